"""Every registered query next to its SQL, and what must hold of their plans."""

import os

import pytest

from __spark_entry__ import entry
from check import connect, difference
from corpusloom.catalog import QUERIES, SQL

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def built(spark, small):
    """Each query is built once for all tests of this module."""
    made = {}

    def build(name):
        if name not in made:
            made[name] = QUERIES[name](spark, FOLDER)
        return made[name]

    return build


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(built, con, name):
    assert difference(built(name), con.sql(SQL[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_gives_rows(built, name):
    assert built(name).collect()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, small):
    assert entry(spark).count() > 0


# Not among them: encode_ids, decode_ids and collate look words up in Arrow batches, as only that keeps rows whole.
NATIVE = (
    "strip_ws collapse_ws reject_tags clean_text clean_guarded filter_clean text_fallback_value "
    "source_ordinal interleave take_n empty_batches prepare_corpus vocab_build "
    "pad_longest mask_prompt mask_pad splice_segment splice_labels pad_spliced pad_audio "
    "embedding_gather splice_batch vector_mean vector_std rms_norm init_new_vectors frame_energy "
    "metric_rollup retain_last_k best_checkpoint word_edits wer_corpus wer_by_group"
).split()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_stays_in_the_jvm(built, name):
    text = plan(built(name))
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_has_no_cross_join(built, name):
    text = plan(built(name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_reaches_the_scan(built):
    text = plan(built("src_language"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text


def test_cleaning_is_computed_once(built):
    physical = plan(built("filter_clean")).split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    assert physical.count("replace(") > 0
    assert physical.count("<QUESTIONMARK>") == 1


def test_few_rows_per_run_are_shuffled(built):
    assert "WindowGroupLimit" in plan(built("retain_last_k"))
