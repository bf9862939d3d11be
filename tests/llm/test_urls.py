"""Verdicts next to a loop over all rules, and the query next to its SQL."""

import os
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from check import connect, difference
from corpusloom.llm import urls
from corpusloom.llm.queries import SQL, URL_RULES, op10_url_verdicts
from corpusloom.llm.urls import RuleArray, judge_url, pack_rules, url_host, url_path

KIND = "page_id long, url string, host int, rule int"


def expected(host, path, rules):
    """The longest fitting rule; block wins over allow for the same rule."""
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits else (None, None)


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    return "".join(c.lower() if c.isascii() else c for c in host), rest.split("#")[0].split("?")[0]


def rule_array(tmp_path, rules):
    file = tmp_path / "rules.bin"
    file.write_bytes(pack_rules(rules))
    return RuleArray(str(file))


@pytest.mark.parametrize("collide", [False, True])
def test_rules_equal_a_loop(tmp_path, monkeypatch, collide):
    if collide:  # many strings share a digest
        monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda key, digest=xxhash.xxh32_intdigest: digest(key) % 7)
    pick = random.Random(4)
    labels = ["a", "b", "com", "x", "é", ""]
    rules = list({(h, p): (h, p, pick.choice(["allow", "block"])) for _ in range(120)
                  for h in [".".join(pick.choices(labels, k=pick.randint(1, 3)))] for p in ["".join(pick.choices(["/", "a", "é", "b/"], k=pick.randint(0, 4)))]}.values())
    array = rule_array(tmp_path, rules)
    hosts = [".".join(pick.choices(labels, k=pick.randint(1, 4))) for _ in range(500)]
    paths = ["".join(pick.choices(["/", "a", "é", "b/"], k=pick.randint(0, 6))) for _ in range(500)]
    assert array.rule_of(hosts, paths) == [expected(h, p, rules) for h, p in zip(hosts, paths)]


def test_equal_rules_and_empty_lists(tmp_path):
    array = rule_array(tmp_path, [("A.com", "/", "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("b.com", None, "allow")])
    assert array.rule_of(["a.com", "x.b.com", "c"], ["/z", "", "/"]) == [("a.com/", "block"), ("b.com", "allow"), (None, None)]
    assert rule_array(tmp_path, []).rule_of(["a"], ["/"]) == [(None, None)]
    assert rule_array(tmp_path, [("a", "", "block")]).rule_of([], []) == []


def test_parts_and_columns(spark):
    given = [None, "", "nothing", "http://", "HTTP://Www.Example.COM/en/x?y#z", "x://y://z/a", "http://a.net?q=/fr/", "http://a.net#/fr/",
             "http://ÀB.net/fr/é", "http://net/es/\nq", "http://u:p@a.com:80/x", "http://" + "a." * 3000 + "com/" + "p" * 100_000]
    df = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(given)] * 2, KIND)
    parts = df.select("page_id", "url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    got = parts.withColumn("j", judge_url(spark, F.col("h"), F.col("p"), URL_RULES, default="block")).collect()
    assert len(got) == 2 * len(given)
    for r in got:
        host, path = split(r["url"])
        assert (r["h"], r["p"]) == (host, path)
        rule, verdict = expected(host, path, URL_RULES)
        assert (r["j"]["rule"], r["j"]["verdict"]) == (rule, verdict or "block")
    assert df.where("false").select(judge_url(spark, F.col("url"), F.col("url"), []).alias("j")).collect() == []


def test_rules_from_a_table(spark):
    rules = spark.createDataFrame([("a.com", "/", "block"), ("b.com", "/", "allow")], "host string, path string, verdict string")
    got = spark.createDataFrame([("www.a.com", "/")], "h string, p string").select(judge_url(spark, F.col("h"), F.col("p"), rules).alias("j"))
    assert got.first()["j"].asDict() == {"rule": "a.com/", "verdict": "block"}


def test_query_equals_sql(spark, small):
    assert difference(op10_url_verdicts(spark, small), connect(small).sql(SQL["op10_url_verdicts"])) is None


def test_query_on_odd_pages(spark, tmp_path):
    df = spark.createDataFrame([(None, None, 1, 2), (1, "https://x.example.com/en/", 1, 2), (1, "https://x.example.com/en/", 1, 2)], KIND)
    df.write.parquet(os.path.join(tmp_path, "pages.parquet"))
    got = op10_url_verdicts(spark, str(tmp_path)).collect()
    assert sorted(r["verdict"] for r in got) == ["allow", "block", "block"]
