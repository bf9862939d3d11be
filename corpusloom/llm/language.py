"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is reduced to its letters in lower case, with one space for everything between them; its
n-grams of one to three characters are hashed into buckets. Training counts buckets per language in
parallel and keeps one matrix of log-probabilities, languages by buckets, which is broadcast: its
size is fixed by the two numbers. Scoring gathers the columns of a block of texts and sums them per
text, so a batch costs a few numpy calls, however many texts it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import hash_share

UNKNOWN = "und"
BUCKET_BITS = 16
SIZES = (1, 2, 3)
# Texts of each language that are learned from: a larger sample does not move the estimates.
TEXTS_PER_LANGUAGE = 4000
# Languages are columns of the broadcast matrix: so many take half a gigabyte.
MOST_LANGUAGES = 1000
# Overlapping n-grams are not independent: a text's evidence counts as that of so many at most.
EVIDENCE = 100.0
# Code points that are scored at a time.
BLOCK_CHARS = 1 << 18
_REST = regex.compile(r"\P{L}+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str | None) -> str:
    """The letters of a text in lower case with single spaces between runs; empty if there are none."""
    return _REST.sub(" ", text.lower()).strip() if text else ""


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of each n-gram, in blocks; a text longer than a block goes through several."""
    pieces, owners, held = [], [], 0
    for i, text in enumerate(texts):
        if text:
            # A space on both sides marks the ends of words.
            points = np.frombuffer(f" {text} ".encode("utf-32-le"), dtype=np.uint32)
            pieces.append(points)
            owners.append(np.full(len(points), i, dtype=np.int64))
            held += len(points)
        if held and (held >= BLOCK_CHARS or i == len(texts) - 1):
            points, owner = np.concatenate(pieces).astype(np.uint64), np.concatenate(owners)
            for at in range(0, len(points), BLOCK_CHARS):
                stop = at + BLOCK_CHARS
                buckets, whose = [], []
                for n in SIZES:
                    # n-grams that begin in this slice; those at its end reach into the next one
                    part = points[at : stop + n - 1]
                    count = len(part) - n + 1
                    if count <= 0:
                        continue
                    code = np.full(count, n, dtype=np.uint64)
                    for j in range(n):
                        code = (code ^ part[j : j + count]) * _MIX
                        code ^= code >> np.uint64(29)
                    same = owner[at : at + count] == owner[at + n - 1 : at + n - 1 + count]
                    buckets.append((code[same] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
                    whose.append(owner[at : at + count][same])
                yield np.concatenate(buckets), np.concatenate(whose)
            pieces, owners, held = [], [], 0


@dataclass
class LanguageModel:
    """Languages by code point, the log of their shares, and log-probabilities by bucket and language."""

    names: list[str]
    prior: np.ndarray
    logs: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its probability; of equally likely ones the first."""
        plain = [letters(t) for t in texts]
        if not self.names:
            return [(UNKNOWN, 0.0)] * len(plain)
        sums = np.zeros((len(plain), len(self.names)))
        grams = np.zeros(len(plain))
        for buckets, owner in _blocks(plain):
            # Owners come in order within each n-gram size; sort them together for one sum per text.
            order = np.argsort(owner, kind="stable")
            owner, buckets = owner[order], buckets[order]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for k in range(len(self.names)):
                sums[owner[first], k] += np.add.reduceat(self.logs[k][buckets].astype(np.float64), first)
            grams[owner[first]] += np.diff(np.r_[first, len(owner)])
        scale = np.minimum(1.0, EVIDENCE / np.maximum(grams, 1.0))
        odds = sums * scale[:, None] + self.prior
        best = odds.argmax(axis=1)
        share = 1.0 / np.exp(odds - odds.max(axis=1, keepdims=True)).sum(axis=1)
        return [
            (self.names[k], float(p)) if g else (UNKNOWN, 0.0) for k, p, g in zip(best, share, grams)
        ]


def fit_language_model(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    smoothing: float = 0.1,
) -> LanguageModel:
    """Learn from labelled texts. Rows without a language or text are left out; without any, nothing is ever recognised.

    From each language about ``texts_per_language`` texts are learned from, chosen by a hash of the
    key, so a rare language has all of its texts and a rerun the same ones. Counts are summed by
    language and bucket in the cluster; the driver receives at most that many numbers.
    """
    rows = labelled.where(F.col(lang).isNotNull()).select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    )
    totals = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"there may be {MOST_LANGUAGES} languages")
    names = sorted(totals)
    number = {name: i for i, name in enumerate(names)}
    if not names:
        return LanguageModel([], np.zeros(0), np.zeros((0, 1 << BUCKET_BITS), dtype=np.float32))
    shares = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, texts_per_language / totals[n]))])
    chosen = rows.where(F.col("_text").isNotNull() & (hash_share(F.col("_key"), "language") < shares[F.col("_lang")]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(names), 1 << BUCKET_BITS), dtype=np.int64)
        for batch in batches:
            langs = np.array([number[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for buckets, owner in _blocks([letters(t) for t in batch.column(0).to_pylist()]):
                flat = np.bincount(langs[owner] << BUCKET_BITS | buckets, minlength=seen.size)
                seen += flat.reshape(seen.shape)
        lang_at, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang_at, pa.int64()), pa.array(bucket, pa.int64()), pa.array(seen[lang_at, bucket], pa.int64())],
            ["lang", "bucket", "n"],
        )

    counted = chosen.select("_text", "_lang").mapInArrow(count, "lang long, bucket long, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((len(names), 1 << BUCKET_BITS))
    seen[summed["lang"].to_numpy(), summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    logs = np.log(seen + smoothing) - np.log(seen.sum(axis=1, keepdims=True) + smoothing * seen.shape[1])
    prior = np.log(np.array([totals[n] for n in names], dtype=float) / sum(totals.values()))
    return LanguageModel(names, prior, logs.astype(np.float32))


def identify_language(spark: SparkSession, text: Column, model: LanguageModel) -> Column:
    """A struct of the language and its score from 0 to 1; ``und`` with score 0 for null and texts without a letter.

    The score is the probability among the learned languages; a text's evidence counts as that of
    at most ``EVIDENCE`` independent n-grams. Whole texts are scored, in blocks of bounded memory. A
    column function: repeated rows and other columns stay as they are.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
        for column in batches:
            found = []
            for at in range(0, len(column), 512):
                found += known.predict(column[at : at + 512].to_pylist())
            yield pa.array([{"lang": name, "score": score} for name, score in found], kind)

    return predict(text)
