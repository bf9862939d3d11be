"""A quality classifier on supervised subword embeddings.

Each word has a vector, the mean of those of its hashed self and its hashed character n-grams; a
text's vector is the mean over its words, and a softmax over it gives the score. Vectors and output
weights are learned together by stochastic gradient descent in numpy, on a sample of labelled
texts of bounded size.

For scoring, the output weights are multiplied into the vectors once. What a word adds to a text's
score is then one number, which a worker keeps for the words it has met.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BITS = 17
NGRAMS = (2, 3)
DIMENSION = 8
EPOCHS = 4
BATCH = 16
# Small samples are gone through more often, until there were so many steps.
LEAST_STEPS = 500
RATE = 0.5
# Labelled texts that are learned from, the size of the longest of them, and words that a scoring worker keeps.
MOST_TEXTS = 2500
MOST_BYTES = 200_000
KEPT_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


# The word that stands for a word pair of twice the same word, whichever it is.
TWICE = b"\x02\x03"


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8, and ``TWICE`` for each that repeats the one before."""
    found = text.encode().split() if text else []
    return found + [TWICE] * sum(map(eq, found[1:], found))


def word_features(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of all words one after the other, and how many each has.

    Features are the word itself and the n-grams of its characters with marks at both ends.
    """
    marked = [np.frombuffer(f"\x02{n.decode()}\x03".encode("utf-32-le"), dtype=np.uint32) for n in names]
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    points = np.concatenate(marked).astype(np.uint64) if marked else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(names)), lengths)
    # The word itself: a sum of its characters, each spread by its place.
    place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    spread = (points + np.uint64(1)) * ((place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MIX)
    spread ^= spread >> np.uint64(31)
    whole = np.add.reduceat(spread * _MIX, np.cumsum(lengths) - lengths) if len(points) else np.zeros(0, np.uint64)
    codes, owners = [whole * _MIX], [np.arange(len(names))]
    for n in NGRAMS:
        count = len(points) - n + 1
        if count <= 0:
            continue
        code = np.full(count, n, dtype=np.uint64)
        for j in range(n):
            code = (code ^ points[j : j + count]) * _MIX
            code ^= code >> np.uint64(29)
        same = owner[:count] == owner[n - 1 :]
        codes.append(code[same])
        owners.append(owner[:count][same])
    code, owner = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (code[order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return buckets, np.bincount(owner, minlength=len(names))


def _word_means(values: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The mean of ``values`` over the features of each word."""
    if not len(counts):
        return np.zeros((0, *values.shape[1:]), dtype=values.dtype)
    sums = np.add.reduceat(values[buckets], np.cumsum(counts) - counts, axis=0)
    return sums / counts.reshape(-1, *[1] * (values.ndim - 1))


@dataclass
class QualityModel:
    """What each bucket adds to the log odds of label 1, and the odds of a text without words."""

    weights: np.ndarray
    bias: float


def train(texts: list[str | None], labels: list[int], seed: int = 1) -> QualityModel:
    """Stochastic gradient descent over batches of texts; the order depends on ``seed`` only.

    With labels of one kind only, or none, every text has the score of their share (one half for none).
    """
    n = len(labels)
    share = sum(labels) / n if n else 0.5
    if not n or not 0 < share < 1:
        return QualityModel(np.zeros(1 << BUCKET_BITS, dtype=np.float32), 20.0 if share == 1 else -20.0 if n else 0.0)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSION)).astype(np.float32) / DIMENSION
    output = np.zeros((2, DIMENSION), dtype=np.float32)
    bias = np.array([math.log(1 - share), math.log(share)], dtype=np.float32)
    target = np.array(labels, dtype=np.int64)
    known: dict[bytes, int] = {}
    bags = []
    for text in texts:
        bag = Counter(words(text))
        ids = np.array([known.setdefault(w, len(known)) for w in bag], dtype=np.int64)
        times = np.array(list(bag.values()), dtype=np.float32)
        bags.append((ids, times / max(1.0, times.sum())))
    buckets, counts = word_features(list(known))
    starts = np.cumsum(counts) - counts
    batches = -(-n // BATCH)
    steps = max(EPOCHS, -(-LEAST_STEPS // batches)) * batches
    for step in range(steps):
        if step % batches == 0:
            order = random.permutation(n)
        rate = RATE * (1 - step / steps)
        rows = order[step % batches * BATCH : (step % batches + 1) * BATCH]
        ids = np.concatenate([bags[r][0] for r in rows])
        times = np.concatenate([bags[r][1] for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
        used, where = np.unique(ids, return_inverse=True)
        if not len(used):
            continue
        size = counts[used]
        feature = buckets[np.repeat(starts[used] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        word = _word_means(vectors, feature, size)
        # Texts by words of this batch, as shares: dense, but only for the words at hand.
        mixed = np.zeros((len(rows), len(used)), dtype=np.float32)
        mixed[owner, where] = times
        hidden = mixed @ word
        odds = hidden @ output.T + bias
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(rows)), target[rows]] -= 1
        to_words = mixed.T @ (error @ output)
        output -= rate * (error.T @ hidden)
        bias -= rate * 0.1 * error.mean(axis=0)
        change = np.repeat(to_words / size[:, None], size, axis=0)
        for d in range(DIMENSION):
            vectors[:, d] -= rate * np.bincount(feature, change[:, d], minlength=len(vectors)).astype(np.float32)
    return QualityModel(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


class QualityScorer:
    """Scores of texts; what words add is kept within a bound."""

    def __init__(self, model: QualityModel, kept: int = KEPT_WORDS) -> None:
        self.model, self.kept, self.known = model, kept, {}

    def score(self, texts: list[str | None]) -> list[float]:
        bags = [words(t) for t in texts]
        fresh = set().union(*bags).difference(self.known) if bags else set()
        if len(self.known) + len(fresh) > self.kept:
            self.known = {}
            fresh = set().union(*bags)
        if fresh:
            names = list(fresh)
            added = _word_means(self.model.weights.astype(np.float64), *word_features(names))
            self.known.update(zip(names, added.tolist()))
        of = self.known.__getitem__
        odds = [self.model.bias + (sum(map(of, bag)) / len(bag) if bag else 0.0) for bag in bags]
        return [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in odds]


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    most_texts: int = MOST_TEXTS,
    most_bytes: int = MOST_BYTES,
) -> QualityModel:
    """Learn from the documents that ``labels`` gives a label of 0 or 1; a null text counts as empty.

    At most ``most_texts`` texts of at most ``most_bytes`` each are learned from, as many of either
    label as there are or half of that number, chosen by a hash of the key so that a rerun takes
    the same. They are all that reaches the driver. The shares of the labels among all labelled
    rows are put back into the odds afterwards. Null keys have no label; no labels, a score of one half.
    """
    order = F.xxhash64(F.lit("quality"), "_key")
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    marks = marks.join(docs.select(F.col(key).alias("_key")), "_key", "left_semi")
    totals = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    few = [marks.where(F.col("_label") == k).orderBy(order, "_key").limit(most_texts // 2) for k in (0, 1)]
    # At most as many rows as the two limits allow.
    chosen = F.broadcast(few[0].unionByName(few[1]).distinct())
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(chosen, "_key")
    rows = rows.where(F.octet_length(F.coalesce("_text", F.lit(""))) <= most_bytes)
    taken = rows.orderBy(order, F.xxhash64("_text"), "_label").limit(most_texts).collect()
    model = train([r["_text"] for r in taken], [r["_label"] for r in taken])
    ones = sum(r["_label"] for r in taken)
    if len(totals) == 2 and 0 < ones < len(taken):
        model.bias += math.log(totals[1] / totals[0]) - math.log(ones / (len(taken) - ones))
    return model


def quality_score(spark: SparkSession, text: Column, model: QualityModel) -> Column:
    """The score of a text, from 0 to 1, as a double; null and empty texts have that of no words.

    The broadcast model has a fixed size. Whole texts are scored. A column function: repeated rows
    and other columns stay as they are.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = QualityScorer(shared.value)
        for column in batches:
            found: list[float] = []
            for at in range(0, len(column), 256):
                found += scorer.score(column[at : at + 256].to_pylist())
            yield pa.array(found, pa.float64())

    return score(text)
