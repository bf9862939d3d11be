"""Quality rules as a learned decision list, in Spark expressions only.

Statistics of each text are columns. Sequential covering finds the rules: a conjunction of
thresholds is grown on two thirds of the labelled rows, condition by condition, by information gain;
conditions that do not help on the other third are pruned from its end; rows that the rule covers
are set aside and the next one is grown. Every step is one aggregation over a narrow table of
labelled statistics, whose result has a fixed number of rows. The outcome is an ordered
conditional expression that anyone can read.

Thresholds come from fixed grids, so rules stay readable and do not depend on where rows lie.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, hash_share, write_through

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SHARES = (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
# The thresholds that a condition on each measure may have.
GRIDS: dict[str, tuple[float, ...]] = {
    "n_words": (20, 50, 100, 200, 500, 1000, 2000, 5000, 10000),
    "mean_word": (2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 10, 12, 15),
    "symbol_share": _SHARES,
    "dup_line_share": _SHARES,
    "repeat_share": _SHARES,
    "upper_share": _SHARES,
    "digit_share": _SHARES,
    "mark_share": _SHARES,
}
# Bits for a word's place in its text; the rest of a long holds the start of a hash.
_PLACE_BITS = 28


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics and measures of each text.

    The statistics are longs: ``n_words``; ``word_chars``, code points in words; ``n_symbols``,
    characters of ``#*$%&|<>``; ``n_dup_lines``, lines with a word that equal an earlier line;
    ``n_repeat_words``, words in three-word windows that the text has twice or more, the first one
    included. The measures are shares of them (see ``GRIDS``), 0 for a text without words. A null
    text counts as empty. Columns of these names are replaced; all other columns and every row stay.

    Repeated windows are found inside the row: the places of all windows, sorted by the start of a
    hash, leave as candidates those beside an equal start, and only these are compared by their words.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    one = docs.withColumns({
        "_words": F.regexp_extract_all(value, F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split(value, "\n"), lambda line: F.regexp_like(line, F.lit(WORD))),
        "n_symbols": (F.length(value) - F.length(F.regexp_replace(value, r"[#*$%&|<>]+", ""))).cast("long"),
        "_upper": F.length(value) - F.length(F.regexp_replace(value, r"\p{Lu}+", "")),
        "_digits": F.length(value) - F.length(F.regexp_replace(value, r"[0-9]+", "")),
        "_marks": F.length(value) - F.length(F.regexp_replace(value, r"[!?]+", "")),
    })

    def word(at: Column) -> Column:
        return F.get(F.col("_words"), at)

    def packed(at: Column) -> Column:
        code = F.shiftleft(F.xxhash64(word(at), word(at + 1), word(at + 2)), _PLACE_BITS)
        return code.bitwiseOR(at.cast("long"))

    # A window's place is below its hash start; the sign of the shifted hash does not matter.
    two = one.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines"),
        "_windows": F.sort_array(
            F.when(F.size("_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("_words") - 3), packed)).otherwise(
                F.array().cast("array<bigint>")
            )
        ),
    })

    def beside_equal(x: Column, i: Column) -> Column:
        start = F.shiftright(x, _PLACE_BITS)

        def same(other: Column) -> Column:
            return F.coalesce(F.shiftright(F.get(F.col("_windows"), other), _PLACE_BITS) == start, F.lit(False))

        return same(i + 1) | ((i > 0) & same(F.greatest(i - 1, F.lit(0))))

    place = F.lit((1 << _PLACE_BITS) - 1)
    three = two.withColumn("_near", F.filter("_windows", beside_equal))

    def spelled(x: Column) -> Column:
        at = x.bitwiseAND(place).cast("int")
        return F.struct(F.concat_ws(" ", word(at), word(at + 1), word(at + 2)).alias("w"), at.alias("at"))

    four = three.withColumn("_near", F.sort_array(F.transform("_near", spelled)))

    def twice(x: Column, i: Column) -> Column:
        def same(other: Column) -> Column:
            return F.coalesce(F.get(F.col("_near"), other)["w"] == x["w"], F.lit(False))

        return same(i + 1) | ((i > 0) & same(F.greatest(i - 1, F.lit(0))))

    five = four.withColumn("_places", F.sort_array(F.transform(F.filter("_near", twice), lambda x: x["at"])))

    def newly_covered(at: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("_places"), F.greatest(i - 1, F.lit(0))))
        return F.least(F.lit(3), F.coalesce(at - before, F.lit(3)))

    six = five.withColumn(
        "n_repeat_words",
        F.aggregate(F.transform("_places", newly_covered), F.lit(0), lambda total, x: total + x).cast("long"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    measured = six.withColumns({
        "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "_n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("_upper", "word_chars"),
        "digit_share": share("_digits", "word_chars"),
        "mark_share": share("_marks", "word_chars"),
    })
    names = list(dict.fromkeys([*STATISTICS, *GRIDS]))
    # A generator of one row keeps a later filter from being pushed below, where it would compute all of this again.
    return measured.select(
        *[c for c in docs.columns if c not in names], F.inline(F.array(F.struct(*names)))
    )


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.measure)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<'} {self.threshold:g}"


def conjunction(rule: tuple[Condition, ...]) -> Column:
    result = F.lit(True)
    for condition in rule:
        result = result & condition.column()
    return result


def _gain(bad: float, good: float, bad_before: float, good_before: float) -> float:
    """Information gained by going from one coverage to a narrower one, times the bad rows kept."""
    if bad <= 0:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def learn_rules(
    statistics: DataFrame,
    label: str,
    key: str = "doc_id",
    most_rules: int = 8,
    most_conditions: int = 3,
    least_precision: float = 0.9,
    least_cover: int = 5,
) -> list[tuple[Condition, ...]]:
    """The ordered rules for low quality, learned from rows with a label of 0 (low) or 1; no such rows, no rules.

    A rule is kept if at least ``least_precision`` of all rows it covers are labelled 0 and these
    are at least ``least_cover``. Rows are told into growing and pruning ones by a hash of the key.
    """
    rows = statistics.where(F.col(label).isin(0, 1))

    def bin_of(measure: str) -> Column:
        grid = F.array(*[F.lit(float(t)) for t in GRIDS[measure]])
        return F.size(F.filter(grid, lambda t: F.col(measure) >= t))

    binned = write_through(
        rows.select(
            *GRIDS,
            (F.col(label) == 0).alias("_bad"),
            (hash_share(F.col(key), "grow") < 2 / 3).alias("_grow"),
            F.array(*[F.struct(F.lit(m).alias("m"), bin_of(m).alias("b")) for m in GRIDS]).alias("_bins"),
        ),
        "labelled-statistics",
    )
    bad, good = F.sum(F.col("_bad").cast("long")), F.sum((~F.col("_bad")).cast("long"))

    def totals(where: Column) -> tuple[int, int]:
        row = binned.where(where).agg(F.coalesce(bad, F.lit(0)), F.coalesce(good, F.lit(0))).first()
        return row[0], row[1]

    rules: list[tuple[Condition, ...]] = []
    open_ = F.lit(True)
    while len(rules) < most_rules:
        growing = open_ & F.col("_grow")
        rule: tuple[Condition, ...] = ()
        bad_before, good_before = totals(growing)
        while bad_before > 0 and good_before > 0 and len(rule) < most_conditions:
            counts = (
                binned.where(growing & conjunction(rule))
                .select("_bad", F.explode("_bins").alias("x"))
                .groupBy("x.m", "x.b")
                .agg(bad.alias("bad"), good.alias("good"))
                .collect()
            )
            best, best_gain, best_counts = None, 1e-9, (0, 0)
            for measure in GRIDS:
                of = {r["b"]: (r["bad"], r["good"]) for r in counts if r["m"] == measure}
                for i, threshold in enumerate(GRIDS[measure]):
                    above = [sum(v[j] for b, v in of.items() if b > i) for j in (0, 1)]
                    for at_least, (p, n) in ((True, above), (False, [bad_before - above[0], good_before - above[1]])):
                        gain = _gain(p, n, bad_before, good_before)
                        if gain > best_gain + 1e-9:
                            best, best_gain, best_counts = Condition(measure, at_least, float(threshold)), gain, (p, n)
            if best is None:
                break
            rule, (bad_before, good_before) = (*rule, best), best_counts
        if not rule:
            break
        # Prune from the end: the shortest start of the rule that is as good on the other rows.
        starts = [rule[: i + 1] for i in range(len(rule))]
        sums = [F.coalesce(F.sum((conjunction(s) & F.col("_bad") & ~F.col("_grow")).cast("long")), F.lit(0)) for s in starts]
        sums += [F.coalesce(F.sum((conjunction(s) & ~F.col("_bad") & ~F.col("_grow")).cast("long")), F.lit(0)) for s in starts]
        found = list(binned.where(open_).agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first())
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in zip(found, found[len(starts) :])]
        rule = starts[max(range(len(starts)), key=lambda i: (worth[i], -i))] if max(worth) > -1 else rule
        bad_all, good_all = totals(open_ & conjunction(rule))
        if bad_all < least_cover or bad_all < least_precision * (bad_all + good_all):
            break
        rules.append(rule)
        open_ = open_ & ~conjunction(rule)
    return rules


def verdict(rules: list[tuple[Condition, ...]]) -> Column:
    """False where a rule applies, tried in order, else true."""
    if not rules:
        return F.lit(True)
    result = F.when(conjunction(rules[0]), F.lit(False))
    for rule in rules[1:]:
        result = result.when(conjunction(rule), F.lit(False))
    return result.otherwise(F.lit(True))


def decided_by(rules: list[tuple[Condition, ...]]) -> Column:
    """The first rule that applies, spelled out; null where none does."""
    named = [F.when(conjunction(rule), F.lit(" and ".join(map(str, rule)))) for rule in rules]
    return F.coalesce(*named) if named else F.lit(None).cast("string")

