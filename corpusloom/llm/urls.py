"""URL filters by a sorted digest array.

Rules (host, path, verdict) are written once as one binary file: 64-bit xxhash digests of their
hosts and of host with path, each sorted, beside the full strings. Tasks memory-map their copy of
the file, so its pages are shared by the workers of a machine and only those probed are read. A
batch of urls is probed with vectorised binary search: first the suffixes of its hosts, then, for
hosts that have rules, the path prefixes of the lengths that those rules have. A digest that is
found counts only if the stored string is equal, so collisions cannot change a verdict.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh_path

ALLOW, BLOCK = "allow", "block"
# A rule list of more rules than this is refused: the driver sorts it.
MOST_RULES = 5_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if null or without it."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty if null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digests(keys: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(key) for key in keys), dtype=np.uint64)


def _packed(keys: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Keys by digest, their digests, and where each begins in their concatenation."""
    digests = _digests(keys)
    order = np.argsort(digests, kind="stable")
    ordered = [keys[i] for i in order]
    return ordered, digests[order], np.r_[0, np.cumsum([len(k) for k in ordered])].astype(np.int64)


def pack_rules(rules: Iterable[tuple[str | None, str | None, str]]) -> bytes:
    """The binary form of a rule list. Of equal rules with different verdicts the blocking one holds; no host, no rule."""
    verdicts: dict[tuple[bytes, bytes], bool] = {}
    for host, path, verdict in rules:
        if host is None:
            continue
        key = (host.translate(str.maketrans(_UPPER, _LOWER)).encode(), (path or "").encode())
        verdicts[key] = verdicts.get(key, False) or verdict == BLOCK
    by_host: dict[bytes, set[int]] = {}
    for host, path in verdicts:
        by_host.setdefault(host, set()).add(len(path))
    hosts, host_digests, host_starts = _packed(list(by_host))
    lengths = [sorted(by_host[h]) for h in hosts]
    keys, digests, starts = _packed([h + b"\n" + p for h, p in verdicts])
    blocked = [verdicts[tuple(k.split(b"\n", 1))] for k in keys]
    numbers = [
        np.array([len(hosts), sum(map(len, lengths)), len(keys)], dtype=np.int64),
        host_digests, host_starts, np.r_[0, np.cumsum([len(x) for x in lengths])].astype(np.int64),
        np.array([n for x in lengths for n in x], dtype=np.int64),
        digests, starts, np.array([len(k.decode()) for k in keys], dtype=np.int64),
    ]
    return b"".join([*(n.tobytes() for n in numbers), bytes(blocked), *hosts, *keys])


class RuleArray:
    """The memory-mapped form of ``pack_rules``."""

    def __init__(self, path: str) -> None:
        whole = np.memmap(path, dtype=np.uint8, mode="r")
        at = 0

        def part(count: int, kind: type) -> np.ndarray:
            nonlocal at
            size = count * np.dtype(kind).itemsize
            at += size
            return whole[at - size : at].view(kind)

        hosts, lengths, rules = map(int, part(3, np.int64))
        self.host_digests, self.host_starts = part(hosts, np.uint64), part(hosts + 1, np.int64)
        self.length_starts, self.lengths = part(hosts + 1, np.int64), part(lengths, np.int64)
        self.digests, self.starts, self.chars = part(rules, np.uint64), part(rules + 1, np.int64), part(rules, np.int64)
        self.blocked = part(rules, np.uint8)
        self.host_strings = part(int(self.host_starts[-1]), np.uint8)
        self.strings = part(int(self.starts[-1]), np.uint8)

    @staticmethod
    def _find(keys: list[bytes], digests: np.ndarray, starts: np.ndarray, strings: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if its string is not stored."""
        wanted = _digests(keys)
        place = np.searchsorted(digests, wanted)
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        while True:
            left = left[place[left] < len(digests)]
            left = left[digests[place[left]] == wanted[left]]
            if not len(left):
                return found
            same = np.fromiter(
                (strings[starts[p] : starts[p + 1]].tobytes() == keys[i] for i, p in zip(left, place[left])),
                dtype=bool, count=len(left),
            )
            found[left[same]] = place[left[same]]
            left = left[~same]  # another string of the same digest: look at the next
            place[left] += 1

    def rule_of(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """Rule and verdict for each url; the longest rule that fits it, of equal ones that of the longer host."""
        known: dict[str, int] = {}
        rows = [known.setdefault(h, len(known)) for h in hosts]
        suffixes, owner = [], []
        for i, host in enumerate(known):
            labels = host.split(".")
            for j in range(len(labels)):
                suffixes.append(".".join(labels[j:]).encode())
                owner.append(i)
        place = self._find(suffixes, self.host_digests, self.host_starts, self.host_strings)
        listed: dict[int, list[tuple[bytes, np.ndarray]]] = {}
        for i, suffix, p in zip(owner, suffixes, place):
            if p >= 0:
                lengths = self.lengths[self.length_starts[p] : self.length_starts[p + 1]]
                listed.setdefault(i, []).append((suffix, lengths))
        keys, at, host_chars = [], [], []
        for i, (row, path) in enumerate(zip(rows, paths)):
            if row in listed:
                raw = path.encode()
                for suffix, lengths in listed[row]:
                    for n in lengths[lengths <= len(raw)]:
                        keys.append(suffix + b"\n" + raw[:n])
                        at.append(i)
                        host_chars.append(len(suffix))
        best: list[tuple[int, int, int]] = [(-1, -1, -1)] * len(hosts)
        for i, chars, p in zip(at, host_chars, self._find(keys, self.digests, self.starts, self.strings)):
            if p >= 0:
                best[i] = max(best[i], (int(self.chars[p]), chars, int(p)))
        text = {}
        for _, _, p in set(best):
            if p >= 0:
                rule = self.strings[self.starts[p] : self.starts[p + 1]].tobytes().decode().replace("\n", "", 1)
                text[p] = (rule, BLOCK if self.blocked[p] else ALLOW)
        return [text.get(p, (None, None)) for _, _, p in best]


def ship_rules(spark: SparkSession, rules: Iterable[tuple[str | None, str | None, str]] | DataFrame) -> str:
    """Write the rules to the shared folder and have every executor fetch them; the name under which tasks find them."""
    if isinstance(rules, DataFrame):
        rules = [tuple(r) for r in rules.limit(MOST_RULES + 1).collect()]
    rules = list(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"a rule list may hold {MOST_RULES} rules")
    data = pack_rules(rules)
    path = fresh_path(spark, "url-rules") + ".bin"
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
    for at in range(0, len(data), 1 << 20):
        stream.write(bytearray(data[at : at + (1 << 20)]))
    stream.close()
    context.addFile(path)
    return path.rsplit("/", 1)[-1]


def judge_url(spark: SparkSession, host: Column, path: Column, rules, default: str = ALLOW) -> Column:
    """A struct of the rule that decides (null if none fits) and the verdict, ``default`` without a rule.

    A rule fits its host and all subdomains if the url's path starts with the rule's. Null hosts or
    paths count as empty; an empty rule list decides nothing. A column function: repeated rows
    and other columns stay as they are.
    """
    name = ship_rules(spark, rules)

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        array = RuleArray(SparkFiles.get(name))
        kind = pa.struct([("rule", pa.string()), ("verdict", pa.string())])
        for hosts, paths in batches:
            found = array.rule_of([h or "" for h in hosts.to_pylist()], [p or "" for p in paths.to_pylist()])
            yield pa.array([{"rule": r, "verdict": v or default} for r, v in found], kind)

    return judge(host, path)
