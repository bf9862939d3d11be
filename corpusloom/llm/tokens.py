"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens; the distinct ones of an Arrow batch that no earlier batch had are
held as one flat array of symbols with the sequence each belongs to. In every round each sequence
finds its lowest-ranked neighbouring pair and merges all its occurrences, left to right, all
sequences at once; a sequence without a mergeable pair leaves with the number of symbols it still
has. Counts per text are sums over its pre-tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: how byte-level vocabularies cut a text, for any script.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pieces_of(letters: str, numbers: str, spaces: str) -> str:
    """The same pattern for a small alphabet, where Python's own engine is faster."""
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


# Letters, numbers and white space up to U+007F and up to U+00FF.
_ASCII_PIECES = _pieces_of("A-Za-z", "0-9", r"\t-\r ")
_LATIN_PIECES = _pieces_of("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0")

# Counts of pre-tokens that a Python worker keeps; beyond them it starts anew.
KEPT_PIECES = 400_000
_NO_RANK = np.iinfo(np.int64).max


def _byte_names() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in printable else next(hidden)) for b in range(256)]


class MergeTable:
    """Byte symbols, and for each mergeable pair its rank and product, as arrays sorted by pair."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, ids = described["model"], described["model"]["vocab"]
        self.symbols = np.array([ids[name] for name in _byte_names()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = np.arange(len(pairs), dtype=np.int64)[order]
        self.products = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.special = [t["content"] for t in described.get("added_tokens", [])]

    def look_up(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that begin at the given places; no rank across or at the end of sequences."""
        if not len(self.keys) or not len(at):
            return np.full(len(at), _NO_RANK), np.zeros(len(at), dtype=np.int64)
        after = np.minimum(at + 1, len(symbols) - 1)
        keys = symbols[at] << 32 | symbols[after]
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        real = (self.keys[found] == keys) & (owner[at] == owner[after]) & (after > at)
        return np.where(real, self.ranks[found], _NO_RANK), self.products[found]


def count_symbols(pieces: list[bytes], table: MergeTable) -> np.ndarray:
    """How many symbols each piece has after all merges."""
    counts = np.zeros(len(pieces), dtype=np.int64)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    names = np.flatnonzero(lengths)
    lengths = lengths[names]
    symbols = table.symbols[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(names)), lengths)
    # For each symbol the rank of the pair it begins, and the symbol that the pair becomes.
    rank, product = table.look_up(symbols, owner, np.arange(len(symbols)))
    while len(names):
        lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        done = lowest == _NO_RANK
        if done.any():
            counts[names[done]] = lengths[done]
            stays = ~done[owner]
            symbols, rank, product = symbols[stays], rank[stays], product[stays]
            names, lengths, lowest = names[~done], lengths[~done], lowest[~done]
            owner = np.repeat(np.arange(len(names)), lengths)
            if not len(names):
                break
        # Of occurrences that overlap, as in a run of one symbol, every second merges.
        where = np.flatnonzero(rank == lowest[owner])
        fresh = np.ones(len(where), dtype=bool)
        fresh[1:] = np.diff(where) != 1
        first = where[fresh][np.cumsum(fresh) - 1]
        where = where[(where - first) % 2 == 0]
        symbols[where] = product[where]
        stays = np.ones(len(symbols), dtype=bool)
        stays[where + 1] = False
        lengths = lengths - np.bincount(owner[where], minlength=len(names))
        symbols, rank, product, owner = symbols[stays], rank[stays], product[stays], owner[stays]
        # Only pairs beside a merged symbol are new.
        merged = where - np.arange(len(where))
        new = np.concatenate([merged, merged[merged > 0] - 1])
        rank[new], product[new] = table.look_up(symbols, owner, new)
    return counts


class PieceCounter:
    """Token counts of texts; what earlier batches counted is kept within a bound."""

    def __init__(self, table: MergeTable, kept: int = KEPT_PIECES) -> None:
        self.table, self.kept, self.known = table, kept, {}
        self.split = regex.compile(PIECES).findall
        self.split_ascii = re.compile(_ASCII_PIECES).findall
        self.split_latin = re.compile(_LATIN_PIECES).findall
        names = sorted(filter(None, table.special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings stand between them."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        found: list[str] = []
        for part in parts:
            found += self.splitter(part)(part)
        return found, len(parts) - 1

    def splitter(self, text: str):
        if text.isascii():
            return self.split_ascii
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split
        return self.split_latin

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self.pieces(text) if text else ([], 0) for text in texts]
        fresh = set().union(*(pieces for pieces, _ in cut)).difference(self.known) if cut else set()
        if len(self.known) + len(fresh) > self.kept:
            self.known = {}
            fresh = set().union(*(pieces for pieces, _ in cut))
        if fresh:
            names = list(fresh)
            # Texts from Spark are valid Unicode, so every piece has its bytes.
            self.known.update(zip(names, count_symbols([n.encode() for n in names], self.table).tolist()))
        size = self.known.__getitem__
        return [sum(map(size, pieces)) + special for pieces, special in cut]


# Characters whose pre-tokens are held at a time, unless one text has more.
BLOCK_CHARS = 2_000_000


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """The number of tokens of a text as a long, by the byte-level BPE file at ``path``; 0 for null and empty texts.

    Special strings inside a text count as their one token, nothing is added or cut off. The file is
    read on the driver and its arrays are broadcast: their size is that of the vocabulary.
    A column function: repeated rows and other columns stay as they are.
    """
    shared = spark.sparkContext.broadcast(MergeTable(path))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = PieceCounter(shared.value)
        for column in batches:
            result: list[int] = []
            block: list[str | None] = []
            held = 0
            for value in column:
                block.append(value.as_py())
                held += len(block[-1] or "")
                if held >= BLOCK_CHARS:
                    result += counter.count(block)
                    block, held = [], 0
            yield pa.array(result + counter.count(block), pa.int64())

    return count(text)
