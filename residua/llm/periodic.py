"""Runs of repeated words, found online by dyadic square catching.

Words come one after another.  A square is a stretch of 2 q words whose halves are equal.  Its first half holds a
completed block of L words, aligned to a multiple of L, for the power of two L with 2 L - 1 <= q <= 4 L - 2;
the catcher of that block waits for its copy q words later.  So every appended word meets two catchers on each
level: the blocks that lie 2 L - 1 to 4 L - 2 words before the L words that it completes.  Where the words
are equal, a suffix comparison opens: it looks back from both places as far as they agree, and each word
appended later moves it on while that word equals the word q before.  A comparison that covers 2 q words has
seen a square; all squares of one period that overlap merge into one stretch, a run, and it is over when a word differs.
Stretches of a multiple of a period that a known run explains are not opened again.

``Catchers`` takes words in pieces of any size, one word at a time or whole texts; the runs are the same.  All words of
a piece are worked on at once in arrays.  Blocks are compared by 64-bit hashes of their words; before a run
is reported its words are compared one by one, and a stretch that is equal in hash only is cut where its words differ.

A run reported here is a longest stretch of at least max(``least_length``, ``least_exponent`` * period) words with
smallest period ``period``.  Words are longest runs of bytes other than space, tab, line feed, vertical tab,
form feed and carriage return.

Null or empty text: no word, no run, empty collapsed text.  A null id is an id like any other.  Repeated rows give
repeated results, each row is worked on alone; other columns do not matter.  Memory is bounded by
the longest text (about 200 bytes a word), whatever the number of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.words import in_pieces, scramble, utf8

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
PIECE = 1 << 16  # words handed over at once
CHUNK = 1_000_000  # characters of texts worked on together
ODD = np.uint64(0x9E3779B97F4A7C15)
RUN = "array<struct<start:long,length:long,period:long>>"

Rebuild = Callable[[str | None, list[bytes]], list[bytes]]


def word_list(text: str | None) -> list[bytes]:
    return utf8(text).split()


class _Runs:
    """Stretches of equal words at a distance: start, end, period, as growing lists of arrays."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        if len(start):
            self.parts.append(np.stack([start, end, period]))

    def all(self) -> np.ndarray:
        return np.concatenate(self.parts, axis=1) if self.parts else np.zeros((3, 0), np.int64)


class Catchers:
    """Squares of a stream of word numbers, merged into runs; ``longest`` bounds the length of a run if known."""

    def __init__(self, longest: int | None = None, least_exponent: int = 2):
        self.size = 0
        self.names: list[np.ndarray] = [np.zeros(0, np.uint64)]  # by level: names of the blocks that start at each word
        self.filled = [0]
        self.most_period = longest // least_exponent if longest is not None else None
        self.live = np.zeros((2, 0), np.int64)  # start and period of the comparisons that reach the last word
        self.closed = _Runs()

    # --- the words so far

    def _room(self, level: int, size: int) -> None:
        if size > len(self.names[level]):
            grown = np.zeros(max(size, 2 * len(self.names[level])), np.uint64)
            grown[: self.filled[level]] = self.names[level][: self.filled[level]]
            self.names[level] = grown

    def _levels(self) -> int:
        """Levels whose catchers can see a square in the words so far."""
        most = self.size // 2 if self.most_period is None else min(self.size // 2, self.most_period)
        return max(0, (most + 1).bit_length() - 1)  # the smallest period of a level is 2 L - 1

    def _take(self, words: np.ndarray) -> list[int]:
        """Names all new blocks; returns the first new start per level."""
        first = [self.size]
        self._room(0, self.size + len(words))
        self.names[0][self.size : self.size + len(words)] = words
        self.size += len(words)
        self.filled[0] = self.size
        for level in range(1, self._levels()):
            half = 1 << (level - 1)
            if level == len(self.names):
                self.names.append(np.zeros(0, np.uint64))
                self.filled.append(0)
            begin, end = self.filled[level], max(self.filled[level], self.size - 2 * half + 1)
            self._room(level, end)
            below = self.names[level - 1]
            self.names[level][begin:end] = scramble(below[begin:end] * ODD + below[begin + half : end + half])
            self.filled[level] = end
            first.append(begin)
        return first

    # --- suffix comparisons

    def _ahead(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on whose word differs from the one ``period`` before."""
        at, top = at.copy(), len(self.names) - 1
        moving = np.arange(len(at))
        while len(moving):  # by whole top blocks, then by ever smaller ones
            moving = moving[self._step(top, at, period, moving, 1)]
        for level in range(top - 1, -1, -1):
            self._step(level, at, period, np.arange(len(at)), 1)
        return at

    def _back(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The least start from which words equal those ``period`` later, up to ``at``."""
        at, top = at.copy(), len(self.names) - 1
        moving = np.arange(len(at))
        while len(moving):
            moving = moving[self._step(top, at, period, moving, -1)]
        for level in range(top - 1, -1, -1):
            self._step(level, at, period, np.arange(len(at)), -1)
        return at

    def _step(self, level: int, at: np.ndarray, period: np.ndarray, rows: np.ndarray, way: int) -> np.ndarray:
        """Moves ``at[rows]`` over one block where both blocks are equal; returns which moved."""
        block, names, filled = 1 << level, self.names[level], self.filled[level]
        here = at[rows] if way > 0 else at[rows] - block
        other = here - period[rows] if way > 0 else here + period[rows]
        ok = (here >= 0) & (other >= 0) & (np.maximum(here, other) < filled)
        ok[ok] = names[here[ok]] == names[other[ok]]
        at[rows[ok]] += way * block
        return ok

    def _open(self, start: np.ndarray, period: np.ndarray, known: _Runs) -> None:
        """New comparisons of blocks at ``start`` and ``period`` later; those that end are closed."""
        begin = self._back(start, period)
        begin, period = np.unique(np.stack([begin, period]), axis=1) if len(begin) else (begin, period)
        end = self._ahead(begin + period, period)
        known.add(begin, end, period)

    # --- words

    def append(self, words: np.ndarray) -> None:
        """More words, as numbers; equal numbers are equal words."""
        old = self.size
        first = self._take(np.asarray(words).astype(np.uint64))
        start, period = self.live
        found = _Runs()
        found.add(start, self._ahead(np.full(len(start), old), period), period)
        for level in range(min(self._levels(), len(first))):
            block = 1 << level
            new = np.arange(first[level], self.filled[level])
            near = (new - 2 * block + 1) // block * block
            for caught in (near, near - block):
                ok = caught >= 0
                ok[ok] = self.names[level][caught[ok]] == self.names[level][new[ok]]
                if self.most_period is not None:
                    ok &= new - caught <= self.most_period
                at, q = caught[ok], (new - caught)[ok]
                if not len(at):
                    continue
                # the block before was caught at the same distance, so this is the same stretch
                order = np.lexsort((at, q))
                at, q = at[order], q[order]
                fresh = np.ones(len(at), bool)
                fresh[1:] = (q[1:] != q[:-1]) | (at[1:] != at[:-1] + block)
                at, q = at[fresh], q[fresh]
                at, q = self._unexplained(at, at + q + block, q, found)
                self._open(at, q, found)
        start, end, period = found.all()
        over = end < self.size
        square = over & (end - start >= 2 * period)
        self.closed.add(start[square], end[square], period[square])
        self.live = np.unique(np.stack([start, period])[:, ~over], axis=1)

    @staticmethod
    def _unexplained(at, upto, q, found: _Runs) -> tuple[np.ndarray, np.ndarray]:
        """Leaves out the stretches inside a known run whose period divides theirs."""
        start, end, period = found.all()
        run = end - start >= 2 * period
        if not run.any() or not len(at):
            return at, q
        start, end, period = start[run], end[run], period[run]
        order = np.argsort(start, kind="stable")
        start, end, period = start[order], end[order], period[order]
        reach = np.maximum.accumulate(end)
        farthest = np.maximum.accumulate(np.where(end == reach, np.arange(len(end)), 0))
        i = np.searchsorted(start, at, side="right") - 1
        best = farthest[np.maximum(i, 0)]
        known = (i >= 0) & (end[best] >= upto) & (q % period[best] == 0)
        return at[~known], q[~known]

    def stretches(self) -> np.ndarray:
        """(start, end, period) rows of all stretches that hold a square, by start, end, period; each once."""
        start, period = self.live
        every = _Runs()
        every.add(*self.closed.all())
        open_ = self.size - start >= 2 * period
        every.add(start[open_], np.full(int(open_.sum()), self.size), period[open_])
        rows = every.all()
        return np.unique(rows, axis=1).T


def _equal_words(ids: np.ndarray, start: int, end: int, period: int) -> Iterator[tuple[int, int]]:
    """The stretches of words that truly equal those ``period`` later."""
    same = ids[start : end - period] == ids[start + period : end]
    if same.all():
        yield start, end
        return
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    for a, b in zip(edge[0::2], edge[1::2]):
        yield start + int(a), start + int(b) + period


def runs_of(
    texts: Sequence[Sequence[bytes]], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """Per text, a list of words, its runs (start, length, period) by start, then period."""
    if least_exponent < 2:
        raise ValueError("a run holds a square")
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    ids = np.full(int((sizes + 1).sum()), -1, np.int64)
    for i, words in zip(begins, texts):
        ids[i : i + len(words)] = [number.setdefault(w, len(number)) for w in words]
    ends = begins + sizes
    ids[ends] = len(number) + np.arange(len(texts))  # what stands between texts equals nothing
    catchers = Catchers(int(sizes.max(initial=0)), least_exponent)
    for i in range(0, len(ids), PIECE):
        catchers.append(ids[i : i + PIECE])
    rows = catchers.stretches()
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least_length, least_exponent * rows[:, 2])]
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    seen: set[tuple[int, int]] = set()
    for start, end, period in rows.tolist():  # the smallest period of equal stretches comes first
        for a, b in _equal_words(ids, start, end, period):
            if (a, b) in seen or b - a < max(least_length, least_exponent * period):
                continue
            seen.add((a, b))
            text = int(np.searchsorted(begins, a, side="right")) - 1
            runs[text].append((a - int(begins[text]), b - a, period))
    for found in runs:
        found.sort(key=lambda r: (r[0], r[2]))
    return runs


def collapsed(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run only its first period stays, unless another run drops that, too."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~gone)]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    rebuild: Rebuild | None = None,
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` per row: the runs by start, then period, and the text without repeats.

    ``rebuild`` may change the words of a document, given its id as text, before they are searched.
    No shuffle: every row is worked on where it is read.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                part = batch.iloc[s]
                texts = [word_list(t) for t in part["text"]]
                if rebuild:
                    texts = [rebuild(i, t) for i, t in zip(part["id"], texts)]
                found = runs_of(texts, least_length, least_exponent)
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "n_words": [len(t) for t in texts],
                        "runs": [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in found],
                        "collapsed": [b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, found)],
                    }
                )

    # ids travel as text: pandas would turn whole numbers beside a null into doubles
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    done = rows.mapInPandas(search, f"id string, n_words long, runs {RUN}, collapsed string")
    return done.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "runs", "collapsed")


# --- what the registered query makes of it


def repeated_tail(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The words, the tail of every tenth document (by hash) replaced by copies of one stretch of it."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of runs, the run of greatest exponent, and hashes of all runs and of the collapsed text."""

    def better(best, run):
        """Exponents as fractions: exact in whole numbers."""
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    marked = found.select(
        id_col,
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    exponent = F.expr("best.length * 1000 div best.period")
    return marked.select(
        id_col,
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        exponent.alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
