"""Runs of words against a definition written out, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm import periodic
from residua.llm.queries import all_queries

BREAK = re.compile(r"[^\x20\x09-\x0D]+")


def stretches(words, period):
    """Longest stretches in which words ``period`` apart are equal."""
    start = None
    for i in range(period, len(words) + 1):
        if i < len(words) and words[i] == words[i - period]:
            start = i - period if start is None else start
        elif start is not None:
            yield start, i
            start = None


def naive(words, least_length=6, least_exponent=4):
    smallest = {}
    for q in range(1, len(words) // least_exponent + 1):
        for s, e in stretches(words, q):
            if e - s >= 2 * q:
                smallest.setdefault((s, e), q)
    return sorted(
        (s, e - s, q) for (s, e), q in smallest.items() if e - s >= max(least_length, least_exponent * q)
    )


def texts(rng, count, letters, most):
    for _ in range(count):
        n = rng.randint(0, most)
        words = [rng.choice(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 3:
                a, p = rng.randrange(n), rng.randint(1, 9)
                tail = words[a : a + p]
                words[a + p : a + p] = tail * rng.randint(0, 6)
        yield [w.encode() for w in words]


@pytest.mark.parametrize("letters,most", [("ab", 60), ("abc", 200), ("abcdefghij", 300), ("a", 90)])
def test_runs_are_those_of_the_definition(letters, most):
    rng = random.Random(len(letters))
    some = list(texts(rng, 60, letters, most))
    for exponent, length in ((4, 6), (2, 2), (3, 1)):
        assert periodic.runs_of(some, length, exponent) == [naive(t, length, exponent) for t in some]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80), st.lists(st.integers(1, 40), min_size=1, max_size=30))
def test_pieces_of_any_size_give_the_same_stretches(words, sizes):
    whole, parts = periodic.Catchers(), periodic.Catchers()
    whole.append(np.array(words, np.int64))
    at, i = 0, 0
    while at < len(words):
        parts.append(np.array(words[at : at + sizes[i % len(sizes)]], np.int64))
        at, i = at + sizes[i % len(sizes)], i + 1

    def runs(catchers):
        smallest = {}
        for s, e, q in catchers.stretches().tolist():
            smallest.setdefault((s, e), q)
        return smallest

    expected = {}
    for q in range(1, len(words) // 2 + 1):
        for s, e in stretches(words, q):
            if e - s >= 2 * q:
                expected.setdefault((s, e), q)
    assert runs(whole) == runs(parts) == expected


def test_special_words():
    fib, other = [b"a"], [b"a", b"b"]
    while len(other) < 2000:
        fib, other = other, other + fib
    thue = [b"ab"[bin(i).count("1") % 2 :][:1] for i in range(2048)]
    for words in (other[:600], thue[:600], [b"x"] * 500, [b"x", b"y"] * 300, ([b"x"] * 9 + [b"y"]) * 40):
        assert periodic.runs_of([words]) == [naive(words)]
        assert periodic.runs_of([words], 2, 2) == [naive(words, 2, 2)]
    assert periodic.runs_of([thue * 16]) == [[(0, 16 * 2048, 2048)]]


def test_a_very_long_text():
    words = [str(i * i % 7919).encode() for i in range(100_000)]
    words[20_000:20_000] = [b"again"] * 50_000
    found = periodic.runs_of([words])[0]
    assert (20_000, 50_000, 1) in found
    assert len(periodic.collapsed(words, [r for r in found if r[2] == 1])) == 100_001


def test_only_true_equality_counts(monkeypatch):
    """With names that clash, runs are still cut where the words differ."""
    monkeypatch.setattr(periodic, "scramble", lambda x: x & np.uint64(3))
    rng = random.Random(3)
    for words in texts(rng, 20, "abcd", 60):
        found = periodic.runs_of([words])[0]
        assert all(words[s + q : s + n] == words[s : s + n - q] and n >= max(6, 4 * q) for s, n, q in found)


def expected_row(doc_id, text):
    words = BREAK.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = naive(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_query(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, b" ".join(t).decode()) for i, t in enumerate(texts(rng, 150, "abcde", 120))]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "é " * 9), (1004, "a\x1cb " * 7), (1005, "a a " * 8), (1003, "é " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS runs", "2 AS id", "'x' AS collapsed"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    got = all_queries()["op11_periodic_runs"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected_row(*r) for r in rows)


def test_null_id_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a " * 10), (None, None)], "doc_id long, text string")
    rows = periodic.digests(periodic.periodic_runs(docs, rebuild=periodic.repeated_tail)).collect()
    assert sorted((r["n_runs"], r["length"]) for r in rows if r["n_runs"]) == [(1, 10)] and len(rows) == 2
    assert periodic.digests(periodic.periodic_runs(docs.limit(0))).count() == 0
