"""Periodic runs, against a search of every period of every text."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import plain
import pytest
from cases import EDGE

from siltstone.llm import runs


def brute(words: list, least_words: int = 24, least_periods: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period): for each period the stretches that keep it, if they have no smaller one."""
    found, n = [], len(words)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            long = len(part) >= max(least_words, least_periods * q)
            if long and next(p for p in range(1, q + 1) if part[p:] == part[:-p]) == q:
                found.append((i, len(part), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def as_rows(found: list[runs.Run]) -> list[tuple[int, int, int]]:
    return [(r.start, r.length, r.period) for r in found]


def test_runs_by_brute_force():
    rng = random.Random(11)
    texts = []
    for _ in range(600):
        words = []
        while len(words) < rng.randrange(200):
            root = [rng.choice("ab") for _ in range(rng.randrange(1, 12))]
            words += (root * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        texts.append([w.encode() for w in words])
    for limits in ({}, {"least_words": 1}, {"least_words": 5, "least_periods": 4}):
        found = runs.runs_of(texts, **limits)
        assert sum(map(len, found)) > 100
        for words, of in zip(texts, found, strict=True):
            assert as_rows(of) == brute(words, **limits)


def test_texts_of_a_batch_stay_apart():
    """A run neither goes on in the next text nor comes from two equal ones."""
    texts = [[b"a"] * 20, [b"a"] * 20, [b"a"] * 24, [], [b"a"] * 23]
    with pytest.raises(ValueError, match="three"):
        runs.runs_of(texts, least_periods=2)
    assert list(map(as_rows, runs.runs_of(texts))) == [[], [], [(0, 24, 1)], [], []]


def test_long_runs():
    """Periods and lengths far beyond a block of the extension."""
    root = [b"%d" % i for i in range(5000)]
    words = [b"x"] * 100 + root * 3 + root[:17] + [b"y"]
    assert as_rows(runs.runs_of([words])[0]) == [(0, 100, 1), (100, 15017, 5000)]
    assert runs.collapsed(words, runs.runs_of([words])[0]) == b" ".join([b"x", *root, b"y"])


def expected(key, text: str) -> tuple:
    words = plain.ascii_words(text)
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        original = list(words)
        words = [original[a + (i - a) % p] if i >= a else original[i] for i in range(n)]
    found = brute(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    return (
        key,
        len(found),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        plain.sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        plain.sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_by_brute_force(query, given):
    """The given texts, but for those on which the brute force would take minutes."""
    texts = {k: t for k, t in given().items() if len(plain.ascii_words(t)) < 1500}
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r.doc_id: tuple(r[c] for c in names) for r in query("op11_periodic_runs")}
    assert set(rows) == set(given()) and len(texts) > 150
    assert sum(rows[k][1] > 0 for k in texts) > 10
    for key, text in texts.items():
        assert rows[key] == expected(key, text)


def test_edge_texts(edge, nothing):
    rows = runs.find(edge.drop("found"), name="found_runs").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in EDGE)
    by_key = {r.doc_id: r.found_runs for r in rows}
    assert (by_key[1].n_words, by_key[1].runs, by_key[1].text) == (0, [], "")
    assert [tuple(r) for r in by_key[4].runs] == [(0, 90_000, 3)] and by_key[4].text == "lorem ipsum dolor"
    assert by_key[6].text == dict(EDGE)[6]
    assert runs.find(nothing).collect() == []


def test_ties(spark):
    """Of equal exponents the first run is named; exponents are compared exactly."""
    words = ["a"] * 24 + ["x"] + ["b"] * 24 + ["y"] + ["c", "d"] * 24
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "a")], "doc_id bigint, text string")
    rows = runs.find(docs).select("doc_id", runs.densest("found.runs").alias("best")).collect()
    assert {r.doc_id: r.best and tuple(r.best) for r in rows} == {1: (0, 24, 1), 2: None}
