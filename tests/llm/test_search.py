"""Ranked search against a plain scorer."""
import math
import re

import pytest

from ledgerlens.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_terms(text):
    return [t.translate(LOW) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    bags = [(i, plain_terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 10 + 90 * len(b) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b.count(t) // (1000 * b.count(t) + 8 * m))
                        for t in set(plain_terms(text)) if t in df)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def ours(spark, docs, items, k=10):
    found = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=k)
    return sorted(map(tuple, found.collect()), key=str)


WORDS = "Alpha beta gamma DELTA épée Épée naïve x1 42 the the of of Ünder 日本 zeta".split()


def corpus(n):
    return [(n - i, " ".join(WORDS[(i * 7 + j * j) % len(WORDS)] + (".", ", ", "\n")[j % 3] for j in range(1 + i % 23))) for i in range(n)]


ASKED = [(1, "alpha, the ÉPÉE"), (2, "zeta zeta 42"), (3, "unheard"), (4, None), (5, ""), (6, "Ünder under OF 日本 x1 beta gamma delta naïve")]


@pytest.mark.parametrize("k", [1, 10])
def test_equals_plain_scorer(spark, k):
    docs = corpus(300)
    assert ours(spark, docs, ASKED, k) == plain(docs, ASKED, k)


def test_tiles_and_passes(spark, monkeypatch):
    docs = corpus(200)
    monkeypatch.setattr(search, "ITEM_TILE", 2)
    monkeypatch.setattr(search, "TERM_TILE", 3)
    monkeypatch.setattr(search, "PASS_BYTES", 30)
    assert ours(spark, docs, ASKED) == plain(docs, ASKED)


def test_ties_take_the_smallest_ids(spark):
    docs = [(i, "same words here") for i in range(2000, 0, -1)] + [(-i, "other text") for i in range(2500)] + [(None, "same words here")]
    got = ours(spark, docs, [(1, "same")])
    assert sorted((r, i) for _, r, i, _ in got) == [(1, None)] + [(r, r - 1) for r in range(2, 11)]
    assert got == plain(docs, [(1, "same")])


def test_odd_rows(spark):
    assert ours(spark, [], ASKED) == [] and ours(spark, corpus(5), []) == []
    assert ours(spark, [(1, None), (2, ""), (3, " .,")], ASKED) == []
    docs = [*corpus(20), (900, "zeta " * 300_000), (901, None)]
    assert ours(spark, docs, ASKED) == plain(docs, ASKED)
    twice = ours(spark, docs, [(2, "zeta 42"), (2, "zeta 42"), (None, "beta")])
    assert twice == plain(docs, [(2, "zeta 42"), (None, "beta")])
    wide = spark.createDataFrame([(str(i), t, 1, 2, 3) for i, t in corpus(20)], "doc_id string, text string, rank int, score int, item int")
    assert {r.id for r in search.search(wide, spark.createDataFrame(ASKED, ITEMS)).collect()} <= {str(i) for i, _ in corpus(20)}


def test_partial_sums_stay_exact():
    import numpy as np
    g = np.random.default_rng(1)
    weights = g.integers(2 ** 30, 2 ** 31, 40)
    tile = search._Tile(0, [np.arange(40), np.arange(0, 40, 3)], weights)
    assert tile.width * int(weights.max()) * search.IMPACT_LIMIT < 2 ** 53
    impact = g.integers(1, search.IMPACT_LIMIT, 40)
    got = tile.scores(np.zeros(40, int), np.arange(40), impact, 1)
    assert got[0, 0] == int((weights.astype(object) * impact.astype(object)).sum())
