"""Fingerprints against a window-by-window version."""
import hashlib
import math
import random

import numpy as np
import pytest

from ledgerlens.llm import fingerprint as fp

DOCS = "doc_id long, text string"


def plain_classes(text):
    out = []
    for i in range(len(text) - fp.WINDOW + 1):
        w = text[i:i + fp.WINDOW]
        total = sum(int(np.round(c * math.log2(c) * 2 ** 24)) for c in (w.count(b) for b in set(w)))
        most = int(np.round(fp.WINDOW * math.log2(fp.WINDOW) * 2 ** 24))
        out.append((most - total) * 1000 // most)
    return out


def plain_features(text, ranks):
    """Places of the features, by points of every span that meets the text."""
    n = [int(ranks[c]) for c in plain_classes(text)]
    points = [0] * len(n)
    for begin in range(-fp.SPAN + 1, len(n)):
        span = [(n[p], p) for p in range(max(0, begin), min(len(n), begin + fp.SPAN)) if n[p] < fp.NONE]
        if span:
            points[min(span)[1]] += 1
    return [p for p, x in enumerate(points) if x >= fp.POINTS]


def plain_filters(hashes):
    out, seen = [], []
    for h in hashes:
        if h in seen:
            continue
        if len(seen) % fp.PER_FILTER == 0:
            out.append([0, set()])
        seen.append(h)
        out[-1][0] += 1
        out[-1][1].update(h >> 11 * i & 2047 for i in range(5))
    return out


def plain_half(a, b):
    total = 0.0
    for n, bits in a:
        best = 0.0
        for _, other in b:
            few, many = min(len(bits), len(other)), max(len(bits), len(other)) / 2048
            chance, shared = few * many, len(bits & other)
            if shared > chance + 3 * math.sqrt(chance * (1 - many)):
                best = max(best, (shared - chance) / (few - chance))
        total += n * best
    return total / sum(n for n, _ in a)


def plain_likeness(a, b):
    n, m = sum(x for x, _ in a), sum(x for x, _ in b)
    if not n or not m:
        return float(n == m)
    return plain_half(a, b) if n < m else plain_half(b, a) if m < n else (plain_half(a, b) + plain_half(b, a)) / 2


def made(seed, n, most=900):
    g = random.Random(seed)
    words = ["".join(g.choice("aeioulnrstdé") for _ in range(g.randint(2, 9))) for _ in range(300)]
    return [" ".join(g.choice(words) for _ in range(g.randint(0, most // 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return fp.ranks_of(fp.class_counts([t.encode() for t in made(9, 60)]))


def chain_of(chains, i):
    a, b = chains.rows(i)
    return [(int(chains.counts[r]), set(np.flatnonzero(np.unpackbits(chains.bits[r].view(np.uint8), bitorder="little")).tolist())) for r in range(a, b)]


def test_classes_and_features(ranks, monkeypatch):
    texts = [t.encode() for t in made(1, 25)] + [b"", b"short", b"a" * 500, b"ab" * 60, bytes(range(97, 123)) * 20]
    for t in texts:
        assert fp.entropy_classes(np.frombuffer(t, np.uint8)).tolist() == plain_classes(t)
    for chunk in (1 << 17, 100):
        monkeypatch.setattr(fp, "CHUNK", chunk)
        buffer, ends, begins = fp._laid(texts)
        places = fp._selected(buffer, begins, ranks)
        start = 0
        for t, e in zip(texts, ends.tolist()):
            assert [p - start for p in places.tolist() if start <= p < e] == plain_features(t, ranks)
            start = e
        counts = np.bincount([c for t in texts for c in plain_classes(t)], minlength=fp.CLASSES)
        assert (fp.class_counts(texts) == counts).all()


def test_chains_and_likeness(ranks, monkeypatch):
    monkeypatch.setattr(fp, "PER_FILTER", 7)
    texts = [t.encode() for t in made(2, 12)] + [b"", b"short", b"a" * 500]
    texts += [texts[0], texts[1][:300] + texts[2]]
    chains = fp.Chains(texts, ranks)
    plain = []
    for i, t in enumerate(texts):
        buffer = np.frombuffer(t, np.uint8)
        hashes = fp.window_hashes(buffer, np.array(plain_features(t, ranks), np.int64)).tolist()
        if not hashes and t:
            hashes = [fp.xxhash.xxh64_intdigest(t)]
        plain.append([(n, bits) for n, bits in plain_filters(hashes)])
        assert chain_of(chains, i) == plain[-1]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert fp.likeness(chains, i, chains, j) == pytest.approx(plain_likeness(plain[i], plain[j]), abs=1e-12)
    assert chains.text(0) == chains.text(len(texts) - 2) and chains.text(12) == ""


def compared(spark, docs, ranks, schema=DOCS, n=4):
    frame = spark.createDataFrame(docs, schema).repartition(n)
    return {r.doc_id: r for r in fp.compare_with_edits(frame, ranks).collect()}


def test_next_in_id_order_over_parts(spark, ranks):
    texts = made(4, 80)
    docs = [(i * 37 % 1009, t) for i, t in enumerate(texts)] + [(2000, None), (2001, ""), (-5, "tiny"), (3000, texts[3] * 40)]
    got = compared(spark, docs, ranks)
    order = sorted((i, t or "") for i, t in docs)
    assert len(got) == len(docs)
    for (i, t), (_, then) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edit = t[:len(t) - half] + then[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        own = fp.Chains([t.encode(), edit.encode(), then.encode()], ranks)
        assert (r.fingerprint, r.edited_fingerprint) == (own.text(0), own.text(1))
        assert r.near_edited == fp.likeness(own, 0, own, 1) and r.near_next == fp.likeness(own, 0, own, 2)


def test_likeness_tells_edits_from_strangers(spark, ranks):
    texts = [t for t in made(5, 60, 3000) if len(t) > 800]
    got = compared(spark, list(enumerate(texts)), ranks).values()
    assert all(0.3 < r.near_edited < 0.8 for r in got) and all(r.near_next < 0.3 for r in got)


def test_odd_tables(spark, ranks):
    assert compared(spark, [], ranks) == {}
    one = compared(spark, [(7, "one text " * 20)], ranks)[7]
    assert one.near_next == 1.0
    docs = [(None, "null id first. " * 9), (3, "copy " * 30), (3, "copy " * 30), (3, "other " * 30), (4, "last words " * 30)]
    rows = fp.compare_with_edits(spark.createDataFrame(docs, DOCS), ranks).collect()
    assert len(rows) == 5 and sum(r.near_next == 1.0 for r in rows) >= 1
    assert len({r.fingerprint for r in rows if r.doc_id == 3}) == 2
    last = [r for r in rows if r.doc_id == 4][0]
    t, first = docs[-1][1], docs[0][1]
    assert last.edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + first[:len(t) // 2]).encode()).hexdigest()
    wide = spark.createDataFrame([(str(i), t, 1, 2, 3) for i, t in docs], "doc_id string, text string, part int, guest int, tie int")
    assert fp.compare_with_edits(wide, ranks).count() == 5
    assert fp.fingerprints(wide, ranks).count() == 5
    assert (fp.corpus_ranks(spark.createDataFrame([], DOCS)) == fp.ranks_of(np.zeros(fp.CLASSES, int))).all()


def test_corpus_ranks_count_all_texts(spark):
    texts = made(6, 30)
    frame = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], DOCS).repartition(3)
    assert (fp.corpus_ranks(frame) == fp.ranks_of(fp.class_counts([t.encode() for t in texts]))).all()
