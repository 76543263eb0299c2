import random
import zlib

import numpy as np

from ledgerlens.llm import quality, toxicity

WORDS = [a + b for a in ("ter", "mon", "lia", "ker", "sor", "vel", "dan") for b in ("ing", "ous", "an", "et", "o", "ula", "em")]


def corpus(r, n, toxic_share=0.2, junk_share=0.2):
    rows = []
    for i in range(n):
        words = r.choices(WORDS, k=r.randint(40, 150))
        toxic = r.random() < toxic_share
        junk = r.random() < junk_share
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words[r.randrange(len(words))] = r.choice(["idiot", "moron", "scum", "zabrak" + r.choice(["in", "el", "ot"])])
        if junk:
            words = [w + r.choice(["$$$", "%%%"]) for w in words]
        rows.append((i, " ".join(words), int(not junk), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _, _ in rows], "doc_id long, text string, id string, score double")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_both_classifiers_on_held_out_rows(spark):
    rows = corpus(random.Random(4), 600)
    docs, labels = frames(spark, rows)
    truth = {i: (q, x) for i, _, q, x in rows}
    for module, k, folds, fold in ((quality, 0, 5, 0), (toxicity, 1, 4, 2)):
        got = module.classify(docs, labels).collect()
        assert len(got) == len(rows) and all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.3) for g in got)
        assert all(g.held_out == (zlib.crc32(str(g.id).encode()) % folds == fold) for g in got)
        tested = [g for g in got if g.held_out]
        right = np.mean([g.predicted == truth[g.id][k] for g in tested])
        assert len(tested) > 50 and right > 0.95, (module.__name__, right)


def test_held_out_labels_are_never_learnt(spark):
    rows = corpus(random.Random(5), 300)
    docs, labels = frames(spark, rows)
    for module, folds, fold in ((quality, 5, 0), (toxicity, 4, 2)):
        changed = [(i, t, 1 - q, 1 - x) if zlib.crc32(str(i).encode()) % folds == fold else (i, t, q, x) for i, t, q, x in rows]
        a = {g.id: round(g.score, 9) for g in module.classify(docs, labels).collect()}
        b = {g.id: round(g.score, 9) for g in module.classify(docs, frames(spark, changed)[1]).collect()}
        assert a == b


def test_odd_rows(spark):
    rows = corpus(random.Random(6), 200)
    docs, labels = frames(spark, rows)
    odd = spark.createDataFrame([(None, "idiot", "x", 1.0), (5000, None, "x", 1.0), (5001, "", "x", 1.0), (5001, "", "x", 1.0),
                                 (5002, "word " * 100_000, "x", 1.0)], docs.schema)
    more = labels.union(spark.createDataFrame([(3, 0, 1), (3, 1, None), (None, 1, 1)], labels.schema))
    for module in (quality, toxicity):
        got = module.classify(docs.union(odd), more).collect()
        assert len(got) == 205 and all(0 <= g.score <= 1 and g.held_out is not None for g in got)
        none = labels.limit(0)
        flat = module.classify(docs, none).collect()
        assert len(flat) == 200 and len({g.score for g in flat}) == 1
        assert module.classify(docs.limit(0), labels).count() == 0
    one = labels.filter("quality = 1")
    assert {g.score for g in quality.classify(docs, one).collect()} == {1.0}


def test_accepted_keeps_columns(spark):
    rows = corpus(random.Random(7), 300)
    docs, labels = frames(spark, rows)
    out = quality.accepted(docs, labels)
    assert out.columns == docs.columns and 200 < out.count() < 280


def test_non_negative_risk_keeps_hidden_positives():
    r = np.random.default_rng(1)
    # feature 0 marks positives; half of the positives are in the unlabelled set
    positive = np.array([True] * 50 + [False] * 250)
    marked = np.array([True] * 50 + [True] * 50 + [False] * 200)
    owner = np.concatenate([np.flatnonzero(marked), np.arange(300)])
    flat = np.concatenate([np.zeros(marked.sum(), int), 1 + r.integers(0, 300, 300)])
    w, b = toxicity.fit_pu(owner, flat, np.ones(len(owner)), positive, 301, 0.2)
    assert w[0] + b > 0 > b


def entries(rng, texts=40, features=7):
    owner = np.repeat(np.arange(texts), 3)
    return owner, rng.integers(0, features, len(owner)), rng.random(len(owner)) * 3, rng.random(texts) < 0.3


def test_risk_gradient_by_finite_differences():
    """Both branches of the non-negative risk: descending it, and raising a second term below zero."""
    rng = np.random.default_rng(3)
    owner, flat, x, positive = entries(rng)
    seen = set()
    for prior in (0.1, 0.5, *[0.95] * 20):
        theta = rng.standard_normal(8) * 2
        first, rest, grad = toxicity.risk(theta, owner, flat, x, positive, prior)
        seen.add(rest >= 0)

        def value(t):
            a, b, _ = toxicity.risk(t, owner, flat, x, positive, prior)
            return a + b if rest >= 0 else -b
        for i in range(len(theta)):
            step = np.zeros(len(theta))
            step[i] = 1e-6
            assert abs((value(theta + step) - value(theta - step)) / 2e-6 - grad[i]) < 1e-5
    assert len(seen) == 2


def test_risk_equals_a_plain_sum():
    rng = np.random.default_rng(4)
    owner, flat, x, positive = entries(rng)
    theta = rng.standard_normal(8)
    first, rest, _ = toxicity.risk(theta, owner, flat, x, positive, 0.2)
    z = [theta[-1] + sum(theta[f] * v for o, f, v in zip(owner, flat, x) if o == i) for i in range(len(positive))]
    plus, minus = (lambda v: np.log1p(np.exp(-v))), (lambda v: np.log1p(np.exp(v)))
    own, other = [v for v, p in zip(z, positive) if p], [v for v, p in zip(z, positive) if not p]
    assert abs(first - 0.2 * np.mean([plus(v) for v in own])) < 1e-9
    assert abs(rest - (np.mean([minus(v) for v in other]) - 0.2 * np.mean([minus(v) for v in own]))) < 1e-9


def test_copies_of_a_row_do_not_swell_the_sample(spark, monkeypatch):
    rows = corpus(random.Random(7), 300)
    docs, labels = frames(spark, rows)
    toxic = next(i for i, _, _, x in rows if x and zlib.crc32(str(i).encode()) % 4 != 2)
    many = docs.union(spark.createDataFrame([(toxic, rows[toxic][1], "x", 1.0)] * 500, docs.schema))
    sizes, fit = [], toxicity.fit_pu

    def seen(owner, flat, x, positive, *rest, **kw):
        sizes.append(len(positive))
        return fit(owner, flat, x, positive, *rest, **kw)
    monkeypatch.setattr(toxicity, "fit_pu", seen)
    a = {g.id: g.score for g in toxicity.classify(docs, labels).collect()}
    b = {g.id: g.score for g in toxicity.classify(many, labels).collect()}
    assert len(sizes) == 2 and sizes[0] == sizes[1] and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_the_prior_of_a_mostly_toxic_corpus_is_not_cut(spark):
    rows = corpus(random.Random(7), 200, toxic_share=0.8)
    docs, labels = frames(spark, rows)
    share = np.mean([x for i, _, _, x in rows if zlib.crc32(str(i).encode()) % 4 != 2])
    model = toxicity.train(docs, labels)
    assert share > 0.7 and (model.weights or abs(1 / (1 + np.exp(-model.bias)) - share) < 1e-9)


def test_discriminant_equals_plain_numpy(spark):
    rng = np.random.default_rng(5)
    d = len(quality.STATS)
    x = [rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * 0.3 + k for k, n in ((0, 50), (1, 80))]
    rows = [(k, v.tolist()) for k in (0, 1) for v in x[k]]
    model = quality.fit(spark.createDataFrame(rows, "label int, x array<double>").repartition(5))
    cov = [np.cov(v.T, bias=True) for v in x]
    both = (cov[0] * 50 + cov[1] * 80) / 130
    made = []
    for c in cov:
        c = (1 - quality.SHRINK_POOLED) * c + quality.SHRINK_POOLED * both
        made.append((1 - quality.SHRINK_IDENTITY) * c + quality.SHRINK_IDENTITY * np.diag(np.diag(both) + 1e-4))
    tested = rng.standard_normal((20, d))
    density = [np.array([-0.5 * (t - v.mean(axis=0)) @ np.linalg.inv(c) @ (t - v.mean(axis=0)) - 0.5 * np.linalg.slogdet(c)[1] for t in tested])
               for v, c in zip(x, made)]
    want = 1 / (1 + np.exp(np.clip(-(density[1] - density[0] + np.log(80 / 50)), -700, 700)))
    assert np.allclose(model.score(tested), want, atol=1e-8)
