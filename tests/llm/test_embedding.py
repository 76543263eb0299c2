import numpy as np
import pytest

from ledgerlens.llm import embedding


def brute(rows):
    ids = [r[0] for r in rows]
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
              and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((ids[j] for j in seen if ids[j] is not None), default=None)
        out.append((ids[i], len(links[i]), least))
    return sorted(out, key=str)


def vectors(rng, n, d=64):
    base = rng.standard_normal((n, d))
    near = base[:n // 3] + rng.standard_normal((n // 3, d)) * 0.15
    hot = base[0] + rng.standard_normal((n // 3, d)) * 0.12
    return [v.astype(np.float32).tolist() for v in np.concatenate([base, near, hot, base[:5] * 2, base[5:8], base[5:8]])]


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = list(enumerate(vectors(rng, 240)))
    rows += [(1000, None), (1001, [0.0] * 64), (1002, [float("nan")] + [1.0] * 63), (1003, [None] + [1.0] * 63), (1004, []),
             (1005, [float("inf")] + [1.0] * 63), (None, rows[3][1]), (1006, [1.0, 0.0]), (1007, [1.0, 0.1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, label string")
    want = brute(rows)
    got = sorted((tuple(r) for r in embedding.near_vectors(df).collect()), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(w[1] for w in want) > 2000 and sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))                # never a link below the limit
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(got)


def made_entries(v, plans):
    import pyarrow as pa
    n, d = len(v), len(v[0])
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([1] * n), pa.array([list(map(float, x)) for x in v]), pa.array([d] * n, pa.int32())],
                                       ["key", "copies", "v", "d"])
    return pa.Table.from_batches(embedding._entries(plans)([batch]))


def links_of(entries, plans, blocks=1, cells=None):
    import pyarrow as pa
    total = {}
    for cell in cells or set(entries.column("cell").to_pylist()):
        own = entries.filter(pa.compute.equal(entries.column("cell"), cell))
        side = [k % blocks for k in own.column("key").to_pylist()]
        for a in range(blocks):
            for b in range(a, blocks):
                pick = [i for i, s in enumerate(side) if s in (a, b)]
                part = own.take(pa.array(pick, pa.int64())).append_column("block", pa.array([side[i] for i in pick])).append_column("cross", pa.array([a != b] * len(pick)))
                out = embedding._group_links(part, plans) if pick else None
                for k, n in zip(*(out.column(c).to_pylist() for c in ("key", "linked"))) if out else []:
                    total[k] = total.get(k, 0) + n
    return total


def test_tiles_count_as_one_group():
    rng = np.random.default_rng(6)
    plans = {64: (*embedding.settings(64, 50_000), np.zeros(64))}
    entries = made_entries(rng.standard_normal(64) + rng.standard_normal((60, 64)) * 0.1, plans)
    assert links_of(entries, plans) == links_of(entries, plans, 3) and len(links_of(entries, plans)) == 60


def test_collisions_equal_plain_counting():
    rng = np.random.default_rng(4)
    n, own = 30, 5
    at = [(r, c, np.float32(rng.exponential())) for r in range(n) for c in range(12) if rng.random() < 0.4]
    total, before, here = np.zeros(n * n, int), np.zeros(n * n, int), np.zeros(n * n, bool)
    for r, c, v in at:
        for q, e, w in at:
            if r < q and c == e and abs(float(v) - float(w)) <= embedding.WINDOW:
                total[r * n + q] += 1
                before[r * n + q] += c < own
                here[r * n + q] |= c == own
    for events in (1 << 21, 50):
        old, embedding.EVENTS = embedding.EVENTS, events
        got = embedding.collisions(*(np.array(x) for x in zip(*at)), n, own)
        embedding.EVENTS = old
        assert all((g == w).all() for g, w in zip(got, (total, before, here)))


def test_settings_follow_the_number_of_vectors():
    """More vectors have more directions, and ends of as many vectors."""
    few, many = embedding.settings(64, 8_000), embedding.settings(64, 64_000)
    assert many[0] >= 6 * few[0] and many[1] > few[1]
    assert few[2] >= 2 <= many[2] and embedding.settings(64, 100)[1] == 0.0
    rng = np.random.default_rng(1)
    for n, (dirs, least, _) in ((8_000, few), (64_000, many)):
        x = rng.standard_normal((2000, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        row, _, _ = embedding.ends_of(x, dirs, least)
        held = len(row) / 2000 / (2 * dirs) * n
        assert 0.7 * embedding.EDGE < held < 1.4 * embedding.EDGE


def planted(rng, centres, links, d=64, common=0.0, cosine=0.902):
    """Random unit vectors of mean cosine ``common``, each with links of one cosine."""
    mean = np.zeros(d)
    mean[0] = np.sqrt(common)
    out = []
    for _ in range(centres):
        r = rng.standard_normal(d)
        r[0] = 0
        x = mean + np.sqrt(1 - common) * r / np.linalg.norm(r)
        y = rng.standard_normal((links, d))
        y[:, 0] = 0
        y -= (y @ x)[:, None] * (x - mean) / (1 - common)        # moves on the sphere of equal common parts
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        near = (cosine - common) / (1 - common)
        y = mean + np.sqrt(1 - common) * (near * (x - mean) / np.sqrt(1 - common) + np.sqrt(1 - near * near) * y)
        out.append(np.concatenate([x[None], y]))
    return mean, out


@pytest.mark.parametrize("vectors", [10_000, 50_000])
@pytest.mark.parametrize("common", [0.0, 0.3, 0.5])
def test_every_vector_finds_its_links(vectors, common):
    """Links of one centre depend on the same few ends: the recall must hold for the centre,
    not only on average, and for vectors with a common direction."""
    rng = np.random.default_rng(8)
    mean, groups = planted(rng, 100, 40, common=common)
    n, least, count = embedding.settings(64, embedding._rounded(vectors), max(0.0, np.ceil(common * 20 - 0.2) / 20))
    found = []
    for v in groups:
        assert abs(float(v[0] @ v[1]) - 0.902) < 1e-6
        row, cell, value = embedding.ends_of(embedding._centred(v, mean), n, least)
        total, _, _ = embedding.collisions(row, cell, value, len(v), 0)
        found.append((total[1:len(v)] >= count).mean())
    assert np.mean(found) >= 0.95 and np.quantile(found, 0.02) >= 0.85 and (np.array(found) >= 0.95).mean() >= 0.93


def test_short_vectors(spark):
    rows = [(i, [float(np.cos(i / 40)), float(np.sin(i / 40))]) for i in range(200)] + [(1000 + i, [float(i - 2)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want, got = brute(rows), sorted((tuple(r) for r in embedding.near_vectors(df).collect()), key=str)
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want) and sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding.near_vectors(df).count() == 0
