"""Near-duplicate vectors by collision-counting projections.

Unit vectors, centred by their mean, are projected on many fixed Gaussian
directions.  Only the two ends of a sorted projection tell close vectors from
others, so on each direction the outermost values of either sign are kept, EDGE
or so at each end however many vectors there are (more vectors have more
directions instead).  Two vectors collide on a projection if both are at the same
end and one lies in the other's window, WINDOW wide to either side of it.
Collisions are counted per pair over all projections, and pairs with
at least the calibrated count are verified by their cosine in double precision.

The number of directions and the count are calibrated vector by vector: links of one
vector depend on its own ends and are lost together, so all but WORST of the
vectors must keep the wanted recall of their links of exactly the limit cosine.

Each vector travels once per end that it is at, with the list of all its ends,
so a task that holds one end counts the pairs' collisions on all projections, and
takes a pair only if this is the first one they collide on: no pair is
shuffled, and none counted twice.  Ends of more than TILE vectors (many near
copies) are cut into tiles of bounded size.  Links leave a task as counts per
vector and as stars of local components.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, written
from .components import connected_components

LIMIT = 0.9
#: Vectors at an end of a projection, about, and ends that a vector is at on average (or more, by the calibration).
EDGE, ENDS = 256, 31
#: Half the width of a window; projections have unit variance.
WINDOW = 1.25
RECALL = 0.98
#: Share of the vectors that may fall short of RECALL of their links.
WORST = 0.01
TILE = 512
SEED = 42
#: Directions made at a time, and collisions counted at a time.
BLOCK, EVENTS = 4096, 1 << 21


@functools.lru_cache(maxsize=64)
def directions(d: int, block: int = 0) -> np.ndarray:
    """One block of Gaussian directions of unit variance for unit vectors of ``d`` components."""
    g = np.random.default_rng([SEED, d, 0, block]).standard_normal((BLOCK, d))
    return (g / np.linalg.norm(g, axis=1, keepdims=True) * np.sqrt(d)).T


@functools.lru_cache(maxsize=256)
def settings(d: int, vectors: int, common: float = 0.0, limit: float = LIMIT, centres: int = 400, links: int = 200) -> tuple[int, float, int]:
    """For so many vectors of ``d`` components and mean cosine ``common``: the number of
    directions, the value at which their ends begin, and the count of collisions that
    decides; the fewest directions, then the largest count, with which all but WORST of
    seeded random centres keep RECALL of their links of cosine ``limit``."""
    near = max(0.05, (limit - common) / (1 - common)) if common < 1 else 0.05       # between centred vectors
    share = min(1.0, 2 * EDGE / max(1, vectors))
    g = np.random.default_rng([SEED, d, 1])
    x = g.standard_normal((centres, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sample = np.abs(x @ directions(d)).ravel()
    while True:
        least = float(np.quantile(sample, 1 - share)) if share < 1 else 0.0
        for more in (1.0, 1.5, 2.0, 3.0, 4.5):
            n = math.ceil(ENDS * more / share)
            count = _collisions(d, n, least, x, links, near)

            def worst(c: int) -> float:
                return float(np.quantile((count >= c).mean(axis=1), WORST))

            if worst(1) >= RECALL:
                return n, least, max(c for c in range(1, n + 1) if c == 1 or worst(c) >= RECALL)
        if share >= 1:
            return n, 0.0, 0                         # no count tells links apart: every pair is verified
        share = min(1.0, 2 * share)


def _collisions(d: int, n: int, least: float, x: np.ndarray, links: int, near: float) -> np.ndarray:
    """How often each of ``links`` seeded random vectors of cosine ``near`` collides with its centre, a row a centre."""
    g = np.random.default_rng([SEED, d, 2])
    out = np.zeros((len(x), links), int)
    for i, c in enumerate(x):
        y = g.standard_normal((links, d))
        y -= (y @ c)[:, None] * c
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
        y = near * c + np.sqrt(1 - near * near) * y
        for block in range(-(-n // BLOCK)):
            dirs = directions(d, block)[:, :min(BLOCK, n - block * BLOCK)]
            p = c @ dirs
            own = np.flatnonzero(np.abs(p) >= least)
            q = y @ dirs[:, own] * np.sign(p[own])
            out[i] += ((q >= least) & (np.abs(q - np.abs(p[own])) <= WINDOW)).sum(axis=1)
    return out


def ends_of(unit: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, end, value)`` of all values of at least ``least`` on ``n`` directions, by row
    and end; end ``2 i`` is the positive one of direction i, ``2 i + 1`` the other."""
    row, end, value = [], [], []
    for at in range(0, len(unit), 512):
        r, e, v = [], [], []
        for block in range(-(-n // BLOCK)):
            p = unit[at:at + 512] @ directions(unit.shape[1], block)[:, :min(BLOCK, n - block * BLOCK)]
            i, c = np.nonzero(np.abs(p) >= least)
            r.append(i)
            e.append((c + block * BLOCK) * 2 + (p[i, c] < 0))
            v.append(np.abs(p[i, c]))
        r, e, v = (np.concatenate(x) for x in (r, e, v))
        order = np.lexsort((e, r))
        row.append(r[order] + at)
        end.append(e[order])
        value.append(v[order].astype(np.float32))
    return np.concatenate(row), np.concatenate(end), np.concatenate(value)


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)      # keeps the squares in range
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centred(unit: np.ndarray, mean: np.ndarray) -> np.ndarray:
    x = unit - mean
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's number and sum of unit vectors for each length."""
    held: dict[int, list] = {}
    for batch in batches:
        sizes = np.asarray(batch.column("d"))
        for d in np.unique(sizes):
            x = _unit(batch.filter(pa.array(sizes == d)).column("v").to_pylist())
            own = held.setdefault(int(d), [0, np.zeros(d)])
            own[0] += len(x)
            own[1] += x.sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()),
                                      pa.array([s.tolist() for _, s in held.values()], pa.list_(pa.float64()))], ["d", "n", "total"])


def plans_for(distinct: DataFrame) -> dict[int, tuple[int, float, int, np.ndarray]]:
    """For each length of vectors ``(directions, least, count, mean)``."""
    rows = distinct.select("v", "d").mapInArrow(_sums, "d int, n long, total array<double>").groupBy("d").agg(
        F.sum("n").alias("n"), F.array_agg("total").alias("totals"))
    summed = rows.select("d", "n", F.aggregate("totals", F.transform(F.get("totals", F.lit(0)), lambda x: F.lit(0.0)),
                                               lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("total"))
    out = {}
    for r in summed.collect():                          # a row for each length of vectors
        mean = np.array(r["total"]) / r["n"]
        # few different settings: the size and the mean cosine are rounded up
        common = max(0.0, math.ceil(float(mean @ mean) * 20 - 0.2) / 20)
        out[r["d"]] = (*settings(r["d"], _rounded(r["n"]), common), mean)
    return out


def _rounded(n: int) -> int:
    """The next power of the square root of 2."""
    return round(2 ** (math.ceil(2 * math.log2(max(1, n))) / 2))


def _entries(plans: dict):
    """A row for each end that a vector is at, with the vector and all its ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("d"))
            for d in np.unique(sizes):
                n, least, _, mean = plans[int(d)]
                own = batch.filter(pa.array(sizes == d))
                for at in range(0, own.num_rows, 256):
                    part = own.slice(at, 256)
                    row, end, value = ends_of(_centred(_unit(part.column("v").to_pylist()), mean), n, least)
                    cuts = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                    pick = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(end.astype(np.int64)), part.column("d").take(pick), part.column("key").take(pick), part.column("copies").take(pick),
                         part.column("v").take(pick), pa.ListArray.from_arrays(cuts, pa.array(end.astype(np.int32))).take(pick),
                         pa.ListArray.from_arrays(cuts, pa.array(value)).take(pick)],
                        ["cell", "d", "key", "copies", "v", "cells", "values"])

    return run


def _sizes(plans: dict):
    """How many of a task's vectors are at each end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("d"))
            for d in np.unique(sizes):
                n, least, _, mean = plans[int(d)]
                own = batch.filter(pa.array(sizes == d))
                _, end, _ = ends_of(_centred(_unit(own.column("v").to_pylist()), mean), n, least)
                cell, held = np.unique(end, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(np.full(len(cell), d, np.int32)), pa.array(held.astype(np.int64))],
                                                 ["cell", "d", "n"])

    return run


def collisions(rows: np.ndarray, cells: np.ndarray, values: np.ndarray, n: int, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per pair of ``n`` rows (numbered ``smaller * n + larger``) how often it collides, how
    often on ends before ``own``, and whether on this: each end's values are sorted,
    and every row looks up its window."""
    order = np.lexsort((values, cells))
    rows, cells, values = rows[order], cells[order], values[order].astype(np.float64)
    far = 4 * (WINDOW + float(values.max(initial=0.0)))
    rank = np.cumsum(np.concatenate([[0], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, int)
    line = rank * far + values                         # one line, with ends out of each other's windows
    reach = np.searchsorted(line, line + WINDOW, side="right") - np.arange(len(line)) - 1
    total, before, here = np.zeros(n * n, np.int32), np.zeros(n * n, np.int32), np.zeros(n * n, bool)
    done = np.cumsum(reach)
    a = 0
    while a < len(reach):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + EVENTS, side="right")))
        held = reach[a:b]
        first = np.repeat(np.arange(a, b), held)
        then = first + 1 + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        pair = np.minimum(rows[first], rows[then]) * n + np.maximum(rows[first], rows[then])
        total += np.bincount(pair, minlength=n * n).astype(np.int32)
        before += np.bincount(pair[cells[first] < own], minlength=n * n).astype(np.int32)
        here[pair[cells[first] == own]] = True
        a = b
    return total, before, here


def _tile_pairs(group: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile to verify here: those with enough collisions whose first one is
    on this end (or, where no count tells links apart, all whose first shared end it is)."""
    n = group.num_rows
    lists, values = group.column("cells").combine_chunks(), group.column("values").combine_chunks()
    rows, cells = np.repeat(np.arange(n), np.asarray(lists.value_lengths())), np.asarray(lists.flatten())
    own = group.column("cell")[0].as_py()
    if least == 0:
        early = cells < own
        held = np.zeros((n, int(cells.max(initial=0)) + 1), np.float32)
        held[rows[early], cells[early]] = 1
        pick = np.flatnonzero(np.triu(held @ held.T == 0, 1).ravel())
    else:
        total, before, here = collisions(rows, cells, np.asarray(values.flatten()), n, own)
        pick = np.flatnonzero((total >= least) & (before == 0) & here)
    return pick // n, pick % n


def _group_links(group: pa.Table, plans: dict) -> pa.RecordBatch | None:
    """Links of one tile: per vector the copies it is linked with and a local root."""
    n = group.num_rows
    if n < 2:
        return None
    side = np.asarray(group.column("block"))
    two = len(np.unique(side)) > 1
    if not two and group.column("cross")[0].as_py():
        return None
    a, b = _tile_pairs(group, plans[group.column("d")[0].as_py()][2])
    if two:
        a, b = a[side[a] != side[b]], b[side[a] != side[b]]
    if not len(a):
        return None
    some = np.unique(np.concatenate([a, b]))
    x = np.zeros((n, group.column("d")[0].as_py()))
    x[some] = _unit(group.column("v").take(pa.array(some)).to_pylist())
    near = np.concatenate([np.einsum("ij,ij->i", x[a[i:i + 8192]], x[b[i:i + 8192]]) >= LIMIT for i in range(0, len(a), 8192)])
    a, b = a[near], b[near]
    if not len(a):
        return None
    copies, keys = np.asarray(group.column("copies")), np.asarray(group.column("key"))
    linked = np.bincount(a, copies[b], n).astype(np.int64) + np.bincount(b, copies[a], n).astype(np.int64)
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            break
        root = low
    some = np.flatnonzero(linked)
    return pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(linked[some]), pa.array(keys[root[some]])], ["key", "linked", "root"])


def _by_tile(plans: dict):
    """Rows come sorted by tile; one tile at a time is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            tile = np.asarray(held.column("tile_key"))
            cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if (out := _group_links(held.slice(a, b - a), plans)) is not None:
                    yield out
            held = held.slice(cuts[-1]).combine_chunks()
        if held is not None and (out := _group_links(held, plans)) is not None:
            yield out

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, n_links, component_id)`` for every row of ``table``.

    ``n_links``: other rows whose vector has a cosine of at least LIMIT with this
    one's, equal vectors included; only vectors of one length are compared.
    ``component_id``: the smallest id reachable by links.  Rows whose vector is
    null, empty, zero, or has null or non-finite components link with nothing
    and are components of their own.  Repeated rows count as rows; a null id
    never names a component.  Equal vectors are compared once, by their value.
    An empty table gives no rows; other columns are ignored.
    """
    # vectors travel as they are stored; every product is taken in double precision
    kind = "float" if table.schema[vector].dataType.simpleString() == "array<float>" else "double"
    v = F.transform(F.col(vector).cast(f"array<{kind}>"), lambda x: F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x))
    usable = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = table.select(F.col(id_col).alias("id"), v.alias("v")).withColumn("usable", usable)
    rows = rows.withColumn("key", F.when(F.col("usable"), F.xxhash64("v")))
    narrow = written(rows.select("id", "key"), "vector-rows")
    distinct = rows.filter("usable").groupBy("key", "v").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    distinct = written(distinct.withColumn("d", F.size("v")), "vectors")

    n = parts(table.sparkSession)
    plans = plans_for(distinct)
    dealt = distinct.select("key", "copies", "v", "d").repartition(n)
    sizes = (dealt.mapInArrow(_sizes(plans), "cell long, d int, n long").groupBy("cell", "d").agg(F.sum("n").alias("n"))
             .withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int")))
    # a row for each end of each projection; vectors alone at their end go no further
    sizes = written(sizes.filter("n > 1").select("cell", "d", "blocks"), "vector-ends")
    entries = dealt.mapInArrow(_entries(plans), f"cell long, d int, key long, copies long, v array<{kind}>, cells array<int>, values array<float>")
    placed = entries.join(sizes, ["cell", "d"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"tile_key": F.xxhash64("cell", "d", F.least("block", "other"), F.greatest("block", "other")),
                                 "cross": F.col("block") != F.col("other")})
    found = (placed.select("tile_key", "cell", "d", "block", "cross", "key", "copies", "v", "cells", "values")
             .repartition(n, "tile_key").sortWithinPartitions("tile_key")
             .mapInArrow(_by_tile(plans), "key long, linked long, root long"))
    found = written(found, "vector-links")
    totals = found.groupBy("key").agg(F.sum("linked").alias("linked"))
    comps = connected_components(found.select(F.col("key").alias("u"), F.col("root").alias("v")))
    named = distinct.select("key", "copies", "least").join(totals, "key", "left").join(comps.withColumnRenamed("node", "key"), "key", "left")
    named = written(named.select("key", "least", F.coalesce("root", "key").alias("root"),
                                 (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "vector-roots")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = named.join(names, "root").select("key", "n_links", "component_id")
    lone = narrow.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return narrow.filter("key is not null").join(by_key, "key").select("id", "n_links", "component_id").unionByName(lone)
