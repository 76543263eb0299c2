"""Ranked lexical search: item vocabulary tiles times document impact tiles.

Documents become rows of counts over the items' vocabulary only.  A term's
weight and a document's impact are integers, so a score is a dot product of
whole numbers: a dense tile of weights (items by terms, in float64) times a dense
tile of impacts (terms by documents) by one BLAS call.  The terms of a tile of
items are numbered compactly, and a tile has so few of them that no partial
sum reaches 2^53; partial sums are exact and add up as 64-bit integers.

Of each product a task keeps every cell that is not below its item's tenth
best so far, ties included, and cuts them by (score, document id); the tasks'
tops meet in one window per item.  Items are taken in passes of PASS_BYTES
of text, each a job over all documents, so what a task is given is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8_values, written

TOP = 10
#: Items, and terms at most, of a tile.  A document tile is an Arrow batch.
ITEM_TILE, TERM_TILE = 256, 4096
#: Bytes of item texts, about, that one pass over the documents serves.
PASS_BYTES = 32 << 20
#: No impact reaches this.
IMPACT_LIMIT = 10 ** 6
#: Letters and digits of ASCII, and all bytes of other characters, make terms; only A-Z is lower-cased.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats."""
    return (text or b"").translate(_TERM_BYTES).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _postings(vocabulary):
    """Per document its id, number of terms, and the counts of the vocabulary's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        size = len(numbers) + 1
        none = size - 1
        for batch in batches:
            lists = [[numbers.get(t, none) for t in terms(x)] for x in utf8_values(batch.column(1))]
            n = np.array([len(x) for x in lists], np.int64)
            flat = np.fromiter((t for x in lists for t in x), np.int64, int(n.sum()))
            keys, counts = np.unique(np.repeat(np.arange(len(lists)), n) * size + flat, return_counts=True)
            own = keys % size != none
            keys, counts = keys[own], counts[own]
            ends = pa.array(np.searchsorted(keys, np.arange(len(lists) + 1) * size).astype(np.int32))
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(ends, pa.array((keys % size).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))], ["id", "n", "term", "tf"])
            yield made.filter(pa.array(n > 0))

    return run


def _totals(size: int):
    """A task's sums: documents holding each term, then documents (-1) and terms (-2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(np.asarray(batch.column(1).flatten()), minlength=size)
            docs += batch.num_rows
            length += int(np.asarray(batch.column(0)).sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(held[some], [docs, length]))], ["term", "n"])

    return run


def _best(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` first of each item by score, ties by id (nulls first)."""
    order = pc.sort_indices(table, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_start")
    table = table.take(order)
    item = np.asarray(table.column("item"))
    start = np.searchsorted(item, item)
    return table.filter(pa.array(np.arange(len(item)) - start < k)).combine_chunks()


class _Tile:
    """Some items: their terms numbered compactly, and cut into parts with safe sums."""

    def __init__(self, first: int, lists: list[np.ndarray], weights: np.ndarray):
        self.first, self.n = first, len(lists)
        flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
        self.vocabulary, self.term = np.unique(flat, return_inverse=True)
        self.item = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.weight = weights[flat]
        largest = max(1, int(self.weight.max(initial=0)))
        self.width = max(1, min(TERM_TILE, (2 ** 53 - 1) // (largest * IMPACT_LIMIT)))

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """Items by documents; ``term`` numbers the pass's vocabulary."""
        out = np.zeros((self.n, docs), np.int64)
        at = np.searchsorted(self.vocabulary, term)
        own = at < len(self.vocabulary)
        own[own] = self.vocabulary[at[own]] == term[own]
        at, doc, impact = at[own], doc[own], impact[own]
        for low in range(0, len(self.vocabulary), self.width):
            wide = min(self.width, len(self.vocabulary) - low)
            mine, theirs = (self.term >= low) & (self.term < low + wide), (at >= low) & (at < low + wide)
            w, x = np.zeros((self.n, wide)), np.zeros((wide, docs))
            w[self.item[mine], self.term[mine] - low] = self.weight[mine]
            x[at[theirs] - low, doc[theirs]] = impact[theirs]
            out += (w @ x).astype(np.int64)
        return out


def _ranked(given, totals: tuple[int, int], k: int):
    """A task's best documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, weights = given.value
        n_docs, length = totals
        tiles = [_Tile(i, lists[i:i + ITEM_TILE], weights) for i in range(0, len(lists), ITEM_TILE)]
        best: list[pa.Table | None] = [None] * len(tiles)
        least = [np.ones(t.n, np.int64) for t in tiles]
        for batch in batches:
            docs = batch.num_rows
            if not docs:
                continue
            held = np.asarray(batch.column("term").value_lengths())
            doc = np.repeat(np.arange(docs), held)
            term, tf = (np.asarray(batch.column(c).flatten(), np.int64) for c in ("term", "tf"))
            m = 10 + 90 * np.asarray(batch.column("n")) * n_docs // length
            impact = 10 ** 9 * tf // (1000 * tf + 8 * m[doc])
            for i, tile in enumerate(tiles):
                score = tile.scores(doc, term, impact, docs)
                bound = least[i]
                if docs > k:
                    bound = np.maximum(bound, np.partition(score, docs - k, axis=1)[:, docs - k])
                item, at = np.nonzero(score >= bound[:, None])
                if not len(item):
                    continue
                new = pa.table({"item": pa.array(item + tile.first), "score": pa.array(score[item, at]), "id": batch.column("id").take(pa.array(at))})
                best[i] = _best(new if best[i] is None else pa.concat_tables([best[i], new]), k)
                own = np.asarray(best[i].column("item")) - tile.first
                full = np.bincount(own, minlength=tile.n) == k
                lowest = np.full(tile.n, np.iinfo(np.int64).max)
                np.minimum.at(lowest, own, np.asarray(best[i].column("score")))
                least[i] = np.where(full, lowest, least[i])
        for table in best:
            if table is not None:
                yield from table.to_batches()

    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = TOP) -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` best documents of each item with a
    score above 0, equal scores by ascending id (nulls first).

    A document row is a document, also if rows are repeated (their order is
    then free); null and empty texts have no terms and count nowhere.  Equal
    item rows are one item; rows of one item id with other texts are ranked
    apart.  An item without a known term, and either table empty: no rows.  Texts
    may be of any length.  Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = f"item {items.schema[item_col].dataType.simpleString()}, rank int, id {docs.schema[id_col].dataType.simpleString()}, score long"
    plain = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / PASS_BYTES))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(passes)))
    found = [x for i in range(passes) if (x := _search_pass(plain, asked.filter(F.col("pass") == i).select("item", "text"), k)) is not None]
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("item", "rank", "id", "score")


def _search_pass(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    rows = asked.withColumn("text", F.encode(F.col("text"), "UTF-8")).toArrow()       # about PASS_BYTES
    numbers: dict[bytes, int] = {}
    lists, kept = [], []
    for i, value in enumerate(rows.column("text")):
        own = dict.fromkeys(terms(value.as_py()))
        if own:
            lists.append(np.array([numbers.setdefault(t, len(numbers)) for t in own], np.int64))
            kept.append(i)
    if not lists:
        return None
    id_type = docs.schema["id"].dataType.simpleString()
    vocabulary = spark.sparkContext.broadcast(numbers)
    postings = written(docs.mapInArrow(_postings(vocabulary), f"id {id_type}, n long, term array<int>, tf array<int>"), "search-postings")
    sums = postings.select("n", "term").mapInArrow(_totals(len(numbers)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    sums = {r["term"]: r["n"] for r in sums}                                            # at most the vocabulary and two
    n_docs, length = sums.get(-1, 0), sums.get(-2, 0)
    if not n_docs:
        return None
    weights = np.array([weight(n_docs, sums.get(t, 0)) for t in range(len(numbers))], np.int64)
    given = spark.sparkContext.broadcast((lists, weights))
    top = postings.mapInArrow(_ranked(given, (n_docs, length), k), f"item long, score long, id {id_type}")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    top = top.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = spark.createDataFrame(pa.table({"item": pa.array(range(len(kept)), pa.int64()), "name": rows.column("item").take(pa.array(kept)).combine_chunks()}))
    return top.join(named, "item").select(F.col("name").alias("item"), "rank", "id", "score")
