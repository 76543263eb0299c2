"""Document fingerprints from statistically improbable features.

Every 32-byte window of a text has an entropy class; how often each class
occurs over all texts is counted first, and the rarer a class the lower, and
better, its rank.  Of every 32 neighbouring windows the leftmost of the best rank
wins a point (windows at either end of a text win from the places beyond it
too); windows with 8 points or more are the text's features.

A feature's 64-bit hash sets five bits of a 2,048-bit Bloom filter; after 160
features the next filter of the chain begins.  Two chains are compared by
the bits that their filters share, less those that chance lets them share,
over the most that they could share (shares within three standard deviations
of chance count as none); each filter of the smaller chain counts with its best
partner and by its number of features.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, written

WINDOW = 32
#: Neighbouring windows that compete, and the points that make a feature.
SPAN, POINTS = 32, 8
CLASSES = 1001
#: Classes below this (runs of few different bytes) say nothing about a text.
LEAST_CLASS = 100
BITS, HASHES, PER_FILTER = 2048, 5, 160
DEVIATIONS = 3.0
#: Places worked on at a time, which bounds a task's memory for long texts.
CHUNK = 1 << 17
NONE = np.int64(1) << 40

_C = np.arange(WINDOW + 1)
#: c log2 c in whole steps of 2^-24, so that equal windows have equal sums wherever they lie.
_F = np.round(np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0) * 2 ** 24).astype(np.int64)
_MOST = int(_F[WINDOW])


def entropy_classes(text: np.ndarray) -> np.ndarray:
    """The entropy class, 0 to 1000, of every window of ``text`` (uint8)."""
    n = len(text)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    # how often a byte occurs in the WINDOW - 1 before it, and in as many after it
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (text[lag:] == text[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    gain = np.diff(_F)
    first = int(_F[np.bincount(text[:WINDOW], minlength=256)].sum())
    moves = gain[before[WINDOW:]] - gain[after[:n - WINDOW]]
    sums = np.concatenate([[first], first + np.cumsum(moves)])
    return (_MOST - sums) * (CLASSES - 1) // _MOST


def _chunks(total: int) -> Iterator[tuple[int, int]]:
    for a in range(0, total, CHUNK):
        yield a, min(total, a + CHUNK)


def _laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, where each ends, and which places begin a window of one text."""
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    begins = np.ones(len(buffer), bool)
    for e, t in zip(ends.tolist(), texts):
        begins[max(e - len(t), e - WINDOW + 1):e] = False
    return buffer, ends, begins


def class_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts are in each class."""
    buffer, _, begins = _laid(texts)
    out = np.zeros(CLASSES, np.int64)
    for a, b in _chunks(max(0, len(buffer) - WINDOW + 1)):
        out += np.bincount(entropy_classes(buffer[a:b + WINDOW - 1])[begins[a:b]], minlength=CLASSES)
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, rarest first, equal counts by class; too low classes have none."""
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    ranks[:LEAST_CLASS] = NONE
    return ranks


def _selected(buffer: np.ndarray, begins: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The places of the buffer whose windows have enough points."""
    n, out = len(buffer), []
    for a, b in _chunks(n):
        # places that compete with those of [a, b); places outside a text or the buffer have no rank
        low, high = a - SPAN + 1, b + SPAN - 1
        lo, hi = max(0, low), min(high, n - WINDOW + 1)
        if hi <= lo:
            continue
        rank = np.full(high - low, NONE)
        rank[lo - low:hi - low] = np.where(begins[lo:hi], ranks[entropy_classes(buffer[lo:hi + WINDOW - 1])], NONE)
        best = rank * (1 << 20) + np.arange(len(rank))          # the leftmost of the best rank
        width = 1
        while width < SPAN:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        won = best[best < NONE << 20] & ((1 << 20) - 1)
        points = np.bincount(won, minlength=len(rank))[a - low:b - low]
        out.append(np.flatnonzero(points >= POINTS) + a)
    return np.concatenate([*out, np.zeros(0, np.int64)])


def _mixed(h: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(buffer: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows at ``places``."""
    out = np.empty(len(places), np.uint64)
    for a, b in _chunks(len(places)):
        words = buffer[places[a:b, None] + np.arange(WINDOW)].view("<u8").astype(np.uint64)
        h = np.zeros(b - a, np.uint64)
        for i in range(words.shape[1]):
            h = _mixed(h + words[:, i] + np.uint64(0x9E3779B97F4A7C15))
        out[a:b] = h
    return out


class Chains:
    """The filter chains of some texts: ``bits`` a row per filter, ``counts`` its
    features, and ``ends`` where each text's filters end."""

    def __init__(self, texts: list[bytes], ranks: np.ndarray):
        buffer, stops, begins = _laid(texts)
        places = _selected(buffer, begins, ranks)
        owner = np.searchsorted(stops, places, side="right")
        hashes = window_hashes(buffer, places)
        # a text without any such window is one feature by itself; an empty text has none
        whole = [i for i in np.flatnonzero(np.bincount(owner, minlength=len(texts)) == 0).tolist() if texts[i]]
        owner = np.concatenate([owner, np.array(whole, np.int64)])
        hashes = np.concatenate([hashes, np.array([xxhash.xxh64_intdigest(texts[i]) for i in whole], np.uint64)])
        # the first of equal features of a text, in text order
        order = np.lexsort((np.arange(len(owner)), hashes, owner))
        again = np.zeros(len(owner), bool)
        again[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
        owner, hashes = owner[~again], hashes[~again]
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
        held = np.bincount(owner, minlength=len(texts))
        filters = -(-held // PER_FILTER)
        self.ends = np.cumsum(filters)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(held) - held, held)
        row = np.repeat(self.ends - filters, held) + at // PER_FILTER
        total = int(self.ends[-1]) if len(texts) else 0
        self.counts = np.bincount(row, minlength=total)
        packed = np.zeros((total, BITS // 8), np.uint8)
        for i in range(HASHES):
            bit = (hashes >> np.uint64(11 * i) & np.uint64(BITS - 1)).astype(np.int64)
            np.bitwise_or.at(packed, (row, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
        self.bits = packed.view("<u8")
        self.set = np.bitwise_count(self.bits).sum(axis=1).astype(np.float64)

    def rows(self, i: int) -> tuple[int, int]:
        return int(self.ends[i - 1]) if i else 0, int(self.ends[i])

    def text(self, i: int) -> str:
        """``<features>:<filter in hex>`` for each filter of the chain, comma-separated."""
        a, b = self.rows(i)
        return ",".join(f"{self.counts[r]}:{self.bits[r].tobytes().hex()}" for r in range(a, b))


def _halves(a: Chains, rows: tuple[int, int], b: Chains, others: tuple[int, int]) -> float:
    """Mean over the filters of ``a``, by features, of the best overlap with one of ``b``."""
    total = 0.0
    for r in range(*rows):
        best = 0.0
        for low in range(others[0], others[1], 4096):
            s = slice(low, min(others[1], low + 4096))
            shared = np.bitwise_count(a.bits[r] & b.bits[s]).sum(axis=1)
            few, many = np.minimum(a.set[r], b.set[s]), np.maximum(a.set[r], b.set[s]) / BITS
            chance = few * many
            told = shared > chance + DEVIATIONS * np.sqrt(chance * (1 - many))
            best = max(best, float(np.where(told, (shared - chance) / (few - chance), 0.0).max()))
        total += int(a.counts[r]) * best
    return total / int(a.counts[rows[0]:rows[1]].sum())


def likeness(a: Chains, i: int, b: Chains, j: int) -> float:
    """0 to 1: how much of the chain with fewer features the other one holds; chains
    of as many features count both ways.  Two empty texts are alike."""
    mine, theirs = a.rows(i), b.rows(j)
    n, m = int(a.counts[slice(*mine)].sum()), int(b.counts[slice(*theirs)].sum())
    if not n or not m:
        return float(n == m)
    if n < m:
        return _halves(a, mine, b, theirs)
    if m < n:
        return _halves(b, theirs, a, mine)
    return (_halves(a, mine, b, theirs) + _halves(b, theirs, a, mine)) / 2


# ---------------------------------------------------------------- over tables
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES, np.int64)
    for batch in batches:
        for group in _groups(batch.column(0)):
            counts += class_counts(group)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(counts)], ["class", "n"])


def _groups(column: pa.Array, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The column's texts in UTF-8, some ``most`` bytes at a time."""
    held, size = [], 0
    for value in column:
        held.append((value.as_py() or "").encode())
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def corpus_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of the entropy classes over all texts of ``docs``: the parameter that
    makes fingerprints comparable (null and short texts have no windows)."""
    rows = docs.select(text).mapInArrow(_counted, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES, np.int64)
    for r in rows:
        counts[r["class"]] = r["n"]
    return ranks_of(counts)


def _place(key: Column, bounds: Column) -> Column:
    """Number of the sorted ``bounds`` after the first that are not above ``key``, in halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in range(24, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step < F.size(bounds)) & (F.get(bounds, at + step) <= key), at + step).otherwise(at))


def in_id_order(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(part, guest, id, text)``: rows dealt to parts by id order and sorted in them,
    each part followed by the next part's first row (``guest``), the last one by the very first.

    The bounds come from a sort of narrow rows (id and a hash of the text); the
    texts move once.  Null ids come first, equal ids by the hash.
    """
    n = parts(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select(F.struct("id", F.xxhash64("text").alias("tie")).alias("key"), "text")
    keys = written(rows.select("key.id", "key.tie").repartitionByRange(n, "id", "tie").withColumn("part", F.spark_partition_id()), "order-keys")
    first = keys.groupBy("part").agg(F.min(F.struct("id", "tie")).alias("key"))            # a row a part
    bounds = first.agg(F.array_sort(F.collect_list("key")).alias("bounds")).scalar()
    placed = rows.withColumn("bounds", bounds)
    placed = placed.withColumn("part", _place(F.col("key"), F.col("bounds")))
    heads = F.get("bounds", F.col("part")) == F.col("key")
    before = F.when(F.col("part") > 0, F.col("part") - 1).otherwise(F.size("bounds") - 1)
    to = F.array(F.struct(F.col("part"), F.lit(False).alias("guest")))
    to = F.when(heads, F.concat(to, F.array(F.struct(before.alias("part"), F.lit(True).alias("guest"))))).otherwise(to)
    dealt = placed.withColumn("to", F.explode(to)).select("to.part", "to.guest", "key", "text")
    return (dealt.repartitionById(n, "part").sortWithinPartitions("part", "guest", "key")
            .select("part", "guest", F.col("key.id").alias("id"), "text"))


def edited(text: str, following: str) -> str:
    """The last half of the text's code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None           # part, guest, id and text of the row before
        for batch in batches:
            ids, guests, where = batch.column("id"), batch.column("guest").to_pylist(), batch.column("part").to_pylist()
            at = 0
            for group in _groups(batch.column("text")):
                rows = [(where[at + i], guests[at + i], ids[at + i], t) for i, t in enumerate(group)]
                at += len(group)
                if held is not None:
                    rows.insert(0, held)
                held = rows[-1]
                made = _rows(rows, ranks, ids.type)
                if made is not None:
                    yield made

    return run


_COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _rows(rows: list[tuple], ranks: np.ndarray, kind: pa.DataType) -> pa.RecordBatch | None:
    """Results of all rows but the last one; guests have none."""
    pick = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
    if not pick:
        return None
    texts = [r[3].decode() for r in rows]
    changed = [edited(texts[i], texts[i + 1]).encode() for i in pick]
    own, other = Chains([r[3] for r in rows], ranks), Chains(changed, ranks)
    return pa.RecordBatch.from_arrays([
        pa.array([rows[i][2].as_py() for i in pick], kind), pa.array([len(texts[i]) for i in pick], pa.int64()),
        pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()), pa.array([own.text(i) for i in pick], pa.string()),
        pa.array([other.text(j) for j in range(len(pick))], pa.string()),
        pa.array([likeness(own, i, other, j) for j, i in enumerate(pick)], pa.float64()),
        pa.array([likeness(own, i, own, i + 1) for i in pick], pa.float64())], list(_COLUMNS))


def compare_with_edits(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row of ``docs`` its fingerprint, that of its edited text, and its likeness
    to this and to the next row's (see :func:`edited`; after the last row comes the first).

    Null texts are empty; an empty text's fingerprint is empty; a single row is
    its own next.  Rows come in id order, null ids first, equal ids by a hash of their texts;
    repeated rows follow each other.  An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return in_id_order(docs, id_col, text).mapInArrow(
        _compared(ranks), f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                          "near_edited double, near_next double")


def fingerprints(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fingerprint)`` of every row; null texts are empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1)):
                chains = Chains(group, ranks)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)),
                                                  pa.array([chains.text(i) for i in range(len(group))], pa.string())], ["id", "fingerprint"])
                at += len(group)

    return docs.select(id_col, text).mapInArrow(run, f"id {kind}, fingerprint string")
