"""SimHash near-duplicates: pigeonhole blocks, join on blocks, Hamming check.

A fingerprint is 64 majority votes over the XXH64 values of a text's word
shingles.  The 64 bits are split into ``max_bits + 4`` blocks: two fingerprints
that differ in at most ``max_bits`` bits agree on all but ``max_bits`` of them,
so they share one of the keys made of the remaining blocks (about 43 of 64
bits), and unrelated fingerprints hardly ever do.

Inside a key no pairs are made.  Members of a key can only differ in its free
bits, so each member that shares its key with another fingerprint is placed on
itself and on every variant with one free bit flipped.  Two fingerprints differ
in at most two bits exactly if they meet on such a variant, and all that meet
there are within two bits of each other; each is linked with the smallest, after
the Hamming check.  The rows made grow with the number of fingerprints, however
many copies a group has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from .common import free_name, met_once, with_value, written
from .components import connected_components

SEED = 42
MAX_BITS = 2
SHINGLE = 3
CHUNK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(data: bytes, k: int) -> Iterator[list[bytes]]:
    """Runs of words; each begins with the last k-1 words of the one before."""
    at, carry = 0, []
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            found = _SPACE.search(data, end)
            end = found.start() if found else len(data)
        run = carry + data[at:end].split()
        at = end
        yield run
        carry = run[-(k - 1):] if k > 1 else []


def fingerprint(data: bytes | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text (null or no words: 0)."""
    votes, n, short = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for run in _word_runs((data or b"").lower(), k):
        if len(run) < k:
            short = run
            continue
        joined = b" ".join(run)
        size = np.fromiter(map(len, run), np.int64, len(run))
        end = np.cumsum(size + 1) - 1
        hashes = [digest(joined[a:b], SEED) for a, b in zip((end - size).tolist(), end[k - 1:].tolist())]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if n == 0:
        return digest(b" ".join(short), SEED) if short else 0
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", k: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` without ``text`` and with its fingerprint as a signed long in ``out``."""
    def prints(texts: list) -> pa.Array:
        return pa.array(np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    return with_value(docs, text, prints, out, LongType(), drop_text=True)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_keys(max_bits: int) -> tuple[list[int], list[list[int]]]:
    """Key masks, and for each the one-bit flips (0 first) outside it."""
    n = max_bits + 4
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(n)]
    keep, free = [], []
    for left_out in combinations(range(n), max_bits):
        rest = sum(blocks[i] for i in left_out)
        keep.append(_signed(((1 << 64) - 1) ^ rest))
        free.append([0, *(_signed(1 << b) for b in range(64) if rest >> b & 1)])
    width = max(map(len, free))
    return keep, [f + [0] * (width - len(f)) for f in free]


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``prints(fp)``.

    Their connected components are those of all pairs within ``max_bits``
    (1 or 2) bits; pairs that the links already connect are not listed.
    """
    if max_bits not in (1, 2):
        raise ValueError("max_bits is 1 or 2")
    masks, flips = block_keys(max_bits)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("block", "key"))
    group = Window.partitionBy("block", "key")
    shared = (keyed.withColumns({"lo": F.min("fp").over(group), "hi": F.max("fp").over(group)})
              .filter("lo <> hi").select("block", "key", "fp"))
    table = F.array(*[F.array(*[F.lit(x) for x in f]) for f in flips])
    if max_bits == 1:                      # a variant of one, itself of the other
        met = shared.select("block", "key", "fp", F.explode(F.array_distinct(F.get(table, "block"))).alias("flip"))
        met = met.withColumn("spot", F.col("fp").bitwiseXOR(F.col("flip")))
        spot = Window.partitionBy("block", "key", "spot")
        met = met.withColumn("to", F.max(F.when(F.col("flip") == 0, F.col("fp"))).over(spot)).filter("to is not null")
    else:
        met = shared.select("block", "key", "fp", F.explode(F.array_distinct(F.get(table, "block"))).alias("flip"))
        met = met.withColumn("spot", F.col("fp").bitwiseXOR(F.col("flip")))
        met = met.withColumn("to", F.min("fp").over(Window.partitionBy("block", "key", "spot")))
    near = (F.col("fp") != F.col("to")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("to"))) <= max_bits)
    return met.filter(near).select(F.col("fp").alias("u"), F.col("to").alias("v")).distinct()


def _row_hash(id_col: Column, text: Column) -> Column:
    """Hash of a text that also tells a null id from any other."""
    return F.xxhash64(text, id_col.isNull())


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                   k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, text_hash, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id of the rows reachable by links.  Rows
    without words have fingerprint 0 and are linked like any other; rows with a
    null id are grouped too but never name a component (null if all ids of a
    component are null).  Repeated rows are returned as often as they come; an
    empty table gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), _row_hash(F.col(id_col), F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    rows = written(with_fingerprint(rows, "text", k), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    found = connected_components(near_links(prints.select("fp"), max_bits))
    named = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = written(named, "fingerprint-roots")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(names, "root").select("fp", "component_id", "root")
    return rows.join(by_print, "fp").select("id", "text_hash", "fp", "component_id", "root")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group.

    The row with the smallest id stays (null ids last, then by a hash of the
    text); of repeated rows with that id and text one stays.
    """
    groups = simhash_groups(docs, id_col, text, k, max_bits)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    best = groups.groupBy("root").agg(F.min(order).alias("best"))
    hashed, keyed = (free_name(docs, c) for c in ("text_hash", "id_key"))
    any_id = F.lit(0).cast(docs.schema[id_col].dataType)
    best = best.select(F.col("best.text_hash").alias(hashed), F.coalesce("best.id", any_id).alias(keyed))
    rows = docs.withColumns({hashed: _row_hash(F.col(id_col), F.col(text)), keyed: F.coalesce(F.col(id_col), any_id)})
    # rows of one id and text meet, sorted, in the join already: no further exchange or sort
    return met_once(rows.join(best, [hashed, keyed]), [hashed, keyed]).select(*[F.col(f"`{c}`") for c in docs.columns])
