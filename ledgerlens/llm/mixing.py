"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source gets a token target (its weight's share of the mix, at most
``max_epochs`` times its size, the excess reshared).  Its documents are dealt by
a seeded hash into shards of bounded size; the targets, divided over the shards,
are the votes of one Sainte-Lague apportionment of equal-token blocks by highest
quotients, which gives each shard an integer quota.  A shard takes its quota as
full passes over its documents plus a seeded run of consecutive blocks of the
shuffled token stream, so nearly all documents are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, met_once, n_words_of, parts, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCK_TOKENS = 16
SHARD_TOKENS = 2_000_000
SEED = 42
GRID = 32


def _draw(*cols: Column | str) -> Column:
    """A seeded number below 2**52, equal in every engine that has MD5."""
    texts = [F.coalesce(c.cast("string") if isinstance(c, Column) else F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(SEED)), *texts)), 1, 13), 16, 10).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by ``source`` in code-point order, null last.

    Range-partitioned and numbered within partitions; only the row counts of
    the partitions reach the driver.
    """
    spread = sources.repartitionByRange(parts(sources.sparkSession), F.col("source").asc_nulls_last())
    spread = written(spread.withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = {r.part: r.n for r in spread.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(counts):
        offsets += [F.lit(part), F.lit(before)]
        before += counts[part]
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    start = F.element_at(F.create_map(*offsets), F.col("part")) if offsets else F.lit(0)
    return spread.withColumn("rank", own + start).drop("part")


def with_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources(source, source_size)`` with the token ``target`` of each.

    target = min(max_epochs * source_size, c * weight), with c such that the
    targets add up to ``share`` of all tokens: weights share the total, those
    above their limit stop there, and the excess is reshared by weight until
    none is above.
    """
    by_rank = F.array(*[F.lit(float(w)) for w in weights])
    table = written(ranked(sources).withColumn("weight", F.get(by_rank, (F.col("rank") % len(weights)).cast("int"))), "mix-weights")
    limit = F.col("source_size") * float(max_epochs)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    left, c, stopped = min(share, max_epochs) * total, 0.0, -1
    while True:
        # with none stopped yet c is the plain share; sources above their limit stop and the rest share what is left
        full = limit <= F.col("weight") * c if c else F.lit(False)
        n, held, open_weight = table.agg(
            F.sum(full.cast("int")), F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if not open_weight or n == stopped:
            break
        stopped, c = n, (left - held) / open_weight
    return table.withColumn("target", F.least(limit, F.col("weight") * c) if c else F.lit(0.0)).drop("weight", "rank")


def sainte_lague(parties: DataFrame, seats: int, votes: str = "votes", cap: str = "cap", key: str = "key") -> DataFrame:
    """``parties`` with ``quota``: ``seats`` given one by one to the highest
    quotient votes / (2 * own seats + 1), none beyond its ``cap``.

    A seat k goes to a party if votes / (k - 1/2) reaches a common divisor, so
    the divisor is bracketed with one aggregation per GRID candidates, and only
    the seats whose quotients lie inside the last bracket are listed and
    ordered (ties by ``key``).  If the caps allow fewer seats, all are given.
    """
    def quota(divisor) -> Column:
        return F.least(F.col(cap), F.floor(F.col(votes) / divisor + 0.5)).cast("bigint")

    total, most, room = parties.agg(F.coalesce(F.sum(votes), F.lit(0.0)), F.coalesce(F.max(votes), F.lit(0.0)),
                                    F.coalesce(F.sum(cap), F.lit(0))).first()
    if seats <= 0 or total <= 0:
        return parties.withColumn("quota", F.lit(0).cast("bigint"))
    if room <= seats:
        return parties.withColumn("quota", F.when(F.col(votes) > 0, F.col(cap)).otherwise(0).cast("bigint"))
    guess = total / seats
    low, high = guess / 2, guess * 2          # seats at low >= seats > seats at high
    at_low = at_high = None
    while at_low is None or at_high is None:
        at_low, at_high = parties.agg(F.sum(quota(F.lit(low))), F.sum(quota(F.lit(high)))).first()
        if at_low < seats:
            low, at_low = low / 16, None
        if at_high >= seats:
            high, at_high = high * 16, None
    for _ in range(40):
        if at_low - seats <= 1000 or (high - low) <= low * 1e-15:
            break
        grid = [low + (high - low) * i / GRID for i in range(1, GRID)]
        got = list(parties.agg(*[F.sum(quota(F.lit(d))) for d in grid]).first())
        for d, n in zip(grid, got):
            if n >= seats and d > low:
                low, at_low = d, n
            if n < seats:
                high, at_high = d, n
                break
    sure = parties.withColumns({"sure": quota(F.lit(high)), "most": quota(F.lit(low))})
    if at_low == seats:
        return sure.withColumn("quota", F.col("most")).drop("sure", "most")
    rest = sure.filter("most > sure").select(F.col(key).alias("k"), F.col(votes).alias("v"), F.explode(F.sequence(F.col("sure") + 1, "most")).alias("seat"))
    won = (rest.orderBy((F.col("v") / (F.col("seat") * 2 - 1)).desc(), "k", "seat").limit(seats - at_high)
           .groupBy("k").agg(F.count("*").alias("won")))
    joined = sure.join(won, F.col(key) == F.col("k"), "left")
    return joined.withColumn("quota", F.col("sure") + F.coalesce("won", F.lit(0))).drop("sure", "most", "k", "won")


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``key`` that they are dealt by and their ``copies``.

    A row alone with its id is dealt by the id.  Rows that share an id, or have
    none, are dealt by their contents as well, so that no id is a hot shard; equal
    ones become one row that stands for its copies, added up before any shuffle.
    """
    alone = rows.withColumns({"key": F.col("id").cast("string"), "copies": F.lit(1).cast("long")})
    many = written(rows.filter("id is not null").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
                   .select(F.col("id").alias("many")), "mix-repeated")
    nameless = rows.filter("id is null")
    if many.isEmpty() and nameless.isEmpty():
        return alone
    met = rows.filter("id is not null").join(many, F.col("id") == F.col("many"), "left")
    shared = met.filter("many is not null").drop("many").unionByName(nameless)
    shared = shared.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    shared = shared.withColumn("key", F.concat_ws("#", F.col("id").cast("string"), F.col("row_hash").cast("string"), F.col("size").cast("string")))
    alone = met.filter("many is null").select(*rows.columns, F.col("id").cast("string").alias("key"), F.lit(1).cast("long").alias("copies"))
    return written(alone.unionByName(shared), "mix-keyed")


def mix(docs: DataFrame, source: str = "source", text: str = "text", id_col: str = "doc_id", weights=WEIGHTS,
        share: float = SHARE, max_epochs: int = MAX_EPOCHS, block_tokens: int = BLOCK_TOKENS,
        shard_tokens: int = SHARD_TOKENS, row_hash: Column | None = None) -> DataFrame:
    """Every row of ``docs`` as ``(id, row_hash, size, source_size, target, taken, passes, spans)``.

    ``size`` words; ``source_size`` and ``target`` of its source; ``taken``
    words, at most ``max_epochs * size``; ``passes`` whole copies; ``spans``, an
    array of ``(start, n)`` word ranges of one further copy taken in part.  Null
    texts have size 0 and are never taken; a null source is a source of its own;
    an empty table gives an empty result; other columns are not read.  Order
    inside a shard is by a seeded hash of the id; rows that share an id, or have
    none, are dealt and ordered by ``row_hash`` (of the text, if not given) as
    well, and equal rows lie next to each other.
    """
    rows = written(docs.select(F.col(source).alias("source"), F.col(id_col).alias("id"),
                               (F.xxhash64(F.col(text)) if row_hash is None else row_hash).alias("row_hash"),
                               n_words_of(F.col(text)).alias("size")), "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(with_targets(by_source, weights, share, max_epochs), "mix-targets")

    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens)).cast("bigint")
    dealt = _keyed(rows).join(targets.withColumnRenamed("source", "to"), F.col("source").eqNullSafe(F.col("to"))).drop("to")
    dealt = dealt.withColumn("shard", _draw(F.lit("shard"), F.col("key")) % shards)
    held = F.col("size") * F.col("copies")
    sizes = dealt.groupBy("source", "shard", "source_size", "target").agg(F.sum(held).alias("shard_size")).filter("shard_size > 0")
    sizes = written(sizes.withColumns({
        "votes": F.col("target") * F.col("shard_size") / F.col("source_size"),
        "cap": F.ceil(F.col("shard_size") * max_epochs / block_tokens).cast("bigint"),
        "key": F.concat_ws("|", F.col("source").isNull().cast("string"), "source", F.col("shard").cast("string"))}), "mix-shards")
    wanted = sizes.agg(F.sum("votes")).first()[0] or 0.0
    quotas = sainte_lague(sizes, int(wanted / block_tokens + 0.5))
    quotas = written(quotas.select(
        F.col("source").alias("to"), F.col("shard").alias("to_shard"), "shard_size",
        F.least(F.col("quota") * block_tokens, F.col("shard_size") * max_epochs).alias("tokens"),
        (_draw(F.lit("run"), F.col("source"), F.col("shard")) % F.ceil(F.col("shard_size") / block_tokens) * block_tokens).alias("begin")),
        "mix-quotas")

    stream = Window.partitionBy("source", "shard").orderBy("draw", "id", "size", "row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("draw", _draw(F.lit("order"), F.col("key"))).withColumn("end", F.sum(held).over(stream))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    placed = placed.withColumn("at", F.col("end") - F.col("size") * F.col("copy")).withColumn("end", F.col("at") + F.col("size"))
    out = placed.join(quotas, F.col("source").eqNullSafe(F.col("to")) & (F.col("shard") == F.col("to_shard")), "left")
    none = F.lit(0).cast("bigint")
    length = F.coalesce(F.col("tokens") % F.col("shard_size"), none)
    # the run [begin, begin + length) goes round the end of the stream
    tail = _overlap(F.col("at"), F.col("end"), F.col("begin"), F.least(F.col("begin") + length, F.col("shard_size")))
    head = _overlap(F.col("at"), F.col("end"), none, F.greatest(F.col("begin") + length - F.col("shard_size"), none))
    out = out.withColumns({"passes": F.coalesce(F.floor(F.col("tokens") / F.col("shard_size")), none), "head": head, "tail": tail,
                           "tail_at": F.greatest(F.col("begin") - F.col("at"), none)})
    spans = F.filter(F.array(F.struct(none.alias("start"), F.col("head").alias("n")),
                             F.struct(F.col("tail_at").alias("start"), F.col("tail").alias("n"))), lambda s: s["n"] > 0)
    return out.select("id", "row_hash", "size", "source_size", "target",
                      (F.col("passes") * F.col("size") + F.col("head") + F.col("tail")).alias("taken"),
                      "passes", spans.alias("spans"))


def _overlap(a: Column, b: Column, start: Column, stop: Column) -> Column:
    return F.coalesce(F.greatest(F.least(b, stop) - F.greatest(a, start), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))


def mixed(docs: DataFrame, source: str = "source", text: str = "text", id_col: str = "doc_id",
          length: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as many times as it
    is taken whole, and once more with the words of a part taken in part
    (``length``, if it is a column, is then counted anew).

    The plan is made on narrow rows; the texts are shuffled once, to meet it.
    """
    names = docs.columns
    hashed, keyed, mark, whole, part = (free_name(docs, c) for c in ("row_hash", "id_key", "take", "whole", "part"))
    any_id = F.lit(0).cast(docs.schema[id_col].dataType)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    plan = mix(docs, source, text, id_col, row_hash=row_hash, **options).filter("taken > 0")
    some = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    plan = plan.withColumns({"whole": F.col("passes") + (some == F.col("size")).cast("bigint"),
                             "part": F.when((some > 0) & (some < F.col("size")), F.col("spans"))})
    # equal rows lie next to each other in one shard: at most its run's ends are parts
    plan = plan.groupBy(F.col("row_hash").alias(hashed), F.coalesce("id", any_id).alias(keyed)).agg(
        F.sum("whole").alias(whole), F.collect_list("part").alias(part))
    rows = docs.withColumns({hashed: row_hash, keyed: F.coalesce(F.col(f"`{id_col}`"), any_id)})
    met = met_once(rows.join(plan, [hashed, keyed]), [hashed, keyed])
    empty = F.array().cast(plan.schema[part].dataType.elementType)
    takes = F.concat(F.array_repeat(empty, F.col(whole).cast("int")), F.col(part))
    met = met.select(*[F.col(f"`{c}`") for c in names], F.explode(takes).alias(mark))
    # a word with the white space before it
    pieces = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.ltrim(F.array_join(F.flatten(F.transform(
        mark, lambda s: F.slice(pieces, s["start"].cast("int") + 1, s["n"].cast("int")))), ""))
    # a column of its own, so that text and length are made from the same cut
    met = met.withColumn(part, F.when(F.size(mark) > 0, cut))
    changed = {text: F.coalesce(part, F.col(f"`{text}`"))}
    if length in names:
        changed[length] = F.when(F.col(part).isNotNull(), F.length(part).cast(docs.schema[length].dataType)).otherwise(F.col(f"`{length}`"))
    return met.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in names])
