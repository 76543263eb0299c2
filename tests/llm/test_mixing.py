from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerlens.llm import mixing


def docs_of(spark, sizes):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(n)), s, 7) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


SIZES = [(f"s{i % 7}", 5 + i * 13 % 90) for i in range(200)] + [("hot", 40)] * 150 + [(None, 30)] * 20 + [("s1", 0)] * 3


def brute_targets(totals):
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(totals.values()), set(order), {}
    while True:
        c = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * totals[s] <= c * weight[s]}
        if not full:
            return out | {s: c * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * totals[s]
            left -= out[s]
        open_ -= full
        if not open_:
            return out


def test_targets_and_takes(spark):
    df = docs_of(spark, SIZES)
    totals = Counter()
    for s, n in SIZES:
        totals[s] += n
    for shard_tokens in (mixing.SHARD_TOKENS, 300):
        got = mixing.mix(df, shard_tokens=shard_tokens).collect()
        want = brute_targets(totals)
        taken = defaultdict(int)
        for r in got:
            s = SIZES[r.id][0]
            assert r.size == SIZES[r.id][1] and r.source_size == totals[s] and abs(r.target - want[s]) < 1e-6
            assert 0 <= r.taken <= 2 * r.size
            assert r.taken == r.passes * r.size + sum(x.n for x in r.spans)
            taken[s] += r.taken
        for s in totals:
            assert abs(taken[s] - want[s]) <= max(16 * (1 + totals[s] // shard_tokens), 0.03 * want[s]), s
        again = {(r.id, r.taken) for r in mixing.mix(df.repartition(5), shard_tokens=shard_tokens).collect()}
        assert again == {(r.id, r.taken) for r in got}


def test_mixed_rows_hold_the_taken_words(spark):
    df = docs_of(spark, SIZES)
    plan = {r.id: r for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        own = r.text.split()
        assert own and set(own) <= {f"w{r.doc_id}x{j}" for j in range(SIZES[r.doc_id][1])}
        assert r.n_chars == 7 or r.n_chars == len(r.text)
        words[r.doc_id] += len(own)
    assert dict(words) == {i: r.taken for i, r in plan.items() if r.taken}


def test_repeated_null_and_empty(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", None), (2, None, "s"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 5 and {r.size for r in got if r.id in (2, 3)} == {0}
    assert sum(len(r.text.split()) for r in mixing.mixed(df).collect()) == sum(r.taken for r in got)
    none = spark.createDataFrame([], df.schema)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_rows_that_share_an_id_are_dealt_over_the_shards(spark):
    """A third of all rows without an id, a sixth with one id, and equal rows: no shard is hot, every row comes back."""
    rows = [(None if i % 3 == 0 else 7 if i % 6 == 1 else i, " ".join(f"w{i}x{j}" for j in range(10 + i % 5)), "s") for i in range(1200)]
    rows += [(5000, "a b c d", "s")] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    flat = df.select("source", F.col("doc_id").alias("id"), F.xxhash64("text").alias("row_hash"), F.lit(1).cast("long").alias("size"))
    keyed = mixing._keyed(flat).withColumn("shard", mixing._draw(F.lit("shard"), F.col("key")) % 20)
    per_shard = [r["count"] for r in keyed.groupBy("shard").count().collect()]
    assert len(per_shard) == 20 and max(per_shard) < 3 * 1201 / 20
    assert keyed.agg(F.sum("copies")).first()[0] == 1300
    got = mixing.mix(df, shard_tokens=500).collect()
    assert Counter((r.id, r.size) for r in got) == Counter((i, len(t.split())) for i, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) < 0.02 * total
    again = mixing.mix(df.repartition(7), shard_tokens=500).collect()
    assert Counter((r.id, r.row_hash, r.taken) for r in again) == Counter((r.id, r.row_hash, r.taken) for r in got)
    assert sum(len(r.text.split()) for r in mixing.mixed(df, shard_tokens=500).collect()) == sum(r.taken for r in got)


def brute_seats(votes, caps, seats):
    own = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min((k for k in votes if own[k] < caps[k]), key=lambda k: (-votes[k] / (2 * own[k] + 1), k), default=None)
        if best is None:
            break
        own[best] += 1
    return own


def test_sainte_lague_gives_seats_by_highest_quotient(spark):
    votes = {f"k{i:02}": v for i, v in enumerate([100.0, 100.0, 50.0, 50.0, 33.3, 7.0, 1.0, 1.0, 1.0, 1000.0, 0.5])}
    for seats in (0, 1, 2, 3, 17, 100, 995, 3000):
        for cap in (10_000, 60):
            df = spark.createDataFrame([(k, v, cap) for k, v in votes.items()], "key string, votes double, cap long")
            got = {r.key: r.quota for r in mixing.sainte_lague(df, seats).collect()}
            assert got == brute_seats(votes, dict.fromkeys(votes, cap), seats), (seats, cap)


def test_ranks_follow_code_points(spark):
    names = ["b", "a", "Z", "é", "", None, "zz", "\U0001F600"]
    got = mixing.ranked(spark.createDataFrame([(n,) for n in names], "source string")).orderBy("rank").collect()
    assert [r.source for r in got] == sorted([n for n in names if n is not None]) + [None]
    assert [r["rank"] for r in got] == list(range(len(names)))
