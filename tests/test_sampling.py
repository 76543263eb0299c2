import math

from pyspark.sql import functions as F

from conftest import txn_rows
from ledgerlens.operators import sampling


def test_balance_keeps_all_positives_and_ratio(wb):
    txn, bal = wb.txn, wb.balanced
    pos = txn.filter("isFraud = 1.0").count()
    neg = txn.filter("isFraud = 0.0").count()
    bpos = bal.filter("isFraud = 1.0").count()
    bneg = bal.filter("isFraud = 0.0").count()
    assert bpos == pos
    f = min(3 * pos / neg, 1.0)
    sigma = math.sqrt(neg * f * (1 - f))
    assert abs(bneg - neg * f) <= 4 * sigma
    assert (bpos, bneg) == (1047, 3111)          # published fixture numbers (sf0.01)


def test_split_disjoint_and_covering(wb):
    tr = {r.txn_id for r in wb.train.select("txn_id").collect()}
    te = {r.txn_id for r in wb.test.select("txn_id").collect()}
    al = {r.txn_id for r in wb.balanced.select("txn_id").collect()}
    assert not (tr & te) and (tr | te) == al
    assert (len(tr), len(te)) == (3352, 806)


def test_hash_coin_is_partition_independent(wb):
    ids = []
    for n in (1, 4, 8):
        df = sampling.balance(wb.txn.repartition(n))
        tr, _ = sampling.split_train_test(df)
        ids.append(sorted(r.txn_id for r in tr.select("txn_id").collect()))
    assert ids[0] == ids[1] == ids[2]


def test_unlisted_stratum_never_drawn(spark):
    df = txn_rows(spark, [(i, "PAYMENT", 1.0, 2.0) for i in range(50)])
    assert sampling.stratified_sample(df).count() == 0


def test_no_majority_rows_gives_ratio_zero(spark):
    df = txn_rows(spark, [(1, "PAYMENT", 1.0, 1.0), (2, "PAYMENT", 1.0, 1.0)])
    r = sampling.class_ratio(df).first()
    assert (r.n_fraud, r.n_nonfraud, r.ratio) == (2, 0, 0.0)
    assert sampling.balance(df).count() == 2


def test_empty_input(spark):
    df = txn_rows(spark, [(1, "PAYMENT", 1.0, 1.0)]).limit(0)
    r = sampling.class_ratio(df).first()
    assert r.ratio == 0.0 and sampling.balance(df).count() == 0


def test_null_and_odd_labels_fall_out_of_both_classes(spark):
    df = txn_rows(spark, [(1, "PAYMENT", 1.0, None), (2, "PAYMENT", 1.0, 2.0), (3, "PAYMENT", 1.0, 1.0),
                          (4, "PAYMENT", 1.0, 0.0)])
    c = sampling.class_counts(df).first()
    assert (c.n_fraud, c.n_nonfraud, c.n_total) == (1, 1, 4)
    assert {r.txn_id for r in sampling.balance(df).collect()} <= {3, 4}


def test_except_strict_drops_duplicates_and_train_equal_rows(spark):
    rows = [(i, "PAYMENT", 1.0, 0.0) for i in range(40)]
    df = txn_rows(spark, rows + rows)                        # every row twice
    train, test = sampling.split_except_strict(df)
    tr = {r.txn_id for r in train.collect()}
    te = [r.txn_id for r in test.collect()]
    assert len(te) == len(set(te))                           # distinct
    assert not (tr & set(te))                                # disjoint by value
    assert set(te) | tr == set(range(40))


def test_union_keeps_duplicates(spark):
    a = txn_rows(spark, [(1, "PAYMENT", 1.0, 0.0)])
    assert sampling.union_all(a, a).count() == 2


def test_native_variants_run(wb):
    n = sampling.balance_native(wb.txn).filter("isFraud = 1.0").count()
    assert n == 1047
    s = sampling.sample_by_native(wb.balanced).count()
    assert 0.7 * 4158 < s < 0.9 * 4158


def test_balance_plan_has_no_shuffle_beyond_fixture(wb):
    """The balance/split filters add no exchange of their own."""
    from ledgerlens.sources.tables import txn_frame

    base = txn_frame(wb.spark, wb.sf_dir)
    n_base = base._jdf.queryExecution().executedPlan().toString().count("Exchange")
    tr, _ = sampling.split_train_test(sampling.balance(base))
    main_plan = tr._jdf.queryExecution().executedPlan().toString()
    # the scalar subquery (class counts) carries its own copy of the fixture
    assert main_plan.count("Exchange") <= 2 * n_base + 1
    assert F is not None


def test_hash_coin_is_uniform(spark):
    from ledgerlens.functions.coin import hash_coin

    u = spark.range(0, 200000).select(hash_coin("bal42", F.col("id")).alias("u"))
    r = u.agg(F.avg("u").alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi"),
              *[F.count_if(F.col("u") < q).alias(f"q{int(q * 10)}") for q in (0.1, 0.5, 0.9)]).first()
    assert abs(r.m - 0.5) < 0.005 and r.lo >= 0.0 and r.hi < 1.0
    for q, got in ((0.1, r.q1), (0.5, r.q5), (0.9, r.q9)):
        assert abs(got / 200000 - q) < 0.005


def test_other_seed_gives_other_valid_split(wb):
    tr42, _ = sampling.split_train_test(wb.balanced, seed=42)
    tr7, te7 = sampling.split_train_test(wb.balanced, seed=7)
    a = {r.txn_id for r in tr42.select("txn_id").collect()}
    b = {r.txn_id for r in tr7.select("txn_id").collect()}
    c = {r.txn_id for r in te7.select("txn_id").collect()}
    assert a != b and not (b & c) and len(b | c) == 4158
    assert abs(len(b) / 4158 - 0.8) < 0.03


def test_training_frame_has_a_fixed_layout(spark, wb):
    from ledgerlens.plans.workbench import TRAIN_PARTITIONS, Workbench

    def layout(w):
        rows = w.balanced.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), "txn_id")
        return [(r.p, r.txn_id) for r in rows.orderBy("i").collect()]

    assert wb.balanced.rdd.getNumPartitions() == TRAIN_PARTITIONS
    other = Workbench(spark, None, wb.seed, txn=wb.txn.repartition(5, "amount"))
    assert layout(other) == layout(wb)
    other.close()
