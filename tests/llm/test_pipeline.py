import sys

sys.path.insert(0, ".")
import corpus_pipeline  # noqa: E402
from ledgerlens.llm import mixing, quality, rules, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).cache()
        n = out.count()
        if i < 4:
            assert out.columns == docs.columns, name
        if name == "quality_rules":
            kept = {r.doc_id for r in rules.quality_rules(docs).filter("kept").collect()}
            assert {r.doc_id for r in out.collect()} == kept and n < docs.count()
        if name == "quality_classifier":
            model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert n == quality.with_score(docs, model).filter("score >= 0.3").count()
        if name == "near_dedup":
            groups = simhash.simhash_groups(docs)
            assert n == groups.select("component_id").distinct().count()
            assert {r.doc_id for r in out.collect()} == {r.component_id for r in groups.collect()}
        if name == "mix_sources":
            want = mixing.mix(docs).agg({"taken": "sum"}).first()[0]
            assert sum(len(r.text.split()) for r in out.collect()) == want
        if name == "token_ids":
            assert n == docs.count()
        docs = out


def test_run_equals_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def odd_docs(spark, ids):
    """Null and repeated ids, null and empty texts and sources, repeated rows, a long text, columns with clashing names."""
    text = "One two three four five six seven eight nine ten. " * 12
    rows = [(None, text, "en", "a"), (1, text + "x", "en", None), (1, text + "x", "en", None), (2, None, None, "b"), (3, "", "en", "b"),
            (4, "word and another one here. " * 4000, "en", "a"), (5, text.replace("two", "zwei"), "de", "c"), (6, text + "y", "en", "c")]
    docs = spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, "z", 2.0) for i, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, id int, take string, score double")
    return docs.withColumn("doc_id", docs.doc_id.cast(ids))


def test_stages_take_odd_rows_and_any_id(spark):
    for ids in ("long", "string"):
        docs = odd_docs(spark, ids)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert i == 4 or out.columns == docs.columns, name
            assert dict(out.dtypes)["doc_id"] == dict(docs.dtypes)["doc_id"], name
            if name in ("near_dedup", "token_ids"):      # the other stages may drop any of them
                assert rows, name
            assert stage(spark, docs.limit(0), SF).count() == 0, name
