import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.llm import rules

CLEAN = " ".join(f"word{i} and thing{i}" for i in range(40))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tri = list(zip(words, words[1:], words[2:]))
    n = Counter(tri)
    covered = {i + d for i, t in enumerate(tri) if n[t] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x " * 500, "a b c d a b c e a b c", "l\nl\n \nl\nm",
             "é€😀 #|<> \x85 \xa0", CLEAN, CLEAN + " " + CLEAN, " ".join(str(i % 37) for i in range(3000)), "\n".join(["same line"] * 9)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, "a", "clash")]
    df = rules.with_measures(spark.createDataFrame(rows, "doc_id long, text string, w_words string"))
    got = {(r.doc_id): (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()}
    assert df.count() == len(rows)
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_verdicts_do_not_depend_on_the_order_of_the_rules(spark):
    texts = [CLEAN, CLEAN.upper() + " OK" * 9, "## " * 60 + CLEAN, "short", None, CLEAN.replace(" ", "! ")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a = {r.doc_id: r.kept for r in rules.quality_rules(df).collect()}
    b = {r.doc_id: r.kept for r in rules.quality_rules(df, rules=rules.DEFAULT_RULES[::-1]).collect()}
    assert a == b == {0: True, 1: False, 2: False, 3: False, 4: False, 5: False}
    assert {r.doc_id for r in rules.passing(df).collect()} == {0}


def test_order_is_by_rejections_per_cost(spark):
    df = spark.createDataFrame([(i, "## " * 60 if i % 2 else CLEAN) for i in range(20)], "doc_id long, text string")
    found = rules.rule_order(df)
    value = [x["rejects"] / x["cost"] for x in found]
    assert value == sorted(value, reverse=True) and found[0]["rule"].name in ("symbols", "short_words")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rules.quality_rules(df).count() == 0 and rules.passing(df).count() == 0


def test_long_text_filtered_in_linear_work(spark):
    text = " ".join(f"w{i % 9973}" for i in range(60000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = rules.quality_rules(df).filter(F.col("base_failed")).first()
    assert row.n_repeat_words == 60000
