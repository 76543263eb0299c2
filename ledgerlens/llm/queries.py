"""The registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from ..session import shared_dir
from . import (bpe, conversation, embedding, fingerprint, htmltext, mixing, quality, rules, search, simhash, toxicity, urlfilter,
               warc)
from .common import prepare, utf8_values

#: Fixed rules of the URL query.
URL_RULES = [urlfilter.UrlRule("com/", "allow"), urlfilter.UrlRule("example.com/en/", "block"),
             urlfilter.UrlRule("www.example.com/en/", "allow"), urlfilter.UrlRule("net/es/", "block"),
             urlfilter.UrlRule("net/fr/", "block")]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(warc.with_revisits(_table(spark, sf_dir, "pages")), path)
    kept = warc.read_archive(spark, path).filter("record_type = 'response'")
    again = warc.read_archive(spark, path, payload=False).filter("record_type = 'revisit'")
    page = warc.page_id("record_id").alias("page_id")
    return kept.select(
        page, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(again.select(
        page, F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", warc.page_id("refers_to").alias("refers_to")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = htmltext.with_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, bpe.lexicon_of(docs, VOCABULARY))


def digests(docs: DataFrame, lexicon_file: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    def values(ids: pa.ListArray, decoded: pa.Array) -> list[pa.Array]:
        sizes = ids.value_lengths()
        flat, ends = np.asarray(ids.flatten(), "<u4"), np.concatenate([[0], np.cumsum(np.asarray(sizes))])
        made = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        again = [hashlib.sha256(t).hexdigest() for t in utf8_values(decoded)]
        return [sizes.cast(pa.int64()), pa.array(made, pa.string()), pa.array(again, pa.string())]

    return bpe.with_coded(docs.select("doc_id", "text"), lexicon_file, values,
                          [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint.compare_with_edits(docs, fingerprint.corpus_ranks(docs))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    fixed = conversation.repair(conversation.damaged(table))
    found = conversation.joined(table.select("conv_id").distinct(), fixed.summary, ["conv_id"], "left")
    found = conversation.joined(found, conversation.digests(fixed.rows), ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    named = [op1_simhash, op2_url_filter, op3_embedding, op4_toxicity, op5_warc, op6_quality_classifier, op7_html_text,
             op8_mixing, op9_quality_rules, op10_bpe, op11_fingerprint, op12_conversation_repair,
             op13_search]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP9_SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
win AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM rep, (VALUES (0), (1), (2)) t(d) GROUP BY rid),
m AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN cov USING (rid)),
f AS (
  SELECT *, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_symbols * 10 > n_words
    OR (length(text) - length(replace(text, '!', ''))) * 5 > n_words
    OR word_chars < n_words * 2 OR word_chars > n_words * 12
    OR (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) * 2 > word_chars
    OR n_dup_lines * 2 > len(ls)) AS kept
FROM f
"""


def _mix_draw(*cols: str) -> str:
    parts = ", ".join(f"coalesce(({c})::VARCHAR, '')" for c in cols)
    return f"('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', {parts})), 1, 13))::BIGINT"


OP8_SQL = rf"""
WITH d AS (SELECT doc_id AS id, source, len({_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
r AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
        sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM s),
k AS (SELECT max((1.5 * t - 2 * held) / open_weight) AS c FROM r, (SELECT sum(source_size)::DOUBLE AS t FROM s)
      WHERE 2 * source_size / weight >= (1.5 * t - 2 * held) / open_weight),
g AS (SELECT source, source_size, least(2.0 * source_size, weight * c) AS target FROM s, k),
p AS (SELECT d.*, source_size, target, {_mix_draw("'shard'", 'id')} % greatest(1, ceil(source_size / {mixing.SHARD_TOKENS}.0))::BIGINT AS shard,
        {_mix_draw("'order'", 'id')} AS draw FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
h AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, target * sum(size) / source_size AS votes,
        ceil(sum(size) * 2 / 16.0)::BIGINT AS cap,
        concat_ws('|', (source IS NULL)::VARCHAR, source, shard::VARCHAR) AS key FROM p GROUP BY source, shard, source_size, target HAVING sum(size) > 0),
seat AS (SELECT key, votes / (2 * n - 1) AS quotient, n FROM (SELECT key, votes, unnest(range(1, cap + 1)) AS n FROM h)),
won AS (SELECT key, count(*) AS quota FROM (
          SELECT key FROM seat QUALIFY row_number() OVER (ORDER BY quotient DESC, encode(key), n) <= (SELECT floor(sum(votes) / 16 + 0.5) FROM h)) GROUP BY key),
q AS (SELECT source, shard, shard_size, least(coalesce(quota, 0) * 16, shard_size * 2) AS tokens,
        {_mix_draw("'run'", 'source', 'shard')} % ceil(shard_size / 16.0)::BIGINT * 16 AS begin_at FROM h LEFT JOIN won USING (key)),
z AS (SELECT p.*, sum(size) OVER (PARTITION BY source, shard ORDER BY draw, id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM p),
x AS (SELECT z.id, size, source_size, target, stop, stop - size AS pos, q.shard_size AS ss, coalesce(tokens // q.shard_size, 0) AS passes,
        coalesce(tokens % q.shard_size, 0) AS n, begin_at AS b
      FROM z LEFT JOIN q ON z.source IS NOT DISTINCT FROM q.source AND z.shard = q.shard)
SELECT id AS doc_id, size, source_size, target,
  (passes * size + coalesce(greatest(least(stop, least(b + n, ss)) - greatest(pos, b), 0), 0)
    + coalesce(greatest(least(stop, greatest(b + n - ss, 0)) - pos, 0), 0))::BIGINT AS taken
FROM x
"""


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NOT NULL AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

OP3_SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM e
      WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
      ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {embedding.LIMIT}),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
  vec_id <= coalesce(c.b, vec_id) AS kept
FROM e LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


# The CRC-32 table comes from its polynomial; a state holds the least (cost, audit, rows) of reaching it.
OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), n) ORDER BY n) AS t FROM range(256) r(n)),
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
      lambda x, b: xor(x >> 8, t[xor(x & 255, b) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM conversations, crc_table),
m AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM d WHERE kind <> 0),
s AS (
  SELECT *, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prior
  FROM m),
f AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS k,
    CASE WHEN seen = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    prior IS NOT NULL AND left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS bad
  FROM s),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
-- w: the four states (nothing, s, u, a); inserts before a row or the end, then the row's own edit
w AS (
  SELECT conv_id, 0::BIGINT AS i, [{'c': 0, 'a': '', 'o': ''}, NULL, NULL, NULL]::STRUCT(c BIGINT, a VARCHAR, o VARCHAR)[] AS v FROM g
  UNION ALL
  SELECT conv_id, i, [
    CASE WHEN x[1] IS NOT NULL THEN {'c': x[1].c + 2, 'a': x[1].a || 'D', 'o': x[1].o} END,
    list_min(list_filter([
      CASE WHEN x[2] IS NOT NULL THEN {'c': x[2].c + 2, 'a': x[2].a || 'D', 'o': x[2].o} END,
      CASE WHEN x[1] IS NOT NULL AND k = 's' AND stay THEN {'c': x[1].c + e, 'a': x[1].a || 'K', 'o': x[1].o || chr(10) || role || ':' || text} END], lambda z: z IS NOT NULL)),
    list_min(list_filter(list_concat([CASE WHEN x[3] IS NOT NULL THEN {'c': x[3].c + 2, 'a': x[3].a || 'D', 'o': x[3].o} END],
      list_transform(list_filter([x[1], x[2], x[4]], lambda z: z IS NOT NULL AND k = 'u' AND stay),
        lambda z: {'c': z.c + e, 'a': z.a || 'K', 'o': z.o || chr(10) || role || ':' || text}),
      list_transform(list_filter([x[1], x[2], x[4]], lambda z: z IS NOT NULL AND stay),
        lambda z: {'c': z.c + e + 1, 'a': z.a || 'R', 'o': z.o || chr(10) || 'user:' || text})), lambda z: z IS NOT NULL)),
    list_min(list_filter([
      CASE WHEN x[4] IS NOT NULL THEN {'c': x[4].c + 2, 'a': x[4].a || 'D', 'o': x[4].o} END,
      CASE WHEN x[3] IS NOT NULL AND k = 'a' AND stay THEN {'c': x[3].c + e, 'a': x[3].a || 'K', 'o': x[3].o || chr(10) || role || ':' || text} END,
      CASE WHEN x[3] IS NOT NULL AND stay THEN {'c': x[3].c + e + 1, 'a': x[3].a || 'R', 'o': x[3].o || chr(10) || 'assistant:' || text} END], lambda z: z IS NOT NULL))]
  FROM (
    SELECT p.conv_id, f.i, f.k, f.role, f.text, coalesce(f.fault NOT IN ('blank', 'duplicate'), true) AS stay,
      CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS e,
      [v[1], v[2],
       list_min(list_filter(list_concat([v[3]], list_transform(list_filter([v[1], v[2], v[4]], lambda z: z IS NOT NULL), lambda z: {'c': z.c + 5, 'a': z.a || 'I', 'o': z.o || chr(10) || 'user:'})), lambda z: z IS NOT NULL)),
       list_min(list_filter(list_concat([v[4]], list_transform(list_filter([v[3]], lambda z: z IS NOT NULL), lambda z: {'c': z.c + 5, 'a': z.a || 'I', 'o': z.o || chr(10) || 'assistant:'}),
         list_transform(list_filter([v[1], v[2]], lambda z: z IS NOT NULL), lambda z: {'c': z.c + 10, 'a': z.a || 'II', 'o': z.o || chr(10) || 'user:' || chr(10) || 'assistant:'})), lambda z: z IS NOT NULL))] AS x
    FROM w p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1)),
b AS (
  SELECT w.conv_id, list_min(list_filter(list_concat([v[1], v[4]],
      list_transform(list_filter([v[3]], lambda z: z IS NOT NULL), lambda z: {'c': z.c + 5, 'a': z.a || 'I', 'o': z.o || chr(10) || 'assistant:'}),
      list_transform(list_filter([v[2]], lambda z: z IS NOT NULL), lambda z: {'c': z.c + 10, 'a': z.a || 'II', 'o': z.o || chr(10) || 'user:' || chr(10) || 'assistant:'})),
      lambda z: z IS NOT NULL)) AS z
  FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = g.n)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.c, 0)::BIGINT AS cost,
  coalesce(z.a, '') AS audit, sha256(substr(coalesce(z.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS all_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
c AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 10 + (90 * len(t) * n_docs) // all_terms AS m FROM d, s WHERE len(t) > 0),
x AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, doc_id, r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM x WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_embedding": OP3_SQL, "op5_warc": OP5_SQL, "op8_mixing": OP8_SQL, "op9_quality_rules": OP9_SQL,
            "op12_conversation_repair": OP12_SQL, "op13_search": OP13_SQL}
