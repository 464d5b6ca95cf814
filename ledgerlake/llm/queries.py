"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontam, exact_dedup, html_extract, line_dedup, mixing, quality, sharding, simhash, spelling, substring_dedup, toxicity, url_filter, whitening
from ledgerlake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn
    return add


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query()
def op1_url_ngram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH cut AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.?\x{3002}\n]*[.?\x{3002}\n]+|[^.?\x{3002}\n]+') AS p FROM documents WHERE text IS NOT NULL)),
normal AS (
  SELECT doc_id, pos, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) AS e,
         trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS u FROM cut),
ranked AS (
  SELECT doc_id, pos, e - length(piece) AS s, e, u, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r,
         CASE WHEN length(u) > 16 * len(string_split(u, ' ')) THEN length(u) // 5 ELSE len(string_split(u, ' ')) END AS n
  FROM normal WHERE u <> ''),
placed AS (SELECT *, first_value(doc_id) OVER w AS fd, first_value(r) OVER w AS fr, row_number() OVER w AS k FROM ranked WINDOW w AS (PARTITION BY u ORDER BY doc_id, r)),
again AS (
  SELECT *, CASE WHEN lag(r) OVER w = r - 1 AND lag(fr) OVER w = fr - 1 AND lag(fd) OVER w = fd THEN 0 ELSE 1 END AS new
  FROM placed WHERE k > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY r)),
marked AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY r) AS run FROM again),
runs AS (
  SELECT doc_id, min(s) AS s, max(e) AS e, min(pos) AS a, max(pos) AS z, count(*) AS pieces, min(fd) AS fd
  FROM marked GROUP BY doc_id, run HAVING sum(n) >= 30),
per_doc AS (
  SELECT doc_id, CAST(sum(pieces) AS BIGINT) AS n_removed, string_agg(CAST(s AS VARCHAR) || '-' || CAST(e AS VARCHAR), ',' ORDER BY s) AS removed, min(fd) AS dup_of
  FROM runs GROUP BY doc_id),
remaining AS (
  SELECT c.doc_id, string_agg(c.piece, '' ORDER BY c.pos) AS text FROM cut c JOIN per_doc USING (doc_id)
  WHERE NOT EXISTS (SELECT 1 FROM runs x WHERE x.doc_id = c.doc_id AND c.pos BETWEEN x.a AND x.z) GROUP BY c.doc_id)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, dup_of,
       CASE WHEN p.doc_id IS NULL THEN d.text ELSE coalesce(x.text, '') END AS text
FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN remaining x USING (doc_id)
"""


@query(OP2_SQL)
def op2_line_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(documents(spark, sf_dir))
    return found.select("doc_id", "n_removed", "removed", "dup_of", "text")


@query()
def op3_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_removed", "removed", "dup_of", "text")


@query()
def op4_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mixing.plan(documents(spark, sf_dir))
    return (units.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")))


@query()
def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir), keys_only=True)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


OP6_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


@query(OP6_SQL)
def op6_stateful_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query()
def op7_gph_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 13) AS l FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i + l - 1], ' '))) AS k FROM bl),
dk AS (SELECT doc_id, l, list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i + l - 1], ' ')) AS ks
       FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l),
dw AS (SELECT doc_id, l, unnest(ks) AS k, generate_subscripts(ks, 1) AS i FROM dk),
hits AS (SELECT doc_id, i, l, item_id FROM dw JOIN win USING (l, k)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hits)) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
                     sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query(OP8_SQL)
def op8_ngram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), decontam.n_hit().alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), decontam.is_contaminated().alias("contaminated"))


@query()
def op9_gbt_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query()
def op10_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query()
def op11_histogram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(documents(spark, sf_dir))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query()
def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whiten(vectors, "embedding", components=16)
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
