"""One query per operator: each applies it with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.llm.common import table

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed canonical URLs are those of pages whose number is that of a document labelled toxic."""
    from sourcelens.llm.url_filter import canonical, judge_urls, url_host, url_path
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    u = F.col("url")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    number = F.regexp_extract(url_path(u), r"/([0-9]{1,18})(?:\.html)?/*$", 1)
    listed = (pages.select("url").distinct().where(number != "").withColumn("doc_id", number.cast("bigint"))
              .join(toxic, "doc_id", "left_semi").select(canonical(url_host(u), url_path(u)).alias("canon")))
    return judge_urls(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict", "listed")


def op3_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.histogram_shards import shard_documents
    out = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.topk_search import top_k
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 5, F.col("vec_id") % 50 == 0)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.secret_scan import scan_documents
    return scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from sourcelens.llm.bpe import encode_documents
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).drop("text")


def held_out(n: int, rest: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n == rest, F.lit(False))


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.crf_language import identify
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, ~held_out(5, 0)).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.pu_quality import fit_quality, learn_rows, score_quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), learn_rows)
    return score_quality(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.jaccard_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, threshold=(90, 100))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op10_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.html_content import extract_text
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.grace_dedup import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sourcelens.llm.spelling_trie import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from sourcelens.llm.cross_tokenizer import align_corpus
    return align_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_filter, op2_secret_scan, op3_histogram_shards, op4_crf_language, op5_bpe, op6_topk_search, op7_pu_quality,
                                     op8_jaccard_join, op9_decontaminate, op10_html_content, op11_grace_dedup, op12_spelling_trie,
                                     op13_cross_tokenizer)}


def oracles() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested against brute force in tests/llm."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    url_filter = rf"""
WITH p0 AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS h,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
p AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p0),
c AS (SELECT *, host || regexp_replace(path, '/+$', '') AS canon, regexp_extract(path, '/([0-9]{{1,18}})(?:\.html)?/*$', 1) AS num FROM p),
bad AS (SELECT DISTINCT canon FROM c JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) t ON t.doc_id = TRY_CAST(c.num AS BIGINT)),
r AS (SELECT * FROM (VALUES {rules}) r(verdict, h, p)),
f AS (SELECT c.page_id, r.h || r.p AS rule, r.verdict,
             row_number() OVER (PARTITION BY c.page_id ORDER BY length(r.h || r.p) DESC, r.h || r.p DESC) AS rn
      FROM c JOIN r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p))
SELECT c.page_id, c.host, c.path, f.rule, bad.canon IS NOT NULL AS listed,
       CASE WHEN f.rule IS NOT NULL THEN f.verdict WHEN bad.canon IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM c LEFT JOIN f ON f.page_id = c.page_id AND f.rn = 1 LEFT JOIN bad ON bad.canon = c.canon AND c.canon <> ''"""
    top_k = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5"""
    copies = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""
    return {"op1_url_filter": url_filter, "op6_topk_search": top_k, "op11_grace_dedup": copies}
