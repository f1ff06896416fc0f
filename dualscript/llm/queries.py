"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.llm import (
    byte_bpe, embedding_dedup, html_crf, language_id, line_dedup, ngram_join, packing, piece_bpe, quality_rules,
    spelling, token_counts, turn_repair, warc,
)
from dualscript.session import ship_package

PACKER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, others = token_counts.pieces_of(public_tokenizers.path(PIECES))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), starts, others)


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    return language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, language_model(docs))
    return out.select(F.col("_id").alias("doc_id"), language_id.held_out(F.col("_id")).alias("held_out"),
                      "lang_pred", "score", "rejected")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKER))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.shared_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.learn(pages))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_rules.judge(docs, quality_rules.learn(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


DAMAGE = 31


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), damage=DAMAGE).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of conversations with faults, dealt by a checksum of each row's place."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(place.cast("binary")), F.lit(20))
    plain = conversations.select("conv_id", "turn", kind.alias("_kind"),
                                 *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    return plain.where("_kind <> 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    out = turn_repair.report(*turn_repair.repair(damaged(conversations)))
    all_ = conversations.select("conv_id").distinct()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_.join(out, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_language_id, op3_best_fit_packing, op4_byte_bpe, op5_line_dedup, op6_ngram_jaccard_join,
    op7_warc, op8_embedding_near_dedup, op9_html_extraction, op10_quality_rules, op11_spelling_variants,
    op12_sentencepiece, op13_turn_repair)}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op5_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_WHITE}), {_AZ}) AS line_key FROM l),
s AS (SELECT line_key, max(doc_id) AS keeper FROM k WHERE length(line_key) >= 40
      GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, s.line_key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone
      FROM k LEFT JOIN s ON k.line_key = s.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id""",
    "op6_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT rid, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.rid <> b.rid GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * common >= 75 * (a.n + b.n - common)),
r AS (SELECT rid, rid AS node FROM w UNION SELECT r.rid, e.y FROM r JOIN e ON e.x = r.node)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(v.doc_id) AS component_id
FROM r JOIN w ON w.rid = r.rid JOIN w v ON v.rid = r.node LEFT JOIN n ON n.rid = r.rid GROUP BY r.rid, w.doc_id""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS b FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p WHERE b >= 1000 GROUP BY h)
SELECT page_id, b AS payload_bytes, sha1(p.h) AS payload_digest,
  CASE WHEN k.h IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k.h IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM p LEFT JOIN k ON p.h = k.h""",
    "op8_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT rid, rid AS node FROM v UNION SELECT r.rid, l.y FROM r JOIN l ON l.x = r.node),
c AS (SELECT r.rid, min(v.vec_id) AS component_id FROM r JOIN v ON v.rid = r.node GROUP BY r.rid)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.x = v.rid) AS n_links, component_id,
  v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c ON c.rid = v.rid""",
}
