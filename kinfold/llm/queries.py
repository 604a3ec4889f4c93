"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, cotrain, fingerprint, maxent, packing, pagediff, rlz, simhash, tokencount, topk
from .common import table

END_ID = 2
CAPACITY = 4096


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotrain.fit(docs, table(spark, sf_dir, "labels"))
    return cotrain.score(docs, model).select("doc.doc_id", "text_score", "meta_score", "quality_score", "toxic_score", "keep")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extract(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.digests(rlz.deduplicate(table(spark, sf_dir, "documents"), window=20))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0, radius=15, blocks=8)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return maxent.score(table(spark, sf_dir, "documents"), held_out)


QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_quality, op3_top_k, op4_simhash_near_duplicates, op5_byte_bpe, op6_main_text, op7_packing, op8_substring_dedup, op9_fingerprints, op10_language_model)
}
ORACLE_SQL: dict[str, str] = {
    "op3_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
 where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)
select query_id, cast(r as integer) as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored) where r <= 10""",
    "op8_substring_dedup": r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 18)) as s from w where len(ws) >= 20),
windows as (select doc_id, s, array_to_string(ws[s:s + 19], ' ') as k from starts),
seen as (select doc_id, s, row_number() over (partition by k order by doc_id, s) as r from windows),
gone as (select distinct doc_id, s + j as i from seen, (select unnest(range(20)) as j) where r > 1),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by i) as k from words anti join gone using (doc_id, i) group by doc_id)
select w.doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256 from w left join kept using (doc_id)""",
}
