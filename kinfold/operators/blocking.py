"""Candidates by shared keys: weighted sums of key matches and the best of each query record.

Hot keys are settled before the join, by a grouped count or a limited rank, so
that no key has more than `cap` records on the candidates' side. Keys that a record
has several times are counted first and multiplied after the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as C
from ..sources.staging import stored
from .keys import V1, Blocking, blocking_keys, token_vocabulary
from .preprocess import DERIVED, preprocess


#: Pairs of keys' matches that a task adds up.
PAIRS = 1 << 21


def source_of(entity_id: Column) -> Column:
    return F.when(entity_id.startswith("S2"), "S2").when(entity_id.startswith("S3"), "S3").otherwise("other")


def key_histogram(keys: DataFrame) -> DataFrame:
    """key, n: how many entries each key has."""
    return keys.groupBy("key").agg(F.count("*").alias("n"))


def hot_keys(keys: DataFrame, cap: int) -> DataFrame:
    """Keys that reach the cap, with their counts."""
    return key_histogram(keys).where(F.col("n") >= cap)


def postings(keys: DataFrame, config: Blocking) -> DataFrame:
    """key, candidate_id, times, length (entries that the key has after the cap)."""
    if config.profile == "v2":
        first = Window.partitionBy("key").orderBy(source_of(F.col("entity_id")), "entity_id", "pos")
        kept = keys.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= config.cap)
        counts = key_histogram(keys).withColumn("n", F.least("n", F.lit(config.cap)))
    else:
        kept, counts = keys, key_histogram(keys).where(F.col("n") < config.cap)
    bags = kept.groupBy("key", F.col("entity_id").alias("candidate_id")).agg(F.count("*").alias("times"))
    return bags.join(counts, "key").select("key", "candidate_id", "times", F.col("n").alias("length"))


def _steps(n: Column, table) -> Column:
    out = F.lit(table[-1][1])
    for most, value in reversed(table[:-1]):
        out = F.when(n <= most, value).otherwise(out)
    return out


def discounts(matches: DataFrame, config: Blocking, vocabulary: DataFrame | None) -> DataFrame:
    """key, length, discount: of distinct keys with the lengths of their postings. matches: key, length."""
    distinct = matches.select("key", "length").distinct()
    if config.profile == "v1":
        return distinct.withColumn("discount", F.lit(1.0))
    if vocabulary is None or config.profile == "v2_disk":
        return distinct.withColumn("discount", _steps(F.col("length"), C.LOCAL_DISCOUNTS))
    kind = F.substring_index("key", ":", 1)
    parts = F.split(F.expr("substring(key, length(substring_index(key, ':', 1)) + 2)"), "_")
    single = kind == "b_tok"
    named = distinct.withColumn("kind", kind).withColumn("t0", F.when(single, F.array_join(parts, "_")).otherwise(parts[0])).withColumn("t1", F.when(~single, F.get(parts, F.lit(1))))
    counted = named
    for t in ("t0", "t1"):
        counted = counted.join(vocabulary.select(F.col("token").alias(t), F.col("n").alias(f"n_{t}")), t, "left").withColumn(f"n_{t}", F.coalesce(f"n_{t}", "length"))
    value = F.lit(1.0)
    for name, (which, table) in C.DISCOUNTS.items():
        n = {"first": F.col("n_t0"), "least": F.least("n_t0", "n_t1"), "greatest": F.greatest("n_t0", "n_t1")}[which]
        value = F.when(F.col("kind") == name, _steps(n, table)).otherwise(value)
    return counted.select("key", "length", value.alias("discount"))


def score_pairs(queries: DataFrame, keys: DataFrame, config: Blocking = V1, vocabulary: DataFrame | None = None) -> DataFrame:
    """s1_id, candidate_id, score: all pairs that share a key. queries, keys: blocking_keys() of both sides."""
    weights = C.KEY_WEIGHTS["v1" if config.profile == "v1" else "v2"]
    weight = F.coalesce(*[F.when(F.col("tag") == t, w) for t, w in weights.items()])
    asked = queries.groupBy("key", "tag", F.col("entity_id").alias("s1_id")).agg(F.count("*").alias("asked"))
    found = postings(keys, config)
    if config.profile != "v1":
        asked, found = stored(asked), stored(found)  # read for the discounts, then for the pairs
    if config.profile == "v1":
        return asked.join(found, "key").groupBy("s1_id", "candidate_id").agg(F.sum((weight * F.col("asked") * F.col("times")).cast("double")).alias("score"))
    # a key's records, at most `cap`, are one array; pairs are made where their S1 record is, so arrays are dealt, once, and no pairs
    lists = found.groupBy("key").agg(F.first("length").alias("length"), F.collect_list(F.struct("candidate_id", "times")).alias("members"))
    discount = discounts(found.join(asked.select("key").distinct(), "key", "left_semi"), config, vocabulary)
    n = asked.join(found.select("key", "length").distinct(), "key").agg(F.sum("length")).first()[0] or 0
    parts = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PAIRS))
    met = asked.join(lists, "key").join(discount, ["key", "length"]).select("s1_id", (weight * F.col("asked") * F.col("discount")).cast("double").alias("each"), "members")
    pairs = met.repartition(parts, "s1_id").select("s1_id", "each", F.inline("members"))
    return pairs.groupBy("s1_id", "candidate_id").agg(F.sum(F.col("each") * F.col("times")).alias("score"))


def best(pairs: DataFrame, top_k: int) -> DataFrame:
    """The top_k of each s1_id with their rank, then without pairs of S1 records; equal scores in the order of their ids."""
    order = Window.partitionBy("s1_id").orderBy(F.desc(F.round("score", 6)), "candidate_id")  # sums of doubles differ in their last digits
    ranked = pairs.withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= top_k)
    return ranked.where((F.col("candidate_id") != F.col("s1_id")) & ~F.col("candidate_id").startswith("S1"))


def prepared(records: DataFrame) -> DataFrame:
    """Preprocessed records, stored; those that are preprocessed already, as they are."""
    return records if set(DERIVED) <= set(records.columns) else stored(preprocess(records))


def candidates(s1: DataFrame, pool: DataFrame, config: Blocking = V1, vocabulary: DataFrame | None = None) -> DataFrame:
    """s1_id, candidate_id, score, rnk. s1, pool: raw or preprocessed records; the pool is S2 and S3 together. Keys are made once and stored, for hot keys and pairs both read them."""
    s1, pool = prepared(s1), prepared(pool)
    if vocabulary is None and config.profile == "v2":
        vocabulary = stored(token_vocabulary(s1.select("name_norm").unionByName(pool.select("name_norm")), config))
    return best(score_pairs(stored(blocking_keys(s1, config, vocabulary)), stored(blocking_keys(pool, config, vocabulary)), config, vocabulary), config.top_k)


def candidates_from_index(s1: DataFrame, index: DataFrame, config: Blocking = V1, vocabulary: DataFrame | None = None) -> DataFrame:
    """The same against a pool's finished key table, of sinks.read_index(); vocabulary: the one that it was made with."""
    return best(score_pairs(stored(blocking_keys(prepared(s1), config, vocabulary)), index, config, vocabulary), config.top_k)
