"""Profiles of sources, ground truth and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .pairs import parse_ground_truth


def source_profile(records: DataFrame, by: str = "source") -> DataFrame:
    """A row a source: rows, distinct ids, missing values, lengths of names."""
    n = F.length("business_name")
    missing = lambda c: F.count_if(T.is_missing(F.col(c)))
    return records.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count_distinct("entity_id").alias("n_ids"), missing("business_name").alias("n_missing_name"), missing("business_address").alias("n_missing_address"), missing("country").alias("n_missing_country"),
        F.min(n).alias("min_length"), F.percentile(n, 0.5).alias("median_length"), F.avg(n).alias("mean_length"), F.max(n).alias("max_length"), F.count_if(n <= 3).alias("n_short"),
    )


def country_counts(records: DataFrame, by: str = "source") -> DataFrame:
    return records.groupBy(by, T.normalise_country(F.col("country")).alias("country_norm")).agg(F.count("*").alias("n"))


def script_counts(records: DataFrame, by: str = "source") -> DataFrame:
    """Names by the script that they are in."""
    return records.groupBy(by, T.detect_script(F.col("business_name")).alias("script")).agg(F.count("*").alias("n"))


def match_cardinality(gt: DataFrame) -> DataFrame:
    """n_matches, n_entities, and how many of these have matches in S2, in S3, in both."""
    has = lambda s: F.exists("true_ids", lambda x: x.startswith(s))
    return parse_ground_truth(gt).groupBy(F.size("true_ids").cast("long").alias("n_matches")).agg(F.count("*").alias("n_entities"), F.count_if(has("S2")).alias("n_s2"), F.count_if(has("S3")).alias("n_s3"), F.count_if(has("S2") & has("S3")).alias("n_both"))


def miss_causes(candidates: DataFrame, gt: DataFrame, s1_keys: DataFrame, pool_keys: DataFrame) -> DataFrame:
    """s1_id, candidate_id, shared: for each true pair that is no candidate, the keys that both records have, joined by a space ("" if blocking can't see the pair)."""
    from .pairs import true_pairs

    missed = true_pairs(gt).join(candidates, ["s1_id", "candidate_id"], "left_anti")
    a = s1_keys.select(F.col("entity_id").alias("s1_id"), "key").distinct()
    b = pool_keys.select(F.col("entity_id").alias("candidate_id"), "key").distinct()
    shared = missed.join(a, "s1_id").join(b, ["candidate_id", "key"]).groupBy("s1_id", "candidate_id").agg(F.array_join(F.array_sort(F.collect_set("key")), " ").alias("shared"))
    return missed.join(shared, ["s1_id", "candidate_id"], "left").select("s1_id", "candidate_id", F.coalesce("shared", F.lit("")).alias("shared"))


def displacement(candidates_untruncated: DataFrame, gt: DataFrame, top_k: int) -> DataFrame:
    """One row: ranks of true matches in untruncated lists, and how many lie beyond top_k."""
    from .pairs import true_pairs

    ranks = true_pairs(gt).join(candidates_untruncated, ["s1_id", "candidate_id"]).select("rnk")
    return ranks.agg(F.count("*").alias("n_found"), F.percentile("rnk", 0.5).alias("median_rank"), F.percentile("rnk", 0.99).alias("p99_rank"), F.max("rnk").alias("max_rank"), F.count_if(F.col("rnk") > top_k).alias("n_displaced"))


def extrapolate(seconds: float, rows: int, target: int, budget_seconds: float) -> dict:
    """Linear projection of a sample's time, and whether it keeps a budget."""
    projected = seconds * target / rows if rows else 0.0
    return {"projected_seconds": projected, "verdict": "GO" if rows and projected <= budget_seconds else "NOT READY"}
