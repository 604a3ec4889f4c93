"""Ground truth, labelled pairs and samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocking import source_of

#: Columns of a record that a pair carries, by the name they have there.
CARRIED = {
    "name_norm": "name_norm", "name_compact": "name_compact", "name_no_suffix": "name_no_suffix", "address_norm": "address_norm", "address_is_missing": "address_is_missing",
    "country_norm": "country_norm", "name_script": "script", "is_domain": "is_domain", "domain_stem": "domain_stem", "legal_suffix": "legal_suffix", "idf_weights": "idf_weights", "domain_core": "domain_core", "plain_compact": "plain_compact",
}


def parse_ground_truth(gt: DataFrame) -> DataFrame:
    """s1_id, true_ids (sorted, distinct): of source1_entity_id and a comma-separated list; blank and null words are no ids. Of rows with one s1_id the greatest counts."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: ~F.lower(x).isin("", "nan", "none", "null"))
    rows = gt.select(F.col("source1_entity_id").alias("s1_id"), F.array_sort(F.array_distinct(ids)).alias("true_ids"))
    return rows.groupBy("s1_id").agg(F.max("true_ids").alias("true_ids"))


def expand_ground_truth(gt: DataFrame) -> DataFrame:
    """s1_id, candidate_id: a row a match; entities without a match have a null."""
    return parse_ground_truth(gt).select("s1_id", F.explode_outer("true_ids").alias("candidate_id"))


def true_pairs(gt: DataFrame) -> DataFrame:
    return expand_ground_truth(gt).where("candidate_id is not null")


def enrich(pairs: DataFrame, s1: DataFrame, pool: DataFrame, how: str = "inner") -> DataFrame:
    """pairs with both records' columns; with "inner" a pair of an unknown id goes, with "left" its columns are null."""

    def side(df: DataFrame, key: str, prefix: str) -> DataFrame:
        return df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{prefix}_{as_}") for c, as_ in CARRIED.items() if c in df.columns])

    joined = pairs.join(side(s1, "s1_id", "s1"), "s1_id", how).join(side(pool, "candidate_id", "cand"), "candidate_id", how)
    return joined.withColumn("cand_source", source_of(F.col("candidate_id")))


def label(pairs: DataFrame, gt: DataFrame) -> DataFrame:
    """pairs with label: 1 if the ground truth has the pair."""
    truth = true_pairs(gt).withColumn("_true", F.lit(1))
    return pairs.join(truth, ["s1_id", "candidate_id"], "left").withColumn("label", F.coalesce("_true", F.lit(0))).drop("_true")


def sample_negatives(labelled: DataFrame, ratio: float, order: Column | None = None) -> DataFrame:
    """All positives; of each entity's negatives max(1, int(positives * ratio)), or int(ratio) if it has no positive, by `order` (a hash of the pair)."""
    order = F.xxhash64("s1_id", "candidate_id") if order is None else order
    positives = F.sum("label").over(Window.partitionBy("s1_id"))
    rank = F.row_number().over(Window.partitionBy("s1_id", "label").orderBy(order, "candidate_id"))
    allowed = F.when(F.col("_p") > 0, F.greatest(F.lit(1), F.floor(F.col("_p") * ratio))).otherwise(F.lit(int(ratio)))
    return labelled.withColumn("_p", positives).withColumn("_r", rank).where((F.col("label") == 1) | (F.col("_r") <= allowed)).drop("_p", "_r")


def distractor_sample(gt: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame, n: int, distractors: int) -> tuple[DataFrame, DataFrame]:
    """The first n entities of the ground truth by id, and a pool of all their matches and distractors / 2 other records of each source, by id."""
    chosen = gt.orderBy("source1_entity_id").limit(n)
    needed = true_pairs(chosen).select(F.col("candidate_id").alias("entity_id")).distinct()
    picked = s1.join(chosen.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_semi")
    parts = []
    for source in (s2, s3):
        parts += [source.join(needed, "entity_id", "left_semi"), source.join(needed, "entity_id", "left_anti").orderBy("entity_id").limit(distractors // 2)]
    pool = parts[0]
    for part in parts[1:]:
        pool = pool.unionByName(part)
    return picked, pool.dropDuplicates(["entity_id"])


def split_entities(ids: DataFrame, share: float = 0.2, seed: int = 42, id_column: str = "s1_id", order: Column | None = None, bits: int = 48) -> DataFrame:
    """id, split ("train" or "val"): by the order of a hash (or of a number of the id, whose lower `bits` don't tell its range), max(1, int(n * share)) of the distinct ids in "val". The place of an id is the number of hashes before it, counted by ranges of the hash, so no task orders all ids."""
    h = F.xxhash64(F.col(id_column), F.lit(seed)) if order is None else order
    rows = ids.select(id_column).distinct().withColumn("_h", h).withColumn("_b", F.shiftright("_h", bits))
    n = rows.count()
    most = max(1, int(n * share)) if n else 0
    buckets = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(buckets), F.lit(0))).drop("_n")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", id_column))
    return rows.join(before, "_b").select(id_column, F.when(place <= most, "val").otherwise("train").alias("split"))
