"""Quality of blocking, of scored pairs and of whole entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import stored
from .pairs import expand_ground_truth, parse_ground_truth, true_pairs


def _share(part: Column, whole: Column, otherwise: float) -> Column:
    return F.when(whole > 0, part / whole).otherwise(otherwise)


def candidate_recall(candidates: DataFrame, gt: DataFrame) -> DataFrame:
    """One row: recall. 1 without matches to find."""
    hits = true_pairs(gt).join(candidates.select("s1_id", "candidate_id", F.lit(1).alias("hit")), ["s1_id", "candidate_id"], "left")
    return hits.agg(_share(F.sum(F.coalesce("hit", F.lit(0))), F.count("*"), 1.0).alias("recall"))


def reduction_ratio(candidates: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """One row: 1 - pairs / possible pairs."""
    n = candidates.agg(F.count("*").alias("n")).join(s1.agg(F.count("*").alias("a"))).join(pool.agg(F.count("*").alias("b")))
    whole = F.col("a").cast("double") * F.col("b")
    return n.select(F.when(whole > 0, 1.0 - F.col("n") / whole).otherwise(1.0).alias("reduction_ratio"))


def recall_at(candidates: DataFrame, gt: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """k, recall: if only the k first of each entity were kept."""
    ranks = true_pairs(gt).join(candidates.select("s1_id", "candidate_id", "rnk"), ["s1_id", "candidate_id"], "left")
    return ranks.select("rnk", F.explode(F.array(*map(F.lit, ks))).alias("k")).groupBy("k").agg(F.avg(F.when(F.col("rnk") <= F.col("k"), 1.0).otherwise(0.0)).alias("recall"))


def blocking_diagnostics(candidates: DataFrame, gt: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """One row of 17 measures of a candidate set."""
    truth = parse_ground_truth(gt)
    found = candidates.groupBy("s1_id").agg(F.count("*").alias("n"))
    each = truth.join(found, "s1_id", "left").select("s1_id", F.size("true_ids").alias("n_true"), F.coalesce("n", F.lit(0)).alias("n"))
    hits = true_pairs(gt).join(candidates.select("s1_id", "candidate_id", F.lit(1).alias("hit")), ["s1_id", "candidate_id"], "left")
    is_s2, hit = F.col("candidate_id").startswith("S2"), F.coalesce("hit", F.lit(0))
    matches = hits.agg(
        F.count("*").alias("total_true_matches"), F.coalesce(F.sum(hit), F.lit(0)).alias("retrieved_true_matches"), _share(F.sum(hit), F.count("*"), 1.0).alias("overall_candidate_recall"),
        F.coalesce(F.avg(F.when(is_s2, hit)), F.lit(1.0)).alias("s2_candidate_recall"), F.coalesce(F.avg(F.when(~is_s2, hit)), F.lit(1.0)).alias("s3_candidate_recall"),
    )
    single = F.col("n_true") == 0
    entities = each.agg(
        F.count("*").alias("total_s1_entities"), F.count_if(single).alias("singleton_count"), F.count_if(single & (F.col("n") == 0)).alias("singleton_clean_count"),
        F.avg("n").alias("candidates_per_s1_mean"), F.percentile("n", 0.5).alias("candidates_per_s1_median"), F.percentile("n", 0.9).alias("candidates_per_s1_p90"), F.percentile("n", 0.95).alias("candidates_per_s1_p95"),
        F.percentile("n", 0.99).alias("candidates_per_s1_p99"), F.max("n").alias("candidates_per_s1_max"), F.min("n").alias("candidates_per_s1_min"),
    )
    total = candidates.agg(F.count("*").alias("total_candidates"))
    ratio = reduction_ratio(candidates, s1, pool).withColumnRenamed("reduction_ratio", "candidate_reduction_ratio")
    return entities.join(matches).join(total).join(ratio)


def blocker_ablation(candidate_sets: dict[str, DataFrame], gt: DataFrame) -> DataFrame:
    """families, n_candidates, recall: of the candidates that each choice of key families gives."""
    out = None
    for name, found in candidate_sets.items():
        row = candidate_recall(found, gt).join(found.agg(F.count("*").alias("n_candidates"))).select(F.lit(name).alias("families"), "n_candidates", "recall")
        out = row if out is None else out.unionByName(row)
    return out


def entity_counts(predictions: DataFrame, gt: DataFrame) -> DataFrame:
    """s1_id, n_true, n_pred, n_hit for each entity of the ground truth. predictions: s1_id, candidate_id, distinct."""
    truth, predicted = true_pairs(gt).withColumn("t", F.lit(1)), predictions.select("s1_id", "candidate_id").withColumn("p", F.lit(1))
    both = truth.join(predicted, ["s1_id", "candidate_id"], "full").groupBy("s1_id").agg(F.count("t").alias("n_true"), F.count("p").alias("n_pred"), F.count(F.col("t") + F.col("p")).alias("n_hit"))
    zero = F.lit(0)
    return parse_ground_truth(gt).select("s1_id").join(both, "s1_id", "left").select("s1_id", *[F.coalesce(c, zero).alias(c) for c in ("n_true", "n_pred", "n_hit")])


def precision(n_true: Column, n_pred: Column, n_hit: Column) -> Column:
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0), 0.0).otherwise(n_hit / n_pred)


def recall(n_true: Column, n_pred: Column, n_hit: Column) -> Column:
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0), 0.0).otherwise(n_hit / n_true)


def f05(n_true: Column, n_pred: Column, n_hit: Column) -> Column:
    """F of precision at twice the weight of recall; 1 if nothing is there and nothing was said."""
    p, r = n_hit / n_pred, n_hit / n_true
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0) | (n_hit == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


COUNTS = ("n_true", "n_pred", "n_hit")


def entity_f05(predictions: DataFrame, gt: DataFrame) -> DataFrame:
    """s1_id, precision, recall, f05."""
    c = [F.col(x) for x in COUNTS]
    return entity_counts(predictions, gt).select("s1_id", precision(*c).alias("precision"), recall(*c).alias("recall"), f05(*c).alias("f05"))


def macro_f05(predictions: DataFrame, gt: DataFrame) -> DataFrame:
    """One row: the mean over the ground truth's entities, 0 if it has none."""
    return entity_f05(predictions, gt).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def error_analysis(pairs: DataFrame, predictions: DataFrame, gt: DataFrame) -> DataFrame:
    """One row: hits, false alarms, and misses of blocking (the pair was no candidate) and of the classifier, by source, and entities without matches."""
    truth = true_pairs(gt).withColumn("t", F.lit(1))
    said = predictions.select("s1_id", "candidate_id", F.lit(1).alias("p"))
    known = pairs.select("s1_id", "candidate_id", F.lit(1).alias("c"))
    ids = parse_ground_truth(gt).select("s1_id", (F.size("true_ids") == 0).alias("single"))
    every = truth.join(said, ["s1_id", "candidate_id"], "full").join(known, ["s1_id", "candidate_id"], "left").join(ids, "s1_id")
    t, p, c = (F.col(x).isNotNull() for x in "tpc")
    is_s2, is_s3 = F.col("candidate_id").startswith("S2"), F.col("candidate_id").startswith("S3")
    counts = every.agg(
        F.count_if(t).alias("total_true_matches"), F.count_if(t & p).alias("true_positives"), F.count_if(~t & p).alias("false_positives"), F.count_if(t & ~p).alias("total_false_negatives"),
        F.count_if(t & ~p & ~c).alias("blocking_misses"), F.count_if(t & ~p & c).alias("classifier_misses"),
        F.count_if(t & ~p & ~c & is_s2).alias("s2_blocking_misses"), F.count_if(t & ~p & ~c & is_s3).alias("s3_blocking_misses"),
        F.count_if(t & ~p & c & is_s2).alias("s2_classifier_misses"), F.count_if(t & ~p & c & is_s3).alias("s3_classifier_misses"),
        F.count_distinct(F.when(F.col("single") & p, F.col("s1_id"))).alias("singleton_false_positives"),
    )
    singles = ids.agg(F.count("*").alias("total_entities"), F.count_if("single").alias("singleton_total"))
    rate = lambda x: F.when(F.col("total_true_matches") > 0, 100.0 * F.col(x) / F.col("total_true_matches")).otherwise(0.0)
    return counts.join(singles).withColumn("singleton_correct", F.col("singleton_total") - F.col("singleton_false_positives")).withColumn("blocking_miss_rate_pct", rate("blocking_misses")).withColumn("classifier_miss_rate_pct", rate("classifier_misses"))


def predict(scored: DataFrame, threshold: float, probability: str = "p") -> DataFrame:
    """s1_id, candidate_id of the pairs at the threshold or above, compared as floats."""
    return scored.where(F.col(probability).cast("float") >= F.lit(threshold).cast("float")).select("s1_id", "candidate_id")


def margin_filter(scored: DataFrame, threshold: float, margin: float, probability: str = "p") -> DataFrame:
    """Of each entity's predictions, those that come within margin of its best."""
    kept = scored.where(F.col(probability).cast("float") >= F.lit(threshold).cast("float"))
    top = F.max(probability).over(Window.partitionBy("s1_id"))
    return kept.withColumn("_top", top).where(F.col(probability) >= F.col("_top") - margin).drop("_top")


def threshold_sweep(scored: DataFrame, gt: DataFrame, thresholds: list[float], probability: str = "p") -> DataFrame:
    """threshold, macro_f05, mean_precision, mean_recall, in one pass over the pairs. scored: s1_id, candidate_id, p, label.

    A pair counts once, under the last threshold that it reaches; an entity's counts at a threshold are added up from the top, in a
    row of its own of as many numbers as there are thresholds."""
    grid = sorted({float(t) for t in thresholds})
    p = F.col(probability).cast("float")
    reached = sum((F.when(p >= F.lit(t).cast("float"), 1).otherwise(0) for t in grid), F.lit(0))
    truth = parse_ground_truth(gt).select("s1_id", F.size("true_ids").alias("n_true"))
    each = scored.select("s1_id", "label", reached.alias("at")).where(F.col("at") > 0).groupBy("s1_id", "at").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    entities = each.groupBy("s1_id").agg(F.collect_list(F.struct("at", "n", "hits")).alias("by"))

    def above(field: str) -> Column:
        return F.coalesce(F.aggregate("by", F.lit(0).cast("long"), lambda s, x: s + F.when(x["at"] > F.col("i"), x[field]).otherwise(0)), F.lit(0).cast("long"))

    rows = truth.join(entities, "s1_id", "left").select("n_true", "by", F.posexplode(F.array(*map(F.lit, grid))).alias("i", "threshold"))
    every = rows.select("threshold", "n_true", above("n").alias("n_pred"), above("hits").alias("n_hit"))
    c = [F.col(x) for x in COUNTS]
    return every.groupBy("threshold").agg(F.avg(f05(*c)).alias("macro_f05"), F.avg(precision(*c)).alias("mean_precision"), F.avg(recall(*c)).alias("mean_recall"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the greatest macro_f05, of the least threshold among equals."""
    return sweep.orderBy(F.desc("macro_f05"), "threshold").limit(1)


def threshold_report(scored: DataFrame, gt: DataFrame, threshold: float, probability: str = "p") -> DataFrame:
    """One row of entity measures at a threshold."""
    c = [F.col(x) for x in COUNTS]
    single = F.col("n_true") == 0
    return entity_counts(predict(scored, threshold, probability), gt).agg(
        F.avg(f05(*c)).alias("macro_f05"), F.avg(precision(*c)).alias("mean_entity_precision"), F.avg(recall(*c)).alias("mean_entity_recall"),
        F.coalesce(F.avg(F.when(single, (F.col("n_pred") == 0).cast("double"))), F.lit(1.0)).alias("singleton_accuracy"), F.coalesce(F.avg(F.when(~single, f05(*c))), F.avg(f05(*c))).alias("non_singleton_macro_f05"),
        F.count("*").alias("num_entities"), F.count_if(single).alias("num_singletons"), F.count_if(~single).alias("num_non_singletons"),
        F.count_if(F.col("n_pred") > F.col("n_hit")).alias("num_fp_entities"), F.count_if(F.col("n_true") > F.col("n_hit")).alias("num_fn_entities"),
    )


def pair_metrics(scored: DataFrame, threshold: float, probability: str = "p") -> DataFrame:
    """One row: precision, recall and F1 of pairs."""
    said, true = F.col(probability).cast("float") >= F.lit(threshold).cast("float"), F.col("label") == 1
    n = scored.agg(F.count_if(said & true).alias("hit"), F.count_if(said).alias("said"), F.count_if(true).alias("true"))
    return n.select(_share(F.col("hit"), F.col("said"), 0.0).alias("pair_precision"), _share(F.col("hit"), F.col("true"), 0.0).alias("pair_recall"), _share(2 * F.col("hit"), F.col("said") + F.col("true"), 0.0).alias("pair_f1"))


def _by_score(scored: DataFrame, probability: str) -> DataFrame:
    """p, n, pos for each distinct score: what both curves need, however many pairs there are."""
    return scored.groupBy(F.col(probability).alias("p")).agg(F.count("*").alias("n"), F.sum("label").alias("pos"))


def _running(scored: DataFrame, probability: str) -> DataFrame:
    """p, n, pos and, of the scores above, n_above and pos_above. Scores are dealt into ranges; each range is added up in a task, and starts from the sums of the ranges above it, a row each."""
    scores = _by_score(scored, probability)
    ranged = stored(scores.repartitionByRange("p").withColumn("range", F.spark_partition_id()))
    sums = ranged.groupBy("range").agg(F.sum("n").alias("n_"), F.sum("pos").alias("pos_"))
    over = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("n_").over(over), F.lit(0)).alias("n_"), F.coalesce(F.sum("pos_").over(over), F.lit(0)).alias("pos_"))
    within = Window.partitionBy("range").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)
    above = lambda c: (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"{c}_")).alias(f"{c}_above")
    return ranged.join(F.broadcast(sums), "range").select("p", "n", "pos", above("n"), above("pos"))


def average_precision(scored: DataFrame, probability: str = "p") -> DataFrame:
    """One row: the sum of precision times the gain in recall, by descending score."""
    steps = _running(scored, probability)
    hits, seen = F.col("pos") + F.col("pos_above"), F.col("n") + F.col("n_above")
    return steps.agg(_share(F.sum(F.col("pos") * hits / seen), F.sum("pos"), 0.0).alias("average_precision"))


def roc_auc(scored: DataFrame, probability: str = "p") -> DataFrame:
    """One row: the share of pairs of a positive and a negative in the right order, ties as halves; null if there is only one class."""
    steps = _running(scored, probability).withColumn("neg", F.col("n") - F.col("pos"))
    right = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0))
    return steps.agg(F.try_divide(right, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))
