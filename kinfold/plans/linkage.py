"""The whole linkage: from sources to candidates, features, scores, a threshold and results."""

from __future__ import annotations

import copy
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocking, evaluate, features, ml, pairs
from ..operators.keys import V1, Blocking
from ..sources import sinks
from ..sources.staging import stored

THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))


@dataclass(frozen=True)
class Plan:
    """What a run does. thresholds: those of the sweep. matcher: what is fitted is a copy of it."""

    blocking: Blocking = V1
    extended: bool = False
    thresholds: tuple[float, ...] = THRESHOLDS
    negatives: float | None = 5.0
    validation: float = 0.2
    seed: int = 42
    matcher: ml.Matcher | None = None


@dataclass
class Result:
    candidates: DataFrame
    scored: DataFrame
    sweep: DataFrame
    threshold: float
    matcher: ml.Matcher
    validation_truth: DataFrame
    table: DataFrame


def pair_features(found: DataFrame, s1: DataFrame, pool: DataFrame, gt: DataFrame | None, extended: bool = False, idf: DataFrame | None = None, default: float = features.UNFITTED_IDF) -> DataFrame:
    """Features of candidate pairs, labelled if there is a ground truth. idf: weights of tokens, for the extended ones."""
    if extended:
        s1, pool = features.extended_records(s1, idf), features.extended_records(pool, idf)
    full = pairs.enrich(found.select("s1_id", "candidate_id"), s1, pool)
    full = pairs.label(full, gt) if gt is not None else full
    return features.extended_features(full, default) if extended else features.basic_features(full)


def fit_and_validate(s1: DataFrame, pool: DataFrame, gt: DataFrame, plan: Plan | None = None) -> Result:
    """Trains on a part of the entities, and chooses the threshold on the others. Records, candidates and the feature table are stored, for several steps read them; the matcher keeps the token weights that it was fitted with."""
    plan = plan or Plan()
    s1, pool = blocking.prepared(s1), blocking.prepared(pool)
    found = stored(blocking.candidates(s1, pool, plan.blocking))
    split = pairs.split_entities(gt.select(F.col("source1_entity_id").alias("s1_id")), plan.validation, plan.seed)
    matcher = copy.copy(plan.matcher or ml.LogisticMatcher())
    matcher.feature_names = list(features.EXTENDED if plan.extended else features.BASIC)
    if plan.extended:
        names = s1.select("name_norm").unionByName(pool.select("name_norm"))
        matcher.idf, matcher.default_idf = stored(features.token_idf(names)), features.default_idf(names.count())
    table = stored(pair_features(found, s1, pool, gt, plan.extended, matcher.idf, matcher.default_idf).join(split, "s1_id"))
    train = table.where("split = 'train'")
    train = stored(pairs.sample_negatives(train, plan.negatives)) if plan.negatives is not None else train
    matcher.fit(train)
    scored = stored(matcher.score(table.where("split = 'val'")).select("s1_id", "candidate_id", "label", "p"))
    truth = gt.join(split.where("split = 'val'").select(F.col("s1_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    sweep = evaluate.threshold_sweep(scored, truth, list(plan.thresholds))
    row = evaluate.best_threshold(sweep).first()
    return Result(found, scored, sweep, row.threshold if row else 0.5, matcher, truth, table)


def infer(s1: DataFrame, pool: DataFrame, matcher: ml.Matcher, threshold: float, config: Blocking = V1, index: DataFrame | None = None, vocabulary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """matching_results and candidate_lists of every S1 record. Features are those that the matcher was fitted on, with the token weights that it keeps. index, vocabulary: a finished key table of the pool."""
    s1, pool = blocking.prepared(s1), blocking.prepared(pool)
    found = stored(blocking.candidates(s1, pool, config, vocabulary) if index is None else blocking.candidates_from_index(s1, index, config, vocabulary))
    extended = set(matcher.feature_names) > set(features.BASIC)
    scored = matcher.score(pair_features(found, s1, pool, None, extended, matcher.idf, matcher.default_idf))
    return sinks.matching_results(evaluate.predict(scored, threshold), s1), sinks.candidate_lists(found, s1)
