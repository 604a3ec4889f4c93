"""Named queries over the driver's tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as X
from ..operators import blocking, evaluate, features, keys, ml, pairs, preprocess, profile
from ..sources import sinks, tables
from ..sources.staging import stored
from . import linkage, oracle

FOUND: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    FOUND[f.__name__] = f
    return f


def raw(spark: SparkSession, at: str) -> DataFrame:
    return tables.view(spark, at, "s1").unionByName(tables.pool(spark, at))


def ready(spark: SparkSession, at: str) -> DataFrame:
    return preprocess.preprocess(raw(spark, at))


def sides(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    """Both sides' records, preprocessed once."""
    return blocking.prepared(tables.view(spark, at, "s1")), blocking.prepared(tables.pool(spark, at))


def truth(spark: SparkSession, at: str) -> DataFrame:
    return tables.view(spark, at, "gt")


def found(spark: SparkSession, at: str, config: keys.Blocking = keys.V1) -> DataFrame:
    return blocking.candidates(*sides(spark, at), config)


def enriched(spark: SparkSession, at: str) -> DataFrame:
    """Labelled candidates with both records' columns."""
    s1, pool = sides(spark, at)
    chosen = blocking.candidates(s1, pool).select("s1_id", "candidate_id")
    return pairs.label(pairs.enrich(chosen, s1, pool), truth(spark, at))


def rule(spark: SparkSession, at: str) -> DataFrame:
    """Pairs with a score that is a fixed mean of three features."""
    f = features.feature_columns()
    p = F.round((f["name_levenshtein_sim"] + f["name_token_jaccard"] + f["address_token_jaccard"]) / 3, 4)
    return enriched(spark, at).select("s1_id", "candidate_id", "label", p.alias("p"))


def said(spark: SparkSession, at: str) -> DataFrame:
    return evaluate.predict(rule(spark, at), oracle.T)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles to so many digits, for comparison."""
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes])


def with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("source", F.substring("entity_id", 1, 2))


@query
def null_literal_flags(spark, at):
    flag = lambda c: X.is_missing(F.col(c)).cast("int")
    return raw(spark, at).select("entity_id", flag("business_name").alias("name_missing"), flag("business_address").alias("address_missing"))


@query
def clean_name_tokens(spark, at):
    return preprocess.preprocess_names(raw(spark, at)).select("entity_id", "name_norm", F.size(X.tokens(F.col("name_norm"))).cast("long").alias("n_tokens"))


@query
def compact_name(spark, at):
    return preprocess.preprocess_names(raw(spark, at)).select("entity_id", "name_compact")


@query
def legal_suffix_extract(spark, at):
    return preprocess.preprocess_names(raw(spark, at)).select("entity_id", "legal_suffix", F.col("has_legal_suffix").cast("int").alias("has_legal_suffix"), "name_no_suffix")


@query
def country_normalise(spark, at):
    return raw(spark, at).select("entity_id", X.normalise_country(F.col("country")).alias("country_norm"))


@query
def address_normalise(spark, at):
    return preprocess.preprocess_addresses(raw(spark, at)).select("entity_id", "address_norm", F.col("address_is_missing").cast("int").alias("address_is_missing"))


@query
def address_order_independent(spark, at):
    return preprocess.preprocess_addresses(raw(spark, at)).select("entity_id", "address_order_indep")


@query
def domain_parse(spark, at):
    return preprocess.preprocess_names(raw(spark, at)).select("entity_id", F.col("is_domain").cast("int").alias("is_domain"), "domain_stem")


@query
def core_domain(spark, at):
    core = X.core_domain(F.col("url"))
    return spark.read.parquet(f"{at}/pages.parquet").select("page_id", core["stem"].alias("core_stem"), core["compact"].alias("core_compact"))


@query
def script_profile(spark, at):
    counts = X.script_counts(F.col("text"))
    return spark.read.parquet(f"{at}/documents.parquet").select("doc_id", *[counts[n].cast("long").alias(f"n_{n}") for n, _ in C.SCRIPTS], counts["all"].cast("long").alias("n_letters"))


@query
def blocking_keys_v1(spark, at):
    return keys.blocking_keys(ready(spark, at)).groupBy("entity_id", "tag", "key").agg(F.count("*").alias("n"))


@query
def blocking_keys_v2(spark, at):
    records = ready(spark, at)
    return keys.blocking_keys(records, keys.V2, keys.token_vocabulary(records)).groupBy("entity_id", "tag", "key").agg(F.count("*").alias("n"))


@query
def key_histogram(spark, at):
    return blocking.key_histogram(keys.blocking_keys(sides(spark, at)[1])).groupBy("n").agg(F.count("*").alias("n_keys"))


@query
def hot_keys(spark, at):
    return blocking.hot_keys(keys.blocking_keys(sides(spark, at)[1]), keys.V1.cap)


@query
def candidates_v1(spark, at):
    return found(spark, at)


@query
def candidates_v2(spark, at):
    return rounded(found(spark, at, keys.V2), 6)


@query
def candidates_v2_disk(spark, at):
    s1, pool = sides(spark, at)
    config = keys.Blocking(profile="v2_disk", cap=150, top_k=120)
    vocabulary = keys.token_vocabulary(s1.select("name_norm").unionByName(pool.select("name_norm")))
    return rounded(blocking.best(blocking.score_pairs(stored(keys.blocking_keys(s1, config, vocabulary)), stored(keys.blocking_keys(pool, config, vocabulary)), config), config.top_k), 6)


@query
def candidate_recall(spark, at):
    return rounded(evaluate.candidate_recall(found(spark, at), truth(spark, at)))


@query
def reduction_ratio(spark, at):
    return rounded(evaluate.reduction_ratio(found(spark, at), tables.view(spark, at, "s1"), tables.pool(spark, at)))


@query
def recall_at_k(spark, at):
    return rounded(evaluate.recall_at(found(spark, at), truth(spark, at), oracle.KS))


@query
def blocker_ablation(spark, at):
    s1, pool = sides(spark, at)
    return rounded(evaluate.blocker_ablation({f: stored(blocking.candidates(s1, pool, keys.V1.only(f))) for f in ("A", "AB", "ABC", "ABCD")}, truth(spark, at)))


@query
def blocking_diagnostics(spark, at):
    return rounded(evaluate.blocking_diagnostics(found(spark, at), truth(spark, at), tables.view(spark, at, "s1"), tables.pool(spark, at)))


@query
def token_vocabulary(spark, at):
    return keys.token_vocabulary(ready(spark, at))


@query
def rare_tokens(spark, at):
    return keys.token_vocabulary(ready(spark, at)).where((F.col("n") > 1) & (F.col("n") <= keys.V2.rare_most))


@query
def token_idf(spark, at):
    return rounded(features.token_idf(ready(spark, at)))


@query
def expand_ground_truth(spark, at):
    return pairs.expand_ground_truth(truth(spark, at))


@query
def match_cardinality(spark, at):
    return profile.match_cardinality(truth(spark, at))


@query
def source_profile(spark, at):
    return rounded(profile.source_profile(with_source(raw(spark, at))))


@query
def country_counts(spark, at):
    return profile.country_counts(with_source(raw(spark, at)))


@query
def labelled_pairs(spark, at):
    return enriched(spark, at).select("s1_id", "candidate_id", "label", "cand_source", F.coalesce("s1_name_norm", F.lit("")).alias("s1_name_norm"), F.coalesce("cand_name_norm", F.lit("")).alias("cand_name_norm"))


@query
def negative_sample(spark, at):
    number = lambda c: F.substring(F.col(c), F.lit(4), F.length(c)).cast("long")
    return pairs.sample_negatives(enriched(spark, at).select("s1_id", "candidate_id", "label"), 2.0, (number("s1_id") * 7919 + number("candidate_id") * 104729) % 65537)


@query
def features_21(spark, at):
    return rounded(features.basic_features(enriched(spark, at)))


def extended(spark: SparkSession, at: str) -> DataFrame:
    """The extended features of the labelled candidates, with fitted token weights."""
    s1, pool = sides(spark, at)
    names = s1.select("name_norm").unionByName(pool.select("name_norm"))
    idf, default = stored(features.token_idf(names)), features.default_idf(names.count())
    return linkage.pair_features(blocking.candidates(s1, pool), s1, pool, truth(spark, at), True, idf, default)


@query
def features_34(spark, at):
    return rounded(extended(spark, at), 5)


@query
def name_similarity(spark, at):
    return rounded(features.basic_features(enriched(spark, at)).select("s1_id", "candidate_id", "name_token_jaccard", "name_levenshtein_sim", "name_compact_levenshtein_sim"))


@query
def trigram_jaccard(spark, at):
    return rounded(extended(spark, at).select("s1_id", "candidate_id", "name_char_3gram_jaccard", "address_char_3gram_jaccard", "domain_core_jaccard"), 5)


@query
def idf_jaccard(spark, at):
    return rounded(extended(spark, at).select("s1_id", "candidate_id", "name_idf_jaccard"), 5)


@query
def extended_inference(spark, at):
    """Results by a fixed mean of extended features."""
    p = F.round((F.round(F.col("name_idf_jaccard").cast("double"), 5) + F.round(F.col("name_char_3gram_jaccard").cast("double"), 5) + F.round(F.col("address_char_3gram_jaccard").cast("double"), 5)) / 3, 4)
    return sinks.matching_results(evaluate.predict(extended(spark, at).withColumn("p", p), oracle.T), tables.view(spark, at, "s1"))


@query
def displacement(spark, at):
    """Places of true matches in lists of any length."""
    return rounded(profile.displacement(found(spark, at, keys.replace(keys.V1, top_k=2**31 - 1)), truth(spark, at), 5))


@query
def split_entities(spark, at):
    number = F.substring("s1_id", 4, 12).cast("long")
    return pairs.split_entities(truth(spark, at).select(F.col("source1_entity_id").alias("s1_id")), order=(number * 7919) % 65537, bits=6)


@query
def detect_script(spark, at):
    return spark.read.parquet(f"{at}/documents.parquet").select("doc_id", X.detect_script(F.col("text")).alias("script"))


#: Records of kinds that the derived tables don't have.
ODD = [
    ("O-01", "Tamsin's Bicycle Repair LLC", "12 ELM ST, Apt 4", "usa"), ("O-02", "Pvt. QRT Lantern Works Ltd.", "P.O. Box 7 NULL", " united states "), ("O-03", "LLC Quillback Pottery Studio", "null", "ind"),
    ("O-04", "Driftmoor Bay Inc Carpets", None, "brazil"), ("O-05", "राम प्राइवेट लिमिटेड", "", "JPN"), ("O-06", "ＡＣＭＥ Ｌｔｄ", "null none", None), ("O-07", "https://www.quiet-harbour.com/about", "4 apt. elm st. 12", "n/a"),
    ("O-08", "Velmora Tiles | www.velmoratl.com", "9 Rue de l’Église", "new zealand"), ("O-09", "Acme हिन्दी", "Ünter-Weg 5", "Fr"), ("O-10", "<NULL>", "१२ मार्ग", "uk"), ("O-11", "Müller & Söhne Co.", "５ Oak Rd", "deu"), ("O-12", "123 45", "5, 6", "Can"),
]


@query
def odd_records(spark, at):
    """The normalisation of records with other scripts, split suffixes, domains and missing values; the SQL has results written by hand."""
    ready_ = preprocess.preprocess(spark.createDataFrame(ODD, tables.RECORD))
    return ready_.select("entity_id", "name_norm", "legal_suffix", "name_no_suffix", "domain_stem", "name_script", "address_norm", "address_order_indep", "country_norm")


@query
def rule_score_predict(spark, at):
    return said(spark, at)


@query
def entity_f05(spark, at):
    return rounded(evaluate.entity_f05(said(spark, at), truth(spark, at)))


@query
def macro_f05(spark, at):
    return rounded(evaluate.macro_f05(said(spark, at), truth(spark, at)))


@query
def threshold_sweep(spark, at):
    return rounded(evaluate.threshold_sweep(rule(spark, at), truth(spark, at), oracle.THRESHOLDS))


@query
def best_threshold(spark, at):
    return evaluate.best_threshold(threshold_sweep(spark, at))


@query
def threshold_report(spark, at):
    return rounded(evaluate.threshold_report(rule(spark, at), truth(spark, at), oracle.T))


@query
def pair_metrics(spark, at):
    return rounded(evaluate.pair_metrics(rule(spark, at), oracle.T))


@query
def average_precision(spark, at):
    return rounded(evaluate.average_precision(rule(spark, at)))


@query
def roc_auc(spark, at):
    return rounded(evaluate.roc_auc(rule(spark, at)))


@query
def error_analysis(spark, at):
    scored = stored(rule(spark, at))
    return rounded(evaluate.error_analysis(scored, evaluate.predict(scored, oracle.T), truth(spark, at)))


@query
def margin_filter(spark, at):
    return evaluate.margin_filter(rule(spark, at), oracle.T, 0.1).select("s1_id", "candidate_id", "p")


@query
def matching_results(spark, at):
    return sinks.matching_results(said(spark, at), tables.view(spark, at, "s1"))


@query
def candidate_pairs(spark, at):
    return sinks.candidate_lists(found(spark, at), tables.view(spark, at, "s1"))


@query
def distractor_sample(spark, at):
    s1, pool = pairs.distractor_sample(truth(spark, at), *(tables.view(spark, at, v) for v in ("s1", "s2", "s3")), 100, 50)
    return s1.select("entity_id").unionByName(pool.select("entity_id"))


@query
def miss_causes(spark, at):
    s1, pool = sides(spark, at)
    return profile.miss_causes(blocking.candidates(s1, pool), truth(spark, at), keys.blocking_keys(s1), keys.blocking_keys(pool))


@query
def logistic_scores(spark, at):
    """Probabilities for the validation entities; an iterative fit, so without SQL."""
    plan = linkage.Plan(matcher=ml.LogisticMatcher(rounds=50))
    return linkage.fit_and_validate(tables.view(spark, at, "s1"), tables.pool(spark, at), truth(spark, at), plan).scored


@query
def normal_forms(spark, at):
    """Compatibility forms and base letters of whole texts; DuckDB has neither form."""
    return spark.read.parquet(f"{at}/documents.parquet").select("doc_id", X.nfkc(F.col("text")).alias("nfkc"), X.strip_accents(F.col("text")).alias("base_letters"))


def queries() -> dict:
    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
