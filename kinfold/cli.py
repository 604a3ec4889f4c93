"""Command line: python -m kinfold COMMAND. Each command reads tab-separated sources under --root and leaves its results and a report as JSON."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import blocking, evaluate, features, keys, ml, pairs, profile
from .plans import linkage
from .sources import reports, sinks, tables
from .sources.staging import stored

MATCHERS: dict[str, Callable[[], ml.Matcher]] = {"logistic": ml.LogisticMatcher, "boosted": ml.BoostedMatcher}
PROFILES = {"v1": keys.V1, "v2": keys.V2, "v2_disk": keys.Blocking(profile="v2_disk", cap=150, top_k=120)}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinfold", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, said: str, *groups: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=said, description=said)
        p.add_argument("--root", required=True, help="folder with a folder for each split")
        p.add_argument("--out", required=True, help="folder for the results")
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--multi-line", action="store_true", help="values may hold line breaks")
        p.add_argument("--log-level", default="WARN")
        if "blocking" in groups:
            p.add_argument("--profile", choices=PROFILES, default="v1")
            p.add_argument("--top-k", type=int)
        if "sample" in groups:
            p.add_argument("--max-s1", type=int, help="as many S1 records, by a hash of their ids")
            p.add_argument("--distractors", type=int, default=1000, help="further records of the pool, if S1 is sampled")
            p.add_argument("--confirm-full", action="store_true", help="train on all records")
        if "training" in groups:
            p.add_argument("--split", default="train")
            p.add_argument("--model", choices=MATCHERS, default="logistic")
            p.add_argument("--extended", action="store_true")
            p.add_argument("--negatives", type=float, default=5.0)
            p.add_argument("--validation", type=float, default=0.2)
            p.add_argument("--seed", type=int, default=42)
        return p

    command("train", "fits a matcher, chooses its threshold and keeps both", "blocking", "sample", "training")
    command("validate", "fits and measures without keeping the matcher", "blocking", "sample", "training")
    command("compare", "fits both kinds of matcher and keeps the better", "blocking", "sample", "training")
    ingest = command("ingest", "makes the pool's key index and stops", "blocking")
    ingest.add_argument("--split", default="test")
    ingest.add_argument("--remove", action="store_true", help="delete the index instead")
    predict = command("predict", "matches a split and writes both tables and their archive", "blocking")
    predict.add_argument("--split", default="test")
    predict.add_argument("--matcher", action="append", required=True, help="folder of a trained matcher; of several the first that is there")
    predict.add_argument("--threshold", type=float, help="instead of the one that was chosen in training")
    predict.add_argument("--index", help="a finished index of this pool")
    predict.add_argument("--smoke-n", type=int, help="only the first S1 records")
    predict.add_argument("--pool-rows", type=int, help="only the first records of each source of the pool")
    command("inspect", "profiles of the sources and the ground truth").add_argument("--split", default="train")
    bench = command("bench", "times blocking and features on samples of several sizes", "blocking")
    bench.add_argument("--split", default="train")
    bench.add_argument("--sizes", type=int, nargs="+", default=[100, 1000])
    bench.add_argument("--target", type=int, default=1_000_000, help="S1 records to project the time to")
    bench.add_argument("--budget-seconds", type=float, default=3600.0)
    return out


def _config(args: argparse.Namespace) -> keys.Blocking:
    found = PROFILES[args.profile]
    return keys.replace(found, top_k=args.top_k) if args.top_k else found


def _sides(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    s1, s2, s3 = (tables.read_source(spark, args.root, args.split, i, args.multi_line) for i in (1, 2, 3))
    return s1, s2.unionByName(s3)


def _training(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1, pool and ground truth: all, if that is confirmed, or a sample."""
    s1, pool = _sides(spark, args)
    gt = tables.read_ground_truth(spark, args.root, args.split)
    if not args.max_s1:
        if not args.confirm_full:
            raise SystemExit("a run over all records wants --confirm-full; or give --max-s1")
        return s1, pool, gt
    chosen = stored(tables.random_sample(gt, args.max_s1, args.seed, "source1_entity_id"))
    s1 = s1.join(chosen.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_semi")
    needed = pairs.true_pairs(chosen).select(F.col("candidate_id").alias("entity_id")).distinct()
    others = tables.random_sample(pool.join(needed, "entity_id", "left_anti"), args.distractors, args.seed)
    return s1, pool.join(needed, "entity_id", "left_semi").unionByName(others), chosen


def _fitted(spark: SparkSession, args: argparse.Namespace, kind: str) -> tuple[linkage.Result, dict]:
    began = time.time()
    s1, pool, gt = _training(spark, args)
    s1, pool = blocking.prepared(s1), blocking.prepared(pool)
    plan = linkage.Plan(_config(args), args.extended, negatives=args.negatives, validation=args.validation, seed=args.seed, matcher=MATCHERS[kind]())
    result = linkage.fit_and_validate(s1, pool, gt, plan)
    said = evaluate.predict(result.scored, result.threshold)
    report = {"model": kind, "profile": args.profile, "extended": args.extended, "threshold": result.threshold, "seconds": time.time() - began, "importances": result.matcher.importances()}
    report |= {"blocking": reports.row_values(evaluate.blocking_diagnostics(result.candidates, gt, s1, pool))}
    report |= {"validation": reports.row_values(evaluate.threshold_report(result.scored, result.validation_truth, result.threshold))}
    report |= {"pairs": reports.row_values(evaluate.pair_metrics(result.scored, result.threshold)) | reports.row_values(evaluate.average_precision(result.scored)) | reports.row_values(evaluate.roc_auc(result.scored))}
    report |= {"errors": reports.row_values(evaluate.error_analysis(result.scored, said, result.validation_truth))}
    report |= {"sweep": [r.asDict() for r in result.sweep.orderBy("threshold").collect()]}
    return result, report


def train(spark: SparkSession, args: argparse.Namespace) -> dict:
    result, report = _fitted(spark, args, args.model)
    result.matcher.save(f"{args.out}/matcher", args.overwrite)
    return report


def validate(spark: SparkSession, args: argparse.Namespace) -> dict:
    return _fitted(spark, args, args.model)[1]


def compare(spark: SparkSession, args: argparse.Namespace) -> dict:
    fitted = {kind: _fitted(spark, args, kind) for kind in MATCHERS}
    first, second = ((fitted[k][0].matcher, fitted[k][1]["validation"]["macro_f05"]) for k in MATCHERS)
    best = ml.better(first, second)
    best.save(f"{args.out}/matcher", args.overwrite)
    chosen = next(k for k in MATCHERS if fitted[k][0].matcher is best)
    return fitted[chosen][1] | {"compared": {k: report for k, (_, report) in fitted.items()}}


def ingest(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.remove:
        return {"removed": sinks.remove_index(spark, args.out)}
    if sinks.index_is_whole(spark, args.out) and not args.overwrite:
        return {"reused": True} | {r.source: r.n for r in sinks.read_index(spark, args.out)[2].collect()}
    config = _config(args)
    s1, pool = (blocking.prepared(x) for x in _sides(spark, args))
    vocabulary = stored(keys.token_vocabulary(s1.select("name_norm").unionByName(pool.select("name_norm")), config)) if config.profile == "v2" else None
    # what an ingest that was cut off has left is made anew
    sinks.write_index(keys.blocking_keys(pool, config, vocabulary), args.out, overwrite=True, vocabulary=vocabulary, sources=pool)
    return {"reused": False} | {r.source: r.n for r in sinks.read_index(spark, args.out)[2].collect()}


def predict(spark: SparkSession, args: argparse.Namespace) -> dict:
    began = time.time()
    at = next((m for m in args.matcher if sinks.is_there(spark, f"{m}/matcher/about/_SUCCESS")), None)
    if at is None:
        raise SystemExit(f"no matcher at {', '.join(args.matcher)}")
    matcher = ml.Matcher().load(f"{at}/matcher")
    threshold = args.threshold if args.threshold is not None else reports.read_report(spark, f"{at}/report")["threshold"]
    s1, pool = _sides(spark, args)
    if args.smoke_n:
        s1 = tables.first_rows(s1, args.smoke_n)
    if args.pool_rows:
        by_source = [tables.first_rows(pool.where(F.col("entity_id").startswith(x)), args.pool_rows) for x in ("S2", "S3")]
        pool = by_source[0].unionByName(by_source[1])
    index = vocabulary = None
    if args.index:
        index, vocabulary, _ = sinks.read_index(spark, args.index)
    results, candidates = (stored(x) for x in linkage.infer(s1, pool, matcher, threshold, _config(args), index, vocabulary))
    sinks.write_tsv(results, f"{args.out}/matching_results", "source1_entity_id")
    sinks.write_tsv(candidates, f"{args.out}/candidate_pairs", "source1_entity_id")
    return {"matcher": at, "threshold": threshold, "seconds": time.time() - began, "check": reports.row_values(sinks.check_results(results, s1)), "archive": sinks.store_archive(spark, f"{args.out}/results.zip", results, candidates, args.overwrite)}


def inspect(spark: SparkSession, args: argparse.Namespace) -> dict:
    s1, pool = _sides(spark, args)
    every = stored(s1.unionByName(pool).withColumn("source", F.substring("entity_id", 1, 2)))
    rows = lambda df: [r.asDict() for r in df.collect()]
    report = {"sources": rows(profile.source_profile(every).orderBy("source")), "countries": rows(profile.country_counts(every).orderBy("source", "country_norm")), "scripts": rows(profile.script_counts(every).orderBy("source", "script"))}
    report["broken_lines"] = {i: tables.broken_lines(spark, f"{args.root}/{args.split}/source{i}.tsv") for i in (1, 2, 3)}
    if args.split == "train":
        report["matches"] = rows(profile.match_cardinality(tables.read_ground_truth(spark, args.root, args.split)).orderBy("n_matches"))
    return report


def bench(spark: SparkSession, args: argparse.Namespace) -> dict:
    s1, pool = _sides(spark, args)
    pool, out = blocking.prepared(pool), []
    for n in args.sizes:
        began = time.time()
        some = blocking.prepared(tables.first_rows(s1, n))
        found = stored(blocking.candidates(some, pool, _config(args)))
        blocked = time.time()
        features.basic_features(pairs.enrich(found.select("s1_id", "candidate_id"), some, pool)).write.format("noop").mode("overwrite").save()
        ended = time.time()
        out.append({"n_s1": n, "n_pairs": found.count(), "blocking_seconds": blocked - began, "feature_seconds": ended - blocked} | profile.extrapolate(ended - began, n, args.target, args.budget_seconds))
    return {"runs": out}


COMMANDS = {f.__name__: f for f in (train, validate, compare, ingest, predict, inspect, bench)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"kinfold {args.command}").getOrCreate()
    spark.sparkContext.setLogLevel(args.log_level)
    report = COMMANDS[args.command](spark, args)
    if not getattr(args, "remove", False):
        reports.write_report(spark, f"{args.out}/report", report, args.overwrite or args.command == "ingest")
    return report
