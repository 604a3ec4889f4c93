"""Writing results: id lists as tab-separated files, the archive of both, and tables."""

from __future__ import annotations

import io
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def matching_results(predictions: DataFrame, s1: DataFrame) -> DataFrame:
    """source1_entity_id, matched_entity_ids for every S1 record: the sorted distinct ids joined by a comma, "" for none."""
    found = predictions.groupBy("s1_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("candidate_id"))).alias("ids"))
    return s1.select(F.col("entity_id").alias("s1_id")).distinct().join(found, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def candidate_lists(candidates: DataFrame, s1: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_ids, likewise."""
    return matching_results(candidates, s1).withColumnRenamed("matched_entity_ids", "candidate_entity_ids")


def write_tsv(df: DataFrame, path: str, order: str | None = None, single_file: bool = False) -> None:
    """Tab-separated with a header; empty strings as nothing. Rows in order, over several files unless one is asked for."""
    rows = df.orderBy(order) if order else df
    rows = rows.coalesce(1) if single_file else rows
    rows.write.mode("errorifexists").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"').csv(path)


def read_back(spark: SparkSession, path: str) -> bytes:
    """The bytes of the one file that write_tsv(..., single_file=True) left, through Spark's file systems."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).orderBy("path").select("content").collect()
    return b"".join(bytes(f.content) for f in files)


def write_archive(path: str, results: DataFrame, candidates: DataFrame) -> None:
    """A zip of both tables at a local path, as archive() has it. Rows come to the driver in order, a partition at a time, and go straight into the file."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, rows in (("matching_results.tsv", results), ("candidate_pairs.tsv", candidates)):
            with z.open(name, "w", force_zip64=True) as out:
                out.write(("\t".join(rows.columns) + "\n").encode())
                for row in rows.orderBy("source1_entity_id").toLocalIterator(prefetchPartitions=True):
                    out.write(("\t".join(map(_field, row)) + "\n").encode())


def store_archive(spark: SparkSession, path: str, results: DataFrame, candidates: DataFrame, overwrite: bool = False) -> str:
    """write_archive() to a path on any of Spark's file systems, by a file of the driver's own that is copied there."""
    with tempfile.TemporaryDirectory() as own:
        write_archive(f"{own}/results.zip", results, candidates)
        paths = spark._jvm.org.apache.hadoop.fs.Path
        at = paths(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(False, overwrite, paths(f"file://{own}/results.zip"), at)
    return path


def _field(value: str | None) -> str:
    value = value or ""
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in '"\t\n\r') else value


def archive(spark: SparkSession, matching_path: str, candidate_path: str) -> bytes:
    """A zip of both files, as the submission format wants it."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("matching_results.tsv", read_back(spark, matching_path))
        z.writestr("candidate_pairs.tsv", read_back(spark, candidate_path))
    return out.getvalue()


def check_results(results: DataFrame, s1: DataFrame) -> DataFrame:
    """One row: n_rows, n_ids, n_missing, n_unknown; a complete result has as many rows as ids, and none missing or unknown."""
    ids, have = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct(), results.select("source1_entity_id")
    counts = have.agg(F.count("*").alias("n_rows"), F.count_distinct("source1_entity_id").alias("n_ids"))
    missing = ids.join(have, "source1_entity_id", "left_anti").agg(F.count("*").alias("n_missing"))
    unknown = have.join(ids, "source1_entity_id", "left_anti").agg(F.count("*").alias("n_unknown"))
    return counts.join(missing).join(unknown)


def write_features(features: DataFrame, path: str) -> None:
    """Parquet, a folder a split, which reads of one split leave out."""
    features.write.mode("errorifexists").partitionBy("split").parquet(path)


def write_index(keys: DataFrame, path: str, overwrite: bool = False, vocabulary: DataFrame | None = None, sources: DataFrame | None = None) -> None:
    """A key table, with the vocabulary that it was made with and the number of records by source; an existing one stays unless it is to be overwritten. The counts come last, so an index that has them is whole."""
    mode = "overwrite" if overwrite else "errorifexists"
    keys.write.mode(mode).parquet(f"{path}/keys")
    if vocabulary is not None:
        vocabulary.write.mode(mode).parquet(f"{path}/vocabulary")
    counts = keys.select("entity_id").distinct() if sources is None else sources.select("entity_id")
    counts.groupBy(F.substring("entity_id", 1, 2).alias("source")).agg(F.count("*").alias("n")).write.mode(mode).parquet(f"{path}/sources")


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any of Spark's file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def index_is_whole(spark: SparkSession, path: str) -> bool:
    return is_there(spark, f"{path}/sources/_SUCCESS")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Keys, vocabulary (or None) and records by source of a finished index; raises for one that was cut off."""
    if not index_is_whole(spark, path):
        raise ValueError(f"no finished index at {path}")
    vocabulary = spark.read.parquet(f"{path}/vocabulary") if is_there(spark, f"{path}/vocabulary/_SUCCESS") else None
    return spark.read.parquet(f"{path}/keys"), vocabulary, spark.read.parquet(f"{path}/sources")


def remove_index(spark: SparkSession, path: str) -> bool:
    """Deletes an index, whole or not; tells whether there was one."""
    if not any(is_there(spark, f"{path}/{part}") for part in ("keys", "vocabulary", "sources")):
        return False
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_shards(records: DataFrame, path: str, shards: int, id_column: str = "entity_id") -> DataFrame:
    """Records in as many folders by a hash of their ids, and what each holds: shard, source, n. A later read of one shard leaves the others out."""
    shard = F.pmod(F.xxhash64(id_column), F.lit(shards)).cast("int")
    rows = records.withColumn("shard", shard)
    rows.repartition("shard").write.mode("errorifexists").partitionBy("shard").parquet(path)
    back = records.sparkSession.read.schema(rows.schema).parquet(path)
    return back.groupBy("shard", F.substring(id_column, 1, 2).alias("source")).agg(F.count("*").alias("n"))


def last_of_each(records: DataFrame, order: str, id_column: str = "entity_id") -> DataFrame:
    """Of rows that share an id, the last by a column that tells their order."""
    columns = [c for c in records.columns if c != id_column]
    return records.groupBy(id_column).agg(F.max_by(F.struct(*columns), order).alias("r")).select(id_column, *[F.col(f"r.{c}").alias(c) for c in columns])
