"""Records that arrive in files: key table, vocabulary and resumable feature batches by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import tokens
from ..operators.keys import V1, Blocking, blocking_keys, token_vocabulary
from ..operators.preprocess import preprocess
from ..sources.tables import RECORD, TSV


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    """Tab-separated record files as they come into a folder, read like read_tsv()."""
    return spark.readStream.schema(RECORD).options(**{k: v for k, v in TSV.items() if k != "inferSchema"}).option("maxFilesPerTrigger", files_per_batch).csv(folder)


def ingest_keys(stream: DataFrame, key_path: str, record_path: str, checkpoint: str, config: Blocking = V1) -> StreamingQuery:
    """Writes each batch's preprocessed records and keys, in a folder of the batch's number that a repeated batch replaces, so a run that was cut off can go on. Ends when the folder is read."""

    def write(batch: DataFrame, number: int) -> None:
        ready = preprocess(batch)
        ready.write.mode("overwrite").parquet(f"{record_path}/batch={number}")
        read = batch.sparkSession.read.parquet(f"{record_path}/batch={number}")
        blocking_keys(read, config).write.mode("overwrite").parquet(f"{key_path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str, id_column: str = "entity_id") -> DataFrame:
    """Of ingested records or keys, those of the last batch that has the id: an id that comes again replaces what it had."""
    rows = spark.read.parquet(path)
    last = rows.groupBy(id_column).agg(F.max("batch").alias("batch"))
    return rows.join(last, [id_column, "batch"], "left_semi").drop("batch")


def check_count(rows: DataFrame, expected: int) -> None:
    """Raises unless there are just so many rows: what was ingested for a training must be all of it."""
    n = rows.count()
    if n != expected:
        raise ValueError(f"{n} rows instead of {expected}; the ingest is not complete")


def add_documents(state: DataFrame | None, records: DataFrame, name_column: str = "name_norm", least: int = 2) -> DataFrame:
    """token, df, n_records: document frequencies of a state (or none) and of further records; token_idf of both at once is idf_of() of it."""
    words = records.select(F.explode(F.array_distinct(tokens(F.coalesce(name_column, F.lit(""))))).alias("token")).where(F.length("token") >= least)
    new = words.groupBy("token").agg(F.count("*").alias("df")).crossJoin(F.broadcast(records.agg(F.count("*").alias("n_records"))))
    if state is None:
        return new
    both = state.unionByName(new).groupBy("token").agg(F.sum("df").alias("df"))
    # one row on each side: what both saw together
    n = state.agg(F.max("n_records").alias("a")).crossJoin(records.agg(F.count("*").alias("b"))).select((F.coalesce("a", F.lit(0)) + F.col("b")).alias("n_records"))
    return both.crossJoin(F.broadcast(n))


def idf_of(state: DataFrame) -> DataFrame:
    """token, df, idf: as token_idf() has it of all records at once."""
    return state.select("token", "df", F.log(1 + (F.col("n_records") + 1) / (F.col("df") + 1)).alias("idf"))


def vocabulary_stream(stream: DataFrame, config: Blocking) -> DataFrame:
    """token, n, kept up as records come: a streaming aggregation for complete or update mode."""
    return token_vocabulary(preprocess(stream), config)


def merge_counts(*parts: DataFrame, key: str = "token", count: str = "n") -> DataFrame:
    """Counts of several batches as one."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(key).agg(F.sum(count).alias(count))


def remaining(batches: DataFrame, done: DataFrame, key: str = "s1_id") -> DataFrame:
    """What is still to do: rows whose key isn't in what was written."""
    return batches.join(done.select(key).distinct(), key, "left_anti")
