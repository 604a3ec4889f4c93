"""Reading entity tables: tab-separated files of strings, Parquet, and views derived from other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
GROUND_TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


#: How tab-separated files are written, for readers of tables and of streams alike.
TSV = {"sep": "\t", "header": "true", "quote": '"', "escape": '"', "nullValue": "", "inferSchema": "false"}


def broken_lines(spark: SparkSession, path: str) -> int:
    """Lines with an odd number of quotes: values that go on in the next line. By such files read_tsv() needs multi_line."""
    return spark.read.text(path).where("((length(value) - length(replace(value, '\"', ''))) & 1) = 1").count()


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD, multi_line: bool = False, strict: bool = True) -> DataFrame:
    """A tab-separated file with a header, all columns strings, empty strings as nulls; further columns than the schema's are read too. Where one of these is missing it raises, or, if not strict, is null.

    Files are read by lines, in as many tasks as their size asks for. multi_line: values may hold line breaks, and each file is one task."""
    found = spark.read.options(**TSV).option("multiLine", multi_line).csv(path)
    missing = [f.name for f in schema if f.name not in found.columns]
    if missing and strict:
        raise ValueError(f"{path} has no columns {missing}")
    return found.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else found


def read_source(spark: SparkSession, root: str, split: str, number: int, multi_line: bool = False) -> DataFrame:
    """One of the three sources of a split."""
    return read_tsv(spark, f"{root}/{split}/source{number}.tsv", multi_line=multi_line)


def read_ground_truth(spark: SparkSession, root: str, split: str = "train") -> DataFrame:
    return read_tsv(spark, f"{root}/{split}/ground_truth.tsv", GROUND_TRUTH)


def record_of(records: DataFrame, entity_id: str, id_column: str = "entity_id") -> dict | None:
    """One record by its id, None if there is none; of several the first by all columns."""
    row = records.where(F.col(id_column) == entity_id).orderBy(*records.columns).first()
    return row.asDict() if row else None


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Some columns and rows of Parquet files; both reach the scan."""
    found = spark.read.parquet(path)
    found = found.where(where) if where else found
    return found.select(*columns) if columns else found


def load_sources(spark: SparkSession, root: str, split: str = "train", multi_line: bool = False) -> dict[str, DataFrame]:
    """source1, source2, source3 and, of a training split, ground_truth, lazily."""
    found = {f"source{i}": read_source(spark, root, split, i, multi_line) for i in (1, 2, 3)}
    if split == "train":
        found["ground_truth"] = read_ground_truth(spark, root, split)
    return found


def random_sample(df: DataFrame, n: int, seed: int = 42, id_column: str = "entity_id") -> DataFrame:
    """n rows by the order of a hash of their ids, so the same ones whatever the partitions."""
    return df.orderBy(F.xxhash64(F.col(id_column), F.lit(seed)), id_column).limit(n)


def first_rows(df: DataFrame, n: int, id_column: str = "entity_id") -> DataFrame:
    """The n first rows by id."""
    return df.orderBy(id_column).limit(n)


def ground_truth_for(gt: DataFrame, ids: DataFrame) -> DataFrame:
    """s1_id, true_ids for each of ids (s1_id); an empty array for those without an entry."""
    from ..operators.pairs import parse_ground_truth

    return ids.select("s1_id").distinct().join(parse_ground_truth(gt), "s1_id", "left").select("s1_id", F.coalesce("true_ids", F.array().cast("array<string>")).alias("true_ids"))


# Entity tables made of the table part, in SQL that Spark and DuckDB both take.
VIEWS = {
    "s1": """select concat('S1-', cast(p_partkey as varchar(20))) as entity_id,
 concat(p_name, ' ', lower(replace(p_brand,'#','')), ' ', cast(p_partkey % 97 as varchar(20)),
   case p_partkey % 4 when 0 then ' LLC' when 1 then ', Inc.' when 2 then ' Pvt Ltd' else '' end) as business_name,
 concat(cast(100 + p_partkey % 900 as varchar(20)), ' ', p_type, ' St, Suite ', cast(p_size as varchar(20)), ', ', cast(10000 + p_partkey % 89999 as varchar(20))) as business_address,
 case p_partkey % 3 when 0 then 'USA' when 1 then 'india' else 'FR' end as country
 from part""",
    "s2": """select concat('S2-', cast(p_partkey as varchar(20))) as entity_id,
 concat(upper(p_name), ' ', lower(replace(p_brand,'#','')), ' ', cast(p_partkey % 97 as varchar(20)),
   case p_partkey % 2 when 0 then ' Limited' else '' end) as business_name,
 case when p_partkey % 7 = 0 then '<NULL>' else concat(cast(100 + p_partkey % 900 as varchar(20)), ' ', p_type, ' Street, ', cast(10000 + p_partkey % 89999 as varchar(20))) end as business_address,
 case p_partkey % 3 when 0 then 'US' when 1 then 'India' else 'france' end as country
 from part where p_partkey % 5 <> 0""",
    "s3": """select concat('S3-', cast(p_partkey as varchar(20))) as entity_id,
 concat('www.', replace(p_name,' ','-'), lower(replace(p_brand,'#','')), cast(p_partkey % 97 as varchar(20)), '.com') as business_name,
 case when p_partkey % 4 = 0 then cast(null as varchar(20)) else concat(p_type, ' st ', cast(100 + p_partkey % 900 as varchar(20))) end as business_address,
 case when p_partkey % 11 = 0 then 'n/a' else 'us' end as country
 from part where p_partkey % 3 = 0""",
    "gt": """select concat('S1-', cast(p_partkey as varchar(20))) as source1_entity_id,
 case when p_partkey % 5 <> 0 and p_partkey % 3 = 0 then concat('S2-', cast(p_partkey as varchar(20)), ',S3-', cast(p_partkey as varchar(20)))
      when p_partkey % 5 <> 0 then concat('S2-', cast(p_partkey as varchar(20)))
      when p_partkey % 3 = 0 then concat('S3-', cast(p_partkey as varchar(20)))
      else '' end as matched_entity_ids
 from part""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(VIEWS[name].replace("from part", "from {part}"), part=part)


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 and S3 together."""
    return view(spark, sf_dir, "s2").unionByName(view(spark, sf_dir, "s3"))
