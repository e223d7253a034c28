"""Readers and writers: JSON Lines, CSV seed, parquet marts.

All readers take a declared schema; nothing is inferred at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.session import STORED_CODEC, shuffles_dropped
from trendspark.sources.files import path_has_data
from trendspark.sources.schemas import RAW_TABLES, SEED_CHAMPIONS, TABLE_KEYS
from trendspark.sources.upsert import newest_per_key

CORRUPT = "_corrupt_record"
REJECT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("line", "reason", "file")])


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def parse_tagged(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines (column ``value``) -> the declared fields and ``_reject``, null where a line fits.

    Each line is parsed in one expression with all declared fields, so which lines fit
    does not depend on the columns read later. A line that does not fit has null fields
    and its text and reason in ``_reject``. Blank lines give no row. Other columns of
    ``lines`` are kept.
    """
    others = [c for c in lines.columns if c != "value"]
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = (lines.where(F.trim("value") != "")
              .withColumn("_row", F.from_json("value", full, options)))
    bad = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull()
    is_object = F.from_json("value", "map<string,string>").isNotNull()
    reject = F.struct(F.col("value").alias("line"),
                      F.when(is_object, "a field does not fit its type").otherwise("not a JSON object").alias("reason"))
    return parsed.select(*[F.when(~bad, F.col(f"_row.`{f.name}`")).alias(f.name) for f in schema.fields], *others,
                         F.when(bad, reject).alias("_reject"))


def rows_that_fit(tagged: DataFrame) -> DataFrame:
    return tagged.where("_reject IS NULL").drop("_reject")


def rejected_lines(tagged: DataFrame) -> DataFrame:
    """(line, reason, file) of the lines that do not fit."""
    file = F.col("_file") if "_file" in tagged.columns else F.lit(None).cast("string")
    return tagged.where("_reject IS NOT NULL").select("_reject.line", "_reject.reason", file.alias("file"))


def parse_lines(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Lines (column ``value``) -> rows that fit the schema, and rejects with a reason."""
    tagged = parse_tagged(lines, schema)
    return rows_that_fit(tagged), rejected_lines(tagged)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               with_rejects: bool = False, with_file: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Newline-delimited JSON scan with a declared schema.

    A missing or empty path yields an empty typed frame. Lines that do not fit are kept
    out of the result; with ``with_rejects`` they are returned as a second frame (line,
    reason, file). ``with_file`` adds ``_landed`` and ``_file``, which order landed files.
    """
    landed = [T.StructField("_landed", T.TimestampType()), T.StructField("_file", T.StringType())]
    if not path_has_data(spark, path):
        good = empty_frame(spark, T.StructType([*schema.fields, *(landed if with_file else [])]))
        return (good, empty_frame(spark, REJECT_SCHEMA)) if with_rejects else good
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file"))
    good, rejects = parse_lines(lines, schema)
    good = good if with_file else good.drop("_landed", "_file")
    return (good, rejects) if with_rejects else good


def read_landed(spark: SparkSession, landing_root: str, table: str) -> DataFrame:
    """One landed raw table as ``parse_tagged`` rows with ``_landed`` and ``_file``; one listing, one parse.

    Store it once (``session.materialize``) and take rows and rejects from the stored
    rows: a file that lands meanwhile is then in neither of them.
    """
    path = f"{landing_root.rstrip('/')}/{table}"
    if not path_has_data(spark, path):
        reject = T.StructType([T.StructField("line", T.StringType()), T.StructField("reason", T.StringType())])
        return empty_frame(spark, T.StructType([
            *RAW_TABLES[table].fields, T.StructField("_landed", T.TimestampType()), T.StructField("_file", T.StringType()),
            T.StructField("_reject", reject)]))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file"))
    return parse_tagged(lines, RAW_TABLES[table])


def newest_landed(tagged: DataFrame, table: str) -> DataFrame:
    """The raw table of ``read_landed`` rows: its files upserted in landing order by key."""
    return newest_per_key(rows_that_fit(tagged), TABLE_KEYS[table], ["_landed", "_file"]).drop("_landed", "_file")


def read_raw(spark: SparkSession, landing_root: str, table: str) -> DataFrame:
    """One landed raw table (``<root>/<table>``): its files upserted in landing order by key."""
    return newest_landed(read_landed(spark, landing_root, table), table)


def read_rejects(spark: SparkSession, landing_root: str, table: str) -> DataFrame:
    """The lines of a landed raw table that do not fit its schema."""
    return rejected_lines(read_landed(spark, landing_root, table))


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """Land rows as JSON Lines; null fields are written, non-ASCII kept as is.

    The readers take compressed files (``gzip``) like plain ones."""
    (df.write.mode("overwrite")
     .option("ignoreNullFields", "false").option("compression", compression)
     .json(path))


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_CHAMPIONS) -> DataFrame:
    """CSV reference table with header; blank cells are null, text 'None' stays text."""
    return (spark.read.option("header", True)
            .option("nullValue", "")
            .option("emptyValue", None)
            .schema(schema).csv(path))


def write_seed(df: DataFrame, path: str, order_by: str = "champion_id") -> None:
    """CSV with header; the files, read in name order, hold the rows in order of the id."""
    (df.orderBy(order_by).write.mode("overwrite")
     .option("header", True).csv(path))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full-rebuild materialisation of a mart as parquet; old partitions go."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", STORED_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)


def write_entity_table(df: DataFrame, path: str, entity: str, order: list[str], dealt: bool = False) -> None:
    """Full-rebuild of a mart that is read one entity at a time.

    Rows are range-partitioned and sorted by the entity, then ``order``, so an entity lies in
    one file, or in neighbouring ones if it holds very many rows; files and row groups that
    cannot hold it are skipped by their minima and maxima, and by a bloom filter of the entity.
    ``dealt``: the rows come in ranges of the entity already (``joins.spread_by_range``) and
    are only sorted. Spark runs the input of a range exchange twice, once for its ranges.
    """
    keys = [entity, *order]
    with shuffles_dropped(df.sparkSession):
        ((df if dealt else df.repartitionByRange(*keys)).sortWithinPartitions(*keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").option("compression", STORED_CODEC)
         .option(f"parquet.bloom.filter.enabled#{entity}", "true")
         .option(f"parquet.bloom.filter.adaptive.enabled#{entity}", "true").parquet(path))
