"""Extract files, partitioned tables, audit and report outputs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from comptoir.schemas import MOVE_LINE_FILE

# fixed value: what an extract holds
EXTRACT_MODEL = "stock.move.line"


def read_move_lines(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Move lines of gzipped JSON-lines files, with the file each came from.

    One gzip file is one task however large it is, so ``partitions`` can spread
    the rows out again before the parsing and hashing that follow.
    """
    df = spark.read.schema(MOVE_LINE_FILE).json(path)
    df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df.repartition(partitions) if partitions else df


def latest_file(spark: SparkSession, inbox: str, pattern: str = "*.gz") -> str | None:
    """Newest extract of an inbox: a file, or the folder of a many-part extract.

    Names carry the extract time, so the greatest is the newest. Files are
    listed without reading their contents, and one value comes back.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(inbox)
    )
    newest = files.agg(F.max("path").alias("path")).first()["path"]
    if newest is None:
        return None
    folder = newest.rsplit("/", 1)[0]
    return newest if folder.rstrip("/").endswith(inbox.rstrip("/")) else folder


def write_extract(df: DataFrame, out_dir: str, run_ts: datetime, since: datetime, filter_done: bool = True) -> str:
    """Write one extract and its manifest; returns the folder of the data files.

    Rows are counted while they are written. A ``raw`` that is no JSON stays as text.
    """
    spark = df.sparkSession
    base = f"stock_move_line_{run_ts:%Y%m%d_%H%M%S}"
    data_dir = f"{out_dir}/{base}"
    as_text = F.to_variant_object(F.struct(F.col("raw").alias("text"))) if "raw" in df.columns else None
    nested = df
    if as_text is not None:
        parsed = F.try_parse_json("raw")
        nested = df.withColumn("raw", F.coalesce(parsed, F.variant_get(as_text, "$.text", "variant")))
    seen = Observation()
    counted = nested.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("ignoreNullFields", "false").json(data_dir, compression="gzip")
    manifest = (
        spark.range(1)
        .select(
            F.lit(EXTRACT_MODEL).alias("model"),
            F.lit(f"{run_ts:%Y-%m-%d %H:%M:%S}").alias("created_at_utc"),
            F.lit(f"{since:%Y-%m-%d %H:%M:%S}").alias("extract_since_utc"),
            F.lit(filter_done).alias("filter_done"),
            F.lit(seen.get["rows"]).alias("rows"),
            F.lit(base).alias("data_file"),
        )
    )
    manifest.write.json(f"{out_dir}/manifests/{base}")
    return data_dir


def write_partitioned(
    df: DataFrame, path: str, day_col: str, grain: str = "day", mode: str = "overwrite"
) -> None:
    """Table split by day or by month; an overwrite touches only the parts it brings.

    Rows are rebalanced by partition value: AQE joins small partitions into one
    file and splits large ones, so a day holding much of the data has several writers.
    """
    if grain not in ("day", "month"):
        raise ValueError("grain must be 'day' or 'month'")
    part = day_col
    if grain == "month":
        part = "part_month"
        df = df.withColumn(part, month_of(F.col(day_col)))
    (
        df.hint("rebalance", part)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def month_of(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def read_day_range(spark: SparkSession, path: str, day_col: str, from_day: date, to_day: date) -> DataFrame:
    """Days ``[from_day, to_day]`` of a month-split table; prunes by month too."""
    return spark.read.parquet(path).filter(
        F.col("part_month").between(int(f"{from_day:%Y%m}"), int(f"{to_day:%Y%m}"))
        & F.col(day_col).between(F.lit(from_day), F.lit(to_day))
    )


def write_audit(df: DataFrame, path: str, ts: str, key: str) -> None:
    """Touched rows in time order as CSV with a header."""
    (
        df.select(key, ts, *[c for c in df.columns if c not in (key, ts)])
        .orderBy(F.col(ts).asc_nulls_last(), F.col(key).asc_nulls_last())
        .write.mode("overwrite").option("header", True).csv(path)
    )


def write_report(df: DataFrame, path: str, day_col: str, fmt: str = "parquet", grain: str = "month") -> None:
    """Put a report in place of what was stored for its months, or for its days."""
    part = f"report_{grain}"
    day = F.col(day_col).cast("date")
    (
        df.withColumn(part, month_of(day) if grain == "month" else day)
        .hint("rebalance", part)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(part)
        .format(fmt)
        .save(path)
    )
