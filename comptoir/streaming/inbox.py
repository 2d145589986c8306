"""File streams in place of repeated small loads.

The checkpoint of a stream remembers which files were taken, so a file is loaded
once even if the job is lost and started again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from comptoir.operators.merge import read_or_empty, store, touched_parts, upsert
from comptoir.operators.skew import splittable_join
from comptoir.operators.windows import dedup_latest, top_one
from comptoir.schemas import MOVE_LINE_FILE


def stream_inbox(
    spark: SparkSession, inbox: str, schema: str = MOVE_LINE_FILE, archive: str | None = None,
    files_per_trigger: int = 1000, fmt: str = "json", recursive: bool = True,
) -> DataFrame:
    """Files landing in a folder, optionally moved to an archive once loaded."""
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", str(recursive).lower())
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.format(fmt).load(inbox)


def known_keys(table: DataFrame, batch: DataFrame, keys: Sequence[str], day_col: str | None = None, lookback_days: int = 0) -> DataFrame:
    """Keys of a table that a batch may hold again.

    The batch is collected to the range of each key, by which the scan skips files and row groups. With ``day_col``,
    the table's partitions of the batch's days and ``lookback_days`` before are taken as they are. Older (and later) ones are
    streamed past the batch's keys by a semi join, where Spark broadcasts the batch while it is small and else
    prunes by a Bloom filter at run time, so that what is not in the batch is neither shuffled nor kept.
    """
    ends = batch.agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("low", F.min), ("high", F.max))], *([F.min(day_col).alias("__from"), F.max(day_col).alias("__to")] if day_col else [])).first()
    near = table
    for k in keys:
        if ends[f"low_{k}"] is not None:
            near = near.filter(F.col(k).between(F.lit(ends[f"low_{k}"]), F.lit(ends[f"high_{k}"])) | F.col(k).isNull())
    wanted = batch.select(*keys).distinct()
    if day_col is None or ends["__from"] is None:
        return splittable_join(near.select(*keys), wanted, keys, "left_semi", null_safe=True)
    recent = F.col(day_col).between(F.lit(ends["__from"] - timedelta(days=lookback_days)), F.lit(ends["__to"]))
    old = splittable_join(near.filter(~recent | F.col(day_col).isNull()).select(*keys), wanted, keys, "left_semi", null_safe=True)
    return near.filter(recent).select(*keys).unionByName(old)


def append_new(
    path: str, keys: Sequence[str], order: Sequence[str], part_col: str | None = None, lookback_days: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """One micro-batch into a table: the first row of each key by ``order``, unless the table has the key.

    The table itself is the memory, so no row is too late and a batch that is run twice adds nothing. A
    ``part_col`` that is a function of the key limits what is looked at to the partitions that the batch touches;
    with ``lookback_days`` it is a day that is none, and older partitions are looked at through the batch's keys.
    Rows with a missing key part equal each other, like any key.
    """
    keys = list(keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = top_one(batch, keys, list(order))
        known = read_or_empty(spark, path, batch.schema)
        if part_col and lookback_days is None:
            known = touched_parts(known, batch, part_col)
        known = known_keys(known, batch, keys, part_col if lookback_days is not None else None, lookback_days or 0)
        fresh = splittable_join(first, known.select(*keys).distinct(), keys, "left_anti", null_safe=True)
        writer = fresh.write.mode("append")
        (writer.partitionBy(part_col) if part_col else writer).parquet(path)

    return run


def stream_dedup(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], part_col: str | None = None,
    lookback_days: int | None = None,
) -> StreamingQuery:
    """Append what has arrived and is not yet in the table, then stop; deliveries may come in any order."""
    return (
        df.writeStream.foreachBatch(append_new(path, keys, order, part_col, lookback_days))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(df: DataFrame, path: str, checkpoint: str, part_col: str | None = None) -> StreamingQuery:
    """Append what has arrived to a table, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if part_col:
        writer = writer.partitionBy(part_col)
    return writer.trigger(availableNow=True).start(path)


def merge_batch(path: str, part_col: str, keys: Sequence[str], ts: str, seq: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """One micro-batch into a keyed table: latest version per key, then a merge.

    An older version never replaces a newer one, so a batch that is run twice,
    or arrives late, leaves the same table. A version without a time replaces the
    known one, as a plain overwrite would. The partition must be a function of the key.
    """
    keys = list(keys)

    def newest(target: DataFrame, batch: DataFrame) -> DataFrame:
        known = target.select(*keys, F.col(ts).alias("__old"))
        newer = F.col("__old").isNull() | F.col(ts).isNull() | (F.col(ts) >= F.col("__old"))
        fresh = batch.join(known, keys, "left").filter(newer)
        return upsert(target, fresh.drop("__old"), keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        store(batch.sparkSession, path, dedup_latest(batch, keys, ts, seq), part_col, newest)

    return run


def stream_upsert(
    df: DataFrame, path: str, checkpoint: str, part_col: str, keys: Sequence[str], ts: str, seq: Sequence[str]
) -> StreamingQuery:
    """Merge what has arrived into a keyed table, then stop."""
    return (
        df.writeStream.foreachBatch(merge_batch(path, part_col, keys, ts, seq))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
