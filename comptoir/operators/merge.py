"""Write semantics on plain Parquet.

The merges are pure functions ``(target, source) -> new target``. ``store`` turns
one into a table change: it rewrites only the partitions the batch touches, and
never overwrites files that the same plan reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from comptoir.functions.measures import as_date
from comptoir.operators.skew import row_salt
from comptoir.operators.windows import dedup_latest
from comptoir.session import SHUFFLE_CLEANUP, scratch_path, shuffle_cleanup, write_scratch  # noqa: F401


def _merged_column(c: str, keys: Sequence[str], updates: set[str], keep: set[str], s: Column, t: Column,
                   matched: Column, source_only: Column) -> Column:
    if c in keys:
        return F.coalesce(t, s)
    if c in keep:
        return F.coalesce(s, t)
    if c in updates:
        return F.when(matched | source_only, s).otherwise(t)
    return F.when(source_only, s).otherwise(t)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    update_cols: Sequence[str] | None = None, keep_if_null: Sequence[str] = (),
    insert_only: Sequence[str] = (), delta: bool = False, latest: tuple[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Insert new keys, overwrite known ones. A key that the source repeats is an error at run time; keys with
    a missing part match nothing and may repeat.

    ``update_cols`` limits what changes on a match, ``insert_only`` names columns
    the old row keeps, and ``keep_if_null`` columns are never erased.

    The default is one full outer join: both sides shuffle once. With ``delta``
    the source is expected to be far smaller than the target: the target is
    streamed past the source, which Spark broadcasts while it is small, so the
    target is not shuffled.

    With ``latest``, a time and the columns that decide among equal times, the
    source may hold versions of a key, and the one ``dedup_latest`` keeps is
    merged. The choice, the check and the join then share one shuffle of the source.
    """
    keys = list(keys)
    cols = target.columns
    updates = set(update_cols if update_cols is not None else cols) - set(keys) - set(insert_only)
    keep = set(keep_if_null)
    source = _checked(source if latest is None else _latest(source, keys, *latest), keys)
    src = source.select(
        *[(F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)).alias(f"s_{c}")
          for c in cols],
        F.col("__apart").alias("s___apart"), F.lit(True).alias("__s"),
    )
    tgt = target.withColumn("__apart", _apart(target, keys)).select(
        *[F.col(c).alias(f"t_{c}") for c in cols], F.col("__apart").alias("t___apart"), F.lit(True).alias("__t"),
    )
    same = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in (*keys, "__apart")])
    in_s, in_t = F.col("__s").isNotNull(), F.col("__t").isNotNull()

    def merged(df: DataFrame) -> DataFrame:
        return df.select(*[
            _merged_column(c, keys, updates, keep, F.col(f"s_{c}"), F.col(f"t_{c}"), in_s & in_t, in_s & ~in_t)
            .cast(target.schema[c].dataType).alias(c)
            for c in cols
        ])

    if not delta:
        return merged(tgt.join(src, same, "full"))
    seen = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    new = source.join(seen, keys, "left_anti")
    new = new.select(*[
        (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in cols
    ])
    return merged(tgt.join(src, same, "left")).unionByName(new)


def _apart(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for a row with a whole key. Rows with a missing part match nothing: they get a number that deals them to
    many tasks, where one key of nulls would gather them in one."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hashed = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    return F.when(whole, F.lit(0)).otherwise(row_salt(hashed, 1024) + 1)


def _latest(source: DataFrame, keys: Sequence[str], ts: str, seq: Sequence[str]) -> DataFrame:
    """The latest version of each key, with ``__apart``, grouped by all that the join is on, so that nothing is shuffled
    again there. One row at most is left of a key with missing parts, so these need no dealing."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    apart = F.when(whole, F.lit(0)).otherwise(1).cast("bigint")  # the type of the target's, so that the join casts nothing
    return dedup_latest(source.withColumn("__apart", apart), [*keys, "__apart"], ts, seq)


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return _has_map(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, (MapType, VariantType))


def _checked(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with ``__apart``; a key that repeats is an error. The error stands in a filter, which decides about
    rows, so no plan can do without it, whichever columns it reads."""
    apart = source if "__apart" in source.columns else source.withColumn("__apart", _apart(source, keys))
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__apart"))
    error = F.raise_error(F.lit(f"the source of a merge repeats a key of {', '.join(keys)}")).cast("boolean")
    return apart.withColumn("__times", times).filter(F.when((F.col("__apart") == 0) & (F.col("__times") > 1), error).otherwise(True)).drop("__times")


def retire_missing(
    target: DataFrame, source: DataFrame, key: str, flag: str = "is_current",
    stamp: str | None = None, as_of: Column | None = None,
) -> DataFrame:
    """Current rows that a full extract no longer has are flagged as not current."""
    present = source.select(key).distinct().withColumn("__present", F.lit(True))
    out = target.join(present, key, "left")
    retire = F.col(flag) & F.col("__present").isNull()
    changed = {flag: F.when(retire, F.lit(False)).otherwise(F.col(flag))}
    if stamp and as_of is not None:
        changed[stamp] = F.when(retire, as_of).otherwise(F.col(stamp))
    return out.withColumns(changed).select(*target.columns)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    return target.unionByName(batch, allowMissingColumns=True)


def reload_window(target: DataFrame, batch: DataFrame, day_col: str, from_day: date | str) -> DataFrame:
    """Days from ``from_day`` on come from the batch alone, cut at the same day."""
    cut = as_date(from_day)
    return append(target.filter(F.col(day_col) < cut), batch.filter(F.col(day_col) >= cut))


def replace_day(target: DataFrame, snapshot: DataFrame, day_col: str, day: date | str) -> DataFrame:
    """The snapshot stands in for whatever was stored for its day."""
    keep = target.filter((F.col(day_col) != as_date(day)) | F.col(day_col).isNull())
    return append(keep, snapshot.filter(F.col(day_col) == as_date(day)))


def purge_from(target: DataFrame, day_col: str, day: date | str) -> DataFrame:
    """Without rows dated on or after the day; undated rows stay."""
    return target.filter((F.col(day_col) < as_date(day)) | F.col(day_col).isNull())


def retention_cutoff(as_of: date | str, keep_days: int | None = None, keep_months: int | None = None) -> Column:
    """First day kept: some days back, or some months before the month's start."""
    as_of = as_date(as_of)
    if keep_days is not None:
        return F.date_sub(as_of, keep_days)
    return F.add_months(F.trunc(as_of, "month"), -(12 if keep_months is None else keep_months))


def apply_retention(
    df: DataFrame, day_col: str, as_of: date | str, keep_days: int | None = None, keep_months: int | None = None
) -> DataFrame:
    return df.filter(F.col(day_col) >= retention_cutoff(as_of, keep_days, keep_months))


# ---- tables ---------------------------------------------------------------

def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def store(
    spark: SparkSession, path: str, batch: DataFrame, part_col: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Change the partitions of a table that the batch touches.

    The batch is written once to the shared folder, the merge result of the
    touched partitions once more, and only then the table is overwritten from
    there, part by part. A failed run leaves the table as it was, or can be
    repeated with the same batch.
    """
    staged = scratch_path(spark, "batch")
    write_scratch(batch, staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    target = read_or_empty(spark, path, table_schema(spark, path, batch, part_col))
    merged = merge(touched_parts(target, batch, part_col), batch)
    lost = [c for c in target.columns if c not in merged.columns]
    if lost:
        raise ValueError(f"the merge would lose the table's columns {lost}")
    merged_path = scratch_path(spark, "merged")
    write_scratch(merged, merged_path)
    overwrite_parts(spark.read.schema(merged.schema).parquet(merged_path), path, part_col, in_turn=True)
    for used in (staged, merged_path):
        remove(spark, used)


INTENT = "_comptoir_intent"
MERGES = 8
"""Merges that a store by file is split into, at most."""
MERGE_ROWS = 1_000_000
"""Rows that are not worth a merge of their own."""


def store_by_file(
    spark: SparkSession, path: str, batch: DataFrame, part_col: str, keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> dict[str, int]:
    """Change a keyed table by rewriting only the files that hold a key of the batch; returns how many files went and
    how many came.

    The keys, which include the partition column, are looked up in the partitions that the batch touches; the rows of
    the files they are found in are merged with the batch, and no other file is read in full or written. The merge is
    called for some partitions at a time, and the shuffles of one call are deleted before the next, so that a load that
    touches them all does not hold its rows on disk several times over. New files are written to the shared folder first. What is to change then goes into a file of intent beside the data, which
    readers skip: a run that breaks off after that is completed by the next one, so files are never lost or doubled.
    The shuffle files of the batch's and the merge's writes are deleted as each write ends.
    """
    with shuffle_cleanup(spark):
        return _store_by_file(spark, path, batch, part_col, keys, merge)


def _store_by_file(
    spark: SparkSession, path: str, batch: DataFrame, part_col: str, keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> dict[str, int]:
    complete_store(spark, path)
    staged = scratch_path(spark, "batch")
    write_scratch(batch, staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    fs, root = file_system(spark, path)
    fs.mkdirs(root)
    stored = spark.read.schema(table_schema(spark, path, batch, part_col)).parquet(path).withColumn("__file", F.col("_metadata.file_path"))
    target = touched_parts(stored, batch, part_col)
    hit = target.select(*keys, "__file").join(batch.select(*keys), list(keys), "left_semi")
    old = sorted(r[0] for r in hit.select("__file").distinct().collect())  # names that the job deletes one by one
    target = stored.filter(F.col("_metadata.file_path").isin(*old)).drop("__file")
    written = scratch_path(spark, "files")
    for chosen in _in_turn(part_col, target, batch):
        merged = merge(target.filter(chosen), batch.filter(chosen))
        lost = [c for c in target.columns if c not in merged.columns]
        if lost:
            raise ValueError(f"the merge would lose the table's columns {lost}")
        merged.hint("rebalance", part_col).write.mode("append").partitionBy(part_col).parquet(written)
    out = fs.create(_hadoop(spark, f"{path}/{INTENT}.tmp"), True)
    out.write(bytearray("\n".join([written, *old]).encode()))
    out.close()
    fs.rename(_hadoop(spark, f"{path}/{INTENT}.tmp"), _hadoop(spark, f"{path}/{INTENT}"))
    came = complete_store(spark, path)
    remove(spark, staged)
    return {"replaced": len(old), "written": came}


def _in_turn(part_col: str, *frames: DataFrame) -> list[Column]:
    """Conditions that share out the partitions of the frames among a few jobs of about as many rows each; one for a
    small load."""
    parts = reduce(lambda a, b: a.unionByName(b), [df.select(part_col) for df in frames])
    rows = dict(parts.groupBy(part_col).count().collect())
    most, groups, held = max(MERGE_ROWS, -(-sum(rows.values()) // MERGES)), [[]], 0
    for value in sorted(rows, key=lambda v: (v is not None, v)):
        if groups[-1] and held + rows[value] > most:
            groups.append([])
            held = 0
        groups[-1].append(value)
        held += rows[value]
    named = [F.col(part_col).isin(*[v for v in g if v is not None]) for g in groups]
    return [c | F.col(part_col).isNull() if None in g else c for c, g in zip(named, groups)]


def complete_store(spark: SparkSession, path: str) -> int:
    """Do what a file of intent says, if there is one: old files go, new ones take their place. Each step can be done
    again. Returns how many files came."""
    fs, root = file_system(spark, path)
    intent = _hadoop(spark, f"{path}/{INTENT}")
    if not fs.exists(intent):
        return 0
    written, *old = bytes(fs.open(intent).readAllBytes()).decode().split("\n")
    uri = spark.sparkContext._jvm.java.net.URI
    for name in old:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri(name)), False)
    came, source = 0, _hadoop(spark, written)
    for part in fs.listStatus(source) if fs.exists(source) else []:
        if not part.isDirectory():
            continue
        folder = _hadoop(spark, f"{path}/{part.getPath().getName()}")
        fs.mkdirs(folder)
        for file in fs.listStatus(part.getPath()):
            came += fs.rename(file.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, file.getPath().getName()))
    fs.delete(intent, False)
    remove(spark, written)
    return came


def _hadoop(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = _hadoop(spark, path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def table_schema(spark: SparkSession, path: str, batch: DataFrame, part_col: str) -> StructType:
    """The schema of a stored table, which a batch need not cover; of a new one, the batch's.

    The partition column has the batch's type, as folder names hold no types.
    """
    try:
        stored = spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return batch.schema
    return StructType([batch.schema[part_col] if f.name == part_col else f for f in stored.fields])


def touched_parts(target: DataFrame, batch: DataFrame, part_col: str) -> DataFrame:
    """Target rows in the partitions the batch has rows for.

    The partition values become a literal list, by which the scan skips every other folder. There are no more
    of them than folders that the write will name, which Spark's driver lists in any case.
    """
    listed = [r[0] for r in batch.select(part_col).distinct().collect()]
    wanted = F.col(part_col).isin(*[v for v in listed if v is not None])
    return target.filter(wanted | F.col(part_col).isNull() if None in listed else wanted)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that only this job uses, on whatever file system it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def overwrite_parts(df: DataFrame, path: str, part_col: str, in_turn: bool = False) -> None:
    """Replace exactly the partitions that the frame has rows for; ``in_turn``, for a frame that is read from files,
    some at a time.

    The shuffle that groups rows by partition holds a whole copy of the frame; its files are deleted as soon as
    the write ends, instead of when the driver happens to collect its garbage, so that writes one after another
    do not pile those copies up on disk.
    """
    with shuffle_cleanup(df.sparkSession):
        for chosen in _in_turn(part_col, df) if in_turn else [F.lit(True)]:
            (
                df.filter(chosen).hint("rebalance", part_col)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(part_col).parquet(path)
            )


def rebuild(df: DataFrame, path: str) -> None:
    """Full refresh; the frame must not read from the path."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def drop_parts(spark: SparkSession, path: str, part_col: str, wanted: Callable[[str], bool]) -> list[str]:
    """Delete the partition folders whose value is ``wanted``; returns the values. Works on folder names alone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name, _, part = status.getPath().getName().partition("=")
        if name == part_col and part != "__HIVE_DEFAULT_PARTITION__" and wanted(part):
            fs.delete(status.getPath(), True)
            dropped.append(part)
    return sorted(dropped)


def drop_old_parts(spark: SparkSession, path: str, part_col: str, first_kept: str) -> list[str]:
    """Delete the partition folders of values before ``first_kept``; returns the values.

    Days as ``yyyy-MM-dd`` and months as ``yyyyMM`` both sort as text.
    """
    return drop_parts(spark, path, part_col, lambda part: part < str(first_kept))


def reload_parts(
    spark: SparkSession, path: str, batch: DataFrame, part_col: str, first: date | str, last: date | str | None = None
) -> list[str]:
    """The stored form of ``reload_window``, ``replace_day`` and ``purge_from``: partitions from ``first`` to ``last``
    (or on) come from the batch alone, and those that it leaves empty disappear; returns the latter.

    Only partitions in the range are written or deleted, and none is read. The batch is written to the shared
    folder first, so a run that breaks off can be repeated. Partition values sort as text.
    """
    inside = F.col(part_col).cast("string") >= str(first)
    if last is not None:
        inside = inside & (F.col(part_col).cast("string") <= str(last))
    staged = scratch_path(spark, "reload")
    write_scratch(batch.filter(inside), staged)
    held = spark.read.schema(batch.schema).parquet(staged)
    filled = {str(r[0]) for r in held.select(part_col).distinct().collect()}
    if filled:
        overwrite_parts(held, path, part_col, in_turn=True)
    emptied = drop_parts(
        spark, path, part_col,
        lambda part: part >= str(first) and (last is None or part <= str(last)) and part not in filled,
    )
    remove(spark, staged)
    return emptied
