"""Watermarks from an append-only run log: one row per run, none ever changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.measures import as_ts
from comptoir.operators.aggregates import DEFAULT_START
from comptoir.operators.sets import day_spine
from comptoir.schemas import RUN_LOG

# ---- fixed values -------------------------------------------------------
DEFAULT_ID = 0
DEFAULT_LOOKBACK_SEC = 7200
WATERMARK_TYPES = ("ts", "id")
RUNNING, SUCCESS, FAIL = "RUNNING", "SUCCESS", "FAIL"
ERROR_LENGTH = 4000
# -------------------------------------------------------------------------


def _seconds(c: Column) -> Column:
    return F.make_dt_interval(secs=c)


def current_watermark(runs: DataFrame) -> DataFrame:
    """Where each enabled job stands: the greatest pair of its successful runs.

    Settings are those of the latest run, whatever its outcome.
    """
    # a run reporting only one half counts with the default for the other
    ts = F.coalesce("watermark_ts", as_ts(DEFAULT_START))
    key = F.coalesce("watermark_id", F.lit(DEFAULT_ID).cast("bigint"))
    reported = (F.col("status") == SUCCESS) & (F.col("watermark_ts").isNotNull() | F.col("watermark_id").isNotNull())
    start = F.struct(as_ts(DEFAULT_START).alias("ts"), F.lit(DEFAULT_ID).cast("bigint").alias("id"))
    latest = F.struct("started_at", "ended_at", "status")
    kind = F.lower(F.trim(F.coalesce("watermark_type", F.lit("ts"))))
    state = runs.groupBy("job_name").agg(
        F.max(F.when(reported, F.struct(ts.alias("ts"), key.alias("id")))).alias("top"),
        F.max_by(F.struct(kind.alias("kind"), "lookback_sec", "is_enabled"), latest).alias("conf"),
    )
    top = F.greatest("top", start)
    return state.filter(F.coalesce("conf.is_enabled", F.lit(True))).select(
        "job_name",
        F.when(F.col("conf.kind").isin(*WATERMARK_TYPES), F.col("conf.kind"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown watermark type of job "), "job_name")))
        .alias("watermark_type"),
        top["ts"].alias("watermark_ts"),
        top["id"].alias("watermark_id"),
        F.coalesce("conf.lookback_sec", F.lit(DEFAULT_LOOKBACK_SEC)).alias("lookback_sec"),
    )


def run_history(runs: DataFrame) -> DataFrame:
    """Last run of each job."""
    last = F.max_by(
        F.struct("started_at", "ended_at", "status", "row_count", F.substring("error", 1, ERROR_LENGTH).alias("error")),
        F.struct("started_at", "ended_at", "status"),
    )
    return runs.groupBy("job_name").agg(last.alias("r"), F.count(F.lit(1)).alias("runs")).select(
        "job_name",
        "runs",
        F.col("r.started_at").alias("last_run_started"),
        F.col("r.ended_at").alias("last_run_ended"),
        F.col("r.status").alias("last_run_status"),
        F.col("r.row_count").alias("last_run_rows"),
        F.when(F.col("r.status") == FAIL, F.col("r.error")).alias("last_error"),
    )


def advance(state: DataFrame, reached: DataFrame, status: Column | str = SUCCESS) -> DataFrame:
    """Move each job's pair up to what a successful run reached, never back.

    ``reached`` has ``job_name, new_ts, new_id`` and may have its own ``status``.
    """
    status = F.col("status") if "status" in reached.columns else (F.lit(status) if isinstance(status, str) else status)
    floor_ts, floor_id = as_ts(DEFAULT_START), F.lit(DEFAULT_ID).cast("bigint")
    old = F.struct(
        F.coalesce("watermark_ts", floor_ts).alias("ts"), F.coalesce("watermark_id", floor_id).alias("id")
    )
    new = F.struct(F.coalesce("new_ts", floor_ts).alias("ts"), F.coalesce("new_id", floor_id).alias("id"))
    moved = state.join(reached.withColumn("__ok", status == SUCCESS), "job_name", "left").withColumn(
        "__top", F.when(F.col("__ok"), F.greatest(old, new)).otherwise(old)
    )
    return moved.withColumns({"watermark_ts": F.col("__top.ts"), "watermark_id": F.col("__top.id")}).select(
        *state.columns
    )


def since(state: DataFrame) -> DataFrame:
    """Time to read from: the watermark less the lookback."""
    return state.withColumn("since_ts", F.col("watermark_ts") - _seconds(F.col("lookback_sec")))


def resolve_since(state: DataFrame, mode: str = "incremental", floor: datetime | str | None = None) -> DataFrame:
    """Start pair of a run. A full catch-up starts at the floor; else a start
    before the floor is raised to it, with id 0."""
    at_floor = as_ts(floor if floor is not None else DEFAULT_START)
    zero = F.lit(0).cast("bigint")
    if mode == "full_catchup":
        return since(state).withColumns({"since_ts": at_floor, "since_id": zero})
    out = since(state).withColumn("since_id", F.col("watermark_id"))
    if floor is None:
        return out
    early = F.col("since_ts") < at_floor
    return out.withColumns({
        "since_id": F.when(early, zero).otherwise(F.col("since_id")),
        "since_ts": F.greatest("since_ts", at_floor),
    })


def since_from_target(
    target: DataFrame, col: str, buffer: str, as_of: datetime | str | None = None, lookback: str = "INTERVAL 7 DAYS"
) -> DataFrame:
    """Start taken from what is loaded: the greatest time less a buffer.

    An empty target starts some days before ``as_of``, less the buffer too, or
    at the default start when no ``as_of`` is given.
    """
    top = F.max(col)
    if as_of is None:
        return target.agg(F.coalesce(top - F.expr(buffer), as_ts(DEFAULT_START)).alias("since_ts"))
    return target.agg((F.coalesce(top, as_ts(as_of) - F.expr(lookback)) - F.expr(buffer)).alias("since_ts"))


def footer_max(spark: SparkSession, path: str, col: str) -> DataFrame:
    """The greatest value of a stored column, read from the Parquet footers: no row is scanned.

    Spark takes the maximum of a number from footers, not that of a time, so tables keep their load time as
    microseconds as well. The frame belongs to a session of its own, whose reader pushes aggregates down.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.max(col).alias("top"))


def since_from_stored(
    spark: SparkSession, path: str, micros_col: str, buffer: str, as_of: datetime | str | None = None, lookback: str = "INTERVAL 7 DAYS"
) -> DataFrame:
    """As ``since_from_target`` for a stored table, from its footers; a table that is not there counts as empty."""
    try:
        top = footer_max(spark, path, micros_col).first()["top"]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        top = None
    reached = F.lit(None if top is None else str(datetime(1970, 1, 1) + timedelta(microseconds=top))).cast("timestamp_ntz")
    return since_from_target(spark.range(1).select(reached.alias("reached")), "reached", buffer, as_of, lookback)


def logged_load(
    rows: DataFrame, ts: str, key: str, load: Callable[[DataFrame], None], log_path: str, job: str,
    started_at: datetime | str, ended_at: datetime | str | None = None, lookback_sec: int | None = None,
) -> Row:
    """Run a load and append what became of it to the run log; returns that row.

    The watermark, the greatest time and id that went through, is observed on the rows while ``load`` writes them, so
    the slice is read once. A load that fails is logged as such, without a watermark, and raises. The maximum is the
    same however often a lost task is run again; the row count is for information.
    """
    spark, seen = rows.sparkSession, Observation()
    pair = F.struct(F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(key).cast("bigint").alias("id"))
    error = None
    try:
        load(rows.observe(seen, F.max(F.when(F.col(ts).isNotNull(), pair)).alias("top"), F.count(F.lit(1)).alias("rows")))
    except Exception as e:
        error = e
    found = {} if error else seen.get
    top = found.get("top")
    logged = Row(
        job_name=job, watermark_type="ts", watermark_ts=top["ts"] if top else None, watermark_id=top["id"] if top else None,
        lookback_sec=lookback_sec, started_at=_time(started_at), ended_at=_time(ended_at or started_at),
        status=FAIL if error else SUCCESS, row_count=found.get("rows"), error=str(error)[:ERROR_LENGTH] if error else None, is_enabled=True,
    )
    spark.createDataFrame([logged], RUN_LOG).coalesce(1).write.mode("append").parquet(log_path)
    if error:
        raise error
    return logged


def _time(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def backfill(df: DataFrame, day_col: str, from_day: date | str, to_day: date | str) -> tuple[DataFrame, DataFrame]:
    """Rows of an inclusive day range, and how many there are per day, empty days too.

    All days are one job grouped by day; there is no loop over them.
    """
    rows = df.filter(F.col(day_col).between(F.lit(str(from_day)).cast("date"), F.lit(str(to_day)).cast("date")))
    found = rows.groupBy(F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    spine = day_spine(df.sparkSession, from_day, to_day)
    return rows, spine.join(found, "day", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def job_state(runs: DataFrame, jobs: Sequence[str] | None = None) -> DataFrame:
    """Watermark and last run of each job in one frame."""
    state = current_watermark(runs)
    if jobs:
        state = state.filter(F.col("job_name").isin(*jobs))
    return state.join(run_history(runs), "job_name")
