"""Incremental slices of a source. Conditions are plain comparisons so that they
reach the Parquet scan and prune partitions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
"""Bars of a histogram, all that a pass over the rows sends back."""
FEW = 4096
"""Pairs that are looked at one by one."""
_EPOCH = datetime(1970, 1, 1)


def _ts(value: datetime | date | str):
    return F.lit(str(value)).cast("timestamp_ntz")


def _text(value: datetime | date | str) -> str:
    """A time as sources write it, to whole seconds."""
    return f"{datetime.fromisoformat(str(value)):%Y-%m-%d %H:%M:%S}"


def not_before(text: str, value: datetime | date | str) -> Column:
    """Bound on a time held as text, for the scan to skip row groups by; what it lets through is still parsed.

    The layout sorts as text. Texts that begin with a blank sort before any digit and are let through.
    """
    return (F.col(text) >= _text(value)) | (F.col(text) < "0")


def not_after(text: str, value: datetime | date | str) -> Column:
    return F.col(text) <= _text(value)


def slice_since(
    df: DataFrame, ts: str, key: str, since_ts: datetime | str, since_id: int,
    max_rows: int | None = None, text: str | None = None,
) -> DataFrame:
    """Rows after ``(since_ts, since_id)``, at most the first ``max_rows`` by time and id.

    The leading ``>=`` is implied by the rest; it is there because an OR of two
    columns is not a range the scan can skip by. ``text`` names the column that
    ``ts`` was parsed from. A capped slice is a plain filter up to the last pair it
    holds, so nothing is sorted or gathered; rows that share that pair all come, as a
    next slice, which begins after it, would miss them.
    """
    at = _ts(since_ts)
    known = df.filter(not_before(text, since_ts)) if text else df
    after = (F.col(ts) >= at) & ((F.col(ts) > at) | ((F.col(ts) == at) & (F.col(key) > since_id)))
    out = known.filter(after)
    last = cut_off(out, ts, key, max_rows) if max_rows else None
    if last:
        end = F.lit(str(last[0])).cast("timestamp_ntz")
        out = known.filter(F.col(ts) <= end).filter(after & ((F.col(ts) < end) | (F.coalesce(F.col(key), F.lit(last[1])) <= last[1])))
        out = out.filter(not_after(text, last[0] + timedelta(seconds=1))) if text else out
    return out


def micros(ts: str) -> Column:
    """A time without a zone as microseconds, whatever the session's zone."""
    c = F.col(ts)
    seconds = F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")


def cut_off(df: DataFrame, ts: str, key: str, n: int) -> tuple[datetime, int] | None:
    """The ``n``-th pair of time and id in order, or None if there are fewer rows; a missing id counts as the least.

    Histograms narrow down first the time, then the id: each pass counts the rows of a range in ``BINS`` bars and goes
    on with the one that holds the n-th. A pass is a scan bounded by the range and sends back no more than its bars.
    """
    least = -(1 << 63)
    at = F.coalesce(F.col(key).cast("long"), F.lit(least))
    pairs = df.filter(F.col(ts).isNotNull()).select(F.col(ts).alias("__ts"), micros(ts).alias("t"), at.alias("i"))
    moment = None
    for column in ("t", "i"):
        low, high, left = pairs.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
        if left < n:
            return None
        while low < high:
            if left <= FEW:
                t, i = sorted((r["t"], r["i"]) for r in pairs.select("t", "i").collect())[n - 1]
                return _EPOCH + timedelta(microseconds=t), i
            width = -(-(high - low + 1) // BINS)
            whole = [f"cast('{x}' AS decimal(38,0))" for x in (low, width)]  # a quotient of decimals is rounded, and may round up to the next bar
            bar = F.expr(f"cast((cast({column} AS decimal(38,0)) - {whole[0]}) div {whole[1]} AS int)")
            for number, rows in sorted((r["bar"], r["count"]) for r in pairs.groupBy(bar.alias("bar")).count().collect()):
                if rows >= n:
                    break
                n -= rows
            low, high, left = low + number * width, min(high, low + (number + 1) * width - 1), rows
            pairs = pairs.filter(F.col(column).between(low, high))
            if column == "t":  # for the scan to skip by
                edge = lambda x: F.lit(str(_EPOCH + timedelta(microseconds=x))).cast("timestamp_ntz")
                pairs = pairs.filter(F.col("__ts").between(edge(low), edge(high)))
        moment = moment if column == "i" else low
        n_of_key = low
    return _EPOCH + timedelta(microseconds=moment), n_of_key


def slice_last(
    df: DataFrame, col: str, as_of: datetime | str, days: float = 0, hours: float = 0,
    inclusive: bool = False, state_col: str | None = None, state: str = "done", text: str | None = None,
) -> DataFrame:
    """Rows of the last days or hours before ``as_of``, optionally in one state.

    ``text`` names the column that ``col`` was parsed from.
    """
    start = datetime.fromisoformat(str(as_of)) - timedelta(days=days, hours=hours)
    cond = F.col(col) >= _ts(start) if inclusive else F.col(col) > _ts(start)
    if state_col:
        cond = cond & (F.coalesce(F.col(state_col), F.lit("")) == state)
    return (df.filter(not_before(text, start)) if text else df).filter(cond)


def slice_range(df: DataFrame, col: str, from_: datetime | str, to: datetime | str, text: str | None = None) -> DataFrame:
    """Half-open range ``[from_, to)``; ``text`` names the column that ``col`` was parsed from."""
    if text:
        df = df.filter(not_before(text, from_) & not_after(text, to))
    return df.filter((F.col(col) >= _ts(from_)) & (F.col(col) < _ts(to)))


def range_bounds(
    mode: str, as_of: datetime, lookback_hours: int = 24,
    from_: datetime | None = None, to: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Bounds of a load: given ones for ``hist``, a lookback for ``daily``."""
    if mode == "hist":
        if from_ is None or to is None:
            raise ValueError("a hist load needs both bounds")
        return from_, to
    return as_of - timedelta(hours=lookback_hours), as_of
