"""Keys, measures and status columns of the movement and opening facts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.schemas import QTY, VALUE

# ---- fixed values -------------------------------------------------------
SOURCE_SIDE, TARGET_SIDE = "SRC", "DST"
INTERNAL_USAGE = "internal"
QTY_NEGATIVE, QTY_ABOVE_ONE, STATUS_OK = "STOCK NEGATIF", "STOCK > 1", "OK"
NO_PRICE_NO_COST = "PRIX & COUT NULS"
NO_COST = "COUT MANQUANT"
NO_PRICE = "PRIX DE VENTE MANQUANT"
# -------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: Column | date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_ts(value: Column | datetime | str) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def date_key(d: Column | str) -> Column:
    """Day as the number yyyymmdd, by arithmetic rather than by formatting."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def movement_day(write: Column | str, business: Column | str, mode: str = "write_date") -> Column:
    """Day a move counts for: the preferred date, else the other one."""
    write, business = _col(write).cast("date"), _col(business).cast("date")
    order = (write, business) if mode == "write_date" else (business, write)
    return F.coalesce(*order)


def payment_dt(
    payment: Column, created: Column | None = None, written: Column | None = None,
    order_day: Column | None = None,
) -> Column:
    """Time of a payment, from the best date there is."""
    choices = [c for c in (payment, created, written) if c is not None]
    if order_day is not None:
        choices.append(order_day.cast("timestamp_ntz"))
    return F.coalesce(*choices)


def plain_number(c: Column | str) -> Column:
    """A quantity as text with at least one decimal and no exponent."""
    digits = F.rtrim(_col(c).cast("decimal(20,4)").cast("string"), F.lit("0"))
    return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)


def dup_key(record_id: Column | str, ts: Column | str, qty: Column | str) -> Column:
    """Digest of id, time and quantity; a missing part counts as ``None``."""
    missing = F.lit("None")
    return F.md5(
        F.concat_ws(
            "|",
            F.coalesce(_col(record_id).cast("string"), missing),
            F.coalesce(_col(ts).cast("timestamp_ntz").cast("string"), missing),
            F.coalesce(plain_number(qty), missing),
        )
    )


def surrogate_key(*natural: Column | str) -> Column:
    """Key derived from the natural key, so that a recomputed row keeps it.

    128 bits, as a random UUID would have, and half the size of a longer digest.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\\N")) for c in natural]
    return F.md5(F.concat_ws("|", *parts))


def signed_qty(side: Column | str, qty: Column | str, internal: Column | str) -> Column:
    """Stock effect on own locations only: out of the source, into the target."""
    size = F.abs(_col(qty))
    sign = F.when(_col(side) == SOURCE_SIDE, -size).otherwise(size)
    return F.when(_col(internal), sign).otherwise(F.lit(0)).cast(QTY)


def movement_qty(side: Column | str, qty: Column | str) -> Column:
    """Movement at any location: out of the source, into the target."""
    side, size = _col(side), F.abs(_col(qty))
    return F.when(side == SOURCE_SIDE, -size).when(side == TARGET_SIDE, size).otherwise(F.lit(0))


def value(qty: Column | str, price: Column | str) -> Column:
    """Size of the quantity times the price; a missing price counts as zero."""
    price = F.coalesce(_col(price).cast(QTY), F.lit(0).cast(QTY))
    return (F.abs(_col(qty).cast(QTY)) * price).cast(VALUE)


def qty_status(qty: Column | str) -> Column:
    qty = _col(qty)
    return F.when(qty < 0, QTY_NEGATIVE).when(qty > 1, QTY_ABOVE_ONE).otherwise(STATUS_OK)


def fin_status(price: Column | str, cost: Column | str) -> Column:
    price, cost = _col(price), _col(cost)
    return (
        F.when((price == 0) & (cost == 0), NO_PRICE_NO_COST)
        .when((price > 0) & (cost == 0), NO_COST)
        .when((price == 0) & (cost > 0), NO_PRICE)
        .otherwise(STATUS_OK)
    )


def age_days(in_date: Column | str, as_of: Column | date | str) -> Column:
    return F.datediff(as_date(as_of), _col(in_date))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill missing values; a default may be a value or another column."""
    return df.withColumns(
        {
            name: F.coalesce(
                F.col(name), (d if isinstance(d, Column) else F.lit(d)).cast(df.schema[name].dataType)
            )
            for name, d in defaults.items()
        }
    )


def fits_numeric(c: Column | str, precision: int = 16, scale: int = 4) -> Column:
    """Whether a number fits the target type; a missing one does."""
    c = _col(c)
    return c.isNull() | c.try_cast(f"decimal({precision},{scale})").isNotNull()


def split_overflow(df: DataFrame, c: str, precision: int = 16, scale: int = 4):
    """Rows that fit the target type, and the rows that do not."""
    fits = fits_numeric(c, precision, scale)
    return df.filter(fits), df.filter(~fits)
