"""Normalisers and classifiers for names, codes and categories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------
UNIT_SYNONYMS = ("unit", "units", "unité", "unites", "pièce", "pieces", "pcs", "pc")
UNIT_NAME = "Units"
CATEGORY_KEYWORDS = ("PERRUQUE", "LACE", "CLOSURE", "PLANTE")
CATEGORY_PREFIX = "VENTE / "
SITE_PREFIXES = (("DEPOT/CENTRAL", "DEPOT_CENTRAL"), ("BOUTIQUE", "BOUTIQUE"))
SITE_DEFAULT = "OTHER"
TRACKED_KEYWORDS = ("perruque", "plante", "lace", "closure")
UNTRACKED_PREFIXES = ("coiffure", "[vieux")
# -------------------------------------------------------------------------

SPACE = r"(?U)\s"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def has_code_prefix(name: Column | str) -> Column:
    """Something other than blanks stands before the first dash."""
    return F.coalesce(_col(name).rlike(r"(?U)^\s*[^\s-][^-]*-"), F.lit(False))


def norm_product(name: Column | str) -> Column:
    """Name without ``[tags]`` and leading code, upper case, single blanks."""
    untagged = F.regexp_replace(F.coalesce(_col(name), F.lit("")), r"(?U)\[[^\]]+\]\s*", "")
    uncoded = F.regexp_replace(untagged, r"^[^-]*-", "")
    return F.trim(F.regexp_replace(F.upper(uncoded), SPACE + "+", " "))


def canon_uom(c: Column | str) -> Column:
    c = _col(c)
    tidy = F.trim(c)
    known = F.lower(tidy).isin(*UNIT_SYNONYMS)
    return F.when(c.isNull() | (c == "") | known, F.lit(UNIT_NAME)).otherwise(tidy)


def pos_category(
    path: Column | str,
    keywords: Sequence[str] = CATEGORY_KEYWORDS,
    prefix: str = CATEGORY_PREFIX,
) -> Column:
    """Sales category by the first keyword found in the path, NULL if none is."""
    text = F.upper(_col(path))
    return F.coalesce(*[F.when(text.contains(k), F.lit(prefix + k)) for k in keywords])


def norm_site(
    name: Column | str,
    prefixes: Sequence[tuple[str, str]] = SITE_PREFIXES,
    default: str = SITE_DEFAULT,
) -> Column:
    text = F.upper(_col(name))
    return F.coalesce(
        *[F.when(text.startswith(p), F.lit(site)) for p, site in prefixes], F.lit(default)
    )


def is_tracked_product(
    name: Column | str,
    sale_ok: Column | str,
    keywords: Sequence[str] = TRACKED_KEYWORDS,
    excluded: Sequence[str] = UNTRACKED_PREFIXES,
    strip: bool = True,
) -> Column:
    """Sellable, of a tracked kind, and not of an excluded family."""
    text = F.lower(_col(name))
    if strip:
        text = F.trim(text)
    wanted = _any([text.contains(k) for k in keywords])
    unwanted = _any([text.startswith(p) for p in excluded])
    return F.coalesce(wanted & ~unwanted & _col(sale_ok), F.lit(False))


def shop_key(c: Column | str) -> Column:
    """Join key that ignores case, blanks, dashes and underscores."""
    return F.regexp_replace(F.upper(F.trim(_col(c))), r"[\s\-_]+", "")


def valid_barcode(c: Column | str) -> Column:
    """Barcode of an own article: starts with a letter and is not ``false``."""
    c = _col(c)
    return c.isNotNull() & (c != "false") & c.rlike("^[A-Za-z]")


def location_key(complete_name: Column | str) -> Column:
    """Report key of a location: its path in upper case, parts set off by bars."""
    parts = F.regexp_replace(F.upper(F.trim(_col(complete_name))), r"\s*/\s*", " | ")
    return F.regexp_replace(parts, SPACE + "+", " ")
