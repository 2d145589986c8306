"""Reading untidy source records: relations, ``false`` for missing, loose text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the one accepted timestamp layout, yyyy-MM-dd HH:mm:ss
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def m2o_id(c: Column | str) -> Column:
    """Id of ``[id, "name"]`` or of a bare number, NULL for ``false``.

    The id stands before the first comma, so the text need not be parsed as JSON.
    """
    head = F.substring_index(_col(c), ",", 1)
    return F.translate(head, "[] ", "").try_cast("bigint")


def m2o_name(c: Column | str) -> Column:
    """Display name of ``[id, "name"]``, else NULL.

    A name without escapes is cut out of the text; JSON is parsed only for the rest.
    """
    c = _col(c)
    quote = F.instr(c, '"')
    name = F.substr(c, quote + 1, F.length(c) - quote - 2)
    is_plain = c.startswith("[") & c.endswith('"]') & ~c.contains("\\") & ~name.contains('"')
    return F.when(is_plain, name).when(c.startswith("["), F.get_json_object(c, "$[1]"))


def clean_false(c: Column | str) -> Column:
    """A text field holding ``false`` is a missing field."""
    c = _col(c)
    return F.when(c != "false", c)


def parse_dt(c: Column | str) -> Column:
    """Zone-less timestamp, NULL when absent or malformed.

    The layout is checked first because the cast alone would also take shorter
    forms; the result never passes through the session time zone.
    """
    text = F.trim(_col(c))
    return F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp_ntz"))


def safe_double(c: Column | str) -> Column:
    """Number held as text, NULL for booleans, words and type suffixes."""
    text = F.trim(_col(c))
    return F.when(~text.rlike("[A-DF-Za-df-z]"), text.try_cast("double"))


def json_path(c: Column | str, path: str) -> Column:
    return F.get_json_object(_col(c), path)


def json_is_array(c: Column | str, path: str) -> Column:
    """Whether the value at ``path`` is an array (for NULL input: false)."""
    return F.coalesce(F.get_json_object(_col(c), path).startswith("["), F.lit(False))


def movement_ref(picking: Column | str, reference: Column | str, display: Column | str) -> Column:
    """Document name of a move: picking name, else reference, else display name."""
    return F.coalesce(m2o_name(picking), clean_false(reference), clean_false(display))


def movement_ref_or_payload(ref: Column | str, payload: Column | str) -> Column:
    """Staged reference, or the picking name still held in the payload."""
    path = "$.raw.picking_id"
    in_payload = F.when(json_is_array(payload, path), json_path(payload, f"{path}[1]"))
    return F.coalesce(_col(ref), in_payload)
