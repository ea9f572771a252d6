"""Column expressions shared by the operators (all Spark built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token boundaries for search text: anything that is not a lower-case letter or a digit.
TOKEN_SPLIT = "[^a-z0-9]+"


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_describe_marker(col_name: Column | str = "col_name") -> Column:
    """A DESCRIBE row that ends the column section: empty name or any ``#`` in it."""
    c = col_or_name(col_name)
    return (F.coalesce(c, F.lit("")) == "") | c.contains("#")


def is_view_type(table_type: Column | str = "table_type") -> Column:
    """Null, empty or ``view`` (any case) is a view; every other type is a table."""
    c = col_or_name(table_type)
    return (F.coalesce(c, F.lit("")) == "") | (F.lower(c) == "view")


def is_delta_format(fmt: Column | str = "format") -> Column:
    """``format`` equals ``delta`` case-insensitively; a null format is not delta."""
    return F.coalesce(F.lower(col_or_name(fmt)) == "delta", F.lit(False))


def epoch_seconds(ts: Column | str, naive: bool = True) -> Column:
    """Whole seconds since the epoch, fraction dropped (floored).

    A naive (``timestamp_ntz``) wall-clock time is read as UTC whatever the
    session zone is; with ``naive=False`` the value is an instant
    (``timestamp``) and ``unix_seconds`` applies.
    """
    c = col_or_name(ts)
    if not naive:
        return F.unix_seconds(c)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1_000_000)).cast("long")


def escape_key_part(part: Column | str) -> Column:
    """Make a value safe inside a ``/``-separated key: ``%`` -> ``%25``, ``/`` -> ``%2F``."""
    c = col_or_name(part)
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def node_key(*parts: Column | str) -> Column:
    """Graph key from non-null parts; callers guarantee the parts are not null."""
    return F.concat_ws("/", *[escape_key_part(p) for p in parts])


def tokens(text: Column | str) -> Column:
    """Lower-cased alphanumeric terms of a text, empty strings removed."""
    parts = F.split(F.lower(col_or_name(text)), TOKEN_SPLIT)
    return F.filter(parts, lambda t: t != "")
