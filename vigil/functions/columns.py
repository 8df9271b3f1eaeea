"""Column expressions used across operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import constants as K


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_number(n: Column | str, width: int) -> Column:
    """Zero-pad a number to ``width`` digits without cutting longer numbers.

    ``lpad`` alone truncates input longer than the width; ids of large tables
    must stay distinct, so the width grows with the number.
    """
    s = col_or_name(n).cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def prefixed_id(prefix: str, n: Column | str, width: int) -> Column:
    """Ids like ``TXN0000001``: prefix + zero-padded number."""
    return F.concat(F.lit(prefix), pad_number(n, width))


def mask_card(card: Column | str) -> Column:
    """Last four characters of a card number; ``****`` for null or empty."""
    c = col_or_name(card)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(K.MASK_NULL)).otherwise(F.right(c, F.lit(4)))


def or_missing(c: Column | str) -> Column:
    """Null or empty text -> ``N/A``."""
    c = col_or_name(c)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(K.MISSING_TEXT))


def money(c: Column | str) -> Column:
    """Thousands separator and two decimals: 1234.5 -> ``1,234.50``."""
    return F.format_number(col_or_name(c).cast("double"), 2)


def timestamp_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` plus ``.ffffff`` when there are fractional seconds."""
    c = col_or_name(c)
    base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(frac == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), frac))


def html_escape(c: Column | str) -> Column:
    """Escape text placed into an HTML body (ampersand first)."""
    c = col_or_name(c)
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def html_text(c: Column | str) -> Column:
    """Escaped text, ``N/A`` for null or empty."""
    return html_escape(or_missing(c))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """Absolute minutes between two instants (fractional, microsecond precision)."""
    micros = F.timestamp_diff("MICROSECOND", col_or_name(a), col_or_name(b))
    return F.abs(micros) / F.lit(60_000_000.0)


def interval_seconds(seconds: int | Column) -> Column:
    """A day-time interval of ``seconds`` (literal or column)."""
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def floor_to(ts: Column | str, unit: str, ntz: bool = False) -> Column:
    """date_trunc that keeps the input type: ``date_trunc`` always returns
    timestamp, so a timestamp_ntz input (``ntz=True``) is cast back."""
    truncated = F.date_trunc(unit, col_or_name(ts))
    return truncated.cast("timestamp_ntz") if ntz else truncated


def is_ntz(df, column: str) -> bool:
    from pyspark.sql.types import TimestampNTZType
    return isinstance(df.schema[column].dataType, TimestampNTZType)
