"""Column expressions shared by the reports. All JVM-side (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_ids(s) -> Column:
    """Comma list -> array of tokens, empty tokens dropped (``"1,2,"`` -> 2).

    ``array_remove`` is code-generated; a lambda filter would be interpreted.
    """
    return F.array_remove(F.split(_c(s), ","), "")


def pct_half_up(num, den) -> Column:
    """Percent with one decimal, rounded half up: round(num*1000/den)/10."""
    q = _c(num).cast("double") * F.lit(1000.0) / _c(den).cast("double")
    return F.floor(q + F.lit(0.5)).cast("double") / F.lit(10.0)


def tenths_truncated(num, den) -> Column:
    """Percent in integer tenths, truncated: (num*1000) div den."""
    scaled = _c(num).cast("bigint") * F.lit(1000)
    den = _c(den).cast("bigint")
    # exact integer division: subtract the remainder before dividing
    return ((scaled - F.pmod(scaled, den)) / den).cast("bigint")


def tenths_text(tenths) -> Column:
    """Integer tenths of a percent -> ``'33.3'`` (Double text)."""
    return (_c(tenths).cast("double") / F.lit(10.0)).cast("string")


def epoch_ms_day(ts_ms) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "yyyy-MM-dd")


def epoch_ms_minute(ts_ms) -> Column:
    """Epoch ms -> ``HH:mm`` (the date is dropped)."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "HH:mm")


def json_pairs(entries, key_field: str, value_field: str) -> Column:
    """Array of structs -> ``[{"k1":v1},{"k2":v2}]`` keeping array order."""
    return F.to_json(F.transform(
        _c(entries),
        lambda e: F.create_map(e[key_field].cast("string"), e[value_field])))
