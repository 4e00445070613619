"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.sources.schemas import WEEKDAY_NAMES

def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column) -> Column:
    """ISO text -> wall-clock ``timestamp_ntz``; malformed text gives null (ANSI on).

    All time helpers here use only field extraction, ``datediff`` and interval
    arithmetic on ``timestamp_ntz``, which do not depend on the session time
    zone (``date_format`` / ``timestamp_diff`` do, around DST gaps).
    """
    return col_(c).try_cast("timestamp_ntz")


def _wall_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]`` text of a wall-clock timestamp (no zone involved)."""
    return ts.cast("timestamp_ntz").cast("string")


def iso_seconds(c: str | Column) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss`` text."""
    t = _wall_text(col_(c))
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8))


def year_month(c: str | Column) -> Column:
    """Timestamp -> ``yyyy-MM`` month key."""
    return F.substring(_wall_text(col_(c)), 1, 7)


def weekday_name(dow: str | Column) -> Column:
    """dayofweek (1 = Sunday) -> label; a fixed 7-entry array, no lookup join."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), col_(dow))


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from start to end (floor for end >= start), like ``timedelta.days``."""
    a, b = col_(start), col_(end)
    secs = F.datediff(b, a) * 86400 + (_second_of_day(b) - _second_of_day(a))
    return F.floor(secs / F.lit(86400)).cast("long")


def add_days(ts: str | Column, days: Column) -> Column:
    return col_(ts) + F.make_dt_interval(days=days.cast("int"))


def truncate_seconds(ts: str | Column) -> Column:
    t = col_(ts)
    sec = F.date_part(F.lit("SECOND"), t)
    return t - F.make_dt_interval(secs=sec - F.floor(sec))


def split_instant(min_ts: str | Column, max_ts: str | Column, share: float) -> Column:
    """``min + floor(whole_days * share)`` days, truncated to the second."""
    d = F.floor(whole_days_between(min_ts, max_ts) * F.lit(share))
    return truncate_seconds(add_days(min_ts, d)).cast("timestamp_ntz")


def literal_row(df) -> dict[str, Column]:
    """Run a one-row result (an aggregate) and return its fields as typed literals.

    Used for bounds a plan needs before it can run (the split instant, quantile
    bounds, histogram ranges): one small row crosses to the driver, and the
    literal can be pushed into scans. A scalar subquery would keep the plan
    lazy, but adaptive execution does not reuse it, so every reference would
    recompute the whole input. Nested fields come back as a dict of literals.
    """
    from pyspark.sql import types as T
    row = df.first()

    def lit(v, dt):
        if isinstance(dt, T.StructType):
            return {f.name: lit(None if v is None else v[f.name], f.dataType) for f in dt.fields}
        if v is None:
            return F.lit(None).cast(dt)
        if isinstance(dt, T.TimestampNTZType):
            return F.lit(v.isoformat()).try_cast("timestamp_ntz")
        return F.lit(v).cast(dt)

    return {f.name: lit(None if row is None else row[f.name], f.dataType) for f in df.schema.fields}


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (no ANSI error)."""
    return F.try_divide(num, den)


def pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def bias_corrected_skew(x: str | Column) -> Column:
    """Sample skewness with the n-adjustment used by pandas ``Series.skew``."""
    n = F.count(col_(x)).cast("double")
    g1 = F.skewness(col_(x))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
