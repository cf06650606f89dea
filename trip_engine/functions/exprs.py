"""Scalar column functions (OP-14..24).

Every function returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; none needs a session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.specs import EARTH_RADIUS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# OP-14 ----------------------------------------------------------------------
def apply_schema(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the listed columns that are present (a label missing from a test
    frame is skipped). ``strict`` uses ``cast`` (raises on bad input under
    ANSI), otherwise ``try_cast`` (bad input -> NULL)."""
    present = {c: t for c, t in types.items() if c in df.columns}
    if strict:
        casts = {c: F.col(c).cast(t) for c, t in present.items()}
    else:
        casts = {c: F.col(c).try_cast(t) for c, t in present.items()}
    return df.withColumns(casts) if casts else df


# OP-15 ----------------------------------------------------------------------
def encode_flag(flag: str | Column, unknown: int | None = None) -> Column:
    """Y -> 1, N -> 0; anything else (NULL included) -> ``unknown``.

    ``unknown=None`` is the SQL reading (unknown stays NULL); ``unknown=1``
    reproduces the batch job, where only N maps to 0."""
    c = _col(flag)
    return (F.when(c == "Y", F.lit(1)).when(c == "N", F.lit(0))
            .otherwise(F.lit(unknown).cast("int")))


# OP-16 ----------------------------------------------------------------------
def map_codes(code: str | Column, mapping: Mapping[str, str]) -> Column:
    """Known codes -> names, unknown codes unchanged, NULL stays NULL.

    For a handful of codes a CASE chain is cheapest; a mapping with many
    thousands of entries belongs in a broadcast join instead."""
    c = _col(code)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return c if out is None else out.otherwise(c)


# OP-17 / OP-18 / OP-19 ------------------------------------------------------
def calendar_parts(ts: str | Column) -> dict[str, Column]:
    """hour, day of month and month of a timestamp (as int)."""
    c = _col(ts)
    return {"hour": F.hour(c).cast("int"), "day": F.dayofmonth(c).cast("int"),
            "month": F.month(c).cast("int")}


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(_col(ts)).cast("int")


def day_of_week(ts: str | Column) -> Column:
    """Day of week with Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_col(ts)).cast("int")


def trip_day(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


# OP-20 / OP-21 --------------------------------------------------------------
def _present(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def great_circle(lat1: str | Column, lon1: str | Column, lat2: str | Column,
                 lon2: str | Column, unit: str = "km", clamp: bool = True,
                 scale: int | None = None, method: str = "cosines") -> Column:
    """Great-circle distance between two points given in degrees.

    ``method='cosines'`` is the spherical law of cosines the original jobs
    use; ``clamp`` keeps its acos argument in [-1, 1] so identical points give
    0 instead of NaN. ``method='haversine'`` is the numerically stable form.
    Any NULL or NaN coordinate gives NULL (the clamp alone would turn it into
    0, because least/greatest skip NULLs)."""
    if unit not in EARTH_RADIUS:
        raise ValueError(f"unit must be one of {sorted(EARTH_RADIUS)}, got {unit!r}")
    radius = F.lit(EARTH_RADIUS[unit])
    a1, o1, a2, o2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    p1, p2 = F.radians(a1), F.radians(a2)
    if method == "cosines":
        arg = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(F.radians(o2) - F.radians(o1))
        if clamp:
            arg = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), arg))
        dist = F.acos(arg) * radius
    elif method == "haversine":
        h = (F.pow(F.sin((p2 - p1) / 2), 2)
             + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(o2) - F.radians(o1)) / 2), 2))
        if clamp:
            h = F.least(F.lit(1.0), h)
        dist = F.lit(2.0) * radius * F.asin(F.sqrt(h))
    else:
        raise ValueError(f"method must be 'cosines' or 'haversine', got {method!r}")
    if scale is not None:
        dist = F.round(dist, scale)
    guard = _present(a1) & _present(o1) & _present(a2) & _present(o2)
    return F.when(guard, dist)


# OP-22 ----------------------------------------------------------------------
def shape_duration(pred: str | Column, shape: str = "round") -> Column:
    """'trunc' -> int toward zero (batch job), 'round' -> nearest whole
    number as double (SQL model), 'raw' -> unchanged (request service)."""
    c = _col(pred)
    if shape == "trunc":
        return c.cast("int")
    if shape == "round":
        return F.round(c, 0)
    if shape == "raw":
        return c
    raise ValueError(f"shape must be 'trunc', 'round' or 'raw', got {shape!r}")


# OP-23 ----------------------------------------------------------------------
def percent(part: str | Column, total: str | Column, decimals: int = 2) -> Column:
    """round(part / total * 100, decimals), rounded half up on the exact
    ratio with integer arithmetic (no binary-fraction ties). NULL if the
    total is 0. A tie such as 1/800 (0.125 %) goes up to 0.13, where rounding the
    binary fraction may fall either way."""
    p = _col(part).cast("long")
    t = F.when(_col(total) != 0, _col(total).cast("long"))
    unit = 10 ** decimals
    num = p * (200 * unit) + t
    den = t * 2
    # num - pmod(num, den) is an exact multiple of den: the quotient is exact.
    whole = ((num - F.pmod(num, den)).cast("decimal(38,0)")
             / den.cast("decimal(38,0)")).cast("long")
    return whole.cast("double") / F.lit(float(unit))


# OP-24 ----------------------------------------------------------------------
def capped_sum(a: str | Column, b: str | Column, cap: float = 100.0) -> Column:
    return F.least(_col(a) + _col(b), F.lit(cap))
