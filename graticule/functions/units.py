"""Unit conversion over a fixed table, and thresholds given as text such as ``"1 mm d-1"``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Unit -> (dimension, factor, offset) with canonical = factor * value + offset; canonical K and mm d-1.
UNITS = {
    "K": ("temperature", 1.0, 0.0),
    "degC": ("temperature", 1.0, 273.15),
    "mm d-1": ("precipitation", 1.0, 0.0),
    "mm/d": ("precipitation", 1.0, 0.0),
    "mm/day": ("precipitation", 1.0, 0.0),
    "kg m-2 s-1": ("precipitation", 86400.0, 0.0),
}

CANONICAL = {"tasmax": "K", "tasmin": "K", "tas": "K", "dtr": "K", "pr": "mm d-1"}


def _unit(name: str) -> tuple[str, float, float]:
    try:
        return UNITS[name]
    except KeyError:
        raise ValueError(f"unknown unit {name!r}; one of {sorted(UNITS)}") from None


def convert(col: Column, source: str, target: str) -> Column:
    dim_s, fac_s, off_s = _unit(source)
    dim_t, fac_t, off_t = _unit(target)
    if dim_s != dim_t:
        raise ValueError(f"{source!r} is a {dim_s}, {target!r} a {dim_t}")
    if (fac_s, off_s) == (fac_t, off_t):
        return col
    return (col * fac_s + (off_s - off_t)) / fac_t if fac_t != 1.0 else col * fac_s + (off_s - off_t)


def threshold(text: str | float, target: str | None = None) -> float:
    """``"4 degC"`` -> 277.15.  A bare number is taken as already canonical."""
    if isinstance(text, (int, float)):
        return float(text)
    number, _, unit = text.strip().partition(" ")
    dim, fac, off = _unit(unit.strip())
    if target is not None and _unit(target)[0] != dim:
        raise ValueError(f"{text!r} is not a {_unit(target)[0]}")
    return float(number) * fac + off


def convert_units(df: DataFrame, wanted: dict[str, str], present: dict[str, str]) -> DataFrame:
    """Convert columns from their ``present`` to their ``wanted`` units; a column without a known unit raises."""
    return df.withColumns({c: convert(F.col(c), present[c], u) for c, u in wanted.items()})
