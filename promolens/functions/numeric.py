"""Numeric column functions, all built-in expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept by the dirty-number rule: digits, comma, dot, minus.
NUMBER_JUNK = r"[^0-9,.\-]"


def coerce_numeric(c: Column, floor_zero: bool = False) -> Column:
    """Dirty text -> double.

    Steps: text, trimmed; drop every character but digits, comma, dot and
    minus; a comma without any dot is a decimal comma; remaining commas are
    thousands separators and vanish; parse, NULL when it does not parse;
    with ``floor_zero`` a negative number becomes NULL (not 0).
    So '1,234' -> 1.234, '1.234,50' -> 1.2345, '1e5' -> 15, '(5)' -> 5.
    """
    s = F.regexp_replace(F.trim(c.cast("string")), NUMBER_JUNK, "")
    s = F.when(F.instr(s, ",") > 0, F.when(F.instr(s, ".") == 0, F.translate(s, ",", ".")).otherwise(s)).otherwise(s)
    s = F.replace(s, F.lit(","), F.lit(""))
    x = s.try_cast("double")
    if floor_zero:
        x = F.when(x >= 0, x)
    return x


def nan_inf_to_null(c: Column) -> Column:
    """NaN and +-inf become NULL (missing), everything else passes."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def lenient_number(c: Column) -> Column:
    """Text or number -> double; what does not parse, and NaN, is missing."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def lenient_label(c: Column) -> Column:
    """0/1 label as text ("1", "1.0", "false"), number or boolean -> int;
    anything else is missing."""
    x = F.coalesce(c.try_cast("double"), c.cast("string").try_cast("boolean").cast("double"))
    return F.when(x == 1, 1).when(x == 0, 0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with a zero denominator, NaN or +-inf giving NULL."""
    return nan_inf_to_null(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)))


def clip(c: Column, lo, hi) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    lo_c = F.lit(lo) if not isinstance(lo, Column) else lo
    hi_c = F.lit(hi) if not isinstance(hi, Column) else hi
    out = c
    if lo is not None:
        out = F.greatest(out, lo_c)
    if hi is not None:
        out = F.least(out, hi_c)
    return F.when(c.isNotNull(), out)
