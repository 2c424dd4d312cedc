"""Column expressions shared by the operators (all JVM built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plain decimal or scientific number with optional sign; anything else
# (blank, '1,000', '1d', 'inf', 'nan') becomes null.
NUMERIC_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_numeric(c) -> Column:
    """Text to double; unparseable or non-finite text becomes null (no ANSI error)."""
    s = F.trim(col_(c).cast("string"))
    x = F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))
    return F.when(F.abs(x) <= F.lit(1.7976931348623157e308), x)


def is_value(c, value) -> Column:
    """1 when the column equals ``value``, else 0 — null counts as 0."""
    return col_(c).eqNullSafe(F.lit(value)).cast("int")


def safe_div(a, b) -> Column:
    return F.try_divide(col_(a), col_(b))


def full(c) -> Column:
    """The value as a double at full precision, -0.0 as 0.0; reports round, operators do not."""
    return col_(c).cast("double") + F.lit(0.0)


def r6(c) -> Column:
    """Round to 6 decimals and fold -0.0 into 0.0 (stable value hashing)."""
    return F.round(col_(c).cast("double"), 6) + F.lit(0.0)


def cut(c, edges: Sequence[float], labels: Sequence[str] | None = None,
        include_lowest: bool = False, as_ordinal: bool = False) -> Column:
    """Right-closed interval bins ``(e_i, e_i+1]``; values outside, or null, give null.

    ``include_lowest`` makes the first bin ``[e_0, e_1]``.  Returns the label
    (or the 0-based bin number when ``as_ordinal``).
    """
    x = col_(c)
    out = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (include_lowest and i == 0) else (x > lo)) & (x <= hi)
        val = F.lit(i) if as_ordinal or labels is None else F.lit(labels[i])
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def bands(rate, mid: float, high: float, names=("low", "mid", "high")) -> Column:
    """'high' above ``high``, 'mid' above ``mid``, else 'low'."""
    r = col_(rate)
    return F.when(r > high, names[2]).when(r > mid, names[1]).otherwise(names[0])


def join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str], plain: Sequence[str] = (),
                how: str = "inner") -> DataFrame:
    """Join on ``groups``, where a null is a group like any other, and on ``plain``
    columns; the columns of ``right`` come without the keys."""
    keys = [*groups, *plain]
    names = {k: f"_on_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[F.col(k).alias(names[k]) for k in keys], *[c for c in right.columns if c not in names])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k).eqNullSafe(F.col(names[k])) if k in groups else F.col(k) == F.col(names[k]))
    return left.join(renamed, on, how).drop(*names.values())
