"""Column-level helpers shared by operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (R / dplyr semantics for
    grouping keys); one copy of each key is kept, as with ``on=[...]``."""
    la, ra = left.alias("__l"), right.alias("__r")
    cond = [F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}")) for k in keys]
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return la.join(ra, cond, how).select(*[F.col(f"__l.{c}") for c in left.columns])
    key_cols = [F.col(f"__l.{k}").alias(k) if how != "full" else
                F.coalesce(F.col(f"__l.{k}"), F.col(f"__r.{k}")).alias(k) for k in keys]
    if how == "right":
        key_cols = [F.col(f"__r.{k}").alias(k) for k in keys]
    rest_l = [F.col(f"__l.{c}") for c in left.columns if c not in keys]
    rest_r = [F.col(f"__r.{c}") for c in right.columns if c not in keys]
    return la.join(ra, cond, how).select(*key_cols, *rest_l, *rest_r)


def safe_div(a: Column, b: Column) -> Column:
    """NULL when the denominator is 0 or NULL (never inf, never an ANSI error)."""
    return F.try_divide(a, b)


def floor_div(a: Column, b: Column) -> Column:
    """R ``%/%``: floor division (Spark ``div`` truncates toward zero)."""
    return F.floor(a / b)


def r_mod(a: Column, b: Column) -> Column:
    """R ``%%``: result has the sign of the divisor."""
    return F.pmod(a, b)


def r_round(c: Column, digits: int = 0) -> Column:
    """R ``round``: IEC 60559 half-to-even."""
    return F.bround(c, digits)


def log_base(c: Column, base: float) -> Column:
    return F.log(float(base), c)


MIX_MOD = 2147483647     # fixed value: Mersenne prime 2^31 - 1
MIX_MULT1 = 742938285    # fixed value: full-period multiplier modulo 2^31 - 1
MIX_MULT2 = 48271        # fixed value: Park-Miller multiplier
MIX_BASE = 1000003       # fixed value: polynomial base for combining keys


def mix_uniform(*cols: Column, seed: int = 0) -> Column:
    """Portable pseudo-uniform in [0, 1) from non-negative integer keys
    (< 2^31): polynomial combine of the keys, a multiplicative step, a
    squaring step (the nonlinear scramble) and a Park-Miller step, all
    modulo 2^31 - 1.  Every product stays below 2^62, so the value is exact
    in any engine with 64-bit integers (``mix_uniform_sql`` is the SQL
    form).  ``xxhash64`` stays the default of the sampling operators."""
    m = F.lit(MIX_MOD)
    h = F.lit(seed % MIX_MOD).cast("long")
    for c in cols:
        h = F.pmod(h * MIX_BASE + c.cast("long"), m)
    h = F.pmod(h * MIX_MULT1, m)
    h = F.pmod(h * h, m)
    h = F.pmod(h * MIX_MULT2, m)
    return h / float(MIX_MOD)


def mix_uniform_sql(cols: Sequence[str], seed: int = 0) -> str:
    """The same value as ``mix_uniform`` written as SQL."""
    h = str(seed % MIX_MOD)
    for c in cols:
        h = f"(({h}) * {MIX_BASE} + CAST({c} AS BIGINT)) % {MIX_MOD}"
    h = f"(({h}) * {MIX_MULT1}) % {MIX_MOD}"
    h = f"(({h}) * ({h})) % {MIX_MOD}"
    return f"((({h}) * {MIX_MULT2}) % {MIX_MOD}) / {float(MIX_MOD)}"
