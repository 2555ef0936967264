"""Normal distribution as JVM column expressions (no Python UDF).

Distribution function: Cody's rational approximations in three ranges (1969), with the
exponent split so that tails keep their relative accuracy.  Quantile: Wichura's AS 241
(1988).  Tests hold the first to 1e-13 relative up to |z| = 10 and 1e-11 beyond, and
the second to 1e-13.

The SQL forms for oracles use other formulas on purpose: the power series of the
distribution function, and Newton steps on it for the quantile.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.columns import col_of

# Fixed published coefficients, highest power first (Cody 1969: near 0, to sqrt(32), beyond).
_NEAR = ((.065682337918207449113, 2.2352520354606839287, 161.02823106855587881, 1067.6894854603709582, 18154.981253343561249),
         (1.0, 47.20258190468824187, 976.09855173777669322, 10260.932208618978205, 45507.789335026729956))
_MIDDLE = ((1.0765576773720192317e-8, .39894151208813466764, 8.8831497943883759412, 93.506656132177855979, 597.27027639480026226,
            2494.5375852903726711, 6848.1904505362823326, 11602.651437647350124, 9842.7148383839780218),
           (1.0, 22.266688044328115691, 235.38790178262499861, 1519.377599407554805, 6485.558298266760755,
            18615.571640885098091, 34900.952721145977266, 38912.003286093271411, 19685.429676859990727))
_FAR = ((.02307344176494017303, .21589853405795699, .1274011611602473639, .022235277870649807, .001421619193227893466, 2.9112874951168792e-5),
        (1.0, 1.28426009614491121, .468238212480865118, .0659881378689285515, .00378239633202758244, 7.29751555083966205e-5))

# Fixed published coefficients, highest power first (Wichura, AS 241: centre, tail, far tail).
_CENTRE = ((2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
            13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
           (5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
            5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0))
_TAIL = ((7.7454501427834140764e-4, .0227238449892691845833, .24178072517745061177, 1.27045825245236838258,
          3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
         (1.05075007164441684324e-9, 5.475938084995344946e-4, .0151986665636164571966, .14810397642748007459,
          .68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0))
_FAR_TAIL = ((2.01033439929228813265e-7, 2.71155556874348757815e-5, .0012426609473880784386, .026532189526576123093,
              .29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
             (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
              .0148753612908506148525, .13692988092273580531, .59983220655588793769, 1.0))


def norm_pdf(x: str | Column) -> Column:
    z = col_of(x)
    return F.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)


def _horner(coef: Sequence[float], x: Column) -> Column:
    acc = F.lit(coef[0])
    for c in coef[1:]:
        acc = acc * x + c
    return acc


def _ratio(pair: tuple[Sequence[float], Sequence[float]], x: Column) -> Column:
    return _horner(pair[0], x) / _horner(pair[1], x)


def norm_cdf(x: str | Column) -> Column:
    z = col_of(x).cast("double")
    y = F.abs(z)
    # exp(-y^2 / 2) from a rounded y, whose square is exact, and the rest
    coarse = F.floor(F.least(y, F.lit(100.0)) * 16) / 16
    bell = F.exp(-0.5 * coarse * coarse) * F.exp(-0.5 * (y - coarse) * (y + coarse))
    inverse = 1 / F.greatest(y * y, F.lit(1.0))
    far = (1 / math.sqrt(2 * math.pi) - inverse * _ratio(_FAR, inverse)) / F.greatest(y, F.lit(1.0))
    upper = F.when(y > 40, 0.0).when(y > math.sqrt(32), bell * far).otherwise(bell * _ratio(_MIDDLE, y))
    return F.when(F.isnan(z), z).when(y <= 0.67448975, 0.5 + z * _ratio(_NEAR, z * z)).when(z > 0, 1 - upper).otherwise(upper)


def norm_ppf(p: str | Column) -> Column:
    """NULL outside (0, 1)."""
    p = col_of(p).cast("double")
    q = p - 0.5
    inside = (p > 0) & (p < 1)
    r = F.sqrt(-F.log(F.when(inside, F.least(p, 1 - p))))
    tail = F.when(r <= 5, _ratio(_TAIL, r - 1.6)).otherwise(_ratio(_FAR_TAIL, r - 5))
    return F.when(inside, F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRE, 0.180625 - q * q)).otherwise(F.signum(q) * tail))


# ------------------------------------------------------------- SQL for oracles
def norm_pdf_sql(x: str) -> str:
    return f"(exp(((-0.5) * ({x})) * ({x})) / {math.sqrt(2 * math.pi)!r})"


def norm_cdf_sql(x: str) -> str:
    """1/2 + pdf(x) (x + x^3/3 + x^5/15 + ...), for |x| up to 8."""
    series = f"list_reduce(list_transform(range(120), lambda k_: 241.0 - 2 * k_), lambda s_, d_: 1 + s_ * ({x}) * ({x}) / d_, 1.0)"
    return f"(0.5 + {norm_pdf_sql(x)} * ({x}) * {series})"


def norm_ppf_sql(p: str) -> str:
    """Newton steps from the tangent at 0, which approach the root from the centre."""
    step = f"at_ - ({norm_cdf_sql('at_')} - ({p})) / {norm_pdf_sql('at_')}"
    return f"list_reduce(list_transform(range(20), lambda k_: CAST(k_ AS DOUBLE)), lambda at_, k_: {step}, (({p}) - 0.5) * {math.sqrt(2 * math.pi)!r})"
