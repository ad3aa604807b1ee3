"""Column-expression helpers (all JVM-side, codegen-friendly)."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dround(col: Column | str, digits: int) -> Column:
    """ROUND(x, n) as the reference engine computes it: scale, round half away
    from zero on the binary double, unscale.  Spark's ``round`` instead rounds the
    shortest decimal text, which differs for values such as 0.285."""
    return _scaled_round(col, float(10 ** digits))


def _scaled_round(col: Column | str, scale: float) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_div(num: Column, den: Column) -> Column:
    """num / den with NULL for a zero or NULL denominator (``x / NULLIF(y, 0)``)."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def flag(pred: Column) -> Column:
    """Boolean predicate as 0/1 integer (NULL predicate -> 0 inside MAX/SUM)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def months_between_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundary count between two timestamps."""
    return (F.floor(F.unix_micros(end.cast("timestamp")) / 1_000_000)
            - F.floor(F.unix_micros(start.cast("timestamp")) / 1_000_000)).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Fractional seconds since the epoch for a zone-less timestamp."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix_`` + first 20 hex chars of sha256 over '|'-joined parts; NULL parts
    render as 'None' (Python ``str(None)``)."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(text, 256), 1, 20))


def clip_lower(x: Column, lower: float) -> Column:
    """pandas ``clip(lower=...)``: NULL stays NULL (``greatest`` would skip it)."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(lower)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return F.log(q / (F.lit(1.0) - q))


def norm_cdf(x: Column) -> Column:
    """Standard normal CDF via erf (Abramowitz-Stegun 7.1.26 has 1.5e-7 error; use
    the complementary form with a high-accuracy rational approximation)."""
    z = F.abs(x) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    # Numerical Recipes erfc approximation, fractional error < 1.2e-7.
    poly = (F.lit(-1.26551223) + t * (F.lit(1.00002368) + t * (F.lit(0.37409196) + t * (
        F.lit(0.09678418) + t * (F.lit(-0.18628806) + t * (F.lit(0.27886807) + t * (
            F.lit(-1.13520398) + t * (F.lit(1.48851587) + t * (F.lit(-0.82215223)
                                                              + t * F.lit(0.17087277))))))))))
    erfc = t * F.exp(-z * z + poly)
    return F.when(x >= 0, F.lit(1.0) - F.lit(0.5) * erfc).otherwise(F.lit(0.5) * erfc)


def norm_ppf_scalar(p: float) -> float:
    """Inverse standard normal CDF for a driver-side scalar parameter."""
    from statistics import NormalDist
    return NormalDist().inv_cdf(p)
