"""Column arithmetic shared by every layer: all JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAGUE_PRIOR = 0.230      # used while no earlier league day exists
PRIOR_STRENGTH = 200      # plate appearances the prior is worth
Z95 = 1.96


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as DOUBLE; NULL where ``b`` is 0 or NULL (ANSI would raise)."""
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0))


def rounded_to(c: Column | str, digits: int) -> Column:
    """A DOUBLE to so many digits, halves away from zero.

    ``round`` goes through the decimal text of every value. Small numbers are
    scaled, cut and scaled back instead: both numbers are whole then, so the
    quotient is the double nearest to the decimal.
    """
    x, scale = col(c), 10.0 ** digits
    near = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + 0.0   # no negative zero
    return F.when(F.abs(x) < 1024, near).otherwise(F.round(x, digits))


def rate(a: Column | str, b: Column | str, digits: int = 4) -> Column:
    return rounded_to(safe_div(a, b), digits)


def count_true(flag: Column | str) -> Column:
    return F.count_if(col(flag))


def avg_where(value: Column | str, flag: Column | str) -> Column:
    return F.avg(F.when(col(flag), col(value)))


def eb_shrink(successes: Column | str, trials: Column | str, prior: Column | str,
              strength: float = PRIOR_STRENGTH) -> Column:
    """Beta-prior shrinkage of a rate towards ``prior``."""
    return (col(successes) + F.lit(float(strength)) * col(prior)) / (col(trials) + F.lit(float(strength)))


def wilson(k: Column | str, n: Column | str, z: float = Z95) -> tuple[Column, Column]:
    """Wilson interval of k successes in n trials; NULL where n is 0."""
    n_ = F.nullif(col(n).cast("double"), F.lit(0.0))
    p = col(k).cast("double") / n_
    z2 = z * z
    scale = 1 + F.lit(z2) / n_
    centre = (p + F.lit(z2) / (2 * n_)) / scale
    # p(1-p) can dip below 0 by rounding at p = 1
    spread = F.greatest(p * (1 - p), F.lit(0.0)) / n_ + F.lit(z2) / (4 * n_ * n_)
    half = F.lit(z) * F.sqrt(spread) / scale
    return centre - half, centre + half


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least alone would skip it)."""
    x = col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def at_least_one(p: Column | str, trials: Column | str) -> Column:
    """Chance of one or more successes in ``trials`` tries of chance ``p``."""
    return 1 - F.pow(1 - col(p), col(trials))


def lineup_slot(order: Column | str) -> Column:
    """Batting-order code (100 = first starter) to slot, rounding halves to even."""
    return F.rint(col(order) / 100).cast("int")
