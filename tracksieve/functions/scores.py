"""Gate, route, rates and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config


def gate(score: Column, auto: float, low: float) -> Column:
    """auto_accept, hitl or discard; both bounds inclusive, null and NaN discard."""
    sound = score.isNotNull() & ~F.isnan(score)
    return F.when(sound & (score >= auto), "auto_accept").when(sound & (score >= low), "hitl").otherwise("discard")


def status(score: Column, config: Config) -> Column:
    return F.when(score >= config.known_threshold, "known").otherwise("unknown")


def route(gated: Column, known: Column) -> Column:
    """First that matches: accepted and known, emit; to review or unknown, queue; else discard."""
    return F.when((gated == "auto_accept") & (known == "known"), "emit").when((gated == "hitl") | (known == "unknown"), "queue").otherwise("discard")


def rate(part: Column, whole: Column) -> Column:
    return part / (whole + 1e-9)


def guarded(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def rounded(value: Column | str, places: int) -> Column:
    """Rounded as SQL engines do that scale, round half away from zero and scale back, in double. F.round goes by the
    shortest decimal instead, which differs where a value was rounded before: 0.1309425 is 0.130943 there, not 0.130942."""
    x = (F.col(value) if isinstance(value, str) else value) * F.lit(float(10**places))
    return F.when(F.abs(x - F.rint(x)) == 0.5, x + F.signum(x) * 0.5).otherwise(F.rint(x)) / F.lit(float(10**places))


def final_label(status: str = "status") -> Column:
    """A reviewer's label if there is one that isn't empty, else the suggested one of a known cluster."""
    return F.coalesce(F.nullif(F.col("hitl_label"), F.lit("")), F.when(F.col(status) == "known", F.col("clip_label")))


def purity(auto: Column, hitl: Column, config: Config) -> Column:
    n = auto + hitl
    return F.when(n == 0, 0.0).otherwise((auto * config.auto_purity + hitl * config.hitl_purity) / n)
