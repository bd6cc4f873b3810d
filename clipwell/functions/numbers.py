"""Numeric expressions: count texts, rates, buckets, range scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwell.functions.coerce import real, text

# Count suffixes.
WAN = "万"
YI = "亿"


def rate(num: Column, den: Column, digits: int | None = None) -> Column:
    """num/den, 0 when the denominator is not positive."""
    r = F.coalesce(F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double"))), F.lit(0.0))
    return r if digits is None else rounded(r, digits)


def rounded(c: Column, digits: int) -> Column:
    """Half-even rounding of a computed mean or ratio.

    The value is first cut to 10 digits, so the order in which a cluster adds
    up doubles cannot flip a tie.
    """
    return F.bround(F.bround(c, 10), digits)


def bounded(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Clamp; null stays null (``greatest`` and ``least`` alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c)))


def share_of(num: Column, den: Column) -> Column:
    """Rate bounded to [0, 1]."""
    return bounded(rate(num, den))


def percentage(num: Column, den: Column) -> Column:
    return F.bround(F.greatest(F.lit(0.0), rate(num, den)) * 100.0, 2)


def score100(c: Column) -> Column:
    """Half-even rounded integer clamped to 0-100."""
    return bounded(F.bround(c, 0), 0.0, 100.0).cast("bigint")


def steps(c: Column, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first cut that is reached; cuts are in descending order."""
    head, *rest = cuts
    expr = F.when(c >= head[0], F.lit(head[1]))
    for cut, label in rest:
        expr = expr.when(c >= cut, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def page_count(c: str | Column) -> Column:
    """Count from page text: separators dropped, 万/亿 multiply, rounded, never negative."""
    bare = F.regexp_replace(F.btrim(text(c), F.lit("\"'` ,;:]})")), "[,_ ]", "")
    times = F.when(bare.endswith(WAN), 1e4).when(bare.endswith(YI), 1e8).otherwise(1.0)
    digits = F.regexp_replace(bare, r"[^0-9.\-]", "")
    value = F.when(~digits.isin("", "-", ".", "-."), digits.try_cast("double"))
    return F.greatest(F.lit(0).cast("bigint"), F.bround(value * times, 0).cast("bigint")) * F.when(
        value.isNotNull(), F.lit(1).cast("bigint")
    )


def comment_count_text(c: str | Column) -> Column:
    """Count from comment meta text: commas dropped, w/万 multiply, truncated, junk 0."""
    bare = F.replace(F.lower(text(c)), F.lit(","), F.lit(""))
    big = bare.endswith("w") | bare.endswith(WAN)
    digits = F.when(big, F.left(bare, F.length(bare) - 1)).otherwise(bare)
    value = digits.try_cast("double") * F.when(big, 1e4).otherwise(1.0)
    zero = F.lit(0).cast("bigint")
    return F.greatest(zero, F.coalesce(value.try_cast("bigint"), zero))


def brightness(c: Column) -> Column:
    return steps(c, [(150, "bright"), (95, "balanced")], "dark")


def saturation(c: Column) -> Column:
    return steps(c, [(55, "high"), (20, "medium")], "low")


def contrast(c: Column) -> Column:
    return steps(c, [(140, "high"), (80, "medium")], "low")


def rhythm(bright_spread: Column, sat_spread: Column, contrast_spread: Column) -> Column:
    movement = bright_spread * 0.45 + sat_spread * 0.25 + contrast_spread * 0.30
    return steps(movement, [(45, "dynamic"), (18, "mixed")], "stable")


def duration_bucket(c: Column) -> Column:
    return steps(c, [(45, "long"), (15, "medium")], "short")


def resolution(width: Column, height: Column) -> Column:
    return steps(F.greatest(width, height), [(3000, "4k_like"), (1800, "high"), (1000, "standard")], "low")


def bitrate(c: Column) -> Column:
    return F.when(c > 0, steps(c, [(4_000_000, "high"), (1_500_000, "medium")], "low")).otherwise(F.lit("unknown"))


def subtitle_readability(bright: Column, span: Column) -> Column:
    return F.when((span >= 150) & bright.between(40, 220), "high").when(span >= 90, "medium").otherwise("low")


def sample_points(duration: Column, count: int) -> Column:
    """Evenly spread timestamps between 15% and 85% of the duration."""
    if count <= 0:
        return F.array().cast("array<double>")
    latest = F.greatest(duration - 0.1, F.lit(0.0))
    if count == 1:
        return F.array(F.when(duration <= 0, 0.0).otherwise(F.least(duration * 0.2, latest)))
    step = duration * 0.7 / (count - 1)
    points = F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.bround(F.least(duration * 0.15 + step * i, latest), 3),
    )
    return F.when(duration <= 0, F.array_repeat(F.lit(0.0), count)).otherwise(points)


def range_score(value: Column, target: Column, scale: float) -> Column:
    """100 inside [low, high], else linear in the distance to low, mid or high; 50 without a target."""
    low, mid, high = (real(target[k]) for k in ("low", "mid", "high"))
    gap = F.least(F.abs(value - low), F.abs(value - high), F.abs(value - mid))
    outside = F.greatest(F.lit(0.0), 100.0 - gap / max(scale, 1e-6) * 100.0)
    return F.when(target.isNull(), 50.0).when(value.between(low, high), 100.0).otherwise(outside)


def speech_score(value: Column, mid: Column) -> Column:
    return F.greatest(F.lit(0.0), 100.0 - F.abs(value - F.coalesce(mid, F.lit(260.0))) / 220.0 * 100.0)


def person_score(value: Column) -> Column:
    return (
        F.when(value <= 1.2, 100.0)
        .when(value <= 1.8, 80.0)
        .otherwise(F.greatest(F.lit(20.0), 80.0 - (value - 1.8) * 16.0))
    )


def all_of(*conds: Column) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def any_of(*conds: Column) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def as_int(c: Column) -> Column:
    return c.cast("int")


def count_where(c: Column) -> Column:
    return F.count_if(c).cast("bigint")


def level(score: Column, high: float, medium: float) -> Column:
    return steps(score, [(high, "high"), (medium, "medium")], "low")


