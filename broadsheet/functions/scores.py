"""Sentiment scores: labels, calibration, confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels in the order that breaks ties, and the calibration's weights.
LABELS = ("negative", "neutral", "positive")
FLOOR, SPAN, FULL_MARGIN = 0.65, 0.35, 0.75


def clip(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def margin(scores: Column) -> Column:
    """Difference of the two largest values of a map label -> score; the only value where there is one."""
    top = F.sort_array(F.map_values(scores), asc=False)
    return F.try_element_at(top, F.lit(1)) - F.coalesce(F.try_element_at(top, F.lit(2)), F.lit(0.0))


def calibrated(label: Column, scores: Column) -> Column:
    """The label's score lowered where the runner-up is close; 6 digits.

    The label's own score counts as the top even where another is larger; then the margin is 0.
    """
    own = clip(F.coalesce(F.try_element_at(scores, label), F.lit(0.0)))
    rest = F.array_max(F.map_values(F.map_filter(scores, lambda k, _: k != label)))
    lead = F.greatest(F.lit(0.0), own - clip(F.coalesce(rest, F.lit(0.0))))
    return F.round(clip(own * (FLOOR + SPAN * F.least(F.lit(1.0), lead / FULL_MARGIN))), 6)


def calibrated_scores(label: Column, scores: Column) -> Column:
    """The map with the label's entry calibrated; other entries stay as they are."""
    value = calibrated(label, scores)
    return F.transform_values(scores, lambda k, v: F.when(k == label, value).otherwise(v))


def bucket(score: Column) -> Column:
    return F.when(score.isNull(), "missing").when(score < 0.55, "low").when(score < 0.75, "mid").otherwise("high")


def top_label(scores: Column, order: tuple[str, ...] = LABELS) -> Column:
    """The label with the largest score; ties go to the label that comes first in `order`."""
    ranked = [F.struct(F.coalesce(F.try_element_at(scores, F.lit(k)), F.lit(-1.0)).alias("v"), F.lit(-i).alias("o"), F.lit(k).alias("k")) for i, k in enumerate(order)]
    return F.array_max(F.array(*ranked))["k"]
