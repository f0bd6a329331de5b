"""Classification and label expressions (C7, O7, Q8, D8, D10, day names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config import DAY_NAMES


def classify_elasticity(e: Column) -> Column:
    """|e| < 0.8 inelastic, |e| > 1.2 elastic, otherwise unit_elastic."""
    a = F.abs(e)
    return (F.when(a < 0.8, F.lit("inelastic"))
            .when(a > 1.2, F.lit("elastic"))
            .when(a.isNotNull(), F.lit("unit_elastic")))


def recommendation_label(discount_pct: Column) -> Column:
    """Label on the optimal discount in percent (40 itself is Clearance)."""
    return (F.when(discount_pct < 2, F.lit("No Change"))
            .when(discount_pct < 10, F.lit("Mild Markdown"))
            .when(discount_pct < 25, F.lit("Moderate Markdown"))
            .when(discount_pct < 40, F.lit("Deep Markdown"))
            .otherwise(F.lit("Clearance Sale")))


def discount_band(discount_pct: Column) -> Column:
    """Q8: upper-inclusive bands on a percent discount; NULL falls to 31%+."""
    return (F.when(discount_pct == 0, F.lit("No Discount"))
            .when(discount_pct <= 10, F.lit("1-10%"))
            .when(discount_pct <= 20, F.lit("11-20%"))
            .when(discount_pct <= 30, F.lit("21-30%"))
            .otherwise(F.lit("31%+")))


# Dashboard descriptions per |elasticity| band.
ELASTICITY_TEXT = (
    (1.5, "Price changes have a strong impact on demand. Discounts will significantly boost volume."),
    (1.0, "Demand is sensitive to price. Moderate discounts can drive meaningful sales lifts."),
    (0.8, "Demand is relatively stable with price changes. Focus on margin over volume."),
    (None, "Very stable demand. Pricing power is strong — avoid unnecessary discounts."),
)


def elasticity_display(e: Column) -> Column:
    """Dashboard description for |e| (bands > 1.5, > 1, > 0.8, else)."""
    a = F.abs(e)
    expr = None
    for limit, text in ELASTICITY_TEXT:
        if limit is None:
            return expr.otherwise(F.lit(text))
        expr = (F.when(a > limit, F.lit(text)) if expr is None
                else expr.when(a > limit, F.lit(text)))
    return expr


def elasticity_colour_band(e: Column) -> Column:
    """Chart band: > 1.5 high, > 1 medium, else low."""
    a = F.abs(e)
    return F.when(a > 1.5, F.lit("high")).when(a > 1.0, F.lit("medium")).otherwise(F.lit("low"))


def elasticity_badge(e: Column) -> Column:
    """Badge class: >1 elastic, >0.9 unit, else inelastic."""
    a = F.abs(e)
    return (F.when(a > 1.0, F.lit("elastic"))
            .when(a > 0.9, F.lit("unit"))
            .otherwise(F.lit("inelastic")))


def discount_level(discount_pct: Column) -> Column:
    """<=10 low, <=25 medium, else high."""
    return (F.when(discount_pct <= 10, F.lit("low"))
            .when(discount_pct <= 25, F.lit("medium"))
            .otherwise(F.lit("high")))


def margin_level(margin_pct: Column) -> Column:
    """>30 high, >15 medium, else low."""
    return (F.when(margin_pct > 30, F.lit("high"))
            .when(margin_pct > 15, F.lit("medium"))
            .otherwise(F.lit("low")))


def day_name(day_of_week: Column) -> Column:
    """Monday=0 .. Sunday=6 -> name."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, (day_of_week + 1).cast("int"))
