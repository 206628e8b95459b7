"""Promotion and price flags of an order line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks searched for in the upper-cased promotion ids.
OFFSITE_MARK = "MPC-"
SHIPPING_MARKS = ("FREE SHIPPING", "A3JU1FCINF5SD0")
ONSITE_MARKS = ("PERCENTAGE OFF", "PLM-")


def _has_any(column: str, marks: tuple[str, ...]) -> Column:
    found = F.lit(False)
    text = F.upper(F.coalesce(F.col(column), F.lit("")))
    for mark in marks:
        found = found | F.contains(text, F.lit(mark))
    return found


def offsite_flag(promotion_ids: str = "promotion_ids") -> Column:
    return _has_any(promotion_ids, (OFFSITE_MARK,))


def shipping_promotion_flag(promotion_ids: str = "promotion_ids") -> Column:
    return _has_any(promotion_ids, SHIPPING_MARKS)


def onsite_promotion_flag(promotion_ids: str = "promotion_ids", discount: str = "item_promotion_discount") -> Column:
    onsite = _has_any(promotion_ids, ONSITE_MARKS) | (F.coalesce(F.col(discount), F.lit(0)) > 0)
    return ~offsite_flag(promotion_ids) & onsite


def low_price_candidate_flag(low_price: str) -> Column:
    """Uses the flags and the six-digit unit price already on the line."""
    limit = F.lit(low_price).cast("decimal(18,6)")
    return ~F.col("offsite_flag") & ~F.col("onsite_promotion_flag") & (F.col("net_unit_price") <= limit)
