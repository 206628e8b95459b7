"""Valid order lines and the attribution base built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import promo
from merchlens.functions.dates import in_pacific_months, month_of, pacific_date
from merchlens.functions.text import same_text, sku_key
from merchlens.scope import Scope

MONEY = "decimal(18,4)"
UNIT_PRICE = "decimal(18,6)"

BASE_COLUMNS = (
    "source_id", "store_name", "order_date", "order_month", "purchase_date_utc",
    "amazon_order_id", "order_item_id", "sku", "sku_key", "asin", "quantity", "currency",
    "gross_item_sales", "item_promotion_discount", "net_item_sales", "net_unit_price",
    "promotion_ids", "offsite_flag", "shipping_promotion_flag", "onsite_promotion_flag",
    "low_price_candidate_flag",
)


def is_valid_line() -> Column:
    """Shipped US-site USD lines with quantity, price, SKU and a purchase time."""
    return (
        F.col("purchase_date_utc").isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("item_price") > 0)
        & F.col("sku").isNotNull()
        & (F.trim("sku") != "")
        & same_text("sales_channel", "Amazon.com")
        & same_text("order_status", "Shipped")
        & same_text("item_status", "Shipped")
        & same_text("currency", "USD")
    )


def valid_orders(orders: DataFrame, scope: Scope | None = None) -> DataFrame:
    lines = orders
    if scope is not None:
        lines = lines.filter(in_pacific_months("purchase_date_utc", scope.start, scope.end))
        lines = scope.fold_store(lines)
    return lines.filter(is_valid_line())


def order_base(orders: DataFrame, scope: Scope | None = None, low_price: str = "10") -> DataFrame:
    """Narrow: one row in, at most one row out, no shuffle."""
    for name in ("source_id", "asin"):
        if name not in orders.columns:
            orders = orders.withColumn(name, F.lit(None).cast("string"))
    gross = F.coalesce("item_price", F.lit(0)).cast(MONEY)
    discount = F.coalesce("item_promotion_discount", F.lit(0)).cast(MONEY)
    net = (gross - discount).cast(MONEY)
    priced = (
        valid_orders(orders, scope)
        .withColumns({
            "order_date": pacific_date("purchase_date_utc"),
            "order_item_id": F.coalesce("order_item_id", F.lit("")),
            "sku_key": sku_key("sku"),
            "offsite_flag": promo.offsite_flag(),
            "shipping_promotion_flag": promo.shipping_promotion_flag(),
            "onsite_promotion_flag": promo.onsite_promotion_flag(),
            "gross_item_sales": gross,
            "net_item_sales": net,
            "net_unit_price": (net / F.col("quantity")).cast(UNIT_PRICE),
        })
        .withColumns({
            "item_promotion_discount": discount,
            "order_month": month_of("order_date"),
            "low_price_candidate_flag": promo.low_price_candidate_flag(low_price),
        })
    )
    return priced.select(*BASE_COLUMNS)
