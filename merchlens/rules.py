"""Rule generations and the fixed text values they write."""

from __future__ import annotations

from dataclasses import dataclass

# Source types as stored and reported.
ADS = "广告"
OFFSITE = "站外推广"
ONSITE = "站内促销"
LOW_PRICE = "低价"
ORGANIC = "自然"
DISPLAY_ORDER = (ADS, OFFSITE, ONSITE, LOW_PRICE, ORGANIC)
PRIMARY_ORDER = (ADS, OFFSITE, LOW_PRICE, ORGANIC)
OFFSITE_FIRST_ORDER = (OFFSITE, ADS, ONSITE, LOW_PRICE, ORGANIC)
ALL_STORES = "全部店铺"
ROLE_PRIMARY = "主来源"
ROLE_DISPLAY = "展示项"
ROLE_DISPLAY_LONG = "展示项，不参与合计占比"
PRIMARY_TOTAL = "主来源合计"

# Allocation levels and their confidence.
DAY_SKU, MONTH_SKU, STORE_MONTH = "DAY_SKU", "MONTH_SKU", "STORE_MONTH"
CONFIDENCE = {DAY_SKU: "HIGH", MONTH_SKU: "MEDIUM", STORE_MONTH: "LOW"}

# Classification reasons.
REASON_OFFSITE = "promotion_ids命中MPC-"
REASON_ADS_STORE_MONTH = "产品表现ad_order_quantity按店铺+月份统计分配"
REASON_ADS_DAY_SKU = "按店铺+当地日期+SKU统计分配SP/SD广告订单"
REASON_ADS_BY_LEVEL = {
    DAY_SKU: "按店铺+当地日期+SKU分配SP/SD广告订单",
    MONTH_SKU: "按店铺+月份+SKU补充分配广告订单",
    STORE_MONTH: "按店铺+月份低置信度兜底广告订单",
}
REASON_ONSITE = "Percentage Off、PLM或item_promotion_discount>0"
REASON_ONSITE_OVERLAY = "站内促销仅作展示标签；主来源计入自然"


@dataclass(frozen=True)
class RuleSet:
    """One rule generation.

    ``low_price`` is the net unit price in USD up to which an otherwise
    unclaimed line counts as low price. ``promo_mode`` says whether on-site
    promotion is one of five exclusive classes or a tag laid over four.
    """

    name: str
    version: str
    allocator: str  # day_sku | hybrid | store_month
    promo_mode: str  # exclusive | overlay
    low_price: str
    reason_low_price: str
    reason_organic: str

    def with_low_price(self, low_price: str) -> RuleSet:
        return RuleSet(
            self.name, self.version, self.allocator, self.promo_mode, low_price,
            self.reason_low_price, self.reason_organic,
        )


_LOW_10 = "排除前三类后净成交单价<=10美元"
_ORGANIC_5 = "未命中站外、广告、站内促销或低价规则"

RULES = {
    r.name: r
    for r in (
        RuleSet("v1", "v1_20260727", "day_sku", "exclusive", "10", _LOW_10, _ORGANIC_5),
        RuleSet("v2", "v2_hybrid_20260727", "hybrid", "exclusive", "10", _LOW_10, _ORGANIC_5),
        RuleSet("v3", "v3_product_month_20260727", "store_month", "exclusive", "10", _LOW_10, _ORGANIC_5),
        RuleSet(
            "v4", "v4_7usd_20260728", "store_month", "exclusive", "7",
            "排除前三类后净成交单价<=7美元",
            "未命中站外、广告、站内促销，且净成交单价>7美元",
        ),
        RuleSet(
            "v5", "v5_10usd_promo_overlay_20260729", "store_month", "overlay", "10",
            "排除站外、广告和站内促销后净成交单价<=10美元",
            "未命中站外、广告或低价规则",
        ),
    )
}
