"""Report jobs: every sheet as a DataFrame, and a sink that writes them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from merchlens.operators import deal_price as dp
from merchlens.operators import source_report as sr
from merchlens.operators.audit import audit_report
from merchlens.schemas import require_columns, schema_of
from merchlens.scope import Scope, infer_scope
from merchlens.session import materialize
from merchlens.sources.warehouse import Warehouse

# Sheet column titles.
TITLES = {
    "main_order_type": "来源类型", "order_sku_count": "订单-SKU数", "order_sku_share": "订单占比",
    "units": "销量", "net_item_sales": "净商品销售额", "net_sales_share": "销售额占比",
    "month": "月份", "order_month": "月份", "metric_role": "指标角色", "gross_item_sales": "毛商品销售额",
    "period": "统计周期", "period_status": "周期状态", "store_name": "店铺", "covered_months": "覆盖月份数",
    "classified_item_rows": "明细行数", "amazon_order_count": "Amazon订单数",
    "product_order_items": "产品表现订单量", "product_ad_order_target": "广告目标",
    "product_promotion_orders": "产品表现促销订单", "msku_count": "MSKU数",
    "base_order_sku_count": "有效订单-SKU", "offsite_order_sku_count": "站外订单-SKU",
    "non_offsite_capacity": "非站外容量", "allocated_ad_orders": "已分配广告订单",
    "unallocated_ad_orders": "未分配广告订单", "allocation_rate": "分配完成率",
    "source_gap_order_sku": "两数据源订单差异", "source_gap_rate": "差异率", "created_at": "生成时间",
    "principal": "负责人（运营）", "style_no": "款号", "season": "季节", "category": "品类",
    "total_units": "全期间销量", "total_weighted_price": "全期间加权成交价", "local_sku_count": "本地SKU数",
    "item_promotion_discount": "商品促销折扣", "weighted_deal_price": "销量加权成交价",
    "min_deal_price": "最低单件成交价", "max_deal_price": "最高单件成交价", "msku": "MSKU",
    "mapping_result": "映射结果", "has_data": "是否有订单数据",
}
# Titles that differ on one sheet.
SHEET_TITLES = {
    "店铺月度明细": {"order_sku_share": "店铺月内占比"},
    "广告审计": {"status": "结果状态"},
    "月份覆盖": {"status": "状态说明"},
}


def source_report(
    warehouse: Warehouse, scope: Scope | None = None, include_partial: bool = False
) -> dict[str, DataFrame]:
    """Sheets over the stored monthly rollup and audit."""
    monthly = warehouse.read("dws_amz_order_source_monthly")
    scope = scope or infer_scope(monthly)
    detail = scope.apply(monthly)
    if detail.isEmpty():
        raise ValueError("no monthly rollup rows in the scope")
    audit = scope.apply(warehouse.read("dws_amz_product_performance_ad_monthly_audit"))
    return {
        "总览": sr.report_overall(detail, scope),
        "月度汇总": sr.report_month(detail, scope),
        "季度汇总": sr.report_quarter(detail, scope, include_partial),
        "半年度汇总": sr.report_half(detail, scope, include_partial),
        "店铺月度明细": sr.report_store_month(detail, scope),
        "广告审计": audit_report(audit).orderBy("month", "store_name"),
    }


def deal_price_report(
    orders: DataFrame, listing: DataFrame, product: DataFrame, scope: Scope, today: dt.date,
    by_store: bool = False,
) -> dict[str, DataFrame]:
    """Deal price sheets. The MSKU months are aggregated once and every sheet reads them."""
    require_columns(
        orders,
        ["purchase_date_utc", "store_name", "amazon_order_id", "sku", "quantity", "currency", "item_price",
         "item_promotion_discount", "sales_channel", "order_status", "item_status"],
        "orders",
    )
    require_columns(listing, schema_of("listing").names, "listing")
    require_columns(product, schema_of("product_category_snapshot").names, "product snapshot")
    msku = materialize(dp.msku_month(orders, scope), "msku-month")
    if msku.isEmpty():
        raise ValueError("no valid orders in the scope")
    mapped = materialize(
        dp.map_styles(msku, dp.best_listing(listing, scope.stores), dp.product_dims(product)), "mapped-msku"
    )
    if by_store:
        return {
            store: dp.deal_price_by_store(mapped, scope.months, store)
            for store in scope.stores or sorted(r[0] for r in mapped.select("store_name").distinct().collect())
        }
    return {
        "款号月成交价_宽表": dp.deal_price_wide(mapped, scope.months),
        "款号月成交价_长表": dp.deal_price_long(mapped),
        "映射审计": dp.mapping_audit(mapped),
        "月份覆盖": dp.month_coverage(msku, scope, today),
    }


def titled(sheet: str, df: DataFrame) -> DataFrame:
    names = {**TITLES, **SHEET_TITLES.get(sheet, {})}
    return df.toDF(*[names.get(c, c) for c in df.columns])


def write_sheets(sheets: dict[str, DataFrame], root: str, fmt: str = "csv") -> None:
    """One folder per sheet with the sheet's titles."""
    for sheet, df in sheets.items():
        writer = titled(sheet, df).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{root.rstrip('/')}/{sheet}")


def write_by_store(df: DataFrame, root: str, sheet: str = "款号月成交价", fmt: str = "csv") -> None:
    """One folder per store of a sheet that has a store column, in a single write."""
    writer = titled(sheet, df).write.mode("overwrite").partitionBy("店铺")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(f"{root.rstrip('/')}/{sheet}")

