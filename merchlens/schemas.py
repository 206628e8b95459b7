"""Table schemas, and helpers that fit a frame to one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header of the strict order report, in file order.
ORDER_HEADERS = [
    "amazon-order-id", "merchant-order-id", "purchase-date", "last-updated-date", "order-status",
    "fulfillment-channel", "sales-channel", "order-channel", "url", "ship-service-level",
    "product-name", "sku", "asin", "item-status", "quantity", "currency", "item-price", "item-tax",
    "shipping-price", "shipping-tax", "gift-wrap-price", "gift-wrap-tax", "item-promotion-discount",
    "ship-promotion-discount", "ship-city", "ship-state", "ship-postal-code", "ship-country",
    "promotion-ids", "cpf", "is-business-order", "purchase-order-number", "price-designation",
    "customized-url", "customized-page", "signature-confirmation-recommended",
    "buyer-identification-number", "buyer-identification-type", "order-item-id",
]
INT_COLUMNS = ("quantity",)
MONEY_COLUMNS = (
    "item_price", "item_tax", "shipping_price", "shipping_tax", "gift_wrap_price", "gift_wrap_tax",
    "item_promotion_discount", "ship_promotion_discount",
)
BOOL_COLUMNS = ("is_business_order", "signature_confirmation_recommended")
DATE_COLUMNS = ("purchase_date", "last_updated_date")


def _order_column(name: str) -> str:
    if name in INT_COLUMNS:
        return f"{name} int"
    if name in MONEY_COLUMNS:
        return f"{name} decimal(18,4)"
    if name in BOOL_COLUMNS:
        return f"{name} boolean"
    if name in DATE_COLUMNS:
        return f"{name}_raw string, {name}_utc timestamp_ntz"
    return f"{name} string"


ORDERS = ", ".join(
    [
        "store_name string", "report_month date", "source_file string", "source_file_sha256 string",
        "source_row_no bigint", "import_batch_no string",
    ]
    + [_order_column(h.replace("-", "_")) for h in ORDER_HEADERS]
    + ["created_at timestamp_ntz", "updated_at timestamp_ntz"]
)
ORDER_KEY = ["store_name", "amazon_order_id", "order_item_id"]
ORDER_NOT_NULL = (
    "store_name", "source_file", "source_file_sha256", "source_row_no", "import_batch_no",
    "amazon_order_id", "order_item_id",
)

PERFORMANCE_INTS = (
    "volume", "order_items", "promotion_volume", "promotion_order_items", "clicks", "sessions_total",
    "page_views_total", "ad_order_quantity", "ad_direct_order_quantity", "impressions",
)
PERFORMANCE_MONEY = ("amount", "promotion_amount", "ad_sales_amount", "ad_direct_sales_amount", "spend")
PERFORMANCE_KEY = ["report_month", "sid", "msku"]

TABLES = {
    "ods_amz_all_orders_report": ORDERS,
    "etl_file_import_log": (
        "target_table string, store_name string, report_month date, source_file string, "
        "source_file_sha256 string, file_size_bytes bigint, import_batch_no string, status string, "
        "total_rows bigint, processed_rows bigint, inserted_or_updated_rows bigint, error_message string, "
        "started_at timestamp_ntz, finished_at timestamp_ntz"
    ),
    "ods_product_performance_monthly_msku": (
        "report_month date, period_start date, period_end date, sid bigint, store_name string, "
        "country string, msku string, sku string, asin string, parent_asin string, item_name string, "
        "volume bigint, order_items bigint, amount decimal(20,6), promotion_volume bigint, "
        "promotion_order_items bigint, promotion_amount decimal(20,6), clicks bigint, "
        "sessions_total bigint, page_views_total bigint, ad_order_quantity bigint, "
        "ad_direct_order_quantity bigint, ad_sales_amount decimal(20,6), "
        "ad_direct_sales_amount decimal(20,6), spend decimal(20,6), impressions bigint, "
        "currency_code string, raw_json string"
    ),
    "etl_product_performance_monthly_log": (
        "report_month date, sid bigint, store_name string, status string, interface_total bigint, "
        "fetched_rows bigint, written_rows bigint, started_at timestamp_ntz, finished_at timestamp_ntz, "
        "error_message string"
    ),
    "ods_ad_spend_daily": (
        "store_name string, report_date date, sku string, asin string, ad_type string, orders bigint, "
        "sales decimal(18,4), cost decimal(18,4), clicks bigint, impressions bigint"
    ),
    "etl_monthly_delivery_log": (
        "store_name string, report_month date, source_file string, delivered_at timestamp, loaded_at timestamp_ntz"
    ),
    "listing": "`店铺` string, `店铺id` string, MSKU string, SKU string, `负责人` string, `状态` int",
    "product_category_snapshot": (
        "sku string, product_name string, spu string, category_name string, category_path string, "
        "custom_fields_json string"
    ),
    "dwd_amz_order_attribution_base": (
        "source_id string, store_name string, order_date date, order_month date, "
        "purchase_date_utc timestamp_ntz, amazon_order_id string, order_item_id string, sku string, "
        "sku_key string, asin string, quantity int, currency string, gross_item_sales decimal(18,4), "
        "item_promotion_discount decimal(18,4), net_item_sales decimal(18,4), "
        "net_unit_price decimal(18,6), promotion_ids string, offsite_flag boolean, "
        "shipping_promotion_flag boolean, onsite_promotion_flag boolean, "
        "low_price_candidate_flag boolean, rule_version string"
    ),
    "dws_amz_ad_order_demand_daily": (
        "store_name string, report_date date, order_month date, sku_key string, asin string, "
        "sp_orders bigint, sd_orders bigint, ad_orders_raw bigint, ad_sales decimal(28,4), "
        "ad_cost decimal(28,4), clicks bigint, impressions bigint, positive_ad_type_count int, "
        "multi_ad_type_flag boolean"
    ),
    "dws_amz_ad_order_demand_monthly": (
        "order_month date, store_name string, msku_count bigint, product_order_items bigint, "
        "ad_order_quantity bigint, promotion_order_items bigint, product_units bigint, "
        "product_sales decimal(20,4)"
    ),
    "dwd_amz_ad_order_allocation": (
        "store_name string, order_date date, order_month date, sku_key string, amazon_order_id string, "
        "first_purchase_date_utc timestamp_ntz, candidate_rank bigint, candidate_orders bigint, "
        "sp_orders bigint, sd_orders bigint, ad_orders_raw bigint, allocated_ad_orders bigint, "
        "unallocated_ad_orders bigint, estimated_ad_flag boolean, allocation_level string, "
        "allocation_confidence string, allocation_version string"
    ),
    "dwd_amz_order_attribution_result": (
        "source_id string, store_name string, order_date date, order_month date, amazon_order_id string, "
        "order_item_id string, sku string, sku_key string, asin string, quantity int, "
        "gross_item_sales decimal(18,4), net_item_sales decimal(18,4), net_unit_price decimal(18,6), "
        "promotion_ids string, offsite_flag boolean, estimated_ad_flag boolean, "
        "ad_allocation_level string, ad_allocation_confidence string, onsite_promotion_flag boolean, "
        "low_price_flag boolean, main_order_type string, classification_reason string, "
        "candidate_rank bigint, ad_orders_raw bigint, rule_version string"
    ),
    "dws_amz_order_source_monthly": (
        "order_month date, store_name string, main_order_type string, classified_item_rows bigint, "
        "order_sku_count bigint, amazon_order_count bigint, units bigint, "
        "gross_item_sales decimal(20,4), net_item_sales decimal(20,4)"
    ),
    "dws_amz_product_performance_ad_monthly_audit": (
        "order_month date, store_name string, product_order_items bigint, "
        "product_ad_order_target bigint, product_promotion_orders bigint, msku_count bigint, "
        "base_order_sku_count bigint, offsite_order_sku_count bigint, non_offsite_capacity bigint, "
        "allocated_ad_orders bigint, unallocated_ad_orders bigint, allocation_pct decimal(10,4), "
        "source_gap_order_sku bigint, created_at timestamp_ntz"
    ),
    "dws_amz_ad_allocation_monthly_audit": (
        "order_month date, store_name string, raw_ad_orders bigint, conservative_target_orders bigint, "
        "day_sku_allocated bigint, month_sku_allocated bigint, store_month_allocated bigint, "
        "total_allocated bigint, unallocated_orders bigint, allocation_pct decimal(10,4)"
    ),
}

# Folder layout of the written tables; unlisted tables are not partitioned.
PARTITIONS = {
    "ods_amz_all_orders_report": ["store_name", "report_month"],
    "ods_product_performance_monthly_msku": ["report_month", "sid"],
    "dwd_amz_order_attribution_base": ["order_month", "store_name"],
    "dws_amz_ad_order_demand_daily": ["order_month", "store_name"],
    "dws_amz_ad_order_demand_monthly": ["order_month", "store_name"],
    "dwd_amz_ad_order_allocation": ["order_month", "store_name"],
    "dwd_amz_order_attribution_result": ["order_month", "store_name"],
    "dws_amz_order_source_monthly": ["order_month", "store_name"],
    "dws_amz_product_performance_ad_monthly_audit": ["order_month", "store_name"],
    "dws_amz_ad_allocation_monthly_audit": ["order_month", "store_name"],
}


# Logs are only ever appended to: of the entries of a key the one written last counts.
LOG_KEYS = {
    "etl_file_import_log": ["target_table", "store_name", "source_file_sha256"],
    "etl_product_performance_monthly_log": ["report_month", "sid"],
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in its order and types; missing ones become null.

    Older files without a later column read as null under the same schema, so
    adding a column to a table needs no rewrite.
    """
    columns = []
    for field in schema_of(table):
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        columns.append(source.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def require_columns(df: DataFrame, required: Iterable[str], name: str = "input") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}; it has {sorted(df.columns)}")
    return df
