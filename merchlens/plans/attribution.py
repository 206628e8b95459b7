"""Attribution jobs: from stored orders to the monthly rollup and audits."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.operators.allocate import allocate_day_sku, allocate_hybrid, allocate_store_month
from merchlens.operators.audit import allocation_audit, create_audit_view, hybrid_audit
from merchlens.operators.base import order_base
from merchlens.operators.classify import classify, reclassify, reflag_base
from merchlens.operators.demand import ad_demand_daily, ad_demand_monthly, of_ad_type
from merchlens.operators.rollup import source_monthly
from merchlens.rules import RuleSet
from merchlens.scope import Scope, infer_scope
from merchlens.sources.warehouse import Warehouse

ORDERS = "ods_amz_all_orders_report"
PERFORMANCE = "ods_product_performance_monthly_msku"
AD_SPEND = "ods_ad_spend_daily"
BASE = "dwd_amz_order_attribution_base"
DEMAND_DAILY = "dws_amz_ad_order_demand_daily"
DEMAND_MONTHLY = "dws_amz_ad_order_demand_monthly"
ALLOCATION = "dwd_amz_ad_order_allocation"
RESULT = "dwd_amz_order_attribution_result"
MONTHLY = "dws_amz_order_source_monthly"
AUDIT = "dws_amz_product_performance_ad_monthly_audit"
HYBRID_AUDIT = "dws_amz_ad_allocation_monthly_audit"


def default_scope(warehouse: Warehouse, rules: RuleSet) -> Scope:
    """Months and stores covered by the ad source the rules use."""
    if rules.allocator == "store_month":
        source, month = warehouse.read(PERFORMANCE), "report_month"
    else:
        source, month = warehouse.read(AD_SPEND).filter(of_ad_type("SP", "SD")), "report_date"
    # The store list is an argument of the run, as a caller would type it.
    # Spellings that differ in case only are one store.
    names = source.groupBy(F.upper("store_name")).agg(F.min("store_name").alias("store_name"))
    stores = [r.store_name for r in names.orderBy("store_name").select("store_name").collect()]
    return infer_scope(source, month, stores)


def run_attribution(
    warehouse: Warehouse, rules: RuleSet, scope: Scope | None = None, now: dt.datetime | None = None
) -> DataFrame:
    """Rebuild every attribution table for the scope and return the monthly rollup.

    All months and stores run together; each table is written once, in
    dependency order, and later steps read what was written. Stores and months
    outside the scope are left as they are.
    """
    scope = scope or default_scope(warehouse, rules)
    in_scope = scope.month_filter() & scope.store_filter()

    def publish(table: str, df: DataFrame) -> DataFrame:
        warehouse.replace_partitions(table, df, in_scope)
        return scope.apply(warehouse.read(table))

    if rules.allocator == "store_month":
        demand = publish(DEMAND_MONTHLY, ad_demand_monthly(warehouse.read(PERFORMANCE), scope))
    else:
        demand = publish(DEMAND_DAILY, ad_demand_daily(warehouse.read(AD_SPEND), scope))
    base = order_base(warehouse.read(ORDERS), scope, rules.low_price)
    base = publish(BASE, base.withColumn("rule_version", F.lit(rules.version)))
    allocate = {
        "store_month": allocate_store_month, "hybrid": allocate_hybrid, "day_sku": allocate_day_sku,
    }[rules.allocator]
    allocation = publish(ALLOCATION, allocate(base, demand, rules.version))
    result = publish(RESULT, classify(base, allocation, rules))
    monthly = publish(MONTHLY, source_monthly(result, rules))
    if rules.allocator == "store_month":
        moment = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        audit = allocation_audit(demand, base, allocation)
        publish(AUDIT, audit.withColumn("created_at", F.lit(moment).cast("timestamp_ntz")))
        create_audit_view(warehouse.read(AUDIT))
    elif rules.allocator == "hybrid":
        publish(HYBRID_AUDIT, hybrid_audit(demand, allocation))
    return monthly


def run_reclassification(warehouse: Warehouse, rules: RuleSet, scope: Scope | None = None) -> DataFrame:
    """Apply other rules to stored results without allocating again."""
    scope = scope or infer_scope(warehouse.read(RESULT))
    in_scope = scope.month_filter() & scope.store_filter()
    base = reflag_base(scope.apply(warehouse.read(BASE)), rules)
    warehouse.replace_partitions(BASE, base, in_scope)
    result = reclassify(scope.apply(warehouse.read(RESULT)), rules)
    warehouse.replace_partitions(RESULT, result, in_scope)
    monthly = source_monthly(scope.apply(warehouse.read(RESULT)), rules)
    warehouse.replace_partitions(MONTHLY, monthly, in_scope)
    return scope.apply(warehouse.read(MONTHLY))
