"""DuckDB SQL for the registered queries, written from the rules and not from the Spark code.

Money is compared as doubles. Quotients rounded to a fixed number of digits are
worked out in whole numbers, so a tie rounds half up as it does on decimals.
"""

from __future__ import annotations

import datetime as dt

LOW_PRICE_E6 = 1000 * 10**6
LOW_PRICE_7_E6 = 700 * 10**6


def _months():
    month = dt.date(1994, 12, 1)
    while month < dt.date(2002, 1, 1):
        yield month
        month = dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)


MONTHS = list(_months())


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` (whole, not negative) half up to ``digits``, as a double."""
    scale = 10**digits
    return (
        f"CAST((2 * CAST({numerator} AS HUGEINT) * {scale} + {denominator}) // (2 * ({denominator})) AS DOUBLE)"
        f" / {scale}.0"
    )


PACIFIC_DATE = "CAST(timezone('America/Los_Angeles', timezone('UTC', purchase_date_utc)) AS DATE)"

# Each common table: its text and the tables it reads.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (text, needs)


cte("order_lines", """
SELECT r_name || '-US' AS store_name,
       o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS purchase_date_utc,
       CAST(l_orderkey AS VARCHAR) AS amazon_order_id,
       CAST(l_linenumber AS VARCHAR) AS order_item_id,
       ' sku-' || CAST(l_partkey AS VARCHAR) || ' ' AS sku,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Non-Amazon' ELSE 'Amazon.com' END AS sales_channel,
       CASE WHEN o_orderstatus = 'P' AND l_suppkey % 2 = 0 THEN 'Cancelled' ELSE 'Shipped' END AS order_status,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Unshipped' ELSE 'Shipped' END AS item_status,
       CASE WHEN l_suppkey % 50 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
       CASE WHEN l_suppkey % 49 = 0 THEN 'CAD' ELSE 'USD' END AS currency,
       CAST(l_extendedprice AS DECIMAL(18,4)) AS item_price,
       CASE WHEN l_returnflag = 'R'
            THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))
       END AS item_promotion_discount,
       CASE l_partkey % 12 WHEN 0 THEN 'US-mpc-' || CAST(l_partkey AS VARCHAR)
                           WHEN 1 THEN 'PLM-7788' WHEN 2 THEN 'US Core Free Shipping'
                           WHEN 3 THEN 'Percentage Off 10' END AS promotion_ids,
       l_suppkey, l_linenumber, l_partkey
FROM lineitem JOIN orders   ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey
              JOIN nation   ON c_nationkey = n_nationkey
              JOIN region   ON n_regionkey = r_regionkey
""")
cte("valid", f"""
SELECT *, {PACIFIC_DATE} AS order_date,
       CAST(date_trunc('month', {PACIFIC_DATE}) AS DATE) AS order_month,
       upper(trim(sku)) AS sku_key,
       item_price - coalesce(item_promotion_discount, 0) AS net,
       CAST((item_price - coalesce(item_promotion_discount, 0)) * 10000 AS BIGINT) AS net_e4
FROM order_lines
WHERE sales_channel = 'Amazon.com' AND order_status = 'Shipped' AND item_status = 'Shipped'
  AND quantity > 0 AND item_price > 0 AND currency = 'USD' AND trim(sku) <> '' AND purchase_date_utc IS NOT NULL
""", "order_lines")
cte("flagged", """
SELECT *, upper(coalesce(promotion_ids, '')) LIKE '%MPC-%' AS offsite_flag,
       upper(coalesce(promotion_ids, '')) LIKE '%FREE SHIPPING%'
         OR upper(coalesce(promotion_ids, '')) LIKE '%A3JU1FCINF5SD0%' AS shipping_promotion_flag,
       upper(coalesce(promotion_ids, '')) NOT LIKE '%MPC-%'
         AND (upper(coalesce(promotion_ids, '')) LIKE '%PERCENTAGE OFF%'
              OR upper(coalesce(promotion_ids, '')) LIKE '%PLM-%'
              OR coalesce(item_promotion_discount, 0) > 0) AS onsite_promotion_flag,
       (net_e4 * 200 + quantity) // (2 * quantity) AS unit_e6
FROM valid
""", "valid")
cte("base", f"""
SELECT *, NOT offsite_flag AND NOT onsite_promotion_flag AND unit_e6 <= {LOW_PRICE_E6} AS low_price_candidate_flag
FROM flagged
""", "flagged")
cte("performance", """
SELECT order_month AS report_month, store_name, sku_key AS msku,
       count(DISTINCT amazon_order_id) AS order_items,
       count(*) FILTER (WHERE l_suppkey % 4 = 0) AS ad_order_quantity,
       count(*) FILTER (WHERE onsite_promotion_flag) AS promotion_order_items,
       CAST(sum(quantity) AS BIGINT) AS volume, sum(item_price) AS amount
FROM flagged GROUP BY 1, 2, 3
""", "flagged")
cte("demand_monthly", """
SELECT report_month AS order_month, store_name, count(*) AS msku_count,
       CAST(sum(order_items) AS BIGINT) AS product_order_items,
       CAST(sum(ad_order_quantity) AS BIGINT) AS ad_order_quantity,
       CAST(sum(promotion_order_items) AS BIGINT) AS promotion_order_items,
       CAST(sum(volume) AS BIGINT) AS product_units, sum(amount) AS product_sales
FROM performance GROUP BY 1, 2
""", "performance")
cte("ad_spend", """
SELECT store_name, order_date + CAST(l_suppkey % 2 AS INT) AS report_date, sku,
       CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'B' || CAST(l_partkey AS VARCHAR) END AS asin,
       ad_type, 1 AS orders, item_price AS sales, coalesce(item_promotion_discount, 0) AS cost,
       l_suppkey % 7 AS clicks, l_suppkey AS impressions
FROM flagged, (VALUES ('SP'), ('SD')) AS kinds(ad_type)
WHERE (ad_type = 'SP' AND l_linenumber % 2 = 0) OR (ad_type = 'SD' AND l_suppkey % 3 = 0)
""", "flagged")
cte("demand_daily", """
SELECT store_name, report_date, CAST(date_trunc('month', report_date) AS DATE) AS order_month,
       upper(trim(sku)) AS sku_key, max(nullif(asin, '')) AS asin,
       count(*) FILTER (WHERE ad_type = 'SP') AS sp_orders,
       count(*) FILTER (WHERE ad_type = 'SD') AS sd_orders,
       count(*) AS ad_orders_raw, sum(sales) AS ad_sales, sum(cost) AS ad_cost,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions,
       count(DISTINCT ad_type) AS positive_ad_type_count, count(DISTINCT ad_type) > 1 AS multi_ad_type_flag
FROM ad_spend GROUP BY 1, 2, 3, 4
""", "ad_spend")
cte("candidates", """
SELECT store_name, order_month, order_date, sku_key, amazon_order_id, min(purchase_date_utc) AS first_purchase_date_utc
FROM base WHERE NOT offsite_flag GROUP BY 1, 2, 3, 4, 5
""", "base")
cte("day_ranked", """
SELECT c.*, row_number() OVER (PARTITION BY c.store_name, c.order_date, c.sku_key
                               ORDER BY first_purchase_date_utc, amazon_order_id) AS candidate_rank,
       count(*) OVER (PARTITION BY c.store_name, c.order_date, c.sku_key) AS candidate_orders,
       d.sp_orders, d.sd_orders, d.ad_orders_raw
FROM candidates c JOIN demand_daily d
  ON d.store_name = c.store_name AND d.report_date = c.order_date AND d.sku_key = c.sku_key
""", "candidates", "demand_daily")
cte("alloc_day", """
SELECT store_name, order_date, order_month, sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, sp_orders, sd_orders, ad_orders_raw,
       least(ad_orders_raw, candidate_orders) AS allocated_ad_orders,
       greatest(ad_orders_raw - candidate_orders, 0) AS unallocated_ad_orders,
       candidate_rank <= ad_orders_raw AS estimated_ad_flag,
       CAST(NULL AS VARCHAR) AS allocation_level, CAST(NULL AS VARCHAR) AS allocation_confidence,
       'v1_20260727' AS allocation_version
FROM day_ranked
""", "day_ranked")
cte("alloc_month", """
SELECT store_name, order_date, order_month, sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, CAST(0 AS BIGINT) AS sp_orders, CAST(0 AS BIGINT) AS sd_orders,
       CAST(1 AS BIGINT) AS ad_orders_raw, CAST(1 AS BIGINT) AS allocated_ad_orders,
       CAST(0 AS BIGINT) AS unallocated_ad_orders, TRUE AS estimated_ad_flag,
       'STORE_MONTH' AS allocation_level, 'LOW' AS allocation_confidence,
       'v3_product_month_20260727' AS allocation_version
FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c.store_name, c.order_month
                ORDER BY first_purchase_date_utc, amazon_order_id, sku_key, order_date) AS candidate_rank,
         count(*) OVER (PARTITION BY c.store_name, c.order_month) AS candidate_orders
  FROM candidates c
) r JOIN demand_monthly d USING (store_name, order_month)
WHERE candidate_rank <= least(d.ad_order_quantity, candidate_orders)
""", "candidates", "demand_monthly")
cte("level1", """
SELECT store_name, order_date, order_month, sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, sp_orders, sd_orders, ad_orders_raw, 'DAY_SKU' AS allocation_level
FROM day_ranked WHERE candidate_rank <= greatest(sp_orders, sd_orders)
""", "day_ranked")
cte("open2", """
SELECT c.* FROM candidates c ANTI JOIN level1 USING (store_name, order_date, sku_key, amazon_order_id)
""", "candidates", "level1")
cte("level2", """
SELECT r.store_name, order_date, r.order_month, r.sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, t.sp_orders, t.sd_orders, t.ad_orders_raw,
       'MONTH_SKU' AS allocation_level
FROM (
  SELECT *, row_number() OVER (PARTITION BY store_name, order_month, sku_key
                ORDER BY first_purchase_date_utc, amazon_order_id, order_date) AS candidate_rank,
         count(*) OVER (PARTITION BY store_name, order_month, sku_key) AS candidate_orders
  FROM open2
) r JOIN (
  SELECT store_name, order_month, sku_key, CAST(sum(sp_orders) AS BIGINT) AS sp_orders,
         CAST(sum(sd_orders) AS BIGINT) AS sd_orders, CAST(sum(ad_orders_raw) AS BIGINT) AS ad_orders_raw,
         sum(greatest(sp_orders, sd_orders)) AS target
  FROM demand_daily GROUP BY 1, 2, 3
) t ON t.store_name = r.store_name AND t.order_month = r.order_month AND t.sku_key = r.sku_key
LEFT JOIN (SELECT store_name, order_month, sku_key, count(*) AS taken FROM level1 GROUP BY 1, 2, 3) a
  ON a.store_name = r.store_name AND a.order_month = r.order_month AND a.sku_key = r.sku_key
WHERE candidate_rank <= greatest(t.target - coalesce(a.taken, 0), 0)
""", "open2", "demand_daily", "level1")
cte("taken2", "SELECT * FROM level1 UNION ALL SELECT * FROM level2", "level1", "level2")
cte("open3", """
SELECT c.* FROM candidates c ANTI JOIN taken2 USING (store_name, order_date, sku_key, amazon_order_id)
""", "candidates", "taken2")
cte("level3", """
SELECT r.store_name, order_date, r.order_month, sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, t.sp_orders, t.sd_orders, t.ad_orders_raw,
       'STORE_MONTH' AS allocation_level
FROM (
  SELECT *, row_number() OVER (PARTITION BY store_name, order_month
                ORDER BY first_purchase_date_utc, amazon_order_id, sku_key) AS candidate_rank,
         count(*) OVER (PARTITION BY store_name, order_month) AS candidate_orders
  FROM open3
) r JOIN (
  SELECT store_name, order_month, CAST(sum(sp_orders) AS BIGINT) AS sp_orders,
         CAST(sum(sd_orders) AS BIGINT) AS sd_orders, CAST(sum(ad_orders_raw) AS BIGINT) AS ad_orders_raw,
         sum(greatest(sp_orders, sd_orders)) AS target
  FROM demand_daily GROUP BY 1, 2
) t ON t.store_name = r.store_name AND t.order_month = r.order_month
LEFT JOIN (SELECT store_name, order_month, count(*) AS taken FROM taken2 GROUP BY 1, 2) a
  ON a.store_name = r.store_name AND a.order_month = r.order_month
WHERE candidate_rank <= greatest(t.target - coalesce(a.taken, 0), 0)
""", "open3", "demand_daily", "taken2")
cte("alloc_hybrid", """
SELECT store_name, order_date, order_month, sku_key, amazon_order_id, first_purchase_date_utc,
       candidate_rank, candidate_orders, sp_orders, sd_orders, ad_orders_raw,
       CAST(1 AS BIGINT) AS allocated_ad_orders, CAST(0 AS BIGINT) AS unallocated_ad_orders,
       TRUE AS estimated_ad_flag, allocation_level,
       CASE allocation_level WHEN 'DAY_SKU' THEN 'HIGH' WHEN 'MONTH_SKU' THEN 'MEDIUM' ELSE 'LOW' END
         AS allocation_confidence,
       'v2_hybrid_20260727' AS allocation_version
FROM (SELECT * FROM taken2 UNION ALL SELECT * FROM level3)
""", "taken2", "level3")


def _result(name: str, allocation: str, version: str, mode: str, ads: str, low: int, low_text: str, organic: str):
    kind_on = "WHEN onsite_promotion_flag THEN '站内促销'" if mode == "exclusive" else ""
    why_on = "WHEN onsite_promotion_flag THEN 'Percentage Off、PLM或item_promotion_discount>0'"
    why_tag = "WHEN onsite_promotion_flag THEN '站内促销仅作展示标签；主来源计入自然'"
    before, after = (why_on, "") if mode == "exclusive" else ("", why_tag)
    is_low = f"(NOT onsite_promotion_flag AND unit_e6 <= {low})"
    cte(name, f"""
SELECT store_name, order_date, order_month, amazon_order_id, order_item_id, sku, sku_key, quantity,
       item_price, net, unit_e6, promotion_ids, offsite_flag, ad, level, confidence, onsite_promotion_flag,
       NOT offsite_flag AND NOT ad AND {is_low} AS low_price_flag,
       CASE WHEN offsite_flag THEN '站外推广' WHEN ad THEN '广告' {kind_on}
            WHEN {is_low} THEN '低价' ELSE '自然' END AS main_order_type,
       CASE WHEN offsite_flag THEN 'promotion_ids命中MPC-' WHEN ad THEN {ads} {before}
            WHEN {is_low} THEN '{low_text}' {after} ELSE '{organic}' END AS classification_reason,
       candidate_rank, raw, '{version}' AS rule_version
FROM (
  SELECT b.*, coalesce(a.estimated_ad_flag, FALSE) AS ad, a.allocation_level AS level,
         a.allocation_confidence AS confidence, a.candidate_rank, coalesce(a.ad_orders_raw, 0) AS raw
  FROM base b LEFT JOIN {allocation} a
    ON a.store_name = b.store_name AND a.order_date = b.order_date AND a.sku_key = b.sku_key
   AND a.amazon_order_id = b.amazon_order_id AND a.order_month = b.order_month
)
""", "base", allocation)


_LOW10 = "排除前三类后净成交单价<=10美元"
_ORG5 = "未命中站外、广告、站内促销或低价规则"
_BY_MONTH = "'产品表现ad_order_quantity按店铺+月份统计分配'"
_result("result_v1", "alloc_day", "v1_20260727", "exclusive",
        "'按店铺+当地日期+SKU统计分配SP/SD广告订单'", LOW_PRICE_E6, _LOW10, _ORG5)
_result("result_v2", "alloc_hybrid", "v2_hybrid_20260727", "exclusive",
        "CASE level WHEN 'DAY_SKU' THEN '按店铺+当地日期+SKU分配SP/SD广告订单'"
        " WHEN 'MONTH_SKU' THEN '按店铺+月份+SKU补充分配广告订单'"
        " ELSE '按店铺+月份低置信度兜底广告订单' END", LOW_PRICE_E6, _LOW10, _ORG5)
_result("result_v3", "alloc_month", "v3_product_month_20260727", "exclusive", _BY_MONTH, LOW_PRICE_E6, _LOW10, _ORG5)
_result("result_v4", "alloc_month", "v4_7usd_20260728", "exclusive", _BY_MONTH, LOW_PRICE_7_E6,
        "排除前三类后净成交单价<=7美元", "未命中站外、广告、站内促销，且净成交单价>7美元")
_result("result_v5", "alloc_month", "v5_10usd_promo_overlay_20260729", "overlay", _BY_MONTH, LOW_PRICE_E6,
        "排除站外、广告和站内促销后净成交单价<=10美元", "未命中站外、广告或低价规则")

RESULT_SELECT = """
SELECT store_name, order_date, order_month, amazon_order_id, order_item_id, sku, sku_key, quantity,
       CAST(item_price AS DOUBLE) AS gross_item_sales, CAST(net AS DOUBLE) AS net_item_sales,
       unit_e6 / 1000000.0 AS net_unit_price, promotion_ids, offsite_flag, ad AS estimated_ad_flag,
       level AS ad_allocation_level, confidence AS ad_allocation_confidence, onsite_promotion_flag,
       low_price_flag, main_order_type, classification_reason, candidate_rank, raw AS ad_orders_raw, rule_version
FROM {0}
"""

_MEASURES = """count(*) AS classified_item_rows, count(DISTINCT amazon_order_id || '|' || sku_key) AS order_sku_count,
       count(DISTINCT amazon_order_id) AS amazon_order_count, CAST(sum(quantity) AS BIGINT) AS units,
       sum(item_price) AS gross_item_sales, sum(net) AS net_item_sales"""
for _v in ("v1", "v2", "v3"):
    cte(f"monthly_{_v}", f"""
SELECT order_month, store_name, main_order_type, {_MEASURES} FROM result_{_v} GROUP BY 1, 2, 3
""", f"result_{_v}")
cte("monthly_v5", f"""
SELECT order_month, store_name, main_order_type, {_MEASURES} FROM result_v5 GROUP BY 1, 2, 3
UNION ALL
SELECT order_month, store_name, '站内促销', {_MEASURES} FROM result_v5 WHERE onsite_promotion_flag GROUP BY 1, 2
""", "result_v5")
MONTHLY_SELECT = """
SELECT order_month, store_name, main_order_type, classified_item_rows, order_sku_count, amazon_order_count, units,
       CAST(gross_item_sales AS DOUBLE) AS gross_item_sales, CAST(net_item_sales AS DOUBLE) AS net_item_sales
FROM {0}
"""
cte("audit", f"""
SELECT d.order_month, d.store_name, d.product_order_items, d.ad_order_quantity AS product_ad_order_target,
       d.promotion_order_items AS product_promotion_orders, d.msku_count,
       coalesce(b.n, 0) AS base_order_sku_count, coalesce(b.off, 0) AS offsite_order_sku_count,
       coalesce(b.n - b.off, 0) AS non_offsite_capacity, coalesce(a.n, 0) AS allocated_ad_orders,
       greatest(d.ad_order_quantity - coalesce(a.n, 0), 0) AS unallocated_ad_orders,
       CASE WHEN d.ad_order_quantity = 0 THEN 0.0
            ELSE {ratio("coalesce(a.n, 0) * 100", "d.ad_order_quantity", 4)} END AS allocation_pct,
       d.product_order_items - coalesce(b.n, 0) AS source_gap_order_sku
FROM demand_monthly d
LEFT JOIN (
  SELECT order_month, store_name, count(*) AS n, count(*) FILTER (WHERE off) AS off
  FROM (SELECT order_month, store_name, amazon_order_id, sku_key, bool_or(offsite_flag) AS off
        FROM base GROUP BY 1, 2, 3, 4) GROUP BY 1, 2
) b USING (order_month, store_name)
LEFT JOIN (SELECT order_month, store_name, count(*) AS n FROM alloc_month GROUP BY 1, 2) a
  USING (order_month, store_name)
""", "demand_monthly", "base", "alloc_month")

SOURCES = "(VALUES ('广告'), ('站外推广'), ('站内促销'), ('低价'), ('自然')) AS s(main_order_type)"
ROLE = "CASE WHEN main_order_type = '站内促销' THEN '展示项' ELSE '主来源' END AS metric_role"


def shares(keys: str, money: bool = True) -> str:
    """Share columns over a zero-filled frame with decimals under the usual names."""

    def one(column: str, name: str) -> str:
        total = f"CAST(sum(CASE WHEN main_order_type <> '站内促销' THEN {column} END) OVER (PARTITION BY {keys}) AS DOUBLE)"
        return (
            f"CASE WHEN main_order_type = '站内促销' THEN NULL WHEN {total} = 0 THEN 0.0 "
            f"ELSE CAST({column} AS DOUBLE) / {total} END AS {name}"
        )

    out = one("order_sku_count", "order_sku_share")
    return out + ", " + one("net_item_sales", "net_sales_share") if money else out


_FILLED = """coalesce(classified_item_rows, 0) AS classified_item_rows, coalesce(order_sku_count, 0) AS order_sku_count,
  coalesce(amazon_order_count, 0) AS amazon_order_count, coalesce(units, 0) AS units,
  coalesce(gross_item_sales, 0) AS gross_item_sales, coalesce(net_item_sales, 0) AS net_item_sales"""
_SUMS = """CAST(sum(classified_item_rows) AS BIGINT) AS classified_item_rows,
  CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count,
  CAST(sum(amazon_order_count) AS BIGINT) AS amazon_order_count, CAST(sum(units) AS BIGINT) AS units,
  sum(gross_item_sales) AS gross_item_sales, sum(net_item_sales) AS net_item_sales"""

cte("overall", f"""
SELECT main_order_type, {_FILLED}
FROM {SOURCES} LEFT JOIN (SELECT main_order_type, {_SUMS} FROM monthly_v5 GROUP BY 1) USING (main_order_type)
""", "monthly_v5")
cte("by_month", f"""
SELECT order_month, main_order_type, {_FILLED}
FROM (SELECT DISTINCT order_month FROM monthly_v5) CROSS JOIN {SOURCES}
LEFT JOIN (SELECT order_month, main_order_type, {_SUMS} FROM monthly_v5 GROUP BY 1, 2)
  USING (order_month, main_order_type)
""", "monthly_v5")
cte("by_store_month", f"""
SELECT order_month, store_name, main_order_type, {_FILLED}
FROM (SELECT DISTINCT order_month FROM monthly_v5) CROSS JOIN (SELECT DISTINCT store_name FROM monthly_v5)
CROSS JOIN {SOURCES} LEFT JOIN monthly_v5 USING (order_month, store_name, main_order_type)
""", "monthly_v5")


def period_sql(kind: str, include_partial: bool) -> tuple[str, tuple[str, ...]]:
    step = 3 if kind == "quarter" else 6
    rows = []
    for start in MONTHS:
        first = dt.date(start.year, (start.month - 1) // step * step + 1, 1)
        last_index = first.year * 12 + first.month - 1 + step
        last = dt.date(last_index // 12, last_index % 12 + 1, 1)
        complete = first >= MONTHS[0] and last <= dt.date(2002, 1, 1)
        label = (
            f"{first.year}-Q{(first.month + 2) // 3}" if kind == "quarter"
            else f"{first.year}{'上半年' if first.month == 1 else '下半年'}"
        )
        if complete or include_partial:
            rows.append(f"(DATE '{first}', DATE '{last}', '{label}', {str(complete).upper()})")
    values = ", ".join(dict.fromkeys(rows))
    return f"""
SELECT period, CASE WHEN complete AND covered_months = {step} THEN '完整周期' ELSE '未完结周期' END AS period_status,
       store_name, main_order_type, {ROLE}, covered_months, order_sku_count, units,
       CAST(net_item_sales AS DOUBLE) AS net_item_sales, {shares("period, store_name")}
FROM (
  SELECT period, complete, store_name, main_order_type, coalesce(covered_months, 0) AS covered_months, {_FILLED}
  FROM (VALUES {values}) AS p(first_month, end_month, period, complete)
  CROSS JOIN (SELECT DISTINCT store_name FROM monthly_v5 UNION ALL SELECT '全部店铺') n
  CROSS JOIN {SOURCES}
  LEFT JOIN (
    SELECT period, store_name, main_order_type, {_SUMS}
    FROM (SELECT * FROM monthly_v5 UNION ALL BY NAME SELECT * REPLACE ('全部店铺' AS store_name) FROM monthly_v5) m
    JOIN (VALUES {values}) AS q(first_month, end_month, period, complete)
      ON m.order_month >= q.first_month AND m.order_month < q.end_month
    GROUP BY 1, 2, 3
  ) USING (period, store_name, main_order_type)
  LEFT JOIN (
    SELECT period, store_name, count(DISTINCT order_month) AS covered_months
    FROM (SELECT * FROM monthly_v5 UNION ALL BY NAME SELECT * REPLACE ('全部店铺' AS store_name) FROM monthly_v5) m
    JOIN (VALUES {values}) AS q(first_month, end_month, period, complete)
      ON m.order_month >= q.first_month AND m.order_month < q.end_month
    GROUP BY 1, 2
  ) USING (period, store_name)
)
""", ("monthly_v5",)


cte("msku_rows", """
SELECT strftime(order_month, '%Y-%m') AS order_month, store_name, sku_key AS msku,
       count(DISTINCT amazon_order_id) AS order_sku_count, CAST(sum(quantity) AS BIGINT) AS units,
       sum(item_price) AS gross, sum(coalesce(item_promotion_discount, 0)) AS discount, sum(net) AS net,
       min((2 * CAST(net_e4 AS HUGEINT) * 10000 + quantity) // (2 * quantity)) AS min_e8,
       max((2 * CAST(net_e4 AS HUGEINT) * 10000 + quantity) // (2 * quantity)) AS max_e8
FROM valid GROUP BY 1, 2, 3
""", "valid")
cte("listing_rows", """
SELECT store, p_partkey AS k, copy, 'S' || CAST(p_partkey % 4 AS VARCHAR) AS sid,
       'sku-' || CAST(p_partkey AS VARCHAR) AS msku,
       CASE WHEN copy = 0 AND p_partkey % 17 = 0 THEN '' ELSE 'L' || CAST(p_partkey % 500 AS VARCHAR) END AS local_sku,
       CASE WHEN copy = 0 AND p_partkey % 7 = 0 THEN '' ELSE 'P' || CAST(p_partkey % 11 AS VARCHAR) END AS principal,
       CAST((p_partkey + copy) % 2 AS INT) AS status
FROM part, (VALUES ('AFRICA-US'), ('AMERICA-US'), ('ASIA-US'), ('EUROPE-US'), ('MIDDLE EAST-US')) AS s(store),
     (VALUES (0), (1)) AS c(copy)
WHERE p_partkey % 23 <> 0 AND (copy = 0 OR p_partkey % 5 = 0)
""")
cte("listing_best", """
SELECT store AS store_key, upper(msku) AS msku_key, store, sid, msku, local_sku, principal, status
FROM (
  SELECT *, row_number() OVER (PARTITION BY store, k ORDER BY status = 1 DESC, principal <> '' DESC,
                               local_sku <> '' DESC, local_sku, principal) AS place
  FROM listing_rows
) WHERE place = 1
""", "listing_rows")
cte("products", """
SELECT 'L' || CAST(k AS VARCHAR) AS sku_key, 'l' || CAST(k AS VARCHAR) AS local_sku,
       'product ' || CAST(k AS VARCHAR) AS product_name,
       CASE WHEN k % 29 = 0 THEN '' ELSE 'ST' || CAST(k % 60 AS VARCHAR) END AS style_no,
       CASE WHEN k % 3 = 0 OR k % 31 = 0 THEN ''
            WHEN k % 4 = 0 THEN '夏' WHEN k % 2 = 0 THEN '夏|春' ELSE '冬|春' END AS season,
       CASE WHEN k % 3 = 0 THEN 'C' || CAST(k % 9 AS VARCHAR)
            WHEN k % 2 = 1 THEN 'N' || CAST(k % 5 AS VARCHAR)
            WHEN k % 8 = 0 THEN 'B' WHEN k % 10 = 0 THEN 'plain'
            ELSE 'T' || CAST(k % 6 AS VARCHAR) END AS category
FROM (SELECT DISTINCT p_partkey % 500 AS k FROM part)
""")
cte("mapped", """
SELECT m.*, coalesce(l.local_sku, '') AS local_sku,
       coalesce(nullif(p.style_no, ''), '（未匹配款号）') AS style_no,
       coalesce(nullif(p.season, ''), '（未维护）') AS season,
       coalesce(nullif(p.category, ''), '（未维护）') AS category,
       coalesce(nullif(l.principal, ''), '（未维护）') AS principal,
       CASE WHEN l.msku_key IS NULL THEN '未匹配Listing（店铺+MSKU）'
            WHEN concat_ws('', CASE WHEN l.local_sku = '' THEN 'x' END, CASE WHEN l.principal = '' THEN 'x' END,
                 CASE WHEN p.sku_key IS NULL THEN 'x' END, CASE WHEN p.style_no = '' THEN 'x' END,
                 CASE WHEN p.season = '' THEN 'x' END, CASE WHEN p.category = '' THEN 'x' END) = '' THEN '已完整匹配'
            ELSE concat_ws('；', CASE WHEN l.local_sku = '' THEN 'Listing本地SKU为空' END,
                 CASE WHEN l.principal = '' THEN '负责人为空' END,
                 CASE WHEN p.sku_key IS NULL THEN '未匹配产品管理' END,
                 CASE WHEN p.style_no = '' THEN '款号/SPU为空' END,
                 CASE WHEN p.season = '' THEN '季节为空' END,
                 CASE WHEN p.category = '' THEN '品类为空' END) END AS mapping_result
FROM msku_rows m LEFT JOIN listing_best l ON l.store_key = m.store_name AND l.msku_key = m.msku
LEFT JOIN products p ON p.sku_key = l.local_sku AND l.local_sku <> ''
""", "msku_rows", "listing_best", "products")


def wide_sql(store: str | None) -> tuple[str, tuple[str, ...]]:
    prices = ", ".join(
        f"""CAST(sum(net) FILTER (WHERE order_month = '{m:%Y-%m}') AS DOUBLE)
  / CAST(sum(units) FILTER (WHERE order_month = '{m:%Y-%m}') AS DOUBLE) AS "{m:%Y-%m}" """
        for m in MONTHS
    )
    keys = "principal, style_no, season, category" if store else "store_name, principal, style_no, season, category"
    where = f"WHERE store_name = '{store}'" if store else ""
    return f"""
SELECT {keys}, CAST(sum(units) AS BIGINT) AS total_units, {prices},
       CAST(sum(net) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS total_weighted_price,
       count(DISTINCT msku) AS msku_count, count(DISTINCT nullif(local_sku, '')) AS local_sku_count
FROM mapped {where} GROUP BY {keys}
""", ("mapped",)


_MONTH_VALUES = ", ".join(f"('{m:%Y-%m}')" for m in MONTHS)
_MONTH_DATES = ", ".join(f"(DATE '{m}')" for m in MONTHS)

cte("report_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 6 AS form, o_orderkey % 4 AS zone,
       CAST(l_quantity AS INT) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
       o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS bought
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
cte("report_strings", """
SELECT *,
       CASE form WHEN 0 THEN 'Yes' WHEN 1 THEN CAST(q AS VARCHAR) || '.7'
                 WHEN 2 THEN '1,' || lpad(CAST(q AS VARCHAR), 3, '0') WHEN 3 THEN '' WHEN 4 THEN '0'
                 ELSE CAST(q AS VARCHAR) END AS quantity_text,
       CASE form WHEN 0 THEN 'x1' WHEN 1 THEN '' ELSE CAST(p AS VARCHAR) END AS price_text,
       strftime(bought, '%Y-%m-%d') || CASE zone WHEN 3 THEN ' ' ELSE 'T' END || strftime(bought, '%H:%M:%S')
         || CASE zone WHEN 0 THEN 'Z' WHEN 1 THEN '-07:00' WHEN 2 THEN '+05:30' ELSE '' END AS purchase_text,
       CASE WHEN l_partkey % 13 = 0 THEN '' ELSE 'sku-' || CAST(l_partkey AS VARCHAR) END AS sku_text,
       CASE WHEN l_orderkey % 17 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS order_text
FROM report_text
""", "report_text")
cte("paths", """
SELECT DISTINCT code, month, '/landing/' || code || '/' ||
       CASE month(month) % 3 WHEN 0 THEN code || '-' || strftime(month, '%Y-%m')
                             WHEN 1 THEN code || strftime(month, '%y%m') || '-note'
                             ELSE 'orders ' || strftime(month, '%Y%m') END || '.txt' AS path
FROM (SELECT ['JQ', 'MT', 'RKZ', 'SY'][CAST(o_custkey % 4 AS INT) + 1] AS code,
             CAST(date_trunc('month', o_orderdate) + INTERVAL '324' MONTH AS DATE) AS month FROM orders)
""")
cte("page_rows", """
SELECT *, max(page) OVER (PARTITION BY report_month, sid) AS last_page
FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY report_month, sid ORDER BY k // 50 + again * 100000) AS INT) AS page
FROM (SELECT *, CAST(substr(msku, 5) AS BIGINT) AS k,
             100 + CASE store_name WHEN 'AFRICA-US' THEN 1 WHEN 'AMERICA-US' THEN 2 WHEN 'ASIA-US' THEN 3
                                   WHEN 'EUROPE-US' THEN 4 ELSE 5 END AS sid
      FROM performance) p, (VALUES (0), (1)) AS a(again)
WHERE again = 0 OR k % 7 = 0)
""", "performance")
# Pages that arrived; which months and stores are incomplete.
cte("landed_rows", """
SELECT *, month(report_month) % 5 = 0 AND page = 1 AS failed,
       CASE WHEN month(report_month) % 5 = 0 THEN 'page 1: code 500'
            WHEN month(report_month) % 7 = 0 AND last_page >= 3 THEN '1 pages are missing' END AS problem
FROM page_rows WHERE NOT (month(report_month) % 7 = 0 AND page = 2)
""", "page_rows")
# Rows of good pages that name an MSKU in one of the two places; only whole months are stored.
cte("kept_rows", """
SELECT * FROM landed_rows WHERE NOT failed AND (k % 3 <> 2 OR k % 11 <> 0)
""", "landed_rows")
cte("good_rows", """
SELECT * FROM kept_rows WHERE problem IS NULL
""", "kept_rows")


ORACLE: dict[str, str] = {}


def oracle(name: str, select: str, *needs: str) -> None:
    ordered: list[str] = []

    def visit(table: str) -> None:
        for other in CTES[table][1]:
            visit(other)
        if table not in ordered:
            ordered.append(table)

    for table in needs:
        visit(table)
    head = ",\n".join(f"{t} AS MATERIALIZED ({CTES[t][0]})" for t in ordered)
    ORACLE[name] = f"WITH {head}\n{select}" if head else select


_LINE = """store_name, purchase_date_utc, amazon_order_id, order_item_id, sku, sales_channel, order_status, item_status,
       quantity, currency, CAST(item_price AS DOUBLE) AS item_price,
       CAST(item_promotion_discount AS DOUBLE) AS item_promotion_discount, promotion_ids"""
oracle("valid_orders", f"SELECT {_LINE}, l_suppkey, l_linenumber, l_partkey FROM valid", "valid")
oracle("order_base", """
SELECT store_name, order_date, order_month, purchase_date_utc, amazon_order_id, order_item_id, sku, sku_key, quantity,
       currency, CAST(item_price AS DOUBLE) AS gross_item_sales,
       CAST(coalesce(item_promotion_discount, 0) AS DOUBLE) AS item_promotion_discount,
       CAST(net AS DOUBLE) AS net_item_sales, unit_e6 / 1000000.0 AS net_unit_price, promotion_ids, offsite_flag,
       shipping_promotion_flag, onsite_promotion_flag, low_price_candidate_flag
FROM base""", "base")
oracle("promo_flags", """
SELECT offsite_flag, shipping_promotion_flag, onsite_promotion_flag, low_price_candidate_flag, count(*) AS lines,
       CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(net) AS DOUBLE) AS net_item_sales
FROM base GROUP BY 1, 2, 3, 4""", "base")
oracle("scope_inference", """
SELECT min(order_month) AS start_month, CAST(max(order_month) + INTERVAL '1' MONTH AS DATE) AS end_month_exclusive,
       string_agg(DISTINCT store_name, ',' ORDER BY store_name) AS stores FROM base""", "base")
oracle("ad_demand_daily", """
SELECT * REPLACE (CAST(ad_sales AS DOUBLE) AS ad_sales, CAST(ad_cost AS DOUBLE) AS ad_cost) FROM demand_daily
""", "demand_daily")
oracle("ad_demand_monthly", """
SELECT * REPLACE (CAST(product_sales AS DOUBLE) AS product_sales) FROM demand_monthly""", "demand_monthly")
oracle("order_sku_candidates", "SELECT * FROM candidates", "candidates")
oracle("day_sku_rank", "SELECT * EXCLUDE (sp_orders, sd_orders, ad_orders_raw) FROM day_ranked", "day_ranked")
oracle("ad_alloc_day_sku", "SELECT * FROM alloc_day", "alloc_day")
for _n in ("ad_alloc_store_month", "ad_alloc_store_month_sorted"):
    oracle(_n, "SELECT * FROM alloc_month", "alloc_month")
for _n in ("ad_alloc_hybrid", "ad_alloc_hybrid_sorted"):
    oracle(_n, "SELECT * FROM alloc_hybrid", "alloc_hybrid")
for _n, _t in (
    ("classify_day_sku", "v1"), ("classify_hybrid", "v2"), ("classify_exclusive_10", "v3"),
    ("classify_exclusive_7", "v4"), ("classify_v5", "v5"), ("reclassify_v5", "v5"),
):
    oracle(_n, RESULT_SELECT.format(f"result_{_t}"), f"result_{_t}")
for _t in ("v1", "v2", "v3", "v5"):
    oracle(f"source_monthly_{_t}", MONTHLY_SELECT.format(f"monthly_{_t}"), f"monthly_{_t}")
_TOTAL = "CAST(sum(order_sku_count) OVER (PARTITION BY order_month, store_name) AS BIGINT)"
oracle("month_share", f"""
SELECT order_month, store_name, main_order_type, order_sku_count,
       {ratio("order_sku_count * 100", _TOTAL, 2)} AS order_sku_pct, units,
       CAST(round(net_item_sales, 2) AS DOUBLE) AS net_item_sales
FROM monthly_v3""", "monthly_v3")
oracle("source_summary", """
SELECT main_order_type, CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count,
       CAST(round(sum(net_item_sales), 2) AS DOUBLE) AS net_item_sales,
       CASE WHEN main_order_type = '站内促销' THEN '展示项，不参与合计占比' ELSE '主来源' END AS metric_role
FROM monthly_v5 GROUP BY 1""", "monthly_v5")
oracle("rule_version_check", """
SELECT rule_version, count(*) AS item_rows, min(order_month) AS min_month, max(order_month) AS max_month
FROM result_v5 GROUP BY 1""", "result_v5")
oracle("alloc_audit", "SELECT * FROM audit", "audit")
oracle("audit_status", """
SELECT strftime(order_month, '%Y-%m') AS month, store_name, product_order_items, product_ad_order_target,
       product_promotion_orders, msku_count, base_order_sku_count, offsite_order_sku_count, non_offsite_capacity,
       allocated_ad_orders, unallocated_ad_orders, allocation_pct / 100.0 AS allocation_rate, source_gap_order_sku,
       CASE WHEN product_order_items = 0 THEN 0.0
            ELSE CAST(source_gap_order_sku AS DOUBLE) / CAST(product_order_items AS DOUBLE) END AS source_gap_rate,
       CASE WHEN unallocated_ad_orders = 0 AND allocation_pct / 100.0 >= 0.999999 THEN '通过' ELSE '需检查' END AS status
FROM audit""", "audit")
oracle("hybrid_audit", f"""
SELECT d.order_month, d.store_name, d.raw_ad_orders, d.target AS conservative_target_orders,
       coalesce(a.d1, 0) AS day_sku_allocated, coalesce(a.d2, 0) AS month_sku_allocated,
       coalesce(a.d3, 0) AS store_month_allocated, coalesce(a.n, 0) AS total_allocated,
       greatest(d.target - coalesce(a.n, 0), 0) AS unallocated_orders,
       CASE WHEN d.target = 0 THEN 0.0 ELSE {ratio("coalesce(a.n, 0) * 100", "d.target", 4)} END AS allocation_pct
FROM (SELECT order_month, store_name, CAST(sum(ad_orders_raw) AS BIGINT) AS raw_ad_orders,
             CAST(sum(greatest(sp_orders, sd_orders)) AS BIGINT) AS target FROM demand_daily GROUP BY 1, 2) d
LEFT JOIN (SELECT order_month, store_name, count(*) AS n, count(*) FILTER (WHERE allocation_level = 'DAY_SKU') AS d1,
                  count(*) FILTER (WHERE allocation_level = 'MONTH_SKU') AS d2,
                  count(*) FILTER (WHERE allocation_level = 'STORE_MONTH') AS d3
           FROM alloc_hybrid GROUP BY 1, 2) a USING (order_month, store_name)
""", "demand_daily", "alloc_hybrid")
oracle("report_overall", f"""
SELECT main_order_type, order_sku_count, units, CAST(net_item_sales AS DOUBLE) AS net_item_sales, {shares("1")}
FROM overall
UNION ALL BY NAME
SELECT '主来源合计' AS main_order_type, CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count,
       CAST(sum(units) AS BIGINT) AS units, CAST(sum(net_item_sales) AS DOUBLE) AS net_item_sales,
       1.0 AS order_sku_share, 1.0 AS net_sales_share
FROM overall WHERE main_order_type <> '站内促销'""", "overall")
oracle("report_month", f"""
SELECT strftime(order_month, '%Y-%m') AS month, main_order_type, {ROLE}, order_sku_count, units,
       CAST(gross_item_sales AS DOUBLE) AS gross_item_sales, CAST(net_item_sales AS DOUBLE) AS net_item_sales,
       {shares("order_month")}
FROM by_month""", "by_month")
oracle("report_store_month", f"""
SELECT strftime(order_month, '%Y-%m') AS month, store_name, main_order_type, {ROLE}, classified_item_rows,
       order_sku_count, amazon_order_count, units, CAST(gross_item_sales AS DOUBLE) AS gross_item_sales,
       CAST(net_item_sales AS DOUBLE) AS net_item_sales, {shares("order_month, store_name", money=False)}
FROM by_store_month""", "by_store_month")
for _n, _k, _p in (("report_quarter", "quarter", False), ("report_quarter_partial", "quarter", True),
                   ("report_half", "half", True)):
    _select, _needs = period_sql(_k, _p)
    oracle(_n, _select, *_needs)
oracle("msku_month", """
SELECT order_month, store_name, msku, order_sku_count, units, CAST(gross AS DOUBLE) AS gross_item_sales,
       CAST(discount AS DOUBLE) AS item_promotion_discount, CAST(net AS DOUBLE) AS net_item_sales,
       CAST(min_e8 AS DOUBLE) / 100000000.0 AS min_deal_price, CAST(max_e8 AS DOUBLE) / 100000000.0 AS max_deal_price
FROM msku_rows""", "msku_rows")
oracle("listing_best", "SELECT * FROM listing_best", "listing_best")
oracle("product_dims", "SELECT * FROM products", "products")
oracle("deal_price_long", """
SELECT order_month, store_name, principal, style_no, season, category,
       CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count, CAST(sum(units) AS BIGINT) AS units,
       CAST(sum(gross) AS DOUBLE) AS gross_item_sales, CAST(sum(discount) AS DOUBLE) AS item_promotion_discount,
       CAST(sum(net) AS DOUBLE) AS net_item_sales,
       CAST(sum(net) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS weighted_deal_price,
       CAST(min(min_e8) AS DOUBLE) / 100000000.0 AS min_deal_price,
       CAST(max(max_e8) AS DOUBLE) / 100000000.0 AS max_deal_price,
       count(DISTINCT msku) AS msku_count, count(DISTINCT nullif(local_sku, '')) AS local_sku_count
FROM mapped GROUP BY 1, 2, 3, 4, 5, 6""", "mapped")
_select, _needs = wide_sql(None)
oracle("deal_price_wide", _select, *_needs)
_select, _needs = wide_sql("AMERICA-US")
oracle("deal_price_by_store", _select, *_needs)
oracle("mapping_audit", """
SELECT store_name, msku, mapping_result, CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count,
       CAST(sum(units) AS BIGINT) AS units, CAST(sum(net) AS DOUBLE) AS net_item_sales,
       CAST(sum(net) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS weighted_deal_price
FROM mapped GROUP BY 1, 2, 3""", "mapped")
oracle("month_coverage", f"""
SELECT order_month, CASE WHEN units > 0 THEN '是' ELSE '否' END AS has_data,
       coalesce(order_sku_count, 0) AS order_sku_count, coalesce(units, 0) AS units,
       CAST(coalesce(net, 0) AS DOUBLE) AS net_item_sales,
       CASE WHEN units > 0 THEN CASE WHEN order_month = '2001-08' THEN '未完结月份，截至2001-08-03' ELSE '已有数据' END
            ELSE '缺少订单数据' END AS status
FROM (VALUES {_MONTH_VALUES}) AS m(order_month)
LEFT JOIN (SELECT order_month, CAST(sum(order_sku_count) AS BIGINT) AS order_sku_count,
                  CAST(sum(units) AS BIGINT) AS units, sum(net) AS net FROM msku_rows GROUP BY 1) USING (order_month)
""", "msku_rows")
oracle("typed_values", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE form WHEN 4 THEN 0 WHEN 5 THEN q END AS strict_quantity,
       CASE form WHEN 0 THEN 1 WHEN 1 THEN q WHEN 2 THEN 1000 + q WHEN 4 THEN 0 WHEN 5 THEN q END AS lenient_quantity,
       CASE WHEN form > 1 THEN CAST(p AS DOUBLE) END AS price,
       CASE form WHEN 1 THEN CAST(CAST(q AS VARCHAR) || '.7' AS DOUBLE) WHEN 2 THEN 1000.0 + q
                 WHEN 4 THEN 0.0 WHEN 5 THEN CAST(q AS DOUBLE) END AS quantity_decimal,
       CASE form WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE WHEN 3 THEN TRUE END AS is_business,
       bought + CASE zone WHEN 1 THEN INTERVAL '7' HOUR WHEN 2 THEN INTERVAL '-330' MINUTE ELSE INTERVAL '0' HOUR END
         AS purchase_date_utc
FROM report_text""", "report_text")
oracle("row_acceptance", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat_ws('; ', CASE WHEN form = 3 THEN 'quantity must be positive or zero' END,
                 CASE WHEN order_text = '' THEN 'order id is empty' END,
                 CASE WHEN sku_text = '' THEN 'sku is empty' END) AS rejects,
       form NOT IN (3, 4) AND order_text <> '' AND sku_text <> '' AS accepted_without_zero
FROM report_strings""", "report_strings")
oracle("synthetic_item_ids", """
SELECT 'txt-' || row_no || '-' || substr(sha256(concat_ws('|', 'SY-US', '1996-05-01', order_text, sku_text, '',
       purchase_text, quantity_text, price_text, row_no)), 1, 24) AS order_item_id
FROM (SELECT *, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS row_no FROM report_strings)""", "report_strings")
oracle("source_hash", """
SELECT sha256(concat_ws('|', 'SY-US', order_text, sku_text, purchase_text, quantity_text, price_text)) AS source_hash
FROM report_strings""", "report_strings")
oracle("month_purity", """
SELECT count(*) AS dated_rows, count(*) FILTER (WHERE strftime(purchase_date_utc, '%Y-%m') = '1996-05') AS month_rows,
       min(purchase_date_utc) AS first_purchase_utc, max(purchase_date_utc) AS last_purchase_utc,
       count(*) FILTER (WHERE strftime(purchase_date_utc, '%Y-%m') = '1996-05') / count(*) >= 0.95 AS is_pure
FROM order_lines""", "order_lines")
oracle("duplicate_items", """
SELECT amazon_order_id, order_item_id, count(*) AS copies FROM order_lines GROUP BY 1, 2 HAVING count(*) > 1
""", "order_lines")
oracle("load_audit", f"""
SELECT count(*) AS row_count, count(DISTINCT amazon_order_id || '|' || sku) AS order_sku_count,
       CAST(sum(quantity) AS BIGINT) AS units,
       {ratio("CAST(sum(item_price - coalesce(item_promotion_discount, 0)) * 10000 AS HUGEINT)",
              "CAST(sum(quantity) AS HUGEINT) * 10000", 4)} AS weighted_deal_price
FROM order_lines""", "order_lines")
oracle("upsert_orders", """
SELECT store_name, amazon_order_id, order_item_id, quantity, CAST(item_price AS DOUBLE) AS item_price,
       import_batch_no, source_file, source_row_no
FROM (
  SELECT *, row_number() OVER (PARTITION BY store_name, amazon_order_id, order_item_id
                               ORDER BY import_batch_no DESC, source_file DESC, source_row_no DESC) AS place
  FROM (SELECT *, 'b' || CAST(l_partkey % 3 AS VARCHAR) AS import_batch_no,
               'f' || CAST(l_suppkey % 2 AS VARCHAR) AS source_file,
               CAST(item_price * 100 AS BIGINT) * 100000 + quantity AS source_row_no FROM order_lines)
) WHERE place = 1""", "order_lines")
oracle("file_names", """
SELECT path, code || '-US' AS store_name, month AS report_month,
       CASE WHEN month(month) % 3 = 1 THEN code || '-US' END AS monthly_store,
       CASE WHEN month(month) % 3 = 1 THEN month END AS monthly_month,
       'txt_' || code || '_' || strftime(month, '%Y%m') || '_20250101000000_' || substr(sha256(path), 1, 8)
         AS import_batch_no
FROM paths""", "paths")
oracle("skip_imported", "SELECT path, code AS store_name FROM paths WHERE month(month) > 4", "paths")
for _n in ("ingest_orders", "ingest_orders_stream"):
    oracle(_n, f"""
SELECT DISTINCT * FROM (
  SELECT {_LINE.replace("order_item_id,", "concat_ws('-', order_item_id, CAST(l_partkey AS VARCHAR),"
                        " CAST(l_suppkey AS VARCHAR), CAST(item_price AS VARCHAR),"
                        " CAST(quantity AS VARCHAR)) AS order_item_id,")}
  FROM order_lines)""", "order_lines")
oracle("performance_rows", """
SELECT report_month, report_month AS period_start, least(last_day(report_month), DATE '2001-08-03') AS period_end,
       sid, store_name, 'US' AS country, msku,
       CASE WHEN k % 3 = 2 THEN 'S' ELSE 'L' END || CAST(k AS VARCHAR) AS sku, 'B' || CAST(k AS VARCHAR) AS asin,
       'P' || CAST(k % 10 AS VARCHAR) AS parent_asin, volume + again AS volume, order_items,
       CAST(amount AS DOUBLE) AS amount, CASE WHEN k % 5 <> 0 THEN promotion_order_items END AS promotion_order_items,
       ad_order_quantity, CAST(NULL AS BIGINT) AS clicks, 'USD' AS currency_code
FROM (SELECT *, row_number() OVER (PARTITION BY report_month, sid, msku ORDER BY page DESC) AS place FROM good_rows)
WHERE place = 1""", "good_rows")
oracle("performance_load_stats", """
SELECT f.report_month, f.sid, f.store_name, f.interface_total, coalesce(k.n, 0) AS fetched_rows,
       CASE WHEN f.problem IS NULL THEN coalesce(k.n, 0) ELSE 0 END AS written_rows,
       CASE WHEN f.problem IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status, f.problem AS error_message
FROM (SELECT report_month, sid, store_name, min(problem) AS problem,
             arg_min(n, page) FILTER (WHERE NOT failed) AS interface_total
      FROM (SELECT report_month, sid, store_name, page, failed, problem, count(*) AS n FROM landed_rows GROUP BY ALL)
      GROUP BY 1, 2, 3) f
LEFT JOIN (SELECT report_month, sid, count(DISTINCT msku) AS n FROM kept_rows GROUP BY 1, 2) k
  ON k.report_month = f.report_month AND k.sid = f.sid""", "landed_rows", "kept_rows")
oracle("pending_tasks", f"""
SELECT store_name, sid, report_month
FROM (SELECT DISTINCT store_name, CAST(length(store_name) AS BIGINT) AS sid FROM performance)
CROSS JOIN (VALUES {_MONTH_DATES}) AS m(report_month)
WHERE NOT EXISTS (SELECT 1 FROM performance p WHERE p.report_month = m.report_month
                  AND length(p.store_name) = sid AND month(p.report_month) % 2 = 0)""", "performance")
oracle("unknown_stores", """
SELECT DISTINCT lower(c_mktsegment) || '-us' AS store_name FROM customer
WHERE upper(c_mktsegment) || '-US' NOT IN (SELECT store_name FROM order_lines)""", "order_lines")
oracle("scoped_source_monthly", """
SELECT order_month, CASE store_name WHEN 'EUROPE-US' THEN 'europe-us' ELSE store_name END AS store_name,
       main_order_type, classified_item_rows, order_sku_count, amazon_order_count, units,
       CAST(gross_item_sales AS DOUBLE) AS gross_item_sales, CAST(net_item_sales AS DOUBLE) AS net_item_sales
FROM monthly_v5 WHERE store_name IN ('ASIA-US', 'EUROPE-US')""", "monthly_v5")
oracle("default_scope_ads", """
SELECT CAST(date_trunc('month', min(report_date)) AS DATE) AS start_month,
       CAST(date_trunc('month', max(report_date)) + INTERVAL 1 MONTH AS DATE) AS end_month_exclusive,
       string_agg(DISTINCT store_name, ',' ORDER BY store_name) AS stores
FROM ad_spend""", "ad_spend")
oracle("sheets_written", "SELECT month, main_order_type, order_sku_count, units FROM (" +
       ORACLE["report_month"] + ")")
oracle("import_log", """
SELECT store_name, CASE store_name WHEN 'ASIA-US' THEN 'failed' ELSE 'success' END AS status,
       CASE store_name WHEN 'ASIA-US' THEN 0 ELSE sum(n) END::BIGINT AS total_rows,
       CASE store_name WHEN 'ASIA-US' THEN 0 ELSE count(*) END::BIGINT AS stored_rows
FROM (SELECT store_name, count(*) AS n FROM order_lines
      GROUP BY store_name, amazon_order_id, order_item_id, l_partkey, l_suppkey, item_price, quantity)
GROUP BY store_name""", "order_lines")
oracle("import_rejects", """
SELECT 'store=ASIA-US' AS folder, 'amazon-order-id is empty' AS reasons, count(*) AS rejected, count(*) AS places
FROM order_lines WHERE store_name = 'ASIA-US' AND l_partkey % 97 = 0""", "order_lines")
cte("monthly_lines", """
SELECT store_name, l_linenumber, CAST(amazon_order_id AS BIGINT) AS k, amazon_order_id, trim(sku) AS sku, quantity,
       CAST(quantity AS VARCHAR) AS quantity_text, CAST(CAST(item_price AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
       replace(promotion_ids, ' ', chr(10)) AS promotion_ids, order_status, currency,
       make_timestamp(1996, 5, CAST(amazon_order_id AS BIGINT) % 28 + 2, CAST(amazon_order_id AS BIGINT) % 24, 0, 0.0)
         AS bought
FROM order_lines
""", "order_lines")
cte("monthly_numbered", """
SELECT *, strftime(bought, '%Y-%m-%dT%H:%M:%SZ') AS date_text,
       row_number() OVER (PARTITION BY store_name ORDER BY k, bought, sku, quantity_text, price_text,
         coalesce(promotion_ids, ''), order_status, currency) + 1 AS source_row_no
FROM monthly_lines
""", "monthly_lines")
oracle("ingest_monthly", """
SELECT store_name, DATE '1996-05-01' AS report_month, source_row_no, amazon_order_id,
       'txt-' || source_row_no || '-' || substr(sha256(concat_ws('|', store_name, '1996-05-01', amazon_order_id, sku, '',
       date_text, quantity_text, price_text, CAST(source_row_no AS VARCHAR))), 1, 24) AS order_item_id,
       bought AS purchase_date_utc, sku, quantity, CAST(price_text AS DOUBLE) AS item_price, promotion_ids,
       order_status, currency
FROM monthly_numbered""", "monthly_numbered")
oracle("monthly_precheck", """
SELECT store_name, count(*) AS input_rows,
       CASE store_name WHEN 'ASIA-US' THEN count(*) FILTER (WHERE l_linenumber = 1) ELSE 0 END AS old_rows,
       count(*) FILTER (WHERE quantity = 0) AS zero_rows, FALSE AS applied
FROM monthly_lines GROUP BY store_name""", "monthly_lines")
ORACLE["performance_import_rows"] = ORACLE["performance_rows"]
ORACLE["performance_import_log"] = ORACLE["performance_load_stats"]


def quoted_form(key: str, plain: str) -> str:
    """What the report texts with quotes in every form stand for."""
    return f"""CASE {key} % 6 WHEN 0 THEN 'Screen 5" ' || CAST({key} AS VARCHAR)
       WHEN 1 THEN 'two' || chr(10) || 'lines' || chr(9) || CAST({key} AS VARCHAR)
       WHEN 2 THEN 'a "b"' || chr(10) || chr(10) || 'c' WHEN 3 THEN 'end of 7"' WHEN 5 THEN {plain} END"""


oracle("strict_quotes", f"""
SELECT DISTINCT * FROM (
  SELECT {_LINE.replace("order_item_id,", "concat_ws('-', order_item_id, CAST(l_partkey AS VARCHAR),"
                        " CAST(l_suppkey AS VARCHAR), CAST(item_price AS VARCHAR),"
                        " CAST(quantity AS VARCHAR)) AS order_item_id,")}, {quoted_form("l_partkey", "'plain'")} AS product_name
  FROM order_lines)""", "order_lines")
cte("quoted_numbered", f"""
SELECT * REPLACE ({quoted_form("k", "replace(promotion_ids, chr(10), ' ')")} AS promotion_ids),
       strftime(bought, '%Y-%m-%dT%H:%M:%SZ') AS date_text,
       row_number() OVER (PARTITION BY store_name ORDER BY k, bought, sku, quantity_text, price_text,
         coalesce(CASE k % 6 WHEN 5 THEN replace(promotion_ids, chr(10), ' ') END, ''), order_status, currency) + 1 AS source_row_no
FROM monthly_lines
""", "monthly_lines")
oracle("monthly_quotes", """
SELECT store_name, source_row_no, amazon_order_id,
       'txt-' || source_row_no || '-' || substr(sha256(concat_ws('|', store_name, '1996-05-01', amazon_order_id, sku, '',
       date_text, quantity_text, price_text, CAST(source_row_no AS VARCHAR))), 1, 24) AS order_item_id,
       bought AS purchase_date_utc, sku, quantity, CAST(price_text AS DOUBLE) AS item_price, promotion_ids,
       order_status, currency
FROM quoted_numbered""", "quoted_numbered")
cte("delivered_lines", """
SELECT * REPLACE (CASE store_name WHEN 'AFRICA-US' THEN 'JQ-US' WHEN 'AMERICA-US' THEN 'MT-US' WHEN 'ASIA-US' THEN 'RKZ-US'
                  ELSE 'SY-US' END AS store_name)
FROM monthly_lines
""", "monthly_lines")
oracle("monthly_deliveries", """
SELECT store_name, CASE WHEN store_name IN ('JQ-US', 'SY-US') THEN 1 ELSE 2 END::BIGINT AS deliveries, 9 AS day,
       DATE '2026-05-01' AS report_month, amazon_order_id, bought + INTERVAL 30 YEAR AS purchase_date_utc, sku, quantity,
       CAST(price_text AS DOUBLE) AS item_price, promotion_ids,
       row_number() OVER (PARTITION BY store_name ORDER BY k, bought, sku, quantity_text, price_text,
         coalesce(promotion_ids, ''), order_status, currency) + 1 AS source_row_no
FROM delivered_lines""", "delivered_lines")
