"""Small hand-made inputs."""

import datetime as dt
from decimal import Decimal

from merchlens.schemas import ORDER_HEADERS, schema_of
from merchlens.sources.warehouse import Warehouse

GOOD = {
    "amazon-order-id": "111-1", "purchase-date": "2025-01-15T12:00:00+00:00", "order-status": "Shipped",
    "sales-channel": "Amazon.com", "sku": "SKU-A", "asin": "B1", "item-status": "Shipped", "quantity": "2",
    "currency": "USD", "item-price": "40.00", "item-promotion-discount": "", "is-business-order": "false",
    "order-item-id": "1",
}


def report_line(**changes):
    row = {**GOOD, **{k.replace("_", "-"): v for k, v in changes.items()}}
    return "\t".join(row.get(h, "") for h in ORDER_HEADERS)


def write_report(path, lines, header=None, bom=True, newline="\n"):
    text = newline.join(["\t".join(header or ORDER_HEADERS), *lines]) + newline
    path.write_bytes(text.encode("utf-8-sig" if bom else "utf-8"))
    return str(path)


def order(**changes):
    row = {
        "store_name": "SY-US", "report_month": dt.date(2025, 1, 1), "source_file": "f", "source_file_sha256": "h",
        "source_row_no": 2, "import_batch_no": "b", "amazon_order_id": "1", "order_item_id": "1",
        "purchase_date_utc": dt.datetime(2025, 1, 15, 12), "order_status": "Shipped",
        "sales_channel": "Amazon.com", "item_status": "Shipped", "sku": "SKU-A", "quantity": 1,
        "currency": "USD", "item_price": Decimal("20"), "item_promotion_discount": None, "promotion_ids": None,
    }
    row.update(changes)
    return row


def orders_frame(spark, rows):
    schema = schema_of("ods_amz_all_orders_report")
    return spark.createDataFrame([tuple(order(**r).get(f.name) for f in schema) for r in rows], schema)


def frame(spark, table, rows):
    schema = schema_of(table)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def warehouse(spark, tmp_path, name="wh"):
    return Warehouse(spark, str(tmp_path / name))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
