"""Order report files: strict 39-column reports and lenient monthly cumulative files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.functions import convert, text
from merchlens.functions.dates import month_label
from merchlens.schemas import (
    BOOL_COLUMNS, DATE_COLUMNS, INT_COLUMNS, MONEY_COLUMNS, ORDER_HEADERS, ORDER_NOT_NULL, schema_of,
)
from merchlens.sources import files

BAD_ROW = "_bad_row"
BAD_HEADER = "_bad_header"

# Accepted source names per target column where they differ.
ALIASES = {
    "purchase_date": ("purchase_date_utc", "purchase_date"),
    "last_updated_date": ("last_updated_date_utc", "last_updated_date"),
    "sku": ("sku", "seller_sku", "msku"),
}


def read_strict(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Raw report rows with record numbers; rows of another width are kept and marked.

    A header row is left out when it has the 39 expected names, and kept and
    marked in ``_bad_header`` when not. Files are split between tasks, also
    where quoted fields hold line breaks.
    """
    if files.holds_open_lines(spark, paths, "UTF-8", "\t"):
        lines = files.text_records(spark, paths, "UTF-8", "\t", True, len(ORDER_HEADERS))
    else:
        lines = files.text_lines(spark, paths, "UTF-8", keep_blank=True)
    rows = lines.withColumn("_fields", files.fields_of(F.col("line"), "\t"))
    fits = F.size("_fields") == len(ORDER_HEADERS)
    names = F.transform("_fields", lambda x: text.strip(F.replace(x, F.lit("\ufeff"), F.lit(""))))
    is_header = F.col("source_row_no") == 1
    same = names == F.array(*[F.lit(h) for h in ORDER_HEADERS])
    # A blank line is a row without columns.
    short = (F.length("line") <= files.FIELD_LIMIT) | F.forall("_fields", lambda x: F.length(x) <= files.FIELD_LIMIT)
    bad = F.when((F.col("line") == "") | ~fits, F.col("line")).when(~short, F.lit("a field is too long"))
    return rows.filter(~(is_header & same)).select(
        *[F.nullif(F.get("_fields", F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(ORDER_HEADERS)], bad.alias(BAD_ROW),
        F.when(is_header, F.array_join(names, "\t")).alias(BAD_HEADER), "_path", "source_row_no",
    )


def convert_strict(raw: DataFrame) -> DataFrame:
    """Typed columns and ``reject_reasons`` (empty for a good row).

    Texts are stripped, then converted, then checked, each in a step of its own, so that none is done anew where it is used.
    """
    names = {h.replace("-", "_"): h for h in ORDER_HEADERS}
    stripped = (*INT_COLUMNS, *MONEY_COLUMNS, *BOOL_COLUMNS, *DATE_COLUMNS)
    ids = ("amazon_order_id", "order_item_id")
    kept = [c for c in raw.columns if c not in ORDER_HEADERS]
    texts = raw.select(
        *kept, *[text.strip(f"`{h}`").alias(n) if n in ids else text.empty_to_null(f"`{h}`").alias(n)
                 for n, h in names.items() if n not in stripped or n in DATE_COLUMNS],
        *[text.strip_or_null(f"`{names[n]}`").alias(f"_text_{n}") for n in stripped],
    )
    columns: dict[str, Column] = {}
    converted = {n: c for kind, c in (
        (INT_COLUMNS, convert.to_int), (MONEY_COLUMNS, convert.to_decimal), (BOOL_COLUMNS, convert.to_bool), (DATE_COLUMNS, convert.to_utc),
    ) for n in kind}
    reasons = [
        F.when(F.col(BAD_HEADER).isNotNull(), _header_reason()),
        F.when(F.col(BAD_ROW).isNotNull(), F.lit("wrong number of columns")),
        F.when(F.col("amazon_order_id") == "", F.lit("amazon-order-id is empty")),
    ]
    for name, header in names.items():
        if name in DATE_COLUMNS:
            columns[f"{name}_raw"] = F.col(name)
        if name not in converted:
            columns[name] = F.col(name)
            continue
        typed = f"{name}_utc" if name in DATE_COLUMNS else name
        columns[typed] = converted[name](F.col(f"_text_{name}"), stripped=True)
        reasons.append(convert.unreadable(header, F.col(f"_text_{name}"), F.col(typed), stripped=True))
    typed_rows = texts.select(*kept, *[c.alias(n) for n, c in columns.items()], *[f"_text_{n}" for n in stripped])
    return typed_rows.select("_path", "source_row_no", *columns, F.array_compact(F.array(*reasons)).alias("reject_reasons"))


def _header_reason() -> Column:
    found = F.transform(F.split(BAD_HEADER, "\t"), text.strip)
    expected = F.array(*[F.lit(h) for h in ORDER_HEADERS])
    return F.concat(
        F.lit("header lacks ["), F.array_join(F.array_except(expected, found), ", "),
        F.lit("], has extra ["), F.array_join(F.array_except(found, expected), ", "),
        F.lit("], columns: "), F.size(found).cast("string"),
    )


def source_value(header: list[str], target: str) -> Column | None:
    """First non-empty of the target's source names present in the file; None if none is."""
    present = [a for a in ALIASES.get(target, (target,)) if a in header]
    return text.first_non_empty(*[f"`{a}`" for a in present]) if present else None


def insert_columns(
    header: list[str], table: str, provided: tuple[str, ...], not_null: tuple[str, ...] = ORDER_NOT_NULL
) -> list[str]:
    """Target columns that get a value; fails when a required one has no source."""
    chosen = []
    for field in schema_of(table):
        base = field.name.removesuffix("_utc").removesuffix("_raw")
        if field.name in provided or source_value(header, base) is not None:
            chosen.append(field.name)
        elif field.name in not_null:
            raise ValueError(f"the file has no source for required column {field.name}")
    return chosen


def read_monthly(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Stripped text rows of a monthly file with record numbers, and its normalised header."""
    charset = files.inspect_text(spark, path)
    names, delimiter = files.header_record(spark, path, charset)
    if not names:
        raise ValueError(f"{path} has no header")
    header = [files.normalize_header(n) for n in names]
    # Of equal names the last column counts.
    columns = [n if n not in header[i + 1:] else f"_dropped_{i}" for i, n in enumerate(header)]
    kept = [n for n in columns if n and not n.startswith("_dropped_")]
    columns = [n or f"_unnamed_{i}" for i, n in enumerate(columns)]
    if charset == "UTF-16":
        # Line breaks cannot be found in the raw bytes, so one task reads the file.
        rows = spark.read.csv(
            path, schema=T.StructType([T.StructField(n, T.StringType()) for n in columns]), sep=delimiter,
            header=True, quote='"', escape='"', mode="PERMISSIVE", encoding=charset, multiLine=True,
        )
        numbered = files.number_rows(rows.select("*", *files.scan_position()))
        rows = numbered.withColumn("source_row_no", F.col("source_row_no") + 1)
    else:
        # Only a file with breaks inside quotes needs its lines put together.
        if files.holds_open_lines(spark, path, charset, delimiter):
            lines = files.text_records(spark, path, charset, delimiter, False, len(columns))
        else:
            lines = files.text_lines(spark, path, charset, False)
        fields = files.fields_of(F.col("line"), delimiter)
        long = F.raise_error(F.concat(F.lit("a field is longer than allowed in row "), F.col("source_row_no")))
        # Only in a long line is a field too long; the fields are taken apart once and then looked at.
        too_long = (F.length("line") > files.FIELD_LIMIT) & F.exists("_fields", lambda x: F.length(x) > files.FIELD_LIMIT)
        rows = lines.filter("source_row_no > 1").withColumn("_fields", fields)
        rows = rows.withColumn("_fields", F.when(too_long, long).otherwise(F.col("_fields"))).select(
            "_path", "source_row_no", *[F.nullif(F.get("_fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(columns)]
        )
    clean = [text.strip(f"`{name}`").alias(name) for name in kept]
    # A row is blank if no column holds more than whitespace; told without a strip of each.
    blank = ~F.concat_ws("", *[F.col(f"`{name}`") for name in kept]).rlike(f"[^{text.WHITESPACE}]")
    return rows.filter(~blank).select("_path", "source_row_no", *clean), kept


def synthetic_item_id(
    store: Column, month: Column, row_no: Column, values: dict[str, Column]
) -> Column:
    """Stable id for a line without one: ``txt-{row}-{first 24 hex digits}``."""
    order = ("amazon_order_id", "sku", "asin", "purchase_date", "quantity", "item_price")
    parts = [store, F.date_format(month, "yyyy-MM-dd"), *[values[n] for n in order], row_no]
    return F.concat(F.lit("txt-"), row_no.cast("string"), F.lit("-"), text.digest(parts, 24))


def source_hash(store: Column, values: dict[str, Column]) -> Column:
    order = ("amazon_order_id", "sku", "purchase_date", "quantity", "item_price")
    return text.digest([store, *[values[n] for n in order]])


def row_rejects(quantity_text: Column, quantity: Column, date: Column, order_id: Column, sku: Column,
                keep_zero: bool = True) -> Column:
    """Reasons a lenient row is refused. Zero quantity is kept unless told otherwise."""
    positive = quantity > 0
    if keep_zero:
        positive = positive | (convert.to_decimal_lenient(quantity_text, "decimal(38,10)") == 0)
    return F.array_compact(F.array(
        F.when(~F.coalesce(positive, F.lit(False)), F.lit("quantity must be positive or zero" if keep_zero
                                                          else "quantity must be positive")),
        F.when(date.isNull(), F.lit("purchase date is empty")),
        F.when(F.coalesce(order_id, F.lit("")) == "", F.lit("order id is empty")),
        F.when(F.coalesce(sku, F.lit("")) == "", F.lit("sku is empty")),
    ))


def convert_monthly(
    rows: DataFrame, header: list[str], store: str, month: dt.date, keep_zero: bool = True
) -> DataFrame:
    """Typed columns of a monthly file and ``reject_reasons``."""
    null = F.lit(None).cast("string")
    targets = [h.replace("-", "_") for h in ORDER_HEADERS]
    found = {n: source_value(header, n) for n in targets}
    # Texts are stripped, then converted, then checked, each in a step of its own, so that none is done anew where it is used.
    texts = rows.select("_path", "source_row_no", *[c.alias(f"_text_{n}") for n, c in found.items() if c is not None])
    values = {n: null if c is None else F.col(f"_text_{n}") for n, c in found.items()}

    columns: dict[str, Column] = {}
    unreadable: list[Column] = []
    for name in targets:
        source, typed = values[name], name
        if name in INT_COLUMNS:
            columns[name] = convert.to_int_lenient(source, stripped=True)
        elif name in MONEY_COLUMNS:
            columns[name] = convert.to_decimal_lenient(source, stripped=True)
        elif name in BOOL_COLUMNS:
            columns[name] = convert.to_int_lenient(source, stripped=True) != 0
        elif name in DATE_COLUMNS:
            typed = f"{name}_utc"
            columns[f"{name}_raw"] = source
            columns[typed] = convert.to_utc(source, stripped=True)
        else:
            columns[name] = source
            continue
        if found[name] is not None:
            unreadable.append(convert.unreadable(name, source, F.col(typed), stripped=True))
    synthetic = synthetic_item_id(F.lit(store), F.lit(month), F.col("source_row_no"), values)
    columns["order_item_id"] = F.coalesce(columns["order_item_id"], synthetic)
    rejects = row_rejects(
        values["quantity"], F.col("quantity"), F.col("purchase_date_utc"), F.col("amazon_order_id"), F.col("sku"), keep_zero,
    )
    typed_rows = texts.select("*", *[c.alias(n) for n, c in columns.items()])
    return typed_rows.select(
        "_path", "source_row_no", *columns,
        F.concat(rejects, F.array_compact(F.array(*unreadable))).alias("reject_reasons"),
    )


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.size("reject_reasons") == 0
    return rows.filter(good).drop("reject_reasons"), rows.filter(~good)


def month_purity(rows: DataFrame, month: dt.date, threshold: float = 0.95) -> DataFrame:
    """Share of rows whose UTC month is the target month, and whether it is enough."""
    hit = month_label("purchase_date_utc") == month.strftime("%Y-%m")
    return rows.filter(F.col("purchase_date_utc").isNotNull()).agg(
        F.count(F.lit(1)).alias("dated_rows"),
        F.count_if(hit).alias("month_rows"),
        F.min("purchase_date_utc").alias("first_purchase_utc"),
        F.max("purchase_date_utc").alias("last_purchase_utc"),
    ).withColumn(
        "is_pure",
        F.coalesce(F.try_divide(F.col("month_rows").cast("double"), F.col("dated_rows").cast("double"))
                   >= threshold, F.lit(False)),
    )


def duplicate_items(rows: DataFrame, key: tuple[str, ...] = ("amazon_order_id", "order_item_id")) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def load_audit(rows: DataFrame) -> DataFrame:
    """Row, order-SKU and unit counts and the weighted price of loaded lines."""
    net = F.col("item_price") - F.coalesce("item_promotion_discount", F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("amazon_order_id", "sku").alias("order_sku_count"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("units"),
        F.round(F.try_divide(F.sum(net), F.sum("quantity")), 4).cast("decimal(20,4)").alias("weighted_deal_price"),
    )
