"""Text helpers as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a whitespace strip removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Raw order text compares without case and without trailing spaces.
LOOSE = "UTF8_LCASE_RTRIM"


def same_text(column: Column | str, value: str) -> Column:
    # Text that is the same as it stands, most of it, is told without the collation, which costs far more.
    return (_col(column) == F.lit(value)) | (F.collate(_col(column), LOOSE) == F.lit(value))


def strip(column: Column | str) -> Column:
    """Whitespace removed at both ends; null becomes the empty string."""
    return F.btrim(F.coalesce(_col(column).cast("string"), F.lit("")), F.lit(WHITESPACE))


def strip_or_null(column: Column | str) -> Column:
    return F.nullif(strip(column), F.lit(""))


def norm(column: Column | str) -> Column:
    """Report key: stripped and upper case."""
    return F.upper(strip(column))


def empty_to_null(column: Column | str) -> Column:
    return F.nullif(_col(column), F.lit(""))


def sku_key(column: Column | str) -> Column:
    """Attribution key: outer spaces (only spaces) removed, upper case."""
    return F.upper(F.trim(_col(column)))


def first_non_empty(*columns: Column | str) -> Column:
    """First column that holds more than whitespace, stripped."""
    return F.coalesce(*[strip_or_null(c) for c in columns])


def digest(parts: list[Column], length: int | None = None) -> Column:
    """SHA-256 in hex over the parts joined by ``|``; null parts count as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    value = F.sha2(joined, 256)
    return value if length is None else F.substring(value, 1, length)


def custom_field_value(json_text: Column | str, name: str) -> Column:
    """Values of the custom fields called ``name`` in a JSON list, joined by ``|``.

    Each matching item gives its first non-empty of four value keys; repeated
    values count once. Text that is not a JSON list of objects gives ''.
    """
    items = F.try_variant_get(F.try_parse_json(_col(json_text)), "$", "array<variant>")

    def text_at(item: Column, key: str) -> Column:
        return F.nullif(F.try_variant_get(item, f"$.{key}", "string"), F.lit(""))

    def value_of(item: Column) -> Column:
        return strip(F.coalesce(*[text_at(item, k) for k in ("val_text", "val", "value", "field_value")]))

    named = F.filter(items, lambda x: strip(F.try_variant_get(x, "$.name", "string")) == F.lit(name))
    values = F.filter(F.transform(named, value_of), lambda v: v != F.lit(""))
    return F.coalesce(F.array_join(F.array_distinct(values), "|"), F.lit(""))


# Path separators in order of preference, as regular expressions.
PATH_SEPARATORS = ((">", ">"), ("/", "/"), ("／", "／"), ("\\", "\\\\"))


def category_fallback(name: Column | str, path: Column | str) -> Column:
    """Category name, else the last non-empty step of the category path."""
    clean_path = strip(path)

    def last_step(separator: str, pattern: str) -> Column:
        steps = F.filter(F.transform(F.split(clean_path, pattern, -1), strip), lambda s: s != F.lit(""))
        return F.when(F.contains(clean_path, F.lit(separator)), F.try_element_at(steps, F.lit(-1)))

    return F.coalesce(
        strip_or_null(name),
        *[last_step(s, p) for s, p in PATH_SEPARATORS],
        clean_path,
    )


# Mapping audit labels.
NO_LISTING = "未匹配Listing（店铺+MSKU）"
FULL_MATCH = "已完整匹配"
ISSUES = {
    "local_sku": "Listing本地SKU为空",
    "principal": "负责人为空",
    "product": "未匹配产品管理",
    "style_no": "款号/SPU为空",
    "season": "季节为空",
    "category": "品类为空",
}
UNMATCHED_STYLE = "（未匹配款号）"
NOT_MAINTAINED = "（未维护）"


def mapping_reason(has_listing: Column, has_product: Column) -> Column:
    """Why an order MSKU has no complete mapping; expects the mapped columns by name."""

    def issue(name: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(ISSUES[name]))

    listing_issues = [issue("local_sku"), issue("principal")]
    product_issues = [issue(n) for n in ("style_no", "season", "category")]
    without_product = F.concat_ws("；", *listing_issues, F.lit(ISSUES["product"]))
    with_product = F.concat_ws("；", *listing_issues, *product_issues)
    return (
        F.when(~has_listing, F.lit(NO_LISTING))
        .when(~has_product, without_product)
        .when(with_product == "", F.lit(FULL_MATCH))
        .otherwise(with_product)
    )


def placeholder(column: Column | str, text: str) -> Column:
    return F.coalesce(F.nullif(_col(column), F.lit("")), F.lit(text))
