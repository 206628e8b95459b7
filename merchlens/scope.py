"""Store and month scope shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.text import LOOSE


def month_start(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.date):
        return dt.date(value.year, value.month, 1)
    parts = str(value)[:10].split("-")
    return dt.date(int(parts[0]), int(parts[1]), 1)


def add_months(month: dt.date, n: int) -> dt.date:
    index = month.year * 12 + month.month - 1 + n
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class Scope:
    """Half-open month range and an optional store list (None means every store)."""

    start: dt.date
    end: dt.date
    stores: tuple[str, ...] | None = None

    @classmethod
    def of(cls, start, end, stores: Iterable[str] | str | None = None) -> Scope:
        if isinstance(stores, str):
            stores = stores.split(",")
        cleaned = None
        if stores is not None:
            cleaned = tuple(s.strip() for s in stores if s and s.strip())
            if not cleaned:
                raise ValueError("store list is empty")
        first, last = month_start(start), month_start(end)
        if first >= last:
            raise ValueError(f"start month {first} must be before end month {last}")
        return cls(first, last, cleaned)

    @property
    def months(self) -> list[dt.date]:
        n = (self.end.year - self.start.year) * 12 + self.end.month - self.start.month
        return [add_months(self.start, i) for i in range(n)]

    def month_filter(self, column: str = "order_month") -> Column:
        return (F.col(column) >= F.lit(self.start)) & (F.col(column) < F.lit(self.end))

    def store_filter(self, column: str = "store_name", collation: str | None = None) -> Column:
        """Partition predicates on the store column prune folders in either form."""
        if self.stores is None:
            return F.lit(True)
        name = F.col(column)
        if collation is None:
            return name.isin(list(self.stores))
        return F.collate(name, collation).isin(list(self.stores))

    def fold_store(self, df: DataFrame, store: str = "store_name") -> DataFrame:
        """Rows of the scope's stores, whatever the case of the name, under the name the scope gives."""
        if self.stores is None:
            return df
        name = F.collate(F.col(store), LOOSE)
        known = F.coalesce(*[F.when(name == s, F.lit(s)) for s in self.stores])
        return df.filter(self.store_filter(store, LOOSE)).withColumn(store, known)

    def apply(self, df: DataFrame, month: str = "order_month", store: str = "store_name") -> DataFrame:
        return df.filter(self.month_filter(month) & self.store_filter(store))


def infer_scope(df: DataFrame, month: str = "order_month", stores: Iterable[str] | None = None) -> Scope:
    """First month to the month after the last one present (one-row result)."""
    row = df.agg(F.min(month).alias("lo"), F.max(month).alias("hi")).first()
    if row.lo is None:
        raise ValueError("no data to infer a month range from")
    return Scope.of(row.lo, add_months(month_start(row.hi), 1), stores)


def scope_summary(df: DataFrame, month: str = "order_month", store: str = "store_name") -> DataFrame:
    """One row: first month, exclusive end month and the sorted distinct store list."""
    return df.groupBy(store).agg(F.min(month).alias("lo"), F.max(month).alias("hi")).agg(
        F.to_date(F.trunc(F.min("lo"), "month")).alias("start_month"),
        F.add_months(F.trunc(F.max("hi"), "month"), 1).alias("end_month_exclusive"),
        F.array_join(F.array_sort(F.collect_set(store)), ",").alias("stores"),
    )
