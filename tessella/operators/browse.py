"""Browsing a release: facets, filters, counts, instruments in view, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_values(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(facet, value): distinct values of every field, by one exploded aggregate."""
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in fields])
    return rows.select(F.explode(pairs).alias("p")).select("p.facet", "p.value").distinct()


def facet_filter(rows: DataFrame, chosen: dict[str, str | None], query: str = "", search: tuple[str, ...] = ("application_id", "office_name")) -> DataFrame:
    """Rows equal to every chosen facet whose joined search columns contain the query, in any case."""
    for field, value in chosen.items():
        if value:
            rows = rows.filter(F.col(field) == value)
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in search])
    return rows.filter(F.contains(F.lower(text), F.lit(query.lower()))) if query else rows


def visible_count(rows: DataFrame, chosen: dict[str, str | None], query: str = "", search: tuple[str, ...] = ("application_id", "office_name")) -> DataFrame:
    """(visible, total) in one pass."""
    test = F.lit(True)
    for field, value in chosen.items():
        if value:
            test = test & F.coalesce(F.col(field) == value, F.lit(False))
    if query:
        text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in search])
        test = test & F.contains(F.lower(text), F.lit(query.lower()))
    return rows.agg(F.count_if(test).alias("visible"), F.count("*").alias("total"))


def instruments_in_view(instruments: DataFrame, rows: DataFrame) -> DataFrame:
    return instruments.join(rows.select("batch_id"), "batch_id", "left_semi")


def label(value: Column, labels: dict[str, str]) -> Column:
    """A value's label, or the value."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), value), value)
