"""Stable deduplication: the first occurrence stays, order is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, position, line): each distinct normalised line of a text once, at its first place, renumbered."""
    each = docs.select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("at", "line")).withColumn("key", F.lower(F.trim(F.regexp_replace("line", r"\s+", " ")))).where("key <> ''")
    first = each.withColumn("k", F.row_number().over(Window.partitionBy(id_col, "key").orderBy("at"))).where("k = 1")
    return first.select(id_col, (F.row_number().over(Window.partitionBy(id_col).orderBy("at")) - 1).alias("position"), "line")


def blocks(items: Column, key: str = "text") -> Column:
    """Array of block structs without those whose normalised text came before; inside the row, no shuffle."""
    norm = lambda b: F.lower(F.trim(F.regexp_replace(F.coalesce(b[key], F.lit("")), r"\s+", " ")))
    return F.filter(items, lambda b, i: (norm(b) == "") | ~F.exists(F.slice(items, F.lit(1), i), lambda e: norm(e) == norm(b)))


def without_contained(items: Column, reach: int = 3, key: str = "text") -> Column:
    """Without quotes that a neighbour within `reach` blocks contains."""
    inside = lambda b, i: F.exists(F.filter(items, lambda o, j: (j != i) & (F.abs(j - i) <= reach) & (o["kind"] == "paragraph")), lambda o: F.contains(F.lower(o[key]), F.lower(b[key])))
    return F.filter(items, lambda b, i: ~((b["kind"] == "quote") & F.coalesce(inside(b, i), F.lit(False))))
