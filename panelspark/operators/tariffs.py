"""Documents of several tariffs: assembled from rows in one aggregate, and taken apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.documents import mixed_columns


def columns_of(written: Column) -> Column:
    """Mixed columns as a list of (name, value) in order of name, whether JSON has them as a map of values or as a list of names and values."""
    as_list = F.from_json(written, "array<struct<name:string,value:double>>")
    as_map = F.from_json(written, "map<string,double>")
    return F.when(F.startswith(F.btrim(written), F.lit("[")), mixed_columns(F.lit(None).cast("map<string,double>"), as_list)).otherwise(mixed_columns(as_map, F.lit(None).cast("array<struct<name:string,value:double>>")))


def assembled(rows: DataFrame, document: str, tariff: list[str], block: list[str], position: str, values: list[str]) -> DataFrame:
    """One row for each document: tariffs, an array of the ``tariff`` columns and blocks, each of the ``block`` columns and rows (position, values).

    Tariffs and blocks are in order of their columns, rows in order of position; one aggregate gathers a document, which is one row of the output.
    """
    each = F.struct(F.struct(*tariff).alias("t"), F.struct(*block).alias("b"), F.struct(position, *values).alias("r"))
    x = rows.groupBy(document).agg(F.sort_array(F.collect_list(each)).alias("_x"))
    of = lambda items, field: F.array_distinct(F.transform(items, lambda e: e[field]))

    def with_rows(items: Column, b: Column) -> Column:
        found = F.transform(F.filter(items, lambda e: e["b"].eqNullSafe(b)), lambda e: e["r"])
        return F.struct(*[b[c].alias(c) for c in block], found.alias("rows"))

    def with_blocks(t: Column) -> Column:
        items = F.filter("_x", lambda e: e["t"].eqNullSafe(t))
        return F.struct(*[t[c].alias(c) for c in tariff], F.transform(of(items, "b"), lambda b: with_rows(items, b)).alias("blocks"))

    return x.select(document, F.transform(of(F.col("_x"), "t"), with_blocks).alias("tariffs"))


def taken_apart(docs: DataFrame, document: str) -> DataFrame:
    """Rows of assembled documents: document, the columns of tariffs, blocks and rows. Documents without rows give none."""
    t = docs.select(document, F.explode("tariffs").alias("_t"))
    b = t.select(document, *[F.col(f"_t.{f.name}").alias(f.name) for f in t.schema["_t"].dataType.fields if f.name != "blocks"], F.explode("_t.blocks").alias("_b"))
    head = [c for c in b.columns if c != "_b"]
    r = b.select(*head, *[F.col(f"_b.{f.name}").alias(f.name) for f in b.schema["_b"].dataType.fields if f.name != "rows"], F.explode("_b.rows").alias("_r"))
    return r.select(*[c for c in r.columns if c != "_r"], "_r.*")
