"""The driver tables seen as a panel: customers are entities, order years are years, order statuses are schemes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import panel

YEARS = (1995, 2001)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an observation: entity, year, tipo, rangos, monto, and what orders them."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("entity"),
        F.year("o_orderdate").cast("long").alias("year"),
        F.col("o_orderstatus").alias("tipo"),
        F.floor(F.col("o_totalprice") / 150000).cast("long").alias("rangos"),
        F.col("o_totalprice").alias("monto"),
        "o_orderdate",
        "o_orderkey",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer and year."""
    first = panel.keep_first(order_rows(spark, sf_dir), ["entity", "year"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("entity", "year", "tipo", "rangos", "monto")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year spine of the observations: kind and ranges only."""
    return panel.spine(observations(spark, sf_dir).select("entity", "year", "tipo", "rangos"), YEARS)


OBS = """
ord AS (
  SELECT o_custkey AS entity, year(o_orderdate)::BIGINT AS year, o_orderstatus AS tipo, floor(o_totalprice / 150000)::BIGINT AS rangos, o_totalprice AS monto, o_orderdate, o_orderkey FROM orders
), obs AS (
  SELECT entity, year, tipo, rangos, monto FROM (SELECT *, row_number() OVER (PARTITION BY entity, year ORDER BY o_orderdate, o_orderkey) AS rn FROM ord) WHERE rn = 1
)"""

CELLS = (
    OBS
    + """, cells AS (
  SELECT e.entity, y.year, o.tipo, o.rangos, o.entity IS NOT NULL AS observed
  FROM (SELECT DISTINCT entity FROM obs) e CROSS JOIN (SELECT unnest(range(1995, 2002))::BIGINT AS year) y LEFT JOIN obs o ON o.entity = e.entity AND o.year = y.year
), nb AS (
  SELECT *, max(CASE WHEN observed THEN year END) OVER (PARTITION BY entity ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS py,
    min(CASE WHEN observed THEN year END) OVER (PARTITION BY entity ORDER BY year ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ny,
    min(CASE WHEN observed THEN year END) OVER (PARTITION BY entity) AS fy, max(CASE WHEN observed THEN year END) OVER (PARTITION BY entity) AS ly
  FROM cells
), vals AS (
  SELECT nb.*, p.tipo AS pt, p.rangos AS pr, n.tipo AS nt, n.rangos AS nr, f.tipo AS ft, f.rangos AS fr, l.tipo AS lt, l.rangos AS lr
  FROM nb LEFT JOIN obs p ON p.entity = nb.entity AND p.year = nb.py LEFT JOIN obs n ON n.entity = nb.entity AND n.year = nb.ny
  LEFT JOIN obs f ON f.entity = nb.entity AND f.year = nb.fy LEFT JOIN obs l ON l.entity = nb.entity AND l.year = nb.ly
)"""
)

IMPUTED = (
    CELLS
    + """, ruled AS (
  SELECT *, CASE WHEN observed THEN ''
    WHEN ny - py - 1 <= 4 AND pt = nt AND pr = nr THEN 'confirmed_fill'
    WHEN year - py <= 4 AND (ny IS NULL OR ny - py - 1 > 4) THEN 'ffill'
    WHEN py IS NULL AND ny - year <= 4 THEN 'bfill'
    WHEN fy < year AND year < ly AND ft = lt AND fr = lr THEN 'closure_fill'
    WHEN ny - py - 1 <= 4 AND pt = nt THEN 'tipo_only_fill' END AS imputed_method
  FROM vals
), imputed AS (
  SELECT entity, year, observed,
    CASE WHEN imputed_method = '' THEN tipo WHEN imputed_method IN ('confirmed_fill', 'ffill', 'tipo_only_fill') THEN pt WHEN imputed_method = 'bfill' THEN nt WHEN imputed_method = 'closure_fill' THEN ft END AS tipo,
    CASE WHEN imputed_method = '' THEN rangos WHEN imputed_method IN ('confirmed_fill', 'ffill') THEN pr WHEN imputed_method = 'bfill' THEN nr WHEN imputed_method = 'closure_fill' THEN fr END AS rangos,
    imputed_method,
    CASE WHEN imputed_method IN ('confirmed_fill', 'ffill', 'tipo_only_fill') THEN py WHEN imputed_method = 'bfill' THEN ny WHEN imputed_method = 'closure_fill' THEN fy END AS imputed_from_year,
    CASE WHEN imputed_method IS NOT NULL THEN NULL WHEN py IS NULL AND ny IS NULL THEN 'no_data' WHEN ny - py - 1 <= 4 THEN 'schema_discontinuity'
      WHEN least(year - py, ny - year) > 4 THEN 'long_gap' ELSE 'edge' END AS gap_reason
  FROM ruled
)"""
)
