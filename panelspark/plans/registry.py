"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelspark.plans import coverage_queries, document_queries, index_queries, panel_queries, report_queries, review_queries, source_queries, stream_queries, variant_queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balanced panel with imputation, event-study variables and names."""
    imputed = panel_queries.impute_full_balanced(spark, sf_dir)
    study = panel_queries.event_study_panel(spark, sf_dir).drop("tipo")
    names = panel_queries.catalog_enrichment(spark, sf_dir).withColumnRenamed("c_custkey", "entity")
    return imputed.join(study, ["entity", "year"]).join(names, "entity", "left")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return panel_queries.QUERIES | document_queries.QUERIES | source_queries.QUERIES | variant_queries.QUERIES | review_queries.QUERIES | stream_queries.QUERIES | index_queries.QUERIES | coverage_queries.QUERIES | report_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return panel_queries.SQL | document_queries.SQL | source_queries.SQL | variant_queries.SQL | review_queries.SQL | stream_queries.SQL | index_queries.SQL | coverage_queries.SQL | report_queries.SQL
