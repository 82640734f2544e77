"""Queries on the decision log as a stream, and on batches over one stream of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.operators import batches
from panelspark.plans.tables import table
from panelspark.sources import files
from panelspark.streaming import decisions

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def decision_stream(spark: SparkSession, sf: str) -> DataFrame:
    """STM01, STM02: a log that comes in several files and out of order, taken by a stream that stops and starts again; the latest row of each id."""
    log, target, checkpoint = (files.scratch_path(spark, name) for name in ("log", "decisions", "stream"))
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    for third in (1, 2, 0):  # rows of the last file are earlier than many of the first
        files.append_log(rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == third), log)
        decisions.keep_latest(decisions.read_log(spark, log, rows.schema), target, checkpoint, "user_id", "ts", "event_id").awaitTermination()
    return decisions.current(spark, target, rows.schema)


@query(r"""
WITH RECURSIVE s AS (SELECT conv_id, turn, length(coalesce(text, '')) // 4 + 20 AS size, row_number() OVER (ORDER BY conv_id, turn) AS i FROM conversations),
b AS (
  SELECT i, size, 0::BIGINT AS batch, size::BIGINT AS used, 1 AS n FROM s WHERE i = 1
  UNION ALL SELECT s.i, s.size, b.batch + (b.used + s.size > 4000 OR b.n >= 25)::INT, CASE WHEN b.used + s.size > 4000 OR b.n >= 25 THEN s.size ELSE b.used + s.size END, CASE WHEN b.used + s.size > 4000 OR b.n >= 25 THEN 1 ELSE b.n + 1 END
  FROM b JOIN s ON s.i = b.i + 1
) SELECT conv_id, turn, s.size::BIGINT AS size, batch FROM s JOIN b USING (i)
""")
def request_batches(spark: SparkSession, sf: str) -> DataFrame:
    """SRC11: all requests as one stream, a batch closed when the next request would pass its tokens or its number."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", (text.token_estimate(F.coalesce(F.col("text"), F.lit(""))) + 20).cast("long").alias("size"))
    return batches.batched(c, ["conv_id", "turn"], "size", 4000, 25)
