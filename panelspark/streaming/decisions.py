"""A stream of decisions: the latest of each id in keyed state, and a table of them of which only touched parts are written anew.

The state store holds the last row of each id by (time, position), so rows may come late and in any order, and each batch of the
stream gives the ids that changed, with their whole rows. A table is cut into parts by a hash of the id. A batch writes
the parts that its ids fall into, under its own number, and then a note of which parts these are; the note makes it count. The
table is, for each part, what the highest noted number wrote. A batch that is repeated after a failure reads what was noted before it
and writes the same again; a stream that is started again goes on from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: Parts of a table of decisions.
PARTS = 64


def read_log(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet") -> DataFrame:
    """The log's files as a stream; a file is taken once."""
    return spark.readStream.format(kind).schema(schema).load(path)


def latest_stream(log: DataFrame, key: str, time: str, position: str) -> DataFrame:
    """A streaming aggregate: the last row of each id by time, then position. Rows without an id (null or empty) are left out."""
    rest = [c for c in log.columns if c != key]
    known = log.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return known.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time, position)).alias("_r")).select(key, "_r.*")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _notes(spark: SparkSession, target: str, before: int | None = None) -> dict[int, int]:
    """For each part the number of the batch that wrote it last. There are ``PARTS`` rows at most for each batch, of two numbers."""
    if not _exists(spark, f"{target}/notes"):
        return {}
    notes = spark.read.schema("part int, batch long").parquet(f"{target}/notes/*")
    if before is not None:
        notes = notes.filter(F.col("batch") < before)
    return {r.part: r.batch for r in notes.groupBy("part").agg(F.max("batch").alias("batch")).collect()}


def _read(spark: SparkSession, target: str, schema: StructType, parts: dict[int, int]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/rows/{batch}/part={part}" for part, batch in sorted(parts.items())])


def current(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The table as it is: one row for each id."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return _read(spark, target, kind, _notes(spark, target))


def keep_latest(log: DataFrame, target: str, checkpoint: str, key: str, time: str, position: str, parts: int = PARTS) -> StreamingQuery:
    """Takes what the log holds now into the table under ``target``, and stops; started again with the same checkpoint, it goes on from there."""
    schema = StructType([log.schema[key], *[f for f in log.schema if f.name != key]])

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        # what changed is written once, so that the state is not asked again for each use
        batch.select(*schema.names).write.mode("overwrite").parquet(f"{target}/changes/{number}")
        fresh = spark.read.schema(schema).parquet(f"{target}/changes/{number}")
        touched = {r.part for r in fresh.select(part.alias("part")).distinct().collect()}
        if not touched:
            return
        noted = _notes(spark, target, number)
        old = _read(spark, target, schema, {p: b for p, b in noted.items() if p in touched})
        rows = old.join(fresh.select(key), key, "left_anti").select(*schema.names).unionByName(fresh).withColumn("part", part)
        # a part is one task: it is written as one file
        rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{target}/rows/{number}")
        spark.createDataFrame([(p, number) for p in sorted(touched)], "part int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{target}/notes/{number}")

    return latest_stream(log, key, time, position).writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events of each kind in windows of time; later than ``late`` they are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
