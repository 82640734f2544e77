"""Helpers shared by the training-data operators: where to put cut lineage, and row keys."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    The setting of the session is used as it is. Only where it is unset in local mode, as in tests, a new folder is made and
    set; on a cluster that is an error, since no machine's own folder is shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that are read no more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task that gives memory back to the system when it ends; workers live on and serve the tasks of later stages."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Spark this package for its workers, once for each application; they need not find it in a folder of their own."""
    context = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(package):
        return
    _SHIPPED.add(context.applicationId)
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="panelspark-")), "panelspark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)


def checked(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns`` of ``df``; a clear error when one is missing. Extra columns, whatever their names, are left behind."""
    ship_package(df.sparkSession)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``_row``, and keys; so no name of a key can clash with a column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(k) for k, c in keys.items()])


INTEGERS = ("byte", "short", "integer", "long")


def by_numbers(rows: DataFrame, id_col: str, results: Callable[[DataFrame], DataFrame], *more: str) -> DataFrame:
    """``results`` of rows whose ids are whole numbers. Ids of another type are numbered in their order, and numbers in id_col and ``more`` named again."""
    if rows.schema[id_col].dataType.typeName() in INTEGERS:
        return results(rows)
    from panelspark.operators.batches import numbered

    names = stored(numbered(rows.select(F.col(f"`{id_col}`").alias("_name")).filter("_name IS NOT NULL").distinct(), ["_name"], "_number"), "names")
    known = names.select("_name", "_number")
    inside = rows.withColumnRenamed(id_col, "_name").join(known, "_name", "left").drop("_name").withColumnRenamed("_number", id_col)
    out = results(inside)
    for c in (id_col, *more):
        named = known.withColumnRenamed("_number", c).withColumnRenamed("_name", f"_named_{c}")
        columns = out.columns
        out = out.join(named, c, "left").select(*[F.col(f"_named_{c}").alias(c) if x == c else F.col(f"`{x}`") for x in columns])
    return out


def hash_share(h: Column, wanted: int, rows: int) -> Column:
    """Whether a 64-bit hash is among about ``wanted`` of ``rows``: under a bound, so nothing is sorted or gathered to draw them."""
    if rows <= wanted:
        return F.lit(True)
    return h < F.lit(int(-(2**63) + 2**64 * wanted // rows))
