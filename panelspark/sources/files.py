"""Readers and writers: CSV with a fixed schema, JSON documents by file, layouts, overlays, quarantine, write-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark.operators.panel import keep_first


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",") -> DataFrame:
    """Header, no inference (all columns are strings without a schema); a byte-order mark goes; bad bytes become U+FFFD."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    df = (r.schema(schema) if schema is not None else r).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def delimiter_of(spark: SparkSession, path: str) -> str:
    """Tab if the first line holds more tabs than commas, else comma."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0].value if head else ""
    return "\t" if line.count("\t") > line.count(",") else ","


def write_csv(df: DataFrame, path: str, columns: list[str], mode: str = "error") -> None:
    """The given columns in order, others left out, null as an empty cell."""
    out = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*out).write.mode(mode).option("header", True).option("emptyValue", "").csv(path)


def read_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON document for each file, in any depth of folders; unreadable ones keep their text in _corrupt. Adds file_path and file_name."""
    s = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if "_corrupt" not in s.fieldNames():
        s = s.add("_corrupt", "string")
    df = spark.read.schema(s).option("multiLine", True).option("recursiveFileLookup", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.withColumns({"file_path": F.col("_metadata.file_path"), "file_name": F.col("_metadata.file_name")})


def name_parts(file_name: Column) -> Column:
    """PREFIX_PREDIAL_year_slug.ext as a struct prefix, year, slug; nulls where the name has another form."""
    p = "^([A-Z]+)_PREDIAL_(\\d{4})_(.+)\\.[A-Za-z0-9]+$"
    get = lambda i: F.nullif(F.regexp_extract(file_name, p, i), F.lit(""))
    return F.struct(get(1).alias("prefix"), get(2).cast("int").alias("year"), get(3).alias("slug"))


def overlay(corrected: DataFrame, canonical: DataFrame, key: str) -> DataFrame:
    """Rows of the corrected copy where it has the key, else the canonical ones."""
    rest = canonical.join(corrected.select(key), key, "left_anti")
    return corrected.unionByName(rest, allowMissingColumns=True)


def by_layout(df: DataFrame, layouts: dict[str, dict[str, str]]) -> DataFrame:
    """Renames the columns of the first layout whose source columns are all there; columns of no layout become null strings."""
    targets = list(dict.fromkeys(t for m in layouts.values() for t in m))
    for mapping in layouts.values():
        if set(mapping.values()) <= set(df.columns):
            return df.select(*[F.col(f"`{mapping[t]}`").cast("string").alias(t) if t in mapping else F.lit(None).cast("string").alias(t) for t in targets])
    raise ValueError(f"no layout fits the columns {df.columns}")


def write_if_absent(df: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> None:
    """Appends the rows whose key the target doesn't have yet."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        df = df.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def quarantine(df: DataFrame, bad: Column, kept_path: str, bad_path: str) -> None:
    """Two outputs; nothing is deleted."""
    flag = F.coalesce(bad, F.lit(False))
    df.filter(~flag).write.parquet(kept_path)
    df.filter(flag).write.parquet(bad_path)


def static_source(entities: DataFrame, brackets: DataFrame, years: tuple[int, int]) -> DataFrame:
    """A uniform tariff for every entity and year: a few brackets, so they are broadcast."""
    rows = brackets.agg(F.array_sort(F.collect_list(F.struct(*brackets.columns))).alias("rows"))
    return entities.crossJoin(F.broadcast(rows)).withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))


def latest_version(df: DataFrame, keys: list[str], priority: Column, path: str) -> DataFrame:
    """The best version of each document: least priority, then least path."""
    return keep_first(df, keys, [priority, F.col(path)])


def response_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Batch responses: state, slug, year from a custom id of three parts, and a route (ok, or the reason for the fallback)."""
    schema = "custom_id string, error string, response struct<status_code:int, body:string>"
    x = lines.select(F.from_json(column, schema).alias("r"))
    parts = F.split("r.custom_id", "\\|")
    route = F.when(F.col("r.custom_id").isNull(), "bad_json").when(F.size(parts) != 3, "bad_id").when(F.col("r.error").isNotNull(), "error").when(F.col("r.response.status_code") != 200, "status").otherwise("ok")
    return x.select(F.get(parts, F.lit(0)).alias("state"), F.get(parts, F.lit(1)).alias("slug"), F.get(parts, F.lit(2)).try_cast("int").alias("year"), route.alias("route"), F.col("r.response.body").alias("body"))


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.encode(F.lit("%PDF"), "UTF-8")


def scanned_documents(pages: DataFrame, document: str, text: str, least: int = 100) -> DataFrame:
    """Mean characters of a document's pages, and whether they are too few for a text document."""
    return pages.groupBy(document).agg(F.avg(F.length(F.coalesce(F.col(text), F.lit("")))).alias("mean_chars")).withColumn("scanned", F.col("mean_chars") < least)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``; one of our own only where it is unset in local mode)."""
    import tempfile
    import uuid

    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to a new path of the shared folder and read back: cuts lineage, and a lost executor costs nothing that is written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_documents(df: DataFrame, path: str, state: str, year: str) -> None:
    """JSON documents by state and year; pruning by folder needs no index."""
    df.write.partitionBy(state, year).json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Rows are only added; the writer's commit protocol shows a batch whole or not at all."""
    df.write.mode("append").parquet(path)


def markdown_table(df: DataFrame, most: int = 200) -> str:
    """A small result as a Markdown table; ``most`` rows, since it is a report."""
    rows = df.limit(most).collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return "\n".join([head, *["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]])


def latex_table(df: DataFrame, most: int = 200) -> str:
    """A small result as a LaTeX tabular."""
    from panelspark.functions.text import escaped_latex

    shown = df.select(*[escaped_latex(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(c) for c in df.columns]).limit(most).collect()
    body = " \\\\\n".join(" & ".join(r) for r in shown)
    return "\\begin{tabular}{" + "l" * len(df.columns) + "}\n" + " & ".join(df.columns) + " \\\\\n\\hline\n" + body + " \\\\\n\\end{tabular}"
