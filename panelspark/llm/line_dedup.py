"""Line dedup: which lines of which documents go, as compressed keep bitmaps. DataFrame functions only.

Method. Each line becomes a 128-bit hash of its key. Hashes are range-partitioned together with a salt of
the document and sorted within a partition by document and position, so that one pass over each partition
streams the first occurrence and the number of documents of a hash. The salt splits a line that a third of
all documents hold over all partitions; what each salt found is a row at most, and those rows are summed
for each hash. Texts never travel with the hashes: the result is a compressed bitmap for each document that
loses lines.

Defined results
* null or empty text: one empty line, which has no key and stays.
* rows with the same doc_id count as one document; rows with the same doc_id and text share a bitmap, and
  each of them is returned. A null doc_id is a document of its own, so equal rows without an id count as often as they stand
  there; with ``keep_first_lines`` they share a bitmap too.
* a very long text is a row like others: its lines are an array in one row, and its bitmap holds only the turns.
* an empty table gives an empty table; other columns of the input are left out of bitmaps and kept by ``apply_bitmaps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checked, lower_ascii, packed, stored

SPACE = " \t\n\x0b\f\r"
#: Salts of a document. A line held by every document is dealt to as many groups.
SALTS = 4096


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _row_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds what identifies a row: its id, and a 64-bit hash of its text."""
    return df.withColumn("_doc", F.col(f"`{id_col}`")).withColumn("_text", F.xxhash64(f"`{text_col}`"))


def bitmap_of(dropped: Column) -> Column:
    """A compressed bitmap of sorted positions: the lines at which keeping turns to dropping and back, as 4-byte numbers."""
    start = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    end = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    turns = F.flatten(F.zip_with(start, end, lambda a, b: F.array(a, b + 1)))
    return F.unhex(F.array_join(F.transform(turns, lambda x: F.lpad(F.hex(x.cast("long")), 8, "0")), ""))


def turns_of(bitmap: Column) -> Column:
    """The turns of a bitmap as numbers: dropped from the first to before the second, kept to before the third, and so on."""
    n = (F.length(bitmap) / 4).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.hex(F.substring(bitmap, i * 4 + 1, F.lit(4))), 16, 10).cast("int"))


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int | None = None, min_length: int = 1) -> DataFrame:
    """Bitmaps of the documents that lose lines: _doc, _text, n_lines, n_dropped, bitmap.

    min_docs: None keeps the first occurrence of a key, by document and position, and drops the others. A number
    drops every line whose key is found in so many documents. min_length: shorter keys are never dropped.
    """
    rows = checked(docs, id_col, text_col)
    nameless = F.col(f"`{id_col}`").isNull()
    # rows without an id are documents of their own: each text once, with the number of its rows
    copies = rows.filter(nameless).groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias("_copies"))
    base = _row_keys(rows.filter(~nameless).withColumn("_copies", F.lit(1).cast("long")).unionByName(copies), id_col, text_col)
    base = base.withColumn("_own", F.when(F.col("_doc").isNull(), F.col("_text")).otherwise(F.lit(0))).withColumn("_lines", lines_of(F.col(f"`{text_col}`")))
    keys = (
        base.select("_doc", "_own", "_text", "_copies", F.size("_lines").alias("_n"), F.posexplode("_lines").alias("_pos", "_line"))
        .withColumn("_key", line_key(F.col("_line")))
        .filter(F.length("_key") >= max(min_length, 1))
        .select("_doc", "_own", "_text", "_copies", "_n", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("second"), "_key").alias("_h2"))
        .withColumn("_salt", F.pmod(F.xxhash64("_doc", "_own"), F.lit(SALTS)).cast("int"))
    )
    # hashes, not texts, are stored: sampling the ranges, streaming them and marking lines would read and hash the texts three times
    keys = stored(keys, "line-keys")
    group = Window.partitionBy("_h1", "_h2", "_salt").orderBy(F.col("_doc").asc_nulls_first(), "_own", "_pos", "_text")
    streamed = keys.repartitionByRange("_h1", "_h2", "_salt").withColumn("_seen", F.row_number().over(group))
    if min_docs is None:
        # a salt holds all rows of a document, so the first of a key is the least of the firsts of its salts
        first = streamed.filter("_seen = 1").groupBy("_h1", "_h2").agg(F.min(F.struct("_doc", "_own", "_pos", "_text")).alias("_first"), F.sum(F.lit(1)).alias("_salts"), F.collect_list("_salt").alias("_all"))
        marks = first.select("_h1", "_h2", "_first", F.explode("_all").alias("_salt"))
        gone = keys.join(marks, ["_h1", "_h2", "_salt"]).filter(~F.struct("_doc", "_own", "_pos", "_text").eqNullSafe(F.col("_first")))
    else:
        new_doc = (F.col("_seen") == 1) | ~F.struct("_doc", "_own").eqNullSafe(F.lag(F.struct("_doc", "_own")).over(group))
        per_salt = streamed.withColumn("_new", F.when(new_doc, F.col("_copies")).otherwise(0)).groupBy("_h1", "_h2", "_salt").agg(F.sum("_new").alias("_docs"))
        often = per_salt.groupBy("_h1", "_h2").agg(F.sum("_docs").alias("_docs"), F.collect_list("_salt").alias("_all")).filter(F.col("_docs") >= min_docs)
        gone = keys.join(often.select("_h1", "_h2", F.explode("_all").alias("_salt")), ["_h1", "_h2", "_salt"])
    dropped = gone.groupBy("_doc", "_text").agg(F.first("_n").alias("n_lines"), F.sort_array(F.collect_set("_pos")).alias("_dropped"))
    return dropped.select("_doc", "_text", "n_lines", F.size("_dropped").alias("n_dropped"), bitmap_of(F.col("_dropped")).alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, and n_lines, n_dropped. Rows without a bitmap keep all lines."""
    left = packed(docs, _doc=F.col(f"`{id_col}`"), _text=F.xxhash64(f"`{text_col}`"))
    right = bitmaps.select(F.col("_doc").alias("_doc2"), F.col("_text").alias("_text2"), F.col("n_dropped").alias("_dropped"), "bitmap")
    both = left.join(right, F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_text") == F.col("_text2")), "left")
    text = F.col(f"_row.`{text_col}`")
    # kept lines stand before the first turn, between the second and third, and so on, and after the last
    ends = F.concat(F.array(F.lit(0)), F.col("_turns"), F.array(F.size("_l")))
    starts, stops = F.filter(ends, lambda x, i: i % 2 == 0), F.filter(ends, lambda x, i: i % 2 == 1)
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(F.col("_l"), a + 1, b - a)))
    new = {
        text_col: F.when(F.col("bitmap").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.size("_l").cast("long"),
        "n_dropped": F.coalesce(F.col("_dropped"), F.lit(0)).cast("long"),
    }
    old = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in new]
    done = both.withColumns({"_l": lines_of(text), "_turns": turns_of(F.col("bitmap"))}).select("_row", *[c.alias(f"_new{i}") for i, c in enumerate(new.values())])
    return done.select(*old, *[F.col(f"_new{i}").alias(k) for i, k in enumerate(new)])


def drop_common_lines(docs: DataFrame, min_docs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the lines whose key at least ``min_docs`` documents hold."""
    return apply_bitmaps(docs, line_keep_bitmaps(docs, id_col, text_col, min_docs), id_col, text_col)


def keep_first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 1) -> DataFrame:
    """Documents with the first occurrence of each line only."""
    return apply_bitmaps(docs, line_keep_bitmaps(docs, id_col, text_col, None, min_length), id_col, text_col)
