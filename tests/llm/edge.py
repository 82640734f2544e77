"""Small documents with everything that may go wrong, for all tests of this folder."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wort{i % 977} zeile{i % 31}" for i in range(60_000))
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta.\nShared line\n\n  shared LINE \nlast", "en", "a", 1),
    (2, "alpha beta gamma delta epsilon zeta eta\nShared line", "en", "a", 2),
    (3, None, "en", "b", None),
    (4, "", None, "b", 0),
    (5, "one", "en", None, 3),
    (6, "one", "en", None, 3),
    (7, "   \n\t ", "de", "b", 5),
    (8, "Ünïcode ß 文字 😀 word word word\r\nShared line", "de", "c", 9),
    (8, "Ünïcode ß 文字 😀 word word word\r\nShared line", "de", "c", 9),
    (9, LONG, "de", "c", len(LONG)),
    (10, LONG + " tail", "de", "c", len(LONG) + 5),
    (None, "no id here but some words to read", "en", "c", 7),
    (None, None, None, None, None),
    (11, "tie", "en", "a", 3),
    (11, "tie but another text", "en", "a", 3),
    (12, "<|endoftext|> special <|startoftext|>x  y  z", "en", "a", 3),
]
CLASH = ["_doc", "_text", "n_lines", "size", "taken", "component", "score", "bucket", "rep", "bitmap", "hub", "set", "id", "key"]


def docs(spark, clash=True):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASH}) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
