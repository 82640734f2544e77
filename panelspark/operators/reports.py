"""Reports as rows of text, records out of nested answers, texts judged, and what is to be processed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import CONNECTORS, escaped_latex, mojibake_repaired, norm_light
from panelspark.operators.batches import numbered

#: What a readable law section shows, and the amounts that make a table of ranges; fixed values.
TITLE = r"(?iu)LEY[\s\w]{0,30}INGRESOS[\s\w]{0,80}MUNICIPIO[\s\w]{0,30}DE\s+\w+"
ARTICLE = r"(?iu)ART[IÍ]CULO\s+\d+[°ºo]?\.?\s*[\s\S]{0,200}?(?:el\s+)?impuesto\s+predial"
AMOUNT = r"\$\s?\d{1,3}(?:[,.]?\d{3})*(?:\.\d{2})?"
TABLE_AMOUNTS, SHORT_TEXT = 5, 5000


def report_lines(df: DataFrame, order: list[str], style: str = "markdown") -> DataFrame:
    """A table of any length as the lines of a report: line (from 0), text. style: markdown or latex. The order must tell rows apart.

    Rows become lines where they are; only their numbers come from counts of range partitions, so no task holds the report.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    if style == "markdown":
        row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")) for c in cells]), F.lit(" |"))
        head, tail = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)], []
    elif style == "latex":
        row = F.concat(F.concat_ws(" & ", *[escaped_latex(c) for c in cells]), F.lit(" \\\\"))
        head, tail = ["\\begin{tabular}{" + "l" * len(df.columns) + "}", " & ".join(c.replace("_", "\\_") for c in df.columns) + " \\\\", "\\hline"], ["\\end{tabular}"]
    else:
        raise ValueError(f"no style {style}: markdown or latex")
    lines = numbered(df.select(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], row.alias("text")), [f"_o{i}" for i in range(len(order))])
    out = lines.select((F.col("position") + len(head)).alias("line"), "text")
    spark = df.sparkSession
    out = out.unionByName(spark.createDataFrame(list(enumerate(head)), "line long, text string"))
    if tail:
        end = lines.agg((F.count("*") + len(head)).alias("line")).select("line", F.lit(tail[0]).alias("text"))
        out = out.unionByName(end)
    return out


def nested_records(answers: DataFrame, source: str, document: str, groups: str, record: str) -> DataFrame:
    """Records out of API answers with named groups of records: source, group, and the fields of ``record`` (a schema). Groups that are no lists give none."""
    parsed = answers.select(source, F.from_json(F.get_json_object(document, f"$.{groups}"), "map<string,string>").alias("_g"))
    each = parsed.select(source, F.explode("_g").alias("group", "_items"))
    return each.select(source, "group", F.explode(F.from_json("_items", f"array<struct<{record}>>")).alias("_r")).filter("_r IS NOT NULL").select(source, "group", "_r.*")


def deduplicated_records(records: DataFrame, identity: str, natural: list[str], rank: list[Column]) -> DataFrame:
    """One record for each identity and, of these, for each natural key; the first by ``rank``, then by identity. Records without either are left out."""
    known = records.filter(F.col(identity).isNotNull())
    for c in natural:
        known = known.filter(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    rest = known.columns
    order = F.struct(*[r.alias(f"_{i}") for i, r in enumerate(rank)], F.col(identity).alias("_id"))
    once = known.groupBy(F.col(identity).alias("_k")).agg(F.min_by(F.struct(*rest), order).alias("_r")).select("_r.*")
    return once.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(natural)]).agg(F.min_by(F.struct(*rest), order).alias("_r")).select("_r.*")


def readable(text: Column) -> Column:
    """Struct title, article, table, amounts: what an extracted text of a law shows."""
    t = F.coalesce(text, F.lit(""))
    amounts = F.size(F.regexp_extract_all(t, F.lit(AMOUNT), F.lit(0)))
    return F.struct(t.rlike(TITLE).alias("title"), t.rlike(ARTICLE).alias("article"), (amounts >= TABLE_AMOUNTS).alias("table"), amounts.alias("amounts"))


def missed_section(text: Column, tax: str, rate: str, chapter: str) -> Column:
    """Why no section was found: no_predial_in_pdf, pattern_miss, low_quality_ocr or ambiguo. Lines that begin with # are the file's head, not text."""
    body = F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: ~F.startswith(line, F.lit("#"))), "\n")
    plain = norm_light(body)
    times = lambda c, p: F.size(F.regexp_extract_all(c, F.lit(p), F.lit(0)))
    return (
        F.when((times(plain, tax) == 0) & (times(plain, rate) == 0), "no_predial_in_pdf")
        .when((times(plain, tax) >= 2) & plain.rlike(chapter) & (times(body, AMOUNT) >= TABLE_AMOUNTS), "pattern_miss")
        .when((times(plain, tax) >= 1) & (F.length(body) < SHORT_TEXT), "low_quality_ocr")
        .otherwise("ambiguo")
    )


def tidy_name(raw: Column, state: str) -> Column:
    """A name out of a heading: repaired, without the state at its end and marks after it, words with a capital but for connectors inside.

    state: a pattern of the state's name, such as YUCAT[AÁ]N.
    """
    s = F.btrim(F.regexp_replace(F.btrim(mojibake_repaired(raw)), rf"(?iu)\s*,?\s*{state}\s*$", ""))
    words = F.split(F.initcap(F.lower(F.rtrim(s, F.lit(",. ")))), " ", -1)
    small = [c.capitalize() for c in CONNECTORS]
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*small), F.lower(w)).otherwise(w)), " ")


def selected(cases: DataFrame, key: str, pattern: str | None = None, pending: bool = False, reviewed: bool = False, explicit: DataFrame | None = None) -> DataFrame:
    """Cases to process again, each once: of a pattern, pending, reviewed, or named; with several selectors what all of them pick.

    cases: key, patterns (array), status, decision. explicit: a table with the key; names that no case has are left out.
    """
    out = cases
    if pattern is not None:
        out = out.filter(F.array_contains(F.coalesce("patterns", F.array().cast("array<string>")), pattern))
    if pending:
        out = out.filter(F.btrim(F.coalesce("decision", F.lit(""))) == "")
    if reviewed:
        out = out.filter((F.btrim(F.coalesce("decision", F.lit(""))) != "") & (F.coalesce("status", F.lit("")) != "closed"))
    if explicit is not None:
        out = out.join(explicit.select(key).distinct(), key, "left_semi")
    return out.dropDuplicates([key])
