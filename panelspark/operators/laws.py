"""Laws, spans, page sections and blocks found in texts: windows over lines, and Column expressions over whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import text as texts


@dataclass(frozen=True)
class LawPatterns:
    """A title with the name as group 1 and a year, which may be missing, as group 2; what must follow it and what may not stand before."""

    title: str
    year: str
    needed: str
    refused: str
    window: int = 3
    year_ahead: int = 120
    needed_ahead: int = 160
    look_back: int = 60
    apart: int = 25


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def laws(all_lines: DataFrame, key: str, p: LawPatterns) -> DataFrame:
    """Titles of laws over lines (key, line_no, line): key, line_no, name, year.

    A title may run over ``window`` lines. Its year is its own or the first within ``year_ahead`` lines. ``needed`` must begin
    within ``needed_ahead`` lines, ``refused`` not within ``look_back`` lines before; each may run into a second line. A name and
    year seen before count again only ``apart`` or more lines after the last law taken.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    ahead = lambda n: w.rowsBetween(0, n - 1)
    some = lambda flag, over: F.coalesce(F.max(flag).over(over), F.lit(False))
    joined = F.concat_ws(" ", *[F.nullif(_stripped(F.lead("line", i).over(w) if i else F.col("line")), F.lit("")) for i in range(p.window)])
    x = all_lines.select(key, "line_no", "line", joined.alias("_t"), F.lead("line").over(w).alias("_next"))
    two = F.concat_ws("\n", "line", "_next")

    def held(pattern: str) -> tuple[Column, Column]:
        """Whether a line holds the pattern, and whether only the line with its next does."""
        alone = F.col("line").rlike(pattern)
        return alone, ~alone & two.rlike(pattern) & ~F.coalesce(F.col("_next").rlike(pattern), F.lit(False))

    n1, n2 = held(p.needed)
    r1, r2 = held(p.refused)
    y1, y2 = held(p.year)
    x = x.withColumns({"_n1": n1, "_n2": n2, "_r1": r1, "_r2": r2, "_y1": F.when(y1, F.regexp_extract("line", p.year, 1)), "_y2": F.when(y2, F.regexp_extract(two, p.year, 1))})
    near = F.first(F.coalesce("_y1", "_y2"), ignorenulls=True).over(ahead(p.year_ahead - 1))
    year = F.coalesce(near, F.first("_y1", ignorenulls=True).over(ahead(p.year_ahead)), F.lit(""))
    needed = some(F.col("_n1"), ahead(p.needed_ahead)) | some(F.col("_n2"), ahead(p.needed_ahead - 1))
    refused = some(F.col("_r1"), w.rowsBetween(-p.look_back, 0)) | some(F.col("_r2"), w.rowsBetween(-p.look_back, -1))
    x = x.withColumns({"_year": year, "_ok": needed & ~refused}).filter(F.col("_ok") & F.col("_t").rlike(p.title))
    own = F.nullif(F.regexp_extract("_t", p.title, 2), F.lit(""))
    x = x.select(key, "line_no", texts.collapse_space(F.regexp_extract("_t", p.title, 1)).alias("name"), F.coalesce(own, "_year").alias("year"))
    again = F.row_number().over(Window.partitionBy(key, texts.slugify(F.col("name")), "year").orderBy("line_no")) > 1
    first = F.row_number().over(Window.partitionBy(key).orderBy("line_no")) == 1
    x = x.withColumn("_again", again).withColumn("_first", first)
    return _taken_apart(x.sortWithinPartitions(key, "line_no"), p.apart).select(key, "line_no", "name", "year")


def _taken_apart(candidates: DataFrame, apart: int) -> DataFrame:
    """Candidates in order of lines, without those seen before that stand too near to the last one taken.

    What is taken depends on what was taken before, so rows stream in order through tasks that hold the last one only.
    """

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0
        for batch in batches:
            keep = []
            for line, first, again in zip(batch["line_no"], batch["_first"], batch["_again"]):
                fresh = bool(first) or not again or line - last >= apart
                keep.append(fresh)
                last = line if fresh else last
            yield batch[keep]

    return candidates.mapInPandas(take, candidates.schema)


def law_span(text: Column, name: Column, strict: str, lax: str, word: str = "\\w+") -> Column:
    """Struct start, end (characters from 0) of the law of a name, or null.

    ``strict`` and ``lax`` are what stands before a name. The law starts at its strict header, else at its first lax header
    from the first strict header of any name on: what comes before is the summary. It ends at the next strict header, else
    at the next lax one, else with the text.
    """
    name = texts.collapse_space(name)
    quoted = F.concat(F.lit("\\Q"), F.replace(name, F.lit(" "), F.lit("\\E\\s+\\Q")), F.lit("\\E"))
    mine = lambda before: F.concat(F.lit(before), quoted)
    at = lambda t, pattern: F.nullif(F.regexp_instr(t, pattern), F.lit(0))
    body = F.coalesce(at(text, F.lit(strict + word)), F.lit(1))
    by_strict = at(text, mine(strict))
    by_lax = at(F.substring(text, body, F.length(text)), mine(lax)) + body - 1
    start = F.coalesce(by_strict, by_lax)
    header = F.when(by_strict.isNotNull(), F.regexp_substr(text, mine(strict))).otherwise(F.regexp_substr(F.substring(text, body, F.length(text)), mine(lax)))
    tail_at = start + F.length(header)
    tail = F.substring(text, tail_at, F.length(text))
    following = F.coalesce(at(tail, F.lit(strict + word)), at(tail, F.lit(lax + word)))
    end = F.coalesce(tail_at + following - 2, F.length(text))
    return F.when((name != "") & start.isNotNull(), F.struct((start - 1).cast("int").alias("start"), end.cast("int").alias("end")))


@dataclass(frozen=True)
class PagePatterns:
    """Headers of a section in full or short form, what must stand near them, pages ruled out, and headers of what follows."""

    full: str
    short: str
    section: str
    chapter: str
    matter: str
    parent: str
    article: str
    ruled_out: str
    following: str
    following_start: str
    short_most: int = 30
    following_most: int = 120
    context: int = 5
    top: int = 8
    forced: int = 4


def page_sections(page_lines: DataFrame, key: str, p: PagePatterns) -> DataFrame:
    """The pages of a section from lines (key, page, line_no, line; pages from 0): key, pages, first, last, next, forced, expanded, confidence.

    The first page counts that isn't ruled out by its top lines, has an article on it or on the next page, and a header with a
    section line among the ``context`` lines before it; a full header will do with the parent's name on the page, or a chapter
    and the matter. The section ends before the page of the next header; without one it takes ``forced`` more pages.
    A key without such a page has nulls.
    """
    sizes = page_lines.groupBy(key).agg((F.max("page") + 1).alias("pages"))
    x = page_lines.select(key, "page", "line_no", texts.collapse_space(F.lower("line")).alias("line")).filter("line <> ''")
    w = Window.partitionBy(key, "page").orderBy("line_no")
    line, before = F.col("line"), F.lag("line").over(w)
    near = F.coalesce(F.max(line.rlike(p.section)).over(w.rowsBetween(-p.context, -1)), F.lit(False))
    framed = F.coalesce(before.rlike(p.chapter) | before.rlike(p.section), F.lit(False))
    x = x.withColumns({
        "full": line.rlike(p.full),
        "short": line.rlike(p.short) & (F.length(line) <= p.short_most) & ~line.rlike(p.full),
        "near": near,
        "next": line.rlike(p.following) & (F.length(line) <= p.following_most) & (line.rlike(p.following_start) | framed),
        "top": F.row_number().over(w) <= p.top,
    })
    has = lambda c: F.max(c)
    pages = x.groupBy(key, "page").agg(
        has((F.col("full") | F.col("short")) & F.col("near")).alias("strong"),
        has(F.col("full")).alias("full"),
        has(line.rlike(p.parent)).alias("parent"),
        has(line.rlike(p.chapter)).alias("chapter"),
        has(line.rlike(p.matter)).alias("matter"),
        has(line.rlike(p.article)).alias("article"),
        has(line.rlike(p.ruled_out) & F.col("top")).alias("out"),
        has("next").alias("next"),
    )
    by_page = Window.partitionBy(key).orderBy("page")
    article_next = F.coalesce((F.lead("page").over(by_page) == F.col("page") + 1) & F.lead("article").over(by_page), F.lit(False))
    core = ~F.col("out") & (F.col("strong") | F.col("full") & (F.col("parent") | F.col("chapter") & F.col("matter"))) & (F.col("article") | article_next)
    marked = pages.withColumn("core", core)
    marked = marked.withColumn("first", F.min(F.when(F.col("core"), F.col("page"))).over(Window.partitionBy(key)))
    found = marked.groupBy(key).agg(F.first("first").alias("first"), F.min(F.when(F.col("next") & (F.col("page") > F.col("first")), F.col("page"))).alias("next"))
    x = sizes.join(found, key, "left")
    last = F.when(F.col("next").isNotNull(), F.col("next") - 1).when(F.col("first").isNotNull(), F.least(F.col("pages") - 1, F.col("first") + p.forced))
    forced = F.when(F.col("first").isNotNull(), F.col("next").isNull())
    return x.select(
        key, "pages", "first", last.alias("last"), "next", forced.alias("forced"),
        (forced | (last - F.col("first") + 1 <= 2)).alias("expanded"),
        F.when(forced.isNull(), 0.0).when(forced, 0.3).otherwise(1.0).alias("confidence"),
    )


#: Fields of a case and of a pattern in the review book; fixed values.
CASE_FIELDS = ("veredicto", "tipo_correcto", "causa_raiz", "patron", "notas", "accion")
PATTERN_FIELDS = ("diagnostico", "fix_propuesto", "prioridad", "estado", "casos")
#: Misspellings in verdicts and causes; fixed values.
VERDICT_FIXES = {"invalid": "invalido", "inválido": "invalido", "incorrect": "incorrecto", "incorrecto.": "incorrecto", "correct": "correcto"}
CAUSE_FIXES = {"segment": "segmentacion", "segmetacion": "segmentacion", "segmentación": "segmentacion", "api_eror": "api_error", "api error": "api_error"}



def _fixed(c: Column, fixes: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in fixes.items() for x in pair]), c), c)


_CASE = "`([a-z_]+)/([a-z0-9_]+)/(\\d{4})`\\s*\\(cvegeo\\s+(\\d+)\\)"


def book_cases(df: DataFrame, key: str, text: str) -> DataFrame:
    """Cases of review books in Markdown, one row for each block under "### `state/slug/year` (cvegeo n)"; a field left open is empty."""
    block = F.col("_b")
    blocks = df.select(key, F.posexplode(F.split(F.col(text), "\n###\\s+", -1)).alias("n", "_b")).filter("n > 0").filter(block.startswith("`") & block.rlike(_CASE))
    field = lambda f: _stripped(F.regexp_extract(block, f"-[^\\S\\n]*{f}:[^\\S\\n]*([^\\n]*)", 1))
    return blocks.select(
        key, "n",
        F.regexp_extract(block, _CASE, 1).alias("estado"),
        F.regexp_extract(block, _CASE, 2).alias("slug"),
        F.regexp_extract(block, _CASE, 3).cast("int").alias("anio"),
        F.regexp_extract(block, _CASE, 4).alias("cvegeo"),
        F.regexp_extract(block, "\\*\\*JSON\\*\\*:\\s*\\[`([^`]+)`\\]", 1).alias("json_rel"),
        F.regexp_extract(block, "\\*\\*tipo actual\\*\\*[^:]*:\\s*`([^`]+)`", 1).alias("tipo_actual"),
        block.rlike("-\\s*\\[\\s*[xX]\\s*\\]\\s*revisado").alias("revisado"),
        _fixed(F.rtrim(F.lower(field("veredicto")), F.lit(".")), VERDICT_FIXES).alias("veredicto"),
        F.lower(field("tipo_correcto")).alias("tipo_correcto"),
        _fixed(F.trim(F.split_part(F.lower(field("causa_raiz")), F.lit(","), F.lit(1))), CAUSE_FIXES).alias("causa_raiz"),
        F.upper(F.regexp_extract(field("patron"), "(?i)P-\\d{2}", 0)).alias("patron"),
        *[field(f).alias(f) for f in ("notas", "accion")],
    )


def book_patterns(df: DataFrame, key: str, text: str) -> DataFrame:
    """Patterns of review books, one row for each "### P-nn" under "## Patrones detectados" up to the next heading of that level."""
    section = F.regexp_extract(F.col(text), "##\\s+Patrones detectados\\s*\\n([\\s\\S]*?)(?=\\n##\\s+[^#]|\\z)", 1)
    block = F.col("_b")
    blocks = df.select(key, F.explode(F.split(F.concat(F.lit("\n"), section), "\n###\\s+", -1)).alias("_b")).filter(block.rlike("^P-\\d{2}"))
    field = lambda f: _stripped(F.regexp_extract(block, f"-[^\\S\\n]*\\*\\*{f}\\*\\*:[^\\S\\n]*([^\\n]*)", 1))
    return blocks.select(key, F.substring(block, 1, 4).alias("patron"), *[field(f).alias(f) for f in PATTERN_FIELDS])


def tariff_section(text: Column, start: str, end: str, least: int = 50, most: int = 8000, gap: int = 20) -> Column:
    """From the first ``start`` to the next ``end`` (``gap`` or more characters on), else at most ``most`` characters; shorter than ``least``: null."""
    at = F.regexp_instr(text, F.lit(start))
    tail_at = at + gap
    tail = F.regexp_instr(F.substring(text, tail_at, F.length(text)), F.lit(end))
    found = _stripped(F.substring(text, at, F.when(tail > 0, F.lit(gap) + tail - 1).otherwise(F.lit(most))))
    return F.when((at > 0) & (F.length(found) >= least), found)


def with_fallback(first: Column, second: Column, numbers: list[str]) -> Column:
    """The first section if it holds all kinds of numbers, else the second if it is longer."""
    whole = F.lit(True)
    for p in numbers:
        whole = whole & first.rlike(p)
    longer = F.length(second) > F.coalesce(F.length(first), F.lit(0))
    return F.when(first.isNotNull() & whole, first).when(F.coalesce(longer, F.lit(False)), second).otherwise(first)


def index_hits(df: DataFrame, key: str, text: str, header: str, hit: str, year: str, tail: int = 250) -> DataFrame:
    """Hits of an index: key, block, header, hit, year. ``header`` and ``hit`` have what they name as group 1.

    A block runs from a header to the next; the year of a hit (group 1 of ``year``) is looked for in the ``tail`` characters after it.
    """
    t = F.col(text)
    blocks = F.arrays_zip(F.regexp_extract_all(t, F.lit(header), F.lit(1)).alias("header"), F.slice(F.split(t, header, -1), 2, F.length(t) + 1).alias("body"))
    x = df.select(key, F.posexplode(blocks).alias("block", "_b")).select(key, "block", "_b.header", F.col("_b.body").alias("_body"))
    ahead = F.lit(f"(?:{hit})(?=([\\s\\S]{{0,{tail}}}))")
    hits = F.arrays_zip(F.regexp_extract_all("_body", ahead, F.lit(1)).alias("hit"), F.regexp_extract_all("_body", ahead, F.lit(2)).alias("tail"))
    return x.select(key, "block", "header", F.explode(hits).alias("_h")).select(key, "block", "header", _stripped(F.col("_h.hit")).alias("hit"), F.regexp_extract("_h.tail", year, 1).alias("year"))
