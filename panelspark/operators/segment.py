"""Finding a section of a text by patterns, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


@dataclass(frozen=True)
class SectionPatterns:
    """Start patterns in order of priority, end patterns, and what may not stand before a start."""

    starts: list[tuple[str, str, float]]
    ends: list[str]
    blacklist: str | None = None
    look_back: int = 800
    least: int = 50
    most: int = 20_000
    signals: list[str] = field(default_factory=list)
    #: Whether ``most`` holds for sections with an end too, and whether a refused start ends its pattern.
    capped: bool = False
    first_only: bool = False
    #: Hooks: whether the text before a start will do, and whether a section will do; a refused start leaves the next match its turn, then the next pattern.
    context_ok: Callable[[Column], Column] | None = None
    section_ok: Callable[[Column], Column] | None = None


def match_sizes(text: Column, pattern: str | Column) -> Column:
    """For each match of a pattern: gap (characters between the match before and this one) and size."""
    matches = F.regexp_extract_all(text, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    # an empty match at the very start splits nothing off
    pieces = F.when(F.size(pieces) == F.size(matches), F.concat(F.array(F.lit("")), pieces)).otherwise(pieces)
    both = F.zip_with(pieces, matches, lambda a, m: F.struct(F.length(a).alias("gap"), F.length(m).alias("size")))
    return F.filter(both, lambda x: x["size"].isNotNull())


def place_of(text: Column, pattern: str | Column) -> Column:
    """Where a pattern first matches, in characters from 1; 0 without a match. ``regexp_instr`` counts characters outside the basic plane twice."""
    p = pattern if isinstance(pattern, Column) else F.lit(pattern)
    at = F.regexp_instr(text, p)
    return F.when(at > 1, F.length(F.get(F.split(text, p, 2), F.lit(0))) + 1).otherwise(at)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _first_hit(text: Column, p: SectionPatterns, name: str, pattern: str, confidence: float) -> Column:
    """The section at the first match of a start pattern that holds, or null."""

    def section(at: Column, last: Column, closed: Column) -> Column:
        ok = p.section_ok(F.substring(text, at, last - at + 1)) if p.section_ok else F.lit(True)
        sure = F.when(closed, F.lit(confidence)).otherwise(F.lit(round(confidence * 0.8, 4)))
        return F.when(ok, F.struct(F.lit(True).alias("found"), F.lit(name).alias("method"), (at - 1).alias("start"), last.alias("end"), sure.alias("confidence")))

    def hit_at(at: Column) -> Column:
        before = F.substring(text, F.greatest(at - p.look_back, F.lit(1)), F.least(F.lit(p.look_back), at - 1))
        ok = F.lit(True)
        if p.blacklist:
            ok = ok & ~before.rlike(p.blacklist)
        if p.context_ok:
            ok = ok & p.context_ok(before)
        tail = F.substring(text, at + p.least, F.length(text))
        nearest = F.array_min(F.filter(F.array(*[place_of(tail, e) for e in p.ends]), lambda i: i > 0))
        most = F.least(at - 1 + p.most, F.length(text))
        last = lambda n: F.least(at - 1 + p.least + n - 1, most) if p.capped else F.coalesce(at - 1 + p.least + n - 1, most)
        return F.when(ok, _bound(nearest, lambda n: section(at, last(n), n.isNotNull())))

    def step(acc: Column, m: Column) -> Column:
        at = acc["next"] + m["gap"]
        return F.when(acc["hit"].isNotNull(), acc).otherwise(F.struct((at + m["size"]).alias("next"), hit_at(at).alias("hit")))

    state = F.struct(F.lit(1).alias("next"), F.lit(None).cast("struct<found:boolean,method:string,start:int,end:int,confidence:double>").alias("hit"))
    every = F.lit(None) if p.first_only else F.aggregate(match_sizes(text, pattern), state, step, lambda acc: acc["hit"])
    # most texts have their section at the first match; only where that is refused are all matches taken apart
    return _bound(place_of(text, pattern), lambda at: F.when(at > 0, F.coalesce(hit_at(at), every)))


def locate(text: Column, p: SectionPatterns) -> Column:
    """Struct found, method, start, end, confidence (characters from 0).

    Patterns are tried in order, and all matches of a pattern in theirs; the first that holds is the start. The nearest end
    ``least`` or more after it closes the section; ``most`` is its size only where there is no end, or the most of any if it is ``capped``.
    """
    none = F.struct(F.lit(False).alias("found"), F.lit("none").alias("method"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(0.0).alias("confidence"))
    return F.coalesce(*[_first_hit(text, p, name, pattern, confidence) for name, pattern, confidence in p.starts], none)


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each line: key, line number, character offset, line."""
    parts = F.split(F.col(text), "\n", -1)
    x = df.select(key, parts.alias("_l")).select(key, F.posexplode("_l").alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return x.withColumn("offset", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)))


def entities(df: DataFrame, key: str, text: str, patterns: list[tuple[str, str]], excluded: list[str], before: int) -> DataFrame:
    """Names that any of the patterns finds (as its group 1), each once for a key whatever its case: key, entity, pattern, ordinal.

    Patterns come in order of priority, and the first find of the first pattern stays. Where an excluded word stands whole
    among the ``before`` characters in front, a pattern doesn't match.
    """
    guard = "|".join(f"{re.escape(w)}[\\s\\S]{{0,{before - len(w)}}}" for w in excluded if len(w) <= before)
    guard = f"(?<!{guard})" if guard else ""
    # what stands in front is looked at only where a pattern holds: looking ahead for it first leaves the matches as they are
    ahead = [f"(?={p})" if guard else "" for _, p in patterns]
    found = F.array(*[F.regexp_extract_all(F.col(text), F.lit(f"(?m){a}{guard}(?:{p})"), F.lit(1)) for a, (_, p) in zip(ahead, patterns, strict=True)])
    x = df.select(key, F.posexplode(found).alias("p", "_names")).select(key, "p", F.posexplode("_names").alias("ordinal", "entity")).filter("entity <> ''")
    first = x.groupBy(key, F.lower("entity").alias("_e")).agg(F.min_by(F.struct("entity", "p", "ordinal"), F.struct("p", "ordinal")).alias("f"))
    names = F.array(*[F.lit(n) for n, _ in patterns])
    return first.select(key, "f.entity", F.get(names, F.col("f.p")).alias("pattern"), F.col("f.ordinal").alias("ordinal"))


def closed_intervals(hits: DataFrame, key: str, start: str, end_of: Column) -> DataFrame:
    """Each hit ends where the next begins; the last where the text ends."""
    w = Window.partitionBy(key).orderBy(start)
    return hits.withColumn("end", F.coalesce(F.lead(start).over(w), end_of))


def carried(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The last value seen at or before each row."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(f"{value}_carried", F.last(value, ignorenulls=True).over(w))


def accepted_count(positions: Column, distance: int) -> Column:
    """How many ``accepted_apart`` accepts; the fold holds the last one and a count only."""
    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, p: Column) -> Column:
        far = acc["last"].isNull() | (p.cast("long") - acc["last"] > distance)
        return F.struct(F.when(far, p.cast("long")).otherwise(acc["last"]).alias("last"), F.when(far, acc["n"] + 1).otherwise(acc["n"]).alias("n"))

    return F.aggregate(positions, start, step, lambda acc: acc["n"])


def accepted_apart(positions: Column, distance: int) -> Column:
    """Of ascending positions, those farther than ``distance`` from the last one accepted: a fold, since refusals don't count."""
    return F.aggregate(
        positions,
        F.array().cast("array<long>"),
        lambda acc, p: F.when((F.size(acc) == 0) | (p.cast("long") - F.element_at(acc, -1) > distance), F.concat(acc, F.array(p.cast("long")))).otherwise(acc),
    )


def pattern_lists(patterns: DataFrame, state: str) -> DataFrame:
    """Patterns as data, to one row for each state: arrays of starts (by rank), ends, blacklist and needs.

    patterns: state, kind (start, end, blacklist), rank, name, pattern, confidence, needs (what must follow a start within 300 characters; null for nothing).
    """
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", "name", "pattern", "confidence", "needs"))))
    return patterns.groupBy(state).agg(of("start").alias("_starts"), of("end").alias("_ends"), of("blacklist").alias("_black"))


def locate_by_lists(docs: DataFrame, patterns: DataFrame, state: str, pages: str, least: int = 50, most: int = 15_000, look_back: int = 800, fallback_pages: int = 4) -> DataFrame:
    """``docs`` with a section each: found, method, start, end (characters from 0), page_start, page_end (from 0, exclusive), confidence.

    pages: array of a document's page texts, which its text joins by line feeds. The patterns of a document's state are joined to it and
    resolved in one pass over the row: starts by rank, each with all its matches in the first half of the text, refused behind a blacklisted
    text or without what must follow; the nearest end closes the section. Where no start holds, the first ``fallback_pages`` pages are the section.
    """
    x = docs.join(pattern_lists(patterns, state), state, "left")
    x = x.withColumns({"_text": F.array_join(F.transform(F.coalesce(pages, F.array().cast("array<string>")), lambda p: F.coalesce(p, F.lit(""))), "\n"), "_sizes": F.transform(F.coalesce(pages, F.array().cast("array<string>")), lambda p: F.length(F.coalesce(p, F.lit(""))) + 1)})
    text, empty = F.col("_text"), F.array().cast("array<struct<rank:int,name:string,pattern:string,confidence:double,needs:string>>")
    starts, ends, black = (F.coalesce(F.col(c).cast("array<struct<rank:int,name:string,pattern:string,confidence:double,needs:string>>"), empty) for c in ("_starts", "_ends", "_black"))

    def hit(at: Column, size: Column, s: Column) -> Column:
        before = F.substring(text, F.greatest(at - look_back, F.lit(1)), F.least(F.lit(look_back), at - 1))
        ok = (at - 1 <= F.length(text) / 2) & ~F.exists(black, lambda b: F.rlike(before, b["pattern"]))
        ok &= F.coalesce(F.rlike(F.substring(text, at + size, F.lit(300)), s["needs"]), F.lit(True))
        tail = F.substring(text, at + least, F.length(text))
        nearest = F.array_min(F.filter(F.transform(ends, lambda e: place_of(tail, e["pattern"])), lambda i: i > 0))
        last = F.coalesce(at - 1 + least + nearest - 1, F.least(at - 1 + most, F.length(text)))
        confidence = F.when(nearest.isNotNull(), s["confidence"]).otherwise(F.round(s["confidence"] * 0.8, 4))
        return F.when(ok, F.struct(s["name"].alias("method"), (at - 1).alias("start"), last.alias("end"), confidence.alias("confidence")))

    kind = "struct<method:string,start:int,end:int,confidence:double>"

    def by_pattern(acc: Column, s: Column) -> Column:
        def step(a: Column, m: Column) -> Column:
            at = a["next"] + m["gap"]
            return F.when(a["hit"].isNotNull(), a).otherwise(F.struct((at + m["size"]).cast("int").alias("next"), hit(at, m["size"], s).cast(kind).alias("hit")))

        first = F.aggregate(match_sizes(text, s["pattern"]), F.struct(F.lit(1).alias("next"), F.lit(None).cast(kind).alias("hit")), step, lambda a: a["hit"])
        return F.when(acc.isNotNull(), acc).otherwise(first)

    x = x.withColumn("_hit", F.aggregate(starts, F.lit(None).cast(kind), by_pattern))
    total = lambda n: F.aggregate(F.slice("_sizes", F.lit(1), n), F.lit(0), lambda a, v: a + v)
    some, first_pages = F.size("_sizes") > 0, F.least(F.lit(fallback_pages), F.size("_sizes"))
    found = F.col("_hit").isNotNull()
    begin, end = F.when(found, F.col("_hit.start")).when(some, 0), F.when(found, F.col("_hit.end")).when(some, F.least(total(first_pages) - 1, F.length(text)))
    # the page of a character is how many pages end at or before it
    page = lambda at: F.size(F.filter(F.sequence(F.lit(1), F.size("_sizes")), lambda n: total(n) <= at))
    return x.select(
        *docs.columns,
        some.alias("found"),
        F.when(found, F.col("_hit.method")).when(some, F.lit(f"fallback_{fallback_pages}pp")).otherwise("no_text").alias("method"),
        begin.alias("start"),
        end.alias("end"),
        F.when(found, page(begin)).when(some, 0).alias("page_start"),
        F.when(found, page(F.greatest(end - 1, begin)) + 1).when(some, first_pages).alias("page_end"),
        F.when(found, F.col("_hit.confidence")).otherwise(0.0).alias("confidence"),
    )


def packed(sizes: DataFrame, group: str, order: str, size: str, limit: int, most: int) -> DataFrame:
    """Batch numbers by next-fit: a batch closes when the next item would pass the limit or the number of items.

    Where a batch begins depends on all before it in its group, so a group's items stream in order through one task, which
    holds the open batch's size and number only.
    """
    first = F.row_number().over(Window.partitionBy(group).orderBy(order)) == 1
    x = sizes.select(group, order, F.col(size).cast("long").alias(size), first.alias("_first")).sortWithinPartitions(group, order)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = used = n = 0
        for rows in batches:
            out = []
            for s, begins in zip(rows[size], rows["_first"]):
                if begins:
                    batch = used = n = 0
                elif used + s > limit or n >= most:
                    batch, used, n = batch + 1, 0, 0
                used, n = used + s, n + 1
                out.append(batch)
            yield rows.drop(columns="_first").assign(batch=out)

    schema = StructType([f for f in x.schema if f.name != "_first"] + [StructField("batch", LongType())])
    return x.mapInPandas(number, schema)


def page_span(start: Column, end: Column, pages: Column, bound: Column, fallback: int) -> Column:
    """Struct first, last (exclusive) inside a document of so many pages; ``bound`` or null caps the end, an empty span gets ``fallback`` pages."""
    first = F.greatest(F.lit(0), F.least(start, pages - 1))
    limit = F.when(bound.isNull(), pages).otherwise(F.least(F.greatest(bound, F.lit(0)), pages))
    limit = F.when(limit <= first, pages).otherwise(limit)
    last = F.greatest(F.lit(0), F.least(F.coalesce(end, first), limit))
    last = F.when(last <= first, F.least(first + fallback, limit)).otherwise(last)
    at = lambda c: F.when(pages <= 0, 0).otherwise(c).cast("int")
    return F.struct(at(first).alias("first"), at(last).alias("last"))


def skipped_pages(pages: Column, pattern: str, check: int = 5) -> Column:
    """How many pages a cover and summary take: up to the first of ``check`` pages that names a summary, else the cover alone."""
    return F.coalesce(F.array_min(F.transform(F.slice(pages, 1, check), lambda p, i: F.when(F.upper(p).rlike(pattern), i + 1))), F.lit(1))


def article_ranges(all_lines: DataFrame, key: str, article: str, following: str, cuts: str, tail_cuts: str) -> DataFrame:
    """For each key with such an article: its number, the lines at which it starts and ends.

    ``article`` and ``following`` have the number as group 1 and may run into the next line. The article ends before the first
    ``following`` with the number after its own, else at the first line of ``cuts`` or ``tail_cuts``, else with the last line.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    both = F.trim(F.concat_ws(" ", "line", F.lead("line").over(w)))
    number = lambda p: F.when(F.col("line").rlike(p), F.regexp_extract("line", p, 1)).when(both.rlike(p), F.regexp_extract(both, p, 1)).cast("int")
    x = all_lines.select(key, "line_no", number(article).alias("n"), number(following).alias("f"), F.col("line").rlike(cuts).alias("cut"), F.col("line").rlike(tail_cuts).alias("tail"))
    ends = x.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("cut"), F.col("line_no"))), F.max("line_no")).alias("cutoff"))
    starts = x.filter("n IS NOT NULL").join(ends, key).filter("line_no <= cutoff").groupBy(key).agg(F.min_by(F.struct(F.col("line_no").alias("first"), F.col("n").alias("article"), "cutoff"), "line_no").alias("s")).select(key, "s.*")
    after = x.filter("f IS NOT NULL OR tail").join(starts, key).filter("line_no <= cutoff")
    after = after.groupBy(key).agg(F.min(F.expr("CASE WHEN f = article + 1 AND line_no > first THEN line_no END")).alias("next"), F.min(F.expr("CASE WHEN tail AND line_no >= first THEN line_no END")).alias("tail"))
    return starts.join(after, key, "left").select(key, "article", "first", F.coalesce(F.col("next") - 1, F.col("tail"), F.col("cutoff")).alias("last"))
