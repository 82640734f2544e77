"""Tables and lists of web pages as rows.

A page is read tag by tag, with a stack of the tables and lists that are open: for each its number, rows, cells, and whether a cell is open.
A page may come in parts, so that none has to be held whole. What a part does to the stack, whatever it finds there, is small: how many it closes,
what it does to the one then on top, and which it leaves open. These effects are composed in order of parts, which gives the stack that each
part finds, and then each part is read by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

CONTAINERS, _PARTS = ("table", "ul", "ol"), ("tr", "td", "th", "li")
#: Names of characters that pages of Latin scripts use.
NAMES = {n: chr(c) for n, c in sorted(name2codepoint.items()) if c < 0x100}


def unescaped(c: Column) -> Column:
    """Character references replaced: names of Latin-1 characters, decimal and hexadecimal numbers. Others stay as they are."""
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    number = lambda digits, base: F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32")

    def part(x: Column, i: Column) -> Column:
        name = F.regexp_extract(x, r"^([A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});", 1)
        digits = F.substring(name, 2, 8)
        plain = F.when(F.startswith(name, F.lit("#x")) | F.startswith(name, F.lit("#X")), number(F.substring(name, 3, 8), 16)).when(F.startswith(name, F.lit("#")), number(digits, 10)).otherwise(F.try_element_at(names, name))
        read = F.when((name != "") & plain.isNotNull(), F.concat(plain, F.substring(x, F.length(name) + 2, F.length(x))))
        return F.when(i == 0, x).otherwise(F.coalesce(read, F.concat(F.lit("&"), x)))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "&", -1), part), "")).otherwise(c)


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute; null without it."""
    value = F.regexp_extract(tag, rf"(?is)^<[^>]*?\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    bare = F.when(F.rlike(value, F.lit("^[\"']")), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.when(F.rlike(tag, F.lit(rf"(?is)^<[^>]*?\s{name}\s*=")), unescaped(bare))


class Open:
    """A table or list that is open: number, depth, kind, rows, cells of the last row, whether a cell is open, and that cell's pieces and link."""

    __slots__ = ("number", "depth", "kind", "row", "cell", "within", "pieces", "link")

    def __init__(self, number: int, depth: int, kind: str, row: int = 0, cell: int = 0, within: bool = False):
        self.number, self.depth, self.kind, self.row, self.cell, self.within = number, depth, kind, row, cell, within
        self.pieces, self.link = [], None

    def take(self, tag: str, closing: str) -> bool:
        """Counts a tag of the table or list itself; whether it ends the cell that was open."""
        is_row, is_cell = (tag == "tr", tag in ("td", "th")) if self.kind == "table" else (tag == "li", tag == "li")
        if not (is_row or is_cell):
            return False
        if is_row and not closing:
            self.row, self.cell = self.row + 1, 0
        if is_cell and not closing:
            self.cell += 1
        self.within = is_cell and not closing
        return True


#: Comments, scripts and styles, tags with whether they close and their name; the second has texts too.
_TAG = r"(?s:<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|<(/?)([A-Za-z][A-Za-z0-9]*)?[^>]*>)"
_TAGS, _TOKENS, _LINKED = re.compile(_TAG, re.ASCII), re.compile(_TAG + "|[^<]+", re.ASCII), re.compile(r"^<[^>]*?\shref\s*=", re.I | re.ASCII)


def _read(html: str, stack: list[Open], opened: int) -> Iterator[tuple]:
    """Cells of a page or part, as they close: kind, number, depth, row, cell, pieces, link. ``stack`` is left as the end finds it."""

    def ended(o: Open, place: tuple[int, int]) -> tuple:
        cell = (o.kind, o.number, o.depth, *place, o.pieces, o.link)
        o.pieces, o.link = [], None
        return cell

    for m in _TOKENS.finditer(html):
        closing, tag = m.groups()
        tag = tag and tag.lower()
        if tag in CONTAINERS:
            if not closing:
                opened += 1
                stack.append(Open(opened, len(stack) + 1, "table" if tag == "table" else "list"))
            elif stack and (o := stack.pop()).within:
                yield ended(o, (o.row, o.cell))
        elif stack:
            o = stack[-1]
            if tag in _PARTS:
                was, place = o.within, (o.row, o.cell)
                if o.take(tag, closing) and was:
                    yield ended(o, place)
            elif o.within:
                if tag is None:
                    if (token := m.group())[0] != "<":
                        o.pieces.append(token)
                elif tag in ("br", "p", "div"):
                    o.pieces.append(" ")
                elif tag == "a" and not closing and o.link is None and _LINKED.match(token := m.group()):
                    o.link = token


def _rest(stack: list[Open]) -> Iterator[tuple]:
    """Cells that the end of a page closes."""
    yield from ((o.kind, o.number, o.depth, o.row, o.cell, o.pieces, o.link) for o in stack if o.within)


def _effect(html: str) -> tuple[int, int, list[tuple], list[tuple]]:
    """What a part does to any stack: how many it opens in all, how many of those before it closes, what it does to the one then on top (as a
    table, as a list), and those that it leaves open, with numbers from 1. A cell that is open before any tag of it is told by None."""
    opened = closed = 0
    fresh = lambda: [Open(0, 0, "table"), Open(0, 0, "list")]
    below, stack, touched = fresh(), [], [False, False]
    for closing, tag in _TAGS.findall(html):
        tag = tag.lower()
        if tag in CONTAINERS:
            if not closing:
                opened += 1
                stack.append(Open(opened, 0, "table" if tag == "table" else "list"))
            elif stack:
                stack.pop()
            else:
                closed, below, touched = closed + 1, fresh(), [False, False]
        elif tag not in _PARTS:
            continue
        elif stack:
            stack[-1].take(tag, closing)
        else:
            touched = [o.take(tag, closing) or t for o, t in zip(below, touched, strict=True)]
    return opened, closed, [(o.row, o.cell, o.within if t else None) for o, t in zip(below, touched, strict=True)], [(o.number, o.kind, o.row, o.cell, o.within) for o in stack]


def _composed(stack: list[tuple], opened: int, effect: tuple) -> tuple[list[tuple], int]:
    """The stack (number, kind, row, cell, within of each) and the number opened after a part."""
    more, closed, below, left = effect
    stack = stack[: max(len(stack) - closed, 0)]
    if stack:
        number, kind, row, cell, within = stack[-1]
        rows, cells_, now = below[kind == "list"]
        stack[-1] = (number, kind, row + rows, cells_ if rows else cell + cells_, within if now is None else now)
    return [*stack, *((opened + n, *rest) for n, *rest in left)], opened + more


_FOUND = "kind string, number long, depth long, row long, cell long, pieces array<string>, link string"
_STACK = pa.list_(pa.struct([("number", pa.int64()), ("kind", pa.string()), ("row", pa.int64()), ("cell", pa.int64()), ("within", pa.bool_())]))
#: Cells of one batch that a task hands on.
BATCH = 4096


def _rows(found: Iterator[tuple], page: pa.Scalar, batch_type: pa.Schema, held: list[list]) -> Iterator[pa.RecordBatch]:
    """Batches of cells of a page, as soon as they are full; what is left stays in ``held``."""
    key = page.as_py()
    for cell in found:
        for column, value in zip(held, (key, *cell), strict=True):
            column.append(value)
        if len(held[0]) >= BATCH:
            yield _batch(held, batch_type)


def _batch(held: list[list], batch_type: pa.Schema) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, batch_type.types, strict=True)], schema=batch_type)
    for column in held:
        column.clear()
    return out


def cells(pages: DataFrame, page: str, html: str, part: str | None = None) -> DataFrame:
    """One row for each cell of a table and each item of a list: page, kind, number, depth, row, cell, text, href.

    number: of the table or list in its page, from 1; depth: how many it stands in, itself included; row and cell: from 1 (an item is a row of
    one cell; 0 for a cell before any row). text: its own, without that of tables and lists inside it, white space made one space;
    href: of its first link. End tags may be left out; those without a start are passed over. Pages without either give no row.

    With ``part`` a page is the rows of its key in order of their parts (of any type that sorts), cut between tags where no cell is open.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField(page, pages.schema[page].dataType), *StructType.fromDDL(_FOUND).fields])
    entry = "array<struct<number:long,kind:string,row:long,cell:long,within:boolean>>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_type = to_arrow_schema(schema)
        held: list[list] = [[] for _ in batch_type]
        for batch in batches:
            for i in range(batch.num_rows):
                stack, opened, last = [], 0, True
                if batch.num_columns > 2:
                    before, opened, last = (batch.column(k)[i].as_py() for k in (2, 3, 4))
                    stack = [Open(o["number"], d, o["kind"], o["row"], o["cell"], o["within"]) for d, o in enumerate(before, 1)]
                    if any(o.within for o in stack):
                        raise ValueError("a page is cut inside a cell")
                yield from _rows(_read(batch.column(1)[i].as_py() or "", stack, opened), batch.column(0)[i], batch_type, held)
                if last:
                    yield from _rows(_rest(stack), batch.column(0)[i], batch_type, held)
        if held[0]:
            yield _batch(held, batch_type)

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pickle import dumps

        for batch in batches:
            done = [dumps(_effect(batch.column(2)[i].as_py() or "")) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(done, pa.binary())], names=[page, "_part", "effect"])

    def stacks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of pages in order, each with the stack before it; one row is held back, to tell a page's last part."""
        from pickle import loads

        now: list[tuple] = []
        opened, at = 0, object()
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                if (key := batch.column(0)[i].as_py()) != at:
                    now, opened, at = [], 0, key
                out.append((now, opened))
                now, opened = _composed(now, opened, loads(batch.column(2)[i].as_py()))
            names = ("number", "kind", "row", "cell", "within")
            arrays = [pa.array([[dict(zip(names, o, strict=True)) for o in s] for s, _ in out], _STACK), pa.array([n for _, n in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays, batch.column(3)], names=[page, "_part", "stack", "opened", "last"])

    if part is None:
        # a file of pages may be one task's, and reading tags is work
        found = pages.select(page, html).repartition(page).mapInArrow(read, schema)
    else:
        kinds = {c: pages.schema[c].dataType.simpleString() for c in (page, part)}
        parts = pages.select(page, F.col(part).alias("_part"), F.col(html).alias("_html"))
        done = parts.mapInArrow(effects, f"`{page}` {kinds[page]}, _part {kinds[part]}, effect binary")
        # effects of a page are small, and meet in one task, which streams them
        done = done.withColumn("last", F.lead("_part").over(Window.partitionBy(page).orderBy("_part")).isNull()).sortWithinPartitions(page, "_part")
        before = done.mapInArrow(stacks, f"`{page}` {kinds[page]}, _part {kinds[part]}, stack {entry}, opened long, last boolean")
        joined = parts.join(before.withColumnRenamed(page, "_page"), parts[page].eqNullSafe(F.col("_page")) & (parts["_part"] == before["_part"]))
        found = joined.select(parts[page], "_html", "stack", "opened", "last").mapInArrow(read, schema)
    text = F.trim(F.regexp_replace(F.array_join(F.transform("pieces", unescaped), ""), "[\\s\u00a0]+", " "))
    return found.select(page, "kind", "number", "depth", "row", "cell", text.alias("text"), attribute(F.col("link"), "href").alias("href"))


def index_dates(found: DataFrame, page: str, date_cell: int, months: tuple[int, ...], known: DataFrame, url: str) -> DataFrame:
    """Of rows of index tables whose date (day/month/year, or written out in Spanish) is in one of ``months``: page, number, row, day, href, exists (in ``known``)."""
    from panelspark.functions.text import spanish_date

    # dates and links of a row are gathered together, so that pages are read once
    cells_ = found.filter((F.col("kind") == "table") & ((F.col("cell") == date_cell) | F.col("href").isNotNull()))
    day = F.coalesce(F.try_to_date(F.nullif(F.regexp_extract("text", r"(\d{1,2}/\d{1,2}/\d{4})", 1), F.lit("")), "d/M/yyyy"), spanish_date(F.col("text")))
    link = F.min_by("href", F.when(F.col("href").isNotNull(), F.col("cell")))
    rows = cells_.groupBy(page, "number", "row").agg(F.max(F.when(F.col("cell") == date_cell, day)).alias("day"), link.alias("href")).filter(F.month("day").isin(*months))
    there = known.select(F.col(url).alias("href")).distinct().withColumn("exists", F.lit(True))
    return rows.join(there, "href", "left").select(page, "number", "row", "day", "href", F.coalesce("exists", F.lit(False)).alias("exists"))
