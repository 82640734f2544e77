"""Benchmark decontamination with suffix arrays of the training text.

Each shard (about ``SHARD`` bytes of documents in a task) gets a suffix array over its words, made by prefix doubling: suffixes
are ordered by their first word, then by 2, 4, 8 words, of which only ties are looked at. Every suffix of the test items is
binary-searched in it, which gives the interval of the array that begins with it. The interval of a window holds all its occurrences:
their words are the hits, and rows with a hit are removed. Windows that items share are one interval, with the list of its items.
As test suffixes are sorted too, every suffix of the shard lies between two neighbours of theirs, and the longer match with one
of these is the longest verbatim match from that place; each row reports its longest. No text is moved: documents are read
once, and a document's matches are found in the task that reads it. Arrays are as large as their shards and are made anew in
each run, not kept.

Test items are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one after another, so that neither the driver nor a task
holds more than one. A benchmark of several blocks takes a pass over the documents for each; what passes find is then brought together
by row. Results are the same for any number of blocks and any cut into shards.

Defined results
* words are lower-cased (A-Z) runs of digits, ASCII letters and all code points from 0x80. Null or empty text has no words.
* a window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
* items with the same item_id count once; a null item_id is written "null". An empty benchmark hits nothing.
* repeated rows and null doc_ids give a row each; other columns are left out, whatever their names (``decontaminated`` keeps them).
* a very long text is a shard of its own. longest, longest_item and longest_at are the words, item and first word of the longest run of
  words that a row shares with any item (ties: the first in the row, then the least item); 0 and null where it shares no word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import ALNUM, buffers, hashes, slices, words
from .shared import checked, packed, stored, tidy

BLOCK_BYTES = 32 << 20
#: Bytes of documents in an array.
SHARD = 4 << 20


def suffix_array(numbers: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The places ``at``, all that hold no 0, ordered by the up to ``depth`` words from there; 0 ends a text. By prefix doubling."""
    n = len(at)
    if not n:
        return at
    order = at[np.argsort(numbers[at], kind="stable")]
    first = numbers[order]
    fresh = np.concatenate([[True], first[1:] != first[:-1]])
    place = np.arange(n)
    group = np.maximum.accumulate(np.where(fresh, place, 0))
    rank = np.zeros(len(numbers), np.int64)  # of what begins with a 0: 0
    rank[order] = group + 1
    step = 1
    while step < depth:
        tied = np.flatnonzero(~fresh | np.concatenate([~fresh[1:], [False]]))
        if not len(tied):
            break
        then = rank[np.minimum(order[tied] + step, len(rank) - 1)]
        sub = np.argsort(group[tied] * (n + 1) + then, kind="stable")
        order[tied], then = order[tied][sub], then[sub]
        g = group[tied]
        fresh[tied] = np.concatenate([[True], (g[1:] != g[:-1]) | (then[1:] != then[:-1])])
        group = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[order[tied]] = group[tied] + 1
        step *= 2
    return order


class TestSuffixes:
    """Sorted vocabulary and all suffixes of a block of items, as word numbers from 1."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str], window: int):
        column = pa.array(texts, pa.large_string())
        raw, offsets = buffers(column)
        w = words(raw, offsets, ALNUM)
        h = hashes(raw, w)
        self.vocabulary, number = np.unique(h, return_inverse=True)
        number = (number + 1).astype(np.int32)
        size = np.diff(w.first)
        self.names = sorted(set(ids))
        place = {x: i for i, x in enumerate(self.names)}
        row = np.repeat(np.arange(len(size)), size)
        self.longest = int(size.max()) if len(size) else 0
        # a 0 after each item
        spot = np.arange(len(number)) + row
        self.words = np.zeros(len(number) + len(size) + self.longest + 1, np.int32)
        self.words[spot] = number
        item = np.zeros(len(self.words), np.int64)
        item[spot] = np.array([place[x] for x in ids], np.int64)[row] if len(ids) else 0
        left = np.zeros(len(self.words), np.int64)
        left[spot] = w.first[1:][row] - np.arange(len(number))  # words to the item's end
        need = np.zeros(len(self.words), np.int64)
        need[spot] = np.minimum(size[row], window)
        # in their own order
        self.at = suffix_array(self.words, spot, self.longest)
        self.item, self.left, self.need = item[self.at], left[self.at], need[self.at]


def search(numbers: np.ndarray, array: np.ndarray, test: np.ndarray, at: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
    """For each suffix of ``length`` words from ``at``, its place in the array, before or after all that begin with it."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        common = shared_words(numbers, array[mid], test, at[live], length[live])
        whole = common >= length[live]
        a, b = numbers[array[mid] + common], test[at[live] + np.minimum(common, length[live])]
        up = np.where(whole, right, a < b)
        lo[live] = np.where(up, mid + 1, lo[live])
        hi[live] = np.where(up, hi[live], mid)


def shared_words(numbers: np.ndarray, a: np.ndarray, test: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and at ``b`` have in common, ``most`` at most."""
    common = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    step = 0
    while len(live):
        x, y = numbers[a[live] + step], test[b[live] + step]
        live = live[(x == y) & (x > 0) & (step < most[live])]
        step += 1
        common[live] = step
    return np.minimum(common, most)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(fresh)


class Matches:
    """What a shard of texts shares with the items of a block.

    count: words of each row; first: number of the first word of each row, one more at the end; hit: flag of each word;
    kinds: sets of items, by number; found: (row, kind) pairs of rows with the windows that a set of items has;
    best: (row, first word, words, item) of the longest match of each row that has any.
    """

    def __init__(self, column: pa.Array, test: TestSuffixes):
        raw, offsets = buffers(column)
        w = words(raw, offsets, ALNUM)
        n = len(w.start)
        self.first, self.count = w.first, np.diff(w.first)
        self.hit, self.kinds = np.zeros(n, bool), []
        self.found, self.best = np.zeros((0, 2), np.int64), np.zeros((0, 4), np.int64)
        if not n or not len(test.at):
            return
        h = hashes(raw, w)
        place = np.minimum(np.searchsorted(test.vocabulary, h), len(test.vocabulary) - 1)
        number = np.where(test.vocabulary[place] == h, place + 1, 0).astype(np.int32)
        # a 0 after each row keeps suffixes inside it; words that no item has are 0 too, and no suffix begins with one
        row = np.repeat(np.arange(len(self.count)), self.count)
        numbers = np.zeros(n + len(self.count) + test.longest + 1, np.int32)
        spot = np.arange(n) + row
        numbers[spot] = number
        own = np.flatnonzero(number > 0)
        if not len(own):
            return
        back = np.full(len(numbers), -1, np.int64)
        back[spot] = np.arange(n)
        array = suffix_array(numbers, spot[own], test.longest)
        begins = np.zeros(len(test.vocabulary) + 1, bool)
        begins[number] = True
        searched = np.flatnonzero(begins[test.words[test.at]])
        at, left, need = test.at[searched], test.left[searched], test.need[searched]
        to = search(numbers, array, test.words, at, left, False)
        self._windows(numbers, array, test, searched[left >= need], to[left >= need], back, row)
        self._longest(numbers, array, test, at, left, to, back, row)

    def _windows(self, numbers: np.ndarray, array: np.ndarray, test: TestSuffixes, at: np.ndarray, to: np.ndarray, back: np.ndarray, row: np.ndarray) -> None:
        """Hits, and the items of each row, from the suffixes ``at`` that begin with a whole window."""
        need = test.need[at]
        # windows that aren't in the shard have no neighbour that begins with them
        before, after = array[np.maximum(to - 1, 0)], array[np.minimum(to, len(array) - 1)]
        near = np.maximum(*(shared_words(numbers, x, test.words, test.at[at], need) for x in (before, after)))
        at, need = at[near >= need], need[near >= need]
        if not len(at):
            return
        lo, hi = (search(numbers, array, test.words, test.at[at], need, right) for right in (False, True))
        order = np.lexsort((test.item[at], need, lo))
        at, need, lo, hi = at[order], need[order], lo[order], hi[order]
        starts = _runs(lo, need)  # a window once, with its items
        names: dict[bytes, int] = {}
        kind = np.array([names.setdefault(np.unique(x).tobytes(), len(names)) for x in np.split(test.item[at], starts[1:])])
        self.kinds = [np.frombuffer(x, np.int64) for x in names]
        lo, hi, need = lo[starts], hi[starts], need[starts]
        times = hi - lo
        begin = back[array[np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())]]
        change = np.bincount(begin, minlength=len(self.hit) + 1)
        change -= np.bincount(begin + np.repeat(need, times), minlength=len(self.hit) + 1)
        self.hit = np.cumsum(change[:-1]) > 0
        pairs = np.unique(row[begin] * len(self.kinds) + np.repeat(kind, times))
        self.found = np.stack([pairs // len(self.kinds), pairs % len(self.kinds)], 1)

    def _longest(self, numbers: np.ndarray, array: np.ndarray, test: TestSuffixes, at: np.ndarray, left: np.ndarray, to: np.ndarray, back: np.ndarray, row: np.ndarray) -> None:
        """The longest match of each row. ``to`` grows with the order of test suffixes, so the neighbours of each suffix of the shard are known."""
        after = np.searchsorted(to, np.arange(len(array)), "right")
        length = np.zeros(len(array), np.int64)
        for neighbour in (after - 1, after):
            ok = np.flatnonzero((neighbour >= 0) & (neighbour < len(at)))
            k = neighbour[ok]
            length[ok] = np.maximum(length[ok], shared_words(numbers, array[ok], test.words, at[k], left[k]))
        begin = back[array]
        order = np.lexsort((begin, -length, row[begin]))
        top = order[_runs(row[begin[order]])]
        begin, length, start = begin[top], length[top], array[top]
        # all test suffixes that share as much with it; the least of their items
        lo, hi = (search(test.words, test.at, numbers, start, length, right) for right in (False, True))
        of = {span: int(test.item[span[0] : span[1]].min()) for span in set(zip(lo.tolist(), hi.tolist(), strict=True))}
        item = np.array([of[span] for span in zip(lo.tolist(), hi.tolist(), strict=True)], np.int64)
        self.best = np.stack([row[begin], begin - self.first[row[begin]], length, item], 1)

    def hits(self) -> np.ndarray:
        """Hit words of each row."""
        total = np.concatenate([[0], np.cumsum(self.hit)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def items(self, test: TestSuffixes) -> tuple[list[tuple[int, ...]], dict[tuple[int, ...], list[str]]]:
        """For each row the numbers of its sets of items, and for each such list the names in it."""
        kinds: list[list[int]] = [[] for _ in self.count]
        for r, k in self.found.tolist():
            kinds[r].append(k)
        rows = [tuple(k) for k in kinds]
        return rows, {k: sorted(test.names[i] for i in (np.unique(np.concatenate([self.kinds[j] for j in k])) if k else ())) for k in set(rows)}

    def places(self, test: TestSuffixes) -> list[pa.Array]:
        """The longest match of each row: words, item, first word."""
        n = len(self.count)
        size, item, at = np.zeros(n, np.int64), np.full(n, None, object), np.full(n, -1, np.int64)
        row = self.best[:, 0]
        size[row], at[row] = self.best[:, 2], self.best[:, 1]
        item[row] = [test.names[j] for j in self.best[:, 3]]
        return [pa.array(size), pa.array(item, pa.string()), pa.array(at, mask=at < 0)]


def test_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[TestSuffixes]:
    """The items in blocks of bounded size, one at a time on the driver."""
    items = checked(benchmark, id_col, text_col).select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("i"), F.col(f"`{text_col}`").alias("t")).filter("length(t) > 0")
    ids, texts, size = [], [], 0
    for r in items.toLocalIterator():
        more = len(r.t.encode())
        if ids and size + more > block_bytes:
            yield TestSuffixes(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += more
    yield TestSuffixes(ids, texts, window)


test_blocks.__test__ = False


RESULTS = (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"), ("contaminated", "boolean"), ("longest", "long"), ("longest_item", "string"), ("longest_at", "long"))


def _names_sha(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, clean_rows: bool = False) -> DataFrame:
    """For each row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated, longest, longest_item, longest_at. clean_rows: whole rows without a hit instead."""
    blocks = test_blocks(benchmark, item_id, item_text, window, block_bytes)
    block, more = next(blocks), next(blocks, None)
    if more is not None:
        return _in_passes(docs, (b for some in ((block, more), blocks) for b in some), id_col, text_col, clean_rows)
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kept = docs.columns if clean_rows else [id_col]
    carry = [c for c in kept if c != text_col]
    source = checked(docs, *carry, text_col)
    schema = checked(docs, *kept).schema
    for name, kind in () if clean_rows else RESULTS:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = shared.value
        for batch in batches:
            for part in slices(batch, len(carry), SHARD):
                m = Matches(part.column(len(carry)), test)
                n_hit = m.hits()
                if clean_rows:
                    columns = dict(zip(carry, part.columns, strict=False)) | {text_col: part.column(len(carry))}
                    yield pa.RecordBatch.from_arrays([columns[c] for c in kept], names=kept).filter(pa.array(n_hit == 0))
                else:
                    rows, names = m.items(test)
                    sha = {k: _names_sha(x) for k, x in names.items()}
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m.count), pa.array(n_hit), pa.array([len(names[k]) for k in rows], pa.int64()), pa.array([sha[k] for k in rows], pa.string()), pa.array(n_hit > 0), *m.places(test)], names=schema.names)

    return source.mapInArrow(tidy(run), schema)


def _in_passes(docs: DataFrame, blocks: Iterator[TestSuffixes], id_col: str, text_col: str, clean_rows: bool) -> DataFrame:
    """One pass over the documents for each block of items, each stored before the next; rows are brought together by id and hash of the text."""
    spark: SparkSession = docs.sparkSession
    slim = checked(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(f"`{text_col}`").alias("_h"), F.col(f"`{text_col}`").alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    found = None
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            test = shared.value
            for batch in batches:
                for part in slices(batch, 2, SHARD):
                    m = Matches(part.column(2), test)
                    n_hit = m.hits()
                    rows, names = m.items(test)
                    bits = [np.packbits(m.hit[a:b]).tobytes() if n else None for a, b, n in zip(m.first[:-1], m.first[1:], n_hit, strict=True)]
                    out = [part.column(0), part.column(1), pa.array(m.count), pa.array(bits, pa.binary()), pa.array([names[k] for k in rows], pa.list_(pa.string())), *m.places(test)]
                    yield pa.RecordBatch.from_arrays(out, names=["_id", "_h", "n_words", "bits", "names", "longest", "longest_item", "longest_at"])

        one = stored(slim.mapInArrow(tidy(run), f"_id {kind}, _h long, n_words long, bits binary, names array<string>, longest long, longest_item string, longest_at long"), "hits")
        shared.destroy()
        found = one if found is None else found.unionByName(one)
        last = one
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h").eqNullSafe(F.col("_h2")))
    if clean_rows:
        gone = found.filter("bits IS NOT NULL").select(F.col("_id").alias("_id2"), F.col("_h").alias("_h2")).distinct()
        return packed(docs, _id=F.col(f"`{id_col}`"), _h=F.xxhash64(f"`{text_col}`")).join(gone, same, "left_anti").select("_row.*")

    def combine(group: pa.Table) -> pa.Table:
        flags = None
        for b in group.column("bits").to_pylist():
            x = np.frombuffer(b, np.uint8)
            flags = x if flags is None else flags | x
        names = sorted({n for x in group.column("names").to_pylist() for n in x})
        return pa.table({"_id2": group.column("_id")[:1], "_h2": group.column("_h")[:1], "n_hit": pa.array([int(np.bitwise_count(flags).sum())], pa.int64()), "n_items": pa.array([len(names)], pa.int64()), "items_sha256": pa.array([_names_sha(names)])})

    # a row's copies found the same in each pass; one of each is enough
    once = found.filter("bits IS NOT NULL").dropDuplicates(["_id", "_h", "bits", "names"])
    hits = once.groupBy("_id", "_h").applyInArrow(combine, f"_id2 {kind}, _h2 long, n_hit long, n_items long, items_sha256 string")
    first = F.min(F.struct((-F.col("longest")).alias("less"), "longest_at", "longest_item"))
    best = found.filter("longest > 0").groupBy(F.col("_id").alias("_id2"), F.col("_h").alias("_h2")).agg(first.alias("best"))
    return (
        last.select("_id", "_h", "n_words")
        .join(hits, same, "left")
        .drop("_id2", "_h2")
        .join(best, same, "left")
        .select(
            F.col("_id").alias(id_col),
            "n_words",
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_hit", "n_items")],
            F.coalesce("items_sha256", F.lit(_names_sha([]))).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
            F.coalesce(-F.col("best.less"), F.lit(0)).cast("long").alias("longest"),
            F.col("best.longest_item").alias("longest_item"),
            F.col("best.longest_at").alias("longest_at"),
        )
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of each item in each row of ``docs``, of ``least`` words or more: id, item_id, first_word, n_words.

    Each document is a shard of its own here, and its matches are those of every test suffix with its neighbours in it.
    """
    spark = docs.sparkSession
    source = checked(docs, id_col, text_col)
    schema = checked(docs, id_col).schema.add("item_id", "string").add("first_word", "long").add("n_words", "long")
    out = None
    for block in test_blocks(benchmark, item_id, item_text, least, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            test = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    found = longest_of_items(batch.column(1).slice(i, 1), test)
                    found = found[found[:, 2] >= least]
                    if len(found):
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(found), i))), pa.array([test.names[j] for j in found[:, 0]], pa.string()), pa.array(found[:, 1]), pa.array(found[:, 2])], names=schema.names)

        found = stored(source.mapInArrow(tidy(run), schema), "longest")
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def longest_of_items(text: pa.Array, test: TestSuffixes) -> np.ndarray:
    """The longest match of each item in one text: item, first word, words."""
    raw, offsets = buffers(text)
    w = words(raw, offsets, ALNUM)
    h = hashes(raw, w)
    none = np.zeros((0, 3), np.int64)
    if not len(h) or not len(test.at):
        return none
    place = np.minimum(np.searchsorted(test.vocabulary, h), len(test.vocabulary) - 1)
    numbers = np.concatenate([np.where(test.vocabulary[place] == h, place + 1, 0), np.zeros(test.longest + 1)]).astype(np.int32)
    own = np.flatnonzero(numbers > 0)
    begins = np.zeros(len(test.vocabulary) + 1, bool)
    begins[numbers] = True
    searched = np.flatnonzero(begins[test.words[test.at]])
    if not len(own) or not len(searched):
        return none
    array = suffix_array(numbers, own, test.longest)
    at, left = test.at[searched], test.left[searched]
    to = search(numbers, array, test.words, at, left, False)
    size = np.maximum(*(shared_words(numbers, array[x], test.words, at, left) for x in (np.maximum(to - 1, 0), np.minimum(to, len(array) - 1))))
    item = test.item[searched]
    most = np.zeros(len(test.names), np.int64)
    np.maximum.at(most, item, size)
    top = np.flatnonzero(size == most[item])
    # the first place in the text where so much is shared
    lo, hi = (search(numbers, array, test.words, at[top], size[top], right) for right in (False, True))
    first = np.full(len(test.names), len(numbers), np.int64)
    np.minimum.at(first, item[top], np.array([array[a:b].min() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], np.int64))
    found = np.unique(item)
    return np.stack([found, first[found], most[found]], 1)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without those that hold a window of a test item."""
    return contamination(docs, benchmark, clean_rows=True, **options)
