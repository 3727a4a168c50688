"""Benchmark decontamination: which documents hold a benchmark item with few edits.

Texts and items are lower-cased and every run of non-word characters becomes one space. An item of m characters with at
most e edits (``rate`` of m) in a document keeps m - q + 1 - q * e of its q-grams (the q-gram lemma), all within e
diagonals of each other. So shared q-grams are counted in overlapping bands of 2e diagonals; bands that reach the bound
are verified by a banded alignment of the whole item, which may begin and end anywhere in the document. Items of a template
share their grams: postings are counted a bounded number at a time, and what items have in common at their beginning is
aligned once in a band.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters (a longer item is a block of its own); each block
is sent to all tasks and all documents pass it once, without a shuffle. Where an item is too short for its budget, q falls
for it to the longest gram that keeps the bound positive, so items of any length are found; items shorter than q, which
allow no edit, count where they stand as whole words. Empty items are in no document.

NULL and empty texts hold nothing; long texts are searched whole; repeated rows and repeated items give rows of their
own; an empty table gives no rows. Other input columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from productlens.llm.tasks import filtered, prepare, ranges, slices, texts_of

OTHER = re.compile(r"[\W_]+")
Q, RATE = 10, 0.08
BLOCK_CHARS = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
FLAG_BITS = 22
#: postings counted, and cells of the alignment table filled, at once
POSTINGS, CELLS = 4 << 20, 1 << 22


def normal(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of every q-gram, by doubling."""
    if codes.size < q:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, width = codes.astype(np.uint64) * BASE + np.uint64(1), 1
        out, done, scale = None, 0, BASE
        while True:
            if q & width:
                out = power if out is None else out[: codes.size - done - width + 1] * scale + power[done:]
                done += width
            if done == q:
                return out[: codes.size - q + 1]
            power = power[:-width] * scale + power[width:]
            scale, width = scale * scale, width * 2


def common_start(a: np.ndarray, b: np.ndarray) -> int:
    """How many characters two texts begin with alike."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if other.size else n


class Grams:
    """The items of a block that share a gram length: their q-grams with postings, edit budgets and bounds.

    Items are in an order in which those that begin alike stand together, with the length that each shares with the one
    before it, so that ``align`` takes a common beginning once.
    """

    def __init__(self, codes: list[np.ndarray], edits: np.ndarray, q: int):
        self.q, self.edits, self.text = q, edits, np.concatenate(codes)
        self.length = np.array([len(c) for c in codes], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bound = self.length - q + 1 - q * edits
        self.band = 2 * np.maximum(edits, 1)
        self.reach = int((self.length + edits).max())
        grams = [gram_hashes(c, q) for c in codes]
        counts = [len(g) for g in grams]
        flat = np.concatenate([*grams, np.empty(0, np.uint64)])
        item, place = np.repeat(np.arange(len(codes)), counts), ranges(np.zeros(len(codes), np.int64), np.array(counts, np.int64))
        order = np.argsort(flat, kind="stable")
        self.keys, self.many = np.unique(flat[order], return_counts=True)
        self.item, self.place = item[order], place[order]
        self.posting = np.repeat(np.arange(self.keys.size), self.many) * len(codes) + self.item  # ascending
        self.flag = np.zeros(1 << FLAG_BITS, bool)
        self.flag[self._slot(self.keys)] = True
        self.least = [np.array([0, *map(common_start, codes, codes[1:])], np.int64)]  # of 1, 2, 4, ... items
        while 2 << len(self.least) - 1 <= len(codes):
            half, step = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(half[:-step], half[step:]))

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FLAG_BITS)).astype(np.int64)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common beginning of the items a <= b."""
        out = self.length[b].copy()
        for level, least in enumerate(self.least):
            own = np.flatnonzero((b - a) >> level == 1)
            out[own] = np.minimum(least[a[own] + 1], least[b[own] + 1 - (1 << level)])
        return out

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, lowest diagonal of the band) where a band shares at least the bound's number of q-grams.

        Postings are counted about ``POSTINGS`` at a time: in windows of the document that overlap by the longest item
        with its edits, so that one of them holds all grams of an occurrence, and in ranges of items.
        """
        none = np.empty(0, np.int64)
        grams = gram_hashes(codes, self.q)
        if not self.keys.size or not grams.size:
            return none, none
        at = np.flatnonzero(self.flag[self._slot(grams)])
        key = np.minimum(np.searchsorted(self.keys, grams[at]), self.keys.size - 1)
        hit = self.keys[key] == grams[at]
        at, key = at[hit], key[hit]
        before = np.append(0, np.cumsum(self.many[key]))
        found, first = [(none, none)], 0
        while first < at.size:
            core = int(np.searchsorted(before, before[first] + POSTINGS, "right")) - 1
            core = max(core, int(np.searchsorted(at, at[first] + self.reach)))
            last = int(np.searchsorted(at, at[core] + self.reach)) if core < at.size else at.size
            found += self._counted(at[first:last], key[first:last], 0, len(self.length))
            first = core if last < at.size else last
        item, low = map(np.concatenate, zip(*found))
        if len(found) > 3:
            both = np.unique(np.stack([item, low], axis=1), axis=0)
            item, low = both[:, 0], both[:, 1]
        return item, low

    def _counted(self, at: np.ndarray, key: np.ndarray, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The candidates among the items from ``low`` up to ``high``, of the grams ``key`` at ``at``."""
        first, last = (np.searchsorted(self.posting, key * len(self.length) + k) for k in (low, high))
        many = last - first
        if many.sum() > POSTINGS and high - low > 1:
            middle = (low + high) // 2
            return self._counted(at, key, low, middle) + self._counted(at, key, middle, high)
        if not many.any():
            return []
        posting = ranges(first, many)
        item = self.item[posting]
        band = self.band[item]
        diagonal = np.repeat(at, many) - self.place[posting]
        out = []
        for half in (0, 1):
            # bands are cut at multiples of their width, wherever the window begins
            place = (diagonal + half * (band // 2)) // band
            floor = int(place.min())
            width = int(place.max()) - floor + 1
            code = (item - low) * width + place - floor
            if (high - low) * width <= 4 * code.size:
                counts = np.bincount(code)
                keys = np.flatnonzero(counts)
                counts = counts[keys]
            else:
                keys, counts = np.unique(code, return_counts=True)
            own, place = keys // width + low, keys % width + floor
            full = counts >= self.bound[own]
            own, place = own[full], place[full]
            out.append((own, place * self.band[own] - half * (self.band[own] // 2)))
        return out

    def align(self, around: np.ndarray, margin: int, item: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each item within its band, and where in the document the item then ends; of bands that hold
        no occurrence within the budget, some number above it. ``around`` is the document with ``margin`` zeros on both sides.

        The items allow the same edits and are in the order of (low, item). Row i of the table has the first i characters
        of an item, column k the document up to ``low - edits + i + k``. Items of one band that begin alike are one row
        of the table up to where they part; rows that are above the budget everywhere end.
        """
        edits = int(self.edits[item[0]])
        width = int(self.band[item[0]]) + 2 * edits + 1
        kind = np.int16 if width < 1 << 13 else np.int32
        column, length = np.arange(width, dtype=kind), self.length[item]
        begin = low - edits + margin
        parts = np.append(-1, np.where(low[1:] == low[:-1], self.shared(item[:-1], item[1:]), -1))
        order = np.argsort(parts, kind="stable")
        splits = np.split(order, np.searchsorted(parts[order], np.arange(int(length.max()) + 1)))
        best, end = np.full(len(item), edits + 1), low - edits
        first, last = splits[0], np.append(splits[0][1:], len(item))
        cost = np.zeros((len(first), width), kind)
        for i in range(int(length.max()) + 1):
            new = splits[i + 1]
            if new.size and first.size:
                parent = np.searchsorted(first, new, "right") - 1
                inside = (parent >= 0) & (new < last[parent])
                new, parent = new[inside], parent[inside]
                place = np.searchsorted(first, new)
                first, own_last = np.insert(first, place, new), np.insert(last, place, last[parent])
                cost = np.insert(cost, place, cost[parent], axis=0)
                last = np.minimum(own_last, np.append(first[1:], len(item)))
            ends = length[first] == i
            if ends.any():
                k = cost[ends].argmin(axis=1)
                best[first[ends]], end[first[ends]] = cost[ends].min(axis=1), low[first[ends]] - edits + i + k
                first, last, cost = first[~ends], last[~ends], cost[~ends]
            if not first.size:
                break
            char = self.text[self.begin[item[first]] + i]
            step = cost + (around[(begin[first] + i)[:, None] + column] != char[:, None])
            np.minimum(step[:, :-1], cost[:, 1:] + 1, out=step[:, :-1])
            step -= column
            cost = np.minimum.accumulate(step, axis=1)
            cost += column
            live = cost.min(axis=1) <= edits
            if not live.all():
                first, last, cost = first[live], last[live], cost[live]
        return best, end

    def found(self, codes: np.ndarray):
        """Arrays (item, edits, end in ``codes``) of the bands that hold their item within the budget."""
        item, low = self.candidates(codes)
        order = np.lexsort((item, low, self.edits[item]))
        item, low = item[order], low[order]
        edits = self.edits[item]
        margin = 5 * self.reach + 4  # a band begins within the longest item before the document and is 4 budgets wide
        around = np.pad(codes, margin) if item.size else codes
        for e in np.unique(edits).tolist():
            a, b = np.searchsorted(edits, [e, e + 1])
            group = max(64, CELLS // (4 * e + 3))
            for k in range(a, b, group):
                part = slice(k, min(k + group, b))
                fewest, end = self.align(around, margin, item[part], low[part])
                good = fewest <= e
                yield item[part][good], fewest[good], end[good]


class Items:
    """A block of items. The gram length is q, or less where an item and its edit budget need it: the longest that keeps
    the bound positive. Items shorter than q have no edits and are searched with a space on both sides, as whole words."""

    def __init__(self, texts: list[str], q: int, rate: float):
        self.q = q
        plain = [normal(t) for t in texts]
        self.edits = np.array([int(len(t) * rate) for t in plain], np.int64)
        self.short = np.array([len(t) < q for t in plain], bool)
        codes = [code_points(f" {t} " if s else t) for t, s in zip(plain, self.short)]
        grams = np.array([min(q, len(c) // (e + 1)) if t else 0 for c, e, t in zip(codes, self.edits.tolist(), plain)], np.int64)
        self.parts = []
        for n, s in sorted(set(zip(grams.tolist(), self.short.tolist()))):
            own = np.array(sorted(np.flatnonzero((grams == n) & (self.short == s)).tolist(), key=plain.__getitem__))
            if n:
                self.parts.append((own, s, Grams([codes[i] for i in own], self.edits[own], n)))

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, end) of each item found, ``end`` in characters of the normal form: its best occurrence."""
        gap = "\0" * (self.q + 2)
        plain = [normal(t) for t in texts]
        sizes = np.array([len(t) + len(gap) for t in plain], np.int64)
        begin = np.cumsum(sizes) - sizes + 1
        codes = code_points("\0" + gap.join(plain) + gap)
        spaced = codes.copy()  # a space before and after each text
        spaced[begin - 1] = spaced[begin + sizes - len(gap)] = ord(" ")
        rows = [np.empty((0, 4), np.int64)]
        for own, short, grams in self.parts:
            for item, edits, end in grams.found(spaced if short else codes):
                text = np.searchsorted(begin, end - short - 1, "right") - 1
                rows.append(np.stack([text, own[item], edits, end - short - begin[text]], axis=1))
        rows = np.concatenate(rows)
        rows = rows[np.lexsort(rows.T[::-1])]  # the fewest edits and the first end come first
        best = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]
        return [tuple(r) for r in rows[best].tolist()]


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int):
    """Lists of (id, text), each of about ``block_chars`` characters at most, one at a time."""
    items = benchmark.select(benchmark[id_col].alias("id"), benchmark[text_col].alias("text")).where(
        F.length("text") > 0)
    total = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    parts = max(1, -(-2 * total // block_chars))
    block = F.pmod(F.xxhash64("text", "id"), F.lit(parts))
    for k in range(parts if total else 0):
        rows, size = [], 0
        for r in items.where(block == k).toLocalIterator():
            if rows and size + len(r.text) > block_chars:
                yield rows
                rows, size = [], 0
            rows.append((r.id, r.text))
            size += len(r.text)
        if rows:
            yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item id, edits, end) for each document row and item that it holds: the fewest edits, and where that
    occurrence ends in the document's normal form."""
    spark = docs.sparkSession
    prepare(spark)
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    names = [id_col, item_col, "edits", "end"]
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def search(block):
        sent = spark.sparkContext.broadcast(([i for i, _ in block], Items([t for _, t in block], q, rate)))

        def run(batches):
            ids, items = sent.value
            for b in slices(batches, "text", 1 << 20):
                if found := items.search(texts_of(b, "text")):
                    text, item, edits, end = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").take(pa.array(text)), pa.array([ids[i] for i in item], item_type),
                         pa.array(edits, pa.int32()), pa.array(end, pa.int64())], ["id", "item", "edits", "end"])

        return rows.mapInArrow(run, f"id {kind}, item {item_kind}, edits int, end long")

    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    out = None
    for block in blocks_of(benchmark, item_col, item_text_col, block_chars):
        part = search(block)
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], f"id {kind}, item {item_kind}, edits int, end long")
    return out.toDF(*names)


def clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    for block in blocks_of(benchmark, item_col, item_text_col, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(Items([t for _, t in block], q, rate))

        def start(sent=sent):
            def free(texts):
                out = np.ones(len(texts), bool)
                out[[found[0] for found in sent.value.search(texts)]] = False
                return out
            return free

        docs = filtered(docs, text_col, start)
    return docs
