"""SimHash near-duplicates: fingerprints of word shingles, linked by tiled exact comparison.

Distinct fingerprints are compared, each with the smallest id of its documents, so copies meet in a partial
aggregation. A tile holds fingerprints with the same population counts of the four 16-bit quarters, further cut by a
hash to about ``TILE`` rows. Two fingerprints within the radius differ in those counts by the radius at most (summed),
so a tile meets only the tiles whose counts are that near: all others are skipped. A meeting compares all pairs by
numpy exclusive-or and bit counts. A task keeps one tile and streams its visitors; it emits a spanning set of its links
(at most one per row), not all pairs of a group. ``components.py`` joins the links of all tiles.

Texts that are NULL or have no words have fingerprint zero, linked like any other. A text of fewer words than a shingle
is one shingle. Long texts are read whole. NULL ids take part; a component's id is its smallest known id, NULL if it has
none. Repeated rows give repeated rows. Other input columns are not read.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens.llm.components import components, label_components
from productlens.llm.tasks import LOWER, drop_folder, prepare, slices, texts_of, written

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
#: Rows of a tile; fingerprint pairs that a task compares at once.
TILE, PAIRS = 4096, 1 << 22
QUARTERS, CELL_BITS = 4, 5
SALTS = 64


def shingle_hashes(text: str, width: int) -> list[int]:
    words = WORDS.findall(text.translate(LOWER).encode())
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = list(itertools.accumulate((len(w) + 1 for w in words)))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], SEED) for a, b in zip([0, *ends], ends[width - 1:])]


def fingerprints_of(texts: list[str], width: int) -> np.ndarray:
    """The 64-bit fingerprint of each text: bits that over half of its shingle hashes have set."""
    hashes = [shingle_hashes(t, width) for t in texts]
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter(itertools.chain.from_iterable(hashes), np.uint64, int(counts.sum()))
    full = np.flatnonzero(counts)
    out = np.zeros(len(texts), np.uint64)
    if full.size:
        starts = (np.cumsum(counts) - counts)[full]
        for bit in range(64):
            ones = np.add.reduceat((flat >> np.uint64(bit)) & np.uint64(1), starts)
            out[full] |= (2 * ones > counts[full].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text",
                 **also: Column) -> DataFrame:
    """(id, fp): the fingerprint of each row's whole text as a long; the columns ``also`` come before fp."""
    prepare(docs.sparkSession)
    kept = ["id", *also]

    def run(batches):
        for b in slices(batches, "text", 1 << 20):
            fp = fingerprints_of(texts_of(b, "text"), width)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(fp.view(np.int64))], [*kept, "fp"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *(c.alias(k) for k, c in also.items()))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in kept) + ", fp long")


def offsets(radius: int) -> list[int]:
    """Steps between cells whose population counts differ by the radius at most, summed: zero and one of each
    opposite pair."""
    reach = range(-radius, radius + 1)
    near = [d for d in itertools.product(reach, repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    steps = [sum(x << (CELL_BITS * k) for k, x in enumerate(d)) for d in near]
    return sorted(s for s in steps if s >= 0)


def tiled(fps: DataFrame, radius: int) -> DataFrame:
    """Rows for the tiles' tasks: (cell, tile, visitor, fp). Each fingerprint once in its own tile, and as a visitor in
    the tiles that it is compared with."""
    def quarter(k: int):
        return F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)))

    placed = fps.select("fp", sum((quarter(k) * (1 << (CELL_BITS * k)) for k in range(1, QUARTERS)), quarter(0))
                        .cast("int").alias("cell"))
    # at most 17 ** 4 rows of two numbers
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = (placed.join(F.broadcast(cells), "cell")
           .withColumn("tile", F.pmod(F.xxhash64(F.xxhash64("fp")), F.col("tiles").cast("long")).cast("int")))
    homes = own.select("cell", "tile", F.lit(0).alias("visitor"), "fp")
    goals = cells.select(F.col("cell").alias("goal"), F.col("tiles").alias("goal_tiles"))
    visits = (own.select("cell", "tile", "fp", F.explode(F.array(*map(F.lit, offsets(radius)))).alias("step"))
              .withColumn("goal", F.col("cell") + F.col("step"))
              .join(F.broadcast(goals), "goal")
              .select(F.col("goal").alias("cell"), F.lit(1).alias("visitor"), "fp", F.explode(F.sequence(
                  F.lit(0), F.when(F.col("step") == 0, F.col("tile")).otherwise(F.col("goal_tiles") - 1))).alias("tile"))
              .select("cell", "tile", "visitor", "fp"))
    return homes.union(visits)


class Tile:
    """One tile's fingerprints and the links found so far among them and to visitors."""

    def __init__(self):
        self.rows, self.a, self.b, self.links = np.empty(0, np.uint64), [], [], []

    def settle(self, fps: np.ndarray) -> None:
        self.rows = np.concatenate([self.rows, fps])

    def meet(self, fps: np.ndarray, radius: int) -> None:
        step = max(1, PAIRS // max(1, self.rows.size))
        for at in range(0, fps.size, step):
            guests = fps[at: at + step]
            near = np.bitwise_count(np.bitwise_xor.outer(guests, self.rows)) <= radius
            guest, row = np.nonzero(near)
            if guest.size == 0:
                continue
            # the guest's first row stands for all it is linked with
            begin = np.append(0, np.flatnonzero(np.diff(guest)) + 1)
            first, linked = row[begin], guests[guest[begin]]
            differ = linked != self.rows[first]
            self.links.append(np.column_stack([linked[differ], self.rows[first][differ]]))
            pairs = np.unique(row * self.rows.size + np.repeat(first, np.diff(np.append(begin, guest.size))))
            self.a.append(pairs // self.rows.size)
            self.b.append(pairs % self.rows.size)

    def found(self) -> np.ndarray:
        if not self.links:
            return np.empty((0, 2), np.uint64)
        label = label_components(self.rows.size, np.concatenate(self.a), np.concatenate(self.b))
        moved = np.flatnonzero(label != np.arange(label.size))
        inner = np.column_stack([self.rows[moved], self.rows[label[moved]]])
        return np.unique(np.concatenate([*self.links, inner]), axis=0)


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all that differ in ``radius`` bits at most: a
    spanning set of each tile's links."""
    def run(batches):
        tile, key = Tile(), None
        for batch in batches:
            cells, tiles, visitor, fp = (c.to_numpy() for c in batch.columns)
            both = cells.astype(np.int64) << 32 | tiles
            cuts = np.flatnonzero((np.diff(both) != 0) | (np.diff(visitor) != 0)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(both)]):
                if a == b:
                    continue
                if both[a] != key:
                    yield from emit(tile)
                    tile, key = Tile(), both[a]
                own = fp[a:b].view(np.uint64)
                if visitor[a]:
                    tile.meet(own, radius)
                else:
                    tile.settle(own)
        yield from emit(tile)

    def emit(tile):
        found = tile.found().view(np.int64)
        if found.size:
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return (tiled(fps, radius).repartition("cell", "tile").sortWithinPartitions("cell", "tile", "visitor")
            .mapInArrow(run, "a long, b long"))


def roots_of(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint ``fp`` that is linked; those of one component share their root."""
    edges, edges_path = written(links(fps, radius), "simhash-links")
    roots = components(edges).select(F.col("node").alias("fp"), "root")
    drop_folder(fps.sparkSession, edges_path)
    return roots


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row: fingerprint as 16 hex digits, component_id the smallest id that
    links within ``radius`` bits reach."""
    rows, _ = written(fingerprints(docs, width, id_col, text_col), "simhash-rows")
    distinct, _ = written(rows.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    roots = roots_of(distinct.select("fp"), radius)
    # a component may hold many fingerprints: its smallest id comes back to them by a salted join
    salt = F.pmod(F.xxhash64(F.xxhash64("fp")), F.lit(SALTS)).cast("int")
    linked = distinct.join(roots, "fp").withColumn("salt", salt)
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id")).withColumn(
        "salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    classes = (linked.join(smallest, ["root", "salt"]).select("fp", "component_id")
               .unionByName(distinct.join(roots, "fp", "left_anti").select("fp", F.col("id").alias("component_id"))))
    return (rows.join(classes, "fp", "left")
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, all columns as they are: the first by (id, fingerprint, content).

    A row is known by its number in a written copy of ``docs``, not by its id, so one id may be in several groups and
    each keeps its own row. Rows without id are not compared with those that have one: a group keeps one row of each
    kind that it holds. Rows that differ in nothing are told apart by their number alone.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered, _ = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-numbered")
    # NULLs count for nothing in a hash: where they are is hashed as well
    content = F.xxhash64(*(numbered[c].isNull() for c in docs.columns), *(numbered[c] for c in docs.columns))
    rows, rows_path = written(fingerprints(numbered, width, id_col, text_col, content=content, row=numbered[row]), "simhash-rows")
    unsigned = F.col("fp").bitwiseXOR(F.lit(-1 << 63)).alias("fp")
    distinct, _ = written(rows.groupBy("fp", F.col("id").isNull().alias("unnamed"))
                          .agg(F.min(F.struct("id", unsigned, "content", "row")).alias("first")), "simhash-distinct")
    roots = roots_of(distinct.select("fp").distinct(), radius)
    chosen = (distinct.join(roots, "fp").groupBy("root", "unnamed").agg(F.min("first").alias("first")).select("first.row")
              .unionByName(distinct.join(roots, "fp", "left_anti").select("first.row")))
    # the rows that go are fewer than those that stay and are written, so their size is known to the join of the texts
    dropped, _ = written(rows.select("row").join(chosen, "row", "left_anti"), "simhash-dropped")
    drop_folder(docs.sparkSession, rows_path)
    return numbered.join(dropped.withColumnRenamed("row", row), row, "left_anti").select(*docs.columns)
