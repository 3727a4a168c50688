"""Vector code compression: product quantisation in whole numbers, assigned through a trie of the distinct parts.

A component x becomes floor(``SCALE`` x); a vector is cut into ``PARTS`` equal consecutive parts, each coded by the nearest
of the ``ENTRIES`` entries of its position's codebook (squared Euclidean distance, ties to the lower index). A codebook
starts as that part of the vectors with the smallest ids and takes ``ROUNDS`` rounds of assignment and averaging (floored,
unused entries stay).

Only the distinct parts with their counts are assigned, once a round: they are aggregated, dealt out by range and sorted,
so a task holds a run of the leaves of their lexicographic trie. The traversal goes down depth first; a node's distances
to all entries over the dimensions up to it are its parent's plus one dimension, so a common prefix is worked out once.
Leaves take the smallest distance and add their part, times its count, to that entry. A task sends on one row for each
entry, and the driver holds the codebooks only. The codes are then assigned row by row without a shuffle. The sums of a
label are joined back: labels of more than one in ``HOT`` rows (fewer than ``HOT`` labels) by broadcast, the rest by key.

Rows whose vector is NULL, empty or holds NULL or non-finite components are dropped, and so are vectors of another length
than most (ties: the shorter), or, if that is no multiple of ``PARTS``, all. Rows without id are kept and come last; rows of
one id go by their vectors. Repeated rows give repeated rows; fewer rows than entries give a smaller codebook; an empty
table gives no rows. Sums are exact at any size (Python integers where 64 bits don't hold them); a component beyond a long
counts as the nearest long, an error beyond one as the largest. Other input columns are not read.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import prepare, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: leaves of the trie that are worked on at once
BLOCK = 1024
HOT = 10_000
LONG = (1 << 63) - 1


def squares_type(parts: np.ndarray, book: np.ndarray):
    """The smallest type that holds every distance between the two."""
    widest = max((abs(int(x)) for m in (parts, book) if m.size for x in (m.min(), m.max())), default=0)
    most = 4 * widest * widest * max(1, parts.shape[1])
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object


def nearest_entries(parts: np.ndarray, book: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every row of ``parts``, which are distinct and in lexicographic order."""
    count, dims = parts.shape
    kind = squares_type(parts, book)
    parts, book = parts.astype(kind), book.astype(kind)
    if not dims:
        return np.zeros(count, np.int64), np.zeros(count, kind)
    best, least = np.empty(count, np.int64), np.empty(count, kind)
    # the first dimension in which a row differs from the one before it
    fork = np.zeros(count, np.int64)
    if count > 1:
        fork[1:] = (parts[1:] != parts[:-1]).argmax(axis=1)

    def step(values: np.ndarray, depth: int) -> np.ndarray:
        return (values[:, None] - book[None, :, depth]) ** 2

    def below(a: int, b: int, depth: int, so_far: np.ndarray) -> None:
        """Leaves a to b, few enough to hold: all nodes of a depth at once, each from its parent."""
        node, reached = np.zeros(b - a, np.int64), so_far[None]
        for d in range(depth, dims):
            new = fork[a:b] <= d
            new[0] = True
            heads = np.flatnonzero(new)
            values, which = np.unique(parts[a + heads, d], return_inverse=True)
            parents = node[heads]
            node = np.cumsum(new) - 1
            reached = reached.take(parents, axis=0)
            reached += step(values, d).take(which, axis=0)
        own = reached.argmin(axis=1)
        best[a:b], least[a:b] = own, reached[np.arange(b - a), own]

    def visit(a: int, b: int, depth: int, so_far: np.ndarray) -> None:
        """The node over leaves a to b, whose entry distances over the dimensions before ``depth`` are ``so_far``."""
        if b - a <= block:
            below(a, b, depth, so_far)
            return
        child = np.concatenate([[a], a + 1 + np.flatnonzero(fork[a + 1: b] <= depth), [b]])
        at = 0
        while at < len(child) - 1:
            upto = max(at + 1, int(np.searchsorted(child, child[at] + block, side="right")) - 1)
            if upto == at + 1:
                value = parts[child[at]: child[at] + 1, depth]
                visit(child[at], child[upto], depth + 1, so_far + step(value, depth)[0])
            else:  # children of few leaves go together
                below(child[at], child[upto], depth, so_far)
            at = upto

    if count:
        visit(0, count, 0, np.zeros(len(book), kind))
    return best, least


def weighted_sums(parts: np.ndarray, counts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries in use, and of each the number of its parts and their sum."""
    order = np.argsort(own, kind="stable")
    parts, counts, own = parts[order], counts[order], own[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    widest = max(abs(int(parts.max())), abs(int(parts.min()))) if parts.size else 0
    if widest * int(counts.sum()) > LONG:
        parts, counts = parts.astype(object), counts.astype(object)
    return own[first], np.add.reduceat(counts, first), np.add.reduceat(parts * counts[:, None], first, axis=0)


def sorted_distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and each row's place among them."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def whole(vector: Column) -> Column:
    """floor(``SCALE`` x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def cells(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


class Codebooks(list):
    """One array of whole numbers (entry, dimension) for each part position."""

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and dimension, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for book in self for x in book.ravel()).encode()).hexdigest()


def parts_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(id, label, v) of the rows that take part, as whole numbers, and the vectors' length."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].alias("v"))
    rows = rows.where(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common.dims if common is not None and common.dims % PARTS == 0 else 0
    return rows.where(F.size("v") == dims).select("id", "label", whole(F.col("v")).alias("v")), dims


def distinct_parts(rows: DataFrame, dims: int) -> DataFrame:
    """(pos, part, n): every distinct part of a position with its count, sorted by range."""
    width = dims // PARTS
    cut = F.array(*[F.slice("v", p * width + 1, width) for p in range(PARTS)])
    counted = rows.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n"))
    return written(counted.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "vector-parts")[0]


def refine(distinct: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """One round: every distinct part to its nearest entry, every used entry to the floored mean of its parts."""
    total = "decimal(38,0)"
    names = [f"s{d}" for d in range(width)]

    def run(batches):
        held = {}
        for b in batches:
            pos, n = b.column("pos").to_numpy(), b.column("n").to_numpy()
            part = cells(b.column("part"), width)
            for p in np.unique(pos).tolist():
                at = pos == p
                own, _ = nearest_entries(part[at], books[p])
                for entry, count, sums in zip(*weighted_sums(part[at], n[at], own)):
                    have = held.setdefault((p, int(entry)), [0, np.zeros(width, object)])
                    have[0] += int(count)
                    have[1] += sums.astype(object)
        if held:
            keys = sorted(held)
            digits = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.int32()),
                 pa.array([Decimal(held[k][0]) for k in keys], digits),
                 *[pa.array([Decimal(held[k][1][d]) for k in keys], digits) for d in range(width)]],
                ["pos", "entry", "n", *names])

    schema = f"pos int, entry int, n {total}, " + ", ".join(f"{c} {total}" for c in names)
    sums = distinct.mapInArrow(run, schema).groupBy("pos", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
    new = Codebooks(book.copy() for book in books)
    for r in sums.collect():  # at most PARTS * ENTRIES rows
        new[r.pos][r.entry] = [int(r[c]) // int(r.n) for c in names]
    return new


def fit(rows: DataFrame, dims: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the rows that ``parts_of`` gives."""
    width = dims // PARTS
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    start = np.array([r.v for r in first], np.int64).reshape(len(first), dims)
    books = Codebooks(start[:, p * width: (p + 1) * width].copy() for p in range(PARTS))
    if len(first):
        distinct = distinct_parts(rows, dims)
        for _ in range(rounds):
            books = refine(distinct, books, width)
    return books


def encode(rows: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """(id, label, code, error) of every row, without a shuffle."""
    width = dims // PARTS
    kinds = dict(rows.dtypes)

    def run(batches):
        for b in batches:
            v = cells(b.column("v"), dims)
            codes, errors = np.zeros((len(v), PARTS), np.uint8), np.zeros(len(v), object)
            for p in range(PARTS):
                leaves, place = sorted_distinct(v[:, p * width: (p + 1) * width])
                own, far = nearest_entries(leaves, books[p])
                codes[:, p] = own[place]
                errors += far.astype(object)[place]
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"),
                 pa.array([text[i: i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], pa.string()),
                 pa.array([min(int(e), LONG) for e in errors], pa.int64())], ["id", "label", "code", "error"])

    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_label_error(codes: DataFrame, hot: int = HOT) -> DataFrame:
    """``codes`` (read twice: a written table) with the sum of ``error`` over the rows of its label."""
    longest = F.lit(LONG).cast("decimal(38,0)")
    sums = codes.groupBy(F.col("label").alias("of")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), longest).cast("long").alias("label_error"))
    least = codes.count() / hot
    often, seldom = sums.where(F.col("rows") > least), sums.where(F.col("rows") <= least)
    same = F.col("label").eqNullSafe(F.col("of"))
    columns = [*codes.columns, "label_error"]
    known = codes.join(F.broadcast(often), same).select(columns)  # fewer than ``hot`` labels
    rest = codes.join(F.broadcast(often.select("of")), same, "left_anti").join(seldom, same).select(columns)
    return known.union(rest)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, label_error) of every row that takes part, and the codebooks."""
    prepare(vectors.sparkSession)
    rows, dims = parts_of(vectors, id_col, vector_col, label_col)
    books = fit(rows, dims, entries, rounds)
    codes, _ = written(encode(rows, books, dims), "vector-codes")
    return with_label_error(codes).withColumnRenamed("id", id_col).withColumnRenamed("label", label_col), books
