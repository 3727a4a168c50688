"""Language-model scores of whole texts by a hidden Markov model over words.

A hidden state emits one of ``CLASSES`` word classes (a hash of the word; the end of a text is a class of its own), and
the class gives the word by its smoothed count in the training texts:
P(word | state) = P(class | state) * (c + 0.1) / (C + 0.1 * (V + 1)) with the class's tokens C and distinct words V.
So the model stays as small as classes by states, while the word counts are exact and grow with the corpus.

Steps, each over all documents:
1. Texts become chunks: token codes, the chunk's distinct words, their training counts. Written to the shared folder in
   rows of bounded size, each readable alone: the codes go by class, so a row of texts needs only each class's first.
2. Word counts are summed by a window over each word's rows; they come back to the chunk's tokens by its number. What
   moves is a row for each distinct word of a chunk, never one for each token.
3. The states start from clusters of the classes: each class's mean position among random directions of the pieces of
   text it is in. Then ``ROUNDS`` of Baum-Welch over whole texts: a task cuts them into pieces of ``PIECE`` tokens, so
   that memory is bounded and long texts advance side by side, and carries the forward and backward vectors over the
   cuts by each piece's transfer matrix, so the counts are those of the uncut texts. Tasks send expected counts, at
   most one row for each class; they are summed across partitions, and the sums (classes by states numbers) make the
   next model, which goes to all tasks.
4. The scaled forward recursion over the whole text gives its exact likelihood.

NULL and empty texts are the end token alone. NULL ids are held out. Without training texts every class is equally
likely. Long texts are scored whole; repeated rows give repeated rows. Other input columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from productlens.llm.nearest import k_means, squared
from productlens.llm.tasks import held_out, list_array, prepare, slices, written

STATES, CLASSES, ROUNDS, PIECE, DIRECTIONS = 8, 1 << 14, 4, 256, 8
END = CLASSES
#: a chunk ends when it has so many tokens or distinct words; tokens that forward-backward works on at once
CHUNK_TOKENS, CHUNK_WORDS, BLOCK_TOKENS = 2_000_000, 400_000, 100_000
#: bytes of text that end a chunk, so that long words do not fill memory
CHUNK_BYTES = 64 << 20
#: tokens of a chunk's row of texts (more only for a single longer text), bytes of its row of words
ROW_TOKENS, ROW_BYTES = 1 << 18, 1 << 18
#: Spark's readers and writers hold a row group at once: by default 100 rows at least, of any size
CHUNK_FILES = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1",
               "parquet.page.size.row.check.max": "4", "parquet.enable.dictionary#tokens.list.element": "false",
               "parquet.enable.dictionary#words.list.element": "false"}
#: prior weight of uniform starts and moves
MOVE_PRIOR = 1.0
#: stands for the end of a text: no word has a space
END_WORD = " "
ADD = 0.1


def tokens_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased (A-Z) words, each word occurrence's number among them, and each occurrence's text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    real = (pc.binary_length(coded.dictionary).to_numpy() > 0)[code]
    return coded.dictionary.to_pylist(), code[real], owner[real]


class Chunk:
    """Documents whose tokens share one list of distinct words."""

    def __init__(self):
        self.ids, self.held, self.lengths, self.tokens = [], [], [], []
        self.words, self.size, self.bytes = {END_WORD: 0}, 0, 0

    def full(self) -> bool:
        return self.size >= CHUNK_TOKENS or len(self.words) >= CHUNK_WORDS or self.bytes >= CHUNK_BYTES

    def add(self, batch: pa.RecordBatch) -> None:
        distinct, code, owner = tokens_of(batch.column("text"))
        known = self.words
        local = np.fromiter((known.setdefault(w, len(known)) for w in distinct), np.int32, len(distinct))
        lengths = np.bincount(owner, minlength=batch.num_rows) + 1
        tokens = np.zeros(int(lengths.sum()), np.int32)  # 0, the end, at the last place of each text
        inner = np.ones(tokens.size, bool)
        inner[np.cumsum(lengths) - 1] = False
        tokens[inner] = local[code]
        self.ids.append(batch.column("id"))
        self.held.append(batch.column("held").to_numpy(zero_copy_only=False))
        self.lengths.append(lengths)
        self.tokens.append(tokens)
        self.size += tokens.size
        self.bytes += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0

    def rows(self, number: int):
        """Rows of its words, then rows of its texts; words are numbered by class, then by first sight."""
        classes = np.array([zlib.crc32(w.encode()) for w in self.words]) % CLASSES
        classes[0] = END
        order = np.argsort(classes, kind="stable")
        classes = classes[order]
        code = np.empty(len(order), np.int32)
        code[order] = np.arange(len(order), dtype=np.int32)
        lengths, held, ids = np.concatenate(self.lengths), np.concatenate(self.held), pa.concat_arrays(self.ids)
        tokens = code[np.concatenate(self.tokens)]
        counts = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(code))
        first = one(np.searchsorted(classes, np.arange(CLASSES + 1)))
        words = pa.array(list(self.words), pa.string()).take(pa.array(order))

        def row(**columns) -> pa.RecordBatch:
            full = [columns.get(f.name, pa.nulls(1, f.type)) for f in row_schema(ids.type)]
            return pa.RecordBatch.from_arrays([pa.array([number]), *full[1:]], schema=row_schema(ids.type))

        for part, _ in blocks(pc.binary_length(words).to_numpy().astype(np.int64) + 12, ROW_BYTES):
            yield row(at=pa.array([part.start], pa.int32()), words=one(words[part]), kinds=one(classes[part]), trained=one(counts[part]))
        for texts, inner in blocks(lengths, ROW_TOKENS):
            yield row(ids=one(ids[texts]), held=one(pa.array(held[texts])), lengths=one(lengths[texts]),
                      tokens=one(tokens[inner]), classes=first)


def one(values) -> pa.ListArray:
    """A single list of all values; those of numpy become int32."""
    if isinstance(values, np.ndarray):
        return list_array(values, [len(values)])
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def row_schema(id_type: pa.DataType) -> pa.Schema:
    """A row of a chunk holds texts (``classes``: the first code of each class) or words (``at``: the first one's code)."""
    ints = pa.list_(pa.int32())
    return pa.schema([("chunk", pa.int64()), ("ids", pa.list_(id_type)), ("held", pa.list_(pa.bool_())), ("lengths", ints),
                      ("tokens", ints), ("classes", ints), ("at", pa.int32()), ("words", pa.list_(pa.string())),
                      ("kinds", ints), ("trained", ints)])


def chunks(docs: DataFrame, folds: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of each chunk of documents."""
    def run(batches):
        part, number, chunk = TaskContext.get().partitionId(), 0, Chunk()
        for b in slices(batches, "text"):
            if chunk.size and chunk.full():
                yield from chunk.rows(part << 32 | number)
                number, chunk = number + 1, Chunk()
            chunk.add(b)
        if chunk.size:
            yield from chunk.rows(part << 32 | number)

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                       held_out(docs[id_col], folds).alias("held")).mapInArrow(
        run, f"chunk long, ids array<{kind}>, held array<boolean>, lengths array<int>, tokens array<int>,"
             " classes array<int>, at int, words array<string>, kinds array<int>, trained array<int>")


def flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def class_of_code(first: np.ndarray) -> np.ndarray:
    """The class of each code, given the first code of each class; the end of a text is the last class's only word."""
    return np.repeat(np.arange(len(first)), np.diff(np.append(first, first[-1] + 1)))


def training_texts(batch: pa.RecordBatch):
    """(classes, lengths, goes_on) of the training texts of some rows, cut into pieces of at most ``PIECE`` tokens; a piece
    that goes on continues the text of the piece before it."""
    classes, lengths = [], []
    for i in range(batch.num_rows):
        b = batch.slice(i, 1)
        size, held = flat(b.column("lengths")), flat(b.column("held"))
        classes.append(class_of_code(flat(b.column("classes")))[flat(b.column("tokens"))[np.repeat(~held, size)]])
        lengths.append(size[~held].astype(np.int64))
    classes, lengths = np.concatenate(classes), np.concatenate(lengths)
    if not lengths.size:
        return
    parts = -(-lengths // PIECE)
    size = np.full(int(parts.sum()), PIECE)
    size[np.cumsum(parts) - 1] = lengths - PIECE * (parts - 1)
    goes_on = np.ones(size.size, bool)
    goes_on[np.cumsum(parts) - parts] = False
    yield classes, size, goes_on


def blocks(lengths: np.ndarray, limit: int | None = None):
    """(pieces, tokens) as slices, of about ``limit`` (``BLOCK_TOKENS``) tokens each."""
    start = np.cumsum(lengths) - lengths
    cuts = [0, *(np.flatnonzero(np.diff(start // (limit or BLOCK_TOKENS))) + 1).tolist(), lengths.size]
    for a, b in zip(cuts, cuts[1:]):
        yield slice(a, b), slice(int(start[a]), int(start[b - 1] + lengths[b - 1]))


class Model:
    """Start, move and emission probabilities (the last by class, then state)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def from_counts(cls, start, move, emit, shares) -> Model:
        # a state's emissions fall back on the overall class shares, with the weight of the classes it has (Witten-Bell)
        emit = emit + np.minimum(emit, 1).sum(axis=0) * shares[:, None]
        move = move + MOVE_PRIOR / STATES
        start = start + MOVE_PRIOR / STATES
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def by_step(classes: np.ndarray, lengths: np.ndarray):
    """The sequences side by side, longest first: for each step the classes of those that reach it, and the order."""
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(int(lengths.max())), "left")  # how many are longer than t
    return order, [classes[start[:n] + t] for t, n in enumerate(alive)]


def transfers(model: Model, classes: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each piece the matrix (up to scale) that takes the state distribution at the end of the piece before to that at
    its own end, with ``first`` the model's moves; with its start as the only row, the latter of pieces that begin a text."""
    order, steps = by_step(classes, lengths)
    out = first * model.emit[steps[0]][:, None, :]
    for t, s in enumerate(steps[1:], 1):
        n = len(s)
        out[:n] = (out[:n].reshape(-1, STATES) @ model.move).reshape(n, -1, STATES) * model.emit[s][:, None, :]
        if t % 16 == 0:  # long before anything underflows
            out[:n] /= out[:n].sum(axis=(1, 2), keepdims=True)
    back = np.empty_like(out)
    back[order] = out / out.sum(axis=(1, 2), keepdims=True)
    return back


def carried(model: Model, classes: np.ndarray, lengths: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What whole texts say at the borders of their pieces: of each piece the forward state distribution at the end of the
    piece before it (zeros where a text begins), and the backward vector at its own end (ones where it ends)."""
    before, leave = np.zeros((len(lengths), STATES)), np.ones((len(lengths), STATES))
    cut = goes_on | np.append(goes_on[1:], False)
    if not cut.any():
        return before, leave
    at = np.flatnonzero(cut)
    step = np.empty((len(at), STATES, STATES))
    for on, enter in ((False, model.start[None]), (True, model.move)):
        here, own = np.flatnonzero(goes_on[at] == on), cut & (goes_on == on)
        inner, size = classes[np.repeat(own, lengths)], lengths[own]
        for pieces, tokens in blocks(size):
            step[here[pieces]] = transfers(model, inner[tokens], size[pieces], enter)
    first = np.flatnonzero(~goes_on[at])
    count = np.diff(np.append(first, len(at)))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    alive = np.searchsorted(-count, -np.arange(count[0]), "left")  # texts of more than j pieces
    end = np.empty((len(at), STATES))
    end[first] = step[first][:, 0] / step[first][:, 0].sum(axis=1, keepdims=True)
    for j in range(1, int(count[0])):
        here = first[: alive[j]] + j
        before[at[here]] = end[here - 1]
        a = np.einsum("ni,nij->nj", end[here - 1], step[here])
        end[here] = a / a.sum(axis=1, keepdims=True)
    for j in range(int(count[0]) - 1, 0, -1):
        here = first[: alive[j]] + j
        b = np.einsum("nij,nj->ni", step[here], leave[at[here]])
        leave[at[here - 1]] = b / (end[here - 1] * b).sum(axis=1, keepdims=True)
    return before, leave


def expected_counts(model: Model, classes: np.ndarray, lengths: np.ndarray, goes_on: np.ndarray | None = None,
                    before: np.ndarray | None = None, leave: np.ndarray | None = None):
    """Expected starts, moves and emissions of scaled forward-backward over sequences that lie behind each other, or over
    pieces with what ``carried`` gives at their borders; the move into a piece that goes on counts to it.

    With the forward scales in the backward recursion, alpha times beta is the state distribution without a further
    division.
    """
    order, steps = by_step(classes, lengths)
    seen = [model.emit[s] for s in steps]
    start = model.start
    if goes_on is not None:
        goes_on, before, leave = goes_on[order], before[order], leave[order]
        start = np.where(goes_on[:, None], before @ model.move, model.start)
    alpha, scale = [], []
    for t, b in enumerate(seen):
        a = b * start if t == 0 else alpha[-1][: len(b)] @ model.move
        if t:
            a *= b
        scale.append(a.sum(axis=1, keepdims=True))
        a /= scale[-1]
        alpha.append(a)

    def at_end(upto):
        return np.ones((upto, STATES)) if leave is None else leave[:upto].copy()

    moves = np.zeros((STATES, STATES))
    beta = at_end(len(seen[-1]))
    gamma = [None] * len(seen)
    gamma[-1] = alpha[-1] * beta
    for t in range(len(seen) - 2, -1, -1):
        ahead = seen[t + 1]
        ahead *= beta
        ahead /= scale[t + 1]
        n = len(ahead)
        moves += alpha[t][:n].T @ ahead
        beta = at_end(len(seen[t]))
        np.matmul(ahead, model.move.T, out=beta[:n])
        gamma[t] = alpha[t] * beta
    starts = gamma[0]
    if goes_on is not None:
        moves += before[goes_on].T @ (seen[0] * beta / scale[0])[goes_on]
        starts = starts[~goes_on]
    at, all_gamma = np.concatenate(steps), np.concatenate(gamma).T.copy()
    emit = np.stack([np.bincount(at, weights=g, minlength=CLASSES + 1) for g in all_gamma], axis=1)
    return starts.sum(axis=0), moves * model.move, emit


def log10_likelihood(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scaled forward recursion: log10 probability of each sequence of classes."""
    order, steps = by_step(classes, lengths)
    total = np.zeros(len(lengths))
    alpha = None
    for t, s in enumerate(steps):
        a = model.emit[s] * (model.start if t == 0 else alpha[: len(s)] @ model.move)
        scale = a.sum(axis=1)
        alpha = a / scale[:, None]
        total[: len(s)] += np.log10(scale)
    out = np.empty(len(lengths))
    out[order] = total
    return out


def summed(coded: DataFrame, work, width: int) -> np.ndarray:
    """Sums across all tasks of the rows of ``work(classes, lengths, goes_on) -> [(CLASSES + 1 + extra, width), ...]``, given
    the pieces of some texts: a bounded table."""
    names = [f"v{k}" for k in range(width)]

    def run(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            for texts in training_texts(b):
                for part in work(*texts):
                    total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, k]) for k in range(width))],
                                             ["row", *names])

    rows = (coded.where("tokens is not null").select("held", "lengths", "tokens", "classes")
            .mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
            .groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas())
    out = np.zeros((CLASSES + 1 + 1 + STATES, width))
    out[rows["row"].to_numpy(np.int64)] = rows[names].to_numpy(float)
    return out


def first_model(coded: DataFrame, shares: np.ndarray) -> Model:
    """States from clusters of classes that occur in like pieces of text."""
    spark = coded.sparkSession
    directions = np.random.default_rng(1).standard_normal((CLASSES + 1, DIRECTIONS))
    sent = spark.sparkContext.broadcast(directions)

    def profile(classes, lengths, goes_on):
        for pieces, tokens in blocks(lengths):
            size, own = lengths[pieces], classes[tokens]
            mean = np.add.reduceat(sent.value[own], np.cumsum(size) - size) / size[:, None]
            owner = np.repeat(mean, size, axis=0)
            out = np.zeros((CLASSES + 1, DIRECTIONS + 1))
            out[:, -1] = np.bincount(own, minlength=CLASSES + 1)
            for k in range(DIRECTIONS):
                out[:, k] = np.bincount(own, weights=owner[:, k], minlength=CLASSES + 1)
            yield out

    table = summed(coded, profile, DIRECTIONS + 1)[: CLASSES + 1]
    count, emit = table[:, -1], np.ones((CLASSES + 1, STATES))
    common = np.argsort(-count, kind="stable")[:256]  # enough to place the clusters; all classes are assigned to them
    common = common[count[common] > 0]
    if common.size >= STATES:
        where = table[:, :-1] / np.maximum(count, 1)[:, None]
        where = where - np.average(where, axis=0, weights=count)
        centre = k_means(np.unique(where[common], axis=0), STATES)
        own = squared(where, centre).argmin(axis=1)
        emit[np.arange(CLASSES + 1), own] = 5.0
    emit = (emit + np.random.default_rng(2).uniform(0, 0.1, emit.shape)) * shares[:, None]
    move = np.full((STATES, STATES), 1.0) + 7 * np.eye(STATES)
    return Model(np.full(STATES, 1 / STATES), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def baum_welch(coded: DataFrame, shares: np.ndarray, rounds: int = ROUNDS) -> Model:
    spark = coded.sparkSession
    model = first_model(coded, shares)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def work(classes, lengths, goes_on, sent=sent):
            before, leave = carried(sent.value, classes, lengths, goes_on)
            for pieces, tokens in blocks(lengths):
                start, move, emit = expected_counts(sent.value, classes[tokens], lengths[pieces], goes_on[pieces],
                                                    before[pieces], leave[pieces])
                yield np.concatenate([emit, start[None], move])

        table = summed(coded, work, STATES)
        if not table.any():
            return model
        model = Model.from_counts(table[CLASSES + 1], table[CLASSES + 2:], table[: CLASSES + 1], shares)
        sent.unpersist()
    return model


def score(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, scores in log10."""
    spark = docs.sparkSession
    prepare(spark)
    coded, _ = written(chunks(docs, folds, id_col, text_col), "hmm-chunks", CHUNK_FILES)
    each = coded.where("words is not null").select(
        "chunk", "at", F.posexplode(F.arrays_zip("words", "kinds", "trained")).alias("then", "w")).select(
        "chunk", (F.col("at") + F.col("then")).alias("at"), F.col("w.words").alias("word"), F.col("w.kinds").alias("class"),
        F.col("w.trained").alias("n"))
    # a word has a row for each chunk at most, so no word is a hot key
    same = Window.partitionBy("word").orderBy("chunk")
    total = F.sum("n").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    known, _ = written(each.select(F.col("chunk").alias("of_chunk"), "at", "class", total.alias("c"),
                                   (F.row_number().over(same) == 1).alias("first")), "hmm-counts")
    tokens, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in known.where("first and c > 0").groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        tokens[r["class"]], kinds[r["class"]] = r.c, r.v  # a row for each class at most
    all_tokens, all_kinds = int(tokens.sum()), int(kinds.sum())
    shares = (tokens + ADD) / (tokens + ADD).sum()
    model = baum_welch(coded, shares, rounds)
    sent = spark.sparkContext.broadcast((model, np.log10(tokens + ADD * (kinds + 1))))
    whole = np.log10(all_tokens + ADD * (all_kinds + 1))

    def finish(key, chunk: pa.Table, known: pa.Table) -> pa.Table:
        model, class_size = sent.value
        code, lengths = flat(chunk.column("tokens").combine_chunks()), flat(chunk.column("lengths").combine_chunks())
        classes = class_of_code(flat(chunk.column("classes").slice(0, 1).combine_chunks()))
        c = np.zeros(len(classes))
        c[known.column("at").to_numpy()] = known.column("c").to_numpy()
        begin = np.cumsum(lengths) - lengths
        words = np.add.reduceat(np.log10(c + ADD)[code], begin)
        inner = words - np.add.reduceat(class_size[classes][code], begin)
        n_known = np.add.reduceat((c > 0)[code].astype(np.int64), begin)
        return pa.table({
            "id": chunk.column("ids").combine_chunks().flatten(), "held_out": chunk.column("held").combine_chunks().flatten(),
            "n_tokens": pa.array(lengths.astype(np.int64)), "n_known": pa.array(n_known),
            "train_tokens": pa.array(np.full(len(lengths), all_tokens)),
            "base_score": pa.array(words - lengths * whole),
            "score": pa.array(inner + log10_likelihood(model, classes[code], lengths.astype(np.int64)))})

    out = (coded.where("tokens is not null").select("chunk", "ids", "held", "lengths", "tokens", "classes").groupBy("chunk")
           .cogroup(known.select("of_chunk", "at", "c").groupBy("of_chunk"))
           .applyInArrow(finish, f"id {dict(docs.dtypes)[id_col]}, held_out boolean, n_tokens long, n_known long,"
                                 " train_tokens long, base_score double, score double"))
    return out.withColumnRenamed("id", id_col)
