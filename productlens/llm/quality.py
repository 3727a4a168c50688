"""Quality classifier: supervised subword embeddings (averaged hashed word and character n-gram vectors, softmax).

A word gives one feature for itself and one for each character n-gram of ``NGRAMS`` sizes with its ends marked; features
are hashed into ``BUCKETS`` rows of an embedding table. A word that repeats one of the ``LAGS`` words before it gives one
more feature, the same for all words, as repetition shows in no single word. A document is the mean of its features' vectors; a softmax layer
gives the class. Table and layer are fitted by numpy stochastic gradient descent in one task, on at most ``SAMPLE``
labelled rows with ``SAMPLE_CHARS`` characters in sum (those with the smallest hashes, whatever the order of the rows;
a text that would pass the sum is left out and counts for nothing; of repeated rows of an id the smallest text is
read, once for each label). The fitted model is one small array per bucket, sent to all tasks; scoring needs no shuffle and reads whole texts.

NULL and empty texts have the mean vector zero, so the score is that of the bias. A document without label, or with a
NULL one, is not learned from; of repeated labels of an id all count. With labels of one class or none, the score is that
class's share (0.5 without any). Repeated rows give repeated rows. Other input columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import Growing, WordTable, filtered, held_out, prepare, ranges, slices, texts_of

WORD = re.compile(r"\S+")
NGRAMS, BUCKETS, DIM = (2, 3), 1 << 17, 8
SAMPLE, SAMPLE_CHARS = 6000, 24_000_000
EPOCHS, RATE, BATCH = 4, 0.5, 32
LAGS = 2
BASE = np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' features behind each other, and how many each word has."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marked = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), length)
    start = np.cumsum(length) - length
    parts, owners = [], []
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(length.max()), BASE))])
        inside = np.arange(codes.size) - start[word]
        whole = np.add.reduceat((codes + np.uint64(1)) * power[inside], start) + np.uint64(7)
        parts.append(whole)
        owners.append(np.arange(len(words)))
        for n in NGRAMS:
            if codes.size < n:
                continue
            grams = sum((codes[k: codes.size - n + k + 1] + np.uint64(1)) * power[k] for k in range(n)) * np.uint64(2 * n + 1)
            own = word[: grams.size] == word[n - 1:]
            parts.append(grams[own])
            owners.append(word[: grams.size][own])
        flat, owner = np.concatenate(parts), np.concatenate(owners)
        bucket = ((flat * BASE) >> np.uint64(64 - 17)).astype(np.int64) % BUCKETS
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def repeats(code: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """How many words of each text repeat one of the ``LAGS`` words before them."""
    again = np.zeros(code.size, bool)
    for k in range(1, LAGS + 1):
        again[k:] |= (code[k:] == code[:-k]) & (owner[k:] == owner[:-k])
    return np.bincount(owner[again], minlength=texts)


#: bucket of the repetition feature, beside those of the hashes
REPEAT = BUCKETS


class Words:
    """What a task knows of the words it has seen: their features."""

    def __init__(self):
        self.flat, self.start, self.count = Growing(np.int32), Growing(np.int64), Growing(np.int64)
        self.table = WordTable(self._new, lambda: [a.clear() for a in (self.flat, self.start, self.count)])

    def _new(self, words: list[str]) -> None:
        flat, count = features(words)
        self.start.extend(self.flat.size + np.cumsum(count) - count)
        self.count.extend(count)
        self.flat.extend(flat)


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts, each word occurrence's number among them, and each occurrence's text."""
    lists = [WORD.findall(t) for t in texts]
    coded = pa.array([w for own in lists for w in own], pa.string()).dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lists), np.int64, len(lists)))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), owner


@dataclass
class Model:
    """Logit of class 1 over class 0 for each bucket, and its bias."""

    weight: np.ndarray
    bias: float

    def score(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + self.bias, -50, 50)))


def fit(texts: list[str], labels: np.ndarray, seed: int = 1) -> Model:
    """Mini-batch stochastic gradient descent on softmax cross-entropy, with a rate that falls to zero."""
    share = labels.mean() if labels.size else 0.5
    if share in (0, 1) or not labels.size:
        share = float(np.clip(share, 1e-6, 1 - 1e-6))
        return Model(np.zeros(BUCKETS + 1), float(np.log(share / (1 - share))))
    docs = []
    for t in texts:  # a document is its distinct features with their shares
        words, code, owner = words_of([t])
        flat, count = features(words)
        times = np.repeat(np.bincount(code, minlength=len(words)), count)
        total = np.bincount(np.append(flat, REPEAT), weights=np.append(times, repeats(code, owner, 1)))
        at = np.flatnonzero(total)
        docs.append((at, total[at] / max(1, total.sum())))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM))
    layer, bias = np.zeros((DIM, 2)), np.log([1 - share, share])
    steps, step = EPOCHS * -(-len(docs) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), BATCH):
            batch = order[k: k + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = np.stack([docs[i][1] @ table[docs[i][0]] for i in batch])
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            to_mean = p @ layer.T
            layer -= rate * mean.T @ p
            bias -= rate * p.mean(axis=0)
            for i, g in zip(batch, to_mean):
                at, share_of = docs[i]
                table[at] -= rate * np.outer(share_of, g)
    return Model(table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of the labelled documents whose crc32(id) is no multiple of ``folds``."""
    spark = docs.sparkSession
    prepare(spark)
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("id"), folds))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(~held_out(F.col("id"), folds))
    rank = F.xxhash64(F.col("id").cast("string"), F.lit(1))
    chosen = known.orderBy(rank, "id", "label").limit(sample)  # bounded: at most ``sample`` ids and labels
    # one text an id, so that the task below gets at most ``sample`` rows
    single = rows.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    texts = single.join(F.broadcast(chosen), "id").select(rank.alias("r"), "text", "label")

    def run(batches):
        size, kept = 0, []
        for b in slices(batches, "text"):
            for t, y in zip(texts_of(b, "text"), b.column("label").to_pylist()):
                if size + len(t) <= sample_chars:
                    size += len(t)
                    kept.append((t, y))
        model = fit([t for t, _ in kept], np.array([y for _, y in kept], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()]), pa.array([model.bias])], ["weight", "bias"])

    # one task: the sample, in the order of the hashes
    fitted = texts.repartition(1).sortWithinPartitions("r", "text", "label").mapInArrow(run, "weight binary, bias double").first()
    if fitted is None:
        return fit([], np.empty(0, np.int64))
    return Model(np.frombuffer(fitted.weight), fitted.bias)


class Scorer:
    """Scores lists of texts; knows the features of the words it has seen."""

    def __init__(self, model: Model):
        self.model, self.words = model, Words()

    def __call__(self, texts: list[str]) -> np.ndarray:
        model, known = self.model, self.words
        distinct, code, owner = words_of(texts)
        known.table.see([distinct])
        at = known.table.index(distinct)
        start, count = known.start.data[at], known.count.data[at]
        flat = known.flat.data[ranges(start, count)]
        sums = np.bincount(np.repeat(np.arange(len(at)), count), weights=model.weight[flat], minlength=len(at))
        again = repeats(code, owner, len(texts))
        total = np.bincount(owner, weights=sums[code], minlength=len(texts)) + again * model.weight[REPEAT]
        return model.score(total, np.bincount(owner, weights=count[code], minlength=len(texts)) + again)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the model's probability of class 1."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(scorer(texts_of(b, "text")))], ["id", "score"])

    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col))


def keep(docs: DataFrame, model: Model, at_least: float, text_col: str = "text") -> DataFrame:
    """The rows that score ``at_least`` that much, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(sent.value)
        return lambda texts: scorer(texts) >= at_least

    return filtered(docs, text_col, start)
