"""Toxicity by weak supervision: many noisy voters, a generative label model, a linear classifier on its posteriors.

Voters. From a bounded sample of labelled rows (at most ``SAMPLE``, half of each label, ``SAMPLE_CHARS`` characters in sum;
those with the smallest hashes; of repeated rows of an id the smallest text) items are mined: words, word beginnings and
word endings that occur once or twice in a text and go with label 1 (likelihood ratio and share). The items of a kind are
dealt in turn to ``LEXICONS`` lexicons; a lexicon votes where one of its items occurs often enough. Five pattern voters look
at the number and share of words with items, at capitals and at exclamation marks.

Label model. One pass over all texts, labelled or not, counts how often each voter and each pair of voters fires. Given the
class, voters are independent but for some pairs, so their covariances are u_i u_j off those pairs; u is fitted to them,
pairs whose residual correlation is largest are set apart as correlated, and u is fitted again. With the share of label 1
among the labelled rows that gives each voter's two firing rates. The posterior of a text adds the log-likelihood ratios
of its votes; a voter that stays correlated with others counts for less, 1 / (1 + the sum of those correlations).

Classifier. A logistic regression fitted in one task to the posteriors of the sample's texts; their labels are not read
again. Its features are the ``FEATURES`` words, beginnings and endings, once or twice in a text, that go with the posteriors
most. Its bias is moved from the sample's share of label 1 to that of all labelled rows. Scoring reads whole texts and needs
no shuffle.

NULL and empty texts have no features: the score is that of the bias. Rows without label, with a NULL one or held out (NULL
ids are) are not learned from; of repeated labels of an id all count. With labels of one class or none, the score is that
class's share (0.5 without any). Repeated rows give repeated rows. Other input columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import Growing, WordTable, held_out, prepare, ranges, slices, texts_of, written

WORD = re.compile(r"\w+")
CAPITALS = re.compile(r"\w{3,}")
SAMPLE, SAMPLE_CHARS = 6000, 24_000_000
HEADS, TAILS = range(3, 8), range(3, 6)
ITEMS, LEXICONS, LEAST_DOCS, LEAST_RATIO = 256, 6, 3, 12.0
#: share of label 1 among the texts with an item, at equal numbers of both labels
LEAST_SHARE = 0.95
TIMES = 2
#: pattern voters: texts with so many different item words, with this share of item words, of capital words, of "!"
PATTERNS = ("two", "four", "share", "capitals", "bangs")
#: a residual correlation from which on two voters count as correlated
CORRELATED = 0.1
#: no voter is believed to be right more often than this when it fires
MOST_PRECISE = 0.98
FEATURES, RIDGE, STEPS = 512, 1.0, 30


def traits(word: str) -> list[str]:
    """The word, its beginnings and its endings, each marked by its kind."""
    return ["=" + word, *["^" + word[:k] for k in HEADS if len(word) > k], *["$" + word[-k:] for k in TAILS if len(word) > k]]


def counted_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct lower-cased words; then text number, word number and count of every word that occurs in a text."""
    lists = [WORD.findall(t.lower()) for t in texts]
    coded = pa.array([w for own in lists for w in own], pa.string()).dictionary_encode()
    words = coded.dictionary.to_pylist()
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lists), np.int64, len(lists)))
    key, count = np.unique(owner * max(1, len(words)) + coded.indices.to_numpy(), return_counts=True)
    return words, key // max(1, len(words)), key % max(1, len(words)), count


def ratio(a: np.ndarray, b: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """Log-likelihood ratio of a trait found in a of ``ones`` and b of ``zeros`` texts; 0 where it goes with class 0."""
    n, seen = ones + zeros, a + b
    parts = 0.0
    for x, of, share in ((a, ones, seen), (ones - a, ones, n - seen), (b, zeros, seen), (zeros - b, zeros, n - seen)):
        expected = of * share / n
        parts = parts + np.where(x > 0, x * np.log(np.maximum(x, 1) / np.maximum(expected, 1e-12)), 0)
    return np.where(a * zeros > b * ones, 2 * parts, 0.0)


def trait_sets(texts: list[str]) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """All traits, and for each number of times the pairs (trait, text) of those that occur so often or more."""
    ids: dict[str, int] = {}
    of_word: dict[str, list[int]] = {}
    found = [[(np.empty(0, np.int64),) * 2] for _ in range(TIMES)]
    for n, t in enumerate(texts):
        words, _, at, count = counted_words([t])
        own = [of_word[w] if w in of_word else of_word.setdefault(w, [ids.setdefault(x, len(ids)) for x in traits(w)])
               for w in words]
        flat = np.array([x for x in own for x in x], np.int64)
        times = np.repeat(count[np.argsort(at)], [len(x) for x in own])
        trait, inverse = np.unique(flat, return_inverse=True)
        total = np.bincount(inverse, weights=times, minlength=len(trait))
        for k in range(TIMES):
            hit = trait[total > k]
            found[k].append((hit, np.full(len(hit), n)))
    return list(ids), [tuple(np.concatenate([f[i] for f in own]) for i in (0, 1)) for own in found]


def ranked_items(texts: list[str], weight: np.ndarray, least_share: float, most: int) -> list[tuple[str, int]]:
    """Items (trait, times) that go with ``weight``, each text's share of class 1, best first; of equal sets of texts one."""
    ones, zeros = float(weight.sum()), float((1 - weight).sum())
    if min(ones, zeros) < 1e-9:
        return []
    names, found = trait_sets(texts)
    mark = np.random.default_rng(1).integers(1, 1 << 62, len(texts))  # the sum over an item's texts tells equal sets
    ranked = []
    for k, (trait, text) in enumerate(found):
        a = np.bincount(trait, weights=weight[text], minlength=len(names))
        b = np.bincount(trait, weights=1 - weight[text], minlength=len(names))
        where = np.zeros(len(names), np.int64)
        np.add.at(where, trait, mark[text])
        score = ratio(a, b, ones, zeros)
        sure = a * zeros >= least_share * (a * zeros + b * ones)
        ranked += [(-score[i], len(names[i]), names[i], k + 1, int(where[i]))
                   for i in np.flatnonzero((score >= LEAST_RATIO) & (a >= LEAST_DOCS) & sure)]
    items, seen = [], set()
    for _, _, name, times, where in sorted(ranked):
        if where not in seen and len(items) < most:
            seen.add(where)
            items.append((name, times))
    return items


def mine(texts: list[str], labels: np.ndarray) -> dict[tuple[str, int], int]:
    """Voter number of each item."""
    voters, dealt = {}, {}
    for name, times in ranked_items(texts, labels.astype(float), LEAST_SHARE, ITEMS):
        kind = (name[0], times)
        turn = dealt[kind] = dealt.get(kind, -1) + 1
        voters[name, times] = (kind, turn % LEXICONS)
    number = {v: i for i, v in enumerate(sorted(set(voters.values())))}
    return {item: number[v] for item, v in voters.items()}


class Finder:
    """Finds items in lists of texts; knows the traits of the words it has seen."""

    def __init__(self, items: list[tuple[str, int]]):
        self.names = {}
        for name, _ in items:
            self.names.setdefault(name, len(self.names))
        self.items = [(self.names[name], times) for name, times in items]
        self.flat, self.start, self.size = Growing(np.int64), Growing(np.int64), Growing(np.int64)
        self.table = WordTable(self._new, lambda: [a.clear() for a in (self.flat, self.start, self.size)])

    def _new(self, words: list[str]) -> None:
        names = self.names
        own = [[names[x] for x in traits(w) if x in names] for w in words]
        size = np.fromiter(map(len, own), np.int64, len(own))
        self.start.extend(self.flat.size + np.cumsum(size) - size)
        self.size.extend(size)
        self.flat.extend(np.array([x for x in own for x in x], np.int64))

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """The texts of each item; per text the number of different words with items, of such words, and of all words."""
        words, text, word, count = counted_words(texts)
        self.table.see([words])
        at = self.table.index(words)[word]
        size = self.size.data[at]
        has = size > 0
        trait = self.flat.data[ranges(self.start.data[at][has], size[has])]
        owner, times = np.repeat(text[has], size[has]), np.repeat(count[has], size[has])
        key, inverse = np.unique(trait * max(1, len(texts)) + owner, return_inverse=True)
        total = np.bincount(inverse, weights=times, minlength=len(key))
        trait, owner = key // max(1, len(texts)), key % max(1, len(texts))
        edge = np.searchsorted(trait, np.arange(len(self.names) + 1))
        found = [owner[edge[i]: edge[i + 1]][total[edge[i]: edge[i + 1]] >= least] for i, least in self.items]
        return (found, np.bincount(text[has], minlength=len(texts)),
                np.bincount(text[has], weights=count[has], minlength=len(texts)),
                np.bincount(text, weights=count, minlength=len(texts)))


class Votes:
    """Votes (texts x voters) of lists of texts."""

    def __init__(self, items: dict[tuple[str, int], int]):
        self.finder, self.voters = Finder(list(items)), list(items.values())
        self.lexicons = 1 + max(self.voters, default=-1)
        self.count = self.lexicons + len(PATTERNS)

    def __call__(self, texts: list[str]) -> np.ndarray:
        votes = np.zeros((len(texts), self.count), bool)
        found, different, hits, words = self.finder(texts)
        for own, voter in zip(found, self.voters):
            votes[own, voter] = True
        some = np.maximum(words, 1)
        capitals = np.array([sum(map(str.isupper, CAPITALS.findall(t))) for t in texts])
        bangs = np.array([t.count("!") for t in texts])
        votes[:, self.lexicons:] = np.stack([different >= 2, different >= 4, hits >= 0.02 * some, capitals >= 0.3 * some,
                                             bangs >= 0.05 * some], axis=1) & (words > 0)[:, None]
        return votes


@dataclass
class LabelModel:
    """Class share, each voter's firing rate in both classes, its weight, and the pairs found correlated."""

    share: float
    fires: np.ndarray
    misfires: np.ndarray
    weight: np.ndarray
    correlated: list[tuple[int, int, float]] = field(default_factory=list)

    def accuracy(self) -> np.ndarray:
        return self.share * self.fires + (1 - self.share) * (1 - self.misfires)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.fires / self.misfires) * self.weight
        no = np.log((1 - self.fires) / (1 - self.misfires)) * self.weight
        z = votes @ (yes - no) + no.sum() + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def rank_one(cov: np.ndarray, free: np.ndarray, rounds: int = 200) -> np.ndarray:
    """u with u_i u_j closest to the covariances of the ``free`` pairs, by alternating least squares."""
    masked = np.where(free, cov, 0)
    u = np.sqrt(np.maximum(masked.sum(axis=1), 0)) + 1e-9
    for _ in range(rounds):
        u = 0.5 * u + 0.5 * (masked @ u) / np.maximum(free @ (u * u), 1e-18)
    return u if u.sum() >= 0 else -u


def label_model(n: int, pairs: np.ndarray, share: float) -> LabelModel:
    """Fit to the numbers of texts in which each pair of voters fires (the diagonal: each voter), of ``n`` texts."""
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    count = len(pairs)
    rate = np.diag(pairs) / max(n, 1)
    cov = pairs / max(n, 1) - np.outer(rate, rate)
    spread = np.sqrt(np.maximum(np.outer(rate * (1 - rate), rate * (1 - rate)), 1e-18))
    free = ~np.eye(count, dtype=bool)
    correlated = []
    u = rank_one(cov, free)
    for _ in range(count * count):
        residual = np.where(np.triu(free), (cov - np.outer(u, u)) / spread, 0)
        i, j = np.unravel_index(np.abs(residual).argmax(), residual.shape)
        # three partners must be left to each side, or its rate is no longer determined
        if abs(residual[i, j]) < CORRELATED or min(free[i].sum(), free[j].sum()) <= max(3, count // 2):
            break
        free[i, j] = free[j, i] = False
        correlated.append((int(i), int(j), float(residual[i, j])))
        u = rank_one(cov, free, 20)
    gap = np.maximum(u, 0) / np.sqrt(share * (1 - share))
    least = 0.5 / (n + 1)
    fires = np.clip(rate + (1 - share) * gap, least, 1 - least)
    most = share * fires / (1 - share)
    misfires = np.clip(rate - share * gap, np.minimum(most * (1 - MOST_PRECISE) / MOST_PRECISE, 1 - least), 1 - least)
    misfires = np.minimum(np.maximum(misfires, least), fires)
    shared = np.zeros(count)
    for i, j, r in correlated:
        shared[[i, j]] += max(r, 0)
    return LabelModel(share, fires, misfires, 1 / (1 + shared), correlated)


@dataclass
class Model:
    """Weight of each item (trait, times), and the bias."""

    weight: dict[tuple[str, int], float]
    bias: float


class Scorer:
    """Scores lists of texts."""

    def __init__(self, model: Model):
        self.finder, self.weight, self.bias = Finder(list(model.weight)), list(model.weight.values()), model.bias

    def __call__(self, texts: list[str]) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        for own, w in zip(self.finder(texts)[0], self.weight):
            z[own] += w
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(texts: list[str], target: np.ndarray, share: float) -> Model:
    """Ridge logistic regression on soft targets by Newton steps, over the ``FEATURES`` items that go with them most."""
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    centre = float(np.clip(target.mean() if target.size else share, 1e-6, 1 - 1e-6))
    shift = np.log(share / (1 - share)) - np.log(centre / (1 - centre))
    items = ranked_items(texts, target, 0.0, FEATURES) if target.size else []
    x = np.zeros((len(texts), len(items) + 1))
    x[:, -1] = 1
    for own, column in zip(Finder(items)(texts)[0], range(len(items))):
        x[own, column] = 1
    ridge = np.full(len(items) + 1, RIDGE)
    ridge[-1] = 1e-6
    beta = np.zeros(len(items) + 1)
    beta[-1] = np.log(centre / (1 - centre))
    for _ in range(STEPS if items else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (target - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        beta = beta + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return Model(dict(zip(items, beta[:-1].tolist())), float(beta[-1] + shift))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, id_col: str, text_col: str, sample: int):
    """(r, text, label) of the sample, and the share of label 1 among all rows that may be learned from."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("id"), folds))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    rank = F.xxhash64(F.col("id").cast("string"), F.lit(2))
    halves = [known.where(F.col("label") == y).orderBy(rank, "id").limit(sample // 2) for y in (0, 1)]
    chosen = halves[0].union(halves[1])  # bounded: at most ``sample`` ids and labels
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    single = (rows.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi")
              .groupBy("id").agg(F.min("text").alias("text")))
    texts = single.join(F.broadcast(chosen), "id").select(rank.alias("r"), "text", "label")
    return written(texts, "toxicity-sample")[0], share


def whole_sample(batches, chars: int) -> tuple[list[str], np.ndarray]:
    size, kept = 0, []
    for b in slices(batches, "text"):
        for t, y in zip(texts_of(b, "text"), b.column("label").to_pylist()):
            if size + len(t) <= chars:
                size += len(t)
                kept.append((t, y))
    return [t for t, _ in kept], np.array([y for _, y in kept], np.int64)


def count_votes(docs: DataFrame, items: dict, text_col: str) -> tuple[int, np.ndarray]:
    """Number of all texts, and of those in which each pair of voters fires."""
    size = Votes(items).count
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        votes, n, pairs = Votes(sent.value), 0, np.zeros((size, size), np.int64)
        for b in slices(batches, "text"):
            fired = votes(texts_of(b, "text")).astype(np.float32)
            n += len(fired)
            pairs += (fired.T @ fired).astype(np.int64)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)),
                                          pa.array(np.append(pairs[i, j], n))], ["i", "j", "n"])

    sums = docs.select(docs[text_col].alias("text")).mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(
        F.sum("n").alias("n"))
    n, pairs = 0, np.zeros((size, size))
    for r in sums.collect():  # one row for each pair of voters
        if r.i < 0:
            n = r.n
        else:
            pairs[r.i, r.j] = pairs[r.j, r.i] = r.n
    return n, pairs


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> tuple[Model, LabelModel]:
    """The classifier and the label model, learned from rows whose crc32(id) is no multiple of ``folds``."""
    spark = docs.sparkSession
    prepare(spark)
    texts, share = labelled(docs, labels, label_col, folds, id_col, text_col, sample)
    one_task = texts.repartition(1).sortWithinPartitions("r", "text", "label")  # the sample, in the order of the hashes

    def find(batches):
        items = mine(*whole_sample(batches, sample_chars))
        yield pa.RecordBatch.from_arrays([pa.array([name for name, _ in items], pa.string()),
                                          pa.array([times for _, times in items], pa.int32()),
                                          pa.array(list(items.values()), pa.int32())], ["name", "times", "voter"])

    items = {(r.name, r.times): r.voter  # at most ITEMS rows
             for r in one_task.mapInArrow(find, "name string, times int, voter int").collect()}
    voters = label_model(*count_votes(docs, items, text_col), share)
    sent = spark.sparkContext.broadcast((items, voters))

    def learn(batches):
        own, _ = whole_sample(batches, sample_chars)
        items, voters = sent.value
        target = voters.posterior(Votes(items)(own)) if own and items else np.full(len(own), share)
        model = fit(own, target, share)
        yield pa.RecordBatch.from_arrays([pa.array([*[name for name, _ in model.weight], None], pa.string()),
                                          pa.array([*[times for _, times in model.weight], 0], pa.int32()),
                                          pa.array([*model.weight.values(), model.bias])], ["name", "times", "weight"])

    fitted = one_task.mapInArrow(learn, "name string, times int, weight double").collect()  # FEATURES rows and the bias
    weight = {(r["name"], r["times"]): r["weight"] for r in fitted if r["name"] is not None}
    bias = next((r["weight"] for r in fitted if r["name"] is None), None)
    return (fit([], np.empty(0), share) if bias is None else Model(weight, bias)), voters


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the classifier's probability of label 1."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(scorer(texts_of(b, "text")))], ["id", "score"])

    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col))
