"""Quality classifier on held-out rows; hidden Markov model against brute force over all state paths."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from productlens.llm import hmm, quality, queries
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.conftest import ODD


def out_of(i, folds):
    return i is None or zlib.crc32(str(i).encode()) % folds == 0


def test_features_are_the_same_in_any_company():
    one, n = quality.features(["abc"])
    many, counts = quality.features(["x", "abc", "é東"])
    assert n[0] == 1 + 4 + 3 and counts.tolist() == [1 + 2 + 1, 8, 1 + 3 + 2]
    assert many[counts[0]: counts[0] + counts[1]].tolist() == one.tolist()
    assert quality.features([])[0].size == 0


def test_repeats():
    words, code, owner = quality.words_of(["a a b a", "b c c", ""])
    assert quality.repeats(code, owner, 3).tolist() == [2, 1, 0]


def plain_features(text):
    """Bucket -> how often, one word and one character gram at a time, in whole numbers of 64 bits."""
    base, whole = int(quality.BASE), 1 << 64
    words, counts = re.findall(r"\S+", text), Counter()
    for k, word in enumerate(words):
        codes = [ord(c) + 1 for c in f"<{word}>"]
        values = [sum(c * base ** i for i, c in enumerate(codes)) + 7]
        for n in quality.NGRAMS:
            values += [sum(c * base ** i for i, c in enumerate(codes[at: at + n])) * (2 * n + 1) for at in range(len(codes) - n + 1)]
        counts.update((v * base % whole) >> 47 for v in values)
        if word in words[max(0, k - quality.LAGS): k]:
            counts[quality.REPEAT] += 1
    return counts


TEXTS = ["ab ba", "ab ab c", "é東 ab\tba", "", "c c c c", "ba  ab", " long" * 40, "a" * 300]


def test_scores_equal_plain_features():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(size=quality.BUCKETS + 1), 0.3)
    for text, score in zip(TEXTS, quality.Scorer(model)(TEXTS)):
        counts = plain_features(text)
        logit = sum(model.weight[b] * n for b, n in counts.items()) / max(1, counts.total()) + model.bias
        assert score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-12)


def test_two_gradient_steps_equal_finite_differences(monkeypatch):
    """Each step goes against the slope of the cross-entropy: its sum for table and layer, its mean for the bias."""
    texts, labels = TEXTS[:6], np.array([1, 0, 1, 1, 0, 0])
    monkeypatch.setattr(quality, "EPOCHS", 2)
    monkeypatch.setattr(quality, "BATCH", len(texts))
    got = quality.fit(texts, labels, seed=5)
    counts = [plain_features(t) for t in texts]
    used = sorted(set().union(*counts))
    shares = np.array([[c[b] / max(1, c.total()) for b in used] for c in counts])
    start = np.random.default_rng(5).uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.BUCKETS + 1, quality.DIM))
    cut = np.cumsum([len(used) * quality.DIM, quality.DIM * 2])
    x = np.concatenate([start[used].ravel(), np.zeros(quality.DIM * 2), np.log([1 - labels.mean(), labels.mean()])])

    def loss(x):
        table, layer, bias = np.split(x, cut)
        logits = shares @ table.reshape(-1, quality.DIM) @ layer.reshape(-1, 2) + bias
        return sum(math.log(sum(math.exp(v) for v in row)) - row[y] for row, y in zip(logits.tolist(), labels))

    for rate in (quality.RATE, quality.RATE / 2):
        slope = np.array([(loss(x + d) - loss(x - d)) / 2e-5 for d in np.eye(len(x)) * 1e-5])
        slope[cut[1]:] /= len(texts)
        x = x - rate * slope
    table, layer, bias = np.split(x, cut)
    layer = layer.reshape(-1, 2)
    assert got.weight[used] == pytest.approx(table.reshape(-1, quality.DIM) @ (layer[:, 1] - layer[:, 0]), abs=1e-7)
    assert got.bias == pytest.approx(bias[1] - bias[0], abs=1e-7)


def test_fit_separates_and_is_repeatable():
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 30)) for _ in range(80)]
    bad = [" ".join(rng.choice(["xx###", "yy###", "alpha###"], 30)) for _ in range(80)]
    labels = np.array([1] * 80 + [0] * 80)
    model, again = quality.fit(good + bad, labels), quality.fit(good + bad, labels)
    assert (model.weight == again.weight).all() and model.bias == again.bias
    scores = quality.Scorer(model)(good + bad)
    assert scores[:80].min() > 0.5 > scores[80:].max()
    alone = np.concatenate([quality.Scorer(model)([t]) for t in good + bad])
    assert np.allclose(scores, alone)


def test_fit_without_labels_or_with_one_class():
    assert quality.Scorer(quality.fit([], np.empty(0, np.int64)))(["x", ""]).tolist() == [0.5, 0.5]
    assert quality.Scorer(quality.fit(["x"], np.array([1])))(["", "y"]).min() > 0.99


def test_quality_on_odd_rows(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(i, i % 2, 0, "t") for i in range(1, 8)] + [(5, None, None, None), (None, 1, 0, "t")],
                                   "doc_id long, quality int, toxic int, text string")
    model = quality.train(odd_docs, labels)
    rows = quality.score(odd_docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep(odd_docs, model, 0.5)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.score >= 0.5)
    none = quality.train(make_docs([]), labels.limit(0))
    assert [r.score for r in quality.score(make_docs([(1, "a")]), none).collect()] == [0.5]
    assert quality.score(make_docs([]), none).count() == 0


def test_sample_bounds_hold(spark, make_docs, monkeypatch):
    docs = make_docs([(i, "word " * 50) for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    seen = quality.train(docs, labels, sample=10)
    assert abs(seen.bias) < 5
    tiny = quality.train(docs, labels, sample_chars=10)  # no text fits: no label is learned
    assert not tiny.weight.any()


def test_registered_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.op2_quality(spark, SF_CHECK).collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF_CHECK, "labels").collect()}
    assert len(rows) == queries.table(spark, SF_CHECK, "documents").count()
    assert all(r.held_out == out_of(i, 5) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    wins = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum(wins) / len(wins) > 0.9


def plain_probability(model, classes):
    total = 0.0
    for path in itertools.product(range(hmm.STATES), repeat=len(classes)):
        p = model.start[path[0]] * model.emit[classes[0], path[0]]
        for t in range(1, len(classes)):
            p *= model.move[path[t - 1], path[t]] * model.emit[classes[t], path[t]]
        total += p
    return total


@pytest.fixture()
def small_model(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "CLASSES", 4)
    rng = np.random.default_rng(7)
    return hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)


def test_forward_equals_all_paths(small_model):
    rng = np.random.default_rng(8)
    lengths = np.array([1, 4, 3, 6, 1])
    classes = rng.integers(0, 5, lengths.sum())
    got = hmm.log10_likelihood(small_model, classes, lengths)
    parts = np.split(classes, np.cumsum(lengths)[:-1])
    assert np.allclose(got, [math.log10(plain_probability(small_model, p)) for p in parts])


def test_expected_counts_equal_all_paths(small_model):
    rng = np.random.default_rng(9)
    lengths = np.array([3, 1, 5, 2])
    classes = rng.integers(0, 5, lengths.sum())
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for own in np.split(classes, np.cumsum(lengths)[:-1]):
        total = plain_probability(small_model, own)
        for path in itertools.product(range(3), repeat=len(own)):
            p = small_model.start[path[0]] * small_model.emit[own[0], path[0]]
            for t in range(1, len(own)):
                p *= small_model.move[path[t - 1], path[t]] * small_model.emit[own[t], path[t]]
            start[path[0]] += p / total
            for t, s in enumerate(path):
                emit[own[t], s] += p / total
                if t:
                    move[path[t - 1], s] += p / total
    for got, want in zip(hmm.expected_counts(small_model, classes, lengths), (start, move, emit)):
        assert np.allclose(got, want)


@pytest.mark.parametrize("piece, block", [(1, 4), (2, 7), (3, 1000), (5, 30)])
def test_pieces_give_the_counts_of_whole_texts(small_model, monkeypatch, piece, block):
    import pyarrow as pa
    monkeypatch.setattr(hmm, "PIECE", piece)
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", block)
    rng = np.random.default_rng(11)
    lengths = np.array([7, 1, 40, 3, 2, 90, 5])
    tokens = rng.integers(0, 5, lengths.sum())
    held = np.array([False, False, False, True, False, False, False])
    row = pa.RecordBatch.from_pydict({"held": [held.tolist()], "lengths": [lengths.tolist()], "tokens": [tokens.tolist()],
                                      "classes": [[0, 1, 2, 3, 4]]})
    (classes, sizes, goes_on), = hmm.training_texts(row)
    before, leave = hmm.carried(small_model, classes, sizes, goes_on)
    parts = [hmm.expected_counts(small_model, classes[t], sizes[p], goes_on[p], before[p], leave[p]) for p, t in hmm.blocks(sizes)]
    whole = hmm.expected_counts(small_model, tokens[np.repeat(~held, lengths)], lengths[~held])
    for k, want in enumerate(whole):
        assert np.allclose(sum(part[k] for part in parts), want)
    assert whole[1].sum() == pytest.approx(lengths[~held].sum() - (~held).sum()) and len(sizes) >= len(lengths) - 1


def test_rounds_raise_the_likelihood(small_model):
    rng = np.random.default_rng(10)
    lengths = np.full(40, 30)
    classes = np.concatenate([np.repeat(rng.integers(0, 5, 6), 5) for _ in range(40)])
    shares, model, before = np.full(5, 0.2), small_model, -np.inf
    for _ in range(5):
        now = hmm.log10_likelihood(model, classes, lengths).sum()
        assert now > before
        before = now
        start, move, emit = hmm.expected_counts(model, classes, lengths)
        model = hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def words_and_end(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [" "]


def check_counts(rows, docs, folds=10):
    train = Counter(w for i, t in docs if not out_of(i, folds) for w in words_and_end(t))
    n, v = sum(train.values()), len(train)
    want = []
    for i, t in docs:
        own = words_and_end(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want.append((i is None, i or 0, out_of(i, folds), len(own), sum(train[w] > 0 for w in own), n, round(base, 4)))
    got = [(r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
           for r in rows]
    assert sorted(got) == sorted(want)


def test_scores_on_odd_rows(odd_docs, make_docs):
    rows = hmm.score(odd_docs, rounds=1).collect()
    check_counts(rows, ODD)
    assert all(r.score < 0 for r in rows)
    assert hmm.score(make_docs([]), rounds=1).count() == 0
    untrained = hmm.score(make_docs([(None, "only held out")]), rounds=1).collect()
    assert untrained[0].train_tokens == 0 and untrained[0].n_known == 0 and untrained[0].score < 0


def test_words_of_a_class_sum_to_one():
    counts, kinds = np.array([5, 2, 1]), 3
    p = (counts + hmm.ADD) / (counts.sum() + hmm.ADD * (kinds + 1))
    unknown = hmm.ADD / (counts.sum() + hmm.ADD * (kinds + 1))
    assert math.isclose(p.sum() + unknown, 1)


def test_registered_scores(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF_SMALL, "documents").collect()]
    rows = queries.op8_hmm(spark, SF_SMALL).collect()
    check_counts(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_sample_bounds_hold_for_long_texts_and_hot_ids(spark, make_docs):
    ids = [i for i in range(60) if not out_of(i, 5)]
    texts = {i: " ".join(["alpha beta" if i % 2 else "xx### yy###"] * (3 + i % 4)) for i in ids}
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    order = [r.doc_id for r in labels.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(1))).collect()]
    long, hot = order[0], order[1]
    texts[long] = "long " * 5000  # passes the sum by itself and is left out; what follows it stays
    docs = make_docs([*texts.items()] + [(hot, texts[hot] + " zz" * n) for n in range(1, 500)])
    got = quality.train(docs, labels, sample=40, sample_chars=10_000)
    kept = [i for i in order[:40] if i != long]
    want = quality.fit([texts[i] for i in kept], np.array([i % 2 for i in kept], np.int64))
    assert len(kept) == 39 and np.isclose(got.bias, want.bias) and np.allclose(got.weight, want.weight, atol=1e-9)


def test_rows_of_a_chunk_hold_its_texts_and_words(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(hmm, "ROW_TOKENS", 6)
    monkeypatch.setattr(hmm, "ROW_BYTES", 60)
    texts = ["b a b", None, "", "long " * 20, "C c d", "e f g h i j k", "a  a\tz", "é東 東"]
    held = [False, True, False, False, True, False, False, False]
    chunk = hmm.Chunk()
    for part in (slice(0, 3), slice(3, 8)):
        chunk.add(pa.RecordBatch.from_pydict({"id": list(range(8))[part], "text": pa.array(texts[part], pa.string()), "held": held[part]}))
    rows = pa.Table.from_batches(chunk.rows(5)).to_pylist()
    words = [w for r in rows if r["words"] is not None for w in r["words"]]
    kinds = [k for r in rows if r["words"] is not None for k in r["kinds"]]
    trained = [n for r in rows if r["words"] is not None for n in r["trained"]]
    assert [r["at"] for r in rows if r["words"]] == list(np.cumsum([0] + [len(r["words"]) for r in rows if r["words"]])[:-1])
    assert kinds == [hmm.END if w == " " else zlib.crc32(w.encode()) % hmm.CLASSES for w in words] == sorted(kinds)
    assert +Counter(dict(zip(words, trained))) == Counter(w for t, h in zip(texts, held) for w in words_and_end(t) if not h)
    own = [r for r in rows if r["words"] is None]
    assert [i for r in own for i in r["ids"]] == list(range(8)) and [h for r in own for h in r["held"]] == held
    for r in own:
        assert len(r["ids"]) == 1 or sum(r["lengths"][:-1]) < 2 * hmm.ROW_TOKENS
        assert [words[t] for t in r["tokens"]] == [w for i in r["ids"] for w in words_and_end(texts[i])]
        assert [hmm.class_of_code(np.array(r["classes"]))[t] for t in r["tokens"]] == [kinds[t] for t in r["tokens"]]
    assert len(own) > 3 and len(rows) - len(own) > 2 and {r["chunk"] for r in rows} == {5}


def test_long_words_end_a_chunk(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 1000)
    chunk = hmm.Chunk()
    chunk.add(pa.RecordBatch.from_pydict({"id": [1], "text": ["x" * 999], "held": [False]}))
    assert not chunk.full()
    chunk.add(pa.RecordBatch.from_pydict({"id": [2], "text": pa.array([None], pa.string()), "held": [False]}))
    assert not chunk.full()
    chunk.add(pa.RecordBatch.from_pydict({"id": [3], "text": ["東"], "held": [False]}))
    assert chunk.full()


def test_chunks_are_written_in_small_rows_and_row_groups(spark, monkeypatch):
    import pyarrow.parquet as pq
    docs = spark.range(0, 3000, 1, 1).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 2000), k -> hex(pmod(xxhash64(id, k), 300000)))) AS text")

    class Done(Exception):
        pass

    def first(*args, written=hmm.written):
        raise Done(written(*args)[1])

    monkeypatch.setattr(hmm, "written", first)
    with pytest.raises(Done) as done:  # 6 M tokens in one task
        hmm.score(docs)
    table = spark.read.parquet(done.value.args[0])
    most, total = table.selectExpr("max(size(tokens))", "sum(size(tokens)) FILTER (WHERE tokens IS NOT NULL)").first()
    assert total == 3000 * 2001 and most <= hmm.BLOCK_TOKENS * 3
    groups = [g for f in table.inputFiles() for meta in [pq.ParquetFile(f.removeprefix("file://")).metadata]
              for g in map(meta.row_group, range(meta.num_row_groups))]
    assert max(g.total_byte_size for g in groups) < 10 << 20
