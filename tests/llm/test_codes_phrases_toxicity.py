"""Vector codes, collocations and toxicity against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from productlens.llm import collocations, queries, toxicity, vector_codes
from tests.conftest import SF_CHECK
from tests.llm.conftest import ODD

VECTORS = "vec_id long, embedding array<float>, label int, id long, code string, error long, v string"


# --- vector codes ---

def plain_entries(parts, book):
    """Nearest entry and distance of each part, entry by entry."""
    out = []
    for part in parts:
        far = [sum((int(x) - int(y)) ** 2 for x, y in zip(part, entry)) for entry in book]
        out.append((far.index(min(far)), min(far)))
    return out


def plain_codes(rows, entries, rounds):
    """(vec_id, code, error, label_error) and the codebooks' digest, by plain loops."""
    kept = [(i, [max(-2**63, min(2**63 - 1, math.floor(1024 * float(np.float32(x))))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    parts = [[v[p * width: (p + 1) * width] for _, v, _ in kept] for p in range(4)]
    books = [own[:entries] for own in parts]
    for _ in range(rounds):
        for p in range(4):
            near = plain_entries(parts[p], books[p])
            new = list(books[p])
            for e in range(len(new)):
                mine = [part for part, (own, _) in zip(parts[p], near) if own == e]
                if mine:
                    new[e] = [sum(x) // len(mine) for x in zip(*mine)]
            books[p] = new
    near = [plain_entries(parts[p], books[p]) for p in range(4)]
    errors = [sum(near[p][i][1] for p in range(4)) for i in range(len(kept))]
    labels = Counter()
    for (_, _, label), e in zip(kept, errors):
        labels[label] += e
    most = 2**63 - 1
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return Counter((r[0], "".join(f"{near[p][i][0]:02x}" for p in range(4)), min(errors[i], most), min(labels[r[2]], most))
                   for i, r in enumerate(kept)), digest


def coded(spark, rows, entries=256, rounds=4):
    df = spark.createDataFrame([(i, v, label, None, None, None, None) for i, v, label in rows], VECTORS)
    codes, books = vector_codes.compress(df, entries=entries, rounds=rounds)
    return Counter(map(tuple, codes.select("vec_id", "code", "error", "label_error").collect())), books.digest()


@pytest.mark.parametrize("block", [1, 3, 1000])
@pytest.mark.parametrize("wide", [3, 1 << 13, 1 << 34, 1 << 60])
def test_trie_equals_plain_distances(block, wide):
    rng = np.random.default_rng(wide % 97)
    parts, _ = vector_codes.sorted_distinct(rng.integers(-wide, wide, (120, 4)) * rng.integers(0, 2, (120, 4)))
    book = rng.integers(-wide, wide, (9, 4))
    book[5] = book[2]
    own, far = vector_codes.nearest_entries(parts, book, block)
    assert [(int(a), int(b)) for a, b in zip(own, far)] == plain_entries(parts.tolist(), book.tolist())


def test_weighted_sums_beyond_64_bits():
    parts = np.array([[1 << 61, -(1 << 61)], [5, 6], [1 << 61, 1]], np.int64)
    own, count, sums = vector_codes.weighted_sums(parts, np.array([7, 2, 9]), np.array([1, 0, 1]))
    assert own.tolist() == [0, 1] and count.tolist() == [2, 16]
    assert [[int(x) for x in s] for s in sums] == [[10, 12], [16 << 61, -(7 << 61) + 9]]


def test_codes_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8) / 1024], i % 3 or None) for i in range(1, 40)]
    rows += [(2, rows[4][1], 1), (2, rows[1][1], 1), (None, rows[0][1], None), (50, None, 1), (51, [], 1), (52, [1.0, 2.0], 1),
             (53, [1.0] * 7 + [None], 2), (54, [float("nan")] + [0.0] * 7, 2), (55, [float("inf")] * 8, 2),
             (56, [0.1] * 8, None), (57, rows[0][1], 2), (57, rows[0][1], 2)]
    usable = [r for r in rows if r[0] != 52]
    for entries, rounds in ((256, 4), (5, 3), (1, 1)):
        assert coded(spark, rows, entries, rounds) == plain_codes(usable, entries, rounds)


def test_codes_of_huge_components_and_no_rows(spark):
    rows = [(1, [1e30, 0.0, 1.0, 2.0], 1), (2, [-3e38, 1e10, 1.0, 2.0], 1), (3, [7e4, -1e12, 0.5, -0.25], 2), (4, [0.0] * 4, 2)]
    assert coded(spark, rows, 2, 2) == plain_codes(rows, 2, 2)
    assert coded(spark, [])[0] == Counter() and coded(spark, [(1, None, 1)])[0] == Counter()
    assert coded(spark, [(1, [1.0, 2.0, 3.0], 1)])[0] == Counter()


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_label_sums_by_broadcast_and_by_key(spark, hot):
    rows = [(i, None if i % 5 == 0 else i % 4, i) for i in range(30)]
    codes = spark.createDataFrame([(i, f"{i:08x}", label, e) for i, label, e in rows], "id long, code string, label int, error long")
    total = Counter()
    for _, label, e in rows:
        total[label] += e
    got = vector_codes.with_label_error(codes, hot).collect()
    assert sorted((r.id, r.label_error) for r in got) == [(i, total[label]) for i, label, _ in rows]


def test_registered_codes(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, SF_CHECK, "embeddings").collect()]
    got = queries.op11_vector_codes(spark, SF_CHECK).collect()
    # the plain loops take minutes over 256 entries, so numpy's whole distance tables stand in for them
    kept = sorted((i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows)
    books, parts = [], []
    for p in range(4):
        own = np.array([v[p * len(v) // 4: (p + 1) * len(v) // 4] for _, v in kept])
        book = own[:256].copy()
        for _ in range(4):
            near = ((own[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
            for e in np.unique(near):
                book[e] = own[near == e].sum(axis=0) // (near == e).sum()
        books.append(book)
        parts.append(((own[:, None] - book[None]) ** 2).sum(axis=2))
    want = {i: ("".join(f"{d[n].argmin():02x}" for d in parts), sum(int(d[n].min()) for d in parts)) for n, (i, _) in enumerate(kept)}
    assert {r.vec_id: (r.code, r.error) for r in got} == want and len(got) == len(rows)
    assert {r.codebooks_sha256 for r in got} == {vector_codes.Codebooks(books).digest()}


# --- collocations ---

def plain_collocations(rows, longest, at_least, covered=50):
    words, count = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i: i + k])] += 1
    out = set()
    for lang, own in count.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= at_least}
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i: i + len(p)] == p for i in range(len(q)))
                   for q, b in candidates.items()):
                continue
            score, k = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            out.add((lang, " ".join(p), a, own[p[:k]], own[p[k:]], words[lang], score))
    return out


PASSAGE = " ".join(f"p{i}" for i in range(37))


def phrase_rows():
    rng = np.random.default_rng(5)
    rows = []
    for n in range(60):
        words = rng.choice(["a", "A", "b", "c", "d\t", "e.", "f,", "\n", "ß", "g\xa0h", "\x0b", "x;y", "É"], 30)
        rows.append((["en", "de", None, "und"][n % 4], " ".join(words)))
    rows += [("en", f"x{n} {PASSAGE} y{n % 2}") for n in range(12)]
    rows += [("en", PASSAGE + (" tail" if n % 3 else "")) for n in range(12)] + [("fr", "p3 p4 p5 p6 p7")] * 11
    rows += [("en", "loop loop loop loop loop")] * 4 + [("en", None), (None, ""), ("en", " \t "), ("en", "...,"), ("de", "one")]
    return rows


@pytest.mark.parametrize("longest, at_least", [(3, 10), (2, 3), (4, 5)])
def test_collocations_equal_plain_counting(spark, monkeypatch, longest, at_least):
    if longest == 4:
        monkeypatch.setattr(collocations, "HOT", 30)  # phrases on both sides of the bound
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, gram string")
    got = [tuple(r) for r in collocations.collocations(docs, longest, at_least).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_collocations(rows, longest, at_least)


def test_grams_are_sorted_once_and_summed_in_order(spark):
    docs = spark.createDataFrame([(t, lang) for lang, t in phrase_rows()], "text string, lang string")
    grams = collocations.count_grams(docs, 3)
    plan = grams._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("SortAggregate") == 1 and plan.count("Exchange") == 1
    rows = grams.collect()
    assert grams.columns == ["lang", "gram", "n"] and dict(grams.dtypes)["n"] == "bigint"
    assert len(rows) == len({(r.lang, r.gram) for r in rows})


def test_paths_run_between_branches(spark):
    docs = spark.createDataFrame([(t, lang) for lang, t in phrase_rows()], "text string, lang string")
    grams = collocations.count_grams(docs, 3)
    edges = grams.where("n >= 10").where(collocations.word_count("gram") == 3)
    nodes = collocations.best_neighbours(collocations.node_flow(grams, 2, 10), edges, 2)
    steps = {(r.lang, r.gram): (r.path, r.pos) for r in collocations.unary_paths(nodes).collect()}
    # 24 copies: the passage's edges are one path from its first edge on, broken by no branch but its ends
    assert steps["en", "p20 p21 p22"] == ("p0 p1 p2", 20) and steps["en", "p34 p35 p36"] == ("p0 p1 p2", 34)
    assert steps["fr", "p4 p5 p6"] == ("p3 p4 p5", 1)
    assert ("en", "loop loop loop") not in steps and ("en", "p0 p1 p2") not in steps


def test_collocations_on_odd_rows(odd_docs, make_docs):
    assert {tuple(r) for r in collocations.collocations(odd_docs, 3, 2).collect()} == plain_collocations(
        [(None, t) for _, t in ODD], 3, 2)
    assert collocations.collocations(make_docs([])).count() == 0


def test_many_words_outgrow_one_key():
    texts = [f"w{i} w{i + 1} w{i + 2} z" for i in range(0, 40)]
    names, grams, counts = collocations.longest_grams(texts, 13)
    got = {tuple(names[int(g)].as_py() for g in row if g >= 0): int(n) for row, n in zip(grams.T, counts)}
    want = Counter(tuple(t.split()[i:]) for t in texts for i in range(4))
    assert got == want


def test_top_breaks_ties_by_count_and_bytes(spark):
    rows = [("en", p, a, 1, 1, 9, s) for p, a, s in (("é a", 3, 5), ("z a", 3, 5), ("b b", 4, 5), ("c c", 1, 9), ("d d", 1, 1))]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = collocations.top(df, 4).orderBy("rank").collect()
    assert [(r["rank"], r.phrase) for r in got] == [(1, "c c"), (2, "b b"), (3, "z a"), (4, "é a")]


# --- toxicity ---

def test_label_model_finds_rates_and_correlated_pair():
    rng = np.random.default_rng(2)
    n, share = 400_000, 0.2
    y = rng.random(n) < share
    fires, misfires = np.array([.6, .5, .4, .7, .3, .5, .6, .45]), np.array([.01, .02, .05, .1, .01, .03, .02, .04])
    votes = rng.random((n, 8)) < np.where(y[:, None], fires, misfires)
    copy = rng.random(n) < 0.8
    votes[:, 7] = np.where(copy, votes[:, 6], votes[:, 7])
    v = votes.astype(float)
    model = toxicity.label_model(n, v.T @ v, share)
    assert [p[:2] for p in model.correlated] == [(6, 7)]
    assert np.abs(model.fires - fires)[:7].max() < 0.02 and np.abs(model.misfires - misfires)[:7].max() < 0.01
    assert np.abs(model.accuracy()[:6] - np.where(y[:, None], votes, ~votes)[:, :6].mean(axis=0)).max() < 0.02
    # of votes without correlation the posterior is Bayes' rule
    plain = toxicity.LabelModel(share, fires, misfires, np.ones(8))
    for row in votes[:50]:
        one = share * np.where(row, fires, 1 - fires).prod()
        zero = (1 - share) * np.where(row, misfires, 1 - misfires).prod()
        assert plain.posterior(row[None])[0] == pytest.approx(one / (one + zero), abs=1e-9)


def plain_traits(word):
    return {"=" + word} | {"^" + word[:k] for k in range(3, 8) if len(word) > k} | {"$" + word[-k:] for k in range(3, 6) if len(word) > k}


def test_votes_and_scores_equal_plain_counting():
    texts = ["Dummkopf dumm DUMMY, ok!", "", "!!!", "Idiot idiot idioten x", "ABC DEF GHI", None, "plain words only", "dumm"]
    texts = [t or "" for t in texts]
    items = {("^dum", 1): 0, ("^dum", 2): 1, ("=idiot", 2): 1, ("$oten", 1): 0, ("=dumm", 1): 2}
    votes = toxicity.Votes(items)
    model = toxicity.Model({item: 0.5 + i for i, item in enumerate(items)}, -1.0)
    scorer = toxicity.Scorer(model)
    got, scores = votes(texts), scorer(texts)
    for n, t in enumerate(texts):
        words = re.findall(r"\w+", t.lower())
        hits = {item: sum(item[0] in plain_traits(w) for w in words) >= item[1] for item in items}
        want = [any(hits[i] for i, v in items.items() if v == voter) for voter in range(3)]
        marked = [w for w in words if plain_traits(w) & {name for name, _ in items}]
        capitals = [w for w in re.findall(r"\w{3,}", t) if w.isupper()]
        want += [len(set(marked)) >= 2, len(set(marked)) >= 4, len(marked) >= 0.02 * len(words),
                 len(capitals) >= 0.3 * len(words), t.count("!") >= 0.05 * len(words)] if words else [False] * 5
        assert got[n].tolist() == want
        z = -1.0 + sum(w for item, w in model.weight.items() if hits[item])
        assert scores[n] == pytest.approx(1 / (1 + math.exp(-z)))


def test_fit_is_the_ridge_optimum():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["bad", "worse", "fine", "good", "so"], 6)) for _ in range(300)]
    target = np.array([0.9 if "bad" in t else 0.2 if "worse" in t else 0.05 for t in texts])
    model = toxicity.fit(texts, target, target.mean())
    x = np.array([[sum(item[0] in plain_traits(w) for w in t.split()) >= item[1] for item in model.weight] for t in texts], float)
    w = np.array(list(model.weight.values()))
    p = 1 / (1 + np.exp(-(x @ w + model.bias)))
    assert len(w) and np.abs(x.T @ (target - p) - toxicity.RIDGE * w).max() < 1e-6 and abs((target - p).sum()) < 1e-4


def test_toxicity_on_odd_rows(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(i, 1, i % 2, "x") for i in (1, 2, 3, 4, 5, 7)] + [(None, 1, 1, "x"), (4, 1, None, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    model, _ = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got)
    nothing, _ = toxicity.train(odd_docs, labels.limit(0))
    assert {round(r.score, 6) for r in toxicity.score(odd_docs, nothing).collect()} == {0.5}
    one, _ = toxicity.train(odd_docs, labels.where("toxic = 1"))
    assert all(r.score > 0.99 for r in toxicity.score(odd_docs, one).collect())
    empty, _ = toxicity.train(make_docs([]), labels)
    assert toxicity.score(make_docs([]), empty).count() == 0


def test_registered_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf, "labels").collect()}
    got = queries.op12_toxicity(spark, sf).collect()
    assert len(got) == queries.table(spark, sf, "documents").count()
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    caught = [p for p, y in held if y]
    assert np.mean(caught) >= 0.85 and np.mean([y for p, y in held if p]) >= 0.9
