"""Phrase collocations from a weighted de Bruijn graph of the corpus, one graph per language.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks (U+000A to U+000D), pieces into words at
spaces and tabs. Every word occurrence gives the longest gram that starts there: ``longest`` words (an edge from the node
of its first ``longest`` - 1 words to the node of its last ones) or, near the end of a piece, the words that are left. Only
these are taken from the texts, combined in the tasks before the shuffle. All shorter counts follow from the graph: a
node's count is the sum of the edges that leave it plus the pieces that end in it, and likewise for shorter phrases.

Frequent edges whose node between takes the whole flow of one edge into one other are joined into unary paths by pointer
doubling (a path has no branch, start or end inside, so it is finite and no longer than a piece). All edges and inner nodes
of a path share its weight, so only a path's two ends look their counts up.

A candidate is a phrase of 2 to ``longest`` words that occurs ``at_least`` times. Its score is the smallest over its cuts
into two of floor(10^6 a^2 / (l r)) (a, l, r: counts of the phrase and of both sides), ties to the earliest cut. It is
dropped if a longer candidate holds it and occurs ``covered`` percent as often or more; such a one of one word more exists
whenever any does, so those are looked at. Products are decimals of 38 digits: exact to 10^13 words.

Phrases and words that hold more than one in ``HOT`` word occurrences (fewer than ``HOT`` of them) are joined by broadcast;
of the others, each meets at most one in ``HOT`` times ``at_least`` candidates. NULL and empty texts give nothing; a NULL
language is ``und``; repeated rows count each time; an empty table gives no rows. Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from productlens.llm.tasks import drop_folder, prepare, shared_folder, slices, texts_of, written

HOT = 10_000
#: parts of a language that are ranked on their own
PARTS = 64
#: text bytes that a task combines at once
SLICE = 8 << 20
#: A-Z lower-cased, a tab as a space, what ends a piece as a line break; in UTF-8 these bytes are characters of their own
CLEAN = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 9)
#: ends of pieces become a word of their own, which no word of a text can be
END = "\n"


def words_and_ends(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, and the numbers of all words and piece ends in order."""
    clean = "\n".join(texts).encode().translate(CLEAN).replace(b"\n", b" \n ") + b" \n"
    one = pa.Array.from_buffers(pa.large_utf8(), 1, [None, pa.py_buffer(np.array([0, len(clean)])), pa.py_buffer(clean)])
    coded = pc.split_pattern(one, " ").flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    return coded.dictionary.cast(pa.string()), code[code != pc.index(coded.dictionary, "").as_py()].astype(np.int64)


def longest_grams(texts: list[str], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the distinct grams that start at their occurrences (word numbers, -1 beyond a piece), and counts."""
    names, code = words_and_ends(texts)
    end = code == pc.index(names, END).as_py()
    starts = np.flatnonzero(~end)
    end, code = (np.append(x, np.full(longest, pad)) for x, pad in ((end, True), (code, 0)))
    grams = np.full((longest, len(starts)), -1, np.int64)
    inside = np.ones(len(starts), bool)
    for k in range(longest):
        inside &= ~end[starts + k]
        grams[k] = np.where(inside, code[starts + k], -1)
    size = len(names) + 1
    if size ** longest < 1 << 62:
        key = grams[0] + 1
        for k in range(1, longest):
            key = key * size + grams[k] + 1
        key, counts = np.unique(key, return_counts=True)
        for k in range(longest - 1, -1, -1):
            key, word = np.divmod(key, size)
            grams[k, : len(word)] = word - 1
        return names, grams[:, : len(counts)], counts
    key = np.zeros(len(starts), np.int64)
    for k in range(longest):  # number the prefixes anew, so that the next word fits
        _, key = np.unique(key * size + grams[k] + 1, return_inverse=True)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return names, grams[:, first], counts


def joined(names: pa.Array, grams: np.ndarray) -> pa.Array:
    """The words of each gram joined by spaces."""
    columns = [names.take(pa.array(g, pa.int64(), mask=g < 0)) for g in grams]
    return pc.binary_join_element_wise(*columns, " ", null_handling="skip")


def count_grams(docs: DataFrame, longest: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n): the longest gram of every word occurrence; fewer words than ``longest`` end a piece.

    The tasks combine them over ``SLICE`` bytes of text, so after the shuffle they are sorted once and added up in that
    order, with no hash table on either side. The gram goes first: the sort compares its first bytes as one number.
    Each task's rows come in this order.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].alias("text"))

    def run(batches):
        for b in slices(batches, "text", SLICE):
            langs = b.column("lang")
            for lang in pc.unique(langs).to_pylist():
                names, grams, counts = longest_grams(texts_of(b.filter(pc.equal(langs, lang)), "text"), longest)
                for at in range(0, len(counts), 1 << 16):
                    part = grams[:, at: at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang, pa.string()), part.shape[1]), joined(names, part),
                         pa.array(counts[at: at + part.shape[1]], pa.int64())], ["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram string, n long")
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    total = F.sum(F.col("n").cast("double")).cast("long")  # exact to 2^53; Spark drops a sort before a sum of integers
    return (counts.repartition("lang", "gram").sortWithinPartitions("gram", "lang")
            .groupBy("gram", "lang").agg(total.alias("n")).select("lang", "gram", "n"))


def word_count(gram: str) -> Column:
    return F.length(gram) - F.length(F.translate(gram, " ", "")) + 1


def first_words(gram: str, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def last_words(gram: str, k: int) -> Column:
    return F.substring_index(gram, " ", -k)


def node_flow(grams: DataFrame, size: int, at_least: int) -> DataFrame:
    """(lang, gram, n) of the phrases of ``size`` words: what leaves them and the pieces that end in them."""
    enough = F.lit(True) if size == 1 else first_words("gram", size - 1) != F.col("gram")  # cheaper than counting words
    prefixes = grams.where(enough).select("lang", first_words("gram", size).alias("gram"), "n")
    return prefixes.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


def best_neighbours(nodes: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """``nodes`` with the most frequent of the ``longer`` grams that end and that begin with it, as structs (n, gram)."""
    edge = F.max(F.struct("n", "gram"))
    into = longer.groupBy("lang", last_words("gram", size).alias("node")).agg(edge.alias("into"))
    out = longer.groupBy("lang", first_words("gram", size).alias("node")).agg(edge.alias("out"))
    ends = into.join(out, ["lang", "node"], "full")
    return nodes.join(ends.withColumnRenamed("node", "gram"), ["lang", "gram"], "left")


def unary_paths(nodes: DataFrame) -> DataFrame:
    """(lang, gram, path, pos) of every edge that follows another one in a unary path; a path is named by its first edge.

    ``nodes`` as ``best_neighbours`` gives them. Every round doubles the distance that a pointer spans; a pointer's target
    is the target of no other one of its round, so no key is hot.
    """
    spark = nodes.sparkSession
    unary = nodes.where((F.col("into.n") == F.col("n")) & (F.col("out.n") == F.col("n")))
    links, path = written(unary.select("lang", F.col("out.gram").alias("gram"), F.col("into.gram").alias("path"),
                                       F.lit(1).cast("long").alias("pos"), F.lit(False).alias("done")), "path-links")
    while not links.where("not done").isEmpty():
        ahead = links.select("lang", F.col("gram").alias("path"), F.col("path").alias("to"), F.col("pos").alias("more"),
                             F.col("done").alias("ends"))
        moved = links.where("not done").join(ahead, ["lang", "path"], "left").select(
            "lang", "gram", F.coalesce("to", "path").alias("path"),
            (F.col("pos") + F.coalesce("more", F.lit(0))).alias("pos"), F.coalesce("ends", F.lit(True)).alias("done"))
        old, (links, path) = path, written(links.where("done").union(moved), "path-links")
        drop_folder(spark, old)
    return links.drop("done")


def look_up(rows: DataFrame, key: Column, counts: DataFrame, name: str, total: int) -> DataFrame:
    """``rows`` (a written table or small) with the count of their ``key``, which ``counts`` holds, as column ``name``."""
    keyed = rows.withColumn("_key", key)
    table = counts.select("lang", F.col("gram").alias("_key"), F.col("n").alias(name))
    often = F.col(name) > total / HOT
    return (keyed.join(F.broadcast(table.where(often)), ["lang", "_key"])  # fewer than HOT phrases
            .unionByName(keyed.join(table.where(~often), ["lang", "_key"])).drop("_key"))


def with_node_counts(edges: DataFrame, steps: DataFrame, nodes: DataFrame, size: int, total: int) -> DataFrame:
    """``edges`` with the counts of their first and last ``size`` words, looked up at the two ends of each unary path."""
    placed = edges.join(steps, ["lang", "gram"], "left").select(
        "lang", "gram", "n", F.coalesce("path", "gram").alias("path"), F.coalesce("pos", F.lit(0)).alias("pos"))
    paths, _ = written(placed.groupBy("lang", "path").agg(
        F.max("pos").alias("last_pos"), F.max_by("gram", "pos").alias("last_edge")), "paths")
    paths, _ = written(look_up(paths, first_words("path", size), nodes, "head", total), "path-heads")
    paths = look_up(paths, last_words("last_edge", size), nodes, "tail", total)
    return written(placed.join(paths, ["lang", "path"]).select(
        "lang", "gram", "n", F.when(F.col("pos") == 0, F.col("head")).otherwise(F.col("n")).alias(f"first{size}"),
        F.when(F.col("pos") == F.col("last_pos"), F.col("tail")).otherwise(F.col("n")).alias(f"last{size}")),
        "edge-counts")[0]


def scored(phrases: DataFrame, size: int) -> DataFrame:
    """``phrases`` with the counts of their sides (``first1``, ``last1``, ...) scored by their lowest cut."""
    wide = [F.struct((F.lit(1_000_000).cast("decimal(7,0)") * F.col("n").cast("decimal(15,0)")
                      * F.col("n").cast("decimal(15,0)")).alias("top"),
                     (F.col(f"first{k}").cast("decimal(15,0)") * F.col(f"last{size - k}").cast("decimal(15,0)")).alias("low"))
            for k in range(1, size)]
    cuts = [F.struct(F.call_function("div", w["top"], w["low"]).alias("score"), F.lit(k).alias("k"),
                     F.col(f"first{k}").alias("l"), F.col(f"last{size - k}").alias("r"))
            for k, w in enumerate(wide, 1)]
    return phrases.withColumn("cut", F.array_min(F.array(*cuts))).select(
        "lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = 3, at_least: int = 10, covered: int = 50, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate that is not dropped; n: all word occurrences of the language."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "grams")
    counted = count_grams(docs, longest, lang_col, text_col)
    counted.write.option("compression", "zstd").parquet(folder)
    grams = spark.read.schema(counted.schema).parquet(folder)
    words, words_path = written(grams.groupBy("lang").agg(F.sum("n").alias("n")), "gram-totals")
    total = words.agg(F.sum("n")).first()[0] or 0
    level = {longest: written(grams.where((F.col("n") >= at_least) & (word_count("gram") == longest))
                              .select("lang", "gram", "n"), "edges")[0]}
    for size in range(1, longest):
        level[size] = written(node_flow(grams, size, at_least), f"phrases-{size}")[0]
    drop_folder(spark, folder)
    out = None
    for size in range(longest, 1, -1):
        phrases = level[size]
        if size < longest:  # a longer phrase that holds it is one of the best to the left or right
            near = best_neighbours(phrases, level[size + 1], size)
            most = F.coalesce(F.greatest(F.col("into.n"), F.col("out.n")), F.lit(0))
            phrases = written(near.where(100 * most < covered * F.col("n")).select("lang", "gram", "n"), "left-over")[0]
        elif longest > 2:
            nodes = best_neighbours(level[longest - 1], phrases, longest - 1)
            phrases = with_node_counts(phrases, unary_paths(nodes), level[longest - 1], longest - 1, total)
        for k in range(1, size):
            for side, take in ((f"first{k}", first_words), (f"last{k}", last_words)):
                if side not in phrases.columns:
                    phrases = written(look_up(phrases, take("gram", k), level[k], side, total), "sides")[0]
        rows = scored(phrases, size)
        out = rows if out is None else out.union(rows)
    return out.join(F.broadcast(words), "lang").select("lang", "phrase", "a", "l", "r", "n", "score")  # a row a language


def top(phrases: DataFrame, count: int) -> DataFrame:
    """The first ``count`` phrases of each language with their rank: first those of each of ``PARTS`` parts of a language,
    so a task ranks a part of its phrases or at most ``PARTS`` times ``count`` of them."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = phrases.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= count)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= count)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
