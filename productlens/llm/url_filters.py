"""Allow and block lists over URLs: a blocked Bloom filter, then an exact join of the possible hits.

A listing is a host (with all its subdomains) and the start of a path, written ``host/path``. A URL's candidates are
its host suffixes, each with the starts of its path that have a listed length; the keys are built by SQL functions.
With ``canonical``, listed URLs (not rules, which fit the host and path as written) are filtered by a canonical form of
both sides: no user info, port or dots at the host's end, ``/`` for an empty path, escapes of A-Z a-z 0-9 - . _ ~ decoded once,
others in upper case. Dot segments of a path stay. A host or path that is no part of a URL has no canonical form.
The filter is one bit array of ``KEY_BYTES`` for each listing, at most ``MOST_BYTES``, made by partial aggregation and sent to all
tasks; beyond that bound only more candidates pass it. Candidates that pass it
are joined with the listings on the key, which removes the false positives. The join's skew is split by a salt: every
listing is there once for each of ``SALTS`` values.

A rule that fits goes before every listed URL; among rules, and among listed URLs, the longest that fits decides, of
equally long ones allow before block. A URL that nothing fits is allowed. NULL URLs and URLs without ``://`` have an empty host and path and are allowed.
Repeated rows are judged each. An empty list allows all. Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import lower_ascii, prepare

#: 64-bit words in a block of the filter, and bits set for a key
BLOCK_WORDS, KEY_BITS = 8, 6
#: bytes of the filter for each key, and of the whole filter at least and at most
KEY_BYTES, LEAST_BYTES, MOST_BYTES = 2, 1 << 16, 1 << 26
SALTS = 16
#: First character of a key.
RULE, LISTED = "r", "l"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def normal_escapes(c: Column) -> Column:
    """Percent escapes of unreserved characters decoded once, all others in upper case."""
    def piece(p: Column) -> Column:
        char = F.call_function("chr", F.conv(F.substring(p, 2, 2), 16, 10).cast("long"))
        escape = F.when(char.rlike(r"^[A-Za-z0-9._~-]\z"), char).otherwise(F.upper(F.substring(p, 1, 3)))
        return F.when(p.rlike("^%[0-9A-Fa-f]{2}"), F.concat(escape, p.substr(F.lit(4), F.length(p)))).otherwise(p)

    return F.when(c.contains("%"), F.array_join(F.transform(F.split(c, "(?=%[0-9A-Fa-f]{2})"), piece), "")).otherwise(c)


def canonical_host(host: Column) -> Column:
    """Of a URL's part between ``://`` and path: without user info, port and dots at the end, escapes normal."""
    bare = F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", "")
    return F.regexp_replace(lower_ascii(normal_escapes(bare)), r"\.+\z", "")


def canonical_path(path: Column) -> Column:
    return F.when(path == "", "/").otherwise(normal_escapes(path))


def key_bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each 64-bit hash the filter's block, and its words' bit masks within the block."""
    h = hashes.astype(np.int64).view(np.uint64)
    block = ((h >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
    masks = np.zeros((len(h), BLOCK_WORDS), np.uint64)
    state = h
    for _ in range(KEY_BITS):
        state = state * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
        bit = (state >> np.uint64(55)).astype(np.int64)  # 0..511
        masks[np.arange(len(h)), bit >> 6] |= np.uint64(1) << (bit & 63).astype(np.uint64)
    return block, masks


def filter_size(keys: int) -> int:
    """Bytes of a filter of that many keys, whole blocks."""
    block = 8 * BLOCK_WORDS
    return min(max(-(-KEY_BYTES * keys // block) * block, LEAST_BYTES), MOST_BYTES)


def bloom_filter(keys: DataFrame, filter_bytes: int) -> np.ndarray:
    """The filter of column ``key``: (blocks, words). Tasks send the blocks they touch; at most ``filter_bytes`` meet."""
    blocks = filter_bytes // (8 * BLOCK_WORDS)

    def touched(batches):
        for b in batches:
            block, masks = key_bits(b["h"].to_numpy(), blocks)
            yield pd.DataFrame({"block": block, **{f"w{i}": masks[:, i].view(np.int64) for i in range(BLOCK_WORDS)}})

    words = [f"w{i}" for i in range(BLOCK_WORDS)]
    rows = (keys.select(F.xxhash64("key").alias("h"))
            .mapInPandas(touched, "block long, " + ", ".join(f"{w} long" for w in words))
            .groupBy("block").agg(*(F.bit_or(w).alias(w) for w in words)).toPandas())
    out = np.zeros((blocks, BLOCK_WORDS), np.uint64)
    out[rows["block"].to_numpy(np.int64)] = rows[words].to_numpy(np.int64).view(np.uint64)
    return out


def judge_urls(pages: DataFrame, listings: DataFrame, id_col: str = "page_id", url_col: str = "url",
               filter_bytes: int | None = None, canonical: bool = False) -> DataFrame:
    """(id, host, path, rule, listed, verdict) of every row of ``pages``.

    ``listings`` has host, path, verdict (allow or block) and is_rule; rule is the deciding listing if it is a rule,
    listed the one if not. ``canonical`` compares listings that are no rules in their canonical form;
    ``filter_bytes`` is ``filter_size`` of their number unless given.
    """
    spark = pages.sparkSession
    prepare(spark)
    def site(host: Column, path: Column) -> tuple[Column, Column]:
        return (canonical_host(host), canonical_path(path)) if canonical else (host, path)

    # a key begins with its kind, as rules and other listings may be compared in different forms
    named = listings.where("host is not null and path is not null").withColumn("host", lower_ascii(F.col("host")))
    shown = [F.when(F.col("is_rule"), c).otherwise(s) for c, s in zip((F.col("host"), F.col("path")),
                                                                      site(F.col("host"), F.col("path")))]
    listed = (named.select(F.when(F.col("is_rule"), RULE).otherwise(LISTED).alias("kind"), shown[0].alias("host"),
                           shown[1].alias("path"), "verdict", "is_rule")
              .select(F.concat("kind", "host", "path").alias("key"), "kind", F.length("path").alias("n"),
                      F.size(F.split("host", r"\.")).alias("labels"), "verdict", "is_rule")
              .groupBy("key", "kind", "n", "labels").agg(F.min("verdict").alias("verdict"), F.first("is_rule").alias("is_rule")))
    # bounded by the lengths of a URL's parts
    shapes = {r.kind: r for r in listed.groupBy("kind").agg(F.collect_set("n").alias("n"),
                                                            F.collect_set("labels").alias("labels"),
                                                            F.count(F.lit(1)).alias("keys")).collect()}
    filter_bytes = filter_bytes or filter_size(sum(r["keys"] for r in shapes.values()))
    bits = spark.sparkContext.broadcast(bloom_filter(listed, filter_bytes))
    blocks = filter_bytes // (8 * BLOCK_WORDS)

    def possible(batches):
        for b in batches:
            hashes, keys = b.column("hashes"), b.column("keys")
            flat = hashes.flatten().to_numpy(zero_copy_only=False)
            flags = np.zeros(len(flat), bool)
            if flat.size:
                block, masks = key_bits(flat, blocks)
                flags = ((bits.value[block] & masks) == masks).all(axis=1)
            sizes = pc.list_value_length(hashes).to_numpy(zero_copy_only=False)
            kept = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[flags], minlength=len(sizes))
            offsets = np.append(0, np.cumsum(kept)).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(offsets), keys.flatten().filter(pa.array(flags)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), b.column("path"), hits],
                                             ["id", "host", "path", "hits"])

    def candidates(kind: str, host: Column, path: Column) -> Column:
        if kind not in shapes:
            return F.array().cast("array<string>")
        labels = F.split(host, r"\.")
        suffixes = F.filter(F.array(*(F.when((F.size(labels) >= k) & (host != ""), F.array_join(F.slice(labels, -k, k), "."))
                                      for k in sorted(shapes[kind].labels))), lambda x: x.isNotNull())
        starts = F.filter(F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(shapes[kind].n))),
                          lambda x: x.isNotNull())
        return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(F.lit(kind), s, p))))

    host, path = site(F.col("host"), F.col("path"))
    keys = (pages.select(pages[id_col].alias("id"), host_of(pages[url_col]).alias("host"),
                         path_of(pages[url_col]).alias("path"))
            .withColumns({"site": host, "place": path})
            .withColumn("keys", F.concat(candidates(RULE, F.col("host"), F.col("path")),
                                         candidates(LISTED, F.col("site"), F.col("place"))))
            .withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
            .mapInArrow(possible, f"id {dict(pages.dtypes)[id_col]}, host string, path string, hits array<string>"))
    free = keys.where(F.size("hits") == 0).select("id", "host", "path", F.lit(None).cast(
        "struct<is_rule:boolean,size:int,allowed:boolean,hit:string>").alias("best"))
    row = F.monotonically_increasing_id()
    hits = (keys.where(F.size("hits") > 0).withColumn("n", row)
            .select("n", "id", "host", "path", F.explode("hits").alias("hit"))
            .withColumn("salt", F.pmod(F.xxhash64("n"), F.lit(SALTS)).cast("int")))
    exact = listed.select(F.col("key").alias("hit"), "verdict", "is_rule",
                          F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    best = F.when(F.col("is_rule").isNotNull(),
                  F.struct("is_rule", F.length("hit").alias("size"), (F.col("verdict") == "allow").alias("allowed"), "hit"))
    judged = (hits.join(exact, ["hit", "salt"], "left")
              .groupBy("n").agg(F.first("id").alias("id"), F.first("host").alias("host"), F.first("path").alias("path"),
                                F.max(best).alias("best")).drop("n"))
    hit = F.col("best.hit").substr(F.lit(2), F.length("best.hit"))
    return free.unionByName(judged).select(
        F.col("id").alias(id_col), "host", "path", F.when(F.col("best.is_rule"), hit).alias("rule"), F.when(~F.col("best.is_rule"), hit).alias("listed"),
        F.when(F.coalesce("best.allowed", F.lit(True)), "allow").otherwise("block").alias("verdict"))
