"""CSV source and sink for the base tables.

``read_table`` maps columns **by header name** (not position) onto the
declared schema (all files of a folder must have the same header; a file
with another one fails the load), casts from text with ``try_cast`` (a malformed value
becomes NULL instead of failing the load; ``count_cast_failures`` reports
them), and fills columns absent from the file with their load defaults.
JSON cells written by pandas double their quotes, so ``escape='"'`` is
required, otherwise a JSON value is cut at its first comma.

Quoted cells may hold line breaks, so a line is not a record. A large file is
read by many tasks all the same (``read_text``): a first pass counts the lines
with an odd number of quotes of every byte range, a prefix pass over one row a
range tells which ranges begin inside a quoted cell, and a second pass joins
each range's lines to records; a record that crosses ranges is put together
from its pieces. Files whose quotes don't pair up (a lone quote inside an
unquoted cell) are read whole, one task each.
"""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from productlens import schemas
from productlens.session import ship_package

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "multiLine": "true"}
RECORD_OPTIONS = {"escape": '"', "quote": '"', "multiLine": "true"}
# Written timestamps keep microseconds and an explicit offset (Spark's default keeps milliseconds).
WRITE_OPTIONS = {**CSV_OPTIONS, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def apply_load_defaults(df: DataFrame, table: str, load_ts: datetime | None = None) -> DataFrame:
    """Add the declared default for every column the source omitted.

    A default applies only to an omitted column; an explicit NULL stays NULL.
    ``load_ts`` stands for the load time (pass it explicitly for repeatable loads).
    """
    schema = schemas.BASE_TABLES[table]
    for name, default in schemas.LOAD_DEFAULTS.get(table, {}).items():
        if name in df.columns:
            continue
        if default == "load_ts":
            value = F.lit(load_ts) if load_ts is not None else F.current_timestamp()
        else:
            value = F.lit(default)
        df = df.withColumn(name, value.cast(schema[name].dataType))
    return df


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, start, quotes, value): the lines of every byte range in order; a line belongs to the range it begins in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"), "value")


def range_states(odd_lines: list[tuple[str, int, int]]) -> tuple[dict[tuple[str, int], tuple[bool, int]], list[str]]:
    """By (file, start): whether the range begins inside a quoted cell, and the range in which that record began.

    ``odd_lines`` holds (file, start, lines with an odd number of quotes). Also the files that end inside a cell.
    """
    states, odd_files = {}, []
    before, inside, owner = None, False, 0
    for file, start, odd in sorted(odd_lines):
        if file != before:
            if inside:
                odd_files.append(before)
            before, inside, owner = file, False, start
        states[file, start] = (inside, owner)
        if not inside or odd >= 2:  # a record begins here
            owner = start
        inside ^= bool(odd % 2)
    if inside:
        odd_files.append(before)
    return states, odd_files


def assemble(batches, states):
    """(file, owner, start, whole, head, text) from the lines of ranges: whole records, and pieces of those that cross
    ranges; ``head`` marks a file's first record."""
    key, inside, owner, held, head, missing = None, False, 0, [], False, (None, None)

    def rows(files, owners, starts, whole, heads, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([files] * n, pa.string()), pa.array([owners] * n, pa.int64()), pa.array([starts] * n, pa.int64()),
             pa.array([whole] * n), pa.array(heads, pa.bool_()), texts], ["file", "owner", "start", "whole", "head", "text"])

    def piece():
        return rows(key[0], owner, key[1], False, [head], pa.array(["\n".join(held)], pa.string()))

    for b in batches:
        files, starts = b.column("file"), b.column("start").to_numpy()
        code = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
        for a, e in zip([0, *cuts], [*cuts, b.num_rows]):
            if a == e:
                continue
            now = (files[int(a)].as_py(), int(starts[a]))
            if now != key:
                if held:
                    yield piece()
                if now not in states:
                    raise ValueError(f"byte ranges of {now[0]} changed between two reads")
                key, (inside, owner), held, head = now, states[now], [], False
                leading, first = inside, now[1] == 0
            lines = b.column("value").slice(a, e - a)
            odd = b.column("quotes").slice(a, e - a).to_numpy() & 1
            state = np.cumsum(odd) + inside
            begins = np.flatnonzero(np.append(not inside, state[:-1] % 2 == 0))
            inside = bool(state[-1] % 2)
            stop = begins[0] if len(begins) else len(lines)
            if stop:  # lines of a record that began before
                held += lines.slice(0, stop).to_pylist()
                if stop == len(lines) and inside:
                    continue
                if leading:
                    yield piece()
                else:
                    yield rows(*key[:1], key[1], key[1], True, [head], pa.array(["\n".join(held)], pa.string()))
                held, leading, head = [], False, False
            if not len(begins):
                continue
            leading, owner = False, key[1]
            whole_upto = begins[-1] if inside else len(lines)
            bounds = np.append(begins[begins < whole_upto], whole_upto)
            if len(bounds) > 1:
                lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)),
                                                 lines.slice(bounds[0], bounds[-1] - bounds[0]))
                heads = np.zeros(len(bounds) - 1, bool)
                heads[0] = first
                yield rows(key[0], key[1], key[1], True, heads, pc.binary_join(lists, "\n"))
            if inside:
                head = bool(first and len(bounds) == 1)
                held = lines.slice(begins[-1]).to_pylist()
            first = False
    if held:
        yield piece()


def _records(spark: SparkSession, path: str, states, odd_files: list[str], columns: list[str]) -> DataFrame:
    """Every column as string, from files that are read in byte ranges."""
    ship_package(spark)
    lines = _lines(spark, path)
    if odd_files:
        lines = lines.where(~F.col("file").isin(odd_files))
    sent = spark.sparkContext.broadcast(states)
    found = lines.mapInArrow(lambda batches: assemble(batches, sent.value),
                             "file string, owner long, start long, whole boolean, head boolean, text string")
    kept = ["file", "head", "text"]
    crossing = found.where("not whole").groupBy("file", "owner").agg(  # the pieces of one record
        F.max("head").alias("head"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "\n").alias("text"))
    # a range that ends inside a cell and has no later one is the end of its file
    text = F.regexp_replace("text", "\r$", "")
    records = found.where("whole").select(kept).unionByName(crossing.select(kept)).withColumn("text", text)
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    clean = F.when(F.col("head"), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    parsed = records.where("text <> ''").select("file", "head", F.from_csv(clean, ddl, RECORD_OPTIONS).alias("r"))

    def cell(c: str) -> Column:
        return F.col("r").getField(c)

    same = F.lit(True)
    for c in columns:
        same = same & cell(c).eqNullSafe(F.lit(c))
    header = F.when(~same, F.raise_error(F.concat(F.lit("CSV header does not match the other files' header: "), F.col("file"))))
    kept_row = ~F.col("head") | header.isNotNull()  # the header of a file is no row; one that differs fails the read
    return parsed.where(kept_row).select(*[cell(c).alias(c) for c in columns])


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as string, named by the header; a file whose header differs fails when it is read."""
    named = spark.read.options(**CSV_OPTIONS).csv(path).schema
    ranges = _lines(spark, path).groupBy("file", "start").agg(F.count_if(F.col("quotes") % 2 == 1).alias("odd"))
    states, odd_files = range_states([tuple(r) for r in ranges.collect()])  # one row a byte range
    whole = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").schema(named)
    if len(odd_files) == len({file for file, _ in states}):
        return whole.csv(path)
    records = _records(spark, path, states, odd_files, named.fieldNames())
    return records.union(whole.csv(odd_files)) if odd_files else records


def read_table(spark: SparkSession, path: str, table: str, load_ts: datetime | None = None) -> DataFrame:
    """Read one base table from CSV files with a header row."""
    schema = schemas.BASE_TABLES[table]
    text = read_text(spark, path)
    present = set(text.columns)
    cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in present]
    df = apply_load_defaults(text.select(*cols), table, load_ts)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    df = df.select(*[F.col(f.name) if f.name not in missing else F.lit(None).cast(f.dataType).alias(f.name)
                     for f in schema.fields])
    return df


def count_cast_failures(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Per column, non-empty text values that did not parse into the declared type."""
    schema = schemas.BASE_TABLES[table]
    text = read_text(spark, path)
    aggs = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
            .alias(f.name) for f in schema.fields if f.name in text.columns
            and not isinstance(f.dataType, T.StringType)]
    return text.agg(*aggs) if aggs else text.limit(0)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table as CSV with a header row (S2). Parquet is preferred for anything downstream."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Export a set of tables (e.g. the six base tables) as ``<root>/<table>/`` CSV folders."""
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}", mode)


def read_tables(spark: SparkSession, root: str, load_ts: datetime | None = None) -> dict[str, DataFrame]:
    """Load every base table from ``<root>/<table>/`` CSV folders (S1, S3 input)."""
    return {t: read_table(spark, f"{root.rstrip('/')}/{t}", t, load_ts) for t in schemas.BASE_TABLES}
