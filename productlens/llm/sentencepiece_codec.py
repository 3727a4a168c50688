"""SentencePiece (BPE with byte fallback) encoding and decoding of a corpus.

The text becomes segments that no piece can cross; each distinct segment of a task is encoded once by vectorised
merge rounds (``merge_rounds.py``) and a text's ids are gathered from its segments. No shuffle: memory is bounded by
a slice of texts and the segment table.

NULL and empty texts have no ids and decode to the empty string. Long texts are encoded whole. Repeated rows give
repeated rows. The input's other columns are not read, so clashing names do no harm.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from productlens.llm.merge_rounds import PairTable, merge_rounds
from productlens.llm.tasks import Growing, WordTable, list_array, prepare, ranges, slices

SPACE = "▁"
CODE_POINTS = 0x110000


class Codec:
    """Vocabulary of a model file and the tables for merging; encodes and decodes lists of texts."""

    def __init__(self, path: str):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=path)
        size = vocabulary.get_piece_size()
        self.size = size
        pieces = [vocabulary.id_to_piece(i) for i in range(size)]
        bytes_ = [i for i in range(size) if vocabulary.is_byte(i)]
        special = {i for i in range(size) if vocabulary.is_control(i) or vocabulary.is_unknown(i)}
        normal = {p: i for i, p in enumerate(pieces)
                  if not (i in special or vocabulary.is_byte(i) or vocabulary.is_unused(i))}
        self.unknown = vocabulary.unk_id()
        self.byte_id = np.full(256, self.unknown, np.int32)
        for i in bytes_:
            self.byte_id[int(pieces[i][3:5], 16)] = i
        #: what each id decodes to
        raw = [b"" if i in special and i != self.unknown else p.replace(SPACE, " ").encode()
               for i, p in enumerate(pieces)]
        for i in bytes_:
            raw[i] = bytes([int(pieces[i][3:5], 16)])
        self.raw_size = np.array([len(b) for b in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.leading_space = np.array([p.startswith(SPACE) for p in pieces])
        self._merges(normal, vocabulary)
        self._segments(normal)
        self.flat, self.start, self.count = Growing(np.int32), Growing(np.int64), Growing(np.int64)
        self.table = WordTable(self._encode_new, self._forget)

    def _merges(self, normal: dict[str, int], vocabulary) -> None:
        """Pairs of symbols that make a piece, ranked by score. Runs of spaces are left out: their pieces share the
        lowest score, so they merge last, the leftmost pair first; ``_split_run`` has what a run becomes."""
        runs = {len(p): i for p, i in normal.items() if len(p) > 1 and not p.strip(SPACE)}
        scores = {i: vocabulary.get_score(i) for p, i in normal.items() if len(p) > 1 and i not in runs.values()}
        lowest = min(scores.values(), default=0.0)
        if len({vocabulary.get_score(i) for i in runs.values()} | {lowest}) > 2 \
                or any(vocabulary.get_score(i) >= lowest for i in runs.values()):
            raise ValueError("runs of spaces must share the lowest score")
        if len(set(scores.values())) != len(scores):
            raise ValueError("pieces must have scores of their own")
        if any(p.strip(SPACE) and SPACE in p.lstrip(SPACE) or p.strip(SPACE) and p.startswith(SPACE * 2) for p in normal):
            raise ValueError("a piece may have a space at its start only")
        self.run_ids = {1: normal[SPACE], **runs}
        self.longest_run = max(self.run_ids)
        self.short_runs = [self._merged_run(k) for k in range(self.longest_run)]
        if any(self._merged_run(self.longest_run + k) != [self.longest_run, *self.short_runs[k]]
               for k in range(self.longest_run)):
            raise ValueError("a run of spaces must begin with the longest piece")
        order = sorted(scores, key=lambda i: -scores[i])
        rank_of = {i: r for r, i in enumerate(order)}
        symbol = {c: normal.get(c, self.size + ord(c)) for p in normal for c in p} | normal
        left, right, rank = [], [], []
        for p, i in normal.items():
            if i not in rank_of:
                continue
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(rank_of[i])
        self.pairs = PairTable(left, right, rank, order, self.size + CODE_POINTS)
        self.symbol_of = np.arange(self.size, self.size + CODE_POINTS, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i

    def _merged_run(self, k: int) -> list[int]:
        """Piece lengths of k spaces, by merging the leftmost pair that makes a piece again and again."""
        run = [1] * k
        while (at := next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in self.run_ids), None)) is not None:
            run[at: at + 2] = [run[at] + run[at + 1]]
        return run

    def _segments(self, normal: dict[str, int]) -> None:
        """No piece has a space after another character (checked above); a line break cuts too if no piece has one."""
        line = "" if any("\n" in p for p in normal if len(p) > 1) else "\\n"
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + (f"|{line}+" if line else ""))

    def _forget(self) -> None:
        for a in (self.flat, self.start, self.count):
            a.clear()

    def _encode_new(self, segments: list[str]) -> None:
        """Append the ids of new segments to the flat array."""
        # of leading spaces only the last can merge with what follows
        extra = {i: len(s) - len(s.lstrip(SPACE)) - 1 for i, s in enumerate(segments) if s.startswith(SPACE * 2)}
        cores = [s[extra.get(i, 0):] for i, s in enumerate(segments)] if extra else segments
        lengths = np.fromiter(map(len, cores), np.int64, len(cores))
        codes = np.frombuffer("".join(cores).encode("utf-32-le"), np.uint32)
        sym, counts = merge_rounds(self.symbol_of[codes], lengths, self.pairs)
        sym, counts = self._fall_back(sym, counts)
        if extra:
            sym, counts = self._spaces(sym, counts, extra)
        self.start.extend(self.flat.size + np.cumsum(counts) - counts)
        self.count.extend(counts)
        self.flat.extend(sym)

    def _fall_back(self, sym: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero(sym >= self.size)
        if not odd.size:
            return sym, counts
        owner = np.repeat(np.arange(len(counts)), counts)
        codes = sym[odd] - self.size
        width = np.ones(sym.size, np.int64)
        width[odd] = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        data = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        out = np.repeat(sym, width)
        out[ranges((np.cumsum(width) - width)[odd], width[odd])] = self.byte_id[data]
        return out, np.bincount(np.repeat(owner, width), minlength=len(counts))

    def _spaces(self, sym, counts, extra) -> tuple[np.ndarray, np.ndarray]:
        """Put back the leading spaces: longest runs from the left, then the rest."""
        one, whole, out, sizes, at = self.run_ids[1], self.run_ids[self.longest_run], [], [], 0
        for i, n in enumerate(counts.tolist()):
            k, own = extra.get(i, 0), sym[at: at + n]
            at += n
            if k:
                if n and own[0] == one:
                    k, own = k + 1, own[1:]
                full, rest = divmod(k, self.longest_run)
                tail = [self.run_ids[x] for x in self.short_runs[rest]]
                own = np.concatenate([np.full(full, whole), tail, own]).astype(np.int32)
            out.append(own)
            sizes.append(len(own))
        return np.concatenate(out), np.array(sizes, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and each text's number of ids; NULL has none.

        Words between spaces are made distinct by Arrow's dictionary encoding, so Python handles each once a slice.
        Texts with several spaces in a row, at an end, or with the space symbol itself are cut by ``_cut``.
        """
        words = pc.split_pattern(pc.fill_null(texts, ""), " ")
        per_text = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        odd = np.fromiter((not w or SPACE in w for w in distinct), bool, len(distinct))
        code = coded.indices.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), per_text)
        by_cut = np.unique(owner[odd[code]])
        cut = [self.cut.findall(SPACE + t.replace(" ", SPACE)) if t else []
               for t in (texts[i].as_py() for i in by_cut.tolist())]
        segments = [SPACE + w for w in distinct]
        self.table.see([segments, *cut])
        at = self.table.index(segments)[code]
        if by_cut.size:
            plain = ~np.isin(owner, by_cut)
            owner = np.concatenate([owner[plain], np.repeat(by_cut, [len(x) for x in cut])])
            at = np.concatenate([at[plain], *(self.table.index(x) for x in cut)])
            order = np.argsort(owner, kind="stable")
            owner, at = owner[order], at[order]
        size = self.count.data[at]
        counts = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        return self.flat.data[ranges(self.start.data[at], size)], counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of id lists that lie behind each other: pieces joined, bytes as UTF-8, without the space that
        encoding puts first."""
        size = self.raw_size[ids]
        data = self.raw[ranges(self.raw_start[ids], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[np.cumsum(counts)].tolist()
        first = np.append(ids, 0)[np.cumsum(counts) - counts]
        skip = (self.leading_space[first] & (np.asarray(counts) > 0)).tolist()
        return [data[a + k: b].decode("utf-8", "replace") for a, b, k in zip([0, *ends], ends, skip)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row; with ``decoded`` also the text that the ids decode to."""
    prepare(docs.sparkSession)

    def run(batches):
        c = codec(model)
        for b in slices(batches, "text"):
            ids, counts = c.encode(b.column("text"))
            out = [b.column("id"), list_array(ids, counts)]
            yield pa.RecordBatch.from_arrays(out + [pa.array(c.decode(ids, counts))] * decoded,
                                             ["id", "ids", "decoded"][: 2 + decoded])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decoded)
            .withColumnRenamed("id", id_col))


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row's ids; NULL reads as no ids."""
    prepare(df.sparkSession)

    def run(batches):
        c = codec(model)
        for b in batches:
            lists = b.column("ids")
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(c.decode(flat, counts), pa.string())],
                                             ["id", "text"])

    kind = dict(df.dtypes)[id_col]
    return (df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))
            .mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col))
