"""Token counts of a byte-level BPE vocabulary without building the tokens.

Whole-token shortcut: loading merges every vocabulary string by the merge rules and keeps those that end as one
token; a pre-token among them counts one. The other distinct pre-tokens of a task are merged by vectorised rounds
(``merge_rounds.py``), each once. No shuffle: memory is bounded by a slice of texts and the table of pre-tokens.

NULL and empty texts have no tokens; long texts are counted whole; repeated rows give repeated rows. Strings of added
tokens inside a text count one each, as is the library's default. Other input columns are not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from productlens.llm.merge_rounds import PairTable, merge_rounds
from productlens.llm.tasks import Growing, WordTable, prepare, slices, texts_of

# The pre-token pattern of byte-level BPE, with Unicode white space written out.
WHITE = r"\t-\r \x85\xa0  -     　"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+"
           r"|[" + WHITE + r"]+(?![^" + WHITE + r"])|[" + WHITE + r"]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Counter:
    """Pattern, merge table and whole tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("byte-level BPE without normaliser and prefix space is supported")
        vocab = model["vocab"]
        self.added = [t["content"] for t in spec["added_tokens"]]
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that strip or need word ends are not supported")
        self.added_split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.pattern = regex.compile(PATTERN)
        symbols = byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairTable([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], np.arange(len(pairs)),
                               [vocab[a + b] for a, b in pairs], max(vocab.values()) + 1)
        byte_of = {s: b for b, s in enumerate(symbols)}
        texts = {}
        for t in vocab:
            try:
                texts[bytes(byte_of[c] for c in t).decode()] = t
            except (KeyError, UnicodeDecodeError):
                continue  # an added token, or a part of a character, which is never a whole pre-token
        strings = list(texts)
        self.whole = [s for s, n in zip(strings, self._merged(strings)) if n == 1]
        self.size = Growing(np.int64)
        self.table = WordTable(lambda new: self.size.extend(self._merged(new)), self._restart)
        self._restart()

    def _restart(self) -> None:
        """Only the whole tokens are known."""
        self.size.clear()
        self.table.ids.update(zip(self.whole, range(len(self.whole))))
        self.size.extend(np.ones(len(self.whole), np.int64))

    def _merged(self, pre_tokens: list[str]) -> np.ndarray:
        data = [t.encode() for t in pre_tokens]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        return merge_rounds(self.byte_id[np.frombuffer(b"".join(data), np.uint8)], lengths, self.pairs)[1]

    def counts(self, texts: list[str]) -> np.ndarray:
        added, lists = np.zeros(len(texts), np.int64), []
        for i, t in enumerate(texts):
            if self.added and any(s in t for s in self.added):
                parts = self.added_split.split(t)
                added[i] = len(parts) - 1
                lists.append([w for p in parts for w in self.pattern.findall(p)])
            else:
                lists.append(self.pattern.findall(t))
        words = pa.array([w for own in lists for w in own], pa.string()).dictionary_encode()
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        distinct = words.dictionary.to_pylist()
        self.table.see([distinct])
        tokens = self.size.data[self.table.index(distinct)][words.indices.to_numpy()]
        owner = np.repeat(np.arange(len(texts)), lengths)
        return added + np.bincount(owner, weights=tokens, minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row's whole text."""
    prepare(docs.sparkSession)

    def run(batches):
        c = counter(tokenizer)
        for b in slices(batches, "text"):
            texts = texts_of(b, "text")
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), size, pa.array(c.counts(texts))],
                                             ["id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col))
