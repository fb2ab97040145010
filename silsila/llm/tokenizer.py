"""Encoding with a public byte-level BPE vocabulary.

A word of the vocabulary's splitting pattern is encoded by backtracking: Aho-Corasick gives the longest token at
each byte, a token is accepted if the merges allow it beside the token before it (pair compatibility), else a
shorter one is tried. This gives the exact merges in time linear in the word. Words that were met before come from
a bounded table, since a word's ids do not depend on its neighbours. Decoding looks tokens up in an offset table.

Defined cases: a null and an empty text have no ids; strings of special tokens in a text are ordinary text.
"""
from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import spread

NAME = "byte_bpe_50k"
DEFAULT_FOLDER = "/opt/tokenizers"
#: Words kept in the table of a worker; beyond it the table starts anew.
KNOWN_WORDS = 300_000


def vocabulary_path(name: str = NAME, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("SILSILA_TOKENIZERS", DEFAULT_FOLDER), f"{name}.json")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable bytes stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of words that were met before."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        ids = self.make(word)
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """``encode`` and ``decode`` of one vocabulary file."""

    #: Splitting pattern of the vocabulary.
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import ahocorasick
        import numpy as np
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        raw = {token: bytes(letters[c] for c in token) for token in model["vocab"] if all(c in letters for c in token)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merged = {a + b for a, b in merges}
        raw = {t: b for t, b in raw.items() if len(b) == 1 or t in merged}
        ids = {token: model["vocab"][token] for token in raw}
        size = max(ids.values()) + 1
        self.rank = [0] * size  # of the merge that makes the token, 0 for single bytes
        self.parts = [(i, i) for i in range(size)]
        self.pair: dict[tuple[int, int], int] = {}
        for n, (a, b) in enumerate(merges, 1):
            token = ids[a + b]
            self.rank[token], self.parts[token] = n, (ids[a], ids[b])
            self.pair[ids[a], ids[b]] = token
        data: list[bytes] = [b""] * size
        for token, b in raw.items():
            data[ids[token]] = b
        by_bytes = {b: i for i, b in enumerate(data) if b}
        self.shorter = [-1] * size  # the longest token that begins this one
        for b, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in by_bytes), -1)
        self.length = [len(b) for b in data]
        self.automaton = ahocorasick.Automaton()
        for b, i in by_bytes.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum(self.length, out=self.offsets[1:])
        self.blob = b"".join(data)
        self.words = regex.compile(self.PATTERN).findall
        self.known = _Known(self.encode_word)

    def _fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` apart when they stand side by side."""
        rank, parts, pair = self.rank, self.parts, self.pair
        limit = 1 << 60
        while True:
            joined = pair.get((left, right))
            if joined is not None and rank[joined] < limit:
                return False
            # undo the later of the two merges; what is undone bounds the merges that may come earlier
            if rank[left] > rank[right]:
                limit = rank[left]
                left = parts[left][1]
            elif rank[right]:
                limit = rank[right] + 1
                right = parts[right][0]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "replace")
        size = len(data)
        longest, reach = [-1] * size, [0] * size
        length, shorter, fits = self.length, self.shorter, self._fits
        for end, token in self.automaton.iter(data.decode("latin-1")):
            start = end + 1 - length[token]
            if length[token] > reach[start]:
                longest[start], reach[start] = token, length[token]
        out: list[int] = []
        open_end = bytearray(b"\1") * (size + 1)
        at, token = 0, longest[0]
        while at < size:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + length[token]
                if open_end[end] and (last < 0 or fits(last, token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at < size:
                    token = longest[at]
            else:
                open_end[at] = 0
                token = out.pop()
                at -= length[token]
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.known.__getitem__, self.words(text))))

    def decode(self, ids: list[int]) -> str:
        blob, offsets = self.blob, self.offsets
        return b"".join(blob[offsets[i] : offsets[i + 1]] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def shipped(df: DataFrame, path: str) -> str:
    """The name under which the vocabulary file goes to the executors with the job; it need not lie on their machines."""
    df.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def _received(name: str) -> str:
    from pyspark import SparkFiles

    return SparkFiles.get(name)


def encode_column(df: DataFrame, text: str, keep: list[str], ids: str = "ids", path: str | None = None) -> DataFrame:
    """``keep`` and the token ids of ``text`` for every row; narrow, no shuffle."""
    name = shipped(df, path or vocabulary_path())
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = encoder(_received(name)).encode
        for batch in batches:
            flat, offsets = array("i"), [0]
            for value in batch.column(0):
                flat.extend(encode(value.as_py()))
                offsets.append(len(flat))
            values = pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32))
            rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], rows], names=[*keep, ids])

    return df.select(text, *keep).mapInArrow(run, schema)


def count_column(df: DataFrame, text: str, keep: list[str], count: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``keep`` and the number of tokens of ``text`` for every row; narrow, no shuffle."""
    name = shipped(df, path or vocabulary_path())
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(count, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(_received(name)).encode
        for batch in batches:
            sizes = pa.array([len(encode(v.as_py())) for v in batch.column(0)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], sizes], names=[*keep, count])

    return df.select(text, *keep).mapInArrow(run, schema)


def p7_ids(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_column(spread(documents), "text", ["doc_id"])
