"""Filling containers of a fixed number of tokens.

Conflict-constrained best fit: pieces come in falling size; the open bins lie ordered by the room they have left,
each with bitmaps of the sources and duplicate clusters it holds; where a bitmap tells of a conflict, the bin's exact
set decides. The search goes from the tightest bin that fits to wider ones until a compatible one is found. A cluster
of one conflicts with nothing. As little room left as possible comes first: where no open bin is
compatible, the tightest one that fits is taken rather than a new one opened (``strict=True`` opens one instead).

Documents are dealt to shards by a hash of their id, so a source or a cluster of copies with a third of all rows
is spread evenly; each shard is packed by itself and leaves at most its last bins partly empty.

Defined cases: an empty, blank or null text of no tokens takes a place of size 0; a document over the capacity is
cut into full containers and a remainder, which is packed like any other piece; an empty table gives no rows.
"""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .tokenizer import count_column

CAPACITY = 2048
#: Rows of a shard, 40 bytes each in Python: what one task packs.
SHARD_ROWS = 50_000
SCHEMA = "container_id long, place int, doc_id long, piece_no int, token_start int, n_tokens int"


class Packer:
    """Bins ordered by residual: ``free`` has a bit for each residual that some bin has."""

    def __init__(self, capacity: int, strict: bool = False):
        self.capacity, self.strict = capacity, strict
        self.free = 0
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.residual: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[set[tuple[str, object]]] = []
        self.source_bits: dict[object, int] = {}
        self.cluster_bits: dict[object, int] = {}

    def _bit(self, table: dict[object, int], key: object) -> int:
        """A bit of a 64-bit signature; different keys may share one, and the exact set tells them apart."""
        if key is None:
            return 0
        return table.setdefault(key, 1 << (len(table) % 64))

    def _conflict(self, b: int, s: int, source: object, c: int, cluster: object) -> bool:
        if not (self.clusters[b] & c or self.sources[b] & s):
            return False
        held = self.held[b]
        return bool(c) and ("c", cluster) in held or bool(s) and ("s", source) in held

    def place(self, size: int, source: object = None, cluster: object = None) -> int:
        s, c = self._bit(self.source_bits, source), self._bit(self.cluster_bits, cluster)
        found, fallback = -1, -1
        mask = self.free >> size
        room = size
        while mask:
            step = (mask & -mask).bit_length() - 1  # successor of ``room`` among the residuals in use
            room += step
            mask >>= step + 1
            bins = self.bins[room]
            if size == 0:
                found = bins[-1]
                break
            if fallback < 0:
                fallback = bins[-1]
            found = next((b for b in reversed(bins) if not self._conflict(b, s, source, c, cluster)), -1)
            if found >= 0:
                break
            room += 1
        if found < 0 and fallback >= 0 and not self.strict:
            found = fallback
        if found < 0:
            found = len(self.residual)
            self.residual.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
            self.held.append(set())
        elif size:
            held = self.bins[self.residual[found]]
            held.remove(found) if held[-1] != found else held.pop()
            if not held:
                self.free &= ~(1 << self.residual[found])
        if size or not self.bins[self.residual[found]]:
            self.residual[found] -= size
            self.bins[self.residual[found]].append(found)
            self.free |= 1 << self.residual[found]
        self.sources[found] |= s
        self.clusters[found] |= c
        if s:
            self.held[found].add(("s", source))
        if c:
            self.held[found].add(("c", cluster))
        return found


def pack_sizes(sizes, capacity: int = CAPACITY, sources=None, clusters=None, strict: bool = False) -> list[tuple[int, int, int, int, int, int]]:
    """``(bin, place, item, piece, start, size)`` of each piece of the items with these sizes."""
    pieces = []
    for item, size in enumerate(sizes):
        size = int(size)
        start = 0
        while size - start > capacity:
            pieces.append((capacity, item, start // capacity, start))
            start += capacity
        pieces.append((size - start, item, start // capacity, start))
    # of equal sizes the sources and clusters take turns, so that neighbours seldom conflict
    turns: dict[object, int] = defaultdict(int)
    order = []
    for n, (size, item, *_) in enumerate(pieces):
        turn = 0
        if sources is not None or clusters is not None:
            for key in (("s", size, sources[item]) if sources is not None else None, ("c", size, clusters[item]) if clusters is not None else None):
                if key is not None:
                    turn = max(turn, turns[key])
                    turns[key] += 1
        order.append((-size, turn, n))
    pieces = [pieces[n] for _, _, n in sorted(order)]
    packer, places, out = Packer(capacity, strict), defaultdict(int), []
    members = Counter(clusters) if clusters is not None else {}
    for size, item, piece, start in pieces:
        cluster = None if clusters is None or members[clusters[item]] < 2 else clusters[item]
        b = packer.place(size, None if sources is None else sources[item], cluster)
        out.append((b, places[b], item, piece, start, size))
        places[b] += 1
    return out


def pack(sized: DataFrame, shards: int, capacity: int = CAPACITY, strict: bool = False) -> DataFrame:
    """Places of ``sized(doc_id, n_tokens, source, cluster)`` in containers."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("doc_id", kind="stable")
        shard = int(pdf["shard"].iloc[0])
        ids = pdf["doc_id"].to_numpy()
        rows = pack_sizes(pdf["n_tokens"].tolist(), capacity, pdf["source"].tolist(), pdf["cluster"].tolist(), strict)
        return pd.DataFrame(
            {
                "container_id": [(shard << 40) + r[0] for r in rows], "place": [r[1] for r in rows], "doc_id": [ids[r[2]] for r in rows],
                "piece_no": [r[3] for r in rows], "token_start": [r[4] for r in rows], "n_tokens": [r[5] for r in rows],
            }
        )

    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(run, SCHEMA)


def containers(documents: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, strict: bool = False) -> DataFrame:
    """Containers of all documents by the tokens of ``text``; only sizes and hashes are shuffled."""
    shards = max(1, -(-documents.count() // shard_rows))
    keyed = spread(documents).where("doc_id is not null").select(
        "doc_id", "text", F.pmod(F.xxhash64("source"), F.lit(1 << 30)).cast("int").alias("source"), F.xxhash64("text").alias("cluster")
    )
    sized = count_column(keyed, "text", ["doc_id", "source", "cluster"])
    return pack(sized, shards, capacity, strict)


def p8_containers(spark, sf_dir: str) -> DataFrame:
    return containers(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
