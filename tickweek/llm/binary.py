"""Packed token ids in binary form: best fit decreasing with a segment tree.

Each task tokenizes its documents and packs them block by block. In a block the
pieces are placed from the longest to the shortest, each into the open sequence
with the least room that still holds it; a segment tree over the amounts of
room finds that sequence in log(capacity) steps. A row of the result is one
sequence: its ids, the cumulative lengths of its segments, the position ids that
start again at every segment, and which part of which document a segment is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweek.llm.common import documents, slices
from tickweek.llm.tokens import SEPARATOR, Encoder

CAPACITY = 2048
BLOCK_TOKENS = 4_000_000  # ids that a task packs at a time: 16 MB
PAD = 0

SCHEMA = (
    "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
    "segments array<struct<rid:bigint,doc_id:bigint,piece:int>>"
)


class Rooms:
    """Open sequences by the room they have left; a segment tree over 0 .. capacity."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.width)  # number of open sequences below a node
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The sequence with the smallest room of at least ``least`` (and that room), no longer open."""
        node = least + self.width
        if not self.filled[node]:
            # up until a right neighbour has something, then down its left side
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.width
        sequence = self.open[room].pop()
        self._count(room, -1)
        return sequence, room

    def _count(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.filled[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences of piece numbers; pieces of equal length keep their order."""
    rooms = Rooms(capacity)
    out: list[list[int]] = []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = rooms.take(lengths[k])
        if found is None:
            found = len(out), capacity
            out.append([])
        sequence, room = found
        out[sequence].append(k)
        rooms.put(sequence, room - lengths[k])
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK_TOKENS) -> DataFrame:
    """Packed sequences of all texts of ``docs`` (columns of ``SCHEMA``).

    ``ids`` and ``position_ids`` are little-endian unsigned 32-bit numbers, each
    ``capacity`` long; behind ``n_tokens`` both are padding. A document's ids end
    with the separator, so NULL and empty texts have one id. Documents of more
    than ``capacity`` ids are cut every ``capacity`` ids; nothing is dropped.
    ``rid`` numbers the rows of ``docs``, so repeated rows and NULL ids stay
    apart; an empty table gives no sequences. Only ``doc_id`` and ``text`` are read.
    """

    def pack(pieces: list[tuple[int, int | None, int, np.ndarray]], base: int) -> pa.RecordBatch:
        rows = []
        for k, members in enumerate(best_fit_decreasing([len(p[3]) for p in pieces], capacity)):
            sizes = [len(pieces[m][3]) for m in members]
            used = sum(sizes)
            ids, places = np.full(capacity, PAD, "<u4"), np.zeros(capacity, "<u4")
            ids[:used] = np.concatenate([pieces[m][3] for m in members])
            places[:used] = np.concatenate([np.arange(n) for n in sizes])
            segments = [{"rid": pieces[m][0], "doc_id": pieces[m][1], "piece": pieces[m][2]} for m in members]
            rows.append((base + k, used, ids.tobytes(), [0, *np.cumsum(sizes).tolist()], places.tobytes(), segments))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
        kinds.append(pa.list_(pa.struct([("rid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())])))
        names = ["sequence_id", "n_tokens", "ids", "cu_seqlens", "position_ids", "segments"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        base = TaskContext.get().partitionId() << 36
        pieces: list[tuple[int, int | None, int, np.ndarray]] = []
        held = 0
        end = np.array([SEPARATOR], np.uint32)
        for batch in slices(batches):
            for rid, doc, text in zip(*(batch[c].to_pylist() for c in ("rid", "doc_id", "text"))):
                ids = np.concatenate([encoder.ids(text), end])
                for k, a in enumerate(range(0, len(ids), capacity)):
                    pieces.append((rid, doc, k, ids[a : a + capacity]))
                held += len(ids)
                if held >= block:
                    for made in _rows(pieces, pack, base):
                        base += made.num_rows
                        yield made
                    pieces, held = [], 0
        if pieces:
            yield from _rows(pieces, pack, base)

    slim = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA)


def _rows(pieces, pack, base: int) -> Iterator[pa.RecordBatch]:
    """A block's sequences in batches of at most 1,000 rows (16 MB)."""
    whole = pack(pieces, base)
    for a in range(0, whole.num_rows, 1000):
        yield whole.slice(a, 1000)


def write_packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> None:
    packed(docs, capacity).write.mode("errorifexists").parquet(path)


def unpack(sequences: DataFrame) -> DataFrame:
    """``rid, doc_id, ids`` (array, without the separator) of every document: the inverse of ``packed``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ids, ends, segments in zip(*(batch[c].to_pylist() for c in ("ids", "cu_seqlens", "segments"))):
                values = np.frombuffer(ids, "<u4")
                for a, b, s in zip(ends, ends[1:], segments):
                    rows.append((s["rid"], s["doc_id"], s["piece"], values[a:b].tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["rid", "doc_id", "piece", "ids"])

    parts = sequences.select("ids", "cu_seqlens", "segments").mapInArrow(run, "rid bigint, doc_id bigint, piece int, ids array<bigint>")
    whole = parts.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("p"))
    ids = F.flatten("p.ids")
    return whole.select("rid", "doc_id", F.slice(ids, F.lit(1), F.size(ids) - 1).alias("ids"))


def op6_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
