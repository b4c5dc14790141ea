"""Quality classifier: random-indexing word vectors and a small calibrated network.

Every term (a word, a run of signs, or a mark such as "all capitals") has a
sparse random index vector. A term's vector adds up the index vectors of its
neighbours over the whole corpus; terms share ``BUCKETS`` rows by hash, so the
table has a fixed size. A document is the mean of its terms' unit vectors. Two
dense layers in numpy turn it into a score whose temperature is fitted on
labelled rows that training did not see.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import documents, fold, lean, slices, table

BUCKETS = 1 << 14
DIMENSIONS = 64
ENTRIES = 2  # non-zero entries of an index vector
BLOCKS = 32  # the table travels in so many blocks of rows
LABELLED = 20_000  # most labelled documents that the network is fitted on
HIDDEN = 32
EPOCHS = 40
REJECT_BELOW = 0.3

_terms = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_CACHE = 300_000


class Terms:
    """Bucket numbers of a batch of texts' terms; one per Python worker."""

    def __init__(self) -> None:
        self.known: dict[str, list[int]] = {}

    @staticmethod
    def buckets(term: str) -> list[int]:
        """The term's bucket, and that of a mark for its shape where it has one."""
        marks = [term.lower()]
        if term.isupper() and len(term) > 1:
            marks.append("<capitals>")
        elif term.isdigit():
            marks = ["<digits>"]
        return [zlib.crc32(m.encode()) % BUCKETS for m in marks]

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all terms in order, and each text's number of them."""
        split = [_terms.findall(t) if t else [] for t in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        codes, unique = pd.factorize(np.array([w for x in split for w in x], object))
        del split
        if len(self.known) > _CACHE:
            self.known = {}
        known, rows = self.known, []
        for w in unique:
            if w not in known:
                known[w] = self.buckets(w)
            rows.append(known[w])
        first = np.array([r[0] for r in rows], np.int64)
        mark = np.array([r[1] if len(r) > 1 else -1 for r in rows], np.int64)
        # a term that repeats the one before it counts as a mark of its own
        again = zlib.crc32(b"<again>") % BUCKETS
        repeat = np.concatenate([[False], codes[1:] == codes[:-1]]) if len(codes) else np.zeros(0, bool)
        both = np.stack([first[codes], np.where(repeat, again, mark[codes])], 1) if len(codes) else np.zeros((0, 2), np.int64)
        keep = both >= 0
        owner = np.repeat(np.arange(len(texts)), sizes)
        return both[keep], np.bincount(np.repeat(owner, keep.sum(1)), minlength=len(texts))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bucket's non-zero entries."""
    random = np.random.default_rng(11)
    return random.integers(0, DIMENSIONS, (BUCKETS, ENTRIES)), random.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors [bucket, dimension] from all texts of ``docs``; NULL texts add nothing."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        terms = Terms()
        sums = np.zeros(BUCKETS * DIMENSIONS)
        for batch in slices(batches):
            bucket, sizes = terms.batch(batch["text"].to_pylist())
            inner = np.ones(max(len(bucket) - 1, 0), bool)  # neighbours of one text
            ends = np.cumsum(sizes)
            inner[ends[(ends > 0) & (ends < len(bucket))] - 1] = False
            left, right = bucket[:-1][inner], bucket[1:][inner]
            for a, b in ((left, right), (right, left)):
                for e in range(ENTRIES):
                    sums += np.bincount(a * DIMENSIONS + places[b, e], signs[b, e], len(sums))
        part = TaskContext.get().partitionId()
        blocks = sums.astype("<f4").reshape(BLOCKS, -1)
        filled = [i for i in range(BLOCKS) if blocks[i].any()]
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(filled, pa.int32()), "part": pa.array([part] * len(filled), pa.int32()), "sums": pa.array([blocks[i].tobytes() for i in filled], pa.binary())}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # at most the whole table
        for batch in batches:
            for block, sums in zip(batch["block"].to_pylist(), batch["sums"].to_pylist()):
                got = np.frombuffer(sums, "<f4").astype(np.float64)
                total[block] = total[block] + got if block in total else got
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(list(total), pa.int32()), "part": pa.array([0] * len(total), pa.int32()), "sums": pa.array([x.astype("<f4").tobytes() for x in total.values()], pa.binary())}
        )

    kind = "block int, part int, sums binary"
    partial = docs.select("text").mapInArrow(lean(gather), kind)
    # Added up in two levels, each task streaming over its rows.
    level = partial.withColumn("part", F.pmod("part", F.lit(16))).repartition("block", "part").mapInArrow(lean(add), kind)
    level = level.repartition("block").mapInArrow(lean(add), kind)
    vectors = np.zeros((BLOCKS, BUCKETS * DIMENSIONS // BLOCKS), np.float64)
    for r in level.collect():  # BLOCKS rows at most
        vectors[r.block] = np.frombuffer(r.sums, "<f4")
    vectors = vectors.reshape(BUCKETS, DIMENSIONS)
    places, signs = index_vectors()
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    for e in range(ENTRIES):  # a term's own index vector keeps it apart from its neighbours
        vectors[np.arange(BUCKETS), places[:, e]] += signs[:, e]
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(vectors: np.ndarray, bucket: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean vector of each text's terms; zeros where it has none."""
    out = np.zeros((len(sizes), vectors.shape[1]))
    start = 0
    for i, n in enumerate(sizes.tolist()):
        for k in range(start, start + n, 50_000):
            out[i] += vectors[bucket[k : min(k + 50_000, start + n)]].sum(0, dtype=np.float64)
        if n:
            out[i] /= n
        start += n
    return out


@dataclass
class Network:
    """Two dense layers over standardised inputs; ``temperature`` divides the last one's output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Train on four fifths of the rows and set the temperature on the rest; without rows every score is 0.5."""
    random = np.random.default_rng(5)
    dims = x.shape[1]
    net = Network(
        x.mean(0) if len(x) else np.zeros(dims), (x.std(0) if len(x) else np.ones(dims)) + 1e-6,
        random.normal(0, (2 / dims) ** 0.5, (dims, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0,
    )
    if not len(x):
        return net
    net.w2 = random.normal(0, HIDDEN**-0.5, HIDDEN)
    order = random.permutation(len(x))
    rest, train = order[: len(x) // 5], order[len(x) // 5 :]
    z = (x - net.mean) / net.scale
    keys = ("w1", "b1", "w2", "b2")
    first, second = {k: 0.0 for k in keys}, {k: 0.0 for k in keys}
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(train), max(1, len(train) // 128)):
            hidden = np.maximum(z[rows] @ net.w1 + net.b1, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, net.w2) * (hidden > 0)
            slope = {"w1": z[rows].T @ back + 1e-4 * net.w1, "b1": back.sum(0), "w2": hidden.T @ error + 1e-4 * net.w2, "b2": error.sum()}
            step += 1
            for k in keys:  # Adam
                first[k] = 0.9 * first[k] + 0.1 * slope[k]
                second[k] = 0.999 * second[k] + 0.001 * slope[k] ** 2
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - 0.003 * move)
    if len(rest):
        logit, target = net.logit(x[rest]), y[rest]

        def loss(t: float) -> float:
            return float(np.logaddexp(0, np.where(target > 0.5, -1, 1) * logit / t).mean())

        net.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def learn(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """Word vectors from all of ``docs``; the network from ``labels`` (doc_id, quality) joined to them.

    At most ``most`` labelled ids are used, those of the smallest hash. An id
    with several labels counts as good when at least half of them are 1; NULL
    ids or labels are left out; of several documents of one id one is taken.
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    target = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    chosen = target.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the bound of the broadcast below
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    shared = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in slices(batches):
            pooled = pool(shared.value, *terms.batch(batch["text"].to_pylist())).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], pa.array([x.tobytes() for x in pooled], pa.binary())], ["doc_id", "y", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(lean(run), f"doc_id {kind}, y double, x binary").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    sample = sorted(got.collect(), key=lambda r: r.doc_id)  # at most `most` rows
    x = np.array([np.frombuffer(r.x, "<f4") for r in sample], np.float64).reshape(-1, DIMENSIONS)
    return Model(vectors, fit(x, np.array([r.y for r in sample])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in the struct ``row``, and their ``score``.

    A NULL or empty text has no terms and gets the network's score of the zero
    vector; equal texts score alike; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for whole in batches:
            flat = pa.RecordBatch.from_arrays([whole["row"].field("text"), whole["row"]], ["text", "row"])
            for batch in slices([flat]):
                x = pool(shared.value.vectors, *terms.batch(batch["text"].to_pylist()))
                yield pa.RecordBatch.from_arrays([batch["row"], pa.array(shared.value.network.score(x))], ["row", "score"])

    return packed.mapInArrow(lean(run), T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())]))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", "quality").where(fold(F.col("doc_id"), 5) != 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learn(docs, training_labels(table(spark, sf_dir, "labels")))
    doc_id = F.col("row.doc_id")
    return score(docs, model).select(
        doc_id.alias("doc_id"),
        (fold(doc_id, 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the rows that score under ``below``; columns as they were."""
    return score(docs, model).where(F.col("score") >= below).select("row.*")
