"""Language-model scores from a probabilistic suffix tree over words.

The tree's nodes are contexts: the last one, two, ... words of a history. A
context seen ``least`` times or more in training is a candidate. The divergence
test asks whether its next-word distribution tells more than that of its
longest kept suffix: the gain in log likelihood over its own occurrences, each
predicted without itself, must be above ``gain``. The test is made for several
smoothing strengths and the best one stays with the context. A word's
probability comes from the longest kept suffix of its history, smoothed with the
next shorter kept one and so on to the root (add-one word counts).

How it runs: texts become blocks of word numbers. In each round the blocks send what
they need counted (words, then words after contexts of 1, 2, ... words) once per
block, dealt to buckets by hash; a bucket adds up the blocks' counts, tests its
contexts and replies to each block with the totals of the things it asked for.
Every context's counts are spread over as many buckets as its frequency asks for,
so no bucket grows with a frequent context. The model itself never is in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import documents, fold, ranges, slices
from tickweek.session import stored

MOST_PARTITIONS = 20_000  # partitions of a shuffle; a partition may hold several blocks or buckets


@dataclass(frozen=True)
class Settings:
    """What is a context, and how the work is cut. The cuts change no result."""

    depth: int = 2  # words of the longest context
    least: int = 2  # training occurrences of a candidate context
    gain: float = 0.0  # nats by which a kept context must tell more than its suffix
    strengths: tuple[float, ...] = (0.25, 0.5, 1.0, 2.0, 4.0)  # of smoothing, times the occurrences to the power 0.8
    block_bytes: int = 8 << 20  # text of a block; a single longer text is a block alone
    bucket_tokens: int = 2_000_000  # tokens of the corpus per bucket
    hot: int = 1_000_000  # occurrences of a context per bucket that shares it

    def alpha(self, occurrences: np.ndarray) -> np.ndarray:
        """Smoothing strengths [context, choice]."""
        return np.power(np.maximum(occurrences, 1.0), 0.8)[:, None] * np.array(self.strengths)

    def chosen(self, gains: np.ndarray) -> np.ndarray:
        """1 + the strength of the largest gain of each context, 0 where none is above ``gain``."""
        best = gains.argmax(1) if len(gains) else np.zeros(0, np.int64)
        return np.where(gains[np.arange(len(gains)), best] > self.gain, best + 1, 0)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from -1 on, byte plane by byte plane of the width they need, compressed."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(values.max(initial=0)) < 1 << 8 * w - 1)
    planes = np.ascontiguousarray(values + 1, f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").reshape(-1).astype(np.int64) - 1


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _floats(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<f8")


def rough(chances: np.ndarray) -> np.ndarray:
    """Probabilities as whole numbers, 12 binary digits after the leading one; the divergence test needs no more."""
    return (chances.astype("<f4").view("<u4").astype(np.int64) + (1 << 10)) >> 11


def from_rough(numbers: np.ndarray) -> np.ndarray:
    return (numbers << 11).astype("<u4").view("<f4").astype(np.float64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed hash of whole numbers, not negative."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(1)).astype(np.int64)


_BLOCK = "block bigint, keys array<{key}>, sizes binary, train binary, codes binary, words binary, tokens bigint"
_WORDS = "bucket int, block bigint, words binary, counts binary"
_ASKED = "bucket int, block bigint, context binary, salt binary, seen binary, size binary, next binary, counts binary, base binary"
_REPLY = "block bigint, depth int, bucket int, first binary, second binary, third binary, tokens bigint, kinds bigint"


def text_blocks(docs: DataFrame, key: str, train: Column, most: int) -> DataFrame:
    """Blocks of about ``most`` bytes of text: keys, tokens per document, training marks, token codes, vocabulary.

    Code 0 is the end of a document, the empty text in the vocabulary; the others
    go by the words' crc32."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    kind = rows.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in filled(slices(batches, most=most), most):
            # the words of all texts in one array, and each text's number of them
            whole = batch["text"].take(pa.array(np.arange(batch.num_rows)))  # the split is wrong on slices of an array
            split = pc.ascii_split_whitespace(pc.ascii_lower(whole.cast(pa.large_string()).fill_null("")))
            words = split.flatten()
            real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
            ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[np.asarray(split.offsets)]
            sizes = np.diff(ends)
            coded = words.filter(real).dictionary_encode()
            known = coded.dictionary.cast(pa.large_binary()).to_pylist()
            # codes by the words' hash: the words of one bucket are neighbours
            marks = np.fromiter(map(zlib.crc32, known), np.int64, len(known))
            order = np.argsort(marks, kind="stable")
            number = np.empty(len(known), np.int64)
            number[order] = np.arange(1, len(known) + 1)
            codes = np.zeros(len(coded) + len(sizes), np.int64)
            codes[ranges(np.cumsum(sizes + 1) - sizes - 1, sizes)] = number[coded.indices.to_numpy()]
            words = zstandard.ZstdCompressor(level=3).compress(b" ".join([b"", *(known[i] for i in order.tolist())]))
            marks = batch["train"].to_numpy(zero_copy_only=False).astype(np.int64)
            keys = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch["key"])
            row = [packed(sizes + 1), packed(marks), packed(codes), words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), keys, *[pa.array([x], pa.binary()) for x in row], pa.array([len(codes)], pa.int64())],
                ["block", "keys", "sizes", "train", "codes", "words", "tokens"],
            )
            block += 1

    return rows.mapInArrow(run, _BLOCK.format(key=kind.simpleString()))


def filled(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


class Block:
    """One block's tokens, and what the replies so far say of them."""

    def __init__(self, row: dict, buckets: int, tree: Settings, tokens: int = 0, kinds: int = 0) -> None:
        self.tree = tree
        self.buckets, self.total, self.kinds = buckets, tokens, kinds
        self.sizes, self.codes = unpacked(row["sizes"]), unpacked(row["codes"])
        self.train = np.repeat(unpacked(row["train"]).astype(bool), self.sizes)
        self.start = np.zeros(len(self.codes), bool)
        self.start[np.cumsum(self.sizes) - self.sizes] = True

    def word_requests(self, vocabulary: bytes) -> Iterator[tuple]:
        words = zstandard.ZstdDecompressor().decompress(vocabulary).split(b" ")
        counts = np.bincount(self.codes[self.train], minlength=len(words))
        home = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * self.buckets >> 32
        for bucket, rows in _groups(home):
            blob = zstandard.ZstdCompressor(level=3).compress(b" ".join(words[rows[0] : rows[-1] + 1]))
            yield bucket, blob, packed(counts[rows])

    def learn_words(self, replies: list[dict]) -> None:
        """Ids and training counts of the words (id -1, count 0: not in training); buckets follow the codes' order."""
        self.ids = np.concatenate([unpacked(r["first"]) for r in replies])
        self.counts = np.concatenate([unpacked(r["second"]) for r in replies])
        root = (self.counts + 1) / (self.total + self.kinds + 1)
        self.base = root[self.codes]
        self.chance = self.base.copy()
        # Context of each token, by number; -1: none that can be a candidate.
        self.context = np.where(self.start, -1, np.concatenate([[-1], self.codes[:-1]]))
        self.seen, self.names = self.counts, self.ids[:, None]

    def ask(self) -> None:
        """Lay out this depth's candidates: pairs (context, next word), units (context, share), both in bucket order."""
        self.candidate = self.context >= 0
        self.candidate[self.candidate] = self.seen[self.context[self.candidate]] >= self.tree.least
        wanted = self.candidate & (self.ids[self.codes] >= 0)
        at = np.flatnonzero(wanted)
        inverse, pairs = pd.factorize(self.context[at] * len(self.ids) + self.codes[at])
        counts = np.bincount(inverse[self.train[at]], minlength=len(pairs))
        chance = np.zeros(len(pairs))
        chance[inverse] = self.chance[at]
        context, word = np.divmod(pairs, len(self.ids))
        # A context has one unit per share of its occurrences; next words are dealt to them by hash.
        used = np.zeros(len(self.seen), bool)
        used[self.context[self.candidate]] = True
        contexts = np.flatnonzero(used)
        self.number = np.cumsum(used) - 1
        shares = 1 + self.seen[contexts] // self.tree.hot
        first = np.cumsum(shares) - shares
        owner = np.repeat(np.arange(len(contexts)), shares)
        salt = np.arange(len(owner)) - first[owner]
        mark = mixed(salt + 1)
        for column in self.names[contexts[owner]].T:
            mark = mixed(mark + column)
        home = mark % self.buckets
        local = self.number[context]
        unit = first[local] + mixed(self.ids[word] + 7) % shares[local]
        # bucket order: units by bucket and by the first word of their context, pairs by their unit's place
        self.unit_order = np.argsort((home << 42) + self.names[contexts[owner], 0], kind="stable")
        place = np.empty(len(owner), np.int64)
        place[self.unit_order] = np.arange(len(owner))
        self.pair_order = np.argsort(place[unit], kind="stable")
        self.contexts, self.owner, self.home_of_unit = contexts, owner, home[self.unit_order]
        self.salt, self.unit_size = salt, np.bincount(place[unit], minlength=len(owner))
        self.at, self.inverse, self.pairs, self.pair_counts, self.pair_chance = at, inverse, (context, word), counts, chance

    def requests(self) -> Iterator[tuple]:
        context, word = self.pairs
        ends = np.concatenate([[0], np.cumsum(self.unit_size)])
        owner, salt = self.owner[self.unit_order], self.salt[self.unit_order]
        for bucket, rows in _groups(self.home_of_unit):
            pair = self.pair_order[ends[rows[0]] : ends[rows[-1] + 1]]
            name = self.contexts[owner[rows]]
            words = self.names[name].T.copy()
            words[0, 1:] = np.diff(words[0])
            yield (
                bucket, packed(words.reshape(-1)), packed(salt[rows]), packed(self.seen[name]), packed(self.unit_size[rows]),
                packed(self.ids[word[pair]]), packed(self.pair_counts[pair]), packed(rough(self.pair_chance[pair])),
            )

    def learn(self, replies: list[dict]) -> None:
        """Totals and kept contexts of this depth, their probabilities, and the contexts one word longer."""
        total = np.zeros(len(self.pair_order), np.int64)
        choice = np.zeros(len(self.contexts), np.int64)
        if replies:
            total[self.pair_order] = np.concatenate([unpacked(r["first"]) for r in replies])
            owner = self.owner[self.unit_order]
            hot = self.seen[self.contexts[owner]] >= self.tree.hot
            choice[owner[~hot]] = np.concatenate([unpacked(r["second"]) for r in replies])
            gains = np.concatenate([_floats(r["third"]).reshape(-1, len(self.tree.strengths)) for r in replies])
            if len(gains):
                sums = np.zeros((len(self.contexts), len(self.tree.strengths)))
                np.add.at(sums, owner[hot], gains)
                shared = np.unique(owner[hot])
                choice[shared] = self.tree.chosen(sums[shared])
        follows = np.zeros(len(self.codes), np.int64)
        follows[self.at] = total[self.inverse]
        rows = np.flatnonzero(self.candidate)
        local = self.number[self.context[rows]]
        rows, local = rows[choice[local] > 0], local[choice[local] > 0]
        seen = self.seen[self.contexts]
        alpha = self.tree.alpha(seen)[np.arange(len(seen)), np.maximum(choice - 1, 0)]
        self.chance[rows] = (follows[rows] + alpha[local] * self.chance[rows]) / (seen[local] + alpha[local])
        pair = np.full(len(self.codes), -1, np.int64)
        pair[self.at] = self.inverse
        context, word = self.pairs
        self.names = np.hstack([self.names[context], self.ids[word][:, None]])
        self.seen = total
        self.context = np.where(self.start, -1, np.concatenate([[-1], pair[:-1]]))


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key, ascending, with the rows that have it."""
    order = np.argsort(keys, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for rows in np.split(order, cuts):
            yield int(keys[rows[0]]), rows


def _sorted_rows(table: pa.Table, by: str) -> list[dict]:
    return table.sort_by(by).to_pylist()


def _reply(rows: list[tuple]) -> pa.Table:
    names = [p.split()[0] for p in _REPLY.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=names)


def count_words(buckets: int):
    """Bucket task of the words: totals over the blocks, an id for each word of training, and the bucket's own sums."""

    def run(table: pa.Table) -> pa.Table:
        rows = _sorted_rows(table, "block")
        split = [zstandard.ZstdDecompressor().decompress(r["words"]).split(b" ") for r in rows]
        sizes = [len(s) for s in split]
        flat = np.empty(sum(sizes), object)
        flat[:] = [w for s in split for w in s]
        codes, known = pd.factorize(flat)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, codes, np.concatenate([unpacked(r["counts"]) for r in rows]))
        # ids by falling count, so that frequent words have small ones; ties by the word
        order = np.lexsort((np.argsort(np.argsort(known, kind="stable")), -total))
        ids = np.empty(len(known), np.int64)
        bucket = rows[0]["bucket"]
        ids[order] = np.arange(len(known)) * buckets + bucket
        ids[total == 0] = -1
        out = [(None, 0, bucket, b"", b"", b"", int(total.sum()), int((total > 0).sum()))]
        for r, part in zip(rows, np.split(codes, np.cumsum(sizes)[:-1])):
            out.append((r["block"], 0, bucket, packed(ids[part]), packed(total[part]), b"", 0, 0))
        return _reply(out)

    return run


def _numbered(columns: list[np.ndarray]) -> np.ndarray:
    """One number per distinct row of several columns of whole numbers from -1 on."""
    number, kinds = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        values = int(column.max(initial=0)) + 2
        if kinds * values > 1 << 62:
            column, found = pd.factorize(column)
            values = len(found) + 1
        number, found = pd.factorize(number * values + column)
        kinds = max(1, len(found))
    return number


def count_contexts(depth: int, tree: Settings):
    """Bucket task of one depth: totals over the blocks and the divergence test of the contexts dealt here."""

    def run(table: pa.Table) -> pa.Table:
        rows = _sorted_rows(table, "block")
        names = [unpacked(r["context"]).reshape(depth, -1) for r in rows]
        names = np.concatenate([np.concatenate([np.cumsum(x[:1], 1), x[1:]]) for x in names], 1)
        salt, seen, size = (np.concatenate([unpacked(r[c]) for r in rows]) for c in ("salt", "seen", "size"))
        word, counts = (np.concatenate([unpacked(r[c]) for r in rows]) for c in ("next", "counts"))
        base = from_rough(np.concatenate([unpacked(r["base"]) for r in rows]))
        unit = _numbered([*names, salt] if salt.any() else [*names])
        units = int(unit.max(initial=-1)) + 1
        occurrences = np.zeros(units, np.int64)
        occurrences[unit] = seen
        of = np.repeat(unit, size)
        pair = _numbered([of, word])
        pairs = int(pair.max(initial=-1)) + 1
        total = np.zeros(pairs, np.int64)
        np.add.at(total, pair, counts)
        chance, home = np.zeros(pairs), np.zeros(pairs, np.int64)
        chance[pair[::-1]], home[pair[::-1]] = base[::-1], of[::-1]
        gains = np.zeros((units, len(tree.strengths)))
        there = np.flatnonzero(total)
        n, t, p = occurrences[home[there]], total[there], chance[there]
        alpha = tree.alpha(n)
        for k in range(len(tree.strengths)):
            # each occurrence predicted from the others of its context
            without = (t - 1 + alpha[:, k] * p) / (n - 1 + alpha[:, k])
            gains[:, k] = np.bincount(home[there], t * np.log(without / p), units)
        keep = tree.chosen(gains)
        hot = occurrences >= tree.hot
        out = []
        u = v = 0
        for r in rows:
            own = unit[u : u + len(unpacked(r["salt"]))]
            asked = pair[v : v + len(unpacked(r["next"]))]
            u, v = u + len(own), v + len(asked)
            out.append((r["block"], depth, r["bucket"], packed(total[asked]), packed(keep[own[~hot[own]]]), _squeezed(gains[own[hot[own]]]), 0, 0))
        return _reply(out)

    return run


def _table(rows: Iterator[tuple], block: int, kinds: str) -> pa.Table:
    """Request rows of one block; ``kinds`` is their schema text."""
    columns = list(zip(*rows))
    names = [p.split()[0] for p in kinds.split(", ")]
    if not columns:
        columns = [[] for _ in names[:1] + names[2:]]
    n = len(columns[0])
    arrays = [pa.array(columns[0], pa.int32()), pa.array([block] * n, pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]]
    return pa.table(arrays, names=names)


def suffix_tree_scores(docs: DataFrame, train: Column, key: str = "doc_id", tree: Settings = Settings()) -> DataFrame:
    """Scores of every row: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words of the whole ``text`` with A-Z in lower case, then one
    end. Rows where ``train`` holds (NULL: does not) are learned from. ``score`` is the
    model's log10 probability of the tokens, ``base_score`` that of add-one word
    counts. The probabilities of all next words, of the end and of "any other
    word" add up to 1 in every state. A NULL, empty or blank text is the end
    alone; repeated rows and keys are each counted and scored; without training
    rows every probability is 1 at the root, so all scores are 0; an empty table
    gives no rows; other columns are not read.
    """
    blocks = stored(text_blocks(docs, key, train, tree.block_bytes), "token-blocks")
    about = blocks.agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).first()
    kind = blocks.schema["keys"].dataType.elementType
    result = T.StructType(
        [T.StructField(key, kind)]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    )
    if not about.n:
        return docs.sparkSession.createDataFrame([], result)
    buckets = int(about.tokens // tree.bucket_tokens) + 1
    by_block, by_bucket = min(about.n, MOST_PARTITIONS), min(buckets, MOST_PARTITIONS)

    def replies_to(requests: DataFrame, task) -> DataFrame:
        return stored(requests.repartition(by_bucket, "bucket").groupBy("bucket").applyInArrow(task, _REPLY), "replies")

    def first_requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _table(Block(row, buckets, tree).word_requests(row["words"]), row["block"], _WORDS).to_batches()

    replies = [replies_to(blocks.drop("keys", "tokens").mapInArrow(first_requests, _WORDS), count_words(buckets))]
    sums = replies[0].where(F.col("block").isNull()).agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = sums.tokens, sums.kinds

    def restored(row: dict, answers: list[dict], rounds: int) -> Block:
        block = Block(row, buckets, tree, tokens, kinds)
        block.learn_words([r for r in answers if r["depth"] == 0])
        for d in range(1, rounds + 1):
            block.ask()
            block.learn([r for r in answers if r["depth"] == d])
        return block

    def together() -> tuple:
        left = blocks.drop("words").repartition(by_block, "block").groupBy("block")
        said = replies[0].where(F.col("block").isNotNull())
        for r in replies[1:]:
            said = said.unionByName(r)
        return left.cogroup(said.drop("tokens", "kinds").repartition(by_block, "block").groupBy("block"))

    def requests_after(rounds: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.drop_columns(["keys"]).to_pylist()[0]
            block = restored(row, _sorted_rows(right, "bucket"), rounds)
            block.ask()
            return _table(block.requests(), row["block"], _ASKED)

        return run

    for d in range(1, tree.depth + 1):
        replies.append(replies_to(together().applyInArrow(requests_after(d - 1), _ASKED), count_contexts(d, tree)))

    def scores(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.drop_columns(["keys"]).to_pylist()[0]
        block = restored(row, _sorted_rows(right, "bucket"), tree.depth)
        at = np.cumsum(block.sizes) - block.sizes
        known = np.add.reduceat((block.counts[block.codes] > 0).astype(np.int64), at)
        base, score = (np.add.reduceat(np.log10(p), at) for p in (block.base, block.chance))
        keys = left["keys"].combine_chunks().flatten()
        n = len(keys)
        return pa.table([keys, block.sizes, known, np.full(n, tokens, np.int64), base, score], names=result.names)

    return together().applyInArrow(scores, result)


def op13_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = suffix_tree_scores(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
