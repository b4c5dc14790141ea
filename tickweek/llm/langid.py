"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A
word's probability is the sum over all ways to cut it into pieces, by a forward
recursion over its characters; a text's is the product over its words. The
piece probabilities come from expectation maximisation (forward and backward
sums) over words of a sample of labelled texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweek.llm.common import documents, fold, slices

SAMPLE_DOCS = 1500  # labelled texts per language that are learned from (expected number, drawn by a hash of the text)
EM_STEPS = 2
SMOOTHING = 0.1  # added to each piece's expected count
WORD_CHARS = 24  # longer runs of letters are cut: keeps sums in a double's range
UNKNOWN = 1e-9  # probability of a character that is no piece, for every language
CACHE_WORDS = 200_000  # per Python worker; emptied when full
UNDETERMINED = "und"



def _categories(*first: str, last: int) -> str:
    """The characters up to ``last`` of the Unicode categories with these first letters, as ranges of a character class."""
    out, start = [], None
    for i in range(last + 2):
        inside = i <= last and unicodedata.category(chr(i))[0] in first
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(i - 1))}")
            start = None
    return "".join(out)


LAST_LETTER = 0x32FFF  # no letter stands beyond the CJK extensions of planes 2 and 3
LAST_BASIC = 0xFFFF


def _words_up_to(last: int) -> re.Pattern[str]:
    """Words begin with a letter (category L; signs for numbers are none) and go on over letters and combining marks."""
    return re.compile(f"[{_categories('L', last=last)}][{_categories('L', 'M', last=last)}]*")


# A class is one table up to U+FFFF; every range beyond is tried in turn for each character outside, so few texts get it.
_ascii, _basic, _letters = _words_up_to(0x7F), _words_up_to(LAST_BASIC), _words_up_to(LAST_LETTER)
_beyond = re.compile("[\U00010000-\U0010ffff]")
_piece = re.compile(f"[{_categories('L', 'M', last=LAST_LETTER)}]+")


def words(text: str) -> list[str]:
    """Runs of letters in lower case behind a word mark, cut every ``WORD_CHARS`` characters."""
    low = text.lower()
    found = (_ascii if low.isascii() else _letters if _beyond.search(low) else _basic).findall(low)
    if found and len(max(found, key=len)) > WORD_CHARS:
        found = [w[i : i + WORD_CHARS] for w in found for i in range(0, len(w), WORD_CHARS)]
    return ["▁" + w for w in found]


def vocabulary(path: str | None = None) -> dict[str, int]:
    """Pieces of letters (with or without the word mark) and their numbers."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    kept = [p for p in pieces if _piece.fullmatch(p.removeprefix("▁")) or p == "▁"]
    return {p: i for i, p in enumerate(dict.fromkeys(p.lower() for p in kept))}


class Lattice:
    """All cuts of words into pieces; words of one length are worked on together."""

    def __init__(self, pieces: dict[str, int]) -> None:
        self.size = len(pieces)
        self.longest = min(max(map(len, pieces)), WORD_CHARS + 1)
        # A tree of the pieces' characters: a node is a prefix, its children are found by node and character.
        letters = sorted({ord(c) for p in pieces for c in p})
        self.letter = np.zeros(letters[-1] + 2, np.int64)  # 0, and the last one: in no piece
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        children: dict[int, int] = {}
        number = self.letter.tolist()
        ends = np.zeros(len(pieces), np.int64)
        for i, p in enumerate(pieces):
            node = 0
            for c in p:
                node = children.setdefault(node * self.letters + number[ord(c)], len(children) + 1)
            ends[i] = node
        self.ways = np.sort(np.fromiter(children, np.int64, len(children)))
        self.child = np.fromiter((children[w] for w in self.ways.tolist()), np.int64, len(children))
        self.piece = np.full(len(children) + 1, self.size, np.int32)
        self.piece[ends] = np.fromiter(pieces.values(), np.int32, len(pieces))

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word numbers, and piece numbers [word, end, length]; ``size`` stands for none, ``size + 1`` for unknown."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        none = self.size
        for n, all_members in by_length.items():
            for k in range(0, len(all_members), 20_000):
                members = all_members[k : k + 20_000]
                points = np.frombuffer("".join(words[i] for i in members).encode("utf-32-le"), "<u4").reshape(-1, n)
                letters = self.letter[np.minimum(points, len(self.letter) - 1)]
                table = np.full((len(members), n + 1, min(n, self.longest) + 1), none, np.int32)
                row, start = np.divmod(np.arange(len(members) * n), n)
                node = np.zeros(len(row), np.int64)
                for size in range(1, table.shape[2]):  # from every start one character on, while a piece begins so
                    way = node * self.letters + letters[row, start + size - 1]
                    at = np.minimum(np.searchsorted(self.ways, way), len(self.ways) - 1)
                    met = np.flatnonzero(self.ways[at] == way)
                    row, start, node = row[met], start[met], self.child[at[met]]
                    table[row, start + size, size] = self.piece[node]
                    more = np.flatnonzero(start + size < n)
                    row, start, node = row[more], start[more], node[more]
                single = table[:, 1:, 1]
                single[single == none] = none + 1
                yield np.array(members), table

    def forward(self, table: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Sums over the cuts of each prefix, [word, end, language]; ``p`` is [piece, language]."""
        n, length = table.shape[0], table.shape[1] - 1
        sums = np.zeros((n, length + 1, p.shape[1]))
        sums[:, 0] = 1
        for end in range(1, length + 1):
            for k in range(1, min(end, table.shape[2] - 1) + 1):
                piece = table[:, end, k]
                here = np.flatnonzero(piece != self.size)
                sums[here, end] += sums[here, end - k] * p[piece[here]]
        return sums

    def expected(self, table: np.ndarray, p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected count of each piece over all cuts of words that occur ``times``; ``p`` is [piece, 1]."""
        forward = self.forward(table, p)[..., 0]
        p = p[:, 0]
        n, length = table.shape[0], table.shape[1] - 1
        back = np.zeros((n, length + 1))
        back[:, length] = 1
        out = np.zeros(len(p))
        share = times / np.maximum(forward[:, length], 1e-300)
        for end in range(length, 0, -1):
            for k in range(1, min(end, table.shape[2] - 1) + 1):
                piece = table[:, end, k]
                here = np.flatnonzero(piece != self.size)
                step = p[piece[here]] * back[here, end]
                back[here, end - k] += step
                out += np.bincount(piece[here], forward[here, end - k] * step * share[here], len(p))
        return out


@dataclass
class Model:
    """Languages in order of name, piece numbers, and probabilities [piece, language]."""

    languages: list[str]
    pieces: dict[str, int]
    p: np.ndarray


def learn(texts: DataFrame, sample: int = SAMPLE_DOCS, steps: int = EM_STEPS) -> Model:
    """A model from columns ``lang`` and ``text``; NULL in either is left out.

    From each language about ``sample`` rows are drawn by a hash of the text,
    so the sample does not grow with the corpus and is the same for every layout
    of the rows. Equal texts count once. No rows give a model without
    languages.
    """
    spark = texts.sparkSession
    pieces = vocabulary()
    known = texts.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    numbers = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(numbers)
    p = np.full((len(pieces) + 2, len(languages)), 1 / max(1, len(pieces)))
    p[-2], p[-1] = 0, UNKNOWN
    if not languages:
        return Model([], pieces, p)
    share = F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(sample / numbers[k]))))
    draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.withColumn("draw", draw).where(F.col("draw") < F.element_at(share, F.col("lang")))
    drawn = drawn.select("lang", "text").distinct()  # a text with many copies is drawn, and learned from, once

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            frame = [(lang, w) for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()) for w in words(text)]
            if frame:
                yield pa.RecordBatch.from_pydict({"lang": [x[0] for x in frame], "word": [x[1] for x in frame]})

    # Bounded by the sample: its distinct words, kept for the steps below.
    counted = drawn.select("lang", "text").mapInArrow(split, "lang string, word string").groupBy("lang", "word").agg(F.count("*").alias("n"))
    counted = counted.persist()
    for _ in range(steps):
        shared = spark.sparkContext.broadcast((pieces, languages, p))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, languages, p = shared.value
            lattice = Lattice(pieces)
            sums = np.zeros_like(p)
            for batch in batches:
                lang = np.array(batch["lang"].to_pylist(), object)
                word, n = batch["word"].to_pylist(), batch["n"].to_numpy(zero_copy_only=False)
                for k, name in enumerate(languages):
                    own = np.flatnonzero(lang == name)
                    for members, table in lattice.groups([word[i] for i in own]):
                        sums[:, k] += lattice.expected(table, p[:, k : k + 1], n[own[members]])
            piece, k = np.nonzero(sums[:-2])
            yield pa.RecordBatch.from_pydict({"piece": piece.astype(np.int32), "k": k.astype(np.int32), "n": sums[piece, k]})

        rows = counted.mapInArrow(expect, "piece int, k int, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros((len(pieces), len(languages)))  # at most vocabulary x languages numbers
        counts[rows["piece"], rows["k"]] = rows["n"]
        p[:-2] = (counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * len(pieces))
        shared.unpersist()
    counted.unpersist()
    return Model(languages, pieces, p)


class Scorer:
    """Log-probabilities of texts under each language; one per Python worker."""

    def __init__(self, model: Model) -> None:
        self.model, self.lattice = model, Lattice(model.pieces)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.logs = np.zeros((1024, len(self.model.languages)))

    def _learn(self, fresh: list[str]) -> None:
        base = len(self.code)
        while base + len(fresh) > len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        self.code.update(zip(fresh, range(base, base + len(fresh))))
        for members, table in self.lattice.groups(fresh):
            total = self.lattice.forward(table, self.model.p)[:, -1]
            self.logs[base + members] = np.log(np.maximum(total, 1e-300))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Per text the likeliest language and its share of the probability."""
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        split = [words(t) if t else [] for t in texts]
        sizes = np.array([len(x) for x in split])
        codes, unique = pd.factorize(np.array([w for x in split for w in x], object))
        fresh = [w for w in unique if w not in self.code]
        if len(self.code) + len(fresh) > CACHE_WORDS:
            self._clear()
            fresh = list(unique)
        self._learn(fresh)
        logs = self.logs[np.fromiter(map(self.code.__getitem__, unique), np.int64, len(unique))]
        owner = np.repeat(np.arange(len(texts)), sizes)
        sums = np.stack([np.bincount(owner, logs[codes, k], len(texts)) for k in range(logs.shape[1])], 1)
        shares = np.exp(sums - sums.max(1, keepdims=True))
        shares /= shares.sum(1, keepdims=True)
        best = sums.argmax(1)
        names = [self.model.languages[b] if n else UNDETERMINED for b, n in zip(best, sizes)]
        return names, np.where(sizes > 0, shares[np.arange(len(texts)), best], 0.0)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``id`` (any column called so), ``lang_pred`` and ``score`` of each row's whole ``text``.

    A NULL, empty or letterless text is ``und`` with score 0; equal texts score
    alike; of equally likely languages the first by name wins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            names, scores = scorer.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, lang_pred string, score double")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 4) == 2
    model = learn(docs.where(~held_out).select("lang", "text"))
    found = identify(docs.select(F.col("doc_id").alias("id"), "text"), model)
    return found.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score")
