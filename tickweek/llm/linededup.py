"""Line dedup by a log-template tree.

The tree has a fixed depth: a line's number of tokens, then its first ``LEAD``
tokens; tokens that hold a digit count as a field. Tokens are runs without white
space; in scripts that put none between words each character is one. A leaf's templates are its
lines as they are and its lines with one of ``BLOCKS`` stretches of tokens left
open, so lines that differ in one variable stretch meet in one template. A line
goes if one of its templates recurs in enough independent documents.

Documents that are copies of each other say nothing about a template: what
counts is the number of near-duplicate classes among the documents that hold it
(``neardup.signature_classes``), however many copies a class has. Only documents
that hold a template of enough documents are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import SLICE_BYTES, documents, lean, no_nulls, replaced, slices, without_empty
from tickweek.llm.neardup import signature_classes
from tickweek.session import drop_stored, stored

LEAD = 3
BLOCKS = 4
OPEN_TOKENS = 8  # lines of fewer tokens have no template with an open stretch
DOCUMENTS = 5  # independent documents that make a template recurring
KEYS = [f"key{b}" for b in range(1 + BLOCKS)]
FIELD = "<*>"
# Thai, Lao, Tibetan, Burmese, Khmer, Japanese and Chinese, as Python and Java write them in a character class
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3001-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff61-\uff9f\U00020000-\U0003fffd"
# White space beyond ASCII
_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# A short line without a letter or digit (a bracket, a rule) is layout, not text, and stays.
_WORD = r"[\p{L}\p{N}]"

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    out = h >> np.uint64(32)
    out ^= h
    for _ in range(2):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def tokens_in(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all lines in a row, and each line's number of them."""
    wide = pc.invert(pc.string_is_ascii(lines))
    if pc.any(wide).as_py():
        spaced = replaced(replaced(lines.filter(wide), _SPACE, " "), f"([{UNSPACED}])", r" \1 ")
        lines = pc.replace_with_mask(lines, wide, spaced)
    flat, ends = without_empty(pc.ascii_split_whitespace(lines))
    return flat, np.diff(ends)


def have_digit(tokens: pa.Array) -> np.ndarray:
    """Whether some character of each token is a digit, as ``str.isdigit`` has it."""
    found = pc.match_substring_regex(tokens, "[0-9]").to_numpy(zero_copy_only=False).copy()
    wide = np.flatnonzero(~found & ~pc.string_is_ascii(tokens).to_numpy(zero_copy_only=False))
    numbers = pc.match_substring_regex(tokens.take(pa.array(wide)), r"\p{N}").to_numpy(zero_copy_only=False)
    for i in wide[numbers]:
        found[i] = any(c.isdigit() for c in tokens[i].as_py())
    return found


def templates(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, ...]:
    """Of every line with a template: text number, line number, leaf, template keys [line, 1 + BLOCKS], whether it has open ones."""
    split = pc.split_pattern(no_nulls(texts), "\n")
    lines, offsets = split.flatten(), np.asarray(split.offsets)
    tokens, n = tokens_in(lines)
    kept = (n > 2) | (n > 0) & pc.match_substring_regex(lines, _WORD).to_numpy(zero_copy_only=False)
    if not kept[n > 0].all():
        tokens = tokens.filter(pa.array(np.repeat(kept, n)))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    number = np.arange(len(lines)) - offsets[owner]
    owner, number, n = owner[kept], number[kept], n[kept]
    if not len(n):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros((0, 1 + BLOCKS), np.int64), np.zeros(0, bool)
    coded = tokens.dictionary_encode()
    codes = coded.indices.to_numpy()
    masked = pc.replace_with_mask(coded.dictionary, pa.array(have_digit(coded.dictionary)), pa.scalar(FIELD, coded.dictionary.type))
    masked = masked.to_numpy(zero_copy_only=False)
    start = np.cumsum(n) - n
    place = np.arange(1, len(codes) + 1, dtype=np.uint64)  # in the line, from 1
    place -= np.repeat(start.astype(np.uint64), n)
    place *= _P
    place += pd.util.hash_array(masked, categorize=False)[codes]
    value = _mix(place)
    size = _mix(n.astype(np.uint64))
    whole = np.add.reduceat(value, start) + size
    leaf = size + sum(np.where(n > i, value[start + np.minimum(i, n - 1)], np.uint64(0)) for i in range(LEAD))
    keys = np.empty((len(n), 1 + BLOCKS), np.uint64)
    keys[:, 0] = _mix(whole)
    open_ = n >= OPEN_TOKENS
    sums = np.concatenate([[np.uint64(0)], np.cumsum(value)])  # wraps around, differences stay right
    for b in range(BLOCKS):
        a, z = start + n * b // BLOCKS, start + n * (b + 1) // BLOCKS
        keys[:, 1 + b] = _mix(whole - (sums[z] - sums[a]) + np.uint64(b + 1))
    return owner, number, _mix(leaf).view(np.int64), keys.view(np.int64), open_


def firsts(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key is its owner's first such (owner and key are hashed together)."""
    both = _mix(keys.view(np.uint64) + _mix(owner.astype(np.uint64) * _P + np.uint64(1)))
    return ~pd.Series(both).duplicated().to_numpy()


def _lines(rows: DataFrame) -> DataFrame:
    """``rid, line, leaf, key0 .. key4`` of each template line (NULL: it has no such key); ``first`` and the bits of ``news`` mark where a text meets the leaf and each key first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            owner, line, leaf, keys, open_ = templates(batch["text"])
            if not len(owner):
                continue
            width = np.where(open_, 1 + BLOCKS, 1)
            chosen = np.arange(1 + BLOCKS) < width[:, None]
            new = np.zeros(chosen.shape, bool)
            new[chosen] = firsts(np.repeat(owner, width), keys[chosen])
            news = new @ (1 << np.arange(1 + BLOCKS, dtype=np.int32))
            rid = batch["rid"].to_numpy()[owner]
            flat = [pa.array(keys[:, 0]), *(pa.array(keys[:, b], mask=~open_) for b in range(1, 1 + BLOCKS))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid), pa.array(line.astype(np.int32)), pa.array(leaf), pa.array(firsts(owner, leaf)), pa.array(news.astype(np.int32)), *flat],
                ["rid", "line", "leaf", "first", "news", *KEYS],
            )

    kind = f"rid bigint, line int, leaf bigint, first boolean, news int, {', '.join(f'{k} bigint' for k in KEYS)}"
    return rows.select("rid", F.col("row.text").alias("text")).mapInArrow(lean(run), kind)


def recurring_lines(rows: DataFrame, documents_: int = DOCUMENTS) -> DataFrame:
    """``rid`` and the sorted numbers ``drop`` of its lines whose template recurs.

    A text counts once for a leaf or template, however many of its lines meet there. Counts are summed before every shuffle and per (template, class) first, so a
    line that a third of all documents hold is spread over many tasks.
    """
    lines = stored(_lines(rows), "line-templates")
    leaves = lines.groupBy("leaf").agg(F.sum(F.col("first").cast("long")).alias("n")).where(F.col("n") >= documents_)
    keys = [F.struct(F.col(k).alias("key"), (F.col("news").bitwiseAND(1 << b) != 0).alias("news")) for b, k in enumerate(KEYS)]
    open_ = lines.join(leaves.select("leaf"), "leaf").select("rid", "line", F.inline(F.array(*keys))).where("key is not null")
    # No template has more classes than documents: most lines end here.
    often = open_.groupBy("key").agg(F.sum(F.col("news").cast("long")).alias("n")).where(F.col("n") >= documents_)
    held = stored(open_.join(often.select("key"), "key").select("rid", "line", "key"), "line-held")
    drop_stored(lines)
    # the texts are not sorted for the join: the other side is their numbers alone
    holders = rows.join(held.select("rid").distinct().hint("shuffle_hash"), "rid").select(F.col("rid").alias("doc_id"), F.col("row.text").alias("text"))
    classes = signature_classes(holders, apart=UNSPACED).select(F.col("doc_id").alias("rid"), "class")
    counts = held.join(classes, "rid").select("key", "class").distinct().groupBy("key").agg(F.count("*").alias("n"))
    recurring = counts.where(F.col("n") >= documents_).select("key")
    return held.join(recurring, "key").groupBy("rid").agg(F.sort_array(F.collect_set("line")).alias("drop"))


def dedup_lines(docs: DataFrame, documents_: int = DOCUMENTS) -> DataFrame:
    """Rows of ``docs`` (struct ``row``) with the recurring lines left out of ``text``, and ``n_lines, n_dropped``.

    Lines end at line feeds. Empty lines, and lines of one or two tokens without a
    letter or digit, always stay. Every row stays, with NULL or empty text as it is; a text of which
    every line goes becomes empty. ``n_chars``, where it exists, follows a changed
    text. Repeated rows are copies: they count as one document and change alike.
    """
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "line-rows")
    met = rows.join(recurring_lines(rows, documents_).hint("shuffle_hash"), "rid", "left").select("row", "drop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, drop = batch["row"], batch["drop"].to_pylist()
            fields = {f.name: row.field(f.name) for f in row.type}
            text = fields["text"]
            counts = pc.add(pc.cast(pc.count_substring(text, "\n"), pa.int64()), pc.cast(pc.greater(pc.binary_length(text), 0), pa.int64()))
            changed = {}
            for i, gone in enumerate(drop):
                if gone:
                    gone = set(gone)
                    changed[i] = "\n".join(x for k, x in enumerate(text[i].as_py().split("\n")) if k not in gone)
            if changed:
                rewritten = np.zeros(len(drop), bool)
                rewritten[list(changed)] = True
                fields["text"] = pc.replace_with_mask(text, pa.array(rewritten), pa.array(changed.values(), text.type))
                if "n_chars" in fields:
                    n = fields["n_chars"].to_pylist()
                    fields["n_chars"] = pa.array([len(changed[i]) if i in changed else v for i, v in enumerate(n)], fields["n_chars"].type)
            out = pa.StructArray.from_arrays(list(fields.values()), fields=list(row.type))
            dropped = [len(x) if x else 0 for x in drop]
            yield pa.RecordBatch.from_arrays([out, pc.fill_null(counts, 0), pa.array(dropped, pa.int64())], ["row", "n_lines", "n_dropped"])

    fields = [met.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    return met.mapInArrow(lean(run), T.StructType(fields))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "row.text")
