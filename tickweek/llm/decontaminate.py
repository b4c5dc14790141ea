"""Benchmark decontamination with a generalised suffix automaton over item words.

The items' words become small integers and all items one automaton: a state
stands for a set of word sequences with the same end places. Document words
stream through it; at each word the automaton gives the length of the longest
sequence ending there that some item holds. A stretch of at least ``WINDOW``
words, or the whole of a shorter item, marks its words as hit.

Only runs whose neighbouring words are neighbours in some item are streamed:
every match lies inside such a run, so this changes no result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import documents, lean, slices, table
from tickweek.session import drop_stored, stored

WINDOW = 10
# Items are dealt to automata of at most about this many bytes of item text. An
# automaton takes some 30 bytes of memory for each, in the driver that
# builds it and in each worker; larger benchmarks take one pass after another.
AUTOMATON_BYTES = 8 << 20
# Fixed value: the word pattern, applied after A-Z became lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Limits for removal: a hit span of this many words goes (1: every hit span); a
# document of which this share of the words is hit goes whole.
SPAN_WORDS = 1
COVERAGE = 0.5

_word = re.compile(WORD)


def lower_ascii(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode().lower().decode()


def words(text: str | None) -> list[str]:
    return _word.findall(lower_ascii(text)) if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences and what each state stands for.

    States are rows of flat arrays. Most states have one move (word, target) and
    one owning item; only those with more have a dict or set of their own.
    """

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[str, int] = {}
        self.word, self.target = array("q", [-1]), array("q", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("q", [-1]), array("q", [0])
        self.names: list[str | None] = []
        coded = []
        for item, tokens in items:
            ids = array("q", [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens])
            if ids:
                self.names.append(item)
                coded.append(ids)
        self.shortest = min([window, *map(len, coded)])
        self.base = max(1, len(self.vocabulary))
        flat = [np.frombuffer(ids, np.int64) for ids in coded]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(x[:-1] * self.base + x[1:] for x in flat)]))
        for ids in coded:
            state = 0
            for w in ids:
                state = self._extend(state, w)
        self._climb(coded)

    def _climb(self, coded: list[array]) -> None:
        """Per state: the one up its links that stands for its last ``window`` words, and the nearest that ends a short item."""
        count = len(self.length)
        order = np.argsort(np.frombuffer(self.length, np.int64), kind="stable").tolist()  # links come first
        self.top = array("q", range(count))
        for state in order[1:]:
            up = self.link[state]
            if self.length[up] >= self.window:
                self.top[state] = self.top[up]
        # Items by the state of each of their windows; whole short items by their
        # end state, with their length (a state may stand for longer sequences).
        self.owner = array("q", [-1]) * count
        self.owners: dict[int, set[int]] = {}
        self.whole: dict[int, tuple[int, set[int]]] = {}
        for item, ids in enumerate(coded):
            state = 0
            for i, w in enumerate(ids, 1):
                state = self._move(state, w)
                if i >= self.window:
                    self._own(self.top[state], item)
            if len(ids) < self.window:
                self.whole.setdefault(state, (len(ids), set()))[1].add(item)
        self.short = array("q", [-1]) * count
        for state in order[1:]:
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def _own(self, state: int, item: int) -> None:
        if self.owner[state] < 0:
            self.owner[state] = item
        elif self.owner[state] != item:
            self.owners.setdefault(state, {self.owner[state]}).add(item)

    def _move(self, state: int, w: int) -> int:
        """Where ``w`` leads from ``state``, or -1."""
        if self.word[state] == w:
            return self.target[state]
        others = self.more.get(state)
        return others.get(w, -1) if others else -1

    def _set(self, state: int, w: int, target: int) -> None:
        if self.word[state] in (-1, w):
            self.word[state], self.target[state] = w, target
        else:
            self.more.setdefault(state, {})[w] = target

    def _extend(self, last: int, w: int) -> int:
        """Append ``w`` to the sequence that ``last`` ends; return the new end's state."""
        there = self._move(last, w)
        if there >= 0:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, there, w)
        new = self._state(self.length[last] + 1, 0)
        p, q = last, -1
        while p >= 0 and (q := self._move(p, w)) < 0:
            self._set(p, w, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _state(self, length: int, link: int) -> int:
        for column, value in ((self.word, -1), (self.target, -1), (self.length, length), (self.link, link)):
            column.append(value)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """Part ``q``'s shorter sequences, those reached from ``p``, off into their own state."""
        clone = self._state(self.length[p] + 1, self.link[q])
        self.word[clone], self.target[clone] = self.word[q], self.target[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        self.link[q] = clone
        while p >= 0 and self._move(p, w) == q:
            self._set(p, w, clone)
            p = self.link[p]
        return clone

    def match(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Hit word ranges ``(start, end)`` of a run of known words, and the items hit.

        A word looks at one state for the windows and at fewer than ``window``
        for short items, however long the match is."""
        state = size = 0
        found: list[tuple[int, int]] = []
        windows: set[int] = set()
        items: set[int] = set()
        for i, w in enumerate(ids, 1):
            while (on := self._move(state, w)) < 0 and state:
                state = self.link[state]
                size = self.length[state]
            if on >= 0:
                state, size = on, size + 1
            if size >= self.window:
                windows.add(self.top[state])
                found.append((i - size, i))
            up = self.short[state]
            while up > 0:
                n, short = self.whole[up]
                if n <= size:
                    items |= short
                    found.append((i - n, i))
                up = self.short[self.link[up]]
        for up in windows:
            items |= self.owners.get(up) or {self.owner[up]}
        return merged(found), {self.names[k] for k in items}


def scan(automaton: ItemAutomaton, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], set[str | None]]]:
    """Per text: number of words, hit word ranges in order, items hit."""
    tokens: list[str] = []
    ends = []
    for text in texts:
        tokens += words(text)
        ends.append(len(tokens))
    get = automaton.vocabulary.get
    ids = np.fromiter((get(w, -1) for w in tokens), np.int64, len(tokens))
    del tokens
    # known[i]: word i occurs in an item; joined[i]: words i, i+1 are neighbours in one
    known = ids >= 0
    joined = np.zeros(max(len(ids) - 1, 0), bool)
    both = np.flatnonzero(known[:-1] & known[1:])
    code = ids[both] * automaton.base + ids[both + 1]
    if len(automaton.pairs):
        at = np.minimum(np.searchsorted(automaton.pairs, code), len(automaton.pairs) - 1)
        joined[both] = automaton.pairs[at] == code
    limits = np.array(ends, np.int64)
    joined[limits[:-1][(limits[:-1] > 0) & (limits[:-1] < len(ids))] - 1] = False  # not across texts
    # runs: maximal stretches of known words whose neighbours are joined
    starts = np.flatnonzero(known & ~np.concatenate([[False], joined])[: len(ids)])
    stops = np.flatnonzero(known & ~np.concatenate([joined, [False]])[: len(ids)]) + 1
    long = stops - starts >= automaton.shortest
    starts, stops = starts[long], stops[long]
    first = np.searchsorted(starts, np.concatenate([[0], limits]))
    begin = 0
    for k, end in enumerate(ends):
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        for r in range(first[k], first[k + 1]):
            found, hit = automaton.match(ids[starts[r] : stops[r]].tolist())
            spans += [(int(starts[r]) - begin + a, int(starts[r]) - begin + b) for a, b in found]
            items |= hit
        yield end - begin, spans, items
        begin = end


_HITS = "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<string>>"


def automata(benchmark: DataFrame, window: int = WINDOW, most: int = AUTOMATON_BYTES) -> Iterator[ItemAutomaton]:
    """Automata that together hold every item; each is built from at most about ``most`` bytes.

    Items are dealt by a running total of their bytes (item sizes alone, in
    their own order), so the number of automata follows the benchmark's size.
    A single larger item makes one larger automaton.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("text").isNotNull())
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    pieces = int(total // most) + 1
    piece = F.pmod(F.xxhash64("item", "text"), F.lit(pieces))
    for k in range(pieces):
        yield ItemAutomaton([(r.item, words(r.text)) for r in rows.where(piece == k).collect()], window)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = AUTOMATON_BYTES, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None
) -> DataFrame:
    """All columns of ``docs`` inside the struct ``row``, and ``hits`` (word count, spans, items).

    ``spans`` are word ranges, sorted and disjoint, that some item window
    covers; ``items`` the ids (as text, sorted) of the items with an occurring
    window. A NULL or empty text has no words and no hits; items with a NULL
    text, or without words, hit nothing; the words of an item with a NULL id
    are hit, but no id is listed for them; repeated item ids count once; an
    empty benchmark gives no hits; repeated documents are each judged alike.
    With ``then`` the result is what it makes of each batch of these: ``row`` alone.
    """
    context = docs.sparkSession.sparkContext
    marked, passed, held, own = docs.select(F.struct("*").alias("row"), F.lit(None).cast(_HITS).alias("hits")), None, None, False
    for automaton in automata(benchmark, window, most):
        if held is not None:
            # One automaton at a time: the pass before is written, then its automaton and its input go.
            done = stored(passed, "contamination")
            held.destroy()
            if own:
                drop_stored(marked)
            marked, own = done, True
        held = context.broadcast(automaton)
        passed = _pass(marked, held)
    return _pass(marked, held, then) if then else passed


def _pass(marked: DataFrame, automaton, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    schema = T.StructType([marked.schema["row"]] if then else [f for f in marked.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            flat = pa.RecordBatch.from_arrays(
                [whole.column("row").field("text"), whole.column("row"), whole.column("hits")], ["text", "row", "hits"]
            )
            for batch in slices([flat]):
                hits = []
                before = batch.column("hits").to_pylist()
                for old, (n, spans, items) in zip(before, scan(automaton.value, batch.column("text").to_pylist())):
                    if old:
                        spans = merged([*((s["start"], s["stop"]) for s in old["spans"]), *spans])
                        items = items | set(old["items"])
                    hits.append({"n_words": n, "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(items - {None})})
                column = pa.array(hits, whole.column("hits").type)
                out = pa.RecordBatch.from_arrays([batch.column("row"), column], ["row", "hits"])
                yield then(out) if then else out

    return marked.mapInArrow(lean(run), schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, overlapping or touching ranges joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _word.finditer(lower_ascii(text))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, span_words: int = SPAN_WORDS, coverage: float = COVERAGE, most: int = AUTOMATON_BYTES
) -> DataFrame:
    """``docs`` without hit spans of ``span_words`` words or more; documents hit to ``coverage`` go.

    Columns and other rows stay as they are; rows with NULL or empty text stay;
    ``n_chars``, if there, follows the new text. The search and the cut share one
    Python worker a task: a second one would hold its memory beside the first.
    """

    def without(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, short = [], []
        for hits in batch.column("hits").to_pylist():
            n_hit = sum(s["stop"] - s["start"] for s in hits["spans"])
            keep.append(not (n_hit > 0 and n_hit >= hits["n_words"] * coverage))
            if keep[-1]:
                short.append([(s["start"], s["stop"]) for s in hits["spans"] if s["stop"] - s["start"] >= span_words])
        rows = batch.column("row").filter(pa.array(keep, pa.bool_()))
        names = [f.name for f in rows.type]
        text = rows.field("text").to_pylist()
        changed = {i for i, x in enumerate(short) if x}
        fields = {n: rows.field(n) for n in names}
        if changed:
            new = [cut(t, x) if i in changed else t for i, (t, x) in enumerate(zip(text, short))]
            fields["text"] = pa.array(new, fields["text"].type)
            if "n_chars" in fields:
                n = fields["n_chars"].to_pylist()
                fields["n_chars"] = pa.array([len(new[i]) if i in changed else v for i, v in enumerate(n)], fields["n_chars"].type)
        return pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([fields[n] for n in names], fields=list(rows.type))], ["row"])

    return find_contamination(docs, benchmark, window, most, without).select("row.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
