"""Corpus operators against plain-Python versions and on awkward rows."""

import collections
import hashlib
import random
import re
import time
import tracemalloc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import types as T

from tickweek.llm import binary, common, decontaminate, fingerprint, langid, licenses, linededup, neardup, packing, quality, sharding
from tickweek.llm.common import lean, spread
from tickweek.llm.tokens import Encoder
from tickweek.plans.explain import plan_text

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("rid", T.LongType()),
        T.StructField("size", T.StringType()),
        T.StructField("part", T.IntegerType()),
    ]
)
WORDS = [a + b for a in ("an", "be", "co", "de", "el", "fu", "go") for b in ("ra", "ti", "mo", "su", "ne", "pi")]


def make(seed=3, n=60):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 60))) for _ in range(n)]
    texts += [texts[0], texts[0], None, "", "  \n\t ", "x" * 5000, "é世界 " * 50, "word " * 6000, "Is <|endoftext|> here\n\n a  b"]
    near = texts[5].split() * 3
    texts += [" ".join(near), " ".join([*near, "tail"])]
    rows = [(i, t, rnd.choice(["en", "fr", None]), "s", len(t or ""), "r", 7, "z", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[1], None, None, None, None, None, None, None)] * 2 + [(3, "again three", "en", "s", 11, "r", 1, "z", 1)] * 2
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make(), SCHEMA).repartition(3, "n_chars", "text")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_encoder_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Encoder()
    odd = ["it's  'll", "a\n", " a", "x\n\ny", "don\n't", "１2 ３", "a\x1cb", "　wide", "ab" * 3000]
    for text in [r[1] for r in make()] + odd:
        assert encoder.ids(text).tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_packing_is_gapless_and_whole(docs, empty):
    capacity = 128
    rows = packing.pack(docs, capacity).collect()
    encoder = Encoder()
    want = collections.Counter()
    for r in make():
        ids = [*encoder.ids(r[1]).tolist(), 0]
        first = len(ids) % capacity or capacity
        cuts = [0, len(ids)] if len(ids) <= capacity else [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter(tuple(r[:5]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= 1.1 * sum(r.length for r in rows) / capacity + 1
    assert packing.pack(empty, capacity).count() == 0


def test_patterns_hold_the_histogram_and_beat_best_fit():
    rnd = random.Random(5)
    histogram = dict(collections.Counter(int(rnd.gauss(700, 120)) for _ in range(3000)))
    patterns = packing.solve(histogram, 2048)
    held = collections.Counter()
    for copies, pattern in patterns:
        assert sum(n * k for n, k in pattern) <= 2048
        for n, k in pattern:
            held[n] += copies * k
    assert held == histogram
    plain = sum(c for c, _ in packing.best_fit_decreasing(dict(histogram), 2048))
    assert sum(c for c, _ in patterns) <= plain


def test_knapsack_against_all_choices():
    rnd = random.Random(2)
    for _ in range(30):
        lengths = np.array(sorted(rnd.sample(range(1, 12), 4)))
        values, most, room = np.array([rnd.random() for _ in lengths]), np.array([rnd.randint(0, 3) for _ in lengths]), rnd.randint(1, 25)
        found = packing.best_configuration(lengths, values, most, room)
        assert sum(lengths[i] * k for i, k in found.items()) <= room and all(k <= most[i] for i, k in found.items())
        grid = np.stack(np.meshgrid(*[np.arange(m + 1) for m in most]), -1).reshape(-1, len(lengths))
        best = (grid @ values)[grid @ lengths <= room].max()
        assert abs(sum(values[i] * k for i, k in found.items()) - best) < 1e-9


def test_sharding_by_bytes(docs, empty):
    rows = sharding.shard_by_bytes(docs, 4).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in make()
    )
    total = sum(r.size for r in rows)
    for shard in range(4):
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 4) <= max(r.size for r in rows)
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    assert sharding.shard_by_bytes(empty).count() == 0


def brute_hits(items, text, window):
    w = decontaminate.words(text)
    hit, found = set(), set()
    for name, x in items:
        for i in range(max(1, len(x) - window + 1) if x else 0):
            part = x[i : i + window]
            for k in range(len(w) - len(part) + 1):
                if w[k : k + len(part)] == part:
                    hit.update(range(k, k + len(part)))
                    found.add(name)
    return len(w), len(hit), found


def test_automaton_against_windows():
    rnd = random.Random(1)
    for _ in range(300):
        window = rnd.choice([2, 3, 4])
        items = [(str(k), [rnd.choice("abc") for _ in range(rnd.randint(0, 7))]) for k in range(rnd.randint(0, 4))]
        texts = [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 20))) for _ in range(5)] + [None, ""]
        for text, (n, spans, found) in zip(texts, decontaminate.scan(decontaminate.ItemAutomaton(items, window), texts)):
            assert (n, sum(b - a for a, b in spans), found) == brute_hits(items, text, window)


def test_automaton_of_equal_words_and_its_size():
    """Long repeats are matched in linear time, and a state takes a few flat numbers."""
    started = time.perf_counter()
    automaton = decontaminate.ItemAutomaton([("a", ["la"] * 100_000), ("b", ["la"] * 3)])
    (n, spans, found), = decontaminate.scan(automaton, [" ".join(["la"] * 100_000)])
    assert (n, spans, found) == (100_000, [(0, 100_000)], {"a", "b"}) and time.perf_counter() - started < 20
    rnd = random.Random(3)
    words = [f"w{rnd.randint(0, 20_000)}" for _ in range(150_000)]
    tracemalloc.start()
    automaton = decontaminate.ItemAutomaton([(str(k), words[k : k + 100]) for k in range(0, len(words), 100)])
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert size < 40 * sum(len(w) + 1 for w in words)
    (_, spans, found), = decontaminate.scan(automaton, [" ".join(["x", *words[5:40], "y"])])
    assert (spans, found) == ([(1, 36)], {"0"})


def test_decontamination_of_a_table(spark, docs, empty):
    texts = {r[0]: r[1] for r in make()}
    items = [(1, texts[2]), (2, texts[7]), (2, texts[7]), (None, texts[9]), (4, None), (5, "!!!"), (6, "again three")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    pairs = [(None if i is None else str(i), decontaminate.words(t)) for i, t in items]
    for most in (decontaminate.AUTOMATON_BYTES, 200):  # one automaton, several
        for r in decontaminate.find_contamination(docs, bench, most=most).collect():
            n, hit, found = brute_hits(pairs, r.row.text, 10)
            assert (r.hits.n_words, sum(s.stop - s.start for s in r.hits.spans)) == (n, hit)
            assert r.hits["items"] == sorted(found - {None})
    out = decontaminate.decontaminate(docs, bench)
    assert out.columns == docs.columns and decontaminate.find_contamination(empty, bench).count() == 0
    kept = out.collect()
    assert not any(brute_hits(pairs, r.text, 10)[1] for r in kept)
    clean = [r for r in make() if not brute_hits(pairs, r[1], 10)[1]]
    assert not collections.Counter(clean) - collections.Counter(map(tuple, kept))
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs, none).count() == docs.count()


def test_cut_removes_span_and_what_is_between():
    assert decontaminate.cut("Aa, bb cc! dd", [(1, 3)]) == "Aa, ! dd"


def brute_components(rows):
    sets = []
    for r in rows:
        w = [x for x in (r[1] or "").encode().lower().split()]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for k in range(i):
            y = sets[k]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(i)] = root(k)
    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[root(i)].append(r[0])
    least = {k: min([d for d in v if d is not None], default=None) for k, v in ids.items()}
    return collections.Counter((r[0], len(s), least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets)))


def test_near_duplicates(spark, docs, empty):
    found = neardup.near_duplicates(docs)
    got = found.select("row.doc_id", "n_shingles", "component_id", "keeper").collect()
    assert collections.Counter(tuple(r[:3]) for r in got) == brute_components(make())
    some = [r for r in got if r.n_shingles]
    assert sum(r.keeper for r in some) == len({r.component_id for r in some}) + 1  # id 3 stands for two texts
    assert all(r.keeper for r in got if not r.n_shingles)
    assert neardup.keep_one(docs).columns == docs.columns
    assert neardup.near_duplicates(empty).count() == 0


def test_near_copies_of_graded_similarity(spark):
    """A base text, copies with few to many edits, and texts that share a passage only."""
    rnd = random.Random(9)
    base = [rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(120)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = f"edit{i}x{rnd.random()}"
        rows.append((i, " ".join(w)))
    for i in range(60):
        own = [f"own{i}y{k}" for k in range(rnd.randint(10, 90))]
        rows.append((1000 + i, " ".join([*own, *base[:70]])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = neardup.near_duplicates(docs).select("row.doc_id", "n_shingles", "component_id").collect()
    assert collections.Counter(map(tuple, got)) == brute_components(rows)


def test_prefix_pairs_miss_nothing(spark):
    rnd = random.Random(4)
    base = [rnd.choice(WORDS) + str(k) for k in range(60)]
    rows = []
    for c in range(50):
        w = [x if rnd.random() > 0.03 else f"e{c}{k}" for k, x in enumerate(base)][: rnd.randint(45, 60)]
        rows.append((c, c, " ".join(w)))
    found = {tuple(r) for r in neardup.prefix_pairs(spark.createDataFrame(rows, "c bigint, comp bigint, text string"), 75, 100).collect()}
    sets = neardup.shingle_sets([r[2] for r in rows])
    links = 0
    for a in range(50):
        for b in range(a + 1, 50):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                links += 1
                assert (a, b) in found
    assert links


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (205, 200)]
    got = dict(neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 205: 200}


def test_posterior_bound_keeps_true_pairs():
    need = neardup.needed_matches(0.75)
    assert list(need) == list(range(16, 129, 16)) and all(0 < m < 0.75 * n for n, m in need.items())


def test_fingerprints(docs, empty):
    rows = fingerprint.fingerprints(docs).collect()
    ordered = sorted({(r[0], r[1] or "") for r in make()}, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest()))
    want, prints = {}, {}
    for i, (doc, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[(i + 1) % len(ordered)][1][:half]
        want[doc, len(text), hashlib.sha256(edited.encode()).hexdigest()] = text
    assert len(rows) == len(make())
    for r in rows:
        text = want[r.doc_id, r.n_chars, r.edited_sha256]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(prints.values())) == len(prints) - 1  # "" and white space alone: no tokens
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows])
    assert fingerprint.fingerprints(empty).count() == 0


def test_fingerprint_depends_on_order(spark):
    rnd = random.Random(8)
    words = [f"w{rnd.randint(0, 10**6)}" for _ in range(300)]
    halves = words[150:] + words[:150]
    few = [w if k % 60 else "new" for k, w in enumerate(words)]
    texts = [(0, " ".join(words)), (1, " ".join(few)), (2, " ".join(halves)), (3, " ".join(reversed(words)))]
    df = fingerprint.with_fingerprint(spark.createDataFrame(texts, "k int, text string"), "text", "fp")
    a = df.where("k = 0").selectExpr("fp as a").crossJoin(df.selectExpr("k", "fp as b"))
    near = dict(a.select("k", fingerprint.likeness("a", "b")).collect())
    assert near[0] == 1.0 and near[1] > 0.8 and near[1] > near[2] > near[3] == 0.0


def plain_fingerprint(text):
    """Order MinHash in plain Python: a dictionary of bin numbers and tuple hashes."""

    def h(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64(v if isinstance(v, bytes) else (v % 2**64).to_bytes(8, "little"), seed=seed).intdigest()
        return seed

    runs = re.findall(r"\S+", text, re.ASCII)
    tokens = [t.encode() for r in runs for t in ([r] if len(r) <= 24 else [r[i : i + 4] for i in range(len(r) - 3)])]
    seen, items = collections.Counter(), []
    for place, token in enumerate(tokens):
        kmer = h(token, *tokens[place + 1 : place + 2]) >> 30 << 30
        number = seen[kmer].to_bytes(4, "little")
        seen[kmer] += 1
        value = h(kmer, number)
        items.append((value % 64, value >> 37, place))
    bins = collections.defaultdict(list)
    for b, value, place in sorted(items):
        bins[b].append((place, b << 27 | value))
    return {b: h(*[v for _, v in sorted(x[:2])]) & 0xFFFFFFFF for b, x in bins.items()}


def test_fingerprint_against_plain_python(spark):
    rnd = random.Random(14)
    texts = [r[1] for r in make() if r[1]] + ["".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(400)), "😀x" * 40, "a" * 25 + " b"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.fp for r in fingerprint.with_fingerprint(df, "text", "fp").collect()}
    for k, text in enumerate(texts):
        assert {x >> 32: x & 0xFFFFFFFF for x in got[k]} == plain_fingerprint(text), text[:60]


def test_one_inserted_character_in_unspaced_text(spark):
    rnd = random.Random(15)
    text = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(3000))
    texts = [text, "前" + text, text[:1500] + "中" + text[1500:], text[:1500] + text[1501:], text[1500:] + text[:1500]]
    df = fingerprint.with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), "text", "fp")
    a = df.where("k = 0").selectExpr("fp as a").crossJoin(df.selectExpr("k", "fp as b"))
    near = dict(a.select("k", fingerprint.likeness("a", "b")).collect())
    assert min(near[1], near[2], near[3]) > 0.9 > 0.8 > near[4]


def test_language(spark, empty):
    rnd = random.Random(6)
    words = {"aa": ["the", "and", "house", "water", "thing"], "bb": ["der", "und", "haus", "wasser", "nicht"]}
    rows = [(i, " ".join(rnd.choice(words[k]) for _ in range(20)), k) for i in range(80) for k in (("aa", "bb")[i % 2],)]
    df = spark.createDataFrame(rows, "id bigint, text string, lang string")
    model = langid.learn(df)
    assert model.languages == ["aa", "bb"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!"), (4, "wasserhaus " * 9), (5, "the" * 400)], "id bigint, text string")
    got = {r.id: r for r in langid.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "und", "bb"] and got[3].score == 0
    assert all(r.lang_pred == k[2] and 0 <= r.score <= 1 for r, k in zip(sorted(langid.identify(df, model).collect(), key=lambda r: r.id), rows))
    none = langid.learn(empty)
    assert none.languages == [] and {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"}


def test_words_are_letters_and_their_marks():
    assert langid.words("½ ② ² ٣ 12 _-") == [] and langid.words("Ⅷ") == []
    assert langid.words("हिन्दी É1a c̈") == ["▁हिन्दी", "▁é", "▁a", "▁c̈"]


def test_language_sample_goes_by_text(spark):
    rnd = random.Random(8)
    words = {"aa": ["the", "and", "house", "water"], "bb": ["der", "und", "haus", "wasser"]}
    rows = [(" ".join(rnd.choice(words[k]) for _ in range(12)), k) for i in range(300) for k in (("aa", "bb")[i % 2],)]
    rows += [(rows[0][0], "aa")] * 200  # a hot text
    models = [langid.learn(spark.createDataFrame(r, "text string, lang string").repartition(n), sample=60) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert np.allclose(models[0].p, models[1].p) and models[0].languages == models[1].languages


def test_op2_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = langid.op2_language(spark, sf)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    rows = found.collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id] is not None]
    assert len(right) > 20 and sum(right) >= 0.9 * len(right)  # rows that were not learned from


def test_forward_sums_all_cuts():
    pieces = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aba"])}
    p = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0], [1e-9]])
    lattice = langid.Lattice(pieces)

    def total(word):
        if not word:
            return 1.0
        return sum(p[pieces.get(word[:k], 6 if k == 1 else 5), 0] * total(word[k:]) for k in range(1, len(word) + 1))

    words = ["a", "ab", "abab", "abaxb", "bbabaa"]
    for members, table in lattice.groups(words):
        got = lattice.forward(table, p)[:, -1, 0]
        assert np.allclose(got, [total(words[i]) for i in members])
        counts = lattice.expected(table, p, np.ones(len(members)))
        spelled = sum(counts[i] * len(x) for x, i in pieces.items()) + counts[6]
        assert np.isclose(spelled, sum(len(words[i]) for i in members))


def test_lattice_follows_only_prefixes_of_pieces():
    class Pieces(dict):
        asked = 0

        def get(self, *key):
            Pieces.asked += 1
            return super().get(*key)

    pieces = Pieces({p: i for i, p in enumerate(["a", "ab", "abc", "é", "éa\U00010400", "\U00010400"])})
    lattice = langid.Lattice(pieces)
    words = ["abcab", "xabéa", "éa\U00010400bc", "zzzzz", "a", "\U00010400", "ñ"]
    found = {}
    for members, table in lattice.groups(words):
        found |= {words[i]: t for i, t in zip(members, table)}
    assert Pieces.asked == 0  # once for every stretch of every word before
    for w in words:
        for end in range(1, len(w) + 1):
            for size in range(1, min(end, lattice.longest) + 1):
                want = dict.get(pieces, w[end - size : end], len(pieces) + (size == 1))
                assert found[w][end, size] == want


def test_words_by_kind_of_text():
    assert langid.words("Ab c2d") == ["▁ab", "▁c", "▁d"] and langid.words("Ñu 中文 e\u0301a") == ["▁ñu", "▁中文", "▁e\u0301a"]
    assert langid.words("a\U00020000b \U0001f600 \U00010400 ½é") == ["▁a\U00020000b", "▁\U00010428", "▁é"]
    # most texts get a table without the ranges beyond U+FFFF, which every blank would be compared with
    assert all(ord(c) <= 0xFFFF for c in langid._basic.pattern) and langid._letters.pattern != langid._basic.pattern


def test_quality(spark, empty):
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(40)]
        rows.append((i, " ".join(f"{w.upper()}!!" if bad else w for w in words)))
        labels.append((i, 0 if bad else 1))
    labels += [(None, 1), (5, None), (7, 1), (99999, 0)]
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.learn(df, quality.training_labels(marks))
    got = {r.row.doc_id: r.score for r in quality.score(df, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 403
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i % 4 != 0) for i in held]) > 0.95
    assert quality.score(empty, model).count() == 0
    nothing = quality.learn(empty, marks.limit(0))
    assert {r.score for r in quality.score(df, nothing).collect()} == {0.5}


def test_line_dedup(spark, docs, empty):
    rnd, rows = random.Random(10), []
    for i in range(12):
        body = "\n".join(" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(9)) for _ in range(6))
        rows.append((i, f"{body}\nServed by node {i} of the big cluster tonight\nshort line\n}}\n\n- -"))
    copies = rows[0][1]
    rows += [(100 + i, copies.replace("Served by node 0 of the big cluster tonight\n", "")) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r for r in linededup.dedup_lines(df).select("row.doc_id", "row.text", "n_lines", "n_dropped").collect()}
    for i in range(12):
        assert out[i].n_dropped == 2 and "Served" not in out[i].text and out[i].text.endswith("\n}\n\n- -") and "short" not in out[i].text
    # copies are one document: they lose the short line, which others hold too, and nothing else
    assert all(out[100 + i].n_dropped == 1 and out[100 + i].text == rows[12 + i][1].replace("short line\n", "") for i in range(20))
    kept = linededup.dedup_lines(docs).select("row.*")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert linededup.dedup_lines(empty).count() == 0


def unique_lines(rnd, n, words=9):
    return [" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(words)) for _ in range(n)]


def dropped_lines(spark, rows):
    """Of each row of ``rows`` (id, lines) the lines that line dedup leaves out."""
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in rows], "doc_id bigint, text string").repartition(3)
    kept = {r.doc_id: r.text.split("\n") for r in linededup.dedup_lines(df).select("row.doc_id", "row.text").collect()}
    return {i: [x for x in lines if x not in kept[i]] for i, lines in rows}


def test_line_dedup_decides_on_independent_holders_alone(spark):
    rnd = random.Random(21)
    footer = "all articles of the weekly paper are free to read"
    rows = [(i, [*unique_lines(rnd, 6), footer]) for i in range(8)]
    page = unique_lines(rnd, 12)
    rows += [(100 + i, [*page, footer]) for i in range(30)]  # copies outnumber the independent holders
    near = unique_lines(rnd, 20)
    rows += [(200 + i, [*near, *unique_lines(rnd, 1)]) for i in range(10)]  # near copies, one own line each
    gone = dropped_lines(spark, rows)
    assert all(gone[i] == ([footer] if i < 200 else []) for i, _ in rows)


def test_line_dedup_drops_blocks_of_shared_lines(spark):
    for shared, own in ((5, 2), (10, 4), (20, 10)):
        rnd = random.Random(shared)
        block = unique_lines(rnd, shared)
        rows = [(i, [*block, *unique_lines(rnd, own)]) for i in range(60)]
        assert all(x == block for x in dropped_lines(spark, rows).values())


def test_line_dedup_counts_a_document_once_for_a_template(spark):
    rnd = random.Random(23)
    log = [f"the server has sent its answer to user {x} again" for x in unique_lines(rnd, 6 * 8, 1)]
    rows = [(i, [*unique_lines(rnd, 3), *log[6 * i : 6 * i + 6]]) for i in range(8)]
    alone = [f"the engine has lost its contact to host {x} again" for x in unique_lines(rnd, 12, 1)]
    rows.append((99, [*unique_lines(rnd, 3), *alone]))  # many variants, but one document
    gone = dropped_lines(spark, rows)
    assert all(gone[i] == log[6 * i : 6 * i + 6] for i in range(8)) and gone[99] == []


def test_line_dedup_of_text_without_spaces(spark):
    tokens, counts = linededup.tokens_in(pa.array(["猫が ab3好き。", "", "é a\u3000b", " a\tb "], pa.large_string()))
    assert tokens.to_pylist() == ["猫", "が", "ab3", "好", "き", "。", "é", "a", "b", "a", "b"] and counts.tolist() == [6, 0, 3, 2]
    rnd = random.Random(24)
    footers = ["本站所有文章均可免费阅读", "บทความทั้งหมดอ่านได้ฟรี"]
    own = lambda n: ["".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(30)) for _ in range(n)]
    rows = [(i, [*own(4), footers[i % 2]]) for i in range(12)]
    near = own(12)
    rows += [(100 + i, [*(x[:-1] + chr(0x4E00 + i) if k == i else x for k, x in enumerate(near))]) for i in range(10)]
    gone = dropped_lines(spark, rows)
    assert all(gone[i] == ([footers[i % 2]] if i < 100 else []) for i, _ in rows)


def test_open_stretch_templates():
    lines = [f"the quick brown fox jumps over {x} dog today again" for x in ("lazy", "sleepy")] + ["the quick brown fox"]
    _, number, leaf, keys, open_ = linededup.templates(["\n".join(lines)])
    assert leaf[0] == leaf[1] != leaf[2] and keys[0, 0] != keys[1, 0] and list(open_) == [True, True, False]
    assert len(set(keys[0]) & set(keys[1])) == 1


def test_license_scan(docs, empty, spark):
    mit = licenses.TEMPLATES["MIT-permission"].split()
    changed = [w if k != 30 else "something" for k, w in enumerate(mit)]
    filler = " ".join(f"f{k}" for k in range(500))
    texts = [
        (0, f"{filler} {' '.join(mit)} {filler}"),
        (1, f"{filler} {' '.join(changed)} {filler}"),
        (2, f"{filler} {' '.join(mit[:30])} {filler}"),
        (3, "x released UNDER the mit\nLicense. y All rights reserved. all rights RESERVED."),
        (4, None),
        (5, ""),
    ]
    got = {r.doc_id: [(m.license, m.word) for m in r.matches] for r in licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert [k for k, _ in got[0]] == ["MIT-permission"] and got[0][0][1] == 500
    assert [k for k, _ in got[1]] == ["MIT-permission"] and got[2] == [] == got[4] == got[5]
    assert got[3] == [("MIT", 1), ("all-rights-reserved", 7), ("all-rights-reserved", 10)]
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(empty).count() == 0


def test_license_of_each_family(spark):
    filler = " ".join(f"f{k}" for k in range(40))
    names = sorted(licenses.TEMPLATES)
    texts = [(i, f"{filler} -- {licenses.TEMPLATES[n].replace('.', ' .')} {filler}") for i, n in enumerate(names)]
    gpl = licenses.TEMPLATES["GPL-3.0-or-later"]
    texts += [(900, gpl.replace("version 3", "version 4")), (901, "(This work is licensed under the GNU General Public License, version 2)")]
    texts += [(902, "* Released under the MIT License!"), (903, f"{gpl} {licenses.TEMPLATES['MPL-2.0']}"), (904, "-- ...")]
    got = {r.doc_id: [(m.license, m.word) for m in r.matches] for r in licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    for i, n in enumerate(names):
        if "." not in licenses.TEMPLATES[n][:-1]:
            assert got[i] == [(n, 41)]
    plain = [(i, f"{filler} {licenses.TEMPLATES[n]} {filler}") for i, n in enumerate(names)]
    got_plain = {r.doc_id: [(m.license, m.word) for m in r.matches] for r in licenses.scan(spark.createDataFrame(plain, "doc_id bigint, text string")).collect()}
    assert got_plain == {i: [(n, 40)] for i, n in enumerate(names)}
    assert got[900] == [] == got[904] and got[901] == [("GPL-2.0", 0)] and got[902] == [("MIT", 1)]
    assert [n for n, _ in got[903]] == ["GPL-3.0-or-later", "MPL-2.0"]


def test_license_windows_of_every_offset():
    templates = licenses.Templates(licenses.TEMPLATES)
    words = licenses.TEMPLATES["GPL-3.0-or-later"].split()
    for start in range(0, 130, 3):
        text = " ".join([*(f"a{k}" for k in range(start)), *words, *(f"b{k}" for k in range(40))])
        rows, _ = neardup.shingle_rows([text])
        runs = {n: neardup.shingle_rows([text], n, exact=True)[0][0] for n in set(templates.words.values())}
        assert [(templates.names[k], a) for k, a, _ in templates.find(rows[0], runs)] == [("GPL-3.0-or-later", start)]


def test_binary_round_trip(docs, empty):
    capacity = 256
    packed = binary.packed(docs, capacity, block=3000).persist()
    encoder = Encoder()
    back = binary.unpack(packed).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in back) == collections.Counter((r[0], tuple(encoder.ids(r[1]).tolist())) for r in make())
    for r in packed.collect():
        ids, places = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.position_ids, "<u4")
        assert len(ids) == len(places) == capacity and r.cu_seqlens[-1] == r.n_tokens <= capacity
        assert len(r.cu_seqlens) == len(r.segments) + 1
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
    packed.unpersist()
    assert binary.packed(empty).count() == 0


def test_segment_tree_is_best_fit():
    rnd = random.Random(3)
    for _ in range(50):
        lengths = [rnd.randint(1, 50) for _ in range(rnd.randint(0, 60))]
        rooms, want = [], 0
        for n in sorted(lengths, reverse=True):
            fit = [k for k, room in enumerate(rooms) if room >= n]
            if fit:
                rooms[min(fit, key=lambda k: rooms[k])] -= n
            else:
                rooms.append(50 - n)
                want += 1
        got = binary.best_fit_decreasing(lengths, 50)
        assert len(got) == want and sorted(k for s in got for k in s) == list(range(len(lengths)))


def test_native_operators_plan_no_python(docs):
    for df in (sharding.shard_by_bytes(docs), fingerprint.fingerprints(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[1])


def test_line_dedup_joins_texts_without_sorting_them(spark):
    docs = spark.createDataFrame([(i, f"same line of all texts\nown line {i} of text {i}") for i in range(8)], "doc_id bigint, text string")
    found = linededup.dedup_lines(docs)
    assert "ShuffledHashJoin" in plan_text(found, "simple")
    assert {r.row.text for r in found.collect()} <= {f"own line {i} of text {i}" for i in range(8)} | {""}


def test_decontamination_goes_to_python_once(spark):
    rows = [(1, "a b c d e f g h i j k l", 23), (2, " ".join(f"w{i}" for i in range(40)), 0), (3, None, None), (4, "x " * 30 + "a b c d e f g h i j y", 0), (None, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    benchmark = spark.createDataFrame([("i", "a b c d e f g h i j k l"), ("k", "a b c d e f g h i j")], "item_id string, text string")
    for most in (decontaminate.AUTOMATON_BYTES, 20):
        kept = decontaminate.decontaminate(docs, benchmark, most=most)
        assert plan_text(kept, "simple").count("MapInArrow") == 1  # two, each with a worker of its own, before
        got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
        assert set(got) == {2, 3, 4, None} and got[2] == (rows[1][1], 0) and got[3] == (None, None) and got[None] == ("", 0)
        assert got[4][0].split() == ["x"] * 30 + ["y"] and got[4][1] == len(got[4][0])


def test_helpers_take_slices_of_arrow_arrays():
    texts = ["a b c d e f", None, "", "É  a　b 猫が ab3好き。\nx y z w v u", " a b\tc d e f g ", "w " * 9] * 3
    part = pa.array(texts)[4:]
    assert [x.tolist() for x in neardup.shingle_sets(part)] == [x.tolist() for x in neardup.shingle_sets(texts[4:])]
    sets = neardup.shingle_sets(part)
    assert [k is None for k in neardup.set_keys(sets)] == [not len(s) for s in sets]
    assert len(set(neardup.set_keys(sets))) == 5  # none for NULL and empty texts
    for x, y in zip(linededup.templates(part), linededup.templates(texts[4:])):
        assert x.tolist() == y.tolist()
    assert spread(part, linededup.UNSPACED).equals(spread(texts[4:], linededup.UNSPACED))
    assert spread(["猫が ab", None], linededup.UNSPACED).to_pylist() == [" 猫  が  ab", ""]


def test_tasks_give_unused_memory_back(monkeypatch):
    made, given = [], []

    def run(batches):
        for batch in batches:
            block = np.ones(1 << 12)
            made.append(weakref.ref(block))
            yield pa.RecordBatch.from_arrays([pa.array([len(block) + i for i in range(batch.num_rows)])], ["n"])

    # the task's own data are gone by then, or they could not be given back
    monkeypatch.setattr(common, "give_back", lambda: given.append([ref() is None for ref in made]))
    batches = [pa.RecordBatch.from_arrays([pa.array(["a", "b"])], ["text"]), pa.RecordBatch.from_arrays([pa.array(["c"])], ["text"])]
    assert [b["n"].to_pylist() for b in lean(run)(iter(batches))] == [[4096, 4097], [4096]]
    assert given == [[True, True]]
    assert list(lean(run)(iter([]))) == [] and len(given) == 2
    monkeypatch.undo()
    common.give_back()


def test_corpus_tasks_are_lean(spark, monkeypatch):
    seen = []
    for module in (quality, linededup, neardup, decontaminate, packing):
        monkeypatch.setattr(module, "lean", lambda run, name=module.__name__: seen.append(f"{name}.{run.__name__}") or run)
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(4)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "one two three")], "item_id string, text string")
    assert decontaminate.decontaminate(docs, bench).count() == 4
    assert linededup.dedup_lines(docs).count() == 4
    assert neardup.keep_one(docs).count() == 4
    assert packing.pack(docs).count() == 4
    quality.score(docs, None)
    for name in ("decontaminate.run", "linededup.run", "neardup.run", "packing.run", "quality.run"):
        assert f"tickweek.llm.{name}" in seen
