"""Centroid clustering, periodic runs and suffix-tree scores against plain versions and on awkward rows."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm import centroids, periodic, suffixtree
from tickweek.llm.common import fold

SF = "/root/testdata/sf0.001"


# --- centroids ------------------------------------------------------------------

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # names that the operator uses inside
        T.StructField("vec", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("distance", T.LongType()),
    ]
)


def plain_clusters(rows, size, k, rounds, seed=3, scale=1024):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    now = [v for _, v in start]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[place(v)[1]].append(v)
        now = [tuple(sum(c) // len(groups[j]) for c in zip(*groups[j])) if groups[j] else now[j] for j in range(len(now))]
    placed = [(i, *place(v)[::-1]) for i, v in kept]
    inertia = collections.Counter()
    for _, j, d in placed:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return collections.Counter((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in placed)


def vectors(n, size, seed, step):
    rnd = random.Random(seed)
    middle = [[rnd.uniform(-1, 1) for _ in range(size)] for _ in range(5)]
    return [(i, [round((m + rnd.gauss(0, 0.3)) / step) * step for m in rnd.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("size, step, k, rounds", [(6, 1e-3, 4, 10), (6, 0.5, 5, 3), (3, 1.0, 8, 10)])
def test_clusters_equal_plain_lloyd(spark, size, step, k, rounds):
    rows = vectors(150, size, 5, step)  # coarse steps give equal vectors and equal distances
    rows += [(rows[0][0], rows[3][1]), rows[4], rows[4], (None, rows[5][1])]
    rows += [(900, None), (901, []), (902, [1.0] * (size + 1)), (903, [None] + [0.0] * (size - 1))]
    rows += [(904, [math.nan] * size), (905, [math.inf] + [0.0] * (size - 1)), (906, [-0.0] * size), (907, [1000.0] * size)]
    df = spark.createDataFrame([(i, v, "v", "c", 7) for i, v in rows], VECTORS).repartition(3)
    exact = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]  # as 32-bit floats
    got = centroids.cluster_vectors(df, size=size, clusters=k, rounds=rounds, leading=2)
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_clusters(exact, size, k, rounds)


def test_clusters_of_few_none_and_too_large(spark):
    few = spark.createDataFrame([(1, [1.0, 2.0], "", "", 0), (2, [1.0, 2.0], "", "", 0)], VECTORS)
    got = centroids.cluster_vectors(few, size=2).collect()
    assert sorted(r.vec_id for r in got) == [1, 2] and {(r.distance, r.inertia) for r in got} == {(0, 0)}
    assert len({r.cluster for r in got}) == 1  # equal centroids: the smaller number
    none = centroids.cluster_vectors(few.limit(0), size=2)
    assert none.collect() == [] and none.dtypes == centroids.cluster_vectors(few, size=2).dtypes
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0], "", "", 0)], VECTORS), size=2).collect()


def test_bounds_never_exceed_the_distance():
    import numpy as np

    rnd = np.random.default_rng(2)
    x = rnd.integers(-2000, 2000, (300, 10))
    turn = centroids.Rotation(x.mean(0), np.linalg.qr(rnd.normal(size=(10, 10)))[0][:, :3])
    lead, rest = turn.parts(x)
    for c in x[:20]:
        their_lead, their_rest = turn.parts(c[None].astype(float))
        bound = ((lead - their_lead) ** 2).sum(1) + (rest - their_rest[0]) ** 2
        assert (bound <= ((x - c) ** 2).sum(1) * (1 + 1e-9) + 1e-3).all()


def test_op11_on_the_table(spark):
    df = centroids.op11_centroids(spark, SF)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert df.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert collections.Counter(tuple(r) for r in df.collect()) == plain_clusters(rows, 64, 8, 10)


# --- periodic runs ----------------------------------------------------------------


def plain_runs(w, power=4, least=6):
    out = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(least, power * q) and not any(all(w[x] == w[x + d] for x in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rnd = random.Random(9)
    texts = []
    for _ in range(150):
        letters = rnd.randint(1, 3)
        some = lambda n: [rnd.choice("abc"[:letters]) for _ in range(n)]
        unit = some(rnd.randint(1, 12))
        texts.append(some(rnd.randint(0, 25)) + (unit * 8)[: rnd.randint(1, 7 * len(unit))] + some(rnd.randint(0, 25)))
    texts += [["x"] * n for n in (1, 3, 5, 6, 7, 64, 4000)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), list((fib[5] * 9 + "c") * 5)]
    return texts


def test_runs_equal_plain_search():
    texts = [[w.encode() for w in t] for t in periodic_texts()]
    runs, counts = periodic.search(texts)
    want = [plain_runs(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and sum(counts) > 100
    assert [tuple(r) for r in runs.tolist()] == [r for w in want for r in w]
    for t in texts:  # one text alone as in a batch
        assert [tuple(r) for r in periodic.search([t])[0].tolist()] == plain_runs(t)


def test_wavelet_tree_range_successor():
    import numpy as np

    rnd = np.random.default_rng(4)
    for n in (1, 2, 63, 64, 65, 300):
        values = rnd.permutation(n)
        tree = periodic.WaveletTree(values)
        low = rnd.integers(0, n, 200)
        high = np.minimum(low + rnd.integers(0, n + 1, 200), n)
        above = rnd.integers(-1, n + 1, 200)
        want = [min((v for v in values[a:b].tolist() if v > x), default=-1) for a, b, x in zip(low, high, above)]
        assert tree.successor(low, high, above).tolist() == want


def plain_op12(doc_id, text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    keep = [not any(s + q <= i < s + m for s, m, q in runs) for i in range(n)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    first = (best[0], best[1], best[2], best[1] * 1000 // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *first, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for x, k in zip(w, keep) if k)))


def test_op12_equals_plain_version(spark, scratch):
    rows = [(i, " ".join(t)) for i, t in enumerate(periodic_texts())]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "a\x1cb a\x1cb　c é é é é é é é"), (None, "q r s t u v w"), (None, "q r s t u v w"), (3, "again a"), (1004, "no\x00run" * 9)]
    path = scratch("runs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    df = periodic.op12_runs(spark, path)
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert [n for n, _ in df.dtypes] == names and {t for n, t in df.dtypes if not n.endswith("sha256")} == {"bigint"}
    assert collections.Counter(tuple(r) for r in df.collect()) == collections.Counter(plain_op12(*r) for r in rows)


def test_op12_on_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert collections.Counter(tuple(r) for r in periodic.op12_runs(spark, SF).collect()) == collections.Counter(plain_op12(*r) for r in rows)


def test_runs_keep_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b " * 5, "r", "x")], "doc_id long, text string, row string, runs string")
    [r] = periodic.periodic_runs(df).collect()
    assert tuple(r.row) == (1, "a b " * 5, "r", "x") and [tuple(x) for x in r.runs] == [(0, 10, 2)] and r.collapsed == "a b"
    assert periodic.periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, power=3)


# --- suffix tree scores -------------------------------------------------------------


def tokens_of(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]  # None: the end


def plain_scores(rows, train, tree):
    """(key, n_tokens, n_known, N, base, score) of every row, from dictionaries of whole contexts."""
    counts = [collections.defaultdict(collections.Counter) for _ in range(tree.depth + 1)]  # [words of context][context][next]
    for key, text in rows:
        if train(key):
            t = tokens_of(text)
            for i, w in enumerate(t):
                for d in range(min(i, tree.depth) + 1):
                    counts[d][tuple(t[i - d : i])][w] += 1
    words = counts[0][()]
    n, v = sum(words.values()), len(words)
    kept = {}

    def chance(context, w):
        if not context:
            return (words[w] + 1) / (n + v + 1)
        shorter = chance(context[1:], w)
        if context not in kept:
            return shorter
        seen = sum(counts[len(context)][context].values())
        alpha = kept[context] * seen**0.8
        return (counts[len(context)][context][w] + alpha * shorter) / (seen + alpha)

    for d in range(1, tree.depth + 1):
        found = {}
        for context, after in counts[d].items():
            seen = sum(after.values())
            if seen >= tree.least:
                gains = []
                for s in tree.strengths:
                    alpha = s * seen**0.8
                    gains.append(sum(c * math.log((c - 1 + alpha * chance(context[1:], w)) / (seen - 1 + alpha) / chance(context[1:], w)) for w, c in after.items()))
                if max(gains) > tree.gain:
                    found[context] = tree.strengths[gains.index(max(gains))]
        kept.update(found)
    out = []
    for key, text in rows:
        t = tokens_of(text)
        base = sum(math.log10(chance((), w)) for w in t)
        score = sum(math.log10(chance(tuple(t[max(0, i - tree.depth) : i]), w)) for i, w in enumerate(t))
        out.append((key, len(t), sum(words[w] > 0 for w in t), n, base, score))
    return out, kept, chance


def score_rows():
    rnd = random.Random(6)
    words = [a + b for a in "bdgk" for b in "aeiou"]
    rows = []
    for i in range(80):
        t = [rnd.choice(words)]
        for _ in range(rnd.randint(0, 40)):  # the next word depends on the two before
            h = zlib.crc32(" ".join(t[-2:]).encode())
            t.append(words[(h + rnd.randint(0, 2)) % len(words)] if rnd.random() < 0.8 else rnd.choice(words))
        rows.append((i, " ".join(t)))
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "BA be\x1cBe Ñandú ñ"), (104, "word " * 3000), (5, rows[5][1]), (5, "other text"), (None, "ba be bi"), (None, "ba be bi")]
    return rows


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"least": 4, "depth": 3, "gain": 0.5},
        {"block_bytes": 700, "bucket_tokens": 300, "hot": 20},  # many blocks and buckets, shared contexts
        {"depth": 1, "hot": 1, "bucket_tokens": 1000},
    ],
)
def test_scores_equal_plain_tree(spark, settings):
    tree = suffixtree.Settings(**settings)
    rows = score_rows()
    df = spark.createDataFrame([(k, t, "r", 1, 2.0) for k, t in rows], "doc_id long, text string, block string, tokens int, score double").repartition(3)
    got = suffixtree.suffix_tree_scores(df, ~(fold(F.col("doc_id"), 7) == 2), tree=tree).collect()
    want, kept, chance = plain_scores(rows, lambda k: not held(k), tree)
    assert any(len(c) == tree.depth for c in kept)
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert [tuple(r)[:4] for r in sorted(got, key=order)] == [r[:4] for r in sorted(want, key=order)]
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert a.base_score == pytest.approx(b[4], rel=1e-9) and a.score == pytest.approx(b[5], rel=1e-5)
    known = {w for _, t in rows for w in tokens_of(t) if not held(_)}
    for context in [(), *list(kept)[:5]]:  # probabilities of all next words and of one unknown word add up to 1
        assert sum(chance(context, w) for w in known | {"never seen"}) == pytest.approx(1)


def test_scores_without_training_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, None)], "doc_id long, text string")
    got = suffixtree.suffix_tree_scores(df, F.lit(None).cast("boolean")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 5, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    empty = suffixtree.suffix_tree_scores(df.limit(0), F.lit(True))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_op13_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    df = suffixtree.op13_scores(spark, SF)
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r.doc_id: r for r in df.collect()}
    want, _, _ = plain_scores(rows, lambda k: not held(k), suffixtree.Settings())
    assert len(got) == len(want)
    for key, n, known, total, base, score in want:
        r = got[key]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(key), n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-5)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # better than word counts on texts not learned from
