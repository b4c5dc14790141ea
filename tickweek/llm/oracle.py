"""DuckDB SQL for the rows of the corpus queries that SQL can express, stated from their contracts.

Each states the rule itself, without the method of its operator: joins of word
windows for decontamination, all pairs that share a shingle for near-duplicates,
all distances for clusters, gaps and islands for periodic runs.
"""

from __future__ import annotations

from tickweek.llm.centroids import CLUSTERS, ROUNDS, SIZE
from tickweek.llm.sharding import SHARDS

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"


def _crc_entry(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def _crc32(data: str) -> str:
    """The unsigned CRC-32 of the blob ``data``, byte by byte."""
    table = f"[{', '.join(str(_crc_entry(n)) for n in range(256))}]"
    step = f"xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    listed = f"list_transform(regexp_extract_all(hex({data}), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({listed}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


SHARDING = f"""
WITH sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
    {_crc32("encode(coalesce(text, ''))")} AS text_crc32
  FROM documents
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS everything FROM sized
), dealt AS (
  SELECT *, least(((2 * upto - size) * {SHARDS}) // (2 * everything), {SHARDS - 1})::INTEGER AS shard FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

DECONTAMINATION = rf"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS (
  SELECT item_id, w, least(len(w), 10) AS k
  FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS seen
  FROM items
), doc_windows AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS place,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS seen
  FROM doc_words, (SELECT DISTINCT k FROM items) WHERE len(w) >= k
), met AS (
  SELECT doc_id, item_id, place, k FROM doc_windows JOIN item_windows USING (k, seen)
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + k)) AS word FROM met) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, {_SPACED}), []) AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id,
    unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), close AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common >= 75 * (x.n + y.n - common)
), links AS (
  SELECT a, b FROM close UNION ALL SELECT b, a FROM close
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def _nearest(centres: str) -> str:
    """Every vector with ``m``, its least (squared distance, number) as one integer."""
    return f"""
  SELECT vec_id, any_value(vectors.v) AS v, min({CLUSTERS} * list_sum(list_transform(list_zip(vectors.v, {centres}.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT + c) AS m
  FROM vectors, {centres} GROUP BY vec_id"""


def _round(r: int) -> str:
    return f""", near{r} AS MATERIALIZED ({_nearest(f"centre{r}")}
), mean{r} AS (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY j)::BIGINT[] AS v FROM (
    SELECT m % {CLUSTERS} AS c, j, sum(x) AS s, count(*) AS n
    FROM (SELECT m, unnest(v) AS x, unnest(range({SIZE})) AS j FROM near{r}) GROUP BY 1, 2
  ) GROUP BY c
), centre{r + 1} AS MATERIALIZED (
  SELECT centre{r}.c, coalesce(mean{r}.v, centre{r}.v) AS v FROM centre{r} LEFT JOIN mean{r} ON centre{r}.c = mean{r}.c
)"""


CENTROIDS = f"""
WITH vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centre0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM vectors QUALIFY c < {CLUSTERS}
){"".join(_round(r) for r in range(ROUNDS))}
, final AS ({_nearest(f"centre{ROUNDS}")}
), told AS (
  SELECT vec_id, (m % {CLUSTERS})::INTEGER AS cluster, (m // {CLUSTERS})::BIGINT AS distance FROM final
)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(centre{ROUNDS}.v, ',')) AS centroid_sha256
FROM told JOIN centre{ROUNDS} ON cluster = c
"""

# A run of four periods or more holds four places that are multiples of its period,
# with equal words: periods without such places need no look at every word.
RUNS = f"""
WITH read AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, {_SPACED}), []) AS w, {_crc32("encode(doc_id::VARCHAR)")} AS h FROM documents
), placed AS (
  SELECT doc_id, w, len(w) AS n, h, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS share FROM read
), tailed AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // share) END + 1])
    ELSE w END AS w
  FROM placed
), likely AS (
  SELECT doc_id, unnest(list_filter(range(1, n // 4 + 1), lambda q: len(list_filter(range(1, n - 3 * q + 1, q),
    lambda i: w[i] = w[i + q] AND w[i] = w[i + 2 * q] AND w[i] = w[i + 3 * q])) > 0)) AS q
  FROM tailed
), words AS MATERIALIZED (
  SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM tailed
), alike AS (
  SELECT doc_id, q, x.i, x.i - row_number() OVER (PARTITION BY doc_id, q ORDER BY x.i) AS island
  FROM likely JOIN words x USING (doc_id) JOIN words y USING (doc_id)
  WHERE y.i = x.i + q AND x.word = y.word
), stretches AS MATERIALIZED (
  SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length FROM alike GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS MATERIALIZED (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM tailed LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

SQL = {
    "op7_decontamination": DECONTAMINATION,
    "op9_sharding": SHARDING,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_centroids": CENTROIDS,
    "op12_runs": RUNS,
}
