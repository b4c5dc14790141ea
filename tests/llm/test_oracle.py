"""Corpus queries against their DuckDB SQL, on given rows and on awkward ones."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickweek.llm import oracle, queries

GIVEN = "/root/testdata/sf0.001"
TABLES = {
    "op7_decontamination": ["documents", "benchmark"],
    "op9_sharding": ["documents"],
    "op10_near_duplicates": ["documents"],
    "op11_centroids": ["embeddings"],
    "op12_runs": ["documents"],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given tables with awkward rows, and a column whose name operators use inside."""
    path = str(tmp_path_factory.mktemp("oracle"))
    given = spark.read.parquet(f"{GIVEN}/documents.parquet")
    item = spark.read.parquet(f"{GIVEN}/benchmark.parquet").first().text
    period = "one two three four five six seven"
    texts = [
        None, "", " \n\t ", "Word", "word", "FOUR words ARE here", "four words are here", "x" * 3000, "é世界 " * 40, "same " * 50,
        (period + " ") * 9, "before " + (period + " ") * 4 + "one two after", "a b a b a b a b", "a b a b a b a", "😀 ½ ② ½ " * 5,
        item, item.upper(), f"It begins, {item} and goes on", " ".join(item.split()[:9]), period, period + " eight nine", item + "\u0000z",
    ]
    odd = spark.createDataFrame([Row(doc_id=10**6 + i, text=t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    docs = given.unionByName(odd, allowMissingColumns=True).withColumn("row", F.lit("clash"))
    docs.coalesce(1).write.parquet(f"{path}/documents.parquet")
    items = spark.createDataFrame([(900, None), (901, ""), (902, "Word"), (903, "WORDS are"), (904, period), (905, item)], "item_id bigint, text string")
    spark.read.parquet(f"{GIVEN}/benchmark.parquet").unionByName(items).coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    rnd = np.random.default_rng(5)
    same = rnd.normal(size=64).tolist()
    bad = [None, [], same[:63], [None, *same[1:]], [float("nan"), *same[1:]], [float("inf"), *same[1:]], same, same, [-x for x in same]]
    vectors = spark.createDataFrame([(10**6 + i, v) for i, v in enumerate(bad)], "vec_id bigint, embedding array<float>")
    vectors = spark.read.parquet(f"{GIVEN}/embeddings.parquet").unionByName(vectors, allowMissingColumns=True)
    vectors.coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_rows_of_the_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES[name]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    want = con.execute(oracle.SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert {c: t for c, t in got.dtypes} == {d[0]: names[str(d[1])] for d in want.description}
    rows = {tuple(r) for r in got.select(*columns).collect()}
    assert rows == set(want.fetchall())
