"""The pipeline's stages on the smallest tables, each against its own input."""

import collections

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_hits
from tickweek.llm import decontaminate
from tickweek.llm.common import BATCH_BYTES, documents
from tickweek.session import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = documents(spark, SF)
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out.append(docs.collect())
    return out


def test_columns_and_order(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near duplicates", "benchmark decontamination", "packing"]
    assert all(tuple(rows[0].__fields__) == ("doc_id", "text", "lang", "source", "n_chars") for rows in steps[:-1])


def test_quality_stage_follows_labels(spark, steps):
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    kept = {r.doc_id for r in steps[1]}
    right = [(d in kept) == (q == 1) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.9 and len(kept) > 0.7 * len(steps[0])


def test_line_stage_keeps_rows_and_other_lines(steps):
    before = {r.doc_id: r.text for r in steps[1]}
    assert {r.doc_id for r in steps[2]} == set(before)
    assert all(not collections.Counter(r.text.split("\n")) - collections.Counter([*before[r.doc_id].split("\n"), ""]) for r in steps[2])


def test_near_duplicate_stage_keeps_one_of_each(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    want = {c for (d, n, c), k in brute_components(rows).items() if n} | {d for (d, n, c), k in brute_components(rows).items() if not n}
    assert {r.doc_id for r in steps[3]} == want


def test_decontamination_stage(spark, steps):
    items = [(str(r.item_id), decontaminate.words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(brute_hits(items, r.text, 10)[1] for r in steps[4])
    clean = {tuple(r) for r in steps[3] if not brute_hits(items, r.text, 10)[1]}
    assert clean <= {tuple(r) for r in steps[4]}


def test_packing_stage_holds_every_document(spark, steps):
    assert {r.doc_id for r in steps[5]} == {r.doc_id for r in steps[4]}
    assert corpus_pipeline.run(spark, SF).count() == len(steps[5])


def test_stages_hand_long_rows_to_python_in_small_batches(spark):
    docs = documents(spark, SF).limit(1)
    long_rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, SF)
        assert max(r.n for r in long_rows.mapInArrow(sizes, "n long").collect()) < 1.2 * BATCH_BYTES
