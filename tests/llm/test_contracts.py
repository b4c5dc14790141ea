"""The queries without SQL, called as registered: columns, types, folds and bounds of their rows."""

import zlib

import pyarrow.parquet as pq
import pytest

from tickweek.llm import queries

GIVEN = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13_scores": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
        "base_score": "double", "score": "double",
    },
}
HELD_OUT = {"op2_language": (4, 2), "op4_quality": (5, 0), "op13_scores": (7, 2)}


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{GIVEN}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_folds_and_columns(spark, texts, name):
    got = queries.queries()[name](spark, GIVEN)
    types = dict(got.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    folds, left_out = HELD_OUT[name]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == left_out) for r in rows)
    if name == "op13_scores":
        assert all(r.score < 0 and r.base_score < 0 and 0 <= r.n_known <= r.n_tokens for r in rows)
    else:
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "op4_quality":
        assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_packed_pieces(spark, texts):
    rows = queries.queries()["op1_packing"](spark, GIVEN).collect()
    assert {r.doc_id for r in rows} == set(texts)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in pieces.values():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(found)):
            assert (piece, start) == (k, at) and 0 < length <= 2048 and (k == 0 or length == 2048)
            at += length
        assert len(found) == -(-at // 2048)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
