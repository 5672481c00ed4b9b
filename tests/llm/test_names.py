"""Columns of the input that are called like what the stages add keep their values."""

import pytest

from quakeframe.llm import exact_dedup, mixing, near_dedup

ROWS = [(i, f"{word} " * 30 + "end", "en", "a") for i, word in enumerate(["one", "two", "two", "three"])]


@pytest.mark.parametrize("stage", [exact_dedup.keep_one, near_dedup.keep_one, mixing.mixed])
def test_clashing_names(docs, stage):
    table = docs(ROWS).selectExpr("*", "'s' as _sha", "'c' as _COPY", "X'07' as _node", "8 as __sha")
    plain, clash = stage(docs(ROWS)), stage(table)
    assert clash.columns == table.columns
    assert {(r["_sha"], r["_COPY"], bytes(r["_node"]), r["__sha"]) for r in clash.collect()} == {("s", "c", b"\x07", 8)}
    assert sorted(r.doc_id for r in clash.collect()) == sorted(r.doc_id for r in plain.collect())
