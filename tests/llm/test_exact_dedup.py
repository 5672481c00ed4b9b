import collections
import hashlib

import pytest

from quakeframe.llm import exact_dedup

UPPER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.parametrize("fan_in", [2, 16])
def test_groups(docs, fan_in):
    texts = ["Ab", "aB", "ab ", "É", "é", "", None, "x" * 300000, "X" * 300000] + ["same"] * 200 + [f"t{i % 50}" for i in range(300)]
    rows = [*enumerate(texts), (None, "ab"), (None, "no id"), (3, "É"), (3, "É")]
    found = exact_dedup.exact_duplicates(docs(rows).repartition(11), fan_in).collect()
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(UPPER)].append(i)
    expected = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            expected[i, max(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    assert collections.Counter(r.text_sha256 for r in found if r.kept) == {h: 1 for _, _, _, h in expected}
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_rows_that_stay(docs):
    rows = [(1, "a"), (2, "A"), (2, "A"), (3, "b"), (None, "c"), (None, "c"), (4, None), (5, "")]
    left = exact_dedup.keep_one(docs(rows))
    assert left.columns == docs(rows).columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(2, "A"), (3, "b"), (None, "c"), (5, "")], key=str)


def test_no_rows(docs):
    assert exact_dedup.exact_duplicates(docs([])).collect() == []
    assert exact_dedup.keep_one(docs([])).collect() == []


def test_native_plan(spark, docs):
    plan = exact_dedup.exact_duplicates(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" in plan
