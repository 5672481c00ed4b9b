import hashlib
import random

import numpy as np
import pytest

from quakeframe.llm import multiset
from quakeframe.llm.queries import QUERIES


def slow(rows):
    """The rows of the query, each text hashed as a whole."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    result = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, other, after = (multiset.vector(multiset.paragraphs(t)) for t in (text, edited, following))
        result.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), multiset.digest(own), multiset.digest(other),
                       multiset.likeness(own, other), multiset.likeness(own, after)))
    return sorted(result, key=str)


def test_query_equals_whole_texts(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op3_fingerprints"](spark, sf).collect()
    assert sorted(map(tuple, found), key=str) == slow(rows)
    long = [r for r in found if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) == pytest.approx(0.5, abs=0.1)
    assert np.median([r.near_next for r in long]) < 0.1
    texts = dict(rows)
    by_print = {}
    for r in found:
        assert by_print.setdefault(r.fingerprint, texts[r.doc_id]) == texts[r.doc_id]  # equal prints, equal texts
    assert len(by_print) == len(set(texts.values()))


def test_sums():
    rng = random.Random(6)
    parts = ["".join(rng.choice("ab cd\té") for _ in range(rng.randrange(60))) for _ in range(50)]
    whole = multiset.vector(parts)
    mixed = parts[:]
    rng.shuffle(mixed)
    assert np.array_equal(multiset.vector(mixed), whole)
    assert np.array_equal(multiset.insert(multiset.vector(parts[:20]), parts[20:]), whole)
    assert np.array_equal(multiset.delete(whole, parts[10:]), multiset.vector(parts[:10]))
    assert not np.array_equal(multiset.vector([*parts, parts[0]]), whole)
    many = multiset.vector(["x"] * 70000)
    assert np.array_equal(multiset.delete(many, ["x"] * 70000), multiset.vector([]))


def test_likeness_follows_common_runs():
    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    for share in (0.0, 0.3, 0.7, 0.95):
        common = [words(40) for _ in range(int(20 * share))]
        a, b = ([*common, *(words(40) for _ in range(20 - len(common)))] for _ in range(2))
        assert multiset.likeness(multiset.vector(a), multiset.vector(b)) == pytest.approx(len(common) / 20, abs=0.12)


def test_odd_documents(docs):
    long = "a\nb " * 30000
    rows = [(5, None), (2, ""), (7, "x"), (1, "é\n\nü"), (1, "again"), (9, long), (None, "none"), (None, "none"), (3, "🇩🇪 flag"), (7, "x"), (8, "last\n")]
    found = [tuple(r) for r in multiset.fingerprints(docs(rows)).collect()]
    assert sorted(found, key=str) == slow(rows)
    for few in ([], [(4, "only one")], [(4, "one"), (4, "two")]):
        assert sorted(map(tuple, multiset.fingerprints(docs(few)).collect()), key=str) == slow(few)


def test_likeness_of_texts_that_repeat_a_run_very_often():
    whole, half = (multiset.vector(["one two three four five"] * n) for n in (50_000, 25_000))
    assert multiset.likeness(whole, half) == pytest.approx(0.8)
    assert multiset.digest(multiset.delete(whole, ["one two three four five"] * 25_000)) == multiset.digest(half)
