import collections
import math
import random

import numpy as np
import pytest

from quakeframe.llm import near_dedup
from quakeframe.llm.queries import QUERIES


def slow_classes(rows, least=0.8):
    """Classes by comparing all pairs, shingles as tuples of words."""
    shingles = {}
    for i, (_, text) in enumerate(rows):
        w = (text or "").lower().split()
        shingles[i] = collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else collections.Counter()
    df = collections.Counter(s for c in shingles.values() for s in c)
    idf = {s: 1 + math.log(1 / max(near_dedup.FREQUENT, n / len(rows))) for s, n in df.items()}
    total = {i: sum(n * idf[s] for s, n in c.items()) for i, c in shingles.items()}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in shingles:
        for b in range(a):
            shared = sum(min(n, shingles[b][s]) * idf[s] for s, n in shingles[a].items() if s in shingles[b])
            if shared >= least * (total[a] + total[b] - shared):
                parent[root(a)] = root(b)
    found = collections.defaultdict(list)
    for i in shingles:
        found[root(i)].append(rows[i][0])
    return sorted(sorted(x) for x in found.values())


def grouped(result):
    found = collections.defaultdict(list)
    for r in result:
        found[r.class_id].append(r.doc_id)
        assert r.class_id == r.doc_id or not r.kept
    assert sum(r.kept for r in result) == len(found)
    assert all(r.class_size == len(found[r.class_id]) for r in result)
    return sorted(sorted(x) for x in found.values())


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words]


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert grouped(QUERIES["op10_near_dedup"](spark, sf).collect()) == slow_classes(rows)


def test_group_of_edited_copies_and_common_shingles(spark, docs):
    rng = random.Random(3)
    base, line = [f"w{i}" for i in range(150)], [f"common{i}" for i in range(12)]
    texts = [" ".join(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.06]))) for _ in range(120)]
    texts += [" ".join(line + [f"x{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(40)]
    rows = list(enumerate(texts))
    result = near_dedup.near_duplicates(docs(rows)).collect()
    assert grouped(result) == slow_classes(rows)


def test_samples_agree_as_often_as_texts_are_similar():
    weights = near_dedup.Weights({})
    sampler = near_dedup.Sampler(weights.rare)
    rng, agree, true = random.Random(1), [], []
    for _ in range(150):
        words = [f"w{rng.randrange(400)}" for _ in range(120)]
        a, b = (weights.of(" ".join(x).encode()) for x in (words, edited(rng, words, 0.03)))
        b = (b[0], b[1] * np.where(b[0] % np.uint64(3) == 0, 1.5, 1.0))  # weights other than the usual one
        true.append(near_dedup.similarity(a, b))
        agree.append((sampler.sample(*a) == sampler.sample(*b)).mean())
    assert np.mean(agree) == pytest.approx(np.mean(true), abs=0.02)
    assert np.corrcoef(agree, true)[0, 1] > 0.8


def test_odd_documents(docs):
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(40000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " end"), (None, "alone here"),
            (None, "one two"), (9, "x y z"), (9, "p q r"), (9, "x y z")]
    found = collections.defaultdict(list)
    for r in near_dedup.near_duplicates(docs(rows)).collect():
        found[r.class_id, r.class_size].append(r.kept)
    assert sorted((k, sorted(v)) for k, v in found.items() if k[0] is not None and k[0] != 9) == [
        ((1, 3), [False, False, True]), ((4, 3), [False, False, True]), ((6, 1), [True]), ((7, 2), [False, True])]
    assert found[None, 1] == [True] and found[9, 1] == [True] and sorted(found[9, 2]) == [False, True]
    left = near_dedup.keep_one(docs(rows))
    assert left.columns == docs(rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted(
        [(0, "alone here"), (1, ""), (4, "One two"), (6, "one two three"), (7, long), (9, "x y z"), (9, "p q r")])
    assert near_dedup.near_duplicates(docs([])).collect() == []
