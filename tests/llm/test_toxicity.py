import random

import numpy as np
import pytest

from quakeframe.llm import toxicity
from quakeframe.llm.queries import QUERIES


def auc(pairs):
    ranks = {s: i for i, s in enumerate(sorted({s for s, _ in pairs}))}
    good, bad = [ranks[s] for s, y in pairs if y], [ranks[s] for s, y in pairs if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_margin_equals_all_pairs():
    rng = np.random.default_rng(4)
    size = 1 << toxicity.BITS
    machine = toxicity.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, toxicity.FACTORS)), np.ones(size, dtype=bool))
    texts = [b"a b c", b"", b"a a a", b"one two, three! caf\xc3\xa9 \xc3\xa9t\xc3\xa9"]
    got = machine.margin(*toxicity.terms(texts), len(texts))
    for value, text in zip(got, texts):
        columns = toxicity.terms([text])[1]
        expected = 0.3 + machine.weight[columns].sum()
        expected += sum(machine.vector[i] @ machine.vector[j] for i in columns for j in columns if i < j)
        assert value == pytest.approx(expected)


def test_learns_pairs_that_no_sum_of_weights_can_tell():
    rng = random.Random(2)
    rows = []
    for _ in range(1600):
        a, b = rng.random() < 0.5, rng.random() < 0.4
        words = [f"w{rng.randrange(300)}" for _ in range(20)] + ["insult"] * a + ["group"] * b
        rows.append((toxicity.terms([" ".join(words).encode()])[1], int(a == b) if a or b else int(rng.random() < 0.2)))
    machine = toxicity.fit(rows)
    score = dict(zip(("both", "insult", "group"), machine.score(["insult group", "insult", "group"])))
    assert score["both"] > 0.8 and score["insult"] < 0.2 and score["group"] < 0.2


def test_learns_pairs_of_words_that_are_as_frequent_in_either_label():
    rng = random.Random(3)

    def row(i, y):
        words = [f"w{rng.randrange(2000)}" for _ in range(60)] + [f"common{k}" for k in range(12) if rng.random() < 0.7]
        has = (i < 900, i < 900) if y else (i < 900, 900 <= i < 1800)
        return toxicity.terms([" ".join(words + ["insult"] * has[0] + ["group"] * has[1]).encode()])[1], y

    rows = [row(i, y) for y in (0, 1) for i in range(3000)]
    machine = toxicity.fit([r for k, r in enumerate(rows) if k % 5])
    margin = lambda c: machine.margin(np.zeros(len(c), np.int64), c, 1)[0]
    left = [(k % 3000, margin(c), y) for k, (c, y) in enumerate(rows) if k % 5 == 0]
    both = [m for i, m, y in left if y and i < 900]
    one = [m for i, m, y in left if not y and i < 1800]
    assert np.mean([m > 0 for m in both]) > 0.9 and np.mean([m < 0 for m in one]) > 0.9


def test_rare_words_of_one_label_count():
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        words = [f"w{rng.randrange(500)}" for _ in range(20)] + ["awful"] * (i % 2 and i % 3 == 0) + ["vile"] * (i in (11, 505, 1201, 3003))
        rows.append((toxicity.terms([" ".join(words).encode()])[1], i % 2))
    machine = toxicity.fit(rows)
    column = {w: toxicity.terms([w.encode()])[1] for w in ("awful", "vile")}
    assert machine.used[column["vile"]].all() and 0 < machine.weight[column["vile"]] < machine.weight[column["awful"]]


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op9_toxicity"](spark, sf)
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = found.collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert auc([(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]) > 0.7
    assert not [r for r in rows if r.held_out and truth.get(r.doc_id) == 0 and r.predicted]


def test_odd_documents(spark, docs):
    rows = [(i, "you awful person" if i % 4 == 0 else "a nice day to you all") for i in range(80)]
    rows += [(80, None), (81, ""), (82, "!!!"), (None, "awful awful"), (3, "awful again"), (83, "nice " * 50000 + "awful")]
    label_rows = [(i, 1 if i % 4 == 0 else 0, 7) for i in range(80)] + [(0, 0, 7), (None, 1, 7), (81, None, 7), (4, 1, 7)]
    labels = spark.createDataFrame(label_rows, "doc_id long, toxic int, text int")
    found = toxicity.scored(docs(rows), labels).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert by[80].score == by[81].score == by[82].score < 0.5 < by[None].score and by[None].held_out
    assert by[4].predicted == 1 and by[5].predicted == 0
    nothing = toxicity.scored(docs(rows), labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert toxicity.scored(docs([]), labels).collect() == []
