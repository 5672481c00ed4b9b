import collections
import re

import numpy as np
import pytest

from quakeframe.llm import collocations, queries

UPPER = {i: i + 32 for i in range(65, 91)}


def slow(rows, least=10, top=2000, covered=50):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= covered * found[q]}
        scored = []
        for p, a in found.items():
            if p not in dropped:
                score, k = min((10**6 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def rows(found):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found.collect())


@pytest.mark.parametrize("block,small", [(60, 4), (1 << 25, 1 << 18)])
def test_against_counting(docs, monkeypatch, block, small):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations.equal_partitions, "__defaults__", (1, small))
    random = np.random.default_rng(3)
    words = np.array(["New", "york", "City", "of", "ÉTÉ", "été", "a\x00b", "x."])
    cells = [(" ".join(random.choice(words, random.integers(0, 40), p=[0.3, 0.25, 0.2, 0.05, 0.05, 0.05, 0.05, 0.05])), lang) for lang in ("en", None, "und", "", "a b") for _ in range(25)]
    cells += [(None, "en"), ("", "en"), ("go " * 3000, "fr"), ("one two. " * 9 + "one\ttwo", "nine"), ("p q\r\n" * 10, "ten")]
    found = collocations.collocations(docs([(i, *c) for i, c in enumerate(cells)]).repartition(4), 10, 6)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows(found) == slow(cells, 10, 6)


def test_a_pair_inside_a_longer_phrase_goes(docs):
    cells = [("a b c, " * 10 + "a b; " * 9 + "b c d. " * 10, "x")]
    found = collocations.collocations(docs([(1, *cells[0])]))
    assert rows(found) == slow(cells)
    assert {r["phrase"] for r in found.collect()} == {"a b c", "b c d"}


def test_no_rows(docs):
    assert collocations.collocations(docs([])).collect() == []
    assert collocations.collocations(docs([(1, None), (2, "alone")])).collect() == []


def test_equal_partitions():
    random = np.random.default_rng(1)
    keys = [random.integers(0, 5, 5000) for _ in range(3)]
    for before, key in zip(keys, keys[1:]):
        key[before == 0] = 0  # nothing follows an ended phrase
    weight = random.integers(1, 4, 5000)
    for small in (1, 10, 10**6):
        found = collocations.equal_partitions(keys, weight, 30, small)
        for depth in range(3):
            expected = collections.Counter()
            for i in range(5000):
                if all(k[i] for k in keys[: depth + 1]):
                    expected[tuple(k[i] for k in keys[: depth + 1])] += weight[i]
            assert {tuple(k[p] for k in keys[: depth + 1]): t for p, t in zip(*found[depth])} == {k: v for k, v in expected.items() if v >= 30}


def test_query_against_sql(spark, con, sf):
    ours = sorted(map(tuple, queries.op12_collocations(spark, sf).collect()))
    assert ours == sorted(map(tuple, con.execute(queries.ORACLES["op12_collocations"]).fetchall()))
