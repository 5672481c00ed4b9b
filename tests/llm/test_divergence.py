import collections
import re

import numpy as np
import pytest

from quakeframe.llm import divergence, queries

UPPER = {i: i + 32 for i in range(65, 91)}


def slow(rows, least_docs, top):
    rows = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs = collections.Counter(t for _, _, terms in own for t in set(terms))
        kept = {t for t, n in docs.items() if n >= least_docs}
        groups = {s: collections.Counter() for _, s, _ in own}
        for _, s, terms in own:
            groups[s].update(t for t in terms if t in kept)

        def p(count):
            return {t: 1 + 10**9 * (count[t] + 2) // (sum(count.values()) + 2 * len(kept)) for t in kept}

        chance, q = {s: p(c) for s, c in groups.items()}, p(sum(groups.values(), collections.Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(-sum(gap(chance[s][t], chance[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-gap(chance[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and chance[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(items, 1)]
    return sorted(out)


def rows(found):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found.collect())


@pytest.mark.parametrize("block", [40, 1 << 23])
def test_against_counting(docs, monkeypatch, block):
    monkeypatch.setattr(divergence, "CELLS", 7)
    monkeypatch.setattr(divergence, "byte_blocks", lambda batches, column: blocks(batches, column, block))
    random = np.random.default_rng(5)
    words = ["The", "the", "Über", "über", "né", "a_b", "x9y", "日本", "zu"]
    cells = [(" ".join(random.choice(words, random.integers(0, 30))), *x) for x in [("de", "s1"), ("de", "s2"), ("de", None), (None, "s1"), ("fr", "é")] * 12]
    cells += [(None, "de", "s1"), ("", "empty", "a"), (None, "empty", "b"), ("the " * 30000, "de", "s2"), ("1 2 !", "de", "quiet")]
    found = divergence.divergences(docs([(i, *c) for i, c in enumerate(cells)]).repartition(5), 4, 3)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(found) == slow(cells, 4, 3)


blocks = divergence.byte_blocks


def test_ties_and_repeated_rows(docs):
    cells = [("b a c", "x", "s"), ("b a c", "x", "s"), ("d", "x", "t"), ("d", "x", "t")]
    found = divergence.divergences(docs([(1, *c) for c in cells]), 2, 2)
    assert rows(found) == slow(cells, 2, 2)
    assert [r["item"] for r in found.where("source = 's' and part = 'term'").orderBy("rank").collect()] == ["a", "b"]


def test_no_rows(docs):
    assert divergence.divergences(docs([])).collect() == []


def test_long_division():
    count, total = np.array([0, 1, 7, 5 * 10**15, 9 * 10**15]), np.array([1, 3, 7, 9 * 10**15 - 1, 9 * 10**15])
    assert divergence.share(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]


def test_query_against_sql(spark, con, sf):
    ours = sorted(map(tuple, queries.op11_divergence(spark, sf).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert ours == sorted(map(tuple, con.execute(queries.ORACLES["op11_divergence"]).fetchall()))
