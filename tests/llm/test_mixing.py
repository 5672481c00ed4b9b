import collections
import itertools
import random

import pytest

from quakeframe.llm import mixing
from quakeframe.llm.queries import QUERIES


def slow_targets(sizes):
    """Shares by stepping: give out by weight, cap, give out again."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    given, left = dict.fromkeys(order, 0.0), float(sum(sizes.values()))
    for _ in range(10000):
        free = [s for s in order if given[s] < 3 * sizes[s] - 1e-9]
        if left < 1e-9 or not free:
            break
        total = sum(weight[s] for s in free)
        step = {s: min(left * weight[s] / total, 3 * sizes[s] - given[s]) for s in free}
        for s in free:
            given[s] += step[s]
        left -= sum(step.values())
    return given


def test_targets():
    rng = random.Random(1)
    for _ in range(50):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 500, 10**6]) for i in range(rng.randrange(1, 9))} | {None: 7}
        assert mixing.targets(sizes) == pytest.approx(slow_targets(sizes), rel=1e-6, abs=1e-3)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_fill_is_as_near_as_any_subset():
    rng = random.Random(2)
    for _ in range(300):
        lengths = sorted(rng.sample(range(1, 30), rng.randrange(1, 5)))
        counts = [rng.randrange(1, 4) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        budget = rng.randrange(total + 3)
        taken = mixing.fill(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        best = min(abs(budget - sum(n * t for n, t in zip(lengths, ts))) for ts in itertools.product(*(range(c + 1) for c in counts)))
        got = abs(budget - sum(n * t for n, t in zip(lengths, taken)))
        assert got == best
    assert sum(n * t for n, t in zip([3, 50, 400], mixing.fill([3, 50, 400], [1000, 900, 500], 123457))) == pytest.approx(123457, abs=1)


def check(rows, result):
    size = {}
    for r in result:
        assert r.taken == r.copies * r.size and r.copies <= 3
    sources, taken, wanted = collections.Counter(), collections.Counter(), {}
    for r in result:
        sources[r.source] += r.size
        taken[r.source] += r.taken
        wanted[r.source] = r.target
    assert collections.Counter((r.doc_id, r.source, r.size) for r in result) == collections.Counter((i, s, len((t or "").split())) for i, t, s in rows)
    assert wanted == pytest.approx(slow_targets(dict(sources)))
    assert all(r.source_size == sources[r.source] for r in result)
    longest = collections.defaultdict(int)
    for r in result:
        longest[r.source] = max(longest[r.source], r.size)
    for s, target in wanted.items():
        assert abs(taken[s] - target) <= max(1, longest[s])
    return size


def test_query(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    first = QUERIES["op6_mixing"](spark, sf)
    result = first.collect()
    check(rows, result)
    for s in {r.source for r in result}:  # ten documents each: no subset need fit
        target = next(r.target for r in result if r.source == s)
        assert abs(sum(r.taken for r in result if r.source == s) - target) <= 0.02 * target
    assert sorted(map(tuple, QUERIES["op6_mixing"](spark, sf).collect())) == sorted(map(tuple, result))


def test_odd_documents(docs):
    rows = [(i, "w " * (i % 4), "en", "hot") for i in range(400)] + [(401, None, "en", "b"), (402, "one", "en", None), (None, "two words", "en", None),
            (403, "long " * 50000, "en", "z"), (403, "long " * 50000, "en", "z"), (404, "", "en", "b"), (405, "\x1codd\xa0space x", "en", "é")]
    frame = docs(rows)
    result = mixing.mix(frame).collect()
    assert len(result) == len(rows)
    assert {r.doc_id: r.size for r in result}[405] == 2
    taken = collections.Counter()
    for r in result:
        taken[r.doc_id] += r.copies
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +taken
    assert mixing.mix(docs([])).collect() == [] and mixing.mixed(docs([])).collect() == []


@pytest.mark.parametrize("share", [0.3, 0.78])
def test_rare_lengths_are_taken_in_proportion(share):
    rng = random.Random(6)
    lengths = sorted({int(rng.lognormvariate(5.5, 0.8)) + 1 for _ in range(2000)})
    counts = [1] * len(lengths)
    budget = round(share * sum(lengths))
    by_quarter = [0.0] * 4
    for seed in range(8):
        taken = mixing.fill(lengths, counts, budget, seed)
        assert sum(n * t for n, t in zip(lengths, taken)) == budget and max(taken) == 1
        for q in range(4):
            part = taken[q * len(taken) // 4 : (q + 1) * len(taken) // 4]
            by_quarter[q] += sum(part) / len(part) / 8
    assert all(abs(x - share) < 0.1 for x in by_quarter)
    assert mixing.fill(lengths, counts, budget, 1) != mixing.fill(lengths, counts, budget, 2)
