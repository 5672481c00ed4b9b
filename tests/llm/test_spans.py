import random
import re

import pytest

from quakeframe.llm import spans
from quakeframe.llm.queries import QUERIES


def slow(rows):
    """Texts left, one document after the other, with every run looked up among those before."""
    seen, left = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        pieces = spans.sentences(text or "")
        words = [(text or "")[a:b].lower().split() for a, b, _ in pieces]
        gone = set()
        for i in range(len(pieces)):
            for j in range(i + spans.SENTENCES, len(pieces) + 1):
                run = tuple(w for x in words[i:j] for w in (*x, "."))
                if sum(map(len, words[i:j])) >= spans.WORDS:
                    if seen.setdefault(run, (doc_id, i)) != (doc_id, i):
                        gone |= set(range(i, j))
                    break
        left[doc_id] = "".join((text or "")[a:b] for k, (a, b, _) in enumerate(pieces) if k not in gone) if text is not None else None
    return left


def test_query_equals_slow_search(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op4_substring_dedup"](spark, sf).collect()
    expected = slow(rows)
    assert {r.doc_id: r.text for r in found} == expected
    texts = dict(rows)
    for r in found:
        assert r.n_removed == sum(p.end - p.start for p in r.removed) == len(texts[r.doc_id] or "") - len(r.text or "")


@pytest.mark.parametrize("shape", ["one sentence", "sentences", "lines"])
def test_passages_of_fifty_words(docs, shape):
    rng = random.Random(shape)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    end = {"one sentence": "", "sentences": ".", "lines": ".\n"}[shape]
    passage = " ".join(word() + (end if i % 9 == 8 else "") for i in range(51)) + ".\n"
    rows = [(i, "".join(" ".join(word() for _ in range(12)) + ".\n" for _ in range(4)) + (passage if i % 3 == 0 else "") + f"The end {word()}.") for i in range(12)]
    found = {r.doc_id: r for r in spans.without_repeats(docs(rows)).collect()}
    for i, text in rows:
        assert found[i].text == (text if i % 3 or i == 0 else text.replace(passage, ""))


def test_sentences_are_the_whole_text():
    for text in ("", "a", "\n\n a. b", "x " * 100, "He said \"no.\" Then? Yes!! \n\n\t", "a.b.c 3.14 e.g. this", " . . . ", "é" * 5000):
        pieces = spans.sentences(text)
        assert "".join(text[a:b] for a, b, _ in pieces) == text
        assert sum(n for *_, n in pieces) == len(text.split())


def test_odd_documents(docs):
    long = " ".join(f"w{i}." if i % 7 == 6 else f"w{i}" for i in range(59997))
    rows = [(1, None), (2, ""), (3, long), (4, long + " More here."), (5, "of the. " * 40), (None, long), (6, "short. one. two."), (6, "short. one. two."), (3, long)]
    found = sorted(((r.doc_id, r.text, r.n_removed) for r in spans.without_repeats(docs(rows)).collect()), key=str)
    repeated = [r for r in found if r[0] == 5]
    assert repeated[0][1].startswith("of the. ") and 0 < len(repeated[0][1]) < len("of the. " * 40)
    assert [r for r in found if r[0] != 5] == sorted(
        [(1, None, 0), (2, "", 0), (3, long, 0), (3, long, 0), (4, "More here.", len(long) + 1), (None, "", len(long)), (6, "short. one. two.", 0), (6, "short. one. two.", 0)], key=str)
    assert spans.without_repeats(docs([])).collect() == []


def shared_spans(rows, least):
    """(doc_id, first word, word behind the last) of the maximal runs of ``least`` words or more that an earlier text has."""
    seen, found = set(), []
    for doc_id, text in rows:
        words = text.lower().split()
        grams = [tuple(words[i : i + least]) for i in range(len(words) - least + 1)]
        at = None
        for i, gram in enumerate([*grams, None]):
            if gram in seen:
                at = i if at is None else at
            elif at is not None:
                found.append((doc_id, at, i - 1 + least))
                at = None
        seen.update(grams)
    return found


@pytest.mark.parametrize("length", [1, 5, 8, 9, 14, 23, 200])
def test_passages_behind_any_prefix_and_across_sentences(docs, length):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))

    def prose(n):
        return [word() + ("." if rng.random() < 1 / length else "") for _ in range(n)]

    rows = []
    for _ in range(40):
        passage = prose(51)
        rows += [(len(rows) + k, " ".join(prose(rng.randint(0, 30)) + passage + prose(rng.randint(0, 30)))) for k in range(4)]
    expected = shared_spans(rows, 51)
    assert len(expected) == 120
    removed = {r.doc_id: [(p.start, p.end) for p in r.removed] for r in spans.without_repeats(docs(rows)).collect()}
    texts = dict(rows)
    for doc_id, first, last in expected:
        starts = [m.start() for m in re.finditer(r"\S+", texts[doc_id])]
        gone = [i for i, at in enumerate(starts) if any(a <= at < b for a, b in removed[doc_id])]
        assert len(gone) >= spans.WORDS and first <= gone[0] < first + 15 and last - 24 < gone[-1] < last
    assert not any(removed[i] for i in range(0, len(rows), 4))


def test_cuts_fall_alike_whatever_precedes():
    rng = random.Random(9)
    words = [f"w{rng.randrange(500)}" for _ in range(300)]
    tails = set()
    for n in range(40):
        text = " ".join(["other"] * n + words)
        tails.add(tuple(text[a:b] for a, b, _ in spans.sentences(text))[-40:])
    assert len(tails) == 1 and all(n <= spans.PIECE for *_, n in spans.sentences(text))
