import math
import random
from collections import Counter, defaultdict

import pytest

from quakeframe.llm import language
from quakeframe.llm.queries import QUERIES


def slow_bits(sample, text, order):
    """The same by dictionaries, byte by byte."""
    seen = defaultdict(Counter)
    for data in sample:
        for i, byte in enumerate(data):
            for k in range(min(order, i) + 1):
                seen[data[i - k : i]][byte] += 1
    bits = 0.0
    for i, byte in enumerate(text):
        excluded = set()
        for k in range(min(order, i), -1, -1):
            counts = {b: n for b, n in seen.get(text[i - k : i], {}).items() if b not in excluded}
            if text[i - k : i] not in seen:
                continue
            total, distinct = sum(counts.values()), len(counts)
            if byte in counts:
                bits += math.log2((total + distinct) / counts[byte])
                break
            if distinct:
                bits += math.log2((total + distinct) / distinct)
            excluded = set(seen[text[i - k : i]])
        else:
            bits += math.log2(256 - len(excluded))
    return bits


@pytest.mark.parametrize("order", [1, 2, 3])
def test_code_lengths_equal_brute_force(order):
    rng = random.Random(order)
    samples = {x: ["".join(rng.choice(a) for _ in range(200)).encode() for _ in range(4)] for x, a in (("aa", "abc d"), ("bb", "abé f"))}
    model = language.Model(["aa", "bb"], {x: language.count_grams(s, order) for x, s in samples.items()}, order)
    texts = [b"a", b"abc d", "é fß".encode(), b"zzzz", *("".join(rng.choice("abcdé fxy") for _ in range(90)).encode() for _ in range(9))]
    got = model.bits_of(texts)
    for row, text in zip(got, texts):
        assert row.tolist() == pytest.approx([slow_bits(samples[x], text, order) for x in ("aa", "bb")], rel=1e-5)


def test_query_on_held_out_documents(spark, sf):
    found = QUERIES["op1_language"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_odd_documents(docs):
    en, de = "the quick fox and the dog ran over the hill", "der schnelle fuchs und der hund liefen über den berg"
    rows = [(i, (en, de)[i % 2] * (1 + i % 3), ("en", "de")[i % 2], "s") for i in range(30)]
    rows += [(30, None, "en"), (31, "", "en"), (32, "12 34 !!", "de"), (33, "the dog", None), (None, "der hund", "de"), (0, en, "en"), (34, "the dog " * 30000, "en")]
    found = language.identified(docs(rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert {by[i].lang_pred for i in (30, 31, 32)} == {"und"} and by[31].score == 0
    assert by[33].lang_pred == by[34].lang_pred == "en" and by[None].lang_pred == "de" and by[None].held_out
    assert language.identified(docs([])).collect() == []
    assert [r.lang_pred for r in language.identified(docs([(1, "text", None)])).collect()] == ["und"]


@pytest.mark.parametrize("sample", [3, 400])
def test_a_language_of_few_copied_texts_is_learned(docs, sample):
    rng = random.Random(8)
    german = ["der hund und die katze schlafen", "wir gehen heute nicht nach hause", "das wetter ist schön und warm", "ich habe keine zeit für dich", "sie liest ein gutes buch"]
    english = [" ".join(rng.choice(["the", "dog", "and", "cats", "with", "house", "they", "this", "have"]) for _ in range(12)) for _ in range(50)]
    rows = [(i, german[i % 5], "de") for i in range(1000)] + [(1000 + i, text, "en") for i, text in enumerate(english)]
    found = language.identified(docs(rows), sample).collect()
    right = sum(r.lang_pred == ("de" if r.doc_id < 1000 else "en") for r in found)
    assert right > 0.95 * len(rows)
