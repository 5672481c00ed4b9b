import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quakeframe.llm import bpe, token_files
from quakeframe.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "  ", "Σας ΟΔΟΣ ΣΣ.", "İstanbul ǅ", "á ́x é", "<|endoftext|>it's <|startoftext|><|endoftext", "x\x1cy\x1dz \x85 \xa0q r　",
    "''s''re 12 ½ ²٣", "🇩🇪", "ﬀ ﬁ ＡＢ", "\x00\x01", "a" * 3000, "ab" * 2000, "!" * 5000, "é" * 1500, None, "the the", "the the",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    runs = ["".join(rng.choice(["th", "er", "ing", "on", "an", "é", "ß", "s", "t"]) for _ in range(n)) for n in (40, 700, 3000)]
    return ODD + runs


def rows():
    return [*enumerate(texts()), (None, "no id"), (3, "again")]


def test_transducer_equals_library(docs, library):
    found = {(r.doc_id, r.ids_sha256, r.decoded_sha256, r.n_tokens) for r in bpe.encoded(docs(rows()), PATH).collect()}
    expected = set()
    for i, text in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        numbers, decoded = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        expected.add((i, hashlib.sha256(numbers.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), len(ids)))
    assert found == expected


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_stream_keeps_its_window(name):
    path = public_tokenizers.path(name)
    codec, library = bpe.Codec(path), Tokenizer.from_file(path)
    for text in texts():
        ids = list(codec.encode(text or ""))
        assert ids == library.encode(text or "", add_special_tokens=False).ids
        assert "".join(codec.decode(ids)) == library.decode(ids, skip_special_tokens=False)
    ahead = iter(range(10**6))
    used = codec.merges.encode((next(ahead), 97 + _ % 7)[1] for _ in range(10**5))
    next(used)
    assert next(ahead) <= codec.merges.window + 1  # the first token came out after one window


def test_files_round_trip(docs, library):
    frame = docs(rows())
    found = token_files.round_trip(frame, PATH).orderBy("start").collect()
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, len(library.encode(r[1] or "", add_special_tokens=False).ids)))
    start = 0
    for row, (i, text) in zip(found, ordered, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_query_and_single_documents(spark, sf, library, tmp_path):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    files, dictionary = token_files.write(documents, PATH, str(tmp_path / "ids"))
    assert len(dictionary) > 1000
    listed = [r.path for r in files.orderBy("file").collect()]
    expected, start = {}, 0
    for row in documents.orderBy("doc_id").collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        expected[row.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_files"](spark, sf).collect()}
    assert found == expected
    for doc_id in (0, 57, 199):
        got = [x for x in (token_files.fetch(p, dictionary, doc_id) for p in listed) if x is not None]
        assert len(got) == 1 and zlib.crc32(got[0].astype("<u4").tobytes()) == expected[doc_id][2]
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.fetch(listed[0], b"", 0)


def test_no_documents(docs):
    assert token_files.round_trip(docs([]), PATH).collect() == []
    assert bpe.encoded(docs([]), PATH).collect() == []


def test_letters_of_any_script_are_asked_for_once(monkeypatch):
    """Whole words of letters, whatever the script, need no pass of the library's splitter; ids are the library's."""
    import unicodedata

    own, tokenizer, asked = token_files.Encoder(PATH, 2), Tokenizer.from_file(PATH), []
    slow = own._asked
    monkeypatch.setattr(own, "_asked", lambda chunk: asked.append(chunk) or slow(chunk))
    draw = random.Random(5)
    scripts = ["abzß", "éÀñçÖ", "жЩяЁ", "ΣΑσςΰ", "漢字", "שלום", "हिन्दी", "İIıi", "ǅǆ", "ﬁ", "각가", "ไทย"]
    words = ["".join(draw.choices(draw.choice(scripts) + "ae", k=draw.randint(1, 8))) for _ in range(3000)]
    text = " ".join(w + draw.choice(["", "", ",", "'s", "'LL", "7", "…", "é", "--'t"]) for w in words)
    assert list(np.frombuffer(own.encode(text), "<u2")) == tokenizer.encode(text, add_special_tokens=False).ids
    plain = [c for c in text.split() if all(unicodedata.category(x).startswith("L") and x != "İ" for x in c)]  # that one gets a mark
    assert len(plain) > 500 and not {c for c in plain if unicodedata.is_normalized("NFC", c)} & set(asked)
    every = "".join(map(chr, [*range(32, 0x3400), *range(0xA000, 0xA830), *range(0xF900, 0x10000), *range(0x10000, 0x10500)]))
    for sample in (" ".join(every), " ".join(f"a{c}b" for c in every), " ".join("".join(draw.choices(every, k=4)) for _ in range(20000))):
        assert own.encode(sample) == own._whole(sample)
