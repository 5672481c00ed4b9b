import collections
import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quakeframe.llm import mixing
from test_near_dedup import slow_classes

UPPER = {i: i + 32 for i in range(65, 91)}


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = left
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert all(r == given[r.doc_id] for r in rows)
        left = {r.doc_id: r for r in rows}
        if name == "language":
            assert set(left) == {i for i, r in given.items() if any(c.isalpha() for c in r.text or "")}
        if name == "exact dedup":
            best = {(r.text or "").translate(UPPER): i for i, r in sorted(given.items())}
            assert sorted(r.doc_id for r in rows) == sorted(best.values())
        if name == "near dedup":
            assert sorted(r.doc_id for r in rows) == sorted(min(g) for g in slow_classes([(i, r.text) for i, r in given.items()]))
        if name == "mixing":
            size = {i: len((r.text or "").split()) for i, r in given.items()}
            sources = collections.Counter()
            for i, r in given.items():
                sources[r.source] += size[i]
            taken = collections.Counter()
            for r in rows:
                taken[r.source] += size[r.doc_id]
            for source, target in mixing.targets(dict(sources)).items():
                assert abs(taken[source] - target) <= 0.02 * target + 3
            assert max(collections.Counter(r.doc_id for r in rows).values()) <= 3
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in rows)
    for r in last:
        ids = library.encode(left[r.doc_id].text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in last)


def test_odd_documents(spark, docs):
    rows = [(1, "the dog and the cat " * 9, "en", "a"), (2, "THE dog and the cat " * 9, "en", "a"), (2, "the dog and the cat " * 9, "en", "b"), (3, None, "en", "a"),
            (4, "", None, None), (None, "der hund und die katze " * 9, "de", None), (5, "123", "de", "b"), (6, "der hund und die katz " * 9, "de", "a"), (6, "der hund und die katz " * 9, "de", "a")]
    for given in (rows, []):
        frame = docs(given)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, "")
            assert out.columns == frame.columns
            frame = spark.createDataFrame(out.collect(), frame.schema)
        texts = {r.text for r in frame.collect()}
        assert len(texts) == 3 if given else not texts
        assert corpus_pipeline.STAGES[-1][1](spark, frame, "").count() == frame.count()
