"""Source divergence audit: Arrow kernels count terms inside tasks, merged columnar shards give the divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import byte_blocks, shards, stored

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what lies between terms
LEAST_DOCS = 10  # of a language, for a term to be kept
TOP = 10  # terms reported of a group
SCALE = 1_000_000_000
ROWS = 400_000  # partial counts that a task gathers before it combines them
CELLS = 1 << 20  # of a block of probabilities, and of sums that a task holds

PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _counts(block: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term); a row with a null term for each (lang, source)."""
    langs, sources = (pc.fill_null(block[name], "").dictionary_encode() for name in ("lang", "source"))
    width = max(1, len(sources.dictionary))
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), width), sources.indices.cast(pa.int64()))
    # In this order: lower-casing a slice that was cast to wide offsets gives wrong bytes.
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(block["text"], "")).cast(pa.large_string()), NO_TERM)
    terms = pc.list_flatten(parts).dictionary_encode()
    found = pa.table({"doc": pc.list_parent_indices(parts), "term": terms.indices})
    blank = pc.index(terms.dictionary, pa.scalar("", pa.large_string())).as_py()
    found = found.filter(pc.not_equal(found["term"], blank))
    found = found.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    found = pa.table({"group": pc.take(group, found["doc"]), "term": found["term"], "n": found["count_all"]})
    found = found.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    seen = pc.unique(group)
    marks = pa.table({"group": seen, "term": pa.nulls(len(seen), pa.int32()), "n_sum": pa.array(np.zeros(len(seen), np.int64)), "n_count": pa.array(np.zeros(len(seen), np.int64))})
    every = pa.concat_tables([found.select(marks.column_names), marks])
    code = every["group"].to_numpy()
    return pa.table([
        pc.take(langs.dictionary, pa.array(code // width)), pc.take(sources.dictionary, pa.array(code % width)),
        pc.take(terms.dictionary.cast(pa.string()), every["term"]), every["n_sum"], every["n_count"],
    ], schema=PARTIAL)


def _combined(tables: list[pa.Table]) -> pa.Table:
    grouped = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return grouped.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(PARTIAL.names).cast(PARTIAL)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, rows = [], 0
    for block in byte_blocks(batches, "text"):
        tables.append(_counts(block))
        rows += tables[-1].num_rows
        if rows > ROWS:
            tables = [_combined(tables)]
            rows = tables[0].num_rows
            if rows > ROWS // 2:
                yield from tables[0].to_batches()
                tables, rows = [], 0
    if tables:
        yield from _combined(tables).to_batches()


def _merged(least_docs: int):
    """For one shard of terms: of each kept (lang, term) the sources that have it and their counts."""
    def merge(shard: pa.Table) -> pa.Table:
        found = _combined([shard.select(PARTIAL.names)])
        found = found.group_by(["lang", "term"], use_threads=False).aggregate([("docs", "sum"), ("source", "list"), ("n", "list")])
        found = found.filter(pc.or_(pc.is_null(found["term"]), pc.greater_equal(found["docs_sum"], least_docs)))
        return pa.table({"lang": found["lang"], "term": found["term"], "sources": found["source_list"], "counts": found["n_list"]})

    return merge


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, sources, counts``: the kept terms of each language and how often each source has them.

    A row whose term is null has the sources of a language, terms or not. Tasks count with Arrow kernels
    and send one row per (lang, source, term) and some ``ROWS`` rows; these are dealt by (lang, term), so
    that neither a common term nor a large source brings more than that to any task.
    """
    read = docs.select("lang", "source", "text").mapInArrow(_partial, "lang string, source string, term string, n long, docs long")
    parts = read.withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards(docs.sparkSession))))
    return parts.groupBy("shard").applyInArrow(_merged(least_docs), "lang string, term string, sources array<string>, counts array<long>")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * count / total)`` by long division, exact for totals up to 9e15."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        part, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + part
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Sums:
    """What a task has found: sums over terms for pairs of sources, and the first terms of each group."""

    def __init__(self, groups: dict[str, tuple[list[str], np.ndarray, int]], top: int):
        self.groups, self.top, self.pairs, self.first, self.cells = groups, top, {}, {}, 0
        self.known = {lang: pa.array(sources, pa.string()) for lang, (sources, _, _) in groups.items()}

    def add(self, lang: str, rows: pa.RecordBatch) -> None:
        """Takes whole rows of one language in blocks of ``CELLS`` probabilities, terms by sources."""
        _, sizes, kept = self.groups[lang]
        step = max(1, CELLS // len(sizes))
        for at in range(0, rows.num_rows, step):
            block = rows.slice(at, step)
            term = pc.list_parent_indices(block["sources"]).to_numpy()
            source = pc.index_in(pc.list_flatten(block["sources"]), self.known[lang]).to_numpy()
            count = pc.list_flatten(block["counts"]).to_numpy()
            counts = np.zeros((block.num_rows, len(sizes)), dtype=np.int64)
            counts[term, source] = count
            p = share(counts + 2, (sizes + 2 * kept)[None, :])
            q = share(counts.sum(axis=1) + 2, sizes.sum() + 2 * kept)
            for i in range(len(sizes) - 1):
                total = gap(p[:, i, None], p[:, i + 1 :]).sum(axis=0)
                if (lang, i) in self.pairs:
                    self.pairs[lang, i] += total
                else:
                    self.pairs[lang, i] = total
                    self.cells += len(total)
            own = p[term, source]
            more = np.flatnonzero((own > q[term]) & (count > 0))
            self._rank(lang, source[more], gap(own[more], q[term[more]]), block["term"].take(pa.array(term[more])))

    def _rank(self, lang: str, source: np.ndarray, value: np.ndarray, term: pa.Array) -> None:
        found = pa.table({"source": source, "value": value, "term": term})
        found = found.take(pc.sort_indices(found, [("source", "ascending"), ("value", "descending"), ("term", "ascending")]))
        source = found["source"].to_numpy()
        place = np.arange(len(source)) - np.searchsorted(source, source)
        for row in found.filter(pa.array(place < self.top)).to_pylist():
            best = self.first.setdefault((lang, row["source"]), [])
            best.append((-row["value"], row["term"].encode()))
        for at in np.unique(source).tolist():
            self.first[lang, at] = sorted(self.first[lang, at])[: self.top]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, i), totals in self.pairs.items():
            names = self.known[lang]
            n = len(totals)
            yield pa.record_batch([
                pa.repeat(pa.scalar(lang), n), pa.repeat(names[i], n), pa.repeat(pa.scalar("pair"), n), names.slice(i + 1), pa.array(totals),
            ], names=["lang", "source", "part", "item", "value"])
        for (lang, i), best in self.first.items():
            yield pa.record_batch([
                [lang] * len(best), [self.known[lang][i].as_py()] * len(best), ["term"] * len(best), [t.decode() for _, t in best], [-v for v, _ in best],
            ], names=["lang", "source", "part", "item", "value"])
        self.pairs, self.first, self.cells = {}, {}, 0


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the sources of a language differ in their words.

    Part ``pair`` has a row for each other source of the language, part ``term`` the ``top`` terms that
    a source has more often than its language. Counts are exact; probabilities are whole billionths,
    smoothed by 2. The counts of a term in all sources make one row of a table in the shared folder, so
    the divergences need no shuffle of counts: a task adds up sums over its terms for each pair, in
    blocks of ``CELLS`` numbers, and keeps ``top`` terms a group.

    One number per (lang, source) goes to the driver and to each task: the result itself has the square
    of their number as rows. Counts are exact up to 9e15 words of a language.

    Defined cases: a null text, lang or source is an empty string; a group without terms has pairs, but
    no terms; a language without kept terms has pairs of value 0; a language with one source has no
    pairs; ties go by the item in UTF-8 order; repeated rows are documents of their own; an empty table
    gives no rows; other columns are ignored.
    """
    kept = stored(term_counts(docs, least_docs), "term-counts")
    groups = kept.where("term is null").select("lang", F.explode("sources").alias("source")).distinct()
    words = kept.where("term is not null")
    sizes = words.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("words"))
    vocabulary = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    known: dict[str, tuple[list[str], np.ndarray, int]] = {}
    listed: dict[str, list] = {}
    for row in groups.join(sizes, ["lang", "source"], "left").collect():
        listed.setdefault(row["lang"], []).append((row["source"], row["words"] or 0))
    for lang, found in listed.items():
        found.sort()
        known[lang] = ([s for s, _ in found], np.array([n for _, n in found], dtype=np.int64), vocabulary.get(lang, 0))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(sent.value, top)
        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                sums.add(lang, batch.filter(pc.equal(batch["lang"], lang)))
            if sums.cells > CELLS:
                yield from sums.rows()
        yield from sums.rows()

    found = stored(words.mapInArrow(gaps, "lang string, source string, part string, item string, value long"), "gaps")
    half = found.where("part = 'pair'")
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, F.expr("a.lang = b.lang and a.source <> b.source")).select("a.lang", "a.source", F.col("b.source").alias("item"))
    pairs = pairs.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    terms = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms)
