"""Phrase collocations: multikey quicksort of suffix pointers in tasks, and again over phrases routed by their words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import byte_blocks, mix, shards, stored, word_hashes

BREAK = r"[.,;:!?\x0A-\x0D]"  # ends a piece
LEAST = 10  # occurrences of a candidate
DEPTH = 3  # words of a phrase at most
TOP = 2000  # phrases reported of a language
COVERED = 50  # per cent of a pair's occurrences within one longer candidate, from which the pair is dropped
SMALL = 1 << 18  # pointers that are sorted at once
BLOCK = 1 << 23  # bytes of text whose suffixes a task sorts together
SHARDS = 4  # into which what a shuffle partition gets is dealt
SALTS = 64  # parts of a language in which its first phrases are sought before they meet

PACKED = pa.ipc.IpcWriteOptions(compression="zstd")
COUNTED = "lang string, first string, second string, third string, f long"


def _sorted_runs(keys: list[np.ndarray], part: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The pointers in key order, and for each key where its equal runs begin."""
    values = [key[part] for key in keys]
    bits = [int(v.max()).bit_length() for v in values]
    if sum(bits) < 64:
        packed = np.zeros(len(part), dtype=np.int64)
        for v, b in zip(values, bits):
            packed = packed << b | v
        order = np.argsort(packed)
    else:
        order = np.lexsort(values[::-1])
    new = np.zeros(len(part), dtype=bool)
    new[0] = True
    starts = []
    for v in values:
        v = v[order]
        new[1:] |= v[1:] != v[:-1]
        starts.append(np.flatnonzero(new))
    return part[order], starts


def equal_partitions(keys: list[np.ndarray], weight: np.ndarray, least: int = 1, small: int = SMALL) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth, one pointer into each class of pointers that agree up to there, and the weight of the class.

    Three-way partitioning by one key at a time: what equals the pivot goes on to the next key, and the
    weight of that part is a count. Parts that weigh less than ``least`` are abandoned, as is what lies
    behind an ended phrase (key 0). A part of ``small`` pointers is put in order at once.
    """
    found: list[list] = [[] for _ in keys]
    stack = [(np.arange(len(weight)), 0)] if len(weight) else []
    while stack:
        part, depth = stack.pop()
        if len(part) <= small:
            part, starts = _sorted_runs(keys[depth:], part)
            for at, start in enumerate(starts, depth):
                total = np.add.reduceat(weight[part], start)
                heavy = (total >= least) & (keys[at][part[start]] > 0)
                found[at].append((part[start[heavy]], total[heavy]))
            continue
        key = keys[depth][part]
        sample = np.sort(key[:: max(1, len(key) // 63)])
        pivot = sample[len(sample) // 2]
        same = part[key == pivot]
        total = weight[same].sum()
        if total >= least and pivot > 0:
            found[depth].append((same[:1], np.array([total])))
            if depth + 1 < len(keys):
                stack.append((same, depth + 1))
        for rest in (part[key < pivot], part[key > pivot]):
            if len(rest) and (least <= 1 or weight[rest].sum() >= least):
                stack.append((rest, depth))
    none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    return [tuple(map(np.concatenate, zip(none, *parts))) for parts in found]


def _suffixes(block: pa.RecordBatch) -> tuple[list[np.ndarray], pa.Array, pa.Array]:
    """Keys of all suffixes (language, then words up to ``DEPTH``; 0 behind the end of a piece), words and languages."""
    text = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(block["text"], "")), BREAK, " \n ")
    split = pc.split_pattern_regex(text.cast(pa.large_string()), r"[\x20\x09]+")
    words = pc.list_flatten(split).dictionary_encode()
    langs = pc.fill_null(block["lang"], "und").dictionary_encode()
    code, doc = words.indices.to_numpy(), pc.list_parent_indices(split).to_numpy()
    blank, stop = (pc.index(words.dictionary, pa.scalar(x, pa.large_string())).as_py() for x in ("", "\n"))
    there = code != blank
    code, doc = code[there], doc[there]
    key = np.where(code == stop, 0, code + 1).astype(np.int32)
    keys = [langs.indices.to_numpy()[doc] + np.int32(1), key]
    for _ in range(1, DEPTH):
        behind = np.zeros_like(key)
        behind[:-1] = np.where(doc[1:] == doc[:-1], keys[-1][1:], 0)
        keys.append(np.where(keys[-1] > 0, behind, 0))
    start = key > 0
    return [k[start] for k in keys], words.dictionary.cast(pa.string()), langs.dictionary


def _phrases(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Counts of all phrases of a block, dealt to shards by their words: one row for each shard."""
    for block in byte_blocks(batches, "text", BLOCK):
        keys, words, langs = _suffixes(block)
        if not len(keys[0]):
            continue
        count = equal_partitions(keys, np.ones(len(keys[0]), dtype=np.int64))[1:]
        columns = [np.concatenate([keys[0][at] for at, _ in count])]
        for depth in range(1, DEPTH + 1):
            columns.append(np.concatenate([keys[depth][at] if depth <= d else np.zeros(len(at), dtype=np.int32) for d, (at, _) in enumerate(count, 1)]))
        n = np.concatenate([total for _, total in count])
        joined = b" ".join(w.encode() for w in words.to_pylist() if w and w != "\n")
        digest = np.zeros(len(words) + 1, dtype=np.uint64)
        named = np.array([bool(w) and w != "\n" for w in words.to_pylist()])
        digest[1:][named] = word_hashes(joined)
        of_lang = np.array([0, *(zlib.crc32(lang.encode()) for lang in langs.to_pylist())], dtype=np.uint64)
        route = of_lang[columns[0]]
        for depth in range(1, DEPTH + 1):
            route = mix(route + digest[columns[depth]])
        route = (route % np.uint64(parts)).astype(np.int32)
        order = np.argsort(route, kind="stable")
        route, columns, n = route[order], [c[order] for c in columns], n[order]
        edges = [*np.flatnonzero(np.diff(route, prepend=-1)), len(route)]
        packed = []
        for a, b in zip(edges, edges[1:]):
            own = np.unique(np.concatenate([c[a:b] for c in columns[1:]]))
            own = own[own > 0]
            local = [np.searchsorted(own, c[a:b]) + (c[a:b] > 0) - 1 for c in columns[1:]]
            packed.append(_packed(words.take(pa.array(own - 1)), langs, [columns[0][a:b] - 1, *local, n[a:b]]))
        yield pa.record_batch([pa.array(route[edges[:-1]]), pa.array(packed, pa.binary())], names=["shard", "part"])


def _packed(words: pa.Array, langs: pa.Array, columns: list[np.ndarray]) -> bytes:
    """The phrases that a block has for a shard, as one compressed row of Arrow lists: words and languages once each, then their numbers."""
    lists = [words, langs, *(pa.array(c.astype(np.int32)) for c in columns)]
    names = ["words", "langs", "lang", "first", "second", "third", "n"]
    row = pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], names=names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=PACKED) as writer:
        writer.write_batch(row)
    return sink.getvalue().to_pybytes()


def _merged(least: int):
    """For one shard, the phrases with ``least`` occurrences; words of each language as a row without a phrase."""
    def merge(shard: pa.Table) -> pa.Table:
        rows = pa.concat_tables([pa.ipc.open_stream(part.as_buffer()).read_all() for part in shard["part"]])
        lists = {name: rows[name].combine_chunks() for name in rows.column_names}
        words, langs = (pc.list_flatten(lists[name]).dictionary_encode() for name in ("words", "langs"))
        row = pc.list_parent_indices(lists["n"]).to_numpy()

        def codes(names: str, column: str) -> np.ndarray:
            """Numbers of words (or languages) of this shard, from 1; 0 for none."""
            begin = np.cumsum([0, *pc.list_value_length(lists[names]).to_pylist()])[row]
            local = pc.list_flatten(lists[column]).to_numpy()
            known = (words if names == "words" else langs).indices.to_numpy().astype(np.int64)
            return np.where(local >= 0, known[np.minimum(begin + local, len(known) - 1)] + 1, 0)

        keys = [codes("langs", "lang"), *(codes("words", c) for c in ("first", "second", "third"))]
        weight = pc.list_flatten(lists["n"]).to_numpy().astype(np.int64)
        lang, only = keys[0], keys[2] == 0
        # Only whole phrases are equal here, so an ended phrase ends in a number of its own.
        ended = [keys[0], *(k + 1 for k in keys[1:])]
        at, f = equal_partitions(ended, weight, least)[-1]
        size = np.zeros(len(langs.dictionary) + 1, dtype=np.int64)
        np.add.at(size, lang[only], weight[only])
        some = np.flatnonzero(size)
        out = [langs.dictionary.take(pa.array(np.concatenate([lang[at], some]) - 1))]
        for key in keys[1:]:
            code = np.concatenate([key[at], np.zeros(len(some), dtype=np.int64)])
            out.append(words.dictionary.take(pa.array(code - 1, mask=code == 0)))
        return pa.table([*out, pa.array(np.concatenate([f, size[some]]))], names=["lang", "first", "second", "third", "f"])

    return merge


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, first, second, third, f``: all phrases of one to three words with ``least`` occurrences.

    ``second`` and ``third`` are null in shorter phrases; rows with ``first`` null add up to the words of
    a language. Each task sorts the suffixes of its texts (``BLOCK`` bytes at a time) and sends each phrase
    once, with its count, to the shard of its words; so a phrase of any frequency brings one row a block to
    the shard, and phrases that begin alike don't meet in one.
    """
    parts = shards(docs.sparkSession, SHARDS)
    routed = docs.select("lang", "text").mapInArrow(lambda batches: _phrases(batches, parts), "shard int, part binary")
    return routed.groupBy("shard").applyInArrow(_merged(least), COUNTED)


def _score(a: str, left: str, right: str) -> Column:
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"cast(1000000 as decimal(7,0)) * {wide(a)} * {wide(a)} div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    Each of ``SALTS`` parts of a language is put in order by itself; at most ``top`` phrases of each meet in
    one task. Counts, joins and scores are exact (decimals of 38 digits). A phrase is scored by its weakest cut, the
    earliest of equals; a pair with ``covered`` per cent of its occurrences in one longer candidate is dropped.

    Defined cases: a null text is empty; a null language is ``und``; a text or language without
    candidates gives no rows; ties go by phrase in UTF-8 order; repeated rows count again; an empty table
    gives no rows; other columns are ignored. A text may be of any length; what a task holds is some ten
    times the text of a block, and a text of more than ``BLOCK`` bytes is a block.
    """
    counts = stored(phrase_counts(docs, least), "phrases")
    n = counts.where("first is null").groupBy("lang").agg(F.sum("f").alias("n"))
    one = counts.where("first is not null and second is null").select("lang", F.col("first").alias("word"), "f")
    two = counts.where("second is not null and third is null").select("lang", "first", "second", F.col("f").alias("a"))
    three = counts.where("third is not null").withColumnRenamed("f", "a")

    def word(column: str, name: str) -> DataFrame:
        return one.select("lang", F.col("word").alias(column), F.col("f").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return two.select("lang", F.col("first").alias(first), F.col("second").alias(second), F.col("a").alias(name))

    parts = three.select("lang", "first", "second", "a").unionByName(three.select("lang", F.col("second").alias("first"), F.col("third").alias("second"), "a"))
    longer = parts.groupBy("lang", "first", "second").agg(F.max("a").alias("longer"))
    pairs = two.join(longer, ["lang", "first", "second"], "left").where(f"longer is null or 100 * longer < {covered} * a")
    pairs = pairs.join(word("first", "l"), ["lang", "first"]).join(word("second", "r"), ["lang", "second"])
    pairs = pairs.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    cut = three.join(word("first", "l1"), ["lang", "first"]).join(pair("second", "third", "r1"), ["lang", "second", "third"])
    cut = cut.join(pair("first", "second", "l2"), ["lang", "first", "second"]).join(word("third", "r2"), ["lang", "third"])
    cut = cut.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    triples = cut.select(
        "lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    within = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = pairs.unionByName(triples).withColumn("salt", salt).withColumn("rank", within).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
