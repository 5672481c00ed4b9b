"""Substring dedup: runs of several consecutive sentences that occur before are removed."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import map_rows, mix, stored

SENTENCES = 3  # of a run at least
WORDS = 20  # of a run at least
PIECE = 8  # words: a longer sentence counts as several; see sentences()
KNOWN = 1 << 17  # words whose hashes are remembered
NO_ID = (1 << 63) - 1  # stands for a null id

# A sentence ends with its marks and closing quotes before white space, or with its line.
_SENTENCE = re.compile(r"[^\n]*?[.!?]+[\"'”’»)\]]*(?=\s|$)\s*|[^\n]+\n*|\n+", re.MULTILINE)
_U64 = np.uint64
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_BASE = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]  # odd, so that they have inverses modulo 2 ** 64
_END = [_U64(0xD6E8FEB86659FD93), _U64(0xA0761D6478BD642F)]  # what the last word of a piece adds
_COUNT = [_U64(0xE7037ED1A0B428DB), _U64(0x8EBC6AF09C88C6E3)]  # what each piece adds


class _Words(dict):
    """Numbers the words that it is asked for; ``table`` has three 64-bit hashes of each: order, high, low."""

    def __init__(self, size: int):
        self.table = np.zeros((size, 3), dtype=_U64)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.table[at] = np.frombuffer(hashlib.blake2b(word.encode(), digest_size=24).digest(), dtype="<u8")
        return at


_words = _Words(KNOWN)
_powers = np.ones((4, 1), dtype=_U64)  # of the two bases and their inverses


def _hashes(words: list[str]) -> np.ndarray:
    global _words
    if len(_words) + len(words) > len(_words.table):
        _words = _Words(max(KNOWN, len(words)))
    return _words.table[list(map(_words.__getitem__, words))]


def _power(n: int) -> np.ndarray:
    global _powers
    if n > _powers.shape[1]:
        factors = [*_BASE, *(pow(base, -1, 1 << 64) for base in _BASE)]
        _powers = np.ones((4, 2 * n), dtype=_U64)
        for row, factor in zip(_powers, factors):
            row[1:] = factor
            np.multiply.accumulate(row, out=row)
    return _powers


def _pieces(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges, words, hashes): piece i is ``text[edges[i]:edges[i + 1]]`` and has the words from words[i] to words[i + 1]."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    space = np.ones(len(codes) + 1, dtype=bool)
    space[1:] = _SPACE[np.minimum(codes, 0x3001)]
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    hashes, n = _hashes(text.lower().split()), len(starts)
    ends = np.array([m.end() for m in _SENTENCE.finditer(text)], dtype=np.int64)
    before = np.searchsorted(starts, ends)  # words up to the end of each sentence
    if len(ends):
        keep = np.append(np.diff(before) > 0, True)  # white space alone belongs to the sentence before
        ends, before = ends[keep], before[keep]
    order = hashes[:, 0] & ~_U64(PIECE - 1) | _U64(PIECE)
    order[before[before > 0] - 1] = 0
    cuts = np.zeros(n + 1, dtype=bool)
    windows = n - PIECE + 1
    if windows > 0:
        least = order[:windows].copy()
        for j in range(1, PIECE):
            np.minimum(least, order[j : j + windows] | _U64(j), out=least)
        cuts[np.arange(1, windows + 1) + (least & _U64(PIECE - 1)).astype(np.int64)] = True
    cuts[before] = False
    inner = np.flatnonzero(cuts)
    edges, words = np.concatenate([[0], ends, starts[inner]]), np.concatenate([[0], before, inner])
    at = np.argsort(edges, kind="stable")
    return edges[at], words[at], hashes


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of each sentence; together they are the whole text.

    Sentences end at full stops, exclamation and question marks before white space, and at line ends.
    Sentences of more than ``PIECE`` words are cut where their words say: of any ``PIECE`` words in a
    row, the text is cut behind the one with the least hash, the first of equals, where the last word of
    a sentence is less than all others. So a piece has ``PIECE`` words at most, and whether there is a
    cut behind a word depends on the ``PIECE - 1`` words on either side of it only, not on where the
    sentence or the text began. Of any 51 words that two texts share, wherever they lie in their
    sentences and as long as line ends agree, 7 at either end may be cut differently; a cut follows
    within 8 words, and from there a run of 27 words at most, which is found. White space belongs to the
    piece before it.
    """
    edges, words, _ = _pieces(text)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), np.diff(words).tolist()))


def runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, sentence behind the last, high 64 and low 32 bits of the hash) of the shortest run from each
    sentence that has ``SENTENCES`` sentences and ``WORDS`` words or more. Case and white space don't count.

    Hashes are polynomials in the hashes of the words, of which any run's are a difference of two sums.
    """
    edges, words, hashes = _pieces(text)
    first = np.arange(len(edges) - 1)
    end = np.maximum(first + SENTENCES, np.searchsorted(words, words[:-1] + WORDS))
    first, end = first[end < len(edges)], end[end < len(edges)]
    found, power = [], _power(len(hashes) + 1)
    for lane in (0, 1):
        value = hashes[:, lane + 1].copy()
        value[words[1:][np.diff(words) > 0] - 1] += _END[lane]
        total = np.zeros(len(hashes) + 1, dtype=_U64)
        np.cumsum(value * power[lane, : len(hashes)], out=total[1:])
        run = (total[words[end]] - total[words[first]]) * power[lane + 2][words[first]]
        found.append(mix(run + (end - first).astype(_U64) * _COUNT[lane]).view(np.int64))
    return first, end, found[0], found[1].astype(np.int32)


def _again(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Whether a hash is there before."""
    result = np.zeros(len(high), dtype=bool)
    if len(np.unique(high)) < len(high):
        seen = set()
        for i, digest in enumerate(zip(high.tolist(), low.tolist())):
            result[i] = digest in seen
            seen.add(digest)
    return result


def span_runs(docs: DataFrame) -> DataFrame:
    """``high, low`` (hash of a run), ``doc_id``, ``first`` (its first sentence) and ``again`` for every run of
    every row. ``again`` tells that the run occurs before in the same row, so no other row need be asked."""
    def rows(blocks):
        for block in blocks:
            parts = []
            for doc_id, text in zip(block["doc_id"].to_pylist(), block["text"].to_pylist()):
                first, _, high, low = runs(text or "")
                parts.append((high, low, np.full(len(first), doc_id), first, _again(high, low)))
            high, low, ids, first, again = map(np.concatenate, zip(*parts))
            if len(ids):
                yield high, low, ids, first.astype(np.int32), again

    return map_rows(_rows(docs), rows, "high long, low int, doc_id long, first int, again boolean", block=256)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` (first sentence and second half of the hash) of runs that occur before.

    The first occurrence of a run is the one in the smallest (doc_id, place). Runs are shuffled once, by
    their hash; each document brings a run once, however often it repeats it, so what meets in one task
    for a run is a row for each document that has it.
    """
    every = stored(span_runs(docs), "runs")
    place = F.struct("doc_id", "first")
    found = every.where("not again").withColumn("origin", F.min(place).over(Window.partitionBy("high", "low")))
    later = found.where(place != F.col("origin")).select("doc_id", "first", "low")
    later = later.unionByName(every.where("again").select("doc_id", "first", "low"))
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("first", "low")).alias("spans"))


def remove(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the sentences of ``spans``, and the removed places."""
    pieces = sentences(text)
    covered = [False] * len(pieces)
    for first, last in spans:
        covered[first:last] = [True] * (last - first)
    places: list[tuple[int, int]] = []
    for (a, b, _), gone in zip(pieces, covered):
        if gone:
            if places and places[-1][1] == a:
                places[-1] = (places[-1][0], b)
            else:
                places.append((a, b))
    left, at = [], 0
    for a, b in places:
        left.append(text[at:a])
        at = b
    return "".join(left) + text[at:], places


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_removed, removed`` for every row of ``docs``.

    Every run of consecutive sentences (three or more, with 20 words or more) is hashed and looked up
    in all documents; sentences in any run that occurs before are removed. ``text`` is what is left,
    ``removed`` has the places (start, end, in code points) and ``n_removed`` their code points. A
    document without such a run keeps its text unchanged.

    Defined cases: a null text stays null; rows that repeat an id are one document, so that a run at
    the same place in them occurs once; rows without an id are one document too, the last; of runs
    within one document the first stays; a table without rows gives none; other columns are ignored.
    """
    def cut(blocks):
        for block in blocks:
            texts, counts, places = [], [], []
            for text, spans in zip(block["text"].to_pylist(), block["spans"].to_pylist()):
                found = []
                if spans and text:
                    asked = {(s["first"], s["low"]) for s in spans}
                    own = zip(*(x.tolist() for x in runs(text)))
                    text, found = remove(text, [(a, b) for a, b, _, low in own if (a, low) in asked])
                texts.append(text)
                counts.append(sum(b - a for a, b in found))
                places.append([{"start": a, "end": b} for a, b in found])
            ids = [None if x == NO_ID else x for x in block["doc_id"].to_pylist()]
            yield ids, texts, counts, places

    joined = _rows(docs).join(repeated_spans(docs), "doc_id", "left").select("doc_id", "text", "spans")
    return map_rows(joined, cut, "doc_id long, text string, n_removed long, removed array<struct<start int, end int>>", block=256)
