"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import map_rows

ORDER = 3  # bytes of the longest context
SAMPLE_DOCS = 400  # different texts of a language that the model is fitted on
FOLD, FOLDS = 1, 3
BLOCK_BYTES = 1 << 20  # texts are scored together up to this size
_U64 = np.uint64


class Model:
    """Frozen context trees of all languages, and the code length that each gives to any byte in any context.

    For each language a tree holds, for every context of at most ``ORDER`` bytes seen in its sample,
    how often each byte followed. A byte is coded in the longest context seen: with n of T counts and
    q distinct bytes it gets n / (T + q), and an escape to the context without its first byte gets
    q / (T + q) (method C). After an escape, bytes that the longer context has seen are excluded.
    Below the empty context the bytes not seen at all are equally likely.

    A gram is a context with the byte behind it, a number that starts with a one bit. ``costs[k]``
    has the bits of every gram of k + 1 bytes that some language has seen, one row for each language.
    """

    def __init__(self, languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.languages, self.order = languages, order
        trees = [_Tree(*counts[x], order) for x in languages]
        self.grams, self.costs = [], []
        for k in range(order + 1):
            grams = np.unique(np.concatenate([t.grams[k] for t in trees])) if trees else np.empty(0, _U64)
            self.grams.append(grams)
            self.costs.append(np.array([t.cost(grams, k) for t in trees], dtype=np.float32).reshape(len(trees), len(grams)))
        self.trees = trees
        self._hash()

    def _hash(self) -> None:
        """For the longest grams, a table from a hash to the place of one gram with it."""
        top = self.grams[self.order]
        self.bits = max(8, int(16 * max(1, len(top))).bit_length())
        self.slot = np.zeros(1 << self.bits, dtype=np.int32)
        self.slot[self._hashed(top)] = np.arange(len(top), dtype=np.int32)

    def _hashed(self, grams: np.ndarray) -> np.ndarray:
        return (grams * _U64(0x9E3779B97F4A7C15)) >> _U64(64 - self.bits)

    def bits_of(self, texts: list[bytes]) -> np.ndarray:
        """The code length of each text in each language, in bits: a row per text."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(_U64)
        begin, n = np.cumsum(size) - size, len(raw)
        gram = np.ones(n, dtype=_U64)  # begins at its place
        for k in range(min(self.order + 1, n)):
            gram = (gram[: n - k] << _U64(8)) | raw[k:]
            if k < self.order:  # the first bytes of a text have shorter contexts
                here = np.flatnonzero(size > k)
                for j, tree in enumerate(self.trees):
                    total[here, j] += tree.cost(gram[begin[here]], k)
        if n <= self.order:
            return total
        text = np.repeat(np.arange(len(texts)), size)[: len(gram)]
        inside = np.arange(len(gram)) + self.order < (begin + size)[text]
        gram, text = gram[inside], text[inside]
        top = self.grams[self.order]
        if len(top):
            place = self.slot[self._hashed(gram)]
            known = top[place] == gram
            for j in range(len(self.trees)):
                total[:, j] += np.bincount(text[known], self.costs[self.order][j][place[known]], len(texts))
            gram, text = gram[~known], text[~known]
        if len(gram):  # grams that share a hash, and those that no language has seen
            unique, at = np.unique(gram, return_inverse=True)
            for j, tree in enumerate(self.trees):
                total[:, j] += np.bincount(text, tree.cost(unique, self.order)[at], len(texts))
        return total

    def predict(self, texts: list[bytes]) -> list[tuple[str, float, float]]:
        """For each text the language with the shortest code (the first by name of equal ones), its
        probability given the text, and the bits for each byte."""
        result, low = [], 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= BLOCK_BYTES):
                size, high = size + len(texts[high]), high + 1
            bits = self.bits_of(texts[low:high])
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(best)), best]
            score = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
            result += [(self.languages[b], s, n / len(t)) for b, s, n, t in zip(best.tolist(), score.tolist(), least.tolist(), texts[low:high])]
            low = high
        return result


class _Tree:
    """One language's context tree as sorted arrays, for each length of context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        self.grams, self.counts, self.contexts = [], [], []
        size = np.array([(int(g).bit_length() - 1) // 8 for g in grams.tolist()], dtype=np.int64)
        for k in range(order + 1):
            own = np.argsort(grams[size == k + 1])
            self.grams.append(grams[size == k + 1][own])
            self.counts.append(counts[size == k + 1][own].astype(np.float64))
            self.contexts.append(np.unique(self.grams[k] >> _U64(8)))
        self.total, self.distinct, self.seen_total, self.seen_distinct = [], [], [], []
        for k in range(order + 1):
            at = np.searchsorted(self.contexts[k], self.grams[k] >> _U64(8))
            self.total.append(np.bincount(at, self.counts[k], len(self.contexts[k])))
            self.distinct.append(np.bincount(at, minlength=len(self.contexts[k])).astype(np.float64))
            # Of the context one byte shorter: the counts of the bytes that this one has seen, which an escape excludes.
            shorter = self._shorter(self.grams[k], k + 1) if k else None
            if k:
                j = np.minimum(np.searchsorted(self.grams[k - 1], shorter), max(0, len(self.grams[k - 1]) - 1))
                there = self.grams[k - 1][j] == shorter
                self.seen_total.append(np.bincount(at, self.counts[k - 1][j] * there, len(self.contexts[k])))
                self.seen_distinct.append(np.bincount(at, there, len(self.contexts[k])))
            else:
                self.seen_total.append(None)
                self.seen_distinct.append(None)

    @staticmethod
    def _shorter(number: np.ndarray, size: int) -> np.ndarray:
        """A number of ``size`` bytes without its first byte."""
        low = _U64(8 * (size - 1))
        return (number & ((_U64(1) << low) - _U64(1))) | (_U64(1) << low)

    def cost(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Bits of the last byte of each gram in its context of ``k`` bytes."""
        bits = np.zeros(len(grams))
        open_, gram = np.arange(len(grams)), grams
        less_total, less_distinct = np.zeros(len(grams)), np.zeros(len(grams))
        for k in range(k, -1, -1):
            if not len(open_):
                return bits
            context = gram >> _U64(8)
            c, seen = _find(self.contexts[k], context)
            g, hit = _find(self.grams[k], gram)
            total = np.where(seen, self.total[k][c] if len(self.total[k]) else 0, 0) - less_total
            distinct = np.where(seen, self.distinct[k][c] if len(self.distinct[k]) else 0, 0) - less_distinct
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = np.log2(total + distinct) - np.log2(self.counts[k][g] if len(self.counts[k]) else 1)
                escape = np.where(distinct > 0, np.log2(total + distinct) - np.log2(distinct), 0)
            bits[open_] += np.where(hit, coded, np.where(seen, escape, 0))
            if k:
                less_total = np.where(seen, self.seen_total[k][c] if len(self.contexts[k]) else 0, 0)[~hit]
                less_distinct = np.where(seen, self.seen_distinct[k][c] if len(self.contexts[k]) else 0, 0)[~hit]
                gram = self._shorter(gram, k + 1)[~hit]
            open_ = open_[~hit]
        bits[open_] += np.log2(max(1, 256 - (self.distinct[0][0] if len(self.distinct[0]) else 0)))
        return bits


def _find(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def count_grams(texts: Iterable[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All grams of 1 to ``order`` + 1 bytes of the texts, and how often each occurs."""
    grams, counts = np.empty(0, _U64), np.empty(0, np.int64)
    for data in texts:
        raw = np.frombuffer(data, dtype=np.uint8).astype(_U64)
        parts = []
        gram = np.full(len(raw), 1, dtype=_U64)
        for k in range(min(order + 1, len(raw))):
            gram = (gram[: len(raw) - k] << _U64(8)) | raw[k:]
            parts.append(gram)
        if parts:
            grams, counts = _summed(np.concatenate([grams, *parts]), np.concatenate([counts, np.ones(sum(map(len, parts)), np.int64)]))
    return grams, counts


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(grams, return_inverse=True)
    return unique, np.bincount(place, counts, len(unique)).astype(np.int64)


def held_out(doc_id: Column, fold: int = FOLD, folds: int = FOLDS) -> Column:
    """Whether a document takes no part in learning; a null id is never learned from and counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, order: int = ORDER) -> Model:
    """Fits the model on ``sample_docs`` different whole texts of each language, the first by a hash of the text.

    Texts with a null or no letter, a null ``lang`` or in the held-out fold aren't learned from. A text that
    has copies counts once, so a language of few texts with many copies is learned from all of them, and the
    sample is bounded whatever repeats. The hashes of all documents are compared first; only texts that they
    name are read as texts. Grams are counted where the texts are and summed up by Spark; the model, whose
    size is bounded by the sample, goes to the driver and to each task.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    first = usable.select("lang", "h").distinct().withColumn("place", place).where(F.col("place") <= sample_docs).drop("place")
    sample = usable.join(F.broadcast(first), ["lang", "h"], "left_semi")  # one row per language and sampled text
    sample = sample.groupBy("lang", "h").agg(F.min("text").alias("text"))

    def grams(blocks):
        for block in blocks:
            names = block["lang"].to_pylist()
            for lang in sorted(set(names)):
                found, n = count_grams((t.as_py().encode() for t, x in zip(block["text"], names) if x == lang), order)
                yield [lang] * len(found), found.view(np.int64), n

    counted = map_rows(sample, grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    frame = counted.toPandas()  # no rows where there is nothing to learn from
    counts = {x: (own["gram"].to_numpy(np.int64).view(_U64), own["n"].to_numpy(np.int64)) for x, own in frame.groupby("lang")}
    return Model(sorted(counts), counts, order)


def identified(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte`` for every row of ``docs``.

    ``score`` is the probability of the language given the text, all languages being equally likely
    before. Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every
    text if there is nothing to learn from; equal code lengths go to the first language by name;
    repeated rows are judged alike; a table without rows gives none; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, sample_docs))

    def rows(blocks):
        own = model.value
        for block in blocks:
            spoken = [letter and bool(own.languages) for letter in block["letter"].to_pylist()]
            told = iter(own.predict([t.as_py().encode() for t, yes in zip(block["text"], spoken) if yes]))
            found = [next(told) if yes else ("und", 0.0, None) for yes in spoken]
            yield block["doc_id"], block["held"], *map(list, zip(*found))

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"),
    )
    return map_rows(chosen, rows, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def accepted(docs: DataFrame, least: float = 0.5, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is known: any but ``und`` with score ``least`` or more.

    Where there is nothing to learn from, all rows with a letter are accepted.
    """
    learned = learn(docs, sample_docs)
    model = docs.sparkSession.sparkContext.broadcast(learned)
    spoken = docs.where(F.col("text").rlike(r"\p{L}"))
    if not learned.languages:
        return spoken
    columns = docs.columns

    def rows(blocks):
        for block in blocks:
            sure = [score >= least for _, score, _ in model.value.predict([t.as_py().encode() for t in block["text"]])]
            yield [block[c].filter(pa.array(sure)) for c in columns]

    return map_rows(spoken, rows, docs.schema)
