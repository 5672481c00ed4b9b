"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import map_rows, mix

BITS = 18  # terms are hashed to 2 ** BITS columns
FACTORS = 8  # length of the vector of a term, whose products are the pairwise weights
SAMPLE_ROWS = 6000  # labelled documents, about, that the model is fitted on
SAMPLE_TERMS = 4_000_000  # terms of them, about: documents are fewer if they are longer
LEAST_DOCS = 4  # sampled documents that a term must be in to get a weight
EPOCHS, STEPS, BATCH, RATE = 20, 1500, 64, 0.1  # at least so many of either
SHRINK, SCORE = 5.0, 3.0  # penalty of a weight whose term's share differs by SCORE standard deviations between the labels
DECAY = 0.01  # penalty of the vectors
FOLD, FOLDS = 0, 5
BLOCK_BYTES = 1 << 20  # texts are taken apart together up to this size
_U64 = np.uint64
# Letters, digits and bytes of other scripts make terms; all else parts them.
_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_VALUE = mix(np.arange(1, 257, dtype=_U64) + _U64(1 << 60))


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) of all distinct terms of each text, in order of text; texts are in lower case."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    inside = np.zeros(len(raw) + 1, dtype=np.int8)
    inside[1:] = _TERM_BYTE[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    place = (np.arange(int(lengths.sum())) - np.repeat(first, lengths)).astype(_U64)
    letters = _VALUE[raw[inside[1:].astype(bool)]] * (mix(place) | _U64(1))
    column = (mix(np.add.reduceat(letters, first)) >> _U64(64 - BITS)).astype(np.int64)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts]))
    pair = np.unique(np.searchsorted(ends, starts, side="right") << BITS | column)
    return pair >> BITS, pair & ((1 << BITS) - 1)


class Machine:
    """score(x) = sigmoid(bias + sum of weights + sum over pairs of terms of the products of their vectors)."""

    def __init__(self, bias: float, weight: np.ndarray, vector: np.ndarray, used: np.ndarray | None = None):
        self.bias, self.weight, self.vector = bias, weight, vector
        self.used = np.zeros(len(weight), dtype=bool) if used is None else used  # columns whose numbers aren't zero

    def margin(self, text: np.ndarray, column: np.ndarray, texts: int) -> np.ndarray:
        """Pairs of a text's terms need no loop: half of the squared sum of its vectors less the sum of their squares."""
        text, column = text[self.used[column]], column[self.used[column]]
        total = self.bias + np.bincount(text, self.weight[column], texts)
        for f in range(self.vector.shape[1]):
            v = self.vector[column, f]
            total += 0.5 * (np.bincount(text, v, texts) ** 2 - np.bincount(text, v * v, texts))
        return total

    def score(self, texts: list[str]) -> list[float]:
        result, low = [], 0
        data = [t.lower().encode() for t in texts]
        while low < len(data):
            high, size = low, 0
            while high < len(data) and (high == low or size + len(data[high]) <= BLOCK_BYTES):
                size, high = size + len(data[high]), high + 1
            margin = self.margin(*terms(data[low:high]), high - low)
            result += (1 / (1 + np.exp(-np.clip(margin, -30, 30)))).tolist()
            low = high
        return result


def fit(rows: list[tuple[np.ndarray, int]], seed: int = 7) -> Machine:
    """Logistic loss by stochastic gradients in small batches.

    ``rows`` are (columns of the terms, label). Every column in ``LEAST_DOCS`` rows has a weight and a
    vector. While they are learned, the share of rows that have a term is taken off its input, 1 or 0;
    so pairs that tell are not hidden by terms that most texts have, and the parts of single terms are
    put into weights and bias in the end. Very many terms say nothing and would be learned by heart:
    weights have a step size for each (Adagrad) and are shrunk by the fourth power of the standard
    deviations by which the term's share differs between the labels, so that few rows or equal shares
    leave a small weight, not none. Vectors start small and random, with one step size for all, so that
    they grow in proportion to the rows that speak for a pair; ``DECAY`` is what that must exceed.
    Without rows, or with one label only, the model is its bias.
    """
    rng = np.random.default_rng(seed)
    weight, vector = np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS))
    share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
    bias = float(np.log(share / (1 - share)))
    machine = Machine(bias, weight, vector)
    if not 0 < sum(y for _, y in rows) < len(rows):
        return machine
    y = np.array([label for _, label in rows], dtype=float)
    clean, toxic = (np.bincount(np.concatenate([c for c, label in rows if label == k]), minlength=1 << BITS) for k in (0, 1))
    machine.used = clean + toxic >= LEAST_DOCS
    clean, toxic, columns = clean[machine.used], toxic[machine.used], int(machine.used.sum())
    number = np.cumsum(machine.used) - 1
    own = [number[c[machine.used[c]]] for c, _ in rows]
    common = (clean + toxic) / len(rows)
    spread = common * (1 - common) * (1 / (len(y) - y.sum()) + 1 / y.sum())
    square = (toxic / y.sum() - clean / (len(y) - y.sum())) ** 2 / np.maximum(spread, 1e-12)
    penalty = SHRINK * (SCORE**2 / np.maximum(square, 0.01)) ** 2 / len(rows)
    w, v = np.zeros(columns), rng.normal(0, 0.01, (columns, FACTORS))
    past_w, past_b = np.full(columns, 1e-6), 1e-6
    for _ in range(max(EPOCHS, -(-STEPS // -(-len(rows) // BATCH)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            text = np.repeat(np.arange(len(part)), [len(own[i]) for i in part])
            column = np.concatenate([own[i] for i in part])
            chosen, square = v[column], (v * v).sum(axis=1)
            summed = np.stack([np.bincount(text, chosen[:, f], len(part)) for f in range(FACTORS)], axis=1) - common @ v
            squares = np.bincount(text, ((1 - 2 * common) * square)[column], len(part)) + common**2 @ square
            margin = bias + np.bincount(text, w[column], len(part)) - common @ w + 0.5 * ((summed**2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]) / len(part)
            pulled = error[:, None] * summed
            errors = np.bincount(column, error[text], columns)
            grad_w = errors - common * error.sum()
            grad_v = np.stack([np.bincount(column, pulled[text, f], columns) for f in range(FACTORS)], axis=1)
            grad_v -= common[:, None] * pulled.sum(axis=0) + ((1 - 2 * common) * errors + common**2 * error.sum())[:, None] * v
            grad_v += DECAY * v
            past_w += grad_w**2
            past_b += error.sum() ** 2
            step = RATE / np.sqrt(past_w)
            w = (w - step * grad_w) / (1 + step * penalty)
            v -= RATE * grad_v / max(1.0, np.sqrt((grad_v**2).sum()))
            bias -= RATE * error.sum() / np.sqrt(past_b)
    mean, square = common @ v, (v * v).sum(axis=1)
    machine.bias = float(bias - common @ w + 0.5 * (mean @ mean - common**2 @ square))
    weight[machine.used], vector[machine.used] = w - v @ mean + common * square, v
    return machine


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels take no part in learning; a null id is never learned from and counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == FOLD, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits the machine on whole texts of about ``sample_rows`` labelled documents, half of either label
    if there are so many, chosen by a hash of the text. A document whose labels disagree isn't learned from.

    Texts are joined to their labels and taken apart into columns by Spark; the columns of the sample
    go to the driver, ``SAMPLE_TERMS`` of them at most in expectation.
    """
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("doc_id", "y")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").alias("chars")).where(~held_out(F.col("doc_id")) & F.col("chars").isNotNull())
    sizes = {r["y"]: (r["n"], r["chars"] or 0) for r in own.join(known, "doc_id").groupBy("y").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()}
    share = {y: min(1.0, sample_rows / 2 / n, SAMPLE_TERMS / 2 / max(1, chars / 10)) for y, (n, chars) in sizes.items()}
    hashed = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(hashed < F.when(F.col("y") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    texts = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def columns(blocks):
        for block in blocks:
            data = [t.as_py().lower().encode() for t in block["text"]]
            yield block["y"], pa.array([terms([d])[1].astype(np.int32) for d in data], pa.list_(pa.int32()))

    # The chosen ids are about ``sample_rows`` by their shares, and a quarter more of the held-out fold.
    sample = map_rows(texts.join(F.broadcast(chosen), "doc_id").select("y", "text"), columns, "y int, columns array<int>")
    rows = [(np.array(r["columns"], dtype=np.int64), r["y"]) for r in sample.collect()]
    machine = fit(sorted(rows, key=lambda r: (r[1], len(r[0]), r[0].tolist())))
    machine.bias -= float(np.log(share.get(1, 1.0) / share.get(0, 1.0)))  # the labels' own shares, not the sample's
    return machine


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Defined cases: a text that is null, empty or without terms gets the score of the bias alone; if
    nothing is labelled, all texts have score 0.5 at most; repeated rows are scored alike; a table
    without rows gives none; other columns of either table are ignored.
    """
    machine = learn(docs, labels, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.used, machine.weight[machine.used], machine.vector[machine.used]))

    def rows(blocks):
        bias, used, some_weight, some_vector = sent.value
        weight, vector = np.zeros(len(used)), np.zeros((len(used), FACTORS))
        weight[used], vector[used] = some_weight, some_vector
        own = Machine(bias, weight, vector, used)
        for block in blocks:
            score = own.score([t or "" for t in block["text"].to_pylist()])
            yield block["doc_id"], block["held"], score, [int(s >= 0.5) for s in score]

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text")
    return map_rows(chosen, rows, "doc_id long, held_out boolean, score double, predicted int")
