"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Each paragraph is hashed to a wide vector of 16-bit numbers, and a text's vector is the sum of its
paragraphs' vectors, kept modulo 2 ** 32 and named modulo 2 ** 16. So the order of paragraphs does not count, a paragraph is put in
by adding its vector and taken out by subtracting it, and parts of a text can be summed anywhere.
The first ``LANES`` numbers are those of an extendable hash: sums are equal for equal multisets, and
to find another multiset with the same sum is hard. The other ``SKETCH`` numbers say how alike two
multisets are: each run of five words in a paragraph adds one or takes one off in one of them, which
needs all 32 bits if a text repeats a run very often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import SHINGLE_WORDS, id_bounds, map_rows, mix, ordered_ranges, range_number, shingle_hashes, word_hashes

LANES, SKETCH = 1024, 512
ROWS_PER_RANGE = 20_000
LEAST = -(1 << 63)


def paragraphs(text: str) -> list[str]:
    """The lines of a text; an empty text has none, and empty lines are paragraphs."""
    return text.split("\n") if text else []


def _runs(parts: list[str]) -> np.ndarray:
    """Hashes of the runs of five words within each paragraph, or of all words of a shorter one."""
    data = "\n".join(parts).lower().encode()
    counts = np.array([len(line.split()) for line in data.split(b"\n")])
    words = word_hashes(data)
    begin = np.cumsum(counts) - counts
    found = [shingle_hashes(words[begin[i] : begin[i] + counts[i]]) for i in np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))]
    if len(words) >= SHINGLE_WORDS:
        paragraph = np.repeat(np.arange(len(counts)), counts)
        found.append(shingle_hashes(words)[paragraph[: 1 - SHINGLE_WORDS] == paragraph[SHINGLE_WORDS - 1 :]])
    return np.concatenate(found) if found else words


def vector(parts: Iterable[str]) -> np.ndarray:
    """The sum of the paragraphs' vectors."""
    total, parts = np.zeros(LANES + SKETCH, dtype=np.uint32), list(parts)
    for part in parts:
        total[:LANES] += np.frombuffer(hashlib.shake_128(part.encode()).digest(2 * LANES), dtype="<u2")
    hashed = mix(_runs(parts)) if parts else np.empty(0, np.uint64)
    lane = (hashed >> np.uint64(1)) % np.uint64(SKETCH)
    sign = np.where(hashed & np.uint64(1), 1.0, -1.0)
    total[LANES:] = np.bincount(lane.astype(np.int64), sign, SKETCH).astype(np.int64).astype(np.uint32)
    return total


def insert(total: np.ndarray, parts: Iterable[str]) -> np.ndarray:
    return total + vector(parts)


def delete(total: np.ndarray, parts: Iterable[str]) -> np.ndarray:
    return total - vector(parts)


def digest(total: np.ndarray) -> str:
    """The vector's name: equal for vectors that are equal modulo 2 ** 16."""
    return hashlib.sha256(total.astype("<u2").tobytes()).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """About the share of runs of five words that two texts have in common, 1 only for equal sketches.

    The expected product of two sketches is the number of common runs: twice that over the sum of
    both texts' own products, 0 if it is negative.
    """
    x, y = a[LANES:].astype(np.int32).astype(float), b[LANES:].astype(np.int32).astype(float)
    both = x @ x + y @ y
    return float(min(1.0, max(0.0, 2 * (x @ y) / both))) if both else float(np.array_equal(a, b))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_vector(total: np.ndarray, text: str, edited: str) -> np.ndarray:
    """The vector of the edited text from that of the text: paragraphs that both begin with stay as they are."""
    old, new = paragraphs(text), paragraphs(edited)
    same = 0
    while same < min(len(old), len(new)) and old[same] == new[same]:
        same += 1
    return insert(delete(total, old[same:]), new[same:])


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text, own``: ranges of ids in ascending order, each followed by the first row of the next one.

    That row, and the very first one after the last range, is sent to two ranges, ``own`` telling
    which is which. Ranges come from quantiles of the ids, so texts are shuffled once and no range is
    much larger than another. Rows with a null id come first; rows of one id are in order of text.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(LEAST))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = id_bounds(docs, key, ordered_ranges(docs.sparkSession, docs.count(), ROWS_PER_RANGE)) or [LEAST]
    number = range_number(key, bounds) - 1
    begins = F.when(key == bounds[0], len(bounds) - 1).when(range_number(key - 1, bounds) <= number, number - 1)
    place = F.struct(number.alias("range"), F.lit(True).alias("own"), F.lit(0).alias("late"))
    ahead = F.struct(begins.alias("range"), F.lit(False).alias("own"), F.when(key == bounds[0], 1).otherwise(0).alias("late"))
    sent = docs.withColumn("to", F.explode(F.when(begins.isNull(), F.array(place)).otherwise(F.array(place, ahead))))
    sent = sent.select("doc_id", "text", F.col("to.range").cast("int").alias("range"), "to.own", "to.late")
    ordered = sent.repartitionById(len(bounds), "range")
    return ordered.sortWithinPartitions("range", "late", key, "text").select("doc_id", "text", "range", "own")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text is ``edited_text`` of the row's text and the next row's, ascending by ``doc_id``;
    the first row comes after the last. ``near_edited`` and ``near_next`` are the likeness of the
    row's vector to the edited and to the next text's. The edited text's vector is made from the
    row's own by taking paragraphs out and putting others in.

    Defined cases: a null text is an empty one, whose vector is zero; the only row is its own next
    one; rows with a null ``doc_id`` come first; of rows that repeat an id, the lesser text comes
    first; an empty table gives no rows; other columns are ignored.
    """
    def rows(blocks):
        own = None  # the last row read, which waits for the one after it: (doc_id, text, vector, range)
        for block in blocks:
            out = []
            for doc_id, text, number, is_own in zip(*(block[k].to_pylist() for k in ("doc_id", "text", "range", "own"))):
                total = None
                if own is not None and own[3] == number:
                    total = vector(paragraphs(text))
                    changed = edited_text(own[1], text)
                    other = edited_vector(own[2], own[1], changed)
                    out.append((own[0], len(own[1]), hashlib.sha256(changed.encode()).hexdigest(), digest(own[2]), digest(other), likeness(own[2], other), likeness(own[2], total)))
                own = (doc_id, text, vector(paragraphs(text)) if total is None else total, number) if is_own else None
            if out:
                id_, *rest = map(list, zip(*out))
                yield pa.array(id_, pa.int64()), *rest

    return map_rows(
        in_order(docs), rows,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", block=256,
    )
