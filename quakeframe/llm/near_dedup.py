"""Near duplicates: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard similarity."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quakeframe.llm.common import map_rows, mix, shingle_hashes, stored, unused, word_hashes
from quakeframe.llm.components import components

SIMILARITY = 0.8
BANDS, ROWS = 16, 4  # two texts of similarity 0.8 share a band with probability 0.9998
SAMPLES = BANDS * ROWS
FREQUENT = 0.01  # a shingle in a smaller share of the documents weighs as if it were in this share
CHUNK_SHINGLES = 2 << 20  # shingles of one local count
CANDIDATES = 2 << 20  # candidate shingles that are counted in one pass over the documents
CENTRES = 2  # members of each bucket that all others are compared with at first
LIKELY = 50  # equal samples, of 64, for a pair to be tried first
POSSIBLE = 40  # and to be tried at all: a pair of similarity 0.8 has fewer with probability 0.0003, about what the bands lose
BLOCK = 256  # members of a bucket that are compared in one piece
BLOCK_BYTES = 2 << 20  # and bytes of their texts, about
DRAWS = 1 << 16  # prepared draws of (r, c, beta)
_U64, _F64 = np.uint64, np.float64


def canonical(text: str | None) -> bytes:
    """The words of a text in lower case, one space between them."""
    return b" ".join((text or "").lower().encode().split())


# ---------------------------------------------------------------------------- document frequencies


def frequent_shingles(docs: DataFrame) -> tuple[int, dict[int, float]]:
    """Number of documents, and the share of documents for each shingle that at least ``FREQUENT`` of them have.

    Counts cover all documents and are exact. The documents are cut into chunks; a shingle that
    reaches the share in total reaches it in some chunk, so each chunk names those that do, and a
    second pass counts the named ones in all documents. No more than (shingles per document) /
    ``FREQUENT`` shingles can qualify, however many documents there are, so the result is small
    enough to send to every task. Named shingles are counted in blocks, one pass for each block.
    """
    def named(blocks):
        parts, docs_here, size = [], 0, 0

        def emit():
            unique, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, _U64), np.empty(0))
            return unique[n >= FREQUENT * docs_here].view(np.int64), pa.array([docs_here] + [0] * int((n >= FREQUENT * docs_here).sum()))

        for block in blocks:
            for text in block["text"]:
                own = np.unique(shingle_hashes(word_hashes(canonical(text.as_py()))))
                parts.append(own)
                docs_here, size = docs_here + 1, size + len(own)
                if size >= CHUNK_SHINGLES:
                    found, n = emit()
                    yield pa.array([None, *found.tolist()], pa.int64()), n
                    parts, docs_here, size = [], 0, 0
        if docs_here:
            found, n = emit()
            yield pa.array([None, *found.tolist()], pa.int64()), n

    texts = docs.select("text")
    found = stored(map_rows(texts, named, "shingle long, docs long").groupBy("shingle").agg(F.sum("docs").alias("docs")), "shingles")
    total = found.where("shingle is null").agg(F.sum("docs")).first()[0] or 0
    candidates = found.where("shingle is not null").select("shingle")
    shares: dict[int, float] = {}
    passes = -(-candidates.count() // CANDIDATES)
    for i in range(passes):
        block = candidates.where(F.pmod(F.xxhash64("shingle"), F.lit(passes)) == i)
        asked = np.sort(np.array([r[0] for r in block.toLocalIterator()], dtype=np.int64).view(_U64))
        sent = docs.sparkSession.sparkContext.broadcast(asked)

        def counted(blocks):
            own = sent.value
            n = np.zeros(len(own), dtype=np.int64)
            for block in blocks:
                for text in block["text"]:
                    have = np.unique(shingle_hashes(word_hashes(canonical(text.as_py()))))
                    at = np.minimum(np.searchsorted(own, have), len(own) - 1)
                    n[at[own[at] == have]] += 1
            yield own[n > 0].view(np.int64), n[n > 0]

        counts = map_rows(texts, counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        shares |= {r["shingle"] & ((1 << 64) - 1): r["n"] / total for r in counts.where(F.col("n") >= FREQUENT * total).collect()}
        sent.unpersist()
    return total, shares


class Weights:
    """Weighted shingles of a text: how often a shingle occurs times 1 + ln(1 / share of documents)."""

    def __init__(self, shares: dict[int, float]):
        self.common = np.array(sorted(shares), dtype=_U64)
        self.idf = np.array([1 + math.log(1 / shares[s]) for s in sorted(shares)], dtype=_F64)
        self.rare = 1 + math.log(1 / FREQUENT)

    def of(self, words: bytes) -> tuple[np.ndarray, np.ndarray]:
        shingles, n = np.unique(shingle_hashes(word_hashes(words)), return_counts=True)
        idf = np.full(len(shingles), self.rare)
        if len(self.common) and len(shingles):
            at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
            hit = self.common[at] == shingles
            idf[hit] = self.idf[at[hit]]
        return shingles, n * idf


def similarity(a: tuple, b: tuple) -> float:
    """Sum of the smaller weights over sum of the greater weights; 1 for two texts without words."""
    total = a[1].sum() + b[1].sum()
    if not total:
        return 1.0
    if not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    hit = b[0][at] == a[0]
    shared = np.minimum(a[1][hit], b[1][at[hit]]).sum()
    return float(shared / (total - shared))


# ---------------------------------------------------------------------------- consistent weighted samples


class Sampler:
    """Improved consistent weighted sampling.

    Sample k draws r and c from Gamma(2, 1) and beta from [0, 1) for each shingle, by hash. With weight
    S, t = floor(ln S / r + beta), and the shingle with the least ln a = ln c - r (t - beta + 1) is
    taken. Two texts take the same (shingle, t) with the probability of their weighted Jaccard
    similarity. The draws come from a table of ``DRAWS`` triples, by sixteen bits of a hash of shingle
    and k; equal values of different shingles are ordered by further bits of the hash. The value and
    these bits name the sample.
    """

    def __init__(self, rare: float):
        u = (mix(np.arange(5 * DRAWS, dtype=_U64) + _U64(1 << 50)) >> _U64(11)).astype(_F64).reshape(5, DRAWS) / float(1 << 53) + 1e-18
        self.r, self.c, self.beta = -np.log(u[0] * u[1]), -np.log(u[2] * u[3]), u[4]
        self.rare = rare
        self.value = self._ordered(self._ln_a(math.log(rare), np.arange(DRAWS)))
        self.seeds = mix(np.arange(SAMPLES, dtype=_U64) + _U64(1 << 52))

    def _ln_a(self, ln_weight, draw: np.ndarray) -> np.ndarray:
        r, beta = self.r[draw], self.beta[draw]
        return np.log(self.c[draw]) - r * (np.floor(ln_weight / r + beta) - beta + 1)

    @staticmethod
    def _ordered(values: np.ndarray) -> np.ndarray:
        """32-bit floats as the upper half of numbers in the same order."""
        raw = values.astype(np.float32).view(np.uint32)
        raw = np.where(raw >> np.uint32(31), ~raw, raw | np.uint32(1 << 31))
        return raw.astype(_U64) << _U64(32)

    def sample(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The ``SAMPLES`` samples of a text, 0 if it has no words."""
        best = np.full(SAMPLES, ~_U64(0))
        for low in range(0, len(shingles), 4096):
            s, w = shingles[low : low + 4096], weights[low : low + 4096]
            h = (s[:, None] ^ self.seeds) * _U64(0x9E3779B97F4A7C15)
            h ^= h >> _U64(32)
            h *= _U64(0xD6E8FEB86659FD93)
            draw = (h >> _U64(48)).astype(np.int64)
            value = self.value[draw]
            other = np.flatnonzero(w != self.rare)
            if len(other):
                value[other] = self._ordered(self._ln_a(np.log(w[other])[:, None], draw[other]))
            value |= h & _U64(0xFFFFFFFF)
            best = np.minimum(best, value.min(axis=0))
        return best if len(shingles) else np.zeros(SAMPLES, dtype=_U64)


# ---------------------------------------------------------------------------- candidates and links


def copy_key(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def signatures(docs: DataFrame, shares: dict[int, float]) -> DataFrame:
    """``doc_id, node`` (hash of the words), ``bands`` (a hash each) and ``samples`` (16 bits each, in bytes).

    A text without words has no bands and no samples.
    """
    sent = docs.sparkSession.sparkContext.broadcast(shares)

    def rows(blocks):
        weights = Weights(sent.value)
        sampler = Sampler(weights.rare)
        order = np.arange(1, ROWS + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15) | _U64(1)
        for block in blocks:
            node, bands, samples = [], [], []
            for text in block["text"]:
                words = canonical(text.as_py())
                own = mix(sampler.sample(*weights.of(words)))
                node.append(copy_key(words))
                bands.append(mix((own.reshape(BANDS, ROWS) * order).sum(axis=1)).view(np.int64).tolist() if words else [])
                samples.append(own.astype(np.uint16).tobytes() if words else None)
            yield block["doc_id"], node, bands, samples

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(chosen, rows, "doc_id long, node binary, bands array<long>, samples binary", block=256)


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).sum(axis=-1)


def verified(pairs: DataFrame, texts: DataFrame, shares: dict[int, float], least: float) -> DataFrame:
    """Of ``pairs`` (a, b), those whose texts' weighted Jaccard similarity is ``least`` or more, with it."""
    sent = texts.sparkSession.sparkContext.broadcast(shares)

    def rows(blocks):
        weights, kept = Weights(sent.value), {}

        def of(node, text):
            if node not in kept:
                if len(kept) >= 32:
                    kept.pop(next(iter(kept)))
                kept[node] = weights.of(canonical(text.as_py()))
            return kept[node]

        for block in blocks:
            found = []
            for a, b, text_a, text_b in zip(block["a"].to_pylist(), block["b"].to_pylist(), block["text_a"], block["text_b"]):
                value = similarity(of(a, text_a), of(b, text_b))
                if value >= least:
                    found.append((a, b, value))
            if found:
                yield list(map(list, zip(*found)))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return map_rows(joined, rows, "a binary, b binary, similarity double", block=256)


def _members(distinct: DataFrame) -> DataFrame:
    """``bucket, band, node, samples`` for every bucket (a band and a hash) with two different texts or more."""
    rows = distinct.select("node", F.posexplode("bands").alias("band", "hash"))
    rows = rows.select(F.xxhash64("band", "hash").alias("bucket"), "band", "node")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return rows.join(shared, "bucket").join(distinct.select("node", "samples"), "node").select("bucket", "band", "node", "samples")


def _first_pairs(members: DataFrame) -> DataFrame:
    """For each text, of the centres of its buckets those that agree most with it, if enough."""
    def agreeing(blocks):
        for block in blocks:
            x, y = (np.frombuffer(b"".join(block[k].to_pylist()), dtype=np.uint16).reshape(-1, SAMPLES) for k in ("samples", "centre_samples"))
            equal = _agreement(x, y)
            likely = pa.array(equal >= LIKELY)
            yield *(block[k].filter(likely) for k in ("seed", "node", "centre")), equal[equal >= LIKELY]

    chosen = [F.min_by(F.struct("node", "samples"), F.xxhash64(F.lit(i), "node")) for i in range(CENTRES)]
    centres = members.groupBy("bucket").agg(F.array(*chosen).alias("all")).select("bucket", F.posexplode("all").alias("seed", "c"))
    joined = members.join(centres, "bucket").where("node <> c.node").select(
        "seed", "node", F.col("c.node").alias("centre"), "samples", F.col("c.samples").alias("centre_samples"),
    )
    likely = map_rows(joined, agreeing, "seed int, node binary, centre binary, equal int", block=4096)
    best = likely.groupBy("seed", "node").agg(F.max(F.struct("equal", "centre")).alias("best"))
    return best.select(F.least("node", "best.centre").alias("a"), F.greatest("node", "best.centre").alias("b")).distinct()


def _compared(row: dict, weights: Weights, least: float) -> list[tuple]:
    """Links between classes that hold for the members of two blocks, as few as join the same classes.

    Pairs that agree most are verified first; once a link joins two classes, no more pairs of these
    are. A pair counts in the first band that its texts share.
    """
    left, right, same = row["left"], row["right"], row["same"]
    x, y = (np.frombuffer(b"".join(m["samples"] for m in side), dtype=np.uint16).reshape(-1, SAMPLES) for side in (left, right))
    names: dict[bytes, int] = {}
    g, h = (np.array([names.setdefault(m["g"], len(names)) for m in side]) for side in (left, right))
    pairs = []
    for i in range(len(x)):
        equal = _agreement(x[i], y)
        fits = np.flatnonzero((equal >= POSSIBLE) & (h != g[i]))
        fits = fits[fits > i] if same else fits
        if len(fits):
            first = (x[i] == y[fits]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            fits = fits[first == row["band"]]
            pairs.append(np.stack([equal[fits], np.full(len(fits), i), fits]))
    if not pairs:
        return []
    order = np.concatenate(pairs, axis=1)
    order = order[:, np.lexsort((order[2], order[1], -order[0]))]
    parent, kept, found = list(range(len(names))), {}, []

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def of(side, i, member):
        if (side, i) not in kept:
            kept[side, i] = weights.of(canonical(member["text"]))
        return kept[side, i]

    for _, i, j in order.T.tolist():
        if root(g[i]) != root(h[j]):
            value = similarity(of(0, i, left[i]), of(0 if same else 1, j, right[j]))
            if value >= least:
                parent[root(g[i])] = root(h[j])
                found.append((*sorted((left[i]["node"], right[j]["node"])), value))
    return found


def _remaining_links(members: DataFrame, groups: DataFrame, texts: DataFrame, shares: dict[int, float], least: float) -> DataFrame:
    """The links that join classes which the first links have left apart.

    Buckets whose members are in one class already are left out. The others are cut into blocks of
    about ``BLOCK`` members (fewer long ones), and every two blocks of a bucket meet in one row, so
    that neither a bucket nor its pairs become rows of a task. All pairs of different classes whose
    samples do not rule the similarity out are verified there, on the whole texts.
    """
    sent = texts.sparkSession.sparkContext.broadcast(shares)

    def compared(blocks):
        weights = Weights(sent.value)
        for block in blocks:
            for band, same, left, right in zip(*(block[k] for k in ("band", "same", "left", "right"))):
                row = {"band": band.as_py(), "same": same.as_py(), "left": left.as_py(), "right": right.as_py()}
                found = _compared(row, weights, least)
                if found:
                    yield list(map(list, zip(*found)))

    roots = groups.select(F.col("node").alias("n"), "component")
    known = members.join(roots, members["node"] == roots["n"], "left").drop("n")
    known = stored(known.withColumn("g", F.coalesce("component", "node")).drop("component"), "members")
    mixed = known.groupBy("bucket").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("bucket")
    known = stored(known.join(mixed, "bucket").join(texts, "node"), "mixed")
    sizes = known.groupBy("bucket").agg(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES).alias("size"))
    known = known.join(sizes.select("bucket", F.ceil("size").cast("int").alias("blocks")), "bucket")
    known = known.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    known = known.groupBy("bucket", "band", "blocks", "block").agg(F.collect_list(F.struct("node", "g", "samples", "text")).alias("rows"))
    left = known.select("bucket", "band", "block", F.col("rows").alias("left"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"))
    right = known.select("bucket", F.col("block").alias("other"), F.col("rows").alias("right"))
    joined = left.join(right, ["bucket", "other"]).select("band", (F.col("block") == F.col("other")).alias("same"), "left", "right")
    return map_rows(joined, compared, "a binary, b binary, similarity double", block=16)


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, class_id, class_size, kept`` for every row; see ``near_duplicates``."""
    _, shares = frequent_shingles(docs)
    signed = stored(signatures(docs, shares).withColumn("row", F.monotonically_increasing_id()), "signatures")
    distinct = signed.where("samples is not null").groupBy("node").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    members = stored(_members(distinct), "members")

    def keyed(blocks):
        for block in blocks:
            yield [copy_key(canonical(t.as_py())) for t in block["text"]], block["text"]

    wanted = members.select("node").distinct()
    texts = map_rows(docs.select("text"), keyed, "node binary, text string").join(wanted, "node")
    texts = stored(texts.groupBy("node").agg(F.min("text").alias("text")), "texts")
    links = stored(verified(_first_pairs(members), texts, shares, least), "links")
    groups = components(links, "classes")
    rest = stored(_remaining_links(members, groups, texts, shares, least), "links")
    if rest.limit(1).count():
        groups = components(links.unionByName(rest), "classes")
    rows = signed.select("doc_id", "node", "row").join(groups, "node", "left")
    rows = stored(rows.withColumn("class", F.coalesce("component", "node")).drop("component"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node", "row")
    of_class = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(order).alias("first"))
    return rows.join(of_class, "class").select(
        "doc_id", "node", "class_id", "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row of ``docs``.

    A class is a connected component of texts of weighted Jaccard similarity ``least`` or more over
    runs of five words in lower case; ``class_id`` is its smallest ``doc_id``, and that row is kept.
    Texts with the same words are copies: one stands for all. Any two different texts that share a
    bucket count. Each is first compared with centres of its buckets; then only pairs in different
    classes are left, and all of them are verified, so that a large group of copies of one text does
    not make all its pairs, yet no link between classes is lost.

    Defined cases: texts without words (null ones too) are copies of each other; a text of fewer
    than five words is one shingle; a null ``doc_id`` comes after all others and names a class only
    if it has no other; of rows that repeat an id one is kept, the first by its words; a table
    without rows gives none; other columns are ignored.
    """
    return classes(docs, least).drop("node")


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class, with its columns."""
    def keyed(blocks):
        for block in blocks:
            yield *(block[c] for c in columns), [copy_key(canonical(t.as_py())) for t in block["text"]]

    columns, own = docs.columns, unused(docs, "_node")
    d = map_rows(docs, keyed, StructType([*docs.schema, StructField(own, BinaryType())])).alias("d")
    k = classes(docs, least).where("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_key")).alias("k")
    joined = d.join(k, F.expr(f"d.{own} = k._key and d.doc_id <=> k._id"), "left_semi")
    return joined.dropDuplicates(["doc_id", own]).select(*columns)
