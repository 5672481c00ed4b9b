"""Mixing sources to target weights by subset sums over exact document lengths."""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import mix as mixed_bits
from quakeframe.llm.common import stored, unused

WEIGHTS = (5, 2, 1)  # by the source's place in code point order, repeating
MOST_PASSES = 3  # a document is taken so many times at most
SEED = 17
KNAPSACK = 1 << 14  # words, about, that are left to the knapsack
CELLS = 256  # ranges of the seeded hash; only one range per source and length is put in order


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> dict:
    """Words to take from each source. All sizes together are shared by weight; a source whose share
    exceeds ``most`` times its size stops there, and what is over is shared by weight among the rest."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, result = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] > most * sizes[s]}
        if not full:
            result |= {s: each * weight[s] for s in open_}
            break
        result |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return {s: float(result[s]) for s in order}


def fill(lengths: list[int], counts: list[int], budget: int, seed: int = SEED) -> list[int]:
    """How many documents of each length to take so that their words come as near ``budget`` as possible.

    All but ``KNAPSACK`` words are given out in proportion, from each length alike. What rounding leaves
    goes to lengths in the order of a seeded random number over the fraction that a length lost, so that
    one gets a document more about as often as its fraction says, be it long or short. A bounded knapsack over what is left of each length (reachable
    sums as bits of an integer) closes the rest: exactly if some subset does, else by the nearest sum,
    the smaller one of two equally near.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or not total:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    shares = [divmod(c * max(0, budget - KNAPSACK), total) for c in counts]
    taken = [t for t, _ in shares]
    rest = budget - sum(n * t for n, t in zip(lengths, taken))
    drawn = mixed_bits(mixed_bits(np.array(lengths, dtype=np.uint64)) + np.uint64(seed)).tolist()
    order = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    for i in sorted((i for i in order if shares[i][1]), key=lambda i: Fraction(drawn[i], shares[i][1])):
        if rest - KNAPSACK >= lengths[i]:
            taken[i] += 1
            rest -= lengths[i]
    limit = rest + lengths[order[0]]
    mask, reach, steps = (1 << (limit + 1)) - 1, 1, []
    for i in sorted(order, key=lambda i: lengths[i] * 2654435761 % (1 << 32)):  # short and long ones in turn
        free, step = min(counts[i] - taken[i], limit // lengths[i]), 1
        while free > 0 and not reach >> rest & 1:  # binary parts of the number of copies
            part = min(step, free)
            steps.append((i, part, reach))
            reach |= reach << part * lengths[i] & mask
            free, step = free - part, step * 2
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reach >> rest
    above = rest + (above & -above).bit_length() - 1 if above else None
    at = below if above is None or rest - below <= above - rest else above
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= part * lengths[i]
    return taken


def _quota(groups: pd.DataFrame, seed: int = SEED) -> pd.DataFrame:
    """For one source, the extra copies of each length. One row per length comes in, not one per document."""
    seed = seed % (1 << 31) << 32 | zlib.crc32(str(groups["source"].iloc[0]).encode())
    groups = groups.sort_values("size")
    total = int((groups["size"] * groups["n"]).sum())
    budget = round(float(groups["target"].iloc[0]))
    passes = min(MOST_PASSES, budget // total) if total else 0
    extra = fill([int(x) for x in groups["size"]], [int(x) for x in groups["n"]], budget - passes * total, seed) if passes < MOST_PASSES else [0] * len(groups)
    return pd.DataFrame({"source": groups["source"], "size": groups["size"], "passes": passes, "extra": extra, "source_size": total, "target": groups["target"]})


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The columns of ``docs`` but the text, with ``size, source_size, target, copies, taken``.

    Documents of a source and a length are interchangeable but for a seeded hash, which says which of
    them get the extra copy: hash ranges below the quota are taken whole, and only the range in which
    the quota ends is put in order. So a source or a length of any share of the rows is spread.

    Defined cases: a null text has size 0 and is never taken; a null source is a source of its own,
    the last; repeated rows are documents of their own; an empty table gives no rows. One row per
    source goes to the driver, as weights are given by source; other columns are ignored.
    """
    hashed = F.xxhash64(F.lit(seed), "doc_id")
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"), hashed.alias("h"))
    sized = stored(sized.withColumn("cell", F.pmod("h", F.lit(CELLS))), "sizes")
    cells = sized.groupBy("source", "size", "cell").agg(F.count("*").alias("n"))
    cells = stored(cells, "lengths")
    per_source = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()
    wanted = targets({r["source"]: int(r["s"]) for r in per_source}, weights)
    spark = docs.sparkSession
    wanted = spark.createDataFrame(list(wanted.items()), "source string, target double")
    histogram = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    histogram = histogram.join(wanted, histogram["source"].eqNullSafe(wanted["source"])).drop(wanted["source"])
    quota = histogram.groupBy("source").applyInPandas(
        lambda groups: _quota(groups, seed), "source string, size long, passes int, extra long, source_size long, target double",
    )
    quota = stored(quota, "quota")
    # Where each hash range of a source and length starts and ends in the order of documents.
    end = F.sum("n").over(Window.partitionBy("source", "size").orderBy("cell"))
    ranges = cells.withColumn("end", end).withColumn("start", F.col("end") - F.col("n")).drop("n")
    q, r = quota.alias("q"), ranges.alias("r")
    ranges = r.join(q, F.expr("r.source <=> q.source and r.size = q.size")).select(
        "r.source", "r.size", "cell", "passes", "source_size", "target",
        F.greatest(F.lit(0), F.least(F.col("extra") - F.col("start"), F.col("end") - F.col("start"))).alias("here"),
        (F.col("end") - F.col("start")).alias("n"),
    )
    d, r = sized.alias("d"), ranges.alias("r")
    joined = d.join(r, F.expr("d.source <=> r.source and d.size = r.size and d.cell = r.cell")).select(
        "d.doc_id", "d.source", "d.size", "d.cell", "d.h", "source_size", "target", "passes", "here", "n",
    )
    whole = joined.where("here = 0 or here = n").withColumn("extra", F.when(F.col("here") > 0, 1).otherwise(0))
    place = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "doc_id"))
    cut = joined.where("here > 0 and here < n").withColumn("extra", (place <= F.col("here")).cast("int"))
    copies = F.when(F.col("size") > 0, F.col("passes") + F.col("extra")).otherwise(0).cast("int")
    return whole.unionByName(cut).withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Rows that repeat an id are told apart by nothing, so each gets the largest number of copies among them.
    """
    chosen = mix(docs, weights, seed).groupBy("doc_id", "source").agg(F.max("copies").alias("copies"))
    d, c = docs.alias("d"), chosen.where("copies > 0").alias("c")
    joined = d.join(c, F.expr("d.doc_id <=> c.doc_id and d.source <=> c.source"))
    repeated = joined.select("d.*", F.explode(F.array_repeat(F.lit(0), F.col("c.copies"))).alias(unused(docs, "_copy")))
    return repeated.select(*docs.columns)
