"""Exact duplicates by a tree merge of sorted digest runs. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import stored, unused

FAN_IN = 16  # runs that one merge takes
RANGE_BYTES = 2  # leading bytes of the digest that name a digest range; each range has a tree of its own


def normalised(text: Column) -> Column:
    """A null text as an empty one; A to Z in lower case, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


KEY = ["digest", "length", "second"]


def merge_runs(leaves: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: its key columns, ``best`` and ``copies``.

    ``leaves`` has one row per document with its ``run`` (the partition that read it). A run is what
    is left of a partition after equal digests are combined. In each round the runs whose numbers
    agree above the next digit meet in digest order, one merge for each digest range, and of equal
    digests the row with the greatest ``best`` goes on. That the texts are equal is verified at each
    level by the length and a second hash beside the digest. A group of copies of any size brings at
    most one row per run into a merge, so no merge takes more than ``fan_in`` rows of one text.
    """
    width = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    merged = leaves.groupBy("range", "run", *KEY).agg(F.max("best").alias("best"), F.count("*").alias("copies"))
    while True:
        width = -(-width // fan_in)
        merged = merged.withColumn("run", F.expr(f"run div {fan_in}")).repartition("range", "run")
        equal = Window.partitionBy("range", "run", *KEY).orderBy(F.col("best").desc())
        merged = (
            merged.withColumn("place", F.row_number().over(equal))
            .withColumn("copies", F.sum("copies").over(equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .where("place = 1").drop("place")
        )
        if width == 1:
            return merged.drop("run", "range")


def exact_duplicates(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A to Z. Of equal texts the row with the largest
    ``doc_id`` stays. Defined cases: a null text is an empty one; a null ``doc_id`` is smaller than
    any other, so such a row stays only if its group has no other id (``keep_id`` null); of rows that
    repeat an id and a text, one stays; an empty table gives no rows; other columns are ignored.
    """
    text = normalised(F.col("text"))
    read = docs.select("doc_id", text.alias("t")).select(
        "doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.length("t").alias("length"), F.xxhash64("t").alias("second"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"),
    )
    # Written once: row numbers are fixed from here on, and texts are read a single time.
    read = stored(read, "digests")
    leaves = read.select(
        "digest", "length", "second", "run", F.substring("digest", 1, RANGE_BYTES).alias("range"), F.struct("doc_id", "row").alias("best"),
    )
    groups = merge_runs(leaves, fan_in).withColumnRenamed("copies", "group_size")
    joined = read.drop("run").join(groups, KEY)
    return joined.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns. Of rows that repeat id and text, one stays."""
    found = exact_duplicates(docs, fan_in).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"),
    )
    sha = unused(docs, "_sha")
    marked = docs.withColumn(sha, F.sha2(normalised(F.col("text")), 256))
    joined = marked.join(found, marked["doc_id"].eqNullSafe(found["_id"]) & (marked[sha] == found["_digest"]), "left_semi")
    return joined.dropDuplicates(["doc_id", sha]).select(*docs.columns)
