"""Personal data, and terms that reveal it by their co-occurrence in the corpus. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import stored

# The kinds in their order, as what Java's expressions must say to find the same leftmost matches in linear
# time: runs are possessive where what follows can't be in the run, and a run is entered at its first
# character only, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no match
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = "term"  # the kind of what the method adds
WORDS = 12  # on either side of personal data whose co-occurrence with it is counted
SUPPORT = 3  # different texts that must show a co-occurrence
DISCLOSURE = 0.75  # share of the information in an item of personal data that a term may not reveal
PREFIXES = (4, 3, 2, 1)  # letters that a generalised term keeps, the longest that is safe

_SPACE = "[\\x20\\x09-\\x0D]+"
_PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEY = ["doc_id", "digest"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _matches(kind: str, text: Column) -> Column:
    """All matches of a kind: the characters since the last one, length, whether valid, and the words around it."""
    def flat(piece: Column) -> Column:
        return F.translate(piece, "\t\n\x0b\f\r", "     ")

    def one(pieces: Column):
        def match(value: Column, i: Column) -> Column:
            return _let(_valid(kind, value), lambda ok: F.struct(
                F.lit(kind).alias("kind"), i.alias("i"), F.length(pieces[i]).alias("gap"), F.length(value).alias("length"), ok.alias("ok"),
                F.when(ok, F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)).alias("value"),
                F.when(ok, F.substring_index(flat(pieces[i]), " ", -WORDS)).alias("before"),
                F.when(ok, F.substring_index(flat(pieces[i + 1]), " ", WORDS)).alias("after"),
            ))

        return match

    none = "array<struct<kind:string,i:int,gap:int,length:int,ok:boolean,value:string,before:string,after:string>>"
    found = _let(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), lambda values: F.when(
        F.size(values) > 0, _let(F.split(text, PATTERNS[kind], -1), lambda pieces: F.transform(values, one(pieces))),
    ).otherwise(F.array().cast(none)))
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast(none)) if kind in NEEDS else found


def _read(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, digest, found``. Written once, without the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*(_matches(kind, text) for kind in PATTERNS))
    return stored(docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), found.alias("found")), "matches")


def base_spans(read: DataFrame) -> DataFrame:
    """``doc_id, digest, kind, start, end, entity, before, after``: the valid matches, in code points, end exclusive.

    Rows that repeat an id and a text are one here; what is found holds for each of them.
    """
    once = read.where(F.size("found") > 0).dropDuplicates(_KEY).select(*_KEY, F.explode("found").alias("m")).select(*_KEY, "m.*")
    run = Window.partitionBy(*_KEY, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(run)
    placed = once.withColumn("end", end).where("ok").withColumn("start", F.col("end") - F.col("length"))
    return placed.select(*_KEY, "kind", "start", "end", F.concat_ws(":", "kind", "value").alias("entity"), "before", "after")


def _term(field: Column) -> Column:
    """A word without punctuation around it; empty if it has a digit or an @."""
    return F.when(field.rlike("[0-9@]"), F.lit("")).otherwise(F.regexp_replace(field, f"^{_PUNCTUATION}|{_PUNCTUATION}$", ""))


def nearby(spans: DataFrame) -> DataFrame:
    """``doc_id, digest, entity, term, start, end``: the words on either side of each item of personal data."""
    def placed(text: Column, start: Column) -> Column:
        fields = F.split(text, " ")
        return F.transform(fields, lambda f, i: F.struct(
            f.alias("field"), (start + i + F.aggregate(F.slice(fields, F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x))).alias("at"),
        ))

    around = F.concat(placed(F.col("before"), F.col("start") - F.length("before")), placed(F.col("after"), F.col("end")))
    words = spans.select(*_KEY, "entity", F.explode(around).alias("w")).select(*_KEY, "entity", "w.field", "w.at")
    lead = F.length(F.regexp_extract("field", f"^{_PUNCTUATION}", 0))
    words = words.withColumn("word", _term(F.col("field"))).where("word <> ''")
    start = F.col("at") + lead
    return words.select(*_KEY, "entity", F.lower("word").alias("term"), start.alias("start"), (start + F.length("word")).alias("end")).distinct()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``term, n``: how often each term occurs in all texts."""
    fields = docs.select(F.explode(F.split(F.lower("text"), _SPACE)).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    return fields.select(_term(F.col("field")).alias("term"), "n").where("term <> ''").groupBy("term").agg(F.sum("n").alias("n"))


def _revealed(together: str, entity: str, term: str, total: int) -> Column:
    """PMI of a term and an entity over the information in the entity: 1 where the term says all, 0 where nothing."""
    information = F.log2(F.lit(float(total)) / F.col(entity))
    return F.when(information > 0, 1 + F.log2(F.col(together) / F.col(term)) / information).otherwise(0.0)


def disclosing(near: DataFrame, words: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``entity, term, revealed, general``: terms that reveal an entity beyond the threshold, and what to put instead.

    Of all word occurrences in the corpus, those within ``WORDS`` words of an entity are counted, for each
    entity and term (``together``), each entity and each term. ``revealed`` is the pointwise mutual
    information of the two as a share of the information content of the entity. ``general`` is the longest
    of the term's prefixes (``PREFIXES`` letters and ``*``) that, counted over all terms that begin so,
    stays below the threshold; null if none does.
    """
    pairs = stored(near.groupBy("entity", "term").agg(F.count("*").alias("together"), F.count_distinct("digest").alias("texts")), "co-occurrence")
    entities = pairs.groupBy("entity").agg(F.sum("together").alias("n_entity"))
    total = words.agg(F.sum("n")).first()[0] or 1
    scored = pairs.where(F.col("texts") >= support).join(words.withColumnRenamed("n", "n_term"), "term").join(entities, "entity")
    scored = scored.withColumn("revealed", _revealed("together", "n_entity", "n_term", total)).where(F.col("revealed") >= disclosure)
    flagged = stored(scored.select("entity", "term", "n_entity", "revealed"), "disclosing")
    lengths = F.explode(F.array(*map(F.lit, PREFIXES))).alias("kept")
    prefix = F.expr("substring(term, 1, kept)").alias("prefix")
    classes = flagged.select("entity", "term", "n_entity", lengths).where(F.length("term") > F.col("kept")).select("*", prefix)
    asked = classes.select("prefix").distinct()
    of_words = words.select("term", "n", lengths).select(prefix, "n").join(asked, "prefix", "left_semi").groupBy("prefix").agg(F.sum("n").alias("n_class"))
    of_pairs = pairs.join(flagged.select("entity").distinct(), "entity", "left_semi").select("entity", "term", "together", lengths)
    of_pairs = of_pairs.select("entity", prefix, "together").groupBy("entity", "prefix").agg(F.sum("together").alias("together"))
    safe = classes.join(of_words, "prefix").join(of_pairs, ["entity", "prefix"])
    safe = safe.where(_revealed("together", "n_entity", "n_class", total) < disclosure)
    general = safe.groupBy("entity", "term").agg(F.concat(F.max_by("prefix", "kept"), F.lit("*")).alias("general"))
    return flagged.join(general, ["entity", "term"], "left").select("entity", "term", "revealed", "general")


def _all_spans(docs: DataFrame, read: DataFrame, support: int, disclosure: float) -> DataFrame:
    """``doc_id, digest, kind, rank, start, end, instead`` of all spans, base and added."""
    base = stored(base_spans(read), "spans")
    near = stored(nearby(base), "nearby")
    found = disclosing(near, stored(vocabulary(docs), "vocabulary"), support, disclosure)
    # A word near several entities goes if one of them asks for it, else keeps the fewest letters.
    removed = F.max(F.col("general").isNull())
    added = near.join(found, ["entity", "term"]).groupBy(*_KEY, "start", "end").agg(
        F.when(removed, F.lit(f"[{TERM}]")).otherwise(F.min_by("general", F.length("general"))).alias("instead"),
    )
    order = F.array_position(F.array(*map(F.lit, PATTERNS)), F.col("kind")).cast("int")
    base = base.select(*_KEY, "kind", order.alias("rank"), "start", "end", F.concat(F.lit("["), "kind", F.lit("]")).alias("instead"))
    return base.unionByName(added.select(*_KEY, F.lit(TERM).alias("kind"), F.lit(len(PATTERNS) + 1).alias("rank"), "start", "end", "instead"))


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    r, f = rows.alias("r"), found.alias("f")
    return r.join(f, F.expr("r.doc_id <=> f.doc_id and r.digest = f.digest"), "left")


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs``.

    Base spans are found by pattern and check. To them the method adds words near an item of personal data
    that reveal it: their co-occurrence over the corpus gives them ``disclosure`` or more of the item's
    information, in ``support`` different texts. So exact copies of one text show nothing, and a text
    without personal data gets no span.

    Defined cases: a null text is empty; an empty text has no spans, and the digest of the empty string;
    rows that repeat an id and a text get the same spans, and copies of a text count in all frequencies but
    not as support; rows without an id are told apart by their text; an empty table gives no rows; other
    columns are ignored. Texts may be of any length: matching is linear, and one text with its matches must
    fit a task some four times.
    """
    read = _read(docs)
    spans = _all_spans(docs, read, support, disclosure)
    name = F.concat_ws(":", "kind", "start", "end")
    listed = F.sort_array(F.collect_list(F.struct("rank", "start", "end", name.alias("name"))))
    counts = [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in PATTERNS]
    each = spans.groupBy(*_KEY).agg(*counts, listed.alias("listed"))

    def joined(chosen: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(chosen, lambda s: s["name"]), ","), F.lit(""))

    base = F.filter("listed", lambda s: s["rank"] <= len(PATTERNS))
    return _joined(read.select(*_KEY), each).select(
        "r.doc_id", *(F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("listed")).alias("spans"),
    )


def sanitised(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """The rows and columns of ``docs`` with personal data replaced by its kind and revealing terms generalised or removed.

    Where spans overlap, what they cover together goes, and the first one says what stands instead. A null
    text stays null; texts without spans stay as they are.
    """
    spans = _all_spans(docs, _read(docs), support, disclosure)
    before = F.max("end").over(Window.partitionBy(*_KEY).orderBy("start", F.col("end").desc(), "rank").rowsBetween(Window.unboundedPreceding, -1))
    apart = spans.withColumn("before", F.coalesce(before, F.lit(0))).where("end > before")
    apart = apart.select(*_KEY, F.greatest("start", "before").alias("start"), "end", "before", F.when(F.col("start") >= F.col("before"), F.col("instead")).otherwise("").alias("instead"))
    listed = apart.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end", "before", "instead"))).alias("spans"))
    text = F.col("r.row.text")

    def left(s: Column) -> Column:
        return F.concat(F.substring(text, s["before"] + 1, s["start"] - s["before"]), s["instead"])

    rest = F.substring(text, F.element_at("spans", -1)["end"] + 1, F.length(text))
    changed = F.when(F.col("spans").isNull(), text).otherwise(F.concat(F.array_join(F.transform("spans", left), ""), rest))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    return _joined(rows, listed).select(*(changed.alias("text") if c == "text" else F.col(f"r.row.{c}") for c in docs.columns))
