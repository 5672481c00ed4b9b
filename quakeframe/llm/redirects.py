"""URL filters with redirect equivalence: decisions on a URL hold for its aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm.common import stored
from quakeframe.llm.components import components

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The name of a URL among its aliases: host, path and query; the scheme and the fragment don't count."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), path(url), query))


def _numeric(text: Column, pattern: str, base: int) -> Column:
    """Character references of one base replaced; those of no character stay."""
    def replaced(done: Column, found: Column) -> Column:
        digits = F.regexp_extract(found, pattern, 1)
        code = F.conv(digits, base, 10).cast("long")
        letter = F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32")
        return F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.replace(done, found, letter)).otherwise(done)

    return F.aggregate(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), text, replaced)


def decoded(text: Column) -> Column:
    """Numeric character references and those of markup characters replaced, each once: ``&amp;lt;`` is ``&lt;``."""
    text = F.regexp_replace(text, r"(?i)&#(0*38|x0*26)(;|(?![0-9a-f]))", "&amp;")
    text = _numeric(_numeric(text, r"&#(\d{1,7});", 10), r"&#[xX]([0-9a-fA-F]{1,6});", 16)
    for name, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(letter))
    return text


def without_dots(url: Column) -> Column:
    """The URL with the segments ``.`` and ``..`` of its path resolved."""
    parts = F.split(path(url), "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part))),
    )
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    begin, end = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1)
    return F.when(path(url).rlike(r"/\.\.?(/|$)"), F.concat(begin, F.lit("/"), F.array_join(kept, "/"), end)).otherwise(url)


def absolute(target: Column, url: Column) -> Column:
    """A link target as a URL: with a scheme, with a host only, from the root, or beside ``url``.

    An empty target, or a fragment alone, is the page itself; a query alone keeps the path. Targets of other
    kinds (``mailto:``, ``javascript:``, ``data:``) are none.
    """
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host(url))
    folder = F.regexp_extract(path(url), r"(?s)^(.*/)", 1)
    beside = F.concat(root, F.when(folder == "", "/").otherwise(folder), target)
    return (
        F.when(F.instr(url, "://") == 0, None).when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when((target == "") | target.startswith("#"), url)
        .when(target.startswith("?"), F.concat(root, path(url), target))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target)).otherwise(beside)
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """``a, b, url``: canonical links and page refreshes of each page, as nodes, and the target's URL.

    Targets are taken without character references and segments of dots.
    """
    found = F.explode(F.array_union(
        F.regexp_extract_all("html", F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(1)),
    ))
    targets = pages.where(F.col("html").isNotNull() & (F.instr("url", "://") > 0)).select("url", found.alias("target"))
    targets = targets.select("url", decoded(F.col("target")).alias("target"))
    targets = targets.select(node(F.col("url")).alias("a"), absolute(F.col("target"), F.col("url")).alias("url"))
    targets = targets.select("a", without_dots(F.col("url")).alias("url"))
    return targets.select("a", node(F.col("url")).alias("b"), "url").where("b is not null")


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``node, rule, rule_verdict`` of every node that a rule fits; the longest rule wins, of equally long ones allow.

    Each host is taken apart into itself and its parents, which join the rules; so rules may be many.
    """
    parents = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    asked = urls.select("node", "path", F.explode(parents).alias("rule_host"))
    name = F.concat("rule_host", "rule_path")
    fits = asked.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("node").agg(F.max(F.struct(F.length(name).alias("n"), (F.col("rule_verdict") == "allow").alias("allow"), name.alias("rule"))).alias("r"))
    return best.select("node", F.col("r.rule").alias("rule"), F.when(F.col("r.allow"), "allow").otherwise("block").alias("rule_verdict"))


def judged(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A rule that fits a URL decides on it. Any other URL takes the decision of its aliases, the
    component of redirects and canonical links that it belongs to: allow if a rule allows one of
    them (allow goes first), else block if a rule blocks one, else allow. ``links`` (``a, b, url``)
    adds redirects known from elsewhere. Targets that are no pages count as aliases too.

    Defined cases: a URL that is null or has no ``://`` has empty host and path, no aliases and is
    allowed; a null ``html`` has no links; repeated rows are judged alike; an empty table gives no rows.
    """
    found = alias_links(pages)
    links = stored(found if links is None else found.unionByName(links), "aliases")
    url = F.col("url")
    from_pages = pages.select(node(url).alias("node"), host(url).alias("host"), path(url).alias("path"))
    from_links = links.select(F.col("b").alias("node"), host(url).alias("host"), path(url).alias("path"))
    urls = from_pages.unionByName(from_links).where("node is not null").dropDuplicates(["node"])
    decided = stored(rule_of(urls, rules), "rules")
    groups = components(links, "aliases")
    heard = groups.join(decided, "node").groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("allow"))
    heard = groups.join(heard, "component").select("node", F.when(F.col("allow"), "allow").otherwise("block").alias("heard"))
    judged_nodes = decided.join(heard, "node", "full_outer").select("node", "rule", F.coalesce("rule_verdict", "heard").alias("v"))
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), node(url).alias("node"))
    return rows.join(judged_nodes, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("v", F.lit("allow")).alias("verdict"))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)
