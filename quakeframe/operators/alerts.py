"""Alert rules over timelines, and what is done with the alerts they raise."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.functions import times
from quakeframe.operators import buckets
from quakeframe.schema import ALERT_PAYLOAD


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    hold_seconds: int
    summary: str
    description: str  # with {value}, {region}, {depth_bin} as placeholders
    action: str | None = None
    research_note: str | None = None  # with {region}


# Names, severities, hold times and texts of the rules.
RULES = {
    r.name: r
    for r in (
        Rule("HighMagnitudeEarthquake", "critical", 0, "HIGH MAGNITUDE EARTHQUAKE DETECTED",
             "Earthquake with magnitude {value} detected in {region} (depth: {depth_bin})",
             action="IMMEDIATE RESPONSE REQUIRED - Emergency protocols activated"),
        Rule("CriticalMagnitudeEarthquake", "critical", 0, "CRITICAL MAGNITUDE EARTHQUAKE",
             "MAJOR earthquake with magnitude {value} in {region} - CATASTROPHIC EVENT",
             action="HIGHEST PRIORITY - Full emergency response required"),
        Rule("EarthquakeSwarmDetected", "warning", 120, "Earthquake swarm detected",
             "{value} earthquakes detected in 5 minutes in {region}",
             research_note="Potential aftershock sequence, foreshocks, or volcanic activity"),
        Rule("EarthquakeSequenceActive", "warning", 60, "Active earthquake sequence detected",
             "Rapid sequence of earthquakes detected in {region} - monitoring for escalation",
             research_note="Sequence detection algorithm triggered - {region} showing unusual activity"),
        Rule("RegionalSeismicActivity", "warning", 600, "Elevated regional seismic activity",
             "{value} earthquakes detected in last hour in {region}",
             research_note="Regional activity above normal threshold"),
        Rule("SeismicDataPipelineDown", "critical", 120, "Seismic data pipeline failure",
             "No seismic data updates received for {value}",
             action="Check streaming pipeline, Kafka, and InfluxDB connectivity"),
    )
}
STEP_SECONDS = 15

# Routes in order, with their waits and repeat intervals in seconds.
ROUTES = [
    ({"severity": "critical"}, 5, 1800),
    ({"alertname": "HighMagnitudeEarthquake"}, 0, 900),
    ({"alertname": "EarthquakeSwarm"}, 30, 7200),
]
DEFAULT_ROUTE = (10, 3600)
GROUP_INTERVAL = 10  # fixed value: seconds between times to send for one group


# --- rules ------------------------------------------------------------------------------------

def known_by(timeline: DataFrame, as_of: Column) -> DataFrame:
    """Spells as they are known at an instant: those after it are left out, others end behind it at the latest."""
    after = F.timestamp_micros(F.unix_micros(as_of) + 1)
    return timeline.where(F.col("start") <= as_of).withColumn("end", F.least("end", after))


def sustained(
    timeline: DataFrame, keys: Sequence[str], hold_seconds: int, step_seconds: int = STEP_SECONDS, as_of: Column | None = None,
) -> DataFrame:
    """Runs of instants at which a condition holds, with the state each run reached.

    ``timeline`` has the spells ``[start, end)`` in which the condition is true, and their
    ``value``. A run is pending from its first instant, fires once it has held for
    ``hold_seconds`` and is resolved at the first instant at which the condition is gone.

    A look-back lets spells reach beyond the data. With ``as_of`` nothing after that instant is
    claimed: a run that holds there is open, without ``resolved_at``, and has fired only if it has
    held long enough by then. ``ticks`` counts the instants of the run so far.
    """
    runs = buckets.islands(timeline if as_of is None else known_by(timeline, as_of), keys, "value")
    firing_at = times.shift(F.col("start"), hold_seconds)
    resolved = F.col("end")
    if as_of is not None:
        until = F.timestamp_micros(F.unix_micros(as_of) - F.pmod(F.unix_micros(as_of), F.lit(step_seconds * 1_000_000)) + step_seconds * 1_000_000)
        runs = runs.withColumn("_open", F.col("end") > as_of).withColumn("end", F.when(F.col("end") > as_of, until).otherwise(F.col("end")))
        firing_at = F.when(firing_at <= as_of, firing_at)
        resolved = F.when(~F.col("_open"), F.col("end"))
    return runs.select(
        *keys, F.col("start").alias("pending_at"),
        F.when(firing_at < F.col("end"), firing_at).alias("firing_at"),
        resolved.alias("resolved_at"),
        (times.seconds(F.col("start"), F.col("end")) / step_seconds).cast("bigint").alias("ticks"),
        F.col("value").alias("peak"),
    )


def firing(
    timeline: DataFrame, rule: Rule, keys: Sequence[str] = ("region",), hold_seconds: int | None = None, as_of: Column | None = None,
) -> DataFrame:
    """The alerts of a rule: runs that held long enough, by ``as_of`` if it is given."""
    hold = rule.hold_seconds if hold_seconds is None else hold_seconds
    return (
        sustained(timeline, keys, hold, as_of=as_of).where(F.col("firing_at").isNotNull())
        .withColumns({"alertname": F.lit(rule.name), "severity": F.lit(rule.severity)})
    )


def data_gaps(df: DataFrame, limit_seconds: int = 300, time: str = "time", as_of: Column | None = None) -> DataFrame:
    """Silences of the data: pending once over the limit, firing after the hold time.

    With ``as_of`` the silence that goes on at that instant is one of them, without ``resolved_at``,
    and its length is what it has reached.
    """
    rule = RULES["SeismicDataPipelineDown"]
    start, gap = F.col("gap_start"), F.col("gap_seconds")
    fires = gap >= limit_seconds + rule.hold_seconds
    return buckets.silences(df, limit_seconds, time, as_of).select(
        F.lit(rule.name).alias("alertname"), F.lit(rule.severity).alias("severity"),
        times.shift(start, limit_seconds).alias("pending_at"),
        F.when(fires, times.shift(start, limit_seconds + rule.hold_seconds)).alias("firing_at"),
        (F.col("gap_end") if as_of is None else F.when(~F.col("open"), F.col("gap_end"))).alias("resolved_at"), "gap_seconds",
        describe(rule, times.humanize_seconds(gap), numeric=False).alias("description"),
    )


def describe(
    rule: Rule, value: Column, region: str = "region", depth_bin: str = "depth_bin", numeric: bool = True,
) -> Column:
    """The description with its placeholders filled; a missing label leaves an empty text.

    Whole numbers are written without a fraction.
    """
    whole = F.when(value.cast("double") % 1 == 0, value.cast("bigint").cast("string")) if numeric else None
    text = value.cast("string")
    fill = {"value": F.coalesce(whole, text) if numeric else text, "region": F.col(region), "depth_bin": F.col(depth_bin)}
    parts, rest = [], rule.description
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(before), F.coalesce(fill[name], F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def annotations(alerts: DataFrame, value: str = "peak", rules: dict[str, Rule] = RULES) -> DataFrame:
    """Adds what a notification says: ``summary, description, action, research_note``, by ``alertname``.

    The region is a column already. Labels that an alert lacks leave an empty text.
    """
    missing = [F.lit(None).cast("string").alias(c) for c in ("region", "depth_bin") if c not in alerts.columns]
    out = alerts.select("*", *missing)
    texts = {
        "summary": lambda r: F.lit(r.summary), "description": lambda r: describe(r, F.col(value)),
        "action": lambda r: F.lit(r.action),
        "research_note": lambda r: F.lit(None) if r.research_note is None else F.concat(*[
            F.coalesce(F.col("region"), F.lit("")) if part == "{region}" else F.lit(part)
            for part in re.split(r"(\{region\})", r.research_note)]),
    }
    columns = {}
    for name, text in texts.items():
        column = F.lit(None).cast("string")
        for rule in rules.values():
            column = F.when(F.col("alertname") == rule.name, text(rule)).otherwise(column)
        columns[name] = column
    return out.withColumns(columns).drop(*[c for c in ("region", "depth_bin") if c not in alerts.columns])


# --- notifications ----------------------------------------------------------------------------

def group_alerts(alerts: DataFrame, by: Sequence[str] = ("alertname", "region")) -> DataFrame:
    """One row per notification group. The members stay rows of ``alerts``: a group has no bound."""
    return alerts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_alerts"),
        F.min("firing_at").alias("first_firing_at"), F.max("firing_at").alias("last_firing_at"),
        F.max("resolved_at").alias("last_resolved_at"), F.max("peak").alias("peak"),
    )


def route(alerts: DataFrame, routes=ROUTES, default: tuple[int, int] = DEFAULT_ROUTE) -> DataFrame:
    """The first route whose labels all match decides wait and repeat interval."""
    number = F.lit(len(routes))
    wait, repeat = F.lit(default[0]), F.lit(default[1])
    for i, (match, group_wait, interval) in reversed(list(enumerate(routes))):
        hit = F.lit(True)
        for label, value in match.items():
            hit = hit & F.col(label).eqNullSafe(F.lit(value))
        number = F.when(hit, i).otherwise(number)
        wait, repeat = F.when(hit, group_wait).otherwise(wait), F.when(hit, interval).otherwise(repeat)
    return alerts.withColumns({"route": number, "group_wait": wait, "repeat_interval": repeat})


_DAY = 86_400_000_000


def _by_day(df: DataFrame, start: str, end: str) -> DataFrame:
    """Spells ``[start, end)`` cut at midnight, with their ``day``, all in microseconds."""
    low, high = F.unix_micros(start), F.unix_micros(end)
    days = F.sequence(low - F.pmod(low, F.lit(_DAY)), high - 1 - F.pmod(high - 1, F.lit(_DAY)), F.lit(_DAY))
    cut = df.where(F.col(start) < F.col(end)).withColumns({"_low": low, "_high": high}).withColumn("day", F.explode(days))
    return cut.withColumns({"_low": F.greatest("_low", "day"), "_high": F.least("_high", F.col("day") + _DAY)})


def inhibit(
    targets: DataFrame, sources: DataFrame, equal: Sequence[str] = ("alertname", "region"),
    start: str = "firing_at", end: str = "resolved_at",
) -> DataFrame:
    """The parts ``[part_start, part_end)`` of targets in which no source of the same labels fires.

    Spells are cut at midnight and meet by labels and day. Of the sources that overlap a target, in
    order, the parts before each and behind the last are left; no row stands for an instant. A
    target is told from others by all of its columns.
    """
    columns = targets.columns
    t = _by_day(targets, start, end).alias("t")
    s = _by_day(sources, start, end).select(*equal, "day", F.col("_low").alias("s_low"), F.col("_high").alias("s_high")).alias("s")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in equal]
    meets = (F.col("t.day") == F.col("s.day")) & (F.col("s_low") < F.col("t._high")) & (F.col("s_high") > F.col("t._low"))
    for test in same:
        meets = meets & test
    met = t.join(s, meets, "left").select(*[F.col(f"t.{c}") for c in columns], "t.day", "t._low", "t._high", "s_low", "s_high")
    key = [*columns, "day", "_low", "_high"]
    reached = F.max("s_high").over(Window.partitionBy(*key).orderBy("s_low", "s_high").rowsBetween(Window.unboundedPreceding, -1))
    before = met.withColumn("part_start", F.greatest("_low", F.coalesce(reached, "_low"))).withColumn("part_end", F.col("s_low"))
    behind = met.groupBy(*key).agg(F.max("s_high").alias("part_start")).withColumns({
        "part_start": F.greatest("_low", F.coalesce("part_start", "_low")), "part_end": F.col("_high")})
    parts = before.select(*columns, "part_start", "part_end").unionByName(behind.select(*columns, "part_start", "part_end"))
    return parts.where("part_start < part_end").withColumns({
        "part_start": F.timestamp_micros("part_start"), "part_end": F.timestamp_micros("part_end")})


def part_ticks(parts: DataFrame, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """The instants of parts, which end at midnight at the latest."""
    last = times.shift(F.col("part_end"), -step_seconds)
    return parts.withColumn("tick", F.explode(F.sequence("part_start", last, F.make_dt_interval(secs=F.lit(step_seconds)))))


def repeat_suppression(
    parts: DataFrame, keys: Sequence[str], repeat_seconds: Column | int, step_seconds: Column | int = STEP_SECONDS,
    first: Column | None = None,
) -> DataFrame:
    """Notifications that are sent: in each repeat interval from ``first`` (by default ``firing_at``) on
    the earliest instant of the grid of steps that lies in a part.

    An interval's candidates are one for each part that reaches into it, found from the bounds.
    """
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    micros = parts.withColumns({
        "_first": F.unix_micros(F.col("firing_at") if first is None else first),
        "_every": as_column(repeat_seconds).cast("bigint") * 1_000_000, "_step": as_column(step_seconds).cast("bigint") * 1_000_000,
        "_low": F.unix_micros("part_start"), "_high": F.unix_micros("part_end"),
    }).withColumn("_low", F.greatest("_low", "_first")).where("_low < _high")
    number = lambda at: F.floor((at - F.col("_first")) / F.col("_every")).cast("bigint")
    each = micros.withColumn("repeat", F.explode(F.sequence(number(F.col("_low")), number(F.col("_high") - 1))))
    begin = F.greatest(F.col("_low"), F.col("_first") + F.col("repeat") * F.col("_every"))
    sent = F.col("_first") + F.ceil((begin - F.col("_first")) / F.col("_step")).cast("bigint") * F.col("_step")
    inside = (F.col("_sent") < F.col("_high")) & (F.col("_sent") < F.col("_first") + (F.col("repeat") + 1) * F.col("_every"))
    return each.withColumn("_sent", sent).where(inside).groupBy(*keys, "firing_at", "repeat").agg(
        F.timestamp_micros(F.min("_sent")).alias("sent_at"))


def notifications(
    alerts: DataFrame, sources: DataFrame, as_of: Column, equal: Sequence[str] = ("alertname", "region"), routes=ROUTES,
    default: tuple[int, int] = DEFAULT_ROUTE, group_interval: int = GROUP_INTERVAL, labels: Sequence[str] = ("alertname", "region"),
) -> DataFrame:
    """Everything that is sent by ``as_of`` for alerts: ``labels, severity, firing_at, status, repeat, sent_at``.

    An alert's first notification waits for the routed ``group_wait``. From then on there is a time to
    send every ``group_interval``; a firing alert is sent again at the first of these at which the
    routed repeat interval has passed, unless a source with equal labels fires then, and the end of
    an alert of which something was sent is told at the first one at or after it.
    """
    until = F.timestamp_micros(F.unix_micros(as_of) + 1)
    keys = [*labels, "severity", "group_wait", "repeat_interval", "resolved_at"]
    routed = route(alerts, routes, default).select(*keys, "firing_at", F.least(F.coalesce("resolved_at", until), until).alias("_until"))
    ended = lambda df: df.withColumn("_until", F.least(F.coalesce("resolved_at", until), until))
    parts = inhibit(routed, ended(sources), equal, end="_until")
    first = F.timestamp_micros(F.unix_micros("firing_at") + F.col("group_wait").cast("bigint") * 1_000_000)
    every = F.ceil(F.col("repeat_interval") / group_interval) * group_interval
    sent = repeat_suppression(parts, keys, every, group_interval, first)
    last = sent.groupBy(*keys, "firing_at").agg(F.max("repeat").alias("repeat")).where(F.col("resolved_at") <= as_of)
    start, step = F.unix_micros(first), F.lit(group_interval * 1_000_000)
    told = start + F.greatest(F.ceil((F.unix_micros("resolved_at") - start) / step).cast("bigint"), F.lit(0)) * step
    resolved = last.withColumn("sent_at", F.timestamp_micros(told)).where(F.col("sent_at") <= as_of)
    columns = [*labels, "severity", "firing_at", "status", "repeat", "sent_at"]
    return sent.withColumn("status", F.lit("firing")).select(*columns).unionByName(
        resolved.withColumn("status", F.lit("resolved")).select(*columns))


# --- received payloads ------------------------------------------------------------------------

def flatten_payloads(payloads: DataFrame, text: str = "payload", received: str = "received_at") -> DataFrame:
    """One row per alert of a payload, with defaults for what is missing."""
    body = F.from_json(F.col(text), ALERT_PAYLOAD)
    # The outer form has no filter inferred for it, which would parse the payload a second time.
    alert = payloads.select(received, F.explode_outer(body["alerts"]).alias("a")).where(F.col("a").isNotNull())
    label = lambda name, default: F.coalesce(F.col("a.labels")[name], F.lit(default)).alias(name)
    note = lambda name: F.coalesce(F.col("a.annotations")[name], F.lit("N/A")).alias(name)
    return alert.select(
        received, label("alertname", "Unknown"),
        F.coalesce("a.status", F.lit("Unknown")).alias("status"),
        label("severity", "Unknown"), label("region", "N/A"), note("summary"), note("description"),
        F.coalesce("a.startsAt", F.lit("N/A")).alias("startsAt"),
        F.coalesce("a.endsAt", F.lit("N/A")).alias("endsAt"),
    )


def totals(alerts: DataFrame, received: str = "received_at") -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_received"),
        F.count_if(F.col("severity") == "critical").alias("critical_alerts"),
        F.count_if(F.col("severity") == "warning").alias("warning_alerts"),
        F.max(received).alias("last_alert_time"),
    )


def history(alerts: DataFrame, keep: int = 100, show: int | None = None, received: str = "received_at") -> DataFrame:
    """The latest alerts, newest first. ``show`` narrows the kept ones."""
    order = [F.col(received).desc(), F.col("alertname"), F.col("region")]
    kept = alerts.orderBy(*order).limit(keep)
    return kept if show is None else kept.orderBy(*order).limit(show)
