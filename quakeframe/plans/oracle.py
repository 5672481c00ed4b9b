"""Comparison SQL: the registered queries restated for DuckDB over the given tables.

The common table expressions follow FIXTURES.md section 6 and the rules of the two paths. Averages
are one division of exact integer sums; rounding goes through the decimal text of a double, which
is how Spark rounds half up.
"""

from __future__ import annotations

K = "CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS INTEGER)"

QUAKES = f"""quakes AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS event_time, ts AS updated,
    CASE WHEN k % 50 <> 7 THEN CAST((user_id % 6) * 10 - 25 AS DOUBLE) END AS latitude,
    CAST((user_id % 4) * 10 - 15 AS DOUBLE) AS longitude,
    CASE WHEN k % 10 <> 9 THEN CAST(k * 7 - 20 AS DOUBLE) END AS depth,
    CAST(3 AS DOUBLE) + value / 64 AS mag, 'mb' AS magType,
    CASE k % 6 WHEN 0 THEN k || ' km NE of Townville, ' || event_type
               WHEN 1 THEN 'south of ' || event_type
               WHEN 2 THEN event_type || ' region'
               WHEN 3 THEN 'South OF ' || event_type
               WHEN 4 THEN event_type END AS place,
    event_id
  FROM (SELECT *, {K} AS k FROM events))"""

DUPLICATED = """duplicated AS (
  SELECT * FROM quakes UNION ALL
  SELECT * REPLACE (event_time + INTERVAL 10 SECOND AS event_time, updated + INTERVAL 10 SECOND AS updated)
  FROM quakes WHERE event_id % 20 = 0)"""

CALENDAR = """CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
    CAST(weekofyear(event_time) AS INTEGER) AS week, CAST(event_time AS DATE) AS date"""


def _depth(unknown: str) -> str:
    return (f"CASE WHEN {unknown} THEN 'unknown' WHEN depth < 70 THEN 'shallow' "
            "WHEN depth < 300 THEN 'intermediate' ELSE 'deep' END")


DEPTH_CAT = _depth("depth IS NULL")
DEPTH_LIVE = _depth("depth IS NULL OR depth <= 0")
MAG_CAT = ("CAST(floor(mag) AS DOUBLE)::VARCHAR || '-' || CAST(round(floor(mag) + 0.9, 1) AS DOUBLE)::VARCHAR")
MAG_LIVE = ("CASE WHEN mag IS NULL OR mag < 0 THEN 'unknown' ELSE "
            "CAST(trunc(mag) AS BIGINT) || '.0-' || CAST(trunc(mag) AS BIGINT) || '.9' END")

# The region in words: what follows the last comma; if nothing does, what follows the last word "of";
# else the place. A closing word "region" goes. The places of the fixture have single blanks only.
def _after_of(place: str) -> str:
    """The part behind the last `` of ``; empty without one. ``place`` is compared as it is given."""
    return f"CASE WHEN contains(' ' || {place}, ' of ') THEN trim(right(place, strpos(reverse(' ' || {place}), ' fo ') - 1)) ELSE '' END"


def _region(place: str) -> str:
    tail = "CASE WHEN contains(place, ',') THEN trim(list_last(string_split(place, ','))) ELSE '' END"
    found = f"coalesce(nullif({tail}, ''), nullif({_after_of(place)}, ''), trim(place))"
    bare = f"CASE WHEN ends_with(lower({found}), ' region') THEN trim(left({found}, length({found}) - 7)) ELSE {found} END"
    return f"coalesce(nullif({bare}, ''), 'Unknown')"


REGION_CAT, REGION_LIVE = _region("place"), _region("lower(place)")


def _silver(name: str, source: str, table: str, where: str, mag: str, depth: str, region: str) -> str:
    return f"""{name} AS (
  SELECT *, {CALENDAR}, {mag} AS mag_bin, {depth} AS depth_bin, {region} AS region, '{source}' AS source
  FROM {table} WHERE event_time IS NOT NULL AND {where})"""


CATALOGUE = _silver("catalogue", "batch", "quakes", "mag >= 4.0", MAG_CAT, DEPTH_CAT, REGION_CAT)
LIVE = _silver("live", "stream", "quakes", "id <> '' AND mag <> 0 AND mag >= 4.0", MAG_LIVE, DEPTH_LIVE, REGION_LIVE)


def _points(name: str, table: str) -> str:
    return f"""{name} AS (
  SELECT event_time AS time, region, mag_bin, depth_bin, source, magType AS mag_type, mag AS magnitude,
    latitude, longitude, depth, id AS event_id, place
  FROM {table} WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""


POINTS = _points("points", "catalogue")
STREAM_POINTS = _points("stream_points", "live")
ALL_POINTS = "all_points AS (SELECT * FROM points UNION ALL SELECT * FROM stream_points)"

ORIGIN = "TIMESTAMP '1970-01-01'"
N = "CAST(count(*) AS BIGINT) AS eq_count"
SPAN = "min(event_time) AS min_event_time, max(event_time) AS max_event_time"


def rounded(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def mean(x: str) -> str:
    """One division of whole units of 1e-8: a sum of decimals loses a digit on its way to a double."""
    return f"CAST(sum(CAST(round({x} * 1e8) AS HUGEINT)) AS DOUBLE) / (count({x}) * 1e8)"


def mags(digits: int) -> str:
    average = rounded(mean("mag"), digits)
    return f"{N}, {average} AS avg_mag, {rounded('max(mag)', digits)} AS max_mag"


def bucket(width: str, time: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width}', {time}, {ORIGIN})"


def tumbling(width: str, keys: str, values: str, table: str = "live", where: str = "true") -> str:
    keys = f"{keys}, " if keys else ""
    return f"""SELECT {bucket(width)} AS window_start, {bucket(width)} + INTERVAL '{width}' AS window_end,
  {keys}{values}, {SPAN} FROM {table} WHERE {where} GROUP BY ALL"""


def sliding(width: str, slide: str, copies: int, extra: str = "") -> str:
    start = f"{bucket(slide)} - i * INTERVAL '{slide}'"
    return f"""SELECT {start} AS window_start, {start} + INTERVAL '{width}' AS window_end, region,
  {mags(2)}, {SPAN}{extra} FROM live, unnest(range({copies})) AS r(i) GROUP BY ALL"""


ROLLING_7DAY = sliding("7 days", "1 day", 7)
ROLLING_24H = sliding("24 hours", "1 hour", 24)
SEQUENCE_TYPE = ("CASE WHEN {n} < 3 THEN 'isolated_sequence' WHEN {n} >= 10 THEN 'swarm' "
                 "WHEN {m} > 6.0 THEN 'aftershock' ELSE 'general_sequence' END")


def grid(x: str) -> str:
    return f"CAST(trunc({x} / 10) AS INTEGER)"


SEQUENCES = f"""SELECT {bucket('24 hours')} AS window_start, {bucket('24 hours')} + INTERVAL '24 hours' AS window_end,
  region, {grid('latitude')} AS lat_grid, {grid('longitude')} AS lon_grid, {mags(2)}, {SPAN},
  {SEQUENCE_TYPE.format(n='count(*)', m='max(mag)')} AS sequence_type
FROM live WHERE mag >= 4.0 AND latitude IS NOT NULL AND longitude IS NOT NULL
GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 3"""

MONTHLY_MAGNITUDE = f"SELECT year, month, region, mag_bin, {N} FROM catalogue GROUP BY ALL"
MONTHLY_DEPTH = f"SELECT year, month, region, depth_bin, {N} FROM catalogue GROUP BY ALL"
LIVE_MAGNITUDE = tumbling("2 hours", "mag_bin", N)
LIVE_DEPTH = tumbling("12 hours", "region, depth_bin", N)
WEEKLY = f"SELECT year, week, region, {mags(3)} FROM catalogue GROUP BY ALL"
DAILY = f"SELECT date, {mags(3)} FROM catalogue GROUP BY ALL"
HOURLY = tumbling("1 hour", "", mags(2))

_TABLES = {
    "duplicated": DUPLICATED, "catalogue": CATALOGUE, "live": LIVE, "points": POINTS,
    "stream_points": STREAM_POINTS, "all_points": ALL_POINTS,
}
_NEEDS = {
    "duplicated": [], "catalogue": [], "live": [], "points": ["catalogue"], "stream_points": ["live"],
    "all_points": ["points", "stream_points"],
}


def sql(body: str, *tables: str, **extra: str) -> str:
    """A query over ``quakes`` and the named tables; ``extra`` adds further ones in order."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS[name]:
            need(other)
        if name not in order:
            order.append(name)

    for name in tables:
        need(name)
    parts = [QUAKES, *[_TABLES[n] for n in order], *[f"{n} AS ({q})" for n, q in extra.items()]]
    return "WITH " + ",\n".join(parts) + "\n" + body


def as_of(table: str, time: str = "time") -> str:
    return f"(SELECT max({time}) FROM {table})"


def since(table: str, interval: str, time: str = "time", of: str | None = None) -> str:
    now = as_of(of or table, time)
    return f"{table} WHERE {time} >= {now} - INTERVAL '{interval}' AND {time} <= {now}"


# --- timelines and runs -----------------------------------------------------------------------

STEP = "INTERVAL '15 seconds'"


def count_ticks(table: str, lookback_seconds: int, at_least: int) -> str:
    """Brute force: every event copied to every instant that sees it."""
    micros = "epoch_us(time)"
    return f"""SELECT region, make_timestamp(instant) AS tick, CAST(count(*) AS BIGINT) AS value
FROM (SELECT region, unnest(range(
    CAST(ceil({micros} / 15e6) AS BIGINT) * 15000000,
    CAST(floor(({micros} + {lookback_seconds * 1000000}) / 15e6) AS BIGINT) * 15000000 + 1,
    15000000)) AS instant FROM {table})
GROUP BY ALL HAVING count(*) >= {at_least}"""


def strongest_ticks(table: str, above: float) -> str:
    micros = "epoch_us(time)"
    return f"""SELECT region, depth_bin, tick, magnitude AS value FROM (
  SELECT *, make_timestamp(instant) AS tick,
    row_number() OVER (PARTITION BY region, instant ORDER BY magnitude DESC, time DESC, event_id DESC) AS rn
  FROM (SELECT *, unnest(range(
      CAST(ceil({micros} / 15e6) AS BIGINT) * 15000000,
      CAST(floor(({micros} + 300000000) / 15e6) AS BIGINT) * 15000000 + 1, 15000000)) AS instant
    FROM {table} WHERE magnitude > {above}))
WHERE rn = 1"""


def runs(ticks: str, keys: str, hold_seconds: int) -> str:
    """Gaps and islands over instants."""
    return f"""SELECT {keys}, min(tick) AS pending_at,
  CASE WHEN max(tick) >= min(tick) + INTERVAL '{hold_seconds} seconds'
       THEN min(tick) + INTERVAL '{hold_seconds} seconds' END AS firing_at,
  max(tick) + {STEP} AS resolved_at, CAST(count(*) AS BIGINT) AS ticks, max(value) AS peak
FROM (SELECT *, tick - row_number() OVER (PARTITION BY {keys} ORDER BY tick) * {STEP} AS island FROM ({ticks}))
GROUP BY {keys}, island"""


def fired(ticks: str, keys: str, hold_seconds: int, name: str, severity: str) -> str:
    return f"""SELECT *, '{name}' AS alertname, '{severity}' AS severity
FROM ({runs(ticks, keys, hold_seconds)}) WHERE firing_at IS NOT NULL"""
