"""The same results in plain SQL for DuckDB. Faults planted by the fixtures are counted by arithmetic here."""

from __future__ import annotations

from workload.fixtures import WIDE
from workload.queries import BOX, CENTER, POLYGON, PREFIX, RADIUS_M, SAMPLE, STRIDE, TYPE

# ---- shared views ---------------------------------------------------------------------------------------------------

S0 = """s0 AS (SELECT event_id AS e, CAST(event_id AS VARCHAR) AS id,
    CAST((user_id*31 + event_id % 5) % 145 + 1 AS INT) AS species_id, event_type AS source,
    CASE WHEN user_id % 10 = 0 THEN CAST(2.25 AS DOUBLE) ELSE CAST(-74.0 AS DOUBLE) END
      + CAST(user_id*37 % 256 AS DOUBLE)/1024
      + CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 1024 AS DOUBLE)/65536 ELSE CAST(0 AS DOUBLE) END AS lng,
    CASE WHEN user_id % 10 = 0 THEN CAST(48.75 AS DOUBLE) ELSE CAST(40.5 AS DOUBLE) END
      + CAST(user_id*91 % 251 AS DOUBLE)/1024 AS lat,
    CAST(ts AS TIMESTAMP) AS appeared_utc FROM events)"""


def local_sql(utc: str) -> str:
    return f"{utc} + to_minutes(CAST(round_even(lng*4, 0) AS BIGINT))"


S = f"""{S0}, s1 AS (SELECT *, {local_sql("appeared_utc")} AS appeared_local FROM s0),
s AS (SELECT *, CAST(hour(appeared_local) AS INT) AS local_hour, CAST(isodow(appeared_local) - 1 AS INT) AS local_dow,
    strftime(appeared_local, '%Y-%m-%d') AS local_date FROM s1)"""

C = """c0 AS (SELECT CAST(p_partkey % 151 + 1 AS INT) AS species_id, min(p_partkey) AS k FROM part GROUP BY 1),
c AS (SELECT species_id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN [lower(p_type)]
    ELSE [lower(p_type), lower(p_brand)] END AS types FROM c0 JOIN part ON p_partkey = k)"""


def iso(column: str) -> str:
    """Microseconds only where there are any."""
    return (f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({column}) % 1000000 <> 0 "
            f"THEN strftime({column}, '.%f') ELSE '' END || 'Z'")


CELL = f"""{S}, cell AS (SELECT *, CAST(floor(lng/CAST(0.01 AS DOUBLE)) AS BIGINT) AS cx,
    CAST(floor(lat/CAST(0.01 AS DOUBLE)) AS BIGINT) AS cy FROM s),
g AS (SELECT CAST(cx AS VARCHAR) || '_' || CAST(cy AS VARCHAR) AS cell_id, cx, cy, count(*) AS count,
    count(DISTINCT species_id) AS species, count(DISTINCT (lng, lat)) AS distinct_points,
    round((cx + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE), 6) AS lng_c,
    round((cy + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE), 6) AS lat_c FROM cell GROUP BY cx, cy)"""

TOP = f"""{CELL}, {C}, top0 AS (SELECT * FROM g ORDER BY count DESC, cell_id LIMIT 200),
top AS (SELECT CAST(row_number() OVER (ORDER BY count DESC, cell_id) AS INT) AS rank, * FROM top0),
dom0 AS (SELECT top.rank, cell.species_id, count(*) AS n FROM cell JOIN top USING (cx, cy) GROUP BY ALL),
dom1 AS (SELECT dom0.*, c.name, c.types, row_number() OVER (PARTITION BY rank ORDER BY n DESC, dom0.species_id) AS r
    FROM dom0 JOIN c ON c.species_id = dom0.species_id),
dom AS (SELECT rank, CAST(row_number() OVER (PARTITION BY rank ORDER BY n DESC, species_id DESC) - 1 AS INT) AS pos,
    species_id, name, array_to_string(types, ',') AS types, n AS count FROM dom1 WHERE r <= 3)"""

SP = f"""{S}, {C}, spc AS (SELECT s.species_id, name, types, count(*) AS count FROM s JOIN c ON c.species_id = s.species_id
    GROUP BY ALL)"""


def haversine(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    h = (f"sin(radians({lat2} - {lat1})/2) * sin(radians({lat2} - {lat1})/2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * sin(radians({lng2} - {lng1})/2) * sin(radians({lng2} - {lng1})/2)")
    return f"asin(sqrt(least({h}, CAST(1 AS DOUBLE)))) * CAST({2 * 6_378_100.0} AS DOUBLE)"


def record(distance: bool) -> str:
    extra = ", round(distance_m, 1) AS distance_m" if distance else ""
    return (f"f.id, f.species_id, c.name, array_to_string(c.types, ',') AS types, f.source, "
            f"{iso('f.appeared_utc')} AS appeared_utc, f.local_date, f.local_hour, f.local_dow{extra}")


_D0 = haversine(f"CAST({CENTER['lng']} AS DOUBLE)", f"CAST({CENTER['lat']} AS DOUBLE)", "lng", "lat")
NEAR = f"""{S}, {C}, d AS (SELECT *, {_D0} AS distance_m FROM s), f0 AS (SELECT * FROM d WHERE distance_m <= {RADIUS_M})"""

# Great-circle edges to the north of a point; relative longitudes are plain differences for these polygons.
_NORTH = """x >= least(xa, xb) AND x < greatest(xa, xb) AND tan(radians(lat)) <
    (CASE WHEN xa <= xb THEN sin(radians(xb - x)) * tan(radians(ya)) + sin(radians(x - xa)) * tan(radians(yb))
          ELSE sin(radians(xa - x)) * tan(radians(yb)) + sin(radians(x - xb)) * tan(radians(ya)) END)
    / sin(radians(abs(xb - xa)))"""


def _polygon_values() -> str:
    ring = POLYGON[0]
    return ", ".join(f"(CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE), CAST({b[0]} AS DOUBLE), CAST({b[1]} AS DOUBLE))"
                     for a, b in zip(ring, ring[1:]))


_ORIGIN = f"CAST({POLYGON[0][0][0]} AS DOUBLE)"
INSIDE = f"""{S}, edge AS (SELECT ax - {_ORIGIN} AS xa, ay AS ya, bx - {_ORIGIN} AS xb, by_ AS yb
    FROM (VALUES {_polygon_values()}) v(ax, ay, bx, by_)),
inside AS (SELECT s.* FROM s WHERE (SELECT count(*) FROM (SELECT s.lng - {_ORIGIN} AS x, s.lat AS lat) p, edge
    WHERE {_NORTH}) % 2 = 1)"""

# ---- requests -------------------------------------------------------------------------------------------------------

_POINT_REASON = """CASE k % 61 WHEN 1 THEN 'lat:missing' WHEN 2 THEN 'lat:not_numeric' WHEN 3 THEN 'lat:not_finite'
    WHEN 4 THEN 'lat:range' WHEN 5 THEN 'lng:missing' WHEN 6 THEN 'lng:range' WHEN 7 THEN 'radius:range'
    WHEN 8 THEN 'radius:range' WHEN 9 THEN 'radius:range' WHEN 10 THEN 'radius:missing' WHEN 11 THEN 'species:range'
    WHEN 12 THEN 'species:range' WHEN 13 THEN 'species:not_integer' WHEN 14 THEN 'type:unknown'
    WHEN 15 THEN 'limit:range' WHEN 16 THEN 'limit:range' WHEN 17 THEN 'limit:range' WHEN 18 THEN 'limit:not_integer'
    WHEN 19 THEN 'limit:not_integer' WHEN 24 THEN 'limit:range' WHEN 20 THEN 'lat:not_finite' WHEN 21 THEN 'lng:not_finite'
    WHEN 22 THEN 'lng:missing' WHEN 23 THEN 'radius:not_numeric' END"""

REQ = f"""{C}, tid AS (SELECT list(species_id ORDER BY species_id) AS ids FROM c WHERE list_contains(types, '{TYPE}')),
r0 AS (SELECT c_custkey AS k, {_POINT_REASON} AS reason,
    CASE WHEN k % 10 = 0 THEN CAST(2.25 AS DOUBLE) ELSE CAST(-74 AS DOUBLE) END + CAST(k * 53 % 256 AS DOUBLE)/1024
        + CAST(1 AS DOUBLE)/4096 AS q_lng,
    CASE WHEN k % 10 = 0 THEN CAST(48.75 AS DOUBLE) ELSE CAST(40.5 AS DOUBLE) END + CAST(k * 29 % 251 AS DOUBLE)/1024
        + CAST(1 AS DOUBLE)/8192 AS q_lat,
    CAST(CASE WHEN k % 97 = 0 THEN 25000 ELSE 100 + k % 40 * 25 END AS DOUBLE) AS radius_m,
    CAST(CASE WHEN k % 3 = 0 THEN 50 ELSE 1 + k % 60 END AS INT) AS lim,
    CASE WHEN k % 5 = 0 THEN CAST(1 + k % 151 AS INT) END AS one, k % 7 = 0 AS by_type FROM customer),
req AS (SELECT k AS query_id, reason, q_lng, q_lat, radius_m, lim,
    CASE WHEN by_type AND one IS NOT NULL THEN list_filter(ids, lambda i: i = one)
         WHEN by_type THEN ids WHEN one IS NOT NULL THEN [one] END AS ids FROM r0, tid)"""

_FAULTS = "11, 12, 13, 14, 15, 16, 17, 18, 19, 21, 22, 23, 24, 33"
_POLYGON_REASON = """CASE k % 50 WHEN 11 THEN 'body:not_an_object' WHEN 12 THEN 'body:not_an_object'
    WHEN 13 THEN 'type:not_polygon' WHEN 14 THEN 'rings:missing' WHEN 15 THEN 'rings:missing' WHEN 16 THEN 'ring:size'
    WHEN 17 THEN 'ring:open' WHEN 18 THEN 'position:range' WHEN 19 THEN 'position:range'
    WHEN 21 THEN 'position:not_numeric' WHEN 22 THEN 'position:shape' WHEN 23 THEN 'vertices:too_many'
    WHEN 24 THEN 'body:not_an_object' WHEN 33 THEN 'edge:antipodal' END"""

# Bow-ties, and what the request table plants by the supplier number.
_CROSSING = "(k % 10 = 9 OR k % 50 IN (27, 28, 31, 32))"

def _wide_corners() -> str:
    return " ".join(f"WHEN {k} THEN [[" + ", ".join(f"[CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)]" for x, y in ring) + "]]" for k, (_, ring) in WIDE.items())


def _wide_triangles() -> str:
    """Triangles of every wide polygon from the place that sees all its corners."""
    return ", ".join(f"({k}, {p[0]}, {p[1]}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for k, (p, ring) in WIDE.items() for a, b in zip(ring, ring[1:]))


def _vector(name: str, lng: str, lat: str) -> str:
    lng, lat = f"radians(CAST({lng} AS DOUBLE))", f"radians(CAST({lat} AS DOUBLE))"
    return f"cos({lat}) * cos({lng}) AS {name}x, cos({lat}) * sin({lng}) AS {name}y, sin({lat}) AS {name}z"


def _volume(a: str, b: str, c: str) -> str:
    return (f"(({a}y * {b}z - {a}z * {b}y) * {c}x + ({a}z * {b}x - {a}x * {b}z) * {c}y + ({a}x * {b}y - {a}y * {b}x) * {c}z)")


_VOLUMES = [_volume("u", "v", "p"), _volume("v", "w", "p"), _volume("w", "u", "p")]
WIDE_IN = f"""wt AS (SELECT k, {_vector("u", "x0", "y0")}, {_vector("v", "x1", "y1")}, {_vector("w", "x2", "y2")}
    FROM (VALUES {_wide_triangles()}) t(k, x0, y0, x1, y1, x2, y2)),
sp AS (SELECT id, species_id, {_vector("p", "lng", "lat")} FROM s),
win AS (SELECT DISTINCT wt.k, id, species_id FROM sp JOIN wt ON least({", ".join(_VOLUMES)}) > 0 OR greatest({", ".join(_VOLUMES)}) < 0)"""

SHAPE = f"""p0 AS (SELECT s_suppkey AS k, CAST(-74 AS DOUBLE) + CAST(k * 53 % 256 AS DOUBLE)/1024 + CAST(1 AS DOUBLE)/2048 AS x,
    CAST(40.5 AS DOUBLE) + CAST(k * 29 % 200 AS DOUBLE)/1024 + CAST(1 AS DOUBLE)/2048 AS y,
    CAST(1 + k % 8 AS DOUBLE)/256 AS h, {_POLYGON_REASON} AS reason FROM supplier),
p1 AS (SELECT *, CASE WHEN k % 50 = 26 THEN CASE k % 100 {_wide_corners()} END ELSE CASE k % 50
    WHEN 27 THEN [[[0, 0], [h, 0], [h, h], [0, h], [0, 0]], [[h/2, h/2], [2*h, h/2], [h/2, h/4], [h/2, h/2]]]
    WHEN 28 THEN [[[0, 0], [h, 0], [h, h], [2*h, 2*h], [h, h], [0, h], [0, 0]]]
    WHEN 31 THEN [[[0, 0], [0, 0], [0, 0], [0, 0]]]
    WHEN 32 THEN [[[-40, h], [40, h], [41, 2], [0, 4], [-41, 2], [-40, h]]] ELSE CASE
    WHEN k % 10 = 9 THEN [[[-h, -h], [h, h], [h, -h], [-h, h], [-h, -h]]]
    WHEN k % 4 = 0 THEN [[[-h, -h], [h, -h], [h, h], [-h, h], [-h, -h]]]
    WHEN k % 4 = 1 THEN [[[-h, -h], [h, -h], [0, 0], [h, h], [-h, h], [-h, -h]]]
    WHEN k % 4 = 2 THEN [[[-h, -h], [h, -h], [h, h], [-h, h], [-h, -h]],
                         [[-h/2, -h/2], [h/2, -h/2], [h/2, h/2], [-h/2, h/2], [-h/2, -h/2]]]
    ELSE [[[-h, -h], [h, 0], [-h, h], [-h, -h]]] END END END AS rings FROM p0),
pring AS (SELECT k, x, y, h, unnest(rings) AS ring FROM p1 WHERE reason IS NULL AND NOT {_CROSSING} AND k % 50 <> 26),
pedge0 AS (SELECT k, x, y, h, ring, unnest(range(1, len(ring))) AS i FROM pring),
pedge AS (SELECT k, x + h AS reach_e, x - h AS reach_w, y + h + CAST(0.01 AS DOUBLE) AS reach_n, y - h AS reach_s,
    x - h AS o, (x + ring[i][1]) - (x - h) AS xa, y + ring[i][2] AS ya,
    (x + ring[i + 1][1]) - (x - h) AS xb, y + ring[i + 1][2] AS yb FROM pedge0),
{WIDE_IN},
pin AS (SELECT p0.k, id, species_id FROM p0 JOIN win ON p0.k % 100 = win.k UNION ALL SELECT k, id, species_id FROM (SELECT pedge.*, s.id, s.species_id, s.lat, s.lng - o AS x FROM pedge JOIN s
    ON s.lng BETWEEN reach_w AND reach_e AND s.lat BETWEEN reach_s AND reach_n) t
    WHERE {_NORTH} GROUP BY k, id, species_id HAVING count(*) % 2 = 1)"""

# ---- raw lines ------------------------------------------------------------------------------------------------------

RAW = f"""{S}, x0 AS (SELECT s.* EXCLUDE (appeared_utc, local_hour, local_dow, local_date), appeared_utc AS ts,
    unnest(CASE WHEN e % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM s),
x1 AS (SELECT e, copy, 'part' || lpad(CAST(e // 4096 AS VARCHAR), 6, '0') AS part,
    CASE WHEN e % 50 = 7 THEN 'blank' WHEN e % 29 = 3 THEN 'invalid' ELSE 'doc' END AS status,
    CASE WHEN copy = 1 AND e % 40 <> 0 THEN 'c' ELSE '0' END || lpad(printf('%x', e), 23, '0') AS id,
    CASE WHEN e % 41 = 5 THEN NULL WHEN e % 43 = 6 THEN CASE WHEN e % 2 = 0 THEN 0 ELSE 152 END
         WHEN e % 47 = 8 OR e % 53 = 9 AND copy = 0 OR e % 53 <> 9 AND e % 59 = 10 AND copy = 0 THEN NULL
         WHEN e % 53 <> 9 AND e % 59 = 10 THEN 1 ELSE species_id END AS sp,
    CASE WHEN e % 41 = 5 THEN NULL WHEN e % 43 = 6 THEN CASE WHEN e % 2 = 0 THEN 0 ELSE 152 END
         WHEN e % 47 = 8 OR e % 53 = 9 THEN species_id WHEN e % 59 = 10 THEN 1 ELSE species_id END AS sp_value,
    e % 41 <> 5 AND e % 43 <> 6 AND e % 47 = 8 AS sp_is_text,
    CASE WHEN e % 71 = 3 THEN 'None' ELSE source END AS source, lng AS lng0, lat AS lat0,
    CASE WHEN e % 37 <> 4 THEN 'ok' ELSE ['sin_location', 'cero_cero', 'fuera_de_rango', 'fuera_de_rango',
        'no_numerico_o_nulo', 'no_numerico_o_nulo', 'coordinates_malformado', 'tipo_no_point', 'nan',
        'no_numerico_o_nulo'][e // 37 % 10 + 1] END AS category,
    CASE WHEN e % 37 <> 4 THEN lng ELSE [NULL, 0, 181 + e % 100, lng, NULL, NULL, NULL, NULL, NULL, NULL][e // 37 % 10 + 1] END AS rlng,
    CASE WHEN e % 37 <> 4 THEN lat ELSE [NULL, 0, lat, -91 - e % 50, NULL, NULL, NULL, NULL, NULL, NULL][e // 37 % 10 + 1] END AS rlat,
    CASE WHEN e % 31 <> 2 THEN CASE WHEN e % 79 = 6 THEN [strftime(ts, '%Y%m%dT%H%M%S.%g') || 'Z', strftime(ts, '%G-W%V-%uT%H:%M:%S.%g') || 'Z',
                  strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S,%g') || '+0200'][e // 79 % 3 + 1]
              WHEN e % 73 = 4 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+02:00'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END
         WHEN e // 31 % 6 = 0 THEN 'no-date' WHEN e // 31 % 6 = 4 THEN '12:00:00'
         WHEN e // 31 % 6 = 5 THEN strftime(ts + CASE WHEN e % 73 = 4 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H:%M:%S')
             || ' Europe/Madrid' END AS dtext,
    CASE WHEN e % 31 <> 2 THEN date_trunc('milliseconds', ts) END AS utc,
    CASE WHEN e % 61 <> 1 THEN strftime(appeared_local + CASE WHEN e % 67 = 2 THEN INTERVAL 7 MINUTE ELSE INTERVAL 0 MINUTE END,
        '%H:%M:%S') END AS ltime,
    concat_ws(',', '__v', '_id', 'appearedOn', CASE WHEN e % 61 <> 1 THEN 'localTime' END,
        CASE WHEN NOT (e % 37 = 4 AND e // 37 % 10 = 0) THEN 'location' END,
        CASE WHEN e % 41 <> 5 THEN 'pokemonId' END, CASE WHEN e % 71 <> 3 THEN 'source' END) AS keys FROM x0),
x2 AS (SELECT *, CAST(row_number() OVER (PARTITION BY part ORDER BY e, copy) - 1 AS BIGINT) AS line,
    CASE WHEN status <> 'doc' THEN status WHEN category <> 'ok' THEN 'coordinates'
         WHEN sp IS NULL OR sp NOT BETWEEN 1 AND 151 THEN 'species' WHEN utc IS NULL THEN 'date' END AS reason,
    CASE WHEN length(dtext) >= 19 AND substr(dtext, 5, 1) = '-' THEN dtext END AS date FROM x1),
raw AS (SELECT *, ((CAST(substr(ltime, 1, 2) AS INT) * 60 + CAST(substr(ltime, 4, 2) AS INT)
    - CAST(substr(date, 12, 2) AS INT) * 60 - CAST(substr(date, 15, 2) AS INT)) % 1440 + 1440) % 1440 AS off0 FROM x2),
doc AS (SELECT *, CASE WHEN off0 > 840 THEN off0 - 1440 ELSE off0 END AS offset_min FROM raw WHERE status = 'doc'),
good0 AS (SELECT part, e, copy, id, CAST(sp AS INT) AS species_id, source, lng0 AS lng, lat0 AS lat, utc FROM raw
    WHERE reason IS NULL),
good AS (SELECT *, {local_sql("utc")} AS local FROM good0)"""

_OUTCOME = "SELECT part, line, CASE WHEN status = 'doc' THEN id END AS id, coalesce(reason, 'ok') AS reason FROM raw"

FREQ = f"""{RAW}, freq0 AS (
    SELECT part, 'source' AS dim, source AS value FROM doc
    UNION ALL SELECT part, 'keys', keys FROM doc
    UNION ALL SELECT part, 'coords', category FROM doc
    UNION ALL SELECT part, 'species', CAST(sp AS VARCHAR) FROM doc WHERE sp BETWEEN 1 AND 151
    UNION ALL SELECT part, 'day', substr(date, 1, 10) FROM doc WHERE date IS NOT NULL
    UNION ALL SELECT part, 'offset', coalesce(CAST(offset_min AS VARCHAR), 'sin_dato') FROM doc WHERE date IS NOT NULL
    UNION ALL SELECT part, 'cell', CAST(CAST(floor(lat0) AS INT) AS VARCHAR) || ',' || CAST(CAST(floor(lng0) AS INT) AS VARCHAR)
        FROM doc WHERE category = 'ok'),
freq AS (SELECT part, dim, value, count(*) AS count FROM freq0 GROUP BY ALL)"""


def later(view: str, keys: str, name: str) -> str:
    return (f"(SELECT part, CAST(sum(CASE WHEN r > 1 THEN 1 ELSE 0 END) AS BIGINT) AS {name} FROM (SELECT part, row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY part, e, copy) AS r FROM {view}) GROUP BY part)")


# ---- spots ----------------------------------------------------------------------------------------------------------

SPOT = f"""{S}, sp0 AS (SELECT *, e AS line, CAST(epoch_us(appeared_utc) // 1000000 AS BIGINT) AS tsec,
    CAST(round_even(lng * 1000000, 0) AS BIGINT) || ',' || CAST(round_even(lat * 1000000, 0) AS BIGINT) AS point FROM s),
sp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY species_id, point, tsec ORDER BY line) AS dr FROM sp0)
    WHERE dr = 1)"""
VIEW = f"""{SPOT}, v AS (SELECT *, 'complete' AS view FROM sp UNION ALL SELECT *, 'prefix' FROM sp WHERE line < {PREFIX}
    UNION ALL SELECT *, 'stride' FROM sp WHERE line % {STRIDE} = 0)"""
ALL = f"{SPOT}, v AS (SELECT *, 'all' AS view FROM sp)"

POINTS = """, pt AS (SELECT view, point, count(*) AS n, count(DISTINCT species_id) AS d FROM v GROUP BY view, point),
ps AS (SELECT view, CAST(sum(n) AS BIGINT) AS sightings, count(*) AS distinct_points, max(n) AS max_at_point,
    CAST(sum(n) AS DOUBLE) / count(*) AS mean_per_point,
    CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS DOUBLE) * 100 / sum(n) AS pct_in_repeated_points,
    CAST(count_if(n = 1) AS DOUBLE) * 100 / count(*) AS pct_points_seen_once, count(*) FILTER (WHERE n >= 2) AS repeated_points,
    CAST(count_if(n >= 2 AND d = 1) AS DOUBLE) * 100 / count(*) FILTER (WHERE n >= 2) AS pct_single_species,
    CAST(sum(CASE WHEN n >= 2 THEN d END) AS DOUBLE) / count(*) FILTER (WHERE n >= 2) AS mean_distinct_species FROM pt GROUP BY view)"""
PAIRS = f""", {C}, cf AS (SELECT species_id, list_contains(types, '{TYPE}') AS flag FROM c),
pr0 AS (SELECT v.*, coalesce(flag, false) AS flag, lead(tsec) OVER w AS ntsec, lead(v.species_id) OVER w AS nsp,
    lead(source) OVER w AS nsrc, lead(coalesce(flag, false)) OVER w AS nflag FROM v LEFT JOIN cf ON cf.species_id = v.species_id
    WINDOW w AS (PARTITION BY view, point ORDER BY tsec, line)),
pr AS (SELECT view, ntsec - tsec AS gap_s, nsp = species_id AS same, nsrc = source AS same_src, flag, nflag
    FROM pr0 WHERE ntsec IS NOT NULL),
pq AS (SELECT view, count(*) AS pairs, CAST(count_if(same) AS DOUBLE) / count(*) AS same_species_rate,
    CAST(count_if(gap_s <= 900) AS DOUBLE) * 100 / count(*) AS pct_gap_15min,
    CAST(count_if(gap_s <= 3600) AS DOUBLE) * 100 / count(*) AS pct_gap_1h,
    CAST(count_if(gap_s <= 86400) AS DOUBLE) * 100 / count(*) AS pct_gap_24h,
    CAST(count_if(same_src) AS DOUBLE) * 100 / count(*) AS pct_same_source, count(*) FILTER (WHERE same AND gap_s <= 900) AS near_dups,
    {", ".join(f"quantile_cont(CAST(gap_s AS DOUBLE), {p}) / 3600 AS gap_h_p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))},
    CAST(count_if(flag AND nflag) AS DOUBLE) / count(*) FILTER (WHERE flag) AS next_given_type,
    CAST(count_if(NOT flag AND nflag) AS DOUBLE) / count(*) FILTER (WHERE NOT flag) AS next_given_other FROM pr GROUP BY view),
tot AS (SELECT view, count(*) AS n, CAST(count_if(flag) AS DOUBLE) / count(*) AS share FROM pr0 GROUP BY view),
si0 AS (SELECT view, species_id, CAST(count(*) AS HUGEINT) AS n FROM v GROUP BY ALL),
si AS (SELECT view, CAST(sum(n * n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS same_species_by_chance
    FROM si0 GROUP BY view)"""
COVER = f""", cv AS (SELECT view, {iso('min(appeared_utc)')} AS first_utc, {iso('max(appeared_utc)')} AS last_utc,
    count(DISTINCT CAST(appeared_utc AS DATE)) AS distinct_days,
    {", ".join(f"CAST(count_if(isodow(appeared_utc) = {d + 1}) AS DOUBLE) * 100 / count(*) AS pct_dow{d}" for d in range(7))}
    FROM v GROUP BY view)"""
_QUANTILES = "gap_h_p10, gap_h_p25, gap_h_p50, gap_h_p75, gap_h_p90"


def with_(views: str, select: str) -> str:
    return f"WITH {views} {select}"


def _time(granularity: str) -> str:
    key = {"hour": "lpad(CAST(local_hour AS VARCHAR), 2, '0')", "dow": "CAST(local_dow AS VARCHAR)", "day": "local_date"}
    return f"SELECT '{granularity}' AS granularity, {key[granularity]} AS key, count(*) AS count FROM s GROUP BY 2"


_BOX = (f"lat_c >= {BOX['min_lat']} AND lat_c <= {BOX['max_lat']} AND lng_c >= {BOX['min_lng']} AND lng_c <= {BOX['max_lng']}")

_GOOD_KEY = "species_id, lng, lat, utc"

ORACLES = {
    "grid_cells": with_(CELL, "SELECT * FROM g"),
    "grid_bench": with_(CELL, "SELECT cx, cy, count AS size, species AS nunique FROM g"),
    "grid_fingerprint": with_(CELL, "SELECT count(*) AS cells, CAST(sum(count) AS BIGINT) AS total, "
                                    "CAST(sum(species) AS BIGINT) AS species_sum FROM g"),
    "hotspots": with_(TOP, "SELECT rank, cell_id, count, species, distinct_points, lng_c, lat_c FROM top "
                           "WHERE rank IN (SELECT rank FROM dom)"),
    "hotspot_species": with_(TOP, "SELECT * FROM dom"),
    "cell_polygons": with_(CELL, """SELECT cell_id, CAST(pos AS INT) AS pos,
        round(lng_c + CASE WHEN pos IN (1, 2) THEN CAST(0.005 AS DOUBLE) ELSE -CAST(0.005 AS DOUBLE) END, 6) AS lng,
        round(lat_c + CASE WHEN pos IN (2, 3) THEN CAST(0.005 AS DOUBLE) ELSE -CAST(0.005 AS DOUBLE) END, 6) AS lat
        FROM g, (VALUES (0), (1), (2), (3), (4)) p(pos)"""),
    "recount_hotspots": with_(TOP, f""", sq AS (SELECT rank, cell_id, count, round(lng_c - CAST(0.005 AS DOUBLE), 6) AS w,
        round(lng_c + CAST(0.005 AS DOUBLE), 6) AS e, round(lat_c - CAST(0.005 AS DOUBLE), 6) AS so,
        round(lat_c + CAST(0.005 AS DOUBLE), 6) AS no FROM top),
        ed AS (SELECT rank, so AS low, unnest([[0, e - w, so, so], [0, e - w, no, no]]) AS v, w AS o FROM sq),
        hit AS (SELECT rank, id FROM (SELECT rank, v[1] AS xa, v[2] AS xb, v[3] AS ya, v[4] AS yb, s.id, s.lat, s.lng - o AS x
            FROM ed JOIN s ON s.lng BETWEEN o - 0.001 AND o + 0.011 AND s.lat BETWEEN low - 0.01 AND low + 0.02) t
            WHERE {_NORTH} GROUP BY rank, id HAVING count(*) % 2 = 1)
        SELECT sq.rank, sq.cell_id, sq.count, (SELECT count(*) FROM hit WHERE hit.rank = sq.rank) AS recount FROM sq"""
                              .replace(", sq AS", "SELECT * FROM (WITH sq AS", 1) + ")"),
    "invariants": with_(f"{S}, {C}", "SELECT count(*) AS total, count(*) AS grid, count(*) AS hours, "
                        "(SELECT count(*) FROM s JOIN c ON c.species_id = s.species_id) AS species, "
                        "count(*) = (SELECT count(*) FROM s JOIN c ON c.species_id = s.species_id) AS agree FROM s"),
    "time_hour": with_(S, _time("hour")),
    "time_dow": with_(S, _time("dow")),
    "time_day": with_(S, _time("day")),
    "time_all": with_(S, " UNION ALL ".join(_time(g) for g in ("hour", "dow", "day"))),
    "species_counts": with_(SP, "SELECT species_id, name, array_to_string(types, ',') AS types, count FROM spc"),
    "species_hour": with_(S, "SELECT species_id, local_hour, count(*) AS count FROM s GROUP BY ALL"),
    "type_counts": with_(SP, "SELECT type, CAST(sum(count) AS BIGINT) AS count FROM (SELECT unnest(types) AS type, count "
                             "FROM spc) GROUP BY type"),
    "peak_hour": with_(S, f"SELECT key, count FROM ({_time('hour')}) ORDER BY count DESC, key LIMIT 1"),
    "species_audit": with_(RAW, "SELECT count(*) AS rows, CAST(min(sp) AS BIGINT) AS min_id, CAST(max(sp) AS BIGINT) AS max_id, "
                                "count(DISTINCT sp) AS distinct_ids, CAST(count_if(sp NOT BETWEEN 1 AND 151) AS BIGINT) AS outside, "
                                "CAST(count_if(sp IS NULL) AS BIGINT) AS without_id FROM doc"),
    "missing_species": with_(f"{S}, {C}", "SELECT species_id, name, array_to_string(types, ',') AS types FROM c "
                                          "WHERE species_id NOT IN (SELECT species_id FROM s)"),
    "type_vocabulary": with_(C, "SELECT DISTINCT unnest(types) AS type FROM c"),
    "list_hotspots": with_(TOP, "SELECT rank, cell_id, top.count, (SELECT CAST(count(*) AS INT) FROM dom WHERE dom.rank = top.rank) "
                                "AS top FROM top ORDER BY rank LIMIT 20"),
    "list_grid": with_(CELL, "SELECT cell_id, count, species FROM g ORDER BY count DESC, cell_id LIMIT 50"),
    "list_time": with_(S, _time("dow")),
    "list_types": with_(SP, "SELECT type, CAST(sum(count) AS BIGINT) AS count FROM (SELECT unnest(types) AS type, count "
                            "FROM spc) GROUP BY type ORDER BY count DESC, type"),
    "list_species": with_(SP, "SELECT species_id, name, array_to_string(types, ',') AS types, count FROM spc "
                              "ORDER BY count DESC, species_id LIMIT 20"),
    "list_species_hours": with_(f"{S}, {C}", "SELECT s.species_id, name, local_hour, count(*) AS count FROM s "
                                "LEFT JOIN c ON c.species_id = s.species_id WHERE s.species_id = 2 GROUP BY ALL"),
    "bbox_grid": with_(CELL, f"SELECT cell_id, count, lng_c, lat_c FROM g WHERE {_BOX}"),
    "heat": with_(CELL, f"SELECT cell_id, lat_c, lng_c, sqrt(CAST(count AS DOUBLE) / greatest(max(count) OVER (), 1)) AS intensity "
                        f"FROM (SELECT * FROM g WHERE {_BOX} ORDER BY count DESC, cell_id LIMIT 500)"),
    "share_of_max": with_(SP, "SELECT species_id, name, count, CAST(count * 100 AS DOUBLE) / max(count) OVER () AS pct_of_max "
                              "FROM (SELECT * FROM spc ORDER BY count DESC, species_id LIMIT 15)"),
    "enrich": with_(f"{S}, {C}", f"SELECT {record(False)}, f.lng, f.lat FROM s f LEFT JOIN c ON c.species_id = f.species_id"),
    "near": with_(NEAR, f"SELECT {record(False)} FROM (SELECT * FROM f0 ORDER BY distance_m, id LIMIT 50) f "
                        "LEFT JOIN c ON c.species_id = f.species_id"),
    "near_species": with_(NEAR, f"SELECT id, species_id FROM f0 WHERE species_id IN (SELECT species_id FROM c WHERE "
                                f"list_contains(types, '{TYPE}')) ORDER BY distance_m, id LIMIT 200"),
    "geonear": with_(NEAR, f"SELECT {record(True)} FROM (SELECT * FROM f0 ORDER BY distance_m, id LIMIT 1000) f "
                           "LEFT JOIN c ON c.species_id = f.species_id"),
    "served_near": with_(NEAR, f"SELECT {record(False)} FROM (SELECT * FROM f0 ORDER BY distance_m, id LIMIT 50) f "
                               "LEFT JOIN c ON c.species_id = f.species_id"),
    "served_geonear": with_(NEAR, "SELECT id, species_id, lng, lat, round(distance_m, 1) AS distance_m FROM f0 ORDER BY distance_m, id LIMIT 1000"),
    "served_within": with_(INSIDE, "SELECT id, species_id, lng, lat FROM inside ORDER BY id LIMIT 100"),
    "near_documents": with_(f"{RAW}, one AS (SELECT DISTINCT id, lng, lat FROM good), d AS (SELECT *, {_D0} AS distance_m FROM one)",
                            f"SELECT id, lng, lat, round(distance_m, 1) AS distance_m FROM (SELECT * FROM d WHERE distance_m <= {RADIUS_M} "
                            "ORDER BY distance_m, id LIMIT 1000)"),
    "near_join": with_(f"{S}, {REQ}", f"""SELECT query_id, CAST(r AS INT) AS rank, id, species_id, round(d, 1) AS distance_m FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS r FROM (
            SELECT query_id, lim, radius_m, id, species_id, {haversine("q_lng", "q_lat", "lng", "lat")} AS d
            FROM req JOIN s ON abs(lat - q_lat) < 0.3 AND abs(lng - q_lng) < 0.5
            WHERE reason IS NULL AND (ids IS NULL OR list_contains(ids, species_id))) WHERE d <= radius_m) WHERE r <= lim"""),
    "within": with_(INSIDE, "SELECT id, species_id, lng, lat FROM inside ORDER BY id LIMIT 100"),
    "within_truncated": with_(INSIDE, "SELECT least(count(*), 100) AS count, count(*) > 100 AS truncated FROM inside"),
    "within_total": with_(INSIDE, "SELECT count(*) AS total FROM inside"),
    "within_join": with_(f"{S}, {SHAPE}", "SELECT polygon_id, CAST(r AS INT) AS rank, id, species_id FROM (SELECT k AS polygon_id, id, "
                         "species_id, row_number() OVER (PARTITION BY k ORDER BY id) AS r FROM pin) WHERE r <= 200"),
    "within_totals": with_(f"{S}, {SHAPE}", "SELECT p1.k AS polygon_id, count(pin.id) AS count FROM p1 LEFT JOIN pin ON pin.k = p1.k "
                            f"WHERE reason IS NULL AND NOT {_CROSSING.replace('k %', 'p1.k %')} GROUP BY p1.k"),
    "within_top_species": with_(INSIDE, "SELECT species_id, count(*) AS count FROM inside GROUP BY species_id "
                                        "ORDER BY count DESC, species_id LIMIT 5"),
    "species_filter_type": with_(f"{S}, {C}", "SELECT s.species_id, count(*) AS count FROM s JOIN c ON c.species_id = s.species_id "
                                 f"WHERE list_contains(types, '{TYPE}') GROUP BY 1"),
    "species_filter_both": with_(f"{S}, {C}", "SELECT s.species_id, source, count(*) AS count FROM s JOIN c ON c.species_id = "
                                 f"s.species_id WHERE list_contains(types, '{TYPE}') AND s.species_id = 2 GROUP BY ALL"),
    "clean_reasons": with_(RAW, "SELECT part, coalesce(reason, 'ok') AS reason, count(*) AS rows FROM raw GROUP BY ALL"),
    "clean_rows": with_(RAW, f"""SELECT id, species_id, source, lng, lat, {iso("utc")} AS appeared_utc,
        strftime(local, '%Y-%m-%d') AS local_date, CAST(hour(local) AS INT) AS local_hour,
        CAST(isodow(local) - 1 AS INT) AS local_dow FROM good"""),
    "dedup": with_(RAW, f"""SELECT part, id, species_id, source, lng, lat, {iso("utc")} AS appeared_utc FROM (
        SELECT *, row_number() OVER (PARTITION BY {_GOOD_KEY} ORDER BY part, e, copy) AS r FROM good) WHERE r = 1"""),
    "clean_report": with_(RAW, f"""SELECT count(*) FILTER (WHERE status <> 'blank') AS lines_read, count(*) FILTER (WHERE status = 'invalid') AS invalid_json,
        count(*) FILTER (WHERE reason = 'coordinates') AS bad_coordinates, count(*) FILTER (WHERE reason = 'species') AS bad_species,
        count(*) FILTER (WHERE reason = 'date') AS bad_date, count(*) FILTER (WHERE reason IS NULL) AS after_rules,
        (SELECT count(DISTINCT ({_GOOD_KEY})) FROM good) AS final_rows,
        count(*) FILTER (WHERE reason IS NULL) - (SELECT count(DISTINCT ({_GOOD_KEY})) FROM good) AS duplicates FROM raw"""),
    "local_time": with_(S, f"SELECT id, {iso('appeared_local')} AS appeared_local, local_hour, local_dow, local_date FROM s"),
    "line_numbers": with_(RAW, _OUTCOME),
    "stride_sample": with_(RAW, f"{_OUTCOME} WHERE line % {STRIDE} = 0"),
    "prefix_sample": with_(RAW, f"{_OUTCOME} WHERE line < {SAMPLE}"),
    "scan_plan": with_(RAW, f"SELECT part, count(*) AS lines, CAST(ceil(CAST(count(*) AS DOUBLE) / {STRIDE}) AS BIGINT) AS lines_taken "
                            "FROM raw GROUP BY part"),
    "profile_files": with_(RAW, """SELECT part, count(*) FILTER (WHERE status = 'doc') AS rows, count(*) FILTER (WHERE status = 'blank') AS blank,
        count(*) FILTER (WHERE status = 'invalid') AS invalid_json,
        count(*) FILTER (WHERE status = 'doc' AND NOT coalesce(sp BETWEEN 1 AND 151, false)) AS id_invalid,
        count(*) FILTER (WHERE status = 'doc' AND dtext IS NULL) AS no_date,
        count(*) FILTER (WHERE status = 'doc' AND dtext IS NOT NULL AND date IS NULL) AS bad_date,
        min(CASE WHEN status = 'doc' THEN date END) AS date_min, max(CASE WHEN status = 'doc' THEN date END) AS date_max,
        min(CASE WHEN status = 'doc' AND category = 'ok' THEN lat0 END) AS lat_min,
        max(CASE WHEN status = 'doc' AND category = 'ok' THEN lat0 END) AS lat_max,
        min(CASE WHEN status = 'doc' AND category = 'ok' THEN lng0 END) AS lng_min,
        max(CASE WHEN status = 'doc' AND category = 'ok' THEN lng0 END) AS lng_max FROM raw GROUP BY part"""),
    "profile_freq": with_(FREQ, "SELECT * FROM freq"),
    "top_k_freq": with_(FREQ, """SELECT dim, value, count, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (
        PARTITION BY dim ORDER BY count DESC, value) AS r FROM (SELECT dim, value, CAST(sum(count) AS BIGINT) AS count FROM freq
        GROUP BY dim, value)) WHERE r <= 5"""),
    "top_k_files": with_(FREQ, """SELECT part, dim, value, count, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (
        PARTITION BY part, dim ORDER BY count DESC, value) AS r FROM freq) WHERE r <= 3"""),
    "least_freq": with_(FREQ, """SELECT dim, value, count, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (
        PARTITION BY dim ORDER BY count, value) AS r FROM (SELECT dim, value, CAST(sum(count) AS BIGINT) AS count FROM freq
        GROUP BY dim, value)) WHERE r <= 4"""),
    "profile_cells": with_(FREQ, "SELECT count(DISTINCT value) AS cells FROM freq WHERE dim = 'cell'"),
    "profile_dups": with_(RAW, f"SELECT part, coalesce(dup_id, 0) AS dup_id, dup_event FROM "
                               f"{later('doc', 'sp_value, sp_is_text, rlng, rlat, date', 'dup_event')} LEFT JOIN {later('doc', 'id', 'dup_id')} USING (part)"),
    "profile_sample": with_(f"{RAW}, smp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY line) AS nth "
                            f"FROM doc) WHERE nth <= {SAMPLE})",
                            f"""SELECT part, rows, coords_ok, date_min, date_max, dup_event, coords_ok - dup_event AS usable FROM (
        SELECT part, count(*) AS rows, count(*) FILTER (WHERE category = 'ok') AS coords_ok, min(date) AS date_min, max(date) AS date_max FROM smp
        GROUP BY part) JOIN {later('smp', 'sp_value, sp_is_text, rlng, rlat, date', 'dup_event')} USING (part)"""),
    "profile_offsets": with_(RAW, "SELECT count(offset_min) AS offsets, count(*) FILTER (WHERE offset_min % 15 <> 0) AS odd_offsets FROM doc "
                                  "WHERE date IS NOT NULL"),
    "bad_examples": with_(RAW, """SELECT part, CAST(r AS INT) AS rank, example FROM (SELECT part,
        row_number() OVER (PARTITION BY part ORDER BY line) AS r, CASE e // 29 % 6 WHEN 2 THEN '[1]' WHEN 3 THEN '5'
        WHEN 1 THEN replace(head, '"', '''') ELSE head END AS example FROM (SELECT *, substr('{"_id":{"$oid":"' || id || '"}'
        || CASE WHEN e % 41 = 5 THEN '' WHEN e % 43 = 6 THEN ',"pokemonId":' || sp WHEN e % 47 = 8 THEN
            ',"pokemonId":"' || sp_value || '"' WHEN sp IS NULL THEN ',"pokemonId":' || CASE WHEN e % 53 = 9 THEN sp_value || '.0' ELSE 'true' END
            ELSE ',"pokemonId":' || sp END
        || CASE WHEN e % 71 = 3 THEN '' ELSE ',"source":"' || source || '"' END || ',"appearedOn":'
        || CASE WHEN e % 31 <> 2 OR e // 31 % 6 IN (0, 4, 5) THEN '{"$date":"' || dtext || '"}'
            WHEN e // 31 % 6 = 1 THEN '{}' WHEN e // 31 % 6 = 2 THEN 'null' ELSE '12345' END
        || CASE WHEN ltime IS NULL THEN '' ELSE ',"localTime":"' || ltime || '"' END
        || CASE WHEN e % 37 = 4 AND e // 37 % 10 = 0 THEN ',"__v":0}' ELSE ',"location":{"type":"' || CASE WHEN e % 37 = 4 AND
            e // 37 % 10 = 7 THEN 'LineString' ELSE 'Point' END || '","coordinates":[' END, 1, 120) AS head
        FROM raw WHERE status = 'invalid')) WHERE r <= 3"""),
    "point_stats": with_(ALL + POINTS, "SELECT sightings, distinct_points, max_at_point, mean_per_point, pct_in_repeated_points, "
                                       "pct_points_seen_once FROM ps"),
    "point_histogram": with_(ALL + POINTS, """SELECT band, count(n) AS points FROM (VALUES ('1', 1, 1), ('2', 2, 2), ('3-5', 3, 5),
        ('6-10', 6, 10), ('11-50', 11, 50), ('>50', 51, 1000000000)) b(band, lo, hi) LEFT JOIN pt ON n BETWEEN lo AND hi GROUP BY band"""),
    "simpson": with_(ALL + PAIRS, "SELECT same_species_by_chance FROM si"),
    "pair_stats": with_(ALL + PAIRS, f"SELECT pairs, same_species_rate, pct_gap_15min, pct_gap_1h, pct_gap_24h, {_QUANTILES} FROM pq"),
    "pair_by_gap": with_(ALL + PAIRS, """SELECT CASE WHEN gap_s <= 900 THEN '<=15min' WHEN gap_s <= 3600 THEN '15min-1h'
        WHEN gap_s <= 86400 THEN '1h-24h' WHEN gap_s <= 604800 THEN '1-7d' ELSE '>7d' END AS band, count(*) AS pairs,
        CAST(count_if(same) AS DOUBLE) / count(*) AS same_species_rate FROM pr GROUP BY 1"""),
    "near_dups": with_(ALL + PAIRS, "SELECT near_dups, CAST(near_dups AS DOUBLE) * 100 / n AS pct_near_dups FROM pq JOIN tot USING (view)"),
    "type_persistence": with_(ALL + PAIRS, "SELECT share, next_given_type, next_given_other FROM pq JOIN tot USING (view)"),
    "same_source": with_(ALL + PAIRS, "SELECT pct_same_source FROM pq"),
    "point_mix": with_(ALL + POINTS, "SELECT repeated_points, pct_single_species, mean_distinct_species FROM ps"),
    "view_coverage": with_(VIEW + COVER, "SELECT * FROM cv"),
    "compare_views": with_(VIEW + POINTS + PAIRS + COVER, """SELECT ps.*, pq.* EXCLUDE (view), si.same_species_by_chance, tot.share,
        cv.* EXCLUDE (view), CAST(near_dups AS DOUBLE) * 100 / n AS pct_near_dups
        FROM ps JOIN pq USING (view) JOIN si USING (view) JOIN tot USING (view) JOIN cv USING (view)"""),
    "request_checks": with_(REQ, """SELECT query_id, reason, CASE WHEN reason IS NULL THEN q_lng END AS q_lng,
        CASE WHEN reason IS NULL THEN q_lat END AS q_lat, CASE WHEN reason IS NULL THEN radius_m END AS radius_m,
        CASE WHEN reason IS NULL THEN lim END AS "limit", CASE WHEN reason IS NULL THEN array_to_string(ids, ',') END AS species_ids
        FROM req"""),
    "polygon_checks": with_(f"{S}, {SHAPE}", "SELECT k AS polygon_id, reason, CASE WHEN reason IS NULL THEN CAST(len(rings) AS INT) END "
                            "AS n_rings, CASE WHEN reason IS NULL THEN CAST(len(flatten(rings)) AS INT) END AS n_points FROM p1"),
    "self_intersection": with_(f"{S}, {SHAPE}", f"SELECT k AS polygon_id, {_CROSSING} AS crosses FROM p1 WHERE reason IS NULL"),
    "load_report": with_(RAW, """SELECT step, count(*) AS rows, CASE WHEN step = 'first' THEN count(DISTINCT id) ELSE 0 END AS inserted,
        count(*) - CASE WHEN step = 'first' THEN count(DISTINCT id) ELSE 0 END AS duplicate_ids
        FROM good, (VALUES ('first'), ('again')) t(step) GROUP BY step"""),
    "slim_catalog": """SELECT CAST(p_partkey AS INT) AS species_id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN lower(p_type)
        ELSE lower(p_type) || ',' || lower(p_brand) END AS types, CAST(p_size AS INT) AS height, CAST(p_size * 2 AS INT) AS weight,
        CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey % 300 AS INT) END AS base_experience, CAST(p_size AS INT) AS hp,
        CAST(NULL AS INT) AS attack, CAST(NULL AS INT) AS defense, CAST(p_partkey % 70 AS INT) AS special_attack,
        CAST(NULL AS INT) AS special_defense, CAST(p_partkey % 90 AS INT) AS speed FROM part""",
}
# Other physical forms of the same joins.
ORACLES |= {f"{name}_shuffled": ORACLES[name] for name in ("near_join", "within_join")}
ORACLES["profile_totals"] = (
    "SELECT * FROM (SELECT CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(blank) AS BIGINT) AS blank, CAST(sum(invalid_json) AS BIGINT) AS invalid_json, "
    "CAST(sum(id_invalid) AS BIGINT) AS id_invalid, CAST(sum(no_date) AS BIGINT) AS no_date, CAST(sum(bad_date) AS BIGINT) AS bad_date, "
    "min(date_min) AS date_min, max(date_max) AS date_max, min(lat_min) AS lat_min, max(lat_max) AS lat_max, min(lng_min) AS lng_min, "
    f"max(lng_max) AS lng_max FROM ({ORACLES['profile_files']})), "
    f"(SELECT CAST(sum(dup_id) AS BIGINT) AS dup_id, CAST(sum(dup_event) AS BIGINT) AS dup_event FROM ({ORACLES['profile_dups']})), "
    "(SELECT CAST(sum(rows) AS BIGINT) AS sample_rows, CAST(sum(coords_ok) AS BIGINT) AS sample_coords_ok, CAST(sum(dup_event) AS BIGINT) AS "
    f"sample_dup_event, CAST(sum(usable) AS BIGINT) AS sample_usable FROM ({ORACLES['profile_sample']}))")
