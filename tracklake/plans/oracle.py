"""SQL for the registered queries, written against the driver tables for a second engine.

The statements are independent of the DataFrame code: triples are spelled out per row and made a set with
DISTINCT, row numbers come from plain windows, and the tracker is a recursive query.
"""

from __future__ import annotations

from ..vocab import ANALYTICS_DATA, DATA, EXTENSION, FILTER_DATA, IES, ISO3166, ISO8601, ITU, LOCODE, MMSI_SCHEME, RDF_TYPE, XSD

ORACLE: dict[str, str] = {}

# --- tables -------------------------------------------------------------------------------------

_RAW = """
raw AS (
  SELECT event_id AS seq, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, ts, epoch_us(ts) AS micros
  FROM events
)"""

_POSITION = _RAW + """,
position AS (
  SELECT seq, CAST(200000000 + user_id AS VARCHAR) AS mmsi, ts, micros,
         CAST(5050000 + (user_id % 50) * 1000 + k + CASE WHEN seq % 41 = 0 THEN 5000 ELSE 0 END AS DOUBLE) / 100000 AS lat,
         CAST(-150000 + (user_id % 37) * 1000 + seq % 97 AS DOUBLE) / 100000 AS lon,
         value AS sog, k * CAST(3.0 AS DOUBLE) AS cog, k * CAST(1.0 AS DOUBLE) AS heading,
         CASE WHEN user_id % 3 = 0 THEN '' ELSE 'VESSEL ' || user_id END AS vessel_name,
         CASE WHEN user_id % 4 = 0 THEN '' ELSE CAST(9000000 + user_id AS VARCHAR) END AS imo,
         CASE WHEN user_id % 5 = 0 THEN '' ELSE 'CS' || user_id END AS call_sign,
         CASE event_type WHEN 'click' THEN '1001' WHEN 'view' THEN '1004' WHEN 'purchase' THEN '1011' ELSE '9999' END AS vessel_type,
         event_type AS status, user_id % 200 + CAST(20 AS DOUBLE) AS length, user_id % 30 + CAST(5 AS DOUBLE) AS width,
         user_id % 10 + CAST(1.5 AS DOUBLE) AS draft
  FROM raw
)"""



def _batches(position: str) -> str:
    return f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts NULLS FIRST, seq) - 1 AS rn, count(*) OVER (PARTITION BY mmsi) AS n
  FROM {position}
),
batched AS (SELECT *, rn // 4 AS track_no FROM numbered WHERE rn // 4 < n // 4),
bounds AS (
  SELECT mmsi, track_no, min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n_pings FROM batched GROUP BY mmsi, track_no
)"""


_BATCHED = _POSITION + _batches("position")

# Pings of which some have no time.
_GAPPY = _POSITION + """,
gappy AS (
  SELECT * REPLACE (CASE WHEN seq % 11 <> 0 THEN ts END AS ts, CASE WHEN seq % 11 <> 0 THEN micros END AS micros) FROM position
)"""

_COMPRESSED = _POSITION + """,
squeezed AS (
  SELECT * REPLACE (1704067200000000 + (micros - 1704067200000000) // 200 AS micros) FROM position
),
synced AS (SELECT *, (micros - (SELECT min(micros) FROM squeezed)) // 60000000 AS step FROM squeezed),
latest AS (
  SELECT mmsi, step, max(micros) AS micros, arg_max(seq, (micros, seq)) AS seq,
         arg_max(lat, (micros, seq)) AS lat, arg_max(lon, (micros, seq)) AS lon
  FROM synced GROUP BY mmsi, step
)"""


def _iso(ts: str) -> str:
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
        f"ELSE '.' || lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0') END)"
    )


def _round(x: str, digits: int) -> str:
    return f"round({x}, {digits})"


def _sql(name: str, tables: str, select: str) -> None:
    ORACLE[name] = f"WITH RECURSIVE {tables.strip()}\n{select.strip()}" if tables else select.strip()


# --- sources and projections --------------------------------------------------------------------

_sql("ping_scan", _POSITION, f"""
SELECT mmsi, {_iso('ts')} AS time, lat, lon, sog AS speed, cog AS course, vessel_name AS name, imo, call_sign AS callsign
FROM position""")

_sql("row_count", "", "SELECT count(*) AS n FROM events")

_sql("oz_reshape", _POSITION, f"""
SELECT mmsi, lon, lat, cog, sog, vessel_type, CAST(NULL AS VARCHAR) AS subtype, length, width, draft,
       {_iso('ts')} AS ts, vessel_name, imo, call_sign, seq
FROM position""")

_sql("iso_time", _POSITION, f"""
SELECT seq, {_iso('ts')} AS iso, strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS craft_time,
       strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS parsed_craft, micros AS parsed_micros,
       '{ISO8601}' || {_iso('ts')} AS period_uri
FROM position""")

_sql("csv_detections", _POSITION, """
SELECT mmsi, vessel_type, micros, lat, lon, CAST(2 AS INTEGER) AS n_metadata FROM position""")

# --- tracks -------------------------------------------------------------------------------------

_sql("track_batches", _BATCHED, "SELECT mmsi, track_no, seq FROM batched")
_sql("track_bounds", _BATCHED, """
SELECT mmsi, track_no, epoch_us(min_ts) AS min_micros, epoch_us(max_ts) AS max_micros, n_pings FROM bounds""")
_sql("last_seen", _POSITION, """
SELECT mmsi, seq, lag(micros) OVER w AS prev_micros, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
FROM position WINDOW w AS (PARTITION BY mmsi ORDER BY ts, seq)""")
_sql("ping_cap", _POSITION, "SELECT mmsi, seq, micros FROM position ORDER BY ts, seq LIMIT 20")
_sql("pings_in_time_order", _POSITION, "SELECT mmsi, seq, micros FROM position ORDER BY ts, seq")
_sql("track_last_point", _BATCHED, """
SELECT mmsi, track_no, max(micros) AS micros, arg_max(lat, (ts, seq)) AS lat, arg_max(lon, (ts, seq)) AS lon
FROM batched GROUP BY mmsi, track_no""")
_sql("open_tracks", _BATCHED, """
SELECT mmsi, track_no, min(micros) AS min_micros, max(micros) AS max_micros,
       string_agg(CAST(seq AS VARCHAR), ',' ORDER BY ts, seq) AS seqs
FROM batched GROUP BY mmsi, track_no""")

_sql("track_batches_sliced", _GAPPY + _batches("gappy"), "SELECT mmsi, track_no, seq FROM batched")
_sql("pack_messages_sliced", _GAPPY, """
SELECT rn // 8 AS batch_id, CAST(rn % 8 AS INTEGER) AS place, seq
FROM (SELECT *, row_number() OVER (ORDER BY ts NULLS FIRST, seq) - 1 AS rn FROM gappy)""")
_sql("last_seen_sliced", _GAPPY, """
SELECT mmsi, seq, lag(micros) OVER w AS prev_micros, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
FROM gappy WINDOW w AS (PARTITION BY mmsi ORDER BY ts NULLS FIRST, seq)""")

# --- triples ------------------------------------------------------------------------------------


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _iri(s: str, predicate: str, o: str, only: str | None = None) -> str:
    row = f"{{'s': {s}, 'p': {_q(predicate)}, 'o': {o}, 'o_kind': 'iri', 'o_dtype': CAST(NULL AS VARCHAR)}}"
    return f"CASE WHEN {only} THEN {row} END" if only else row


def _lit(s: str, predicate: str, o: str, dtype: str | None = "string", only: str | None = None) -> str:
    kind = _q(XSD + dtype) if dtype else "CAST(NULL AS VARCHAR)"
    row = f"{{'s': {s}, 'p': {_q(IES + predicate)}, 'o': {o}, 'o_kind': 'literal', 'o_dtype': {kind}}}"
    return f"CASE WHEN {only} THEN {row} END" if only else row


def _a(s: str, cls: str, only: str | None = None) -> str:
    return _iri(s, RDF_TYPE, _q(IES + cls), only)


def _rel(s: str, predicate: str, o: str, only: str | None = None) -> str:
    return _iri(s, IES + predicate, o, only)


def _spread(rows: str, triples: list[str], extra: str = "") -> str:
    body = ",\n    ".join(triples)
    return (
        f"SELECT graph_id{extra}, t.s AS s, t.p AS p, t.o AS o, t.o_kind AS o_kind, t.o_dtype AS o_dtype FROM (\n"
        f"  SELECT graph_id{extra}, unnest([{body}]) AS t FROM {rows}\n) WHERE t IS NOT NULL"
    )


def _scheme(node: str, scheme_name: bool = True) -> list[str]:
    scheme, owner = _q(MMSI_SCHEME), _q(ITU)
    named = [
        _a(f"{node} || '-schemeName'", "Name"),
        _lit(f"{node} || '-schemeName'", "representationValue", "'MMSI'"),
        _rel(scheme, "hasName", f"{node} || '-schemeName'"),
        _rel(f"{node} || '-schemeName'", "inScheme", scheme),
    ]
    return [
        _a(scheme, "NamingScheme"),
        *(named if scheme_name else []),
        _a(owner, "Organisation"),
        _a(f"{node} || '-ownerName'", "Name"),
        _lit(f"{node} || '-ownerName'", "representationValue", "'International Telecommunications Union'"),
        _rel(owner, "hasName", f"{node} || '-ownerName'"),
        _rel(scheme, "schemeOwner", owner),
    ]


def _carrier(uri: str, mmsi: str) -> list[str]:
    ident = f"{uri} || '_idObj'"
    return [
        _a(uri, "LocationTransponder"),
        _a(ident, "CommunicationsIdentifier"),
        _lit(ident, "representationValue", mmsi),
        _rel(uri, "isIdentifiedBy", ident),
        _rel(ident, "inScheme", _q(MMSI_SCHEME)),
    ]


def _period(iso: str, only: str | None = None, text: bool = True) -> list[str]:
    uri = f"'{ISO8601}' || {iso}"
    out = [_a(uri, "ParticularPeriod", only)]
    return out + ([_lit(uri, "iso8601PeriodRepresentation", iso, only=only)] if text else [])


def _in(item: str, iso: str, only: str | None = None) -> str:
    return _rel(item, "inPeriod", f"'{ISO8601}' || {iso}", only)


def _bound(state: str, item: str, iso: str, which: str, only: str | None = None) -> list[str]:
    return [_a(state, "BoundingState", only), _rel(state, which, item, only), _in(state, iso, only)]


def _part(node: str, cls: str, whole: str, event: str, only: str | None = None) -> list[str]:
    return [
        _a(node, cls, only), _rel(node, "isParticipationOf", whole, only), _rel(node, "isParticipantIn", event, only)
    ]


def _name(item: str, node: str, text: str, cls: str = "Name", only: str | None = None) -> list[str]:
    return [
        _a(node, cls, only), _lit(node, "representationValue", text, only=only), _rel(item, "hasName", node, only)
    ]


def _ident(item: str, node: str, text: str, cls: str, scheme: str | None = None, only: str | None = None) -> list[str]:
    out = [
        _a(node, cls, only), _lit(node, "representationValue", text, only=only),
        _rel(item, "isIdentifiedBy", node, only),
    ]
    return out + ([_rel(node, "inScheme", scheme, only)] if scheme else [])


def _measure(role: str, cls: str, number: str, unit: str, only: str | None = None) -> list[str]:
    node, val = f"node || '-{role}'", f"node || '-{role}Value'"
    return [
        _a(node, "Measure", only), _rel(node, "measureClass", _q(DATA + cls), only), _a(val, "MeasureValue", only),
        _lit(val, "representationValue", f"CAST({number} AS VARCHAR)", only=only), _rel(node, "hasValue", val, only),
        _rel(val, "measureUnit", _q(DATA + unit), only), _rel("node || '-target'", "observedCharacteristic", node, only),
    ]


def _point(place: str) -> list[str]:
    lat, lon = f"{place} || '_lat'", f"{place} || '_lon'"
    return [
        _a(place, "GeoPoint"), _a(lat, "Latitude"), _a(lon, "Longitude"),
        _rel(place, "isIdentifiedBy", lat), _rel(place, "isIdentifiedBy", lon),
        _lit(lat, "representationValue", "CAST(lat AS VARCHAR)"), _lit(lon, "representationValue", "CAST(lon AS VARCHAR)"),
    ]


_PLACE = f"'{DATA}latlong' || CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR)"


def _geohash(lat: str, lon: str) -> str:
    """Five bits per character, longitude first; bit i of a 60-bit interleaving."""
    x = f"CAST(floor(({lon} + 180) / 360 * 1073741824) AS BIGINT)"
    y = f"CAST(floor(({lat} + 90) / 180 * 1073741824) AS BIGINT)"
    bit = f"((CASE WHEN (c*5+b) % 2 = 0 THEN {x} ELSE {y} END >> CAST(29 - (c*5+b)//2 AS BIGINT)) & 1)"
    code = f"list_sum(list_transform(range(0, 5), lambda b: {bit} << CAST(4 - b AS BIGINT)))"
    return (
        "array_to_string(list_transform(range(0, 12), lambda c: "
        f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({code} AS BIGINT) + 1, 1)), '')"
    )


def _track_sql(full: bool, batched: str = _BATCHED, sparse: bool = False) -> tuple[str, str]:
    """`sparse`: times, positions and measures can be missing; what would say something of them is left out."""
    have = (lambda c: f"{c} IS NOT NULL") if sparse else (lambda c: None)
    place = _PLACE if full else f"'{DATA}geohash_' || geohash"
    tables = batched + f""",
heads AS (
  SELECT *, 'track' || mmsi || '-' || track_no AS graph_id, '{DATA}' || md5('track' || mmsi || '-' || track_no) AS node,
         '{DATA}MMSI_' || mmsi AS carrier, {_iso('min_ts')} AS lo, {_iso('max_ts')} AS hi
  FROM bounds
),
seen AS (
  SELECT *, 'track' || mmsi || '-' || track_no AS graph_id,
         '{DATA}' || md5('track' || mmsi || '-' || track_no || '|' || seq) AS node,
         '{DATA}' || md5('track' || mmsi || '-' || track_no) || '-observation' AS whole,
         '{DATA}MMSI_' || mmsi AS carrier, {_iso('ts')} AS iso, {'NULL' if full else _geohash('lat', 'lon')} AS geohash
  FROM batched
)"""
    whole = "node || '-observation'"
    head = [
        *_scheme("node", full),
        _a(whole, "Observation"),
        *_bound("node || '-start'", whole, "lo", "isStartOf", have("lo")),
        *_bound("node || '-end'", whole, "hi", "isEndOf", have("hi")),
        *_carrier("carrier", "mmsi"),
        *_period("lo", have("lo"), text=full), *_period("hi", have("hi"), text=full),
    ]
    if full:
        head += _part("node || '-target'", "ObservedTarget", "carrier", whole)
        for local, cls, name, role in (
            ("SpeedOverGround", "ClassOfMeasure", "Speed Over Ground", "sogName"),
            ("CourseOverGround", "ClassOfMeasure", "Course Over Ground", "cogName"),
            ("Knots", "UnitOfMeasure", "knots", "knotsName"),
            ("DegreesTrueNorth", "UnitOfMeasure", "degrees true North", "degName"),
        ):
            head += [_a(_q(DATA + local), cls), *_name(_q(DATA + local), f"node || '-{role}'", _q(name))]
    loc = "node || '-location'"
    body = [
        _a(loc, "LocationObservation"), _rel(loc, "isPartOf", "whole"), _in(loc, "iso", have("iso")), *_period("iso", have("iso"), text=full),
        *_part("node || '-target'", "ObservedTarget", "carrier", loc),
        *_part("node || '-place'", "ObservedLocation", place, loc, have("lat + lon")),
        *(f"CASE WHEN {have('lat + lon')} THEN {t} END" if sparse else t for t in _point(place)),
    ]
    if full:
        body += _measure("sog", "SpeedOverGround", "sog", "Knots", have("sog")) + _measure("cog", "CourseOverGround", "cog", "DegreesTrueNorth", have("cog"))
    return tables, f"SELECT DISTINCT * FROM (\n{_spread('heads', head)}\nUNION ALL\n{_spread('seen', body)}\n)"


_sql("track_triples", *_track_sql(True))
_sql("basic_track_triples", *_track_sql(False))
_sql("sparse_track_triples", *_track_sql(True, _GAPPY + """,
sparse AS (
  SELECT * REPLACE (CASE WHEN seq % 13 <> 0 THEN lat END AS lat, CASE WHEN seq % 7 <> 0 THEN sog END AS sog,
                    CASE WHEN seq % 7 > 1 THEN cog END AS cog)
  FROM gappy
)""" + _batches("sparse"), sparse=True))
# A row's number tells its message (of eight) and its place there.
_sql("message_track_triples", *_track_sql(True, _POSITION + """,
twice AS (
  SELECT * REPLACE (seq * 2 AS seq) FROM position
  UNION ALL SELECT * REPLACE (seq * 2 + 1 AS seq) FROM position WHERE seq % 10 = 0
),
sent AS (SELECT *, row_number() OVER (ORDER BY ts, seq) - 1 AS nth FROM twice),
received AS (
  SELECT * EXCLUDE (nth) REPLACE ((nth // 8) * 4194304 + nth % 8 AS seq, CASE WHEN seq % 7 <> 0 THEN sog END AS sog) FROM sent
)""" + _batches("received"), sparse=True))

_PINGS_ONE = _POSITION + f""",
seen AS (
  SELECT *, 'ping' || seq AS graph_id, '{DATA}' || md5('ping' || seq) AS node, '{DATA}MMSI_' || mmsi AS carrier,
         {_iso('ts')} AS iso
  FROM position
)"""
_LOC = "node || '-location'"
_sql("ping_triples", _PINGS_ONE, "SELECT DISTINCT * FROM (" + _spread("seen", [
    *_scheme("node"), *_carrier("carrier", "mmsi"), _a(_LOC, "LocationObservation"), _in(_LOC, "iso"), *_period("iso"),
    *_part("node || '-target'", "ObservedTarget", "carrier", _LOC),
    *_part("node || '-place'", "ObservedLocation", _PLACE, _LOC), *_point(_PLACE),
]) + ")")

# Closed form: 41 + 23 n + 7 d + 2 t triples, of which 18 + 7 n + 3 d + t are types.
_sql("track_triple_counts", _BATCHED, """
SELECT 'track' || mmsi || '-' || track_no AS graph_id,
       41 + 23 * count(*) + 7 * count(DISTINCT (lat, lon)) + 2 * count(DISTINCT ts) AS n_triples,
       18 + 7 * count(*) + 3 * count(DISTINCT (lat, lon)) + count(DISTINCT ts) AS n_objects
FROM batched GROUP BY mmsi, track_no""")

_sql("triple_membership", _BATCHED, f"SELECT seq, '{ISO8601}' || {_iso('ts')} AS s FROM batched")
_sql("triple_union", _POSITION, "SELECT DISTINCT * FROM (" + _spread(
    f"(SELECT 'all' AS graph_id, {_iso('ts')} AS iso FROM position)", [_a(f"'{ISO8601}' || iso", "ParticularPeriod")]
) + ")")


def _band(p: str) -> str:
    return (
        f"'{IES}' || CASE WHEN {p} <= 0.05::DOUBLE THEN 'AssessToBeRemoteChance' WHEN {p} <= 0.225::DOUBLE THEN 'AssessToBeHighlyUnlikely' "
        f"WHEN {p} <= 0.375::DOUBLE THEN 'AssessToBeUnlikely' WHEN {p} <= 0.525::DOUBLE THEN 'AssessToBeRealisticPossibility' "
        f"WHEN {p} <= 0.775::DOUBLE THEN 'AssessToBeLikelyOrProbably' WHEN {p} <= 0.925::DOUBLE THEN 'AssessToBeHighlyLikely' "
        f"ELSE 'AssessToBeAlmostCertain' END"
    )


_sql("assessments_by_band", "", f"""
SELECT {_band('(l_discount * 10.0::DOUBLE)')} AS band, count(*) AS n FROM lineitem GROUP BY 1""")

_sql("geohash_points", _POSITION, f"""
SELECT {_geohash('lat', 'lon')} AS geohash, lat, lon, count(*) AS n_pings, count(DISTINCT mmsi) AS n_vessels
FROM position GROUP BY lat, lon""")

# --- mapping ------------------------------------------------------------------------------------

_CLASSES = f"""CASE vessel_type
  WHEN '1001' THEN ['{IES}VehicleState', '{IES}Observed', '{EXTENSION}CommercialFishingVessel']
  WHEN '1004' THEN ['{IES}VehicleState', '{IES}Observed', '{EXTENSION}FreightShip']
  WHEN '1011' THEN ['{IES}Ship', '{EXTENSION}OilRecoveryVessel']
  ELSE ['{IES}VehicleState', '{IES}Observed'] END"""
_sql("class_map", _POSITION, f"SELECT seq, unnest({_CLASSES}) AS class FROM position")
_sql("class_patterns", _POSITION, f"""
SELECT seq, unnest(CASE
  WHEN regexp_matches(code, '^1[0-9]+c$') THEN ['{IES}Ship', '{EXTENSION}Clicked']
  WHEN regexp_matches(code, '^1') THEN ['{IES}Vessel']
  WHEN regexp_matches(code, '^9[0-9]+s$') THEN ['{EXTENSION}Unknown']
  ELSE ['{IES}VehicleState', '{IES}Observed'] END) AS class
FROM (SELECT seq, vessel_type || substr(status, 1, 1) AS code FROM position)""")
_sql("uri_policy", _POSITION, f"""
SELECT 'guid' AS policy, seq, '{DATA}' || md5('row|' || seq) AS row_uri FROM position
UNION ALL SELECT 'field-guid', seq, '{DATA}' || CASE WHEN imo = '' THEN md5('row|' || seq) ELSE imo END FROM position
UNION ALL SELECT 'field-skip', seq, '{DATA}' || imo FROM position WHERE imo <> ''""")

_STATE = _POSITION + f""",
mapped AS (
  SELECT *, 'msg-' || seq AS graph_id, '{DATA}' || md5('vesselState|msg-' || seq) AS node,
         '{DATA}' || md5('row|msg-' || seq) AS state, {_iso('ts')} AS iso, {_CLASSES} AS classes
  FROM position
)"""
_IMO = f"'{DATA}imo-NamingScheme'"
_VIN = "VehicleIdentificationNumber"
_STATE_TRIPLES = [
    *_scheme("node"),
    _a("node || '-observation'", "Observation"),
    _rel("state", "isParticipantIn", "node || '-observation'"),
    _a(_IMO, "NamingScheme", "imo <> ''"),
    *_ident("state", f"'{DATA}' || imo || 'IMO'", "imo", _VIN, _IMO, "imo <> ''"),
    *_ident("state", "node || '-mmsi'", "mmsi", _VIN, _q(MMSI_SCHEME)),
    *_name("state", "node || '-name'", "vessel_name", "VehicleName", "vessel_name <> ''"),
    *_ident("state", "node || '-callsign'", "call_sign", "Callsign", None, "call_sign <> ''"),
    *_period("iso"), _in("state", "iso"),
    _a("node || '-point'", "GeoPoint"),
    *_ident("node || '-point'", "node || '-lat'", "CAST(lat AS VARCHAR)", "Latitude"),
    *_ident("node || '-point'", "node || '-lon'", "CAST(lon AS VARCHAR)", "Longitude"),
    _rel("state", "inLocation", "node || '-point'"),
    *[_iri("state", RDF_TYPE, f"classes[{i}]", f"len(classes) >= {i}") for i in (1, 2, 3)],
]
_sql("vessel_state_triples", _STATE, "SELECT DISTINCT * FROM (" + _spread("mapped", _STATE_TRIPLES) + ")")

# --- events -------------------------------------------------------------------------------------

_FOLLOWING = _BATCHED + f""",
following AS (
  SELECT 'following-' || mmsi || '-' || track_no AS graph_id, mmsi AS follower,
         CAST(CAST(mmsi AS BIGINT) + 1 AS VARCHAR) AS followed, {_iso('min_ts')} AS lo, {_iso('max_ts')} AS hi,
         CASE WHEN track_no % 3 = 0 THEN '' ELSE 'HAL' END AS sys,
         CASE WHEN track_no % 5 = 0 THEN {_iso('max_ts')} ELSE {_iso("(max_ts + INTERVAL 1 DAY)")} END AS judged_at
  FROM bounds
),
follows AS (
  SELECT *, '{DATA}' || md5('following|' || graph_id) AS node, '{DATA}MMSI_' || follower AS tail,
         '{DATA}MMSI_' || followed AS lead
  FROM following
)"""


def _n(role: str) -> str:
    return f"node || '-{role}'"


_FOLLOW_TRIPLES = "SELECT DISTINCT * FROM (" + _spread("follows", [
    *_scheme("node"), _a(_n("follow"), "Follow"),
    *_bound(_n("start"), _n("follow"), "lo", "isStartOf"), *_bound(_n("end"), _n("follow"), "hi", "isEndOf"),
    *_carrier("tail", "follower"), *_carrier("lead", "followed"),
    *_part(_n("follower"), "Follower", "tail", _n("follow")), *_part(_n("followed"), "Followed", "lead", _n("follow")),
    _a(_n("system"), "System", "sys <> ''"), *_name(_n("system"), _n("systemName"), "sys", only="sys <> ''"),
    _a(_n("world"), "PossibleWorld", "sys <> ''"), _rel(_n("follow"), "isPartOf", _n("world"), "sys <> ''"),
    _a(_n("assessment"), "Assess", "sys <> ''"), _rel(_n("assessment"), "assessed", _n("world"), "sys <> ''"),
    *_part(_n("assessor"), "Assessor", _n("system"), _n("assessment"), "sys <> ''"),
    _in(_n("assessment"), "judged_at", "sys <> ''"), *_period("lo"), *_period("hi"), *_period("judged_at", "sys <> ''"),
]) + ")"
_sql("following_triples", _FOLLOWING, _FOLLOW_TRIPLES)
_sql("ntriples_roundtrip", _FOLLOWING, _FOLLOW_TRIPLES)

_GRAPH_LINES = _FOLLOWING + f""",
triples AS ({_FOLLOW_TRIPLES}),
lines AS (
  SELECT graph_id, '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>'
         ELSE '"' || o || '"' || CASE WHEN o_dtype IS NULL THEN '' ELSE '^^<' || o_dtype || '>' END END || ' .' AS line
  FROM triples
)"""
_sql("graph_messages", _GRAPH_LINES, """
SELECT graph_id, count(*) AS n_triples, string_agg(line, chr(10) ORDER BY line) AS text FROM lines GROUP BY graph_id""")


def _brief(uri: str) -> str:
    return (
        f"CASE WHEN {uri} LIKE '{IES}%' THEN 'ies:' || substr({uri}, {len(IES) + 1}) "
        f"WHEN {uri} LIKE '{ISO8601}%' AND {uri} NOT LIKE '%.%.%.%' AND regexp_matches(substr({uri}, {len(ISO8601) + 1}), "
        f"'^[A-Za-z0-9_][A-Za-z0-9_:-]*$') THEN 'iso8601:' || substr({uri}, {len(ISO8601) + 1}) "
        f"WHEN {uri} LIKE '{DATA}%' THEN 'data:' || substr({uri}, {len(DATA) + 1}) ELSE '<' || {uri} || '>' END"
    )


_sql("turtle_graphs", _FOLLOWING + f""",
triples AS ({_FOLLOW_TRIPLES}),
pairs AS (
  SELECT graph_id, {_brief('s')} AS subject, p <> '{RDF_TYPE}' AS later,
         CASE WHEN p = '{RDF_TYPE}' THEN 'a' ELSE {_brief('p')} END || ' ' ||
         CASE WHEN o_kind = 'iri' THEN {_brief('o')} ELSE '"' || o || '"^^xsd:string' END AS pair
  FROM triples
),
blocks AS (
  SELECT graph_id, subject || ' ' || string_agg(pair, ' ;' || chr(10) || '    ' ORDER BY later, pair) || ' .' AS block
  FROM pairs GROUP BY graph_id, subject
)""", f"""
SELECT graph_id, count(*) AS n_subjects,
       '@prefix data: <{DATA}> .' || chr(10) || '@prefix ies: <{IES}> .' || chr(10) ||
       '@prefix iso8601: <{ISO8601}> .' || chr(10) || '@prefix xsd: <{XSD}> .' || chr(10) || chr(10) ||
       string_agg(block, chr(10) || chr(10) ORDER BY block) || chr(10) AS text
FROM blocks GROUP BY graph_id""")

_sys = _q(ANALYTICS_DATA + "TrackAnalytics")


def _assess(node: str, items: list[str], band: str, prob: str, at: str) -> list[str]:
    world, act, p, who = (f"{node} || '-{r}'" for r in ("world", "assessment", "probability", "assessor"))
    return [
        _a(world, "PossibleWorld"), _iri(act, RDF_TYPE, band), _rel(act, "assessed", world),
        _a(p, "ProbabilityRepresentation"), _lit(p, "representationValue", f"CAST({prob} AS VARCHAR)", "float"),
        _rel(act, "hasRepresentation", p), _a(who, "Assessor"), _rel(who, "isParticipantIn", act),
        _rel(who, "isParticipationOf", _sys), *[_rel(i, "isPartOf", world) for i in items], _in(act, at), *_period(at),
    ]


def _vessel_sql(mmsi: str) -> list[str]:
    uri = f"'{ANALYTICS_DATA}_vessel_mmsi_' || {mmsi}"
    return [*_ident(uri, f"{uri} || '_idObj'", mmsi, "CommunicationsIdentifier", _q(MMSI_SCHEME)), _a(uri, "Vessel")]


_COOPERING = _BATCHED + f""",
meet AS (
  SELECT *, 'coopering-' || mmsi || '-' || track_no AS graph_id,
         '{ANALYTICS_DATA}' || md5('coopering|coopering-' || mmsi || '-' || track_no) AS node,
         {_iso('min_ts')} AS lo, {_iso('max_ts')} AS hi, {_iso("(max_ts + INTERVAL 1 DAY)")} AS judged_at,
         CAST(track_no % 21 AS DOUBLE) / 20 AS prob
  FROM bounds
),
banded AS (
  SELECT *, CASE WHEN track_no % 3 <> 0 THEN {_band('prob')} ELSE '{IES}AssessProbability' END AS band FROM meet
),
vessels AS (
  SELECT graph_id, node, i,
         CASE i WHEN 1 THEN mmsi WHEN 2 THEN CAST(CAST(mmsi AS BIGINT) + 1 AS VARCHAR)
           ELSE CASE WHEN track_no % 6 = 0 THEN mmsi ELSE CAST(CAST(mmsi AS BIGINT) + 2 AS VARCHAR) END END AS vessel,
         CASE WHEN i < 3 THEN lo WHEN track_no % 4 = 0 THEN NULL ELSE hi END AS "from",
         CASE WHEN track_no % 7 = 0 THEN NULL WHEN i = 2 AND track_no % 2 <> 1 THEN NULL ELSE hi END AS until
  FROM banded, range(1, 4) AS r(i)
)"""
_cp = "node || '-' || i || '-coopering'"
_sql("coopering_triples", _COOPERING, "SELECT DISTINCT * FROM (" + _spread("banded", [
    *_scheme("node"), _a(_sys, "System"), _a(_n("cooper"), "CooperAtSea"),
    *_bound(_n("start"), _n("cooper"), "lo", "isStartOf", "track_no % 5 <> 0"), *_period("lo", "track_no % 5 <> 0"),
    *_bound(_n("end"), _n("cooper"), "hi", "isEndOf"), *_period("hi"),
    *_assess("node", [_n("cooper")], "band", "prob", "judged_at"),
]) + "\nUNION ALL\n" + _spread("vessels", [
    *_vessel_sql("vessel"), _a(_cp, "CooperingAtSea"), _rel(_cp, "isParticipantIn", _n("cooper")),
    _rel(_cp, "isParticipationOf", f"'{ANALYTICS_DATA}_vessel_mmsi_' || vessel"), _rel(_cp, "isPartOf", _n("world")),
    *_bound("node || '-' || i || '-start'", _cp, '"from"', "isStartOf", '"from" IS NOT NULL'),
    *_period('"from"', '"from" IS NOT NULL'),
    *_bound("node || '-' || i || '-end'", _cp, "until", "isEndOf", "until IS NOT NULL"),
    *_period("until", "until IS NOT NULL"),
]) + ")")

_DESTINATION = f"""
cust AS (
  SELECT c_custkey, 'destination-' || c_custkey AS graph_id, CAST(300000000 + c_custkey AS VARCHAR) AS mmsi,
         '{ANALYTICS_DATA}' || md5('destination|destination-' || c_custkey) AS base, c_nationkey,
         {_iso("(TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey AS BIGINT)))")} AS judged_at
  FROM customer
),
candidates AS (
  SELECT cust.*, base || '-' || (i + 1) AS node, i, n_name AS port_name,
         CASE WHEN i = 2 AND c_custkey % 4 = 0 THEN '' ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ' P' || i END AS locode,
         CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso3,
         CASE i WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.3::DOUBLE ELSE 0.2::DOUBLE END AS prob
  FROM cust, range(0, 3) AS r(i), nation WHERE n_nationkey = (c_nationkey + 7 * i) % 25
),
ports AS (
  SELECT *, CASE WHEN locode = '' THEN node || '-port' ELSE '{LOCODE}' || replace(locode, ' ', '') END AS port,
         '{ISO3166}' || iso3 AS country, {_band('prob')} AS band
  FROM candidates
)"""
_sql("destination_triples", _DESTINATION, "SELECT DISTINCT * FROM (" + _spread("cust", [
    *_scheme("base"), _a(_sys, "System"), *_vessel_sql("mmsi"), *_period("judged_at"),
]) + "\nUNION ALL\n" + _spread("ports", [
    _a("port", "Port"), *_name("port", _n("portName"), "port_name", "PlaceName"),
    *_ident("port", _n("portCode"), "locode", "UN_LOCODE", None, "locode <> ''"),
    _a("country", "Country", "iso3 <> ''"),
    *_ident("country", "country || '_code'", "iso3", "ISO3166Alpha_3", None, "iso3 <> ''"),
    _rel("port", "isPartOf", "country", "iso3 <> ''"), _a(_n("sailing"), "Sailing"),
    *_part(_n("vehicle"), "VehicleUsed", f"'{ANALYTICS_DATA}_vessel_mmsi_' || mmsi", _n("sailing")),
    _a(_n("arrival"), "Arrival"), _rel(_n("arrival"), "isEndOf", _n("sailing")),
    _rel(_n("arrival"), "inLocation", "port"),
    *_assess("node", [_n("sailing"), _n("vehicle"), _n("arrival")], "band", "prob", "judged_at"),
]) + ")")

# --- messages -----------------------------------------------------------------------------------

_PACKED = _POSITION + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY ts, seq) - 1 AS rn, {_iso('ts')} AS iso FROM position)"""


def _json_row() -> str:
    q = lambda c: f"'\"' || {c} || '\"'"
    v = lambda c: f"CAST({c} AS VARCHAR)"
    parts = [
        q("mmsi"), q("iso"), v("lat"), v("lon"), v("sog"), v("cog"), v("heading"), q("vessel_name"), q("imo"),
        q("call_sign"), q("vessel_type"), q("status"), v("length"), v("width"), v("draft"), "'null'",
    ]
    return "'[' || " + " || ',' || ".join(parts) + " || ']'"


_sql("pack_messages", _PACKED, f"""
SELECT rn // 8 AS batch_id, CAST(count(*) AS INTEGER) AS n_rows,
       '[' || string_agg({_json_row()}, ',' ORDER BY rn) || ']' AS text
FROM placed GROUP BY 1""")
_sql("pack_messages_compat", _PACKED, """
SELECT rn // 7 AS batch_id, count(*) AS n_rows, min(seq) AS first_seq FROM placed
WHERE rn // 7 < (SELECT round_even(count(*) / CAST(7 AS DOUBLE), 0) FROM placed) GROUP BY 1""")
_sql("oz_csv_messages", _PACKED, """
SELECT rn // 8 AS batch_id, CAST(count(*) AS INTEGER) AS n_rows,
       string_agg(concat_ws(',', mmsi, lon, lat, cog, sog, vessel_type, '', length, width, draft, iso, vessel_name, imo, call_sign)
                  || chr(13) || chr(10), '' ORDER BY rn) AS text
FROM placed GROUP BY 1""")
_sql("message_roundtrip", _PACKED, """
SELECT 'pings:0:' || (rn // 8) AS graph_id, rn % 8 AS place, mmsi, micros, lat, lon, sog, cog, vessel_name, imo,
       call_sign, vessel_type
FROM placed""")
_STATE_JSON = (
    "'{\"timestamp\":\"' || iso || '\",\"coordinates\":[' || lat || ',' || lon || '],\"epsgCode\":\"4326\","
    "\"velocityVector\":[' || sog || ',' || sog || ']}'"
)
_sql("track_json", _BATCHED, f"""
SELECT mmsi || '-' || track_no AS track_id, CAST(count(*) AS INTEGER) AS n_states,
       '{{"metadata":{{"mmsi":"' || mmsi || '"}},"states":[' || string_agg({_STATE_JSON}, ',' ORDER BY ts) || ']}}' AS text
FROM (SELECT *, {_iso('ts')} AS iso FROM batched) GROUP BY mmsi, track_no""")
_sql("track_messages", _BATCHED, """
SELECT mmsi, mmsi || '-' || track_no AS track_id,
       CAST(row_number() OVER (PARTITION BY mmsi, track_no ORDER BY ts) - 1 AS INTEGER) AS step, micros, lat, lon,
       '4326' AS epsg, CAST(2 AS INTEGER) AS n_velocity
FROM batched""")
_sql("dead_letters", _POSITION, """
SELECT CASE WHEN seq % 13 = 0 THEN 'not a JSON array' ELSE 'bad position' END AS error, count(*) AS n
FROM position WHERE seq % 13 = 0 OR seq % 17 = 0 GROUP BY 1""")

_sql("escaped_roundtrip", "", f"""
SELECT doc_id, 'http://example.org/doc#' || doc_id AS s, 'http://example.org/text' AS p, sha256(text) AS text_sha256, 'literal' AS o_kind,
       CASE doc_id % 3 WHEN 0 THEN '@' || lang WHEN 1 THEN '{XSD}string' END AS o_dtype
FROM documents WHERE text IS NOT NULL""")

# --- monitor ------------------------------------------------------------------------------------

_WATCHED = _STATE.replace("AS graph_id,", "AS graph_id, seq AS msg_id,", 1) + f""",
watched AS (SELECT DISTINCT * FROM ({_spread('mapped', _STATE_TRIPLES, ', msg_id, micros')})),
per_message AS (
  SELECT msg_id, min(micros) AS micros, count(*) AS trip_count, count(*) FILTER (p = '{RDF_TYPE}') AS obj_count
  FROM watched GROUP BY msg_id
),
per_class AS (
  SELECT msg_id, min(micros) AS micros, o AS class, count(*) AS n FROM watched WHERE p = '{RDF_TYPE}' GROUP BY msg_id, o
),
rated AS (
  SELECT *, CASE WHEN micros > min(micros) OVER w THEN
           sum(n) OVER w / (CAST(micros - min(micros) OVER w AS DOUBLE) / 1000000) END AS rate
  FROM per_class WINDOW w AS (PARTITION BY class ORDER BY micros, msg_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
),
newest AS (
  SELECT class, arg_max(rate, (micros, msg_id)) AS rate, CAST(sum(n) AS BIGINT) AS total FROM rated GROUP BY class
)"""
_sql("mapped_dead_letters", _WATCHED + """,
told AS (
  SELECT *, (row_number() OVER (ORDER BY ts, seq) - 1) // 8 AS batch FROM position
),
judged AS (
  SELECT *, CASE WHEN seq % 23 = 0 THEN 'no vessel id' WHEN seq % 19 = 0 THEN 'bad timestamp' WHEN seq % 17 = 0 THEN 'bad position' END AS error
  FROM told WHERE batch % 29 <> 0 AND batch % 31 <> 1
)""", """
SELECT 'body cannot be decoded' AS kind, count(DISTINCT batch) AS n FROM told WHERE batch % 29 = 0 HAVING count(*) > 0
UNION ALL SELECT 'not a JSON array', count(DISTINCT batch) FROM told WHERE batch % 31 = 1 AND batch % 29 <> 0 HAVING count(*) > 0
UNION ALL SELECT error, count(*) FROM judged WHERE error IS NOT NULL GROUP BY error
UNION ALL SELECT 'graphs sent', count(*) FROM judged WHERE error IS NULL
UNION ALL SELECT 'triples sent', CAST(sum(trip_count) AS BIGINT) FROM judged JOIN per_message ON msg_id = seq WHERE error IS NULL
UNION ALL SELECT 'lines refused', 0""")
_sql("message_counts", _WATCHED, "SELECT msg_id, trip_count, obj_count FROM per_message")
_sql("monitored_messages", _WATCHED, """
SELECT 'pings:0:' || (rn // 8) || ':' || (rn % 8) AS msg_id, trip_count, obj_count
FROM (SELECT *, row_number() OVER (ORDER BY micros, msg_id) - 1 AS rn FROM per_message)""")
_sql("class_counts", _WATCHED, "SELECT msg_id, class, n FROM per_class")
_sql("message_totals", _WATCHED, """
SELECT count(*) AS messages, CAST(sum(trip_count) AS BIGINT) AS triples, CAST(sum(obj_count) AS BIGINT) AS objects
FROM per_message""")
_sql("streamed_counts", _WATCHED, "SELECT msg_id, trip_count, obj_count, 0 AS bad_lines FROM per_message")
_sql("streamed_rates", _WATCHED + """,
told AS (
  SELECT 'messages' AS name, msg_id, micros, trip_count AS first, obj_count AS second FROM per_message
  UNION ALL SELECT class, msg_id, micros, n, 0 FROM per_class
),
last_few AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY name ORDER BY micros DESC, msg_id DESC) <= 5),
rates AS (
  SELECT name, CASE WHEN max(micros) > min(micros) THEN CAST(max(micros) - min(micros) AS DOUBLE) / 1000000 END AS span,
         count(*) AS m, sum(first) AS a, sum(second) AS b FROM last_few GROUP BY name
)""", """
SELECT name, count(*) AS messages, CAST(sum(first) AS BIGINT) AS first, CAST(sum(second) AS BIGINT) AS second,
       round(any_value(m) / any_value(span), 6) AS msg_rate, round(any_value(a) / any_value(span), 6) AS first_rate,
       round(any_value(b) / any_value(span), 6) AS second_rate
FROM told JOIN rates USING (name) GROUP BY name""")
_sql("class_totals", _WATCHED, "SELECT class, total FROM newest")


def _rate(amount: str) -> str:
    return (
        f"CASE WHEN micros > min(micros) OVER w THEN round({amount} OVER w / "
        f"(CAST(micros - min(micros) OVER w AS DOUBLE) / 1000000), 6) END"
    )


_sql("rolling_rate", _WATCHED, f"""
SELECT msg_id, trip_count, obj_count, {_rate('sum(trip_count)')} AS trip_rate, {_rate('sum(obj_count)')} AS obj_rate,
       {_rate('count(*)')} AS msg_rate
FROM per_message WINDOW w AS (ORDER BY micros, msg_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
_sql("rolling_rate_sliced", _WATCHED + """,
late AS (SELECT * REPLACE (CASE WHEN msg_id % 11 <> 0 THEN micros END AS micros) FROM per_message)""", f"""
SELECT msg_id, trip_count, obj_count, {_rate('sum(trip_count)')} AS trip_rate, {_rate('sum(obj_count)')} AS obj_rate,
       {_rate('count(*)')} AS msg_rate
FROM late WINDOW w AS (ORDER BY micros NULLS FIRST, msg_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
_sql("class_rolling_rate", _WATCHED, "SELECT msg_id, class, n, round(rate, 6) AS rate FROM rated")
_SHORT = f"CASE WHEN class LIKE '{IES}%' THEN 'ies:' || substr(class, {len(IES) + 1}) ELSE class END"
_sql("class_labels", _WATCHED, f"SELECT class, {_SHORT} || ' (' || total || ')' AS label FROM newest ORDER BY class DESC")
_sql("rate_bars", _WATCHED, f"""
SELECT class, {_SHORT} AS short_name, '{IES}' AS namespace, round(rate, 6) AS rate FROM newest
WHERE class IN ('{IES}Observation', '{IES}VehicleName', '{IES}Callsign', '{IES}GeoPoint', '{IES}Ship')
ORDER BY short_name, class""")

# --- tracker ------------------------------------------------------------------------------------

_sql("time_sync", _COMPRESSED, "SELECT mmsi, step, count(*) AS n_pings FROM synced GROUP BY mmsi, step")
_sql("latest_per_vessel", _COMPRESSED, "SELECT mmsi, step, micros, seq, lat, lon FROM latest")
_sql("sessions", _COMPRESSED + """,
flagged AS (
  SELECT *, CASE WHEN micros - lag(micros) OVER w <= 600000000 THEN 0 ELSE 1 END AS opens
  FROM squeezed WINDOW w AS (PARTITION BY mmsi ORDER BY micros, seq)
),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY mmsi ORDER BY micros, seq) AS no FROM flagged)""", """
SELECT mmsi, CAST(no AS BIGINT) AS session_no, min(micros) AS start_micros, max(micros) AS end_micros, count(*) AS n_pings
FROM grouped GROUP BY mmsi, no""")
ORACLE["sessions_sliced"] = ORACLE["sessions"].replace("FROM squeezed WINDOW", "FROM squeezed WHERE seq % 11 <> 0 WINDOW")


def _utm_tables() -> str:
    """Forward and inverse projection in steps, with the zone of the first detection."""
    flat = 1 / 298.257223563
    n = flat / (2 - flat)
    r = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    c = 2 * n**0.5 / (1 + n)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    num = lambda v: f"CAST({v!r} AS DOUBLE)"
    series = lambda k, f, g, a, b: " + ".join(
        f"{num(v)} * {f}({2 * j} * {a}) * {g}({2 * j} * {b})" for j, v in enumerate(k, 1)
    )
    chi = " + ".join(f"{num(v)} * sin({2 * j} * chi)" for j, v in enumerate(delta, 1))
    return f""",
meridian AS (
  SELECT 6 * (CAST(floor((arg_min(lon, (micros, seq)) + 180) / 6) AS INTEGER) + 1) - 183 AS lon0 FROM squeezed
),
angles AS (
  SELECT latest.*, radians(lon - lon0) AS dl, sin(radians(lat)) AS s, lon0 FROM latest, meridian
),
conformal AS (SELECT *, sinh(atanh(s) - {num(c)} * atanh({num(c)} * s)) AS tt FROM angles),
gauss AS (SELECT *, atan2(tt, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + tt * tt)) AS eta FROM conformal),
projected AS (
  SELECT mmsi, step, micros, seq, lon0,
         500000 + {num(r)} * (eta + {series(alpha, 'cos', 'sinh', 'xi', 'eta')}) AS x,
         {num(r)} * (xi + {series(alpha, 'sin', 'cosh', 'xi', 'eta')}) AS y
  FROM gauss
)""", f"""
  inv0 AS (SELECT *, y / {num(r)} AS xi, (x - 500000) / {num(r)} AS eta FROM __SOURCE__),
  inv1 AS (
    SELECT *, xi - ({series(beta, 'sin', 'cosh', 'xi', 'eta')}) AS xi1,
           eta - ({series(beta, 'cos', 'sinh', 'xi', 'eta')}) AS eta1
    FROM inv0
  ),
  inv2 AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM inv1),
  located AS (
    SELECT *, degrees(chi + {chi}) AS lat, lon0 + degrees(atan2(sinh(eta1), cos(xi1))) AS lon FROM inv2
  )"""


_FORWARD, _INVERSE = _utm_tables()
_PROJECTED = _COMPRESSED + _FORWARD
_sql("projected_detections", _PROJECTED + "," + _INVERSE.replace("__SOURCE__", "projected"), """
SELECT mmsi, step, round(x, 2) AS x, round(y, 2) AS y, round(lat, 6) AS lat, round(lon, 6) AS lon FROM located""")

# One level of recursion feeds the next detection of every vessel to its live tracks.
_AXIS = "m DOUBLE, v DOUBLE, pm DOUBLE, pc DOUBLE, pv DOUBLE"
_LIVE = f"STRUCT(id VARCHAR, seen BIGINT, a STRUCT({_AXIS}), b STRUCT({_AXIS}))"


def _decay(rate: str, dt: str) -> str:
    """1 - exp(-rate * dt) without cancellation: 2 exp(-a/2) sinh(a/2)."""
    half = f"({rate}::DOUBLE * {dt} / 2)"
    return f"(2 * exp(-{half}) * sinh({half}))"


def _ahead(axis: str) -> str:
    g, d = "f.g", "f.d"
    p = f"f.t.{axis}"
    return (
        f"{{'m': {p}.m + {g} * {p}.v, 'v': {d} * {p}.v, "
        f"'pm': {p}.pm + 2 * {g} * {p}.pc + {g} * {g} * {p}.pv + f.qm, "
        f"'pc': {d} * ({p}.pc + {g} * {p}.pv) + f.qc, 'pv': {d} * {d} * {p}.pv + f.qv}}"
    )


def _corrected(axis: str, z: str) -> str:
    p = f"best.{axis}"
    s = f"({p}.pm + 15)"
    return (
        f"{{'m': {p}.m + {p}.pm / {s} * ({z} - {p}.m), 'v': {p}.v + {p}.pc / {s} * ({z} - {p}.m), "
        f"'pm': {p}.pm - {p}.pm / {s} * {p}.pm, 'pc': {p}.pc - {p}.pm / {s} * {p}.pc, "
        f"'pv': {p}.pv - {p}.pc / {s} * {p}.pc}}"
    )


def _fresh(z: str) -> str:
    zero, noise, speed = ("CAST(%s AS DOUBLE)" % v for v in (0, 15, 10))
    return f"{{'m': {z}, 'v': {zero}, 'pm': {noise}, 'pc': {zero}, 'pv': {speed}}}"


_TRACKER = _PROJECTED + f""",
detections AS (
  SELECT mmsi, micros, x, y, lon0, row_number() OVER (PARTITION BY mmsi ORDER BY micros) AS rn FROM projected
),
fold AS (
  SELECT DISTINCT mmsi, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS micros, CAST(NULL AS DOUBLE) AS lon0,
         CAST([] AS {_LIVE}[]) AS live, CAST(NULL AS {_LIVE}) AS one, '' AS kind
  FROM detections
  UNION ALL
  SELECT mmsi, rn, micros, lon0,
         list_append(list_filter(alive, lambda o: o.id <> one.id), one) AS live, one, kind
  FROM (
    SELECT *, CASE WHEN hit THEN
             {{'id': best.id, 'seen': micros, 'a': {_corrected('a', 'x')}, 'b': {_corrected('b', 'y')}}}
           ELSE {{'id': mmsi || '-' || micros, 'seen': micros, 'a': {_fresh('x')}, 'b': {_fresh('y')}}} END AS one,
           CASE WHEN hit THEN 'update' ELSE 'init' END AS kind
    FROM (
      SELECT *, coalesce(best.dist < 3, false) AS hit FROM (
        SELECT *, list_sort(list_transform(ahead, lambda h: {{
            'dist': sqrt((x - h.a.m) * (x - h.a.m) / (h.a.pm + 15) + (y - h.b.m) * (y - h.b.m) / (h.b.pm + 15)),
            'id': h.id, 'a': h.a, 'b': h.b}}))[1] AS best
        FROM (
          SELECT *, list_transform(list_transform(list_transform(alive, lambda t: {{
              't': t, 'dt': CAST(micros - t.seen AS DOUBLE) / 1000000,
              'e1': {_decay('0.0001', '(CAST(micros - t.seen AS DOUBLE) / 1000000)')},
              'e2': {_decay('0.0002', '(CAST(micros - t.seen AS DOUBLE) / 1000000)')}}}),
            lambda e: {{'t': e.t, 'g': e.e1 / 0.0001::DOUBLE, 'd': 1 - e.e1,
              'qm': CASE WHEN e.dt >= 1 THEN 0.5 * (e.dt - 2 * e.e1 / 0.0001::DOUBLE + e.e2 / 0.0002::DOUBLE) / 0.00000001::DOUBLE
                    ELSE 0.5 * (e.dt**3 / 3 - 0.0001::DOUBLE * e.dt**4 / 4) END,
              'qc': CASE WHEN e.dt >= 1 THEN 0.5 * (e.e1 / 0.0001::DOUBLE - e.e2 / 0.0002::DOUBLE) / 0.0001::DOUBLE
                    ELSE 0.5 * (e.dt**2 / 2 - 0.0001::DOUBLE * e.dt**3 / 2) END,
              'qv': CASE WHEN e.dt >= 1 THEN 0.5 * e.e2 / 0.0002::DOUBLE ELSE 0.5 * (e.dt - 0.0001::DOUBLE * e.dt**2) END}}),
            lambda f: {{'id': f.t.id, 'a': {_ahead('a')}, 'b': {_ahead('b')}}}) AS ahead
          FROM (
            SELECT d.mmsi, d.rn, d.micros, d.x, d.y, d.lon0,
                   list_filter(fold.live, lambda t: d.micros - t.seen <= 600000000) AS alive
            FROM fold JOIN detections d ON d.mmsi = fold.mmsi AND d.rn = fold.rn + 1
          )
        )
      )
    )
  )
),
states AS (
  SELECT one.id AS track_id, mmsi, micros, lon0, kind, one.a.m AS x, one.a.v AS vx, one.b.m AS y, one.b.v AS vy,
         one.a.pm AS p_xx, one.a.pc AS p_xv, one.a.pv AS p_vv
  FROM fold WHERE rn > 0
)"""
_sql("kalman_tracks", _TRACKER, """
SELECT track_id, mmsi, micros, kind, round(x, 2) AS x, round(vx, 2) AS vx, round(y, 2) AS y, round(vy, 2) AS vy,
       round(p_xx, 2) AS p_xx, round(p_xv, 2) AS p_xv, round(p_vv, 2) AS p_vv
FROM states""")
_sql("track_counts", _TRACKER, """
SELECT count(DISTINCT track_id) AS tracks, count(DISTINCT mmsi) AS vessels, count(*) AS states FROM states""")
_sql("predicted_states", _TRACKER + """,
gaps AS (
  SELECT *, coalesce(lead(micros) OVER (PARTITION BY track_id ORDER BY micros) - micros, 600000000) AS gap FROM states
),
grid AS (SELECT gaps.*, g.dt AS dt FROM gaps, range(60, 601, 60) AS g(dt) WHERE g.dt * 1000000 < gap)""", f"""
SELECT track_id, mmsi, micros + dt * 1000000 AS micros,
       round(x + {_decay('0.0001', 'dt')} / 0.0001::DOUBLE * vx, 2) AS x,
       round(y + {_decay('0.0001', 'dt')} / 0.0001::DOUBLE * vy, 2) AS y
FROM grid""")
_sql("track_polylines", _TRACKER + "," + _INVERSE.replace("__SOURCE__", "states"), """
SELECT track_id, mmsi, CAST(count(*) AS INTEGER) AS n_points, round(arg_max(lat, micros), 6) AS last_lat,
       round(arg_max(lon, micros), 6) AS last_lon
FROM located GROUP BY track_id, mmsi""")

_WHOLE = f"'{FILTER_DATA}' || graph_id"
_CARRIER = f"'{FILTER_DATA}_MMSI_' || mmsi"
_ISO_MICROS = lambda c: _iso(f"make_timestamp({c})")
_sql("filtered_track_triples", _TRACKER + f""",
steps AS (
  SELECT track_id AS graph_id, mmsi, {_ISO_MICROS('micros')} AS iso, round(x, 2) AS px, round(y, 2) AS py,
         '{FILTER_DATA}' || md5('filtered|' || track_id || '|' || micros) AS node
  FROM states
),
tops AS (
  SELECT track_id AS graph_id, mmsi, '{FILTER_DATA}' || md5('filtered|' || track_id) AS node,
         {_ISO_MICROS('min(micros)')} AS lo, {_ISO_MICROS('max(micros)')} AS hi
  FROM states GROUP BY track_id, mmsi
)""", "SELECT DISTINCT * FROM (" + _spread("tops", [
    _a(_WHOLE, "Observation"), *_carrier(_CARRIER, "mmsi"),
    *_bound(_n("start"), _WHOLE, "lo", "isStartOf"), *_bound(_n("end"), _WHOLE, "hi", "isEndOf"),
]) + "\nUNION ALL\n" + _spread("steps", [
    _a(_LOC, "LocationObservation"), _rel(_LOC, "isPartOf", _WHOLE), _in(_LOC, "iso"), *_period("iso"),
    *_part(_n("target"), "ObservedTarget", _CARRIER, _LOC), _a(_n("point"), "GeoPoint"),
    _a(_n("representation"), "EpsgGeoPointRepresentation"),
    _rel(_n("point"), "isIdentifiedBy", _n("representation")),
    *_part(_n("place"), "ObservedLocation", _n("point"), _LOC),
    *[x for i, c in ((1, "px"), (2, "py")) for x in (
        _a(_n(f"param{i}"), f"EpsgParameter{i}"), _rel(_n(f"param{i}"), "inRepresentation", _n("representation")),
        _lit(_n(f"param{i}"), "representationValue", f"CAST({c} AS VARCHAR)", None),
    )],
]) + ")")

# --- streams ------------------------------------------------------------------------------------

ORACLE["streamed_last_seen"] = ORACLE["last_seen"]
ORACLE["streamed_tracks"] = ORACLE["kalman_tracks"]
ORACLE["gathered_graph_messages"] = ORACLE["graph_messages"]
ORACLE["monitored_triples"] = ORACLE["monitored_messages"]
ORACLE["graph_files_roundtrip"] = ORACLE["following_triples"]
_sql("open_tracks_late", _POSITION + """,
halved AS (SELECT * REPLACE (CASE WHEN seq % 2 = 0 THEN '200000000' ELSE mmsi END AS mmsi) FROM position),
paused AS (
  SELECT *, CASE WHEN micros - lag(micros) OVER (PARTITION BY mmsi ORDER BY micros, seq) <= 86400000000 THEN 0 ELSE 1 END AS opens FROM halved
),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY mmsi ORDER BY micros, seq) AS run FROM paused),
placed AS (SELECT *, (row_number() OVER (PARTITION BY mmsi, run ORDER BY micros, seq) - 1) // 4 AS part FROM runs),
built AS (
  SELECT mmsi, run, part, count(*) = 4 AS finished, min(micros) AS min_micros, max(micros) AS max_micros,
         string_agg(CAST(seq AS VARCHAR), ',' ORDER BY micros, seq) AS seqs FROM placed GROUP BY mmsi, run, part
)""", """
SELECT mmsi, row_number() OVER (PARTITION BY mmsi ORDER BY run, part) - 1 AS track_no, finished, min_micros, max_micros, seqs FROM built""")
_sql("track_union", _TRACKER, """
SELECT track_id, mmsi, min(micros) AS first_micros, max(micros) AS last_micros, count(*) AS n_states FROM states GROUP BY track_id, mmsi""")

# --- further checks -----------------------------------------------------------------------------

_sql("craft_files", _POSITION, """
SELECT mmsi, micros // 1000000 * 1000000 AS micros, lat, lon, sog, cog, vessel_type, length, width, draft, '' AS imo, '' AS vessel_name FROM position""")
_sql("rate_bar_labels", _WATCHED, f"""
SELECT class, {_SHORT} AS short_name, 'rate=' || CAST(round_even(rate, 2) AS VARCHAR) || ' count=' || total AS label FROM newest""")
_sql("polyline_parts", _TRACKER + "," + _INVERSE.replace("__SOURCE__", "states") + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY micros) - 1 AS rn FROM located)""", """
SELECT track_id, mmsi, rn // 5 AS part, CAST(rn % 5 AS INTEGER) AS place, round(lat, 6) AS lat, round(lon, 6) AS lon FROM placed
UNION ALL SELECT track_id, mmsi, rn // 5 - 1, 5, round(lat, 6), round(lon, 6) FROM placed WHERE rn % 5 = 0 AND rn > 0""")
_sql("triple_union_of_kinds", _BATCHED, "SELECT DISTINCT * FROM (" + " UNION ALL ".join([
    _spread(f"(SELECT 'all' AS graph_id, {_iso('ts')} AS iso, lat, lon FROM position)", [_a(f"'{ISO8601}' || iso", "ParticularPeriod"), _a(_PLACE, "GeoPoint")]),
    _spread("(SELECT 'all' AS graph_id, mmsi, track_no FROM bounds)", [_a(f"'{DATA}' || md5('track' || mmsi || '-' || track_no) || '-observation'", "Observation")]),
]) + ")")
