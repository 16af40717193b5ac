"""Rows to graphs: tracks, filtered tracks, events and vessel states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import text as tx
from ..vocab import ANALYTICS_DATA, DATA, FILTER_DATA, MMSI_SCHEME, RDF_TYPE
from . import triples as tr
from .triples import Pattern, var


def _node(data_uri: str, *key: Column) -> Column:
    """Stem of the names of a row's nodes; roles are appended to it."""
    return F.concat(F.lit(data_uri), tx.hashed(*key))


def _unit(values: str | Column) -> Column:
    """The value that belongs to the row's unit; units count from 1."""
    return F.get(values, F.col("unit") - 1)


def _first(values: str) -> Column:
    """Whether no earlier unit has the same value."""
    return F.array_position(F.col(values), _unit(F.col(values))) == F.col("unit")


def _repeat(values: str) -> Column:
    """Null for the first unit with its value, then 2, 3, ... as text; nulls count as equal."""
    at = F.col("unit")
    earlier = F.filter(F.slice(values, 1, at), lambda v: v.eqNullSafe(_unit(F.col(values))))
    return F.when(F.size(earlier) > 1, F.size(earlier).cast("string"))


def track_graphs(tracks: DataFrame, data_uri: str = DATA, *, form: str = "full", only=None) -> DataFrame:
    """One graph per track, or those of its triples whose patterns `only` chooses.

    `form="full"` writes speed and course measures and points named by position; `form="basic"` writes
    neither measures nor period texts and names points by geohash.

    Each track becomes `n + 1` rows: number 0 carries the track's own triples, 1..n its pings. Periods
    and points are written by the first ping that has them. A ping's nodes are named by its `seq`; pings of a
    track that share one are told apart by their order, so that each stays an observation of its own and the
    triples of a graph are a set. A ping without time or position is observed without them.
    """
    full = form == "full"
    graph_id = F.concat(F.lit("track"), F.col("mmsi"), F.lit("-"), F.col("track_no").cast("string"))
    units = tracks.select(
        graph_id.alias("graph_id"), "mmsi", "min_ts", "max_ts", "pings",
        F.col("pings.ts").alias("times"), F.col("pings.seq").alias("seqs"),
        F.transform("pings", lambda p: F.struct(p["lat"], p["lon"])).alias("places"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.size("pings"))).alias("unit"))
    ping = F.col("ping")
    lat, lon = ping["lat"], ping["lon"]
    place = (
        tx.point_uri(data_uri, lat, lon) if full else F.concat(F.lit(data_uri + "geohash_"), geo.geohash(lat, lon))
    )
    rows = units.withColumn("ping", _unit("pings")).select(
        "graph_id", "mmsi", "unit",
        F.when(F.col("unit") == 0, _node(data_uri, F.col("graph_id")))
        .otherwise(_node(data_uri, F.col("graph_id"), F.coalesce(ping["seq"].cast("string"), F.lit("")), _repeat("seqs"))).alias("node"),
        _node(data_uri, F.col("graph_id")).alias("graph_node"),
        tx.transponder_uri(data_uri, F.col("mmsi")).alias("carrier"),
        tx.period_uri(F.col("min_ts")).alias("first_period"),
        tx.period_uri(F.col("max_ts")).alias("last_period"),
        tx.period_uri(ping["ts"]).alias("period"),
        tx.iso_text(ping["ts"]).alias("iso"),
        place.alias("place"),
        *[tx.number_text(ping[c]).alias(c) for c in ("lat", "lon", *(("sog", "cog") if full else ()))],
        _first("times").alias("new_time"),
        _first("places").alias("new_place"),
    )
    n = lambda role: var("node", "-" + role)
    whole, carrier = var("graph_node", "-observation"), var("carrier")
    head = [
        *tr.naming_schemes("graph_node", scheme_name=full),
        tr.typed(whole, "Observation"),
        *tr.when("first_period IS NOT NULL", tr.bound(n("start"), whole, var("first_period"), end=False)),
        *tr.when("last_period IS NOT NULL", tr.bound(n("end"), whole, var("last_period"), end=True)),
        *tr.transponder("carrier", "mmsi"),
    ]
    if full:
        for local, class_name, name, role in (
            ("SpeedOverGround", "ClassOfMeasure", "Speed Over Ground", "sogName"),
            ("CourseOverGround", "ClassOfMeasure", "Course Over Ground", "cogName"),
            ("Knots", "UnitOfMeasure", "knots", "knotsName"),
            ("DegreesTrueNorth", "UnitOfMeasure", "degrees true North", "degName"),
        ):
            head += [tr.typed(data_uri + local, class_name), *tr.named(data_uri + local, n(role), name)]
        head += tr.participates(n("target"), "ObservedTarget", carrier, whole)
    body = [
        *_location_observation(data_uri, measures=full),
        tr.link(n("location"), "isPartOf", whole),
        *tr.when("new_time", tr.period(var("period"), var("iso"), representation=full)),
        *tr.when("new_place AND place IS NOT NULL", tr.point("place", var("lat"), var("lon"))),
    ]
    return tr.emit(rows, (F.col("unit") == 0, head), (F.col("unit") > 0, body), only=only)


def _location_observation(data_uri: str, measures: bool) -> list[Pattern]:
    """One ping observed, without its period and point nodes.

    Columns: node, carrier, period, place, and sog and cog for measures.
    """
    n = lambda role: var("node", "-" + role)
    seen, target = n("location"), n("target")
    out = [
        tr.typed(seen, "LocationObservation"),
        tr.in_period(seen, var("period")),
        *tr.participates(target, "ObservedTarget", var("carrier"), seen),
        *tr.when("place IS NOT NULL", tr.participates(n("place"), "ObservedLocation", var("place"), seen)),
    ]
    if measures:
        for column, local, unit in (("sog", "SpeedOverGround", "Knots"), ("cog", "CourseOverGround", "DegreesTrueNorth")):
            measure = tr.measured(n(column), n(column + "Value"), data_uri + local, var(column), data_uri + unit)
            # Speed and course are often blank: then nothing was measured.
            out += tr.when(f"{column} IS NOT NULL", [*measure, tr.link(target, "observedCharacteristic", n(column))])
    return out


def ping_graphs(pings: DataFrame, data_uri: str = DATA, *, only=None) -> DataFrame:
    """Single pings as location observations outside any track, one graph each."""
    graph_id = F.concat(F.lit("ping"), F.col("seq").cast("string"))
    rows = pings.select(
        graph_id.alias("graph_id"),
        "mmsi",
        _node(data_uri, graph_id).alias("node"),
        tx.transponder_uri(data_uri, F.col("mmsi")).alias("carrier"),
        tx.period_uri(F.col("ts")).alias("period"),
        tx.iso_text(F.col("ts")).alias("iso"),
        tx.point_uri(data_uri, F.col("lat"), F.col("lon")).alias("place"),
        tx.number_text(F.col("lat")).alias("lat"),
        tx.number_text(F.col("lon")).alias("lon"),
    )
    return tr.emit(
        rows,
        [
            *tr.naming_schemes("node"),
            *tr.transponder("carrier", "mmsi"),
            *_location_observation(data_uri, measures=False),
            *tr.period(var("period"), var("iso")),
            *tr.when("place IS NOT NULL", tr.point("place", var("lat"), var("lon"))),
        ],
        only=only,
    )


def filtered_track_graphs(
    steps: DataFrame,
    data_uri: str = FILTER_DATA,
    *,
    mapping=(0, 2),
    mmsi_scheme: bool = True,
    scheme: str = MMSI_SCHEME,
    epsg: str | None = None,
) -> DataFrame:
    """One graph per filtered track; input one row per (track_id, mmsi, ts, state array).

    The track's own triples need its bounds, which a map-side combined aggregate gives. Times of a
    track are distinct, so each state writes its own period; the bounds refer to two of them.
    """
    bounds = steps.groupBy("track_id", "mmsi").agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
    track = F.col("track_id")
    shared = [
        track.alias("graph_id"),
        F.concat(F.lit(data_uri), track).alias("whole"),
        tx.transponder_uri(data_uri, F.col("mmsi"), "_MMSI_" if mmsi_scheme else "_transponderID_").alias("carrier"),
    ]
    whole, carrier = var("whole"), var("carrier")
    n = lambda role: var("node", "-" + role)
    heads = bounds.select(
        *shared, "mmsi",
        _node(data_uri, F.lit("filtered"), track).alias("node"),
        tx.period_uri(F.col("min_ts")).alias("first_period"),
        tx.period_uri(F.col("max_ts")).alias("last_period"),
    )
    head = tr.emit(
        heads,
        [
            tr.typed(whole, "Observation"),
            *tr.transponder("carrier", "mmsi", scheme),
            *tr.bound(n("start"), whole, var("first_period"), end=False),
            *tr.bound(n("end"), whole, var("last_period"), end=True),
        ],
    )
    rows = steps.select(
        *shared,
        _node(data_uri, F.lit("filtered"), track, F.unix_micros("ts").cast("string")).alias("node"),
        tx.period_uri(F.col("ts")).alias("period"),
        tx.iso_text(F.col("ts")).alias("iso"),
        *[tx.number_text(F.get("state", F.lit(c))).alias(f"value{i}") for i, c in enumerate(mapping, 1)],
    )
    seen, target, where, rep = n("location"), n("target"), n("point"), n("representation")
    body = [
        tr.typed(seen, "LocationObservation"),
        tr.link(seen, "isPartOf", whole),
        tr.in_period(seen, var("period")),
        *tr.period(var("period"), var("iso")),
        *tr.participates(target, "ObservedTarget", carrier, seen),
        tr.typed(where, "GeoPoint"),
        tr.typed(rep, "EpsgGeoPointRepresentation"),
        tr.link(where, "isIdentifiedBy", rep),
        *tr.participates(n("place"), "ObservedLocation", where, seen),
    ]
    if epsg:
        body.append(tr.value(rep, epsg, "epsgCode"))
    for i in range(1, len(mapping) + 1):
        param = n(f"param{i}")
        body += [
            tr.typed(param, f"EpsgParameter{i}"),
            tr.link(param, "inRepresentation", rep),
            tr.plain_value(param, var(f"value{i}")),
        ]
    return head.unionByName(tr.emit(rows, body))


def following_graphs(events: DataFrame, data_uri: str = DATA, *, form: str = "full", emit=tr.emit) -> DataFrame:
    """One graph per following event: (event_id, follower, followed, start, end, system, assessed_at).

    `emit=emit_texts` gives each graph as one text.
    """
    full = form == "full"
    judged = ~tx.blank(F.col("system"))
    at = F.when(judged, F.col("assessed_at"))
    start, end = F.col("start"), F.col("end")
    rows = events.select(
        F.col("event_id").alias("graph_id"), "follower", "followed", "system",
        _node(data_uri, F.lit("following"), F.col("event_id")).alias("node"),
        tx.transponder_uri(data_uri, F.col("follower")).alias("tail"),
        tx.transponder_uri(data_uri, F.col("followed")).alias("lead"),
        *[tx.period_uri(c).alias(f"period{i}") for i, c in enumerate((start, end, at))],
        *[tx.iso_text(c).alias(f"iso{i}") for i, c in enumerate((start, end, at))],
        judged.alias("judged"),
        (F.col("follower") != F.col("followed")).alias("two"),
        (~start.eqNullSafe(end)).alias("new1"),
        at.isNotNull().alias("dated"),
        (at.isNotNull() & ~at.eqNullSafe(start) & ~at.eqNullSafe(end)).alias("new2"),
    )
    n = lambda role: var("node", "-" + role)
    act, system, tail, lead = n("follow"), n("system"), var("tail"), var("lead")
    return emit(
        rows,
        [
            *tr.naming_schemes("node", scheme_name=full),
            tr.typed(act, "Follow"),
            *tr.bound(n("start"), act, var("period0"), end=False),
            *tr.bound(n("end"), act, var("period1"), end=True),
            *tr.transponder("tail", "follower"),
            *tr.when("two", tr.transponder("lead", "followed")),
            *tr.participates(n("follower"), "Follower", tail, act),
            *tr.participates(n("followed"), "Followed", lead, act),
            *tr.when(
                "judged",
                [
                    tr.typed(system, "System"),
                    *tr.named(system, n("systemName"), var("system")),
                    tr.typed(n("world"), "PossibleWorld"),
                    tr.link(act, "isPartOf", n("world")),
                    tr.typed(n("assessment"), "Assess"),
                    tr.link(n("assessment"), "assessed", n("world")),
                    *tr.participates(n("assessor"), "Assessor", system, n("assessment")),
                ],
            ),
            *tr.when("dated", [tr.in_period(n("assessment"), var("period2"))]),
            *tr.period(var("period0"), var("iso0"), representation=full),
            *tr.when("new1", tr.period(var("period1"), var("iso1"), representation=full)),
            *tr.when("new2", tr.period(var("period2"), var("iso2"), representation=full)),
        ],
    )


def _vessel_columns(data_uri: str, mmsi: Column, compat_node: Column | None) -> list[Column]:
    """A vessel's name and identifier text: by MMSI, or a hashed name and the MMSI name as text."""
    natural = F.concat(F.lit(data_uri + "_vessel_mmsi_"), mmsi)
    uri, text = (natural, mmsi) if compat_node is None else (compat_node, natural)
    return [uri.alias("vessel"), text.alias("vessel_text")]


def _vessel() -> list[Pattern]:
    return [
        *tr.identified(
            var("vessel"), var("vessel", "_idObj"), var("vessel_text"), "CommunicationsIdentifier", MMSI_SCHEME
        ),
        tr.typed(var("vessel"), "Vessel"),
    ]


def _vessel_times(times: str) -> Column:
    """Per-vessel times, all null unless the list is as long as the vessel list."""
    parsed = F.transform(times, lambda t: F.nullif(F.trim(t), F.lit("")).try_cast("timestamp"))
    empty = F.array_repeat(F.lit(None).cast("timestamp"), F.size("mmsis"))
    return F.when(F.size(times) == F.size("mmsis"), parsed).otherwise(empty)


def coopering_graphs(events: DataFrame, data_uri: str = ANALYTICS_DATA, *, golden_compat: bool = False) -> DataFrame:
    """One graph per meeting at sea: (event_id, start, end, mmsis, starts, ends, probability,
    assessed_at, use_phia).

    Units of an event: 0 the event itself, then its vessels, then its distinct times. The lists are part
    of one event row and are exploded, never gathered.
    """
    filled = events.select(
        F.col("event_id").alias("graph_id"), "start", "end", "mmsis", "probability", "assessed_at", "use_phia",
        _vessel_times("starts").alias("starts"), _vessel_times("ends").alias("ends"),
    )
    every = F.concat(F.array("start", "end", "assessed_at"), "starts", "ends")
    units = (
        filled.withColumn("times", F.filter(F.array_distinct(every), lambda t: t.isNotNull()))
        .withColumn("vessels", F.size("mmsis"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("vessels") + F.size("times"))).alias("unit"))
    )
    graph_node = _node(data_uri, F.lit("coopering"), F.col("graph_id"))
    own = F.concat(graph_node, F.lit("-"), F.col("unit").cast("string"))
    from_, until = _unit("starts"), _unit("ends")
    time = F.get("times", F.col("unit") - 1 - F.col("vessels"))
    rows = units.select(
        "graph_id", "unit", "vessels",
        graph_node.alias("graph_node"), own.alias("node"),
        *_vessel_columns(data_uri, _unit("mmsis"), F.concat(own, F.lit("-vessel")) if golden_compat else None),
        (_first("mmsis") | F.lit(golden_compat)).alias("new_vessel"),
        tx.period_uri(F.col("start")).alias("start_period"),
        tx.period_uri(F.col("end")).alias("end_period"),
        tx.period_uri(F.col("assessed_at")).alias("assessed_period"),
        tx.period_uri(from_).alias("from_period"),
        tx.period_uri(until).alias("until_period"),
        tx.period_uri(time).alias("period"),
        tx.iso_text(time).alias("iso"),
        F.col("start").isNotNull().alias("has_start"),
        F.col("end").isNotNull().alias("has_end"),
        F.col("assessed_at").isNotNull().alias("dated"),
        from_.isNotNull().alias("has_from"),
        until.isNotNull().alias("has_until"),
        tx.phia_class(F.col("probability"), F.col("use_phia")).alias("band"),
        tx.number_text(F.col("probability")).alias("probability"),
    )
    act, system, part = var("graph_node", "-cooper"), data_uri + "TrackAnalytics", var("node", "-coopering")
    g = lambda role: var("graph_node", "-" + role)
    head = [
        *tr.naming_schemes("graph_node"),
        tr.typed(system, "System"),
        tr.typed(act, "CooperAtSea"),
        *tr.when("has_start", tr.bound(g("start"), act, var("start_period"), end=False)),
        *tr.when("has_end", tr.bound(g("end"), act, var("end_period"), end=True)),
        *tr.assessed("graph_node", [act], system, var("band"), var("probability"), var("assessed_period"), "dated"),
    ]
    body = [
        *tr.when("new_vessel", _vessel()),
        tr.typed(part, "CooperingAtSea"),
        tr.link(part, "isParticipantIn", act),
        tr.link(part, "isParticipationOf", var("vessel")),
        tr.link(part, "isPartOf", g("world")),
        *tr.when("has_from", tr.bound(var("node", "-start"), part, var("from_period"), end=False)),
        *tr.when("has_until", tr.bound(var("node", "-end"), part, var("until_period"), end=True)),
    ]
    return tr.emit(
        rows,
        (F.col("unit") == 0, head),
        (F.col("unit") <= F.col("vessels"), body),
        (F.col("unit") > F.col("vessels"), tr.period(var("period"), var("iso"))),
    )


def destination_graphs(
    predictions: DataFrame, data_uri: str = ANALYTICS_DATA, *, golden_compat: bool = False
) -> DataFrame:
    """One graph per prediction: (event_id, mmsi, assessed_at, destinations array of
    (port, locode, iso3, probability)). Unit 0 is the vessel, 1..k the candidates."""
    units = predictions.select(
        F.col("event_id").alias("graph_id"), "mmsi", "assessed_at", "destinations",
        F.col("destinations.locode").alias("codes"),
        F.col("destinations.iso3").alias("countries"),
        F.transform("destinations", lambda d: F.struct(d["locode"], d["iso3"])).alias("pairs"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.size("destinations"))).alias("unit"))
    graph_node = _node(data_uri, F.lit("destination"), F.col("graph_id"))
    own = F.concat(graph_node, F.lit("-"), F.col("unit").cast("string"))
    d = F.col("d")
    coded, placed = ~tx.blank(d["locode"]), ~tx.blank(d["iso3"])
    rows = units.withColumn("d", _unit("destinations")).select(
        "graph_id", "unit",
        graph_node.alias("graph_node"), own.alias("node"),
        *_vessel_columns(
            ANALYTICS_DATA, F.col("mmsi"), F.concat(graph_node, F.lit("-vessel")) if golden_compat else None
        ),
        tx.period_uri(F.col("assessed_at")).alias("assessed_period"),
        tx.iso_text(F.col("assessed_at")).alias("assessed_iso"),
        F.col("assessed_at").isNotNull().alias("dated"),
        F.when(coded, tx.locode_uri(d["locode"])).otherwise(F.concat(own, F.lit("-port"))).alias("port"),
        tx.country_uri(d["iso3"]).alias("country"),
        d["port"].alias("port_name"), d["locode"].alias("locode"), d["iso3"].alias("iso3"),
        tx.phia_class(d["probability"]).alias("band"),
        tx.number_text(d["probability"]).alias("probability"),
        coded.alias("coded"),
        (~coded | _first("codes")).alias("new_port"),
        (placed & _first("countries")).alias("new_country"),
        (placed & (~coded | _first("pairs"))).alias("in_country"),
    )
    n = lambda role: var("node", "-" + role)
    system, port, country = ANALYTICS_DATA + "TrackAnalytics", var("port"), var("country")
    sailing, used, arrival = n("sailing"), n("vehicle"), n("arrival")
    head = [
        *tr.naming_schemes("graph_node"),
        tr.typed(system, "System"),
        *_vessel(),
        *tr.when("dated", tr.period(var("assessed_period"), var("assessed_iso"))),
    ]
    body = [
        *tr.when("new_port", [tr.typed(port, "Port")]),
        *tr.named(port, n("portName"), var("port_name"), "PlaceName"),
        *tr.when("coded", tr.identified(port, n("portCode"), var("locode"), "UN_LOCODE")),
        *tr.when(
            "new_country",
            [
                tr.typed(country, "Country"),
                *tr.identified(country, var("country", "_code"), var("iso3"), "ISO3166Alpha_3"),
            ],
        ),
        *tr.when("in_country", [tr.link(port, "isPartOf", country)]),
        tr.typed(sailing, "Sailing"),
        *tr.participates(used, "VehicleUsed", var("vessel"), sailing),
        tr.typed(arrival, "Arrival"),
        tr.link(arrival, "isEndOf", sailing),
        tr.link(arrival, "inLocation", port),
        *tr.assessed(
            "node", [sailing, used, arrival], system, var("band"), var("probability"), var("assessed_period"), "dated"
        ),
    ]
    return tr.emit(rows, (F.col("unit") == 0, head), (F.col("unit") > 0, body))


def vessel_state_graphs(mapped: DataFrame, data_uri: str = DATA, keep: tuple[str, ...] = ()) -> DataFrame:
    """One graph per mapped ping: (graph_id, row_uri, classes, ping columns). Unit 0 is the message, the
    others are the classes of the vessel state."""
    units = mapped.select("*", F.explode(F.sequence(F.lit(0), F.size("classes"))).alias("unit")).select("*", _unit("classes").alias("class"))
    classes = [tr.typed_as(var("row_uri"), var("class"))]
    rows = _state_rows(units, data_uri, "unit", "class", *keep)
    return tr.emit(rows, (F.col("unit") == 0, _state_patterns(data_uri)), (F.col("unit") > 0, classes), keep=keep)


def vessel_state_texts(mapped: DataFrame, data_uri: str = DATA, keep: tuple[str, ...] = ()) -> DataFrame:
    """The graphs of `vessel_state_graphs` as N-Triples texts, each made in its ping's row."""
    head = F.concat(tx.node_text(F.col("row_uri")), F.lit(f" <{RDF_TYPE}> <"))
    typing = F.transform(F.array_distinct("classes"), lambda c: F.concat(head, c, F.lit("> .")))
    return tr.emit_texts(_state_rows(mapped, data_uri, "classes", *keep), _state_patterns(data_uri), more=typing, keep=keep)


def _state_rows(mapped: DataFrame, data_uri: str, *keep: str) -> DataFrame:
    return mapped.select(
        "graph_id", "mmsi", "imo", "vessel_name", "call_sign", "row_uri", *keep,
        _node(data_uri, F.lit("vesselState"), F.col("graph_id")).alias("node"),
        F.concat(F.lit(data_uri), F.col("imo"), F.lit("IMO")).alias("imo_node"),
        tx.period_uri(F.col("ts")).alias("period"),
        tx.iso_text(F.col("ts")).alias("iso"),
        tx.number_text(F.col("lat")).alias("lat"),
        tx.number_text(F.col("lon")).alias("lon"),
        *[(~tx.blank(F.col(c))).alias(f"has_{c}") for c in ("imo", "vessel_name", "call_sign")],
    )


def _state_patterns(data_uri: str) -> list[Pattern]:
    imo_scheme = data_uri + "imo-NamingScheme"
    vin = "VehicleIdentificationNumber"
    n = lambda role: var("node", "-" + role)
    state, where = var("row_uri"), n("point")
    return [
        *tr.naming_schemes("node"),
        tr.typed(n("observation"), "Observation"),
        tr.link(state, "isParticipantIn", n("observation")),
        *tr.when(
            "has_imo",
            [
                tr.typed(imo_scheme, "NamingScheme"),
                *tr.identified(state, var("imo_node"), var("imo"), vin, imo_scheme),
            ],
        ),
        *tr.when("mmsi IS NOT NULL", tr.identified(state, n("mmsi"), var("mmsi"), vin, MMSI_SCHEME)),
        *tr.when("has_vessel_name", tr.named(state, n("name"), var("vessel_name"), "VehicleName")),
        *tr.when("has_call_sign", tr.identified(state, n("callsign"), var("call_sign"), "Callsign")),
        *tr.period(var("period"), var("iso")),
        tr.in_period(state, var("period")),
        *tr.when("lat IS NOT NULL AND lon IS NOT NULL", [
            tr.typed(where, "GeoPoint"),
            *tr.identified(where, n("lat"), var("lat"), "Latitude"),
            *tr.identified(where, n("lon"), var("lon"), "Longitude"),
            tr.link(state, "inLocation", where),
        ]),
    ]
