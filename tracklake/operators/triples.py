"""Triple patterns, their expansion over rows, and set operations on triple tables.

A graph shape is a list of patterns. A pattern names its subject and object by a column of the row and a
fixed suffix, or by fixed text alone, so the whole list is one constant array. Emitting explodes that
constant next to the row and fills in the columns: the table is scanned once whatever the number of
triples, and the generated code stays small however long the list is.

Nodes with natural names can repeat within a graph. A guard column says whether this row is the first to
have the node, which makes the output a set without a de-duplicating shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_literal, node_text
from ..schema import TRIPLE_COLUMNS
from ..vocab import ITU, MMSI_SCHEME, RDF_TYPE, XSD, ies

# How the object is written; expanded to o_kind and o_dtype after the explode.
_IRI, _STRING, _FLOAT, _PLAIN = 0, 1, 2, 3
# A pattern inside a plan: subject column number and text, predicate, object column number and text,
# object code, guard number, and one bit for each column it reads.
_PATTERN_FIELDS = ("sc", "st", "p", "oc", "ot", "k", "g", "m")
_PATTERN_TYPE = "array<struct<sc:int,st:string,p:string,oc:int,ot:string,k:int,g:int,m:bigint>>"


@dataclass(frozen=True)
class Term:
    """Value of `column` (if any) followed by `text`."""

    column: str | None
    text: str = ""


@dataclass(frozen=True)
class Pattern:
    s: Term
    p: str
    o: Term
    code: int = _IRI
    guard: str | None = None  # condition on the row that must hold, mostly a boolean column


def var(column: str, text: str = "") -> Term:
    return Term(column, text)


def _term(x: Term | str) -> Term:
    return x if isinstance(x, Term) else Term(None, x)


def link(s, predicate: str, o) -> Pattern:
    return Pattern(_term(s), ies(predicate), _term(o))


def typed(s, class_name: str) -> Pattern:
    return Pattern(_term(s), RDF_TYPE, Term(None, ies(class_name)))


def typed_as(s, class_uri: Term) -> Pattern:
    return Pattern(_term(s), RDF_TYPE, class_uri)


def value(s, o, predicate: str = "representationValue") -> Pattern:
    return Pattern(_term(s), ies(predicate), _term(o), _STRING)


def float_value(s, o) -> Pattern:
    return Pattern(_term(s), ies("representationValue"), _term(o), _FLOAT)


def plain_value(s, o) -> Pattern:
    return Pattern(_term(s), ies("representationValue"), _term(o), _PLAIN)


def when(guard: str, patterns: list[Pattern]) -> list[Pattern]:
    return [replace(p, guard=guard) for p in patterns]


def period(uri: Term, iso: Term, representation: bool = True) -> list[Pattern]:
    """A period node; wanted once per distinct time in a graph."""
    out = [typed(uri, "ParticularPeriod")]
    return out + ([value(uri, iso, "iso8601PeriodRepresentation")] if representation else [])


def in_period(item, uri: Term) -> Pattern:
    return link(item, "inPeriod", uri)


def bound(state: Term, item: Term, uri: Term, end: bool) -> list[Pattern]:
    """A bounding state at the start or end of an item, without the period node itself."""
    return [typed(state, "BoundingState"), link(state, "isEndOf" if end else "isStartOf", item), in_period(state, uri)]


def named(item, name_node, text, class_name: str = "Name", scheme: str | None = None) -> list[Pattern]:
    out = [typed(name_node, class_name), value(name_node, text), link(item, "hasName", name_node)]
    return out + ([link(name_node, "inScheme", scheme)] if scheme else [])


def identified(
    item, id_node, text, class_name: str = "Identifier", scheme: str | None = None, relation: str = "isIdentifiedBy"
) -> list[Pattern]:
    out = [typed(id_node, class_name), value(id_node, text), link(item, relation, id_node)]
    return out + ([link(id_node, "inScheme", scheme)] if scheme else [])


def measured(measure: Term, measure_value: Term, class_uri: str, number: Term, unit_uri: str) -> list[Pattern]:
    return [
        typed(measure, "Measure"),
        link(measure, "measureClass", class_uri),
        typed(measure_value, "MeasureValue"),
        value(measure_value, number),
        link(measure, "hasValue", measure_value),
        link(measure_value, "measureUnit", unit_uri),
    ]


def participates(part: Term, class_name: str, whole, event) -> list[Pattern]:
    return [typed(part, class_name), link(part, "isParticipationOf", whole), link(part, "isParticipantIn", event)]


def transponder(column: str, mmsi: str, scheme: str = MMSI_SCHEME) -> list[Pattern]:
    """A location transponder and its identifier, both under natural names."""
    uri = var(column)
    return [
        typed(uri, "LocationTransponder"),
        *identified(uri, var(column, "_idObj"), var(mmsi), "CommunicationsIdentifier", scheme),
    ]


def point(column: str, lat: Term, lon: Term) -> list[Pattern]:
    """A geographic point with latitude and longitude nodes; wanted once per distinct point in a graph."""
    uri, lat_node, lon_node = var(column), var(column, "_lat"), var(column, "_lon")
    return [
        typed(uri, "GeoPoint"),
        typed(lat_node, "Latitude"),
        typed(lon_node, "Longitude"),
        link(uri, "isIdentifiedBy", lat_node),
        link(uri, "isIdentifiedBy", lon_node),
        value(lat_node, lat),
        value(lon_node, lon),
    ]


def naming_schemes(graph_node: str, scheme_name: bool = True) -> list[Pattern]:
    """The naming scheme every graph starts with."""
    out = [typed(MMSI_SCHEME, "NamingScheme")]
    if scheme_name:
        out += named(MMSI_SCHEME, var(graph_node, "-schemeName"), "MMSI", scheme=MMSI_SCHEME)
    out.append(typed(ITU, "Organisation"))
    out += named(ITU, var(graph_node, "-ownerName"), "International Telecommunications Union")
    out.append(link(MMSI_SCHEME, "schemeOwner", ITU))
    return out


def assessed(
    node: str, items: list[Term], assessor, band: Term, probability: Term, period_uri: Term, dated: str
) -> list[Pattern]:
    """A probability assessment of a possible world that `items` are part of, without the period node."""
    world, act, prob, who = (var(node, "-" + r) for r in ("world", "assessment", "probability", "assessor"))
    return [
        typed(world, "PossibleWorld"),
        typed_as(act, band),
        link(act, "assessed", world),
        typed(prob, "ProbabilityRepresentation"),
        float_value(prob, probability),
        link(act, "hasRepresentation", prob),
        typed(who, "Assessor"),
        link(who, "isParticipantIn", act),
        link(who, "isParticipationOf", assessor),
        *[link(item, "isPartOf", world) for item in items],
        *when(dated, [in_period(act, period_uri)]),
    ]


Shape = list[Pattern] | tuple[Column, list[Pattern]]


class _Compiled:
    """Shapes as one constant array per row, and how its patterns `t` are filled in from the row's columns."""

    def __init__(self, shapes: tuple[Shape, ...]):
        chosen = self.chosen = [s if isinstance(s, tuple) else (F.lit(True), s) for s in shapes]
        patterns = [p for _, shape in chosen for p in shape]
        self.columns = sorted({t.column for p in patterns for t in (p.s, p.o) if t.column})
        self.guards = sorted({p.guard for p in patterns if p.guard})
        column_no = {c: i for i, c in enumerate(self.columns)} | {None: -1}
        guard_no = {g: i for i, g in enumerate(self.guards)} | {None: -1}

        def constant(shape: list[Pattern]) -> Column:
            """The patterns as one literal: the optimizer folds the JSON text into an array."""
            rows = [
                [column_no[p.s.column], p.s.text, p.p, column_no[p.o.column], p.o.text, p.code, guard_no[p.guard],
                 sum({1 << column_no[c] for c in (p.s.column, p.o.column) if c})]
                for p in shape
            ]
            return F.from_json(F.lit(json.dumps([dict(zip(_PATTERN_FIELDS, row)) for row in rows])), _PATTERN_TYPE)

        self.picked = constant(chosen[0][1])
        if len(chosen) > 1:
            self.picked = F.when(chosen[0][0], self.picked)
            for condition, shape in chosen[1:]:
                self.picked = self.picked.when(condition, constant(shape))

    def prepared(self, *keep: str) -> list[Column | str]:
        """The columns of a row that filling in needs. Which of them have no value is worked out once per row, as a
        number with a bit for each."""
        none = F.lit(0).cast("bigint")
        bits = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(self.columns)]
        conditions = [F.expr(g).alias(f"_g{i}") for i, g in enumerate(self.guards)]
        return [*dict.fromkeys(["graph_id", *self.columns, *keep]), *conditions, reduce(lambda a, b: a + b, bits, none).alias("_missing")]

    def kept(self, t: Column) -> Column:
        out = F.col("_missing").bitwiseAND(t["m"]) == 0
        if self.guards:
            held = F.when(t["g"] == -1, True)
            for i in range(len(self.guards)):
                held = held.when(t["g"] == i, F.col(f"_g{i}"))
            out = held & out
        return out

    def filled(self, t: Column, number: str, text: str) -> Column:
        out = F.when(t[number] == -1, t[text])
        for i, c in enumerate(self.columns):
            out = out.when(t[number] == i, F.concat(F.col(c), t[text]))
        return out

    def lines(self) -> Column:
        """The triples of a row as an array of N-Triples lines. Each pattern is an expression of its own, which Spark compiles;
        a loop over the constant array would be interpreted for each line."""
        shapes = [(condition, F.array_compact(F.array(*[self._line(p) for p in shape]))) for condition, shape in self.chosen]
        if len(shapes) == 1:
            return shapes[0][1]
        out = F.when(*shapes[0])
        for condition, lines in shapes[1:]:
            out = out.when(condition, lines)
        return out

    def _line(self, p: Pattern) -> Column:
        """The triple as a line of N-Triples; null where a column has no value or the guard does not hold."""
        text = lambda t: F.lit(t.text) if t.column is None else F.concat(F.col(t.column), F.lit(t.text)) if t.text else F.col(t.column)
        end = {_STRING: f'"^^<{XSD}string> .', _FLOAT: f'"^^<{XSD}float> .'}.get(p.code, '" .')
        o = [node_text(text(p.o)), F.lit(" .")] if p.code == _IRI else [F.lit('"'), escape_literal(text(p.o)), F.lit(end)]
        line = F.concat(node_text(text(p.s)), F.lit(f" <{p.p}> "), *o)
        return line if p.guard is None else F.when(F.col(f"_g{self.guards.index(p.guard)}"), line)


def of_type(*class_names: str) -> Callable[[Pattern], bool]:
    """Patterns that type a node with one of the classes, for `only`."""
    return lambda p: p.p == RDF_TYPE and p.o.column is None and p.o.text in {ies(c) for c in class_names}


def emit(rows: DataFrame, *shapes: Shape, keep: tuple[str, ...] = (), only: Callable[[Pattern], bool] | None = None) -> DataFrame:
    """Fill in the patterns for each row of `rows`, which has `graph_id` and the columns they name.
    `keep` names further columns of the row to put next to each triple.

    Several shapes come with conditions: a row uses the first whose condition holds. A pattern that reads a
    column without a value gives no triple. `only` chooses patterns when the plan is built: the others and the
    columns that only they read are not worked out at all.
    """
    if only is not None:
        shapes = tuple((s[0], [p for p in s[1] if only(p)]) if isinstance(s, tuple) else [p for p in s if only(p)] for s in shapes)
    plan, t = _Compiled(shapes), F.col("_t")
    return (
        rows.select(*plan.prepared(*keep), F.explode(plan.picked).alias("_t"))
        .where(plan.kept(t))
        .select(
            "graph_id",
            plan.filled(t, "sc", "st").alias("s"),
            t.p.alias("p"),
            plan.filled(t, "oc", "ot").alias("o"),
            F.when(t.k == _IRI, "iri").otherwise("literal").alias("o_kind"),
            F.when(t.k == _STRING, XSD + "string").when(t.k == _FLOAT, XSD + "float").alias("o_dtype"),
            *keep,
        )
    )


def emit_texts(rows: DataFrame, *shapes: Shape, more: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The graph of each row as one N-Triples text with sorted lines: (graph_id, n_triples, text), then `keep`.

    For graphs that come from one row: the lines never leave it, so nothing is exploded or shuffled. `more` is
    an array of further lines made from the row's columns.
    """
    plan = _Compiled(shapes)
    lines = plan.lines()
    if more is not None:
        lines = F.concat(lines, F.col("_more"))
    return (
        rows.select(*plan.prepared(*keep), *([more.alias("_more")] if more is not None else []))
        .select("graph_id", F.sort_array(lines).alias("_lines"), *keep)
        .select("graph_id", F.size("_lines").cast("bigint").alias("n_triples"), F.array_join("_lines", "\n").alias("text"), *keep)
    )


def as_set(triples: DataFrame) -> DataFrame:
    """Set semantics for triples of unknown origin."""
    return triples.dropDuplicates(TRIPLE_COLUMNS)


def as_set_stream(triples: DataFrame, event_time: str, delay: str) -> DataFrame:
    return triples.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(TRIPLE_COLUMNS)


def union_sets(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return as_set(out)


def contained(candidates: DataFrame, graph: DataFrame, scope: tuple[str, ...] = ("graph_id",)) -> DataFrame:
    """Candidates that are in the graph. `scope=()` looks in all graphs.

    Every graph repeats some triples, so the graph side is made distinct, map-side first; the join then
    uses the same partitioning. Spark takes the size of triples for that of the columns they are made from, and would
    gather them on the driver to broadcast them; the hint keeps both sides in their tasks.
    """
    on = [*scope, "s", "p", "o"]
    return candidates.join(graph.select(*on).distinct().hint("merge"), on, "left_semi")


def is_typing() -> Column:
    return F.col("p") == RDF_TYPE
