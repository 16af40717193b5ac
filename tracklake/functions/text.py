"""Column expressions that turn values into text and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

TIME_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text, with microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def parse_time(text: Column, formats=TIME_FORMATS) -> Column:
    """First format that fits, else whatever the ISO cast accepts, else null."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries, text.try_cast("timestamp"))


def parse_number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def number_text(x: Column) -> Column:
    """Decimal text of a double, with the JVM's digits: plain from 1e-4 up to 1e16, exponent form outside."""
    short = x.cast("string")
    digits = F.regexp_replace(x.cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    power = F.regexp_replace(F.regexp_replace(short, r"\.0E", "E"), r"E(\d)", "E+$1")
    power = F.lower(F.regexp_replace(power, r"E([+-])(\d)$", "E$10$2"))
    return (
        F.when(~short.contains("E"), short)
        .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain)
        .otherwise(power)
    )


def escape_literal(text: Column) -> Column:
    """N-Triples string escapes."""
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def unescape_literal(text: Column) -> Column:
    """Undo string escapes; null if there is an unknown one. But for two they are those of JSON, so only text with a
    backslash is parsed. Those two, quote and eight digits, are undone between the escaped backslashes.
    """

    def character(digits: Column) -> Column:
        short = F.concat(F.lit("\\u"), F.substring(digits, 5, 4))
        return F.when(digits.startswith("0000"), short).otherwise(F.decode(F.unhex(digits), "UTF-32"))

    def as_json(part: Column) -> Column:
        codes = F.array_distinct(F.regexp_extract_all(part, F.lit(r"\\U(000[0-9A-Fa-f]{5}|0010[0-9A-Fa-f]{4})"), F.lit(1)))
        wide = F.aggregate(codes, part, lambda done, c: F.replace(done, F.concat(F.lit("\\U"), c), character(c)))
        return F.replace(wide, F.lit("\\'"), F.lit("'"))

    body = F.array_join(F.transform(F.split(text, r"\\\\"), as_json), "\\\\")
    quoted = F.concat(F.lit('["'), body, F.lit('"]'))
    parsed = F.from_json(quoted, "array<string>", {"allowUnquotedControlChars": "true"})
    return F.when(text.contains("\\"), parsed.getItem(0)).otherwise(text)


def term(o: Column, kind: Column, dtype: Column) -> Column:
    """N-Triples text of an object."""
    suffix = F.when(dtype.isNull(), "").when(dtype.startswith("@"), dtype).otherwise(F.concat(F.lit("^^<"), dtype, F.lit(">")))
    return (
        F.when(kind == "iri", F.concat(F.lit("<"), o, F.lit(">")))
        .when(kind == "bnode", o)
        .otherwise(F.concat(F.lit('"'), escape_literal(o), F.lit('"'), suffix))  # once: large methods are not compiled
    )


def node_text(s: Column) -> Column:
    return F.when(s.startswith("_:"), s).otherwise(F.concat(F.lit("<"), s, F.lit(">")))


def ntriples_line(s="s", p="p", o="o", kind="o_kind", dtype="o_dtype") -> Column:
    """One line; null if a term is missing."""
    blank_ = F.lit(" ")
    return F.concat(
        node_text(F.col(s)), blank_, node_text(F.col(p)), blank_, term(F.col(o), F.col(kind), F.col(dtype)), F.lit(" .")
    )


GRAPH = "urn:graph:"


def quad_line() -> Column:
    """One line of N-Quads: the triple and its graph, whose id is percent-encoded in a name of its own."""
    line = ntriples_line()
    graph = F.concat(F.lit(f"<{GRAPH}"), F.url_encode("graph_id"), F.lit("> ."))
    return F.concat(line.substr(F.lit(1), F.length(line) - 1), graph)


def period_uri(ts: Column) -> Column:
    return F.concat(F.lit(vocab.ISO8601), iso_text(ts))


def point_uri(data_uri: str, lat: Column, lon: Column) -> Column:
    return F.concat(F.lit(data_uri + "latlong"), number_text(lat), F.lit(","), number_text(lon))


def transponder_uri(data_uri: str, ident: Column, prefix: str = "MMSI_") -> Column:
    return F.concat(F.lit(data_uri + prefix), ident)


def locode_uri(code: Column) -> Column:
    return F.concat(F.lit(vocab.LOCODE), F.regexp_replace(code, " ", ""))


def country_uri(code: Column) -> Column:
    return F.concat(F.lit(vocab.ISO3166), code)


def hashed(*key: Column) -> Column:
    """Stable part of a node name: the same row gives the same node on every attempt."""
    return F.md5(F.concat_ws("|", *key))


def node(data_uri: str, digest: Column, role: str) -> Column:
    return F.concat(F.lit(data_uri), digest, F.lit("-" + role))


def namespace_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^(.*[#/])([^#/]*)$", 1)


def short_name(uri: Column, prefixes: dict[str, str] = vocab.PREFIXES) -> Column:
    """Prefixed name where the namespace is known, else the URI itself."""
    space = namespace_of(uri)
    local = F.regexp_extract(uri, r"^(.*[#/])([^#/]*)$", 2)
    cases = [(space == ns, F.concat(F.lit(prefix + ":"), local)) for prefix, ns in prefixes.items()]
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), uri)


def bar_label(rate: Column, total: Column) -> Column:
    return F.concat(F.lit("rate="), F.bround(rate, 2).cast("string"), F.lit(" count="), total.cast("string"))


def option_label(name: Column, total: Column) -> Column:
    return F.concat(name, F.lit(" ("), total.cast("string"), F.lit(")"))


def epsg_or_default(code: Column, default: str = "4326") -> Column:
    return F.coalesce(F.nullif(F.trim(code), F.lit("")), F.lit(default or "4326"))


def phia_class(probability: Column, use_phia: Column | bool = True) -> Column:
    """Assessment class of a probability; upper band edges are inclusive."""
    # Upper edge of each band and its class.
    bands = [
        (0.05, "AssessToBeRemoteChance"),
        (0.225, "AssessToBeHighlyUnlikely"),
        (0.375, "AssessToBeUnlikely"),
        (0.525, "AssessToBeRealisticPossibility"),
        (0.775, "AssessToBeLikelyOrProbably"),
        (0.925, "AssessToBeHighlyLikely"),
    ]
    use = use_phia if isinstance(use_phia, Column) else F.lit(use_phia)
    chain = F.when(F.coalesce(~use, F.lit(True)) | probability.isNull(), vocab.ies("AssessProbability"))
    for edge, name in bands:
        chain = chain.when(probability <= edge, vocab.ies(name))
    return chain.otherwise(vocab.ies("AssessToBeAlmostCertain"))
