"""N-Triples text to the triples layout."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from ..functions.codec import PIECE_ROWS, decode_body, inflate_one
from ..functions.text import GRAPH
from ..schema import TRIPLE_COLUMNS

# One line of N-Triples: subject, predicate, and an object that is a node or a literal with datatype or language.
# Tokens may touch. A pattern for Arrow, whose engine works in linear time and needs no stack for long literals.
_NODE = r"<[^<>\x00-\x1F]*>|_:[\w\x{B7}-\x{FFFD}][\w\x{B7}-\x{FFFD}.-]*"
_ESCAPE = r"\\(?:[tbnrf\"'\\]|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})"
_BODY = rf'[^"\\\n\r]*(?:{_ESCAPE}[^"\\\n\r]*)*'
LINE = (
    rf'(?s)^(?P<s>{_NODE})[ \t]*(?P<p><[^<>\x00-\x1F]*>)[ \t]*'
    rf'(?:(?P<node>{_NODE})|"(?P<body>{_BODY})"(?:\^\^<(?P<dtype>[^<>\x00-\x1F]*)>|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*))?)'
    r'[ \t]*\.[ \t]*(?:#.*)?\z'
)
_TERMS = TRIPLE_COLUMNS[1:]
_PARTS = StructType([*(StructField(c, StringType()) for c in _TERMS), StructField("valid", BooleanType())])
_PIECE_LINES = 4096  # lines that leave Python together
_WIDE = re.compile(r"\\U(000[0-9A-Fa-f]{5}|0010[0-9A-Fa-f]{4})")
_LONE = re.compile("[\ud800-\udfff]")


def _unescaped(text: str | None) -> str | None:
    """`unescape_literal` of one text with a backslash."""
    if text is None or "\\" not in text:
        return text
    wide = lambda m: "\\u" + m[1][4:] if m[1].startswith("0000") else chr(int(m[1], 16))
    body = "\\\\".join(_WIDE.sub(wide, part).replace("\\'", "'") for part in text.split("\\\\"))
    try:
        return _LONE.sub("?", json.loads(f'["{body}"]', strict=False)[0])
    except (ValueError, TypeError):
        return None


def _says(content: pa.Array) -> pa.Array:
    """Whether a trimmed line is neither blank nor a comment."""
    return pc.and_not(pc.not_equal(content, ""), pc.starts_with(content, "#"))


def _take_apart(lines: pa.Array) -> list[pa.Array]:
    """The columns of `_PARTS`; terms are null in a line that does not fit. Only an escape can be wrong in one that fits."""
    content = pc.utf8_trim(pc.fill_null(lines, "(damaged body)"), " \t\r")
    found = pc.extract_regex(content, LINE)  # a group that a line does not have is empty
    s, p, node, body, dtype, lang = (pc.struct_field(found, g) for g in ("s", "p", "node", "body", "dtype", "lang"))
    is_node, none = pc.not_equal(node, ""), pa.scalar(None, pa.string())
    bare = lambda name: pc.utf8_trim(name, "<>")
    terms = [
        bare(s), bare(p), pc.if_else(is_node, bare(node), body),
        pc.if_else(is_node, pc.if_else(pc.starts_with(node, "<"), "iri", "bnode"), "literal"),
        pc.if_else(is_node, none, pc.if_else(pc.not_equal(dtype, ""), dtype, pc.if_else(pc.not_equal(lang, ""), lang, none))),
    ]
    valid = found.is_valid()
    escaped = pc.and_(valid, pc.match_substring(content, "\\"))
    if pc.any(escaped).as_py():
        for i in (0, 1, 2, 4):
            undone = pa.array([_unescaped(t) for t in terms[i].filter(escaped).to_pylist()], pa.string())
            terms[i] = pc.replace_with_mask(terms[i], escaped, undone)
            if i < 3:
                valid = pc.and_(valid, terms[i].is_valid())
    return [*terms, valid]


@F.arrow_udf(_PARTS)
def _line_parts(lines: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in lines:
        for at in range(0, len(batch), _PIECE_LINES):
            piece = batch.slice(at, _PIECE_LINES)
            *terms, valid = _take_apart(piece)
            says = _says(pc.utf8_trim(pc.fill_null(piece, "(damaged body)"), " \t\r"))
            yield pa.StructArray.from_arrays([*terms, pc.if_else(says, valid, pa.scalar(None, pa.bool_()))], names=_PARTS.names)


def distinct_lines(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """Lines of a few messages that say something, each once a message, and the message of each. A missing text is a null line."""
    lists = pc.split_pattern(pa.array(["" if t is None else t for t in texts], pa.string()), "\n")
    lines, owner = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    code = lines.dictionary_encode().indices.to_numpy()
    content = pc.utf8_trim(lines, " \t\r")
    damaged = np.array([t is None for t in texts], dtype=bool)[owner]
    says = _says(content).to_numpy(zero_copy_only=False) | damaged
    first = np.zeros(len(lines), dtype=bool)
    first[np.unique(owner * (len(lines) + 1) + code, return_index=True)[1]] = True
    at = np.flatnonzero(first & says)
    return pc.if_else(pa.array(damaged[at]), pa.scalar(None, pa.string()), lines.take(pa.array(at))), owner[at]


def _message_parts(raw: bool):
    fields = [*([StructField("line", StringType())] if raw else []), *_PARTS]

    @F.arrow_udf(ArrayType(StructType(fields)))
    def parts(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in bodies:
            for at in range(0, len(batch), PIECE_ROWS):
                piece = batch.slice(at, PIECE_ROWS).to_pylist()
                lines, owner = distinct_lines([None if b is None else inflate_one(b) for b in piece])
                columns = [*([lines] if raw else []), *_take_apart(lines)]
                offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(piece)))].astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, names=[f.name for f in fields]))

    return parts.asNondeterministic()


# Spark would work deterministic functions out once more for each condition on their results.
_line_parts = _line_parts.asNondeterministic()
_message_parts_only, _message_parts_and_lines = _message_parts(False), _message_parts(True)


def parse_lines(
    lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ("graph_id",)
) -> tuple[DataFrame, DataFrame]:
    """(triples, lines that are not N-Triples), each after the `keep` columns. Blank and comment lines are
    neither. One pass of one pattern takes a line apart, in Arrow batches."""
    taken = judged_lines(lines, line, keep)
    return good_and_bad(taken, taken, keep, line)


def good_and_bad(judged: DataFrame, with_lines: DataFrame, keep: tuple[str, ...], line: str = "line") -> tuple[DataFrame, DataFrame]:
    good = judged.where("valid").select(*keep, *TRIPLE_COLUMNS[1:])
    bad = with_lines.where("NOT valid").select(*keep, F.lit("not an N-Triples line").alias("error"), F.col(line).alias("raw"))
    return good, bad


def judged_lines(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ("graph_id",)) -> DataFrame:
    """Both parts of `parse_lines` as one frame, told apart by `valid`, for what needs both and should read the lines once."""
    cut = lines.select(*keep, line, _line_parts(F.col(line)).alias("_parts"))
    return _judged(cut, *keep, line).where("valid IS NOT NULL")  # null in lines that say nothing


def judged_messages(messages: DataFrame, keep: tuple[str, ...], raw: bool = True) -> DataFrame:
    """`judged_lines` of the `message_lines` of zlib messages. A body is taken apart by the worker that inflates it; `raw=False`
    leaves the lines there."""
    parts = (_message_parts_and_lines if raw else _message_parts_only)(F.col("value"))
    cut = messages.select(*keep, parts.alias("_all")).select(*keep, F.explode("_all").alias("_parts"))
    if raw:
        cut = cut.select(*keep, F.col("_parts.line").alias("line"), "_parts")
    return _judged(cut, *keep, *(["line"] if raw else []))


def _judged(cut: DataFrame, *keep: str) -> DataFrame:
    return cut.select(*keep, *(F.col(f"_parts.{c}").alias(c) for c in _PARTS.names))


def read_ntriples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Files of N-Triples; the graph is the file."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("graph_id"))
    return parse_lines(lines)


_AFTER_GRAPH = r"^[^<>]*>[ \t]*\.[ \t]*\z"  # what follows the namespace of a quad's graph, the last name of the line


def read_graph_buckets(
    spark: SparkSession, path: str, graph_ids: list[str] | DataFrame | None = None, *, others: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(triples, bad lines) of graphs written by `save_graph_buckets`, all, those with the given ids, or with `others` the rest.

    The manifest tells the buckets of the graphs, and only those folders are read. Ids in any number come as a frame with a
    column `graph_id`; they meet the lines in a join that keeps both sides in their tasks.
    """
    lines = spark.read.schema("value string, bucket int").text(f"{path}/graphs")
    tail = F.substring_index("value", f"<{GRAPH}", -1)
    is_quad = tail.rlike(_AFTER_GRAPH) & (F.length(tail) < F.length("value"))
    triple = F.left("value", F.length("value") - F.length(tail) - len(f"<{GRAPH}"))
    named = lines.select(
        "bucket", F.url_decode(F.when(is_quad, F.substring_index(tail, ">", 1)).otherwise("")).alias("graph_id"),
        F.concat(F.when(is_quad, triple).otherwise(""), F.lit(".")).alias("line"))
    if graph_ids is not None:
        if not isinstance(graph_ids, DataFrame):
            graph_ids = spark.createDataFrame([(i,) for i in graph_ids], "graph_id string")
        how, ids = "left_anti" if others else "left_semi", graph_ids.select("graph_id").distinct()
        found = spark.read.parquet(f"{path}/manifest").join(ids, "graph_id", how).select("bucket").distinct().collect()
        named = named.where(F.col("bucket").isin(sorted(r["bucket"] for r in found))).join(ids.hint("shuffle_hash"), "graph_id", how)
    return parse_lines(named)


def message_lines(messages: DataFrame, codec: str = "zlib") -> DataFrame:
    """Distinct lines of N-Triples messages. A damaged body gives one null line."""
    text = decode_body(F.col("value"), codec)
    return messages.select("graph_id", "timestamp", text.alias("_text")).select(
        "graph_id", "timestamp", F.explode_outer(F.array_distinct(F.split("_text", "\n"))).alias("line")
    )
