"""Secret scan: fixed patterns, and strings that a token vocabulary spells badly."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, hence the same as runs of any length that have 24 or more
KINDS = ("assign", "access", "hex", "token")
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # of the rank files

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
STRING = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"(?ai:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})")
NUMBER = re.compile(r"[0-9+/_=-]+")
IDENTIFIER = re.compile(r"(?:[A-Za-z]+[0-9]{0,4}[/_=-]+)+[A-Za-z]*[0-9]{0,4}|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*[0-9]{0,4}|[A-Z]+[0-9]{0,4}")
SEPARATORS = re.compile(r"[/_=-]+")
NAME_SHARE = 7 / 8  # of most_chars: what has the shape of a name must be spelled still worse
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str, lowered: bytes | None = None) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    found: list[Span] = []
    lowered = text.encode().lower() if lowered is None else lowered
    if any(k in lowered for k in KEYWORDS):
        found += ((m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6)
    if b"akia" in lowered:
        found += ((m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20)
    found += ((m.start(), 2, m.end()) for m in HEX.finditer(text))
    return sorted(found)


def excluded(string: str) -> bool:
    """Known digests, UUIDs and plain numbers are no secrets."""
    if len(string) in DIGEST_LENGTHS and not string.strip("0123456789abcdefABCDEF"):
        return True
    return bool(UUID.fullmatch(string) or NUMBER.fullmatch(string))


def made_of_words(string: str, encode, least_chars: float) -> bool:
    """Whether a string has the shape of a name and its parts are spelled in few tokens, as words are.

    Parts of up to three characters are one or two tokens in any case and do not count. Upper-case words may be spelled
    like their lower-case forms.
    """
    if not IDENTIFIER.fullmatch(string):
        return False
    parts = [p for p in SEPARATORS.split(string) if len(p) > 3]
    tokens = sum(min(len(encode(p)), len(encode(p.lower()))) if p.isupper() else len(encode(p)) for p in parts)
    return sum(map(len, parts)) > least_chars * tokens or not parts


def random_spans(text: str, taken: list[Span], encode, most_chars: float) -> list[Span]:
    """Strings with at most `most_chars` characters per token that no base span touches."""
    out = []
    for m in STRING.finditer(text):
        string = m[0]
        if excluded(string) or any(a < m.end() and m.start() < b for a, _, b in taken):
            continue
        if len(string) <= most_chars * len(encode(string)) and not made_of_words(string, encode, most_chars * NAME_SHARE):
            out.append((m.start(), 3, m.end()))
    return out


def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_encoders: dict[int, object] = {}


def _encoder(shared):
    """The encoder of a broadcast rank file, built once per Python worker."""
    key = shared._id if hasattr(shared, "_id") else id(shared)
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key].encode_ordinary


def scan_secrets(
    docs: DataFrame,
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_chars: float = 2.0,
) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_token, base_sha256, spans.

    Base patterns give the spans `assign`, `access` and `hex`. The token test adds `token`: strings of 16 or more
    characters of which a token of the vocabulary covers `most_chars` or fewer on average, without known digests
    and identifiers, and without those that a base span touches. Strings with the shape of a name (one case, camel case,
    or letters with separators) are identifiers unless a token covers 7/8 of `most_chars` or fewer of their parts. Spans are kind:start:end in code points, end
    exclusive, by start and kind. The vocabulary is a file of the driver (some hundred KB, broadcast). Null
    texts are empty; repeated rows and null ids keep their row. No shuffle; a task holds one batch of whole texts.
    """
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                every = sorted(base + random_spans(text, base, encode, most_chars))
                counts = [sum(k == kind for _, k, _ in every) for kind in range(4)]
                rows.append((*counts, hashlib.sha256(spell(base).encode()).hexdigest(), spell(every)))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=["id", *OUT]
            )

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = texts.mapInArrow(scan, "id long, n_assign long, n_access long, n_hex long, n_token long, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)


OUT = ("n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans")
