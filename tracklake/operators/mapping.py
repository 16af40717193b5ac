"""Spec-driven typing of rows: row names and classes from a mapping table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import CLASS_MAP
from ..vocab import (
    DATA,
    DEFAULT_BASE_CLASSES,
    DEFAULT_EXTENSION_CLASSES,
    EXTENSION,
    IES,
    VESSEL_CLASS_MAP,
)


@dataclass
class UriPolicy:
    """How a row gets its name: GUID, or the value of a field with a rule for blanks."""

    mapping_type: str = "GUID"  # GUID | FIELD
    uri_base: str = DATA
    field: str | None = None
    missing: str = "GUID"  # SKIP | GUID | ERROR
    random: bool = False  # uuid() in place of the hashed name

    def __post_init__(self):
        if self.mapping_type == "FIELD" and not self.field:
            raise ValueError("a FIELD policy needs a field")


@dataclass
class ClassPolicy:
    base_uri: str = IES
    extension_uri: str = EXTENSION
    default_base: list[str] = field(default_factory=lambda: list(DEFAULT_BASE_CLASSES))
    default_extension: list[str] = field(default_factory=lambda: list(DEFAULT_EXTENSION_CLASSES))


def vessel_class_map(spark: SparkSession) -> DataFrame:
    """The ten fixed lines. Spark knows no size for a local list, so the hint keeps it from shuffling the facts on the code."""
    return F.broadcast(spark.createDataFrame(VESSEL_CLASS_MAP, CLASS_MAP))


def name_rows(rows: DataFrame, policy: UriPolicy, key: list[str], uri: str = "row_uri") -> DataFrame:
    """Add the row's name. SKIP drops rows without an id, ERROR fails the job on the first one."""
    made: Column = F.expr("uuid()") if policy.random else tx.hashed(F.lit("row"), *[F.col(k).cast("string") for k in key])
    generated = F.concat(F.lit(policy.uri_base), made)
    if policy.mapping_type == "GUID":
        return rows.withColumn(uri, generated)
    missing = tx.blank(F.col(policy.field))
    own = F.concat(F.lit(policy.uri_base), F.col(policy.field))
    if policy.missing == "SKIP":
        return rows.where(~missing).withColumn(uri, own)
    if policy.missing == "GUID":
        return rows.withColumn(uri, F.when(missing, generated).otherwise(own))
    failed = F.raise_error(F.lit(f"no value in id field {policy.field}")).cast("string")
    return rows.withColumn(uri, F.when(missing, failed).otherwise(own))


def _prefixed(names: Column, base: str) -> Column:
    return F.transform(names, lambda c: F.concat(F.lit(base), c))


def type_rows(
    rows: DataFrame, class_map: DataFrame, policy: ClassPolicy | None = None, on: str = "vessel_type",
    patterns: list[tuple[str, list[str], list[str]]] | None = None,
) -> DataFrame:
    """Add `classes`: exact match on the code, else the first matching pattern, else the defaults.

    The class map is a plain left join: the fixed map comes with a broadcast hint; for a map of one's own Spark broadcasts
    it if its known size is under spark.sql.autoBroadcastJoinThreshold and shuffles it otherwise. `patterns` is the list of
    (regular expression, base classes, extension classes) of the mapping spec, in order.
    """
    policy = policy or ClassPolicy()
    lookup = class_map.select(
        F.col("vessel_type").alias("_code"), F.col("base_classes").alias("_base"), F.col("extension_classes").alias("_ext")
    )
    found = rows.join(lookup, F.col(on) == F.col("_code"), "left")
    base, ext = F.col("_base"), F.col("_ext")
    names = lambda values: F.lit(values).cast("array<string>") if values else F.array().cast("array<string>")
    if patterns:
        first_base, first_ext = F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>")
        for pattern, pattern_base, pattern_ext in reversed(patterns):
            hit = F.col(on).rlike(pattern)
            first_base = F.when(hit, names(pattern_base)).otherwise(first_base)
            first_ext = F.when(hit, names(pattern_ext)).otherwise(first_ext)
        base, ext = F.coalesce(base, first_base), F.coalesce(ext, first_ext)
    matched = F.concat(_prefixed(base, policy.base_uri), _prefixed(ext, policy.extension_uri))
    default = F.concat(
        _prefixed(names(policy.default_base), policy.base_uri),
        _prefixed(names(policy.default_extension), policy.extension_uri),
    )
    classes = F.when(base.isNull() | (F.size(matched) == 0), default).otherwise(matched)
    return found.select(*rows.columns, classes.alias("classes"))


def map_pings(
    pings: DataFrame, class_map: DataFrame, uri: UriPolicy | None = None, classes: ClassPolicy | None = None,
    graph_id: Column | None = None,
) -> DataFrame:
    """Pings ready for `vessel_state_graphs`: one graph per ping."""
    graph = F.concat(F.lit("msg-"), F.col("seq").cast("string")) if graph_id is None else graph_id
    keyed = pings.withColumn("graph_id", graph)
    return type_rows(name_rows(keyed, uri or UriPolicy(), ["graph_id"]), class_map, classes)
