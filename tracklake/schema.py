"""Row layouts of the tables and messages the engine reads and writes."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(*pairs) -> StructType:
    return StructType([StructField(name, kind) for name, kind in pairs])


_S, _D, _L, _T = StringType(), DoubleType(), LongType(), TimestampType()

# Canonical ping. `seq` is unique and breaks ties between equal timestamps.
PING = _fields(
    ("mmsi", _S), ("ts", _T), ("lat", _D), ("lon", _D), ("sog", _D), ("cog", _D), ("heading", _D),
    ("vessel_name", _S), ("imo", _S), ("call_sign", _S), ("vessel_type", _S), ("status", _S),
    ("length", _D), ("width", _D), ("draft", _D), ("cargo", _S), ("seq", _L),
)
PING_FIELDS = [f.name for f in PING if f.name != "seq"]

# The 16 source columns, in message order (fixed values).
AIS_COLUMNS = [
    "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading", "VesselName", "IMO", "CallSign",
    "VesselType", "Status", "Length", "Width", "Draft", "Cargo",
]
# The 11 columns of the alternative craft layout, in message order (fixed values).
OZ_COLUMNS = [
    "CRAFT_ID", "LON", "LAT", "COURSE", "SPEED", "TYPE", "SUBTYPE", "LENGTH", "BEAM", "DRAUGHT", "TIMESTAMP",
]
AIS_TEXT = _fields(*[(c, _S) for c in AIS_COLUMNS])
OZ_TEXT = _fields(*[(c, _S) for c in OZ_COLUMNS])

TRACK_STATE = _fields(
    ("timestamp", _S), ("coordinates", ArrayType(_S)), ("epsgCode", _S), ("velocityVector", ArrayType(_S)),
)
TRACK_MESSAGE = _fields(("metadata", MapType(_S, _S)), ("states", ArrayType(TRACK_STATE)))

TRIPLE_COLUMNS = ["graph_id", "s", "p", "o", "o_kind", "o_dtype"]
TRIPLE = _fields(*[(c, _S) for c in TRIPLE_COLUMNS])

CLASS_MAP = _fields(("vessel_type", _S), ("base_classes", ArrayType(_S)), ("extension_classes", ArrayType(_S)))

# Column names of a Kafka frame; every message source and sink uses them.
MESSAGE = _fields(
    ("key", BinaryType()), ("value", BinaryType()), ("topic", _S), ("partition", IntegerType()),
    ("offset", _L), ("timestamp", _T),
)
