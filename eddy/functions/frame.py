"""Schema-registry wire frames on binary Kafka values.

A framed record is ``0x00`` (magic byte), the writer schema id as a
4-byte big-endian integer, then the Avro binary body.  Splitting and
building frames are plain binary expressions, so they run in codegen and
need no connector; only the body codec needs ``from_avro``/``to_avro``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format: magic byte 0, then a 4-byte schema id.
MAGIC_HEX = "00"
ID_BYTES = 4
HEADER_BYTES = 1 + ID_BYTES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frame_magic_ok(value) -> Column:
    return F.hex(F.substring(_col(value), 1, 1)) == F.lit(MAGIC_HEX)


def frame_schema_id(value) -> Column:
    """Writer schema id (int) from bytes 2..5."""
    return F.conv(F.hex(F.substring(_col(value), 2, ID_BYTES)), 16, 10).cast("int")


def frame_body(value) -> Column:
    """The Avro body: everything after the 5-byte header."""
    return F.substring(_col(value), HEADER_BYTES + 1, 2_147_483_647)


def split_frame(value) -> Column:
    """struct(magic_ok, schema_id, body)."""
    return F.struct(frame_magic_ok(value).alias("magic_ok"),
                    frame_schema_id(value).alias("schema_id"),
                    frame_body(value).alias("body"))


def build_frame(schema_id, body) -> Column:
    """Prefix an Avro body with the magic byte and the schema id."""
    sid = schema_id if isinstance(schema_id, Column) else F.lit(int(schema_id))
    header = F.unhex(F.concat(F.lit(MAGIC_HEX), F.lpad(F.hex(sid.cast("bigint")), 8, "0")))
    return F.concat(header, _col(body))


def value_subject(topic: str) -> str:
    """Registry subject of a topic's value schema (``<topic>-value``)."""
    return f"{topic}-value"


def key_subject(topic: str) -> str:
    """Registry subject of a topic's key schema (``<topic>-key``)."""
    return f"{topic}-key"
