"""Framed Avro values: decode by writer schema id.

The reference looks up the reader schema from a registry while building
the job, and the deserializer fetches each writer schema by the id in the
frame.  Here both are arguments: ``schemas`` maps writer ids to schema
JSON and ``reader_schema`` is the schema the job reads with.  Decoding is
one projection: a ``CASE`` over the known ids, each branch a ``from_avro``
with the reader schema as the evolved schema.  Frames with a bad magic
byte or an unknown id decode to null; ``undecodable`` selects them.

``from_avro``/``to_avro`` need the ``spark-avro`` package on the
classpath; without it Spark raises ``AVRO_NOT_LOADED_SQL_FUNCTIONS_UNUSABLE``
when the plan is analysed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.functions.frame import build_frame, frame_body, frame_magic_ok, frame_schema_id


def _avro():
    from pyspark.sql.avro import functions as A   # present in pyspark; jar may not be
    return A


def decode_column(value, schemas: dict[int, str], reader_schema: str,
                  mode: str = "FAILFAST") -> Column:
    """The decoded record (struct in the reader schema), or null."""
    A = _avro()
    sid, body = frame_schema_id(value), frame_body(value)
    out = None
    for wid, writer in schemas.items():
        dec = A.from_avro(body, writer, {"avroSchema": reader_schema, "mode": mode})
        cond = frame_magic_ok(value) & (sid == F.lit(int(wid)))
        out = F.when(cond, dec) if out is None else out.when(cond, dec)
    return out


def decode_framed(df: DataFrame, schemas: dict[int, str], reader_schema: str,
                  value_col: str = "value", out: str = "record") -> DataFrame:
    """Add the decoded record as ``out`` (keeps the other columns)."""
    return df.withColumn(out, decode_column(F.col(value_col), schemas, reader_schema))


def undecodable(df: DataFrame, schemas: dict[int, str], value_col: str = "value") -> DataFrame:
    """Frames with a bad magic byte or a writer id not in ``schemas``, and null or short values."""
    v = F.col(value_col)
    known = frame_schema_id(v).isin([int(k) for k in schemas])
    return df.where(~F.coalesce(frame_magic_ok(v) & known, F.lit(False)))


def encode_framed(record: Column, schema_id: int, schema: str) -> Column:
    """K3: ``to_avro`` of a record, framed with ``schema_id``."""
    return build_frame(schema_id, _avro().to_avro(record, schema))


# Fixed value: the Avro schema of a plain long key.
LONG_KEY_SCHEMA = '"long"'
