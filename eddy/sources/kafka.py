"""Kafka topics as sources and sinks (S3, K3, K4).

Only option building lives here; the ``kafka`` format itself comes from
the ``spark-sql-kafka`` package, which must be on the cluster's
classpath.  The reference reads from the earliest offset and sets no
consumer group or commit policy; Structured Streaming tracks offsets in
its checkpoint, which gives exactly-once replay on restart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.sources.avro import LONG_KEY_SCHEMA, encode_framed


# Records read in one micro-batch (see ``text.MAX_FILES_PER_TRIGGER``).
MAX_OFFSETS_PER_TRIGGER = 5_000_000


def source_options(bootstrap: str, topic: str, starting: str = "earliest",
                   max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    """S3: options for ``readStream.format("kafka")``; ``None`` sets no bound."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def read_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """S3: the topic as a stream of (key, value, topic, partition, offset, ..)."""
    return spark.readStream.format("kafka").options(**source_options(bootstrap, topic, **kw)).load()


def sink_options(bootstrap: str, topic: str | None = None) -> dict[str, str]:
    """Options for ``writeStream.format("kafka")``; no topic = per-row ``topic``."""
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topic:
        opts["topic"] = topic
    return opts


def value_only(record: Column, schema_id: int, schema: str) -> list[Column]:
    """K3: the ``value`` column of an unkeyed framed-Avro record."""
    return [encode_framed(record, schema_id, schema).alias("value")]


def keyed(key: Column, key_schema_id: int, record: Column, schema_id: int, schema: str,
          topic: str | None = None) -> list[Column]:
    """K4: ``key`` and ``value`` (and ``topic``) columns of a keyed record."""
    cols = [encode_framed(key, key_schema_id, LONG_KEY_SCHEMA).alias("key"),
            encode_framed(record, schema_id, schema).alias("value")]
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return cols


def kafka_batch_writer(bootstrap: str, topic: str, encode):
    """A ``foreachBatch`` writer: ``encode(batch)`` -> key/value columns -> topic.

    ``encode`` returns the columns, e.g. ``lambda d: value_only(struct(*d.columns), ..)``.
    """
    def write(batch: DataFrame) -> None:
        (batch.select(*encode(batch)).write.format("kafka")
         .options(**sink_options(bootstrap, topic)).save())
    return write
