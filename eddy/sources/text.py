"""Text lines, one record per line.

The reference reads a text file, or a socket, line by line.  Batch jobs
read files with ``spark.read.text``; streaming jobs take any streaming
DataFrame with a ``value`` column, by default a folder of text files
(``readStream.text``), which is replayable from the checkpoint - unlike
a socket.  A socket source stays the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch lines as a ``value`` column."""
    return spark.read.text(path)


# Files read in one micro-batch: keyed state sees the rows of one key in one
# micro-batch together, so this bounds what a task holds of a key.
MAX_FILES_PER_TRIGGER = 64


def stream_lines(spark: SparkSession, path: str,
                 max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """New files in ``path`` as a stream of lines; ``None`` takes all there are at once."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return r.load(path)
