"""Printing records (K1, K2).

``print()`` in the reference writes every record from the task that has it;
``print(id)`` puts a label in front of each.  Here a ``foreach`` writer
prints every row of every micro-batch from the executor's Python worker
(its standard output goes to the executor's log; in a local run, to the
driver's standard error), so nothing is cut off or pulled to the driver.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: the prefix of the reference's print-sink label.
SYNC_PREFIX = "sync_"


def sync_label(prefix: str = SYNC_PREFIX) -> str:
    """K2: the label the reference gives its print sink."""
    return f"{prefix}{int(time.time() * 1000)}"


def line(row: Row, label: str | None = None) -> str:
    """``(a,b,c)``, behind ``label> `` if there is one."""
    text = "(" + ",".join("null" if v is None else str(v) for v in row) + ")"
    return f"{label}> {text}" if label else text


class RowPrinter:
    """A ``foreach`` writer that prints each row."""

    def __init__(self, label: str | None = None):
        self.label = label

    def process(self, row: Row) -> None:
        sys.stdout.write(line(row, self.label) + "\n")

    def close(self, error) -> None:
        sys.stdout.flush()


def printing(df: DataFrame, label: str | None = None, output_mode: str = "append") -> DataStreamWriter:
    """K1/K2: a stream writer that prints every row; start it as any other."""
    return df.writeStream.outputMode(output_mode).foreach(RowPrinter(label))


def to_console(df: DataFrame, label: str | None = None, checkpoint: str | None = None,
               output_mode: str = "append") -> StreamingQuery:
    """K1/K2: print a streaming DataFrame."""
    w = printing(df, label, output_mode)
    if label:
        w = w.queryName(label)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()
