"""eddy: event-pipeline operators expressed as Spark DataFrame plans.

Every operator takes and returns DataFrames.  Batch forms are plain
Catalyst plans (window functions, joins, aggregates); streaming forms use
Structured Streaming with watermarks and ``transformWithState``.
"""

from eddy.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
