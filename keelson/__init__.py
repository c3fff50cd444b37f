"""keelson: ordered event-stream analytics as Spark DataFrame jobs.

Every public operator takes DataFrames and returns a DataFrame, so it composes with
``df.transform`` and works the same on a batch read or (where noted) a streaming read.
"""

from keelson.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
