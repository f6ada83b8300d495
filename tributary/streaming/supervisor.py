"""Several streaming queries under one supervisor."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def supervise(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait until every query ends; when any fails, stop all the others
    and raise its error.  ``awaitAnyTermination`` sees whichever query
    ends first (the reference waits on the first query only)."""
    sm = spark.streams
    live = list(queries)
    try:
        while live:
            try:
                sm.awaitAnyTermination(timeout_s) if timeout_s else sm.awaitAnyTermination()
            except Exception as e:  # noqa: BLE001 - a query ended with an error
                raise RuntimeError(f"streaming query failed: {e}") from e
            sm.resetTerminated()
            done = [q for q in live if not q.isActive]
            if not done and timeout_s:
                raise TimeoutError("streaming queries still running after the timeout")
            for q in done:
                live.remove(q)
                err = q.exception()
                if err is not None:
                    raise RuntimeError(f"query {q.name or q.id} failed: {err}")
    finally:
        for q in live:
            if q.isActive:
                q.stop()
