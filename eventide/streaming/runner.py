"""Query runner: checkpointed start, bounded runs, restart strategies.

Checkpoint folders are taken from ``spark.checkpoint.dir`` (shared storage
on a cluster); a restarted query with the same checkpoint continues from
its last committed batch with its state.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventide.session import checkpoint_root


@dataclass
class FixedDelay:
    """Restart up to ``attempts`` times, waiting ``delay_s`` in between."""
    attempts: int = 3
    delay_s: float = 60.0

    def allow(self, failures: list[float]) -> bool:
        return len(failures) <= self.attempts


@dataclass
class FailureRate:
    """Restart while fewer than ``max_failures`` failures happened within
    ``interval_s``; wait ``delay_s`` before each restart."""
    max_failures: int = 3
    interval_s: float = 300.0
    delay_s: float = 60.0

    def allow(self, failures: list[float]) -> bool:
        now = time.time()
        return sum(1 for f in failures if now - f <= self.interval_s) <= self.max_failures


def start(df: DataFrame, sink: str | Callable, name: str | None = None,
          mode: str = "append", checkpoint: str | None = None, trigger: dict | None = None,
          options: dict | None = None, path: str | None = None) -> StreamingQuery:
    """Start a checkpointed query.  ``sink`` is a format name or a
    ``foreachBatch`` function; ``trigger`` e.g. ``{"processingTime": "500
    milliseconds"}`` (checkpoint cadence) or ``{"availableNow": True}``.

    Without ``checkpoint`` the folder follows from ``name`` alone, so a query
    of that name goes on where it stopped; one of the two is required."""
    if not checkpoint and not name:
        raise ValueError("a query needs a name or a checkpoint folder to be restarted from")
    spark = df.sparkSession
    ck = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/query-{name}"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ck)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
    if name:
        w = w.queryName(name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def run_until_done(query: StreamingQuery, timeout_s: float = 300.0) -> None:
    """Wait for an ``availableNow`` query to finish, within a time limit."""
    finished = query.awaitTermination(timeout_s)
    if not finished:
        query.stop()
        raise TimeoutError(f"query {query.name} did not finish in {timeout_s}s")
    if query.exception():
        raise RuntimeError(str(query.exception()))


def run_with_restarts(make_query: Callable[[], StreamingQuery], strategy=None,
                      timeout_s: float | None = None, sleep=time.sleep) -> int:
    """Run a query; when it fails, restart it from its checkpoint as the
    strategy allows.  Returns the number of restarts.  A query that still
    runs after ``timeout_s`` is stopped and reported as a TimeoutError."""
    strategy = strategy or FixedDelay()
    failures: list[float] = []
    while True:
        q = make_query()
        try:
            done = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
            if not done:
                q.stop()
                raise TimeoutError(f"query {q.name} still ran after {timeout_s}s")
            if q.exception() is None:
                return len(failures)
            raise RuntimeError(str(q.exception()))
        except TimeoutError:
            raise
        except Exception:  # noqa: BLE001
            failures.append(time.time())
            try:
                q.stop()
            except Exception:  # noqa: BLE001
                pass
            if not strategy.allow(failures):
                raise
            sleep(strategy.delay_s)


class BatchCommitted:
    """Callback when a micro-batch (and its state/checkpoint) is committed:
    ``on_commit(name, batch_id, watermark, rows)`` from the query's progress
    events.  Register with ``spark.streams.addListener(...)``."""

    def __new__(cls, on_commit):
        from pyspark.sql.streaming import StreamingQueryListener

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                on_commit(p.name, p.batchId, (p.eventTime or {}).get("watermark"), p.numInputRows)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        return _Listener()
