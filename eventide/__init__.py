"""eventide: keyed event-stream analytics on Spark DataFrames.

The same operator functions accept a batch DataFrame (bounded input) or a
streaming DataFrame where Spark allows it; per-row stateful logic that
Structured Streaming cannot express with expressions lives in
``eventide.streaming``.
"""

import sys as _sys

from eventide.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]


def _ship_by_value() -> None:
    """Pickle this package's functions and classes by value, so Python
    workers (mapInPandas replays, transformWithState processors) run them
    without the package being installed on the executors."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: rely on installation
        pass


_ship_by_value()
