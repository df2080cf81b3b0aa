"""Session settings the library is tuned for. Any session works; these give the intended plans."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

# What steps that write tables set for as long as they last, where the session has not chosen itself.
WHILE_WRITING = {
    # Shuffle files go when the action that made them ends. Otherwise those of a whole run pile up until the driver's heap fills.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

SETTINGS = {
    # Runtime re-planning: partition sizes, join choice and skewed keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Landing times and dates carry no zone.
    "spark.sql.session.timeZone": "UTC",
    # A task that writes few folders at once keeps one writer each and need not sort its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Tables of one run are independent jobs.
    "spark.scheduler.mode": "FAIR",
}

_writing: dict[SparkSession, tuple[int, list[str]]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def while_writing(spark: SparkSession) -> Iterator[None]:
    """Steps inside run with ``WHILE_WRITING``. They can be nested and run at once; the last to end takes the settings back."""
    with _lock:
        inside, ours = _writing.get(spark, (0, []))
        if not inside:
            ours = [name for name in WHILE_WRITING if spark.conf.get(name, None) is None]
            for name in ours:
                spark.conf.set(name, WHILE_WRITING[name])
        _writing[spark] = inside + 1, ours
    try:
        yield
    finally:
        with _lock:
            inside, ours = _writing.pop(spark)
            if inside > 1:
                _writing[spark] = inside - 1, ours
            else:
                for name in ours:
                    spark.conf.unset(name)


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (SETTINGS | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
