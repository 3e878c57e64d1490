"""Stopping streams from outside: a signal file, a listener that looks for it, a sleep that it ends."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidewell.sources.files import Files

log = logging.getLogger(__name__)


class StopSignal:
    """The existence of ``{root}/{dag_id}``; if that can't be told, there is no signal."""

    def __init__(self, spark: SparkSession, root: str, dag_id: str) -> None:
        self._spark, self.path = spark, f"{root.rstrip('/')}/{dag_id}"

    @property
    def _files(self) -> Files:
        return Files(self._spark, self.path)  # anew: a cached file system may have been closed since

    def given(self) -> bool:
        try:
            return self._files.exists(self.path)
        except Exception as e:
            log.warning("signal %s can't be checked: %s", self.path, e)
            return False

    def give(self) -> None:
        self._files.create(self.path, "")

    def clear(self) -> None:
        self._files.delete(self.path)


def interruptible_sleep(seconds: float, stopped: Callable[[], bool], step: float = 10.0) -> bool:
    """Sleep, looking for a stop at least every ``step`` seconds; True if it came."""
    end = time.monotonic() + seconds
    while not stopped():
        left = end - time.monotonic()
        if left <= 0:
            return False
        time.sleep(min(step, left))
    return True


class StopListener(StreamingQueryListener):
    """Logs progress and stops all queries once the signal is given."""

    def __init__(self, spark: SparkSession, signal: StopSignal) -> None:
        self._spark, self._signal = spark, signal
        self.progress: list[dict] = []

    def _look(self) -> None:
        if self._signal.given():
            for q in self._spark.streams.active:
                log.info("stopping %s", q.name or q.id)
                q.stop()

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info("%s batch %s: %s rows", p.name or p.id, p.batchId, p.numInputRows)
        self.progress.append({"id": str(p.id), "batch": p.batchId, "rows": p.numInputRows})
        self._look()

    def onQueryIdle(self, event) -> None:
        self._look()

    def onQueryTerminated(self, event) -> None:
        log.info("ended %s: %s", event.id, event.exception or "no error")
