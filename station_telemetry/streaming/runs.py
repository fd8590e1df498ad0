"""How streaming queries run: once over what is there, or on an interval; alone or together."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger(__name__)

DEFAULT_INTERVAL_SECONDS = 30  # fixed value


def start(writer: DataStreamWriter, name: str, once: bool = False, interval: int | None = None) -> StreamingQuery:
    """Starts a query. `once` handles all waiting input and ends; otherwise it keeps running.

    Without an interval, batches follow each other as the source allows: set an interval for
    file sources, and leave it out where the source has its own flush policy.
    """
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=f"{interval} seconds")
    return writer.queryName(name).start()


def run_once(writer: DataStreamWriter, name: str) -> None:
    """One pass over the waiting input; a failure is raised and progress stays at the last batch."""
    start(writer, name, once=True).awaitTermination()


def watch(
    make_writer: Callable[[], DataStreamWriter],
    name: str,
    interval: int = DEFAULT_INTERVAL_SECONDS,
    stop: Callable[[], bool] = lambda: False,
) -> None:
    """Passes on an interval until `stop()`; a failed pass is logged and tried again."""
    while not stop():
        query = None
        try:
            query = start(make_writer(), name, interval=interval)
            while not query.awaitTermination(1):  # raises when the query failed
                if stop():
                    return
        except Exception:
            log.exception("%s failed, next try in %d s", name, interval)
            time.sleep(interval)
        finally:
            if query is not None:
                query.stop()


class StateLog(StreamingQueryListener):
    """Logs starts, ends and failures of queries."""

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name)

    def onQueryProgress(self, event) -> None:
        log.debug("query %s: %s rows", event.progress.name, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s ended", event.id)


class Central:
    """Runs several queries together and stops them in reverse order."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.queries: list[StreamingQuery] = []
        self._listener = StateLog()
        spark.streams.addListener(self._listener)

    def add(self, query: StreamingQuery) -> StreamingQuery:
        self.queries.append(query)
        return query

    def run(self) -> None:
        """Waits until one query ends or fails, then stops the others."""
        self._until(self.spark.streams.awaitAnyTermination)

    def finish(self) -> None:
        """Waits for queries that end by themselves."""
        self._until(lambda: [query.awaitTermination() for query in self.queries])

    def _until(self, done: Callable[[], object]) -> None:
        try:
            done()
        except Exception:
            log.exception("a query failed, stopping all")
            raise
        finally:
            self.stop()

    def stop(self) -> None:
        for query in reversed(self.queries):
            try:
                query.stop()
            except Exception:
                log.exception("could not stop query %s", query.name)
        self.queries.clear()
        self.spark.streams.removeListener(self._listener)
