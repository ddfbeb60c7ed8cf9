"""Durations and outcomes of stages, as rows."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


class Trace:
    """Spans of a run: with trace.span("chunk", documents=3): ...; errors are recorded and raised on."""

    def __init__(self) -> None:
        self.spans: list[tuple[str, float, bool, str | None, str]] = []

    @contextmanager
    def span(self, name: str, **attributes: object) -> Iterator[None]:
        began, error = time.perf_counter(), None
        try:
            yield
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            raise
        finally:
            self.spans.append((name, time.perf_counter() - began, error is None, error, str(attributes)))
            log.info("%s took %.3f s", name, self.spans[-1][1])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.spans, "name string, seconds double, success boolean, error string, attributes string")
