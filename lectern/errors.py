"""Errors, their counting and retries on the driver; inside plans, failures are columns."""

from __future__ import annotations

import functools
import logging
import time
from collections.abc import Callable
from typing import Any

from lectern.operators.statistics import ERROR_CATEGORIES

log = logging.getLogger(__name__)


class LecternError(Exception):
    """Base of this package's errors; context tells where it happened."""

    def __init__(self, message: str, context: dict[str, Any] | None = None) -> None:
        super().__init__(message)
        self.context = context or {}


class IngestionError(LecternError):
    pass


class ProcessingError(LecternError):
    pass


class ChunkingError(LecternError):
    pass


class CleaningError(LecternError):
    pass


class EnrichmentError(LecternError):
    pass


class ConfigurationError(LecternError):
    pass


class ValidationError(LecternError):
    pass


class ErrorCounter:
    """Counts errors by category; other holds those of unknown categories."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.counts = dict.fromkeys(ERROR_CATEGORIES, 0)

    def handle(self, error: Exception, category: str = "other", context: dict | None = None, reraise: bool = True) -> None:
        self.counts[category if category in self.counts else "other"] += 1
        log.error("%s error: %s %s", category, error, context or {})
        if reraise:
            raise error

    def summary(self) -> dict:
        total = sum(self.counts.values())
        return {"total_errors": total, "error_breakdown": dict(self.counts), "has_errors": total > 0}


def counted(counter: ErrorCounter, category: str = "other", reraise: bool = True) -> Callable:
    """Decorator: errors of the function are counted by the counter given."""

    def wrap(f: Callable) -> Callable:
        @functools.wraps(f)
        def inner(*args: Any, **kw: Any) -> Any:
            try:
                return f(*args, **kw)
            except Exception as e:
                counter.handle(e, category, {"function": f.__name__}, reraise)
                return None

        return inner

    return wrap


def safely(f: Callable, *args: Any, default: Any = None, **kw: Any) -> Any:
    """The function's result, or the default if it raises."""
    try:
        return f(*args, **kw)
    except Exception as e:
        log.warning("%s failed: %s", getattr(f, "__name__", f), e)
        return default


def retried(f: Callable, *args: Any, retries: int = 3, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep, **kw: Any) -> Any:
    """The function's result after up to retries + 1 attempts, waiting factor**attempt seconds between them; the last error is raised."""
    for attempt in range(retries + 1):
        try:
            return f(*args, **kw)
        except Exception:
            if attempt == retries:
                raise
            sleep(factor**attempt)
    raise AssertionError


def require(settings: dict, names: list[str]) -> None:
    """Raises a ValidationError that names the settings that are missing or empty."""
    missing = [n for n in names if not settings.get(n)]
    if missing:
        raise ValidationError(f"missing settings: {', '.join(missing)}", {"missing": missing})
