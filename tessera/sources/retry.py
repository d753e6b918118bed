"""Retrying driver-side actions; tasks are retried by Spark itself."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException

#: Attempts, first pause, longest pause in seconds.
ATTEMPTS, FIRST_PAUSE, LONGEST_PAUSE = 6, 0.25, 8.0


def retryable(f: Callable | None = None, *, attempts: int = ATTEMPTS, on: tuple = (Py4JJavaError, OSError), sleep: Callable[[float], None] = time.sleep):
    """Repeat on transient errors with doubling pauses; the last error is raised. Errors of analysis are permanent."""

    def wrap(g: Callable) -> Callable:
        @functools.wraps(g)
        def run(*a, **k):
            for n in range(attempts):
                try:
                    return g(*a, **k)
                except (AnalysisException, ParseException):
                    raise
                except on:
                    if n + 1 == attempts:
                        raise
                    sleep(min(LONGEST_PAUSE, FIRST_PAUSE * 2**n))

        return run

    return wrap(f) if f else wrap
