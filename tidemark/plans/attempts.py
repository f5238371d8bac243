"""Bounded repetition of driver-side calls.  Failed tasks are repeated by Spark itself."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

LOGGER = logging.getLogger(__name__)

# Fixed limits.
QUERY_ATTEMPTS = 5
CATALOG_ATTEMPTS = 30
CATALOG_WAIT_SECONDS = 120.0
DROPPED_CONNECTION = "server closed the connection unexpectedly"

Result = TypeVar("Result")


def attempt(
    action: Callable[[], Result],
    attempts: int = QUERY_ATTEMPTS,
    wait_seconds: float = 0.0,
    may_repeat: Callable[[Exception], bool] = lambda error: True,
) -> Result:
    """The action's result after at most ``attempts`` calls; the last error is raised."""
    for number in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if number == attempts or not may_repeat(error):
                raise
            LOGGER.warning("Attempt %d of %d failed: %s", number, attempts, error)
            time.sleep(wait_seconds)
    raise ValueError("At least one attempt is needed")


def attempt_catalog(action: Callable[[], Result], wait_seconds: float = CATALOG_WAIT_SECONDS) -> Result:
    """Repeat a catalog read while the database drops connections; other errors are final."""
    return attempt(action, CATALOG_ATTEMPTS, wait_seconds, lambda error: DROPPED_CONNECTION in str(error))
