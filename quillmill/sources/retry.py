"""Requests that wait their turn, and are made again where the fault may pass."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

# HTTP statuses that a later request may not meet.
PASSING = frozenset({408, 429, 500, 502, 503, 504, 522, 524})

T = TypeVar("T")


@dataclass(frozen=True)
class Patience:
    """Seconds before each request of a task, how often it is made again, and seconds before the first time, doubled for each later one."""

    delay: float = 0.0
    retries: int = 3
    backoff: float = 1.5

    def ask(self, request: Callable[[], T], wait: Callable[[float], None] = time.sleep) -> T:
        """What the request gives; a fault that passes costs time, any other one and the last one are raised."""
        for turn in range(self.retries + 1):
            if self.delay:
                wait(self.delay)
            try:
                return request()
            except Exception as fault:
                if turn == self.retries or not passing(fault):
                    raise
                wait(self.backoff * 2**turn)
        raise AssertionError


def passing(fault: Exception) -> bool:
    """Whether a fault is of the connection, or a status that may change; its status is an attribute of it or of its response."""
    status = getattr(fault, "status", None) or getattr(fault, "code", None) or getattr(getattr(fault, "response", None), "status_code", None)
    if isinstance(status, int):
        return status in PASSING
    return isinstance(fault, (ConnectionError, TimeoutError, OSError)) and not isinstance(fault, (FileNotFoundError, PermissionError))
