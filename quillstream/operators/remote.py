"""Calling remote services from a partition: retries, jitter, throttling and pacing, as plain testable functions.

A service's quota is shared by the partitions that call it at once, whose number Spark knows.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass

#: What the message of a passing failure holds, and its status codes; statuses that are final.
TRANSIENT_WORDS = ("429", "too many requests", "503", "service unavailable", "connection reset", "connection refused", "connection timed out", "timeout", "temporarily unavailable", "502", "504")
TRANSIENT_CODES = (429, 502, 503, 504)
FINAL_CODES = (400, 401, 403, 404, 409)


@dataclass(frozen=True)
class Retry:
    tries: int = 6
    base: float = 1.0
    ceiling: float = 30.0
    extra: float = 0.0  #: added jitter
    every_error: bool = False  #: not only transient ones
    long_wait: float = 30.0  #: a quota answer that asks for more
    long_waits: int = 3  #: gives up after so many of these in a row


def is_transient(error: Exception) -> bool:
    said = str(error).lower()
    return getattr(error, "status_code", None) in TRANSIENT_CODES or any(w in said for w in TRANSIENT_WORDS)


def jitter(attempt: int, r: Retry, draw: Callable[[float, float], float] = random.uniform) -> float:
    """A wait between 0 and the smaller of ceiling and base * 2**attempt, plus up to extra."""
    return draw(0, min(r.ceiling, r.base * 2**attempt)) + (draw(0, r.extra) if r.extra else 0)


def call(step: Callable, r: Retry = Retry(), sleep: Callable[[float], None] = time.sleep):
    """step()'s result, tried again after errors that may pass."""
    waits = 0
    for attempt in range(r.tries):
        try:
            return step()
        except Exception as e:  # noqa: BLE001
            asked = getattr(e, "retry_after", None)
            waits = waits + 1 if asked and asked > r.long_wait else 0
            final = getattr(e, "status_code", None) in FINAL_CODES or not (r.every_error or is_transient(e))
            if final or attempt == r.tries - 1 or waits >= r.long_waits:
                raise
            sleep(asked or jitter(attempt, r))


@dataclass
class Quota:
    """What a service has said about its limits, and the waits that follow."""

    callers: int = 1
    # The share held back, tokens a minute where no limit was said, the shortest and longest wait for
    # tokens, and the wait where requests run out.
    reserve: float = 0.2
    fallback: int = 240_000
    shortest: float = 0.5
    longest: float = 60.0
    few_requests: float = 2.0
    tokens: int | None = None
    requests: int | None = None
    limit: int | None = None

    def read(self, headers: dict[str, str]) -> None:
        """Takes the x-ratelimit fields that are whole numbers."""
        for name, field in (("remaining-tokens", "tokens"), ("remaining-requests", "requests"), ("limit-tokens", "limit")):
            value = headers.get(f"x-ratelimit-{name}")
            if value is not None and str(value).isdigit():
                setattr(self, field, int(value))

    def throttle(self, batch: int) -> float:
        """Seconds to wait before a batch of tokens."""
        wait = 0.0
        if self.tokens is not None and batch > 0:
            short = batch * (1 + self.reserve) - self.tokens / max(1, self.callers)
            if short > 0:
                wait = min(self.longest, max(self.shortest, short / max(1.0, (self.limit or self.fallback) / 60)))
        return wait + (self.few_requests if self.requests is not None and self.requests < 2 else 0.0)

    def pace(self, batch: int) -> float:
        """Seconds of this caller's share that a batch has used."""
        return batch / ((self.limit or self.fallback) / max(1, self.callers)) * 60
