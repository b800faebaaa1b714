"""Calls to an outside service from a task: a window of calls in flight, retries, order kept."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Calls:
    """How a task calls: so many at once, so many retries, each after twice the pause of the one before. on_failure: "raise" ends the task, "none" gives None."""

    in_flight: int = 8
    retries: int = 2
    pause: float = 0.5
    on_failure: str = "raise"

    def __post_init__(self):
        if self.in_flight < 1 or self.retries < 0 or self.on_failure not in ("raise", "none"):
            raise ValueError("in_flight is 1 or more, retries 0 or more, on_failure 'raise' or 'none'")


def patient(call: Callable[..., Any], calls: Calls) -> Callable[..., Any]:
    """call, tried again as calls says."""

    def run(*args):
        for nth in range(calls.retries + 1):
            try:
                return call(*args)
            except Exception:
                if nth == calls.retries:
                    if calls.on_failure == "none":
                        return None
                    raise
                time.sleep(calls.pause * 2**nth)

    return run


def in_order(items: Iterable, call: Callable[[Any], Any], in_flight: int) -> Iterator[Any]:
    """The results of call for the items, in their order, with in_flight threads at work and at most as many items again waiting.

    After a failure no further item is begun; what is under way ends before the failure is raised.
    """
    waiting: deque = deque()
    with ThreadPoolExecutor(in_flight) as pool:
        try:
            for item in items:
                waiting.append(pool.submit(call, item))
                if len(waiting) >= 2 * in_flight:
                    yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()
        finally:
            for left in waiting:
                left.cancel()
