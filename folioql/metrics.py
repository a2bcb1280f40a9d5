"""What an engine did: spans with their seconds, and counters.  A listener may take them elsewhere."""

from __future__ import annotations

import time
from collections import Counter, deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass


@dataclass(frozen=True)
class Span:
    name: str
    detail: str
    seconds: float
    error: str | None = None


class Metrics:
    """The last spans, and sums of all of them; `listener` gets each span as it ends."""

    def __init__(self, listener: Callable[[Span], None] | None = None, kept: int = 1000):
        self.listener, self.spans = listener, deque(maxlen=kept)
        self.counts: Counter = Counter()
        self.seconds: Counter = Counter()

    def count(self, name: str, n: int = 1) -> None:
        self.counts[name] += n

    @contextmanager
    def span(self, name: str, detail: str = "") -> Iterator[None]:
        began, error = time.perf_counter(), None
        try:
            yield
        except BaseException as e:
            error = type(e).__name__
            raise
        finally:
            span = Span(name, detail, time.perf_counter() - began, error)
            self.spans.append(span)
            self.counts[name] += 1
            self.counts[f"{name} errors"] += error is not None
            self.seconds[name] += span.seconds
            if self.listener:
                self.listener(span)
