"""Timed repetitions of a query, their statistics and the gate."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field


class FakeClock:
    """Nanoseconds that advance by a step at each reading."""

    def __init__(self, step: int = 0, now: int = 0):
        self.step, self.now = step, now

    def __call__(self) -> int:
        self.now += self.step
        return self.now - self.step


def micros(ns: float) -> float:
    return round(ns / 1000.0, 3)


@dataclass(frozen=True)
class Statistics:
    min_us: float
    median_us: float
    p95_us: float
    max_us: float


def statistics(samples: list[int]) -> Statistics:
    """Least, median, nearest-rank 95th percentile and most of nanosecond samples, in microseconds."""
    if not samples:
        raise ValueError("no samples")
    s = sorted(samples)
    n = len(s)
    median = s[n // 2] if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2
    return Statistics(micros(s[0]), micros(median), micros(s[math.ceil(0.95 * n) - 1]), micros(s[-1]))


@dataclass(frozen=True)
class Report:
    family: str
    name: str
    warmup: int
    iterations: int
    rows: int
    statistics: Statistics
    max_p95_us: float | None = None
    extra: dict = field(default_factory=dict)

    @property
    def passed(self) -> bool:
        """The gate is strict: a 95th percentile equal to the limit fails."""
        return self.max_p95_us is None or self.statistics.p95_us < self.max_p95_us

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 7

    def to_json(self) -> str:
        return json.dumps(asdict(self) | {"passed": self.passed}, ensure_ascii=False) + "\n"

    def to_text(self) -> str:
        s = self.statistics
        return f"{self.family} {self.name}: {self.rows} rows, {self.iterations} runs; min {s.min_us} us, median {s.median_us} us, p95 {s.p95_us} us, max {s.max_us} us: {'pass' if self.passed else 'FAIL'}\n"


def run(family: str, name: str, query: Callable[[], list], warmup: int = 1_000, iterations: int = 10_000, max_p95_us: float | None = None, clock: Callable[[], int] = time.perf_counter_ns) -> Report:
    """Repeats a query that returns its rows; only the query is timed."""
    if not 0 <= warmup <= 1_000_000 or not 1 <= iterations <= 10_000_000:
        raise ValueError("warmup is 0 to 1,000,000, iterations 1 to 10,000,000")
    for _ in range(warmup):
        query()
    samples, rows = [], 0
    for _ in range(iterations):
        began = clock()
        got = query()
        samples.append(clock() - began)
        rows = len(got)
    return Report(family, name, warmup, iterations, rows, statistics(samples), max_p95_us)
