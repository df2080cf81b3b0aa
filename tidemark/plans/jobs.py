"""Submitting independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor


def together(steps: Sequence[Callable], at_once: int | None = None) -> list:
    """Run steps that each start Spark jobs, and return their results in order.

    The threads only submit and wait. Spark shares its executors between the jobs.
    """
    if not steps:
        return []
    with ThreadPoolExecutor(max_workers=at_once or len(steps)) as pool:
        started = [pool.submit(step) for step in steps]
        return [job.result() for job in started]
