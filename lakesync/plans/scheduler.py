"""Order of jobs, retries with growing delays, and parallel runs by dependency."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import Any

from .config import Config, Job, Retry


def ordered(config: Config, job: str | None = None, group: str | None = None) -> list[Job]:
    """Jobs after those they depend on, else as written; filters do not pull in dependencies."""
    done: dict[str, Job] = {}

    def visit(one: Job) -> None:
        if one.name not in done:
            if one.depends_on:
                visit(config.job(one.depends_on))
            done[one.name] = one

    for one in config.sync_jobs:
        visit(one)
    return [j for j in done.values() if (job is None or j.name == job) and (group is None or j.group == group)]


def with_retry(retry: Retry, run: Callable[[], Any], sleep: Callable[[float], None] = time.sleep) -> Any:
    """run(), again after each failure as often as retry allows; the last failure is raised."""
    delay = retry.initial_delay_ms / 1000
    for attempt in range(1, retry.max_attempts + 1):
        try:
            return run()
        except Exception:  # noqa: BLE001  any failure of a run may pass
            if attempt == retry.max_attempts:
                raise
            sleep(delay)
            delay *= retry.backoff_multiplier
    raise AssertionError("max_attempts is 1 or more")


class Skipped(RuntimeError):
    """A job that did not run, as one that it depends on failed."""


def run_jobs(jobs: list[Job], run: Callable[[Job], Any], parallel: int = 1) -> dict[str, Any]:
    """Each job's result or exception, by name in the order given; a job starts when those it depends on are done."""
    results: dict[str, Any] = {}
    waiting, names, running = list(jobs), {j.name for j in jobs}, {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        while waiting or running:
            for job in list(waiting):
                parent = job.depends_on if job.depends_on in names else None
                if parent in results and isinstance(results[parent], Exception):
                    results[job.name] = Skipped(f"'{parent}' failed")
                    waiting.remove(job)
                elif (parent is None or parent in results) and len(running) < max(1, parallel):
                    future: Future = pool.submit(run, job)
                    running[future] = job.name
                    waiting.remove(job)
            for future in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                error = future.exception()
                results[running.pop(future)] = error if error is not None else future.result()
    return {j.name: results[j.name] for j in jobs}
