"""Independent publishing steps of one mart, run as concurrent Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor


def run_together(steps: Iterable[Callable[[], object]]) -> None:
    """Run steps that write different tables at the same time; the first error is raised at the end.

    The threads only wait: the cluster shares its slots among the jobs, so small dimensions do not
    queue behind a large fact.
    """
    waiting = list(steps)
    with ThreadPoolExecutor(max_workers=max(len(waiting), 1)) as pool:
        for done in [pool.submit(step) for step in waiting]:
            done.result()
