"""Submit independent Spark jobs concurrently (the two arms of an experiment, k folds).

Each thunk builds and runs its own jobs; the scheduler interleaves their tasks,
so small jobs stop leaving executor slots idle.  Results come back in order.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor


def run_concurrently(*thunks, max_workers: int | None = None):
    if len(thunks) == 1:
        return [thunks[0]()]
    with ThreadPoolExecutor(max_workers=max_workers or len(thunks)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]
