"""One rate of calls for a whole job.

Rows are dealt to a fixed number of lanes (partitions), and each lane makes its share of the calls in a second, in slots that start at
fixed distances. A stage has at most one running task per lane, so the rate is bounded by what was asked for, on a laptop and on a
thousand executors. A lane that starts late or is run again keeps its own distance. Speculative execution would run a lane twice: leave it off.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Calls in flight at once; as long as a call takes less than LANES / per_second seconds, the asked rate is reached.
LANES = 8


def dealt(rows: DataFrame, per_second: float | None, lanes: int = LANES, *columns: str) -> DataFrame:
    """`rows` in their lanes where a rate is asked for; a given number of partitions is not coalesced at run time."""
    return rows.repartition(lanes, *columns) if per_second else rows


def slots(per_second: float | None, lanes: int = LANES, clock=time.monotonic, sleep=time.sleep) -> Callable[[], None]:
    """A function that waits for the next slot of this task's lane; the first slots of the lanes follow one another."""
    if not per_second:
        return lambda: None
    gap = lanes / per_second
    context = TaskContext.get()
    at = clock() + gap * ((context.partitionId() if context else 0) % lanes) / lanes

    def wait():
        nonlocal at
        now = clock()
        if at > now:
            sleep(at - now)
        at = max(at, now) + gap

    return wait
