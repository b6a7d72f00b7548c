import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from haplometh.llm.arrow import frugal


def own_mb() -> float:
    """Memory of this process that no file backs."""
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_what_a_task_frees_goes_back_to_the_system():
    kept = []

    def run(batches):
        for batch in batches:
            small = [np.ones(10_000) for _ in range(3000)]  # 240 MB of the heap
            kept.append(small[-1])  # lies above them, so the heap does not shrink by itself
            del small
            yield batch

    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(2)]
    before = own_mb()
    assert list(run(iter(batches[:1]))) == batches[:1]
    assert own_mb() > before + 150  # what a worker holds otherwise while it waits
    rows = frugal(run)(iter(batches))
    assert next(rows) == batches[0] and next(rows) == batches[1]
    assert list(rows) == []
    assert own_mb() < before + 50


def test_memory_goes_back_when_a_task_stops_early():
    ended = []

    def run(batches):
        try:
            yield from batches
        finally:
            ended.append(True)

    rows = frugal(run)(iter([pa.RecordBatch.from_pydict({"x": [1]})] * 3))
    next(rows)
    rows.close()
    assert ended == [True]
