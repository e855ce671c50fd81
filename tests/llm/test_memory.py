"""Workers that Spark keeps give back, at a task's end, the memory that the task has freed."""

from __future__ import annotations

import re

import numpy as np
import pytest

from tidemark.llm import common


def held() -> float:
    """MB of this process without mapped files."""
    with open("/proc/self/smaps_rollup") as found:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", found.read())[1]) / 1024


def test_freed_memory_goes_back():
    blocks = [np.ones(8_000) for _ in range(3_200)]  # 64 KB each, below what is mapped apart
    full = held()
    last = blocks[-1]  # keeps the end of the heap in use
    blocks.clear()
    common.hand_back()
    assert len(last) and held() < full - 100


@pytest.mark.parametrize("fails", [False, True])
def test_a_task_hands_back_at_its_end(monkeypatch, fails):
    calls = []
    monkeypatch.setattr(common, "hand_back", lambda: calls.append("handed back"))

    def run(batches):
        for batch in batches:
            assert not calls
            yield batch + 1
        if fails:
            raise ValueError("task")

    task = common._handing_back(run)(iter([1, 2]))
    assert [next(task), next(task)] == [2, 3]
    with pytest.raises(ValueError) if fails else pytest.raises(StopIteration):
        next(task)
    assert calls == ["handed back"]
