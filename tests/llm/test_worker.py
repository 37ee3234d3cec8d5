"""Tasks over batches: the wrapper passes rows, errors and early ends on, and hands memory back."""

import pyarrow as pa
import pytest

from fieldspark.llm import worker

BATCHES = [pa.record_batch({"x": [i]}) for i in range(3)]


def test_tidy_passes_batches_and_releases_once(monkeypatch):
    calls = []
    monkeypatch.setattr(worker, "release", lambda: calls.append(1))

    @worker.tidy
    def same(batches):
        yield from batches

    @worker.tidy
    def fails(batches):
        yield next(batches)
        raise ValueError("bad row")

    assert [b.to_pydict() for b in same(iter(BATCHES))] == [b.to_pydict() for b in BATCHES] and len(calls) == 1
    assert list(same(iter([]))) == [] and len(calls) == 2
    with pytest.raises(ValueError, match="bad row"):
        list(fails(iter(BATCHES)))
    assert len(calls) == 3
    early = same(iter(BATCHES))
    next(early)
    early.close()
    assert len(calls) == 4


def test_release_can_be_called_at_any_time():
    held = pa.array(range(100_000))
    worker.release()
    assert held[99_999].as_py() == 99_999
