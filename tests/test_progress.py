"""Progress of streams as a table."""

from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from pulsegrain.streaming import progress


def _event(batch, at, rows, observed=None, states=()):
    return SimpleNamespace(progress=SimpleNamespace(
        id="q", batchId=batch, timestamp=at, numInputRows=rows, durationMs={"addBatch": 7}, stateOperators=list(states),
        observedMetrics=observed or {}))


def _query(run):
    return SimpleNamespace(runId=run)


def test_last_report_of_a_batch_counts(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    state = SimpleNamespace(operatorName="counters", numRowsTotal=3, numRowsUpdated=2, numRowsRemoved=1, memoryUsedBytes=99)
    log.onQueryProgress(_event(0, "2026-01-01T00:00:00.000Z", 5, {"steps": Row(read=5, parse=1, mean=0.5)}))
    log.onQueryProgress(_event(1, "2026-01-01T00:00:01.000Z", 0))
    log.onQueryProgress(_event(1, "2026-01-01T00:00:02.000Z", 6, {"steps": Row(read=6, parse=0, mean=None)}, [state]))
    log.onQueryProgress(_event(1, "2026-01-01T00:00:03.000Z", 6, {"steps": Row(read=6, parse=0, mean=None)}, [state]))
    log.onQueryTerminated(_query("r"))
    log.wait(_query("r"), seconds=1)
    read = progress.read(spark, str(tmp_path / "log"))
    sums = {(row.part, row.name): row.n for row in progress.totals(read).collect()}
    assert sums == {("source", "rows"): 11, ("duration-ms", "addBatch"): 14, ("steps", "read"): 11, ("steps", "parse"): 1}
    held = {(row.batch, row.name): row.value for row in read.where("part = 'state:counters'").collect()}
    assert held == {(1, "rows"): 3, (1, "updated"): 2, (1, "removed"): 1, (1, "memory-bytes"): 99}


def test_a_write_that_fails_is_raised_by_wait(spark, tmp_path):
    (tmp_path / "log").write_text("a file where the folder should be")
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    log.onQueryProgress(_event(0, "2026-01-01T00:00:00.000Z", 5))
    log.onQueryTerminated(_query("r"))
    with pytest.raises(Exception, match="log"):
        log.wait(_query("r"), seconds=1)


def test_an_end_that_never_comes(spark, tmp_path):
    with pytest.raises(TimeoutError):
        progress.ProgressLog(spark, str(tmp_path / "log")).wait(_query("r"), seconds=0.1)
