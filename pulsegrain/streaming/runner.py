"""The dataflow over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrain.operators import counters as C
from pulsegrain.operators.metrics import observe
from pulsegrain.plans.pipeline import emit, flatten
from pulsegrain.specs import App
from pulsegrain.streaming.counters import normalize_stream


def run_stream(messages: DataFrame, app: App, initial: DataFrame | None = None, observed: str | None = None) -> DataFrame:
    """Streaming messages to (topic, key, value, …) in order of arrival per partition.

    No watermark is set: late rows are never dropped, only their differences are empty. State is held per tag and
    entity across all partitions of the source; a checkpoint location makes a restart go on where it stopped, also with
    counters added, removed or in another order. Limit the size of micro-batches at the source (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``). ``initial`` holds readings that a new stream starts with (``streaming.state``).
    ``observed`` names counts of each micro-batch: messages by step under that name, rows by outcome under the name with ``-rows``
    (``streaming.progress`` keeps them).
    """
    rows = C.read_counters(flatten(messages, app, observed), app)
    output = emit(C.write_counters(normalize_stream(rows, app, initial), app), app)
    return output if observed is None else observe(output, app, f"{observed}-rows")
