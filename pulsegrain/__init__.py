"""JSON telemetry pipelines as Spark DataFrames: parse, gate, route, reshape, count, emit."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from pulsegrain.plans.pipeline import run, to_sink
from pulsegrain.session import configure, local_session
from pulsegrain.specs import App, CounterSet, CounterSpec, KeyPart, NormalizeConfig, Pipeline, TimeRule

# The few functions that run in Python tasks travel with the query, so executors need not have the package installed.
register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "App", "CounterSet", "CounterSpec", "KeyPart", "NormalizeConfig", "Pipeline", "TimeRule",
    "configure", "local_session", "run", "to_sink",
]
