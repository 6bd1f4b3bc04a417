"""Tables between two steps of a job, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from pulsegrain.session import checkpoint_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that what several steps read is computed once and survives lost executors.

    The files stay in the shared folder for whoever cleans it; readers take only the columns they need.
    """
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
