"""Fitted transforms on streaming DataFrames.

Every fitted operator's ``transform`` is a stateless projection or a
stream-static join with a category map, so a fit learned on a batch table
applies unchanged to ``spark.readStream`` input; a fitted ``pyspark.ml``
model's ``transform`` is a projection too. This module wires the two and
starts the query with a checkpoint under the shared folder so a restarted
driver resumes where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q
from ..session import ensure_checkpoint_dir


def transform_stream(fitted, stream: DataFrame) -> DataFrame:
    """Apply a fitted operator or chain to a streaming DataFrame."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return fitted.transform(stream)


def predict_stream(fitted, model, stream: DataFrame, key: str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Preprocess with a fitted chain, then score with a fitted ML pipeline."""
    out = model.transform(transform_stream(fitted, stream))
    return out.select(F.col(q(key)), *[F.col(q(c)) for c in keep], "prediction")


def start(df: DataFrame, name: str, sink: str = "parquet", path: str | None = None,
          trigger_once: bool = True, mode: str = "append"):
    """Start a streaming query; its checkpoint lives in the shared folder."""
    base = ensure_checkpoint_dir(df.sparkSession)
    if base.startswith("file:"):
        base = base[len("file:"):]
    w = (df.writeStream.outputMode(mode)
         .option("checkpointLocation", os.path.join(base, "streams", name)))
    if sink == "memory":
        w = w.format("memory").queryName(name)
    else:
        w = w.format(sink).option("path", path)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
