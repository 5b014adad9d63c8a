"""Shared helpers: bounded text slices inside tasks, tables written to the
shared folder, and a join that spreads hot keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir

ARROW_ROWS = 1024
SLICE_BYTES = 1 << 20
HOT_SHARE = 1 / 500
_SHIPPED: set[str] = set()


def prepare_python(spark: SparkSession) -> None:
    """Before an operator runs Python in tasks: workers get this package (once a
    context), and an Arrow batch has at most ``ARROW_ROWS`` rows, as a row here is
    a whole document and the default of 10,000 could be a gigabyte."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tessera-py-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))  # the driver's file server hands it to executors


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``limit`` bytes of ``column``
    (one row at least; a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = (np.cumsum(sizes.to_numpy(zero_copy_only=False)) // limit)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage is
    cut, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_spread(left: DataFrame, right: DataFrame, key: str, how: str = "left",
                  share: float = HOT_SHARE) -> DataFrame:
    """``left`` joined with ``right`` (one row per ``key``) by equal ``key``.

    Keys holding more than ``share`` of the left rows are counted first; there
    are fewer than ``1 / share`` of them, so their right rows are broadcast and
    their left rows stay where they are. All others meet in a sort-merge join,
    where no key is hot. ``left`` is read twice: pass a stored table.
    ``how`` is left or inner; null keys match nothing.
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    total = left.count()
    hot = [r[0] for r in counts.where(F.col("count") > max(1000, int(total * share)))
           .select(key).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (left.where(~is_hot).join(right.where(~is_hot), key, how)
            .unionByName(left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how)))


def columns_of(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Only ``wanted`` columns: whatever else a table carries cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])


__all__ = ["ARROW_ROWS", "columns_of", "cut_lineage", "lookup_spread", "prepare_python",
           "stored", "text_slices", "work_path"]
