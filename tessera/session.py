"""Session helpers: a local session for tests / bench, and the checkpoint folder.

The library never invents storage on a cluster: lineage cuts go to the shared
folder the cluster names in ``spark.checkpoint.dir``. Only a local session with
no such setting (tests, bench) gets a fresh scratch folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "tessera",
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and ``bench.py`` (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, wiring ``spark.checkpoint.dir`` into the context.

    On a cluster the setting must exist (a shared folder); only a local session
    without it gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def has_shuffle(df: DataFrame) -> bool:
    """Whether producing ``df`` needs a shuffle (join, aggregate, window, repartition)."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except Exception:  # noqa: BLE001 - no JVM plan to read (e.g. a Connect session)
        return True    # assume the expensive case: materialise
    return any(k in plan for k in ("Join ", "Aggregate [", "Window [", "Repartition"))


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder when an operator will read it
    several times and it comes out of a shuffle; a plain scan is returned as is
    (re-reading the columns is cheaper than writing them)."""
    return cut_lineage(df) if has_shuffle(df) else df

