"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Key = TypeVar("Key", bound=Hashable)
Result = TypeVar("Result")

RUNTIME_CONF = {
    # Every instant in the model is UTC; date keys and weeks depend on it.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, size-checked broadcast, skew splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the operator after the join needs one more shuffle for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Bloom filters from the small (increment) side prune the scan of the large side.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Shuffle files go when their query has ended, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM does not compile methods beyond this size: wide projections ran interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Shared folder by application, where the caller names it after the start.
_SCRATCH: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the model relies on in an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "devtide", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        # No Python call site per column: plans are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_scratch(spark: SparkSession, folder: str) -> None:
    """Name the shared folder for a session that was started without one."""
    _SCRATCH[spark.sparkContext.applicationId] = folder.rstrip("/")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that all executors share, if one is named."""
    return spark.conf.get("spark.checkpoint.dir", None) or _SCRATCH.get(
        spark.sparkContext.applicationId
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder; there is no other place to fall back on."""
    base = shared_folder(spark)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def together(
    spark: SparkSession, jobs: Mapping[Key, Callable[[], Result]]
) -> dict[Key, Result]:
    """Submit independent Spark jobs at once, so that one fills the other's idle slots."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {key: pool.submit(inherit(job)) for key, job in jobs.items()}
        return {key: future.result() for key, future in running.items()}
