"""Python code for the tasks: the package goes to the executors once per application."""

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source files to the executors, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)

    def run_and_release(batches):
        yield from run(batches)
        # a worker waits for its next task; what this one's batches took goes back to the machine
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run_and_release, schema)
