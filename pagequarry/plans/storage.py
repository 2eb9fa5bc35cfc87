"""Tables in the cluster's shared folder.

Intermediate results that several jobs read are written here rather than kept in executor memory, so a
lost executor costs nothing and the plan behind them is cut.
"""

import tempfile
import uuid
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="pagequarry-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/pagequarry/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once, with real size statistics."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
