"""Tables written between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders made on this machine, by application, where the setting is missing.
_made: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where unset, one is made for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _made:
            _made[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
        folder = _made[context.applicationId]
    return folder.rstrip("/")


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: a lost executor costs nothing.

    The files stay until the folder's owner clears it; they belong to this application.
    """
    spark = frame.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/llm-{app}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
