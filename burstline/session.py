"""Where intermediate results go, and how one is pinned."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

REMOVED_AT_END: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder for such results of this application: below the one the session names, else beside its tables. All executors reach both.

    With a local master and no named folder, it is removed when the process ends. Elsewhere results may outlive the application that made
    them: clear its folder when they are not read any more.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    of_this = f"burstline-{spark.sparkContext.applicationId}"
    if named:
        return f"{named.rstrip('/')}/{of_this}"
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_pinned/{of_this}"
    if spark.sparkContext.master.split("[")[0] == "local" and folder not in REMOVED_AT_END:
        REMOVED_AT_END.add(folder)
        atexit.register(shutil.rmtree, unquote(urlparse(folder).path), ignore_errors=True)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    Used where a result feeds several branches of a plan: every branch then sees the same rows, nothing
    upstream runs twice, a lost executor costs only a re-read, and the planner knows the size from the files,
    so it broadcasts a small result by itself.
    """
    path = f"{shared_folder(df.sparkSession)}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
