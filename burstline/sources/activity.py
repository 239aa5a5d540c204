"""Event tables: one table with a group column, or one table per resource group."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.operators.joins import attach
from burstline.schema import GROUP
from burstline.session import pin

# Longest list of groups put into a filter.
IN_LIST = 1000


def scan_activity(events: DataFrame, group: int = 1) -> DataFrame:
    """Events of one resource group; prunes partitions where the table is partitioned by it."""
    return events.where(F.col(GROUP) == group)


def scan_activity_multi(events: DataFrame, groups: DataFrame) -> DataFrame:
    """Events of all given groups (column ``rg_id``) in one scan.

    A short list of groups becomes part of the scan's own filter, so that other groups' partitions are not read. A
    long one is a semi-join whose small side has a filter, and partitions are skipped while the query runs.
    """
    wanted = groups.select(GROUP).dropna().distinct()
    some = wanted.limit(IN_LIST + 1).collect()
    if len(some) <= IN_LIST:
        return events.where(F.col(GROUP).isin([row[GROUP] for row in some]))
    listed = pin(wanted.withColumn("_listed", F.lit(1)))
    return events.join(listed.where("_listed = 1").select(GROUP), GROUP, "left_semi").select(*events.columns)


def skipped_groups(events: DataFrame, groups: DataFrame) -> DataFrame:
    """Requested groups that have no events to read. Only the requested groups are looked for."""
    return groups_without_events(scan_activity_multi(events, groups), groups)


def groups_without_events(scanned: DataFrame, groups: DataFrame) -> DataFrame:
    """The same, of events that were scanned for these groups."""
    present = scanned.select(GROUP).distinct()
    return attach(groups.select(GROUP).distinct(), present, [GROUP], "left_anti", [GROUP])


def table_of_group(group: int) -> str:
    return f"activity{group}incoming"


def union_all(tables: list[DataFrame]) -> DataFrame:
    """One union of many tables. It is built from halves: each table is analysed a few times only."""
    if len(tables) == 1:
        return tables[0]
    half = len(tables) // 2
    return union_all(tables[:half]).unionByName(union_all(tables[half:]), allowMissingColumns=True)


def scan_group_tables(
    spark: SparkSession, groups: Iterable[int], table: Callable[[int], str] = table_of_group
) -> tuple[DataFrame | None, DataFrame]:
    """Union of the per-group tables that exist, and the groups left out (column ``rg_id``).

    The tables stay apart in the plan, so a filter on ``rg_id`` drops the others' scans. Only a table that is not there is
    skipped: any other error is raised.
    """
    found, skipped = [], []
    for group in groups:
        try:
            found.append(spark.table(table(group)).withColumn(GROUP, F.lit(group).cast("long")))
        except AnalysisException as error:
            if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                raise
            skipped.append((group,))
    return union_all(found) if found else None, spark.createDataFrame(skipped, f"{GROUP} long")


def _folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Names and paths of the folders in ``root``, from one listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getPath().toString() for s in files.listStatus(path) if s.isDirectory()}


def group_of_file(folder: Callable[[int], str] = table_of_group) -> Column:
    """The group of a row, from the name of the folder of its file."""
    before, after = (re.escape(part) for part in folder("\0").split("\0"))
    name = F.regexp_extract("_metadata.file_path", f"/{before}(-?[0-9]+){after}/[^/]*$", 1)
    return name.try_cast("long")


def scan_group_folders(
    spark: SparkSession, root: str, groups: Iterable[int], schema: T.StructType | str, folder: Callable[[int], str] = table_of_group
) -> tuple[DataFrame | None, DataFrame]:
    """One scan of the Parquet folders of all given groups below ``root``, and the groups left out (column ``rg_id``) as they have none.

    The plan has a single scan node however many groups there are. The group comes from each file's path, so a filter on ``rg_id`` drops
    files before they are opened. Columns that a group's files lack are null; those not in ``schema`` are not read.
    """
    there, wanted = _folders(spark, root), list(dict.fromkeys(groups))
    paths = [there[folder(group)] for group in wanted if folder(group) in there]
    skipped = spark.createDataFrame([(group,) for group in wanted if folder(group) not in there], f"{GROUP} long")
    if not paths:
        return None, skipped
    return spark.read.schema(schema).parquet(*paths).withColumn(GROUP, group_of_file(folder)), skipped
