"""Policies, their categories, threats and the last ids given out, kept together in one numbered state.

Each table lies in buckets by a hash of its key, and a state names the folders of every bucket. A change writes
the buckets it touches to fresh folders and publishes them with the new marks in one step: readers see all of it or nothing, and of two
changes at once the later one is worked out anew on the state the other left, so that no id is given out twice. Marks only grow:
the ids of a deleted policy do not come back.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.fixed_values import NEW_POLICY
from burstline.operators.joins import attach
from burstline.operators.policies import (
    ID_KINDS, SETTINGS, category_rows, last_ids, listed_categories, merge_policies, replace_categories,
)
from burstline.session import pin
from burstline.sinks.versions import State, Versions

BUCKETS = 16
# A bucket in more folders than this is written anew as one.
FOLDERS = 8
KEY_OF = {"policies": "id", "categories": "policyid", "threats": "id"}
BUCKET = "_bucket"
SPARK_TYPE = {str: "string", int: "int", bool: "boolean", float: "double"}
# The columns a new policy sets, with their types.
SETTING_TYPES = (
    dict.fromkeys(SETTINGS, "string") | dict.fromkeys(["id", "riskthreatid", "risktypeid"], "long") | {"categoryid": "int"}
    | dict.fromkeys(["level1_meta", "level2_meta"], "array<string>")
    | {name: SPARK_TYPE[type(value)] for name, value in NEW_POLICY.items()}
)

Tables = dict[str, dict[str, list[str]]]


class PolicyStore:
    """The tables below ``path``; ``create`` gives the store its first state."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.versions, self.buckets = spark, Versions(spark, path), buckets

    def create(self, policies: DataFrame, threats: DataFrame, marks: dict[str, int] | None = None) -> State:
        """The first state; ``Taken`` if there is one. ``marks`` are ids known to have been given out, of policies that may be gone.

        Settings that a new policy has and the table lacks become columns of it, unset.
        """
        policies = policies.withColumns({name: F.lit(None).cast(kind) for name, kind in SETTING_TYPES.items() if name not in policies.columns})
        rows = {"policies": policies, "categories": category_rows(policies), "threats": threats}
        largest = last_ids(policies, ID_KINDS[:3]) | {"riskthreatid": last_ids(threats, ["id"])["id"]}
        content = {
            "schemas": {name: df.schema.json() for name, df in rows.items()},
            "tables": {name: self._written(name, df) for name, df in rows.items()},
            "marks": {kind: max(n, (marks or {}).get(kind, 0)) for kind, n in largest.items()},
        }
        return self.versions.publish(State(), content)

    def read(self, name: str, state: State | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A table, of the current state or a given one; whole, or some buckets of it."""
        content = (state or self.versions.current()).content
        folders = [f for bucket, held in content["tables"][name].items() if buckets is None or int(bucket) in buckets for f in held]
        return self.versions.rows(folders, self._schema(name, content))

    def marks(self) -> dict[str, int]:
        """The last id of each kind that was ever given out."""
        return self.versions.current().content["marks"]

    def merge(self, requests: DataFrame, categories: DataFrame) -> DataFrame:
        """Add a policy for each accepted request whose name is new, its category and its threat if that is new; the added policies."""
        made: list[DataFrame] = []

        def work(now: State) -> dict:
            policies, threats, marks = self.read("policies", now), self.read("threats", now), now.content["marks"]
            merged = merge_policies(requests, policies, categories, threats, marks=marks).where("is_new").drop("is_new")
            new = pin(merged.select(*[F.col(f"`{f.name}`").cast(f.dataType) if f.name in merged.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                      for f in self._schema("policies", now.content)]))
            made[:] = [new]
            named = new.where("threatname is not null").select(F.col("riskthreatid").alias("id"), F.col("threatname").alias("name")).distinct()
            new_threats = attach(named, threats.select("name"), ["name"], "left_anti", ["id"])
            largest = last_ids(new, ID_KINDS)
            return now.content | {
                "tables": self._added(self._added(self._added(
                    now.content["tables"], now, "policies", new), now, "categories", category_rows(new)), now, "threats", new_threats),
                "marks": {kind: max(marks[kind], largest[kind]) for kind in ID_KINDS},
            }

        self.versions.change(work)
        return made[0]

    def replace_categories(self, lists: DataFrame, categories: DataFrame) -> State:
        """Every policy with a list (``policyid``, ``categoryids``) has the categories of the list and no others, an empty list none."""
        rows, replaced = listed_categories(lists)
        rows, replaced = pin(rows), pin(replaced)
        touched = self._buckets(replaced, "policyid")

        def work(now: State) -> dict:
            old = self.read("categories", now, touched)
            new = replace_categories(old, rows, categories, self.read("policies", now), replaced).select(*old.columns)
            return self._rewritten(now, "categories", touched, new)

        return self.versions.change(work)

    def delete(self, ids: DataFrame) -> State:
        """Policies (``id``) go, with their categories. Marks stay."""
        gone = pin(ids.select(F.col("id").cast("long").alias("id")).dropna().distinct())
        touched = self._buckets(gone, "id")

        def work(now: State) -> dict:
            content = now.content
            for name in ("policies", "categories"):
                key, old = KEY_OF[name], self.read(name, now, touched)
                left = attach(old, gone.select(F.col("id").alias(key)), [key], "left_anti", old.columns[:1])
                content = self._rewritten(State(now.number, content), name, touched, left)
            return content

        return self.versions.change(work)

    def _schema(self, name: str, content: dict) -> T.StructType:
        return T.StructType.fromJson(json.loads(content["schemas"][name]))

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(self.buckets)).cast("int")

    def _buckets(self, keys: DataFrame, key: str) -> list[int]:
        return [row[BUCKET] for row in keys.select(self._bucket(key).alias(BUCKET)).distinct().collect()]

    def _written(self, name: str, rows: DataFrame) -> dict[str, list[str]]:
        """The rows in a fresh folder, by bucket; the folders of the buckets that have any."""
        folder = self.versions.fresh(name)
        rows.withColumn(BUCKET, self._bucket(KEY_OF[name])).repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        found = self.spark.read.schema(f"{BUCKET} int").parquet(folder).select(BUCKET).distinct().collect()
        return {str(row[BUCKET]): [f"{folder}/{BUCKET}={row[BUCKET]}"] for row in found}

    def _added(self, tables: Tables, now: State, name: str, rows: DataFrame) -> Tables:
        """The tables with rows added to one; a bucket that has become many folders is written as one."""
        added, held = self._written(name, rows), dict(tables[name])
        for bucket, folders in added.items():
            held[bucket] = [*held.get(bucket, []), *folders]
        many = [b for b, folders in held.items() if len(folders) > FOLDERS]
        if many:
            schema = self._schema(name, now.content)
            held |= self._written(name, self.versions.rows([f for b in many for f in held[b]], schema))
        return tables | {name: held}

    def _rewritten(self, now: State, name: str, touched: list[int], rows: DataFrame) -> dict:
        """The content with some buckets of a table replaced by the rows; one without rows goes."""
        held = {b: folders for b, folders in now.content["tables"][name].items() if int(b) not in touched}
        return now.content | {"tables": now.content["tables"] | {name: held | self._written(name, rows)}}
