"""Numbered states of a set of files, each published by one file that must not exist yet.

Spark writes rows to a fresh folder first. A state is a small JSON document that names the folders it is made of; it becomes visible
when its numbered file appears, which only one writer of that number can bring about. Readers go by the highest
number, so they see all of a state or nothing of it, and a folder of a write that broke off is never named. Whoever loses the race for a
number reads the new state and decides anew.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STATES, MARKS = "states", "marks"


class Taken(Exception):
    """Another writer has published the number."""


@dataclass(frozen=True)
class State:
    """``number`` 0 and nothing in it before the first is published."""

    number: int = 0
    content: dict = field(default_factory=dict)


class Versions:
    """States below one folder that all executors and writers reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{STATES}")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._folder)
        # A folder of this machine: its own call is the one that fails if the name is taken.
        made = self._files.getFileStatus(self._folder).getPath().toUri()
        self._local = made.getPath() if made.getScheme() == "file" else None

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def _numbers(self) -> list[int]:
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def current(self) -> State:
        numbers = self._numbers()
        return self.state(numbers[-1]) if numbers else State()

    def state(self, number: int) -> State:
        name = f"{number:012d}"
        if self._local:
            with open(f"{self._local}/{name}") as text:
                return State(number, json.load(text))
        stream = self._files.open(self._at(name))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return State(number, json.loads(text))

    def publish(self, after: State, content: dict) -> State:
        """The next state, or ``Taken`` if there is one after ``after`` already."""
        number = after.number + 1
        draft, name = f".draft-{uuid.uuid4().hex}", f"{number:012d}"
        text = json.dumps(content)
        if self._local:
            with open(f"{self._local}/{draft}", "w") as out:
                out.write(text)
            try:
                os.link(f"{self._local}/{draft}", f"{self._local}/{name}")
            except FileExistsError:
                raise Taken(name) from None
            finally:
                os.unlink(f"{self._local}/{draft}")
            return State(number, content)
        stream = self._files.create(self._at(draft), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        # A rename onto a name that exists is refused.
        if self._files.exists(self._at(name)) or not self._files.rename(self._at(draft), self._at(name)):
            self._files.delete(self._at(draft), False)
            raise Taken(name)
        return State(number, content)

    def change(self, work: Callable[[State], dict], attempts: int = 20) -> State:
        """Publish ``work`` of the current state; done again on the new state where another writer was faster."""
        for _ in range(attempts):
            now = self.current()
            try:
                return self.publish(now, work(now))
            except Taken:
                continue
        raise Taken(f"{attempts} attempts")

    def _mark(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{MARKS}/{name}")

    def mark(self, name: str) -> None:
        """Leave a mark of a name; it may be there."""
        self._files.create(self._mark(name), True).close()

    def marked(self, name: str) -> bool:
        return self._files.exists(self._mark(name))

    def fresh(self, name: str) -> str:
        """A folder that no state names yet."""
        return f"{self.path}/{name}-{uuid.uuid4().hex}"

    def rows(self, folders: list[str], schema: T.StructType | str) -> DataFrame:
        """The rows in the folders a state names; none without folders."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
