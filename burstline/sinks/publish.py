"""Writing violations out, as messages or as files, and page by page with a record of what was sent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.operators.joins import attach
from burstline.session import pin
from burstline.sinks.versions import State, Versions

# Parts that the pages of a run are sent in: what is lost when a run breaks off is one part at most.
PARTS = 16
# A log in more files than this is written anew as one.
LOG_FOLDERS = 64
LOG = "page_id string, digest string, events long, place string"


def messages(violations: DataFrame, key: str = "violation_id") -> DataFrame:
    """One message per violating event: ``key`` and the whole row as JSON in ``value``."""
    return violations.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish_to_topic(violations: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Send the messages to a topic; needs the Kafka connector on the class path."""
    messages(violations).write.format("kafka").options(topic=topic, **options).save()


def publish_to_files(violations: DataFrame, path: str, file_format: str = "json",
                     mode: str = "errorifexists", by: tuple[str, ...] = ()) -> None:
    """Write the violations under ``path``, in folders by the columns ``by`` if any are given."""
    violations.write.mode(mode).partitionBy(*by).format(file_format).save(path)


def page_messages(rows: DataFrame, keys: list[str], key: str = "violation_id") -> DataFrame:
    """Messages with the page they belong to: ``page_id`` (of the group's keys and the page), ``key`` and ``value``.

    ``rows`` have a column ``page`` (``paging.page_number``), which is not part of the message.
    """
    page_id = F.sha2(F.to_json(F.struct(*keys, "page"), {"ignoreNullFields": "false"}), 256)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "page"]))
    return rows.select(page_id.alias("page_id"), *keys, "page", F.col(key).cast("string").alias("key"), whole.alias("value"))


def pages_of(sent: DataFrame, keys: list[str]) -> DataFrame:
    """A row per page: its id, keys and number, ``events`` on it, and a digest of its messages whatever their order.

    The digest is of the messages' own digests in order, 64 bytes for each of a page's events.
    """
    each = F.array_sort(F.collect_list(F.sha2("value", 256)))
    return sent.groupBy("page_id", *keys, "page").agg(F.count("*").alias("events"), F.sha2(F.concat_ws(",", each), 256).alias("digest"))


# Sends the messages (``page_id``, ``key``, ``value``) of whole pages and says where they went.
Sender = Callable[[DataFrame], str]


@dataclass(frozen=True)
class Sent:
    """What a run did: pages and events it sent, and pages it found sent before."""

    pages: int
    events: int
    known: int


class PageLog:
    """Pages published below ``path``, and the log of them.

    Pages are sent in parts; after each part the log takes in its pages, by one new state (see ``versions``). A run that broke off
    is repeated: it sends only pages that the log does not have with the same digest. With the sender of files below ``path`` each page
    is there once for who reads through ``messages``, as a part that broke off is in no state; a sender to a topic may send
    one part again. Two runs at once: the log takes the part of one, the other stops with ``Taken``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def published(self, state: State | None = None) -> DataFrame:
        """Pages in the log: id, digest, number of events, and where they are. A page sent anew with other events is there twice."""
        return self.versions.rows((state or self.versions.current()).content.get("log", []), LOG)

    def messages(self) -> DataFrame:
        """The messages that the sender of files wrote, of the pages in the log."""
        places = [r["place"] for r in self.published().select("place").distinct().collect()]  # a folder for each part of a run
        return self.versions.rows(places, "page_id string, key string, value string")

    def to_files(self, part: DataFrame) -> str:
        place = self.versions.fresh("messages")
        part.write.parquet(place)
        return place

    def publish(self, rows: DataFrame, keys: list[str], key: str = "violation_id", send: Sender | None = None, parts: int = PARTS) -> Sent:
        """Send every page of the rows (with column ``page``) that is not in the log yet."""
        send = send or self.to_files
        part_of = F.pmod(F.xxhash64("page_id"), F.lit(parts)).cast("int").alias("part")
        waiting = pin(page_messages(rows, keys, key).select("*", part_of))
        pages = pages_of(waiting, keys).select("page_id", "digest", "events")
        now = self.versions.current()
        todo = pin(attach(pages, self.published(now), ["page_id", "digest"], "left_anti", ["page_id"]).select("*", part_of))
        counts = {r["part"]: (r["pages"], r["events"]) for r in todo.groupBy("part").agg(F.count("*").alias("pages"), F.sum("events").alias("events")).collect()}
        for part in sorted(counts):
            pages_in = todo.where(F.col("part") == part)
            going = attach(waiting.where(F.col("part") == part), pages_in.select("page_id"), ["page_id"], "left_semi", ["key"])
            place = send(going.select("page_id", "key", "value"))
            now = self._logged(now, pages_in.select("page_id", "digest", "events", F.lit(place).alias("place")))
        total = lambda k: sum(c[k] for c in counts.values())
        return Sent(total(0), total(1), pages.count() - total(0))

    def _logged(self, now: State, rows: DataFrame) -> State:
        folders = list(now.content.get("log", []))
        if len(folders) >= LOG_FOLDERS:
            rows, folders = rows.unionByName(self.versions.rows(folders, LOG)), []
        fresh = self.versions.fresh("log")
        rows.write.parquet(fresh)
        return self.versions.publish(now, now.content | {"log": [*folders, fresh]})
