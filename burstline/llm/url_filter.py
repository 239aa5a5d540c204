"""URL rules as intervals over canonical keys, matched by sorted sweeps (DataFrame functions only).

A host is turned around label by label and every label closed by a dot: ``a.example.net`` becomes
``net.example.a.``. Exactly the host of a rule and its subdomains then have keys from ``net.example.``
up to, and without, ``net.example/``, as ``/`` follows ``.`` among the characters. A path prefix is an interval too: from itself up to itself
with a byte behind it that no text holds. Two such intervals are nested or apart, so at each place a stack of rules is active, which changes
only where an interval starts or ends. These places are few and are made from the rules alone.

The first sweep is over hosts: urls and places are sorted together across the cluster, and each url takes the stack of the last place before it, the
hosts with rules that it belongs to (as many as it has labels at most). The second is over these hosts and the paths: each url, once for
every host of its stack, takes the innermost path rule of the last place before it. So a host with very many path rules costs a url no
more than one with few. A sorted piece starts with what the pieces before it left.

The order of the keys also spreads the urls of one frequent host over as many tasks as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.common import table, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def turned(labels: Column) -> Column:
    return F.concat(F.concat_ws(".", F.reverse(labels)), F.lit("."))


def clean_rules(rules: DataFrame) -> DataFrame:
    """Host, path and verdict of each rule once; see ``judge``."""
    return (
        rules.select(
            lower_ascii(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
    )


def host_places(rules: DataFrame) -> DataFrame:
    """The keys at which the stack of hosts with rules changes, each with its stack from there on."""
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.", -1)
    # Every host looks up itself and the hosts above it: as many rows as it has labels.
    above = hosts.select("host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("n")).select(
        "host", F.concat_ws(".", F.slice(labels, -F.col("n"), F.col("n"))).alias("up")
    )
    stacked = above.join(hosts.withColumnRenamed("host", "up"), "up").groupBy("host").agg(
        F.collect_set("up").alias("inside"), F.collect_set(F.when(F.col("up") != F.col("host"), F.col("up"))).alias("after")
    )
    start = turned(labels)
    end = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("start")), F.lit("/"))
    places = stacked.select(start.alias("start"), "inside", "after").withColumn("end", end)
    return places.select(F.col("start").alias("key"), F.col("inside").alias("active")).unionByName(
        places.select(F.col("end").alias("key"), F.col("after").alias("active"))
    )


def path_places(rules: DataFrame) -> DataFrame:
    """For each host of a rule, the paths at which the innermost path rule changes, each with that rule from there on (null: none)."""
    # Every path looks up the shorter ones that it starts with: as many rows as it has characters.
    own = F.struct(F.length("path").alias("n"), "path", "verdict")
    shorter = rules.select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n")).where("n between 0 and length(path) - 1").select(
        "host", F.col("path").alias("of"), F.expr("substring(path, 1, n)").alias("path"))
    outer = shorter.join(rules, ["host", "path"]).groupBy("host", "of").agg(F.max(own).alias("outer"))
    known = rules.select("host", "path", own.alias("own")).join(outer.withColumnRenamed("of", "path"), ["host", "path"], "left")
    start = F.col("path").cast("binary")
    return known.select("host", start.alias("key"), F.array("own").alias("active")).unionByName(
        known.select("host", F.concat(start, F.lit(BEHIND)).alias("key"), F.when(F.col("outer").isNotNull(), F.array("outer")).otherwise(F.array()).alias("active"))
    )


BEHIND = bytearray([0xFF])  # no text holds this byte: behind a prefix, it sorts after every path that starts with it


def swept(rows: DataFrame, places: DataFrame, by: list[str], tie: Column, name: str) -> DataFrame:
    """Rows with ``active`` of the last place at or before them, in the order of ``by``; null before the first."""
    both = rows.withColumn("kind", F.lit(1)).unionByName(places.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = written(
        both.withColumn("tie", tie).repartitionByRange(count, *by, "kind", "tie").withColumn("piece", F.spark_partition_id()), name)
    # One row for each piece that holds a place: what it leaves, carried on to the next such piece.
    last = pieces.where("kind = 0").groupBy("piece").agg(F.max_by("active", F.struct(*by)).alias("left"))
    held = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.select("piece").distinct().join(last, "piece", "left")
        .select("piece", F.last("left", ignorenulls=True).over(held).alias("carried"))
    )
    sweep = Window.partitionBy("piece").orderBy(*by, "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = pieces.withColumn("active", F.last("active", ignorenulls=True).over(sweep)).where("kind = 1")
    return active.join(F.broadcast(carried), "piece", "left").withColumn("active", F.coalesce("active", "carried")).drop("piece", "carried", "kind", "tie")


def judge(urls: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting rule (host and path together) wins; without one ``rule`` is null and the verdict
    ``default``. A url without host fits none. Columns of ``urls`` that bear one of the new names are replaced.
    ``rules``: host, path, verdict. A null host or path counts as empty (an empty host fits no url that
    has one); of several rules with one host and path, the smallest verdict holds.
    """
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in urls.columns if c not in new]
    parts = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), url_host(F.col(f"`{url}`")).alias("host"),
        url_path(F.col(f"`{url}`")).alias("path"),
    )
    known = written(clean_rules(rules), "url-rules")
    parts = written(parts.withColumn("url", F.monotonically_increasing_id()), "numbered-urls")
    # The sweeps get numbers, hosts and paths only. Equal keys are told apart by number, so that one host or url of a third of all rows is spread.
    keyed = parts.select("url", "path", turned(F.split("host", r"\.", -1)).alias("key"))
    hosts = swept(keyed, host_places(known), ["key"], F.xxhash64("url"), "url-hosts")
    asked = hosts.select("url", "path", F.explode("active").alias("host")).withColumn("key", F.col("path").cast("binary"))
    inner = swept(asked, path_places(known), ["host", "key"], F.xxhash64("url"), "url-paths")
    fits = inner.select("url", "path", F.col("host").alias("of"), F.explode("active").alias("r")).where(F.startswith(F.col("path"), F.col("r.path")))
    rule = F.concat("of", "r.path").alias("rule")
    best = fits.groupBy("url").agg(F.max(F.struct((F.length("of") + F.col("r.n")).alias("n"), rule, F.col("r.verdict").alias("verdict"))).alias("best"))
    return parts.join(best, "url", "left").select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")
