"""Maps the driver's tables to the engine's inputs, in Spark. ``oracle.py`` has the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.fixed_values import CATEGORIES, ENTITIES, FUNCTIONALITIES, THREATS
from burstline.operators.detect import Rule
from burstline.operators.joins import attach

# Events of the test tables are thinner than real ones, so the test rule counts by day.
DAILY_ERRORS = Rule(equal={"message": "error"}, keys=("accountname", "year", "dayofyear"), more_than=2)

SENTENCE = (
    'Account ${accountname!"ACCOUNTNAME"} performed ${transactionstring1!"ACTIVITY"} '
    'from ipaddress ${ipaddress!"UNKNOWN"}'
)
SHORT_SENTENCE = '${message} by ${accountname} [${nosuchfield!"n/a"}]'
TOTALS = (
    'Account ${accountname!"ACCOUNTNAME"} performed a total of ${transactionstring1$COUNT!"Unknown"} '
    'uploads amounting to ${bytesout$SUM!"UNKNOWN"}'
)
ABSENT_GROUP = 7
SCORES = {"Low": 1.0, "Medium": 2.0, "High": 3.0}


# The tables read here; given to the reader, so that no job looks into the files for it.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Table times carry no zone; reading them as UTC is what the expressions below expect.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


def epoch_ms(time: str) -> Column:
    return F.unix_millis(F.col(time).cast("timestamp"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the resource group of their user."""
    events = read(spark, sf_dir, "events")
    users = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", "c_mktsegment"
    )
    joined = attach(events, users, ["user_id"], "inner", ["event_id"])
    nation = F.col("c_nationkey")
    return joined.select(
        nation.cast("long").alias("rg_id"),
        F.col("event_id").cast("string").alias("eventid"),
        epoch_ms("ts").alias("eventtime"),
        F.col("user_id").cast("string").alias("accountname"),
        F.get_json_object("props", "$.k").alias("ipaddress"),
        F.col("event_type").alias("message"),
        F.year("ts").alias("year"),
        F.dayofyear("ts").alias("dayofyear"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        F.floor("value").cast("int").alias("bytesout"),
        F.when(F.col("value") >= 10, F.col("c_mktsegment")).alias("transactionstring1"),
        F.col("c_mktsegment").alias("categorybehavior"),
        F.when(nation < 8, "America/New_York").when(nation < 16, "Asia/Tokyo").alias("tenanttz"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with numbers and flags as text, some of it unreadable."""
    kind = F.col("event_type")
    ms = epoch_ms("ts").cast("string")
    k = F.get_json_object("props", "$.k")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("eventid"),
        F.when(kind == "click", F.concat(F.lit("+"), ms)).when(kind == "view", F.concat(F.lit(" "), ms))
        .otherwise(ms).alias("eventtime"),
        F.when(kind == "view", F.concat(k, F.lit(".7"))).when(kind == "signup", F.concat(F.lit(" "), k))
        .when(kind == "purchase", "").when(kind == "error", "2147483648")
        .otherwise(F.concat(F.lit("-"), k)).alias("destinationport"),
        F.when(kind == "signup", "inf").when(kind == "click", "1e3").when(kind == "view", "abc")
        .otherwise(F.col("value").cast("string")).alias("transactionnumber1"),
        F.when(kind == "error", "TRUE").when(kind == "view", "true").when(kind == "click", "t")
        .when(kind == "signup", "1").alias("u_encrypted"),
        F.when(kind == "error", "x").otherwise(F.col("user_id").cast("string")).alias("tenantid"),
        F.col("value").alias("rg_riskscore"),
        kind.alias("message"),
    )


def nation_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource group per nation; its functionality is the region."""
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("r_name").alias("functionality")
    )


def supplier_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource group per supplier; its functionality is the supplier's region."""
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("nation"), "s_suppkey")
    regions = nation_groups(spark, sf_dir).withColumnRenamed("id", "nation")
    return attach(suppliers, regions, ["nation"], "inner", ["s_suppkey"]).select(
        F.col("s_suppkey").alias("id"), "functionality"
    )


def customers_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("long"))
    regions = nation_groups(spark, sf_dir).withColumnRenamed("id", "nation")
    return attach(customers, regions, ["nation"], "inner", ["c_custkey"])


def customer_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per customer; one market segment names its resource group, the others none."""
    segment = F.col("c_mktsegment")
    return customers_by_region(spark, sf_dir).select(
        (F.col("c_custkey") + 1).alias("id"),
        F.concat(F.lit("Account "), F.col("c_custkey").cast("string")).alias("name"),
        "functionality",
        F.when(segment == "MACHINERY", F.col("nation")).otherwise(F.lit(-1)).alias("resourcegroupid"),
        (F.col("c_nationkey") - 5).alias("categoryid"),
        F.when(segment == "BUILDING", "High").when(segment == "FURNITURE", "Medium")
        .when(segment == "HOUSEHOLD", "Severe").otherwise("Low").alias("criticality"),
        segment.alias("segment"),
    )


def numbered_policies(policies: DataFrame) -> DataFrame:
    """Policies with threat and risk-type ids already given."""
    return policies.withColumns({"riskthreatid": F.col("id") + 500, "risktypeid": F.col("id") + 900})


def tenant_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a tenant as text, which cannot be read for some hours."""
    return activity(spark, sf_dir).withColumn("tenantid", F.when(F.col("hour") % 5 == 0, F.lit("x")).otherwise(F.lit("7")))


def existing_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policies of one market segment, as those made before."""
    return customer_policies(spark, sf_dir).where("segment = 'BUILDING'").drop("segment")


def segment_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per region and market segment, so that every event falls under a few."""
    segment = F.col("c_mktsegment")
    return (
        customers_by_region(spark, sf_dir)
        .groupBy("functionality", "c_mktsegment")
        .agg((F.min("c_custkey") + 1).alias("id"), F.min("nation").alias("nation"))
        .select(
            "id",
            F.concat_ws(" ", "functionality", "c_mktsegment").alias("name"),
            "functionality",
            F.when(segment == "MACHINERY", F.col("nation")).otherwise(F.lit(-1)).alias("resourcegroupid"),
            (F.col("nation") * 3 + 1).cast("int").alias("categoryid"),
            F.concat(segment, F.lit(" threat")).alias("threatname"),
            (F.col("id") + 500).alias("riskthreatid"),
            (F.col("id") + 900).alias("risktypeid"),
            F.when(segment == "BUILDING", "High").when(segment == "FURNITURE", "Medium")
            .when(segment == "HOUSEHOLD", "Severe").otherwise("Low").alias("criticality"),
            F.lit(ENTITIES[0]).alias("violator"),
            F.when(segment == "BUILDING", F.lit(SENTENCE)).when(segment == "FURNITURE", F.lit(SHORT_SENTENCE))
            .when(segment == "AUTOMOBILE", F.lit(TOTALS)).when(segment != "MACHINERY", F.lit("")).alias("verboseinfotemplate"),
            F.when(segment != "FURNITURE", F.lit("message")).alias("grouping_attribute"),
            F.when(segment != "FURNITURE", F.array(F.lit("transactionstring1"), F.lit("categorybehavior")))
            .alias("level1_meta"),
            F.when(segment != "HOUSEHOLD", F.lit("ipaddress")).alias("level2_attribute"),
            F.when(segment == "BUILDING", F.array(F.lit("hour"))).alias("level2_meta"),
        )
    )


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CATEGORIES.items()), "id int, name string")


def scores(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCORES.items()), "criticality string, score double")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of wanted policies as text, one set per order, good and bad."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def pick(texts: list[str], number: Column) -> Column:
        return F.get(F.array(*[F.lit(text) for text in texts]), number.cast("int"))

    return read(spark, sf_dir, "orders").select(
        key.alias("request_no"),
        F.concat(F.lit("Account "), customer.cast("string")).alias("policyname"),
        pick([*FUNCTIONALITIES, "Home Network", " "], customer % 25).alias("functionality"),
        F.when(status == "F", (key % 13).cast("string")).when(status == "O", "7").otherwise(" 5").alias("categoryid"),
        F.when(priority == "1-URGENT", F.concat(F.lit("Threat to "), customer.cast("string")))
        .otherwise(pick(THREATS, key % 130)).alias("riskthreatname"),
        F.when(priority == "1-URGENT", "High").when(priority == "3-MEDIUM", "Medium")
        .when(priority == "4-NOT SPECIFIED", " ").when(priority == "5-LOW", "Severe").alias("criticality"),
        pick([*ENTITIES, "Device"], customer % 6).alias("violationentity"),
        F.when(status == "F", F.lit(f" {SENTENCE} "))
        .when(status == "O", F.concat(F.lit("${message} of "), customer.cast("string"), F.lit(' ${bytesout$SUM!"0"}')))
        .alias("verboseinformation"),
        F.when(status == "F", " message ").when(status == "P", "").alias("grouping_attribute"),
        F.lit("transactionstring1").alias("level1_metadataattribute1"),
        F.when(priority == "2-HIGH", "categorybehavior").when(priority == "5-LOW", " ").alias("level1_metadataattribute2"),
        F.when(priority != "3-MEDIUM", "categoryoutcome ").alias("level1_metadataattribute3"),
        F.when(priority != "2-HIGH", "ipaddress").otherwise(" ").alias("level2_primaryattribute"),
        F.lit(" ").alias("level2_metadataattribute1"),
        F.when(status == "O", "devicecustomstring2").alias("level2_metadataattribute2"),
        F.lit(None).cast("string").alias("level2_metadataattribute3"),
    )


def known_threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threats that have an id already: those of requests of one priority, by first use."""
    return (
        requests(spark, sf_dir).where("criticality = 'Medium' AND riskthreatname IS NOT NULL")
        .groupBy(F.col("riskthreatname").alias("name")).agg((F.min("request_no") + 1).alias("id"))
    )
