"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from burstline.fixed_values import CATEGORIES, CRITICALITIES, ENTITIES, FUNCTIONALITIES, THREATS
from workload.tables import ABSENT_GROUP, SCORES, SENTENCE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def text_list(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def values(rows: dict) -> str:
    return ", ".join(f"({quoted(k) if isinstance(k, str) else k}, {quoted(v) if isinstance(v, str) else v})" for k, v in rows.items())


ACTIVITY = """activity AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS rg_id, CAST(e.event_id AS VARCHAR) AS eventid,
    epoch_us(e.ts) // 1000 AS eventtime, CAST(e.user_id AS VARCHAR) AS accountname,
    json_extract_string(e.props, '$.k') AS ipaddress, e.event_type AS message,
    CAST(year(e.ts) AS INTEGER) AS year, CAST(dayofyear(e.ts) AS INTEGER) AS dayofyear,
    CAST(hour(e.ts) AS INTEGER) AS hour, CAST(minute(e.ts) AS INTEGER) AS minute,
    CAST(floor(e.value) AS INTEGER) AS bytesout,
    CASE WHEN e.value >= 10 THEN c.c_mktsegment END AS transactionstring1,
    c.c_mktsegment AS categorybehavior,
    CASE WHEN c.c_nationkey < 8 THEN 'America/New_York' WHEN c.c_nationkey < 16 THEN 'Asia/Tokyo' END AS tenanttz
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

HITS = ACTIVITY + """, hits AS (
  SELECT rg_id, accountname, year, dayofyear, count(accountname) AS n, count(*) AS events FROM activity
  WHERE message = 'error' GROUP BY ALL HAVING count(accountname) > 2)"""

FOUND = HITS + """, found AS (
  SELECT a.* FROM activity a WHERE a.message = 'error' AND EXISTS (
    SELECT 1 FROM hits h WHERE h.rg_id = a.rg_id AND h.accountname = a.accountname
      AND h.year = a.year AND h.dayofyear = a.dayofyear))"""

NATION_GROUPS = """nation_groups AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, r_name AS functionality
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = NATION_GROUPS + """, customers AS (
  SELECT c.*, CAST(c.c_nationkey AS BIGINT) AS nation, g.functionality
  FROM customer c JOIN nation_groups g ON c.c_nationkey = g.id)"""

CRITICALITY = """CASE c_mktsegment WHEN 'BUILDING' THEN 'High' WHEN 'FURNITURE' THEN 'Medium'
    WHEN 'HOUSEHOLD' THEN 'Severe' ELSE 'Low' END"""

POLICIES = CUSTOMERS + f""", policies AS (
  SELECT c_custkey + 1 AS id, 'Account ' || c_custkey AS name, functionality,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN nation ELSE -1 END AS resourcegroupid,
    c_nationkey - 5 AS categoryid, {CRITICALITY} AS criticality, c_mktsegment AS segment
  FROM customers), existing AS (SELECT * FROM policies WHERE segment = 'BUILDING')"""

SEGMENTS = CUSTOMERS + f""", segments AS (
  SELECT id, functionality || ' ' || c_mktsegment AS name, functionality,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN nation ELSE -1 END AS resourcegroupid,
    CAST(nation * 3 + 1 AS INTEGER) AS categoryid, c_mktsegment || ' threat' AS threatname,
    id + 500 AS riskthreatid, id + 900 AS risktypeid, {CRITICALITY} AS criticality,
    '{ENTITIES[0]}' AS violator, c_mktsegment AS segment
  FROM (SELECT functionality, c_mktsegment, min(c_custkey) + 1 AS id, min(nation) AS nation
        FROM customers GROUP BY ALL)),
  applied AS (
  SELECT s.*, g.id AS rg_id FROM segments s JOIN nation_groups g ON s.functionality = g.functionality
  WHERE s.resourcegroupid = -1
  UNION ALL SELECT s.*, s.resourcegroupid FROM segments s WHERE s.resourcegroupid <> -1)"""

CATEGORY_TABLE = f"categories(id, name) AS (VALUES {values(CATEGORIES)})"
SCORE_TABLE = f"scores(criticality, score) AS (VALUES {values(SCORES)})"

TAGGED = FOUND + """, totals AS (
  SELECT rg_id, accountname, year, dayofyear, count(transactionstring1) AS total_count,
    CAST(sum(CAST(bytesout AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS total_sum FROM found GROUP BY ALL)""" + ", " + SEGMENTS + ", " + CATEGORY_TABLE + ", " + SCORE_TABLE + """, tagged AS (
  SELECT f.*, a.id AS policy_id, a.name AS policy_name, a.violator, a.riskthreatid AS risk_threat_id,
    a.threatname AS risk_threat_name, a.risktypeid AS risk_type_id, a.categoryid AS category_id,
    coalesce(k.name, '') AS category, CAST(s.score AS DOUBLE) AS risk_score, a.segment, t.total_count, t.total_sum
  FROM found f JOIN applied a ON f.rg_id = a.rg_id
  JOIN totals t ON t.rg_id = f.rg_id AND t.accountname = f.accountname AND t.year = f.year AND t.dayofyear = f.dayofyear
  LEFT JOIN categories k ON k.id = a.categoryid LEFT JOIN scores s ON s.criticality = a.criticality)"""

REQUESTS = f"""requests AS (
  SELECT o_orderkey AS request_no, 'Account ' || o_custkey AS policyname,
    {text_list([*FUNCTIONALITIES, "Home Network", " "])}[o_custkey % 25 + 1] AS functionality,
    CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey % 13 AS VARCHAR) WHEN 'O' THEN '7' ELSE ' 5' END AS categoryid,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Threat to ' || o_custkey
      ELSE {text_list(THREATS)}[o_orderkey % 130 + 1] END AS riskthreatname,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
      WHEN '4-NOT SPECIFIED' THEN ' ' WHEN '5-LOW' THEN 'Severe' END AS criticality,
    {text_list([*ENTITIES, "Device"])}[o_custkey % 6 + 1] AS violationentity,
    CASE o_orderstatus WHEN 'F' THEN {quoted(" " + SENTENCE + " ")}
      WHEN 'O' THEN '${{message}} of ' || o_custkey || ' ${{bytesout$SUM!"0"}}' END AS verboseinformation,
    CASE o_orderstatus WHEN 'F' THEN ' message ' WHEN 'P' THEN '' END AS grouping_attribute,
    'transactionstring1' AS l1a,
    CASE o_orderpriority WHEN '2-HIGH' THEN 'categorybehavior' WHEN '5-LOW' THEN ' ' END AS l1b,
    CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'categoryoutcome ' END AS l1c,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN 'ipaddress' ELSE ' ' END AS level2_primaryattribute,
    ' ' AS l2a, CASE o_orderstatus WHEN 'O' THEN 'devicecustomstring2' END AS l2b, NULL::VARCHAR AS l2c
  FROM orders), known_threats AS (
  SELECT riskthreatname AS name, min(request_no) + 1 AS id FROM requests
  WHERE criticality = 'Medium' AND riskthreatname IS NOT NULL GROUP BY 1)"""

CHECKED = POLICIES + ", " + REQUESTS + f""", checked AS (
  SELECT r.*, e.name IS NOT NULL AS "exists",
    coalesce(trim(policyname), '') <> '' AS name_ok,
    coalesce(regexp_full_match(r.categoryid, '[+-]?[0-9]+'), false) AS category_ok,
    e.name IS NOT NULL OR coalesce(trim(riskthreatname), '') <> '' AS threat_ok,
    e.name IS NOT NULL OR coalesce(trim(r.functionality), '') <> '' AS functionality_ok,
    e.name IS NOT NULL OR coalesce(nullif(trim(r.criticality), ''), 'Low') IN ({", ".join(map(quoted, CRITICALITIES))}) AS criticality_ok,
    e.name IS NOT NULL OR coalesce(violationentity, 'Activityaccount') IN ({", ".join(map(quoted, ENTITIES))}) AS entity_ok,
    coalesce(list_contains({text_list(FUNCTIONALITIES)}, r.functionality), false) AS functionality_listed,
    coalesce(list_contains({text_list(THREATS)}, riskthreatname), false) AS threat_listed
  FROM requests r LEFT JOIN existing e ON e.name = r.policyname)"""
ACCEPTED = "name_ok AND category_ok AND threat_ok AND functionality_ok AND criticality_ok AND entity_ok"

MERGED = CHECKED + ", " + CATEGORY_TABLE + f""", picked AS (
    SELECT * FROM checked WHERE {ACCEPTED} AND NOT "exists" QUALIFY row_number() OVER (PARTITION BY policyname ORDER BY request_no) = 1),
  threat_names AS (SELECT DISTINCT riskthreatname FROM picked),
  threat_made AS (SELECT riskthreatname, (SELECT max(id) FROM known_threats) + row_number() OVER (ORDER BY riskthreatname) AS id
    FROM threat_names WHERE riskthreatname NOT IN (SELECT name FROM known_threats)),
  threat_all AS (SELECT name, id FROM known_threats UNION ALL SELECT riskthreatname, id FROM threat_made),
  made AS (SELECT p.*, row_number() OVER (ORDER BY policyname) AS no FROM picked p),
  merged AS (
    SELECT id, name, functionality, resourcegroupid, categoryid, criticality, id + 500 AS riskthreatid, id + 900 AS risktypeid,
      CASE WHEN id % 2 = 0 THEN 'old' ELSE CAST(id + 1000000 AS VARCHAR) END AS signatureid, false AS is_new,
      NULL::VARCHAR AS category, NULL::VARCHAR AS threatname, NULL::VARCHAR AS riskname, NULL::VARCHAR AS violator,
      NULL::VARCHAR AS verboseinfotemplate, NULL::VARCHAR AS grouping_attribute, NULL::VARCHAR AS level1_meta,
      NULL::VARCHAR AS level2_attribute, NULL::VARCHAR AS level2_meta, NULL::INTEGER AS resourcetypeid, NULL::VARCHAR AS type,
      NULL::VARCHAR AS analyticstype, NULL::VARCHAR AS targetworkflow, NULL::INTEGER AS weight, NULL::VARCHAR AS createdby,
      NULL::VARCHAR AS updatedby, NULL::BOOLEAN AS dashboarddisplay, NULL::BOOLEAN AS enabled FROM existing
    UNION ALL
    SELECT (SELECT max(id) FROM existing) + no, policyname, m.functionality, -1, CAST(m.categoryid AS INTEGER),
      coalesce(CASE WHEN trim(criticality) <> '' THEN criticality END, 'Low'), t.id, (SELECT max(id) + 900 FROM existing) + no,
      CAST((SELECT max(id) + 1000000 FROM existing WHERE id % 2 = 1) + no AS VARCHAR), true, coalesce(c.name, ''), riskthreatname,
      policyname || ' Risk', coalesce(violationentity, 'Activityaccount'), nullif(trim(verboseinformation), ''), nullif(trim(grouping_attribute), ''),
      CASE WHEN trim(grouping_attribute) <> '' THEN concat_ws(',', nullif(trim(l1a), ''), nullif(trim(l1b), ''), nullif(trim(l1c), '')) END,
      nullif(trim(level2_primaryattribute), ''),
      CASE WHEN trim(level2_primaryattribute) <> '' THEN nullif(concat_ws(',', nullif(trim(l2a), ''), nullif(trim(l2b), ''), nullif(trim(l2c), '')), '') END,
      -1, 'HDFS', 'CUSTOM', 'PolicyOutlierWorkflow', 1, 'admin', 'admin', true, true
    FROM made m LEFT JOIN categories c ON c.id = CAST(m.categoryid AS INTEGER)
    JOIN threat_all t ON t.name = m.riskthreatname)"""

RAW = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS eventid, event_type AS kind, value, user_id,
    CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms, json_extract_string(props, '$.k') AS k FROM events),
  raw_events AS (
  SELECT eventid, CASE kind WHEN 'click' THEN '+' || ms WHEN 'view' THEN ' ' || ms ELSE ms END AS eventtime,
    CASE kind WHEN 'view' THEN k || '.7' WHEN 'signup' THEN ' ' || k WHEN 'purchase' THEN ''
      WHEN 'error' THEN '2147483648' ELSE '-' || k END AS destinationport,
    CASE kind WHEN 'signup' THEN 'inf' WHEN 'click' THEN '1e3' WHEN 'view' THEN 'abc'
      ELSE CAST(value AS VARCHAR) END AS transactionnumber1,
    CASE kind WHEN 'error' THEN 'TRUE' WHEN 'view' THEN 'true' WHEN 'click' THEN 't' WHEN 'signup' THEN '1' END AS u_encrypted,
    CASE kind WHEN 'error' THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS tenantid,
    value AS rg_riskscore, kind AS message FROM raw),
  typed AS (
  SELECT eventid,
    CASE WHEN regexp_full_match(eventtime, '[+-]?[0-9]+') THEN TRY_CAST(ltrim(eventtime, '+') AS BIGINT) END AS eventtime,
    CASE WHEN regexp_full_match(destinationport, '[+-]?[0-9]+') THEN TRY_CAST(destinationport AS INTEGER) END AS destinationport,
    CASE WHEN lower(transactionnumber1) NOT IN ('inf', 'nan') THEN TRY_CAST(transactionnumber1 AS DOUBLE) END AS transactionnumber1,
    lower(u_encrypted) = 'true' AS u_encrypted,
    CASE WHEN regexp_full_match(tenantid, '[+-]?[0-9]+') THEN TRY_CAST(tenantid AS BIGINT) END AS tenantid,
    rg_riskscore, message, tenantid AS tenant_text, eventtime AS time_text, destinationport AS port_text,
    transactionnumber1 AS number_text FROM raw_events)"""

DAY = """epoch_us(timezone(coalesce(tenanttz, 'GMT'),
    date_trunc('day', timezone(coalesce(tenanttz, 'GMT'), make_timestamptz(eventtime * 1000))))) // 1000"""


def filled(column: str, default: str) -> str:
    return f"coalesce(nullif({column}, ''), {quoted(default)})"


FIXED_SENTENCE = (
    f"'Account ' || {filled('accountname', 'ACCOUNTNAME')} || ' performed ' || "
    f"{filled('transactionstring1', 'ACTIVITY')} || ' from ipaddress ' || {filled('ipaddress', 'UNKNOWN')}"
)
POLICY_SENTENCE = f"""CASE segment WHEN 'BUILDING' THEN {FIXED_SENTENCE}
    WHEN 'FURNITURE' THEN message || ' by ' || accountname || ' [n/a]'
    WHEN 'AUTOMOBILE' THEN 'Account ' || {filled('accountname', 'ACCOUNTNAME')} || ' performed a total of ' || total_count
      || ' uploads amounting to ' || coalesce(CAST(total_sum AS VARCHAR), 'UNKNOWN')
    WHEN 'MACHINERY' THEN NULL ELSE '' END"""
VERBOSE = """CASE segment
    WHEN 'BUILDING' THEN concat_ws(',', 'accountname=' || accountname, 'ipaddress=' || ipaddress, 'transactionstring1=' || transactionstring1)
    WHEN 'FURNITURE' THEN concat_ws(',', 'accountname=' || accountname, 'message=' || message)
    WHEN 'AUTOMOBILE' THEN concat_ws(',', 'accountname=' || accountname, 'bytesout=' || bytesout, 'transactionstring1=' || transactionstring1)
    ELSE '' END"""
VIOLATION_ID = "sha256(policy_id || '|' || rg_id || '|' || eventid)"
TREE = """SELECT policy_id, policy_name, violator, risk_threat_id, risk_threat_name, risk_type_id, category_id, category, risk_score,
    eventid, """ + VIOLATION_ID + """ AS key, """ + VERBOSE + """ AS verbose_values, """ + DAY + """ AS day_epoch, accountname AS root,
    CASE WHEN segment <> 'FURNITURE' THEN message END AS level1,
    CASE WHEN segment <> 'FURNITURE' THEN concat_ws('/', transactionstring1, categorybehavior) ELSE '' END AS level1_meta,
    CASE WHEN segment <> 'HOUSEHOLD' THEN ipaddress END AS level2,
    CASE WHEN segment = 'BUILDING' THEN CAST(hour AS VARCHAR) ELSE '' END AS level2_meta FROM tagged"""


def oracle_sql() -> dict[str, str]:
    key_columns = "rg_id, accountname, year, dayofyear"
    new_categories = """requested AS (SELECT DISTINCT o_custkey + 1 AS policyid, CAST(o_custkey % 13 AS INTEGER) AS categoryid
      FROM orders)"""
    flat_record = """eventid, 1 AS violations, policy_id, policy_name, violator, risk_threat_id, risk_threat_name, risk_type_id,
      category_id, category, risk_score, day_epoch, day_epoch AS verbose_day, root,
      level1, level1_meta, level2, level2_meta, verbose_values"""
    return {
        "scan_activity": f"WITH {ACTIVITY} SELECT * FROM activity WHERE rg_id = 1",
        "scan_activity_multi": f"WITH {ACTIVITY}, {NATION_GROUPS} SELECT * FROM activity WHERE rg_id IN "
            "(SELECT id FROM nation_groups WHERE functionality = 'ASIA')",
        "skipped_groups": f"WITH {ACTIVITY} SELECT DISTINCT s_suppkey AS rg_id FROM supplier "
            "WHERE s_suppkey NOT IN (SELECT rg_id FROM activity)",
        "filter_message": f"WITH {ACTIVITY} SELECT * FROM activity WHERE message = 'error'",
        "bucket_minute": f"WITH {ACTIVITY} SELECT eventid, year, dayofyear, hour, minute, "
            "(eventtime // 60000) * 60000 AS minute_epoch FROM activity",
        "detect": f"WITH {HITS} SELECT * FROM hits",
        "detect_keys": f"WITH {HITS} SELECT {key_columns} FROM hits",
        "detect_sql": f"WITH {ACTIVITY} SELECT accountname, ipaddress, count(accountname) AS n FROM activity "
            "WHERE message = 'error' GROUP BY ALL HAVING count(accountname) > 1",
        "burst_hits": f"""WITH {ACTIVITY} SELECT rg_id, accountname, ipaddress, year, dayofyear, hour, minute,
            count(accountname) AS n, count(*) AS events FROM activity WHERE message = 'error' GROUP BY ALL HAVING count(accountname) > 0""",
        "hits_per_group": f"WITH {HITS} SELECT rg_id, count(*) AS hits FROM hits GROUP BY rg_id",
        "drilldown": f"WITH {FOUND} SELECT * FROM found",
        "drilldown_one": f"""WITH {FOUND} SELECT * FROM found WHERE ({key_columns}) IN (
            SELECT ({key_columns}) FROM hits ORDER BY {key_columns} LIMIT 1)""",
        "custom_analyzer": f"""WITH {ACTIVITY}, wide AS (SELECT rg_id, accountname FROM activity WHERE message = 'error'
            GROUP BY ALL HAVING count(DISTINCT ipaddress) > 12)
            SELECT a.* FROM activity a SEMI JOIN wide w ON a.rg_id = w.rg_id AND a.accountname = w.accountname
            WHERE a.message = 'error'""",
        "policy_by_id": f"WITH {POLICIES} SELECT id, name, functionality FROM policies WHERE id IN "
            "(SELECT o_custkey FROM orders)",
        "policy_by_name": f"WITH {POLICIES}, {REQUESTS} SELECT request_no, policyname, e.id AS policy_id "
            "FROM requests r LEFT JOIN existing e ON e.name = r.policyname",
        "rgs_for_functionality": f"WITH {NATION_GROUPS} SELECT s_suppkey AS id FROM supplier JOIN nation_groups "
            "ON s_nationkey = id WHERE functionality = 'ASIA'",
        "policy_groups": f"""WITH {POLICIES} SELECT p.id, g.id AS rg_id FROM policies p JOIN nation_groups g
            ON p.functionality = g.functionality WHERE p.resourcegroupid = -1
            UNION ALL SELECT id, resourcegroupid FROM policies WHERE resourcegroupid <> -1""",
        "policy_defaults": f"""WITH {REQUESTS} SELECT request_no, coalesce(CASE WHEN trim(criticality) <> '' THEN criticality END, 'Low') AS criticality,
            coalesce(violationentity, 'Activityaccount') AS violationentity, nullif(trim(verboseinformation), '') AS verboseinformation,
            nullif(trim(grouping_attribute), '') AS grouping_attribute, nullif(trim(l1b), '') AS level1_metadataattribute2,
            nullif(trim(l1c), '') AS level1_metadataattribute3 FROM requests""",
        "display_config": f"""WITH {REQUESTS} SELECT request_no, nullif(trim(grouping_attribute), '') AS grouping_attribute,
            CASE WHEN trim(grouping_attribute) <> '' THEN concat_ws(',', nullif(trim(l1a), ''), nullif(trim(l1b), ''), nullif(trim(l1c), '')) END AS level1_meta,
            nullif(trim(level2_primaryattribute), '') AS level2_attribute,
            CASE WHEN trim(level2_primaryattribute) <> '' THEN nullif(concat_ws(',', nullif(trim(l2a), ''), nullif(trim(l2b), ''), nullif(trim(l2c), '')), '') END AS level2_meta
            FROM requests""",
        "policy_category_name": f"WITH {POLICIES}, {CATEGORY_TABLE} SELECT p.id, p.categoryid, coalesce(c.name, '') AS category "
            "FROM policies p LEFT JOIN categories c ON c.id = p.categoryid",
        "tag_score": f"WITH {POLICIES}, {SCORE_TABLE} SELECT p.id, p.criticality, CAST(s.score AS DOUBLE) AS risk_score "
            "FROM policies p LEFT JOIN scores s ON s.criticality = p.criticality",
        "policy_threat_id": f"""WITH {REQUESTS}, names AS (SELECT DISTINCT riskthreatname AS threatname FROM requests
              WHERE riskthreatname IS NOT NULL),
            made AS (SELECT threatname, (SELECT max(id) FROM known_threats) + row_number() OVER (ORDER BY threatname) AS id
              FROM names WHERE threatname NOT IN (SELECT name FROM known_threats))
            SELECT threatname, id AS riskthreatid, false AS is_new FROM names JOIN known_threats ON name = threatname
            UNION ALL SELECT threatname, id, true FROM made""",
        "validate_policies": f"WITH {CHECKED} SELECT request_no, policyname, \"exists\", name_ok, category_ok, threat_ok, "
            f"functionality_ok, criticality_ok, entity_ok, functionality_listed, threat_listed, {ACCEPTED} AS accepted FROM checked",
        "replace_categories": f"""WITH {POLICIES}, {CATEGORY_TABLE}, {new_categories}
            SELECT p.id AS policyid, p.categoryid, p.id + 500 AS riskthreatid, p.id + 900 AS risktypeid, coalesce(c.name, '') AS category
            FROM policies p LEFT JOIN categories c ON c.id = p.categoryid WHERE p.id NOT IN (SELECT policyid FROM requested)
            UNION ALL SELECT r.policyid, r.categoryid, p.id + 500, p.id + 900, coalesce(c.name, '') FROM requested r
            LEFT JOIN policies p ON p.id = r.policyid LEFT JOIN categories c ON c.id = r.categoryid""",
        "assign_signature_ids": f"WITH {POLICIES} SELECT name, CAST(1000000 + row_number() OVER (ORDER BY name) AS VARCHAR) AS signatureid FROM policies",
        "merge_policies": f"""WITH {MERGED} SELECT * FROM merged""",
        "merged_categories": f"""WITH {MERGED} SELECT m.id AS policyid, m.categoryid, m.riskthreatid, m.risktypeid, coalesce(c.name, '') AS category
            FROM merged m LEFT JOIN categories c ON c.id = m.categoryid""",
        "page_deep": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY ALL LIMIT 500 OFFSET 30000",
        "group_tables": f"""WITH {ACTIVITY} SELECT rg_id, eventid, false AS skipped FROM activity WHERE rg_id <> {ABSENT_GROUP}
            UNION ALL SELECT {ABSENT_GROUP}, NULL, true""",
        "rejected_events": f"""WITH {TAGGED} SELECT eventid, count(*) AS violations, NULL::VARCHAR AS tenantid FROM tagged
            WHERE hour % 5 <> 0 GROUP BY eventid
            UNION ALL SELECT eventid, 0, 'x' FROM found WHERE hour % 5 = 0""",
        "analyzer_without_count": f"WITH {FOUND} SELECT * FROM found",
        "page_one": f"WITH {FOUND} SELECT * FROM found ORDER BY eventtime, eventid LIMIT 10 OFFSET 5",
        "page_number": f"""WITH {FOUND} SELECT eventid, {key_columns}, CAST((row_number() OVER (PARTITION BY {key_columns}
            ORDER BY eventtime, eventid) - 1) // 2 AS BIGINT) AS page FROM found""",
        "page_number_all": f"""WITH {ACTIVITY} SELECT eventid, message, CAST((row_number() OVER (PARTITION BY message
            ORDER BY eventtime, eventid) - 1) // 1000 AS BIGINT) AS page FROM activity""",
        "violations_per_page": f"""WITH {ACTIVITY}, heavy AS (SELECT {key_columns} FROM activity WHERE message = 'error' GROUP BY ALL
              HAVING count(transactionstring1) > 1),
            paged AS (SELECT {key_columns}, CAST((row_number() OVER (PARTITION BY {key_columns}
            ORDER BY eventtime, eventid) - 1) // 2 AS BIGINT) AS page FROM activity JOIN heavy USING ({key_columns}) WHERE message = 'error')
            SELECT {key_columns}, page, count(*) AS events FROM paged GROUP BY ALL""",
        "parse_fields": f"WITH {RAW} SELECT eventid, CAST(length(eventid) AS VARCHAR) AS eventcount, eventtime, destinationport, transactionnumber1, u_encrypted, tenantid, rg_riskscore, message FROM typed",
        "parse_strict": f"WITH {RAW} SELECT eventid, tenantid, tenantid IS NULL AS quarantined FROM typed",
        "parse_failures": f"""WITH {RAW}
            SELECT 'eventtime' AS field, count(*) FILTER (time_text IS NOT NULL AND eventtime IS NULL) AS failures FROM typed
            UNION ALL SELECT 'destinationport', count(*) FILTER (port_text IS NOT NULL AND destinationport IS NULL) FROM typed
            UNION ALL SELECT 'transactionnumber1', count(*) FILTER (number_text IS NOT NULL AND transactionnumber1 IS NULL) FROM typed
            UNION ALL SELECT 'tenantid', count(*) FILTER (tenant_text IS NOT NULL AND tenantid IS NULL) FROM typed
            UNION ALL SELECT 'rg_riskscore', count(*) FILTER (rg_riskscore IS NULL) FROM typed
            UNION ALL SELECT 'eventtime.day', 0""",
        "day_epoch": f"WITH {ACTIVITY} SELECT eventid, tenanttz, {DAY} AS day_epoch FROM activity",
        "template_vars": f"WITH {REQUESTS} SELECT request_no, array_to_string(regexp_extract_all(verboseinformation, "
            "'\\$\\{([A-Za-z0-9_]+)(?:\\$(COUNT|SUM))?(?:!\"([^\"]*)\")?\\}', 1), ',') AS variables FROM requests",
        "render_template": f"WITH {FOUND} SELECT eventid, {FIXED_SENTENCE} AS sentence FROM found",
        "render_policy_template": f"WITH {TAGGED} SELECT policy_id, eventid, {POLICY_SENTENCE} AS sentence FROM tagged",
        "render_template_agg": f"""WITH {FOUND} SELECT {key_columns}, 'Account ' || {filled('accountname', 'ACCOUNTNAME')}
            || ' performed a total of ' || count(transactionstring1) || ' uploads amounting to '
            || coalesce(CAST(CAST(sum(CAST(bytesout AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS VARCHAR), 'UNKNOWN') AS sentence
            FROM found GROUP BY {key_columns}""",
        "verbose_values": f"""WITH {TAGGED}, long AS (
              SELECT policy_id, eventid, {DAY} AS day_epoch, segment, unnest(['accountname', 'transactionstring1', 'ipaddress', 'message', 'bytesout']) AS variable,
                unnest([accountname, transactionstring1, ipaddress, message, CAST(bytesout AS VARCHAR)]) AS value FROM tagged)
            SELECT policy_id, eventid, day_epoch, variable, value FROM long WHERE value IS NOT NULL AND
              ((segment = 'BUILDING' AND variable IN ('accountname', 'transactionstring1', 'ipaddress')) OR
                (segment = 'FURNITURE' AND variable IN ('message', 'accountname')) OR
                (segment = 'AUTOMOBILE' AND variable IN ('accountname', 'transactionstring1', 'bytesout')))""",
        "tag_policy": f"""WITH {TAGGED} SELECT rg_id, eventid, eventtime, accountname, ipaddress, policy_id, policy_name, violator,
            risk_threat_id, risk_threat_name, risk_type_id, category_id, category, risk_score FROM tagged""",
        "violations": f"""WITH {TAGGED} SELECT {VIOLATION_ID} AS violation_id, rg_id, eventid, eventtime, accountname, policy_id,
            policy_name, risk_score, {DAY} AS day_epoch, {POLICY_SENTENCE} AS sentence FROM tagged""",
        "violation_tree": f"""WITH {TAGGED}, nodes AS ({TREE})
            SELECT policy_id, day_epoch, root, level1, level1_meta, level2, level2_meta, count(*) AS events FROM nodes GROUP BY ALL""",
        "violations_nested": f"""WITH {TAGGED}, nodes AS ({TREE})
            SELECT {flat_record} FROM nodes""",
        "violations_json": f"""WITH {TAGGED}, nodes AS ({TREE}) SELECT {flat_record} FROM nodes""",
        "detect_stream": f"""WITH {ACTIVITY} SELECT {key_columns}, count(accountname) AS n, count(*) AS events,
            count(*) FILTER (CAST(eventid AS BIGINT) % 25 > 10) AS late
            FROM activity WHERE message = 'error' GROUP BY {key_columns} HAVING count(accountname) > 2""",
        "published_pages": f"""WITH {FOUND}, paged AS (SELECT *, CAST((row_number() OVER (PARTITION BY {key_columns}
              ORDER BY eventtime, eventid) - 1) // 2 AS BIGINT) AS page FROM found),
            texts AS (SELECT {key_columns}, page, sha256('{{"rg_id":' || rg_id || ',"eventid":"' || eventid || '","eventtime":' || eventtime
              || ',"accountname":"' || accountname || '","year":' || year || ',"dayofyear":' || dayofyear || '}}') AS text FROM paged)
            SELECT {key_columns}, page, count(*) AS events, sha256(string_agg(text, ',' ORDER BY text)) AS digest, count(*) AS messages
            FROM texts GROUP BY {key_columns}, page""",
        "published_counts": f"""WITH {TAGGED}, sound AS (SELECT * FROM tagged WHERE hour % 5 <> 0),
            sizes AS (SELECT {key_columns}, count(*) AS n FROM sound GROUP BY {key_columns}),
            counts AS (SELECT (SELECT count(*) FROM found) AS read, (SELECT count(*) FROM found WHERE hour % 5 = 0) AS rejected,
              (SELECT count(*) FROM sound) AS formed, (SELECT CAST(sum((n + 1) // 2) AS BIGINT) FROM sizes) AS all_pages)
            SELECT CAST(1 AS INTEGER) AS run, read, rejected, formed, formed AS events, all_pages AS pages, CAST(0 AS BIGINT) AS known_pages FROM counts
            UNION ALL SELECT 2, read, rejected, formed, 0, 0, all_pages FROM counts""",
        "category_lists": f"""WITH {POLICIES}, {CATEGORY_TABLE}, listed AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey % 5 <> 1),
            given AS (SELECT key + 1 AS policyid, CAST(unnest([key % 13, (key + 3) % 13]) AS INTEGER) AS categoryid FROM listed WHERE key % 5 <> 0),
            after AS (SELECT id AS policyid, categoryid FROM policies WHERE id - 1 NOT IN (SELECT key FROM listed) UNION ALL SELECT * FROM given)
            SELECT a.policyid, a.categoryid, p.id + 500 AS riskthreatid, p.id + 900 AS risktypeid, coalesce(c.name, '') AS category
            FROM after a LEFT JOIN policies p ON p.id = a.policyid LEFT JOIN categories c ON c.id = a.categoryid""",
        "kept_ids": f"""WITH {CHECKED}, wanted AS (SELECT policyname, bool_or(request_no % 2 = 0) AS early FROM checked
              WHERE {ACCEPTED} AND NOT "exists" GROUP BY policyname),
            counts AS (SELECT (SELECT max(id) FROM existing) AS last, (SELECT count(*) FROM wanted WHERE early) AS gone),
            made AS (SELECT policyname, gone + row_number() OVER (ORDER BY policyname) AS no, last FROM wanted, counts)
            SELECT name, id, CAST(id + 1000000 AS VARCHAR) AS signatureid, id + 900 AS risktypeid FROM existing
            UNION ALL SELECT policyname, last + no, CAST(last + 1000000 + no AS VARCHAR), last + 900 + no FROM made""",
        "display_config_xml": f"""WITH {REQUESTS}, columns AS (SELECT request_no, nullif(trim(grouping_attribute), '') AS grouping_attribute,
              CASE WHEN trim(grouping_attribute) <> '' THEN concat_ws(',', nullif(trim(l1a), ''), nullif(trim(l1b), ''), nullif(trim(l1c), '')) END AS level1_meta,
              nullif(trim(level2_primaryattribute), '') AS level2_attribute,
              CASE WHEN trim(level2_primaryattribute) <> '' THEN nullif(concat_ws(',', nullif(trim(l2a), ''), nullif(trim(l2b), ''), nullif(trim(l2c), '')), '') END AS level2_meta
              FROM requests)
            SELECT *, grouping_attribute IS NOT NULL OR level2_attribute IS NOT NULL AS stored, false AS display_unreadable FROM columns""",
        "group_folders": f"""WITH {ACTIVITY} SELECT rg_id, eventid, false AS skipped FROM activity WHERE rg_id <> {ABSENT_GROUP}
            UNION ALL SELECT CAST(n_nationkey AS BIGINT), NULL, true FROM nation
              WHERE n_nationkey = {ABSENT_GROUP} OR n_nationkey NOT IN (SELECT rg_id FROM activity)""",
        "drilldown_filtered": f"WITH {FOUND} SELECT * FROM found",
        "rows_near_hits": f"WITH {FOUND} SELECT eventid FROM found",
        "parse_warnings": f"""WITH {RAW}
            SELECT eventid, 'destinationport' AS field, port_text AS value FROM typed WHERE port_text IS NOT NULL AND destinationport IS NULL
            UNION ALL SELECT eventid, 'eventtime', time_text FROM typed WHERE time_text IS NOT NULL AND eventtime IS NULL
            UNION ALL SELECT eventid, 'transactionnumber1', number_text FROM typed WHERE number_text IS NOT NULL AND transactionnumber1 IS NULL
            UNION ALL SELECT eventid, 'tenantid', tenant_text FROM typed WHERE tenant_text IS NOT NULL AND tenantid IS NULL""",
        "totals_of_thousandths": f"""WITH {FOUND} SELECT {key_columns}, 'Account ' || {filled('accountname', 'ACCOUNTNAME')}
            || ' performed a total of ' || count(transactionstring1) || ' uploads amounting to '
            || coalesce(CAST(CAST(sum(CAST(bytesout AS DECIMAL(18, 3)) * CAST(0.001 AS DECIMAL(4, 3))) AS DECIMAL(38, 2)) AS VARCHAR), 'UNKNOWN') AS sentence
            FROM found GROUP BY {key_columns}""",
    }
