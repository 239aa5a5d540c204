"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from burstline.llm.brown import op8_brown
from burstline.llm.codes import op11_active_lloyd
from burstline.llm.common import prepare
from burstline.llm.decontaminate import op1_decontaminate
from burstline.llm.hard_negatives import op12_hard_negatives
from burstline.llm.langid import op4_language
from burstline.llm.near_dup import op7_minhash
from burstline.llm.pieces import op3_sentencepiece
from burstline.llm.quality import op9_attention_quality
from burstline.llm.rollups import op5_token_rollup
from burstline.llm.toxicity import op13_toxicity
from burstline.llm.url_filter import op6_url_filter
from burstline.llm.vectors import op10_multi_index
from burstline.llm.warc_zip import op2_warc_zip


Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _ready(query) for name, query in OPERATORS.items()}


OPERATORS: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_warc_zip": op2_warc_zip,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_language": op4_language,
    "op5_token_rollup": op5_token_rollup,
    "op6_url_filter": op6_url_filter,
    "op7_minhash": op7_minhash,
    "op8_brown": op8_brown,
    "op9_attention_quality": op9_attention_quality,
    "op10_multi_index": op10_multi_index,
    "op11_active_lloyd": op11_active_lloyd,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_toxicity": op13_toxicity,
    "pipeline": corpus_pipeline.run,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": OP1,
        "op2_warc_zip": OP2,
        "op6_url_filter": OP6,
        "op11_active_lloyd": op11(),
        "op12_hard_negatives": OP12,
    }


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE
    regexp_extract_all({LOWERED.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') END AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWERED.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, words[i : i + size - 1] AS gram
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM (SELECT *, least(10, len(words)) AS size FROM b WHERE len(words) > 0))),
places AS (
  SELECT doc_id, i, size, words[i : i + size - 1] AS gram
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
hits AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows w ON p.size = w.size AND p.gram = w.gram),
inside AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN inside USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP6 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM u),
h AS (
  SELECT page_id, {LOWERED.format('raw_host')} AS host, regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM s),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN fits USING (page_id)
"""


def op11(rounds: int = 6) -> str:
    """Each round compares every part with every entry; distances by inner products, exact for integers of this size."""
    far = "list_inner_product(c, c) - 2 * list_inner_product(c, entry) + list_inner_product(entry, entry)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT n, p, c, CAST(floor(best / 16) AS BIGINT) AS far, best % 16 AS e
  FROM (SELECT n, p, any_value(c) AS c, min(CAST({far} AS BIGINT) * 16 + e) AS best FROM parts JOIN book{r} USING (p) GROUP BY n, p)),""")
        steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{r} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS entry FROM (
      SELECT p, e, i, floor(sum(c[i]) / count(*)) AS mean FROM a{r}, range(1, 9) AS t(i) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e)),""")
    steps.pop()
    return f"""
WITH sound AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS n, [floor(4096 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT n, p, v[p * 8 + 1 : p * 8 + 8] AS c FROM sound, range(0, 8) AS t(p)),
book0 AS MATERIALIZED (SELECT p, n - 1 AS e, c AS entry FROM parts WHERE n <= 16),
{chr(10).join(steps)}
digest AS (
  SELECT sha256(string_agg(CAST(CAST(entry[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM book{rounds}, range(1, 9) AS t(i)),
coded AS (SELECT n, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY n)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM sound JOIN coded USING (n), digest
"""


OP12 = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
