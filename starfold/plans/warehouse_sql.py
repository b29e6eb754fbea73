"""Independent ANSI-SQL statements (DuckDB dialect) for the warehouse queries.

Written from the semantics, not generated from the Spark plans, so that a
result match is evidence. Surrogate keys (xxhash64) are left out; DuckDB has
no such function. Integer sums are cast to BIGINT and small integers to
INTEGER so result types line up with Spark's.
"""

from __future__ import annotations

from starfold.plans import warehouse as W


def norm(expr: str) -> str:
    return f"coalesce(trim(CAST({expr} AS VARCHAR)), '<null>')"


def sha(*exprs: str) -> str:
    return "sha256(concat_ws('||', " + ", ".join(norm(e) for e in exprs) + "))"


def d(iso: str) -> str:
    return f"DATE '{iso}'"


def initcap(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def null_if_missing(expr: str) -> str:
    return f"CASE WHEN trim({expr}) IN ('', 'NA', 'N/A', 'null', 'NULL') THEN NULL ELSE trim({expr}) END"


MEDAL = ("CASE WHEN l.l_returnflag = 'A' THEN 'Gold' WHEN l.l_returnflag = 'R' THEN 'Silver' "
         "WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'Bronze' END")

EV = f"""ev AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey AS c_custkey,
         CAST(o.o_orderdate AS DATE) AS order_date, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         p.p_type, p.p_brand, l.l_quantity, l.l_extendedprice, l.l_discount,
         {MEDAL} AS medal,
         {sha('l.l_orderkey', 'l.l_linenumber', 'l.l_partkey', 'l.l_suppkey', 'o.o_custkey')} AS line_key
  FROM (SELECT DISTINCT * FROM lineitem) l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

SNAP = f"""snap AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, x.o_orderpriority AS priority,
         x.o_orderkey AS last_orderkey, x.batch_date,
         {sha('c.c_mktsegment', 'x.o_orderpriority')} AS record_hash
  FROM (
    SELECT o_custkey, o_orderkey, o_orderpriority,
           make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31) AS batch_date,
           row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                              ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderpriority DESC) AS rn
    FROM orders
  ) x
  JOIN customer c ON c.c_custkey = x.o_custkey
  WHERE x.rn = 1
)"""

HIST = f"""{SNAP},
starts AS (
  SELECT * FROM (
    SELECT *, lag(record_hash) OVER (PARTITION BY c_custkey ORDER BY batch_date) AS prev_hash FROM snap
  ) WHERE prev_hash IS NULL OR prev_hash <> record_hash
),
hist AS (
  SELECT c_custkey, c_name, c_mktsegment, priority, last_orderkey, record_hash,
         batch_date AS valid_from,
         coalesce(CAST(lead(batch_date) OVER w - INTERVAL 1 DAY AS DATE), {d('9999-12-31')}) AS valid_to,
         lead(batch_date) OVER w IS NULL AS is_current
  FROM starts
  WINDOW w AS (PARTITION BY c_custkey ORDER BY batch_date)
)"""

LIFE = f"""{HIST},
life AS (
  SELECT c_custkey, count(*) AS nb_of_versions, min(valid_from) AS first_seen,
         max(valid_from) AS latest_version,
         max(CASE WHEN is_current THEN priority END) AS current_priority
  FROM hist GROUP BY c_custkey
)"""

CLS = f"""{LIFE},
cls AS (
  SELECT *, CASE WHEN nb_of_versions > 1 THEN 'UPDATE'
                 WHEN first_seen = {d(W.LAST_BATCH)} THEN 'INSERT'
                 ELSE 'UNCHANGED' END AS change_type
  FROM life
)"""

SCD_COLS = "c_custkey, c_name, c_mktsegment, priority, last_orderkey, record_hash"

INIT = f"""init AS (
  SELECT {SCD_COLS}, {d(W.FIRST_BATCH)} AS valid_from, {d('9999-12-31')} AS valid_to, TRUE AS is_current
  FROM snap WHERE batch_date = {d(W.FIRST_BATCH)}
),
inc AS (SELECT {SCD_COLS} FROM snap WHERE batch_date = {d(W.SECOND_BATCH)})"""

FACT = f"""WITH {EV}, {HIST},
cur AS (SELECT * FROM hist WHERE is_current),
fact AS (
  SELECT ev.*, cur.c_custkey IS NOT NULL AS customer_matched,
         cur.c_mktsegment AS cur_segment, cur.priority AS cur_priority,
         1 AS participation_count,
         CASE WHEN ev.medal IS NOT NULL THEN 1 ELSE 0 END AS medal_count,
         CASE WHEN ev.medal = 'Gold' THEN 1 ELSE 0 END AS gold_count,
         CASE WHEN ev.medal = 'Silver' THEN 1 ELSE 0 END AS silver_count,
         CASE WHEN ev.medal = 'Bronze' THEN 1 ELSE 0 END AS bronze_count
  FROM ev LEFT JOIN cur ON ev.c_custkey = cur.c_custkey
)"""

ORDER_BATCH = "make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31)"

ACTIVE_SUPPLIER = "(SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"
REGIONAL_REF = (f"(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey "
                f"WHERE r_name <> '{W.UNLISTED_REGION}')")


def _gate_rows() -> str:
    rows = [
        ("customer is empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM (SELECT 1 FROM customer LIMIT 1)"),
        ("lineitem is empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM (SELECT 1 FROM lineitem LIMIT 1)"),
        ("orders rows with null keys (o_orderkey, o_custkey)",
         "SELECT count(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL"),
        ("customer rows with null keys (c_custkey, c_mktsegment)",
         "SELECT count(*) FROM customer WHERE c_custkey IS NULL OR c_mktsegment IS NULL "
         "OR trim(c_mktsegment) = ''"),
        ("lineitem duplicate keys (l_orderkey, l_linenumber)",
         "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
        ("lineitem.l_suppkey orphans",
         f"SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey IS NOT NULL AND NOT EXISTS "
         f"(SELECT 1 FROM {ACTIVE_SUPPLIER} s WHERE s.s_suppkey = lineitem.l_suppkey)"),
        ("customer.c_nationkey missing from reference",
         f"SELECT count(*) FROM (SELECT c_nationkey FROM customer GROUP BY c_nationkey) c WHERE NOT EXISTS "
         f"(SELECT 1 FROM {REGIONAL_REF} r WHERE r.n_nationkey = c.c_nationkey)"),
    ]
    return "\nUNION ALL ".join(f"SELECT '{name}' AS \"check\", CAST(({q}) AS BIGINT) AS violations"
                               for name, q in rows)


# Events of two batches of which some have no year; each row is in one batch (``first``: in the first one).
_SPOILT_EVENTS = """src AS (
  SELECT DISTINCT c.c_custkey, c.c_name, c.c_mktsegment, l.l_linenumber, l.l_quantity, p.p_size, c.c_nationkey,
         CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE CAST(year(o.o_orderdate) AS INTEGER) END AS year,
         CASE WHEN c.c_custkey % 7 = 0 THEN -1 ELSE year(o.o_orderdate) END AS games, p.p_type, p.p_brand,
         """ + MEDAL + """ AS medal, o.o_totalprice < 150000 AS first
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
)"""


SQL: dict[str, str] = {
    "yearly_trend": f"""{FACT}
SELECT year, count(*) AS participations, CAST(sum(medal_count) AS BIGINT) AS medals,
       CAST(sum(gold_count) AS BIGINT) AS gold_medals, CAST(sum(silver_count) AS BIGINT) AS silver_medals,
       CAST(sum(bronze_count) AS BIGINT) AS bronze_medals,
       round(CAST(sum(medal_count) AS DOUBLE) / count(*), 4) AS medal_rate
FROM fact GROUP BY year""",
    "fact_star": f"""{FACT}
SELECT line_key, l_orderkey, l_linenumber, l_suppkey, c_custkey, order_date, p_type, p_brand, year,
       l_quantity, l_extendedprice, l_discount, medal, participation_count, medal_count, gold_count,
       silver_count, bronze_count, customer_matched
FROM fact""",
    "totals_by_member": f"""{FACT}
SELECT cur_segment AS c_mktsegment, cur_priority AS priority, count(*) AS participations,
       CAST(sum(gold_count) AS BIGINT) AS gold, CAST(sum(silver_count) AS BIGINT) AS silver,
       CAST(sum(bronze_count) AS BIGINT) AS bronze, CAST(sum(medal_count) AS BIGINT) AS total_medals,
       round(CAST(sum(medal_count) AS DOUBLE) / count(*), 4) AS medal_rate
FROM fact WHERE customer_matched GROUP BY cur_segment, cur_priority""",
    "deduped_medal_table": f"""WITH {EV}
SELECT c_nationkey,
       CAST(sum(CASE WHEN medal = 'Gold' THEN 1 ELSE 0 END) AS BIGINT) AS gold,
       CAST(sum(CASE WHEN medal = 'Silver' THEN 1 ELSE 0 END) AS BIGINT) AS silver,
       CAST(sum(CASE WHEN medal = 'Bronze' THEN 1 ELSE 0 END) AS BIGINT) AS bronze,
       count(medal) AS total
FROM (SELECT DISTINCT ev.year, ev.l_orderkey, c.c_nationkey, ev.p_type, ev.p_brand, ev.medal
      FROM ev LEFT JOIN customer c ON ev.c_custkey = c.c_custkey)
GROUP BY c_nationkey""",
    "dim_supplier": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "dim_date": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "dim_part_kind": "SELECT DISTINCT p_type, p_brand FROM part",
    "scd2_initial": f"WITH {SNAP}, {INIT} SELECT * FROM init",
    "scd2_merge": f"""WITH {SNAP}, {INIT}
SELECT f.c_custkey, f.c_name, f.c_mktsegment, f.priority, f.last_orderkey, f.record_hash, f.valid_from,
       CASE WHEN i.c_custkey IS NOT NULL AND i.record_hash <> f.record_hash
            THEN CAST({d(W.SECOND_BATCH)} - INTERVAL 1 DAY AS DATE) ELSE f.valid_to END AS valid_to,
       CASE WHEN i.c_custkey IS NOT NULL AND i.record_hash <> f.record_hash
            THEN FALSE ELSE f.is_current END AS is_current
FROM init f LEFT JOIN inc i ON f.c_custkey = i.c_custkey
UNION ALL
SELECT i.c_custkey, i.c_name, i.c_mktsegment, i.priority, i.last_orderkey, i.record_hash,
       {d(W.SECOND_BATCH)}, {d('9999-12-31')}, TRUE
FROM inc i LEFT JOIN init f ON f.c_custkey = i.c_custkey
WHERE f.c_custkey IS NULL OR f.record_hash <> i.record_hash""",
    "scd2_compare": f"""WITH {SNAP}, {INIT}
SELECT i.c_custkey, i.c_name, i.c_mktsegment, i.priority, i.last_orderkey, i.record_hash,
       f.record_hash AS existing_hash,
       CASE WHEN f.record_hash IS NULL THEN 'INSERT'
            WHEN i.record_hash <> f.record_hash THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type
FROM inc i LEFT JOIN init f ON f.c_custkey = i.c_custkey""",
    "scd2_multi_batch": f"WITH {HIST} SELECT * FROM hist",
    "scd2_status": f"WITH {HIST} SELECT is_current, count(*) AS count FROM hist GROUP BY is_current",
    "scd2_changes": f"""WITH {HIST}
SELECT * FROM (
  SELECT c_custkey, lag(priority) OVER w AS previous_priority, priority AS new_priority,
         lag(valid_from) OVER w AS previous_valid_from, lag(valid_to) OVER w AS previous_valid_to,
         valid_from AS new_valid_from, valid_to AS new_valid_to, is_current
  FROM hist WINDOW w AS (PARTITION BY c_custkey ORDER BY valid_from)
) WHERE previous_priority IS NOT NULL AND previous_priority <> new_priority""",
    "scd2_timeline": f"""WITH {LIFE}
SELECT c_custkey, priority, valid_from, valid_to, is_current, record_hash FROM hist
WHERE c_custkey IN (SELECT c_custkey FROM life
                    WHERE nb_of_versions > 1 AND latest_version = {d(W.LAST_BATCH)})""",
    "scd2_lifecycle": f"WITH {LIFE} SELECT * FROM life",
    "scd2_inserts": f"""WITH {LIFE}
SELECT c_custkey, current_priority, first_seen FROM life
WHERE nb_of_versions = 1 AND first_seen = {d(W.LAST_BATCH)}""",
    "scd2_classify": f"WITH {CLS} SELECT * FROM cls",
    "scd2_classify_counts": f"WITH {CLS} SELECT change_type, count(*) AS count FROM cls GROUP BY change_type",
    "batch_summary": f"SELECT {ORDER_BATCH} AS odate, count(*) AS number_rows FROM orders GROUP BY 1",
    "batch_new_keys": f"""SELECT DISTINCT a.o_custkey FROM orders a
WHERE {ORDER_BATCH.replace('o_orderdate', 'a.o_orderdate')} = {d(W.LAST_BATCH)}
  AND NOT EXISTS (SELECT 1 FROM orders b
                  WHERE {ORDER_BATCH.replace('o_orderdate', 'b.o_orderdate')} = {d(W.PREVIOUS_BATCH)}
                    AND b.o_custkey = a.o_custkey)""",
    "batch_volume_diff": f"""SELECT o_custkey, batch_1_rows, batch_2_rows, batch_2_rows - batch_1_rows AS row_difference
FROM (
  SELECT o_custkey,
         CAST(sum(CASE WHEN {ORDER_BATCH} = {d(W.PREVIOUS_BATCH)} THEN 1 ELSE 0 END) AS BIGINT) AS batch_1_rows,
         CAST(sum(CASE WHEN {ORDER_BATCH} = {d(W.LAST_BATCH)} THEN 1 ELSE 0 END) AS BIGINT) AS batch_2_rows
  FROM orders WHERE {ORDER_BATCH} IN ({d(W.PREVIOUS_BATCH)}, {d(W.LAST_BATCH)})
  GROUP BY o_custkey
)""",
    "clean_missing_tokens": f"""SELECT p_partkey, {null_if_missing('p_name')} AS p_name,
       {initcap(null_if_missing('p_name'))} AS p_name_title,
       upper({null_if_missing('p_brand')}) AS p_brand,
       {initcap(null_if_missing('p_type'))} AS p_type,
       lower(trim(p_type)) AS p_type_lower
FROM part""",
    "dedupe_exact": "SELECT DISTINCT text, lang FROM documents",
    "dedupe_by_key": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
             l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST, l_discount ASC NULLS FIRST,
             l_tax ASC NULLS FIRST, l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) AS rn
  FROM lineitem
) WHERE rn = 1""",
    "required_fields": """SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
    "apply_code_mapping": f"""SELECT c.c_custkey, CAST(c.c_nationkey AS VARCHAR) AS source_code,
       coalesce(m.canonical_code, CAST(c.c_nationkey AS VARCHAR)) AS nation_code
FROM customer c LEFT JOIN (
  SELECT CAST(n_nationkey AS VARCHAR) AS source_code, upper(n_name) AS canonical_code
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> '{W.UNLISTED_REGION}'
) m ON CAST(c.c_nationkey AS VARCHAR) = m.source_code""",
    "mapping_ambiguity": """SELECT 'part' AS source_system, upper(trim(p_brand)) AS source_code, count(*) AS n_rows,
       count(DISTINCT upper(trim(p_type))) AS n_canonical
FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL
GROUP BY upper(trim(p_brand))
HAVING count(*) > 1 OR count(DISTINCT upper(trim(p_type))) > 1""",
    "record_hash": f"""SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       {sha('c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment')} AS record_hash
FROM customer""",
    "null_key_profile": f"""WITH {EV}, {HIST}
SELECT CAST(sum(CASE WHEN s.s_suppkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_supplier_keys,
       CAST(sum(CASE WHEN ev.order_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_date_keys,
       CAST(sum(CASE WHEN ev.p_type IS NULL OR ev.p_brand IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS null_part_kind_keys,
       CAST(sum(CASE WHEN h.c_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_customer_keys
FROM ev
LEFT JOIN {ACTIVE_SUPPLIER} s ON ev.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT c_custkey FROM hist WHERE is_current) h ON ev.c_custkey = h.c_custkey""",
    "orphan_keys": f"""SELECT DISTINCT l_suppkey FROM lineitem
WHERE l_suppkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {ACTIVE_SUPPLIER} s WHERE s.s_suppkey = lineitem.l_suppkey)""",
    "orphan_counts": f"""SELECT 'supplier' AS dimension, count(DISTINCT l_suppkey) AS missing_keys FROM lineitem
WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {ACTIVE_SUPPLIER} s WHERE s.s_suppkey = lineitem.l_suppkey)
UNION ALL
SELECT 'part', count(DISTINCT l_partkey) FROM lineitem
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = lineitem.l_partkey)
UNION ALL
SELECT 'orders', count(DISTINCT l_orderkey) FROM lineitem
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = lineitem.l_orderkey)
UNION ALL
SELECT 'customer', count(DISTINCT o_custkey) FROM orders
WHERE o_custkey IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = orders.o_custkey)""",
    "reference_coverage": f"""SELECT c_nationkey, count(*) AS count FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM {REGIONAL_REF} r WHERE r.n_nationkey = c.c_nationkey)
GROUP BY c_nationkey""",
    "current_version_violations": """SELECT o_custkey, current_versions FROM (
  SELECT o_custkey, CAST(sum(CAST(o_orderstatus = 'O' AS INTEGER)) AS BIGINT) AS current_versions
  FROM orders GROUP BY o_custkey
) WHERE coalesce(current_versions, 0) <> 1""",
    "multiple_current_versions": """SELECT o_custkey, count(*) AS count FROM orders
WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(*) <> 1""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "quality_gate_summary": _gate_rows(),
    "layer_reconciliation": """SELECT 'bronze' AS layer, count(*) AS rows FROM lineitem
UNION ALL SELECT 'silver', count(*) FROM (SELECT DISTINCT * FROM lineitem)
UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT * FROM lineitem)""",
    "bronze_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "pipeline_yearly_trend": """WITH src AS (
  SELECT DISTINCT c.c_custkey, c.c_name, c.c_mktsegment, l.l_linenumber, l.l_quantity, p.p_size,
         c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year, p.p_type, p.p_brand,
         """ + MEDAL + """ AS medal
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
)
SELECT year, count(*) AS participations, count(medal) AS medals,
       CAST(sum(CASE WHEN medal = 'Gold' THEN 1 ELSE 0 END) AS BIGINT) AS gold_medals,
       CAST(sum(CASE WHEN medal = 'Silver' THEN 1 ELSE 0 END) AS BIGINT) AS silver_medals,
       CAST(sum(CASE WHEN medal = 'Bronze' THEN 1 ELSE 0 END) AS BIGINT) AS bronze_medals,
       round(CAST(count(medal) AS DOUBLE) / count(*), 4) AS medal_rate
FROM src GROUP BY year""",
    "pipeline_dim_noc": """WITH n AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
)
SELECT 'N' || n_nationkey AS noc_code, n_name AS region, r_name AS notes, DATE '2026-06-20' AS valid_from,
       CASE WHEN r_name = 'EUROPE' THEN DATE '2026-06-20' ELSE DATE '9999-12-31' END AS valid_to,
       r_name <> 'EUROPE' AS is_current
FROM n
UNION ALL
SELECT 'N' || n_nationkey, n_name || ' (EU)', r_name, DATE '2026-06-21', DATE '9999-12-31', TRUE
FROM n WHERE r_name = 'EUROPE'""",
    "pipeline_incremental": """WITH src AS (
  SELECT DISTINCT c.c_custkey, c.c_name, c.c_mktsegment, l.l_linenumber, l.l_quantity, p.p_size,
         c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year, p.p_type, p.p_brand,
         """ + MEDAL + """ AS medal, o.o_totalprice < 150000 AS first
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
), later AS (SELECT DISTINCT c_custkey, year, p_brand FROM src WHERE NOT first),
stored AS (
  SELECT s.* FROM src s LEFT JOIN later n
    ON n.c_custkey = s.c_custkey AND n.year = s.year AND n.p_brand = s.p_brand
  WHERE NOT s.first OR n.c_custkey IS NULL
)
SELECT year, count(*) AS participations, count(medal) AS medals,
       CAST(sum(CASE WHEN medal = 'Gold' THEN 1 ELSE 0 END) AS BIGINT) AS gold_medals,
       CAST(sum(CASE WHEN medal = 'Silver' THEN 1 ELSE 0 END) AS BIGINT) AS silver_medals,
       CAST(sum(CASE WHEN medal = 'Bronze' THEN 1 ELSE 0 END) AS BIGINT) AS bronze_medals,
       round(CAST(count(medal) AS DOUBLE) / count(*), 4) AS medal_rate
FROM stored GROUP BY year""",
    "pipeline_null_years": """WITH """ + _SPOILT_EVENTS + """, later AS (SELECT DISTINCT c_custkey, games, p_brand FROM src WHERE NOT first),
stored AS (
  SELECT s.* FROM src s LEFT JOIN later n
    ON n.c_custkey = s.c_custkey AND n.games = s.games AND n.p_brand = s.p_brand
  WHERE NOT s.first OR n.c_custkey IS NULL
)
SELECT year, count(*) AS participations, count(medal) AS medals,
       CAST(sum(CASE WHEN medal = 'Gold' THEN 1 ELSE 0 END) AS BIGINT) AS gold_medals,
       CAST(sum(CASE WHEN medal = 'Silver' THEN 1 ELSE 0 END) AS BIGINT) AS silver_medals,
       CAST(sum(CASE WHEN medal = 'Bronze' THEN 1 ELSE 0 END) AS BIGINT) AS bronze_medals,
       round(CAST(count(medal) AS DOUBLE) / count(*), 4) AS medal_rate
FROM stored GROUP BY year""",
    "pipeline_reconciliation": """WITH """ + _SPOILT_EVENTS + """, later AS (SELECT DISTINCT c_custkey, games, p_brand FROM src WHERE NOT first),
raw AS (
  SELECT o.o_totalprice < 150000 AS first, count(*) AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
),
side AS (SELECT 2 * count(*) AS reference, count(*) FILTER (r_name = 'AFRICA') AS mapping, count(*) AS codes
  FROM nation JOIN region ON n_regionkey = r_regionkey),
facts AS (SELECT first, count(*) AS n FROM src GROUP BY 1),
kept AS (
  SELECT count(*) AS n FROM src s LEFT JOIN later x
    ON x.c_custkey = s.c_custkey AND x.games = s.games AND x.p_brand = s.p_brand
  WHERE s.first AND x.c_custkey IS NULL
)
SELECT CASE WHEN raw.first THEN DATE '2026-06-20' ELSE DATE '2026-06-21' END AS batch_date,
       CAST(raw.n + reference + mapping AS BIGINT) AS landed, CAST(0 AS BIGINT) AS set_aside,
       CAST(raw.n + reference + mapping AS BIGINT) AS "read", CAST(facts.n + codes AS BIGINT) AS silver, facts.n AS fact,
       CAST(CASE WHEN raw.first THEN facts.n ELSE facts.n + kept.n END AS BIGINT) AS stored,
       TRUE AS landed_agrees, TRUE AS fact_agrees
FROM raw JOIN facts ON raw.first = facts.first, side, kept""",
}


def picked(key: str, values: list[str], otherwise: str, every: int) -> str:
    whens = " ".join(f"WHEN {key} % {every} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {whens} ELSE {otherwise} END"


_TOKENS, _BAD = ["", "NA", "N/A", "null", "NULL", "  NA "], ["12x", "--1", "1 2"]
_SPOILT = f"""rows AS (
  SELECT CASE WHEN c_custkey % 19 <> 0 THEN c_custkey END AS k, c_name,
         {picked('c_custkey', ['', '  '], 'c_mktsegment', 23)} AS seg, c_nationkey FROM customer),
c AS (SELECT * FROM rows UNION ALL SELECT * FROM rows WHERE c_nationkey % 5 = 1)"""

SQL |= {
    "typed_cast": f"""SELECT p_partkey, TRY_CAST({null_if_missing('size')} AS INTEGER) AS p_size,
       upper({null_if_missing('brand')}) AS p_brand, {initcap(null_if_missing('kind'))} AS p_type
FROM (SELECT p_partkey, {picked('p_partkey', _TOKENS + _BAD, "' ' || p_size", 17)} AS size,
             {picked('p_partkey', _TOKENS, 'lower(p_brand)', 13)} AS brand,
             {picked('p_partkey', _TOKENS, 'upper(p_type)', 11)} AS kind FROM part) q""",
    "rejected_values": f"""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'p_size' AS column_name, size AS value, 'int' AS rule
FROM (SELECT p_partkey, {picked('p_partkey', _TOKENS + _BAD, "' ' || p_size", 17)} AS size FROM part) q
WHERE {null_if_missing('size')} IS NOT NULL AND TRY_CAST({null_if_missing('size')} AS INTEGER) IS NULL""",
    "dirty_gate_summary": f"""WITH {_SPOILT}
SELECT 'nowhere is empty' AS "check", CAST(1 AS BIGINT) AS violations
UNION ALL SELECT 'customer rows with null keys (c_custkey)', count(*) FROM c WHERE k IS NULL
UNION ALL SELECT 'customer rows with null keys (c_name, c_mktsegment)', count(*) FROM c
  WHERE c_name IS NULL OR trim(c_name) = '' OR seg IS NULL OR trim(seg) = ''
UNION ALL SELECT 'customer duplicate keys (c_custkey)', count(*) FROM (SELECT k FROM c GROUP BY k HAVING count(*) > 1)
UNION ALL SELECT 'distinct customer duplicate keys (c_custkey)', count(*)
  FROM (SELECT k FROM (SELECT DISTINCT * FROM c) GROUP BY k HAVING count(*) > 1)""",
    "clean_mapping": """SELECT 'customer' AS source_system, 'N' || n_nationkey AS source_code,
       upper(n_name) AS canonical_code, 'why' AS reason
FROM nation WHERE n_nationkey % 7 <> 0 AND n_nationkey % 5 <> 0 AND n_nationkey % 3 <> 0""",
    "corrupt_rows": """SELECT 'rejected' AS kind, CASE WHEN s_suppkey % 10 = 3 THEN CAST(s_suppkey AS VARCHAR)
       ELSE s_suppkey || ',' || s_name || ',' || s_nationkey || ',more' END AS line, CAST(1 AS BIGINT) AS rows
FROM supplier WHERE s_suppkey % 10 IN (3, 4)
UNION ALL SELECT 'read', NULL, count(*) FROM supplier WHERE s_suppkey % 10 NOT IN (3, 4)""",
    "fact_versions": f"""WITH {EV}, {HIST}
SELECT ev.line_key, h.c_custkey AS member, h.valid_from, h.record_hash
FROM ev LEFT JOIN hist h ON h.c_custkey = ev.c_custkey AND h.is_current""",
    "totals_all_versions": f"""{FACT}, m AS (SELECT c_custkey, max(c_mktsegment) AS seg FROM hist GROUP BY c_custkey)
SELECT m.seg AS c_mktsegment, count(*) AS participations, CAST(sum(gold_count) AS BIGINT) AS gold,
       CAST(sum(silver_count) AS BIGINT) AS silver, CAST(sum(bronze_count) AS BIGINT) AS bronze,
       CAST(sum(medal_count) AS BIGINT) AS total_medals,
       round(CAST(sum(medal_count) AS DOUBLE) / count(*), 4) AS medal_rate
FROM fact JOIN m ON m.c_custkey = fact.c_custkey GROUP BY m.seg""",
}

# The same rows, whether they are summed from the fact or from its kept totals.
SQL["pipeline_maintained_trend"] = SQL["pipeline_null_years"]
