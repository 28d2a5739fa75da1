"""DuckDB oracle SQL for the registered queries.

``mining_cte`` recomputes baskets, frequent itemsets (up to four items) and
rules with plain joins and GROUP BY; it is exact while no itemset of five
items is frequent (the brand-level test data has none of four at the
registered parameters).  Arrays are compared as sorted, comma-joined text.
"""

from __future__ import annotations


def mining_cte(min_support: float, min_confidence: float) -> str:
    return f"""
b0 AS (SELECT DISTINCT l_orderkey AS o, CAST(substr(p_brand, 7) AS BIGINT) AS i
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                     JOIN part ON l_partkey = p_partkey
       WHERE CAST(substr(p_brand, 7) AS BIGINT) IS NOT NULL),
b AS (SELECT o, i FROM (SELECT *, count(*) OVER (PARTITION BY o) AS n FROM b0) WHERE n >= 2),
t AS (SELECT count(DISTINCT o) AS n FROM b),
mc AS (SELECT ceil({min_support} * n) AS k FROM t),
f1 AS (SELECT i AS a, count(*) AS k FROM b GROUP BY 1 HAVING count(*) >= (SELECT k FROM mc)),
bf AS (SELECT o, i FROM b WHERE i IN (SELECT a FROM f1)),
f2 AS (SELECT x.i AS a, y.i AS b, count(*) AS k FROM bf x JOIN bf y ON x.o = y.o AND x.i < y.i
       GROUP BY 1, 2 HAVING count(*) >= (SELECT k FROM mc)),
f3 AS (SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS k
       FROM bf x JOIN bf y ON x.o = y.o AND x.i < y.i JOIN bf z ON x.o = z.o AND y.i < z.i
       GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT k FROM mc)),
f4 AS (SELECT x.i AS a, y.i AS b, z.i AS c, w.i AS d, count(*) AS k
       FROM bf x JOIN bf y ON x.o = y.o AND x.i < y.i JOIN bf z ON x.o = z.o AND y.i < z.i
                 JOIN bf w ON x.o = w.o AND z.i < w.i
       GROUP BY 1, 2, 3, 4 HAVING count(*) >= (SELECT k FROM mc)),
fi AS (SELECT a AS i1, CAST(NULL AS BIGINT) AS i2, CAST(NULL AS BIGINT) AS i3,
              CAST(NULL AS BIGINT) AS i4, k AS freq, 1 AS item_count FROM f1
       UNION ALL SELECT a, b, NULL, NULL, k, 2 FROM f2
       UNION ALL SELECT a, b, c, NULL, k, 3 FROM f3
       UNION ALL SELECT a, b, c, d, k, 4 FROM f4),
r0 AS (SELECT p.a AS a1, CAST(NULL AS BIGINT) AS a2, CAST(NULL AS BIGINT) AS a3,
              p.b AS con, p.k AS kxy, x.k AS kx
       FROM f2 p JOIN f1 x ON x.a = p.a
       UNION ALL SELECT p.b, NULL, NULL, p.a, p.k, x.k FROM f2 p JOIN f1 x ON x.a = p.b
       UNION ALL SELECT p.a, p.b, NULL, p.c, p.k, x.k
                 FROM f3 p JOIN f2 x ON x.a = p.a AND x.b = p.b
       UNION ALL SELECT p.a, p.c, NULL, p.b, p.k, x.k
                 FROM f3 p JOIN f2 x ON x.a = p.a AND x.b = p.c
       UNION ALL SELECT p.b, p.c, NULL, p.a, p.k, x.k
                 FROM f3 p JOIN f2 x ON x.a = p.b AND x.b = p.c
       UNION ALL SELECT p.a, p.b, p.c, p.d, p.k, x.k
                 FROM f4 p JOIN f3 x ON x.a = p.a AND x.b = p.b AND x.c = p.c
       UNION ALL SELECT p.a, p.b, p.d, p.c, p.k, x.k
                 FROM f4 p JOIN f3 x ON x.a = p.a AND x.b = p.b AND x.c = p.d
       UNION ALL SELECT p.a, p.c, p.d, p.b, p.k, x.k
                 FROM f4 p JOIN f3 x ON x.a = p.a AND x.b = p.c AND x.c = p.d
       UNION ALL SELECT p.b, p.c, p.d, p.a, p.k, x.k
                 FROM f4 p JOIN f3 x ON x.a = p.b AND x.b = p.c AND x.c = p.d),
ru AS (SELECT a1, a2, a3, con, CAST(kxy AS DOUBLE) / kx AS confidence,
              (CAST(kxy AS DOUBLE) / kx) / (CAST(y.k AS DOUBLE) / (SELECT n FROM t)) AS lift,
              CAST(kxy AS DOUBLE) / (SELECT n FROM t) AS support
       FROM r0 JOIN f1 y ON y.a = r0.con
       WHERE CAST(kxy AS DOUBLE) / kx >= {min_confidence}),
dim AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS name FROM part),
itemsets AS (SELECT concat_ws(',', i1, i2, i3, i4) AS items, freq, item_count, i1, i2, i3, i4
             FROM fi),
rules AS (SELECT concat_ws(',', a1, a2, a3) AS antecedent, CAST(con AS VARCHAR) AS consequent,
                 confidence, lift, support, a1, a2, a3, con FROM ru),
named AS (SELECT r.antecedent,
                 concat_ws(', ', d1.name, d2.name, d3.name) AS antecedent_product_names,
                 r.consequent, coalesce(dc.name, '') AS consequent_product_names,
                 r.confidence, r.lift, r.support, r.a1, r.a2, r.a3, r.con
          FROM rules r LEFT JOIN dim d1 ON d1.id = r.a1 LEFT JOIN dim d2 ON d2.id = r.a2
                       LEFT JOIN dim d3 ON d3.id = r.a3 LEFT JOIN dim dc ON dc.id = r.con)
"""


# Same parameters as the registered queries.
SUPPORT, CONFIDENCE = 0.005, 0.15
STRONG_LIFT, HIGH_CONFIDENCE = 1.1, 0.20
SLIDER_CONFIDENCE, SLIDER_LIFT = 0.18, 1.05
SEARCH_TEXT = "brand#1"
STREAM_FILES, FILES_PER_BATCH = 12, 3

_BASKETS = """SELECT o AS order_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items,
       CAST(count(*) AS INTEGER) AS item_count FROM b GROUP BY o"""
_DIRTY_BASKETS = """SELECT o AS order_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items,
       CAST(count(*) AS INTEGER) AS item_count
FROM (SELECT DISTINCT l_orderkey AS o, CAST(substr(p_brand, 7) AS BIGINT) AS i
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      WHERE l_partkey % 7 <> 0) GROUP BY o HAVING count(*) >= 2"""
# Messages: of every 11 orders one is cut off, of every 13 one has no items.
_SENT = """SELECT CASE WHEN o % 11 <> 0 THEN o END AS order_id,
       CASE WHEN o % 11 <> 0 AND o % 13 <> 0
            THEN string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) ELSE '' END AS items,
       CASE WHEN o % 11 <> 0 AND o % 13 <> 0 THEN CAST(count(*) AS INTEGER) END AS item_count"""
_CLEAN = "con % 5 <> 0 AND con % 7 <> 0 AND con % 9 <> 0"
_ITEMSETS = "SELECT items, freq, item_count FROM itemsets"
_RULES = "SELECT antecedent, consequent, confidence, lift, support FROM rules"
_NAMED = """SELECT antecedent, antecedent_product_names, consequent, consequent_product_names,
       confidence, lift, support FROM named"""
_VIEW = "antecedent_product_names, consequent_product_names, confidence, lift"
_FILTERED = (f"(SELECT * FROM named WHERE confidence >= {SLIDER_CONFIDENCE} "
             f"AND lift >= {SLIDER_LIFT})")
_LABEL = "antecedent_product_names || ' → ' || consequent_product_names"
_KNOWN = "(SELECT * FROM dim WHERE id % 4 <> 0)"
_NAMED_ITEMSETS = f"""(SELECT s.items,
        concat_ws(', ', coalesce(d1.name, CAST(s.i1 AS VARCHAR)),
                        coalesce(d2.name, CAST(s.i2 AS VARCHAR)),
                        coalesce(d3.name, CAST(s.i3 AS VARCHAR)),
                        coalesce(d4.name, CAST(s.i4 AS VARCHAR))) AS products,
        s.freq
 FROM itemsets s LEFT JOIN {_KNOWN} d1 ON d1.id = s.i1 LEFT JOIN {_KNOWN} d2 ON d2.id = s.i2
                 LEFT JOIN {_KNOWN} d3 ON d3.id = s.i3 LEFT JOIN {_KNOWN} d4 ON d4.id = s.i4)"""
# Java formats the shortest decimal form of a double with HALF_UP rounding;
# going through VARCHAR -> DECIMAL reproduces that in DuckDB.
_JAVA_2F = "printf('%.2f', round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2))"


def _q(body: str) -> str:
    return f"WITH {mining_cte(SUPPORT, CONFIDENCE)}\n{body}"
_KPIS = f"""SELECT count(*) AS total_rules,
       count(*) FILTER (WHERE confidence >= {SLIDER_CONFIDENCE} AND lift >= {SLIDER_LIFT}) AS filtered_rules,
       round(avg(confidence), 9) AS avg_confidence, round(avg(lift), 9) AS avg_lift,
       greatest(5.0, max(lift)) AS max_lift_bound,
       format('{{:,}}', count(*)) AS total_rules_text,
       format('{{:,}}', count(*) FILTER (WHERE confidence >= {SLIDER_CONFIDENCE} AND lift >= {SLIDER_LIFT})) AS filtered_rules_text,
       {_JAVA_2F.format(x='round(avg(confidence), 9) * 100.0')} || '%' AS avg_confidence_text,
       {_JAVA_2F.format(x='round(avg(lift), 9)')} AS avg_lift_text"""


_PRODUCTS = """SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL
            WHEN p_partkey % 4 = 0 THEN p_partkey + 3000000000 ELSE p_partkey END AS product_id,
       CASE p_partkey % 6 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN '"' || p_name || '", \\'
            WHEN 2 THEN p_name || chr(10) || p_name WHEN 3 THEN '' WHEN 4 THEN NULL
            ELSE p_name END AS product_name
FROM part"""
# Messages of more bad kinds, in the order in which they are told apart.
_KINDS = """SELECT o, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items,
       CASE WHEN o % 17 = 0 THEN 'no message' WHEN o % 19 = 0 THEN 'empty message'
            WHEN o % 23 = 0 THEN 'no order id' WHEN o % 29 = 0 THEN 'order id is not a number'
            WHEN o % 31 = 0 THEN 'items are not a list of numbers'
            WHEN o % 11 = 0 THEN 'not a JSON object' WHEN o % 13 = 0 THEN 'no items' END AS reason
FROM b GROUP BY o"""

ORACLES: dict[str, str] = {
    "order_lines_bucketed": """SELECT l_orderkey AS order_id, CAST(substr(p_brand, 7) AS BIGINT) AS product_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "baskets_bucketed": _q(_BASKETS),
    "baskets_hot_order": """WITH l AS (
    SELECT CASE WHEN l_orderkey % 3 = 0 THEN (SELECT min(l_orderkey) FROM lineitem)
                ELSE l_orderkey END AS o, l_partkey FROM lineitem)
SELECT o AS order_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items,
       CAST(count(*) AS INTEGER) AS item_count
FROM (SELECT DISTINCT o, CAST(substr(p_brand, 7) AS BIGINT) AS i
      FROM l JOIN orders ON o = o_orderkey JOIN part ON l_partkey = p_partkey)
GROUP BY o HAVING count(*) >= 2""",
    "stream_batches": _q(f"""SELECT CAST(ceil({STREAM_FILES} / {FILES_PER_BATCH}) AS BIGINT) AS batches,
       count(*) AS input_rows, count(*) AS messages,
       count(*) FILTER (WHERE o % 11 <> 0 AND o % 13 <> 0) AS valid_messages
FROM (SELECT DISTINCT o FROM b)"""),
    "stream_replayed": _q("""SELECT o AS order_id, i AS product_id FROM b
WHERE o % 11 <> 0 AND o % 13 <> 0"""),
    "stream_latest": _q("""SELECT o AS order_id, i AS product_id FROM b
WHERE o % 11 <> 0 AND o % 13 <> 0 AND o % 2 = 1"""),
    "messages_checked": _q(f"""SELECT o AS sent, reason,
       CASE reason WHEN 'empty message' THEN '  ' WHEN 'no order id' THEN '{{"items":[1,2]}}'
            WHEN 'order id is not a number' THEN '{{"order_id":"x7","items":[1,2]}}'
            WHEN 'items are not a list of numbers' THEN '{{"order_id":' || o || ',"items":5}}'
            WHEN 'not a JSON object' THEN substr('{{"order_id":' || o || ',', 1, 12)
            WHEN 'no items' THEN '{{"order_id":' || o || '}}' END AS value,
       CASE WHEN reason IS NULL THEN items END AS items
FROM ({_KINDS})"""),
    "messages_rejected": _q(f"SELECT reason, count(*) AS n FROM ({_KINDS}) GROUP BY reason"),
    "rules_rejected": _q("""SELECT antecedent, consequent,
       CASE WHEN con % 5 = 0 THEN 'n/a' ELSE NULL END AS confidence,
       CASE WHEN con % 7 = 0 THEN 'NaN' ELSE NULL END AS lift,
       CASE WHEN con % 9 = 0 THEN '' ELSE NULL END AS support,
       CASE WHEN con % 5 = 0 THEN 'confidence is not a number' WHEN con % 7 = 0 THEN 'lift is NaN'
            ELSE 'support is missing' END AS reason
FROM named WHERE con % 5 = 0 OR con % 7 = 0 OR con % 9 = 0"""),
    "product_dim_one_line": _PRODUCTS,
    "rules_named_one_line": _q(_NAMED),
    "batch_chain_resumed": _q(_NAMED),
    "rule_search_indexed": _q(f"""SELECT antecedent_product_names AS product_purchased,
       consequent_product_names AS recommended_product, confidence, lift
FROM named WHERE coalesce(regexp_matches(antecedent_product_names, '{SEARCH_TEXT}', 'i'), false)"""),
    "baskets": _q(_BASKETS),
    "clean_baskets": _DIRTY_BASKETS,
    "parquet_baskets": _q(_BASKETS),
    "csv_roundtrip": _q(_BASKETS),
    "json_parse": _q(f"{_SENT} FROM b GROUP BY o"),
    "stream_parse": _q(f"{_SENT} FROM b GROUP BY o"),
    "order_lines": """SELECT l_orderkey AS order_id, CAST(substr(p_brand, 7) AS BIGINT) AS product_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "exploded_items": _q("SELECT o AS order_id, i AS product_id FROM b"),
    "stream_items": _q("""SELECT o AS order_id, i AS product_id FROM b
WHERE o % 11 <> 0 AND o % 13 <> 0"""),
    "product_dim": _PRODUCTS,
    "part_names": """SELECT o AS order_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items,
       string_agg(n, ', ' ORDER BY i) AS names
FROM (SELECT DISTINCT l_orderkey AS o, l_partkey AS i, p_name AS n
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
GROUP BY o HAVING count(*) >= 2""",
    "freq_itemsets": _q(_ITEMSETS),
    "itemsets_flat": _q(_ITEMSETS),
    "parquet_itemsets": _q(_ITEMSETS),
    "rules": _q(_RULES),
    "rules_flat": _q(_RULES),
    "rules_named": _q(_NAMED),
    "rules_enriched": _q(f"{_NAMED} UNION ALL {_NAMED}"),
    "rules_named_csv": _q(_NAMED),
    "parquet_roundtrip": _q(_NAMED),
    "rules_for_load": _q(_NAMED),
    "serving_table": _q(f"""SELECT *, CAST(row_number() OVER (
    ORDER BY lift DESC, antecedent, consequent) AS BIGINT) AS position FROM ({_NAMED})"""),
    "rules_clean": _q(f"{_NAMED} WHERE {_CLEAN}"),
    "batch_chain": _q(_NAMED),
    "names_by_array": _q("""SELECT 'antecedent' AS side, antecedent AS ids, antecedent_product_names AS names
FROM (SELECT DISTINCT antecedent, antecedent_product_names FROM named)
UNION ALL
SELECT 'consequent', consequent, consequent_product_names
FROM (SELECT DISTINCT consequent, consequent_product_names FROM named)"""),
    "itemsets_named": _q(f"SELECT items, products, freq FROM {_NAMED_ITEMSETS}"),
    "stage_counts": _q("""SELECT 'orders' AS stage, count(*) AS "rows" FROM orders
UNION ALL SELECT 'order_lines', count(*) FROM lineitem
UNION ALL SELECT 'baskets', (SELECT n FROM t)
UNION ALL SELECT 'itemsets', count(*) FROM itemsets
UNION ALL SELECT 'rules', count(*) FROM rules"""),
    "split_ids": _q("""SELECT antecedent, consequent,
       CAST(len(string_split(antecedent, ',')) AS INTEGER) AS n_antecedent,
       a1 AS first_antecedent, coalesce(a3, a2, a1) AS last_antecedent, con AS consequent_id
FROM rules"""),
    "basket_json": _q("""SELECT o AS order_id,
       '{"order_id":' || o || ',"items":[' || string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) || ']}' AS value
FROM b GROUP BY o"""),
    "topic_peek": _q(f"{_SENT} FROM b GROUP BY o ORDER BY o LIMIT 10"),
    "top_rules": _q(f"""SELECT antecedent_product_names, consequent_product_names,
       round(confidence, 4) AS confidence, round(lift, 4) AS lift, round(support, 4) AS support
FROM named ORDER BY lift DESC, confidence DESC, antecedent, consequent LIMIT 30"""),
    "top_confidence": _q(f"SELECT {_VIEW} FROM named ORDER BY confidence DESC, antecedent, consequent LIMIT 10"),
    "top_lift": _q(f"SELECT {_VIEW} FROM named ORDER BY lift DESC, antecedent, consequent LIMIT 10"),
    "strong_rules": _q(f"""SELECT {_VIEW} FROM named WHERE lift > {STRONG_LIFT}
ORDER BY lift DESC, antecedent, consequent LIMIT 50"""),
    "high_confidence": _q(f"""SELECT {_VIEW} FROM named WHERE confidence > {HIGH_CONFIDENCE}
ORDER BY confidence DESC, antecedent, consequent LIMIT 50"""),
    "top_recommendations": _q("""SELECT consequent_product_names, count(*) AS "count" FROM named
GROUP BY 1 ORDER BY "count" DESC, consequent_product_names LIMIT 20"""),
    "rule_summary": _q(f"""SELECT count(*) AS total_rules,
       count(*) FILTER (WHERE lift > {STRONG_LIFT}) AS strong_rules,
       count(*) FILTER (WHERE confidence > {HIGH_CONFIDENCE}) AS high_confidence_rules
FROM named"""),
    "preview": _q("SELECT items, freq, item_count FROM itemsets ORDER BY freq DESC, items LIMIT 20"),
    "preview_rules": _q(f"{_RULES} ORDER BY lift DESC, antecedent, consequent LIMIT 20"),
    "rule_kpis": _q(f"{_KPIS} FROM named"),
    "dashboard_clean_kpis": _q(f"{_KPIS} FROM (SELECT * FROM named WHERE {_CLEAN})"),
    "kpis_of_no_rules": _q(f"{_KPIS} FROM (SELECT * FROM named WHERE confidence >= 2)"),
    "dashboard_clean_top": _q(f"""SELECT antecedent_product_names AS product_a,
       consequent_product_names AS product_b, confidence, lift
FROM {_FILTERED} WHERE {_CLEAN} ORDER BY lift DESC, antecedent, consequent LIMIT 20"""),
    "dashboard_kpis": _q("""SELECT (SELECT n FROM t) AS transactions, (SELECT count(*) FROM itemsets) AS itemsets,
       count(*) AS rules, round(avg(confidence), 3) AS avg_confidence,
       round(avg(lift), 3) AS avg_lift, round(avg(support), 3) AS avg_support
FROM rules"""),
    "rules_filtered": _q(f"""SELECT antecedent, antecedent_product_names, consequent, consequent_product_names,
       confidence, lift, support FROM {_FILTERED}"""),
    "top_rules_filtered": _q(f"""SELECT antecedent_product_names AS product_a, consequent_product_names AS product_b,
       confidence, lift FROM {_FILTERED} ORDER BY lift DESC, antecedent, consequent LIMIT 20"""),
    "chart_lift": _q(f"""SELECT {_LABEL} AS rule, confidence, lift FROM {_FILTERED}
ORDER BY lift DESC, antecedent, consequent LIMIT 15"""),
    "chart_confidence": _q(f"""SELECT {_LABEL} AS rule, confidence, lift FROM {_FILTERED}
ORDER BY confidence DESC, antecedent, consequent LIMIT 15"""),
    "chart_scatter": _q(f"SELECT {_LABEL} AS rule, confidence, lift, support FROM {_FILTERED}"),
    "dashboard_rules": _q(f"""SELECT r.antecedent, r.consequent,
       concat_ws(', ', coalesce(d1.name, CAST(r.a1 AS VARCHAR)), coalesce(d2.name, CAST(r.a2 AS VARCHAR)),
                       coalesce(d3.name, CAST(r.a3 AS VARCHAR)))
         || ' ➜ ' || coalesce(dc.name, CAST(r.con AS VARCHAR)) AS rule,
       r.confidence, r.lift, r.support
FROM rules r LEFT JOIN {_KNOWN} d1 ON d1.id = r.a1 LEFT JOIN {_KNOWN} d2 ON d2.id = r.a2
             LEFT JOIN {_KNOWN} d3 ON d3.id = r.a3 LEFT JOIN {_KNOWN} dc ON dc.id = r.con"""),
    "all_rules": _q(f"""SELECT antecedent_product_names AS product_a, consequent_product_names AS product_b,
       confidence, lift FROM {_FILTERED}"""),
    "rule_search": _q(f"""SELECT CAST(row_number() OVER (
    ORDER BY lift DESC, confidence DESC, antecedent, consequent) AS BIGINT) AS position,
       antecedent_product_names AS product_purchased,
       consequent_product_names AS recommended_product, confidence, lift
FROM named WHERE coalesce(regexp_matches(antecedent_product_names, '{SEARCH_TEXT}', 'i'), false)"""),
    "rule_display": _q(f"""SELECT antecedent, consequent, antecedent_product_names AS product_purchased,
       consequent_product_names AS recommended_product,
       {_JAVA_2F.format(x='confidence * 100.0')} || '%' AS confidence_text,
       {_JAVA_2F.format(x='lift')} AS lift_text
FROM named"""),
    "rules_by_lift": _q("""SELECT CAST(row_number() OVER (
    ORDER BY lift DESC, antecedent, consequent) AS BIGINT) AS position, antecedent_product_names AS antecedent_names,
       consequent_product_names AS consequent_names, confidence, lift, support FROM named"""),
    "itemsets_by_freq": _q(f"""SELECT CAST(row_number() OVER (ORDER BY freq DESC, items) AS BIGINT)
    AS position, items, products, freq FROM {_NAMED_ITEMSETS}"""),
    "top_itemsets": _q(f"SELECT items, products, freq FROM {_NAMED_ITEMSETS} ORDER BY freq DESC, items LIMIT 20"),
}
