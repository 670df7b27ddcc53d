"""Oracle SQL (DuckDB dialect) for the registered queries, computed from the flat tables.

Each statement derives the expected answer directly from the driver tables, without the JSON
round trip, so it checks the packing, the parse, the casts and the relational operators at once.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# lineitem -> one row per (line, product) with the values the JSON pages carry
PRICING_LINES = """
pl AS (
  SELECT
    'run-' || CAST(year(l_shipdate) AS VARCHAR) AS run_id,
    'prov-' || CAST(l_suppkey AS VARCHAR) AS provider_id,
    'Brand ' || CAST(l_suppkey AS VARCHAR) AS brand_name,
    date_trunc('year', l_shipdate) + to_microseconds(l_orderkey) AS fetched_at,
    CAST(date_trunc('year', l_shipdate) AS DATE) AS as_of_date,
    'banking:get-products' AS endpoint,
    'https://prov-' || CAST(l_suppkey AS VARCHAR) || '.example.com/cds-au/v1/banking/products?page='
      || CAST(l_orderkey AS VARCHAR) AS url,
    3 AS responded_xv,
    CAST(l_partkey AS VARCHAR) AS product_id,
    'Product ' || CAST(l_partkey AS VARCHAR) AS product_name,
    CAST(NULL AS VARCHAR) AS product_description,
    CASE l_returnflag WHEN 'A' THEN 'TRANS_AND_SAVINGS_ACCOUNTS' WHEN 'N' THEN 'TERM_DEPOSITS'
         ELSE 'RESIDENTIAL_MORTGAGES' END AS product_category,
    l_shipdate - INTERVAL 10 HOUR AS product_last_updated,
    CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS effective_from,
    CAST(NULL AS TIMESTAMP) AS effective_to,
    'Brand ' || CAST(l_suppkey AS VARCHAR) AS product_brand,
    CAST(NULL AS VARCHAR) AS product_brand_group,
    l_quantity > 25 AS is_tailored,
    l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus,
    CASE WHEN l_tax = 0 THEN '' ELSE printf('%.2f', l_tax) END AS fee_amount_text,
    CASE WHEN l_returnflag <> 'R' THEN 'deposit' ELSE 'lending' END AS rate_kind,
    CASE WHEN l_linestatus = 'F' THEN 'FIXED' ELSE 'VARIABLE' END AS rate_type,
    CAST(printf('%.2f', l_discount) AS DECIMAL(28,10)) AS rate_value,
    'P1M' AS application_frequency,
    'P' || CAST(l_linenumber AS VARCHAR) || 'M' AS additional_value,
    CASE WHEN l_quantity >= 25 THEN 'Tier ' || CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) END AS tier_name,
    CASE WHEN l_quantity >= 25 THEN 'DOLLAR' END AS tier_unit_of_measure,
    CASE WHEN l_quantity >= 25 THEN CAST(floor(l_quantity / 10) * 10 AS DECIMAL(28,10)) END AS tier_minimum_value,
    CASE WHEN l_quantity >= 25 THEN CAST(floor(l_quantity / 10) * 10 + 9.99 AS DECIMAL(28,10)) END AS tier_maximum_value
  FROM lineitem
)"""

# position of each line inside its page (pages group one supplier's lines of one order and year)
PRICING_PAGES = PRICING_LINES + """,
pp AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY provider_id, l_orderkey, as_of_date ORDER BY l_linenumber, l_partkey, l_shipdate, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1
                 AS INTEGER) AS product_pos
  FROM pl
)"""

ORACLE["stg_products"] = "WITH " + PRICING_PAGES + """
SELECT run_id, provider_id, brand_name, fetched_at, as_of_date, endpoint, url, responded_xv,
       product_id, product_name, product_description, product_category, product_last_updated,
       effective_from, effective_to, product_brand, product_brand_group, is_tailored,
       l_orderkey AS page_num, product_pos
FROM pp"""

FEE_JSON = """json_object('amount', fee_amount_text, 'currency', 'AUD', 'feeType', 'PERIODIC',
                   'name', 'Account fee')::VARCHAR"""

STG_FEES = """
SELECT provider_id, brand_name, as_of_date, product_id, product_name, product_category,
       'Account fee' AS fee_name, 'PERIODIC' AS fee_type, CAST(NULL AS VARCHAR) AS additional_info,
       CAST(NULL AS VARCHAR) AS additional_info_uri,
       CASE WHEN fee_amount_text = '' THEN NULL ELSE CAST(fee_amount_text AS DECIMAL(28,10)) END AS amount,
       'AUD' AS currency, """ + FEE_JSON + """ AS fee_json
FROM pl"""

ORACLE["stg_fees"] = "WITH " + PRICING_LINES + STG_FEES

ORACLE["fct_product_fees"] = "WITH " + PRICING_LINES + ", f AS (" + STG_FEES + """)
SELECT provider_id, brand_name, as_of_date, product_id, fee_name, fee_type, amount, currency,
       additional_info, additional_info_uri, fee_json FROM f"""

ORACLE["stg_rates"] = "WITH " + PRICING_LINES + """
SELECT provider_id, brand_name, as_of_date, product_id, product_name, product_category,
       rate_kind, rate_type, rate_value, CAST(NULL AS DECIMAL(28,10)) AS comparison_rate,
       CAST(NULL AS VARCHAR) AS calculation_frequency, application_frequency, additional_value,
       CAST(NULL AS VARCHAR) AS additional_info, CAST(NULL AS VARCHAR) AS additional_info_uri
FROM pl"""

STG_TIERS = """
SELECT provider_id, brand_name, as_of_date, product_id, product_name, product_category,
       rate_kind, rate_type, rate_value, CAST(NULL AS DECIMAL(28,10)) AS comparison_rate,
       CAST(NULL AS VARCHAR) AS calculation_frequency, application_frequency, additional_value,
       CAST(NULL AS VARCHAR) AS additional_info, CAST(NULL AS VARCHAR) AS additional_info_uri,
       tier_name, tier_unit_of_measure, tier_minimum_value, tier_maximum_value,
       CAST(NULL AS VARCHAR) AS tier_rate_application_method, CAST(NULL AS VARCHAR) AS tier_applicability,
       CAST(NULL AS VARCHAR) AS tier_additional_info, CAST(NULL AS VARCHAR) AS tier_additional_info_uri,
       CAST(NULL AS VARCHAR) AS conditions_json
FROM pl"""

ORACLE["stg_rate_tiers"] = "WITH " + PRICING_LINES + STG_TIERS

RATE_FACT = """
SELECT provider_id, brand_name, as_of_date, product_id, product_name, product_category, rate_kind,
       rate_type, tier_name, tier_unit_of_measure, tier_minimum_value, tier_maximum_value,
       rate_value AS rate, comparison_rate, calculation_frequency, application_frequency,
       additional_value, additional_info, additional_info_uri, conditions_json
FROM (""" + STG_TIERS + ") t"

ORACLE["fct_product_rates"] = "WITH " + PRICING_LINES + RATE_FACT

ORACLE["dim_products"] = "WITH " + PRICING_PAGES + """
SELECT provider_id, brand_name, as_of_date, product_id, product_name, product_description,
       product_category, product_last_updated, effective_from, effective_to, product_brand,
       product_brand_group, is_tailored
FROM pp
QUALIFY row_number() OVER (PARTITION BY provider_id, product_id, as_of_date
                           ORDER BY fetched_at DESC, url, product_pos) = 1"""


def snapshot_diff_sql(src: str, entity: str, date: str, strict: list[str], sentinel: dict[str, str],
                      value: str, carry: list[str], names: dict[str, str], where_current: str = "") -> str:
    """Snapshot diff of repeated keys in plain SQL: values held by both snapshots cancel, the rest is
    ranked on each side and joined by rank."""
    part = [entity, *strict, *[f"_n_{k}" for k in sentinel]]
    pick_order = ", ".join(f"{c} ASC NULLS LAST" for c in carry + list(sentinel))
    on = " AND ".join([f"c.{entity} = p.{entity}", f"c.{date} = p._next", f"c._prev = p.{date}"]
                      + [f"c.{k} = p.{k}" for k in strict] + [f"c._n_{k} = p._n_{k}" for k in sentinel])
    held = f"{on} AND c.{value} IS NOT DISTINCT FROM p.{value}"
    rank = f"row_number() OVER (PARTITION BY {', '.join(part)}, {date} ORDER BY {value} ASC NULLS LAST) AS _rank"
    out_cols = [f"coalesce(c.{entity}, p.{entity}) AS {entity}"]
    out_cols += [f"coalesce(c.{k}, p.{k}) AS {k}" for k in strict + list(sentinel) + carry]
    out_cols += [f"coalesce(c._prev, p.{date}) AS {names['pd']}", f"coalesce(c.{date}, p._next) AS {names['cd']}",
                 f"p.{value} AS {names['pv']}", f"c.{value} AS {names['cv']}"]
    return f"""
src AS ({src}),
d0 AS (SELECT DISTINCT {entity}, {date} FROM src),
d AS (SELECT {entity}, {date}, lag({date}) OVER w AS _prev, lead({date}) OVER w AS _next
      FROM d0 WINDOW w AS (PARTITION BY {entity} ORDER BY {date})),
f AS (SELECT src.*, d._prev, d._next, {", ".join(f"coalesce(src.{k}, {s}) AS _n_{k}" for k, s in sentinel.items()) or "1 AS _dummy"}
      FROM src JOIN d USING ({entity}, {date})),
r AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(part)}, {date}, {value}
                                ORDER BY {pick_order or value}) AS _rn
      FROM f),
u AS (SELECT * FROM r WHERE _rn = 1),
c0 AS (SELECT *, {rank} FROM u c WHERE _prev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM u p WHERE {held})),
p0 AS (SELECT *, {rank} FROM u p WHERE _next IS NOT NULL AND NOT EXISTS (SELECT 1 FROM u c WHERE {held})),
j AS (SELECT {", ".join(out_cols)} FROM c0 c FULL OUTER JOIN p0 p ON {on} AND c._rank = p._rank)
SELECT * FROM j WHERE {names['pv']} IS DISTINCT FROM {names['cv']} {where_current}"""


RATE_CHANGE_NAMES = {"pd": "previous_as_of_date", "cd": "current_as_of_date", "pv": "previous_rate", "cv": "current_rate"}
RATE_CHANGE_SELECT = """provider_id, brand_name, product_id, product_name, product_category, rate_kind,
       rate_type, tier_name, tier_unit_of_measure, tier_minimum_value, tier_maximum_value,
       previous_as_of_date, current_as_of_date, previous_rate, current_rate"""


def _rate_changes_sql(where_current: str = "") -> str:
    return "WITH " + PRICING_LINES + "," + snapshot_diff_sql(
        RATE_FACT, "provider_id", "as_of_date", ["product_id", "rate_kind", "rate_type"],
        {"tier_name": "''", "tier_unit_of_measure": "''", "tier_minimum_value": "-1", "tier_maximum_value": "-1"},
        "rate", ["brand_name", "product_name", "product_category"], RATE_CHANGE_NAMES, where_current)


ORACLE["rate_changes"] = "SELECT " + RATE_CHANGE_SELECT + " FROM (" + _rate_changes_sql() + ") x"
ORACLE["rate_changes_as_of"] = ("SELECT " + RATE_CHANGE_SELECT + " FROM (" + _rate_changes_sql() +
                                ") x WHERE current_as_of_date = DATE '1998-01-01'")
ORACLE["rate_change_report"] = """
SELECT provider_id, brand_name, product_id, product_name, product_category, rate_kind, rate_type,
       tier_name, previous_as_of_date, current_as_of_date, previous_rate, current_rate,
       current_rate - previous_rate AS delta
FROM (""" + _rate_changes_sql() + """) x
WHERE current_as_of_date = DATE '1998-01-01'
ORDER BY abs(current_rate - previous_rate) DESC NULLS LAST, provider_id, product_id, rate_kind, rate_type,
         tier_name NULLS LAST, tier_unit_of_measure NULLS LAST, tier_minimum_value NULLS LAST,
         tier_maximum_value NULLS LAST, previous_rate NULLS LAST, current_rate NULLS LAST
LIMIT 200"""

# the mart's own rule, written plainly: a full outer join of neighbouring snapshots on unique keys
ORACLE["rate_changes_keyed"] = "WITH " + PRICING_LINES + """,
f AS (SELECT provider_id, as_of_date, product_id, rate_kind, rate_type, coalesce(tier_name, '') AS tn,
             coalesce(tier_minimum_value, -1) AS tmin, max(brand_name) AS brand_name, max(rate) AS rate
      FROM (""" + RATE_FACT + """) r GROUP BY ALL),
d AS (SELECT provider_id, as_of_date, lag(as_of_date) OVER w AS prev, lead(as_of_date) OVER w AS next
      FROM (SELECT DISTINCT provider_id, as_of_date FROM f) WINDOW w AS (PARTITION BY provider_id ORDER BY as_of_date)),
cur AS (SELECT f.*, d.prev FROM f JOIN d USING (provider_id, as_of_date) WHERE d.prev IS NOT NULL),
prv AS (SELECT f.*, d.next FROM f JOIN d USING (provider_id, as_of_date) WHERE d.next IS NOT NULL)
SELECT coalesce(c.provider_id, p.provider_id) AS provider_id, coalesce(c.brand_name, p.brand_name) AS brand_name,
       coalesce(c.product_id, p.product_id) AS product_id, coalesce(c.rate_kind, p.rate_kind) AS rate_kind,
       coalesce(c.rate_type, p.rate_type) AS rate_type, coalesce(c.tn, p.tn) AS tier_name,
       coalesce(c.tmin, p.tmin) AS tier_minimum_value, coalesce(c.prev, p.as_of_date) AS previous_as_of_date,
       coalesce(c.as_of_date, p.next) AS current_as_of_date, p.rate AS previous_rate, c.rate AS current_rate
FROM cur c FULL OUTER JOIN prv p
  ON c.provider_id = p.provider_id AND c.prev = p.as_of_date AND c.product_id = p.product_id
 AND c.rate_kind = p.rate_kind AND c.rate_type = p.rate_type AND c.tn = p.tn AND c.tmin = p.tmin
WHERE c.rate IS DISTINCT FROM p.rate"""

ORACLE["rate_changes_flat"] = "WITH " + snapshot_diff_sql(
    """SELECT l_suppkey, l_partkey, l_linestatus, CAST(date_trunc('year', l_shipdate) AS DATE) AS as_of,
              CAST(l_discount AS DECIMAL(12,2)) AS discount FROM lineitem""",
    "l_suppkey", "as_of", ["l_partkey", "l_linestatus"], {}, "discount", [],
    {"pd": "previous_as_of", "cd": "current_as_of", "pv": "previous_discount", "cv": "current_discount"})


# ---- events domain --------------------------------------------------------------------------

EVENT_FETCH = """
ev AS (SELECT *, CAST(ts AS DATE) AS d, json_extract_string(props, '$.k') AS k,
              CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'purchase' THEN 200
                              WHEN 'signup' THEN 304 WHEN 'error' THEN 500 END AS st
       FROM events),
evp AS (SELECT *,
          CASE WHEN st = 200 THEN CASE event_type
            WHEN 'view' THEN '{"data":{"products":[{"productId":"v' || k || '"}]},"links":{"next":""}}'
            WHEN 'click' THEN '{"data":{"products":[{"productId":"a' || k || '"},{"productId":"b' || k
                 || '"},{"productId":"c' || k || '"},{"productId":"d' || k || '","extra":1}]},"links":{"next":""},"meta":{"k":'
                 || k || '}}'
            WHEN 'purchase' THEN '{"data":{"products":[{"productId":"p' || k
                 || '","fees":[{"amount":"1.00"}]}]},"links":{"next":""}}' END END AS payload
        FROM ev),
fetches AS (
  SELECT 'run-' || strftime(d, '%Y-%m-%d') AS run_id,
         'user-' || CAST(user_id AS VARCHAR) AS provider_id,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'User ' || CAST(user_id AS VARCHAR) END AS brand_name,
         CASE WHEN event_type = 'signup' THEN 'banking:get-product-detail' ELSE 'banking:get-products' END AS endpoint,
         'https://api.user-' || CAST(user_id AS VARCHAR) || '.example.com/cds/banking/products?page='
           || CAST(event_id AS VARCHAR) AS url,
         event_id AS page_num, st AS http_status, 3 AS responded_xv, ts AS fetched_at,
         CAST(NULL AS VARCHAR) AS etag, payload,
         CASE WHEN length(b) > 0 THEN sha256(b) END AS payload_hash,
         CASE WHEN st = 200 THEN NULL ELSE coalesce(nullif(substr(b, 1, 500), ''), 'HTTP ' || CAST(st AS VARCHAR)) END AS error,
         event_type, value, user_id, d
  FROM (SELECT *, CASE WHEN st = 200 THEN payload WHEN st = 500 THEN props END AS b FROM evp) x
),
pages AS (SELECT * FROM fetches WHERE endpoint = 'banking:get-products'),
runs AS (SELECT 'run-' || strftime(d, '%Y-%m-%d') AS run_id, min(ts) AS run_started_at, d AS run_date
         FROM ev GROUP BY d),
edim AS (SELECT provider_id, brand_name, CAST(fetched_at AS DATE) AS as_of_date, event_type AS product_id
         FROM pages WHERE http_status = 200
         QUALIFY row_number() OVER (PARTITION BY provider_id, event_type, CAST(fetched_at AS DATE)
                                    ORDER BY fetched_at DESC, page_num DESC) = 1)"""

COVERAGE = EVENT_FETCH + """,
brands AS (
  SELECT r.run_id, r.run_started_at, r.run_date, 'user-' || CAST(u.user_id AS VARCHAR) AS provider_id,
         CASE WHEN u.user_id % 10 = 0 THEN NULL ELSE 'User ' || CAST(u.user_id AS VARCHAR) END AS brand_name,
         coalesce(CASE WHEN u.user_id % 3 = 0 THEN NULL
                       ELSE 'https://api.user-' || CAST(u.user_id AS VARCHAR) || '.example.com/cds' END,
                  'https://user-' || CAST(u.user_id AS VARCHAR) || '.example.com') AS expected_base_uri
  FROM (SELECT d AS run_date, user_id FROM ev UNION SELECT d + 1, user_id FROM ev) u
  JOIN runs r USING (run_date)),
lb AS (SELECT run_date AS as_of_date, provider_id, brand_name, expected_base_uri FROM brands
       QUALIFY row_number() OVER (PARTITION BY run_date, provider_id ORDER BY run_started_at DESC, run_id) = 1),
calls AS (SELECT CAST(fetched_at AS DATE) AS as_of_date, provider_id, http_status AS call_status, error AS last_error
          FROM fetches WHERE endpoint = 'banking:get-products'
          QUALIFY row_number() OVER (PARTITION BY CAST(fetched_at AS DATE), provider_id
                                     ORDER BY fetched_at DESC, url, run_id) = 1),
pstats AS (SELECT CAST(fetched_at AS DATE) AS as_of_date, provider_id,
                  count(*) FILTER (WHERE http_status = 200) AS pages_ok, max(http_status) AS page_status
           FROM pages GROUP BY 1, 2),
nrows AS (SELECT as_of_date, provider_id, count(*) AS n_rows FROM edim GROUP BY 1, 2),
cov AS (
  SELECT lb.as_of_date, lb.provider_id, brand_name, expected_base_uri,
         CAST(coalesce(pages_ok, 0) AS BIGINT) AS products_pages_ok,
         CAST(coalesce(n_rows, 0) AS BIGINT) AS products_rows,
         coalesce(call_status, page_status) AS last_http_status, last_error
  FROM lb LEFT JOIN pstats USING (as_of_date, provider_id) LEFT JOIN nrows USING (as_of_date, provider_id)
          LEFT JOIN calls USING (as_of_date, provider_id))"""

ORACLE["provider_coverage"] = "WITH " + COVERAGE + " SELECT * FROM cov"
ORACLE["coverage_report"] = "WITH " + COVERAGE + " SELECT * FROM cov WHERE as_of_date = DATE '2024-01-15'"
ORACLE["coverage_summary"] = "WITH " + COVERAGE + """
SELECT count(*) AS providers_discovered,
       count(*) FILTER (WHERE coalesce(products_pages_ok, 0) > 0 AND coalesce(last_http_status, 0) IN (200, 304))
         AS providers_ok
FROM cov WHERE as_of_date = DATE '2024-01-15'"""

ORACLE["dim_latest"] = """
SELECT user_id, CAST(ts AS DATE) AS as_of_date, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""

FINGERPRINTS = EVENT_FETCH + """,
fp0 AS (
  SELECT provider_id, endpoint, fetched_at AS observed_at, run_id, page_num,
         CASE event_type
           WHEN 'view' THEN ['data', 'data.products', 'data.products[]', 'data.products[].productId',
                             'links', 'links.next']
           WHEN 'click' THEN ['data', 'data.products', 'data.products[]', 'data.products[].extra',
                              'data.products[].productId', 'links', 'links.next', 'meta', 'meta.k']
           WHEN 'purchase' THEN ['data', 'data.products', 'data.products[]', 'data.products[].fees',
                                 'data.products[].fees[]', 'data.products[].fees[].amount', 'data.products[].productId',
                                 'links', 'links.next']
         END AS paths
  FROM pages WHERE http_status = 200 AND payload IS NOT NULL),
fp AS (SELECT *, sha256(array_to_string(paths, chr(10))) AS fingerprint_hash FROM fp0),
de AS (SELECT *, lag(fingerprint_hash) OVER (PARTITION BY provider_id, endpoint ORDER BY observed_at, page_num) AS old
       FROM fp),
drift AS (SELECT provider_id, endpoint, old AS old_fingerprint_hash, fingerprint_hash AS new_fingerprint_hash,
                 observed_at, run_id, 'Schema/path fingerprint changed' AS note
          FROM de WHERE old IS NOT NULL AND old <> fingerprint_hash)"""

ORACLE["fingerprints"] = "WITH " + FINGERPRINTS + """
SELECT provider_id, endpoint, fingerprint_hash, array_to_string(paths, '|') AS fingerprint_path_list,
       observed_at, run_id, page_num FROM fp"""
ORACLE["fingerprints_limited"] = "WITH " + FINGERPRINTS + """,
few AS (SELECT *, list_filter(paths, lambda x: x NOT IN ('data.products[].extra', 'data.products[].fees[].amount')) AS upper FROM fp0)
SELECT provider_id, endpoint, sha256(array_to_string(upper, chr(10))) AS fingerprint_hash,
       array_to_string(upper, '|') AS fingerprint_path_list, observed_at, run_id, page_num FROM few"""
ORACLE["drift_events"] = "WITH " + FINGERPRINTS + " SELECT * FROM drift"
ORACLE["drift_report"] = "WITH " + FINGERPRINTS + """
SELECT provider_id, endpoint, old_fingerprint_hash, new_fingerprint_hash, observed_at FROM drift
WHERE CAST(observed_at AS DATE) = DATE '2024-01-15'
ORDER BY observed_at DESC, provider_id, endpoint, new_fingerprint_hash LIMIT 50"""

EVENT_RATE_FACT = """
SELECT provider_id, brand_name, CAST(fetched_at AS DATE) AS as_of_date, event_type AS product_id,
       event_type AS product_name, CAST(NULL AS VARCHAR) AS product_category, 'deposit' AS rate_kind,
       'FIXED' AS rate_type, CAST(NULL AS VARCHAR) AS tier_name, CAST(NULL AS VARCHAR) AS tier_unit_of_measure,
       CAST(NULL AS DECIMAL(28,10)) AS tier_minimum_value, CAST(NULL AS DECIMAL(28,10)) AS tier_maximum_value,
       CAST(value AS DECIMAL(28,10)) AS rate
FROM pages WHERE http_status = 200"""


def _fmt(x: str) -> str:
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


ORACLE["qa_gates"] = "WITH " + COVERAGE + """,
fp0 AS (SELECT 1),
rc AS (SELECT * FROM (WITH """ + snapshot_diff_sql(
    EVENT_RATE_FACT, "provider_id", "as_of_date", ["product_id", "rate_kind", "rate_type"],
    {"tier_name": "''", "tier_unit_of_measure": "''", "tier_minimum_value": "-1", "tier_maximum_value": "-1"},
    "rate", ["brand_name", "product_name", "product_category"], RATE_CHANGE_NAMES) + """) z),
m AS (
  SELECT
    (SELECT count(*) FROM cov WHERE as_of_date = DATE '2024-01-15' AND coalesce(products_pages_ok, 0) > 0
        AND coalesce(last_http_status, 0) IN (200, 304)) AS providers_ok,
    (SELECT count(*) FROM edim WHERE as_of_date = DATE '2024-01-15') AS dim_rows,
    (SELECT count(*) FROM rc WHERE current_as_of_date = DATE '2024-01-15') AS rc_rows,
    (SELECT (epoch_us(TIMESTAMP '2024-01-16 00:00:00') - epoch_us(max(fetched_at))) / 3.6e9 FROM pages
       WHERE CAST(fetched_at AS DATE) = DATE '2024-01-15') AS fresh,
    (SELECT count(*) FROM (WITH """ + FINGERPRINTS.replace(EVENT_FETCH + ",", "") + """ SELECT * FROM drift) q
       WHERE CAST(observed_at AS DATE) = DATE '2024-01-15') AS drift_n,
    (SELECT count(*) FROM (SELECT provider_id, product_id, as_of_date FROM edim GROUP BY ALL HAVING count(*) > 1) a)
    + (SELECT count(*) FROM edim WHERE provider_id IS NULL OR product_id IS NULL OR as_of_date IS NULL)
    + (SELECT count(*) FROM (SELECT as_of_date, provider_id FROM cov GROUP BY ALL HAVING count(*) > 1) b) AS failing
)
SELECT 'providers_ok' AS gate_name, providers_ok >= 1 AS passed, CAST(providers_ok AS DOUBLE) AS actual_value,
       1.0::DOUBLE AS threshold_value,
       """ + _fmt("providers_ok") + """ || CASE WHEN providers_ok >= 1 THEN ' >= ' ELSE ' < ' END || '1.0' AS details FROM m
UNION ALL
SELECT 'dim_products_rows', dim_rows >= 1, CAST(dim_rows AS DOUBLE), 1.0,
       """ + _fmt("dim_rows") + """ || CASE WHEN dim_rows >= 1 THEN ' >= ' ELSE ' < ' END || '1.0' FROM m
UNION ALL
SELECT 'rate_changes_rows', rc_rows >= 1, CAST(rc_rows AS DOUBLE), 1.0,
       """ + _fmt("rc_rows") + """ || CASE WHEN rc_rows >= 1 THEN ' >= ' ELSE ' < ' END || '1.0' FROM m
UNION ALL
SELECT 'products_freshness_hours', coalesce(fresh <= 36.0, false), fresh, 36.0,
       CASE WHEN fresh IS NULL THEN 'missing metric value; expected <= 36.0h'
            ELSE """ + _fmt("fresh") + """ || 'h' || CASE WHEN fresh <= 36.0 THEN ' <= ' ELSE ' > ' END || '36.0h' END FROM m
UNION ALL
SELECT 'schema_drift_events', true, CAST(drift_n AS DOUBLE), CAST(NULL AS DOUBLE),
       'observed=' || """ + _fmt("drift_n") + """ || '; fail gate disabled' FROM m
UNION ALL
SELECT 'dbt_tests', failing = 0, CASE WHEN failing = 0 THEN 1.0 ELSE 0.0 END, 1.0,
       'failing rows=' || CAST(failing AS VARCHAR) FROM m"""

ORACLE["qa_verdict"] = "WITH g AS (" + ORACLE["qa_gates"] + """)
SELECT CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN bool_and(passed) THEN 0 ELSE 1 END AS exit_code,
       count(*) FILTER (WHERE NOT passed) AS failed_gates FROM g"""

ORACLE["unique_combo"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["not_null"] = """
SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_rows FROM orders
UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders"""

ORACLE["accepted_values"] = """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')"""

ORACLE["fk_orphans"] = "WITH " + EVENT_FETCH + """
SELECT 'api_call_log' AS child, url AS child_key FROM fetches f
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.run_id = f.run_id)
UNION ALL
SELECT 'orders', CAST(o_orderkey AS VARCHAR) FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)"""

ORACLE["source_freshness"] = "WITH " + EVENT_FETCH + """,
s AS (SELECT 'products_raw' AS source, max(fetched_at) AS max_loaded_at FROM pages
      UNION ALL
      SELECT 'product_detail_raw', max(fetched_at) FROM fetches WHERE endpoint = 'banking:get-product-detail')
SELECT source, max_loaded_at,
       (epoch_us(TIMESTAMP '2024-02-03 00:00:00') - epoch_us(max_loaded_at)) / 3.6e9 AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-02-03 00:00:00') - epoch_us(max_loaded_at)) / 3.6e9 > 168 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-02-03 00:00:00') - epoch_us(max_loaded_at)) / 3.6e9 > 48 THEN 'warn'
            ELSE 'pass' END AS status
FROM s"""

ORACLE["insert_ignore"] = """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts,
       arg_min(value, (ts, event_id)) AS value, arg_min(props, (ts, event_id)) AS props
FROM events GROUP BY user_id, event_type"""

ORACLE["upsert_all"] = """
SELECT user_id, event_type, event_id, ts, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["upsert_partial"] = """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(value, (ts, event_id)) AS value, arg_min(props, (ts, event_id)) AS props
FROM events GROUP BY user_id, event_type"""

ORACLE["atomic_groups"] = "WITH " + EVENT_FETCH + """
SELECT provider_id, CAST(fetched_at AS DATE) AS as_of_date, url, http_status FROM fetches f
WHERE NOT EXISTS (SELECT 1 FROM fetches g WHERE g.provider_id = f.provider_id
                  AND CAST(g.fetched_at AS DATE) = CAST(f.fetched_at AS DATE) AND g.http_status >= 500)"""


# ---- collection bookkeeping -----------------------------------------------------------------

REGISTER_BRANDS = """
rb AS (
  SELECT 'run-register' AS run_id,
         CASE WHEN c_acctbal < -900 THEN '' ELSE 'cust-' || CAST(c_custkey AS VARCHAR) END AS data_holder_brand_id,
         c_name AS brand_name, CAST(NULL AS VARCHAR) AS brand_group,
         CASE WHEN c_acctbal >= 0 THEN to_json(['Banking', lower(c_mktsegment)])::VARCHAR
              ELSE to_json([lower(c_mktsegment)])::VARCHAR END AS industries,
         'https://cust-' || CAST(c_custkey AS VARCHAR) || '.example.com' AS public_base_uri,
         CASE WHEN c_acctbal > 5000 THEN 'https://api.cust-' || CAST(c_custkey AS VARCHAR) || '.example.com/cds/'
              ELSE '' END AS product_base_uri,
         CAST(NULL AS VARCHAR) AS logo_uri, CAST(NULL AS VARCHAR) AS last_updated,
         c_acctbal >= 0 AS in_industry, c_acctbal < -900 AS missing_id
  FROM customer)"""

ORACLE["discover_providers"] = "WITH " + REGISTER_BRANDS + """
SELECT run_id, data_holder_brand_id, brand_name, brand_group, industries, public_base_uri, product_base_uri,
       logo_uri, last_updated
FROM rb WHERE in_industry AND NOT missing_id"""

ORACLE["discovery_counts"] = "WITH " + REGISTER_BRANDS + """
SELECT run_id, count(*) AS discovered, count(*) FILTER (WHERE NOT missing_id) AS kept,
       count(*) FILTER (WHERE missing_id) AS skipped_missing_id
FROM rb WHERE in_industry GROUP BY run_id"""

ORACLE["first_page_requests"] = "WITH " + REGISTER_BRANDS + """
SELECT run_id, data_holder_brand_id AS provider_id, brand_name, 'banking:get-products' AS endpoint,
       rtrim(coalesce(nullif(product_base_uri, ''), nullif(public_base_uri, '')), '/') || '/'
         || 'cds-au/v1/banking/products' AS url, 1 AS page_num
FROM rb WHERE in_industry AND NOT missing_id
  AND coalesce(nullif(product_base_uri, ''), nullif(public_base_uri, '')) IS NOT NULL"""

ORACLE["detail_requests"] = "WITH " + PRICING_LINES + """
SELECT DISTINCT provider_id, product_id, 'banking:get-product-detail' AS endpoint,
       'https://prov-' || substr(provider_id, 6) || '.example.com/cds-au/v1/banking/products/' || product_id AS url
FROM pl JOIN supplier ON 'prov-' || CAST(s_suppkey AS VARCHAR) = provider_id"""

ORACLE["version_choice"] = """
WITH a AS (
  SELECT 'https://api.user-' || CAST(user_id AS VARCHAR) || '.example.com/cds/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS url,
         event_id AS attempt, CAST(event_id % 3 + 1 AS INTEGER) AS xv,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 406 ELSE 200 END AS st,
         CASE WHEN event_type = 'click' THEN CAST(CAST(event_id % 3 + 1 AS INTEGER) AS VARCHAR)
              WHEN event_type = 'view' THEN 'v3' END AS hdr
  FROM events),
g AS (
  SELECT url, count(*) AS attempts,
         min(attempt) FILTER (WHERE st IS NOT NULL AND st <> 406) AS ok_attempt,
         max(attempt) FILTER (WHERE st = 406) AS na_attempt,
         arg_min(xv, attempt) AS preferred
  FROM a GROUP BY url)
SELECT g.url, attempts, coalesce(ok_attempt, na_attempt) AS chosen_attempt, c.st AS http_status,
       CASE WHEN c.attempt IS NOT NULL THEN coalesce(TRY_CAST(c.hdr AS INTEGER),
            CASE WHEN ok_attempt IS NOT NULL THEN c.xv ELSE preferred END) END AS responded_xv,
       CASE WHEN ok_attempt IS NOT NULL THEN 'ok' WHEN na_attempt IS NOT NULL THEN 'not_acceptable' ELSE 'failed' END AS outcome
FROM g LEFT JOIN a c ON c.url = g.url AND c.attempt = coalesce(ok_attempt, na_attempt)"""

ORACLE["call_log"] = "WITH " + EVENT_FETCH + """
SELECT run_id, provider_id, endpoint, url, http_status, responded_xv, fetched_at, etag, payload_hash, error FROM fetches"""

ORACLE["run_totals"] = "WITH " + PRICING_LINES + """
SELECT run_id, provider_id, CAST(count(*) AS BIGINT) AS products_listed,
       count(DISTINCT (l_orderkey, as_of_date)) AS pages
FROM pl GROUP BY run_id, provider_id"""

# ---- scalar functions -------------------------------------------------------------------------

ORACLE["text_functions"] = """
WITH d AS (SELECT *, CASE WHEN length(text) <= 4000 THEN text ELSE substr(text, 1, 3997) || '...' END AS clipped
           FROM documents)
SELECT doc_id, CASE WHEN length(text) > 0 THEN sha256(text) END AS text_sha256,
       length(clipped) AS clipped_length, sha256(clipped) AS clipped_sha256,
       printf('%04d', doc_id) AS page_label,
       sha256(regexp_replace(source || ':' || lang || '/' || text, '[^\\p{L}\\p{N}\\-_.]', '_', 'g')) AS safe_name_sha256,
       sha256(coalesce(nullif(substr(text, 1, 500), ''), 'HTTP 500')) AS error_sha256,
       'HTTP 404' AS error_empty
FROM d"""

ORACLE["url_functions"] = """
WITH p AS (SELECT *, regexp_extract(html, 'href="([^"]*)"', 1) AS href,
                  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) AS origin FROM pages)
SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}\\-_.]', '_', 'g') AS safe_url,
       CASE WHEN href = '' THEN '' ELSE origin || href END AS next_url,
       origin || '/cds/banking/products' AS products_url,
       '/banking/products/' || CAST(page_id AS VARCHAR) AS detail_path
FROM p"""

ORACLE["safe_casts"] = """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE l_linenumber WHEN 1 THEN printf('%.2f', l_extendedprice)
                           WHEN 2 THEN '+' || CAST(l_linenumber AS VARCHAR)
                           WHEN 3 THEN CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || '%'
                           WHEN 4 THEN ' ' || CAST(l_linenumber AS VARCHAR)
                           WHEN 5 THEN '-' || printf('%.2f', l_discount)
                           WHEN 6 THEN CAST(l_linenumber AS VARCHAR) || 'e-3'
                           ELSE '' END AS num_text,
         ['true', 'T', 'on', 'off', 'yes', '0', '', 'maybe', 'OF', ' No '][CAST(l_partkey % 10 + 1 AS INTEGER)] AS bool_text,
         CASE l_suppkey % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+11:00'
                            WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
                            WHEN 2 THEN '' ELSE 'garbage' END AS ts_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       num_text, CASE WHEN regexp_full_match(num_text, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST(num_text AS DECIMAL(28,10)) END AS num_value,
       bool_text,
       CASE WHEN lower(trim(bool_text)) IN ('t', 'tr', 'tru', 'true', 'y', 'ye', 'yes', 'on', '1') THEN true
            WHEN lower(trim(bool_text)) IN ('f', 'fa', 'fal', 'fals', 'false', 'n', 'no', 'of', 'off', '0') THEN false
       END AS bool_value,
       ts_text, CAST(TRY_CAST(nullif(ts_text, '') AS TIMESTAMPTZ) AS TIMESTAMP) AS ts_value
FROM x"""

ORACLE["json_extract"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CASE WHEN regexp_full_match(json_extract_string(props, '$.k'), '-?[0-9]+(\\.[0-9]+)?')
            THEN TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(28,10)) END AS k_value,
       json_extract_string(props, '$.missing') AS missing_text
FROM events"""


ORACLE["page_chain_capped"] = """
WITH RECURSIVE
l AS (
  SELECT 'blk-' || CAST(event_id // 300 AS VARCHAR) AS provider_id,
         'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
           || CAST(event_id AS VARCHAR) AS url,
         CASE WHEN event_type = 'error' AND value > 250 THEN NULL
              WHEN event_type = 'signup' AND value > 250 THEN NULL
              WHEN event_type = 'purchase' AND value > 250
                THEN 'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
                     || CAST((event_id // 300) * 300 AS VARCHAR)
              WHEN (event_id + 1) // 300 <> event_id // 300 THEN NULL
              ELSE 'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
                   || CAST(event_id + 1 AS VARCHAR) END AS nxt
  FROM events),
s AS (SELECT 'blk-' || CAST(event_id // 300 AS VARCHAR) AS provider_id,
             'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
               || CAST(min(event_id) AS VARCHAR) AS url
      FROM events GROUP BY event_id // 300),
walk(provider_id, p, url, seen, rep) AS (
  SELECT provider_id, 0, url, [url], false FROM s
  UNION ALL
  SELECT w.provider_id, w.p + 1, l.nxt, list_append(w.seen, l.nxt), list_contains(w.seen, l.nxt)
  FROM walk w JOIN l ON l.provider_id = w.provider_id AND l.url = w.url
  WHERE NOT w.rep AND w.p < 200 AND l.nxt IS NOT NULL)
SELECT provider_id, p + 1 AS page_num, url, 'page' AS kind, CAST(NULL AS INTEGER) AS http_status,
       CAST(NULL AS VARCHAR) AS error
FROM walk WHERE p < 200 AND NOT rep
UNION ALL
SELECT provider_id, p + 1, url, 'audit', 0,
       CASE WHEN p = 200 THEN 'Pagination limit exceeded (200)' ELSE 'Pagination loop detected from links.next' END
FROM walk WHERE p = 200 OR rep"""

ORACLE["page_chain"] = """
WITH RECURSIVE
l AS (
  SELECT 'blk-' || CAST(event_id // 300 AS VARCHAR) AS provider_id,
         'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
           || CAST(event_id AS VARCHAR) AS url,
         CASE WHEN event_type = 'error' AND value > 250 THEN NULL
              WHEN event_type = 'signup' AND value > 250 THEN NULL
              WHEN event_type = 'purchase' AND value > 250
                THEN 'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
                     || CAST((event_id // 300) * 300 AS VARCHAR)
              WHEN (event_id + 1) // 300 <> event_id // 300 THEN NULL
              ELSE 'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
                   || CAST(event_id + 1 AS VARCHAR) END AS nxt
  FROM events),
s AS (SELECT 'blk-' || CAST(event_id // 300 AS VARCHAR) AS provider_id,
             'https://blk-' || CAST(event_id // 300 AS VARCHAR) || '.example.com/cds/banking/products?page='
               || CAST(min(event_id) AS VARCHAR) AS url
      FROM events GROUP BY event_id // 300),
walk(provider_id, p, url, seen, rep) AS (
  SELECT provider_id, 0, url, [url], false FROM s
  UNION ALL
  SELECT w.provider_id, w.p + 1, l.nxt, list_append(w.seen, l.nxt), list_contains(w.seen, l.nxt)
  FROM walk w JOIN l ON l.provider_id = w.provider_id AND l.url = w.url
  WHERE NOT w.rep AND l.nxt IS NOT NULL),
runs AS (SELECT unnest(['run-1', 'run-2']) AS run_id)
SELECT run_id, provider_id, p + 1 AS page_num, url, CASE WHEN rep THEN 'audit' ELSE 'page' END AS kind,
       CASE WHEN rep THEN 0 END AS http_status,
       CASE WHEN rep THEN 'Pagination loop detected from links.next' END AS error
FROM walk CROSS JOIN runs"""


ORACLE["rate_change_markdown"] = """
SELECT '| ' || concat_ws(' | ', coalesce(brand_name, 'None'), coalesce(nullif(product_name, ''), product_id),
                         coalesce(product_category, ''),
                         coalesce(rate_kind, 'None') || '/' || coalesce(rate_type, 'None'), coalesce(tier_name, ''),
                         coalesce(CASE WHEN previous_rate = 0 THEN '0' ELSE rtrim(rtrim(CAST(previous_rate AS VARCHAR), '0'), '.') END, 'None'), coalesce(CASE WHEN current_rate = 0 THEN '0' ELSE rtrim(rtrim(CAST(current_rate AS VARCHAR), '0'), '.') END, 'None'),
                         coalesce(CASE WHEN delta = 0 THEN '0' ELSE rtrim(rtrim(CAST(delta AS VARCHAR), '0'), '.') END, 'None')) || ' |' AS line
FROM (""" + ORACLE["rate_change_report"] + """) r
ORDER BY abs(delta) DESC NULLS LAST, provider_id, product_id, rate_kind, rate_type,
         tier_name NULLS LAST, previous_rate NULLS LAST, current_rate NULLS LAST
LIMIT 20"""


DETAILS = """
details AS (
  SELECT 'run-' || strftime(d, '%Y-%m-%d') AS run_id, 'user-' || CAST(user_id AS VARCHAR) AS provider_id,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'User ' || CAST(user_id AS VARCHAR) END AS brand_name,
         'prod-' || CAST(event_id % 7 AS VARCHAR) AS product_id, 'banking:get-product-detail' AS endpoint,
         'https://api.user-' || CAST(user_id AS VARCHAR) || '.example.com/cds/banking/products/prod-' || CAST(event_id % 7 AS VARCHAR)
           || '?try=' || CAST(event_id AS VARCHAR) AS url,
         CASE event_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 500 ELSE 304 END AS http_status, 3 AS responded_xv, ts AS fetched_at,
         CAST(NULL AS VARCHAR) AS etag,
         CASE WHEN event_id % 3 = 0 THEN '{"data":{"productId":"prod-' || CAST(event_id % 7 AS VARCHAR) || '"'
              || CASE WHEN event_id % 2 = 0 THEN ',"fees":[{"amount":"1.00"}]' ELSE '' END || '}}' END AS payload,
         event_id AS fetch_id, d
  FROM ev WHERE event_type = 'signup')"""

ALL_TABLES = FINGERPRINTS + "," + DETAILS + """,
runs_full AS (SELECT *, 'banking' AS register_industry, 'banking' AS filter_industry,
                     false AS fetch_product_details FROM runs),
brands_full AS (
  SELECT r.run_id, 'user-' || CAST(u.user_id AS VARCHAR) AS data_holder_brand_id, r.run_started_at AS extracted_at
  FROM (SELECT d AS run_date, user_id FROM ev UNION SELECT d + 1, user_id FROM ev) u JOIN runs r USING (run_date)),
prints_full AS (SELECT *, paths AS fingerprint_paths FROM fp)
"""
TABLE_SOURCES = {"products_raw": "pages", "api_call_log": "fetches", "pipeline_run": "runs_full", "data_holder_brand": "brands_full",
                 "product_detail_raw": "details", "schema_fingerprint": "prints_full", "schema_drift_event": "drift"}


def _table_checks_sql() -> str:
    from ratewatch.schemas import TABLES
    parts = []
    for name, t in TABLES.items():
        key, src = ", ".join(t.key), TABLE_SOURCES.get(name)
        # the gate results are made by the run itself: keys and declared columns are never missing
        count = f"SELECT count(*) FROM (SELECT {key} FROM {src} GROUP BY {key} HAVING count(*) > 1) q" if src else "SELECT 0::BIGINT"
        parts.append(f"SELECT '{name}' AS table_name, 'unique' AS \"check\", '{','.join(t.key)}' AS column_or_key, ({count}) AS failing_rows")
        for c in t.not_null:
            count = f"SELECT count(*) FROM {src} WHERE {c} IS NULL" if src else "SELECT 0::BIGINT"
            parts.append(f"SELECT '{name}', 'not_null', '{c}', ({count})")
    return "WITH " + ALL_TABLES + "\nUNION ALL\n".join(parts)


def _run_fk_sql() -> str:
    from ratewatch.schemas import TABLES
    union = " UNION ALL ".join(f"SELECT '{n}' AS table_name, run_id FROM {src}" for n, src in TABLE_SOURCES.items() if TABLES[n].run_fk)
    return "WITH " + ALL_TABLES + f""",
known AS (SELECT run_id FROM runs WHERE run_date NOT IN (DATE '2024-01-15', DATE '2024-01-17')),
child AS ({union})
SELECT table_name, count(*) AS child_rows, count(*) FILTER (run_id NOT IN (SELECT run_id FROM known)) AS orphan_rows,
       count(DISTINCT run_id) FILTER (run_id NOT IN (SELECT run_id FROM known)) AS orphan_keys
FROM child GROUP BY table_name"""


ORACLE["run_fk_checks"] = _run_fk_sql()
ORACLE["table_checks"] = _table_checks_sql()

LANDED = EVENT_FETCH + """,
bodies AS (
  SELECT event_id, user_id, d, ts,
         sha256(CASE event_type WHEN 'error' THEN '{"k":' || k ELSE payload END || CASE WHEN event_id % 7 = 0 THEN chr(10) ELSE '' END) AS h,
         event_type <> 'error' AS parsed,
         'https://api.user-' || CAST(user_id AS VARCHAR) || '.example.com/cds/banking/products?page=' || CAST(event_id AS VARCHAR) AS url
  FROM evp WHERE event_type <> 'signup'),
last_call AS (SELECT user_id, d, h, max(ts) AS ts, arg_max(url, (ts, url)) AS url FROM bodies GROUP BY ALL),
landed AS (
  SELECT 'run-' || strftime(b.d, '%Y-%m-%d') AS run_id, 'user-' || CAST(b.user_id AS VARCHAR) AS provider_id,
         'banking:get-products' AS endpoint, c.url, b.event_id AS page_num, 200 AS http_status, c.ts AS fetched_at,
         b.h AS payload_hash, b.parsed
  FROM bodies b JOIN last_call c USING (user_id, d, h))"""
ORACLE["landed_pages"] = "WITH " + LANDED + " SELECT * FROM landed"
ORACLE["landed_files"] = "WITH " + LANDED + """
SELECT CAST(d AS VARCHAR) AS ingestion_date, 'user-' || CAST(user_id AS VARCHAR) AS provider, 'banking_get-products' AS endpoint,
       event_id AS page_num, h AS content_sha256 FROM bodies"""
ORACLE["parse_error_calls"] = "WITH " + LANDED + """
SELECT run_id, provider_id, endpoint, url, http_status, 3 AS responded_xv, fetched_at, payload_hash, 'JSON parse error' AS error
FROM landed WHERE NOT parsed"""

ORACLE["qa_gates_strict"] = ORACLE["qa_gates"].split("SELECT 'providers_ok' AS gate_name")[0] + """
SELECT 'providers_ok' AS gate_name, false AS passed, CAST(NULL AS DOUBLE) AS actual_value, 1.0::DOUBLE AS threshold_value,
       'missing relation: expected mart_provider_coverage' AS details
UNION ALL SELECT 'dim_products_rows', dim_rows >= 1000000000, CAST(dim_rows AS DOUBLE), 1e9,
       """ + _fmt("dim_rows") + """ || ' < 1000000000.0' FROM m
UNION ALL SELECT 'rate_changes_rows', false, NULL, 1.0, 'missing relation: expected mart_rate_changes'
UNION ALL SELECT 'products_freshness_hours', coalesce(fresh <= 0.0, false), fresh, 0.0,
       """ + _fmt("fresh") + """ || 'h > 0.0h' FROM m
UNION ALL SELECT 'schema_drift_events', drift_n <= 0, CAST(drift_n AS DOUBLE), 0.0, """ + _fmt("drift_n") + """ || ' > 0.0' FROM m
UNION ALL SELECT 'dbt_tests', true, 1.0, 1.0, 'skipped'"""

ORACLE["qa_gates_by_name"] = (
    ORACLE["qa_gates"].split("SELECT 'rate_changes_rows'")[0]
    + "SELECT 'rate_changes_rows', false, NULL, 1.0, 'missing relation: expected gold_mart_rate_changes or public_gold_mart_rate_changes'\nUNION ALL\n"
    + "SELECT 'products_freshness_hours'" + ORACLE["qa_gates"].split("SELECT 'products_freshness_hours'")[1].split("SELECT 'dbt_tests'")[0]
    + "SELECT 'dbt_tests', true, 1.0, 1.0, 'skipped'")


def _declared_tests_sql() -> str:
    from ratewatch.plans.qa import DECLARED_TESTS
    src = {"dim_products": "dim_products", "fct_product_rates": "fct_product_rates", "mart_rate_changes": "rate_changes",
           "mart_provider_coverage": "provider_coverage"}
    parts = []
    for model, test, cols in DECLARED_TESTS:
        if test == "unique_combo":
            key = ", ".join(cols)
            parts.append((model, test, ",".join(cols), f"SELECT count(*) FROM (SELECT {key} FROM {model} GROUP BY {key} HAVING count(*) > 1) q"))
        elif test == "not_null":
            parts += [(model, test, c, f"SELECT count(*) FROM {model} WHERE {c} IS NULL") for c in cols]
        else:
            values = ", ".join(f"'{v}'" for v in cols[1:])
            parts.append((model, test, cols[0], f"SELECT count(*) FROM {model} WHERE {cols[0]} NOT IN ({values})"))
    return ("WITH " + ",\n".join(f"{m} AS ({ORACLE[q]})" for m, q in src.items()) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, '{t}' AS test, '{c}' AS columns, ({sql}) AS failing_rows" for m, t, c, sql in parts))


ORACLE["declared_tests"] = _declared_tests_sql()

# ---- stored tables ------------------------------------------------------------------------------

ORACLE["provider_publish"] = "WITH " + EVENT_FETCH + """,
a1 AS (SELECT run_id, provider_id, page_num, http_status, 1 AS attempt FROM pages WHERE d <= DATE '2024-01-15'),
a2 AS (SELECT run_id, provider_id, page_num, http_status, 2 AS attempt, event_type FROM pages
       WHERE d >= DATE '2024-01-13' AND event_type <> 'click'),
bad1 AS (SELECT DISTINCT run_id, provider_id FROM a1 WHERE http_status >= 500),
bad2 AS (SELECT DISTINCT run_id, provider_id FROM a2 WHERE http_status >= 500 OR (page_num % 5 = 0 AND event_type = 'purchase')),
good2 AS (SELECT DISTINCT run_id, provider_id FROM a2 WHERE (run_id, provider_id) NOT IN (SELECT (run_id, provider_id) FROM bad2))
SELECT run_id, provider_id, page_num, http_status, attempt FROM a1
WHERE (run_id, provider_id) NOT IN (SELECT (run_id, provider_id) FROM bad1)
  AND (run_id, provider_id) NOT IN (SELECT (run_id, provider_id) FROM good2)
UNION ALL
SELECT run_id, provider_id, page_num, http_status, attempt FROM a2 WHERE (run_id, provider_id) IN (SELECT (run_id, provider_id) FROM good2)"""


def _merge_sql(source: str, key: list[str], run_and_key: str, columns: list[str]) -> str:
    own = [c for c in columns if c not in (*key, "brand_name", "url")]
    return f"""
src AS ({run_and_key}),
oldest AS (SELECT {", ".join(key)}, brand_name, url FROM src
           QUALIFY row_number() OVER (PARTITION BY {", ".join(key)} ORDER BY fetched_at, fetch_id) = 1),
newest AS (SELECT {", ".join(key + own)} FROM src
           QUALIFY row_number() OVER (PARTITION BY {", ".join(key)} ORDER BY fetched_at DESC, fetch_id DESC) = 1)
SELECT {", ".join(columns)} FROM oldest JOIN newest USING ({", ".join(key)})"""


ORACLE["merge_products_raw"] = "WITH " + EVENT_FETCH + "," + _merge_sql(
    "pages", ["run_id", "provider_id", "endpoint", "page_num"],
    "SELECT * EXCLUDE (run_id, page_num), 'run-' || strftime(fetched_at, '%Y-%m') AS run_id, page_num AS fetch_id, page_num % 4 AS page_num FROM pages",
    ["run_id", "provider_id", "brand_name", "endpoint", "url", "page_num", "http_status", "responded_xv", "fetched_at", "etag", "payload",
     "payload_hash"])
ORACLE["merge_details"] = "WITH " + EVENT_FETCH + "," + DETAILS + "," + _merge_sql(
    "details", ["run_id", "provider_id", "product_id"],
    "SELECT * EXCLUDE (run_id), 'run-' || strftime(fetched_at, '%Y-%m') AS run_id, sha256(payload) AS payload_hash FROM details",
    ["run_id", "provider_id", "brand_name", "product_id", "url", "http_status", "responded_xv", "fetched_at", "etag", "payload", "payload_hash"])

ORACLE["rejects"] = "WITH " + EVENT_FETCH + """,
p AS (SELECT run_id, provider_id, endpoint, page_num AS fetch_id, page_num % 2 AS page_num,
             CASE WHEN page_num % 11 <> 0 THEN url END AS url, fetched_at FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY run_id, provider_id, endpoint, page_num, url IS NULL ORDER BY fetched_at, fetch_id) AS nth FROM p)
SELECT run_id, provider_id, endpoint, page_num, url, fetched_at, CASE WHEN url IS NULL THEN 'not_null:url' ELSE 'unique' END AS reject_reason
FROM r WHERE url IS NULL OR nth > 1"""

ORACLE["detail_retry"] = "WITH " + EVENT_FETCH + "," + DETAILS + """
SELECT run_id, provider_id, product_id, count(*) AS attempts, arg_max(http_status, (fetched_at, http_status)) AS last_status
FROM details GROUP BY run_id, provider_id, product_id HAVING count(*) FILTER (http_status = 200) = 0"""

ORACLE["run_totals_details"] = "WITH " + EVENT_FETCH + "," + DETAILS + """,
t AS (SELECT run_id, provider_id, sum(CASE WHEN http_status <> 200 THEN 0 WHEN event_type = 'click' THEN 4 ELSE 1 END)::BIGINT AS products_listed,
             count(*) AS pages FROM pages GROUP BY ALL),
o AS (SELECT run_id, provider_id, count(*) FILTER (http_status = 200) AS details_ok FROM details GROUP BY ALL)
SELECT run_id, provider_id, coalesce(products_listed, 0) AS products_listed, coalesce(pages, 0) AS pages, coalesce(details_ok, 0) AS details_ok
FROM t FULL JOIN o USING (run_id, provider_id)"""

ORACLE["endpoint_drift"] = "WITH " + FINGERPRINTS + "," + DETAILS + """,
dp AS (SELECT provider_id, endpoint, fetched_at AS observed_at, run_id, fetch_id,
              sha256(array_to_string(CASE WHEN fetch_id % 2 = 0
                THEN ['data', 'data.fees', 'data.fees[]', 'data.fees[].amount', 'data.productId'] ELSE ['data', 'data.productId'] END, chr(10))) AS h
       FROM details WHERE http_status = 200),
dd AS (SELECT *, lag(h) OVER (PARTITION BY provider_id, endpoint ORDER BY observed_at, fetch_id) AS old FROM dp)
SELECT * FROM drift
UNION ALL
SELECT provider_id, endpoint, old, h, observed_at, run_id, 'Schema/path fingerprint changed' FROM dd WHERE old IS NOT NULL AND old <> h"""

# ---- stored builds, appends and reports: what is stored equals what one pass over everything gives -----------

ORACLE["drift_events_stored"] = ORACLE["endpoint_drift"]
ORACLE["drift_state"] = ORACLE["endpoint_drift"].split("SELECT * FROM drift\n")[0] + """,
seen AS (SELECT provider_id, endpoint, fingerprint_hash, observed_at, page_num FROM fp
         UNION ALL SELECT provider_id, endpoint, h, observed_at, fetch_id FROM dp)
SELECT provider_id, endpoint, fingerprint_hash, observed_at FROM seen
QUALIFY row_number() OVER (PARTITION BY provider_id, endpoint ORDER BY observed_at DESC, page_num DESC) = 1"""
ORACLE["rate_changes_late"] = ORACLE["rate_changes"]
ORACLE["call_log_stored"] = ORACLE["call_log"]
ORACLE["qa_stored"] = "WITH g AS (" + ORACLE["qa_gates"] + """)
SELECT 'qa-1' AS qa_run_id, DATE '2024-01-15' AS qa_date, g.*, true AS dbt_test_ran,
       (SELECT bool_and(passed) FROM g WHERE gate_name = 'dbt_tests') AS dbt_test_passed, 'declared tests' AS dbt_test_command FROM g"""
ORACLE["qa_summary_stored"] = "WITH g AS (" + ORACLE["qa_gates"] + """),
word AS (SELECT CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS run,
                CASE WHEN bool_and(passed) FILTER (gate_name = 'dbt_tests') THEN 'PASS' ELSE 'FAIL' END AS tests FROM g)
SELECT unnest(['# QA summary - 2024-01-15', '', '- Status: **' || run || '**', '- QA run id: `qa-1`',
               '- dbt tests: **' || tests || '** (`declared tests`)', '', '| Gate | Passed | Actual | Threshold | Details |',
               '|---|---|---:|---:|---|']) AS line FROM word
UNION ALL
SELECT '| ' || gate_name || ' | ' || CASE WHEN passed THEN 'yes' ELSE 'no' END || ' | ' || coalesce(CAST(actual_value AS VARCHAR), '') || ' | '
       || coalesce(CAST(threshold_value AS VARCHAR), '') || ' | ' || details || ' |' FROM g"""
ORACLE["rate_change_csv"] = ORACLE["rate_change_report"]
ORACLE["provider_limit"] = ORACLE["discover_providers"] + """
ORDER BY brand_name, data_holder_brand_id LIMIT 25"""
