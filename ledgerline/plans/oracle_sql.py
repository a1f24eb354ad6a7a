"""DuckDB SQL twins of the registered queries (independent re-statement).

Each query is written from the rules, not from the Spark plan: keep-latest
uses ``row_number()``, the orphan test ``NOT IN``, the merge a full outer
join with ``CASE``. The shared tables are pre-registered views.
"""

from __future__ import annotations

from ledgerline.plans.derived import RUN_UUID
from ledgerline.schemas import CURRENCY_MAP, FACT_FINANCIALS
from ledgerline.sources.fixtures import FX_CURRENCIES, REVENUE_CURRENCIES

UUID2 = "00000000-0000-4000-8000-000000000005"
UUID_FX2 = "00000000-0000-4000-8000-000000000006"


def _list(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _currency_case(x: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CURRENCY_MAP.items())
    return f"CASE {x} {whens} END"


NUM_RE = r"(?i)[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|[+-]?inf(inity)?"


def int_key(x: str) -> str:
    t = f"trim({x})"
    d = f"TRY_CAST({t} AS DOUBLE)"
    return (f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN CAST(TRY_CAST({t} AS BIGINT) AS VARCHAR) "
            f"WHEN regexp_full_match({t}, '{NUM_RE}') AND NOT isinf({d}) AND {d} = floor({d}) "
            f"THEN CAST(TRY_CAST({d} AS BIGINT) AS VARCHAR) END")


def to_double(x: str) -> str:
    t = f"trim({x})"
    d = f"TRY_CAST({t} AS DOUBLE)"
    return f"CASE WHEN regexp_full_match({t}, '{NUM_RE}') AND NOT isnan({d}) THEN {d} END"


CTES = f"""
company_raw AS (
  SELECT CASE WHEN c_custkey%97=0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS company_id,
         '  '||c_name||' ' AS name, c_mktsegment AS industry, n_name AS country,
         TIMESTAMP '2024-01-02' AS created_at, c_custkey*2 AS row_ord
  FROM customer JOIN nation ON c_nationkey=n_nationkey
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name||' OLD', c_mktsegment, n_name, TIMESTAMP '2024-01-01', c_custkey*2+1
  FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE c_custkey%40=0 AND c_custkey%97<>0),
company_norm AS (
  SELECT {int_key('company_id')} AS company_id, trim(name) AS name, trim(industry) AS industry,
         trim(country) AS country, created_at, row_ord FROM company_raw),
company_ruled AS (
  SELECT *, CASE WHEN company_id IS NULL THEN 'NULL_COMPANY_ID' END AS rule_reason FROM company_norm),
company_cls AS (
  SELECT company_id, name, industry, country, created_at, row_ord, rule_reason,
         COALESCE(rule_reason, CASE WHEN row_number() OVER (
             PARTITION BY company_id, rule_reason IS NULL
             ORDER BY created_at DESC NULLS LAST, row_ord) > 1
           THEN 'SUPERSEDED_BY_CORRECTION' END) AS quarantine_reason
  FROM company_ruled),
dim_ids AS (SELECT company_id FROM company_cls WHERE quarantine_reason IS NULL),
dim1 AS (
  SELECT company_id, name, industry, country, '{RUN_UUID["company"]}' AS pipeline_load_uuid
  FROM company_cls WHERE quarantine_reason IS NULL),
revenue_raw AS (
  SELECT CASE WHEN o_orderkey%211=0 THEN NULL
              WHEN o_orderkey%101=0 THEN CAST(o_custkey+1000000 AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS company_id,
         strftime(o_orderdate,'%Y-%m') AS month,
         CASE WHEN o_orderkey%103=0 THEN NULL WHEN o_orderkey%107=0 THEN -o_totalprice ELSE o_totalprice END AS revenue,
         CASE WHEN o_orderkey%109=0 THEN 'XXX'
              ELSE ({_list(REVENUE_CURRENCIES)})[1+o_orderkey%10] END AS currency,
         o_orderdate AS updated_at, o_orderkey AS row_ord
  FROM orders),
revenue_norm AS (
  SELECT {int_key('company_id')} AS company_id, trim(month) AS month, revenue,
         upper(trim(currency)) AS currency_text, {_currency_case('upper(trim(currency))')} AS currency_code,
         updated_at, row_ord FROM revenue_raw),
revenue_ruled AS (
  SELECT *, CASE WHEN company_id IS NULL OR company_id NOT IN (SELECT company_id FROM dim_ids) THEN 'ORPHAN_COMPANY_ID'
                 WHEN currency_code IS NULL THEN 'MALFORMED_CURRENCY'
                 WHEN revenue IS NULL THEN 'NULL_REVENUE'
                 WHEN revenue < 0 THEN 'NEGATIVE_REVENUE'
                 WHEN month IS NULL OR month = '' THEN 'INVALID_MONTH' END AS rule_reason
  FROM revenue_norm),
revenue_cls AS (
  SELECT company_id, month, revenue,
         CASE WHEN rule_reason IS NULL THEN currency_code ELSE currency_text END AS currency,
         updated_at, row_ord, rule_reason,
         COALESCE(rule_reason, CASE WHEN row_number() OVER (
             PARTITION BY company_id, month, rule_reason IS NULL
             ORDER BY updated_at DESC NULLS LAST, row_ord DESC) > 1
           THEN 'SUPERSEDED_BY_CORRECTION' END) AS quarantine_reason
  FROM revenue_ruled),
order_amounts AS (
  SELECT l_orderkey, CAST(SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2))
                                    * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)) AS DOUBLE) AS amt
  FROM lineitem GROUP BY l_orderkey),
expense_raw AS (
  SELECT CASE WHEN o_orderkey%199=0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS company_id,
         strftime(o_orderdate,'%Y-%m') AS month,
         CASE WHEN o_orderkey%127=0 THEN NULL WHEN o_orderkey%113=0 THEN -amt ELSE amt END AS expenses,
         o_orderdate AS updated_at, o_orderkey AS row_ord
  FROM orders JOIN order_amounts ON l_orderkey=o_orderkey),
expense_norm AS (
  SELECT {int_key('company_id')} AS company_id, trim(month) AS month, expenses, updated_at, row_ord
  FROM expense_raw),
expense_ruled AS (
  SELECT *, CASE WHEN company_id IS NULL OR company_id NOT IN (SELECT company_id FROM dim_ids) THEN 'ORPHAN_COMPANY_ID'
                 WHEN expenses IS NULL THEN 'NULL_EXPENSE'
                 WHEN expenses < 0 THEN 'NEGATIVE_EXPENSE'
                 WHEN month IS NULL OR month = '' THEN 'INVALID_MONTH' END AS rule_reason
  FROM expense_norm),
expense_cls AS (
  SELECT company_id, month, expenses, updated_at, row_ord, rule_reason,
         COALESCE(rule_reason, CASE WHEN row_number() OVER (
             PARTITION BY company_id, month, rule_reason IS NULL
             ORDER BY updated_at DESC NULLS LAST, row_ord DESC) > 1
           THEN 'SUPERSEDED_BY_CORRECTION' END) AS quarantine_reason
  FROM expense_ruled),
fx_raw AS (
  SELECT CASE WHEN event_id%131=0 THEN '  '
              ELSE ({_list(FX_CURRENCIES)})[1+user_id%8] END AS local_currency,
         'usd' AS base_currency, strftime(ts,'%Y-%m-%d') AS date,
         CASE WHEN event_id%139=0 THEN NULL WHEN event_id%137=0 THEN 0.0 ELSE value END AS fx_rate,
         event_id AS row_ord
  FROM events),
fx_ruled AS (
  SELECT upper(trim(local_currency)) AS local_currency, upper(trim(base_currency)) AS base_currency,
         trim(date) AS date, CAST(fx_rate AS DOUBLE) AS fx_rate, row_ord,
         CASE WHEN local_currency IS NULL OR trim(local_currency) = '' OR base_currency IS NULL OR trim(base_currency) = ''
                THEN 'INVALID_CURRENCY'
              WHEN fx_rate IS NULL OR fx_rate <= 0 THEN 'INVALID_FX_RATE'
              WHEN date IS NULL OR trim(date) = '' THEN 'INVALID_DATE' END AS rule_reason
  FROM fx_raw),
fx_cls AS (
  SELECT local_currency, base_currency, date, fx_rate, row_ord, rule_reason,
         COALESCE(rule_reason, CASE WHEN row_number() OVER (
             PARTITION BY local_currency, base_currency, date, rule_reason IS NULL
             ORDER BY row_ord DESC) > 1
           THEN 'SUPERSEDED_BY_CORRECTION' END) AS quarantine_reason
  FROM fx_ruled),
rev_clean AS (SELECT * FROM revenue_cls WHERE quarantine_reason IS NULL),
exp_clean AS (SELECT * FROM expense_cls WHERE quarantine_reason IS NULL),
fact AS (
  SELECT COALESCE(r.company_id, e.company_id) AS company_id, COALESCE(r.month, e.month) AS month,
         r.revenue, e.expenses, r.currency,
         CAST(r.updated_at AS DATE) AS revenue_updated_at, CAST(e.updated_at AS DATE) AS expenses_updated_at,
         CASE WHEN r.company_id IS NOT NULL THEN '{RUN_UUID["revenue"]}' END AS revenue_pipeline_load_uuid,
         CASE WHEN e.company_id IS NOT NULL THEN '{RUN_UUID["expense"]}' END AS expense_pipeline_load_uuid
  FROM rev_clean r FULL OUTER JOIN exp_clean e ON r.company_id = e.company_id AND r.month = e.month),
fact_w AS (
  SELECT *, revenue IS NOT NULL AND expenses IS NOT NULL AS elig,
         lag(revenue) OVER (PARTITION BY company_id ORDER BY try_strptime(month, '%Y-%m') NULLS LAST, month) AS prev_rev,
         sum(revenue) OVER (PARTITION BY company_id ORDER BY try_strptime(month, '%Y-%m') NULLS LAST, month
                            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll
  FROM fact),
fact_m AS (
  SELECT company_id, month, revenue, expenses, currency,
         CASE WHEN elig THEN revenue - expenses END AS gross_profit,
         CASE WHEN elig AND revenue <> 0 THEN (revenue - expenses) / revenue * 100 END AS gross_margin_pct,
         CASE WHEN elig AND prev_rev IS NOT NULL AND prev_rev <> 0
              THEN (revenue - prev_rev) / prev_rev * 100 END AS mom_revenue_growth_pct,
         round(CASE WHEN elig THEN roll END, 2) AS rolling_3m_revenue,
         revenue_updated_at, expenses_updated_at, revenue_pipeline_load_uuid, expense_pipeline_load_uuid
  FROM fact_w),
company_b2 AS (
  SELECT CAST(c_custkey + 50 AS VARCHAR) AS company_id, upper(c_name) AS name, c_mktsegment AS industry,
         n_name AS country
  FROM customer JOIN nation ON c_nationkey=n_nationkey),
dim2 AS (
  SELECT COALESCE(t.company_id, s.company_id) AS company_id,
         CASE WHEN s.company_id IS NOT NULL THEN s.name ELSE t.name END AS name,
         CASE WHEN s.company_id IS NOT NULL THEN s.industry ELSE t.industry END AS industry,
         CASE WHEN s.company_id IS NOT NULL THEN s.country ELSE t.country END AS country,
         CASE WHEN s.company_id IS NOT NULL THEN '{UUID2}' ELSE t.pipeline_load_uuid END AS pipeline_load_uuid,
         CASE WHEN s.company_id IS NOT NULL AND t.company_id IS NOT NULL THEN 'update'
              WHEN s.company_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS action
  FROM dim1 t FULL OUTER JOIN company_b2 s ON t.company_id = s.company_id),
revenue_b2 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY company_id, month ORDER BY dated DESC, row_ord DESC) AS rn FROM (
      SELECT company_id, month, revenue, row_ord, updated_at + CASE WHEN row_ord % 2 = 0 THEN INTERVAL (-10) DAY ELSE INTERVAL 10 DAY END AS dated
      FROM revenue_ruled WHERE rule_reason IS NULL)) WHERE rn = 1),
fx1 AS (SELECT local_currency, base_currency, date, fx_rate FROM fx_cls WHERE quarantine_reason IS NULL),
fx_b2 AS (
  SELECT local_currency, base_currency, date, fx_rate FROM (
    SELECT upper(trim(({_list(FX_CURRENCIES)})[1+user_id%8])) AS local_currency, 'USD' AS base_currency,
           strftime(ts + INTERVAL 15 DAY, '%Y-%m-%d') AS date, value + 0.5 AS fx_rate,
           row_number() OVER (PARTITION BY upper(trim(({_list(FX_CURRENCIES)})[1+user_id%8])),
                                           strftime(ts + INTERVAL 15 DAY, '%Y-%m-%d')
                              ORDER BY event_id DESC) AS rn
    FROM events) WHERE rn = 1),
fx2 AS (
  SELECT COALESCE(t.local_currency, s.local_currency) AS local_currency,
         COALESCE(t.base_currency, s.base_currency) AS base_currency,
         COALESCE(t.date, s.date) AS date,
         CASE WHEN s.local_currency IS NOT NULL THEN s.fx_rate ELSE t.fx_rate END AS fx_rate
  FROM fx1 t FULL OUTER JOIN fx_b2 s
    ON t.local_currency = s.local_currency AND t.base_currency = s.base_currency AND t.date = s.date)
"""


def with_ctes(select: str) -> str:
    return "WITH " + CTES.strip() + "\n" + select.strip()


def _counts(entity: str, cls: str, raw: str) -> str:
    return f"""
  SELECT '{entity}' AS entity, 'BRONZE' AS stage, 'SUCCESS' AS status, (SELECT count(*) FROM {raw}) AS row_count
  UNION ALL SELECT '{entity}', 'SILVER', 'SUCCESS', (SELECT count(*) FROM {cls} WHERE quarantine_reason IS NULL)
  UNION ALL SELECT '{entity}', 'QUARANTINE', 'SUCCESS', (SELECT count(*) FROM {cls} WHERE quarantine_reason IS NOT NULL)
  UNION ALL SELECT '{entity}', 'GOLDEN', 'SUCCESS', (SELECT count(*) FROM {cls} WHERE quarantine_reason IS NULL)"""


AUDIT_ROWS = (f"audit_rows AS ({_counts('company', 'company_cls', 'company_raw')}"
              f"\n  UNION ALL {_counts('revenue', 'revenue_cls', 'revenue_raw').strip()}"
              f"\n  UNION ALL {_counts('expense', 'expense_cls', 'expense_raw').strip()}"
              f"\n  UNION ALL {_counts('fx_rate', 'fx_cls', 'fx_raw').strip()})")


SQL = {
    "stamp_load": """
SELECT c_custkey, c_name, '00000000-0000-4000-8000-000000000001' AS pipeline_load_uuid,
       '2024-03-01 00:00:00' AS pipeline_loaded_at
FROM customer""",
    "normalise_keys": f"""
SELECT c_custkey, key_text, {int_key('key_text')} AS company_id FROM (
  SELECT c_custkey,
         CASE c_custkey % 6 WHEN 0 THEN '00' || CAST(c_custkey AS VARCHAR)
                            WHEN 1 THEN ' ' || CAST(c_custkey AS VARCHAR) || ' '
                            WHEN 2 THEN CAST(c_custkey AS VARCHAR) || '.0'
                            WHEN 3 THEN 'C' || CAST(c_custkey AS VARCHAR)
                            WHEN 4 THEN CAST(c_custkey AS VARCHAR) || 'e0'
                            ELSE CAST(c_custkey AS VARCHAR) || '.5' END AS key_text
  FROM customer)""",
    "normalise_text": "SELECT row_ord, name, industry, country FROM company_norm",
    "coerce_numeric": f"""
SELECT event_id, value_text, {to_double('value_text')} AS value_num FROM (
  SELECT event_id,
         CASE event_id % 6 WHEN 0 THEN json_extract_string(props, '$.k')
                           WHEN 1 THEN ' ' || json_extract_string(props, '$.k') || ' '
                           WHEN 2 THEN json_extract_string(props, '$.k') || '.25'
                           WHEN 3 THEN json_extract_string(props, '$.k') || 'd'
                           WHEN 4 THEN json_extract_string(props, '$.k') || 'e1'
                           ELSE 'NaN' END AS value_text
  FROM events)""",
    "coerce_timestamp": """
SELECT event_id, ts_text, strftime(ts_parsed, '%Y-%m-%d %H:%M:%S') AS ts_parsed FROM (
  SELECT event_id,
         CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                           WHEN 2 THEN strftime(ts, '%Y-%m-%d')
                           WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'
                           WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
                           WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-0800'
                           ELSE 'not a time' END AS ts_text,
         CASE event_id % 7 WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN ts - INTERVAL 330 MINUTE
                           WHEN 5 THEN ts + INTERVAL 8 HOUR WHEN 6 THEN NULL ELSE ts END AS ts_parsed
  FROM events)""",
    "currency_normalise": """
SELECT row_ord, currency_text, currency_code FROM revenue_norm""",
    "month_parse": """
SELECT o_orderkey, month_text, strftime(try_strptime(month_text, '%Y-%m'), '%Y-%m-%d') AS month_start FROM (
  SELECT o_orderkey,
         CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m')
                             WHEN 1 THEN strftime(o_orderdate, '%Y-%-m')
                             WHEN 2 THEN strftime(o_orderdate, '%Y/%m')
                             ELSE strftime(o_orderdate, '%Y-%m-%d') END AS month_text
  FROM orders)""",
    "sanitise_floats": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN isnan(ratio) OR isinf(ratio) THEN NULL ELSE ratio END AS ratio FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_tax = 0 AND l_discount = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN l_tax = 0 THEN CAST('Infinity' AS DOUBLE)
              ELSE l_discount / l_tax END AS ratio
  FROM lineitem)""",
    "orphan_check": """
SELECT row_ord, company_id,
       company_id IS NOT NULL AND company_id IN (SELECT company_id FROM dim_ids) AS known
FROM revenue_norm""",
    "orphan_rows": """
SELECT row_ord, company_id FROM revenue_norm
WHERE company_id IS NULL OR company_id NOT IN (SELECT company_id FROM dim_ids)""",
    "classify_company": "SELECT row_ord, company_id, rule_reason AS quarantine_reason FROM company_ruled",
    "classify_revenue": "SELECT row_ord, company_id, month, rule_reason AS quarantine_reason FROM revenue_ruled",
    "classify_expense": "SELECT row_ord, company_id, month, rule_reason AS quarantine_reason FROM expense_ruled",
    "classify_fx": """
SELECT row_ord, local_currency, base_currency, date, rule_reason AS quarantine_reason FROM fx_ruled""",
    "dedup_company": "SELECT row_ord, company_id, name, quarantine_reason FROM company_cls",
    "dedup_revenue": "SELECT row_ord, company_id, month, currency, quarantine_reason FROM revenue_cls",
    "dedup_expense": "SELECT row_ord, company_id, month, expenses, quarantine_reason FROM expense_cls",
    "dedup_fx": """
SELECT row_ord, local_currency, base_currency, date, fx_rate, quarantine_reason FROM fx_cls""",
    "zone_split": """
SELECT row_ord, CASE WHEN quarantine_reason IS NULL THEN 'silver' ELSE 'quarantine' END AS zone
FROM revenue_cls""",
    "quarantine_union": """
SELECT 'company' AS entity, row_ord, company_id, CAST(NULL AS VARCHAR) AS month, quarantine_reason
FROM company_cls WHERE quarantine_reason IS NOT NULL
UNION ALL SELECT 'revenue', row_ord, company_id, month, quarantine_reason FROM revenue_cls WHERE quarantine_reason IS NOT NULL
UNION ALL SELECT 'expense', row_ord, company_id, month, quarantine_reason FROM expense_cls WHERE quarantine_reason IS NOT NULL
UNION ALL SELECT 'fx_rate', row_ord, NULL, NULL, quarantine_reason FROM fx_cls WHERE quarantine_reason IS NOT NULL""",
    "quarantine_breakdown": """
SELECT entity, quarantine_reason, count(*) AS rows FROM (
  SELECT 'company' AS entity, quarantine_reason FROM company_cls
  UNION ALL SELECT 'revenue', quarantine_reason FROM revenue_cls
  UNION ALL SELECT 'expense', quarantine_reason FROM expense_cls
  UNION ALL SELECT 'fx_rate', quarantine_reason FROM fx_cls)
WHERE quarantine_reason IS NOT NULL GROUP BY entity, quarantine_reason""",
    "quarantine_report": """
SELECT company_id, month, revenue, currency, quarantine_reason FROM revenue_cls
WHERE quarantine_reason IS NOT NULL""",
    "zone_counts": """
SELECT entity, count(*) AS raw_rows, count(*) FILTER (WHERE quarantine_reason IS NULL) AS clean_rows,
       count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS quarantined_rows FROM (
  SELECT 'company' AS entity, quarantine_reason FROM company_cls
  UNION ALL SELECT 'revenue', quarantine_reason FROM revenue_cls
  UNION ALL SELECT 'expense', quarantine_reason FROM expense_cls
  UNION ALL SELECT 'fx_rate', quarantine_reason FROM fx_cls) GROUP BY entity""",
    "distinct_keys": "SELECT DISTINCT company_id FROM revenue_norm WHERE company_id IS NOT NULL",
    "company_upsert": "SELECT company_id, name, industry, country, pipeline_load_uuid FROM dim2",
    "company_upsert_counts": """
SELECT count(*) FILTER (WHERE action = 'insert') AS inserted,
       count(*) FILTER (WHERE action = 'update') AS updated,
       count(*) FILTER (WHERE action = 'keep') AS unchanged FROM dim2""",
    "fact_upsert": """
SELECT company_id, month, revenue, expenses, currency, strftime(revenue_updated_at, '%Y-%m-%d') AS revenue_updated_at,
       strftime(expenses_updated_at, '%Y-%m-%d') AS expenses_updated_at,
       revenue_pipeline_load_uuid, expense_pipeline_load_uuid FROM fact""",
    "fact_upsert_counts": """
SELECT 'revenue' AS step, (SELECT count(*) FROM rev_clean) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged
UNION ALL
SELECT 'expense',
       (SELECT count(*) FROM exp_clean e WHERE NOT EXISTS (SELECT 1 FROM rev_clean r WHERE r.company_id = e.company_id AND r.month = e.month)),
       (SELECT count(*) FROM exp_clean e WHERE EXISTS (SELECT 1 FROM rev_clean r WHERE r.company_id = e.company_id AND r.month = e.month)),
       (SELECT count(*) FROM rev_clean r WHERE NOT EXISTS (SELECT 1 FROM exp_clean e WHERE r.company_id = e.company_id AND r.month = e.month))""",
    "fx_upsert": "SELECT local_currency, base_currency, date, fx_rate FROM fx2",
    "fk_violations": """
SELECT count(*) AS violations FROM fact WHERE company_id NOT IN (SELECT company_id FROM dim_ids)""",
    "fin_metrics": """
SELECT company_id, month, revenue, expenses, gross_profit, gross_margin_pct, mom_revenue_growth_pct,
       rolling_3m_revenue FROM fact_m""",
    "fin_metrics_one": """
SELECT f.company_id, f.month, f.revenue, f.expenses,
       CASE WHEN f.company_id = '7' THEN m.gross_profit END AS gross_profit,
       CASE WHEN f.company_id = '7' THEN m.gross_margin_pct END AS gross_margin_pct,
       CASE WHEN f.company_id = '7' THEN m.mom_revenue_growth_pct END AS mom_revenue_growth_pct,
       CASE WHEN f.company_id = '7' THEN m.rolling_3m_revenue END AS rolling_3m_revenue
FROM fact f JOIN fact_m m ON f.company_id = m.company_id AND f.month = m.month""",
    "metrics_summary": """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE revenue IS NOT NULL AND expenses IS NOT NULL) AS eligible_rows,
       count(mom_revenue_growth_pct) AS rows_with_growth,
       count(rolling_3m_revenue) AS rows_with_rolling FROM fact_m""",
    "read_company": """
SELECT company_id, name, industry, country FROM dim1
WHERE industry ILIKE '%build%' AND country ILIKE '%tion_1%'""",
    "read_revenue": "SELECT company_id, month, revenue, currency FROM fact WHERE currency = 'USD'",
    "read_expense": "SELECT company_id, month, expenses FROM fact WHERE month = '1997-06'",
    "read_financials": """
SELECT company_id, month, revenue, expenses, currency, gross_profit, gross_margin_pct,
       mom_revenue_growth_pct, rolling_3m_revenue FROM fact_m WHERE currency = 'EUR'""",
    "read_fx": """
SELECT local_currency, base_currency, date, fx_rate FROM fx1
WHERE local_currency = 'EUR' AND base_currency = 'USD'""",
    "audit_log": "SELECT entity, stage, status, row_count FROM audit_rows",
    "audit_query": """
SELECT entity, stage, status, row_count FROM audit_rows WHERE entity = 'revenue' AND status = 'SUCCESS'""",
    "load_company": "SELECT company_id, name, industry, country FROM dim1",
    "load_revenue": """
SELECT company_id, month, revenue, currency FROM rev_clean""",
    "load_expense": """
SELECT company_id, month, revenue, expenses, currency FROM fact""",
    "load_fx": "SELECT local_currency, base_currency, date, fx_rate FROM fx1",
    "load_metrics": """
SELECT company_id, month, revenue, expenses, gross_profit, gross_margin_pct, mom_revenue_growth_pct,
       rolling_3m_revenue FROM fact_m""",
    "load_metrics_one": """
SELECT company_id, month, revenue, expenses, CASE WHEN company_id = '7' THEN gross_profit END AS gross_profit,
       CASE WHEN company_id = '7' THEN gross_margin_pct END AS gross_margin_pct,
       CASE WHEN company_id = '7' THEN mom_revenue_growth_pct END AS mom_revenue_growth_pct,
       CASE WHEN company_id = '7' THEN rolling_3m_revenue END AS rolling_3m_revenue FROM fact_m""",
    "metrics_run": """
SELECT scope, 'success' AS status, 'Metrics computed and saved for ' || eligible_rows || ' eligible rows.' AS message,
       total_rows, eligible_rows, total_rows AS updated_rows FROM (
  SELECT 'all' AS scope, count(*) AS total_rows, count(*) FILTER (WHERE elig) AS eligible_rows FROM fact_w
  UNION ALL SELECT 'one', count(*), count(*) FILTER (WHERE elig) FROM fact_w WHERE company_id = '7')""",
    "scan_quoted": """
SELECT CAST(c_custkey AS VARCHAR) AS company_id,
       c_name || CASE c_custkey % 4 WHEN 0 THEN ', "Ltd"' WHEN 1 THEN chr(10) || 'Inc, 2,b,c' WHEN 2 THEN '"' || chr(10) || '"' ELSE '' END AS name,
       c_mktsegment AS industry, n_name || CASE WHEN c_custkey % 5 = 0 THEN chr(10) || '9,x,y,z' ELSE '' END AS country
FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "late_records": """
SELECT f.company_id, f.month, CASE WHEN late THEN f.revenue ELSE s.revenue * 2 END AS revenue,
       strftime(CASE WHEN late THEN CAST(f.updated_at AS DATE) ELSE CAST(s.dated AS DATE) END, '%Y-%m-%d') AS revenue_updated_at,
       CASE WHEN late THEN 'stale' ELSE 'update' END AS action
FROM (SELECT f.company_id, f.month, f.revenue, f.updated_at, CAST(s.dated AS DATE) < CAST(f.updated_at AS DATE) AS late
      FROM rev_clean f JOIN revenue_b2 s ON f.company_id = s.company_id AND f.month = s.month) f
JOIN revenue_b2 s ON f.company_id = s.company_id AND f.month = s.month""",
    "fact_in_base": """
SELECT company_id, month, currency, rate, rate_date, revenue * rate AS revenue_base, expenses * rate AS expenses_base,
       gross_profit * rate AS gross_profit_base FROM fact_usd""",
    "missing_rate_counts": """
SELECT currency, count(*) AS row_count, count(*) FILTER (rate IS NULL) AS missing_rate FROM fact_usd GROUP BY currency""",
    "fact_as_json": f"""
SELECT '{','.join(f.name for f in FACT_FINANCIALS.fields)}' AS json_keys, company_id, month, revenue, expenses, currency, gross_profit,
       gross_margin_pct, mom_revenue_growth_pct, rolling_3m_revenue, strftime(revenue_updated_at, '%Y-%m-%d') AS revenue_updated_at,
       strftime(expenses_updated_at, '%Y-%m-%d') AS expenses_updated_at,
       CASE WHEN revenue_pipeline_load_uuid IS NOT NULL THEN '2024-03-01T00:00:00' END AS revenue_pipeline_loaded_at,
       CASE WHEN expense_pipeline_load_uuid IS NOT NULL THEN '2024-03-01T00:00:00' END AS expense_pipeline_loaded_at,
       revenue_pipeline_load_uuid, expense_pipeline_load_uuid, '2024-03-01T00:00:00' AS updated_at
FROM fact_m""",
}


IN_BASE = """
rates_m AS (
  SELECT local_currency AS currency, date_trunc('month', try_cast(date AS DATE)) AS first, try_cast(date AS DATE) AS rate_date, fx_rate AS rate
  FROM fx1 WHERE base_currency = 'USD' AND try_cast(date AS DATE) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY local_currency, date_trunc('month', try_cast(date AS DATE)) ORDER BY try_cast(date AS DATE) DESC, date DESC) = 1),
fact_usd AS (
  SELECT f.company_id, f.month, f.currency, CASE WHEN f.currency = 'USD' AND m.first IS NOT NULL THEN 1.0::DOUBLE ELSE r.rate END AS rate,
         CASE WHEN f.currency <> 'USD' THEN r.rate_date END AS rate_date, f.revenue, f.expenses, f.gross_profit
  FROM fact_m f LEFT JOIN (SELECT DISTINCT month, CAST(try_strptime(month, '%Y-%m') AS DATE) AS first FROM fact_m) m ON m.month = f.month
  LEFT JOIN (SELECT DISTINCT k.currency, k.month, last_value(r.rate) OVER w AS rate, last_value(r.rate_date) OVER w AS rate_date
             FROM (SELECT DISTINCT currency, month, CAST(try_strptime(month, '%Y-%m') AS DATE) AS first FROM fact_m) k
             JOIN rates_m r ON r.currency = k.currency AND r.first <= k.first
             WINDOW w AS (PARTITION BY k.currency, k.month ORDER BY r.first ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) r
    ON r.currency = f.currency AND r.month = f.month)"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, select in {**SQL, "hand_off_round_trip": SQL["quarantine_union"], "fin_metrics_spread": SQL["fin_metrics"]}.items():
        ctes = CTES.strip()
        if name.startswith("audit_"):
            ctes = ctes + ",\n" + AUDIT_ROWS
        if name in ("fact_in_base", "missing_rate_counts"):
            ctes = ctes + "," + IN_BASE
        out[name] = "WITH " + ctes + "\n" + select.strip()
    return out
