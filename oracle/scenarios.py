"""SQL answers of the scenarios: landing, refresh, history, quality and serving."""

from __future__ import annotations

from meterbook.quality import declared
from meterbook.quality.rules import Rule
from oracle.tables import EVT_DAY, SUB_DAY, WINDOW

EVT = "TIMESTAMP '2024-01-20 00:00:00'"
LATE = "TIMESTAMP '2024-01-15 00:00:00'"
CUT = "TIMESTAMP '1999-06-01 00:00:00'"
MICRO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
NO_ID = "Value error, missing required technical identifier: "
NO_TIME = "Value error, missing required timestamp: "
BAD_TIME = "Value error, Unknown string format: "

TABLES = {
    # landed text of the account deliveries
    "account_text": """
        SELECT s_suppkey AS n, s_acctbal AS balance, 'crm_' || s_suppkey AS crm_account_id,
               CASE WHEN s_suppkey % 41 = 0 THEN 'org_missing_' || s_suppkey ELSE 'org_' || s_suppkey END
                   AS organization_id,
               CASE WHEN s_nationkey % 2 = 0 THEN ' Prospect' ELSE 'active' END AS account_status,
               ['smb','Mid_Market','ENTERPRISE','other'][s_suppkey % 4 + 1] AS segment,
               [' Sales','success'][s_suppkey % 2 + 1] AS owner_team,
               ['Web',' ','referral'][s_suppkey % 3 + 1] AS lead_source,
               '1999-01-01T00:00:00Z' AS created_at,
               strftime(TIMESTAMP '1999-01-01' + to_days((1 + s_suppkey % 300)::INT), '%Y-%m-%dT00:00:00Z')
                   AS updated_at,
               strftime(TIMESTAMP '1999-01-01' + to_days((366 + s_suppkey % 300)::INT), '%Y-%m-%dT00:00:00Z')
                   AS updated_later,
               s_suppkey % 29 = 5 AS no_id, s_suppkey % 31 = 7 AS bad_time
        FROM supplier""",
    "account_deliveries": """
        SELECT n, no_id, bad_time FROM account_text
        UNION ALL SELECT n, no_id, bad_time FROM account_text WHERE balance <= 9000""",
    "event_lines": """
        SELECT event_id AS n, CASE WHEN event_id % 307 = 1 THEN 'broken' WHEN event_id % 311 = 2 THEN 'array'
                    WHEN event_id % 331 = 5 THEN 'blank' WHEN event_id % 313 = 3 THEN 'number' ELSE 'record' END AS kind,
               event_id % 317 = 4 AS no_time, unnest(range(0, CASE WHEN event_id % 337 = 6 THEN 2 ELSE 1 END)) AS copy
        FROM events""",
    "request_rows": """
        SELECT event_id AS n, event_id % 211 = 1 AS no_id, event_id % 223 = 2 AS bad_time,
               event_id % 223 <> 2 AND event_id % 227 = 3 AS no_time
        FROM events""",
    "rejects": f"""
        SELECT 'crm_accounts' AS source_name,
               concat_ws('; ', CASE WHEN no_id THEN '{NO_ID}crm_account_id' END,
                               CASE WHEN bad_time THEN '{BAD_TIME}not-a-date' END) AS reason
        FROM account_deliveries WHERE no_id OR bad_time
        UNION ALL
        SELECT 'crm_accounts', 'duplicate business key within source file'
        FROM account_text WHERE balance <= 9000 AND NOT no_id AND NOT bad_time
        UNION ALL
        SELECT 'product_events', CASE kind WHEN 'broken' THEN 'malformed JSON'
               WHEN 'array' THEN 'line is not a JSON object'
               WHEN 'number' THEN 'Input should be a valid string'
                    || CASE WHEN no_time THEN '; {NO_TIME}event_timestamp' ELSE '' END
               ELSE CASE WHEN no_time THEN '{NO_TIME}event_timestamp'
                         ELSE 'duplicate business key within source file' END END
        FROM event_lines WHERE kind IN ('broken', 'array', 'number') OR (kind = 'record' AND (no_time OR copy = 1))
        UNION ALL
        SELECT 'api_usage',
               concat_ws('; ', CASE WHEN no_id THEN '{NO_ID}request_id' END,
                               CASE WHEN bad_time THEN '{BAD_TIME}garbage'
                                    WHEN no_time THEN '{NO_TIME}request_timestamp' END)
        FROM request_rows WHERE no_id OR bad_time OR no_time""",
    "received": """
        SELECT 'crm_accounts' AS source, count(*) AS n FROM account_deliveries
        UNION ALL SELECT 'product_events', count(*) FROM event_lines WHERE kind <> 'blank'
        UNION ALL SELECT 'api_usage', count(*) FROM request_rows""",
    "account_versions": """
        SELECT crm_account_id, organization_id, account_status, is_account_status_unknown, segment, owner_team,
               lead_source, is_lead_source_missing, created_at, updated_at, updated_at AS valid_from,
               CASE WHEN balance < 0 THEN updated_at + INTERVAL 365 DAY
                    WHEN balance > 9000 THEN TIMESTAMP '2001-01-01 00:00:00' END AS valid_to
        FROM crm_first
        UNION ALL
        SELECT crm_account_id, organization_id, account_status, is_account_status_unknown, segment, owner_team,
               lead_source, is_lead_source_missing, created_at, updated_at, updated_at, NULL
        FROM crm_second WHERE balance < 0""",
    "snap_subscriptions": "SELECT *, updated_at AS valid_from, NULL::TIMESTAMP AS valid_to FROM stg_subscriptions",
    "snap_crm_accounts": "SELECT *, updated_at AS valid_from, NULL::TIMESTAMP AS valid_to FROM stg_crm_accounts",
    "raw_organizations": "SELECT c_custkey // 2 AS organization_id FROM customer GROUP BY 1",
    "raw_users": "SELECT c_custkey AS user_id FROM customer",
    "raw_subscriptions": "SELECT o_orderkey AS subscription_id FROM orders",
    "raw_invoices": "SELECT invoice_id FROM invoice_versions",
    "raw_product_events": "SELECT event_id FROM events",
    "raw_api_usage": "SELECT event_id AS request_id FROM events",
    "raw_crm_accounts": "SELECT crm_account_id FROM crm_first UNION ALL SELECT crm_account_id FROM crm_second",
    "raw_marketing_events": """SELECT event_id AS marketing_event_id FROM events""",
    "newest_landed": """
        SELECT 'raw.users' AS t, max(_ingested_at) AS m FROM stg_users
        UNION ALL SELECT 'raw.organizations', max(_ingested_at) FROM stg_organizations
        UNION ALL SELECT 'raw.subscriptions', max(_ingested_at) FROM stg_subscriptions
        UNION ALL SELECT 'raw.invoices', max(_ingested_at) FROM invoice_versions
        UNION ALL SELECT 'raw.product_events', max(_ingested_at) FROM stg_product_events
        UNION ALL SELECT 'raw.api_usage', max(_ingested_at) FROM stg_api_usage
        UNION ALL SELECT 'raw.crm_accounts', max(_ingested_at)
                  FROM (SELECT _ingested_at FROM crm_first UNION ALL SELECT _ingested_at FROM crm_second)
        UNION ALL SELECT 'raw.marketing_events', max(_ingested_at) FROM stg_marketing_events""",
    "orphans": """
        SELECT 'orphaned_subscription_users' AS test_name, count(*) FILTER (u.user_id IS NULL) AS failed_rows,
               count(*) AS total_rows FROM stg_subscriptions s LEFT JOIN stg_users u USING (user_id)
        UNION ALL SELECT 'orphaned_product_event_users', count(*) FILTER (u.user_id IS NULL), count(*)
               FROM stg_product_events e LEFT JOIN stg_users u USING (user_id)
        UNION ALL SELECT 'orphaned_invoice_subscriptions', count(*) FILTER (s.subscription_id IS NULL), count(*)
               FROM stg_invoices i LEFT JOIN stg_subscriptions s USING (subscription_id)
        UNION ALL SELECT 'orphaned_crm_organizations', count(*) FILTER (o.organization_id IS NULL), count(*)
               FROM stg_crm_accounts c LEFT JOIN stg_organizations o USING (organization_id)""",
    "orphan_results": """
        SELECT test_name, failed_rows, total_rows, round(failed_rows / total_rows, 4) AS failure_rate,
               CASE WHEN failed_rows / total_rows > 0.15 THEN 'FAIL' WHEN failed_rows / total_rows > 0.02 THEN 'WARN'
                    ELSE 'PASS' END AS status
        FROM orphans""",
    "ages": f"""
        SELECT t AS source_table, epoch_us({EVT}) / 3600000000.0 - epoch_us(m) / 3600000000.0 AS age_hours,
               CASE WHEN age_hours > 48 THEN 'FAIL' WHEN age_hours > 24 THEN 'WARN' ELSE 'PASS' END AS status
        FROM newest_landed""",
    "bad_invoices": """
        SELECT count(*) AS total, count(*) FILTER (paid_amount > billed_amount + 0.01
               OR outstanding_amount > billed_amount + 0.01 OR least(billed_amount, paid_amount, outstanding_amount) < 0)
               AS failed FROM fact_invoices""",
    "fact_lags": """
        SELECT 'analytics.fact_product_usage' AS f, (SELECT m FROM newest_landed WHERE t = 'raw.product_events')
               - (SELECT max(_last_ingested_at) FROM fact_product_usage) AS lag
        UNION ALL SELECT 'analytics.fact_api_usage', (SELECT m FROM newest_landed WHERE t = 'raw.api_usage')
               - (SELECT max(_last_ingested_at) FROM fact_api_usage)
        UNION ALL SELECT 'analytics.fact_invoices', (SELECT m FROM newest_landed WHERE t = 'raw.invoices')
               - (SELECT max(_last_ingested_at) FROM fact_invoices)""",
    "check_results": """
        SELECT 'required_relations_exist' AS test_name, 'structural' AS category, 'ERROR' AS severity,
               'PASS' AS status, 0 AS failed_rows, 23 AS total_rows, 0.0 AS failure_rate
        UNION ALL SELECT 'fact_primary_key_uniqueness', 'structural', 'ERROR', if(d = 0, 'PASS', 'FAIL'), d, NULL, NULL
          FROM (SELECT (SELECT count(*) - count(DISTINCT subscription_id) FROM fact_subscriptions)
                     + (SELECT count(*) - count(DISTINCT invoice_id) FROM fact_invoices) AS d)
        UNION ALL SELECT 'critical_tables_not_empty', 'structural', 'ERROR', 'PASS', 0, 7, NULL
        UNION ALL SELECT test_name, 'referential', 'WARN', status, failed_rows, total_rows, failure_rate
          FROM orphan_results
        UNION ALL SELECT 'invoice_amount_semantics', 'business', 'ERROR', if(failed = 0, 'PASS', 'FAIL'), failed, total,
          round(failed / total, 4) FROM bad_invoices
        UNION ALL SELECT 'mrr_arr_relationship_by_currency', 'business', 'ERROR', 'PASS',
          (SELECT count(*) FROM mart_mrr JOIN mart_arr a USING (currency)
           WHERE round(mart_mrr.mrr * 12, 2) <> round(a.arr, 2)), (SELECT count(*) FROM mart_mrr), NULL
        UNION ALL SELECT 'rates_within_valid_range', 'business', 'ERROR', 'PASS',
          (SELECT count(*) FROM (SELECT churn_rate AS r FROM mart_customer_churn
             UNION ALL SELECT gross_revenue_churn_rate FROM mart_revenue_churn
             UNION ALL SELECT retention_rate FROM mart_retention_cohorts
             UNION ALL SELECT adoption_rate FROM mart_feature_adoption
             UNION ALL SELECT trial_to_paid_conversion_rate FROM mart_acquisition_channels
             UNION ALL SELECT error_rate FROM fact_api_usage) WHERE r NOT BETWEEN 0 AND 1), NULL, NULL
        UNION ALL SELECT 'no_negative_monetary_or_count_values', 'business', 'ERROR', 'PASS',
          (SELECT count(*) FROM fact_subscriptions WHERE subscription_amount < 0 OR monthly_equivalent_amount < 0),
          NULL, NULL
        UNION ALL SELECT 'raw_source_freshness', 'freshness', 'WARN',
          CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'
               WHEN count(*) FILTER (status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END,
          count(*) FILTER (status <> 'PASS'), 8, NULL FROM ages
        UNION ALL SELECT 'incremental_fact_watermarks', 'freshness', 'WARN',
          if(count(*) FILTER (lag > INTERVAL 24 HOUR) > 0, 'WARN', 'PASS'),
          count(*) FILTER (lag > INTERVAL 24 HOUR), 3, NULL FROM fact_lags
        UNION ALL SELECT 'snapshot_current_record_uniqueness', 'snapshot', 'ERROR', 'PASS', 0, NULL, NULL
        UNION ALL SELECT 'snapshot_valid_intervals', 'snapshot', 'ERROR', 'PASS',
          (SELECT count(*) FROM stg_subscriptions WHERE updated_at IS NULL),
          (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier), NULL
        UNION ALL SELECT 'row_count_volume_drop', 'volume', 'WARN', 'PASS', NULL, NULL, NULL""",
    "run_summary": """
        SELECT CASE WHEN count(*) FILTER (status = 'FAIL' AND severity = 'ERROR') > 0 THEN 'FAIL'
                    WHEN count(*) FILTER (status <> 'PASS') > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status,
               count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed_checks,
               count(*) FILTER (status = 'WARN') AS warned_checks, count(*) FILTER (status = 'FAIL') AS failed_checks
        FROM check_results""",
}


def _violations(rule: Rule) -> str:
    first = rule.columns[0]
    listed = ", ".join(f"'{v}'" for v in rule.values)
    conditions = {
        "not_null": f"{first} IS NULL",
        "accepted_values": f"{first} NOT IN ({listed})",
        "positive_or_zero": f"{first} < 0",
        "fraction": f"{first} NOT BETWEEN 0 AND 1",
        "valid_currency_code": f"{first} NOT IN ('USD', 'EUR', 'GBP')",
        "valid_timestamp_order": f"{rule.columns[-1]} < {first}",
    }
    if rule.kind in conditions:
        return f"SELECT count(*) FROM {rule.model} WHERE {conditions[rule.kind]}"
    if rule.kind == "relationships":
        parent, key = rule.parent
        return (
            f"SELECT count(*) FROM {rule.model} WHERE {first} IS NOT NULL "
            f"AND {first} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
        )
    keep = rule.where or "true"
    if rule.kind == "unique":
        keep += f" AND {first} IS NOT NULL"
    keys = ", ".join(rule.columns)
    return f"SELECT count(*) FROM (SELECT 1 FROM {rule.model} WHERE {keep} GROUP BY {keys} HAVING count(*) > 1)"


def _rule_counts(rules: list[Rule]) -> tuple[str, str]:
    rows = [
        f"SELECT '{r.model}' AS model, '{r.kind}' AS rule, '{r.labels}' AS columns, '{r.severity}' AS severity, "
        f"({_violations(r)}) AS violations"
        for r in rules
    ]
    return "model rule columns severity violations", "\nUNION ALL ".join(rows)


def _same_total(name: str, left: str, right: str) -> str:
    return (
        f"SELECT *, left_total = right_total AS agrees FROM (SELECT '{name}' AS test, "
        f"({left})::DECIMAL(38,2) AS left_total, ({right})::DECIMAL(38,2) AS right_total)"
    )


def _total(table: str, value: str = "count(*)") -> str:
    return f"SELECT {value} FROM {table}"


_RECONCILED = "\nUNION ALL ".join(
    _same_total(*row)
    for row in (
        ("fact_invoices_rows", _total("fact_invoices"), _total("int_customer_revenue")),
        ("fact_subscriptions_rows", _total("fact_subscriptions"), _total("int_user_subscription_history")),
        ("int_customer_revenue_rows", _total("int_customer_revenue"), _total("stg_invoices")),
        ("int_user_subscription_history_rows", _total("int_user_subscription_history"), _total("stg_subscriptions")),
        ("fact_api_usage_requests", _total("fact_api_usage", "sum(request_count)"),
         _total("int_api_usage_by_customer", "sum(request_count)")),
        ("fact_product_usage_events", _total("fact_product_usage", "sum(event_count)"),
         _total("int_daily_product_usage", "sum(event_count)")),
        ("int_customer_revenue_billed", _total("int_customer_revenue", "sum(billed_amount)"),
         _total("stg_invoices", "sum(total_amount)")),
        ("int_daily_product_usage_events", _total("int_daily_product_usage", "sum(event_count)"),
         _total("stg_product_events", "count(event_timestamp)")),
        ("int_api_usage_by_customer_requests", _total("int_api_usage_by_customer", "sum(request_count)"),
         _total("stg_api_usage", "count(request_timestamp)")),
    )
)

_ACCOUNT_TEXT = """crm_account_id organization_id account_status segment owner_team lead_source created_at updated_at"""
_ACCOUNT_ROW = ", ".join(_ACCOUNT_TEXT.split())
_VERSION = """crm_account_id organization_id account_status is_account_status_unknown segment owner_team lead_source
    is_lead_source_missing created_at updated_at valid_from valid_to"""
_CHECK = "test_name category severity status failed_rows total_rows failure_rate"
_LTV = "organization_id currency realized_ltv_to_date current_arpu platform_churn_rate estimated_ltv"
_PROFILE = "organization_id organization_name organization_type is_enterprise country_code created_date"


def _page(table: str, order: str, limit: int, offset: int, where: str = "true") -> str:
    return f"SELECT * FROM {table} WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"


def results(columns_of: dict[str, str]) -> dict[str, tuple[str, str]]:
    """``columns_of`` gives the columns of the models."""

    def same_as(model: str) -> tuple[str, str]:
        return columns_of[model], f"SELECT * FROM {model}"

    def where(model: str, condition: str = "true") -> tuple[str, str]:
        return columns_of[model], f"SELECT * FROM {model} WHERE {condition}"

    return {
        "event_properties": (
            "event_name k rows",
            """SELECT event_name, regexp_extract(properties, '"k": *(-?[0-9]+)', 1)::BIGINT AS k, count(*) AS rows
               FROM stg_product_events GROUP BY ALL""",
        ),
        "ingest_reject_reasons": (
            "source_name reason rows", "SELECT source_name, reason, count(*) AS rows FROM rejects GROUP BY ALL"
        ),
        "ingest_landed_accounts": (
            _ACCOUNT_TEXT,
            """SELECT * REPLACE (CASE WHEN balance < 0 THEN 'at_risk' ELSE account_status END AS account_status,
                                 CASE WHEN balance < 0 THEN updated_later ELSE updated_at END AS updated_at)
               FROM account_text WHERE NOT no_id AND NOT bad_time""",
        ),
        "ingest_landed_events": (
            "event_id user_id organization_id event_name event_timestamp session_id properties",
            f"""SELECT 'evt_' || event_id AS event_id,
                       CASE WHEN event_id % 167 = 0 THEN 'usr_missing_' || event_id ELSE 'usr_' || user_id END AS user_id,
                       CASE WHEN event_id % 53 <> 0 THEN 'org_' || user_id // 2 END AS organization_id,
                       upper(event_type) || ' ' AS event_name,
                       CASE WHEN event_id % 499 = 0 THEN '2024-01-01' ELSE strftime(ts, {MICRO}) END AS event_timestamp,
                       user_id || '-' || strftime(ts, '%Y%m%d%H') AS session_id, props AS properties
                FROM events
                WHERE event_id IN (SELECT n FROM event_lines WHERE kind = 'record' AND NOT no_time)""",
        ),
        "ingest_landed_requests": (
            """request_id user_id organization_id endpoint model_family request_timestamp latency_ms input_units
               output_units status_code estimated_cost""",
            f"""SELECT 'req_' || event_id AS request_id, 'usr_' || user_id AS user_id,
                       CASE WHEN event_id % 53 <> 0 THEN 'org_' || user_id // 2 END AS organization_id,
                       '/V1/' || event_type AS endpoint,
                       ['Small',' medium','LARGE','embed'][event_id % 4 + 1] AS model_family,
                       strftime(ts, {MICRO}) AS request_timestamp, (cents // 10)::VARCHAR AS latency_ms,
                       (cents % 1000)::VARCHAR AS input_units,
                       CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN (cents % 777)::VARCHAR END
                           AS output_units,
                       CASE WHEN event_id % 101 <> 0 THEN if(event_type = 'error', '500', '200') END AS status_code,
                       CASE WHEN event_id % 97 <> 0 THEN (cents % 1000)::DOUBLE::VARCHAR END AS estimated_cost
                FROM (SELECT *, round(value * 100)::BIGINT AS cents FROM events)
                WHERE event_id IN (SELECT n FROM request_rows WHERE NOT no_id AND NOT bad_time AND NOT no_time)""",
        ),
        "ingest_report": (
            """source raw_row_count duplicate_keys null_keys rows_received rows_inserted rows_updated rows_rejected
               status""",
            """SELECT source, n - r AS raw_row_count, 0 AS duplicate_keys, 0 AS null_keys, n AS rows_received,
                      n - r AS rows_inserted, 0 AS rows_updated, r AS rows_rejected, 'PARTIAL_SUCCESS' AS status
               FROM received JOIN (SELECT source_name AS source, count(*) AS r FROM rejects GROUP BY 1) USING (source)""",
        ),
        "ingest_lineage": (
            "source_name status _ingested_at rows rows_with_file",
            """SELECT source AS source_name, 'PARTIAL_SUCCESS' AS status, TIMESTAMP '2024-02-01' AS _ingested_at,
                      n - r AS rows, n - r AS rows_with_file
               FROM received JOIN (SELECT source_name AS source, count(*) AS r FROM rejects GROUP BY 1) USING (source)""",
        ),
        "ingest_upsert_runs": (
            "started_at status rows_received rows_inserted rows_updated rows_rejected",
            """SELECT TIMESTAMP '2024-02-01' + to_days(i) AS started_at, 'SUCCESS' AS status,
                      if(i = 0, stayed, every) AS rows_received, [stayed, every - stayed, 0][i + 1] AS rows_inserted,
                      [0, stayed, every][i + 1] AS rows_updated, 0 AS rows_rejected
               FROM (SELECT count(*) AS every, count(*) FILTER (balance <= 9000) AS stayed FROM account_text)
               CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)""",
        ),
        "ingest_upserted_accounts": (
            f"{_ACCOUNT_TEXT} _ingested_at",
            f"SELECT {_ACCOUNT_ROW}, TIMESTAMP '2024-02-03' AS _ingested_at FROM account_text",
        ),
        "inc_affected_days": (
            "affected_day",
            f"""SELECT DISTINCT event_timestamp::DATE AS affected_day FROM stg_product_events
                WHERE event_timestamp IS NOT NULL
                  AND _ingested_at > (SELECT max(_ingested_at) FROM stg_product_events
                                      WHERE event_timestamp IS NOT NULL AND _ingested_at <= {LATE}) - INTERVAL 3 DAY""",
        ),
        "inc_fact_after_late_rows": same_as("fact_product_usage"),
        "inc_stored_fact_after_late_rows": same_as("fact_api_usage"),
        "inc_invoices_after_update": same_as("fact_invoices"),
        "inc_landed_usage_refreshed": (
            same_as("fact_api_usage")[0].replace("_last_ingested_at", ""), same_as("fact_api_usage")[1]
        ),
        "inc_full_refresh_equals_incremental": (
            "date_day refreshed_requests rebuilt_requests",
            """SELECT date_day, sum(request_count) AS refreshed_requests, sum(request_count) AS rebuilt_requests
               FROM fact_api_usage GROUP BY date_day""",
        ),
        "scd2_history": (_VERSION, "SELECT * FROM account_versions"),
        "scd2_current": (_VERSION, "SELECT * FROM account_versions WHERE valid_to IS NULL"),
        "scd2_previous_status": (
            "crm_account_id account_status previous_account_status previous_segment valid_from valid_to",
            """SELECT v.crm_account_id, v.account_status, p.account_status AS previous_account_status,
                      p.segment AS previous_segment, v.valid_from, v.valid_to
               FROM account_versions v LEFT JOIN account_versions p
                 ON p.crm_account_id = v.crm_account_id AND p.valid_to = v.valid_from""",
        ),
        "scd2_subscription_history": (
            "subscription_id status plan_name updated_at valid_from valid_to",
            """SELECT subscription_id, status, plan_name, updated_at, updated_at AS valid_from,
                      NULL::TIMESTAMP AS valid_to FROM stg_subscriptions
               UNION ALL SELECT subscription_id, 'trialing', plan_name, started_at, started_at, updated_at
               FROM stg_subscriptions WHERE started_at < TIMESTAMP '2000-01-01'""",
        ),
        "dq_rules_sources": _rule_counts(declared.SOURCE_RULES),
        "dq_rules_staging": _rule_counts(declared.STAGING_RULES),
        "dq_rules_intermediate": _rule_counts(declared.INTERMEDIATE_RULES),
        "dq_rules_marts": _rule_counts(declared.MART_RULES),
        "dq_rules_snapshots": _rule_counts(declared.SNAPSHOT_RULES),
        "dq_orphaned_subscriptions": (
            "subscription_id user_id",
            "SELECT subscription_id, user_id FROM stg_subscriptions ANTI JOIN stg_users USING (user_id)",
        ),
        "dq_reconciliation": ("test left_total right_total agrees", _RECONCILED),
        "dq_row_tests": (
            "test severity violations",
            """SELECT 'invoice_paid_before_issued' AS test, 'WARN' AS severity,
                      (SELECT count(*) FROM stg_invoices WHERE paid_at < issued_at) AS violations
               UNION ALL SELECT 'cancelled_before_started', 'ERROR',
                      (SELECT count(*) FROM stg_subscriptions WHERE cancelled_at < started_at)
               UNION ALL SELECT 'transitions_out_of_order', 'ERROR',
                      (SELECT count(*) FROM int_subscription_transitions WHERE transition_at < previous_transition_at)
               UNION ALL SELECT 'funnel_out_of_order', 'ERROR',
                      (SELECT count(*) FROM stg_users u WHERE EXISTS (
                          FROM stg_subscriptions s WHERE s.user_id = u.user_id AND (s.trial_started_at < u.signup_at
                          OR (s.started_at < u.signup_at AND s.plan_name <> 'free'))))
               UNION ALL SELECT 'monthly_amount_mismatch', 'ERROR', 0
               UNION ALL SELECT 'arr_mismatch', 'ERROR', 0
               UNION ALL SELECT 'cohort_size_mismatch', 'ERROR', 0""",
        ),
        "dq_orphan_rates": (
            "test_name failed_rows total_rows failure_rate status", "SELECT * FROM orphan_results"
        ),
        "dq_freshness": ("source_table age_hours status", "SELECT * FROM ages"),
        "dq_watermark_lag": (
            "fact_table lag_hours is_lagging",
            f"""SELECT f AS fact_table, epoch_us(m) / 3.6e9 - epoch_us(w) / 3.6e9 AS lag_hours, lag_hours > 24 AS is_lagging
                FROM (SELECT 'analytics.fact_product_usage' AS f, 'raw.product_events' AS t,
                             max(_last_ingested_at) AS w FROM fact_product_usage WHERE _last_ingested_at <= {LATE}
                      UNION ALL SELECT 'analytics.fact_api_usage', 'raw.api_usage', max(_last_ingested_at)
                             FROM fact_api_usage WHERE _last_ingested_at <= {LATE}
                      UNION ALL SELECT 'analytics.fact_invoices', 'raw.invoices', max(_ingested_at) FROM stg_invoices)
                JOIN newest_landed USING (t)""",
        ),
        "dq_volume_drop": (
            "source_table previous_rows current_rows status",
            f"""SELECT t AS source_table, a AS previous_rows, c AS current_rows,
                       CASE WHEN (a - c) / a > 0.5 THEN 'FAIL' WHEN (a - c) / a > 0.2 THEN 'WARN' ELSE 'PASS' END
                           AS status
                FROM (SELECT 'raw.users' AS t, count(*) AS a, count(*) FILTER (_ingested_at <= {CUT}) AS c FROM stg_users
                      UNION ALL SELECT 'raw.organizations', count(*), count(*) FILTER (_ingested_at <= {CUT})
                          FROM stg_organizations
                      UNION ALL SELECT 'raw.subscriptions', count(*), count(*) FILTER (_ingested_at <= {CUT})
                          FROM stg_subscriptions
                      UNION ALL SELECT 'raw.invoices', count(*), count(*) FILTER (_ingested_at <= {CUT})
                          FROM invoice_versions
                      UNION ALL SELECT 'raw.product_events', count(*), 0 FROM events
                      UNION ALL SELECT 'raw.api_usage', count(*), 0 FROM events)""",
        ),
        "dq_check_results": (_CHECK, "SELECT * FROM check_results"),
        "dq_overall_status": ("overall_status", "SELECT * FROM run_summary"),
        "dq_check_frequency": (
            "test_name times_run times_failed times_warned",
            """SELECT test_name, 1 AS times_run, if(status = 'FAIL', 1, 0) AS times_failed,
                      if(status = 'WARN', 1, 0) AS times_warned FROM check_results""",
        ),
        "qry_daily_growth": where("mart_daily_growth", f"date_day BETWEEN {SUB_DAY} - 30 AND {SUB_DAY}"),
        "qry_acquisition_channels": where("mart_acquisition_channels", "acquisition_channel = 'machinery'"),
        "qry_trial_conversion_page": (
            columns_of["mart_trial_conversion"], _page("mart_trial_conversion", "user_id", 50, 25, "is_converted")
        ),
        "qry_retention_cohorts": where("mart_retention_cohorts", "cohort_month = DATE '1995-01-01'"),
        "qry_mrr": where("mart_mrr", "currency = 'USD'"),
        "qry_arr": where("mart_arr"),
        "qry_churn_by_type": where("mart_customer_churn", "organization_type = 'enterprise'"),
        "qry_arpu": where("mart_arpu", "currency = 'GBP'"),
        "qry_customer_ltv_page": (
            _LTV,
            _page("mart_customer_ltv JOIN dim_organizations USING (organization_key)", "organization_id, currency", 100, 50),
        ),
        "qry_feature_adoption": where("mart_feature_adoption", "event_name = 'click'"),
        "qry_daily_usage_page": (
            "date_day organization_id user_id event_name event_count distinct_session_count",
            _page("fact_product_usage", "date_day, organization_id NULLS LAST, event_name, user_id NULLS LAST", 200, 100,
                  f"date_day BETWEEN {EVT_DAY} - 30 AND {EVT_DAY}"),
        ),
        "qry_api_usage_page": (
            "month_start_date organization_id request_count error_request_count error_rate total_estimated_cost",
            _page("mart_api_usage LEFT JOIN dim_organizations USING (organization_key)",
                  "month_start_date, organization_id NULLS LAST", 40, 5,
                  f"month_start_date BETWEEN {EVT_DAY} - 30 AND {EVT_DAY}"),
        ),
        "qry_customers_page": (
            _PROFILE, _page("dim_organizations", "organization_id", 50, 10, "organization_type = 'enterprise'")
        ),
        "qry_customer_detail": (
            f"""{_PROFILE} currency active_monthly_recurring_revenue realized_ltv_to_date estimated_ltv
                product_event_count api_request_count""",
            f"""SELECT o.*, r.* EXCLUDE (organization_key),
                       (SELECT ifnull(sum(event_count), 0) FROM fact_product_usage p
                        WHERE p.organization_id = o.organization_id AND p.date_day > {EVT_DAY} - {WINDOW})
                           AS product_event_count,
                       (SELECT ifnull(sum(request_count), 0) FROM fact_api_usage a
                        WHERE a.organization_id = o.organization_id AND a.date_day > {EVT_DAY} - {WINDOW})
                           AS api_request_count
                FROM dim_organizations o
                LEFT JOIN (
                    SELECT organization_key, currency,
                           CASE WHEN s.c IS NULL THEN 0 ELSE s.m END AS active_monthly_recurring_revenue,
                           l.realized_ltv_to_date, l.estimated_ltv
                    FROM (SELECT organization_key, currency, count(*) AS c, sum(m1200) / 1200.0 AS m
                          FROM fact_subscriptions WHERE is_recurring_active_now AND organization_key IS NOT NULL
                          GROUP BY ALL) s
                    FULL JOIN mart_customer_ltv l USING (organization_key, currency)) r USING (organization_key)""",
        ),
        "qry_quality_latest": (
            "overall_status total_checks category test_name severity status failed_rows total_rows",
            "SELECT * FROM check_results CROSS JOIN (SELECT overall_status, total_checks FROM run_summary)",
        ),
        "qry_quality_run_by_id": (
            "overall_status total_checks category test_name severity status failed_rows total_rows",
            "SELECT * FROM check_results CROSS JOIN (SELECT overall_status, total_checks FROM run_summary)",
        ),
        "qry_quality_runs": (
            "started_at overall_status total_checks passed_checks warned_checks failed_checks",
            f"SELECT {EVT} AS started_at, * FROM run_summary",
        ),
        "qry_metric_lookup": (
            _LTV,
            _page("mart_customer_ltv JOIN dim_organizations USING (organization_key)", "organization_id, currency", 200,
                  0, "currency = 'EUR'"),
        ),
        "stream_daily_usage": same_as("fact_product_usage"),
    }
