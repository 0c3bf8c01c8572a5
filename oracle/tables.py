"""Common table expressions by name. ``{sub}``, ``{evt}`` are the two clocks."""

SUB = "TIMESTAMP '2001-06-01 00:00:00'"
SUB_DAY = "DATE '2001-06-01'"
EVT_DAY = "DATE '2024-01-20'"
WINDOW = 10
NULL_KEY = "_dbt_utils_surrogate_key_null_"

STAGED = {
    "first_orders": "SELECT o_custkey AS k, min(o_orderdate) AS d FROM orders GROUP BY 1",
    "people": """
        SELECT c_custkey AS n, c_custkey // 2 AS org, c_name, c_mktsegment AS seg, c_nationkey AS nation, d
        FROM customer LEFT JOIN first_orders ON k = c_custkey""",
    "stg_organizations": """
        SELECT 'org_' || org AS organization_id, 'Organization ' || org AS organization_name,
               'org' || org || '.example.com' AS domain,
               ['US','US','GB','DE','FR','ZZ'][arg_min(nation, n) % 6 + 1] AS country_code,
               arg_min(nation, n) % 6 <> 5 AS is_country_code_recognized,
               CASE WHEN org % 97 = 96 THEN 'unknown'
                    ELSE ['individual','startup','business','enterprise'][org % 4 + 1] END AS organization_type,
               org % 97 = 96 AS is_organization_type_unknown,
               min(d) - INTERVAL 60 DAY AS created_at, min(d) - INTERVAL 50 DAY AS updated_at,
               min(d) - INTERVAL 60 DAY + to_days((org % 5)::INT) AS _ingested_at,
               'organizations.csv' AS _source_file, 'run_bound' AS _run_id
        FROM people GROUP BY org""",
    "stg_users": """
        SELECT 'usr_' || n AS user_id,
               CASE WHEN n % 167 = 0 THEN 'org_missing_' || n ELSE 'org_' || org END AS organization_id,
               lower(replace(c_name, '#', '.') || CASE WHEN n % 67 = 0 THEN ' at ' ELSE '@' END || seg || '.example')
                   AS email,
               n % 67 <> 0 AS is_email_valid,
               ['US','US','GB','DE','FR','ZZ'][nation % 6 + 1] AS country_code,
               nation % 6 <> 5 AS is_country_code_recognized,
               d - to_days((n % 21)::INT) AS signup_at, lower(seg) AS acquisition_channel,
               ['active','churned','trial','unknown'][n % 4 + 1] AS status, n % 4 = 3 AS is_status_unknown,
               d - to_days((n % 21)::INT) AS created_at, d - to_days((n % 21)::INT) + INTERVAL 5 DAY AS updated_at,
               d - to_days((n % 21)::INT) + to_days((n % 5)::INT) AS _ingested_at,
               'users.csv' AS _source_file, 'run_bound' AS _run_id
        FROM people""",
    "stg_subscriptions": """
        SELECT 'sub_' || n AS subscription_id,
               CASE WHEN n % 167 = 0 THEN 'usr_missing_' || n ELSE 'usr_' || c END AS user_id,
               CASE WHEN c % 167 = 0 THEN 'org_missing_' || c ELSE 'org_' || c // 2 END AS organization_id,
               plan AS plan_name, plan IS NULL AS is_plan_missing,
               CASE WHEN n % 10 < 3 THEN 'annual' ELSE 'monthly' END AS billing_interval,
               CASE WHEN n % 331 = 0 THEN 'unknown' WHEN s = 'O' THEN 'active' WHEN s = 'F' THEN 'canceled'
                    WHEN n % 2 = 0 THEN 'trialing' ELSE 'past_due' END AS status,
               n % 331 = 0 AS is_status_unknown,
               CASE WHEN c % 10 < 7 THEN 'USD' WHEN c % 10 < 9 THEN 'EUR' ELSE 'GBP' END AS currency,
               true AS is_currency_recognized,
               CASE WHEN n % 457 <> 0 THEN price::DECIMAL(18,2) END AS subscription_amount,
               t AS started_at,
               CASE WHEN n % 5 < 3 AND p <> '5' THEN t - INTERVAL 14 DAY END AS trial_started_at,
               CASE WHEN n % 5 < 3 AND p <> '5' THEN t END AS trial_ended_at,
               CASE WHEN s = 'F' THEN t + to_days((7 + n % 393)::INT) END AS cancelled_at,
               t AS current_period_start,
               t + to_days(CASE WHEN n % 10 < 3 THEN 365 ELSE 30 END) AS current_period_end,
               t + INTERVAL 30 DAY AS updated_at,
               t + to_days((n % 5)::INT) AS _ingested_at,
               'subscriptions.csv' AS _source_file, 'run_bound' AS _run_id
        FROM (SELECT o_orderkey AS n, o_custkey AS c, o_orderstatus AS s, o_totalprice AS price, o_orderdate AS t,
                     left(o_orderpriority, 1) AS p,
                     CASE left(o_orderpriority, 1) WHEN '1' THEN 'enterprise' WHEN '2' THEN 'business'
                          WHEN '3' THEN 'pro' WHEN '5' THEN 'free' END AS plan FROM orders)""",
    "invoice_lines": """
        SELECT l_orderkey AS n, l_linenumber AS line, l_returnflag AS f, l_suppkey AS s, l_shipdate AS t,
               l_extendedprice::DECIMAL(18,2) AS sub,
               (l_extendedprice::DECIMAL(18,2) * (1 + l_tax::DECIMAL(4,2)))::DECIMAL(18,2) AS tot
        FROM lineitem""",
    "invoice_versions": """
        SELECT 'inv_' || n || '_' || line AS invoice_id,
               CASE WHEN n % 163 = 0 THEN 'sub_missing_' || n ELSE 'sub_' || n END AS subscription_id,
               'org_' || s // 2 AS customer_id,
               CASE WHEN n % 499 = 7 THEN NULL WHEN n % 331 = 0 THEN 'XXX' WHEN n % 10 < 7 THEN 'USD'
                    WHEN n % 10 < 9 THEN 'EUR' ELSE 'GBP' END AS currency,
               sub AS subtotal_amount, CASE WHEN n % 457 <> 0 THEN tot - sub END AS tax_amount, tot AS total_amount,
               CASE WHEN n % 331 = 0 AND line = 1 THEN 'unknown' WHEN line = 7 THEN 'void' WHEN f = 'N' THEN 'paid'
                    WHEN f = 'A' THEN 'open' ELSE 'failed' END AS status,
               t AS issued_at,
               CASE WHEN f = 'N' AND line <> 7 AND n % 101 <> 0 THEN t + to_days(line) END AS paid_at,
               t + to_days((n % 5)::INT) AS _ingested_at
        FROM invoice_lines""",
    "stg_invoices": """
        SELECT invoice_id, subscription_id, customer_id, currency,
               CASE WHEN currency IS NOT NULL THEN currency <> 'XXX' END AS is_currency_recognized,
               subtotal_amount, tax_amount, total_amount, status, status = 'unknown' AS is_status_unknown,
               status = 'paid' AND paid_at IS NULL AS is_paid_without_paid_at, issued_at, paid_at, _ingested_at,
               'invoices.csv' AS _source_file, 'run_bound' AS _run_id
        FROM invoice_versions
        QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY _ingested_at DESC NULLS LAST,
            subscription_id DESC NULLS LAST, customer_id DESC NULLS LAST, currency DESC NULLS LAST,
            subtotal_amount DESC NULLS LAST, tax_amount DESC NULLS LAST, total_amount DESC NULLS LAST,
            status DESC NULLS LAST, issued_at DESC NULLS LAST, paid_at DESC NULLS LAST) = 1""",
    "stg_product_events": """
        SELECT 'evt_' || event_id AS event_id,
               CASE WHEN event_id % 167 = 0 THEN 'usr_missing_' || event_id ELSE 'usr_' || user_id END AS user_id,
               CASE WHEN event_id % 53 <> 0 THEN 'org_' || user_id // 2 END AS organization_id,
               event_type AS event_name, CASE WHEN event_id % 499 <> 0 THEN ts END AS event_timestamp,
               event_id % 499 = 0 AS is_event_timestamp_missing,
               user_id || '-' || strftime(ts, '%Y%m%d%H') AS session_id, props AS properties,
               ts + to_days((event_id % 5)::INT) AS _ingested_at,
               'product_events.jsonl' AS _source_file, 'run_bound' AS _run_id
        FROM events""",
    "stg_api_usage": """
        SELECT 'req_' || event_id AS request_id, 'usr_' || user_id AS user_id,
               CASE WHEN event_id % 53 <> 0 THEN 'org_' || user_id // 2 END AS organization_id,
               '/v1/' || event_type AS endpoint,
               ['small','medium','large','embed'][event_id % 4 + 1] AS model_family, ts AS request_timestamp,
               cents // 10 AS latency_ms, cents % 1000 AS input_units,
               CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN cents % 777 END AS output_units,
               CASE WHEN event_id % 101 <> 0 THEN CASE WHEN event_type = 'error' THEN 500 ELSE 200 END END
                   AS status_code,
               CASE WHEN event_id % 101 <> 0 THEN event_type <> 'error' END AS is_successful_request,
               cents::DECIMAL(12,0) * 0.00001::DECIMAL(6,5) AS estimated_cost,
               ts + to_days((event_id % 5)::INT) AS _ingested_at,
               'api_usage.parquet' AS _source_file, 'run_bound' AS _run_id
        FROM (SELECT *, round(value * 100)::BIGINT AS cents FROM events)""",
    "crm_first": """
        SELECT 'crm_' || s_suppkey AS crm_account_id,
               CASE WHEN s_suppkey % 41 = 0 THEN 'org_missing_' || s_suppkey ELSE 'org_' || s_suppkey END
                   AS organization_id,
               CASE WHEN s_nationkey % 2 = 0 THEN 'prospect' ELSE 'active' END AS account_status,
               false AS is_account_status_unknown,
               ['smb','mid_market','enterprise','unknown'][s_suppkey % 4 + 1] AS segment,
               ['sales','success'][s_suppkey % 2 + 1] AS owner_team,
               ['web',NULL,'referral'][s_suppkey % 3 + 1] AS lead_source,
               s_suppkey % 3 = 1 AS is_lead_source_missing,
               TIMESTAMP '1999-01-01 00:00:00' AS created_at,
               TIMESTAMP '1999-01-01 00:00:00' + to_days((1 + s_suppkey % 300)::INT) AS updated_at,
               TIMESTAMP '1999-01-01 00:00:00' + to_days((1 + s_suppkey % 300 + s_suppkey % 5)::INT) AS _ingested_at,
               'crm_accounts.csv' AS _source_file, 'run_bound' AS _run_id, s_acctbal AS balance
        FROM supplier""",
    "crm_second": """
        SELECT * REPLACE (
               CASE WHEN balance < 0 THEN 'at_risk' ELSE account_status END AS account_status,
               CASE WHEN balance < 0 THEN updated_at + INTERVAL 365 DAY ELSE updated_at END AS updated_at,
               _ingested_at + INTERVAL 400 DAY AS _ingested_at)
        FROM crm_first WHERE balance <= 9000""",
    "stg_crm_accounts": """
        SELECT * EXCLUDE (balance) FROM crm_second
        UNION ALL
        SELECT * EXCLUDE (balance) FROM crm_first WHERE balance > 9000""",
    "stg_marketing_events": """
        SELECT 'mkt_' || event_id AS marketing_event_id,
               CASE WHEN event_id % 20 >= 7 THEN 'usr_' || user_id END AS user_id, 'anon_' || user_id AS anonymous_id,
               CASE WHEN event_id % 7 <> 0 THEN 'cmp_' || regexp_extract(props, '"k": *(-?[0-9]+)', 1) END
                   AS campaign_id,
               event_id % 7 <> 0 AS is_campaign_attributed,
               ['search','social','email'][event_id % 3 + 1] AS channel,
               CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click'
                    WHEN 'signup' THEN 'signup_complete' WHEN 'purchase' THEN 'signup_start' ELSE event_type END
                   AS event_type,
               ts AS event_timestamp, ['google','facebook','newsletter'][event_id % 3 + 1] AS utm_source,
               ['cpc','organic'][event_id % 2 + 1] AS utm_medium,
               CASE WHEN event_id % 11 <> 0 THEN 'wave_' || event_id % 5 END AS utm_campaign,
               ts + to_days((event_id % 5)::INT) AS _ingested_at,
               'marketing_events.csv' AS _source_file, 'run_bound' AS _run_id
        FROM events""",
}

INTERMEDIATE = {
    "int_user_subscription_history": """
        SELECT s.* EXCLUDE (_ingested_at, _source_file, _run_id), u.user_id IS NULL AND s.user_id IS NOT NULL
                   AS is_user_orphaned,
               u.signup_at AS user_signup_at,
               extract(day FROM s.started_at - u.signup_at) AS days_from_signup_to_subscription_start
        FROM stg_subscriptions s LEFT JOIN stg_users u USING (user_id)""",
    "int_user_acquisition": """
        SELECT u.user_id, u.organization_id, u.acquisition_channel, m.k IS NOT NULL AS has_known_marketing_touch,
               m.marketing_event_id AS attributed_marketing_event_id, m.event_timestamp AS attributed_touch_at,
               m.campaign_id AS attributed_campaign_id, m.campaign_id IS NOT NULL AS is_campaign_attributed,
               m.channel AS attributed_marketing_channel, m.utm_source AS attributed_utm_source,
               m.utm_medium AS attributed_utm_medium, m.utm_campaign AS attributed_utm_campaign
        FROM stg_users u
        LEFT JOIN (SELECT DISTINCT ON (user_id) user_id AS k, * FROM stg_marketing_events WHERE user_id IS NOT NULL
                   ORDER BY user_id, event_timestamp NULLS LAST, marketing_event_id) m ON m.k = u.user_id""",
    "int_customer_revenue": """
        SELECT i.invoice_id, i.subscription_id,
               i.subscription_id NOT IN (SELECT subscription_id FROM stg_subscriptions) AS is_subscription_orphaned,
               ifnull(s.organization_id, i.customer_id) AS customer_id, s.user_id, s.plan_name, s.billing_interval,
               i.currency, i.is_currency_recognized, i.subtotal_amount, i.tax_amount, i.total_amount, i.status,
               i.is_status_unknown, i.is_paid_without_paid_at, i.total_amount AS billed_amount,
               if(i.status = 'paid', i.total_amount, 0) AS paid_amount,
               if(i.status IN ('open', 'failed'), i.total_amount, 0) AS outstanding_amount, i.issued_at, i.paid_at
        FROM stg_invoices i LEFT JOIN stg_subscriptions s USING (subscription_id)""",
    "int_daily_product_usage": """
        SELECT event_timestamp::DATE AS event_date, user_id, organization_id, event_name, count(*) AS event_count,
               count(DISTINCT session_id) AS distinct_session_count, min(event_timestamp) AS first_event_at,
               max(event_timestamp) AS last_event_at
        FROM stg_product_events WHERE event_timestamp IS NOT NULL GROUP BY ALL""",
    "int_api_usage_by_customer": """
        SELECT request_timestamp::DATE AS usage_date, organization_id,
               organization_id IS NULL AS is_organization_unknown, count(*) AS request_count,
               sum(is_successful_request::INT) FILTER (is_successful_request IS NOT NULL) AS ok,
               ifnull(ok, 0) AS successful_request_count, count(*) FILTER (status_code = 500) AS error_request_count,
               count(*) FILTER (status_code = 500)::DOUBLE / count(*) AS error_rate, sum(input_units) AS total_input_units,
               sum(output_units) AS total_output_units, sum(estimated_cost) AS total_estimated_cost,
               avg(latency_ms) AS avg_latency_ms
        FROM stg_api_usage GROUP BY ALL""",
    "int_subscription_transitions": """
        SELECT subscription_id, user_id, organization_id,
               row_number() OVER chain AS transition_sequence, kind AS transition_type, moment AS transition_at,
               lag(kind) OVER chain AS previous_transition_type, lag(moment) OVER chain AS previous_transition_at,
               extract(day FROM moment - lag(moment) OVER chain) AS days_since_previous_transition
        FROM (SELECT subscription_id, user_id, organization_id,
                     unnest(['trial_started','trial_ended','subscription_started','subscription_cancelled']) AS kind,
                     unnest([trial_started_at, trial_ended_at, started_at, cancelled_at]) AS moment,
                     unnest([1, 2, 3, 4]) AS place
              FROM stg_subscriptions)
        WHERE moment IS NOT NULL
        WINDOW chain AS (PARTITION BY subscription_id ORDER BY moment, place)""",
    "int_customer_activity": """
        SELECT *, product_event_count + api_request_count AS total_activity_count,
               min(activity_date) OVER org AS first_observed_activity_date,
               max(activity_date) OVER org AS last_observed_activity_date
        FROM (SELECT activity_date, organization_id, e IS NOT NULL AS has_product_activity,
                     r IS NOT NULL AS has_api_activity, ifnull(e, 0) AS product_event_count,
                     ifnull(r, 0) AS api_request_count
              FROM (SELECT event_date AS activity_date, organization_id, sum(event_count) AS e
                    FROM int_daily_product_usage WHERE organization_id IS NOT NULL GROUP BY ALL)
              FULL JOIN (SELECT usage_date AS activity_date, organization_id, request_count AS r
                         FROM int_api_usage_by_customer WHERE organization_id IS NOT NULL)
              USING (activity_date, organization_id))
        WINDOW org AS (PARTITION BY organization_id)""",
    "int_conversion_funnel": """
        SELECT user_id, organization_id, signup_at, trial_start_at, paid_conversion_at,
               trial_start_at IS NOT NULL AND trial_start_at < signup_at AS is_trial_before_signup,
               paid_conversion_at IS NOT NULL AND paid_conversion_at < signup_at AS is_paid_conversion_before_signup,
               ifnull(paid_conversion_at < trial_start_at, false) AS is_paid_conversion_before_trial_start,
               extract(day FROM trial_start_at - signup_at) AS days_signup_to_trial,
               extract(day FROM paid_conversion_at - trial_start_at) AS days_trial_to_paid,
               extract(day FROM paid_conversion_at - signup_at) AS days_signup_to_paid
        FROM stg_users
        LEFT JOIN (SELECT user_id, min(trial_started_at) AS trial_start_at FROM stg_subscriptions GROUP BY 1)
            USING (user_id)
        LEFT JOIN (SELECT user_id, min(started_at) AS paid_conversion_at FROM stg_subscriptions
                   WHERE plan_name IN ('enterprise', 'business', 'pro') GROUP BY 1) USING (user_id)""",
    "int_customer_lifecycle": """
        SELECT f.user_id, f.organization_id, f.signup_at AS first_signup_at,
               f.trial_start_at AS first_trial_started_at, f.paid_conversion_at AS first_paid_started_at,
               (SELECT min(cancelled_at) FROM stg_subscriptions x WHERE x.user_id = f.user_id) AS first_cancelled_at,
               l.status AS most_recent_subscription_status, l.plan_name AS most_recent_plan_name,
               ifnull(l.status, 'no_subscription') AS lifecycle_stage
        FROM int_conversion_funnel f
        LEFT JOIN (SELECT user_id, status, plan_name FROM stg_subscriptions
                   QUALIFY row_number() OVER (PARTITION BY user_id
                       ORDER BY updated_at DESC NULLS LAST, subscription_id DESC) = 1) l USING (user_id)""",
}

DIMENSIONS = {
    "dim_date": f"""
        SELECT d AS date_day, year(d) AS year_number, quarter(d) AS quarter_number, month(d) AS month_number,
               date_trunc('month', d)::DATE AS month_start_date, strftime(d, '%Y-%m') AS month_label,
               weekofyear(d) AS week_number, isodow(d) AS day_of_week_number, isodow(d) > 5 AS is_weekend
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d
              FROM (SELECT min(t)::DATE AS lo, greatest(max(t) FILTER (top), {SUB})::DATE AS hi FROM (
                  SELECT signup_at AS t, false AS top FROM stg_users
                  UNION ALL SELECT started_at, false FROM stg_subscriptions
                  UNION ALL SELECT unnest([cancelled_at, current_period_end]), true FROM stg_subscriptions
                  UNION ALL SELECT issued_at, true FROM stg_invoices
                  UNION ALL SELECT event_timestamp, true FROM stg_product_events
                  UNION ALL SELECT request_timestamp, true FROM stg_api_usage)))""",
    "dim_organizations": """
        SELECT md5(organization_id) AS organization_key, organization_id, organization_name, domain,
               organization_type, organization_type = 'enterprise' AS is_enterprise, is_organization_type_unknown,
               country_code, is_country_code_recognized, created_at, created_at::DATE AS created_date
        FROM stg_organizations""",
    "dim_plans": """
        SELECT md5(p || '-' || billing_interval) AS plan_key, p AS plan_name, billing_interval,
               p = 'unknown' AS is_plan_missing, count(*) AS observed_subscription_count,
               avg(subscription_amount::DOUBLE) / if(billing_interval = 'annual', 12, 1)
                   AS typical_monthly_equivalent_amount
        FROM (SELECT ifnull(plan_name, 'unknown') AS p, * FROM stg_subscriptions) GROUP BY p, billing_interval""",
    "dim_users": """
        SELECT md5(u.user_id) AS user_key, u.user_id, u.organization_id, u.country_code, u.is_country_code_recognized,
               u.signup_at, u.signup_at::DATE AS signup_date, u.acquisition_channel, u.status AS current_status,
               l.lifecycle_stage
        FROM stg_users u JOIN int_customer_lifecycle l USING (user_id)""",
}

FACTS = {
    # m1200 is the monthly amount in twelfths of a cent, an exact integer.
    "fact_subscriptions": f"""
        SELECT h.subscription_id, u.user_key, h.is_user_orphaned, o.organization_key,
               o.organization_key IS NULL AND h.organization_id IS NOT NULL AS is_organization_unmatched, p.plan_key,
               h.plan_name, h.is_plan_missing, h.billing_interval, h.status, h.is_status_unknown,
               h.status = 'active' OR (h.status = 'canceled' AND h.cancelled_at > {SUB}) AS is_recurring_active_now,
               h.currency, h.is_currency_recognized, h.subscription_amount,
               (h.subscription_amount * 100)::HUGEINT * if(h.billing_interval = 'annual', 1, 12) AS m1200,
               m1200 / 1200.0 AS monthly_equivalent_amount, h.started_at, h.trial_started_at, h.trial_ended_at,
               h.cancelled_at, h.current_period_start, h.current_period_end, h.updated_at
        FROM int_user_subscription_history h
        LEFT JOIN dim_users u USING (user_id)
        LEFT JOIN dim_organizations o ON o.organization_id = h.organization_id
        LEFT JOIN dim_plans p ON p.plan_name = ifnull(h.plan_name, 'unknown')
                             AND p.billing_interval = h.billing_interval""",
    "fact_invoices": """
        SELECT r.invoice_id, r.subscription_id, r.is_subscription_orphaned, o.organization_key,
               o.organization_key IS NULL AS is_organization_unmatched, p.plan_key, r.user_id, r.currency,
               r.is_currency_recognized, r.subtotal_amount, r.tax_amount, r.total_amount, r.status,
               r.is_status_unknown, r.is_paid_without_paid_at, r.billed_amount, r.paid_amount, r.outstanding_amount,
               r.issued_at, r.paid_at, i._ingested_at AS _last_ingested_at
        FROM int_customer_revenue r JOIN stg_invoices i USING (invoice_id)
        LEFT JOIN dim_organizations o ON o.organization_id = r.customer_id
        LEFT JOIN dim_plans p ON p.plan_name = ifnull(r.plan_name, 'unknown')
                             AND p.billing_interval = r.billing_interval""",
    "fact_product_usage": """
        SELECT md5(concat_ws('-', a.date_day, ifnull(a.user_id, ''), ifnull(a.organization_id, ''), a.event_name))
                   AS usage_grain_key,
               a.date_day, a.user_id, u.user_key, a.user_id IS NOT NULL AND u.user_key IS NULL AS is_user_unmatched,
               a.organization_id, o.organization_key,
               a.organization_id IS NOT NULL AND o.organization_key IS NULL AS is_organization_unmatched,
               a.* EXCLUDE (date_day, user_id, organization_id)
        FROM (SELECT event_timestamp::DATE AS date_day, user_id, organization_id, event_name,
                     count(*) AS event_count, count(DISTINCT session_id) AS distinct_session_count,
                     min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at,
                     max(_ingested_at) AS _last_ingested_at
              FROM stg_product_events WHERE event_timestamp IS NOT NULL GROUP BY ALL) a
        LEFT JOIN dim_users u USING (user_id)
        LEFT JOIN dim_organizations o ON o.organization_id = a.organization_id""",
    "fact_api_usage": """
        SELECT md5(concat_ws('-', a.usage_date, ifnull(a.organization_id, ''))) AS usage_grain_key,
               a.usage_date AS date_day, a.organization_id, o.organization_key, a.is_organization_unknown,
               a.organization_id IS NOT NULL AND o.organization_key IS NULL AS is_organization_unmatched,
               a.request_count, a.successful_request_count, a.error_request_count, a.error_rate, a.total_input_units,
               a.total_output_units, a.total_estimated_cost, a.avg_latency_ms, w._last_ingested_at
        FROM int_api_usage_by_customer a
        LEFT JOIN dim_organizations o ON o.organization_id = a.organization_id
        JOIN (SELECT request_timestamp::DATE AS d, organization_id AS org, max(_ingested_at) AS _last_ingested_at
              FROM stg_api_usage GROUP BY ALL) w
          ON w.d = a.usage_date AND w.org IS NOT DISTINCT FROM a.organization_id""",
}

GROWTH = {
    "mart_daily_growth": f"""
        SELECT date_day, s AS new_user_signups, c AS new_organizations,
               (SELECT count(*) FROM stg_users WHERE signup_at::DATE <= date_day) AS cumulative_user_signups,
               sum(c) OVER (ORDER BY date_day) AS cumulative_organizations
        FROM (SELECT date_day, (SELECT count(*) FROM dim_users WHERE signup_date = date_day) AS s,
                     (SELECT count(*) FROM dim_organizations WHERE created_date = date_day) AS c
              FROM dim_date WHERE date_day <= {SUB_DAY})""",
    "mart_trial_conversion": f"""
        SELECT user_id, organization_id, signup_at, trial_start_at, paid_conversion_at,
               ifnull(paid_conversion_at >= trial_start_at, false) AS is_converted,
               trial_start_at <= {SUB} - INTERVAL 30 DAY AS is_observation_complete,
               CASE WHEN paid_conversion_at >= trial_start_at THEN days_trial_to_paid END
                   AS days_trial_to_paid_conversion
        FROM int_conversion_funnel WHERE trial_start_at IS NOT NULL""",
    "mart_acquisition_channels": """
        SELECT f.*, r.currency, ifnull(r.b, 0) AS billed_amount, ifnull(r.p, 0) AS paid_amount
        FROM (SELECT acquisition_channel, count(*) AS signup_count, count(trial_start_at) AS trial_start_count,
                     count(*) FILTER (paid_conversion_at >= trial_start_at) AS paid_conversion_count,
                     count(*) FILTER (paid_conversion_at >= trial_start_at)::DOUBLE / nullif(count(trial_start_at), 0)
                         AS trial_to_paid_conversion_rate
              FROM int_conversion_funnel JOIN int_user_acquisition USING (user_id) GROUP BY 1) f
        LEFT JOIN (SELECT acquisition_channel AS ch, currency, sum(billed_amount) AS b, sum(paid_amount) AS p
                   FROM int_customer_revenue JOIN int_user_acquisition USING (user_id) GROUP BY ALL) r
          ON r.ch = f.acquisition_channel""",
    "order_activity": "SELECT 'usr_' || o_custkey AS user_id, o_orderdate::DATE AS event_date FROM orders",
    "mart_retention_cohorts": f"""
        SELECT cohort_month, n AS cohort_size, k AS period_index, count(DISTINCT a.user_id) AS retained_users,
               count(DISTINCT a.user_id)::DOUBLE / n AS retention_rate
        FROM (SELECT *, unnest(range(0, 25)) AS k
              FROM (SELECT date_trunc('month', signup_date)::DATE AS cohort_month, count(*) AS n
                    FROM dim_users WHERE signup_date IS NOT NULL GROUP BY 1))
        LEFT JOIN (SELECT user_id, date_trunc('month', signup_date)::DATE AS c, date_trunc('month', event_date) AS m
                   FROM order_activity JOIN dim_users USING (user_id)) a
          ON a.c = cohort_month AND a.m = cohort_month + to_months(k::INT)
        WHERE cohort_month + to_months(k::INT) <= date_trunc('month', {SUB_DAY})
        GROUP BY cohort_month, n, k""",
    "mart_feature_adoption": """
        SELECT event_name, count(DISTINCT user_id) AS adopting_user_count, count(*) AS total_event_count,
               (SELECT count(*) FROM customer) AS eligible_user_count,
               count(DISTINCT user_id)::DOUBLE / (SELECT count(*) FROM customer) AS adoption_rate
        FROM stg_product_events WHERE event_timestamp IS NOT NULL GROUP BY 1""",
    "mart_enterprise_growth": f"""
        SELECT organization_key, organization_id, ifnull(c, 0) AS active_subscription_count,
               amt / 1200.0 AS current_monthly_equivalent_revenue, ifnull(a, 0) AS usage_last_30_days,
               ifnull(b, 0) AS usage_prior_30_days, ifnull(a, 0) - ifnull(b, 0) AS usage_change_count,
               (ifnull(a, 0) - b)::DOUBLE / nullif(b, 0) AS usage_change_pct
        FROM dim_organizations
        LEFT JOIN (SELECT organization_key, count(*) AS c, sum(m1200) AS amt FROM fact_subscriptions
                   WHERE is_recurring_active_now GROUP BY 1) USING (organization_key)
        LEFT JOIN (SELECT organization_key, sum(n) FILTER (age BETWEEN 0 AND {WINDOW - 1}) AS a,
                          sum(n) FILTER (age BETWEEN {WINDOW} AND {2 * WINDOW - 1}) AS b
                   FROM (SELECT organization_key, event_count AS n, {EVT_DAY} - date_day AS age
                         FROM fact_product_usage
                         UNION ALL SELECT organization_key, request_count, {EVT_DAY} - date_day FROM fact_api_usage)
                   GROUP BY 1) USING (organization_key)
        WHERE is_enterprise""",
}

REVENUE = {
    "mart_mrr": f"""
        SELECT {SUB_DAY} AS as_of_date, currency, count(*) AS active_subscription_count, sum(m1200) / 1200.0 AS mrr
        FROM fact_subscriptions WHERE is_recurring_active_now AND currency IS NOT NULL GROUP BY currency""",
    "mart_arr": f"""
        SELECT {SUB_DAY} AS as_of_date, currency, count(*) AS active_subscription_count, sum(m1200) / 1200.0 AS mrr,
               sum(m1200) / 100.0 AS arr
        FROM fact_subscriptions WHERE is_recurring_active_now AND currency IS NOT NULL GROUP BY currency""",
    "mart_arpu": f"""
        SELECT {SUB_DAY} AS as_of_date, currency, sum(m1200) / 1200.0 AS mrr,
               count(DISTINCT organization_key) AS paying_organization_count,
               sum(m1200) / 1200.0 / count(DISTINCT organization_key) AS arpu
        FROM fact_subscriptions
        WHERE is_recurring_active_now AND currency IS NOT NULL AND organization_key IS NOT NULL GROUP BY currency""",
    "org_status": f"""
        SELECT s.organization_id, ifnull(o.organization_type, 'unknown') AS organization_type,
               s.organization_id NOT IN (
                   SELECT organization_id FROM int_user_subscription_history
                   WHERE organization_id IS NOT NULL
                     AND (status = 'active' OR (status = 'canceled' AND cancelled_at > {SUB}))) AS lost
        FROM (SELECT DISTINCT organization_id FROM int_user_subscription_history
              WHERE started_at <= {SUB} - INTERVAL 30 DAY
                AND ifnull(cancelled_at, TIMESTAMP '9999-01-01') > {SUB} - INTERVAL 30 DAY) s
        LEFT JOIN stg_organizations o USING (organization_id)
        WHERE s.organization_id IS NOT NULL""",
    "mart_customer_churn": f"""
        SELECT {SUB_DAY} - 30 AS period_start, {SUB_DAY} AS period_end, *,
               customers_churned::DOUBLE / nullif(customers_active_at_start, 0) AS churn_rate
        FROM (SELECT organization_type, count(*) AS customers_active_at_start, count(*) FILTER (lost) AS customers_churned
              FROM org_status GROUP BY 1
              UNION ALL SELECT 'all', count(*), count(*) FILTER (lost) FROM org_status)""",
    "mart_revenue_churn": f"""
        SELECT {SUB_DAY} - 30 AS period_start, {SUB_DAY} AS period_end, currency,
               sum(m1200) / 1200.0 AS opening_recurring_revenue,
               ifnull(sum(m1200) FILTER (NOT ifnull(is_recurring_active_now, false)), 0) / 1200.0
                   AS churned_recurring_revenue,
               ifnull(sum(m1200) FILTER (NOT ifnull(is_recurring_active_now, false)), 0) / sum(m1200)::DOUBLE
                   AS gross_revenue_churn_rate
        FROM fact_subscriptions
        WHERE currency IS NOT NULL AND m1200 IS NOT NULL AND started_at <= {SUB} - INTERVAL 30 DAY
          AND ifnull(cancelled_at, TIMESTAMP '9999-01-01') > {SUB} - INTERVAL 30 DAY
        GROUP BY currency""",
    "mart_customer_ltv": """
        SELECT l.organization_key, l.currency, l.paid AS realized_ltv_to_date, a.arpu AS current_arpu,
               c.churn_rate AS platform_churn_rate, a.arpu / nullif(c.churn_rate, 0) AS estimated_ltv
        FROM (SELECT organization_key, currency, sum(paid_amount) AS paid FROM fact_invoices
              WHERE organization_key IS NOT NULL AND currency IS NOT NULL GROUP BY ALL) l
        LEFT JOIN mart_arpu a USING (currency)
        CROSS JOIN (SELECT churn_rate FROM mart_customer_churn WHERE organization_type = 'all') c""",
    "mart_api_usage": """
        SELECT date_trunc('month', request_timestamp)::DATE AS month_start_date, o.organization_key,
               count(*) AS request_count, count(*) FILTER (status_code = 500) AS error_request_count,
               count(*) FILTER (status_code = 500)::DOUBLE / count(*) AS error_rate,
               sum(estimated_cost) AS total_estimated_cost
        FROM stg_api_usage JOIN dim_organizations o USING (organization_id) GROUP BY ALL""",
}

TABLES = {**STAGED, **INTERMEDIATE, **DIMENSIONS, **FACTS, **GROWTH, **REVENUE}
