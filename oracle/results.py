"""The checked queries: their columns, and the SQL over ``oracle.tables``."""

from oracle import scenarios

_LINEAGE = "_ingested_at _source_file _run_id"

MODEL_COLUMNS = {
    "stg_organizations": f"""organization_id organization_name domain country_code is_country_code_recognized
        organization_type is_organization_type_unknown created_at updated_at {_LINEAGE}""",
    "stg_users": f"""user_id organization_id email is_email_valid country_code is_country_code_recognized signup_at
        acquisition_channel status is_status_unknown created_at updated_at {_LINEAGE}""",
    "stg_subscriptions": f"""subscription_id user_id organization_id plan_name is_plan_missing billing_interval status
        is_status_unknown currency is_currency_recognized subscription_amount started_at trial_started_at
        trial_ended_at cancelled_at current_period_start current_period_end updated_at {_LINEAGE}""",
    "stg_invoices": f"""invoice_id subscription_id customer_id currency is_currency_recognized subtotal_amount
        tax_amount total_amount status is_status_unknown is_paid_without_paid_at issued_at paid_at {_LINEAGE}""",
    "stg_product_events": f"""event_id user_id organization_id event_name event_timestamp is_event_timestamp_missing
        session_id properties {_LINEAGE}""",
    "stg_api_usage": f"""request_id user_id organization_id endpoint model_family request_timestamp latency_ms
        input_units output_units status_code is_successful_request estimated_cost {_LINEAGE}""",
    "stg_crm_accounts": f"""crm_account_id organization_id account_status is_account_status_unknown segment owner_team
        lead_source is_lead_source_missing created_at updated_at {_LINEAGE}""",
    "stg_marketing_events": f"""marketing_event_id user_id anonymous_id campaign_id is_campaign_attributed channel
        event_type event_timestamp utm_source utm_medium utm_campaign {_LINEAGE}""",
    "int_user_subscription_history": """subscription_id user_id organization_id is_user_orphaned user_signup_at
        plan_name is_plan_missing billing_interval status is_status_unknown currency is_currency_recognized
        subscription_amount started_at trial_started_at trial_ended_at cancelled_at current_period_start
        current_period_end updated_at days_from_signup_to_subscription_start""",
    "int_user_acquisition": """user_id organization_id acquisition_channel has_known_marketing_touch
        attributed_marketing_event_id attributed_touch_at attributed_campaign_id is_campaign_attributed
        attributed_marketing_channel attributed_utm_source attributed_utm_medium attributed_utm_campaign""",
    "int_customer_revenue": """invoice_id subscription_id is_subscription_orphaned customer_id user_id plan_name
        billing_interval currency is_currency_recognized subtotal_amount tax_amount total_amount status
        is_status_unknown is_paid_without_paid_at billed_amount paid_amount outstanding_amount issued_at paid_at""",
    "int_daily_product_usage": """event_date user_id organization_id event_name event_count distinct_session_count
        first_event_at last_event_at""",
    "int_api_usage_by_customer": """usage_date organization_id is_organization_unknown request_count
        successful_request_count error_request_count error_rate total_input_units total_output_units
        total_estimated_cost avg_latency_ms""",
    "int_subscription_transitions": """subscription_id user_id organization_id transition_sequence transition_type
        transition_at previous_transition_type previous_transition_at days_since_previous_transition""",
    "int_customer_activity": """activity_date organization_id has_product_activity has_api_activity
        product_event_count api_request_count total_activity_count first_observed_activity_date
        last_observed_activity_date""",
    "int_conversion_funnel": """user_id organization_id signup_at trial_start_at paid_conversion_at
        is_trial_before_signup is_paid_conversion_before_signup is_paid_conversion_before_trial_start
        days_signup_to_trial days_trial_to_paid days_signup_to_paid""",
    "int_customer_lifecycle": """user_id organization_id first_signup_at first_trial_started_at first_paid_started_at
        first_cancelled_at most_recent_subscription_status most_recent_plan_name lifecycle_stage""",
    "dim_date": """date_day year_number quarter_number month_number month_start_date month_label week_number
        day_of_week_number is_weekend""",
    "dim_organizations": """organization_key organization_id organization_name domain organization_type is_enterprise
        is_organization_type_unknown country_code is_country_code_recognized created_at created_date""",
    "dim_plans": """plan_key plan_name billing_interval is_plan_missing observed_subscription_count
        typical_monthly_equivalent_amount""",
    "dim_users": """user_key user_id organization_id country_code is_country_code_recognized signup_at signup_date
        acquisition_channel current_status lifecycle_stage""",
    "fact_subscriptions": """subscription_id user_key is_user_orphaned organization_key is_organization_unmatched
        plan_key plan_name is_plan_missing billing_interval status is_status_unknown is_recurring_active_now currency
        is_currency_recognized subscription_amount monthly_equivalent_amount started_at trial_started_at
        trial_ended_at cancelled_at current_period_start current_period_end updated_at""",
    "fact_invoices": """invoice_id subscription_id is_subscription_orphaned organization_key is_organization_unmatched
        plan_key user_id currency is_currency_recognized subtotal_amount tax_amount total_amount status
        is_status_unknown is_paid_without_paid_at billed_amount paid_amount outstanding_amount issued_at paid_at
        _last_ingested_at""",
    "fact_product_usage": """usage_grain_key date_day user_id user_key is_user_unmatched organization_id
        organization_key is_organization_unmatched event_name event_count distinct_session_count first_event_at
        last_event_at _last_ingested_at""",
    "fact_api_usage": """usage_grain_key date_day organization_id organization_key is_organization_unknown
        is_organization_unmatched request_count successful_request_count error_request_count error_rate
        total_input_units total_output_units total_estimated_cost avg_latency_ms _last_ingested_at""",
    "mart_daily_growth": """date_day new_user_signups new_organizations cumulative_user_signups
        cumulative_organizations""",
    "mart_trial_conversion": """user_id organization_id signup_at trial_start_at paid_conversion_at is_converted
        is_observation_complete days_trial_to_paid_conversion""",
    "mart_acquisition_channels": """acquisition_channel currency signup_count trial_start_count
        paid_conversion_count trial_to_paid_conversion_rate billed_amount paid_amount""",
    "mart_retention_cohorts": "cohort_month cohort_size period_index retained_users retention_rate",
    "mart_feature_adoption": "event_name adopting_user_count total_event_count eligible_user_count adoption_rate",
    "mart_enterprise_growth": """organization_key organization_id active_subscription_count
        current_monthly_equivalent_revenue usage_last_30_days usage_prior_30_days usage_change_count
        usage_change_pct""",
    "mart_mrr": "as_of_date currency active_subscription_count mrr",
    "mart_arr": "as_of_date currency active_subscription_count mrr arr",
    "mart_arpu": "as_of_date currency mrr paying_organization_count arpu",
    "mart_customer_churn": """period_start period_end organization_type customers_active_at_start customers_churned
        churn_rate""",
    "mart_revenue_churn": """period_start period_end currency opening_recurring_revenue churned_recurring_revenue
        gross_revenue_churn_rate""",
    "mart_customer_ltv": """organization_key currency realized_ltv_to_date current_arpu platform_churn_rate
        estimated_ltv""",
    "mart_api_usage": """month_start_date organization_key request_count error_request_count error_rate
        total_estimated_cost""",
}

RESULTS: dict[str, tuple[str, str]] = {
    **{name: (columns, f"SELECT * FROM {name}") for name, columns in MODEL_COLUMNS.items()},
    **scenarios.results(MODEL_COLUMNS),
}
