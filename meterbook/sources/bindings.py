"""The eight landed tables of a subscription business, derived from the driver's parquet tables.

Everything is text, as a landing layer holds it, and carries dirt that follows from the keys:
padding, mixed case, unknown words, orphan keys, unparseable numbers and duplicate deliveries.
Every row of the driver's tables becomes a row here.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbook.plans.warehouse import Warehouse

SUBSCRIPTION_AS_OF = datetime(2001, 6, 1)
EVENT_AS_OF = datetime(2024, 1, 20)
EVENT_WINDOW_DAYS = 10


# SQL fragments. Each table is one projection of expressions over a driver table.


def _day_text(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def _micro_text(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def _pick(index: str, *words: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"element_at(array({listed}), cast({index} + 1 as int))"


def _after(moment: str, days: str) -> str:
    return f"({moment} + make_dt_interval(cast({days} as int)))"


def _lineage(ingested_at: str, file: str) -> list[str]:
    return [
        f"cast({ingested_at} as timestamp) as _ingested_at",
        f"'{file}' as _source_file",
        "'run_bound' as _run_id",
    ]


def _country(nation: str) -> str:
    return _pick(f"{nation} % 6", "USA", " us", "UK", "DE", "fr", "ZZ")


def _currency(bucket: str) -> str:
    return f"case when {bucket} < 7 then 'USD' when {bucket} < 9 then 'EUR' else 'GBP' end"


class Bindings:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def raw(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "organizations": self.organizations,
            "users": self.users,
            "subscriptions": self.subscriptions,
            "invoices": self.invoices,
            "product_events": self.product_events,
            "api_usage": self.api_usage,
            "crm_accounts": self.crm_accounts,
            "marketing_events": self.marketing_events,
        }

    def warehouse(self, as_of: datetime = SUBSCRIPTION_AS_OF) -> Warehouse:
        return Warehouse(self.raw(), as_of, EVENT_AS_OF, EVENT_WINDOW_DAYS, activity=self.order_activity())

    def _customers(self) -> DataFrame:
        first_orders = self._read("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
        customers = self._read("customer").withColumnRenamed("c_custkey", "n")
        return customers.join(first_orders, customers["n"] == first_orders["o_custkey"], "left")

    def organizations(self) -> DataFrame:
        grouped = (
            self._customers()
            .groupBy(F.expr("shiftright(n, 1) as org"))
            .agg(F.expr("min_by(c_nationkey, n) as nation"), F.expr("min(first_order) as first_order"))
            .selectExpr("org", "nation", "first_order - interval 60 days as created")
        )
        kind = _pick("org % 4", "individual", " Startup", "BUSINESS ", "enterprise")
        return grouped.selectExpr(
            "concat('org_', org) as organization_id",
            "concat('  Organization ', org, ' ') as organization_name",
            "concat('ORG', org, '.Example.com') as domain",
            f"{_country('nation')} as country_code",
            f"if(org % 97 = 96, 'partner', {kind}) as organization_type",
            f"{_day_text('created')} as created_at",
            f"{_day_text(_after('created', '10'))} as updated_at",
            *_lineage(_after("created", "org % 5"), "organizations.csv"),
        )

    def users(self) -> DataFrame:
        people = self._customers().selectExpr("*", f"{_after('first_order', '-(n % 21)')} as signup")
        return people.selectExpr(
            "concat('usr_', n) as user_id",
            "if(n % 167 = 0, concat('org_missing_', n), concat('org_', shiftright(n, 1))) as organization_id",
            "concat(' ', replace(c_name, '#', '.'), if(n % 67 = 0, ' at ', '@'), c_mktsegment, '.Example ') as email",
            f"{_country('c_nationkey')} as country_code",
            f"{_day_text('signup')} as signup_at",
            "concat(' ', c_mktsegment) as acquisition_channel",
            f"{_pick('n % 4', 'active', ' Churned', 'TRIAL', 'paused')} as status",
            f"{_day_text('signup')} as created_at",
            f"{_day_text(_after('signup', '5'))} as updated_at",
            *_lineage(_after("signup", "n % 5"), "users.csv"),
        )

    def subscriptions(self) -> DataFrame:
        orders = self._read("orders").selectExpr(
            "o_orderkey as n",
            "o_custkey as owner",
            "o_orderdate as t",
            "o_orderstatus as s",
            "o_totalprice as price",
            "substring(o_orderpriority, 1, 1) as priority",
            "o_orderkey % 5 < 3 and o_orderpriority not like '5%' as on_trial",
            f"{_currency('(o_custkey % 10)')} as money",
        )
        return orders.selectExpr(
            "concat('sub_', n) as subscription_id",
            "if(n % 167 = 0, concat('usr_missing_', n), concat('usr_', owner)) as user_id",
            "if(owner % 167 = 0, concat('org_missing_', owner), concat('org_', shiftright(owner, 1))) "
            "as organization_id",
            "case priority when '1' then 'enterprise' when '2' then 'business' when '3' then ' Pro ' "
            "when '5' then 'free' end as plan_name",
            "if(n % 10 < 3, 'annual', 'Monthly ') as billing_interval",
            "case when n % 331 = 0 then 'paused' when s = 'O' then 'active' when s = 'F' then ' Canceled' "
            "when n % 2 = 0 then 'trialing' else 'PAST_DUE' end as status",
            "if(n % 17 = 0, lower(money), money) as currency",
            "if(n % 457 = 0, 'n/a', cast(cast(price as decimal(18,2)) as string)) as amount",
            f"{_day_text('t')} as started_at",
            f"if(on_trial, {_day_text(_after('t', '-14'))}, null) as trial_started_at",
            f"if(on_trial, {_day_text('t')}, null) as trial_ended_at",
            f"if(s = 'F', {_day_text(_after('t', '7 + n % 393'))}, null) as cancelled_at",
            f"{_day_text('t')} as current_period_start",
            f"{_day_text(_after('t', 'if(n % 10 < 3, 365, 30)'))} as current_period_end",
            f"{_day_text(_after('t', '30'))} as updated_at",
            *_lineage(_after("t", "n % 5"), "subscriptions.csv"),
        )

    def invoices(self) -> DataFrame:
        lines = (
            self._read("lineitem")
            .selectExpr(
                "l_orderkey as n",
                "l_linenumber as line",
                "l_returnflag as flag",
                "l_suppkey as supplier",
                "l_shipdate as t",
                "cast(l_extendedprice as decimal(18,2)) as net",
                "cast(l_tax as decimal(4,2)) as rate",
                f"{_currency('(l_orderkey % 10)')} as money",
            )
            .selectExpr("*", "cast(net * (1 + rate) as decimal(18,2)) as gross")
        )
        paid = "flag = 'N' and line <> 7 and n % 101 <> 0"
        return lines.selectExpr(
            "concat('inv_', n, '_', line) as invoice_id",
            "concat(if(n % 163 = 0, 'sub_missing_', 'sub_'), n) as subscription_id",
            "concat('org_', shiftright(supplier, 1)) as customer_id",
            "case when n % 499 = 7 then null when n % 331 = 0 then 'XXX' "
            "when n % 17 = 0 then concat(' ', lower(money)) else money end as currency",
            "cast(net as string) as subtotal",
            "if(n % 457 = 0, 'n/a', cast(gross - net as string)) as tax",
            "cast(gross as string) as total",
            "case when n % 331 = 0 and line = 1 then 'refunded' when line = 7 then 'Void' when flag = 'N' then 'paid' "
            "when flag = 'A' then ' OPEN' else 'failed' end as status",
            f"{_day_text('t')} as issued_at",
            f"if({paid}, {_day_text(_after('t', 'line'))}, null) as paid_at",
            *_lineage(_after("t", "n % 5"), "invoices.csv"),
        )

    def product_events(self) -> DataFrame:
        return self._read("events").selectExpr(
            "concat('evt_', event_id) as event_id",
            "if(event_id % 167 = 0, concat('usr_missing_', event_id), concat('usr_', user_id)) as user_id",
            "if(event_id % 53 <> 0, concat('org_', shiftright(user_id, 1)), null) as organization_id",
            "concat(upper(event_type), ' ') as event_name",
            f"if(event_id % 499 <> 0, {_micro_text('ts')}, null) as event_timestamp",
            "concat(user_id, '-', date_format(ts, 'yyyyMMddHH')) as session_id",
            "props as properties",
            *_lineage(_after("ts", "event_id % 5"), "product_events.jsonl"),
        )

    def api_usage(self) -> DataFrame:
        events = self._read("events").selectExpr("*", "cast(round(value * 100) as bigint) as cents")
        return events.selectExpr(
            "concat('req_', event_id) as request_id",
            "concat('usr_', user_id) as user_id",
            "if(event_id % 53 <> 0, concat('org_', shiftright(user_id, 1)), null) as organization_id",
            "concat('/V1/', event_type) as endpoint",
            f"{_pick('event_id % 4', 'Small', ' medium', 'LARGE', 'embed')} as model_family",
            f"{_micro_text('ts')} as request_timestamp",
            "cast(cents div 10 as string) as latency_ms",
            "cast(cents % 1000 as string) as input_units",
            "case when event_id % 97 = 0 then 'n/a' when event_id % 89 = 0 then '3.7' "
            "else cast(cents % 777 as string) end as output_units",
            "if(event_id % 101 <> 0, if(event_type = 'error', '500', '200'), null) as status_code",
            "cast(cast(cast(cents as decimal(12,0)) * 0.00001 as decimal(18,6)) as string) as estimated_cost",
            *_lineage(_after("ts", "event_id % 5"), "api_usage.parquet"),
        )

    def _accounts(self, updated_at: str, ingested_at: str, status: str) -> list[str]:
        return [
            "concat('crm_', n) as crm_account_id",
            "concat(if(n % 41 = 0, 'org_missing_', 'org_'), n) as organization_id",
            f"{status} as account_status",
            f"{_pick('n % 4', 'smb', 'Mid_Market', 'ENTERPRISE', 'other')} as segment",
            f"{_pick('n % 2', ' Sales', 'success')} as owner_team",
            f"{_pick('n % 3', 'Web', ' ', 'referral')} as lead_source",
            "'1999-01-01T00:00:00Z' as created_at",
            f"{_day_text(updated_at)} as updated_at",
            *_lineage(ingested_at, "crm_accounts.csv"),
        ]

    def _suppliers(self) -> DataFrame:
        updated = _after("timestamp_ntz'1999-01-01 00:00:00'", "1 + s_suppkey % 300")
        return self._read("supplier").selectExpr(
            "s_suppkey as n", "s_acctbal as balance", f"{updated} as updated",
            "if(s_nationkey % 2 = 0, ' Prospect', 'active') as state",
        )

    def crm_first_delivery(self) -> DataFrame:
        return self._suppliers().selectExpr(*self._accounts("updated", _after("updated", "n % 5"), "state"))

    def crm_second_delivery(self) -> DataFrame:
        """Accounts in debt turn ``at_risk`` a year later; accounts above 9,000 left."""
        stayed = self._suppliers().filter("balance <= 9000")
        return stayed.selectExpr(
            *self._accounts(
                f"if(balance < 0, {_after('updated', '365')}, updated)",
                _after("updated", "n % 5 + 400"),
                "if(balance < 0, 'at_risk', state)",
            )
        )

    def crm_accounts(self) -> DataFrame:
        """Both deliveries as they arrived; staging keeps the newer version of each account."""
        return self.crm_first_delivery().unionByName(self.crm_second_delivery())

    def marketing_events(self) -> DataFrame:
        return self._read("events").selectExpr(
            "concat('mkt_', event_id) as marketing_event_id",
            "if(event_id % 20 >= 7, concat('usr_', user_id), null) as user_id",
            "concat('anon_', user_id) as anonymous_id",
            "if(event_id % 7 = 0, '  ', concat('cmp_', get_json_object(props, '$.k'))) as campaign_id",
            f"{_pick('event_id % 3', 'Search', 'SOCIAL ', 'email')} as channel",
            "case event_type when 'view' then 'impression' when 'click' then 'CLICK' when 'signup' then ' signup_complete' "
            "when 'purchase' then 'signup_start' else event_type end as event_type",
            f"{_micro_text('ts')} as event_timestamp",
            f"{_pick('event_id % 3', 'Google', 'facebook', ' Newsletter')} as utm_source",
            f"{_pick('event_id % 2', 'CPC', 'organic')} as utm_medium",
            "if(event_id % 11 = 0, '', concat('wave_', event_id % 5)) as utm_campaign",
            *_lineage(_after("ts", "event_id % 5"), "marketing_events.csv"),
        )

    def order_activity(self) -> DataFrame:
        """Activity over years, which the one month of events cannot show: a user's order days."""
        return self._read("orders").selectExpr(
            "concat('usr_', o_custkey) as user_id", "to_date(o_orderdate) as event_date"
        )
