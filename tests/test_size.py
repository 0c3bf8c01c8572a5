"""What keeps the stored build in proportion to its input."""

import re
import threading

import pytest
from pyspark.sql import functions as F

from meterbook import scenarios
from meterbook.operators import dedup, lookup
from meterbook.plans import build, facts, staging
from meterbook.plans.warehouse import Warehouse
from meterbook.quality import reconcile
from meterbook.sources import audit
from meterbook.sources import store as store_module
from meterbook.sources.bindings import Bindings
from meterbook.sources.registry import SOURCES
from meterbook.sources.store import Store
from tests.helpers import AS_OF, event, raw, rows, sub


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("listed", [2_000_000, 1])
def test_rereading_keeps_the_same_rows(spark, monkeypatch, listed):
    """With the list of repeated keys and, where it would be too long, without it."""
    monkeypatch.setattr(dedup, "LISTED_HASHES", listed)
    landed = raw(
        spark, "product_events",
        event("a", "2024-05-01T00:00:00Z", _ingested_at="2024-05-02 00:00:00"),
        event("a", "2024-05-03T00:00:00Z", _ingested_at="2024-05-04 00:00:00"),
        event("b", "2024-05-01T00:00:00Z", event_name="x"),
        event("b", "2024-05-01T00:00:00Z", event_name="y"),
        event("c", "2024-05-01T00:00:00Z"),
        event(None, "2024-05-01T00:00:00Z"),
        event(None, "2024-05-02T00:00:00Z"),
        event("d", None),
    )
    assert rows(staging.product_events(landed, reread=True)) == rows(staging.product_events(landed))


def test_stored_events_are_not_shuffled_to_be_staged(spark, tmp_path):
    """Only hashes, and rows whose key is repeated, move."""
    path = str(tmp_path / "raw")
    events = [event(f"e{i}", "2024-05-01T00:00:00Z", properties="x" * 200) for i in range(3000)]
    raw(spark, "product_events", *events).write.parquet(path)
    lazy = Warehouse({"product_events": spark.read.parquet(path)}, AS_OF, reread_raw=True)
    staged = lazy.stg_product_events
    assert staged.count() == 3000
    text = plan(staged)
    rest = text[text.index("Union") :]
    assert "BroadcastHashJoin" in rest and "xxhash64(event_id" in rest


def test_all_totals_of_a_model_come_from_one_pass(spark, small):
    from meterbook.sources.bindings import Bindings

    asked = []
    w = Bindings(spark, small).warehouse()

    def table(name):
        asked.append(name)
        return w.table(name)

    reconcile.reconciliation(table)
    assert len(asked) == len(set(asked))


def test_channels_read_the_stored_invoices(spark):
    """The stored fact has the user of each invoice: no second join with the subscriptions."""
    invoices = spark.sql("select 'u1' user_id, 'USD' currency, 5.00 billed_amount, 3.00 paid_amount")
    users = spark.sql("select 'u1' user_id, 'web' acquisition_channel")
    landed = {"subscriptions": raw(spark, "subscriptions", sub("s1"))}
    w = Warehouse(landed, AS_OF, stored={"stg_users": users, "fact_invoices": invoices})
    assert rows(w.mart_acquisition_channels, "acquisition_channel", "currency", "billed_amount", "paid_amount") == [
        ("web", "USD", 5, 3)
    ]


def test_derived_columns_are_added_after_rows_have_moved(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    seen = []

    def finish(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.selectExpr("*", "md5(cast(id as string)) as hashed")

    got = store.replace(spark.range(10).selectExpr("id", "id % 2 as part"), "x", "t", ["part"], finish)
    assert got.count() == 10 and "hashed" in got.columns and store.read("x", "t").columns == got.columns
    assert re.search("[Rr]ebalance", seen[0])


def test_rules_on_the_same_columns_share_one_grouping(spark):
    from meterbook.quality import rules as quality

    df = spark.sql("select * from values ('a'), ('a'), (null), (null), ('b') t(k)")
    declared = [quality.Rule("m", "unique", ("k",)), quality.Rule("m", "unique_combination", ("k",))]
    counted = quality.count_violations(declared, lambda name: df)
    assert sorted((r["rule"], r["violations"]) for r in counted.collect()) == [("unique", 1), ("unique_combination", 2)]
    assert plan(quality.count_violations(declared, lambda name: df.repartition(2))).count("hashpartitioning(k") == 1


def test_a_delivery_compares_places_of_repeated_keys_only(spark, tmp_path):
    from meterbook.sources import ingest
    from meterbook.sources.readers import PLACE
    from meterbook.sources.registry import SOURCES

    spec = SOURCES["product_events"]
    keys = spark.sql("select explode(array('a', 'b', 'b', 'c', null)) event_id")
    places = {c: f"monotonically_increasing_id() as {c}" for c in PLACE}
    keys.selectExpr("event_id", *places.values(), "cast(null as string) _reason").write.parquet(str(tmp_path / "c"))
    found = ingest.repeated_keys(spark.read.parquet(str(tmp_path / "c")), spec)
    assert [r["event_id"] for r in found.collect()] == ["b"]
    text = plan(found)
    assert "xxhash64(event_id" in text and "BroadcastHashJoin" in text

def test_landing_copies_are_written_together(spark, tmp_path, monkeypatch):
    """Each copy waits for the others to be begun; one after the other they would wait for ever."""
    begun = threading.Barrier(len(SOURCES), timeout=60)
    replace = Store.replace

    def waiting(self, df, layer, table, *more):
        if layer == build.RAW:
            begun.wait()
        return replace(self, df, layer, table, *more)

    monkeypatch.setattr(Store, "replace", waiting)
    monkeypatch.setattr(build, "build", lambda store, lazy: lazy)
    folder = str(tmp_path / "few")
    for name in ("orders", "customer", "supplier", "lineitem", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(20).write.parquet(f"{folder}/{name}.parquet")
    store, _ = scenarios.built(Bindings(spark, folder))
    assert all(store.exists(build.RAW, name) for name in SOURCES)
    assert {r["status"] for r in audit.runs(store).collect()} == {audit.SUCCESS}


def test_small_partitions_are_joined_by_hash(spark, small):
    """Joins whose partitions turn out small after the shuffle need not sort their sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = Bindings(spark, small).warehouse().fact_invoices
        assert fact.count() > 0
        fact.collect()
        run, planned = plan(fact).split("Initial Plan")
        assert "ShuffledHashJoin" in run and run.count("SortMergeJoin") < planned.count("SortMergeJoin")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes, as staging of subscriptions has in one piece."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_refreshes_share_the_staged_organizations(spark, small, monkeypatch):
    """Both deliveries join a stored copy; the landed tables behind the organizations are read once."""
    seen, refresh = [], scenarios._refresh_requests
    monkeypatch.setattr(scenarios, "_refresh_requests", lambda store, organizations: seen.append(organizations) or refresh(store, organizations))
    monkeypatch.setattr(scenarios, "_shared", {})
    scenarios.landed_usage_refreshed(Bindings(spark, small))
    plans = [o._jdf.queryExecution().optimizedPlan().toString() for o in seen]
    assert len(plans) == 2 and not any("Join" in p or "Aggregate" in p for p in plans)


@pytest.mark.parametrize("listed", [2_000_000, 0])
def test_known_finds_what_a_lookup_finds(spark, monkeypatch, listed):
    """With the list of keys without a partner and, where it would be too long, without it."""
    monkeypatch.setattr(dedup, "LISTED_HASHES", listed)
    rows_ = spark.sql("select * from values (1, 'a', 'x'), (2, 'b', 'x'), (3, null, 'y'), (4, 'a', null), (5, 'c', 'z') t(n, u, o)")
    users, organizations = spark.sql("select 'a' user_id"), spark.sql("select 'x' id union all select 'q'")
    got = lookup.known(rows_, {"_u": ("u", users, "user_id"), "_o": ("o", organizations, "id")})
    assert rows(got, "n", "u", "o", "_u", "_o") == [
        (1, "a", "x", True, True), (2, "b", "x", False, True), (3, None, "y", False, False),
        (4, "a", None, True, False), (5, "c", "z", False, False),
    ]


def test_stored_subscriptions_do_not_move_to_be_looked_up(spark, small, tmp_path):
    w = Bindings(spark, small).warehouse()
    paths = {}
    for name in ("stg_subscriptions", "stg_users", "stg_organizations"):
        w.table(name).write.parquet(str(tmp_path / name))
        paths[name] = spark.read.parquet(str(tmp_path / name))
    fact = facts.stored_subscriptions(*paths.values(), w.as_of)
    assert rows(fact) == rows(w.fact_subscriptions.select(*fact.columns))
    rest = plan(fact).rsplit("Union", 1)[1]
    assert "BroadcastHashJoin" in rest and "xxhash64(user_id" in rest


def test_packed_keys_are_told_apart_like_keys(spark):
    from meterbook import functions as fn

    keys = ["0123456789abcdef0123456789abcdef", "0123456789ABCDEF0123456789ABCDEF", "0123456789abcdef", "", "ü", "x" * 32, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("p", fn.packed_key(F.col("k")))
    got = df.select("k", "p", fn.unpacked_key(F.col("p")).alias("back"), F.length("p").alias("n")).collect()
    assert all(r["k"] == r["back"] for r in got) and len({r["p"] and bytes(r["p"]) for r in got}) == len(keys)
    assert [r["n"] for r in got if r["k"] == keys[0]] == [16]


def test_rows_of_a_large_table_are_written_where_they_are(spark, tmp_path):
    store, seen = Store(spark, str(tmp_path)), []

    def finish(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    source = spark.range(0, 10, 1, 2).selectExpr("id", "id % 2 as part")
    got = store.replace(source, "x", "t", ["part"], finish, in_place=True)
    assert rows(got) == rows(source) and not re.search("[Rr]ebalance", seen[0])
    assert len(got.inputFiles()) == 4


def test_partitions_are_rewritten_in_groups(spark, tmp_path, monkeypatch):
    """A partition that loses all its rows goes, a new one comes, the others stay as they are."""
    monkeypatch.setattr(store_module, "REWRITTEN", 1)
    store = Store(spark, str(tmp_path))
    table = store.replace(spark.sql("select id, id % 4 as part from range(8)"), "x", "t", ["part"])
    asked = []

    def content(values):
        asked.append(list(values))
        kept = store.read("x", "t").filter(F.col("part").isin(values)).filter("part = 0 and id = 0")
        return kept.union(spark.sql(f"select 100L, {values[0]}L")) if values[0] in (0, 9) else kept

    untouched = {f for f in table.inputFiles() if "part=2" in f or "part=3" in f}
    store.rewrite_partitions("x", "t", "part", [0, 1, 9], content)
    after = store.read("x", "t")
    assert rows(after, "id", "part") == sorted([(0, 0), (100, 0), (2, 2), (6, 2), (3, 3), (7, 3), (100, 9)], key=str)
    assert untouched <= set(after.inputFiles()) and sorted(asked) == [[0], [1], [9]]
    store.rewrite_partitions("x", "t", "part", [], content)
    assert store.read("x", "t").count() == 7


def test_invoices_are_merged_by_month_without_moving_the_others(spark, small, monkeypatch):
    """Large tables, written in place and rewritten a month at a time, hold the same rows as small ones."""
    usual = rows(scenarios.invoices_after_update(Bindings(spark, small)))
    monkeypatch.setattr(store_module, "LARGE", 0)
    monkeypatch.setattr(store_module, "REWRITTEN", 100_000)
    seen, rewrite = [], Store.rewrite_partitions

    def recorded(self, layer, table, partition, replaced, content):
        seen.append((table, plan(content(list(replaced)[:1]))))
        return rewrite(self, layer, table, partition, replaced, content)

    monkeypatch.setattr(Store, "rewrite_partitions", recorded)
    assert rows(scenarios.invoices_after_update(Bindings(spark, small))) == usual
    merged = dict(seen)["fact_invoices"]
    assert "BroadcastHashJoin" in merged and "hashpartitioning" not in merged
