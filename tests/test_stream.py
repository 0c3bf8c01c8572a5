import os

from meterbook import scenarios
from meterbook.plans import staging
from meterbook.plans.facts import fact_product_usage
from meterbook.sources.bindings import Bindings
from meterbook.streaming import daily_usage
from tests.helpers import event, org, raw, rows, user

COLUMNS = ("date_day", "user_id", "event_name", "event_count", "usage_grain_key")


def test_out_of_order_files_and_moved_events_equal_a_batch(spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    files = [
        [event("e1", "2024-05-02T10:00:00Z"), event("e2", "2024-05-01T10:00:00Z"), event("e9", None)],
        # late for an older day, a copy, an event that moves to another day, and a day of its own
        [
            event("e3", "2024-05-01T11:00:00Z", _ingested_at="2024-05-03 00:00:00"),
            event("e1", "2024-05-02T10:00:00Z", _ingested_at="2024-05-03 00:00:00"),
            event("e2", "2024-05-04T10:00:00Z", _ingested_at="2024-05-03 00:00:00"),
        ],
        # an older version of e2 comes last and must not count; e1 leaves its day empty
        [
            event("e2", "2024-05-05T10:00:00Z", _ingested_at="2024-05-02 00:00:00"),
            event("e1", "2024-05-06T10:00:00Z", _ingested_at="2024-05-04 00:00:00"),
        ],
    ]
    users = staging.users(raw(spark, "users", user("u1")))
    organizations = staging.organizations(raw(spark, "organizations", org("o1")))
    stream = daily_usage.UsageStream(spark, str(tmp_path / "state"), users, organizations)
    for i, landed in enumerate(files):
        raw(spark, "product_events", *landed).coalesce(1).write.mode("append").parquet(arrivals)
        source = spark.readStream.schema(daily_usage.LANDED).parquet(arrivals)
        daily_usage.start(stream, source, str(tmp_path / "progress")).awaitTermination()
    everything = raw(spark, "product_events", *[e for landed in files for e in landed])
    want = fact_product_usage(staging.product_events(everything), users, organizations)
    assert rows(stream.fact(), *COLUMNS) == rows(want, *COLUMNS)
    assert not os.path.exists(f"{stream.fact_path}/date_day=2024-05-02")

    # a batch that is processed again leaves the same fact
    stream.process(raw(spark, "product_events", *files[2]), 2)
    assert rows(stream.fact(), *COLUMNS) == rows(want, *COLUMNS)


def test_what_a_batch_reads_does_not_grow_with_batches(spark, tmp_path):
    users = staging.users(raw(spark, "users", user("u1")))
    organizations = staging.organizations(raw(spark, "organizations", org("o1")))
    stream = daily_usage.UsageStream(spark, str(tmp_path / "state"), users, organizations, gather_after=2)
    everything, folders, files = [], [], []
    for i in range(8):
        at = f"2024-05-0{1 + i % 2}T10:00:00Z"
        # one new event a batch, and one that comes again on the other day
        landed = [event(f"e{i}", at), event("moving", at, _ingested_at=f"2024-05-03 00:00:0{i}")]
        everything += landed
        stream.process(raw(spark, "product_events", *landed).coalesce(1), i)
        folders.append(len(os.listdir(stream.events.folder)) + len(os.listdir(stream.index.folder)))
        files.append(len(stream.index.read().inputFiles()))
        want = fact_product_usage(staging.product_events(raw(spark, "product_events", *everything)), users, organizations)
        assert rows(stream.fact(), *COLUMNS) == rows(want, *COLUMNS)
    assert max(folders) <= 6 and max(files[2:]) <= 10


def test_only_events_stored_more_than_once_are_ranked(spark, tmp_path, monkeypatch):
    users = staging.users(raw(spark, "users", user("u1")))
    organizations = staging.organizations(raw(spark, "organizations", org("o1")))
    stream = daily_usage.UsageStream(spark, str(tmp_path / "state"), users, organizations)
    ranked, newest = [], daily_usage.newest

    def counted(rows, *within):
        ranked.append(rows.count())
        return newest(rows, *within)

    monkeypatch.setattr(daily_usage, "newest", counted)
    first = [event(f"a{i}", f"2024-05-0{1 + i % 2}T10:00:00Z") for i in range(50)]
    # new events, a copy, and two events that leave their days: one for another day, one for none
    later = [event(f"b{i}", f"2024-05-0{1 + i % 2}T10:00:00Z") for i in range(50)] + [
        event("a0", "2024-05-01T10:00:00Z", _ingested_at="2024-05-03 00:00:00"),
        event("a1", "2024-05-03T10:00:00Z", _ingested_at="2024-05-03 00:00:00"),
        event("a2", None, _ingested_at="2024-05-03 00:00:00"),
    ]
    for i, landed in enumerate((first, later)):
        stream.process(raw(spark, "product_events", *landed), i)
    want = fact_product_usage(staging.product_events(raw(spark, "product_events", *first, *later)), users, organizations)
    assert rows(stream.fact(), *COLUMNS) == rows(want, *COLUMNS)
    # Nothing of the first batch; both versions of a1 and a2 for their marks; then these, but the row
    # without a day, with their marks and both copies of a0.
    assert ranked == [0, 4, 2 + 1 + 1 + 1 + 2]


def test_versions_that_move_between_days_equal_a_batch(spark, tmp_path):
    """Late versions, older ones, copies inside a batch, and days that come and go."""
    users = staging.users(raw(spark, "users", user("u1")))
    organizations = staging.organizations(raw(spark, "organizations", org("o1")))
    stream = daily_usage.UsageStream(spark, str(tmp_path / "state"), users, organizations, gather_after=2)
    everything = []
    for i in range(5):
        landed = []
        for n in range(24):
            for copy in range(1 + (n + i) % 2):
                day = (n * 7 + i * 5 + copy * n) % 6
                at = f"2024-05-0{day}T10:00:00Z" if day else None
                hour = (n * 11 + i * 13 + copy * 3) % 24
                landed.append(event(f"e{(n * (i + 1)) % 30}", at, _ingested_at=f"2024-05-08 {hour:02}:{n:02}:0{i}"))
        everything += landed
        stream.process(raw(spark, "product_events", *landed), i)
        want = fact_product_usage(staging.product_events(raw(spark, "product_events", *everything)), users, organizations)
        assert rows(stream.fact(), *COLUMNS) == rows(want, *COLUMNS)


def test_dimensions_are_staged_once_for_all_batches(spark, small, monkeypatch):
    made, stream = [], daily_usage.UsageStream

    def keep(*args):
        made.append(stream(*args))
        return made[-1]

    monkeypatch.setattr(daily_usage, "UsageStream", keep)
    scenarios.streamed_usage(Bindings(spark, small))
    read = [*made[0].users.inputFiles(), *made[0].organizations.inputFiles()]
    assert read and not any(small in path for path in read)
