"""URL filters whose lists change over time (operator 1).

List entries are dated events: an address was added to or removed from a block or allow list. The events
of one entry become validity intervals, from an addition to the next removal; the addition counts from
its own moment, the removal ends it at its own. An as-of join then holds every capture against the
entries that were active when it was fetched. Of several, the most specific decides: an exact URL before
a path prefix before a domain, longer before shorter, and block before allow among equals.

Entry kinds: ``domain`` matches a host and all hosts below it, ``prefix`` a host and the begin of its path
up to a slash, ``url`` a whole address without fragment. Hosts are compared in lower case without user,
port and closing dot.

All of it is DataFrame functions: a capture's address gives the keys an entry could have, an equi-join
finds intervals by key, so that Spark can split a host with very many captures, and the decision is a
maximum that is pre-aggregated. Intervals are sent around while there are at most 500,000.

A null, empty or unreadable url has no host and no verdict (``none``); so has a capture with a null time.
Null ids are ids like others. Rows equal in id, url and time give one row. Entries with a null kind,
address, list or time count for nothing; among events of one entry at one moment a removal is last.
Empty lists give the verdict ``none``, empty captures an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbook.llm.tables import written

KINDS = ("domain", "prefix", "url")  # from general to specific
BROADCAST_INTERVALS = 500_000
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_of(url: Column) -> Column:
    place = F.lower(F.regexp_extract(url, _ADDRESS, 1))
    return F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")


def path_of(url: Column) -> Column:
    path = F.regexp_extract(url, _ADDRESS, 2)
    return F.when(path == "", "/").otherwise(path)


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, address, valid_from, valid_to`` (null: still active) from events ``list, kind, address, action, at``."""
    events = entries.where(
        "list is not null and kind is not null and address is not null and at is not null and action in ('add', 'remove')"
    ).select("list", "kind", "address", "action", "at")
    # One state per entry and moment: a removal is last.
    events = events.groupBy("list", "kind", "address", "at").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list", "kind", "address").orderBy("at")
    turns = events.withColumn("before", F.lag("action").over(w)).where("before is null or before <> action")
    return (
        turns.withColumn("valid_to", F.lead("at").over(w))
        .where("action = 'add'")
        .select("list", "kind", "address", F.col("at").alias("valid_from"), "valid_to")
    )


def _keys(host: Column, path: Column, query: Column) -> Column:
    """All entries an address could match: ``kind, address``, as an array."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("address")),
    )
    steps = F.split(path, "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"), F.concat(host, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")).alias("address")
        ),
    )
    whole = F.array(F.struct(F.lit("url").alias("kind"), F.concat(host, path, query).alias("address")))
    return F.concat(domains, prefixes, whole)


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, fetched_at, host, verdict, rule_kind, rule, valid_from`` of every capture."""
    active = written(intervals(entries), "intervals")
    few = active.limit(BROADCAST_INTERVALS + 1).count() <= BROADCAST_INTERVALS
    active = active.withColumnsRenamed({"kind": "e_kind", "address": "e_address"})
    base = captures.select("page_id", "url", "fetched_at").withColumn("host", host_of(F.col("url")))
    readable = F.coalesce(F.col("host") != "", F.lit(False))
    keys = F.when(readable, _keys(F.col("host"), path_of(F.col("url")), F.regexp_extract("url", _ADDRESS, 3)))
    keyed = base.select("page_id", "url", "fetched_at", "host", F.explode_outer(keys).alias("key"))
    then = (
        (F.col("key.kind") == F.col("e_kind"))
        & (F.col("key.address") == F.col("e_address"))
        & (F.col("fetched_at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    )
    rank = F.when(F.col("e_kind") == "domain", 1).when(F.col("e_kind") == "prefix", 2).when(F.col("e_kind") == "url", 3)
    best = F.max(
        F.when(
            F.col("list").isNotNull(),
            F.struct(rank.alias("rank"), F.length("e_address").alias("n"), "list", "e_kind", "e_address", "valid_from"),
        )
    )
    return (
        keyed.join(F.broadcast(active) if few else active, then, "left")
        .groupBy("page_id", "url", "fetched_at", "host")
        .agg(best.alias("rule"))
        .select(
            "page_id",
            "url",
            "fetched_at",
            F.when(F.col("host") != "", F.col("host")).alias("host"),
            F.coalesce("rule.list", F.lit("none")).alias("verdict"),
            F.col("rule.e_kind").alias("rule_kind"),
            F.col("rule.e_address").alias("rule"),
            F.col("rule.valid_from").alias("valid_from"),
        )
    )


def _digest(text: Column) -> Column:
    """0 to 65535, the same in SQL."""
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with the day of 2024 they count as fetched on: the table has no time of its own."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries made from the hosts of the pages; the host's digest says when they come and go."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("d", _digest(F.col("host")))

    def events(kind: str, of: str, address: Column, action: str, when: str, day: str) -> DataFrame:
        at = F.expr(f"date_add(date'2024-01-01', cast({day} as int))")
        return hosts.where(when).select(
            F.lit(of).alias("list"), F.lit(kind).alias("kind"), address.alias("address"), F.lit(action).alias("action"), at.alias("at")
        )

    host = F.col("host")
    parts = [
        events("domain", "block", host, "add", "d % 3 = 0", "d % 200"),
        events("domain", "block", host, "remove", "d % 3 = 0", "d % 200 + 40 + d % 90"),
        events("domain", "block", host, "add", "d % 6 = 0", "d % 200 + 150"),
        events("domain", "block", F.regexp_replace(host, r"^[^.]+\.", ""), "add", "d % 11 = 0 and host like '%.%.%.%'", "d % 300"),
        events("prefix", "allow", F.concat(host, F.lit("/en/")), "add", "d % 2 = 0", "d % 100"),
        events("prefix", "block", F.concat(host, F.lit("/de/")), "add", "d % 5 < 2", "d % 250"),
        events("prefix", "block", F.concat(host, F.lit("/de/")), "remove", "d % 5 = 0", "d % 250 + 60"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


ORACLE_SQL = r"""
WITH captures AS (
  SELECT DISTINCT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 365 AS INT) AS fetched_at,
         regexp_replace(regexp_replace(lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '')),
           '^.*@', ''), '\.?(:[0-9]*)?$', '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)', 2) AS raw_path,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) AS query
  FROM pages
), placed AS (SELECT *, CASE WHEN raw_path = '' THEN '/' ELSE raw_path END AS path FROM captures
), hosts AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 4) AS INT) AS d FROM captures WHERE host <> ''
), events AS (
  SELECT 'block' AS list, 'domain' AS kind, host AS address, 'add' AS action, d % 200 AS day FROM hosts WHERE d % 3 = 0
  UNION ALL SELECT 'block', 'domain', host, 'remove', d % 200 + 40 + d % 90 FROM hosts WHERE d % 3 = 0
  UNION ALL SELECT 'block', 'domain', host, 'add', d % 200 + 150 FROM hosts WHERE d % 6 = 0
  UNION ALL SELECT 'block', 'domain', regexp_replace(host, '^[^.]+\.', ''), 'add', d % 300 FROM hosts
    WHERE d % 11 = 0 AND host LIKE '%.%.%.%'
  UNION ALL SELECT 'allow', 'prefix', host || '/en/', 'add', d % 100 FROM hosts WHERE d % 2 = 0
  UNION ALL SELECT 'block', 'prefix', host || '/de/', 'add', d % 250 FROM hosts WHERE d % 5 < 2
  UNION ALL SELECT 'block', 'prefix', host || '/de/', 'remove', d % 250 + 60 FROM hosts WHERE d % 5 = 0
), states AS (
  SELECT list, kind, address, DATE '2024-01-01' + day AS moment, max(action) AS action FROM events GROUP BY ALL
), turns AS (
  SELECT * FROM (SELECT *, lag(action) OVER (PARTITION BY list, kind, address ORDER BY moment) AS before FROM states)
  WHERE before IS NULL OR before <> action
), spans AS (
  SELECT list, kind, address, moment AS valid_from, valid_to
  FROM (SELECT *, lead(moment) OVER (PARTITION BY list, kind, address ORDER BY moment) AS valid_to FROM turns) WHERE action = 'add'
), matches AS (
  SELECT c.page_id, c.url, c.fetched_at, s.*,
         row_number() OVER (PARTITION BY c.page_id, c.url, c.fetched_at
           ORDER BY CASE s.kind WHEN 'url' THEN 3 WHEN 'prefix' THEN 2 ELSE 1 END DESC, length(s.address) DESC, s.list DESC) AS place
  FROM placed c JOIN spans s ON c.host <> '' AND c.fetched_at >= s.valid_from AND (s.valid_to IS NULL OR c.fetched_at < s.valid_to)
   AND CASE s.kind WHEN 'domain' THEN c.host = s.address OR ends_with(c.host, '.' || s.address)
                   WHEN 'prefix' THEN starts_with(c.host || c.path, s.address)
                   ELSE c.host || c.path || c.query = s.address END
)
SELECT c.page_id, c.url, c.fetched_at, CASE WHEN c.host <> '' THEN c.host END AS host, coalesce(m.list, 'none') AS verdict,
       m.kind AS rule_kind, m.address AS rule, m.valid_from
FROM placed c LEFT JOIN matches m
  ON m.place = 1 AND m.page_id = c.page_id AND m.url IS NOT DISTINCT FROM c.url AND m.fetched_at = c.fetched_at
"""
