"""Operator 2: URL lists joined as of the time of each capture.

A list is a log of dated entries ``list, key, day, action``: ``list`` is ``block`` or
``allow``, ``action`` is ``add`` or ``remove``. Each entry is in force from its day until
the day before the next entry of the same list and key (several on one day: a
``remove`` wins). Keys are ``host:a.b.c`` (that host), ``domain:b.c`` (it and all below) and
``prefix:a.b.c/en`` (paths whose first segment is ``en``). Their hosts are read as those of
captures: in lower case, without final dot and ``www.``; ``domain:www.b.c`` is thus the host
``b.c`` and what is below ``www.b.c``.

A capture is dropped if a block entry was in force on the day it was fetched and no
allow entry was. Captures of one host, segment and day get one evaluation, which is
joined back, so a host with a third of all rows is looked up once a day.

A null url or day, and one without scheme and host, matches nothing and is kept.
Hosts of any length are matched. Entries with a null in any
column are ignored. Repeated captures repeat. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)"


#: Parts that the captures of one key are dealt into.
SALTS = 8


def url_parts(url):
    """Host without ``www.`` and final dot, in lower case; first path segment."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, AUTHORITY, 1)), r"^www\.|\.$", "")
    return host, F.regexp_extract(url, SEGMENT, 1)


def normalised(entries: DataFrame) -> DataFrame:
    """Entries whose keys have hosts in the form of ``url_parts``."""
    kind, name, rest = (F.regexp_extract("key", r"^(host|domain|prefix):([^/]*)(.*)$", k) for k in (1, 2, 3))
    low = F.regexp_replace(F.lower(name), r"\.$", "")
    bare = F.regexp_replace(low, r"^www\.", "")
    keys = (
        F.when(kind == "", F.array("key"))
        .when((kind == "domain") & low.startswith("www."), F.array(F.concat(F.lit("domain:"), low), F.concat(F.lit("host:"), bare)))
        .when(kind == "domain", F.array(F.concat(F.lit("domain:"), low)))
        .otherwise(F.array(F.concat(kind, F.lit(":"), bare, rest)))
    )
    return entries.select("list", "key", "day", "action").dropna().select("list", F.explode(keys).alias("key"), "day", "action")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, since, until) during which a key is on a list; ``until`` is exclusive, null: still on it."""
    days = entries.select("list", "key", "day", "action").dropna().groupBy("list", "key", "day").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list", "key").orderBy("day")
    return days.withColumn("until", F.lead("day").over(w)).where("action = 'add'").select("list", "key", F.col("day").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(capture_id, host, day, n_block, n_allow, entry, dropped) of captures (capture_id, url, day)."""
    return _evaluate(captures, normalised(entries))


def _evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    host, segment = url_parts(F.col("url"))
    c = captures.select("capture_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(segment, F.lit("")).alias("segment"), "day")
    kinds = c.where("host <> '' and day is not null").select("host", "segment", "day").distinct()
    labels = F.split("host", r"\.")
    parents = F.expr("transform(sequence(1, size(labels)), i -> concat('domain:', array_join(slice(labels, i, size(labels)), '.')))")
    keyed = kinds.withColumn("labels", labels).select(
        "host", "segment", "day",
        F.explode(F.concat(F.array(F.concat(F.lit("host:"), "host"), F.concat(F.lit("prefix:"), "host", F.lit("/"), "segment")), parents)).alias("key"),
    )
    # One host, or the last label of most, can be a third of all captures: entries are there SALTS times.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    part = F.pmod(F.xxhash64("host", "segment", "day"), F.lit(SALTS)).cast("int")
    listed = intervals(entries).select("*", salts).alias("i")
    on = [
        keyed["key"] == F.col("i.key"), part == F.col("i.salt"), keyed["day"] >= F.col("i.since"),
        F.col("i.until").isNull() | (keyed["day"] < F.col("i.until")),
    ]
    hits = (
        keyed.join(listed, on)
        .groupBy("host", "segment", keyed["day"])
        .agg(
            F.count_if(F.col("i.list") == "block").alias("n_block"),
            F.count_if(F.col("i.list") == "allow").alias("n_allow"),
            F.min(F.when(F.col("i.list") == "block", keyed["key"])).alias("entry"),
        )
        .select("*", salts)
    )
    can = (F.col("host") != "") & F.col("day").isNotNull()
    part = F.pmod(F.xxhash64("capture_id", F.col("url")), F.lit(SALTS)).cast("int").alias("salt")
    met = c.where(can).select("*", part).join(hits, ["host", "segment", "day", "salt"], "left")
    # Without a host or a day a capture meets no entry, and skips the join.
    rest = c.where(~can).select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("n_block", "long"), ("n_allow", "long"), ("entry", "string"))))
    columns = ["capture_id", "host", "day", "n_block", "n_allow", "entry"]
    return met.select(*columns).unionByName(rest.select(*columns)).select(
        "capture_id", "host", "day",
        F.coalesce("n_block", F.lit(0)).cast("long").alias("n_block"),
        F.coalesce("n_allow", F.lit(0)).cast("long").alias("n_allow"),
        "entry",
        (F.coalesce("n_block", F.lit(0)) > 0).__and__(F.coalesce("n_allow", F.lit(0)) == 0).alias("dropped"),
    )


def _number(key, n: int):
    return F.conv(F.substr(F.md5(key.cast("binary")), F.lit(1), F.lit(7)), 16, 10).cast("long") % n


def lists_of(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts and paths met in ``pages`` by digests of their
    names: a fifth of them is listed, some are taken off again, some return."""
    host, segment = url_parts(F.col("url"))
    p = pages.select(host.alias("host"), segment.alias("segment")).where("host <> ''").distinct()
    keys = p.select(
        F.explode(
            F.array(
                F.concat(F.lit("host:"), "host"),
                F.concat(F.lit("domain:"), F.substring_index("host", ".", -3)),
                F.concat(F.lit("prefix:"), "host", F.lit("/"), "segment"),
            )
        ).alias("key")
    ).distinct()
    n = keys.withColumn("n", _number(F.concat(F.lit("on "), "key"), 20)).where("n < 4").withColumn("d", _number(F.concat(F.lit("day "), "key"), 300))
    event = "named_struct('day', d + {}, 'action', '{}')"
    log = F.expr(
        f"array({event.format(0, 'add')}, {event.format(40, 'remove')}, {event.format(55, 'add')})"
    )
    return n.select(
        F.when(F.col("n") == 3, "allow").otherwise("block").alias("list"),
        "key",
        # n = 0: listed for good; 1: taken off; 2 and 3: taken off and back.
        F.explode(F.slice(log, F.lit(1), F.least(F.col("n") + 1, F.lit(3)).cast("int"))).alias("e"),
    ).select("list", "key", F.col("e.day").alias("day"), F.col("e.action").alias("action"))


def op2(spark, sf_dir: str) -> DataFrame:
    """``pages`` has no fetch time: a page counts as fetched on day ``page_id % 366``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", (F.col("page_id") % 366).alias("day"))
    return _evaluate(captures, lists_of(pages)).withColumnRenamed("capture_id", "page_id")


SQL = rf"""
with p as (
  select page_id, page_id % 366 as day,
    coalesce(regexp_replace(lower(regexp_extract(url, '{AUTHORITY}', 1)), '^www\.|\.$', '', 'g'), '') as host,
    coalesce(regexp_extract(url, '{SEGMENT}', 1), '') as segment
  from pages
), names as (
  select distinct unnest(['host:' || host, 'domain:' || array_to_string(string_split(host, '.')[-3:], '.'),
    'prefix:' || host || '/' || segment]) as key
  from p where host <> ''
), listed as (
  select key, cast('0x' || substr(md5('on ' || key), 1, 7) as bigint) % 20 as n,
    cast('0x' || substr(md5('day ' || key), 1, 7) as bigint) % 300 as d
  from names
), spans as (
  select key, case when n = 3 then 'allow' else 'block' end as list, d as since,
    case when n = 0 then null else d + 40 end as until from listed where n < 4
  union all
  select key, case when n = 3 then 'allow' else 'block' end, d + 55, null from listed where n in (2, 3)
), looked as (
  select p.page_id, count(*) filter (s.list = 'block') as n_block, count(*) filter (s.list = 'allow') as n_allow,
    min(s.key) filter (s.list = 'block') as entry
  from p join spans s on p.day >= s.since and (s.until is null or p.day < s.until)
    and (s.key = 'host:' || p.host or s.key = 'prefix:' || p.host || '/' || p.segment
      or (starts_with(s.key, 'domain:') and (p.host = substr(s.key, 8) or ends_with(p.host, '.' || substr(s.key, 8)))))
  where p.host <> '' group by p.page_id
)
select p.page_id, p.host, p.day, coalesce(n_block, 0) as n_block, coalesce(n_allow, 0) as n_allow, entry,
  coalesce(n_block, 0) > 0 and coalesce(n_allow, 0) = 0 as dropped
from p left join looked using (page_id)
"""
