"""URL filters over dated lists, in built-in expressions only.

A list's dated entries (listed or dropped on a day) become validity intervals. A capture is judged
by the entries that were active when it was fetched: an as-of join by key, where the keys of a URL
are its host with all parent domains, its path prefixes by whole segments, and the URL itself.
An active entry of an allowing list overrules those of blocking lists.

Captures are first reduced to distinct (url, day), so a page fetched a million times is judged once;
of a key that a third of all URLs share (a large host), Spark splits the partition, since the
matching side holds one row for each interval of that key.

Defined cases: a null or unreadable URL has no keys and is not blocked; a null day matches no
entry; of entries for one pattern on one day, a drop wins over a listing; entries with a null
pattern, day or list are ignored; repeated captures each get a row. Extra columns of captures are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import same

#: What an entry's pattern names: a host with all below it, a path with all below it, or one URL.
KINDS = ("domain", "path", "url")
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    place = F.regexp_extract(url, _SCHEME + r"([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[0-9]*$", "")
    return F.nullif(F.regexp_replace(F.lower(bare), r"\.$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"[^/?#]*([^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """(kind, pattern) pairs that an entry may name to match ``url``."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    steps = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    paths = F.transform(
        F.sequence(F.lit(0), F.size(steps)),
        lambda i: F.concat_ws("/", host, F.slice(steps, F.lit(1), i)),
    )
    pair = lambda kind: lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
    own = F.array(F.regexp_replace(url, "#.*$", ""))
    found = F.concat(F.transform(domains, pair("domain")), F.transform(paths, pair("path")), F.transform(own, pair("url")))
    return F.when(host.isNotNull(), F.array_distinct(found))


def validity(entries: DataFrame) -> DataFrame:
    """(list, blocks, kind, pattern, valid_from, valid_to) from (list, blocks, kind, pattern, day, listed).

    ``valid_to`` is the first day on which the entry no longer holds, null while it holds."""
    whole = entries.dropna(subset=["list", "kind", "pattern", "day", "listed"])
    daily = whole.groupBy("list", "kind", "pattern", "day").agg(F.bool_and("listed").alias("listed"), F.bool_and("blocks").alias("blocks"))
    order = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    changes = daily.withColumn("before", F.lag("listed", 1, False).over(order)).where("listed <> before")
    spans = changes.withColumn("valid_to", F.lead("day").over(order)).where("listed")
    return spans.select("list", "blocks", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, intervals: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with ``blocked``, ``n_active`` (entries active at the fetch), ``lists`` (their names) and
    ``first_active`` (the smallest of them as text); columns of these names are replaced."""
    targets = captures.select(F.col(url).alias("u"), F.col(day).alias("d")).distinct()
    keyed = targets.select("u", "d", F.explode(keys_of(F.col("u"))).alias("k")).select("u", "d", "k.kind", "k.pattern")
    active = keyed.join(intervals, ["kind", "pattern"]).where("valid_from <= d AND (valid_to IS NULL OR d < valid_to)")
    verdicts = active.groupBy(F.col("u").alias("__u"), F.col("d").alias("__d")).agg(
        F.struct(
            F.bool_and("blocks").alias("all_block"),
            F.count("*").alias("n"),
            F.array_join(F.array_sort(F.collect_set("list")), ",").alias("names"),
            F.min(F.concat_ws("|", "list", "kind", "pattern")).alias("least"),
        ).alias("__found")
    )
    joined = captures.join(verdicts, same(captures[url], F.col("__u")) & same(captures[day], F.col("__d")), "left")
    return joined.select(
        *[captures[c] for c in captures.columns if c.lower() not in ("blocked", "n_active", "lists", "first_active")],
        F.coalesce("__found.all_block", F.lit(False)).alias("blocked"),
        F.coalesce("__found.n", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("__found.names", F.lit("")).alias("lists"),
        F.col("__found.least").alias("first_active"),
    )
