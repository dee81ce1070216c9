"""URL rules by a sort-merge range join on reversed hosts.

A host read backwards label by label (``net.example.www.``) makes a rule's host and all its subdomains one interval of
keys.  Intervals of rules are nested or apart, so a sweep over the sorted keys keeps a stack of the rules that are
open: it grows where an interval begins and shrinks where it ends.  Every url takes the stack that the sweep has at its
key, and the longest rule there whose path its own begins with decides.

The sweep runs in segments.  A segment is a piece of the urls below one registered domain (two labels), cut to bounded
size by a hash of the url, with the marks of the rules below that domain; rules of a whole top-level domain are open
throughout it.  So a host or a domain with a third of all urls is spread over many tasks.  Everything runs on built-in
functions.

A stack holds the rules of one host and its parents: rules, not urls, bound its size.

Edge cases: a null url, and one without ``://``, has empty host and path and meets only rules with an empty host, of
which there are none.  Repeated rows are judged each.  Of equal rules that contradict each other the one that blocks
counts.  An empty table gives an empty result; without rules every url gets the default.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dockside.plans.staging import stage

#: Urls of one domain to a segment, or four for each mark of a rule there if that is more: the marks, which every
#: segment of a domain repeats, then stay fewer than the urls.
SEGMENT_URLS = 2_000
DEFAULT_VERDICT = "allow"
#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_STACK = "array<struct<rank:int,host:string,path:string,verdict:string>>"


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    """The host's labels backwards, each with a full stop behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _domain(key: Column) -> Column:
    """The first two labels of a key."""
    return F.substring_index(key, ".", 2)


def marks(rules: DataFrame) -> DataFrame:
    """(labels, domain, at, opens, stack): where the stack changes, and what it is from there on.

    A rule's ancestors are the rules whose host is one of the tails of its own host, found by an equal join on tails.
    """
    own = rules.select(
        "host", "path", "verdict", reversed_key(F.col("host")).alias("key"), F.size(F.split("host", r"\.", -1)).alias("labels")
    )
    tails = own.select("key", "labels").distinct().select("key", "labels", F.explode(F.sequence(F.lit(1), F.col("labels"))).alias("n"))
    tails = tails.select("key", "labels", "n", F.expr("concat(substring_index(key, '.', n), '.')").alias("tail"))
    entry = F.struct(F.col("r_labels").alias("rank"), F.col("host"), F.col("path"), F.col("verdict"))
    found = tails.join(own.select(F.col("key").alias("tail"), F.col("labels").alias("r_labels"), "host", "path", "verdict"), "tail")
    stacks = found.groupBy("key", "labels").agg(
        F.collect_set(entry).alias("inside"), F.collect_set(F.when(F.col("tail") != F.col("key"), entry)).alias("outside")
    )
    # Keys that begin with "a.b." are those from "a.b." up to "a.b/", for "/" follows "." and no host has one.
    end = F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/"))
    edges = F.explode(F.array(
        F.struct(F.col("key").alias("at"), F.lit(1).alias("opens"), F.col("inside").cast(_STACK).alias("stack")),
        F.struct(end.alias("at"), F.lit(0).alias("opens"), F.col("outside").cast(_STACK).alias("stack")),
    )).alias("e")
    return stacks.select("labels", _domain(F.col("key")).alias("domain"), edges).select("labels", "domain", "e.*")


def judge(
    pages: DataFrame, rules: DataFrame, *, default: str = DEFAULT_VERDICT, segment_urls: int = SEGMENT_URLS
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    # Copies of a row are dealt apart by their place in the input, which is the same whenever the scan is run again.
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"), F.monotonically_increasing_id().alias("row"),
    )
    urls = urls.withColumn("at", reversed_key(F.col("host"))).withColumn("domain", _domain(F.col("at")))
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"
    edges = stage(marks(rules), "url-marks")
    marked = edges.where("labels > 1").groupBy("domain").agg(F.count("*").alias("marks"))
    cut = F.greatest(F.lit(segment_urls), 4 * F.coalesce("marks", F.lit(0)))
    sizes = urls.groupBy("domain").agg(F.count("*").alias("n")).join(marked, "domain", "left")
    sizes = stage(sizes.select("domain", F.ceil(F.col("n") / cut).cast("int").alias("segments")), "url-domains")
    # The first label is a top-level domain: its rules are open before the first mark of any segment below it.
    top = edges.where("labels = 1 and opens = 1").select(F.expr("left(at, length(at) - 1)").alias("tld"), F.col("stack").alias("top"))
    segments = sizes.join(top, F.substring_index(F.col("domain"), ".", 1) == F.col("tld"), "left").select("domain", "segments", "top")
    base = segments.select(
        "domain", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment"),
        F.lit("").alias("at"), F.lit(0).alias("opens"), F.coalesce("top", F.array().cast(_STACK)).alias("stack"),
    )
    inner = edges.where("labels > 1").join(segments.select("domain", "segments"), "domain").select(
        "domain", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment"), "at", "opens", "stack"
    )
    no_url = [F.lit(None).cast(t).alias(c) for c, t in (("page_id", "long"), ("host", "string"), ("path", "string"))]
    swept = base.unionByName(inner).select("domain", "segment", "at", "opens", "stack", *no_url)
    points = urls.join(sizes, "domain").select(
        "domain", F.pmod(F.xxhash64("row"), F.col("segments")).cast("int").alias("segment"), "at",
        F.lit(2).alias("opens"), F.lit(None).cast(_STACK).alias("stack"), "page_id", "host", "path",
    )
    w = Window.partitionBy("domain", "segment").orderBy("at", "opens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stacked = swept.unionByName(points).withColumn("stack", F.last("stack", ignorenulls=True).over(w)).where("opens = 2")
    fits = F.filter("stack", lambda r: F.col("path").startswith(r.path))
    longest = F.array_max(F.transform(fits, lambda r: F.struct((F.length(r.host) + F.length(r.path)).alias("n"), r.alias("r")))).r
    return stacked.withColumn("best", longest).select(
        "page_id", "host", "path", F.concat(F.col("best.host"), F.col("best.path")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
