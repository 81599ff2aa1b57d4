"""URL filter: rules on hosts and paths, found for each URL by a sort-merge range join.

A rule (host, path) fits the host and all its subdomains, if the URL's path starts with the
rule's. Hosts are reversed, so that a rule becomes an interval of keys: all keys that start with
its own. A URL gets a key for its host and for each parent domain, as deep as the rules' hosts
go. Interval starts, interval ends and URL keys are sorted together; a sweep over them counts
the rules that are open, which gives each key its depth, and the rule on top of the stack is the
last one that was opened at that depth.

The sort is cut into ranges of equal size, however often a URL occurs; what is still open where
a range begins is carried over from the ranges before. Everything is DataFrame operations.

Of several rules that fit, the one with the longest text (host and path together) wins, then the
one with the longer host, then the smaller text. Rules of equal host and path count once, as a
block if one of them blocks. NULL URLs and those without ``://`` have an empty host and path,
which fits no rule. Repeated rows are judged one by one. Only the named columns are read and
returned, so that others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"

# The rules of the query.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)

_START, _KEY, _END = 0, 1, 2


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    """Labels can't hold ``/``, with which each path that is not empty begins."""
    return F.concat(F.array_join(labels, "."), F.lit("\0"), path).cast("binary")


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    staging: str,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """The id, host and path of each URL, the rule that decides, and the verdict.

    ``rules`` has the columns host, path and verdict, and may be large. The sorted events are
    written to ``staging``, so that each keeps its range.
    """
    spark = pages.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    deepest = rules.agg(F.max(F.size(_reversed_labels(F.col("host"))))).first()[0] or 1
    events = _url_events(pages, id_column, url_column, deepest).unionByName(
        _rule_events(rules), allowMissingColumns=True
    )
    (
        events.repartitionByRange(ranges, "key", "kind", "row")
        .withColumn("range", F.spark_partition_id())
        .write.parquet(staging)
    )
    swept = _with_depth(spark.read.schema(_schema(events)).parquet(staging))
    matched = _with_top(swept)
    best = F.max_by("found", F.struct("found.length", "found.host_length", "found.order"))
    return (
        matched.groupBy("row")
        .agg(
            F.first(id_column).alias(id_column),
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            best.alias("found"),
        )
        .select(
            id_column,
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
        )
    )


def _schema(events: DataFrame):
    return events.withColumn("range", F.lit(0)).schema


def _url_events(pages: DataFrame, id_column: str, url_column: str, deepest: int) -> DataFrame:
    """A key per URL and parent domain; ``row`` tells equal rows apart."""
    url = F.col(url_column)
    urls = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    ).withColumn("labels", _reversed_labels(F.col("host")))
    depths = F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(deepest)))
    return urls.withColumn("labels_used", F.explode(depths)).select(
        "row",
        id_column,
        "host",
        "path",
        _key(F.slice("labels", 1, F.col("labels_used")), F.col("path")).alias("key"),
        F.lit(_KEY).alias("kind"),
    )


def _rule_events(rules: DataFrame) -> DataFrame:
    """Where each rule's interval opens and closes. No UTF-8 text holds the byte FF."""
    text = F.concat("host", "path")
    opened = _key(_reversed_labels(F.col("host")), F.col("path"))
    rule = F.struct(
        text.alias("rule"),
        "verdict",
        F.length(text).alias("length"),
        F.length("host").alias("host_length"),
    )
    # Keys of one rule are unique: ``row`` only has to be there for the sort.
    starts = rules.select(
        F.lit(None).cast("long").alias("row"),
        opened.alias("key"),
        F.lit(_START).alias("kind"),
        rule.alias("opened"),
    )
    ends = rules.select(
        F.lit(None).cast("long").alias("row"),
        F.concat(opened, F.unhex(F.lit("FF"))).alias("key"),
        F.lit(_END).alias("kind"),
    )
    return starts.unionByName(ends, allowMissingColumns=True)


_IN_ORDER = ("key", "kind", "row")


def _with_depth(events: DataFrame) -> DataFrame:
    """``depth``: the rules open at an event, a rule that opens there included."""
    step = F.when(F.col("kind") == _START, 1).when(F.col("kind") == _END, -1).otherwise(0)
    events = events.withColumn("step", step)
    totals = events.groupBy("range").agg(F.sum("step").alias("total"))  # a row per range
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("total").over(before), F.lit(0))
    carried = totals.select("range", opened.alias("open"))
    within = Window.partitionBy("range").orderBy(*_IN_ORDER)
    return (
        events.withColumn("inner", F.sum("step").over(within))
        .join(F.broadcast(carried), "range")
        .withColumn("depth", F.col("open") + F.col("inner"))
    )


def _with_top(swept: DataFrame) -> DataFrame:
    """URL keys with the rule on top of the stack: the last one opened at their depth."""
    # What is open where a range begins: the last rule opened at each depth before it.
    last = swept.where(F.col("kind") == _START).groupBy("range", "depth")
    opened = last.agg(F.max_by("opened", "key").alias("opened"))
    ranges = swept.select("range", "open").distinct()
    wanted = ranges.where("open > 0").select(
        "range", F.explode(F.sequence(F.lit(1).cast("long"), F.col("open"))).alias("depth")
    )
    by_depth = Window.partitionBy("depth").orderBy("range", "opens")
    below = (
        wanted.select("range", "depth", F.lit(0).alias("opens"), F.lit(None).alias("opened"))
        .unionByName(opened.select("range", "depth", F.lit(1).alias("opens"), "opened"))
        .withColumn("below", F.last("opened", ignorenulls=True).over(by_depth))
        .where("opens = 0")
        .select("range", "depth", "below")
    )
    at_depth = Window.partitionBy("range", "depth").orderBy(*_IN_ORDER)
    inside = (
        swept.where((F.col("depth") > 0) & (F.col("kind") != _END))
        .withColumn("top", F.last("opened", ignorenulls=True).over(at_depth))
        .where(F.col("kind") == _KEY)
        .join(below, ["range", "depth"], "left")
        .withColumn("found", F.coalesce("top", "below"))
    )
    outside = swept.where((F.col("depth") == 0) & (F.col("kind") == _KEY))
    found = inside.unionByName(outside, allowMissingColumns=True)
    # Of equal lengths the smaller text wins: the complement of its bytes is larger.
    order = F.translate(F.lower(F.hex("found.rule")), "0123456789abcdef", "fedcba9876543210")
    return found.withColumn("found", F.col("found").withField("order", F.concat(order, F.lit("g"))))
