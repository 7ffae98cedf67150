"""Allow and block lists for urls: a sort-merge range join, DataFrame code only.

A rule (host, path) fits its host and all subdomains when the url's path starts
with the rule's path. A url is therefore looked up once for each of its host's
suffixes. Written as ``reversed host labels, NUL, path`` in UTF-8 bytes, a rule
is a prefix of the keys it fits, and a prefix is the interval
``[key, key + FF]`` (the byte FF never occurs in UTF-8). Intervals of prefixes
are nested or apart, so one sorted sweep answers all look-ups: an opening adds
one to the depth, a closing takes one away, and the innermost active rule at a
key is the last rule opened at the current depth - the top of the stack.

The sweep is cut by reversed host and by a salt of the path: rules are copied
to every salt, a host with a third of all urls is dealt over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import lower_ascii, with_fields

#: Fixed example list: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SALTS = 32
_CLOSE, _OPEN, _LOOKUP = 0, 1, 2  # at equal keys: leave, enter, then look


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lowered; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(anchor: Column, path: Column) -> Column:
    return F.encode(F.concat(anchor, F.lit("\0"), path), "UTF-8")


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def match_rules(urls: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """Distinct (host, path) of ``urls`` that a rule fits, with that rule.

    ``urls`` has host and path, ``rules`` verdict, host and path. Rules with a
    null field are ignored and a rule's host is lowered; of equal rules, block
    wins. The longest rule (host and path together) wins, then the longer host.
    """
    clean = (
        rules.select("verdict", lower_ascii(F.col("host")).alias("host"), "path")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block > allow
        .select(
            _reversed(F.split("host", r"\.")).alias("anchor"),
            "path",
            F.struct(
                (F.length("host") + F.length("path")).alias("size"),
                F.length("host").alias("host_size"),
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("found"),
        )
    )
    labels = F.split("host", r"\.")
    looked_up = (
        urls.select("host", "path")
        .distinct()
        .select(
            "host",
            "path",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size(labels)),
                    lambda n: _reversed(F.slice(labels, F.size(labels) - n + 1, n)),
                )
            ).alias("anchor"),
        )
        .join(clean.select("anchor").distinct(), "anchor", "left_semi")
        .select(
            "anchor",
            F.pmod(F.xxhash64("host", "path"), F.lit(salts)).alias("salt"),
            _key(F.col("anchor"), F.col("path")).alias("key"),
            F.lit(_LOOKUP).alias("kind"),
            "host",
            "path",
            F.lit(None).cast(clean.schema["found"].dataType).alias("found"),
        )
    )
    start = _key(F.col("anchor"), F.col("path"))
    bounds = (
        clean.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        .withColumn(
            "bound",
            F.explode(
                F.array(
                    F.struct(start.alias("key"), F.lit(_OPEN).alias("kind")),
                    F.struct(F.concat(start, F.unhex(F.lit("FF"))).alias("key"), F.lit(_CLOSE).alias("kind")),
                )
            ),
        )
        .select(
            "anchor",
            "salt",
            "bound.key",
            "bound.kind",
            F.lit(None).cast("string").alias("host"),
            F.lit(None).cast("string").alias("path"),
            "found",
        )
    )
    # Longer prefixes open later and close earlier, so sorting by key, then
    # kind, visits the bounds of nested rules in stack order.
    sweep = Window.partitionBy("anchor", "salt").orderBy("key", "kind")
    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)
    # A closing row leaves the level it ends: give it the depth from before.
    depth = F.sum(step).over(sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.when(
        F.col("kind") == _CLOSE, 1
    ).otherwise(0)
    level = Window.partitionBy("anchor", "salt", "depth").orderBy("key", "kind")
    top = F.last(F.when(F.col("kind") == _OPEN, F.col("found")), ignorenulls=True).over(
        level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        looked_up.unionByName(bounds)
        .withColumn("depth", depth)
        .withColumn("top", top)
        .where((F.col("kind") == _LOOKUP) & (F.col("depth") > 0))
        .groupBy("host", "path")
        .agg(F.max("top").alias("found"))
    )


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict for every row.

    Null urls and urls without ``://`` have empty host and path; urls that no
    rule fits, and all urls if there are no rules, get a null rule and the
    verdict ``default``. Every input row gives one output row, repeated rows
    included. Input columns named host, path, rule or verdict are replaced.
    """
    named = with_fields(
        df,
        F.struct(url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path")),
        ["host", "path"],
        keep=[c for c in df.columns if c.lower() not in ("rule", "verdict")],
    )
    found = match_rules(named, rules).select("host", "path", "found")
    joined = named.alias("u").join(
        found.select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("found").alias("__found")),
        (F.col("u.host") == F.col("__host")) & (F.col("u.path") == F.col("__path")),
        "left",
    )
    return joined.select(
        "u.*",
        F.col("__found.rule").alias("rule"),
        F.coalesce(F.col("__found.verdict"), F.lit(default)).alias("verdict"),
    )
