"""URL rules by a sort-merge sweep over reversed-host keys. DataFrame functions only.

A rule's key is its host's labels in reverse, each followed by a dot, and its path; the keys that begin with it are one
interval of the sorted keys. Such intervals are nested or apart, so the rules open at any point of the sort are a stack: the
last rule that began and the rules whose keys its own begins with. An address asks once for its host and once for each
parent domain, with its path. Rules and questions are sorted together; each question gets the stack open at its place and
keeps the longest rule that its key begins with.

Both are cut into ranges of the sort, of about as many rows each, and every range is swept by itself: it begins with the stack
that is open at its start, the stack of the last rule before it. So no rule is copied, and equal keys, asked for by many
addresses, are spread over ranges too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.llm.shared import stored

#: Rules and questions of one range, on average.
SWEEP_ROWS = 20_000
DEFAULT_VERDICT = "allow"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and for text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.coalesce(_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _keyed(rules: DataFrame) -> DataFrame:
    """``(label, key, stack)``: per rule, itself and the rules whose intervals hold its own.

    Of rules with one key the greater verdict counts (block over allow).
    """
    labels = F.split(_lower(F.col("host")), r"\.")
    key = F.concat(F.array_join(F.reverse(labels), "."), F.lit("."), F.col("path"))
    own = rules.groupBy(F.element_at(labels, -1).alias("label"), key.alias("key"), F.concat(_lower(F.col("host")), F.col("path")).alias("rule")).agg(F.max("verdict").alias("verdict"))
    starts = own.select("label", "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("outer"))
    outer = own.select(F.col("key").alias("outer"), F.struct(F.length("rule").alias("size"), F.col("key").alias("key"), "rule", "verdict").alias("entry"))
    return starts.join(outer, "outer").groupBy("label", "key").agg(F.sort_array(F.collect_list("entry"), asc=False).alias("stack"))


def judged(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` for every distinct ``(host, path)`` of ``addresses`` that a rule fits."""
    distinct = addresses.where("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    key_of = lambda n: F.concat(F.array_join(F.reverse(F.slice(F.col("labels"), n, F.size("labels"))), "."), F.lit("."), F.col("path"))
    asked = distinct.withColumn("labels", labels).select(
        "host", "path", F.element_at("labels", -1).alias("label"), F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), key_of)).alias("key"),
    )
    keyed = stored(_keyed(rules), "rules")
    asked = stored(asked.join(keyed.select("label").distinct(), "label", "left_semi").drop("label"), "questions")
    both = ranged(keyed.drop("label"), asked)
    order = Window.partitionBy("range").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    last = both.groupBy("range").agg(F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("key"))).alias("last"))
    # A row per range; all of them are a table many thousand times shorter than the questions.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    started = last.select(F.col("range").alias("of"), F.last("last", ignorenulls=True).over(before).alias("start"))
    swept = both.withColumn("own", F.last("stack", ignorenulls=True).over(order)).where("host is not null")
    swept = swept.join(started, F.col("range") == F.col("of")).withColumn("open", F.coalesce("own", "start"))
    fits = F.expr("filter(open, r -> startswith(key, r.key))")
    hits = swept.select("host", "path", fits.alias("fits")).where(F.size("fits") > 0).select("host", "path", F.element_at("fits", 1).alias("hit"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct("hit.size", "hit.rule", "hit.verdict")).alias("hit"))
    return best.select("host", "path", "hit.rule", "hit.verdict")


def ranged(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    """Rules ``(key, stack)`` and questions ``(host, path, key)`` as one stored table with the ``range`` of the sort each is in.

    A rule stands before the questions of its key, and those in the order of a hash, by which a frequent key is divided.
    """
    rules = keyed.select("key", "stack", F.lit(-(2**63)).cast("long").alias("tie"))
    questions = asked.select("host", "path", "key", F.greatest(F.xxhash64("host", "path"), F.lit(1 - 2**63)).alias("tie"))
    both = rules.unionByName(questions, allowMissingColumns=True)
    ranges = max(1, -(-(keyed.count() + asked.count()) // SWEEP_ROWS))
    return stored(both.repartitionByRange(ranges, "key", "tie").withColumn("range", F.spark_partition_id()), "ranges")


def filtered(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages (page_id, url)``.

    ``rules (host, path, verdict)``: a rule fits its host and all its subdomains if the path begins with the rule's; the longest
    (host and path together) counts, and without one the ``default``. Null addresses and text without ``://`` have an empty
    host and path and no rule; null ids and repeated rows are kept. An empty table gives an empty result. Other columns are
    not read.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    known = judged(rows, rules).select(F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict")
    met = rows.join(known, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return met.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
