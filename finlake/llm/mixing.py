"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words. DataFrame functions only.

The words of a source are laid out shard by shard, documents in seeded order, and cut into blocks of ``BLOCK`` words. All
blocks of the mix are given to sources by highest quotients ``target / (2 k + 1)``, and a source's blocks to its shards by
highest quotients of their sizes. A shard repeats all its blocks as often as its quota holds them and takes the rest as one
run of blocks that starts at a seeded place (and goes on at the front), so only the documents at the two ends of a run are
taken in part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.shared import BROADCAST_IDS, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 16
SHARD_DOCUMENTS = 8192
MOST_REPEATS = 3
CYCLE = 3
SEED = "mix-1"


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def _number(md5: Column) -> Column:
    return F.conv(F.substring(md5, 1, 8), 16, 10).cast("long")


def words(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)`` per row; a null text has no words."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, documents, target)``: one row per source, null being one.

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share the words of all. In ascending order of
    limit per weight, a source is held to its limit if its share of what those before it leave is above that; so
    the excess ends up shared by weight. The table has a row per source, so one task orders it.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = by_source.withColumn("weight", (place - 1) % CYCLE + 1).withColumn("most", F.col("source_size") * MOST_REPEATS)
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = weighed.select("*", left.alias("left"), weights.alias("weights"), F.row_number().over(order).alias("rank"))
    held = F.col("most") * F.col("weights") <= F.col("weight") * F.col("left")
    free = F.when(~held, F.struct("rank", "left", "weights"))
    shared = ranked.select("*", held.alias("held"), F.min(free).over(every).alias("free"))
    target = F.when(F.col("held"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("free.left") / F.col("free.weights"))
    return shared.select("source", "source_size", "documents", target.alias("target"))


def apportioned(units: DataFrame, group: list[str], unit: list[str]) -> DataFrame:
    """``units`` with ``quota``: the ``seats`` of each group given to its units by highest ``votes / (2 k + 1)``.

    No unit gets more than ``most``. With S units, N seats and V votes, the deciding quotient is that of a divisor between
    V / (N + S / 2) and V / (N - S / 2): seats beyond the second are certain, and only those between the two are ranked, a few
    per unit. Ties go to the smaller unit.
    """
    whole = Window.partitionBy(*group)
    per = F.when(F.sum("votes").over(whole) > 0, F.col("votes") / F.sum("votes").over(whole)).otherwise(F.lit(0.0))
    half = F.count(F.lit(1)).over(whole) / 2
    sure = F.least("most", F.greatest(F.floor(per * (F.col("seats") - half) + 0.5) - 1, F.lit(0)))
    open_ = F.when(F.col("votes") > 0, F.least("most", F.floor(per * (F.col("seats") + half) + 0.5) + 2)).otherwise(F.lit(0))
    known = units.select("*", sure.cast("long").alias("sure"), open_.cast("long").alias("open"))
    known = known.withColumn("rest", F.col("seats") - F.sum("sure").over(whole))
    seat = F.explode_outer(F.expr("case when open > sure then sequence(sure, open - 1) end")).alias("seat")
    quotient = F.col("votes") / (2 * F.col("seat") + 1)
    order = whole.orderBy(quotient.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in unit], F.col("seat"))
    won = known.select("*", seat).withColumn("won", F.col("seat").isNotNull() & (F.row_number().over(order) <= F.col("rest")))
    columns = [c for c in units.columns]
    return won.groupBy(*columns).agg((F.first("sure") + F.sum(F.col("won").cast("long"))).alias("quota"))


def plan(sizes: DataFrame) -> DataFrame:
    """What the mix takes of every row of ``sizes (doc_id, source, size)``.

    Adds ``source_size``, ``target``, ``taken`` (words, repeats counted), ``copies`` (whole ones), and the words
    ``[first, last)`` and ``[0, wrapped)`` taken besides.
    """
    sources = stored(targets(sizes), "sources")
    most = F.lit(MOST_REPEATS) * F.ceil(F.col("votes_words") / BLOCK)
    blocks = F.floor(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / BLOCK + 0.5).cast("long")
    by_source = sources.select("source", F.lit(0).alias("all"), F.col("target").alias("votes"), F.col("source_size").alias("votes_words"), blocks.alias("seats"))
    quotas = apportioned(by_source.withColumn("most", most), ["all"], ["source"])
    quotas = stored(quotas.select(F.col("source").alias("of"), "quota"), "quotas")
    known = sources.select(F.col("source").alias("of"), "source_size", "target", F.ceil(F.col("documents") / SHARD_DOCUMENTS).alias("shards"))
    key = _hash(F.col("doc_id"))
    laid = sizes.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    laid = laid.withColumn("key", key).withColumn("shard", _number(F.col("key")) % F.col("shards")).drop("shards")
    shards = laid.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    shards = shards.join(quotas, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "shard", "words", F.col("words").cast("double").alias("votes"), F.col("words").alias("votes_words"), F.col("quota").alias("seats"),
    )
    shares = apportioned(shards.withColumn("most", most), ["source"], ["shard"])
    n = F.greatest(F.ceil(F.col("words") / BLOCK), F.lit(1))
    shares = shares.select(
        F.col("source").alias("of"), F.col("shard").alias("part"), n.alias("n"), F.floor(F.col("quota") / n).alias("copies"),
        (F.col("quota") % n).alias("run"), (_number(_hash(F.col("source"), F.col("shard"))) % n).alias("start"),
    )
    shares = stored(shares, "shares")
    met = laid.join(shares, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("part")))
    order = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    met = met.withColumn("end", end).withColumn("begin", F.col("end") - F.col("size"))
    run_start, run_end = F.col("start") * BLOCK, (F.col("start") + F.col("run")) * BLOCK
    first = F.greatest("begin", run_start)
    last = F.greatest(first, F.least("end", run_end))
    wrapped = F.greatest(F.lit(0), F.least("end", run_end - F.col("n") * BLOCK) - F.col("begin"))
    met = met.withColumn("first", first - F.col("begin")).withColumn("last", last - F.col("begin")).withColumn("wrapped", wrapped)
    taken = F.col("copies") * F.col("size") + F.col("last") - F.col("first") + F.col("wrapped")
    return met.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "copies", "first", "last", "wrapped")


def mix(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, source)`` for every row of ``docs (doc_id, text, source)``.

    Null texts have size 0 and are taken 0 times; a null source is a source; null ids and repeated rows are rows like any other
    (equal rows may trade places, which changes nothing but which of them is which). An empty table gives an empty result. Other
    columns are not read. The same rows give the same mix however they are partitioned.
    """
    return plan(stored(words(docs), "sizes")).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns and its whole text.

    At the two ends of a shard's run, a document is taken when at least half of it is, so each shard is within a document of its
    quota. Null and empty texts have no words and are never taken; a null source is a source; rows that agree in id, source and
    size, null ids too, share what the plan takes of them in the order of their texts. Columns may have any names and types; an
    empty table gives an empty result.

    Only ids, sources, sizes and numbers are exchanged. The rows themselves stay where they are, unless more than
    ``BROADCAST_IDS`` of them are taken, or their id is null or repeats.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    of = dict(zip(names, rows.columns))
    size = F.coalesce(F.regexp_count(F.col(of["text"]).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    key = [F.col(of["doc_id"]).cast("long").alias("id"), F.col(of["source"]).cast("string").alias("source"), size.alias("size")]
    # Sums of integers keep halves exact.
    part = F.col("last") - F.col("first") + F.col("wrapped")
    times = (F.col("copies") + F.when(F.col("size") > 0, F.floor((2 * part + F.col("size")) / (2 * F.col("size")))).otherwise(0)).cast("int")
    planned = plan(stored(words(docs), "sizes")).select(F.col("doc_id").alias("id"), "source", "size", times.alias("times"))
    planned = stored(planned, "takes")
    per_id = planned.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.max("times").alias("taken"))
    unique = F.col("id").isNotNull() & (F.col("rows") == 1)
    once = stored(per_id.where(unique & (F.col("taken") > 0)).select(F.col("id").alias("of_id"), "taken"), "once")
    small = once.count() <= BROADCAST_IDS
    keyed = rows.select("*", *key)
    alone = keyed.join(F.broadcast(once) if small else once, F.col("id") == F.col("of_id")).select(*rows.columns, "taken")
    # Rows of an id that is null or repeats are told apart by source and size, and shared by the order of their texts.
    again = stored(per_id.where(~unique).select(F.col("id").alias("of_id")), "again")
    parts = [alone]
    if not again.isEmpty():
        takes = planned.join(again, F.col("id").eqNullSafe(F.col("of_id"))).groupBy("id", "source", "size").agg(
            F.sort_array(F.collect_list(F.when(F.col("times") > 0, F.col("times"))), False).alias("times")
        )
        several = stored(takes.where(F.size("times") > 0), "several").toDF("of_id", "of_source", "of_size", "times")
        match = F.col("id").eqNullSafe(F.col("of_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))
        place = F.row_number().over(Window.partitionBy("id", "source", "size").orderBy(of["text"]))
        met = keyed.join(F.broadcast(several) if several.count() <= BROADCAST_IDS else several, match)
        parts.append(met.withColumn("taken", F.get("times", place - 1)).where("taken is not null").select(*rows.columns, "taken"))
    out = reduce(DataFrame.unionByName, parts).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("taken"))))
    return out.select(*rows.columns).toDF(*names)
