"""Incremental ingestion: new snapshots are noticed by a file stream, and only the keys they belong to are rebuilt."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.plans.builds import Outcome, build_silver
from finlake.plans.specs import DOCUMENT_FOLDERS, SOURCE_SYSTEM
from finlake.sinks.tables import overwrite_table, path_exists, remove

STATE = "chave string, caminho string, lote bigint"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def snapshot_stream(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``path`` of every file below ``root`` as it appears; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", f"*{suffix}")
    return reader.option("recursiveFileLookup", "true").load(root).select("path")


def rebuild_changed(
    spark: SparkSession, root: str, suffix: str, key: Column, snapshot: Column, state: str, rebuild: Callable[[dict[str, str]], None],
) -> dict[str, str]:
    """Take all files that came since the last call and rebuild the keys that have a newer snapshot; returns those.

    ``key`` and ``snapshot`` are expressions over ``path``; of a key's snapshots the greatest counts. ``rebuild`` gets the newest
    snapshot of each changed key, and has to give the same result when it is called again: after a crash a batch comes once more.
    The stream's checkpoint and the table of newest snapshots (a row per key) live below ``state``. Files that match no key are
    passed over.
    """
    changed: dict[str, str] = {}
    table = f"{state}/newest"

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        found = batch.select(key.alias("chave"), snapshot.alias("caminho")).where("chave <> '' and caminho <> ''")
        found = found.groupBy("chave").agg(F.max("caminho").alias("caminho"))
        # Two copies take turns, so the one that is read is never the one that is written.
        sides = [f"{table}-{i}" for i in (0, 1)]
        known = _newest_state(session, sides)
        newer = found.join(known.select("chave", F.col("caminho").alias("__known")), "chave", "left")
        newer = {r["chave"]: r["caminho"] for r in newer.where("__known is null or caminho > __known").collect()}  # a row per key
        if not newer:
            return
        rebuild(newer)
        fresh = session.createDataFrame([(k, p, number) for k, p in newer.items()], STATE)
        merged = known.join(fresh, "chave", "left_anti").unionByName(fresh)
        overwrite_table(merged.coalesce(1), sides[_current(session, sides) ^ 1])
        remove(session, sides[_current(session, sides, oldest=True)])
        changed.update(newer)

    query = (
        snapshot_stream(spark, root, suffix).writeStream.foreachBatch(take).trigger(availableNow=True)
        .option("checkpointLocation", f"{state}/checkpoint").start()
    )
    query.awaitTermination()
    return changed


def _batch_of(spark: SparkSession, path: str) -> int:
    """The last batch that a copy of the state knows; -1 where there is none, or where it was not finished."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return -1
    return spark.read.schema(STATE).parquet(path).agg(F.coalesce(F.max("lote"), F.lit(-1))).first()[0]


def _current(spark: SparkSession, sides: list[str], oldest: bool = False) -> int:
    batches = [_batch_of(spark, side) for side in sides]
    return int(batches[1] > batches[0]) ^ int(oldest)


def _newest_state(spark: SparkSession, sides: list[str]) -> DataFrame:
    side = sides[_current(spark, sides)]
    return spark.read.schema(STATE).parquet(side) if path_exists(spark, f"{side}/_SUCCESS") else spark.createDataFrame([], STATE)


def ingest_new_archives(
    spark: SparkSession, lake: Lake, document: str, run_ts: datetime | None = None,
    build: Callable[..., list[Outcome]] = build_silver,
) -> Mapping[int, list[Outcome]]:
    """Rebuild the years of a document type that have a newer archive than at the last call; outcomes per year."""
    outcomes: dict[int, list[Outcome]] = {}

    def rebuild(newest: dict[str, str]) -> None:
        for outcome in build(spark, lake, document, sorted(map(int, newest)), run_ts=run_ts):
            outcomes.setdefault(outcome.year, []).append(outcome)

    year = F.regexp_extract("path", r"/ano=(\d+)/", 1)
    root = f"{lake.bronze}/{SOURCE_SYSTEM}/{DOCUMENT_FOLDERS[document]}"
    rebuild_changed(spark, root, ".zip", year, F.col("path"), f"{lake.root}/state/{document}", rebuild)
    return outcomes
