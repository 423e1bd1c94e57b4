"""Raw objects in the bronze layer: path layout, listing, newest snapshot, ingestion manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The path layout and the shape of an ingestion record.
PATH_PARTS = {"ano": r"/ano=(\d+)/", "data_extracao": r"/data_extracao=([^/]+)/", "hora": r"/hora=([^/]+)/"}
MANIFEST_SCHEMA = (
    "fonte string, tipo_ativo string, identificador struct<tipo: string, valor: string>, "
    "extracao struct<data: string, hora: string, timestamp_utc: string>, "
    "requisicao struct<url: string, status_code: int, encoding: string, "
    "headers struct<`User-Agent`: string>, tempo_resposta_ms: double>, "
    "dados struct<formato: string, separador: string, compactacao: string, tamanho_bytes: bigint, "
    "ano_referencia: int, moeda: string>, versao_ingestor string"
)


def bronze_path(source: Column, asset: Column, id_type: Column, id_value: Column, day: Column,
                time: Column | None = None) -> Column:
    """``source/asset/id_type=id_value/data_extracao=day/[hora=time/]`` as one expression."""
    parts = [source, F.lit("/"), asset, F.lit("/"), id_type, F.lit("="), id_value, F.lit("/data_extracao="), day,
             F.lit("/")]
    if time is not None:
        parts += [F.lit("hora="), time, F.lit("/")]
    return F.concat(*parts)


def list_objects(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``path, length, ano, data_extracao, hora`` of every object below ``root``, contents unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
        .load(root)
    )
    part = {name: F.nullif(F.regexp_extract("path", rx, 1), F.lit("")) for name, rx in PATH_PARTS.items()}
    part["ano"] = part["ano"].try_cast("int")
    return files.select("path", "length", *[c.alias(n) for n, c in part.items()])


def latest_path(objects: DataFrame, *keys: str) -> DataFrame:
    """Newest object per key: the greatest path, since a path embeds extraction day and time."""
    return objects.groupBy(*keys).agg(F.max("path").alias("path"))


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Ingestion records with their declared nested schema."""
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
    return reader.option("multiLine", str(multi_line).lower()).json(path)


def manifest_summary(records: DataFrame) -> DataFrame:
    """Objects, bytes and response time per source and asset type."""
    return records.groupBy("fonte", "tipo_ativo").agg(
        F.count(F.lit(1)).alias("objetos"),
        F.sum("dados.tamanho_bytes").alias("tamanho_bytes"),
        F.max("requisicao.tempo_resposta_ms").alias("tempo_resposta_ms_max"),
        F.count_if(F.col("requisicao.status_code") != 200).alias("falhas"),
    )


def ingestion_records(objects: DataFrame, source: str, compression: str = "ZIP", file_format: str = "CSV") -> DataFrame:
    """One ingestion record per listed object, with what its path and size tell; store it with ``write.json``."""
    day, hour = F.col("data_extracao"), F.col("hora")
    stamp = F.concat(day, F.lit("T"), F.translate(hour, "-", ":"))
    return objects.select(
        F.lit(source).alias("fonte"),
        F.regexp_extract("path", r"/([^/]+)/ano=", 1).alias("tipo_ativo"),
        F.struct(F.lit("ano").alias("tipo"), F.col("ano").cast("string").alias("valor")).alias("identificador"),
        F.struct(day.alias("data"), hour.alias("hora"), stamp.alias("timestamp_utc")).alias("extracao"),
        F.struct(
            F.lit(file_format).alias("formato"), F.lit(";").alias("separador"), F.lit(compression).alias("compactacao"),
            F.col("length").alias("tamanho_bytes"), F.col("ano").alias("ano_referencia"), F.lit("BRL").alias("moeda"),
        ).alias("dados"),
    )
