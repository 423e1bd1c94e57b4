"""The physical plans are the ones intended."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from finlake.operators.quality import profile
from finlake.operators.rows import repeat_per_match, with_match
from finlake.operators.star import build_fact
from finlake.plans.builds import checks_for
from finlake.plans.specs import SPECS
from finlake.plans.star import FACTS
from finlake.queries.gold import cleaned
from finlake.session import scratch_dir
from finlake.sinks.tables import replace_years
from finlake.sources.tables import read_table


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf):
    """Cleaned balance sheets stored by year."""
    path = scratch_dir(spark, "plan-test")
    replace_years(cleaned(spark, sf, "BPP_con"), path, range(1995, 2003))
    return path


def test_a_year_is_read_from_its_own_files(spark, stored):
    plan = physical(read_table(spark, stored, 1998))
    assert "(ano_referencia" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_facts_are_narrow_and_read_only_their_columns(spark, stored):
    silver = read_table(spark, stored).where(F.col("ano_referencia").isin([1997, 1998]))
    plan = physical(build_fact({"BPA_con": silver, "BPP_con": silver}, FACTS["FATO_BALANCO"]))
    assert "Exchange" not in plan
    assert "DENOM_CIA" not in plan.split("ReadSchema")[1]
    assert "PushedFilters: [IsNotNull(VL_CONTA)]" in plan
    assert "ano_referencia" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_cleaning_is_one_narrow_stage_unless_copies_are_removed(spark, sf):
    assert "Exchange" not in physical(cleaned(spark, sf, "BPP_con"))
    assert physical(cleaned(spark, sf, "distribuicao_dividendos")).count("Exchange") == 1


def test_profile_is_two_scans_with_the_key_pass_narrow(spark, stored):
    plan = physical(profile(read_table(spark, stored), checks_for(SPECS["BPP_con"]), date(2001, 1, 1), by="ano_referencia"))
    scans = plan.split("ReadSchema: ")[1:]
    assert len(scans) == 2
    narrow = min(scans, key=len).split("\n")[0]
    assert "CNPJ_CIA" in narrow and "VL_CONTA" not in narrow
    assert "partial_count" in plan


def test_dimension_is_broadcast_only_when_known_small(spark):
    fact = spark.range(1000).select(F.col("id").cast("string").alias("cnpj"), "id")
    dim = spark.range(10).select(F.col("id").cast("string").alias("cnpj"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (repeat_per_match, with_match):
            assert "BroadcastHashJoin" in physical(join(fact, "cnpj", dim, "cnpj", dimension_rows=10))
            assert "SortMergeJoin" in physical(join(fact, "cnpj", dim, "cnpj"))
            assert "SortMergeJoin" in physical(join(fact, "cnpj", dim, "cnpj", dimension_rows=2_000_000_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_dimension_is_not_multiplied(spark):
    fact = spark.range(1000).select(F.col("id").cast("string").alias("cnpj"), "id")
    dim = spark.range(100_000).select(F.col("id").cast("string").alias("cnpj"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (repeat_per_match, with_match):
            assert "Generate" not in physical(join(fact, "cnpj", dim, "cnpj"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_company_is_split_over_tasks(spark):
    """Half the fact belongs to one company and the dimension is too big to broadcast."""
    fact = spark.range(0, 200_000, numPartitions=4).selectExpr(
        "case when id % 2 = 0 then 'hot' else cast(id as string) end as cnpj", "id", "repeat('x', 50) as pad"
    )
    dim = spark.range(0, 50_000, numPartitions=4).selectExpr("cast(id as string) as cnpj").unionAll(
        spark.sql("select 'hot' as cnpj")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for join in (repeat_per_match, with_match):
            df = join(fact, "cnpj", dim, "cnpj")
            assert df.agg(F.count("*"), F.count_distinct("id")).first() == (100_000 + 25_000, 125_000)
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            plan = physical(df)
            assert "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_a_hot_year_becomes_many_files(spark, folder):
    rows = spark.range(0, 400_000, numPartitions=8).selectExpr(
        "id", "xxhash64(id) as noise", "cast(if(id % 10 = 0, 2001 + id % 3, 2000) as int) as ano_referencia"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        written = replace_years(rows, f"{folder}/t", range(2000, 2004))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert written[2000] == 360_000
    files = read_table(spark, f"{folder}/t").inputFiles()
    assert sum("ano_referencia=2000" in f for f in files) > 3
    assert sum("ano_referencia=2001" in f for f in files) <= 2


def test_no_query_uses_a_row_at_a_time_function(spark, sf):
    from finlake.queries import QUERIES

    for name in ("silver_income", "fact_quotes", "quality_summary", "current_ratio", "normalize_text"):
        assert "Python" not in physical(QUERIES[name](spark, sf)), name
