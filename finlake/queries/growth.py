"""Restatement, joins over time, mergeable summaries, account trees, snapshot differences, incremental ingestion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.operators.accounts import roll_up, unbalanced, wide
from finlake.operators.sketches import (
    DISTINCT_ERROR, QUANTILE_ERROR, distinct_counts, distinct_sketches, histogram, merged_histograms, quantile_sketches, quantiles,
)
from finlake.operators.snapshots import difference
from finlake.operators.temporal import asof_join, instant, interval_join
from finlake.queries.registry import query, table
from finlake.session import scratch_dir
from finlake.sinks.merge import merge_rows
from finlake.sinks.tables import YEAR, replace_years, years_in
from finlake.sources.tables import read_table
from finlake.streaming.bronze import rebuild_changed

# Restatement ----------------------------------------------------------------------------------------------------

#: Keys of inserted rows lie beyond all others.
_NEW_KEYS = 1_000_000_000


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.lit(1).alias("versao"), F.year("o_orderdate").cast("int").alias(YEAR)
    )


def _files_by_year(spark: SparkSession, path: str) -> DataFrame:
    files = read_table(spark, path).select(YEAR, F.col("_metadata.file_path").alias("file"))
    return files.groupBy(YEAR).agg(F.array_sort(F.collect_set("file")).alias("files"))


@query(f"""
    with o as (select o_orderkey, o_totalprice, cast(year(o_orderdate) as int) as y from orders),
    restated as (select * from o where y % 4 = 0 and o_orderkey % 7 = 0),
    moved as (select * from o where y % 4 = 2 and o_orderkey % 7 = 0),
    added as (select o_orderkey + {_NEW_KEYS} as o_orderkey, o_totalprice, y from o where y % 4 = 0 and o_orderkey % 13 = 0),
    touched as (
      select y from restated union select y from moved union select y + 1 from moved union select y from added),
    final as (
      select o_orderkey, o_totalprice + 1 as o_totalprice, 2 as versao, y from restated
      union all select o_orderkey, o_totalprice, 2, y + 1 from moved
      union all select o_orderkey, o_totalprice, 1, y from added
      union all select o_orderkey, o_totalprice, 1, y from o where not (y % 4 in (0, 2) and o_orderkey % 7 = 0))
    select o_orderkey, o_totalprice, versao, y as ano_referencia, y in (select y from touched) as ano_reescrito from final
""")
def merge_restated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows restated by a later version, moved to another year, inserted, and outdated ones that change nothing; the years that
    were rewritten are told by the names of their files."""
    path = scratch_dir(spark, "merge-target")
    orders = _orders(spark, sf)
    replace_years(orders, path, years_in(orders))
    before = _files_by_year(spark, path)
    before.write.parquet(f"{path}-before")
    before = spark.read.parquet(f"{path}-before")
    chosen, group = F.col("o_orderkey") % 7 == 0, F.col(YEAR) % 4
    updates = [
        orders.where(chosen & (group == 0)).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "versao": F.lit(2)}),
        orders.where(chosen & (group == 2)).withColumns({YEAR: F.col(YEAR) + 1, "versao": F.lit(2)}),
        orders.where((F.col("o_orderkey") % 13 == 0) & (group == 0)).withColumn("o_orderkey", F.col("o_orderkey") + _NEW_KEYS),
        orders.where(chosen & (group == 1)).withColumns({"o_totalprice": F.lit(-1.0), "versao": F.lit(0)}),
        orders.where(chosen & (group == 3)).withColumn("o_totalprice", F.lit(-1.0)),
    ]
    merge_rows(reduce(DataFrame.unionByName, updates), path, ["o_orderkey"], "versao")
    after = _files_by_year(spark, path).join(before.withColumnRenamed("files", "old"), YEAR, "left")
    rewritten = after.select(YEAR, (~F.arrays_overlap("files", F.coalesce("old", F.array().cast("array<string>")))).alias("ano_reescrito"))
    return read_table(spark, path).join(rewritten, YEAR).select("o_orderkey", "o_totalprice", "versao", YEAR, "ano_reescrito")


# Joins over time ------------------------------------------------------------------------------------------------


@query("""
    select e.event_id, e.user_id, s.event_id as visto_id, epoch_us(s.ts) as visto_em, s.value as visto_valor
    from (select * from events where event_type <> 'view') e
    asof left join (select * from events where event_type = 'view') s on e.user_id = s.user_id and e.ts > s.ts
""")
def asof_events(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with its user's latest earlier view."""
    events = table(spark, sf, "events")
    rows, views = events.where("event_type <> 'view'"), events.where("event_type = 'view'")
    views = views.withColumn("instante", instant(F.col("ts"), dict(views.dtypes)["ts"]))
    taken = {"visto_em": "instante", "visto_id": "event_id", "visto_valor": "value"}
    # Ranges of 1000 rows, so that the small tables too are split.
    found = asof_join(rows, views, ["user_id"], "ts", "ts", taken, rows_per_range=1000)
    return found.select("event_id", "user_id", "visto_id", "visto_em", "visto_valor")


_PERIODS_SQL = """
    select o_custkey, o_orderstatus, min(cast(o_orderdate as date)) as inicio, max(cast(o_orderdate as date)) as fim
    from orders group by o_custkey, o_orderstatus, year(o_orderdate)
"""


@query(f"""
    with p as ({_PERIODS_SQL}),
    l as (select l_orderkey, l_linenumber, o_custkey, cast(o_orderdate as date) as pedido, cast(l_shipdate as date) as envio
          from lineitem join orders on l_orderkey = o_orderkey)
    select l_orderkey, l_linenumber, l.o_custkey, pedido, envio, p.o_orderstatus as p_o_orderstatus, p.inicio as p_inicio, p.fim as p_fim
    from l join p on l.o_custkey = p.o_custkey and pedido <= fim and inicio <= envio and pedido <= envio
""")
def interval_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries, from order to shipment, with every period of activity of their customer that they overlap."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("pedido"))
    periods = orders.groupBy("o_custkey", "o_orderstatus", F.year("pedido").alias("ano")).agg(
        F.min("pedido").alias("inicio"), F.max("pedido").alias("fim")
    ).drop("ano")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("envio"))
    deliveries = lines.join(orders.drop("o_orderstatus"), lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")
    met = interval_join(deliveries, periods, ["o_custkey"], ("pedido", "envio"), ("inicio", "fim"), "p_")
    return met.select("l_orderkey", "l_linenumber", "o_custkey", "pedido", "envio", "p_o_orderstatus", "p_inicio", "p_fim")


# Mergeable summaries --------------------------------------------------------------------------------------------

_SPANS_SQL = """
    with y as (select distinct cast(year(o_orderdate) as int) as ano from orders),
    spans as (select a.ano as de, b.ano as ate from y a join y b on a.ano <= b.ano)
"""


def _spans(years: DataFrame) -> DataFrame:
    """All spans of years (a row per pair of years)."""
    ends = years.select(F.col(YEAR).alias("ate"))
    return years.select(F.col(YEAR).alias("de")).join(ends, F.col("de") <= F.col("ate"))


@query(f"""{_SPANS_SQL}
    select de, ate, 'o_custkey' as coluna, count(distinct o_custkey) as exatos, true as dentro
    from spans join orders on year(o_orderdate) between de and ate group by de, ate
    union all
    select de, ate, 'o_orderkey', count(distinct o_orderkey), true
    from spans join orders on year(o_orderdate) between de and ate group by de, ate
""")
def distinct_by_span(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers and orders of every span of years from one stored sketch per year, held against exact counts within four
    standard errors."""
    orders = table(spark, sf, "orders").withColumn(YEAR, F.year("o_orderdate").cast("int"))
    columns, path = ["o_custkey", "o_orderkey"], scratch_dir(spark, "distinct")
    sketches = distinct_sketches(orders, columns, [YEAR])
    replace_years(sketches, path, years_in(orders), rebalance=False)
    stored = read_table(spark, path)
    spans = _spans(stored.select(YEAR).distinct())
    merged = distinct_counts(stored.join(F.broadcast(spans), F.col(YEAR).between(F.col("de"), F.col("ate"))), ["de", "ate"])
    rows = orders.select(YEAR, F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("v")) for c in columns]))).distinct()
    exact = rows.join(F.broadcast(spans), F.col(YEAR).between(F.col("de"), F.col("ate"))).groupBy("de", "ate", "coluna").agg(
        F.count_distinct("v").alias("exatos")
    )
    near = F.abs(F.col("distintos") - F.col("exatos")) <= F.col("exatos") * (4 * DISTINCT_ERROR) + 1
    return merged.join(exact, ["de", "ate", "coluna"]).select("de", "ate", "coluna", "exatos", near.alias("dentro"))


_SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(f"""
    with s as (select unnest([{','.join(map(str, _SHARES))}]) as parte),
    y as (select cast(year(o_orderdate) as int) as ate, count(*) as c from orders group by all)
    select a.ate, cast(sum(b.c) as bigint) as n, cast(parte as double) as parte, true as dentro
    from y a join y b on b.ate <= a.ate, s group by a.ate, parte
""")
def quantiles_by_span(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of prices over all years up to each one, from one stored sketch per year; their exact ranks are within the bound."""
    orders = table(spark, sf, "orders").select("o_totalprice", F.year("o_orderdate").cast("int").alias(YEAR))
    path = scratch_dir(spark, "quantiles")
    replace_years(quantile_sketches(orders, ["o_totalprice"], [YEAR]), path, years_in(orders), rebalance=False)
    stored = read_table(spark, path)
    upto = stored.select(F.col(YEAR).alias("ate")).distinct()
    merged = quantiles(stored.join(F.broadcast(upto), F.col(YEAR) <= F.col("ate")), _SHARES, ["ate"])
    below = orders.join(F.broadcast(merged), F.col(YEAR) <= F.col("ate")).groupBy("ate", "n", "parte").agg(
        F.count_if(F.col("o_totalprice") < F.col("valor")).alias("menores"), F.count_if(F.col("o_totalprice") <= F.col("valor")).alias("ate_valor")
    )
    slack = F.col("n") * QUANTILE_ERROR + 1
    near = (F.col("menores") <= F.col("parte") * F.col("n") + slack) & (F.col("ate_valor") >= F.col("parte") * F.col("n") - slack)
    return below.select("ate", "n", "parte", near.alias("dentro"))


_BOUNDS = (10, 100, 1000, 10_000, 100_000)


@query(f"""
    with b as (select unnest([{','.join(f'{b}.0' for b in _BOUNDS)}, 'infinity'::double]) as ate),
    placed as (select event_id, event_type, min(ate) as ate from events join b on value <= ate group by event_id, event_type)
    select event_type, ate, count(*) as n from placed group by event_type, ate
""")
def histograms_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Histograms of values per type and day, merged to one per type."""
    events = table(spark, sf, "events").withColumn("dia", F.to_date("ts"))
    return merged_histograms(histogram(events, "value", _BOUNDS, ["event_type", "dia"]), ["event_type"]).drop("soma")


# Account trees --------------------------------------------------------------------------------------------------

_LEAVES = "concat('3.', lpad(cast(l_linenumber as {text}), 2, '0'), '.', lpad(cast(l_suppkey % 7 as {text}), 2, '0'))"
_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
#: Filed parents are the sums of their children, but for those of some years and lines, which are off by one.
_FILED_SQL = """
    with leaves as (select cast(year(l_shipdate) as int) as ano, {leaf} as conta, sum({cents}) as valor from lineitem group by all),
    lines as (select ano, substr(conta, 1, 4) as conta, sum(valor) as valor from leaves group by all),
    filed as (
      select ano, conta, cast(valor as bigint) as valor from leaves
      union all
      select ano, conta, cast(valor + case when (ano + cast(substr(conta, 4, 1) as int)) % 3 = 0 then 1 else 0 end as bigint) from lines
      union all select ano, '3', cast(sum(valor) as bigint) from lines group by ano)
"""


def _filed(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("int").alias("ano"), F.expr(_LEAVES.format(text="string")).alias("conta"), F.expr(_CENTS).alias("valor")
    )
    leaves = lines.groupBy("ano", "conta").agg(F.sum("valor").alias("valor"))
    totals = roll_up(leaves, "conta", "valor", ["ano"]).where("nivel < 3")
    wrong = (F.col("nivel") == 2) & ((F.col("ano") + F.substring("conta", 4, 1).cast("int")) % 3 == 0)
    return leaves.unionByName(totals.select("ano", "conta", (F.col("total") + wrong.cast("int")).alias("valor")))


_FILED = _FILED_SQL.format(leaf=_LEAVES.format(text="varchar"), cents=_CENTS)


@query(f"""{_FILED},
    below as (
      select ano, regexp_replace(conta, '\\.[^.]*$', '') as conta, sum(valor) as filhas, count(*) as n_filhas
      from filed where contains(conta, '.') group by all)
    select f.ano, f.conta, f.valor, cast(b.filhas as bigint) as filhas, b.n_filhas
    from filed f join below b on f.ano = b.ano and f.conta = b.conta where f.valor <> b.filhas
""")
def accounts_unbalanced(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts whose children do not add up to them."""
    return unbalanced(_filed(spark, sf), "conta", "valor", ["ano"])


@query(f"""
    with leaves as (
      select cast(year(l_shipdate) as int) as ano, {_LEAVES.format(text='varchar')} as conta, {_CENTS} as valor from lineitem),
    spread as (
      select ano, conta, valor, 3 as nivel from leaves union all select ano, substr(conta, 1, 4), valor, 2 from leaves
      union all select ano, '3', valor, 1 from leaves)
    select ano, conta, cast(nivel as int) as nivel, cast(sum(valor) as bigint) as total, count(*) as contas from spread group by all
""")
def accounts_rolled_up(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts of every account with all below it, per year."""
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("int").alias("ano"), F.expr(_LEAVES.format(text="string")).alias("conta"), F.expr(_CENTS).alias("valor")
    )
    return roll_up(lines, "conta", "valor", ["ano"])


@query(f"""
    pivot (select cast(year(l_shipdate) as int) as ano, l_suppkey, concat('l', cast(l_linenumber as varchar)) as conta, {_CENTS} as valor from lineitem)
    on conta using cast(sum(valor) as bigint) group by ano, l_suppkey
""")
def accounts_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A row per supplier and year, an account per column."""
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("int").alias("ano"), "l_suppkey", F.concat(F.lit("l"), F.col("l_linenumber").cast("string")).alias("conta"),
        F.expr(_CENTS).alias("valor"),
    )
    return wide(lines, ["ano", "l_suppkey"], "conta", "valor")


# Snapshots ------------------------------------------------------------------------------------------------------


@query("""
    with before as (
      select p_brand, p_type, p_size, p_retailprice from part where p_partkey % 5 <> 0
      union all select p_brand, p_type, p_size, p_retailprice from part where p_partkey % 9 = 1),
    after as (
      select p_brand, p_type, p_size, case when p_partkey % 7 = 0 then p_retailprice + 1 else p_retailprice end as p_retailprice
      from part where p_partkey % 6 <> 0),
    gone as (select * from before except all select * from after),
    came as (select * from after except all select * from before),
    net as (
      select p_brand, p_type, count(*) filter (side = 1) as more, count(*) filter (side = 0) as less
      from (select *, 1 as side from came union all select *, 0 from gone) group by all)
    select p_brand, p_type, more - least(more, less) as incluidas, less - least(more, less) as excluidas, least(more, less) as alteradas
    from net
""")
def snapshot_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Parts added, removed and altered between two states with repeated rows, per brand and type."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    before = part.where("p_partkey % 5 <> 0").unionByName(part.where("p_partkey % 9 = 1")).drop("p_partkey")
    price = F.when(F.col("p_partkey") % 7 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
    after = part.where("p_partkey % 6 <> 0").withColumn("p_retailprice", price).drop("p_partkey")
    return difference(before, after, ["p_brand", "p_type"])


# Incremental ingestion ------------------------------------------------------------------------------------------


@query("""
    select cast(dayofyear(ts) as int) as ano, event_id, user_id,
           case when dayofyear(ts) % 2 = 0 then 2 else 1 end as construcoes
    from events where dayofyear(ts) % 2 = 0 or event_id % 2 = 0
""")
def incremental_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals of snapshots noticed by a file stream: first the even events of all days, then all events of every other day;
    only the days of the second arrival are built again, from their newest snapshot."""
    root, state, target, log = (scratch_dir(spark, f"arrivals-{n}") for n in ("files", "state", "table", "log"))
    events = table(spark, sf, "events").select("event_id", "user_id", F.dayofyear("ts").alias("ano"))
    schema = "event_id long, user_id long"
    day = F.regexp_extract("path", r"/ano=(\d+)/", 1)
    snapshot = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)

    def rebuild(newest: dict[str, str]) -> None:
        days = sorted(map(int, newest))
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/ano=(\d+)/", 1).cast("int")
        rows = spark.read.schema(schema).json(list(newest.values())).withColumn(YEAR, folder)
        replace_years(rows, target, days)
        spark.createDataFrame([(d,) for d in days], "ano int").write.mode("append").parquet(log)

    arrivals = [events.where("event_id % 2 = 0"), events.where("ano % 2 = 0")]
    for i, rows in enumerate(arrivals):
        stamped = rows.withColumn("data_extracao", F.lit(f"2024-02-0{i + 1}"))
        stamped.repartition("ano").write.mode("append").partitionBy("ano", "data_extracao").json(root)
        rebuild_changed(spark, root, ".json", day, snapshot, state, rebuild)
    built = spark.read.parquet(log).groupBy("ano").agg(F.count(F.lit(1)).cast("int").alias("construcoes"))
    return read_table(spark, target).withColumnRenamed(YEAR, "ano").join(built, "ano").select("ano", "event_id", "user_id", "construcoes")
