"""Cleaned tables: the whole cleaner on each kind of filing, and each of its steps alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.dates import parse_date
from finlake.functions.numbers import scale_units, to_bigint, to_double
from finlake.functions.predicates import has_text, matches, same_text
from finlake.functions.text import account_level, fold_text, null_if_token, strip_id, tidy_strings
from finlake.operators.clean import RowRule, TableSpec, UnitRule, clean, drop_empty, keep_rows, with_lineage
from finlake.plans.specs import SPECS, per_share_unscaled
from finlake.queries import filings
from finlake.queries.filings import raw
from finlake.queries.registry import query, table


@query(filings.statement_sql("DRE_con"))
def silver_income(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "statements"), SPECS["DRE_con"])


@query(filings.statement_sql("DRE_con", "ESCALA_MOEDA like '%MIL%' and DS_CONTA not ilike '%por ação%'"))
def silver_income_per_share(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "statements"), per_share_unscaled(SPECS["DRE_con"]))


@query(filings.statement_sql("BPA_con"))
def silver_assets(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "statements"), SPECS["BPA_con"])


@query(filings.statement_sql("BPP_con"))
def silver_liabilities(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "statements"), SPECS["BPP_con"])


@query(filings.statement_sql("DFC_DMPL_con"))
def silver_equity(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "statements"), SPECS["DFC_DMPL_con"])


@query(filings.QUOTES_SQL)
def silver_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "quotes"), SPECS["volume_valor_mobiliario"])


@query(filings.DIVIDENDS_SQL)
def silver_dividends(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "dividends"), SPECS["distribuicao_dividendos"])


@query(filings.CAPITAL_SQL)
def silver_capital(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "capital"), SPECS["capital_social"])


@query(f"""
    select distinct * replace (case when ano_referencia % 2 = 0 then null else Quantidade_Acoes_Preferenciais end
                               as Quantidade_Acoes_Preferenciais)
    from ({filings.CAPITAL_SQL})
""")
def silver_capital_short_header(spark: SparkSession, sf: str) -> DataFrame:
    """Years whose header lacks one share count: the others stay typed, and all years go together."""
    rows, spec = raw(spark, sf, "capital"), SPECS["capital_social"]
    short = clean(rows.where("ano_referencia % 2 = 0").drop("Quantidade_Acoes_Preferenciais"), spec)
    return clean(rows.where("ano_referencia % 2 <> 0"), spec).unionByName(short, allowMissingColumns=True)


@query(filings.SECURITIES_SQL)
def silver_securities(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "securities"), SPECS["cad_valor_mobiliario"])


@query(filings.SHARES_SQL)
def silver_share_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "shares"), SPECS["composicao_capital"])


@query(filings.REGISTER_SQL)
def register_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean(raw(spark, sf, "register"), SPECS["cad_cia_aberta"])


ORDERS = TableSpec(
    name="orders", document="DFP", member="orders",
    rules=(
        RowRule(("o_orderpriority",), lambda: matches(F.col("o_orderpriority"), "urgent|high|low")),
        RowRule(("o_clerk",), lambda: F.col("o_clerk").isNotNull()),
    ),
    doubles=("o_totalprice",), bigints=("o_orderkey", "o_custkey"), dates=("o_orderdate",),
    ids=(("cliente", "o_name"),), unit=UnitRule("o_totalprice", "o_unit"), distinct=True,
)


@query("""
    select distinct cast(o_orderkey as bigint) as o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus,
           o_totalprice * case when o_orderstatus = 'O' then 1000 else 1 end as o_totalprice,
           cast(o_orderdate as date) as o_orderdate, o_orderpriority,
           case when o_orderstatus = 'O' then 'MIL' else 'UNIDADE' end as o_unit,
           concat('Customer-', cast(o_custkey as varchar)) as o_name,
           concat('Customer', cast(o_custkey as varchar)) as cliente, 'DFP' as document_type,
           cast(year(o_orderdate) as int) as ano_referencia
    from orders where regexp_matches(lower(o_orderpriority), 'urgent|high|low')
""")
def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cleaner with a specification of its own; one rule names a column that never arrives."""
    text = table(spark, sf, "orders").selectExpr(
        "concat(' ', cast(o_orderkey as string)) as o_orderkey", "cast(o_custkey as string) as o_custkey",
        "case when o_orderstatus = 'P' then 'N/A' else o_orderstatus end as o_orderstatus",
        "cast(o_totalprice as string) as o_totalprice", "cast(cast(o_orderdate as date) as string) as o_orderdate",
        "o_orderpriority", "case when o_orderstatus = 'O' then 'MIL' else 'UNIDADE' end as o_unit",
        "concat('Customer-', cast(o_custkey as string)) as o_name",
    )
    rows = with_lineage(clean(text, ORDERS), ORDERS, "2024-01-01 00:00:00", F.year("o_orderdate"))
    return rows.drop("data_processamento")


@query("select p_partkey, case when p_type <> 'PROMO' then p_type end as p_type from part")
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    filed = F.when(F.col("p_type") == "PROMO", F.lit("#N/A")).otherwise(F.col("p_type"))
    return parts.select("p_partkey", filed.alias("p_type")).withColumn("p_type", null_if_token("p_type"))


@query("select p_partkey, p_name, nullif(p_type, 'PROMO') as p_type from part")
def trim_all(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "part").selectExpr(
        "p_partkey", "concat('  ', p_name, ' ') as p_name",
        "case when p_type = 'PROMO' then ' null ' else concat(p_type, '  ') end as p_type",
    )
    return tidy_strings(padded)


@query("select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus from orders where o_orderstatus <> 'P'")
def not_null_filter(spark: SparkSession, sf: str) -> DataFrame:
    status = null_if_token("o_orderstatus", ("P",)).alias("o_orderstatus")
    rows = table(spark, sf, "orders").select("o_orderkey", status)
    return keep_rows(rows, [RowRule(("o_orderstatus",), lambda: F.col("o_orderstatus").isNotNull())])


@query("""
    select p_partkey, p_name, p_type from part
    where regexp_matches(lower(p_name), 'red|small .*bolt') and p_type ilike 'economy'
""")
def regex_filter(spark: SparkSession, sf: str) -> DataFrame:
    rule = RowRule(
        ("p_name", "p_type"), lambda: matches(F.col("p_name"), "red|small .*bolt") & same_text(F.col("p_type"), "economy")
    )
    return keep_rows(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), [rule])


@query("select c_custkey, c_mktsegment from customer where c_mktsegment ilike 'machinery'")
def ilike_equal(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return rows.where(same_text(F.col("c_mktsegment"), "Machinery"))


@query("select p_partkey, p_name from part where p_name ilike '%BOLT%'")
def ilike_contains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_name").where(has_text(F.col("p_name"), "BOLT"))


@query("select c_custkey, c_name, c_mktsegment from customer")
def schema_conditional(spark: SparkSession, sf: str) -> DataFrame:
    """Rules and casts whose columns are absent leave the rows as they are."""
    spec = TableSpec(
        name="customer", document="CAD", member="customer",
        rules=(RowRule(("c_mktsegment", "c_region"), lambda: same_text(F.col("c_region"), "none")),),
        doubles=("c_balance",), bigints=("c_custkey", "c_absent"), dates=("c_since",), ids=(("c_id", "c_taxid"),),
    )
    return clean(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), spec)


@query("""
    select nullif(event_type, 'view') as event_type, case when event_type <> 'view' then value end as value
    from events where event_type <> 'view'
""")
def drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr(
        "nullif(event_type, 'view') as event_type", "case when event_type <> 'view' then value end as value"
    )
    spec = TableSpec(
        name="events", document="CAD", member="events", doubles=("value",),
        rules=(RowRule(("value",), lambda: F.lit(True), proves=("value",)), RowRule(("absent",), lambda: F.lit(False), proves=("event_type",))),
    )
    return drop_empty(rows, spec)


@query("select c_custkey, replace(c_name, '#', '') as c_name from customer", name="strip_id")
def strip_id_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", strip_id(F.col("c_name"), "#").alias("c_name"))


@query("""
    select doc_id, translate(lower(text), 'áàãâäéèêëíìîïóòõôöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') as text
    from documents
""")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", fold_text(F.col("text")).alias("text"))


@query("""
    select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then l_extendedprice end as price,
           case when l_linestatus <> 'O' then l_partkey * 10000000000 end as part_code,
           cast(l_linenumber as varchar) as line_text
    from lineitem
""")
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_returnflag = 'R' then '1,5' else cast(l_extendedprice as string) end p",
        "case when l_linestatus = 'O' then '12x' else concat(cast(l_partkey as string), '0000000000') end k",
    )
    return text.select(
        "l_orderkey", "l_linenumber", to_double(F.col("p")).alias("price"), to_bigint(F.col("k")).alias("part_code"),
        F.col("l_linenumber").cast("string").alias("line_text"),
    )


@query("""
    select o_orderkey, o_totalprice * case when o_orderstatus = 'O' then 1000 else 1 end as filed_price,
           o_totalprice * case when o_orderstatus = 'O' and o_orderpriority <> '5-LOW' then 1000 else 1 end as unit_price
    from orders
""", name="scale_units")
def scale_units_query(spark: SparkSession, sf: str) -> DataFrame:
    unit = F.when(F.col("o_orderstatus") == "O", "MIL").when(F.col("o_orderstatus") == "F", "UNIDADE")
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", scale_units(price, unit).alias("filed_price"),
        scale_units(price, unit, same_text(F.col("o_orderpriority"), "5-low")).alias("unit_price"),
    )


@query("""
    select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as o_orderdate from orders
""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    filed = F.expr(
        "case when o_orderstatus <> 'P' then cast(cast(o_orderdate as date) as string) "
        "when o_orderpriority = '5-LOW' then '2024-13-01' else '31/12/2020' end"
    )
    return table(spark, sf, "orders").select("o_orderkey", parse_date(filed).alias("o_orderdate"))


@query("select page_id, cast(len(string_split(url, '/')) as bigint) as nivel from pages", name="account_level")
def account_level_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", account_level(F.col("url"), "/").cast("bigint").alias("nivel"))


@query("""
    select distinct l_suppkey, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate from lineitem
""")
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "l_returnflag", "l_linestatus", "cast(l_shipdate as date) as l_shipdate"
    )
    return rows.dropDuplicates()
