"""The operators' inputs as views over the given tables, in SQL both engines run.

`seq` is the ingest position, `pos` the position in a map.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-ins for index names and their export codes.
INDICES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CODES = {"1-URGENT": "URG", "2-HIGH": "HIGH", "3-MEDIUM": "MED", "4-NOT SPECIFIED": "NSP", "5-LOW": "LOW"}

# The ingest position as digits: order, line and part number in fixed places.
POSITION = """concat(lpad(cast(l_orderkey as string), 15, '0'), lpad(cast(l_linenumber as string), 3, '0'),
              lpad(cast(l_partkey as string), 13, '0'))"""
# The same as a number, which compares and hashes faster.
POSITION_NUMBER = """cast(cast(l_orderkey as decimal(15,0)) * 10000000000000000bd
              + cast(l_linenumber as decimal(3,0)) * 10000000000000bd + cast(l_partkey as decimal(13,0)) as decimal(31,0))"""

VIEWS = {
    # Supplier as symbol, ship date as bar date; has natural duplicate keys.
    "bars_raw": f"""
select concat('S', cast(l_suppkey as string)) as symbol, cast(l_shipdate as date) as dt,
       l_extendedprice as open, l_extendedprice + l_quantity as high,
       l_extendedprice - l_quantity as low, l_extendedprice + l_tax as close,
       cast(l_quantity as bigint) as volume,
       {POSITION} as seq
from {{lineitem}}""",
    # Few bars per symbol and year: one neighbour or none.
    "bars_sparse": """
select concat('C', cast(o_custkey as string)) as symbol,
       cast(date_trunc('quarter', o_orderdate) as date) as dt,
       o_totalprice as open, o_totalprice + 10 as high, o_totalprice - 10 as low, o_totalprice + 1 as close,
       o_orderkey % 1000 as volume, o_orderkey as seq
from {orders}""",
    # Chain-free; the target symbol exists too, so renamed rows collide.
    "renames": """
select concat('S', cast(s_suppkey as string)) as old, concat('S', cast(s_suppkey - 1 as string)) as new
from {supplier} where s_suppkey % 10 = 7""",
    # Chains, listed forwards for some stretches and backwards for others.
    "rename_chain": """
select concat('S', cast(s_suppkey as string)) as old, concat('S', cast(s_suppkey - 1 as string)) as new,
       case when s_suppkey % 40 < 20 then 1000000000 - s_suppkey else 1000000000 + s_suppkey end as pos
from {supplier}""",
    # One action per supplier and month of its orders; factors that alternate keep products exact.
    "multipliers_raw": """
select concat('S', cast(l_suppkey as string)) as symbol, cast(date_trunc('month', o_orderdate) as date) as dt,
       max(case when month(o_orderdate) % 2 = 0 then 2.0e0 else 0.5e0 end) as multiplier,
       min(o_orderkey) as seq
from {lineitem} join {orders} on l_orderkey = o_orderkey group by 1, 2""",
    # Normalised changes at month starts, mostly not bar dates of the symbol.
    "index_changes": """
select o_orderpriority as index_name, concat('S', cast(l_suppkey as string)) as symbol,
       cast(date_trunc('month', o_orderdate) as date) as dt,
       case when o_orderstatus = 'F' then 'I' else 'E' end as change_type,
       min(o_orderkey) as seq
from {lineitem} join {orders} on l_orderkey = o_orderkey group by 1, 2, 3, 4""",
    # Every third supplier per index name, as an equi-join on the remainder.
    "index_current": """
select p as index_name, concat('S', cast(s_suppkey as string)) as symbol
from {supplier} join (select distinct o_orderpriority as p from {orders}) z
  on s_suppkey % 3 = (3 - length(p) % 3) % 3""",
    # Raw feed: scrip names, text change types, dd-mm-yyyy text dates.
    "index_feed": """
select o_orderpriority as index_name,
       concat('01-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', cast(year(o_orderdate) as string)) as date_text,
       concat('Company ', cast(l_suppkey as string)) as scrip,
       case when o_orderstatus = 'F' then 'Inclusion into Index' else 'Exclusion from Index' end as change_text,
       min(o_orderkey) as seq
from {lineitem} join {orders} on l_orderkey = o_orderkey group by 1, 2, 3, 4""",
    # Every seventh scrip is left unmapped.
    "scrip_map": """
select concat('Company ', cast(s_suppkey as string)) as scrip, concat('S', cast(s_suppkey as string)) as symbol
from {supplier} where s_suppkey % 7 <> 0""",
    # Corrections for the even ones among the unmapped scrips.
    "manual_fix": """
select distinct concat('Company ', cast(l_suppkey as string)) as symbol,
       cast(date_trunc('month', o_orderdate) as date) as dt,
       concat('S', cast(l_suppkey as string)) as correct_symbol, 1 as pos
from {lineitem} join {orders} on l_orderkey = o_orderkey where l_suppkey % 14 = 0""",
    # Symbols asked for by name, as a list too long for a literal would be.
    "wanted_symbols": """
select concat('S', cast(s_suppkey as string)) as symbol from {supplier} where s_acctbal > 0""",
}

TABLES = ["lineitem", "orders", "supplier"]

def spark_view(spark: SparkSession, sf_dir, name) -> DataFrame:
    text = VIEWS[name].replace(POSITION, POSITION_NUMBER)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)


def spelled_out(df: DataFrame) -> DataFrame:
    """`df` with an ingest position that is a number spelled as its digits, as the SQL has it."""
    if not dict(df.dtypes).get("seq", "").startswith("decimal"):
        return df
    return df.withColumn("seq", F.lpad(F.col("seq").cast("string"), 31, "0"))


def duckdb_view(name) -> str:
    return VIEWS[name].format(**{t: t for t in TABLES})
