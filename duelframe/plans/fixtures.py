"""Tables in the shapes of uploads and events, derived from the sample orders.

Each is one SQL text that Spark and an ANSI engine both accept, and holds every kind
of title, duration, date and description that the operators tell apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duelframe.sources.files import spread

UPLOADS = """
select id, title, description, upload_date, view_count, duration, 'https://x.test/watch?v=' || id as url, like_count as likeCount, cast(null as string) as commentCount
from (
  select 'v' || cast(o as string) as id,
    case o % 16 when 1 then '"Bar League - ' when 2 then '  Bar League - ' when 7 then '5 on 5: ' when 9 then 'bar league - ' when 11 then ''
      when 12 then 'Bar League Fest - ' when 13 then cast(null as string) when 14 then 'A and '
      when 15 then case o % 48 when 15 then 'Vlog ' when 31 then 'Bar League ' else 'Day 2 - ' end else 'Bar League - ' end
    || a ||
    case o % 16 when 4 then ' vs. ' when 6 then '/B vs ' when 10 then ' Vs ' when 11 then '  VS  '
      when 15 then case o % 48 when 15 then ' ' when 31 then ' vs M-Zhayt' else ' vs ' end else ' vs ' end
    || b ||
    case o % 16 when 1 then '"' when 2 then '  ' when 3 then ' pt. ' || cast(part as string) when 5 then ' vs C' when 8 then ' INTERVIEW' when 9 then ' - Finals'
      when 10 then ' @ Channel 2' when 11 then ' ' || cast(o % 9 as string) when 12 then ' (rematch)'
      when 14 then case when o % 32 = 14 then ' and D' else '' end else '' end as title,
    case o % 6
      when 0 then 'Bar League presents: Ahon ' || cast(o % 17 as string) || ' @ B-Side, Makati City. Dec. 20-21, 2024'
      when 1 then 'bar league  presents Gubat ' || cast(o % 5 as string) || ', Day 1 @ Cebu City. Sept. 5, 20' || cast(10 + o % 15 as string)
      when 2 then 'Some event. Quezon City.'
      when 3 then cast(null as string)
      when 4 then 'Feb. 31, 2010'
      else 'No date here @ Davao City'
    end as description,
    case when o % 29 = 0 then 'not a date' else replace(cast(o_orderdate + interval '25' year as string), ' ', 'T') || 'Z' end as upload_date,
    case o % 5 when 0 then cast(null as string) when 1 then 'n/a' else cast(o * 7 as string) end as view_count,
    case o % 3 when 0 then '12.5' else cast(o % 100 as string) end as like_count,
    case o % 8
      when 0 then cast(null as string) when 1 then 'bad' when 2 then 'P1DT2H3M4S' when 3 then 'PT' || cast(o % 59 as string) || 'M' || cast(o % 60 as string) || 'S'
      when 4 then 'PT1,5S' when 5 then 'P1M' when 6 then 'P0D' else 'PT' || cast(o % 30 as string) || 'H' end as duration
  from (
    select o_orderkey as o, o_orderdate, part,
      case n % 10 when 0 then 'Flip' when 1 then 'M-Zhayt' when 2 then 'JayTee' else 'Mc ' || cast(n % 53 as string) || 'a' end as a,
      case n % 7 when 0 then 'Poison 13' when 1 then 'Spade' else 'Rhymer ' || cast(n % 41 as string) || 'x' end as b
    from (
      select o_orderkey, o_orderdate, 1 + cast(floor((o_orderkey % 64) / 16.0) as bigint) as part,
        case when o_orderkey % 16 = 3 then cast(floor(o_orderkey / 64.0) as bigint) else o_custkey end as n
      from orders) x) y) z
"""

_DESCRIPTION = """case o_orderkey % 8
      when 0 then 'Bar League presents: Ahon 12 @ B-Side, Makati City. Dec. 20-21, 2024'
      when 1 then 'Bar League presents: Gubat 12, Day 1 @ Cebu City. Sept. 5, 2015'
      when 2 then 'Sep. 5, 2015' when 3 then 'Some event. Quezon City' when 4 then 'Some event. Quezon City.'
      when 5 then 'Feb. 31, 2010' when 6 then 'At: Davao City. Oct 29 , 2010' else cast(null as string) end"""

EVENTS = f"""
select 'A vs B' as matchup, case when o_orderkey % 11 = 0 then cast(null as string) else 'Event ' || cast(o_orderkey % 40 as string) end as event_name,
  {_DESCRIPTION} as event_description, 'v' || cast(o_orderkey as string) as video_id, o_orderkey as _ord
from orders where o_orderkey % 3 <> 0
union all
select 'A vs B', 'Later row', 'Bar League presents: Zoning @ Davao City. May 1, 2019', 'v' || cast(o_orderkey as string), 100000000 + o_orderkey
from orders where o_orderkey % 5 = 0
union all
select 'A vs B', 'No id', 'Jan 1, 2020', cast(null as string), 1
from orders where o_orderkey % 1000 = 0
"""


#: All orders as events, without a gap; for queries of events alone.
ALL_EVENTS = EVENTS.replace(" where o_orderkey % 3 <> 0", "")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the tables are made of, over all cores."""
    return spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate"))


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(UPLOADS.replace("from orders", "from {orders}"), orders=orders(spark, sf_dir))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ALL_EVENTS.replace("from orders", "from {orders}"), orders=orders(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS.replace("from orders", "from {orders}"), orders=orders(spark, sf_dir))
