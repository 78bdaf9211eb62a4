"""The flat match table over the TPC-H-like ``orders`` table.

The same text runs on Spark and on a plain SQL engine, so results can be compared. Spark
reads only the columns a query needs. Every customer is a team; forty of them in a row form a
pool that plays within itself, so that the number of pools grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCOPE = {"Division A": "Homeland", "Division B": "Homeland", "Division C": "Homeland"}
CUTOFF = "1999-12-19"
ORIGINS = ["1997-07-01", "1998-07-01", "1999-07-01"]
AS_OF = "2001-08-01"

COMMON = """
o AS (
  SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_custkey AS BIGINT) AS c,
         CAST(floor(o_totalprice) AS BIGINT) AS p, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr
  FROM orders),
g AS (
  SELECT *, c AS h, c - c % 40 + (c % 40 + 1 + k % 39) % 40 AS a,
         20 + p % 51 AS s1, 10 + c % 20 AS sx, (p * 7 + c * 13 + k * 29) % 100 AS u
  FROM o),
s AS (
  SELECT *,
    CASE WHEN k % 11 = 0 THEN NULL WHEN u < s1 - 5 THEN '1' WHEN u < s1 + sx THEN 'X' ELSE '2' END AS r
  FROM g),
matches AS (
  SELECT CAST(floor(k / 13) AS INT) AS round_number, CAST(k % 13 + 1 AS INT) AS event_number, k AS match_id,
    d AS match_date, concat(CAST(d AS VARCHAR(10)), 'T15:00:00') AS match_start,
    concat('Team ', CAST(h AS VARCHAR(10))) AS home_team, concat('Team ', CAST(a AS VARCHAR(10))) AS away_team,
    CASE pr WHEN '1-URGENT' THEN 'Division A' WHEN '2-HIGH' THEN 'Division B' WHEN '3-MEDIUM' THEN 'Division C'
            WHEN '4-NOT SPECIFIED' THEN 'Cup' ELSE 'Foreign' END AS league,
    CAST(s1 AS DOUBLE) / 100 AS crowd_1, CAST(sx AS DOUBLE) / 100 AS crowd_x,
    CAST(100 - s1 - sx AS DOUBLE) / 100 AS crowd_2,
    CAST(CASE r WHEN '1' THEN 1 + p % 3 WHEN 'X' THEN p % 3 WHEN '2' THEN 0 END AS INT) AS home_goals,
    CAST(CASE r WHEN '1' THEN 0 WHEN 'X' THEN p % 3 WHEN '2' THEN 1 + p % 3 END AS INT) AS away_goals,
    r AS result,
    CAST(100 + p % 400 AS DOUBLE) / 100 AS odds_1, CAST(250 + k % 300 AS DOUBLE) / 100 AS odds_x,
    CAST(150 + c % 500 AS DOUBLE) / 100 AS odds_2,
    CAST(105 + p % 400 AS DOUBLE) / 100 AS start_odds_1, CAST(240 + k % 300 AS DOUBLE) / 100 AS start_odds_x,
    CAST(155 + c % 500 AS DOUBLE) / 100 AS start_odds_2,
    CAST(CASE WHEN d < DATE '1998-01-01' THEN 1000000 + h ELSE h END AS INT) AS home_team_id,
    CAST(CASE WHEN d < DATE '1998-01-01' THEN 1000000 + a ELSE a END AS INT) AS away_team_id,
    concat('Country ', CAST(h % 7 AS VARCHAR(10))) AS home_team_country,
    concat('Country ', CAST(a % 7 AS VARCHAR(10))) AS away_team_country,
    CAST(CASE pr WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS INT) AS league_id,
    CASE WHEN pr IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Homeland' ELSE 'Abroad' END AS league_country,
    CASE WHEN k % 11 = 0 THEN 'NotStarted' ELSE 'Ended' END AS status,
    CAST(s1 * 100 + k % 50 AS DOUBLE) / 100 / 100 AS favourite_odds_1,
    CAST(sx * 100 AS DOUBLE) / 100 / 100 AS favourite_odds_x,
    CAST(10000 - s1 * 100 - sx * 100 - k % 50 AS DOUBLE) / 100 / 100 AS favourite_odds_2,
    CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(70000000 + k AS VARCHAR(20)) END AS betradar_id
  FROM s)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with every column of the flat match table."""
    text = "WITH" + COMMON.replace("FROM orders", "FROM {orders}") + "SELECT * FROM matches"
    return spark.sql(text, orders=table(spark, sf_dir, "orders"))


#: Clubs of the linked matches, each of which meets every other.
CLUBS = 100
LINKED = f"""
linked AS (
  SELECT match_id, match_date, match_start, result,
    CAST(home % {CLUBS} AS INT) AS h, CAST((home % {CLUBS} + 1 + match_id % {CLUBS - 1}) % {CLUBS} AS INT) AS a
  FROM (SELECT *, CAST(substr(home_team, 6) AS BIGINT) AS home FROM matches))
"""


def linked_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matches between clubs that are all linked to one another."""
    body = "SELECT match_id, match_start, result, concat('Club ', h) AS home_team, concat('Club ', a) AS away_team FROM linked"
    return spark.sql("WITH" + COMMON.replace("FROM orders", "FROM {orders}") + f", {LINKED} {body}", orders=table(spark, sf_dir, "orders"))


def on_matches(body: str, recursive: bool = False) -> str:
    """A stand-alone statement whose body may read ``matches``; a body that begins with
    more common table expressions starts with a comma."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{COMMON.strip()}\n{body.strip()}"
