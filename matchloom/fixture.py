"""Deterministic projection of the star-schema test tables onto head-to-head matches; the statement is plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MATCH_SQL = """
WITH li AS (
  SELECT l_orderkey AS ok, l_linenumber % 2 AS side, CAST(l_quantity AS BIGINT) AS q,
         CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS x FROM lineitem),
s AS (SELECT ok,
    CAST(sum(CASE WHEN side = 1 THEN q ELSE 0 END) AS BIGINT) AS p1_svpt, CAST(sum(CASE WHEN side = 0 THEN q ELSE 0 END) AS BIGINT) AS p2_svpt,
    CAST(sum(CASE WHEN side = 1 THEN d ELSE 0 END) AS BIGINT) AS p1_bpFaced, CAST(sum(CASE WHEN side = 0 THEN d ELSE 0 END) AS BIGINT) AS p2_bpFaced,
    CAST(sum(CASE WHEN side = 1 THEN x ELSE 0 END) AS BIGINT) AS p1_df, CAST(sum(CASE WHEN side = 0 THEN x ELSE 0 END) AS BIGINT) AS p2_df,
    CAST(sum(CASE WHEN side = 1 THEN q % 5 ELSE 0 END) AS BIGINT) AS p1_ace, CAST(sum(CASE WHEN side = 0 THEN q % 5 ELSE 0 END) AS BIGINT) AS p2_ace,
    CAST(sum(CASE WHEN side = 1 THEN q - q % 3 ELSE 0 END) AS BIGINT) AS p1_1stIn, CAST(sum(CASE WHEN side = 0 THEN q - q % 3 ELSE 0 END) AS BIGINT) AS p2_1stIn,
    CAST(sum(CASE WHEN side = 1 THEN d - d % 2 ELSE 0 END) AS BIGINT) AS p1_bpSaved, CAST(sum(CASE WHEN side = 0 THEN d - d % 2 ELSE 0 END) AS BIGINT) AS p2_bpSaved,
    CAST(sum(CASE WHEN side = 1 THEN (q - q % 3) - (q - q % 3) % 4 ELSE 0 END) AS BIGINT) AS p1_1stWon, CAST(sum(CASE WHEN side = 0 THEN (q - q % 3) - (q - q % 3) % 4 ELSE 0 END) AS BIGINT) AS p2_1stWon,
    CAST(sum(CASE WHEN side = 1 THEN q % 3 - q % 3 % 2 ELSE 0 END) AS BIGINT) AS p1_2ndWon, CAST(sum(CASE WHEN side = 0 THEN q % 3 - q % 3 % 2 ELSE 0 END) AS BIGINT) AS p2_2ndWon,
    CAST(sum(CASE WHEN side = 1 THEN x % 3 ELSE 0 END) AS BIGINT) AS p1_SvGms, CAST(sum(CASE WHEN side = 0 THEN x % 3 ELSE 0 END) AS BIGINT) AS p2_SvGms
  FROM li GROUP BY ok)
SELECT CAST(o_orderkey AS BIGINT) AS seq, CAST(date_trunc('month', o_orderdate) AS DATE) AS tourney_date,
  CAST(2000 + o_orderkey % 7 AS INT) AS tourney_id,
  CASE o_orderkey % 7 WHEN 0 THEN 'G' WHEN 1 THEN 'M' WHEN 2 THEN 'F' WHEN 3 THEN 'O' ELSE 'A' END AS tourney_level,
  CASE (o_custkey + o_orderkey) % 4 WHEN 0 THEN 'Hard' WHEN 1 THEN 'Clay' WHEN 2 THEN 'Grass' ELSE 'Carpet' END AS surface,
  CASE o_orderkey % 8 WHEN 0 THEN 'ER' WHEN 1 THEN 'R128' WHEN 2 THEN 'R64' WHEN 3 THEN 'R32' WHEN 4 THEN 'R16' WHEN 5 THEN 'QF' WHEN 6 THEN 'SF' ELSE 'F' END AS round,
  CAST(CASE o_orderkey % 8 WHEN 0 THEN 256 WHEN 1 THEN 128 WHEN 2 THEN 64 WHEN 3 THEN 32 WHEN 4 THEN 16 WHEN 5 THEN 8 WHEN 6 THEN 4 ELSE 2 END AS INT) AS round_order,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 3 END AS INT) AS best_of,
  CAST(o_custkey % 64 AS INT) AS player1_id, CAST((o_custkey % 64 + 1 + (o_orderkey * 31) % 63) % 64 AS INT) AS player2_id,
  CAST(CASE WHEN (o_orderkey * 7919 + o_custkey) % 10 < 5 THEN 1 ELSE 0 END AS INT) AS RESULT,
  p1_svpt, p2_svpt, p1_1stIn, p2_1stIn, p1_ace, p2_ace, p1_df, p2_df, p1_bpFaced, p2_bpFaced, p1_bpSaved, p2_bpSaved, p1_1stWon, p2_1stWon, p1_2ndWon, p2_2ndWon, p1_SvGms, p2_SvGms,
  CAST(o_orderkey % 8 AS INT) AS p1_set1, CAST((o_orderkey * 3 + o_custkey) % 8 AS INT) AS p2_set1, CAST((o_orderkey + o_custkey) % 7 AS INT) AS p1_set2, CAST(o_custkey % 8 AS INT) AS p2_set2,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 ELSE 0 END AS INT) AS p1_set3, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 6 ELSE 0 END AS INT) AS p2_set3,
  CAST(CASE o_orderkey % 3 WHEN 0 THEN 32 WHEN 1 THEN 64 ELSE 128 END AS INT) AS draw_size,
  CAST(CASE WHEN o_custkey % 11 > 0 THEN o_custkey * 13 % 200 + 1 END AS DOUBLE) AS player1_rank, CAST(o_orderkey * 17 % 200 + 1 AS DOUBLE) AS player2_rank,
  CAST(o_custkey * 37 % 5000 AS DOUBLE) AS player1_atp_points, CAST(CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey * 29 % 5000 END AS DOUBLE) AS player2_atp_points,
  CAST(18 + o_custkey % 20 AS DOUBLE) AS player1_age, CAST(CASE WHEN o_orderkey % 9 > 0 THEN 18 + o_orderkey % 21 END AS DOUBLE) AS player2_age,
  CAST(CASE WHEN o_custkey % 7 > 0 THEN 165 + o_custkey % 40 END AS INT) AS player1_ht, CAST(165 + o_orderkey % 41 AS INT) AS player2_ht
FROM orders LEFT JOIN s ON s.ok = orders.o_orderkey"""


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(MATCH_SQL)
