"""Queries over the driver tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def r6(column: str | Column, alias: str | None = None) -> Column:
    name = alias or (column if isinstance(column, str) else None)
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, 6).alias(name)


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# --- SQL building blocks that state the bindings ----------------------------------------

PLEX = "CASE l_linestatus WHEN 'F' THEN 'plex1' ELSE 'plex2' END"
SAMPLE = f"({PLEX} || '_tmt_' || lower(l_returnflag) || l_linenumber)"
QUANTITIES = f"""quantities AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS protein_group, {SAMPLE} AS sample_name, sum(l_extendedprice) AS value
  FROM lineitem GROUP BY 1, 2)"""
DENSE = f"""{QUANTITIES},
dense AS (SELECT protein_group, sample_name, log2(nullif(value, 0)) AS intens FROM quantities)"""
SPARSE = f"""discounts AS (
  SELECT CAST(l_partkey AS VARCHAR) AS protein_group, {SAMPLE} AS sample_name, sum(l_discount) AS value
  FROM lineitem GROUP BY 1, 2),
sparse AS (SELECT protein_group, sample_name, CASE WHEN value > 0 THEN log2(value) END AS intens FROM discounts)"""
SAMPLES = f"""sample_list AS (
  SELECT DISTINCT {SAMPLE} AS sample_name, {PLEX} AS plex, lower(l_returnflag) || l_linenumber AS channel,
    l_returnflag AS flag, l_linenumber AS ln,
    CASE WHEN l_linenumber = 7
      THEN 'POOL' || (1 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END + CASE l_linestatus WHEN 'O' THEN 3 ELSE 0 END)
      ELSE CAST(l_linenumber + 6 * CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END
        + CASE l_linestatus WHEN 'O' THEN 18 ELSE 0 END AS VARCHAR) END AS number
  FROM lineitem),
meta AS (
  SELECT CASE WHEN ln = 7 THEN number ELSE 'sample_' || number END AS sample_number, sample_name, plex, channel,
    CASE WHEN ln = 7 THEN 'POOL' ELSE 'Group' || flag END AS group_number,
    CASE WHEN ln = 7 THEN 'POOL' ELSE 'Group ' || flag END AS exp_group
  FROM sample_list)"""
ANNOTATED = f"""{DENSE},
{SAMPLES},
annotated AS (SELECT d.*, m.* EXCLUDE (sample_name) FROM dense d JOIN meta m USING (sample_name)),
model_rows AS (SELECT *, replace(exp_group, ' ', '_') AS grp FROM annotated WHERE group_number <> 'POOL')"""
MEDIANS = """medians AS (SELECT sample_name, median(intens) AS MED FROM dense GROUP BY 1)"""
NORMALISED = f"""{ANNOTATED},
{MEDIANS},
normalised AS (
  SELECT a.*, MED, intens - MED + (SELECT median(intens) FROM dense) AS normalized_intensity
  FROM annotated a JOIN medians USING (sample_name))"""
