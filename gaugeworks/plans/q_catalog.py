"""Dataset catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from .fixtures import add_views
from .registry import query

add_views({
    "fx_unit_map": "SELECT dataset, row_cnt % 26 AS unit_id, run_id AS ord FROM fx_run",
    "fx_unit_name": "SELECT CAST(n_nationkey AS BIGINT) AS unit_id, CASE WHEN n_nationkey = 3 THEN '  ' ELSE n_name END AS unit FROM nation",
    "fx_unit_text": """
        SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '  ' WHEN 2 THEN c_mktsegment
               WHEN 3 THEN concat(c_mktsegment, ' - cde ') WHEN 4 THEN concat(' ', c_mktsegment, ' - A - ', c_name)
               ELSE concat(c_mktsegment, ' - ', c_name) END AS unit
        FROM customer""",
})


@query("b01_prefix_filter", "SELECT dataset, run_id FROM fx_run WHERE dataset LIKE 'ds\\_b%' ESCAPE '\\'")
def prefix_filter(t):
    return C.filter_prefix(t.fx_run.select("dataset", "run_id"), "dataset", "ds_b")


@query("b02_resolve_names", """
    SELECT m.dataset, m.unit_id, CASE WHEN trim(n.unit) <> '' THEN trim(n.unit) END AS unit
    FROM (SELECT dataset, unit_id, row_number() OVER (PARTITION BY dataset ORDER BY ord DESC) AS rn FROM fx_unit_map) m
    LEFT JOIN fx_unit_name n ON m.unit_id = n.unit_id WHERE m.rn = 1""")
def resolve_names(t):
    return C.resolve_names(t.fx_unit_map, t.fx_unit_name, "dataset", "unit_id", "unit", [F.desc("ord")])


@query("b03_parse_unit", """
    SELECT c_custkey, unit,
           CASE WHEN strpos(trim(unit), ' - ') > 0 THEN trim(substr(trim(unit), 1, strpos(trim(unit), ' - ') - 1)) ELSE NULLIF(trim(unit), '') END AS "Market",
           CASE WHEN strpos(trim(unit), ' - ') > 0 THEN trim(substr(trim(unit), strpos(trim(unit), ' - ') + 3)) END AS "Project",
           CASE WHEN trim(unit) LIKE '% - cde' THEN 'Yes' ELSE 'No' END AS "CDE" FROM fx_unit_text""")
def parse_unit(t):
    return C.parse_unit(t.fx_unit_text, "unit")


@query("b04_union_regions", """
    SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'east' ELSE 'west' END AS region FROM customer""")
def union_regions(t):
    c = t.customer
    east, west = c.filter("c_acctbal < 0"), c.filter("c_acctbal >= 0")
    return C.union_regions({"east": east.select("c_custkey", "c_mktsegment"), "west": west.select("c_custkey", "c_mktsegment")})


@query("b05_latest_run", """
    SELECT dataset, run_id, run_date FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) s
    WHERE rn = 1""")
def latest_run(t):
    return C.latest_run(t.fx_run, "dataset", "run_id", "run_date")
