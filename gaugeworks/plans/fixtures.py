"""The given tables, and views that shape them like findings, runs and tickets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Each text runs unchanged on Spark and on the checking database.
VIEWS: dict[str, str] = {
    "fx_run": """
        SELECT concat('ds_', lower(c.c_mktsegment), '_', CAST(c.c_custkey AS STRING)) AS dataset,
               o.o_orderkey AS run_id, o.o_orderdate AS run_date,
               CAST(floor(o.o_totalprice) AS BIGINT) AS row_cnt, o.o_orderstatus AS status
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "fx_bu": """
        SELECT concat('ds_', lower(c.c_mktsegment), '_', CAST(c.c_custkey AS STRING)) AS dataset,
               concat(n.n_name, ' - ', CASE WHEN c.c_custkey % 5 = 0 THEN 'cde' ELSE c.c_mktsegment END) AS business_unit,
               lower(r.r_name) AS region, c.c_custkey AS ord
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fx_rule": """
        SELECT r.dataset, r.run_id, r.run_date,
               concat('if_col_', CAST(l.l_linenumber AS STRING), '_is_bad') AS rule_nm,
               CASE WHEN l.l_returnflag = 'R' THEN 'BREAKING' ELSE 'PASSING' END AS break_msg,
               l.l_quantity AS score, l.l_discount * 100 AS perc, l.l_partkey AS seq, l.l_suppkey AS seq2,
               CASE l.l_linenumber % 6 WHEN 0 THEN 'Completeness' WHEN 1 THEN 'Validity' WHEN 2 THEN 'Consistency'
                    WHEN 3 THEN 'Accuracy' WHEN 4 THEN 'Uniqueness' ELSE 'Timeliness' END AS dim_name
        FROM lineitem l JOIN fx_run r ON l.l_orderkey = r.run_id""",
    "fx_adaptive": """
        SELECT r.dataset, r.run_id, r.run_date,
               CASE WHEN l.l_linenumber = 1 THEN 'Row Count' ELSE concat('col_', CAST(l.l_linenumber AS STRING)) END AS name,
               CASE l.l_linenumber WHEN 1 THEN 'ROW_COUNT' WHEN 2 THEN 'NULL' WHEN 3 THEN 'MIN VALUE'
                    WHEN 4 THEN 'CARDINALITY' ELSE 'MEAN VALUE' END AS type,
               CASE WHEN l.l_returnflag = 'N' THEN 'Breaking' ELSE 'Passing' END AS status,
               l.l_extendedprice AS value, l.l_extendedprice * (1.0 + l.l_discount - l.l_tax) AS mean,
               l.l_quantity / 5.0 AS score, (l.l_tax - l.l_discount) * 100.0 AS per_change,
               l.l_partkey AS seq, l.l_suppkey AS seq2
        FROM lineitem l JOIN fx_run r ON l.l_orderkey = r.run_id""",
    "fx_issue": """
        SELECT concat('T-', CAST(o.run_id AS STRING)) AS issue_key, o.dataset AS parent_summary,
               CASE o.status WHEN 'O' THEN 'Open' WHEN 'P' THEN 'In Progress' ELSE 'Closed' END AS status,
               o.run_date AS date_updated, o.run_id AS ord,
               concat('col_', CAST(o.run_id % 7 + 1 AS STRING), ': Invalid') AS title
        FROM fx_run o""",
    "fx_link": """
        SELECT concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS src,
               concat(CAST(conv_id AS STRING), '-', CAST(turn + 1 AS STRING)) AS dst
        FROM conversations""",
    "fx_target": """
        SELECT o_orderkey AS k, o_custkey AS grp, o_orderstatus AS status,
               CAST(floor(o_totalprice) AS BIGINT) AS rows_cnt, o_orderpriority AS note
        FROM orders""",
    "fx_source": """
        SELECT o_orderkey + 1000 AS k, o_custkey AS grp, o_orderstatus AS status,
               CAST(floor(o_totalprice) AS BIGINT) + 1 AS rows_cnt, o_orderpriority AS note
        FROM orders""",
}

_NAMES = re.compile(r"\b(?:fx_\w+|" + "|".join(TABLES) + r")\b")


def add_views(views: dict[str, str]) -> None:
    VIEWS.update(views)


def _in_order(sql: str, seen: list[str]) -> list[str]:
    for name in _NAMES.findall(sql):
        if name in VIEWS and name not in seen:
            _in_order(VIEWS[name], seen)
            seen.append(name)
    return seen


def with_views(sql: str) -> str:
    """The SQL with every view it uses written out as a common table expression."""
    body = sql.strip()
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _in_order(body, [])]
    if body[:5].upper() == "WITH ":
        body = body[5:].lstrip()
        return "WITH " + ",\n".join(parts + [body]) if parts else "WITH " + body
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


class Inputs:
    """Tables of one folder as DataFrames, with the views resolved lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        used = set(_NAMES.findall(with_views(text)))
        for name in TABLES:
            if name in used:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(with_views(text))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_") and name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)
