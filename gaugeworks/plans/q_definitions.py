"""Dataset definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import definitions as D
from ..operators.relational import spread
from .fixtures import add_views
from .registry import query

_SETTINGS = '"shape":{"columnSettings":[{"name":"c_a","type":"String","enabled":true},{"name":"c_b","type":"Int","enabled":false},{"name":"c_c","type":"Int","enabled":"yes"}]}'
_QUERY = "SELECT c_a, coalesce(c_b, 0) AS b2, c_c FROM db_x.tb WHERE to_date(load_dt, 1) >= current_date"

add_views({
    "fx_def": f"""
        SELECT p_partkey, concat('ds_part_', CAST(p_partkey AS STRING)) AS dataset, p_size AS run_id, p_size % 4 AS v, p_size > 25 AS big,
               concat('{{"linkId":"', p_brand, '","profile":{{"behaviorRowCheck":', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END,
                 ',"behaviorNullCheck":"yes"}},"rule":{{"on":"Y"}},"jobSchedule":{{"enabled":true,"scheduleTime":"08:00:00"}},',
                 CASE p_size % 4
                   WHEN 0 THEN '"load":{{"query":"{_QUERY}"}},"outliers":{{"on":true,"include":["c_a"]}},"dupe":{{"on":true,"exclude":["c_b"]}},{_SETTINGS},'
                   WHEN 1 THEN '"outliers":{{"on":false,"include":["c_a"]}},"dupe":{{"on":false,"settings":[{{"columns":["c_b"]}},{{"column":"c_c"}}]}},{_SETTINGS},'
                   WHEN 2 THEN '"outliers":{{"on":true}},"dupe":{{"on":false}},'
                   ELSE '"load":{{"sql":"SELECT * FROM db_x.tb"}},"outliers":{{"on":true}},"dupe":[{{"include":["c_a"]}}],{_SETTINGS},' END,
                 '"patterns":[{{"key":"P1","include":["c_a","c_b"]}},{{"pattern":"P2","columns":["c_a"]}},{{"include":["c_c"]}}]}}') AS text
        FROM part""",
    "fx_query": """
        SELECT p_partkey, p_size % 5 AS v,
               CASE p_size % 5
                 WHEN 0 THEN concat('select p_name, Upper(concat(a, '','', b)) as tag, t.size FROM db_', lower(p_brand), '.tb_', CAST(p_partkey AS STRING), ' t WHERE size > 3 AND load_dt >= current_date')
                 WHEN 1 THEN concat('SELECT  sum(x) total, y FROM "S".db_y."', p_type, '" where date(run_time) = current_date')
                 WHEN 2 THEN concat('SELECT * FROM tb_', CAST(p_partkey AS STRING))
                 WHEN 3 THEN concat('SELECT a FROM z.tb WHERE a = 1 AND b < 2 and d_', CAST(p_size AS STRING), ' in (current_date)')
                 ELSE 'not a query' END AS sql_text
        FROM part""",
})


def _defs(t):
    return spread(t.fx_def, "p_partkey").withColumn("definition", F.from_json("text", D.DEFINITION))


_FLAGS = """dataset, run_id AS "Run Id", p_brand AS "Link Id", {date} AS "Date Filter", {key} AS "Date Filter Key", TRUE AS "Scheduler",
    CAST(NULL AS VARCHAR) AS "Scheduled Freq", '08:00:00' AS "Scheduled Time", {col} AS col_name, {type} AS "Data Type", big AS "Row Count", FALSE AS "Execution Time",
    FALSE AS "Data Type Check", FALSE AS "Schema Change", {dupes} AS "Dupes", TRUE AS "Custom Rules", TRUE AS "Null Values", FALSE AS "Empty Fields",
    FALSE AS "Uniqueness", FALSE AS "Min", FALSE AS "Max", FALSE AS "Mean", {outliers} AS "Outliers", {shapes} AS "Shapes", {patterns} AS "Patterns",
    CAST(NULL AS DOUBLE) AS "Current Null Pct\""""
_NULL = "CAST(NULL AS VARCHAR)"


def _variant(v, col, kind, dupes, outliers, shapes, patterns, date="FALSE", key=_NULL):
    def text(x):
        return _NULL if x is None else f"'{x}'"

    body = _FLAGS.format(date=date, key=key, col=text(col), type=text(kind), dupes=dupes, outliers=outliers, shapes=shapes, patterns=text(patterns))
    return f"SELECT {body} FROM fx_def JOIN part USING (p_partkey) WHERE v = {v}"


_BY_QUERY = {"date": "TRUE", "key": "'load_dt'"}
DEFINITION_SQL = "\nUNION ALL ".join([
    _variant(0, "c_a", "String", "TRUE", "TRUE", "TRUE", "P1;P2", **_BY_QUERY),
    _variant(0, "coalesce(c_b, 0)", None, "FALSE", "FALSE", "FALSE", None, **_BY_QUERY),
    _variant(0, "c_c", "Int", "TRUE", "FALSE", "TRUE", None, **_BY_QUERY),
    _variant(1, "c_a", "String", "FALSE", "TRUE", "TRUE", "P1;P2"),
    _variant(1, "c_b", "Int", "TRUE", "FALSE", "FALSE", "P1"),
    _variant(1, "c_c", "Int", "TRUE", "FALSE", "TRUE", None),
    _variant(2, None, None, "FALSE", "TRUE", "FALSE", None),
    _variant(3, "c_a", "String", "TRUE", "TRUE", "TRUE", "P1;P2"),
    _variant(3, "c_b", "Int", "FALSE", "TRUE", "FALSE", "P1"),
    _variant(3, "c_c", "Int", "FALSE", "TRUE", "TRUE", None),
])


@query("c18_definition_rows", DEFINITION_SQL)
def definition_rows(t):
    return D.definition_rows(_defs(t), "dataset", "run_id", "definition")


@query("c19_column_set", """
    SELECT dataset, CASE v WHEN 1 THEN 'c_b,c_c' WHEN 3 THEN 'c_a' ELSE '' END AS included, CASE v WHEN 0 THEN 'c_b' WHEN 1 THEN 'c_b,c_c' ELSE '' END AS excluded FROM fx_def""")
def column_set(t):
    df = _defs(t).withColumn("dupe", D.parse_section("definition.dupe"))
    return df.select("dataset", F.array_join(D.column_set("dupe"), ",").alias("included"), F.array_join(D.column_set("dupe", "exclude"), ",").alias("excluded"))


@query("c20_complement", "SELECT dataset, CASE v WHEN 0 THEN 'c_a,c_c' WHEN 1 THEN 'c_a' WHEN 3 THEN 'c_a,c_b,c_c' END AS columns FROM fx_def")
def complement(t):
    names = F.transform("definition.shape.columnSettings", lambda s: s["name"])
    df = _defs(t).withColumn("dupe", D.parse_section("definition.dupe"))
    return df.select("dataset", F.array_join(D.complement(names, D.column_set("dupe", "exclude")), ",").alias("columns"))


@query("c21_pattern_map", """
    SELECT dataset, 'c_a' AS col_name, 'P1;P2' AS patterns FROM fx_def UNION ALL SELECT dataset, 'c_b', 'P1' FROM fx_def""")
def pattern_map(t):
    return D.pattern_map(_defs(t).withColumn("p", D.parse_section("definition.patterns")), ["dataset"], "p")


@query("c22_column_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'A' OR l_returnflag = l_linestatus OR (l_linestatus = 'O' AND l_linenumber = 1) AS flag FROM lineitem""")
def column_flag(t):
    members = F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), F.array().cast("array<string>")).otherwise(F.array(F.lit("A"), "l_linestatus"))
    df = t.lineitem.withColumn("members", members)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", D.column_flag("l_returnflag", "members", F.lit(True)).alias("flag"))


@query("c23_query_columns", """
    SELECT p_partkey, position, col_name FROM fx_query,
      LATERAL (SELECT unnest(CASE v WHEN 0 THEN [0, 1, 2] WHEN 1 THEN [0, 1] WHEN 3 THEN [0] END) AS position,
                      unnest(CASE v WHEN 0 THEN ['p_name', 'upper(concat(a, '','', b))', 't.size'] WHEN 1 THEN ['sum(x)', 'y'] WHEN 3 THEN ['a'] END) AS col_name) x""")
def query_columns(t):
    return D.query_columns(spread(t.fx_query, "p_partkey"), ["p_partkey"], "sql_text")


@query("c24_query_date_filter", """
    SELECT p_partkey, v IN (0, 1, 3) AS date_filter, CASE v WHEN 0 THEN 'load_dt' WHEN 1 THEN 'run_time' WHEN 3 THEN 'b' END AS date_field FROM fx_query""")
def query_date_filter(t):
    return D.query_date_filter(spread(t.fx_query, "p_partkey"), "sql_text").select("p_partkey", "date_filter", "date_field")


@query("c25_query_source_table", """
    SELECT q.p_partkey, CASE v WHEN 0 THEN concat('db_', lower(p_brand)) WHEN 1 THEN 'db_y' WHEN 3 THEN 'z' END AS db_nm,
           CASE v WHEN 0 THEN concat('tb_', CAST(q.p_partkey AS VARCHAR)) WHEN 1 THEN p_type WHEN 2 THEN concat('tb_', CAST(q.p_partkey AS VARCHAR)) WHEN 3 THEN 'tb' END AS table_nm
    FROM fx_query q JOIN part USING (p_partkey)""")
def query_source_table(t):
    return D.query_source_table(spread(t.fx_query, "p_partkey"), "sql_text").select("p_partkey", "db_nm", "table_nm")
