"""Findings ingestion and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce as K
from ..operators import findings as O
from ..operators.state import ensure_columns
from .fixtures import add_views
from .registry import query

_REC = """concat('{"ruleNm":"r', CAST(l_partkey AS STRING), '","score":', CAST(CAST(l_quantity AS INT) AS STRING), ',"sub":{"flag":"', l_returnflag, '"}}')"""
_DIMS = ("Completeness", "Validity", "Consistency", "Accuracy", "Uniqueness", "Timeliness")
_SCORES = ",\n".join(
    f"CAST(sum(CASE WHEN dim_name = '{d}' AND break_msg = 'BREAKING' THEN CAST(score AS DECIMAL(18,4)) END) AS DOUBLE) AS {d.lower()}Score"
    for d in _DIMS
)
SCORE_COLUMNS = [f"{d.lower()}Score" for d in _DIMS]

add_views({
    "fx_payload": f"""
        SELECT concat('ds_', CAST(l_suppkey AS STRING)) AS dataset, l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
               CASE l_linenumber
                 WHEN 1 THEN concat('[', {_REC}, ',7]')
                 WHEN 2 THEN concat('{{"rules":[', {_REC}, ']}}')
                 WHEN 3 THEN concat('{{"rules":"x","data":[', {_REC}, ',', {_REC}, ']}}')
                 WHEN 4 THEN concat('{{"data":5,"items":[', {_REC}, ']}}')
                 WHEN 5 THEN concat('{{"content":[', {_REC}, ',"text"]}}')
                 WHEN 6 THEN {_REC}
                 ELSE 'not json' END AS payload
        FROM lineitem""",
    "fx_score": f"SELECT dataset, run_id, run_date, {_SCORES} FROM fx_rule GROUP BY dataset, run_id, run_date",
    "fx_attr": """
        SELECT dataset, ord, CASE WHEN ord % 3 = 0 THEN FALSE ELSE TRUE END AS jobSchedule,
               CASE ord % 4 WHEN 0 THEN '' ELSE concat('conn_', region) END AS connectionName,
               CASE WHEN ord % 5 = 0 THEN CAST(NULL AS STRING) ELSE concat('db_', region) END AS db_nm, concat('tb_', CAST(ord AS STRING)) AS table_nm
        FROM fx_bu""",
    "fx_mapping": """
        SELECT dataset, region, business_unit, ord, CASE WHEN ord % 2 = 0 THEN 'stored' END AS db_nm, CAST(NULL AS STRING) AS connectionName FROM fx_bu""",
    "fx_template": """
        SELECT CASE WHEN p_size % 2 = 0 THEN 'east' ELSE 'west' END AS region, CASE WHEN p_size = 7 THEN ' ' ELSE concat(p_brand, '-', CAST(p_size AS STRING)) END AS name,
               CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('$colNm is not ', p_type) END AS value,
               CASE WHEN p_size % 7 = 0 THEN '' ELSE concat('about ', p_name) END AS description, p_partkey AS ord
        FROM part""",
    "fx_template_last": """
        SELECT region, name, value, description, ord FROM
          (SELECT *, row_number() OVER (PARTITION BY region, name ORDER BY ord DESC) AS rn FROM fx_template WHERE trim(name) <> '') s WHERE rn = 1""",
    "fx_custom": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CASE WHEN l.l_suppkey % 2 = 0 THEN 'east' ELSE 'west' END AS region,
               CASE l.l_returnflag WHEN 'A' THEN 'CUSTOM' WHEN 'N' THEN 'custom' ELSE 'SQLG' END AS ruleType,
               concat(p.p_brand, '-', CAST(p.p_size AS STRING)) AS ruleRepo,
               CASE WHEN l.l_linenumber = 2 THEN '' WHEN l.l_linenumber = 3 THEN CAST(NULL AS STRING) ELSE concat('col_', CAST(l.l_linenumber AS STRING)) END AS columnName,
               CASE WHEN l.l_linestatus = 'O' THEN 'kept' WHEN l.l_linenumber > 4 THEN '' END AS ruleValue,
               CASE WHEN l.l_linenumber = 5 THEN 'described' ELSE '' END AS businessDesc
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx_rules_only": "SELECT DISTINCT dataset, rule_nm, 'stale' AS perc FROM fx_rule",
})

UNWRAPPED = """
    SELECT dataset, l_orderkey, l_linenumber, l_partkey, concat('r', CAST(l_partkey AS STRING)) AS "ruleNm", CAST(floor(l_quantity) AS DOUBLE) AS score
    FROM lineitem, LATERAL (SELECT concat('ds_', CAST(l_suppkey AS STRING)) AS dataset) d WHERE l_linenumber <= 5
    UNION ALL
    SELECT concat('ds_', CAST(l_suppkey AS STRING)), l_orderkey, l_linenumber, l_partkey, concat('r', CAST(l_partkey AS STRING)), CAST(floor(l_quantity) AS DOUBLE)
    FROM lineitem WHERE l_linenumber = 3"""


@query("c01_unwrap_envelope", UNWRAPPED)
def unwrap_envelope(t):
    rows = O.unwrap_envelope(t.fx_payload, "payload", "rules")
    return rows.select(
        "dataset", "l_orderkey", "l_linenumber", "l_partkey",
        F.try_variant_get("record", "$.ruleNm", "string").alias("ruleNm"),
        F.try_variant_get("record", "$.score", "double").alias("score"),
    )


@query("c02_first_record", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber IN (1, 3, 4, 5, 6) THEN concat('r', CAST(l_partkey AS STRING)) END AS "ruleNm" FROM lineitem""")
def first_record(t):
    return O.first_record(t.fx_payload, "payload", {"ruleNm": "string"}).select("l_orderkey", "l_linenumber", "l_partkey", "ruleNm")


@query("c03_path_get", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 6 THEN l_returnflag ELSE '?' END AS flag, CAST(-1 AS BIGINT) AS absent FROM lineitem""")
def path_get(t):
    flag = O.path_get("payload", "sub.flag", "string", "?").alias("flag")
    return t.fx_payload.select("l_orderkey", "l_linenumber", "l_partkey", flag, O.path_get("payload", "sub.none.deep", "bigint", -1).alias("absent"))


def _nested(t):
    rule = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("score"))
    other = F.struct(F.col("l_linestatus").alias("flag"), F.lit(0.0).alias("score"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array(rule, other).alias("rules"),
        F.create_map(F.lit("a__NULL"), rule, F.lit("b__MIN"), other).alias("dqItems"),
    )


EXPLODED = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag, l_quantity AS score {a} FROM lineitem WHERE {skip}
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, 0.0 {b} FROM lineitem WHERE {skip}"""


@query("c04_explode_findings", EXPLODED.format(a="", b="", skip="l_linestatus <> 'O'"))
def explode_findings(t):
    return O.explode_findings(_nested(t), ["l_orderkey", "l_linenumber", "l_partkey"], "rules", skip=F.col("l_linestatus") == "O")


@query("c05_explode_items", EXPLODED.format(a=", 'a__NULL' AS \"key\"", b=", 'b__MIN'", skip="TRUE"))
def explode_items(t):
    return O.explode_items(_nested(t), ["l_orderkey", "l_linenumber", "l_partkey"], "dqItems")


@query("c06_stringify_lists", """
    SELECT l_orderkey, l_linenumber, l_partkey, concat('["', l_returnflag, '","', l_linestatus, '"]') AS alerts, l_linestatus AS sources FROM lineitem""")
def stringify(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array("l_returnflag", "l_linestatus").alias("alerts"), F.col("l_linestatus").alias("sources"))
    return O.stringify(df, ["alerts", "sources"])


@query("c07_route_region", """
    SELECT dataset, run_id, CASE WHEN dataset IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde') THEN 'inner' ELSE 'outer' END AS region FROM fx_run""")
def route_region(t):
    return O.route_region(t.fx_run.select("dataset", "run_id"), t.fx_bu.filter("business_unit LIKE '% - cde'"), "dataset", "inner", "outer")


@query("c08_tag_position", """
    SELECT p_partkey, NULLIF(trim(p_brand), '') AS data_domain, CASE WHEN p_size % 3 <> 0 THEN p_type END AS sub_domain FROM part""")
def tag_position(t):
    tags = F.array(F.lit("root"), F.concat(F.lit(" "), "p_brand", F.lit(" ")), F.when(F.col("p_size") % 3 != 0, F.col("p_type")).otherwise("  "))
    df = t.part.select("p_partkey", tags.alias("tags"))
    return df.select("p_partkey", K.tag_at("tags", 1).alias("data_domain"), K.tag_at("tags", 2).alias("sub_domain"))


@query("c09_attach_truthy", """
    SELECT r.dataset, r.run_id, CASE WHEN a."jobSchedule" THEN TRUE END AS "jobSchedule", NULLIF(a."connectionName", '') AS "connectionName", a.db_nm
    FROM fx_run r LEFT JOIN fx_attr a ON r.dataset = a.dataset""")
def attach_truthy(t):
    return O.attach_truthy(t.fx_run.select("dataset", "run_id"), t.fx_attr, "dataset", ["jobSchedule", "connectionName", "db_nm"])


@query("c10_enrich_override", """
    SELECT m.dataset, m.region, m.business_unit, m.ord, coalesce(a.db_nm, m.db_nm) AS db_nm, coalesce(a."connectionName", m."connectionName") AS "connectionName", a.table_nm
    FROM fx_mapping m LEFT JOIN fx_attr a ON m.dataset = a.dataset""")
def enrich_override(t):
    return O.enrich_override(t.fx_mapping, t.fx_attr, "dataset", ["db_nm", "connectionName", "table_nm"], ["ord"])


@query("c11_enrich_missing", """
    SELECT r.dataset, r.run_id, r.status, m.region, m.business_unit, m.db_nm, m."connectionName", m.ord
    FROM fx_run r LEFT JOIN fx_mapping m ON r.dataset = m.dataset""")
def enrich_missing(t):
    return O.enrich_missing(t.fx_run.select("dataset", "run_id", "status"), t.fx_mapping, "dataset", ["ord"])


_TOTAL = " - ".join(["100.0"] + [f"coalesce({c}, 0)" for c in SCORE_COLUMNS])


@query("c12_composite_score", f"SELECT dataset, run_id, CAST({_TOTAL} AS DOUBLE) AS \"DQScore\" FROM fx_score")
def composite_score(t):
    return O.composite_score(t.fx_score, SCORE_COLUMNS + ["absentScore"]).select("dataset", "run_id", "DQScore")


@query("c13_scorecard", f"""
    SELECT s.dataset, s.run_id, s.run_date, s."validityScore", CAST({_TOTAL} AS DOUBLE) AS "DQScore", m.region, m.business_unit, '2001-08' AS report_time
    FROM fx_score s LEFT JOIN fx_mapping m ON s.dataset = m.dataset""")
def scorecard(t):
    details = O.composite_score(t.fx_score, SCORE_COLUMNS)
    columns = ["dataset", "run_id", "run_date", "rows", "validityScore", "DQScore"]
    return O.scorecard(details, t.fx_mapping, "dataset", columns, ["dataset", "region", "business_unit", "absent"], F.lit("2001-08-15").cast("date"), ["ord"])


@query("c14_boolean_coercions", """
    SELECT word, n, CASE upper(trim(word)) WHEN 'TRUE' THEN TRUE WHEN 'FALSE' THEN FALSE END AS strict,
           coalesce(lower(trim(word)) IN ('true', 'yes', 'y', '1'), FALSE) AS truthy, coalesce(lower(trim(word)) IN ('true', 'yes', 'y', '1'), FALSE) AS boolish,
           coalesce(lower(trim(word)) IN ('true', 'yes', 'y', '1', 'on'), TRUE) AS parsed, n <> 0 AS number_truthy
    FROM (SELECT CASE l_linenumber WHEN 1 THEN ' True' WHEN 2 THEN 'false ' WHEN 3 THEN 'Yes' WHEN 4 THEN '1' WHEN 5 THEN 'ON' WHEN 6 THEN l_returnflag END AS word,
                 CAST(l_linenumber % 2 AS BIGINT) AS n FROM lineitem) s""")
def boolean_coercions(t):
    case = F.element_at(F.create_map(F.lit(1), F.lit(" True"), F.lit(2), F.lit("false "), F.lit(3), F.lit("Yes"), F.lit(4), F.lit("1"), F.lit(5), F.lit("ON")), F.col("l_linenumber"))
    word = F.coalesce(case, F.when(F.col("l_linenumber") == 6, F.col("l_returnflag")))
    df = t.lineitem.select(word.alias("word"), (F.col("l_linenumber") % 2).cast("bigint").alias("n"))
    return df.select(
        "word", "n", K.to_bool("word").alias("strict"), K.is_truthy("word").alias("truthy"), K.boolish("word").alias("boolish"),
        K.parse_bool("word", True).alias("parsed"), K.is_truthy("n", numeric=True).alias("number_truthy"),
    )


@query("c15_repair_timestamp", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS at FROM events""")
def repair_timestamp(t):
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_type") == "view", ".000+0000").otherwise("+00:00"))
    df = t.events.select("event_id", F.when(F.col("event_type") == "error", "NaT").otherwise(written).alias("text"))
    return df.select("event_id", F.date_format(K.repair_timestamp("text"), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("c16_null_pct", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 3 THEN NULL WHEN r > 1 THEN r / 100 * 100 ELSE r * 100 END AS pct
    FROM (SELECT *, CASE WHEN l_linenumber > 3 THEN l_quantity ELSE l_discount END AS r FROM lineitem) s""")
def null_pct(t):
    ratio = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).when(F.col("l_linenumber") > 3, F.col("l_quantity")).otherwise(F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", K.null_pct(ratio).alias("pct"))


@query("c17_coalesce_name", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN 'a' WHEN 2 THEN l_returnflag ELSE l_linestatus END AS col_name
    FROM lineitem WHERE l_linenumber <> 4""")
def coalesce_name(t):
    n = F.col("l_linenumber")
    df = t.lineitem.withColumns({
        "colName": F.when(n == 1, "a").when(n == 2, ""),
        "datasetField": F.struct(F.when(n == 2, F.col("l_returnflag")).when(n == 4, "  ").alias("fieldNm")),
        "runProfile": F.struct(F.col("l_linestatus").alias("colName")),
    })
    named = O.coalesce_name(df, ["colName", "datasetField.fieldNm", "runProfile.colName"], "col_name")
    return named.select("l_orderkey", "l_linenumber", "l_partkey", "col_name")


@query("c26_merge_deltas", """
    SELECT CAST(d.dataset AS STRING) AS dataset, CAST(d.run_id AS STRING) AS run_id, d.col_name, x.pct
    FROM (SELECT DISTINCT dataset, run_id, rule_nm AS col_name FROM fx_rule) d
    LEFT JOIN (SELECT dataset, run_id, name AS col_name, max(per_change) AS pct FROM (SELECT dataset, run_id, concat('if_', name, '_is_bad') AS name, per_change FROM fx_adaptive) a GROUP BY 1, 2, 3) x
      ON d.dataset = x.dataset AND d.run_id = x.run_id AND d.col_name = x.col_name""")
def merge_deltas(t):
    defs = t.fx_rule.select("dataset", "run_id", F.col("rule_nm").alias("col_name")).distinct().withColumn("pct", F.lit(None).cast("double"))
    deltas = t.fx_adaptive.groupBy("dataset", "run_id", F.concat(F.lit("if_"), "name", F.lit("_is_bad")).alias("col_name")).agg(F.max("per_change").alias("pct"))
    return O.merge_deltas(defs, deltas, ["dataset", "run_id", "col_name"])


@query("c27_enrich_definitions", """
    SELECT d.dataset, d.rule_nm, m.region, m.business_unit FROM (SELECT DISTINCT dataset, rule_nm FROM fx_rule) d LEFT JOIN fx_mapping m ON d.dataset = m.dataset""")
def enrich_definitions(t):
    return O.enrich_definitions(t.fx_rule.select("dataset", "rule_nm").distinct(), t.fx_mapping, "dataset", ["region", "business_unit", "absent"], ["ord"])


@query("c28_keep_observed", "SELECT dataset, ord FROM fx_bu WHERE dataset IN (SELECT dataset FROM fx_run)")
def keep_observed(t):
    return O.keep_observed(t.fx_bu.select("dataset", "ord"), t.fx_run, "dataset")


@query("c29_ensure_columns", "SELECT o_orderkey, o_custkey, CAST(NULL AS STRING) AS remark, CAST(NULL AS DOUBLE) AS score FROM orders")
def guarantee_columns(t):
    from pyspark.sql.types import StructType

    return ensure_columns(t.orders.select("o_orderkey", "o_custkey"), StructType.fromDDL("o_orderkey bigint, remark string, score double"))


TEMPLATED = """
    SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.region,
           {value} AS "ruleValue",
           CASE WHEN c."businessDesc" <> '' THEN c."businessDesc" WHEN x.description <> '' THEN x.description ELSE c."businessDesc" END AS "businessDesc"
    FROM fx_custom c LEFT JOIN fx_template_last x ON c.region = x.region AND c."ruleRepo" = x.name AND upper(c."ruleType") = 'CUSTOM'"""
_FILLED = "CASE WHEN coalesce(c.\"columnName\", '') <> '' THEN replace(x.value, '$colNm', c.\"columnName\") ELSE x.value END"


def _templates(t):
    return O.template_lookup(t.fx_template, "name", ["region"], [F.desc("ord")])


@query("c30_apply_templates", TEMPLATED.replace("{value}", f"CASE WHEN x.value <> '' THEN {_FILLED} ELSE c.\"ruleValue\" END"))
def apply_templates(t):
    return O.apply_templates(t.fx_custom, _templates(t)).select("l_orderkey", "l_linenumber", "l_partkey", "region", "ruleValue", "businessDesc")


@query("c30_fill_templates", TEMPLATED.replace("{value}", f"CASE WHEN c.\"ruleValue\" <> '' THEN c.\"ruleValue\" WHEN x.value <> '' THEN {_FILLED} ELSE c.\"ruleValue\" END"))
def fill_templates(t):
    return O.apply_templates(t.fx_custom, _templates(t), overwrite=False).select("l_orderkey", "l_linenumber", "l_partkey", "region", "ruleValue", "businessDesc")


@query("c31_template_lookup", "SELECT region, name, value, description, ord FROM fx_template_last")
def template_lookup(t):
    return _templates(t)


@query("c32_latest_metrics", """
    SELECT r.dataset, r.rule_nm, m.run_id, m.score, m.perc FROM fx_rules_only r LEFT JOIN
      (SELECT *, row_number() OVER (PARTITION BY dataset, rule_nm ORDER BY run_id DESC, seq DESC, seq2 DESC, score DESC, perc DESC) AS rn FROM fx_rule) m
      ON r.dataset = m.dataset AND r.rule_nm = m.rule_nm AND m.rn = 1""")
def latest_metrics(t):
    order = [F.desc("run_id"), F.desc("seq"), F.desc("seq2"), F.desc("score"), F.desc("perc")]
    return O.latest_metrics(t.fx_rules_only, t.fx_rule, ["dataset", "rule_nm"], ["run_id", "score", "perc"], order)


@query("c33_backfill", """
    SELECT b.dataset, b.ord, coalesce(CASE WHEN b.ord % 2 = 0 THEN b.ord END, l.run_id) AS run_id FROM fx_bu b
    LEFT JOIN (SELECT dataset, max(run_id) AS run_id FROM fx_run GROUP BY dataset) l ON b.dataset = l.dataset""")
def backfill(t):
    df = t.fx_bu.select("dataset", "ord", F.when(F.col("ord") % 2 == 0, F.col("ord")).alias("run_id"))
    lookup = t.fx_run.groupBy("dataset").agg(F.max("run_id").alias("latest"))
    return O.backfill(df, lookup, "dataset", "run_id", "latest")


@query("c34_order_columns", "SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice FROM orders")
def order_columns(t):
    return O.order_columns(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), ["absent", "o_orderstatus"])
