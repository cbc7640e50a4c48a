"""Domain report and history consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import coerce as K
from ..operators import history as H
from ..operators import report as R
from ..operators.relational import union_all
from .fixtures import add_views
from .registry import query

ZONE = ("Asia/Singapore", "SGT")
AS_OF = "DATE '2001-06-01'"
DOMAINS = {"FURN": "Furniture", "MACH": "Machinery,Tools", "HOUSE": "", "AUTO": "Automobile"}

add_views({
    "fx_dom": """
        SELECT r.dataset, r.rule_nm AS ruleNm, r.dim_name AS dimName, concat('col_', r.rule_nm) AS columnName, 'text' AS businessDesc,
               CASE WHEN r.break_msg = 'BREAKING' THEN CAST(r.score AS STRING) ELSE 'n/a' END AS score, r.run_id, r.seq, r.seq2,
               CASE WHEN r.dataset LIKE '%furniture%' THEN 'FURN, MACH' WHEN r.dataset LIKE '%household%' THEN 'HOUSE' WHEN r.dataset LIKE '%automobile%' THEN ' AUTO,,XX' ELSE CAST(NULL AS STRING) END AS subDomain,
               a.connectionName, a.db_nm, a.table_nm, m.region AS Market, m.business_unit AS Project, a.jobSchedule, m.region AS data_domain,
               CASE WHEN r.break_msg = 'BREAKING' THEN '12' END AS run_count
        FROM fx_rule r JOIN fx_attr a ON r.dataset = a.dataset JOIN fx_mapping m ON r.dataset = m.dataset""",
    "fx_system": "SELECT concat('conn_', lower(r_name)) AS connectionName, CASE WHEN r_regionkey = 1 THEN '' ELSE concat('System ', r_name) END AS system FROM region WHERE r_regionkey > 0",
    "fx_past": """
        SELECT dataset, CAST(run_date AS DATE) AS day, run_id, row_cnt, 'past' AS origin, strftime_month AS report_time FROM
          (SELECT *, substr(CAST(CAST(run_date AS DATE) AS STRING), 1, 7) AS strftime_month FROM fx_run) s WHERE run_date < TIMESTAMP '2000-01-01 00:00:00'""",
    "fx_now": """
        SELECT dataset, CAST(run_date AS DATE) AS day, run_id, row_cnt + 1 AS row_cnt, 'now' AS origin, substr(CAST(CAST(run_date AS DATE) AS STRING), 1, 7) AS report_time
        FROM fx_run WHERE run_date >= TIMESTAMP '1999-06-01 00:00:00'""",
    "fx_hist": "SELECT dataset, run_id, run_date, CASE WHEN status <> 'P' THEN row_cnt END AS row_cnt, row_cnt % 50 AS behaviorScore, 100 - row_cnt % 50 AS DQScore FROM fx_run",
    "fx_hist7": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_hist) s WHERE rn <= 7",
})


@query("d01_runs_in_window", f"""
    SELECT b.dataset, count(r.run_id) AS run_count FROM fx_bu b LEFT JOIN fx_run r ON b.dataset = r.dataset AND r.run_date >= {AS_OF} - INTERVAL 90 DAY GROUP BY b.dataset""")
def runs_in_window(t):
    return R.runs_in_window(t.fx_run, t.fx_bu, F.expr(AS_OF), 90, "dataset", "run_date")


@query("d02_lookup_distinct", """
    SELECT r.dataset, r.run_id, r.rule_nm, s.row_cnt, s.status FROM fx_rule r LEFT JOIN fx_run s ON r.dataset = s.dataset AND r.run_id = s.run_id""")
def lookup_distinct(t):
    return R.lookup_distinct(t.fx_rule.select("dataset", "run_id", "rule_nm"), t.fx_run, ["dataset", "run_id"], ["row_cnt", "status"], ["run_date"])


_MAPPED = """CASE "subDomain" WHEN 'FURN, MACH' THEN 'Furniture,Machinery,Tools' WHEN ' AUTO,,XX' THEN 'Automobile,XX' ELSE '' END"""


@query("d03_map_multi", f'SELECT dataset, run_id, "ruleNm", {_MAPPED} AS "Domain" FROM fx_dom')
def map_multi(t):
    return t.fx_dom.select("dataset", "run_id", "ruleNm", R.map_multi("subDomain", DOMAINS).alias("Domain"))


@query("d04_map_default", """
    SELECT a.dataset, a."connectionName", coalesce(s.system, 'Other') AS system FROM fx_attr a LEFT JOIN fx_system s ON a."connectionName" = s."connectionName\"""")
def map_default(t):
    return R.map_default(t.fx_attr.select("dataset", "connectionName"), "connectionName", t.fx_system, "connectionName", "system", "Other", "system")


@query("d05_composite_id", "SELECT dataset, db_nm || '.' || table_nm AS id FROM fx_attr")
def composite_id(t):
    return t.fx_attr.select("dataset", K.composite_id("db_nm", "table_nm").alias("id"))


@query("d06_quality_ratio", 'SELECT dataset, run_id, "ruleNm", seq, (100 - TRY_CAST(score AS DOUBLE)) / 100 AS ratio FROM fx_dom')
def quality_ratio(t):
    return t.fx_dom.select("dataset", "run_id", "ruleNm", "seq", K.quality_ratio("score").alias("ratio"))


@query("d07_flag_member", "SELECT dataset, run_id, CASE WHEN dataset IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde') THEN 'Yes' ELSE 'No' END AS flag FROM fx_run")
def flag_member(t):
    return R.flag_member(t.fx_run.select("dataset", "run_id"), t.fx_bu.filter("business_unit LIKE '% - cde'"), "dataset", "flag")


DOMAIN_SQL = f"""
    SELECT d."Domain", NULLIF(coalesce(s.system, 'Other'), '') AS "System or Platform", x."columnName" AS "Applicable Critical Data Element", x.db_nm || '.' || x.table_nm AS "ID",
           x."ruleNm" AS "Name", x."businessDesc" AS "Rule", x."dimName" AS "DQ Dimension", (100 - TRY_CAST(x.score AS DOUBLE)) / 100 AS "Data Quality Score",
           coalesce(CAST(x.run_count AS BIGINT), 0) AS "Number of Records", CASE WHEN x."Project" LIKE '% - cde' THEN 'Yes' ELSE 'No' END AS "DQ Trigger",
           x."Market", x."Project", x."jobSchedule", x.data_domain AS "Data Domain", x.dataset
    FROM fx_dom x LEFT JOIN fx_system s ON x."connectionName" = s."connectionName",
         LATERAL (SELECT unnest(string_split({_MAPPED}, ',')) AS "Domain") d WHERE d."Domain" <> ''"""


def _domains(t):
    return R.explode_domains(t.fx_dom.withColumnRenamed("data_domain", "Data Domain"), DOMAINS, t.fx_system, t.fx_bu.filter("business_unit LIKE '% - cde'"), "Other")


@query("d08_explode_domains", DOMAIN_SQL)
def explode_domains(t):
    return _domains(t)


@query("d09_split_by_domain", f'SELECT concat(\'out_\', lower("Domain")) AS output, "Name", count(*) AS n FROM ({DOMAIN_SQL}) q GROUP BY 1, 2')
def split_by_domain(t):
    parts = R.split_by_domain(_domains(t), {f"out_{d.lower()}": d for d in ("Furniture", "Machinery", "Tools", "Automobile", "XX")})
    frames = [df.groupBy("Name").agg(F.count("*").alias("n")).withColumn("output", F.lit(name)) for name, df in parts.items()]
    return union_all(frames)


@query("e01_normalize_history", """
    SELECT run_id, CAST(CAST(run_date AS DATE) AS VARCHAR) AS "runId", CASE status WHEN 'O' THEN 'Aus & NZ' WHEN 'P' THEN 'R&D' ELSE 'japan' END AS "Market" FROM fx_run""")
def normalize_history(t):
    market = F.expr("CASE status WHEN 'O' THEN ' A&AMP;N ' WHEN 'P' THEN 'R&AMP;D' ELSE 'japan ' END")
    df = t.fx_run.select("run_id", F.date_format("run_date", "yyyy-MM-dd'T'HH:mm:ss").alias("runId"), market.alias("Market"))
    return H.normalize_history(df, {"A&N": "Aus & NZ", "JAPAN": "Japan"})


_BOTH = "(SELECT *, 0 AS src FROM fx_past UNION ALL SELECT *, 1 FROM fx_now)"
MERGED_SQL = f"""
    SELECT dataset, day, run_id, row_cnt, origin, report_time FROM
      (SELECT *, row_number() OVER (PARTITION BY dataset, day ORDER BY src DESC, run_id DESC) AS rn FROM {_BOTH} b) q WHERE rn = 1"""


def _merged(t):
    return H.union_keep_last(t.fx_past, t.fx_now, ["dataset", "day"], [F.desc("run_id")])


@query("e02_union_keep_last", MERGED_SQL)
def union_keep_last(t):
    return _merged(t)


@query("e03_append_new", f"""
    SELECT dataset, day, run_id, row_cnt, origin, report_time FROM fx_past
    UNION ALL SELECT * FROM ({MERGED_SQL}) m WHERE NOT EXISTS (SELECT 1 FROM fx_past p WHERE p.dataset = m.dataset AND p.day = m.day)""")
def append_new(t):
    return H.append_new(t.fx_past, _merged(t), ["dataset", "day"], ["run_id"])


MONTHLY_SQL = """
    WITH merged AS ({merged}),
    monthly AS (SELECT dataset, report_time, day, run_id, row_cnt, origin FROM (SELECT *, row_number() OVER (PARTITION BY dataset, report_time ORDER BY day DESC, run_id DESC) AS rn FROM merged) a WHERE rn = 1),
    past AS (SELECT dataset, report_time, day, run_id, row_cnt, origin FROM (SELECT *, row_number() OVER (PARTITION BY dataset, report_time ORDER BY day DESC, run_id DESC) AS rn FROM {past}) b WHERE rn = 1),
    pick AS (SELECT (SELECT count(*) FROM past WHERE report_time = (SELECT max(report_time) FROM past))
                  > (SELECT count(*) FROM monthly WHERE report_time = (SELECT max(report_time) FROM past)) AS fuller)
    SELECT monthly.* FROM monthly, pick WHERE NOT fuller UNION ALL SELECT past.* FROM past, pick WHERE fuller"""


def _by_day():
    return [F.desc("day"), F.desc("run_id")]


@query("e04_monthly_snapshot", MONTHLY_SQL.format(merged=MERGED_SQL, past="fx_past"))
def monthly_snapshot(t):
    return H.monthly_snapshot(_merged(t), t.fx_past, ["dataset"], _by_day(), _by_day())


@query("e04_monthly_from_history", MONTHLY_SQL.format(merged="SELECT * FROM fx_now WHERE origin = 'none'", past="fx_past"))
def monthly_from_history(t):
    return H.monthly_snapshot(t.fx_now.filter("origin = 'none'"), t.fx_past, ["dataset"], _by_day(), _by_day())


@query("e05_project_for_sink", """
    SELECT dataset, status = 'O' AS "jobSchedule", strftime(run_date, '%Y-%m-%d %H:%M:%S') AS "runDate", CAST(row_cnt AS VARCHAR) AS rows, CAST(NULL AS VARCHAR) AS remark
    FROM fx_run""")
def project_for_sink(t):
    schema = StructType.fromDDL("dataset string, runDate timestamp_ntz, rows string, jobSchedule boolean, remark string")
    df = t.fx_run.select(
        F.expr("CASE status WHEN 'O' THEN 'true' ELSE 'False' END").alias("jobSchedule"),
        F.date_format("run_date", "yyyy-MM-dd'T'HH:mm:ss'+0000'").alias("runDate"), F.col("row_cnt").alias("rows"), "dataset",
    )
    return H.project_for_sink(df, schema).withColumn("runDate", F.date_format("runDate", "yyyy-MM-dd HH:mm:ss"))


@query("f16_last_n_runs", """
    SELECT dataset, run_id, run_date, row_cnt FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) s
    WHERE rn <= 7 AND dataset IN (SELECT dataset FROM fx_adaptive WHERE status = 'Breaking')""")
def last_n_runs(t):
    wanted = t.fx_adaptive.filter("status = 'Breaking'")
    return H.last_n_runs(t.fx_run, wanted, 7, "dataset", "run_date", "run_id").select("dataset", "run_id", "run_date", "row_cnt")


@query("f17_row_history", """
    WITH filled AS (SELECT *, last_value(row_cnt IGNORE NULLS) OVER (PARTITION BY dataset ORDER BY run_date, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM fx_hist7),
    changed AS (SELECT *, CASE WHEN lag(f) OVER w = 0 THEN NULL ELSE (CAST(f AS DOUBLE) / CAST(lag(f) OVER w AS DOUBLE) - 1) * 100.0 END AS pct FROM filled WINDOW w AS (PARTITION BY dataset ORDER BY run_date, run_id)),
    texts AS (SELECT dataset, concat('*Row count history (last 7 runs)*', chr(10), chr(10), '| runDate | rows | % change vs prev | behaviorScore | DQScore |', chr(10), '|---|---:|---:|---:|---:|', chr(10),
        string_agg(concat('| ', strftime(run_date + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S'), ' SGT | ', coalesce(CAST(row_cnt AS VARCHAR), 'NA'), ' | ', coalesce(printf('%.2f', pct) || '%', 'NA'), ' | ',
            CAST("behaviorScore" AS VARCHAR), ' | ', CAST("DQScore" AS VARCHAR), ' |'), chr(10) ORDER BY run_date DESC, run_id DESC)) AS history_text FROM changed GROUP BY dataset),
    ranked AS (SELECT a.dataset, a.run_id AS at_id, a.run_date AS at_date, c.row_cnt, c.pct, c.run_date, c.run_id,
                 bool_or(c.run_date = a.run_date) OVER (PARTITION BY a.dataset, a.run_id) AS matched FROM fx_run a JOIN changed c ON a.dataset = c.dataset),
    cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY at_id ORDER BY CASE WHEN matched AND run_date <> at_date THEN 1 ELSE 0 END, run_date DESC, run_id DESC) AS rn FROM ranked) s WHERE rn = 1),
    prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY at_id ORDER BY run_date DESC, run_id DESC) AS rn FROM ranked WHERE NOT matched OR run_date < at_date) s)
    SELECT cur.dataset, cur.at_id AS run_id, cur.at_date AS run_date, cur.row_cnt AS rows_current, prev.row_cnt AS rows_prev, cur.pct AS rows_pct_change_vs_prev, texts.history_text
    FROM cur JOIN texts ON cur.dataset = texts.dataset LEFT JOIN prev ON prev.at_id = cur.at_id AND prev.rn = CASE WHEN cur.matched THEN 1 ELSE 2 END""")
def row_history(t):
    wanted = t.fx_run.select("dataset", "run_id", "run_date")
    return H.row_history(t.fx_hist, wanted, "dataset", "run_date", "run_id", "row_cnt", "run_date", *ZONE)


CHANGE_SQL = """
    SELECT dataset, run_id, run_date, row_cnt, rows_prev, CASE WHEN rows_prev <> 0 THEN CAST(row_cnt - rows_prev AS DOUBLE) / rows_prev * 100.0 END AS row_pct_change,
           CAST(CAST(run_date AS DATE) AS VARCHAR) AS run_key
    FROM (SELECT *, lag(row_cnt) OVER (PARTITION BY dataset ORDER BY run_date, run_id) AS rows_prev FROM
           (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) a WHERE rn <= 4) b"""


@query("h03_change_vs_previous", CHANGE_SQL)
def change_vs_previous(t):
    return H.change_vs_previous(t.fx_run, 4, "dataset", "run_date", "run_id", "row_cnt").drop("status")


@query("h04_newest_runs", "SELECT dataset, run_id FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) s WHERE rn <= 3")
def newest_runs(t):
    return H.newest_runs(t.fx_run, 3, "dataset", "run_date", "run_id").select("dataset", "run_id")
