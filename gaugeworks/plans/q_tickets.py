"""Ticket inventory, candidates and planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce as K
from ..functions import text as X
from ..operators import candidates as C
from ..operators import matching as M
from ..operators import planning as P
from ..operators import tickets as T
from .fixtures import add_views
from .q_report import ZONE
from .registry import query

NAME_RULES = [("col_7_", "{}: invalid id", "id: invalid"), ("pair", "pair: mismatch", "pair: mismatch")]

add_views({
    "fx_ticket": """
        SELECT concat('T-', CAST(run_id AS STRING)) AS key, 'Sub-task' AS issue_type, dataset AS parent_summary, concat('P-', dataset) AS parent_key,
               concat('col_', CAST(run_id % 7 + 1 AS STRING), CASE run_id % 7 WHEN 1 THEN ': Inconsistent' WHEN 2 THEN ': Inaccurate'
                   WHEN 3 THEN ': Duplicates' WHEN 4 THEN ': Out-of-date' WHEN 5 THEN ': NULL' ELSE ': Invalid' END) AS title,
               CASE status WHEN 'O' THEN 'Open' WHEN 'P' THEN 'In Progress' ELSE 'Closed' END AS status,
               CASE run_id % 4 WHEN 0 THEN 'Adaptive, dq' WHEN 1 THEN '["dq", "dupes"]' WHEN 2 THEN '' ELSE 'pattern' END AS labels,
               run_date AS date_updated, run_date - INTERVAL 5 DAY AS date_created, run_id AS ord FROM fx_run
        UNION ALL SELECT concat('P-', dataset), 'Task', CAST(NULL AS STRING), CAST(NULL AS STRING), dataset, 'Open', 'quality',
               CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), ord FROM fx_bu WHERE business_unit NOT LIKE '% - cde'""",
    "fx_find": """
        SELECT a.dataset, concat('r', CAST(a.run_id AS STRING)) AS runId, a.run_id, a.run_date, a.name, a.type, concat(a.name, '__', a.type) AS key, a.status,
               CAST(floor(a.value) AS DOUBLE) AS value, CAST(floor(a.mean) AS DOUBLE) AS mean, a.score, a.per_change AS perChange, 2.0 + 0.5 AS zscore, concat('saw ', a.name) AS verbose,
               x.db_nm, x.table_nm, m.business_unit AS Project, a.seq, a.seq2
        FROM fx_adaptive a JOIN fx_attr x ON a.dataset = x.dataset JOIN fx_mapping m ON a.dataset = m.dataset""",
    "fx_break": """
        SELECT *, type = 'ROW_COUNT' AS is_row_count FROM fx_find
        WHERE lower(status) = 'breaking' AND dataset NOT IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde')""",
    "fx_obs": """
        SELECT concat('ds_s', CAST(l_suppkey AS STRING)) AS dataset, CAST(extract(YEAR FROM l_shipdate) AS STRING) AS runId,
               CASE WHEN l_linenumber = 7 THEN 'no separator' ELSE concat('Title ~~ ', l_returnflag, l_linestatus) END AS obs,
               concat(lpad(CAST(l_orderkey AS STRING), 10, '0'), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS obsKey,
               l_tax * 100 AS obsScore, CAST(floor(l_quantity) AS BIGINT) AS owlRank, l_linenumber AS line, l_shipdate,
               CASE WHEN l_discount > 0.02 THEN 'TRUE' ELSE 'false' END AS jobSchedule FROM lineitem""",
    "fx_cand": """
        SELECT r.dataset, concat('r', CAST(r.run_id AS STRING)) AS runId, r.rule_nm AS ruleNm, r.dim_name AS dimName, r.score, r.perc, r.seq, r.seq2,
               concat('col_', CAST(r.seq % 9 AS STRING), ': Invalid') AS suggested_title,
               CASE WHEN r.seq % 6 = 5 THEN CAST(NULL AS STRING) ELSE concat('unit ', r.dim_name) END AS business_unit,
               CASE r.seq % 4 WHEN 0 THEN 'custom' WHEN 1 THEN 'adaptive' WHEN 2 THEN 'dupes' ELSE 'pattern' END AS ticket_source
        FROM fx_rule r WHERE r.break_msg = 'BREAKING' AND r.perc > 0""",
    "fx_limit": "SELECT dataset, CAST(20 + ord % 20 AS DOUBLE) AS threshold FROM fx_bu WHERE business_unit LIKE '% - cde'",
})

TIE = ["seq", "seq2", "key", "value"]
DIM_TITLE = """CASE dim_name WHEN 'Validity' THEN ': Invalid' WHEN 'Consistency' THEN ': Inconsistent' WHEN 'Accuracy' THEN ': Inaccurate'
             WHEN 'Uniqueness' THEN ': Duplicates' WHEN 'Timeliness' THEN ': Out-of-date' ELSE ': NULL' END"""
ACTIVE = "('Open', 'To Do', 'In Progress', 'Reopened')"


@query("f01_labels", """
    SELECT key, CASE labels WHEN 'Adaptive, dq' THEN 'adaptive|dq' WHEN '["dq", "dupes"]' THEN 'dq|dupes' ELSE labels END AS labels FROM fx_ticket""")
def labels(t):
    return t.fx_ticket.select("key", F.array_join(X.labels_to_array("labels"), "|").alias("labels"))


def _raw(t):
    status = F.expr("CASE o_orderstatus WHEN 'O' THEN 'Open' ELSE 'Closed' END")
    kind = F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'Task' WHEN '2-HIGH' THEN 'Epic' ELSE 'Sub-task' END")
    version = F.struct(F.when(F.col("o_orderstatus") == "P", "DELETED").otherwise(F.col("o_orderpriority")).alias("name"), F.lit("JP").alias("description"))
    fields = F.struct(
        F.concat(F.lit("ds_"), F.col("o_custkey").cast("string")).alias("summary"),
        F.struct(status.alias("name")).alias("status"),
        F.struct(kind.alias("name")).alias("issuetype"),
        F.struct(F.struct(F.concat(F.lit("ds_"), F.col("o_custkey").cast("string")).alias("summary")).alias("fields"), F.lit("P").alias("key")).alias("parent"),
        F.array(F.struct(F.lit("first").alias("name")), F.struct(F.lit("second").alias("name"))).alias("components"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.array(version)).alias("versions"),
        F.date_format(F.col("o_orderdate") - F.expr("INTERVAL 9 DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSS'-0400'").alias("created"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'-0400'").alias("updated"),
    )
    return t.orders.select(F.concat(F.lit("T-"), F.col("o_orderkey").cast("string")).alias("key"), fields.alias("fields"))


@query("f02_prepare_tickets", """
    SELECT concat('T-', CAST(o_orderkey AS VARCHAR)) AS key, CASE o_orderpriority WHEN '1-URGENT' THEN 'task' WHEN '2-HIGH' THEN 'epic' ELSE 'subtask' END AS output,
           concat('ds_', CAST(o_custkey AS VARCHAR)) AS title, 'first' AS project, CASE o_orderstatus WHEN 'O' THEN 'Open' ELSE 'Closed' END AS status,
           9 AS issue_duration_days, strftime(o_orderdate, '%Y-%m') AS report_date, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS version_name,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'JP' END AS market, CAST(NULL AS VARCHAR) AS assignee
    FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '5-LOW'""")
def prepare_tickets(t):
    columns = ["key", "output", "title", "project", "status", "issue_duration_days", "report_date", "version_name", "market", "assignee"]
    subtasks, tasks, epics = T.prepare_tickets(_raw(t))
    named = {"subtask": subtasks, "task": tasks, "epic": epics}
    frames = [df.withColumn("output", F.lit(name)).select(*columns) for name, df in named.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("f03_filter_reference", """
    SELECT dataset, run_id, dataset IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde') AS included FROM fx_run""")
def filter_reference(t):
    reference = t.fx_bu.filter("business_unit LIKE '% - cde'")
    inside = C.filter_reference(t.fx_run, reference, "dataset", True).select("dataset", "run_id", F.lit(True).alias("included"))
    return inside.unionByName(C.filter_reference(t.fx_run, reference, "dataset", False).select("dataset", "run_id", F.lit(False).alias("included")))


_TITLE = """CASE WHEN l_linenumber = 7 THEN 'col_7: invalid id'
    WHEN l_linenumber = 1 THEN 'col_1: Invalid' WHEN l_linenumber = 2 THEN 'col_2: Inconsistent' WHEN l_linenumber = 3 THEN 'col_3: Inaccurate'
    WHEN l_linenumber = 4 THEN 'col_4: Duplicates' WHEN l_linenumber = 5 THEN 'col_5: Out-of-date' ELSE 'col_6: NULL' END"""


@query("f04_rule_title", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_TITLE} AS title FROM lineitem")
def rule_title(t):
    df = t.sql("SELECT r.*, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey FROM lineitem l JOIN (SELECT DISTINCT rule_nm, dim_name FROM fx_rule) r ON r.rule_nm = concat('if_col_', CAST(l.l_linenumber AS STRING), '_is_bad')")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.rule_title("rule_nm", F.lit(" "), "dim_name", NAME_RULES).alias("title"))


@query("f05_derive_labels", """
    SELECT dataset, run_id, rule_nm, seq, concat(dim_name, '|Data|Rule') AS rule_labels,
           concat('dq|end-users|', lower(dim_name), CASE WHEN break_msg = 'PASSING' THEN '|custom' ELSE '' END) AS ticket_labels FROM fx_rule""")
def derive_labels(t):
    extra = F.when(F.col("break_msg") == "PASSING", F.array(F.lit("custom"), F.lit("dq"), F.lit("")))
    return t.fx_rule.select(
        "dataset", "run_id", "rule_nm", "seq", F.array_join(X.dimension_labels(F.upper("dim_name")), "|").alias("rule_labels"),
        F.array_join(X.derive_labels(["dq", "end-users"], "dim_name", extra), "|").alias("ticket_labels"),
    )


@query("f06_severity", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount * 100 >= 10 THEN 'Critical' WHEN l_discount * 100 >= 1 THEN 'High' ELSE 'Medium' END AS by_percent,
           CASE WHEN l_returnflag = 'A' THEN 'Medium' WHEN l_quantity >= 20 THEN 'Critical' WHEN l_quantity >= 10 THEN 'High' ELSE 'Medium' END AS by_total FROM lineitem""")
def severity(t):
    total = F.when(F.col("l_returnflag") == "A", F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.severity_from_percent(F.col("l_discount") * 100).alias("by_percent"),
        K.severity_from_total(total).alias("by_total"),
    )


@query("f07_title_value", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN source WHEN trim(text, ' ') <> '' THEN trim(text, ' ') ELSE concat('rule ', CAST(doc_id AS VARCHAR)) END AS value FROM documents""")
def title_value(t):
    column = F.when(F.col("lang") == "en", F.col("source")).otherwise("  ")
    return t.documents.select("doc_id", X.title_value(column, "text", F.concat(F.lit("rule "), F.col("doc_id").cast("string"))).alias("value"))


def _rule_titles(t):
    return t.fx_rule.filter("break_msg = 'BREAKING' AND perc > 0").select("dataset", X.rule_title("rule_nm", F.lit(None), "dim_name").alias("title"))


def _open_titles(t):
    return T.active_subtasks(t.fx_ticket).select(F.col("parent_summary").alias("dataset"), "title", "ord")


LCS = """list_last(list_reduce(string_split({a}, ''), lambda d, ch: list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc,
    CASE WHEN substr({b}, j, 1) = ch THEN d[j] + 1 ELSE greatest(acc[j], d[j + 1]) END), [CAST(0 AS BIGINT)]), list_resize([CAST(0 AS BIGINT)], length({b}) + 1, 0)))"""

# Two TF-IDF cosines fitted on a dataset's open titles, the token-set ratio, and the share of column names.
MATCH_SQL = f"""
    WITH cand AS (SELECT DISTINCT dataset, concat(substr(rule_nm, 4, 5), {DIM_TITLE}) AS title FROM fx_rule WHERE break_msg = 'BREAKING' AND perc > 0),
    tick AS (SELECT parent_summary AS dataset, title, count(*) AS copies, min(ord) AS ord FROM fx_ticket WHERE issue_type = 'Sub-task' AND status IN {ACTIVE} AND trim(title) <> '' GROUP BY 1, 2),
    names AS (SELECT DISTINCT title, lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS norm FROM (SELECT title FROM cand UNION SELECT title FROM tick) u),
    ws AS (SELECT title, regexp_extract_all(norm, '\\w+') AS w, list_filter(string_split(norm, ' '), lambda x: x <> '') AS parts FROM names),
    grams AS (
      SELECT title, 'w' AS space, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term FROM ws
      UNION ALL SELECT title, 'c', substr(p, CAST(i AS INTEGER), size) FROM (SELECT title, p, size, unnest(range(1, length(p) - size + 2)) AS i
        FROM (SELECT title, concat(' ', unnest(parts), ' ') AS p FROM ws) x, (VALUES (3), (4), (5)) s(size) WHERE length(p) >= size) y),
    tf AS (SELECT title, space, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3),
    total AS (SELECT dataset, sum(copies) AS n FROM tick GROUP BY 1),
    idf AS (SELECT k.dataset, space, term, ln(CAST(1 + max(n) AS DOUBLE) / CAST(1 + sum(copies) AS DOUBLE)) + 1 AS idf FROM tick k JOIN tf USING (title) JOIN total o ON o.dataset = k.dataset GROUP BY 1, 2, 3),
    vec AS (SELECT i.dataset, s.title, space, term, tf * idf AS w FROM (SELECT dataset, title FROM cand UNION SELECT dataset, title FROM tick) s JOIN tf USING (title) JOIN idf i USING (space, term) WHERE i.dataset = s.dataset),
    unit AS (SELECT dataset, title, space, term, w / sqrt(sum(w * w) OVER (PARTITION BY dataset, title, space)) AS u FROM vec),
    cosine AS (SELECT a.dataset, a.title AS c, b.title AS t, sum(0.35 * a.u * b.u) AS cosines FROM unit a JOIN unit b USING (dataset, space, term) GROUP BY 1, 2, 3),
    pair AS (SELECT c.dataset, c.title AS c, k.title AS t, k.ord, coalesce(x.cosines, 0) AS cosines FROM cand c JOIN tick k ON k.dataset = c.dataset LEFT JOIN cosine x ON x.dataset = c.dataset AND x.c = c.title AND x.t = k.title),
    texts AS (SELECT DISTINCT c, t, list_distinct(list_filter(string_split(c, ' '), lambda x: x <> '')) AS x, list_distinct(list_filter(string_split(t, ' '), lambda x: x <> '')) AS y,
        list_distinct(list_filter(regexp_extract_all(lower(c), '[a-z0-9_]+'), lambda x: contains(x, '_') OR ends_with(x, 'id') OR ends_with(x, 'code'))) AS cc,
        list_distinct(list_filter(regexp_extract_all(lower(t), '[a-z0-9_]+'), lambda x: contains(x, '_') OR ends_with(x, 'id') OR ends_with(x, 'code'))) AS tc FROM pair),
    cut AS (SELECT c, t, len(cc) AS n_cols, len(list_intersect(cc, tc)) AS shared_cols, array_to_string(list_sort(list_intersect(x, y)), ' ') AS s,
        array_to_string(list_sort(list_filter(x, lambda e: NOT list_contains(y, e))), ' ') AS l, array_to_string(list_sort(list_filter(y, lambda e: NOT list_contains(x, e))), ' ') AS r FROM texts),
    sized AS (SELECT *, length(s) AS base, CASE WHEN s <> '' THEN 1 ELSE 0 END AS gap, CASE WHEN l = '' OR r = '' THEN 0 ELSE {LCS.format(a="l", b="r")} END AS common FROM cut),
    ratio AS (SELECT *, CASE WHEN s <> '' AND (l = '' OR r = '') THEN 1.0 ELSE greatest(
        1 - CAST(length(l) + length(r) - 2 * common AS DOUBLE) / (2 * (base + gap) + length(l) + length(r)),
        CASE WHEN s <> '' THEN 1 - CAST(gap + length(l) AS DOUBLE) / (2 * base + gap + length(l)) ELSE 0 END,
        CASE WHEN s <> '' THEN 1 - CAST(gap + length(r) AS DOUBLE) / (2 * base + gap + length(r)) ELSE 0 END) END AS tokens FROM sized),
    scored AS (SELECT p.dataset, p.c, p.t, p.ord, round(cosines + 0.2 * tokens + 0.1 * CASE WHEN shared_cols = 0 THEN 0.0 WHEN shared_cols = n_cols THEN 1.0
        ELSE CAST(shared_cols AS DOUBLE) / max(shared_cols) OVER (PARTITION BY p.dataset, p.c) END, 12) AS score FROM pair p JOIN ratio q ON q.c = p.c AND q.t = p.t)
    SELECT dataset, title, matched_title, CAST(score AS DOUBLE) AS score FROM (SELECT dataset, c AS title, t AS matched_title, score, row_number() OVER (PARTITION BY dataset, c ORDER BY score DESC, ord) AS rn FROM scored WHERE score >= 0.72) b WHERE rn = 1"""


@query("f08_match_titles", MATCH_SQL)
def match_titles(t):
    return M.match_titles(_rule_titles(t), _open_titles(t))


CUSTOM_SQL = f"""
    SELECT b.dataset, a.db_nm || '.' || a.table_nm AS table_name, b.run_id AS "runId", b.rule_nm AS "ruleNm", CAST(NULL AS VARCHAR) AS "ruleType", CAST(NULL AS VARCHAR) AS "ruleValue",
           b.dim_name AS "dimName", b.score, b.perc, a.region AS business_unit, substr(b.rule_nm, 4, 5) AS violation_columns, b.title AS suggested_title,
           concat(b.dim_name, '|Data|Rule') AS suggested_labels, CASE WHEN b.perc >= 10 THEN 'Critical' WHEN b.perc >= 1 THEN 'High' ELSE 'Medium' END AS suggested_priority,
           concat('*Dataset:* ', b.dataset, chr(10), '*DataTable:* ', coalesce(a.db_nm || '.' || a.table_nm, 'NA'), chr(10), '*RunId:* ', CAST(b.run_id AS VARCHAR), chr(10),
             '*Project:* ', a.region, chr(10), '*Rule:* ', b.rule_nm, chr(10), '*Dimension:* ', b.dim_name, chr(10), '*Affected percentage:* ', printf('%.2f', b.perc), '%', chr(10), '*Column:* ', substr(b.rule_nm, 4, 5)) AS jira_description
    FROM (SELECT r.*, concat(substr(rule_nm, 4, 5), {DIM_TITLE}) AS title FROM fx_rule r WHERE break_msg = 'BREAKING' AND perc > 0) b
    JOIN (SELECT x.*, m.region FROM fx_attr x JOIN fx_mapping m ON x.dataset = m.dataset) a ON a.dataset = b.dataset
    WHERE a."jobSchedule\""""


def _custom(t, tickets):
    breaks = t.fx_rule.select("dataset", F.col("run_id").alias("runId"), F.col("rule_nm").alias("ruleNm"), F.col("break_msg").alias("breakMsg"), "score", "perc")
    rules = t.sql("""
        SELECT r.dataset, r.run_id AS runId, r.rule_nm AS ruleNm, r.dim_name AS dimName, substr(r.rule_nm, 4, 5) AS columnName, a.jobSchedule, a.db_nm, a.table_nm, m.region AS Project
        FROM (SELECT DISTINCT dataset, run_id, rule_nm, dim_name FROM fx_rule) r JOIN fx_attr a ON r.dataset = a.dataset JOIN fx_mapping m ON r.dataset = m.dataset""")
    return C.custom_candidates(rules, breaks, tickets)


@query("f09_custom_candidates", CUSTOM_SQL)
def custom_candidates(t):
    """Against closed tickets only, so that no candidate is a duplicate and SQL can state the result."""
    closed = t.fx_ticket.filter("status = 'Closed'")
    return C.ordered_candidates(_custom(t, closed)).withColumn("suggested_labels", F.array_join("suggested_labels", "|"))


@query("f09_custom_candidates_matched", f"""
    WITH all_of AS ({CUSTOM_SQL}), matched AS ({MATCH_SQL.replace("WITH cand AS", "SELECT * FROM (WITH cand AS") + ")"})
    SELECT a.* FROM all_of a WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.dataset = a.dataset AND m.title = a.suggested_title)""")
def custom_candidates_matched(t):
    """Against all tickets: near-equal open titles remove candidates."""
    return C.ordered_candidates(_custom(t, t.fx_ticket)).withColumn("suggested_labels", F.array_join("suggested_labels", "|"))


@query("f10_number_text", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS safe,
           CASE WHEN l_returnflag = 'A' THEN 'NA' ELSE printf('%.2f', l_discount * 100) || '%' END AS pct,
           CASE WHEN l_returnflag = 'A' THEN 'NA' ELSE CAST(CAST(l_quantity * 1000 AS BIGINT) AS VARCHAR) END AS whole,
           CASE WHEN l_tax = 0 THEN '0' ELSE printf('%.2f', l_tax) END AS small FROM lineitem""")
def number_text(t):
    def odd(c):
        return F.when(F.col("l_returnflag") == "A", F.lit(float("inf"))).otherwise(c)

    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.safe_double(odd(F.col("l_quantity"))).alias("safe"),
        K.fmt_pct(odd(F.col("l_discount") * 100)).alias("pct"), K.fmt_num(odd(F.col("l_quantity") * 1000)).alias("whole"), K.fmt_num("l_tax").alias("small"),
    )


@query("f11_classify_breaks", """
    SELECT dataset, "runId", key, seq, seq2, value, upper(type) AS break_type, type = 'ROW_COUNT' AS is_row_count, name AS item FROM fx_find""")
def classify_breaks(t):
    df = t.fx_find.withColumn("type", F.when(F.col("type") != "NULL", F.concat(F.lit(" "), F.lower("type"))))
    df = df.withColumn("name", F.when(F.col("name") != "Row Count", F.lit("  ")).otherwise(F.col("name")))
    return C.classify_breaks(df).select("dataset", "runId", "key", "seq", "seq2", "value", "break_type", "is_row_count", "item")


def _reference(t):
    return t.fx_bu.filter("business_unit LIKE '% - cde'").select("dataset")


@query("f12_clean_adaptive", 'SELECT dataset, "runId", key, value, CASE WHEN type = \'NULL\' THEN NULL ELSE score END AS score FROM fx_break')
def clean_adaptive(t):
    odd = F.when(F.col("type") == "NULL", F.lit(float("-inf"))).otherwise(F.col("score"))
    df = t.fx_find.withColumns({"status": F.upper("status"), "score": odd, "value": F.col("value").cast("string")})
    return C.clean_adaptive(df, _reference(t)).select("dataset", "runId", "key", "value", "score")


STABLE_SQL = f"""
    SELECT parent_summary AS dataset_norm, title AS stable_title FROM (SELECT *, row_number() OVER (PARTITION BY parent_summary ORDER BY date_updated DESC, ord) AS rn
      FROM fx_ticket WHERE issue_type = 'Sub-task' AND status IN {ACTIVE} AND labels = 'Adaptive, dq') s WHERE rn = 1"""


@query("f13_stable_titles", STABLE_SQL)
def stable_titles(t):
    return T.stable_titles(t.fx_ticket, "ord")


SUGGEST_SQL = """
    WITH items AS (SELECT dataset, "runId", name, score, row_number() OVER (PARTITION BY dataset, "runId" ORDER BY score DESC, seq, seq2, key, value) AS rn FROM
                     (SELECT *, row_number() OVER (PARTITION BY dataset, "runId", name ORDER BY score DESC, seq, seq2, key, value) AS rk FROM fx_break WHERE NOT is_row_count) q WHERE rk = 1),
    columns AS (SELECT dataset, "runId", string_agg(name, ', ' ORDER BY rn) AS names FROM items WHERE rn <= 2 GROUP BY 1, 2),
    counted AS (SELECT dataset, "runId", CASE WHEN value <> mean THEN CASE WHEN value > mean THEN 'Increased' ELSE 'Dropped' END
                    WHEN "perChange" <> 0 THEN CASE WHEN "perChange" > 0 THEN 'Increased' ELSE 'Dropped' END ELSE 'Changed' END AS suffix
                FROM (SELECT *, row_number() OVER (PARTITION BY dataset, "runId" ORDER BY score DESC, seq, seq2, key, value) AS rk FROM fx_break WHERE is_row_count) q WHERE rk = 1)
    SELECT b.dataset, b."runId", concat(coalesce(c.names, 'Row Count'), ': ', coalesce('Row Count ' || x.suffix, 'Profile Change')) AS suggested_title
    FROM (SELECT DISTINCT dataset, "runId" FROM fx_break) b LEFT JOIN columns c ON b.dataset = c.dataset AND b."runId" = c."runId"
    LEFT JOIN counted x ON b.dataset = x.dataset AND b."runId" = x."runId\""""


def _breaks(t):
    return C.classify_breaks(C.clean_adaptive(t.fx_find, _reference(t)))


@query("f14_suggest_titles", SUGGEST_SQL)
def suggest_titles(t):
    return C.suggest_titles(_breaks(t), ["dataset", "runId"], TIE)


def _sql_int(c):
    return f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"


LINES_SQL = f"""
    SELECT dataset, "runId", concat('*Adaptive profile changes detected in this run:*', chr(10), chr(10), string_agg(concat('- *', name, '* — *', type, '*', chr(10),
        '  - Anomaly: ', "verbose", chr(10), '  - Past (mean): ', {_sql_int("mean")}, ' | Current (value): ', {_sql_int("value")}, ' | Z-score: 2.5', chr(10),
        '  - Bands: [NA, NA] | % change: ', printf('%.2f', "perChange"), '% | Score impact: ', printf('%.2f', score), '%'), chr(10) || chr(10) ORDER BY score DESC, seq, seq2, key, value)) AS breaks_text
    FROM fx_break GROUP BY dataset, "runId\""""


@query("f15_render_breaks", LINES_SQL)
def render_breaks(t):
    return C.render_breaks(_breaks(t), ["dataset", "runId"], TIE)


@query("f15_break_parts", f"""
    SELECT dataset, "runId", CAST(floor(rn / 2) AS INTEGER) AS part, string_agg(concat('- *', name, '* — *', type, '*', chr(10),
        '  - Anomaly: ', "verbose", chr(10), '  - Past (mean): ', {_sql_int("mean")}, ' | Current (value): ', {_sql_int("value")}, ' | Z-score: 2.5', chr(10),
        '  - Bands: [NA, NA] | % change: ', printf('%.2f', "perChange"), '% | Score impact: ', printf('%.2f', score), '%'), chr(10) || chr(10) ORDER BY rn) AS text
    FROM (SELECT *, row_number() OVER (PARTITION BY dataset, "runId" ORDER BY score DESC, seq, seq2, key, value) - 1 AS rn FROM fx_break) q GROUP BY 1, 2, 3""")
def break_parts(t):
    """All break lists, two breaks a part."""
    return C.break_parts(_breaks(t), ["dataset", "runId"], TIE, part_lines=2)


ADAPTIVE_SQL = f"""
    WITH filled AS (SELECT *, last_value(row_cnt IGNORE NULLS) OVER (PARTITION BY dataset ORDER BY run_date, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM fx_hist7),
    changed AS (SELECT *, CASE WHEN lag(f) OVER w = 0 THEN NULL ELSE (CAST(f AS DOUBLE) / CAST(lag(f) OVER w AS DOUBLE) - 1) * 100.0 END AS pct FROM filled WINDOW w AS (PARTITION BY dataset ORDER BY run_date, run_id)),
    texts AS (SELECT dataset, concat('*Row count history (last 7 runs)*', chr(10), chr(10), '| runDate | rows | % change vs prev | behaviorScore | DQScore |', chr(10), '|---|---:|---:|---:|---:|', chr(10),
        string_agg(concat('| ', strftime(run_date + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S'), ' SGT | ', coalesce(CAST(row_cnt AS VARCHAR), 'NA'), ' | ', coalesce(printf('%.2f', pct) || '%', 'NA'), ' | ',
            CAST("behaviorScore" AS VARCHAR), ' | ', CAST("DQScore" AS VARCHAR), ' |'), chr(10) ORDER BY run_date DESC, run_id DESC)) AS history_text FROM changed GROUP BY dataset),
    runs AS (SELECT dataset, "runId", max(run_id) AS at_id, max(run_date) AS at_date, CAST(sum(CAST(score AS DECIMAL(28,6))) AS DOUBLE) AS score, bool_or(is_row_count) AS counted, max(db_nm) AS db_nm, max(table_nm) AS table_nm, max("Project") AS project
             FROM fx_break GROUP BY 1, 2),
    ranked AS (SELECT a.dataset, a.at_id, a.at_date, c.row_cnt, c.pct, c.run_date, c.run_id, bool_or(c.run_date = a.at_date) OVER (PARTITION BY a.dataset, a.at_id) AS matched
               FROM (SELECT * FROM runs WHERE NOT counted) a JOIN changed c ON a.dataset = c.dataset),
    cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY at_id ORDER BY CASE WHEN matched AND run_date <> at_date THEN 1 ELSE 0 END, run_date DESC, run_id DESC) AS rn FROM ranked) s WHERE rn = 1),
    prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY at_id ORDER BY run_date DESC, run_id DESC) AS rn FROM ranked WHERE NOT matched OR run_date < at_date) s),
    counts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, "runId" ORDER BY seq, seq2, key, value) AS rk FROM fx_break WHERE is_row_count) q WHERE rk = 1),
    suggested AS (SELECT * FROM (@SUGGEST@) q), stable AS ({STABLE_SQL}), lines AS ({LINES_SQL})
    SELECT r.dataset, r.db_nm || '.' || r.table_nm AS table_name, r."runId", r.project AS business_unit, coalesce(st.stable_title, sg.suggested_title) AS suggested_title,
           CASE WHEN r.score >= 20 THEN 'Critical' WHEN r.score >= 10 THEN 'High' ELSE 'Medium' END AS suggested_priority, 'dq|adaptive|profile-change|end-users' AS suggested_labels, r.score,
           CASE WHEN r.counted THEN x.value ELSE CAST(cur.row_cnt AS DOUBLE) END AS rows_current, CASE WHEN r.counted THEN x.mean ELSE CAST(prev.row_cnt AS DOUBLE) END AS rows_prev,
           CASE WHEN r.counted THEN x."perChange" ELSE cur.pct END AS rows_pct_change_vs_prev,
           concat('*Dataset:* ', r.dataset, chr(10), '*DataTable:* ', coalesce(r.db_nm || '.' || r.table_nm, ''), chr(10), '*RunId (runDate):* ', r."runId", chr(10), '*Project:* ', r.project, chr(10),
             '*Total adaptive score impact:* ', printf('%.2f', r.score), '%', chr(10), CASE WHEN r.counted THEN '' ELSE chr(10) || t.history_text || chr(10) END, chr(10), l.breaks_text) AS jira_description
    FROM runs r JOIN suggested sg ON sg.dataset = r.dataset AND sg."runId" = r."runId" JOIN lines l ON l.dataset = r.dataset AND l."runId" = r."runId"
    LEFT JOIN stable st ON st.dataset_norm = r.dataset LEFT JOIN counts x ON x.dataset = r.dataset AND x."runId" = r."runId"
    LEFT JOIN cur ON cur.at_id = r.at_id LEFT JOIN prev ON prev.at_id = r.at_id AND prev.rn = CASE WHEN cur.matched THEN 1 ELSE 2 END LEFT JOIN texts t ON t.dataset = r.dataset"""


def _adaptive(t):
    return C.adaptive_candidates(t.fx_find, t.fx_ticket.withColumn("key", F.format_string("%012d", "ord")), t.fx_hist, _reference(t), TIE, *ZONE)


@query("f18_adaptive_candidates", ADAPTIVE_SQL.replace("@SUGGEST@", SUGGEST_SQL.strip()))
def adaptive_candidates(t):
    return _adaptive(t).withColumn("suggested_labels", F.array_join("suggested_labels", "|"))


def _records(t):
    """Two records per observation: an odd one and a usual one."""
    odd = F.create_map(F.lit("qty"), F.col("owlRank").cast("string"), F.lit("occurs"), F.lit("2"), F.lit("flag"), F.substring("obs", -2, 2))
    usual = F.create_map(F.lit("qty"), F.lit("0"), F.lit("occurs"), F.lit("2"), F.lit("line"), F.col("line").cast("string"))
    pairs = F.posexplode(F.array(odd, usual)).alias("at", "record")
    df = t.fx_obs.select("dataset", "runId", "obsKey", pairs)
    return df.withColumn("ord", F.concat("obsKey", F.lit("#"), F.col("at").cast("string"))).drop("at")


_SCHEDULED = "fx_obs WHERE \"jobSchedule\" = 'TRUE'"
_HEAD = """'*Dataset:* ', h.dataset, chr(10), '*DataTable:* ', chr(10), '*RunId (runDate):* ', h."runId", chr(10), '*Total {label} score impact:* ', printf('%.2f', h.score), '%', chr(10)"""


@query("f19_pattern_candidates", f"""
    WITH p AS (SELECT *, substr(obs, 10) AS pattern FROM {_SCHEDULED} AND line <> 7),
    h AS (SELECT dataset, "runId", pattern, CAST(sum(CAST("obsScore" AS DECIMAL(28,6))) AS DOUBLE) AS score FROM p GROUP BY 1, 2, 3),
    s AS (SELECT dataset, "runId", pattern, string_agg(concat(chr(10), '| PatternCount | qty | occurs | flag |', chr(10), '| ', CAST("owlRank" AS VARCHAR), ' | ', CAST("owlRank" AS VARCHAR), ' | 2 | ', substr(obs, 10), ' |', chr(10),
            '| Majority Pattern | 0 | 2 | ', CAST(line AS VARCHAR), ' |'), chr(10) ORDER BY "obsKey") AS samples FROM p GROUP BY 1, 2, 3)
    SELECT h.dataset, CAST(NULL AS VARCHAR) AS table_name, h."runId", CAST(NULL AS VARCHAR) AS business_unit, concat('Anti-Pattern: ', h.pattern) AS suggested_title,
           CASE WHEN h.score >= 20 THEN 'Critical' WHEN h.score >= 10 THEN 'High' ELSE 'Medium' END AS suggested_priority, 'dq|pattern|end-users' AS suggested_labels, CAST(round(h.score, 6) AS DOUBLE) AS score,
           concat({_HEAD.format(label="pattern")}, chr(10), '*Pattern: ', h.pattern, '*', coalesce(chr(10) || s.samples, '')) AS jira_description
    FROM h LEFT JOIN s ON h.dataset = s.dataset AND h."runId" = s."runId" AND h.pattern = s.pattern""")
def pattern_candidates(t):
    df = C.pattern_candidates(t.fx_obs, _records(t), ["obsKey"])
    return df.withColumns({"suggested_labels": F.array_join("suggested_labels", "|"), "score": F.round("score", 6)})


_ODD = """concat(chr(10), '| PatternCount | qty | occurs | flag |', chr(10), '| ', CAST("owlRank" AS VARCHAR), ' | ', CAST("owlRank" AS VARCHAR), ' | 2 | ', substr(obs, 10), ' |')"""


@query("f19_pattern_parts", f"""
    WITH p AS (SELECT *, substr(obs, 10) AS pattern FROM {_SCHEDULED} AND line <> 7),
    l AS (SELECT dataset, "runId", pattern, "obsKey", 0 AS place, {_ODD} AS line FROM p
          UNION ALL SELECT dataset, "runId", pattern, "obsKey", 1, concat('| Majority Pattern | 0 | 2 | ', CAST(line AS VARCHAR), ' |') FROM p),
    n AS (SELECT *, row_number() OVER (PARTITION BY dataset, "runId", pattern ORDER BY "obsKey", place) AS rn FROM l)
    SELECT dataset, "runId", pattern, CAST((rn - 1) // 3 AS INTEGER) AS part, string_agg(line, chr(10) ORDER BY rn) AS text FROM n GROUP BY 1, 2, 3, 4""")
def pattern_parts(t):
    """All sample tables, three lines a part."""
    return C.pattern_parts(t.fx_obs, _records(t), ["obsKey"], part_lines=3)


@query("f20_duplicate_parts", f"""
    WITH p AS (SELECT * FROM {_SCHEDULED}),
    r AS (SELECT dataset, "runId", concat('| ', CAST("owlRank" AS VARCHAR), ' | ', substr(obs, length(obs) - 1), ' | nan | 2 |') AS line, "obsKey" || '#0' AS ord FROM p WHERE "runId" <> '1995'
          UNION ALL SELECT dataset, "runId", concat('| 0 | nan | ', CAST(line AS VARCHAR), ' | 2 |'), "obsKey" || '#1' FROM p WHERE "runId" <> '1995'),
    d AS (SELECT dataset, "runId", line, min(ord) AS ord FROM r GROUP BY 1, 2, 3),
    n AS (SELECT dataset, "runId", 'samples' AS kind, line, row_number() OVER (PARTITION BY dataset, "runId" ORDER BY ord, line) AS rn FROM d
          UNION ALL SELECT dataset, "runId", 'unseen', "obsKey", row_number() OVER (PARTITION BY dataset, "runId" ORDER BY "obsKey") FROM p WHERE "runId" = '1995')
    SELECT dataset, "runId", kind, CAST((rn - 1) // 4 AS INTEGER) AS part, CASE kind WHEN 'samples' THEN string_agg(line, chr(10) ORDER BY rn) ELSE string_agg(line, ', ' ORDER BY rn) END AS text FROM n GROUP BY 1, 2, 3, 4""")
def duplicate_parts(t):
    """All sample records, four a part, and all keys of the runs that have no record here."""
    return C.duplicate_parts(t.fx_obs, _records(t).filter("runId <> '1995'"), ["obsKey"], part_lines=4)


@query("f20_duplicate_candidates", f"""
    WITH p AS (SELECT * FROM {_SCHEDULED}),
    h AS (SELECT dataset, "runId", CAST(sum("owlRank") AS DOUBLE) AS score, string_agg("obsKey", ', ' ORDER BY "obsKey") AS keys FROM p GROUP BY 1, 2),
    r AS (SELECT dataset, "runId", concat('| ', CAST("owlRank" AS VARCHAR), ' | ', substr(obs, length(obs) - 1), ' | nan | 2 |') AS line, "obsKey" || '#0' AS ord FROM p
          UNION ALL SELECT dataset, "runId", concat('| 0 | nan | ', CAST(line AS VARCHAR), ' | 2 |'), "obsKey" || '#1' FROM p),
    d AS (SELECT dataset, "runId", line, min(ord) AS ord FROM r GROUP BY 1, 2, 3),
    s AS (SELECT dataset, "runId", string_agg(line, chr(10) ORDER BY ord) AS samples FROM d GROUP BY 1, 2)
    SELECT h.dataset, CAST(NULL AS VARCHAR) AS table_name, h."runId", CAST(NULL AS VARCHAR) AS business_unit,
           concat('Dupes: ', CASE WHEN s.samples IS NOT NULL THEN 'qty,flag,line' WHEN h.dataset LIKE '%3' THEN 'k1,k2' ELSE '' END) AS suggested_title,
           CASE WHEN h.score >= 20 THEN 'Critical' WHEN h.score >= 10 THEN 'High' ELSE 'Medium' END AS suggested_priority, 'dq|dupes|end-users' AS suggested_labels, h.score,
           concat({_HEAD.format(label="dupes")}, chr(10), '*Dupes Records:*', chr(10), CASE WHEN s.samples IS NOT NULL THEN concat(chr(10), '| qty | flag | line | occurs |', chr(10), s.samples)
             ELSE concat('No details found for obs keys: ', h.keys) END) AS jira_description
    FROM h LEFT JOIN s ON h.dataset = s.dataset AND h."runId" = s."runId\"""")
def duplicate_candidates(t):
    include = t.fx_obs.select("dataset").distinct().filter("dataset LIKE '%3'").withColumn("columns", F.array(F.lit("k1"), F.lit("k2")))
    return C.duplicate_candidates(t.fx_obs, _records(t), include, ["obsKey"]).withColumn("suggested_labels", F.array_join("suggested_labels", "|"))


@query("g01_union_candidates", """
    SELECT dataset, "runId", score, perc, CAST(NULL AS VARCHAR) AS pattern, 'custom' AS ticket_source FROM fx_cand
    UNION ALL SELECT dataset, "runId", score, NULL, NULL, 'adaptive' FROM fx_find
    UNION ALL SELECT dataset, "runId", "obsScore", NULL, obs, 'pattern' FROM fx_obs""")
def union_candidates(t):
    return P.union_candidates({
        "custom": t.fx_cand.select("dataset", "runId", "score", "perc"),
        "adaptive": t.fx_find.select("dataset", "runId", "score"),
        "pattern": t.fx_obs.select("dataset", "runId", F.col("obsScore").alias("score"), F.col("obs").alias("pattern")),
    })


@query("g02_above_threshold", """
    SELECT c.dataset, c."runId", c."ruleNm", c.seq, c.score, coalesce(x.threshold, 5.0) AS jira_dq_threshold FROM fx_cand c LEFT JOIN fx_limit x ON c.dataset = x.dataset
    WHERE c.score > coalesce(x.threshold, 5.0)""")
def above_threshold(t):
    df = P.above_threshold(t.fx_cand.withColumn("score", F.col("score").cast("string")), t.fx_limit, 5.0)
    return df.select("dataset", "runId", "ruleNm", "seq", "score", "jira_dq_threshold")


ROUTES = {
    "component": [(("HOUSE", "HOLD"), "Home"), (("MACH",), "Tools"), (("FURNI",), "Home")],
    "assignee": [(("CDE",), "alpha"), (("BUILD",), "beta"), (("UNIT VAL",), "gamma")],
}
ROUTED_SQL = """
    SELECT dataset, "runId", seq, unit, upper(CASE WHEN strpos(unit, ' - ') > 0 THEN substr(unit, 1, strpos(unit, ' - ') - 1) ELSE unit END) AS unit_region,
           CASE WHEN cap LIKE '%HOUSE%' THEN 'Home' WHEN cap LIKE '%MACH%' THEN 'Tools' WHEN cap LIKE '%FURNI%' THEN 'Home' ELSE 'Other' END AS component,
           CASE WHEN cap LIKE '%CDE%' THEN 'alpha' WHEN cap LIKE '%BUILD%' THEN 'beta' WHEN cap LIKE '%UNIT VAL%' THEN 'gamma' END AS assignee
    FROM (SELECT *, upper(CASE WHEN strpos(unit, ' - ') > 0 THEN substr(unit, strpos(unit, ' - ') + 3) ELSE unit END) AS cap FROM
      (SELECT c.dataset, c."runId", c.seq, coalesce(b.business_unit, c.business_unit) AS unit FROM fx_cand c LEFT JOIN (SELECT * FROM fx_bu WHERE region <> 'region_0' AND region <> 'africa') b ON b.dataset = c.dataset) u) v"""


def _routed(t):
    mapping = t.fx_bu.filter("region <> 'region_0' AND region <> 'africa'")
    df = P.route_units(t.fx_cand, mapping, ROUTES, {"component": "Other"}, ["ord"])
    return df.select("dataset", "runId", "seq", "unit", "unit_region", "component", "assignee")


@query("g03_route_units", ROUTED_SQL)
def route_units(t):
    return _routed(t)


@query("g04_exclude_routed", f"SELECT * FROM ({ROUTED_SQL}) q WHERE component <> 'Home'")
def exclude_routed(t):
    return P.exclude_routed(_routed(t), ["Home"])


@query("g05_plan_ticket_actions", f"""
    WITH sub AS (SELECT *, status IN {ACTIVE} AS is_open, CASE labels WHEN 'Adaptive, dq' THEN 'adaptive' WHEN '["dq", "dupes"]' THEN 'dupes' ELSE labels END AS label FROM fx_ticket WHERE issue_type = 'Sub-task'),
    by_label AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent_key, label ORDER BY date_updated DESC, ord) AS rn FROM sub WHERE is_open) a WHERE rn = 1),
    by_title AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent_key, title ORDER BY date_created DESC, ord) AS rn FROM sub) a WHERE rn = 1),
    j AS (SELECT c.*, p.key AS parent_key, l.key AS label_key, l.title AS label_title, x.key AS title_key, x.is_open AS title_open FROM fx_cand c
          LEFT JOIN fx_ticket p ON p.issue_type = 'Task' AND p.title = c.dataset LEFT JOIN by_label l ON l.parent_key = p.key AND l.label = c.ticket_source
          LEFT JOIN by_title x ON x.parent_key = p.key AND x.title = c.suggested_title)
    SELECT dataset, "runId", seq, ticket_source, parent_key, CASE WHEN ticket_source = 'custom' THEN title_key ELSE label_key END AS existing_key,
           CASE WHEN ticket_source = 'custom' THEN suggested_title ELSE coalesce(label_title, suggested_title) END AS title,
           CASE WHEN ticket_source = 'custom' THEN CASE WHEN title_key IS NULL THEN 'create' WHEN title_open THEN 'update-description' ELSE 'reopen-comment' END
                WHEN label_key IS NULL THEN 'create' WHEN ticket_source = 'adaptive' THEN 'comment' ELSE 'update-description' END AS action,
           CASE WHEN ticket_source = 'custom' THEN CASE WHEN title_key IS NULL THEN 'New' WHEN title_open THEN 'Old' ELSE 'Reopened' END
                WHEN label_key IS NULL THEN 'New' ELSE 'Old' END AS "SUBTASK_STATUS" FROM j""")
def plan_ticket_actions(t):
    df = T.plan_ticket_actions(t.fx_cand, t.fx_ticket, tie="ord")
    return df.select("dataset", "runId", "seq", "ticket_source", "parent_key", "existing_key", "title", "action", "SUBTASK_STATUS")


def _sample_input(t):
    record = F.create_map(
        F.lit("dataset"), F.lit("x"), F.lit("order"), F.col("l_orderkey").cast("string"), F.lit("line"), F.col("l_linenumber").cast("string"),
        F.lit("flag"), F.concat("l_returnflag", F.lit("|"), "l_linestatus"), F.lit("part"), F.col("l_partkey").cast("string"), F.lit("long"), F.repeat("l_returnflag", 90),
    )
    return t.lineitem.withColumn("record", record).withColumn("broken", F.lit("flag"))


@query("g06_sample_records", """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem)
    SELECT l_suppkey, concat('*Break column(s):* flag', chr(10), '| # | flag | order | line | part | long |', chr(10), '|---|---|---|---|---|---|', chr(10),
      string_agg(concat('| ', CAST(n AS VARCHAR), ' | ', l_returnflag, chr(92), '|', l_linestatus, ' | ', CAST(l_orderkey AS VARCHAR), ' | ', CAST(l_linenumber AS VARCHAR), ' | ', CAST(l_partkey AS VARCHAR), ' | ',
        repeat(l_returnflag, 77), '... |'), chr(10) ORDER BY n)) AS sample FROM s WHERE n <= 6 GROUP BY l_suppkey""")
def sample_records(t):
    return P.sample_records(_sample_input(t), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], max_rows=6, break_columns="broken", max_cols=10, max_cell_len=80)


@query("g06_sample_bullets", """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem)
    SELECT l_suppkey, string_agg(concat('- *#', CAST(n AS VARCHAR), '*', chr(10), '  - *linkId*: None', chr(10), '  - *order*: ', CAST(l_orderkey AS VARCHAR), chr(10), '  - *line*: ', CAST(l_linenumber AS VARCHAR)), chr(10) ORDER BY n) AS sample
    FROM s WHERE n <= 6 GROUP BY l_suppkey""")
def sample_bullets(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    return P.sample_records(_sample_input(t), ["l_suppkey"], order, max_rows=6, max_cols=2, output="bullets")


@query("g07_break_summary", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'A' THEN '_No breaking records._' WHEN l_returnflag = 'N' THEN concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), ' (-)')
           ELSE concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), ' (', printf('%.4f', l_discount), '%)') END AS summary FROM lineitem""")
def break_summary(t):
    count = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    share = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.break_summary(count, share).alias("summary"))


IDENTITY_SQL = """
    SELECT r.dataset, r.run_id, CASE WHEN a.dataset IS NULL THEN 'File' WHEN a.db_nm IS NOT NULL THEN 'Table' ELSE 'File' END AS table_kind,
           CASE WHEN a.db_nm IS NOT NULL THEN a.table_nm ELSE concat(r.dataset, '.csv') END AS table_label,
           CASE WHEN a.db_nm IS NOT NULL THEN a.db_nm ELSE 'link' END AS table_db, CASE WHEN a.dataset IS NOT NULL THEN 'host' END AS table_host,
           CASE WHEN a.db_nm IS NULL THEN concat('/in/', r.dataset, '.csv') END AS table_path
    FROM fx_run r LEFT JOIN (SELECT * FROM fx_attr WHERE "jobSchedule") a ON r.dataset = a.dataset"""


def _identity(t, df):
    reports = t.fx_attr.filter("jobSchedule").select("dataset", "db_nm", F.when(F.col("db_nm").isNotNull(), F.col("table_nm")).alias("table_nm"), F.lit("host").alias("host"), "ord")
    sources = t.fx_bu.select("dataset", F.concat(F.lit("/in/"), "dataset", F.lit(".csv")).alias("filePath"), F.lit("link").alias("connectionName"))
    return P.table_identity(df, reports, sources, ["ord"])


@query("g08_table_identity", IDENTITY_SQL)
def table_identity(t):
    return _identity(t, t.fx_run.select("dataset", "run_id"))


@query("g09_render_description", f"""
    WITH i AS ({IDENTITY_SQL}),
    s AS (SELECT dataset, run_id, count(*) AS n FROM fx_rule WHERE break_msg = 'BREAKING' GROUP BY 1, 2)
    SELECT c.dataset, c."runId", c."ruleNm", c.seq, c.seq2, concat('h3. Description', chr(10), chr(10), '*Dataset:* ', c.dataset, chr(10), '*Run ID:* ', c."runId", chr(10), '*Rule Name:* ', c."ruleNm", chr(10),
      '*Penalty Score:* ', printf('%.1f', c.score), chr(10), '*Perc:* ', CAST(c.perc AS VARCHAR), '%', chr(10), '*Dimension:* ', c."dimName", chr(10), chr(10), '---', chr(10), chr(10),
      'h3. Table / View / File', chr(10), chr(10), '- *Type*: ', i.table_kind, chr(10),
      CASE WHEN i.table_kind = 'File' THEN concat('- *Path*: `', i.table_path, '`') ELSE concat('- *DB*: `', i.table_db, '`', chr(10), '- *Object*: `', i.table_label, '`', chr(10), '- *Host*: `host`') END, chr(10), chr(10),
      'h3. Invalid Sample Data', chr(10), chr(10), CASE WHEN c.score > 25 THEN concat('sample of ', c.dataset) ELSE '_No sample breaking records returned._' END, chr(10), chr(10),
      'h3. Breaking Records', chr(10), chr(10), CAST(s.n AS VARCHAR), ' (', printf('%.4f', c.perc), '%)', chr(10), chr(10),
      'h3. Investigation', chr(10), chr(10), '_Owner to add investigation notes here_', chr(10), chr(10),
      'h3. Expected Outcome / Solution', chr(10), chr(10), '_Owner to propose fix / logic change / data correction_', chr(10), chr(10),
      'h3. Status / Next Steps', chr(10), chr(10), 'None', chr(10), chr(10), 'h3. Links', chr(10), chr(10), '- *Dataset*: /finding?dataset=', c.dataset, chr(10), chr(10), 'h3. Comments', chr(10), chr(10), 'None') AS jira_description
    FROM fx_cand c JOIN i ON c.dataset = i.dataset AND c."runId" = concat('r', CAST(i.run_id AS VARCHAR)) JOIN s ON s.dataset = i.dataset AND s.run_id = i.run_id""")
def render_description(t):
    counts = t.fx_rule.filter("break_msg = 'BREAKING'").groupBy("dataset", F.concat(F.lit("r"), F.col("run_id").cast("string")).alias("runId")).agg(F.count("*").alias("violation_count"))
    cands = _identity(t, t.fx_cand.withColumn("ruleValue", F.lit(""))).join(counts, ["dataset", "runId"])
    samples = t.fx_cand.filter("score > 25").select("dataset", "runId", "ruleNm", "score", F.concat(F.lit("sample of "), "dataset").alias("sample")).distinct()
    df = P.render_description(cands, samples, ["dataset", "runId", "ruleNm", "score"], "/finding?dataset=")
    return df.select("dataset", "runId", "ruleNm", "seq", "seq2", "jira_description")
