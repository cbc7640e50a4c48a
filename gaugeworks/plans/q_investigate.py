"""Break investigation, alerts and notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as K
from ..functions import text as X
from ..operators import history as H
from ..operators import investigate as V
from ..operators import notify as N
from ..operators import tickets as T
from ..session import materialize, scratch_path
from ..sources.readers import Source
from .fixtures import add_views
from .q_report import CHANGE_SQL
from .registry import query

NOTE_TAG = "[AUTO_INVALIDATE]"

add_views({
    "fx_seen": """
        SELECT f.dataset, CAST(f.run_date AS STRING) AS run_text, f.run_id, f.run_date, concat('r', CAST(f.run_id AS STRING)) AS runId, f.name, f.type, f.key, f.key AS break_key, f.status,
               f.value, f.mean, f.zscore, f.score, f.perChange, f.seq, f.seq2, upper(f.type) AS break_type, f.type = 'ROW_COUNT' AS is_row_count,
               CASE f.name WHEN 'col_5' THEN 'none' WHEN 'col_6' THEN '{"id": 6}' WHEN 'col_4' THEN '{"id": 4, "uuid": "u4"}'
                    ELSE concat('{''id'': ', CAST(f.run_id AS STRING), ', ''uuid'': ''u', CAST(f.seq AS STRING), '''}') END AS assignmentId
        FROM fx_find f""",
    "fx_raised": """
        SELECT concat('T-', CAST(doc_id % 97 AS STRING)) AS issue_key, concat('col_', CAST(n_chars % 7 AS STRING), '__', upper(lang)) AS break_key, doc_id, source FROM documents""",
    "fx_note": """
        SELECT t.parent_summary AS dataset, concat('r', CAST(t.ord AS STRING)) AS runId, t.ord, t.key AS issue_key, concat('Title ', t.status) AS suggested_title,
               CASE WHEN t.parent_summary LIKE '%5' THEN 'high_score_ticket' ELSE 'invalidated_break' END AS notification_type,
               CASE WHEN t.status = 'Open' THEN 'b__NULL | a__MIN |' ELSE CAST(NULL AS STRING) END AS detected_breaks,
               CASE WHEN t.status <> 'Open' THEN concat('col_', CAST(t.ord % 7 AS STRING), '__NULL') END AS break_key, t.status = 'Closed' AS should_close
        FROM fx_ticket t WHERE t.issue_type = 'Sub-task'""",
    "fx_owner": """
        SELECT t.key, t.ord, CASE WHEN t.labels = 'pattern' THEN 'Special' ELSE 'Plain' END AS project,
               CASE t.ord % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'not an address' WHEN 2 THEN concat('u', CAST(t.ord AS STRING), '@else.org')
                    ELSE concat(' u', CAST(t.ord % 50 AS STRING), '@Example.com ') END AS assignee_email,
               concat('rep', CAST(t.ord % 40 AS STRING), '@example.com') AS reporter_email
        FROM fx_ticket t WHERE t.issue_type = 'Sub-task'""",
})

NEWEST3 = "SELECT dataset, run_id, run_date FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) s WHERE rn <= 3"
HIT_SQL = f"SELECT DISTINCT n.dataset, n.run_id, n.run_date, f.key AS break_key FROM ({NEWEST3}) n JOIN fx_seen f ON f.dataset = n.dataset AND f.run_id = n.run_id AND f.status = 'Breaking'"


@query("h01_parse_assignment", """
    SELECT dataset, run_id, key, seq, CASE WHEN name = 'col_4' THEN 4 ELSE run_id END AS assignment_id, CASE WHEN name = 'col_4' THEN 'u4' ELSE concat('u', CAST(seq AS VARCHAR)) END AS assignment_uuid
    FROM fx_seen WHERE name NOT IN ('col_5', 'col_6')""")
def parse_assignment(t):
    return V.parse_assignment(t.fx_seen, "assignmentId").select("dataset", "run_id", "key", "seq", "assignment_id", "assignment_uuid")


@query("h02_run_key", """
    SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d') WHEN 'error' THEN strftime(ts, '%Y-%m-%d') WHEN 'click' THEN 'batch numb' END AS run_key FROM events""")
def run_key(t):
    text = F.expr("CASE event_type WHEN 'view' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 'error' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 'click' THEN 'batch number 9' ELSE ' ' END")
    return t.events.select("event_id", K.run_key(text).alias("run_key"))


def _checked(t) -> tuple[DataFrame, DataFrame]:
    runs = H.newest_runs(t.fx_run, 3, "dataset", "run_date", "run_id").select("dataset", "run_id", "run_date")
    return runs, V.breaking_keys(t.fx_seen, "run_id")


@query("h05_breaking_keys", "SELECT DISTINCT dataset, run_id, key FROM fx_seen WHERE status = 'Breaking'")
def breaking_keys(t):
    return V.breaking_keys(t.fx_seen, "run_id")


PERSIST_SQL = f"""
    SELECT b.dataset, b.run_id, b.break_key, b.seq, b.seq2, coalesce(h.n, 0) AS persist_cnt, coalesce(h.n, 0) >= 3 AS persist_ok, coalesce(h.runs, '') AS persist_runs, coalesce(c.runs, '') AS checked_runs
    FROM (SELECT * FROM fx_seen WHERE status = 'Breaking') b
    LEFT JOIN (SELECT dataset, break_key, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(run_id AS VARCHAR), ', ' ORDER BY run_date DESC, run_id DESC) AS runs FROM ({HIT_SQL}) x GROUP BY 1, 2) h
      ON h.dataset = b.dataset AND h.break_key = b.break_key
    LEFT JOIN (SELECT dataset, string_agg(CAST(run_id AS VARCHAR), ', ' ORDER BY run_date DESC, run_id DESC) AS runs FROM ({NEWEST3}) y GROUP BY 1) c ON c.dataset = b.dataset"""


def _persisted(t) -> DataFrame:
    runs, keys = _checked(t)
    return V.persistence(t.fx_seen.filter("status = 'Breaking'"), runs, keys, "run_id", [F.desc("run_date"), F.desc("run_id")])


@query("h06_persistence", PERSIST_SQL)
def persistence(t):
    return _persisted(t).select("dataset", "run_id", "break_key", "seq", "seq2", "persist_cnt", "persist_ok", "persist_runs", "checked_runs")


@query("h07_any_in_group", """
    SELECT b.dataset, b.run_id, b.key, b.seq, b.seq2, bool_or(is_row_count) OVER (PARTITION BY dataset, run_id) AS has_row_count_break FROM fx_seen b WHERE status = 'Breaking'""")
def any_in_group(t):
    df = V.any_in_group(t.fx_seen.filter("status = 'Breaking'"), ["dataset", "run_id"], "is_row_count", "has_row_count_break")
    return df.select("dataset", "run_id", "key", "seq", "seq2", "has_row_count_break")


ROWCHANGE_SQL = f"""
    SELECT b.dataset, b.run_id, b.key, b.seq, b.seq2, CASE WHEN c.dataset IS NOT NULL THEN c."perChange" ELSE h.row_pct_change END AS row_pct_change,
           CASE WHEN c.dataset IS NOT NULL THEN c.value ELSE CAST(h.row_cnt AS DOUBLE) END AS rows_current, CASE WHEN c.dataset IS NOT NULL THEN c.mean ELSE CAST(h.rows_prev AS DOUBLE) END AS rows_prev
    FROM fx_seen b LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_id, seq, seq2, value) AS rn FROM fx_seen WHERE status = 'Breaking' AND type = 'ROW_COUNT') q WHERE rn = 1) c ON c.dataset = b.dataset
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, run_key ORDER BY run_id DESC) AS rk FROM ({CHANGE_SQL}) z) y WHERE rk = 1) h ON h.dataset = b.dataset AND h.run_key = substr(CAST(CAST(b.run_date AS DATE) AS VARCHAR), 1, 10)
    WHERE b.status = 'Breaking'"""


def _row_history(t) -> DataFrame:
    changes = H.change_vs_previous(t.fx_run, V.PERSIST_RUNS + 1, "dataset", "run_date", "run_id", "row_cnt")
    from ..operators.relational import first_row

    return first_row(changes, ["dataset", "run_key"], [F.desc("run_id")])


@query("h08_row_change", ROWCHANGE_SQL)
def row_change(t):
    breaks = t.fx_seen.filter("status = 'Breaking'").withColumn("run_key", K.run_key("run_date"))
    return V.row_change(breaks, _row_history(t), ["run_id", "seq", "seq2", "value"]).select("dataset", "run_id", "key", "seq", "seq2", "row_pct_change", "rows_current", "rows_prev")


def investigated(t) -> DataFrame:
    """Breaks with assignments, persistence, row changes and the decision; the findings are read once."""
    seen = materialize(t.fx_seen.filter("status = 'Breaking'"), "breaks")
    breaks = V.parse_assignment(seen, "assignmentId").withColumn("run_key", K.run_key("run_date"))
    runs = H.newest_runs(t.fx_run, 3, "dataset", "run_date", "run_id").select("dataset", "run_id", "run_date")
    df = V.persistence(breaks, runs, seen.select("dataset", "run_id", "key"), "run_id", [F.desc("run_date"), F.desc("run_id")], most_runs=3)
    df = V.any_in_group(df, ["dataset", "runId"], "is_row_count", "has_row_count_break", breaks)
    return V.heuristics(V.row_change(df, _row_history(t), ["run_id", "seq", "seq2", "value"], breaks))


INVESTIGATED_SQL = f"""
    WITH b AS (SELECT * FROM fx_seen WHERE status = 'Breaking' AND name NOT IN ('col_5', 'col_6')),
    p AS (SELECT DISTINCT dataset, run_id, break_key, persist_cnt, persist_ok, persist_runs, checked_runs FROM ({PERSIST_SQL}) x),
    r AS (SELECT b.*, CASE WHEN c.dataset IS NOT NULL THEN c."perChange" ELSE h.row_pct_change END AS row_pct_change,
            CASE WHEN c.dataset IS NOT NULL THEN c.value ELSE CAST(h.row_cnt AS DOUBLE) END AS rows_current, CASE WHEN c.dataset IS NOT NULL THEN c.mean ELSE CAST(h.rows_prev AS DOUBLE) END AS rows_prev
          FROM b LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_id, seq, seq2, value) AS rn FROM b WHERE type = 'ROW_COUNT') q WHERE rn = 1) c ON c.dataset = b.dataset
          LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, run_key ORDER BY run_id DESC) AS rk FROM ({CHANGE_SQL}) z) y WHERE rk = 1) h ON h.dataset = b.dataset AND h.run_key = substr(CAST(CAST(b.run_date AS DATE) AS VARCHAR), 1, 10)),
    k AS (SELECT r.*, p.persist_cnt, p.persist_ok, p.persist_runs, p.checked_runs, bool_or(r.is_row_count) OVER (PARTITION BY r.dataset, r."runId") AS has_row_count_break,
            coalesce(abs(r.row_pct_change) < 20, FALSE) AS small FROM r JOIN p ON p.dataset = r.dataset AND p.run_id = r.run_id AND p.break_key = r.break_key),
    f AS (SELECT *, NOT has_row_count_break OR small AS row_ok FROM k),
    g AS (SELECT *, is_row_count AND small AS h_rc_small_change, break_type LIKE '%NULL%' AND "perChange" < 0 AND row_ok AS h_null_reduces,
            break_type IN ('MIN VALUE', 'MAX VALUE', 'CARDINALITY', 'DATA_TYPE', 'UNIQUE', 'UNIQUENESS') AND row_ok AS h_profile_with_row_ok FROM f),
    z AS (SELECT *, persist_ok AND (h_rc_small_change OR h_null_reduces OR h_profile_with_row_ok) AS to_invalidate FROM g)
    """
_FLAGS = ["row_ok", "h_rc_small_change", "h_null_reduces", "h_profile_with_row_ok", "to_invalidate"]


@query("h09_heuristics", INVESTIGATED_SQL + f"SELECT dataset, run_id, key, seq, seq2, {', '.join(_FLAGS)} FROM z")
def heuristics(t):
    return investigated(t).select("dataset", "run_id", "key", "seq", "seq2", *_FLAGS)


_NOTE = """concat('persist_cnt=', CAST(persist_cnt AS VARCHAR), '/3 across runs [', checked_runs, ']',
    CASE WHEN h_null_reduces THEN concat(' | NULL% reduced (perChange=', printf('%.2f', "perChange"), '%) and row_ok (±20%)') ELSE '' END,
    CASE WHEN h_profile_with_row_ok THEN concat(' | ', break_type, ' break but row_ok (±20%)') ELSE '' END,
    CASE WHEN h_rc_small_change THEN concat(' | ROW_COUNT change within ±20% (row_pct_change=', printf('%.2f', row_pct_change), '%)') ELSE '' END,
    ' | mean=', CAST(CAST(mean AS BIGINT) AS VARCHAR), ', value=', CAST(CAST(value AS BIGINT) AS VARCHAR), ', z=2.5')"""


@query("h10_annotation", INVESTIGATED_SQL + f"SELECT dataset, run_id, key, seq, seq2, {_NOTE} AS annotation FROM z")
def annotation(t):
    return V.annotate(investigated(t)).select("dataset", "run_id", "key", "seq", "seq2", "annotation")


@query("h11_invalidation_list", INVESTIGATED_SQL + f"""
    SELECT dataset, "runId", break_key, break_type, CASE WHEN name = 'col_4' THEN 4 ELSE run_id END AS assignment_id, CASE WHEN name = 'col_4' THEN 'u4' ELSE concat('u', CAST(seq AS VARCHAR)) END AS assignment_uuid,
           TRUE AS "includeKey", {_NOTE} AS annotation, persist_cnt, persist_runs, checked_runs, row_pct_change, rows_current, rows_prev FROM z WHERE to_invalidate""")
def invalidation_list(t):
    return V.invalidation_list(investigated(t))


@query("h12_pick_ticket", """
    WITH c AS (SELECT parent_summary AS dataset, CASE WHEN status = 'Closed' THEN 1 ELSE 0 END AS tier, date_updated AS at_date, key, lpad(CAST(ord AS VARCHAR), 12, '0') AS tie FROM fx_ticket WHERE issue_type = 'Sub-task'
      UNION ALL SELECT dataset, 2, NULL, concat('N-', dataset), concat('N-', dataset) FROM fx_bu WHERE business_unit LIKE '% - cde'),
    p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY tier, at_date DESC NULLS LAST, tie) AS rn FROM c) q WHERE rn = 1)
    SELECT b.dataset, p.key AS issue_key FROM fx_bu b LEFT JOIN p ON p.dataset = b.dataset""")
def pick_ticket(t):
    logged = t.fx_bu.filter("business_unit LIKE '% - cde'").select("dataset", F.concat(F.lit("N-"), "dataset").alias("SUBTASK"))
    tickets = t.fx_ticket.withColumn("tie", F.format_string("%012d", "ord"))
    return T.pick_ticket(t.fx_bu, tickets, logged, "tie")


@query("h13_breaks_in_text", """
    SELECT DISTINCT issue_key, 'raised' AS kind, concat('col ', CAST(doc_id % 5 AS VARCHAR), '__', upper(source)) AS break_key FROM fx_raised
    UNION ALL SELECT DISTINCT issue_key, 'raised', 'odd__TWO WORDS' FROM fx_raised
    UNION ALL SELECT DISTINCT issue_key, 'noted', break_key FROM fx_raised""")
def breaks_in_text(t):
    text = F.concat(F.lit("x\n- *col  "), (F.col("doc_id") % 5).cast("string"), F.lit("* — *"), "source", F.lit("*\n- **odd** – **two  words**\n"))
    note = F.concat(F.lit("[auto_invalidate] done\ninvalidated: "), "break_key", F.lit(", plain\n"), "break_key")
    df = t.fx_raised.select("issue_key", text.alias("description"), note.alias("body"))
    raised = V.breaks_in_text(df, ["issue_key"], "description").withColumn("kind", F.lit("raised"))
    return raised.unionByName(V.breaks_in_text(df, ["issue_key"], "body", NOTE_TAG).withColumn("kind", F.lit("noted")))


@query("h14_outstanding", """
    WITH f AS (SELECT issue_key, break_key, TRUE AS r, bool_or(source > 'src6') AS a, bool_or(source BETWEEN 'src3' AND 'src4') AS n FROM fx_raised GROUP BY 1, 2)
    SELECT issue_key, count(*) FILTER (r) AS raised_breaks_cnt, count(*) FILTER (a) AS already_invalidated_cnt, count(*) FILTER (n) AS newly_invalidated_cnt, count(*) FILTER (r AND NOT a AND NOT n) AS outstanding_cnt,
           count(*) FILTER (r) > 0 AND count(*) FILTER (r AND NOT a AND NOT n) = 0 AS should_close FROM f GROUP BY 1""")
def outstanding(t):
    df = t.fx_raised
    return V.outstanding(df, df.filter("source > 'src6'"), df.filter("source BETWEEN 'src3' AND 'src4'"))


def _part(keys: str, order: str) -> str:
    """SQL for the row a line of a long list stands in."""
    return f"CAST((row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) // 999 AS INTEGER) AS part"


_RUN = 'dataset, "runId"'
ALERT_SQL = f"""
    SELECT c.dataset, c."runId", coalesce(x.part, 0) AS part, c.score, c.suggested_title, CASE WHEN c.score > 30 THEN 'Critical' ELSE 'High' END AS suggested_priority, x.keys AS detected_breaks, y.types AS break_types,
           'high_score_ticket' AS notification_type, 'High-Scoring Tickets Requiring Attention' AS notification_title, concat('S-', CAST(c.seq AS VARCHAR)) AS issue_key, c.business_unit
    FROM fx_cand c LEFT JOIN (SELECT dataset, "runId", part, string_agg(key, ' | ' ORDER BY key) AS keys FROM (SELECT *, {_part(_RUN, "key")} FROM (SELECT DISTINCT dataset, "runId", key FROM fx_seen) d) q GROUP BY 1, 2, 3) x ON x.dataset = c.dataset AND x."runId" = c."runId"
    LEFT JOIN (SELECT dataset, "runId", part, string_agg(break_type, ' | ' ORDER BY break_type) AS types FROM (SELECT *, {_part(_RUN, "break_type")} FROM (SELECT DISTINCT dataset, "runId", break_type FROM fx_seen) d) q GROUP BY 1, 2, 3) y ON y.dataset = c.dataset AND y."runId" = c."runId" AND y.part = x.part
    WHERE c.score > 10 AND c.dataset NOT IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde')"""


def _alerts(t) -> DataFrame:
    tickets = t.fx_cand.withColumns({
        "suggested_priority": F.when(F.col("score") > 30, "Critical").otherwise("High"), "SUBTASK": F.concat(F.lit("S-"), F.col("seq").cast("string")),
    })
    return V.high_score_alerts(tickets, t.fx_seen, t.fx_bu.filter("business_unit LIKE '% - cde'"))


@query("h15_high_score_alerts", ALERT_SQL)
def high_score_alerts(t):
    return _alerts(t)


@query("h15_alert_breaks", """
    SELECT DISTINCT s.dataset, s."runId", s.key AS break_key FROM fx_seen s JOIN fx_cand c ON c.dataset = s.dataset AND c."runId" = s."runId"
    WHERE c.score > 10 AND c.dataset NOT IN (SELECT dataset FROM fx_bu WHERE business_unit LIKE '% - cde')""")
def alert_breaks(t):
    return V.alert_breaks(t.fx_cand, t.fx_seen, t.fx_bu.filter("business_unit LIKE '% - cde'"))


@query("h16_split_break_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS item, CASE WHEN l_linenumber <> 3 THEN concat('B__', l_linestatus) END AS metric FROM lineitem""")
def split_break_key(t):
    key = F.when(F.col("l_linenumber") == 3, "abc").otherwise(F.concat(F.lit(" "), "l_returnflag", F.lit("__B__"), "l_linestatus"))
    item, metric = X.split_break_key(key)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", item.alias("item"), metric.alias("metric"))


@query("h17_notifications", f"""
    SELECT dataset, "runId", NULL AS score, NULL AS suggested_title, 'invalidated_break' AS notification_type, 'Adaptive Rules Invalidated' AS notification_title, break_key FROM fx_note WHERE break_key IS NOT NULL
    UNION ALL SELECT dataset, "runId", score, suggested_title, notification_type, notification_title, NULL FROM ({ALERT_SQL}) a""")
def notifications(t):
    invalidated = t.fx_note.filter("break_key IS NOT NULL").select("dataset", "runId", "break_key")
    df = V.notifications(invalidated, _alerts(t))
    return df.select("dataset", "runId", "score", "suggested_title", "notification_type", "notification_title", "break_key")


@query("j01_load_notifications", "SELECT c_custkey, 'invalidated_break' AS notification_type FROM customer")
def load_notifications(t):
    missing = Source(options={"path": scratch_path(t.spark, "absent")})
    legacy = Source(options={"path": f"{t.sf_dir}/customer.parquet"})
    return N.load_notifications(t.spark, missing, legacy).select("c_custkey", "notification_type")


DOMAINS = ["example.com"]


@query("j02_valid_email", """
    SELECT key, coalesce(assignee_email LIKE '%@%', FALSE) AS shaped, coalesce(assignee_email LIKE '%@Example.com%', FALSE) AS allowed FROM fx_owner""")
def valid_email(t):
    return t.fx_owner.select("key", X.valid_email("assignee_email").alias("shaped"), X.valid_email("assignee_email", DOMAINS).alias("allowed"))


RECIPIENT_SQL = """
    SELECT key AS issue_key, trim(assignee_email) AS email FROM fx_owner WHERE assignee_email LIKE '%@Example.com%'
    UNION SELECT key, 'team@example.com' FROM fx_owner WHERE project = 'Special'
    UNION SELECT key, reporter_email FROM fx_owner WHERE project <> 'Special' AND coalesce(assignee_email NOT LIKE '%@Example.com%', TRUE)"""


def _recipients(t) -> DataFrame:
    owners = materialize(t.fx_owner, "owners")
    extras = owners.select("project").distinct().filter("project = 'Special'").withColumn("email", F.lit("team@example.com"))
    keys = owners.select(F.col("key").alias("issue_key"))
    return N.recipients(keys, owners.drop("reporter_email"), owners.select("key", "assignee_email", "reporter_email"), extras, DOMAINS, ["ord"])


@query("j03_recipients", RECIPIENT_SQL)
def recipients(t):
    return _recipients(t)


GROUP_SQL = f"""
    WITH a AS (SELECT DISTINCT n.dataset, r.email FROM fx_note n JOIN ({RECIPIENT_SQL}) r ON r.issue_key = n.issue_key UNION SELECT DISTINCT dataset, 'list@example.com' FROM fx_note)
    SELECT h.dataset, p.part, h.notification_type, p.keys AS issue_keys, p.emails AS recipients
    FROM (SELECT dataset, max(notification_type) AS notification_type FROM fx_note WHERE dataset IN (SELECT dataset FROM a) GROUP BY 1) h
    JOIN (SELECT * FROM (SELECT dataset, part, string_agg(email, ';' ORDER BY email) AS emails FROM (SELECT *, {_part("dataset", "email")} FROM a) d GROUP BY 1, 2) e
          FULL JOIN (SELECT dataset, part, string_agg(issue_key, ';' ORDER BY issue_key) AS keys FROM (SELECT *, {_part("dataset", "issue_key")} FROM (SELECT DISTINCT dataset, issue_key FROM fx_note) u) q GROUP BY 1, 2) k
          USING (dataset, part)) p ON p.dataset = h.dataset"""


def _notes(t) -> DataFrame:
    return materialize(t.fx_note.drop("runId"), "notes")


def _grouped(t, notes: DataFrame) -> DataFrame:
    return N.group_notifications(notes, _recipients(t), ["list@example.com", "no address"], DOMAINS, ["ord"])


@query("j04_group_notifications", GROUP_SQL)
def group_notifications(t):
    return _grouped(t, _notes(t))


NOTE_RECIPIENT_SQL = f"SELECT DISTINCT n.dataset, r.email FROM fx_note n JOIN ({RECIPIENT_SQL}) r ON r.issue_key = n.issue_key UNION SELECT DISTINCT dataset, 'list@example.com' FROM fx_note"


@query("j04_note_recipients", NOTE_RECIPIENT_SQL)
def note_recipients(t):
    return N.note_recipients(_notes(t), _recipients(t), ["list@example.com", "no address"], DOMAINS)


BREAK_SQL = """
    SELECT DISTINCT dataset, b.break_key FROM fx_note, LATERAL (SELECT unnest(['a__MIN', 'b__NULL']) AS break_key) b WHERE notification_type = 'high_score_ticket' AND detected_breaks IS NOT NULL
    UNION ALL SELECT DISTINCT dataset, break_key FROM fx_note WHERE notification_type = 'invalidated_break' AND break_key IS NOT NULL
    UNION ALL SELECT dataset, suggested_title FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY ord) AS rn, bool_or(detected_breaks IS NOT NULL) OVER (PARTITION BY dataset) AS found FROM fx_note) q
      WHERE rn = 1 AND NOT found AND notification_type = 'high_score_ticket'"""


@query("j05_unpack_breaks", BREAK_SQL)
def unpack_breaks(t):
    return N.unpack_breaks(t.fx_note, ["ord"])


STATUS_SQL = """
    SELECT dataset, issue_key, CASE WHEN bool_or(should_close AND notification_type <> 'high_score_ticket') THEN 'Closed' ELSE 'Updated' END AS status FROM fx_note GROUP BY 1, 2"""


@query("j06_issue_status", STATUS_SQL)
def issue_status(t):
    return N.issue_status(t.fx_note)


_LINE = "CASE WHEN strpos(break_key, '__') > 0 THEN concat('- ', substr(break_key, 1, strpos(break_key, '__') - 1), ' (', substr(break_key, strpos(break_key, '__') + 2), ')') ELSE concat('- ', break_key) END"


@query("j07_message_parts", f"""
    SELECT dataset, CAST((rn - 1) // 2 AS INTEGER) AS part, string_agg({_LINE}, chr(10) ORDER BY break_key) AS text
    FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY break_key) AS rn FROM ({BREAK_SQL}) b) q GROUP BY 1, 2""")
def message_parts(t):
    """All break lists, two breaks a part."""
    return N.message_parts(N.unpack_breaks(_notes(t), ["ord"]), part_lines=2)


@query("j07_render_messages", f"""
    WITH g AS ({GROUP_SQL.replace("WITH a AS", "SELECT * FROM (WITH a AS")})),
    b AS (SELECT dataset, part, string_agg({_LINE}, chr(10) ORDER BY break_key) AS bt FROM (SELECT *, {_part("dataset", "break_key")} FROM ({BREAK_SQL}) d) q GROUP BY 1, 2),
    s AS (SELECT dataset, part, string_agg(concat('- ', issue_key, ' (', status, ')'), chr(10) ORDER BY issue_key) AS st FROM (SELECT *, {_part("dataset", "issue_key")} FROM ({STATUS_SQL}) d) q GROUP BY 1, 2),
    j AS (SELECT g.* EXCLUDE (notification_type), b.* EXCLUDE (dataset, part), s.* EXCLUDE (dataset, part), coalesce(g.dataset, b.dataset, s.dataset) AS ds, coalesce(g.part, b.part, s.part) AS pt
          FROM g FULL JOIN b ON b.dataset = g.dataset AND b.part = g.part FULL JOIN s ON s.dataset = coalesce(g.dataset, b.dataset) AND s.part = coalesce(g.part, b.part))
    SELECT g.dataset, g.pt AS part, g.notification_type, g.recipients,
      CASE WHEN g.notification_type = 'high_score_ticket' THEN concat('[Data Quality] High-score rule breaks detected - ', g.dataset, ' requires attention') ELSE concat('[Data Quality] Adaptive rule invalidated, no further action needed - ', g.dataset) END AS subject,
      concat(CASE WHEN g.notification_type = 'high_score_ticket' THEN 'High-score rule breaks detected and require attention.' ELSE 'Data quality rule breaks for Adaptive rules have been invalidated.' END, chr(10), chr(10),
        'Dataset:', chr(10), g.dataset, chr(10), '- /finding?dataset=', g.dataset, chr(10), chr(10), CASE WHEN g.notification_type = 'high_score_ticket' THEN 'Detected breaks:' ELSE 'Invalidated breaks:' END, chr(10),
        coalesce(g.bt, CASE WHEN g.pt = 0 THEN '- None' ELSE '- None further' END), chr(10), chr(10), 'Tickets:', chr(10), coalesce(g.st, CASE WHEN g.pt = 0 THEN '- None' ELSE '- None further' END), chr(10), chr(10),
        CASE WHEN g.notification_type = 'high_score_ticket' THEN concat('Action Required:', chr(10), 'These high-score rule breaks have been detected with high confidence score (>10).', chr(10),
          'Please review the dataset changes and assess whether these represent genuine', chr(10), 'data quality issues that need to be addressed.')
        ELSE concat('Reason:', chr(10), 'DQ data profile changes persisted across multiple runs while row count', chr(10), 'remained within normal fluctuation.') END) AS message
    FROM (SELECT k.dataset, k.notification_type, j.pt, j.recipients, j.bt, j.st FROM j JOIN (SELECT DISTINCT dataset, notification_type FROM g) k ON k.dataset = j.ds) g""")
def render_messages(t):
    notes = _notes(t)
    return N.render_messages(_grouped(t, notes), N.unpack_breaks(notes, ["ord"]), N.issue_status(notes), "/finding?dataset=")
