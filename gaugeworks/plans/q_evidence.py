"""Upstream evidence ranking and key discovery."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evidence as E
from ..operators import keys as Y
from .fixtures import add_views
from .registry import query

add_views({
    "fx_inc": """
        SELECT o.o_orderkey AS incident, o.o_custkey AS cust, o.o_orderdate + INTERVAL 10 HOUR AS run_at,
               CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate + INTERVAL 20 HOUR END AS end_at, concat('x.t', CAST(o.o_custkey AS STRING)) AS tbl, n.n_name AS business_unit,
               CASE o.o_orderstatus WHEN 'O' THEN 'dropped' WHEN 'F' THEN 'increased' END AS row_count_direction
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "fx_ev": """
        SELECT concat('T-', CAST(o.o_orderkey AS STRING)) AS key, o.o_custkey AS cust, n.n_name AS unit, o.o_orderpriority AS prio,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN o.o_orderdate + INTERVAL 7 HOUR WHEN '2-HIGH' THEN o.o_orderdate + INTERVAL 20 HOUR ELSE o.o_orderdate + INTERVAL 617 MINUTE END AS updated,
               CASE WHEN o.o_orderpriority <> '3-MEDIUM' THEN o.o_orderdate - INTERVAL 2 DAY END AS created,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN concat('Load x.t', CAST(o.o_custkey AS STRING), ' Row  Count dropped') WHEN '2-HIGH' THEN concat('Load T', CAST(o.o_custkey AS STRING)) ELSE 'nothing' END AS summary,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 'decrease seen' WHEN '2-HIGH' THEN concat('unit ', n.n_name) ELSE concat('about x.t', CAST(o.o_custkey AS STRING), ' increase') END AS body,
               CASE WHEN o.o_orderpriority = '1-URGENT' THEN concat('merged 1990-01-01, again ', CAST(CAST(o.o_orderdate AS DATE) AS STRING)) END AS development,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Story' WHEN '2-HIGH' THEN 'task' ELSE 'Bug' END AS issue_type, o.o_orderstatus AS status,
               CASE WHEN o.o_orderstatus = 'O' THEN 1 END AS depth
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "fx_pair": """
        SELECT i.incident, i.run_at, i.tbl, i.business_unit, i.row_count_direction, e.key, e.prio, e.updated, e.created, e.summary, e.body, e.development, e.issue_type, e.status, e.depth,
               CASE WHEN e.prio = '1-URGENT' THEN CAST(CAST(e.updated AS DATE) AS TIMESTAMP) END AS dev_at
        FROM fx_inc i JOIN fx_ev e ON i.cust = e.cust""",
    "fx_turn": "SELECT conv_id, turn, concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS key, length(text) % 5 = 0 AS late FROM conversations",
})


def _description(t):
    text = F.concat(
        F.lit("*Dataset:* "), "dataset", F.lit("\n*DataTable:* db."), "status", F.lit("\n*RunId (runDate):* "), F.date_format("run_date", "yyyy-MM-dd HH:mm:ss"),
        F.lit("\n*Project:* unit "), "status", F.lit("\n- Row Count: "),
        F.expr("CASE status WHEN 'O' THEN 'Row Count Dropped' WHEN 'P' THEN 'Row  Count increased' ELSE 'steady' END"), F.lit("\nsaw col_1__NULL; b__MIN VALUE"),
    )
    return t.fx_run.select(F.col("run_id").alias("id"), text.alias("text"))


@query("i01_extract_signals", """
    SELECT run_id AS id, dataset, concat('db.', status) AS table_name, strftime(run_date, '%Y-%m-%d %H:%M:%S') AS run_id, concat('unit ', status) AS business_unit,
           CASE status WHEN 'O' THEN 'dropped' WHEN 'P' THEN 'increased' END AS row_count_direction, 'col_1__NULL|b__MIN VALUE' AS break_keys, run_date AS run_at FROM fx_run""")
def extract_signals(t):
    df = E.extract_signals(_description(t), "text").drop("text")
    return df.withColumn("break_keys", F.array_join("break_keys", "|"))


@query("i02_search_terms", """
    SELECT dataset, run_id, concat('dbo.t_1|', CASE WHEN seg = 'building' THEN concat('building.', n, '|') ELSE '' END, dataset) AS candidates,
           concat('dbo.t_1|dbo|t|1|', CASE WHEN seg = 'building' THEN concat('building.', n, '|building|', CASE WHEN n <> '1' THEN concat(n, '|') ELSE '' END, dataset, '|ds|x')
             ELSE concat(dataset, '|ds|x|', seg, CASE WHEN n <> '1' THEN concat('|', n) ELSE '' END) END, '|My Project') AS terms
    FROM (SELECT concat('ds_x_', substr(dataset, 4)) AS dataset, run_id, string_split(dataset, '_')[2] AS seg, string_split(dataset, '_')[3] AS n FROM fx_run) r""")
def search_terms(t):
    df = t.fx_run.withColumn("dataset", F.concat(F.lit("ds_x_"), F.substring("dataset", 4, 100)))
    df = df.withColumn("names", E.table_candidates("dataset", F.lit("dbo.t_1"), ["building"]))
    return df.select("dataset", "run_id", F.array_join("names", "|").alias("candidates"), F.array_join(E.search_terms("names", F.lit(" My Project ")), "|").alias("terms"))


SEARCH_SQL = """
    SELECT incident, key, updated FROM (SELECT i.incident, e.key, e.updated, row_number() OVER (PARTITION BY i.incident ORDER BY e.updated DESC, e.key) AS rn
      FROM fx_inc i JOIN fx_ev e ON i.business_unit = e.unit AND (e.prio = '2-HIGH' OR i.cust = e.cust)
       AND e.updated >= i.run_at - INTERVAL 45 DAY AND e.updated <= coalesce(i.end_at, i.run_at + INTERVAL 24 HOUR)) q WHERE rn <= 500"""


def _search_inputs(t):
    names = F.array("tbl")
    incidents = t.fx_inc.select("incident", "run_at", "end_at", F.filter(E.search_terms(names, "business_unit"), lambda w: w != "x").alias("terms"))
    return incidents, t.fx_ev.select("key", "updated", F.concat_ws("\n", "summary", "body").alias("text"))


@query("i03_search_evidence", SEARCH_SQL)
def search_evidence(t):
    return E.search_evidence(*_search_inputs(t), limit=500)


EVENT = "coalesce(dev_at, updated)"


@query("i04_nearest_in_time", f"""
    SELECT incident, key, {EVENT} AS event_at FROM (SELECT *, row_number() OVER (PARTITION BY incident ORDER BY abs(epoch_us({EVENT}) - epoch_us(run_at)), updated DESC, key) AS rn FROM fx_pair) q WHERE rn <= 15""")
def nearest_in_time(t):
    return E.nearest_in_time(t.fx_pair).select("incident", "key", "event_at")


SCORE_SQL = """
    SELECT *, CASE WHEN late > 86400 THEN -1.0 ELSE CAST(CASE prio WHEN '1-URGENT' THEN 60 WHEN '2-HIGH' THEN 15 ELSE 43 END
        + CASE WHEN row_count_direction = 'dropped' AND prio = '1-URGENT' THEN 15 WHEN row_count_direction = 'increased' AND prio NOT IN ('1-URGENT', '2-HIGH') THEN 15 ELSE 0 END
        + CASE WHEN prio = '2-HIGH' THEN 4 ELSE 0 END + CASE prio WHEN '1-URGENT' THEN 6 WHEN '2-HIGH' THEN 3 ELSE 0 END AS DOUBLE)
        + greatest(CAST(18.0 AS DOUBLE) - least(greatest(-late / 86400.0, 0.0) * 3.0, 18.0), 0.0) + CASE WHEN depth IS NOT NULL THEN 10.0 - depth * 3.0 ELSE 0.0 END END AS score, late > 86400 AS excluded
    FROM (SELECT *, CAST(epoch_us(coalesce(dev_at, created, updated)) / 1e6 - epoch_us(run_at) / 1e6 AS DOUBLE) AS late FROM fx_pair) p"""


def _scored(t):
    incidents = E.incident_names(t.fx_inc.withColumn("candidates", F.array("tbl")))
    tickets = E.ticket_texts(t.fx_ev)
    dev_at = F.when(F.col("prio") == "1-URGENT", F.col("updated").cast("date").cast("timestamp_ntz"))
    pairs = incidents.drop("end_at").join(tickets.drop("unit"), "cust")
    return E.relevance(pairs.withColumn("dev_at", dev_at))


@query("i05_relevance", f"SELECT incident, key, CAST(round(score, 6) AS DOUBLE) AS score, excluded FROM ({SCORE_SQL}) q")
def relevance(t):
    return _scored(t).select("incident", "key", F.round("score", 6).alias("score"), "excluded")


@query("i06_link_edges", """
    SELECT src, CAST(0 AS INTEGER) AS position, dst FROM fx_link UNION ALL SELECT src, 1, concat(dst, 'x') FROM fx_link""")
def link_edges(t):
    links = F.array(F.struct(F.col("dst").alias("inward"), F.concat("dst", F.lit("x")).alias("outward")), F.struct(F.lit(None).cast("string").alias("inward"), F.lit("").alias("outward")))
    df = t.fx_link.select(F.col("src").alias("key"), F.lit(None).cast("string").alias("parent_key"), F.array("dst").alias("subtasks"), links.alias("links"))
    return E.link_edges(df)


@query("i07_expand_links", """
    SELECT conv_id AS incident, key, 0 AS depth, CAST(1 AS BIGINT) AS place, CAST(NULL AS VARCHAR) AS found_from FROM fx_turn WHERE turn = 0
    UNION ALL SELECT a.conv_id, a.key, 1, 1, concat(CAST(a.conv_id AS VARCHAR), '-0') FROM fx_turn a JOIN fx_turn z ON z.conv_id = a.conv_id AND z.turn = 0 WHERE a.turn = 1 AND NOT a.late
    UNION ALL SELECT b.conv_id, b.key, 2, 1, a.key FROM fx_turn b JOIN fx_turn a ON a.conv_id = b.conv_id AND a.turn = 1 AND NOT a.late JOIN fx_turn z ON z.conv_id = b.conv_id AND z.turn = 0 WHERE b.turn = 2 AND NOT b.late""")
def expand_links(t):
    at = F.lit("2024-01-10").cast("timestamp_ntz")
    seeds = t.fx_turn.filter("turn = 0").select(F.col("conv_id").alias("incident"), "key", F.lit(1).alias("rank"), at.alias("latest_at"))
    allowed = t.fx_turn.select("key", F.when(F.col("late"), at + F.expr("INTERVAL 1 DAY")).otherwise(at).alias("event_at"))
    return E.expand_links(seeds, t.fx_link.withColumn("position", F.lit(0)), allowed, cap=50, first=3)


RANK_SQL = f"""
    SELECT *, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY incident ORDER BY score DESC, key) AS rn FROM ({SCORE_SQL}) s WHERE NOT excluded) q WHERE rn <= 20"""


@query("i08_rank_evidence", f"SELECT incident, key, rank, CAST(round(score, 3) AS DOUBLE) AS relevance FROM ({RANK_SQL}) z")
def rank_evidence(t):
    return E.rank_evidence(_scored(t)).select("incident", "key", "rank", "relevance")


@query("i09_redact_comments", r"""
    SELECT doc_id, concat(regexp_replace(regexp_replace(text, '@?\[~[^\]]+\]', '[USER]', 'g'), '\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b', '[EMAIL]', 'g'), chr(10), 'asked [USER] and [EMAIL]') AS clean
    FROM documents""")
def redact_comments(t):
    df = t.documents.select("doc_id", F.array("text", F.concat(F.lit("asked [~user."), F.col("doc_id").cast("string"), F.lit("] and x.y@z.org"))).alias("comments"))
    return E.redact_comments(df, "comments", "clean").select("doc_id", "clean")


@query("i09_redact_limited", r"""
    SELECT doc_id, concat('asked [USER] and [EMAIL]', chr(10), lang, ' by [EMAIL], [USER]') AS clean FROM documents""")
def redact_limited(t):
    first = F.concat(F.lit("asked @[~user."), F.col("doc_id").cast("string"), F.lit("] and x.y@z.org"))
    second = F.concat("lang", F.lit(" by "), "source", F.lit("@mail.example.com, [~u]"))
    return E.redact_comments(t.documents.select("doc_id", F.array(first, second, F.lit("dropped")).alias("comments")), "comments", "clean", limit=2).select("doc_id", "clean")


@query("i10_evidence_text", f"""
    SELECT incident, string_agg(concat('Key: ', key, chr(10), 'Type: ', issue_type, chr(10), 'Summary: ', summary, chr(10), 'Status: ', status, chr(10), 'Created: ', coalesce(strftime(created, '%Y-%m-%d %H:%M:%S'), ''), chr(10),
        'Updated: ', strftime(updated, '%Y-%m-%d %H:%M:%S'), chr(10), 'Development Latest: ', coalesce(strftime(dev_at, '%Y-%m-%d %H:%M:%S'), ''), chr(10), 'Relevance Score: ', CAST(CAST(round(score, 3) AS DOUBLE) AS VARCHAR), chr(10),
        'Description: ', body, chr(10), 'Comments:', chr(10), 'c'), chr(10) || chr(10) ORDER BY rank) AS evidence FROM ({RANK_SQL}) z GROUP BY incident""")
def evidence_text(t):
    ranked = E.rank_evidence(_scored(t)).withColumns({"description": F.col("body"), "comments_text": F.lit("c")})
    return E.evidence_text(ranked)


@query("i11_diagnosable", """
    SELECT DISTINCT concat('S-', CAST(seq AS VARCHAR)) AS issue_key FROM fx_cand WHERE (ticket_source = 'adaptive' OR "ruleNm" = 'if_col_2_is_bad') AND score > 20""")
def diagnosable(t):
    df = t.fx_cand.withColumns({
        "suggested_labels": F.when(F.col("ruleNm") == "if_col_2_is_bad", "['dq', 'Adaptive']").otherwise("['dq']"),
        "SUBTASK": F.concat(F.lit(" S-"), F.col("seq").cast("string")), "SUBTASK_STATUS": F.when(F.col("score") > 40, " New").when(F.col("score") > 20, "Reopened").otherwise("Old"),
    })
    return E.diagnosable(df)


MARKER = "h3. Summary of findings"


@query("i12_merge_section", f"""
    SELECT doc_id, CASE WHEN lang = 'en' THEN concat('intro ', source, chr(10), chr(10), '{MARKER}', chr(10), 'new') WHEN lang = 'fr' THEN concat(chr(10), '{MARKER}', chr(10), 'new')
      ELSE concat('{MARKER}', chr(10), 'new') END AS merged FROM documents""")
def merge_section(t):
    old = F.when(F.col("lang") == "en", F.concat(F.lit("intro "), "source", F.lit(f" \n{MARKER}\nold block"))).when(F.col("lang") == "fr", "\n")
    return t.documents.select("doc_id", X.merge_section(old, F.lit(f"{MARKER}\nnew"), MARKER).alias("merged"))


@query("i13_rule_confidence", f"""
    WITH r AS ({RANK_SQL}), t AS (SELECT incident, score, coalesce(epoch_us(run_at) / 1e6 - epoch_us(created) / 1e6 <= 864000, FALSE) AS recent, row_number() OVER (PARTITION BY incident ORDER BY score DESC, key DESC) AS n FROM r),
    s AS (SELECT incident, count(*) FILTER (score > 10) AS strong FROM r GROUP BY 1)
    SELECT t.incident, CASE WHEN t.score >= 25 AND t.recent THEN 'High' WHEN t.score >= 15 OR s.strong >= 3 THEN 'Medium' ELSE 'Low' END AS confidence, CAST(round(t.score, 6) AS DOUBLE) AS top_score
    FROM t JOIN s ON s.incident = t.incident WHERE t.n = 1""")
def rule_confidence(t):
    return E.rule_confidence(E.rank_evidence(_scored(t))).withColumn("top_score", F.round("top_score", 6))


def _key_sql(table: str, columns: list[str]) -> str:
    singles = " UNION ALL ".join(f"SELECT '{c}' AS columns, 1 AS width WHERE (SELECT count(DISTINCT {c}) = count(*) FROM {table})" for c in columns)
    pairs = " UNION ALL ".join(
        f"SELECT '{a},{b}', 2 WHERE (SELECT count(DISTINCT {a}) < count(*) AND count(DISTINCT {b}) < count(*) AND count({a}) = count(*) AND count({b}) = count(*) "
        f"AND (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {table}) q) = count(*) FROM {table})"
        for a, b in combinations(columns, 2)
    )
    return f"{singles} UNION ALL {pairs}"


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _wide_key_sql(table: str, columns: list[str], width: int) -> str:
    """Every column set up to a width, whether its values are never null and never repeat, and the minimal ones of these."""
    sets = [s for n in range(1, width + 1) for s in combinations(columns, n)]
    checks = " UNION ALL ".join(
        f"SELECT '{','.join(s)}' AS columns, {len(s)} AS width, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {table} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in s)}) q) = (SELECT count(*) FROM {table}) AS ok"
        for s in sets
    )
    return f"""WITH checked AS ({checks})
    SELECT columns, width FROM checked a WHERE ok AND NOT EXISTS (SELECT 1 FROM checked b WHERE b.ok AND b.width < a.width AND list_has_all(string_split(a.columns, ','), string_split(b.columns, ',')))"""


_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


@query("k01_wide_keys", _wide_key_sql("lineitem", _LINE_COLUMNS, 3))
def wide_keys(t):
    """Minimal keys of up to three columns of the line items."""
    return Y.candidate_keys(t.lineitem.select(*_LINE_COLUMNS), 3)


@query("k01_candidate_keys", _key_sql("orders", _ORDER_COLUMNS))
def candidate_keys(t):
    return Y.candidate_keys(t.orders, 2)
