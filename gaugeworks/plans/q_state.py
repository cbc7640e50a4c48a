"""Sources, sinks and keyed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import state as S
from ..operators.store import KeyedTable, differing_keys
from ..operators.relational import union_all
from ..session import scratch_path
from ..sources import readers as R
from ..sources import writers as W
from ..sources.schemas import managed
from .registry import query


def own_name(label: str) -> str:
    """A catalog name of this run alone."""
    return f"gaugeworks_{uuid.uuid4().hex}_{label}"


ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("a01_csv_source", "SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders GROUP BY o_orderstatus")
def csv_source(t):
    path = scratch_path(t.spark, "csv")
    W.write_csv(t.orders, path)
    df = R.read_csv(t.spark, path, t.orders.schema)
    total = F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double").alias("total")
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), total)


@query("a01_csv_texts", "SELECT doc_id, text, concat(' ', lang, ' ') AS padded FROM documents")
def csv_texts(t):
    """Texts with line breaks, quotes and outer spaces, written and read back."""
    path = scratch_path(t.spark, "csv")
    df = t.documents.select("doc_id", "text", F.concat(F.lit(" "), "lang", F.lit(" ")).alias("padded"))
    W.write_csv(df, path)
    return R.read_csv(t.spark, path, df.schema)


@query("a02_table_source", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def table_source(t):
    name = own_name("customer")
    W.write_replace(t.customer, name, scratch_path(t.spark, "customer"))
    return R.read_table(t.spark, name).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("a03_format_source", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40")
def format_source(t):
    df = R.read_source(t.spark, "parquet", {"path": f"{t.sf_dir}/lineitem.parquet"}, columns=["l_orderkey", "l_linenumber", "l_quantity"])
    return df.filter("l_quantity > 40")


@query("a04_first_available", "SELECT s_suppkey, s_nationkey FROM supplier")
def first_available(t):
    sources = [
        R.Source(table="gaugeworks_no_such_table"),
        R.Source(fmt="csv", options={"path": f"{t.sf_dir}/no_such.csv"}, schema=t.supplier.schema),
        R.Source(options={"path": f"{t.sf_dir}/supplier.parquet"}),
    ]
    return R.read_first_available(t.spark, sources).select("s_suppkey", "s_nationkey")


@query("a05_lenient_source", "SELECT p_partkey, p_brand, 'found' AS origin FROM part")
def lenient_source(t):
    schema = StructType([t.part.schema["p_partkey"], t.part.schema["p_brand"]])
    found = R.read_or_empty(t.spark, R.Source(options={"path": f"{t.sf_dir}/part.parquet"}), schema)
    absent = R.read_or_empty(t.spark, R.Source(options={"path": f"{t.sf_dir}/no_such.parquet"}), schema)
    return found.withColumn("origin", F.lit("found")).unionByName(absent.withColumn("origin", F.lit("absent")))


@query("a06_csv_sink", """
    SELECT c_custkey, c_mktsegment, concat('{"a":', CAST(c_custkey AS STRING), ',"b":"', c_mktsegment, '"}') AS nested
    FROM customer""")
def csv_sink(t):
    path = scratch_path(t.spark, "csv")
    df = t.customer.select("c_custkey", "c_mktsegment", F.struct(F.col("c_custkey").alias("a"), F.col("c_mktsegment").alias("b")).alias("nested"))
    W.write_csv(df, path)
    return R.read_csv(t.spark, path, W.normalize_for_sink(df).schema)


@query("a07_table_replace", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def table_replace(t):
    name = own_name("flags")
    W.write_replace(t.lineitem.groupBy("l_linestatus").count(), name, scratch_path(t.spark, "flags"))
    W.write_replace(t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n")), name, scratch_path(t.spark, "flags"))
    return R.read_table(t.spark, name)


@query("a08_sink_router", """
    SELECT kind, o_orderpriority, count(*) AS n FROM orders, (SELECT 'csv' AS kind UNION ALL SELECT 'table') k
    GROUP BY kind, o_orderpriority""")
def sink_router(t):
    df = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    root = scratch_path(t.spark, "router")
    where = W.write_output(df, "order priorities", [W.Target("csv", root), W.Target("table", root)], own_name(""))
    a = R.read_csv(t.spark, where["csv"], df.schema).withColumn("kind", F.lit("csv"))
    return a.unionByName(R.read_table(t.spark, where["table"]).withColumn("kind", F.lit("table")))


@query("a08_write_policies", """
    SELECT 'mapping' AS what, coalesce(x.k, s.k) AS k, x.grp, CASE WHEN s.k IS NOT NULL THEN s.status ELSE x.status END AS status FROM fx_target x FULL OUTER JOIN fx_source s ON x.k = s.k
    UNION ALL SELECT 'snapshot', k, NULL, status FROM fx_source""")
def write_policies(t):
    """Each output is written twice; the mapping keeps keys and columns of the first time, the snapshot its columns only."""
    prefix, root = own_name(""), scratch_path(t.spark, "policies")
    out = None
    for name, what in (("business_unit_mapping", "mapping"), ("findings", "snapshot")):
        for df in (t.fx_target.select("k", "grp", "status"), t.fx_source.select("k", "status")):
            named = df.withColumnRenamed("k", "dataset")
            where = W.write_output(named, name, [W.Target("table", root)], prefix)
        rows = R.read_table(t.spark, where["table"]).select(F.lit(what).alias("what"), F.col("dataset").alias("k"), "grp", "status")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("a09_write_policy", """
    SELECT concat('auto_', k.t, lower(c.c_mktsegment)) AS table_name, k.kind, k.keys, count(*) AS n
    FROM customer c, (VALUES ('findings_', 'snapshot', '', 0), ('', 'upsert', 'dataset', 1), ('', 'skip', '', 2)) k(t, kind, keys, v) WHERE k.v = 0 GROUP BY ALL
    UNION ALL SELECT CASE v WHEN 1 THEN 'auto_business_unit_mapping' ELSE 'kept' END, kind, keys, (SELECT count(*) FROM customer)
    FROM (VALUES ('upsert', 'dataset', 1), ('skip', '', 2)) k(kind, keys, v)""")
def write_policy(t):
    """Table, kind and keys of one output per segment and of the two that do not follow the snapshot rule."""
    segments = sorted(r[0] for r in t.customer.select("c_mktsegment").distinct().collect())
    rows = []
    for segment in segments:
        p = W.policy_for(f"Findings {segment}", "auto_")
        rows.append((segment, p.table, p.kind, ",".join(p.keys)))
    for name in ("business_unit_mapping", "dataset_definitions"):
        p = W.policy_for(name, "auto_", {"dataset_definitions": "kept"})
        rows.append((None, p.table, p.kind, ",".join(p.keys)))
    policies = t.spark.createDataFrame(rows, "segment string, table_name string, kind string, keys string")
    counts = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")).unionByName(t.customer.agg(F.count("*").alias("n")).withColumn("c_mktsegment", F.lit(None).cast("string")))
    return policies.join(counts, F.col("segment").eqNullSafe(F.col("c_mktsegment"))).select("table_name", "kind", "keys", "n")


@query("a10_snapshot_replace", """
    SELECT k, grp, status, CAST(NULL AS BIGINT) AS rows_cnt, note, concat('#', note) AS extra FROM fx_source""")
def snapshot_replace(t):
    new = t.fx_source.drop("rows_cnt").withColumn("extra", F.concat(F.lit("#"), F.col("note")))
    return S.snapshot_replace(new, t.fx_target)


@query("a10_snapshot_versions", "SELECT k, grp, status, rows_cnt, note FROM fx_source")
def snapshot_versions(t):
    policy = W.WritePolicy("snapshot", own_name("snapshot"))
    W.write_table(t.fx_target, policy, scratch_path(t.spark, "snapshot"))
    W.write_table(t.fx_source, policy, scratch_path(t.spark, "snapshot"))
    return R.read_table(t.spark, policy.table)


@query("a10_version_switch", "SELECT k, status, 'before' AS seen FROM fx_target UNION ALL SELECT k, status, 'after' FROM fx_source")
def version_switch(t):
    """A reader that began before the switch, and one that began after it."""
    name, place = own_name("versions"), scratch_path(t.spark, "versions")
    W.write_version(t.fx_target, name, place)
    before = R.read_table(t.spark, name)
    W.write_version(t.fx_source, name, place)
    after = R.read_table(t.spark, name)
    return before.select("k", "status", F.lit("before").alias("seen")).unionByName(after.select("k", "status", F.lit("after").alias("seen")))


def _keyed(t) -> KeyedTable:
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), ["k"], parts=8)
    table.create(t.fx_target)
    return table


INSERT_ONLY = """
    SELECT k, grp, status, rows_cnt, note FROM fx_target
    UNION ALL SELECT k, grp, status, rows_cnt, note FROM fx_source WHERE k NOT IN (SELECT k FROM fx_target)"""


@query("a11_merge_insert_only", INSERT_ONLY)
def merge_insert_only(t):
    return S.merge_insert_only(t.fx_target, t.fx_source.unionByName(t.fx_source.withColumn("note", F.lit("~later"))), ["k"], ["note"])


@query("a12_new_rows", """
    SELECT s.grp, s.status, s.k FROM fx_source s
    WHERE NOT EXISTS (SELECT 1 FROM fx_target x WHERE x.grp = s.grp AND x.status IS NOT DISTINCT FROM NULLIF(s.status, 'P'))""")
def new_rows(t):
    source = t.fx_source.withColumn("status0", F.col("status")).withColumn("status", F.nullif("status", F.lit("P")))
    return S.new_rows(source, t.fx_target, ["grp", "status"]).select("grp", F.col("status0").alias("status"), "k")


UPSERT = """
    SELECT coalesce(x.k, s.k) AS k,
           CASE WHEN {take} THEN s.grp ELSE x.grp END AS grp, CASE WHEN {take} THEN s.status ELSE x.status END AS status,
           CASE WHEN {take} THEN s.rows_cnt ELSE x.rows_cnt END AS rows_cnt, CASE WHEN {take} THEN s.note ELSE x.note END AS note,
           CASE WHEN x.k IS NULL THEN 'insert' WHEN s.k IS NOT NULL AND s.status IS DISTINCT FROM x.status THEN 'update' ELSE 'keep' END AS _action
    FROM fx_target x FULL OUTER JOIN fx_source s ON x.k = s.k"""


@query("a13_merge_upsert", UPSERT.replace("{take}", "x.k IS NULL OR (s.k IS NOT NULL AND s.status IS DISTINCT FROM x.status)"))
def merge_upsert(t):
    return S.merge_upsert(t.fx_target, t.fx_source, ["k"], change_columns=["status"])


@query("a13_partwise_upsert", """
    SELECT k, grp, status, rows_cnt, note FROM fx_target WHERE k NOT IN (SELECT k FROM fx_source WHERE k % 100 = 1)
    UNION ALL SELECT k, grp, status, rows_cnt, note FROM fx_source WHERE k % 100 = 1""")
def partwise_upsert(t):
    """The stored table after the merge of a delta, read back."""
    table = _keyed(t)
    table.upsert(t.fx_source.filter("k % 100 = 1"))
    return table.read()


@query("a14_partwise_partial", """
    SELECT coalesce(x.k, s.k) AS k, x.grp, CASE WHEN s.k IS NOT NULL THEN s.status ELSE x.status END AS status, x.rows_cnt, x.note
    FROM fx_target x FULL OUTER JOIN (SELECT k, status FROM fx_source WHERE k % 50 = 3) s ON x.k = s.k""")
def partwise_partial(t):
    table = _keyed(t)
    table.upsert_partial(t.fx_source.filter("k % 50 = 3").select("k", "status"))
    return table.read()


@query("a14_merge_partial", """
    SELECT coalesce(x.k, s.k) AS k, x.grp, CASE WHEN s.k IS NOT NULL THEN s.status ELSE x.status END AS status, x.rows_cnt, x.note,
           CASE WHEN x.k IS NULL THEN 'insert' WHEN s.k IS NOT NULL AND s.status IS DISTINCT FROM x.status THEN 'update' ELSE 'keep' END AS _action
    FROM fx_target x FULL OUTER JOIN fx_source s ON x.k = s.k""")
def merge_partial(t):
    return S.merge_partial(t.fx_target, t.fx_source.select("k", "status"), ["k"])


@query("a15_normalize_for_sink", """
    SELECT l_orderkey, l_linenumber, l_partkey, concat('["', l_returnflag, '","', l_linestatus, '"]') AS flags,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount FROM lineitem""")
def normalize_for_sink(t):
    nan = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array("l_returnflag", "l_linestatus").alias("flags"), nan.alias("discount"))
    return W.normalize_for_sink(df)


@query("a16_prune_stale", """
    SELECT k, grp, status, rows_cnt, note FROM fx_target x
    WHERE status NOT IN (SELECT status FROM fx_source WHERE status <> 'P')
          OR EXISTS (SELECT 1 FROM fx_source s WHERE s.status = x.status AND s.status <> 'P' AND s.k = x.k)""")
def prune_stale(t):
    return S.prune_stale(t.fx_target, t.fx_source.filter("status <> 'P'"), ["status"], ["k"])


@query("a16_partwise_prune", """
    SELECT k, grp, status, rows_cnt, note FROM fx_target x
    WHERE grp NOT IN (SELECT grp FROM fx_target WHERE k % 40 = 0) OR k % 40 = 0""")
def partwise_prune(t):
    """Rows whose key left one of the groups that a delta covers."""
    table = _keyed(t)
    table.prune(t.fx_target.filter("k % 40 = 0"), ["grp"])
    return table.read()


@query("a17_managed_schema", """
    SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_custkey AS STRING) AS o_custkey, CAST(NULL AS STRING) AS remark FROM orders""")
def managed_schema(t):
    schema = StructType.fromDDL("o_orderkey string, o_custkey string, remark string")
    return S.conform(t.orders, schema, ["o_orderkey"])


@query("a17_managed_tables", """
    SELECT 'mapping' AS what, dataset AS k1, CAST(NULL AS VARCHAR) AS k2, region, CAST(NULL AS DOUBLE) AS score, CAST(14 AS INTEGER) AS width FROM fx_bu
    UNION ALL SELECT 'rules', dataset, concat(CAST(run_id AS VARCHAR), '/', rule_nm), NULL, min(score), 26 FROM fx_rule GROUP BY 2, 3
    UNION ALL SELECT 'history', dataset, strftime(run_date, '%Y-%m-%d'), NULL, CAST(max(row_cnt) AS DOUBLE), 32 FROM fx_run GROUP BY 2, 3
    UNION ALL SELECT 'definitions', dataset, rule_nm, NULL, NULL, 33 FROM fx_rule GROUP BY 2, 3
    UNION ALL SELECT 'position', c_mktsegment, NULL, NULL, CAST(CAST(avg(CAST(c_custkey AS DOUBLE)) AS DECIMAL(10,2)) AS DOUBLE), 9 FROM customer GROUP BY 2""")
def managed_tables(t):
    """Each of the five managed tables filled from a view, shaped and checked for its key."""
    rules = t.fx_rule.groupBy("dataset", F.concat(F.col("run_id").cast("string"), F.lit("/"), "rule_nm").alias("ruleNm")).agg(F.min("score").alias("score"))
    days = t.fx_run.groupBy("dataset", F.date_trunc("day", "run_date").alias("runId")).agg(F.max("row_cnt").alias("rows"))
    segments = t.customer.groupBy(F.col("c_mktsegment").alias("sector")).agg(F.avg("c_custkey").alias("dq_capability"))
    filled = {
        "business_unit_mapping": ("mapping", t.fx_bu.drop("ord"), "dataset", None, "region", None),
        "custom_rule_details": ("rules", rules.withColumn("runId", F.lit("2024-01-01").cast("timestamp")), "dataset", "ruleNm", None, "score"),
        "dashboard_history": ("history", days, "dataset", "runId", None, "rows"),
        "dataset_definitions": ("definitions", t.fx_rule.select("dataset", F.col("rule_nm").alias("col_name")).distinct(), "dataset", "col_name", None, None),
        "global_position": ("position", segments, "sector", None, None, "dq_capability"),
    }
    out = []
    for name, (what, df, k1, k2, region, score) in filled.items():
        shaped = managed(df, name)
        second = F.lit(None).cast("string") if k2 is None else F.date_format(k2, "yyyy-MM-dd") if what == "history" else F.col(k2)
        out.append(shaped.select(
            F.lit(what).alias("what"), F.col(k1).alias("k1"), second.alias("k2"), (F.lit(None).cast("string") if region is None else F.col(region)).alias("region"),
            (F.lit(None) if score is None else F.col(score)).cast("double").alias("score"), F.lit(len(shaped.columns)).alias("width"),
        ))
    return union_all(out)


@query("a18_seed_reference", """
    SELECT coalesce(a.sector, b.sector) AS sector, coalesce(b.n, a.n) AS n
    FROM (SELECT c_mktsegment AS sector, count(*) AS n FROM customer GROUP BY 1) a
    FULL OUTER JOIN (SELECT o_orderpriority AS sector, count(*) AS n FROM orders GROUP BY 1
                     UNION ALL SELECT c_mktsegment, count(*) * 10 FROM customer WHERE c_acctbal < 0 GROUP BY 1) b ON a.sector = b.sector""")
def seed_reference(t):
    stored = t.customer.groupBy(F.col("c_mktsegment").alias("sector")).agg(F.count("*").alias("n"))
    rows = t.orders.groupBy(F.col("o_orderpriority").alias("sector")).agg(F.count("*").alias("n")).unionByName(
        t.customer.filter("c_acctbal < 0").groupBy(F.col("c_mktsegment").alias("sector")).agg((F.count("*") * 10).alias("n"))
    )
    return S.seed(stored, rows, "sector")


@query("a19_sync_insert", INSERT_ONLY)
def sync_insert(t):
    return S.sync_table(t.fx_source, t.fx_target, ["k"], update_existing=False)


@query("a19_sync_update", """
    SELECT k, grp, status, rows_cnt, note FROM fx_source
    UNION ALL SELECT k, grp, status, rows_cnt, note FROM fx_target WHERE k NOT IN (SELECT k FROM fx_source)""")
def sync_update(t):
    return S.sync_table(t.fx_source, t.fx_target, ["k"], update_existing=True)


@query("a19_partwise_sync", INSERT_ONLY)
def partwise_sync(t):
    table = _keyed(t)
    table.sync(t.fx_source, update_existing=False)
    return table.read()


@query("a20_schema_check", """
    SELECT 'status' AS "column", 'source_only' AS side, CAST(2 AS BIGINT) AS n
    UNION ALL SELECT 'rows_cnt', 'order', 3 UNION ALL SELECT 'note', 'order', 4 UNION ALL SELECT 'extra', 'target_only', 4
    UNION ALL SELECT 'grp', 'source_key', count(*) FROM (SELECT grp FROM fx_target GROUP BY grp HAVING count(*) > 1) a
    UNION ALL SELECT 'grp', 'target_key', count(*) FROM (SELECT grp FROM fx_source GROUP BY grp HAVING count(*) > 1) b""")
def schema_check(t):
    return S.sync_check(t.fx_target, t.fx_source.drop("status").withColumn("extra", F.lit(1)), ["grp"])


@query("a21_reconcile_counts", """
    SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM fx_run) AS target_rows,
           (SELECT count(*) FROM orders) = (SELECT count(*) FROM fx_run) AS matches
    UNION ALL SELECT 'rules', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM fx_rule WHERE break_msg = 'BREAKING'),
           (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM fx_rule WHERE break_msg = 'BREAKING')""")
def reconcile_counts(t):
    return S.reconcile_counts({"orders": (t.orders, t.fx_run), "rules": (t.lineitem, t.fx_rule.filter("break_msg = 'BREAKING'"))})


@query("a22_bi_export", """
    SELECT event_id, ts - INTERVAL 8 HOUR AS ts, value, concat('{"kind":"', event_type, '","user":', CAST(user_id AS STRING), '}') AS who
    FROM events""")
def bi_export(t):
    zoned = F.to_timestamp_ltz(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+08:00")), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXXX"))
    df = t.events.select("event_id", zoned.alias("ts"), "value", F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("who"))
    return W.bi_export(df)


@query("a23_flatten_struct", """
    SELECT o_orderkey AS "key", o_orderstatus AS "fields.status.name", o_orderpriority AS "fields.priority.name", o_custkey AS "fields.owner" FROM orders""")
def flatten_struct(t):
    fields = F.struct(
        F.struct(F.col("o_orderstatus").alias("name")).alias("status"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        F.col("o_custkey").alias("owner"),
    )
    return W.flatten_struct(t.orders.select(F.col("o_orderkey").alias("key"), fields.alias("fields")))


@query("a05_quarantine", """
    SELECT 'good' AS kind, o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS detail FROM orders WHERE o_custkey % 10 > 2
    UNION ALL SELECT 'bad', NULL, CASE o_custkey % 10 WHEN 0 THEN concat(o_orderkey, ',', o_custkey) WHEN 1 THEN concat('x', o_orderkey, ',', o_custkey, ',', o_orderstatus)
      ELSE concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',more') END FROM orders WHERE o_custkey % 10 <= 2""")
def quarantine(t):
    """Lines that are short, mistyped or long beside the good rows; nothing vanishes."""
    path = scratch_path(t.spark, "mixed-lines")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    short = F.concat_ws(",", "o_orderkey", "o_custkey")
    kind = F.col("o_custkey") % 10
    lines = F.when(kind == 0, short).when(kind == 1, F.concat(F.lit("x"), line)).when(kind == 2, F.concat(line, F.lit(",more"))).otherwise(line)
    t.orders.select(lines.alias("value")).write.text(path)
    good, bad = R.read_csv_checked(t.spark, path, StructType.fromDDL("k bigint, c bigint, s string"), header=False)
    return good.select(F.lit("good").alias("kind"), "k", F.col("c").cast("string").alias("detail")).unionByName(
        bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("bigint").alias("k"), F.col("line").alias("detail"))
    )


@query("a21_content_diff", """
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b' ELSE 'changed' END AS state
    FROM fx_target a FULL JOIN (SELECT CASE WHEN k % 500 = 2 THEN -k ELSE k END AS k, grp, CASE WHEN k % 300 = 1 THEN NULL ELSE status END AS status, rows_cnt, note FROM fx_target WHERE k % 400 <> 3) b ON a.k = b.k
    WHERE a.k IS NULL OR b.k IS NULL OR a.status IS DISTINCT FROM b.status""")
def content_diff(t):
    """The keys in which a changed copy of a table differs."""
    copy = t.fx_target.filter("k % 400 <> 3").withColumns({"k": F.when(F.col("k") % 500 == 2, -F.col("k")).otherwise(F.col("k")), "status": F.when(F.col("k") % 300 == 1, F.lit(None)).otherwise(F.col("status"))})
    other = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), ["k"], parts=8)
    other.create(copy)
    return differing_keys(_keyed(t), other)


@query("e02_latest_by_delta", """
    SELECT dataset, run_id, run_date, row_cnt, status FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, run_id DESC) AS rn FROM fx_run) q WHERE rn = 1""")
def latest_by_delta(t):
    """The newest run of each dataset, kept from three deltas that come out of order."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "latest"), ["dataset"], parts=8)
    table.create(t.fx_run.limit(0))
    for part in (2, 0, 1):
        table.merge_latest(t.fx_run.filter(F.col("run_id") % 3 == part), ["run_date", "run_id"])
    return table.read()
