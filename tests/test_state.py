"""Keyed merges, sinks and snapshots."""

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.operators import findings as O
from gaugeworks.operators import state as S
from gaugeworks.operators.store import KeyedTable, differing_keys
from gaugeworks.session import scratch_path
from gaugeworks.sources import readers as R
from gaugeworks.sources import writers as W


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def frame(spark, data, ddl="k int, a string, b string"):
    return spark.createDataFrame(data, ddl)


def test_untracked_change_is_kept_and_tracked_refreshes_all(spark):
    target = frame(spark, [(1, "x", "p"), (2, "y", "q")])
    source = frame(spark, [(1, "x", "new"), (2, "z", "new"), (3, "n", "new")])
    got = S.merge_upsert(target, source, ["k"], change_columns=["a"])
    assert rows(got, "k", "a", "b", "_action") == [(1, "x", "p", "keep"), (2, "z", "new", "update"), (3, "n", "new", "insert")]


def test_upsert_twice_changes_nothing(spark):
    target, source = frame(spark, [(1, "x", None)]), frame(spark, [(1, "y", "n"), (2, None, "m")])
    once = S.merge_upsert(target, source, ["k"]).drop("_action")
    again = S.merge_upsert(once, source, ["k"])
    assert rows(again, "k", "a", "b") == rows(once, "k", "a", "b")
    assert {r._action for r in again.collect()} == {"keep"}


def test_repeated_source_key_raises(spark):
    source = frame(spark, [(1, "x", "a"), (1, "y", "b")])
    with pytest.raises(Exception, match="twice"):
        S.merge_upsert(frame(spark, [(2, "x", "p")]), source, ["k"]).collect()


def test_partial_upsert_keeps_other_columns(spark):
    got = S.merge_partial(frame(spark, [(1, "x", "kept")]), frame(spark, [(1, "y"), (2, "z")], "k int, a string"), ["k"])
    assert rows(got, "k", "a", "b") == [(1, "y", "kept"), (2, "z", None)]
    with pytest.raises(ValueError):
        S.merge_partial(frame(spark, [(1, "x", "p")]), frame(spark, [("y",)], "a string"), ["k"])


def test_insert_only_matches_null_keys(spark):
    target, source = frame(spark, [(None, "x", "p")]), frame(spark, [(None, "y", "q"), (1, "b", "2"), (1, "a", "1")])
    got = S.merge_insert_only(target, source, ["k"], ["a"])
    assert rows(got, "k", "a", "b") == [(1, "a", "1"), (None, "x", "p")]


def test_prune_keeps_null_keys_and_absent_groups(spark):
    target = spark.createDataFrame([("g", 1), ("g", 2), ("g", None), ("h", 9)], "grp string, k int")
    source = spark.createDataFrame([("g", 1)], "grp string, k int")
    assert rows(S.prune_stale(target, source, ["grp"], ["k"]), "grp", "k") == [("g", 1), ("g", None), ("h", 9)]


def test_primary_key(spark):
    schema = StructType.fromDDL("k int, a string, c double")
    good = S.conform(frame(spark, [(1, "x", "y")]), schema, ["k"])
    assert good.columns == ["k", "a", "c"] and good.count() == 1
    for bad in ([(1, "x", "y"), (1, "z", "y")], [(None, "x", "y")]):
        with pytest.raises(Exception, match="null or repeated"):
            S.conform(frame(spark, bad), schema, ["k"]).collect()


def test_sync(spark):
    a, b = frame(spark, [(1, "n", "n"), (2, "n", "n")]), frame(spark, [(1, "o", "o"), (3, "o", "o")])
    assert rows(S.sync_table(a, b, ["k"], True), "k", "a") == [(1, "n"), (2, "n"), (3, "o")]
    assert rows(S.sync_table(a, b, ["k"], False), "k", "a") == [(1, "o"), (2, "n"), (3, "o")]
    with pytest.raises(ValueError):
        S.sync_table(a.drop("b"), b, ["k"], True)
    assert S.sync_check(a, b, ["k"]).count() == 0


def test_snapshot_is_staged_then_replaced(spark):
    policy = W.WritePolicy("snapshot", f"t_{uuid.uuid4().hex}")
    W.write_table(spark.createDataFrame([("ds_one", "2024-01-01")], "dataset string, run_date string"), policy)
    W.write_table(spark.createDataFrame([("ds_two", 5)], "dataset string, extra int"), policy)
    assert rows(spark.read.table(policy.table), "dataset", "run_date", "extra") == [("ds_two", None, 5)]
    failing = spark.createDataFrame([("x",)], "dataset string").withColumn("extra", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        W.write_table(failing, policy)
    assert rows(spark.read.table(policy.table), "dataset", "extra") == [("ds_two", 5)]
    W.write_table(spark.read.table(policy.table).filter(F.lit(False)), policy)
    assert spark.read.table(policy.table).count() == 0


def test_partial_upsert_keeps_other_columns_and_rows(spark):
    prefix = f"t_{uuid.uuid4().hex}_"
    first = spark.createDataFrame([("a", "r1", "u1"), ("b", "r2", "u2")], "dataset string, region string, business_unit string")
    where = W.write_output(first, "business_unit_mapping", [W.Target("table")], prefix)
    W.write_output(spark.createDataFrame([("a", "new"), ("c", "r3")], "dataset string, region string"), "business_unit_mapping", [W.Target("table")], prefix)
    got = rows(spark.read.table(where["table"]), "dataset", "region", "business_unit")
    assert got == [("a", "new", "u1"), ("b", "r2", "u2"), ("c", "r3", None)]
    for bad in ([(None, "x")], [("a", "x"), ("a", "y")]):
        with pytest.raises(Exception, match="null or occurs twice"):
            W.write_output(spark.createDataFrame(bad, "dataset string, region string"), "business_unit_mapping", [W.Target("table")], prefix)


def test_null_keys_raise_on_both_sides(spark):
    good, bad = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(None, "x")], "k int, v string")
    with pytest.raises(Exception, match="null"):
        S.merge_upsert(good, bad, ["k"]).collect()
    with pytest.raises(Exception, match="stored key is null"):
        S.merge_upsert(bad, good, ["k"]).collect()


def test_csv_keeps_line_breaks(spark):
    texts = ["a\nb", "\r\n", "back\\nslash \\\\", ' "quoted", ', "", None, "\\", "x\ty"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = scratch_path(spark, "test-csv")
    W.write_csv(df, path)
    assert [t for _, t in sorted(tuple(r) for r in R.read_csv(spark, path, df.schema).collect())] == texts


def test_duplicate_columns_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a")
    with pytest.raises(ValueError):
        S.snapshot_replace(df, spark.createDataFrame([(1,)], "a int"))


def test_write_dispatch(spark):
    assert W.policy_for("business_unit_mapping", "auto_") == W.WritePolicy("upsert", "auto_business_unit_mapping", ("dataset",))
    assert W.policy_for("dataset_definitions", "").kind == "skip"
    assert W.policy_for("New Ticket-List", "auto_").table == "auto_new_ticket_list"
    assert W.policy_for("x", "auto_", {"x": "other.table"}).table == "other.table"
    df = spark.createDataFrame([("ds_one", ["a"])], "dataset string, tags array<string>")
    root = scratch_path(spark, "test-output")
    where = W.write_output(df, "dataset_definitions", [W.Target("csv", root), W.Target("table", root)], "t_")
    assert set(where) == {"csv"}
    back = R.read_csv(spark, where["csv"], StructType.fromDDL("dataset string, tags string"))
    assert rows(back, "dataset", "tags") == [("ds_one", '["a"]')]


def test_source_order(spark):
    schema = StructType.fromDDL("a int")
    path = scratch_path(spark, "test-source")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    missing = R.Source(options={"path": path + "-none"})
    assert R.read_first_available(spark, [missing, R.Source(options={"path": path})]).count() == 1
    with pytest.raises(AnalysisException):
        R.read_first_available(spark, [missing])
    assert R.read_or_empty(spark, missing, schema).count() == 0
    with pytest.raises(Exception, match="no_such_format"):
        R.read_or_empty(spark, R.Source(fmt="no_such_format", options={"path": path}), schema)


def test_override_and_missing_columns(spark):
    left = spark.createDataFrame([("a", "old", None), (None, "n", "n")], "dataset string, x string, y string")
    right = spark.createDataFrame([("a", None, "new", 1), ("a", "late", "late", 2), (None, "q", None, 1)], "dataset string, x string, y string, ord int")
    got = O.enrich_override(left, right, "dataset", ["x", "y"], ["ord"])
    assert rows(got, "dataset", "x", "y") == [("a", "old", "new"), (None, "q", "n")]
    added = O.enrich_missing(left.drop("y"), right, "dataset", ["ord"])
    assert rows(added, "dataset", "x", "y") == [("a", "old", "new"), (None, "n", None)]


def test_versions_switch_in_one_step(spark, tmp_path):
    name, place = f"v_{uuid.uuid4().hex}", str(tmp_path / "versions")
    assert W.current_version(spark, name) is None and W.drop_versions(spark, name, place) == []
    first = W.write_version(frame(spark, [(1, "x", "y")]), name, place)
    before = spark.read.table(name)
    failing = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken")).cast("int")).otherwise(1).alias("k"))
    with pytest.raises(Exception, match="broken"):
        W.write_version(failing, name, place)
    assert W.current_version(spark, name) == first and rows(spark.read.table(name), "k") == [(1,)]
    second = W.write_version(spark.createDataFrame([(2, 5.0)], "k int, c double"), name, place)
    assert rows(before, "k", "a", "b") == [(1, "x", "y")]  # whole, though read after the switch
    after = spark.read.table(name)
    assert after.columns == ["k", "c"] and rows(after, "k", "c") == [(2, 5.0)] and W.current_version(spark, name) == second
    gone = W.drop_versions(spark, name, place)
    assert first.rsplit("/", 1)[1] in gone and second.rsplit("/", 1)[1] not in gone and rows(spark.read.table(name), "k") == [(2,)]
    spark.sql(f"DROP VIEW {name}")


def test_snapshot_with_a_location_is_a_version(spark, tmp_path):
    policy = W.WritePolicy("snapshot", f"s_{uuid.uuid4().hex}")
    W.write_table(frame(spark, [(1, "x", "y")]), policy, str(tmp_path))
    reader = spark.read.table(policy.table)
    W.write_table(spark.createDataFrame([(2, True)], "k int, extra boolean"), policy, str(tmp_path))
    assert rows(reader, "k", "a") == [(1, "x")]
    assert rows(spark.read.table(policy.table), "k", "a", "b", "extra") == [(2, None, None, True)]
    merged = W.WritePolicy("upsert", policy.table, ("k",))
    W.write_table(spark.createDataFrame([(2, "new"), (3, "n")], "k int, a string"), merged, str(tmp_path))
    assert rows(spark.read.table(policy.table), "k", "a", "extra") == [(2, "new", True), (3, "n", None)]
    spark.sql(f"DROP VIEW {policy.table}")


def test_database_target_never_loses_rows_by_upsert(spark):
    with pytest.raises(ValueError, match="merged by key"):
        W.write_output(frame(spark, [(1, "x", "y")]), "business_unit_mapping", [W.Target("jdbc", options={"url": "jdbc:none:"})], "p_")


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def changed_parts(before, after):
    return {int(f.split("=")[1].split("/")[0]) for f, _ in set(before.items()) ^ set(after.items())}


def test_merges_rewrite_only_what_changes(spark, tmp_path):
    path = tmp_path / "keyed"
    table = KeyedTable(spark, str(path), ["k"], parts=16)
    table.create(spark.range(400).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("a"), (F.col("id") % 5).cast("string").alias("b")))
    before = files_of(path)
    assert table.upsert(frame(spark, [(7, "x", "2"), (8, "x", "3")])) == [] and files_of(path) == before  # nothing differs
    touched = table.upsert(frame(spark, [(7, "new", "2"), (8, "x", "3"), (1000, "in", None)]))
    after = files_of(path)
    assert changed_parts(before, after) == set(touched) == set(table.parts_of(frame(spark, [(7, "", ""), (1000, "", "")])))
    assert len(touched) <= 2 and rows(table.read().filter("k in (7, 8, 1000)"), "k", "a", "b") == [(1000, "in", None), (7, "new", "2"), (8, "x", "3")]
    assert table.read().count() == 401
    plan = table.read([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_part" in plan.replace("isnotnull(key_part", "key_part").replace("[key_part#", "[key_part") or "key_part" in plan.split("PartitionFilters")[1][:80]
    assert table.insert_only(frame(spark, [(7, "no", "no"), (None, "n", "n")]), ["a"]) and table.insert_only(frame(spark, [(7, "no", "no"), (None, "m", "m")]), ["a"]) == []
    assert table.read().count() == 402 and rows(table.read().filter("k is null"), "a") == [("n",)]
    with pytest.raises(Exception, match="twice"):
        table.upsert(frame(spark, [(1, "x", "a"), (1, "y", "b")]))
    with pytest.raises(Exception, match="null"):
        table.upsert(frame(spark, [(None, "x", "a")]))


def test_prune_and_partial_by_parts(spark, tmp_path):
    path = tmp_path / "keyed"
    table = KeyedTable(spark, str(path), ["k"], parts=8)
    data = [(i, "g" if i < 4 else "h", "kept") for i in range(40)]
    table.create(frame(spark, data))
    before = files_of(path)
    source = frame(spark, [(0, "g", ""), (2, "g", "")])
    touched = table.prune(source, ["a"])
    assert changed_parts(before, files_of(path)) == set(touched) == set(table.parts_of(frame(spark, [(1, "", ""), (3, "", "")])))
    assert rows(table.read(), "k", "a", "b") == sorted(((i, a, b) for i, a, b in data if i not in (1, 3)), key=str)
    assert table.prune(source, ["a"]) == []
    table.upsert_partial(spark.createDataFrame([(5, "z"), (99, "n")], "k int, a string"))
    assert rows(table.read().filter("k in (5, 99)"), "k", "a", "b") == [(5, "z", "kept"), (99, "n", None)]
    one = KeyedTable(spark, str(tmp_path / "one"), ["k"], parts=4)
    one.create(frame(spark, [(1, "g", "x")]))
    one.prune(frame(spark, [(2, "g", "")]), ["a"])
    assert one.read().count() == 0 and one.upsert(frame(spark, [(1, "g", "y")])) and rows(one.read(), "k", "b") == [(1, "y")]


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "f.csv").write_text('k,a,n\n1,"x, y",1.5\n2,short\nthree,z,1\n4,long,2.5,more\n5,\\N,\\N\n6,"a\\\\nb",oops\n7,"a\\nb",3\n')
    good, bad = R.read_csv_checked(spark, str(tmp_path / "f.csv"), StructType.fromDDL("k int, a string, n double"))
    assert rows(good, "k", "a", "n") == sorted([(1, "x, y", 1.5), (5, None, None), (7, "a\nb", 3.0)], key=str)
    lines = [r.line for r in bad.collect()]
    assert sorted(x.split(",")[0] for x in lines) == ["2", "4", "6", "three"] and bad.filter("file like '%f.csv'").count() == 4
    empty, none = R.read_csv_checked(spark, str(tmp_path / "f.csv"), StructType.fromDDL("k string, a string, n string, m string"))
    assert empty.count() + none.count() == 7


def test_differing_keys_read_only_differing_parts(spark, tmp_path):
    tables = []
    data = [(i, "x" if i % 3 else None, str(i)) for i in range(500)]
    other = [(i, "changed" if i == 17 else a, b) for i, a, b in data if i != 40] + [(900, "new", None)]
    for name, held in (("a", data), ("b", other), ("c", data)):
        table = KeyedTable(spark, str(tmp_path / name), ["k"], parts=16)
        table.create(frame(spark, held))
        tables.append(table)
    a, b, c = tables
    assert rows(differing_keys(a, b), "k", "state") == sorted([(17, "changed"), (40, "only_a"), (900, "only_b")], key=str)
    assert differing_keys(a, c).collect() == []
    parts = set(a.parts_of(frame(spark, [(17, "", ""), (40, "", ""), (900, "", "")])))
    for part in set(range(16)) - parts:  # equal parts are not read below the first level: without them the rows still compare
        assert a.checksums(["k", "a", "b"], [part]).collect() == b.checksums(["k", "a", "b"], [part]).collect()
    with pytest.raises(ValueError):
        differing_keys(a, KeyedTable(spark, str(tmp_path / "b"), ["k"], parts=8))


def test_latest_rows_by_delta_equal_a_full_computation(spark, tmp_path):
    path = tmp_path / "latest"
    table = KeyedTable(spark, str(path), ["k"], parts=8)
    first = [(i, f"2024-01-{i % 28 + 1:02d}", "v1") for i in range(60)]
    table.create(frame(spark, first))
    before = files_of(path)
    assert table.merge_latest(frame(spark, [(3, "2023-01-01", "older"), (4, None, "null"), (5, "2024-01-06", "equal")]), ["a"]) == [] and files_of(path) == before
    delta = [(3, "2024-02-01", "v2"), (3, "2024-02-03", "v3"), (70, "2024-01-01", "v1")]
    touched = table.merge_latest(frame(spark, delta), ["a"])
    assert changed_parts(before, files_of(path)) == set(touched) == set(table.parts_of(frame(spark, delta)))
    newest = {}
    for k, a, b in first + delta:
        newest[k] = max(newest.get(k, ("", "")), (a, b))
    assert rows(table.read(), "k", "a", "b") == sorted(((k, *v) for k, v in newest.items()), key=str)
