import pytest
from conftest import rows
from pyspark.sql import functions as F

from starrung import workspace
from starrung.operators import joins
from starrung.operators.copies import expand_copies
from starrung.operators.joins import heavy_keys, lookup, natural_anti_join, semi_join
from starrung.workspace import Workspace, measured


@pytest.fixture
def skewed(spark):
    """A third of the rows has key 0, some have no key, the others are spread."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97).alias("k"),
        F.col("id").alias("v"),
    )


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(k, f"t{k}") for k in [None, *range(0, 90, 2)]], "k bigint, t string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_shuffled_lookup_equals_broadcast_lookup(ws, skewed, table, how, request):
    small = rows(lookup(skewed, table, ["k"], how))
    request.getfixturevalue("no_broadcast")
    assert rows(lookup(skewed, table, ["k"], how)) == small
    assert rows(lookup(skewed, ws.keep(table, "t"), ["k"], how, ws=ws)) == small
    assert rows(lookup(skewed, table, ["k"], how, balanced=True)) == small
    given = lookup(skewed, table, ["k"], how, heavy=lambda: skewed.where("k = 0 or k is null").select("k").distinct().collect())
    assert rows(given) == small
    assert rows(lookup(skewed, table, ["k"], how, heavy=lambda: [])) == small


def test_null_matches_null(skewed, table):
    got = lookup(skewed, table, ["k"])
    assert got.where("k is null").select("t").distinct().collect()[0][0] == "tNone"
    assert got.count() == 3000


def test_plain_equality_unless_the_table_has_null_keys(skewed, table):
    for side in (table, table.where("k is not null")):
        joined = lookup(skewed, side, ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("coalesce(k" in plan) == (side is table)
        assert joined.where("t is null").count() == skewed.count() - lookup(skewed, side, ["k"], "inner").count()


def test_heavy_keys_are_bounded(skewed, no_broadcast):
    found = [r[0] for r in heavy_keys(skewed, ["k"])]
    assert len(found) == 5
    assert found[0] == 0


def test_lookup_avoids_cartesian_products_and_python(skewed, table, no_broadcast):
    plan = lookup(skewed, table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert "Union" in plan and "BroadcastHashJoin" in plan


def test_semi_join(ws, skewed, spark):
    keep = spark.createDataFrame([(0,), (0,), (None,)], "k bigint")
    assert semi_join(ws, skewed, keep, "k").count() == skewed.where("k = 0 or k is null").count()


def test_natural_anti_join_keeps_copies_and_matches_null(spark, ws):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(2, None), (3, "d"), (9, "z")], "k int, v string")
    assert rows(natural_anti_join(ws, left, right)) == [(1, "a"), (1, "a"), (3, "c")]


def test_natural_anti_join_on_shared_columns_only(spark, ws):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(2, 5)], "k int, w int")
    assert rows(natural_anti_join(ws, left, right)) == [(1, "a")]


def test_expand_copies_in_chunks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 0), ("d", 3), ("e", 6)], "k string, n bigint")
    for chunk in (1, 3, 100):
        got = expand_copies(df, "n", 17, chunk, task_rows=5).groupBy("k").count()
        assert rows(got) == [("a", 7), ("b", 1), ("d", 3), ("e", 6)]


@pytest.mark.parametrize("many, copies", [(400, 2500), (1, 1_000_000)])
def test_copies_come_from_many_tasks(spark, many, copies):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    grouped = spark.range(many * 2).groupBy((F.col("id") % many).alias("k")).agg((F.count("id") * copies / 2).cast("long").alias("n"))
    tasks = expand_copies(grouped, "n", many * copies).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 4 and sum(t["count"] for t in tasks) == many * copies
    assert max(t["count"] for t in tasks) < many * copies / 2


def test_a_local_folder_is_refused_on_a_cluster(tmp_path):
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": f"file://{tmp_path}"}

    session = Session()
    original = workspace._is_local
    try:
        workspace._is_local = lambda spark, root: root.startswith("file:")
        with pytest.raises(RuntimeError):
            workspace.shared_root(session)
        session.conf["spark.starrung.sharedMount"] = "true"
        assert workspace.shared_root(session) == f"file://{tmp_path}"
        session.conf = {"spark.checkpoint.dir": "hdfs://there/shared/"}
        assert workspace.shared_root(session) == "hdfs://there/shared"
    finally:
        workspace._is_local = original


class OnCluster:
    """The session under the name of a cluster's master, with settings of its own; of its ranges ``lost`` rows get lost."""

    def __init__(self, spark, conf, lost=0):
        class Java:
            def sc(self):
                return self

            def getCheckpointDir(self):  # none is set
                return self

            def isDefined(self):
                return False

            def hadoopConfiguration(self):
                return spark.sparkContext._jsc.hadoopConfiguration()

        class Context:
            master, _jsc = "spark://somewhere:7077", Java()

            def __getattr__(self, name):
                return getattr(spark.sparkContext, name)

        self.spark, self.conf, self.lost, self.tried, self.sparkContext = spark, conf, lost, 0, Context()

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def range(self, start, end, step, parts):
        self.tried += 1
        return self.spark.range(start, end - self.lost, step, parts)


def test_a_folder_that_all_executors_see_is_used_on_a_cluster(spark, tmp_path):
    session = OnCluster(spark, {"spark.checkpoint.dir": f"file://{tmp_path}/"})
    assert [workspace.shared_root(session) for _ in range(2)] == [f"file://{tmp_path}"] * 2
    assert session.tried == 1 and not list(tmp_path.iterdir())
    with Workspace(session) as ws:
        assert ws.keep(spark.range(10), "t").df.count() == 10


def test_the_warehouse_is_used_on_a_cluster_without_a_checkpoint_folder(spark, tmp_path):
    assert workspace.shared_root(OnCluster(spark, {"spark.sql.warehouse.dir": f"file://{tmp_path}"})) == f"file://{tmp_path}"
    assert workspace.shared_root(OnCluster(spark, {"spark.sql.warehouse.dir": "viewfs://there/tables",
                                                   "spark.starrung.sharedMount": "true"})) == "viewfs://there/tables"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(OnCluster(spark, {}))


def test_a_folder_in_which_rows_get_lost_is_refused_on_a_cluster(spark, tmp_path):
    conf = {"spark.checkpoint.dir": f"file://{tmp_path}"}
    for _ in range(2):
        with pytest.raises(RuntimeError, match="not seen alike"):
            workspace.shared_root(OnCluster(spark, conf, lost=1))
    assert workspace.shared_root(OnCluster(spark, conf)) == f"file://{tmp_path}"
    (tmp_path / "file").touch()
    with pytest.raises(RuntimeError, match="not seen alike"):  # no folder can be made there
        workspace.shared_root(OnCluster(spark, {"spark.checkpoint.dir": f"file://{tmp_path}/file"}))


def test_a_store_that_only_the_session_knows(spark, tmp_path):
    """Spark's readers and writers reach it, so a workspace does too."""
    link = f"fs.viewfs.mounttable.{tmp_path.name.replace('_', '-')}.link./kept"
    spark.conf.set(link, f"file://{tmp_path}")
    try:
        root = f"viewfs://{tmp_path.name.replace('_', '-')}/kept"
        assert workspace.shared_root(OnCluster(spark, {"spark.checkpoint.dir": root})) == root
        with Workspace(spark, root) as ws:
            assert ws.keep(spark.range(10), "t").df.count() == 10 and ws.intact() and list(tmp_path.iterdir())
        assert not list(tmp_path.iterdir())
    finally:
        spark.conf.unset(link)


def test_chained_lookups_read_their_input_once_per_level(spark, ws, skewed, no_broadcast):
    rows_ = ws.table(skewed, "rows")
    kept = semi_join(ws, semi_join(ws, rows_, rows_.where("v < 2000"), "k"), rows_.where("v < 1000"), "v")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 6  # rows and keys, once for what moves and once for what stays
    assert kept.count() == skewed.where("v < 1000").count()


def test_measured_size_decides(spark, monkeypatch):
    df = spark.range(1000).withColumn("s", F.lit("x" * 100))
    table = measured(df)
    size = table.bytes
    assert table.rows == 1000 and table.nulls == frozenset()
    assert 1000 * 108 <= size <= 1000 * 300
    monkeypatch.setattr(joins, "BROADCAST_BYTES", size - 1)
    assert not joins.is_small(table)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", size)
    assert joins.is_small(table)


def test_kept_tables_are_measured_and_released(spark):
    with Workspace(spark) as ws:
        kept = ws.keep(spark.range(10).where("id > 3"), "few")
        empty = ws.keep(spark.range(10).where("id > 30"), "none")
        assert (kept.rows, empty.rows, empty.bytes) == (6, 0, 0)
        assert kept.bytes >= 6 * 8
        path = ws.root
        assert empty.df.count() == 0
        parts = ws.table(spark.range(10).withColumn("odd", F.col("id") % 2 == 1), "parts", ("odd",))
        assert parts.where("odd").count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_sizes_are_computed_if_their_event_is_lost(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_observed", lambda seen: None)
    with Workspace(spark) as ws:
        kept = ws.keep(spark.range(10).select(F.when(F.col("id") > 3, F.col("id")).alias("x")), "t", total=F.sum("x"))
        assert (kept.rows, kept.nulls, kept.totals) == (10, frozenset({"x"}), {"total": 39})


def test_workspace_uses_the_folder_of_the_session(spark):
    assert Workspace(spark).root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_row_size_of_lists_structs_and_maps(spark):
    """By lengths, with what is missing or empty as the least."""
    df = spark.createDataFrame(
        [([1, 2, 3], ["ab", None, "é"], (1, "xyz"), [(5, [1, 2])], {"k": 1}, [[1], [], None]),
         ([], [], (None, None), [], {}, []),
         (None, None, None, None, None, None)],
        "a array<bigint>, b array<string>, c struct<x:int,y:string>, d array<struct<n:int,t:array<bigint>>>, "
        "e map<string,int>, f array<array<int>>")
    size = {c: [r[0] for r in df.select(workspace.row_bytes(df.select(c)) - workspace.ROW_OVERHEAD).collect()] for c in df.columns}
    assert size == {
        "a": [16 + 24, 16, 16],
        "b": [16 + 10 + 8 + 10, 16, 16],
        "c": [16 + 8 + 11, 16 + 8 + 8, 16 + 8 + 8],
        "d": [16 + (16 + 8 + 32), 16, 16],
        "e": [16 + 9 + 16 + 8, 32, 32],
        "f": [16 + 24 + 16 + 16, 16, 16],
    }
    plan = df.select(workspace.row_bytes(df))._jdf.queryExecution().executedPlan().toString()
    assert "to_json" not in plan and "structstojson" not in plan.lower()


def test_row_size_without_ansi_and_of_wide_numbers(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")  # the size of a missing list is -1 there
    try:
        df = spark.createDataFrame([(None,), ([1.5],)], "a array<double>")
        assert sorted(r[0] for r in df.select(workspace.row_bytes(df)).collect()) == [workspace.ROW_OVERHEAD + 16, workspace.ROW_OVERHEAD + 24]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    wide = spark.range(1).select(F.lit(1).cast("decimal(38,2)").alias("d"), F.lit(1).cast("decimal(9,2)").alias("s"))
    assert wide.select(workspace.row_bytes(wide)).first()[0] == workspace.ROW_OVERHEAD + 24 + 8
