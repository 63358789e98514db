"""JDBC option maps (no database is started in this repository)."""

import datetime as dt

import pytest

from scoreflow.sinks.jdbc import jdbc_write_options, run_statements
from scoreflow.sources.jdbc import JdbcConfig, JdbcPartitioning, jdbc_read_options

CFG = JdbcConfig(url="jdbc:postgresql://db/x", driver="org.postgresql.Driver", user="u", password="p")


def test_query_read_is_single_partition():
    opts = jdbc_read_options(CFG, query="SELECT a FROM t;")
    assert opts["query"] == "SELECT a FROM t" and "dbtable" not in opts
    assert opts["preferTimestampNTZ"] == "true"


def test_partitioned_query_becomes_derived_table():
    opts = jdbc_read_options(CFG, query="SELECT a FROM t", partitioning=JdbcPartitioning("a", 0, 100, 8))
    assert opts["dbtable"] == "(SELECT a FROM t) scoreflow_q"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("a", "0", "100", "8")
    assert "query" not in opts


def test_exactly_one_source():
    with pytest.raises(ValueError):
        jdbc_read_options(CFG)
    with pytest.raises(ValueError):
        jdbc_read_options(CFG, query="q", table="t")


def test_write_options_spell_batchsize():
    opts = jdbc_write_options(CFG, "TARGET.T", num_partitions=4, batchsize=10_000)
    assert opts["batchsize"] == "10000" and opts["truncate"] == "true" and opts["numPartitions"] == "4"


def test_dry_run_opens_no_connection(spark):
    bad = JdbcConfig(url="jdbc:nowhere:x", driver="no.such.Driver")
    assert run_statements(spark, bad, [("DELETE FROM t WHERE d = ?", ["20240101"])], is_dryrun=True) == []


def test_name_case(spark):
    from scoreflow.sources.jdbc import with_name_case

    df = spark.createDataFrame([(1, 2)], "customer_id int, Data_Dt int")
    assert with_name_case(df, "upper").columns == ["CUSTOMER_ID", "DATA_DT"]
    assert with_name_case(df, "lower").columns == ["customer_id", "data_dt"]
    assert with_name_case(df, None).columns == ["customer_id", "Data_Dt"]
    with pytest.raises(ValueError):
        with_name_case(spark.createDataFrame([(1, 2)], "a int, A int"), "lower")


def test_a_write_needs_its_connection_count():
    with pytest.raises(TypeError):
        jdbc_write_options(CFG, "TARGET.T")
    with pytest.raises(ValueError):
        jdbc_write_options(CFG, "TARGET.T", num_partitions=0)


def test_partition_count_follows_the_rows_without_a_cap():
    from scoreflow.sources.jdbc import partitions_for

    assert [partitions_for(n) for n in (None, 0, 1, 2_500_001, 10**12)] == [1, 1, 1, 3, 1_000_000]


def test_quantile_predicates_hold_every_row_once():
    import duckdb

    from scoreflow.sources.jdbc import quantile_cuts_query, range_predicates

    # Most keys are small: equal strides would put nearly all rows in one task.
    keys = list(range(900)) + [10**9 + i for i in range(100)] + [None] * 7
    base = "SELECT * FROM (VALUES " + ", ".join("(NULL)" if k is None else f"({k})" for k in keys) + ") t(k)"
    con = duckdb.connect()
    lows = [r[1] for r in con.sql(quantile_cuts_query(base, "k", 10)).fetchall()]
    counts = [con.sql(f"SELECT count(*) FROM ({base}) q WHERE {p}").fetchall()[0][0] for p in range_predicates("k", lows)]
    assert sum(counts) == len(keys) and len(counts) == 10 and max(counts) <= 107
    assert range_predicates("k", []) == range_predicates("k", [5, 5]) == ["1 = 1"]
    assert range_predicates("d", ["a'b", "c"])[-1] == "d >= 'c'"


def test_gate_query_aggregates_in_the_database():
    import duckdb

    from scoreflow.sources.jdbc import activity_marks_query

    con = duckdb.connect()
    con.sql("CREATE TABLE log AS SELECT * FROM (VALUES ('Load START', TIMESTAMP '2024-01-15 01:00'), ('load start', "
            "TIMESTAMP '2024-01-15 02:00'), ('load finish', TIMESTAMP '2024-01-16 01:00'), ('other start', "
            "TIMESTAMP '2024-01-15 01:00')) t(activity_name, created_date)")
    query = activity_marks_query("log", ["LOAD", "it's"], dt.date(2024, 1, 15))
    assert [(n, t.hour) for n, t in con.sql(query).fetchall()] == [("load start", 2)]


def test_gate_day_is_a_half_open_range_of_the_bare_column():
    import duckdb

    from scoreflow.sources.jdbc import activity_marks_query

    query = activity_marks_query("log", ["a"], dt.date(2024, 2, 29))
    assert "created_date >= TIMESTAMP '2024-02-29 00:00:00' AND created_date < TIMESTAMP '2024-03-01 00:00:00'" in query
    assert "CAST(" not in query
    con = duckdb.connect()
    con.sql("CREATE TABLE log AS SELECT * FROM (VALUES ('a start', TIMESTAMP '2024-02-29 00:00:00'), "
            "('a finish', TIMESTAMP '2024-03-01 00:00:00'), ('A Finish', TIMESTAMP '2024-02-29 23:59:59.999999')) t(activity_name, created_date)")
    assert [(n, t.day) for n, t in sorted(con.sql(query).fetchall())] == [("a finish", 29), ("a start", 29)]


def test_driver_is_optional():
    opts = jdbc_read_options(JdbcConfig(url="jdbc:postgresql://db/x"), table="t")
    assert "driver" not in opts and opts["url"] == "jdbc:postgresql://db/x"


def test_atomic_slice_replace_dry_run_opens_nothing(spark):
    from scoreflow.sinks.jdbc import replace_slice_jdbc

    bad = JdbcConfig(url="jdbc:nowhere:x", driver="no.such.Driver")
    df = spark.range(7).withColumnRenamed("id", "customer_id")
    rep = replace_slice_jdbc(
        spark, df, bad, "TARGET.T", "DATA_DT", "20240101", "TARGET.T_STAGE", num_partitions=3, is_dryrun=True
    )
    assert (rep.target, rep.mode, rep.rows, rep.is_dryrun) == ("TARGET.T", "replace_slice", 7, True)


def test_slice_replace_steps_keep_their_settings():
    from scoreflow.sinks.jdbc import TransactionStep, WriteStep, slice_replace_steps

    write, swap = slice_replace_steps(
        CFG, "T.MAIN", ["id", "data_dt"], "data_dt", "20240101", "T.STAGE", num_partitions=8, batchsize=10_000
    )
    assert isinstance(write, WriteStep) and isinstance(swap, TransactionStep)
    assert write.mode == "overwrite" and write.options["dbtable"] == "T.STAGE" and write.options["truncate"] == "true"
    assert (write.options["numPartitions"], write.options["batchsize"]) == ("8", "10000")
    assert swap.statements == (
        ("DELETE FROM T.MAIN WHERE data_dt = ?", ("20240101",)),
        ("INSERT INTO T.MAIN (id, data_dt) SELECT id, data_dt FROM T.STAGE", ()),
    )
    for wrong in ({"num_partitions": 0}, {"num_partitions": 2, "batchsize": 0}):
        with pytest.raises(ValueError):
            slice_replace_steps(CFG, "T.MAIN", ["id"], "d", 1, "T.STAGE", **wrong)
    with pytest.raises(ValueError, match="staging"):
        slice_replace_steps(CFG, "T.MAIN", ["id"], "d", 1, "t.main", num_partitions=1)


def test_settings_of_a_write_go_by_name_alone(spark):
    from scoreflow.sinks.jdbc import jdbc_write_options, replace_slice_jdbc, slice_replace_steps, write_jdbc

    df = spark.range(1)
    for call in (
        lambda: jdbc_write_options(CFG, "T", 4),
        lambda: write_jdbc(df, CFG, "T", "append", 4),
        lambda: write_jdbc(df, CFG, "T", "append"),
        lambda: slice_replace_steps(CFG, "T", ["id"], "d", 1, "S", 4),
        lambda: replace_slice_jdbc(spark, df, CFG, "T", "d", 1, "S", 4),
        lambda: replace_slice_jdbc(spark, df, CFG, "T", "d", 1, "S"),
    ):
        with pytest.raises(TypeError):
            call()


def test_a_slice_load_runs_its_steps_in_order(spark, monkeypatch):
    """The whole load with the two calls that reach a database recorded."""
    import scoreflow.sinks.jdbc as sink

    seen = []

    def write(df, step, **counts):
        seen.append(step)
        return df.agg(sink.F.count(sink.F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]).first().asDict()

    monkeypatch.setattr(sink, "_write_frame", write)
    monkeypatch.setattr(sink, "run_statements", lambda spark, config, statements: seen.append(statements))
    df = spark.createDataFrame([(1, "20240101"), (2, "20240101")], "id int, data_dt string")
    load = lambda df, **kw: sink.replace_slice_jdbc(
        spark, df, CFG, "T.MAIN", "DATA_DT", "20240101", "T.STAGE", num_partitions=8, batchsize=500, **kw
    )
    report = load(df, name_case="upper")
    assert (report.rows, report.is_dryrun) == (2, False)
    write_step, statements = seen
    assert (write_step.options["numPartitions"], write_step.options["batchsize"]) == ("8", "500")
    assert [s for s, _ in statements] == [
        "DELETE FROM T.MAIN WHERE DATA_DT = ?",
        "INSERT INTO T.MAIN (ID, DATA_DT) SELECT ID, DATA_DT FROM T.STAGE",
    ]
    # Rows of another slice stop the load before the target is touched.
    seen.clear()
    other = df.unionByName(spark.createDataFrame([(3, "20240102"), (4, None)], "id int, data_dt string"))
    for kw in ({}, {"is_dryrun": True}):
        with pytest.raises(ValueError, match="2 rows are not of the slice"):
            load(other, **kw)
    assert len(seen) == 1 and isinstance(seen[0], sink.WriteStep)


def test_lake_to_db_passes_the_settings_on(spark, monkeypatch):
    import scoreflow.plans.loads as loads

    seen = {}
    monkeypatch.setattr(loads, "run_sql_file", lambda *a, **k: spark.range(1))
    monkeypatch.setattr(loads, "write_jdbc", lambda df, config, table, mode, **kw: seen.update(kw))
    monkeypatch.setattr(loads, "run_statements", lambda *a: None)
    loads.lake_to_db(spark, "f.sql", {}, CFG, "T", "append", num_partitions=8, batchsize=77)
    assert (seen["num_partitions"], seen["batchsize"]) == (8, 77)


def test_rows_that_arrive_during_a_read_are_left_for_the_next():
    """Cuts and high-water mark, then late rows, then the reads: what was
    counted comes back once, and the next load takes the rest."""
    import duckdb

    from scoreflow.sources.jdbc import predicates_from_cuts, quantile_cuts_query, rows_after

    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT range AS k, range % 7 AS v FROM range(1000)")
    con.sql("INSERT INTO t VALUES (NULL, 1), (NULL, 2)")
    cuts = [(low, high) for _, low, high in con.sql(quantile_cuts_query("SELECT * FROM t", "k", 8)).fetchall()]
    read = predicates_from_cuts("k", cuts)
    assert len(read.predicates) == 8 and read.high_water == 999
    con.sql("INSERT INTO t SELECT 1000 + range, 0 FROM range(500)")
    got = [k for p in read.predicates for (k,) in con.sql(f"SELECT k FROM (SELECT * FROM t) q WHERE {p}").fetchall()]
    assert sorted(got, key=str) == sorted([*range(1000), None, None], key=str)
    late = con.sql(rows_after("SELECT * FROM t;", "k", read.high_water)).fetchall()
    assert sorted(k for k, _ in late) == list(range(1000, 1500))
    assert rows_after("SELECT 1;", None, None) == "SELECT 1"
    # One value; no value at all.
    assert predicates_from_cuts("k", [(5, 5)]).predicates == ("k <= 5 OR k IS NULL",)
    assert predicates_from_cuts("k", []).predicates == ("k IS NULL",)


def test_marks_of_time_columns_are_quoted():
    from scoreflow.sources.jdbc import predicates_from_cuts

    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    read = predicates_from_cuts("ts", [(t[0], t[1]), (t[2], t[3])])
    assert read.predicates[-1] == "ts >= '2024-01-03 00:00:00' AND ts <= '2024-01-04 00:00:00'"
