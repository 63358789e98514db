import pytest
from pyspark.sql import functions as F

from scoreflow.plans.loads import frame_to_lake
from scoreflow.session import scratch_path
from scoreflow.sinks.lake import read_date_partitioned
from scoreflow.sources.parquet import read_merged
from scoreflow.sources.sql_files import bind_sql_file, packaged_sql, run_sql_file, sql_markers


def _frame(spark, n, tag):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(tag).alias("v"))


def test_overwrite_replaces_only_its_date(spark):
    base = scratch_path(spark, "t_lake")
    frame_to_lake(_frame(spark, 5, "a"), base, "20240101", "overwrite")
    frame_to_lake(_frame(spark, 7, "b"), base, "20240102", "overwrite")
    for _ in range(2):  # idempotent re-run
        rep = frame_to_lake(_frame(spark, 3, "c"), base, "20240102", "overwrite")
    assert rep.rows == 3 and not rep.is_dryrun
    got = {r["data_dt"]: r["n"] for r in read_date_partitioned(spark, base).groupBy("data_dt").agg(F.count("*").alias("n")).collect()}
    assert got == {"20240101": 5, "20240102": 3}


def test_append_and_dry_run(spark):
    base = scratch_path(spark, "t_lake")
    frame_to_lake(_frame(spark, 4, "a"), base, "20240101", "append")
    frame_to_lake(_frame(spark, 4, "a"), base, "20240101", "append")
    dry = frame_to_lake(_frame(spark, 9, "z"), base, "20240102", "overwrite", is_dryrun=True)
    assert dry.rows == 9 and dry.is_dryrun
    df = read_date_partitioned(spark, base)
    assert df.count() == 8
    with pytest.raises(ValueError):
        frame_to_lake(_frame(spark, 1, "a"), base, "20240101", "upsert")


def test_slice_filter_prunes_partitions(spark):
    base = scratch_path(spark, "t_lake")
    frame_to_lake(_frame(spark, 2, "a"), base, "20240101", "overwrite")
    frame_to_lake(_frame(spark, 2, "b"), base, "20240102", "overwrite")
    q = read_date_partitioned(spark, base).filter(F.col("data_dt") == "20240102")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DATA_DT" in plan
    assert q.count() == 2


def test_merge_schema(spark):
    base = scratch_path(spark, "t_merge")
    frame_to_lake(_frame(spark, 2, "a").drop("v"), base, "20240101", "overwrite")
    frame_to_lake(_frame(spark, 3, "b"), base, "20240102", "overwrite")
    df = read_merged(spark, base)
    assert set(df.columns) == {"k", "v", "DATA_DT"}
    assert df.filter(F.col("v").isNull()).count() == 2


def test_sql_file_markers_and_missing_parameter(spark, tmp_path):
    assert sql_markers("SELECT ':x', `:y` FROM t WHERE a = :a AND b::int = :b -- :c") == {"a", "b"}
    p = tmp_path / "q.sql"
    p.write_text("SELECT * FROM IDENTIFIER(:t) WHERE s = :s;")
    with pytest.raises(KeyError):
        bind_sql_file(spark, str(p), {"t": "x"})
    spark.createDataFrame([("a;b", 1), ("c", 2)], "s string, n int").createOrReplaceTempView("t_sqlfile")
    out = run_sql_file(spark, str(p), t="t_sqlfile", s="a;b").collect()
    assert [r["n"] for r in out] == [1]


def test_packaged_sql_files_exist():
    for name in ("extract_dataset.sql", "select_dataset.sql", "prep_dataset.sql"):
        assert open(packaged_sql(name)).read().strip()


def test_split_sql_statements_respects_literals():
    from scoreflow.sources.sql_files import split_sql_statements

    text = "DELETE FROM t WHERE a = 'x;y'; -- note; here\n/* c; */ INSERT INTO \"s;t\" VALUES ('it''s;'); ;  \n-- only comment"
    assert split_sql_statements(text) == [
        "DELETE FROM t WHERE a = 'x;y'",
        "-- note; here\n/* c; */ INSERT INTO \"s;t\" VALUES ('it''s;')",
    ]


def test_read_statements_binds_markers(spark):
    from scoreflow.sources.sql_files import packaged_sql, read_statements

    stmts = read_statements(spark, packaged_sql("prep_dataset.sql"), ["20240101"])
    assert len(stmts) == 1 and stmts[0][1] == ["20240101"] and stmts[0][0].startswith("-- Pre-load")


def test_bind_literals_for_database_sql():
    import datetime as dt

    from scoreflow.sources.sql_files import bind_literals

    text = "SELECT a, ':x' AS lit FROM t WHERE d = :data_dt AND n > :n AND s = :s -- :ignored\nAND day = :day"
    out = bind_literals(text, {"data_dt": "20240101", "n": 3, "s": "o'neil", "day": dt.date(2024, 1, 1)})
    assert out == "SELECT a, ':x' AS lit FROM t WHERE d = '20240101' AND n > 3 AND s = 'o''neil' -- :ignored\nAND day = DATE '2024-01-01'"
    with pytest.raises(KeyError):
        bind_literals("SELECT :missing", {})


def test_empty_overwrite_empties_its_date_only(spark):
    base = scratch_path(spark, "t_lake")
    frame_to_lake(_frame(spark, 5, "a"), base, "20240101", "overwrite")
    frame_to_lake(_frame(spark, 7, "b"), base, "20240102", "overwrite")
    report = frame_to_lake(_frame(spark, 0, "c"), base, "20240102", "overwrite")
    assert report.rows == 0
    back = read_date_partitioned(spark, base)
    assert [r.data_dt for r in back.collect()] == ["20240101"] * 5
    with pytest.raises(ValueError):
        frame_to_lake(_frame(spark, 1, "a"), base, "2024/01", "overwrite")


def test_export_keeps_every_text(spark):
    from scoreflow.plans.export import daily_export, read_export

    texts = [
        "  padded  ", "a\nb", "a\r\nb\rc", "", None, '"', '""', 'x "y" z', "\\N", "\\\\N", "\\", "a,b", "\t", "#c", "é日本", "\n", " ", "\\n",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    df = df.withColumn("load_dt", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    root = scratch_path(spark, "t_export")
    report = daily_export(df, root, "2024-01-05T20:00:00")
    assert report.rows == len(texts)
    back = {int(r.id): r.t for r in read_export(spark, root, "20240105").collect()}
    assert back == dict(enumerate(texts))


def test_empty_export_day_reads_back_empty(spark):
    from scoreflow.plans.export import daily_export, read_export

    df = spark.createDataFrame([], "id int, load_dt timestamp_ntz")
    root = scratch_path(spark, "t_export")
    assert daily_export(df, root, "2024-01-05T20:00:00").rows == 0
    back = read_export(spark, root, "20240105")
    assert back.count() == 0 and back.columns == ["id", "load_dt"]


def test_feature_files_are_in_date_order(spark, sf_small):
    import glob

    import pyarrow.parquet as pq

    from scoreflow.plans.feature_store import feature_job

    path = scratch_path(spark, "t_sorted")
    feature_job(spark, sf_small, path, "t")
    files = glob.glob(f"{path.replace('file:', '')}/*/*.parquet")
    assert files
    for f in files:
        dates = pq.ParquetFile(f).read(["snapshot_date"]).column(0).to_pylist()
        assert dates == sorted(dates)


def test_export_files_are_bounded_by_bytes(spark):
    """Short and long rows, quotes and line ends: no file beyond the bound but
    those of a single row, and the same rows back."""
    import random

    from scoreflow.plans.export import daily_export, in_files, line_bytes, read_export

    rnd = random.Random(3)
    pieces = ['"', "\n", "é", "word ", ",", "\\N", " "]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 3, 40, 400])))) for i in range(800)]
    rows += [(9000 + i, "long " * 3000) for i in range(4)] + [(9100, None), (9101, "")]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("load_dt", F.lit("2024-01-05 03:00:00").cast("timestamp_ntz"))
    root, bound = scratch_path(spark, "bounded_export"), 10_000
    report = daily_export(df.repartition(3), root, "2024-01-06T20:00:00", "UTC", file_bytes=bound)
    folder = report.target
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("length", "content").collect()
    large = [f for f in files if f.length > bound]
    assert len(files) > 10 and report.rows == len(rows)
    assert len(large) == 4 and all(f.content.count(b"long long") and f.content.count(b"\n") == 2 for f in large)
    # Files are filled: about twice as many as the bytes need, not one per row.
    assert len(files) - 4 <= 2 * (sum(f.length for f in files) - sum(f.length for f in large)) // bound + 3
    back = read_export(spark, root, report.target.rsplit("=", 1)[-1])
    assert sorted((r.id, r.text) for r in back.collect()) == sorted((str(i), t) for i, t in rows)
    # The lengths that files are cut by are the bytes that are written.
    text = df.select(F.col("id").cast("string"), "text")
    path = scratch_path(spark, "lines")
    in_files(text, 1 << 20).write.options(**{"quoteAll": "true", "escape": '"', "nullValue": "\\N", "emptyValue": "", "lineSep": "\n"}).csv(path)
    written = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length").collect()
    assert len(written) == 1
    assert abs(written[0].length - text.agg(F.sum(line_bytes(text.columns))).first()[0]) <= 2 * len(rows)


def test_running_sums_of_an_export_take_no_texts(spark, monkeypatch):
    """Files are cut by the lines' lengths; no sum over all rows reads their
    texts, however many of them are equal."""
    from scoreflow.plans import export

    seen, sums = [], export.prefix_sums
    monkeypatch.setattr(export, "prefix_sums", lambda df, *args, **more: seen.append(df.dtypes) or sums(df, *args, **more))
    df = spark.createDataFrame([(str(i // 9), "same text " * 20) for i in range(600)] + [(None, None)] * 40, "id string, text string")
    out = export.in_files(df.repartition(5), 10_000)
    sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.sum(export.line_bytes(out.columns)).alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) <= 10_000
    assert len(seen) == 1 and all(t in ("int", "bigint") for _, t in seen[0])
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
