import json
import os

from scoreflow.cli import build_parser, main
from scoreflow.plans.feature_store import materialize_feature_store
from scoreflow.session import scratch_path


def test_both_option_spellings():
    p = build_parser()
    a = p.parse_args(["train", "--feature_store_path", "f", "--model-registry-path", "m", "--metrics_path", "x", "--sampling-ratio", "1.5"])
    assert (a.feature_store_path, a.model_registry_path, a.sampling_ratio) == ("f", "m", 1.5)


def test_train_job_end_to_end(spark, sf_small, capsys):
    fs = materialize_feature_store(spark, sf_small)
    root = scratch_path(spark, "t_cli")
    rc = main(["train", "--feature_store_path", fs, "--model_registry_path", f"{root}/reg", "--metrics_path", f"{root}/met",
               "--as_of", "2001-08-01", "--num_trees", "5", "--run_tag", "cli", "--sampling_ratio", "1.5"])
    assert rc == 0
    row = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert row["run_tag"] == "cli" and 0 <= row["auc"] <= 1
    assert spark.read.json(f"{root}/met/cli").count() == 1
    assert os.path.isdir(f"{root}/reg/cli/pipeline".replace("file:", ""))


def test_features_then_train(spark, sf_small, capsys):
    root = scratch_path(spark, "t_cli_chain")
    assert main(["features", "--input_path", sf_small, "--output-path", f"{root}/fs", "--run_tag", "r1"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["rows"] == spark.read.parquet(f"{sf_small}/orders.parquet").count()
    assert main(["train", "--feature_store_path", f"{root}/fs", "--model_registry_path", f"{root}/reg",
                 "--metrics_path", f"{root}/met", "--as_of", "2001-08-01", "--num_trees", "3", "--run_tag", "r1"]) == 0


def test_export_job(spark, sf_small, capsys):
    from scoreflow.plans.export import daily_window, read_export
    from scoreflow.plans.fixtures import response_log

    log = response_log(spark, sf_small)
    log.createOrReplaceTempView("t_cli_response_log")
    root = scratch_path(spark, "t_cli_export")
    assert main(["export", "--source", "t_cli_response_log", "--export-root", root, "--job_datetime", "2024-01-05T20:00:00Z"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    expected = daily_window(log, "2024-01-05T20:00:00")[0].count()
    assert report["rows"] == expected and report["target"].endswith("EXPORT_DT=20240105")
    assert read_export(spark, root, "20240105").count() == expected


def test_lake_to_db_dry_run_opens_no_connection(spark, sf_small, capsys):
    from scoreflow.plans.fixtures import customer_snapshot
    from scoreflow.sources.sql_files import packaged_sql

    customer_snapshot(spark, sf_small, "20240101").createOrReplaceTempView("t_cli_snapshot")
    rc = main([
        "lake-to-db", "--jdbc_url", "jdbc:nowhere:db", "--jdbc_driver", "no.such.Driver",
        "--sql_file", packaged_sql("extract_dataset.sql"),
        "--param", "source_table=t_cli_snapshot", "--param", "data_dt=20240101",
        "--table", "TARGET.CUSTOMER_SNAPSHOT", "--write_mode", "append",
        "--pre_ins_sql_file_path", packaged_sql("prep_dataset.sql"), "--pre_param", "20240101",
        "--is_dryrun", "true", "--num_partitions", "2",
    ])
    assert rc == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report == {"target": "TARGET.CUSTOMER_SNAPSHOT", "mode": "append",
                      "rows": spark.read.parquet(f"{sf_small}/customer.parquet").count(), "is_dryrun": True}


def test_gate_job(spark, sf_small, capsys):
    from scoreflow.plans.fixtures import activity_log

    activity_log(spark, sf_small).createOrReplaceTempView("t_cli_activity_log")
    assert main(["gate", "--log_source", "t_cli_activity_log", "--activities", "click, error,absent", "--day", "2024-01-15"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sorted(res["completed"] + res["pending"]) == ["absent", "click", "error"]
    assert "absent" in res["pending"] and res["all_completed"] is False


def test_jobs_leave_master_and_partitions_to_spark_submit(spark, sf_small, monkeypatch, capsys):
    import scoreflow.session as session

    seen = {}

    def build(**kw):
        seen.update(kw)
        return spark

    monkeypatch.setattr(session, "build_session", build)
    log = spark.createDataFrame([("a start", None)], "activity_name string, created_date timestamp")
    log.createOrReplaceTempView("t_cli_empty_log")
    gate = ["gate", "--log_source", "t_cli_empty_log", "--activities", "a", "--day", "2024-01-15"]
    assert main(gate) == 0 and seen == {"master": None, "shuffle_partitions": None, "extra": None}
    assert main([*gate, "--shuffle_gb", "1000", "--executors", "100", "--cores_per_executor", "4"]) == 0
    assert seen["extra"]["spark.sql.shuffle.partitions"] == str(-(-10**12 // (256 << 20)))


def test_a_jdbc_read_must_be_split_or_say_otherwise(spark, tmp_path):
    import pytest

    sql = tmp_path / "q.sql"
    sql.write_text("SELECT 1 AS a")
    args = ["db-to-lake", "--jdbc_url", "jdbc:nowhere:x", "--jdbc_driver", "no.such.Driver", "--sql_file", str(sql),
            "--target_path", str(tmp_path / "t"), "--data_dt", "20240101", "--write_mode", "append"]
    with pytest.raises(SystemExit, match="partition_column"):
        main(args)


def test_one_day_of_features(spark, sf_small, capsys):
    root = scratch_path(spark, "t_cli_day")
    day = spark.read.parquet(f"{sf_small}/orders.parquet").selectExpr("cast(min(o_orderdate) as date)").first()[0]
    for tag in ("r1", "r2"):
        assert main(["features", "--input_path", sf_small, "--output_path", f"{root}/fs", "--run_tag", tag, "--day", str(day)]) == 0
    back = spark.read.parquet(f"{root}/fs")
    assert {(r.snapshot_date, r.run_tag) for r in back.collect()} == {(day, "r2")}


def test_day_store_jobs(spark, sf_small, capsys):
    from scoreflow.plans.daily_store import read_daily_store

    root = scratch_path(spark, "t_cli_days")
    day = spark.read.parquet(f"{sf_small}/orders.parquet").selectExpr("cast(min(o_orderdate) as date)").first()[0]
    for tag in ("r1", "r2"):
        assert main(["features", "--input_path", sf_small, "--output_path", root, "--run_tag", tag, "--day", str(day), "--day-store", "true"]) == 0
    assert main(["compact-features", "--output_path", root, "--before", "2030-01-01", "--vacuum_keep", "1"]) == 0
    done = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert done == {"version": 2, "folders": 1, "removed": 2}
    assert {(r.snapshot_date, r.run_tag) for r in read_daily_store(spark, root).collect()} == {(day, "r2")}


def test_compact_bronze_job(spark, sf_small, capsys):
    from scoreflow.plans.fixtures import stage_envelopes
    from scoreflow.streaming.bronze import envelope_file_source
    from scoreflow.streaming.bronze_store import read_bronze_store, start_bronze_store

    root = scratch_path(spark, "t_cli_bronze")
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", 400)
    start_bronze_store(envelope_file_source(spark, landing, 3), f"{root}/s", f"{root}/c", available_now=True).awaitTermination()
    rows = read_bronze_store(spark, f"{root}/s").count()
    assert main(["compact-bronze", "--target", f"{root}/s", "--vacuum-keep", "1"]) == 0
    done = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert done["version"] == 0 and done["removed"] > 0
    assert read_bronze_store(spark, f"{root}/s").count() == rows == spark.read.parquet(landing).count()
