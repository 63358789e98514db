"""Command-line entry points for the jobs:

    python -m scoreflow.cli features --input_path ... --output_path ... --run_tag ...
    python -m scoreflow.cli train --feature_store_path ... --model_registry_path ... --metrics_path ...
    python -m scoreflow.cli export --source api_response_log --export_root ... --job_datetime ...
    python -m scoreflow.cli gate --log_source activity_log --activities load,score --day 2024-01-15
    python -m scoreflow.cli bronze --bootstrap_servers ... --topic ... --target ... --checkpoint ...
    python -m scoreflow.cli compact-bronze --target ... --vacuum_keep 2
    python -m scoreflow.cli compact-features --output_path ... --before 2024-02-01
    python -m scoreflow.cli db-to-lake --jdbc_url ... --jdbc_driver ... --sql_file ... --target_path ... --data_dt ...
    python -m scoreflow.cli lake-to-db --sql_file ... --param data_dt=20240101 --jdbc_url ... --table ...

Master, partition counts and the shared checkpoint folder come from
spark-submit. Every job also takes ``--shuffle_gb``, ``--executors`` and
``--cores_per_executor``, from which ``cluster_settings`` are set. A job's
scratch folders are removed when it ends.

Every ``--a_b`` option is also accepted as ``--a-b`` (a launcher that turns
``_`` into ``-`` cannot break a job). Database passwords are read from the
environment variable named by ``--jdbc_password_env``, never from the
command line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys


def _opt(parser: argparse.ArgumentParser, name: str, **kw) -> None:
    parser.add_argument(f"--{name}", f"--{name.replace('_', '-')}", dest=name, **kw)


def _bool(text: str) -> bool:
    return str(text).lower() in ("1", "true", "yes")


def _jdbc(args):
    from scoreflow.sources.jdbc import JdbcConfig

    password = os.environ.get(args.jdbc_password_env) if args.jdbc_password_env else None
    return JdbcConfig(url=args.jdbc_url, driver=args.jdbc_driver, user=args.jdbc_user, password=password)


def _jdbc_opts(p):
    _opt(p, "jdbc_url", required=True)
    _opt(p, "jdbc_driver", required=True)
    _opt(p, "jdbc_user")
    _opt(p, "jdbc_password_env")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="scoreflow")
    sub = parser.add_subparsers(dest="job", required=True)

    f = sub.add_parser("features", help="B1: raw loan tables to the feature table")
    _opt(f, "input_path", required=True, help="folder with orders, lineitem, customer, nation, region")
    _opt(f, "output_path", required=True)
    _opt(f, "run_tag", default="manual")
    _opt(f, "day", type=dt.date.fromisoformat, default=None, help="YYYY-MM-DD: build and replace this day only")

    _opt(f, "day_store", type=_bool, default=False, help="with --day: a store of days that compact-features turns into months")

    cf = sub.add_parser("compact-features", help="B1: closed months of a day store into one folder each")
    _opt(cf, "output_path", required=True)
    _opt(cf, "before", type=dt.date.fromisoformat, required=True, help="YYYY-MM-DD: months that end before this day are closed")
    _opt(cf, "vacuum_keep", type=int, default=0, help="remove folders that none of so many last versions names (0: keep all)")

    t = sub.add_parser("train", help="B2: credit-risk training run")
    _opt(t, "feature_store_path", required=True)
    _opt(t, "model_registry_path", required=True)
    _opt(t, "metrics_path", required=True)
    _opt(t, "training_window_months", type=int, default=6)
    _opt(t, "sampling_ratio", type=float, default=1.0)
    _opt(t, "run_tag", default="manual")
    _opt(t, "as_of", type=dt.date.fromisoformat, default=None)
    _opt(t, "num_trees", type=int, default=200)
    _opt(t, "seed", type=int, default=42)

    e = sub.add_parser("export", help="B6: previous local day of a table, as text")
    _opt(e, "source", required=True, help="catalog table/view name or path")
    _opt(e, "source_format", default="parquet")
    _opt(e, "export_root", required=True)
    _opt(e, "job_datetime", required=True, help="UTC trigger time, ISO 8601")
    _opt(e, "zone", default=None, help="IANA zone of the business day (default: the reference's zone)")
    _opt(e, "ts_column", default="load_dt")
    _opt(e, "format", default="csv")
    _opt(e, "is_dryrun", type=_bool, default=False)

    b = sub.add_parser("bronze", help="B5: Kafka topic to a bronze table")
    _opt(b, "bootstrap_servers", required=True)
    _opt(b, "topic", required=True)
    _opt(b, "target", required=True, help="table name or path")
    _opt(b, "checkpoint", required=True)
    _opt(b, "starting_offsets", default="earliest")
    _opt(b, "max_offsets_per_trigger", type=int, default=20_000)
    _opt(b, "security_protocol")
    _opt(b, "sasl_mechanism")
    _opt(b, "sasl_jaas_config_env")
    _opt(b, "min_partitions", type=int)
    _opt(b, "format", default="parquet")

    _opt(b, "compactable", type=_bool, default=False, help="target is the root of a store that compact-bronze compacts")

    cb = sub.add_parser("compact-bronze", help="B5: new batches of a bronze store into few files per day")
    _opt(cb, "target", required=True)
    _opt(cb, "file_mb", type=int, default=256)
    _opt(cb, "vacuum_keep", type=int, default=0, help="remove what none of so many last versions needs (0: keep all)")

    g = sub.add_parser("gate", help="B7: which activities completed on a day")
    _opt(g, "log_source", required=True, help="activity log: catalog table/view name, path, or database table with --jdbc_url")
    _opt(g, "jdbc_url", help="read --log_source from this database (the day filter is pushed into its query)")
    _opt(g, "jdbc_driver")
    _opt(g, "jdbc_user")
    _opt(g, "jdbc_password_env")
    _opt(g, "log_format", default="parquet")
    _opt(g, "activities", required=True, help="comma-separated activity names")
    _opt(g, "day", type=dt.date.fromisoformat, default=None, help="YYYY-MM-DD, default today in the session's time zone")
    _opt(g, "is_dryrun", type=_bool, default=False)

    d = sub.add_parser("db-to-lake", help="B3: JDBC query to a date folder")
    _jdbc_opts(d)
    _opt(d, "sql_file", required=True)
    _opt(d, "param", action="append", default=[], help="name=value for :name markers, repeatable")
    _opt(d, "target_path", required=True)
    _opt(d, "data_dt", required=True)
    _opt(d, "write_mode", choices=["overwrite", "append"], required=True)
    _opt(d, "partition_column", help="numeric, date or timestamp column the read is split on")
    _opt(d, "after", help="high-water mark of an earlier load: read only rows beyond it")
    _opt(d, "lower_bound")
    _opt(d, "upper_bound")
    _opt(d, "num_partitions", type=int, help="tasks of the read; with no bounds, cut at quantiles of the column")
    _opt(d, "single_task", type=_bool, default=False, help="read the whole result through one task")
    _opt(d, "is_dryrun", type=_bool, default=False)

    l = sub.add_parser("lake-to-db", help="B4: SQL file over catalog tables to a JDBC table")
    _jdbc_opts(l)
    _opt(l, "sql_file", required=True)
    _opt(l, "param", action="append", default=[], help="name=value, repeatable")
    _opt(l, "table", required=True)
    _opt(l, "pre_ins_sql_file_path", help="pre-load statements, run in one transaction before the write")
    _opt(l, "pre_param", action="append", default=[], help="positional ? value for the pre-load file, repeatable")
    _opt(l, "write_mode", choices=["overwrite", "append"], required=True)
    _opt(l, "slice_column")
    _opt(l, "slice_value")
    _opt(l, "staging_table")
    _opt(l, "batchsize", type=int, default=10_000)
    _opt(l, "num_partitions", type=int, required=True, help="connections the database sees at once")
    _opt(l, "is_dryrun", type=_bool, default=False)
    for job in sub.choices.values():
        _opt(job, "shuffle_gb", type=float, help="expected bytes of the job's largest shuffle")
        _opt(job, "executors", type=int, default=1)
        _opt(job, "cores_per_executor", type=int, default=1)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    from scoreflow.session import build_session, cluster_settings, job_scratch

    extra = None
    if args.shuffle_gb is not None:
        extra = cluster_settings(int(args.shuffle_gb * 1e9), args.executors, args.cores_per_executor)
    spark = build_session(master=None, shuffle_partitions=None, extra=extra)
    with job_scratch(spark):
        _run(spark, args)
    return 0


def _run(spark, args: argparse.Namespace) -> None:
    if args.job == "features":
        from scoreflow.plans.feature_store import feature_job

        if args.day_store:
            from scoreflow.plans.daily_store import build_days

            if args.day is None:
                raise SystemExit("--day_store builds a --day")
            report = build_days(spark, args.input_path, args.output_path, args.day, args.day + dt.timedelta(days=1), args.run_tag)
        else:
            report = feature_job(spark, args.input_path, args.output_path, args.run_tag, args.day)
        print(json.dumps(report.__dict__))
    elif args.job == "compact-features":
        from scoreflow.plans.daily_store import compact_months, vacuum_store

        made = compact_months(spark, args.output_path, args.before)
        gone = vacuum_store(spark, args.output_path, args.vacuum_keep) if args.vacuum_keep else []
        print(json.dumps({"version": made.version, "folders": len(made.folders), "removed": len(gone)}))
    elif args.job == "train":
        from scoreflow.plans.training import TrainingConfig, training_run

        cfg = TrainingConfig(
            run_tag=args.run_tag,
            training_window_months=args.training_window_months,
            sampling_ratio=args.sampling_ratio,
            as_of=args.as_of,
            num_trees=args.num_trees,
            seed=args.seed,
        )
        row = training_run(spark, args.feature_store_path, args.model_registry_path, args.metrics_path, cfg).first()
        print(json.dumps(row.asDict()))
    elif args.job == "export":
        from scoreflow.plans.export import daily_export
        from scoreflow.sources.tables import table_scan

        from scoreflow.functions.dates import LOCAL_ZONE

        report = daily_export(
            table_scan(spark, args.source, args.source_format), args.export_root, args.job_datetime,
            args.zone or LOCAL_ZONE, args.ts_column, args.format, args.is_dryrun,
        )
        print(json.dumps(report.__dict__))
    elif args.job == "gate":
        from scoreflow.functions.dates import session_today
        from scoreflow.plans.completion import check_activity_completion
        from scoreflow.sources.tables import table_scan

        names = [n.strip() for n in args.activities.split(",") if n.strip()]
        # One clock for the database query and the check: the session's.
        day = args.day or session_today(spark)
        if args.jdbc_url:
            from scoreflow.sources.jdbc import activity_marks_query, jdbc_query_scan

            # The database sends one row per activity mark, not the day's log.
            query = activity_marks_query(args.log_source, names, day)
            log = jdbc_query_scan(spark, _jdbc(args), query)
        else:
            log = table_scan(spark, args.log_source, args.log_format)
        print(json.dumps(check_activity_completion(spark, log, names, day, args.is_dryrun)))
    elif args.job == "bronze":
        from scoreflow.streaming.bronze import kafka_options, kafka_source, start_bronze

        jaas = os.environ.get(args.sasl_jaas_config_env) if args.sasl_jaas_config_env else None
        opts = kafka_options(
            args.bootstrap_servers, args.topic, args.starting_offsets, args.max_offsets_per_trigger,
            args.security_protocol, args.sasl_mechanism, jaas, args.min_partitions,
        )
        if args.compactable:
            from scoreflow.streaming.bronze_store import start_bronze_store

            query = start_bronze_store(kafka_source(spark, opts), args.target, args.checkpoint)
        else:
            query = start_bronze(kafka_source(spark, opts), args.target, args.checkpoint, fmt=args.format)
        print(json.dumps({"query_id": str(query.id)}))
        query.awaitTermination()
    elif args.job == "compact-bronze":
        from scoreflow.streaming.bronze_store import compact, vacuum

        made = compact(spark, args.target, args.file_mb << 20)
        gone = vacuum(spark, args.target, args.vacuum_keep) if args.vacuum_keep else []
        print(json.dumps({"version": made.version, "days": len(made.folders), "removed": len(gone)}))
    elif args.job == "db-to-lake":
        from scoreflow.plans.loads import db_to_lake
        from scoreflow.sources.jdbc import JdbcPartitioning, JdbcPredicates, jdbc_partitioning, rows_after
        from scoreflow.sources.sql_files import bind_literals, read_sql_file

        params = dict(p.split("=", 1) for p in args.param)
        query = bind_literals(read_sql_file(spark, args.sql_file), params)
        if args.after is not None and not args.partition_column:
            raise SystemExit("--after needs the --partition_column that it is a mark of")
        query = rows_after(query, args.partition_column, args.after)
        part = None
        if not args.partition_column and not args.single_task:
            raise SystemExit("db-to-lake needs --partition_column, or --single_task true to read through one task")
        if args.partition_column and (args.lower_bound is None or args.upper_bound is None):
            part = jdbc_partitioning(spark, _jdbc(args), query, args.partition_column, args.num_partitions)
        elif args.partition_column:
            part = JdbcPartitioning(args.partition_column, args.lower_bound, args.upper_bound, args.num_partitions or 8)
        report = db_to_lake(
            spark, _jdbc(args), query, args.target_path, args.data_dt,
            args.write_mode, part, args.is_dryrun,
        )
        mark = part.high_water if isinstance(part, JdbcPredicates) else None
        print(json.dumps(report.__dict__ | {"high_water": None if mark is None else str(mark)}))
    elif args.job == "lake-to-db":
        from scoreflow.plans.loads import lake_to_db

        from scoreflow.sources.sql_files import read_statements

        params = dict(p.split("=", 1) for p in args.param)
        pre = read_statements(spark, args.pre_ins_sql_file_path, args.pre_param) if args.pre_ins_sql_file_path else ()
        report = lake_to_db(
            spark, args.sql_file, params, _jdbc(args), args.table, args.write_mode, pre_statements=pre,
            batchsize=args.batchsize, num_partitions=args.num_partitions, slice_column=args.slice_column,
            slice_value=args.slice_value, staging_table=args.staging_table, is_dryrun=args.is_dryrun,
        )
        print(json.dumps(report.__dict__))


if __name__ == "__main__":
    sys.exit(main())
