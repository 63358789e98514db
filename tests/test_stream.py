from pyspark.sql import functions as F

from scoreflow.plans.fixtures import payment_envelopes, stage_envelopes
from scoreflow.session import scratch_path
from scoreflow.streaming.bronze import decode_envelope, envelope_file_source, kafka_options, start_bronze


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_small):
    root = scratch_path(spark, "t_stream")
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", 200)
    n_files = len([f for f in spark.read.parquet(landing).inputFiles()])
    assert n_files > 2
    for _ in range(2):  # second run resumes from the checkpoint: nothing new
        q = start_bronze(envelope_file_source(spark, landing, 2), f"{root}/bronze", f"{root}/ckpt", available_now=True)
        q.awaitTermination()
    progress = q.recentProgress
    bronze = spark.read.parquet(f"{root}/bronze")
    batch = decode_envelope(payment_envelopes(spark, sf_small))
    assert bronze.count() == batch.count()
    assert bronze.exceptAll(batch).count() == 0 and batch.exceptAll(bronze).count() == 0
    assert sum(p["numInputRows"] for p in progress) == 0


def test_rate_limit_splits_batches(spark, sf_small):
    root = scratch_path(spark, "t_stream")
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", 300)
    q = start_bronze(envelope_file_source(spark, landing, 1), f"{root}/bronze", f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(sizes) > 1 and max(sizes) <= 300


def test_kafka_options():
    opts = kafka_options("b:9092", "payments", "earliest", security_protocol="SASL_SSL", sasl_mechanism="PLAIN")
    assert opts["maxOffsetsPerTrigger"] == "20000" and opts["subscribe"] == "payments"
    assert "skipChangeCommits" not in opts and "minPartitions" not in opts
    assert kafka_options("b:9092", "t", min_partitions=64)["minPartitions"] == "64"


def test_processing_time_trigger_and_table_sink(spark, sf_small):
    import uuid

    root = scratch_path(spark, "t_stream")
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", 500)
    table = "bronze_payment_txn_" + uuid.uuid4().hex[:8]
    q = start_bronze(envelope_file_source(spark, landing, 3), table, f"{root}/ckpt", processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    n = spark.read.parquet(landing).count()
    assert spark.table(table).count() == n
    assert dict(spark.table(table).dtypes)["key"] == "string"
    spark.sql(f"DROP TABLE {table}")


def test_envelope_timestamp_is_the_event_instant(spark, sf_small):
    import datetime as dt

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = payment_envelopes(spark, sf_small).select("offset", F.unix_micros("timestamp").alias("us")).orderBy("offset").first()
        ts = spark.read.parquet(f"{sf_small}/events.parquet").filter(F.col("event_id") == row["offset"]).first()["ts"]
        assert row["us"] == int((ts - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_batches_are_bounded_by_bytes(spark, sf_small):
    """More and smaller files do not make more batches: their bytes do."""
    import pytest

    root = scratch_path(spark, "t_stream")
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", 100)
    files = spark.read.format("binaryFile").load(landing).select("length").collect()
    size = sum(f.length for f in files)
    for limit, low, high in ((size * 2, 1, 1), (size // 3, 3, 6)):
        q = start_bronze(
            envelope_file_source(spark, landing, max_bytes_per_trigger=limit), f"{root}/b{limit}", f"{root}/c{limit}", available_now=True
        )
        q.awaitTermination()
        batches = [p for p in q.recentProgress if p["numInputRows"]]
        assert low <= len(batches) <= high < len(files)
        assert spark.read.parquet(f"{root}/b{limit}").count() == spark.read.parquet(landing).count()
    for wrong in ({}, {"max_files_per_trigger": 1, "max_bytes_per_trigger": 1}):
        with pytest.raises(ValueError):
            envelope_file_source(spark, landing, **wrong)


def _store(spark, sf_small, name, rows_per_file=100):
    root = scratch_path(spark, name)
    landing = stage_envelopes(spark, sf_small, f"{root}/landing", rows_per_file)
    return f"{root}/store", landing, f"{root}/ckpt"


def _run(spark, store, landing, checkpoint, files=2):
    from scoreflow.streaming.bronze_store import start_bronze_store

    q = start_bronze_store(envelope_file_source(spark, landing, files), store, checkpoint, available_now=True)
    q.awaitTermination()


def _same_rows(a, b):
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_compaction_bounds_the_files_of_a_day(spark, sf_small):
    from scoreflow.sinks.manifest import read_manifest
    from scoreflow.streaming.bronze_store import compact, read_bronze_store, vacuum

    store, landing, checkpoint = _store(spark, sf_small, "t_store")
    _run(spark, store, landing, checkpoint)
    want = decode_envelope(payment_envelopes(spark, sf_small))
    _same_rows(read_bronze_store(spark, store), want)
    before = len(read_bronze_store(spark, store).inputFiles())
    manifest = compact(spark, store)
    found = read_bronze_store(spark, store)
    _same_rows(found, want)
    days = want.select(F.to_date("timestamp").alias("d")).distinct().count()
    # One file a day: each day is far below the file size.
    assert len(found.inputFiles()) == days == len(manifest.folders) < before
    # Smaller files on demand: at most bytes / file size + 1 of a day.
    assert compact(spark, store).version == manifest.version  # nothing new
    gone = vacuum(spark, store, keep=1)
    assert gone and all(g.startswith("fresh/") for g in gone)
    _same_rows(read_bronze_store(spark, store), want)
    day = sorted(manifest.folders)[3]
    one = read_bronze_store(spark, store, [day])
    assert {str(r.d) for r in one.select(F.to_date("timestamp").alias("d")).distinct().collect()} == {day}
    assert len(one.inputFiles()) == 1 and read_manifest(spark, store).version == 0


def test_large_days_get_several_bounded_files(spark, sf_small):
    from scoreflow.streaming.bronze_store import compact, read_bronze_store

    store, landing, checkpoint = _store(spark, sf_small, "t_store_large")
    _run(spark, store, landing, checkpoint, files=50)
    total = sum(f.length for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true").load(f"{store}/fresh").select("length").collect())
    days = len(compact(spark, store, file_bytes=max(1, total // 60)).folders)
    files = read_bronze_store(spark, store).inputFiles()
    assert days < len(files) <= 60 + days
    _same_rows(read_bronze_store(spark, store), decode_envelope(payment_envelopes(spark, sf_small)))


def test_store_restart_late_rows_and_repeated_batches(spark, sf_small):
    """A restart adds nothing, a batch that is run again adds nothing, and late
    rows of compacted days come in by the next compaction."""
    from scoreflow.streaming.bronze_store import _query_id, compact, read_bronze_store, vacuum, write_batch

    root = scratch_path(spark, "t_store_late")
    store, landing, checkpoint = f"{root}/store", f"{root}/landing", f"{root}/ckpt"
    rows = payment_envelopes(spark, sf_small)
    null_time = rows.limit(3).withColumn("timestamp", F.lit(None).cast("timestamp")).withColumn("offset", F.col("offset") + 10**9)
    rows = rows.unionByName(null_time)
    rows.where("offset % 2 = 0").coalesce(3).write.mode("append").parquet(landing)
    _run(spark, store, landing, checkpoint)
    compact(spark, store)
    rows.where("offset % 2 = 1").coalesce(3).write.mode("append").parquet(landing)
    for _ in range(2):
        _run(spark, store, landing, checkpoint)
    want = decode_envelope(rows)
    _same_rows(read_bronze_store(spark, store), want)
    # The stream runs its last batch again, as after a crash before its commit.
    query = _query_id(spark, checkpoint)
    from scoreflow.sinks.manifest import child_folders

    last = max(int(b.split("=")[1]) for b in child_folders(spark, f"{store}/fresh/query={query}"))
    write_batch(want.limit(5), store, query, last)
    _same_rows(read_bronze_store(spark, store), want)
    compact(spark, store)
    vacuum(spark, store, keep=1)
    _same_rows(read_bronze_store(spark, store), want)
    days = want.select(F.to_date("timestamp").alias("d")).distinct().count()
    assert len(read_bronze_store(spark, store).inputFiles()) == days
    # A second query into the same store counts its batches for itself.
    _run(spark, store, landing, f"{root}/other")
    assert read_bronze_store(spark, store).count() == 2 * want.count()


def test_unfinished_batches_and_compactions_are_not_read(spark, sf_small):
    import pytest

    from scoreflow.sinks.manifest import Manifest, ManifestConflict, commit, drop_folder, read_manifest
    from scoreflow.streaming.bronze_store import compact, read_bronze_store

    store, landing, checkpoint = _store(spark, sf_small, "t_store_crash", 500)
    _run(spark, store, landing, checkpoint, files=1)
    want = read_bronze_store(spark, store).count()
    from scoreflow.sinks.manifest import child_folders

    (query,) = child_folders(spark, f"{store}/fresh")
    drop_folder(spark, f"{store}/fresh/{query}/batch=0/_SUCCESS")
    less = read_bronze_store(spark, store).count()
    assert 0 < less < want
    # Of two compactions from one version the second is told so, and changes nothing.
    compact(spark, store)
    with pytest.raises(ManifestConflict):
        commit(spark, store, Manifest(), {}, {})
    assert read_manifest(spark, store).version == 0 and read_bronze_store(spark, store).count() == less
    assert read_bronze_store(spark, f"{store}/nowhere").count() == 0
