"""The feature store as days that are compacted into months.

Daily builds write ``<root>/days/snapshot_date=<day>-<id>/``; a closed month
is compacted into ``<root>/months/snapshot_month=<month>-<id>/``, range-sorted
like the one-shot layout, so the store does not stay thousands of small
folders. Which folders are live is the manifest's (``sinks.manifest``): a
build or a compaction shows all at once or not at all. A day that is built
again after its month was compacted replaces that day's rows of the month.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.operators.features import DATE_COLUMN, ID_COLUMN, feature_store_from_dir
from scoreflow.sinks.lake import LoadReport, write_observed
from scoreflow.sinks.manifest import Manifest, child_folders, commit, drop_folder, exists, read_manifest, unnamed

DAY, MONTH = "day", "month"


def _key(kind: str, date: dt.date) -> str:
    return f"{kind}:{date.isoformat()}"


def _split(manifest: Manifest) -> tuple[dict[dt.date, str], dict[dt.date, str]]:
    """Live folders by day and by month (its first day)."""
    out: tuple[dict, dict] = ({}, {})
    for key, folder in manifest.folders.items():
        kind, date = key.split(":")
        out[kind == MONTH][dt.date.fromisoformat(date)] = folder
    return out


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _after(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=32)).replace(day=1)


def build_days(spark: SparkSession, input_dir: str, root: str, start: dt.date, end: dt.date, run_tag: str) -> LoadReport:
    """Builds the days from ``start`` up to but without ``end`` in one job, a
    folder each (a day without rows replaces its folder by none), and commits
    them together."""
    root = root.rstrip("/")
    base = read_manifest(spark, root)
    batch = f"days/build={uuid.uuid4().hex[:12]}"
    rows = feature_store_from_dir(spark, input_dir, snapshot_from=start, snapshot_to=end).withColumn("run_tag", F.lit(run_tag))
    # The folder's date is dropped from the files, so the rows keep one of their own.
    placed = rows.withColumn(DAY, F.col(DATE_COLUMN)).repartitionByRange(DAY, ID_COLUMN).sortWithinPartitions(DAY, ID_COLUMN)
    written = write_observed(placed, lambda f: f.write.partitionBy(DAY).parquet(f"{root}/{batch}"), "build_days")
    live = {k: f for k, f in base.folders.items() if not (k.startswith(DAY) and start.isoformat() <= k.split(":")[1] < end.isoformat())}
    live |= {_key(DAY, dt.date.fromisoformat(name.split("=")[1])): f"{batch}/{name}" for name in child_folders(spark, f"{root}/{batch}")}
    # Their rows in compacted months no longer count.
    months = _split(base)[1]
    replaced = set(base.state.get("replaced", []))
    day = start
    while day < end:
        if _month(day) in months:
            replaced.add(day.isoformat())
        day += dt.timedelta(days=1)
    commit(spark, root, base, live, {"replaced": sorted(replaced)})
    return LoadReport(f"{root}#{run_tag}", "replace_days", written, False)


def build_months(spark: SparkSession, input_dir: str, root: str, start: dt.date, end: dt.date, run_tag: str) -> LoadReport:
    """Builds whole months (``start`` and ``end`` are first days) at once, for
    the history of a new store; folders of their days and months are replaced."""
    if start.day != 1 or end.day != 1:
        raise ValueError("whole months begin and end on a first day")
    root = root.rstrip("/")
    base = read_manifest(spark, root)
    rows = feature_store_from_dir(spark, input_dir, snapshot_from=start, snapshot_to=end).withColumn("run_tag", F.lit(run_tag))
    folders, written = _write_months(spark, root, rows)
    inside = lambda date: start.isoformat() <= date < end.isoformat()
    live = {k: f for k, f in base.folders.items() if not inside(k.split(":")[1])} | folders
    commit(spark, root, base, live, {"replaced": [d for d in base.state.get("replaced", []) if not inside(d)]})
    return LoadReport(f"{root}#{run_tag}", "replace_months", written, False)


def _write_months(spark: SparkSession, root: str, rows: DataFrame) -> tuple[dict[str, str], int]:
    """Month folders of ``rows`` in one range-sorted job: their manifest
    entries and the number of rows."""
    batch = f"months/build={uuid.uuid4().hex[:12]}"
    placed = rows.withColumn(MONTH, F.trunc(DATE_COLUMN, "MM"))
    placed = placed.repartitionByRange(DATE_COLUMN, ID_COLUMN).sortWithinPartitions(MONTH, DATE_COLUMN, ID_COLUMN)
    written = write_observed(placed, lambda f: f.write.partitionBy(MONTH).parquet(f"{root}/{batch}"), "months")
    names = child_folders(spark, f"{root}/{batch}")
    return {_key(MONTH, dt.date.fromisoformat(n.split("=")[1])): f"{batch}/{n}" for n in names}, written


def _read(spark: SparkSession, root: str, folders: list[str]) -> DataFrame | None:
    held = [f"{root}/{f}" for f in folders if exists(spark, f"{root}/{f}")]
    return spark.read.parquet(*held) if held else None


def _rows(spark: SparkSession, root: str, manifest: Manifest, days: list[str], months: list[str]) -> DataFrame | None:
    """The rows of live day and month folders."""
    of_days, of_months = _read(spark, root, days), _read(spark, root, months)
    replaced = manifest.state.get("replaced", [])
    if of_months is not None and replaced:
        gone = [dt.date.fromisoformat(d) for d in replaced]
        of_months = of_months.where(~F.coalesce(F.col(DATE_COLUMN).isin(gone), F.lit(False)))
    if of_days is None or of_months is None:
        return of_days if of_months is None else of_months
    return of_months.unionByName(of_days)


def read_daily_store(spark: SparkSession, root: str, since: dt.date | None = None) -> DataFrame:
    """All live rows; with ``since`` those from that day on, from the folders
    that can hold them alone."""
    root = root.rstrip("/")
    manifest = read_manifest(spark, root)
    days, months = _split(manifest)
    kept = [f for d, f in sorted(days.items()) if since is None or d >= since]
    whole = [f for m, f in sorted(months.items()) if since is None or _after(m) > since]
    rows = _rows(spark, root, manifest, kept, whole)
    if rows is None:
        raise ValueError(f"no rows were built at {root}")
    return rows if since is None else rows.where(F.col(DATE_COLUMN) >= F.lit(since))


def compact_months(spark: SparkSession, root: str, before: dt.date) -> Manifest:
    """Compacts the months that end before ``before`` and have day folders:
    their days, and what is live of an earlier month folder, become one month
    folder each, in one range-sorted job."""
    root = root.rstrip("/")
    base = read_manifest(spark, root)
    days, months = _split(base)
    closed = sorted({_month(d) for d in days if _after(_month(d)) <= before})
    if not closed:
        return base
    own = {d: f for d, f in days.items() if _month(d) in closed}
    rows = _rows(spark, root, base, [own[d] for d in sorted(own)], [months[m] for m in closed if m in months])
    live = {k: f for k, f in base.folders.items() if k not in {_key(DAY, d) for d in own} | {_key(MONTH, m) for m in closed}}
    if rows is not None:
        live |= _write_months(spark, root, rows)[0]
    left = [d for d in base.state.get("replaced", []) if _month(dt.date.fromisoformat(d)) not in closed]
    return commit(spark, root, base, live, {"replaced": left})


def vacuum_store(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes the folders of builds that none of the last ``keep`` manifests
    names any part of, once a later build is committed."""
    root = root.rstrip("/")
    builds = [f"{kind}/{b}" for kind in ("days", "months") for b in child_folders(spark, f"{root}/{kind}")]
    inner = [f"{b}/{f}" for b in builds for f in child_folders(spark, f"{root}/{b}") if not f.startswith("_")]
    done = [f for f in inner if exists(spark, f"{root}/{f.rsplit('/', 1)[0]}/_SUCCESS")]
    gone = unnamed(spark, root, done, keep)
    for folder in gone:
        drop_folder(spark, f"{root}/{folder}")
    return gone
