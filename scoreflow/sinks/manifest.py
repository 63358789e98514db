"""Which folders of a table are live, as a log of small JSON files.

A table that replaces folders (compaction, re-runs of a day) writes new
folders beside the live ones and then commits the next version of its
manifest. A commit is one rename that fails if the version exists, so of two
writers one is told to start again; readers take the last version and never see
a folder half written, missing or twice. Folders that no recent version names
are removed by ``vacuum``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

LOG = "_log"


class ManifestConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Manifest:
    """``folders`` maps a key (a day, a month) to a folder below the root;
    ``state`` is what the writer keeps beside them."""

    version: int = -1
    folders: dict[str, str] = field(default_factory=dict)
    state: dict[str, Any] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it does not exist)."""
    fs, hadoop = file_system(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return bool(fs.exists(hadoop))


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop = file_system(spark, path)
    return int(fs.getContentSummary(hadoop).getLength()) if fs.exists(hadoop) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = file_system(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, hadoop = file_system(spark, f"{root}/{LOG}")
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())


def _path(root: str, version: int) -> str:
    return f"{root}/{LOG}/{version:020d}.json"


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The last version (or the given one) of the table; empty before its first commit."""
    known = _versions(spark, root)
    if not known:
        return Manifest()
    at = known[-1] if version is None else version
    stored = json.loads(read_text(spark, _path(root, at)))
    return Manifest(at, stored["folders"], stored["state"])


def commit(spark: SparkSession, root: str, base: Manifest, folders: dict[str, str], state: dict[str, Any]) -> Manifest:
    """The version after ``base``; ``ManifestConflict`` if it is there already."""
    jvm = spark.sparkContext._jvm
    new = Manifest(base.version + 1, dict(folders), dict(state))
    target = _path(root, new.version)
    fs, final = file_system(spark, target)
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/{LOG}/.draft-{jvm.java.util.UUID.randomUUID().toString()}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps({"folders": new.folders, "state": new.state}).encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(final):
            raise ManifestConflict(f"{target} was committed by another writer") from error
        raise
    return new


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = file_system(spark, path)
    fs.delete(hadoop, True)


def unnamed(spark: SparkSession, root: str, folders: list[str], keep: int) -> list[str]:
    """Those of ``folders`` (below the root) that none of the last ``keep``
    versions names: neither they nor anything in them."""
    named = set()
    for version in _versions(spark, root)[-max(1, keep) :]:
        named |= set(read_manifest(spark, root, version).folders.values())
    return [f for f in folders if not any(n == f or n.startswith(f + "/") for n in named)]
