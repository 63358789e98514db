"""Parameterised SQL files run by Spark.

The reference pastes parameter values into SQL text (``{data_dt}``) and only
warns when a placeholder stays unreplaced. Here SQL files use Spark's named
parameter markers (``:data_dt``) and ``IDENTIFIER(:table)`` for names, so
values are bound as typed literals (no injection, no quoting bugs) and a
missing parameter is an error raised by the analyzer (UNBOUND_SQL_PARAMETER).
"""

from __future__ import annotations

import os
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sql")

_MARKER = re.compile(r"(?<![:\w]):([A-Za-z_][A-Za-z0-9_]*)")
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*")


def packaged_sql(name: str) -> str:
    """Path of a SQL file shipped with the package (``scoreflow/sql``)."""
    return os.path.join(SQL_DIR, name)


def read_sql_file(spark: SparkSession, path: str) -> str:
    """Read a SQL file. Local paths are read directly; any other URI goes
    through the Hadoop file system so object-store paths work on a cluster."""
    if "://" not in path or path.startswith("file:"):
        local = path[len("file:"):] if path.startswith("file:") else path
        with open(local, encoding="utf-8") as handle:
            return handle.read()
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def sql_markers(text: str) -> set[str]:
    """Named markers used in ``text`` (ignoring string literals, quoted names
    and comments)."""
    return set(_MARKER.findall(_QUOTED.sub(" ", text)))


def bind_sql_file(spark: SparkSession, path: str, params: dict[str, Any]) -> tuple[str, dict[str, Any]]:
    """Text of the file and the subset of ``params`` it uses. Raises when a
    marker has no value (the reference silently left it in the text)."""
    text = read_sql_file(spark, path).strip().rstrip(";")
    needed = sql_markers(text)
    missing = sorted(needed - set(params))
    if missing:
        raise KeyError(f"SQL file {path} needs parameters {missing}")
    return text, {k: params[k] for k in needed}


def run_sql_file(spark: SparkSession, path: str, **params: Any) -> DataFrame:
    """Run a SELECT from a SQL file with bound named parameters."""
    text, args = bind_sql_file(spark, path, params)
    return spark.sql(text, args=args)


def split_sql_statements(text: str) -> list[str]:
    """Split a SQL script on top-level ``;`` only: semicolons inside quoted
    literals, quoted names and comments do not split. Blank statements and
    comment-only pieces are dropped."""
    out, buf, i, n = [], [], 0, len(text)
    while i < n:
        ch = text[i]
        if ch in ("'", '"', "`"):
            j = i + 1
            while j < n:
                if text[j] == ch:
                    if j + 1 < n and text[j + 1] == ch:  # doubled quote
                        j += 2
                        continue
                    break
                j += 1
            buf.append(text[i : j + 1])
            i = j + 1
        elif text.startswith("--", i):
            j = text.find("\n", i)
            j = n if j < 0 else j
            buf.append(text[i:j])
            i = j
        elif text.startswith("/*", i):
            j = text.find("*/", i + 2)
            j = n if j < 0 else j + 2
            buf.append(text[i:j])
            i = j
        elif ch == ";":
            out.append("".join(buf))
            buf = []
            i += 1
        else:
            buf.append(ch)
            i += 1
    out.append("".join(buf))

    def has_code(stmt: str) -> bool:
        code = re.sub(r"--[^\n]*|/\*.*?\*/", " ", stmt, flags=re.S)
        return bool(code.strip())

    return [s.strip() for s in out if has_code(s)]


def read_statements(spark: SparkSession, path: str, params: list | None = None) -> list[tuple[str, list]]:
    """Pre-load statements of a SQL file for ``sinks.jdbc.run_statements``:
    every statement gets the positional ``?`` parameters it uses, in order."""
    values = list(params or [])
    statements = []
    for stmt in split_sql_statements(read_sql_file(spark, path)):
        k = _QUOTED.sub(" ", stmt).count("?")
        statements.append((stmt, values[:k]))
        values = values[k:]
    return statements


def sql_literal(value: Any) -> str:
    """A value as a SQL literal of its type (strings quoted, quotes doubled)."""
    import datetime as _dt

    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def bind_literals(text: str, params: dict[str, Any]) -> str:
    """SQL text for a database (a JDBC ``query`` cannot bind parameters):
    each ``:name`` marker outside literals, quoted names and comments becomes
    the typed literal of ``params[name]``; a missing value raises."""
    out, pos = [], 0

    def sub(segment: str) -> str:
        def one(m: re.Match) -> str:
            name = m.group(1)
            if name not in params:
                raise KeyError(f"SQL needs parameter {name!r}")
            return sql_literal(params[name])

        return _MARKER.sub(one, segment)

    for m in _QUOTED.finditer(text):
        out.append(sub(text[pos : m.start()]))
        out.append(m.group(0))
        pos = m.end()
    out.append(sub(text[pos:]))
    return "".join(out)
