"""JDBC scans.

A ``query`` read is a single partition: one task pulls the whole result
through one connection. For tables of any size pass ``partitioning`` so
Spark splits the read into ``num_partitions`` range predicates on a numeric,
date or timestamp column; the query is then wrapped as a derived table,
because Spark only accepts the partition options together with ``dbtable``.
Later filters and projections are still pushed into the database.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url}
        if self.driver:  # otherwise Spark picks the driver registered for the URL
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update(self.extra)
        return opts


@dataclass(frozen=True)
class JdbcPartitioning:
    column: str
    lower_bound: Any
    upper_bound: Any
    num_partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower_bound),
            "upperBound": str(self.upper_bound),
            "numPartitions": str(self.num_partitions),
        }


@dataclass(frozen=True)
class JdbcPredicates:
    """One read task per predicate. ``high_water`` is the largest value of the
    partition column when the cuts were taken (None: there was none)."""

    predicates: tuple[str, ...]
    high_water: Any = None


def with_name_case(df: DataFrame, case: str | None) -> DataFrame:
    """Rename all columns to ``upper`` or ``lower`` case (None: unchanged).

    Spark's JDBC writer quotes column names, so lower-case names become
    case-sensitive in databases that fold unquoted names to upper case;
    writing upper-case names keeps plain SQL working there, and reading
    back with ``lower`` restores the lake's names."""
    if case is None:
        return df
    if case not in ("upper", "lower"):
        raise ValueError("case must be upper, lower or None")
    names = [c.upper() if case == "upper" else c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide in {case} case: {df.columns}")
    return df.toDF(*names)


def jdbc_read_options(
    config: JdbcConfig,
    query: str | None = None,
    table: str | None = None,
    partitioning: JdbcPartitioning | None = None,
    fetch_size: int = 10_000,
    prefer_timestamp_ntz: bool = True,
) -> dict[str, str]:
    """Option map for a JDBC read; pure so it can be unit-tested."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts = config.options()
    opts["fetchsize"] = str(fetch_size)
    # Databases return TIMESTAMP WITHOUT TIME ZONE; keep it that way.
    opts["preferTimestampNTZ"] = "true" if prefer_timestamp_ntz else "false"
    if partitioning is not None:
        source = table if table is not None else f"({query.strip().rstrip(';')}) scoreflow_q"
        opts["dbtable"] = source
        opts.update(partitioning.options())
    elif query is not None:
        opts["query"] = query.strip().rstrip(";")
    else:
        opts["dbtable"] = table
    return opts


def jdbc_query_scan(
    spark: SparkSession,
    config: JdbcConfig,
    query: str,
    partitioning: JdbcPartitioning | JdbcPredicates | None = None,
    fetch_size: int = 10_000,
    name_case: str | None = "lower",
) -> DataFrame:
    """Run a SELECT in the database and return its rows as a DataFrame."""
    if isinstance(partitioning, JdbcPredicates):
        opts = jdbc_read_options(config, table=f"({query.strip().rstrip(';')}) scoreflow_q", fetch_size=fetch_size)
        url, source = opts.pop("url"), opts.pop("dbtable")
        read = spark.read.jdbc(url, source, predicates=list(partitioning.predicates), properties=opts)
        return with_name_case(read, name_case)
    opts = jdbc_read_options(config, query=query, partitioning=partitioning, fetch_size=fetch_size)
    return with_name_case(spark.read.format("jdbc").options(**opts).load(), name_case)


def jdbc_table_scan(
    spark: SparkSession,
    config: JdbcConfig,
    table: str,
    partitioning: JdbcPartitioning | None = None,
    fetch_size: int = 10_000,
    name_case: str | None = "lower",
) -> DataFrame:
    opts = jdbc_read_options(config, table=table, partitioning=partitioning, fetch_size=fetch_size)
    return with_name_case(spark.read.format("jdbc").options(**opts).load(), name_case)


def quantile_cuts_query(query: str, column: str, partitions: int) -> str:
    """The smallest and the largest value of ``column`` in each of
    ``partitions`` equal shares of the rows: cuts that follow the data, so a
    dense range of keys is split as finely as it is filled. The largest of all
    is the high-water mark, from the same statement as the cuts."""
    return (
        f"SELECT scoreflow_t AS share, MIN({column}) AS low, MAX({column}) AS high FROM (SELECT {column}, "
        f"NTILE({int(partitions)}) OVER (ORDER BY {column}) AS scoreflow_t FROM ({query.strip().rstrip(';')}) scoreflow_b "
        f"WHERE {column} IS NOT NULL) scoreflow_s GROUP BY scoreflow_t ORDER BY scoreflow_t"
    )


def rows_after(query: str, column: str, mark: Any) -> str:
    """``query`` without the rows up to the high-water mark of an earlier read
    (None: all rows). Rows without a value belong to the first read alone."""
    base = query.strip().rstrip(";")
    return base if mark is None else f"SELECT * FROM ({base}) scoreflow_n WHERE {column} > {sql_literal(mark)}"


def sql_literal(value: Any) -> str:
    """A number as it is, anything else quoted."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, lows: list[Any], high: Any = None) -> list[str]:
    """One predicate per task for the cuts ``lows`` (ascending; equal ones are
    merged): together they hold every row once, rows without a value too. With
    ``high`` the last range ends there, so rows that arrive while the tasks
    read do not add to what was counted."""
    cuts = sorted(set(lows))[1:]
    end = "" if high is None else f" AND {column} <= {sql_literal(high)}"
    if not cuts:
        return ["1 = 1"] if high is None else [f"{column} <= {sql_literal(high)} OR {column} IS NULL"]
    values = [sql_literal(c) for c in cuts]
    out = [f"{column} < {values[0]} OR {column} IS NULL"]
    out += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(values, values[1:])]
    return [*out, f"{column} >= {values[-1]}{end}"]


def predicates_from_cuts(column: str, cuts: list[tuple[Any, Any]]) -> JdbcPredicates:
    """The read for the (low, high) of each share. Without any value in the
    column only rows without one were there."""
    if not cuts:
        return JdbcPredicates((f"{column} IS NULL",))
    high = max(h for _, h in cuts)
    return JdbcPredicates(tuple(range_predicates(column, [low for low, _ in cuts], high)), high)


def jdbc_partitioning(
    spark: SparkSession,
    config: JdbcConfig,
    query: str,
    column: str,
    partitions: int | None = None,
    rows_per_partition: int = 1_000_000,
) -> JdbcPredicates:
    """A parallel read of ``query`` cut at quantiles of ``column``, up to the
    high-water mark taken with the cuts. The cuts, and without a partition
    count the row count, are computed in the database; one row per partition
    comes back."""
    if partitions is None:
        counted = f"SELECT COUNT(*) AS n FROM ({query.strip().rstrip(';')}) scoreflow_b"
        partitions = partitions_for(jdbc_query_scan(spark, config, counted).first()["n"], rows_per_partition)
    cuts = jdbc_query_scan(spark, config, quantile_cuts_query(query, column, partitions)).collect()
    return predicates_from_cuts(column, [(r["low"], r["high"]) for r in cuts])


def partitions_for(rows: Any, rows_per_partition: int = 1_000_000) -> int:
    """ceil(rows / rows_per_partition); an empty result reads as one partition."""
    return max(1, -(-int(rows or 0) // rows_per_partition))


def activity_marks_query(table: str, activities: list[str], day: dt.date) -> str:
    """The latest start and finish of each activity on a day, aggregated in the
    database: a log of at most two rows per activity. The day is a half-open
    range of the bare column, so an index or partition of it is used."""
    marks = [f"{a.lower()} {kind}" for a in activities for kind in ("start", "finish")]
    listed = ", ".join(sql_literal(m) for m in marks) or "''"
    start, end = (f"TIMESTAMP '{d.isoformat()} 00:00:00'" for d in (day, day + dt.timedelta(days=1)))
    return (
        f"SELECT LOWER(activity_name) AS activity_name, MAX(created_date) AS created_date FROM {table} "
        f"WHERE created_date >= {start} AND created_date < {end} AND LOWER(activity_name) IN ({listed}) "
        "GROUP BY LOWER(activity_name)"
    )
