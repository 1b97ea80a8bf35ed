"""JDBC sources and sinks.

Option builders around ``spark.read.jdbc`` / ``df.write.jdbc``.  Parallel
reads are either range-partitioned (column + bounds + numPartitions) or
predicate-partitioned (one task per WHERE clause, via ``predicates=``; the
``predicates`` *option* is silently ignored by Spark).  On write only
``numPartitions``, ``batchsize``, ``isolationLevel``, ``truncate`` and the
create-table options have an effect.
"""

from __future__ import annotations

from collections.abc import Callable

import re

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: driver classes of the databases the jobs talk to -------
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver",
    "derby": "org.apache.derby.jdbc.EmbeddedDriver",
}

READ_TUNING = ("fetchsize", "sessionInitStatement", "customSchema", "queryTimeout", "pushDownPredicate")
WRITE_OPTIONS = ("batchsize", "isolationLevel", "truncate", "numPartitions", "createTableOptions",
                 "createTableColumnTypes", "cascadeTruncate")

_QUERY = re.compile(r"^\s*\(?\s*(select|with)\b", re.IGNORECASE)


def connection(url: str, user: str | None = None, password: str | None = None,
               driver: str | None = None) -> dict[str, str]:
    props = {"url": url}
    kind = url.split(":")[1] if url.startswith("jdbc:") else ""
    props["driver"] = driver or DRIVERS.get(kind, "")
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    return {k: v for k, v in props.items() if v}


def is_query(source: str) -> bool:
    """A source is a query when it *starts* with SELECT/WITH (not when it
    merely contains the word)."""
    return bool(_QUERY.match(source))


def read_options(source: str, conn: dict[str, str], partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
                 **tuning) -> dict[str, str]:
    """Options for a table or query read.

    A query with a partition column is wrapped as a derived table, because
    Spark rejects ``query`` together with ``partitionColumn``.
    """
    opts = dict(conn)
    if is_query(source):
        if partition_column:
            opts["dbtable"] = f"({source.strip().rstrip(';')}) AS q"
        else:
            opts["query"] = source.strip().rstrip(";")
    else:
        opts["dbtable"] = source
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitionColumn needs lowerBound, upperBound and numPartitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    for k, v in tuning.items():
        if k not in READ_TUNING:
            raise ValueError(f"unknown read option {k}")
        opts[k] = str(v)
    return opts


def read_jdbc(spark: SparkSession, source: str, conn: dict[str, str], predicates: list[str] | None = None,
              **kwargs) -> DataFrame:
    """One entry point for tables, queries, range or predicate partitions."""
    if predicates:
        props = {k: v for k, v in conn.items() if k != "url"}
        table = f"({source.strip().rstrip(';')}) AS q" if is_query(source) else source
        return spark.read.jdbc(conn["url"], table, predicates=predicates, properties=props)
    return spark.read.format("jdbc").options(**read_options(source, conn, **kwargs)).load()


def write_options(table: str, conn: dict[str, str], **options) -> dict[str, str]:
    opts = dict(conn)
    opts["dbtable"] = table
    for k, v in options.items():
        if k not in WRITE_OPTIONS:
            raise ValueError(f"option {k} has no effect on a JDBC write")
        opts[k] = str(v).lower() if isinstance(v, bool) else str(v)
    return opts


def write_jdbc(df: DataFrame, table: str, conn: dict[str, str], mode: str = "append", **options) -> None:
    """JDBC write (batchsize, truncate, isolation, parallelism)."""
    df.write.format("jdbc").options(**write_options(table, conn, **options)).mode(mode).save()


def extract(mart: DataFrame, condition: str, columns: list[str], sink: Callable[[DataFrame], None],
            partitions: int | None = None) -> None:
    """The rows of a mart that meet a SQL condition, projected and handed to a sink
    (``lambda d: write_jdbc(d, table, conn, batchsize=10000)``, or any other writer).
    ``partitions`` bounds the connections that a database sink opens at once."""
    out = mart.filter(condition).select(*columns)
    sink(out.coalesce(partitions) if partitions else out)


def clickhouse_table_options(order_by: str, engine: str = "MergeTree()") -> dict[str, str]:
    """Engine clause for tables Spark creates in ClickHouse."""
    return {"createTableOptions": f"ENGINE = {engine} ORDER BY {order_by}"}
