"""Presets for external connectors.

The connector jars are not part of this repository; these functions return
the option maps the connectors expect so jobs stay declarative.  Reads and
writes then go through ``spark.read.format(fmt).options(**o)``.
"""

from __future__ import annotations


def mongo_options(uri: str, database: str, collection: str) -> tuple[str, dict[str, str]]:
    """A27/B13."""
    return "mongodb", {"connection.uri": uri, "database": database, "collection": collection}


def redis_read_options(host: str, port: int, keys_pattern: str, infer_schema: bool = True) -> tuple[str, dict]:
    """Scan hashes by key pattern."""
    return "org.apache.spark.sql.redis", {"host": host, "port": str(port), "keys.pattern": keys_pattern,
                                          "infer.schema": str(infer_schema).lower()}


def redis_write_options(host: str, port: int, table: str, key_column: str) -> tuple[str, dict]:
    """One hash per row, keyed by a column."""
    return "org.apache.spark.sql.redis", {"host": host, "port": str(port), "table": table,
                                          "key.column": key_column}


def kafka_batch_options(servers: str, topic: str, starting: str = "earliest",
                        ending: str = "latest") -> tuple[str, dict[str, str]]:
    """A bounded batch read of a topic between offsets."""
    return "kafka", {"kafka.bootstrap.servers": servers, "subscribe": topic,
                     "startingOffsets": starting, "endingOffsets": ending}


def s3a_conf(endpoint: str, access_key_env: str = "AWS_ACCESS_KEY_ID",
             secret_key_env: str = "AWS_SECRET_ACCESS_KEY", path_style: bool = True) -> dict[str, str]:
    """Hadoop S3A settings for an object store (credentials from env names)."""
    import os
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": os.environ.get(access_key_env, ""),
        "spark.hadoop.fs.s3a.secret.key": os.environ.get(secret_key_env, ""),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }
