"""Relational table load through Spark's own JDBC writer."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

# Load mode -> (Spark save mode, truncate before the load).
LOAD_MODES = {
    "APPEND": ("append", False),
    "INSERT": ("append", False),
    "TRUNCATE": ("overwrite", True),
    "TRUNCATE_INSERT": ("overwrite", True),
    "REPLACE": ("overwrite", True),
}
# Spark type name -> bulk-loader field type; others are CHAR.
LOADER_TYPES = {
    "string": "CHAR",
    "integer": "INTEGER EXTERNAL",
    "int": "INTEGER EXTERNAL",
    "long": "INTEGER EXTERNAL",
    "bigint": "INTEGER EXTERNAL",
    "short": "INTEGER EXTERNAL",
    "smallint": "INTEGER EXTERNAL",
    "byte": "INTEGER EXTERNAL",
    "tinyint": "INTEGER EXTERNAL",
    "double": "DECIMAL EXTERNAL",
    "float": "DECIMAL EXTERNAL",
    "decimal": "DECIMAL EXTERNAL",
    "boolean": "CHAR",
    "date": 'DATE "YYYY-MM-DD"',
    "timestamp": 'TIMESTAMP "YYYY-MM-DD HH24:MI:SS"',
    "timestamp_ntz": 'TIMESTAMP "YYYY-MM-DD HH24:MI:SS"',
    "binary": "RAW",
}
# Rows per batch and port of loads that declare none.
DEFAULT_BATCH = 10_000
DEFAULT_PORT = 1521


def loader_type(spark_type: str) -> str:
    """Bulk-loader type of a Spark type name; ``decimal(p,s)`` counts as decimal."""
    return LOADER_TYPES.get(spark_type.lower().split("(")[0].strip(), "CHAR")


def column_types(df: DataFrame) -> DataFrame:
    """Per column: upper-case name, Spark type, loader type and values to load.

    The counts of all columns come from one aggregation.
    """
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name.upper()).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("spark_type"),
            F.lit(loader_type(f.dataType.simpleString())).alias("loader_type"),
            F.col(f"n{i}").alias("values_to_load"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def table_types(df: DataFrame, char_length: int = 4000) -> str:
    """Column types of a table that does not exist yet.

    Text columns need a length in most databases; other types are left to the
    dialect.
    """
    return ", ".join(
        f"{f.name} VARCHAR({char_length})"
        for f in df.schema
        if isinstance(f.dataType, T.StringType)
    )


def load_options(logic: Mapping[str, Any]) -> tuple[str, dict[str, str]]:
    """Save mode and writer options of a declared load.

    ``url`` and ``driver`` may be given outright; otherwise host, port and
    service name make the URL. Credentials come from the caller.
    """
    table = str(logic.get("table") or "").strip()
    url = str(logic.get("url") or "").strip()
    if not url:
        missing = [k for k in ("host", "service_name") if not logic.get(k)]
        if missing:
            raise ValueError(f"table load needs {' and '.join(missing)}")
        port = int(logic.get("port") or DEFAULT_PORT)
        url = f"jdbc:oracle:thin:@//{logic['host']}:{port}/{logic['service_name']}"
    if not table:
        raise ValueError("table load needs a table")
    load_mode = str(logic.get("load_mode") or "APPEND").upper()
    if load_mode not in LOAD_MODES:
        raise ValueError(f"unknown load mode '{load_mode}'")
    save_mode, truncate = LOAD_MODES[load_mode]
    schema = str(logic.get("schema") or "").strip()
    options = {
        "url": url,
        "dbtable": f"{schema}.{table}" if schema else table,
        "batchsize": str(int(logic.get("batch_size") or DEFAULT_BATCH)),
        "truncate": str(truncate).lower(),
    }
    for key in ("driver", "user", "password", "numPartitions"):
        if logic.get(key):
            options[key] = str(logic[key])
    return save_mode, options


def load_table(df: DataFrame, logic: Mapping[str, Any]) -> None:
    """Load a frame into a table, one connection per partition.

    INSERT wants an empty table, and a table that exists keeps its definition in
    every mode. A task that is run again may repeat its batch; tables loaded so
    need a key or a staging table.
    """
    save_mode, options = load_options(logic)
    if str(logic.get("load_mode") or "").upper() == "INSERT":
        present = df.sparkSession.read.format("jdbc").options(**options).load()
        if not present.isEmpty():
            raise RuntimeError(f"INSERT into a table that has rows: {options['dbtable']}")
    types = table_types(df)
    writer = df.write.format("jdbc").options(**options).mode(save_mode)
    (writer.option("createTableColumnTypes", types) if types else writer).save()
