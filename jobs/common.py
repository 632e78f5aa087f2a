"""What the jobs share: configuration, partitioned writing with counts for the log."""

from __future__ import annotations

import json
import logging
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_config(spark: SparkSession, path: str, known: dict[str, Any]) -> dict[str, Any]:
    """The settings of a JSON file over the known ones. An unknown setting is an error."""
    given = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if odd := sorted(set(given) - set(known)):
        raise ValueError(f"{path}: unknown settings: {', '.join(odd)}")
    return known | given


def write_partitions(df: DataFrame, path: str, by: list[str], only: bool, dealt: bool = False, **counts: Column) -> dict[str, Any]:
    """Writes Parquet partitioned by columns, and returns its rows and the counts named, seen while it is written.

    only: partitions that df has no row of stay as they are; else the table is replaced as a whole. Partitions come in files of even size
    whatever their number of rows: Spark splits large ones and joins small ones as it deals the rows out; dealt: df was dealt out so already.
    """
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in counts.items()))
    rows = rows if dealt else rows.hint("rebalance", *by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only else "static").partitionBy(*by).parquet(path)
    try:
        return dict(seen.get)
    except Py4JJavaError:  # of a plan that Spark finds empty it keeps no counts
        return {"rows": 0} | dict.fromkeys(counts, 0)


def say(log: logging.Logger, what: str, **values: Any) -> None:
    log.info("%s: %s", what, ", ".join(f"{k} {v}" for k, v in values.items()))


def command_log() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
