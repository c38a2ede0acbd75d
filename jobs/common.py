"""What the jobs share: settings from a JSON file, the command line, and runs of the registered queries."""

from __future__ import annotations

import argparse
import json
import logging
import uuid
from collections.abc import Callable
from importlib import resources
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from meshloom.operators.cut import shared_folder

log = logging.getLogger("meshloom.jobs")


def settings(config: type, name: str, spark: SparkSession | None = None, path: str | None = None) -> Any:
    """The dataclass `config` from the JSON file at path, which Spark reads (it may be remote), or from the one shipped beside the job; unknown keys are an error."""
    text = spark.read.text(path, wholetext=True).first().value if path else resources.files(__package__).joinpath(f"{name}.json").read_text()
    return config(**json.loads(text))


def written(spark: SparkSession, table: DataFrame, what: str) -> None:
    log.info("%s: %d rows", what, table.count())


def twice(spark: SparkSession, name: str, run: Callable[[str], None]) -> str:
    """Two runs into one new folder below the shared one, as the registered query asks for; the folder's path."""
    out = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for _ in range(2):
        run(out)
    return out


def main(name: str, config: type, run: Callable[[SparkSession, str, str, Any], None], about: str) -> None:
    parser = argparse.ArgumentParser(description=about)
    parser.add_argument("source", help="folder of the input tables")
    parser.add_argument("out", help="folder of the output")
    parser.add_argument("--config", help=f"JSON file of settings; {name}.json beside the job if left out")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, args.source, args.out, settings(config, name, spark, args.config))
    finally:
        spark.stop()
