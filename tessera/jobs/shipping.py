"""The library's own code on the executors."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, as Spark sends any file."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = Path(tempfile.mkdtemp(prefix="spark-code-")) / "tessera.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted([*(ROOT / "tessera").rglob("*.py"), *ROOT.glob("corpus_pipeline.py")]):
            out.write(source, source.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
