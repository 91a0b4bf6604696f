"""Python workers import this package; where they cannot find it themselves, it is sent to them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parents[2]
_SENT = "MARGINALIA_SENT"


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each Spark context.

    Not needed where all workers run on this machine and inherit a path that leads here.
    """
    context = spark.sparkContext
    inherited = {os.path.realpath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p}
    if context.master.startswith("local") and str(_ROOT) in inherited:
        return
    if context.environment.get(_SENT):
        return
    archive = Path(tempfile.mkdtemp()) / "marginalia.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((_ROOT / "marginalia").rglob("*.py")):
            out.write(file, file.relative_to(_ROOT))
    context.addPyFile(str(archive))
    context.environment[_SENT] = "1"


def shipped(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A job whose first argument is the session, with the package sent before it starts."""

    @wraps(job)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return job(spark, *args)

    return run
