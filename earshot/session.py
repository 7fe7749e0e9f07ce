"""Sessions for local runs, and getting this package to the workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).parent
_METHOD_LIMIT, _METHOD_LIMIT_DEFAULT = "spark.sql.codegen.hugeMethodLimit", "65535"
_shipped: set[str] = set()


def prepare_session(spark: SparkSession, tune: bool = False) -> SparkSession:
    """Make a session fit for this library, once per application.

    * Python workers get to import the package, where it is not installed.
    * With ``tune``, generated methods above 8,000 bytes are split, in the
      whole session.  HotSpot never compiles longer ones, and 83 rules in one
      projection make a longer one (measured: scoring short texts is 2.5 times
      as fast).  A value the user chose stays.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        folder = tempfile.mkdtemp(prefix="earshot-package-")  # the driver serves the archive from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = Path(folder) / _PACKAGE.name
        archive = shutil.make_archive(str(base), "zip", _PACKAGE.parent, _PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    if tune and spark.conf.get(_METHOD_LIMIT) == _METHOD_LIMIT_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, "8000")
    return spark


def local_session(cores: int | str = "*", name: str = "earshot") -> SparkSession:
    """A session for tests and benchmarks.  On a cluster these settings belong
    to the submitter; nothing in the library depends on them."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark, tune=True)
