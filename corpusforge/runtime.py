"""Session helpers that every operator may use: the shared work folder, package shipping, Arrow batch sizes."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()
_MADE: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "corpusforge", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once for each application.

    Arrow batches are held to a few hundred rows, unless the session says how many, so that a worker's memory follows the size of a batch of texts, not 10,000 of them.
    """
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:  # Spark's own default: the user has said nothing
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    if sc.applicationId in _SHIPPED:
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(_PACKAGE.rglob("*.py")):
            archive.write(path, f"{_PACKAGE.name}/{path.relative_to(_PACKAGE)}")
    folder = Path(tempfile.mkdtemp(prefix="corpusforge-"))
    target = folder / f"{_PACKAGE.name}_pkg.zip"
    target.write_bytes(buffer.getvalue())
    sc.addPyFile(str(target))  # the driver serves it to the executors
    _SHIPPED.add(sc.applicationId)


def application_dir(spark: SparkSession) -> str:
    """This application's part of the folder that the driver and all executors share: spark.checkpoint.dir, or one of our own where it is unset and the master is local (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "corpusforge-work")
    return f"{root.rstrip('/')}/corpusforge/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the application's part; what is left there goes when the driver ends (`clean_up`)."""
    top = application_dir(spark)
    if top not in _MADE:
        _MADE.add(top)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
        local = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"
        atexit.register(_clean_up_at_exit, spark, top, place.toUri().getPath() if local else None)
    return f"{top}/{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Remove all work tables of this application. DataFrames returned by the operators may still read them: call it once their results are written."""
    drop_dir(spark, application_dir(spark))


def _clean_up_at_exit(spark: SparkSession, top: str, local: str | None) -> None:
    if local is not None:  # the driver sees the folder itself, whether or not the session still runs
        shutil.rmtree(local, ignore_errors=True)
    elif spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone: nothing is lost but space
            drop_dir(spark, top)


def drop_dir(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spread(df: DataFrame) -> DataFrame:
    """A table as it is read, dealt to all cores if it comes in fewer partitions than there are: a small table is often one row group, which one core would work through alone.

    A large one comes in more partitions than cores and is left as it is. Give it scans only: to count partitions behind a shuffle would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows of ids that a broadcast may have: some tens of MB.
BROADCAST_ROWS = 1_000_000


def small_side(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A table of ids for a join with a large one: marked for broadcast if it has `most` rows or fewer, else left to a shuffled join. Counts the rows; give it a written table."""
    return F.broadcast(ids) if ids.count() <= most else ids


#: States of the SQL parser's cache (about 10 KB each) that may outlive a large expression.
PARSER_STATES = 200


@contextlib.contextmanager
def parser_caches_released(spark: SparkSession) -> Iterator[None]:
    """While SQL expressions of many thousand words are parsed: the parser's caches, which else hold some 60 MB of the driver's heap until it ends, are given up after each parse. Settings of the session's own stay as they are."""
    wanted = {"spark.sql.parser.manageParserCaches": "true", "spark.sql.parser.parserDfaCacheFlushThreshold": str(PARSER_STATES)}
    before = {k: spark.conf.get(k) for k in wanted}
    if before["spark.sql.parser.manageParserCaches"] == "true":
        yield
        return
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Workspace:
    """Written tables in the shared folder: they cut lineage and survive lost executors.

    Tables that a returned DataFrame still reads must outlive the call; everything else is removed as soon as it is used up.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = shared_dir(spark)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            drop_dir(self.spark, f"{self.root}/{name}")

    def close(self) -> None:
        drop_dir(self.spark, self.root)
