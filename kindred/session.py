"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_ONE_PROCESS = re.compile(r"local(\[.*\])?$")

_shipped: set[str] = set()
_own_roots: dict[str, str] = {}


def build_session(app_name: str = "kindred", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators count on.

    Cluster sizing (executors, shuffle partitions, split size) is left to the
    submit command; anything passed in ``conf`` (dots written as ``__``) wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (what ``--py-files`` does), once
    per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="kindred-code-")
    archive = shutil.make_archive(
        f"{folder}/kindred-{context.applicationId}", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def work_root(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and
    all executors are threads of this machine's process (tests, a laptop) a
    temporary folder is taken, once per application, and removed at the end.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if not _ONE_PROCESS.match(master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors of {master} share")
        application = spark.sparkContext.applicationId
        if application not in _own_roots:
            _own_roots[application] = tempfile.mkdtemp(prefix="kindred-")
            atexit.register(shutil.rmtree, _own_roots[application], ignore_errors=True)
        root = _own_roots[application]
    return root.rstrip("/")


class WorkScope:
    """The intermediate tables of one job, to be removed when nothing reads them any more.

    Inside ``with scope:`` every new work path belongs to it (to the innermost
    scope where several are open). What is written outside of scopes is removed by
    nobody but the one who wrote it.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> WorkScope:
        _scopes.set((*_scopes.get(), self))
        return self

    def __exit__(self, *_: object) -> None:
        _scopes.set(_scopes.get()[:-1])

    def drop(self, spark: SparkSession) -> None:
        """Remove the scope's folders and their entries in the catalog, nothing else."""
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove_folder(spark, path)
        self.paths, self.tables = [], []


_scopes: ContextVar[tuple[WorkScope, ...]] = ContextVar("work_scopes", default=())


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{work_root(spark)}/kindred/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get()[-1:]:
        scope.paths.append(path)
    return path


def new_work_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name and a path that nothing else uses, for tables that the catalog must know (bucketed ones)."""
    path = new_work_path(spark, name)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    for scope in _scopes.get()[-1:]:
        scope.tables.append(table)
    return table, path


#: Narrow rows (ids, digests) that a task takes before there is another one.
TASK_ROWS = 262_144


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that as many narrow rows ask for, one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def in_tasks(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` of at most ``rows`` narrow rows (None: not known) in no more tasks than those ask for.

    Shuffle partitions are set for the whole input; a table that is thousands of times
    shorter needs no task, sort buffer and file for each. More tasks are never made.
    """
    return df if rows is None else df.coalesce(tasks_for(df.sparkSession, rows))


def lasting_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder for what outlives the job: the same for the
    same name, and part of no scope."""
    return f"{work_root(spark)}/kindred/lasting/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a result feeds two branches: an expensive stage (a model, a
    similarity join) then runs once, and a lost executor costs a re-read, not
    the stage.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
