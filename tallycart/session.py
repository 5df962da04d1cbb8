"""Session settings the library relies on, and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "tallycart") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster the caller brings its own session."""
    parallelism = 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. Taken from spark.checkpoint.dir; only a local session may lack it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tallycart-")
    spark.conf.set("spark.checkpoint.dir", made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, and read it back: computed once, lineage ends at the files."""
    path = scratch(df.sparkSession, name)
    if getattr(_here, "paths", None) is not None:
        _here.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application has written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_here = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is deleted at the end, so no frame that reads it may leave the block."""
    outer, _here.paths = getattr(_here, "paths", None), []
    try:
        yield
    finally:
        paths, _here.paths = _here.paths, outer
        for path in paths:
            delete(spark, path)


#: Shuffle files go when their statement ends instead of with the driver's garbage; steps whose code is too long for the JVM's
#: compiler (8,000 bytes a method) run as separate expressions, which it compiles; files are about 0.7 of snappy's.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
}
_lean: dict[int, tuple[int, dict[str, str | None]]] = {}
_lean_lock = threading.Lock()


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Large writes inside leave no shuffle files and run compiled. Frames inside are run once each; threads may overlap."""
    key = spark._jsparkSession.hashCode()
    with _lean_lock:
        depth, before = _lean.get(key, (0, {}))
        if not depth:
            before = {name: spark.conf.get(name, None) for name in LEAN}
            for name, value in LEAN.items():
                spark.conf.set(name, value)
        _lean[key] = (depth + 1, before)
    try:
        yield
    finally:
        with _lean_lock:
            depth, before = _lean.pop(key)
            if depth > 1:
                _lean[key] = (depth - 1, before)
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def side_by_side(spark: SparkSession, work: Callable[[str], object], names: Iterable[str]) -> dict:
    """Run independent Spark jobs from threads, so that small tables don't wait for each other; the first error is raised."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(spark)(work), names), strict=True))
