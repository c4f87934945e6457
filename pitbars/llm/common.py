"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from ctypes import CDLL
from functools import wraps
from pathlib import Path
from zipfile import ZipFile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


_shipped: set[str] = set()
#: Settings of Arrow batches: Spark's default, and what suits long texts.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m"),
}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent.parent
    archive = f"{tempfile.mkdtemp(prefix='pitbars-')}/pitbars.zip"
    with ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The same query, run after ship(), with Arrow batches that suit long texts unless others are set."""

    @wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        for name, (usual, ours) in BATCHES.items():
            if spark.conf.get(name) == usual:
                spark.conf.set(name, ours)
        return query(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(df: DataFrame, name: str) -> int:
    """Position of a column: the first of that exact name, else the first that differs in case only."""
    if name in df.columns:
        return df.columns.index(name)
    lowered = [c.lower() for c in df.columns]
    if name.lower() in lowered:
        return lowered.index(name.lower())
    raise ValueError(f"no column {name!r} in {df.columns}")


def numbered(df: DataFrame) -> DataFrame:
    """The same columns named c0, c1, ... by position, so that no name can clash."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def with_names(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.toDF(*like.columns)


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the given new names: picked(df, id="doc_id")."""
    flat = numbered(df)
    return flat.select(*(F.col(f"c{place(df, old)}").alias(new) for new, old in names.items()))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a local one is set if Spark runs
    in one process, as in tests; a cluster has to name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context: SparkContext = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or f"/tmp/checkpoints/{uuid.uuid4().hex}")
    return named or context._jsc.sc().getCheckpointDir().get()


#: Tables that cut() has written and that nobody has dropped.
written: list[str] = []


def drop_written(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that cut() wrote after the first `since`; whoever reads them must be done."""
    while len(written) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "cut", watch: tuple | None = None) -> DataFrame:
    """The rows written as a table in the shared folder and read again: short lineage, computed once.
    drop_written() deletes it once its readers have ended.
    `watch`, an observation and its metrics, is taken while they are written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    written.append(path)
    (df.observe(*watch) if watch else df).write.parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def appended(df: DataFrame, *fields: StructField) -> StructType:
    return StructType([*df.schema.fields, *fields])


def give_back() -> None:
    """Return what a task has freed to the system: Spark keeps its Python workers for other tasks, and
    idle ones would hold on to it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(CDLL(None), "malloc_trim", None):
        trim(0)


def tidied(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function over a task's batches, with give_back() at its end."""

    def done(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return done


def together(batches: Iterable[pa.RecordBatch], text: int, size: int, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `size` bytes of text, or `rows` rows if that is less."""
    held, held_size = [], 0
    for whole in batches:
        for x in range(0, whole.num_rows, 256):
            held.append(whole.slice(x, 256))
            held_size += pc.sum(pc.binary_length(held[-1].column(text))).as_py() or 0
            if held_size > size or len(held) * 256 >= rows:
                yield pa.concat_batches(held)
                held, held_size = [], 0
    if held:
        yield pa.concat_batches(held)
    held = None
    give_back()
