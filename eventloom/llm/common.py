"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker holds decoded at a time.
SLICE = 256


#: Folders of the tables that `stored` has written, one list for each `scratch` that is open.
_written: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Only a local master may do without: it gets a folder of its own."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="eventloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Computes df now and cuts its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, keep: bool = False) -> DataFrame:
    """Computes df now into a compressed table in the shared folder and reads it from there; with `keep` it outlives `scratch`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    if _written and not keep:
        _written[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that `stored` writes within: what is needed later must be computed by then."""
    _written.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _written.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


#: The functions of `per_worker`, in a worker process.
_kept: list[Callable] = []


def per_worker(make: Callable) -> Callable:
    """`make`, whose last result a worker process keeps for its next tasks, until a task comes that doesn't name it in `keep`."""
    held = functools.lru_cache(maxsize=1)(make)
    _kept.append(held)
    return held


def give_back() -> None:
    """Returns memory that this process has freed to the system, which allocators else keep for later."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keep: Callable | None = None) -> DataFrame:
    """df.mapInArrow(run, schema), in workers that hold between tasks no more than they need.

    Workers live on from task to task, and several of them, some idle, share an executor's memory with its heap. So a task first drops what
    tasks of other operators have kept (all of `per_worker` but `keep`), and at its end gives back what it has freed.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if others := [f for f in _kept if f is not keep and f.cache_info().currsize]:
            for f in others:
                f.cache_clear()
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def on_arrow(df: DataFrame, columns: list[Column], make: Callable[[], Callable[[list[list]], dict[str, list] | pa.RecordBatch]], schema: str, keep: Callable | None = None) -> DataFrame:
    """Applies, on Arrow batches, a function of lists of values to slices of the given columns.

    `make` is called once in each task and gives that function; it returns lists or arrays by output column. `keep` is as for `mapped`.
    """
    chosen = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = _arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                out = apply(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return mapped(chosen, run, fields, keep)


def _arrow_schema(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def query_text(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""
