"""What the operators need from the session: shared storage, code on workers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import drop_folder, scratch_dir, shared_dir

X = TypeVar("X")

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()
#: Folders written inside each open :func:`temporary`, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())
#: What a Python worker keeps from task to task; one thing at a time.
_held: dict[Hashable, object] = {}


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers of a cluster may not have it installed; a zip added to the job is
    found first by all of them.
    """
    context: SparkContext = spark.sparkContext
    if context.applicationId in _shipped:
        return
    if _PACKAGE.is_dir():
        archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "tidemark_code.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(_PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(_PACKAGE.parent))
        context.addPyFile(archive)
    _shipped.add(context.applicationId)


def held(key: Hashable, build: Callable[[], X]) -> X:
    """What ``build`` makes, kept in this worker for its next tasks with the same key.

    Workers outlive the stage they ran in: what is kept goes when a task of
    another key, or a :func:`lean` one, runs in the worker.
    """
    if key not in _held:
        _let_go()
        _held[key] = build()
    return _held[key]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow`` in workers that keep nothing: not what others had :func:`held`, nor freed memory.

    Workers are used again and stand beside the heap of their executor.
    """

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go()
        try:
            yield from run(batches)
        finally:
            give_back()

    return alone


def _let_go() -> None:
    if _held:
        _held.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Hand freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_names(df: DataFrame, *wishes: str) -> list[str]:
    """Column names like the wishes that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wishes:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is :func:`stored` inside is removed at the end, unless it is kept.

    What leaves the block must be read from kept frames only; a kept one belongs
    to the block around, if there is one.
    """
    folders: list[str] = []
    token = _open.set((*_open.get(), folders))
    try:
        yield
    finally:
        _open.reset(token)
        for path in folders:
            drop_folder(spark, path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands Python batches of so many rows; a batch of texts stands beside the heap, in both processes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    What is written survives lost executors, and later steps read the file
    instead of running ``df`` again. A join with what was stored can be split by
    adaptive execution where a key is hot, which a join with an aggregate cannot.
    """
    out, path = stored_at(df, label)
    blocks = _open.get()[:-1] if keep else _open.get()
    if blocks:
        blocks[-1].append(path)
    return out


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the folder, so that it can be removed when it is no longer read."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the checkpoint folder; lineage is cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) or scratch_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)
