"""Helpers that several operators share."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20
STAGE_BYTES = 4 << 20  # of the pipeline's operators, whose workers share an executor's memory with a large heap
Batches = Iterator[pa.RecordBatch]


def map_batches(
    rows: DataFrame, work: Callable[[Batches], Batches], schema: str, batch_bytes: int | None = None, batch_rows: int | None = None
) -> DataFrame:
    """``mapInArrow`` over batches whose rows and bytes are bounded, so a worker's memory is too."""
    conf = rows.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows or BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes or BATCH_BYTES))
    return rows.mapInArrow(work, schema)


_KEPT: dict[str, Callable[[], None]] = {}


def take_over(owner: str, release: Callable[[], None] | None = None) -> None:
    """Called where an operator's task begins: a Python worker drops what other operators' tasks left in it.

    ``release`` drops what this one leaves. Spark reuses workers, so without it
    the caches of every stage of a long job add up in each of them.
    """
    others = [name for name in _KEPT if name != owner]
    for name in others:
        _KEPT.pop(name)()
    if others:
        pa.default_memory_pool().release_unused()
    if release is not None:
        _KEPT[owner] = release


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null becomes empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null becomes empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def sha256_hex(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def held_out(doc_id: Column) -> Column:
    """One row in five, by the checksum of the id's text; a row without id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared_files(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if re.match(r"[a-z][a-z0-9+.-]*:/", uri):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return fs.LocalFileSystem(), uri


def publish(uri: str, write: Callable[[pa.NativeFile], None]) -> None:
    """Writes a file under a name of its own, then moves it into place.

    A task that runs twice replaces its file with an equal one; a reader never
    sees half a file.
    """
    files, path = shared_files(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        write(out)
    files.move(draft, path)


def make_folder(uri: str) -> str:
    files, path = shared_files(uri)
    files.create_dir(path, recursive=True)
    return uri


def one_per_task(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short list of work items, each in a task of its own."""
    frame = spark.createDataFrame(rows, schema)
    return frame.repartitionByRange(len(rows), *frame.columns) if len(rows) > 1 else frame


class Memo(dict):
    """A cache of short texts in two generations of bounded size.

    When the young one is full it becomes the old one; what is asked for again
    comes back from there.
    """

    LONGEST = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def trim(self) -> None:
        if len(self) >= self.limit // 2:
            self.old = dict(self)
            self.clear()

    def recall(self, text):
        """The old generation's value, which is young again, or None."""
        value = self.old.pop(text, None)
        if value is not None:
            self[text] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def keep(self, text, value) -> None:
        if len(text) <= self.LONGEST:
            self[text] = value


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Prefix sums that start at 0."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])
