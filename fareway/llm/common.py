"""Helpers the operators share: row identity, words, word and shingle codes."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id while rows are compared and joined; sorts before every id.
NO_ID = -(2**63)
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 150_000

#: A task and its Python worker hold batches of about a megabyte, and so many rows of a Parquet file at once.
_SMALL = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20), "spark.sql.parquet.columnarReaderBatchSize": "512"}

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and turns every byte that is no letter, digit or part of a non-ASCII character into a space.
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(column: str = "doc_id"):
    """An id that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def unkey(column: str = "doc_id"):
    return F.when(F.col(column) != NO_ID, F.col(column))


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; a null text counts as empty."""
    return docs.select(key().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not hold, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, so that they can import it."""
    context = spark.sparkContext
    if context.getLocalProperty("fareway.shipped"):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="fareway-code-")) / "fareway.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context.setLocalProperty("fareway.shipped", "yes")


def small_batches(spark: SparkSession) -> None:
    """From now on the session reads rows and passes them to Python a few at a time; their number alone would make batches of any size."""
    for name, value in _SMALL.items():
        spark.conf.set(name, value)


@contextmanager
def in_small_batches(spark: SparkSession):
    """``small_batches`` for the actions inside."""
    before = {name: spark.conf.get(name) for name in _SMALL}
    small_batches(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on, and its next task may be of another stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc alone has it
        trim(0)


def map_rows(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` over a function that yields dicts of columns, cast to ``schema``."""
    target = pa_schema(schema)
    ship(df.sparkSession)

    def run(batches):
        for columns in fn(batches):
            arrays = [pa.array(columns[f.name], f.type) for f in target]
            if arrays and len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
            del columns, arrays
        give_back()

    return df.mapInArrow(run, schema)


def pa_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def append(df: DataFrame, fields: str, fn: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """All columns of ``df`` and new ones computed batch by batch; a new column replaces one of the same name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    names = {f.name.lower() for f in new.fields}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    target, given = to_arrow_schema(new), df.columns
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            columns = fn(pa.RecordBatch.from_arrays(batch.columns, names=given))
            arrays = [pa.array(columns[f.name], f.type) for f in target]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *target.names])
            del batch, columns, arrays
        give_back()

    # a name with a dot does not pass through a Python worker
    plain = df.toDF(*[f"c{i}" for i in range(len(given))])
    found = plain.mapInArrow(run, StructType([*plain.schema.fields, *new.fields]))
    return found.toDF(*given, *new.names)


def segments(text: str, size: int = 1 << 20):
    """The whole text in pieces of about ``size`` characters, cut before spaces only."""
    start = 0
    while len(text) - start > size:
        end = text.find(" ", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


class WordCodes(dict):
    """64-bit code of each word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def shingles(codes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Code of every run of ``n`` words, in order; of the whole sequence if it is shorter; none without words."""
    if not len(codes):
        return codes
    n = min(n, len(codes))
    total = np.full(len(codes) - n + 1, n + (salt << 8), np.uint64)
    for j in range(n):
        total = mix(total + codes[j : len(codes) - n + 1 + j] * _ODD[j % 4])
    return total


def distinct(codes: np.ndarray) -> np.ndarray:
    """Ascending distinct values."""
    codes = np.sort(codes)
    return codes[np.r_[True, codes[1:] != codes[:-1]]] if len(codes) else codes
