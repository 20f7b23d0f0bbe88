"""What several corpus operators need: folds, texts as bytes, files of executors."""

from __future__ import annotations

import os
import posixpath
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A text longer than this many bytes is worked on in slices.
SLICE_BYTES = 1 << 22


def fold(key: str, modulus: int) -> Column:
    """crc32 of a key's text modulo ``modulus``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def byte_values(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """``text`` in pieces of about ``limit`` bytes that end after white space; a longer
    run without any stays in one piece, so no word is ever cut."""
    start = 0
    while len(text) - start > limit:
        end = start + limit
        found = min((p for p in (text.find(c, end) for c in (b" ", b"\n", b"\t", b"\r"))
                     if p >= 0), default=-1)
        if found < 0:
            break
        yield text[start:found + 1]
        start = found + 1
    yield text[start:]


def in_chunks(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` in total, at least one item each."""
    start = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system a shared folder is on, and the path there."""
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (pa.fs.LocalFileSystem(), path)


def create_file(folder: str, name: str):
    """A stream to a new file in a shared folder, and the file's full name."""
    full = posixpath.join(folder, name)
    files, place = filesystem(full)
    files.create_dir(posixpath.dirname(place), recursive=True)
    return files.open_output_stream(place, compression=None), full


def open_file(path: str):
    """A file of a shared folder for reading at any position."""
    files, place = filesystem(path)
    return files.open_input_file(place)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let tasks import this package also when it is run from a checkout: Spark sends every
    executor an archive of it. Done once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), os.path.basename(package))
        spark.sparkContext.addPyFile(shutil.make_archive(
            archive, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
