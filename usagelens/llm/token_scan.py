"""Token counts of documents in flat token files that have separators but no index.

A token file is nothing but 16-bit little-endian token numbers, documents one after the
other, each ended by the end-of-document number. ``scan`` cuts files into blocks of a fixed
size, reads each block by its position and finds separators with one vector comparison.
What a block cannot know, how many documents ended before it and where the last of them
did, is a prefix scan over one small row per block; with it every separator becomes a
document with its ordinal, start and length, also when it began many blocks earlier.

``write_token_files`` tokenises texts with a given public vocabulary (never trained here)
and writes such files from the tasks. A task's rows name the file it wrote, so files of lost
or repeated attempts are never looked at.

Defined results: null and empty texts are documents of 0 tokens; tokens after the last
separator of a file are a document too if there are any (``closed`` false); an empty file
has no documents. Equal rows are separate documents. Long texts are encoded in slices, cut
before a single space between two characters that are not white space: the splitting pattern
starts a new piece there in any case, so the tokens are those of the whole text. A text without
such a place is encoded in one go. Other columns play no part.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import byte_values, create_file, open_file, ship_package
from usagelens.session import new_path, stage

#: The free number of the vocabularies used here (ranks 0 to 50255).
END = 50256
BLOCK_BYTES = 1 << 22
#: A task starts another file beyond this size.
FILE_BYTES = 1 << 28
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the splitting pattern the public vocabulary was made with.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters of a text that are encoded at a time, about.
SLICE_CHARS = 1 << 22
_CUT = re.compile(r"\S \S")


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _slices(text: str, limit: int) -> Iterator[str]:
    start = 0
    while len(text) - start > limit:
        found = _CUT.search(text, start + limit)
        if found is None:
            break
        yield text[start:found.start() + 1]
        start = found.start() + 1
    yield text[start:]


def tokens(text: bytes | None, vocabulary: str = VOCABULARY, slice_chars: int = SLICE_CHARS) -> list[int]:
    """The token numbers of one text."""
    encode = _encoder(vocabulary).encode_ordinary
    whole = (text or b"").decode("utf-8", "replace")
    return [t for part in _slices(whole, slice_chars) for t in encode(part)]


def write_token_files(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
                      vocabulary: str = VOCABULARY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``docs`` as flat token files; one row (file, ordinal, key) per document.

    Running the plan writes the files, so stage the rows before using them.
    """
    ship_package(docs.sparkSession)

    def write(batches):
        out = name = None
        ordinal = size = 0
        try:
            for batch in batches:
                keys = batch.column(0)
                names, ordinals = [], []
                for row in byte_values(batch.column(1)):
                    if out is None or size >= file_bytes:
                        if out is not None:
                            out.close()
                        out, name = create_file(folder, f"tokens-{uuid.uuid4().hex}.bin")
                        ordinal = size = 0
                    size += out.write(np.array([*tokens(row, vocabulary), END], "<u2").tobytes())
                    names.append(name)
                    ordinals.append(ordinal)
                    ordinal += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), keys],
                    names=["file", "ordinal", key])
        finally:
            if out is not None:
                out.close()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(write, f"file string, ordinal long, `{key}` {kind}")


def blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block) for every block of the files; ``files`` has path and length."""
    last = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1)).cast("long") - 1
    return files.select(F.col("path").alias("file"),
                        F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))


def _block(path: str, block: int, block_bytes: int) -> np.ndarray:
    with open_file(path) as file:
        start = block * block_bytes
        data = file.read_at(max(0, min(block_bytes, file.size() - start)), start)
    if len(data) % 2:
        raise ValueError(f"{path} does not hold 16-bit numbers")
    return np.frombuffer(data, "<u2")


def scan(files: DataFrame, end: int = END, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in the files."""
    ship_package(files.sparkSession)
    if block_bytes % 2:
        raise ValueError("a block is a whole number of tokens")
    spark = files.sparkSession
    per_block = block_bytes // 2

    def search(batches):
        for batch in batches:
            for file, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = _block(file, block, block_bytes)
                ends = (np.flatnonzero(held == end) + block * per_block).tolist()
                starts = [None, *(x + 1 for x in ends[:-1])] if ends else []
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([len(held)], pa.int64()),
                     pa.array([starts], longs), pa.array([ends], longs)],
                    names=["file", "block", "held", "starts", "ends"])

    todo = blocks(files, block_bytes)
    found = stage(todo.repartition(max(1, spark.sparkContext.defaultParallelism), "file", "block")
                  .mapInArrow(search, "file string, block long, held long, starts array<long>, "
                              "ends array<long>"),
                  "separators")

    # The prefix scan: one row of four numbers per block, in the order of the file.
    size = F.size("ends")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = found.select(
        "file", "block", "held", size.alias("n"),
        F.when(size > 0, F.element_at("ends", -1)).alias("last")).select(
        "file", "block", (F.col("block") * per_block + F.col("held")).alias("stop"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinal"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open"),
        "last", "n").withColumns({
            "rest": F.coalesce(F.col("last") + 1, "open"),  # where the next document starts
            "next": F.col("ordinal") + F.col("n")})

    # Joined while there is one row per block; a block's documents are spread out afterwards.
    ended = found.select("file", "block", "starts", "ends").join(
        carried.select("file", "block", "ordinal", "open"), ["file", "block"]).select(
        "file", "ordinal", "open", F.posexplode(F.arrays_zip("starts", "ends")).alias("i", "at"))
    closed = ended.select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"),
        F.coalesce("at.starts", "open").alias("start"), F.col("at.ends").alias("end"))
    tail = carried.groupBy("file").agg(
        F.max("stop").alias("end"), F.max("rest").alias("start"), F.max("next").alias("ordinal"))
    return closed.select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                         F.lit(True).alias("closed")).unionByName(
        tail.where("end > start").select("file", "ordinal", "start",
                                         (F.col("end") - F.col("start")).alias("n_tokens"),
                                         F.lit(False).alias("closed")))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files of a folder; their content is not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 vocabulary: str = VOCABULARY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write ``docs`` as token files, scan them, and give every document its count."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-files")
    written = stage(write_token_files(docs, folder, key, text, vocabulary), "token-manifest")
    files = _with_length(written.select("file").distinct(), spark.sparkContext.defaultParallelism)
    counted = scan(files, END, block_bytes)
    return written.join(counted, ["file", "ordinal"], "left").select(
        key, "file", "ordinal", "start", "n_tokens")


def _with_length(files: DataFrame, tasks: int) -> DataFrame:
    """(path, length) of the named files, looked up in so many tasks."""
    ship_package(files.sparkSession)

    def look(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = []
            for name in names:
                with open_file(name) as file:
                    sizes.append(file.size())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["path", "length"])

    return files.repartition(tasks, "file").mapInArrow(look, "path string, length long")
