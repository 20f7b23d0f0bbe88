"""Fill-in-the-middle texts: prefix and suffix first, the middle last, cut between units.

A unit is a run of ASCII letters or any other single code point. A text of n units is cut after
two numbers of units drawn from its id, so the same document is always cut the same way. Forms:
``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix
``<M>`` middle, ``plain`` is the text itself. ``restore`` rebuilds the text from output and form.

Texts are worked on as UTF-8 bytes in blocks of a fixed size. Two Fenwick trees over the blocks
hold how many units and how many code points start in each. A cut is found by descending the
unit tree bit by bit to the block in which its unit starts, adding up code points on the way;
only that block is then searched. Beside the text itself a task holds two numbers per block and
the marks of ``STRIDE`` blocks.

Defined results. A null text is an empty one: no units, ``plain``, empty output. Texts that hold
one of the marks are ``plain``, since they could not be told apart again. A null id is drawn for
as an empty one. Rows with one id have the same draws, equal rows equal results. Texts may be of
any length. Other columns pass through; columns called ``n``, ``form``, ``prefix_chars`` or
``middle_chars`` are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm.common import byte_values, in_chunks, ship_package

# The marks, in the order prefix, suffix, middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of the documents whose draw leaves them plain, and of the others in suffix-first form.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
BLOCK_BYTES = 4096
#: So many blocks are marked at a time.
STRIDE = 256
#: Texts are returned in batches of about this size.
BATCH_BYTES = 1 << 25

ADDED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])


def _starts(data: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of a range start a unit, and which a code point."""
    part = data[max(0, low - 1):high]
    letter = ((part | 0x20) - np.uint8(97)) < 26
    if not low:
        letter = np.concatenate(([False], letter))
    first = (data[low:high] & 0xC0) != 0x80
    return first & ~(letter[1:] & letter[:-1]), first


class UnitIndex:
    """Where the units of one text start: Fenwick trees over its blocks."""

    def __init__(self, text: bytes, block_bytes: int = BLOCK_BYTES):
        self.data, self.block_bytes = np.frombuffer(text, np.uint8), block_bytes
        units, chars = [], []
        stride = STRIDE * block_bytes
        for low in range(0, len(text), stride):
            marks = _starts(self.data, low, min(low + stride, len(text)))
            edges = np.arange(0, len(marks[0]), block_bytes)
            for held, mark in zip((units, chars), marks):
                held.append(np.add.reduceat(mark, edges, dtype=np.int64))
        self.units, self.n = self._tree(units)
        self.chars, self.n_chars = self._tree(chars)

    @staticmethod
    def _tree(counts: list[np.ndarray]) -> tuple[list[int], int]:
        """Entry i holds the blocks i - lowbit(i) to i - 1."""
        before = np.concatenate(([0], np.cumsum(np.concatenate(counts or [np.zeros(0, np.int64)]))))
        at = np.arange(len(before))
        return (before - before[at - (at & -at)]).tolist(), int(before[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before unit number ``units``."""
        block = had = chars = 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            to = block + step
            if to < len(self.units) and had + self.units[to] <= units:
                block, had, chars = to, had + self.units[to], chars + self.chars[to]
            step >>= 1
        low = block * self.block_bytes
        if block == len(self.units) - 1:  # behind the last unit
            return len(self.data), chars
        unit, char = _starts(self.data, low, min(low + self.block_bytes, len(self.data)))
        offset = int(np.flatnonzero(unit)[units - had])
        return low + offset, chars + int(np.count_nonzero(char[:offset]))


def draws(seed: int, key: object) -> tuple[int, ...]:
    """Four numbers of 32 bits that the id decides."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def transform_text(text: bytes, numbers: tuple[int, ...], plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT, block_bytes: int = BLOCK_BYTES):
    """(n, form, code points of prefix and middle, output) of one text."""
    index = UnitIndex(text, block_bytes)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) \
            or numbers[2] % 100 >= 100 - plain_percent:
        return index.n, "plain", None, None, text
    first, last = sorted(h % (index.n + 1) for h in numbers[:2])
    (a, before), (b, upto) = index.cut(first), index.cut(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if numbers[3] % 100 < spm_percent else "psm"
    parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
    return index.n, form, before, upto - before, b"".join((*parts, MIDDLE, middle))


def restore(output: Column, form: Column) -> Column:
    """The text that was cut, rebuilt from what ``fill_in_middle`` made of it."""
    mark = {m: m.decode() for m in (PREFIX, SUFFIX, MIDDLE)}
    width = len(PREFIX)
    middle = F.substring(output, F.instr(output, mark[MIDDLE]) + width, F.length(output))

    def between(first: bytes, last: bytes) -> Column:
        low = F.instr(output, mark[first]) + width
        return F.substring(output, low, F.instr(output, mark[last]) - low)

    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1,
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with transformed texts, units, form and code points of prefix and middle."""
    ship_package(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ADDED.names]
    at_text, names = [f.name for f in kept].index(text), [f.name for f in kept]
    # Plain names on the way through the tasks; the id comes once more, as text.
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*kept, *ADDED.fields])]

    def work(batches):
        for batch in batches:
            texts = byte_values(batch.column(at_text))
            keys = batch.column(len(kept)).to_pylist()
            for low, high in in_chunks((len(t or b"") for t in texts), BATCH_BYTES):
                rows = [transform_text(t or b"", draws(seed, k), plain_percent, spm_percent, block_bytes)
                        for t, k in zip(texts[low:high], keys[low:high])]
                n, form, before, middle, out = zip(*rows)
                columns = batch.slice(low, high - low).columns[:len(kept)]
                columns[at_text] = pa.array(out, pa.binary()).view(pa.string()).cast(columns[at_text].type)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(before, pa.int64()), pa.array(middle, pa.int64())],
                    names=[f.name for f in fields])

    plain = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)],
                        F.col(key).cast("string").alias("own"))
    return plain.mapInArrow(work, T.StructType(fields)).toDF(*names, *ADDED.names)
