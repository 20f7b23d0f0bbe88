"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is the sequence of its tokens: words, lower-cased (A-Z), each followed by one space,
and an end byte after the last. Bytes are predicted bit by bit, most significant first. Six
predictors look at the last 0 to 5 bytes, the seventh at the word so far, all of them also at
the bits of the byte so far. For each context and bits a predictor has how many zeros and ones
followed in the training texts. The predictors' logits are combined by weights chosen by two
gates (how long a context has been seen, how often, how often the word so far; and the bits of
the byte so far), and the mixed logit is refined by an adaptive map from gate and logit to what
really followed. The bits of a text and its end add up to its total code length.

The prediction of a byte depends on its key alone: its six-byte window and a 16-bit hash of the
word so far. So each distinct key of the corpus is learned from once and scored once:

1. Tasks count the distinct keys of their texts and deal them out by a hash of the five bytes
   before (``parts`` of it). A part adds up the counts of its keys.
2. All keys that share a context of five bytes, or such a context and a word, are in one part,
   which therefore has these predictors' counts. All that share three bytes are in one group of
   parts; windows meet there to count contexts of three and four, and the results go back. Contexts of up to
   two bytes are added up from all parts; there are no more than 2^24 of them with a byte, so
   that table may be broadcast. All counts are exact, nothing collides, nothing is capped, and
   every table but that one is as large as the corpus makes it and stays distributed.
3. Learning tasks go through their keys once, in mini-batches: each is predicted with the weights
   so far (a byte's own occurrence taken off its counts, so that it is not predicted from
   itself), then weights and map move. Weights are averaged over tasks by the keys' occurrences,
   maps added up.
4. Every key is scored by the finished model. The ``COMMON_KEYS`` most frequent keys are
   broadcast with their scores, a table of bounded size; the other bytes of a text meet their
   scores part by part. Scores do not depend on order or partitioning of the texts.

The usual smoothed unigram base is computed beside it. The ``COMMON_WORDS`` most frequent words
are broadcast, a table of bounded size; every other token is looked up by a join, so the base
covers all words.

Defined results: null texts score as empty ones, one end token. Rows that repeat count as
often as they occur and are scored each; ids may be null or repeat. Without training texts
the base is 0 and the model predicts evenly. Texts may be of any length; their tokens are worked
on in pieces. Other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import byte_values, in_chunks, ship_package
from usagelens.session import new_path, remove_staged, stage

#: Bytes the order predictors look back; the predictor after them sees the word so far.
LENGTHS = (0, 1, 2, 3, 4, 5)
BACK = 5
WORD = len(LENGTHS)
PREDICTORS = WORD + 1
#: Orders counted from one broadcast table.
_LOW = 3
END = b"\n"  # white space, so never inside a token
#: What stands before a text: its first word begins after a space like any other.
START = END * (BACK - 1) + b" "
#: Counts added to both sides of a bit.
PRIOR = 0.2
LEARNING_RATE = 0.05
_CLIP = 12.0
_CONSTANT = 0.3
#: Classes of how often a context and the word so far were seen.
_CONTEXT_SEEN = (0.5, 1.5, 2.5, 12.5, 100.5)
_WORD_SEEN = (0.5, 1.5, 2.5, 4.5, 8.5, 20.5, 60.5, 200.5, 1000.5)
#: The first predictor whose contexts tell something by having been seen at all.
_TELLING = 3
#: First gate: telling contexts seen, how often the longest, how often the word so far.
GATES = (WORD - _TELLING + 1) * (len(_CONTEXT_SEEN) + 1) * (len(_WORD_SEEN) + 1)
#: Steps of the refining map over the mixed logit.
STEPS = 33
COMMON_WORDS = 200_000
COMMON_KEYS = 1 << 21
#: log2 of the places for common keys.
_PLACE_BITS = 22
#: Parts per shuffle partition.
PARTS = 8
_MINI_BATCH = 1 << 11
#: Keys that are learned from together, in random order.
_LEARNED_KEYS = 1 << 16
_CHUNK_BYTES = 1 << 21
#: Less at a time while scoring, where each byte's key, place and score are held besides.
_SCORED_BYTES = 1 << 19
_CACHED_BYTES = 1 << 17
#: Distinct keys, words, and occurrences of rare keys that a task holds at a time.
_HELD_KEYS = 1 << 20
_HELD_WORDS = 1 << 18
_HELD_RARE = 1 << 19
_PIECE_WORDS = 1 << 17
_COUNTED = 1 << 16
#: Bytes of a window's counts in contexts of three and four bytes: order x side x bit, floats.
_ROW = 2 * 2 * 8 * 4

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = np.uint64((1 << 48) - 1)
_CODEC = pa.Codec("zstd", compression_level=1)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_CONTEXT_CLASS = np.digitize(np.arange(102), _CONTEXT_SEEN).astype(np.int32)
_WORD_CLASS = np.digitize(np.arange(1002), _WORD_SEEN).astype(np.int64)


def pieces(words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(bytes before, bytes) of a text's pieces; long texts come in several."""
    before = START
    for start in range(0, len(words) + 1, _PIECE_WORDS):
        part = words[start:start + _PIECE_WORDS]
        body = b" ".join(part) + b" " * bool(part)
        if start + _PIECE_WORDS > len(words):
            body += END
        yield before, body
        before = (before + body)[-BACK:]


def keys_of(parts: list[tuple[bytes, bytes]]) -> np.ndarray:
    """The key of every byte of some pieces: below, the six bytes up to and with it; above, a
    hash of the word so far."""
    data = np.frombuffer(b"".join(x for part in parts for x in part), np.uint8)
    n = len(data) - BACK
    wide = data.astype(np.uint64)
    windows = wide[:n].copy()
    for i in range(1, BACK + 1):
        np.left_shift(windows, np.uint64(8), out=windows)
        np.bitwise_or(windows, wide[i:n + i], out=windows)
    lengths = np.array([len(body) for _, body in parts])
    starts = np.cumsum(lengths + BACK) - lengths  # of the pieces' own bytes
    numbers = _BYTES.take(data)
    sums = np.cumsum(numbers) - numbers  # before each byte
    begins = np.zeros(len(data), np.int64)  # the first byte of the word a byte belongs to
    after_space = np.flatnonzero(data[:-1] == 32) + 1
    begins[after_space] = after_space
    begins[starts] = starts
    begins = np.maximum.accumulate(begins)
    so_far = ((sums - sums[begins]) * _MULTIPLIER) & ~_WINDOW
    own = np.ones(len(data), bool)
    for i in range(BACK):
        own[starts - 1 - i] = False
    return windows[own[BACK:]] | so_far[own]


def letters(windows: np.ndarray) -> np.ndarray:
    """How many of the five bytes before belong to the word so far."""
    found, inside = np.zeros(len(windows), np.int64), np.ones(len(windows), bool)
    for i in range(1, BACK + 1):
        byte = (windows >> np.uint64(8 * i)) & np.uint64(255)
        inside = inside & (byte != 32) & (byte != END[0])
        found += inside
    return found


# --- counts --------------------------------------------------------------------------

def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often they occur."""
    if times is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")  # which merges what is sorted already
    keys, times = keys[order], times[order]
    firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[firsts], np.add.reduceat(times, firsts) if len(firsts) else times


def node_counts(group: np.ndarray, byte: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries sorted by context and byte, and each bit of their byte: how often, in this
    context and after the bits so far, the same bit followed, and how often the other."""
    hits, misses = np.empty((8, len(n)), np.float32), np.empty((8, len(n)), np.float32)
    if not len(n):
        return hits, misses
    new = np.r_[True, group[1:] != group[:-1]]

    def spread(starts):
        return np.repeat(np.add.reduceat(n, starts), np.diff(np.r_[starts, len(n)]))

    total = spread(np.flatnonzero(new))
    for bit in range(8):
        prefix = byte >> np.uint8(7 - bit)
        own = spread(np.flatnonzero(new | np.r_[True, prefix[1:] != prefix[:-1]]))
        hits[bit], misses[bit], total = own, total - own, own
    return hits, misses


def order_counts(windows: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """``node_counts`` of every window in its context of ``order`` bytes."""
    codes, place = np.unique(windows & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
    hits, misses = node_counts(codes >> np.uint64(8), codes.astype(np.uint8),
                               np.bincount(place, n, len(codes)))
    return hits[:, place], misses[:, place]


class LowOrders:
    """Contexts of up to two bytes, from the counts of three-byte codes."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.tables = []
        for order in range(_LOW):
            own, place = np.unique(codes & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            self.tables.append((own, *node_counts(own >> 8, own.astype(np.uint8), np.bincount(place, n, len(own)))))

    def of(self, windows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        found = []
        for order, (codes, hits, misses) in enumerate(self.tables):
            own = (windows & np.uint64((1 << 8 * (order + 1)) - 1)).astype(np.int64)
            at = np.searchsorted(codes, own)
            found.append((hits[:, at], misses[:, at]))
        return found


@dataclass
class Seen:
    """What the predictors have counted for some keys. Orders are counted per window, words per
    key; ``place`` is the window of each key."""

    keys: np.ndarray
    place: np.ndarray
    orders: list[tuple[np.ndarray, np.ndarray]]
    word: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, low: LowOrders, windows: np.ndarray,
           middle: np.ndarray) -> "Seen":
        """Of a part's keys, sorted. ``middle`` holds the counts of orders 3 and 4 by window."""
        own, place = np.unique(keys & _WINDOW, return_inverse=True)
        at = np.argsort(windows, kind="stable")
        middle = middle[at[np.searchsorted(windows, own, sorter=at)]].reshape(len(own), 2, 2, 8)
        orders = low.of(own)
        orders += [tuple(np.ascontiguousarray(middle[:, i, side].T) for side in range(2)) for i in range(2)]
        orders.append(order_counts(own, np.bincount(place, n, len(own)), BACK))
        # Up to four letters and the space before them are a context of the orders above; longer
        # words are told apart by the last five letters and the hash.
        size = letters(own)
        word = tuple(np.empty((8, len(keys)), np.float32) for _ in range(2))
        for length in range(BACK):
            mine = size[place] == length
            for i in range(2):
                word[i][:, mine] = orders[length + 1][i][:, place[mine]]
        long = np.flatnonzero(size[place] == BACK)
        order = long[np.lexsort((keys[long] & np.uint64(255), keys[long] >> np.uint64(8)))]
        for side, counts in zip(word, node_counts(keys[order] >> np.uint64(8), keys[order].astype(np.uint8), n[order])):
            side[:, order] = counts
        return cls(keys, place, orders, word)

    def bit(self, at: np.ndarray, bit: int) -> tuple[list[np.ndarray], ...]:
        """How often the same bit and the other followed, by predictor, for some of the keys."""
        place = self.place[at]
        return tuple([*(counts[side][bit].take(place, mode="clip") for counts in self.orders),
                      self.word[side][bit].take(at, mode="clip")] for side in range(2))


# --- the model -----------------------------------------------------------------------

@dataclass
class Model:
    weights: np.ndarray  # (predictor, constant) x (first gate, then second gate)
    map: np.ndarray  # (zeros, ones) x gate x step
    seen: np.ndarray  # squared gradients so far, by weight

    @classmethod
    def start(cls) -> "Model":
        weights = np.zeros((PREDICTORS + 1, GATES + 256), np.float32)
        weights[:PREDICTORS, :GATES] = 0.2
        odds = 1.0 / (1.0 + np.exp(-np.linspace(-_CLIP, _CLIP, STEPS)))
        # Until something follows, the map gives the mixed logit itself.
        return cls(weights, 4.0 * np.tile(np.stack([1 - odds, odds])[:, None], (1, GATES, 1)),
                   np.zeros(weights.shape))

    def copy(self) -> "Model":
        return Model(self.weights.copy(), self.map.copy(), self.seen.copy())

    def mixed(self, same: list, other: list, ones: np.ndarray, state: np.ndarray):
        """Logits of a one, (predictor, constant) x byte, both gates, and the mixed logit."""
        n = len(ones)
        sign = ones.astype(np.float32) * 2 - 1
        logits = np.empty((PREDICTORS + 1, n), np.float32)
        logits[PREDICTORS] = _CONSTANT
        longest, often = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for predictor in range(PREDICTORS):
            hits, misses = same[predictor], other[predictor]
            logits[predictor] = np.log((hits + np.float32(PRIOR)) / (misses + np.float32(PRIOR))) * sign
            if _TELLING <= predictor < WORD:
                total = hits + misses
                known = total > 0
                longest += known
                often = np.where(known, _CONTEXT_CLASS.take(np.minimum(total, 101).astype(np.int64)), often)
        word = _WORD_CLASS.take(np.minimum(same[WORD] + other[WORD], 1001).astype(np.int64))
        first = (longest * (len(_CONTEXT_SEEN) + 1) + often) * (len(_WORD_SEEN) + 1) + word
        second = state + GATES
        total = np.zeros(n, np.float32)
        for weights, own in zip(self.weights, logits):
            total += (weights.take(first, mode="clip") + weights.take(second, mode="clip")) * own
        return logits, first, second, np.clip(total, -_CLIP, _CLIP)

    def learn(self, seen: Seen, times: np.ndarray) -> None:
        """One online pass over the keys that occur: every mini-batch is predicted, then weights
        and map move. Each weight's step shrinks with the gradients it has seen."""
        order = np.random.default_rng(0).permutation(np.flatnonzero(times))
        for start in range(0, len(order), _MINI_BATCH):
            at = order[start:start + _MINI_BATCH]
            own, n = seen.keys[at], times[at].astype(np.float64)
            for bit in range(8):
                ones = bits(own, bit)
                same, other = seen.bit(at, bit)
                same = [x - 1 for x in same]  # its own occurrence
                logits, first, second, mixed = self.mixed(same, other, ones, states(own, bit))
                error = (ones - 1.0 / (1.0 + np.exp(-mixed))) * n
                for i, logit in enumerate(logits):
                    own_error = error * logit
                    step = np.concatenate([np.bincount(first, own_error, GATES),
                                           np.bincount(second - GATES, own_error, 256)])
                    self.seen[i] += step * step
                    self.weights[i] += LEARNING_RATE * step / np.sqrt(self.seen[i] + 1.0)
                low, part = _steps(mixed)
                place = (ones.astype(np.int64) * GATES + first) * STEPS + low
                for step, share in ((place, n * (1 - part)), (place + 1, n * part)):
                    self.map += np.bincount(step, share, self.map.size).reshape(self.map.shape)

    def log10(self, seen: Seen) -> np.ndarray:
        """log10 probability of every key's byte."""
        answers = np.log(self.map[1] / self.map[0]).astype(np.float32).ravel()
        found = np.empty(len(seen.keys))
        for start in range(0, len(found), _MINI_BATCH):
            at = np.arange(start, min(start + _MINI_BATCH, len(found)))
            own, chance = seen.keys[at], np.ones(len(at))
            for bit in range(8):
                ones = bits(own, bit)
                _, first, _, mixed = self.mixed(*seen.bit(at, bit), ones, states(own, bit))
                low, part = _steps(mixed)
                place = first * STEPS + low
                logit = (mixed + answers.take(place) * (1 - part) + answers.take(place + 1) * part) / 2
                chance /= 1.0 + np.exp(np.where(ones, -logit, logit)).astype(np.float64)
            found[at] = np.log10(chance)
        return found


def states(keys: np.ndarray, bit: int) -> np.ndarray:
    """The bits of each byte before this one, with a leading one."""
    return (1 << bit) | ((keys & np.uint64(255)).astype(np.int64) >> (8 - bit))


def bits(keys: np.ndarray, bit: int) -> np.ndarray:
    return (keys >> np.uint64(7 - bit)).astype(np.uint8) & 1


def _steps(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = (mixed + np.float32(_CLIP)) * np.float32((STEPS - 1) / (2 * _CLIP))
    low = np.minimum(place.astype(np.int64), STEPS - 2)
    return low, place - low


# --- blocks of keys -------------------------------------------------------------------

def _split(parts: int) -> tuple[int, int]:
    """Groups of parts, and parts in a group."""
    groups = max(1, parts // PARTS)
    return groups, parts // groups


def part_of(contexts: np.ndarray, parts: int) -> np.ndarray:
    """The part of contexts of five bytes: the last three choose a group of parts, all five one
    of its parts. So what contexts of three bytes count together stays within a group."""
    groups, each = _split(parts)
    group = _mix((contexts & np.uint64((1 << 24) - 1)) * _MULTIPLIER) % np.uint64(groups)
    return (group * np.uint64(each) + (_mix(contexts * _MULTIPLIER) >> np.uint64(32)) % np.uint64(each)).astype(np.int32)


def _dealt(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of columns by part, as bytes; the order within a part stays."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for low, high in zip(edges, [*edges[1:], len(part)]):
        yield int(part[low]), [c[order[low:high]].tobytes() for c in columns]


def _planes(data: bytes, size: int) -> bytes:
    """The bytes of items of a size, first those of one place, then of the next, so that alike
    bytes lie together, compressed: a block is one value of a row, which Spark holds several
    times over while it is shuffled, written or handed to Python. Their number stands before."""
    return len(data).to_bytes(8, "little") + _CODEC.compress(
        np.frombuffer(data, np.uint8).reshape(-1, size).T.tobytes(), asbytes=True)


def _items(data: bytes, size: int) -> bytes:
    planes = _CODEC.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"))
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(_items(data, 8), np.int64)


def _by_window(keys: np.ndarray) -> np.ndarray:
    """Keys with the window above and the hash below."""
    return (keys << np.uint64(16)) | (keys >> np.uint64(48))


def _packed(keys: np.ndarray) -> bytes:
    """Keys in the order of their windows as steps from one to the next."""
    return _ascending(_by_window(keys))


def _unpacked(data: bytes) -> np.ndarray:
    found = _risen(data)
    return (found >> np.uint64(16)) | (found << np.uint64(48))


def _ascending(numbers: np.ndarray) -> bytes:
    """Row numbers, keys or windows in rising order, as steps from one to the next."""
    return _planes(np.diff(numbers, prepend=numbers.dtype.type(0)).tobytes(), 8)


def _risen(data: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(np.frombuffer(_items(data, 8), kind), dtype=kind)


def _rows_of(column) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(_risen(x, np.int64) for x in column.to_pylist())])


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), kind)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Held:
    """Distinct keys of many pieces, with how often each occurred."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(_counted(keys))
        if self.size() >= _HELD_KEYS:
            self.parts = [self.take()]

    def size(self) -> int:
        return sum(len(n) for _, n in self.parts)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys = [k for k, _ in self.parts] or [np.zeros(0, np.uint64)]
        times = [n for _, n in self.parts] or [np.zeros(0, np.int64)]
        self.parts = []
        return _counted(np.concatenate(keys), np.concatenate(times))


def _chunks(column: pa.Array, limit: int = _CHUNK_BYTES) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The tokens of many texts at a time, and the number of the first."""
    sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
    for start, stop in in_chunks(sizes, limit):
        yield start, [tokens(b) for b in byte_values(column.slice(start, stop - start))]


def _chunk_keys(split: list[list[bytes]]) -> np.ndarray:
    """The keys of some texts, made for so many bytes at a time that they stay in the cache."""
    parts = [p for words in split for p in pieces(words)]
    return np.concatenate([keys_of(parts[a:b]) for a, b in in_chunks(
        (len(body) for _, body in parts), _CACHED_BYTES)])


#: What a block of counts, or of things looked up, holds.
_TRAIN, _APART, _WORDS, _TEXT = 0, 1, 2, 3
_COUNTS = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("own", pa.binary()), ("times", pa.binary())])


def _word_parts(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % parts for w in words), np.int32, len(words))


def _dealt_words(words: list[bytes], parts: int, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Words, which hold no line break, and columns by part, as bytes."""
    part = _word_parts(words, parts)
    for p, own in _dealt(part, np.arange(len(words)), *columns):
        yield p, [b"\n".join([words[i] for i in np.frombuffer(own[0], np.int64).tolist()]), *own[1:]]


def count_tasks(docs: DataFrame, held_out: Column, text: str, parts: int) -> DataFrame:
    """What tasks count in whole texts, in blocks (part, kind, own, times): keys of training texts
    and of others, and words of training texts, where the end byte counts as the empty word."""

    def run(batches):
        words: Counter = Counter()
        held = {_TRAIN: _Held(), _APART: _Held()}

        def word_blocks():
            names = list(words)
            n = np.array([words[w] for w in names], np.int64)
            words.clear()
            return _batch(_COUNTS, [(p, _WORDS, *own) for p, own in _dealt_words(names, parts, n)])

        def blocks(kind):
            keys, n = held[kind].take()
            order = np.argsort(_by_window(keys))
            keys, n = keys[order], n[order]
            part = part_of((keys & _WINDOW) >> np.uint64(8), parts)
            return _batch(_COUNTS, [(p, kind, _packed(np.frombuffer(own, np.uint64)), _planes(times, 4))
                                    for p, (own, times) in _dealt(part, keys, n.astype(np.uint32))])

        for batch in batches:
            apart = batch.column(1).to_numpy(zero_copy_only=False)
            for start, split in _chunks(batch.column(0)):
                for kind in held:
                    own = [w for w, out in zip(split, apart[start:]) if int(out) == kind]
                    if not own:
                        continue
                    held[kind].add(_chunk_keys(own))
                    if held[kind].size() >= _HELD_KEYS:
                        yield blocks(kind)
                    if kind == _TRAIN:
                        words[b""] += len(own)
                        for found in own:
                            words.update(found)
                if len(words) >= _HELD_WORDS:
                    yield word_blocks()
        yield word_blocks()
        for kind in held:
            yield blocks(kind)

    return docs.select(text, F.coalesce(held_out, F.lit(False)).alias("apart")).mapInArrow(
        run, "part int, kind int, own binary, times binary")


_KEYS = pa.schema([("part", pa.int32()), *[(name, pa.binary()) for name in ("keys", "train", "all", "words", "counts")],
                   ("distinct", pa.int64()), ("tokens", pa.int64()), ("ends", pa.int64())])


def _blocks_of(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pa.compute.equal(table.column("kind"), kind))


def add_up(blocks: DataFrame) -> DataFrame:
    """One row per part: its distinct keys, sorted, with their occurrences in training and in all,
    and its words with theirs."""

    def merge(table: pa.Table) -> pa.Table:
        sides = []
        for own in (_blocks_of(table, _TRAIN), _blocks_of(table, _APART)):
            keys = [_unpacked(x) for x in own.column("own").to_pylist()]
            times = b"".join(_items(x, 4) for x in own.column("times").to_pylist())
            sides.append((np.concatenate([np.zeros(0, np.uint64), *keys]), np.frombuffer(times, np.uint32)))
        keys, place = np.unique(np.concatenate([k for k, _ in sides]), return_inverse=True)
        cut = len(sides[0][0])
        train = np.zeros(len(keys), np.int64)
        np.add.at(train, place[:cut], sides[0][1].astype(np.int64))
        every = train.copy()
        np.add.at(every, place[cut:], sides[1][1].astype(np.int64))
        words: Counter = Counter()
        for own, times in zip(*(_blocks_of(table, _WORDS).column(c).to_pylist() for c in ("own", "times"))):
            for word, n in zip(own.split(b"\n"), np.frombuffer(times, np.int64).tolist()):
                words[word] += n
        n = np.fromiter(words.values(), np.int64, len(words))
        return pa.Table.from_batches([_batch(_KEYS, [(
            table.column("part")[0].as_py(), _ascending(keys), _planes(train.tobytes(), 8), _planes(every.tobytes(), 8),
            b"\n".join(words), n.tobytes(), len(words), int(n.sum()), words[b""])])])

    return blocks.groupBy("part").applyInArrow(
        merge, "part int, keys binary, train binary, all binary, words binary, counts binary, "
               "distinct long, tokens long, ends long")


def _windows(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    windows, place = np.unique(keys & _WINDOW, return_inverse=True)
    total = np.zeros(len(windows), np.int64)
    np.add.at(total, place, n)
    return windows, total


def low_orders(keys: DataFrame) -> LowOrders:
    """Contexts of up to two bytes with the byte that followed: 2^24 rows at the very most."""

    def run(batches):
        for batch in batches:
            for own, train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                windows, n = _windows(_risen(own), _numbers(train))
                codes, place = np.unique(windows & np.uint64((1 << 8 * _LOW) - 1), return_inverse=True)
                total = np.zeros(len(codes), np.int64)
                np.add.at(total, place, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes.astype(np.int32)), pa.array(total)], names=["code", "n"])

    found = keys.select("keys", "train").mapInArrow(run, "code int, n long").groupBy("code").agg(
        F.sum("n").alias("n")).toArrow()
    codes = found.column("code").to_numpy().astype(np.int64)
    order = np.argsort(codes)
    return LowOrders(codes[order], found.column("n").to_numpy()[order].astype(np.float64))


def with_middle_orders(keys: DataFrame, parts: int) -> DataFrame:
    """``keys`` with the windows of each part and their counts in contexts of three and four
    bytes. Windows go to where their group of parts is counted, and back."""
    each = _split(parts)[1]
    sent = pa.schema([("team", pa.int32()), ("windows", pa.binary()), ("n", pa.binary())])
    back = pa.schema([("part", pa.int32()), ("windows", pa.binary()), ("counts", pa.binary())])

    def send(batches):
        for batch in batches:
            for part, own, train in zip(*(batch.column(i).to_pylist() for i in range(3))):
                windows, n = _windows(_risen(own), _numbers(train))
                yield _batch(sent, [(part // each, _ascending(windows), _planes(n.tobytes(), 8))])

    def count(table: pa.Table) -> pa.Table:
        windows = np.concatenate([_risen(x) for x in table.column("windows").to_pylist()])
        n = np.concatenate([_numbers(x) for x in table.column("n").to_pylist()]).astype(np.float64)
        order = np.argsort(windows)
        windows, n = windows[order], n[order]
        counts = np.stack([np.stack(order_counts(windows, n, order)) for order in (3, 4)])  # order, side, bit
        rows = np.ascontiguousarray(counts.reshape(32, -1).T)
        part = part_of(windows >> np.uint64(8), parts)
        return pa.Table.from_batches([_batch(back, [
            (p, _ascending(np.frombuffer(own, np.uint64)), _planes(counts, _ROW))
            for p, (own, counts) in _dealt(part, windows, rows)])])

    def gather(own: pa.Table, found: pa.Table) -> pa.Table:
        # One row on either side: a part's windows are all counted in its group, and only there.
        nothing = {"windows": _ascending(np.zeros(0, np.uint64)), "counts": _planes(b"", _ROW)}
        for name, value in nothing.items():
            own = own.append_column(name, found.column(name) if len(found) else pa.array([value], pa.binary()))
        return own

    counted = keys.select("part", "keys", "train").mapInArrow(send, "team int, windows binary, n binary").groupBy(
        "team").applyInArrow(count, "part int, windows binary, counts binary")
    return keys.select("part", "keys", "train", "all").groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(
        gather, "part int, keys binary, train binary, all binary, windows binary, counts binary")


def _each_part(batches, low: LowOrders, least: int = 0) -> Iterator[tuple[int, Seen, np.ndarray, np.ndarray]]:
    """The counts of every part; with ``least`` parts are put together until they have so many
    keys (they share no context of five bytes, so this changes no count)."""
    held: list[tuple] = []

    def together():
        part, keys, n, every, windows, counts = (list(x) for x in zip(*held))
        keys, n, every = (np.concatenate(x) for x in (keys, n, every))
        if len(held) > 1:
            order = np.argsort(keys, kind="stable")
            keys, n, every = keys[order], n[order], every[order]
        held.clear()
        return part[0], Seen.of(keys, n.astype(np.float64), low, np.concatenate(windows),
                                np.concatenate(counts)), n, every

    for batch in batches:
        for part, keys, train, every, windows, counts in zip(*(batch.column(i).to_pylist() for i in range(6))):
            held.append((part, _risen(keys), _numbers(train), _numbers(every), _risen(windows),
                         np.frombuffer(_items(counts, _ROW), np.float32).reshape(-1, 32)))
            if sum(len(x[1]) for x in held) >= least:
                yield together()
    if held:
        yield together()


def fit(counted: DataFrame, low) -> Model:
    """The model of all training keys; ``low`` is the broadcast of ``low_orders``."""
    start = Model.start()

    def run(batches):
        own, total = start.copy(), 0
        for _, seen, n, _ in _each_part(batches, low.value, _LEARNED_KEYS):
            own.learn(seen, n)
            total += int(n.sum())
        if total:
            values = np.r_[float(total), own.weights.ravel() * float(total), (own.map - start.map).ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["place", "value"])

    # A fixed number of small sums, whatever the corpus.
    sums = counted.mapInArrow(run, "place int, value double").groupBy("place").agg(
        F.sum("value").alias("value")).toPandas().sort_values("place")["value"].to_numpy()
    if not len(sums):
        return start
    weights, counts = np.split(sums[1:], [start.weights.size])
    return Model((weights / sums[0]).reshape(start.weights.shape).astype(np.float32),
                 start.map + counts.reshape(start.map.shape), start.seen)


def common_from(counts: DataFrame, most: int,
                numbers: Callable[[bytes], np.ndarray] = lambda x: np.frombuffer(x, np.int64)) -> int:
    """The smallest number of occurrences that no more than ``most`` keys or words reach;
    ``counts`` has one column, of blocks of occurrences that ``numbers`` reads."""

    def run(batches):
        for batch in batches:
            for every in batch.column(0).to_pylist():
                n, times = np.unique(np.minimum(numbers(every), _COUNTED), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(times)], names=["n", "times"])

    rows = counts.mapInArrow(run, "n long, times long").groupBy("n").agg(
        F.sum("times").alias("times")).orderBy(F.desc("n")).collect()  # _COUNTED rows at most
    reached, least = 0, None
    for row in rows:
        reached += row["times"]
        if reached > most:
            break
        least = row["n"]
    return least if least is not None else 1 << 62


def common_words(keys: DataFrame, most: int) -> dict[bytes, float]:
    """The most frequent words, ``most`` at the most, with log10(n + 1)."""
    least = common_from(keys.select("counts"), most)

    def run(batches):
        for batch in batches:
            for own, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.frombuffer(counts, np.int64)
                words = own.split(b"\n") if len(n) else []
                # A word of more than 64 bytes is looked up with the others.
                top = [i for i in np.flatnonzero(n >= least).tolist() if 0 < len(words[i]) <= 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in top], pa.binary()), pa.array(n[top])], names=["word", "n"])

    found = keys.select("words", "counts").mapInArrow(run, "word binary, n long").toArrow()
    return dict(zip(found.column("word").to_pylist(), np.log10(found.column("n").to_numpy() + 1.0).tolist()))


def score_keys(counted: DataFrame, low, model: Model, least: int) -> DataFrame:
    """(part, keys, logs, common_keys, common_logs): the log10 probability of every key."""
    schema = pa.schema([("part", pa.int32()), *[(name, pa.binary()) for name in ("keys", "logs", "common_keys", "common_logs")]])

    def blocks(keys, logs):
        return _ascending(keys), _planes(logs.tobytes(), 4)

    def run(batches):
        for part, seen, _, every in _each_part(batches, low.value):
            logs = model.log10(seen).astype(np.float32)
            # The more frequent, the later: these keep their place where two want the same one.
            top = np.flatnonzero(every >= least)
            yield _batch(schema, [(part, *blocks(seen.keys, logs), *blocks(seen.keys[top], logs[top]))])

    return counted.mapInArrow(run, "part int, keys binary, logs binary, common_keys binary, common_logs binary")


def _scored(keys, logs) -> tuple[np.ndarray, np.ndarray]:
    """The keys and scores of columns of blocks."""
    return (np.concatenate([np.zeros(0, np.uint64), *(_risen(x) for x in keys.to_pylist())]),
            np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(_items(x, 4), np.float32) for x in logs.to_pylist())]))


class _Common:
    """Scores of common keys; each key has one place, which it may have lost to another."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        self.keys = np.full(1 << _PLACE_BITS, np.uint64(2 ** 64 - 1))
        self.logs = np.zeros(1 << _PLACE_BITS, np.float32)
        at = self._place(keys)
        self.keys[at], self.logs[at] = keys, logs

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return (_mix(keys * _MULTIPLIER) >> np.uint64(64 - _PLACE_BITS)).view(np.int64)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores, 0 where there is none, and where that is."""
        at = self._place(keys)
        missing = self.keys.take(at) != keys
        return np.where(missing, np.float32(0), self.logs.take(at)), np.flatnonzero(missing)


# --- texts ----------------------------------------------------------------------------

def score_texts(docs: DataFrame, known: _Common, common: dict[bytes, float], held_out: Column, key: str,
                text: str, parts: int) -> DataFrame:
    """What tasks find in whole texts, in rows (part, kind, ...): one per text with its sums over
    common tokens and bytes, and blocks of the other words and keys with their texts' numbers."""
    # No more than COMMON_KEYS keys and COMMON_WORDS words.
    shared = docs.sparkSession.sparkContext.broadcast((known, common))

    def run(batches):
        known, size = shared.value
        rare: list[tuple[np.ndarray, np.ndarray]] = []
        rest: list[tuple[int, bytes, int]] = []
        schema = None

        def blocks():
            found = []
            if rare:
                rows, own = (np.concatenate(x) for x in zip(*rare))
                part = part_of((own & _WINDOW) >> np.uint64(8), parts)
                found += [(p, _TRAIN, *_nothing(schema), _ascending(np.frombuffer(x[0], np.int64)), x[1], None)
                          for p, x in _dealt(part, rows, own)]
            if rest:
                rows, words, n = zip(*rest)
                found += [(p, _WORDS, *_nothing(schema), _ascending(np.frombuffer(x[1], np.int64)), x[0], x[2])
                          for p, x in _dealt_words(list(words), parts, np.array(rows, np.int64), np.array(n, np.int64))]
            rare.clear()
            rest.clear()
            return _batch(schema, found)

        for batch in batches:
            schema = schema or _asked(batch.schema.field(1).type)
            numbers, keys_of_rows, apart = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for start, split in _chunks(batch.column(3), _SCORED_BYTES):
                own = _chunk_keys(split)
                logs10, missing = known.of(own)
                lengths = np.array([sum(map(len, words)) + len(words) + 1 for words in split])
                starts = np.r_[0, np.cumsum(lengths)[:-1]]
                scores = np.add.reduceat(logs10, starts, dtype=np.float64)
                if len(missing):
                    text_of = np.searchsorted(starts, missing, side="right") - 1
                    rare.append((numbers[start + text_of], own[missing]))
                hits, totals = [], []
                for number, words in zip(numbers[start:].tolist(), split):
                    found, hit, total = Counter(words), 0, 0.0
                    for word, n in found.items():
                        log = size.get(word)
                        if log is None:
                            rest.append((number, word, n))
                        else:
                            hit, total = hit + n, total + n * log
                    hits.append(hit)
                    totals.append(total)
                many = slice(start, start + len(split))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((numbers[many] % parts).astype(np.int32)), pa.array(np.full(len(split), _TEXT, np.int32)),
                     pa.array(numbers[many]), keys_of_rows[many], apart[many],
                     pa.array([len(w) + 1 for w in split], pa.int64()), pa.array(hits, pa.int64()), pa.array(totals),
                     pa.array(scores), pa.array(lengths), *(pa.nulls(len(split), pa.binary()) for _ in range(3))],
                    schema=schema)
                if 2 * len(rest) + sum(len(r) for r, _ in rare) >= _HELD_RARE:
                    yield blocks()
        if rare or rest:
            yield blocks()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                       held_out.alias("held_out"), text).mapInArrow(run, f"part int, kind int, {_FOUND.format(kind)}")


#: A text's columns, and a block's: texts, what is asked about them (or the sums found) and how often.
_FOUND = ("row long, key {}, held_out boolean, n long, hits long, total double, score double, n_bytes long, "
          "rows binary, own binary, times binary")


def _asked(kind: pa.DataType, first: tuple[str, ...] = ("part", "kind")) -> pa.Schema:
    """The Arrow schema of ``_FOUND`` behind two numbers."""
    return pa.schema([*[(name, pa.int32()) for name in first], ("row", pa.int64()), ("key", kind), ("held_out", pa.bool_()),
                      ("n", pa.int64()), ("hits", pa.int64()), ("total", pa.float64()), ("score", pa.float64()),
                      ("n_bytes", pa.int64()), ("rows", pa.binary()), ("own", pa.binary()), ("times", pa.binary())])


def _nothing(schema: pa.Schema) -> list[None]:
    return [None] * (len(schema) - 5)


def look_up(asked: DataFrame, known: DataFrame, words: DataFrame) -> DataFrame:
    """All texts (row, key, held_out, n, hits, total, score, n_bytes) with the words and bytes added
    that are not common. These have gone to the part that knows them; sums go back to where the
    task's texts are put together, a task's share of the input."""
    kind = asked.schema["key"].dataType.simpleString()
    result = [f for f in _FOUND.format(kind).split(", ") if f.split()[0] not in ("rows", "own", "times")]

    def look(table: pa.Table, held: pa.Table) -> pa.Table:
        schema = _asked(table.schema.field("key").type, ("task", "kind"))
        texts = _blocks_of(table, _TEXT)
        task = pa.array((texts.column("row").to_numpy() >> 33).astype(np.int32))
        texts = texts.drop_columns(["part"]).add_column(0, "task", task).cast(schema)
        rows, sums = [], []
        own = _blocks_of(table, _TRAIN)
        if len(own) and len(held):
            keys, logs = _scored(held.column("keys"), held.column("logs"))
            at = np.searchsorted(keys, _joined(own.column("own"), np.uint64))
            sums.append((_TRAIN, _rows_of(own.column("rows")), [logs[at]], np.float32))
        own = _blocks_of(table, _WORDS)
        if len(own):
            counts = {}
            for names, n in zip(*(held.column(c).to_pylist() for c in ("words", "counts"))):
                counts.update(zip(names.split(b"\n"), np.frombuffer(n, np.int64).tolist()))
            c = np.array([counts.get(w, 0) for names in own.column("own").to_pylist() for w in names.split(b"\n")], np.int64)
            n = _joined(own.column("times"), np.int64)
            sums.append((_WORDS, _rows_of(own.column("rows")), [n * np.log10(c + 1.0), n * (c > 0)], np.float64))
        for what, texts_of, values, precision in sums:
            names, place = np.unique(texts_of, return_inverse=True)
            found = [np.bincount(place, x, len(names)).astype(precision) for x in values]
            rows += [(t, what, *_nothing(schema), _ascending(np.frombuffer(x[0], np.int64)), *x[1:], *[None] * (2 - len(found)))
                     for t, x in _dealt((names >> 33).astype(np.int32), names, *found)]
        return pa.concat_tables([texts, pa.Table.from_batches([_batch(schema, rows)])])

    def together(table: pa.Table) -> pa.Table:
        texts = _blocks_of(table, _TEXT).select([f.split()[0] for f in result])
        order = np.argsort(texts.column("row").to_numpy())
        texts = texts.take(pa.array(order))
        numbers = texts.column("row").to_numpy()
        added = {"score": np.zeros(len(numbers)), "total": np.zeros(len(numbers)), "hits": np.zeros(len(numbers))}
        for what, names, precision in ((_TRAIN, ("score",), np.float32), (_WORDS, ("total", "hits"), np.float64)):
            own = _blocks_of(table, what)
            at = np.searchsorted(numbers, _rows_of(own.column("rows")))
            for name, column in zip(names, ("own", "times")):
                added[name] += np.bincount(at, _joined(own.column(column), precision), len(numbers))
        for name, more in added.items():
            place = texts.schema.get_field_index(name)
            whole = texts.column(name).to_numpy() + more
            texts = texts.set_column(place, texts.schema.field(place), pa.array(whole).cast(texts.schema.field(place).type))
        return texts

    held = known.select("part", "keys", "logs").join(words.select("part", "words", "counts"), "part", "full")
    found = asked.groupBy("part").cogroup(held.groupBy("part")).applyInArrow(look, f"task int, kind int, {_FOUND.format(kind)}")
    return found.groupBy("task").applyInArrow(together, ", ".join(result))


def score(docs: DataFrame, held_out: Column, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Scores of all rows by a model of the rows that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    used = [new_path(spark, name) for name in ("keys", "seen")]
    keys = stage(add_up(count_tasks(docs, held_out, text, parts)), "keys", used[0])
    sums = keys.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "tokens", "ends")]).first()
    distinct, n_train, ends = sums
    words = stage(keys.select("part", "words", "counts"), "words")
    common = common_words(keys, COMMON_WORDS)

    low = spark.sparkContext.broadcast(low_orders(keys))
    seen = stage(with_middle_orders(keys, parts), "seen", used[1])
    model = fit(seen, low)
    scores = stage(score_keys(seen, low, model, common_from(keys.select("all"), COMMON_KEYS, _numbers)), "key-scores")
    found = scores.select("common_keys", "common_logs").toArrow()
    known = _Common(*_scored(*found.columns))
    for path in used:  # all that follows reads the scores and the words
        remove_staged(spark, path)

    texts = look_up(score_texts(docs, known, common, held_out, key, text, parts), scores, words)
    norm, end = math.log10(n_train + distinct + 1), math.log10(ends + 1)
    return texts.select(
        F.col("key").alias(key), "held_out", F.col("n").alias("n_tokens"),
        (F.col("hits") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("total") + end - F.col("n") * norm).alias("base_score"),
        "score", (F.col("score") * -math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))
