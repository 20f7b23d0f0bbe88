import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import context_mixing as cm
from usagelens.llm.common import fold

DOCS = "doc_id long, text string"


def _base(docs, held_out):
    train = Counter()
    for key, text in docs:
        if not held_out(key):
            train.update([*brute.tokens(text), ""])  # the end is the empty word
    n, v = sum(train.values()), len(train)
    rows = []
    for key, text in docs:
        words = [*brute.tokens(text), ""]
        rows.append((key, held_out(key), len(words), sum(w in train for w in words), n,
                     sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words)))
    return rows


def _check(spark, docs, common=None):
    rows = cm.score(spark.createDataFrame(docs, DOCS).repartition(3), fold("doc_id", 7) == 2).collect()
    found = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                    for r in rows), key=str)
    want = sorted(((*r[:5], round(r[5], 6)) for r in _base(docs, lambda k: brute.fold(k, 7) == 2)), key=str)
    assert found == want
    return rows


@pytest.fixture
def docs():
    texts = ["The cat sat on the mat.", "the dog sat\ton THE log", None, "", "  ", "é É straße " * 30, "x" * 300,
             "the cat " * 40]
    return [(i, texts[i % len(texts)]) for i in range(60)] + [(3, "again"), (None, "the cat"), (None, None)]


def test_base_against_direct_counts(spark, docs):
    rows = _check(spark, docs)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in rows)


def test_words_beyond_the_common_ones_are_joined(spark, docs, monkeypatch):
    monkeypatch.setattr(cm, "COMMON_WORDS", 2)
    _check(spark, docs)


def _spelled(text):
    """A text as the model sees it, after the five bytes before it."""
    words = [w.encode() for w in brute.tokens(text)]
    return cm.START + b"".join(w + b" " for w in words) + cm.END


def _positions(texts):
    """(five bytes before, word so far, byte) of every byte of the texts."""
    for text in texts:
        whole = _spelled(text)
        for i in range(5, len(whole)):
            yield whole[i - 5:i], whole[:i].rsplit(b" ", 1)[-1], whole[i]


def _counted(training):
    """Occurrences by predictor, context and byte."""
    counts = [Counter() for _ in range(cm.PREDICTORS)]
    for before, word, byte in _positions(training):
        for order in range(6):
            counts[order][before[5 - order:], byte] += 1
        counts[cm.WORD][word, byte] += 1
    return counts


def _sides(counts, before, word, byte, bit):
    """(same bit followed, other followed) by predictor, from loops over all bytes."""
    found = []
    for predictor in range(cm.PREDICTORS):
        context = word if predictor == cm.WORD else before[5 - predictor:]
        same = sum(counts[predictor][context, b] for b in range(256) if b >> (7 - bit) == byte >> (7 - bit))
        upto = sum(counts[predictor][context, b] for b in range(256) if b >> (8 - bit) == byte >> (8 - bit))
        found.append((same, upto - same))
    return found


def _seen(spark, training, asked=()):
    """The counts of all keys as the parts have them: {(before, word, byte): Seen, place}."""
    docs = spark.createDataFrame([(t, False) for t in training] + [(t, True) for t in asked], "text string, apart boolean")
    counted = cm.count_tasks(docs.repartition(3), F.col("apart"), "text", 5)
    keys = cm.add_up(counted)
    low = cm.low_orders(keys)
    parts = cm.with_middle_orders(keys, 5).toArrow().to_batches()
    return [x[1:3] for x in cm._each_part(parts, low)], low


TEXTS = ["The cat sat on the mat", "the catalogue, the catalogues", "é É straße straßen", None, "", "a a a a b",
         "understanding understandable misunderstanding", "x" * 40, "to be or not to be"]


def test_counts_of_every_predictor_against_loops(spark):
    asked = ["the cats understand", "new words only"]
    counts, parts = _counted(TEXTS), _seen(spark, TEXTS, asked)[0]
    wanted = {}
    for before, word, byte in _positions(TEXTS + asked):
        key = cm.keys_of([(before, bytes([byte]))])  # of the window; the word's hash comes from the whole word
        wanted.setdefault(int(key[0] & cm._WINDOW), []).append((before, word, byte))
    checked = 0
    for seen, n in parts:
        for at, key in enumerate(seen.keys.tolist()):
            for bit in (0, 3, 7):
                same, other = seen.bit(np.array([at]), bit)
                found = [(int(s[0]), int(o[0])) for s, o in zip(same, other)]
                assert found in [_sides(counts, *w, bit) for w in wanted[key & int(cm._WINDOW)]]
                checked += 1
    assert checked == 3 * sum(len(n) for _, n in parts) > 300
    assert sum(int(n.sum()) for _, n in parts) == sum(1 for _ in _positions(TEXTS))


def _by_hand(model, counts, before, word, byte):
    """log10 of a byte's probability, bit by bit in plain Python."""
    total = 0.0
    for bit in range(8):
        one = byte >> (7 - bit) & 1
        state = (1 << bit) | byte >> (8 - bit)
        sides = _sides(counts, before, word, byte, bit)
        logits = [math.log((s + cm.PRIOR) / (o + cm.PRIOR)) * (1 if one else -1) for s, o in sides]
        longest = often = 0
        for s, o in sides[3:6]:
            if s + o:
                longest, often = longest + 1, sum(s + o >= x for x in cm._CONTEXT_SEEN)
        first = (longest * (len(cm._CONTEXT_SEEN) + 1) + often) * (len(cm._WORD_SEEN) + 1) + sum(
            sum(sides[cm.WORD]) >= x for x in cm._WORD_SEEN)
        mixed = sum((float(w[first]) + float(w[cm.GATES + state])) * x for w, x in zip(model.weights, [*logits, cm._CONSTANT]))
        mixed = min(max(mixed, -cm._CLIP), cm._CLIP)
        place = (mixed + cm._CLIP) * (cm.STEPS - 1) / (2 * cm._CLIP)
        low = min(int(place), cm.STEPS - 2)
        answer = [math.log(model.map[1, first, i] / model.map[0, first, i]) for i in (low, low + 1)]
        logit = (mixed + answer[0] * (1 - (place - low)) + answer[1] * (place - low)) / 2
        total -= math.log10(1 + math.exp(-logit if one else logit))
    return total


def _random_model():
    rng = np.random.default_rng(0)
    model = cm.Model.start()
    model.weights += rng.normal(size=model.weights.shape).astype(np.float32) / 10
    model.map *= rng.uniform(0.5, 2, model.map.shape)
    return model


def test_scores_of_keys_against_a_model_written_out(spark):
    model, counts = _random_model(), _counted(TEXTS)
    wanted = {}
    for before, word, byte in _positions(TEXTS):
        wanted.setdefault(before + bytes([byte]), []).append(_by_hand(model, counts, before, word, byte))
    for seen, _ in _seen(spark, TEXTS)[0]:
        for key, log in zip(seen.keys.tolist(), model.log10(seen)):
            window = (key & int(cm._WINDOW)).to_bytes(6, "big")
            assert any(log == pytest.approx(w, abs=2e-4) for w in wanted[window])


def test_probabilities_of_all_next_bytes_add_up(spark):
    """After 'the c', with and without having been seen there."""
    model, (parts, low) = _random_model(), _seen(spark, TEXTS)
    keys, n, windows, middle = [], [], [], []
    before = int.from_bytes(b"the c", "big") << 8
    seen, n = next((s, n) for s, n in parts if any(k & int(cm._WINDOW) >> 8 << 8 == before for k in s.keys.tolist()))
    word = next(k for k in seen.keys.tolist() if k & int(cm._WINDOW) >> 8 << 8 == before) & ~255
    every = np.array([word | b for b in range(256)], np.uint64)
    held = dict(zip(seen.keys.tolist(), n.tolist()))
    # The keys of these 256 and of all others, counted together in one part.
    rest = np.concatenate([s.keys for s, _ in parts])
    keys = np.unique(np.concatenate([rest, every]))
    counts = {k: c for s, m in parts for k, c in zip(s.keys.tolist(), m.tolist())}
    n = np.array([counts.get(k, 0) for k in keys.tolist()], np.float64)
    windows, total = cm._windows(keys, n.astype(np.int64))
    middle = np.stack([np.stack(cm.order_counts(windows, total.astype(float), o)) for o in (3, 4)]).reshape(32, -1).T
    codes, place = np.unique(windows & np.uint64((1 << 24) - 1), return_inverse=True)
    low = cm.LowOrders(codes.astype(np.int64), np.bincount(place, total, len(codes)))
    whole = cm.Seen.of(keys, n, low, windows, np.ascontiguousarray(middle).astype(np.float32))
    logs = model.log10(whole)[np.searchsorted(keys, every)]
    assert held and (10 ** logs).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_partitions_or_on_which_keys_are_common(spark, monkeypatch):
    texts = [(i, f"alpha beta {'gamma ' * (i % 7)} delta{i % 5} word{i}") for i in range(80)]
    frame = spark.createDataFrame(texts, DOCS).repartition(3)
    found = []
    for common in (1 << 21, 10, 0):
        monkeypatch.setattr(cm, "COMMON_KEYS", common)
        rows = cm.score(frame, fold("doc_id", 7) == 2).collect()
        found.append({r["doc_id"]: (r["score"], r["bits_per_byte"]) for r in rows})
        assert len(rows) == 80
    for other in found[1:]:
        for key, (score, bits) in other.items():
            assert found[0][key] == (pytest.approx(score, rel=1e-5), pytest.approx(bits, rel=1e-5))


def test_keys_of_pieces(monkeypatch):
    words = [b"ab", b"c", b"ab", b"abcdefgh", b"c"]
    whole = cm.keys_of(list(cm.pieces(words)))
    text = cm.START + b"ab c ab abcdefgh c \n"
    assert (whole & cm._WINDOW).tolist() == [int.from_bytes(text[i:i + 6], "big") for i in range(len(text) - 5)]
    so_far = [text[:i].rsplit(b" ", 1)[-1] for i in range(5, len(text))]
    assert cm.letters(whole & cm._WINDOW).tolist() == [min(5, len(w)) for w in so_far]
    hashes = (whole >> np.uint64(48)).tolist()
    assert len(set(zip(so_far, hashes))) == len(set(so_far)) == len(set(hashes))
    monkeypatch.setattr(cm, "_PIECE_WORDS", 2)
    assert cm.keys_of(list(cm.pieces(words))).tolist() == whole.tolist()
    held = cm._Held()
    held.add(whole)
    held.add(whole)
    keys, times = held.take()
    assert keys.tolist() == sorted(set(whole.tolist())) and times.sum() == 2 * len(whole)


def test_common_keys_keep_to_their_bound(spark):
    rows = [(np.array(n, np.int64).tobytes(),) for n in ([1, 1, 5, 70_000], [5, 9, 1], [])]
    keys = spark.createDataFrame(rows, "all binary")
    assert [cm.common_from(keys, most) for most in (0, 1, 2, 3, 4, 6, 7)] == [1 << 62, 1 << 16, 9, 9, 5, 5, 1]


def test_a_very_long_text(spark):
    long = " ".join(f"w{i % 900} and" for i in range(150_000))
    rows = {r["doc_id"]: r for r in cm.score(spark.createDataFrame([(0, long), (1, "w1 and w2"), (2, long)], DOCS),
                                              F.col("doc_id") == 2).collect()}
    assert rows[0]["n_tokens"] == 300_001 and rows[2]["score"] == pytest.approx(rows[0]["score"], rel=1e-5)
    assert rows[2]["bits_per_byte"] < 3


def test_learning_shortens_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [r for r in cm.score(docs, fold("doc_id", 7) == 2).collect() if r["held_out"]]
    assert rows and sum(r["bits_per_byte"] for r in rows) / len(rows) < 3.5


def test_counts_beyond_single_precision_are_exact():
    codes = np.array([0x7A7A7A00, 0x7A7A7A80], np.uint64)
    hits, misses = cm.node_counts(codes >> np.uint64(8), codes.astype(np.uint8), np.array([2.0 ** 24 + 2 ** 20, 2.0 ** 24]))
    assert hits[0].tolist() == [2 ** 24 + 2 ** 20, 2 ** 24] and misses[0].tolist() == [2 ** 24, 2 ** 24 + 2 ** 20]
    assert hits[7].tolist() == hits[0].tolist() and misses[7].tolist() == [0, 0]


def test_unseen_contexts_fall_back_on_single_bytes(spark):
    """Held-out words whose every pair of letters is new, though the letters are not."""
    rng = np.random.default_rng(4)
    seen = ["".join(rng.choice(list(letters), 6)) for letters in ("abc", "def", "ghi") for _ in range(400)]
    new = ["".join("abcdefghi"[rng.integers(3) + 3 * ((j + k) % 3)] for j in range(30)) for k in range(20)]
    docs = [(7 * i, " ".join(seen[i::40])) for i in range(40)] + [(7 * i + 1, w) for i, w in enumerate(new)]
    rows = cm.score(spark.createDataFrame(docs, DOCS), F.col("doc_id") % 7 == 1).collect()
    found = [r["bits_per_byte"] for r in rows if r["held_out"]]
    assert len(found) == 20 and sum(found) / 20 < 6.5


def test_empty_and_untrained(spark):
    assert cm.score(spark.createDataFrame([], DOCS), F.lit(False)).collect() == []
    row = cm.score(spark.createDataFrame([(1, "a")], DOCS), F.lit(True)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (2, 0, 0, 0.0)
    assert row["bits_per_byte"] == pytest.approx(8, abs=0.01)


def test_other_columns_with_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a b", "w", 5)], "doc_id long, text string, word string, n int")
    assert cm.score(docs, F.lit(False)).first()["n_tokens"] == 3


def test_packed_keys_come_back():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 2 ** 64, size, np.uint64))
        keys = keys[np.argsort(cm._by_window(keys))]
        assert cm._unpacked(cm._packed(keys)).tolist() == keys.tolist()
        assert cm._items(cm._planes(keys.tobytes(), 8), 8) == keys.tobytes()


def test_blocks_take_a_fraction_of_what_they_hold(spark):
    """Rows of blocks are what executors hold several times over; as plain numbers a key takes 24
    bytes and a window's counts 136."""
    docs = spark.createDataFrame([(f"{'alpha beta gamma ' * (i % 3)} delta{i} word{i * i}", False) for i in range(400)], "text string, apart boolean")
    keys = cm.add_up(cm.count_tasks(docs, F.col("apart"), "text", 5))
    rows = cm.with_middle_orders(keys, 5).collect()
    held = [x for x in cm._each_part(cm.with_middle_orders(keys, 5).toArrow().to_batches(), cm.low_orders(keys))]
    plain = sum(24 * len(seen.keys) + 136 * len(np.unique(seen.keys & cm._WINDOW)) for _, seen, _, _ in held)
    assert len(rows) == len(held) and 3 * sum(len(x) for r in rows for x in r[1:]) < plain
