import numpy as np
import pytest

from usagelens.llm import token_scan
from usagelens.llm.queries import QUERIES

TEXTS = "doc_id long, text string"


def _files(spark, tmp_path, *contents):
    rows = []
    for i, numbers in enumerate(contents):
        path = tmp_path / f"{i}.bin"
        path.write_bytes(np.array(numbers, "<u2").tobytes())
        rows.append((str(path), path.stat().st_size))
    return spark.createDataFrame(rows, "path string, length long")


@pytest.mark.parametrize("block_bytes", [2, 4, 10, 1 << 20])
def test_documents_across_blocks(spark, tmp_path, block_bytes):
    end = token_scan.END
    files = _files(spark, tmp_path, [1, 2, 3, end, end, 4, end, 5, 6], [end], [], list(range(40)))
    rows = token_scan.scan(files, end, block_bytes).collect()
    found = sorted((r["file"][-5:], r["ordinal"], r["start"], r["n_tokens"], r["closed"]) for r in rows)
    assert found == [("0.bin", 0, 0, 3, True), ("0.bin", 1, 4, 0, True), ("0.bin", 2, 5, 1, True),
                     ("0.bin", 3, 7, 2, False), ("1.bin", 0, 0, 0, True), ("3.bin", 0, 0, 40, False)]


def test_counts_of_texts(spark):
    long = "token scan " * 30_000
    docs = spark.createDataFrame(
        [(1, "Hello, world."), (2, None), (3, ""), (3, "again"), (None, "no id"), (4, long)], TEXTS).repartition(3)
    rows = token_scan.count_tokens(docs, block_bytes=64).collect()
    found = sorted(((r["doc_id"] is None, r["doc_id"], r["n_tokens"]) for r in rows), key=str)
    want = [(k is None, k, len(token_scan.tokens((t or "").encode())))
            for k, t in [(1, "Hello, world."), (2, None), (3, ""), (3, "again"), (None, "no id"), (4, long)]]
    assert found == sorted(want, key=str)


def test_empty_table_and_other_columns(spark):
    assert token_scan.count_tokens(spark.createDataFrame([], TEXTS)).collect() == []
    docs = spark.createDataFrame([(7, "a b", "x", 5)], "doc_id long, text string, file string, ordinal long")
    assert token_scan.count_tokens(docs).first()["n_tokens"] == 2


def test_files_are_cut_at_a_size(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words here") for i in range(20)], TEXTS).coalesce(1)
    rows = token_scan.write_token_files(docs, str(tmp_path), file_bytes=20).collect()
    assert len({r["file"] for r in rows}) > 3 and sorted(r["doc_id"] for r in rows) == list(range(20))


def test_odd_files_are_refused(spark, tmp_path):
    path = tmp_path / "odd.bin"
    path.write_bytes(b"abc")
    with pytest.raises(Exception, match="16-bit"):
        token_scan.scan(spark.createDataFrame([(str(path), 3)], "path string, length long")).collect()


def test_query_against_direct_counts(spark):
    rows = QUERIES["op1_token_counts"](spark, "/root/testdata/sf0.001").collect()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        r["doc_id"]: len(token_scan.tokens((r["text"] or "").encode())) for r in texts}


def _alone(text):
    """An encoder put together here, given the whole text at once."""
    import base64
    import tiktoken
    with open(token_scan.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("alone", pat_str=token_scan.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary(text)


def test_a_text_above_the_slice_size_is_encoded_as_a_whole():
    words = "plain words of a very long text and so on " * 250_000  # 10.5 MB, cut twice
    assert token_scan.tokens(words.encode()) == _alone(words)


@pytest.mark.parametrize("text", [
    "a b  c   d\n e \u00a0 f g\u3000h i\tj k l'm don't 12 34 , . !? x  ", "слово слово 言葉 x y\x1f z q", "no-space" * 50, " " * 60,
    "it 's a  b 's c", "a \n b c \r\n d e"])
def test_slices_of_any_size_change_nothing(text):
    for size in range(1, 30):
        assert token_scan.tokens(text.encode(), slice_chars=size) == _alone(text)
