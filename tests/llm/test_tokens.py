"""Encoding, decoding, counting and training order against the libraries."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.samples import clashing, documents, rows, words
from tidewell.llm import bpe, counts, ordering
from tidewell.llm.common import blank_parts, by_bytes, safe_slices
from tidewell.llm.queries import RANKS, TOKENIZER


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def expected(library, data):
    return sorted(((i, library.encode_ordinary(t or "")) for i, t, *_ in data), key=str)


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (50, 20), (7, 5)])
def test_encode_matches_library(spark, library, chunk, overlap):
    got = bpe.encode(clashing(documents(spark)), RANKS, public_tokenizers.PATTERN, chunk, overlap).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == expected(library, rows())


def test_chunks_without_a_common_boundary_stay_together(spark, library):
    data = [(1, "x" * 1000 + " y " + "z" * 900, "en", "s", 0), (2, " " * 700, "en", "s", 0), (3, "it's" * 300, "en", "s", 0)]
    got = bpe.encode(documents(spark, data), RANKS, public_tokenizers.PATTERN, 64, 16).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == expected(library, data)


def test_round_trip(spark):
    encoded = bpe.encode(documents(spark), RANKS, public_tokenizers.PATTERN, 64, 32)
    got = bpe.decode(encoded, RANKS).collect()
    assert sorted((bytes(r["decoded"]) for r in got)) == sorted((t or "").encode() for _, t, *_ in rows())


def test_decode_null_ids(spark):
    assert bytes(bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), RANKS).first()["decoded"]) == b""


@pytest.mark.parametrize("slice_chars", [1 << 18, 40])
def test_counts_match_library(spark, slice_chars):
    library = Tokenizer.from_file(TOKENIZER)
    got = counts.token_counts(clashing(documents(spark)), TOKENIZER, slice_chars).collect()
    wanted = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t, *_ in rows()]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []
    assert counts.token_counts(none, TOKENIZER).collect() == []


def test_parts_and_slices_lose_nothing():
    for _, text, *_ in rows():
        if text is not None:
            first, *rest = blank_parts(text)
            assert first + "".join(" " + part for part in rest) == text
            assert "".join(safe_slices(text, 10)) == text


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_permutation(n):
    places = ordering.permuted(np.arange(n), n, 9)
    assert sorted(places.tolist()) == list(range(n))
    assert n < 200 or (places != ordering.permuted(np.arange(n), n, 10)).any()


@pytest.mark.parametrize("length", [8, 100])
def test_training_order(spark, library, tmp_path, length):
    data = [(i, words(i, i % 40), "en", "s", 0) for i in range(200)] + [(None, None, "en", "s", 0)]
    encoded = bpe.encode(documents(spark, data).coalesce(3), RANKS, public_tokenizers.PATTERN)
    path = str(tmp_path / "order")
    made = ordering.materialise(encoded, path, length, key=3, end_id=50256, shards=7)
    got = sorted(spark.read.parquet(path).collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in got] == list(range(made["sequences"]))
    assert sorted(r["slot"] for r in got) == list(range(made["sequences"]))
    assert all(r["slot"] == ordering.permuted(np.array([r["sequence"]]), made["sequences"], 3)[0] for r in got)
    assert all(r["shard"] == r["slot"] // made["stride"] and len(r["record"]) == 2 * length for r in got)
    flow = np.frombuffer(b"".join(bytes(r["record"]) for r in got), "<u2").tolist()
    n = sum(r["n_tokens"] for r in got)
    assert set(flow[n:]) <= {ordering.PAD}
    stops = [i for i, t in enumerate(flow[:n]) if t == 50256]
    parts = [flow[a:b] for a, b in zip([0, *[s + 1 for s in stops]], stops)]
    assert sorted(parts) == sorted(ids for _, ids in expected(library, data))
    later = ordering.read_from(spark, path, made["stride"] + 2, made["stride"]).collect()
    assert [r["slot"] for r in later] == list(range(made["stride"] + 2, made["sequences"]))


def test_training_order_of_nothing(spark, tmp_path):
    made = ordering.materialise(spark.createDataFrame([], "ids array<int>"), str(tmp_path / "none"), 8, 1, 50256)
    assert made["sequences"] == 0
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert ordering.materialise(none, str(tmp_path / "one"), 8, 1, 50256)["sequences"] == 1
    assert spark.read.parquet(str(tmp_path / "one")).select(F.sum("n_tokens")).first()[0] == 1


def test_batches_of_lists_are_cut_by_items():
    lists = [[1] * 5, None, [], [2] * 30, *[[3, 4]] * 40]
    whole = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), pa.array(range(len(lists)))], names=["ids", "k"])
    parts = list(by_bytes(iter([whole, whole.slice(3, 7), whole.slice(0, 0)]), "ids", 12))
    assert [k for p in parts for k in p.column("k").to_pylist()] == [*range(len(lists)), *range(3, 10)]
    assert [v for p in parts for v in p.column("ids").to_pylist()] == [*lists, *lists[3:10]]
    assert all(p.num_rows == 1 or len(p.column("ids").flatten()) <= 12 for p in parts)
