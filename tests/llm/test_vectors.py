"""Vector searches against brute force, and the pipeline's contract."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.samples import clashing, documents, words
from tidewell.llm import ann, bpe, kdtree, mixing, quality

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, n=400, dims=16, copies=0):
    random = np.random.default_rng(1)
    x = random.normal(size=(n, dims)).astype(np.float32)
    x[1::10] = x[::10] + 0.01 * random.normal(size=x[1::10].shape).astype(np.float32)
    if copies:
        x[:copies] = x[0]
    data = [(i, x[i].tolist(), i % 3) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    data += [(n, None, 0), (n + 20, [0.0] * dims, 0), (n + 40, [nan] * dims, 0), (n + 60, [inf] + [0.0] * (dims - 1), 0), (n + 80, [None] + [1.0] * (dims - 1), 0), (None, [1.0] * dims, 0)]
    return clashing(spark.createDataFrame(data, SCHEMA)), x.astype(float)


def brute(x, ids, q, k, exact=None):
    s = (x if exact is None else exact) @ (x if exact is None else exact)[q]
    order = [i for i in np.lexsort([ids, -s]) if ids[i] != ids[q]]
    return [(int(ids[i]), s[i]) for i in order[:k]]


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("copies", [0, 150])
def test_neighbours_have_recall(spark, copies):
    df, x = vectors(spark, copies=copies)
    got = by_query(ann.search(df, lambda i: F.pmod(i, F.lit(20)) == 0, k=10).collect())
    ids = np.arange(len(x))
    assert set(got) == set(range(0, 400, 20))
    hit = 0
    for q, found in got.items():
        wanted = brute(x, ids, q, 10)
        hit += len({v for v, _ in wanted} & {v for v, _ in found})
        assert all(abs(s - x[q] @ x[v]) < 1e-9 and v != q for v, s in found)
        assert [(-s, v) for v, s in found] == sorted((-s, v) for v, s in found)
    assert hit >= 0.9 * 10 * len(got)


def test_scan_of_a_block_finds_the_nearest():
    random = np.random.default_rng(2)
    x = random.normal(size=(1500, 64))
    turn = np.linalg.qr(random.normal(size=(64, 64)))[0]
    ids, q = np.arange(1500), np.arange(0, 1500, 50)
    pairs = ann._scan(x[q] @ turn, q, x @ turn, ids, (x**2).sum(axis=1), 10)
    assert len(pairs) < 0.6 * len(q) * 1500
    best = ann._best(q, x[q], ids, x, pairs, 10)
    wanted = [(int(i), v, s) for i in q for v, s in brute(x, ids, i, 10)]
    assert len(set((a, b) for a, b, _ in best) & set((a, b) for a, b, _ in wanted)) >= 0.97 * len(wanted)


@pytest.mark.parametrize(("copies", "shard", "leaf"), [(0, 100, 16), (150, 1 << 14, 256), (400, 64, 8)])
def test_exact_top_k(spark, monkeypatch, copies, shard, leaf):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 4)
    df, x = vectors(spark, copies=copies)
    got = by_query(kdtree.exact_top_k(df, lambda i: F.pmod(i, F.lit(50)) == 0, k=5).collect())
    whole = np.floor(256 * x).astype(np.int64)
    # the zero vector takes part here
    whole, ids = np.concatenate([whole, np.zeros((1, 16), np.int64)]), np.append(np.arange(400), 420)
    assert set(got) == set(range(0, 400, 50))
    for q, found in got.items():
        assert found == brute(x, ids, q, 5, whole)


def test_tree_boxes_are_tight_and_leaves_small():
    x = np.random.default_rng(3).normal(size=(500, 4))
    tree = kdtree.Tree(x, leaf=20)
    leaves = [m for m in tree.members if m is not None]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(map(len, leaves)) <= 20
    q = np.random.default_rng(4).normal(size=(5, 4))
    bounds = tree.bounds(q)
    for node, own in enumerate(tree.members):
        if own is not None:
            assert (tree.low[node] == x[own].min(axis=0)).all() and ((x[own] @ q.T).max(axis=0) <= bounds[:, node] + 1e-9).all()


def test_searches_of_little(spark):
    for search in (lambda d: ann.search(d, lambda i: i == 1, k=3), lambda d: kdtree.exact_top_k(d, lambda i: i == 1, k=3)):
        assert search(spark.createDataFrame([], SCHEMA)).collect() == []
        two = search(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 0.5], 0), (1, [3.0, 3.0], 0)], SCHEMA)).collect()
        assert {r["vec_id"] for r in two} == {2}


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns, name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_dedup", "source_mixing", "byte_level_bpe"]
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_pipeline_against_a_plain_chain(spark, tmp_path):
    """Predicted documents, all-pairs classes at five words and 0.8, whole copies by the mix, library token ids."""
    import corpus_pipeline
    from tests.llm.test_corpus import plain_classes, plain_mix

    data = []
    for i in range(160):
        text = words(i, 60) if i % 4 else words(i, 20).upper() + " !!! $$$ ###"
        data.append((i, text, "en", None if i % 9 == 0 else f"s{i % 3}", len(text)))
    for k in range(30):
        near = words(1 + 4 * k, 60).split()
        near[k % 60] = "other"
        data.append((200 + k, " ".join(near), "en", "s1", 0))
    data += [(300, "", "en", "s0", 0), (301, None, "en", "s2", 0)]
    folder = str(tmp_path)
    documents(spark, data).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    scored = quality.score(documents(spark, data), spark.read.parquet(f"{folder}/labels.parquet")).collect()
    good = {r["doc_id"] for r in scored if r["predicted"]}
    assert {i for i in range(160) if i % 4} <= good and not {i for i in range(160) if i % 4 == 0} & good
    kept = [r for r in data if r[0] in good]
    low = plain_classes(kept, 5, 80)
    kept = [r for r in kept if low[r[0]][1] == r[0]]
    size, total, target = plain_mix(kept)
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(documents(spark, kept)).collect()}
    for source in total:
        own = [taken[r[0]][0] for r in kept if r[3] == source]
        assert abs(sum(own) - target[source]) <= max(s for r, s in zip(kept, size) if r[3] == source)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    wanted = Counter()
    for (i, text, *_), n in zip(kept, size):
        copies = taken[i][0] // n if n else None
        if copies is None:
            continue  # follows the whole epochs of its source
        wanted[i, tuple(library.encode_ordinary(text))] += copies
    wanted = +wanted
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect() if r["n_tokens"])
    assert got == wanted and len(got) > 60


def test_probes_reach_enough_rows_in_small_lists(spark, monkeypatch):
    """One tight far cluster and few rows per list: every query still finds all it can."""
    random = np.random.default_rng(8)
    x = np.concatenate([random.normal(size=(200, 8)), 50 + random.normal(size=(200, 8)) * 1e-3])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    monkeypatch.setattr(ann, "fit", lambda rows, queries, k, recall: ann.Index(
        np.concatenate([random.normal(size=(30, 8)), np.full((1, 8), -1.0), np.ones((1, 8))]), np.eye(8), 1))
    got = by_query(ann.search(df, lambda i: F.pmod(i, F.lit(20)) == 0, k=20).collect())
    assert set(got) == set(range(0, 400, 20)) and all(len(found) == 20 for found in got.values())


def test_exact_scores_beyond_doubles_and_longs(spark):
    random = np.random.default_rng(9)
    for size in (1e10, 1e16):
        x = np.round(random.normal(size=(60, 4)) * size)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = by_query(kdtree.exact_top_k(df, lambda i: F.pmod(i, F.lit(10)) == 0, k=3, scale=1).collect())
        whole, most = [[int(c) for c in row] for row in x], (1 << 63) - 1
        for q, found in got.items():
            exact = {v: max(-most, min(most, sum(a * b for a, b in zip(whole[q], whole[v])))) for v in range(60) if v != q}
            assert [s for _, s in found] == sorted(exact.values(), reverse=True)[:3] and all(exact[v] == s for v, s in found)
