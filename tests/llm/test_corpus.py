"""Shards, mixing, classifier, language model and near duplicates against plain Python."""

import math
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions.session import shared_folder
from tests.llm.samples import clashing, documents, rows, words
from tidewell.llm import components, ctw, mixing, neardup, quality, shards
from tidewell.llm.common import word_count


def test_word_count(spark):
    got = documents(spark).select("text", word_count(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len((r["text"] or "").encode().split()) for r in got)


# shards

def cut(spark, data, n=5, **more):
    items = spark.createDataFrame(data, "doc_id long, size long, g long, shard string, _at string, slot string")
    return shards.by_bytes(items, "size", ["g", "doc_id"], n, group=["g"], **more).collect()


def test_shards_against_a_plain_cut(spark):
    """Rows in order, each to the shard in whose share its first byte falls; clashing columns pass through."""
    data = [(i, 5 + (i * 29) % 90, (i * 7) % 50, "s", "at", "slot") for i in range(400)]
    items = spark.createDataFrame(data, "doc_id long, size long, g long, _one string, _before string, _part string")
    out = shards.by_bytes(items, "size", ["g", "doc_id"], 9)
    assert out.columns == [*items.columns, "shard", "slot"]
    total, before, at, wanted = sum(r[1] for r in data), 0, Counter(), {}
    for i, size, *_ in sorted(data, key=lambda r: (r[2], r[0])):
        shard = before * 9 // total
        wanted[i] = (shard, at[shard])
        at[shard] += 1
        before += size
    got = out.collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == wanted
    assert {(r["_one"], r["_before"], r["_part"]) for r in got} == {("s", "at", "slot")}


def test_shards_are_contiguous_and_balanced(spark):
    data = [(i, 10 + (i * 37) % 50, i // 3, "", "", "") for i in range(600)] + [(None, 20, None, "", "", "")] * 3
    got = cut(spark, data, 7, keep_together=0)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 2 * 60
    for k in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["g"] is not None, r["g"] or 0, r["doc_id"] or 0) for r in order]
    assert keys == sorted(keys)


def test_small_groups_stay_whole_and_large_ones_are_cut(spark):
    got = cut(spark, [(i, 10, i // 7, "", "", "") for i in range(1400)], 10, keep_together=0.1)
    assert all(n == 1 for n in Counter(g for g, _ in {(r["g"], r["shard"]) for r in got}).values())
    got = cut(spark, [(i, 10, 0, "", "", "") for i in range(1000)], 10)
    assert set(Counter(r["shard"] for r in got).values()) == {100}


def test_shards_of_little(spark):
    assert cut(spark, [(1, 16, 1, "", "", "")])[0]["slot"] == 0
    empty = spark.createDataFrame([], "doc_id long, size long, g long")
    assert shards.by_bytes(empty, "size", ["g", "doc_id"], 4, group=["g"]).collect() == []


# mixing

def plain_mix(data, weights=(3, 1, 2), share=1.5, most=2.0):
    size = [len((t or "").encode().split()) for _, t, *_ in data]
    total = Counter()
    for (_, _, _, s, _), n in zip(data, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, budget = set(), share * sum(total.values())
    while True:
        free = sum(w for s, w in weight.items() if s not in full)
        level = (budget - sum(most * total[s] for s in full)) / free if free else math.inf
        more = {s for s in order if level * weight[s] > most * total[s]} | full
        if more == full:
            return size, total, {s: min(most * total[s], level * weight[s]) for s in order}
        full = more


def test_mix_meets_targets(spark):
    data = [(i, words(i, i % 30), "en", None if i % 11 == 0 else ("a" if i % 3 else f"b{i % 7}"), 0) for i in range(600)] + rows()
    size, total, target = plain_mix(data)
    got = mixing.mix(clashing(documents(spark, data))).collect()
    assert len(got) == len(data)
    by = {s: target[s] for s in total}
    assert {(round(r["target"], 6), r["source_size"]) for r in got} == {(round(by[s], 6), total[s]) for s in total}
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    for s in total:
        assert abs(taken[round(by[s], 6), total[s]] - by[s]) <= 4000
    again = mixing.mix(documents(spark, data).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    copies = mixing.mixed(clashing(documents(spark, data)))
    assert copies.columns == clashing(documents(spark, data)).columns
    assert copies.select(F.sum(word_count(F.col("text")))).first()[0] == sum(r["taken"] for r in got)


def test_larger_shares_take_supersets(spark):
    docs = documents(spark, [(i, words(i, 1 + i % 30), "en", f"s{i % 2}", 0) for i in range(300)])
    less, more = ({r["doc_id"]: r["taken"] for r in mixing.mix(docs, share=share).collect()} for share in (0.4, 0.6))
    assert all(more[i] >= n for i, n in less.items()) and more != less


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None, "en", None, 0), (2, "", "en", "s", 0)])).collect()] == [0, 0]


# quality

def labelled(n):
    good = [(i, words(i, 60).capitalize() + ".", "en", "s", 0) for i in range(n)]
    bad = [(n + i, " ".join(w.upper() + "!!" for w in words(n + i, 60).split()), "en", "s", 0) for i in range(n)]
    return good + bad, [(i, 1) for i in range(n)] + [(n + i, 0) for i in range(n)] + [(None, 1), (3, None), (4, 7), (10**6, 1)]


def test_quality_on_held_out_rows(spark):
    data, labels = labelled(150)
    docs, known = documents(spark, data + rows()[1:4]), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score(clashing(docs), known).where("doc_id > 16").collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert len(held) > 30 and np.mean([got[i]["predicted"] == (i < 150) for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    flipped = known.select("doc_id", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    same = {r["doc_id"]: r["score"] for r in quality.score(docs, flipped).where("doc_id > 16").collect()}
    assert same == {i: r["score"] for i, r in got.items()}
    kept = quality.good(clashing(docs), known)
    assert kept.columns == clashing(docs).columns
    predicted = {r["doc_id"] for r in quality.score(docs, known).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.collect()} == predicted


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(documents(spark), none).collect()} == {0.5}
    assert quality.score(documents(spark, []), none).collect() == []


def plain_quality(texts, labels, folds):
    """Scores of all texts by a numpy fit: Gaussian features, ridge per fold, out-of-fold calibration."""
    classes = quality._class_of_byte()
    stats = np.stack([quality.statistics(t, classes) for t in texts]).astype(np.float32).astype(float)
    rows = np.array(sorted(labels))
    y, fold = np.array([labels[i] for i in rows]), np.array([folds[i] for i in rows])
    mean, scale = stats[rows].mean(axis=0), np.sqrt(np.maximum(stats[rows].var(axis=0), 1e-6))
    random = np.random.default_rng(3)
    turn = random.normal(size=(quality.STATISTICS, quality.FEATURES)) / quality.WIDTH
    shift = random.uniform(0, 2 * np.pi, quality.FEATURES)
    x = np.concatenate([np.cos(np.clip((stats - mean) / scale, -8, 8) @ turn + shift), np.ones((len(stats), 1))], axis=1)

    def ridge(own):
        gram = x[rows[own]].T @ x[rows[own]]
        penalty = quality.RIDGE * own.sum() * np.eye(len(gram))
        penalty[-1, -1] = 0
        return np.linalg.solve(gram + penalty + 2e-9 * np.eye(len(gram)), x[rows[own]].T @ y[own])

    outside = np.zeros(len(rows))
    for f in (0, 1):
        outside[fold == f] = x[rows[fold == f]] @ ridge(fold != f)
    order = np.argsort(quality.bin_of(outside), kind="stable")
    bins, ones = quality.bin_of(outside)[order], y[order]
    steps, best = np.zeros(quality.BINS), []
    for b, v in zip(bins, ones):  # pool adjacent violators, label by label
        best.append([float(v), 1.0, b])
        while len(best) > 1 and (best[-2][2] == best[-1][2] or best[-2][0] / best[-2][1] >= best[-1][0] / best[-1][1]):
            s, n, last = best.pop()
            best[-1] = [best[-1][0] + s, best[-1][1] + n, last]
    at = 0
    for s, n, last in best:
        steps[at:last + 1], at = s / n, last + 1
    steps[at:] = best[-1][0] / best[-1][1]
    return steps, quality.bin_of(x @ ridge(np.ones(len(rows), bool)))


def test_quality_against_a_plain_fit(spark):
    data = [(i, (words(i, 40) if i % 3 else words(i, 40).upper() + " !!! $$$" * (i % 5)) + " x" * (i % 11), "en", "s", 0) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0 or i % 7 == 0)) for i in range(300)], "doc_id long, quality int")
    docs = documents(spark, data)
    held = {r["doc_id"]: r["held_out"] for r in quality.score(docs, labels).collect()}
    folds = dict(map(tuple, docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()))
    steps, bins = plain_quality([t for _, t, *_ in data], {i: int(i % 3 > 0 or i % 7 == 0) for i in range(300) if not held[i]}, folds)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, labels).collect()}
    near = [min(abs(got[i] - steps[max(0, b - 3):b + 4])) < 0.02 for i, b in enumerate(bins)]
    assert np.mean(near) > 0.98


def test_isotonic():
    steps = quality.isotonic(np.array([0, 1, 1, 2, 0, 1.0]), np.array([0.9, 0.5, 0.1, 0.4, 0.0, 1.0]))
    assert (np.diff(steps) >= 0).all() and np.allclose(steps, [0.3, 0.3, 0.3, 0.4, 0.4, 1.0])


def test_features_approach_the_gaussian_kernel():
    random = np.random.default_rng(0)
    n = quality.STATISTICS
    turn, shift = random.normal(size=(n, 4000)) / quality.WIDTH, random.uniform(0, 2 * np.pi, 4000)
    model = quality.Model(np.zeros(n), np.ones(n), turn, shift, np.zeros(1), np.zeros(1))
    x = random.normal(size=(6, n))
    f = model.features(x)[:, :-1] / quality.UNIT
    wanted = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * quality.WIDTH**2))
    assert np.abs(2 * f @ f.T / 4000 - wanted).max() < 0.1


# language model

def test_contexts_hold_six_bytes():
    one, other = (ctw.contexts(ctw.stream([[w]])[0])[6] for w in (b"1abcdex", b"2abcdex"))
    assert one & 255 == other & 255 == ord("x") and one != other


def exact_ctw(texts, scored):
    """log10 probability of each scored text when every context seen in ``texts`` is a node."""
    def steps(t):
        f = ctw.stream([t])[0].tolist()
        for i in range(ctw.DEPTH, len(f)):
            for j in range(8):
                yield [(tuple(f[i - d:i]), j, f[i] >> 8 - j) for d in range(ctw.DEPTH + 1)], f[i] >> 7 - j & 1

    seen, below = {}, Counter()
    for t in texts:
        for path, bit in steps(t):
            for node in path:
                seen.setdefault(node, [0, 0])[bit] += 1
    weight = {}
    for node in sorted(seen, key=lambda node: -len(node[0])):
        context, j, prefix = node
        a, b = seen[node]
        own = both = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        weight[node] = 1.0
        if len(context) < ctw.DEPTH:
            both = np.logaddexp(own, below[node]) - math.log(2)
            weight[node] = math.exp(own - math.log(2) - both)
        below[context[1:], j, prefix] += both if context else 0
    out = []
    for t in scored:
        total = 0.0
        for path, bit in steps(t):
            p, left = 0.0, 1.0
            for node in path:
                a, b = seen.get(node, (0, 0))
                w = weight.get(node, 0.5 if len(node[0]) < ctw.DEPTH else 1.0)
                p, left = p + left * w * (b + 0.5) / (a + b + 1), left * (1 - w)
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


@pytest.mark.parametrize(("share", "part", "held"), [(2.0**-24, 1 << 18, 1 << 22), (2.0**-10, 1000, 400)])
def test_every_seen_context_has_its_estimate(spark, monkeypatch, share, part, held):
    """More than 2**16 positions, so that a context seen once has less than 2**-16 of them."""
    monkeypatch.setattr(ctw, "KEY_SHARE", share)
    monkeypatch.setattr(ctw, "HELD_KEYS", held)
    monkeypatch.setattr(ctw, "PART_KEYS", part)
    data = [(i, words(i, 2000), "en", "s", 0) for i in range(9)] + [(20, words(3, 300) + " zq", "en", "s", 0), (21, None, "en", "s", 0)]
    got = {r["doc_id"]: r["score"] for r in ctw.score(documents(spark, data), F.col("doc_id") < 9).collect()}
    spoken = {i: ctw.words_of(t) for i, t, *_ in data}
    wanted = exact_ctw([spoken[i] for i in range(9)], [spoken[i] for i in (0, 20, 21)])
    assert np.allclose([got[i] for i in (0, 20, 21)], wanted, rtol=1e-6)


def test_base_and_counts(spark):
    data = rows() + [(100 + i, words(i, 5 + i), "en", "s", 0) for i in range(40)]
    train = [t for i, t, *_ in data if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*(t or "").encode().lower().split(), None])
    n = sum(c.values())
    got = sorted(ctw.held_out_scores(clashing(documents(spark, data))).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]))
    wanted = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, len((r[1] or "").encode().split())))
    assert len(got) == len(wanted)
    for r, (i, t, *_) in zip(got, wanted):
        w = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((c[x] + 1) / (n + len(c) + 1)) for x in w)
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, len(w), sum(c[x] > 0 for x in w), n)
        assert abs(r["base_score"] - base) < 1e-9 * abs(base) and r["score"] < 0


def test_language_model_of_nothing(spark):
    assert ctw.held_out_scores(documents(spark, [])).collect() == []
    untrained = ctw.score(documents(spark, [(1, "ab", "en", "s", 0)]), F.lit(False)).first()
    assert untrained["n_known"] == 0 and abs(untrained["score"] - 3 * math.log10(1 / 256)) < 1e-4


def test_contexts_of_a_task_are_counted_in_place():
    """What a task needs beside the contexts that it holds is smaller than these."""
    random = np.random.default_rng(3)
    key, learned = random.integers(0, 1 << 14, 1 << 19), random.integers(0, 2, 1 << 19)
    marked = key << 1 | learned
    tracemalloc.start()
    found = ctw.counted(marked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < marked.nbytes
    assert list(zip(*(c.tolist() for c in found))) == [
        (k, int(n), int(m)) for k, n, m in zip(range(1 << 14), np.bincount(key, learned, 1 << 14), np.bincount(key, minlength=1 << 14)) if m]
    assert [len(c) for c in ctw.counted(np.zeros(0, np.int64))] == [0, 0, 0]


def test_counts_beyond_the_table_of_log_gammas(monkeypatch):
    counts = np.arange(0, 5000, 7.0)
    wanted = [ctw._log_gamma(counts + plus) for plus in (0.5, 1.0)]
    monkeypatch.setattr(ctw, "SMALL", 100)
    ctw._small.cache_clear()
    got = [ctw._log_gamma_of(counts, plus) for plus in (0.5, 1.0)]
    ctw._small.cache_clear()
    assert all(np.array_equal(g, w) for g, w in zip(got, wanted))
    assert np.allclose(wanted[1], [math.lgamma(n + 1) for n in counts], rtol=1e-12)


# near duplicates

def plain_classes(data, words_, percent):
    sets = {}
    for i, t, *_ in data:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + words_]) for k in range(len(w) - words_ + 1)} or ({tuple(w)} if w else set())
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and low[b] < low[a]:
                    low[a], changed = low[b], True
    return {i: (len(sets[i]), low[i]) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, n, percent):
    data = [r for r in rows() if r[0] is not None]
    for k in range(60):
        text = words(k % 20, 120).split()
        for at in range(k // 20 * 2):
            text[(at * 41 + k) % 120] = f"new{k}{at}"
        data.append((100 + k, " ".join(text), "en", "s", 0))
    got = neardup.near_duplicates(clashing(documents(spark, data)), n, percent).collect()
    wanted = plain_classes(data, n, percent)
    assert len(got) == len(data)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_group_of_near_copies(spark):
    base = words(7, 150).split()
    data = []
    for k in range(400):
        text = list(base)
        text[k % 150], text[(k * 7) % 150] = f"x{k}", f"y{k}"
        data.append((k + 1, " ".join(text), "en", "s", 0))
    got = neardup.near_duplicates(documents(spark, data), 3, 85).collect()
    wanted = plain_classes(data, 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == wanted


@pytest.mark.parametrize("block", [1 << 20, 4000])
def test_links_in_a_crowded_region(spark, monkeypatch, block):
    """A template family in which all texts are 0.75 alike, some 0.86, when the window holds no more than the next row."""
    base = words(8, 120)
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "REACH", 1)
    tails = [[f"own{k}x{i}" for i in range(20)] for k in range(150)]
    tails += [[*tails[k][:10], *(f"new{k}x{i}" for i in range(10))] for k in range(12)]
    tails += [[*tails[0][:12], *(f"more{i}" for i in range(8))]] + [[*tails[1][:19], f"copy{k}"] for k in range(60)]
    data = [(k, f"{base} {' '.join(tail)}", "en", "s", 0) for k, tail in enumerate(tails)]
    got = neardup.near_duplicates(documents(spark, data), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_classes(data, 3, 85)


def written(spark, act):
    """Bytes that a query leaves in the shared folder."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    act()
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file()) - before


def test_a_template_family_is_not_copied_by_blocks(spark, monkeypatch):
    """1,500 texts 0.66 alike, in many blocks: what is written stays within a few times the input."""
    base = words(9, 150)
    monkeypatch.setattr(neardup, "BLOCK", 25_000)
    data = [(k, f"{base} {' '.join(f'own{k}x{i}' for i in range(38))}", "en", "s", 0) for k in range(1500)]
    docs = documents(spark, data)
    size = sum(len(r[1]) for r in data)
    got = []
    assert written(spark, lambda: got.extend(neardup.near_duplicates(docs, 3, 85).collect())) < 4 * size
    assert all(r["component_id"] == r["doc_id"] for r in got)


def test_crowded_runs_make_no_pairs_of_texts(spark, monkeypatch):
    """300 texts 0.76 alike, some 0.86: pairs that are read in full grow with the rows, not with what each has around it."""
    base, read, confirmed = words(8, 130), [], neardup.confirmed

    def counting(pairs, *more):
        read.append(pairs.count())
        return confirmed(pairs, *more)

    monkeypatch.setattr(neardup, "confirmed", counting)
    tails = [[f"own{k}x{i}" for i in range(18)] for k in range(300)]
    tails += [[*tails[k][:10], *(f"new{k}x{i}" for i in range(8))] for k in range(12)]
    data = [(k, f"{base} {' '.join(tail)}", "en", "s", 0) for k, tail in enumerate(tails)]
    got = neardup.near_duplicates(documents(spark, data), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_classes(data, 3, 85)
    assert sum(read) < 24 * len(data)


def test_near_duplicates_edge_rows(spark):
    docs = documents(spark)
    null = neardup.near_duplicates(docs).where("doc_id is null").collect()
    assert all(r["component_id"] is None and r["kept"] for r in null) and len(null) == 2
    assert neardup.near_duplicates(documents(spark, [])).collect() == []
    kept = neardup.deduplicated(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 11 not in ids and 14 not in ids and 15 not in ids and {10, 13, 2, 3, 4} <= set(ids) and ids.count(None) == 2
    assert ids.count(16) == 1
    text = words(21, 80)
    more = documents(spark, [(None, text, "en", "s", 0)] * 3 + [(7, text, "en", "s", 0), (7, "other " + words(22, 60), "en", "s", 0), (None, None, "en", "s", 0), (None, None, "en", "s", 0)])
    assert sorted(map(str, [r["doc_id"] for r in neardup.deduplicated(more).collect()])) == ["7", "7", "None"]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)}


@pytest.mark.parametrize("chunk", [1 << 18, 50, 1])
def test_components_in_chunks(spark, monkeypatch, chunk):
    """Edges of one chunk, of several and of one edge each give the same components as a plain search."""
    monkeypatch.setattr(components, "CHUNK", chunk)
    random = np.random.default_rng(3)
    links = [tuple(map(int, x)) for x in random.integers(-90, 90, (70, 2))] + [(500 - k, 499 - k) for k in range(40)] + [(1 << 62, 7), (600, 600)]
    low = {x: x for link in links if link[0] != link[1] for x in link}
    for _ in low:
        for a, b in links:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(low) and dict(map(tuple, got)) == low


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def tasks(spark, act):
    """Tasks that an action runs."""
    context, group = spark.sparkContext, f"tasks-{id(act)}"
    context.setJobGroup(group, group)
    act()
    context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return sum(info.numCompletedTasks for s in stages if (info := status.getStageInfo(s)))


def test_components_of_few_links_take_few_tasks(spark):
    """A chain in many partitions: not a task for each of them in round after round."""
    links = spark.range(0, 300, 1, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = []
    assert tasks(spark, lambda: got.extend(components.components(links).collect())) < 60
    assert {tuple(r) for r in got} == {(k, 0) for k in range(301)}
