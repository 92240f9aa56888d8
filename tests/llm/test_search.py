"""Phrase index, reversed search and collocations against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import clashing, documents, rows, words
from tidewell.llm import collocations, postings, reversed_search

ITEMS = "item_id long, text string, _window string, _term string, rank string, doc_id string"


def benchmark(spark, data):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in data], ITEMS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


ITEM_TEXTS = [
    (1, " ".join(words(1, 40).split()[5:30])), (2, "one two"), (2, "one"), (3, None), (4, ""), (5, "...!!"), (None, words(3, 12)),
    (6, "Straße, ünïcode!"), (7, "日本語 العربية"), (8, "never said anywhere in any of these texts at all really"), (9, words(2, 300)),
    (10, words(2, 300)), (11, "a a a a a a a a a a a a"),
]
DOCS = rows() + [
    (30, "- " + words(1, 40).upper() + " -", "en", "s", 0), (31, words(2, 150), "en", "s", 0), (32, " ".join(["a"] * 25) + " b " + " ".join(["a"] * 9), "en", "s", 0),
    (33, "one-two, one: two one", "en", "s", 0), (34, ";" + words(3, 12), "en", "s", 0), (0, words(3, 12), "en", "s", 0), (None, words(3, 12), "en", "s", 0),
]


def plain_contamination(docs, items, length):
    windows = set()
    for item, text in items:
        said = terms(text)
        if said:
            windows |= {(item, tuple(said[s:s + length])) for s in range(max(1, len(said) - length + 1))}
    out = []
    for doc, text, *_ in docs:
        said, hit, seen = terms(text), set(), set()
        for item, window in windows:
            for s in range(len(said) - len(window) + 1):
                if tuple(said[s:s + len(window)]) == window:
                    hit |= set(range(s, s + len(window)))
                    seen.add(item)
        out.append((doc, len(said), len(hit), tuple(sorted(str(i) for i in seen if i is not None))))
    return Counter(out)


@pytest.mark.parametrize("length, few", [(10, 1 << 18), (3, 1 << 18), (1, 1 << 18), (10, 0), (2, 0)])
def test_contamination(spark, monkeypatch, length, few):
    monkeypatch.setattr(postings, "FEW", few)
    got = postings.contamination(clashing(documents(spark, DOCS)), benchmark(spark, ITEM_TEXTS), length).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == plain_contamination(DOCS, ITEM_TEXTS, length)


def test_contamination_of_little(spark):
    none = postings.contamination(documents(spark, DOCS), benchmark(spark, []), 10).collect()
    assert len(none) == len(DOCS) and not any(r["n_hit"] or r["items"] for r in none)
    assert postings.contamination(documents(spark, []), benchmark(spark, ITEM_TEXTS), 10).collect() == []
    assert postings.proximity(documents(spark, []), benchmark(spark, ITEM_TEXTS)).collect() == []


def test_proximity(spark):
    r = random.Random(3)
    docs = [(i, " ".join(r.choice("abcdefgh") for _ in range(60)), "en", "s", 0) for i in range(8)]
    docs += [(20, "h g x x b a", "en", "s", 0), (21, "a x x x x x x x x b", "en", "s", 0), (22, None, "en", "s", 0)]
    items = [(1, "a b"), (2, "a b g h"), (3, "c d e f"), (4, "q a"), (5, "b b a"), (6, None)]
    length, within = 4, 6
    index = Counter(t for _, text, *_ in docs for t in terms(text))
    wanted = {}
    for item, text in items:
        said = terms(text)
        if not said or any(t not in index for t in said):
            continue
        rarest = min((index[t], k, t) for k, t in enumerate(said))
        for doc, held, *_ in docs:
            held = terms(held)
            places = {p for p, t in enumerate(held) if t == said[rarest[1]] and any(
                set(said) <= set(held[s:s + within]) for s in range(max(0, p - within + 1), p + 1))}
            if places:
                wanted[doc, item] = len(places)
    got = postings.proximity(documents(spark, docs), benchmark(spark, items), length, within).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_places"] for r in got} == wanted and len(got) == len(wanted)


def plain_search(docs, items, k):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t, *_ in docs if terms(t)]
    n_docs, n_terms, df = len(held), sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, count, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 12 * m)) for t in terms(text) if t in count)
            scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -neg) for rank, (neg, _, _, doc) in enumerate(sorted(scored)[:k], 1) if neg < 0]
    return Counter(out)


@pytest.mark.parametrize("block, piece", [(1 << 18, 1 << 20), (30, 64)])
def test_reversed_search(spark, monkeypatch, block, piece):
    monkeypatch.setattr(reversed_search, "POSTINGS", block)
    monkeypatch.setattr(reversed_search, "SLICE", piece)
    for k in (3, 20):
        got = reversed_search.top_documents(clashing(documents(spark, DOCS)).repartition(5), benchmark(spark, ITEM_TEXTS), k).collect()
        assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == plain_search(DOCS, ITEM_TEXTS, k)


def test_reversed_search_of_little(spark):
    assert reversed_search.top_documents(documents(spark, DOCS), benchmark(spark, [])).collect() == []
    assert reversed_search.top_documents(documents(spark, [(1, None, "en", "s", 0)]), benchmark(spark, ITEM_TEXTS)).collect() == []
    assert reversed_search.top_documents(documents(spark, []), benchmark(spark, ITEM_TEXTS)).collect() == []


def phrase_docs():
    r = random.Random(7)
    vocabulary = ["the", "of", "New", "york", "é", "city", "a", "b-c", "x", "'s"]
    docs = [(i, " ".join(r.choice(vocabulary) + r.choice(["", "", "", "", ".", "\n", ",\t"]) for _ in range(r.randint(0, 80))), [None, "en", "und", "de"][i % 4], "s", 0) for i in range(120)]
    docs += [(200 + i, "new York city hall opened", "en", "s", 0) for i in range(40)] + [(300, None, "en", "s", 0), (301, "", None, "s", 0), (302, "\t \n..", "fr", "s", 0)]
    return docs + [(303, "one word " * 40, "fr", "s", 0), (304, "z\xa0y \x1c z\xa0y " * 31, "fr", "s", 0), *rows()]


def plain_collocations(docs, least, first):
    f, totals = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            said = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(said)
            f.update((lang, tuple(said[i:i + k])) for k in range(1, 5) for i in range(len(said) - k + 1))
    often = {key: n for key, n in f.items() if n >= least}
    covered = Counter()
    for (lang, p), n in often.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                covered[lang, p[i:i + size]] = max(covered[lang, p[i:i + size]], n)
    kept = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and 100 * covered[lang, p] < 80 * a:
            score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            kept.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, totals[lang], -score)
            for lang, own in kept.items() for rank, (score, a, p, left, right) in enumerate(sorted(own)[:first], 1)}


@pytest.mark.parametrize("limits", [
    {}, {"TILE": 2, "DENSE": 3, "TOGETHER": 2, "BUFFER": 200, "HELD": 5, "SLICE": 16},
    {"RANKED_WORDS": 4, "RANKED_PHRASES": 5, "HELD": 3}, {"RANKED_WORDS": 0}, {"RANKED_PHRASES": 1, "SIEVE_BITS": 1 << 15, "SLICE": 8},
])
def test_collocations(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(collocations, name, value)
    docs = phrase_docs()
    for first in (7, 2000):
        got = collocations.collocations(clashing(documents(spark, docs)).repartition(4), least=12, first=first).collect()
        assert {tuple(r) for r in got} == plain_collocations(docs, 12, first) and len(got) > 10


def test_collocations_of_little(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None, None, 0), (2, "", "en", "s", 0)])).collect() == []
