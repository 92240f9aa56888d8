"""A byte language model by context-tree weighting, beside a word unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, remainder, shuffle_partitions, stored

# Bytes of context, and the marks before and after a text; UTF-8 has neither.
DEPTH, BEGIN, END = 6, 0xFE, 0xFF
# Words of at least WORD_SHARE of all tokens, and contexts with their next byte
# of at least KEY_SHARE of all positions, are known to every task; all others
# are joined.
WORD_SHARE, KEY_SHARE = 2.0**-22, 2.0**-24
# Contexts with their next byte that a task weighs at once, about.
PART_KEYS = 1 << 17
# Positions whose contexts a task holds, eight bytes each, before it counts them and passes them on.
HELD_KEYS = 6 << 20
# Rows of a batch that is scored at once: a key and the row's place fill 64 bits.
ROWS = 256
# Counts below it have their log gamma read from a table.
SMALL = 1 << 16
# The token that ends a text, among the hashes of words.
END_TOKEN = 0
_COUNTED = "_kind byte, _key long, _n long, _all long"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def hashed_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of all texts, and the place among them of every word; a word is hashed once."""
    import xxhash

    spoken = pa.array([word for words in texts for word in words], pa.binary()).dictionary_encode()
    hashed = np.array([xxhash.xxh3_64_intdigest(word) for word in spoken.dictionary.to_pylist()], np.uint64).view(np.int64)
    return hashed, spoken.indices.to_numpy()


def stream(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each after DEPTH BEGIN marks and before an END, and the ends of the texts."""
    parts = [bytes([BEGIN]) * DEPTH + b" ".join(words) + bytes([END]) for words in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def contexts(flow: np.ndarray) -> np.ndarray:
    """DEPTH + 1 bytes packed for every predicted position: the context, the latest byte last, then the byte itself."""
    n = len(flow) - DEPTH
    packed = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        packed <<= 8
        packed |= flow[k:k + n]
    return packed[flow[DEPTH:] != BEGIN]


def turned(keys: np.ndarray) -> np.ndarray:
    """The context's bytes in reverse, the latest first, and the byte itself: sorted, every subtree is one run."""
    apart = np.ascontiguousarray(keys, "<i8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(apart[:, [0, *range(DEPTH, 0, -1), *range(DEPTH + 1, 8)]]).view("<i8").ravel()


def counted(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts with their byte, how often each was learned and how often it occurs.

    ``marked`` holds 2 * key + whether it is learned. It is sorted in place, as it may be large.
    """
    marked.sort()
    new = np.ones(len(marked), bool)
    np.not_equal(marked[1:], marked[:-1], out=new[1:])
    first = np.flatnonzero(new)
    if not len(first):
        return (np.zeros(0, np.int64),) * 3
    key, n = marked[first], np.diff(first, append=len(marked))
    start = np.flatnonzero(np.diff(key >> 1, prepend=-1))
    return key[start] >> 1, np.add.reduceat(n * (key & 1), start), np.add.reduceat(n, start)


def gather(docs: DataFrame, train: Column) -> DataFrame:
    """Counts: ``_kind`` 0 are training words by hash, 1 the turned contexts of all texts with the byte that follows.

    ``_n`` counts the texts where ``train`` holds, 0 for what only the others have; ``_all`` counts all.
    A task holds the contexts of HELD_KEYS positions, whatever it reads, and adds up those that are equal.
    """

    def out(kind: int, found: np.ndarray, times: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found[part]), kind, np.int8)), pa.array(found[part]), pa.array(times[part]), pa.array(total[part])],
                names=["_kind", "_key", "_n", "_all"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(HELD_KEYS, np.int64), 0
        for batch in by_bytes(batches, "text", 1 << 20):
            texts = [words_of(text) for text in batch.column("text").to_pylist()]
            learned = np.array(batch.column("_train").to_pylist(), bool)
            if learned.any():
                word, place = hashed_words([words for words, own in zip(texts, learned) if own])
                yield from out(0, np.append(word, END_TOKEN), *[np.append(np.bincount(place, minlength=len(word)), learned.sum())] * 2)
            flow, ends = stream(texts)
            marked = contexts(flow) << 1 | np.repeat(learned, np.diff(ends, prepend=0) - DEPTH)
            while len(marked):
                fits = min(len(marked), HELD_KEYS - size)
                held[size:size + fits] = marked[:fits]
                marked, size = marked[fits:], size + fits
                if size == HELD_KEYS:
                    key, own, every = counted(held)
                    yield from out(1, turned(key), own, every)
                    size = 0
        key, own, every = counted(held[:size])
        yield from out(1, turned(key), own, every)

    learned = F.coalesce(train, F.lit(False)).alias("_train")
    return docs.select("text", learned).mapInArrow(run, _COUNTED).groupBy("_kind", "_key").agg(F.sum("_n").alias("_n"), F.sum("_all").alias("_all"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 0.5: Stirling's series eight steps further on."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    rising = x.copy()
    for k in range(1, 8):
        rising *= x + k
    return series - np.log(rising)


@cache
def _small(plus: float) -> np.ndarray:
    return _log_gamma(np.arange(SMALL) + plus)


def _log_gamma_of(counts: np.ndarray, plus: float) -> np.ndarray:
    """``_log_gamma`` of whole numbers plus 0.5 or 1; nearly all counts are small."""
    found = _small(plus)[np.minimum(counts, SMALL - 1).astype(np.int32)]
    large = np.flatnonzero(counts >= SMALL)
    found[large] = _log_gamma(counts[large] + plus)
    return found


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - np.log(np.pi) - _log_gamma_of(zeros + ones, 1.0)


def _above(ids: np.ndarray) -> np.ndarray:
    """The same binary node in the context that is one byte shorter."""
    return ids >> 16 << 8 | ids & 255


@dataclass
class Level:
    """The binary nodes of a depth: context * 256 + node, what they saw, and the log of the children's product."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    below: np.ndarray | None = None
    up: np.ndarray | None = None

    def weighted(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Log of the weighted probability, and the weight of the node's own estimate."""
        own = _kt(self.zeros, self.ones)
        if d == DEPTH:
            return own, np.ones_like(own)
        both = np.logaddexp(own, self.below) - np.log(2)
        return both, np.exp(own - np.log(2) - both)


def levels(keys: np.ndarray, n: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """The levels over ascending turned keys, without products, and each key's places among the deepest nodes."""
    ids, zeros, ones, places, start = [], [], [], [], 0
    for j in range(8):
        new = np.diff(keys >> 8 - j, prepend=-1) != 0
        first, bit = np.flatnonzero(new), keys >> 7 - j & 1
        one = np.add.reduceat(n * bit, first)
        ids.append(keys[first] & ~255 | (1 << j) - 1 + ((keys[first] & 255) >> 8 - j))
        ones.append(one)
        zeros.append(np.add.reduceat(n, first) - one)
        places.append(np.cumsum(new) - 1 + start)
        start += len(first)
    found = [Level(np.concatenate(ids), np.concatenate(zeros), np.concatenate(ones))]
    for _ in range(DEPTH):
        low = found[0]
        up, low.up = np.unique(_above(low.ids), return_inverse=True)
        found.insert(0, Level(up, np.bincount(low.up, low.zeros), np.bincount(low.up, low.ones)))
    return found, np.stack(places)


def _open(level: Level, d: int, keys: np.ndarray) -> np.ndarray:
    """Nodes of the first and last context of a partition, which may go on in the next one."""
    context, shift = level.ids >> 8, 8 * (DEPTH + 1 - d)
    return (context == keys[0] >> shift) | (context == keys[-1] >> shift)


def borders(keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, Level]]:
    """A partition's share of its open nodes; their products cover the children that are whole inside it."""
    found, _ = levels(keys, n)
    for d in range(DEPTH, -1, -1):
        level = found[d]
        level.below = np.zeros(len(level.ids)) if d == DEPTH else np.bincount(found[d + 1].up, closed)
        at = _open(level, d, keys)
        closed = np.where(at, 0.0, level.weighted(d)[0])
        yield d, Level(level.ids[at], level.zeros[at], level.ones[at], level.below[at])


def joined(shares: list[Level]) -> list[Level]:
    """The open nodes of all partitions, with the open children added to their products; ids ascending."""
    for d in range(DEPTH - 1, -1, -1):
        at = np.searchsorted(shares[d].ids, _above(shares[d + 1].ids))
        shares[d].below = shares[d].below + np.bincount(at, shares[d + 1].weighted(d + 1)[0], len(shares[d].ids))
    return shares


def predictions(keys: np.ndarray, n: np.ndarray, whole: list[Level]) -> np.ndarray:
    """log10 of each key's byte after its context, by the mixture of all context trees.

    Every binary decision of the next byte has its own weighted context tree.
    A node either predicts by its own counts or leaves it to its children, with
    prior weights of one half: P = (KT + product of the children's P) / 2. With
    all counts known, the weights are fixed and a prediction is the mixture of
    the KT estimates along the path; a context never seen predicts one half.
    """
    found, places = levels(keys, n)
    weights: list[np.ndarray] = []
    for d in range(DEPTH, -1, -1):
        level = found[d]
        level.below = np.zeros(len(level.ids)) if d == DEPTH else np.bincount(found[d + 1].up, mine)
        at = np.flatnonzero(_open(level, d, keys))
        known = np.searchsorted(whole[d].ids, level.ids[at])
        for column in ("zeros", "ones", "below"):
            getattr(level, column)[at] = getattr(whole[d], column)[known]
        mine, weight = level.weighted(d)
        weights.insert(0, weight)
    mixed, left = np.zeros(1), np.ones(1)
    for d, (level, weight) in enumerate(zip(found, weights)):
        up = level.up if d else np.zeros(len(level.ids), int)
        mixed, left = mixed[up], left[up]
        mixed = mixed + left * weight * (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
        left = left * (1 - weight)
    bits = keys >> np.arange(7, -1, -1)[:, None] & 1
    return np.log10(np.where(bits, mixed[places], 1 - mixed[places])).sum(axis=0)


def model(counts: DataFrame) -> DataFrame:
    """``_key, _all, _log``: log10 of the byte after its context for every turned key; all seen contexts take part.

    The keys are sorted over partitions, so nearly all subtrees lie inside one.
    Only the contexts at the partitions' ends come to the driver, at most
    2 * (DEPTH + 1) a partition with up to 255 binary nodes each.
    """
    table = counts.where("_kind = 1").select("_key", "_n", "_all")
    parts = max(shuffle_partitions(counts), -(-table.count() // PART_KEYS))
    ordered = settle(table.repartitionByRange(parts, "_key").sortWithinPartitions("_key"))

    def held(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, np.ndarray] | None:
        rows = [batch for batch in batches if batch.num_rows]
        if not rows:
            return None
        part = pa.Table.from_batches(rows)
        return part, part["_key"].to_numpy(), part["_n"].to_numpy().astype(float)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if part := held(batches):
            for d, level in borders(*part[1:]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(level.ids), d, np.int32)), *map(pa.array, (level.ids, level.zeros, level.ones, level.below))], names=names)

    names = ["_depth", "_id", "_zeros", "_ones", "_below"]
    shares = ordered.mapInArrow(ends, "_depth int, _id long, _zeros double, _ones double, _below double").groupBy("_depth", "_id").agg(
        *[F.sum(c).alias(c) for c in names[2:]]).toArrow().sort_by([("_depth", "ascending"), ("_id", "ascending")])
    depth, *columns = (shares[c].to_numpy() for c in names)
    whole = joined([Level(*[c[depth == d] for c in columns]) for d in range(DEPTH + 1)])
    # plain arrays: what is broadcast is not sent with its class
    sent = counts.sparkSession.sparkContext.broadcast([(x.ids, x.zeros, x.ones, x.below) for x in whole])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if part := held(batches):
            log = predictions(*part[1:], [Level(*x) for x in sent.value])
            out = pa.table([part[0]["_key"], part[0]["_all"], pa.array(log)], names=["_key", "_all", "_log"])
            yield from out.to_batches(max_chunksize=1 << 16)

    return stored(ordered.mapInArrow(run, "_key long, _all long, _log double"))


def known_and_rare(key: np.ndarray, row: np.ndarray, frequent: np.ndarray, log: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """Each row's sum over the frequent keys, and the others as row, key and times; at most ROWS rows."""
    both = key.view(np.uint64) << np.uint64(8) | row.astype(np.uint64)
    both.sort()
    first = np.flatnonzero(np.diff(both, prepend=both[:1] - np.uint64(1)))
    times, both = np.diff(first, append=len(both)), both[first]
    row, key = (both & np.uint64(ROWS - 1)).view(np.int64), (both >> np.uint64(8)).view(np.int64)
    start = np.flatnonzero(np.diff(key, prepend=-1))
    each = np.diff(start, append=len(key))
    at = np.searchsorted(frequent, key[start]).clip(0, max(0, len(frequent) - 1))
    found = frequent[at] == key[start] if len(frequent) else np.zeros(len(start), bool)
    one = np.zeros(len(start))
    one[found] = log[at[found]]
    sums = np.bincount(row, np.repeat(one, each) * times, rows)
    rest = np.repeat(~found, each)
    return sums, row[rest], key[rest], times[rest]


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Score every document by the model learned where ``train`` holds.

    Returns ``doc_id, n_tokens, n_known, train_tokens, base_score, score``, a
    row per row of ``docs`` (``doc_id, text``). Tokens are lower-cased words and
    one end. The model predicts the bytes of the words, joined by one blank,
    and an end mark; ``score`` is the log10 probability of all of them. The
    base is the unigram with one added to each count and one unknown word.

    Counts of words and contexts cover all training texts and grow with them,
    and every context has its own estimate. What every task holds is bounded:
    the words with at least WORD_SHARE of all tokens and the contexts with
    their next byte of at least KEY_SHARE of all positions. Others are looked
    up by a join, in which no key can be hot for the same reason. Words count
    by 64-bit hash.

    Null and empty texts are one end each. Null and repeated ids are kept: rows
    are told apart by their place in the table. Without training texts all
    bytes are equally likely. Other columns are ignored.
    """
    counts = stored(gather(docs, train))
    words = counts.where("_kind = 0").select("_key", "_n")
    n, v = words.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    often = max(1, n * WORD_SHARE)
    known = words.where(F.col("_n") >= often).toArrow().sort_by("_key")
    logs = model(counts)
    usual = max(1, (logs.agg(F.sum("_all")).first()[0] or 0) * KEY_SHARE)
    likely = logs.where(F.col("_all") >= usual).select("_key", "_log").toArrow().sort_by("_key")
    held = docs.sparkSession.sparkContext.broadcast(
        tuple(table.column(c).to_numpy() for table, c in ((known, "_key"), (known, "_n"), (likely, "_key"), (likely, "_log"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, times, keys, log = held.value
        for batch in (part.slice(at, ROWS) for part in by_bytes(batches) for at in range(0, part.num_rows, ROWS)):
            texts = [words_of(text) for text in batch.column("text").to_pylist()]
            rows = batch.column("_row").to_numpy()
            flow, ends = stream(texts)
            place = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0) - DEPTH)
            scores, row, key, m = known_and_rare(turned(contexts(flow)), place, keys, log, len(texts))
            rare = [(np.ones(len(row), np.int8), rows[row], key, m)]
            n_words = np.array([len(words) for words in texts], np.int64)
            word, place = hashed_words(texts)
            # every text ends in one END_TOKEN
            word, place = np.append(word, END_TOKEN), np.append(place, np.full(len(texts), len(word)))
            both, m = np.unique(np.append(np.repeat(np.arange(len(texts)), n_words), np.arange(len(texts))) * len(word) + place, return_counts=True)
            row, key = both // len(word), word[both % len(word)]
            at = np.searchsorted(frequent, key).clip(0, max(0, len(frequent) - 1))
            found = frequent[at] == key if len(frequent) else np.zeros(len(key), bool)
            seen = np.bincount(row[found], m[found], len(texts)).astype(np.int64)
            sums = np.bincount(row[found], m[found] * np.log10(times[at[found]] + 1.0), len(texts)) if found.any() else np.zeros(len(texts))
            rare.append((np.zeros(np.count_nonzero(~found), np.int8), rows[row[~found]], key[~found], m[~found]))
            own = pa.StructArray.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n_words + 1), pa.array(seen), pa.array(sums), pa.array(scores)],
                fields=list(kind.field("_own").type))
            # a text's own row meets nothing; its key, the row, spreads it
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), 2, np.int8)), pa.array(rows), pa.array(rows), pa.nulls(len(rows), pa.int32()), own], schema=kind)
            which, row, key, m = (np.concatenate(part) for part in zip(*rare))
            yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(row), pa.array(key), pa.array(m.astype(np.int32)), pa.nulls(len(row), own.type)], schema=kind)

    whole, real = pa.int64(), pa.float64()
    kind = pa.schema([("_kind", pa.int8()), ("_row", whole), ("_key", whole), ("_m", pa.int32()), ("_own", pa.struct(
        [("doc_id", whole), ("n_tokens", whole), ("seen", whole), ("sum", real), ("score", real)]))])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_row"))
    found = texts.mapInArrow(run, "_kind byte, _row long, _key long, _m int, _own struct<doc_id: long, n_tokens: long, seen: long, sum: double, score: double>")
    rare = words.where(F.col("_n") < often).select(F.lit(0).cast("byte").alias("_kind"), "_key", F.log10(F.col("_n") + 1).alias("_log"))
    rare = rare.union(logs.where(F.col("_all") < usual).select(F.lit(1).cast("byte"), "_key", "_log"))
    met = found.join(rare, ["_kind", "_key"], "left")
    part = F.col("_m") * F.col("_log")
    is_word = (F.col("_kind") == 0) & F.col("_log").isNotNull()
    # one number per rare key and one row per text come together again
    out = met.select(
        "_row", "_own", F.when(is_word, F.col("_m")).alias("_seen"), F.when(is_word, part).alias("_base"), F.when(F.col("_kind") == 1, part).alias("_part")
    ).where("_own is not null or _seen is not null or _part is not null").groupBy("_row").agg(
        F.max("_own.doc_id").alias("doc_id"), F.max("_own.n_tokens").alias("n_tokens"),
        (F.max("_own.score") + F.coalesce(F.sum("_part"), F.lit(0.0))).alias("score"),
        (F.max("_own.seen") + F.coalesce(F.sum("_seen"), F.lit(0))).alias("n_known"),
        (F.max("_own.sum") + F.coalesce(F.sum("_base"), F.lit(0.0))).alias("_sum"),
    )
    base = F.col("_sum") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def held_out_scores(docs: DataFrame, by: int = 7, out: int = 2) -> DataFrame:
    """``score`` learned from the documents whose crc32(doc_id) mod ``by`` is not ``out``, with the column ``held_out``."""
    outside = remainder(F.col("doc_id"), by) == out
    scored = score(docs, ~outside)
    return scored.select("doc_id", outside.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
