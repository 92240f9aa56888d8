"""Phrases whose words stand together, counted in tiles of ranked pairs."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.llm.common import by_bytes, in_order, running, stored

# The most frequent words, and phrases of each length, have their rank as id;
# tasks hold so many of them. Phrases with rarer parts are counted by their text.
RANKED_WORDS, RANKED_PHRASES = 1 << 19, 1 << 21
# Ids of a tile on either side; a tile is counted by direct address when a
# buffer holds so many of its pairs, else sorted; so many tiles at a time.
TILE, DENSE, TOGETHER = 1 << 10, 1 << 16, 8
# Pairs counted at a time, distinct words or phrases counted before they are
# passed on, bytes of a text split at a time.
BUFFER, HELD, SLICE = 1 << 22, 1 << 18, 1 << 20
# Bits of the sieve for frequent phrases that have no rank.
SIEVE_BITS = 1 << 26
# The first phrases of a language are picked in so many groups, then once more.
GROUPS = 64

# A-Z is lower-cased, a tab is a blank, and a byte that no text holds stands for the end of a piece.
BREAK = b"\xff"
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")
_TABLE = bytes(_ENDS[b] for b in bytes(range(256)).lower())


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """A text's words, and BREAK between pieces, in lists of those that begin in about SLICE bytes."""
    said = (text or "").encode().translate(_TABLE)
    start = 0
    while start < len(said):
        cut = said.find(b" ", start + SLICE)
        end = len(said) if cut < 0 else cut
        yield said[start:end].replace(BREAK, b" \xff ").split()
        start = end


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, _phrase, _n`` of every word; stored."""

    def out(held: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, own in held.items() for word, n in own.items()]
        lang, word, n = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.binary()), pa.array(n, pa.int64())], names=["lang", "_phrase", "_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        for batch in by_bytes(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for words in word_slices(text):
                    held[lang].update(words)
                held[lang].pop(BREAK, None)
            if sum(map(len, held.values())) > HELD:
                yield out(held)
                held.clear()
        yield out(held)

    parts = docs.mapInArrow(run, "lang string, _phrase binary, _n long")
    return stored(parts.groupBy("lang", "_phrase").agg(F.sum("_n").alias("_n")).withColumn("_phrase", F.col("_phrase").cast("string")))


def tile_counts(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pair codes and their numbers; a code holds a row id above a column id of 32 bits.

    Tiles with many of the pairs are arrays with a cell per pair; the pairs of
    all other tiles are sorted and their runs measured.
    """
    row, column = codes >> 32, codes & 0xFFFFFFFF
    wide = int(column.max()) // TILE + 1
    tile = row // TILE * wide + column // TILE
    full = np.flatnonzero(np.bincount(tile) >= DENSE)
    place = np.full(int(tile.max()) + 1, -1, np.int64)
    place[full] = np.arange(len(full))
    at = place[tile]
    cell = row % TILE * TILE + column % TILE
    for first in range(0, len(full), TOGETHER):
        own = (at >= first) & (at < first + TOGETHER)
        counts = np.bincount((at[own] - first) * TILE * TILE + cell[own])
        seen = np.flatnonzero(counts)
        tiles, cells = full[first + seen // (TILE * TILE)], seen % (TILE * TILE)
        yield (tiles // wide * TILE + cells // TILE) << 32 | (tiles % wide * TILE + cells % TILE), counts[seen]
    rest = np.sort(codes[at < 0])
    if len(rest):
        starts = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        yield rest[starts], np.diff(np.concatenate([starts, [len(rest)]]))


def sieve_place(lang: Column, phrase: Column) -> Column:
    """From 1 on, as Spark numbers the places of a bitmap."""
    return F.pmod(F.crc32(F.concat(lang, F.lit("\n"), phrase).cast("binary")), F.lit(SIEVE_BITS)) + 1


def in_sieve(sieve: np.ndarray, lang: str, phrase: bytes) -> bool:
    place = zlib.crc32(lang.encode() + b"\n" + phrase) % SIEVE_BITS
    return bool(sieve[place // 8] >> (place % 8) & 1)


class Units:
    """The frequent words, or phrases of one length: ``table`` of ``_id, _code, lang, _phrase, _n``, stored.

    Those of the ``most`` that are most frequent have their rank as ``_id``;
    all others have none and stand in the sieve, a bitmap of SIEVE_BITS bits
    that may let others through but never loses one.
    """

    def __init__(self, coded: DataFrame, rest: DataFrame | None, most: int) -> None:
        order = [F.desc("_n"), F.col("lang"), F.col("_phrase")]
        ranked = running(in_order(coded.withColumn("_one", F.lit(1).cast("long")), *order), _id="_one")
        rows = ranked.select(F.when(F.col("_id") < most, F.col("_id")).alias("_id"), "_code", "lang", "_phrase", "_n")
        if rest is not None:
            rows = rows.union(rest.select(F.lit(None).cast("long"), F.lit(None).cast("long"), "lang", "_phrase", "_n"))
        self.table = stored(rows)
        self.ranked = self.table.where("_id is not null")
        place = sieve_place(F.col("lang"), F.col("_phrase")).cast("long")
        unranked = self.table.where("_id is null").select(place.alias("_p"))
        # a row for each 32768 bits at most
        bits = unranked.groupBy(F.bitmap_bucket_number("_p").alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits")).collect()
        self.sieve = None
        if bits:
            self.sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
            for r in bits:
                self.sieve[(r["_b"] - 1) * 4096:r["_b"] * 4096] = np.frombuffer(bytes(r["_bits"]), np.uint8)

    def words(self) -> dict[str, dict[bytes, int]]:
        """Per language, each ranked word's id."""
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        rows = self.ranked.select("lang", "_phrase", "_id").toArrow()
        for lang, word, id_ in zip(rows["lang"].to_pylist(), rows["_phrase"].to_pylist(), rows["_id"].to_pylist()):
            known[lang][word.encode()] = id_
        return dict(known)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """The ranked codes in ascending order, and their ids."""
        rows = self.ranked.select("_code", "_id").toArrow()
        codes, ids = rows["_code"].to_numpy(), rows["_id"].to_numpy()
        order = np.argsort(codes)
        return codes[order], ids[order]


def longer_phrases(docs: DataFrame, lookup, length: int, coded: bool) -> DataFrame:
    """Occurrences of phrases of ``length`` words both of whose parts of ``length - 1`` words may be frequent.

    ``coded``: those whose first part and last word have ids, as ``_code, _n``;
    else all others as ``lang, _phrase, _n``. A row per task and buffer; the
    rows of a phrase are to be summed.
    """

    def places(lang: str, words: list[bytes], known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words, of the parts that begin at each place, and where such a part may be frequent."""
        ids = np.fromiter(map(known["words"].get(lang, {}).get, words, repeat(-1)), np.int64, len(words))
        rank, may = ids, ids >= 0
        for k in range(1, length):
            if k > 1:
                could, first, last = may[:-1] & may[1:], rank[:-1], ids[k - 1:]
                rank = np.full(len(could), -1, np.int64)
                asked = np.flatnonzero(could & (first >= 0) & (last >= 0))
                codes, of = known["codes"][k]
                if len(codes) and len(asked):
                    wanted = first[asked] << 32 | last[asked]
                    near = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                    rank[asked] = np.where(codes[near] == wanted, of[near], -1)
                may = rank >= 0
            else:
                could = np.ones(len(ids), bool)
            sieve = known["sieves"][k]
            if sieve is not None:
                for p in np.flatnonzero(could & ~may):
                    part = words[p:p + k]
                    may[p] = BREAK not in part and in_sieve(sieve, lang, b" ".join(part))
        return ids, rank, may

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
        """Words by language; a list continues the one before it by ``length - 1`` words of the same text."""
        for batch in by_bytes(batches):
            together: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = together[lang]
                own.append(BREAK)
                for words in word_slices(text):
                    own += words
                    if len(own) > SLICE:
                        yield lang, own
                        own = together[lang] = own[len(own) - (length - 1):]
            yield from together.items()

    def run_coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = lookup.value, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if size:
                for codes, n in tile_counts(np.concatenate(held)):
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], names=["_code", "_n"])

        for lang, words in texts(batches):
            ids, rank, may = places(lang, words, known)
            could = may[:-1] & may[1:] & (rank[:-1] >= 0) & (ids[length - 1:] >= 0)
            held.append(rank[:-1][could] << 32 | ids[length - 1:][could])
            size += len(held[-1])
            if size > BUFFER:
                yield from out()
                held, size = [], 0
        yield from out()

    def run_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = lookup.value, Counter()

        def out() -> pa.RecordBatch:
            lang, phrase = zip(*held) if held else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.binary()), pa.array(list(held.values()), pa.int64())], names=["lang", "_phrase", "_n"])

        for lang, words in texts(batches):
            ids, rank, may = places(lang, words, known)
            could = may[:-1] & may[1:] & ~((rank[:-1] >= 0) & (ids[length - 1:] >= 0))
            held.update((lang, b" ".join(words[p:p + length])) for p in np.flatnonzero(could))
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    if coded:
        return docs.mapInArrow(run_coded, "_code long, _n long").groupBy("_code").agg(F.sum("_n").alias("_n"))
    rest = docs.mapInArrow(run_rest, "lang string, _phrase binary, _n long").groupBy("lang", "_phrase").agg(F.sum("_n").alias("_n"))
    return rest.withColumn("_phrase", F.col("_phrase").cast("string"))


def frequent_phrases(docs: DataFrame, most_words: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``most_words`` words with at least ``least`` occurrences, and all words' number per language.

    ``lang, _phrase, _n, _words`` and ``lang, n``. Words have ids by frequency;
    pairs of ids are counted in tiles. The frequent pairs get ids by frequency
    in turn, and a longer phrase is the pair of its first part and its last word.
    """
    spark = docs.sparkSession
    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = word_counts(read)
    totals = words.groupBy("lang").agg(F.sum("_n").alias("n"))
    often = F.col("_n") >= least
    units = {1: Units(words.where(often).select(F.lit(None).cast("long").alias("_code"), "lang", "_phrase", "_n"), None, RANKED_WORDS)}
    known = {"words": units[1].words(), "codes": {}, "sieves": {1: units[1].sieve}}
    last = units[1].ranked.select(F.col("_id").alias("_column"), F.col("_phrase").alias("_last"))
    for length in range(2, most_words + 1):
        lookup = spark.sparkContext.broadcast(known)
        pairs = stored(longer_phrases(read, lookup, length, coded=True).where(often))
        first = units[length - 1].ranked.select(F.col("_id").alias("_row"), "lang", F.col("_phrase").alias("_first"))
        parts = pairs.select("_code", "_n", F.shiftright("_code", 32).alias("_row"), F.col("_code").bitwiseAND(0xFFFFFFFF).alias("_column"))
        named = parts.join(first, "_row").join(last, "_column").select("_code", "lang", F.concat_ws(" ", "_first", "_last").alias("_phrase"), "_n")
        rest = None
        if any(sieve is not None for sieve in known["sieves"].values()):
            rest = stored(longer_phrases(read, lookup, length, coded=False).where(often))
        units[length] = Units(named, rest, RANKED_PHRASES)
        if length < most_words:
            known = known | {"codes": known["codes"] | {length: units[length].codes()}, "sieves": known["sieves"] | {length: units[length].sieve}}
    phrases = [unit.table.select("lang", "_phrase", "_n", F.lit(k).alias("_words")) for k, unit in units.items()]
    return reduce(DataFrame.union, phrases), totals


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 30, first: int = 2000, most_words: int = 4, within: int = 80) -> DataFrame:
    """Each language's ``first`` phrases whose words stand together most: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs``: ``text, lang``. A-Z is lower-cased; texts are cut into pieces at
    ``.,;:!?`` and line ends and into words at blanks and tabs. A candidate is a
    phrase of 2 to ``most_words`` words with ``least`` occurrences (``a``) within
    pieces, overlaps included. A cut into two parts with ``l`` and ``r``
    occurrences scores 2,000,000 a div (l + r), in exact arithmetic; the lowest
    cut counts, of equal ones the first. Candidates inside a longer one with
    ``within`` percent of their occurrences are dropped. ``n`` counts the
    language's words. Order: score, then a, both descending, then the phrase's bytes.

    Null and empty texts have no words; a null ``lang`` is ``und``. Repeated
    rows count each time; other columns are ignored, an empty table gives an
    empty result.
    """
    phrases, totals = frequent_phrases(docs, most_words, least)
    shorter = phrases.where(F.col("_words") < most_words)
    found = phrases.where("_words > 1").withColumn("_parts", F.split("_phrase", " "))
    cuts = found.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_words") - 1)))
    cuts = cuts.select("lang", "_phrase", "_n", "_words", "_k", _part("_parts", F.lit(1), F.col("_k")).alias("_left"), _part("_parts", F.col("_k") + 1, F.col("_words") - F.col("_k")).alias("_right"))
    cuts = cuts.join(shorter.select("lang", F.col("_phrase").alias("_left"), F.col("_n").alias("l")), ["lang", "_left"])
    cuts = cuts.join(shorter.select("lang", F.col("_phrase").alias("_right"), F.col("_n").alias("r")), ["lang", "_right"])
    score = F.expr("(cast(2000000 as decimal(10,0)) * cast(_n as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long")
    scored = cuts.groupBy("lang", "_phrase", F.col("_n").alias("a")).agg(F.min(F.struct(score.alias("score"), "_k", "l", "r")).alias("_cut"))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("_words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("_words") - size + 1), lambda at: _part("_parts", at, size)))))
    longer = found.where("_words > 2").select("lang", "_n", inner.alias("_phrase")).groupBy("lang", "_phrase").agg(F.max("_n").alias("_longer"))
    kept = scored.join(longer, ["lang", "_phrase"], "left").where(
        F.col("_longer").isNull() | (F.col("_longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * within))
    rows = kept.select("lang", F.col("_phrase").alias("phrase"), "a", "_cut.l", "_cut.r", "_cut.score")

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    group = Window.partitionBy("lang", F.pmod(F.crc32(F.col("phrase").cast("binary")), F.lit(GROUPS))).orderBy(*order)
    rows = rows.withColumn("_r", F.row_number().over(group)).where(F.col("_r") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
