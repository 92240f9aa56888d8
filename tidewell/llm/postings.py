"""Exact phrases and proximity through a positional inverted index of the training text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.llm.common import stored

# What stands between two words, before A-Z is lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Tables of at most so many rows are broadcast; larger ones are joined by a shuffle.
FEW = 1 << 18
# A posting with this term stands one place after a text's last word.
END = -1
# A document is known by its id, 0 for none, and a hash of the id and the text.
DOC = ["_id", "_hash"]


def _split(text: Column) -> Column:
    """Words with an empty one at the end, and one at the start if the text begins with a gap."""
    return F.split(F.concat(text, F.lit(" ")), GAP, -1)


def _lower(word: Column) -> Column:
    ascii_only = F.length(word) == F.octet_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def word_places(rows: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep, _pos, _word``: a row per word of each text and an empty word after the last; null counts as empty."""
    known = F.coalesce(F.col(text), F.lit(""))
    ahead = F.when((known == "") | F.substring(known, 1, 1).rlike(GAP), 1).otherwise(0)
    placed = rows.select(*keep, ahead.alias("_ahead"), F.posexplode(_split(known)).alias("_pos", "_word"))
    return placed.select(*[c for c in placed.columns if c not in ("_ahead", "_pos", "_word")],
                         (F.col("_pos") - F.col("_ahead")).alias("_pos"), _lower(F.col("_word")).alias("_word")).where("_pos >= 0")


def few(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it has at most FEW rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def document_key() -> list[Column]:
    known = F.col("doc_id").cast("long")
    return [F.coalesce(known, F.lit(0)).alias("_id"), F.xxhash64(known.isNull(), known, F.col("text").isNull(), F.col("text")).alias("_hash"),
            known.isNull().alias("_nameless")]


def doc_id() -> Column:
    return F.when(~F.col("_nameless"), F.col("_id")).alias("doc_id")


class Index:
    """Postings of those terms of ``docs`` that ``items`` hold, and the windows of ``items``; all stored.

    ``postings``: ``_id, _hash, _nameless, _pos, _term``, a row per occurrence,
    and one with the term END behind each text's last word. ``terms``: ``_word, _term, _n``
    with the number of postings. ``windows``: ``_window, _size, _terms``, the
    distinct runs of ``length`` consecutive item words (an item of fewer, but
    not none, is one), as structs of ``_n, _off, _term``, rarest first; windows
    with a term that no document holds are left out. ``owners``: ``_window,
    item_id``, the items of each window.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, length: int) -> None:
        # a row number for an item: ids may be null or repeat
        spoken = stored(word_places(items.select("item_id", "text").withColumn("_item", F.monotonically_increasing_id()), "text", F.col("_item"), F.col("item_id")).where("_word <> ''"))
        self.length = length
        numbered = stored(spoken.select("_word").distinct().select("_word", F.monotonically_increasing_id().alias("_term")))
        wanted = numbered.union(numbered.sparkSession.range(1).select(F.lit(""), F.lit(END).cast("long")))
        if numbered.count() <= FEW:
            wanted = F.broadcast(wanted)
        self.postings = stored(word_places(docs, "text", *document_key()).join(wanted, "_word").select(*DOC, "_nameless", "_pos", "_term"))
        held = self.postings.groupBy("_term").agg(F.count("*").alias("_n"))
        self.terms = stored(numbered.join(held, "_term").select("_word", "_term", "_n"))

        placed = spoken.join(numbered, "_word").join(self.terms.select("_term", "_n"), "_term", "left")
        start = F.explode(F.sequence(F.greatest(F.lit(0), F.col("_pos") - (length - 1)), F.col("_pos")))
        words_of = spoken.groupBy("_item").agg(F.count("*").alias("_words"))
        rows = placed.join(words_of, "_item").select("_item", "item_id", "_words", "_pos", "_term", "_n", start.alias("_start"))
        # a window begins where it ends inside the item, or at the start of a short item
        rows = rows.where((F.col("_start") + length <= F.col("_words")) | (F.col("_start") == 0) & (F.col("_words") < length))
        cut = rows.groupBy("_item", "item_id", "_start").agg(
            F.sort_array(F.collect_list(F.struct((F.col("_pos") - F.col("_start")).alias("_off"), "_term"))).alias("_in_order"),
            F.sort_array(F.collect_list(F.struct("_n", (F.col("_pos") - F.col("_start")).alias("_off"), "_term"))).alias("_terms"),
            F.bool_or(F.col("_n").isNull()).alias("_missing")).where("not _missing")
        cut = stored(cut.select("item_id", "_in_order._term", "_terms").withColumnRenamed("_term", "_in_order"))
        self.windows = stored(cut.groupBy("_in_order").agg(F.first("_terms").alias("_terms")).select(
            F.monotonically_increasing_id().alias("_window"), F.size("_terms").alias("_size"), "_terms", "_in_order"))
        self.owners = stored(cut.join(self.windows, "_in_order").select("_window", "item_id").distinct())

    def lengths(self) -> DataFrame:
        """``_id, _hash, doc_id, _words``, a row per row of the documents."""
        return self.postings.where(F.col("_term") == END).select(*DOC, doc_id(), F.col("_pos").cast("long").alias("_words"))

    def lists(self, rank: int) -> DataFrame:
        """Postings of the terms that stand at ``rank`` from the rarest in a window; ``_pos`` and ``_term``."""
        wanted = stored(self.windows.where(F.col("_size") > rank).select(F.element_at("_terms", rank + 1)["_term"].alias("_term")).distinct())
        return self.postings.join(few(wanted), "_term", "left_semi")


def exact(index: Index) -> DataFrame:
    """Every place where a window's words follow each other in a document: ``_id, _hash, _start, _window, _size``; stored.

    The postings of a window's rarest term, moved back by its place in the
    window, are the first candidates. The list of the second rarest, moved
    alike, is intersected with them; what is left meets the lists of all other
    terms, in the documents that are left.
    """
    windows = index.windows.select("_window", "_size", "_terms")
    first = F.element_at("_terms", 1)
    anchored = index.postings.join(few(windows.withColumn("_term", first["_term"])), "_term")
    start = (F.col("_pos") - first["_off"]).alias("_start")
    found = anchored.select(*DOC, start, "_window", "_size", F.expr("slice(_terms, 2, greatest(size(_terms) - 1, 1))").alias("_rest")).where("_start >= 0")
    single, found = found.where("_size = 1"), found.where("_size > 1")

    second = F.element_at("_rest", 1)
    met = found.withColumns({"_pos": F.col("_start") + second["_off"], "_term": second["_term"]})
    met = met.join(index.lists(1), [*DOC, "_pos", "_term"], "left_semi")
    met = stored(met.select(*DOC, "_start", "_window", "_size", F.expr("slice(_rest, 2, greatest(size(_rest) - 1, 1))").alias("_rest")).distinct())

    pairs, more = met.where("_size = 2"), met.where("_size > 2")
    inside = stored(more.select(*DOC).distinct())
    lists = index.postings.where(F.col("_term") != END).join(few(inside), DOC, "left_semi").select(*DOC, "_pos", "_term").distinct()
    asked = more.select(*DOC, "_start", "_window", "_size", F.explode("_rest").alias("_t")).select(
        *DOC, (F.col("_start") + F.col("_t._off")).alias("_pos"), F.col("_t._term").alias("_term"), "_start", "_window", "_size")
    agreed = asked.join(lists, [*DOC, "_pos", "_term"]).groupBy(*DOC, "_start", "_window", "_size").agg(F.count("*").alias("_agreed"))
    whole = agreed.where("_agreed = _size - 2")
    names = [*DOC, "_start", "_window", "_size"]
    return stored(reduce(DataFrame.union, [part.select(*names) for part in (single.distinct(), pairs, whole)]))


def proximity(docs: DataFrame, items: DataFrame, length: int = 10, within: int = 20) -> DataFrame:
    """Windows whose words all stand within ``within`` consecutive words of a document, in any order.

    Returns ``doc_id, item_id, n_places``: at how many places of the window's
    rarest word such a stretch lies around it. Windows as in ``contamination``;
    a word that a window repeats needs one occurrence. Null texts have no words,
    rows with equal id and text are one document, items without an id share the
    null one. Empty tables give an empty result, other columns are ignored.
    """
    index = Index(docs, items, length)
    windows = index.windows.select("_window", "_terms", F.array_distinct("_terms._term").alias("_distinct"))
    anchors = index.postings.join(few(windows.withColumn("_term", F.element_at("_terms", 1)["_term"])), "_term")
    anchors = anchors.select(*DOC, F.col("_pos").alias("_at"), "_window", F.size("_distinct").alias("_need"), "_distinct").distinct()

    # lists meet in blocks of ``within`` places, next to the anchor's own block
    block = F.explode(F.sequence(F.floor(F.col("_at") / within) - 1, F.floor(F.col("_at") / within) + 1))
    asked = anchors.withColumn("_block", block).select(*DOC, "_block", "_at", "_window", "_need", F.explode("_distinct").alias("_term"))
    lists = index.postings.where(F.col("_term") != END).select(*DOC, "_pos", "_term").distinct().withColumn("_block", F.floor(F.col("_pos") / within))
    met = asked.join(lists, [*DOC, "_block", "_term"]).where(F.abs(F.col("_pos") - F.col("_at")) < within)
    # at most 2 * within - 1 places for each anchor and window
    around = met.groupBy(*DOC, "_window", "_at", "_need").agg(F.collect_list(F.struct("_pos", "_term")).alias("_near"), F.count_distinct("_term").alias("_terms"))

    def covers(from_: Column) -> Column:
        span = F.filter("_near", lambda x: (x["_pos"] >= from_) & (x["_pos"] < from_ + within))
        return (from_ <= F.col("_at")) & (F.col("_at") < from_ + within) & (F.size(F.array_distinct(F.transform(span, lambda x: x["_term"]))) == F.col("_need"))

    close = around.where("_terms = _need").where(F.exists("_near", lambda x: covers(x["_pos"])))
    named = close.join(few(index.owners), "_window").groupBy(*DOC, "item_id").agg(F.count_distinct("_at").alias("n_places"))
    return index.lengths().distinct().join(named, DOC).select("doc_id", "item_id", "n_places")


def contamination(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Which words of each document lie in a window of an item, and of which items.

    ``docs``: ``doc_id, text``; ``items``: ``item_id, text``. A window is
    ``length`` consecutive words of an item; an item of fewer, but not none, is
    one window. Returns ``doc_id, n_words, n_hit, items``, a row per row of
    ``docs``: its words, those inside any occurrence of a window, and the ids,
    as sorted strings, of the items with a window that occurs.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z
    lower-cased. Null and empty texts have no words and hit nothing. Rows with
    equal id and text get equal results; windows of an item without id hit
    words but are not listed. Other columns are ignored; no documents give an
    empty result, no items hit nothing.
    """
    index = Index(docs, items, length)
    places = exact(index)
    # what an occurrence covers beyond all that begin before it, in one document
    longest = places.groupBy(*DOC, "_start").agg(F.max("_size").alias("_size"))
    before = Window.partitionBy(*DOC).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("_start") + F.col("_size")
    upto = F.greatest(F.col("_start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = longest.withColumn("_new", F.greatest(F.lit(0), end - upto)).groupBy(*DOC).agg(F.sum("_new").alias("_hit"))
    seen = places.select(*DOC, "_window").distinct().join(few(index.owners), "_window")
    listed = seen.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    found = hit.join(listed, DOC)

    counted = index.lengths().join(found, DOC, "left")
    return counted.select("doc_id", F.col("_words").alias("n_words"), F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
                          F.coalesce("items", F.array().cast("array<string>")).alias("items"))
