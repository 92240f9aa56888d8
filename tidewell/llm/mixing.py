"""Mix sources to target weights by thresholds on a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import in_order, running, word_count

# The hash has 60 bits, read in five digits of 12.
DIGIT_BITS, DIGITS = 12, 5
# More sources than this are not broadcast to the rows.
FEW_SOURCES = 10_000


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits that depend on the id and the text alone, so reruns choose the same rows."""
    said = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Add ``_rank``, ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources take the weights in turn, by code point, null last. The budget of
    ``share`` times all sizes is dealt by weight; a target stops at ``most``
    times its source and the excess is dealt again until none is above.
    """
    ranked = running(in_order(sources.withColumn("_one", F.lit(1).cast("long")), F.col("source").asc_nulls_last()), _rank="_one")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = settle(ranked.select("source", "source_size", "_rank", turn.alias("weight")))
    cap = most * F.col("source_size")

    def level(above: Column) -> tuple[float, int]:
        """Budget per unit of weight when the sources in ``above`` are at their cap, and how many these are."""
        got = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, F.col("source_size"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"), F.count(F.when(above, 1)).alias("n"),
        ).first()
        budget = share * (got["all"] or 0) - most * (got["held"] or 0)
        return (budget / got["free"] if got["free"] else float("inf")), got["n"]

    per_weight, full = level(F.lit(False))
    while True:
        per_weight, n = level(F.lit(per_weight) * F.col("weight") > cap)
        if n == full:
            break
        full = n
    return ranked.withColumn("target", F.least(cap, F.lit(per_weight) * F.col("weight")))


def plan(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """What each source's rows are taken by: ``source, source_size, target, _whole, _threshold``, a row per source; settled.

    A source's whole epochs go to all its rows; the rest of its target goes to
    the rows whose hash lies below a threshold. A histogram over source and
    first digit of the hash finds the digit in which the threshold falls; only
    that bucket's rows are counted again, by the next digit, down to one hash
    value, which is taken if that brings the sum nearer to the target. Larger
    targets give supersets.
    """
    rows = settle(docs.select("source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("_hash")))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), list(weights), share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = settle(sources.select("source", "_rank", "source_size", "target", whole.alias("_whole")))
    ranked = with_source(rows, sources.select("source", "_rank")).where("size > 0").select("size", "_hash", "_rank")

    # Per source: the hash digits settled so far and the budget left below them.
    state = sources.select("_rank", F.lit(0).cast("long").alias("_prefix"), (F.col("target") - F.col("_whole") * F.col("source_size")).alias("_left"))
    few = sources.count() <= FEW_SOURCES
    for digit in range(DIGITS):
        below = DIGIT_BITS * (DIGITS - 1 - digit)
        # one row per source, so that the rows of a large source stay where they are
        inside = ranked.join(F.broadcast(state) if few else state, "_rank").where(F.shiftright("_hash", below + DIGIT_BITS) == F.col("_prefix"))
        buckets = inside.groupBy("_rank", "_left", F.shiftright("_hash", below).alias("_prefix")).agg(F.sum("size").alias("_size"))
        earlier = Window.partitionBy("_rank").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        buckets = buckets.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        edge = buckets.where((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_size")))
        state = settle(edge.select("_rank", "_prefix", (F.col("_left") - F.col("_before")).alias("_left"), "_size"))

    threshold = state.select("_rank", (F.col("_prefix") + F.when(2 * F.col("_left") >= F.col("_size"), 1).otherwise(0)).alias("_threshold"))
    return settle(sources.join(threshold, "_rank", "left").drop("_rank"))


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join rows to one row per source, null to null; broadcast if there are at most FEW_SOURCES."""
    named = sources.withColumnRenamed("source", "_source")
    if named.count() <= FEW_SOURCES:
        named = F.broadcast(named)
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")


def copies(doc_id: str = "doc_id", text: str = "text") -> Column:
    """How often the mix takes a row that ``plan`` was joined to; one without words only in whole epochs."""
    spoken = F.coalesce(F.length(F.trim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))) > 0, F.lit(False))
    again = F.when(spoken & (row_hash(F.col(doc_id), F.col(text)) < F.col("_threshold")), 1).otherwise(0)
    return F.col("_whole") + again


def mix(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """How many words of each document the mix takes, by the thresholds of ``plan``.

    Returns ``doc_id, size, source_size, target, taken``, a row per row of
    ``docs`` (``doc_id, text, source``). Null text: size 0. Null source: a
    source of its own, last in turn. Null ids: hashed by the text. Equal rows
    share a hash and are taken together. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = docs.select("doc_id", "source", "text", word_count(F.col("text")).alias("size"))
    return with_source(rows, plan(docs, weights, share, most)).select("doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def mixed(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, with the columns it had.

    Texts without words take nothing from any budget and follow the whole
    epochs of their source.
    """
    chosen = plan(docs, weights, share, most).select("source", "_whole", "_threshold")
    # the row travels as one value, so no column of it can clash
    taken = with_source(docs.select(F.struct("*").alias("_doc"), "source"), chosen)
    times = copies("_doc.doc_id", "_doc.text")
    return taken.where(times > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).select("_doc.*")
