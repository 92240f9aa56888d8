"""Quality flags FLG-001..FLG-008.

Each rule yields (rule_id, table_name, record_id, flag_type, description) and
an ``ordinal`` that tells apart several flags of one rule on one record.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.moments import threshold
from tidewell.functions.numbers import cents
from tidewell.functions.ranking import numbered
from tidewell.operators.exclude import mark_known
from tidewell.sources.warehouse import Warehouse

Tables = Mapping[str, DataFrame]

# Character pairs that mark UTF-8 text decoded as Latin-1.
MOJIBAKE = {
    "ü": "Ã¼", "ö": "Ã¶", "ä": "Ã¤", "é": "Ã©", "è": "Ã¨", "ñ": "Ã±", "ß": "ÃŸ", "ø": "Ã¸", "å": "Ã¥", "ç": "Ã§",
}
# Letters that end a whole word often enough not to be suspicious.
USUAL_LAST_LETTERS = ("c", "g", "d", "s", "t", "n", "e", "y")
SENTENCE_ENDS = (".", "!", "?")
# Every character Unicode counts as white space.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0            "
    "    　"
)
DATED_COLUMNS = (("orders", "order_date", "order_id"), ("activities", "activity_date", "activity_id"))
# Descriptions of flags that say the same for every record.
TRACKED_TEXT = "Near-duplicate record (tracked in duplicate_tracking)"
TRUNCATED_TEXT = "Notes may be truncated (ends mid-word)"
UNTIDY_TEXT = "Company name has leading/trailing/double whitespace"
FLAG_COLUMNS = ("rule_id", "table_name", "record_id", "flag_type", "description")


def _flags(
    df: DataFrame, rule: str, table: str, record: str, kind: str, text: Column | str, ordinal: Column | None = None
) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule_id"),
        F.lit(table).alias("table_name"),
        F.col(record).alias("record_id"),
        F.lit(kind).alias("flag_type"),
        (F.lit(text) if isinstance(text, str) else text).alias("description"),
        (F.lit(0) if ordinal is None else ordinal).cast("bigint").alias("ordinal"),
    )


def outlier(t: Tables, sigmas: float = 3.0) -> DataFrame:
    """Prices above the mean by ``sigmas`` deviations; both come from exact sums of cents, in any order the same."""
    items = t["order_items"].filter(F.col("unit_price") > 0)
    upper = threshold(items, cents("unit_price"), sigmas) / 100
    high = items.filter(F.col("unit_price") > upper)
    text = F.format_string("unit_price exceeds 3 std devs (threshold: %.2f)", upper)
    return _flags(high, "FLG-001", "order_items", "line_id", "outlier", text)


def duplicate_tracked(t: Tables) -> DataFrame:
    hit = t["duplicate_tracking"].join(
        t["customers"].select("customer_id"), F.col("duplicate_customer_id") == F.col("customer_id")
    )
    return _flags(hit, "FLG-002", "customers", "customer_id", "duplicate_suspect", TRACKED_TEXT)


def duplicate_original(t: Tables) -> DataFrame:
    """One flag per tracking row, so an original may carry several."""
    hit = t["duplicate_tracking"].join(
        t["customers"].select("customer_id"), F.col("original_customer_id") == F.col("customer_id")
    )
    text = "Original record has one or more near-duplicates"
    return _flags(
        hit, "FLG-002", "customers", "customer_id", "duplicate_suspect", text, F.col("duplicate_customer_id") + 1
    )


def _with_cluster_size(df: DataFrame, *keys: str) -> DataFrame:
    """All rows, with the number of rows that share their keys as ``_size``; NULL where a key is.

    Counts are taken before rows move; the rows then meet one count row per
    cluster, so even a cluster holding a third of the table is never gathered.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_count"))
    # NULL-safe, so that no filter on the keys is inferred; see ``_emit``
    met = df.join(counts, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return met.withColumn("_size", F.when(known, F.col("_count"))).drop("_count", *[f"_of_{k}" for k in keys])


def clusters(df: DataFrame, name: str, place: str) -> DataFrame:
    """Rows that share upper-cased trimmed name and raw place with another row."""
    named = df.withColumn("_norm", F.upper(F.trim(F.col(name))))
    return _with_cluster_size(named, "_norm", place).filter(F.col("_size") > 1)


def duplicate_cluster(t: Tables) -> DataFrame:
    tracked = t["duplicate_tracking"]
    known = tracked.select(F.col("duplicate_customer_id").alias("customer_id")).union(
        tracked.select("original_customer_id")
    ).distinct()
    rows = clusters(t["customers"], "company_name", "region").join(known, "customer_id", "left_anti")
    text = F.concat(F.lit("Matches duplicate cluster: "), "_norm", F.lit(" / "), "region")
    return _flags(rows, "FLG-002", "customers", "customer_id", "duplicate_suspect", text)


def truncated_text(notes: Column, mode: str = "letter") -> Column:
    """Longer than 10 and ending mid-word.

    ``letter``: the last character is a letter unusual at a word's end;
    ``punctuation``: the text does not end a sentence.
    """
    last = F.substring(F.rtrim(notes, F.lit(WHITESPACE)), -1, 1)
    if mode == "punctuation":
        cut = (last != "") & ~last.isin(*SENTENCE_ENDS)
    else:
        cut = last.rlike(r"^\p{L}$") & ~last.isin(*USUAL_LAST_LETTERS)
    return (F.length(notes) > 10) & cut


def truncated(t: Tables, mode: str = "letter") -> DataFrame:
    rows = t["activities"].filter(truncated_text(F.col("notes"), mode))
    return _flags(rows, "FLG-003", "activities", "activity_id", "possibly_truncated", TRUNCATED_TEXT)


def mojibake_found(text: Column) -> Column:
    """Array of 1-based numbers of the patterns the text contains."""
    tests = [F.when(F.contains(text, F.lit(p)), F.lit(i)) for i, p in enumerate(MOJIBAKE.values(), 1)]
    return F.array_compact(F.array(*tests))


def mojibake(t: Tables, table: str = "customers", key: str = "customer_id", column: str = "company_name") -> DataFrame:
    """One flag per row and matching pattern, in one pass over the table."""
    suspect = t[table].filter(F.contains(F.col(column), F.lit("Ã")))
    rows = suspect.select(key, F.explode(mojibake_found(F.col(column))).alias("_nr"))
    pattern = F.element_at(F.array(*[F.lit(p) for p in MOJIBAKE.values()]), F.col("_nr"))
    text = F.concat(F.lit("Company name contains mojibake pattern: "), pattern)
    return _flags(rows, "FLG-004", table, key, "encoding_issue", text, F.col("_nr"))


def _orphan_text(key: str, parent: str) -> Column:
    return F.concat(F.lit(f"{key}="), F.col(key).cast("string"), F.lit(f" does not match any {parent}"))


def _future_text(column: str) -> Column:
    return F.concat(F.lit(f"{column}="), F.col(column).cast("string"), F.lit(" is beyond data range"))


def _orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return df.join(parent.select(key), key, "left_anti")


def orphan_orders(t: Tables) -> DataFrame:
    rows = _orphans(t["orders"], t["customers"], "customer_id")
    return _flags(rows, "FLG-005", "orders", "order_id", "orphaned_fk", _orphan_text("customer_id", "customer"))


def orphan_payments(t: Tables) -> DataFrame:
    rows = _orphans(t["payments"], t["invoices"], "invoice_id")
    return _flags(rows, "FLG-006", "payments", "payment_id", "orphaned_fk", _orphan_text("invoice_id", "invoice"))


def untidy(text: Column) -> Column:
    return text.startswith(" ") | text.endswith(" ") | F.contains(text, F.lit("  "))


def whitespace(t: Tables) -> DataFrame:
    rows = t["customers"].select("customer_id", "company_name")
    return _emit(rows, "customers", "customer_id", ("FLG-007", "whitespace_issue", untidy(F.col("company_name")), UNTIDY_TEXT, 0))


def future_date(t: Warehouse, columns: tuple[tuple[str, str, str], ...] = DATED_COLUMNS) -> DataFrame:
    found = None
    for nr, (table, column, key) in enumerate(columns):
        rows = t[table].filter(F.col(column) > F.lit(t.rules.cutoff))
        part = _flags(rows, "FLG-008", table, key, "future_date", _future_text(column), F.lit(nr))
        found = part if found is None else found.unionByName(part)
    return found


RULES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "outlier": outlier,
    "duplicate_tracked": duplicate_tracked,
    "duplicate_original": duplicate_original,
    "duplicate_cluster": duplicate_cluster,
    "truncated": truncated,
    "mojibake": mojibake,
    "orphan_orders": orphan_orders,
    "orphan_payments": orphan_payments,
    "whitespace": whitespace,
    "future_date": future_date,
}


def flags(t: Warehouse, rule: str) -> DataFrame:
    return RULES[rule](t).select(*FLAG_COLUMNS)


def _emit(df: DataFrame, table: str, record: str, *found: tuple[str, str, Column, Column | str, int]) -> DataFrame:
    """All flags of a table in one pass: a row per rule whose condition holds.

    The conditions give the numbers of the rules that hold, which are unrolled;
    the flag is looked up by number. Rows without a flag have no array and end
    there. A filter instead would be pushed below the columns it reads and copy
    what they are made of once per mention.
    """
    rules, kinds, hits, texts, ordinals = zip(*found)
    numbers = F.array(*[F.when(hit, nr) for nr, hit in enumerate(hits, 1)])
    nr = F.col("_nr")
    some = df.withColumn("_nr", F.explode(F.when(reduce(Column.__or__, hits), numbers))).filter(nr.isNotNull())

    def looked_up(values: tuple[str | int, ...]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), nr)

    text = looked_up(tuple(t if isinstance(t, str) else "" for t in texts))
    for at, own in enumerate(texts, 1):
        if not isinstance(own, str):
            text = F.when(nr == at, own).otherwise(text)
    return some.select(
        looked_up(rules).alias("rule_id"), F.lit(table).alias("table_name"), F.col(record).alias("record_id"),
        looked_up(kinds).alias("flag_type"), text.alias("description"), looked_up(ordinals).cast("bigint").alias("ordinal"))


def _customer_flags(t: Warehouse) -> DataFrame:
    tracked, name = t["duplicate_tracking"], F.col("company_name")
    listed = tracked.select(F.col("duplicate_customer_id").alias("_listed"), F.lit(1).alias("_copy")).union(
        tracked.select("original_customer_id", F.lit(0)))
    listed = listed.groupBy("_listed").agg(F.max("_copy").alias("_copy"))
    named = t["customers"].select("customer_id", "company_name", "region").withColumn("_norm", F.upper(F.trim(name)))
    rows = _with_cluster_size(named, "_norm", "region").join(listed, F.col("customer_id") == F.col("_listed"), "left")
    cluster = F.concat(F.lit("Matches duplicate cluster: "), "_norm", F.lit(" / "), "region")
    patterns = [
        ("FLG-004", "encoding_issue", F.contains(name, F.lit(bad)), f"Company name contains mojibake pattern: {bad}", nr)
        for nr, bad in enumerate(MOJIBAKE.values(), 1)
    ]
    return _emit(
        rows, "customers", "customer_id",
        ("FLG-002", "duplicate_suspect", F.col("_copy") == 1, TRACKED_TEXT, 0),
        ("FLG-002", "duplicate_suspect", F.col("_listed").isNull() & (F.col("_size") > 1), cluster, 0),
        *patterns,
        ("FLG-007", "whitespace_issue", untidy(name), UNTIDY_TEXT, 0),
    )


def _order_flags(t: Warehouse) -> DataFrame:
    rows = mark_known(t["orders"].select("order_id", "customer_id", "order_date"), t["customers"], "customer_id", "_known")
    return _emit(
        rows, "orders", "order_id",
        ("FLG-005", "orphaned_fk", ~F.col("_known"), _orphan_text("customer_id", "customer"), 0),
        ("FLG-008", "future_date", F.col("order_date") > F.lit(t.rules.cutoff), _future_text("order_date"), 0),
    )


def _activity_flags(t: Warehouse) -> DataFrame:
    return _emit(
        t["activities"].select("activity_id", "notes", "activity_date"), "activities", "activity_id",
        ("FLG-003", "possibly_truncated", truncated_text(F.col("notes")), TRUNCATED_TEXT, 0),
        ("FLG-008", "future_date", F.col("activity_date") > F.lit(t.rules.cutoff), _future_text("activity_date"), 1),
    )


# Per table, all its flags from one reading of it; originals of copies come from
# the tracking table, which names an original once per copy.
BY_TABLE: dict[str, tuple[Callable[[Warehouse], DataFrame], ...]] = {
    "customers": (_customer_flags, duplicate_original),
    "orders": (_order_flags,),
    "order_items": (outlier,),
    "payments": (orphan_payments,),
    "activities": (_activity_flags,),
}


def _union(t: Warehouse, tables: list[str] | None = None) -> DataFrame:
    parts = [rule(t) for table, rules in BY_TABLE.items() if tables is None or table in tables for rule in rules]
    return reduce(DataFrame.unionByName, parts)


def all_flags(t: Warehouse) -> DataFrame:
    """All rules in one table, numbered by rule, table, record and ordinal.

    A plan: the flags are made once and sorted in ranges, whose sizes say where
    the numbers of each begin.
    """
    return numbered(_union(t), ["rule_id", "table_name", "record_id", "ordinal"], "flag_id").select("flag_id", *FLAG_COLUMNS)


def summary(t: Warehouse, tables: list[str] | None = None) -> DataFrame:
    """Flags by rule and type, with the smallest description as an example."""
    return _union(t, tables).groupBy("rule_id", "flag_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("description").alias("example")
    )
