"""Deterministic fault injection.

Rows are chosen by a hash of their key (see ``functions.keyhash``), so the same
defects appear on every run and every recomputed task. Edits are plain column
expressions: no rule but the id-giving ones moves a row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.keyhash import bucket, chosen, draw, drawn, in_span, number
from tidewell.functions.numbers import count_if
from tidewell.operators.flags import MOJIBAKE
from tidewell.sources.warehouse import Warehouse

# Share of rows each rule hits.
NULL_RULES: tuple[tuple[str, str, str, float], ...] = (
    ("orders", "order_id", "ship_date", 0.05),
    ("returns", "return_id", "reason", 0.15),
    ("support_tickets", "ticket_id", "resolved_date", 0.10),
    ("support_tickets", "ticket_id", "resolution_hours", 0.10),
    ("usage_events", "event_id", "session_id", 0.04),
    ("usage_events", "event_id", "duration_seconds", 0.06),
    ("feature_adoption", "adoption_id", "last_used_date", 0.07),
    ("activities", "activity_id", "notes", 0.18),
    ("accounts", "account_id", "last_contact_date", 0.08),
    ("accounts", "account_id", "next_renewal_date", 0.06),
)
REGION_RATE = 0.05
DUPLICATE_RATE = 0.03
SHIFT_RATE, TYPO_RATE = 0.04, 0.005
# The rules of one column share one draw per row and take neighbouring ranges,
# so no value is edited twice and no edit reads the result of another.
NAME_RANGE, NAME_SPACE_RANGE, MOJIBAKE_RANGE = (0.0, 0.12), (0.12, 0.18), (0.18, 0.20)
NOTES_SPACE_RANGE, TRUNCATE_RANGE = (0.18, 0.24), (0.24, 0.25)
ZERO_RANGE, NEGATIVE_RANGE, OUTLIER_RANGE = (0.0, 0.008), (0.008, 0.011), (0.011, 0.013)
ORPHAN_RATE = 0.005
GHOST_START = 90001
GHOST_GAP = 10001
# Misspellings planted for each canonical region.
PLANTED_REGIONS: dict[str, tuple[str, ...]] = {
    "North America": ("N. America", "NA", "north america", "North_America", "NorthAmerica"),
    "Europe": ("EU", "europe", "EMEA", "Europe "),
    "APAC": ("Asia Pacific", "apac", "Asia-Pacific", "AP"),
    "LATAM": ("Latin America", "latam", "LATAM ", "South America"),
}
DUPLICATE_KINDS = ("upper", "lower", "strip_suffix", "add_period")
# Years whose typo swaps the last two digits: 2023 -> 2032, 2024 -> 2042, 2025 -> 2052.
TYPO_YEARS: dict[int, int] = {2023: 9, 2024: 18, 2025: 27}


def _edit(key: str, salt: str, span: tuple[float, float], column: str, new: Callable[[Column], Column]) -> Column:
    old = F.col(column)
    return F.when(drawn(key, salt, *span), new(old)).otherwise(old)


def nulled(key: str, column: str, rate: float) -> Column:
    return _edit(key, f"null.{column}", (0.0, rate), column, _blank)


def _blank(old: Column) -> Column:
    return F.lit(None)


def null_columns(df: DataFrame, table: str) -> DataFrame:
    edits = {c: nulled(key, c, rate) for name, key, c, rate in NULL_RULES if name == table}
    return df.withColumns(edits)


def _without(text: Column, *parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def _name_change(key: str, salt: str = "company_name") -> Callable[[Column], Column]:
    kind = bucket(key, salt, 7)

    def vary(name: Column) -> Column:
        longer = F.replace(F.replace(name, F.lit("Corp."), F.lit("Corporation")), F.lit("Inc."), F.lit("Incorporated"))
        return (
            F.when(kind == 0, F.upper(name)).when(kind == 1, F.lower(name))
            .when(kind == 2, _without(name, " Inc.", " Corp.", " LLC")).when(kind == 3, longer)
            .when(kind == 4, F.concat(name, F.lit("."))).when(kind == 5, F.concat(F.lit(" "), name))
            .otherwise(F.concat(name, F.lit("  ")))
        )

    return vary


def varied_name(key: str, column: str, span: tuple[float, float] = NAME_RANGE, salt: str = "company_name") -> Column:
    return _edit(key, salt, span, column, _name_change(key, salt))


def _region_change(key: str, salt: str = "region") -> Callable[[Column], Column]:
    """The planted lists are a few literals, so they ride in the expression."""

    def misspell(region: Column) -> Column:
        case = F
        for canonical, variants in PLANTED_REGIONS.items():
            nr = (bucket(key, salt, len(variants)) + 1).cast("int")
            case = case.when(region == canonical, F.element_at(F.array(*[F.lit(v) for v in variants]), nr))
        return case.otherwise(region)

    return misspell


def region_variant(key: str, column: str, rate: float = REGION_RATE, salt: str = "region") -> Column:
    return _edit(key, salt, (0.0, rate), column, _region_change(key, salt))


def _space_change(key: str, salt: str) -> Callable[[Column], Column]:
    kind = bucket(key, salt, 3)

    def loosen(text: Column) -> Column:
        at = F.instr(text, " ")
        head, tail = F.substr(text, F.lit(1), at), F.substr(text, at + 1)
        return (
            F.when(kind == 0, F.concat(F.lit(" "), text)).when(kind == 1, F.concat(text, F.lit("  ")))
            .when(at > 0, F.concat(head, F.lit(" "), tail)).otherwise(text)
        )

    return loosen


def whitespace(key: str, column: str, span: tuple[float, float], salt: str) -> Column:
    return _edit(key, salt, span, column, _space_change(key, salt))


def _day_change(key: str, salt: str = "shift") -> Callable[[Column], Column]:
    return lambda day: F.date_add(day, (bucket(key, salt, 5) + 3).cast("int"))


def shifted_date(key: str, column: str, rate: float = SHIFT_RATE, salt: str = "shift") -> Column:
    return _edit(key, salt, (0.0, rate), column, _day_change(key, salt))


def _year_change(years: dict[int, int]) -> Callable[[Column], Column]:
    def mistype(day: Column) -> Column:
        months = F
        for year, shift in years.items():
            months = months.when(F.year(day) == year, 12 * shift)
        return F.add_months(day, months.otherwise(0))

    return mistype


def year_typo(
    key: str, column: str, rate: float = TYPO_RATE, salt: str = "typo", years: dict[int, int] = TYPO_YEARS
) -> Column:
    return _edit(key, salt, (0.0, rate), column, _year_change(years))


def _scaled(price: Column, factor: Column | float) -> Column:
    """Price times a factor; prices that are not positive stay as they are."""
    return price * F.when(price > 0, factor).otherwise(1.0)


def _decimal_shift(key: str, salt: str = "price") -> Column:
    return F.when(bucket(key, salt, 2) == 0, 100.0).otherwise(1000.0)


def zeroed(key: str, column: str, span: tuple[float, float] = ZERO_RANGE, salt: str = "price") -> Column:
    return _edit(key, salt, span, column, lambda price: _scaled(price, 0.0))


def negated(key: str, column: str, span: tuple[float, float] = NEGATIVE_RANGE, salt: str = "price") -> Column:
    return _edit(key, salt, span, column, lambda price: _scaled(price, -1.0))


def outlying(key: str, column: str, span: tuple[float, float] = OUTLIER_RANGE, salt: str = "price") -> Column:
    return _edit(key, salt, span, column, lambda price: _scaled(price, _decimal_shift(key, salt)))


def spoiled_price(key: str, column: str, salt: str = "price") -> Column:
    """All three price rules in one step; most rows need one digest only."""
    hit = F.when(drawn(key, salt, *ZERO_RANGE), 0.0).when(drawn(key, salt, *NEGATIVE_RANGE), -1.0)
    hit = hit.otherwise(_decimal_shift(key, salt))
    return _scaled(F.col(column), F.when(chosen(key, salt, OUTLIER_RANGE[1]), hit).otherwise(1.0))


def _garble(text: Column) -> Column:
    for good, bad in MOJIBAKE.items():
        text = F.replace(text, F.lit(good), F.lit(bad))
    return text


def garbled(key: str, column: str, span: tuple[float, float] = MOJIBAKE_RANGE, salt: str = "company_name") -> Column:
    return _edit(key, salt, span, column, _garble)


def _cut_change(key: str, salt: str = "null.notes") -> Callable[[Column], Column]:
    """Texts longer than 20 are cut somewhere between 10 and half their length."""

    def cut(text: Column) -> Column:
        room = F.greatest(F.floor(F.length(text) / 2) - 9, F.lit(1))
        at = (number(key, salt) % room + 10).cast("int")
        return F.when(F.length(text) > 20, F.substr(text, F.lit(1), at)).otherwise(text)

    return cut


def truncated(key: str, column: str, span: tuple[float, float] = TRUNCATE_RANGE, salt: str = "null.notes") -> Column:
    return _edit(key, salt, span, column, _cut_change(key, salt))


def near_duplicates(
    df: DataFrame, key: str, name: str, rate: float = DUPLICATE_RATE, salt: str = "duplicate"
) -> tuple[DataFrame, DataFrame]:
    """Append varied copies under new ids; also return the tracking table.

    A copy's id is its original's id counted on from the largest id, so new
    ids are unique without numbering the copies.
    """
    kind = F.element_at(F.array(*[F.lit(k) for k in DUPLICATE_KINDS]), (bucket(key, salt, 4) + 1).cast("int"))

    def vary(old: Column) -> Column:
        stripped = _without(old, " Inc.", " Corp.", " LLC", " Ltd.")
        stripped = F.when(stripped == old, F.concat(old, F.lit(" Inc"))).otherwise(stripped)
        return (
            F.when(F.col("_kind") == "upper", F.upper(old)).when(F.col("_kind") == "lower", F.lower(old))
            .when(F.col("_kind") == "strip_suffix", stripped).otherwise(F.concat(old, F.lit(".")))
        )

    top = df.agg(F.max(key)).scalar()
    copies = df.filter(chosen(key, salt, rate)).withColumns({"_kind": kind, "_original": F.col(key)})
    copies = copies.withColumns({key: top + 1 + F.col("_original"), name: vary(F.col(name))})
    tracking = copies.select(
        F.col(key).alias("duplicate_customer_id"), F.col("_original").alias("original_customer_id"),
        F.col("_kind").alias("variation_type"),
    )
    return df.unionByName(copies.select(*df.columns)), tracking


def orphan_fk(
    df: DataFrame, key: str, foreign: str, first_ghost: DataFrame, rate: float = ORPHAN_RATE, salt: str = "orphan"
) -> DataFrame:
    """Point the foreign key of chosen rows at ids no parent has.

    The ghost id is the row's own key counted on from ``first_ghost``, a
    one-row frame: unique per row, and no row moves.
    """
    ghost = first_ghost.scalar() + F.col(key)
    return df.withColumn(foreign, F.when(chosen(key, salt, rate), ghost).otherwise(F.col(foreign)))


def customer_ghosts(customers: DataFrame) -> DataFrame:
    """First id beyond the customers and beyond any copies of them."""
    return customers.agg(F.greatest(F.lit(GHOST_START), F.max("customer_id") * 2 + 2).alias("first_ghost"))


def invoice_ghosts(invoices: DataFrame) -> DataFrame:
    return invoices.agg((F.max("invoice_id") + GHOST_GAP).alias("first_ghost"))


@dataclass(frozen=True)
class Edit:
    """A rule of the degradation plan: rows of a table whose draw falls in ``span`` get a changed value in one column."""

    category: str
    rule: str
    table: str
    key: str
    column: str
    salt: str
    span: tuple[float, float]
    change: Callable[[Column], Column]

    def hit(self, draws: dict[str, Column]) -> Column:
        return in_span(draws[self.salt], *self.span)


def edits(typo_years: dict[int, int] = TYPO_YEARS) -> list[Edit]:
    """Column edits in the order they apply: NULLs, formats, dates, numbers, encoding."""
    customer, activity, line, payment = "customer_id", "activity_id", "line_id", "payment_id"
    names, notes, typo = "company_name", "null.notes", (0.0, TYPO_RATE)
    return [Edit("nulled", f"{t}.{c}", t, key, c, f"null.{c}", (0.0, rate), _blank) for t, key, c, rate in NULL_RULES] + [
        Edit("format", "company_names", "customers", customer, "company_name", names, NAME_RANGE, _name_change(customer)),
        Edit("format", "regions", "customers", customer, "region", "region", (0.0, REGION_RATE), _region_change(customer)),
        Edit("format", "whitespace:customers", "customers", customer, "company_name", names, NAME_SPACE_RANGE, _space_change(customer, names)),
        Edit("format", "whitespace:activities", "activities", activity, "notes", notes, NOTES_SPACE_RANGE, _space_change(activity, notes)),
        Edit("temporal", "shifted_payments", "payments", payment, "payment_date", "shift", (0.0, SHIFT_RATE), _day_change(payment)),
        Edit("temporal", "future_typo:orders", "orders", "order_id", "order_date", "typo", typo, _year_change(typo_years)),
        Edit("temporal", "future_typo:activities", "activities", activity, "activity_date", "typo", typo, _year_change(typo_years)),
        Edit("numeric", "zero_amounts", "order_items", line, "unit_price", "price", ZERO_RANGE, lambda p: _scaled(p, 0.0)),
        Edit("numeric", "negative_amounts", "order_items", line, "unit_price", "price", NEGATIVE_RANGE, lambda p: _scaled(p, -1.0)),
        Edit("numeric", "extreme_outliers", "order_items", line, "unit_price", "price", OUTLIER_RANGE, lambda p: _scaled(p, _decimal_shift(line))),
        Edit("encoding", "mojibake", "customers", customer, "company_name", names, MOJIBAKE_RANGE, _garble),
        Edit("encoding", "truncated", "activities", activity, "notes", notes, TRUNCATE_RANGE, _cut_change(activity)),
    ]


def _drawn(df: DataFrame, own: list[Edit]) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with one draw per salt, and the draws by salt."""
    names = {salt: f"_draw{nr}" for nr, salt in enumerate(dict.fromkeys(e.salt for e in own))}
    return df.withColumns({name: draw(own[0].key, salt) for salt, name in names.items()}), {salt: F.col(name) for salt, name in names.items()}


def _apply(df: DataFrame, table: str, plan: list[Edit], categories: tuple[str, ...]) -> DataFrame:
    """One CASE per column on the row's draw. The rules of a column share the draw and take separate ranges of it."""
    own = [e for e in plan if e.table == table and e.category in categories]
    if not own:
        return df
    columns = df.columns
    df, draws = _drawn(df, own)
    new = {}
    for column in dict.fromkeys(e.column for e in own):
        case = F
        for edit in own:
            if edit.column == column:
                case = case.when(edit.hit(draws), edit.change(F.col(column)))
        new[column] = case.otherwise(F.col(column))
    return df.withColumns(new).select(*columns)


def degraded(w: Warehouse, typo_years: dict[int, int] = TYPO_YEARS) -> Warehouse:
    """The warehouse with every rule applied in the fixed category order."""
    plan = edits(typo_years)

    def column_edits(table: str):
        return lambda _: _apply(w[table], table, plan, ("nulled", "format", "temporal", "numeric", "encoding"))

    @cache
    def customers_and_tracking() -> tuple[DataFrame, DataFrame]:
        tidy = _apply(w["customers"], "customers", plan, ("format",))
        return near_duplicates(tidy, "customer_id", "company_name")

    def customers(_: Warehouse) -> DataFrame:
        return _apply(customers_and_tracking()[0], "customers", plan, ("encoding",))

    def orders(_: Warehouse) -> DataFrame:
        dated = _apply(w["orders"], "orders", plan, ("nulled", "temporal"))
        return orphan_fk(dated, "order_id", "customer_id", customer_ghosts(w["customers"]))

    def payments(_: Warehouse) -> DataFrame:
        dated = _apply(w["payments"], "payments", plan, ("temporal",))
        return orphan_fk(dated, "payment_id", "invoice_id", invoice_ghosts(w["invoices"]))

    def order_items(_: Warehouse) -> DataFrame:
        return w["order_items"].withColumn("unit_price", spoiled_price("line_id", "unit_price"))

    plain = ("returns", "support_tickets", "usage_events", "feature_adoption", "activities", "accounts")
    return w.replacing(
        customers=customers, orders=orders, order_items=order_items, payments=payments,
        duplicate_tracking=lambda _: customers_and_tracking()[1],
        **{table: column_edits(table) for table in plain},
    )


def report(w: Warehouse, typo_years: dict[int, int] = TYPO_YEARS) -> DataFrame:
    """Records each rule changes, with totals per category and overall.

    No two rules hit one value, so each is measured on the value as it was, in
    one pass per table; garbling is measured on the customers with their copies.
    """
    counts = None

    def add(part: DataFrame) -> None:
        nonlocal counts
        counts = part if counts is None else counts.unionByName(part)

    plan = edits(typo_years)
    garble = [e for e in plan if e.rule == "mojibake"]  # acts on the copies too
    tidy = _apply(w["customers"], "customers", plan, ("format",))
    starts = {"customers": w["customers"], "": near_duplicates(tidy, "customer_id", "company_name")[0]}
    rest = [e for e in plan if e not in garble]
    for table in [*dict.fromkeys(e.table for e in rest), ""]:
        own = [e for e in rest if e.table == table] if table else garble
        df, draws = _drawn(starts[table] if table in starts else w[table], own)
        hits = [e.hit(draws) & ~F.col(e.column).eqNullSafe(e.change(F.col(e.column))) for e in own]
        row = df.agg(*[count_if(hit).alias(f"_{nr}") for nr, hit in enumerate(hits)])
        rules = [
            F.struct(F.lit(e.category).alias("category"), F.lit(e.rule).alias("rule"), F.col(f"_{nr}").alias("records"))
            for nr, e in enumerate(own)
        ]
        add(row.select(F.inline(F.array(*rules))))
    extra = (
        ("duplicates", "customers", "customers", "customer_id", "duplicate", DUPLICATE_RATE),
        ("orphans", "orders.customer_id", "orders", "order_id", "orphan", ORPHAN_RATE),
        ("orphans", "payments.invoice_id", "payments", "payment_id", "orphan", ORPHAN_RATE),
    )
    for category, rule, table, key, salt, rate in extra:
        add(
            w[table].agg(count_if(chosen(key, salt, rate)).alias("records"))
            .select(F.lit(category).alias("category"), F.lit(rule).alias("rule"), "records")
        )
    return counts.rollup("category", "rule").agg(F.sum("records").alias("records")).select(
        F.coalesce("category", F.lit("TOTAL")).alias("category"), F.coalesce("rule", F.lit("TOTAL")).alias("rule"),
        "records",
    )


def dry_run(w: Warehouse) -> DataFrame:
    """Rows each NULL rule would hit: floor(rows with a value * rate)."""
    found = None
    for table in dict.fromkeys(t for t, *_ in NULL_RULES):
        rules = [(c, rate) for t, _, c, rate in NULL_RULES if t == table]
        row = w[table].agg(*[F.count(c).alias(c) for c, _ in rules])
        structs = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("rows_with_value"),
                F.floor(F.col(c) * rate).alias("would_affect"),
            )
            for c, rate in rules
        ]
        part = row.select(F.inline(F.array(*structs)))
        found = part if found is None else found.unionByName(part)
    return found
