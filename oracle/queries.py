"""One SQL text per registered query; column names equal the Spark result's."""

from __future__ import annotations

import re

from oracle.dialect import (
    bucket, change, chosen, drawn, favg, fixed, iavg, mavg, month, msum, pct, qtr, rat, rnd, with_tables, year, yq,
)
from oracle.tables import (
    AS_OF, CUTOFF, FOCUS, MOJIBAKE, T, cut, garbled, loosened, misspelt, mistyped, varied,
)

Q: dict[str, str] = {}


def over_degraded(sql: str) -> str:
    """The same SQL with d_* and dv_* tables for b_* and v_*, and helpers built on those alike."""

    def other(m: re.Match) -> str:
        kind, name = m.groups()
        if kind == "x":
            if over_degraded(T.get(f"x_{name}", "")) == T.get(f"x_{name}", ""):
                return m[0]
            T[f"x_degraded_{name}"] = over_degraded(T[f"x_{name}"])
            return f"x_degraded_{name}"
        target = f"{'d' if kind == 'b' else 'dv'}_{name}"
        return target if target in T else m[0]

    return re.sub(r"\b(b|v|x)_([a-z0-9_]+)\b", other, sql)


T["d_mrr_movements"] = "SELECT * FROM b_mrr_movements"
for _n in ("customer_xref", "customer_360"):
    T[f"d_{_n}"] = over_degraded(T[f"b_{_n}"])
CANONICAL = "('North America','Europe','APAC','LATAM')"


def share(window: str) -> str:
    return f"sum({fixed('revenue')}) {window}::DOUBLE/100"


OPEN = "stage NOT IN ('closed_won','closed_lost')"

# -- sources ------------------------------------------------------------------
Q["src_coerce_dates"] = """SELECT o_orderkey, try_cast(day AS DATE) AS order_date, try_cast(strftime(o_orderdate,'%Y-%m-%d 08:30:00') AS TIMESTAMP)::DATE AS ship_date
    FROM (SELECT *, CASE WHEN o_orderkey%7=0 THEN strftime(o_orderdate,'%Y-')||'13-45' WHEN o_orderkey%11=0 THEN 'n/a'
        WHEN o_orderkey%13=0 THEN NULL ELSE strftime(o_orderdate,'%Y-%m-%d') END AS day FROM orders)"""
_STAR = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag
        l_linestatus l_shipdate""",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
}
Q["src_build_schema"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CASE WHEN '{c}' LIKE '%date' THEN 'date'
        WHEN max(typeof({c})) LIKE '%INT%' THEN 'bigint' WHEN max(typeof({c})) IN ('DOUBLE','FLOAT') OR max(typeof({c})) LIKE 'DECIMAL%'
        THEN 'double' WHEN max(typeof({c}))='BOOLEAN' THEN 'boolean' ELSE 'string' END AS type,
        count({c}) AS n_values, count(*)-count({c}) AS n_nulls FROM {t}"""
    for t, columns in _STAR.items() for c in columns.split()
)

# -- exclusion ----------------------------------------------------------------
PRICED = "SELECT line_id, order_id, product_id, unit_price FROM d_order_items"
Q["ex_zero_price"] = f"{PRICED} WHERE unit_price>0"
Q["ex_negative_price"] = """SELECT product_id, count(*) AS n_lines, min(unit_price) AS min_price
    FROM d_order_items WHERE unit_price>0 GROUP BY 1"""
Q["ex_orphan_orders"] = """SELECT order_id, customer_id, total_amount FROM d_orders
    WHERE customer_id IN (SELECT customer_id FROM d_customers)"""
Q["ex_orphan_payments"] = """SELECT payment_id, invoice_id, amount FROM d_payments
    WHERE invoice_id IN (SELECT invoice_id FROM d_invoices)"""
Q["ex_future_orders"] = f"SELECT order_id, order_date FROM d_orders WHERE order_date<={CUTOFF}"
Q["ex_future_activities"] = f"SELECT activity_id, activity_date FROM d_activities WHERE activity_date<={CUTOFF}"
Q["ex_future_payments"] = f"SELECT payment_id, payment_date FROM d_payments WHERE payment_date<={CUTOFF}"
Q["ex_known_duplicates"] = """SELECT customer_id, company_name FROM d_customers
    WHERE customer_id NOT IN (SELECT duplicate_customer_id FROM d_duplicate_tracking)"""
Q["ex_price_cap"] = f"{PRICED} WHERE unit_price<10000"
Q["ex_null_key"] = "SELECT event_id, session_id FROM d_usage_events WHERE session_id IS NOT NULL"
Q["ex_override_label"] = f"""
    SELECT 'governed' AS data_scope, count(*) AS orders, {msum('total_amount')} AS revenue FROM dv_orders
    UNION ALL SELECT 'including excluded records', count(*), {msum('total_amount')} FROM d_orders
    WHERE customer_id IN (SELECT customer_id FROM d_customers)"""

# -- normalisation and imputation ----------------------------------------------
Q["nrm_company_name"] = "SELECT customer_id, upper(trim(company_name)) AS company_name FROM d_customers"
Q["nrm_notes_trim"] = "SELECT activity_id, trim(notes) AS notes FROM d_activities"
Q["nrm_region_lookup"] = """SELECT customer_id, coalesce((SELECT canonical FROM b_region_mapping m
    WHERE m.variant=upper(trim(c.region))),'Unknown') AS region FROM d_customers c"""
Q["nrm_region_case"] = """SELECT customer_id, CASE
    WHEN upper(trim(region)) IN ('NORTH AMERICA','N. AMERICA','NA','NORTH_AMERICA','NORTHAMERICA') THEN 'North America'
    WHEN upper(trim(region)) IN ('EUROPE','EU','EMEA') THEN 'Europe'
    WHEN upper(trim(region)) IN ('APAC','ASIA PACIFIC','ASIA-PACIFIC','AP') THEN 'APAC'
    WHEN upper(trim(region)) IN ('LATAM','LATIN AMERICA','SOUTH AMERICA') THEN 'LATAM' ELSE 'Unknown' END AS region
    FROM d_customers"""
Q["nrm_cap_percentile"] = f"""SELECT product_id, count(*) AS n_lines, {mavg('unit_price')} AS avg_price,
    sum(CAST(floor(least(unit_price, cap/100.0::DOUBLE)*10000+0.5) AS BIGINT))::DOUBLE/10000/count(*) AS avg_capped
    FROM d_order_items, (SELECT quantile_cont({fixed('unit_price')}::DOUBLE, 0.99) AS cap FROM d_order_items) GROUP BY 1"""
Q["nrm_discount_null"] = "SELECT order_id, coalesce(discount_pct,0)::DOUBLE AS discount_pct FROM b_orders"
for _key, _table, _pk, _col, _text in (
    ("imp_ship_date", "d_orders", "order_id", "ship_date", "Pending"),
    ("imp_reason", "d_returns", "return_id", "reason", "Not recorded"),
    ("imp_resolved", "d_support_tickets", "ticket_id", "resolved_date", "Open"),
    ("imp_hours", "d_support_tickets", "ticket_id", "resolution_hours", "N/A"),
    ("imp_notes", "d_activities", "activity_id", "notes", "No notes recorded"),
    ("imp_last_contact", "d_accounts", "account_id", "last_contact_date", "Not on file"),
    ("imp_renewal", "d_accounts", "account_id", "next_renewal_date", "TBD"),
    ("imp_session", "d_usage_events", "event_id", "session_id", "No session"),
    ("imp_duration", "d_usage_events", "event_id", "duration_seconds", "N/A"),
    ("imp_last_used", "d_feature_adoption", "adoption_id", "last_used_date", "Unknown"),
):
    Q[_key] = f"""SELECT {_pk}, {_col}, CASE WHEN {_col} IS NULL THEN '{_text}' ELSE {_col}::VARCHAR END
        AS {_col}_display FROM {_table}"""
Q["imp_count_semantics"] = f"""SELECT count(*) AS all_rows, count(resolution_hours) AS rows_with_value,
    {iavg('resolution_hours')} AS avg_of_values FROM d_support_tickets"""

# -- clean views ----------------------------------------------------------------
VIEW_NAMES = (
    "customers", "orders", "order_items", "returns", "saas_customers", "support_tickets", "usage_events",
    "feature_adoption", "invoices", "payments", "activities", "opportunities",
)
for _n in VIEW_NAMES:
    Q[f"cv_{_n}"] = f"SELECT * FROM dv_{_n}"
Q["cv_reconcile"] = " UNION ALL ".join(
    f"""SELECT 'v_{n}_clean' AS view_name, (SELECT count(*) FROM dv_{n}) AS clean_rows,
    (SELECT count(*) FROM d_{n}) AS raw_rows, (SELECT count(*) FROM d_{n})-(SELECT count(*) FROM dv_{n}) AS excluded"""
    for n in VIEW_NAMES
)

# -- flags ----------------------------------------------------------------------
_WS = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)||chr(28)||chr(29)||chr(30)||chr(31)||chr(133)||chr(160)" \
    "||chr(5760)||" + "||".join(f"chr({c})" for c in range(8192, 8203)) + "||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
_LAST = f"right(rtrim(notes,{_WS}),1)"


def flag(rule: str, table: str, key: str, kind: str, text: str, source: str, ordinal: str = "0") -> str:
    return f"""SELECT '{rule}' AS rule_id, '{table}' AS table_name, {key} AS record_id, '{kind}' AS flag_type,
        {text} AS description, ({ordinal})::BIGINT AS ordinal FROM {source}"""


def mojibake(table: str, key: str, column: str, source: str) -> str:
    return " UNION ALL ".join(
        flag("FLG-004", table, key, "encoding_issue", f"'Company name contains mojibake pattern: {bad}'",
             f"{source} WHERE contains({column},'{bad}')", str(i))
        for i, (_, bad) in enumerate(MOJIBAKE, 1)
    )


F: dict[str, str] = {}
T["x_limit"] = f"""SELECT (m+3*sqrt(greatest(q-m*m,0)))/100 AS upper FROM (SELECT sum(c)::DOUBLE/count(*) AS m,
    sum(c::HUGEINT*c)::DOUBLE/count(*) AS q FROM (SELECT {fixed('unit_price')} AS c FROM d_order_items WHERE unit_price>0))"""
F["outlier"] = flag(
    "FLG-001", "order_items", "line_id", "outlier",
    "'unit_price exceeds 3 std devs (threshold: '||printf('%.2f',upper)||')'",
    "d_order_items, x_limit WHERE unit_price>0 AND unit_price>upper",
)
F["duplicate_tracked"] = flag(
    "FLG-002", "customers", "customer_id", "duplicate_suspect",
    "'Near-duplicate record (tracked in duplicate_tracking)'",
    "d_duplicate_tracking JOIN d_customers ON duplicate_customer_id=customer_id",
)
F["duplicate_original"] = flag(
    "FLG-002", "customers", "customer_id", "duplicate_suspect", "'Original record has one or more near-duplicates'",
    "d_duplicate_tracking JOIN d_customers ON original_customer_id=customer_id", "duplicate_customer_id+1",
)
T["x_clusters"] = """SELECT upper(trim(company_name)) AS norm, region AS reg FROM d_customers
    WHERE company_name IS NOT NULL GROUP BY 1,2 HAVING count(*)>1"""
F["duplicate_cluster"] = flag(
    "FLG-002", "customers", "customer_id", "duplicate_suspect",
    "'Matches duplicate cluster: '||norm||' / '||reg",
    """d_customers JOIN x_clusters ON upper(trim(company_name))=norm AND region=reg
    WHERE customer_id NOT IN (SELECT duplicate_customer_id FROM d_duplicate_tracking)
    AND customer_id NOT IN (SELECT original_customer_id FROM d_duplicate_tracking)""",
)
F["truncated"] = flag(
    "FLG-003", "activities", "activity_id", "possibly_truncated", "'Notes may be truncated (ends mid-word)'",
    f"""d_activities WHERE length(notes)>10 AND regexp_full_match({_LAST},'\\p{{L}}')
    AND {_LAST} NOT IN ('c','g','d','s','t','n','e','y')""",
)
F["mojibake"] = mojibake("customers", "customer_id", "company_name", "d_customers")
F["orphan_orders"] = flag(
    "FLG-005", "orders", "order_id", "orphaned_fk", "'customer_id='||o.customer_id||' does not match any customer'",
    "d_orders o LEFT JOIN d_customers c ON o.customer_id=c.customer_id WHERE c.customer_id IS NULL",
)
F["orphan_payments"] = flag(
    "FLG-006", "payments", "payment_id", "orphaned_fk", "'invoice_id='||p.invoice_id||' does not match any invoice'",
    "d_payments p LEFT JOIN d_invoices i ON p.invoice_id=i.invoice_id WHERE i.invoice_id IS NULL",
)
F["whitespace"] = flag(
    "FLG-007", "customers", "customer_id", "whitespace_issue",
    "'Company name has leading/trailing/double whitespace'",
    "d_customers WHERE company_name LIKE ' %' OR company_name LIKE '% ' OR company_name LIKE '%  %'",
)
F["future_date"] = flag(
    "FLG-008", "orders", "order_id", "future_date", "'order_date='||order_date||' is beyond data range'",
    f"d_orders WHERE order_date>{CUTOFF}",
) + " UNION ALL " + flag(
    "FLG-008", "activities", "activity_id", "future_date", "'activity_date='||activity_date||' is beyond data range'",
    f"d_activities WHERE activity_date>{CUTOFF}", "1",
)
T["x_flags"] = " UNION ALL ".join(F.values())
for _n, _sql in F.items():
    if _n != "mojibake":
        Q[f"flg_{_n}"] = f"SELECT rule_id, table_name, record_id, flag_type, description FROM ({_sql})"
T["x_garbled"] = f"""SELECT activity_id, CASE WHEN {drawn('activity_id', 'company_name', 0.0, 0.2)}
    THEN {garbled('activity_id', 'notes').split('THEN ')[1].split(' ELSE')[0]} ELSE notes END AS notes FROM b_activities"""
Q["flg_mojibake"] = f"""SELECT rule_id, table_name, record_id, flag_type, description
    FROM ({mojibake('activities', 'activity_id', 'notes', 'x_garbled')})"""
Q["flg_truncated_punctuation"] = f"""SELECT 'FLG-003' AS rule_id, 'activities' AS table_name, activity_id AS record_id,
    'possibly_truncated' AS flag_type, 'Notes may be truncated (ends mid-word)' AS description
    FROM d_activities WHERE length(notes)>10 AND {_LAST}<>'' AND {_LAST} NOT IN ('.','!','?')"""
Q["flg_cluster_rows"] = """SELECT product_id, norm AS cluster_name, subcategory, n AS cluster_size FROM (
    SELECT product_id, upper(trim(product_name)) AS norm, subcategory,
        count(*) OVER (PARTITION BY upper(trim(product_name)), subcategory) AS n
    FROM b_products WHERE product_name IS NOT NULL) WHERE n>1"""
Q["flg_all"] = """SELECT row_number() OVER (ORDER BY rule_id, table_name, record_id, ordinal) AS flag_id,
    rule_id, table_name, record_id, flag_type, description FROM x_flags"""
Q["flg_summary"] = """SELECT rule_id, flag_type, count(*) AS n, min(description) AS example FROM x_flags GROUP BY 1,2"""
Q["flg_summary_tables"] = """SELECT rule_id, flag_type, count(*) AS n, min(description) AS example FROM x_flags
    WHERE table_name IN ('orders','payments') GROUP BY 1,2"""

# -- profiling --------------------------------------------------------------------
Q["prf_raw_vs_clean"] = " UNION ALL ".join(
    f"""SELECT raw_rows, clean_rows, raw_rows-clean_rows AS excluded,
    {rnd(pct('raw_rows-clean_rows', 'raw_rows'), 2)} AS excluded_pct, '{n}' AS table_name
    FROM (SELECT (SELECT count(*) FROM d_{n}) AS raw_rows, (SELECT count(*) FROM dv_{n}) AS clean_rows)"""
    for n in VIEW_NAMES
)
_COLUMNS = {
    "customers": "customer_id company_name customer_type region segment industry acquisition_date acquisition_channel status annual_revenue_tier",
    "orders": "order_id customer_id order_date ship_date status channel region total_amount discount_pct",
    "order_items": "line_id order_id product_id quantity unit_price line_total",
    "returns": "return_id order_id return_date reason refund_amount status",
    "support_tickets": "ticket_id saas_customer_id created_date resolved_date category priority resolution_hours",
    "usage_events": "event_id user_id saas_customer_id event_date event_type feature_module session_id duration_seconds",
    "feature_adoption": "adoption_id saas_customer_id feature_module first_used_date last_used_date total_events monthly_active_users adoption_depth",
    "activities": "activity_id account_id activity_date activity_type subject notes outcome",
    "accounts": "account_id customer_id owner account_tier health_score last_contact_date next_renewal_date",
    "products": "product_id product_name category subcategory unit_price cost launch_date status",
    "saas_customers": "saas_customer_id customer_id plan_tier signup_date contract_months mrr status usage_score",
    "mrr_movements": "movement_id saas_customer_id movement_date movement_type amount previous_mrr new_mrr",
    "saas_users": "user_id saas_customer_id email role created_date last_login_date status",
    "invoices": "invoice_id order_id customer_id invoice_date due_date amount status",
    "payments": "payment_id invoice_id payment_date amount method days_to_pay is_late",
    "opportunities": "opp_id account_id opp_name stage amount close_date probability product_interest",
    "customer_xref": "customer_id ecommerce_id saas_customer_id account_id payment_customer_id",
    "customer_360": """customer_id company_name region segment total_orders total_revenue total_returns return_rate saas_plan
        saas_mrr saas_usage_score dau_mau_ratio features_adopted avg_session_minutes avg_days_to_pay late_payment_pct
        account_health last_activity_date open_opportunities lifetime_value""",
}
T["x_null_rates"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name,
    {rnd(pct(f'count(*)-count({c})', 'count(*)'), 2)} AS null_pct FROM d_{t}"""
    for t, columns in _COLUMNS.items() for c in columns.split()
)
Q["prf_null_rates"] = "SELECT * FROM x_null_rates WHERE null_pct>0"
Q["prf_completeness_alert"] = "SELECT *, null_pct>5 AS alert FROM x_null_rates WHERE null_pct>0"
Q["prf_orphan_rate"] = " UNION ALL ".join(
    f"""SELECT '{c}.{k}' AS relation, count(*) FILTER (WHERE p.{k} IS NULL) AS orphans, count(*) AS n_rows,
    {rnd(pct(f'count(*) FILTER (WHERE p.{k} IS NULL)', 'count(*)'), 4)} AS orphan_pct
    FROM d_{c} c LEFT JOIN d_{p} p ON c.{k}=p.{k}"""
    for c, p, k in (("orders", "customers", "customer_id"), ("payments", "invoices", "invoice_id"))
)
Q["prf_outlier_counts"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS outliers FROM d_order_items, (SELECT m, sqrt(greatest(q-m*m,0)) AS s FROM
    (SELECT sum(x)::DOUBLE/count(*) AS m, sum(x::HUGEINT*x)::DOUBLE/count(*) AS q FROM (SELECT {fixed(c)} AS x FROM d_order_items)))
    WHERE abs({fixed(c)}-m)>3*s"""
    for c in ("quantity", "unit_price", "line_total")
)
Q["prf_encoding_counts"] = " UNION ALL ".join(
    f"SELECT '{bad}' AS pattern, count(*) AS n_rows FROM x_garbled WHERE contains(notes,'{bad}')" for _, bad in MOJIBAKE
)
Q["prf_future_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_future FROM d_{t} WHERE {c}>{CUTOFF}"
    for t, c in (("orders", "order_date"), ("payments", "payment_date"), ("activities", "activity_date"),
                 ("opportunities", "close_date"))
)
Q["prf_duplicate_count"] = """SELECT (SELECT count(*) FROM d_duplicate_tracking) AS tracked, count(*) AS clusters,
    coalesce(sum(n),0)::BIGINT AS clustered_rows FROM (SELECT count(*) AS n FROM d_customers
    WHERE company_name IS NOT NULL GROUP BY upper(trim(company_name)), region HAVING count(*)>1)"""
Q["prf_value_variants"] = " UNION ALL ".join(
    f"""SELECT '{phase}' AS phase, region AS value, count(*) AS n,
    CASE WHEN region IN {CANONICAL} THEN 'canonical' ELSE 'variant' END AS mark FROM {source} GROUP BY region"""
    for phase, source in (("raw", "d_customers"), ("governed", "dv_customers"))
)
Q["prf_page_callouts"] = " UNION ALL ".join(
    f"SELECT '{page}' AS page, '{name}' AS callout, count(*) AS n FROM d_{t} WHERE {cond}"
    for page, name, t, cond in (
        ("e-commerce", "zero_price_lines", "order_items", "unit_price=0"),
        ("e-commerce", "returns_without_reason", "returns", "reason IS NULL"),
        ("subscriptions", "open_tickets", "support_tickets", "resolved_date IS NULL"),
        ("product", "events_without_session", "usage_events", "session_id IS NULL"),
        ("product", "adoption_without_last_use", "feature_adoption", "last_used_date IS NULL"),
        ("payments", "future_payments", "payments", f"payment_date>{CUTOFF}"),
    )
)

# -- degradation --------------------------------------------------------------------
Q["deg_null_columns"] = "SELECT ticket_id, resolved_date, resolution_hours FROM d_support_tickets"
Q["deg_name_variation"] = f"SELECT customer_id, {varied('customer_id', 'company_name')} AS company_name FROM b_customers"
Q["deg_region_variant"] = f"SELECT customer_id, {misspelt('customer_id', 'region')} AS region FROM b_customers"
Q["deg_whitespace"] = f"SELECT activity_id, {loosened('activity_id', 'notes', 'null.notes', 0.18, 0.24)} AS notes FROM b_activities"
T["x_dup_new"] = f"""SELECT c.*, ['upper','lower','strip_suffix','add_period'][{bucket('customer_id', 'duplicate', 4)}+1] AS kind,
    (SELECT max(customer_id) FROM b_customers)+1+customer_id AS new_id,
    replace(replace(replace(replace(company_name,' Inc.',''),' Corp.',''),' LLC',''),' Ltd.','') AS stripped
    FROM b_customers c WHERE {chosen('customer_id', 'duplicate', 0.03)}"""
Q["deg_near_duplicates"] = """SELECT customer_id, company_name, region, NULL::BIGINT AS original_customer_id,
    NULL::VARCHAR AS variation_type FROM b_customers UNION ALL
    SELECT new_id, CASE kind WHEN 'upper' THEN upper(company_name) WHEN 'lower' THEN lower(company_name)
        WHEN 'strip_suffix' THEN CASE WHEN stripped=company_name THEN company_name||' Inc' ELSE stripped END
        ELSE company_name||'.' END, region, customer_id, kind FROM x_dup_new"""
Q["deg_shift_dates"] = f"""SELECT payment_id, payment_date+CASE WHEN {chosen('payment_id', 'shift', 0.04)}
    THEN ({bucket('payment_id', 'shift', 5)}+3)::INT ELSE 0 END AS payment_date FROM b_payments"""
Q["deg_year_typo"] = f"SELECT order_id, {mistyped('order_id', 'order_date')} AS order_date FROM b_orders"
Q["deg_zero"] = f"""SELECT line_id, CASE WHEN {drawn('line_id', 'price', 0.0, 0.008)} AND unit_price>0 THEN 0
    ELSE unit_price END AS unit_price FROM b_order_items"""
Q["deg_negative"] = f"""SELECT line_id, CASE WHEN {drawn('line_id', 'price', 0.008, 0.011)} AND unit_price>0
    THEN -unit_price ELSE unit_price END AS unit_price FROM b_order_items"""
Q["deg_outlier"] = f"""SELECT line_id, CASE WHEN {drawn('line_id', 'price', 0.011, 0.013)} AND unit_price>0
    THEN unit_price*CASE WHEN {bucket('line_id', 'price', 2)}=0 THEN 100 ELSE 1000 END ELSE unit_price END AS unit_price
    FROM b_order_items"""
Q["deg_orphan_fk"] = f"""SELECT order_id, CASE WHEN {chosen('order_id', 'orphan', 0.005)}
    THEN (SELECT greatest(90001, max(customer_id)*2+2) FROM b_customers)+order_id ELSE customer_id END AS customer_id
    FROM b_orders"""
Q["deg_mojibake"] = f"SELECT activity_id, {garbled('activity_id', 'notes')} AS notes FROM b_activities"
Q["deg_truncate"] = f"SELECT activity_id, {cut('activity_id', 'notes')} AS notes FROM b_activities"


def changed(before: str, after: str, key: str, column: str) -> str:
    return f"""(SELECT count(*) FROM {before} p JOIN {after} q USING ({key})
        WHERE p.{column} IS DISTINCT FROM q.{column})"""


_REPORT = [
    ("nulled", f"{t}.{c}", changed(f"b_{t}", f"d_{t}", k, c)) for t, k, c in (
        ("orders", "order_id", "ship_date"), ("returns", "return_id", "reason"),
        ("support_tickets", "ticket_id", "resolved_date"), ("support_tickets", "ticket_id", "resolution_hours"),
        ("usage_events", "event_id", "session_id"), ("usage_events", "event_id", "duration_seconds"),
        ("feature_adoption", "adoption_id", "last_used_date"), ("accounts", "account_id", "last_contact_date"),
        ("accounts", "account_id", "next_renewal_date"),
    )
] + [
    ("nulled", "activities.notes", changed("b_activities", "x_act_nulled", "activity_id", "notes")),
    ("format", "company_names", changed("b_customers", "x_named", "customer_id", "company_name")),
    ("format", "regions", changed("b_customers", "x_named", "customer_id", "region")),
    ("format", "whitespace:customers", changed("x_named", "x_spaced", "customer_id", "company_name")),
    ("format", "whitespace:activities", changed("x_act_nulled", "x_act_spaced", "activity_id", "notes")),
    ("temporal", "shifted_payments", changed("b_payments", "d_payments", "payment_id", "payment_date")),
    ("temporal", "future_typo:orders", changed("b_orders", "d_orders", "order_id", "order_date")),
    ("temporal", "future_typo:activities", changed("b_activities", "d_activities", "activity_id", "activity_date")),
    ("numeric", "zero_amounts", changed("b_order_items", "x_zeroed", "line_id", "unit_price")),
    ("numeric", "negative_amounts", changed("x_zeroed", "x_negated", "line_id", "unit_price")),
    ("numeric", "extreme_outliers", changed("x_negated", "d_order_items", "line_id", "unit_price")),
    ("encoding", "mojibake", changed("x_doubled", "d_customers", "customer_id", "company_name")),
    ("encoding", "truncated", changed("x_act_spaced", "d_activities", "activity_id", "notes")),
    ("duplicates", "customers", "(SELECT count(*) FROM x_copies)"),
    ("orphans", "orders.customer_id", changed("b_orders", "d_orders", "order_id", "customer_id")),
    ("orphans", "payments.invoice_id", changed("b_payments", "d_payments", "payment_id", "invoice_id")),
]
T["x_report"] = " UNION ALL ".join(f"SELECT '{c}' AS category, '{r}' AS rule, {n} AS records" for c, r, n in _REPORT)
Q["deg_report"] = """SELECT coalesce(category,'TOTAL') AS category, coalesce(rule,'TOTAL') AS rule,
    sum(records)::BIGINT AS records FROM x_report GROUP BY ROLLUP (category, rule)"""
_DRY = (
    ("orders", "ship_date", 0.05), ("returns", "reason", 0.15), ("support_tickets", "resolved_date", 0.10),
    ("support_tickets", "resolution_hours", 0.10), ("usage_events", "session_id", 0.04),
    ("usage_events", "duration_seconds", 0.06), ("feature_adoption", "last_used_date", 0.07),
    ("activities", "notes", 0.18), ("accounts", "last_contact_date", 0.08), ("accounts", "next_renewal_date", 0.06),
)
Q["deg_dry_run"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS rows_with_value,
    floor(count({c})*{rate}::DOUBLE)::BIGINT AS would_affect FROM b_{t}""" for t, c, rate in _DRY
)

# -- derived tables -------------------------------------------------------------------
Q["der_feature_adoption"] = "SELECT * FROM b_feature_adoption"
Q["der_usage_score"] = f"""
    SELECT s.saas_customer_id, s.status, (CASE
        WHEN a.events IS NULL THEN CASE WHEN s.status='churned' AND s.usage_score>20 THEN 5 ELSE s.usage_score END
        WHEN s.status='churned' THEN least(20, score) ELSE score END)::INT AS usage_score
    FROM b_saas_customers s LEFT JOIN (
        SELECT e.saas_customer_id, count(*) AS events, trunc(greatest(0, least(100,
            least(count(DISTINCT user_id)::DOUBLE/greatest(coalesce(max(seats),1),1),1)*35
            +count(DISTINCT feature_module)::DOUBLE/6*25+least(count(*)::DOUBLE/500,1)*25
            +least(coalesce({iavg('duration_seconds')},0)/600,1)*15))) AS score
        FROM b_usage_events e LEFT JOIN (SELECT saas_customer_id, count(*) AS seats FROM b_saas_users
            WHERE status='active' GROUP BY 1) u USING (saas_customer_id)
        WHERE event_date::DATE>={AS_OF}-30 GROUP BY 1) a USING (saas_customer_id)"""
Q["der_last_login"] = "SELECT user_id, max(event_date)::DATE AS last_login_date FROM b_usage_events GROUP BY 1"
Q["der_invoice"] = """SELECT customer_id, order_id, order_date, segment, terms, order_date+terms AS due_date FROM (
    SELECT o.customer_id, order_id, order_date, segment, CASE segment WHEN 'enterprise' THEN 60 WHEN 'mid_market' THEN 45
        ELSE 30 END AS terms FROM b_orders o JOIN b_customers c USING (customer_id))"""
Q["der_is_late"] = """SELECT payment_id, days_to_pay, (due_date-invoice_date)::INT AS terms,
    CASE WHEN days_to_pay>due_date-invoice_date THEN 1 ELSE 0 END AS is_late
    FROM b_payments JOIN b_invoices USING (invoice_id)"""
Q["der_invoice_overdue"] = f"""SELECT invoice_id, payment_date, is_late,
    CASE WHEN is_late=1 AND payment_date>{CUTOFF} THEN 'overdue' ELSE 'paid' END AS invoice_status FROM b_payments"""
Q["der_order_total"] = f"""SELECT order_id, {msum(rnd('unit_price*quantity', 2))} AS order_total, count(*) AS n_lines
    FROM b_order_items GROUP BY 1"""
Q["der_discounted_price"] = f"""SELECT line_id, {rnd('p.unit_price*(1-discount_pct)', 2)} AS price
    FROM b_order_items i JOIN b_orders USING (order_id) JOIN b_products p USING (product_id)"""
Q["der_mrr_movements"] = "SELECT * FROM b_mrr_movements"
Q["der_current_mrr"] = """SELECT saas_customer_id, new_mrr AS mrr,
    CASE WHEN movement_type='churn' THEN 'churned' ELSE 'active' END AS status FROM (
    SELECT *, row_number() OVER (PARTITION BY saas_customer_id ORDER BY movement_date DESC) AS rn FROM b_mrr_movements)
    WHERE rn=1"""
Q["der_months_active"] = """SELECT movement_id, m.saas_customer_id, movement_date, movement_type,
    ((year(movement_date)-year(signup_date))*12+month(movement_date)-month(signup_date)+1)::INT AS months_active
    FROM b_mrr_movements m JOIN b_saas_customers s USING (saas_customer_id)"""
Q["der_account_tier"] = """SELECT account_id, a.customer_id, health_score, CASE WHEN s.status='churned' THEN 'at_risk'
    WHEN s.usage_score<30 THEN 'at_risk' WHEN health_score>=80 THEN 'strategic' WHEN health_score>=60 THEN 'growth'
    ELSE 'maintain' END AS account_tier FROM b_accounts a LEFT JOIN b_saas_customers s USING (customer_id)"""
Q["der_stage_probability"] = "SELECT opp_id, stage, probability FROM b_opportunities"
Q["der_period_tag"] = f"""SELECT order_date, orders, revenue, period, value FROM (
    SELECT order_date, count(*) AS orders, {msum('total_amount')} AS revenue FROM b_orders GROUP BY 1)
    LEFT JOIN (VALUES ('q2_1997_growth',1997,2,NULL),('q3_1998_delays',1998,3,'1.2'),('q1_1999_push',1999,1,'0.85'))
        t(period,y,q,value) ON year(order_date)=y AND quarter(order_date)=q"""
Q["der_month_spine"] = f"""SELECT saas_customer_id, {year('first_day')} AS year, month(first_day)::INT AS month, first_day,
    least(last_day(first_day), {CUTOFF}) AS last_day FROM (
    SELECT saas_customer_id, unnest(generate_series(date_trunc('month',signup_date)::TIMESTAMP,
        TIMESTAMP '2000-12-01', INTERVAL 1 MONTH))::DATE AS first_day
    FROM b_saas_customers WHERE signup_date<={CUTOFF})"""
Q["der_customer_xref"] = "SELECT * FROM b_customer_xref"
Q["der_customer_360"] = "SELECT * FROM b_customer_360"

# -- executive ------------------------------------------------------------------------
Q["exec_kpis"] = f"""SELECT (SELECT {msum('total_amount')} FROM v_orders) AS total_rev,
    (SELECT count(*) FROM v_orders) AS total_orders, (SELECT count(*) FROM v_customers) AS total_cust,
    (SELECT count(*) FROM v_saas_customers WHERE status='active') AS active_saas,
    (SELECT {msum('mrr')} FROM v_saas_customers WHERE status='active') AS total_mrr,
    (SELECT {msum('amount')} FROM v_opportunities WHERE {OPEN}) AS pipeline"""
Q["monthly_revenue"] = f"""SELECT {month('order_date')} AS month, {msum('total_amount')} AS revenue, count(*) AS orders,
    count(DISTINCT customer_id) AS unique_customers, {mavg('total_amount')} AS avg_order_value,
    {favg('discount_pct')} AS avg_discount FROM v_orders GROUP BY 1"""
Q["yoy_performance"] = f"""SELECT *, {change('revenue', 'lag(revenue) OVER (ORDER BY year)')} AS rev_growth,
    {change('orders', 'lag(orders) OVER (ORDER BY year)')} AS order_growth FROM (
    SELECT {year('order_date')} AS year, {msum('total_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers, {mavg('total_amount')} AS aov,
        {favg('discount_pct')}*100 AS avg_discount_pct FROM v_orders GROUP BY 1)"""
Q["region_share"] = f"""SELECT region, revenue, {pct('revenue', share('OVER ()'))} AS share_pct FROM (
    SELECT region, {msum('total_amount')} AS revenue FROM v_orders GROUP BY 1)"""
Q["region_year_share"] = f"""SELECT *, {pct('revenue', share('OVER (PARTITION BY year)'))} AS share_pct FROM (
    SELECT {year('order_date')} AS year, region, {msum('total_amount')} AS revenue, count(*) AS orders,
        count(DISTINCT customer_id) AS customers FROM v_orders GROUP BY 1,2)"""
Q["customer_mix"] = " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, {d}::VARCHAR AS value, count(*) AS n,
    {pct('count(*)', '(SELECT count(*) FROM v_customers)')} AS share_pct FROM v_customers GROUP BY {d}"""
    for d in ("segment", "industry", "region", "acquisition_channel", "status")
)
Q["status_by_segment"] = "SELECT segment, status, count(*) AS n FROM v_customers GROUP BY 1,2"
Q["acquisition_monthly"] = f"SELECT {month('acquisition_date')} AS month, count(*) AS new_customers FROM v_customers GROUP BY 1"
Q["acquisition_yearly"] = f"SELECT {year('acquisition_date')} AS year, count(*) AS new_customers FROM v_customers GROUP BY 1"
Q["c360_top_ltv"] = f"""SELECT customer_id, company_name, region, segment, total_orders,
    {rnd('total_revenue', 0)} AS revenue, saas_plan, account_health, {rnd('lifetime_value', 0)} AS ltv
    FROM b_customer_360 WHERE lifetime_value>0 ORDER BY lifetime_value DESC, customer_id LIMIT 10"""
Q["c360_bottom_health"] = f"""SELECT customer_id, company_name, region, segment, account_health, saas_plan,
    {rnd('late_payment_pct*100', 1)} AS late_pct, total_returns, return_rate
    FROM b_customer_360 WHERE account_health IS NOT NULL ORDER BY account_health, customer_id LIMIT 10"""

# -- e-commerce -----------------------------------------------------------------------
TARGET = "[0.85,0.90,0.95,1.00,1.05,1.10,0.90,0.88,1.05,1.15,1.38,0.95]::DOUBLE[]"
Q["ecommerce_kpis"] = f"""SELECT *, {pct('returns', 'orders')} AS return_rate_pct FROM (
    SELECT {msum('total_amount')} AS revenue, count(*) AS orders, {mavg('total_amount')} AS aov,
        {favg('discount_pct')}*100 AS avg_discount_pct FROM v_orders), (SELECT count(*) AS returns FROM v_returns)"""
Q["quarterly_revenue"] = f"""SELECT {year('order_date')} AS year, {qtr('order_date')} AS quarter,
    {msum('total_amount')} AS revenue, count(*) AS orders FROM v_orders GROUP BY 1,2"""
Q["quarterly_pivot"] = f"SELECT {year('order_date')} AS year," + ",".join(
    rnd(f"sum({fixed('total_amount')}) FILTER (WHERE quarter(order_date)={q})::DOUBLE/100000000", 0) + f" AS Q{q}"
    for q in (1, 2, 3, 4)
) + " FROM v_orders GROUP BY 1"
Q["seasonality_index"] = f"""SELECT month_num, avg_rev, total_orders,
    {rnd(rat('total_orders', 'avg(total_orders) OVER ()'), 2)} AS multiplier, ({TARGET})[month_num] AS target FROM (
    SELECT month(order_date)::INT AS month_num, {mavg('total_amount')} AS avg_rev, count(*) AS total_orders
    FROM v_orders GROUP BY 1)"""
LINES = "v_order_items i JOIN v_orders o ON i.order_id=o.order_id JOIN b_products p ON i.product_id=p.product_id"
Q["q2_category_yoy"] = f"""SELECT *,
    {change('revenue', 'lag(revenue) OVER (PARTITION BY category ORDER BY year)')} AS yoy_pct FROM (
    SELECT {year('o.order_date')} AS year, p.category, {msum('i.line_total')} AS revenue,
        count(DISTINCT i.order_id) AS orders, {mavg('i.unit_price')} AS avg_price
    FROM {LINES} WHERE month(o.order_date) BETWEEN 4 AND 6 GROUP BY 1,2)"""
Q["category_monthly"] = f"""SELECT {month('o.order_date')} AS month, p.category, {msum('i.line_total')} AS revenue
    FROM {LINES} GROUP BY 1,2"""
T["x_mix"] = f"""SELECT p.category, p.subcategory, {msum('i.line_total')} AS revenue, sum(i.quantity)::BIGINT AS units,
    count(DISTINCT i.order_id) AS orders, {mavg('i.unit_price')} AS avg_price
    FROM v_order_items i JOIN b_products p ON i.product_id=p.product_id GROUP BY 1,2"""
Q["product_mix"] = "SELECT * FROM x_mix"
Q["top_subcategories"] = "SELECT category, subcategory, revenue FROM x_mix ORDER BY revenue DESC, category, subcategory LIMIT 20"
Q["category_summary"] = f"""SELECT *, {pct('revenue', share('OVER ()'))} AS share_pct FROM (
    SELECT category, {msum('revenue')} AS revenue, sum(orders)::BIGINT AS orders, {rnd('avg(avg_price)', 4)} AS avg_price
    FROM x_mix GROUP BY 1)"""
_BP = fixed("discount_pct", 4)
Q["discount_by_segment"] = f"""SELECT segment, count(discount_pct) AS orders,
    sum({_BP})::DOUBLE/10000/count(discount_pct)*100 AS mean_pct, """ + ",".join(
    rnd(f"quantile_cont({_BP}::DOUBLE,{p})/10000", 6) + f" AS {n}"
    for p, n in ((0, "minimum"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "maximum"))
) + " FROM v_orders JOIN v_customers USING (customer_id) WHERE discount_pct IS NOT NULL GROUP BY 1"
_RM = f"(SELECT {month('return_date')} AS month, count(*) AS returns, {msum('refund_amount')} AS refund_total FROM v_returns GROUP BY 1)"
_OM = f"(SELECT {month('order_date')} AS month, count(*) AS orders FROM v_orders GROUP BY 1)"
Q["monthly_return_rate"] = f"SELECT month, returns, refund_total, orders, {pct('returns', 'orders')} AS return_rate FROM {_RM} LEFT JOIN {_OM} USING (month)"
Q["monthly_return_rate_inner"] = f"SELECT month, returns, refund_total, orders, {rnd(pct('returns', 'orders'), 2)} AS return_rate FROM {_RM} JOIN {_OM} USING (month)"
Q["return_reasons"] = f"""SELECT reason, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM v_returns)')} AS share_pct
    FROM v_returns GROUP BY 1"""
Q["returns_by_category"] = f"""SELECT p.category, count(*) AS returns, {msum('r.refund_amount')} AS refund_total
    FROM v_returns r JOIN v_orders o ON r.order_id=o.order_id JOIN v_order_items i ON o.order_id=i.order_id
    JOIN b_products p ON i.product_id=p.product_id GROUP BY 1"""

# -- subscriptions --------------------------------------------------------------------
Q["saas_kpis"] = f"""SELECT *, {pct('active', 'subscribers')} AS active_pct, {pct('churned', 'subscribers')} AS churned_pct
    FROM (SELECT count(*) AS subscribers, count(*) FILTER (WHERE status='active') AS active,
        count(*) FILTER (WHERE status='churned') AS churned,
        {msum("CASE WHEN status='active' THEN mrr END")} AS active_mrr,
        {iavg("CASE WHEN status='active' THEN usage_score END")} AS avg_usage_score FROM v_saas_customers)"""
Q["saas_status_churn"] = f"""SELECT status, count(*) AS n, (SELECT {pct("count(*) FILTER (WHERE status='churned')", 'count(*)')}
    FROM v_saas_customers) AS lifetime_churn_pct FROM v_saas_customers GROUP BY 1"""
T["x_plan"] = f"""SELECT plan_tier, status, count(*) AS customers, {mavg('mrr')} AS avg_mrr,
    {iavg('usage_score')} AS avg_usage, {iavg('contract_months')} AS avg_contract FROM v_saas_customers GROUP BY 1,2"""
Q["plan_status_metrics"] = "SELECT * FROM x_plan"
Q["plan_mean_of_means"] = f"SELECT plan_tier, {rnd('avg(avg_mrr)', 4)} AS avg_mrr, {rnd('avg(avg_usage)', 4)} AS avg_usage FROM x_plan GROUP BY 1"
Q["mrr_total"] = f"SELECT {msum('mrr')} AS active_mrr, {msum('mrr')}*12 AS annualized FROM v_saas_customers WHERE status='active'"
Q["mrr_movement_totals"] = f"""SELECT {yq('movement_date')} AS quarter, movement_type, {msum('amount')} AS total,
    count(*) AS movements FROM b_mrr_movements GROUP BY 1,2"""
Q["mrr_waterfall"] = f"""SELECT quarter, n::DOUBLE/100 AS new, e::DOUBLE/100 AS expansion, -abs(c)::DOUBLE/100 AS contraction,
    -abs(l)::DOUBLE/100 AS churn, (n+e-abs(c)-abs(l))::DOUBLE/100 AS net FROM (SELECT {yq('movement_date')} AS quarter, """ + ",".join(
    f"coalesce(sum({fixed('amount')}) FILTER (WHERE movement_type='{t}'),0) AS {a}"
    for t, a in (("new", "n"), ("expansion", "e"), ("contraction", "c"), ("churn", "l"))
) + " FROM b_mrr_movements GROUP BY 1)"
Q["churn_monthly"] = f"""SELECT {month('movement_date')} AS month, count(*) AS churns, {msum('abs(amount)')} AS lost_mrr
    FROM b_mrr_movements WHERE movement_type='churn' GROUP BY 1"""
T["x_tenure"] = """SELECT trunc((movement_date-signup_date)::DOUBLE/30)::INT AS months_active, count(*) AS churns
    FROM b_mrr_movements JOIN b_saas_customers USING (saas_customer_id) WHERE movement_type='churn' GROUP BY 1
    HAVING months_active BETWEEN 1 AND 36"""
Q["churn_tenure"] = "SELECT * FROM x_tenure"
Q["churn_cliff_share"] = f"""SELECT a AS cliff_12, b AS cliff_24, t AS total_churn, {pct('a', 't')} AS cliff_12_pct,
    {pct('b', 't')} AS cliff_24_pct FROM (SELECT
    coalesce(sum(churns) FILTER (WHERE months_active BETWEEN 9 AND 14),0)::BIGINT AS a,
    coalesce(sum(churns) FILTER (WHERE months_active BETWEEN 21 AND 26),0)::BIGINT AS b, sum(churns)::BIGINT AS t FROM x_tenure)"""
Q["tickets_monthly_priority"] = f"SELECT {month('created_date')} AS month, priority, count(*) AS tickets FROM v_support_tickets GROUP BY 1,2"
Q["ticket_resolution"] = f"""SELECT category, priority, count(*) AS tickets, {iavg('resolution_hours')} AS avg_hours,
    count(CASE WHEN resolved_date IS NULL THEN 1 END) AS unresolved FROM b_support_tickets GROUP BY 1,2"""
Q["ticket_categories"] = f"SELECT category, count(*) AS tickets, {rnd(iavg('resolution_hours'), 1)} AS avg_hours FROM v_support_tickets GROUP BY 1"
Q["unresolved_rate"] = f"""SELECT count(*) AS tickets, count(*) FILTER (WHERE resolved_date IS NULL) AS unresolved,
    {pct('count(*) FILTER (WHERE resolved_date IS NULL)', 'count(*)')} AS unresolved_pct FROM b_support_tickets"""


def hist(source: str, column: str, bins: int, by: str) -> str:
    return f"""SELECT {by}, least(coalesce(floor(({column}-lo)/nullif((hi-lo)/{bins},0)),0),{bins - 1})::BIGINT AS bin,
        count(*) AS n FROM {source}, (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source})
        WHERE {column} IS NOT NULL GROUP BY 1,2"""


Q["usage_score_hist"] = f"""SELECT status, bin, n, mean_score FROM ({hist('v_saas_customers', 'usage_score', 40, 'status')})
    JOIN (SELECT status, {iavg('usage_score')} AS mean_score FROM v_saas_customers GROUP BY 1) USING (status)"""

# -- product usage ----------------------------------------------------------------------
Q["product_kpis"] = f"""SELECT count(*) AS events, count(DISTINCT user_id) AS users,
    count(DISTINCT saas_customer_id) AS accounts, count(DISTINCT feature_module) AS modules,
    (SELECT count(*) FROM b_usage_events WHERE feature_module={FOCUS}) AS focus_events FROM v_usage_events"""
for _name, _period, _expr in (("engagement_monthly", "month", month("event_date")), ("engagement_daily", "day", "event_date::DATE")):
    Q[_name] = f"""SELECT {_expr} AS {_period}, count(*) AS events, count(DISTINCT user_id) AS active_users,
        count(DISTINCT saas_customer_id) AS active_accounts, count(DISTINCT session_id) AS sessions,
        {iavg('duration_seconds')}/60.0 AS avg_session_min FROM v_usage_events GROUP BY 1"""
T["x_users"] = "SELECT user_id, count(*) AS events, count(DISTINCT session_id) AS sessions FROM v_usage_events GROUP BY 1"
T["x_pareto"] = f"""SELECT user_id, events, sessions, row_number() OVER w AS rank,
    {pct('sum(events) OVER (w ROWS UNBOUNDED PRECEDING)', 'sum(events) OVER ()')} AS cumulative_pct,
    {pct('row_number() OVER w', 'count(*) OVER ()')} AS user_rank_pct
    FROM x_users WINDOW w AS (ORDER BY events DESC, user_id)"""
Q["pareto_users"] = "SELECT * FROM x_pareto"
Q["pareto_sample"] = """SELECT rank, user_rank_pct, cumulative_pct FROM x_pareto
    WHERE (rank-1)%(SELECT greatest(1, count(*)//200) FROM x_users)=0"""


def top20(source: str) -> str:
    return f"""SELECT max(k)::BIGINT AS top_users, sum(events) FILTER (WHERE rn<=k)::BIGINT AS top_events,
        sum(events)::BIGINT AS all_events, {pct('coalesce(sum(events) FILTER (WHERE rn<=k),0)', 'sum(events)')} AS top_share_pct
        FROM (SELECT events, row_number() OVER (ORDER BY events DESC, user_id) AS rn,
            floor(count(*) OVER ()*0.2::DOUBLE) AS k
            FROM (SELECT user_id, count(*) AS events FROM {source} GROUP BY 1))"""


Q["top20_share"] = top20("v_usage_events")
Q["user_event_stats"] = f"""SELECT count(*) AS n_users, {iavg('events')} AS mean_events, max(events) AS max_events,
    quantile_cont(events::DOUBLE,0.5) AS median_events FROM x_users"""
Q["adoption_depth"] = f"""SELECT feature_module, adoption_depth, count(*) AS accounts, {iavg('total_events')} AS avg_events,
    {iavg('monthly_active_users')} AS avg_mau, CASE adoption_depth WHEN 'none' THEN 1 WHEN 'light' THEN 2
        WHEN 'moderate' THEN 3 ELSE 4 END AS depth_order FROM v_feature_adoption GROUP BY 1,2"""
Q["event_types"] = "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS unique_users FROM v_usage_events GROUP BY 1"
T["x_ramp"] = f"""SELECT {month('event_date')} AS month, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
    count(DISTINCT saas_customer_id) AS accounts FROM b_usage_events WHERE feature_module={FOCUS} GROUP BY 1,2"""
Q["feature_launch_ramp"] = "SELECT * FROM x_ramp"
Q["feature_launch_rollup"] = """SELECT month, sum(events)::BIGINT AS events, sum(users)::BIGINT AS users,
    arg_min(accounts, event_type) AS accounts FROM x_ramp GROUP BY 1"""
Q["module_penetration"] = f"""SELECT adopted, active, {pct('adopted', 'active')} AS penetration_pct FROM (
    SELECT (SELECT count(DISTINCT saas_customer_id) FROM b_feature_adoption WHERE feature_module={FOCUS}) AS adopted,
    (SELECT count(*) FROM b_saas_customers WHERE status='active') AS active)"""
Q["adopters_vs_rest"] = f"""SELECT CASE WHEN fa.saas_customer_id IS NOT NULL THEN 'Adopter' ELSE 'Non-Adopter' END AS grp,
    {iavg('sc.usage_score')} AS avg_usage_score, count(*) AS customers, {mavg('sc.mrr')} AS avg_mrr
    FROM b_saas_customers sc LEFT JOIN (SELECT DISTINCT saas_customer_id FROM b_feature_adoption
        WHERE feature_module={FOCUS}) fa ON sc.saas_customer_id=fa.saas_customer_id
    WHERE sc.status='active' GROUP BY 1"""

# -- payments -----------------------------------------------------------------------------
DAYS, LATE = iavg("days_to_pay"), rnd(iavg("is_late") + "*100", 1)
Q["payments_kpis"] = f"""SELECT count(*) AS payments, {msum('amount')} AS collected, {DAYS} AS avg_days,
    {iavg('is_late')}*100 AS late_pct, (SELECT count(*) FROM v_invoices) AS invoices FROM v_payments"""
Q["dtp_monthly"] = f"""SELECT {month('payment_date')} AS month, {DAYS} AS avg_days, {LATE} AS late_pct,
    count(*) AS payments, {msum('amount')} AS total_collected FROM v_payments GROUP BY 1"""
Q["dtp_hist"] = """SELECT bin, n, CASE bin WHEN floor(30/1.2::DOUBLE) THEN 'Net 30' WHEN floor(45/1.2::DOUBLE) THEN 'Net 45'
    WHEN floor(60/1.2::DOUBLE) THEN 'Net 60' END AS term_marker FROM (
    SELECT floor(days_to_pay/1.2::DOUBLE)::BIGINT AS bin, count(*) AS n FROM v_payments
    WHERE days_to_pay>0 AND days_to_pay<120 GROUP BY 1)"""
PAID = "v_payments p JOIN b_invoices i ON p.invoice_id=i.invoice_id JOIN v_customers c ON i.customer_id=c.customer_id"
T["x_period"] = f"""SELECT CASE WHEN year(payment_date)=1998 AND month(payment_date) BETWEEN 7 AND 9 THEN 'Q3 1998'
    ELSE 'Other Periods' END AS period, c.region, {DAYS} AS avg_days, {LATE} AS late_pct, count(*) AS payments
    FROM {PAID} GROUP BY 1,2"""
Q["period_region_compare"] = "SELECT * FROM x_period"
Q["period_region_delta"] = f"""SELECT a.region, a.avg_days AS period_days, b.avg_days AS baseline_days,
    {rnd('a.avg_days-b.avg_days', 4)} AS delta_days FROM x_period a JOIN x_period b
    ON a.region=b.region AND a.period='Q3 1998' AND b.period='Other Periods'"""
Q["segment_method_dtp"] = f"""SELECT segment, method, {DAYS} AS avg_days, {LATE} AS late_pct, count(*) AS payments
    FROM {PAID} GROUP BY 1,2"""
Q["segment_vs_terms"] = f"""WITH_TABLES SELECT segment, 'avg_days' AS type, {rnd(DAYS, 1)} AS days FROM {PAID} GROUP BY 1
    UNION ALL SELECT DISTINCT segment, 'terms', CASE segment WHEN 'enterprise' THEN 60 WHEN 'mid_market' THEN 45 ELSE 30 END::DOUBLE
    FROM {PAID}""".replace("WITH_TABLES ", "")
Q["method_mix"] = f"""SELECT year, method, payments, volume, {rat('sum(d) OVER (PARTITION BY method)',
    'sum(payments) OVER (PARTITION BY method)')} AS avg_days FROM (SELECT {year('payment_date')} AS year, method,
    count(*) AS payments, {msum('amount')} AS volume, sum(days_to_pay) AS d FROM v_payments GROUP BY 1,2)"""
Q["quarterly_ar"] = f"SELECT {yq('payment_date')} AS quarter, {DAYS} AS avg_days, {LATE} AS late_pct FROM v_payments GROUP BY 1"
Q["invoice_status_year"] = f"SELECT status, {year('invoice_date')} AS year, count(*) AS n FROM v_invoices GROUP BY 1,2"
Q["orphan_payments"] = """SELECT count(*) AS orphan_payments FROM d_payments p LEFT JOIN d_invoices i
    ON p.invoice_id=i.invoice_id WHERE i.invoice_id IS NULL"""

# -- CRM ----------------------------------------------------------------------------------
Q["crm_kpis"] = f"""SELECT (SELECT count(*) FROM b_accounts) AS accounts, (SELECT {iavg('health_score')} FROM b_accounts) AS avg_health,
    (SELECT count(*) FROM v_opportunities) AS opps, (SELECT count(*) FROM v_opportunities WHERE {OPEN}) AS open_opps,
    (SELECT {msum('amount')} FROM v_opportunities WHERE {OPEN}) AS pipeline,
    (SELECT count(*) FROM v_activities) AS activities"""
Q["pipeline_funnel"] = f"""SELECT *, {pct('deals', 'first(deals) OVER (ORDER BY avg_prob, stage)')} AS pct_of_first FROM (
    SELECT stage, count(*) AS deals, {msum('amount')} AS total_value, {mavg('amount')} AS avg_deal,
        {iavg('probability')} AS avg_prob FROM v_opportunities GROUP BY 1)"""
Q["pipeline_by_stage"] = f"SELECT product_interest, stage, count(*) AS deals, {msum('amount')} AS total_value FROM v_opportunities GROUP BY 1,2"
Q["pipeline_by_product"] = f"""SELECT product_interest, 'open_val' AS type, {msum(f'CASE WHEN {OPEN} THEN amount ELSE 0 END')} AS amount
    FROM v_opportunities GROUP BY 1 UNION ALL
    SELECT product_interest, 'won_val', {msum("CASE WHEN stage='closed_won' THEN amount ELSE 0 END")} FROM v_opportunities GROUP BY 1"""
Q["health_hist"] = hist("b_accounts", "health_score", 30, "account_tier")
Q["tier_summary"] = f"""SELECT account_tier, count(*) AS accounts, {iavg('health_score')} AS avg_health,
    {pct('count(*)', '(SELECT count(*) FROM b_accounts)')} AS share_pct FROM b_accounts GROUP BY 1"""
Q["activity_monthly"] = f"SELECT {month('activity_date')} AS month, activity_type, count(*) AS activities FROM v_activities GROUP BY 1,2"
Q["activity_outcomes"] = f"""SELECT activity_type, outcome, count(*) AS n, (SELECT {pct("count(*) FILTER (WHERE b.outcome='positive')", 'count(*)')}
    FROM v_activities b WHERE b.activity_type=a.activity_type) AS positive_pct FROM v_activities a GROUP BY 1,2"""
Q["rep_leaderboard"] = f"""SELECT a2.owner AS rep, count(act.activity_id) AS activities,
    count(DISTINCT act.account_id) AS accounts_touched, count(*) FILTER (WHERE act.outcome='positive') AS positive,
    {rnd(pct("count(*) FILTER (WHERE act.outcome='positive')", 'count(*)'), 1)} AS win_rate
    FROM v_activities act JOIN b_accounts a2 ON act.account_id=a2.account_id GROUP BY 1"""
T["x_touched"] = """SELECT a.account_id, a.health_score, a.account_tier, count(act.activity_id) AS activities,
    max(act.activity_date) AS last_activity FROM b_accounts a LEFT JOIN v_activities act ON a.account_id=act.account_id
    GROUP BY 1,2,3"""
Q["health_vs_activity"] = "SELECT * FROM x_touched"
Q["activity_by_tier"] = f"SELECT account_tier, {iavg('activities')} AS avg_activities FROM x_touched GROUP BY 1"
Q["null_notes_rate"] = f"""SELECT count(*) AS activities, count(*) FILTER (WHERE notes IS NULL) AS null_notes,
    {pct('count(*) FILTER (WHERE notes IS NULL)', 'count(*)')} AS null_pct FROM d_activities"""

# -- calibration ----------------------------------------------------------------------------
NOTHING = "NULL::DOUBLE AS target, NULL::BOOLEAN AS ok"
_TABLES = (
    "customers", "products", "orders", "order_items", "returns", "saas_customers", "mrr_movements", "support_tickets",
    "saas_users", "usage_events", "feature_adoption", "invoices", "payments", "accounts", "activities",
    "opportunities", "customer_xref", "customer_360",
)
Q["val_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS metric, count(*)::DOUBLE AS actual, {NOTHING} FROM d_{t}" for t in _TABLES
)
DONE = "b_orders WHERE status='completed'"
Q["val_month_multiplier"] = f"""SELECT metric, actual, target, abs(actual-target)<0.15::DOUBLE AS ok FROM (
    SELECT 'month_'||lpad(m::VARCHAR,2,'0') AS metric, {rat('c', 'sum(c) OVER ()::DOUBLE/count(*) OVER ()')} AS actual,
        ({TARGET})[m] AS target
    FROM (SELECT month(order_date) AS m, sum({fixed('total_amount')}) AS c FROM {DONE} GROUP BY 1))"""
Q["val_yoy"] = f"""SELECT metric, actual, 8.0::DOUBLE AS target, abs(actual-8.0::DOUBLE)<5 AS ok FROM (
    SELECT 'yoy_'||y AS metric, {change('c', 'lag(c) OVER (ORDER BY y)')} AS actual
    FROM (SELECT year(order_date) AS y, sum({fixed('total_amount')})::BIGINT AS c FROM {DONE} GROUP BY 1)) WHERE actual IS NOT NULL"""
Q["val_january_returns"] = f"""SELECT 'january_spike_pct' AS metric, actual, 17.0::DOUBLE AS target, abs(actual-17)<5 AS ok FROM (
    SELECT {change('jr::DOUBLE/greatest(jo,1)', '(ar::DOUBLE/ao)')} AS actual FROM (SELECT
    (SELECT count(*) FROM {DONE} AND month(order_date)=1) AS jo, (SELECT count(*) FROM {DONE}) AS ao,
    (SELECT count(*) FROM b_returns r JOIN b_orders o USING (order_id) WHERE month(order_date)=1) AS jr,
    (SELECT count(*) FROM b_returns) AS ar))"""
Q["val_monthly_churn"] = f"""SELECT 'monthly_churn_pct' AS metric, actual, 2.5::DOUBLE AS target, abs(actual-2.5)<1 AS ok FROM (
    SELECT {pct("count(*) FILTER (WHERE status='churned')", 'count(*)*18')} AS actual
    FROM b_saas_customers WHERE plan_tier<>'free')"""
Q["val_nrr"] = f"""SELECT 'nrr_pct' AS metric, actual, 104.0::DOUBLE AS target, abs(actual-104)<5 AS ok FROM (
    SELECT {pct('s+e-c-l', 's')} AS actual FROM (SELECT
    (SELECT coalesce(sum({fixed('new_mrr')}),0) FROM b_mrr_movements WHERE movement_type='new' AND movement_date<DATE '1999-01-01') AS s,
    """ + ",".join(
    f"""(SELECT coalesce(sum(abs({fixed('amount')})),0) FROM b_mrr_movements WHERE movement_type='{t}'
        AND movement_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31') AS {a}"""
    for t, a in (("expansion", "e"), ("contraction", "c"), ("churn", "l"))
) + "))"
PAID_ORDERS = "b_payments JOIN b_invoices USING (invoice_id) JOIN b_orders o USING (order_id)"
T["x_delay"] = f"""SELECT (SELECT {DAYS} FROM {PAID_ORDERS} WHERE region='Europe' AND year(order_date)=1998 AND quarter(order_date)=3) AS a,
    (SELECT {DAYS} FROM {PAID_ORDERS} WHERE region='Europe' AND NOT (year(order_date)=1998 AND quarter(order_date)=3)) AS b"""
Q["val_region_delay"] = f"""SELECT 'period_days' AS metric, a AS actual, {NOTHING} FROM x_delay UNION ALL
    SELECT 'baseline_days', b, NULL, NULL FROM x_delay UNION ALL SELECT 'delta_days', {rnd('a-b', 4)}, NULL, NULL FROM x_delay"""
Q["val_quarter_dip"] = f"""SELECT 'q2_vs_q1_revenue_pct' AS metric, {change('b', 'a')} AS actual, {NOTHING} FROM (
    SELECT coalesce(sum({fixed('total_amount')}) FILTER (WHERE quarter(order_date)=1),0) AS a,
        coalesce(sum({fixed('total_amount')}) FILTER (WHERE quarter(order_date)=2),0) AS b FROM {DONE} AND year(order_date)=1999)
    UNION ALL SELECT 'q2_days_to_pay', {DAYS}, NULL, NULL FROM {PAID_ORDERS} WHERE year(order_date)=1999 AND quarter(order_date)=2
    UNION ALL SELECT 'q2_days_to_pay_last_year', {DAYS}, NULL, NULL FROM {PAID_ORDERS}
        WHERE year(order_date)=1998 AND quarter(order_date)=2"""
T["x_use"] = f"""SELECT count(*) AS e, count(DISTINCT saas_customer_id) AS a,
    (SELECT count(*) FROM b_saas_customers WHERE status='active') AS t FROM b_usage_events WHERE feature_module={FOCUS}"""
Q["val_module_use"] = f"""SELECT 'module_events' AS metric, e::DOUBLE AS actual, {NOTHING} FROM x_use UNION ALL
    SELECT 'module_accounts', a, NULL, NULL FROM x_use UNION ALL
    SELECT 'module_pct_of_active', {pct('a', 'greatest(t,1)')}, NULL, NULL FROM x_use"""
Q["val_user_concentration"] = f"""SELECT 'top20_share_pct' AS metric, top_share_pct AS actual, 60.0::DOUBLE AS target,
    top_share_pct>=60 AS ok FROM ({top20('b_usage_events')})"""

# -- reports over degraded tables ------------------------------------------------------


for _name in (
    "exec_kpis", "monthly_revenue", "yoy_performance", "region_share", "region_year_share", "customer_mix",
    "status_by_segment", "acquisition_monthly", "ecommerce_kpis", "quarterly_revenue", "q2_category_yoy",
    "category_monthly", "product_mix", "top_subcategories", "category_summary", "discount_by_segment",
    "monthly_return_rate", "return_reasons", "returns_by_category", "payments_kpis", "dtp_monthly", "dtp_hist",
    "segment_method_dtp", "segment_vs_terms", "method_mix", "quarterly_ar", "saas_kpis", "saas_status_churn",
    "plan_status_metrics", "mrr_total", "mrr_movement_totals", "mrr_waterfall", "churn_monthly", "churn_tenure",
    "churn_cliff_share", "tickets_monthly_priority", "ticket_resolution", "ticket_categories", "unresolved_rate",
    "usage_score_hist", "product_kpis", "user_event_stats", "adoption_depth", "event_types", "feature_launch_ramp",
    "feature_launch_rollup", "module_penetration", "adopters_vs_rest", "crm_kpis", "pipeline_funnel", "pipeline_by_stage",
    "pipeline_by_product", "health_hist", "tier_summary", "activity_monthly", "activity_outcomes", "rep_leaderboard",
    "health_vs_activity", "activity_by_tier",
):
    Q[f"{_name}_governed"] = over_degraded(Q[_name])

ORACLE: dict[str, str] = {key: with_tables(body, T) for key, body in Q.items()}
