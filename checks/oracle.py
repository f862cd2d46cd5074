"""The same queries in plain SQL, written directly: distinct counts, IN lists and row numbers where
the library uses rollups, joins and minimums."""

from __future__ import annotations

from checks.registry import FILTERS, KPI_FILTERS, REPORT_FILTERS, SERIES_FILTERS, STORED_FILTERS
from ledgermill.plans.filters import MetricFilter

_ID = "lpad({0}::VARCHAR, greatest(6, length({0}::VARCHAR))::INT, '0')"

#: Derived tables; each may use the ones before it.
_TABLES = {
    "crm": f"""
        SELECT 'CUST-' || {_ID.format("c_custkey")} AS customer_id, c_name AS company_name,
            c_mktsegment AS industry, n_name AS city,
            ['Starter', 'Growth', 'Enterprise'][c_custkey % 3 + 1] AS plan,
            ['closed_won', 'Won', 'QUALIFIED', NULL, 'proposal', 'Demo', 'Lead', 'Closed Lost',
             'Closed Won', 'Proposal', 'closed_lost', 'Qualified'][c_custkey % 12 + 1]
                AS pipeline_stage,
            CASE WHEN c_custkey % 97 = 0 THEN strftime(signup, '%Y.%m.%d')
                 WHEN c_custkey % 9 = 0 THEN strftime(signup, '%d/%m/%Y')
                 ELSE strftime(signup, '%Y-%m-%d') END AS signup_date,
            'AM-' || (c_custkey % 5 + 1) AS account_manager
        FROM (SELECT *, DATE '2024-01-01' + (c_custkey % 366)::INT AS signup FROM customer)
        JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey % 10 <> 9""",
    "billing": f"""
        SELECT 'TX-' || l_orderkey || '-' || l_linenumber AS transaction_id,
            'C' || {_ID.format("o_custkey")} AS customer_id,
            l_extendedprice::DECIMAL(12, 2) AS amount, l_shipdate::DATE AS transaction_date,
            CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'paid' END AS status,
            ['Starter', 'Growth', 'Enterprise'][o_orderkey % 3 + 1] AS plan
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "churn": f"""
        SELECT 'CUST-' || {_ID.format("c_custkey")} AS customer_id,
            strftime(DATE '1998-01-01' + (c_custkey % 900)::INT, '%Y-%m-%d') AS churn_date,
            ['Budget cuts', 'No longer needed', 'Poor support', 'Price',
             'Switched to competitor'][c_custkey % 5 + 1] AS churn_reason
        FROM customer WHERE c_custkey % 6 = 0""",
    "bronze_crm": """
        SELECT * REPLACE (coalesce(try_strptime(signup_date, '%Y-%m-%d'),
            try_strptime(signup_date, '%d/%m/%Y'))::DATE AS signup_date)
        FROM crm""",
    "bronze_churn": "SELECT * REPLACE (churn_date::DATE AS churn_date) FROM churn",
    "silver_customers": """
        SELECT b.customer_id, company_name, industry, city, coalesce(c.plan, b.plan) AS plan,
            signup_date, account_manager,
            CASE WHEN c.customer_id IS NULL THEN NULL
                 WHEN pipeline_stage IS NULL THEN 'Lead'
                 WHEN lower(pipeline_stage) IN ('won', 'closed_won') THEN 'Closed Won'
                 WHEN lower(pipeline_stage) = 'closed_lost' THEN 'Closed Lost'
                 WHEN lower(pipeline_stage) = 'lead' THEN 'Lead'
                 WHEN lower(pipeline_stage) = 'demo' THEN 'Demo'
                 WHEN lower(pipeline_stage) = 'qualified' THEN 'Qualified'
                 WHEN lower(pipeline_stage) = 'proposal' THEN 'Proposal'
                 ELSE pipeline_stage END AS pipeline_stage,
            c.customer_id IS NULL AS billing_only_flag
        FROM (SELECT DISTINCT regexp_replace(customer_id, '^C', 'CUST-') AS customer_id, plan
              FROM billing) b
        LEFT JOIN bronze_crm c ON b.customer_id = c.customer_id""",
    "silver_transactions": """
        SELECT transaction_id, regexp_replace(customer_id, '^C', 'CUST-') AS customer_id, amount,
            transaction_date, status, plan
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
                  ORDER BY transaction_date NULLS FIRST, status, amount, customer_id, plan) AS rn
              FROM billing)
        WHERE rn = 1 AND status = 'paid'""",
}


def _sql(body: str) -> str:
    """``body`` with the derived tables it needs, and those they need."""
    wanted, text = [], body
    for name, table in reversed(_TABLES.items()):
        if f" {name}" in text.replace("\n", " "):
            wanted.append(f"{name} AS ({table})")
            text += table
    return f"WITH {', '.join(reversed(wanted))} {body}" if wanted else body


def _in_list(column: str, values: tuple[str, ...] | None) -> str:
    if values is None:
        return f"{column} IS NOT NULL"
    if not values:
        return "FALSE"
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _tx(f: MetricFilter) -> str:
    """Filtered transactions."""
    where = [_in_list("plan", f.plans)]
    if f.mode == "raw" and f.plans is None:
        where.append("plan IN (SELECT plan FROM silver_transactions)")
    if f.start_date:
        where.append(f"transaction_date >= DATE '{f.start_date}'")
    if f.end_date:
        where.append(f"transaction_date <= DATE '{f.end_date}'")
    if f.mode == "clean":
        if f.industries == ():
            where.append("FALSE")
        where.append(
            "customer_id IN (SELECT customer_id FROM silver_customers"
            f" WHERE {_in_list('industry', f.industries)} OR billing_only_flag)"
        )
    if f.status == "active":
        where.append("customer_id NOT IN (SELECT customer_id FROM churn)")
    elif f.status == "churned":
        where.append("customer_id IN (SELECT customer_id FROM churn)")
    table = "silver_transactions" if f.mode == "clean" else "billing"
    return f"(SELECT * FROM {table} WHERE {' AND '.join(where)})"


def _kpi(f: MetricFilter) -> str:
    return f"""
        SELECT revenue AS total_revenue, active AS active_customers, customers AS unique_customers,
            churned AS churned_customers, n AS n_transactions,
            CASE WHEN customers > 0 THEN round_even(churned / customers * 100.0, 1) ELSE 0.0 END
                ::DOUBLE AS churn_rate
        FROM (SELECT coalesce(sum(amount), 0)::DOUBLE AS revenue,
                  count(DISTINCT customer_id) AS customers,
                  count(DISTINCT customer_id) FILTER (NOT gone) AS active,
                  count(DISTINCT customer_id) FILTER (gone) AS churned, count(*) AS n
              FROM (SELECT *, customer_id IN (SELECT customer_id FROM churn) AS gone
                    FROM {_tx(f)}))"""


def _monthly_revenue(f: MetricFilter) -> str:
    return f"""
        SELECT strftime(transaction_date, '%Y-%m') AS month, sum(amount)::DOUBLE AS revenue
        FROM {_tx(f)} GROUP BY ALL ORDER BY month"""


def _revenue_by_plan(f: MetricFilter) -> str:
    return f"""
        SELECT plan, sum(amount)::DOUBLE AS revenue
        FROM {_tx(f)} GROUP BY ALL ORDER BY revenue DESC, plan"""


def _new_customers(f: MetricFilter) -> str:
    return f"""
        SELECT strftime(first_date, '%Y-%m') AS month, count(*) AS new_customers
        FROM (SELECT customer_id, min(transaction_date) AS first_date
              FROM {_tx(f)} GROUP BY customer_id)
        GROUP BY ALL ORDER BY month"""


def _stage_distribution(f: MetricFilter) -> str:
    table, where = "crm", ""
    if f.mode == "clean":
        table = "silver_customers"
        where = f"AND customer_id IN (SELECT customer_id FROM {_tx(f)})"
    return f"""
        SELECT pipeline_stage AS stage, count(*) AS customers,
            count(*) / sum(count(*)) OVER () AS share
        FROM {table} WHERE pipeline_stage IS NOT NULL {where}
        GROUP BY ALL ORDER BY customers DESC, stage"""


def _report(f: MetricFilter) -> str:
    figures = ("total_revenue", "active_customers", "churn_rate")
    parts = [
        f"SELECT 'kpi' AS part, '{name}' AS label, {name}::DOUBLE AS value FROM ({_kpi(f)})"
        for name in figures
    ]
    for part, sql, label, value in (
        ("monthly_revenue", _monthly_revenue(f), "month", "revenue"),
        ("revenue_by_plan", _revenue_by_plan(f), "plan", "revenue"),
        ("stage_distribution", _stage_distribution(f), "stage", "customers"),
        ("new_customers", _new_customers(f), "month", "new_customers"),
    ):
        parts.append(f"SELECT '{part}', {label}, {value}::DOUBLE FROM ({sql})")
    return " UNION ALL ".join(parts)


def _value_counts(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM {table} GROUP BY {c}"
        for c in columns
    )


def _profile(table: str, **types: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {position} AS position, '{c}' AS column_name,"
        f" '{dtype}' AS data_type, count({c}) AS non_null FROM {table}"
        for position, (c, dtype) in enumerate(types.items(), start=1)
    )


_MONEY = "SELECT * REPLACE (amount::DOUBLE AS amount) FROM"
_COPIES = "(SELECT *, count(*) OVER (PARTITION BY transaction_id) AS n FROM billing)"
_LADDER = """
    SELECT (SELECT sum(amount) FROM billing) AS gross_amount,
        (SELECT sum(amount) FROM billing WHERE status = 'paid') AS paid_amount,
        (SELECT sum(amount) FROM silver_transactions) AS paid_amount_without_copies"""
_STANDARD = "('Lead', 'Qualified', 'Demo', 'Proposal', 'Closed Won', 'Closed Lost')"
_NOT_STANDARD = f"pipeline_stage NOT IN {_STANDARD}"
_NOT_ISO = "try_strptime(signup_date, '%Y-%m-%d') IS NULL"
_BAD_CRM_ID = r"NOT regexp_matches(customer_id, '^CUST-\d+$')"
_BAD_BILLING_ID = r"NOT regexp_matches(customer_id, '^C\d+$')"
_BILLING_ONLY = """
    SELECT replace(customer_id, 'C', 'CUST-') AS customer_id FROM billing
    EXCEPT SELECT customer_id FROM crm"""


def _checks(*checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, ({value})::BIGINT AS n FROM {table}"
        for name, value, table in checks
    )


_TABLE_SQL = {
    "crm_bronze": "SELECT * FROM bronze_crm",
    "billing_bronze": f"{_MONEY} billing",
    "churn_bronze": "SELECT * FROM bronze_churn",
    "load_report": """
        SELECT 'bronze_crm_customers' AS table_name, count(*) AS n_rows,
            count(*) - count(signup_date) AS null_signup_dates FROM bronze_crm
        UNION ALL SELECT 'bronze_billing_transactions', count(*), 0 FROM billing
        UNION ALL SELECT 'bronze_churn', count(*), 0 FROM bronze_churn""",
    "bronze_crm_validation": """
        SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS unique_customers,
            sum(CASE WHEN signup_date IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_dates,
            sum(CASE WHEN pipeline_stage IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_stages
        FROM bronze_crm""",
    "bronze_billing_validation": """
        SELECT count(*) AS total_rows, count(DISTINCT transaction_id) AS unique_transactions,
            count(DISTINCT customer_id) AS unique_customers,
            sum(amount)::DOUBLE AS gross_amount_incl_refunds
        FROM billing""",
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_transactions": f"{_MONEY} silver_transactions",
    "silver_churn": "SELECT * FROM bronze_churn",
    "flagged_customers": "SELECT * FROM silver_customers WHERE billing_only_flag",
    "billing_only_customers": _BILLING_ONLY,
    "dq_report": _checks(
        ("crm_rows", "count(*)", "crm"),
        ("crm_null_stages", "count(*) - count(pipeline_stage)", "crm"),
        ("crm_nonstandard_stages", f"count(*) FILTER ({_NOT_STANDARD})", "crm"),
        ("crm_nonstandard_dates", f"count(*) FILTER ({_NOT_ISO})", "crm"),
        (
            "crm_unparsed_dates",
            "count(signup_date) - count(coalesce(try_strptime(signup_date, '%Y-%m-%d'),"
            " try_strptime(signup_date, '%d/%m/%Y')))",
            "crm",
        ),
        ("crm_id_violations", f"count(*) FILTER ({_BAD_CRM_ID})", "crm"),
        ("crm_malformed_lines", "0 * count(*)", "crm"),
        ("billing_rows", "count(*)", "billing"),
        ("billing_id_violations", f"count(*) FILTER ({_BAD_BILLING_ID})", "billing"),
        ("billing_refund_rows", "count(*) FILTER (status = 'refunded')", "billing"),
        ("billing_duplicate_rows", "count(*) FILTER (n > 1)", _COPIES),
        ("billing_duplicated_ids", "count(DISTINCT transaction_id) FILTER (n > 1)", _COPIES),
        (
            "billing_bad_amounts",
            "count(amount) - count(try_cast(amount::VARCHAR AS DECIMAL(12, 2)))",
            "billing",
        ),
        (
            "billing_unparsed_dates",
            "count(transaction_date)"
            " - count(try_strptime(transaction_date::VARCHAR, '%Y-%m-%d'))",
            "billing",
        ),
        ("billing_malformed_lines", "0 * count(*)", "billing"),
        ("billing_only_customers", "count(*)", f"({_BILLING_ONLY})"),
        ("churn_rows", "count(*)", "churn"),
        (
            "churn_unparsed_dates",
            "count(churn_date) - count(try_strptime(churn_date, '%Y-%m-%d'))",
            "churn",
        ),
        ("churn_id_violations", f"count(*) FILTER ({_BAD_CRM_ID})", "churn"),
        ("churn_malformed_lines", "0 * count(*)", "churn"),
    ),
    "table_shapes": """
        SELECT 'crm' AS table_name, count(*) AS n_rows, 8::BIGINT AS n_columns FROM crm
        UNION ALL SELECT 'billing', count(*), 6 FROM billing
        UNION ALL SELECT 'churn', count(*), 3 FROM churn""",
    "column_profile": " UNION ALL ".join(
        (
            _profile(
                "crm",
                customer_id="string",
                company_name="string",
                industry="string",
                city="string",
                plan="string",
                pipeline_stage="string",
                signup_date="string",
                account_manager="string",
            ),
            _profile(
                "billing",
                transaction_id="string",
                customer_id="string",
                amount="string",
                transaction_date="string",
                status="string",
                plan="string",
            ),
            _profile("churn", customer_id="string", churn_date="string", churn_reason="string"),
        )
    ),
    "crm_value_counts": _value_counts("crm", ("industry", "plan", "pipeline_stage")),
    "billing_value_counts": _value_counts("billing", ("status", "plan")),
    "null_stage_rows": "SELECT * FROM crm WHERE pipeline_stage IS NULL",
    "nonstandard_stages": f"""
        SELECT pipeline_stage, count(*) AS n FROM crm WHERE {_NOT_STANDARD}
        GROUP BY ALL ORDER BY n DESC, pipeline_stage""",
    "nonstandard_dates": f"SELECT customer_id, signup_date FROM crm WHERE {_NOT_ISO}",
    "id_format_violations": f"""
        SELECT 'crm' AS table_name, count(*) FILTER ({_BAD_CRM_ID}) AS violations FROM crm
        UNION ALL SELECT 'billing', count(*) FILTER ({_BAD_BILLING_ID}) FROM billing
        UNION ALL SELECT 'churn', count(*) FILTER ({_BAD_CRM_ID}) FROM churn""",
    "duplicate_transactions": f"{_MONEY} (SELECT * EXCLUDE n FROM {_COPIES} WHERE n > 1)",
    "duplicate_transactions_top10": f"""
        {_MONEY} (SELECT * EXCLUDE n FROM {_COPIES} WHERE n > 1
        ORDER BY transaction_id, transaction_date, status, amount, customer_id, plan LIMIT 10)""",
    "duplicate_summary": f"""
        SELECT count(*) AS rows_involved, count(DISTINCT transaction_id) AS duplicated_ids
        FROM {_COPIES} WHERE n > 1""",
    "refund_summary": """
        SELECT count(*) AS refund_rows, sum(amount)::DOUBLE AS refund_amount,
            '$' || format('{:,.2f}', sum(amount)::DOUBLE) AS refund_label
        FROM billing WHERE status = 'refunded'""",
    "revenue_ladder": f"SELECT COLUMNS(*)::DOUBLE FROM ({_LADDER})",
    "revenue_ladder_labels": f"""
        SELECT '$' || format('{{:,.2f}}', gross_amount::DOUBLE) AS gross_amount,
            '$' || format('{{:,.2f}}', paid_amount::DOUBLE) AS paid_amount,
            '$' || format('{{:,.2f}}', paid_amount_without_copies::DOUBLE)
                AS paid_amount_without_copies
        FROM ({_LADDER})""",
    "churn_reason_counts": """
        SELECT churn_reason, count(*) AS n FROM churn GROUP BY ALL ORDER BY n DESC, churn_reason""",
    "sample_rows": "SELECT * FROM crm ORDER BY customer_id LIMIT 10",
    "sample_billing": f"{_MONEY} (SELECT * FROM billing ORDER BY ALL LIMIT 10)",
    "sample_churn": "SELECT * FROM churn ORDER BY customer_id LIMIT 10",
    "sample_refunds": f"""
        {_MONEY} (SELECT * FROM billing WHERE status = 'refunded' ORDER BY ALL LIMIT 5)""",
    "kpi_labels": f"""
        SELECT '$' || format('{{:,.0f}}', total_revenue) AS total_revenue,
            format('{{:,}}', active_customers) AS active_customers,
            churn_rate::VARCHAR || '%' AS churn_rate
        FROM ({_kpi(FILTERS["clean"])})""",
    "filter_options": """
        SELECT DISTINCT 'plan' AS field, plan AS value FROM silver_transactions
        UNION ALL SELECT DISTINCT 'industry', industry FROM silver_customers
            WHERE industry IS NOT NULL
        UNION ALL SELECT 'date_min', min(transaction_date)::VARCHAR FROM silver_transactions
        UNION ALL SELECT 'date_max', max(transaction_date)::VARCHAR FROM silver_transactions
        ORDER BY field, value""",
}


def _report_sql() -> dict[str, str]:
    found = {f"kpi_{name}": _kpi(FILTERS[name]) for name in KPI_FILTERS}
    for name in SERIES_FILTERS:
        f = FILTERS[name]
        found[f"monthly_revenue_{name}"] = _monthly_revenue(f)
        found[f"revenue_by_plan_{name}"] = _revenue_by_plan(f)
        found[f"new_customers_{name}"] = _new_customers(f)
        found[f"stage_distribution_{name}"] = _stage_distribution(f)
    for name in STORED_FILTERS:
        found[f"stored_stage_distribution_{name}"] = _stage_distribution(FILTERS[name])
    for name in REPORT_FILTERS:
        found[f"report_{name}"] = _report(FILTERS[name])
    return found


def oracle_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in {**_TABLE_SQL, **_report_sql()}.items()}
