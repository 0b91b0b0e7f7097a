"""Sources, cleaning and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave import columns as c
from loanweave.columns import KEY, TIME
from loanweave.functions import expressions as x
from loanweave.operators import cleaning, quality
from loanweave.plans.registry import query
from loanweave.sources import ingest

# ---------------------------------------------------------------- SQL fragments


def _sql_codes(column: str, codes: dict) -> str:
    arms = " ".join(f"when '{k}' then {v}" for k, v in codes.items())
    return f"cast(case {column} {arms} end as integer)"


def _sql_range(column: str, low, high) -> str:
    return f"case when {column} >= {low} and {column} <= {high} then {column} end"


def _sql_period(column: str) -> str:
    return f"case when length({column}) = 6 then {column} end"


_LTV = (
    "case when coalesce(RELIEF_REFINANCE_INDICATOR, '') = 'Y' "
    "then case when ORIGINAL_LTV between 1 and 998 then ORIGINAL_LTV end "
    "when ORIGINAL_LTV between 6 and 105 then ORIGINAL_LTV end"
)
_POSTAL = (
    "case when length(POSTAL_CODE) >= 5 then substr(POSTAL_CODE, 1, 3) || '00' else POSTAL_CODE end"
)
_AGE = (
    f"cast(coalesce(case when LOAN_AGE >= 0 then LOAN_AGE end, "
    f"(cast(substr({TIME}, 1, 4) as integer) - 1999) * 12 + cast(substr({TIME}, 5, 2) as integer)) as integer)"
)

LOANS_CLEAN_RULES = {
    **{n: _sql_range(n, *r) for n, r in c.ORIGINATION_RANGES.items()},
    **{n: _sql_period(n) for n in c.ORIGINATION_PERIODS},
    **{n: _sql_codes(n, d) for n, d in c.ORIGINATION_CODES.items()},
    "ORIGINAL_UPB": "round(ORIGINAL_UPB / 1000.0) * 1000.0",
    "ORIGINAL_LTV": _LTV,
    "POSTAL_CODE": _POSTAL,
}
PANEL_CLEAN_RULES = {
    **{n: _sql_range(n, *r) for n, r in c.PERFORMANCE_RANGES.items()},
    **{n: _sql_period(n) for n in c.PERFORMANCE_PERIODS},
    **{n: _sql_codes(n, d) for n, d in c.PERFORMANCE_CODES.items()},
    **{n: f"case when {n} >= 0 then {n} end" for n in c.NON_NEGATIVE},
    **{n: f"case when not isnan({n}) then {n} end" for n in c.AMOUNTS},
    "LOAN_AGE": _AGE,
}


def _replace(rules: dict[str, str], table: str) -> str:
    listing = ",\n  ".join(f"({e}) as {n}" for n, e in rules.items())
    return f"select * replace (\n  {listing})\nfrom {table}"


LOANS_CLEAN_SQL = f"loans_clean as ({_replace(LOANS_CLEAN_RULES, 'loans')})"
PANEL_CLEAN_SQL = f"panel_clean as ({_replace(PANEL_CLEAN_RULES, 'panel')})"


def _columns(rules, names) -> str:
    return ", ".join(f"({rules[n]}) as {n}" for n in names)


# ---------------------------------------------------------------- sources


@query(
    "src_04_vintage_lineage",
    f"select {KEY}, vintage_year from loans",
    uses="loans",
)
def _(t):
    return ingest.add_lineage(t.loans().drop("vintage_year"), x.vintage_of(KEY)).select(KEY, "vintage_year")


@query(
    "src_05_reporting_year",
    f"select {KEY}, {TIME}, substr({TIME}, 1, 4) as reporting_year from panel",
    uses="panel",
)
def _(t):
    return ingest.add_reporting_year(t.panel().drop("reporting_year")).select(KEY, TIME, "reporting_year")


@query(
    "src_06_record_counts",
    "select vintage_year, count(*) as records from loans group by rollup (vintage_year)",
    uses="loans",
)
def _(t):
    return ingest.record_counts(t.loans())


# ---------------------------------------------------------------- cleaning


@query(
    "cln_01_valid_ranges",
    f"select {KEY}, {_columns(LOANS_CLEAN_RULES, c.ORIGINATION_RANGES)} from loans",
    uses="loans",
)
def _(t):
    return cleaning.clean_origination(t.loans()).select(KEY, *c.ORIGINATION_RANGES)


@query(
    "cln_01_current_rate_range",
    f"select {KEY}, {TIME}, {_columns(PANEL_CLEAN_RULES, c.PERFORMANCE_RANGES)} from panel",
    uses="panel",
)
def _(t):
    return cleaning.clean_performance(t.panel()).select(KEY, TIME, *c.PERFORMANCE_RANGES)


@query(
    "cln_02_non_negative",
    f"select {KEY}, {TIME}, case when LOAN_AGE >= 0 then LOAN_AGE end as LOAN_AGE, "
    "case when REMAINING_MONTHS_TO_LEGAL_MATURITY >= 0 then REMAINING_MONTHS_TO_LEGAL_MATURITY end "
    "as REMAINING_MONTHS_TO_LEGAL_MATURITY from panel",
    uses="panel",
)
def _(t):
    return cleaning.apply_rules(t.panel(), {n: x.null_below(n) for n in c.NON_NEGATIVE}).select(
        KEY, TIME, *c.NON_NEGATIVE
    )


@query(
    "cln_03_period_text",
    f"select {KEY}, {TIME}, {_columns(PANEL_CLEAN_RULES, c.PERFORMANCE_PERIODS)} from panel",
    uses="panel",
)
def _(t):
    return cleaning.clean_performance(t.panel()).select(KEY, TIME, *c.PERFORMANCE_PERIODS)


@query(
    "cln_03_period_text_strict",
    f"select {KEY}, "
    + ", ".join(
        f"case when regexp_matches({n}, '^[0-9]{{4}}(0[1-9]|1[0-2])$') then {n} end as {n}"
        for n in c.ORIGINATION_PERIODS
    )
    + " from loans",
    uses="loans",
)
def _(t):
    return cleaning.clean_origination(t.loans(), strict_periods=True).select(
        KEY, *c.ORIGINATION_PERIODS
    )


@query(
    "cln_04_encode_status",
    f"select {KEY}, {TIME}, {_columns(PANEL_CLEAN_RULES, ['CURRENT_LOAN_DELINQUENCY_STATUS'])} from panel",
    uses="panel",
)
def _(t):
    return cleaning.clean_performance(t.panel()).select(
        KEY, TIME, "CURRENT_LOAN_DELINQUENCY_STATUS"
    )


@query(
    "cln_04_encode_status_extended",
    f"select {KEY}, {TIME}, cast(case when CURRENT_LOAN_DELINQUENCY_STATUS = 'RA' then 999 "
    "else try_cast(CURRENT_LOAN_DELINQUENCY_STATUS as integer) end as integer) as status from panel",
    uses="panel",
)
def _(t):
    return t.panel().select(
        KEY, TIME,
        cleaning.delinquency_code("CURRENT_LOAN_DELINQUENCY_STATUS", extended=True).alias("status"),
    )


@query(
    "cln_05_origination_codes",
    f"select {KEY}, {_columns(LOANS_CLEAN_RULES, c.ORIGINATION_CODES)} from loans",
    uses="loans",
)
def _(t):
    return cleaning.clean_origination(t.loans()).select(KEY, *c.ORIGINATION_CODES)


@query(
    "cln_05_performance_codes",
    f"select {KEY}, {TIME}, {_columns(PANEL_CLEAN_RULES, c.PERFORMANCE_CODES)} from panel",
    uses="panel",
)
def _(t):
    return cleaning.clean_performance(t.panel()).select(KEY, TIME, *c.PERFORMANCE_CODES)


@query(
    "cln_06_round_upb",
    f"select {KEY}, {_columns(LOANS_CLEAN_RULES, ['ORIGINAL_UPB'])} from loans",
    uses="loans",
)
def _(t):
    return cleaning.clean_origination(t.loans()).select(KEY, "ORIGINAL_UPB")


@query(
    "cln_07_ltv_by_relief_flag", f"select {KEY}, {_LTV} as ORIGINAL_LTV from loans", uses="loans"
)
def _(t):
    return cleaning.clean_origination(t.loans()).select(KEY, "ORIGINAL_LTV")


@query(
    "cln_07_ltv_by_relief_flag_legacy",
    f"select {KEY}, case when RELIEF_REFINANCE_INDICATOR <> 'Y' and ORIGINAL_LTV between 6 and 105 then ORIGINAL_LTV "
    "when RELIEF_REFINANCE_INDICATOR = 'Y' and ORIGINAL_LTV between 1 and 998 then ORIGINAL_LTV end as ORIGINAL_LTV from loans",
    uses="loans",
)
def _(t):
    return cleaning.clean_origination(t.loans(), legacy=True).select(KEY, "ORIGINAL_LTV")


@query("cln_08_postal_mask", f"select {KEY}, {_POSTAL} as POSTAL_CODE from loans", uses="loans")
def _(t):
    return cleaning.clean_origination(t.loans()).select(KEY, "POSTAL_CODE")


@query(
    "cln_09_amounts",
    f"select {KEY}, {TIME}, {_columns(PANEL_CLEAN_RULES, c.AMOUNTS)} from panel",
    uses="panel",
)
def _(t):
    return cleaning.clean_performance(t.panel()).select(KEY, TIME, *c.AMOUNTS)


@query("cln_10_loan_age", f"select {KEY}, {TIME}, {_AGE} as LOAN_AGE from panel", uses="panel")
def _(t):
    return cleaning.clean_performance(t.panel()).select(KEY, TIME, "LOAN_AGE")


@query(
    "cln_10_loan_age_from_first_payment",
    f"""select {KEY}, {TIME}, cast(coalesce(case when LOAN_AGE >= 0 then LOAN_AGE end,
      cast(substr({TIME}, 1, 4) as integer) * 12 + cast(substr({TIME}, 5, 2) as integer)
      - cast(substr(fp, 1, 4) as integer) * 12 - cast(substr(fp, 5, 2) as integer)) as integer) as LOAN_AGE
    from panel join (select {KEY}, {_sql_period('FIRST_PAYMENT_DATE')} as fp from loans) using ({KEY})""",
    uses="loans panel",
)
def _(t):
    first = cleaning.clean_origination(t.loans()).select(KEY, "FIRST_PAYMENT_DATE")
    return t.panel().join(first, KEY).select(
        KEY, TIME, cleaning.imputed_loan_age("LOAN_AGE", TIME, "FIRST_PAYMENT_DATE").alias("LOAN_AGE")
    )


@query("cln_11_clean_loans", "select * from loans_clean", uses="loans", ctes=LOANS_CLEAN_SQL)
def _(t):
    return t.clean()[0]


@query("cln_11_clean_panel", "select * from panel_clean", uses="panel", ctes=PANEL_CLEAN_SQL)
def _(t):
    return t.clean()[1]


@query(
    "cln_11_table_counts",
    'select \'origination\' as "table", count(*) as rows from loans union all '
    "select 'performance', count(*) from panel",
    uses="loans panel",
)
def _(t):
    return cleaning.table_counts(*t.clean())


# ---------------------------------------------------------------- quality


def _violation_sql(column: str, table: str) -> str:
    listed = ", ".join(f"'{v}'" for v in c.VALID_CODES[column])
    return (
        f"select '{column}' as \"column\", count({column}) as checked, "
        f"cast(count_if({column} not in ({listed})) as bigint) as violations from {table}"
    )


@query(
    "dq_02_code_violations",
    " union all ".join(
        _violation_sql(n, "loans" if n == "PROPERTY_STATE" else "panel") for n in c.VALID_CODES
    ),
    uses="loans panel",
)
def _(t):
    return quality.code_violations(t.loans()).unionByName(quality.code_violations(t.panel()))


def _unmapped_sql(column: str) -> str:
    known = list(c.ORIGINATION_CODES[column]) + list(c.NOT_AVAILABLE_CODES.get(column, ()))
    listed = ", ".join(f"'{v}'" for v in known)
    return (
        f"select '{column}' as \"column\", {column} as value, count(*) as rows from loans "
        f"where {column} not in ({listed}) group by {column}"
    )


@query(
    "dq_04_unmapped_values",
    " union all ".join(_unmapped_sql(n) for n in c.ORIGINATION_CODES),
    uses="loans",
)
def _(t):
    return quality.unmapped_values(t.loans(), c.ORIGINATION_CODES)


@query(
    "dq_01_missing_vintages",
    "select cast(v as integer) as vintage_year from range(1995, 2021) r(v) "
    "where v not in (select vintage_year from loans)",
    uses="loans",
)
def _(t):
    return quality.missing_vintages(t.loans(), 1995, 2020)


# ---------------------------------------------------------------- projections and scalars


@query(
    "prj_01_drop_lineage",
    "select * exclude (vintage_year) from loans",
    uses="loans",
)
def _(t):
    return cleaning.drop_lineage(t.loans().withColumn("ingestion_timestamp", F.current_timestamp()))


@query(
    "prj_02_first_of_same_name",
    f"select {KEY}, {TIME}, CURRENT_ACTUAL_UPB, CREDIT_SCORE from panel join loans using ({KEY})",
    uses="loans panel",
)
def _(t):
    left = t.panel().select(KEY, TIME, "CURRENT_ACTUAL_UPB").alias("p")
    right = t.loans().select(KEY, "CREDIT_SCORE").alias("l")
    both = left.join(right, F.col(f"p.{KEY}") == F.col(f"l.{KEY}"))
    return cleaning.unique_columns(both)


@query(
    "prj_04_cast_text",
    f"select {KEY}, try_cast(MSA as double) as MSA, try_cast(POSTAL_CODE as double) as POSTAL_CODE from loans",
    uses="loans",
)
def _(t):
    return cleaning.cast_text_columns(t.loans().select(KEY, "MSA", "POSTAL_CODE"), keep=(KEY,))


@query(
    "fn_07_month_index",
    f"select {KEY}, {TIME}, cast(substr({TIME}, 1, 4) as integer) * 12 + cast(substr({TIME}, 5, 2) as integer) as month_index from panel",
    uses="panel",
)
def _(t):
    return t.panel().select(KEY, TIME, x.month_index(TIME).alias("month_index"))


@query(
    "fn_08_missing_text",
    f"select {KEY}, case when CHANNEL is null or CHANNEL in ('nan', 'None', '') then 'MISSING' else CHANNEL end as CHANNEL, "
    "case when MSA is null or MSA in ('nan', 'None', '') then 'MISSING' else MSA end as MSA from loans",
    uses="loans",
)
def _(t):
    return cleaning.apply_rules(
        t.loans().select(KEY, "CHANNEL", "MSA"), {n: x.missing_text(n) for n in ("CHANNEL", "MSA")}
    )


@query(
    "fn_09_numeric_coercion",
    f"select {KEY}, try_cast(MSA as double) as msa_number, try_cast(SELLER_NAME as double) as seller_number from loans",
    uses="loans",
)
def _(t):
    return t.loans().select(
        KEY,
        F.col("MSA").try_cast("double").alias("msa_number"),
        F.col("SELLER_NAME").try_cast("double").alias("seller_number"),
    )
