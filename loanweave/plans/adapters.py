"""The loan panel's two tables and a scored table, derived from the star-schema tables.

``customer`` stands for originations and ``orders``, summed per customer and month, for the
monthly performance panel, so both grow with the data.  The derived columns contain
sentinels, out-of-range numbers, unmapped codes, NULLs and NaNs on purpose.

The column expressions are plain SQL that Spark and DuckDB read alike; the aggregation and
window steps around them are written per engine (`Tables` here, the ``*_SQL`` texts for
DuckDB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanweave.columns import AMOUNTS, KEY, TIME
from loanweave.functions.history import History
from loanweave.session import without_huge_methods


def _loan_id(customer: str) -> str:
    return (
        f"concat('F', lpad(cast((99 + {customer} % 14) % 100 as string), 2, '0'), 'Q', "
        f"cast(1 + {customer} % 4 as string), lpad(cast({customer} as string), 7, '0'))"
    )


#: Texts that both engines read, and shorter ones of the same value for Spark.  A method of generated
#: code beyond 8,000 bytes is never compiled by the JVM, and a long list of cases makes such methods.
SHORTER: dict[str, str] = {}


def _pick(number: str, *values: str) -> str:
    """One of the values, by remainder."""
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    text = f"case {number} % {len(values)} {arms} end"
    SHORTER[text] = f"get(array({', '.join(values)}), cast({number} % {len(values)} as int))"
    return text


_CK = "c_custkey"
_YEAR = f"(1999 + {_CK} % 14)"
ORIGINATION_EXPRESSIONS = {
    "CREDIT_SCORE": f"cast(case when {_CK} % 41 = 0 then 9999 else 300 + ({_CK} * 37) % 650 end as int)",
    "FIRST_PAYMENT_DATE": f"case {_CK} % 13 when 0 then '1999' when 1 then null else concat(cast({_YEAR} as string), lpad(cast(1 + {_CK} % 12 as string), 2, '0')) end",
    "FIRST_TIME_HOMEBUYER_FLAG": _pick(_CK, "'Y'", "'9'", "null", "'N'", "'N'"),
    "MATURITY_DATE": f"case when {_CK} % 17 = 0 then '20301' else concat(cast({_YEAR} + 30 as string), lpad(cast(1 + {_CK} % 15 as string), 2, '0')) end",
    "MSA": f"case {_CK} % 6 when 0 then null when 1 then 'N/A' else lpad(cast(({_CK} * 7) % 50000 as string), 5, '0') end",
    "MI_PERCENTAGE": f"cast(case when {_CK} % 6 = 0 then 999 else ({_CK} * 7) % 130 end as int)",
    "NUMBER_OF_UNITS": f"cast(case when {_CK} % 10 = 0 then 9 else {_CK} % 7 end as int)",
    "OCCUPANCY_STATUS": _pick(_CK, "'P'", "'S'", "'I'", "'9'", "null"),
    "ORIGINAL_CLTV": f"cast(({_CK} * 17) % 260 as int)",
    "ORIGINAL_DTI": f"cast(({_CK} * 11) % 80 as int)",
    "ORIGINAL_UPB": f"cast(100000 + ({_CK} * 777) % 400000 as int)",
    "ORIGINAL_LTV": f"cast(({_CK} * 13) % 1000 as int)",
    "ORIGINAL_INTEREST_RATE": f"cast(case when {_CK} % 47 = 0 then 45 else 3 + ({_CK} % 40) / 10.0 end as double)",
    "CHANNEL": _pick(_CK, "'R'", "'B'", "'C'", "'T'", "'9'", "null"),
    "PPM_FLAG": _pick(_CK, "'Y'", "'N'", "null"),
    "AMORTIZATION_TYPE": _pick(_CK, "'FRM'", "'ARM'", "'IO'", "'9'"),
    "PROPERTY_STATE": "case c_nationkey % 4 when 0 then 'CA' when 1 then 'NY' when 2 then 'TX' else 'ZZ' end",
    "PROPERTY_TYPE": _pick(_CK, "'SF'", "'CONDO'", "'COOP'", "'PUD'", "'MH'", "'CO'", "'9'"),
    "POSTAL_CODE": f"case when {_CK} % 23 = 0 then '123' else lpad(cast({_CK} * 31 % 100000 as string), 5, '0') end",
    KEY: _loan_id(_CK),
    "LOAN_PURPOSE": _pick(_CK, "'P'", "'R'", "'C'", "'N'", "'9'"),
    "ORIGINAL_LOAN_TERM": f"cast({_pick(_CK, '360', '180', '30', '240')} as int)",
    "NUMBER_OF_BORROWERS": f"cast(case when {_CK} % 11 = 0 then 99 else {_CK} % 12 end as int)",
    "SELLER_NAME": "c_mktsegment",
    "SERVICER_NAME": "c_name",
    "SUPER_CONFORMING_FLAG": _pick(_CK, "'Y'", "' '", "null"),
    "PRE_RELIEF_REFINANCE_LSN": f"case when {_CK} % 7 = 0 then {_loan_id(f'({_CK} + 1)')} end",
    "SPECIAL_ELIGIBILITY_PROGRAM": _pick(_CK, "'H'", "'F'", "'R'", "' '", "null"),
    "RELIEF_REFINANCE_INDICATOR": _pick(_CK, "'Y'", "' '", "null", "'N'", "'N'", "'N'", "'N'"),
    "PROPERTY_VALUATION_METHOD": f"cast({_CK} % 4 as int)",
    "IO_INDICATOR": _pick(_CK, "'Y'", "'N'", "'9'", "null"),
    "MI_CANCELLATION_INDICATOR": _pick(f"({_CK} + 1)", "'Y'", "'N'", "'9'", "'7'"),
    "vintage_year": f"cast({_YEAR} as int)",
}


def _amount(i: int) -> str:
    """An amount that is sometimes NULL and sometimes NaN, by the order key."""
    return (
        f"cast(case when k % {7 + i} = 0 then null when k % {11 + i} = 0 "
        f"then cast('NaN' as double) else (k * {i + 3} % 10007) / 4.0 end as double)"
    )


PERFORMANCE_EXPRESSIONS = {
    KEY: KEY,
    TIME: "period",
    **{n: _amount(i) for i, n in enumerate(AMOUNTS)},
    "CURRENT_ACTUAL_UPB": "upb",
    "CURRENT_LOAN_DELINQUENCY_STATUS": "case when k % 12 <> 0 then '0' when k % 13 = 0 then 'RA' else cast(k % 11 as string) end",
    "LOAN_AGE": "cast(case when k % 23 = 0 then null when k % 29 = 0 then -1 else rn end as int)",
    "REMAINING_MONTHS_TO_LEGAL_MATURITY": "cast(case when k % 37 = 0 then -5 else 360 - rn end as int)",
    "DEFECT_SETTLEMENT_DATE": "case k % 31 when 0 then '2005' when 1 then period when 2 then '20051X' end",
    "MODIFICATION_FLAG": "case when k % 17 = 0 then 'Y' when k % 17 = 1 then 'P' end",
    "ZERO_BALANCE_CODE": "case when is_last = 1 and customer % 5 = 0 then '01' end",
    "ZERO_BALANCE_EFFECTIVE_DATE": "case when is_last = 1 and customer % 5 = 0 then case when k % 2 = 0 then period else '0' end end",
    "CURRENT_INTEREST_RATE": "cast(case when k % 43 = 0 then 99 else 3 + (k % 40) / 10.0 end as double)",
    "DDLPI": "case k % 9 when 0 then null when 1 then 'X' else period end",
    "INTEREST_RATE_STEP_INDICATOR": "case k % 4 when 0 then 'Y' when 1 then 'N' when 2 then 'Q' end",
    "PAYMENT_DEFERRAL_FLAG": "case when k % 19 = 0 then 'Y' when k % 19 = 1 then 'P' end",
    "ELTV": "cast(case when k % 4 = 0 then null else 40 + k % 60 end as double)",
    "DELINQUENCY_DUE_TO_DISASTER": "case k % 8 when 0 then 'Y' when 1 then 'N' end",
    "BORROWER_ASSISTANCE_STATUS_CODE": "case k % 10 when 0 then 'T' when 1 then 'F' when 2 then 'R' when 3 then '7' end",
    "reporting_year": "substring(period, 1, 4)",
}

#: The same numbers for Spark without its slow decimals: quarters and tenths of whole numbers, each
#: the double next to the exact quotient.
DOUBLES = {
    **{n: PERFORMANCE_EXPRESSIONS[n].replace("/ 4.0", "/ 4D") for n in AMOUNTS if n in PERFORMANCE_EXPRESSIONS},
    "CURRENT_INTEREST_RATE": "cast(case when k % 43 = 0 then 99 else (30 + k % 40) / 10D end as double)",
    "ORIGINAL_INTEREST_RATE": f"cast(case when {_CK} % 47 = 0 then 45 else (30 + {_CK} % 40) / 10D end as double)",
}

SCORE_EXPRESSION = "round(1 / (1 + exp(-(value - 50) / 20)), 6)"
# Heavily tied scores with unequal rates, three rival "models" over the same labels.
TIED_SCORE_EXPRESSION = "round(l_discount * 10, 6)"


def spark_listing(expressions: dict[str, str]) -> list[str]:
    """The expressions as Spark computes them."""
    listed = []
    for name, text in (expressions | {n: e for n, e in DOUBLES.items() if n in expressions}).items():
        for long, short in SHORTER.items():
            text = text.replace(long, short)
        listed.append(f"{text} as {name}")
    return listed


def _listing(expressions: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} as {n}" for n, e in expressions.items())


LOANS_SQL = f"loans as (select\n  {_listing(ORIGINATION_EXPRESSIONS)}\nfrom customer)"
PANEL_SQL = f"""months as (
  select {_loan_id('o_custkey')} as {KEY}, o_custkey as customer,
         strftime(o_orderdate, '%Y%m') as period,
         min(o_orderkey) as k, round(sum(o_totalprice), 2) as upb
  from orders group by all),
numbered as (
  select *, row_number() over (partition by {KEY} order by period) as rn,
         case when lead(period) over (partition by {KEY} order by period) is null then 1 else 0 end as is_last
  from months),
panel as (select
  {_listing(PERFORMANCE_EXPRESSIONS)}
from numbered)"""
SCORED_SQL = f"""scored as (
  select event_id as id, case when event_type = 'purchase' then 1 else 0 end as y_true,
         {SCORE_EXPRESSION} as y_proba, user_id
  from events)"""
TIED_SQL = f"""tied as (
  select l_orderkey * 10 + l_linenumber as id, case when l_returnflag = 'R' then 1 else 0 end as y_true,
         {TIED_SCORE_EXPRESSION} as y_proba
  from lineitem)"""


class Tables:
    """The star-schema tables of one directory, as the shapes the operators expect."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = without_huge_methods(spark), directory

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def loans(self) -> DataFrame:
        return self.read("customer").selectExpr(*spark_listing(ORIGINATION_EXPRESSIONS))

    def panel(self) -> DataFrame:
        """One row per loan and month: summing first bounds a loan by its months."""
        months = (
            self.read("orders")
            .select(
                F.expr(_loan_id("o_custkey")).alias(KEY),
                F.col("o_custkey").alias("customer"),
                F.date_format("o_orderdate", "yyyyMM").alias("period"),
                "o_orderkey",
                "o_totalprice",
            )
            .groupBy(KEY, "customer", "period")
            .agg(
                F.min("o_orderkey").alias("k"),
                F.round(F.sum("o_totalprice"), 2).alias("upb"),
            )
        )
        w = Window.partitionBy(KEY).orderBy("period")
        numbered = months.select(
            "*",
            F.row_number().over(w).alias("rn"),
            F.lead("period").over(w).isNull().cast("int").alias("is_last"),
        )
        return numbered.selectExpr(*spark_listing(PERFORMANCE_EXPRESSIONS))

    def scored(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y_true"),
            F.expr(SCORE_EXPRESSION).alias("y_proba"),
            "user_id",
        )

    def tied(self) -> DataFrame:
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y_true"),
            F.expr(TIED_SCORE_EXPRESSION).alias("y_proba"),
        )

    def clean(self) -> tuple[DataFrame, DataFrame]:
        from loanweave.operators.cleaning import clean_both

        return clean_both(self.loans(), self.panel())

    def joined(self) -> DataFrame:
        from loanweave.operators.features import join_static

        loans, panel = self.clean()
        return join_static(panel, loans)

    def features(self) -> DataFrame:
        from loanweave.operators.features import history_features

        return history_features(self.joined(), History())

    def labelled(self, **options) -> DataFrame:
        """The cleaned, joined panel with its look-ahead target."""
        from loanweave.operators.target import create_target

        return create_target(self.joined(), **options)
