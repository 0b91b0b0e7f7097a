"""Column-profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave import columns as c
from loanweave.columns import KEY
from loanweave.operators import profile
from loanweave.plans.adapters import ORIGINATION_EXPRESSIONS
from loanweave.plans.catalog_cleaning import LOANS_CLEAN_SQL
from loanweave.plans.catalog_metrics import rounded
from loanweave.plans.catalog_models import FRAME_COLUMNS, FRAME_CTES, FRAME_SQL, dataset_frame
from loanweave.plans.registry import query

COLUMNS = list(ORIGINATION_EXPRESSIONS)
TEXT = {
    "FIRST_PAYMENT_DATE", "MATURITY_DATE", "MSA", "POSTAL_CODE", KEY, "SELLER_NAME", "SERVICER_NAME",
    "PRE_RELIEF_REFINANCE_LSN",
}
DOUBLES = {"ORIGINAL_UPB", "ORIGINAL_INTEREST_RATE"}


def _dtype(name: str) -> str:
    return "string" if name in TEXT else "double" if name in DOUBLES else "int"


def _flag(condition: bool) -> str:
    return "true" if condition else "false"


def _one(name: str) -> str:
    return (
        f"select '{name}' as \"column\", '{_dtype(name)}' as dtype, {_flag(name in TEXT)} as is_object_dtype, "
        f"count(distinct {name}) as cardinality, (count(*) - count({name})) / cast(count(*) as double) as null_rate, "
        f"{'false' if name in TEXT else f'coalesce(min({name}) = max({name}), false)'} as is_constant_numeric, "
        f"(select max(n) from (select count(*) as n from loans_clean group by {name})) / cast(count(*) as double) as top_share, "
        f"{_flag(name in c.CATEGORICAL_FEATURES)} as in_config_categorical_features, "
        f"{_flag(name in c.DROP_FEATURES)} as in_config_drop_features from loans_clean"
    )


PROFILE_SQL = (
    f"{LOANS_CLEAN_SQL}, stats as ({' union all '.join(_one(n) for n in COLUMNS)}),\n"
    "profile as (select * exclude (top_share), case when cardinality <= 50 then top_share end as dominant_value_share, "
    "cardinality <= 50 and top_share > 0.995 as is_near_constant, is_object_dtype or cardinality < 20 as flagged_by_heuristic, "
    "is_object_dtype and cardinality > 100 as is_high_cardinality_object from stats)"
)


def profile_query(name: str, sql: str):
    return query(name, sql, uses="loans", ctes=PROFILE_SQL)


def _loans(t):
    return t.clean()[0]


def _profile(t):
    return profile.column_profile(_loans(t), exact=True)


@query("agg_07_row_count", "select count(*) as rows from panel", uses="panel")
def _(t):
    return t.panel().agg(F.count("*").alias("rows"))


@profile_query("agg_08_cardinality", 'select "column", cardinality from profile')
def _(t):
    return profile.exact_statistics(_loans(t)).select("column", "cardinality")


@query("agg_08_approx_cardinality")
def _(t):
    df = t.panel()
    return profile.tall_statistics(profile.wide_statistics(df), df.columns)


@profile_query("agg_09_null_rate", 'select "column", round(null_rate, 6) as null_rate from profile')
def _(t):
    df = _loans(t)
    tall = profile.tall_statistics(profile.wide_statistics(df), df.columns)
    return rounded(tall.select("column", "null_rate"), "null_rate")


@profile_query("agg_10_constant_columns", 'select "column", is_constant_numeric from profile')
def _(t):
    df = _loans(t)
    return profile.tall_statistics(profile.wide_statistics(df), df.columns).select(
        "column", "is_constant_numeric"
    )


@profile_query(
    "agg_11_dominant_share",
    'select "column", round(dominant_value_share, 6) as dominant_value_share from profile where cardinality <= 50',
)
def _(t):
    low = profile.exact_statistics(_loans(t)).filter(F.col("cardinality") <= 50)
    return rounded(low.select("column", "dominant_value_share"), "dominant_value_share")


@profile_query(
    "agg_11_dominant_any_cardinality",
    'select "column", round(top_share, 6) as dominant_value_share from stats',
)
def _(t):
    return rounded(profile.dominant_shares(_loans(t)), "dominant_value_share")


@profile_query("agg_12_near_constant", 'select "column" from stats where top_share > 0.995')
def _(t):
    return profile.near_constant(profile.dominant_shares(_loans(t))).select("column")


@profile_query(
    "agg_13_high_cardinality_text", 'select "column", cardinality from profile where is_high_cardinality_object'
)
def _(t):
    return profile.high_cardinality_text(_profile(t)).select("column", "cardinality")


_NUMBERS = [n for n in COLUMNS if n not in TEXT]


@profile_query(
    "agg_14_review_values",
    "select v.* from (" + " union all ".join(
        f"select '{n}' as \"column\", array_to_string(list_slice(list_sort(list(distinct round(cast({n} as double), 3))), 1, 15), ',') as sample "
        f"from loans_clean where {n} is not null"
        for n in _NUMBERS
    ) + ') v join profile using ("column") where not is_object_dtype and cardinality between 1 and 20',
)
def _(t):
    df = _loans(t)
    names = [r["column"] for r in profile.review_candidates(_profile(t)).collect()]
    text = F.transform("values", lambda v: F.round(v, 3).cast("string"))
    return profile.sample_values(df, names).select("column", F.array_join(text, ",").alias("sample")).filter("sample <> ''")


@profile_query(
    "agg_14_review_candidates",
    'select "column", cardinality from profile where not is_object_dtype and cardinality <= 20',
)
def _(t):
    return profile.review_candidates(_profile(t)).select("column", "cardinality")


@profile_query(
    "ord_04_profile_order",
    'select "column", cardinality, row_number() over (order by is_object_dtype desc, cardinality, "column") as position from profile',
)
def _(t):
    # The sorted table numbered in its own order: one row per column.
    from pyspark.sql import Window

    order = Window.partitionBy(F.lit(0)).orderBy(
        F.col("is_object_dtype").desc(), "cardinality", "column"
    )
    ordered = profile.sorted_profile(_profile(t))
    return ordered.select("column", "cardinality", F.row_number().over(order).cast("bigint").alias("position"))


@profile_query(
    "jn_06_profile_assembly",
    'select "column", cardinality, round(null_rate, 6) as null_rate, round(dominant_value_share, 6) as dominant_value_share from profile',
)
def _(t):
    statistics = profile.exact_statistics(_loans(t))
    low = statistics.filter(F.col("cardinality") <= 50).select("column", "dominant_value_share")
    joined = statistics.drop("dominant_value_share").join(low, "column", "full")
    return rounded(joined, "null_rate", "dominant_value_share")


_PROFILE_COLUMNS = (
    '"column", dtype, is_object_dtype, cardinality, round(null_rate, 6) as null_rate, is_constant_numeric, '
    "round(dominant_value_share, 6) as dominant_value_share, is_near_constant, in_config_categorical_features, "
    "flagged_by_heuristic, is_high_cardinality_object, in_config_drop_features"
)


@profile_query("ml_23_column_profile", f"select {_PROFILE_COLUMNS} from profile")
def _(t):
    return rounded(_profile(t), "null_rate", "dominant_value_share")


@profile_query(
    "ml_24_categorical_difference",
    "select \"column\", case when flagged_by_heuristic then 'heuristic' else 'config' end as only_in from profile "
    "where flagged_by_heuristic <> in_config_categorical_features",
)
def _(t):
    return profile.categorical_difference(_profile(t))


@profile_query(
    "set_03_symmetric_difference",
    'select "column" from ((select "column" from profile where flagged_by_heuristic except select "column" from profile where in_config_categorical_features) '
    'union all (select "column" from profile where in_config_categorical_features except select "column" from profile where flagged_by_heuristic))',
)
def _(t):
    return profile.categorical_difference(_profile(t)).select("column")


@profile_query(
    "prj_08_column_roles",
    "select \"column\", case when in_config_drop_features or is_constant_numeric or is_near_constant or is_high_cardinality_object then 'excluded' "
    "when is_object_dtype or in_config_categorical_features then 'categorical' else 'numeric' end as role from profile",
)
def _(t):
    return profile.column_roles(_profile(t))


@profile_query(
    "ml_01_inferred_categoricals", 'select "column" from profile where is_object_dtype or cardinality < 20'
)
def _(t):
    names = profile.inferred_categoricals(_loans(t))
    return _names(t, names)


@profile_query(
    "ml_02_inferred_categoricals_strict",
    'select "column" from profile where is_object_dtype or (cardinality > 1 and cardinality < 20)',
)
def _(t):
    return _names(t, profile.inferred_categoricals(_loans(t), min_values=2))


def _names(t, names):
    return t.spark.createDataFrame([(n,) for n in names], "column string")


@profile_query("ml_06_drop_constants", 'select "column" from profile where is_object_dtype or cardinality > 1')
def _(t):
    return _names(t, profile.drop_constant_columns(_loans(t)).columns)


_FLAGS = ["is_constant_numeric", "is_near_constant", "flagged_by_heuristic", "is_high_cardinality_object"]


@profile_query(
    "ml_23_default_profile",
    f'select "column", dtype, round(null_rate, 6) as null_rate, round(dominant_value_share, 6) as dominant_value_share, {", ".join(_FLAGS)} from profile',
)
def _(t):
    """The default path, with sketches; flags and shares do not depend on their error."""
    df = profile.column_profile(_loans(t))
    return rounded(df.select("column", "dtype", "null_rate", "dominant_value_share", *_FLAGS), "null_rate", "dominant_value_share")


def _frame_column(name: str) -> str:
    return (
        f"select '{name}' as \"column\", count(distinct {name}) as cardinality, "
        f"round((count(*) - count({name})) / cast(count(*) as double), 6) as null_rate, "
        f"round((select max(n) from (select count(*) as n from frame group by {name})) / cast(count(*) as double), 6) as dominant_value_share from frame"
    )


@query(
    "ml_23_dataset_profile",
    " union all ".join(_frame_column(n) for n in FRAME_COLUMNS),
    uses="loans panel",
    ctes=f"{FRAME_CTES}, frame as ({FRAME_SQL})",
)
def _(t):
    return rounded(profile.exact_statistics(dataset_frame(t)), "null_rate", "dominant_value_share")


@query(
    "agg_11_dataset_dominant_share",
    f"select \"column\", dominant_value_share from ({' union all '.join(_frame_column(n) for n in FRAME_COLUMNS)})",
    uses="loans panel",
    ctes=f"{FRAME_CTES}, frame as ({FRAME_SQL})",
)
def _(t):
    shares = profile.exact_statistics(dataset_frame(t)).select("column", "dominant_value_share")
    return rounded(shares, "dominant_value_share")
