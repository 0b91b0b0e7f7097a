"""Column names, schemas, code dictionaries and column lists of the loan panel.

Everything in this module is a FIXED VALUE: the names, codes, ranges and lists
have to equal the published data layout for results to be comparable.
"""

from __future__ import annotations

KEY = "LOAN_SEQUENCE_NUMBER"
TIME = "MONTHLY_REPORTING_PERIOD"
TARGET = "target"

# The two pipe-delimited layouts, in file order.
ORIGINATION_DDL = """
    CREDIT_SCORE INT, FIRST_PAYMENT_DATE STRING, FIRST_TIME_HOMEBUYER_FLAG STRING,
    MATURITY_DATE STRING, MSA STRING, MI_PERCENTAGE INT, NUMBER_OF_UNITS INT,
    OCCUPANCY_STATUS STRING, ORIGINAL_CLTV INT, ORIGINAL_DTI INT, ORIGINAL_UPB INT,
    ORIGINAL_LTV INT, ORIGINAL_INTEREST_RATE DOUBLE, CHANNEL STRING, PPM_FLAG STRING,
    AMORTIZATION_TYPE STRING, PROPERTY_STATE STRING, PROPERTY_TYPE STRING,
    POSTAL_CODE STRING, LOAN_SEQUENCE_NUMBER STRING NOT NULL, LOAN_PURPOSE STRING,
    ORIGINAL_LOAN_TERM INT, NUMBER_OF_BORROWERS INT, SELLER_NAME STRING,
    SERVICER_NAME STRING, SUPER_CONFORMING_FLAG STRING, PRE_RELIEF_REFINANCE_LSN STRING,
    SPECIAL_ELIGIBILITY_PROGRAM STRING, RELIEF_REFINANCE_INDICATOR STRING,
    PROPERTY_VALUATION_METHOD INT, IO_INDICATOR STRING, MI_CANCELLATION_INDICATOR STRING
"""

PERFORMANCE_DDL = """
    LOAN_SEQUENCE_NUMBER STRING NOT NULL, MONTHLY_REPORTING_PERIOD STRING,
    CURRENT_ACTUAL_UPB DOUBLE, CURRENT_LOAN_DELINQUENCY_STATUS STRING, LOAN_AGE INT,
    REMAINING_MONTHS_TO_LEGAL_MATURITY INT, DEFECT_SETTLEMENT_DATE STRING,
    MODIFICATION_FLAG STRING, ZERO_BALANCE_CODE STRING, ZERO_BALANCE_EFFECTIVE_DATE STRING,
    CURRENT_INTEREST_RATE DOUBLE, CURRENT_NON_INTEREST_BEARING_UPB DOUBLE, DDLPI STRING,
    MI_RECOVERIES DOUBLE, NET_SALE_PROCEEDS DOUBLE, NON_MI_RECOVERIES DOUBLE,
    TOTAL_EXPENSES DOUBLE, LEGAL_COSTS DOUBLE, MAINTENANCE_AND_PRESERVATION_COSTS DOUBLE,
    TAXES_AND_INSURANCE DOUBLE, MISCELLANEOUS_EXPENSES DOUBLE, ACTUAL_LOSS_CALCULATION DOUBLE,
    CUMULATIVE_MODIFICATION_COST DOUBLE, INTEREST_RATE_STEP_INDICATOR STRING,
    PAYMENT_DEFERRAL_FLAG STRING, ELTV DOUBLE, ZERO_BALANCE_REMOVAL_UPB DOUBLE,
    DELINQUENT_ACCRUED_INTEREST DOUBLE, DELINQUENCY_DUE_TO_DISASTER STRING,
    BORROWER_ASSISTANCE_STATUS_CODE STRING, CURRENT_MONTH_MODIFICATION_COST DOUBLE,
    INTEREST_BEARING_UPB DOUBLE
"""

LINEAGE = ("vintage_year", "ingestion_timestamp")

# State codes are numbered 1..54 in this order.
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO "
    "MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY "
    "DC PR GU VI"
).split()

# Code dictionaries.  A code that is not listed becomes NULL.
ORIGINATION_CODES = {
    "FIRST_TIME_HOMEBUYER_FLAG": {"Y": 1, "N": 0},
    "OCCUPANCY_STATUS": {"P": 1, "S": 2, "I": 3},
    "CHANNEL": {"R": 1, "B": 2, "C": 3, "T": 4},
    "PPM_FLAG": {"Y": 1, "N": 0},
    "AMORTIZATION_TYPE": {"FRM": 1, "ARM": 2, "IO": 3},
    "PROPERTY_STATE": {state: number for number, state in enumerate(STATES, 1)},
    "PROPERTY_TYPE": {"SF": 1, "CONDO": 2, "COOP": 3, "PUD": 4, "MH": 5},
    "LOAN_PURPOSE": {"P": 1, "R": 2, "C": 3},
    "SUPER_CONFORMING_FLAG": {"Y": 1, " ": 0},
    "SPECIAL_ELIGIBILITY_PROGRAM": {"H": 1, "F": 2, "R": 3},
    "RELIEF_REFINANCE_INDICATOR": {"Y": 1, "N": 0},
    "IO_INDICATOR": {"Y": 1, "N": 0},
    "MI_CANCELLATION_INDICATOR": {"Y": 1, "N": 0},
}
PERFORMANCE_CODES = {
    "CURRENT_LOAN_DELINQUENCY_STATUS": {
        "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "6": 6, "7": 7, "8": 8, "9": 9,
        "RA": 10,
    },
    "MODIFICATION_FLAG": {"Y": 1, "P": 2},
    "ZERO_BALANCE_CODE": {"01": 1, "02": 2, "03": 3, "09": 4, "15": 5, "16": 6, "96": 7},
    "INTEREST_RATE_STEP_INDICATOR": {"Y": 1, "N": 0},
    "PAYMENT_DEFERRAL_FLAG": {"Y": 1, "P": 2},
    "DELINQUENCY_DUE_TO_DISASTER": {"Y": 1, "N": 0},
    "BORROWER_ASSISTANCE_STATUS_CODE": {"T": 1, "F": 2, "R": 3},
}

# Codes that are known to mean "not available" (so unmapped on purpose).
NOT_AVAILABLE_CODES = {
    "FIRST_TIME_HOMEBUYER_FLAG": ("9",),
    "OCCUPANCY_STATUS": ("9",),
    "CHANNEL": ("9",),
    "AMORTIZATION_TYPE": ("9",),
    "PROPERTY_TYPE": ("9",),
    "LOAN_PURPOSE": ("9",),
    "SPECIAL_ELIGIBILITY_PROGRAM": (" ",),
    "RELIEF_REFINANCE_INDICATOR": (" ",),
    "IO_INDICATOR": ("9",),
    "MI_CANCELLATION_INDICATOR": ("9",),
}

# Inclusive valid ranges; anything outside becomes NULL.
ORIGINATION_RANGES = {
    "CREDIT_SCORE": (300, 850),
    "MI_PERCENTAGE": (0, 100),
    "NUMBER_OF_UNITS": (1, 4),
    "ORIGINAL_CLTV": (0, 200),
    "ORIGINAL_DTI": (0, 65),
    "ORIGINAL_INTEREST_RATE": (0, 30),
    "ORIGINAL_LOAN_TERM": (60, 480),
    "NUMBER_OF_BORROWERS": (1, 10),
}
PERFORMANCE_RANGES = {"CURRENT_INTEREST_RATE": (0, 30)}
LTV_RANGE = (6, 105)
LTV_RANGE_RELIEF = (1, 998)
NON_NEGATIVE = ("LOAN_AGE", "REMAINING_MONTHS_TO_LEGAL_MATURITY")

ORIGINATION_PERIODS = ("FIRST_PAYMENT_DATE", "MATURITY_DATE")
PERFORMANCE_PERIODS = ("DEFECT_SETTLEMENT_DATE", "ZERO_BALANCE_EFFECTIVE_DATE", "DDLPI")

# Amounts that are kept as doubles with NaN turned into NULL.
AMOUNTS = (
    "CURRENT_ACTUAL_UPB", "CURRENT_NON_INTEREST_BEARING_UPB", "MI_RECOVERIES",
    "NET_SALE_PROCEEDS", "NON_MI_RECOVERIES", "TOTAL_EXPENSES", "LEGAL_COSTS",
    "MAINTENANCE_AND_PRESERVATION_COSTS", "TAXES_AND_INSURANCE", "MISCELLANEOUS_EXPENSES",
    "ACTUAL_LOSS_CALCULATION", "CUMULATIVE_MODIFICATION_COST", "ELTV",
    "ZERO_BALANCE_REMOVAL_UPB", "DELINQUENT_ACCRUED_INTEREST",
    "CURRENT_MONTH_MODIFICATION_COST", "INTEREST_BEARING_UPB",
)

# Raw codes that are valid per column ('' stands for "not set").
VALID_CODES = {
    "PROPERTY_STATE": tuple(STATES),
    "CURRENT_LOAN_DELINQUENCY_STATUS": tuple("0 1 2 3 4 5 6 7 8 9 RA".split()),
    "ZERO_BALANCE_CODE": ("01", "02", "03", "09", "15", "16", "96", ""),
    "MODIFICATION_FLAG": ("Y", "P", ""),
    "PAYMENT_DEFERRAL_FLAG": ("Y", "P", ""),
}

# Columns that never reach a model.
DROP_FEATURES = """
    LOAN_SEQUENCE_NUMBER MONTHLY_REPORTING_PERIOD FIRST_PAYMENT_DATE MATURITY_DATE
    POSTAL_CODE SELLER_NAME SERVICER_NAME DEFECT_SETTLEMENT_DATE ZERO_BALANCE_CODE
    ZERO_BALANCE_EFFECTIVE_DATE DDLPI MI_RECOVERIES NET_SALE_PROCEEDS NON_MI_RECOVERIES
    TOTAL_EXPENSES LEGAL_COSTS MAINTENANCE_AND_PRESERVATION_COSTS TAXES_AND_INSURANCE
    MISCELLANEOUS_EXPENSES ACTUAL_LOSS_CALCULATION CUMULATIVE_MODIFICATION_COST
    INTEREST_RATE_STEP_INDICATOR PAYMENT_DEFERRAL_FLAG ZERO_BALANCE_REMOVAL_UPB
    DELINQUENT_ACCRUED_INTEREST CURRENT_MONTH_MODIFICATION_COST
    BORROWER_ASSISTANCE_STATUS_CODE DELINQUENCY_DUE_TO_DISASTER AMORTIZATION_TYPE
    PROPERTY_VALUATION_METHOD IO_INDICATOR MI_CANCELLATION_INDICATOR SUPER_CONFORMING_FLAG
    RELIEF_REFINANCE_INDICATOR PRE_RELIEF_REFINANCE_LSN SPECIAL_ELIGIBILITY_PROGRAM
    vintage_year origination_year reporting_year delinquency_numeric is_delinquent
    is_terminated future_termination future_delinquency_max delinquency_days row_num
    cumulative_delinquency last_delinquent_month last_modification_month
    delinquency_streak_id num_modifications payment_deferral_count rate_reduction_after_mod
    CURRENT_NON_INTEREST_BEARING_UPB prev_interest_rate rolling_std_balance_6m
    rolling_std_rate_6m rolling_avg_eltv_6m rolling_std_eltv_6m rolling_min_eltv_6m
    rolling_max_eltv_6m
""".split()

# Columns that are categories even though they are stored as numbers.
CATEGORICAL_FEATURES = """
    FIRST_TIME_HOMEBUYER_FLAG OCCUPANCY_STATUS PROPERTY_TYPE LOAN_PURPOSE CHANNEL
    CURRENT_LOAN_DELINQUENCY_STATUS PROPERTY_STATE NUMBER_OF_BORROWERS NUMBER_OF_UNITS
    MODIFICATION_FLAG PPM_FLAG
""".split()

# Identifier and leakage columns taken out of a model input table.
MODEL_INPUT_DROP = """
    LOAN_SEQUENCE_NUMBER MONTHLY_REPORTING_PERIOD target ingestion_timestamp vintage_year
    origination_year reporting_year delinquency_numeric is_delinquent is_terminated
    future_termination future_delinquency_max delinquency_days row_num
    cumulative_delinquency last_delinquent_month last_modification_month
    delinquency_streak_id num_modifications payment_deferral_count rate_reduction_after_mod
    CURRENT_NON_INTEREST_BEARING_UPB prev_interest_rate rolling_std_balance_6m
    rolling_std_rate_6m rolling_avg_eltv_6m rolling_std_eltv_6m rolling_min_eltv_6m
    rolling_max_eltv_6m
""".split()

# Defaults for columns a model may expect but a scoring table may lack.
MISSING_TEXT = "MISSING"
SCORING_DEFAULTS = {
    **dict.fromkeys(
        """
        origination_year vintage_year reporting_year delinquency_numeric is_delinquent
        is_terminated future_termination future_delinquency_max delinquency_days row_num
        cumulative_delinquency delinquency_streak_id num_modifications
        payment_deferral_count rate_reduction_after_mod CURRENT_NON_INTEREST_BEARING_UPB
        prev_interest_rate rolling_std_balance_6m rolling_std_rate_6m rolling_avg_eltv_6m
        rolling_std_eltv_6m rolling_min_eltv_6m rolling_max_eltv_6m
        """.split(),
        0,
    ),
    "last_delinquent_month": MISSING_TEXT,
    "last_modification_month": MISSING_TEXT,
}

# Static attributes of the loan-level summary.
LOAN_SUMMARY = (
    "vintage_year", "ORIGINAL_UPB", "CREDIT_SCORE", "ORIGINAL_LTV", "ORIGINAL_DTI",
    "PROPERTY_STATE",
)

# Half-open probability bands [low, high).
RISK_BANDS = (
    ("Low", 0.00, 0.02),
    ("Medium", 0.02, 0.05),
    ("High", 0.05, 0.10),
    ("Very High", 0.10, 1.00),
)
