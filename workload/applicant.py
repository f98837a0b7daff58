"""Queries over the applicant mart built from the derived raw tables, and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmart.config import Settings, scratch_dir
from grainmart.operators import profile
from grainmart.operators.features import (
    capture_levels, conform_levels, feature_columns, fit_linear_preparation, level_counts, most_frequent,
    numeric_fill, scaled, split_types,
)
from grainmart.operators.rollup import split_pools
from grainmart.plans.applicant_mart import (
    CONTRACT, MART, ROLLUPS, build_mart, declared_rules_report, roll_up,
)
from grainmart.plans.applicant_staging import STAGING, stage_all
from workload.derived import RAW, raw_cte, raw_tables

SETTINGS = Settings()


# Averages of ratios: the only measures whose last bits depend on the order of addition. All
# others come from exact sums of whole units.
RATIO_AVERAGES = (
    "bureau_bb_dpd_rate_avg", "prev_app_credit_to_application_ratio_avg",
    "prev_app_down_payment_rate_avg", "cc_utilization_avg", "cc_min_payment_ratio_avg",
    "inst_payment_ratio_avg", "returned_rate_avg")


def rounded(df: DataFrame, only: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Doubles at a precision that does not depend on the order of addition, and no minus zero."""
    return df.selectExpr(*[
        f"round(`{f.name}`, {digits}) + 0D AS `{f.name}`"
        if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)
        else f"`{f.name}`" for f in df.schema.fields
    ])


def settled(df: DataFrame) -> DataFrame:
    return rounded(df, RATIO_AVERAGES, 10)


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared checkpoint folder, for operators that pass over it
    more than once."""
    path = f"{scratch_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(spark: SparkSession, sf_dir: str, names=tuple(STAGING)) -> dict[str, DataFrame]:
    raw = [table for name in names for table in STAGING[name][1]]
    return stage_all(raw_tables(spark, sf_dir, raw))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir)
    return build_mart(tables["stg_application"], roll_up(tables))


def training_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_pools(mart(spark, sf_dir), "is_train")[0]


def _stage(name: str):
    return lambda spark, sf_dir: staged(spark, sf_dir, (name,))[name]


def _roll(name: str):
    return lambda spark, sf_dir: settled(roll_up(staged(spark, sf_dir, ROLLUPS[name][1]))[name])


def applicant_mart(spark, sf_dir):
    return settled(mart(spark, sf_dir))


def applicant_declared_rules(spark, sf_dir):
    tables = staged(spark, sf_dir)
    rolled = roll_up(tables)
    return declared_rules_report(
        {**tables, **rolled, MART: build_mart(tables["stg_application"], rolled)})


def _blemished(spark, sf_dir):
    """The mart with violations: missing and negative counts, an impossible label, null flags."""
    return mart(spark, sf_dir).withColumns({
        "bureau_count": F.nullif("bureau_count", F.lit(10)),
        "pos_active_count": F.col("pos_active_count") - 5,
        "target": F.when(F.col("gender") == "M", F.col("target") + 1).otherwise(F.col("target")),
        "has_credit_card_history": F.when(F.col("has_credit_card_history"), F.lit(True)),
    })


def applicant_contract_report(spark, sf_dir):
    return CONTRACT.report(_blemished(spark, sf_dir))


def applicant_contract_violations(spark, sf_dir):
    from grainmart.operators.quality import violating_rows

    df = _blemished(spark, sf_dir)
    return violating_rows(df, CONTRACT.row_rules(df), "sk_id_curr").select(
        "sk_id_curr", "rule", "column")


def profile_missing(spark, sf_dir):
    pool = training_pool(spark, sf_dir)
    return rounded(profile.missing_rates(pool, feature_columns(pool, SETTINGS.non_features)))


def profile_label_correlation(spark, sf_dir):
    pool = training_pool(spark, sf_dir)
    numeric, _ = split_types(pool, feature_columns(pool, SETTINGS.non_features))
    return rounded(profile.label_correlations(pool, numeric, "target"))


def profile_level_spread(spark, sf_dir):
    pool = training_pool(spark, sf_dir)
    _, text = split_types(pool, feature_columns(pool, SETTINGS.non_features))
    return rounded(profile.level_spread(pool, text, "target"))


def profile_header(spark, sf_dir):
    pool = training_pool(spark, sf_dir)
    numeric, text = split_types(pool, feature_columns(pool, SETTINGS.non_features))
    return rounded(profile.header(pool, numeric, text, "target"))


# All text columns of the mart.
LEVEL_COLUMNS = (
    "contract_type", "gender", "own_car", "own_realty", "type_suite", "income_type", "education_type",
    "family_status", "housing_type", "occupation_type", "apply_weekday", "organization_type",
    "fond_kapremont", "house_type", "walls_material", "emergency_state")


def level_capture(spark, sf_dir):
    pool, _ = split_pools(staged(spark, sf_dir, ("stg_application",))["stg_application"], "is_train")
    return level_counts(pool, LEVEL_COLUMNS)


def level_conform(spark, sf_dir):
    """Scoring pool against the levels of the training pool: the income type of the scoring pool
    never occurs in training."""
    train, score = split_pools(staged(spark, sf_dir, ("stg_application",))["stg_application"], "is_train")
    return conform_levels(score, capture_levels(train, LEVEL_COLUMNS), LEVEL_COLUMNS).select(
        "sk_id_curr", *LEVEL_COLUMNS)


def level_most_frequent(spark, sf_dir):
    return most_frequent(training_pool(spark, sf_dir), LEVEL_COLUMNS)


SCALED = ("own_car_age", "ext_source_1", "employed_years", "bureau_debt_to_credit_ratio",
          "cc_dpd_avg", "has_credit_card_history")


def impute_and_scale(spark, sf_dir):
    """Exact median fill and standardisation of numeric columns over the training pool."""
    pool = written(training_pool(spark, sf_dir).select("sk_id_curr", *SCALED))
    fills = numeric_fill(pool, SCALED)
    return rounded(pool.selectExpr(
        "sk_id_curr", *[f"{scaled(c, fills[c])} AS {c}" for c in SCALED]))


def linear_numbers(spark, sf_dir):
    """The numeric half of the linear preparation: every numeric column of the training pool."""
    pool = training_pool(spark, sf_dir)
    numeric, _ = split_types(pool, feature_columns(pool, SETTINGS.non_features))
    pool = written(pool.select("sk_id_curr", *numeric))
    fills = numeric_fill(pool, numeric)
    return rounded(pool.selectExpr("sk_id_curr", *[f"{scaled(c, f)} AS {c}" for c, f in fills.items()]))


def linear_levels(spark, sf_dir):
    """The one-hot half, fitted on the training pool: of each row of both pools, the place set in every text
    column's block; null where the block is all zero."""
    pools = mart(spark, sf_dir)
    _, text = split_types(pools, feature_columns(pools, SETTINGS.non_features))
    pools = written(pools.select("sk_id_curr", "is_train", *text))
    encoded = fit_linear_preparation(pools.where("is_train"), [], text).transform(pools)
    return encoded.select("sk_id_curr", *[
        F.nullif(F.array_position(vector_to_array(f"{c}__hot"), F.lit(1.0)), F.lit(0)).alias(c) for c in text])


QUERIES = {
    **{f"applicant_{name}": _stage(name) for name in STAGING},
    **{f"applicant_{name}": _roll(name) for name in ROLLUPS},
    **{f.__name__: f for f in (
        applicant_mart, applicant_declared_rules, applicant_contract_report,
        applicant_contract_violations, profile_missing, profile_label_correlation,
        profile_level_spread, profile_header, level_capture, level_conform, level_most_frequent,
        impute_and_scale, linear_numbers, linear_levels)},
}

# ---------------------------------------------------------------------------------- oracle SQL


_OPEN, _CLOSE = "/*to*/round((", "), /*digits*/ 10)"


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def r10(expression: str) -> str:
    return f"{_OPEN}{expression}{_CLOSE}"


def _unrounded(sql: str) -> str:
    """The same SQL with intermediate results kept at full precision."""
    return sql.replace(_OPEN, "((").replace(_CLOSE, "))")


# The clean names and column lists that the mart promises, spelled here once more so that
# a slip in the library's own lists turns a row red.
CLEAN_NAMES = {
    "NAME_CONTRACT_TYPE": "contract_type", "NAME_CONTRACT_STATUS": "contract_status",
    "CODE_GENDER": "gender", "FLAG_OWN_CAR": "own_car", "FLAG_OWN_REALTY": "own_realty",
    "NAME_TYPE_SUITE": "type_suite", "NAME_FAMILY_STATUS": "family_status",
    "NAME_HOUSING_TYPE": "housing_type", "NAME_EDUCATION_TYPE": "education_type",
    "NAME_INCOME_TYPE": "income_type",
    "AMT_REQ_CREDIT_BUREAU_HOUR": "bureau_enquiries_hour",
    "AMT_REQ_CREDIT_BUREAU_DAY": "bureau_enquiries_day",
    "AMT_REQ_CREDIT_BUREAU_WEEK": "bureau_enquiries_week",
    "AMT_REQ_CREDIT_BUREAU_MON": "bureau_enquiries_mon",
    "AMT_REQ_CREDIT_BUREAU_QRT": "bureau_enquiries_qrt",
    "AMT_REQ_CREDIT_BUREAU_YEAR": "bureau_enquiries_year",
    "TOTALAREA_MODE": "total_area_mode", "WALLSMATERIAL_MODE": "walls_material",
    "HOUSETYPE_MODE": "house_type", "FONDKAPREMONT_MODE": "fond_kapremont",
    "EMERGENCYSTATE_MODE": "emergency_state",
    "WEEKDAY_APPR_PROCESS_START": "apply_weekday", "HOUR_APPR_PROCESS_START": "apply_hour",
    "AMT_RECIVABLE": "amt_receivable", "SK_DPD": "dpd", "SK_DPD_DEF": "dpd_def",
    "NUM_INSTALMENT_VERSION": "instalment_version", "NUM_INSTALMENT_NUMBER": "instalment_number",
    "NAME_CASH_LOAN_PURPOSE": "cash_loan_purpose", "NAME_PAYMENT_TYPE": "payment_type",
    "CODE_REJECT_REASON": "reject_reason", "NAME_CLIENT_TYPE": "client_type",
    "NAME_GOODS_CATEGORY": "goods_category", "NAME_PORTFOLIO": "portfolio",
    "NAME_PRODUCT_TYPE": "product_type", "NAME_SELLER_INDUSTRY": "seller_industry",
    "NAME_YIELD_GROUP": "yield_group",
    "FLAG_LAST_APPL_PER_CONTRACT": "is_last_appl_per_contract",
    "NFLAG_LAST_APPL_IN_DAY": "is_last_appl_in_day",
    "NFLAG_INSURED_ON_APPROVAL": "is_insured_on_approval",
}
CONTACTS = ("FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL")
DOCUMENTS = tuple(f"FLAG_DOCUMENT_{i}" for i in range(2, 22))
DWELLING = (
    "APARTMENTS_AVG", "BASEMENTAREA_AVG", "YEARS_BEGINEXPLUATATION_AVG", "YEARS_BUILD_AVG",
    "COMMONAREA_AVG", "ELEVATORS_AVG", "ENTRANCES_AVG", "FLOORSMAX_AVG", "FLOORSMIN_AVG", "LANDAREA_AVG",
    "LIVINGAPARTMENTS_AVG", "LIVINGAREA_AVG", "NONLIVINGAPARTMENTS_AVG", "NONLIVINGAREA_AVG")


def _plain(raw: str, *, without=()) -> list[str]:
    """Raw columns that are only renamed."""
    return [f"{c} AS {CLEAN_NAMES.get(c, c.lower())}" for c in RAW[raw][2]
            if c not in without and not c.startswith("DAYS_")]


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} END"


def _years(column: str) -> str:
    return f"-({column}) / CAST(365.25 AS DOUBLE)"


_FOLDED = (*CONTACTS, *DOCUMENTS, *DWELLING)
_APPLICATION_SQL = ", ".join([
    "is_train", *_plain("application_train", without=_FOLDED),
    f"{_ratio('AMT_ANNUITY', 'AMT_CREDIT')} AS annuity_to_credit_ratio",
    f"{_ratio('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS credit_to_goods_ratio",
    f"{_ratio('AMT_CREDIT', 'AMT_INCOME_TOTAL')} AS credit_to_income_ratio",
    f"{_ratio('AMT_ANNUITY', 'AMT_INCOME_TOTAL')} AS annuity_to_income_ratio",
    f"{_years('DAYS_BIRTH')} AS age_years", f"{_years('nullif(DAYS_EMPLOYED, 365243)')} AS employed_years",
    "DAYS_EMPLOYED IS NOT DISTINCT FROM 365243 AS is_pensioner_anomaly",
    f"{_years('DAYS_REGISTRATION')} AS registration_years",
    f"{_years('DAYS_ID_PUBLISH')} AS id_publish_years",
    f"{_years('DAYS_LAST_PHONE_CHANGE')} AS last_phone_change_years",
    f"{' + '.join(CONTACTS)} AS contactability_score",
    f"{' + '.join(DOCUMENTS)} AS documents_submitted_count",
    "(" + " + ".join(f"ifnull({c}, 0)" for c in DWELLING) + ") / CAST(14 AS DOUBLE) AS housing_quality_score",
    "(" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in DWELLING)
    + ") / CAST(14 AS DOUBLE) AS housing_info_missing_rate",
])

_STAGE_SQL = {
    "stg_application": (("application_train", "application_test"), f"""
        SELECT {_APPLICATION_SQL} FROM (
            SELECT *, true AS is_train FROM application_train UNION ALL BY NAME
            SELECT *, false AS is_train FROM application_test)"""),
    "stg_bureau": (("bureau",), "SELECT " + ", ".join([
        *_plain("bureau"), "-DAYS_CREDIT AS days_since_credit_applied",
        "-DAYS_CREDIT_ENDDATE AS days_to_credit_enddate", "-DAYS_ENDDATE_FACT AS days_since_credit_closed",
        "-DAYS_CREDIT_UPDATE AS days_since_bureau_update"]) + " FROM bureau"),
    "stg_bureau_balance": (("bureau_balance",), "SELECT " + ", ".join([
        *_plain("bureau_balance"), "STATUS BETWEEN '1' AND '5' AS is_dpd",
        "TRY_CAST(STATUS AS INT) AS status_numeric"]) + " FROM bureau_balance"),
    "stg_previous_application": (("previous_application",), "SELECT " + ", ".join([
        *_plain("previous_application"),
        f"{_ratio('AMT_CREDIT', 'AMT_APPLICATION')} AS credit_to_application_ratio",
        f"{_ratio('AMT_DOWN_PAYMENT', 'AMT_CREDIT')} AS down_payment_rate",
        "-DAYS_DECISION AS days_since_decision",
        *[f"-nullif(DAYS_{e}, 365243) AS days_since_{e.lower()}" for e in (
            "FIRST_DRAWING", "FIRST_DUE", "LAST_DUE_1ST_VERSION", "LAST_DUE", "TERMINATION")],
    ]) + " FROM previous_application"),
    "stg_pos_cash_balance": (
        ("pos_cash_balance",), "SELECT " + ", ".join(_plain("pos_cash_balance")) + " FROM pos_cash_balance"),
    "stg_credit_card_balance": (("credit_card_balance",), "SELECT " + ", ".join([
        *_plain("credit_card_balance"), f"{_ratio('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')} AS utilization",
        f"{_ratio('AMT_PAYMENT_TOTAL_CURRENT', 'AMT_INST_MIN_REGULARITY')} AS min_payment_ratio",
    ]) + " FROM credit_card_balance"),
    "stg_installments_payments": (("installments_payments",), "SELECT " + ", ".join([
        *_plain("installments_payments"), "-DAYS_INSTALMENT + 0.0 AS days_since_instalment_due",
        "-DAYS_ENTRY_PAYMENT + 0.0 AS days_since_payment_entered",
        "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS days_late",
        f"{_ratio('AMT_PAYMENT', 'AMT_INSTALMENT')} AS payment_ratio"]) + " FROM installments_payments"),
}

# Rollups straight from the raw tables: (raw tables, group key, source, {name: (SQL, default)}).
_n = "count(*)"


def _where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _rate(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) / CAST(count(*) AS DOUBLE)"


def _safe(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} END"


_MONTHS = {
    "bb_months_count": _n, "bb_months_balance_min": "min(MONTHS_BALANCE)",
    "bb_dpd_rate": _rate("STATUS IN ('1', '2', '3', '4', '5')"),
    "bb_closed_rate": _rate("STATUS = 'C'"), "bb_unknown_rate": _rate("STATUS = 'X'"),
    "bb_max_dpd_status": "max(TRY_CAST(STATUS AS INT))",
}
_ROLL_SQL = {
    "int_bureau_agg": (
        ("bureau", "bureau_balance"),
        "bureau LEFT JOIN (SELECT SK_ID_BUREAU, count(*) AS months, max(TRY_CAST(STATUS AS INT)) AS worst, "
        "avg(CASE WHEN STATUS BETWEEN '1' AND '5' THEN 1 ELSE 0 END) AS late "
        "FROM bureau_balance GROUP BY 1) USING (SK_ID_BUREAU)", "has_bureau_history", {
            "bureau_count": (_n, 0), "bureau_credit_types_count": "count(DISTINCT CREDIT_TYPE)",
            "bureau_active_count": (_where("CREDIT_ACTIVE = 'Active'"), 0),
            "bureau_closed_count": (_where("CREDIT_ACTIVE = 'Closed'"), 0),
            "bureau_days_since_credit_applied_avg": "avg(-DAYS_CREDIT)",
            "bureau_days_since_credit_applied_min": "min(-DAYS_CREDIT)",
            "bureau_credit_day_overdue_max": "max(CREDIT_DAY_OVERDUE)",
            "bureau_cnt_credit_prolong_sum": ("CAST(sum(CNT_CREDIT_PROLONG) AS BIGINT)", 0),
            "bureau_amt_credit_sum_total": "sum(AMT_CREDIT_SUM)",
            "bureau_amt_credit_sum_debt_total": "sum(AMT_CREDIT_SUM_DEBT)",
            "bureau_amt_credit_sum_overdue_total": "sum(AMT_CREDIT_SUM_OVERDUE)",
            "bureau_debt_to_credit_ratio": _safe("sum(AMT_CREDIT_SUM_DEBT)", "sum(AMT_CREDIT_SUM)"),
            "bureau_overdue_to_credit_ratio": _safe("sum(AMT_CREDIT_SUM_OVERDUE)", "sum(AMT_CREDIT_SUM)"),
            "bureau_bb_months_count_avg": "avg(months)", "bureau_bb_dpd_rate_avg": r10("avg(late)"),
            "bureau_bb_max_dpd_status_max": "max(worst)"}),
    "int_previous_application_agg": (
        ("previous_application",), "previous_application", "has_previous_application_history", {
            "prev_app_count": (_n, 0),
            "prev_app_approved_count": (_where("NAME_CONTRACT_STATUS = 'Approved'"), 0),
            "prev_app_refused_count": (_where("NAME_CONTRACT_STATUS = 'Refused'"), 0),
            "prev_app_canceled_count": (_where("NAME_CONTRACT_STATUS = 'Canceled'"), 0),
            "prev_app_approval_rate": _rate("NAME_CONTRACT_STATUS = 'Approved'"),
            "prev_app_amt_credit_avg": "avg(AMT_CREDIT)",
            "prev_app_amt_annuity_avg": "avg(AMT_ANNUITY)",
            "prev_app_amt_application_avg": "avg(AMT_APPLICATION)",
            "prev_app_credit_to_application_ratio_avg": r10("avg(" + _safe("AMT_CREDIT", "AMT_APPLICATION") + ")"),
            "prev_app_down_payment_rate_avg": r10("avg(" + _safe("AMT_DOWN_PAYMENT", "AMT_CREDIT") + ")"),
            "prev_app_cnt_payment_avg": "avg(CNT_PAYMENT)",
            "prev_app_days_since_decision_min": "-max(DAYS_DECISION)",
            "prev_app_days_since_decision_max": "-min(DAYS_DECISION)",
            "prev_app_new_client_count": (_where("NAME_CLIENT_TYPE = 'New'"), 0)}),
    "int_pos_cash_agg": (
        ("pos_cash_balance",), "pos_cash_balance", "has_pos_cash_history", {
            "pos_records_count": (_n, 0), "pos_distinct_prev_count": ("count(DISTINCT SK_ID_PREV)", 0),
            "pos_completed_count": (_where("NAME_CONTRACT_STATUS = 'Completed'"), 0),
            "pos_active_count": (_where("NAME_CONTRACT_STATUS = 'Active'"), 0),
            "pos_cnt_instalment_avg": "avg(CNT_INSTALMENT)",
            "pos_months_balance_min": "min(MONTHS_BALANCE)", "pos_dpd_max": "max(SK_DPD)",
            "pos_dpd_avg": "avg(SK_DPD)", "pos_dpd_def_max": "max(SK_DPD_DEF)",
            "pos_dpd_rate": _rate("SK_DPD > 0")}),
    "int_credit_card_agg": (
        ("credit_card_balance",), "credit_card_balance", "has_credit_card_history", {
            "cc_records_count": (_n, 0), "cc_distinct_prev_count": ("count(DISTINCT SK_ID_PREV)", 0),
            "cc_amt_balance_avg": "avg(AMT_BALANCE)", "cc_amt_balance_max": "max(AMT_BALANCE)",
            "cc_credit_limit_avg": "avg(AMT_CREDIT_LIMIT_ACTUAL)",
            "cc_utilization_avg": r10("avg(" + _safe("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL") + ")"),
            "cc_utilization_max": "max(" + _safe("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL") + ")",
            "cc_amt_drawings_atm_avg": "avg(AMT_DRAWINGS_ATM_CURRENT)",
            "cc_amt_drawings_avg": "avg(AMT_DRAWINGS_CURRENT)",
            "cc_amt_payment_total_avg": "avg(AMT_PAYMENT_TOTAL_CURRENT)",
            "cc_min_payment_ratio_avg": r10("avg(" + _safe("AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY") + ")"),
            "cc_underpaid_months_count": (_where(_safe("AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY") + " < 1"), 0),
            "cc_months_balance_min": "min(MONTHS_BALANCE)", "cc_dpd_max": "max(SK_DPD)",
            "cc_dpd_avg": "avg(SK_DPD)", "cc_dpd_def_max": "max(SK_DPD_DEF)"}),
    "int_installments_agg": (
        ("installments_payments",), "installments_payments", "has_installments_history", {
            "inst_payments_count": (_n, 0), "inst_distinct_prev_count": ("count(DISTINCT SK_ID_PREV)", 0),
            "inst_days_late_avg": "avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)",
            "inst_days_late_max": "max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)",
            "inst_late_payment_rate": _rate("DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT"),
            "inst_severely_late_payment_rate": _rate("DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT + 30"),
            "inst_payment_ratio_avg": r10("avg(" + _safe("AMT_PAYMENT", "AMT_INSTALMENT") + ")"),
            "inst_underpayment_rate": _rate(_safe("AMT_PAYMENT", "AMT_INSTALMENT") + " < CAST(0.99 AS DOUBLE)"),
            "inst_amt_instalment_sum": "sum(AMT_INSTALMENT)", "inst_amt_payment_sum": "sum(AMT_PAYMENT)"}),
}


def _sql_of(measure) -> str:
    return measure[0] if isinstance(measure, tuple) else measure


def _ctes(*names: str) -> str:
    return ", ".join(raw_cte(n) for n in names)


def _roll_select(name: str) -> str:
    _, source, _, measures = _ROLL_SQL[name]
    listed = ", ".join(f"{_sql_of(m)} AS {c}" for c, m in measures.items())
    return f"SELECT SK_ID_CURR AS sk_id_curr, {listed} FROM {source} GROUP BY SK_ID_CURR"


_MONTHS_SELECT = ("SELECT SK_ID_BUREAU AS sk_id_bureau, "
                  + ", ".join(f"{sql} AS {c}" for c, sql in _MONTHS.items())
                  + " FROM bureau_balance GROUP BY SK_ID_BUREAU")


def _mart_ctes() -> str:
    """Raw tables, the rollups and the mart as named subqueries."""
    columns, joins = ["a.*"], []
    for i, (name, (_, _, flag, measures)) in enumerate(_ROLL_SQL.items()):
        joins.append(f"LEFT JOIN {name} r{i} ON r{i}.sk_id_curr = a.sk_id_curr")
        for c, m in measures.items():
            columns.append(f"ifnull(r{i}.{c}, 0) AS {c}" if isinstance(m, tuple) else f"r{i}.{c}")
        columns.append(f"r{i}.sk_id_curr IS NOT NULL AS {flag}")
    return ", ".join([
        _ctes(*RAW), f"stg_application AS ({_STAGE_SQL['stg_application'][1]})",
        *[f"{name} AS MATERIALIZED ({_roll_select(name)})" for name in _ROLL_SQL],
        f"mart AS MATERIALIZED (SELECT {', '.join(columns)} FROM stg_application a {' '.join(joins)})",
        "pool AS (SELECT * FROM mart WHERE is_train)",
    ])


_MART = _unrounded(_mart_ctes())
_TEXT = [
    "contract_type", "gender", "own_car", "own_realty", "type_suite", "family_status",
    "housing_type", "education_type", "income_type", "occupation_type", "organization_type",
    "walls_material", "house_type", "fond_kapremont", "emergency_state", "apply_weekday"]
_COUNTED = [c for *_, ms in _ROLL_SQL.values() for c, m in ms.items() if isinstance(m, tuple)]
_FLAGS = [flag for *_, flag, _ in _ROLL_SQL.values()]
_APPLICATION_NAMES = [
    p.split(" AS ")[-1] for p in _plain("application_train", without=_FOLDED)] + [
    "annuity_to_credit_ratio", "credit_to_goods_ratio", "credit_to_income_ratio",
    "annuity_to_income_ratio", "age_years", "employed_years", "is_pensioner_anomaly",
    "registration_years", "id_publish_years", "last_phone_change_years", "contactability_score",
    "documents_submitted_count", "housing_quality_score", "housing_info_missing_rate"]
_FEATURES = [c for c in _APPLICATION_NAMES if c not in ("sk_id_curr", "target")] + [
    c for *_, flag, ms in _ROLL_SQL.values() for c in (*ms, flag)]
_NUMERIC = [c for c in _FEATURES if c not in _TEXT]


def _rule(rule: str, column: str, violation: str, source: str, key: str, extra: str = "") -> str:
    return (f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) AS failures, "
            f"CAST(min({key}) AS VARCHAR) AS sample{extra} FROM {source} WHERE {violation}")


def _unique(column: str, source: str, extra: str = "") -> str:
    return (f"SELECT 'unique' AS rule, '{column}' AS \"column\", count(*) AS failures, "
            f"min(CAST(k AS VARCHAR)) AS sample{extra} FROM (SELECT {column} AS k FROM {source} "
            f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


def _declared_sql() -> str:
    tables = {
        "stg_application": ("stg_application", "sk_id_curr", ()),
        "stg_bureau": ("bureau", "sk_id_bureau", ("sk_id_curr",)),
        "stg_bureau_balance": ("bureau_balance", None, ("sk_id_bureau",)),
        "stg_previous_application": ("previous_application", "sk_id_prev", ("sk_id_curr",)),
        "stg_pos_cash_balance": ("pos_cash_balance", None, ("sk_id_prev",)),
        "stg_credit_card_balance": ("credit_card_balance", None, ("sk_id_prev",)),
        "stg_installments_payments": ("installments_payments", None, ("sk_id_prev",)),
        "int_bureau_balance_agg": ("int_bureau_balance_agg", "sk_id_bureau", ()),
        **{n: (n, "sk_id_curr", ()) for n in _ROLL_SQL},
        MART: ("mart", "sk_id_curr", ("bureau_count", "prev_app_count", "pos_records_count",
                                      "cc_records_count", "inst_payments_count")),
    }
    parents = {
        "stg_bureau": ("sk_id_curr", "stg_application"),
        "stg_bureau_balance": ("sk_id_bureau", "bureau"),
        "stg_previous_application": ("sk_id_curr", "stg_application"),
        "stg_pos_cash_balance": ("sk_id_prev", "previous_application"),
        "stg_credit_card_balance": ("sk_id_prev", "previous_application"),
        "stg_installments_payments": ("sk_id_prev", "previous_application"),
    }
    selects = []
    for table, (source, unique, filled) in tables.items():
        extra = f", '{table}' AS \"table\""
        first = unique or filled[0]
        for c in (*([unique] if unique else []), *filled):
            selects.append(_rule("not_null", c, f"{c} IS NULL", source, first, extra))
        if table in ("stg_application", MART):
            selects.append(_rule("accepted_values", "target", "is_train AND target NOT IN (0, 1)",
                                 source, first, extra))
        if table == MART:
            selects.append(_rule("label_matches_split", "target", "is_train = (target IS NULL)",
                                 source, first, extra))
        if unique:
            selects.append(_unique(unique, source, extra))
        if table in parents:
            key, parent = parents[table]
            selects.append(_rule("relationship", key, f"{key} NOT IN (SELECT {key} FROM {parent} "
                                 f"WHERE {key} IS NOT NULL)", source, key, extra))
    return (f"WITH {_MART}, int_bureau_balance_agg AS ({_MONTHS_SELECT}) "
            + " UNION ALL ".join(selects))


_BLEMISHED = (
    "blemished AS MATERIALIZED (SELECT * REPLACE (nullif(bureau_count, 10) AS bureau_count, "
    "pos_active_count - 5 AS pos_active_count, "
    "CASE WHEN gender = 'M' THEN target + 1 ELSE target END AS target, "
    "CASE WHEN has_credit_card_history THEN true END AS has_credit_card_history) FROM mart)")
_CONTRACT_RULES = [
    ("not_null", "sk_id_curr", "sk_id_curr IS NULL"), ("at_least", "sk_id_curr", "sk_id_curr < 0"),
    ("not_null", "is_train", "is_train IS NULL"),
    ("accepted_values", "target", "target IS NOT NULL AND target <> 0 AND target <> 1"),
    *[("not_null", c, f"{c} IS NULL") for c in (*_FLAGS, *_COUNTED)],
    *[("at_least", c, f"{c} < 0") for c in _COUNTED],
]
_CONTRACT_SQL = f"WITH {_MART}, {_BLEMISHED} " + " UNION ALL ".join([
    *[f"SELECT 'column_exists' AS rule, '{c}' AS \"column\", 0 AS failures, "
      "CAST(NULL AS VARCHAR) AS sample" for c in ("sk_id_curr", "is_train", "target", *_COUNTED)],
    *[f"SELECT 'type', '{c}', 0, NULL" for c in ("sk_id_curr", "is_train", *_FLAGS)],
    *[_rule(rule, c, sql, "blemished", "sk_id_curr") for rule, c, sql in _CONTRACT_RULES],
    _unique("sk_id_curr", "blemished"),
])
_VIOLATIONS_SQL = f"WITH {_MART}, {_BLEMISHED} " + " UNION ALL ".join(
    f"SELECT sk_id_curr, '{rule}' AS rule, '{c}' AS \"column\" FROM blemished WHERE {sql}"
    for rule, c, sql in _CONTRACT_RULES)


def _correlation(c: str) -> str:
    both = f"FILTER (WHERE {c} IS NOT NULL AND target IS NOT NULL)"
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS feature, covar_pop({x}, target) {both} / nullif(stddev_pop({x}) {both} "
            f"* stddev_pop(target) {both}, 0) AS correlation FROM pool")


def _level_counts(c: str) -> str:
    return f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n FROM pool WHERE {c} IS NOT NULL GROUP BY {c}"


_LEVELS_SQL = "(" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS level FROM pool WHERE {c} IS NOT NULL" for c in LEVEL_COLUMNS) + ")"

ORACLE = {
    **{f"applicant_{n}": f"WITH {_ctes(*raw)} {sql}" for n, (raw, sql) in _STAGE_SQL.items()},
    "applicant_int_bureau_balance_agg": f"WITH {_ctes('bureau_balance')} {_MONTHS_SELECT}",
    **{f"applicant_{n}": f"WITH {_ctes(*_ROLL_SQL[n][0])} {_roll_select(n)}" for n in _ROLL_SQL},
    "applicant_mart": f"WITH {_mart_ctes()} SELECT * FROM mart",
    "applicant_declared_rules": _declared_sql(),
    "applicant_contract_report": _CONTRACT_SQL,
    "applicant_contract_violations": _VIOLATIONS_SQL,
    "profile_missing": f"WITH {_MART} SELECT feature, {r6('missing_rate')} AS missing_rate FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing_rate FROM pool"
        for c in _FEATURES) + ") ORDER BY missing_rate DESC, feature LIMIT 15",
    "profile_label_correlation": f"WITH {_MART} SELECT feature, {r6('correlation')} AS correlation FROM ("
    + " UNION ALL ".join(_correlation(c) for c in _NUMERIC)
    + ") WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC, feature LIMIT 15",
    "profile_level_spread": f"WITH {_MART} SELECT feature, {r6('max(rate) - min(rate)')} AS spread, "
    "count(*) AS n_categories FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(target) AS rate FROM pool WHERE {c} IS NOT NULL GROUP BY {c} "
        "HAVING count(target) >= 20" for c in _TEXT)
    + ") GROUP BY feature ORDER BY max(rate) - min(rate) DESC, feature LIMIT 10",
    "profile_header": f"WITH {_MART} SELECT count(*) AS n_rows, {r6('avg(target)')} AS label_rate, "
    f"{len(_FEATURES)} AS n_features, {len(_NUMERIC)} AS n_numeric, {len(_TEXT)} AS n_categorical FROM pool",
    "level_capture": f"WITH {_MART} SELECT feature, level, count(*) AS n FROM {_LEVELS_SQL} GROUP BY 1, 2",
    "level_conform": f"WITH {_MART} SELECT sk_id_curr, " + ", ".join(
        f"CASE WHEN {c} IN (SELECT {c} FROM pool WHERE {c} IS NOT NULL) THEN {c} END AS {c}"
        for c in LEVEL_COLUMNS) + " FROM mart WHERE NOT is_train",
    "level_most_frequent": f"WITH {_MART} SELECT feature, level FROM (SELECT feature, level, "
    f"row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, level) AS place FROM {_LEVELS_SQL} "
    "GROUP BY 1, 2) WHERE place = 1",
    "impute_and_scale": f"WITH {_MART}, filled AS (SELECT sk_id_curr, " + ", ".join(
        f"ifnull(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM pool)) AS {c}"
        for c in SCALED) + " FROM pool) SELECT sk_id_curr, " + ", ".join(
        r6(f"({c} - avg({c}) OVER ()) / ifnull(nullif(stddev_pop({c}) OVER (), 0), 1)") + f" AS {c}"
        for c in SCALED) + " FROM filled",
    "linear_numbers": f"WITH {_MART}, filled AS (SELECT sk_id_curr, " + ", ".join(
        f"ifnull(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM pool)) AS {c}"
        for c in _NUMERIC) + " FROM pool) SELECT sk_id_curr, " + ", ".join(
        r6(f"({c} - avg({c}) OVER ()) / ifnull(nullif(stddev_pop({c}) OVER (), 0), 1)") + f" AS {c}"
        for c in _NUMERIC) + " FROM filled",
    "linear_levels": f"WITH {_MART}, counted AS ({' UNION ALL '.join(_level_counts(c) for c in _TEXT)}), "
    "placed AS (SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY level) AS place, "
    "row_number() OVER (PARTITION BY feature ORDER BY n DESC, level) AS often FROM counted) "
    "SELECT sk_id_curr, " + ", ".join(
        f"(SELECT max(place) FROM placed WHERE feature = '{c}' AND CASE WHEN mart.{c} IS NULL THEN often = 1 "
        f"ELSE level = mart.{c} END) AS {c}" for c in _TEXT) + " FROM mart",
}
