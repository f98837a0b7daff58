"""Staging of the applicant mart: one lazy, narrow select per raw table, no row lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmart.functions.scalar import (
    days_since, digit_or_null, guarded_ratio, is_one_of, is_sentinel, missing_share,
    offset_difference, strict_sum, without_sentinel, years_since, zero_filled_mean,
)
from grainmart.operators.rollup import union_pools

# Clean names of raw columns that are not simply the raw name in lower case.
RENAMED = {
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

# Columns that are folded into one score.
CONTACT_FLAGS = [f"FLAG_{c}" for c in (
    "MOBIL", "EMP_PHONE", "WORK_PHONE", "CONT_MOBILE", "PHONE", "EMAIL")]
DOCUMENT_FLAGS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
HOUSING = [f"{c}_AVG" for c in (
    "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "COMMONAREA",
    "ELEVATORS", "ENTRANCES", "FLOORSMAX", "FLOORSMIN", "LANDAREA", "LIVINGAPARTMENTS",
    "LIVINGAREA", "NONLIVINGAPARTMENTS", "NONLIVINGAREA")]
LATE_STATUSES = ["1", "2", "3", "4", "5"]


def _as_is(*raw: str) -> list[Column]:
    """Raw columns under their clean names."""
    return [F.col(c).alias(RENAMED.get(c, c.lower())) for c in raw]


def _derived(**columns: Column) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def application(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both pools at applicant grain; applicants to be scored have no label."""
    return union_pools(train, test, "TARGET", "is_train").select(
        *_as_is("SK_ID_CURR", "is_train", "TARGET"),
        *_as_is("NAME_CONTRACT_TYPE", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"),
        *_derived(
            annuity_to_credit_ratio=guarded_ratio("AMT_ANNUITY", "AMT_CREDIT"),
            credit_to_goods_ratio=guarded_ratio("AMT_CREDIT", "AMT_GOODS_PRICE")),
        *_as_is("CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "CNT_CHILDREN",
                "CNT_FAM_MEMBERS", "NAME_TYPE_SUITE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
                "NAME_EDUCATION_TYPE", "AMT_INCOME_TOTAL"),
        *_derived(
            credit_to_income_ratio=guarded_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            annuity_to_income_ratio=guarded_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL")),
        *_as_is("NAME_INCOME_TYPE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE"),
        *_derived(
            age_years=years_since("DAYS_BIRTH"),
            employed_years=years_since(without_sentinel("DAYS_EMPLOYED")),
            is_pensioner_anomaly=is_sentinel("DAYS_EMPLOYED"),
            registration_years=years_since("DAYS_REGISTRATION"),
            id_publish_years=years_since("DAYS_ID_PUBLISH"),
            last_phone_change_years=years_since("DAYS_LAST_PHONE_CHANGE")),
        *_as_is("OWN_CAR_AGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
                "REGION_POPULATION_RELATIVE", "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY",
                "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION",
                "LIVE_REGION_NOT_WORK_REGION", "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY",
                "LIVE_CITY_NOT_WORK_CITY"),
        *_derived(contactability_score=strict_sum(CONTACT_FLAGS)),
        *_as_is("OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
                "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"),
        *_derived(documents_submitted_count=strict_sum(DOCUMENT_FLAGS)),
        *_as_is(*[f"AMT_REQ_CREDIT_BUREAU_{u}" for u in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]),
        *_derived(
            housing_quality_score=zero_filled_mean(HOUSING),
            housing_info_missing_rate=missing_share(HOUSING)),
        *_as_is("TOTALAREA_MODE", "WALLSMATERIAL_MODE", "HOUSETYPE_MODE", "FONDKAPREMONT_MODE",
                "EMERGENCYSTATE_MODE", "WEEKDAY_APPR_PROCESS_START", "HOUR_APPR_PROCESS_START"),
    )


def bureau(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as_is("SK_ID_BUREAU", "SK_ID_CURR", "CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"),
        *_derived(days_since_credit_applied=days_since("DAYS_CREDIT")),
        *_as_is("CREDIT_DAY_OVERDUE"),
        *_derived(
            days_to_credit_enddate=days_since("DAYS_CREDIT_ENDDATE"),
            days_since_credit_closed=days_since("DAYS_ENDDATE_FACT"),
            days_since_bureau_update=days_since("DAYS_CREDIT_UPDATE")),
        *_as_is("CNT_CREDIT_PROLONG", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM",
                "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE",
                "AMT_ANNUITY"),
    )


def bureau_balance(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as_is("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"),
        *_derived(is_dpd=is_one_of("STATUS", LATE_STATUSES), status_numeric=digit_or_null("STATUS")),
    )


def credit_card_balance(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as_is("SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "NAME_CONTRACT_STATUS",
                "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        *_derived(utilization=guarded_ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL")),
        *_as_is("AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT",
                "AMT_DRAWINGS_POS_CURRENT", "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT",
                "AMT_PAYMENT_TOTAL_CURRENT"),
        *_derived(min_payment_ratio=guarded_ratio(
            "AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY")),
        *_as_is("AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
                "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT",
                "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM", "SK_DPD", "SK_DPD_DEF"),
    )


def installments_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as_is("SK_ID_PREV", "SK_ID_CURR", "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER"),
        *_derived(
            days_since_instalment_due=days_since("DAYS_INSTALMENT"),
            days_since_payment_entered=days_since("DAYS_ENTRY_PAYMENT"),
            days_late=offset_difference("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")),
        *_as_is("AMT_INSTALMENT", "AMT_PAYMENT"),
        *_derived(payment_ratio=guarded_ratio("AMT_PAYMENT", "AMT_INSTALMENT")),
    )


def pos_cash_balance(raw: DataFrame) -> DataFrame:
    return raw.select(*_as_is(
        "SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "NAME_CONTRACT_STATUS", "CNT_INSTALMENT",
        "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"))


def previous_application(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as_is("SK_ID_PREV", "SK_ID_CURR", "NAME_CONTRACT_TYPE", "NAME_CONTRACT_STATUS",
                "NAME_CASH_LOAN_PURPOSE", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON",
                "NAME_CLIENT_TYPE", "NAME_GOODS_CATEGORY", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE",
                "CHANNEL_TYPE", "NAME_SELLER_INDUSTRY", "NAME_YIELD_GROUP", "PRODUCT_COMBINATION",
                "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
                "AMT_GOODS_PRICE"),
        *_derived(
            credit_to_application_ratio=guarded_ratio("AMT_CREDIT", "AMT_APPLICATION"),
            down_payment_rate=guarded_ratio("AMT_DOWN_PAYMENT", "AMT_CREDIT")),
        *_as_is("RATE_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED",
                "CNT_PAYMENT"),
        *_derived(
            days_since_decision=days_since("DAYS_DECISION"),
            **{f"days_since_{e.lower()}": days_since(without_sentinel(f"DAYS_{e}")) for e in (
                "FIRST_DRAWING", "FIRST_DUE", "LAST_DUE_1ST_VERSION", "LAST_DUE", "TERMINATION")}),
        *_as_is("FLAG_LAST_APPL_PER_CONTRACT", "NFLAG_LAST_APPL_IN_DAY",
                "NFLAG_INSURED_ON_APPROVAL", "SELLERPLACE_AREA"),
    )


# Staging model: (function, raw tables it reads).
STAGING = {
    "stg_application": (application, ("application_train", "application_test")),
    "stg_bureau": (bureau, ("bureau",)),
    "stg_bureau_balance": (bureau_balance, ("bureau_balance",)),
    "stg_previous_application": (previous_application, ("previous_application",)),
    "stg_pos_cash_balance": (pos_cash_balance, ("pos_cash_balance",)),
    "stg_credit_card_balance": (credit_card_balance, ("credit_card_balance",)),
    "stg_installments_payments": (installments_payments, ("installments_payments",)),
}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging frames whose raw tables are given."""
    return {
        name: build(*[raw[t] for t in tables])
        for name, (build, tables) in STAGING.items() if all(t in raw for t in tables)
    }
