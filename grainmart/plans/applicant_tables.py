"""The eight raw tables of the applicant mart: files, required columns, keys and types."""

from __future__ import annotations

from pyspark.sql import types as T

from grainmart.sources.catalog import TableSpec

_LONG, _TEXT, _DOUBLE = T.LongType(), T.StringType(), T.DoubleType()

# Name patterns of raw columns that are text, whole numbers, and amounts, rates, scores
# or offsets. The last are read as double, which keeps whole and fractional spellings alike.
_TYPES = (
    ("NAME_.*|CODE_.*|FLAG_OWN_(CAR|REALTY)|OCCUPATION_TYPE|ORGANIZATION_TYPE|WEEKDAY_.*", _TEXT),
    ("WALLSMATERIAL_MODE|HOUSETYPE_MODE|FONDKAPREMONT_MODE|EMERGENCYSTATE_MODE", _TEXT),
    ("CREDIT_ACTIVE|CREDIT_CURRENCY|CREDIT_TYPE|STATUS|CHANNEL_TYPE|PRODUCT_COMBINATION", _TEXT),
    ("FLAG_LAST_APPL_PER_CONTRACT", _TEXT),
    ("SK_ID_.*|SK_DPD|SK_DPD_DEF|MONTHS_BALANCE|NUM_INSTALMENT_NUMBER|SELLERPLACE_AREA", _LONG),
    ("CNT_CHILDREN|HOUR_APPR_PROCESS_START|REGION_RATING_.*|REG_.*|LIVE_.*_NOT_.*", _LONG),
    ("FLAG_.*|NFLAG_LAST_APPL_IN_DAY|CREDIT_DAY_OVERDUE|CNT_CREDIT_PROLONG", _LONG),
    ("DAYS_BIRTH|DAYS_ID_PUBLISH|DAYS_CREDIT|DAYS_CREDIT_UPDATE|DAYS_DECISION", _LONG),
    ("TARGET|AMT_.*|RATE_.*|CNT_.*|DAYS_.*|NUM_.*|NFLAG_.*|EXT_SOURCE_.*|(OBS|DEF)_.*", _DOUBLE),
    ("OWN_CAR_AGE|REGION_POPULATION_RELATIVE|TOTALAREA_MODE|.*_(AVG|MODE|MEDI)", _DOUBLE),
)


def _table(name, file_name, required, unique=(), bucket="SK_ID_CURR", description=""):
    return TableSpec(name, file_name, tuple(required), tuple(unique), _TYPES, bucket, description)


# Table and file names, key columns and grains.
RAW_TABLES = (
    _table("application_train", "application_train.csv", ("SK_ID_CURR", "TARGET"),
           ("SK_ID_CURR",), description="One row per labelled application."),
    _table("application_test", "application_test.csv", ("SK_ID_CURR",),
           ("SK_ID_CURR",), description="One row per application to be scored; no TARGET."),
    _table("bureau", "bureau.csv", ("SK_ID_BUREAU", "SK_ID_CURR"),
           ("SK_ID_BUREAU",), "SK_ID_BUREAU", description="One row per credit seen by the bureau."),
    _table("bureau_balance", "bureau_balance.csv", ("SK_ID_BUREAU", "MONTHS_BALANCE"),
           bucket="SK_ID_BUREAU", description="Monthly status of each bureau credit."),
    _table("previous_application", "previous_application.csv", ("SK_ID_PREV", "SK_ID_CURR"),
           description="One row per earlier application."),
    _table("pos_cash_balance", "POS_CASH_balance.csv", ("SK_ID_PREV", "SK_ID_CURR"),
           description="Monthly snapshots of earlier point-of-sale and cash loans."),
    _table("credit_card_balance", "credit_card_balance.csv", ("SK_ID_PREV", "SK_ID_CURR"),
           description="Monthly snapshots of earlier credit cards."),
    _table("installments_payments", "installments_payments.csv", ("SK_ID_PREV", "SK_ID_CURR"),
           description="Repayments of earlier credits."),
)
