"""The eight raw applicant tables as projections of the given tables.

Each raw column is an SQL expression both engines understand: customers become applicants,
orders become credits and earlier applications, line items become monthly and instalment rows,
events become card months. Nulls, sentinels, zero denominators, orphans and applicants without
history all occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TRAINING = "c_mktsegment <> 'MACHINERY'"


def _pick(number: str, *values: str | None) -> str:
    """A CASE that spreads values over the remainders of a number."""
    cases = " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE ({number}) % {len(values)} {cases} END"


def _spread(key: str, factor: int, size: int, null_at: int | None = None) -> str:
    value = f"(({key} * {factor}) % {size})"
    return value if null_at is None else f"nullif({value}, {null_at})"


def _double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


# Whole units: their sums are exact in double arithmetic in any order of addition.
_BALANCE = _double("floor(c_acctbal)")
_PRICE = _double("floor(o_totalprice)")
_LINE = _double("floor(l_extendedprice)")
_VALUE = _double("floor(value)")

_APPLICATION = {
    "SK_ID_CURR": "c_custkey",
    "NAME_CONTRACT_TYPE": "CASE WHEN c_nationkey < 5 THEN 'Revolving loans' ELSE 'Cash loans' END",
    "AMT_CREDIT": f"{_BALANCE} * 4", "AMT_ANNUITY": f"{_BALANCE} / 8 + 20",
    "AMT_GOODS_PRICE": f"{_BALANCE} - 100",
    "AMT_INCOME_TOTAL": f"nullif({_double(_spread('c_custkey', 31, 40))}, 7) * 1000",
    "CODE_GENDER": _pick("c_nationkey", "F", "M", "F"),
    "FLAG_OWN_CAR": _pick("c_custkey", "Y", "N"), "FLAG_OWN_REALTY": _pick("c_custkey + c_nationkey", "N", "Y"),
    "NAME_TYPE_SUITE": _pick("c_custkey", "Unaccompanied", "Family", "Spouse, partner", None),
    "NAME_FAMILY_STATUS": _pick("c_nationkey", "Married", "Single", "Widow"),
    "NAME_HOUSING_TYPE": _pick("c_custkey", "House", "Rented", "With parents"),
    "NAME_EDUCATION_TYPE": _pick("c_custkey + 1", "Higher", "Secondary", "Incomplete"),
    "NAME_INCOME_TYPE": "c_mktsegment",
    "OCCUPATION_TYPE": _pick("c_custkey", "Laborers", "Core staff", None, "Managers", "Drivers"),
    "ORGANIZATION_TYPE": _pick("c_nationkey", *[f"Type {i}" for i in range(12)]),
    "WEEKDAY_APPR_PROCESS_START": _pick("c_custkey", "MONDAY", "TUESDAY", "FRIDAY"),
    "HOUR_APPR_PROCESS_START": _spread("c_custkey", 5, 24),
    "CNT_CHILDREN": _spread("c_custkey", 3, 4), "CNT_FAM_MEMBERS": _double(_spread("c_custkey", 3, 6, 5)),
    "DAYS_BIRTH": f"-(8000 + {_spread('c_custkey', 37, 15000)})",
    "DAYS_EMPLOYED": f"CASE WHEN c_nationkey = 3 THEN 365243 WHEN c_nationkey = 4 THEN NULL ELSE -(1 + {_spread('c_custkey', 53, 9000)}) END",
    "DAYS_REGISTRATION": _double(f"-(1 + {_spread('c_custkey', 11, 7000)})"),
    "DAYS_ID_PUBLISH": f"-(1 + {_spread('c_custkey', 17, 6000)})",
    "DAYS_LAST_PHONE_CHANGE": f"-(1 + {_spread('c_custkey', 19, 4000)})",
    "OWN_CAR_AGE": _double(_spread("c_custkey", 7, 25, 3)),
    **{f"EXT_SOURCE_{i}": f"{_double(_spread('c_custkey', 13 * i + 4, 64, 9))} / 64" for i in (1, 2, 3)},
    "REGION_POPULATION_RELATIVE": f"{_double(_spread('c_custkey', 29, 128))} / 64",
    "REGION_RATING_CLIENT": f"1 + {_spread('c_custkey', 1, 3)}",
    "REGION_RATING_CLIENT_W_CITY": f"1 + {_spread('c_custkey', 2, 3)}",
    **{c: _spread(f"(c_custkey + {i})", 3, 2) for i, c in enumerate((
        "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
        "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"))},
    **{c: _spread(f"(c_custkey + {i})", 5, 3, 2 if i == 4 else None) for i, c in enumerate(
        f"FLAG_{c}" for c in ("MOBIL", "EMP_PHONE", "WORK_PHONE", "CONT_MOBILE", "PHONE", "EMAIL"))},
    **{c: _spread(f"(c_custkey + {i})", 1, 2) for i, c in enumerate(
        f"FLAG_DOCUMENT_{i}" for i in range(2, 22))},
    **{c: _double(_spread("c_custkey", 3 + i, 5, 4)) for i, c in enumerate((
        "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
        "DEF_60_CNT_SOCIAL_CIRCLE"))},
    **{f"AMT_REQ_CREDIT_BUREAU_{u}": _double(_spread("c_custkey", 11 + 2 * i, 7, 6)) for i, u in
       enumerate(("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR"))},
    **{c: f"{_double(_spread('c_custkey', 2 * i + 3, 17, i))} / 16" for i, c in enumerate(
        f"{c}_AVG" for c in (
            "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "COMMONAREA", "ELEVATORS",
            "ENTRANCES", "FLOORSMAX", "FLOORSMIN", "LANDAREA", "LIVINGAPARTMENTS", "LIVINGAREA",
            "NONLIVINGAPARTMENTS", "NONLIVINGAREA"))},
    "TOTALAREA_MODE": f"{_double(_spread('c_custkey', 23, 100, 0))} / 64",
    "WALLSMATERIAL_MODE": _pick("c_custkey", "Panel", None, "Stone, brick"),
    "HOUSETYPE_MODE": _pick("c_nationkey", "block of flats", None),
    "FONDKAPREMONT_MODE": _pick("c_custkey", None, None, "reg oper account"),
    "EMERGENCYSTATE_MODE": _pick("c_custkey", "No", "No", None, "Yes"),
}

_STATUS_OF_ORDER = "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END"
_ORDER_DAYS = "((year(o_orderdate) - 2002) * 365 + month(o_orderdate) * 30 - 365 + day(o_orderdate) - 40)"
_SHIP_DAYS = "((year(l_shipdate) - 2002) * 365 + month(l_shipdate) * 30 - 365 + day(l_shipdate) - 40)"

# raw table: (given table, restriction that defines the pool, columns)
RAW: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "application_train": ("customer", TRAINING, {
        **_APPLICATION, "TARGET": _double("CASE WHEN c_acctbal < 2000 THEN 1 ELSE 0 END")}),
    "application_test": ("customer", f"NOT ({TRAINING})", _APPLICATION),
    "bureau": ("orders", None, {
        "SK_ID_BUREAU": "o_orderkey", "SK_ID_CURR": "o_custkey", "CREDIT_ACTIVE": _STATUS_OF_ORDER,
        "CREDIT_CURRENCY": "'currency 1'", "CREDIT_TYPE": "nullif(o_orderpriority, '5-LOW')",
        "DAYS_CREDIT": _ORDER_DAYS, "CREDIT_DAY_OVERDUE": _spread("o_orderkey", 7, 90),
        "DAYS_CREDIT_ENDDATE": _double(f"{_ORDER_DAYS} + 5000"),
        "DAYS_ENDDATE_FACT": _double(f"CASE WHEN o_orderstatus = 'F' THEN {_ORDER_DAYS} END"),
        "DAYS_CREDIT_UPDATE": _ORDER_DAYS, "CNT_CREDIT_PROLONG": _spread("o_orderkey", 3, 5),
        "AMT_CREDIT_MAX_OVERDUE": f"nullif({_double(_spread('o_orderkey', 11, 50))}, 0)",
        "AMT_CREDIT_SUM": f"nullif({_PRICE}, 0)",
        "AMT_CREDIT_SUM_DEBT": f"CASE WHEN o_orderstatus <> 'F' THEN {_PRICE} / 2 END",
        "AMT_CREDIT_SUM_LIMIT": f"CASE WHEN o_orderstatus = 'P' THEN {_PRICE} END",
        "AMT_CREDIT_SUM_OVERDUE": f"CASE WHEN o_orderstatus = 'P' THEN {_PRICE} / 4 ELSE 0 END",
        "AMT_ANNUITY": f"CASE WHEN o_orderstatus = 'O' THEN {_PRICE} / 16 END"}),
    "bureau_balance": ("lineitem", None, {
        "SK_ID_BUREAU": "l_orderkey", "MONTHS_BALANCE": "CAST(-l_linenumber AS BIGINT)",
        "STATUS": "CASE l_returnflag WHEN 'R' THEN CAST(l_linenumber % 6 AS VARCHAR(2)) "
                  "WHEN 'A' THEN 'C' ELSE CASE WHEN l_linestatus = 'O' THEN 'X' ELSE '0' END END"}),
    "previous_application": ("orders", None, {
        "SK_ID_PREV": "o_orderkey", "SK_ID_CURR": "nullif(o_custkey, 5)",
        **{c: _pick("o_orderkey", *v) for c, v in {
            "NAME_CONTRACT_TYPE": ("Cash loans", "Consumer loans", "Revolving loans"),
            "NAME_CONTRACT_STATUS": ("Approved", "Refused", "Approved", "Canceled", "Unused offer"),
            "NAME_CASH_LOAN_PURPOSE": ("XAP", "Repairs", None), "NAME_PAYMENT_TYPE": ("Cash", "XNA"),
            "CODE_REJECT_REASON": ("XAP", "HC"), "NAME_CLIENT_TYPE": ("New", "Repeater", "Refreshed", None),
            "NAME_GOODS_CATEGORY": ("Mobile", "XNA"), "NAME_PORTFOLIO": ("POS", "Cash"),
            "NAME_PRODUCT_TYPE": ("x-sell", "walk-in"), "CHANNEL_TYPE": ("Stone", "Contact center"),
            "NAME_SELLER_INDUSTRY": ("Connectivity", "XNA"), "NAME_YIELD_GROUP": ("low", "high"),
            "PRODUCT_COMBINATION": ("Cash", "POS mobile")}.items()},
        "AMT_ANNUITY": f"{_PRICE} / 32", "AMT_APPLICATION": f"{_double(_spread('o_orderkey', 13, 21))} * 1048576",
        "AMT_CREDIT": f"CASE WHEN o_orderstatus = 'P' THEN 0 ELSE {_PRICE} END",
        "AMT_DOWN_PAYMENT": f"nullif({_double(_spread('o_orderkey', 17, 33))}, 0)",
        "AMT_GOODS_PRICE": f"{_PRICE}", "RATE_DOWN_PAYMENT": f"{_double(_spread('o_orderkey', 17, 33, 0))} / 64",
        "RATE_INTEREST_PRIMARY": "CAST(NULL AS DOUBLE)", "RATE_INTEREST_PRIVILEGED": "CAST(NULL AS DOUBLE)",
        "CNT_PAYMENT": _double(_spread("o_orderkey", 5, 48, 12)),
        "DAYS_DECISION": _ORDER_DAYS, "DAYS_FIRST_DRAWING": "CAST(365243 AS DOUBLE)",
        **{f"DAYS_{e}": _double(f"CASE WHEN o_orderstatus = 'F' THEN 365243 ELSE {_ORDER_DAYS} - {i} END")
           for i, e in enumerate(("FIRST_DUE", "LAST_DUE_1ST_VERSION", "LAST_DUE", "TERMINATION"))},
        "FLAG_LAST_APPL_PER_CONTRACT": "'Y'", "NFLAG_LAST_APPL_IN_DAY": _spread("o_orderkey", 1, 2),
        "NFLAG_INSURED_ON_APPROVAL": _double(_spread("o_orderkey", 1, 3, 2)),
        "SELLERPLACE_AREA": _spread("o_orderkey", 41, 500)}),
    "pos_cash_balance": ("lineitem", None, {
        "SK_ID_PREV": "l_orderkey", "SK_ID_CURR": "l_partkey",
        "MONTHS_BALANCE": "CAST(-l_linenumber AS BIGINT)",
        "NAME_CONTRACT_STATUS": "CASE l_returnflag WHEN 'A' THEN 'Active' WHEN 'R' THEN 'Completed' ELSE 'Signed' END",
        "CNT_INSTALMENT": "nullif(l_quantity, 12)", "CNT_INSTALMENT_FUTURE": "l_quantity - 1",
        "SK_DPD": "greatest(0, l_linenumber - 4)", "SK_DPD_DEF": "nullif(greatest(0, l_linenumber - 5), 2)"}),
    "credit_card_balance": ("events", None, {
        "SK_ID_PREV": _spread("event_id", 7, 211), "SK_ID_CURR": "user_id",
        "MONTHS_BALANCE": "-(1 + event_id % 96)", "NAME_CONTRACT_STATUS": "event_type",
        "AMT_BALANCE": _VALUE, "AMT_CREDIT_LIMIT_ACTUAL": f"{_double(_spread('event_id', 3, 10))} * 1024",
        **{f"AMT_{c}": f"CASE WHEN event_type <> '{t}' THEN {_VALUE} * {m} END" for c, t, m in (
            ("DRAWINGS_ATM_CURRENT", "view", 2), ("DRAWINGS_CURRENT", "click", 3),
            ("DRAWINGS_OTHER_CURRENT", "error", 4), ("DRAWINGS_POS_CURRENT", "signup", 5),
            ("PAYMENT_CURRENT", "view", 6), ("PAYMENT_TOTAL_CURRENT", "purchase", 7),
            ("RECEIVABLE_PRINCIPAL", "view", 8), ("RECIVABLE", "view", 9),
            ("TOTAL_RECEIVABLE", "view", 10))},
        "AMT_INST_MIN_REGULARITY": f"{_double(_spread('event_id', 7, 64))} * 128",
        **{f"CNT_{c}": _spread("event_id", 3 + 2 * i, 5) for i, c in enumerate((
            "DRAWINGS_ATM_CURRENT", "DRAWINGS_CURRENT", "DRAWINGS_OTHER_CURRENT",
            "DRAWINGS_POS_CURRENT", "INSTALMENT_MATURE_CUM"))},
        "SK_DPD": _spread("event_id", 3, 8), "SK_DPD_DEF": _spread("event_id", 5, 6)}),
    "installments_payments": ("lineitem", None, {
        "SK_ID_PREV": "l_orderkey", "SK_ID_CURR": "l_suppkey",
        "NUM_INSTALMENT_VERSION": "CAST(1 AS DOUBLE)", "NUM_INSTALMENT_NUMBER": "l_linenumber",
        "DAYS_INSTALMENT": _double(_SHIP_DAYS),
        "DAYS_ENTRY_PAYMENT": _double(f"{_SHIP_DAYS} + CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber * 9 - 12 END"),
        "AMT_INSTALMENT": f"CASE WHEN l_quantity = 1 THEN 0 ELSE {_LINE} END",
        "AMT_PAYMENT": _double("floor(l_extendedprice * (1 - l_discount))")}),
}


def raw_tables(spark: SparkSession, sf_dir: str, names=tuple(RAW)) -> dict[str, DataFrame]:
    frames = {}
    for name in names:
        given, restriction, columns = RAW[name]
        df = spark.read.parquet(f"{sf_dir}/{given}.parquet")
        df = df.filter(restriction) if restriction else df
        frames[name] = df.selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])
    return frames


def raw_cte(name: str) -> str:
    """The same projection as a named SQL subquery."""
    given, restriction, columns = RAW[name]
    listed = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    where = f" WHERE {restriction}" if restriction else ""
    return f"{name} AS (SELECT {listed} FROM {given}{where})"
