"""Rollups, mart and data-quality rules of the applicant tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from grainmart.functions.measures import (
    average, count_where, distinct_count, maximum, minimum, rate_where, ratio_of_totals, row_count,
    total,
)
from grainmart.operators.quality import (
    Contract, RowRule, TableRules, accepted_values, check_tables, label_matches_split, not_null,
)
from grainmart.operators.rollup import Rollup, enrich, feature_mart

KEY = "sk_id_curr"
MART = "mart_applicant_features"

# Fixed values below: names of the measures, and the column or condition each one summarises.
BUREAU_MONTHS = Rollup("sk_id_bureau", (
    row_count("bb_months_count"),
    minimum("bb_months_balance_min", "months_balance"),
    rate_where("bb_dpd_rate", "is_dpd"),
    rate_where("bb_closed_rate", "status = 'C'"),
    rate_where("bb_unknown_rate", "status = 'X'"),
    maximum("bb_max_dpd_status", "status_numeric"),
))

BUREAU = Rollup(KEY, (
    row_count("bureau_count").or_zero(),
    distinct_count("bureau_credit_types_count", "credit_type"),
    count_where("bureau_active_count", "credit_active = 'Active'").or_zero(),
    count_where("bureau_closed_count", "credit_active = 'Closed'").or_zero(),
    average("bureau_days_since_credit_applied_avg", "days_since_credit_applied"),
    minimum("bureau_days_since_credit_applied_min", "days_since_credit_applied"),
    maximum("bureau_credit_day_overdue_max", "credit_day_overdue"),
    total("bureau_cnt_credit_prolong_sum", "cnt_credit_prolong").or_zero(),
    total("bureau_amt_credit_sum_total", "amt_credit_sum"),
    total("bureau_amt_credit_sum_debt_total", "amt_credit_sum_debt"),
    total("bureau_amt_credit_sum_overdue_total", "amt_credit_sum_overdue"),
    ratio_of_totals("bureau_debt_to_credit_ratio", "amt_credit_sum_debt", "amt_credit_sum"),
    ratio_of_totals("bureau_overdue_to_credit_ratio", "amt_credit_sum_overdue", "amt_credit_sum"),
    average("bureau_bb_months_count_avg", "bb_months_count"),
    average("bureau_bb_dpd_rate_avg", "bb_dpd_rate"),
    maximum("bureau_bb_max_dpd_status_max", "bb_max_dpd_status"),
), "has_bureau_history")

PREVIOUS = Rollup(KEY, (
    row_count("prev_app_count").or_zero(),
    count_where("prev_app_approved_count", "contract_status = 'Approved'").or_zero(),
    count_where("prev_app_refused_count", "contract_status = 'Refused'").or_zero(),
    count_where("prev_app_canceled_count", "contract_status = 'Canceled'").or_zero(),
    rate_where("prev_app_approval_rate", "contract_status = 'Approved'"),
    average("prev_app_amt_credit_avg", "amt_credit"),
    average("prev_app_amt_annuity_avg", "amt_annuity"),
    average("prev_app_amt_application_avg", "amt_application"),
    average("prev_app_credit_to_application_ratio_avg", "credit_to_application_ratio"),
    average("prev_app_down_payment_rate_avg", "down_payment_rate"),
    average("prev_app_cnt_payment_avg", "cnt_payment"),
    minimum("prev_app_days_since_decision_min", "days_since_decision"),
    maximum("prev_app_days_since_decision_max", "days_since_decision"),
    count_where("prev_app_new_client_count", "client_type = 'New'").or_zero(),
), "has_previous_application_history")

POS_CASH = Rollup(KEY, (
    row_count("pos_records_count").or_zero(),
    distinct_count("pos_distinct_prev_count", "sk_id_prev").or_zero(),
    count_where("pos_completed_count", "contract_status = 'Completed'").or_zero(),
    count_where("pos_active_count", "contract_status = 'Active'").or_zero(),
    average("pos_cnt_instalment_avg", "cnt_instalment"),
    minimum("pos_months_balance_min", "months_balance"),
    maximum("pos_dpd_max", "dpd"),
    average("pos_dpd_avg", "dpd"),
    maximum("pos_dpd_def_max", "dpd_def"),
    rate_where("pos_dpd_rate", "dpd > 0"),
), "has_pos_cash_history")

CREDIT_CARD = Rollup(KEY, (
    row_count("cc_records_count").or_zero(),
    distinct_count("cc_distinct_prev_count", "sk_id_prev").or_zero(),
    average("cc_amt_balance_avg", "amt_balance"),
    maximum("cc_amt_balance_max", "amt_balance"),
    average("cc_credit_limit_avg", "amt_credit_limit_actual"),
    average("cc_utilization_avg", "utilization"),
    maximum("cc_utilization_max", "utilization"),
    average("cc_amt_drawings_atm_avg", "amt_drawings_atm_current"),
    average("cc_amt_drawings_avg", "amt_drawings_current"),
    average("cc_amt_payment_total_avg", "amt_payment_total_current"),
    average("cc_min_payment_ratio_avg", "min_payment_ratio"),
    count_where("cc_underpaid_months_count", "min_payment_ratio < 1").or_zero(),
    minimum("cc_months_balance_min", "months_balance"),
    maximum("cc_dpd_max", "dpd"),
    average("cc_dpd_avg", "dpd"),
    maximum("cc_dpd_def_max", "dpd_def"),
), "has_credit_card_history")

INSTALMENTS = Rollup(KEY, (
    row_count("inst_payments_count").or_zero(),
    distinct_count("inst_distinct_prev_count", "sk_id_prev").or_zero(),
    average("inst_days_late_avg", "days_late"),
    maximum("inst_days_late_max", "days_late"),
    rate_where("inst_late_payment_rate", "days_late > 0"),
    rate_where("inst_severely_late_payment_rate", "days_late > 30"),
    average("inst_payment_ratio_avg", "payment_ratio"),
    rate_where("inst_underpayment_rate", "payment_ratio < 0.99D"),
    total("inst_amt_instalment_sum", "amt_instalment"),
    total("inst_amt_payment_sum", "amt_payment"),
), "has_installments_history")

SOURCES = (
    ("int_bureau_agg", BUREAU), ("int_previous_application_agg", PREVIOUS),
    ("int_pos_cash_agg", POS_CASH), ("int_credit_card_agg", CREDIT_CARD),
    ("int_installments_agg", INSTALMENTS),
)

# Every measure that defaults to zero, plus nothing else: other counts may be null.
CONTRACT = Contract(
    KEY, "target", "is_train",
    tuple(m.name for _, rollup in SOURCES for m in rollup.measures if m.zero_default))


# Rollup: (measures, staging models it reads).
ROLLUPS = {
    "int_bureau_balance_agg": (BUREAU_MONTHS, ("stg_bureau_balance",)),
    "int_bureau_agg": (BUREAU, ("stg_bureau", "stg_bureau_balance")),
    "int_previous_application_agg": (PREVIOUS, ("stg_previous_application",)),
    "int_pos_cash_agg": (POS_CASH, ("stg_pos_cash_balance",)),
    "int_credit_card_agg": (CREDIT_CARD, ("stg_credit_card_balance",)),
    "int_installments_agg": (INSTALMENTS, ("stg_installments_payments",)),
}


def roll_up(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The rollups whose staging models are given. Bureau months are rolled up to the credit
    first and then travel with it."""
    rolled = {}
    for name, (rollup, (child, *_)) in ROLLUPS.items():
        if not all(t in staged for t in ROLLUPS[name][1]):
            continue
        rows = staged[child]
        if name == "int_bureau_agg":
            months = rolled["int_bureau_balance_agg"]
            rows = enrich(rows, months, BUREAU_MONTHS.key, BUREAU_MONTHS.names)
        rolled[name] = rollup.apply(rows)
    return rolled


def build_mart(applications: DataFrame, rolled: Mapping[str, DataFrame]) -> DataFrame:
    return feature_mart(applications, [(rollup, rolled[name]) for name, rollup in SOURCES], KEY)


# Which declared rules hold for which table. A triple is (child table, key, parent).
UNIQUE_KEYS = {
    "stg_application": KEY, "stg_bureau": "sk_id_bureau", "stg_previous_application": "sk_id_prev",
    "int_bureau_balance_agg": "sk_id_bureau", **{name: KEY for name, _ in SOURCES}, MART: KEY,
}
FILLED_KEYS = {
    "stg_bureau": (KEY,), "stg_bureau_balance": ("sk_id_bureau",),
    "stg_previous_application": (KEY,), "stg_pos_cash_balance": ("sk_id_prev",),
    "stg_credit_card_balance": ("sk_id_prev",), "stg_installments_payments": ("sk_id_prev",),
    MART: ("bureau_count", "prev_app_count", "pos_records_count", "cc_records_count",
           "inst_payments_count"),
}
RELATIONSHIPS = (
    ("stg_bureau", KEY, "stg_application"),
    ("stg_bureau_balance", "sk_id_bureau", "stg_bureau"),
    ("stg_previous_application", KEY, "stg_application"),
    ("stg_pos_cash_balance", "sk_id_prev", "stg_previous_application"),
    ("stg_credit_card_balance", "sk_id_prev", "stg_previous_application"),
    ("stg_installments_payments", "sk_id_prev", "stg_previous_application"),
)


def _row_rules(table: str) -> list[RowRule]:
    filled = [*([UNIQUE_KEYS[table]] if table in UNIQUE_KEYS else []), *FILLED_KEYS.get(table, ())]
    rules = [not_null(c) for c in dict.fromkeys(filled)]
    if table in ("stg_application", MART):
        rules.append(accepted_values("target", (0, 1), where="is_train"))
    if table == MART:
        rules.append(label_matches_split("target", "is_train"))
    return rules


def declared_rules(table: str) -> TableRules:
    rows = tuple(_row_rules(table))
    parents = tuple((key, parent, key) for child, key, parent in RELATIONSHIPS if child == table)
    return TableRules(rows[0].column, rows, UNIQUE_KEYS.get(table), parents)


def declared_rules_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule of every given table, with its failures: each table is read once."""
    return check_tables(tables, {name: declared_rules(name) for name in tables if _row_rules(name)})
