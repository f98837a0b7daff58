"""Queries that bind the operators to the commerce and document tables, and their oracle SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.functions import scalar
from grainmart.functions.measures import (
    average, count_where, distinct_count, maximum, minimum, rate_where, ratio_of_totals, row_count,
    total,
)
from grainmart.operators import metrics, quality, split
from grainmart.operators.features import class_counts
from grainmart.operators.quality import accepted_values, label_matches_split
from grainmart.operators.rollup import (
    Rollup, enrich, feature_mart, split_pools, union_all, union_pools,
)
from grainmart.operators.score import absent_ids, lookup, lookup_requests, score_records
from workload.applicant import rounded, settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ cleaning expressions

def stg_orders_clean(spark, sf_dir):
    offset = F.datediff("o_orderdate", F.lit("2001-08-02"))
    priority = scalar.digit_or_null(F.substring("o_orderpriority", 1, 1))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        scalar.guarded_ratio("o_totalprice", "o_custkey").alias("price_per_custkey"),
        scalar.days_since(offset).alias("days_since_order"),
        scalar.years_since(offset).alias("years_since_order"),
        priority.alias("priority"),
        scalar.without_sentinel(priority, 5).alias("known_priority"),
        scalar.is_sentinel(priority, 5).alias("is_low_priority"),
        scalar.is_one_of("o_orderstatus", ["O", "P"]).alias("is_running"),
        scalar.offset_difference(offset, -priority).alias("shifted_offset"),
        scalar.digit_or_null("o_orderpriority").alias("whole_text_digit"),
        scalar.rendered(scalar.without_sentinel(priority, 5)).alias("priority_text"),
    )


def stg_customer_flags(spark, sf_dir):
    flags = {
        "good_balance": F.nullif(F.when(F.col("c_acctbal") > 5000, 1).otherwise(0),
                                 F.when(F.col("c_nationkey") == 7, 1).otherwise(2)),
        "first_nations": F.when(F.col("c_nationkey") < 10, 1).when(F.col("c_nationkey") < 20, 0),
        "building": F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0),
    }
    names = list(flags)
    return rounded(table(spark, sf_dir, "customer").withColumns(flags).select(
        "c_custkey", F.lit(True).alias("is_customer"), scalar.typed_null("long").alias("target"),
        scalar.strict_sum(names).alias("all_flags"),
        scalar.zero_filled_mean(names).alias("mean_flag"),
        scalar.missing_share(names).alias("missing_flags"),
        scalar.is_one_of("c_mktsegment", ["BUILDING", "FURNITURE"]).alias("in_segment"),
        scalar.is_sentinel("first_nations", 0).alias("is_later_nation"),
        scalar.normalise_nan(F.when(F.col("c_nationkey") == 3, F.lit(float("nan")))
                             .otherwise(F.col("c_acctbal"))).alias("balance"),
    ))


# ------------------------------------------------------------------ rollups and mart

LINES = Rollup("l_orderkey", (
    row_count("line_count"), minimum("first_line", "l_linenumber"),
    rate_where("returned_rate", "l_returnflag = 'R'"),
    rate_where("accepted_rate", "l_returnflag = 'A'"),
    rate_where("open_rate", "l_linestatus = 'O'"),
    maximum("max_quantity", "l_quantity"), total("quantity_total", "l_quantity"),
))
ORDERS = Rollup("c_custkey", (
    row_count("order_count").or_zero(), distinct_count("priority_count", "o_orderpriority"),
    count_where("open_order_count", "o_orderstatus = 'O'").or_zero(),
    count_where("partial_order_count", "o_orderstatus = 'P'").or_zero(),
    average("price_avg", "price"), minimum("price_min", "price"), maximum("price_max", "price"),
    total("price_total", "price"), total("lines_total", "line_count").or_zero(),
    ratio_of_totals("open_price_ratio", "open_price", "price"),
    ratio_of_totals("zero_price_ratio", "price", "no_price"),
    average("lines_per_order_avg", "line_count"), average("returned_rate_avg", "returned_rate"),
    maximum("max_quantity_max", "max_quantity"),
), "has_order_history")
EVENTS = Rollup("c_custkey", (
    row_count("event_count").or_zero(), distinct_count("event_type_count", "event_type").or_zero(),
    count_where("purchase_count", "event_type = 'purchase'").or_zero(),
    rate_where("error_rate", "event_type = 'error'"),
    rate_where("high_value_rate", "nullif(value, 100) > 50"),
    average("event_value_avg", "value"), maximum("event_value_max", "value"),
    average("purchase_value_avg", "CASE WHEN event_type = 'purchase' THEN value END"),
), "has_event_history")


def _orders(spark, sf_dir):
    price = F.floor("o_totalprice").cast("double")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority",
        price.alias("price"), F.when(F.col("o_orderstatus") == "O", price).alias("open_price"),
        F.lit(0.0).alias("no_price"))


def lineitem_rollup(spark, sf_dir):
    return rounded(LINES.apply(table(spark, sf_dir, "lineitem")))


def _order_history(spark, sf_dir):
    lines = LINES.apply(table(spark, sf_dir, "lineitem")).withColumnRenamed("l_orderkey", "o_orderkey")
    return ORDERS.apply(enrich(_orders(spark, sf_dir), lines, "o_orderkey",
                               ["line_count", "returned_rate", "max_quantity"]))


def order_line_enrichment(spark, sf_dir):
    """Orders with the measures of their lines; orders without lines stay."""
    lines = LINES.apply(table(spark, sf_dir, "lineitem")).withColumnRenamed("l_orderkey", "o_orderkey")
    return rounded(enrich(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines,
                          "o_orderkey", LINES.names))


def order_two_level_rollup(spark, sf_dir):
    return settled(_order_history(spark, sf_dir))


def _event_history(spark, sf_dir):
    return EVENTS.apply(table(spark, sf_dir, "events").select(
        F.col("user_id").alias("c_custkey"), "event_type", F.floor("value").cast("double").alias("value")))


def event_rollup(spark, sf_dir):
    return settled(_event_history(spark, sf_dir))


def customer_mart(spark, sf_dir):
    spine = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment",
        scalar.guarded_ratio("c_nationkey", F.floor("c_acctbal")).alias("nation_per_balance"))
    return feature_mart(spine, [(ORDERS, _order_history(spark, sf_dir)),
                                (EVENTS, _event_history(spark, sf_dir))], "c_custkey")


def mart_customer_features(spark, sf_dir):
    return settled(customer_mart(spark, sf_dir))


def document_pool(spark, sf_dir):
    """Documents as one pool: labelled ones train, the others are to be scored."""
    return labelled(spark, sf_dir, table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars"))


def labelled(spark, sf_dir, documents):
    """Documents with their split flag and label: one scan of them, one join."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("target"), F.lit(True).alias("is_train"))
    return documents.join(labels, "doc_id", "left").withColumn(
        "is_train", F.coalesce("is_train", F.lit(False)))


def pool_union_by_name(spark, sf_dir):
    """Two tables of different columns, one labelled and one not, as one pool."""
    pool = document_pool(spark, sf_dir)
    return union_pools(pool.filter("is_train").drop("is_train"),
                       pool.filter("NOT is_train").drop("is_train", "target"), "target", "is_train")


def scoring_pool(spark, sf_dir):
    return split_pools(document_pool(spark, sf_dir), "is_train")[1].select("doc_id", "lang", "n_chars")


def pool_id_list(spark, sf_dir):
    """The sorted ids of the scoring pool."""
    return split_pools(document_pool(spark, sf_dir), "is_train")[1].select("doc_id").orderBy("doc_id")


# ------------------------------------------------------------------ data quality

def dq_null_counts(spark, sf_dir):
    mart = customer_mart(spark, sf_dir)
    return quality.null_counts(mart, mart.columns)


def dq_not_empty(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return union_all([
        quality.check_not_empty(lines).withColumn("table", F.lit("lineitem")),
        quality.check_not_empty(lines.filter("l_quantity < 0")).withColumn("table", F.lit("empty"))])


def dq_required_columns(spark, sf_dir):
    """Required columns exist and are filled. Spelling counts: another case is absent."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    required = ["o_orderkey", "O_CUSTKEY", "o_comment", "o_orderpriority"]
    filled = [quality.not_null(c) for c in required if c in orders.columns]
    return union_all([quality.check_schema(orders, required),
                      quality.check_rows(orders, filled, "o_orderkey")])


def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_unique(spark, sf_dir):
    return union_all([
        quality.check_unique(table(spark, sf_dir, "orders"), ["o_orderkey"]),
        quality.check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])])


def dq_orphan_keys(spark, sf_dir):
    return quality.orphan_keys(table(spark, sf_dir, "lineitem"), "l_partkey",
                               table(spark, sf_dir, "customer"), "c_custkey")


def dq_relationships(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return union_all([
        quality.check_relationship(lines, "l_orderkey", orders, "o_orderkey"),
        quality.check_relationship(orders, "o_custkey", customers, "c_custkey"),
        quality.check_relationship(lines, "l_partkey", customers, "c_custkey")])


def dq_accepted_values(spark, sf_dir):
    return quality.check_rows(table(spark, sf_dir, "orders"), [
        accepted_values("o_orderstatus", ["F", "O"]),
        accepted_values("o_orderstatus", ["F", "O"], where="o_totalprice > 400000"),
        accepted_values("o_orderstatus", ["F", "O", "P"])], "o_orderkey")


def dq_label_consistency(spark, sf_dir):
    """Rows of a pool whose label does not match the split: French labels are taken away."""
    pool = document_pool(spark, sf_dir).withColumn(
        "target", F.when(F.col("lang") != "fr", F.col("target")))
    return quality.violating_rows(pool, [label_matches_split("target", "is_train")], "doc_id").select(
        "doc_id", "rule", "column")


# ------------------------------------------------------------------ splits and metrics

def scored_labels(spark, sf_dir):
    """Labelled documents with two scores that any engine computes alike."""
    labels = table(spark, sf_dir, "labels")
    n = F.col("n_chars").cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(labels, "doc_id").select(
        "doc_id", "quality", "toxic", (n / (n + 1500.0)).alias("score"),
        (F.col("n_chars") % 97).cast("double").alias("coarse")).withColumn("coarse", F.col("coarse") / 97.0)


def stratified_folds(spark, sf_dir):
    return split.stratified_folds(
        table(spark, sf_dir, "labels"), "doc_id", "quality", 5, 42).select("doc_id", "quality", "fold")


def stratified_holdout(spark, sf_dir):
    return split.stratified_holdout(
        table(spark, sf_dir, "labels"), "doc_id", "quality", 0.15, 42).select("doc_id", "is_holdout")


def seeded_sample(spark, sf_dir):
    return split.seeded_sample(
        table(spark, sf_dir, "documents"), "doc_id", 150, 7).select("doc_id", "n_chars")


def class_weights(spark, sf_dir):
    return rounded(class_counts(table(spark, sf_dir, "labels"), "quality"))


def label_rate(spark, sf_dir):
    return rounded(document_pool(spark, sf_dir).agg(F.avg("target").alias("label_rate")))


def rank_metrics(spark, sf_dir):
    return rounded(metrics.rank_metrics(scored_labels(spark, sf_dir), "score", "quality"))


def rank_metrics_by_fold(spark, sf_dir):
    """One pass over all folds of all models."""
    folded = split.stratified_folds(scored_labels(spark, sf_dir), "doc_id", "quality", 5, 42)
    long = folded.select("fold", "quality", "score", "coarse").unpivot(
        ["fold", "quality"], ["score", "coarse"], "model", "probability")
    return rounded(metrics.rank_metrics(long, "probability", "quality", ["model", "fold"]))


def metric_comparison(spark, sf_dir):
    return rounded(metrics.compare_scores(
        scored_labels(spark, sf_dir), {"smooth": "score", "coarse": "coarse"}, "toxic"))


def _fold_metrics(spark, sf_dir):
    folded = split.stratified_folds(scored_labels(spark, sf_dir), "doc_id", "quality", 5, 42)
    long = folded.select("fold", "quality", "score", "coarse").unpivot(
        ["fold", "quality"], ["score", "coarse"], "model", "probability")
    return metrics.rank_metrics(long, "probability", "quality", ["model", "fold"])


def cv_summary(spark, sf_dir):
    return rounded(metrics.cv_summary(_fold_metrics(spark, sf_dir)))


def champion_pick(spark, sf_dir):
    return metrics.champion(
        metrics.cv_summary(_fold_metrics(spark, sf_dir)), ["coarse", "score"]).select("model")


def reliability_bins(spark, sf_dir):
    return rounded(metrics.reliability_bins(scored_labels(spark, sf_dir), "score", "quality"))


def reliability_comparison(spark, sf_dir):
    return rounded(metrics.reliability_comparison(
        scored_labels(spark, sf_dir), {"smooth": "score", "coarse": "coarse"}, "quality", 8))


def exact_quantiles(spark, sf_dir):
    """Exact quantiles of several columns over all line items."""
    from grainmart.operators.ordered import exact_quantiles as quantiles

    columns, at = ["l_quantity", "l_extendedprice", "l_partkey"], [0.0, 0.1, 0.5, 0.9, 1.0]
    found = quantiles(table(spark, sf_dir, "lineitem"), columns, at)
    return spark.createDataFrame(
        [(c, q, round(v, 6)) for c in columns for q, v in zip(at, found[c])],
        "feature string, q double, value double")


# ------------------------------------------------------------------ lookups and records

def keyed_lookup(spark, sf_dir):
    return lookup(table(spark, sf_dir, "orders"), "o_orderkey", [1, 7, 32, 999999999]).select(
        "o_orderkey", "o_custkey", "o_orderstatus")


def requested_rows(spark, sf_dir):
    """A request per event: many repeat, and the later half of them are not customers."""
    requests = table(spark, sf_dir, "events").select((F.col("user_id") * 20).alias("c_custkey"))
    return settled(lookup_requests(customer_mart(spark, sf_dir), requests, "c_custkey").select(
        "c_custkey", "found", "c_mktsegment", "order_count", "event_value_avg"))


def absent_requests(spark, sf_dir):
    requests = table(spark, sf_dir, "events").select((F.col("user_id") * 20).alias("c_custkey"))
    return absent_ids(table(spark, sf_dir, "customer"), requests, "c_custkey")


def risk_tiers(spark, sf_dir):
    scored = scored_labels(spark, sf_dir)
    return rounded(scored.select(
        "doc_id", "score", scalar.risk_tier("score").alias("risk_tier"),
        scalar.risk_tier(F.when(F.col("toxic") == 0, F.col("coarse"))).alias("coarse_tier")))


def score_record_table(spark, sf_dir):
    n = F.col("n_chars").cast("double")
    pool = document_pool(spark, sf_dir).withColumn("probability", n / (n + 1500.0))
    return rounded(score_records(pool, "doc_id", "is_train", "target"))


QUERIES = {f.__name__: f for f in (
    stg_orders_clean, stg_customer_flags, lineitem_rollup, order_line_enrichment,
    order_two_level_rollup, event_rollup, mart_customer_features, pool_union_by_name, scoring_pool,
    pool_id_list, dq_null_counts, dq_not_empty, dq_required_columns, dq_duplicate_keys, dq_unique,
    dq_orphan_keys, dq_relationships, dq_accepted_values, dq_label_consistency, stratified_folds,
    stratified_holdout, seeded_sample, class_weights, label_rate, rank_metrics,
    rank_metrics_by_fold, metric_comparison, cv_summary, champion_pick, reliability_bins,
    reliability_comparison, exact_quantiles, keyed_lookup, requested_rows, absent_requests,
    risk_tiers, score_record_table)}

# ---------------------------------------------------------------------------------- oracle SQL


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


_LINES = """lines AS (SELECT l_orderkey, count(*) AS line_count, min(l_linenumber) AS first_line,
  count(*) FILTER (WHERE l_returnflag = 'R') / CAST(count(*) AS DOUBLE) AS returned_rate,
  count(*) FILTER (WHERE l_returnflag = 'A') / CAST(count(*) AS DOUBLE) AS accepted_rate,
  count(*) FILTER (WHERE l_linestatus = 'O') / CAST(count(*) AS DOUBLE) AS open_rate,
  max(l_quantity) AS max_quantity, sum(l_quantity) AS quantity_total FROM lineitem GROUP BY 1)"""
_LINE_COLUMNS = ("line_count, first_line, round(returned_rate, 6) AS returned_rate, "
                 "round(accepted_rate, 6) AS accepted_rate, round(open_rate, 6) AS open_rate, "
                 "max_quantity, quantity_total")
_ORDER_HISTORY = _LINES + """, order_history AS (SELECT o_custkey AS c_custkey, count(*) AS order_count,
  count(DISTINCT o_orderpriority) AS priority_count,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS open_order_count,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS partial_order_count,
  avg(floor(o_totalprice)) AS price_avg, min(floor(o_totalprice)) AS price_min,
  max(floor(o_totalprice)) AS price_max, sum(floor(o_totalprice)) AS price_total,
  CAST(sum(line_count) AS BIGINT) AS lines_total,
  sum(floor(o_totalprice)) FILTER (WHERE o_orderstatus = 'O') / sum(floor(o_totalprice)) AS open_price_ratio,
  CAST(NULL AS DOUBLE) AS zero_price_ratio, avg(line_count) AS lines_per_order_avg,
  round(avg(returned_rate), 10) AS returned_rate_avg, max(max_quantity) AS max_quantity_max
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey GROUP BY 1)"""
_EVENT_HISTORY = """event_history AS (SELECT user_id AS c_custkey, count(*) AS event_count,
  count(DISTINCT event_type) AS event_type_count,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
  count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE) AS error_rate,
  count(*) FILTER (WHERE floor(value) > 50 AND floor(value) <> 100) / CAST(count(*) AS DOUBLE) AS high_value_rate,
  avg(floor(value)) AS event_value_avg, max(floor(value)) AS event_value_max,
  avg(floor(value)) FILTER (WHERE event_type = 'purchase') AS purchase_value_avg
  FROM events GROUP BY 1)"""
_ZERO = ("order_count", "open_order_count", "partial_order_count", "lines_total", "event_count",
         "event_type_count", "purchase_count")
_MART = f"""{_ORDER_HISTORY}, {_EVENT_HISTORY}, mart AS (SELECT c.c_custkey, c_nationkey, c_mktsegment,
  CASE WHEN floor(c_acctbal) > 0 THEN CAST(c_nationkey AS DOUBLE) / floor(c_acctbal) END AS nation_per_balance,
  {", ".join(f"ifnull({c}, 0) AS {c}" for c in _ZERO)},
  priority_count, price_avg, price_min, price_max, price_total, open_price_ratio, zero_price_ratio,
  lines_per_order_avg, returned_rate_avg, max_quantity_max, o.c_custkey IS NOT NULL AS has_order_history,
  error_rate, high_value_rate, event_value_avg, event_value_max, purchase_value_avg,
  e.c_custkey IS NOT NULL AS has_event_history
  FROM customer c LEFT JOIN order_history o ON o.c_custkey = c.c_custkey
  LEFT JOIN event_history e ON e.c_custkey = c.c_custkey)"""
_MART_COLUMNS = (
    "c_custkey", "c_nationkey", "c_mktsegment", "nation_per_balance", *_ZERO, "priority_count",
    "price_avg", "price_min", "price_max", "price_total", "open_price_ratio", "zero_price_ratio",
    "lines_per_order_avg", "returned_rate_avg", "max_quantity_max", "has_order_history",
    "error_rate", "high_value_rate", "event_value_avg", "event_value_max", "purchase_value_avg",
    "has_event_history")
_POOL = """pool AS (SELECT d.doc_id, lang, source, n_chars, CAST(quality AS DOUBLE) AS target,
  l.doc_id IS NOT NULL AS is_train FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
_SCORED = """scored AS (SELECT doc_id, quality, toxic,
  CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(1500 AS DOUBLE)) AS score,
  CAST(n_chars % 97 AS DOUBLE) / CAST(97 AS DOUBLE) AS coarse
  FROM documents JOIN labels USING (doc_id))"""


def _ranked(key: str, seed: int, by: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (f"row_number() OVER ({part}ORDER BY md5(CAST({key} AS VARCHAR) || ':{seed}'), {key}) - 1")


def _metric_sql(source: str, by: str, score: str, label: str) -> str:
    """Metrics by pair counting over score groups, independent of running totals by slice."""
    part = f"PARTITION BY {by}" if by else ""
    lead, using = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""curve AS (SELECT {lead}s, n, p,
    sum(p) OVER (w ROWS UNBOUNDED PRECEDING) AS tp, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS c,
    sum(p) OVER ({part}) AS pos, sum(n) OVER ({part}) AS cnt FROM (
      SELECT {lead}{score} AS s, count(*) AS n, count(*) FILTER (WHERE {label} = 1) AS p
      FROM {source} GROUP BY ALL) WINDOW w AS ({part} ORDER BY s DESC)),
  measured AS (SELECT {lead}CAST(any_value(cnt) AS BIGINT) AS n_rows, CAST(any_value(pos) AS BIGINT) AS n_positive,
    sum(CAST(n - p AS DOUBLE) * (tp - p / CAST(2 AS DOUBLE)) / (CAST(pos AS DOUBLE) * (cnt - pos))) AS roc_auc,
    sum((CAST(p AS DOUBLE) / pos) * (CAST(tp AS DOUBLE) / c)) AS pr_auc,
    greatest(0, max(CAST(tp AS DOUBLE) / pos - CAST(c - tp AS DOUBLE) / (cnt - pos))) AS ks_statistic,
    sum(p * (1 - s) * (1 - s) + (n - p) * s * s) / sum(n) AS brier_score FROM curve {using})"""


def _rounded_metrics(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return (f"SELECT {lead}n_rows, n_positive, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, "
            "round(ks_statistic, 6) AS ks_statistic, round(brier_score, 6) AS brier_score FROM measured")


_FOLDED = f"""folded AS (SELECT doc_id, quality, score, coarse, CAST(floor({_ranked('doc_id', 42, 'quality')}) AS BIGINT)
    * 5 // count(*) OVER (PARTITION BY quality) AS fold FROM scored)"""
_BY_FOLD = f"""WITH {_SCORED}, {_FOLDED}, long AS (
    SELECT 'score' AS model, fold, quality, score AS probability FROM folded UNION ALL
    SELECT 'coarse', fold, quality, coarse FROM folded),
  {_metric_sql('long', 'model, fold', 'probability', 'quality')}"""


def _bins_sql(score: str, bins: int, model: str | None = None) -> str:
    edges = ", ".join(f"(SELECT quantile_cont({score}, CAST({i} AS DOUBLE) / {bins}) FROM scored)"
                      for i in range(1, bins))
    named = f", '{model}' AS model" if model else ""
    return (f"SELECT bin, count(*) AS n_rows, {r6('avg(s)')} AS mean_predicted, "
            f"{r6('avg(quality)')} AS observed_rate{named} FROM (SELECT quality, {score} AS s, "
            f"len(list_filter([{edges}], lambda e: e < {score})) AS bin FROM scored) GROUP BY bin")


def _rule(rule, column, violation, source, key):
    return (f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) AS failures, "
            f"CAST(min({key}) AS VARCHAR) AS sample FROM {source} WHERE {violation}")


ORACLE = {
    "stg_orders_clean": f"""
      WITH o AS (SELECT *, date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS d,
        CAST(left(o_orderpriority, 1) AS INT) AS p FROM orders)
      SELECT o_orderkey AS order_key,
        CASE WHEN o_custkey > 0 THEN o_totalprice / o_custkey END AS price_per_custkey,
        -d AS days_since_order, -d / CAST(365.25 AS DOUBLE) AS years_since_order, p AS priority,
        nullif(p, 5) AS known_priority, p = 5 AS is_low_priority,
        o_orderstatus IN ('O', 'P') AS is_running, d + p AS shifted_offset,
        CAST(NULL AS INT) AS whole_text_digit, CAST(nullif(p, 5) AS VARCHAR) AS priority_text FROM o""",
    "stg_customer_flags": f"""
      WITH f AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN CASE WHEN c_nationkey = 7 THEN NULL ELSE 1 END ELSE 0 END AS a,
        CASE WHEN c_nationkey < 10 THEN 1 WHEN c_nationkey < 20 THEN 0 END AS b,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c FROM customer)
      SELECT c_custkey, true AS is_customer, CAST(NULL AS BIGINT) AS target, a + b + c AS all_flags,
        {r6('(ifnull(a, 0) + ifnull(b, 0) + ifnull(c, 0)) / CAST(3 AS DOUBLE)')} AS mean_flag,
        {r6('(CAST(a IS NULL AS INT) + CAST(b IS NULL AS INT) + CAST(c IS NULL AS INT)) / CAST(3 AS DOUBLE)')} AS missing_flags,
        c_mktsegment IN ('BUILDING', 'FURNITURE') AS in_segment, b IS NOT DISTINCT FROM 0 AS is_later_nation,
        CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance FROM f""",
    "lineitem_rollup": f"WITH {_LINES} SELECT l_orderkey, {_LINE_COLUMNS} FROM lines",
    "order_line_enrichment": f"WITH {_LINES} SELECT o_orderkey, o_custkey, {_LINE_COLUMNS} "
    "FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey",
    "order_two_level_rollup": f"WITH {_ORDER_HISTORY} SELECT * FROM order_history",
    "event_rollup": f"WITH {_EVENT_HISTORY} SELECT * FROM event_history",
    "mart_customer_features": f"WITH {_MART} SELECT * FROM mart",
    "pool_union_by_name": f"WITH {_POOL} SELECT * FROM pool",
    "scoring_pool": f"WITH {_POOL} SELECT doc_id, lang, n_chars FROM pool WHERE NOT is_train",
    "pool_id_list": f"WITH {_POOL} SELECT doc_id FROM pool WHERE NOT is_train ORDER BY doc_id",
    "dq_null_counts": f"WITH {_MART} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null FROM mart"
        for c in _MART_COLUMNS),
    "dq_not_empty": """SELECT 'not_empty' AS rule, '*' AS "column", CAST((SELECT count(*) FROM lineitem) = 0 AS INT) AS failures,
      CAST(NULL AS VARCHAR) AS sample, 'lineitem' AS "table" UNION ALL SELECT 'not_empty', '*', 1, NULL, 'empty'""",
    "dq_required_columns": """SELECT 'column_exists' AS rule, c AS "column", CAST(c NOT IN (SELECT column_name
      FROM (DESCRIBE orders)) AS INT) AS failures, CAST(NULL AS VARCHAR) AS sample
      FROM (VALUES ('o_orderkey'), ('O_CUSTKEY'), ('o_comment'), ('o_orderpriority')) t(c)
      UNION ALL SELECT 'not_null', 'o_orderkey', count(*) - count(o_orderkey), NULL FROM orders
      UNION ALL SELECT 'not_null', 'o_orderpriority', count(*), CAST(min(o_orderkey) AS VARCHAR)
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "dq_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_unique": """SELECT 'unique' AS rule, 'o_orderkey' AS "column", count(*) AS failures,
        min(CAST(o_orderkey AS VARCHAR)) AS sample FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', count(*), min(l_orderkey || '|' || l_linenumber)
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
    "dq_orphan_keys": "SELECT l_partkey, count(*) AS n_rows FROM lineitem "
    "WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1",
    "dq_relationships": " UNION ALL ".join(
        _rule("relationship", c, f"{c} NOT IN (SELECT {k} FROM {parent})", child, c)
        for child, c, parent, k in (
            ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("orders", "o_custkey", "customer", "c_custkey"),
            ("lineitem", "l_partkey", "customer", "c_custkey"))),
    "dq_accepted_values": " UNION ALL ".join(
        _rule("accepted_values", "o_orderstatus", v, "orders", "o_orderkey") for v in (
            "o_orderstatus = 'P'", "o_orderstatus = 'P' AND o_totalprice > 400000", "false")),
    "dq_label_consistency": "SELECT doc_id, 'label_matches_split' AS rule, 'target' AS \"column\" "
    "FROM documents JOIN labels USING (doc_id) WHERE lang = 'fr'",
    "stratified_folds": f"SELECT doc_id, quality, ({_ranked('doc_id', 42, 'quality')}) * 5 // "
    "count(*) OVER (PARTITION BY quality) AS fold FROM labels",
    "stratified_holdout": f"SELECT doc_id, {_ranked('doc_id', 42, 'quality')} < "
    "ceil(CAST(0.15 AS DOUBLE) * count(*) OVER (PARTITION BY quality)) AS is_holdout FROM labels",
    "seeded_sample": f"SELECT doc_id, n_chars FROM documents QUALIFY {_ranked('doc_id', 7)} < 150",
    "class_weights": f"""SELECT n0 AS n_negative, n1 AS n_positive, {r6('n0 / CAST(n1 AS DOUBLE)')} AS positive_weight,
      {r6('(n0 + n1) / (2 * CAST(n0 AS DOUBLE))')} AS balanced_negative,
      {r6('(n0 + n1) / (2 * CAST(n1 AS DOUBLE))')} AS balanced_positive FROM (
        SELECT count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1 FROM labels)""",
    "label_rate": f"SELECT {r6('avg(quality)')} AS label_rate FROM labels JOIN documents USING (doc_id)",
    "rank_metrics": f"WITH {_SCORED}, {_metric_sql('scored', '', 'score', 'quality')} {_rounded_metrics()}",
    "rank_metrics_by_fold": f"{_BY_FOLD} {_rounded_metrics('model, fold')}",
    "metric_comparison": f"""WITH {_SCORED}, long AS (SELECT 'smooth' AS model, toxic, score FROM scored
      UNION ALL SELECT 'coarse', toxic, coarse FROM scored),
      {_metric_sql('long', 'model', 'score', 'toxic')} {_rounded_metrics('model')}""",
    "cv_summary": f"""{_BY_FOLD} SELECT model, {r6('avg(roc_auc)')} AS mean_roc_auc,
      {r6('stddev_pop(roc_auc)')} AS std_roc_auc, {r6('avg(pr_auc)')} AS mean_pr_auc,
      {r6('stddev_pop(pr_auc)')} AS std_pr_auc FROM measured GROUP BY model""",
    "champion_pick": f"{_BY_FOLD} SELECT model FROM measured GROUP BY model ORDER BY avg(pr_auc) DESC, model LIMIT 1",
    "reliability_bins": f"WITH {_SCORED} {_bins_sql('score', 10)}",
    "reliability_comparison": f"WITH {_SCORED} {_bins_sql('score', 8, 'smooth')} UNION ALL {_bins_sql('coarse', 8, 'coarse')}",
    "exact_quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({q} AS DOUBLE) AS q, {r6(f'quantile_cont(CAST({c} AS DOUBLE), {q})')} AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_partkey") for q in (0.0, 0.1, 0.5, 0.9, 1.0)),
    "keyed_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN (1, 7, 32, 999999999)",
    "requested_rows": f"WITH {_MART} SELECT r.c_custkey, m.c_custkey IS NOT NULL AS found, c_mktsegment, order_count, "
    "event_value_avg FROM (SELECT DISTINCT user_id * 20 AS c_custkey FROM events) r "
    "LEFT JOIN mart m ON m.c_custkey = r.c_custkey",
    "absent_requests": "SELECT DISTINCT user_id * 20 AS c_custkey FROM events "
    "WHERE user_id * 20 NOT IN (SELECT c_custkey FROM customer)",
    "risk_tiers": f"""WITH {_SCORED} SELECT doc_id, {r6('score')} AS score,
      CASE WHEN score >= CAST(0.2 AS DOUBLE) THEN 'High' WHEN score >= CAST(0.08 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS risk_tier,
      CASE WHEN toxic = 0 THEN CASE WHEN coarse >= CAST(0.2 AS DOUBLE) THEN 'High'
        WHEN coarse >= CAST(0.08 AS DOUBLE) THEN 'Medium' ELSE 'Low' END END AS coarse_tier FROM scored""",
    "score_record_table": f"""WITH {_POOL}, p AS (SELECT *, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1500) AS s FROM pool)
      SELECT doc_id, is_train, CAST(target AS INT) AS actual_target, {r6('s')} AS probability,
      CASE WHEN s >= CAST(0.2 AS DOUBLE) THEN 'High' WHEN s >= CAST(0.08 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS risk_tier,
      CASE target WHEN 1 THEN 'Default' WHEN 0 THEN 'No default' ELSE 'Unknown (scoring set)' END AS actual_outcome FROM p""",
}
