"""Named-query registry.

Every entry is ``(spark, sf_dir) -> DataFrame`` over the driver tables mapped
onto the canonical contract.  ``run_query`` is the allow-listed lookup with a
row limit; ``run_all`` is the catalogue job (rows, columns, seconds per query).
"""
from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from lotwise.plans import analyses as A
from lotwise.plans import marts as M
from lotwise.session import side_by_side, stored
from lotwise.sources.driver_tables import load_marketplace

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def _mp(spark, d):
    return load_marketplace(spark, d)


@register("K1_mart_session_funnel")
def _k1(spark, d):
    m = _mp(spark, d)
    return M.session_funnel(m.sessions, m.events)


@register("K2_mart_car_performance")
def _k2(spark, d):
    m = _mp(spark, d)
    return M.car_performance(m.cars, m.events)


@register("K3_mart_campaign_daily")
def _k3(spark, d):
    m = _mp(spark, d)
    return M.campaign_daily(M.session_funnel(m.sessions, m.events), m.campaigns)


@register("K4_campaign_attribution")
def _k4(spark, d):
    m = _mp(spark, d)
    return A.campaign_attribution(m.events, m.cars, m.sessions, m.campaigns)


@register("K5_campaign_quality")
def _k5(spark, d):
    m = _mp(spark, d)
    return A.campaign_quality(m.sessions, m.events, m.cars, m.campaigns)


@register("K6_cohort_retention")
def _k6(spark, d):
    m = _mp(spark, d)
    return A.cohort_retention(m.users, m.sessions, m.events)


@register("K7_customer_360")
def _k7(spark, d):
    m = _mp(spark, d)
    return A.customer_360(m.users, m.sessions, m.events, m.cars)


@register("K8_demand_supply_gap")
def _k8(spark, d):
    m = _mp(spark, d)
    return A.demand_supply_gap(m.events, m.cars)


@register("K9_funnel_analysis")
def _k9(spark, d):
    m = _mp(spark, d)
    return A.funnel_analysis(m.sessions, m.events)


@register("K10_funnel_transition_times")
def _k10(spark, d):
    m = _mp(spark, d)
    return A.funnel_transition_times(m.sessions, m.events)


@register("K11_inventory_aging")
def _k11(spark, d):
    return A.inventory_aging(_mp(spark, d).cars)


@register("K12_inventory_survival")
def _k12(spark, d):
    return A.inventory_survival(_mp(spark, d).cars)


@register("K13_position_bias")
def _k13(spark, d):
    return A.position_bias(_mp(spark, d).impressions)


@register("K14_price_analysis")
def _k14(spark, d):
    return A.price_analysis(_mp(spark, d).cars)


@register("K15_recommendation_ips")
def _k15(spark, d):
    m = _mp(spark, d)
    return A.recommendation_ips(m.impressions, m.cars)


@register("K16_recommendation_metrics")
def _k16(spark, d):
    return A.recommendation_metrics(_mp(spark, d).impressions)


@register("K17_user_intent_analysis")
def _k17(spark, d):
    m = _mp(spark, d)
    return A.user_intent_analysis(m.events, m.cars)


def run_query(spark: SparkSession, sf_dir: str, name: str, limit: int | None = None) -> DataFrame:
    """Allow-listed named query with an optional row limit."""
    if name not in REGISTRY:
        raise KeyError(f"unknown query {name!r}; allowed: {sorted(REGISTRY)}")
    df = REGISTRY[name](spark, sf_dir)
    return df.limit(limit) if limit else df


CATALOGUE_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("columns", T.IntegerType()), T.StructField("runtime_ms", T.LongType())])


def run_all(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
            names: list[str] | None = None, checks: tuple[str, ...] = ()) -> DataFrame:
    """Run each analysis once, optionally writing each result (A8); returns the
    catalogue (query, rows, columns, runtime_ms).  Rows are counted while they are written.
    ``checks`` names queries whose rows are violations: the run raises at the end when one
    has any.  The catalogue has one row per query, so building it on the driver is bounded."""
    from lotwise.sources.io import write_csv_report
    rows = []
    for name in names or sorted(REGISTRY):
        t0 = time.time()
        df = REGISTRY[name](spark, sf_dir)
        if out_dir:
            seen = Observation(name)
            write_csv_report(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{out_dir}/{name}")
            n = seen.get["n"]
        else:
            n = df.count()
        rows.append((name, int(n), len(df.columns), int((time.time() - t0) * 1000)))
    broken = {name: n for name, n, *_ in rows if name in checks and n}
    if broken:
        raise RuntimeError(f"rows in violation: {broken}")
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


# --------------------------------------------------------------- quality (K18, M)
from lotwise.plans import quality as QC  # noqa: E402


@register("K18_data_quality_checks")
def _k18(spark, d):
    m = _mp(spark, d)
    return QC.data_quality_checks(m.users, m.sessions, m.events, m.cars, m.impressions)


@register("M1_validate_cars")
def _m1(spark, d):
    return QC.validate_cars(_mp(spark, d).cars)


@register("M2_validate_users")
def _m2(spark, d):
    return QC.validate_users(_mp(spark, d).users)


@register("M3_validate_sessions_events")
def _m3(spark, d):
    m = _mp(spark, d)
    return QC.validate_sessions_events(m.sessions, m.events, m.users, m.cars, m.campaigns)


@register("M4_validate_impressions")
def _m4(spark, d):
    m = _mp(spark, d)
    return QC.validate_impressions(m.impressions, m.sessions, m.events, m.cars)


# --------------------------------------------------------------------- GA4 (N)
from lotwise.sources import ga4 as G  # noqa: E402


@register("N5_ga4_canonical_events")
def _n5(spark, d):
    return G.canonicalise(G.flattened_export_from_driver(spark, d))


@register("N6_ga4_sessions")
def _n6(spark, d):
    return G.sessionise(G.canonicalise(G.flattened_export_from_driver(spark, d)))


# ------------------------------------------------------------ commercial (L)
from lotwise.plans import commercial as L  # noqa: E402


@register("L1_campaign_performance")
def _l1(spark, d):
    m = _mp(spark, d)
    return L.campaign_performance(m.sessions, m.events, m.cars, m.campaigns)


@register("L2_inventory_match_score")
def _l2(spark, d):
    m = _mp(spark, d)
    return L.inventory_match_score(m.sessions, m.events, m.cars)


@register("L3_inventory_opportunities")
def _l3(spark, d):
    m = _mp(spark, d)
    return L.inventory_opportunities(m.events, m.cars, minimum_gap=1.0)


@register("L4_price_review_candidates")
def _l4(spark, d):
    m = _mp(spark, d)
    return L.price_review_candidates(m.events, m.cars)


@register("L5_budget_allocation")
def _l5(spark, d):
    m = _mp(spark, d)
    return L.budget_allocation(L.campaign_performance(m.sessions, m.events, m.cars, m.campaigns))


@register("L6_segment_sample_sizes")
def _l6(spark, d):
    m = _mp(spark, d)
    return L.segment_sample_sizes(L.campaign_performance(m.sessions, m.events, m.cars, m.campaigns))


@register("L7_experiment_readout")
def _l7(spark, d):
    m = _mp(spark, d)
    return L.experiment_readout(L.user_arm_assignment(m.users, m.events))


@register("L8_baseline_booking_rate")
def _l8(spark, d):
    return L.baseline_booking_rate(_mp(spark, d).events)


@register("L12_deal_labels")
def _l12(spark, d):
    return L.deal_labels_for_listings(_mp(spark, d).cars)


@register("L14_comparable_segments")
def _l14(spark, d):
    return L.comparable_segments(_mp(spark, d).cars)


@register("L15_modal_model")
def _l15(spark, d):
    return L.modal_model(_mp(spark, d).cars)


# -------------------------------------------------------------- features (O)
from lotwise.plans import features as O  # noqa: E402


@register("O4_price_dataset")
def _o4(spark, d):
    m = _mp(spark, d)
    return O.build_price_dataset(m.cars, m.events)


@register("O5_booking_dataset")
def _o5(spark, d):
    m = _mp(spark, d)
    return O.build_booking_dataset(m.impressions, m.sessions, m.users, m.cars, m.events)


@register("O6_sellthrough_dataset")
def _o6(spark, d):
    m = _mp(spark, d)
    return O.build_sellthrough_dataset(m.cars, m.events)


# ------------------------------------------------- metrics, ranking, drift (S, R, T)
from pyspark.sql import functions as F  # noqa: E402

from lotwise.plans import drift as T  # noqa: E402
from lotwise.plans import evalmetrics as S  # noqa: E402
from lotwise.plans import ranking as R  # noqa: E402


def scored_impressions(spark, d):
    """Impressions scored by the logged list order: y = clicked, p = 1/position."""
    imp = _mp(spark, d).impressions
    return imp.select(F.concat_ws("|", "session_id", F.col("list_position").cast("string"), "car_id",
                                  F.col("clicked").cast("int").cast("string")).alias("row_key"),
                      F.col("clicked").cast("int").alias("y"),
                      (F.lit(1.0) / F.col("list_position")).alias("p"))


def price_baseline_scored(spark, d):
    """Sold cars with the make+model median fair-price baseline as prediction."""
    fair = L.segment_fair_price(_mp(spark, d).cars).filter(F.col("sold_flag"))
    return fair.select("car_id", "body_type", "city", F.col("transaction_price").alias("y"),
                       F.col("fair_price").alias("p"))


@register("S2_regression_metrics")
def _s2(spark, d):
    return S.regression_metrics(price_baseline_scored(spark, d))


@register("S17_error_slices_by_body")
def _s17(spark, d):
    return S.regression_metrics(price_baseline_scored(spark, d), by=["body_type"]).select("body_type", "mae", "n")


@register("S3_interval_metrics")
def _s3(spark, d):
    df = price_baseline_scored(spark, d)
    return S.interval_metrics(df.withColumn("lo", F.col("p") * 0.9).withColumn("hi", F.col("p") * 1.1))


@register("S5_classification_metrics")
def _s5(spark, d):
    return S.classification_metrics(scored_impressions(spark, d), threshold=0.5, tiebreak="row_key")


@register("S7_lift_table")
def _s7(spark, d):
    return S.lift_table(scored_impressions(spark, d), tiebreak="row_key")


@register("S8_threshold_table")
def _s8(spark, d):
    return S.threshold_table(scored_impressions(spark, d))


@register("S9_reliability_curve")
def _s9(spark, d):
    return S.reliability_curve(scored_impressions(spark, d))


@register("S11_bootstrap_ctr_ci")
def _s11(spark, d):
    imp = _mp(spark, d).impressions
    return S.bootstrap_ratio_ci(imp.withColumn("c", F.col("clicked").cast("int")), "user_id", "c")


def ranked_impressions(spark, d):
    m = _mp(spark, d)
    imp = R.with_relevance(m.impressions).withColumn("logged_score", -F.col("list_position").cast("double"))
    return imp.join(m.cars.select("car_id", "model_popularity", "inspection_score", "listed_price"),
                    "car_id", "left"), m.cars


@register("R9_ranking_metrics_logged_order")
def _r9(spark, d):
    imp, cars = ranked_impressions(spark, d)
    return R.ranking_metrics(imp, "logged_score", cars, tiebreak=["list_position", "relevance"])


@register("R10_strategy_comparison")
def _r10(spark, d):
    imp, cars = ranked_impressions(spark, d)
    imp = imp.withColumn("cheapest_first", -F.col("listed_price"))
    return R.compare_strategies(imp, {"logged_order": "logged_score", "popularity": "model_popularity",
                                      "inspection": "inspection_score", "cheapest_first": "cheapest_first"}, cars,
                                 tiebreak=["list_position", "relevance"])


def _drift_inputs(m):
    """Data sets of the drift report that need no fitted model, and the order that splits them."""
    booking = O.build_booking_dataset(m.impressions, m.sessions, m.users, m.cars, m.events)
    datasets = {"price": (O.build_price_dataset(m.cars, m.events), O.PRICE_FEATURES),
                "booking": (booking, O.BOOKING_FEATURES),
                "sellthrough": (O.build_sellthrough_dataset(m.cars, m.events), O.SELL_FEATURES)}
    order = {"price": ["observation_date", "car_id"],
             "booking": ["observation_date", "session_id", "car_id", "list_position"],
             "sellthrough": ["observation_date", "car_id", "snapshot_age"]}
    return datasets, order


@register("T6_drift_report_sellthrough")
def _t6(spark, d):
    datasets, order = _drift_inputs(_mp(spark, d))
    return T.drift_report({"sellthrough": datasets["sellthrough"]}, order)


@register("T6_drift_report")
def _t6_all(spark, d):
    return T.drift_report(*_drift_inputs(_mp(spark, d)))


# ------------------------------------------------------ intent and recommendations (P, Q)
import datetime as _dt  # noqa: E402

from lotwise.plans import intent as P  # noqa: E402
from lotwise.plans import recs as RC  # noqa: E402

REC_AS_OF = _dt.date(2024, 2, 1)


def _sorted_json(col):
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col))))


@register("P1_intent_distributions")
def _p1(spark, d):
    m = _mp(spark, d)
    anchors = P.current_sessions(m.events).withColumnRenamed("session_id", "current_session")
    return P.distributions(m.events, m.cars, anchors)


@register("P6_intent_profiles")
def _p6(spark, d):
    m = _mp(spark, d)
    p = P.infer_profiles(m.events, m.cars)
    return p.select("user_id", "session_id", "ref_time", "n_events",
                    _sorted_json(F.col("hard_constraints")).alias("hard_constraints"),
                    _sorted_json(F.col("soft_preferences")).alias("soft_preferences"),
                    _sorted_json(F.col("entropy_by_dim")).alias("entropy_by_dim"),
                    "session_entropy", "confidence")


@register("P7_budget_from_events")
def _p7(spark, d):
    m = _mp(spark, d)
    return P.budget_from_events(m.events, m.cars)


@register("Q9_popularity_by_car")
def _q9(spark, d):
    m = _mp(spark, d)
    return RC.popularity_by_car(m.events, m.cars)


@register("Q14_batch_recommendations")
def _q14(spark, d):
    m = _mp(spark, d)
    return RC.recommend_all(m.users, m.events, m.cars, REC_AS_OF)


# ------------------------------------------------------------ models
from lotwise.plans import models as MD  # noqa: E402

_FITTED: dict = {}

#: Split dates of the driver's tables, by data set.
PRICE_DATES = dict(train_end="2023-12-14", validation_end="2023-12-28", test_end="2024-12-31")
SELL_DATES = dict(train_end="2024-01-02", validation_end="2024-01-18", test_end="2024-12-31")
IMPRESSION_DATES = dict(train_end="1998-12-23", validation_end="2000-04-06", test_end="2002-12-31")


def _fitted(spark, d, what):
    """Fit each model once per (dataset dir, model) in this process."""
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _FITTED:
        m = _mp(spark, d)
        if what == "price":
            ds = stored(O.build_price_dataset(m.cars, m.events))
            _FITTED[key] = MD.train_price_model(ds, O.PRICE_FEATURES, O.PRICE_CAT, dates=PRICE_DATES)
        elif what == "sellthrough":
            ds = stored(O.build_sellthrough_dataset(m.cars, m.events))
            _FITTED[key] = MD.train_classifier(ds, "label_sold_30d", O.SELL_FEATURES, O.SELL_CAT,
                                               ["car_id", "snapshot_age"], rounds=MD.SELL_ROUNDS, dates=SELL_DATES)
        elif what == "booking":
            ds = stored(O.build_booking_dataset(m.impressions, m.sessions, m.users, m.cars, m.events)).withColumn(
                "__id", F.concat_ws("|", "session_id", "car_id", F.col("observation_date").cast("string")))
            _FITTED[key] = MD.train_classifier(ds, "label_booked", O.BOOKING_FEATURES, O.BOOKING_CAT,
                                               ["session_id", "car_id", "__id"], dates=IMPRESSION_DATES)
    return _FITTED[key]


def _fitted_all(spark, d, *names):
    """Several models, fitted side by side."""
    return side_by_side(*[partial(_fitted, spark, d, what) for what in names])


@register("S13_price_model_metrics")
def _s13(spark, d):
    return MD.price_metrics(_fitted(spark, d, "price"))


@register("S18_price_scoring_unsold")
def _s18(spark, d):
    m = _mp(spark, d)
    rows = O.car_base_features(m.cars, with_static_supply=False).filter(~F.col("sold_flag")) \
        .withColumn("observation_date", F.col("inventory_entry_date").cast("timestamp_ntz"))
    from lotwise.operators.pit import attach_market_context
    rows = attach_market_context(rows, m.cars, m.events, "observation_date")
    out = MD.score_price(_fitted(spark, d, "price"), rows)
    return out.select("car_id", "listed_price", "predicted_fair_price", "lower_price", "upper_price")


@register("S19_sellthrough_model_metrics")
def _s19s(spark, d):
    return MD.classifier_metrics(_fitted(spark, d, "sellthrough"), "sellthrough")


@register("S19_booking_model_metrics")
def _s19b(spark, d):
    return MD.classifier_metrics(_fitted(spark, d, "booking"), "booking")


def _all_metrics(spark, d):
    """Metrics of the fitted models; ``ranking`` is the blend chosen on validation, as it
    ranks the test window, and ``ranking_session_only`` its baseline."""
    _fitted_all(spark, d, "price", "booking", "sellthrough")
    ranked = _ranking_eval(spark, d)["comparison"]
    names = {"validation_selected_blend": "ranking", "session_only": "ranking_session_only"}
    cols = [c for c in ranked.columns if c != "strategy"]
    model = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("strategy")]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    rk_long = (ranked.where(F.col("strategy").isin(list(names))).withColumn("model", model)
               .selectExpr("model", f"stack({len(cols)}, {stack}) AS (metric_name, metric_value)"))
    return (MD.price_metrics(_fitted(spark, d, "price"))
            .unionByName(MD.classifier_metrics(_fitted(spark, d, "booking"), "booking"))
            .unionByName(MD.classifier_metrics(_fitted(spark, d, "sellthrough"), "sellthrough"))
            .unionByName(rk_long))


@register("T7_quality_gates")
def _t7(spark, d):
    return T.quality_gates(_all_metrics(spark, d))


@register("T8_monitoring_status")
def _t8(spark, d):
    datasets, order = _drift_inputs(_mp(spark, d))
    metrics = _all_metrics(spark, d)
    datasets["ranking"] = (_ranking_dataset(spark, d), R.RANK_FEATURES)
    order["ranking"] = ["observation_date", "session_id", "car_id", "list_position"]
    return T.monitoring_status(T.quality_gates(metrics), T.drift_report(datasets, order))


# ------------------------------------------------------ exploration
from lotwise.plans import exploration as X  # noqa: E402


@register("D20_missing_share_cars")
def _d20(spark, d):
    return X.missing_share(_mp(spark, d).cars)


@register("D21_monthly_event_volume")
def _d21(spark, d):
    return X.monthly_volume(_mp(spark, d).events)


@register("D22_retention_matrix")
def _d22(spark, d):
    m = _mp(spark, d)
    return X.retention_matrix(A.cohort_retention(m.users, m.sessions, m.events))


@register("D23_aging_rollup")
def _d23(spark, d):
    return X.aging_rollup(A.inventory_aging(_mp(spark, d).cars))


@register("D24_table_row_counts")
def _d24(spark, d):
    return X.table_row_counts(_mp(spark, d).as_dict())


@register("D25_inspection_histogram")
def _d25(spark, d):
    return X.histogram(_mp(spark, d).cars, "inspection_score", 30)


@register("F6_most_active_users")
def _f6(spark, d):
    return X.most_active_users(_mp(spark, d).events)


@register("C17_latest_snapshot_lookup")
def _c17(spark, d):
    m = _mp(spark, d)
    snaps = O.build_sellthrough_dataset(m.cars, m.events)
    req = m.cars.select("car_id", F.lit(20).alias("snapshot_age"))
    return X.latest_snapshot_at_or_before(snaps, req)


@register("L13_price_features_as_of_latest")
def _l13(spark, d):
    m = _mp(spark, d)
    cand = m.cars.drop("market_demand_index", "local_supply_index")
    out = X.price_features_as_of_latest(cand, m.cars, m.events)
    return out.select("car_id", "observation_date", "vehicle_age", "kilometres_per_year", "inventory_entry_month",
                      "model_popularity", "market_demand_index", "local_supply_index")


# ------------------------------------------------------ ranking dataset and ranker
from lotwise.plans import ranking_data as RD  # noqa: E402

_RANKING: dict = {}


def _ranking_dataset(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _RANKING:
        m = _mp(spark, d)
        price, booking = _fitted_all(spark, d, "price", "booking")
        b_scores = MD.score_classifier(booking, booking["test"].unionByName(booking["train"])
                                       .unionByName(booking["validation"])) \
            .select("session_id", "car_id", F.col("probability").alias("booking_probability"))
        events = m.events
        uf, cf = RC.fit_collaborative(events)
        ds = RD.build_ranking_dataset(m.impressions, m.cars, m.users, events, price,
                                      b_scores, (uf, cf))
        _RANKING[key] = ds.checkpoint(eager=True)
    return _RANKING[key]


@register("R3_ranking_dataset")
def _r3(spark, d):
    ds = _ranking_dataset(spark, d)
    return ds.select("session_id", "user_id", "car_id", "list_position", "observation_date", "relevance", "ipw",
                     "list_position_propensity", "booking_probability", "predicted_fair_price", *R.RANK_FEATURES)


_EVAL: dict = {}


def _ranking_eval(spark, d):
    """One ranker fit + blend search + strategy comparison per dataset."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _EVAL:
        ev = RD.ranking_evaluation(_ranking_dataset(spark, d), _mp(spark, d).cars, dates=IMPRESSION_DATES)
        _EVAL[key] = {k: (v.checkpoint(eager=True) if hasattr(v, "checkpoint") else v) for k, v in ev.items()}
    return _EVAL[key]


@register("R10_ranker_strategy_comparison")
def _r10b(spark, d):
    return _ranking_eval(spark, d)["comparison"]


@register("R11_blend_search")
def _r11(spark, d):
    return _ranking_eval(spark, d)["blend_search"]


@register("L9_ablation_study")
def _l9(spark, d):
    return RD.ablation_study(_ranking_dataset(spark, d), _mp(spark, d).cars, IMPRESSION_DATES)


# ---------------------------------------------------------- scoring labels and explanations
@register("L11_lead_tiers")
def _l11(spark, d):
    b = _fitted(spark, d, "booking")
    scored = MD.score_classifier(b, b["test"])
    quality, action = L.lead_tier(F.col("probability"))
    return scored.select("session_id", "car_id", F.col("probability").alias("booking_probability"),
                         quality.alias("lead_quality"), action.alias("recommended_action"))


@register("S23_price_feature_importance")
def _s23(spark, d):
    b = _fitted(spark, d, "price")
    return MD.global_importance(b["models"]["random_forest"], b["features"])


@register("S24_price_local_factors")
def _s24(spark, d):
    b = _fitted(spark, d, "price")
    return MD.linear_contributions(b["ridge"], b["test"].select("car_id", "features"), "car_id", top_k=5)
