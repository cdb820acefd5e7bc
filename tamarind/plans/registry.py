"""Every report bound to the tables of a folder, by name."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.functions.dates import inferred_format, parse_inferred
from tamarind.functions.text import clean_comment, first_capture, standardize
from tamarind.functions.vectors import argmax, softmax
from tamarind.operators import basket, features, linear, missing, models, neighbours, pivots, places, rank, scoring, summary
from tamarind.plans import customer_value, exploration, launches, loyalty, series, workforce
from tamarind.session import apply_options, freeze, scratch_path
from tamarind.sources import csv_ranges, files, html
from tamarind.sources.views import Tables

REPORT_DATE = dt.date(2001, 9, 1)
DOUBLE_PRODUCT = "red plate"
CITY = "NATION_3"
LEAVER, HIRE = "TERMINATED", "HIRED"
FAMILIES = ("Specialist", "Head of Unit", "Collaborator", "Director")
FAILURES = ("R F", "N F")
LAUNCH_KEY = ["launch_id", "launch_seq", "part_key", "supp_key"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so that results compare equal across engines."""

    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select([cast(f) for f in df.schema.fields])


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a report under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _comparable(build(Tables(apply_options(spark), folder)))

    QUERIES[build.__name__] = run
    return build


# --- customer value -----------------------------------------------------------------------------------------------
@query
def rfm_metrics(t: Tables) -> DataFrame:
    return customer_value.rfm_metrics(t.customer_transaction(), t.customer_registered(), REPORT_DATE)


@query
def rfm_scores(t: Tables) -> DataFrame:
    return customer_value.rfm_scores(rfm_metrics(t))


@query
def rfm_distribution(t: Tables) -> DataFrame:
    return customer_value.rfm_distribution(rfm_scores(t))


@query
def global_rank(t: Tables) -> DataFrame:
    orders = t.raw("orders", "o_orderkey", "o_totalprice")
    return rank.global_row_number(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# --- loyalty ------------------------------------------------------------------------------------------------------
@query
def loyalty_total_spent(t: Tables) -> DataFrame:
    return loyalty.total_spent(t.sales(), t.menu())


@query
def loyalty_visit_days(t: Tables) -> DataFrame:
    return loyalty.visit_days(t.sales())


@query
def loyalty_visit_days_merged(t: Tables) -> DataFrame:
    return loyalty.visit_days_of(freeze(loyalty.visit_day_partials(t.sales()), "visit_days"))


@query
def loyalty_first_item(t: Tables) -> DataFrame:
    return loyalty.first_item(t.sales(), t.menu())


@query
def loyalty_top_item(t: Tables) -> DataFrame:
    return loyalty.top_item(t.sales(), t.menu())


@query
def loyalty_favourite_item(t: Tables) -> DataFrame:
    return loyalty.favourite_item(t.sales(), t.menu())


@query
def loyalty_first_after_join(t: Tables) -> DataFrame:
    return loyalty.first_after_join(t.sales(), t.menu(), t.members())


@query
def loyalty_before_join_ref(t: Tables) -> DataFrame:
    return loyalty.before_join(t.sales(), t.menu(), t.members(), last=False)


@query
def loyalty_last_before_join(t: Tables) -> DataFrame:
    return loyalty.before_join(t.sales(), t.menu(), t.members(), last=True)


@query
def loyalty_pre_member_totals(t: Tables) -> DataFrame:
    return loyalty.pre_member_totals(t.sales(), t.menu(), t.members())


@query
def loyalty_points(t: Tables) -> DataFrame:
    return loyalty.points(t.sales(), t.menu(), DOUBLE_PRODUCT)


@query
def loyalty_member_month_sales(t: Tables) -> DataFrame:
    return loyalty.member_month_sales(t.sales(), t.menu(), t.members(), month=1)


@query
def loyalty_points_first_week(t: Tables) -> DataFrame:
    return loyalty.points_first_week(t.sales(), t.menu(), t.members(), DOUBLE_PRODUCT, dt.date(2001, 1, 31))


@query
def loyalty_member_flag(t: Tables) -> DataFrame:
    return loyalty.member_flag(t.sales(), t.menu(), t.members())


@query
def loyalty_member_ranking(t: Tables) -> DataFrame:
    return loyalty.member_ranking(t.sales(), t.menu(), t.members())


# --- baskets ------------------------------------------------------------------------------------------------------
@query
def basket_pairs(t: Tables) -> DataFrame:
    return basket.pair_metrics(t.basket_lines())


@query
def basket_pairs_supported(t: Tables) -> DataFrame:
    """Pairs in at least three of 1,000 baskets."""
    return basket.pair_metrics(t.basket_lines(), min_support=0.003)


@query
def basket_rules_fpgrowth(t: Tables) -> DataFrame:
    rules = basket.growth_rules(t.basket_lines(), min_support=0.002, min_confidence=0.05)
    return rules.withColumns({c: F.round(c, 9) for c in ("confidence", "lift", "support")})


# --- workforce ----------------------------------------------------------------------------------------------------
def _known(statements: DataFrame) -> DataFrame:
    known = missing.fill(missing.require(statements, "employee_work_date"), leader_code=workforce.NO_LEADER)
    return workforce.enrich(known, REPORT_DATE, LEAVER, FAMILIES)


def _statements(t: Tables) -> DataFrame:
    """Statements without place and title."""
    return _known(t.statement())


def _employees(t: Tables) -> DataFrame:
    """Statements with place and title."""
    return _known(t.employee_statement())


def _city_leavers(t: Tables) -> DataFrame:
    return workforce.leavers(_employees(t), CITY, LEAVER)


@query
def hr_clean(t: Tables) -> DataFrame:
    return workforce.clean_statements(t.employee_statement_text(), unused=["employee_code"])


@query
def hr_position_map(t: Tables) -> DataFrame:
    return _employees(t).select("statement_id", "job_title", "position")


@query
def hr_tenure(t: Tables) -> DataFrame:
    return _statements(t).select("statement_id", "statement_type", "tenure")


@query
def hr_kpis(t: Tables) -> DataFrame:
    return workforce.kpis(_statements(t), REPORT_DATE, LEAVER, HIRE)


@query
def hr_status_counts(t: Tables) -> DataFrame:
    return workforce.count_report(_employees(t), ["statement_type"], "job_title")


@query
def hr_status_share(t: Tables) -> DataFrame:
    return workforce.count_report(_employees(t), ["statement_type"], "job_title", share=True)


@query
def hr_churn_by_year(t: Tables) -> DataFrame:
    return workforce.count_report(workforce.leavers(_statements(t), leaver=LEAVER), ["valid_year"], "statement_id")


@query
def hr_churn_by_year_share(t: Tables) -> DataFrame:
    return workforce.count_report(workforce.leavers(_statements(t), leaver=LEAVER), ["valid_year"], "statement_id", share=True)


@query
def hr_churn_by_location_share(t: Tables) -> DataFrame:
    left = workforce.leavers(_employees(t), leaver=LEAVER)
    return workforce.count_report(left, ["work_location"], "statement_id", share=True)


@query
def hr_churn_city(t: Tables) -> DataFrame:
    return _city_leavers(t).select("statement_id", "statement_valid_date", "job_title", "leader_code", "tenure")


@query
def hr_churn_city_month(t: Tables) -> DataFrame:
    return workforce.count_report(_city_leavers(t), ["valid_month"], "statement_id", by_key=True)


@query
def hr_churn_city_position_share(t: Tables) -> DataFrame:
    return workforce.count_report(_city_leavers(t), ["position"], "statement_id", share=True)


@query
def hr_churn_job_counts(t: Tables) -> DataFrame:
    return summary.value_counts(_city_leavers(t).filter(F.col("position") == "Specialist"), "job_title")


@query
def hr_top_leaders(t: Tables) -> DataFrame:
    return workforce.top_leaders(_city_leavers(t), "statement_id", 10)


@query
def hr_hire_vs_churn(t: Tables) -> DataFrame:
    return workforce.hires_against_leavers(_statements(t), "statement_id", LEAVER, HIRE)


@query
def hr_tenure_share(t: Tables) -> DataFrame:
    left = workforce.served(workforce.leavers(_statements(t), leaver=LEAVER))
    return workforce.count_report(left, ["tenure"], "statement_id", share=True, by_key=True)


@query
def hr_tenure_by_position(t: Tables) -> DataFrame:
    left = workforce.served(workforce.leavers(_employees(t), leaver=LEAVER))
    return workforce.count_report(left, ["tenure", "position"], "statement_id", by_key=True)


@query
def hr_reason_share(t: Tables) -> DataFrame:
    return workforce.count_report(workforce.leavers(_statements(t), leaver=LEAVER), ["statement_name"], "statement_id", share=True)


# --- comments -----------------------------------------------------------------------------------------------------
@query
def text_extract_id(t: Tables) -> DataFrame:
    """The first e-mail address of a text; null without one.

    A match can only start where a run of its first class starts, and possessive loops never go back, so that long runs of
    letters cost linear time.
    """
    pattern = r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)"
    return t.raw("documents", "doc_id", "text").select("doc_id", first_capture(F.col("text"), pattern).alias("object_id"))


@query
def text_standardize(t: Tables) -> DataFrame:
    return t.raw("documents", "doc_id", "text").select("doc_id", standardize(F.col("text")).alias("content_std"))


@query
def text_expand_abbrev(t: Tables) -> DataFrame:
    return t.raw("documents", "doc_id", "text").select("doc_id", clean_comment(F.col("text")).alias("content_std"))


def _labelled_comments(t: Tables) -> DataFrame:
    label = (
        F.when(F.col("toxic") == 1, scoring.NEGATIVE).when(F.col("quality") == 1, scoring.POSITIVE).otherwise(scoring.NEUTRAL)
    )
    return t.raw("labels").join(t.raw("documents", "doc_id", "text"), "doc_id").select("text", label.alias("label"))


@query
def sentiment_score(t: Tables) -> DataFrame:
    model = scoring.train_comment_model(_labelled_comments(t))
    return scoring.score_with_model(t.raw("documents", "doc_id", "text"), model, "doc_id").select("doc_id", "sentiment")


@query
def sentiment_word_list(t: Tables) -> DataFrame:
    """Comments scored by a scorer that the user brings."""
    scorer = scoring.word_list_scorer({"der", "die", "und", "of"}, {"the", "and", "la", "de"})
    return scoring.score_with(t.raw("documents", "doc_id", "text"), scorer).select("doc_id", "sentiment")


@query
def sentiment_argmax(t: Tables) -> DataFrame:
    """Weights of the comment model as shares, and the class with the largest one."""
    model = scoring.train_comment_model(_labelled_comments(t))
    logits = scoring.class_weights(t.raw("documents", "doc_id", "text"), model, "doc_id")
    weights = logits.select("doc_id", softmax(F.transform("weights", lambda w: F.round(w, 6))).alias("w"))
    return weights.select(
        "doc_id",
        *[F.round(F.get("w", F.lit(i)), 4).alias(n) for i, n in enumerate(("negative", "positive", "neutral"))],
        argmax(F.col("w")).alias("sentiment"),
    )


# --- nested documents and launch table ----------------------------------------------------------------------------
@query
def json_flatten_events(t: Tables) -> DataFrame:
    events = t.raw("events", "event_id", "event_type", "props")
    return files.flatten_structs(files.parse_json(events, "props", "k bigint"), sep="_")


def _single_launches(t: Tables) -> DataFrame:
    return launches.single_core_launches(launches.from_documents(t.launch_documents()), dt.date(2000, 11, 13))


@query
def json_singleton_unwrap(t: Tables) -> DataFrame:
    return _single_launches(t).select(
        "flight_number", "launch_date", "rocket", F.col("payloads").alias("payload_id"), F.col("cores.core").alias("core_id")
    )


@query
def launch_outcome_text(t: Tables) -> DataFrame:
    return launches.core_outcomes(_single_launches(t))


@query
def launch_enrich_dims(t: Tables) -> DataFrame:
    resolved = launches.resolve_ids(t.launch_ids(), t.rockets(), t.launchpads(), t.payloads(), t.cores())
    return resolved.select(
        "launch_id", "launch_seq", "rocket_id", "booster_version", "launch_site", "longitude", "latitude", "payload_mass",
        "orbit", "block", "reuse_count", "serial",
    )


@query
def launch_renumber(t: Tables) -> DataFrame:
    rows = t.launch("launch_date", *LAUNCH_KEY, "booster_version")
    return launches.renumber(rows, "Brand#1", ["launch_date", *LAUNCH_KEY])


@query
def launch_impute_mean(t: Tables) -> DataFrame:
    return missing.impute_mean(t.launch(*LAUNCH_KEY, "payload_mass"), ["payload_mass"])


@query
def scraped_clean(t: Tables) -> DataFrame:
    return launches.tidy_scraped(t.scraped())


@query
def wr_value_counts(t: Tables) -> DataFrame:
    return summary.value_counts_long(t.launch("launch_site", "orbit", "outcome"), ["launch_site", "orbit", "outcome"])


@query
def wr_outcome_label(t: Tables) -> DataFrame:
    rows = t.launch(*LAUNCH_KEY, "outcome")
    return launches.label_outcomes(rows, FAILURES)


@query
def wr_success_rate(t: Tables) -> DataFrame:
    return exploration.success_rate(launches.label_outcomes(t.launch("outcome"), FAILURES))


# --- profiles -----------------------------------------------------------------------------------------------------
@query
def profile_nulls(t: Tables) -> DataFrame:
    return summary.null_profile(t.employee_statement())


@query
def profile_columns(t: Tables) -> DataFrame:
    return summary.column_profile(t.employee_statement())


@query
def profile_columns_wide(t: Tables) -> DataFrame:
    """The profile with value lists of up to 149 values, over the text columns."""
    rows = t.employee_statement()
    return summary.column_profile(rows.select(*summary.columns_of_type(rows, text=True)), list_below=150)


@query
def values_numbered(t: Tables) -> DataFrame:
    return summary.numbered_values(t.launch("outcome"), "outcome")


@query
def drop_all_null_columns(t: Tables) -> DataFrame:
    return missing.drop_empty_columns(t.employee_statement_text())


@query
def src_csv_roundtrip(t: Tables) -> DataFrame:
    table = t.raw("documents").withColumn("source_if_known", F.when(F.col("lang") != "en", F.col("source")))
    path = scratch_path(t.spark, "csv")
    files.write_csv(table, path)
    return files.read_csv(t.spark, path, table.schema)


@query
def src_csv_ranges(t: Tables) -> DataFrame:
    table = t.raw("documents").withColumn("source_if_known", F.when(F.col("lang") != "en", F.col("source")))
    path = scratch_path(t.spark, "csv")
    files.write_csv(table, path)
    return csv_ranges.read_csv_ranges(t.spark, path, table.schema)


def _dates_as_text(t: Tables) -> DataFrame:
    """Order dates as the text of five sources, two of them month first."""
    month_first = F.col("o_orderpriority").substr(1, 1).isin("2", "5")
    return t.raw("orders", "o_orderkey", "o_orderpriority", "o_orderdate").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(month_first, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day_text"),
    )


DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy-M-d")


@query
def date_formats_inferred(t: Tables) -> DataFrame:
    return inferred_format(_dates_as_text(t), "day_text", DATE_FORMATS, ["o_orderpriority"])


@query
def dates_in_inferred_format(t: Tables) -> DataFrame:
    return parse_inferred(_dates_as_text(t), "day_text", DATE_FORMATS, "day", ["o_orderpriority"])


# --- exploration --------------------------------------------------------------------------------------------------
@query
def eda_distinct_sites(t: Tables) -> DataFrame:
    return exploration.distinct_sites(t.launch("launch_site"))


@query
def eda_site_prefix(t: Tables) -> DataFrame:
    return exploration.site_prefix(t.launch(), "site_1", 5, LAUNCH_KEY)


@query
def eda_total_payload_customer(t: Tables) -> DataFrame:
    return exploration.total_payload(t.launch("payload_mass", "customer"), F.col("customer") == "CUST_7")


@query
def eda_avg_payload_version(t: Tables) -> DataFrame:
    return exploration.average_payload(t.launch("payload_mass", "booster_version"), "brand#12")


@query
def eda_first_success_date(t: Tables) -> DataFrame:
    return exploration.first_date(t.launch("launch_date", "outcome"), "a o")


@query
def eda_booster_payload_range(t: Tables) -> DataFrame:
    return exploration.boosters_in_range(t.launch("booster_version", "outcome", "payload_mass"), "A F", 20.0, 30.0)


@query
def eda_outcome_counts(t: Tables) -> DataFrame:
    return exploration.outcome_counts(exploration.with_date(t.launch("launch_date", "outcome")))


@query
def eda_max_payload_boosters(t: Tables) -> DataFrame:
    return exploration.heaviest(t.launch("booster_version", "payload_mass"))


@query
def eda_failures_by_month(t: Tables) -> DataFrame:
    return exploration.failures_by_month(t.launch(), "R F", 1998)


@query
def eda_outcome_rank_period(t: Tables) -> DataFrame:
    return exploration.outcome_rank(t.launch("launch_date", "outcome"), dt.date(1996, 6, 4), dt.date(1999, 3, 20))


@query
def eda_ctas_not_null(t: Tables) -> DataFrame:
    """A stored table without rows that miss the first working day."""
    name = f"not_null_{uuid.uuid4().hex}"
    t.employee_statement().filter(F.col("employee_work_date").isNotNull()).write.saveAsTable(name)
    return t.spark.table(name)


@query
def sql_outcomes_by_site(t: Tables) -> DataFrame:
    """A report in SQL over the published views."""
    t.publish()
    return t.spark.sql(
        "select launch_site, outcome, count(*) as launches, sum(payload_mass) as payload_kg from launch "
        "where payload_mass is not null group by launch_site, outcome"
    )


@query
def viz_success_by_orbit(t: Tables) -> DataFrame:
    return exploration.success_rate_by(t.launch("orbit", "class"), "orbit", "orbit")


@query
def viz_success_by_year(t: Tables) -> DataFrame:
    return exploration.success_rate_by(t.launch("launch_date", "class"), F.year("launch_date"), "launch_year")


@query
def viz_scatter_bins(t: Tables) -> DataFrame:
    return exploration.scatter_bins(t.launch("payload_mass", "launch_site", "class"), "payload_mass", 5.0, "launch_site")


@query
def dash_payload_bounds(t: Tables) -> DataFrame:
    return exploration.payload_bounds(t.launch("payload_mass"))


@query
def dash_success_by_site(t: Tables) -> DataFrame:
    return exploration.success_pie(t.launch("launch_site", "class"))


@query
def dash_site_outcomes(t: Tables) -> DataFrame:
    return exploration.success_pie(t.launch("launch_site", "class"), "SITE_2")


@query
def dash_payload_scatter_all(t: Tables) -> DataFrame:
    return exploration.payload_scatter(t.launch("launch_site", "payload_mass", "class", "booster_version"), 10.0, 40.0)


@query
def dash_payload_scatter(t: Tables) -> DataFrame:
    return exploration.payload_scatter(t.launch("launch_site", "payload_mass", "class", "booster_version"), 10.0, 40.0, "SITE_2")


# --- maps ---------------------------------------------------------------------------------------------------------
@query
def geo_sites(t: Tables) -> DataFrame:
    return places.site_coordinates(t.launch_points(), "site_name", "lat", "lon", "launch_id")


@query
def geo_marker_colors(t: Tables) -> DataFrame:
    return places.marker_layer(t.launch_points()).select(*LAUNCH_KEY, "site_name", "lat", "lon", "marker_color")


@query
def geo_marker_clusters(t: Tables) -> DataFrame:
    return places.marker_clusters(t.launch_points())


@query
def geo_zoom_clusters(t: Tables) -> DataFrame:
    return places.zoom_clusters(t.launch_points())


@query
def geo_nearest_poi(t: Tables) -> DataFrame:
    return places.nearest_landmark(t.site_geo(), t.poi_geo()).withColumn("km", F.round("km", 6))


# --- pages and series ---------------------------------------------------------------------------------------------
@query
def html_title_extract(t: Tables) -> DataFrame:
    return t.raw("pages").select("page_id", html.element_text(F.col("html"), "title").alias("title"))


@query
def html_table_rows(t: Tables) -> DataFrame:
    return html.table_rows(
        t.raw("pages", "page_id", "html"), container="ul", row="li", cell="a", position=0, cells=("link_text",)
    )


@query
def revenue_clean(t: Tables) -> DataFrame:
    return series.clean_revenue(t.revenue_text())


@query
def revenue_last_rows(t: Tables) -> DataFrame:
    return series.last_rows(series.clean_revenue(t.revenue_text()), ["d", "row_id"], 5)


@query
def series_price_revenue(t: Tables) -> DataFrame:
    revenue = series.clean_revenue(t.revenue_text()).groupBy("d").agg(F.sum("revenue").alias("revenue"))
    return series.price_and_revenue(t.price_series(), revenue, dt.date(2024, 1, 20), dt.date(2001, 4, 30))


# --- features and models ------------------------------------------------------------------------------------------
@query
def features_one_hot(t: Tables) -> DataFrame:
    rows = t.launch(*LAUNCH_KEY, "payload_mass", "class", "orbit", "launch_site")
    return features.as_doubles(features.one_hot(rows, ["orbit", "launch_site"]), "payload_mass", "class")


@query
def features_standardize(t: Tables) -> DataFrame:
    scaled = features.standardize_vector(t.raw("embeddings"), "embedding")
    return scaled.select("vec_id", F.posexplode("standardized").alias("entry", "z")).withColumn("z", F.round("z", 6))


def _vectors(t: Tables) -> DataFrame:
    return t.raw("embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))


@query
def ml_train_test_split(t: Tables) -> DataFrame:
    train, test = features.train_test_split(t.raw("embeddings", "vec_id", "label"), "vec_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def ml_knn_classify(t: Tables) -> DataFrame:
    train, test = features.train_test_split(_vectors(t), "id")
    return neighbours.classify(train, test).join(test.select("id", "label"), "id").select("id", "p", "k", "label", "predicted")


@query
def ml_knn_all(t: Tables) -> DataFrame:
    """The five nearest of all training rows for every test row, by the pivot index."""
    train, test = features.train_test_split(_vectors(t), "id")
    return pivots.nearest_of_all(train, test, k=5).withColumn("distance", F.round("distance", 9))


@query
def ml_cv_knn(t: Tables) -> DataFrame:
    train, _ = features.train_test_split(_vectors(t), "id")
    scores = neighbours.cross_validate(train.withColumn("fold", features.hash_bucket(F.col("id"), 3, models.FOLDS)))
    return scores.withColumn("cv_accuracy", F.round("cv_accuracy", 9))


def _best_neighbours(train: DataFrame) -> tuple[int, int]:
    """The tuned (p, k): best accuracy over the folds, then smaller p, then smaller k."""
    scores = neighbours.cross_validate(train.withColumn("fold", features.hash_bucket(F.col("id"), 3, models.FOLDS)))
    best = scores.select("p", "k", F.round("cv_accuracy", 9).alias("a")).orderBy(F.desc("a"), "p", "k").first()
    return best.p, best.k


def _tuned_neighbours(train: DataFrame, test: DataFrame) -> DataFrame:
    p, k = _best_neighbours(train)
    return neighbours.classify(train, test, ks=[k], ps=(p,)).join(test.select("id", "label"), "id")


@query
def ml_confusion(t: Tables) -> DataFrame:
    """Confusion counts of the tuned neighbour model on the test rows."""
    return models.confusion(_tuned_neighbours(*features.train_test_split(_vectors(t), "id")))


def _binary_vectors(t: Tables) -> DataFrame:
    return _vectors(t).withColumn("label", (F.col("label") >= 5).cast("int"))


def _binary_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with standardised features; statistics come from the training rows."""
    train, test = features.train_test_split(_binary_vectors(t), "id")
    scaled = features.standardize_vector(_binary_vectors(t), "vec", "vec", fit_on=train)
    # A search reads its rows many times; they are standardised once.
    parts = features.train_test_split(freeze(scaled, "standardised"), "id")
    return tuple(models.as_training_rows(part, "id", "vec", "label") for part in parts)


@query
def ml_linear_figures(t: Tables) -> DataFrame:
    """Losses, gradients and hits of a fixed linear model for every held-out fold: one pass of the linear searches."""
    rows = models.as_training_rows(_binary_vectors(t), "id", "vec", "label")
    settings = [linear.Setting(loss, 1.0, fold) for loss in (linear.HINGE, linear.LOGISTIC) for fold in range(models.FOLDS)]
    weights = [((7 * i) % 11 - 5) / 10 for i in range(64)] + [0.1]
    return linear.figures(rows, weights, settings).withColumn("value", F.round("value", 6))


@query
def ml_cv_logistic(t: Tables) -> DataFrame:
    return models.grid_report(t.spark, models.tune_logistic(_binary_rows(t)[0]))


@query
def ml_cv_linear_svm(t: Tables) -> DataFrame:
    return models.grid_report(t.spark, models.tune_linear_svm(_binary_rows(t)[0]))


@query
def ml_cv_tree(t: Tables) -> DataFrame:
    return models.grid_report(t.spark, models.tune_tree(_binary_rows(t)[0]))


@query
def ml_leaderboard(t: Tables) -> DataFrame:
    """Accuracy of the four tuned models on the test rows, best first."""
    train, test = _binary_rows(t)
    both = models.tune_linear(train, {linear.LOGISTIC: models.LOGISTIC_C, linear.HINGE: models.SVM_C})
    tuned = [
        ("Logistic Regression", both[linear.LOGISTIC]),
        ("Support Vector Machine", both[linear.HINGE]),
        ("Decision Tree", models.tune_tree(train)),
    ]
    scored = [(name, models.accuracy(models.predict(model.bestModel, test))) for name, model in tuned]
    near = _tuned_neighbours(*features.train_test_split(_binary_vectors(t), "id"))
    scored.append(("K-Nearest Neighbors", models.accuracy(near, "label", "predicted")))
    rows = [
        score.select(F.lit(i).alias("position"), F.lit(name).alias("model"), "score")
        for i, (name, score) in enumerate(scored)
    ]
    return models.leaderboard(reduce(DataFrame.unionByName, rows))


@query
def ml_best_neighbours(t: Tables) -> DataFrame:
    """The best of a board over all (p, k): accuracy on the test rows, first one wins."""
    train, test = features.train_test_split(_vectors(t), "id")
    predicted = neighbours.classify(train, test).join(test.select("id", "label"), "id")
    hit = (F.col("label") == F.col("predicted")).cast("double")
    board = predicted.groupBy("p", "k").agg(F.round(F.avg(hit), 9).alias("score"))
    named = board.select(
        (F.col("p") * 100 + F.col("k")).alias("position"), F.format_string("p=%d k=%d", "p", "k").alias("model"), "score"
    )
    return models.best_of(named)
