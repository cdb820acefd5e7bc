"""Hand-made rows for the rules that decide results: nulls, ties, rounding, sentinels."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tamarind.functions import dates, labels, numbers, text, vectors
from tamarind.functions.geo import EARTH_RADIUS_KM, haversine_km
from tamarind.operators import basket, features, missing, models, places, rank, scoring, summary
from tamarind.plans import customer_value, exploration, launches, loyalty, series, workforce

D = dt.date


def value(spark, column, **cells):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in cells.items())
    df = spark.createDataFrame([tuple(v for _, v in cells.values())], schema)
    return df.select(column.alias("v")).first().v


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- ranks and scores ---------------------------------------------------------------------------------------------
def metrics(spark, data):
    return spark.createDataFrame(data, "customer_id long, recency int, frequency double, monetary double")


def test_quintiles_of_seven(spark):
    scores = customer_value.rfm_scores(metrics(spark, [(i, 100 - i, float(i), float(i)) for i in range(1, 8)]))
    assert [r.recency_score for r in scores.orderBy("customer_id").collect()] == [1, 2, 3, 3, 4, 5, 5]
    assert rows(scores.select("rfm_score"), "rfm_score")[0] == ("111",)


def test_rank_ties_and_nulls(spark):
    df = metrics(spark, [(1, 5, 1.0, None), (2, 5, 1.0, 3.0), (3, 9, None, 3.0), (4, None, 2.0, -1.0)])
    ranked = rank.rank_measures(df, "customer_id", [("recency", True), ("frequency", False), ("monetary", False)])
    got = {r.customer_id: (r.recency_rank, r.frequency_rank, r.monetary_rank, r.total) for r in ranked.collect()}
    assert got == {3: (1, 1, 4, 4), 1: (2, 2, 1, 4), 2: (3, 3, 3, 4), 4: (4, 4, 2, 4)}
    assert {r.customer_id: r.recency for r in ranked.collect()} == {1: 5.0, 2: 5.0, 3: 9.0, 4: None}


def test_first_membership_year_gives_nulls(spark):
    day = D(2001, 9, 1)
    transactions = spark.createDataFrame(
        [(1, D(2001, 8, 1), 10), (1, D(2001, 8, 1), 5), (2, D(2001, 7, 1), 30), (0, D(2001, 7, 1), 9), (9, D(2001, 7, 1), 9)],
        "customer_id long, purchase_date date, gmv int",
    ).withColumn("gmv", F.col("gmv").cast("decimal(18,2)"))
    registered = spark.createDataFrame(
        [(1, D(2001, 5, 24), None), (2, D(1997, 1, 1), D(1999, 6, 1)), (0, D(1997, 1, 1), None)],
        "customer_id long, created_date date, stop_date date",
    )
    got = rows(customer_value.rfm_metrics(transactions, registered, day), "customer_id")
    # Customer 2: four full years to the report date, two full years to the stop date.
    assert got == [(1, 31, None, None), (2, 62, 0.25, 15.0)]


# --- loyalty ------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def shop(spark):
    sales = [
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
        ("A", D(2021, 1, 13), 3), ("A", D(2021, 1, 14), 3), ("A", D(2021, 1, 14), 1),
        ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1),
        ("B", D(2021, 1, 11), 1), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3),
    ]
    return (
        spark.createDataFrame(sales, "customer_id string, order_date date, product_id int"),
        spark.createDataFrame([(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)], "product_id int, product_name string, price int"),
        spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))], "customer_id string, join_date date"),
    )


def test_loyalty_totals(shop):
    sales, menu, members = shop
    assert [(r[0], int(r[1])) for r in loyalty.total_spent(sales, menu).collect()] == [("A", 86), ("B", 60), ("C", 24)]
    assert rows(loyalty.visit_days(sales), "customer_id") == [("A", 5), ("B", 4), ("C", 1)]
    assert rows(loyalty.top_item(sales, menu)) == [("ramen", 5)]
    assert rows(loyalty.favourite_item(sales, menu), "customer_id", "product_name") == [
        ("A", "ramen", 3), ("B", "sushi", 3), ("C", "ramen", 2)
    ]
    before = [(r[0], r[1], int(r[2])) for r in loyalty.pre_member_totals(sales, menu, members).collect()]
    assert before == [("A", 2, 25), ("B", 3, 40)]
    assert [(r[0], int(r[1])) for r in loyalty.points(sales, menu, "sushi").collect()] == [("A", 1060), ("B", 900), ("C", 240)]


def test_loyalty_edge_days(shop):
    sales, menu, members = shop
    assert rows(loyalty.first_item(sales, menu), "customer_id") == [("A", "curry, sushi"), ("B", "curry"), ("C", "ramen")]
    after = rows(loyalty.first_after_join(sales, menu, members), "customer_id")
    assert after == [("A", "curry", D(2021, 1, 7)), ("B", "sushi", D(2021, 1, 11)), ("B", "sushi", D(2021, 1, 11))]
    first = rows(loyalty.before_join(sales, menu, members, last=False), "customer_id")
    assert first == [("A", "curry, sushi", D(2021, 1, 1)), ("B", "curry", D(2021, 1, 1))]
    last = rows(loyalty.before_join(sales, menu, members), "customer_id")
    assert last == [("A", "curry, sushi", D(2021, 1, 1)), ("B", "sushi", D(2021, 1, 4))]


def test_points_of_the_first_week(shop):
    sales, menu, members = shop
    got = {r[0]: int(r[1]) for r in loyalty.points_first_week(sales, menu, members, "sushi", D(2021, 1, 31)).collect()}
    # A: join day, day 3 and day 6 count twice (15, 12, 12); on day 7 only sushi does (12 once, 10 twice).
    assert got == {"A": 20 * 39 + 120 + 200, "B": 400}


def test_membership_flag_and_ranking(spark, shop):
    sales, menu, members = shop
    flags = loyalty.member_flag(sales, menu, members)
    assert flags.count() == sales.count()
    assert rows(flags.groupBy("customer_id", "member").count(), "customer_id", "member") == [
        ("A", "N", 2), ("A", "Y", 5), ("B", "N", 3), ("B", "Y", 2), ("C", "N", 2)
    ]
    ranked = loyalty.member_ranking(sales, menu, members)
    assert ranked.count() == sales.count()
    assert rows(ranked.filter("customer_id = 'A'").select("order_date", "ranking").distinct(), "order_date") == [
        (D(2021, 1, 1), None), (D(2021, 1, 7), 1), (D(2021, 1, 10), 2), (D(2021, 1, 13), 3), (D(2021, 1, 14), 4)
    ]
    undated = sales.unionByName(spark.createDataFrame([("A", None, 1), (None, D(2021, 1, 1), 9), ("D", None, 2)], sales.schema))
    assert loyalty.member_ranking(undated, menu, members).count() == sales.count() + 3
    assert dict(rows(loyalty.first_item(undated, menu).na.drop())) == {"A": "curry, sushi", "B": "curry", "C": "ramen", "D": "curry"}
    assert loyalty.member_month_sales(sales, menu, members, 1).count() == 7
    assert loyalty.member_month_sales(sales, menu, members, 2).count() == 0


# --- workforce ----------------------------------------------------------------------------------------------------
def test_half_even(spark):
    for given, expected in ((0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-0.4, 0.0)):
        got = value(spark, numbers.half_even(F.col("x")), x=("double", given))
        assert got == expected and math.copysign(1, got) == 1
    assert value(spark, numbers.percent(F.lit(1), F.lit(800)), x=("int", 0)) == 0.12
    assert value(spark, numbers.percent(F.lit(1), F.lit(0)), x=("int", 0)) is None


def test_null_groups_are_left_out_and_shares_use_the_rest(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), (None, 1)], "g string, x int")
    got = rows(workforce.count_report(df, ["g"], "x", share=True))
    assert got == [("a", 1, 50.0), ("b", 1, 50.0)]
    outcome = spark.createDataFrame([("x",), (None,)], "outcome string")
    assert exploration.outcome_counts(outcome).count() == 2
    assert rows(summary.value_counts(df, "g")) == [("a", 2), ("b", 1)]


def test_dates(spark):
    for given, expected in (("12/31/9999", D(2100, 12, 31)), ("1/5/2019", D(2019, 1, 5)), ("01/05/2019", D(2019, 1, 5)), (None, None), ("x", None)):
        assert value(spark, dates.parse_month_first(F.col("x")), x=("string", given)) == expected
    parse = dates.parse_any(F.col("x"), series.DATE_FORMATS)
    for given, expected in (("2021-06-14", D(2021, 6, 14)), ("6/4/2010", D(2010, 6, 4)), ("4 June 2010", D(2010, 6, 4)), ("2021--06-14", None)):
        assert value(spark, parse, x=("string", given)) == expected
    assert value(spark, dates.month_name(F.col("d")), d=("date", D(2015, 1, 10))) == "January"
    assert value(spark, dates.day_month_year(F.col("d")), d=("date", D(2020, 1, 2))) == "02/01/2020"
    assert value(spark, dates.whole_years(F.lit(D(2022, 9, 1)), F.col("d")), d=("date", D(2020, 9, 1))) == 1
    assert value(spark, dates.within_year(F.col("d"), 2015), d=("date", D(2015, 12, 31))) is True
    assert value(spark, dates.within_year(F.col("d"), 2015), d=("date", D(2016, 1, 1))) is False


def test_statement_cleaning_and_reports(spark):
    raw = spark.createDataFrame(
        [
            (workforce.LEAVER, "03/01/2019", "12/31/9999", "03/01/2018", "Hà Nội", "Chuyên viên cao cấp", "L1", None, "x"),
            (workforce.LEAVER, "04/01/2019", "12/31/9999", "09/01/2018", "Hà Nội", "Phó Giám đốc", None, None, "x"),
            (workforce.HIRE, "03/05/2019", "12/31/9999", "03/05/2019", "Hà Nội", "Cộng tác viên", "L1", None, "x"),
            (workforce.HIRE, "05/05/2019", "12/31/9999", None, "Hà Nội", "Trưởng phòng", "L1", None, "x"),
        ],
        "statement_type string, statement_valid_date string, statement_expired_date string, employee_work_date string, "
        "work_location string, job_title string, KH200 string, HAM string, employee_code string",
    )
    clean = workforce.clean_statements(raw, unused=["employee_code", "not there"])
    assert clean.columns == [c if c != "KH200" else "leader_code" for c in raw.columns if c not in ("HAM", "employee_code")]
    assert "position" not in workforce.enrich(clean.drop("job_title"), D(2020, 1, 1)).columns
    assert clean.count() == 3 and clean.filter("leader_code = 'No Leader'").count() == 1
    staff = workforce.enrich(clean, D(2020, 1, 1))
    assert rows(staff.select("position", "tenure", "valid_year", "valid_month"), "position") == [
        ("Chuyên viên", 1.0, 2019, 3), ("Cộng tác viên", 1.0, 2019, 3), ("Giám đốc", 1.0, 2019, 4)
    ]
    assert rows(workforce.kpis(staff, D(2020, 1, 1))) == [("01/01/2020", 3, 2, 66.67, 1)]
    assert rows(workforce.hires_against_leavers(staff, "job_title")) == [(3, 1, 1, 0)]
    assert rows(workforce.top_leaders(workforce.leavers(staff, "Hà Nội"), "job_title")) == [("L1", 1)]
    assert workforce.leavers(staff, "Huế").count() == 0


def test_hires_against_leavers_keeps_left_join_rules(spark):
    df = spark.createDataFrame(
        [("H", 1, 1), ("H", 2, None), ("T", 2, 1), ("T", 3, 1), ("O", 4, 1)], "statement_type string, valid_month int, x int"
    )
    got = rows(workforce.hires_against_leavers(df, "x", leaver="T", hire="H"))
    assert got == [(1, 1, None, None), (2, 0, 1, -1)]


def test_position_of_missing_title(spark):
    assert value(spark, labels.first_contained(F.col("x")), x=("string", None)) is None
    assert value(spark, labels.first_contained(F.col("x")), x=("string", "Kế toán")) is None


# --- baskets ------------------------------------------------------------------------------------------------------
LINES = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, "a"), (4, "c"), (5, "b"), (5, "c"), (5, None)]


@pytest.mark.parametrize("block", [1, 2, 512])
def test_basket_by_hand(spark, block):
    df = spark.createDataFrame(LINES, "transaction_id int, item string")
    got = {(r.item_a, r.item_b): r for r in basket.pair_metrics(df, block=block).collect()}
    assert {k: r.pair_count for k, r in got.items()} == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 2}
    ab = got["a", "b"]
    assert (ab.support, ab.confidence_ab, ab.confidence_ba) == (2 / 5, 2 / 3, 2 / 3)
    assert ab.lift == pytest.approx(2 * 5 / (3 * 3))


def test_basket_support_prunes_exactly(spark):
    df = spark.createDataFrame(LINES, "transaction_id int, item string")
    got = {(r.item_a, r.item_b) for r in basket.pair_metrics(df, min_support=0.4).collect()}
    assert got == {("a", "b"), ("b", "c")}


def test_growth_rules_agree_with_pairs(spark):
    df = spark.createDataFrame(LINES, "transaction_id int, item string")
    rules = {(r.antecedent, r.consequent): r for r in basket.growth_rules(df, min_support=0.2, min_confidence=0.1).collect()}
    assert rules["a", "b"].confidence == pytest.approx(2 / 3) and rules["a", "b"].support == pytest.approx(0.4)
    assert rules["a + c", "b"].confidence == 1.0


def test_growth_rules_all_itemsets_by_dataframes(spark):
    """Every frequent set of any size, by brute force; counted by Spark jobs, not out of trees built from an RDD."""
    import itertools

    lines = [(t, f"i{k}") for t in range(60) for k in range(6) if (t >> k) & 1 or t % (k + 2) == 0]
    df = spark.createDataFrame(lines, "transaction_id int, item string")
    rules = basket.growth_rules(df, min_support=0.1, min_confidence=0.3)
    assert "ExistingRDD" not in rules._jdf.queryExecution().executedPlan().toString()
    baskets = [{i for t2, i in lines if t2 == t} for t in range(60)]
    count = lambda s: sum(set(s) <= b for b in baskets)
    items = sorted({i for _, i in lines})
    expected = {}
    for size in range(2, len(items) + 1):
        for s in itertools.combinations(items, size):
            if count(s) >= 6:
                for c in s:
                    a = [x for x in s if x != c]
                    if count(s) / count(a) >= 0.3:
                        expected[" + ".join(a), c] = (count(s) / count(a), count(s) / 60)
    got = {(r.antecedent, r.consequent): (r.confidence, r.support) for r in rules.collect()}
    assert got.keys() == expected.keys() and any(" + " in a and a.count("+") >= 2 for a, _ in got)
    for k, (conf, sup) in expected.items():
        assert got[k] == (pytest.approx(conf), pytest.approx(sup))


# Published pair table: (pair count, confidence both ways, lift, support) with 3471 baskets in all.
@pytest.mark.parametrize("pairs,conf_ab,conf_ba,lift,support", [(203, 0.2010, 0.4732, 1.63, 0.0585), (175, 0.6530, 0.2709, 3.51, 0.0504)])
def test_lift_identity(pairs, conf_ab, conf_ba, lift, support):
    n_a, n_b = pairs / conf_ab, pairs / conf_ba
    assert round(pairs * 3471 / (n_a * n_b), 2) == lift and round(pairs / 3471, 4) == support


# --- comments -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "given,expected",
    [
        ("\nPhim quá hay luôn...mong từng tập!\n", "phim quá hay luôn mong từng tập"),
        ("Ok!!!", "ok"),
        ("a... b?!  \u3000\n", "a b"),
        ("." * 200_000 + "x" + "!" * 200_000, "x"),
        ("KO xem dc", "không xem được"),
        ("hay lắm, (rất) \"hay\" - 'ok' @bạn; “à”: \\ ?", "hay lắm rất hay okhông bạn à"),
        ("ĐC qua roi vn", "được quá rồi việt nam"),
        ("admin", "admin min"),
        ("a  b", "a b"),
        ("", ""),
        (None, None),
    ],
)
def test_comment_cleaner(spark, given, expected):
    assert value(spark, text.clean_comment(F.col("x")), x=("string", given)) == expected


def test_word_boundary_rules(spark):
    assert value(spark, text.clean_comment(F.col("x"), word_boundary=True), x=("string", "admin ko kon k")) == "admin không kon không"


def test_standardize_equals_its_steps(spark):
    samples = ["A.b!c?!.", "  x -- y  ", "“q” ; (z) \\ @", "tab\there\nnew", "...", "K."]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    steps = text.squeeze(text.blank_marks(text.strip_closing_marks(F.lower("x"))))
    for r in df.select(text.standardize(F.col("x")).alias("a"), steps.alias("b")).collect():
        assert r.a == r.b and "  " not in r.a and not set(r.a) & set(text.MARKS)


def test_object_id(spark):
    assert value(spark, text.object_id(F.col("x")), x=("string", "{'$oid': '5fa1b2'}")) == "5fa1b2"
    assert value(spark, text.object_id(F.col("x")), x=("string", "plain")) is None


def test_outcome_text(spark):
    df = spark.createDataFrame([(True, "ASDS"), (None, None), (False, "RTLS"), (None, "ASDS")], "a boolean, b string")
    got = [r.v for r in df.select(text.outcome_text(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == ["True ASDS", "None None", "False RTLS", "None ASDS"]


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0, 0.0],)], "x array<double>")
    got = df.select(vectors.softmax(F.col("x")).alias("w")).select("w", vectors.argmax(F.col("w")).alias("c")).collect()
    assert [r.c for r in got] == [1, 0] and all(sum(r.w) == pytest.approx(1) for r in got)


def word_scorer():
    """Weights by word; fails when it sees unscorable text."""

    def score(texts):
        assert all(t and len(t.split()) <= 4 for t in texts)
        return [[1, 0, 0] if "bad" in t else [0, 1, 0] if "good" in t else [0, 0, 1] for t in texts]

    return lambda: score


COMMENTS = [(1, "Good!"), (2, "bad, BAD"), (3, "so so"), (4, None), (5, "good " * 5), (6, "..."), (7, "")]


def test_pluggable_scorer_and_guards(spark):
    df = spark.createDataFrame(COMMENTS, "id int, text string")
    got = dict(rows(scoring.score_with(df, word_scorer(), max_tokens=4).select("id", "sentiment")))
    assert got == {1: 1, 2: 0, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2}


def test_trained_scorer_and_guards(spark):
    train = spark.createDataFrame(
        [("very good film", 1), ("good good", 1), ("bad film", 0), ("bad bad", 0), ("film at nine", 2), ("nine", 2)] * 3,
        "text string, label int",
    )
    model = scoring.train_comment_model(train)
    got = dict(rows(scoring.score_with_model(spark.createDataFrame(COMMENTS, "id int, text string"), model, "id").select("id", "sentiment")))
    assert got[1] == 1 and got[2] == 0 and [got[i] for i in (4, 5, 6, 7)] == [2, 1, 2, 2]
    long = spark.createDataFrame([(1, "so " * 2000 + "bad")], "id int, text string")
    assert scoring.score_with_model(long, model, "id").first().sentiment == 0


# --- money, mass, missing data ------------------------------------------------------------------------------------
def test_money_text(spark):
    df = spark.createDataFrame([(1, "2021-01-01", "$1,234"), (2, "2021-01-02", "$"), (3, "2021-01-03", ""), (4, "2021-01-04", None)],
                               "row_id int, date_text string, revenue_text string")
    assert rows(series.clean_revenue(df)) == [(1, D(2021, 1, 1), 1234.0)]


def test_mass_and_percent_text(spark):
    cases = [("4,700 kg", 4700.0), ("~4,000 kg", 4000.0), ("5,000–6,000 kg", 5000.0), ("C", None), ("0", 0.0), ("525 kg\n", 525.0), (None, None)]
    for given, expected in cases:
        assert value(spark, numbers.mass_text(F.col("x")), x=("string", given)) == expected
    assert value(spark, numbers.percent_text(F.col("x")), x=("string", "20.10%")) == pytest.approx(0.201)


def test_series_cut_offs(spark):
    prices = spark.createDataFrame([(D(2021, 6, 14), 1.0), (D(2021, 6, 15), 2.0)], "d date, close double")
    revenue = spark.createDataFrame([(D(2021, 4, 30), 3.0), (D(2021, 5, 1), 4.0)], "d date, revenue double")
    assert rows(series.price_and_revenue(prices, revenue), "series") == [
        ("revenue", D(2021, 4, 30), 3.0), ("share_price", D(2021, 6, 14), 1.0)
    ]
    assert rows(series.last_rows(prices, ["d"], 1)) == [(D(2021, 6, 15), 2.0)]


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None), (3, 4.0, None)], "id int, x double, empty string")
    assert missing.drop_empty_columns(df).columns == ["id", "x"]
    assert rows(missing.impute_mean(df, ["x"]).select("id", "x"), "id") == [(1, 2.0), (2, 3.0), (3, 4.0)]
    assert missing.require(df, "x").count() == 2 and missing.require(df).count() == 0
    assert rows(summary.null_profile(df), "column_name") == [("empty", 3, 100.0), ("id", 0, 0.0), ("x", 1, pytest.approx(100 / 3))]


def test_column_profile(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i else None) for i in range(5)], "id int, c string")
    got = {r.column_name: r for r in summary.column_profile(df, list_below=5).collect()}
    assert (got["id"].n_distinct, got["id"].value_list, got["id"].data_type) == (5, None, "int")
    assert (got["c"].n_distinct, got["c"].value_list, got["c"].null_count, got["c"].row_count) == (3, "a|b", 1, 5)
    assert summary.columns_of_type(df, text=True) == ["c"] and summary.columns_of_type(df, text=False) == ["id"]


def test_numbered_values(spark):
    df = spark.createDataFrame([(v,) for v in "bbacca"] + [(None,)], "x string")
    assert rows(summary.numbered_values(df, "x").select("position", "x", "total"), "position") == [(0, "a", 2), (1, "b", 2), (2, "c", 2)]


# --- launches -----------------------------------------------------------------------------------------------------
def test_failure_label_and_rate(spark):
    df = spark.createDataFrame([("True ASDS",), ("None None",), (None,)], "outcome string")
    labelled = launches.label_outcomes(df, labels.FAILED_LANDINGS)
    assert [r["class"] for r in labelled.collect()] == [1, 0, 1]
    assert exploration.success_rate(labelled).first()[0] == pytest.approx(2 / 3)


def test_inequality_keeps_missing_values(spark):
    df = spark.createDataFrame([("F1", 1), (None, 2), ("F9", 3)], "booster_version string, id int")
    assert rows(launches.renumber(df, "F1", ["id"]).select("id", "flight_number"), "id") == [(2, 1), (3, 2)]


def test_pattern_filters_ignore_case(spark):
    df = spark.createDataFrame([("CCA 1", "F9 v1.1", 1.0), ("cca 2", "f9 V1.1", 3.0), ("KSC", "F9 v1.1x", 9.0)],
                               "launch_site string, booster_version string, payload_mass double")
    assert exploration.site_prefix(df, "CCA", 5, ["launch_site"]).count() == 2
    assert exploration.average_payload(df, "F9 v1.1").first()[0] == 2.0


def test_dashboard_selector(spark):
    df = spark.createDataFrame([("A", 1, 10.0, "v"), ("A", 0, 20.0, "v"), ("B", 1, 30.0, "w"), ("B", 1, None, "w")],
                               "launch_site string, class int, payload_mass double, booster_version string")
    assert rows(exploration.success_pie(df), "launch_site") == [("A", 1, 33.33), ("B", 2, 66.67)]
    assert rows(exploration.success_pie(df, "A"), "class") == [("A", 0, 1), ("A", 1, 1)]
    assert exploration.payload_scatter(df, 10, 20).count() == 2 and exploration.payload_scatter(df, 0, 99, "B").count() == 1


# --- features, models, maps ---------------------------------------------------------------------------------------
def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b", True), (2, None, False), (3, "a", None)], "id int, c string, flag boolean")
    hot = features.one_hot(df, ["c"])
    assert hot.columns == ["id", "flag", "c_a", "c_b"]
    assert rows(features.as_doubles(hot), "id") == [(1.0, 1.0, 0.0, 1.0), (2.0, 0.0, 0.0, 0.0), (3.0, None, 1.0, 0.0)]
    many = features.one_hot(spark.range(1500).withColumn("v", F.col("id").cast("string")), ["v"])
    assert len(many.columns) == 1501
    assert rows(features.one_hot_indexed(df, "c").select("id", "c_index"), "id") == [(1, 1), (2, None), (3, 0)]


def test_scaler(spark):
    df = spark.createDataFrame([([5.0, 1.0],), ([5.0, 3.0],)], "v array<double>")
    assert sorted(r.s for r in features.standardize_vector(df, "v", "s").select("s").collect()) == [[0.0, -1.0], [0.0, 1.0]]
    other = spark.createDataFrame([([0.0, 0.0],), ([2.0, 4.0],)], "v array<double>")
    assert [r.s for r in features.standardize_vector(df.limit(1), "v", "s", fit_on=other).select("s").collect()] == [[4.0, -0.5]]
    holes = spark.createDataFrame([([1.0, 2.0, 5.0],), ([3.0, None, 9.0],), (None,)], "v array<double>")
    scaled = sorted(str(r.s) for r in features.standardize_vector(holes, "v", "s").select("s").collect())
    assert scaled == ["None", "[-1.0, 0.0, -1.0]", "[1.0, None, 1.0]"]
    with pytest.raises(ValueError):
        features.standardize_vector(df.union(holes), "v")
    with pytest.raises(Exception, match="longer"):
        features.standardize_vector(holes, "v", fit_on=df).collect()


def test_split_depends_on_the_key_only(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = features.train_test_split(df, "k")
    assert train.count() + test.count() == 2000 and 0.17 < test.count() / 2000 < 0.23
    again = features.train_test_split(df.repartition(13), "k")[1]
    assert sorted(r.k for r in again.collect()) == sorted(r.k for r in test.collect())


def test_confusion_and_leaderboard(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "label int, predicted int")
    assert rows(models.confusion(df)) == [(0, 0, 1), (0, 1, 1), (1, 1, 2)]
    assert rows(models.confusion_matrix(df, [0, 1])) == [(0, 1, 1), (1, 0, 2)]
    assert models.accuracy(df, prediction="predicted").first().score == 0.75
    board = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.9), (2, "c", 0.9)], "position int, model string, score double")
    assert [r.model for r in models.leaderboard(board).collect()] == ["b", "c", "a"]


def test_distance(spark):
    km = value(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)), x=("int", 0))
    assert km == pytest.approx(EARTH_RADIUS_KM * math.pi / 2)
    coast = haversine_km(F.lit(28.563197), F.lit(-80.576820), F.lit(28.56367), F.lit(-80.56803))
    assert value(spark, coast, x=("int", 0)) == pytest.approx(0.860, abs=0.005)
    assert value(spark, text.distance_label(F.lit("Railway"), F.lit(1.234)), x=("int", 0)) == "Railway       1.23 KM"


def test_map_layers(spark):
    df = spark.createDataFrame([(2, "A", 9.0, 9.0, 0), (1, "A", None, 1.0, 1), (3, "A", 5.0, 5.0, 1), (4, "B", 0.0, 0.0, None)],
                               "id int, site string, lat double, lon double, class int")
    assert rows(places.site_coordinates(df, "site", "lat", "lon", "id"), "site") == [("A", 9.0, 9.0), ("B", 0.0, 0.0)]
    assert [r.marker_color for r in places.marker_layer(df).orderBy("id").collect()] == ["green", "red", "green", "red"]
    assert rows(places.marker_clusters(df.na.drop()), "cell_lat") == [(0, 0, 2, 0.5)]
