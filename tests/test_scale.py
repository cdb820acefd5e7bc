"""Operators against brute force on skewed, tied and random data, and the shape of their plans."""

import contextlib
import io
import itertools
import os
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tamarind.functions.geo import haversine_km
from tamarind.operators import basket, features, neighbours, pivots, places, rank, scoring, selection
from tamarind.plans import loyalty
from tamarind.plans.registry import QUERIES
from tamarind.session import freeze, shared_folder
from tamarind.sources.views import Tables

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


# --- global rank --------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed,partitions", [(0, 1), (1, 5), (2, 8), (3, 23)])
def test_global_rank_equals_the_window(spark, seed, partitions):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    # A third of the rows share one value and some have none.
    values = [None if u < 0.1 else 7.0 if u < 0.43 else float(rng.integers(0, 50)) for u in rng.random(n)]
    df = spark.createDataFrame(list(zip(range(n), values)), "id long, v double").repartition(partitions)
    got = {r.id: r.row_no for r in rank.global_row_number(df, ["v", "id"]).collect()}
    window = Window.orderBy(F.col("v").asc_nulls_first(), "id")
    assert got == {r.id: r.n for r in df.withColumn("n", F.row_number().over(window)).collect()}


def test_global_rank_of_nothing(spark):
    assert rank.global_row_number(spark.range(0), ["id"]).count() == 0


def test_global_rank_keeps_rows_out_of_one_task(spark):
    df = spark.range(100_000).withColumn("v", F.lit(1))
    plan = plan_of(rank.global_row_number(df, ["v", "id"]))
    # The only single-partition step is the running total over one row per partition.
    before, _, after = plan.partition("SinglePartition")
    assert "SinglePartition" not in after and "Window" in before
    assert "HashAggregate(keys=[_part" in after and "Range (" not in plan


@pytest.mark.parametrize("n,buckets", [(1, 5), (4, 5), (7, 5), (100, 5), (101, 4)])
def test_bucket_rule(spark, n, buckets):
    df = spark.range(1, n + 1).select(F.col("id"), rank.bucket_of_rank(F.col("id"), F.lit(n), buckets).alias("b"))
    for r in df.collect():
        assert r.b == next(k for k in range(1, buckets + 1) if k == buckets or r.id * buckets <= k * n)


@pytest.mark.parametrize("bins, few", [(16, 0), (16, 30), (1024, 4096)])
@pytest.mark.parametrize("shape", ["ties", "heavy", "odd", "wide keys", "few"])
def test_selected_thresholds_give_the_scores_of_the_ranks(spark, monkeypatch, bins, few, shape):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "FEW", few)
    rng = np.random.default_rng(len(shape))
    n = {"few": 3}.get(shape, 700)
    keys = rng.choice(10**6, n, replace=False) - 500_000
    if shape == "wide keys":
        keys = rng.choice(2**62, n, replace=False) * 2 * rng.choice([-1, 1], n) + 1
    values = {
        "ties": lambda: [None if u < 0.2 else 7.0 if u < 0.6 else float(rng.integers(0, 9)) for u in rng.random(n)],
        "heavy": lambda: [float(s * 10.0**e) for s, e in zip(rng.choice([-1, 1], n), rng.uniform(-300, 300, n))],
        "odd": lambda: [float(rng.choice([np.inf, -np.inf, np.nan, 0.0, -0.0, 1e308, -1e308, 5e-324])) for _ in range(n)],
        "wide keys": lambda: [1.5] * n,
        "few": lambda: [None, 2.0, 1.0],
    }[shape]()
    df = spark.createDataFrame(list(zip(map(int, keys), values, values)), "k long, up double, down double").repartition(4)
    measures = [("up", False), ("down", True)]
    got = {r.k: (r.up_score, r.down_score) for r in selection.bucket_scores(df, "k", measures).collect()}
    ranked = rank.rank_measures(df, "k", measures)
    expected = ranked.select("k", *[rank.bucket_of_rank(F.col(f"{m}_rank"), F.col("total")).alias(m) for m, _ in measures])
    assert got == {r.k: (r.up, r.down) for r in expected.collect()}


def test_scores_neither_sort_nor_store_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    plan = plan_of(selection.bucket_scores(df, "k", [("v", False)]))
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan
    assert selection.bucket_scores(df.limit(0), "k", [("v", False)]).collect() == []


def test_frozen_rows_do_not_change(spark):
    frozen = freeze(spark.range(1000).withColumn("x", F.rand()), "random")
    assert frozen.agg(F.sum("x")).first() == frozen.agg(F.sum("x")).first()
    assert shared_folder(spark) in plan_of(frozen, "formatted")


@pytest.mark.parametrize("master,checkpoints,warehouse,folder", [
    ("local[4]", None, "file:/w", "file:/w/_frozen"), ("yarn", None, "hdfs://n/w/", "hdfs://n/w/_frozen"),
    ("yarn", "file:/shared", "file:/w", "file:/shared"), ("yarn", None, "file:/w", None),
])
def test_frozen_rows_lie_where_all_machines_reach_them(master, checkpoints, warehouse, folder):
    settings = {"spark.checkpoint.dir": checkpoints, "spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default),
        sparkContext=SimpleNamespace(master=master, getConf=lambda: {}),
    )
    if folder:
        assert shared_folder(session) == folder
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session)


# --- hot customers ------------------------------------------------------------------------------------------------
def test_hot_customer_gets_whole_results(spark):
    rng = np.random.default_rng(5)
    days = [f"2020-01-{d:02d}" for d in range(1, 29)]
    data = [(0 if rng.random() < 0.4 else int(rng.integers(1, 30)), days[rng.integers(28)], int(rng.integers(6))) for _ in range(4000)]
    sales = spark.createDataFrame(data, "customer_id long, order_date string, product_id int").withColumn(
        "order_date", F.col("order_date").cast("date")
    )
    menu = spark.createDataFrame([(i, f"p{i % 5}", i + 1) for i in range(6)], "product_id int, product_name string, price int")
    members = spark.createDataFrame([(c, "2020-01-15") for c in range(0, 30, 2)], "customer_id long, join_date string").withColumn(
        "join_date", F.col("join_date").cast("date")
    )
    wanted: dict = {}
    for c, d, p in data:
        wanted.setdefault(c, {}).setdefault(d, []).append(f"p{p % 5}")
    first = {r.customer_id: r.product_name for r in loyalty.first_item(sales, menu).collect()}
    assert first == {c: ", ".join(sorted(set(by[min(by)]))) for c, by in wanted.items()}
    after = sorted((r.customer_id, r.product_name, str(r.order_date)) for r in loyalty.first_after_join(sales, menu, members).collect())
    expected = []
    for c, by in wanted.items():
        later = [d for d in by if c % 2 == 0 and d >= "2020-01-15"]
        expected += [(c, p, min(later)) for p in by[min(later)]] if later else []
    assert after == sorted(expected)
    last = {r.customer_id: (r.product_name, str(r.order_date)) for r in loyalty.before_join(sales, menu, members).collect()}
    for c, by in wanted.items():
        earlier = [d for d in by if c % 2 == 0 and d < "2020-01-15"]
        assert last.get(c) == ((", ".join(sorted(set(by[max(earlier)]))), max(earlier)) if earlier else None)


# --- baskets ------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("block", [3, 512])
def test_pairs_equal_brute_force_with_one_giant_basket(spark, block):
    rng = np.random.default_rng(11)
    lines = [(0, f"i{i}") for i in range(40)] + [(int(rng.integers(1, 60)), f"i{rng.integers(12)}") for _ in range(400)]
    baskets: dict = {}
    for t, i in lines:
        baskets.setdefault(t, set()).add(i)
    pairs: dict = {}
    for items in baskets.values():
        for pair in itertools.combinations(sorted(items), 2):
            pairs[pair] = pairs.get(pair, 0) + 1
    count = {i: sum(i in b for b in baskets.values()) for i in {i for _, i in lines}}
    got = basket.pair_metrics(spark.createDataFrame(lines, "transaction_id long, item string"), block=block).collect()
    assert {(r.item_a, r.item_b): r.pair_count for r in got} == pairs
    for r in got:
        assert r.confidence_ab <= 1 and r.confidence_ba <= 1
        assert r.support <= min(count[r.item_a], count[r.item_b]) / len(baskets)
        assert r.lift == pytest.approx(r.confidence_ab / (count[r.item_b] / len(baskets)))
        assert r.lift == pytest.approx(r.confidence_ba / (count[r.item_a] / len(baskets)))


# --- neighbours ---------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_equal_brute_force(spark, monkeypatch, p):
    monkeypatch.setattr(neighbours, "_BLOCK", 500)
    rng = np.random.default_rng(p)
    # Two far clusters, a third of the rows at one single point, whole numbers so that distances tie.
    x = np.concatenate([rng.integers(0, 4, (80, 3)), rng.integers(50, 54, (60, 3)), np.full((70, 3), 2)]).astype(float)
    train = [(i, int(i % 3), [float(c) for c in v]) for i, v in enumerate(x)]
    test = [(1000 + i, [float(c) for c in v]) for i, v in enumerate(rng.integers(0, 55, (40, 3)))]
    found = neighbours.nearest_rows(
        spark.createDataFrame(train, "id long, label int, vec array<double>"),
        spark.createDataFrame(test, "id long, vec array<double>"), k=10, p=p,
    ).collect()
    got: dict = {}
    for r in sorted(found, key=lambda r: (r.id, r.place)):
        got.setdefault(r.id, []).append(r.neighbour)
    for i, v in test:
        d = np.abs(x - v).sum(axis=1) if p == 1 else np.sqrt(np.square(x - v).sum(axis=1))
        assert got[i] == [int(j) for j in np.lexsort((np.arange(len(x)), d))[:10]]


@pytest.mark.parametrize("p, pivot_count", [(1, 7), (2, 1), (2, 30)])
def test_pivot_index_equals_brute_force(spark, monkeypatch, p, pivot_count):
    """Far and crowded groups, a third of the rows at one point, whole numbers so that distances tie; small blocks."""
    monkeypatch.setattr(pivots, "BLOCK", 16)
    monkeypatch.setattr(pivots, "PACK", 5)
    rng = np.random.default_rng(p)
    x = np.concatenate([rng.integers(0, 4, (80, 3)), rng.integers(50, 54, (60, 3)), np.full((70, 3), 2)]).astype(float)
    train = [(i, int(i % 3), [float(c) for c in v]) for i, v in enumerate(x)] + [(999, 1, None)]
    test = [(1000 + i, [float(c) for c in v]) for i, v in enumerate(rng.integers(0, 55, (40, 3)))] + [(5000, None)]
    known = spark.createDataFrame(train, "id long, label int, vec array<double>").repartition(3)
    found = pivots.nearest_of_all(known, spark.createDataFrame(test, "id long, vec array<double>"), 10, p, pivot_count)
    got: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r.id, r.place)):
        got.setdefault(r.id, []).append((r.neighbour, r.label, r.place))
    assert got.keys() == {i for i, v in test if v}
    for i, v in test[:-1]:
        d = np.abs(x - v).sum(axis=1) if p == 1 else np.sqrt(np.square(x - v).sum(axis=1))
        assert got[i] == [(int(j), int(j % 3), place + 1) for place, j in enumerate(np.lexsort((np.arange(len(x)), d))[:10])]


def test_closest_screens_by_product_yet_equals_the_whole_sort():
    """Near copies far from the origin and exact ties: the same columns and distances as sorting all ``distances``."""
    rng = np.random.default_rng(8)
    vecs = np.repeat(rng.normal(size=(4, 64)) * 1e6, 50, axis=0) + rng.integers(0, 2, (200, 64)) * 1e-3
    asked, known = np.concatenate([vecs[::7], rng.normal(size=(10, 64))]), rng.permutation(1000)[:200].astype("int64")
    d = pivots.distances(asked, vecs, 2)
    whole = np.lexsort((np.broadcast_to(known, d.shape), d), axis=1)[:, :5]
    order, near = pivots.closest(asked, vecs, known, 5, 2)
    assert np.array_equal(order, whole) and np.array_equal(near, np.take_along_axis(d, whole, axis=1))


def test_pivot_index_of_few_rows_and_its_plan(spark):
    train = spark.createDataFrame([(1, 5, [0.0]), (2, 6, [1.0])], "id long, label int, vec array<double>")
    test = spark.createDataFrame([(9, [0.2])], "id long, vec array<double>")
    found = pivots.nearest_of_all(train, test)
    assert [(r.neighbour, r.place) for r in found.orderBy("place").collect()] == [(1, 1), (2, 2)]
    nothing = pivots.nearest_of_all(train.filter("id < 0"), test)
    assert nothing.collect() == [] and nothing.dtypes == found.dtypes
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pivots.nearest_of_all(train, test))
        assert "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_fewer_training_rows_than_k(spark):
    train = spark.createDataFrame([(1, 5, [0.0]), (2, 6, [1.0])], "id long, label int, vec array<double>")
    test = spark.createDataFrame([(9, [0.2])], "id long, vec array<double>")
    assert [(r.neighbour, r.place) for r in neighbours.nearest_rows(train, test, 10).orderBy("place").collect()] == [(1, 1), (2, 2)]
    nothing = neighbours.nearest_rows(train.filter("id < 0"), test, 10)
    assert nothing.collect() == [] and nothing.dtypes == neighbours.nearest_rows(train, test, 10).dtypes


def test_vote_prefers_the_smaller_label(spark):
    train = spark.createDataFrame([(1, 7, [0.0]), (2, 3, [1.0]), (3, 7, [2.0])], "id long, label int, vec array<double>")
    test = spark.createDataFrame([(9, [-1.0])], "id long, vec array<double>")
    assert {r.k: r.predicted for r in neighbours.classify(train, test, [1, 2, 3], (2,)).collect()} == {1: 7, 2: 3, 3: 7}


@pytest.mark.parametrize("p", [1, 2])
def test_votes_over_blocks_use_every_row_and_none_on_the_driver(spark, monkeypatch, p):
    """All fitted rows vote, dealt over several blocks and chunks; no row is collected to fit them."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    monkeypatch.setattr(neighbours, "fitted_rows", lambda *a, **k: pytest.fail("fitted rows collected on the driver"))
    rng = np.random.default_rng(p)
    x = np.concatenate([rng.integers(0, 4, (50, 2)), np.full((30, 2), 2)]).astype(float)
    labels = [int(i % 4) for i in range(len(x))]
    train = spark.createDataFrame([(i, labels[i], [float(c) for c in v]) for i, v in enumerate(x)], "id long, label int, vec array<double>")
    asked = [(1000 + i, [float(c) for c in v]) for i, v in enumerate(rng.integers(0, 5, (20, 2)))] + [(1000, [0.0, 0.0])]
    got = neighbours.classify(train, spark.createDataFrame(asked, "id long, vec array<double>"), [1, 3, 10], (p,)).collect()
    assert len(got) == 3 * len(asked)
    want = []
    for i, v in asked:
        d = np.abs(x - v).sum(axis=1) if p == 1 else np.sqrt(np.square(x - v).sum(axis=1))
        order = np.lexsort((np.arange(len(x)), d))
        for k in (1, 3, 10):
            votes = np.bincount([labels[j] for j in order[:k]], minlength=4)
            want.append((i, k, int(votes.argmax())))
    assert sorted((r.id, r.k, r.predicted) for r in got) == sorted(want)


def _nearest_by_brute_force(a, x, ids, labels, k, p, apart):
    for i, v in enumerate(a):
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.abs(x - v).sum(axis=1) if p == 1 else np.sqrt(np.square(x - v).sum(axis=1))
        met = np.flatnonzero(np.isfinite(d) & (apart[1] != apart[0][i]))
        met = met[np.lexsort((labels[met], ids[met], d[met]))][:k]
        yield d[met], ids[met], labels[met]


def _odd_vectors(rng, x):
    """One far row, one with a huge entry, rows that are not finite, and a row that comes often."""
    x[1] *= 1e7
    x[2, 3], x[3, 4], x[4, 5] = 1e300, np.nan, np.inf
    x[10:40] = x[50]
    return x


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("kind", ["normal", "offset", "odd", "ties", "equal", "tiny", "huge", "sparse", "flat", "few"])
def test_screened_search_equals_measuring_all_pairs(kind, p):
    """Distances, ids and labels to the last bit, equal distances by id and label, rows of one fold apart."""
    rng = np.random.default_rng(p)
    a, x = rng.normal(size=(60, 64)), rng.normal(size=(1500, 64))
    a, x = {
        "normal": lambda: (a, x), "offset": lambda: (a + 1e4, x + 1e4), "odd": lambda: (_odd_vectors(rng, a), _odd_vectors(rng, x)),
        "ties": lambda: (rng.integers(0, 3, (60, 3)) * 1.0, rng.integers(0, 3, (1500, 3)) * 1.0),
        "equal": lambda: (np.ones((60, 4)), np.ones((1500, 4))), "tiny": lambda: (a * 1e-30, x * 1e-30), "huge": lambda: (a * 1e160, x * 1e160),
        "sparse": lambda: (a * (rng.random(a.shape) < 0.01), x * (rng.random(x.shape) < 0.01)),
        "flat": lambda: (a[:, :0], x[:, :0]), "few": lambda: (a[:, :1], x[:5, :1]),
    }[kind]()
    ids, labels = rng.permutation(len(x)) // 2, rng.integers(0, 4, len(x))
    apart = rng.integers(0, 5, len(a)), rng.integers(0, 5, len(x))
    kept = neighbours._Kept(len(a), 10)
    for part in np.array_split(np.arange(len(x)), 3):
        neighbours._search(kept, a, x[part], ids[part], labels[part], p, (apart[0], apart[1][part]))
    for i, (near, other, label) in enumerate(_nearest_by_brute_force(a, x, ids, labels, 10, p, apart)):
        n = len(near)
        assert np.array_equal(kept.near[i, :n], near) and np.isinf(kept.near[i, n:]).all()
        assert np.array_equal(kept.other[i, :n], other) and np.array_equal(kept.label[i, :n], label)


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("odd", [False, True])
def test_few_pairs_are_measured(monkeypatch, p, odd):
    """The work entry by entry is a small share of all pairs, with rows far from all others as well."""
    rng, pairs, measured = np.random.default_rng(p), [], neighbours._measured
    monkeypatch.setattr(neighbours, "_measured", lambda a, b, p: pairs.append(len(a)) or measured(a, b, p))
    a, x = rng.normal(size=(200, 64)), rng.normal(size=(8192, 64))
    if odd:
        x[1], x[2, 3], a[1], a[2, 3] = x[1] * 1e7, 1e300, a[1] * 1e7, 1e200
    kept = neighbours._Kept(len(a), 10)
    neighbours._search(kept, a, x, np.arange(len(x)), np.zeros(len(x), "int64"), p)
    assert len(a) * 10 <= sum(pairs) < len(a) * len(x) * 0.03


@pytest.mark.parametrize("section", [64 << 20, 100])
def test_votes_over_sections_with_missing_values(spark, monkeypatch, section):
    """Several packs, blocks and sections: the same folds apart, every row once, also those that repeat an id or lack a label."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 9)
    monkeypatch.setattr(neighbours, "SECTION_BYTES", section)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (90, 3)).astype(float)
    x[7, 1] = np.nan
    rows = [(i // 2, None if i % 30 == 8 else i % 3, i % 4, [float(c) for c in v]) for i, v in enumerate(x)] + [(500, 1, 2, None)]
    df = spark.createDataFrame(rows, "id long, label int, fold int, vec array<double>").repartition(4)
    votes = neighbours._votes(df, df, [1, 4], [2, 1], None, by_fold=True).collect()
    ids, labels = np.array([r[0] for r in rows[:-1]]), np.array([-(2**63) if r[1] is None else r[1] for r in rows[:-1]])
    folds, want = np.array([r[2] for r in rows[:-1]]), []
    for p in (1, 2):
        for i, (_, _, near) in enumerate(_nearest_by_brute_force(x, x, ids, labels, 4, p, (folds, folds))):
            for k in (1, 4):
                names, n = np.unique(near[:k], return_counts=True)
                chosen = names[n.argmax()] if len(names) else 0
                # A missing label votes; as before it reads 0 where it wins.
                want.append((rows[i][0], rows[i][1], rows[i][2], p, k, max(int(chosen), 0)))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, votes), key=key) == sorted(want, key=key)
    asked = df.select("id", "vec")
    assert neighbours.classify(df.limit(0), asked).collect() == [] and neighbours.classify(df, asked.limit(0)).collect() == []


def test_fitted_rows_are_bounded_by_an_argument(spark):
    train = spark.range(50).select("id", F.lit(1).alias("label"), F.array(F.col("id").cast("double")).alias("vec"))
    first, again = neighbours.fitted_rows(train, 7), neighbours.fitted_rows(train.repartition(5), 7)
    assert len(first["id"]) == 7 and list(first["id"]) == list(again["id"])


# --- landmarks ----------------------------------------------------------------------------------------------------
def test_grid_and_list_find_the_same_landmarks(spark):
    rng = np.random.default_rng(3)
    sites = [(i, f"s{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(-90, 90, 150), rng.uniform(-180, 180, 150)))]
    sites += [(900 + i, "dense", 10.0, 20.0) for i in range(75)] + [(990, "pole", 90.0, 0.0), (991, "line", 0.0, 180.0)]
    nowhere = [(995, "nowhere", None, 1.0)]
    pois = [(i, f"p{i}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(-90, 90, 40), rng.uniform(-180, 180, 40)))]
    pois += [(200 + i, "near", 10.0 + i / 1000, 20.0) for i in range(15)] + [(300, "line", 0.0, -179.9)]
    # Most landmarks share one coordinate; the first id is the answer there.
    pois += [(900 - i, f"stack{i % 7}", -10.0, 30.0) for i in range(500)]
    sites += [(980, "stack", -10.0, 30.0), (981, "stack", -10.01, 30.0)]
    s = spark.createDataFrame(sites + nowhere, "site_id long, site_name string, lat double, lon double")
    p = spark.createDataFrame(pois, "poi_id long, poi_name string, lat double, lon double")
    p = p.unionByName(p.limit(1).select(F.lit(-1).cast("long").alias("poi_id"), "poi_name", F.lit(None).cast("double").alias("lat"), "lon"))
    found = [places.nearest_landmark(s, p).collect(), places.nearest_landmark(s, p, list_bound=0).collect()]
    for rows in found:
        assert [(r.poi_id, r.km, r.label) for r in rows if r.site_id == 995] == [(None, None, None)]
    by_list, by_grid = (sorted((r.site_id, r.poi_id, r.km) for r in rows if r.site_id != 995) for rows in found)
    assert by_list == by_grid and len(by_list) == len(sites)
    assert {tuple(r) for r in found[0]} == {tuple(r) for r in found[1]}
    pairs = s.withColumn("one", F.lit(1)).join(
        p.select("poi_id", F.col("lat").alias("a"), F.col("lon").alias("o"), F.lit(1).alias("one")), "one"
    ).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("o")))
    best = pairs.filter("km is not null").groupBy("site_id").agg(F.min(F.struct("km", "poi_id")).alias("b")).select("site_id", "b.poi_id", "b.km")
    assert by_list == sorted((r.site_id, r.poi_id, r.km) for r in best.collect())


# --- features -----------------------------------------------------------------------------------------------------
def test_standardised_columns_have_mean_zero_and_deviation_one(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([([float(c) for c in v],) for v in rng.normal(3, 9, (500, 4))], "v array<double>")
    z = np.array([r.z for r in features.standardize_vector(df, "v", "z").select("z").collect()])
    assert np.allclose(z.mean(axis=0), 0, atol=1e-9) and np.allclose(z.std(axis=0), 1)


# --- plans --------------------------------------------------------------------------------------------------------
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
PYTHON_ALLOWED = {"ml_knn_classify", "ml_confusion", "ml_cv_knn", "ml_leaderboard"}
CHEAP_TO_BUILD = sorted(
    n for n in QUERIES if not n.startswith("ml_") and n not in ("sentiment_word_list", "basket_rules_fpgrowth")
)


@needs_tables
@pytest.mark.parametrize("name", CHEAP_TO_BUILD)
def test_plan_has_no_all_pairs_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for step in (*UNWANTED, "EvalPython", "MapInPandas"):
        assert step not in plan


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["eda_failures_by_month"](spark, FOLDER), "formatted")
    lineitem = next(part for part in plan.split("\n\n") if "l_shipdate" in part and "Scan parquet" in part)
    assert "l_comment" not in plan and "l_extendedprice" not in lineitem
    assert "GreaterThanOrEqual(l_shipdate" in lineitem and "LessThan(l_shipdate" in lineitem
    t = Tables(spark, FOLDER)
    prices = plan_of(t.price_series(), "formatted")
    assert "EqualTo(event_type,purchase)" in prices and "props" not in prices


@needs_tables
def test_large_dimensions_are_not_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("loyalty_member_flag", "launch_enrich_dims", "rfm_metrics", "basket_pairs", "hr_position_map"):
            plan = plan_of(QUERIES[name](spark, FOLDER))
            assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        # Service and dates come from the statement alone.
        assert "Join" not in plan_of(QUERIES["hr_tenure"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@needs_tables
def test_launch_reports_join_only_what_they_read(spark):
    joins = {
        0: ("eda_outcome_counts", "eda_outcome_rank_period", "eda_first_success_date", "dash_payload_bounds",
            "wr_outcome_label", "wr_success_rate", "viz_success_by_year"),
        1: ("eda_avg_payload_version", "eda_booster_payload_range", "viz_success_by_orbit", "viz_scatter_bins",
            "dash_site_outcomes", "launch_renumber", "geo_sites", "geo_marker_colors",
            "geo_marker_clusters", "eda_total_payload_customer"),
    }
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, names in joins.items():
            for name in names:
                assert plan_of(QUERIES[name](spark, FOLDER)).count("SortMergeJoin") <= most, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@needs_tables
def test_share_report_groups_once(spark):
    df = QUERIES["hr_reason_share"](spark, FOLDER)
    df.collect()
    assert "ReusedExchange" in plan_of(df).split("== Initial Plan ==")[0] + plan_of(df)


def test_hot_customer_is_split_in_shuffled_joins(spark):
    """With broadcasts off, the partition of a customer with 40 % of all rows is cut up, also below a grouping."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 200_000
    sales = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 997).cast("long").alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.xxhash64("id") % 300).cast("int")).alias("order_date"),
        (F.col("id") % 50).cast("int").alias("product_id"),
    )
    menu = spark.range(50).select(F.col("id").cast("int").alias("product_id"), F.col("id").cast("string").alias("product_name"),
                                  F.lit(1).cast("decimal(18,2)").alias("price"))
    members = spark.range(997).select(F.col("id").alias("customer_id"), F.lit("2020-06-01").cast("date").alias("join_date"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for report in (loyalty.member_flag, loyalty.pre_member_totals):
            df = report(sales, menu, members)
            got = df.collect()
            assert "skew=true" in plan_of(df).split("== Initial Plan ==")[0]
            if report is loyalty.member_flag:
                assert len(got) == n
            else:
                assert sum(r.total_items for r in got) == sales.filter("order_date < date '2020-06-01'").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pairs_pruned_by_counters_equal_the_plain_count(spark):
    rng = np.random.default_rng(5)
    lines = [(t, f"i{int(i)}") for t in range(300) for i in rng.zipf(1.4, 6) % 80] + [(900, f"i{i}") for i in range(60)]
    df = spark.createDataFrame(lines, "transaction_id long, item string")
    every = {(r.item_a, r.item_b): r for r in basket.pair_metrics(df).collect()}
    for support, counters in ((0.02, 1 << 18), (0.02, 7), (0.001, 64), (0.9, 16)):
        wanted = {k: tuple(r) for k, r in every.items() if r.support >= support}
        got = basket.pair_metrics(df, min_support=support, block=16, counters=counters)
        assert {(r.item_a, r.item_b): tuple(r) for r in got.collect()} == wanted
    assert 0 < sum(r.support >= 0.02 for r in every.values()) < len(every) / 4
    # What is counted pair by pair is less than what shares a basket: rare pairs of frequent items are gone before.
    total = F.lit(301).cast("bigint")
    pairs = basket._pairs_in_place(basket.distinct_items(df))
    left = basket._in_full_counters(pairs, total, 0.02, 1 << 18).distinct().count()
    assert left < pairs.distinct().count() / 4
    assert "LeftSemi" in plan_of(got)
    assert basket.pair_metrics(df.limit(0), min_support=0.1).count() == 0


def test_common_words_and_rare_words_score_alike(spark, monkeypatch):
    """The share that parts common from rare words chooses a plan, not a result."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(200)]
    texts = [(int(i), " ".join(words[int(w) % 200] for w in rng.zipf(1.3, int(rng.integers(1, 40)))), int(rng.integers(3)))
             for i in range(300)] + [(7, "w1 unknown", 1), (None, "w2", 0), (500, "never", 1), (501, "", 2), (502, None, 2)]
    df = spark.createDataFrame(texts, "id long, text string, label int")
    model = scoring.train_comment_model(df.filter("id < 200"))
    found = []
    for common in (1, 50, 1 << 16):
        monkeypatch.setattr(scoring, "COMMON", common)
        weights = scoring.class_weights(df, model, "id")
        found.append({r.id: list(r.weights) for r in weights.collect()})
        kept = model.words.filter(F.col("n") * common >= model.total).count()
        assert kept <= common and (kept == model.words.count()) == (common == 1 << 16)
        assert "LeftOuter" in plan_of(weights)
    assert 500 not in found[0] and None in found[0]
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for id_, weights in other.items():
            assert weights == pytest.approx(found[0][id_], abs=1e-9)
    by_hand = {r.word: (r.w0, r.w1, r.w2) for r in model.words.collect()}
    said = Counter(w for i, t, _ in texts if i == 7 for w in t.split() if w in by_hand)
    for c in range(3):
        assert found[0][7][c] == pytest.approx(model.priors[c] + sum(n * by_hand[w][c] for w, n in said.items()), abs=1e-5)
    # The cleaner runs once over what is scored, and once over what is learned from.
    assert plan_of(scoring.class_weights(df, model, "id")).count("translate(") == 1
