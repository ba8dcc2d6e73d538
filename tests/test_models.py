"""Property tests of the fitted operators."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from meterline import config as C
from meterline.operators import accounts as A
from meterline.operators import attribution as B
from meterline.operators import forecasting as M
from meterline.functions import breaks as K_breaks
from meterline.operators import series as S
from meterline.operators import series_models as K
from meterline.operators import trees as R
from meterline.sources.shared import stored

import __spark_entry__ as entry

QUERIES = entry.queries()


def clean_series(spark, days=800):
    data = [("u", dt.date(2019, 1, 1) + dt.timedelta(days=i), 5000.0 + 2.0 * i + 300.0 * (i % 7)) for i in range(days)]
    return spark.createDataFrame(data, "unit string, date date, v double").select(
        "unit", "date", F.col("v").cast("decimal(18,4)").alias("dollars"))


def test_clean_trend_and_week_are_recovered(spark):
    series = clean_series(spark)
    model = K.Candidate(breaks="none", penalty=1e-8)
    got = K.series_forecast(S.future_frame_daily(series, "unit", 28), "unit", K.DAILY, default=model).orderBy("date").collect()
    want = [5000.0 + 2.0 * i + 300.0 * (i % 7) for i in range(800, 828)]
    assert [r["forecast"] for r in got] == pytest.approx(want, rel=0.01)


def test_daily_forecast_has_every_day_and_an_ordered_band(spark, sf_dir, few):
    forecast = QUERIES["series_forecast_daily"](spark, sf_dir)
    units = QUERIES["unit_daily_series"](spark, sf_dir).select("unit").distinct().count()
    rows = forecast.collect()
    assert len(rows) == units * C.DAILY_HORIZON
    assert all(r["forecast_lower"] <= r["forecast"] <= r["forecast_upper"] for r in rows)
    checks = QUERIES["forecast_checks"](spark, sf_dir).collect()
    assert len(checks) == units and all(r["days"] == C.DAILY_HORIZON and r["ordered_bands"] and r["winner_has_least_score"] for r in checks)


def test_monthly_forecast_has_every_month(spark, sf_dir, few):
    for name, key in (("series_forecast_monthly", "unit"), ("series_forecast_monthly_sub_unit", "sub_unit")):
        rows = QUERIES[name](spark, sf_dir).collect()
        assert len(rows) == C.MONTHLY_HORIZON * len({r[key] for r in rows})
        assert all(r["forecast_lower"] <= r["forecast"] <= r["forecast_upper"] for r in rows)


def test_account_forecast_has_twelve_months(spark, sf_dir, few):
    eligible = QUERIES["account_monthly_eligible"](spark, sf_dir).count()
    assert QUERIES["account_monthly_forecast"](spark, sf_dir).count() == eligible * C.ACCOUNT_MONTH_HORIZON


def test_grid_and_budget(spark):
    whole = K.DAILY.candidates(10**6)
    assert len(whole) == 3 * 17 * 4 * 2 * 4 and len(K.MONTHLY.candidates(10**6)) == 3 * 17 * 4
    drawn = K.DAILY.candidates()
    assert len(drawn) == C.SEARCH_BUDGET and set(drawn) < set(whole) and drawn == K.DAILY.candidates() != K.DAILY.candidates(seed=1)
    with pytest.raises(ValueError):
        K.candidate_scores(clean_series(spark), "unit", K.DAILY, 60, 60, drawn[:2], budget=1)


def series_of(spark, value, days=1500):
    data = [("u", dt.date(2019, 1, 1) + dt.timedelta(days=i), float(value(i))) for i in range(days)]
    return spark.createDataFrame(data, "unit string, date date, v double").select("unit", "date", F.col("v").cast("decimal(18,4)").alias("dollars"))


def searched(spark, series, candidates, horizon=60):
    scores = K.candidate_scores(series, "unit", K.DAILY, horizon, horizon, candidates)
    best = K.candidate_search(scores, "unit", "mape").first()
    made = K.searched_forecast(S.future_frame_daily(series, "unit", horizon), "unit", K.DAILY, scores, candidates, "mape")
    return scores, candidates[best["candidate"]], [r["forecast"] for r in made.orderBy("date").collect()]


def test_search_keeps_the_best_candidate(spark):
    candidates = [K.Candidate(breaks=b, penalty=p) for b in ("none", "even_3") for p in (1e-6, 10.0)]
    scores, won, _ = searched(spark, clean_series(spark), candidates)
    means = {}
    for r in scores.collect():
        means.setdefault(r["candidate"], []).append(r["mape"])
    assert len(means) == 4 and {len(v) for v in means.values()} == {C.MAX_SPLITS}
    assert won == candidates[min(means, key=lambda k: sum(means[k]))] and won.penalty == 1e-6  # the data have no noise


def test_planted_break_changes_winner_and_forecast(spark):
    """A slope that turns: the detected break wins over none and carries the new slope on."""
    turn = lambda i: 5000 + 2 * i + 30 * max(i - 700, 0) + 100 * (i % 7)
    candidates = [K.Candidate(breaks="none", penalty=1e-6), K.Candidate(breaks="found_1", penalty=1e-6)]
    _, won, made = searched(spark, series_of(spark, turn), candidates)
    assert won.breaks == "found_1"
    assert made == pytest.approx([turn(i) for i in range(1500, 1560)], rel=0.03)
    _, straight, flat = searched(spark, series_of(spark, lambda i: 5000 + 2 * i + 100 * (i % 7)), candidates)
    assert flat == pytest.approx([5000 + 2 * i + 100 * (i % 7) for i in range(1500, 1560)], rel=0.03)


def test_planted_seasonal_break_is_used(spark):
    """A yearly cycle that trebles: terms from the break on win."""
    wave = lambda i: 9000 + 1000 * math.sin(2 * math.pi * i / 365.25) * (3 if i >= 800 else 1)
    candidates = [K.Candidate(breaks="none", penalty=1e-6), K.Candidate(breaks="none", seasonal_breaks=2, penalty=1e-6)]
    _, won, made = searched(spark, series_of(spark, wave, 1900), candidates)
    assert won.seasonal_breaks == 2
    assert made == pytest.approx([wave(i) for i in range(1900, 1960)], rel=0.05)


def test_planted_holiday_is_used(spark):
    """A dip two days before Easter Sunday, which moves from year to year: a term of its own forecasts it."""
    easters = {dt.date(2019, 4, 21), dt.date(2020, 4, 12), dt.date(2021, 4, 4), dt.date(2022, 4, 17), dt.date(2023, 4, 9)}
    dips = {d - dt.timedelta(days=2) for d in easters}
    value = lambda i: 5000 - 3000 * (dt.date(2019, 1, 1) + dt.timedelta(days=i) in dips)
    days = (dt.date(2023, 3, 1) - dt.date(2019, 1, 1)).days
    candidates = [K.Candidate(breaks="none", holidays=h, penalty=1e-6) for h in ("joint", "apart")]
    made = K.series_forecast(S.future_frame_daily(series_of(spark, value, days), "unit", 60), "unit", K.DAILY, default=candidates[1])
    told = {r["date"]: r["forecast"] for r in made.collect()}
    assert told[dt.date(2023, 4, 7)] == pytest.approx(2000, rel=0.2) and told[dt.date(2023, 4, 11)] == pytest.approx(5000, rel=0.1)


def test_easter_and_weekday_rules(spark):
    from meterline.functions.holidays import easter_sunday, nth_weekday
    known = {1995: (4, 16), 1999: (4, 4), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2024: (3, 31), 2038: (4, 25)}
    y = F.col("y").cast("int")
    rows = spark.createDataFrame([(k,) for k in known], "y int").select("y", easter_sunday(y).alias("e"), nth_weekday(y, 11, "Thu", 4).alias("t"), nth_weekday(y, 5, "Mon", -1).alias("m")).collect()
    for r in rows:
        assert r["e"] == dt.date(r["y"], *known[r["y"]])
        assert r["t"].weekday() == 3 and 22 <= r["t"].day <= 28 and r["m"].weekday() == 0 and r["m"].day >= 25


def brute_lasso(x, y, strength):
    """Coefficients of unit columns by very many plain proximal steps."""
    z = x / np.linalg.norm(x, axis=0)
    penalty, step, w = strength * np.abs(z.T @ y).max(), 1 / np.linalg.norm(z, 2) ** 2, np.zeros(z.shape[1])
    for _ in range(20_000):
        w = w + step * (z.T @ (y - z @ w))
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
    return w


@pytest.mark.parametrize("strength", [0.8, 0.4, 0.1])
def test_lasso_equals_brute_force(strength):
    rng = np.random.default_rng(int(strength * 10))
    x = rng.normal(size=(40, 8)).cumsum(axis=0)
    y = x[:, 2] * 3 - x[:, 5] + rng.normal(size=40)
    assert K_breaks.lasso(x, y, strength) == pytest.approx(brute_lasso(x, y, strength), abs=1e-3)


@pytest.mark.parametrize("k", range(6))
def test_every_setting_finds_a_strong_break(k):
    setting = K.DAILY.found[k]
    day = np.arange(2000.0)
    found = K_breaks.trend_breaks(day, 100 + day + 9 * np.maximum(day - 900, 0), setting, np.array([1300.0]))
    assert min(abs(found - 900)) <= 2 * setting.resample and 1300.0 in found
    gaps = np.diff(found)
    assert not len(gaps) or gaps.min() >= min(setting.min_distance, setting.given_distance)
    flat = K_breaks.trend_breaks(day, 100 + day, setting)
    assert len(flat) == 0 or np.all(flat <= day[-1] * (1 - setting.quiet_end))
    # a break that is given takes the place of a detected one close to it, or gives way
    near = K_breaks.trend_breaks(day, 100 + day + 9 * np.maximum(day - 900, 0), setting, np.array([903.0]))
    assert (903.0 in near) != (setting.keep_detected and setting.given_distance > 3)


def test_breaks_of_short_and_empty_series():
    setting = K.DAILY.found[0]
    for n in range(8):
        assert len(K_breaks.trend_breaks(np.arange(float(n)), np.ones(n), setting, np.array([2.0]))) <= 1
        assert K_breaks.seasonal_breaks(np.arange(float(n)), np.ones(n), K.DAILY.seasonal[0]) == []


def test_splits_do_not_leak(spark):
    labelled = M.rolling_origin_splits(clean_series(spark, 400), "unit", 30, 30)
    parts = labelled.groupBy("split", "part").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"))
    by_key = {(r["split"], r["part"]): r for r in parts.collect()}
    for k in range(1, C.MAX_SPLITS + 1):
        assert by_key[(k, "test")]["n"] == 30
        assert by_key[(k, "train")]["b"] + dt.timedelta(days=1) == by_key[(k, "test")]["a"]
        assert by_key[(k, "train")]["n"] == 400 - 30 * k


NODES = [
    {"id": 0, "left": 1, "right": 2, "feature": 0, "threshold": 0.5, "rows": 10, "value": 0.0},
    {"id": 1, "left": 3, "right": 4, "feature": 1, "threshold": 0.2, "rows": 6, "value": 0.0},
    {"id": 2, "left": 5, "right": 6, "feature": 0, "threshold": 0.8, "rows": 4, "value": 0.0},
    {"id": 3, "left": -1, "right": -1, "feature": -1, "threshold": None, "rows": 2, "value": 1.0},
    {"id": 4, "left": -1, "right": -1, "feature": -1, "threshold": None, "rows": 4, "value": 3.0},
    {"id": 5, "left": -1, "right": -1, "feature": -1, "threshold": None, "rows": 3, "value": -2.0},
    {"id": 6, "left": -1, "right": -1, "feature": -1, "threshold": None, "rows": 1, "value": 7.0},
]


def expected_value(x, known, node=0):
    """Prediction with only the known features fixed, straight from the definition."""
    n = NODES[node]
    if n["left"] < 0:
        return n["value"]
    left, right = NODES[n["left"]], NODES[n["right"]]
    if n["feature"] in known:
        return expected_value(x, known, n["left"] if x[n["feature"]] <= n["threshold"] else n["right"])
    return sum(expected_value(x, known, c["id"]) * c["rows"] / n["rows"] for c in (left, right))


def nodes_of(spark, rows, name="s", tree=0):
    given = [(name, tree, n["id"], n["left"], n["right"], n["feature"], n["threshold"], float(n["rows"]), n["value"]) for n in rows]
    return spark.createDataFrame(given, "slice string, tree int, node int, left int, right int, feature int, threshold double, rows double, value double")


def test_contributions_equal_brute_force(spark):
    points = np.array(list(itertools.product((0.1, 0.6, 0.9), (0.1, 0.9), (0.0,))))
    leaves = B.leaf_paths(nodes_of(spark, NODES), 2)
    rows = spark.createDataFrame([("s", k, [float(v) for v in x]) for k, x in enumerate(points)], "slice string, row int, inputs array<double>")
    got = {(r["row"], r["feature"]): r for r in B.attribute(rows, leaves, ("0", "1", "2")).collect()}
    assert len(got) == 3 * len(points)
    assert got[(0, "0")]["base_value"] == pytest.approx(expected_value(points[0], set()))
    for k, x in enumerate(points):
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = 0.0
            for size in range(3):
                for subset in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(2 - size) / math.factorial(3)
                    want += weight * (expected_value(x, {*subset, i}) - expected_value(x, set(subset)))
            assert got[(k, str(i))]["contribution"] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize(("rows_of_block", "trees_of_block"), [(2_000, 10), (37, 2)])
def test_contributions_add_up_to_spark_predictions(spark, monkeypatch, rows_of_block, trees_of_block):
    """Also where rows and trees come in many blocks, and with more than one slice."""
    monkeypatch.setattr(B, "ROWS", rows_of_block)
    monkeypatch.setattr(B, "TREES", trees_of_block)
    df = spark.range(400).select("id", (F.rand(1) * 4).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")).withColumn(
        "target", F.col("a") * 3 + F.when(F.col("b") > 0.5, 2.0).otherwise(0.0) * F.col("a")).cache()
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    scored, nodes = [], []
    for name, depth, trees in (("one", 4, 6), ("two", 6, 3)):
        model = GBTRegressor(labelCol="target", maxDepth=depth, maxIter=trees, seed=1).fit(rows)
        scored.append(model.transform(rows).select(F.lit(name).alias("slice"), F.col("id").alias("row"), F.array("a", "b", "c").alias("inputs"), "prediction"))
        nodes.append(B.node_table(spark, model, name))
    scored, nodes = scored[0].unionByName(scored[1]), nodes[0].unionByName(nodes[1])
    parts = B.attribute(scored.drop("prediction"), B.leaf_paths(nodes, 6), ("a", "b", "c"))
    sums = parts.groupBy("slice", "row").agg((F.sum("contribution") + F.first("base_value")).alias("s"), F.count("*").alias("n")).join(scored, ["slice", "row"]).collect()
    assert len(sums) == 800 and all(r["n"] == 3 and r["s"] == pytest.approx(r["prediction"]) for r in sums)


def test_search_scores_all_settings(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("account_id"), F.lit(1).alias("week"), F.rand(1).alias("a"),
                                 F.rand(2).alias("b")).withColumn("target", F.col("a") * 3 + F.col("b")).cache()
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    scores = R.boosted_tree_search(rows, 32, depths=(1, 3), counts=(2, 4))
    assert [(d, n) for d, n, _ in scores] == [(1, 2), (1, 4), (3, 2), (3, 4)]
    assert min(scores, key=lambda s: s[2])[:2] == (3, 4)


def test_explained_slices_add_up(spark, sf_dir):
    df = QUERIES["fit_and_attribute"](spark, sf_dir)
    sums = df.groupBy("account_id", "train_date", "quarter_explained").agg(
        F.sum("contribution").alias("s"), F.first("base_value").alias("b"), F.first("prediction").alias("p"),
        F.count("*").alias("n")).collect()
    assert sums and all(r["n"] == len(C.FEATURES) for r in sums)
    assert all(r["s"] + r["b"] == pytest.approx(r["p"], rel=1e-6, abs=1e-6) for r in sums)


def test_steps_are_scored_in_one_pass_and_models_reload(spark, tmp_path):
    """Scores from the node table equal those of the models, before and after they are kept and loaded again."""
    rows = spark.range(3000).select(
        (F.col("id") % 60).cast("string").alias("account_id"), F.floor(F.col("id") / 60).cast("int").alias("week"), F.rand(3).alias("balance"),
        *[F.lit("x").alias(c) for c in C.CATEGORICAL_FEATURES]).withColumn("dollars", F.round(F.col("balance") * 50 + F.col("week"), 2))
    panel = stored(rows)
    newest = panel.where("week = 49").withColumn("train_date", F.lit(dt.date(2020, 1, 6)))
    models = R.fit_horizons(panel, 3, depth=3, trees=4)
    models.save(str(tmp_path / "store"))
    first = {(r["account_id"], r["week_ahead"]): r["prediction"] for r in models.score(newest).collect()}
    again = {(r["account_id"], r["week_ahead"]): r["prediction"] for r in R.HorizonModels.load(spark, str(tmp_path / "store")).score(newest).collect()}
    assert first == again and len(first) == 60 * 3 and len(set(first.values())) > 10
    plan = models.score(newest)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan
    # against the library's own predictions, step by step
    assembled, _, bins = R.feature_assembly(A.horizon_values(panel, 3))
    for step in (1, 3):
        fit = R._regressor(3, 4, bins).fit(assembled.withColumn("target", F.element_at("later", step) - F.col("dollars")).where("target is not null"))
        inputs = models.pipeline.transform(R.impute(newest, R.numeric_features(newest)))
        own = B.node_table(spark, fit, "1")
        got = R.HorizonModels(models.pipeline, own, 3).score(newest).select("account_id", "prediction")
        want = fit.transform(inputs).select("account_id", F.col("prediction").alias("p"))
        assert all(r["prediction"] == pytest.approx(r["p"]) for r in got.join(want, "account_id").collect())


def test_one_prediction_per_account_and_step(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(C, "ACCOUNT_WEEK_HORIZON", 2)
    rows = QUERIES["direct_multi_horizon_forecast"](spark, sf_dir).collect()
    keys = {(r["account_id"], r["week_ahead"]) for r in rows}
    assert rows and len(keys) == len(rows) and {k[1] for k in keys} == {1, 2} and {r["population"] for r in rows} == {"real", "small"}
    assert all(r["forecast"] >= 0 for r in QUERIES["account_tree_schedule"](spark, sf_dir).collect())


def test_feature_vectors_have_no_missing_numbers(spark, sf_dir):
    df = QUERIES["feature_assembly"](spark, sf_dir)
    assert df.where(F.exists("features", lambda v: F.isnan(v) | v.isNull())).isEmpty()
    assert df.select(F.size("features").alias("n")).distinct().count() == 1
