"""Plans and helpers of the account queries: what is unfolded is unfolded last, where its account lies."""

import re

import numpy as np
import pytest

import __spark_entry__ as entry
from meterline.functions.breaks import lasso
from meterline.operators import explain as X
from meterline.plans import inputs as I

QUERIES = entry.queries()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def operators(lines):
    return [m.group(1) for line in lines if (m := re.match(r"[\s:+\-*()0-9]*([A-Z]\w+)", line))]


def test_dense_panel_is_not_joined_or_sorted_after_it_is_unfolded(spark, sf_dir):
    """F13, F17."""
    found = operators(optimized(QUERIES["panel_clean"](spark, sf_dir)))
    assert not {"Join", "Window", "Aggregate"} & {*found[:found.index("Generate")]}


def test_newest_weeks_are_those_of_the_whole_panel(spark, sf_dir):
    whole = I.account_week(spark, sf_dir)
    newest = whole.agg({"week": "max"}).first()[0]
    got, want = I.account_week(spark, sf_dir, 9), whole.where(whole.week > newest - 9)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not want.isEmpty()


def test_predictions_are_stored_before_their_steps(spark, sf_dir):
    """F14, F19, F22."""
    from meterline.plans import account_queries as Q
    assert "Generate" in operators(optimized(Q.predictions(spark, sf_dir)))


def test_days_are_smoothed_as_weeks(spark, sf_dir):
    """the fold over runs stands below the unfolding to days."""
    lines = optimized(QUERIES["smooth_over_vintages_daily"](spark, sf_dir))
    folded = next(i for i, line in enumerate(lines) if "Aggregate" in line and "collect_list(struct(train_date" in line)
    assert re.search(r"Aggregate \[account_id#\d+, week#\d+\]", lines[folded])


def test_outlook_of_weekdays_is_that_of_days(spark, sf_dir):
    """far fewer rows than days, and the same sums."""
    days, weekdays = I.account_day_forecast(spark, sf_dir), I.account_weekday_forecast(spark, sf_dir)
    assert weekdays.count() * 6 < days.count()
    got, want = X.quarter_outlook(weekdays), X.quarter_outlook(days)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()


@pytest.mark.parametrize("name", ["contribution_strength", "kind_strength", "kind_direction", "explainer_master"])
def test_long_contributions_are_not_moved(spark, sf_dir, name):
    """F15, F16, F23, F26: no exchange between the unfolding to features and what groups them."""
    lines = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().splitlines()
    unfolded = next(i for i, line in enumerate(lines) if "Generate" in line)
    # columns of the tree on the left: an exchange above the unfolding stands on its own branch
    above = [line for line in lines[:unfolded] if "Exchange hashpartitioning" in line and line.index("Exchange") < lines[unfolded].index("Generate")]
    assert not above


def plain_lasso(x, y, strength, rounds, tolerance=1e-6):
    """Coordinate descent as it is written down."""
    z = x / np.linalg.norm(x, axis=0)
    gram, moment = z.T @ z, z.T @ y
    top = np.abs(moment).max()
    w, slope = np.zeros(len(moment)), moment.copy()
    for share in np.geomspace(1.0, strength, 8):
        for _ in range(rounds):
            moved = 0.0
            for j in np.flatnonzero((w != 0) | (np.abs(slope) > share * top)):
                was, full = w[j], slope[j] + w[j]
                w[j] = np.sign(full) * max(abs(full) - share * top, 0.0)
                if w[j] != was:
                    slope -= gram[:, j] * (w[j] - was)
                    moved = max(moved, abs(w[j] - was))
            if moved <= tolerance * top:
                break
    return w


@pytest.mark.parametrize("strength", [0.2, 0.5, 0.9])
def test_quick_lasso_takes_the_same_steps(strength):
    """what the plain loop gives, stopped anywhere; products of matrices may differ in the last bit."""
    rng = np.random.default_rng(3)
    for rounds in (1, 7, 60):
        x, y = np.maximum(np.arange(60.0)[:, None] - rng.uniform(0, 55, 25), 0), rng.normal(size=60) * 1e5
        assert np.allclose(lasso(x, y, strength, rounds), plain_lasso(x, y, strength, rounds), rtol=1e-6, atol=1e-3)
