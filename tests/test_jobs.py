"""Jobs with state: publishing, freezing, explaining; boosted trees with sampling."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.operators import attribution as B
from meterline.operators import boosting as G
from meterline.operators import jobs as J
from meterline.sources import sinks

D = dt.date
AT = dt.datetime(2001, 1, 8, 6)


def models(spark, y, names=("a", "b"), vintages=(D(2001, 1, 1), D(2001, 1, 8))):
    rows = [("AFRICABUILDINGy", v + dt.timedelta(days=k), m, v, y, y - 1, y + 1) for v in vintages for m in names for k in range(3)]
    return spark.createDataFrame(rows, "ts_key string, date date, model string, vintage date, y double, y_lower double, y_upper double").select(
        "ts_key", "date", "model", "vintage", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("y", "y_lower", "y_upper")])


def snapshots(spark, dollars):
    rows = [(D(2001, 1, 8), D(2001, 1, 2), "O", "AFRICA", "BUILDING", "A", dollars)]
    return spark.createDataFrame(rows, "snapshot_date date, date date, platform string, region string, segment string, kind string, d double").withColumn(
        "dollars", F.col("d").cast("decimal(18,4)"))


def values(store, table, column):
    frame = store.read(table)
    return None if frame is None else sorted({(r["vintage"], float(r[column])) for r in frame.collect()})


def test_republished_vintage_is_frozen_anew(spark, tmp_path):
    store = J.VintageStore(spark, str(tmp_path / "store"))
    assert store.freeze(snapshots(spark, 5.0), "r0") == [] and store.unfinished() == []
    assert store.publish(models(spark, 10.0), ("a", "b"), "r1", AT) == [D(2001, 1, 1), D(2001, 1, 8)]
    store.freeze(snapshots(spark, 5.0), "r1")
    assert {v for _, v in values(store, "frozen", "dollars")} == {5.0}
    frozen = store.read("frozen").count()
    # nothing new: nothing is frozen twice
    assert store.freeze(snapshots(spark, 6.0), "r2") == [] and store.read("frozen").count() == frozen
    # one vintage again: its forecasts are replaced, its copy is dropped and taken anew, the other vintage stays
    store.publish(models(spark, 30.0, vintages=(D(2001, 1, 8),)), ("a", "b"), "r3", AT + dt.timedelta(hours=6))
    assert values(store, "forecast", "y") == [(D(2001, 1, 1), 10.0), (D(2001, 1, 8), 30.0)]
    assert [v for v, _ in values(store, "frozen", "dollars")] == [D(2001, 1, 1)]
    assert store.freeze(snapshots(spark, 7.0), "r3") == [D(2001, 1, 8)]
    assert values(store, "frozen", "dollars") == [(D(2001, 1, 1), 5.0), (D(2001, 1, 8), 7.0)]
    steps = sorted((r["run_id"], r["step"]) for r in store.read("ledger").where("vintage = DATE'2001-01-08'").collect())
    assert steps == [("r1", "frozen"), ("r1", "published"), ("r1", "started"), ("r3", "frozen"), ("r3", "published"), ("r3", "started")]


def test_gate_writes_nothing(spark, tmp_path):
    store = J.VintageStore(spark, str(tmp_path / "store"))
    store.publish(models(spark, 10.0), ("a", "b"), "r1", AT)
    half = models(spark, 99.0, ("a",), (D(2001, 1, 8),)).unionByName(models(spark, 99.0, vintages=(D(2001, 1, 15),)))
    with pytest.raises(ValueError, match="2001-01-08"):
        store.publish(half, ("a", "b"), "r2", AT)
    with pytest.raises(ValueError):
        store.publish(models(spark, 1.0).limit(0), ("a",), "r3", AT)
    assert values(store, "forecast", "y") == [(D(2001, 1, 1), 10.0), (D(2001, 1, 8), 10.0)]
    assert store.read("ledger").where("run_id <> 'r1'").isEmpty()


def test_run_that_breaks_off_can_be_repeated(spark, tmp_path, monkeypatch):
    store = J.VintageStore(spark, str(tmp_path / "store"))
    store.publish(models(spark, 10.0, vintages=(D(2001, 1, 1),)), ("a", "b"), "r1", AT)
    store.freeze(snapshots(spark, 5.0), "r1")
    write = sinks.write_vintages

    def broken(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(sinks, "write_vintages", broken)
    with pytest.raises(OSError):
        store.publish(models(spark, 20.0), ("a", "b"), "r2", AT)
    assert store.unfinished() == [D(2001, 1, 8)]
    assert values(store, "forecast", "y") == [(D(2001, 1, 1), 10.0)]
    monkeypatch.setattr(sinks, "write_vintages", write)
    for _ in range(2):  # a run that is repeated leaves the same tables behind
        store.publish(models(spark, 20.0), ("a", "b"), "r2", AT)
        store.freeze(snapshots(spark, 5.0), "r2")
        assert store.unfinished() == [] and values(store, "forecast", "y") == [(D(2001, 1, 1), 20.0), (D(2001, 1, 8), 20.0)]
        assert store.read("frozen").count() == 2 and store.read("forecast").count() == 6


def test_second_run_explains_only_what_is_new(spark, tmp_path):
    folder, seen = str(tmp_path / "explained"), []

    def explain(features, labels, vintages):
        seen.append(vintages)
        return features.where(F.col("train_date").isin(vintages)).select("account_id", "train_date", F.lit(1.0).alias("contribution"))

    def features(*days):
        return spark.createDataFrame([(str(k), d) for d in days for k in range(2)], "account_id string, train_date date")

    first, second, third = D(2001, 1, 1), D(2001, 1, 8), D(2001, 1, 15)
    labels = spark.createDataFrame([], "train_date date")
    assert J.explain_pending(features(first), labels, folder, explain) == [first]
    assert J.explain_pending(features(first, second, third), labels, folder, explain) == [second, third]
    assert J.explain_pending(features(first, second, third), labels, folder, explain) == []
    assert seen == [[first], [second, third]]
    assert spark.read.parquet(folder).count() == 6


def boosted_rows(spark):
    return spark.range(600).select(
        F.col("id").cast("string").alias("k"), F.array(*[F.rand(s) for s in range(4)]).alias("inputs")).select(
        "k", "inputs", (F.get("inputs", F.lit(0)) * 5 + F.when(F.get("inputs", F.lit(1)) > 0.5, 2.0).otherwise(0.0)).alias("y")).cache()


def test_loss_falls_by_tree_and_a_seed_repeats(spark):
    rows = boosted_rows(spark)
    settings = G.Boosting(trees=7, depth=3, shrinkage=0.5, row_share=0.7, column_share=0.5, seed=3)
    nodes, predictions = G.boost(rows, "k", "y", 4, settings, "s")
    told = {r["k"]: r["prediction"] for r in predictions.collect()}
    # the prediction is that of the node table, and sums of contributions and base value
    scored = rows.crossJoin(G.ensembles(nodes)).select("k", "y", "inputs", "trees", *[
        G.predicted(F.col("inputs"), F.slice("trees", 1, n), 3).alias(f"p{n}") for n in range(1, 8)])
    got = scored.collect()
    assert all(r["p7"] == pytest.approx(told[r["k"]]) for r in got)
    losses = [sum((r["y"] - r[f"p{n}"]) ** 2 for r in got) for n in range(1, 8)]
    assert losses[-1] < 0.3 * losses[0] and all(b <= a * 1.02 for a, b in zip(losses, losses[1:]))
    used = nodes.where("left >= 0").groupBy("tree").agg(F.collect_set("feature").alias("f")).collect()
    assert all(len(r["f"]) <= 2 for r in used) and len({i for r in used for i in r["f"]}) > 2
    parts = B.attribute(rows.select(F.lit("s").alias("slice"), F.col("k").alias("row"), "inputs"), B.leaf_paths(nodes, 3), ("a", "b", "c", "d"))
    sums = parts.groupBy("row").agg((F.sum("contribution") + F.first("base_value")).alias("s")).collect()
    assert all(r["s"] == pytest.approx(told[r["row"]]) for r in sums)
    again = {r["k"]: r["prediction"] for r in G.boost(rows, "k", "y", 4, settings, "s")[1].collect()}
    assert all(again[k] == pytest.approx(told[k], rel=1e-9) for k in told) and len(again) == len(told)  # but for the order of sums
    # a gain no split reaches leaves single leaves
    flat, _ = G.boost(rows, "k", "y", 4, G.Boosting(trees=1, depth=3, least_gain=1e9), "s")
    assert flat.count() == 1


def test_job_from_usage_to_frozen_actuals(spark, sf_dir, tmp_path):
    """From usage to published forecasts and frozen actuals through the store, with a rerun of the newest vintage."""
    import __spark_entry__ as entry
    from meterline.operators import vintages as V
    from meterline.plans import inputs as I
    from meterline.session import prepare
    from meterline.sources.shared import one_build, stored

    def told(frame, *columns):
        return sorted(tuple(str(x) for x in r) for r in frame.select(*columns).collect())

    prepare(spark)
    store = J.VintageStore(spark, str(tmp_path / "store"))
    with one_build():
        newest = [I.vintage_before(spark, sf_dir, k) for k in (0, 1)]
        models = stored(I.model_forecast(spark, sf_dir).where(F.col("vintage").isin(newest)))
        snapshots = stored(I.usage_snapshots(spark, sf_dir).where(F.col("snapshot_date").isin(newest)))
    for run in ("first", "again"):
        assert store.publish(models, ("naive7", "naive28"), run, dt.datetime.combine(newest[0], dt.time(6))) == sorted(newest)
        store.freeze(snapshots, run)
    want = entry.queries()["ensemble_average"](spark, sf_dir).where(F.col("vintage").isin(newest))
    keys = ("ts_key", "date", "vintage")
    assert told(store.read("forecast"), *keys, F.col("y").cast("double")) == told(want, *keys, "y")
    # one frozen copy for each vintage, that of the day of its run
    frozen = store.read("frozen")
    assert frozen.groupBy("vintage").agg(F.count_distinct("pulled_at").alias("n")).where("n <> 1").isEmpty()
    latest = V.actuals_latest_frozen(frozen)
    known = snapshots.where(F.col("snapshot_date") == newest[0])
    assert latest.agg(F.sum("dollars")).first()[0] == known.agg(F.sum("dollars")).first()[0]
