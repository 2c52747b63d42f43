"""Category codes, folds side by side, losses, reloaded models, the feature job's
own figures and its partitions."""

import datetime as dt
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import features as fe
from larder.operators import forecast as fc
from larder.plans import jobs
from larder.sources import files
from tests import fixtures as fx

NUM, CAT = ["lag_7", "is_weekend"], ["kind"]


@pytest.fixture(scope="module")
def feats(spark):
    rng = np.random.default_rng(1)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "S", item, float(20 * k + 5 * (i % 7 >= 5) + rng.integers(0, 4)),
             float(rng.integers(10, 50)) if i >= 7 else None, int(i % 7 >= 5), "XYZ"[k])
            for k, item in enumerate(("A", "B", "C")) for i in range(40)]
    return spark.createDataFrame(rows, "date date, store_id string, item_id string, sales double, lag_7 double, is_weekend int, kind string")


def test_split_of_features_and_target(spark, feats):
    assert fc.feature_target_split(feats) == (NUM, CAT)
    assert fc.feature_target_split(feats.drop("store_id").withColumn("flag", F.lit(True))) == ([*NUM, "flag"], CAT)
    with pytest.raises(ValueError, match="no column sales"):
        fc.feature_target_split(feats.drop("sales"))
    with pytest.raises(ValueError, match="day"):
        fc.feature_target_split(feats.withColumn("day", F.col("date")))


def test_unseen_categories_share_a_bucket(spark):
    known = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "kind string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "kind string")
    coded = fc.category_index(["kind"]).fit(known).transform(rows).collect()
    assert {r.kind: int(r.kind__idx) for r in coded} == {"b": 0, "a": 1, "c": 2, "new": 3, None: 3}


def test_unseen_categories_are_scored(spark, feats):
    model = fc.train_model(feats.filter("kind <> 'Z'"), NUM, CAT, max_iter=2)
    out = fc.predict(model, feats, NUM)
    assert out.columns == [*feats.columns, "prediction"] and out.filter("prediction IS NULL").count() == 0


def test_folds_side_by_side_equal_one_after_the_other(spark, feats):
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=3, horizon=5)
    one, many = (fc.cross_validate(feats, folds, NUM, CAT, parallel=n, max_iter=4).first() for n in (1, 3))
    assert one.asDict() == many.asDict() and one.n_folds == 3
    scored = fc.score_folds(feats, folds, NUM, CAT, max_iter=2)
    assert scored.columns == ["fold", "store_id", "item_id", "date", "sales", "prediction"] and scored.count() == 3 * 5 * 3
    # each fold by itself, without the shared vectors
    by_hand = []
    for f in (1, 2, 3):
        d = folds.filter(F.col("fold") == f)
        train, test = (fc.date_semi_join(feats, d.filter(F.col("role") == r)) for r in ("train", "test"))
        p = fc.predict(fc.train_model(train, NUM, CAT, max_iter=4), test, NUM)
        by_hand.append(fc.wmape(p, "sales", "prediction").first()[0])
    assert many.wmape == pytest.approx(np.mean(by_hand))
    none = fc.cross_validate(feats, folds.filter("fold > 9"), NUM, CAT).first()
    assert (none.rmse, none.wmape, none.n_folds) == (None, None, 0)


def test_a_fold_that_fails_ends_the_run(spark, feats):
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=2, horizon=5)
    with pytest.raises(Exception, match="(?i)maxIter"):
        fc.cross_validate(feats, folds, NUM, CAT, max_iter=-1)


def test_training_loss_falls_and_beats_the_mean(spark, feats):
    model = fc.train_model(feats, NUM, CAT, max_iter=6, step_size=0.3)
    losses = fc.training_losses(model, feats, NUM)
    assert len(losses) == 6 and all(b < a for a, b in zip(losses, losses[1:], strict=False))
    got = fc.predict(model, feats, NUM)
    assert losses[-1] == pytest.approx(got.agg(F.avg((F.col("sales") - F.col("prediction")) ** 2)).first()[0])
    assert losses[-1] < feats.agg(F.var_pop("sales")).first()[0] / 10


def test_reloaded_model_scores_alike(spark, feats, tmp_path):
    model = fc.train_model(feats, NUM, CAT, max_iter=3)
    row = jobs.reload_check(spark, model, str(tmp_path / "model"), feats, NUM).first()
    assert (row.n_scored, row.n_diff, row.n_null) == (feats.count(), 0, 0)


PARAMS = dict(min_group_rows=1)


@pytest.fixture(scope="module")
def csvs(tmp_path_factory):
    return fx.write_csvs(os.path.join(tmp_path_factory.mktemp("job"), "csv"))


def _run(spark, csvs, out, report=None, **params):
    return jobs.feature_job(spark, csvs["sales"], csvs["calendar"], csvs["prices"], str(out), jobs.Params(**{**PARAMS, **params}), report)


def _by(df, *keys):
    return {tuple(r[k] for k in keys): (r.n, r.empty) for r in df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(F.col("sell_price").isNull().cast("int")).alias("empty")).collect()}


def test_filtered_runs_replace_their_own_rows_only(spark, csvs, tmp_path):
    first = _by(_run(spark, csvs, tmp_path / "f"), "store_id")
    again = _by(_run(spark, csvs, tmp_path / "f", stores_filter=["CA_7"], price_ffill_limit=0), "store_id")
    assert again["CA_7",][0] == first["CA_7",][0] and again["CA_7",][1] > first["CA_7",][1]
    assert {k: v for k, v in again.items() if k != ("CA_7",)} == {k: v for k, v in first.items() if k != ("CA_7",)}
    before = _by(files.read_features(spark, str(tmp_path / "f")), "store_id", "item_id")
    item = fx.ITEMS[1]
    after = _by(_run(spark, csvs, tmp_path / "f", stores_filter=["TX_4"], items_filter=[item], price_ffill_limit=0), "store_id", "item_id")
    assert {k for k in before if before[k] != after[k]} == {("TX_4", item)} and set(before) == set(after)
    assert _by(_run(spark, csvs, tmp_path / "new", items_filter=[item]), "item_id").keys() == {(item,)}
    assert _by(_run(spark, csvs, tmp_path / "f"), "store_id") == first  # a run without filters replaces everything


def test_store_filter_prunes_partitions(spark, csvs, tmp_path):
    feats = _run(spark, csvs, tmp_path / "f").filter("store_id = 'CA_7'")
    assert feats.count() == len(fx.ITEMS) * fx.N_DAYS
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*store_id#\d+ = CA_7", plan)
    assert len(feats.inputFiles()) > 0 and feats.select(F.input_file_name()).distinct().filter(~F.col("input_file_name()").contains("store_id=CA_7")).count() == 0


def test_the_job_counts_its_own_rows(spark, csvs, tmp_path):
    report: dict = {}
    feats = _run(spark, csvs, tmp_path / "f", report, min_group_rows=fx.N_DAYS)
    want = fe.feature_null_counts(feats).first().asDict()
    assert {k: report[k] for k in want} == want and report["rows_dropped"] == 0 and report["rows_in"] == want["n_rows"]
    _run(spark, csvs, tmp_path / "g", report, min_group_rows=fx.N_DAYS + 1)
    assert report["rows_in"] == report["rows_dropped"] == len(fx.STORES) * len(fx.ITEMS) * fx.N_DAYS and report["n_rows"] == 0


def test_the_figures_take_no_second_pass(spark, feats):
    """Both observations lie in the one plan that is written."""
    from pyspark.sql import Observation
    df = fe.observe_null_counts(fe.drop_sparse_groups(feats, 41, observation=Observation()), Observation(), ["lag_7"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 2 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_item_mean_without_look_ahead(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 3, 4)]
    rows = [("S1", "A", days[0], 2.0), ("S2", "A", days[0], 4.0), ("S1", "A", days[1], 6.0), ("S1", "A", days[2], None),
            ("S1", "A", days[3], 8.0), ("S1", "B", days[0], 5.0), ("S1", "B", days[1], 5.0), ("S1", "Z", days[0], 0.0), ("S1", "Z", days[1], 1.0)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, sell_price double")
    got = {(r.store_id, r.item_id, r.date.day): r.price_rel_mean for r in fe.price_rel_mean(df, as_of=True).collect()}
    assert got == {("S1", "A", 1): None, ("S2", "A", 1): None, ("S1", "A", 2): 2.0, ("S1", "A", 3): None, ("S1", "A", 4): 2.0,
                   ("S1", "B", 1): None, ("S1", "B", 2): 1.0, ("S1", "Z", 1): None, ("S1", "Z", 2): None}
    later = df.union(spark.createDataFrame([("S9", "A", dt.date(2020, 2, 1), 99.0)], df.schema))
    again = {(r.store_id, r.item_id, r.date.day): r.price_rel_mean for r in fe.price_rel_mean(later, as_of=True).filter("date < '2020-02-01'").collect()}
    assert again == got  # what comes later changes nothing
    assert fe.price_rel_mean(later).filter("date = '2020-01-01' AND store_id = 'S2'").first().price_rel_mean != 4.0 / 5.0


def test_only_dates_are_broadcast(spark, feats):
    day = F.unix_date("date").alias("date")
    numbers = feats.select(day, "sales")
    plans = [fc.date_semi_join(a, b)._jdf.queryExecution().optimizedPlan().toString() for a, b in (
        (feats, feats.limit(3)), (numbers, numbers.limit(3)))]
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]
    assert fc.date_semi_join(numbers, numbers.limit(1)).count() == 3


def test_places_in_a_tree_are_looked_up(spark, feats):
    """No RDD of places is written and checkpointed; the trees are the same as with one."""
    pipeline = fc.gbt_pipeline(CAT, max_iter=3)
    trees = pipeline.getStages()[-1]
    assert not trees.getCacheNodeIds() and trees.getCheckpointInterval() == 10
    rows = fc.assemble_numeric(feats, NUM)
    looked_up = pipeline.fit(rows).stages[-1].toDebugString
    trees.setCacheNodeIds(True)
    kept = pipeline.fit(rows).stages[-1].toDebugString
    assert looked_up.split("\n")[1:] == kept.split("\n")[1:]


def test_constant_slots_are_kept_from_the_trees(spark, feats):
    """Same predictions as from all slots, also for rows whose slots were constant in training."""
    full = feats.filter("lag_7 IS NOT NULL")  # both 0/1 indicators are constant there
    rows = fc.assemble_numeric(full, NUM)
    assert fc.varying_slots(rows) == [0, 1] and fc.varying_slots(rows.filter("is_weekend = 0")) == [0]
    slim, plain = fc.train_model(full, NUM, CAT, max_iter=5), fc.gbt_pipeline(CAT, max_iter=5).fit(rows)
    assert (slim.stages[-1].numFeatures, plain.stages[-1].numFeatures) == (3, 5)
    a, b = ([tuple(r) for r in fc.predict(m, feats, NUM).orderBy("item_id", "date").collect()] for m in (slim, plain))
    assert a == b and fc.predict(slim, feats, NUM).columns == [*feats.columns, "prediction"]
    flat = feats.withColumns({"lag_7": F.lit(1.0), "is_weekend": F.lit(1)})
    assert fc.varying_slots(fc.assemble_numeric(flat, NUM)) == [] and fc.train_model(flat, NUM, [], max_iter=1).stages[-1].numFeatures == 4


def test_tasks_of_fits_side_by_side(spark, feats, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert (fc.fit_tasks(feats, 1), fc.fit_tasks(feats, cores)) == (cores, 1)
    monkeypatch.setattr(fc, "FIT_TASK_ROWS", 7)
    assert fc.fit_tasks(feats, cores) == -(-120 // 7)  # what a task holds is bounded, whatever the cores
    seen, fit = [], fc.train_model
    monkeypatch.setattr(fc, "train_model", lambda train, *a, **kw: seen.append(train.rdd.getNumPartitions()) or fit(train, *a, **kw))
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=2, horizon=5)
    models: dict = {}
    scored = fc.score_folds(feats.repartition(11), folds, NUM, CAT, tasks=3, models=models, max_iter=2)
    assert seen == [3, 3] and scored.count() == 2 * 5 * 3
    for f, m in models.items():  # each fold's rows are scored by the model that is handed out
        test = fc.date_semi_join(feats, folds.filter((F.col("fold") == f) & (F.col("role") == "test")))
        keys = ("item_id", "date", "prediction")
        assert sorted(fc.predict(m, test, NUM).select(*keys).collect()) == sorted(scored.filter(F.col("fold") == f).select(*keys).collect())
    assert sorted(models) == [1, 2]


def test_training_check_takes_all_trees(spark, monkeypatch):
    """The loss is followed over every tree of the setting, and no fold is fitted twice."""
    from larder.catalog import queries as q
    rng = np.random.default_rng(3)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "S", "AB"[k], "D", "C", "T", float(9 * k + 4 * (i % 7 >= 5) + rng.integers(0, 9)), int(i % 7), float(rng.integers(0, 99)))
            for k in range(2) for i in range(100)]
    fm = spark.createDataFrame(rows, "date date, store_id string, item_id string, dept_id string, cat_id string, state_id string, sales double, day_of_week int, lag_7 double")
    fm = fm.withColumns({c: F.lit(None).cast("double") for c in q.GBT_NUMERIC if c not in fm.columns})
    ready = fc.assemble_numeric(fm, q.GBT_NUMERIC).coalesce(1).cache()
    trees = q.FEW_TREES + 3
    monkeypatch.setattr(q, "_assembled", lambda *_: ready)
    monkeypatch.setattr(q, "feature_matrix", lambda *_: ready)
    monkeypatch.setattr(q, "GBT", {**q.GBT, "max_iter": trees})
    fits, losses, fit, follow = [], [], fc.train_model, fc.training_losses
    monkeypatch.setattr(fc, "train_model", lambda *a, **kw: fits.append(kw["max_iter"]) or fit(*a, **kw))
    monkeypatch.setattr(fc, "training_losses", lambda *a: losses.append(follow(*a)) or losses[-1])
    row = q.QUERIES["gbt_training_check"](spark, "-").first()
    assert [len(x) for x in losses] == [trees] and fits == [trees] * 3
    assert (row.n_folds, row.trees_better, row.loss_falls) == (3, True, True)
