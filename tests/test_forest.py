import numpy as np
import pytest
from pyspark.sql import functions as F

from burstwatch import detect, features
from burstwatch.operators.quantiles import exact_quantiles
from burstwatch.schemas import FEATURES


def training_rows(spark, n=4000):
    """Rows with spread in every feature, and their number as page."""
    noise = [F.rand(seed=i).alias(c) if "ratio" in c else (F.exp(F.randn(seed=i)) * 10).alias(c) for i, c in enumerate(FEATURES)]
    return spark.range(n, numPartitions=4).select(F.col("id").cast("string").alias("page_title"), *noise)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = training_rows(spark).cache()
    return rows, detect.IsolationForest.fit(rows)


def test_flags_the_contaminated_share(fitted):
    rows, model = fitted
    share = detect.label(model.score(rows)).agg(F.avg("is_anomaly")).first()[0]
    assert share == pytest.approx(0.01, abs=0.0005)


def test_forest_does_not_depend_on_partitioning(fitted):
    rows, model = fitted
    again = detect.IsolationForest.fit(rows.repartition(7, "page_title"))
    assert again.offset == pytest.approx(model.offset, abs=1e-12)
    assert again.nodes.equals(model.nodes)


def test_outlying_rows_score_lower(spark, fitted):
    _, model = fitted
    far = spark.createDataFrame([(1.0,) * 8, (10_000.0,) * 8], ",".join(f"{c} double" for c in FEATURES))
    usual, unusual = [r["anomaly_score"] for r in model.score(far).collect()]
    assert unusual < 0 and unusual < usual


def test_nulls_count_as_zero(spark, fitted):
    _, model = fitted
    rows = spark.createDataFrame([(None,) * 8, (0.0,) * 8], ",".join(f"{c} double" for c in FEATURES))
    first, second = [r["anomaly_score"] for r in model.score(rows).collect()]
    assert first == second


def test_save_and_load(spark, fitted, tmp_path, monkeypatch):
    rows, model = fitted
    model.save(spark, str(tmp_path / "m"))
    monkeypatch.setenv("ANOMALY_MODEL_PATH", str(tmp_path / "m"))
    loaded = detect.IsolationForest.load(spark)
    scores = [m.score(rows).agg(F.sum("anomaly_score")).first()[0] for m in (model, loaded)]
    assert scores[0] == pytest.approx(scores[1])
    with pytest.raises(FileNotFoundError, match="Trained model not found"):
        detect.IsolationForest.load(spark, str(tmp_path / "other"))


def test_resolve_model_path(monkeypatch):
    monkeypatch.delenv("ANOMALY_MODEL_PATH", raising=False)
    assert detect.resolve_model_path("x") == "x"
    assert detect.resolve_model_path().startswith("models")
    monkeypatch.setenv("ANOMALY_MODEL_PATH", "env")
    assert detect.resolve_model_path() == "env" and detect.resolve_model_path("x") == "x"


def test_no_rows_to_train_on(spark):
    with pytest.raises(ValueError, match="no rows"):
        detect.IsolationForest.fit(training_rows(spark, 0))


def test_spike_page_scores_lowest(spark):
    """A hundred calm edits over five pages against one page with 150 editors."""
    rng = np.random.default_rng(42)
    calm = [(f"n{i}", f"Page {rng.integers(5)}", f"E{rng.integers(10)}", bool(rng.integers(4) == 0), bool(rng.integers(2)),
             int(rng.integers(100)), int(rng.integers(86400))) for i in range(100)]
    burst = [(f"s{i}", "Breaking", f"B{i}", False, False, int(rng.integers(500, 2000)), int(43200 + rng.integers(800))) for i in range(150)]
    events = spark.createDataFrame(calm + burst, "event_id string, page_title string, user string, bot boolean, minor boolean, byte_change long, t long")
    rows = features.tumbling(events.withColumn("event_time", F.timestamp_seconds("t")))
    scored = detect.IsolationForest.fit(rows).score(rows)
    assert scored.orderBy("anomaly_score").first()["page_title"] == "Breaking"


def test_score_lake_picks_a_row_before_dropping_nulls(spark, fitted):
    _, model = fitted
    first, second = [("P", None, *[1.0] * 7), ("P", 5.0, *[1.0] * 7)], [("Q", 2.0, *[1.0] * 7)]
    rows = spark.createDataFrame(first + second, "page_title string," + ",".join(f"{c} double" for c in FEATURES))
    scored = detect.score_lake(rows, model, [F.asc_nulls_first("edit_count")])
    assert [r["page_title"] for r in scored.collect()] == ["Q"]


def test_robust_scale_keeps_constant_columns(spark):
    rows = spark.createDataFrame([(float(x), 1.0 if x < 9 else 5.0) for x in range(10)], "a double, b double")
    scaled = detect.robust_scale(rows, ["a", "b"]).orderBy("a").collect()
    assert [r["a"] for r in scaled][0] == pytest.approx(-1.0)
    assert [r["b"] for r in scaled][-2:] == [0.0, 4.0]


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], list(range(101)), [0.0] * 999 + [5.0], [None, 4.0, None, 8.0],
    list(np.random.default_rng(1).normal(size=2000)), [1.0] * 500 + [2.0] * 500,
])
def test_exact_quantiles(spark, values):
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    rows = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)
    have = exact_quantiles(rows, ["x"], wanted)["x"]
    assert have == pytest.approx(list(np.quantile([v for v in values if v is not None], wanted)))


def test_train_from_history_and_lake(spark, tmp_path):
    import json

    from burstwatch import train

    path = tmp_path / "history.jsonl"
    path.write_text("\n".join(json.dumps({"title": f"P{i % 7}", "user": f"u{i % 5}", "byte_change": i * i, "timestamp": i * 300}) for i in range(200)))
    model, rows = train(spark, history=str(path), model_path=str(tmp_path / "m1"))
    assert rows.count() == 200 and model.sample == 200
    rows.write.parquet(str(tmp_path / "lake"))
    again, _ = train(spark, feature_lake=str(tmp_path / "lake"), model_path=str(tmp_path / "m2"))
    assert again.offset == pytest.approx(model.offset)
    assert detect.IsolationForest.load(spark, str(tmp_path / "m2")).sample == 200
    with pytest.raises(ValueError):
        train(spark)
    with pytest.raises(FileNotFoundError):
        train(spark, feature_lake=str(tmp_path / "none"))


def test_repeated_rows_leave_no_tree_out(spark):
    """40 % equal rows: all trees are grown, and the same ones however the rows are dealt."""
    from burstwatch.operators import forest
    from burstwatch.schemas import FEATURES

    rows = spark.range(20_000).selectExpr(*[
        f"if(id % 5 < 2, 1.0D, rand({i + 3}) + 2) as {c}" for i, c in enumerate(FEATURES)
    ])
    size = forest.SAMPLE
    data = rows.select(*forest._inputs())
    grown = forest._grow_trees(data, 20_000, 10, size, 1).toPandas()
    assert grown.tree.nunique() == 10
    again = forest._grow_trees(data.repartition(7), 20_000, 10, size, 1).toPandas()
    key = ["tree", "node"]
    assert grown.sort_values(key, ignore_index=True).equals(again.sort_values(key, ignore_index=True))


def test_few_different_rows_still_give_every_tree(spark):
    from burstwatch.schemas import FEATURES

    rows = spark.range(20_000).selectExpr(*[f"cast(id % 20 as double) as {c}" for c in FEATURES])
    model = detect.IsolationForest.fit(rows, trees=20)
    assert model.nodes.tree.nunique() == 20
    assert (model.nodes.groupby("tree").size() > 1).all()
