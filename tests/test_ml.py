"""Spark ML selection rules and the fixed-width key encoding."""

from pyspark.sql import functions as F

from aerolith.operators import features as FT
from aerolith.operators import ml as ML
from aerolith.plans import scenarios as SC
from aerolith.sources.driver_tables import core
from tests.conftest import SF_SMALL


def test_train_select_save_load_score(spark, tmp_path):
    c = core(spark, SF_SMALL)
    feats = FT.features(FT.star_rows(SC.published(c, "fact_measurement"), spark))
    split = FT.chronological_split(feats)
    for enc in ("onehot", "hashed"):
        model, metrics = ML.evaluate(split, key_encoding=enc)
        rows = {r.model_name: r for r in metrics.collect()}
        assert set(rows) == {"linear-regression", "random-forest"}
        chosen = [r.model_name for r in rows.values() if r.chosen]
        lin, rf = rows["linear-regression"], rows["random-forest"]
        assert chosen == (["random-forest"] if rf.mae < lin.mae else ["linear-regression"])  # linear wins ties
        assert lin.train_rows + lin.test_rows == split.count()
    path = str(tmp_path / "model")
    ML.save(model, metrics, path, "0.1.0", "2024-02-01T00:00:00")
    loaded, bundle = ML.load(spark, path)
    assert bundle["model_version"] == "0.1.0" and bundle["model_name"] in ("linear-regression", "random-forest")
    scored = ML.score(loaded, feats.limit(20))
    assert scored.filter(F.col("prediction").isNull()).count() == 0
