"""The frame of the regression fits: staged columns of its own, read as files, with the rows of the table."""

import math

import pytest

from tessera.plans import QUERIES, models
from tessera.plans.registry import Tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("vector", [False, True])
def test_fits_read_files_with_their_columns_alone(spark, vector):
    t = Tables(spark, SF)
    f = models.reg_frame(t, vector=vector)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan and "UDF" not in plan
    assert set(f.columns) == {"y", "split"} | ({"features"} if vector else set(models._LINE_FEATURES))
    if vector:
        assert "UDF" not in f.where("split = 'train'").select("features", "y")._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.y, r.split, *r.features.toArray()) for r in f.collect())
        assert got == sorted((r.y, r.split, *map(float, r[1:4])) for r in models.reg_frame(t).select("y", *models._LINE_FEATURES, "split").collect())
    assert f.count() == t.lineitem.count()


def test_forest_regressor_metrics(spark):
    r = QUERIES["model_forest_regressor"](spark, SF).collect()[0]
    assert r.rmse == pytest.approx(math.sqrt(r.mse)) and -0.1 < r.r2 < 1 and 0 < r.mae <= r.rmse
