"""Fold statistics by merging moments, one-pass cross-validation, checked CSV loads."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagoon.operators.folds import fold_moments, stats_without
from lagoon.operators.models import grouped_cv
from lagoon.operators.stats import fit_column_stats
from lagoon.sources.csv import BadLinesError, HOUSEHOLD_SCHEMA, NullValuesError, load_csv_panel

HEAD = "Household_ID,Date,Energy_Consumption_kWh,Household_Size,Avg_Temperature_C,Has_AC,Peak_Hours_Usage_kWh\n"
GOOD = "H1,2025-01-01,10.5,3,20.1,Yes,4.2\nH2,2025-01-02,11.0,3,19.5,No,4.0\n"


def test_fold_statistics_equal_refitting(spark):
    rng = np.random.default_rng(2)
    rows = [(int(f), float(1e6 + x), None if i % 7 == 0 else float(x), 5.0 if f == 2 else float(i))
            for i, (f, x) in enumerate(zip(rng.integers(0, 4, 300), rng.normal(size=300), strict=True))]
    rows.append((9, 3.0, None, 1.0))                    # a fold of one row, without one of the columns
    df = spark.createDataFrame(rows, "fold int, big double, holes double, flat double").repartition(5)
    moments = fold_moments(df, ["big", "holes", "flat"])
    for fold in [None, *sorted(moments)]:
        want = fit_column_stats(df if fold is None else df.where(F.col("fold") != fold), ["big", "holes", "flat"])
        got = stats_without(moments, fold)
        for c, s in want.items():
            assert got[c]["mean"] == pytest.approx(s["mean"], rel=1e-12)
            assert got[c]["std"] == pytest.approx(s["std"], rel=1e-9)


def test_fold_statistics_of_too_few_rows(spark):
    one = fold_moments(spark.createDataFrame([(0, 1.0), (1, None)], "fold int, x double"), ["x"])
    assert stats_without(one, None)["x"] == {"mean": 1.0, "std": None}
    assert stats_without(one, 0)["x"] == {"mean": None, "std": None}


def test_cross_validation_computes_the_panel_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rng = np.random.default_rng(3)
    rows = [(e, t, float(e % 4 + 0.1 * rng.normal()), None if e == 1 else float(e), e % 2 == 0, e % 3) for e in range(24) for t in range(8)]
    df = spark.createDataFrame(rows, "e long, t long, x double, s double, flag boolean, fold int")
    panel = df.mapInArrow(watched, df.schema)
    model, rmse = grouped_cv(panel, "e", ["t"], ["x"], "x", 2, ["s"], ["flag"], max_iter=3, max_depth=2)
    assert len(rmse) == 3 and all(0 < r < 2 for r in rmse)
    # Once for the stored lags and once for the size of the busiest entity, however many folds.
    assert seen.value == 2 * len(rows)
    assert model.transform(df).where("prediction IS NOT NULL").count() == len(rows)


def _csv(folder, text):
    path = os.path.join(folder, "h.csv")
    with open(path, "w") as f:
        f.write(HEAD + text)
    return path


def test_csv_is_loaded_and_counted_in_one_pass(spark, tmp_dir):
    df, seen = load_csv_panel(spark, _csv(tmp_dir, GOOD), HOUSEHOLD_SCHEMA, flags={"Has_AC": "Yes"})
    assert seen["rows"] == 2 and seen["bad_lines"] == 0 and not any(n for k, n in seen.items() if k.startswith("null_"))
    assert [r["Has_AC"] for r in df.orderBy("Date").collect()] == [True, False]
    assert df.columns == HOUSEHOLD_SCHEMA.names


def test_bad_lines_and_nulls_are_told_apart(spark, tmp_dir):
    path = _csv(tmp_dir, GOOD + "H3,2025-01-03,oops,3,19.5,No,4.0\nH4,2025-01-04,,3,19.5,No,4.0\n")
    df, seen = load_csv_panel(spark, path, HOUSEHOLD_SCHEMA, strict=False)
    assert (seen["rows"], seen["bad_lines"], seen["null_Energy_Consumption_kWh"]) == (4, 1, 1)
    assert df.count() == 4
    with pytest.raises(BadLinesError, match="1 of 4"):
        load_csv_panel(spark, path, HOUSEHOLD_SCHEMA)
    with pytest.raises(NullValuesError, match="Energy"):
        load_csv_panel(spark, _csv(tmp_dir, GOOD + "H4,2025-01-04,,3,19.5,No,4.0\n"), HOUSEHOLD_SCHEMA)
