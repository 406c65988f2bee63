from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import encoding, quality
from shelfcast.operators import panel as P
from shelfcast.plans.preparation import Encoders
from shelfcast.plans.retraining import Registry
from shelfcast.sources import tables, versions

DAY = date(2015, 1, 1)


def registry(spark, number):
    one_hot = spark.createDataFrame([("A", "x", "event", str(number))], "store_id string, item_id string, variable string, category string")
    models = spark.createDataFrame([("A", "x", float(number))], "store_id string, item_id string, intercept double")
    return Registry(Encoders(one_hot, one_hot), models)


def test_versions_of_a_registry(spark, tmp_path):
    path = f"{tmp_path}/registry"
    assert [registry(spark, n).save(path) for n in (1, 2)] == [1, 2]
    assert Registry.load(spark, path).models.first()["intercept"] == 2.0
    assert Registry.load(spark, path, 1).encoders.one_hot.first()["category"] == "1"
    broken = registry(spark, 3)
    broken.models = broken.models.withColumn("intercept", F.raise_error(F.lit("cut off")).cast("double"))
    with pytest.raises(Exception, match="cut off"):
        broken.save(path)
    assert versions.versions(spark, path) == [1, 2]
    assert Registry.load(spark, path).models.first()["intercept"] == 2.0
    with pytest.raises(ValueError, match="no version 7"):
        Registry.load(spark, path, 7)
    # A publisher that was cut off while it took its number leaves it unused.
    (tmp_path / "registry" / "versions" / "000000003").touch()
    assert registry(spark, 4).save(path) == 4
    assert versions.versions(spark, path) == [1, 2, 4]


def test_lines_that_do_not_parse_are_set_apart(spark, tmp_path):
    lines = ["date,name,n", "2015-01-01,a,1", "2015-13-01,b,2", '2015-01-03,"c,d",x', "2015-01-04,e", "2015-01-05,f,6,7", ",,", '2015-01-06,"g, h",8']
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.csv").write_text("date,name,n\n2015-02-01,z,9\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("date", T.DateType())])
    good, bad = tables.read_csv_apart(spark, str(tmp_path), schema)
    assert good.columns == ["n", "name", "date"]
    assert {(r["n"], r["name"]) for r in good.collect()} == {(1, "a"), (None, None), (8, "g, h"), (9, "z")}
    told = {r["record"]: (r["reason"], r["file"].rpartition("/")[2]) for r in bad.collect()}
    assert told == {
        "2015-13-01,b,2": ("date is not date", "one.csv"),
        '2015-01-03,"c,d",x': ("n is not int", "one.csv"),
        "2015-01-04,e": ("number of fields", "one.csv"),
        "2015-01-05,f,6,7": ("number of fields", "one.csv"),
    }


def test_gaps_of_series(spark):
    days = [("A", "x", d) for d in (3, 4, 4, 8, 9)] + [("A", "y", d) for d in range(1, 11)] + [("B", "x", 1), ("B", "x", 10)]
    rows = spark.createDataFrame([(s, i, DAY + timedelta(days=d)) for s, i, d in days], "store_id string, item_id string, date date")
    at = lambda d: F.lit(DAY + timedelta(days=d))
    got = {(r["store_id"], r["item_id"], (r["first_date"] - DAY).days, (r["last_date"] - DAY).days, r["days"]) for r in P.gap_intervals(rows, at(1), at(10)).collect()}
    assert got == {("A", "x", 1, 2, 2), ("A", "x", 5, 7, 3), ("A", "x", 10, 10, 1), ("B", "x", 2, 9, 8)}


def test_codes_of_a_fold_and_of_a_row_see_only_the_past(spark):
    sales = [5, 1, 4, 4, 2, 8, 6, 3, 9, 7]
    data = [("A", "x", DAY + timedelta(days=i), "ab"[i % 2], s) for i, s in enumerate(sales)]
    schema = "store_id string, item_id string, date date, kind string, sales int"
    rows = spark.createDataFrame(data, schema)
    state = encoding.fit_target_encoding_by_fold(rows, ["kind"], folds=2, test_rows=3, min_samples=2).collect()
    for fold, known in ((0, 7), (1, 4)):
        for kind in "ab":
            mine = [s for i, s in enumerate(sales[:known]) if "ab"[i % 2] == kind]
            (r,) = [r for r in state if r["fold"] == fold and r["category"] == kind]
            weight = 1 / (1 + 2.718281828459045 ** -(len(mine) - 2))
            prior = sum(sales[:known]) / known
            assert (r["n"], r["mean"]) == (len(mine), sum(mine) / len(mine))
            assert r["encoding"] == pytest.approx(prior * (1 - weight) + r["mean"] * weight)
    coded = lambda df: [r["kind_te"] for r in encoding.encode_from_past(df, ["kind"], min_samples=2).orderBy("date").collect()]
    before = coded(rows)
    later = spark.createDataFrame([(*r[:4], r[4] + 100 * (i >= 6)) for i, r in enumerate(data)], schema)
    assert before[0] is None and before[1] == 5.0 and coded(later)[:7] == before[:7] and coded(later)[7:] != before[7:]


def test_profiles_of_days_add_up(spark):
    data = [(DAY + timedelta(days=i % 7), f"w{i % 400}" if i % 3 else None, float(i % 90)) for i in range(5000)]
    rows = spark.createDataFrame(data, "date date, word string, amount double")
    profiles = quality.daily_profiles(rows)
    merged = {r["variable"]: r for r in quality.merge_profiles(profiles).collect()}
    assert (merged["word"]["non_null"], merged["word"]["nulls"]) == (sum(i % 3 > 0 for i in range(5000)), sum(i % 3 == 0 for i in range(5000)))
    assert abs(merged["word"]["distinct_estimate"] - 400) <= 20
    assert (merged["amount"]["low"], merged["amount"]["high"]) == (0.0, 89.0)
    assert merged["amount"]["total"] == sum(i % 90 for i in range(5000)) and abs(merged["amount"]["median_estimate"] - 44.5) < 4
    some = {r["variable"]: r for r in quality.merge_profiles(profiles.where(F.col("date") < DAY + timedelta(days=2))).collect()}
    assert some["amount"]["non_null"] == sum(i % 7 < 2 for i in range(5000))
