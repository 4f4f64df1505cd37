"""Running totals and exact quantiles against brute force, with skew, ties and nulls."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators.quantiles import QuantileCuts, exact_quantiles
from clickloom.operators.running import CHUNK, chunks_for, totals_before, with_chunks


def brute_force(pdf: pd.DataFrame, keys: list[str], order: list[str]) -> pd.DataFrame:
    rows = pdf.sort_values(order, na_position="first")
    groups = rows.groupby(keys, dropna=False) if keys else rows.groupby(lambda _: 0)
    rows["n_before"] = groups.cumcount()
    rows["v_before"] = groups["v"].cumsum() - rows["v"]
    return rows.sort_values("id").reset_index(drop=True)


def skewed(rows: int = 5000) -> pd.DataFrame:
    rng = np.random.default_rng(3)
    key = np.where(rng.random(rows) < 0.4, 0, rng.integers(1, 200, rows))
    t = np.where(rng.random(rows) < 0.35, 777, rng.integers(0, 100_000, rows))
    return pd.DataFrame({"id": np.arange(rows), "k": key, "t": t, "v": rng.integers(0, 10, rows)})


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("chunks,rows_per_key", [(1, 10), (7, 10**6), (7, 100), (64, 20)])
def test_totals_equal_brute_force(spark, keys, chunks, rows_per_key):
    pdf = skewed()
    df = with_chunks(spark.createDataFrame(pdf).repartition(5), ["t", "id"], chunks)
    out = totals_before(df, ["t", "id"], [(keys, {"n_before": F.lit(1), "v_before": F.col("v")})], rows_per_key)
    got = out.drop(CHUNK).toPandas().sort_values("id").reset_index(drop=True)
    want = brute_force(pdf, keys, ["t", "id"])
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_hot_key_and_hot_instant_are_split(spark):
    df = with_chunks(spark.createDataFrame(skewed(20_000)), ["t", "id"], 50)
    largest = df.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0]
    instant = df.filter("t = 777").groupBy(CHUNK).count().agg(F.max("count")).first()[0]
    # One key holds 40 % of the rows and one instant 35 %; a task sees a small part of either.
    assert largest < 20_000 * 0.4 / 20
    assert instant < 20_000 * 0.35 / 20


def test_chunks_never_decrease_along_the_order(spark):
    pdf = with_chunks(spark.createDataFrame(skewed()), ["t", "id"], 30).toPandas()
    ordered = pdf.sort_values(["t", "id"])[CHUNK]
    assert ordered.is_monotonic_increasing and ordered.nunique() > 20


def test_nulls_in_key_and_order(spark):
    rows = [(i, None if i % 4 == 0 else i % 3, None if i % 5 == 0 else float(i % 7), i) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k int, t double, v int")
    out = totals_before(
        with_chunks(df, ["t", "id"], 8), ["t", "id"], [(["k"], {"n_before": F.lit(1), "v_before": F.col("v")})], 20
    )
    got = out.drop(CHUNK).toPandas().sort_values("id").reset_index(drop=True)
    want = brute_force(df.toPandas(), ["k"], ["t", "id"])
    assert got["n_before"].tolist() == want["n_before"].tolist()
    assert got["v_before"].tolist() == want["v_before"].tolist()


def test_several_groups_at_once(spark):
    pdf = skewed(1000)
    df = with_chunks(spark.createDataFrame(pdf), ["t", "id"], 9)
    groups = [(["k"], {"a": F.lit(1)}), (["k", "v"], {"c": F.lit(1)}), ([], {"b": F.col("v")})]
    out = totals_before(df, ["t", "id"], groups, 50).toPandas()
    out = out.sort_values("id").reset_index(drop=True)
    assert out["c"].tolist() == pdf.sort_values(["t", "id"]).groupby(["k", "v"]).cumcount().sort_index().tolist()
    assert out["a"].tolist() == brute_force(pdf, ["k"], ["t", "id"])["n_before"].tolist()
    assert out["b"].tolist() == brute_force(pdf, [], ["t", "id"])["v_before"].tolist()


def test_text_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="cannot cut"):
        with_chunks(spark.createDataFrame([("a",)], "t string"), ["t"], 4)


def test_chunk_count_follows_rows():
    assert chunks_for(0) == chunks_for(10) == 1
    assert chunks_for(10**6) < chunks_for(10**7) < chunks_for(10**12) == 10**6


def test_many_chunks_and_two_heavy_instants(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": np.arange(30_000), "k": rng.integers(0, 3, 30_000), "t": np.where(rng.random(30_000) < 0.5, 5, rng.integers(5, 9, 30_000)), "v": 1})
    df = with_chunks(spark.createDataFrame(pdf), ["t", "id"], 20_000)
    out = totals_before(df, ["t", "id"], [(["k"], {"n_before": F.lit(1), "v_before": F.col("v")})], 100)
    got = out.drop(CHUNK).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[["id", "n_before"]], brute_force(pdf, ["k"], ["t", "id"])[["id", "n_before"]], check_dtype=False)


@pytest.mark.parametrize("parts", [2, 10, 100])
def test_exact_quantiles(spark, parts):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=9000), np.full(5000, 0.25)])
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": values})), "x", parts)
    ordered = np.sort(values)
    want = [ordered[-(-i * len(values) // parts) - 1] for i in range(1, parts)]
    assert got == want


def test_repeated_cuts_collapse(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + [2] * 50], "x double")
    exact = QuantileCuts("x", "b", 100, 0.0).fit(df)
    sketch = QuantileCuts("x", "b", 100, 0.001).fit(df)
    assert exact.getSplits() == sketch.getSplits() == [float("-inf"), 1.0, 2.0, float("inf")]
    assert {r["b"] for r in exact.transform(df).collect()} == {1.0, 2.0}


def test_quantile_settings_are_checked(spark):
    with pytest.raises(ValueError):
        QuantileCuts("x", "b", 1)
    with pytest.raises(ValueError):
        QuantileCuts("x", "b", 10, 1.5)
    with pytest.raises(ValueError, match="no values"):
        exact_quantiles(spark.createDataFrame([], "x double"), "x", 4)
