"""Edge values of the row-level rules and encoders (FIXTURES §4)."""

import pytest

from lifeboat import config as C
from lifeboat.functions import columns as X
from lifeboat.functions import text as TX
from lifeboat.operators import binning, encode, impute


def _col(spark, values, typ="double", name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, {name} {typ}")


def _vals(df, c):
    return [r[c] for r in df.orderBy("i").collect()]


def test_age_bin_edges(spark):
    d = _col(spark, [0.0, 12.0, 12.1, 20.0, 80.0, 81.0, None])
    out = binning.bin_fixed(d, "x", C.AGE_EDGES, "b", C.DEFAULT_BIN)
    assert _vals(out, "b") == [0, 0, 1, 1, 4, 2, 2]


def test_fare_bin_edges(spark):
    d = _col(spark, [-1.0, 8.0, 8.01, 100.0, 100.01, None])
    out = binning.bin_fixed(d, "x", C.FARE_EDGES, "b", C.DEFAULT_BIN)
    assert _vals(out, "b") == [0, 0, 1, 3, 4, 2]


def test_equal_width_constant_column(spark):
    out = binning.bin_equal_width(_col(spark, [3.0, 3.0]), "x", "b", 5)
    assert _vals(out, "b") == [2, 2]


def test_equal_width_right_closed(spark):
    # edges 0, 2, 4, 6, 8, 10: 2 is in bin 0, 2.0001 in bin 1, 10 in bin 4
    out = binning.bin_equal_width(_col(spark, [0.0, 2.0, 2.0001, 10.0]), "x", "b", 5)
    assert _vals(out, "b") == [0, 0, 1, 4]


def test_quantile_bins_drop_duplicate_edges(spark):
    out = binning.bin_quantile(_col(spark, [1.0, 1.0, 1.0, 1.0, 5.0]), "x", "b")
    # quartile edges 1, 1, 1, 1, 5 -> unique 1, 5 -> one bin
    assert _vals(out, "b") == [0, 0, 0, 0, 0]
    out = binning.bin_quantile(_col(spark, [1.0, 2.0, 3.0, 4.0, 5.0]), "x", "b")
    assert _vals(out, "b") == [0, 0, 1, 2, 3]


def test_median_fill(spark):
    out = impute.fill_median(_col(spark, [1.0, 2.0, 3.0, 8.0, None]), "x")
    assert _vals(out, "x") == [1.0, 2.0, 3.0, 8.0, 2.5]


def test_mode_fill_ties_smallest(spark):
    out = impute.fill_mode(_col(spark, ["b", "a", "b", "a", None], "string"), "x")
    assert _vals(out, "x") == ["b", "a", "b", "a", "a"]


def test_mode_fill_empty_uses_default(spark):
    out = impute.fill_mode(_col(spark, [None, None], "string"), "x", default="S")
    assert _vals(out, "x") == ["S", "S"]


def test_group_median_then_global(spark):
    d = spark.createDataFrame([(0, "a", 1.0), (1, "a", 3.0), (2, "a", None), (3, "b", None)],
                              "i INT, g STRING, x DOUBLE")
    out = impute.fill_median_by_group(d, "x", ["g"])
    # group a -> 2.0; group b has no values -> global median of [1, 3, 2] = 2.0
    assert _vals(out, "x") == [1.0, 3.0, 2.0, 2.0]


def test_category_codes(spark):
    d = _col(spark, ["b", "a", None, "b"], "string")
    assert _vals(encode.category_codes(d, "x", "c"), "c") == [1, 0, -1, 1]
    assert _vals(encode.category_codes(d, "x", "c", map_values=0), "c") == [1, 0, -1, 1]


def test_category_codes_numeric_sort(spark):
    d = _col(spark, [10, 9, 100], "int")
    assert _vals(encode.category_codes(d, "x", "c"), "c") == [1, 0, 2]


def test_one_hot_drop_first(spark):
    d = _col(spark, ["b", "a", None, "c"], "string")
    out, names = encode.one_hot_drop_first(d, "x")
    assert names == ["x_b", "x_c"]
    assert [(r["x_b"], r["x_c"]) for r in out.orderBy("i").collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]


def test_scaler_population_std_and_constant(spark):
    d = spark.createDataFrame([(0, 1.0, 5.0), (1, 3.0, 5.0)], "i INT, x DOUBLE, y DOUBLE")
    p = encode.fit_scaler(d, ["x", "y"])
    out = encode.apply_scaler(d, p).orderBy("i").collect()
    assert [r["x"] for r in out] == [-1.0, 1.0]
    assert [r["y"] for r in out] == [0.0, 0.0]


@pytest.mark.parametrize("name,regex_title,split_rf,split_xgb", [
    ("X, the Countess. J", "Rare", "Mrs", "Rare"),
    ("X, Mlle. J", "Miss", "Miss", "Miss"),
    ("X, Dr. J", "Rare", "Mr", "Rare"),
    ("X, Mr. J", "Mr", "Mr", "Mr"),
    ("No title here", "Rare", None, None),
])
def test_titles(spark, name, regex_title, split_rf, split_xgb):
    d = spark.createDataFrame([(name,)], "name STRING")
    r = d.select(TX.title_regex("name").alias("a"), TX.title_rf(TX.title_split("name")).alias("b"),
                 TX.title_xgb(TX.title_split("name")).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (regex_title, split_rf, split_xgb)


def test_title_codes_null_is_minus_one(spark):
    d = spark.createDataFrame([(0, "No title"), (1, "A, Mr. B")], "i INT, name STRING")
    d = d.withColumn("t", TX.title_split("name"))
    assert _vals(encode.category_codes(d, "t", "c"), "c") == [-1, 0]


@pytest.mark.parametrize("ticket,token", [
    ("330911", "X"), ("A/5 21171", "A5"), ("W.E.P. 5734", "WEP"), ("SC/PARIS 2133", "SCPARIS"),
    ("SC/Paris 2133", "SCParis"), (None, None),
])
def test_ticket_token(spark, ticket, token):
    d = spark.createDataFrame([(ticket,)], "t STRING")
    assert d.select(TX.ticket_token("t").alias("k")).first()["k"] == token


def test_flags_and_family(spark):
    d = spark.createDataFrame([("female", 0, 0, None), ("male", 1, 2, "B45"), (None, 0, 0, None)],
                              "sex STRING, sibsp INT, parch INT, cabin STRING")
    rows = d.select(X.is_female("sex").alias("f"), X.is_alone(X.family_size()).alias("a"),
                    X.family_size(include_self=False).alias("fs"), X.has_value("cabin").alias("h"),
                    TX.deck_letter("cabin", "N").alias("dk")).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0, 0, "N"), (0, 0, 3, 1, "B"), (0, 1, 0, 0, "N")]


def test_ticket_group_clip(spark):
    d = _col(spark, ["t"] * 5 + ["u", None], "string")
    out = impute.group_size(d, "x", "g", *C.TICKET_GROUP_CLIP)
    assert _vals(out, "g") == [4, 4, 4, 4, 4, 1, None]


def test_frequency_encode_null_zero(spark):
    d = _col(spark, ["a", "a", "b", None], "string")
    assert _vals(impute.frequency_encode(d, "x", "f"), "f") == [2.0, 2.0, 1.0, 0.0]


def test_outlier_trim_sample_std(spark):
    vals = [0.0] * 20 + [100.0]
    d = _col(spark, vals)
    kept = impute.trim_outliers(d, ["x"], 4.0).count()
    assert kept == 20
    assert impute.trim_outliers(d, ["x"], 5.0).count() == 21


def test_unknown_feature_set_raises(spark):
    from lifeboat.plans.features import build_features
    with pytest.raises(ValueError):
        build_features(_col(spark, [1.0]), "nope")


def test_soft_vote_half_is_zero(spark):
    from lifeboat.operators.vote import soft_vote
    a = spark.createDataFrame([(1, 0.5), (2, 0.9)], "id INT, p1 DOUBLE")
    b = spark.createDataFrame([(1, 0.5), (2, 0.2)], "id INT, p1 DOUBLE")
    out = {r["id"]: r["prediction"] for r in soft_vote([a, b]).collect()}
    assert out == {1: 0, 2: 1}
    with pytest.raises(RuntimeError):
        soft_vote([])


def test_group_median_hot_group_path(spark):
    # a tiny hot threshold sends group "a" through the distributed order-statistics search
    rows = [(i, "a", float(v)) for i, v in enumerate([5, 1, 4, 2, 3, 3])] + [(10, "b", 7.0), (11, "b", 9.0)]
    d = spark.createDataFrame(rows, "i INT, g STRING, x DOUBLE")
    hot = {r["g"]: r["x_median"] for r in impute.median_by_group(d, "x", ["g"], hot_distinct=2).collect()}
    cold = {r["g"]: r["x_median"] for r in impute.median_by_group(d, "x", ["g"]).collect()}
    assert hot == cold == {"a": 3.0, "b": 8.0}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-5, max_value=120, allow_nan=False), min_size=1, max_size=40))
def test_fixed_bins_monotone_and_total(spark, xs):
    d = _col(spark, xs)
    out = binning.bin_fixed(d, "x", C.AGE_EDGES, "b", C.DEFAULT_BIN).orderBy("i").collect()
    assert len(out) == len(xs)
    inside = sorted((r["x"], r["b"]) for r in out if C.AGE_EDGES[0] <= r["x"] <= C.AGE_EDGES[-1])
    assert [b for _, b in inside] == sorted(b for _, b in inside)
    assert all(r["b"] == C.DEFAULT_BIN for r in out if not C.AGE_EDGES[0] <= r["x"] <= C.AGE_EDGES[-1])


def test_categories_many_types_and_order(spark):
    d = spark.createDataFrame([(10, "b", 1.5), (9, "a", None), (100, None, 0.5)], "n INT, s STRING, x DOUBLE")
    cats = encode.categories_many(d, ["n", "s", "x"])
    assert cats == {"n": [9, 10, 100], "s": ["a", "b"], "x": [0.5, 1.5]}


def test_category_codes_many_matches_single(spark):
    d = spark.createDataFrame([(0, "b", 10), (1, "a", 9), (2, None, 100), (3, "b", None)], "i INT, s STRING, n INT")
    many = encode.category_codes_many(d, ["s", "n"]).orderBy("i").collect()
    assert [(r["s"], r["n"]) for r in many] == [(1, 1), (0, 0), (-1, 2), (1, -1)]
    fallback = encode.category_codes_many(d, ["s", "n"], map_values=1).orderBy("i").collect()
    assert [(r["s"], r["n"]) for r in fallback] == [(1, 1), (0, 0), (-1, 2), (1, -1)]


def test_stage_roundtrip(spark):
    from lifeboat.operators.layout import stage
    d = _col(spark, [1.0, None, 3.0])
    staged = stage(d, "t")
    assert sorted(map(str, staged.collect())) == sorted(map(str, d.collect()))
    assert staged.inputFiles()[0].endswith(".parquet")


@pytest.mark.parametrize("map_values", [0, 100])
def test_category_codes_keep_types(spark, map_values):
    from decimal import Decimal
    d = spark.createDataFrame([(0, 1.5, Decimal("10.20"), True), (1, float("nan"), Decimal("9.00"), False), (2, None, None, None), (3, 0.1, Decimal("100.00"), True)],
                              "i INT, f FLOAT, d DECIMAL(10,2), b BOOLEAN")
    out = encode.category_codes_many(d, ["f", "d", "b"], map_values=map_values).orderBy("i").collect()
    assert [(r["f"], r["d"], r["b"]) for r in out] == [(1, 1, 1), (-1, 0, 0), (-1, -1, -1), (0, 2, 1)]


def test_category_codes_of_many_values_and_hot_nulls(spark):
    d = spark.range(40_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('v', lpad(id % 9000, 5, '0')) END AS s")
    out = encode.category_codes(d, "s", "c")
    assert out.where("s IS NULL").select("c").distinct().collect() == [(-1,)]
    got = {r["s"]: r["c"] for r in out.where("s IS NOT NULL").select("s", "c").distinct().collect()}
    assert got == {s: i for i, s in enumerate(sorted(got))}
    assert out.count() == 40_000


def test_one_hot_beyond_a_thousand_categories(spark):
    d = spark.range(1_200).selectExpr("CAST(id AS INT) AS x")
    out, names = encode.one_hot_drop_first(d, "x")
    assert len(names) == 1_199 and out.selectExpr("sum(x_1199) AS s").first()["s"] == 1


def test_median_of_many_hot_groups(spark):
    import numpy as np
    d = spark.range(6_000).selectExpr("id % 1100 AS g", "CAST((id * 7919) % 977 AS DOUBLE) / 4 AS x").unionByName(
        spark.createDataFrame([(None, 5.0), (None, 6.0), (None, 7.5), (None, 9.0)], "g LONG, x DOUBLE"))
    rows = {}
    for r in d.collect():
        rows.setdefault(r["g"], []).append(r["x"])
    want = {g: float(np.median(v)) for g, v in rows.items()}
    got = {r["g"]: r["x_median"] for r in impute.median_by_group(d, "x", "g", hot_distinct=2).collect()}     # every group is hot
    assert got == want == {r["g"]: r["x_median"] for r in impute.median_by_group(d, "x", "g").collect()}


def test_fit_scope_is_checked(spark):
    from lifeboat.plans.features import features_mlp
    with pytest.raises(ValueError):
        features_mlp(spark.createDataFrame([(1, True)], "id INT, is_train BOOLEAN"), fit_scope="half")


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch):
    from types import SimpleNamespace
    from lifeboat import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(fake)
