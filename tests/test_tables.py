from __future__ import annotations

import math
import warnings

import pytest
from pyspark.sql import functions as F

from holdfast.operators import cleaning, encoding, quality
from holdfast.plans.prepare import fit_splits, prepare_files, prepare_model_splits, prepare_table
from holdfast.session import staging_path
from holdfast.sources.customers import load_customers, load_with_rescue, rescue_report, rescued_values
from holdfast.sources.fingerprints import table_fingerprint
from holdfast.sources.sinks import write_ranked, write_table


def test_csv_tokens_and_types(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "CustomerID,Tenure,Gender,Flag,Empty,Score\n"
        "1,3.5,Male,True,,7\n2,NA,nan,False,NULL,8\n3,,Female,True,n/a,9\n"
    )
    df = load_customers(spark, str(path))
    assert dict(df.dtypes) == {
        "CustomerID": "bigint", "Tenure": "double", "Gender": "string", "Flag": "boolean",
        "Empty": "double", "Score": "bigint",
    }
    rows = df.orderBy("CustomerID").collect()
    assert [r["Tenure"] for r in rows] == [3.5, None, None]
    assert [r["Gender"] for r in rows] == ["Male", None, "Female"]


def test_csv_with_schema_is_lazy_and_tolerant(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("CustomerID,Tenure\n1,3.5\nx,NaN\n")
    rows = load_customers(spark, str(path), "CustomerID long, Tenure double").collect()
    assert [tuple(r) for r in rows] == [(1, 3.5), (None, None)]


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        load_customers(spark, "/nowhere/at/all.parquet")
    with pytest.raises(FileNotFoundError):
        load_customers(spark, "/nowhere/at/all.csv")


def test_nan_becomes_null(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "a double").write.parquet(
        str(tmp_path / "t")
    )
    assert load_customers(spark, str(tmp_path / "t")).filter("a IS NULL").count() == 1


def test_ranked_files_are_in_order(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").alias("CustomerID"), ((F.col("id") * 37 % 1000) / 1000).alias(
            "churn_probability")
    )
    write_ranked(df, str(tmp_path / "r"))
    parts = sorted((tmp_path / "r").glob("part-*"))
    read = [r[0] for p in parts
            for r in spark.read.parquet(str(p)).select("churn_probability").collect()]
    assert read == sorted(read, reverse=True) and len(read) == 1000


def test_fingerprint_ignores_order_and_sees_changes(spark, customers):
    first = table_fingerprint(customers).first()
    assert first == table_fingerprint(customers.orderBy(F.desc("CustomerID"))
                                      .repartition(7)).first()
    changed = customers.withColumn(
        "Gender", F.when(F.col("CustomerID") == 1005, "x").otherwise(F.col("Gender"))
    )
    assert first["digest"] != table_fingerprint(changed).first()["digest"]
    texts = [("a|b", "c"), ("a", "b|c"), (None, "\\N"), ("\\N", None)]
    prints = {
        table_fingerprint(spark.createDataFrame([t], "x string, y string")).first()["digest"]
        for t in texts
    }
    assert len(prints) == 4


def test_customer_rules(spark):
    good = (1, "Male", "Single", 5.0, "Phone", "UPI", 3, 0, 1, 10.0, 5.0)
    schema = (
        "CustomerID long, Gender string, MaritalStatus string, Tenure double, "
        "PreferredLoginDevice string, PreferredPaymentMode string, SatisfactionScore int, "
        "Complain int, CityTier int, WarehouseToHome double, CashbackAmount double"
    )
    df = spark.createDataFrame([good], schema)
    assert quality.validate_customers(df) == (True, [])
    checks = quality.summarize_checks(quality.check_table(df, quality.CUSTOMER_RULES)).first()
    assert (checks["total_checks"], checks["failed_checks"]) == (20, 0)
    bad = spark.createDataFrame(
        [good, (None, "X", "Single", 500.0, "Phone", "UPI", 9, 0, 1, -1.0, 5.0)], schema
    )
    passed, failures = quality.validate_customers(bad)
    assert not passed
    assert failures == [quality.IN_SET] + [quality.BETWEEN] * 3 + [quality.NOT_NULL]
    with pytest.raises(quality.QualityError) as error:
        quality.quality_gate(bad)
    assert error.value.failures == failures
    assert quality.quality_gate(bad, skip=True)


def test_mostly_nulls_and_absent_columns(spark):
    rows = [(float(i),) for i in range(99)] + [(1000.0,), (None,)]
    df = spark.createDataFrame(rows, "Tenure double")
    rules = quality.QualityRules(
        required=("Tenure", "Gone"), ranges={"Tenure": (0, 120, 0.99), "Gone": (0, 1, None)}
    )
    got = {r["check_no"]: r for r in quality.check_table(df, rules).collect()}
    assert got[3]["success"] and (got[3]["n_checked"], got[3]["n_bad"]) == (100, 1)
    assert [got[i]["success"] for i in (1, 2, 4)] == [True, False, False]
    strict = quality.QualityRules(ranges={"Tenure": (0, 120, 0.995)})
    assert not quality.check_table(df, strict).first()["success"]
    empty = quality.QualityRules(value_sets={"Tenure": (1.0,)})
    assert quality.check_table(df.filter("Tenure IS NULL"), empty).first()["success"]


def test_target_checks(spark):
    df = spark.createDataFrame([(0,), (1,), (None,), (2,)], "Churn int")
    row = quality.target_profile(df, "Churn").first()
    assert (row["n_null"], row["n_not_binary"], row["target_ok"]) == (1, 1, False)
    with pytest.raises(ValueError, match="0 or 1"):
        quality.require_binary_target(df, "Churn")
    with pytest.raises(ValueError, match="not found"):
        quality.require_target(df, "Other")


def test_clean_merges_labels_before_dedup(spark):
    rows = [
        (7, " Yes", "Phone", "COD", 1.0), (3, "Yes", "Mobile Phone", "Cash on Delivery", 1.0),
        (5, "No ", "Computer", "CC", None), (9, "No", "Computer", "Credit Card", None),
        (8, "Maybe", "Computer", "UPI", 2.0),
    ]
    df = spark.createDataFrame(
        rows, "` CustomerID` long, Churn string, PreferredLoginDevice string, "
        "PreferredPaymentMode string, Tenure double"
    )
    got = {r["row_key"]: r for r in cleaning.clean(df).collect()}
    assert sorted(got) == [3, 5, 8]
    assert [got[k]["Churn"] for k in (3, 5, 8)] == [1, 0, None]
    assert [got[k]["Tenure_missing"] for k in (3, 5, 8)] == [0, 1, 0]
    assert cleaning.clean(df, drop_duplicates=False).count() == 5
    assert "Churn_missing" not in cleaning.clean(df).columns


def test_rows_without_id_get_a_content_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "Churn int, x string")
    rows = cleaning.clean(df).collect()
    assert len(rows) == 2 and len({r["row_key"] for r in rows}) == 2


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    row = cleaning.duplicate_report(df, ["a", "b"]).first()
    assert (row["n_before"], row["n_after"], row["n_dropped"]) == (3, 2, 1)
    assert row["dropped_share"] == pytest.approx(1 / 3)


def test_medians_are_interpolated_and_gaps_warn(spark):
    rows = [(1.0, None), (2.0, None), (4.0, None), (9.0, None), (None, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    with pytest.warns(UserWarning, match="'b'"):
        imputed, medians = cleaning.impute_numeric(df)
    assert medians == {"a": 3.0, "b": None}
    assert sorted(r["a"] for r in imputed.collect()) == [1.0, 2.0, 3.0, 4.0, 9.0]
    assert {r["b"] for r in imputed.collect()} == {0.0}
    later, _ = cleaning.impute_numeric(
        spark.createDataFrame([(None, 5.0)], "a double, b double"), {"a": 3.0, "b": 1.0}
    )
    assert tuple(later.first()) == (3.0, 5.0)


def test_flag_medians_follow_from_sums(spark):
    rows = [(0, 1, 0, None), (0, 1, 1, None), (1, 1, 0, None), (0, 0, 1, None)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    plain = cleaning.fit_medians(df, list("abcd"))
    assert plain == {"a": 0.0, "b": 1.0, "c": 0.5, "d": None}
    assert cleaning.fit_medians(df, list("abcd"), flags=list("abcd")) == plain


def test_encoding_by_number_of_values(spark):
    rows = [
        ("Male", "No", "a", "only", None, 1.0, True), ("Female", "Yes", "b", "only", None, 2.0,
                                                       False),
        ("Male", None, "c", "only", None, None, True),
    ]
    df = spark.createDataFrame(
        rows, "Gender string, Paid string, Mode string, Same string, Nothing string, "
        "Tenure double, Flag boolean"
    ).withColumn("Churn", F.lit(1))
    schema = encoding.fit_feature_schema(df)
    assert schema.binary == {"Gender": {"Female": 0, "Male": 1}, "Paid": {"No": 0, "Yes": 1}}
    assert schema.multi == {"Mode": ("a", "b", "c")}
    assert schema.dropped == ("Same", "Nothing")
    assert schema.feature_columns == ("Gender", "Paid", "Tenure", "Flag", "Mode_b", "Mode_c")
    assert encoding.FeatureSchema.from_json(schema.to_json()) == schema
    encoded = encoding.apply_feature_schema(df, schema).collect()
    assert tuple(encoded[2]) == (1, 1, 0, None, 1, 0, 1)


def test_unseen_categories_keep_the_columns(spark):
    train = spark.createDataFrame(
        [("UPI", "Yes", 1.0), ("Card", "No", 2.0), ("COD", "No", 3.0)],
        "Mode string, Paid string, Tenure double",
    )
    schema = encoding.fit_feature_schema(train)
    batch = spark.createDataFrame([("Crypto", "Perhaps", 9)], "Mode string, Paid string, Extra int")
    encoded = encoding.apply_feature_schema(batch, schema)
    assert encoded.columns == list(schema.feature_columns)
    assert tuple(encoded.first()) == (0, 0, 0, 0)
    drift = encoding.unseen_binary_values(batch, schema).collect()
    assert [tuple(r) for r in drift] == [("Paid", "Perhaps", 1)]
    with pytest.warns(UserWarning, match="Paid"):
        assert encoding.warn_about_drift(batch, schema) == 1


def test_category_limit(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("name"))
    with pytest.raises(ValueError, match="name"):
        encoding.fit_feature_schema(df, limit=100)


def test_prepare_table_and_files(spark, customers, tmp_path):
    raw = staging_path(spark, "raw")
    write_table(customers, raw)
    out = prepare_files(spark, raw, str(tmp_path / "clean.csv"), str(tmp_path / "features"))
    features = spark.read.parquet(str(tmp_path / "features"))
    assert features.columns == ["Churn", *out.schema.feature_columns]
    assert features.count() == 180
    assert load_customers(spark, str(tmp_path / "clean.csv")).filter("Tenure IS NULL").count() == 0
    with pytest.raises(ValueError, match="0 or 1"):
        prepare_table(customers.withColumn("Churn", F.lit(None).cast("int")))


def test_test_rows_shape_nothing(spark):
    rows = [
        (i, i % 2, "Crypto" if i == 3 else ["Card", "UPI", "COD"][i % 3],
         1000.0 if i == 3 else float(i % 12), "test" if i == 3 else "val" if i % 5 == 0 else
         "train") for i in range(80)
    ]
    df = spark.createDataFrame(
        rows, "row_key long, Churn int, Mode string, Tenure double, split string"
    )
    prepared = fit_splits(df, "Churn")
    assert "Crypto" not in prepared.schema.multi["Mode"]
    train = sorted(r[3] for r in rows if r[4] == "train")
    middle = (train[(len(train) - 1) // 2] + train[len(train) // 2]) / 2
    assert prepared.medians["Tenure"] == middle
    test_row = prepared.part("test").first()
    assert (test_row["Mode_Card"], test_row["Mode_UPI"]) == (0.0, 0.0)


def test_splits_do_not_depend_on_partitions(spark, customers):
    cleaned = cleaning.clean(customers)
    marks = []
    for n in (1, 4, 64):
        frame = prepare_model_splits(cleaned.repartition(n), "Churn").frame
        marks.append({r["row_key"]: r["split"] for r in frame.select("row_key", "split").collect()})
    assert marks[0] == marks[1] == marks[2]
    counts = {s: list(marks[0].values()).count(s) for s in ("train", "val", "test")}
    assert counts == {"train": 108, "val": 36, "test": 36}
    with pytest.raises(ValueError, match="not found"):
        prepare_model_splits(cleaned, "Other")


def test_nothing_warns_on_clean_medians(spark):
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        cleaning.apply_medians(spark.createDataFrame([(1,)], "a int"), {"a": 2.0})


def test_categories_of_any_number(spark):
    from pyspark.ml.functions import vector_to_array

    rows = [(i, f"v{i % 700:03d}" if i % 9 else None, "only", "ab"[i % 2]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, many string, one string, two string")
    columns = ["many", "one", "two"]
    known = encoding.fit_categories(df, columns)
    wanted = {(c, v): (i, len(vs)) for c, vs in ((c, sorted({r[k] for r in rows if r[k] is not None}))
                                                 for k, c in enumerate(columns, 1)) for i, v in enumerate(vs)}
    assert {(r["column_name"], r["value"]): (r["code"], r["size"]) for r in known.collect()} == wanted
    batch = spark.createDataFrame([(1, "v001", "only", "b"), (2, None, None, "a"), (3, "new", "x", "zz"),
                                   (4, "v699", "only", None)], df.schema)
    coded = {r["id"]: tuple(r)[4:] for r in encoding.with_codes(batch, known, columns).collect()}
    assert coded == {1: (1, 0, 1), 2: (None, None, 0), 3: (None, None, None), 4: (699, 0, None)}
    vectors = encoding.one_hot_vectors(batch, known, columns).select(
        "id", vector_to_array("many_vector").alias("m"), vector_to_array("two_vector").alias("t")).collect()
    ones = {r["id"]: ([i for i, x in enumerate(r["m"]) if x], len(r["m"]), list(r["t"])) for r in vectors}
    assert ones == {1: ([0], 699, [1.0]), 2: ([], 699, [0.0]), 3: ([], 699, [0.0]), 4: ([698], 699, [0.0])}
    assert encoding.fit_categories(df.filter("id < 0"), columns).collect() == []


def test_nothing_is_lost_of_a_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'id,Tenure,extra column,When\n1,3.5,a,2020-01-02\nx,seven,,2020-02-31\n3,NA\n4,1,b,2020-01-01,more\n'
        '5,"say ""9""",,\n99999999999,inf,,2021-12-31\n')
    schema = "id int, Tenure double, `When` date, Absent string"
    df = load_with_rescue(spark, str(path), schema)
    rows = df.collect()
    assert df.columns == ["id", "Tenure", "When", "Absent", "rescued"]
    assert [r["id"] for r in rows] == [1, None, 3, 4, 5, None]
    assert rows[0]["rescued"] == {"extra column": "a"} and rows[0]["Absent"] is None
    assert rows[1]["rescued"] == {"id": "x", "Tenure": "seven", "When": "2020-02-31"}
    assert rows[2]["rescued"] == {"": "3,NA"}
    assert rows[3]["rescued"] == {"": "4,1,b,2020-01-01,more", "extra column": "b"}
    assert rows[4]["rescued"] == {"Tenure": 'say "9"'}
    assert rows[5]["rescued"] == {"id": "99999999999"}
    assert {(r["column_name"], r["n_failed"]) for r in rescue_report(df).collect()} == {
        ("", 2), ("id", 2), ("Tenure", 2), ("When", 1), ("extra column", 2)}
    assert {tuple(r) for r in rescued_values(df, ["Tenure"]).filter("column_name = 'id'").collect()} == {
        (None, "id", "x"), (math.inf, "id", "99999999999")}


def test_rescue_of_clashing_names_and_empty_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("rescued,__record,c1\nq,w,e\n")
    row = load_with_rescue(spark, str(tmp_path / "a.csv"), "c1 int, rescued string", rescued="odd").first()
    assert (row["c1"], row["rescued"], row["odd"]) == (None, "q", {"c1": "e", "__record": "w"})
    (tmp_path / "b.csv").write_text("id,x\n")
    df = load_with_rescue(spark, str(tmp_path / "b.csv"), "id int")
    assert df.collect() == [] and rescue_report(df).collect() == []
    with pytest.raises(FileNotFoundError):
        load_with_rescue(spark, "/nowhere/at/all.csv", "id int")
