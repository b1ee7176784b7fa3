import pytest
from pyspark.sql import functions as F

from rankwatch.operators import quality as q
from rankwatch.sources.snapshot import load_snapshot, read_csv, read_upload, typed

from .conftest import HEADER, csv_lines


def fired(findings):
    return {(r["code"], r["column"]): r["value"] for r in findings.where("fired").collect()}


def test_clean_table_passes(frame, cfg):
    df = frame(2)
    found = q.validate(df, cfg, fail_fast=True)
    assert fired(found) == {}
    assert tuple(q.validation_summary(found, df).first()) == (True, 0, 2, 15)


def test_missing_column(frame, cfg):
    with pytest.raises(q.DataValidationError, match="required_column in city"):
        q.validate(frame(2).drop("city"), cfg, fail_fast=True)


def test_duplicate_id(frame, cfg):
    df = frame(2).withColumn("customer_id", F.lit(1))
    assert fired(q.validate(df, cfg)) == {("duplicate_ids", "customer_id"): 1.0}
    assert fired(q.validate(df, cfg.with_(max_duplicates=1))) == {}


def test_target_two(frame, cfg):
    df = frame(2).withColumn("churn", F.col("churn") * 2)
    assert fired(q.validate(df, cfg)) == {("target_domain", "churn"): 1.0}
    assert [tuple(r) for r in q.target_invalid_values(df, cfg).collect()] == [("2", True, 1)]


def test_text_target_hides_domain_check(frame, cfg):
    df = frame(4).withColumn("churn", F.expr("CASE churn WHEN 1 THEN 'yes' ELSE '5' END"))
    assert fired(q.validate(df, cfg)) == {("target_non_numeric", "churn"): 2.0}
    listed = {tuple(r) for r in q.target_invalid_values(df, cfg).collect()}
    assert listed == {("yes", False, 2), ("5", True, 2)}


def test_all_null_target_has_no_target_finding(frame, cfg):
    df = frame(2).withColumn("churn", F.lit(None).cast("int"))
    assert fired(q.validate(df, cfg)) == {("missing_values", "churn"): 2.0}


def test_negative_bill(frame, cfg):
    df = frame(2).withColumn("monthly_bill", F.lit(-10.0))
    with pytest.raises(q.DataValidationError, match="below_min in monthly_bill: 2"):
        q.validate(df, cfg, fail_fast=True)


def test_bad_number_hides_range(frame, cfg):
    df = frame(4).withColumn("age", F.expr("CASE WHEN customer_id = 10000 THEN '1d' ELSE '-5' END"))
    assert fired(q.validate(df, cfg)) == {("non_numeric", "age"): 1.0}


def test_target_optional(frame, cfg):
    assert fired(q.validate(frame(2).drop("churn"), cfg, require_target=False)) == {}
    assert ("required_column", "churn") in fired(q.validate(frame(2).drop("churn"), cfg))


def test_missing_allowed(frame, cfg):
    df = frame(2).withColumn("city", F.lit(None).cast("string"))
    assert fired(q.validate(df, cfg)) == {("missing_values", "city"): 2.0}
    assert fired(q.validate(df, cfg.with_(allow_missing=True))) == {}


def test_empty_table(frame, cfg):
    assert fired(q.validate(frame(2).limit(0), cfg)) == {}


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (1,), (2,)], "id int")
    assert q.duplicate_count(df, "id").first()[0] == 2
    nan = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "id double")
    assert q.duplicate_count(nan, "id").first()[0] == 1


def test_text_ids_compare_as_numbers(spark):
    df = spark.createDataFrame([("1",), ("01",), ("a",), ("A",), (None,), ("1.0",)], "id string")
    assert q.duplicate_count(df, "id").first()[0] == 1
    assert [tuple(r) for r in q.duplicate_keys(df, "id").collect()] == [("1", 2)]


def test_csv_round_trip(spark, cfg, write_csv):
    path = write_csv("a.csv", csv_lines(4), bom=True)
    df = load_snapshot(spark, path, cfg)
    assert df.count() == 4
    kinds = dict(df.dtypes)
    assert (kinds["customer_id"], kinds["signup_date"], kinds["churn"], kinds["age"]) == (
        "bigint", "date", "int", "double",
    )


def test_csv_is_read_as_text(spark, cfg, write_csv):
    lines = csv_lines(3)
    lines[1] = lines[1].replace(",24,", ", 2 ,", 1)
    lines[2] = lines[2].replace(",48,", ",1d,", 1)
    lines[3] = lines[3].replace("Quetta", "NA")
    raw = read_csv(spark, write_csv("b.csv", lines))
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert fired(q.validate(raw, cfg)) == {
        ("non_numeric", "age"): 1.0, ("missing_values", "city"): 1.0,
    }
    assert [r["age"] for r in typed(raw, cfg).orderBy("customer_id").collect()] == [2.0, None, 36.0]
    with pytest.raises(q.DataValidationError):
        load_snapshot(spark, write_csv("c.csv", lines), cfg)


def test_csv_quotes_and_line_breaks(spark, cfg, write_csv):
    lines = csv_lines(2)
    lines[1] = lines[1].replace("Coverage seems alright", 'He said ""fine"",\nthen left')
    texts = [r[0] for r in read_csv(spark, write_csv("d.csv", lines), True).select("customer_feedback").collect()]
    assert texts[0] == 'He said "fine",\nthen left'


def test_text_ids_stay_text(spark, cfg, write_csv):
    lines = csv_lines(2)
    lines[1] = lines[1].replace("10000", "A-1", 1)
    path = write_csv("e.csv", lines)
    kinds = dict(load_snapshot(spark, path, cfg.with_(id_type="string")).dtypes)
    assert kinds["customer_id"] == "string"
    with pytest.raises(Exception, match="A-1"):
        load_snapshot(spark, path, cfg).select("customer_id").collect()


def test_files_with_another_column_order_are_refused(spark, cfg, write_csv):
    lines = csv_lines(2)
    write_csv("folder/a.csv", lines)
    turned = [",".join([*x.split(",")[1:], x.split(",")[0]]) for x in lines]
    path = write_csv("folder/b.csv", turned).rsplit("/", 1)[0]
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path).collect()


def test_upload_checks(spark, cfg, write_csv, frame):
    raw = read_upload(spark, write_csv("f.csv", ["customer_id,age", "1,20", "1,30"], bom=True))
    assert raw.columns == ["customer_id", "age"]
    codes = fired(q.upload_profile(raw, cfg))
    assert sum(c == "required_column" for c, _ in codes) == 12
    assert codes["duplicate_ids", "customer_id"] == 1.0
    assert fired(q.upload_profile(frame(3).drop("churn"), cfg)) == {}
    empty = fired(q.upload_profile(frame(3).limit(0), cfg, require_target=True))
    assert empty == {("empty", None): 0.0}
    bad = frame(3).withColumn("churn", F.lit(None).cast("int"))
    assert fired(q.upload_profile(bad, cfg, True)) == {("target_non_numeric", "churn"): 3.0}
    with pytest.raises(ValueError):
        read_upload(spark, None)


def test_header_only_csv(spark, cfg, write_csv):
    raw = read_csv(spark, write_csv("g.csv", [HEADER]))
    assert fired(q.upload_profile(raw, cfg)) == {("empty", None): 0.0}
