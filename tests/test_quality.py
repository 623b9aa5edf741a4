import pytest
from pyspark.sql import functions as F

from stratalake.functions.columns import key_hash
from stratalake.operators import access, quality
from stratalake.operators.joins import enrich


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, None, -5.0), (3, "c", None)], "id INT, name STRING, total DOUBLE")


def test_expectations(spark, people, rows):
    watched, seen = quality.expect(people, {"positive": "total > 0", "named": F.col("name").isNotNull()})
    assert watched.count() == 3
    assert seen.get == {"rows": 3, "positive": 2, "named": 1}  # an unknown outcome is a violation
    assert rows(quality.expect_or_drop(people, {"positive": "total > 0"}), "id") == [(1,)]
    with pytest.raises(Exception, match="expectation violated: positive"):
        quality.expect_or_fail(people, {"positive": "total > 0"}).count()


def test_null_passes_a_rule_unless_named(people, rows):
    lax = quality.validate(people, [("negative", "total < 0")])
    assert rows(lax.filter("rejection_reason IS NULL"), "id") == [(1,), (3,)]
    strict = quality.validate(people, [("missing", "total IS NULL"), ("negative", "total < 0")])
    assert rows(strict, "id", "rejection_reason") == [(1, None), (2, "negative"), (3, "missing")]


def test_profile(people, rows):
    assert rows(quality.null_counts(people)) == [(0, 1, 1)]
    got = quality.describe(people, ["id", "total"]).collect()
    assert [(r["column"], r["count"], r["mean"]) for r in got] == [("id", 3, 2.0), ("total", 2, 2.5)]


def test_unique_keys(people):
    quality.assert_unique(people, "id")
    with pytest.raises(ValueError, match="repeated keys"):
        quality.assert_unique(people.unionByName(people), ["id"])


def test_key_hash_keeps_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x STRING, y STRING")
    assert df.select(key_hash(["x", "y"]).alias("h")).distinct().count() == 2
    plain = df.limit(1).select(key_hash(["x", "y"], null_token=None).alias("h"), F.sha2(F.lit("a"), 256).alias("w")).first()
    assert plain["h"] == plain["w"]


def test_enrich_keeps_rows_and_marks_nameless_matches(spark, people, rows):
    dim = spark.createDataFrame([(1, None)], "id INT, label STRING")
    got = enrich(people, dim, "id", ["label"])
    assert rows(got, "id", "_join_status") == [(1, "matched"), (2, "unmatched"), (3, "unmatched")]
    assert rows(enrich(people, dim, "id", ["label"])) == rows(got)


def test_masks_and_row_filters(spark, rows):
    df = spark.createDataFrame([("4532-7891-2345-6789", "Mexico"), ("1111-2222-3333-4444", None)], "account STRING, country STRING")
    assert rows(access.mask_columns(df, ["account"], "analyst"), "account")[1] == ("****-****-****-6789",)
    assert rows(access.mask_columns(df, ["account"], "data-engineer")) == rows(df)
    assert access.filter_rows(df, "country = 'Mexico'", "analyst").count() == 1
    assert access.filter_rows(df, "country = 'Mexico'", "lead", {"lead"}).count() == 2
    access.register_mask(spark, "mask_t")
    access.register_row_filter(spark, "sees_t", "Mexico")
    seen = spark.sql("SELECT mask_t('4532-7891-2345-6789', 'x'), sees_t('Peru', 'x'), sees_t('Peru', 'data-engineer')").first()
    assert tuple(seen) == ("****-****-****-6789", False, True)


def test_reconcile_keeps_null_groups(spark, people, rows):
    got = quality.reconcile(people, people.limit(0), ["name"])
    assert rows(got, "name", "n_a", "n_b", "matches") == sorted([("a", 1, 0, False), ("c", 1, 0, False), (None, 1, 0, False)], key=repr)
