"""Masking, residency, contracts."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from borderlake.functions.mask import KEY_VARIABLE, mask, tokenise, tokenise_in_plan
from borderlake.functions.residency import classify_transfer, load_policy, region_name
from borderlake.operators.contracts import load_contract, load_contracts, pii_columns, pii_inventory
from borderlake.operators.silver import projection

from helpers import KEY, rows

POLICY = {"allowed_regions": ["af-south-1"], "flagged_regions": ["eu-west-1"], "on_unknown_region": "blocked"}


def masked(spark, values, strategy, key=None):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in frame.select(mask(F.col("v"), strategy, key)).collect()]


def test_hash_and_partial(spark):
    assert masked(spark, ["a", None], "hash") == [hashlib.sha256(b"a").hexdigest(), None]
    assert masked(spark, ["+27821234567", "12", "", None], "partial") == ["567", "12", "", None]


@pytest.mark.parametrize("key", ["k", KEY, "x" * 65, "schlüssel"])
def test_tokens_are_hmacs_in_both_forms(spark, key):
    values = ["8001015009087", "", "é", None]
    expected = [None if v is None else hmac.new(key.encode(), v.encode(), "sha256").hexdigest() for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = frame.select(tokenise(F.col("v"), key), tokenise_in_plan(F.col("v"), key)).collect()
    assert [r[0] for r in found] == [r[1] for r in found] == expected


def test_tokenising_needs_a_key_before_any_job(spark, monkeypatch):
    monkeypatch.delenv(KEY_VARIABLE, raising=False)
    with pytest.raises(RuntimeError):
        mask(F.col("v"), "tokenise")
    monkeypatch.setenv(KEY_VARIABLE, "")
    with pytest.raises(RuntimeError):
        mask(F.col("v"), "tokenise")


def test_the_key_is_not_in_the_plan(spark, capsys):
    spark.createDataFrame([("a",)], "v string").select(tokenise(F.col("v"), KEY)).explain(True)
    plan = capsys.readouterr().out
    assert "token" in plan and KEY not in plan and KEY.encode().hex() not in plan.lower()


@pytest.mark.parametrize("strategy", ["drop", "none", "rot13"])
def test_other_strategies_are_refused(spark, strategy):
    with pytest.raises(ValueError):
        mask(F.col("v"), strategy)


def test_an_unmasked_personal_column_never_reaches_silver(spark):
    with pytest.raises(ValueError):
        projection({"columns": [{"name": "v", "pii": True}]})


def test_verdicts(spark):
    cases = [
        ("af-south-1", "af-south-1", "domestic"),
        ("eu-west-1", "af-south-1", "domestic"),
        ("ap-south-1", "ap-south-1", "domestic"),
        ("af-south-1", "eu-west-1", "cross_border_flagged"),
        ("af-south-1", "ap-south-1", "blocked"),
        ("af-south-1", "", "blocked"),
        (None, "af-south-1", None),
        ("af-south-1", None, None),
    ]
    frame = spark.createDataFrame(cases, "h string, p string, expected string")
    verdict = classify_transfer(F.col("h"), F.col("p"), POLICY)
    assert all(r.expected == r.v for r in frame.withColumn("v", verdict).collect())
    empty = frame.limit(1).select(classify_transfer(F.lit("a"), F.lit("b"), {})).first()[0]
    assert empty == "blocked"


def test_a_policy_may_not_fail_open(tmp_path):
    (tmp_path / "p.yml").write_text("on_unknown_region: domestic\n")
    with pytest.raises(ValueError):
        load_policy(tmp_path / "p.yml")
    (tmp_path / "empty.yml").write_text("")
    assert load_policy(tmp_path / "empty.yml") == {}


def test_region_names_fall_back_to_the_code(spark):
    frame = spark.createDataFrame([("eu-west-1",), ("ap-south-1",)], "r string")
    assert [r[0] for r in frame.select(region_name(F.col("r"))).collect()] == ["Ireland", "ap-south-1"]


def test_contracts(spark, tmp_path):
    contracts = load_contracts()
    assert pii_columns(contracts["customers"]) == ["first_name", "last_name", "sa_id_number", "email", "phone"]
    assert rows(pii_inventory(spark, contracts)) == {
        ("customers", "first_name", "drop"),
        ("customers", "last_name", "drop"),
        ("customers", "sa_id_number", "tokenise"),
        ("customers", "email", "hash"),
        ("customers", "phone", "partial"),
    }
    (tmp_path / "c.yml").write_text("")
    assert load_contract(tmp_path / "c.yml") == {}
    (tmp_path / "c.yml").write_text("dataset: d\ncolumns: [{name: x, uniqe: true}]\n")
    with pytest.raises(ValueError, match="uniqe"):
        load_contract(tmp_path / "c.yml")
