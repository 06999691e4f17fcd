import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import staging
from tallyforge.sources import schemas

RAW = "job_id string, company_id string, job_title string, job_description string, job_url string, location string, date_retrieved timestamp_ntz, is_active boolean, raw_data string, partition_key string, published_at string, department string, requisition_id string"


def test_staging_keeps_the_latest_of_each_id(make):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("1", "c", "Sr. cook", "<p>The role is for a cook with experience</p>", "u", "Boise, ID", t(1), True, None, "c", "2024-01-01", "d", "R"),
        ("1", "c", "Sr. cook", "<p>The new role is for a cook with skills</p>", "u", "Boise, ID", t(2), True, None, "c", "2024-01-01", "d", "R"),
        ("2", None, None, None, None, None, None, None, None, None, None, None, None),
    ]
    u = staging.stage(make(RAW, *rows), "greenhouse", make("company_id string, company_name string", ("c", "Acme inc")), F.lit("2024-02-01"))
    u = u.withColumn("date_posted", F.col("date_posted").cast("date"))
    got = {r.job_id: r for r in schemas.assert_schema(u, "jobs_unified").collect()}
    one, two = got["1"], got["2"]
    assert (one.job_title_clean, one.company_name_clean, one.detected_language, one.location_standardized) == ("Senior Cook", "Acme Inc.", "en", "Boise, ID, United States")
    assert "new role" in one.job_description_clean and one.platform_specific_data == '{"requisition_id":"R"}' and one.data_quality_score == 0.9
    assert (two.detected_language, two.job_title_clean, two.data_quality_score) == ("unknown", "", 0.1)


def test_enriched_records(make):
    full = {"salary_info": {"salary_min": 5, "confidence": 1.0}, "skills": {"technical_skills": ["x"], "confidence": 0.0}, "experience_requirements": {"specific_technologies_years": {"sql": 2}, "confidence": 9}}
    a = staging.salvaged(make("k string, answer string", ("1", f"so: {json.dumps(full)}"), ("2", "no json"), ("3", "{}"), ("4", None)))
    got = {r.k: r for r in staging.enriched(a, "k", "answer").collect()}
    assert set(got) == {"1", "3"}
    r = got["1"]
    assert (r.salary_min, r.salary_currency, r.technical_skills, r.specific_technologies_years, r.llm_overall_confidence, r.llm_needs_manual_review) == (5, "USD", ["x"], {"sql": 2.0}, 0.5, True)
    assert got["3"].llm_overall_confidence == 0.0 and got["3"].equity_mentioned is False


def test_rules_and_models(make):
    j = make("k string, t string, b string", ("1", "Lead Cook", "We ask for 5+ years, hybrid"), ("2", None, None), ("3", "x", "36 months of practice on site"))
    e = {r.k: r for r in staging.enriched(staging.rule_answers(j, "k", "t", "b"), "k", "answer").collect()}
    assert (e["1"].min_years_experience, e["1"].work_type, e["1"].seniority_level) == (5, "Hybrid", "Senior") and e["2"].work_type is None and (e["3"].min_years_experience, e["3"].work_type) == (3, "On-site")

    def make_model():
        calls = {"n": 0}

        def model(t):
            calls["n"] += 1
            if "years" in t:
                raise RuntimeError("busy")
            return '{"skills": {"confidence": 1}}'

        return model

    m = {r.k: r for r in staging.model_answers(j, "k", "b", make_model).collect()}
    assert m["1"].answer is None and m["1"].error == "RuntimeError: busy" and m["2"].answer and m["2"].error is None


def test_schemas(spark, make, tmp_path):
    assert sorted(schemas.ensure_tables(spark, str(tmp_path))) == sorted(schemas.SCHEMAS) and schemas.ensure_tables(spark, str(tmp_path)) == []
    assert spark.read.parquet(f"{tmp_path}/jobs_unified.parquet").count() == 0
    assert schemas.seed(spark, "us_states_mapping", [("ID", "Idaho")]).count() == 1
    with pytest.raises(ValueError, match="missing"):
        schemas.assert_schema(make("code string"), "us_states_mapping")
    with pytest.raises(ValueError, match="repeat"):
        schemas.expect_unique(make("a int", (1,), (1,)), ["a"])
    with pytest.raises(ValueError, match="parent"):
        schemas.expect_fk(make("a int", (1,), (2,)), make("a int", (1,)), "a")
    schemas.expect_fk(make("a int", (1,), (None,)), make("a int", (1,)), "a")


def test_view_versions():
    assert schemas.view_version("select 1 -- x\n from /* y\n */ t") == schemas.view_version("select 1\n  from t") != schemas.view_version("select 2 from t")
