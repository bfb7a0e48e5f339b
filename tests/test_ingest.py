"""Folder to warehouse, end to end, with real workbook bytes."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronograde.operators import audit, history, integrity
from chronograde.operators.rules import standard_rules
from chronograde.sources.landing import discover, fingerprint, sheet_cells
from chronograde.sources.store import Store, Write
from chronograde.streaming.landing_stream import drain, ingest_folder
from conftest import rating_rows, workbook

T0 = 1_700_000_000


def land(folder, name, content, at):
    path = folder / name
    path.write_bytes(content)
    os.utime(path, (T0 + at, T0 + at))


def test_sheet_cells():
    content = workbook([["a", None, 1.0], [None, " b ", 42.556]])
    assert sheet_cells(content, "MASTER") == [(0, 0, "a"), (0, 2, "1"), (1, 1, " b "), (1, 2, "42.56")]
    assert sheet_cells(content, "OTHER") == [] and sheet_cells(b"Error: not a workbook", "MASTER") == []


def test_discovery_and_fingerprint(spark, tmp_path):
    import hashlib

    land(tmp_path, "a.xlsm", b"abc", 0)
    land(tmp_path, "~$a.xlsm", b"lock", 0)
    land(tmp_path, "b.txt", b"no", 0)
    rows = fingerprint(discover(spark, str(tmp_path))).collect()
    assert [(r["filename"], r["file_size"], r["checksum"]) for r in rows] == [("a.xlsm", 3, hashlib.sha256(b"abc").hexdigest())]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder, root = tmp_path_factory.mktemp("landing"), tmp_path_factory.mktemp("store")
    store = Store(spark, str(root))
    a1 = workbook(rating_rows("Company A"))
    land(folder, "01_a.xlsm", a1, 1)
    land(folder, "02_copy_of_a.xlsm", a1, 2)
    land(folder, "03_a_new_sector.xlsm", workbook(rating_rows("Company A", CorporateSector="Media")), 3)
    land(folder, "04_a_new_profile.xlsm", workbook(rating_rows("Company A", CorporateSector="Media", Leverage="CCC")), 4)
    land(folder, "05_a_new_value.xlsm", workbook(rating_rows("Company A", CorporateSector="Media", Leverage="CCC", metrics={"Cover": [9, 9, 9, 9]})), 5)
    land(folder, "06_b.xlsm", workbook(rating_rows("Company B", Industry_risk=["Media", "Media"], Industry_weight=[0.5, 0.5], Industry_risk_score=["A", "A"])), 6)
    bad = workbook(rating_rows("Company C", Liquidity="100 Notches Down", Industry_weight=[0.5, 0.6]))
    land(folder, "07_bad.xlsm", bad, 7)
    land(folder, "08_bad_again.xlsm", bad, 8)
    land(folder, "09_no_anchor.xlsm", workbook([[None, "Rated entity", "X"]]), 9)
    land(folder, "10_broken.xlsm", b"not a workbook", 10)
    land(folder, "11_two_labels_one_year.xlsm", workbook(rating_rows("Company D", years=[2023, 2024, "2024E", 2026])), 11)
    land(folder, "12_sector_missing.xlsm", workbook(rating_rows("Company E", Industry_weight=[0.3, 0.3, 0.4], Industry_risk_score=["A"])), 12)
    assert ingest_folder(spark, str(folder), store, standard_rules(), datetime(2024, 1, 1)) == 1
    return folder, store


def test_outcomes(loaded):
    log = {r["file_name"]: r for r in loaded[1].read("pipeline_file_details").collect()}
    got = {n[:2]: (r["outcome"], r["execution_stage"], r["route"]) for n, r in log.items()}
    ok, bad = ("SUCCESS", "5.Transform", "archive"), "dlq"
    assert got == {
        "01": ok, "02": ("SKIPPED", "1.Initial", bad), "03": ok, "04": ok, "05": ok, "06": ok,
        "07": ("FAILURE", "3.Validation", bad), "08": ("FAILURE", "3.Validation", bad),
        "09": ("FAILURE", "2.Extraction", bad), "10": ("FAILURE", "2.Extraction", bad),
        "11": ("FAILURE", "5.Transform", bad), "12": ("FAILURE", "5.Transform", bad),
    }
    assert log["07_bad.xlsm"]["error_message"] == (
        "Value violation on 'Liquidity': Element '100 Notches Down' is out of bounds.; "
        "Mathematical allocation error: Combined weights sum to 110.0% instead of 100%."
    )
    assert log["02_copy_of_a.xlsm"]["submission_id"] is None
    assert log["02_copy_of_a.xlsm"]["error_message"] == "Duplicate file checksum detected"


def test_submissions_and_errors(loaded):
    store = loaded[1]
    subs = store.read("submissions")
    assert subs.count() == 11 and subs.select("submission_id").distinct().count() == 11
    states = {r["filename"][:2]: (r["final_status"], r["current_status"]) for r in subs.collect()}
    assert states["01"] == ("SUCCESS", "SUBMISSION SUCCESS") and states["07"] == ("FAILURE", "VALIDATION FAILURE")
    assert states["09"] == ("FAILURE", "EXTRACTION FAILURE") and states["12"] == ("FAILURE", "TRANSFORM FAILURE")
    kinds = {r["error_type"]: r["error_per_file"] for r in audit.error_report(store.read("submission_errors")).collect()}
    assert kinds["Value violation"] == 1 and kinds["Mathematical al"] == 1
    assert store.read("submission_errors").count() == 2 * 2 + 4


def test_run_and_audit(loaded):
    store = loaded[1]
    assert audit.upload_stats(store.read("pipeline_runs")).first().asDict() == {
        "total_pipeline_runs": 1, "total_files_evaluated": 12, "success_count": 5, "failure_count": 6, "skipped_count": 1,
    }
    trail = store.read("pipeline_audit_logs")
    assert trail.filter("execution_status = 'SKIPPED'").count() == 1
    assert trail.filter("execution_status = '5.Transform'").count() == 7


def test_history(loaded):
    store = loaded[1]
    versions = history.entity_versions(store.read("dim_entities"), "Company A").collect()
    assert [v["is_current"] for v in versions] == [True, False]
    assert versions[1]["valid_to"] == versions[0]["valid_from"]
    profiles = store.read("dim_profiles").filter("natural_key = 'Company A'")
    assert profiles.count() == 3 and profiles.filter("is_current").count() == 1
    industries = store.read("dim_ind_profile")
    # the repeated industry of Company B is stored once
    b = store.read("dim_profiles").filter("natural_key = 'Company B'").join(industries.drop("is_current"), "profile_key")
    assert b.count() == 1
    assert industries.filter("is_current").count() == 3
    # a metric-only correction updates the facts of the current profile
    points = history.metric_history(store.read("fct_rating_metric", "is_open"), store.read("dim_entities"), "company a", ["Cover"])
    assert {float(r["metric_value"]) for r in points.collect()} == {9.0}
    other = history.metric_history(store.read("fct_rating_metric", "is_open"), store.read("dim_entities"), "Company A", ["Debt/EBITDA"])
    assert {r["calendar_year"]: r["metric_value_formatted"] for r in other.collect()} == {
        2022: "4.86", 2023: "5.00", 2024: None, 2025: "1,234,567.50"}


def check_invariants(store):
    entities, profiles = store.read("dim_entities"), store.read("dim_profiles")
    industries, facts = store.read("dim_ind_profile"), store.read("fct_rating_metric", "is_open")
    assert integrity.repeated_current(entities, ["natural_key"]).count() == 0
    assert integrity.repeated_current(profiles, ["entity_key"]).count() == 0
    assert integrity.repeated_keys(industries, ["profile_key", "sector_name", "industry_hash_key"]).count() == 0
    assert integrity.repeated_keys(facts, ["entity_key", "profile_key", "metric_name", "calendar_year"]).count() == 0
    assert integrity.orphans(profiles, entities, "entity_key").count() == 0
    assert integrity.orphans(industries, profiles, "profile_key").count() == 0
    assert integrity.orphans(facts, profiles, "profile_key").count() == 0
    assert entities.filter("valid_to < valid_from").count() == 0
    open_children = profiles.filter("is_current").join(entities.filter("is_current"), "entity_key", "left_anti")
    assert open_children.count() == 0


def test_invariants(loaded):
    check_invariants(loaded[1])


def dims(store):
    cols = {"dim_entities": ["natural_key", "entity_hash_key", "is_current"], "dim_profiles": ["natural_key", "profile_hash_key", "is_current"]}
    return {t: sorted(map(str, store.read(t).select(c).collect())) for t, c in cols.items()}


def test_second_batch(spark, loaded, tmp_path):
    """Known files are skipped, failures fail again, a change closes the old version."""
    folder, store = loaded
    before = dims(store)
    land(tmp_path, "20_a.xlsm", workbook(rating_rows("Company A")), 1)
    land(tmp_path, "21_b.xlsm", workbook(rating_rows("Company B", CorporateSector="Retail")), 20)
    land(tmp_path, "22_a_same_profile.xlsm", workbook(rating_rows("Company A", CorporateSector="Media", Leverage="CCC", metrics={"Cover": [7, 7, 7, 7]})), 21)
    version = ingest_folder(spark, str(tmp_path), store, standard_rules(), datetime(2024, 1, 2))
    assert version == 2
    log = {r["file_name"][:2]: r["outcome"] for r in store.read("pipeline_file_details").filter("run_id = 2").collect()}
    assert log == {"20": "SKIPPED", "21": "SUCCESS", "22": "SUCCESS"}
    after = dims(store)
    assert len(after["dim_entities"]) == len(before["dim_entities"]) + 1
    # an unchanged profile keeps its industries current
    a = store.read("dim_profiles").filter("natural_key = 'Company A' AND is_current")
    assert a.join(store.read("dim_ind_profile").filter("is_current").select("profile_key"), "profile_key").count() == 2
    cover = history.metric_history(store.read("fct_rating_metric", "is_open"), store.read("dim_entities"), "Company A", ["Cover"])
    assert {float(r["metric_value"]) for r in cover.collect()} == {7.0}
    check_invariants(store)


def test_no_files_no_run(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    store = Store(spark, str(tmp_path / "store"))
    (tmp_path / "landing" / "x.txt").write_text("x")
    assert ingest_folder(spark, str(tmp_path / "landing"), store, standard_rules(), datetime(2024, 1, 1)) is None
    assert store.manifest()["version"] == 0


def test_stream_equals_one_batch(spark, tmp_path):
    """Micro-batches of a few files give the dimensions of a single batch; a restart loads nothing twice."""
    folder = tmp_path / "landing"
    folder.mkdir()
    for i, (name, sector) in enumerate([("A", "Media"), ("B", "Media"), ("A", "Retail"), ("A", "Retail"), ("B", "Chemicals")]):
        land(folder, f"{i}.xlsm", workbook(rating_rows(f"Company {name}", CorporateSector=sector, Leverage="BB" if i == 3 else "B")), i * 100)
    streamed, single = Store(spark, str(tmp_path / "s1")), Store(spark, str(tmp_path / "s2"))
    for _ in range(2):
        query = drain(spark, str(folder), streamed, standard_rules(), str(tmp_path / "ck"), lambda: datetime(2024, 1, 1), files_per_batch=2)
        query.awaitTermination(300)
        assert query.exception() is None
    ingest_folder(spark, str(folder), single, standard_rules(), datetime(2024, 1, 1))
    assert streamed.read("submissions").count() == single.read("submissions").count() == 5
    assert dims(streamed) == dims(single)
    check_invariants(streamed)


def test_commit_is_exclusive(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    runs = spark.createDataFrame([(1, None, "x", 1, 1, 0, 0)], store.read("pipeline_runs").schema)
    assert store.commit({"pipeline_runs": Write(runs)}) == 1
    with pytest.raises(Exception):
        store.commit({"pipeline_runs": Write(runs)}, expect=0)
    assert store.read("pipeline_runs").count() == 1


def test_download(loaded):
    log, contents = loaded[1].read("pipeline_file_details"), loaded[1].read("pipeline_file_contents")
    upload = log.filter("file_name = '10_broken.xlsm'").first()["id"]
    row = audit.file_content(log, contents, upload).first()
    assert (row["file_name"], bytes(row["file_content"])) == ("10_broken.xlsm", b"not a workbook")
    empty = contents.withColumn("content", F.lit(b""))
    assert audit.file_content(log, empty, upload).count() == 0 and audit.file_content(log, contents, -1).count() == 0


def test_upload_details(loaded):
    store = loaded[1]
    rows = {r["file_name"][:2]: r for r in audit.upload_impact(store.read("pipeline_file_details"), store.read("dim_entities")).collect()}
    assert [s["natural_key"] for s in rows["01"]["impacted_snapshots"]] == ["Company A"]
    assert rows["04"]["impacted_snapshots"] == [] and rows["02"]["impacted_snapshots"] == []
