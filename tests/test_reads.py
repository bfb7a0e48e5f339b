"""Name patterns, deep pages, kept reports and co-partitioned joins against plain forms."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronograde.functions.text import trimmed
from chronograde.operators import audit, copart, history, names, pages, reports
from chronograde.operators.rules import standard_rules
from chronograde.plans import warehouse
from chronograde.sources.store import Store, stage
from chronograde.streaming.landing_stream import ingest_folder
from conftest import rating_rows, workbook
from test_scd2 import make, row

START = datetime(2024, 1, 1)


def rows_of(df, *columns):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


# Name patterns -------------------------------------------------------------------------------------------------------

NAMES = ["Company A", "  company b ", "COMPANY", "Compañía", "ÄÖÜ Werke", "ab", "a", "", "50%_off\\x", "ΑΣ ΣΟΦΟΣ", "İstanbul AŞ", "aaaaaa", "banana", None]
PATTERNS = ["%pan%", "company _", "company%", "%", "_", "", "a", "%ab%", "%PAÑ%", "%öü w%", "%50\\%\\_%", "%off\\\\x", "%σοφ%", "%ΑΣ%", "%aaa%",
            "%anan%", "%zzz%", "%com%ny%", " Company A ", "i̇stanbul%"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_patterns_match_as_without_index(spark, indexed_names, pattern):
    store, everything = indexed_names
    want = everything.filter(F.ilike(trimmed(F.col("natural_key")), F.lit(pattern.strip()))).select("natural_key").distinct()
    assert rows_of(names.matching(store, pattern).select(F.col("name").alias("natural_key"))) == rows_of(want)


@pytest.fixture(scope="module")
def indexed_names(spark, tmp_path_factory):
    rng = random.Random(4)
    values = NAMES + ["".join(rng.choice("abC ñ%") for _ in range(rng.randrange(9))) for _ in range(150)]
    store = Store(spark, str(tmp_path_factory.mktemp("names")), buckets=32)
    everything = stage(spark.createDataFrame([(v,) for v in values + values[:20]], "natural_key string"), "values")
    half = F.xxhash64("natural_key") % 2 == 0
    for part in (everything.filter(half), everything.filter(~half)):
        store.commit(names.index_writes(store, part))
    return store, everything


def test_search_reads_the_rarest_lists_only(spark, indexed_names):
    store, _ = indexed_names
    grams = names.pattern_grams(spark, "%Werke%ÄÖ")
    assert grams == ["erk", "rke", "wer"]
    read = {f.rsplit("/_bucket=", 1)[1].split("/")[0] for f in names.candidates(store, grams).inputFiles()}
    assert 1 <= len(read) <= names.LISTS
    assert names.candidates(store, ["wer", "qqq"]).count() == 0
    empty = Store(spark, store.root + "-none")
    assert names.matching(empty, "%abc%").count() == 0 and names.matching(empty, "a").count() == 0


@pytest.mark.parametrize("in_list", [0, 1000])
def test_merges_keep_the_index_and_versions_are_whole(spark, tmp_path, monkeypatch, in_list):
    rng = random.Random(1)
    monkeypatch.setattr(names, "IN_LIST", in_list)
    rows = [row(i, rng.choice(["Acme North", "acme south", "Bolt", "Cold Acme", f"k{rng.randrange(30)}"]), i, rng.choice("ab"), "x") for i in range(120)]
    store = Store(spark, str(tmp_path), buckets=16)
    for part in (rows[:50], rows[50:90], rows[90:]):
        batch = stage(make(spark, part), "rows")
        touched = store.touched(batch, "natural_key")
        store.commit(warehouse.merge_touched(store, batch, touched, stage))
    index = store.read_open("name_grams")
    assert index.count() == index.distinct().count()
    assert {r["name"] for r in index.filter("gram = ''").collect()} == {r[1] for r in rows}
    for pattern in ("%ACME%", "acme%", "%k1%", "nobody here"):
        want = store.read("dim_entities").filter(F.ilike(trimmed(F.col("natural_key")), F.lit(pattern)))
        assert rows_of(names.versions(store, pattern), *want.columns) == rows_of(want)
    if in_list:
        acme = {store.spark.range(1).select(store.bucket(F.lit(n))).first()[0] for n in ("Acme North", "acme south", "Cold Acme")}
        files = [f for f in names.versions(store, "%acme%").inputFiles() if "_part=open" in f]
        assert {int(f.rsplit("/_bucket=", 1)[1].split("/")[0]) for f in files} <= acme


# Deep pages ----------------------------------------------------------------------------------------------------------


def test_every_page_equals_the_full_sort(spark, tmp_path):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else None if rng.random() < 0.05 else f"n{rng.randrange(50):02}", i) for i in range(500)]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    built = pages.build(spark.createDataFrame(rows, "name string, id long").repartition(7), ["name", "id"], str(tmp_path / "p"), rows_per_range=40)
    assert sum(built.counts.values()) == 500 and len(built.counts) > 8
    for offset, limit in [(0, 10), (37, 10), (240, 60), (495, 10), (500, 5), (900, 5), (10, 0), (0, 500)]:
        assert [tuple(r) for r in built.page(offset, limit).collect()] == want[offset:offset + limit]
    assert len({f.rsplit("/page_range=", 1)[1].split("/")[0] for f in built.page(250, 10).inputFiles()}) <= 2
    with pytest.raises(ValueError):
        built.page(-1, 5)
    nothing = pages.build(spark.createDataFrame([], "name string, id long"), ["name", "id"], str(tmp_path / "e"))
    assert nothing.page(0, 10).collect() == []


# Reports -------------------------------------------------------------------------------------------------------------


def test_kept_reports_equal_recomputed_ones(spark, tmp_path):
    rng = random.Random(5)
    store, log_rows, error_rows = Store(spark, str(tmp_path), buckets=8), [], []
    log_schema = "id long, run_id long, outcome string, execution_stage string, error_message string"
    error_schema = "submission_id long, error_message string"
    for batch in range(4):
        log = [(batch * 50 + i, rng.choice([1, 2, 3, batch + 10, None]), rng.choice(["SUCCESS", "FAILURE", "SKIPPED", None]), rng.choice(["1", "3"]),
                rng.choice([None, "Value violation on 'x'", "Missing"])) for i in range(50 if batch != 2 else 0)]
        errors = [(rng.randrange(20), rng.choice(["Value violation on 'x'", "Missing required", None])) for _ in range(30)]
        before = store.manifest()["tables"].get("report_uploads", {}).get("open", [])
        frames = spark.createDataFrame(log, log_schema), spark.createDataFrame(errors, error_schema)
        writes = reports.merge_writes(store, reports.partials(*frames))
        if before and writes.get("report_uploads"):
            touched = writes["report_uploads"].touched
            store.commit(writes)
            after = store.manifest()["tables"]["report_uploads"]["open"]
            assert {p for p in before if int(p.rsplit("=", 1)[1]) not in touched} <= set(after)
        else:
            store.commit(writes)
        log_rows += log
        error_rows += errors
        whole_log, whole_errors = spark.createDataFrame(log_rows, log_schema), spark.createDataFrame(error_rows, error_schema)
        assert rows_of(reports.kept(store, "uploads")) == rows_of(audit.upload_report(whole_log))
        assert rows_of(reports.kept(store, "errors")) == rows_of(audit.error_report(whole_errors))
        assert rows_of(reports.kept_stats(store)) == rows_of(audit.upload_stats(audit.run_counts(whole_log)))


def test_ingest_keeps_the_reports_and_the_index(spark, tmp_path):
    store, landing = Store(spark, str(tmp_path / "w")), tmp_path / "landing"
    for run, entity in enumerate(["Company A", "Company B"]):
        (landing / str(run)).mkdir(parents=True)
        (landing / str(run) / "good.xlsm").write_bytes(workbook(rating_rows(entity)))
        (landing / str(run) / "broken.xlsm").write_bytes(b"not a workbook" + entity.encode())
        ingest_folder(spark, str(landing / str(run)), store, standard_rules(), datetime(2024, 1, 1 + run))
        log, errors = store.read("pipeline_file_details"), store.read("submission_errors")
        assert rows_of(reports.kept(store, "uploads")) == rows_of(audit.upload_report(log))
        assert rows_of(reports.kept(store, "errors")) == rows_of(audit.error_report(errors))
        assert rows_of(reports.kept_stats(store)) == rows_of(audit.upload_stats(store.read("pipeline_runs")))
    assert {r["name"] for r in names.matching(store, "%company%").collect()} == {"Company A", "Company B"}
    assert names.versions(store, "%pany b").count() == 1


# Co-partitioned joins ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_history_over_copartitioned_tables(spark, hot_rows):
    rng = random.Random(6)
    dim = [(k, f"n{k % 7}", START.replace(day=1 + k % 20)) for k in range(40)]
    facts = [(rng.choice([3, 3, 3, rng.randrange(45), None]), rng.choice("ABC"), 2000 + rng.randrange(4), f"{i}", float(i), str(i), False, None, START, i)
             for i in range(600)]
    dim_df = spark.createDataFrame(dim, "entity_key long, natural_key string, valid_from timestamp_ntz")
    facts_df = spark.createDataFrame(facts, "entity_key long, metric_name string, calendar_year int, year_label string, metric_value double, "
                                            "metric_value_formatted string, is_forecast boolean, processing_status string, updated_at timestamp_ntz, submission_id long")
    tables = copart.copartition(facts_df, dim_df, buckets=8, hot_rows=hot_rows)
    try:
        assert tables.hot_dim.count() == (0 if hot_rows > 600 else len({f[0] for f in facts if sum(g[0] == f[0] for g in facts) > 5 and f[0] is not None and f[0] < 40}))
        assert rows_of(copart.metric_history(tables)) == rows_of(history.metric_history(facts_df, dim_df))
        joined = history.version_points(tables.facts, tables.dim.hint("merge"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        tables.drop()
