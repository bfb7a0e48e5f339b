"""History semantics against a row-at-a-time model, merges, quirks and skew."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronograde.functions.timeline import Timeline
from chronograde.operators import dedupe, facts, integrity, scd2
from chronograde.sources.store import stage

SCHEMA = (
    "submission_id long, natural_key string, submitted_at timestamp_ntz, entity_hash_key string, profile_hash_key string, "
    "industry_aggregate_hash_key string, industries array<struct<sector:string,weight:double,score:string>>, "
    "metrics map<string,map<string,string>>"
)
ATTRS = [c for c in [*scd2.ENTITY_COLUMNS, *scd2.PROFILE_COLUMNS] if c != "natural_key"]
START = datetime(2024, 1, 1)
SMALL = Timeline(["natural_key"], ["load_rank", "submitted_at", "submission_id"], rows_per_slice=3)


def make(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("entity_hash_key")) for c in ATTRS})


def annotate(spark, rows, timeline):
    return stage(scd2.annotate_versions(scd2.batch_rows(stage(make(spark, rows), "rows")), timeline), "annotated")


def row(i, key, day, entity, profile, metrics=None):
    vector = [(f"s{profile}", 60.0, "A"), (f"s{profile}", 60.0, "A"), ("t", 40.0, None)]
    return (i, key, START + timedelta(days=day), entity, profile, f"agg{profile}", vector, metrics or {"m": {"2024": str(i), "status": "Locked"}})


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(3)
    return [
        row(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", rng.randrange(60), rng.choice("ab"), rng.choice("xyz"))
        for i in range(600)
    ]


def model(rows):
    """Sequential load: compare with the current row, expire, insert."""
    entities, profiles, fact = {}, {}, {}
    current_e, current_p = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        sid, key, at, eh, ph = r[:5]
        e = current_e.get(key)
        if e is None or entities[e][1] != eh:
            if e is not None:
                entities[e][3] = at
            entities[sid] = [key, eh, at, None]
            if key in current_p:
                profiles[current_p.pop(key)][4] = at
            current_e[key] = sid
        p = current_p.get(key)
        if p is None or profiles[p][2] != ph:
            if p is not None:
                profiles[p][4] = at
            profiles[sid] = [key, current_e[key], ph, at, None]
            current_p[key] = sid
        for m, years in r[7].items():
            for y, v in years.items():
                if y != "status":
                    fact[(current_e[key], current_p[key], m, int(y))] = v
    return entities, profiles, fact


def check_against_model(rows, entities, profiles, upserted):
    want_e, want_p, want_f = model(rows)
    got_e = {r["entity_key"]: [r["natural_key"], r["entity_hash_key"], r["valid_from"], r["valid_to"]] for r in entities.collect()}
    got_p = {r["profile_key"]: [r["natural_key"], r["entity_key"], r["profile_hash_key"], r["valid_from"], r["valid_to"]] for r in profiles.collect()}
    got_f = {(r["entity_key"], r["profile_key"], r["metric_name"], r["calendar_year"]): r["metric_value"] for r in upserted.collect()}
    assert got_e == want_e and got_p == want_p
    assert {k: int(v) for k, v in got_f.items()} == {k: int(v) for k, v in want_f.items()}


@pytest.mark.parametrize("timeline", [scd2.LOAD_ORDER, SMALL], ids=["whole", "sliced"])
def test_batch_equals_sequential_load(spark, random_rows, timeline):
    annotated = annotate(spark, random_rows, timeline)
    check_against_model(
        random_rows, scd2.entity_history(annotated, timeline), scd2.profile_history(annotated, timeline),
        facts.upsert_facts(facts.fact_rows(annotated)),
    )
    industries = scd2.industry_history(annotated, timeline)
    assert integrity.repeated_keys(industries, ["profile_key", "sector_name", "industry_hash_key"]).count() == 0
    assert industries.count() == 2 * scd2.profile_history(annotated, timeline).count()


@pytest.mark.parametrize("timeline", [scd2.LOAD_ORDER, SMALL], ids=["whole", "sliced"])
def test_two_loads_equal_one(spark, random_rows, timeline):
    cut = START + timedelta(days=30)
    early, late = [r for r in random_rows if r[2] < cut], [r for r in random_rows if r[2] >= cut]
    first = annotate(spark, early, timeline)
    e0, p0 = stage(scd2.entity_history(first, timeline), "e"), stage(scd2.profile_history(first, timeline), "p")
    i0, f0 = stage(scd2.industry_history(first, timeline), "i"), stage(facts.upsert_facts(facts.fact_rows(first)), "f")
    merged = scd2.merge_dimensions(make(spark, late), e0, p0, i0, timeline, settle=lambda df: stage(df, "merged"))
    e1 = e0.filter("NOT is_current").unionByName(merged["dim_entities"])
    p1 = p0.filter("NOT is_current").unionByName(merged["dim_profiles"])
    check_against_model(random_rows, e1, p1, facts.upsert_facts(facts.fact_rows(merged["annotated"]), f0))
    i1 = i0.filter("NOT is_current").unionByName(merged["dim_ind_profile"])
    whole = annotate(spark, random_rows, timeline)
    cols = ["profile_key", "sector_name", "industry_hash_key", "is_current", "valid_from", "valid_to"]
    once = scd2.industry_history(whole, timeline)
    assert sorted(map(str, i1.select(cols).collect())) == sorted(map(str, once.select(cols).collect()))


def test_reload_is_a_no_op(spark):
    rows = [row(1, "a", 0, "x", "p")]
    first = annotate(spark, rows, scd2.LOAD_ORDER)
    e0, p0, i0 = [stage(f(first), "dim") for f in (scd2.entity_history, scd2.profile_history, scd2.industry_history)]
    again = make(spark, [row(2, "a", 1, "x", "p", {"m": {"2024": "9", "status": "Locked"}})])
    merged = scd2.merge_dimensions(again, e0, p0, i0, settle=lambda df: stage(df, "merged"))
    assert [r["entity_key"] for r in merged["dim_entities"].collect()] == [1]
    assert merged["dim_profiles"].filter("is_current").count() == 1
    assert merged["dim_ind_profile"].filter("is_current").count() == 2
    assert merged["annotated"].first()["profile_key"] == 1


def test_return_to_an_earlier_state_is_a_new_version(spark):
    rows = [row(1, "a", 0, "x", "p"), row(2, "a", 1, "y", "p"), row(3, "a", 2, "x", "p")]
    history = scd2.entity_history(scd2.annotate_versions(scd2.batch_rows(make(spark, rows))))
    assert sorted(r["entity_key"] for r in history.collect()) == [1, 2, 3]


def test_children_may_stay_open(spark):
    rows = [row(1, "a", 0, "x", "p"), row(2, "a", 1, "y", "p")]
    annotated = scd2.annotate_versions(scd2.batch_rows(make(spark, rows)))
    closed = {r["profile_key"]: r["is_current"] for r in scd2.profile_history(annotated).collect()}
    left_open = {r["profile_key"]: r["is_current"] for r in scd2.profile_history(annotated, close_children=False).collect()}
    assert closed == {1: False, 2: True} and left_open == {1: True, 2: True}


@pytest.mark.parametrize("change, error", [
    ({"natural_key": "cast(null as string)"}, "Rated entity is missing"),
    ({"industries": "array(named_struct('sector', cast(null as string), 'weight', 1D, 'score', 'A'))"}, "Industry without a sector name"),
    ({"industries": "array(named_struct('sector', 'a', 'weight', cast(null as double), 'score', 'A'))"}, "Industry weight is not a number"),
    ({"industries": "slice(industries, 1, 0)"}, "Warehouse transformer script invocation failure"),
    ({"metrics": "map('m', map('2024', '1', '2024E', '2', 'status', 'x'))"}, "Year label repeated or without digits"),
    ({"metrics": "map('m', map('trend', '1', 'status', 'x'))"}, "Year label repeated or without digits"),
    ({"metrics": "map('m', map('status', 'x'))"}, "Warehouse transformer script invocation failure"),
    ({}, None),
])
def test_transform_errors(spark, change, error):
    df = make(spark, [row(1, "a", 0, "x", "p")])
    for column, expression in change.items():
        df = df.withColumn(column, F.expr(expression))
    assert df.select(scd2.transform_error()).first()[0] == error


def test_payload_projection_with_fallback_and_lists(spark):
    docs = [
        (1, '{"metadata":{"Rated entity":"A","CorporateSector":null,"Rating methodologies applied":["x","y"],"Industry risk":[{"sector":"s","Industry weight":"100%","Industry risk score":"3"}]},"scopeCreditMetrics":{"years":["2024"],"metrics":{"E":{"2024":5000,"2025":null,"status":"Final"}}}}'),
        (2, '{"parsed_data":{"Rated entity":"B","CorporateSector":"Retail"}}'), (3, "not json"),
    ]
    rows = {r["submission_id"]: r for r in scd2.warehouse_rows(
        spark.createDataFrame(docs, "submission_id long, parsed_data string").withColumn("submitted_at", F.lit(START))).collect()}
    assert (rows[1]["natural_key"], rows[1]["sector"], rows[1]["rating_methodologies_applied"]) == ("A", None, '["x","y"]')
    assert rows[1]["metrics"] == {"E": {"2024": "5000", "2025": None, "status": "Final"}}
    assert (rows[2]["natural_key"], rows[2]["sector"], rows[2]["industries"]) == ("B", "Retail", [])
    assert rows[3]["natural_key"] is None


def test_in_batch_outcomes_with_a_hot_content(spark):
    rng = random.Random(5)
    contents = ["hot" if rng.random() < 0.4 else f"c{rng.randrange(60)}" for _ in range(800)]
    verdict = {c: ("failure" if c[-1] in "37" else "success") for c in contents}
    files = spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "ingest_seq long, checksum string")
    verdicts = spark.createDataFrame([(c, v, "3.Validation" if v == "failure" else "5.Transform") for c, v in verdict.items()], "checksum string, verdict string, stage string")
    got = {r["ingest_seq"]: r["outcome"] for r in dedupe.in_batch_outcomes(files, verdicts, hot_rows=20).collect()}
    seen, want = set(), {}
    for i, c in enumerate(contents):
        want[i] = "skipped" if c in seen and verdict[c] == "success" else verdict[c]
        seen.add(c)
    assert got == want


def test_cascade_delete(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "id int, profile_key int")
    gone = spark.createDataFrame([(10,)], "profile_key int")
    assert [r["id"] for r in integrity.cascade_delete(child, gone, "profile_key").collect()] == [3]
