import json

from pyspark.sql import functions as F

from chronograde import schemas
from chronograde.operators import grid, rules, staging
from chronograde.operators.rules import Rule, RuleSet
from chronograde.plans import catalog, warehouse
from conftest import SF, cells_of, rating_rows

ANCHOR = "[Scope Credit Metrics]"


def docs_of(spark, grids):
    return warehouse.extract(spark.createDataFrame(cells_of(grids), schemas.CELLS))


def by_file(df):
    return {r["file_id"]: r for r in df.collect()}


def test_metadata_shapes_lineage_and_gaps(spark):
    got = by_file(docs_of(spark, {1: [
        [None, " Name ", "x", None, " y "],
        [None, "Empty", "n/a"],
        [None, None, "no key"],
        [None, "One", "42"],
        [None, "Name", "last wins"],
        [None, ANCHOR, "2020", None, "2021E"],
        [None, "M", "1", "2", "Locked"],
    ]}))[1]
    assert got["metadata"] == {"Empty": [], "One": ["42"], "Name": ["last wins"]}
    assert got["lineage"]["One"].asDict() == {"source_sheet": "MASTER", "excel_row": 4, "excel_columns": [3]}
    assert got["lineage"]["Name"]["excel_row"] == 5
    assert got["lineage"]["Empty"]["excel_columns"] == []
    # years are compacted, points are not: the second year reads the second value column
    assert got["years"] == ["2020", "2021E"]
    assert [tuple(p) for p in got["metrics"][0]["points"]] == [("2020", "1"), ("2021E", "2")]
    assert got["metrics"][0]["status"] == "Locked"
    assert got["error"] is None


def test_gaps_in_value_rows_shift_left(spark):
    got = by_file(docs_of(spark, {1: [[None, "Vec", "a", None, "c"], [None, ANCHOR, "2020"], [None, "M", "1", "s"]]}))[1]
    assert got["metadata"]["Vec"] == ["a", "c"] and got["lineage"]["Vec"]["excel_columns"] == [3, 4]


def test_metric_block_ends_at_first_blank_name(spark):
    got = by_file(docs_of(spark, {1: [
        [None, "k", "v"], [None, ANCHOR, "2020"], [None, "A", "1", "s"], [None, " n/a ", "2", "s"], [None, "B", "3", "s"],
    ], 2: [
        [None, "k", "v"], [None, ANCHOR, "2020"], [None, "A", None, "s"], [], [None, "B", "3", "s"],
    ]}))
    assert [m["name"] for m in got[1]["metrics"]] == ["A"]
    assert [m["name"] for m in got[2]["metrics"]] == ["A"]
    assert got[2]["metrics"][0]["points"][0]["value"] is None


def test_first_anchor_counts_and_must_be_exact(spark):
    got = by_file(docs_of(spark, {
        1: [[None, "k", "v"], [None, f" {ANCHOR}", "1999"], [None, ANCHOR, "2020"], [None, ANCHOR, "2021"]],
        2: [[None, f"{ANCHOR} ", "2020"]], 3: [[None, ANCHOR, "2020"]], 4: [[None, "k"], [None, ANCHOR, "na"]],
        5: [[None, "k"], [None, ANCHOR, "2020"], [None, "M", "1"]],
    }))
    assert got[1]["anchor_row"] == 2 and got[1]["years"] == ["2020"]
    assert "not found" in got[2]["error"]
    assert "Anchor" in got[3]["error"] and "Years" in got[4]["error"] and "Status" in got[5]["error"]


def test_payload_round_trip(spark):
    docs = docs_of(spark, {1: rating_rows(Country_of_origin='Quote " and \\ slash')})
    checked = staging.payload_json(rules.validate(docs, rules.standard_rules()))
    row = checked.first()
    payload = json.loads(row["parsed_data"])
    assert payload["metadata"]["Country of origin"] == 'Quote " and \\ slash'
    assert payload["metadata"]["Sector/company-specific factors (2)"] is None
    assert payload["metadata"]["Rating methodologies applied"] == ["Chemicals Rating Methodology", "General Corporate Rating Methodology"]
    assert payload["metadata"]["Industry risk"] == [
        {"sector": "Capital Goods", "Industry weight": "40%", "Industry risk score": "BBB"},
        {"sector": "Media", "Industry weight": "60%", "Industry risk score": "A"},
    ]
    assert "Industry weight" not in payload["metadata"]
    metrics = payload["scopeCreditMetrics"]
    assert metrics["years"] == ["2022", "2023", "2024", "2025E"]
    assert metrics["metrics"]["Cover"] == {"2022": "1", "2023": "2", "2024": "3", "2025E": "4", "status": "Locked"}
    assert json.loads(row["lineage_trace"])["Rated entity"] == {"source_sheet": "MASTER", "excel_row": 1, "excel_columns": [3]}


# --- rules ---------------------------------------------------------------------------------------

UNIT_RULES = RuleSet((
    Rule("Rated entity", required=True),
    Rule("Country of origin", required=True, allowed=["Germany", "UK", "USA"]),
    Rule("Industry risk", default="Unknown Sector"),
))


def errors_of(spark, metadata, rule_set):
    schema = "file_id int, metadata map<string,array<string>>, metric_rows array<struct<key:string>>"
    df = spark.createDataFrame([(1, metadata, [])], schema)
    return rules.validate(df, rule_set).first()


def test_boundaries(spark):
    from dataclasses import replace

    unit = replace(UNIT_RULES, allocation_total=None)
    assert errors_of(spark, {"Rated entity": ["ACME"], "Country of origin": ["Germany"]}, unit)["errors"] == []
    assert errors_of(spark, {"Country of origin": ["Germany"]}, unit)["errors"] == ["Missing mandatory field: 'Rated entity'"]
    assert errors_of(spark, {"Rated entity": ["ACME"], "Country of origin": ["Mars", "UK", "Moon"]}, unit)["errors"] == [
        "Value violation on 'Country of origin': Element 'Mars' is out of bounds.",
        "Value violation on 'Country of origin': Element 'Moon' is out of bounds.",
    ]


def test_allocation(spark):
    base = {"Rated entity": ["ACME"], "Country of origin": ["UK"]}
    vec = {"Industry risk": ["Automotive", "Tech"], "Industry risk score": ["3", "2"]}
    row = errors_of(spark, {**base, **vec, "Industry weight": ["0.4", "0.5"]}, UNIT_RULES)
    assert row["errors"] == ["Mathematical allocation error: Combined weights sum to 90.0% instead of 100%."]
    assert not row["is_valid"]
    bad = errors_of(spark, {**base, **vec, "Industry weight": ["x", "y%"]}, UNIT_RULES)
    assert bad["errors"] == ["Failed parsing allocation percentage."] * 2
    both = errors_of(spark, {"Country of origin": ["UK"], **vec, "Industry weight": ["60%", "50%"]}, UNIT_RULES)
    assert "; ".join(both["errors"]) == (
        "Missing mandatory field: 'Rated entity'; "
        "Mathematical allocation error: Combined weights sum to 110.0% instead of 100%."
    )


def test_padding(spark):
    base = {"Rated entity": ["ACME"], "Country of origin": ["UK"]}
    row = errors_of(spark, {**base, "Industry weight": ["100"], "Industry risk score": ["A", "B"]}, UNIT_RULES)
    assert [tuple(i) for i in row["industries"]] == [("Unknown Sector", "100%", "A"), ("Unknown Sector", "0%", "B")]
    full = rules.standard_rules()
    row = errors_of(spark, {"Industry risk": ["Media", "Media"], "Industry weight": ["100"]}, full)
    assert [tuple(i) for i in row["industries"]] == [("Media", "100%", ""), ("Media", "0", "")]


def test_optional_checks_are_off_by_default(spark):
    from dataclasses import replace

    meta = {"Rated entity": ["A"], "Country of origin": ["UK"], "Industry weight": ["100"], "Industry risk": ["a", "b"]}
    checks = replace(
        UNIT_RULES, rules=(*UNIT_RULES.rules, Rule("Industry weight", value_range=(0, 1))), expected_rows=6,
        optional_checks=frozenset({"range", "equal_lengths", "expected_rows", "type"}),
    )
    kinds = {e.split()[0] for e in errors_of(spark, meta, checks)["errors"]}
    assert kinds == {"Range", "Unequal", "Metric", "Type"}
    assert errors_of(spark, meta, replace(checks, optional_checks=frozenset()))["errors"] == []


def test_load_rules(tmp_path):
    assert rules.load_rules(tmp_path / "none.json").rules == ()
    file = tmp_path / "rules.json"
    file.write_text(json.dumps({
        "extraction_meta": {"anchors": [{"name": "A", "required": True, "allowed_values": ["x"]}, {"name": "W", "range": ["0", "1"], "default": "0"}]},
        "cross_validation": [{"rule_type": "equal_lengths", "fields": ["A", "W"]}],
        "tables": [{"expected_rows": 6}],
    }))
    loaded = rules.load_rules(file)
    assert loaded.rules[0] == Rule("A", True, ["x"]) and loaded.rules[1].value_range == (0.0, 1.0)
    assert loaded.equal_lengths == ("A", "W") and loaded.expected_rows == 6


def test_standard_rules_domains():
    by_name = {r.name: r for r in rules.standard_rules().rules}
    assert len(by_name) == 24
    sizes = {n: len(by_name[n].allowed) for n in ("CorporateSector", "Rating methodologies applied", "Industry risk",
             "Industry risk score", "Reporting Currency/Units", "Country of origin", "End of business year", "Leverage", "Liquidity")}
    assert list(sizes.values()) == [17, 16, 47, 7, 28, 39, 12, 21, 9]


def test_assembled_payload_has_years_and_metrics(spark):
    """The payload is the metadata and the metric matrix, not the metadata alone."""
    docs = docs_of(spark, {1: [
        [None, "b", "x", "y"], [None, 'a "q"', None], [None, "c", "1"], [None, ANCHOR, "2020", "2021E"],
        [None, "M", "1.5", "n/a", "Locked"], [None, "N", None, "2", None, ""],
    ], 2: [[None, "k", "v"], [None, ANCHOR, "2020"]]})
    texts = {r[0]: r[1] for r in docs.select("file_id", grid.document_json(F.col("metadata"), F.col("years"), F.col("metrics"))).collect()}
    assert json.loads(texts[1]) == {
        "metadata": {"b": ["x", "y"], 'a "q"': None, "c": "1"},
        "scopeCreditMetrics": {"years": ["2020", "2021E"], "metrics": {
            "M": {"2020": "1.5", "2021E": None, "status": "Locked"}, "N": {"2020": None, "2021E": "2", "status": None}}},
    }
    assert json.loads(texts[2]) == {"metadata": {"k": "v"}, "scopeCreditMetrics": {"years": ["2020"], "metrics": {}}}


def test_assembled_payload_query_is_the_whole_document(spark):
    first = catalog.assemble_payload(spark, SF).first()
    whole = json.loads(first["payload_json"])
    assert whole["metadata"] == json.loads(first["metadata_json"]) and len(whole["scopeCreditMetrics"]["years"]) == 7


def test_payload_texts_are_made_once(spark):
    """A document's metadata text is one expression of the plan, not repeated for its length and its test for being empty."""
    docs = docs_of(spark, {1: [[None, "k", "v"], [None, ANCHOR, "2020"], [None, "M", "1", "s"]]}).withColumn(
        "industries", F.array().cast("array<struct<sector:string,weight:string,score:string>>"))
    document = staging.payload_json(docs).select("parsed_data")
    assert document._jdf.queryExecution().analyzed().toString().count("map_entries(") == 1
    assert document.first()[0] == '{"metadata":{"k":"v","Industry risk":[]},"scopeCreditMetrics":{"years":["2020"],"metrics":{"M":{"2020":"1","status":"s"}}}}'


def test_repeated_years_and_names_last_wins(spark):
    docs = docs_of(spark, {1: [[None, "k", "v"], [None, ANCHOR, "2020", "2021", "2020"],
                               [None, "M", "1", "2", "3", "s"], [None, "N", "4", "5", "6", "t"], [None, "M", "7", "8", "9", "u"]]})
    assert docs.select(grid.metrics_json(F.col("years"), F.col("metrics"))).first()[0] == (
        '{"years":["2020","2021","2020"],"metrics":{"N":{"2021":"5","2020":"6","status":"t"},"M":{"2021":"8","2020":"9","status":"u"}}}')
