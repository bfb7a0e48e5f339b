"""Merges by touched keys, late submissions, stage times, hostile workbooks, and grids that span tasks, against plain models."""

import io
import os
import random
import time
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chronograde.operators import audit, dedupe, grid, late, scd2, sheets
from chronograde.operators.rules import standard_rules
from chronograde.plans import catalog, catalog_incremental, warehouse
from chronograde.session import shared_folder
from chronograde.sources import landing
from chronograde.sources.store import Store, Write, stage
from chronograde.streaming import stage_events
from chronograde.streaming.landing_stream import ingest_folder
from conftest import SF, rating_rows, workbook
from test_scd2 import make, row

START = datetime(2024, 1, 1)
VERSION = ["entity_key", "natural_key", "entity_hash_key", "is_current", "valid_from", "valid_to"]


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


# Merges --------------------------------------------------------------------------------------------------------------


def load(store, rows):
    touched = store.touched(rows, "natural_key")
    store.commit(warehouse.merge_touched(store, rows, touched, stage))
    return touched


def test_merge_reads_and_writes_only_touched_buckets(spark, tmp_path):
    rng = random.Random(9)
    rows = [row(i, f"k{rng.randrange(40)}", i, rng.choice("ab"), rng.choice("xyz")) for i in range(300)]
    small = [row(300 + i, k, 400 + i, "c", "y") for i, k in enumerate(["k3", "k3", "brand new"])]
    store, whole = Store(spark, str(tmp_path / "a"), buckets=32), Store(spark, str(tmp_path / "b"), buckets=4)
    load(store, stage(make(spark, rows[:150]), "rows"))
    load(store, stage(make(spark, rows[150:]), "rows"))
    before = store.manifest()["tables"]
    touched = load(store, stage(make(spark, small), "rows"))
    after = store.manifest()["tables"]
    assert len(touched) <= 2 and Store(spark, str(tmp_path / "a")).buckets == 32
    for table in ("dim_entities", "dim_profiles", "dim_ind_profile", "fct_rating_metric"):
        others = [p for p in before[table]["open"] if int(p.rsplit("=", 1)[1]) not in touched]
        assert [p for p in after[table]["open"] if p in before[table]["open"]] == others  # same files, not rewritten copies
        assert len(after[table]["open"]) - len(others) <= len(touched)
        read = {int(f.rsplit("/_bucket=", 1)[1].split("/")[0]) for f in store.read_open(table, touched).inputFiles()}
        assert read <= set(touched)
    load(whole, stage(make(spark, rows + small), "rows"))
    for table, columns in (("dim_entities", VERSION), ("dim_profiles", ["profile_key", "entity_key", "profile_hash_key", "valid_from", "valid_to"]),
                           ("dim_ind_profile", ["industry_profile_key", "profile_key", "valid_from", "valid_to"]),
                           ("fct_rating_metric", ["fact_metric_key", "submission_id", "metric_value"])):
        assert rows_of(store.read(table, "is_open" if table[0] == "f" else "is_current"), *columns) == rows_of(
            whole.read(table, "is_open" if table[0] == "f" else "is_current"), *columns), table
    keys = make(spark, small).select("natural_key")
    assert {n: df.count() for n, df in warehouse.check_touched(store, keys).items()} == dict.fromkeys(
        ["repeated_entities", "repeated_profiles", "repeated_facts", "orphan_profiles", "open_entities_without_profile", "repeated_industries"], 0)
    # a row that breaks a constraint among the touched keys is seen, one among others is not looked for
    e = store.read_open("dim_entities", touched).withColumn("key_bucket", store.bucket("natural_key"))
    store.commit({"dim_entities": Write(e.unionByName(e.filter("natural_key = 'k3'")), "versioned", touched=touched)})
    assert [r["natural_key"] for r in warehouse.check_touched(store, keys)["repeated_entities"].collect()] == ["k3"]
    other = spark.createDataFrame([("no such key",)], "natural_key string")
    assert warehouse.check_touched(store, other)["repeated_entities"].count() == 0


def test_filters_are_no_larger_than_their_rows(spark, tmp_path):
    """The file of a bucket with a few rows has no filter of a megabyte for each looked-up column."""
    store = Store(spark, str(tmp_path), buckets=8)
    rows = make(spark, [row(i, f"k{i}", i, "a", "x") for i in range(40)])
    entities = scd2.entity_history(scd2.annotate_versions(scd2.batch_rows(rows)))
    folder = store.prepare("dim_entities", Write(entities.withColumn("key_bucket", store.bucket("natural_key")), "versioned")).data
    files = list((tmp_path / folder).rglob("*.parquet"))
    assert files and max(f.stat().st_size for f in files) < 500_000


def test_known_contents(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    old = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("checksum"), F.col("id").alias("submission_id"))
    for part in (old.filter("submission_id < 1500"), old.filter("submission_id >= 1500")):
        store.commit({"known_contents": Write(part.withColumn("key_bucket", store.bucket("checksum")), "keyed")})
    batch = spark.range(2900, 3200).select(F.sha2(F.col("id").cast("string"), 256).alias("checksum"))
    batch = batch.unionByName(batch)
    touched = store.touched(batch, "checksum")
    history = store.read_open("known_contents", touched)
    assert store.read_open("known_contents").count() == 3000
    got = dedupe.known_contents(batch, history, store.bucket("checksum"), store.buckets)
    want = batch.distinct().join(old, "checksum", "left_semi")
    assert rows_of(got, "checksum") == rows_of(want, "checksum") and got.count() == 100
    one = batch.limit(1)
    assert len(history.sparkSession.createDataFrame([], history.schema).collect()) == 0
    files = store.read_open("known_contents", store.touched(one, "checksum")).inputFiles()
    assert len({f.rsplit("/_bucket=", 1)[1].split("/")[0] for f in files}) == 1
    nothing = spark.createDataFrame([], "checksum string")
    assert dedupe.known_contents(nothing, history, store.bucket("checksum"), store.buckets).count() == 0
    assert dedupe.known_contents(batch, history.limit(0), store.bucket("checksum"), store.buckets).count() == 0


def test_bloom_filter_drops_most_of_the_history(spark):
    """What reaches the join is close to what matches, not the history."""
    key = lambda df: df.select(F.sha2(F.col("id").cast("string"), 256).alias("checksum"))
    bucket = F.pmod(F.xxhash64("checksum"), F.lit(4)).cast("int")
    filters = {r["bucket"]: r["bits"] for r in dedupe.bloom_filters(key(spark.range(400)), "checksum", bucket, 4).collect()}
    assert len(filters) == 4 and all(len(b) == dedupe.BLOOM_WORDS for b in filters.values())
    words = dedupe.BLOOM_WORDS
    probes = key(spark.range(10_000)).select(bucket.alias("b"), F.array(*[F.pmod(F.xxhash64("checksum", F.lit(i)), F.lit(64 * words)) for i in range(dedupe.PROBES)]).alias("p"))
    passed = [all(filters[r["b"]][p // 64] >> (p % 64) & 1 for p in r["p"]) for r in probes.collect()]
    assert all(passed[:400]) and sum(passed[400:]) < 100


# Late submissions ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("slice_rows", [2, 1 << 16])
def test_any_arrival_order_gives_the_sorted_history(spark, slice_rows):
    rng = random.Random(slice_rows)
    schema = "natural_key string, submitted_at timestamp_ntz, submission_id long, h string, note string"
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}", START + timedelta(days=rng.randrange(30)), i, rng.choice("abc"), f"n{i}") for i in range(400)]
    rng.shuffle(rows)
    args = (["natural_key"], "h", "submitted_at", "submission_id")
    order = ["submitted_at", "submission_id"]
    want = rows_of(scd2.scd2_history(spark.createDataFrame(rows, schema), ["natural_key"], "h", order, "submitted_at"), "*")
    batches = [rows[:150], rows[150:153], rows[153:300], rows[300:]]
    seen = stage(spark.createDataFrame(batches[0], schema), "seen")
    versions = stage(scd2.scd2_history(seen, ["natural_key"], "h", order, "submitted_at"), "versions")
    for i, b in enumerate([*batches[1:], batches[2], []]):  # the last but one comes again, the last is empty
        extra = [(None, START, 9999, "z", "no key"), ("k1", None, 9998, "z", "no time")] if i == 0 else []
        new = spark.createDataFrame(b + b[:1] + extra, schema)
        kept, patched = late.patch_versions(versions, seen, new, *args, rows_per_slice=slice_rows, hot_rows=20)
        if i == 0:
            assert patched.select("natural_key").distinct().count() <= 3  # the keys of three rows
        versions = stage(kept.unionByName(patched), "versions")
        seen = stage(late.observe(seen, new.filter("natural_key IS NOT NULL AND submitted_at IS NOT NULL"), ["natural_key"], "submission_id"), "seen")
    assert rows_of(versions, *scd2.scd2_history(seen, ["natural_key"], "h", order, "submitted_at").columns) == want
    assert seen.count() == 400


# Stage times ---------------------------------------------------------------------------------------------------------

LIMIT = timedelta(hours=2)


def plain_spans(events):
    out = []
    keys = {e[0] for e in events if e[0] is not None}
    for k in keys:
        own = sorted({e[1]: e for e in events if e[0] == k and e[2] is not None}.values(), key=lambda e: (e[2], e[1]))
        opened = None
        for _, _, at, is_start, n in own:
            if opened is not None and at - opened > LIMIT:
                out.append((k, opened, None, None, "timed out"))
                opened = None
            if is_start:
                if opened is not None:
                    out.append((k, opened, None, None, "retried"))
                opened = at
            else:
                out.append((k, opened, at, n, "completed" if opened is not None else "start missing"))
                opened = None
        if opened is not None:
            out.append((k, opened, None, None, "timed out"))
    return sorted(out, key=str)


def some_events():
    rng = random.Random(4)
    events = [(rng.randrange(6), i, START + timedelta(minutes=rng.randrange(3000)), rng.random() < 0.5, rng.randrange(9)) for i in range(300)]
    events += [(0, 900, START, True, None), (0, 901, START, False, 5), (1, 902, START, True, 0), (1, 903, START + LIMIT, False, None)]
    return events + events[:40] + [(None, 904, START, True, 1), (2, 905, None, True, 1)]


SCHEMA = "user_id long, event_id long, at timestamp, is_start boolean, records long"


def test_spans_of_a_table(spark):
    df = spark.createDataFrame(some_events(), SCHEMA)
    for per_slice in (4, 1 << 16):
        got = stage_events.paired(df, ["user_id"], LIMIT, per_slice).select("user_id", "started_at", "completed_at", "records", "state")
        assert sorted(map(tuple, got.collect()), key=str) == plain_spans(some_events())
    assert stage_events.paired(df.limit(0), ["user_id"], LIMIT).count() == 0


def test_spans_of_a_stream(spark, tmp_path):
    """Several micro-batches, out of order by less than the delay, with repeats; events behind the watermark are dropped."""
    events = sorted([e for e in some_events() if e[2] is not None], key=lambda e: e[2] + timedelta(minutes=(e[1] * 37) % 50))
    cuts = [events[i:i + 80] for i in range(0, len(events), 80)]
    end = START + timedelta(days=30)
    too_late = [(3, 999, START, True, 7)]  # arrives after the watermark has passed it
    files = [*cuts, [(-1, -1, end, False, None)], too_late, [(-1, -2, end + timedelta(days=1), False, None)]]
    folder = tmp_path / "events"
    folder.mkdir()
    query = None
    for i, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        source = spark.readStream.schema(SCHEMA).parquet(str(folder))
        query = (stage_events.spans(source, "user_id", LIMIT).writeStream.format("parquet").option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "progress")).outputMode("append").trigger(availableNow=True).start())
        assert query.awaitTermination(300) and query.exception() is None
    got = spark.read.parquet(str(tmp_path / "out")).filter("user_id >= 0").select("user_id", "started_at", "completed_at", "records", "state")
    assert sorted(map(tuple, got.collect()), key=str) == plain_spans([e for e in events if e[0] is not None])


def test_close_events(spark):
    opened = spark.createDataFrame([(1, "2.Extraction", 0, None, START, None), (2, "x", 0, None, START, None)],
                                   "id long, execution_status string, processed_records long, error_message string, started_at timestamp, completed_at timestamp")
    at = START + timedelta(seconds=5)
    updates = spark.createDataFrame([(1, "FAILURE", 3, "bad", START), (1, "SUCCESS", 4, None, at), (7, "SUCCESS", 1, None, at), (None, "y", 1, None, at)],
                                    "id long, execution_status string, processed_records long, error_message string, completed_at timestamp")
    got = sorted(map(tuple, audit.close_events(opened, updates).collect()))
    assert got == [(1, "SUCCESS", 4, None, START, at), (2, "x", 0, None, START, None)]


# Workbooks -----------------------------------------------------------------------------------------------------------


def repacked(content, change=None, **parts):
    """The workbook with other parts; ``change`` edits the text of the sheet."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            text = old.read(name).decode()
            if change and name.endswith("sheet1.xml"):
                text = change(text)
            new.writestr(name, parts.get(name, text))
    return out.getvalue()


def cause(content):
    with pytest.raises(landing.Unreadable) as caught:
        list(landing.sheet_pieces(content, "MASTER"))
    return str(caught.value)


def bomb(megabytes):
    """A sheet of blanks that packs to almost nothing."""
    good = workbook(rating_rows("Company Z"))
    return repacked(good, lambda text: text.replace("<sheetData>", "<sheetData>" + " " * (megabytes << 20)))


def test_causes(monkeypatch):
    good = workbook(rating_rows("Company A"))
    assert "BadZipFile" in cause(b"not a workbook") and "BadZipFile" in cause(None) and "BadZipFile" in cause(good[:200])
    assert cause(workbook([["a"]], sheet="OTHER")) == "no sheet named 'MASTER'"
    assert "ExpatError" in cause(repacked(good, lambda t: t[:-30]))
    assert "shared string 99999 does not exist" in cause(repacked(good, lambda t: t.replace('t="s"><v>0<', 't="s"><v>99999<')))
    assert "is no number" in cause(repacked(good, lambda t: t.replace('t="s"><v>0<', '><v>x<')))
    assert "outside the format" in cause(repacked(good, lambda t: t.replace('r="B1"', 'r="ZZZZ1"')))
    assert "KeyError" in cause(repacked(good, **{"xl/_rels/workbook.xml.rels": "<a/>"}))
    monkeypatch.setattr(landing, "MAX_SHEET", 1 << 20)
    assert "xl/worksheets/sheet1.xml unpacks to" in cause(bomb(4))
    monkeypatch.setattr(landing, "MAX_STRINGS", 10)
    assert "xl/sharedStrings.xml unpacks to" in cause(good)


def test_long_cells_and_missing_references(monkeypatch):
    text = workbook([["a", "b"], [None, 3.0]])
    bare = repacked(text, lambda t: t.replace(' r="A1"', "").replace(' r="B1"', "").replace(' r="B2"', ""))
    assert landing.sheet_cells(bare, "MASTER") == [(0, 0, "a"), (0, 1, "b"), (1, 0, "3")]  # positions follow the order
    monkeypatch.setattr(landing, "MAX_CELL", 5)
    assert "more than 5 characters" in cause(workbook([["abcdefgh"]]))


def test_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(landing, "PIECE_CELLS", 100)
    monkeypatch.setattr(landing, "_CHUNK", 512)
    content = workbook([[f"{r}/{c}" for c in range(7)] for r in range(300)])
    pieces = list(landing.sheet_pieces(content, "MASTER"))
    assert max(map(len, pieces)) <= 100 and [c for p in pieces for c in p] == [(r, c, f"{r}/{c}") for r in range(300) for c in range(7)]


def test_hostile_workbooks_among_good_ones(spark, tmp_path):
    """A workbook that unpacks to 5 GB, one that ends half way, one without the sheet: each names its cause, the good ones load."""
    folder, store = tmp_path / "landing", Store(spark, str(tmp_path / "store"), buckets=4)
    folder.mkdir()
    good = workbook(rating_rows("Company A"))
    huge = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(good)) as old, zipfile.ZipFile(huge, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as new:
        for name in old.namelist():
            if name.endswith("sheet1.xml"):
                with new.open(name, "w", force_zip64=True) as part:
                    blank = b" " * (64 << 20)
                    part.write(b"<?xml version='1.0'?><worksheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><sheetData>")
                    for _ in range(80):
                        part.write(blank)
            else:
                new.writestr(name, old.read(name))
    files = {"01.xlsm": good, "02.xlsm": huge.getvalue(), "03.xlsm": repacked(good, lambda t: t[:-30]),
             "04.xlsm": workbook([["x"]], sheet="OTHER"), "05.xlsm": workbook(rating_rows("Company B"))}
    for i, (name, content) in enumerate(files.items()):
        (folder / name).write_bytes(content)
        os.utime(folder / name, (1_700_000_000 + i,) * 2)
    assert ingest_folder(spark, str(folder), store, standard_rules(), datetime(2024, 1, 1), routed=str(tmp_path / "routes")) == 1
    log = {r["file_name"]: r for r in store.read("pipeline_file_details").collect()}
    assert {n: r["outcome"] for n, r in log.items()} == {
        "01.xlsm": "SUCCESS", "02.xlsm": "FAILURE", "03.xlsm": "FAILURE", "04.xlsm": "FAILURE", "05.xlsm": "SUCCESS"}
    assert "unpacks to 53687" in log["02.xlsm"]["error_message"] and "ExpatError" in log["03.xlsm"]["error_message"]
    assert log["04.xlsm"]["error_message"] == "Workbook or sheet cannot be read: no sheet named 'MASTER'"
    assert log["03.xlsm"]["execution_stage"] == "2.Extraction"
    assert {r["error_message"] for r in store.read("submission_errors").collect()} == {log[n]["error_message"] for n in ("02.xlsm", "03.xlsm", "04.xlsm")}
    # files by route, read back
    routes = spark.read.parquet(str(tmp_path / "routes"))
    assert {r["filename"] for r in routes.filter("route = 'archive'").collect()} == {"01.xlsm", "05.xlsm"}
    assert {r["filename"] for r in spark.read.parquet(str(tmp_path / "routes" / "run_id=1" / "route=dlq")).collect()} == {"02.xlsm", "03.xlsm", "04.xlsm"}
    # stage times and records
    trail = store.read("pipeline_audit_logs").collect()
    assert all(r["started_at"] < r["completed_at"] for r in trail)
    spans = {r["execution_status"]: (r["started_at"], r["completed_at"]) for r in trail}
    assert spans["1.Initial"][0] == datetime(2024, 1, 1) and spans["1.Initial"][1] == spans["2.Extraction"][0]
    assert spans["3.Validation"][1] == spans["4.Load"][0] and spans["4.Load"][1] == spans["5.Transform"][0]
    records = {(r["filename"], r["execution_status"]): r["processed_records"] for r in trail}
    facts = store.read("fct_rating_metric", "is_open").count()
    assert records["01.xlsm", "5.Transform"] + records["05.xlsm", "5.Transform"] == facts > 0
    assert records["02.xlsm", "2.Extraction"] == 0 and records["01.xlsm", "2.Extraction"] == 1
    # a second run: duplicates are found by checksum, routes of the first run stay
    assert ingest_folder(spark, str(folder), store, standard_rules(), datetime(2024, 1, 2), routed=str(tmp_path / "routes")) == 2
    assert {r["outcome"] for r in store.read("pipeline_file_details").filter("run_id = 2 AND file_name IN ('01.xlsm', '05.xlsm')").collect()} == {"SKIPPED"}
    assert spark.read.parquet(str(tmp_path / "routes")).count() == 10


# Grids ---------------------------------------------------------------------------------------------------------------


def test_spanning_grids_equal_documents(spark):
    rng = random.Random(11)
    cells = []
    for f in range(60):
        at = rng.choice([None, 0, 3, 5, 5, 5])
        for r in range(rng.randrange(1, 14)):
            key = "[A]" if r == at or (at is not None and rng.random() < 0.02) else rng.choice(["k1", "k2", " k2 ", "m", None, "n/a", "x y"])
            if key is not None:
                cells.append((f, r, 1, key))
            cells += [(f, r, c, rng.choice(["1", "2023", " n/a ", "v"])) for c in range(2, 2 + rng.randrange(6)) if rng.random() < 0.8]
    df = spark.createDataFrame(cells, "file_id long, row_idx int, col_idx int, value string")
    docs = grid.documents(df, "[A]")
    rows = sheets.sheet_rows(df, "[A]")
    for hot in (1, 1_000_000):  # with and without salting
        placed = sheets.placed_rows(df, "[A]", hot_rows=hot)
        anchored = docs.filter("anchor_row IS NOT NULL")
        assert rows_of(sheets.metadata_rows(placed), "file_id", "row_idx", "key", "vals") == rows_of(grid.metadata_rows(anchored), "file_id", "row_idx", "key", "vals")
        assert rows_of(sheets.metadata_last_wins(placed), "file_id", "key", "vals") == rows_of(grid.metadata_last_wins(anchored), "file_id", "key", "vals")
        assert rows_of(sheets.year_header(placed), "file_id", "pos", "year_label") == rows_of(grid.year_header(anchored), "file_id", "pos", "year_label")
        assert rows_of(sheets.metric_block(placed), "file_id", "row_idx", "metric_name") == rows_of(grid.metric_block(anchored), "file_id", "row_idx", "metric_name")
        points = ["file_id", "metric_name", "year_label", "value", "status"]
        assert rows_of(sheets.metric_points(placed, hot), *points) == rows_of(grid.metric_points(anchored), *points)
        traced = grid.with_lineage(anchored).select("file_id", F.explode("lineage").alias("key", "l")).select(
            "file_id", "key", "l.source_sheet", "l.excel_row", F.size("l.excel_columns").alias("n_values"))
        assert rows_of(sheets.lineage(placed), "file_id", "key", "source_sheet", "excel_row", "n_values") == rows_of(traced, "*")
    errors = sheets.extraction_errors(rows, sheets.bounds(rows), "[A]")
    assert rows_of(errors, "file_id", "error") == rows_of(docs.filter("error IS NOT NULL"), "file_id", "error")
    empty = sheets.placed_rows(df.limit(0), "[A]")
    assert sheets.metadata_rows(empty).count() == sheets.metric_points(empty).count() == 0


@pytest.fixture
def all_partitions(spark):
    """Small test data in as many tasks as large data: no coalescing, no broadcast of what is small only here."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_sheet_of_many_rows_spans_tasks(spark, all_partitions):
    """One file: its rows lie in all partitions, and no aggregate by file gathers rows."""
    n = 20_000
    key = F.when(F.col("id") == 9_000, "[A]").when(F.col("id") == 15_000, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
    rows = spark.range(n).select(F.lit(1).cast("long").alias("file_id"), F.col("id").cast("int").alias("row_idx"), key.alias("key"))
    cells = rows.select("file_id", "row_idx", F.lit(1).alias("col_idx"), F.col("key").alias("value")).unionByName(
        rows.select("file_id", "row_idx", F.lit(2).alias("col_idx"), F.lit("7").alias("value")))
    placed = sheets.placed_rows(cells, "[A]", lambda df, name: stage(df, name), hot_rows=1000)
    parts = placed.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 0.75 * n
    assert sheets.metric_block(placed).count() == 15_000 - 9_001
    assert sheets.metadata_last_wins(placed).count() == 700
    plan = sheets.placed_rows(cells, "[A]")._jdf.queryExecution().executedPlan().toString()
    assert "keys=[file_id" in plan and all("collect_list" not in line for line in plan.split("\n") if "keys=[file_id" in line and "row_idx" not in line.split("functions")[0])


def test_cells_by_file_are_not_shuffled(spark):
    from chronograde.sources import fixtures as fx

    plan = grid.documents(fx.cells(spark, "/root/testdata/sf0.001", by_file=True), fx.FIXTURE_ANCHOR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1 and "Exchange" not in plan.split("Union")[0]


def test_payloads_shuffle_orders_and_items_once(spark):
    from chronograde.sources import fixtures as fx

    plan = fx.payloads(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_spanning_points_join_once(spark):
    df = spark.createDataFrame([(1, 0, 1, "[A]"), (1, 0, 2, "2023")], "file_id long, row_idx int, col_idx int, value string")
    joins = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    placed = sheets.placed_rows(df, "[A]")
    assert joins(sheets.metric_points(placed)) <= joins(placed)


def test_bounds_are_never_broadcast(spark):
    """Bounds that repeat take few bytes on disk however many files there are, so their size must not decide on a broadcast."""
    label = F.explode(F.array(*[F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.lit(v).alias("value"))
                                for r, c, v in [(0, 1, "k"), (0, 2, "v"), (1, 1, "[A]"), (1, 2, "2020"), (2, 1, "m"), (2, 2, "1"), (2, 3, "s")]]))
    cells = spark.range(3000).select(F.col("id").alias("file_id"), label.alias("c")).select("file_id", "c.*")
    placed = sheets.placed_rows(cells, "[A]", stage)
    for rows in (sheets.metadata_rows(placed), sheets.metadata_last_wins(placed), sheets.year_header(placed), sheets.metric_block(placed)):
        frame = rows.groupBy().count()
        assert frame.collect()[0][0] == 3000
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(str(d)).rglob("shuffle_*")}


def settled(spark, before):
    """Shuffle files that stay; Spark deletes a write's files in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    before, store = shuffle_files(spark), Store(spark, str(tmp_path), buckets=4)
    rows = stage(make(spark, [row(i, f"k{i % 9}", i, "a", "x") for i in range(60)]).repartition(3, "natural_key"), "rows")
    assert settled(spark, before) == set() and rows.count() == 60
    before = shuffle_files(spark)
    names = rows.select("natural_key").distinct().withColumn("key_bucket", store.bucket("natural_key"))
    data = scd2.entity_history(scd2.annotate_versions(scd2.batch_rows(rows))).join(names, "natural_key")
    store.prepare("dim_entities", Write(data, "versioned"))
    assert settled(spark, before) == set()


def test_a_merged_batch_leaves_only_the_store(spark):
    """Rows, timelines and profiles that the commits have used up are gone, the store's tables are not."""
    whole = Path(shared_folder(spark).removeprefix("file:"))
    before = set(whole.iterdir()) if whole.exists() else set()
    assert catalog_incremental.merge_touched_facts(spark, SF).count() > 0
    (new,) = [p for p in set(whole.iterdir()) - before if any(p.rglob("*.parquet"))]
    assert (new / "manifests").is_dir()


@pytest.mark.parametrize("name", ["metric_history", "metric_history_nested"])
def test_a_history_keeps_no_parsed_rows(spark, name):
    """The annotated timeline holds all of the parsed rows, so these go; the facts' shuffle ends before the history's begins."""
    whole = Path(shared_folder(spark).removeprefix("file:"))
    before = set(whole.rglob("*.parquet"))
    assert catalog.QUERIES[name](spark, SF).count() > 0
    kept = {p.parent.name.split("-")[0] for p in set(whole.rglob("*.parquet")) - before}
    assert kept == {"annotated", "facts"} | ({"history"} if name.endswith("nested") else set())
