"""Tables in parts, the row index, and models refreshed by part."""

from collections import Counter
from functools import reduce
from uuid import uuid4

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.plans.load import Targets, load_batch
from divtide.plans.models import AuditError, ModelTables, build_models, dimension, refresh_models, staging, summary, trends
from divtide.sources.history import append_history, read_history
from divtide.sources.pages import read_pages
from divtide.sources.parts import TIER, PartTable
from divtide.sources.row_index import index_batch, row_hash, row_index, rows_not_held
from divtide.sources.warehouse import create_database, create_raw_table, read_raw
from tests.test_ingest import bag, dividend, frame, land, page

PAIRS = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / "warehouse"))
    return name


def pairs(spark, *rows):
    return spark.createDataFrame(rows, PAIRS)


def held(table, **which):
    return sorted(map(tuple, table.read(**which).collect()), key=repr)


def test_replace_writes_touched_parts_only(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=8)
    assert held(table) == [] and table.build() is None
    rows = [(f"k{i}", i) for i in range(40)] + [(None, 0)]
    first = table.replace(pairs(spark, *rows))
    new = pairs(spark, ("k1", 100))
    [part] = touched = table.touched(new)
    others = table.read([part]).where("key <> 'k1' OR key IS NULL")
    second = table.replace(others.unionByName(new), touched)
    third = table.replace(table.read([part]).where("key <> 'k1'"), touched, {"why": "gone"})
    assert second.changed(first) == third.changed(second) == [part]
    for p in set(range(8)) - {part}:
        assert third.folders.get(p) == first.folders.get(p)
    # Readers one and two builds behind still read theirs.
    assert held(table, build=first) == sorted(rows, key=repr)
    assert held(table, build=table.build(2)) == sorted([("k1", 100) if r == ("k1", 1) else r for r in rows], key=repr)
    assert ("k1", 100) not in held(table) and table.build().notes == {"why": "gone"}
    with pytest.raises(ValueError):
        table.replace(pairs(spark, *rows), touched)


def test_only_folders_asked_for_are_read(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=8)
    table.replace(pairs(spark, *[(f"k{i}", i) for i in range(40)]))
    files = table.read([2, 5]).inputFiles()
    assert files and all("part=2/" in f or "part=5/" in f for f in files)


def test_all_rows_can_be_dealt_anew(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=8)
    rows = sorted(((f"k{i}", i) for i in range(40)), key=repr)
    first = table.replace(pairs(spark, *rows))
    table.deal(3)
    with pytest.raises(ValueError):
        table.replace(pairs(spark), [1])
    second = table.replace(table.read())
    assert held(table) == rows and set(second.folders) <= {0, 1, 2} and second.changed(first) == [0, 1, 2]
    assert PartTable(spark, table.root, PAIRS, ["key"], parts=8).parts == 3


def test_append_merges_by_size_class(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=1)
    n = TIER * 2 + 3
    for i in range(n):
        build = table.append(pairs(spark, ("k", i)))
    assert [level for _, level in build.folders[0]] == [1, 1, 0, 0, 0]
    assert held(table) == sorted((("k", i) for i in range(n)), key=repr)
    empty = table.append(pairs(spark))
    assert empty.folders == build.folders


def test_clean_keeps_what_builds_name(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=4)
    first = table.replace(pairs(spark, *[(f"k{i}", i) for i in range(20)]))
    new = pairs(spark, ("k1", 100))
    table.replace(new, table.touched(new))
    before = held(table)
    table.clean(3600)
    assert table.numbers() == [1, 2] and len(held(table, build=first)) == 20
    table.clean(-60)
    assert table.numbers() == [2] and held(table) == before
    with pytest.raises(Exception):  # noqa: B017
        held(table, build=first)


def test_second_writer_fails(spark, tmp_path, monkeypatch):
    one = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=2)
    one.replace(pairs(spark, ("a", 1)))
    stale = one.build()
    one.replace(pairs(spark, ("a", 2)))
    other = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=2)
    monkeypatch.setattr(other, "build", lambda number=None: stale)
    with pytest.raises(FileExistsError):
        other.replace(pairs(spark, ("a", 3)))
    assert held(one) == [("a", 2)]


def test_published_build_is_switched_whole(spark, tmp_path, database):
    table = PartTable(spark, str(tmp_path / "t"), PAIRS, ["key"], parts=4)
    name = f"{database}.shown"
    spark.range(1).write.saveAsTable(name)  # of an earlier form, which makes room
    first = table.replace(pairs(spark, *[(f"k{i}", i) for i in range(20)]))
    shown = table.publish(name)
    assert shown.columns == PAIRS.names and shown.count() == 20
    table.replace(pairs(spark), [0, 1, 2, 3])
    assert spark.table(name).count() == 20  # until it is published
    assert table.publish(name).count() == 0
    assert shown.count() == 20 and table.read(build=first).count() == 20
    table.clean(-60)
    table.publish(name)
    assert {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == {"shown", "shown__2"}


def index_of(spark, tmp_path, parts=16):
    return row_index(spark, str(tmp_path / "index"), str(tmp_path / "history"), parts)


def test_new_rows_by_the_index(spark, tmp_path):
    history = str(tmp_path / "history")
    stored = frame(spark, dividend("1"), dividend("2", ticker=None), dividend("3", currency=""), dividend(None))
    append_history(stored, history, "a")
    index = index_of(spark, tmp_path)  # made from what is there
    batch = frame(
        spark,
        *[dividend("1"), dividend("2", ticker=None), dividend("3", currency=""), dividend(None)],
        *[dividend("2", ticker=""), dividend("3"), dividend("4"), dividend("4"), dividend("1", ticker="NEW")],
    )
    new = rows_not_held(batch, index, history, "b")
    assert Counter((r["id"], r["ticker"], r["currency"]) for r in new.collect()) == Counter(
        [("2", "", None), ("3", "ABC", None), ("4", "ABC", None), ("1", "NEW", None)]
    )
    # A batch does not stand in its own way, and what it stored before counts for others.
    assert bag(rows_not_held(stored, index, history, "a")) == bag(stored)
    append_history(new, history, "b")
    index_batch(index, new, "b")
    assert rows_not_held(batch, index, history, "c").count() == 0
    assert rows_not_held(frame(spark), index, history, "c").count() == 0


def test_hits_are_confirmed_on_all_columns(spark, tmp_path):
    """Entries whose rows the history does not hold, by chance or after a repeat, decide nothing."""
    history = str(tmp_path / "history")
    append_history(frame(spark, dividend("1")), history, "a")
    index = index_of(spark, tmp_path)
    index_batch(index, frame(spark, dividend("2"), dividend("3")), "a")
    assert [r["id"] for r in rows_not_held(frame(spark, dividend("1"), dividend("2")), index, history, "b").collect()] == ["2"]


def test_only_parts_of_the_batch_are_read(spark, tmp_path):
    history = str(tmp_path / "history")
    for batch in "abc":
        append_history(frame(spark, *[dividend(f"{batch}{i}") for i in range(50)]), history, batch)
    index = index_of(spark, tmp_path)
    rows = frame(spark, dividend("b7"), dividend("b8"))
    touched = index.touched(rows.select(row_hash().alias("row_hash")))
    assert len(touched) <= 2
    files = rows_not_held(rows, index, history, "d").inputFiles()
    # Of the history, only the batch that the index names.
    assert files and all("ingest_batch=b/" in f for f in files)
    assert all(any(f"part={p}/" in f for p in touched) for f in index.read(touched).inputFiles())


def test_ledger_counts_without_the_history(spark, tmp_path, database):
    root = tmp_path / "out"
    to = Targets(f"{root}/history", f"{root}/rejects", f"{database}.dividends", ledger=f"{root}/ledger")
    create_raw_table(spark, to.table, by_batch=True)
    for name, n in (("a", 2), ("b", 3), ("a2", 1)):
        land(tmp_path / name, "p", page(*[dividend(f"{name}{i}") for i in range(n)]))
    load = lambda name, batch: load_batch(read_pages(spark, str(tmp_path / name)), to, batch)
    assert (load("a", "a")["rows_before"], load("b", "b")["rows_before"]) == (0, 2)
    again = load("a2", "a")
    assert (again["rows_before"], again["rows"], again["rows_after"]) == (3, 1, 4)
    assert read_history(spark, to.history).count() == 4


def test_failed_pages_of_no_run_are_skipped(spark, tmp_path, database):
    """Whether walks are kept or not; a page that does not say how its request ended is good."""
    pages = [{**page(dividend(str(s))), "http_status": s} for s in (200, 302, 399, 400, 404, 500)] + [page(dividend("none"))]
    land(tmp_path / "in", "a", *pages)
    for walks in (None, str(tmp_path / "walks")):
        root = tmp_path / f"out{walks is None}"
        to = Targets(f"{root}/history", f"{root}/rejects", f"{database}.d{walks is None}", walks=walks)
        create_raw_table(spark, to.table, by_batch=True)
        counts = load_batch(read_pages(spark, str(tmp_path / "in")), to, "a")
        assert (counts["pages"], counts["rows"]) == (7, 4)
        assert sorted(r["id"] for r in read_raw(spark, to.table).collect()) == ["200", "302", "399", "none"]


def test_repeated_walks_forget_what_the_earlier_try_said(spark, tmp_path, database):
    """A stop that only the earlier try of a batch had does not hold a later batch back."""

    def on(run, seq, next_url="more"):
        return {**page(dividend(f"{run}{seq}")), "run": run, "seq": seq, "http_status": 200, "next_url": next_url}

    land(tmp_path / "1", "p", on("a", 0, None), on("b", 0, None))
    land(tmp_path / "1again", "p", on("a", 0))
    land(tmp_path / "2", "p", on("a", 1), on("b", 1))
    root = tmp_path / "out"
    to = Targets(f"{root}/history", f"{root}/rejects", f"{database}.dividends", walks=f"{root}/walks")
    create_raw_table(spark, to.table, by_batch=True)
    for folder, batch in (("1", "1"), ("1again", "1"), ("2", "2")):
        load_batch(read_pages(spark, str(tmp_path / folder)), to, batch)
    assert sorted(r["id"] for r in read_raw(spark, to.table).collect()) == ["a0", "a1", "b1"]


def models_of(spark, raw, day):
    dim = dimension(staging(raw, day))
    return {"dim_dividends": dim, "fct_dividend_summary": summary(dim), "fct_dividend_trends": trends(dim)}


def rows_of(df):
    return Counter(map(repr, map(tuple, df.drop("loaded_at").collect())))


AMOUNTS = st.sampled_from(["0.25", "0.1", "0.2", "1e12", "NaN", "Infinity", "1e-30", "x", None])
ROWS = st.tuples(st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, "1", "2", "3"]), AMOUNTS, st.sampled_from(["A", "B", None]))
BATCHES = st.lists(st.lists(ROWS, min_size=1, max_size=5), min_size=1, max_size=3)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(BATCHES)
def test_refreshed_models_equal_a_rebuild(spark, tmp_path, parts):
    """Totals by differences and groups computed anew, on amounts that decimals hold and that they do not."""
    name = f"t_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / name))
    frames = []
    for p in parts:
        rows = [dividend(i, record_date=d, cash_amount=c, ticker=t, pay_date=f"202{d or 0}-01-01") for i, d, c, t in p]
        frames.append(frame(spark, *rows))
        models = refresh_models(frames[-1], name, "2022-06-01")
    expected = models_of(spark, reduce(DataFrame.unionByName, frames), "2022-06-01")
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    for relation, df in expected.items():
        assert rows_of(rounded(models[relation])) == rows_of(rounded(df)), relation


def test_refresh_writes_touched_parts_only(spark, database):
    ids = [f"id{i}" for i in range(200)]
    rows = [dividend(i, pay_date=f"2024-0{1 + n % 9}-01", ticker=f"T{n % 5}") for n, i in enumerate(ids)]
    refresh_models(frame(spark, *rows), database, "2024-01-15")
    tables = ModelTables(spark, database)
    before = {t: getattr(tables, t).build() for t in ("latest", "stg", "dim", "totals", "groups")}
    reader = tables.dim.read()
    models = refresh_models(frame(spark, dividend("id7", pay_date="2024-01-01", cash_amount="9")), database, "2024-01-15")
    for t in ("latest", "stg", "dim"):
        assert len(getattr(tables, t).build().changed(before[t])) == 1, t
    assert 1 <= len(tables.totals.build().changed(before["totals"])) <= 2
    assert reader.count() == 200 and models["dim_dividends"].where("cash_amount = 9").count() == 1
    # On another day, the parts with rows whose stage moved; the latest rows stay where they are.
    latest = tables.latest.build()
    moved = refresh_models(frame(spark), database, "2024-02-01")["dim_dividends"]
    assert 0 < len(tables.stg.build().changed(tables.stg.build(2)))
    assert tables.latest.build().folders == latest.folders
    assert moved.where("dividend_lifecycle_stage = 'completed'").count() == moved.where("pay_date <= '2024-02-01'").count() > 0


def test_failed_refresh_is_taken_up_by_the_next(spark, database, monkeypatch):
    rows = [dividend(f"id{i}", ticker="T", pay_date="2024-01-01") for i in range(20)]
    refresh_models(frame(spark, *rows), database, "2024-06-01")
    changed = frame(spark, dividend("id3", ticker="U", pay_date="2024-01-01"))
    with monkeypatch.context() as broken:
        broken.setattr(ModelTables, "refresh_totals", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_models(changed, database, "2024-06-01")
    assert spark.table(f"{database}.dim_dividends").where("ticker = 'U'").count() == 0
    models = refresh_models(frame(spark), database, "2024-06-01")
    assert models["dim_dividends"].where("ticker = 'U'").count() == 1
    got = {r["ticker"]: r["total_cashes_current_year"] for r in models["fct_dividend_trends"].collect()}
    assert got == {"T": 19 * 1.25, "U": 1.25}
    assert models["fct_dividend_summary"].where("ticker = 'U'").count() == 1


def test_audit_keeps_readers_on_the_last_good_build(spark, database):
    good = dividend("1", pay_date="2024-01-01", ex_dividend_date="2024-01-01")
    refresh_models(frame(spark, good), database, "2024-06-01", audit=True)
    bad = frame(spark, {**good, "id": "2", "ticker": None}, {**good, "id": "3", "cash_amount": "#"})
    with pytest.raises(AuditError) as error:
        refresh_models(bad, database, "2024-06-01", audit=True)
    assert error.value.failures == {"ticker": 1, "cash_amount": 1}
    shown = lambda: sorted(r["dividend_id"] for r in spark.table(f"{database}.dim_dividends").collect())
    assert shown() == ["1"]
    # Other parts do not hide what failed; a later version of the rows mends it.
    with pytest.raises(AuditError):
        refresh_models(frame(spark, {**good, "id": "4"}), database, "2024-06-01", audit=True)
    assert shown() == ["1"]
    # Versions without a record date tie; then the greater amount, as text, is the later one.
    mended = [{**good, "id": i, "cash_amount": "9"} for i in "23"]
    models = refresh_models(frame(spark, *mended), database, "2024-06-01", audit=True)
    assert shown() == ["1", "2", "3", "4"]
    assert models["fct_dividend_summary"].count() == 4
    with pytest.raises(AuditError):
        build_models(bad, database, "2024-06-01", audit=True)
    assert shown() == ["1", "2", "3", "4"]


def test_rows_read_from_parts_are_written_where_they_lie(spark, tmp_path):
    """Rows of a table that is dealt alike need no shuffle; those of parts that are not replaced still fail."""
    rows = [(f"k{i}", i) for i in range(200)] + [(None, 0)]
    tables = [PartTable(spark, str(tmp_path / name), PAIRS, ["key"], parts=8) for name in "ab"]
    first = tables[0].replace(pairs(spark, *rows))
    store, shuffles = spark.sparkContext.statusTracker(), f"shuffles-{uuid4().hex}"
    spark.sparkContext.setJobGroup(shuffles, "")
    try:
        made = tables[1].replace(tables[0].read().withColumn("n", F.col("n") + 1), in_parts=True)
        stages = [len(store.getJobInfo(job).stageIds) for job in store.getJobIdsForGroup(shuffles)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages == [1]
    assert held(tables[1]) == sorted([(k, n + 1) for k, n in rows], key=repr) and set(made.folders) == set(first.folders)
    for p in made.folders:
        assert [k for k, _ in held(tables[1], parts=[p])] == [k for k, _ in held(tables[0], parts=[p])]
    with pytest.raises(ValueError):
        tables[1].replace(tables[0].read(), [0], in_parts=True)


def test_changes_are_joined_once_for_totals_and_groups(spark, database):
    refresh_models(frame(spark, *[dividend(f"id{i}", pay_date="2024-01-01") for i in range(20)]), database, "2024-06-01")
    tables = ModelTables(spark, database)
    since = tables.latest.build().number
    tables.merge(frame(spark, dividend("id3", pay_date="2025-01-01", cash_amount="4")))
    found = tables.changed_groups(since)
    assert tables.changed_groups(since) is found
    assert sorted((r["pay_year"], float(r["amount"]), r["n_rows"]) for r in found.collect()) == [(2024, -1.25, -1), (2025, 4.0, 1)]
