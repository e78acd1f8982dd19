"""Pages, history, staging area, raw table and stream on small written pages."""

import json
from collections import Counter
from functools import reduce
from pathlib import Path
from uuid import uuid4

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.__main__ import main
from divtide.operators.normalize import conform, flatten, strict_union
from divtide.plans.load import Targets, load_batch
from divtide.plans.models import dimension, refresh_after, refresh_models, staging
from divtide.plans.run import run_once
from divtide.schema import BATCH_COLUMN, NOT_NULL_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, TABLE_COLUMNS
from divtide.sources.history import append_history, new_rows, read_batch, read_history
from divtide.sources.pages import (
    FALLBACK_PEOPLE,
    no_rows,
    page_rows,
    people,
    nested_pages,
    read_nested,
    read_pages,
    rejected_pages,
)
from divtide.sources.staging_csv import clear_staging, read_staging, write_staging
from divtide.sources.warehouse import (
    append_raw,
    create_database,
    create_raw_table,
    drop_old_builds,
    read_raw,
    replace_batch,
    replace_table,
    table_location,
)
from divtide.streaming.ingest import ingest_available, start_ingest


few = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def dividend(key, **fields):
    row = dict.fromkeys(RAW_COLUMNS)
    return {**row, "id": key, "ticker": "ABC", "cash_amount": "1.25", **fields}


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def bag(df):
    return Counter(map(tuple, df.select(RAW_COLUMNS).collect()))


def land(folder, name, *pages):
    """Writes pages, given as objects or as text, as lines of one file."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    lines = [p if isinstance(p, str) else json.dumps(p) for p in pages]
    (Path(folder) / f"{name}.json").write_text("\n".join(lines) + "\n")


def page(*rows, **fields):
    return {"status": "OK", "results": list(rows), **fields}


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / "warehouse"))
    return name


def test_page_forms(spark, tmp_path):
    land(
        tmp_path / "in",
        "a",
        page({"id": "1", "cash_amount": 0.25, "frequency": 4, "extra": "x"}),
        page(),
        {"status": "OK"},
        {"status": "OK", "results": None},
        '{"status": "OK", "results": [{"id": "lost"',
        page({"id": "2", "frequency": 4.0, "cash_amount": 1e-05}, {"id": None}),
    )
    pages = read_pages(spark, str(tmp_path / "in"))
    rows = page_rows(pages)
    assert rows.schema == RAW_SCHEMA
    got = {r["id"]: (r["cash_amount"], r["frequency"], r["ticker"]) for r in rows.collect()}
    assert got == {"1": ("0.25", "4", None), "2": ("1e-05", "4.0", None), None: (None, None, None)}
    assert [r["page"] for r in rejected_pages(pages).collect()] == ['{"status": "OK", "results": [{"id": "lost"']


def test_page_spread_over_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(page({"id": "1"}, {"id": "2"}), indent=4))
    rows = page_rows(read_pages(spark, str(tmp_path / "in"), multi_line=True))
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2"]


def test_no_rows_has_the_raw_schema(spark):
    assert no_rows(spark).schema == RAW_SCHEMA and no_rows(spark).count() == 0


def test_conform_casts_adds_and_drops(spark):
    given = spark.createDataFrame([(4, 0.5, "keep?", True)], "frequency int, cash_amount double, note string, id boolean")
    out = conform(given)
    assert out.schema == RAW_SCHEMA
    assert out.first().asDict() == {**dict.fromkeys(RAW_COLUMNS), "frequency": "4", "cash_amount": "0.5", "id": "true"}


def test_flatten_dots_nested_and_keeps_arrays(spark, tmp_path):
    land(tmp_path / "in", "a", page({"id": 7, "a": {"b": {"c": 1.5}, "d.e": "x"}, "list": [{"k": 1}]}))
    form = T._parse_datatype_string("id bigint, a struct<b: struct<c: double>, `d.e`: string>, list array<struct<k: bigint>>")
    land(tmp_path / "in", "b", '{"results": [{"id": ', page({"id": "text"}))
    flat = read_nested(spark, str(tmp_path / "in"), form)
    assert len(rejected_pages(nested_pages(spark, str(tmp_path / "in"), form)).collect()) == 2
    assert dict(flat.dtypes) == {
        "a.b.c": "double",
        "a.d.e": "string",
        "id": "bigint",
        "list": "array<struct<k:bigint>>",
    }
    assert flat.first().asDict() == {"a.b.c": 1.5, "a.d.e": "x", "id": 7, "list": [T.Row(k=1)]}
    assert flatten(flat.select("id")).columns == ["id"]
    with pytest.raises(ValueError, match="a.b"):
        flatten(spark.sql("SELECT 1 AS `a.b`, named_struct('b', 2) AS a"))


def test_strict_union_refuses_other_types(spark):
    text = spark.createDataFrame([("1",)], "id string")
    number = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        strict_union(text, number)
    assert strict_union(text, text).count() == 2


def test_people_and_fallback(spark, tmp_path):
    fallback = people(spark, str(tmp_path / "none"))
    assert [(r["craft"], r["name"]) for r in fallback.collect()] == FALLBACK_PEOPLE
    assert {r["number"] for r in fallback.collect()} == {12}
    land(tmp_path / "broken", "a", "<html>", {"number": 1})
    assert people(spark, str(tmp_path / "broken")).count() == 12
    land(tmp_path / "nobody", "a", {"number": 0, "people": []})
    assert people(spark, str(tmp_path / "nobody")).count() == 0
    land(tmp_path / "in", "a", {"number": 3, "people": [{"craft": "A", "name": "x"}, None]}, {"people": [{"name": "y"}]})
    assert sorted(people(spark, str(tmp_path / "in")).collect(), key=str) == [(3, "A", "x"), (None, None, "y")]


def test_history_append_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "history")
    a, b = frame(spark, dividend("1"), dividend("1")), frame(spark, dividend("1"), dividend(None))
    append_history(a, path)
    append_history(b, path)
    assert bag(read_history(spark, path)) == bag(a) + bag(b)


def test_history_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(frame(spark, dividend("1")), path, "a")
    append_history(frame(spark, dividend("2")), path, "b")
    append_history(frame(spark, dividend("3"), dividend("3")), path, "b")
    assert sorted(r["id"] for r in read_history(spark, path).collect()) == ["1", "3", "3"]
    assert [r["id"] for r in read_batch(spark, path, "a").collect()] == ["1"]
    assert read_batch(spark, path, "none").count() == 0


def test_history_of_other_types(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.createDataFrame([("1", 0.5, 4, "x")], "id string, cash_amount double, frequency int, note string").write.parquet(old)
    append_history(frame(spark, dividend("2")), new)
    rows = {r["id"]: r for r in read_history(spark, old, new).collect()}
    assert (rows["1"]["cash_amount"], rows["1"]["frequency"], rows["1"]["ticker"]) == ("0.5", "4", None)
    assert rows["2"]["cash_amount"] == "1.25"


def test_history_with_mixed_files_in_one_folder(spark, tmp_path):
    """Columns and types of files differ; neither values nor rows are lost."""
    path = str(tmp_path / "history")
    spark.createDataFrame([("1", "USD")], "id string, currency string").write.parquet(path)
    append_history(frame(spark, dividend("2", ticker="ABC")), path)
    rows = {r["id"]: r for r in read_history(spark, path).collect()}
    assert rows["2"]["ticker"] == "ABC" and rows["1"]["ticker"] is None and rows["1"]["currency"] == "USD"
    typed = spark.createDataFrame([("3", 0.5, 4, "x")], "id string, cash_amount double, frequency int, note string")
    typed.write.mode("append").parquet(path)
    rows = {r["id"]: r for r in read_history(spark, path).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["2"]["ticker"] == "ABC" and (rows["3"]["cash_amount"], rows["3"]["frequency"]) == ("0.5", "4")


def test_rejects_of_wrong_form_are_stored(spark, tmp_path, database):
    bad = ['{"results":"oops"}', '{"results":{"id":"9"}}', '{"results":[{"id":"2"},7]}']
    to = targets(tmp_path, database)
    create_raw_table(spark, to.table, by_batch=True)
    land(tmp_path / "in", "a", *bad, '{"results":[{"id":"1"},null]}')
    counts = load_batch(read_pages(spark, str(tmp_path / "in")), to, "b1")
    assert (counts["pages"], counts["rejected_pages"], counts["rows"]) == (4, 3, 1)
    assert sorted(r["page"] for r in spark.read.json(to.rejects).collect()) == sorted(bad)


def test_repeat_without_rows_replaces(spark, tmp_path, database):
    to = targets(tmp_path, database)
    create_raw_table(spark, to.table, by_batch=True)
    land(tmp_path / "in", "a", '{"results":[{"id":"1"}]}', "{cut")
    land(tmp_path / "again", "a", '{"results":[]}')
    load_batch(read_pages(spark, str(tmp_path / "in")), to, "b1")
    assert read_history(spark, to.history).count() == 1 and spark.read.schema("page string").json(to.rejects).count() == 1
    load_batch(read_pages(spark, str(tmp_path / "again")), to, "b1")
    assert read_history(spark, to.history).count() == 0 and read_raw(spark, to.table).count() == 0
    assert spark.read.schema("page string").json(to.rejects).count() == 0


def test_new_rows(spark):
    history = frame(spark, dividend("1"), dividend("1"), dividend(None), dividend("9"))
    batch = frame(
        spark,
        dividend("1"),
        dividend("1", record_date="2024-01-01"),
        dividend("1", record_date="2024-01-01"),
        dividend(None),
        dividend(None, ticker="X"),
        dividend("2"),
    )
    new = new_rows(batch, history)
    assert bag(new) == bag(batch.subtract(history))
    assert new.count() == 3


def test_staging_keeps_awkward_text(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows = frame(
        spark,
        dividend(' padded "quoted", and\nbroken ', ticker="a,b"),
        dividend("back\\slash", ticker="NA", currency="'"),
        dividend(None, ticker=""),
        dict.fromkeys(RAW_COLUMNS),
    )
    write_staging(rows, path)
    expected = rows.withColumn("ticker", F.nullif("ticker", F.lit("")))
    assert bag(read_staging(spark, path)) == bag(expected)
    write_staging(frame(spark, dividend("only")), path)
    assert [r["id"] for r in read_staging(spark, path).collect()] == ["only"]


def test_staging_clear_leaves_the_header(spark, tmp_path):
    path = str(tmp_path / "staging")
    write_staging(frame(spark, dividend("1")), path)
    clear_staging(spark, path)
    (file,) = Path(path).glob("*.csv")
    assert file.read_text() == ",".join(RAW_COLUMNS) + "\n"
    assert read_staging(spark, path).count() == 0


def test_staging_of_fewer_columns(spark, tmp_path):
    path = str(tmp_path / "staging")
    spark.createDataFrame([("1", "x")], "id string, ticker string").write.option("header", True).csv(path)
    staged = read_staging(spark, path, ["id", "ticker"])
    assert staged.columns == RAW_COLUMNS
    assert staged.select("id", "ticker", "pay_date").collect() == [("1", "x", None)]


def test_raw_table_matches_by_name(spark, database):
    table = f"{database}.dividends"
    create_raw_table(spark, table)
    create_raw_table(spark, table)
    rows = frame(spark, {c: c for c in RAW_COLUMNS})
    append_raw(rows, table)
    append_raw(rows, table)
    assert spark.table(table).columns == TABLE_COLUMNS
    assert bag(read_raw(spark, table)) == bag(rows) + bag(rows)


def test_raw_table_replaces_a_batch(spark, database):
    table = f"{database}.dividends"
    create_raw_table(spark, table, by_batch=True)
    replace_batch(frame(spark, {c: c for c in RAW_COLUMNS}), table, "a")
    replace_batch(frame(spark, dividend("1")), table, "b")
    replace_batch(frame(spark, dividend("2")), table, "b")
    assert sorted(r["id"] for r in read_raw(spark, table).collect()) == ["2", "id"]
    assert spark.table(table).columns == [*TABLE_COLUMNS, BATCH_COLUMN]


def test_model_table_is_switched_whole(spark, database):
    table = f"{database}.model"
    first = replace_table(spark.range(3), table)
    assert first.count() == 3
    # The new rows may come from the old ones, and who still reads these is not disturbed.
    second = replace_table(first.where("id > 0"), table)
    assert sorted(r["id"] for r in second.collect()) == [1, 2]
    assert first.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        replace_table(spark.sql("SELECT raise_error('lost') AS id"), table)
    assert spark.table(table).count() == 2
    assert replace_table(spark.range(1).withColumn("more", F.lit("x")), table).columns == ["id", "more"]
    assert spark.table(table).count() == 1
    # Earlier builds, also those before the last, stay until they are old.
    assert first.count() == 3
    current = table_location(spark, table)
    drop_old_builds(spark, current.rsplit("/", 1)[0], current, seconds=-60)
    assert spark.read.parquet(current).count() == 1
    with pytest.raises(Exception):  # noqa: B017
        first.count()


def targets(tmp_path, database, **options):
    root = tmp_path / "out"
    return Targets(f"{root}/history", f"{root}/rejects", f"{database}.dividends", **options)


def test_load_batch_counts_and_can_be_repeated(spark, tmp_path, database):
    land(tmp_path / "in", "a", page(dividend("1"), dividend("2")), page(), "no json")
    to = targets(tmp_path, database)
    create_raw_table(spark, to.table, by_batch=True)
    pages = read_pages(spark, str(tmp_path / "in"))
    for _ in range(2):
        assert load_batch(pages, to, "b1") == {"batch": "b1", "pages": 3, "rejected_pages": 1, "rows": 2}
    assert sorted(r["id"] for r in read_history(spark, to.history).collect()) == ["1", "2"]
    assert bag(read_raw(spark, to.table)) == bag(read_history(spark, to.history))
    assert spark.read.json(to.rejects).select("page").collect() == [("no json",)]


def test_batch_id_must_name_a_folder(spark, tmp_path, database):
    with pytest.raises(ValueError):
        load_batch(no_rows(spark), targets(tmp_path, database), "../b'1")


def test_failed_load_keeps_the_staged_rows(spark, tmp_path, database):
    land(tmp_path / "in", "a", page(dividend("1")))
    to = targets(tmp_path, database, staging=str(tmp_path / "staging"))
    pages = read_pages(spark, str(tmp_path / "in"))
    with pytest.raises(Exception):  # noqa: B017 - the table is not there yet
        load_batch(pages, to, "b1")
    assert [r["id"] for r in read_staging(spark, f"{to.staging}/ingest_batch=b1").collect()] == ["1"]
    create_raw_table(spark, to.table, by_batch=True)
    load_batch(pages, to, "b1")
    assert read_history(spark, to.history).count() == 1
    assert read_raw(spark, to.table).count() == 1
    assert read_staging(spark, f"{to.staging}/ingest_batch=b1").count() == 0


def test_run_once(spark, tmp_path):
    in_, out, database = str(tmp_path / "in"), str(tmp_path / "out"), f"t_{uuid4().hex}"
    one = dividend("1", ticker="NA", pay_date="2024-05-01", cash_amount="2.5", frequency="4")
    land(in_, "a", page(one, dividend(None)))
    models, counts = run_once(spark, in_, out, database, "2024-06-01", "r1", null_tokens=("", "NA"))
    assert counts["rows"] == 2
    assert read_history(spark, f"{out}/history").where("ticker = 'NA'").count() == 1
    stg = models["stg_stock_dividends"].collect()
    assert [(r["dividend_id"], r["ticker"], r["dividend_lifecycle_stage"]) for r in stg] == [("1", None, "completed")]
    assert models["dim_dividends"].first()["dividend_frequency"] == "quarterly"
    assert models["fct_dividend_summary"].select("total_dividend_amount_of_year").collect() == [(2.5,)]
    assert models["fct_dividend_trends"].collect() == [(None, 2024, 2.5, None, 2.5)]
    again, _ = run_once(spark, in_, out, database, "2024-06-01", "r1")
    assert again["stg_stock_dividends"].first()["ticker"] == "NA"
    assert read_raw(spark, f"{database}.dividends").count() == 2


def test_run_without_pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "a", page(), {"status": "OK"})
    models, counts = run_once(spark, str(tmp_path / "in"), str(tmp_path / "out"), f"t_{uuid4().hex}")
    assert counts["rows"] == 0 and counts["pages"] == 2
    assert {name: df.count() for name, df in models.items()} == dict.fromkeys(models, 0)
    assert set(NOT_NULL_COLUMNS) <= set(models["stg_stock_dividends"].columns)


def test_stream_takes_each_file_once_and_equals_the_batch(spark, tmp_path, database):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    to = targets(tmp_path, database)
    seen = []
    options = {"max_files": 2, "after_batch": lambda session, counts: seen.append(counts["rows"])}
    for n in range(5):
        land(landing, f"p{n}", page(*[dividend(f"{n}-{k}") for k in range(n + 1)]))
    ingest_available(spark, landing, to, checkpoint, **options)
    assert len(seen) == 3 and sum(seen) == 15
    ingest_available(spark, landing, to, checkpoint, **options)
    assert len(seen) == 3
    land(landing, "p9", page(dividend("late")), "broken")
    ingest_available(spark, landing, to, checkpoint, **options)
    assert seen[3:] == [1]
    batch = bag(page_rows(read_pages(spark, landing)))
    assert bag(read_history(spark, to.history)) == batch == bag(read_raw(spark, to.table))
    assert spark.read.json(to.rejects).count() == 1


def test_stream_repeats_a_failed_batch(spark, tmp_path, database):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    to = targets(tmp_path, database)
    land(landing, "a", page(dividend("1"), dividend("2")))

    def fail(session, counts):
        raise RuntimeError("lost after the batch was stored")

    with pytest.raises(Exception, match="lost after"):
        ingest_available(spark, landing, to, checkpoint, after_batch=fail)
    ingest_available(spark, landing, to, checkpoint)
    assert sorted(r["id"] for r in read_history(spark, to.history).collect()) == ["1", "2"]
    assert read_raw(spark, to.table).count() == 2


def test_new_checkpoint_does_not_replace_older_batches(spark, tmp_path, database):
    to = targets(tmp_path, database)
    for n in (1, 2):
        land(tmp_path / f"in{n}", "a", page(dividend(str(n))))
        ingest_available(spark, str(tmp_path / f"in{n}"), to, str(tmp_path / f"checkpoint{n}"))
    assert sorted(r["id"] for r in read_raw(spark, to.table).collect()) == ["1", "2"]
    assert read_history(spark, to.history).count() == 2


def test_stream_on_a_schedule(spark, tmp_path, database):
    to = targets(tmp_path, database)
    land(tmp_path / "in", "a", page(dividend("1")))
    stream = start_ingest(spark, str(tmp_path / "in"), to, str(tmp_path / "checkpoint"), interval="1 second")
    try:
        stream.processAllAvailable()
        land(tmp_path / "in", "b", page(dividend("2")))
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert read_raw(spark, to.table).count() == 2


def test_stream_refreshes_the_models(spark, tmp_path, database):
    to = targets(tmp_path, database)
    create_raw_table(spark, to.table, by_batch=True)
    replace_batch(frame(spark, dividend("0")), to.table, "loaded otherwise")
    refresh = refresh_after(to.table, database, "2024-06-01")
    days = ["2024-07-01", "2024-05-01", "2024-08-01"]
    versions = ["2024-01-01", "2024-01-03", "2024-01-02"]
    stages = ["announced", "completed", "completed"]
    for n, stage in enumerate(stages):
        row = dividend("1", pay_date=days[n], record_date=versions[n])
        land(tmp_path / "in", f"p{n}", page(row, dividend(f"other{n}")))
        ingest_available(spark, str(tmp_path / "in"), to, str(tmp_path / "checkpoint"), after_batch=refresh)
        if n:
            spark.catalog.refreshTable(f"{database}.dim_dividends")
        dim = {r["dividend_id"]: r["dividend_lifecycle_stage"] for r in spark.table(f"{database}.dim_dividends").collect()}
        assert dim["1"] == stage
        assert set(dim) == {"0", "1", *(f"other{k}" for k in range(n + 1))}


@few
@given(st.lists(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "1", "2"])), max_size=4), max_size=3))
def test_refresh_equals_rebuild(spark, tmp_path, parts):
    name = f"t_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / name))
    frames = [frame(spark, *(dividend(i, record_date=d, cash_amount=str(n)) for n, (i, d) in enumerate(p))) for p in [[], *parts]]
    for part in frames:
        models = refresh_models(part, name, "2024-06-01")
    everything = dimension(staging(reduce(DataFrame.unionByName, frames), "2024-06-01"))
    columns = [c for c in everything.columns if c != "loaded_at"]
    got = Counter(map(tuple, models["dim_dividends"].select(columns).collect()))
    assert got == Counter(map(tuple, everything.select(columns).collect()))


def test_only_new_rows_are_stored(spark, tmp_path, database):
    to = targets(tmp_path, database, only_new=True)
    create_raw_table(spark, to.table, by_batch=True)
    land(tmp_path / "a", "a", page(dividend("1"), dividend("2")))
    land(tmp_path / "b", "b", page(dividend("1"), dividend("2", ticker="NEW"), dividend("3")))
    a, b = (read_pages(spark, str(tmp_path / name)) for name in "ab")
    assert load_batch(a, to, "a")["rows"] == 2
    for _ in range(2):
        assert load_batch(b, to, "b") == {"batch": "b", "pages": 1, "rejected_pages": 0, "rows": 2}
    stored = sorted((r["id"], r["ticker"]) for r in read_raw(spark, to.table).collect())
    assert stored == [("1", "ABC"), ("2", "ABC"), ("2", "NEW"), ("3", "ABC")]
    assert [r["id"] for r in read_raw(spark, to.table, "a").orderBy("id").collect()] == ["1", "2"]


def test_command_line(spark, tmp_path, capsys):
    land(tmp_path / "in", "a", page(dividend("1", pay_date="2024-05-01", ex_dividend_date="2024-04-01")))
    name = f"t_{uuid4().hex}"
    common = ["--database", name, "--out", str(tmp_path / "out"), "--as-of", "2024-06-01"]
    main(["run", "--landing", str(tmp_path / "in"), *common])
    main(["models", *common])
    main(["check", *common])
    assert "ex_dividend_date" in capsys.readouterr().out
    again = ["run", "--landing", str(tmp_path / "in"), "--run-id", "monday", "--csv-staging", *common]
    for _ in range(2):
        main(again)
    assert read_raw(spark, f"{name}.dividends").count() == 2
    land(tmp_path / "gaps", "a", page(dividend("2", ticker=None)))
    main(["run", "--landing", str(tmp_path / "gaps"), *common])
    with pytest.raises(SystemExit) as gaps:
        main(["check", *common])
    assert gaps.value.code == 1
    assert spark.table(f"{name}.fct_dividend_trends").count() == 2
    with pytest.raises(SystemExit):
        main(["run", *common])


def test_walks_split_over_batches(spark, tmp_path, database):
    """Pages beyond a stop in this batch or an earlier one are not loaded; doing a batch again changes nothing."""

    def on(run, seq, http_status=200, next_url="more"):
        return {**page(dividend(f"{run}{seq}")), "run": run, "seq": seq, "http_status": http_status, "next_url": next_url}

    first = [on("a", 0), on("a", 1), on("b", 0, 404), on("b", 1), on("c", 0, 302), on("c", 1, 302), on("d", 0, None)]
    later = [on("a", 2, next_url=None), on("a", 3), on("b", 2), on("c", 2), page(dividend("free")), on("e", None)]
    land(tmp_path / "1", "p", *first)
    land(tmp_path / "2", "p", *later)
    to = targets(tmp_path, database, walks=str(tmp_path / "walks"))
    create_raw_table(spark, to.table, by_batch=True)
    for batch in ("1", "2", "2"):
        load_batch(read_pages(spark, str(tmp_path / batch)), to, batch)
    assert sorted(r["id"] for r in read_raw(spark, to.table).collect()) == ["a0", "a1", "a2", "c0", "free"]
