"""Compaction of the history, and staging files that split."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from divtide.plans.load import Targets, load_batch
from divtide.schema import RAW_COLUMNS
from divtide.sources.history import append_form, append_history, batches, compact_history, compacted, read_batch, read_history, sorted_by_batch
from divtide.sources.pages import read_pages
from divtide.sources.row_index import index_batch, row_index, rows_not_held
from divtide.sources.staging_csv import read_staging, write_staging
from divtide.sources.warehouse import create_raw_table
from tests.test_ingest import bag, database, dividend, frame, land, page  # noqa: F401


def ids(df):
    return sorted(r["id"] for r in df.collect())


def by_batch(spark, path):
    return sorted((r["ingest_batch"], r["id"]) for r in batches(spark, path).collect())


def test_compaction_changes_no_row(spark, tmp_path):
    path = str(tmp_path / "history")
    for batch in "abc":
        append_history(frame(spark, dividend(f"{batch}1"), dividend(f"{batch}2", ticker=None)), path, batch)
    before, rows = read_history(spark, path), bag(read_history(spark, path))
    reader = read_batch(spark, path, "b")
    assert compact_history(spark, path) == 3
    assert bag(read_history(spark, path)) == rows
    assert ids(read_batch(spark, path, "b")) == ["b1", "b2"] and read_batch(spark, path, "none").count() == 0
    # Readers that had begun are not disturbed.
    assert bag(before) == rows and ids(reader) == ["b1", "b2"]
    assert compact_history(spark, path) == 0 and bag(read_history(spark, path)) == rows


def test_merged_batch_still_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "history")
    for batch in "ab":
        append_history(frame(spark, dividend(f"{batch}1")), path, batch)
    compact_history(spark, path)
    append_history(frame(spark, dividend("a9")), path, "a")
    append_history(frame(spark, dividend("c1")), path, "c")
    expected = [("a", "a9"), ("b", "b1"), ("c", "c1")]
    assert by_batch(spark, path) == expected and ids(read_batch(spark, path, "a")) == ["a9"]
    append_history(frame(spark), path, "c")
    expected = expected[:2]
    assert by_batch(spark, path) == expected
    # Merged anew, without the rows passed over, and with old folders gone.
    assert compact_history(spark, path, seconds=-60) == 1
    assert by_batch(spark, path) == expected
    append_history(frame(spark, dividend("d1")), path, "d")
    assert compact_history(spark, path, seconds=-60) == 1
    assert by_batch(spark, path) == [*expected, ("d", "d1")]
    assert compacted(spark, path)["again"] == []
    assert not any((tmp_path / "history" / f"ingest_batch={b}").exists() for b in "ab")
    append_history(frame(spark), path, "a")
    assert by_batch(spark, path) == [("b", "b1"), ("d", "d1")]


def test_index_finds_merged_rows(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(frame(spark, dividend("1")), path, "a")
    compact_history(spark, path)
    index = row_index(spark, str(tmp_path / "index"), path)
    append_history(frame(spark, dividend("2")), path, "b")
    index_batch(index, read_batch(spark, path, "b"), "b")
    compact_history(spark, path, seconds=-60)
    rows = frame(spark, dividend("1"), dividend("2"), dividend("3"))
    assert ids(rows_not_held(rows, index, path, "c")) == ["3"]


def test_loads_go_on_after_compaction(spark, tmp_path, database):  # noqa: F811
    root = tmp_path / "out"
    to = Targets(f"{root}/history", f"{root}/rejects", f"{database}.dividends", only_new=True)
    create_raw_table(spark, to.table, by_batch=True)
    land(tmp_path / "1", "a", page(dividend("1"), dividend("2")))
    land(tmp_path / "2", "a", page(dividend("2"), dividend("3")))
    pages = {n: read_pages(spark, str(tmp_path / n)) for n in "12"}
    load_batch(pages["1"], to, "1")
    compact_history(spark, to.history)
    assert load_batch(pages["2"], to, "2")["rows"] == 1
    assert load_batch(pages["1"], to, "1")["rows"] == 2
    assert by_batch(spark, to.history) == [("1", "1"), ("1", "2"), ("2", "3")]


TEXTS = st.text(alphabet=st.sampled_from(list('\\bnr\n\r",\u2028\u0085 x')), min_size=1, max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=40))
def test_staging_gives_any_text_back(spark, tmp_path, rows):
    path = str(tmp_path / "staging")
    given_rows = frame(spark, *[dividend(a, ticker=b) for a, b in rows])
    write_staging(given_rows, path)
    assert bag(read_staging(spark, path)) == bag(given_rows)


def test_staging_files_split(spark, tmp_path):
    """One file with line breaks in its texts is read by several tasks, and no row is cut."""
    path = str(tmp_path / "staging")
    rows = frame(spark, *[dividend(f"{i}\nline\r\n", ticker='"\\n"') for i in range(4000)])
    write_staging(rows.coalesce(1), path)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "64k")
    try:
        staged = read_staging(spark, path)
        assert len(staged.inputFiles()) == 1 and staged.rdd.getNumPartitions() > 2
        assert bag(staged) == bag(rows.select(RAW_COLUMNS))
    finally:
        spark.conf.set(key, before)


def test_recorded_forms_are_read_once_each(spark, tmp_path):
    """Many writes of two forms are two scans, beside that of files of which nothing is recorded."""
    path = str(tmp_path / "history")
    for i in range(6):
        typed = spark.createDataFrame([(f"t{i}", 0.5 + i, 4, "x")], "id string, cash_amount double, frequency int, note string")
        append_form(typed, path)
        append_form(frame(spark, dividend(f"r{i}")), path)
    found = read_history(spark, path)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    rows = {r["id"]: (r["cash_amount"], r["frequency"]) for r in found.collect()}
    assert rows == {**{f"t{i}": (str(0.5 + i), "4") for i in range(6)}, **{f"r{i}": ("1.25", None) for i in range(6)}}
    append_history(frame(spark, dividend("plain")), path)
    assert len(ids(read_history(spark, path))) == 13


def test_one_large_batch_is_merged_by_many_tasks(spark):
    """Rows of one batch, and copies of one row, are cut over tasks and stay sorted by batch."""
    rows = spark.range(0, 4_000, numPartitions=4).selectExpr("CASE WHEN id < 3900 THEN 'a' ELSE 'b' END AS ingest_batch", "'x' AS id")
    merged = sorted_by_batch(rows)
    placed = merged.selectExpr("spark_partition_id() AS task", "ingest_batch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = [(r["task"], r["ingest_batch"]) for r in placed.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = Counter(task for task, batch in found if batch == "a")
    assert merged.columns == rows.columns and len(sizes) > 4 and max(sizes.values()) < 1_500
    assert found == sorted(found) and [batch for _, batch in found] == ["a"] * 3_900 + ["b"] * 100
