"""What the physical plans must and must not hold."""

from divtide.operators.admission import admitted_pages
from divtide.plans import fixtures as fx
from divtide.plans.load import WALKS, stops_so_far
from divtide.plans.models import clean_columns, dimension, staging, summary
from divtide.plans.registry import QUERIES
from divtide.session import empty, scratch_dir
from divtide.sources.history import append_history, new_rows, read_history
from divtide.sources.pages import page_rows, read_pages
from divtide.sources.parts import PartTable
from divtide.sources.row_index import row_index, rows_not_held

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return text.count("Exchange hashpartitioning")


def test_dedup_cuts_each_task_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_latest"](spark, SF_DIR))
    assert exchanges(text) == 1
    below = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_admission_cuts_each_run_before_its_only_shuffle(spark):
    text = plan(QUERIES["page_admission"](spark, SF_DIR))
    assert exchanges(text) == 1
    assert "row_number(), 5, Partial" in text[text.index("Exchange hashpartitioning") :]


def test_trends_shuffle_aggregates_only(spark):
    text = plan(QUERIES["fct_dividend_trends"](spark, SF_DIR))
    assert exchanges(text) == 3
    assert "TakeOrderedAndProject" in text and "partial_sum" in text
    assert "Exchange SinglePartition" not in text


def test_summary_reads_four_columns_and_has_no_window(spark):
    path = scratch_dir(spark, "dim")
    clean_columns(fx.raw_dividends(spark, SF_DIR)).write.parquet(path)
    text = summary(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "Window" not in text and "partial_avg" in text
    assert "ReadSchema: struct<ticker:string,pay_date:date,record_date:date,cash_amount:double>" in text


def test_page_filter_needs_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["page_ok_filter"](spark, SF_DIR))


def test_staged_filter_reaches_the_scan(spark):
    path = scratch_dir(spark, "raw")
    fx.raw_dividends(spark, SF_DIR).write.parquet(path)
    text = staging(spark.read.parquet(path)).where("dividend_id = 'D1'")._jdf.queryExecution().toString()
    assert "EqualTo(id,D1)" in text


def test_new_rows_shuffle_once_and_combine_copies_first(spark):
    path = scratch_dir(spark, "history")
    raw = fx.raw_dividends(spark, SF_DIR)
    append_history(fx.first_part(raw), path)
    text = plan(new_rows(raw, read_history(spark, path)))
    assert exchanges(text) == 1 and "Join" not in text and "partial_max(held" in text


def test_summary_deals_out_every_group(spark):
    """Groups of any size are cut into chunks and dealt to a fixed number of tasks before rows are repeated."""
    path = scratch_dir(spark, "dim")
    dimension(staging(fx.raw_dividends(spark, SF_DIR), fx.AS_OF)).write.parquet(path)
    text = plan(summary(spark.read.parquet(path)))
    assert "REPARTITION_BY_NUM" in text and "Union" not in text


def test_walks_read_their_own_parts_and_pages_stay(spark):
    """Stops come from the parts of the batch's runs, not from folders of batches; no page is shuffled."""
    landing, walks = scratch_dir(spark, "pages"), scratch_dir(spark, "walks")
    fx.land_walks(spark, SF_DIR, landing, 0, 2)
    stops_so_far(read_pages(spark, landing), walks, "first", parts=64)
    later = scratch_dir(spark, "pages")
    fx.land_walks(spark, SF_DIR, later, 2, 4)
    pages = read_pages(spark, later).where("run IN ('u1', 'u2')")
    stops = stops_so_far(pages, walks, "second", parts=64)
    touched = PartTable(spark, walks, WALKS, ["run"]).touched(pages.where("run IS NOT NULL"))
    assert len(touched) <= 2
    files = [f for f in stops.inputFiles() if walks.rsplit("/", 1)[1] in f and "/data/" in f]
    assert files and all(any(f"part={p}/" in f for p in touched) for f in files)
    text = plan(page_rows(admitted_pages(pages, stops)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    for line in text.splitlines():
        assert not ("Exchange" in line and "results" in line)


def test_pages_of_no_run_are_not_brought_to_one_task(spark):
    """Where stops are not broadcast, NULL runs are dealt out; where there are none, nothing is joined."""
    pages = spark.range(0, 4_000, numPartitions=4).selectExpr("CASE WHEN id = 0 THEN 'none' END AS run", "0L AS seq", "id")
    stops = spark.range(8).selectExpr("CAST(id AS STRING) AS run", "id AS stop")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tasks = admitted_pages(pages, stops).selectExpr("spark_partition_id() AS task").groupBy("task").count().collect()
        alone = plan(admitted_pages(pages, empty(spark, stops.schema)))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(r["count"] for r in tasks) == 4_000 and max(r["count"] for r in tasks) < 1_000
    assert "Exchange" not in alone and "Join" not in alone


def test_landed_pages_are_compressed(spark):
    """Pages take a fraction of their text, and give the rows back."""
    landing, rows = scratch_dir(spark, "pages"), spark.range(5_000).selectExpr("CAST(id AS STRING) AS id", "'USD' AS currency")
    fx.land_pages(rows, landing)
    files = spark.read.format("binaryFile").load(landing).agg({"length": "sum"}).first()[0]
    text = spark.read.text(landing).selectExpr("sum(length(value))").first()[0]
    assert files < text / 2
    assert sorted(r["id"] for r in page_rows(read_pages(spark, landing)).collect()) == sorted(map(str, range(5_000)))


def test_rows_not_held_shuffle_whole_rows_once(spark):
    """The index and the rows it names are found by hashes; the batch's rows are grouped once and not joined."""
    history, raw = scratch_dir(spark, "history"), fx.raw_dividends(spark, SF_DIR)
    append_history(fx.first_part(raw), history, "first")
    found = rows_not_held(raw, row_index(spark, f"{history}_index", history), history, "second")
    text = plan(found)
    assert text.count("Exchange hashpartitioning(cash_amount") == 1 and "LeftAnti" not in text
    expected = raw.distinct().exceptAll(fx.first_part(raw).distinct())
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
