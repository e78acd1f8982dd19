"""Scalar rules, deduplication, totals and models on hand-written rows, and properties on random ones."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from divtide.functions import as_date, as_double, as_long, blank_null_tokens, clean_text, person_message
from divtide.operators.admission import admit_pages, ok_pages
from divtide.operators.dedup import drop_null_keys, keep_latest
from divtide.operators.quality import batch_metrics, not_null_report
from divtide.operators.totals import ticker_year_totals, with_change, with_previous_year
from divtide.plans.models import DIM_COLUMNS, dimension, staging, summary, trends
from divtide.schema import RAW_COLUMNS, RAW_SCHEMA

TODAY = dt.date(2024, 6, 15)
PAST, FUTURE = dt.date(2024, 1, 1), dt.date(2024, 12, 1)

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


def raw(spark, *rows):
    full = [{**dict.fromkeys(RAW_COLUMNS), **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in full], RAW_SCHEMA)


def dim_rows(spark, *rows):
    schema = "ticker string, pay_date date, record_date date, cash_amount double"
    return spark.createDataFrame(list(rows), schema)


@pytest.mark.parametrize(
    ("pay", "ex", "declared", "stage"),
    [
        (PAST, FUTURE, None, "completed"),
        (TODAY, None, None, "completed"),
        (FUTURE, PAST, None, "awaiting_payment"),
        (FUTURE, TODAY, PAST, "awaiting_payment"),
        (FUTURE, FUTURE, PAST, "upcoming"),
        (None, FUTURE, None, "upcoming"),
        (FUTURE, None, None, "announced"),
        (FUTURE, None, PAST, "in_progress"),
        (None, PAST, None, "announced"),
        (None, PAST, PAST, "in_progress"),
        (None, None, None, "announced"),
        (None, None, PAST, "in_progress"),
    ],
)
def test_lifecycle(spark, pay, ex, declared, stage):
    dates = {"pay_date": pay, "ex_dividend_date": ex, "declaration_date": declared}
    row = {"id": "1", **{c: d and d.isoformat() for c, d in dates.items()}}
    for as_of in (TODAY, TODAY.isoformat(), F.lit(TODAY)):
        assert staging(raw(spark, row), as_of).first()["dividend_lifecycle_stage"] == stage


def test_lifecycle_today_by_default(spark):
    out = staging(raw(spark, {"id": "1", "pay_date": "2000-01-01"})).first()
    assert out["dividend_lifecycle_stage"] == "completed"
    assert abs((out["loaded_at"] - dt.datetime.now()).total_seconds()) < 86_400


def test_frequency_labels(spark):
    given_ = ["1", "2", "4", "12", "3", None, "x", "4.0"]
    rows = raw(spark, *({"id": str(n), "frequency": f} for n, f in enumerate(given_)))
    labels = {r["dividend_id"]: r["dividend_frequency"] for r in dimension(staging(rows)).collect()}
    expected = ["annual", "semi_annual", "quarterly", "monthly", "unknown", "unknown", "unknown", "quarterly"]
    assert [labels[str(n)] for n in range(len(given_))] == expected


def test_casts(spark):
    text = spark.createDataFrame(
        [("4",), ("4.0",), ("4.7",), (" 12 ",), ("-2.5",), ("1e3",), ("x",), ("",), (None,), ("99999999999999999999",)],
        "v string",
    )
    got = [r[0] for r in text.select(as_long(F.col("v"))).collect()]
    assert got == [4, 4, 5, 12, -3, 1000, None, None, None, None]
    got = [r[0] for r in text.select(as_double(F.col("v"))).limit(7).collect()]
    assert got == [4.0, 4.0, 4.7, 12.0, -2.5, 1000.0, None]
    whole = ["2024-03-05", " 2024-3-5 ", "2024-03-05 10:20:30", "2024-03-05T10:20:30.5Z"]
    other = ["2024", "2024-03", "03/05/2024", "2024-02-30", "2024-03-05 junk", "2024-03-05Tjunk", "2024-03-05 25:00", None]
    dates = spark.createDataFrame([(v,) for v in whole + other], "v string")
    assert [r[0] for r in dates.select(as_date(F.col("v"))).collect()] == [dt.date(2024, 3, 5)] * 4 + [None] * 8


def test_text_functions(spark):
    row = spark.createDataFrame([("  ab\t ", "x", "ISS")], "t string, name string, craft string")
    assert row.select(clean_text(F.col("t"))).first()[0] == "AB\t"
    message = row.select(person_message(F.col("name"), F.col("craft"), "Hi")).first()[0]
    assert message == "x is currently in space flying on the ISS! Hi"


def test_null_tokens(spark):
    rows = raw(spark, {"ticker": "NA", "currency": ""}, {"ticker": "NAB", "currency": "n/a"})
    assert [tuple(r) for r in blank_null_tokens(rows).select("ticker", "currency").collect()] == [(None, None), ("NAB", None)]
    only_empty = blank_null_tokens(rows, [""]).select("ticker", "currency").collect()
    assert [tuple(r) for r in only_empty] == [("NA", None), ("NAB", "n/a")]


def test_staging_schema(spark):
    types = {
        "dividend_id": "string",
        "ticker": "string",
        "ex_dividend_date": "date",
        "pay_date": "date",
        "record_date": "date",
        "declaration_date": "date",
        "dividend_type": "string",
        "frequency": "bigint",
        "cash_amount": "double",
        "currency": "string",
        "loaded_at": "timestamp",
        "dividend_lifecycle_stage": "string",
    }
    stg = staging(raw(spark))
    assert dict(stg.dtypes) == types and stg.columns == list(types)
    assert dict(dimension(stg).dtypes) == {**types, "dividend_frequency": "string"}
    assert dimension(stg).columns == DIM_COLUMNS


def test_latest_prefers_null_then_text_order_then_other_columns(spark):
    rows = raw(
        spark,
        {"id": "a", "record_date": "2024-01-02", "ticker": "old"},
        {"id": "a", "record_date": "2024-01-10", "ticker": "new"},
        {"id": "b", "record_date": "2024-01-10", "ticker": "dated"},
        {"id": "b", "record_date": None, "ticker": "undated"},
        {"id": "c", "record_date": "2024-01-10", "cash_amount": "1", "ticker": "z"},
        {"id": "c", "record_date": "2024-01-10", "cash_amount": "2", "ticker": "a"},
        {"id": "d", "record_date": "9", "ticker": "text"},
        {"id": "d", "record_date": "10", "ticker": "number"},
        {"id": None, "ticker": "none"},
    )
    kept = {r["id"]: r["ticker"] for r in keep_latest(drop_null_keys(rows)).collect()}
    assert kept == {"a": "new", "b": "undated", "c": "a", "d": "text"}


def test_totals_gaps_nulls_and_top(spark):
    def day(year):
        return dt.date(year, 5, 1)

    dim = dim_rows(
        spark,
        ("A", day(2020), None, 1.25),
        ("A", day(2020), None, 2.0),
        ("A", day(2022), None, 5.0),
        ("A", None, None, 9.0),
        ("B", day(2021), None, None),
        ("B", day(2022), None, 4.0),
        (None, day(2020), None, 3.0),
    )
    totals = ticker_year_totals(dim)
    changes = with_change(with_previous_year(totals)).collect()
    got = {(r["ticker"], r["year"]): (r["total_cashes"], r["total_cashes_previous_year"], r["year_over_year_change"]) for r in changes}
    assert got == {
        ("A", 2020): (3.25, None, 3.25),
        ("A", 2022): (5.0, 3.25, 1.75),
        ("A", None): (9.0, 5.0, 4.0),
        ("B", 2021): (None, None, None),
        ("B", 2022): (4.0, None, 4.0),
        (None, 2020): (3.0, None, 3.0),
    }
    top = [(r["ticker"], r["year"]) for r in trends(dim, 4).collect()]
    assert top == [("B", 2021), ("A", None), ("B", 2022), ("A", 2020)]
    assert trends(dim).columns == [
        "ticker",
        "year",
        "total_cashes_current_year",
        "total_cashes_previous_year",
        "year_over_year_change",
    ]


def window_summary(dim):
    group = Window.partitionBy("ticker", F.year("pay_date"), "record_date")
    return dim.select(
        "ticker",
        F.sum("cash_amount").over(group).alias("total_dividend_amount_of_year"),
        F.avg("cash_amount").over(group).alias("average_dividend_amount_of_year"),
        F.max("pay_date").over(group).alias("last_pay_date_of_year"),
        F.min("pay_date").over(group).alias("first_pay_date_of_year"),
    )


days = st.sampled_from([None, dt.date(2023, 3, 1), dt.date(2023, 9, 1), dt.date(2024, 2, 29)])
dim_lists = st.lists(
    st.tuples(
        st.sampled_from([None, "A", "B"]), days, days, st.one_of(st.none(), st.integers(-40, 40).map(lambda n: n / 4))
    ),
    max_size=40,
)


@few
@given(dim_lists)
def test_summary_equals_windows(spark, rows):
    dim = dim_rows(spark, *rows)
    expected = Counter(map(tuple, window_summary(dim).collect()))
    for chunk_rows in (1, 3, 4_096):
        assert Counter(map(tuple, summary(dim, chunk_rows).collect())) == expected


def test_summary_of_one_large_group(spark):
    """One group of most rows, cut at and around the chunk size."""
    for n in (8, 9, 16, 1_001):
        dim = spark.range(n).select(
            F.lit("A").alias("ticker"),
            F.lit(PAST).alias("pay_date"),
            F.lit(None).cast("date").alias("record_date"),
            F.col("id").cast("double").alias("cash_amount"),
        )
        (group,) = summary(dim, 8).groupBy("total_dividend_amount_of_year").count().collect()
        assert tuple(group) == (n * (n - 1) / 2, n)


keys = st.sampled_from([None, "a", "b", "c"])
small_text = st.sampled_from([None, "1", "2", "x"])
raw_lists = st.lists(st.fixed_dictionaries({"id": keys, "record_date": small_text, "ticker": small_text}), max_size=30)


@few
@given(raw_lists)
def test_one_staged_row_per_id(spark, rows):
    stg = staging(raw(spark, *rows), TODAY)
    ids = [r["dividend_id"] for r in stg.collect()]
    assert sorted(ids) == sorted({r["id"] for r in rows} - {None})
    assert summary(dimension(stg)).count() == len(ids)

    def rank(row):
        order = ("record_date", *sorted(c for c in row if c not in ("id", "record_date")))
        return [(row[c] is None, row[c] or "") for c in order]

    best = {}
    for row in rows:
        if row["id"] is not None and (row["id"] not in best or rank(row) > rank(best[row["id"]])):
            best[row["id"]] = row
    kept = keep_latest(drop_null_keys(raw(spark, *rows))).collect()
    assert {r["id"]: (r["record_date"], r["ticker"]) for r in kept} == {
        key: (row["record_date"], row["ticker"]) for key, row in best.items()
    }


def walk(pages, limit=5):
    """The pages a client would take: `(status, next_url)` in order."""
    taken = []
    for position, (status, next_url) in enumerate(pages):
        good = status is not None and (status < 400 if position == 0 else 200 <= status <= 299)
        if position == limit or not good:
            break
        taken.append(position)
        if not next_url:
            break
    return taken


logs = st.lists(
    st.lists(
        st.tuples(st.sampled_from([200, 200, 200, 204, 304, 404, 429, 500, None]), st.sampled_from(["u", "u", "u", "", None])),
        max_size=9,
    ),
    max_size=6,
)


@few
@given(logs)
def test_admission_equals_a_walk(spark, runs):
    rows = [(f"r{n}", seq, *p) for n, pages in enumerate(runs) for seq, p in enumerate(pages)]
    log = spark.createDataFrame(rows, "run string, seq int, status int, next_url string")
    got = defaultdict(list)
    for r in admit_pages(log).orderBy("run", "seq").collect():
        got[r["run"]].append(r["seq"])
    assert dict(got) == {f"r{n}": walk(pages) for n, pages in enumerate(runs) if walk(pages)}
    assert admit_pages(log).columns == log.columns
    assert ok_pages(log).count() == sum(r[2] is not None and r[2] < 400 for r in rows)


def test_checks_and_counts(spark):
    rows = raw(spark, {"id": "1", "ticker": " a "}, {"id": "2", "cash_amount": "1", "pay_date": "2024-01-01"})
    report = {r["column_name"]: r["failures"] for r in not_null_report(staging(rows)).collect()}
    assert report == {"ticker": 1, "ex_dividend_date": 2, "cash_amount": 1, "pay_date": 1}
    assert batch_metrics(rows, rows.limit(1)).first().asDict() == {"rows_in_batch": 1, "rows_before": 2, "rows_after": 3}
