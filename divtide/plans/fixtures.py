"""Inputs derived by Spark from the given tables, since these hold no dividends."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from divtide.schema import RAW_COLUMNS

AS_OF = "1999-06-30"
LATER = "2000-01-31"
FREQUENCIES = ["1", "2", "4", "12", "4.0", "x"]  # by line number; a seventh line has none
PAGE_ROWS = 1_000
PAGE_CODEC = "snappy"
PEOPLE_PER_PAYLOAD = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows, one per `lineitem` row, with gaps, padding and values that cannot be cast."""

    def shipped(days: int) -> Column:
        return F.date_add(F.col("l_shipdate").cast("date"), days).cast("string")

    def every(key: str, n: int, rest: int = 0) -> Column:
        return F.col(key) % n == rest

    amount = F.concat(F.floor("l_quantity").cast("string"), F.lit(".25"))
    ticker = F.concat(F.lit(" tk"), (F.col("l_suppkey") % 50).cast("string"), F.lit(" "))
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    frequency = F.get(F.array(*map(F.lit, FREQUENCIES)), line - 1)
    columns = {
        "cash_amount": F.when(every("l_partkey", 23), "n/a").otherwise(amount),
        "currency": F.when(flag == "A", " usd").when(flag == "N", "cad "),
        "declaration_date": F.when(~every("l_partkey", 7), shipped(-20)),
        "dividend_type": F.col("l_linestatus"),
        "ex_dividend_date": shipped(-1),
        "frequency": frequency,
        "id": F.when(~every("l_orderkey", 97), F.concat(F.lit("D"), F.col("l_orderkey").cast("string"))),
        "pay_date": F.when(every("l_partkey", 11), "bad-date").otherwise(shipped(30)),
        "record_date": F.when(~every("l_partkey", 13), shipped(0)),
        "ticker": F.when(every("l_suppkey", 50, 7), "NA").otherwise(ticker),
    }
    return table(spark, sf_dir, "lineitem").select([columns[c].alias(c) for c in RAW_COLUMNS])


def first_part(raw: DataFrame) -> DataFrame:
    return raw.where("frequency = '1'")


def other_part(raw: DataFrame) -> DataFrame:
    return raw.where("NOT (frequency <=> '1')")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of landed pages, one per event, in the order of `page`."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("run"),
        F.col("event_id").alias("page"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("p"), F.col("event_id").cast("string"))).alias("next_url"),
    )


def land_pages(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Writes `rows` as JSON pages, one per line, of at most `PAGE_ROWS` rows each.

    Files are compressed: as plain text, the names of ten columns in each row are most of what a load would write.
    """
    page = F.expr(f"monotonically_increasing_id() div {PAGE_ROWS}")
    pages = (
        rows.select(page.alias("page"), F.struct(*rows.columns).alias("row"))
        .groupBy("page")
        .agg(F.collect_list("row").alias("results"))
        .select(F.lit("OK").alias("status"), "results")
    )
    (pages.repartition(files) if files else pages).write.mode("append").json(path, compression=PAGE_CODEC)


def land_walks(spark: SparkSession, sf_dir: str, path: str, low: int, high: int | None = None) -> None:
    """Each event as a page of its user's walk, with one row; the pages from place `low` on and before `high`."""
    place = F.row_number().over(Window.partitionBy("run").orderBy("page")) - 1
    key = F.concat(F.lit("E"), F.col("page").cast("string"))
    row = F.struct(key.alias("id"), F.col("run").alias("ticker"))
    pages = page_log(spark, sf_dir).withColumn("seq", place).where(F.col("seq") >= low)
    if high is not None:
        pages = pages.where(F.col("seq") < high)
    pages.select(
        F.lit("OK").alias("status"), "next_url", "run", "seq", F.col("status").alias("http_status"), F.array(row).alias("results")
    ).write.mode("append").json(path)


def land_loose_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Each order as a page of no walk, with one row; half of them failed, a quarter do not say."""
    key = F.col("o_orderkey")
    row = F.struct(F.concat(F.lit("O"), key.cast("string")).alias("id"), F.lit("loose").alias("ticker"))
    status = F.get(F.array(F.lit(404), F.lit(500), F.lit(200), F.lit(None)), (key % 4).cast("int"))
    pages = table(spark, sf_dir, "orders").select(F.lit("OK").alias("status"), status.alias("http_status"), F.array(row).alias("results"))
    pages.write.mode("append").json(path)


def complete_part(raw: DataFrame) -> DataFrame:
    """Rows whose amount and pay date can be cast."""
    return raw.where("cash_amount <> 'n/a' AND pay_date <> 'bad-date'")


def incomplete_part(raw: DataFrame) -> DataFrame:
    return raw.where("cash_amount = 'n/a' OR pay_date = 'bad-date'")


def three_parts(raw: DataFrame) -> list[DataFrame]:
    """All rows in three batches, so that ids have versions in several of them."""
    return [raw.where("frequency = '2'"), raw.where("frequency IN ('1', '4', 'x')"), raw.where("frequency IS NULL OR frequency IN ('12', '4.0')")]


def land_empty_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A page without rows for each order."""
    table(spark, sf_dir, "orders").select(F.lit('{"status":"OK","results":[]}').alias("page")).write.text(path)


def odd_page(key: Column) -> Column:
    """By order key: a good page, `results` that is a text, an object, has a number in it, or a page cut off."""
    k = key.cast("string")
    forms = [
        F.concat(F.lit('{"status":"OK","results":[{"id":"'), k, F.lit('"}]}')),
        F.concat(F.lit('{"status":"OK","results":"'), k, F.lit('"}')),
        F.concat(F.lit('{"status":"OK","results":{"id":"'), k, F.lit('"}}')),
        F.concat(F.lit('{"status":"OK","results":[{"id":"'), k, F.lit('"},7]}')),
        F.concat(F.lit('{"status":"OK","results":[{"id":"'), k, F.lit('"')),
    ]
    return F.get(F.array(*forms), (key % len(forms)).cast("int"))


def land_odd_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    table(spark, sf_dir, "orders").select(odd_page(F.col("o_orderkey")).alias("page")).write.text(path)


def land_people(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Writes customers as lists of people; keys are unique, so a list has `PEOPLE_PER_PAYLOAD` at most."""
    payload = F.expr(f"c_custkey div {PEOPLE_PER_PAYLOAD}")
    person = F.struct(F.col("c_mktsegment").alias("craft"), F.col("c_name").alias("name"))
    (
        table(spark, sf_dir, "customer")
        .groupBy(payload.alias("payload"))
        .agg(F.collect_list(person).alias("people"))
        .select((F.col("payload") % 20).cast("int").alias("number"), "people")
        .write.json(path)
    )
