"""

``events`` stands in for the transactions (see ``daybook.sources.events``). Every query reads
the whole table. Queries whose name ends in ``_load`` or ``refresh`` go through files: the
events are written as CSV deliveries with JSON cells and travel the whole way from there.
"""

from __future__ import annotations

import pathlib
import sys
from collections.abc import Callable

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas
from daybook.functions.json_fields import member_or, with_member
from daybook.functions.numbers import number
from daybook.operators import pricing, quality, quote_store, reports, volumes
from daybook.operators.editions import Publication
from daybook.operators.extraction import extract_with_rejects
from daybook.operators.quote_objects import put_quotes
from daybook.operators.sinks import (
    append_rows,
    as_table,
    land,
    replace_partitions,
    store_quotes,
    write_lines,
)
from daybook.operators.totals import summed
from daybook.operators.updates import updated
from daybook.plans.control import control_totals, published_profile
from daybook.plans.initial_load import initial_load as load_delivery
from daybook.plans.lake import Lake
from daybook.plans.quarantine import land_with_quarantine, quarantined, replay
from daybook.plans.refresh import apply_valuations, refresh, worklist
from daybook.plans.validation import validate
from daybook.session import scratch_dir, settled
from daybook.sources.events import (
    currency,
    event_date,
    event_quotes,
    event_records,
    event_responses,
    event_transactions,
)
from daybook.sources.metrics import read_metrics, read_project_metrics
from daybook.sources.quotes import (
    read_quote_objects,
    read_responses,
    response_quotes,
    stream_responses,
)
from daybook.sources.transactions import read_landed, stream_transactions
from daybook.streaming.arrivals import refresh_on_arrival, reprice_on_arrival

# The corpus operators are an optional part: without their folder the other queries remain.
try:
    import corpus_pipeline
    import daybook.llm.queries as corpus_queries
except ImportError as missing:  # the folder, or a library that only it needs
    print(f"corpus queries are left out: {missing}", file=sys.stderr)
    corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


# --- inputs ---------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_transactions(_events(spark, sf_dir))


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_quotes(_events(spark, sf_dir))


def _volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volumes.currency_volumes(_transactions(spark, sf_dir))


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volumes.price_keys(_transactions(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.valued(_volumes(spark, sf_dir), _quotes(spark, sf_dir))


def _unvalued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics as first loaded: the raw volume in place of the dollar value, no price yet."""
    return _volumes(spark, sf_dir).select(
        "*",
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("string").alias("price_source"),
        F.col("raw_volume").alias("usd_volume"),
    )


def _updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updated(_unvalued(spark, sf_dir), _metrics(spark, sf_dir))


def _deliveries(spark: SparkSession, sf_dir: str, base_units: bool = True) -> str:
    """Writes the events as CSV deliveries with JSON cells; returns their folder."""
    path = f"{scratch_dir(spark)}/deliveries"
    records = event_records(_events(spark, sf_dir), base_units).repartition(4)
    records.write.option("header", True).option("escape", '"').csv(path)
    return path


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A new lake that has the quotes but no transactions yet."""
    lake = Lake.under(scratch_dir(spark))
    lake.create(spark)
    store_quotes(_quotes(spark, sf_dir), lake.quotes)
    return lake


# --- queries --------------------------------------------------------------------------------


def tx_extract(spark, sf_dir):
    events = with_member(_events(spark, sf_dir), "present", "props", "k")
    return with_member(events, "absent", "props", "missing").select(
        "event_id",
        event_date().alias("date"),
        currency().alias("currency_symbol"),
        member_or("present", "").alias("present_text"),
        member_or("absent", "").alias("absent_text"),
        number(member_or("present", "0")).alias("present_number"),
        number(member_or("absent", "0")).alias("absent_number"),
    )


def rejected_records(spark, sf_dir):
    """Permissive extraction of records some of which are spoiled."""
    records = event_records(_events(spark, sf_dir), base_units=False)
    spoiled = records.withColumns(
        {
            "props": F.when(
                F.col("props").contains("USDC.E"), F.expr("left(props, length(props) - 1)")
            ).otherwise(F.col("props")),
            "nums": F.when(
                F.col("props").contains("WETH"), F.lit('{"currencyValueDecimal":"1.5d"}')
            ).otherwise(F.col("nums")),
        }
    )
    readable, rejects = extract_with_rejects(spoiled, once=True)
    records = readable.select("project_id", F.lit("none").alias("problem"), "amount").unionByName(
        rejects.select(
            F.col("project_id").try_cast("bigint").alias("project_id"),
            "problem",
            F.lit(None).cast("double").alias("amount"),
        )
    )
    counts = {"records": F.count("*")}
    return summed(records, ("project_id", "problem"), "amount", "amount", counts)


def daily_project_metrics(spark, sf_dir):
    """Raw amounts of all currencies together, base units and tokens alike."""
    return volumes.project_metrics(_transactions(spark, sf_dir))


def daily_currency_volumes(spark, sf_dir):
    return _volumes(spark, sf_dir)


def price_exact(spark, sf_dir):
    return pricing.exact_prices(_keys(spark, sf_dir), _quotes(spark, sf_dir))


def price_last_known(spark, sf_dir):
    return pricing.last_known_prices(_keys(spark, sf_dir), _quotes(spark, sf_dir))


def price_resolved(spark, sf_dir):
    return pricing.with_prices(_keys(spark, sf_dir), _quotes(spark, sf_dir))


def price_source_coverage(spark, sf_dir):
    return quality.price_coverage(_metrics(spark, sf_dir))


def unpriced_groups(spark, sf_dir):
    return quality.unpriced_groups(_metrics(spark, sf_dir))


def usd_valuation(spark, sf_dir):
    return pricing.priced(_metrics(spark, sf_dir))


def missing_quotes(spark, sf_dir):
    return quote_store.missing_quotes(_keys(spark, sf_dir), _quotes(spark, sf_dir))


def quote_response_price(spark, sf_dir):
    return response_quotes(event_responses(_events(spark, sf_dir)))


def quote_upsert(spark, sf_dir):
    fetched = response_quotes(event_responses(_events(spark, sf_dir)))
    return quote_store.merged_quotes(_quotes(spark, sf_dir), fetched)


def metrics_update(spark, sf_dir):
    return _updated(spark, sf_dir)


def verify_volumes(spark, sf_dir):
    """Totals to six places: the engines' doubles may differ beyond."""
    report = reports.verify_volumes(_metrics(spark, sf_dir))
    return report.withColumn("total_usd_volume", F.round("total_usd_volume", 6))


def verify_report_text(spark, sf_dir):
    return reports.verify_text(_metrics(spark, sf_dir))


def daily_volumes(spark, sf_dir):
    return reports.daily_volumes(_metrics(spark, sf_dir))


def daily_transactions(spark, sf_dir):
    return reports.daily_transactions(_metrics(spark, sf_dir))


def project_volumes(spark, sf_dir):
    return reports.project_volumes(_metrics(spark, sf_dir))


def project_totals(spark, sf_dir):
    return reports.project_totals(_metrics(spark, sf_dir))


def project_report_text(spark, sf_dir):
    return reports.project_text(_metrics(spark, sf_dir))


def metrics_json(spark, sf_dir):
    return reports.json_records(reports.daily_volumes(_metrics(spark, sf_dir)))


def metrics_row_count(spark, sf_dir):
    return quality.row_count(_metrics(spark, sf_dir))


def metrics_profile(spark, sf_dir):
    return quality.profile(_metrics(spark, sf_dir))


def required_nulls(spark, sf_dir):
    return quality.required_nulls(_metrics(spark, sf_dir))


def count_reconciliation(spark, sf_dir):
    return quality.count_reconciliation(_metrics(spark, sf_dir), _transactions(spark, sf_dir))


def usd_recheck(spark, sf_dir):
    """After an update, the rows that still hold the raw volume are the unpriced ones."""
    return quality.usd_mismatches(_updated(spark, sf_dir))


def duplicate_keys(spark, sf_dir):
    """All metrics are appended, then the priced ones once more."""
    path = f"{scratch_dir(spark)}/appended"
    metrics = _metrics(spark, sf_dir)
    keys = ("date", "project_id", "num_transactions")
    append_rows(metrics, path, schemas.METRICS, keys)
    append_rows(pricing.priced(metrics), path, schemas.METRICS, keys)
    return quality.duplicate_keys(read_metrics(spark, path))


def metrics_validation(spark, sf_dir):
    """The three verdicts and the overall one on the written metrics."""
    path = f"{scratch_dir(spark)}/metrics"
    replace_partitions(as_table(_metrics(spark, sf_dir), schemas.METRICS), path, "date")
    verdict = validate(spark, path)
    return spark.createDataFrame(
        [(*verdict, verdict.ok)], "readable boolean, complete boolean, displayable boolean, ok boolean"
    )


def initial_load(spark, sf_dir):
    lake = Lake.under(scratch_dir(spark))
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    return read_project_metrics(spark, lake.project_metrics)


def rows_loaded(spark, sf_dir):
    """What a first load reports."""
    lake = Lake.under(scratch_dir(spark))
    added = load_delivery(spark, _deliveries(spark, sf_dir), lake)
    return spark.createDataFrame([(added,)], "rows_loaded bigint")


def metrics_table(spark, sf_dir):
    """Metrics read as a table of a database."""
    root = scratch_dir(spark)
    lake = Lake.under(root, database=root.rsplit("/", 1)[-1].replace("-", "_"))
    lake.create(spark)
    store_quotes(_quotes(spark, sf_dir), lake.quotes)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    return pricing.priced(spark.table(f"{lake.database}.daily_metrics"))


def redelivery(spark, sf_dir):
    """A delivery with wrong dates, its correction under the same label, and a refresh of both."""
    lake = _lake(spark, sf_dir)
    records = event_records(_events(spark, sf_dir))
    moved = F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL 40 DAYS"), "yyyy-MM-dd")
    land(records.withColumn("ts", moved), lake.bronze, "shop")
    refresh(spark, lake)
    dates = land(records, lake.bronze, "shop")
    refresh(spark, lake, dates)
    return pricing.priced(read_metrics(spark, lake.metrics))


def landed_responses(spark, sf_dir):
    """Quotes of answers that were kept in JSON files."""
    path = f"{scratch_dir(spark)}/answers"
    event_responses(_events(spark, sf_dir)).write.json(path)
    return response_quotes(read_responses(spark, path))


def refresh_metrics(spark, sf_dir):
    """Load, refresh, and refresh again, which changes nothing."""
    lake = _lake(spark, sf_dir)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    refresh(spark, lake)
    return pricing.priced(read_metrics(spark, lake.metrics))


def quotes_refresh(spark, sf_dir):
    """A refresh that also takes in fetched quotes, and the worklist it leaves."""
    lake = _lake(spark, sf_dir)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake, responses=event_responses(_events(spark, sf_dir)))
    return worklist(spark, lake).select("symbol", "date")


def late_quotes(spark, sf_dir):
    """Quotes fetched after a refresh: the metrics are valued again, the records left alone."""
    lake = _lake(spark, sf_dir)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    refresh(spark, lake, dates=[], responses=event_responses(_events(spark, sf_dir)))
    return read_metrics(spark, lake.metrics)


def stored_update(spark, sf_dir):
    """Stored metrics that hold raw volumes, updated by key where there is a price."""
    lake = _lake(spark, sf_dir)
    run = Publication(spark, lake.catalogue)
    run.replace(as_table(_unvalued(spark, sf_dir), schemas.METRICS), lake.metrics)
    lake.publish(spark, run)
    apply_valuations(spark, lake, _metrics(spark, sf_dir))
    return read_metrics(spark, lake.metrics)


def stream_refresh(spark, sf_dir):
    """Deliveries taken up two files at a time."""
    lake = _lake(spark, sf_dir)
    arriving = stream_transactions(
        spark, _deliveries(spark, sf_dir), max_files_per_trigger=2
    )
    query = refresh_on_arrival(arriving, lake, "events", f"{scratch_dir(spark)}/progress")
    query.awaitTermination()
    return pricing.priced(read_metrics(spark, lake.metrics))


def unpublished_run(spark, sf_dir):
    """A run that wrote other figures and new quotes but was stopped before it published shows nothing."""
    lake = _lake(spark, sf_dir)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    run = Publication(spark, lake.catalogue)
    store_quotes(_quotes(spark, sf_dir).withColumn("price", F.col("price") * 2), lake.quotes, run)
    run.replace(as_table(_unvalued(spark, sf_dir), schemas.METRICS), lake.metrics)
    refresh(spark, lake, dates=[])
    return read_metrics(spark, lake.metrics)


def quote_objects(spark, sf_dir):
    """Quotes as JSON objects per symbol and day; those without a price are put again, one by one."""
    path = f"{scratch_dir(spark)}/prices"
    put_quotes(_quotes(spark, sf_dir), path)
    lacking = read_quote_objects(spark, path).where(F.col("price").isNull())
    put_quotes(settled(lacking).withColumn("price", F.lit(1.5)), path)
    return read_quote_objects(spark, path)


def quote_objects_import(spark, sf_dir):
    """Quotes that were kept as objects value the transactions."""
    path = f"{scratch_dir(spark)}/prices"
    put_quotes(_quotes(spark, sf_dir), path)
    lake = Lake.under(scratch_dir(spark))
    lake.create(spark)
    store_quotes(read_quote_objects(spark, path), lake.quotes)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    return pricing.priced(read_metrics(spark, lake.metrics))


def stream_quotes(spark, sf_dir):
    """Answers for even days arrive before the transactions, the others after."""
    lake = _lake(spark, sf_dir)
    answers = f"{scratch_dir(spark)}/answers"
    progress = scratch_dir(spark)
    responses = settled(event_responses(_events(spark, sf_dir)))

    def arrive(days):
        responses.where(days).write.mode("append").json(answers)
        arriving = stream_responses(spark, answers)
        reprice_on_arrival(arriving, lake, f"{progress}/answers").awaitTermination()

    arrive(F.day("date") % 2 == 0)
    arriving = stream_transactions(spark, _deliveries(spark, sf_dir))
    refresh_on_arrival(arriving, lake, "events", f"{progress}/events").awaitTermination()
    arrive(F.day("date") % 2 == 1)
    return read_metrics(spark, lake.metrics)


def stream_restart(spark, sf_dir):
    """The stream's progress is lost: the files that were taken up do not count again."""
    lake = _lake(spark, sf_dir)
    folder = _deliveries(spark, sf_dir)
    for most in (3, 1):
        arriving = stream_transactions(spark, folder, max_files_per_trigger=most)
        query = refresh_on_arrival(arriving, lake, "events", f"{scratch_dir(spark)}/progress")
        query.awaitTermination()
    return pricing.priced(read_metrics(spark, lake.metrics))


def _loaded(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    load_delivery(spark, _deliveries(spark, sf_dir), lake)
    refresh(spark, lake)
    return lake


def landed_control_totals(spark, sf_dir):
    """Counts kept at landing against those of the refresh, from what was published alone."""
    return control_totals(spark, _loaded(spark, sf_dir))


def kept_profile(spark, sf_dir):
    """Rows, dates and nulls as counted when the metrics were written."""
    return published_profile(spark, _loaded(spark, sf_dir))


def _spoiled_deliveries(spark, sf_dir):
    """Delivered lines of which errors lack their last cell and sign-ups have one too many."""
    path = f"{scratch_dir(spark)}/spoiled"
    records = event_records(_events(spark, sf_dir))
    quoted = [F.concat(F.lit('"'), F.replace(F.col(x), F.lit('"'), F.lit('""')), F.lit('"')) for x in ("props", "nums")]
    line = (
        F.when(F.col("props").contains("WETH"), F.concat_ws(",", "ts", "project_id", quoted[0]))
        .when(F.col("props").contains("USDC.E"), F.concat_ws(",", "ts", "project_id", *quoted, F.lit("x")))
        .otherwise(F.concat_ws(",", "ts", "project_id", *quoted))
    )
    # A separator that does not occur leaves the lines as they are, below a header of their own.
    lines = records.select(line.alias(",".join(schemas.RAW_COLUMNS))).repartition(4)
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return path


def csv_rejects(spark, sf_dir):
    """Lines kept aside, by what is wrong with them, and the days whose other lines were landed."""
    lake = _lake(spark, sf_dir)
    land_with_quarantine(spark, _spoiled_deliveries(spark, sf_dir), lake, "shop")
    landed = read_landed(spark, lake.bronze).select("date", F.lit("none").alias("problem"))
    problem = F.when(F.col("line").endswith(",x"), F.lit("too many")).otherwise(F.lit("too few"))
    aside = quarantined(spark, lake).where(F.col("file").contains("/spoiled/part-"))
    day = F.to_date(F.substring("line", 1, 10))
    both = landed.unionByName(aside.select(day.alias("date"), problem.alias("problem")))
    return both.groupBy("date", "problem").agg(F.count("*").alias("lines"))


def csv_replay(spark, sf_dir):
    """Lines kept aside are put right and landed after all: the figures are those of whole deliveries."""
    lake = _lake(spark, sf_dir)
    land_with_quarantine(spark, _spoiled_deliveries(spark, sf_dir), lake, "shop")
    refresh(spark, lake)
    amount = F.lit(',"{""currencyValueDecimal"":""1""}"')
    repaired = F.when(F.col("line").endswith(",x"), F.expr("left(line, length(line) - 2)")).otherwise(
        F.concat("line", amount)
    )
    refresh(spark, lake, replay(spark, lake, "shop", repaired))
    return read_metrics(spark, lake.metrics).select(
        "date", "currency_symbol", "project_id", "num_transactions", "raw_volume"
    )


def report_files(spark, sf_dir):
    """A report written as files of JSON lines, read back in the order of the files and lines."""
    path = f"{scratch_dir(spark)}/report"
    report = reports.json_records(reports.daily_volumes(_metrics(spark, sf_dir)))
    write_lines(report, path, most=50)
    return spark.read.text(path).select(F.col("value").alias("record"))


_QUERIES = (
    tx_extract,
    rejected_records,
    daily_project_metrics,
    daily_currency_volumes,
    price_exact,
    price_last_known,
    price_resolved,
    price_source_coverage,
    unpriced_groups,
    usd_valuation,
    missing_quotes,
    quote_response_price,
    quote_upsert,
    metrics_update,
    verify_volumes,
    verify_report_text,
    daily_volumes,
    daily_transactions,
    project_volumes,
    project_totals,
    project_report_text,
    metrics_json,
    metrics_row_count,
    metrics_profile,
    required_nulls,
    count_reconciliation,
    usd_recheck,
    duplicate_keys,
    metrics_validation,
    initial_load,
    rows_loaded,
    metrics_table,
    redelivery,
    landed_responses,
    refresh_metrics,
    quotes_refresh,
    late_quotes,
    stored_update,
    stream_refresh,
    unpublished_run,
    quote_objects,
    quote_objects_import,
    stream_quotes,
    stream_restart,
    landed_control_totals,
    kept_profile,
    csv_rejects,
    csv_replay,
    report_files,
)


def entry(spark: SparkSession) -> DataFrame:
    """Dollar value per date and currency, from transactions to report."""
    return daily_volumes(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run} if corpus_queries else {}
    return {query.__name__: query for query in _QUERIES} | corpus


# --- SQL counterparts -----------------------------------------------------------------------

_TX = """
tx AS (
  SELECT CAST(ts AS DATE) AS date,
         user_id % 10 AS project_id,
         CASE event_type WHEN 'purchase' THEN 'MATIC' WHEN 'click' THEN 'SFL'
              WHEN 'view' THEN 'USDC' WHEN 'signup' THEN 'USDC.E' WHEN 'error' THEN 'WETH'
         END AS currency_symbol,
         COALESCE(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k,
         CAST(COALESCE(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS HUGEINT)
           * CAST(CASE event_type WHEN 'purchase' THEN 1000000000000000000 ELSE 1 END AS HUGEINT)
           AS amount,
         value
  FROM events
)"""

_QUOTES = """
quotes AS (
  SELECT currency_symbol AS symbol, date,
         CASE WHEN (currency_symbol = 'MATIC' AND day(date) = 10)
                OR (currency_symbol = 'SFL' AND day(date) = 17) THEN NULL
              ELSE max(value) END AS price
  FROM tx
  WHERE (currency_symbol = 'MATIC' AND day(date) IN (2, 6, 10, 14, 18, 22, 26, 30))
     OR (currency_symbol = 'SFL' AND day(date) IN (2, 5, 8, 11, 14, 17, 20, 23, 26, 29))
  GROUP BY currency_symbol, date
)"""

_RESPONSES = """
responses AS (
  SELECT currency_symbol AS symbol, date,
         CASE WHEN day(date) IN (3, 10, 24) OR day(date) = 7 THEN NULL ELSE min(value) END AS price
  FROM tx WHERE currency_symbol IN ('MATIC', 'SFL')
  GROUP BY currency_symbol, date
)"""

_MERGED = """
merged AS (
  SELECT symbol, date,
         CASE WHEN q.price <> 0 THEN q.price WHEN r.price <> 0 THEN r.price ELSE q.price END AS price
  FROM quotes q FULL OUTER JOIN (SELECT * FROM responses WHERE price <> 0) r USING (symbol, date)
)"""

# The same with the fetched quotes merged in, under the name the later parts refer to.
_ALL_QUOTES = (
    _QUOTES.replace("quotes AS", "stored AS"),
    _RESPONSES,
    _MERGED.replace("quotes q", "stored q").replace("merged AS", "quotes AS"),
)

_VOLUMES = """
volumes AS (
  SELECT date, currency_symbol, project_id,
         count(amount) AS num_transactions, CAST(sum(amount) AS DOUBLE) AS raw_volume
  FROM tx GROUP BY date, currency_symbol, project_id
)"""

_RESOLVED = """
keys AS (SELECT DISTINCT currency_symbol, date FROM tx),
earlier AS (
  SELECT k.currency_symbol, k.date, arg_max_null(q.price, q.date) AS price
  FROM keys k LEFT JOIN quotes q ON q.symbol = k.currency_symbol AND q.date < k.date
  GROUP BY k.currency_symbol, k.date
),
same_day AS (
  SELECT k.currency_symbol, k.date, nullif(q.price, 0) AS price
  FROM keys k LEFT JOIN quotes q ON q.symbol = k.currency_symbol AND q.date = k.date
),
resolved AS (
  SELECT currency_symbol, date,
         CASE WHEN currency_symbol IN ('USDC', 'USDC.E') THEN 1.0
              WHEN s.price IS NOT NULL THEN s.price
              WHEN currency_symbol IN ('MATIC', 'SFL') THEN nullif(e.price, 0)
         END AS price,
         CASE WHEN currency_symbol IN ('USDC', 'USDC.E') THEN 'peg'
              WHEN s.price IS NOT NULL THEN 'exact'
              WHEN currency_symbol IN ('MATIC', 'SFL') AND nullif(e.price, 0) IS NOT NULL
                THEN 'last_known'
              ELSE 'unpriced' END AS price_source
  FROM same_day s JOIN earlier e USING (currency_symbol, date)
)"""

_METRICS = """
metrics AS (
  SELECT date, project_id, currency_symbol, num_transactions, raw_volume, price, price_source,
         CASE WHEN currency_symbol IN ('USDC', 'USDC.E') THEN raw_volume
              WHEN currency_symbol = 'MATIC' THEN raw_volume / 1e18 * price
              ELSE raw_volume * price END AS usd_volume
  FROM volumes JOIN resolved USING (currency_symbol, date)
)"""

_UPDATED = """
updated AS (
  SELECT date, currency_symbol, project_id, num_transactions, raw_volume,
         price, CASE WHEN price IS NOT NULL THEN price_source END AS price_source,
         COALESCE(usd_volume, raw_volume) AS usd_volume,
         usd_volume AS expected_usd_volume
  FROM metrics
)"""

_CENTS = "CAST(round(sum(CAST(usd_volume AS DECIMAL(38, 6))), 2) AS DOUBLE)"


def _sql(*parts: str) -> str:
    """The last part is the query, the others its common table expressions."""
    return f"WITH {','.join(parts[:-1])}\n{parts[-1]}"


def _over_metrics(query: str) -> str:
    return _sql(_TX, _QUOTES, _VOLUMES, _RESOLVED, _METRICS, query)


_PRICED = """
SELECT date, project_id, currency_symbol, num_transactions, raw_volume, price, price_source,
       usd_volume
FROM metrics WHERE price IS NOT NULL"""

_DAILY = f"""
SELECT date, currency_symbol, count(*) AS transactions, {_CENTS} AS total_usd_volume
FROM metrics GROUP BY date, currency_symbol"""

_PROJECT = f"""
SELECT project_id, currency_symbol, count(*) AS total_transactions,
       {_CENTS} AS total_project_volume
FROM metrics GROUP BY project_id, currency_symbol"""

_PROJECT_METRICS = """
SELECT date, project_id, count(amount) AS num_transactions, CAST(sum(amount) AS DOUBLE) AS raw_volume
FROM tx GROUP BY date, project_id"""


def oracle_sql() -> dict[str, str]:
    corpus = dict(corpus_queries.ORACLE_SQL) if corpus_queries else {}
    if corpus_queries and corpus_pipeline.ORACLE_SQL:
        corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus | {
        "tx_extract": """
SELECT event_id, CAST(ts AS DATE) AS date,
       CASE event_type WHEN 'purchase' THEN 'MATIC' WHEN 'click' THEN 'SFL'
            WHEN 'view' THEN 'USDC' WHEN 'signup' THEN 'USDC.E' WHEN 'error' THEN 'WETH'
       END AS currency_symbol,
       COALESCE(json_extract_string(props, '$.k'), '') AS present_text,
       COALESCE(json_extract_string(props, '$.missing'), '') AS absent_text,
       COALESCE(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS present_number,
       COALESCE(CAST(json_extract_string(props, '$.missing') AS DOUBLE), 0) AS absent_number
FROM events""",
        "rejected_records": _sql(_TX, """
SELECT project_id,
       CASE currency_symbol WHEN 'USDC.E' THEN 'props' WHEN 'WETH' THEN 'amount' ELSE 'none'
       END AS problem,
       count(*) AS records,
       CAST(sum(CASE WHEN currency_symbol NOT IN ('USDC.E', 'WETH') THEN k END) AS DOUBLE) AS amount
FROM tx GROUP BY 1, 2"""),
        "daily_project_metrics": _sql(_TX, _PROJECT_METRICS),
        "daily_currency_volumes": _sql(_TX, _VOLUMES, "SELECT * FROM volumes"),
        "price_exact": _sql(_TX, _QUOTES, _RESOLVED, "SELECT * FROM same_day"),
        "price_last_known": _sql(
            _TX, _QUOTES, _RESOLVED,
            "SELECT currency_symbol, date, nullif(price, 0) AS price FROM earlier",
        ),
        "price_resolved": _sql(_TX, _QUOTES, _RESOLVED, "SELECT * FROM resolved"),
        "price_source_coverage": _over_metrics("""
SELECT price_source, count(*) AS groups,
       CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
       count(*) / (SELECT count(*) FROM metrics) AS share
FROM metrics GROUP BY price_source"""),
        "unpriced_groups": _over_metrics("""
SELECT date, currency_symbol, project_id, num_transactions, raw_volume
FROM metrics WHERE price IS NULL"""),
        "usd_valuation": _over_metrics(_PRICED),
        "missing_quotes": _sql(_TX, _QUOTES, _RESOLVED, """
SELECT currency_symbol AS symbol, date,
       CASE currency_symbol WHEN 'MATIC' THEN 'matic-network' ELSE 'sunflower-land' END AS coin_id,
       'https://api.coingecko.com/api/v3/coins/'
         || CASE currency_symbol WHEN 'MATIC' THEN 'matic-network' ELSE 'sunflower-land' END
         || '/history?date=' || strftime(date, '%d-%m-%Y') || '&localization=false' AS request_url,
       'prices/' || currency_symbol || '/' || strftime(date, '%Y-%m-%d') || '.json' AS quote_key
FROM same_day WHERE currency_symbol IN ('MATIC', 'SFL') AND price IS NULL"""),
        "quote_response_price": _sql(_TX, _RESPONSES, "SELECT * FROM responses"),
        "quote_upsert": _sql(_TX, _QUOTES, _RESPONSES, _MERGED, "SELECT * FROM merged"),
        "metrics_update": _sql(
            _TX, _QUOTES, _VOLUMES, _RESOLVED, _METRICS, _UPDATED,
            "SELECT * EXCLUDE (expected_usd_volume) FROM updated",
        ),
        "verify_volumes": _over_metrics("""
SELECT date, currency_symbol, count(*) AS transactions,
       CAST(round(sum(CAST(usd_volume AS DECIMAL(38, 9))), 6) AS DOUBLE) AS total_usd_volume
FROM metrics GROUP BY date, currency_symbol"""),
        "verify_report_text": _over_metrics("""
SELECT date, currency_symbol, count(*) AS transactions,
       COALESCE(format('{:.2f}', CAST(sum(CAST(usd_volume AS DECIMAL(38, 9))) AS DOUBLE)), 'nan')
         AS total_usd_volume
FROM metrics GROUP BY date, currency_symbol"""),
        "daily_volumes": _over_metrics(_DAILY),
        "daily_transactions": _over_metrics(f"""
SELECT date, currency_symbol, CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
       {_CENTS} AS total_usd_volume
FROM metrics GROUP BY date, currency_symbol"""),
        "project_volumes": _over_metrics(_PROJECT),
        "project_totals": _over_metrics(f"""
SELECT project_id, CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
       {_CENTS} AS total_usd_volume
FROM metrics GROUP BY project_id"""),
        "project_report_text": _over_metrics(f"""
SELECT project_id, currency_symbol,
       'Project ' || project_id || ' - ' || currency_symbol || ':' AS heading,
       '  Transactions: ' || total_transactions AS transactions_line,
       '  Total Volume: $' || COALESCE(format('{{:,.2f}}', total_project_volume), 'nan') AS volume_line
FROM ({_PROJECT})"""),
        "metrics_json": _over_metrics(f"""
SELECT CAST(to_json(struct_pack(
         currency_symbol := currency_symbol,
         date := strftime(date, '%a, %d %b %Y 00:00:00 GMT'),
         total_usd_volume := total_usd_volume,
         transactions := transactions)) AS VARCHAR) AS record
FROM ({_DAILY})"""),
        "metrics_row_count": _over_metrics("SELECT count(*) AS row_count FROM metrics"),
        "metrics_profile": _over_metrics("""
SELECT count(*) AS total_rows, count(DISTINCT date) AS unique_dates,
       count(DISTINCT project_id) AS unique_projects,
       CAST(sum(CASE WHEN usd_volume IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_volumes
FROM metrics"""),
        "required_nulls": _over_metrics("""
SELECT count(*) - count(date) AS null_date,
       count(*) - count(project_id) AS null_project_id,
       count(*) - count(num_transactions) AS null_num_transactions,
       count(*) - count(usd_volume) AS null_usd_volume
FROM metrics"""),
        "count_reconciliation": _sql(_TX, """
SELECT date, count(amount) AS source_count, count(amount) AS metrics_count, true AS matches
FROM tx GROUP BY date"""),
        "usd_recheck": _sql(
            _TX, _QUOTES, _VOLUMES, _RESOLVED, _METRICS, _UPDATED, """
SELECT date, currency_symbol, project_id, usd_volume, expected_usd_volume
FROM updated WHERE usd_volume IS DISTINCT FROM expected_usd_volume""",
        ),
        "duplicate_keys": _over_metrics("""
SELECT date, currency_symbol, project_id, CAST(2 AS BIGINT) AS copies
FROM metrics WHERE price IS NOT NULL"""),
        "metrics_validation": _over_metrics("""
SELECT true AS readable, count(*) = count(usd_volume) AS complete,
       (SELECT bool_and(total_project_volume IS NOT NULL) FROM ("""
            + _PROJECT
            + """)) AS displayable,
       count(*) = count(usd_volume) AS ok
FROM metrics"""),
        "initial_load": _sql(_TX, _PROJECT_METRICS),
        "rows_loaded": _sql(_TX, f"SELECT count(*) AS rows_loaded FROM ({_PROJECT_METRICS})"),
        "metrics_table": _over_metrics(_PRICED),
        "redelivery": _over_metrics(_PRICED),
        "landed_responses": _sql(_TX, _RESPONSES, "SELECT * FROM responses"),
        "refresh_metrics": _over_metrics(_PRICED),
        "quotes_refresh": _sql(_TX, _QUOTES, _RESPONSES, _MERGED, """
SELECT DISTINCT t.currency_symbol AS symbol, t.date
FROM tx t LEFT JOIN merged m ON m.symbol = t.currency_symbol AND m.date = t.date
WHERE t.currency_symbol IN ('MATIC', 'SFL') AND nullif(m.price, 0) IS NULL"""),
        "late_quotes": _sql(
            _TX, *_ALL_QUOTES, _VOLUMES, _RESOLVED, _METRICS, "SELECT * FROM metrics"
        ),
        "stored_update": _sql(
            _TX, _QUOTES, _VOLUMES, _RESOLVED, _METRICS, _UPDATED,
            "SELECT * EXCLUDE (expected_usd_volume) FROM updated",
        ),
        "stream_refresh": _over_metrics(_PRICED),
        "unpublished_run": _over_metrics("SELECT * FROM metrics"),
        "quote_objects": _sql(
            _TX, _QUOTES, "SELECT symbol, date, COALESCE(price, 1.5) AS price FROM quotes"
        ),
        "quote_objects_import": _over_metrics(_PRICED),
        "stream_quotes": _sql(
            _TX, *_ALL_QUOTES, _VOLUMES, _RESOLVED, _METRICS, "SELECT * FROM metrics"
        ),
        "stream_restart": _over_metrics(_PRICED),
        "landed_control_totals": _sql(_TX, """
SELECT date, count(*) AS landed, count(*) AS read, count(amount) AS countable,
       count(amount) AS counted, true AS matches
FROM tx GROUP BY date"""),
        "kept_profile": _over_metrics("""
SELECT count(*) AS total_rows, count(*) - count(date) AS null_date,
       count(*) - count(project_id) AS null_project_id,
       count(*) - count(num_transactions) AS null_num_transactions,
       count(*) - count(usd_volume) AS null_usd_volume, count(DISTINCT date) AS unique_dates
FROM metrics"""),
        "csv_rejects": _sql(_TX, """
SELECT date, CASE currency_symbol WHEN 'WETH' THEN 'too few' WHEN 'USDC.E' THEN 'too many' ELSE 'none'
       END AS problem, count(*) AS lines
FROM tx GROUP BY 1, 2"""),
        "csv_replay": _sql(_TX, """
SELECT date, currency_symbol, project_id, count(amount) AS num_transactions,
       CAST(sum(CASE currency_symbol WHEN 'WETH' THEN 1 ELSE amount END) AS DOUBLE) AS raw_volume
FROM tx GROUP BY date, currency_symbol, project_id"""),
        "report_files": _over_metrics(f"""
SELECT CAST(to_json(struct_pack(
         currency_symbol := currency_symbol,
         date := strftime(date, '%a, %d %b %Y 00:00:00 GMT'),
         total_usd_volume := total_usd_volume,
         transactions := transactions)) AS VARCHAR) AS record
FROM ({_DAILY})"""),
    }
