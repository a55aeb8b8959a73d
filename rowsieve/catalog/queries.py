"""Registered queries on the driver's tables, each with a DuckDB oracle.

Every query reads whole tables from ``sf_dir``; the only derived inputs are
``nullif`` / ``case`` columns that give rules something to catch (the
tables hold no NULLs).  Verdicts are emitted as ``failed_rules`` text
(``array_join(…, ',')``) so both engines hash a string.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.operators import report
from rowsieve.operators.quantiles import quantiles
from rowsieve.operators.reconcile import changed_keys, reconcile
from rowsieve.operators.state import KeptState
from rowsieve.operators.validate import ValidationResult, validate
from rowsieve.session import work_folder


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def verdict_text(col: str = "failed_rules"):
    return F.array_join(F.col(col), ",").alias(col)


def rejected(result: ValidationResult, *cols: str) -> DataFrame:
    """Rejected rows: chosen columns plus the verdict as text."""
    return result.bad.select(*cols, verdict_text(result.verdict_col))


# ---------------------------------------------------------------------------
# Row-local rules
# ---------------------------------------------------------------------------
@query(
    "q01_null_check",
    """SELECT c_custkey, segment, 'segment_present' AS failed_rules
       FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
       WHERE segment IS NULL""",
)
def q01(spark, sf_dir):
    """R1 null_check on customer segment (BUILDING made NULL)."""
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment")
    )
    rules = [{"name": "segment_present", "type": "null_check", "column": "segment", "priority": 1}]
    return rejected(validate(df, rules), "c_custkey", "segment")


@query(
    "q02_regex_match",
    """SELECT page_id, url, 'url_is_https' AS failed_rules
       FROM pages WHERE NOT regexp_matches(url, '^https://')""",
)
def q02(spark, sf_dir):
    """R2 regex_match: page URLs must start with https://."""
    df = table(spark, sf_dir, "pages")
    rules = [{"name": "url_is_https", "type": "regex_match", "column": "url", "pattern": "^https://", "priority": 1}]
    return rejected(validate(df, rules), "page_id", "url")


@query(
    "q03_value_range",
    """SELECT l_orderkey, l_linenumber, l_quantity, 'quantity_5_45' AS failed_rules
       FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45 OR isnan(l_quantity)""",
)
def q03(spark, sf_dir):
    """R3 value_range: lineitem quantity within 5..45."""
    df = table(spark, sf_dir, "lineitem")
    rules = [{"name": "quantity_5_45", "type": "value_range", "column": "l_quantity", "min": 5, "max": 45, "priority": 1}]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber", "l_quantity")


@query(
    "q04_allowed_values",
    """SELECT event_id, event_type, 'known_event_type' AS failed_rules
       FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')""",
)
def q04(spark, sf_dir):
    """R4 allowed_values: event types click / view / purchase."""
    df = table(spark, sf_dir, "events")
    rules = [
        {
            "name": "known_event_type",
            "type": "allowed_values",
            "column": "event_type",
            "allowed_values": ["click", "view", "purchase"],
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules), "event_id", "event_type")


@query(
    "q05_date_format",
    """SELECT p_partkey, ship_day, 'ship_day_format' AS failed_rules
       FROM (SELECT p_partkey, '1998-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-15' AS ship_day FROM part)
       WHERE try_strptime(ship_day, '%Y-%m-%d') IS NULL""",
)
def q05(spark, sf_dir):
    """R5 date_format: a yyyy-MM-dd text built from p_size as the month."""
    df = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("1998-"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("-15")).alias("ship_day"),
    )
    rules = [{"name": "ship_day_format", "type": "date_format", "column": "ship_day", "format": "yyyy-MM-dd", "priority": 1}]
    return rejected(validate(df, rules), "p_partkey", "ship_day")


@query(
    "q06_length_check",
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS text_length, 'text_length_200_20000' AS failed_rules
       FROM documents WHERE text IS NULL OR length(text) < 200 OR length(text) > 20000""",
)
def q06(spark, sf_dir):
    """R6 length_check: document text of 200..20000 characters (whole text)."""
    df = table(spark, sf_dir, "documents")
    rules = [
        {"name": "text_length_200_20000", "type": "length_check", "column": "text", "min_length": 200, "max_length": 20000, "priority": 1}
    ]
    r = validate(df, rules)
    return r.bad.select("doc_id", F.length("text").cast("bigint").alias("text_length"), verdict_text())


@query(
    "q07_cross_column",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax, 'discount_le_tax' AS failed_rules
       FROM lineitem WHERE l_discount <= l_tax""",
)
def q07(spark, sf_dir):
    """R7 cross_column: the condition text is the violation (TRUE fails)."""
    df = table(spark, sf_dir, "lineitem")
    rules = [
        {
            "name": "discount_le_tax",
            "type": "cross_column",
            "columns": ["l_discount", "l_tax"],
            "condition": "l_discount <= l_tax",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query(
    "q08_completeness",
    """SELECT c_custkey, 'segment_and_nation' AS failed_rules
       FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, nullif(c_nationkey, 3) AS nation FROM customer)
       WHERE segment IS NULL OR nation IS NULL""",
)
def q08(spark, sf_dir):
    """R8 completeness_check over two derived nullable columns."""
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.expr("nullif(c_nationkey, 3)").alias("nation"),
    )
    rules = [{"name": "segment_and_nation", "type": "completeness_check", "columns": ["segment", "nation"], "priority": 1}]
    return rejected(validate(df, rules), "c_custkey")


@query(
    "q09_time_difference",
    """SELECT l_orderkey, l_linenumber, 'ship_within_30_days' AS failed_rules
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE o_orderdate IS NULL OR l_shipdate IS NULL
          OR floor(epoch(l_shipdate)) - floor(epoch(o_orderdate)) > 2592000""",
)
def q09(spark, sf_dir):
    """R9 time_difference: order date → ship date over 30 days (lineitem ⋈ orders)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    df = li.join(o, li.l_orderkey == o.o_orderkey)
    rules = [
        {
            "name": "ship_within_30_days",
            "type": "time_difference",
            "columns": ["o_orderdate", "l_shipdate"],
            "max_duration": "30 DAYS",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------
# Dataset-level rules
# ---------------------------------------------------------------------------
@query(
    "q10_unique",
    """SELECT doc_id, 'text_unique' AS failed_rules FROM documents
       WHERE text IN (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)""",
)
def q10(spark, sf_dir):
    """G1 unique_check on whole document texts: every copy fails."""
    df = table(spark, sf_dir, "documents")
    rules = [{"name": "text_unique", "type": "unique_check", "column": "text", "priority": 1}]
    return rejected(validate(df, rules), "doc_id")


@query(
    "q11_unique_null_keys",
    """WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang_key FROM documents)
       SELECT doc_id, lang_key, 'lang_unique' AS failed_rules FROM d
       WHERE lang_key IN (SELECT lang_key FROM d WHERE lang_key IS NOT NULL GROUP BY lang_key HAVING count(*) > 1)""",
)
def q11(spark, sf_dir):
    """G1 with NULL keys: NULL keys never count as duplicates."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.expr("nullif(lang, 'en')").alias("lang_key"))
    rules = [{"name": "lang_unique", "type": "unique_check", "column": "lang_key", "priority": 1}]
    return rejected(validate(df, rules), "doc_id", "lang_key")


@query(
    "q12_unique_composite",
    """SELECT l.l_orderkey, l.l_linenumber, 'line_unique' AS failed_rules
       FROM lineitem l JOIN (
         SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem
         WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
         GROUP BY 1, 2 HAVING count(*) > 1) d
       ON l.l_orderkey = d.k AND l.l_linenumber = d.n""",
)
def q12(spark, sf_dir):
    """G1 composite key (l_orderkey, l_linenumber)."""
    df = table(spark, sf_dir, "lineitem")
    rules = [{"name": "line_unique", "type": "unique_check", "columns": ["l_orderkey", "l_linenumber"], "priority": 1}]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber")


@query(
    "q13_referential",
    """SELECT doc_id, 'doc_labelled' AS failed_rules FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def q13(spark, sf_dir):
    """G2 referential_integrity: documents.doc_id → labels.doc_id."""
    df = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    rules = [
        {
            "name": "doc_labelled",
            "type": "referential_integrity",
            "column": "doc_id",
            "reference_table": "labels",
            "reference_column": "doc_id",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules, refs={"labels": labels}), "doc_id")


@query(
    "q14_referential_filtered",
    """SELECT event_id, user_id, 'user_is_building_customer' AS failed_rules FROM events
       WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def q14(spark, sf_dir):
    """G2 against a filtered reference (BUILDING customers)."""
    df = table(spark, sf_dir, "events")
    building = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    rules = [
        {
            "name": "user_is_building_customer",
            "type": "referential_integrity",
            "column": "user_id",
            "reference_table": "building_customers",
            "reference_column": "c_custkey",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules, refs={"building_customers": building}), "event_id", "user_id")


@query(
    "q15_zscore_events",
    """SELECT event_id, value, 'value_zscore_3' AS failed_rules FROM events
       WHERE abs((value - (SELECT avg(value) FROM events))
                 / nullif((SELECT stddev_samp(value) FROM events), 0)) > 3""",
)
def q15a(spark, sf_dir):
    """G3 z-score of events.value above 3."""
    df = table(spark, sf_dir, "events")
    rules = [{"name": "value_zscore_3", "type": "statistical", "column": "value", "statistic": "z_score", "threshold": 3, "priority": 1}]
    return rejected(validate(df, rules), "event_id", "value")


@query(
    "q15_zscore_documents",
    """SELECT doc_id, n_chars, 'n_chars_zscore_3' AS failed_rules FROM documents
       WHERE abs((n_chars - (SELECT avg(n_chars) FROM documents))
                 / nullif((SELECT stddev_samp(n_chars) FROM documents), 0)) > 3""",
)
def q15b(spark, sf_dir):
    """G3 z-score of documents.n_chars above 3."""
    df = table(spark, sf_dir, "documents")
    rules = [{"name": "n_chars_zscore_3", "type": "statistical", "column": "n_chars", "statistic": "z_score", "threshold": 3, "priority": 1}]
    return rejected(validate(df, rules), "doc_id", "n_chars")


# ---------------------------------------------------------------------------
# Flagship: verdict per row, counts, summary, split
# ---------------------------------------------------------------------------
EVENT_RULES = [
    {"name": "value_in_range", "type": "value_range", "column": "value", "min": 1, "max": 20, "priority": 1},
    {
        "name": "known_event_type",
        "type": "allowed_values",
        "column": "event_type",
        "allowed_values": ["click", "view", "purchase"],
        "priority": 2,
    },
]
_EVENT_FLAGS = """SELECT event_id, event_type, value,
         (value < 1 OR value > 20 OR isnan(value)) AS f_value,
         (event_type NOT IN ('click', 'view', 'purchase')) AS f_type
       FROM events"""


def validate_events(spark: SparkSession, sf_dir: str) -> ValidationResult:
    return validate(table(spark, sf_dir, "events"), EVENT_RULES)


@query(
    "q16_flagship",
    f"""SELECT event_id, event_type, value,
         concat_ws(',', CASE WHEN f_value THEN 'value_in_range' END,
                        CASE WHEN f_type THEN 'known_event_type' END) AS failed_rules
       FROM ({_EVENT_FLAGS})""",
)
def q16(spark, sf_dir):
    """A1/A2 flagship: every event with the names of the rules it violates."""
    r = validate_events(spark, sf_dir)
    return r.flagged.select("event_id", "event_type", "value", verdict_text())


@query(
    "q17_rule_counts",
    f"""SELECT 'value_in_range' AS rule, 'value_range' AS rule_type, 1 AS priority,
              CAST(count_if(f_value) AS BIGINT) AS failed_count FROM ({_EVENT_FLAGS})
       UNION ALL
       SELECT 'known_event_type', 'allowed_values', 2, CAST(count_if(f_type) AS BIGINT) FROM ({_EVENT_FLAGS})""",
)
def q17(spark, sf_dir):
    """Violations per rule from one aggregate."""
    return validate_events(spark, sf_dir).violations.select("rule", "rule_type", "priority", "failed_count")


@query(
    "q18_summary",
    """WITH f AS (SELECT (value < 1 OR value > 20 OR isnan(value)) AS v FROM events),
            c AS (SELECT count(*) AS n, CAST(count_if(v) AS BIGINT) AS bad FROM f)
       SELECT n AS total_records, n - bad AS passed_records, bad AS rejected_records,
              round(CASE WHEN n > 0 THEN (n - bad) / n * 100.0 ELSE 0.0 END, 4) AS quality_pct
       FROM c""",
)
def q18(spark, sf_dir):
    """Total / passed / rejected / quality % for value within 1..20."""
    r = validate(table(spark, sf_dir, "events"), EVENT_RULES[:1])
    s = r.summary
    return s.select("total_records", "passed_records", "rejected_records", F.round("quality_pct", 4).alias("quality_pct"))


@query(
    "q19_good_split",
    f"SELECT event_id, event_type, value FROM ({_EVENT_FLAGS}) WHERE NOT coalesce(f_value OR f_type, false)",
)
def q19g(spark, sf_dir):
    """A4: rows passing every rule, input columns only."""
    return validate_events(spark, sf_dir).good.select("event_id", "event_type", "value")


@query(
    "q19_bad_split",
    f"""SELECT event_id,
         concat_ws(',', CASE WHEN f_value THEN 'value_in_range' END,
                        CASE WHEN f_type THEN 'known_event_type' END) AS failed_rules
       FROM ({_EVENT_FLAGS}) WHERE coalesce(f_value OR f_type, false)""",
)
def q19b(spark, sf_dir):
    """A5: rows failing at least one rule, with their rules."""
    return rejected(validate_events(spark, sf_dir), "event_id")


# ---------------------------------------------------------------------------
# Extensions R10–R12
# ---------------------------------------------------------------------------
@query(
    "q22_data_type",
    """SELECT p_partkey, size_text, 'size_is_int' AS failed_rules
       FROM (SELECT p_partkey, CASE WHEN p_size > 40 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS size_text FROM part)
       WHERE size_text IS NOT NULL AND try_cast(size_text AS INTEGER) IS NULL""",
)
def q22(spark, sf_dir):
    """R10 data_type (extension): text that does not cast to int."""
    df = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("CASE WHEN p_size > 40 THEN p_type ELSE CAST(p_size AS STRING) END").alias("size_text"),
    )
    rules = [{"name": "size_is_int", "type": "data_type", "column": "size_text", "expected_type": "int", "priority": 1}]
    return rejected(validate(df, rules), "p_partkey", "size_text")


@query(
    "q23_date_range",
    """SELECT o_orderkey, 'order_date_1996_2000' AS failed_rules FROM orders
       WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01' OR CAST(o_orderdate AS DATE) > DATE '2000-12-31'""",
)
def q23(spark, sf_dir):
    """R11 date_range (extension): order dates within 1996..2000."""
    df = table(spark, sf_dir, "orders")
    rules = [
        {
            "name": "order_date_1996_2000",
            "type": "date_range",
            "column": "o_orderdate",
            "min_date": "1996-01-01",
            "max_date": "2000-12-31",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules), "o_orderkey")


@query(
    "q24_time_range",
    """SELECT event_id, 'business_hours' AS failed_rules FROM events
       WHERE strftime(ts, '%H:%M:%S') < '09:00:00' OR strftime(ts, '%H:%M:%S') > '20:59:59'""",
)
def q24(spark, sf_dir):
    """R12 time_range (extension): event time of day within 09:00:00..20:59:59."""
    df = table(spark, sf_dir, "events")
    rules = [
        {"name": "business_hours", "type": "time_range", "column": "ts", "min_time": "09:00:00", "max_time": "20:59:59", "priority": 1}
    ]
    return rejected(validate(df, rules), "event_id")


# ---------------------------------------------------------------------------
# Q25: row-local + G1 + G2 + G3 composed on documents
# ---------------------------------------------------------------------------
DOCUMENT_RULES = [
    {"name": "text_min_200", "type": "length_check", "column": "text", "min_length": 200, "priority": 1},
    {"name": "text_unique", "type": "unique_check", "column": "text", "priority": 2},
    {
        "name": "doc_labelled",
        "type": "referential_integrity",
        "column": "doc_id",
        "reference_table": "labels",
        "reference_column": "doc_id",
        "priority": 3,
    },
    {"name": "n_chars_zscore_3", "type": "statistical", "column": "n_chars", "statistic": "z_score", "threshold": 3, "priority": 4},
]


@query(
    "q25_documents_composite",
    """WITH s AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS sd FROM documents),
            dup AS (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1),
            f AS (
              SELECT d.doc_id,
                     (d.text IS NULL OR length(d.text) < 200) AS f1,
                     (d.text IN (SELECT text FROM dup)) AS f2,
                     (d.doc_id NOT IN (SELECT doc_id FROM labels)) AS f3,
                     (abs((d.n_chars - (SELECT m FROM s)) / nullif((SELECT sd FROM s), 0)) > 3) AS f4
              FROM documents d)
       SELECT doc_id,
              concat_ws(',', CASE WHEN f1 THEN 'text_min_200' END, CASE WHEN f2 THEN 'text_unique' END,
                             CASE WHEN f3 THEN 'doc_labelled' END, CASE WHEN f4 THEN 'n_chars_zscore_3' END) AS failed_rules
       FROM f WHERE coalesce(f1 OR f2 OR f3 OR f4, false)""",
)
def q25(spark, sf_dir):
    """A1 with length + unique + referential + z-score rules in one plan."""
    df = table(spark, sf_dir, "documents")
    r = validate(df, DOCUMENT_RULES, refs={"labels": table(spark, sf_dir, "labels")})
    return rejected(r, "doc_id")


# ---------------------------------------------------------------------------
# Controls: checks that hold on the generated data (zero violations)
# ---------------------------------------------------------------------------
@query(
    "q26_fk_lineitem_orders",
    "SELECT l_orderkey, l_linenumber, 'order_exists' AS failed_rules FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
)
def q26(spark, sf_dir):
    """Control: every lineitem has its order."""
    rules = [
        {
            "name": "order_exists",
            "type": "referential_integrity",
            "column": "l_orderkey",
            "reference_table": "orders",
            "reference_column": "o_orderkey",
            "priority": 1,
        }
    ]
    r = validate(table(spark, sf_dir, "lineitem"), rules, refs={"orders": table(spark, sf_dir, "orders")})
    return rejected(r, "l_orderkey", "l_linenumber")


@query(
    "q27_unique_page_url",
    """SELECT page_id, 'url_unique' AS failed_rules FROM pages
       WHERE url IN (SELECT url FROM pages WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1)""",
)
def q27(spark, sf_dir):
    """Control: page URLs are unique."""
    rules = [{"name": "url_unique", "type": "unique_check", "column": "url", "priority": 1}]
    return rejected(validate(table(spark, sf_dir, "pages"), rules), "page_id")


# ---------------------------------------------------------------------------
# The full rule set: all 15 rule types in one validation of lineitem ⋈ orders
# (the analogue of a shipped multi-rule configuration).  Used by the report
# queries (P1–P5, A8, A9) and the benchmark.
# ---------------------------------------------------------------------------
FULL_RULES = [
    {"name": "priority_present", "type": "null_check", "column": "priority_n", "priority": 1, "entity": "orders"},
    {"name": "line_unique", "type": "unique_check", "columns": ["l_orderkey", "l_linenumber"], "priority": 1, "entity": "lineitem"},
    {"name": "returnflag_code", "type": "regex_match", "column": "l_returnflag", "pattern": "^[AR]$", "priority": 2},
    {"name": "quantity_1_45", "type": "value_range", "column": "l_quantity", "min": 1, "max": 45, "priority": 2},
    {"name": "status_known", "type": "allowed_values", "column": "o_orderstatus", "allowed_values": ["F", "O"], "priority": 2},
    {"name": "batch_day_format", "type": "date_format", "column": "batch_day", "format": "yyyy-MM-dd", "priority": 3},
    {"name": "priority_text_length", "type": "length_check", "column": "o_orderpriority", "min_length": 6, "max_length": 15, "priority": 3},
    {
        "name": "discount_over_tax",
        "type": "cross_column",
        "columns": ["l_discount", "l_tax"],
        "condition": "l_discount > l_tax + 0.05",
        "priority": 1,
    },
    {"name": "order_fields_complete", "type": "completeness_check", "columns": ["priority_n", "status_n"], "priority": 1},
    {
        "name": "part_is_small",
        "type": "referential_integrity",
        "column": "l_partkey",
        "reference_table": "small_parts",
        "reference_column": "p_partkey",
        "priority": 1,
    },
    {"name": "price_outlier", "type": "statistical", "column": "l_extendedprice", "statistic": "z_score", "threshold": 2.5, "priority": 3},
    {
        "name": "ship_within_year",
        "type": "time_difference",
        "columns": ["o_orderdate", "l_shipdate"],
        "max_duration": "365 DAYS",
        "priority": 2,
    },
    {"name": "quantity_text_int", "type": "data_type", "column": "quantity_text", "expected_type": "int", "priority": 4},
    {"name": "order_date_window", "type": "date_range", "column": "o_orderdate", "min_date": "1995-01-01", "max_date": "1998-12-31", "priority": 4},
    {"name": "ship_before_noon", "type": "time_range", "column": "l_shipdate", "min_time": "00:00:00", "max_time": "12:00:00", "priority": 5},
]
FULL_KEYS = ["l_orderkey", "l_linenumber"]


def full_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_shipdate",
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
        F.expr("nullif(o_orderpriority, '1-URGENT')").alias("priority_n"),
        F.expr("nullif(o_orderstatus, 'P')").alias("status_n"),
        F.expr("concat('1998-', lpad(CAST(l_suppkey % 16 AS STRING), 2, '0'), '-01')").alias("batch_day"),
        F.expr(
            "CASE WHEN l_quantity > 45 THEN l_returnflag ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"
        ).alias("quantity_text"),
    )


def validate_full(spark: SparkSession, sf_dir: str) -> ValidationResult:
    small_parts = table(spark, sf_dir, "part").where(F.col("p_size") <= 40)
    return validate(full_input(spark, sf_dir), FULL_RULES, refs={"small_parts": small_parts})


# DuckDB: the same input with one boolean per rule, in rule (priority) order.
_FULL_FLAGS_SQL = """
WITH lo AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_shipdate, o_orderstatus, o_orderpriority, o_orderdate,
         nullif(o_orderpriority, '1-URGENT') AS priority_n,
         nullif(o_orderstatus, 'P') AS status_n,
         '1998-' || lpad(CAST(l_suppkey % 16 AS VARCHAR), 2, '0') || '-01' AS batch_day,
         CASE WHEN l_quantity > 45 THEN l_returnflag ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity_text
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
dup AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lo
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
st AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM lo),
fl AS (
  SELECT lo.l_orderkey, lo.l_linenumber,
    priority_n IS NULL AS f01,
    dup.k IS NOT NULL AS f02,
    (l_discount > l_tax + 0.05) AS f03,
    (priority_n IS NULL OR status_n IS NULL) AS f04,
    (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)) AS f05,
    NOT regexp_matches(l_returnflag, '^[AR]$') AS f06,
    (l_quantity < 1 OR l_quantity > 45 OR isnan(l_quantity)) AS f07,
    (o_orderstatus NOT IN ('F', 'O')) AS f08,
    (o_orderdate IS NULL OR l_shipdate IS NULL
       OR floor(epoch(l_shipdate)) - floor(epoch(o_orderdate)) > 31536000) AS f09,
    (try_strptime(batch_day, '%Y-%m-%d') IS NULL) AS f10,
    (o_orderpriority IS NULL OR length(o_orderpriority) < 6 OR length(o_orderpriority) > 15) AS f11,
    (abs((l_extendedprice - (SELECT m FROM st)) / nullif((SELECT sd FROM st), 0)) > 2.5) AS f12,
    (quantity_text IS NOT NULL AND try_cast(quantity_text AS INTEGER) IS NULL) AS f13,
    (CAST(o_orderdate AS DATE) < DATE '1995-01-01' OR CAST(o_orderdate AS DATE) > DATE '1998-12-31') AS f14,
    (strftime(l_shipdate, '%H:%M:%S') < '00:00:00' OR strftime(l_shipdate, '%H:%M:%S') > '12:00:00') AS f15
  FROM lo LEFT JOIN dup ON lo.l_orderkey = dup.k AND lo.l_linenumber = dup.n)
"""
# rule names in evaluation (priority, then file) order, matching f01..f15
_FULL_ORDER = [
    "priority_present",
    "line_unique",
    "discount_over_tax",
    "order_fields_complete",
    "part_is_small",
    "returnflag_code",
    "quantity_1_45",
    "status_known",
    "ship_within_year",
    "batch_day_format",
    "priority_text_length",
    "price_outlier",
    "quantity_text_int",
    "order_date_window",
    "ship_before_noon",
]
_FULL_TEXT = "concat_ws(',', " + ", ".join(
    f"CASE WHEN f{i + 1:02d} THEN '{n}' END" for i, n in enumerate(_FULL_ORDER)
) + ")"
_FULL_ANY = "coalesce(" + " OR ".join(f"f{i + 1:02d}" for i in range(len(_FULL_ORDER))) + ", false)"
_FULL_COUNTS = _FULL_FLAGS_SQL + (
    "SELECT "
    + ", ".join(f"CAST(count_if(f{i + 1:02d}) AS BIGINT) AS c{i + 1:02d}" for i in range(len(_FULL_ORDER)))
    + f", count(*) AS total, CAST(count_if({_FULL_ANY}) AS BIGINT) AS rejected FROM fl"
)
_FULL_VIOLATIONS = (
    "WITH agg AS ("
    + _FULL_COUNTS.replace("\n", " ")
    + ") "
    + " UNION ALL ".join(f"SELECT '{n}' AS rule, c{i + 1:02d} AS failed_count FROM agg" for i, n in enumerate(_FULL_ORDER))
)


@query(
    "q28_full_rule_set",
    _FULL_FLAGS_SQL + f"SELECT l_orderkey, l_linenumber, {_FULL_TEXT} AS failed_rules FROM fl WHERE {_FULL_ANY}",
)
def q28(spark, sf_dir):
    """All 15 rule types in one validation of lineitem ⋈ orders: rejected rows."""
    return rejected(validate_full(spark, sf_dir), *FULL_KEYS)


@query("q20_violations_ranking", _FULL_VIOLATIONS)
def q20_ranking(spark, sf_dir):
    """Every rule with its violation count (ordered by count)."""
    return report.violations_ranking(validate_full(spark, sf_dir))


@query(
    "q20_worst_rules_top5",
    "SELECT rule, failed_count FROM (" + _FULL_VIOLATIONS + ") ORDER BY failed_count DESC, rule LIMIT 5",
)
def q20_top5(spark, sf_dir):
    """The five most violated rules."""
    return report.worst_rules(validate_full(spark, sf_dir), 5)


@query(
    "q20_record_distribution",
    "WITH agg AS (" + _FULL_COUNTS.replace("\n", " ") + ") "
    "SELECT 'passed' AS status, total - rejected AS records, total AS total_records FROM agg "
    "UNION ALL SELECT 'rejected', rejected, total FROM agg",
)
def q20_distribution(spark, sf_dir):
    """Passed vs rejected records."""
    return report.record_distribution(validate_full(spark, sf_dir))


@query(
    "q20_metric_cards",
    "WITH agg AS (" + _FULL_COUNTS.replace("\n", " ") + ") "
    "SELECT total AS total_records, total - rejected AS passed_records, rejected AS rejected_records, "
    "round(CASE WHEN total > 0 THEN (total - rejected) / total * 100.0 ELSE 0.0 END, 2) AS quality_pct FROM agg",
)
def q20_cards(spark, sf_dir):
    """Metric cards (quality % to 2 decimals)."""
    return report.metric_cards(validate_full(spark, sf_dir))


@query(
    "q21_rejected_sample",
    _FULL_FLAGS_SQL
    + f"SELECT l_orderkey, l_linenumber, {_FULL_TEXT} AS failed_rules FROM fl WHERE {_FULL_ANY} "
    "ORDER BY l_orderkey, l_linenumber, failed_rules LIMIT 10",
)
def q21_sample(spark, sf_dir):
    """P5: the first ten rejected rows by key (a top-k report)."""
    return report.rejected_sample(validate_full(spark, sf_dir), FULL_KEYS, 10)


@query(
    "q21_exploded",
    _FULL_FLAGS_SQL
    + "SELECT l_orderkey, l_linenumber, rule FROM ("
    + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{n}' AS rule FROM fl WHERE f{i + 1:02d}" for i, n in enumerate(_FULL_ORDER)
    )
    + ")",
)
def q21_exploded(spark, sf_dir):
    """One row per (rejected row, violated rule)."""
    return validate_full(spark, sf_dir).exploded(FULL_KEYS)


@query(
    "q21_failed_summary",
    _FULL_FLAGS_SQL + f"SELECT l_orderkey, l_linenumber, {_FULL_TEXT} AS failed_rules FROM fl WHERE {_FULL_ANY}",
)
def q21_summary(spark, sf_dir):
    """Key and failed rules of every rejected row."""
    fr = validate_full(spark, sf_dir).failed_rules_summary(FULL_KEYS)
    return fr.select(*FULL_KEYS, verdict_text())


# ---------------------------------------------------------------------------
# Sources in the registry: references by catalog name, explicit schemas
# ---------------------------------------------------------------------------
@query(
    "q29_reference_by_view",
    """SELECT doc_id, 'doc_labelled' AS failed_rules FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def q29(spark, sf_dir):
    """The reference is a temporary view resolved by name (no refs)."""
    from rowsieve.sources.readers import register_view

    register_view(table(spark, sf_dir, "labels"), "rowsieve_labels_view")
    rules = [dict(DOCUMENT_RULES[2], reference_table="rowsieve_labels_view", priority=1)]
    return rejected(validate(table(spark, sf_dir, "documents"), rules), "doc_id")


EVENTS_SCHEMA_JSON = {
    "type": "struct",
    "fields": [
        {"name": "event_id", "type": "long", "nullable": True, "metadata": {}},
        {"name": "ts", "type": "timestamp_ntz", "nullable": True, "metadata": {}},
        {"name": "user_id", "type": "long", "nullable": True, "metadata": {}},
        {"name": "event_type", "type": "string", "nullable": True, "metadata": {}},
        {"name": "value", "type": "double", "nullable": True, "metadata": {}},
        {"name": "props", "type": "string", "nullable": True, "metadata": {}},
    ],
}


@query(
    "q30_explicit_schema_scan",
    """SELECT event_id, 'business_hours' AS failed_rules FROM events
       WHERE strftime(ts, '%H:%M:%S') < '09:00:00' OR strftime(ts, '%H:%M:%S') > '20:59:59'""",
)
def q30(spark, sf_dir):
    """Parquet read with an explicit schema given as JSON."""
    from rowsieve.sources.readers import read_parquet

    df = read_parquet(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema=EVENTS_SCHEMA_JSON)
    rules = [
        {"name": "business_hours", "type": "time_range", "column": "ts", "min_time": "09:00:00", "max_time": "20:59:59", "priority": 1}
    ]
    return rejected(validate(df, rules), "event_id")


# ---------------------------------------------------------------------------
# More of the schema: conversations, suppliers by region, nation -> region
# ---------------------------------------------------------------------------
CONVERSATION_RULES = [
    {"name": "turn_unique", "type": "unique_check", "columns": ["conv_id", "turn"], "priority": 1},
    {"name": "role_known", "type": "allowed_values", "column": "role", "allowed_values": ["user", "assistant", "system"], "priority": 1},
    {"name": "text_min_50", "type": "length_check", "column": "text", "min_length": 50, "priority": 2},
    {
        "name": "assistant_never_first",
        "type": "cross_column",
        "columns": ["role", "turn"],
        "expect": "NOT (role = 'assistant' AND turn = 0)",
        "priority": 3,
    },
]


@query(
    "q31_conversation_turns",
    """WITH d AS (SELECT conv_id AS k1, turn AS k2 FROM conversations
                 WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
            f AS (
              SELECT c.conv_id, c.turn,
                     d.k1 IS NOT NULL AS f1,
                     c.role NOT IN ('user', 'assistant', 'system') AS f2,
                     (c.text IS NULL OR length(c.text) < 50) AS f3,
                     NOT (NOT (c.role = 'assistant' AND c.turn = 0)) AS f4
              FROM conversations c LEFT JOIN d ON c.conv_id = d.k1 AND c.turn = d.k2)
       SELECT conv_id, turn,
              concat_ws(',', CASE WHEN f1 THEN 'turn_unique' END, CASE WHEN f2 THEN 'role_known' END,
                             CASE WHEN f3 THEN 'text_min_50' END, CASE WHEN f4 THEN 'assistant_never_first' END) AS failed_rules
       FROM f WHERE coalesce(f1 OR f2 OR f3 OR f4, false)""",
)
def q31(spark, sf_dir):
    """Conversation turns: composite unique key, known roles, minimum text
    length (whole texts) and an expectation across columns."""
    r = validate(table(spark, sf_dir, "conversations"), CONVERSATION_RULES)
    return rejected(r, "conv_id", "turn")


@query(
    "q32_supplier_in_region",
    """SELECT l_orderkey, l_linenumber, l_suppkey, 'supplier_in_region_0' AS failed_rules FROM lineitem
       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
                               WHERE n_regionkey = 0)""",
)
def q32(spark, sf_dir):
    """G2 against a reference derived by a join (suppliers of region 0)."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    region0 = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).where(F.col("n_regionkey") == 0)
    rules = [
        {
            "name": "supplier_in_region_0",
            "type": "referential_integrity",
            "column": "l_suppkey",
            "reference_table": "region0_suppliers",
            "reference_column": "s_suppkey",
            "priority": 1,
        }
    ]
    r = validate(table(spark, sf_dir, "lineitem"), rules, refs={"region0_suppliers": region0})
    return rejected(r, "l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "q33_nation_region_fk",
    """SELECT n_nationkey, 'region_exists' AS failed_rules FROM nation
       WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)""",
)
def q33(spark, sf_dir):
    """Control: every nation's region exists."""
    rules = [
        {
            "name": "region_exists",
            "type": "referential_integrity",
            "column": "n_regionkey",
            "reference_table": "region",
            "reference_column": "r_regionkey",
            "priority": 1,
        }
    ]
    r = validate(table(spark, sf_dir, "nation"), rules, refs={"region": table(spark, sf_dir, "region")})
    return rejected(r, "n_nationkey")


# ---------------------------------------------------------------------------
# Q21 on the flagship events rules (the survey's pilot numbers)
# ---------------------------------------------------------------------------
@query(
    "q21_events_exploded",
    f"""SELECT event_id, 'value_in_range' AS rule FROM ({_EVENT_FLAGS}) WHERE f_value
       UNION ALL
       SELECT event_id, 'known_event_type' AS rule FROM ({_EVENT_FLAGS}) WHERE f_type""",
)
def q21_events_exploded(spark, sf_dir):
    """A9 on the flagship: one row per (event, violated rule)."""
    return validate_events(spark, sf_dir).exploded(["event_id"])


@query(
    "q21_events_sample",
    f"""SELECT event_id,
         concat_ws(',', CASE WHEN f_value THEN 'value_in_range' END,
                        CASE WHEN f_type THEN 'known_event_type' END) AS failed_rules
       FROM ({_EVENT_FLAGS}) WHERE coalesce(f_value OR f_type, false)
       ORDER BY event_id, failed_rules LIMIT 10""",
)
def q21_events_sample(spark, sf_dir):
    """P5 on the flagship: the first ten rejected events by key."""
    return report.rejected_sample(validate_events(spark, sf_dir), ["event_id"], 10)


# ---------------------------------------------------------------------------
# NOT IN semantics, text values, and names in another case
# ---------------------------------------------------------------------------
def _market_rule(reference: str) -> list[dict]:
    return [
        {
            "name": "market_known",
            "type": "referential_integrity",
            "column": "c_mktsegment",
            "reference_table": reference,
            "reference_column": "segment",
            "priority": 1,
        }
    ]


@query(
    "q34_null_in_reference",
    """SELECT c_custkey, c_mktsegment, 'market_known' AS failed_rules FROM customer
       WHERE c_mktsegment NOT IN (SELECT nullif(c_mktsegment, 'BUILDING') FROM customer WHERE c_nationkey < 5)""",
)
def q34(spark, sf_dir):
    """A NULL in the reference means that no row can fail."""
    df = table(spark, sf_dir, "customer")
    ref = df.where("c_nationkey < 5").select(F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    return rejected(validate(df, _market_rule("segments"), refs={"segments": ref}), "c_custkey", "c_mktsegment")


@query(
    "q35_empty_reference",
    """SELECT c_custkey, c_mktsegment, 'market_known' AS failed_rules FROM customer
       WHERE (nullif(c_mktsegment, 'BUILDING') NOT IN (SELECT c_mktsegment FROM customer WHERE c_custkey < 0))""",
)
def q35(spark, sf_dir):
    """With an empty reference every row fails, NULL values too."""
    df = table(spark, sf_dir, "customer")
    seen = df.withColumn("segment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    ref = df.where("c_custkey < 0").select(F.col("c_mktsegment").alias("segment"))
    rules = [{**_market_rule("segments")[0], "column": "segment"}]
    return rejected(validate(seen, rules, refs={"segments": ref}), "c_custkey", "c_mktsegment")


@query(
    "q36_null_input",
    """SELECT c_custkey, segment, 'market_known' AS failed_rules
       FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
       WHERE segment NOT IN (SELECT c_mktsegment FROM customer WHERE c_mktsegment LIKE 'A%' OR c_mktsegment LIKE 'M%')""",
)
def q36(spark, sf_dir):
    """A NULL value passes, unknown values fail."""
    df = table(spark, sf_dir, "customer")
    ref = df.where("c_mktsegment LIKE 'A%' OR c_mktsegment LIKE 'M%'").select(F.col("c_mktsegment").alias("segment"))
    seen = df.select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    rules = [{**_market_rule("segments")[0], "column": "segment"}]
    return rejected(validate(seen, rules, refs={"segments": ref}), "c_custkey", "segment")


@query(
    "q37_time_difference_null_end",
    """SELECT l_orderkey, l_linenumber, 'shipped_in_time' AS failed_rules FROM (
         SELECT l_orderkey, l_linenumber, o_orderdate,
                CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END AS shipped
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       WHERE o_orderdate IS NULL OR shipped IS NULL
          OR epoch(CAST(shipped AS TIMESTAMP)) - epoch(CAST(o_orderdate AS TIMESTAMP)) > 60 * 86400""",
)
def q37(spark, sf_dir):
    """A missing end fails."""
    df = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    df = df.withColumn("shipped", F.expr("CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END"))
    rules = [
        {"name": "shipped_in_time", "type": "time_difference", "columns": ["o_orderdate", "shipped"], "max_duration": "60 DAYS", "priority": 1}
    ]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber")


@query(
    "q38_time_difference_offsets",
    """SELECT event_id, 'within_five_hours' AS failed_rules FROM (SELECT event_id, CAST(event_id % 13 AS INTEGER) AS hours FROM events)
       WHERE hours * 3600 > 5 * 3600""",
)
def q38(spark, sf_dir):
    """R9 on ISO text: both ends say the same clock time, the second one in a
    zone ``event_id % 13`` hours west."""
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    west = F.lpad((F.col("event_id") % 13).cast("string"), 2, "0")
    df = table(spark, sf_dir, "events").select(
        "event_id", F.concat(clock, F.lit("Z")).alias("sent"), F.concat(clock, F.lit("-"), west, F.lit(":00")).alias("received")
    )
    rules = [
        {"name": "within_five_hours", "type": "time_difference", "columns": ["sent", "received"], "max_duration": "5 HOURS", "priority": 1}
    ]
    return rejected(validate(df, rules), "event_id")


@query(
    "q39_long_ids_as_text",
    """SELECT event_id, id, concat_ws(',', CASE WHEN id > 9007199254740992 + 5000 THEN 'id_range' END,
                                          CASE WHEN id <> 9007199254740993 THEN 'id_known' END) AS failed_rules
       FROM (SELECT event_id, 9007199254740992 + event_id AS id FROM events)
       WHERE id > 9007199254740992 + 5000 OR id <> 9007199254740993""",
)
def q39(spark, sf_dir):
    """R3 and R4 on numbers kept as text that a DOUBLE cannot tell apart."""
    number = F.lit(2**53) + F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", number.alias("id"), number.cast("string").alias("text_id"))
    rules = [
        {"name": "id_range", "type": "value_range", "column": "text_id", "max": 2**53 + 5000, "priority": 1},
        {"name": "id_known", "type": "allowed_values", "column": "text_id", "allowed_values": [2**53 + 1], "priority": 2},
    ]
    return rejected(validate(df, rules), "event_id", "id")


@query(
    "q40_reference_as_text",
    """SELECT o_orderkey, o_custkey, 'customer_exists' AS failed_rules FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def q40(spark, sf_dir):
    """Numeric keys against a reference read as text."""
    ref = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id"))
    rules = [
        {
            "name": "customer_exists",
            "type": "referential_integrity",
            "column": "o_custkey",
            "reference_table": "customers",
            "reference_column": "id",
            "priority": 1,
        }
    ]
    return rejected(validate(table(spark, sf_dir, "orders"), rules, refs={"customers": ref}), "o_orderkey", "o_custkey")


@query(
    "q41_names_in_another_case",
    """SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity > 45 THEN 'quantity' END,
                                                     CASE WHEN l_returnflag <> 'N' THEN 'flag' END) AS failed_rules
       FROM lineitem WHERE l_quantity > 45 OR l_returnflag <> 'N'""",
)
def q41(spark, sf_dir):
    """Columns resolve as Spark resolves them: another case, backticks, a struct's field."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.struct("l_returnflag").alias("flags"))
    rules = [
        {"name": "quantity", "type": "value_range", "column": "L_QUANTITY", "max": 45, "priority": 1},
        {"name": "flag", "type": "allowed_values", "column": "flags.`L_ReturnFlag`", "allowed_values": ["N"], "priority": 2},
    ]
    return rejected(validate(df, rules), "l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------
# Rules over ordered rows (ours): periods, sequences, dependencies
# ---------------------------------------------------------------------------
HOT_USER = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"


@query(
    "q42_interval_reference",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, 'price_known' AS failed_rules FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_linenumber = 1 AND p.l_partkey = l.l_partkey
                         AND p.l_shipdate <= l.l_shipdate AND l.l_shipdate < p.l_shipdate + INTERVAL 200 DAY)""",
)
def q42(spark, sf_dir):
    """interval_reference: lines are shipped within a price period of their
    part (200 days from the ship date of any first line of an order)."""
    df = table(spark, sf_dir, "lineitem")
    prices = df.where("l_linenumber = 1").select("l_partkey", F.col("l_shipdate").alias("valid_from"), F.expr("l_shipdate + INTERVAL 200 DAY").alias("valid_to"))
    rules = [
        {
            "name": "price_known",
            "type": "interval_reference",
            "column": "l_shipdate",
            "key_columns": ["l_partkey"],
            "reference_table": "prices",
            "reference_key_columns": ["l_partkey"],
            "from_column": "valid_from",
            "to_column": "valid_to",
            "priority": 1,
        }
    ]
    return rejected(validate(df, rules, refs={"prices": prices}), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query(
    "q43_as_of_reference",
    f"""WITH e AS (SELECT *, {HOT_USER} AS who FROM events)
        SELECT event_id, who, ts, 'viewed_before' AS failed_rules FROM e p
        WHERE event_type = 'purchase' AND NOT EXISTS (
          SELECT 1 FROM e v WHERE v.event_type = 'view' AND v.who = p.who AND v.ts <= p.ts AND p.ts <= v.ts + INTERVAL 2 DAY)""",
)
def q43(spark, sf_dir):
    """interval_reference as of a time: a purchase follows a view of the same
    user by two days at most; one user has a third of all events."""
    df = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.expr(HOT_USER).alias("who"))
    rules = [
        {
            "name": "viewed_before",
            "type": "interval_reference",
            "column": "ts",
            "key_columns": ["who"],
            "reference_table": "views",
            "reference_key_columns": ["who"],
            "from_column": "ts",
            "max_duration": "2 DAYS",
            "priority": 1,
        }
    ]
    views = df.where("event_type = 'view'").select("who", "ts")
    return rejected(validate(df.where("event_type = 'purchase'"), rules, refs={"views": views}), "event_id", "who", "ts")


@query(
    "q44_sequence_gaps",
    f"""WITH e AS (SELECT event_id, {HOT_USER} AS who, ts FROM events),
        points AS (SELECT DISTINCT who, ts FROM e),
        steps AS (SELECT who, ts, epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY who ORDER BY ts))) AS step FROM points)
        SELECT event_id, e.who, e.ts, 'no_gap' AS failed_rules FROM e JOIN steps ON e.who = steps.who AND e.ts = steps.ts WHERE step > 86400 * 3""",
)
def q44(spark, sf_dir):
    """sequence_check: no user is silent for more than three days; one user
    has a third of all events."""
    df = table(spark, sf_dir, "events").select("event_id", F.expr(HOT_USER).alias("who"), "ts")
    rules = [{"name": "no_gap", "type": "sequence_check", "key_columns": ["who"], "order_column": "ts", "column": "ts", "max_step": 86400 * 3, "priority": 1}]
    return rejected(validate(df, rules), "event_id", "who", "ts")


@query(
    "q45_sequence_resets",
    """WITH points AS (SELECT DISTINCT l_suppkey, l_shipdate, l_quantity FROM lineitem),
       steps AS (SELECT *, l_quantity - lag(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_quantity) AS step FROM points)
       SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN step < -45 THEN 'no_reset' END, CASE WHEN step > 46 THEN 'no_jump' END) AS failed_rules
       FROM lineitem JOIN steps USING (l_suppkey, l_shipdate, l_quantity) WHERE step < -45 OR step > 46""",
)
def q45(spark, sf_dir):
    """sequence_check twice: a supplier's quantities, by ship date, neither fall by more than 45 nor jump by more than 46."""
    base = {"type": "sequence_check", "key_columns": ["l_suppkey"], "order_column": "l_shipdate", "column": "l_quantity"}
    rules = [{**base, "name": "no_reset", "min_step": -45, "priority": 1}, {**base, "name": "no_jump", "max_step": 46, "priority": 2}]
    return rejected(validate(table(spark, sf_dir, "lineitem"), rules), "l_orderkey", "l_linenumber")


@query(
    "q46_functional_dependency",
    """WITH bad AS (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) > 1)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'one_flag' AS failed_rules FROM lineitem JOIN bad USING (l_partkey, l_suppkey)""",
)
def q46(spark, sf_dir):
    """functional_dependency: part and supplier determine the return flag."""
    rules = [{"name": "one_flag", "type": "functional_dependency", "key_columns": ["l_partkey", "l_suppkey"], "column": "l_returnflag", "priority": 1}]
    return rejected(validate(table(spark, sf_dir, "lineitem"), rules), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "q47_order_dependency",
    """SELECT o_orderkey, o_custkey, 'keys_rise' AS failed_rules FROM orders o
       WHERE EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate < o.o_orderdate AND p.o_orderkey > o.o_orderkey)""",
)
def q47(spark, sf_dir):
    """order_dependency: a customer's later orders have larger keys."""
    rules = [{"name": "keys_rise", "type": "order_dependency", "key_columns": ["o_custkey"], "order_column": "o_orderdate", "column": "o_orderkey", "priority": 1}]
    return rejected(validate(table(spark, sf_dir, "orders"), rules), "o_orderkey", "o_custkey")


@query(
    "q48_one_sequence",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN early THEN 'dates_rise' END, CASE WHEN step > 1 THEN 'keys_follow' END) AS failed_rules
       FROM (SELECT o_orderkey, max(o_orderdate) OVER before > o_orderdate AS early, o_orderkey - lag(o_orderkey) OVER (ORDER BY o_orderkey) AS step
             FROM (SELECT * FROM orders WHERE o_orderkey % 7 <> 3)
             WINDOW before AS (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       WHERE early OR step > 1""",
)
def q48(spark, sf_dir):
    """Both without keys, the whole table one sequence: order dates rise with
    the order key, and keys follow on each other (every seventh is taken out)."""
    rules = [
        {"name": "dates_rise", "type": "order_dependency", "order_column": "o_orderkey", "column": "o_orderdate", "priority": 1},
        {"name": "keys_follow", "type": "sequence_check", "order_column": "o_orderkey", "column": "o_orderkey", "max_step": 1, "priority": 2},
    ]
    return rejected(validate(table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 3"), rules), "o_orderkey")


# ---------------------------------------------------------------------------
# Counts per segment with subtotals
# ---------------------------------------------------------------------------
SEGMENT_RULES = [
    {"name": "quantity_5_45", "type": "value_range", "column": "l_quantity", "min": 5, "max": 45, "priority": 1, "entity": "line"},
    {"name": "line_unique", "type": "unique_check", "columns": ["l_partkey", "l_suppkey"], "priority": 2, "entity": "line"},
    {"name": "low_tax", "type": "value_range", "column": "l_tax", "max": 0.06, "priority": 3},
]
_SEGMENT_FLAGS = """
    WITH f AS (SELECT l_returnflag AS flag, year(l_shipdate) AS shipped, l_quantity < 5 OR l_quantity > 45 AS a,
                      count(*) OVER (PARTITION BY l_partkey, l_suppkey) > 1 AS b, l_tax > 0.06 AS c FROM lineitem)"""


def _segments(spark, sf_dir):
    return validate(table(spark, sf_dir, "lineitem"), SEGMENT_RULES), {"flag": "l_returnflag", "shipped": F.year("l_shipdate")}


@query(
    "q49_segment_summary",
    _SEGMENT_FLAGS
    + """
    SELECT flag, CAST(shipped AS INTEGER) AS shipped, CAST(GROUPING(flag, shipped) AS BIGINT) AS level, count(*) AS total_records,
      count(*) FILTER (NOT (a OR b OR c)) AS passed_records, count(*) FILTER (a OR b OR c) AS rejected_records,
      count(*) FILTER (NOT (a OR b OR c)) / count(*) * 100.0 AS quality_pct
    FROM f GROUP BY CUBE (flag, shipped)""",
)
def q49(spark, sf_dir):
    """A7 by return flag and ship year, with every subtotal."""
    result, by = _segments(spark, sf_dir)
    return result.segment_summary(by, "cube")


@query(
    "q50_segment_violations",
    _SEGMENT_FLAGS
    + """,
    g AS (SELECT flag, CAST(shipped AS INTEGER) AS shipped, CAST(GROUPING(flag, shipped) AS BIGINT) AS level, count(*) AS total_records,
            count(*) FILTER (a) AS na, count(*) FILTER (b) AS nb, count(*) FILTER (c) AS nc FROM f GROUP BY ROLLUP (flag, shipped))
    SELECT flag, shipped, level, 'quantity_5_45' AS rule, 'value_range' AS rule_type, 1 AS priority, 'line' AS entity, na AS failed_count, total_records FROM g
    UNION ALL SELECT flag, shipped, level, 'line_unique', 'unique_check', 2, 'line', nb, total_records FROM g
    UNION ALL SELECT flag, shipped, level, 'low_tax', 'value_range', 3, NULL, nc, total_records FROM g""",
)
def q50(spark, sf_dir):
    """A6 by return flag and ship year, with totals per flag and over all."""
    result, by = _segments(spark, sf_dir)
    return result.segment_violations(by)


# ---------------------------------------------------------------------------
# Batches validated against kept state
# ---------------------------------------------------------------------------
STATE_RULES = [
    {"name": "once", "type": "unique_check", "columns": ["who", "event_type", "day"], "priority": 1},
    {"name": "outlier", "type": "statistical", "column": "value", "statistic": "z_score", "threshold": 2.5, "priority": 2},
    {"name": "positive", "type": "value_range", "column": "value", "min": 1, "priority": 3},
]
_STATE_INPUT = f"""SELECT event_id, {HOT_USER} AS who, event_type, CAST(ts AS DATE) AS day, value, event_id % 3 AS batch FROM events"""


@query(
    "q51_batches_with_state",
    f"""WITH e AS ({_STATE_INPUT}),
        -- batches come in the order 0, 1, 2; a row is judged with its own batch and those before
        c AS (SELECT who, event_type, day, batch, count(*) AS c FROM e GROUP BY who, event_type, day, batch),
        k AS (SELECT *, sum(c) OVER (PARTITION BY who, event_type, day ORDER BY batch) AS n FROM c),
        m AS (SELECT b AS batch, avg(value) AS mean, stddev_samp(value) AS sd FROM e, (VALUES (0), (1), (2)) AS t(b) WHERE e.batch <= b GROUP BY b),
        f AS (SELECT event_id, batch, n > 1 AS a, abs((value - mean) / sd) > 2.5 AS b, value < 1 OR isnan(value) AS c
              FROM e JOIN k USING (who, event_type, day, batch) JOIN m USING (batch))
        SELECT event_id, CAST(batch AS BIGINT) AS batch,
          concat_ws(',', CASE WHEN a THEN 'once' END, CASE WHEN b THEN 'outlier' END, CASE WHEN c THEN 'positive' END) AS failed_rules
        FROM f WHERE a OR b OR c""",
)
def q51(spark, sf_dir):
    """Events in three batches, each judged with the keys and moments kept of
    those before; one user has a third of all events."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{HOT_USER} AS who", "event_type", "CAST(ts AS DATE) AS day", "value", "event_id % 3 AS batch")
    state, out = KeptState(spark, work_folder(spark), STATE_RULES), []
    for batch in range(3):
        result = state.validate(events.where(F.col("batch") == batch), batch)
        out.append(rejected(result, "event_id", "batch"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "q52_state_after_batches",
    f"""WITH e AS ({_STATE_INPUT}), k AS (SELECT count(*) AS n FROM e GROUP BY who, event_type, day)
        SELECT 'once' AS rule, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS failed_count, CAST(sum(n) AS BIGINT) AS total_records FROM k
        UNION ALL SELECT 'positive', count(*) FILTER (value < 1 OR isnan(value)), count(*) FROM e
        UNION ALL SELECT 'outlier', count(*) FILTER (abs((value - mean) / sd) > 2.5), count(*)
        FROM e, (SELECT avg(value) AS mean, stddev_samp(value) AS sd FROM e)""",
)
def q52(spark, sf_dir):
    """What three batches have left, one of them replayed: the counts of one run over all rows."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{HOT_USER} AS who", "event_type", "CAST(ts AS DATE) AS day", "value", "event_id % 3 AS batch")
    state = KeptState(spark, work_folder(spark), STATE_RULES)
    for batch in (1, 0, 2, 1):
        state.record(state.validate(events.where(F.col("batch") == batch), batch), batch)
    counts = state.key_counts(["who", "event_type", "day"])
    once = counts.agg(F.lit("once").alias("rule"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed_count"), F.sum("n").alias("total_records"))
    moments = state.moments()["value"]
    away = F.abs(F.try_divide(F.col("value") - moments["mean"], F.lit(moments["sd"])))
    outlier = events.agg(F.lit("outlier").alias("rule"), F.count_if(away > 2.5).alias("failed_count"), F.count("*").alias("total_records"))
    return once.unionByName(outlier).unionByName(state.counts().where("rule = 'positive'"))


# ---------------------------------------------------------------------------
# Exact quantiles
# ---------------------------------------------------------------------------
@query(
    "q53_exact_quantiles",
    """WITH p(probability) AS (VALUES (0.01::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.999::DOUBLE)),
       r AS (SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS i,
                    count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
       SELECT l_returnflag, probability, n, l_extendedprice AS value FROM r, p WHERE i = greatest(ceil(probability * n), 1)""",
)
def q53(spark, sf_dir):
    """Exact quantiles of prices per return flag, by histogram refinement."""
    return quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.01, 0.25, 0.5, 0.999], ["l_returnflag"])


@query(
    "q54_robust_outliers",
    f"""WITH e AS (SELECT event_id, {HOT_USER} % 20 AS who, value FROM events),
        m AS (SELECT who, quantile_disc(value, 0.5) AS median FROM e GROUP BY who),
        d AS (SELECT who, quantile_disc(abs(value - median), 0.5) AS mad FROM e JOIN m USING (who) GROUP BY who),
        a AS (SELECT quantile_disc(value, 0.5) AS median FROM e),
        b AS (SELECT quantile_disc(abs(value - median), 0.5) AS mad FROM e, a),
        f AS (SELECT event_id, who, value, abs(value - m.median) / (d.mad * 1.4826) > 3 AS x, abs(value - a.median) / (b.mad * 1.4826) > 3.5 AS y
              FROM e JOIN m USING (who) JOIN d USING (who), a, b)
        SELECT event_id, who, value, concat_ws(',', CASE WHEN x THEN 'odd_for_user' END, CASE WHEN y THEN 'odd_at_all' END) AS failed_rules FROM f WHERE x OR y""",
)
def q54(spark, sf_dir):
    """Median and MAD instead of mean and deviation, per group and over all; one group has a third of all events."""
    df = table(spark, sf_dir, "events").selectExpr("event_id", f"{HOT_USER} % 20 AS who", "value")
    base = {"type": "statistical", "column": "value", "statistic": "mad"}
    rules = [{**base, "name": "odd_for_user", "key_columns": ["who"], "threshold": 3, "priority": 1}, {**base, "name": "odd_at_all", "threshold": 3.5, "priority": 2}]
    return rejected(validate(df, rules), "event_id", "who", "value")


# ---------------------------------------------------------------------------
# Reconciliation of two versions of a table
# ---------------------------------------------------------------------------
#: A later version of lineitem: rows gone, changed, and repeated.
_LATER = """
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 97 = 5 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         CASE WHEN l_partkey % 211 = 7 THEN NULL ELSE l_shipdate END AS l_shipdate
  FROM lineitem WHERE l_orderkey % 101 <> 3
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_orderkey % 103 = 4
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_orderkey % 206 = 4"""
_OLD = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem"
_DIFFERENCE = f"""
  WITH every AS (SELECT *, 1 AS sign FROM ({_OLD}) UNION ALL SELECT *, -1 FROM ({_LATER})),
  d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, sum(sign) AS n FROM every
        GROUP BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate HAVING sum(sign) <> 0)"""


def _versions(spark, sf_dir):
    now = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    later = now.where("l_orderkey % 101 <> 3").withColumns(
        {"l_quantity": F.expr("IF(l_orderkey % 97 = 5, l_quantity + 1, l_quantity)"), "l_shipdate": F.expr("IF(l_partkey % 211 = 7, NULL, l_shipdate)")}
    )
    return now, later.unionByName(now.where("l_orderkey % 103 = 4")).unionByName(now.where("l_orderkey % 206 = 4"))


@query(
    "q55_reconciliation",
    f"""{_DIFFERENCE} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate,
          CASE WHEN n > 0 THEN 'left' ELSE 'right' END AS side, CAST(abs(n) AS BIGINT) AS copies FROM d""",
)
def q55(spark, sf_dir):
    """Two versions of lineitem: every row that they do not have equally often, with the copies."""
    return reconcile(*_versions(spark, sf_dir), keys=["l_orderkey", "l_linenumber"])


@query(
    "q56_changed_keys",
    f"""{_DIFFERENCE}, k AS (SELECT l_orderkey, l_linenumber, CAST(coalesce(sum(n) FILTER (n > 0), 0) AS BIGINT) AS left_copies,
          CAST(coalesce(-sum(n) FILTER (n < 0), 0) AS BIGINT) AS right_copies FROM d GROUP BY l_orderkey, l_linenumber)
        SELECT *, CASE WHEN right_copies = 0 THEN 'removed' WHEN left_copies = 0 THEN 'added' ELSE 'changed' END AS change FROM k""",
)
def q56(spark, sf_dir):
    """The same by key: removed, added (or repeated) and changed."""
    keys = ["l_orderkey", "l_linenumber"]
    return changed_keys(reconcile(*_versions(spark, sf_dir), keys=keys), keys)
