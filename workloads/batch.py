"""Queries over stored tables: one per operator, then the analytical tables and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.functions.columns import extraction_time, label, safe_cast, source_name, trim_headers, trimmed
from tierloom.operators import checks, joins, profile, ranking, versions
from tierloom.operators.checks import suite
from tierloom.operators.expectations import Expectation, enforce, report
from tierloom.operators.listing import discover_links, reconcile
from tierloom.plans import gold, sql
from tierloom.plans.checks import best_year_checks, population_checks, series_population_checks
from tierloom.workspace import stored
from workloads import inputs
from workloads.registry import OBSERVATIONS, POPULATION, QUARTERLY, YEARLY, query

NATION = "NATION_7"
SERIES = "7"


# Projections and scalar functions


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def header_trim(spark: SparkSession, folder: str) -> DataFrame:
    customers = inputs.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return trim_headers(customers.toDF(*[f"  {name}   " for name in customers.columns]))


@query(
    """SELECT doc_id, CAST(unnest(range(1, len(lines) + 1)) AS INTEGER) AS line_no, unnest(lines) AS line
       FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)"""
)
def nested_field(spark: SparkSession, folder: str) -> DataFrame:
    record = inputs.document_snapshots(spark, folder).select("doc_id", F.explode("data").alias("record"))
    return record.select("doc_id", F.col("record.`Line No`").alias("line_no"), F.col("record.Line").alias("line"))


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              TRY_CAST(event_type AS DOUBLE) AS malformed,
              TRY_CAST('  ' || CAST(user_id AS VARCHAR) || ' ' AS BIGINT) AS user_id
       FROM events""",
    name="safe_cast",
)
def safe_cast_values(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events")
    return events.select(
        "event_id",
        safe_cast(F.get_json_object("props", "$.k"), "int").alias("k"),
        safe_cast("event_type", "double").alias("malformed"),
        safe_cast(F.concat(F.lit("  "), inputs.text("user_id"), F.lit(" ")), "bigint").alias("user_id"),
    )


@query(
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity * 2 AS doubled
       FROM lineitem"""
)
def project_rename_drop(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return (
        lines.withColumn("doubled", F.col("l_quantity") * 2)
        .drop("l_quantity")
        .withColumnRenamed("l_orderkey", "order_key")
        .withColumnRenamed("l_linenumber", "line")
    )


@query(
    """SELECT s_suppkey, trim('  ' || s_name || '   ') AS name,
              lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS code
       FROM supplier"""
)
def trim_codes(spark: SparkSession, folder: str) -> DataFrame:
    padded = inputs.table(spark, folder, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("  "), "s_name", F.lit("   ")).alias("name"),
        F.concat(F.lpad(inputs.text("s_nationkey"), 2, "0"), F.lit("  ")).alias("code"),
    )
    return padded.select("s_suppkey", trimmed("name").alias("name"), trimmed("code").alias("code"))


@query(
    """SELECT s_suppkey, concat_ws(' - ', r_name, n_name) AS label
       FROM supplier LEFT JOIN region ON r_regionkey = s_nationkey
       LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 0"""
)
def label_concat(spark: SparkSession, folder: str) -> DataFrame:
    """Parts are missing on one side, on the other, or on both."""
    regions = inputs.table(spark, folder, "region").withColumnRenamed("r_regionkey", "s_nationkey")
    nations = inputs.table(spark, folder, "nation").filter(F.col("n_regionkey") != 0)
    named = joins.lookup(inputs.table(spark, folder, "supplier"), regions, "s_nationkey")
    named = joins.lookup(named, nations.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    return named.select("s_suppkey", label("r_name", "n_name").alias("label"))


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
       WHERE year(o_orderdate) BETWEEN 1996 AND 1998
         AND o_orderpriority IN ('1-URGENT', '2-HIGH')
         AND (o_orderstatus = 'F' OR o_totalprice <> round(o_totalprice, 0))
         AND o_custkey IS NOT NULL AND NOT (o_orderstatus = '')"""
)
def filter_range_in_null(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders")
    return orders.filter(
        F.year("o_orderdate").between(1996, 1998)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") != F.round("o_totalprice", 0)))
        & F.col("o_custkey").isNotNull()
        & ~(F.col("o_orderstatus") == "")
    ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


# Expectations

RULES = (
    Expectation("taxed", "nullif(l_tax, 0) > 0.02"),
    Expectation("not_returned", "l_returnflag <> 'R'"),
    Expectation("shipped", "l_shipdate IS NOT NULL"),
)


@query(
    """SELECT l_orderkey, l_linenumber, l_tax, l_returnflag FROM lineitem
       WHERE nullif(l_tax, 0) > 0.02 AND l_returnflag <> 'R' AND l_shipdate IS NOT NULL"""
)
def expect_drop(spark: SparkSession, folder: str) -> DataFrame:
    kept = enforce(inputs.table(spark, folder, "lineitem"), RULES)
    return kept.select("l_orderkey", "l_linenumber", "l_tax", "l_returnflag")


@query(
    """SELECT 'taxed' AS name, count(*) FILTER (nullif(l_tax, 0) > 0.02) AS passed,
              count(*) - count(*) FILTER (nullif(l_tax, 0) > 0.02) AS failed FROM lineitem
       UNION ALL
       SELECT 'not_returned', count(*) FILTER (l_returnflag <> 'R'),
              count(*) - count(*) FILTER (l_returnflag <> 'R') FROM lineitem
       UNION ALL
       SELECT 'shipped', count(l_shipdate), count(*) - count(l_shipdate) FROM lineitem"""
)
def expect_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return report(inputs.table(spark, folder, "lineitem"), RULES)


# Joins


@query(
    """SELECT c_custkey, c_name, r_name AS region FROM customer LEFT JOIN region ON r_regionkey = c_nationkey"""
)
def left_join_lookup(spark: SparkSession, folder: str) -> DataFrame:
    regions = inputs.table(spark, folder, "region").withColumnRenamed("r_regionkey", "c_nationkey")
    customers = inputs.table(spark, folder, "customer")
    return joins.lookup(customers, regions, "c_nationkey").select(
        "c_custkey", "c_name", F.col("r_name").alias("region")
    )


@query(
    f"""WITH {QUARTERLY}, {POPULATION}
        SELECT q.series_id, q.year, q.period, q.value, p.population
        FROM quarterly q LEFT JOIN population p ON p.year = q.year AND p.nation = '{NATION}'"""
)
def left_join_on_const(spark: SparkSession, folder: str) -> DataFrame:
    people = inputs.population(spark, folder)
    joined = joins.left_join_where(
        inputs.quarterly(spark, folder), people, "year", people["nation"] == NATION
    )
    return joined.select("series_id", "year", "period", "value", "population")


@query(
    "SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON c_custkey = o_custkey"
)
def inner_check(spark: SparkSession, folder: str) -> DataFrame:
    customers = inputs.table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    matched = joins.matching(inputs.table(spark, folder, "orders"), customers, "o_custkey")
    return matched.select("o_orderkey", "o_totalprice", "c_name")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_returnflag = 'N'
                         AND k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber)"""
)
def anti_missing(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    kept = lines.filter(F.col("l_returnflag") == "N")
    missing = joins.missing_rows(lines, kept, ["l_orderkey", "l_linenumber"])
    return missing.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT doc_id, source FROM documents
       WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)"""
)
def semi_available(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    return joins.available_rows(documents, inputs.table(spark, folder, "labels"), "doc_id")


# Aggregates and ranking


@query(
    """SELECT round(avg(l_quantity), 6) AS mean_quantity, round(stddev_pop(l_quantity), 6) AS stddev_quantity
       FROM lineitem"""
)
def mean_stddev(spark: SparkSession, folder: str) -> DataFrame:
    totals = ranking.summary(inputs.table(spark, folder, "lineitem"), "l_quantity", "m", "s")
    return totals.select(F.round("m", 6).alias("mean_quantity"), F.round("s", 6).alias("stddev_quantity"))


@query(
    """SELECT l_suppkey, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY ALL"""
)
def grouped_sum(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    return ranking.grouped_sum(lines, ["l_suppkey", "l_returnflag"], "l_extendedprice", "total", scale=2)


@query("SELECT o_custkey, max(o_totalprice) AS largest FROM orders GROUP BY o_custkey")
def grouped_max(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.grouped_max(inputs.table(spark, folder, "orders"), ["o_custkey"], "o_totalprice", "largest")


@query('SELECT count(*) AS "rows", count(DISTINCT l_orderkey) AS distinct_keys FROM lineitem')
def count_and_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.count_and_distinct(inputs.table(spark, folder, "lineitem"), "l_orderkey")


@query(
    f"""WITH {OBSERVATIONS}, {YEARLY}
        SELECT series_id, year, annual_value,
               CAST(row_number() OVER (PARTITION BY series_id ORDER BY annual_value DESC, year) AS INTEGER) AS row_num
        FROM yearly"""
)
def row_number_rank(spark: SparkSession, folder: str) -> DataFrame:
    yearly = gold.yearly_totals(inputs.observations(spark, folder), scale=2)
    return ranking.ranked(yearly, ["series_id"], [F.col("annual_value").desc(), F.col("year").asc()])


@query(
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (
         SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem)
       QUALIFY row_number() OVER (PARTITION BY l_suppkey
                                  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1"""
)
def top1_per_group(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    return ranking.top_per_group(
        lines.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"),
        ["l_suppkey"],
        [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc()],
    )


@query(
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""
)
def sorted_limit(spark: SparkSession, folder: str) -> DataFrame:
    """Top-k report: each task keeps its own first rows, only those are merged."""
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1")
def first_row(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy("o_totalprice", "o_orderkey").limit(1)


# Analytical tables

STATS_SQL = f"""WITH {POPULATION}
    SELECT round(avg(population), 6) AS mean_population, round(stddev_pop(population), 6) AS stddev_population
    FROM population WHERE nation = '{NATION}' AND year BETWEEN 1996 AND 1998"""
BEST_SQL = f"""WITH {OBSERVATIONS}, {YEARLY},
    best AS (SELECT * FROM yearly
             QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY annual_value DESC, year) = 1)
    SELECT best.series_id, concat_ws(' - ', r_name, n_name) AS series_label, best.year AS best_year,
           best.annual_value AS best_year_value
    FROM best LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = best.series_id
    LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = s_nationkey"""
PAIRED_SQL = f"""WITH {OBSERVATIONS}, {POPULATION}
    SELECT o.year, o.value, p.population
    FROM observations o LEFT JOIN population p ON p.year = o.year AND p.nation = '{NATION}'
    WHERE o.series_id = '{SERIES}' AND o.period = 'Q01'"""


def rounded(stats: DataFrame) -> DataFrame:
    return stats.select(*[F.round(name, 6).alias(name) for name in stats.columns])


@query(STATS_SQL)
def gold_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(gold.population_stats(inputs.population(spark, folder), NATION, 1996, 1998))


@query(STATS_SQL)
def gold_stats_sql(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sql.population_stats(spark, inputs.population(spark, folder), NATION, 1996, 1998))


def best_year_inputs(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [
        source(spark, folder)
        for source in (inputs.observations, inputs.series, inputs.measures, inputs.sectors)
    ]


@query(BEST_SQL)
def gold_best_year(spark: SparkSession, folder: str) -> DataFrame:
    return gold.best_year_by_series(*best_year_inputs(spark, folder), scale=2)


@query(BEST_SQL)
def gold_best_year_sql(spark: SparkSession, folder: str) -> DataFrame:
    return sql.best_year_by_series(spark, *best_year_inputs(spark, folder), scale=2)


@query(PAIRED_SQL)
def gold_series_reference(spark: SparkSession, folder: str) -> DataFrame:
    return gold.series_population(
        inputs.observations(spark, folder), inputs.population(spark, folder), SERIES, "Q01", NATION
    )


@query(PAIRED_SQL)
def gold_series_reference_sql(spark: SparkSession, folder: str) -> DataFrame:
    return sql.series_population(
        spark, inputs.observations(spark, folder), inputs.population(spark, folder), SERIES, "Q01", NATION
    )


@query(
    f"""WITH {OBSERVATIONS}, {POPULATION}
        SELECT o.series_id, o.year, o.period, o.value, p.population
        FROM observations o LEFT JOIN population p ON p.year = o.year AND p.nation = '{NATION}'"""
)
def metric_with_reference(spark: SparkSession, folder: str) -> DataFrame:
    """The population is stored first, as in a refresh, so that Spark knows its size."""
    people = stored(inputs.population(spark, folder), "population")
    return gold.metric_with_population(inputs.observations(spark, folder), people, NATION)


# Checks

CHECKS_SQL = f"""WITH {OBSERVATIONS}, {POPULATION}, {YEARLY},
    stats AS (SELECT avg(population) AS m, stddev_pop(population) AS s FROM population
              WHERE nation = '{NATION}' AND year BETWEEN 1996 AND 1998),
    best AS (SELECT y.series_id, concat_ws(' - ', r_name) AS series_label, y.year AS best_year,
                    y.annual_value AS best_year_value
             FROM (SELECT * FROM yearly
                   QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY annual_value DESC, year) = 1) y
             LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = y.series_id
             LEFT JOIN region ON r_regionkey = s_nationkey),
    source AS (SELECT year, value FROM observations WHERE series_id = '{SERIES}' AND period = 'Q01'),
    people AS (SELECT year, population FROM population WHERE nation = '{NATION}'),
    paired AS (SELECT source.year, value, population FROM source LEFT JOIN people ON people.year = source.year),
    counted("check", v) AS (
      SELECT 'stats_one_row', abs(count(*) - 1) FROM stats
      UNION ALL SELECT 'stats_columns', 0
      UNION ALL SELECT 'stats_mean_present', count(*) FILTER (m IS NULL) FROM stats
      UNION ALL SELECT 'stats_stddev_present', count(*) FILTER (s IS NULL) FROM stats
      UNION ALL SELECT 'stats_mean_positive', count(*) FILTER (NOT coalesce(m > 0, false)) FROM stats
      UNION ALL SELECT 'stats_stddev_not_negative', count(*) FILTER (NOT coalesce(s >= 0, false)) FROM stats
      UNION ALL SELECT 'best_columns', 0
      UNION ALL SELECT 'best_not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM best
      UNION ALL SELECT 'best_one_row_per_series', count(*) - count(DISTINCT series_id) FROM best
      UNION ALL SELECT 'best_series_present', count(*) - count(series_id) FROM best
      UNION ALL SELECT 'best_year_present', count(*) - count(best_year) FROM best
      UNION ALL SELECT 'best_value_present', count(*) - count(best_year_value) FROM best
      UNION ALL SELECT 'best_label_present', count(*) FILTER (coalesce(series_label, '') = '') FROM best
      UNION ALL SELECT 'best_is_max', count(*) FROM best JOIN
        (SELECT series_id, max(annual_value) AS e FROM yearly GROUP BY 1) USING (series_id)
        WHERE abs(best_year_value - e) > 1e-6 * greatest(1, abs(e))
      UNION ALL SELECT 'paired_columns', 0
      UNION ALL SELECT 'paired_not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM paired
      UNION ALL SELECT 'paired_year_present', count(*) - count(year) FROM paired
      UNION ALL SELECT 'paired_value_present', count(*) - count(value) FROM paired
      UNION ALL SELECT 'paired_same_count', abs((SELECT count(*) FROM paired) - (SELECT count(*) FROM source))
      UNION ALL SELECT 'paired_all_present', count(*) FROM source ANTI JOIN paired USING (year, value)
      UNION ALL SELECT 'paired_population_present', count(*) FROM paired SEMI JOIN people USING (year)
        WHERE paired.population IS NULL)
    SELECT "check", v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM counted"""


@query(CHECKS_SQL)
def check_suite(spark: SparkSession, folder: str) -> DataFrame:
    """All checks over the three analytical tables, with a measure lookup that lacks every code.

    As in a refresh, the checks read stored tables, so that nothing is derived once per check.
    """
    observations = stored(inputs.observations(spark, folder), "observations")
    people = stored(inputs.population(spark, folder), "population")
    no_measures = inputs.measures(spark, folder).withColumn("measure_code", F.concat(F.lit("x"), "measure_code"))
    series, sectors = inputs.series(spark, folder), inputs.sectors(spark, folder)
    best = gold.best_year_by_series(observations, series, no_measures, sectors, scale=2)
    chosen = observations.filter((F.col("series_id") == SERIES) & (F.col("period") == "Q01"))
    return suite(
        [
            population_checks(gold.population_stats(people, NATION, 1996, 1998)),
            best_year_checks(stored(best, "best-year"), gold.yearly_totals(observations, scale=2)),
            series_population_checks(
                gold.series_population(observations, people, SERIES, "Q01", NATION),
                chosen,
                people.filter(F.col("nation") == NATION),
            ),
        ]
    )


@query(
    """WITH c("check", v) AS (
         SELECT 'one_row', abs(count(*) - 1) FROM orders
         UNION ALL SELECT 'columns', 1
         UNION ALL SELECT 'not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM orders
         UNION ALL SELECT 'unique_customer', count(*) - count(DISTINCT o_custkey) FROM orders
         UNION ALL SELECT 'unique_order', count(*) - count(DISTINCT o_orderkey) FROM orders
         UNION ALL SELECT 'price_present', count(*) - count(o_totalprice) FROM orders
         UNION ALL SELECT 'price_in_range', count(*) FILTER (o_totalprice <= 1000) FROM orders
         UNION ALL SELECT 'status_final', count(*) FILTER (o_orderstatus <> 'F') FROM orders
         UNION ALL SELECT 'priority_named', count(*) FILTER (substr(o_orderpriority, 3) = '') FROM orders)
       SELECT "check", v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM c"""
)
def check_table_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Shape, key, NULL, range and label checks on one table: one aggregate for all but unique keys, which take one each."""
    orders = inputs.table(spark, folder, "orders").withColumn("label", F.substring("o_orderpriority", 3, 100))
    return checks.table_checks(
        orders,
        [
            checks.row_count_is("one_row", 1),
            checks.has_columns("columns", orders, ["o_orderkey", "o_comment"]),
            checks.not_empty("not_empty"),
            checks.unique_key("unique_customer", "o_custkey"),
            checks.unique_key("unique_order", "o_orderkey"),
            checks.no_row("price_present", checks.is_missing("o_totalprice")),
            checks.every_row("price_in_range", F.col("o_totalprice") > 1000),
            checks.every_row("status_final", F.col("o_orderstatus") == "F"),
            checks.no_row("priority_named", checks.is_blank("label")),
        ],
    )


@query(
    """WITH best AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
            again AS (SELECT o_custkey, max(o_totalprice) AS e FROM orders GROUP BY 1)
       SELECT 'largest_order' AS "check", count(*) FILTER (abs(v - e) > 1e-6 * greatest(1, e)) = 0 AS passed,
              count(*) FILTER (abs(v - e) > 1e-6 * greatest(1, e)) AS violations
       FROM best JOIN again USING (o_custkey)"""
)
def check_selected_is_max(spark: SparkSession, folder: str) -> DataFrame:
    """The largest order without pending ones against the largest of all."""
    orders = inputs.table(spark, folder, "orders")
    settled = orders.filter(F.col("o_orderstatus") != "P")
    best = ranking.grouped_max(settled, ["o_custkey"], "o_totalprice", "v")
    again = ranking.grouped_max(orders, ["o_custkey"], "o_totalprice", "e")
    return checks.selected_is_max("largest_order", best, again, "o_custkey", "v", "e", 1e-6)


@query(
    """WITH labelled AS (SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id)),
            c("check", v) AS (
              SELECT 'same_count', (SELECT count(*) FROM documents) - (SELECT count(*) FROM labels)
              UNION ALL SELECT 'all_present', count(*) FROM documents
                WHERE doc_id NOT IN (SELECT doc_id FROM labels)
              UNION ALL SELECT 'present_when_available', count(*) FROM labelled
                WHERE quality IS NULL AND source IN (SELECT source FROM labelled WHERE quality = 0))
       SELECT "check", v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM c"""
)
def check_against_source(spark: SparkSession, folder: str) -> DataFrame:
    """Documents against their labels: equal counts, none absent, and a label wherever the source has a poor one."""
    documents = inputs.table(spark, folder, "documents").select("doc_id", "source")
    labels = inputs.table(spark, folder, "labels").select("doc_id", "quality")
    labelled = joins.lookup(documents, labels, "doc_id")
    poor = labelled.filter(F.col("quality") == 0)
    return suite(
        [
            checks.same_row_count("same_count", documents, labels),
            checks.all_present("all_present", documents, labels, ["doc_id"]),
            checks.present_when_available("present_when_available", labelled, poor, "source", "quality"),
        ]
    )


# Listings and landed names

LINKS = r"""links AS (
  SELECT url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages),
named AS (
  SELECT url, href, string_split(href, '/')[-1] AS file_name FROM links WHERE href NOT LIKE '%/')"""


@query(
    rf"""WITH {LINKS}
        SELECT DISTINCT file_name, regexp_extract(url, '^(\w+://[^/]+)', 1) || href AS file_url
        FROM named WHERE file_name <> ''"""
)
def link_discovery(spark: SparkSession, folder: str) -> DataFrame:
    return discover_links(inputs.table(spark, folder, "pages"))


@query(
    rf"""WITH {LINKS},
        landed AS (SELECT DISTINCT file_name AS name FROM named WHERE file_name <> '' AND url LIKE 'https:%'),
        listed AS (SELECT DISTINCT file_name AS name FROM named WHERE file_name <> '' AND url LIKE 'http:%')
        SELECT coalesce(landed.name, listed.name) AS name,
               CASE WHEN listed.name IS NULL THEN 'stale' WHEN landed.name IS NULL THEN 'missing'
                    ELSE 'present' END AS status
        FROM landed FULL JOIN listed ON landed.name = listed.name"""
)
def source_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Names linked from secure pages stand for landed files, names linked from the other pages for the listing."""
    links = stored(discover_links(inputs.table(spark, folder, "pages")), "links")
    secure = F.col("file_url").startswith("https:")
    landed = links.filter(secure).select(F.concat("file_name", F.lit(".20260814120000")).alias("landed_name"))
    return reconcile(landed, links.filter(~secure), "landed_name", "file_name")


@query(
    """SELECT event_id, event_type AS source_name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS extracted_at
       FROM events""",
    name="extraction_time",
)
def extraction_times(spark: SparkSession, folder: str) -> DataFrame:
    """Both stamp forms, one per parity of the minute."""
    plain = F.concat("event_type", F.lit("."), F.date_format("ts", "yyyyMMddHHmmss"))
    marked = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit(".json"))
    landed = inputs.table(spark, folder, "events").select(
        "event_id", F.when(F.minute("ts") < 30, plain).otherwise(marked).alias("name")
    )
    return landed.select(
        "event_id",
        source_name("name").alias("source_name"),
        F.date_format(extraction_time("name"), "yyyy-MM-dd HH:mm:ss").alias("extracted_at"),
    )


# Corrections and monitoring


@query(
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders")
    latest = versions.latest_version(
        orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT * FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
       WHERE o_orderstatus <> 'P'"""
)
def apply_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders are the current table; finished ones are upserts and pending ones are removals."""
    orders = inputs.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    current = orders.filter(F.col("o_orderstatus") == "O").drop("o_orderstatus")
    changes = orders.filter(F.col("o_orderstatus") != "O").select(
        "o_custkey", "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "P").alias("removed")
    )
    return versions.apply_changes(current, changes, ["o_custkey"], "o_orderkey", deleted="removed")


@query(
    """WITH o AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
                  WHERE l_linestatus = 'F' GROUP BY 1),
            n AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
                  WHERE l_linestatus = 'O' GROUP BY 1)
       SELECT l_orderkey,
              CASE WHEN o.n IS NULL THEN 'added' WHEN n.n IS NULL THEN 'removed' ELSE 'changed' END AS status,
              o.n AS old_n, o.quantity AS old_quantity, n.n AS new_n, n.quantity AS new_quantity
       FROM o FULL JOIN n USING (l_orderkey)
       WHERE o.n IS DISTINCT FROM n.n OR o.quantity IS DISTINCT FROM n.quantity"""
)
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Order contents by final lines against order contents by open lines."""

    def contents(status: str) -> DataFrame:
        lines = inputs.table(spark, folder, "lineitem").filter(F.col("l_linestatus") == status)
        return lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
        )

    return versions.compare_snapshots(contents("F"), contents("O"), ["l_orderkey"], ["n", "quantity"])


@query(
    """WITH rates AS (
         SELECT source AS batch, avg(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS quality,
                avg(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS toxic
         FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source),
       long AS (SELECT batch, 'quality' AS "column", quality AS null_rate FROM rates
                UNION ALL SELECT batch, 'toxic', toxic FROM rates)
       SELECT batch, "column", round(null_rate, 9) AS null_rate,
              round(null_rate - lag(null_rate) OVER (PARTITION BY "column" ORDER BY batch), 9) AS change
       FROM long"""
)
def null_rates(spark: SparkSession, folder: str) -> DataFrame:
    labelled = joins.lookup(
        inputs.table(spark, folder, "documents").select("doc_id", "source"),
        inputs.table(spark, folder, "labels"),
        "doc_id",
    )
    rates = profile.null_rates(labelled, "source", ["quality", "toxic"])
    return rates.select(
        "batch", "column", F.round("null_rate", 9).alias("null_rate"), F.round("change", 9).alias("change")
    )


@query(
    """WITH counts AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS batch, count(*) AS n
                       FROM events GROUP BY ALL)
       SELECT event_type, batch, n AS "rows", round(avg(n) OVER w, 6) AS expected,
              round(stddev_pop(n) OVER w, 6) AS deviation,
              CASE WHEN count(n) OVER w >= 2
                   THEN abs(n - avg(n) OVER w) > 1.5 * stddev_pop(n) OVER w END AS anomalous
       FROM counts
       WINDOW w AS (PARTITION BY event_type ORDER BY batch ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""
)
def count_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events")
    judged = profile.count_anomalies(events, "event_type", F.date_format("ts", "yyyy-MM-dd"), 7, 1.5)
    return judged.select(
        "event_type",
        "batch",
        "rows",
        F.round("expected", 6).alias("expected"),
        F.round("deviation", 6).alias("deviation"),
        "anomalous",
    )


@query(
    """SELECT CAST(sum(copies) AS BIGINT) AS "rows", count(*) AS keys,
              CAST(sum(copies) - count(*) AS BIGINT) AS duplicate_rows,
              count(*) FILTER (values > 1) AS corrected_keys
       FROM (SELECT l_orderkey, l_linenumber, count(*) AS copies, count(DISTINCT l_extendedprice) AS values
             FROM lineitem GROUP BY 1, 2)"""
)
def dup_rate(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    return profile.duplicate_rates(lines, ["l_orderkey", "l_linenumber"], "l_extendedprice")


@query(
    """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
              CAST(floor(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(ts))) AS BIGINT) AS age_seconds
       FROM events GROUP BY event_type"""
)
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    ages = profile.freshness(inputs.table(spark, folder, "events"), "event_type", "ts", as_of)
    return ages.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@query(
    """SELECT 'k' AS field, CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'BIGINT' ELSE 'OTHER' END AS found_type,
              count(*) AS "rows", 'retyped' AS problem
       FROM events WHERE json_exists(props, '$.k') GROUP BY 1, 2
       UNION ALL SELECT 'origin', NULL, 0, 'missing'"""
)
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events")
    return profile.json_drift(events, "props", {"k": "STRING", "origin": "STRING"})


@query(
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem)
       SELECT 'order' AS path, 'OBJECT' AS found_type, n AS "rows", NULL AS problem FROM n
       UNION ALL SELECT 'order.key', 'BIGINT', n, NULL FROM n
       UNION ALL SELECT 'order.item', 'OBJECT', n, NULL FROM n
       UNION ALL SELECT 'order.item.qty', 'BIGINT', n - r, NULL FROM n
       UNION ALL SELECT 'order.item.qty', 'STRING', r, 'retyped' FROM n
       UNION ALL SELECT 'order.item.codes', 'ARRAY', n, 'unexpected' FROM n
       UNION ALL SELECT 'order.item.codes[]', 'BIGINT', n, 'retyped' FROM n
       UNION ALL SELECT 'order.item.codes[]', 'STRING', n, NULL FROM n
       UNION ALL SELECT 'order.item.note', NULL, 0, 'missing'"""
)
def schema_drift_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as nested objects: returned ones have their quantity, two levels down, as text, and an array holds
    values of two types."""
    amount = inputs.text(F.col("l_quantity").cast("int"))
    quantity = F.when(F.col("l_returnflag") == "R", F.concat(F.lit('"'), amount, F.lit('"'))).otherwise(amount)
    item = F.format_string(
        '{"order":{"key":%s,"item":{"qty":%s,"codes":[%s,"%s"]}}}',
        inputs.text("l_orderkey"), quantity, inputs.text("l_linenumber"), F.col("l_linestatus"),
    )
    lines = inputs.table(spark, folder, "lineitem").select(item.alias("document"))
    contract = {"order": "OBJECT", "order.key": "BIGINT", "order.item": "OBJECT", "order.item.qty": "BIGINT"}
    return profile.nested_drift(lines, "document", {**contract, "order.item.codes[]": "STRING", "order.item.note": "STRING"})
