"""Incremental loads and upserts.

Three pairs of whole tables stand for a curated table and a batch:

* orders, and their totals recomputed from all line items: most totals differ,
  some orders have no line items;
* the reverse, so that orders without line items are new;
* run measurements from view executions, and from click executions: runs known
  to one side only, to both with equal values, and to both with different ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bindings.registry import query
from tidemark.bindings.tables import STAGE_RUNS, stage_runs, table
from tidemark.operators import merge
from tidemark.operators.enrich import backfill_lineage
from tidemark.plans.scratch import materialized, scratch_dir
from tidemark.sources import tables
from tidemark.sources.keyed import KeyedTable


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_orderstatus").alias("title"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
    )


def _recomputed(spark, sf_dir):
    """Per order: its line status, null for orders with mixed lines, and its total."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("post_id"))
        .agg(
            F.when(F.every(F.col("l_linestatus") == "O"), "O")
            .when(F.every(F.col("l_linestatus") == "F"), "F")
            .alias("title"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
            .cast("decimal(18,2)")
            .alias("total"),
        )
    )


PAIR = """o AS (SELECT o_orderkey AS k, o_orderstatus AS title,
                CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders),
r AS (SELECT l_orderkey AS k,
             CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) END AS title,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
      FROM lineitem GROUP BY 1)"""


def _merge_sql(existing: str, incoming: str, same: str) -> str:
    return f"""SELECT coalesce(e.k, i.k) AS post_id, coalesce(i.title, e.title) AS title,
       CAST(coalesce(i.total, e.total) AS DOUBLE) AS total,
       'jsonplaceholder_api' AS source_system, 'legacy_incremental_load' AS source_file,
       CASE WHEN e.k IS NULL THEN 'INSERTED' WHEN i.k IS NULL THEN 'KEPT'
            WHEN {same} THEN 'UNCHANGED' ELSE 'UPDATED' END AS change
FROM {existing} e FULL JOIN {incoming} i ON e.k = i.k"""


ALL_SAME = "e.title IS NOT DISTINCT FROM i.title AND e.total IS NOT DISTINCT FROM i.total"
TITLE_SAME = "e.title IS NOT DISTINCT FROM i.title"


def _shown(merged):
    return merged.withColumn("total", F.col("total").cast("double"))


@query("f2_upsert", f"WITH {PAIR} {_merge_sql('o', 'r', ALL_SAME)}")
def _(spark, sf_dir):
    batch = materialized(_recomputed(spark, sf_dir), "f2")
    return _shown(merge.upsert(_orders(spark, sf_dir), batch, "post_id"))


@query("f2_upsert_full_outer", f"WITH {PAIR} {_merge_sql('o', 'r', TITLE_SAME)}")
def _(spark, sf_dir):
    return _shown(
        merge.upsert(
            _orders(spark, sf_dir),
            _recomputed(spark, sf_dir),
            "post_id",
            compare=["title"],
            strategy="full_outer",
        )
    )


@query("f2_upsert_lookup", f"WITH {PAIR} {_merge_sql('r', 'o', TITLE_SAME)}")
def _(spark, sf_dir):
    return _shown(
        merge.upsert(
            _recomputed(spark, sf_dir),
            _orders(spark, sf_dir),
            "post_id",
            compare=["title"],
            strategy="lookup",
        )
    )


def _measured(spark, sf_dir, stage):
    """Runs of one stage: how often it ran, and its slow executions, null for none."""
    rows = stage_runs(spark, sf_dir).filter(F.col("stage_name") == stage)
    slow = F.count_if(F.col("duration") > 50)
    return rows.groupBy("run_id").agg(
        F.count("*").alias("executions"), F.when(slow > 0, slow).alias("slow")
    )


def _measured_sql(name: str, stage: str) -> str:
    return f"""{name} AS (
  SELECT run_id AS k, count(*) AS executions,
         CASE WHEN count(*) FILTER (WHERE duration > 50) > 0
              THEN count(*) FILTER (WHERE duration > 50) END AS slow
  FROM stage_runs WHERE stage_name = '{stage}' GROUP BY 1)"""


MEASURED = f"WITH {STAGE_RUNS}, {_measured_sql('e', 'view')}, {_measured_sql('i', 'click')}"
CHANGES = f"""{MEASURED}, merged AS (
SELECT coalesce(e.k, i.k) AS run_id, coalesce(i.executions, e.executions) AS executions,
       coalesce(i.slow, e.slow) AS slow,
       CASE WHEN e.k IS NULL THEN 'INSERTED' WHEN i.k IS NULL THEN 'KEPT'
            WHEN e.executions = i.executions AND e.slow IS NOT DISTINCT FROM i.slow
            THEN 'UNCHANGED' ELSE 'UPDATED' END AS change
FROM e FULL JOIN i ON e.k = i.k)"""


def _measured_merge(spark, sf_dir, **options):
    return merge.upsert(
        _measured(spark, sf_dir, "view"),
        _measured(spark, sf_dir, "click"),
        "run_id",
        lineage=False,
        **options,
    )


@query("f2_upsert_runs", f"{CHANGES} SELECT * FROM merged")
def _(spark, sf_dir):
    return _measured_merge(spark, sf_dir)


@query(
    "f3_change_counts",
    f"""{CHANGES} SELECT count(*) FILTER (WHERE change = 'INSERTED') AS inserted,
               count(*) FILTER (WHERE change = 'UPDATED') AS updated,
               count(*) FILTER (WHERE change = 'UNCHANGED') AS unchanged,
               count(*) FILTER (WHERE change = 'KEPT') AS kept FROM merged""",
)
def _(spark, sf_dir):
    return merge.change_counts(_measured_merge(spark, sf_dir))


INSERT_ONLY = f"""WITH {STAGE_RUNS}, existing AS (
  SELECT run_id, stage_name, event_id FROM stage_runs WHERE stage_name = 'error'
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_id) = 1),
added AS (
  SELECT run_id, stage_name, event_id FROM stage_runs
  WHERE run_id NOT IN (SELECT run_id FROM existing)
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_id) = 1)"""


@query(
    "f1_insert_only",
    f"{INSERT_ONLY} SELECT * FROM existing UNION ALL SELECT * FROM added",
)
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir).select("run_id", "stage_name", "event_id")
    existing = rows.filter(F.col("stage_name") == "error")
    return merge.insert_only(
        existing, rows, "run_id", order_by=["event_id"], existing_order=["event_id"]
    )


@query(
    "f1_incremental_append",
    f"{INSERT_ONLY} SELECT * FROM existing UNION ALL SELECT * FROM added",
)
def _(spark, sf_dir):
    """The curated table on disk gains the unseen rows; a second load adds none."""
    rows = stage_runs(spark, sf_dir).select("run_id", "stage_name", "event_id")
    path = scratch_dir(spark, "f1")
    existing = rows.filter(F.col("stage_name") == "error")
    merge.keep_first(existing, "run_id", ["event_id"]).write.parquet(path)
    tables.append_new_rows(rows, path, "run_id", ["event_id"])
    tables.append_new_rows(rows, path, "run_id", ["event_id"])
    return tables.read_table(spark, path)


@query("f1_appended_rows", f"{INSERT_ONLY} SELECT * FROM added")
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir).select("run_id", "stage_name", "event_id")
    existing = rows.filter(F.col("stage_name") == "error")
    return merge.new_rows(existing, rows, "run_id", ["event_id"])


@query(
    "f4_lineage_backfill",
    """SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'reviewed' END,
                'jsonplaceholder_api') AS source_system,
              'legacy_incremental_load' AS source_file
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    known = docs.join(labels, "doc_id", "left").select(
        "doc_id", F.when(F.col("quality") == 1, "reviewed").alias("source_system")
    )
    return backfill_lineage(known)


@query(
    "f5_sorted_files",
    """SELECT count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
              CAST(0 AS BIGINT) AS out_of_order FROM orders""",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "f5")
    merge.sorted_by_key(_orders(spark, sf_dir), "post_id").write.parquet(path)
    files = (
        spark.read.parquet(path)
        .select("post_id", F.col("_metadata.file_name").alias("file"))
        .groupBy("file")
        .agg(F.min("post_id").alias("low"), F.max("post_id").alias("high"), F.count("*").alias("n"))
    )
    # One row per written file; files are numbered in key order.
    files = files.withColumn("number", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
    after = files.select((F.col("number") + 1).alias("number"), F.col("high").alias("before"))
    return files.join(after, "number", "left").agg(
        F.sum("n").alias("rows"),
        F.min("low").alias("first_key"),
        F.max("high").alias("last_key"),
        F.count_if(F.col("before") >= F.col("low")).alias("out_of_order"),
    )


@query(
    "f6_replace_target",
    f"WITH {PAIR} SELECT * EXCLUDE (change) FROM ({_merge_sql('o', 'r', ALL_SAME)})",
)
def _(spark, sf_dir):
    """The table is merged in place of its files, and read again from its newest version."""
    target = KeyedTable(spark, scratch_dir(spark, "f6"), "post_id")
    target.merge(_orders(spark, sf_dir), lineage=False)
    target.merge(materialized(_recomputed(spark, sf_dir), "f6"))
    return _shown(target.read())


@query(
    "f6_untouched_files",
    """WITH touched AS (SELECT max(c_custkey) AS k FROM customer),
spread AS (SELECT o_orderkey > (SELECT k FROM touched) AS beyond FROM orders)
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE NOT beyond) AS BIGINT) AS rows_of_customers,
       true AS one_file_or_more_stays, true AS names_stay, CAST(0 AS BIGINT) AS out_of_range
FROM spread""",
)
def _(spark, sf_dir):
    """Orders with customers' keys get new titles; files with higher keys only are kept."""
    target = KeyedTable(spark, scratch_dir(spark, "f6"), "post_id", rows_per_file=1000)
    orders = _orders(spark, sf_dir)
    first = target.merge(orders, lineage=False)
    last = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    batch = orders.where(F.col("post_id") <= last).withColumn("title", F.lit("X"))
    second = target.merge(batch, lineage=False)
    before, after = target.parts(first.version), target.parts(second.version)
    beyond = {p.file for p in before if p.low > last}
    kept = {p.file for p in before} & {p.file for p in after}
    name = F.regexp_extract("_metadata.file_path", "data/[^/]+/piece=[^/]+/[^/]+$", 0)
    files = target.read().select("title", "post_id", name.alias("file"))
    # One row for each file of the table.
    ranges = spark.createDataFrame([(p.file, p.low, p.high) for p in after], "file string, low long, high long")
    outside = ~F.col("post_id").between(F.col("low"), F.col("high"))
    return files.join(ranges, "file").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("title") == "X").alias("rows_of_customers"),
        F.lit(len(kept) > 0).alias("one_file_or_more_stays"),
        F.lit(beyond <= kept).alias("names_stay"),
        F.count_if(outside).alias("out_of_range"),
    )


@query(
    "a12_first_run",
    """SELECT o_orderkey AS post_id, o_orderstatus AS title,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total, 'INSERTED' AS change
       FROM orders""",
)
def _(spark, sf_dir):
    incoming = _orders(spark, sf_dir)
    root = scratch_dir(spark, "a12")
    existing = tables.read_current(spark, root)
    if existing is None:
        existing = spark.createDataFrame([], incoming.schema)
    return _shown(merge.upsert(existing, incoming, "post_id", lineage=False))
