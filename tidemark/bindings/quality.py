"""Data-quality, schema, freshness and relationship checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.bindings.registry import query
from tidemark.bindings.tables import customers, documents, orders, stage_runs, table
from tidemark.operators import checks, enrich

CHECK = "AS t(check_name, status, violations, detail)"


def _labelled(spark, sf_dir):
    """Every document with its label, if it has one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _staged(spark, sf_dir):
    """Documents as fully staged posts."""
    raw = table(spark, sf_dir, "documents").select(
        F.xxhash64("source").alias("userId"),
        F.col("doc_id").alias("id"),
        F.col("source").alias("title"),
        F.col("text").alias("body"),
    )
    return enrich.enrich_posts(raw, "documents", F.expr("TIMESTAMP'2026-08-12 00:00:00Z'"))


@query(
    "d1_required_columns",
    """SELECT 'required_columns' AS check_name, 'FAILED' AS status, CAST(1 AS BIGINT) AS violations,
              'Missing columns: processed_at' AS detail FROM documents HAVING count(*) > 0""",
)
def _(spark, sf_dir):
    suite = checks.validation_suite(documents(spark, sf_dir))
    return suite.filter(F.col("check_name") == "required_columns").drop("position")


@query(
    "d2_not_empty",
    """SELECT 'not_empty' AS check_name, CASE WHEN count(*) = 0 THEN 'FAILED' ELSE 'PASSED' END
              AS status, CAST(count(*) = 0 AS BIGINT) AS violations,
              CASE WHEN count(*) = 0 THEN 'Dataset is empty' ELSE '' END AS detail
       FROM documents""",
)
def _(spark, sf_dir):
    suite = checks.validation_suite(documents(spark, sf_dir))
    return suite.filter(F.col("check_name") == "not_empty").drop("position")


@query(
    "d3_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf_dir):
    key = F.struct("l_orderkey", "l_linenumber").alias("key")
    lines = table(spark, sf_dir, "lineitem").select(key)
    return checks.duplicate_keys(lines, "key").select("key.*", "rows")


@query(
    "d3_unique_key",
    """SELECT CAST(count(*) - count(DISTINCT user_id) AS BIGINT) AS duplicates,
              (SELECT count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1))
                AS repeated_keys
       FROM events""",
)
def _(spark, sf_dir):
    return checks.key_summary(table(spark, sf_dir, "events"), "user_id")


@query(
    "d4_null_counts",
    f"""WITH {LABELLED} SELECT * FROM (
          SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS null_count FROM labelled
          UNION ALL SELECT 'source', count(*) - count(source) FROM labelled
          UNION ALL SELECT 'quality', count(*) - count(quality) FROM labelled
          UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM labelled)""",
)
def _(spark, sf_dir):
    columns = ["doc_id", "source", "quality", "toxic"]
    return checks.null_counts(_labelled(spark, sf_dir), columns)


@query(
    "d5_length_consistency",
    """SELECT count(*) FILTER (WHERE n_chars IS DISTINCT FROM length(text)) AS wrong,
              count(*) FILTER (WHERE n_chars IS DISTINCT FROM strlen(text)) AS wrong_in_bytes
       FROM documents""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    in_bytes = ~F.coalesce(F.col("n_chars") == F.octet_length("text"), F.lit(False))
    return docs.agg(
        F.count_if(checks.length_mismatch("n_chars", "text")).alias("wrong"),
        F.count_if(in_bytes).alias("wrong_in_bytes"),
    )


@query(
    "d6_exact_schema",
    f"""WITH {LABELLED} SELECT * FROM (VALUES
          ('column_present:created_at', 'FAILED', 1::BIGINT, 'Missing columns'),
          ('column_present:doc_id', 'PASSED', 0::BIGINT, ''),
          ('column_present:lang', 'PASSED', 0::BIGINT, ''),
          ('column_present:n_chars', 'PASSED', 0::BIGINT, ''),
          ('column_present:quality', 'PASSED', 0::BIGINT, ''),
          ('column_expected:source', 'FAILED', 1::BIGINT, 'Unexpected columns'),
          ('column_expected:toxic', 'FAILED', 1::BIGINT, 'Unexpected columns'),
          ('column_type:doc_id', 'PASSED', 0::BIGINT, ''),
          ('column_type:lang', 'PASSED', 0::BIGINT, ''),
          ('column_type:n_chars', 'FAILED', 1::BIGINT, 'n_chars must be string')) {CHECK}
        UNION ALL SELECT 'column_type:quality', 'FAILED', 1, 'quality must be integer'
          FROM labelled HAVING count(*) > count(quality)
        UNION ALL SELECT 'column_type:quality', 'PASSED', 0, ''
          FROM labelled HAVING count(*) = count(quality)""",
)
def _(spark, sf_dir):
    expected = {
        "doc_id": "int",
        "lang": "string",
        "n_chars": "string",
        "quality": "int",
        "created_at": "datetime",
    }
    return checks.exact_schema(_labelled(spark, sf_dir), expected).drop("position")


@query(
    "d7_freshness",
    """SELECT 'freshness' AS check_name, label,
              CASE WHEN now - max(ts) > INTERVAL 24 HOUR THEN 'FAILED' ELSE 'PASSED' END AS status
       FROM events, (VALUES ('soon', TIMESTAMP '2024-01-31 12:00:00'),
                            ('late', TIMESTAMP '2024-02-02 00:00:00')) AS t(label, now)
       GROUP BY label, now""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parts = []
    for label, now in (("soon", "2024-01-31 12:00:00"), ("late", "2024-02-02 00:00:00")):
        check = checks.freshness(events, F.expr(f"TIMESTAMP_NTZ'{now}'"), column="ts")
        parts.append(check.select("check_name", F.lit(label).alias("label"), "status"))
    return parts[0].unionByName(parts[1])


@query(
    "d8_relationship",
    """SELECT 'documents' AS child, CASE WHEN count(*) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
              count(*) AS violations
       FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
       UNION ALL
       SELECT 'orders', CASE WHEN count(*) > 0 THEN 'FAILED' ELSE 'PASSED' END, count(*)
       FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    of_documents = checks.relationship(docs, table(spark, sf_dir, "labels"), "doc_id")
    posts = orders(spark, sf_dir).select("post_id", "user_id")
    of_orders = checks.relationship(posts, customers(spark, sf_dir), "user_id")
    return (
        of_documents.withColumn("child", F.lit("documents"))
        .unionByName(of_orders.withColumn("child", F.lit("orders")))
        .select("child", "status", "violations")
    )


ORPHANS = """SELECT d.doc_id, d.source FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL"""


@query("e3_orphans", ORPHANS)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return checks.orphans(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("e3_orphans_salted", ORPHANS)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return checks.orphans(docs, table(spark, sf_dir, "labels"), "doc_id", "salted")


@query(
    "c9_outer_null_filter",
    """SELECT o.o_orderkey, o.o_custkey FROM orders o
       LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON o.o_custkey = e.user_id
       WHERE e.user_id IS NULL""",
)
def _(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    active = table(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey"))
    return checks.orphans(facts, active, "o_custkey").select("o_orderkey", "o_custkey")


@query(
    "d9_total_nulls",
    f"""WITH {LABELLED}
        SELECT CAST(6 * count(*) - count(doc_id) - count(lang) - count(source) - count(n_chars)
                    - count(quality) - count(toxic) AS BIGINT) AS null_values FROM labelled""",
)
def _(spark, sf_dir):
    return checks.quality_metrics(_labelled(spark, sf_dir), "doc_id").select("null_values")


@query(
    "d10_duplicate_count",
    """SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS duplicate_post_ids
       FROM documents""",
)
def _(spark, sf_dir):
    digests = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"))
    return checks.quality_metrics(digests, "digest").select("duplicate_post_ids")


@query("d11_record_count", "SELECT count(*) AS records_checked FROM lineitem")
def _(spark, sf_dir):
    return checks.quality_metrics(table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        "records_checked"
    )


@query(
    "d12_quality_summary",
    f"""WITH {LABELLED}, counted AS (
          SELECT 'labelled' AS name, count(*) AS records_checked,
                 CAST(2 * count(*) - count(quality) - count(toxic) AS BIGINT) AS null_values,
                 CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) AS duplicate_post_ids
          FROM labelled
          UNION ALL SELECT 'lineitem', count(*), 0,
                 CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT) FROM lineitem
          UNION ALL SELECT 'orders', count(*), 0,
                 CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) FROM orders)
        SELECT *, CASE WHEN records_checked = 0 OR null_values > 0 OR duplicate_post_ids > 0
                       THEN 'FAILED' ELSE 'PASSED' END AS quality_status FROM counted""",
)
def _(spark, sf_dir):
    parts = {
        "labelled": checks.quality_metrics(_labelled(spark, sf_dir), "doc_id"),
        "lineitem": checks.quality_metrics(table(spark, sf_dir, "lineitem"), "l_orderkey"),
        "orders": checks.quality_metrics(table(spark, sf_dir, "orders"), "o_orderkey"),
    }
    named = [df.withColumn("name", F.lit(name)) for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "d13_validation_suite",
    f"""SELECT * FROM (VALUES (1, 'required_columns', 'PASSED', 0::BIGINT, ''))
          AS t(position, check_name, status, violations, detail)
        UNION ALL SELECT 2, 'not_empty', CASE WHEN count(*) = 0 THEN 'FAILED' ELSE 'PASSED' END,
          CAST(count(*) = 0 AS BIGINT), CASE WHEN count(*) = 0 THEN 'Dataset is empty' ELSE '' END
          FROM documents
        UNION ALL SELECT 3, 'unique_key',
          CASE WHEN count(*) > count(DISTINCT doc_id) THEN 'FAILED' ELSE 'PASSED' END,
          CAST(count(*) - count(DISTINCT doc_id) AS BIGINT),
          CASE WHEN count(*) > count(DISTINCT doc_id) THEN 'Duplicate post_id values found'
               ELSE '' END FROM documents
        UNION ALL SELECT 4, 'not_null',
          CASE WHEN 2 * count(*) > count(source) + count(text) THEN 'FAILED' ELSE 'PASSED' END,
          CAST(2 * count(*) - count(source) - count(text) AS BIGINT), '' FROM documents
        UNION ALL SELECT 5, 'title_length_consistent', 'PASSED',
          count(*) FILTER (WHERE source IS NULL), '' FROM documents
        UNION ALL SELECT 6, 'body_length_consistent', 'PASSED',
          count(*) FILTER (WHERE n_chars IS DISTINCT FROM length(text)), '' FROM documents""",
)
def _(spark, sf_dir):
    return checks.validation_suite(_staged(spark, sf_dir))


@query(
    "d13_suite_with_freshness",
    """SELECT position, check_name, status, violations, detail FROM (
         SELECT 3 AS position, 'unique_key' AS check_name,
           CASE WHEN count(*) > count(DISTINCT o_custkey) THEN 'FAILED' ELSE 'PASSED' END AS status,
           CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) AS violations,
           CASE WHEN count(*) > count(DISTINCT o_custkey) THEN 'Duplicate o_custkey values found'
                ELSE '' END AS detail FROM orders
         UNION ALL SELECT 5, 'freshness',
           CASE WHEN max(o_orderdate) < TIMESTAMP '2000-01-02' THEN 'FAILED' ELSE 'PASSED' END,
           CAST(max(o_orderdate) < TIMESTAMP '2000-01-02' AS BIGINT),
           CASE WHEN max(o_orderdate) < TIMESTAMP '2000-01-02' THEN 'the newest row is too old' ELSE '' END
         FROM orders)""",
)
def _(spark, sf_dir):
    """Orders as rows of a customer, a day after the turn of the century."""
    suite = checks.validation_suite(
        table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp_ntz")),
        key="o_custkey",
        required=["o_custkey"],
        not_null=["o_custkey"],
        lengths={},
        now=F.lit("2000-01-03").cast("timestamp_ntz"),
        fresh="at",
    )
    return suite.filter(F.col("check_name").isin("unique_key", "freshness"))


@query(
    "d13_validation_suite_failing",
    """SELECT 'unique_key' AS check_name, 'FAILED' AS status,
              CAST(count(*) - count(DISTINCT user_id) AS BIGINT) AS violations,
              'Duplicate user_id values found' AS detail FROM events""",
)
def _(spark, sf_dir):
    suite = checks.validation_suite(
        stage_runs(spark, sf_dir).withColumn(
            "user_id", F.floor(F.col("run_id").cast("long") / 100)
        ),
        key="user_id",
        required=["run_id", "stage_name", "duration"],
        not_null=["run_id", "stage_name", "duration"],
        lengths={},
    )
    return suite.filter(F.col("status") == "FAILED").drop("position")


@query(
    "k3_column_difference",
    """SELECT side, column_name FROM (VALUES
         ('missing', 'processed_at'), ('missing', 'source_file'), ('missing', 'source_system'),
         ('unexpected', 'posts_seen')) AS t(side, column_name)
       WHERE (SELECT count(*) FROM documents) > 0""",
)
def _(spark, sf_dir):
    posts = documents(spark, sf_dir)
    posts = posts.withColumn("posts_seen", F.lit(True)).withColumn("title_length", F.lit(1))
    failed = checks.exact_schema(posts, schemas.POST_TYPES).filter(F.col("status") == "FAILED")
    return failed.filter(F.col("position") < 2).select(
        F.when(F.col("position") == 0, "missing").otherwise("unexpected").alias("side"),
        F.element_at(F.split("check_name", ":"), 2).alias("column_name"),
    )
