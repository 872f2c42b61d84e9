"""Columns, snapshots, syncs and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from query_suite.base import query, table
from rulemark.operators import columns, snapshot, sync
from rulemark.options import ReadOptions, WriteOptions
from rulemark.sources.export import export_csv
from rulemark.sources.files import FILE, read_folder
from rulemark.sources.storage import new_folder


@query("SELECT s_suppkey AS Postavshchik, s_name AS sname, s_nationkey AS \"1nation\", s_acctbal AS sname_1 FROM supplier")
def clean_columns(spark, sf):
    dirty = table(spark, sf, "supplier").toDF("Поставщик", "s name", "1 nation!", "s-name")
    return columns.rename_clean(dirty)


@query(
    """SELECT *, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS c_name_1 FROM customer"""
)
def label_columns(spark, sf):
    """Empty label columns beside the main ones, names cleaned jointly."""
    return columns.add_label_columns(table(spark, sf, "customer"), "seg ment", "c_name")


@query(
    """SELECT *, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS rank, CAST(NULL AS DOUBLE) AS weight FROM nation"""
)
def typed_columns(spark, sf):
    return columns.add_columns(table(spark, sf, "nation"), note="text", rank="INTEGER", weight="REAL")


DATED = "SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus, strftime(o_orderdate, '%d.%m.%Y') AS local_day FROM orders"


def _dated(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus",
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("local_day"),
    )


@query(
    f"""WITH d AS ({DATED}) UNPIVOT (SELECT
    avg(regexp_full_match(COLUMNS(*), '[0-9]{{4}}[-/.][0-9]{{2}}[-/.][0-9]{{2}}')::INT) FROM d) ON COLUMNS(*) INTO NAME column_name VALUE share"""
)
def date_shares(spark, sf):
    """Share of the values of every column that look like a date."""
    return snapshot.date_shares(_dated(spark, sf))


@query(f"WITH d AS ({DATED}) SELECT 'day' AS date_column, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM d")
def detect_date_column(spark, sf):
    """The date column of a text table, judged by all its rows, and its range."""
    data = _dated(spark, sf)
    found = snapshot.detect_date_column(data, "local_day", sample_rows=None)
    return data.agg(
        F.lit(found).alias("date_column"), F.count("*").alias("n"), F.min(found).alias("first_day"), F.max(found).alias("last_day")
    )


@query(
    """SELECT user_id, event_type, value, props FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1"""
)
def latest_per_key(spark, sf):
    return snapshot.latest_per_key(
        table(spark, sf, "events"), "user_id", ["event_type", "value", "props"], "ts", ("event_id",)
    )


@query(
    """SELECT l_partkey, l_returnflag, l_orderkey, n_rows FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n_rows,
    row_number() OVER (PARTITION BY l_partkey ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC, l_orderkey, l_linenumber,
    l_suppkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1"""
)
def latest_per_key_text_date(spark, sf):
    """The date as text, ties broken by several columns, and the rows per key."""
    lines = table(spark, sf, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return snapshot.latest_per_key(
        lines, "l_partkey", ["l_returnflag", "l_orderkey"], "day",
        ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"), count_as="n_rows",
    )


@query(
    """SELECT o_custkey, o_orderstatus, o_totalprice FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1"""
)
def any_per_key(spark, sf):
    """Without a date: the first row of each key."""
    return snapshot.latest_per_key(
        table(spark, sf, "orders"), "o_custkey", ["o_orderstatus", "o_totalprice"], None, ("o_orderkey",)
    )


def _orders_and_segments(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    customers = table(spark, sf, "customer").filter("c_acctbal > 0")
    return orders, customers.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))


SEGMENTS = "s AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0)"


@query(
    f"""WITH {SEGMENTS} SELECT o_orderkey, o_custkey, CASE WHEN c_custkey IS NULL THEN o_orderpriority ELSE c_mktsegment END AS label
    FROM orders LEFT JOIN s ON c_custkey = o_custkey"""
)
def sync_update(spark, sf):
    target, source = _orders_and_segments(spark, sf)
    return sync.update_from(target, source, "o_custkey", ["label"])


@query(
    f"""WITH {SEGMENTS} SELECT o_orderkey, o_custkey, o_orderpriority AS label FROM orders
    UNION ALL SELECT NULL, c_custkey, c_mktsegment FROM s WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"""
)
def sync_insert_missing(spark, sf):
    target, source = _orders_and_segments(spark, sf)
    return sync.insert_missing(target, source, "o_custkey", ["o_custkey", "label"])


@query(
    f"""WITH {SEGMENTS} SELECT o_orderkey, o_custkey, o_orderpriority AS label FROM orders
    WHERE EXISTS (SELECT 1 FROM s WHERE o_custkey = c_custkey)"""
)
def sync_delete_missing(spark, sf):
    target, source = _orders_and_segments(spark, sf)
    return sync.delete_missing(target, source, "o_custkey")


@query(
    f"""WITH {SEGMENTS} SELECT o_orderkey, o_custkey, c_mktsegment AS label FROM orders JOIN s ON c_custkey = o_custkey
    UNION ALL SELECT NULL, c_custkey, c_mktsegment FROM s WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def sync_tables(spark, sf):
    target, source = _orders_and_segments(spark, sf)
    return sync.sync_tables(target, source, "o_custkey", ["o_custkey", "label"])


@query(
    """SELECT DISTINCT p_brand, p_type, CASE WHEN p_size < 25 THEN p_brand END AS a, CASE WHEN p_size > 10 THEN p_type END AS b
    FROM part WHERE p_size >= 25 OR p_size <= 10"""
)
def unmapped_rows(spark, sf):
    part = table(spark, sf, "part").selectExpr(
        "p_brand", "p_type", "CASE WHEN p_size < 25 THEN p_brand END AS a", "CASE WHEN p_size > 10 THEN p_type END AS b"
    )
    return sync.unmapped_rows(part, ["p_brand", "p_type"], ["a", "b"])


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# --- files ---------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def csv_roundtrip(spark, sf):
    """Whole texts, with line breaks and quotes, through gzip text files with a byte order mark."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    done = export_csv(documents, new_folder(spark, "csv"), "documents", WriteOptions(include_bom=True))
    return read_folder(spark, done.path, "gz").select("doc_id", "text", "lang", "n_chars")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def csv_quoted_lines(spark, sf):
    """The same texts through plain files, each of which is divided among tasks though its fields hold line breaks."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    done = export_csv(documents, new_folder(spark, "csv"), "documents", WriteOptions(compression=None))
    return read_folder(spark, done.path, "csv").select("doc_id", "text", "lang", "n_chars")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name FROM customer")
def csv_union_by_position(spark, sf):
    """Files with other headers, read together under the header of the first."""
    folder = new_folder(spark, "union")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("i-d"), F.col("n_name").alias("name"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    plain = WriteOptions(compression=None)
    export_csv(nations, folder, "a", plain)
    export_csv(customers, folder, "b", plain)
    deep = ReadOptions(include_subfolders=True, multi_line=False)
    return read_folder(spark, folder, "csv", deep).select("id", "name")


@query("SELECT count(*) AS n, true AS in_bounds FROM lineitem")
def export_chunks(spark, sf):
    """Rows exported in files of at most 1000 rows."""
    lines = table(spark, sf, "lineitem")
    done = export_csv(lines, new_folder(spark, "chunks"), "lines", WriteOptions(chunk_size=1000, compression="bz2"))
    sizes = read_folder(spark, done.path, "bz2").groupBy(FILE).agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n"), (F.max("n") <= 1000).alias("in_bounds"))


@query("SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in LINE_KEYS) + " FROM lineitem")
def export_chunk_rows(spark, sf):
    """The rows of all those files."""
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS)
    done = export_csv(lines, new_folder(spark, "chunks"), "lines", WriteOptions(chunk_size=1000, compression="bz2"))
    return read_folder(spark, done.path, "bz2").select(*LINE_KEYS)


@query("SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name AS name FROM customer")
def csv_skip_rows(spark, sf):
    """Three files of all customers that begin with two lines of remarks before the header."""
    folder = new_folder(spark, "skipped")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    for i in (0, 1, 2):
        part = customers.filter(F.col("c_custkey") % 3 == i)
        # one file, as its first lines are not like the others
        head = spark.createDataFrame([(-3, "report; of customers"), (-2, "made by hand"), (-1, "custkey;name")], "n bigint, value string")
        lines = head.unionByName(part.select(F.col("c_custkey").alias("n"), F.concat_ws(";", "c_custkey", "c_name").alias("value")))
        lines.repartition(1).sortWithinPartitions("n").select("value").write.option("compression", "gzip").text(f"{folder}/{i}")
    return read_folder(spark, folder, "gz", ReadOptions(skip_rows=2, include_subfolders=True)).select("custkey", "name")
