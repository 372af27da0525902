"""Round trips through sources and sinks, and layout jobs."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from millrace.functions.nested import at_path
from millrace.functions.payload import json_array_files
from millrace.operators import layout as L
from millrace.operators.ordering import union_all
from millrace.plans.registry import query
from millrace.sources import file_table
from millrace.sources import readers as R
from millrace.sources import writers as S
from millrace.workspace import new_name, new_path

#: Rows that one task of a partitioned write is given, about; it sorts them in its memory.
_ROWS_A_TASK = 250_000


@query("scan_csv_schema", "SRC8 SRC9 SRC10 SNK8", "SELECT * FROM customer")
def scan_csv_schema(t):
    customer = t.customer
    path = new_path(t.spark, "customer-csv")
    S.write_csv(customer, path, sep="\t", quote="'")
    return R.csv(t.spark, path, schema=customer.schema, header=True, sep="\t", quote="'")


@query("sql_on_file", "SRC11 SRC13", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def sql_on_file(t):
    return R.sql_on_file(t.spark, "parquet", t.path("orders"), ["o_orderkey", "o_totalprice"],
                         "o_totalprice > 300000")


@query("scan_partitioned", "SRC13 SNK1 SNK2", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def scan_partitioned(t):
    path = new_path(t.spark, "orders-by-status")
    S.write_parquet(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path, mode="overwrite",
                    partition_by=["o_orderstatus"])
    return R.parquet(t.spark, path).where("o_orderstatus = 'F'")


@query("append_dedup", "SNK3 UP8", """
    SELECT (SELECT 4 * count(*) FROM orders) AS appended, (SELECT count(*) FROM (SELECT DISTINCT * FROM orders))
        AS remaining""")
def append_dedup(t):
    path = new_path(t.spark, "orders-appended")
    S.write_parquet(t.orders, path)
    for _ in range(2):
        # the table is appended to itself: the files to read are known before the new ones are written
        S.write_parquet(R.parquet(t.spark, path), path, mode="append")
    stored = R.parquet(t.spark, path)
    unique = stored.dropDuplicates().agg(F.count(F.lit(1)).alias("n"))
    return stored.agg(F.count(F.lit(1)).alias("appended")).withColumn("remaining", unique.scalar())


@query("partition_replace", "SNK5 SNK7", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END
        AS o_totalprice FROM orders""")
def partition_replace(t):
    path = new_path(t.spark, "orders-replaced")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    S.replace_partitions(orders, path, ["o_orderstatus"], dynamic=False)
    final = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    S.replace_partitions(final, path, ["o_orderstatus"])
    return R.parquet(t.spark, path)


@query("partition_replace_static", "SNK5 SNK6", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def partition_replace_static(t):
    path = new_path(t.spark, "orders-static")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    S.replace_partitions(orders, path, ["o_orderstatus"], dynamic=False)
    S.replace_partitions(orders.where("o_orderstatus = 'F'"), path, ["o_orderstatus"], dynamic=False)
    S.replace_one_partition(orders, path, "o_orderstatus", "O")
    return R.parquet(t.spark, path)


@query("compact", "SNK4 SNK14", "SELECT * FROM orders")
def compact(t):
    path = new_path(t.spark, "orders-small-files")
    t.orders.repartition(24).write.parquet(path)
    return L.compact(t.spark, path, new_path(t.spark, "orders-compacted"))


@query("zorder", "SNK15", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def zorder(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    path = new_path(t.spark, "lines-clustered")
    L.zorder(lines, ["l_partkey", "l_suppkey"]).write.parquet(path)
    return R.parquet(t.spark, path)


@query("zorder_range", "SNK15", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
    WHERE l_partkey BETWEEN 100 AND 400 AND l_suppkey BETWEEN 10 AND 30""")
def zorder_range(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    path, index = new_path(t.spark, "lines-clustered"), new_path(t.spark, "lines-index")
    L.zorder(lines, ["l_partkey", "l_suppkey"], partitions=16).write.parquet(path)
    L.write_file_index(t.spark, path, ["l_partkey", "l_suppkey"], index)
    return L.scan_range(t.spark, path, index, {"l_partkey": (100, 400), "l_suppkey": (10, 30)})


@query("compact_incremental", "SNK14 SNK4 SNK3", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def compact_incremental(t):
    table = new_path(t.spark, "orders-files")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    large = F.col("o_totalprice") > 100000
    # as many tasks as the rows need, so that none sorts more for its partitions when the table, or a row group of it, grows
    tasks = max(L.partition_count(orders), ceil(orders.count() / _ROWS_A_TASK), 1)
    file_table.append(orders.where(large).repartition(tasks, "o_orderkey"), table, ["o_orderstatus"])
    file_table.append(orders.where(~large | large.isNull()).repartition(max(6, tasks), "o_orderkey"), table)
    # small files are merged per partition, the large ones stay
    file_table.compact(t.spark, table, target_bytes=1 << 20, small=0.1)
    return file_table.read(t.spark, table)


@query("saved_table", "SRC14 SNK9", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def saved_table(t):
    name = new_name("suppliers")
    S.save_table(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), name,
                 path=new_path(t.spark, "suppliers"), partition_by=["s_nationkey"])
    return t.spark.table(name)


@query("json_round_trip", "SRC12", "SELECT * FROM events")
def json_round_trip(t):
    events = t.events
    path = new_path(t.spark, "events-json")
    # the default format stops at milliseconds
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    events.write.options(**micros).json(path)
    return R.json(t.spark, path, schema=events.schema, **micros)


@query("partition_report", "LAY8 D10", """
    SELECT count(*) AS rows, 8 AS partitions, true AS within_bounds, true AS even FROM lineitem""")
def partition_report(t):
    summary = L.partition_summary(t.lineitem.repartition(8))
    mean = F.col("rows") / F.col("partitions")
    return summary.select("rows", F.col("partitions").cast("int").alias("partitions"),
                          ((F.col("least") <= mean) & (mean <= F.col("most"))).alias("within_bounds"),
                          (F.col("most") <= 2 * mean).alias("even"))


@query("scan_csv_plain", "SRC6", """
    SELECT CAST(n_nationkey AS VARCHAR) AS _c0, n_name AS _c1, CAST(n_regionkey AS VARCHAR) AS _c2 FROM nation""")
def scan_csv_plain(t):
    path = new_path(t.spark, "nations-csv")
    S.write_csv(t.nation, path, header=False)
    return R.csv(t.spark, path)


@query("scan_csv_inferred", "SRC7", """
    SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def scan_csv_inferred(t):
    path = new_path(t.spark, "suppliers-csv")
    S.write_csv(t.supplier, path)
    return R.csv(t.spark, path, header=True, infer=True)


@query("scan_csv_dialect", "SRC9", "SELECT doc_id, text, lang FROM documents")
def scan_csv_dialect(t):
    # separator, quotes, escapes and line ends inside the texts have to survive
    documents = t.documents.select("doc_id", "text", "lang")
    path = new_path(t.spark, "documents-csv")
    dialect = {"sep": ";", "quote": "'", "escape": "\\", "encoding": "UTF-8", "emptyValue": "''",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    S.write_csv(documents, path, **dialect)
    return R.csv(t.spark, path, schema=documents.schema, header=True, multiLine=True, **dialect)


@query("scan_json_documents", "SRC12 NST1 NST2", """
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
           row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::INT - 1 AS pos,
           l_partkey AS part FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def scan_json_documents(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("lines"))
    head = F.struct("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("state")).alias("head")
    documents = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.struct(head, "lines").alias("document"))
    path = new_path(t.spark, "order-documents")
    json_array_files(documents, "document", path)
    scanned = R.json(t.spark, path, multi_line=True)
    return scanned.select(
        F.col("head.o_orderkey").alias("o_orderkey"), at_path("head", "state", "o_orderstatus").alias("status"),
        at_path("head", "state", "o_orderpriority").alias("priority"),
        F.posexplode(F.col("lines.l_partkey")).alias("pos", "part"))


@query("union_of_files", "SRC10 SRC13", """
    SELECT n_nationkey AS id, n_name AS name FROM nation
    UNION ALL SELECT r_regionkey, r_name FROM region""")
def union_of_files(t):
    scan = R.reader(t.spark, "parquet")
    nations = scan.load(t.path("nation")).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    regions = scan.load(t.path("region")).select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return union_all(nations, regions)
