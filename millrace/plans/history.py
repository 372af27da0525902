"""Merges, history and as-of reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators import upsert as U
from millrace.plans.registry import query
from millrace.sources import change_log
from millrace.workspace import new_path

_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def _base(t):
    """Orders that are not pending."""
    return t.orders.select(*_COLUMNS).where("o_orderstatus <> 'P'")


def _changes(t):
    """Large orders of any status, at half the price: new keys and known ones."""
    return (t.orders.select(*_COLUMNS).where("o_totalprice > 250000")
            .withColumn("o_totalprice", F.col("o_totalprice") * 0.5))


_BASE = "(SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P')"
_CHANGES = """(SELECT o_orderkey, o_orderstatus, o_totalprice * 0.5 AS o_totalprice FROM orders
               WHERE o_totalprice > 250000)"""


@query("merge_insert", "UP1", f"""
    SELECT * FROM {_BASE}
    UNION ALL SELECT * FROM {_CHANGES} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_BASE})""")
def merge_insert(t):
    once = U.merge_insert(_base(t), _changes(t), ["o_orderkey"])
    return U.merge_insert(once, _changes(t), ["o_orderkey"])


@query("merge_upsert", "UP2", f"""
    SELECT * FROM {_CHANGES}
    UNION ALL SELECT * FROM {_BASE} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_CHANGES})""")
def merge_upsert(t):
    return U.merge_upsert(_base(t), _changes(t), ["o_orderkey"])


@query("delete_where", "UP3", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE coalesce(NOT (nullif(o_orderstatus, 'P') = 'F'), true)""")
def delete_where(t):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return U.delete_where(t.orders.select("o_orderkey", "o_orderstatus"), status == "F")


@query("update_where", "UP4", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_totalprice > 400000 THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def update_where(t):
    return U.update_where(t.orders.select(*_COLUMNS), F.col("o_totalprice") > 400000,
                          {"o_totalprice": F.col("o_totalprice") / 2, "o_orderstatus": F.lit("X")})


_FIRST, _SECOND = datetime(2024, 1, 1), datetime(2024, 2, 1)


@query("scd2_apply", "UP5", f"""
    SELECT b.*, TIMESTAMP '2024-01-01' AS valid_from,
           CASE WHEN c.o_orderkey IS NULL THEN TIMESTAMP '2199-12-31' ELSE TIMESTAMP '2024-02-01' END AS valid_to
    FROM {_BASE} b LEFT JOIN {_CHANGES} c ON b.o_orderkey = c.o_orderkey
    UNION ALL
    SELECT *, TIMESTAMP '2024-02-01', TIMESTAMP '2199-12-31' FROM {_CHANGES}""")
def scd2_apply(t):
    history = U.open_history(_base(t), _FIRST)
    return U.scd2_apply(history, _changes(t), ["o_orderkey"], _SECOND)


@query("scd2_apply_compared", "UP5", f"""
    SELECT b.*, TIMESTAMP '2024-01-01' AS valid_from, TIMESTAMP '2199-12-31' AS valid_to FROM {_BASE} b
    UNION ALL
    SELECT *, TIMESTAMP '2024-02-01', TIMESTAMP '2199-12-31' FROM {_CHANGES}
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_BASE})""")
def scd2_apply_compared(t):
    history = U.open_history(_base(t), _FIRST)
    # only the status is compared, and it is the same for every key that exists
    return U.scd2_apply(history, _changes(t), ["o_orderkey"], _SECOND, compare=["o_orderstatus"])


def _write_log(t, snapshots=()):
    """Three versions of the orders: all inserted, open ones updated, final urgent ones deleted."""
    path = new_path(t.spark, "order-log")

    def done(version):
        if version in snapshots:
            change_log.write_snapshot(t.spark, path, ["o_orderkey"], version)
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    change_log.append_version(orders, path, 1, "insert", datetime(2024, 1, 1), ["o_orderkey"])
    done(1)
    change_log.append_version(orders.where("o_orderstatus = 'O'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 0.5), path, 2, "update", datetime(2024, 1, 2), ["o_orderkey"])
    done(2)
    change_log.append_version(orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"),
                              path, 3, U.DELETE, datetime(2024, 1, 3), ["o_orderkey"])
    return path


def _log(t):
    return change_log.read_log(t.spark, _write_log(t))


_AS_OF = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 0.5 ELSE o_totalprice END
                AS o_totalprice FROM orders"""


@query("as_of_version", "UP6 SRC20 SNK16 D8", _AS_OF
       + " WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def as_of_version(t):
    return U.as_of(_log(t), ["o_orderkey"], version=3).select("o_orderkey", "o_totalprice")


@query("as_of_timestamp", "UP6", _AS_OF)
def as_of_timestamp(t):
    return U.as_of(_log(t), ["o_orderkey"], timestamp=datetime(2024, 1, 2, 12)).select(
        "o_orderkey", "o_totalprice")


@query("as_of_snapshot", "UP6 SRC20 SNK16", _AS_OF
       + " WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def as_of_snapshot(t):
    found = change_log.read_as_of(t.spark, _write_log(t, snapshots=(1, 2)), ["o_orderkey"], version=3)
    return found.select("o_orderkey", "o_totalprice")


@query("as_of_snapshot_time", "UP6 SRC20", _AS_OF)
def as_of_snapshot_time(t):
    # between the second and the third version; the snapshot of the third must not serve it
    found = change_log.read_as_of(t.spark, _write_log(t, snapshots=(1,)), ["o_orderkey"], timestamp=datetime(2024, 1, 2, 12))
    return found.select("o_orderkey", "o_totalprice")


@query("change_history", "UP7", """
    SELECT 3 AS _version, 'delete' AS _op, count(*) AS rows, TIMESTAMP '2024-01-03' AS first_ts,
           TIMESTAMP '2024-01-03' AS last_ts
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT 2, 'update', count(*), TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-02' FROM orders
    WHERE o_orderstatus = 'O'""")
def change_history(t):
    return U.change_history(_log(t), last=2)


@query("output_sizes", "UP7", """
    SELECT rows, count(*) AS versions FROM (
        SELECT count(*) AS rows FROM orders UNION ALL
        SELECT count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL
        SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') GROUP BY rows""")
def output_sizes(t):
    return U.output_sizes(_log(t))
