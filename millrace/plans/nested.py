"""Text, arrays, nested data, messages and Python functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import nested as N
from millrace.functions import payload as Y
from millrace.functions import text as X
from millrace.functions import udfs as U
from millrace.operators.aggregate import collect_joined
from millrace.plans.registry import query
from millrace.sources.readers import named_view

_WORDS = "list_filter(regexp_split_to_array(text, '[ \n]'), lambda w: w <> '')"


@query("split_words", "STR1", """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, len(string_split(p_name, ' '))::INT AS words
    FROM part""")
def split_words(t):
    parts = X.split_plain("p_name")
    return t.part.select("p_partkey", X.element(parts, 0).alias("first_word"), F.size(parts).alias("words"))


#: Pages without a number in that place show as -1.
_IDS = """SELECT page_id, CASE WHEN regexp_full_match(split_part(url, '/', 5), '[0-9]+')
                               THEN coalesce(TRY_CAST(split_part(url, '/', 5) AS INTEGER), -1) ELSE -1 END AS url_id
          FROM (SELECT page_id, CASE page_id % 5 WHEN 1 THEN replace(url, 'en/', 'en/-') WHEN 2 THEN replace(url, 'en/', 'en/+')
                                     WHEN 3 THEN replace(url, 'en/', 'en/ ') ELSE url END AS url FROM pages)"""


def _odd_pages(t):
    """The pages with signs and blanks before some of the numbers."""
    rest = F.pmod("page_id", F.lit(5))
    sign = F.when(rest == 1, "en/-").when(rest == 2, "en/+").when(rest == 3, "en/ ").otherwise("en/")
    return t.pages.select("page_id", F.replace("url", F.lit("en/"), sign).alias("url"))


def _known_id(column):
    return F.coalesce(column, F.lit(-1)).alias("url_id")


@query("extract_id", "STR2", _IDS)
def extract_id(t):
    return _odd_pages(t).select("page_id", _known_id(X.extract_id("url")))


@query("udf_extract_id", "UDF1", _IDS)
def udf_extract_id(t):
    return _odd_pages(t).select("page_id", _known_id(U.id_udf()("url")))


@query("udf_sql", "UDF2", _IDS)
def udf_sql(t):
    function = U.register_for_sql(t.spark)
    return t.spark.sql(f"SELECT page_id, coalesce({function}(url), -1) AS url_id FROM {named_view(_odd_pages(t))}")


@query("pandas_udf_extract_id", "UDF3 UDF5", _IDS)
def pandas_udf_extract_id(t):
    return _odd_pages(t).select("page_id", _known_id(U.id_pandas_udf()("url")))


@query("pandas_udf_double", "UDF4", "SELECT p_partkey, p_retailprice * 2 AS twice FROM part")
def pandas_udf_double(t):
    return t.part.select("p_partkey", U.twice_pandas_udf()("p_retailprice").alias("twice"))


@query("minute_key", "STR4", "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS minute FROM events")
def minute_key(t):
    return t.events.select("event_id", X.time_key("ts").alias("minute"))


@query("array_element", "ARR1 ARR2", """
    SELECT p_partkey, string_split(p_name, ' ')[2] AS second,
           coalesce(string_split(p_name, ' ')[9], 'none') AS ninth,
           string_split(p_name, ' ')[-1] AS last
    FROM part""")
def array_element(t):
    parts = X.split_plain("p_name")
    ninth = F.coalesce(X.element(parts, 8), F.lit("none"))
    return t.part.select("p_partkey", X.element(parts, 1).alias("second"), ninth.alias("ninth"),
                         X.element(parts, -1).alias("last"))


@query("array_contains", "ARR3", """
    SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has_ring FROM part""")
def array_contains(t):
    return t.part.select("p_partkey", F.array_contains(X.split_plain("p_name"), "ring").alias("has_ring"))


@query("array_sorted", "ARR4", """
    SELECT doc_id, array_to_string(list_sort(string_split(text, ' ')), '|') AS sorted FROM documents""")
def array_sorted(t):
    return t.documents.select("doc_id", F.array_join(F.sort_array(X.split_plain("text")), "|").alias("sorted"))


@query("explode_words", "ARR5 ARR6", f"SELECT doc_id, lang, unnest({_WORDS}) AS word FROM documents")
def explode_words(t):
    return X.explode_words(t.documents, ["doc_id", "lang"], "text")


@query("explode_positions", "ARR7", f"""
    SELECT doc_id, unnest(range(len({_WORDS})))::INT AS pos, unnest({_WORDS}) AS word FROM documents""")
def explode_positions(t):
    return X.explode_words(t.documents, ["doc_id"], "text", position="pos")


@query("word_count", "ARR8", f"""
    SELECT word, count(*) AS count FROM (SELECT unnest({_WORDS}) AS word FROM documents) GROUP BY word""")
def word_count(t):
    return X.word_frequencies(t.documents, "text")


@query("collect_words", "AGG14", f"""
    SELECT doc_id, array_to_string(list_sort(list_distinct({_WORDS})), '|') AS words FROM documents""")
def collect_words(t):
    # grouped by parent row, so that a group is bounded by one text even where keys repeat
    exploded = X.explode_words(t.documents, ["doc_id"], "text", parent="parent", keep_empty=True)
    return collect_joined(exploded, ["doc_id", "parent"], "word", "words").drop("parent")


@query("renest_words", "ARR9 AGG14", f"""
    SELECT doc_id, array_to_string({_WORDS}, ' ') AS joined FROM documents""")
def renest_words(t):
    exploded = X.explode_words(t.documents, ["doc_id"], "text", position="pos", parent="parent", keep_empty=True)
    return X.renest_words(exploded, ["doc_id", "parent"], "word", "pos", "joined").drop("parent")


def _order_tree(t):
    """Orders as a struct with a nested struct and an array of structs, all from the row itself."""
    amounts = F.array(*[F.struct(F.lit(kind).alias("kind"), F.struct((F.col("o_totalprice") * rate).alias("value"))
                                 .alias("money"))
                        for kind, rate in (("net", 1.0), ("half", 0.5))])
    return t.orders.select("o_orderkey", F.struct(amounts.alias("amounts"), "o_orderpriority").alias("doc"))


@query("nested_path", "NST1", """
    SELECT o_orderkey, 'net' AS kind, o_totalprice * 0.5 AS half, true AS past_the_end FROM orders""")
def nested_path(t):
    return _order_tree(t).select(
        "o_orderkey", N.at_path("doc", "amounts", 0, "kind").alias("kind"),
        N.at_path("doc", "amounts", 1, "money", "value").alias("half"),
        N.at_path("doc", "amounts", 2, "money", "value").isNull().alias("past_the_end"))


@query("array_field", "NST2", """
    SELECT o_orderkey, 0 AS pos, 'net' AS kind FROM orders
    UNION ALL SELECT o_orderkey, 1 AS pos, 'half' AS kind FROM orders""")
def array_field(t):
    kinds = N.field_of_each("doc", "amounts", "kind")
    return _order_tree(t).select("o_orderkey", F.posexplode(kinds).alias("pos", "kind"))


@query("map_access", "NST3", """
    SELECT o_orderkey, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS day, true AS is_absent
    FROM orders""")
def map_access(t):
    entries = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("day"),
                           F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", entries.alias("m")).select(
        "o_orderkey", F.col("m")["status"].alias("status"), F.col("m.day").alias("day"),
        N.map_value("m", "none").isNull().alias("is_absent"))


@query("nest_flatten", "NST4 NST5", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""")
def nest_flatten(t):
    nested = N.nest(t.customer, "person", {"c_custkey": "c_custkey", "c_name": "c_name",
                                           "money": ["c_nationkey", "c_acctbal"]})
    return N.flatten(nested, "person", "person.money").drop("money")


@query("decode_json", "J1", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, true AS lacks_other FROM events""")
def decode_json(t):
    messages = t.events.select("event_id", F.encode("props", "UTF-8").alias("value"))
    return Y.decode_json(messages, "k int, other string").select(
        "event_id", "msg.k", F.col("msg.other").isNull().alias("lacks_other"))


#: Schema of the messages built from line items.
LINE_MESSAGE = "items array<struct<item_id bigint, volume double>>, sent_at timestamp_ntz, sender string"


def line_messages(t):
    """One message per line item with two items, as a message broker would deliver it."""
    def item(key, volume):
        return F.struct(F.col(key).alias("item_id"), F.col(volume).alias("volume"))
    return t.lineitem.select(Y.encode_json(
        F.array(item("l_partkey", "l_quantity"), item("l_suppkey", "l_tax")).alias("items"),
        F.col("l_shipdate").alias("sent_at"), F.col("l_orderkey").cast("string").alias("sender")).alias("value"))


def decoded_lines(messages):
    return Y.decode_items(messages, LINE_MESSAGE, "items", ["sender", "sent_at"], ["item_id", "volume"])


DECODED_LINES = """
    SELECT CAST(l_orderkey AS VARCHAR) AS sender, l_shipdate AS sent_at, 0 AS pos, l_partkey AS item_id,
           l_quantity AS volume FROM lineitem
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR) AS sender, l_shipdate AS sent_at, 1 AS pos, l_suppkey AS item_id,
           l_tax AS volume FROM lineitem"""


@query("decode_and_explode", "J2", DECODED_LINES)
def decode_and_explode(t):
    return decoded_lines(line_messages(t))
