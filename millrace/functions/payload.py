"""Messages that carry JSON in a binary payload. Works the same on tables and on streams."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode_json(*columns: Column) -> Column:
    """A JSON object of the columns as binary."""
    return F.encode(F.to_json(F.struct(*columns)), "UTF-8")


def json_array_files(df: DataFrame, document: str, path: str, documents: int = 10_000) -> None:
    """Write files of one JSON array each, a document over several lines and ``documents`` of them at most in a file.

    Such a file can't be split and its rows are parsed at once, so files grow in number and not in size.
    """
    pretty = df.select(F.to_json(F.col(document), {"pretty": "true"}).alias("value"))

    def elements(batches):
        held, n = None, 0
        for batch in batches:
            found = []
            for text in batch["value"]:
                if held is not None:
                    found.append(held + ("\n]" if n % documents == 0 else ""))
                held, n = ("[\n" if n % documents == 0 else ",\n") + text, n + 1
            yield pd.DataFrame({"value": found}, dtype=object)
        yield pd.DataFrame({"value": ["[\n]" if held is None else held + "\n]"]})
    # a row is one element, so the writer begins a new file where an array has ended
    pretty.mapInPandas(elements, "value string").write.option("maxRecordsPerFile", documents).text(path)


def decode_json(df: DataFrame, schema: T.StructType | str, payload: str = "value",
                name: str = "msg") -> DataFrame:
    """Parse the payload. Fields outside the schema are dropped; malformed messages give NULL fields."""
    return df.withColumn(name, F.from_json(F.col(payload).cast("string"), schema))


def decode_items(df: DataFrame, schema: T.StructType | str, items: str, header: Sequence[str],
                 fields: Sequence[str], payload: str = "value", position: str = "pos", keep_empty: bool = False,
                 malformed: str | None = None) -> DataFrame:
    """One row per item of the array in each message, with header fields, position and item fields.

    With ``keep_empty`` a message without items gives one row without position and
    item. With ``malformed``, a column of that name holds the text of a message that
    could not be parsed, and such messages are kept in any case.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    parsed = df.withColumn("_msg", F.from_json(F.col(payload).cast("string"), kind.add("_broken", "string"),
                                               {"columnNameOfCorruptRecord": "_broken"}))
    names = [*header, *([malformed] if malformed else [])]
    decoded = parsed.select(*[F.col(f"_msg.{h}").alias(h) for h in header],
                            *([F.col("_msg._broken").alias(malformed)] if malformed else []),
                            F.posexplode_outer(F.col(f"_msg.{items}")).alias(position, "_item"))
    if not keep_empty:
        wanted = F.col(position).isNotNull()
        decoded = decoded.where(wanted | F.col(malformed).isNotNull() if malformed else wanted)
    return decoded.select(*names, position, *[F.col(f"_item.{f}").alias(f) for f in fields])
