"""Token ids in length-delimited binary record files with a separate offset index.

A record is: length of the payload (8 bytes), masked CRC-32C of those bytes (4),
payload, masked CRC-32C of the payload (4), all little-endian; readers of such
record files can read them. The payload holds ids of 2 bytes where the vocabulary
allows it, else of 4. Each task writes one shard, under a name of its own that is
moved into place when whole, so a repeated task replaces its shard. The index, a
Parquet table, has a row per record, for reads in any order.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from tokenizers import pre_tokenizers

from millrace.llm.crc32c import crc32c_all, masked
from millrace.llm.staging import stage
from millrace.llm.words import content_key, encode_each, load_tokenizer, raw, row_groups
from millrace.workspace import new_path

#: Kept encodings of pieces and words per worker process; the store starts anew when full.
KEPT = 600_000

#: Characters beside white space of texts that are cut into pieces here: ASCII and the letters of Latin-1, a range
#: in which lower-casing goes by character and nothing is composed.
_PLAIN = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
ODD, PLAIN = re.compile(f"[^{_PLAIN} \t\n\x0b\x0c\r]"), re.compile(f"[{_PLAIN}]+")

#: The tokenizer's pattern (fixed values), and what it finds in such texts in lower case.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

#: Bytes of texts encoded, or of records read, together.
GROUP_BYTES = 2_000_000

HEAD, TAIL = 12, 4


class WordEncoder:
    """Ids of texts, piece by piece.

    For tokenizers that drop white space and whose pre-tokens never cross it. Where one
    lower-cases and cuts by ``PATTERN``, plain texts are cut into pieces here and each
    distinct piece is merged once, by the tokenizer's model alone; words with other
    characters, and texts with special strings, go through the whole library, and so do
    all words of other tokenizers.
    """

    def __init__(self, path: str, end_id: int):
        self.tokenizer = load_tokenizer(path)
        if [len(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in (" ", "\n \t")] != [0, 0]:
            raise ValueError("the tokenizer keeps white space; words cannot be encoded alone")
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.end = np.array([end_id], self.kind).tobytes()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        stated = json.loads(self.tokenizer.to_str())
        steps = {x["type"] for x in (stated["normalizer"] or {}).get("normalizers", [])}
        cuts = [x.get("pattern", {}).get("Regex") or x["type"] for x in (stated["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.cuts_here = steps == {"NFC", "Replace", "Lowercase"} and cuts == [PATTERN, "ByteLevel"]
        self.model, shown = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the model knows bytes by characters that stand for them
        self.shown = str.maketrans({c: shown.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xdf, 0x100))})
        self._forget()

    def _forget(self) -> None:
        # units are numbered as they come, so that one look-up finds both a unit's number and that it is new
        self.numbers: defaultdict[str | bytes, int] = defaultdict(itertools.count().__next__)
        self.ids: list[bytes] = []

    def _units(self, blob: bytes) -> list[str | bytes]:
        """Pieces to be merged by the model (text) and words for the library (bytes)."""
        text = blob.decode()
        if not self.cuts_here or self.special and self.special.search(text):
            return blob.split()
        if not ODD.search(text):
            return PIECES.findall(text.lower())
        return [u for w in blob.split() for u in self._pieces(w)]

    @staticmethod
    def _pieces(word: bytes) -> list[str | bytes]:
        text = word.decode()
        return PIECES.findall(text.lower()) if PLAIN.fullmatch(text) else [word]

    def _learn(self, units: list[str | bytes]) -> None:
        """Ids of the units with the next numbers."""
        words = [u.decode() for u in units if type(u) is bytes]
        whole, merge, shown, kind = encode_each(self.tokenizer, words), self.model.tokenize, self.shown, self.kind.char
        for unit in units:
            ids = next(whole) if type(unit) is bytes else [t.id for t in merge(unit.translate(shown))]
            self.ids.append(struct.pack(f"<{len(ids)}{kind}", *ids))

    def encode(self, blobs: list[bytes]) -> list[bytes]:
        if len(self.ids) > KEPT:
            self._forget()
        number = self.numbers.__getitem__
        cut = [list(map(number, self._units(b))) for b in blobs]
        self._learn(list(itertools.islice(self.numbers, len(self.ids), None)))
        get = self.ids.__getitem__
        return [b"".join([*map(get, units), self.end]) for units in cut]


#: The encoder of this worker process; it goes on from task to task.
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads = masked(crc32c_all(lengths)).astype("<u4")
    tails = masked(crc32c_all(payloads)).astype("<u4")
    return [b"".join((n, h.tobytes(), p, t.tobytes())) for n, h, p, t in zip(lengths, heads, payloads, tails)]


def unframed(buffers: list[bytes]) -> list[bytes]:
    """Payloads of whole records; a wrong length or checksum stops the read."""
    payloads = [b[HEAD:-TAIL] for b in buffers]
    found = [struct.unpack_from("<QI", b) + struct.unpack_from("<I", b, len(b) - TAIL) for b in buffers]
    heads, tails = masked(crc32c_all([b[:8] for b in buffers])).tolist(), masked(crc32c_all(payloads)).tolist()
    for payload, (length, head, tail), h, t in zip(payloads, found, heads, tails):
        if length != len(payload) or head != h or tail != t:
            raise ValueError("a record is damaged")
    return payloads


def shard_name(number: int) -> str:
    return f"shard-{number:06d}.records"


def _write(batches: Iterator[pa.RecordBatch], root: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _ENCODERS.get((path, end_id)) or _ENCODERS.setdefault((path, end_id), WordEncoder(path, end_id))
    files, folder = pa.fs.FileSystem.from_uri(root)
    number = TaskContext.get().partitionId()
    final = f"{folder}/{shard_name(number)}"
    hidden = f"{folder}/_{shard_name(number)}.{uuid.uuid4().hex}"
    offset = position = 0
    out = None
    try:
        for batch in batches:
            blobs = raw(batch.column(1))
            for start, stop in row_groups([len(b) for b in blobs], GROUP_BYTES):
                out = out or files.open_output_stream(hidden)
                written = frames(encoder.encode(blobs[start:stop]))
                out.write(b"".join(written))
                sizes = np.array([len(w) for w in written], np.int64)
                ends = offset + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(np.full(len(sizes), number, np.int32)),
                     pa.array(np.arange(position, position + len(sizes))), pa.array(ends - sizes), pa.array(sizes),
                     pa.array(np.full(len(sizes), encoder.kind.itemsize, np.int32))],
                    ["key", "shard", "position", "offset", "size", "width"])
                offset, position = int(ends[-1]), position + len(sizes)
    finally:
        if out:
            out.close()
    if out:
        files.move(hidden, final)


def write_records(docs: DataFrame, path: str, end_id: int, root: str | None = None, key: str = "doc_id",
                  text: str = "text", shards: int | None = None) -> tuple[DataFrame, str]:
    """Write the ids of every whole text in ascending order of ``key``; the staged index and the folder.

    Index: ``key``, ``shard``, ``position`` in the shard, ``offset`` and ``size`` in
    bytes, ``width`` of an id in bytes. Null and empty texts have the end id alone; rows without a key come
    first; rows equal in key go by content, and repeated rows stay and may lie in
    neighbouring shards; other columns are left out; an empty table gives an empty
    index. ``root`` is a folder that all executors reach, by default one in the
    shared folder.
    """
    spark = docs.sparkSession
    root = root or new_path(spark, "records")
    root = root if "://" in root else "file:" + os.path.abspath(root.removeprefix("file:"))
    root = root.replace("file:/", "file:///", 1) if root.startswith("file:/") and not root.startswith("file:///") else root
    files, folder = pa.fs.FileSystem.from_uri(root)
    files.create_dir(folder, recursive=True)
    kind = docs.schema[key].dataType.simpleString()
    # the row number splits rows that are equal in key and text, whose order does not matter
    order = ["key", "content", "row"]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), content_key(key, text).alias("content"),
                       F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange(shards, *order) if shards else rows.repartitionByRange(*order)
    index = dealt.sortWithinPartitions(*order).select("key", "text").mapInArrow(
        lambda batches: _write(batches, root, path, end_id), f"key {kind}, shard int, position bigint, offset bigint, size bigint, width int")
    return stage(index, "index")[0], root


def _payloads(batch: pa.RecordBatch, files, folder: str, opened: dict) -> Iterator[tuple[int, list[bytes]]]:
    shards, offsets, sizes = (batch.column(c).to_pylist() for c in ("shard", "offset", "size"))
    for start, stop in row_groups(sizes, GROUP_BYTES):
        buffers = []
        for shard, offset, size in zip(shards[start:stop], offsets[start:stop], sizes[start:stop]):
            if shard not in opened:
                for other in opened.values():
                    other.close()
                opened.clear()
                opened[shard] = files.open_input_file(f"{folder}/{shard_name(shard)}")
            buffers.append(opened[shard].read_at(size, offset))
        yield start, unframed(buffers)


def read_records(index: DataFrame, root: str) -> DataFrame:
    """(key, ids) of the records that ``index`` names, in any order and selection; checksums are verified."""
    kind = index.schema["key"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(root)
        opened: dict = {}
        for batch in batches:
            for start, payloads in _payloads(batch, files, folder, opened):
                widths = batch.column("width").slice(start, len(payloads)).to_pylist()
                ids = [np.frombuffer(p, f"<u{n}").astype(np.int32) for p, n in zip(payloads, widths)]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(start, len(ids)),
                                                  pa.array(ids, pa.list_(pa.int32()))], ["key", "ids"])
    return index.mapInArrow(read, f"key {kind}, ids array<int>")


def record_digests(index: DataFrame, root: str, key: str) -> DataFrame:
    """Key, ``start``, ``n_tokens`` and ``ids_crc32`` of every record, from the files.

    ``start`` counts the ids of all records before it: those of the same shard in the
    task that reads it, those of earlier shards from the shards' totals, of which
    there is one row per file.
    """
    kind = index.schema["key"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(root)
        opened: dict = {}
        current, before = None, 0
        for batch in batches:
            shards, widths = batch.column("shard").to_pylist(), batch.column("width").to_pylist()
            for first, payloads in _payloads(batch, files, folder, opened):
                rows = []
                for shard, width, payload in zip(shards[first:], widths[first:], payloads):
                    if shard != current:
                        current, before = shard, 0
                    ids = np.frombuffer(payload, f"<u{width}")
                    rows.append((before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(first, len(rows)), batch.column("shard").slice(first, len(rows)),
                     *(pa.array(c, pa.int64()) for c in zip(*rows))], ["key", "shard", "within", "n_tokens", "ids_crc32"])
    # a shard's records are read by one task, in their order
    dealt = index.repartitionByRange("shard").sortWithinPartitions("shard", "position")
    found, _ = stage(dealt.mapInArrow(read, f"key {kind}, shard int, within bigint, n_tokens bigint, ids_crc32 bigint"), "read")
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts, _ = stage(totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "starts")
    return found.join(starts, "shard").select(
        F.col("key").alias(key), (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def _query(spark, folder):
    from public_tokenizers import path

    from millrace.llm.catalog import table
    index, root = write_records(table(spark, folder, "documents"), path("word_bpe_49k.json"), end_id=2)
    return record_digests(index, root, "doc_id")


QUERIES = {"op5_token_records": (_query, None)}
