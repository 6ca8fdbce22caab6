"""Operator 1: token ids in fixed-width bits, with block offsets.

Every id takes the bits that the vocabulary needs and no more. Eight ids fill a
whole number of bytes, so packing and unpacking are eight numpy lanes over byte
columns, whatever the width.

File format: Parquet written by Spark, so that task commits survive lost
executors and any store works. A row is one block: whole documents of about
``block_ids`` ids. ``shard`` and ``block`` number it, ``first`` is the place of
its first id in the shard, ``payload`` holds the packed ids, ``docs`` has for
each document its id and where its ids start and how many there are. A shard
is a range of doc_id, so ids lie in ascending doc_id order; a block is decoded
alone, and a document is found through its block's offsets.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks, hash_spans, text_bytes

BLOCK_IDS = 1 << 16
BLOCK_TYPE = "shard long, block long, first long, n_ids long, width int, payload binary, docs array<struct<doc_id:bigint,start:bigint,n_tokens:bigint>>"


def bit_width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, least significant bit first; the last group of eight is padded with zeros."""
    ids = np.asarray(ids, np.uint64)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    lanes = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(lanes), width + 5), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = lanes[:, j] << np.uint64(shift)
        for k in range((shift + width + 7) // 8):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return np.ascontiguousarray(out[:, :width]).tobytes()


def unpack(payload: bytes, width: int, n: int, first: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of a payload; only the bytes of these are read."""
    group = first // 8
    last = -(-(first + n) // 8)
    rows = np.frombuffer(payload, np.uint8)[group * width : last * width].reshape(-1, width)
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = np.zeros(len(rows), np.uint64)
        for k in range((shift + width + 7) // 8):
            value |= rows[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[first - 8 * group : first - 8 * group + n]


class CachedBpe:
    """Encodes whole texts with the tokenizers library, and each distinct cut once.

    The byte-level pre-tokenizer always starts a new piece at a space before a
    solid character, and what it finds on either side does not depend on the
    other. So texts are cut at these spaces, unknown cuts are encoded by the
    library, and the ids of a text are those of its cuts in order: the same ids
    as for the whole text. Known cuts are found by 64-bit hash; there are at
    most ``most`` of them, then the cache starts anew.
    """

    def __init__(self, path: str, end_id: int, most: int = 3_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.end_id = Tokenizer.from_file(path), most, end_id
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [x.content for x in added.values()]
        # An added token between two cuts separates them, whatever they are.
        self.mark = next(iter(added.items()), None)
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        if self.mark is not None and not any(x in y for y in texts for x in self.added):
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark[1].content.join(texts)], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) == len(texts) - 1:
                sizes = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                return np.delete(ids, marks), sizes
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        flat, sizes = self._encode(texts)
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(flat), np.uint32)])
        self.flat[self.used : self.used + len(flat)] = flat
        number = len(self.starts) + np.arange(len(keys))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used += len(flat)
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at = np.insert(self.keys, place, keys), np.insert(self.at, place, number)

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a block, its end id last."""
        data, offsets = text_bytes(column)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (data[:-1] == 32) & _SOLID[data[1:]] if len(data) else False
        cut[offsets] = False
        cut[:-1] = cut[1:]  # a cut is at the space, unless that ends its text
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut[: len(data)])
        ends = np.append(starts[1:], len(data))[: len(starts)]
        keys, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(keys[new], [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            place = np.searchsorted(self.keys, keys)
        number = self.at[place][which]
        sizes = self.sizes[number]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.starts[number] - stops[:-1], sizes) + np.arange(stops[-1])]
        cut = stops[np.searchsorted(starts, offsets)]
        end = np.array([self.end_id], np.uint32)
        return [np.concatenate([flat[a:b], end]) for a, b in zip(cut[:-1], cut[1:])]


#: Bytes that surely start a character which is no white space; others only make a cut longer.
_SOLID = np.ones(256, bool)
_SOLID[[*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False

_encoders: dict[tuple[str, int], CachedBpe] = {}


def worker_encoder(path: str, end_id: int) -> CachedBpe:
    """The encoder that all tasks of this Python worker share."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = CachedBpe(path, end_id)
    return _encoders[path, end_id]


def bpe_encoder(path: str, end_id: int = 0) -> tuple[Callable[[], Callable[[pa.Array], list[np.ndarray]]], int]:
    """A maker of an encoder for a byte-level BPE file of the tokenizers library, and the vocabulary size.

    The maker runs in the task, so that the tokenizer is read there; tasks of
    one Python worker share it. Texts are encoded whole and without special
    tokens; ``end_id`` ends each document.
    """
    from tokenizers import Tokenizer

    def make():
        return worker_encoder(path, end_id)

    return make, Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def write_ids(docs: DataFrame, path: str, make_encoder: Callable, vocabulary: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the blocks to ``path``.

    Documents are range-partitioned by doc_id and sorted by doc_id, then text;
    equal rows follow each other. Null text is empty and has the end id alone;
    a null doc_id sorts first. Other columns are left out. An empty table
    writes no block.
    """
    width = bit_width(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = make_encoder()
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        kept: list[np.ndarray] = []
        entries: list[dict] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = {"shard": shard, "block": block, "first": first, "n_ids": size, "width": width}
            row |= {"payload": pack(np.concatenate(kept), width), "docs": entries}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for a, b in blocks(batch.column("text")):
                names = batch.column("doc_id").slice(a, b - a).to_pylist()
                for name, ids in zip(names, encoder(batch.column("text").slice(a, b - a)), strict=True):
                    entries.append({"doc_id": name, "start": size, "n_tokens": len(ids)})
                    kept.append(ids)
                    size += len(ids)
                    if size >= block_ids:
                        yield close()
                        block, first, size, kept, entries = block + 1, first + size, 0, [], []
        if entries:
            yield close()

    arrow = pa.schema([
        ("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))),
    ])
    stages.small_batches(docs.sparkSession)
    ordered = stages.texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # Packed ids have no redundancy that a general compressor could find fast.
    ordered.mapInArrow(encode, BLOCK_TYPE).write.option("compression", "uncompressed").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_TYPE).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each shard. One row a shard; the window sees these rows alone."""
    from pyspark.sql import Window

    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def describe_ids(blocks: DataFrame) -> DataFrame:
    """Read documents back from their blocks: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the
    crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], row["n_ids"]).astype("<u4")
                out = [
                    (row["shard"], d["doc_id"], row["first"] + d["start"], d["n_tokens"], zlib.crc32(ids[d["start"] : d["start"] + d["n_tokens"]].tobytes()))
                    for d in row["docs"]
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    stages.small_batches(blocks.sparkSession)
    found = blocks.mapInArrow(decode, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(shard_starts(blocks), "shard").select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_document(blocks: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents of one doc_id, by random access into their blocks."""
    hit = blocks.where(F.exists("docs", lambda d: d["doc_id"] == doc_id))
    return [
        unpack(r.payload, r.width, d.n_tokens, d.start)
        for r in hit.orderBy("shard", "block").collect()
        for d in r.docs
        if d.doc_id == doc_id
    ]


def token_ids(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the ids of all documents to a new folder and describe them from the files."""
    import public_tokenizers

    spark = docs.sparkSession
    make, vocabulary = bpe_encoder(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), end_id)
    path = stages.new_path(spark, "token-ids")
    write_ids(docs, path, make, vocabulary)
    return describe_ids(read_blocks(spark, path))
