"""Operator 8: benchmark items inside documents by size-partitioned MinHash containment.

Items are partitioned by the number of their shingles, a class for each power
of two. For a class, a document is read through windows of twice the class's
largest size that overlap by half, so an item lies whole in some window, and a
window's similarity with it is bounded from below however long the document is.
Sets are sketched by one-permutation MinHash: a hash's low bits name a bin, and
a bin keeps its least hash. There are four bins for each shingle of the class's
largest size, so a shared shingle is its bin's minimum in both sets more often
than not; an item of 16 shingles, three quarters of them in the window, shares
no minimum with probability below 1e-7. Items of fewer shingles take windows of
one shingle, where every shingle is a minimum and nothing is missed.

Every pair that shares a minimum is checked exactly: the share of the item's
shingles that the whole document has.

The benchmark is the query set. Items of equal text are searched once and joined
to their ids afterwards. Texts go to the tasks in blocks of about ``ITEMS`` texts
and ``ITEM_BYTES`` bytes; the driver holds one block at a time, as a block's
findings are written before the next one is read. Documents are never moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks, distinct, shingle_sets, shingles, text_bytes, word_hashes

PERCENT = 75
#: Different items of one block, and the bytes of their texts, that go to a task at once.
ITEMS = 20_000
ITEM_BYTES = 32 << 20
#: Items of fewer shingles are looked up shingle by shingle.
SMALL = 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def size_class(n: int) -> int:
    """The largest size of the class of a set of ``n`` shingles; 1 for small sets."""
    return 1 if n < SMALL else 1 << int(n).bit_length()


def minima(elements: np.ndarray, window: np.ndarray, windows: int, bins: int) -> np.ndarray:
    """Least hash in every bin of every window; bins without a hash hold the largest number."""
    out = np.full(windows * bins, _NONE, np.uint64)
    np.minimum.at(out, window * bins + (elements & np.uint64(bins - 1)).astype(np.int64), elements)
    return out.reshape(windows, bins)


class ItemIndex:
    """Signatures of a block of items, by class: minimum to item."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.classes = {}
        by_class: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if len(s):
                by_class.setdefault(size_class(len(s)), []).append(i)
        for largest, members in by_class.items():
            keys = [self._signature(sets[i], largest) for i in members]
            key, item = np.concatenate(keys), np.repeat(members, [len(k) for k in keys])
            order = np.argsort(key, kind="stable")
            key, item = key[order], item[order]
            known = np.zeros(1 << 20, bool)
            known[key >> np.uint64(44)] = True
            self.classes[largest] = key, item, known

    @staticmethod
    def _signature(elements: np.ndarray, largest: int) -> np.ndarray:
        if largest == 1:
            return elements
        found = minima(elements, np.zeros(len(elements), np.int64), 1, 4 * largest)[0]
        return found[found != _NONE]

    def candidates(self, elements: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) that share a minimum; row r has the shingles ``begin[r]`` to ``begin[r + 1]`` in order."""
        out: set[tuple[int, int]] = set()
        if not len(elements):
            return out
        counts = np.diff(begin)
        row = np.repeat(np.arange(len(counts)), counts)
        for largest, (key, item, known) in self.classes.items():
            if largest == 1:
                found, owner = elements, row
            else:
                # Half windows are sketched once; a window is two of them.
                halves = -(-counts // largest)
                first = np.cumsum(halves) - halves
                half = first[row] + (np.arange(len(elements)) - begin[row]) // largest
                low = minima(elements, half, int(halves.sum()), 4 * largest)
                of = np.repeat(np.arange(len(counts)), halves)
                joined = low.copy()
                same = of[1:] == of[:-1]
                joined[:-1][same] = np.minimum(low[:-1][same], low[1:][same])
                found, owner = joined.ravel(), np.repeat(of, low.shape[1])
            hit = known[found >> np.uint64(44)] & (found != _NONE)
            found, owner = found[hit], owner[hit]
            a, b = np.searchsorted(key, found, "left"), np.searchsorted(key, found, "right")
            for r, i, j in zip(owner[a < b].tolist(), a[a < b].tolist(), b[a < b].tolist()):
                out.update((r, x) for x in item[i:j].tolist())
        return out


def _search(index: ItemIndex, digests: list[str], percent: int):
    names = ["doc_id", "text_hash", "item", "n_shared", "n_item"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column("text")):
                data, offsets = text_bytes(batch.column("text").slice(a, b - a))
                found, per_row = shingles(*word_hashes(data, offsets))
                begin = np.concatenate([[0], np.cumsum(per_row)])
                doc, digest, item, shared = [], [], [], []
                sets: dict[int, np.ndarray] = {}
                for r, i in sorted(index.candidates(found, begin)):
                    if r not in sets:
                        sets = {r: distinct(found[begin[r] : begin[r + 1]])}
                    both = len(np.intersect1d(sets[r], index.sets[i], assume_unique=True))
                    if 100 * both >= percent * len(index.sets[i]):
                        doc.append(batch.column("doc_id")[a + r].as_py())
                        digest.append(batch.column("text_hash")[a + r].as_py())
                        item.append(i)
                        shared.append(both)
                if doc:
                    sizes = [len(index.sets[i]) for i in item]
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                    columns = [pa.array(x, k) for x, k in zip((doc, digest, [digests[i] for i in item], shared, sizes), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, item_id, n_shared, n_item: every document and item with 100 * shared >= percent * item's shingles.

    Shingles are distinct windows of five words ``[^\\x20\\x09-\\x0D]+``, A-Z in
    lower case; a text of fewer words is one shingle of all its words, and a text
    without words has none: it neither leaks nor is leaked into. Repeated rows of
    either table give repeated rows. ``text_hash`` tells rows of one doc_id
    apart. Other columns are left out.
    """
    spark = docs.sparkSession
    stages.small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Items of equal text are one: their copies can't fill a block.
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).withColumn("item", F.sha2("text", 256))
    items = stages.stage(items, "items")
    different = items.groupBy("item").agg(F.first("text").alias("text"))
    n, size = different.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(-(-n // ITEMS), -(-int(size) // ITEM_BYTES), 1)
    rows = stages.texts(docs).withColumn("text_hash", F.xxhash64("text"))
    out = None
    for part in range(parts):
        block = different.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
        sets = list(shingle_sets(pa.array([r.text for r in block], pa.string()))) if block else []
        search = _search(ItemIndex(sets), [r.item for r in block], percent)
        found = rows.mapInArrow(search, "doc_id long, text_hash long, item string, n_shared long, n_item long")
        if parts > 1:
            found = stages.stage(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out.join(items.select("item", "item_id"), "item").select("doc_id", "text_hash", "item_id", "n_shared", "n_item")


def clean_documents(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    l_id, l_hash, l_text = stages.free_names(docs, "l_id", "l_hash", "l_text")
    found = leaks(docs, benchmark, percent).select(F.col("doc_id").alias(l_id), F.col("text_hash").alias(l_hash)).distinct()
    keyed = docs.withColumn(l_text, F.xxhash64(F.col("text").cast("string")))
    return keyed.join(found, stages.same_row(l_id, l_hash, l_text), "left_anti").select(*stages.own_columns(docs))
