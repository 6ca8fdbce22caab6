"""Operator 6: repeated byte spans by interval expansion on Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier,
in a document of smaller doc_id or earlier in the same one.

Dealing out. The least hash of pairs of 16-byte grams in a window of ``LENGTH`` bytes (its
anchor) depends on the window alone, so equal windows have equal anchors. A pair, as
16 bytes alone are shared by chance the more often the larger the input is. The windows
of one anchor's place are a segment; only segments whose anchor is found at
two places, or twice in itself, are looked at, and segments that are equal to an earlier one go as a
whole: segments are dealt out and sorted by anchor once, which settles both. What remains
are anchors with several different segments: these are
grouped by anchor, and groups are put together to texts of about a megabyte.

Expansion. A text's suffixes are sorted to ``LENGTH`` bytes by prefix doubling,
which gives its Burrows-Wheeler transform. From the intervals of all strings of
eight bytes, a breadth-first search extends strings backward by one character
at a time (Beller, Gog, Ohlebusch, Schnattinger, 2013): the right end of every
new interval is a place whose common prefix is the string's length, so common
prefixes come in rising order. An interval whose end is known already is left;
the search stops at ``LENGTH``. Places that were not reached have a common
prefix of ``LENGTH`` at least: the windows between two reached places are equal.

Anchors with more than ``HOT`` different segments would be large groups; their
windows are hashed to 128 bits and settled by that, which is exact too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import BLOCK_BYTES, blocks, hash_ranges, mix, text_bytes

LENGTH = 100
GRAM = 16
HOT = 20_000
TEXT_BYTES = 1 << 20
#: Places that are hashed at a time, so that intermediate values stay in the cache.
CHUNK = 1 << 14
#: Rows of segments that are settled at a time, at least.
SETTLED_ROWS = 100_000
_OTHER_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def gram_bytes(length: int) -> int:
    """Bytes of the grams that anchors are made of: a pair, unless windows are too short for it."""
    return 2 * GRAM if length >= 4 * GRAM else GRAM


def _eights(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from every place on as a number."""
    return np.ndarray((max(len(data) - 7, 0),), f"{order}u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)


def _grams(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the 16 or 32 bytes from every place on."""
    n = len(data) - size + 1
    out = np.empty(n, np.uint64)
    for a in range(0, n, CHUNK):
        b = min(a + CHUNK, n)
        eight = _eights(data[a : b + size - 1])
        one = mix(eight[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ mix(eight[8:]))
        out[a:b] = one if size == GRAM else mix(one[:-GRAM] * np.uint64(0xD1342543DE82EF95) ^ one[GRAM:])
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of so many values from every place on, as far as they reach."""
    n = len(values) - width + 1
    out = np.empty(n, values.dtype)
    for a in range(0, n, CHUNK):
        least, wide = values[a : min(a + CHUNK, n) + width - 1], 1
        while wide < width:
            step = min(wide, width - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        out[a : a + len(least)] = least
    return out


def window_anchors(data: np.ndarray, place: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The least gram of the window from every place on, as far as windows fit, and all grams.

    The low bits are the gram's place in its text (``place``), so that equal
    grams are told apart, in all copies of a text alike; the others (``>> 7``)
    depend on the window alone.
    """
    size = gram_bytes(length)
    grams = _grams(data, size)
    grams &= ~np.uint64(127)
    grams |= place[: len(grams)].view(np.uint64) & np.uint64(127)
    return _least(grams, length - size + 1), grams


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """anchor, row, start in the row, number of windows, hash of the bytes of every segment of a block of rows, and whether it has its anchor's gram twice."""
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint64, bool))
    offsets = offsets.astype(np.int64)
    anchor, grams = window_anchors(data, np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets)), length)
    # A segment ends where its anchor does, and with the last window that fits into its row.
    new = np.ones(len(anchor) + length, bool)
    new[1 : len(anchor)] = anchor[1:] != anchor[:-1]
    new[offsets] = True
    new[np.maximum(offsets[1:] - length + 1, offsets[:-1])] = True
    start = np.flatnonzero(new[: len(anchor)])
    size = np.diff(np.append(start, len(anchor)))
    row = np.searchsorted(offsets, start, "right") - 1
    fits = start + length <= offsets[row + 1]
    start, size, row = start[fits], size[fits], row[fits]
    return anchor[start] >> np.uint64(7), row, start - offsets[row], size, hash_ranges(data, start, start + size + length - 1), _again_soon(grams, anchor[start], 2 * length)


def _again_soon(grams: np.ndarray, anchors: np.ndarray, within: int) -> np.ndarray:
    """Which anchors are grams that come again within so many bytes: windows of one place may be equal only by such a period. The low 7 bits don't count."""
    some = np.zeros(1 << 20, bool)
    some[anchors >> np.uint64(44)] = True
    place = np.flatnonzero(some[(grams >> np.uint64(44)).view(np.int64)])
    value = grams[place] >> np.uint64(7)
    order = np.argsort(value, kind="stable")
    value, place = value[order], place[order]
    near = (value[1:] == value[:-1]) & (place[1:] - place[:-1] <= within)
    return np.isin(anchors >> np.uint64(7), value[1:][near])


def _segment_rows(length: int):
    names = ["anchor", "content", "place", "text_key", "span"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column("text")):
                keys, place = (batch.column(c).slice(a, b - a) for c in ("text_key", "place"))
                data, offsets = text_bytes(batch.column("text").slice(a, b - a))
                for first in range(0, max(len(data) - length + 1, 0), BLOCK_BYTES):
                    # A long text is read in pieces that overlap by less than a window.
                    part = data[first : first + BLOCK_BYTES + length - 1]
                    cut = offsets if len(data) <= BLOCK_BYTES else np.array([0, len(part)])
                    anchor, row, start, size, content, twice = segments(part[: cut[-1]], cut, length)
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), place.take(row), keys.take(row), pa.array(_span(start + first, size, twice))],
                        names=names,
                    )
                    if len(data) <= BLOCK_BYTES:
                        break

    return run


def _span(start: np.ndarray, size: np.ndarray, twice: np.ndarray | bool = False) -> np.ndarray:
    """Start, number of windows and whether the anchor comes twice as one number, in the order of starts."""
    return (start << 17) | (size << 1) | twice


def _settled(found: DataFrame, length: int) -> DataFrame:
    """Of segments that are equal in anchor and content, the first stays in question, all others go as a whole (``segments`` is 0).

    Firsts are given if their anchor has several of them, their number being
    ``segments``, or has its gram twice. ``size`` is in bytes.
    """
    ordered = found.repartition("anchor").sortWithinPartitions("anchor", "place", "text_key", "span")
    return ordered.mapInArrow(_settle(length), "anchor long, place long, text_key long, start long, size long, segments long")


def _settle(length: int):
    names = ["anchor", "content", "place", "text_key", "span"]

    def settle(columns: list[np.ndarray], whole: bool) -> tuple[pa.RecordBatch, list[np.ndarray] | None]:
        """Result rows, and the firsts of the last anchor unless the rows are whole."""
        anchor, twice = columns[0], (columns[4] & 1).astype(bool)
        last = len(anchor) if whole else int(np.searchsorted(anchor, anchor[-1]))
        keep = twice.copy()
        same = anchor[1:] == anchor[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        keep[last:] = True
        open_rows = len(anchor) - last
        columns = [c[keep] for c in columns]
        order = np.lexsort((columns[1], columns[0]))  # stable: of equal segments the first in order stays the first
        columns = [c[order] for c in columns]
        anchor, content, place, key, span = columns
        if not len(anchor):
            return pa.RecordBatch.from_arrays([pa.array(anchor)] * 6, names=out_names), None
        opens = np.ones(len(anchor), bool)
        opens[1:] = anchor[1:] != anchor[:-1]
        first = opens.copy()
        first[1:] |= content[1:] != content[:-1]
        begin = np.flatnonzero(first)
        of = begin[np.cumsum(first) - 1]
        goes = (key != key[of]) | (span >> 17 != span[of] >> 17)
        group = np.cumsum(opens) - 1
        segments = np.bincount(group[begin])[group]
        again = np.zeros(group[-1] + 1, bool)
        again[group[begin[(span[begin] & 1).astype(bool)]]] = True
        is_open = np.arange(len(anchor)) >= len(anchor) - open_rows
        wanted = first & ((segments > 1) | again[group]) & ~is_open
        at = np.flatnonzero(goes | wanted)
        rows = [anchor[at], place[at], key[at], span[at] >> 17, ((span[at] >> 1) & 0xFFFF) + length - 1, np.where(wanted[at], segments[at], 0)]
        held = None if whole else [c[first & is_open] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=out_names), held

    out_names = ["anchor", "place", "text_key", "start", "size", "segments"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, rows = None, [], 0

        def together() -> list[np.ndarray]:
            table = pa.Table.from_batches(waiting)
            columns = [table.column(c).to_numpy() for c in names]
            return columns if held is None else [np.concatenate(x) for x in zip(held, columns)]

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
            if rows >= max(SETTLED_ROWS, 0 if held is None else len(held[0])):
                out, held = settle(together(), False)
                waiting, rows = [], 0
                yield out
        if waiting:
            held = together()
        if held is not None:
            yield settle(held, True)[0]

    return run


def _stable_order(key: np.ndarray, bits: int) -> np.ndarray:
    """Places in the order of a key of so many bits, equal keys by place.

    Key and place are sorted as one number, far faster than a stable ``argsort``, which is left to keys too wide for that.
    """
    low = max(len(key) - 1, 1).bit_length()
    if bits + low > 64:
        return np.argsort(key, kind="stable")
    packed = np.sort((key.astype(np.uint64) << np.uint64(low)) | np.arange(len(key), dtype=np.uint64))
    return (packed & np.uint64((1 << low) - 1)).astype(np.int64)


def _first_eight(symbols: np.ndarray) -> np.ndarray:
    """The first eight symbols of every suffix as a number; behind the end there are zeros."""
    return _eights(np.concatenate([symbols, np.zeros(7, np.uint8)]), ">")


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` (8 at least) symbols.

    Each round sorts only suffixes that are still equal to others; they keep
    their slots in the order. A rank is the first slot of equal suffixes.
    """
    n, half = len(symbols), len(symbols).bit_length()
    key = _first_eight(symbols)
    order = np.argsort(key)
    key, slots, known = key[order], np.arange(n), 8
    rank = np.zeros(n + depth, np.uint32)  # behind the end there is nothing, which is before all others
    while True:
        new = np.ones(len(slots) + 1, bool)
        np.not_equal(key[1:], key[:-1], out=new[1:-1])
        rank[order[slots]] = np.maximum.accumulate(np.where(new[:-1], slots, 0)) + 1
        slots = slots[~(new[:-1] & new[1:])]
        if known >= depth or not len(slots):
            return order
        step = min(known, depth - known)
        equal = order[slots]
        key = (rank[equal].astype(np.uint64) << np.uint64(half)) | rank[equal + step]
        by = _stable_order(key, 2 * half)
        order[slots], key = equal[by], key[by]
        known += step


def reached_places(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in suffix order, whether its common prefix with the place before is known to be below ``length``.

    Symbol 0 ends a segment and is never extended over.
    """
    n = len(order)
    before = symbols[order - 1]
    before[order == 0] = 0
    back = np.empty(n, np.int64)
    back[np.argsort(before, kind="stable")] = np.arange(n)
    reached = np.zeros(n + 1, bool)
    reached[0] = reached[n] = True
    eight = _first_eight(symbols)[order]
    reached[1:n] = eight[1:] != eight[:-1]
    low = np.flatnonzero(reached[:-1])
    high = np.append(low[1:], n) - 1
    for _ in range(8, length):
        one = low == high
        single = low[one][before[low[one]] != 0]
        first, last = low[~one], high[~one]
        size = last - first + 1
        owner = np.repeat(np.arange(len(first)), size)
        rows = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        char = before[rows]
        solid = char != 0
        owner, rows, char = owner[solid], rows[solid], char[solid]
        key = owner * 256 + char
        by = _stable_order(key, max(len(first), 1).bit_length() + 8)
        key, rows = key[by], rows[by]
        edge = np.ones(len(key), bool)
        edge[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], len(key)) - 1
        low = np.concatenate([back[single], back[rows[begin]] if len(begin) else begin])
        high = np.concatenate([back[single], back[rows[end]] if len(begin) else begin])
        fresh = ~reached[high + 1]
        low, high = low[fresh], high[fresh]
        reached[high + 1] = True
        if not len(low):
            break
    return reached[:n]


def repeated_windows(pieces: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(piece, place, number) of runs of windows that are found earlier, in an earlier piece or before in the same."""
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    order = suffix_order(symbols, length)
    reached = reached_places(symbols, order, length)
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    whole = np.arange(len(symbols)) + length <= (starts + sizes)[piece]
    # Equal windows are neighbours; the first in the text stays.
    inside = whole[order]
    group = np.cumsum(reached | ~inside | ~np.concatenate([[True], inside[:-1]]))
    group, places = group[inside], order[inside]
    if not len(places):
        return []
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(places, edge), np.diff(np.append(edge, len(places))))
    again = np.zeros(len(symbols) + 1, bool)
    again[places[places != least]] = True
    turn = np.flatnonzero(again[1:] != again[:-1]) + 1
    begin = np.concatenate([[0], turn])[again[np.concatenate([[0], turn])]]
    end = turn[~again[turn]]
    return [(int(piece[a]), int(a - starts[piece[a]]), int(b - a)) for a, b in zip(begin, end)]


def _expand(length: int, text_bytes_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            # A row of the input that comes twice gives its segments twice.
            rows = [row for _, row in sorted({r[:3]: r for r in kept}.items())]
            found = [(rows[i][1], rows[i][2] + at, n + length - 1) for i, at, n in repeated_windows([r[3] for r in rows], length)]
            columns = list(zip(*found)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["text_key", "start", "size"])

        last = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "place", "text_key", "start", "bytes")]
            for anchor, *row in zip(*columns):
                if anchor != last and size >= text_bytes_:
                    yield close()
                    kept, size = [], 0
                last = anchor
                kept.append(tuple(row))
                size += len(row[3])
        if kept:
            yield close()

    return run


def _hashed_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("bytes"))
            number = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(len(number)), number)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            begin = offsets[row] + inside
            halves = [hash_ranges(data, begin, begin + length, *t).view(np.int64) for t in ((), (_OTHER_BYTE,))]
            start = batch.column("start").to_numpy()[row] + inside
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, halves), batch.column("place").take(pa.array(row)), batch.column("text_key").take(pa.array(row)), pa.array(_span(start, np.ones(len(row), np.int64)))],
                names=["anchor", "content", "place", "text_key", "span"],
            )

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each row's list starts in the flat values, and these."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        at, wanted = _lists(batch.column("wanted"))
        start, end = (wanted.field(c).to_numpy() for c in ("start", "end"))
        pieces = []
        for i in range(batch.num_rows):
            raw = batch.column("text")[i].as_buffer().to_pybytes()
            pieces += [raw[a:b] for a, b in zip(start[at[i] : at[i + 1]].tolist(), end[at[i] : at[i + 1]].tolist())]
        index = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at)))
        yield pa.RecordBatch.from_arrays(
            [wanted.field("anchor"), wanted.field("segments"), batch.column("place").take(index), batch.column("text_key").take(index), pa.array(start.astype(np.int64)), pa.array(pieces, pa.binary())],
            names=["anchor", "segments", "place", "text_key", "start", "bytes"],
        )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, digest = [], [], []
        at, cuts_ = _lists(batch.column("cuts"))
        start, size = (cuts_.field(c).to_numpy() for c in ("start", "size"))
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
            a, n = start[at[i] : at[i + 1]], size[at[i] : at[i + 1]]
            turns = np.bincount(a, minlength=len(data) + 1) - np.bincount(a + n, minlength=len(data) + 1)
            gone = np.cumsum(turns[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            digest.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], names=["text_key", "n_removed", "n_spans", "kept_sha256"])


_LAST = (1 << 63) - 1


def _sources(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The described rows, and the first row (place) of every different text; texts are told apart by a 64-bit key without clash."""
    rows = stages.texts(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("place", F.coalesce("doc_id", F.lit(_LAST)))
    seed = 0
    while True:
        keyed = rows.withColumn("text_key", F.xxhash64(F.lit(seed), "text"))
        described = stages.stage(keyed.select("doc_id", "place", "text_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "sources")
        first = described.groupBy("text_key").agg(F.min("place").alias("first"), F.min("sha").alias("a"), F.max("sha").alias("b"))
        if first.where("a <> b").isEmpty():
            return keyed, described.join(first.select("text_key", "first"), "text_key")
        seed += 1


def cuts(keyed: DataFrame, length: int = LENGTH, hot: int = HOT, text_bytes_: int = TEXT_BYTES) -> DataFrame:
    """text_key, start, size of byte ranges to remove from the first row of each text; ranges may overlap."""
    spark = keyed.sparkSession
    stages.small_batches(spark)
    row = "anchor long, content long, place long, text_key long, span long"
    settled = stages.stage(_settled(keyed.select("text", "text_key", "place").mapInArrow(_segment_rows(length), row), length), "settled")
    out = settled.where("segments = 0").select("text_key", "start", "size")
    wanted = settled.where("segments > 0").select("text_key", "place", F.struct("anchor", "segments", "start", (F.col("start") + F.col("size")).alias("end")).alias("w"))
    wanted = wanted.groupBy("text_key", "place").agg(F.collect_list("w").alias("wanted"))
    body = keyed.select(F.col("place").alias("p"), F.col("text_key").alias("k"), "text")
    pieces = body.join(wanted, F.expr("text_key = k and place = p")).drop("k", "p")
    pieces = stages.stage(pieces.mapInArrow(_cut_out, "anchor long, segments long, place long, text_key long, start long, bytes binary"), "pieces")
    cool = pieces.where(F.col("segments") <= hot).drop("segments")
    expanded = cool.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_expand(length, text_bytes_), "text_key long, start long, size long")
    windows = pieces.where(F.col("segments") > hot).mapInArrow(_hashed_windows(length), row)
    again = _settled(windows, length).where("segments = 0").select("text_key", "start", "size")
    return out.unionByName(expanded).unionByName(again)


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, text_bytes_: int = TEXT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``.

    Null text is empty. A null doc_id comes after all others; different texts of
    one doc_id are ordered by their hash. Rows that are equal in both are one
    document and get one result each. A later copy of a whole text loses all its
    bytes if it has ``length`` of them. Other columns are left out.
    """
    keyed, described = _sources(docs, length)
    ranges = stages.stage(cuts(keyed, length, hot, text_bytes_), "cuts").groupBy("text_key").agg(F.collect_list(F.struct("start", "size")).alias("cuts"))
    firsts = described.groupBy("text_key").agg(F.min("first").alias("p")).withColumnRenamed("text_key", "k")
    body = keyed.select("place", "text_key", "text").join(firsts.join(ranges.withColumnRenamed("text_key", "r"), F.expr("k = r")), F.expr("text_key = k and place = p"))
    changed = body.select("text", "text_key", "cuts").mapInArrow(_remove, "text_key long, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["text_key"])
    out = described.join(changed, "text_key", "left")
    copy = (F.col("place") != F.col("first")) & (F.col("n_bytes") >= length)
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes
    early = F.col("place") == F.col("first")
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).when(early, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, 1).when(early, F.coalesce("n_spans", F.lit(0))).otherwise(0).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).when(early, F.coalesce("kept_sha256", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
