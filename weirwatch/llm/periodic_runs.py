"""Operator 11: periodic runs of words, by scale-tiled distribution.

A run is a stretch of at least ``max(12, 2 q)`` consecutive words with smallest
period ``q`` that neither neighbour extends. Where words ``p`` apart are equal
over a stretch, the stretch is at least ``max(p, 12 - p)`` places long, so it
holds a multiple of a step that depends on the octave of ``p`` alone.

1. Each document is cut, per octave of periods, into overlapping tiles. Only
   tiles with a boundary (a multiple of the step) whose five words recur within
   the octave's reach go on; a run has such a boundary, so none is lost.
2. Each tile is solved alone: at a boundary, one Z-function to the right and
   one to the left tell for all periods of the octave how far words a period
   apart agree. A period whose word is a power of a shorter one is left out.
3. Stretches are shuffled by document and period, and those that overlap are
   stitched: a run that crosses tiles comes out whole.

Work is about the document's length for each octave, and no task ever holds
more than one document or one tile.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks, distinct, mix, shingles, text_bytes, word_hashes

LEAST_WORDS = 12
#: Words that must recur to make a boundary worth a look; every stretch has more.
GRAM = 5
CORE_WORDS = 1 << 13
_NEVER = 1 << 62

CUT_TYPE = "row long, doc_id long, octave int, at long, words binary, visits binary, text string, collapsed_sha256 string"
STRETCH_TYPE = "row long, period long, first long, last long"
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def step_of(octave: int) -> int:
    """Distance of boundaries: the fewest places at which words of five begin in a stretch of the octave's periods."""
    return min(max(p, LEAST_WORDS - p) for p in range(1 << octave, min(2 << octave, (1 << octave) + LEAST_WORDS))) - GRAM + 1


def _next_equal(grams: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Distance from each five words to their next occurrence in the same row; _NEVER if there is none."""
    row = np.repeat(np.arange(1, len(per_row) + 1, dtype=np.uint64), per_row)
    keys = grams ^ mix(row * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    away = np.full(len(keys), _NEVER, np.int64)
    away[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return away


def _boundaries(away: np.ndarray, octave: int, step: int, core: int) -> np.ndarray:
    """Boundaries at which a run of the octave may be seen first within its tile.

    Left out are those whose five words do not recur in reach; those to whose
    right a shorter period holds all along, so that any period of the octave is
    a multiple of it; and those whose only period also holds at the boundary
    before, which sees the same stretch.
    """
    low, high = 1 << octave, 2 << octave
    at = np.arange(0, len(away), step)
    at = at[away[at] < high]
    if not len(at):
        return at
    edges = np.flatnonzero(away[1:] != away[:-1]) + 1
    begin = np.concatenate([[0], edges])
    piece = np.searchsorted(begin, at, "right") - 1
    begin, end = begin[piece], np.append(edges, len(away))[piece]
    near = away[at]
    shorter = (near < low) & (end - at >= high)
    alone = (near >= low) & (near + away[at + near] >= high)
    seen = alone & (begin <= at - step) & (at % core >= step)
    return at[~shorter & ~seen]


def cut_tiles(words: np.ndarray, away: np.ndarray, core_words: int = CORE_WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Octave, first word, words and boundaries of each tile of a document that may hold a part of a run."""
    octave = 0
    while 2 << octave <= len(words):
        high = 2 << octave
        core, reach = max(core_words, 4 * high), high + 16
        at = _boundaries(away, octave, step_of(octave), core)
        for tile in distinct(at // core).tolist() if len(at) else ():
            first = max(tile * core - reach, 0)
            last = min((tile + 1) * core + reach + high, len(words))
            yield octave, first, words[first:last], (at[at // core == tile] - first).astype(np.int32)
        octave += 1


def _agree(seq: np.ndarray, a: int, b: int) -> int:
    """How long the sequence agrees from a and from b > a on."""
    n, size, most = 0, 16, len(seq) - b
    while n < most:
        size = min(size, most - n)
        differ = seq[a + n : a + n + size] != seq[b + n : b + n + size]
        first = int(differ.argmax())
        if differ[first]:
            return n + first
        n += size
        size *= 4
    return n


def z_function(seq: np.ndarray, origin: int, places: list[int]) -> dict[int, int]:
    """For ascending distances, how long the sequence agrees from the origin and from that far on."""
    found: dict[int, int] = {}
    left = right = 0  # the piece that agrees with the beginning and reaches furthest
    for i in places:
        mirrored = found.get(i - left) if i < right else None
        n = 0 if mirrored is None else min(mirrored, right - i)
        if mirrored is None or i + n >= right:
            n += _agree(seq, origin + n, origin + i + n)
            if i + n > right:
                left, right = i, i + n
        found[i] = n
    return found


@functools.lru_cache(1 << 16)
def prime_factors(n: int) -> tuple[int, ...]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return (*out, n) if n > 1 else tuple(out)


def solve_tile(words: np.ndarray, octave: int, boundaries: np.ndarray) -> list[tuple[int, int, int]]:
    """Period, first and last place of stretches in which words a period apart are equal, as far as the tile shows."""
    low, high = 1 << octave, 2 << octave
    back = high + 16 + step_of(octave)
    grams, _ = shingles(words.astype(np.uint64), np.array([len(words)]), GRAM)
    out = []
    for x in boundaries.tolist():
        places = (np.flatnonzero(grams[x + 1 : x + high] == grams[x]) + 1).tolist()
        if not places or places[-1] < low:
            continue
        right = z_function(words, x, places)
        periods = [p for p in places if p >= low and not any(right.get(p // f, 0) >= p - p // f for f in prime_factors(p))]
        if not periods:
            continue
        # To the left: both sides reversed, one after the other, so one Z-function tells all periods.
        begin, reach = max(x - back, 0), min(high, len(words) - x)
        mirror = np.concatenate([words[begin:x][::-1], [-1], words[begin : x + reach][::-1]])
        shift = {p: x - begin + 1 + reach - p for p in periods}
        left = z_function(mirror, 0, sorted(shift.values()))
        for p in periods:
            first, last = x - left[shift[p]], x + right[p]
            if last - first >= p:
                out.append((p, first, last))
    return out


def _cut(batches: Iterable[pa.RecordBatch], core_words: int, texts: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            column, ids = batch.column("text").slice(a, b - a), batch.column("doc_id").slice(a, b - a).to_pylist()
            data, offsets = text_bytes(column)
            hashes, counts = word_hashes(data, offsets, lower=False)
            grams, per_row = shingles(hashes, counts, GRAM)
            away = _next_equal(grams, per_row)
            word_at, gram_at = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, per_row))
            raw, out = data.tobytes(), []
            for i in range(b - a):
                joined = b" ".join(raw[offsets[i] : offsets[i + 1]].split())
                mine = away[gram_at[i] : gram_at[i + 1]]
                tiles: Iterable = ()
                if counts[i] >= LEAST_WORDS and (mine < _NEVER).any():
                    names = np.unique(hashes[word_at[i] : word_at[i + 1]], return_inverse=True)[1].astype(np.int32)
                    tiles = list(cut_tiles(names, mine, core_words))
                out += [(row, None, k, at, w.tobytes(), v.tobytes(), None, None) for k, at, w, v in tiles]
                kept = joined.decode() if tiles or texts else None
                out.append((row, ids[i], None, None, None, None, kept, None if tiles else hashlib.sha256(joined).hexdigest()))
                row += 1
            yield _batch(out, CUT_ARROW)


CUT_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("octave", pa.int32()), ("at", pa.int64()), ("words", pa.binary()), ("visits", pa.binary()),
    ("text", pa.string()), ("collapsed_sha256", pa.string()),
])
STRETCH_ARROW = pa.schema([(x, pa.int64()) for x in ("row", "period", "first", "last")])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for tile in batch.to_pylist():
            words, visits = np.frombuffer(tile["words"], np.int32), np.frombuffer(tile["visits"], np.int32)
            out += [(tile["row"], p, tile["at"] + s, tile["at"] + e) for p, s, e in solve_tile(words, tile["octave"], visits)]
        yield _batch(out, STRETCH_ARROW)


def stitch(stretches: DataFrame) -> DataFrame:
    """Runs of each row from overlapping stretches of one period: ``row``, ``start``, ``length``, ``period``."""
    along = Window.partitionBy("row", "period").orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(before.isNull() | (F.col("first") > before), 1).otherwise(0)
    parts = stretches.withColumn("apart", apart).withColumn("part", F.sum("apart").over(along))
    whole = parts.groupBy("row", "period", "part").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    runs = whole.select("row", "start", (F.col("last") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), 2 * F.col("period")))


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            words = np.array(text.split(" "), object)
            change = np.zeros(len(words) + 1, np.int64)
            for run in runs or ():
                change[run["start"] + run["period"]] += 1
                change[run["start"] + run["length"]] -= 1
            out.append(" ".join(words[np.cumsum(change[:-1]) == 0]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("runs"), pa.array(out, pa.string())], names=["doc_id", "runs", "text"])


def collapsed_documents(docs: DataFrame, texts: bool = True, core_words: int = CORE_WORDS) -> DataFrame:
    """All runs of all documents, and what remains of each text: ``doc_id``, ``runs``, ``text``, ``collapsed_sha256``.

    ``runs`` is an array of start (a word's number), length and period, by
    start, then period. ``text`` has the words joined by one space, less those
    that some run contains after its first period; the hash is that of this
    text's UTF-8 bytes. Without ``texts``, texts without any recurrence are
    hashed where they are read and their ``text`` is null.

    One row per input row. A null or empty text has no run and an empty
    collapsed text. A null doc_id stays null; repeated rows are solved each
    for itself and stay; columns but ``doc_id`` and ``text`` are left out. An
    empty table gives an empty result. Texts are handled whole, of any length;
    equal words are found by 64-bit hashes.
    """
    stages.small_batches(docs.sparkSession)

    def cut(batches):
        return _cut(batches, core_words, texts)

    # One write, so that row numbers and tiles are those of the task that committed.
    rows = stages.stage(stages.texts(docs).mapInArrow(cut, CUT_TYPE), "periodic-tiles")
    tiles = rows.where("octave is not null").select("row", "octave", "at", "words", "visits")
    stretches = tiles.repartition("row", "octave", "at").mapInArrow(_solve, STRETCH_TYPE)
    runs = stitch(stretches).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    recurring = rows.where("octave is null and collapsed_sha256 is null").select("row", "doc_id", "text").join(runs, "row", "left")
    collapsed = recurring.select("doc_id", "text", "runs").mapInArrow(_collapse, f"doc_id long, runs {RUN_TYPE}, text string")
    collapsed = collapsed.withColumn("collapsed_sha256", F.sha2("text", 256))
    plain = rows.where("collapsed_sha256 is not null").select("doc_id", F.lit(None).cast(RUN_TYPE).alias("runs"), "text", "collapsed_sha256")
    found = plain.unionByName(collapsed)
    return found.withColumn("runs", F.coalesce("runs", F.array().cast(RUN_TYPE)))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where one of ten texts goes on, from some word, in a period of its own.

    Decided by h, the crc32 of the decimal doc_id: where ten divides it, with
    g = h div 10 and n words, words from g mod n on repeat the first
    1 + (what remains div (3 + g mod 8)) of them.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        # An array of one struct binds these values once, outside the loop over words.
        bounds = F.array(F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p")))
        def word(i, x):
            return F.get(words, F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))
        return F.transform(bounds, lambda x: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: word(i, x)), " "))[0]

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)))[0]
    return stages.texts(docs).select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def describe(found: DataFrame) -> DataFrame:
    """Figures of each document's runs: their number, the longest one (ties: first start, then period), and hashes."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
