"""Operator 2: near duplicates by SetSketch registers, bands, likelihood and exact check.

A text's set is its distinct 5-word shingles. Texts with equal sets form a
class; a class is compared once, however many copies it has.

Sketch. Every shingle draws a rising sequence of values, one from each of 256
exponentially growing intervals, and deals them to the registers in an order of
its own; a register keeps the smallest value it was dealt, rounded to a power
of ``BASE``. Registers of a union are the element-wise maxima of the rounded
exponents, so sketches merge; two sketches agree in a register about as often
as the sets agree (Ertl, SetSketch, VLDB 2021).

Candidates. Bands of five registers are hashed; classes that share a band are
candidates. At similarity 0.75 a pair shares no band with probability 1e-6.

Estimate. The numbers of registers that are larger, smaller and equal give the
similarity of maximum likelihood, given both set sizes; pairs more than five
standard deviations below the threshold are dropped.

Check. The remaining pairs are compared on their full sets.

Large buckets are never expanded into all pairs. In the first round each member
is compared with the bucket's hub, the member with most company in all its
buckets. Linked classes then count as one. In later rounds the members of a
bucket's smaller components (``PIVOTS`` at most) meet the members of other
components; registers are compared in arrays, in portions of ``PORTION``
members, likely pairs are compared there on their full sets, each in the first
band that it shares, and a link leaves the task only where it joins two
components: at most one a member. Pivots have then met their whole bucket and leave it. Rounds go on
until no bucket holds two components, so every pair in a bucket is either
compared or connected already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks, mix, shingle_sets, shingles, text_bytes, word_hashes

REGISTERS = 256
ROWS = 5
BANDS = REGISTERS // ROWS
BASE = 1.001
PERCENT = 75
#: Members of a bucket's smaller components that meet all others in one round, and members that one task compares them with at once.
PIVOTS = 256
PORTION = 4096
#: Elements of the sets that one task holds for these, pivots not counted.
PORTION_ELEMENTS = 1 << 22
#: Standard deviations by which an estimate may lie below the threshold.
DEVIATIONS = 5

_LEVELS = np.arange(REGISTERS + 1)
#: Interval bounds of the rising sequence of one element, as multiples of the register's scale.
with np.errstate(divide="ignore"):
    _BOUNDS = np.log1p(_LEVELS / np.maximum(REGISTERS - _LEVELS, 1e-9))


def _draw(elements: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The register each element deals its value of a level to, and the value's place in the level's interval."""
    start = elements & np.uint64(REGISTERS - 1)
    step = ((elements >> np.uint64(8)) & np.uint64(REGISTERS - 1)) | np.uint64(1)
    register = (start + np.array(level, np.uint64) * step) & np.uint64(REGISTERS - 1)
    place = mix(elements + np.array([level], np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
    return register.astype(np.int64), place.astype(np.float64) * 2.0**-53


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes, as rounded exponents; a set without elements has zeros."""
    smallest = np.full(REGISTERS, np.inf)
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    # All values of a level lie below those of the next: a register is settled by the first level that reaches it.
    open_ = REGISTERS
    for level in range(REGISTERS):
        register, place = _draw(elements, level)
        hit = smallest[register] == np.inf
        if hit.any():
            np.minimum.at(smallest, register[hit], level + place[hit])
            settled = smallest < np.inf
            open_ = REGISTERS - int(settled.sum())
            if not open_:
                break
    level = np.floor(smallest).astype(np.int64)
    low = _BOUNDS[level]
    # Within its interval a value is exponential, cut off at both ends; the last interval has no upper end.
    share = smallest - level
    width = np.exp(-low) - np.where(level + 1 < REGISTERS, np.exp(-_BOUNDS[np.minimum(level + 1, REGISTERS - 1)]), 0.0)
    value = -np.log(np.maximum(np.exp(-low) - share * width, 1e-300))
    exponent = np.floor(1.0 - np.log(np.maximum(value, 1e-300) / 64.0) / np.log(BASE))
    return np.clip(exponent, 1, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of a union."""
    return np.maximum(a, b)


def bands(registers: np.ndarray) -> np.ndarray:
    """A key for every band; the band's number is part of it."""
    rows = registers[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(ROWS):
        key = mix(key ^ rows[:, j] * np.uint64(0xA0761D6478BD642F))
    return key.view(np.int64)


_GRID = np.linspace(0.0, 1.0, 101)


def likely_similarity(above: np.ndarray, below: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of maximum likelihood for register comparisons of sets of known sizes, to a hundredth."""
    share = (n_a / np.maximum(n_a + n_b, 1))[:, None]
    most = np.minimum(share, 1 - share) / np.maximum(share, 1 - share)
    similarity = _GRID[None, :] * most

    def larger(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    p_above = larger(share - (1 - share) * similarity)
    p_below = larger((1 - share) - share * similarity)
    p_equal = np.maximum(1 - p_above - p_below, 1e-9)
    score = above[:, None] * np.log(p_above) + below[:, None] * np.log(p_below) + equal[:, None] * np.log(p_equal)
    return similarity[np.arange(len(score)), score.argmax(1)]


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes, column = batch.column("doc_id"), batch.column("text_hash"), batch.column("text")
        for a, b in blocks(column):
            sizes, digests, registers = [], [], []
            last = (b"", b"")
            for elements in shingle_sets(column.slice(a, b - a)):
                digest = _digest(elements)
                if digest != last[0]:
                    last = digest, sketch(elements).tobytes() if len(elements) else None
                sizes.append(len(elements))
                digests.append(digest if len(elements) else None)
                registers.append(last[1])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), hashes.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "class", "registers"],
            )


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class (digest of the set, null for an empty one) and registers of every row."""
    stages.small_batches(docs.sparkSession)
    rows = stages.texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(_describe, "doc_id long, text_hash long, n_shingles long, class binary, registers binary")


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        registers = [np.frombuffer(x, np.uint16) for x in batch.column("registers").to_pylist()]
        if not registers:
            continue
        index = pa.array(np.repeat(np.arange(len(registers)), BANDS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([bands(x) for x in registers])), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(registers))), batch.column("node").take(index), batch.column("n_shingles").take(index)],
            names=["band", "number", "node", "n"],
        )


def _likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Which pairs of registers are likely enough to be similar sets."""
    low = PERCENT / 100 - DEVIATIONS * np.sqrt(0.25 * 0.75 / REGISTERS)
    equal = (a == b).sum(1)
    out = equal >= (low - 0.1) * REGISTERS  # far fewer than any likely pair has
    above = (a[out] > b[out]).sum(1)
    out[out] = likely_similarity(above, REGISTERS - equal[out] - above, equal[out], n_a[out].astype(np.float64), n_b[out].astype(np.float64)) >= low
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Registers of a binary column, a row each."""
    return text_bytes(column)[0].view(np.uint16).reshape(-1, REGISTERS)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose likely similarity is not far below the threshold."""
    for batch in batches:
        if batch.num_rows:
            keep = _likely(_matrix(batch.column("registers_a")), _matrix(batch.column("registers_b")), *(batch.column(c).to_numpy() for c in ("n_a", "n_b")))
            yield batch.filter(pa.array(keep)).select(["a", "b"])


class _Joined:
    """Which components a portion's links have joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def _top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def same(self, x: int, y: int) -> bool:
        return self._top(int(x)) == self._top(int(y))

    def join(self, x: int, y: int) -> None:
        x, y = self._top(int(x)), self._top(int(y))
        self.up[max(x, y)] = min(x, y)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a pivot and a member of another component, portion by portion; rows come sorted by band and portion.

    A link that only joins what this portion's links have joined before is left out.
    """

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        names = ("band", "portion", "number", "node", "n", "component", "pivot")
        band, portion, number, node, n, component, pivot = (rows.column(c).to_numpy() for c in names)
        registers = _matrix(rows.column("registers").combine_chunks())
        edge = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (portion[1:] != portion[:-1]), [True]]))
        elements, offsets = text_bytes(rows.column("elements").combine_chunks())
        elements, offsets = elements.view(np.uint64), offsets // 8
        found_a, found_b = [], []
        for x, y in zip(edge[:-1], edge[1:]):
            ps, ms = np.flatnonzero(pivot[x:y]) + x, np.flatnonzero(~pivot[x:y]) + x
            own = set(node[ps].tolist())
            # Elements as numbers within the portion, so that a pivot's set is a bitmap.
            names, spot = np.unique(elements[offsets[x] : offsets[y]], return_inverse=True)
            marked = np.zeros(len(names), bool)
            joined = _Joined()
            for p in ps:
                q = ms[component[ms] != component[p]]
                q = q[100 * np.minimum(n[q], n[p]) >= PERCENT * np.maximum(n[q], n[p])]
                if not len(q):
                    continue
                mine = np.broadcast_to(registers[p], (len(q), REGISTERS))
                q = q[_likely(mine, registers[q], np.full(len(q), n[p]), n[q])]
                if not len(q):
                    continue
                # A pair is told by the first band it shares; two pivots tell it once.
                shared = (registers[q][:, : BANDS * ROWS].reshape(-1, BANDS, ROWS) == registers[p][: BANDS * ROWS].reshape(BANDS, ROWS)).all(2)
                q = q[shared.argmax(1) == number[p]]
                mine = spot[offsets[p] - offsets[x] : offsets[p + 1] - offsets[x]]
                marked[mine] = True
                for i in q.tolist():
                    if node[i] in own and node[p] > node[i] or joined.same(component[p], component[i]):
                        continue
                    both = int(marked[spot[offsets[i] - offsets[x] : offsets[i + 1] - offsets[x]]].sum())
                    if 100 * both >= PERCENT * (int(n[p]) + int(n[i]) - both):
                        joined.join(component[p], component[i])
                        found_a.append(int(node[p]))
                        found_b.append(int(node[i]))
                marked[mine] = False
        return pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        band, portion = held.column("band").to_numpy(), held.column("portion").to_numpy()
        whole = np.flatnonzero((band != band[-1]) | (portion != portion[-1]))
        if len(whole):
            yield compare(held.slice(0, int(whole[-1]) + 1))
            held = held.slice(int(whole[-1]) + 1)
    if held is not None:
        yield compare(held)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            found = [x.tobytes() for x in shingle_sets(batch.column("text").slice(a, b - a))]
            digests = [hashlib.blake2b(x, digest_size=16).digest() for x in found]
            right = pa.array([x == y for x, y in zip(digests, batch.column("class").slice(a, b - a).to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array(found, pa.binary())], names=["node", "elements"]).filter(right)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and component (its smallest node) of every node of undirected edges (a, b) of longs.

    Large-star and small-star steps (Kiveris et al., 2014) in turn, each a
    grouped minimum and a join, until the edges stay the same; the result of
    every turn is a written table. A node with many neighbours is no group:
    its minimum is combined before the shuffle, and its join may be split.
    """
    last = None
    while True:
        # Large star: greater neighbours move to the smallest neighbour.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours move to the smallest of them.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stages.stage(moved.select("e.a", "e.b").where("a <> b").distinct(), name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        last = state


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's hub."""
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("members"))
    company = buckets.join(sizes, "band").groupBy("node").agg(F.sum("members").alias("company"))
    best = buckets.join(company, "node").groupBy("band").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    pairs = buckets.join(best, "band").where("node <> hub")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _next_links(buckets: DataFrame, linked: DataFrame, classes: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that join different components, and the buckets that remain after these.

    Pivots are members of a bucket's smaller components, ``PIVOTS`` at most, and
    never of its largest.
    """
    state = buckets.join(linked, "node", "left").select("band", "number", "node", "n", F.coalesce("component", "node").alias("component"))
    parts = state.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements"))
    rising = Window.partitionBy("band").orderBy("size", "component")
    parts = parts.withColumn("before", F.coalesce(F.sum("size").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = parts.withColumn("next", F.lead("size").over(rising)).withColumns({x: F.sum(y).over(Window.partitionBy("band")) for x, y in (("members", "size"), ("weight", "elements"))})
    parts = parts.where(f"next is not null and before < {PIVOTS}").select("band", "component", "before", F.ceil(F.greatest(F.col("members") / PORTION, F.col("weight") / PORTION_ELEMENTS)).alias("portions"))
    chosen = state.join(parts, ["band", "component"])
    chosen = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("band", "component").orderBy("node"))).where(f"rank <= {PIVOTS}")
    pivots = stages.stage(chosen.where(f"before + rank <= {PIVOTS}").select(*state.columns, "portions"), "pivots")
    still = state.join(pivots.groupBy("band").agg(F.max("portions").alias("portions")), "band")
    members = still.withColumn("portion", F.pmod(F.xxhash64("node"), F.col("portions"))).withColumn("pivot", F.lit(False))
    guests = pivots.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1))).withColumn("pivot", F.lit(True))
    rows = members.unionByName(guests).drop("portions").join(classes.select("node", "registers"), "node").join(sets, "node")
    found = rows.repartition("band", "portion").sortWithinPartitions("band", "portion").mapInArrow(_meet, "a long, b long")
    rest = still.join(pivots.select("band", "node"), ["band", "node"], "left_anti")
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stages.stage(found, "links"), stages.stage(rest.select("band", "number", "node", "n"), "buckets")


def links(sketches: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes (node, class, n_shingles, registers), and the component of each node that is linked.

    A node is a hash of the class's digest; the class is represented by the row
    of its smallest doc_id.
    """
    found = sketches.where("class is not null")
    first = found.groupBy("class").agg(F.min("doc_id").alias("first")).withColumnRenamed("class", "c")
    kept = found.join(first, F.expr("class = c and doc_id <=> first"))
    classes = kept.select(F.xxhash64("class").alias("node"), "class", "doc_id", "n_shingles", "registers").dropDuplicates(["node"])
    classes = stages.stage(classes, "classes")
    bands_ = classes.select("node", "n_shingles", "registers").mapInArrow(_band_rows, "band long, number int, node long, n long")
    shared = bands_.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("band")
    buckets = stages.stage(bands_.join(shared, "band", "left_semi"), "buckets")
    # Whole sets of all texts that share a band, made once.
    needed = buckets.select("node").distinct().join(classes.select("node", "class", "doc_id"), "node")
    body = stages.texts(docs).withColumnRenamed("doc_id", "of").join(needed, F.expr("of <=> doc_id")).select("node", "class", "text")
    sets = stages.stage(body.mapInArrow(_sets, "node long, elements binary"), "sets")

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"registers_{x}"))
    sized = _first_pairs(buckets).join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    edges = _confirmed(stages.stage(sized.mapInArrow(_estimate, "a long, b long"), "pairs"), sets)
    linked = components(edges)
    while True:
        new, buckets = _next_links(buckets, linked, classes, sets)
        if not new.isEmpty():
            edges = stages.stage(edges.union(new).distinct(), "links")
            linked = components(edges)
        if buckets.isEmpty():
            return classes, linked


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("set_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("set_b")), "b")
    return stages.stage(both.mapInArrow(_confirm, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every row of ``docs``.

    Texts are linked if 100 * intersection >= 75 * union of their sets;
    ``component_id`` is the smallest doc_id that can be reached, ``kept`` is true
    for the row that has it. Null and empty texts are linked with nothing. Texts of fewer than five words
    have their whole sequence as one shingle. Equal rows give equal results. A
    row without doc_id takes part; its component may have no doc_id, and it is
    not kept unless alone. Other columns are left out.
    """
    sketches = stages.stage(describe(docs), "sketches")
    classes, linked = links(sketches, docs)
    member = classes.select("class", "node").join(linked, "node", "left").select("class", F.coalesce("component", "node").alias("part"))
    rows = sketches.select("doc_id", "text_hash", "n_shingles", "class").join(member, "class", "left")
    least = classes.join(member, "class").groupBy("part").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least, "part", "left").withColumn("component_id", F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return rows.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of every group of near duplicates, that of its smallest doc_id, all columns as they are.

    Texts without words are in no group and stay. Of rows that are equal in
    doc_id and text one stays.
    """
    found = near_duplicates(docs).where("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_rows"))
    d_id, d_hash, d_text, d_again = stages.free_names(docs, "d_id", "d_hash", "d_text", "d_again")
    found = stages.stage(found.select(F.col("doc_id").alias(d_id), F.col("text_hash").alias(d_hash), (F.col("n_rows") > 1).alias(d_again)), "kept")
    keyed = docs.withColumn(d_text, F.xxhash64(F.col("text").cast("string")))
    joined = keyed.join(found, stages.same_row(d_id, d_hash, d_text))
    once = joined.where(~F.col(d_again)).select(*stages.own_columns(docs))
    # Few rows, if any: only these are compared by their texts.
    return once.unionByName(joined.where(d_again).dropDuplicates(["doc_id", "text"]).select(*stages.own_columns(docs)))
