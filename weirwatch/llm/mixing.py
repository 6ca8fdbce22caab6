"""Operator 9: mix sources to target weights by a low-discrepancy schedule.

Sizes count words. A source's documents are put into a hash order and cut into
blocks of ``BLOCK_WORDS`` words at all sizes of input; a source of few such
blocks has finer ones. Slots, one a block, are dealt to sources by the
golden-ratio sequence: the place ``frac(slot * phi)`` falls into one source's
span of the cumulative numbers of slots, so every prefix of the mix is close to
the targets. The k-th slot of a source takes block k, from the first again when
all are taken, and its last slot stops at the target's last word, so a source
gives exactly its target in whole words.

The slots joined with the documents' shares of their blocks are the mix: a
sequence of pieces (:func:`sequence`). What is taken of a document is the sum of
its pieces, and every prefix of the sequence has the sources near their targets.

Prefix sums run over hash buckets first and inside one bucket then, so a source
with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirwatch.llm import stages

#: Weights by place in the order of sources, and the share of all words that the mix has.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Words of a block, and the blocks that a source has at least, if it has as many words.
BLOCK_WORDS = 256
LEAST_BLOCKS = 64
BUCKETS = 4096
#: Two Fibonacci numbers in a row: their ratio is the golden ratio to 1e-18, and whole numbers keep every bit of a point.
TURN, CIRCLE = 1_134_903_170, 1_836_311_903
#: Cells that a lookup of spans has for every source, and blocks that one step of an explode makes.
CELLS = 4
STEP = 4096
SOLID = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text"):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none. A word starts where white space ends."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\f\r", "     ")
    pieces = F.split(plain, " +")
    return (F.size(pieces) - (pieces[0] == "").cast("int") - ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, weight, source_size and target of every source, from (source, source_size).

    Sources by code point, null last, take the weights in turn. A target stops
    at ``most`` times the source's size; the excess goes to the others by
    weight. At the end all that didn't stop have the same target per weight, so
    that level is found from sorted caps and prefix sums. One row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn("place", F.row_number().over(order) - 1)
    placed = placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(most))
    all_ = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    level = placed.select(
        "*", (F.sum("source_size").over(all_) * float(share)).alias("total"), F.sum("weight").over(all_).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("caps_before"), F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
    )
    level = level.withColumn("level", (F.col("total") - F.col("caps_before")) / (F.col("weights") - F.col("weights_before")))
    # The first source in rising order whose cap is not reached fixes the level of all after it.
    level = level.withColumn("free", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(all_))
    target = F.when(F.col("free").isNull() | (F.col("level") * F.col("weight") > F.col("cap")), F.col("cap")).otherwise(F.least("cap", F.col("free")["level"] * F.col("weight")))
    return level.select("source", "place", "weight", "source_size", target.alias("target"))


def block_plan(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """source_place, block_words, blocks, need and last_end of every source that is taken from.

    ``need`` slots hold the target, rounded to whole words: full rounds over all
    blocks, then blocks from the first on. The last slot stops before word ``last_end``.
    """
    size = F.col("source_size")
    plan = targets.select(F.col("place").alias("source_place"), size, F.round("target").cast("long").alias("wanted")).where("wanted > 0")
    plan = plan.withColumn("block_words", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(size / LEAST_BLOCKS))).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(size / F.col("block_words"))).withColumn("rest", F.col("wanted") % size)
    need = F.floor(F.col("wanted") / size) * F.col("blocks") + F.ceil(F.col("rest") / F.col("block_words"))
    return plan.select("source_place", "block_words", "blocks", need.alias("need"), F.when(F.col("rest") > 0, F.col("rest")).otherwise(size).alias("last_end"))


def schedule(plan: DataFrame, seed: int = 0) -> DataFrame:
    """slot, source place and the rank of the slot among its source's slots; every source has ``need`` of them.

    Slot i has the place ``i * TURN mod CIRCLE`` on a circle, in whole numbers, so
    no slot is too far on for an exact point; beyond ``CIRCLE`` slots the points
    come again. The sequence deals a source some slots more or less than it needs.
    Those beyond go, in order, to the sources that lack some.
    """
    spark = plan.sparkSession
    rising = Window.orderBy("source_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = plan.select("source_place", "need", F.sum("need").over(rising).alias("to")).withColumn("from", F.col("to") - F.col("need"))
    slots, sources = plan.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count(F.lit(1))).first()
    turned = F.pmod(F.col("id") + F.lit(seed), F.lit(CIRCLE)) * F.lit(TURN) % F.lit(CIRCLE)
    points = spark.range(slots).select(F.col("id").alias("slot"), (turned / F.lit(float(CIRCLE)) * slots).alias("at"))
    # A point meets the spans of its cell; cells grow in number with the sources, so that few spans share one.
    grid = max(1024, CELLS * sources)
    cell = lambda x: F.floor(x / max(slots, 1) * grid).cast("long")
    cells = spans.select("*", F.explode(F.sequence(cell(F.col("from")), F.least(cell(F.col("to")), F.lit(grid)))).alias("cell"))
    hit = points.withColumn("cell", cell(F.col("at"))).join(cells, "cell").where("at >= from and at < to").select("slot", "source_place", "need")
    # Rank in two steps, so that no source is one group: before the stretch, and within it.
    hit = hit.withColumn("stretch", F.shiftright("slot", 12))
    counts = hit.groupBy("source_place", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source_place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source_place", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("source_place", "stretch").orderBy("slot")) - 1
    ranked = hit.withColumn("inner", inner).join(counts, ["source_place", "stretch"])
    ranked = stages.stage(ranked.select("slot", "source_place", (F.col("before") + F.col("inner")).alias("rank"), "need"), "slots")
    # A few slots a source: those beyond, and those that lack.
    dealt = ranked.groupBy("source_place").agg(F.count(F.lit(1)).alias("dealt"))
    lack = plan.join(dealt, "source_place", "left").withColumn("dealt", F.coalesce("dealt", F.lit(0))).where("dealt < need")
    lack = lack.select("source_place", F.explode(F.sequence("dealt", F.col("need") - 1)).alias("rank"))
    lack = lack.withColumn("k", F.row_number().over(Window.orderBy("rank", "source_place")))
    free = ranked.where("rank >= need").select("slot", F.row_number().over(Window.orderBy("slot")).alias("k"))
    lack = lack.join(free, "k", "left").select(F.coalesce("slot", F.lit(slots)).alias("slot"), "source_place", "rank")
    return ranked.where("rank < need").drop("need").unionByName(lack)


def place_documents(rows: DataFrame, seed: int = 0) -> DataFrame:
    """Adds ``first_word``: the words of the source before the document in its shuffled order.

    ``rows`` has row, key, source_place and size. The order is that of a hash of
    the key and the seed, then of ``row``.
    """
    keyed = rows.withColumn("h", F.xxhash64(F.col("key"), F.lit(seed)))
    keyed = keyed.withColumn("bucket", F.shiftrightunsigned("h", 64 - (BUCKETS.bit_length() - 1)))
    sums = keyed.groupBy("source_place", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_place", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = Window.partitionBy("source_place", "bucket").orderBy(F.shiftleft("h", BUCKETS.bit_length() - 1), "h", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(sums, ["source_place", "bucket"])
    return placed.select(*rows.columns, (F.col("before") + F.col("inner")).alias("first_word"))


def _pieces(docs: DataFrame, weights, share: float, most: float, seed: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their source's target, and the written sequence: slot, place, key, copies, each, begin and end.

    Equal rows are one place with the words of all; ``begin`` and ``end`` are among
    these, ``each`` is the size of one row.
    """
    rows = stages.texts(docs, "source").select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"), F.xxhash64("text").alias("text_hash"))
    rows = stages.stage(rows, "sizes")
    targets = stages.stage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    plan = stages.stage(block_plan(targets, block_words), "plan")
    keyed = rows.withColumn("key", F.struct("doc_id", "text_hash"))
    info = targets.withColumnRenamed("source", "named")
    joined = keyed.join(info, F.expr("source <=> named")).drop("named")
    places = joined.groupBy("key", "place", "source_size").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    places = places.select(F.col("place").alias("source_place"), F.to_json("key").alias("row"), "key", "size", "copies", "source_size")
    placed = place_documents(places, seed)
    # Written, so that no plan has all of these steps: the driver keeps every version of it that adaptive execution makes.
    placed = stages.stage(placed.where("size > 0").join(plan.select("source_place", "block_words"), "source_place"), "placed")
    # In two steps, so that no row holds the blocks of a long document or of many copies at once.
    first, last = F.floor(F.col("first_word") / F.col("block_words")), F.floor((F.col("first_word") + F.col("size") - 1) / F.col("block_words"))
    spread = placed.withColumn("last", last).withColumn("far", F.explode(F.sequence(first, F.col("last"), F.lit(STEP).cast("long"))))
    spread = spread.withColumn("block", F.explode(F.sequence(F.col("far"), F.least(F.col("far") + (STEP - 1), F.col("last")))))
    spread = spread.select(
        "source_place", "key", "first_word", "copies", (F.col("size") / F.col("copies")).cast("long").alias("each"), "block",
        F.greatest(F.col("first_word"), F.col("block") * F.col("block_words")).alias("begin"),
        F.least(F.col("first_word") + F.col("size"), (F.col("block") + 1) * F.col("block_words")).alias("end"),
    )
    slots = schedule(plan, seed).join(plan, "source_place").withColumn("block", F.col("rank") % F.col("blocks"))
    slots = slots.select("source_place", "block", "slot", F.when(F.col("rank") == F.col("need") - 1, F.col("last_end")).alias("stop"))
    # A block has as many slots as rounds, so neither side of this join is hot.
    found = spread.join(slots, ["source_place", "block"]).withColumn("end", F.least("end", "stop")).where("end > begin")
    found = found.select("slot", F.col("source_place").alias("place"), "key", "copies", "each", (F.col("begin") - F.col("first_word")).alias("begin"), (F.col("end") - F.col("first_word")).alias("end"))
    return joined, stages.stage(found, "sequence")


def sequence(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as a sequence: slot, doc_id, text_hash, source, copy, from_word, to_word of every piece.

    A piece is the words ``from_word`` up to ``to_word`` (from 0, end exclusive) of
    the ``copy``-th (from 0) of the rows that are equal in doc_id, text and source.
    Reading by slot, then by doc_id, text_hash and copy, gives the mix; all pieces
    of a slot are of one source and have at most a block's words. Texts without
    words, null ones too, have no piece; an empty table gives an empty sequence.
    """
    joined, pieces = _pieces(docs, weights, share, most, seed, block_words)
    named = joined.select("place", "source").distinct()
    copy = F.explode(F.sequence(F.floor(F.col("begin") / F.col("each")), F.floor((F.col("end") - 1) / F.col("each"))))
    out = pieces.withColumn("copy", copy).join(named, "place")
    start = F.col("copy") * F.col("each")
    return out.select(
        "slot", F.col("key")["doc_id"].alias("doc_id"), F.col("key")["text_hash"].alias("text_hash"), "source", "copy",
        (F.greatest("begin", start) - start).alias("from_word"), (F.least(F.col("end"), start + F.col("each")) - start).alias("to_word"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, source, size, source_size, target, taken, first_slot, whole, part.

    ``taken`` counts the words that the mix takes, repeats included: ``whole``
    times the document and ``part`` of its words besides, the latter above 0
    only for a document on the edge of the last round. ``first_slot`` is the slot
    in which the mix comes to the document first, null if it is not taken. Null text
    has no word and is not taken; null is a source of its own. Rows of equal doc_id
    are ordered by their text's hash; rows equal in both share one place and get one
    result each. Reruns agree. Other columns are left out.
    """
    joined, pieces = _pieces(docs, weights, share, most, seed, block_words)
    got = pieces.groupBy("place", "key").agg(F.sum(F.col("end") - F.col("begin")).alias("words_taken"), F.max("copies").alias("copies"), F.min("slot").alias("first_slot"))
    # Equal rows share what is taken: each gets the same number, the remainder falls away.
    got = got.select(F.col("place").alias("at"), F.col("key").alias("of"), F.floor(F.col("words_taken") / F.col("copies")).alias("taken"), "first_slot")
    out = joined.join(got, F.expr("key <=> of") & (joined["place"] == got["at"]), "left")
    taken = F.coalesce("taken", F.lit(0)).cast("long")
    out = out.select("doc_id", "text_hash", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", taken.alias("taken"), "first_slot")
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    return out.withColumn("whole", whole).withColumn("part", F.col("taken") - F.col("whole") * F.col("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all its columns as they are.

    A document of which the mix takes some words besides appears once more with
    its text up to the last of the words that are taken, white space as it was. A
    document without words is kept once, so that mixing never filters by content.
    """
    m_id, m_hash, m_text, m_source, m = stages.free_names(docs, "m_id", "m_hash", "m_text", "m_source", "m_mixed")
    taken = F.struct("size", "whole", "part").alias(m)
    chosen = mix(docs, **options).select(F.col("doc_id").alias(m_id), F.col("text_hash").alias(m_hash), F.col("source").alias(m_source), taken).distinct()
    keyed = docs.withColumn(m_text, F.xxhash64(F.col("text").cast("string")))
    joined = keyed.join(chosen, stages.same_row(m_id, m_hash, m_text) & F.col("source").cast("string").eqNullSafe(F.col(m_source)))
    size, whole, part = (F.col(m)[x] for x in ("size", "whole", "part"))
    copies = F.when(size == 0, F.lit(1)).otherwise(whole + (part > 0).cast("int"))
    (m_copy,) = stages.free_names(joined, "m_copy")
    copied = joined.where(copies > 0).withColumn(m_copy, F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    # After so many splits the last piece is what follows the words; white space at the start makes one piece more.
    led = F.regexp_like("text", F.lit("^[\\x20\\x09-\\x0D]")).cast("int")
    pieces = F.split("text", "[\\x20\\x09-\\x0D]+", (F.greatest(part, F.lit(1)) + 1 + led).cast("int"))
    rest = F.length(F.element_at(pieces, -1))
    cut = F.regexp_replace(F.substring(F.col("text"), F.lit(1), F.length("text") - rest), "[\\x20\\x09-\\x0D]+$", "")
    text = F.when((F.col(m_copy) > whole) & (size > 0), cut).otherwise(F.col("text"))
    return copied.withColumn("text", text).select(*stages.own_columns(docs))
