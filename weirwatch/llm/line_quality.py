"""Operator 3: quality rules with cross-document line frequency.

Lines are normalised (ASCII lower case, runs of digits as one 0, runs of white
space as one space, trimmed) and hashed. A line's frequency is the number of
different texts of a host that have it; a document's host is its source, and
exact copies of a text count once, so that copying a page doesn't make its lines
boilerplate. Lines above the limit are removed from the text, the others stay as
they are and in order; a document that loses more than
``DEPLETED`` of its words to this is rejected, and so is one that fails the
base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages

#: A line is boilerplate in a host if more texts than both of these have it: a number, and a share of the host's texts.
LIMIT = 10
LIMIT_SHARE = 0.001
#: A document of which more than this share of words lies in removed lines is rejected.
DEPLETED = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
_WHITE = "\t\n\x0b\f\r"


def _spaces(text: Column) -> Column:
    """All white space as spaces. ``replace`` looks for bytes and is many times faster than ``translate``."""
    for char in _WHITE:
        text = F.replace(text, F.lit(char), F.lit(" "))
    return text


def _without(text: Column, char: str) -> Column:
    return F.replace(text, F.lit(char), F.lit(""))


def words(spaced: Column) -> Column:
    """The words of a text with spaces as its only white space, in order."""
    return F.array_remove(F.split(spaced, " "), "")


def _repeat_words(hashes: Column) -> Column:
    """How many words lie in windows whose hash is found twice or more; ``hashes`` has a hash per 3-word window.

    Hashes are sorted as numbers first. Only a text with an equal pair sorts
    (hash, place) pairs, takes places next to an equal hash, and counts the
    words that these windows cover.
    """
    neighbours = lambda a: F.arrays_zip(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    equal = F.filter(neighbours(placed), lambda p: p["0"]["h"] == p["1"]["h"])
    places = F.array_distinct(F.flatten(F.transform(equal, lambda p: F.array(p["0"]["i"], p["1"]["i"]))))
    covered = F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2))))
    return F.when(repeated, F.size(covered)).otherwise(F.lit(0)).cast("long")


def base_measures(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; text must be there and not null."""
    text = F.col("text")
    # Each step is a projection of its own: the arrays are made once.
    step = docs.select("*", _spaces(text).alias("spaced_"), F.split(text, "\n").alias("lines_"))
    blank = F.filter("lines_", lambda x: F.ltrim(x, F.lit(" " + _WHITE)) == "")
    step = step.select("*", words(F.col("spaced_")).alias("words_"), blank.alias("blank_"))
    n = F.size("words_")
    triples = F.arrays_zip(
        F.slice("words_", 1, F.greatest(n - 2, F.lit(0))), F.slice("words_", 2, F.greatest(n - 2, F.lit(0))), F.slice("words_", 3, F.greatest(n - 2, F.lit(0)))
    )
    step = step.select("*", F.transform(triples, lambda t: F.xxhash64(t["0"], t["1"], t["2"])).alias("windows_"))
    repeats = lambda a: F.size(a) - F.size(F.array_distinct(a))
    white = F.octet_length("spaced_") - F.octet_length(_without(F.col("spaced_"), " "))
    symbols = sum((F.octet_length(text) - F.octet_length(_without(text, c)) for c in SYMBOLS), F.lit(0))
    return step.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        (F.length(text) - white).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (repeats(F.col("lines_")) - repeats(F.col("blank_"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("windows_")).alias("n_repeat_words"),
    )


def _text_id(text: str = "text") -> Column:
    return F.xxhash64(F.xxhash64(text), F.md5(text))


def _untrimmed_lines(text: str = "text") -> Column:
    """The lines of a text, normalised but for white space at their ends; as many as ``split`` by newlines gives."""
    rest = F.lower(text)
    for char in _WHITE.replace("\n", ""):
        rest = F.replace(rest, F.lit(char), F.lit(" "))
    rest = F.when(F.contains(rest, F.lit("  ")), F.regexp_replace(rest, " +", " ")).otherwise(rest)
    return F.split(F.regexp_replace(rest, "[0-9]+", "0"), "\n")


def document_lines(docs: DataFrame) -> DataFrame:
    """host, text_id, line (hashes) and n, the line's words, of every line with a word, from (host, text)."""
    rows = docs.select("host", _text_id().alias("text_id"), _untrimmed_lines().alias("all"))
    rows = rows.select("host", "text_id", F.explode("all").alias("raw")).select("host", "text_id", F.trim("raw").alias("line")).where("line <> ''")
    n_words = F.octet_length("line") - F.octet_length(_without(F.col("line"), " ")) + 1
    return rows.select("host", "text_id", F.xxhash64("line").alias("line"), n_words.cast("long").alias("n"))


def boilerplate_words(docs: DataFrame, limit: int = LIMIT, share: float = LIMIT_SHARE) -> DataFrame:
    """host, text_id, boilerplate (line hashes) and removed (their words) of every text that has such a line; from (host, text).

    Every line counts with the texts of its own host alone.
    """
    lines = document_lines(docs).groupBy("host", "line", "text_id").agg(F.sum("n").alias("n"))
    lines = stages.stage(lines, "lines")
    size = lines.select("host", "text_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts")).withColumnRenamed("host", "h")
    frequent = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts_with")).where(F.col("texts_with") > limit)
    frequent = frequent.join(size, F.expr("host <=> h")).where(F.col("texts_with") > share * F.col("texts"))
    frequent = frequent.select(F.col("host").alias("fh"), F.col("line").alias("fl"))
    hit = lines.join(frequent, F.expr("line = fl and host <=> fh"), "left_semi")
    found = hit.groupBy("host", "text_id").agg(F.collect_list("line").alias("boilerplate"), F.sum("n").alias("removed"))
    # Words were added up over all copies of a text, which have the same lines.
    copies = docs.select(F.col("host").alias("ch"), _text_id().alias("ct")).groupBy("ch", "ct").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    found = found.join(copies, F.expr("text_id = ct and host <=> ch"), "left")
    return found.select("host", "text_id", "boilerplate", F.expr("removed div coalesce(copies, 1)").alias("removed"))


def _cleaned(text: str, boilerplate: str) -> Column:
    """A text without the lines of the given hashes; a text without such a line is as it was."""
    hashes = F.transform(_untrimmed_lines(text), lambda x: F.xxhash64(F.trim(x)))
    marked = F.arrays_zip(F.split(text, "\n").alias("raw"), F.transform(hashes, lambda h: F.array_contains(boilerplate, h)).alias("out"))
    rest = F.array_join(F.transform(F.filter(marked, lambda x: ~x["out"]), lambda x: x["raw"]), "\n")
    return F.when(F.col(boilerplate).isNull(), F.col(text)).otherwise(rest)


def cleaned_documents(docs: DataFrame, limit: int = LIMIT, share: float = LIMIT_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """doc_id, cleaned text, the base measures of the raw text, n_removed_words, base_failed and kept of every row of ``docs``.

    ``text`` has no boilerplate line any more, also where ``kept`` is false; all
    other lines, blank ones too, are as they were. Null text is empty and has no
    word. A text without words fails. Null is a host of its own. Repeated rows
    get equal results. Other columns are left out.
    """
    rows = stages.texts(docs, "source").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("source").cast("string").alias("host"))
    measured = base_measures(rows.withColumn("t", _text_id()))
    removed = boilerplate_words(rows, limit, share).select(F.col("host").alias("rh"), F.col("text_id").alias("rt"), "boilerplate", "removed")
    out = measured.join(removed, F.expr("t = rt and host <=> rh"), "left").withColumn("n_removed_words", F.coalesce("removed", F.lit(0)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("n_removed_words") <= depleted * F.col("n_words"))
    return out.select("doc_id", _cleaned("text", "boilerplate").alias("text"), *MEASURES[:-2], kept.alias("kept"), "n_removed_words")


def quality(docs: DataFrame, limit: int = LIMIT, share: float = LIMIT_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """``cleaned_documents`` without the texts, which then aren't made."""
    return cleaned_documents(docs, limit, share, depleted).select("doc_id", *MEASURES)
