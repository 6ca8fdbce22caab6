"""Operator 5: toxicity by Levenshtein automata over a lexicon trie, with context windows.

Lexicon. Words and word beginnings that toxic training texts have far more often
than others are counted in two steps on a bounded sample of labelled rows. They
make a trie.

Matching. The Levenshtein automaton of a word for one edit is intersected with
the trie by stepping sets of (trie node, edits) over the word's characters.
Reached sets are states of a deterministic automaton that is built as words are
read; most words reach the empty state after a few characters. A beginning
accepts every word that starts with it, within the allowed edit. Misspelled
forms that clean training texts have are known words and don't count.

Context. A match counts less within quotation marks or next to words of
reporting, and in full when it addresses somebody or stands near other matches.

Score. A logistic regression on the counts; an empty text gets the score of no
match.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks

#: About so many labelled rows are learned from, chosen by a hash of doc_id.
SAMPLE = 20_000
#: Evidence (in nats) that an entry of the lexicon needs.
EVIDENCE = 14.0
STEMS = range(4, 9)
#: Different contexts in toxic texts that an entry needs, however many texts are learned from.
LEAST_CONTEXTS = 5
#: Entries of at least so many characters match within one edit.
FUZZY_LENGTH = 5
WINDOW = 6
KNOWN_WORDS = 400_000

#: White space between words, as the lexicon's words are counted too.
SPACE = re.compile(r"[\x20\x09-\x0D]+")
#: Without a lexicon nothing speaks against a text: its score stays below this.
NO_EVIDENCE = 0.49
PUNCTUATION = ".,;:!?\"'()[]{}<>#$%&*|«»“”„‘’…"
OPENING, CLOSING = "\"'«“„‘", "\"'»”“’"
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes term word words dit disait écrit mot sagte schrieb nannte wort dijo escribió llamó palabra".split())
ADDRESSING = frozenset("you your you're u ur tu toi vous votre du dich dein ihr euch tú te usted vosotros".split())


class Trie:
    """Lexicon entries; an entry is a word, or a beginning if it ends in ``*``."""

    def __init__(self, entries: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.depth = [-1], [-1], [0]
        for number, entry in enumerate(entries):
            node = 0
            for char in entry.removesuffix("*"):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][char]
            (self.stem if entry.endswith("*") else self.word)[node] = number


class Automaton:
    """The Levenshtein automaton of one edit, intersected with a trie; its states are made on demand."""

    def __init__(self, entries: list[str]):
        self.trie = Trie(entries)
        self.clear()

    def clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        #: What a state accepts: of any word that reaches it, and of a word that ends there, as (edits, entry).
        self.through: list[tuple[int, int] | None] = []
        self.at_end: list[tuple[int, int] | None] = []
        self.start = self._state(self._skip({(0, 0)}))

    def _skip(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Adds states in which one character of the lexicon was left out of the word."""
        out = set(pairs)
        for node, edits in pairs:
            if edits == 0:
                out.update((child, 1) for child in self.trie.children[node].values() if (child, 0) not in pairs)
        return frozenset(out)

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.number:
            self.number[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.steps.append({})
            found = {"word": [], "stem": []}
            for node, edits in pairs:
                if edits == 0 or self.trie.depth[node] >= FUZZY_LENGTH:
                    for kind in found:
                        if (entry := getattr(self.trie, kind)[node]) >= 0:
                            found[kind].append((edits, entry))
            self.through.append(min(found["stem"], default=None))
            self.at_end.append(min(found["word"] + found["stem"], default=None))
        return self.number[pairs]

    def _step(self, state: int, char: str) -> int:
        out = set()
        for node, edits in self.sets[state]:
            children = self.trie.children[node]
            if char in children:
                out.add((children[char], edits))
            if edits == 0:
                out.add((node, 1))
                out.update((child, 1) for child in children.values())
        out = {(n, e) for n, e in out if e == 0 or (n, 0) not in out}
        self.steps[state][char] = to = self._state(self._skip(out))
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the best match of a word, or None."""
        if len(self.sets) > 200_000:
            self.clear()
        state, best = self.start, None
        for char in word:
            to = self.steps[state].get(char)
            state = self._step(state, char) if to is None else to
            if not self.sets[state]:
                return best
            if (found := self.through[state]) is not None and (best is None or found < best):
                best = found
        found = self.at_end[state]
        return found if best is None or (found is not None and found < best) else best


@dataclass
class Matcher:
    """Finds and weighs the matches of texts."""

    entries: list[str]
    #: Misspelled forms that are known words.
    known: frozenset[str] = frozenset()
    automaton: Automaton = field(init=False)
    seen: dict[str, tuple[int, int] | None] = field(init=False, default_factory=dict)

    def __post_init__(self):
        self.automaton = Automaton(self.entries)

    def look_up(self, token: str) -> tuple[int, int] | None:
        word = token.strip(PUNCTUATION)
        found = self.automaton.match(word) if word else None
        return None if found is not None and found[0] and word in self.known else found

    def matches(self, text: str) -> tuple[list[str], list[tuple[int, int, int]]]:
        """The lower-case tokens of a text, and (place, edits, entry) of each match."""
        tokens = [t for t in SPACE.split(text.lower()) if t]
        distinct = set(tokens)
        seen = self.seen
        for token in distinct:
            if token not in seen:
                if len(seen) > KNOWN_WORDS:
                    seen.clear()
                seen[token] = self.look_up(token)
        hits = {t: found for t in distinct if (found := seen[t] if t in seen else self.look_up(t)) is not None}
        return tokens, [(i, *hits[t]) for i, t in enumerate(tokens) if t in hits] if hits else []


def context_weights(tokens: list[str], places: list[int]) -> list[float]:
    """For each match, 1 for abuse down to 0.2 for a quotation, from the words around it."""
    out = []
    at = set(places)
    for i in places:
        before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
        own = tokens[i]
        opened = own[0] in OPENING or any(t[0] in OPENING for t in before)
        closed = own[-1] in CLOSING or own.rstrip(".,;:!?")[-1:] in tuple(CLOSING) or any(t[-1] in CLOSING or t.rstrip(".,;:!?")[-1:] in tuple(CLOSING) for t in after)
        around = {t.strip(PUNCTUATION) for t in before + after}
        weight = 1.0 - 0.5 * (opened and closed) - 0.3 * bool(around & REPORTING)
        if around & ADDRESSING or any(j != i and j in at for j in range(i - WINDOW, i + WINDOW + 1)):
            weight += 0.3
        out.append(min(1.0, max(0.2, weight)))
    return out


def features(matcher: Matcher, text: str) -> list[float]:
    """What the score is made from: exact and misspelled matches, in all and for each hundred words."""
    tokens, found = matcher.matches(text)
    if not found:
        return [0.0, 0.0, 0.0, 0.0]
    weights = context_weights(tokens, [i for i, _, _ in found])
    exact = sum(w for w, (_, edits, _) in zip(weights, found) if not edits)
    near = sum(w for w, (_, edits, _) in zip(weights, found) if edits)
    share = 100.0 / max(len(tokens), 20)
    return [float(np.log1p(exact)), min(exact * share, 5.0), float(np.log1p(near)), min(near * share, 5.0)]


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, turns: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the last of which is the constant, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class Model:
    entries: tuple[str, ...]
    known: frozenset[str]
    weights: tuple[float, ...]


def _evidence(a, b, p):
    """Nats by which a term's share of toxic texts speaks against the share among all; 0 if it is below that."""
    n = a + b
    rate = a / n
    gain = a * F.log(rate / p) + F.when(b > 0, b * F.log((b / n) / (1 - p))).otherwise(0.0)
    return F.when(rate > p, gain).otherwise(0.0)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic of about ``sample`` labelled rows whose crc32(doc_id) mod 5 is not 0."""
    marks = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic")).where("of is not null and toxic is not null")
    marks = marks.where(stages.crc_mod("of", 5) != 0).groupBy("of").agg(F.max("toxic").alias("toxic"))
    total = marks.count()
    chosen = marks.where(F.pmod(F.xxhash64("of", F.lit(7)), F.lit(1 << 20)) < (1 << 20) * min(1.0, sample / max(total, 1)))
    rows = stages.texts(docs)
    return rows.join(chosen, rows["doc_id"] == chosen["of"]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn lexicon and weights. What the driver gets is bounded by ``sample``: entries, and one row of figures a text.

    All terms with enough evidence are candidates, of any length from 3
    characters on. Without toxic or without clean rows, or where no term has the
    evidence, the lexicon is empty and the score of every text is the share of
    toxic rows (0 without any row), but below 0.5: nothing is called toxic
    without a match.
    """
    spark = docs.sparkSession
    rows = stages.stage(training_rows(docs, labels, sample), "labelled")
    n_toxic, n = rows.agg(F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    if n_toxic in (0, n):
        return _without_lexicon(n_toxic / n if n else 0.0)
    p = n_toxic / n
    bare = F.transform(F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+"), lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    words = rows.select((F.col("toxic") > 0).cast("long").alias("t"), F.explode(F.array_distinct(bare)).alias("w")).where(F.length("w") >= 3)
    counts = stages.stage(words.groupBy("w").agg(F.sum("t").alias("a"), F.sum(1 - F.col("t")).alias("b")), "word-counts")
    # A beginning's counts are sums over its words here; matching counts them by text below.
    stems = F.array(*[F.when(F.length("w") > k, F.concat(F.substring("w", 1, k), F.lit("*"))) for k in STEMS])
    terms = counts.select(F.col("w").alias("term"), "a", "b").unionByName(
        counts.select(F.explode(F.array_compact(stems)).alias("term"), "a", "b").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    scored = terms.where("a >= 3").withColumn("e", _evidence(F.col("a"), F.col("b"), p)).where(F.col("e") >= EVIDENCE)
    loose = [r.term for r in scored.orderBy(F.desc("e"), "term").collect()]

    # Second step: by the words on both sides. Copies of a text and repeated lines give one context, an insult in many texts gives many.
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = {e: i for i, e in enumerate(loose)}
        for batch in batches:
            found: set[tuple[int, int, int]] = set()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                tokens = ["", *(t.strip(PUNCTUATION) for t in SPACE.split(text.lower()) if t), ""]
                for at, word in enumerate(tokens[1:-1], 1):
                    for e in (word, *(word[:k] + "*" for k in STEMS)):
                        if (i := exact.get(e)) is not None:
                            context = zlib.crc32(f"{tokens[at - 1]} {tokens[at + 1]}".encode())
                            found.add((i, context, int(label > 0)))
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["entry", "context", "t"])

    stages.small_batches(spark)
    contexts = rows.select("text", "toxic").mapInArrow(count, "entry long, context long, t long").distinct()
    contexts = contexts.groupBy("entry").agg(F.sum("t").alias("a"), F.sum(1 - F.col("t")).alias("b"))
    firm = contexts.withColumn("e", _evidence(F.col("a"), F.col("b"), p)).where((F.col("e") >= EVIDENCE) & (F.col("a") >= LEAST_CONTEXTS) & (F.col("a") >= 5 * p / (1 - p) * F.col("b"))).collect()
    # Shorter beginnings say what longer ones say; of equal evidence the more special entry is kept.
    chosen: list[str] = []
    texts_of = {loose[r.entry]: (r.a, r.b) for r in firm}
    for entry in sorted(texts_of, key=lambda e: (len(e.removesuffix("*")), e.endswith("*"), e)):
        inside = [e for e in texts_of if e != entry and entry.endswith("*") and e.startswith(entry[:-1])]
        if any(c.endswith("*") and entry.startswith(c[:-1]) for c in chosen):
            continue
        if any(texts_of[e][0] >= 0.98 * texts_of[entry][0] and texts_of[e][1] <= texts_of[entry][1] for e in inside):
            continue  # one longer entry has all that this has
        chosen.append(entry)

    if not chosen:
        return _without_lexicon(p)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(chosen)
        for batch in batches:
            words = [w for w in batch.column("w").to_pylist() if (f := matcher.look_up(w)) is not None and f[0]]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["w"])

    # A form that one clean text has may be a slip; forms of two are words. So the training rows show how often unknown forms are harmless.
    known = frozenset(r.w for r in counts.where("b >= 2").select("w").mapInArrow(near, "w string").collect())
    table = rows.select("text", "toxic").mapInArrow(_feature_rows(tuple(chosen), known), "x array<double>, toxic int").collect()
    x, y = np.array([r.x for r in table]), np.array([float(r.toxic > 0) for r in table])
    return Model(tuple(chosen), known, tuple(logistic_fit(x, y).tolist()))


def _without_lexicon(share: float) -> Model:
    share = min(max(share, 1e-3), NO_EVIDENCE)
    return Model((), frozenset(), (0.0, 0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))


def _feature_rows(entries: tuple[str, ...], known: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(entries), known)
        for batch in batches:
            x = [features(matcher, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_hash, score (0 to 1) and predicted (1 from 0.5 on) of every row; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(list(model.entries), model.known)
        weights = np.array(model.weights)
        for batch in batches:
            for a, b in blocks(batch.column("text"), 4 << 20):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                x = np.array([[*features(matcher, t or ""), 1.0] for t in texts])
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "text_hash", "score", "predicted"],
                )

    stages.small_batches(docs.sparkSession)
    rows = stages.texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    ``held_out`` rows (crc32 of doc_id mod 5 is 0) are never learned from; a
    null doc_id is neither held out nor learned from. Repeated rows get equal
    results. Labels of unknown documents, null labels and further columns of
    either table are left out.
    """
    found = score(docs, fit(docs, labels, sample))
    return found.select("doc_id", F.coalesce(stages.crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, all columns as they are."""
    model = fit(docs, labels, sample)
    x_id, x_hash, x_text = stages.free_names(docs, "x_id", "x_hash", "x_text")
    found = score(docs, model).where("predicted = 1").select(F.col("doc_id").alias(x_id), F.col("text_hash").alias(x_hash)).distinct()
    keyed = docs.withColumn(x_text, F.xxhash64(F.col("text").cast("string")))
    return keyed.join(found, stages.same_row(x_id, x_hash, x_text), "left_anti").select(*stages.own_columns(docs))
