"""Operator 10: language-model scores by deleted interpolation.

The probability of a word after another is mixed from three estimates: the
pair's share of its context, the word's share of all tokens, and one share for
every known word and one more. The mixture's weights depend on how frequent the
context is; they are learned by expectation-maximisation on counts from which
the occurrence to be predicted has been taken out (deleted estimation), so every
training token is held out once.

Work goes in chunks of about ``CHUNK_BYTES`` of text. A chunk is a written row
with its distinct words and its tokens as numbers of these. Sorted words, and
later word pairs, are sent to buckets by their hash, a slice per chunk and
bucket; a bucket adds up the counts of its keys from all chunks and sends each
chunk the totals of the keys it asked for. So a word that every text has comes
to its bucket once per chunk, no vocabulary is ever in one place, and the counts
cover the whole corpus. Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks, mix, text_bytes, word_hashes

CHUNK_BYTES = 8 << 20
#: Keys of a bucket, about.
BUCKET_KEYS = 1 << 20
#: Contexts that training has less often give no pair estimate: those that it doesn't have.
LEAST_CONTEXT = 1
#: A context of count c belongs to the class of the last bound that is not above c.
CONTEXT_BOUNDS = (1, 2, 3, 4, 8, 16, 32, 64, 128, 512, 2048, 8192, 65536)
#: Steps of log2 in which estimates are counted for learning the weights.
STEPS = 4
_END, _START = np.uint64(1), np.uint64(2)
_CHUNK = "chunk long, words binary, tokens binary, n_tokens long, n_words long, doc_id array<bigint>, held_out array<boolean>, train array<boolean>, sizes array<int>"
_SLICE = "bucket long, chunk long, keys binary, counts binary, context binary, word binary"


def _squeeze(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed; sorted keys should be given as differences."""
    raw = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _expand(data: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = pa.decompress(data[8:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).reshape(-1).view(kind)


def _differences(keys: np.ndarray) -> np.ndarray:
    out = keys.copy()
    out[1:] -= keys[:-1]
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: list[list] = [[], [], [], [], []]
    size = 0

    def close() -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate(held[0]), return_inverse=True)
        row = {"chunk": number, "words": _squeeze(_differences(words)), "tokens": _squeeze(tokens.astype(np.uint32)), "n_tokens": len(tokens), "n_words": len(words)}
        row |= {"doc_id": held[1], "held_out": held[2], "train": held[3], "sizes": held[4]}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    many = lambda t: pa.list_(t)
    schema = pa.schema([("chunk", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("doc_id", many(pa.int64())), ("held_out", many(pa.bool_())), ("train", many(pa.bool_())), ("sizes", many(pa.int32()))])
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            data, offsets = text_bytes(batch.column("text").slice(a, b - a))
            found, counts = word_hashes(data, offsets)
            held[0].append(np.insert(found, np.cumsum(counts), _END))
            for k, name in ((1, "doc_id"), (2, "held_out"), (3, "train")):
                held[k] += batch.column(name).slice(a, b - a).to_pylist()
            held[4] += (counts + 1).tolist()
            size += len(data) + 8 * (b - a)
            if size >= CHUNK_BYTES:
                yield close()
                number, size, held = number + 1, 0, [[], [], [], [], []]
    if held[1]:
        yield close()


class _Chunk:
    """A chunk's row, read."""

    def __init__(self, row: dict):
        self.words = np.cumsum(_expand(row["words"], np.uint64), dtype=np.uint64)
        self.tokens = _expand(row["tokens"], np.uint32).astype(np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.train = np.repeat(np.array(row["train"], bool), self.sizes)
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True

    def pairs(self, counts: np.ndarray, n_texts: int, least: int) -> tuple[np.ndarray, ...]:
        """Context count of each token, the tokens with a context that is frequent enough, and their pair keys."""
        before = np.roll(self.tokens, 1)
        context = np.where(self.first, n_texts, counts[before]).astype(np.int64)
        some = np.flatnonzero(context >= least)
        left = np.where(self.first[some], _START, self.words[before[some]])
        key = mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(self.words[self.tokens[some]]))
        return context, some, key


def _slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The part of sorted keys for each bucket, told by the leading bits."""
    bounds = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.int64)
    edges = np.concatenate([[0], bounds, [len(keys)]])
    for b in range(1 << bits):
        if edges[b] < edges[b + 1]:
            yield b, slice(int(edges[b]), int(edges[b + 1]))


def _slice_batch(chunk: int, keys: np.ndarray, bits: int, counts: np.ndarray, context: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
    rows = [(b, chunk, _squeeze(_differences(keys[s])), _squeeze(counts[s]), _squeeze(context[s]), _squeeze(word[s])) for b, s in _slices(keys, bits)]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "chunk", "keys", "counts", "context", "word"])


def _word_slices(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                counts = np.bincount(chunk.tokens[chunk.train], minlength=len(chunk.words)).astype(np.uint32)
                none = np.zeros(len(counts), np.uint8)
                yield _slice_batch(row["chunk"], chunk.words, bits, counts, none, none)

    return run


def _log_step(x: np.ndarray) -> np.ndarray:
    """log2 in steps, plus one; 0 for 0."""
    return np.where(x > 0, np.round(STEPS * np.log2(np.maximum(x, 1))) + 1, 0).astype(np.uint8)


def _from_step(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, 2.0 ** ((x.astype(np.float64) - 1) / STEPS), 0.0)


def _pair_slices(bits: int, n_texts: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                counts = _joined(row["word_counts"])
                context, some, key = chunk.pairs(counts, n_texts, least)
                if not len(some):
                    continue
                keys, first, which = np.unique(key, return_index=True, return_inverse=True)
                own = np.bincount(which[chunk.train[some]], minlength=len(keys)).astype(np.uint32)
                at = some[first]
                yield _slice_batch(row["chunk"], keys, bits, own, _log_step(context[at]), _log_step(counts[chunk.tokens[at]]))

    return run


def _add_up(table: pa.Table, learn: bool, total: int):
    """Totals of a bucket's keys: for every chunk its own, and figures of the bucket."""
    chunks = table.column("chunk").to_pylist()
    read = lambda name, kind: [_expand(x, kind) for x in table.column(name).to_pylist()]
    keys = [np.cumsum(x, dtype=np.uint64) for x in read("keys", np.uint64)]
    sizes = [len(k) for k in keys]
    known, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(which, weights=np.concatenate(read("counts", np.uint32)), minlength=len(known)).astype(np.int64)
    figures = [(0, int((sums > 0).sum()), int(sums.sum()), 0)]
    if learn:
        context, word = np.zeros(len(known), np.uint8), np.zeros(len(known), np.uint8)
        context[which], word[which] = np.concatenate(read("context", np.uint8)), np.concatenate(read("word", np.uint8))
        seen = sums > 0
        figures = _deleted(sums[seen], _from_step(context[seen]), _from_step(word[seen]), total)
    ends = np.cumsum(sizes)
    totals = sums[which].astype(np.uint64)  # a corpus may have more than 2^32 of a word
    rows = [(c, _squeeze(totals[e - s : e])) for c, s, e in zip(chunks, sizes, ends.tolist())]
    n, m = len(rows), len(figures)
    bucket = table.column("bucket")[0].as_py()
    return pa.table({
        "chunk": pa.array([c for c, _ in rows] + [None] * m, pa.int64()),
        "bucket": pa.array([bucket] * (n + m), pa.int64()),
        "totals": pa.array([t for _, t in rows] + [None] * m, pa.binary()),
        **{name: pa.array([None] * n + [f[i] for f in figures], pa.int64()) for i, name in enumerate(("class", "x", "y", "weight"))},
    })


_TOTALS = "chunk long, bucket long, totals binary, class long, x long, y long, weight long"


def _deleted(count: np.ndarray, context: np.ndarray, word: np.ndarray, total: int) -> list[tuple[int, int, int, int]]:
    """How many training tokens have which pair and word estimate, in steps, once they themselves are left out.

    Their class is that of the context's count without them, as a held-out text
    finds it; so contexts seen twice teach the weight of contexts seen once.
    """
    pair = np.where(count > 1, (count - 1) / np.maximum(context - 1, 1), 0.0)
    single = np.where(word > 1, (word - 1) / max(total - 1, 1), 0.0)
    step = lambda p: np.where(p > 0, np.round(STEPS * np.log2(np.maximum(p, 1e-30))), 1_000).astype(np.int64)
    kind = np.searchsorted(CONTEXT_BOUNDS, np.round(context) - 1, "right")
    rows, which = np.unique(np.stack([kind, np.minimum(step(pair), 1_000), step(single)]), axis=1, return_inverse=True)
    weight = np.bincount(which.ravel(), weights=count)
    return [(int(a), int(b), int(c), int(w)) for (a, b, c), w in zip(rows.T, weight)]


def _joined(parts: list[dict] | None) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[_expand(p["totals"], np.uint64) for p in parts or []]])


def learn_weights(pair: np.ndarray, single: np.ndarray, flat: float, weight: np.ndarray, turns: int = 200) -> tuple[float, float, float]:
    """Weights of the three estimates that make the held-out tokens likeliest, by expectation-maximisation."""
    mixture = np.array([0.4, 0.5, 0.1]) if (pair > 0).any() else np.array([0.0, 0.9, 0.1])
    estimates = np.stack([pair, single, np.full(len(pair), flat)])
    for _ in range(turns):
        parts = estimates * mixture[:, None]
        share = (parts / parts.sum(0)) @ weight
        new = share / share.sum()
        if np.abs(new - mixture).max() < 1e-9:
            break
        mixture = new
    # The last share stays above 0: no text has probability 0.
    mixture = np.maximum(mixture, [0.0, 0.0, 1e-6])
    return tuple((mixture / mixture.sum()).tolist())


@dataclass(frozen=True)
class Model:
    """Counts over the training texts, and the mixture of each class of contexts; class 0 is that of contexts not seen."""

    n_tokens: int
    n_known: int
    n_texts: int
    mixtures: tuple[tuple[float, float, float], ...]

    @property
    def flat(self) -> float:
        return 1.0 / (self.n_known + 1)


def mixtures(rows: list, total: int, known: int) -> tuple[tuple[float, float, float], ...]:
    """A mixture for each class of contexts from rows of (class, x, y, weight)."""
    flat = 1.0 / (known + 1)
    if not rows:
        return ((0.0, 0.9, 0.1),) * (len(CONTEXT_BOUNDS) + 1)
    kind, x, y, weight = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    read = lambda s: np.where(s == 1_000, 0.0, 2.0 ** (np.minimum(s, 0) / STEPS))
    pair, single = read(x), read(y)
    out = [learn_weights(np.zeros(len(pair)), single, flat, weight)]
    for k in range(1, len(CONTEXT_BOUNDS) + 1):
        mine = kind == k
        out.append(learn_weights(pair[mine], single[mine], flat, weight[mine]) if mine.any() else out[-1])
    return tuple(out)


def _score(model: Model, least: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(model.mixtures)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                counts = _joined(row["word_counts"]).astype(np.float64)
                context, some, key = chunk.pairs(counts, model.n_texts, least)
                count = counts[chunk.tokens]
                pair = np.zeros(len(count))
                if len(some):
                    _, which = np.unique(key, return_inverse=True)
                    pair[some] = _joined(row["pair_counts"])[which] / context[some]
                kind = np.where(context >= least, np.searchsorted(CONTEXT_BOUNDS, context, "right"), 0)
                mixture = table[kind]
                p = mixture[:, 0] * pair + mixture[:, 1] * (count / max(model.n_tokens, 1)) + mixture[:, 2] * model.flat
                doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
                add = lambda x: np.bincount(doc, weights=x, minlength=len(chunk.sizes))
                base = np.log10((count + 0.5) / (model.n_tokens + 0.5 * (model.n_known + 1)))
                columns = [pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(chunk.sizes), pa.array(add(count > 0).astype(np.int64)), pa.array(add(base)), pa.array(add(np.log10(p)))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _bits(keys: int) -> int:
    return max(0, int(-(-keys // BUCKET_KEYS) - 1).bit_length())


def score_texts(docs: DataFrame, least_context: int = LEAST_CONTEXT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Tokens are words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case, and one end.
    Rows whose crc32(doc_id) mod 5 is 1 are held out; a null doc_id is neither
    held out nor learned from. Null text has the end alone. Repeated rows are
    learned from and scored each. Without a training row every token is unknown.
    Other columns are left out.
    """
    spark = docs.sparkSession
    stages.small_batches(spark)
    held = stages.crc_mod("doc_id", 5) == 1
    rows = stages.texts(docs).select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"), F.coalesce(~held, F.lit(False)).alias("train"))
    chunks = stages.stage(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    n_texts = rows.where("train").count()
    tokens, words = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    # A chunk is a large row: few to a batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")

    def totals(slices: DataFrame, learn: bool, total: int, name: str) -> tuple[DataFrame, DataFrame]:
        added = stages.stage(slices.groupBy("bucket").applyInArrow(lambda table: _add_up(table, learn, total), _TOTALS), name)
        per_chunk = added.where("chunk is not null").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "totals"))).alias(name))
        return per_chunk, added.where("chunk is null")

    word_counts, figures = totals(chunks.mapInArrow(_word_slices(_bits(words)), _SLICE), False, 0, "word_counts")
    known, total = figures.agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    counted = chunks.join(word_counts, "chunk")
    pair_counts, figures = totals(counted.mapInArrow(_pair_slices(_bits(tokens), n_texts, least_context), _SLICE), True, total, "pair_counts")
    learned = figures.groupBy("class", "x", "y").agg(F.sum("weight").alias("w")).collect()
    model = Model(total, known, n_texts, mixtures(learned, total, known))
    scored = counted.join(pair_counts, "chunk", "left").mapInArrow(_score(model, least_context), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
