"""Operator 12: byte-level BPE as a lazily determinised transducer, and streaming decoding.

Merging by rank decides a piece's tokens only at its end, but two facts make it
a left-to-right machine. A row of tokens is an encoding exactly if each two
neighbours stay apart when merged alone; so each prefix has one last token, and
its tokens are those of the prefix before it, then that token. And a token
that may still grow starts where a vocabulary entry goes on, which reaches back
no further than the longest entry.

A state holds the bytes that are not settled yet, the token before them, and
for each place where a growing token may start the tokens up to there. Reading
a byte finds the new prefix's last token; whatever all live places then share
is settled and leaves as output. Lookahead is thus bounded by the vocabulary.
States and arcs are made when a text first needs them, at most ``most`` of
them, then the machine starts anew: memory is bounded and results do not change.

Decoding joins the tokens' bytes and hands on whole characters only. An UTF-8
automaton, composed per token beforehand, tells where a character is cut.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weirwatch.llm import stages

CHUNK = 1 << 16
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """What the rank table says about tokens: which exist, which may grow, which may be neighbours."""

    def __init__(self, ranks: dict[bytes, int], most: int = 1_000_000):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the single bytes {missing}")
        self.ranks, self.most = ranks, most
        #: What a token may still grow from.
        self.growing = {token[:n] for token in ranks for n in range(len(token))}
        #: Tokens that merging their bytes gives; others are reached as whole pieces only.
        self.usable = {token: rank for token, rank in ranks.items() if len(self.merged(token)) == 1}
        self._apart: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging: the lowest rank first, the leftmost of equal ones. Only for short byte strings."""
        rank, never = self.ranks.get, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], never) for i in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == never:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], never)
        return parts

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stay two when their bytes are merged alone; any token may come first."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) >= self.most:
                self._apart.clear()
            known = self._apart[left, right] = not left or self.merged(left + right) == [left, right]
        return known


class Transducer:
    """The machine of one rank table; states are numbers, 0 the start.

    A state is the token before the open bytes, these bytes, and its live
    places in ascending order: where a token may start that is still growing,
    the last token before, and the ids from the open bytes' begin up to there.
    The last place is the end of what was read.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = 200_000):
        self.merges, self.most = Merges(ranks), most
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes = [bytes((b,)) for b in range(256)]
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        self.states: list[tuple[bytes, bytes, list[tuple[int, bytes, tuple[int, ...]]]]] = []
        self.arcs: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self._number(b"", b"", [(0, b"", ())])

    def _number(self, before: bytes, text: bytes, live: list) -> int:
        """The state's number. ``before`` matters only while a token may still start right after it."""
        key = (b"" if live[0][0] else before, text)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append((before, text, live))
            self.arcs.append({})
        return number

    def _end(self, places: list, text: bytes) -> tuple[int, bytes, tuple[int, ...]]:
        """The place after the open bytes: exactly one last token fits, the longest is looked at first."""
        ranks, known = self.merges.usable, self.merges._apart
        for start, last, chain in places:
            token = text[start:]
            rank = ranks.get(token)
            if rank is not None:
                apart = known.get((last, token))
                if apart or (apart is None and self.merges.apart(last, token)):
                    return len(text), token, (*chain, rank)
        raise AssertionError("single bytes are tokens, so some token fits")

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the arc of a byte: the state it leads to and the ids that are settled by it."""
        before, text, places = self.states[state]
        text += self.bytes[byte]
        growing = self.merges.growing
        live = [place for place in places if text[place[0] :] in growing]
        live.append(self._end(places, text))
        out = live[0][2]
        if out and len(live) > 1:
            settled = 0
            for ids in zip(*[place[2] for place in live]):
                if ids.count(ids[0]) < len(ids):
                    break
                settled += 1
            out = out[:settled]
        if out:
            cut, before = sum([len(self.tokens[i]) for i in out]), self.tokens[out[-1]]
            text = text[cut:]
            live = [(start - cut, last, chain[len(out) :]) for start, last, chain in live]
        arcs = self.arcs[state]
        if len(self.states) >= self.most:
            self._restart()  # the arc below then lies in a list that nothing reads any more
        arcs[byte] = arc = self._number(before, text, live), out
        return arc

    def feed(self, state: int, data: bytes, out: list[int]) -> int:
        """Read bytes from a state on, append the ids that are settled, and return the new state."""
        arcs = self.arcs
        for byte in data:
            try:
                state, ids = arcs[state][byte]
            except KeyError:
                state, ids = self._arc(state, byte)
                arcs = self.arcs
            if ids:
                out += ids
        return state

    def encode_piece(self, data: bytes) -> list[int]:
        """The ids of one piece. A piece that is a token is that token, as in the libraries of rank files."""
        whole = self.merges.ranks.get(data)
        if whole is not None:
            return [whole]
        out: list[int] = []
        if not data:
            return out
        state = self.feed(0, data[:-1], out)
        arc = self.arcs[state].get(data[-1])
        if arc is None:  # the last byte needs no state to go on from
            _, text, places = self.states[state]
            out.extend(self._end(places, text + data[-1:])[2])
        else:
            out.extend(arc[1])
            out.extend(self.states[arc[0]][2][-1][2])
        return out


class _Pieces(dict):
    """Pieces and their ids; a piece that is missing goes through the transducer."""

    def __init__(self, transducer: Transducer, most: int):
        self.transducer, self.most = transducer, most

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= self.most:
            self.clear()
        ids = self[piece] = self.transducer.encode_piece(piece.encode())
        return ids


class Encoder:
    """Texts to ids: the split pattern's matches, each through the transducer; repeated pieces once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 400_000):
        import regex

        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.known = _Pieces(self.transducer, most)

    def __call__(self, text: str | None) -> list[int]:
        """The ids of a whole text; null is empty."""
        return list(itertools.chain.from_iterable(map(self.known.__getitem__, self.split(text or ""))))


#: States of the UTF-8 automaton: between characters, 1 to 3 bytes due, then after the lead
#: bytes E0, ED, F0, F4, whose next byte is limited, and broken.
_CLEAR, _E0, _ED, _F0, _F4, _BROKEN = 0, 4, 5, 6, 7, 8


def _utf8_steps() -> np.ndarray:
    """The state after each byte, by state and byte."""
    steps = np.full((9, 256), _BROKEN, np.uint8)
    steps[_CLEAR, :0x80] = _CLEAR
    for first, last, state in ((0xC2, 0xDF, 1), (0xE0, 0xE0, _E0), (0xE1, 0xEF, 2), (0xED, 0xED, _ED), (0xF0, 0xF0, _F0), (0xF1, 0xF3, 3), (0xF4, 0xF4, _F4)):
        steps[_CLEAR, first : last + 1] = state
    for state, first, last, after in ((1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (_E0, 0xA0, 0xBF, 1), (_ED, 0x80, 0x9F, 1), (_F0, 0x90, 0xBF, 2), (_F4, 0x80, 0x8F, 2)):
        steps[state, first : last + 1] = after
    return steps


class Vocabulary:
    """The bytes of each id, and the UTF-8 automaton's step over a whole token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        steps = _utf8_steps()
        ids = np.array(sorted(self.tokens), np.int64)
        self.steps = np.full((9, int(ids.max()) + 1), _BROKEN, np.uint8)
        for state in range(9):
            after = np.full(len(ids), state, np.uint8)
            rows, column = np.arange(len(ids)), 0
            sizes = np.array([len(self.tokens[i]) for i in ids])
            while len(rows := rows[sizes[rows] > column]):
                byte = np.fromiter((self.tokens[ids[r]][column] for r in rows), np.int64, len(rows))
                after[rows] = steps[after[rows], byte]
                column += 1
            self.steps[state, ids] = after
        #: Ids that do not lead from one end of a character to another.
        self.cutting = frozenset(np.flatnonzero(self.steps[_CLEAR] != _CLEAR).tolist())


class StreamDecoder:
    """Ids to bytes, chunk by chunk; what comes out ends at the end of a character."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.state, self.held = vocabulary, _CLEAR, b""

    def feed(self, ids: list[int]) -> bytes:
        """The bytes of all characters that are complete; an impossible sequence raises ValueError."""
        data = self.held + b"".join(map(self.vocabulary.tokens.__getitem__, ids))
        state = self.state
        if state != _CLEAR or not self.vocabulary.cutting.isdisjoint(ids):
            for i in ids:
                state = self.vocabulary.steps.item(state, i)
            if state == _BROKEN:
                raise ValueError("the ids do not spell UTF-8")
        keep = len(data)
        if state != _CLEAR:  # the begun character starts at the last lead byte
            keep = max(i for i in range(max(len(data) - 3, 0), len(data)) if data[i] >= 0xC0)
        self.state, self.held = state, data[keep:]
        return data[:keep]

    def close(self) -> None:
        if self.state != _CLEAR:
            raise ValueError("the ids end within a character")


def decode(vocabulary: Vocabulary, ids: list[int], chunk: int = CHUNK) -> Iterator[bytes]:
    """The text's bytes in chunks of whole characters."""
    decoder = StreamDecoder(vocabulary)
    for at in range(0, len(ids), chunk):
        yield decoder.feed(ids[at : at + chunk])
    decoder.close()


_machines: dict[tuple[str, str], tuple[Encoder, Vocabulary]] = {}


def machine(path: str, pattern: str) -> tuple[Encoder, Vocabulary]:
    """The encoder and vocabulary that all tasks of this Python worker share."""
    if (path, pattern) not in _machines:
        gc.disable()  # the tables grow by many small objects without cycles; scanning them again and again takes a fifth of the time
        ranks = read_ranks(path)
        _machines[path, pattern] = Encoder(ranks, pattern), Vocabulary(ranks)
    return _machines[path, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Documents as ``doc_id`` and ``ids``, the ids of the whole text; one row per input row.

    Null and empty texts have no ids. Repeated rows stay; other columns are left out.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = machine(ranks_path, pattern)
        for batch in batches:
            ids = [encoder(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    stages.small_batches(docs.sparkSession, 200)
    return stages.texts(docs).mapInArrow(encode, "doc_id long, ids array<int>")


def round_trips(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode every whole text, decode its ids again, and describe both.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined
    by one space) and ``decoded_sha256`` (of the decoded bytes), one row per
    input row. A null text is empty: no token, and the hashes of nothing. A
    null doc_id stays null, repeated rows stay, other columns are left out, and
    an empty table gives an empty result.
    """

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = machine(ranks_path, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids = encoder(text.as_py())
                back = hashlib.sha256()
                for part in decode(vocabulary, ids):
                    back.update(part)
                rows.append((len(ids), hashlib.sha256(" ".join(map(vocabulary.names.__getitem__, ids)).encode()).hexdigest(), back.hexdigest()))
            counts, encoded, decoded = zip(*rows) if rows else ((), (), ())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    stages.small_batches(docs.sparkSession, 200)
    return stages.texts(docs).mapInArrow(describe, RESULT)
