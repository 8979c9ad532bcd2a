"""Byte-level BPE as a lazily determinised transducer, with a streaming decoder.

The merges of a rank table decide, for every byte string, one sequence of tokens. Two
facts make it a finite-state job: a sequence is that one exactly if every adjacent pair
of its tokens comes out of merging the pair's own bytes (a *stable* pair), and therefore
the last token of a prefix is found from earlier prefixes alone: it is the longest token
that ends there and is stable after the last token of what precedes it.

A state of the transducer holds, for the bytes since the last token that is certain, the
last token of every prefix and the boundaries from which a longer token may still come.
Reading a byte gives the next state and the tokens that all open continuations share by
then: the lookahead is bounded by the longest token. States are determinised only as
input reaches them and are shared by all words that lead there.

The decoder maps ids to bytes and runs an incremental UTF-8 machine over them whose
transitions are kept per (state, token); it emits whole characters as soon as they are
complete and replaces malformed sequences by U+FFFD.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import ensure_columns, small_batches

#: Pieces and pairs that a worker remembers before it starts anew.
CACHE = 500_000
#: States of the transducer that a worker remembers, give or take a block.
STATES = 400_000
#: Bytes of a piece between looks at that bound.
BLOCK = 16_384
#: Ids that the streaming decoder is fed at a time.
CHUNK = 8192


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The defining procedure: join the adjacent pair of lowest rank, leftmost first, until none has a rank."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                    if a + b in ranks), default=None)
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Encodes one piece (a match of the splitting pattern) at a time.

    A state is (before, lasts, open): the certain token in front of the pending bytes, the
    last token of every pending prefix, and the (boundary, trie node) pairs from which the
    bytes up to here begin a token. States are numbered as they are met; ``hops`` maps
    state * 256 + byte to (next state, tokens emitted).
    """

    START = 0

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the ranks lack {len(missing)} single bytes")
        self.length = {r: len(t) for t, r in ranks.items()}
        self._build_trie()
        self._stable: dict[int, bool] = {}
        self._spines: dict[int, tuple[list[int], list[int]]] = {}
        self._reset()

    def _build_trie(self) -> None:
        """Trie of the tokens: the children of each node by byte (None at a leaf), and the token
        that ends there (-1 if none). Node 0 is the root."""
        self.children: list[dict[int, int] | None] = [None]
        self.token_at: list[int] = [-1]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                below = self.children[node]
                if below is None:
                    below = self.children[node] = {}
                child = below.get(byte)
                if child is None:
                    child = below[byte] = len(self.children)
                    self.children.append(None)
                    self.token_at.append(-1)
                node = child
            self.token_at[node] = rank

    def _reset(self) -> None:
        self.hops: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._states: list[tuple] = [(-1, (), ((0, 0),))]
        self._numbers: dict[tuple, int] = {self._states[0]: 0}

    def _spine(self, token: int) -> tuple[list[int], list[int]]:
        """The parts that touch the token's left and right end while its bytes are merged,
        smallest first, the token itself last; empty if merging does not give the token."""
        got = self._spines.get(token)
        if got is None:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            left, right = [self.ranks[parts[0]]], [self.ranks[parts[-1]]]
            while len(parts) > 1:
                rank, i = min(((r, i) for i in range(len(parts) - 1)
                               if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=(-1, -1))
                if rank < 0:
                    left, right = [], []
                    break
                if i == 0:
                    left.append(rank)
                if i == len(parts) - 2:
                    right.append(rank)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            got = self._spines[token] = (left, right)
        return got

    def stable(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` gives just these two.

        Ranks rise along a spine, so the merges at the common end happen in rank order. A
        merge across it happens if its rank is below that of the next merge within ``a``
        (at a tie the left one comes first) and not above that of the next within ``b``.
        """
        key = a << 32 | b
        got = self._stable.get(key)
        if got is None:
            got = self._stable[key] = self._is_stable(self._spine(a)[1], self._spine(b)[0])
            if len(self._stable) > 4 * CACHE:
                self._stable.clear()
        return got

    def _is_stable(self, left: list[int], right: list[int]) -> bool:
        never, i, j = 1 << 40, 0, 0
        while True:
            x = left[i + 1] if i + 1 < len(left) else never
            y = right[j + 1] if j + 1 < len(right) else never
            across = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]], never)
            if across < x and across <= y and across != never:
                return False
            if x == never and y == never:
                return True
            if x <= y:
                i += 1
            else:
                j += 1

    def step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one transition."""
        before, lasts, open_ = self._states[number]
        children, length = self.children, self.length
        token, still = -1, []
        for start, node in open_:  # ascending boundaries: the longest token first
            child = children[node].get(byte)
            if child is None:
                continue
            if token < 0:
                t = self.token_at[child]
                if t >= 0:
                    prior = lasts[start - 1] if start else before
                    known = self._stable.get(prior << 32 | t) if prior >= 0 else None
                    if known is None:  # a token that merging does not give is stable after none
                        known = bool(self._spine(t)[0]) and (prior < 0 or self.stable(prior, t))
                    if known:
                        token = t
            if children[child] is not None:
                still.append((start, child))
        lasts = (*lasts, token)
        still.append((len(lasts), 0))
        # the boundary up to which the sequences of all open boundaries agree is certain
        cut = still[0][0]
        for start, _ in still[1:]:
            if not cut:
                break
            while start != cut:
                if start > cut:
                    start -= length[lasts[start - 1]]
                else:
                    cut -= length[lasts[cut - 1]]
        out: tuple[int, ...] = ()
        if cut:
            out = tuple(self._path(lasts, cut))
            before, lasts = out[-1], lasts[cut:]
            still = [(start - cut, node) for start, node in still]
        state = (before, lasts, tuple(still))
        to = self._numbers.get(state)
        if to is None:
            to = self._numbers[state] = len(self._states)
            self._states.append(state)
        hop = self.hops[number << 8 | byte] = (to, out)
        return hop

    def _path(self, lasts: tuple[int, ...], end: int) -> list[int]:
        """The tokens of the pending prefix that ends at ``end``."""
        path = []
        while end:
            token = lasts[end - 1]
            path.append(token)
            end -= self.length[token]
        return path[::-1]

    def _restart(self, number: int) -> int:
        """Forget all states but the one a piece has reached; return its new number."""
        state = self._states[number]
        self._reset()
        if state not in self._numbers:
            self._numbers[state] = len(self._states)
            self._states.append(state)
        return self._numbers[state]

    def feed(self, piece: bytes) -> array:
        state, packed = self.START, array("I")
        for at in range(0, len(piece), BLOCK):
            ids, hops = [], self.hops
            for byte in piece[at:at + BLOCK]:
                state, out = hops.get(state << 8 | byte) or self.step(state, byte)
                if out:
                    ids += out
            packed.extend(ids)
            if len(self._states) > STATES:
                state = self._restart(state)
        lasts = self._states[state][1]
        packed.extend(self._path(lasts, len(lasts)))
        return packed

    def encode_piece(self, piece: str) -> bytes:
        """Little-endian 32-bit ids; a piece that is a token as a whole is that token."""
        raw = piece.encode("utf-8", "replace")
        whole = self.ranks.get(raw)
        return (array("I", [whole]) if whole is not None else self.feed(raw)).tobytes()


class _Pieces(dict):
    """piece -> packed ids, remembered up to a bound; very long pieces are not kept."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece)
        if len(piece) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache
def _compiled(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern for texts of the basic plane, by the standard library's
    engine: the classes it lacks are written out as ranges, as the other engine has them."""

    def ranges(cls: str) -> str:
        held = regex.findall(f"{cls}+", "".join(map(chr, range(0x10000))))
        return "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in held)

    inside = False
    out = []
    for part in re.split(r"(\\[pP]\{\w+\}|\\[sS]|\\.|\[|\])", pattern):
        if part in "[]" and part:
            inside = part == "["
        elif re.fullmatch(r"\\[pP]\{\w+\}|\\[sS]", part):
            part = ranges(part) if inside else f"[{ranges(part)}]"
        out.append(part)
    return re.compile("".join(out)).findall


class Encoder:
    """Whole texts to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self._pieces = _Pieces(self.transducer)
        self._any = regex.compile(pattern).findall
        self._plane = _compiled(pattern)

    def encode(self, text: str) -> np.ndarray:
        plane = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        split = self._plane if plane else self._any
        return np.frombuffer(b"".join(map(self._pieces.__getitem__, split(text))), "<u4")


# states of the UTF-8 machine: bytes still due, with the range that the next one must be in
_READY, _BAD = 0, -1
_LEADS = [(0xC2, 0xDF, 1), (0xE0, 0xE0, 2), (0xE1, 0xEC, 3), (0xED, 0xED, 4), (0xEE, 0xEF, 3),
          (0xF0, 0xF0, 5), (0xF1, 0xF3, 6), (0xF4, 0xF4, 7)]
_NEXT = {1: (0x80, 0xBF, 0), 2: (0xA0, 0xBF, 1), 3: (0x80, 0xBF, 1), 4: (0x80, 0x9F, 1), 5: (0x90, 0xBF, 3),
         6: (0x80, 0xBF, 3), 7: (0x80, 0x8F, 3)}


def utf8_step(state: int, byte: int) -> int:
    """The state after ``byte``; -1 where it cannot follow."""
    if state == _READY:
        if byte < 0x80:
            return _READY
        return next((s for lo, hi, s in _LEADS if lo <= byte <= hi), _BAD)
    lo, hi, to = _NEXT[state]
    return to if lo <= byte <= hi else _BAD


class StreamDecoder:
    """Ids in, whole characters out; bytes of an unfinished character wait.

    Between characters, tokens that consist of whole characters leave the machine where it
    is and are joined directly; only the others, and what follows them, step through it.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.state, self.held = bytes_of, _READY, b""
        self._hops: dict[tuple[int, int], tuple[int, int]] = {}
        self._partial = np.zeros(max(bytes_of) + 1, bool)
        for token in bytes_of:
            self._partial[token] = self._hop(_READY, token) != (_READY, len(bytes_of[token]))

    def _hop(self, state: int, token: int) -> tuple[int, int]:
        """(state after the token, bytes of the token up to the last whole character; -1 if malformed)."""
        raw, done = self.bytes_of[token], 0
        if state == _READY and raw.isascii():
            return _READY, len(raw)
        for i, byte in enumerate(raw):
            state = utf8_step(state, byte)
            if state == _BAD:
                return _READY, -1
            if state == _READY:
                done = i + 1
        return state, done

    def feed(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the characters that are whole by now."""
        out: list[bytes] = []
        tokens, whole, at = ids.tolist(), self.bytes_of.__getitem__, 0
        for k in [*np.flatnonzero(self._partial[ids]).tolist(), len(tokens)]:
            while at < k and self.state != _READY:
                self._feed_one(tokens[at], out)
                at += 1
            if at < k:
                out.extend(map(whole, tokens[at:k]))
                at = k
            if at == k and k < len(tokens):
                self._feed_one(tokens[k], out)
                at = k + 1
        return b"".join(out)

    def _feed_one(self, token: int, out: list[bytes]) -> None:
        hop = self._hops.get((self.state, token))
        if hop is None:
            hop = self._hops[self.state, token] = self._hop(self.state, token)
        raw, (state, done) = self.bytes_of[token], hop
        if done < 0:
            self._malformed(raw, out)
        elif done:
            out.append(self.held + raw[:done])
            self.held, self.state = raw[done:], state
        else:
            self.held, self.state = self.held + raw, state

    def _malformed(self, raw: bytes, out: list[bytes]) -> None:
        for byte in raw:
            state = utf8_step(self.state, byte)
            if state == _BAD and self.state != _READY:
                out.append("�".encode())
                self.held, self.state = b"", _READY
                state = utf8_step(_READY, byte)
            if state == _BAD:
                out.append("�".encode())
                self.held, self.state = b"", _READY
            elif state == _READY:
                out.append(self.held + bytes([byte]))
                self.held, self.state = b"", _READY
            else:
                self.held, self.state = self.held + bytes([byte]), state

    def finish(self) -> bytes:
        left, self.held, self.state = self.held, b"", _READY
        return "�".encode() if left else b""


@lru_cache
def _coders(path: str, pattern: str) -> tuple[Encoder, StreamDecoder]:
    """One pair per worker process, kept between tasks."""
    with _no_cycle_search():
        encoder = Encoder(load_ranks(path), pattern)
        return encoder, StreamDecoder(encoder.transducer.bytes_of)


@contextmanager
def _no_cycle_search() -> Iterator[None]:
    """States are tuples without cycles, freed by their counts; searching them for cycles again
    and again takes a quarter of the time. What is made inside is left out of later searches."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()
        if was:
            gc.enable()


def _batches(path: str, pattern: str, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coders(path, pattern)
        names = ["ids"] * keep_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            n, ids_sha, decoded_sha, all_ids = [], [], [], []
            with _no_cycle_search():
                for text in batch.column(batch.num_columns - 1).to_pylist():
                    ids = encoder.encode(text or "")
                    digest = hashlib.sha256()
                    for k in range(0, len(ids), CHUNK):
                        digest.update(decoder.feed(ids[k:k + CHUNK]))
                    digest.update(decoder.finish())
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    decoded_sha.append(digest.hexdigest())
                    if keep_ids:
                        all_ids.append(ids.astype(np.int32))
            more = [pa.array(all_ids, pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *more, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(decoded_sha, pa.string())],
                names=[*batch.schema.names[:-1], *names])

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
                     keep_ids: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ids (if asked for), n_tokens, and digests of ids and decoded bytes.

    ``path`` is a rank file that every executor can open. A null text is encoded as an
    empty one (no tokens); repeated rows give repeated results.
    """
    ensure_columns(docs, "text", *keep)
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.col("text").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]]
    fields += ["ids array<int>"] * keep_ids + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    return narrow.mapInArrow(_batches(path, pattern, keep_ids), ", ".join(fields))
