"""Byte-level BPE encoding and decoding (operator 3).

Encoding. The merge table is compiled into a transducer over bytes. Its
nondeterministic form guesses token boundaries: a hypothesis is (last token,
trie node of the token being read). A token may follow another only if
merging would leave the boundary between them alone; by the order of merges
a sequence is the encoding of its bytes if and only if every neighbouring
pair passes. The transducer is determinised lazily: a state is a set of
hypotheses; reading a byte advances all of them, drops those that no token
can continue and notes the one token, if any, that may end there. Tokens
leave as soon as all remaining hypotheses agree on them, after a bounded
lookahead. States and transitions are built when first needed and kept in
bounded tables.

Decoding is a stream: token bytes go through an incremental UTF-8 state
machine that gives out text whenever a code point is complete and holds at
most three bytes back.

Defined results: null text counts as empty (no tokens, hash of nothing);
any length of text; a text's white-space runs, digits and letters are split
by the given pattern, each piece encoded alone. Bytes that are not UTF-8
decode to U+FFFD in ``StreamDecoder.feed``; byte output is exact.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from roomrate.llm.common import tidy, worker_table

#: Bytes read before settled tokens are sent on.
LOOK = 1024
#: A hypothesis is one integer: last token + 1, then the trie node.
NODE_BITS = 24
NODE = (1 << NODE_BITS) - 1
MAX_STATES = 200_000
MAX_PIECES = 150_000
MAX_PAIRS = 300_000


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks file: one base64 token and its rank a line."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain BPE of a short byte string: merge the lowest rank, leftmost
    first, until nothing merges. Used to compile pairs, not to encode text."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[c], i) for i in range(len(parts) - 1)
                    if (c := parts[i] + parts[i + 1]) in ranks), default=None)
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class _Below:
    """The ranks below one token's own."""

    def __init__(self, ranks: dict[bytes, int], top: int):
        self.ranks, self.top = ranks, top

    def __contains__(self, token: bytes) -> bool:
        return self.ranks.get(token, self.top) < self.top

    def __getitem__(self, token: bytes) -> int:
        return self.ranks[token]


class _State(dict):
    """byte -> (token that may end here or -1, next state), made when first asked for."""

    __slots__ = ("hypotheses", "step")

    def __missing__(self, byte: int):
        return self.step(self, byte)


class Transducer:
    """Lazily determinised transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        # trie of the tokens: (node, byte) in one integer -> child, its token id
        # (or -1), whether it has children
        child_of: dict[int, int] = {}
        token_at, self.depth, inner = [-1], [0], {0}
        for t, r in ranks.items():
            node = 0
            for b in t:
                nxt = child_of.get(node << 8 | b)
                if nxt is None:
                    nxt = child_of[node << 8 | b] = len(token_at)
                    token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    inner.add(node)
                node = nxt
            token_at[node] = r
        self.arcs = {k: (c, token_at[c], c in inner) for k, c in child_of.items()}
        self.max_states = max_states
        self._step = self.step  # one bound method for all states
        self._pairs: dict[int, bool] = {}  # by both tokens in one integer
        self._split: dict[int, tuple[int, int] | None] = {}
        self._made: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        for st in getattr(self, "states", {}).values():
            st.clear()  # states refer to each other: freed now, not when cycles are looked for
        self.states: dict[tuple, _State] = {}
        self.start = self._state((0,))

    def _state(self, hypotheses: tuple[int, ...]) -> _State:
        st = self.states.get(hypotheses)
        if st is None:
            st = self.states[hypotheses] = _State()
            st.hypotheses, st.step = hypotheses, self._step
        return st

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token`` (None for a byte or a
        token that merging never makes)."""
        if token not in self._split:
            own = self.bytes_of[token]
            parts = merge_by_rank(own, _Below(self.ranks, token))
            self._split[token] = tuple(parts) if len(parts) == 2 else None
            self._made[token] = len(own) == 1 or len(parts) == 2
        return self._split[token]

    def may_follow(self, last: int, token: int) -> bool:
        """Whether merging leaves the boundary between the two tokens alone.

        Looks back in time: the two parts that meet at the boundary stay
        neighbours until a later merge takes one of them into its own token;
        a merge of the two parts with a lower rank (or the same rank further
        left) would have come first and crossed the boundary.
        """
        if last < 0:
            self._halves(token)
            return self._made[token]
        key = last << 32 | token
        ok = self._pairs.get(key)
        if ok is not None:
            return ok
        bytes_of, ranks = self.bytes_of, self.ranks
        left, right, until, wins_tie = last, token, 1 << 62, False
        ok = True
        self._halves(token)
        if not self._made[token]:
            ok = False
        while ok:
            across = ranks.get(bytes_of[left] + bytes_of[right])
            if across is not None and (across < until or wins_tie and across == until):
                ok = False
                break
            if left > right:  # made last: undo its merge
                halves, until, wins_tie = self._halves(left), left, False
                if halves is None:
                    break
                left = halves[1]
            else:
                halves, until, wins_tie = self._halves(right), right, True
                if halves is None:
                    if (halves := self._halves(left)) is None:
                        break
                    left, until, wins_tie = halves[1], left, False
                else:
                    right = halves[0]
        if len(self._pairs) >= MAX_PAIRS:
            self._pairs.clear()
        self._pairs[key] = ok
        return ok

    def step(self, state: _State, byte: int) -> tuple[int, _State]:
        """Build the transition of ``state`` on ``byte``. The encoding of a
        prefix is unique, so at most one hypothesis completes a token here;
        the others keep their order (latest boundary last)."""
        after, done, arcs, pairs = [], -1, self.arcs, self._pairs
        for h in state.hypotheses:
            node = h & NODE
            arc = arcs.get(node << 8 | byte)
            if arc is None:
                continue
            child, token, more = arc
            if done < 0 <= token:
                last = (h >> NODE_BITS) - 1
                ok = pairs.get(last << 32 | token)
                if self.may_follow(last, token) if ok is None else ok:
                    done = token
            if more:
                after.append(h - node + child)
        if done >= 0:
            after.append((done + 1) << NODE_BITS)
        made = state[byte] = (done, self._state(tuple(after)))
        return made

    def _walk_back(self, ends: list[int], at: int, stop: int) -> list[int]:
        """The tokens from ``stop`` to ``at``, given the token that ends at
        each position."""
        out, bytes_of = [], self.bytes_of
        while at > stop:
            token = ends[at]
            out.append(token)
            at -= len(bytes_of[token])
        out.reverse()
        return out

    def stream(self, data: Iterable[int]) -> Iterator[list[int]]:
        """Token ids of one piece, in blocks, each as soon as no later byte
        can change it (checked every ``LOOK`` bytes)."""
        if len(self.states) > self.max_states:
            self._reset()
        state, ends, sent = self.start, [-1], 0
        for b in data:
            token, state = state[b]
            ends.append(token)
            if len(ends) - sent > LOOK:
                # boundaries still possible, and the last one they all share
                n = len(ends) - 1
                live = [n - self.depth[h & NODE] for h in state.hypotheses]
                while len(set(live)) > 1:
                    i = max(range(len(live)), key=live.__getitem__)
                    live[i] -= len(self.bytes_of[ends[live[i]]])
                if live[0] > sent:
                    yield self._walk_back(ends, live[0], sent)
                    ends, sent = [-1, *ends[live[0] + 1:]], 0
                if len(self.states) > 2 * self.max_states:
                    here = state.hypotheses
                    self._reset()
                    state = self._state(here)
        yield self._walk_back(ends, len(ends) - 1, sent)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token is that token
            return (whole,)
        if len(piece) > LOOK:
            return tuple(chain.from_iterable(self.stream(piece)))
        if len(self.states) > self.max_states:
            self._reset()
        state, ends = self.start, [-1]
        for b in piece:
            token, state = state[b]
            ends.append(token)
        return tuple(self._walk_back(ends, len(piece), 0))


class _Cache(dict):
    """Bounded two-generation cache filled on a miss."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Unsafe(Exception):
    pass


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Splits text by ``pattern`` and encodes each piece by the transducer.

    Texts are first cut at single spaces between two other characters: each
    part with its leading space then splits on its own exactly as inside the
    text, so the encodings of frequent parts are kept (bounded). What is kept
    are ids as little-endian 32-bit integers, once for a part that is one piece.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES):
        self.transducer = Transducer(ranks)
        # white space as Unicode defines it, also inside character classes
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                                     .replace(r"\S", r"\P{White_Space}"))
        self.safe_space = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.pieces = _Cache(self._piece, max_pieces)
        self.parts = _Cache(self._part, max_pieces)

    def _piece(self, piece: str) -> bytes:
        return _packed(self.transducer.encode_piece(piece.encode()))

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def _part(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Unsafe
        pieces = self.pattern.findall(" " + part)
        if len(pieces) == 1:  # kept as a part
            return self._piece(pieces[0])
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode_packed(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = text.split(" ")
        try:
            if text[0].isspace() or text[-1].isspace() or not parts[0] or parts[0][-1].isspace():
                raise _Unsafe
            return self._split(parts[0]) + b"".join(map(self.parts.__getitem__, parts[1:]))
        except _Unsafe:
            parts = self.safe_space.split(text)
            return self._split(parts[0]) + b"".join([self._split(" " + p) for p in parts[1:]])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()


# UTF-8 as a state machine: state -> ((low byte, high byte, next state), ...).
# Fixed by the definition of UTF-8; state 0 is between code points.
_UTF8 = {
    0: ((0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5),
        (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)),
    1: ((0x80, 0xBF, 0),),
    2: ((0x80, 0xBF, 1),),
    3: ((0x80, 0xBF, 2),),
    4: ((0xA0, 0xBF, 1),),
    5: ((0x80, 0x9F, 1),),
    6: ((0x90, 0xBF, 2),),
    7: ((0x80, 0x8F, 2),),
}
_NEXT = {(s, b): n for s, arcs in _UTF8.items() for lo, hi, n in arcs for b in range(lo, hi + 1)}


def pending_bytes(data: bytes) -> int:
    """How many bytes at the end of ``data`` begin a code point that is not
    complete yet: runs the state machine from the last byte that can start one."""
    for back in range(1, min(3, len(data)) + 1):
        if data[-back] & 0xC0 != 0x80:
            state = 0
            for b in data[-back:]:
                state = _NEXT.get((state, b))
                if state is None:
                    return 0
            return back if state else 0
    return 0


class StreamDecoder:
    """Token ids in, text out, in blocks of any size."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.held = b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(map(self.bytes_of.__getitem__, ids))
        keep = pending_bytes(data)
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def decode(ids: list[int], bytes_of: dict[int, bytes], block: int = 1 << 16) -> Iterator[str]:
    d = StreamDecoder(bytes_of)
    for i in range(0, len(ids), block):
        yield d.feed(ids[i:i + block])
    yield d.finish()


def worker_encoder(ranks_file: bytes, pattern: str) -> Encoder:
    """One encoder a Python worker: its tables stay filled from task to task
    until another operator runs in it."""
    return worker_table(("bpe", hashlib.sha256(ranks_file).digest(), pattern),
                        lambda: Encoder(parse_ranks(ranks_file), pattern))


def _tokenizer(spark, ranks_path: str, pattern: str | None):
    """Broadcast the vocabulary file (its size is that of the vocabulary,
    about 1 MB, whatever the corpus)."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read()), pattern


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of every whole text. Rows keep
    their multiplicity; other columns of ``docs`` are not read."""
    ranks, pattern = _tokenizer(docs.sparkSession, ranks_path, pattern)

    def run(batches):
        enc = worker_encoder(ranks.value, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = [enc.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """Inverse of ``encode_documents``: (id, text). Null ids decode to ''."""
    ranks, _ = _tokenizer(encoded.sparkSession, ranks_path, "")

    def run(batches):
        bytes_of = {r: t for t, r in parse_ranks(ranks.value).items()}
        for b in batches:
            texts = ["".join(decode(x.as_py() or [], bytes_of)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())],
                                             [id_col, "text"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "ids").mapInArrow(tidy(run), f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text in one pass; per document the number
    of tokens, the SHA-256 of the ids (little-endian unsigned 32-bit) and of
    the decoded bytes, and whether the round trip gave the text back."""
    ranks, pattern = _tokenizer(docs.sparkSession, ranks_path, pattern)

    def run(batches):
        enc = worker_encoder(ranks.value, pattern)
        bytes_of = enc.transducer.bytes_of
        for b in batches:
            n, ids_sha, text_sha, same = [], [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                packed = enc.encode_packed(text)
                ids = np.frombuffer(packed, dtype="<u4").tolist()
                back = "".join(decode(ids, bytes_of))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(back.encode()).hexdigest())
                same.append(back == text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
             "round_trip boolean")
