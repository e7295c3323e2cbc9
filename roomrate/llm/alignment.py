"""Cross-tokenizer alignment (operator 13).

Each text, with a space before it, is encoded whole by a byte-level BPE
tokenizer (A) and by a piece tokenizer (B). Per document a dictionary maps the
byte offset at which each token ends to the token's number, for A and for B;
the intersection of the two key sets, sorted, cuts both id lists into groups.
Every A token of a group is linked with every B token of it.

No token of either vocabulary runs over a single space between two other
characters (A's pieces begin there, and no piece of B has a space after
anything else; both are checked), so a text is the sequence of the parts
between such spaces, each with the space before it, and its tokens and groups
are those of its parts. A worker keeps the tokens and groups of the parts that
it has met; when it has more than ``MAX_PARTS`` only those that come again.

Documents are worked on in blocks of about ``BLOCK_BYTES`` of text, one row a
block from then on. A block names its distinct id pairs once with the number of
its documents that hold each, and holds its documents' pairs as numbers of
these, so corpus-wide counts shuffle block pairs, not documents' pairs:

1. blocks, written to the shared folder;
2. (pair, documents) summed over all blocks, the highest count of each A id;
3. both joined back to the blocks' pairs and grouped by block with the blocks,
   where each document adds up its own.

Nothing is broadcast but the vocabularies (a few MB, whatever the corpus), and
no group holds more than one block. Links inside a group with very many are
counted from its distinct ids.

Defined results: a text that is null or empty, or whose tokens of A or B do not
spell out its bytes (U+2581 in it, characters B has no bytes for), has no
tokens: zeros, no groups, an empty hash column. Any length of text; a text is
never cut. Strings of special tokens are plain text. Rows that repeat an id are
documents of their own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import free_worker_tables, give_back, staged, string_slices, tidy, worker_table

#: Text of a block, of the documents of a block that are worked on together,
#: and of one call of the tokenizers.
BLOCK_BYTES, PIECE_BYTES, CALL_BYTES = 2 << 20, 1 << 20, 1 << 17
#: Parts, and tokens of them, that a worker keeps; uses that a part needs to
#: stay when there are too many.
MAX_PARTS, MAX_TOKENS, AGAIN = 200_000, 3_000_000, 4
#: A group with more links is counted by distinct ids.
WIDE_GROUP = 1 << 16
#: Links of a block that are spelled out at once (a document's at least).
SOME_LINKS = 1 << 17
#: Blocks in a file: a reader of nested columns holds all rows of a file.
FILE_BLOCKS = 4
_SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands
    for itself, the other bytes, in order, for U+0100 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, json_a: bytes, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        alphabet, vocab = byte_alphabet(), json.loads(json_a)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = (bytes(alphabet[c] for c in token) if all(c in alphabet for c in token)
                               else token.encode())
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        if any(_SPACE in self.b.id_to_piece(i).lstrip(_SPACE) for i in range(self.b.get_piece_size())):
            raise ValueError("a piece has a space after another character")
        pre = json.loads(json_a)["pre_tokenizer"]
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError("pieces of the byte-level tokenizer must begin at spaces")
        # ids as they stand in a group's text: with a comma, or with what ends their side
        self.spelled = [f"{i}{end}".encode() for x, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
                        for end in ends for i in range(len(x))]
        self.space = re.compile(r"(?<=\S) (?=\S)")
        self.beside = re.compile(r"[^\S ] | [^\S ]")  # a space beside other white space
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[bytes] = []  # each part's groups as text
        none = np.zeros(0, np.int64)
        #: tokens and groups of the parts one after another, how many each has,
        #: and whether its tokens spell it out
        self.flat = {x: np.zeros(0, np.int32) for x in ("a", "b", "in_a", "in_b")}
        self.size = {x: none for x in ("a", "b", "groups", "fits")}
        self.used = none

    def make_room(self) -> None:
        """Let go of parts that were not used again and again."""
        if len(self.number) <= MAX_PARTS and len(self.flat["a"]) + len(self.flat["b"]) <= MAX_TOKENS:
            return
        stay = np.flatnonzero(self.used >= AGAIN)
        per = {"a": "a", "b": "b", "in_a": "groups", "in_b": "groups"}
        kept = {x: _gather(v, self.size[per[x]], stay) for x, v in self.flat.items()}
        if len(stay) > MAX_PARTS // 2 or len(kept["a"]) + len(kept["b"]) > MAX_TOKENS // 2:
            return self.reset()
        names = list(self.number)  # in the order of their numbers
        self.number = {names[i]: n for n, i in enumerate(stay.tolist())}
        self.text = [self.text[i] for i in stay.tolist()]
        self.flat, self.size = kept, {x: v[stay] for x, v in self.size.items()}
        self.used = self.used[stay] // 2

    def parts(self, text: str) -> list[str]:
        """The parts of a text, without the space before each."""
        if "  " in text or text[0] == " " or text[-1] == " " or self.beside.search(text):
            return self.space.split(text)
        return text.split(" ")

    def learn(self, parts: list[str]) -> None:
        """Tokens and groups of parts not met before."""
        flat, size = {x: [v] for x, v in self.flat.items()}, {x: [v] for x, v in self.size.items()}
        # parts that are words through and through are encoded as one text; those
        # with white space at an end (they begin or end a text) one by one
        edged = [p[0].isspace() or p[-1].isspace() for p in parts]
        for ends in (False, True):
            some = [p for p, e in zip(parts, edged) if e == ends]
            lo = 0
            while lo < len(some):
                hi, length = lo, 0
                while hi < len(some) and (hi == lo or length + len(some[hi]) <= CALL_BYTES):
                    length += len(some[hi])
                    hi += 1
                self._add(some[lo:hi], *((not ends and self._as_one(some[lo:hi])) or self._one_by_one(some[lo:hi])),
                          flat, size)
                lo = hi
        self.flat = {x: np.concatenate(v) for x, v in flat.items()}
        self.size = {x: np.concatenate(v) for x, v in size.items()}
        self.used = np.concatenate([self.used, np.zeros(len(parts), np.int64)])

    def _as_one(self, parts: list[str]) -> tuple | None:
        """Which parts fit (all), tokens of each, and all tokens; None if the
        tokens do not spell out every part."""
        text = " ".join(parts)
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode([text], num_threads=1)[0]
        own = b" " + text.encode()
        if (b"".join(map(self.bytes_a.__getitem__, a)) != own
                or b"".join(map(self.bytes_b.__getitem__, b)) != own):
            return None
        part_ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        out = []
        for ids, size in ((a, self.size_a), (b, self.size_b)):
            ids = np.array(ids, np.int64)
            ends = np.cumsum(size[ids])
            upto = np.searchsorted(ends, part_ends)  # the token that ends where the part does
            if (ends[upto] != part_ends).any():
                return None
            out += [np.diff(upto + 1, prepend=0), ids]
        return np.ones(len(parts), np.int64), out[0], out[2], out[1], out[3]

    def _one_by_one(self, parts: list[str]) -> tuple:
        ids_a = [x.ids for x in self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)]
        ids_b = self.b.encode(parts, num_threads=1)
        fits = [(own := b" " + p.encode()) == b"".join(map(self.bytes_a.__getitem__, x))
                and own == b"".join(map(self.bytes_b.__getitem__, y)) for p, x, y in zip(parts, ids_a, ids_b)]
        ids_a = [x if ok else [] for x, ok in zip(ids_a, fits)]
        ids_b = [y if ok else [] for y, ok in zip(ids_b, fits)]
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (ids_a, ids_b))
        a, b = (np.array(list(chain.from_iterable(x)), np.int64) for x in (ids_a, ids_b))
        return np.array(fits, np.int64), n_a, n_b, a, b

    def _add(self, parts: list[str], fits: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray,
             b: np.ndarray, flat: dict, size: dict) -> None:
        """Keep the tokens of parts, and their groups: the parts are one text
        after another, and both tokenizers' tokens end where a part does."""
        cuts_a, cuts_b = (np.array(x, np.int64) for x in common_cuts(
            np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist()))
        of_group = np.searchsorted(np.cumsum(n_a), cuts_a)  # the first part that ends there or later
        in_a, in_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        code = np.empty(len(a) + len(b), np.int64)
        for ids, cuts, own, other, first, last in (
                (a, cuts_a, in_a, cuts_b - in_b, 0, len(self.bytes_a)),
                (b, cuts_b, in_b, cuts_a, 2 * len(self.bytes_a), len(self.bytes_b))):
            mark = ids + first
            mark[cuts - 1] += last
            code[np.arange(len(ids)) + np.repeat(other, own)] = mark
        spelled = list(map(self.spelled.__getitem__, code.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.number.update(zip(parts, range(len(self.text), len(self.text) + len(parts))))
        self.text += [b"".join(spelled[x:y])[:-1] for x, y in zip([0, *ends[:-1]], ends)]
        for x, v in (("a", a), ("b", b), ("in_a", in_a), ("in_b", in_b)):
            flat[x].append(v.astype(np.int32))
        groups = np.bincount(of_group, minlength=len(parts))
        for x, v in (("a", n_a), ("b", n_b), ("groups", groups), ("fits", fits)):
            size[x].append(v)


def common_cuts(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each group, one past its last token of A and of B: end-to-index
    dictionaries, their common keys in order."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    keys = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, keys)), list(map(at_b.__getitem__, keys))


def _gather(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of ``flat``, of the given sizes, that ``which`` names, in order."""
    n = size[which]
    begin = (np.cumsum(size) - size)[which]
    return flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class Block:
    """Tokens, groups and links of the documents of a block."""

    def __init__(self, tok: Tokenizers, texts: list[str]):
        tok.make_room()
        parts = [tok.parts(t) if t else [] for t in texts]
        new = set(chain.from_iterable(parts)).difference(tok.number)
        if new:
            tok.learn(list(new))
        count = np.array(list(map(len, parts)), np.int64)
        at = np.array(list(map(tok.number.__getitem__, chain.from_iterable(parts))), np.int64)
        flat, size = tok.flat, tok.size
        tok.used += np.bincount(at, minlength=len(tok.used))
        doc = np.repeat(np.arange(len(texts)), count)
        bad = np.zeros(len(texts), bool)
        bad[doc[size["fits"][at] == 0]] = True
        at, count = at[~bad[doc]], np.where(bad, 0, count)
        ends = np.cumsum(count).tolist()
        self.own = [at[x:y].tolist() for x, y in zip([0, *ends[:-1]], ends)]
        self.text = tok.text
        self.a, self.b, self.in_a, self.in_b = (_gather(flat[x], size[n], at).astype(np.int64) for x, n in (
            ("a", "a"), ("b", "b"), ("in_a", "groups"), ("in_b", "groups")))
        doc = np.repeat(np.arange(len(texts)), count)
        total = lambda x: np.bincount(doc, size[x][at], minlength=len(texts)).astype(np.int64)
        self.n_a, self.n_b, self.n_groups = total("a"), total("b"), total("groups")
        self.of_group = np.repeat(np.arange(len(texts)), self.n_groups)
        self.bounds = np.concatenate([[0], np.cumsum(self.n_groups)])
        # groups' begins in the block's tokens
        self.begin_a, self.begin_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        links = np.concatenate([[0], np.cumsum(self.in_a * self.in_b)])
        self.n_links = links[self.bounds[1:]] - links[self.bounds[:-1]]

    def hashes(self) -> list[str]:
        """SHA-256 of the groups as text, per document; '' without tokens."""
        return [hashlib.sha256(b";".join(map(self.text.__getitem__, own))).hexdigest() if own else ""
                for own in self.own]

    def _expanded(self, groups: np.ndarray) -> np.ndarray:
        """document << 32 | A id << 16 | B id of every link of ``groups``."""
        n, width = self.in_a[groups] * self.in_b[groups], self.in_b[groups]
        start = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(start, n)
        width = np.repeat(width, n)
        a = self.a[np.repeat(self.begin_a[groups], n) + at // width]
        b = self.b[np.repeat(self.begin_b[groups], n) + at % width]
        return (np.repeat(self.of_group[groups], n) << 32) | (a << 16) | b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct document << 32 | A id << 16 | B id, sorted, and how many
        links each stands for. Documents are taken a few at a time, so that
        what is sorted stays small beside the result."""
        upto = np.cumsum(self.n_links)
        lo, found = 0, []
        while lo < len(upto):
            most = (upto[lo - 1] if lo else 0) + SOME_LINKS
            hi = max(lo + 1, int(np.searchsorted(upto, most, side="right")))
            found.append(self._links_of(np.arange(self.bounds[lo], self.bounds[hi])))
            lo = hi
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])

    def _links_of(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``links`` of the groups of some documents."""
        n = self.in_a[groups] * self.in_b[groups]
        keys = [self._expanded(groups[n <= WIDE_GROUP])]
        times = [np.ones(len(keys[0]), np.int64)]
        for g in groups[n > WIDE_GROUP]:
            a, count_a = np.unique(self.a[self.begin_a[g]:][:self.in_a[g]], return_counts=True)
            b, count_b = np.unique(self.b[self.begin_b[g]:][:self.in_b[g]], return_counts=True)
            keys.append(((self.of_group[g] << 32) | (a[:, None] << 16) | b[None, :]).ravel())
            times.append(np.outer(count_a, count_b).ravel())
        wide = len(keys) > 1
        keys = np.concatenate(keys)
        if wide:
            keys, at = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, np.concatenate(times))
            return keys, total
        return np.unique(keys, return_counts=True)


def _tokenizers(json_a: bytes, model_b: bytes) -> Tokenizers:
    """One pair of tokenizers a Python worker."""
    return worker_table(("alignment", hashlib.sha256(json_a).digest(), hashlib.sha256(model_b).digest()),
                        lambda: Tokenizers(json_a, model_b))


def _files(spark, path_a: str, path_b: str):
    """Broadcast of the vocabulary files (2 MB)."""
    data = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            data.append(f.read())
    return spark.sparkContext.broadcast(tuple(data))


def _texts(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    data = raw.tobytes()
    at = offsets.tolist()
    return [data[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1], at[1:])]


def _aligned(tok: Tokenizers, raw: np.ndarray, offsets: np.ndarray) -> tuple:
    """Counts, hashes, links and their numbers (``Block.links``) of a block's
    documents, a piece of the block at a time."""
    counts, hashes, keys, times = [], [], [], []
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, side="right")) - 1)
        blk = Block(tok, _texts(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
        some, n = blk.links()
        counts.append((blk.n_a, blk.n_b, blk.n_groups, blk.n_links))
        hashes += blk.hashes()
        keys.append(some + (lo << 32))
        times.append(n)
        lo = hi
    return [np.concatenate(x) for x in zip(*counts)], hashes, np.concatenate(keys), np.concatenate(times)


def _lists(values: np.ndarray, bounds: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids_a, ids_b, ends_a, ends_b): the token ids of every text and, for
    each group, how many tokens of A and of B precede its end."""
    files = _files(docs.sparkSession, path_a, path_b)

    def run(batches):
        tok = _tokenizers(*files.value)
        for batch in batches:
            for ids, raw, offsets in string_slices(batch.column(0), batch.column(1), BLOCK_BYTES):
                blk = Block(tok, _texts(raw, offsets))
                begin = lambda n: np.concatenate([[0], np.cumsum(n)])
                ends = [e + i - begin(n)[blk.of_group] for e, i, n in (
                    (blk.begin_a, blk.in_a, blk.n_a), (blk.begin_b, blk.in_b, blk.n_b))]
                yield pa.RecordBatch.from_arrays(
                    [ids, _lists(blk.a, begin(blk.n_a), pa.int32()), _lists(blk.b, begin(blk.n_b), pa.int32()),
                     *[_lists(e, blk.bounds, pa.int32()) for e in ends]],
                    [id_col, "ids_a", "ids_b", "ends_a", "ends_b"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, ids_a array<int>, ids_b array<int>, ends_a array<int>, ends_b array<int>")


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row a block: per document its id, counts, hash and number of pairs;
    the documents' pairs as steps through the block's distinct ``pairs`` (A id
    << 16 | B id) with ``times`` links each; ``docs`` that hold each pair."""
    files = _files(docs.sparkSession, path_a, path_b)

    def run(batches):
        tok = _tokenizers(*files.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, raw, offsets in string_slices(batch.column(0), batch.column(1), BLOCK_BYTES):
                counts, hashes, keys, times = _aligned(tok, raw, offsets)
                pairs, at = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
                of = keys >> 32
                some = np.bincount(of, minlength=len(ids))
                # numbers rise within a document: steps are small and pack well
                steps = np.diff(at, prepend=0)
                first = np.concatenate([[0], np.cumsum(some)[:-1]])[some > 0]
                steps[first] = at[first]
                one = lambda values, kind: pa.array([values], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     *[one(x, pa.int64()) for x in counts], one(hashes, pa.string()), one(some, pa.int32()), one(steps, pa.int32()),
                     one(times, pa.int64()), one(pairs, pa.int64()), one(np.bincount(at, minlength=len(pairs)), pa.int64())],
                    ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "hashes", "some", "steps", "times",
                     "pairs", "docs"])
                block += 1

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(tidy(run), (
        f"block long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
        "n_links array<long>, hashes array<string>, some array<int>, steps array<int>, times array<long>, "
        "pairs array<long>, docs array<long>"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents of the corpus that hold each id pair linked,
    and whether no pair of the same A id has more."""
    counts = (rows.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
              .withColumn("a", F.shiftright("pair", 16)))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row of ``docs``: tokens, groups, links; links whose id pair is held
    linked by as many documents as any pair of its A id; the sum of these
    counts over the links; the hash of ``a1,a2|b1;a3|b2,b3``."""
    rows = staged(blocks(docs, path_a, path_b, id_col, text_col), "token-blocks", FILE_BLOCKS)
    counts = staged(pair_counts(rows), "pair-counts")
    # back to the blocks: counts of a block's pairs by their places, the best ones
    # negative; a task holds one block and its pairs at a time
    own = (rows.select("block", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
           .select(F.col("block").alias("of"), "at", F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("n")))

    def run(rows, own):
        free_worker_tables()
        n = np.zeros(len(own), np.int64)
        n[own["at"].to_numpy()] = own["n"].to_numpy()
        out = []
        for b in rows.to_batches():
            for r in range(b.num_rows):
                col = {name: b.column(i)[r].values for i, name in enumerate(b.schema.names) if name != "block"}
                some, times, at = (np.asarray(col[x]).astype(np.int64) for x in ("some", "times", "steps"))
                n_best, total = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                if len(at):
                    # steps start anew with each document
                    walked = np.cumsum(at)
                    begin = np.cumsum(some) - some
                    has = some > 0
                    before = np.zeros(len(some), np.int64)
                    before[has] = walked[begin[has]] - at[begin[has]]
                    held = n[walked - np.repeat(before, some)]
                    n_best[has] = np.add.reduceat(np.where(held < 0, times, 0), begin[has])
                    total[has] = np.add.reduceat(np.abs(held) * times, begin[has])
                out.append(pa.RecordBatch.from_arrays(
                    [*[col[x] for x in ("ids", "n_a", "n_b", "n_groups", "n_links")],
                     pa.array(n_best), pa.array(total), col["hashes"]], fields))
        give_back()
        return pa.Table.from_batches(out)

    kind = dict(docs.dtypes)[id_col]
    schema = (f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
              "count_sum long, groups_sha256 string")
    fields = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return rows.drop("pairs", "docs").groupBy("block").cogroup(own.groupBy("of")).applyInArrow(run, schema)
