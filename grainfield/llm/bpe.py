"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Every leaf of the tree holds the rank of the pair that starts at a live byte position, every inner node the smallest
(rank, position) below it, so the root is the leftmost pair of minimum rank. A merge removes one position and makes
point updates at three leaves (the merged one, its left neighbour, the removed one), each logarithmic in the piece's
length. Many pieces of like length are advanced together, one merge of each at a time, in numpy.

Text is cut at white-space runs (a piece of the pattern never crosses the start of one), so that equal chunks are
encoded once per worker; texts with the separators 0x1C to 0x1F, which engines classify differently, are cut by the
pattern as a whole. Empty and null texts have no tokens. Nothing is truncated.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, no_cycles, slices

NONE = np.iinfo(np.int64).max
CHUNK = re.compile(r"\s*\S+|\s+")
ODD = re.compile("[\x1c-\x1f]")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token bytes, of a file with base64 tokens and decimal ranks."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class ByteBPE:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.span = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left * self.span + right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.pieces = Recent(160_000)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where the vocabulary has no such merge."""
        if not len(self.pair_keys):
            return np.full(len(left), NONE)
        keys = left * self.span + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge(self, pieces: list[bytes], cells: int = 1 << 19) -> list[list[int]]:
        """Ids of each piece. Pieces are grouped by length, and a group is cut so that its trees have `cells` leaves at most (one piece at least)."""
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = [whole]
            elif not piece:
                out[i] = []
            else:
                groups.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(i)
        for leaves, members in groups.items():
            step = max(1, cells // leaves)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                found = self._merge_group([pieces[j] for j in part], leaves) if len(part) > 24 else [self._merge_one(pieces[j], leaves) for j in part]
                for i, ids in zip(part, found, strict=True):
                    out[i] = ids
        return out

    def _merge_one(self, piece: bytes, leaves: int) -> list[int]:
        """The same tree for a single piece: few or very long pieces gain nothing from numpy."""
        ranks, tokens, n = self.ranks, self.tokens, len(piece)
        ids, after, before = [ranks[piece[i : i + 1]] for i in range(n)], list(range(1, n + 1)), list(range(-1, n))
        tree = [NONE] * (2 * leaves)

        def rank_at(i: int) -> int:
            rank = ranks.get(tokens[ids[i]] + tokens[ids[after[i]]]) if after[i] < n else None
            return NONE if rank is None else rank * leaves + i

        def put(i: int, value: int) -> None:
            node = i + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        for i in range(n):
            tree[leaves + i] = rank_at(i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != NONE:
            rank, at = divmod(tree[1], leaves)
            gone = after[at]
            ids[at], ids[gone], after[at] = rank, None, after[gone]
            if after[at] < n:
                before[after[at]] = at
            put(gone, NONE)
            put(at, rank_at(at))
            if before[at] >= 0:
                put(before[at], rank_at(before[at]))
        return [i for i in ids if i is not None]

    def _merge_group(self, pieces: list[bytes], leaves: int) -> list[list[int]]:
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), dtype=np.uint8).reshape(n, leaves)
        # One spare column holds the end: position `leaves` is no position.
        ids = np.full((n, leaves + 1), -1, dtype=np.int64)
        ids[:, :leaves] = self.byte_ids[raw]
        place = np.arange(leaves + 1)
        ids[place[None, :] >= sizes[:, None]] = -1
        after = np.minimum(place[None, :] + 1, leaves).repeat(n, 0)
        after[place[None, :] + 1 >= sizes[:, None]] = leaves
        before = (place[None, :] - 1).repeat(n, 0)
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
        has = ids[:, 1 : leaves + 1] >= 0
        rank = np.full((n, leaves), NONE, dtype=np.int64)
        rank[has] = self.pair_rank(ids[:, :leaves][has], ids[:, 1 : leaves + 1][has])
        known = rank != NONE
        tree[:, leaves:][known] = (rank * leaves + place[None, :leaves])[known]
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            best = tree[rows, 1]
            at, rank_now = best % leaves, best // leaves
            gone = after[rows, at]
            follow = after[rows, gone]
            ids[rows, at], ids[rows, gone] = rank_now, -1
            after[rows, at], before[rows, follow] = follow, at
            left = before[rows, at]
            self._put(tree, leaves, rows, gone, np.full(len(rows), NONE))
            ok = follow < leaves
            self._pair_update(tree, ids, leaves, rows[ok], at[ok], follow[ok])
            self._put(tree, leaves, rows[~ok], at[~ok], np.full(int((~ok).sum()), NONE))
            ok = left >= 0
            self._pair_update(tree, ids, leaves, rows[ok], left[ok], at[ok])
            rows = rows[tree[rows, 1] != NONE]
        return [row[row >= 0].tolist() for row in ids]

    def _pair_update(self, tree, ids, leaves, rows, left, right) -> None:
        rank = self.pair_rank(ids[rows, left], ids[rows, right])
        self._put(tree, leaves, rows, left, np.where(rank == NONE, NONE, np.where(rank == NONE, 0, rank) * leaves + left))

    @staticmethod
    def _put(tree, leaves, rows, leaf, value) -> None:
        """Point update: set a leaf of each row's tree and the minima above it."""
        node = leaf + leaves
        tree[rows, node] = value
        while leaves > 1:
            node, leaves = node >> 1, leaves >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each text: its pattern's pieces, each merged on its own, and but once while it is remembered."""
        known = self.pieces
        known.turn()
        cut = [[p.encode("utf-8") for p in self.pattern.findall(c)] for c in chunks]
        missing = [p for p in {p: None for pieces in cut for p in pieces} if p not in known and not known.recall(p)]
        known.update(zip(missing, self.merge(missing), strict=True))
        return [[i for p in pieces for i in known[p]] for pieces in cut]

    def encode(self, text: str) -> list[int]:
        return self.encode_chunks([text])[0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def split_chunks(text: str) -> list[str]:
    return [text] if ODD.search(text) else CHUNK.findall(text)


class Recent(dict):
    """A dict of two generations of `limit` / 2 entries: at the turn the younger becomes the older, and entries in use come back from there."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def turn(self) -> None:
        if 2 * len(self) > self.limit:
            self.older = dict(self)
            self.clear()

    def recall(self, key) -> bool:
        value = self.older.get(key)
        if value is not None:
            self[key] = value
        return value is not None


class Chunks(Recent):
    """Entries [number of ids, decimal ids, decoded bytes] of chunks; new ones are empty, and pending, until filled."""

    def __init__(self, limit: int):
        super().__init__(limit)
        self.pending: dict[str, list] = {}

    def __missing__(self, chunk: str) -> list:
        if not self.recall(chunk):
            self[chunk] = self.pending[chunk] = []
        return self[chunk]


class ChunkCodec:
    """Digests of texts from their chunks, each encoded once while it is remembered."""

    def __init__(self, bpe: ByteBPE, limit: int = 320_000):
        self.bpe, self.known = bpe, Chunks(limit)

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        known = self.known
        known.turn()
        entries = [list(map(known.__getitem__, split_chunks(t))) for t in texts]
        for entry, ids in zip(known.pending.values(), self.bpe.encode_chunks(list(known.pending)), strict=True):
            entry += len(ids), " ".join(map(str, ids)), self.bpe.decode(ids)
        known.pending.clear()
        return [self._digest(e) for e in entries]

    @staticmethod
    def _digest(entries: list[list]) -> tuple[int, str, str]:
        if not entries:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        counts, ids, raw = zip(*entries, strict=True)
        return sum(counts), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(b"".join(raw)).hexdigest()


_codecs: dict = Memo(lambda key: ChunkCodec(ByteBPE(read_ranks(key[0]), key[1])), 4)


def batches_by_size(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `chars` characters, one text at least."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of `docs(doc_id, text)`, repeated and null ids included.

    `vocabulary` is the path of a rank file that the driver can open; its bytes (fixed size) go out as a broadcast.
    Null and empty texts have 0 tokens and the digests of nothing. Other columns are ignored, an empty table gives none.
    """
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(parts):
        codec = _codecs[ranks.value, pattern]
        for part in parts:
            ids = part.column(0)
            for a, b in slices(part.column(1), 2_000_000):
                with no_cycles():
                    found = codec.digests([t or "" for t in part.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *(pa.array(col, t) for col, t in zip(zip(*found, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids array<int>): the ids themselves, for writers. Cases as in encode_documents()."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(parts):
        bpe = _codecs[ranks.value, pattern].bpe
        for part in parts:
            for a, b in slices(part.column(1), 2_000_000):
                found = bpe.encode_chunks([t or "" for t in part.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")
