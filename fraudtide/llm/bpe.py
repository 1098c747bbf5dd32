"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash answers for pre-tokens that are vocabulary entries as a whole; the
others are merged with a heap over linked bytes. Nothing is trained: the ranks come from a file.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

MASK = (1 << 64) - 1
# Odd multipliers that spread bits; any would do.
STEP, SPREAD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

KEYS_PER_BUCKET = 4
MEMO_ENTRIES = 400_000  # pre-tokens remembered per worker and generation, of two
PART_ENTRIES = 200_000  # parts of pre-tokens remembered per worker
CHUNK_CHARS = 1 << 20  # pre-tokens listed at once
OUT_BYTES = 1 << 20  # ids or decoded bytes of rows held before they are passed on
MAX_VOCABULARY_BYTES = 64 << 20  # what may be broadcast


class PerfectHash:
    """A minimal perfect hash of byte strings to their ids, by hash and displace.

    Keys fall into buckets; the largest bucket first, each gets the first displacement that sends
    its keys to free slots. Buckets of one key name their slot outright.
    """

    def __init__(self, entries: dict[bytes, int]):
        n = len(entries)
        self.size, self.buckets = n, max(1, n // KEYS_PER_BUCKET)
        self.keys: list[bytes] = [b""] * n
        self.ids = [-1] * n
        self.shift = [0] * self.buckets
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in entries:
            groups[xxhash.xxh64_intdigest(key) % self.buckets].append(key)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = [True] * n
        for b in order:
            if len(groups[b]) < 2:
                break
            hashes = [xxhash.xxh64_intdigest(k) for k in groups[b]]
            d = 0
            while True:
                slots = [self._slot(h, d) for h in hashes]
                if all(free[s] for s in slots) and len(set(slots)) == len(slots):
                    break
                d += 1
            self.shift[b] = d
            for key, s in zip(groups[b], slots, strict=True):
                free[s], self.keys[s], self.ids[s] = False, key, entries[key]
        left = (s for s in range(n) if free[s])
        for b in order:
            if len(groups[b]) == 1:
                s, key = next(left), groups[b][0]
                self.shift[b], self.keys[s], self.ids[s] = -s - 1, key, entries[key]

    def _slot(self, h: int, d: int) -> int:
        return ((((h ^ (d * STEP)) * SPREAD) & MASK) >> 24) % self.size

    def get(self, key: bytes) -> int:
        """The id of ``key``, or -1."""
        if not self.size:
            return -1
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.ids[s] if self.keys[s] == key else -1


def merge(piece: bytes, rank, pair: list[int]) -> list[int]:
    """Ids of a pre-token: join the neighbours of lowest rank, leftmost first, until none joins.

    Parts are linked by where they end and where the one before begins. A heap entry is one number,
    the rank, then where the joined part begins and ends; entries whose parts have changed since
    are skipped. n log n for a pre-token of n bytes. ``pair`` has the ranks of two bytes at 256
    times the first plus the second.
    """
    n = len(piece)
    end = list(range(1, n + 2))
    end[n] = 0
    before = list(range(-1, n))
    shift = n.bit_length()
    mask = (1 << shift) - 1
    heap = [
        (r << shift | i) << shift | i + 2
        for i in range(n - 1)
        if (r := pair[piece[i] << 8 | piece[i + 1]]) >= 0
    ]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        k, i = entry & mask, entry >> shift & mask
        j = end[i]
        if not j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
            after = end[k]
            if (r := rank(piece[i:after])) >= 0:
                heappush(heap, (r << shift | i) << shift | after)
        if i and (r := rank(piece[(p := before[i]) : k])) >= 0:
            heappush(heap, (r << shift | p) << shift | k)
    ids, i = [], 0
    while i < n:
        ids.append(rank(piece[i : end[i]]))
        i = end[i]
    return ids


class Ranks(dict):
    """Answers of the perfect hash for parts of pre-tokens, kept up to ``PART_ENTRIES``."""

    def __init__(self, table: PerfectHash):
        super().__init__()
        self.table = table

    def __missing__(self, part: bytes) -> int:
        if len(self) >= PART_ENTRIES:
            self.clear()
        rank = self[part] = self.table.get(part)
        return rank


class Pieces(dict):
    """Packed ids by pre-token, filled on demand.

    When ``MEMO_ENTRIES`` are held they become the old generation, from which those still in use
    come back; what nobody asked for in between is forgotten.
    """

    def __init__(self, table: PerfectHash):
        super().__init__()
        self.table, self.old = table, {}
        self.rank = Ranks(table).__getitem__
        self.pair = [table.get(bytes((a, b))) for a in range(256) for b in range(256)]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.old = dict(self)
            self.clear()
        packed = self.old.get(piece)
        if packed is None:
            raw = piece.encode()
            whole = self.table.get(raw)
            ids = [whole] if whole >= 0 else merge(raw, self.rank, self.pair)
            packed = pack(f"<{len(ids)}I", *ids)
        self[piece] = packed
        return packed


class Codec:
    """Encodes texts to packed little-endian ids and back to bytes."""

    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line)
        entries = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(PerfectHash(entries))
        self.token = {rank: token for token, rank in entries.items()}
        self.cut = regex.compile(r"(?<=\S)(?=\s)")

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts of about ``CHUNK_CHARS``, cut where white space begins: no match spans that."""
        begin = 0
        while len(text) - begin > 2 * CHUNK_CHARS and (m := self.cut.search(text, begin + CHUNK_CHARS)):
            yield text[begin : m.start()]
            begin = m.start()
        yield text[begin:]

    def encode(self, text: str) -> bytes:
        find = self.pieces.__getitem__
        return b"".join([b"".join(map(find, self.split(part))) for part in self.parts(text)])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec per vocabulary and worker process."""
    key = (sha256(ranks).hexdigest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def vocabulary(spark: SparkSession, path: str):
    """Broadcast a file of ranks, base64 token and rank a line. Vocabularies do not grow with the data."""
    with open(path, "rb") as file:
        ranks = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(ranks) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has over {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(ranks)


def bounded(batch: pa.RecordBatch, work: Callable[[object], bytes]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """The first column in runs of rows, with what ``work`` makes of the second: about ``OUT_BYTES`` a run.

    Values become Python's one at a time, so a batch of long texts is never held a second time.
    """
    begin, made, size = 0, [], 0
    for end, value in enumerate(batch.column(1), 1):
        made.append(work(value.as_py()))
        size += len(made[-1])
        if size >= OUT_BYTES or end == batch.num_rows:
            yield batch.column(0).slice(begin, end - begin), made
            begin, made, size = end, [], 0


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token ids of each text: ``doc_id, n_tokens, ids``. A null or empty text has no ids.

    Works row by row: repeated rows give repeated rows, an empty table none, other columns are left out.
    """
    ranks = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks.value, pattern)
        for batch in batches:
            for names, packed in bounded(batch, lambda text: coder.encode(text or "")):
                sizes = np.array([len(p) // 4 for p in packed], dtype="i8")
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<u4").astype("i4"))
                )
                yield pa.RecordBatch.from_arrays([names, pa.array(sizes), ids], ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (bytes) of ``doc_id, ids``; null ids give no bytes."""
    ranks = vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks.value, pattern)
        for batch in batches:
            for names, decoded in bounded(batch, lambda ids: coder.decode(np.array(ids or [], dtype="<u4").tobytes())):
                yield pa.RecordBatch.from_arrays([names, pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def token_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digest of the ids and of the bytes they decode to, per document, in one pass over the texts.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``; null and empty texts as in ``encode``.
    """
    ranks = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks.value, pattern)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                packed = coder.encode(value.as_py() or "")
                rows.append((len(packed) // 4, sha256(packed).hexdigest(), sha256(coder.decode(packed)).hexdigest()))
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = (pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
