"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file is: one frame for each document (its ids as little-endian unsigned integers of 2 or 4 bytes), one skippable
frame with the document directory (ids of documents, numbers of tokens, width), and a skippable frame with the seek
table: for every frame before it the compressed size, the decompressed size and a checksum (the low 32 bits of XXH64
over the decompressed bytes), then the number of frames, a flag byte and a magic number. Any reader of the seekable
zstandard format can open it; a reader of one document seeks to its frame and decompresses that alone.

Files are written by ascending document id (null first, equal ids by a hash of their text, so that many of them are not one task's),
each under a name of its own and then moved into place, so a task that runs again leaves the same file.

Cases: null and empty texts hold the end id alone; texts of any length are one frame; rows that share an id, and repeated rows, are documents of
their own; strings of added tokens in a text are those tokens, as in the library; an empty table gives no files and no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard_at_exit, fresh_dir, slices

# Fixed values of the seekable zstandard format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DIRECTORY = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# Marks that end a word after an ASCII letter or digit are a piece of their own; an apostrophe may begin another.
MARKS = r"([a-z0-9])([!-&(-/:-@\[-`{-~]+)([\s\x0b]|$)"


class TokenFileWriter:
    """Writes one file to a binary sink; close() adds the directory and the seek table."""

    def __init__(self, sink, width: int, level: int = 3):
        self.sink, self.width, self.zstd = sink, width, zstandard.ZstdCompressor(level=level)
        self.entries, self.docs, self.counts = [], [], []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """Append a document whose ids are already packed at the file's width."""
        frame = self.zstd.compress(raw)
        self.sink.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.docs.append(doc_id)
        self.counts.append(len(raw) // self.width)

    def close(self) -> None:
        known = np.array([d is not None for d in self.docs], dtype="<u1")
        body = struct.pack("<BQ", self.width, len(self.docs)) + known.tobytes()
        body += np.array([d or 0 for d in self.docs], dtype="<i8").tobytes() + np.array(self.counts, dtype="<u8").tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(body)) + body)
        self.entries.append((len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class TokenFileReader:
    """Random access to a file's documents: `source` has seek() and read()."""

    def __init__(self, source, size: int):
        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        raw = self._at(size - 9 - 12 * frames - 8, 8 + 12 * frames)
        if struct.unpack("<II", raw[:8]) != (SKIPPABLE_SEEK_TABLE, 12 * frames + 9):
            raise ValueError("the seek table is damaged")
        self.entries = np.frombuffer(raw[8:], dtype="<u4").reshape(frames, 3)
        ends = np.cumsum(self.entries[:, 0].astype(np.int64))
        self.starts = ends - self.entries[:, 0]
        body = self._at(int(self.starts[-1]) + 8, int(self.entries[-1, 0]) - 8)
        self.width, n = struct.unpack("<BQ", body[:9])
        known = np.frombuffer(body, dtype="<u1", count=n, offset=9)
        ids = np.frombuffer(body, dtype="<i8", count=n, offset=9 + n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.counts = np.frombuffer(body, dtype="<u8", count=n, offset=9 + 9 * n).astype(np.int64)

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document; only its frame is read and decompressed."""
        size, full, checksum = map(int, self.entries[i])
        raw = self.zstd.decompress(self._at(int(self.starts[i]), size), max_output_size=max(1, full))
        if len(raw) != full or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} doesn't match its checksum")
        return np.frombuffer(raw, dtype=f"<u{self.width}")


_encoders: dict = {}


class WordEncoder:
    """Packed ids of texts under a tokenizer that drops white space, so words split at ASCII white space, and marks at their ends, are encoded once each.

    The library finds strings of added tokens in a text before it lower-cases; words that may hold one are encoded as they stand.
    Each batch looks its distinct words up once, and puts its texts together from their ids in numpy.
    """

    def __init__(self, definition: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(a.split()) != 1 for a in self.added):
            raise ValueError("an added token holds white space, so texts can't be split at it")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.fence = next((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), None)
        self.fence_id = self.tokenizer.token_to_id(self.fence) if self.fence else None
        self.limit, self.known, self.older = limit, {b"": b""}, {}

    def ids(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word. Words are kept in two generations of `limit` / 2 each, so that those in use stay."""
        if 2 * len(self.known) > self.limit:
            self.known, self.older = {b"": b""}, self.known
        known, older = self.known, self.older
        missing = set()
        for w in words:
            if w not in known:
                ids = older.get(w)
                if ids is None:
                    missing.add(w)
                else:
                    known[w] = ids
        self.learn(missing)
        return list(map(known.__getitem__, words))

    def packed(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Packed ids of each text and the end id; null texts have the end id alone."""
        end = end_id.to_bytes(self.width, "little")
        low = pa.compute.ascii_lower(texts.cast(pa.string()).fill_null(""))
        odd = np.zeros(len(texts), bool)
        for token in self.added:
            odd |= pa.compute.match_substring(low, token.decode()).to_numpy(zero_copy_only=False)
        if odd.any():
            low = pa.compute.if_else(pa.array(odd), "", low)
        low = pa.compute.replace_substring_regex(low, MARKS, r"\1 \2\3")
        lists = pa.compute.ascii_split_whitespace(low)  # ends of a text that are white space give empty words, which have no ids
        words = lists.flatten().dictionary_encode()
        own = self.ids(words.dictionary.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // self.width
        ids, starts = np.frombuffer(b"".join(own), f"<u{self.width}"), np.cumsum(sizes) - sizes
        at = words.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        before = np.cumsum(n) - n
        raw = ids[np.repeat(starts[at] - before, n) + np.arange(n.sum())].tobytes()
        offsets = lists.offsets.to_numpy()
        ends = self.width * np.r_[before, n.sum()][offsets - offsets[0]]
        out = [raw[a:b] + end for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd):
            text = texts[int(i)].as_py().encode()
            out[i] = b"".join(self.ids([w if any(a in w.lower() for a in self.added) else w.lower() for w in text.split()])) + end
        return out

    def learn(self, missing: set[bytes]) -> None:
        """Encode words that aren't known yet."""
        known = self.known
        whole = [w for w in missing if self.fence is None or any(a in w.lower() for a in self.added)]
        fenced = list(missing.difference(whole))
        for w in whole:
            known[w] = self.pack(self.tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids).tobytes()
        # An added token between words parts them as texts of their own: one call encodes many.
        for at in range(0, len(fenced), 5_000):
            part = fenced[at : at + 5_000]
            ids = self.pack(self.tokenizer.encode(b"".join((self.fence.encode(), self.fence.encode().join(part))).decode("utf-8"), add_special_tokens=False).ids)
            raw, starts = ids.tobytes(), self.width * (np.flatnonzero(ids == self.fence_id) + 1)
            ends = np.r_[starts[1:] - self.width, len(raw)]
            known.update(zip(part, [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], strict=True))

    def pack(self, ids: list[int]) -> np.ndarray:
        return np.array(ids, f"<u{self.width}")


def encoder(definition: str) -> WordEncoder:
    if definition not in _encoders:
        _encoders.clear()
        _encoders[definition] = WordEncoder(definition)
    return _encoders[definition]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, out_dir: str | None = None, level: int = 3) -> DataFrame:
    """Encode `docs(doc_id, text)` into files below `out_dir` (a fresh shared folder by default).

    Returns a row (file_no, file, n_docs, n_tokens, start) for each file, start the tokens of all files before it.
    `tokenizer` is the path of a tokenizer that drops white space; its definition (fixed size) goes out as a broadcast.
    An empty table gives no files.
    """
    spark = docs.sparkSession
    if out_dir is None:
        out_dir = fresh_dir(spark, "tokens")
        discard_at_exit(spark, out_dir)
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def run(parts):
        coder, no = encoder(definition.value), TaskContext.get().partitionId()
        store, root = pafs.FileSystem.from_uri(out_dir)
        writer = None
        for part in parts:
            ids, texts = part.column(0).to_pylist(), part.column(1)
            for a, b in slices(texts, 8_000_000):
                if writer is None:
                    store.create_dir(root)
                    draft, final = f"{root}/.{no:08d}-{uuid.uuid4().hex}", f"{root}/{no:08d}.tokens"
                    sink = store.open_output_stream(draft)
                    writer = TokenFileWriter(sink, coder.width, level)
                for doc_id, raw in zip(ids[a:b], coder.packed(texts.slice(a, b - a), end_id), strict=True):
                    writer.add(doc_id, raw)
        if writer is not None:
            writer.close()
            sink.close()
            store.move(draft, final)
            yield pa.RecordBatch.from_pylist([{"file_no": no, "file": f"{no:08d}.tokens", "n_docs": len(writer.docs), "n_tokens": sum(writer.counts)}], pa.schema([("file_no", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    keys = "doc_id", "h"
    ordered = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    files = cut(ordered.mapInArrow(run, "file_no long, file string, n_docs long, n_tokens long"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file, not for each document
    return files.select("file_no", F.concat(F.lit(out_dir + "/"), "file").alias("file"), "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))


def read_token_files(files: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of every document in the files of write_token_files(), each from its own frame."""

    def run(parts):
        for part in parts:
            for file, start in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                store, path = pafs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    reader = TokenFileReader(source, source.size())
                    starts = start + np.cumsum(reader.counts) - reader.counts
                    crcs = [zlib.crc32(reader.ids(i).astype("<u4").tobytes()) for i in range(len(reader))]
                for at in range(0, len(reader), 20_000):
                    cols = reader.doc_ids[at : at + 20_000], starts[at : at + 20_000], reader.counts[at : at + 20_000], crcs[at : at + 20_000]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, files.count())
    return files.select("file", "start").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
