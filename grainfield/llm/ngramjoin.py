"""N-gram Jaccard self-join with multiple-global-order prefix filtering, down to components.

A text's set holds the 48-bit digests of its distinct runs of `width` words (A-Z lower-cased; of shorter texts the
whole run). Documents with equal sets are one class, known by its smallest id. Sets are built once, and kept in a table
bucketed by the task that built them, so that what is later known of its documents and digests comes back to it by joins
that never shuffle a set.

Under any global order of digests, two sets with a Jaccard similarity of `num`/`den` or more share a digest among the
first n - ceil(n num/den) + 1 of each. The frequency of every digest, in classes, is counted exactly: chunks of documents
send their distinct digests with counts, and get a code for each back. Three orders are used, all with digests of a single
class first and each with a resolution of frequency and a hash of its own behind that. Digests of a single class match
nothing, so most texts have nothing left in their prefix and take no further part.

Postings of the first order propose candidates; a candidate must also share a prefix digest under the second and the
third order (by 2-byte marks of them) before its sets are intersected. Posting lists with equal members count once. In the first
round every class is compared with one pivot of each list. In the second come the members of a list that the links so far
leave in different components: lists of SMALL members as pairs, longer ones in blocks that hold their members' sets,
where pairs are filtered and intersected in memory and only a forest of links goes out, so no group emits its pairs.
Every pair above the threshold is compared in one of the rounds or joined by links already, so components are exact.

Cases: null and empty texts, and texts of white space, have no shingles and link with nothing; null ids link with nothing
and have no component; repeated rows are one node, rows that share an id alone go by their own sets (sets known by one
smallest id are one node); an empty table gives no rows; other columns are ignored. Whole texts are used, of any length; a text's set is one value of 6 bytes a shingle.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, discard_at_exit, fresh_dir, min_label_components, mix64, slices
from .vectors import forest

ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]
SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)
BITS = 48  # of a digest
SMALL = 64  # members of a list whose pairs may be rows
BLOCK = 1024  # members of a list that are compared in memory
BLOCK_SHINGLES = 8_000_000
BUCKET_SHINGLES = 4_000_000  # digests that one step of the count holds
MOST_TEXTS = 50_000  # texts whose numbers fit beside a digest


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct digests of all texts in turn, where each text's begin and the last one's end)."""
    if len(texts) > MOST_TEXTS:
        parts = [shingle_sets(texts[i : i + MOST_TEXTS], width) for i in range(0, len(texts), MOST_TEXTS)]
        sizes = np.concatenate([np.diff(at) for _, at in parts])
        return np.concatenate([h for h, _ in parts]), np.r_[0, np.cumsum(sizes)]
    raw = [b"".join(map(xxhash.xxh3_64_digest, text.lower().split())) for text in texts]  # hashing a word again costs less than remembering it
    sizes = np.array(list(map(len, raw))) // 8
    d = np.frombuffer(b"".join(raw), ">u8").astype(np.uint64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    keys = []
    with np.errstate(over="ignore"):
        if len(d) >= width:
            n = len(d) - width + 1
            s = sum(d[j : j + n] * np.uint64(ODD[j % 8] + 2 * (j // 8)) for j in range(width))
            ok = np.arange(n) + width <= ends[doc[:n]]
            keys.append((doc[:n][ok].astype(np.uint64) << np.uint64(BITS)) | (mix64(s[ok]) >> np.uint64(64 - BITS)))
        for i in np.flatnonzero((sizes > 0) & (sizes < width)):
            own = d[ends[i] - sizes[i] : ends[i]]
            s = sum(own[j : j + 1] * np.uint64(ODD[j % 8] + 2 * (j // 8)) for j in range(len(own))) + np.uint64(int(sizes[i]))
            keys.append((np.uint64(int(i)) << np.uint64(BITS)) | (mix64(s) >> np.uint64(64 - BITS)))
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return keys & np.uint64((1 << BITS) - 1), np.searchsorted(keys >> np.uint64(BITS), np.arange(len(texts) + 1).astype(np.uint64))


def pack(h: np.ndarray, width: int = BITS // 8) -> bytes:
    """The low bytes of digests."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(blob: bytes, width: int = BITS // 8) -> np.ndarray:
    raw = np.zeros((len(blob) // width, 8), np.uint8)
    raw[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return raw.view("<u8").ravel()


def documents_in(parts, limit: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches (doc_id, text, ...) of bounded text."""
    for part in parts:
        for a, b in slices(part.column(1), limit):
            some = part.slice(a, b - a)
            yield some, [t or b"" for t in some.column(1).cast(pa.binary()).to_pylist()]


CHUNK = pa.schema([("part", pa.int64()), ("seq", pa.int32()), ("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("f0", pa.list_(pa.int64())), ("f1", pa.list_(pa.int64())), ("digests", pa.binary())])


class SetTable:
    """Rows (part, seq, ids, n, f0, f1, digests), one for each chunk of documents: ids, sizes, 128-bit digests and packed elements of their sets.

    Bucketed by part, the task that built the chunk; buckets follow the session's shuffle partitions.
    """

    def __init__(self, docs: DataFrame, width: int):
        def run(parts):
            part = TaskContext.get().partitionId()
            for seq, (some, texts) in enumerate(documents_in(parts)):
                h, at = shingle_sets(texts, width)
                total, mixed = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    total[full] = np.add.reduceat(mix64(h), at[full])
                    mixed[full] = np.bitwise_xor.reduceat(mix64(h ^ np.uint64(SALTS[0])), at[full])
                lists = some.column(0).cast(pa.int64()), pa.array(np.diff(at)), pa.array(total.view(np.int64)), pa.array(mixed.view(np.int64))
                ends = pa.array([0, len(texts)], pa.int32())
                yield pa.record_batch([pa.array([part], pa.int64()), pa.array([seq], pa.int32()), *(pa.ListArray.from_arrays(ends, x) for x in lists), pa.array([pack(h)], pa.binary())], schema=CHUNK)

        self.spark = docs.sparkSession
        self.path, self.name = fresh_dir(self.spark, "sets"), f"grainfield_sets_{uuid.uuid4().hex}"
        chunks = docs.select("doc_id", "text").mapInArrow(run, "part long, seq int, ids array<long>, n array<long>, f0 array<long>, f1 array<long>, digests binary")
        chunks.write.option("compression", "uncompressed").bucketBy(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "part").option("path", self.path).saveAsTable(self.name)
        discard_at_exit(self.spark, self.path)
        self.rows = self.spark.table(self.name)

    def documents(self) -> DataFrame:
        """Rows (part, seq, at, doc_id, n, f0, f1): every document and its place."""
        each = self.rows.select("part", "seq", F.posexplode(F.arrays_zip("ids", "n", "f0", "f1")).alias("at", "d"))
        return each.select("part", "seq", "at", F.col("d.ids").alias("doc_id"), F.col("d.n").alias("n"), F.col("d.f0").alias("f0"), F.col("d.f1").alias("f1"))

    def joined(self, *more: DataFrame) -> DataFrame:
        """The chunks with what each of `more` (part, seq, ...) knows of them; those without rows in the first are left out.

        Only `more` is shuffled: a row for each part, whose items are picked apart beside each chunk.
        """
        out = self.rows
        for i, known in enumerate(more):
            value, rest = f"v{i}", [c for c in known.columns if c != "part"]
            per_part = known.groupBy("part").agg(F.collect_list(F.struct(*rest)).alias(value))
            out = out.join(per_part.hint("shuffle_hash"), "part")
            out = out.withColumn(value, F.filter(value, lambda x: x["seq"] == F.col("seq")))
        return out.filter(F.size("v0") > 0)

    def drop(self) -> None:
        """Forget the table and free its files: nothing may depend on its rows any more but what is written elsewhere."""
        self.spark.sql(f"drop table if exists {self.name}")
        discard(self.spark, self.path)


def each_row(parts) -> Iterator[dict]:
    """Rows one by one, so that large values aren't held twice."""
    for part in parts:
        for i in range(part.num_rows):
            yield part.slice(i, 1).to_pylist()[0]


def own_digests(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(digests of a chunk's representatives in turn, number in the chunk of the document of each)."""
    n = np.array(row["n"])
    first = np.zeros(len(n), bool)
    first[[x["at"] for x in row["v0"]]] = True
    h, doc = unpack(row["digests"]), np.repeat(np.arange(len(n)), n)
    return h[first[doc]], doc[first[doc]]


def frequency_codes(sets: SetTable, reps: DataFrame) -> DataFrame:
    """Rows (part, seq, bucket, codes): for each chunk, a byte for each of its distinct digests in ascending order, by ranges of digests.

    Code 1 is a digest of one class; codes grow with the number of classes, exactly up to 128, then by eighths of a doubling.
    """
    total = reps.agg(F.sum("n")).first()[0] or 1
    bits = max(8, math.ceil(math.log2(total / BUCKET_SHINGLES)))
    width = -(-(BITS - bits) // 8)
    lower = np.uint64((1 << (8 * width)) - 1) if width < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)

    def send(parts):
        zstd = zstandard.ZstdCompressor(level=1)
        for row in each_row(parts):
            u, c = np.unique(own_digests(row)[0], return_counts=True)
            bucket = (u >> np.uint64(BITS - bits)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[starts[1:], len(u)]
            many = [zstd.compress(c[a:b].astype("<u4").tobytes()) if c[a:b].max() > 1 else None for a, b in zip(starts, ends, strict=True)]
            k = len(starts)
            yield pa.record_batch([pa.array(bucket[starts]), pa.array([row["part"]] * k, pa.int64()), pa.array([row["seq"]] * k, pa.int32()), pa.array([pack(u[a:b] & lower, width) for a, b in zip(starts, ends, strict=True)], pa.binary()), pa.array(many, pa.binary())], ["bucket", "part", "seq", "digests", "counts"])

    def count(rows: list[dict]):
        zip_, unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        h = [unpack(r["digests"], width) for r in rows]
        c = [np.frombuffer(unzip.decompress(r["counts"]), "<u4") if r["counts"] else np.ones(len(x), np.uint32) for r, x in zip(rows, h, strict=True)]
        sizes = np.array(list(map(len, h)))
        all_h = np.concatenate(h)
        order = np.argsort(all_h, kind="stable")
        own = all_h[order]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        df = np.add.reduceat(np.concatenate(c).astype(np.int64)[order], starts)
        code = np.where(df <= 128, df, np.minimum(255, 128 + np.ceil(8 * np.log2(np.maximum(df, 1) / 128)))).astype(np.uint8)
        codes = np.empty(len(own), np.uint8)
        codes[order] = np.repeat(code, np.diff(np.r_[starts, len(own)]))
        ends = np.cumsum(sizes)
        blobs = [zip_.compress(codes[e - s : e].tobytes()) for s, e in zip(sizes, ends, strict=True)]
        return pa.record_batch([pa.array([r["part"] for r in rows], pa.int64()), pa.array([r["seq"] for r in rows], pa.int32()), pa.array([r["bucket"] for r in rows], pa.int64()), pa.array(blobs, pa.binary())], ["part", "seq", "bucket", "codes"])

    def answer(parts):
        held: list[dict] = []
        for part in parts:
            for row in part.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield count(held)
                    held = []
                held.append(row)
        if held:
            yield count(held)

    sent = sets.joined(reps.select("part", "seq", "at")).select("part", "seq", "n", "digests", "v0").mapInArrow(send, "bucket long, part long, seq int, digests binary, counts binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, "part long, seq int, bucket long, codes binary")


def order_keys(h: np.ndarray, codes: np.ndarray, order: int) -> np.ndarray:
    """The place of digests in a global order: those of one class first, then by frequency (exactly, by doublings, or not at all), then by a hash of the order's own."""
    rank = codes if order == 0 else np.log2(np.maximum(codes, 1)).astype(np.uint8) + (codes > 1) if order == 1 else codes > 1
    return (rank.astype(np.uint64) << np.uint64(56)) | (mix64(h ^ np.uint64(SALTS[order])) >> np.uint64(8))


def prefix_sizes(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(n > 0, n - (n * num + den - 1) // den + 1, 0)


def postings(sets: SetTable, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (doc, n, prefix, marks, digests) of the classes with shared digests in their prefixes: those of the first order, 2-byte marks of those of each further one, the packed set."""

    def run(parts):
        unzip = zstandard.ZstdDecompressor()
        for row in each_row(parts):
            h, doc = own_digests(row)
            known = b"".join(unzip.decompress(x["codes"]) for x in sorted(row["v1"], key=lambda x: x["bucket"]))
            codes = np.frombuffer(known, np.uint8)[np.unique(h, return_inverse=True)[1]]
            n = np.bincount(doc, minlength=len(row["n"]))
            room = prefix_sizes(n, num, den) - np.bincount(doc, weights=codes == 1, minlength=len(n)).astype(np.int64)
            some = (codes > 1) & (room > 0)[doc]
            d, own, c = doc[some], h[some], codes[some]
            if not len(d):
                continue
            docs, begins, sizes = np.unique(d, return_index=True, return_counts=True)
            take = np.minimum(room[docs], sizes)
            kept = np.arange(len(d)) - np.repeat(begins, sizes) < np.repeat(take, sizes)
            prefixes = [own[np.lexsort((order_keys(own, c, order), d))][kept] for order in range(len(SALTS))]
            ends = np.r_[0, np.cumsum(take)]
            values = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(prefixes[0].view(np.int64)))
            marks = [(p >> np.uint64(30)).astype("<u2") for p in prefixes[1:]]
            blobs = [b"".join(m[i:j].tobytes() for m in marks) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            at = np.searchsorted(doc, docs)
            packed = [pack(h[a : a + k]) for a, k in zip(at, n[docs], strict=True)]
            yield pa.record_batch([pa.array([row["ids"][i] for i in docs], pa.int64()), pa.array(n[docs].astype(np.int64)), values, pa.array(blobs, pa.binary()), pa.array(packed, pa.binary())], ["doc", "n", "prefix", "marks", "digests"])

    known = sets.joined(reps.select("part", "seq", "at"), frequency_codes(sets, reps))
    return known.select("ids", "n", "digests", "v0", "v1").mapInArrow(run, "doc long, n long, prefix array<long>, marks binary, digests binary")


def marks_of(blob: bytes) -> np.ndarray:
    """A row of marks for each further order."""
    return np.frombuffer(blob, "<u2").reshape(len(SALTS) - 1, -1)


def screened(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """The pairs (a, b) that share a mark under every further order: a few hundred bytes a document decide before any set is read."""

    def run(parts):
        for part in parts:
            marks = ((marks_of(x), marks_of(y)) for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True))
            ok = [all(len(np.intersect1d(p, q)) for p, q in zip(x, y, strict=True)) for x, y in marks]
            yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left, right = (entries.select(F.col("doc").alias(k), F.col("marks").alias(m)) for k, m in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, entries: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are links."""

    def run(parts):
        for part in parts:
            ok = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                common = len(np.intersect1d(unpack(x), unpack(y), assume_unique=True))
                ok.append(den * common >= num * ((len(x) + len(y)) // (BITS // 8) - common))
            yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left, right = (entries.select(F.col("doc").alias(k), F.col("digests").alias(m)) for k, m in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class Members:
    """Documents of a list, with numbers in place of marks and digests."""

    def __init__(self, rows: list[dict]):
        self.doc, self.n, self.component, self.block = (np.array([r[c] for r in rows]) for c in ("doc", "n", "component", "block"))
        self.values, self.starts = [], []
        marks = [marks_of(r["marks"]) for r in rows]
        for items in (*([m[k] for m in marks] for k in range(len(SALTS) - 1)), [unpack(r["digests"]) for r in rows]):
            self.starts.append(np.r_[0, np.cumsum(list(map(len, items)))])
            self.values.append(np.unique(np.concatenate(items), return_inverse=True)[1])

    def shared(self, kind: int, i: int) -> np.ndarray:
        """How many items each member has in common with member i."""
        values, starts = self.values[kind], self.starts[kind]
        flag = np.zeros(values.max(initial=0) + 1, bool)
        flag[values[starts[i] : starts[i + 1]]] = True
        return np.add.reduceat(flag[values], starts[:-1], dtype=np.int64)


def links_of(rows: list[dict], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest (a, b) of the links between members of different components, of one block or (with bi <> bj) of two."""
    all_ = Members(rows)
    within = rows[0]["bi"] == rows[0]["bj"]
    names, sizes = np.unique(all_.component, return_counts=True)
    found = []
    for i in np.flatnonzero(all_.component != names[sizes.argmax()]):  # pairs inside the largest component are linked already
        ok = (all_.component != all_.component[i]) & (num * np.maximum(all_.n, all_.n[i]) <= den * np.minimum(all_.n, all_.n[i]))
        if not within:
            ok &= all_.block != all_.block[i]
        for order in range(len(SALTS) - 1):
            if ok.any():
                ok &= all_.shared(order, i) > 0
        if ok.any():
            common = all_.shared(len(SALTS) - 1, i)
            ok &= den * common >= num * (all_.n + all_.n[i] - common)
            found.append(np.stack([np.full(ok.sum(), i), np.flatnonzero(ok)]))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    root = forest(len(rows), a, b)
    own = np.flatnonzero(root != np.arange(len(rows)))
    return all_.doc[own], all_.doc[root[own]]


def block_links(members: DataFrame, entries: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) inside long lists, from rows (token, doc, n, component, m, words): in memory, a pair of bounded blocks at a time."""

    def run(parts):
        held: list[dict] = []

        def links(rows):
            a, b = links_of(rows, num, den)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for part in parts:
            for row in part.to_pylist():
                if held and any(held[0][c] != row[c] for c in ("token", "bi", "bj")):
                    yield links(held)
                    held = []
                held.append(row)
        if held:
            yield links(held)

    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("words") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(entries.select("doc", "marks", "digests"), "doc").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("token", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "doc", "n", "component", "marks", "digests")
    keys = ("token", "bi", "bj")
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def alike(n: str, other: str, num: int, den: int) -> Column:
    """Whether sets of two sizes can be a link."""
    return F.expr(f"{num} * greatest({n}, {other}) <= {den} * least({n}, {other})")


def posting_lists(entries: DataFrame) -> DataFrame:
    """Rows (token, doc, n, m, words, pivot, pivot_n): members of posting lists of two or more, each set of members once. Sums go before the shuffle, so no list is ever one task's."""
    each = entries.select("doc", "n", F.explode("prefix").alias("token"))
    members = F.bit_xor(F.xxhash64("doc")).alias("x0"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("x1")
    lists = each.groupBy("token").agg(F.count("*").alias("m"), F.sum("n").alias("words"), *members, F.min(F.struct("doc", "n")).alias("pivot")).filter("m > 1")
    lists = lists.groupBy("m", "words", "x0", "x1", "pivot").agg(F.min("token").alias("token"))
    return each.join(lists.select("token", "m", "words", F.col("pivot.doc").alias("pivot"), F.col("pivot.n").alias("pivot_n")), "token")


@contextmanager
def small_batches(spark, size: str = "2m") -> Iterator[None]:
    """Arrow batches of `size` for the jobs that run inside, as their rows are large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for every row of `docs(doc_id, text)`; links are similarities of num/den or more."""
    with small_batches(docs.sparkSession):
        return _components(docs, width, num, den)


def _components(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    sets = SetTable(docs, width)
    nodes = cut(sets.documents())
    classes = nodes.filter("n > 0 and doc_id is not null").groupBy("n", "f0", "f1").agg(F.min(F.struct("doc_id", "part", "seq", "at")).alias("r"))
    reps = cut(classes.select("n", "f0", "f1", "r.*"))
    entries = cut(postings(sets, reps, num, den))
    sets.drop()
    lists = cut(posting_lists(entries))
    star = lists.filter((F.col("doc") > F.col("pivot")) & alike("n", "pivot_n", num, den)).select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    so_far = cut(min_label_components(cut(verified(cut(screened(star, entries)), entries, num, den))))
    # Lists of two have been compared; of longer ones, what isn't connected yet.
    rest = lists.filter("m > 2").join(so_far.withColumnRenamed("id", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    mixed = rest.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token")
    rest = cut(rest.join(mixed, "token").select("token", "doc", "n", "component", "m", "words", "pivot"))
    short = rest.filter((F.col("m") <= SMALL) & (F.col("doc") != F.col("pivot"))).select("token", "doc", "n", "component")
    other = short.select("token", F.col("doc").alias("b"), F.col("n").alias("other_n"), F.col("component").alias("other_component"))
    pairs = short.join(other, "token").filter((F.col("doc") < F.col("b")) & (F.col("component") != F.col("other_component")) & alike("n", "other_n", num, den))
    pairs = cut(screened(pairs.select(F.col("doc").alias("a"), "b").distinct(), entries))
    more = cut(verified(pairs, entries, num, den).union(block_links(rest.filter(F.col("m") > SMALL), entries, num, den)))
    # Components of components: only links between them are left to follow.
    name = lambda k: so_far.select(F.col("id").alias(k), F.col("component").alias(f"c{k}"))
    across = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    last = cut(min_label_components(across)).select(F.col("id").alias("c"), F.col("component").alias("top"))
    found = reps.join(so_far.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id")).drop("component")
    found = found.join(last, "c", "left").select(F.col("n").alias("rn"), F.col("f0").alias("r0"), F.col("f1").alias("r1"), F.coalesce("top", "c").alias("component"))
    same = (F.col("n") == F.col("rn")) & (F.col("f0") == F.col("r0")) & (F.col("f1") == F.col("r1")) & F.col("doc_id").isNotNull()
    out = nodes.select("doc_id", "n", "f0", "f1").join(found, same, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
