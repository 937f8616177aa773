"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms describe form, which is what quality shows in any language: the shape of each word (case, digits, marks around
it), pairs of neighbouring shapes, repetition of the word before, and bands of length and of distinct words. Log counts,
weighted by inverse document frequency, are projected on the leading singular directions of a labelled sample. The
sample's vectors, labels and projection have a fixed bound (`rows` x `rank`) and go out as a broadcast; every document's
cosines with all of them are computed exactly, in blocks, and its nearest neighbours vote by their similarity.

Cases: null and empty texts have the terms of length 0 and are scored like any; without labelled rows nothing is known against any text and every score is 1; texts of
any length are scored whole, words of over 64 characters as consecutive pieces; equal texts get equal scores; ties among neighbours at the k-th place go by sample order;
null ids and repeated rows are scored like any; an empty table gives no rows; other columns pass through, but for one named quality, which is replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .bpe import batches_by_size
from .common import Memo
from .labelled import labelled_sample

TERMS = 2048
SHAPES = 512
RUN = re.compile(r"(.)\1+")
LONGEST = 64  # longer words, as in scripts without spaces, count as several of this length


def pieces(text: str) -> list[str]:
    """Words of a text; long ones in consecutive pieces, none left out."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def shape(word: str) -> int:
    """Number of a word's shape: letters, case, digits and marks, with runs shortened."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c if ord(c) < 128 else "*" for c in word)
    return zlib.crc32(RUN.sub(r"\1\1", kinds).encode()) % SHAPES


def term_counts(texts: list[str], memo: Memo) -> np.ndarray:
    """Log counts of the terms of each text."""
    out = np.zeros((len(texts), TERMS), dtype=np.float32)
    for a, b in batches_by_size(texts, 400_000):
        numbers: dict[str, int] = {}
        flat: list[int] = []
        sizes, distinct = [], []
        for text in texts[a:b]:
            words = pieces(text)
            own = [numbers.setdefault(w, len(numbers)) for w in words]
            flat += own
            sizes.append(len(own))
            distinct.append(len(set(own)))
        sizes, distinct = np.array(sizes), np.array(distinct)
        word, shapes = np.array(flat, dtype=np.int64), np.array([memo[w] for w in numbers], dtype=np.int64)
        doc = np.repeat(np.arange(b - a), sizes)
        same = doc[1:] == doc[:-1]
        s = shapes[word] if len(word) else word
        pair = SHAPES + (s[:-1] * 31 + s[1:] * 17) % (TERMS - SHAPES - 64)
        repeat = np.full(int((same & (word[1:] == word[:-1])).sum()), TERMS - 1)
        n = b - a
        keys = np.concatenate([doc * TERMS + s, doc[1:][same] * TERMS + pair[same], doc[1:][same & (word[1:] == word[:-1])] * TERMS + repeat])
        counts = np.bincount(keys, minlength=n * TERMS).reshape(n, TERMS).astype(np.float32)
        share = counts / np.maximum(1, sizes)[:, None]
        weights = np.log1p(share * 50)
        weights[np.arange(n), TERMS - 64 + np.minimum(20, np.log2(sizes + 1).astype(int))] = 1.5
        weights[np.arange(n), TERMS - 40 + np.minimum(10, (10 * distinct / np.maximum(1, sizes)).astype(int))] = 1.5
        out[a:b] = weights
    return out


class Neighbours:
    """Projection and labelled vectors of a sample."""

    def __init__(self, texts: list[str], labels: np.ndarray, rank: int, seed: int = 3):
        x = term_counts(texts, Memo(shape, 1 << 20))
        self.idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.2
        x *= self.idf
        x /= np.maximum(1e-9, np.linalg.norm(x, axis=1))[:, None]
        q = np.random.default_rng(seed).standard_normal((TERMS, rank + 10)).astype(np.float32)
        for _ in range(6):  # subspace iteration for the leading right singular vectors
            q = np.linalg.qr(x.T @ (x @ q))[0]
        u, _, vt = np.linalg.svd(x @ q, full_matrices=False)
        self.project = (q @ vt.T)[:, :rank].astype(np.float32)
        self.vectors, self.labels = self._unit(x @ self.project), labels.astype(np.float64)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(1e-9, np.linalg.norm(x, axis=1))[:, None]

    def score(self, texts: list[str], memo: Memo, k: int, block: int = 256) -> np.ndarray:
        out = np.zeros(len(texts))
        for at in range(0, len(texts), block):
            x = self._unit((term_counts(texts[at : at + block], memo) * self.idf) @ self.project)
            cosines = x @ self.vectors.T
            near = np.argpartition(-cosines, min(k, cosines.shape[1] - 1), axis=1)[:, :k] if cosines.shape[1] > k else np.tile(np.arange(cosines.shape[1]), (len(x), 1))
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(np.float64) ** 8
            out[at : at + block] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0, 1)


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = 4000, rank: int = 48, k: int = 15, train_docs: DataFrame | None = None) -> DataFrame:
    """Columns of docs and quality (double) for every row of `docs(text, ...)`. `usable` and `train_docs` as in score_toxicity()."""
    source = docs if train_docs is None else train_docs
    sample = sorted(labelled_sample(source, labels, "quality", usable, rows, False).collect(), key=lambda r: r["doc_id"])
    model = Neighbours([r["text"] or "" for r in sample], np.array([r["label"] for r in sample]), min(rank, len(sample))) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("quality")
    fields = T.StructType([*docs.schema.fields, T.StructField("quality", T.DoubleType())])

    def run(parts):
        memo, found = Memo(shape, 400_000), shared.value
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                texts = [t or "" for t in some.column("text").to_pylist()]
                scores = found.score(texts, memo, k) if found else np.ones(len(texts))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(scores)], [*some.schema.names, "quality"])

    return docs.mapInArrow(run, fields)
