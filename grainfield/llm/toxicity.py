"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the row of a table that its hash picks. Rows of words that few training documents hold stay zero; the
others start from the log odds of their classes, and noise. Filters of widths 1, 2 and 3 run over the whole text and never into
its neighbours in a batch, each keeps its maximum, and a logistic layer turns the maxima into a score. Training takes a documented, bounded sample of labelled documents (`rows` of each class), on the driver; the trained tables have a fixed size and go out
as a broadcast. For each language a threshold is calibrated on a part of the sample that training never sees; it decides
`rejected`, while the score itself never sees language, source, id or label.

Cases: null and empty texts are padding only and get the score of nothing; languages with few calibration rows, and null ones,
take the threshold over all languages; without labelled rows of both classes every score is 0; texts of any length
are scored whole; equal texts get equal scores, whatever stands beside them; null ids and repeated rows are scored like any;
an empty table gives no rows; other columns pass through, but for ones named toxicity or rejected, which are replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import batches_by_size
from .common import Memo
from .labelled import labelled_sample

BUCKETS = 1 << 18
WORD = re.compile(r"\w+")
WIDTHS = (1, 2, 3)
SEEN = 3  # documents of the sample that hold a word, for it to be learnt


def word_bucket(word: str) -> int:
    """Row of the table for a word; row 0 is the padding's."""
    return 1 + zlib.crc32(word.encode()) % (BUCKETS - 1)


def tokens(texts: list[str], memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the distinct words, word number of each position, first position of each text). Each text ends in padding, word 0."""
    numbers: dict[str, int] = {"": 0}
    flat: list[int] = []
    starts = []
    pad = [0] * max(WIDTHS)
    for text in texts:
        starts.append(len(flat))
        flat.extend([numbers.setdefault(w, len(numbers)) for w in WORD.findall(text.lower())])
        flat.extend(pad)
    buckets = np.array([0, *(memo[w] for w in list(numbers)[1:])], dtype=np.int64)
    return buckets, np.array(flat, dtype=np.int64), np.array(starts, dtype=np.int64)


def outside(starts: np.ndarray, n: int) -> np.ndarray:
    """Positions whose windows could reach into the next text: all of the padding but its first."""
    ends = np.r_[starts[1:], n]
    return np.concatenate([ends - k for k in range(1, max(WIDTHS))])


class ConvNet:
    def __init__(self, dim: int = 12, filters: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = np.zeros((BUCKETS, dim), np.float32)
        self.filters = {w: rng.normal(0, 0.2, (w, dim, filters)).astype(np.float32) for w in WIDTHS}
        for w in WIDTHS:
            self.filters[w][0, 0] = np.abs(self.filters[w][0, 0]) + 0.2
        self.bias = {w: np.full(filters, -0.2, np.float32) for w in WIDTHS}
        self.out, self.offset = np.full(filters * len(WIDTHS), 0.1, np.float32), np.float32(-1)

    def _start(self, texts: list[str], labels: np.ndarray, memo: Memo, seed: int) -> None:
        seen = np.zeros((2, BUCKETS), np.float32)
        for text, label in zip(texts, labels, strict=True):
            seen[label, list({memo[w] for w in WORD.findall(text.lower())})] += 1
        n = np.bincount(labels, minlength=2)
        odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))
        self.learnt = seen.sum(0) >= SEEN
        self.learnt[0] = False
        rows = np.flatnonzero(self.learnt)
        self.table[rows] = np.random.default_rng(seed).normal(0, 0.02, (len(rows), self.table.shape[1]))
        self.table[rows, 0] = odds[rows] * (seen.sum(0)[rows] / (seen.sum(0)[rows] + 10))

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int = 8, batch: int = 48, rate: float = 0.01, decay: float = 1e-4, clean: float = 3.0, seed: int = 6) -> ConvNet:
        """Adam on the log loss, clean documents weighing `clean` times the toxic ones; the maxima pass gradients to one position per filter and text."""
        rng, memo = np.random.default_rng(seed), Memo(word_bucket, 1 << 20)
        self._start(texts, labels, memo, seed)
        weight = np.where(labels == 1, 1 / max(1, labels.sum()), clean / max(1, (1 - labels).sum())) * len(labels) / (1 + clean)
        moments: dict = {}
        step = 0
        for epoch in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                step += 1
                buckets, flat, starts = tokens([texts[i] for i in part], memo)
                x = self.table[buckets]
                x = np.concatenate([x[flat], np.zeros((max(WIDTHS), x.shape[1]), np.float32)])
                n, seg = len(flat), np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(flat)]))
                maxima, tops = [], []
                for w in WIDTHS:
                    h = sum(x[j : j + n] @ self.filters[w][j] for j in range(w)) + self.bias[w]
                    h[outside(starts, n)] = -np.inf
                    top = np.maximum.reduceat(h, starts, axis=0)
                    at = np.empty(top.shape, np.int64)
                    for f in range(h.shape[1]):
                        hit = np.flatnonzero(h[:, f] == top[seg, f])
                        at[:, f] = hit[np.unique(seg[hit], return_index=True)[1]]
                    maxima.append(np.maximum(top, 0))
                    tops.append(at)
                z = np.concatenate(maxima, axis=1)
                score = 1 / (1 + np.exp(-np.clip(z @ self.out + self.offset, -30, 30)))
                slope = ((score - labels[part]) * weight[part] / len(part)).astype(np.float32)
                grads = {"out": z.T @ slope + decay * self.out, "offset": slope.sum()}
                back = np.outer(slope, self.out) * (z > 0)
                dx: list = []
                for k, w in enumerate(WIDTHS):
                    g, at = back[:, k * self.bias[w].size : (k + 1) * self.bias[w].size], tops[k]
                    grads["bias", w] = g.sum(0)
                    grads["filters", w] = np.stack([np.einsum("nfd,nf->df", x[at + j], g) for j in range(w)]) + decay * self.filters[w]
                    dx += [((at + j).ravel(), (g[:, :, None] * self.filters[w][j].T[None]).reshape(-1, x.shape[1])) for j in range(w)]
                at, dx = np.concatenate([d[0] for d in dx]), np.concatenate([d[1] for d in dx])
                ok = at < n
                rows = buckets[flat[at[ok]]]
                known = self.learnt[rows]
                ids, inverse = np.unique(rows[known], return_inverse=True)
                sums = np.zeros((len(ids), x.shape[1]), np.float32)
                np.add.at(sums, inverse.reshape(-1), dx[ok][known])
                self._adam(moments, step, rate / (1 + epoch / 6), grads)
                self._adam_rows(moments, rate / (1 + epoch / 6), ids, sums + decay * self.table[ids])
        return self

    def _adam(self, moments: dict, step: int, rate: float, grads: dict) -> None:
        for name, g in grads.items():
            m, v = moments.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            moments[name] = m, v
            change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            if isinstance(name, tuple):
                getattr(self, name[0])[name[1]] -= change.astype(np.float32)
            else:
                setattr(self, name, (getattr(self, name) - change).astype(np.float32))

    def _adam_rows(self, moments: dict, rate: float, ids: np.ndarray, g: np.ndarray) -> None:
        v = moments.setdefault("table", np.zeros(BUCKETS, np.float32))
        v[ids] += (g * g).mean(axis=1)
        self.table[ids] -= rate * g / (np.sqrt(v[ids]) + 1e-6)[:, None]

    def weights(self) -> dict:
        """What scoring needs: the rows that were learnt, with all filters at all offsets side by side."""
        side = np.concatenate([self.filters[w][j] for w in WIDTHS for j in range(w)], axis=1)
        number = np.zeros(BUCKETS, np.int32)
        rows = np.flatnonzero(self.learnt)
        number[rows] = np.arange(1, len(rows) + 1)
        table = np.concatenate([np.zeros((1, self.table.shape[1]), np.float32), self.table[rows]])
        return {"number": number, "table": table, "side": side, "bias": np.concatenate([self.bias[w] for w in WIDTHS]), "out": self.out, "offset": self.offset, "filters": self.bias[1].size}


def score_texts(net: dict, texts: list[str], memo: Memo) -> np.ndarray:
    scores = np.zeros(len(texts))
    f = net["filters"]
    for a, b in batches_by_size(texts, 400_000):
        buckets, flat, starts = tokens(texts[a:b], memo)
        per_word = net["table"][net["number"][buckets]] @ net["side"]
        n, maxima, col = len(flat), [], 0
        for w in WIDTHS:
            h = per_word[:, col * f : (col + 1) * f][flat]
            for j in range(1, w):
                h[: n - j] += per_word[:, (col + j) * f : (col + j + 1) * f][flat[j:]]
            col += w
            h[outside(starts, n)] = -np.inf
            maxima.append(np.maximum.reduceat(h, starts, axis=0))
        z = np.maximum(np.concatenate(maxima, axis=1) + net["bias"], 0)
        scores[a:b] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64) @ net["out"].astype(np.float64) + float(net["offset"]), -30, 30)))
    return scores


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut of the fewest errors, midway between neighbouring scores; of equal ones the nearest to 0.5."""
    order = np.argsort(scores)
    s, y = scores[order], labels[order]
    errors = np.r_[0, np.cumsum(y)] + np.r_[np.cumsum((1 - y)[::-1])[::-1], 0]
    cuts = np.r_[0.0, (s[1:] + s[:-1]) / 2, 1.0] if len(s) else np.array([0.5])
    if not len(s):
        return 0.5
    ok = np.flatnonzero(errors == errors.min())
    lo, hi = cuts[ok[0]], cuts[ok[-1]]
    return float(min(max(0.5, lo), hi))


def train(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = 1500, least: int = 40) -> tuple[dict | None, dict[str, float], float]:
    """(network, thresholds by language, threshold over all) from `rows` documents of each class at most."""
    sample = sorted(labelled_sample(docs, labels, "toxic", usable, rows, True).collect(), key=lambda r: r["doc_id"])
    texts, y = [r["text"] or "" for r in sample], np.array([r["label"] for r in sample])
    if len(set(y.tolist())) < 2:
        return None, {}, 0.5
    held = np.array([zlib.crc32(b"calibrate %d" % r["doc_id"]) % 4 == 0 for r in sample])
    if len(set(y[~held].tolist())) < 2:
        held[:] = False
    net = ConvNet().fit([t for t, h in zip(texts, held, strict=True) if not h], y[~held]).weights()
    scores = score_texts(net, [t for t, h in zip(texts, held, strict=True) if h], Memo(word_bucket, 1 << 20))
    langs, truth = np.array([r["lang"] or "" for r, h in zip(sample, held, strict=True) if h]), y[held]
    overall = best_threshold(scores, truth)
    by = {lang: best_threshold(scores[langs == lang], truth[langs == lang]) for lang in set(langs.tolist()) - {""} if (langs == lang).sum() >= least}
    return net, by, overall


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = 1500, train_docs: DataFrame | None = None) -> DataFrame:
    """Columns of docs and toxicity (double), rejected (boolean) for every row of `docs(text, lang, ...)`.

    `usable` says which label rows may be learnt from; texts of `train_docs` (docs by default) are looked up by doc_id.
    """
    net, by, overall = train(docs if train_docs is None else train_docs, labels, usable, rows)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    docs = docs.drop("toxicity", "rejected")
    fields = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(parts):
        memo, model = Memo(word_bucket, 300_000), shared.value
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                texts = [t or "" for t in some.column("text").to_pylist()]
                scores = score_texts(model, texts, memo) if model else np.zeros(len(texts))
                cuts = [by.get(lang, overall) for lang in some.column("lang").to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(scores), pa.array(scores >= np.array(cuts))], [*some.schema.names, "toxicity", "rejected"])

    return docs.mapInArrow(run, fields)


def usable_rows(n: int = 5, held: int = 0) -> Column:
    from .labelled import fold

    return fold(F.col("doc_id"), n) != held
