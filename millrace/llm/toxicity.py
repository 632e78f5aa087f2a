"""Convolutional text classifier in numpy: hashed word embeddings, filters of several widths, max pooling.

A word's vector is the sum of a row hashed from the word and one hashed from its first bytes, so that inflected and
compound forms share what they have learned. Only texts are inputs of a score; the language serves to
choose the threshold that turns a score into a decision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, as_documents, slices, small_batches, text_buffers, written


@dataclass
class Settings:
    """Parameters of the classifier. sample, sample_bytes: labelled texts of each class that are learned from, and their bytes of text, at most."""

    sample: int = 6000
    sample_bytes: int = 16 << 20
    buckets: int = 1 << 16
    prefix: int = 4
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 6
    #: Few texts are gone through more often, until so many steps.
    steps: int = 1200
    batch: int = 32
    rate: float = 0.02
    seed: int = 7
    #: Calibration texts of each class that a language needs for a threshold of its own.
    per_language: int = 20


def features(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and prefix buckets of consecutive texts, and where each text's words begin (n + 1)."""
    w = Words(*text_buffers(texts), prefix=s.prefix)
    low = np.uint64(s.buckets - 1)
    return (w.hash & low).astype(np.int32), ((w.prefix_hash >> np.uint64(20)) & low).astype(np.int32), w.first


@dataclass
class Model:
    settings: Settings
    words: np.ndarray
    prefixes: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @classmethod
    def new(cls, s: Settings) -> Model:
        r = np.random.default_rng(s.seed)
        rows = lambda: np.vstack([r.normal(0, 0.1, (s.buckets, s.dim)), np.zeros((1, s.dim))]).astype(np.float32)  # noqa: E731  the last is padding
        kernels = [r.normal(0, (2 / (s.dim * w)) ** 0.5, (w, s.dim, s.filters)).astype(np.float32) for w in s.widths]
        return cls(s, rows(), rows(), kernels, [np.zeros(s.filters, np.float32) for _ in s.widths], r.normal(0, 0.3, (len(s.widths) * s.filters)).astype(np.float32), -0.5)

    def padded(self, words: np.ndarray, prefixes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts with padding behind each, so that every window of the widest filter stays within one text."""
        pad, n = max(self.settings.widths), len(first) - 1
        begin = first[:-1] + pad * np.arange(n)
        size = np.diff(first)
        at = np.repeat(begin - first[:-1], size) + np.arange(len(words))
        out = [np.full(len(words) + pad * n, self.settings.buckets, np.int32) for _ in range(2)]
        out[0][at], out[1][at] = words, prefixes
        return out[0], out[1], begin

    def per_text(self, take: np.ufunc, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """A reduction over the windows of each text: those that begin at its words or its first padding, as later ones reach the next text."""
        end = np.append(begin[1:], len(values)) - max(self.settings.widths) + 1
        return take.reduceat(values, np.stack([begin, end], axis=1).ravel(), axis=0)[::2]

    def pooled(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Embedded words, each filter's largest value per text, and the values themselves."""
        x = self.words[a]
        x += self.prefixes[b]
        values = []
        for kernel, bias in zip(self.kernels, self.biases, strict=True):
            v = x @ kernel[0]
            for j in range(1, len(kernel)):
                v[:-j] += x[j:] @ kernel[j]
            v += bias
            values.append(v)
        return x, np.concatenate([self.per_text(np.maximum, v, begin) for v in values], axis=1), values

    def scores(self, words: np.ndarray, prefixes: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        _, top, _ = self.pooled(*self.padded(words, prefixes, first))
        return 1 / (1 + np.exp(-np.clip(np.maximum(top, 0).astype(np.float64) @ self.out + self.offset, -30, 30)))

    def step(self, words: np.ndarray, prefixes: np.ndarray, first: np.ndarray, y: np.ndarray, memory: dict) -> None:
        """One Adagrad step. Max pooling passes a gradient on to one window of each text and filter."""
        s = self.settings
        a, b, begin = self.padded(words, prefixes, first)
        x, top, values = self.pooled(a, b, begin)
        hidden = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.offset, -30, 30)))
        d = ((p - y) / len(y)).astype(np.float32)
        through = d[:, None] * self.out[None] * (top > 0)
        size = np.diff(np.append(begin, len(a)))
        grads = {"out": hidden.T @ d + 1e-5 * self.out, "offset": np.array([d.sum()], np.float32)}
        rows, steps = [], []
        for k, (v, kernel) in enumerate(zip(values, self.kernels, strict=True)):
            part = slice(k * s.filters, (k + 1) * s.filters)
            hit = v == np.repeat(top[:, part], size, axis=0)
            where = np.stack([self.per_text(np.minimum, np.where(hit[:, f], np.arange(len(v)), len(v)), begin) for f in range(s.filters)], axis=1)
            g = through[:, part]
            grads[f"bias{k}"] = g.sum(0)
            grads[f"kernel{k}"] = np.zeros_like(kernel)
            for j in range(len(kernel)):
                at = np.minimum(where + j, len(a) - 1)
                grads[f"kernel{k}"][j] = np.einsum("bfd,bf->df", x[at], g)
                rows.append(at.ravel())
                steps.append((g[:, :, None] * kernel[j].T[None]).reshape(-1, s.dim))
        at, g = np.concatenate(rows), np.concatenate(steps)
        used = np.abs(g).sum(1) > 0
        for name, table, bucket in (("words", self.words, a[at[used]]), ("prefixes", self.prefixes, b[at[used]])):
            own, inverse = np.unique(bucket, return_inverse=True)
            total = np.zeros((len(own), s.dim), np.float32)
            np.add.at(total, inverse, g[used])
            total[own == s.buckets] = 0
            seen = memory.setdefault(name, np.zeros((s.buckets + 1, 1), np.float32))
            seen[own] += (total**2).mean(1, keepdims=True)
            table[own] -= s.rate * 2 * total / np.sqrt(seen[own] + 1e-10)
        for name, g in grads.items():
            seen = memory.setdefault(name, np.zeros_like(g))
            seen += g * g
            change = s.rate * g / np.sqrt(seen + 1e-8)
            if name == "offset":
                self.offset -= float(change[0])
            elif name == "out":
                self.out -= change
            else:
                (self.biases if name.startswith("bias") else self.kernels)[int(name[-1])] -= change

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
        s, r, memory = self.settings, np.random.default_rng(self.settings.seed + 1), {}
        for _ in range(max(s.epochs, -(-s.steps * s.batch // len(texts)))):
            order = r.permutation(len(texts))
            for k in range(0, len(order), s.batch):
                part = order[k : k + s.batch]
                own = [texts[i] for i in part]
                first = np.concatenate([[0], np.cumsum([len(w) for w, _ in own])])
                self.step(np.concatenate([w for w, _ in own]), np.concatenate([p for _, p in own]), first, y[part].astype(np.float32), memory)

    def calibrate(self, scores: np.ndarray, y: np.ndarray, languages: list) -> None:
        """Thresholds of best F1, one over all and one for each language with enough texts of both classes."""
        self.threshold = best_threshold(scores, y)
        lang = np.array([x or "" for x in languages], object)
        for x in set(lang):
            own = lang == x
            if min(y[own].sum(), (1 - y[own]).sum()) >= self.settings.per_language:
                self.thresholds[x] = best_threshold(scores[own], y[own])


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest run of thresholds in [0.2, 0.9] that share the best F1; 0.5 without both classes."""
    if not 0 < y.sum() < len(y):
        return 0.5
    grid = np.linspace(0.2, 0.9, 71)
    f1 = np.array([2 * (y * (scores >= t)).sum() / max(1, (scores >= t).sum() + y.sum()) for t in grid])
    return float(np.median(grid[f1 >= f1.max() - 1e-12]))


def fitting(sizes: list[tuple[int, int]], most: int) -> list[int]:
    """The keys of (key, size) that fit into `most` one after another, those that don't fit passed over; the smallest if none fits."""
    out, left = [], most
    for key, size in sizes:
        if size <= left:
            out.append(key)
            left -= size
    return out or [key for key, _ in sorted(sizes, key=lambda x: x[1])[:1]]


def train(docs: DataFrame, labels: DataFrame, learn: str = "true", settings: Settings | None = None) -> Model:
    """Learns from at most settings.sample texts of either label among the documents where the SQL condition `learn` on doc_id holds.

    The sample is the texts of least hash of doc_id: the same however the table is laid out. An id whose texts don't fit into what is left of settings.sample_bytes
    is passed over, so that what the driver holds is bounded and no long text ends the sample; if none of a class fits, its shortest is learned from.
    A fifth of it sets the thresholds. Null labels and ids, and labels without a document, are left out; of labels that disagree on a document the larger counts.
    If one of the classes has no labelled document at all, nothing can be learned: every score is 0.5 or less.
    """
    s = settings or Settings()
    marks = as_documents(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.join(as_documents(docs, "doc_id"), "doc_id", "left_semi")
    chosen = None
    for c in (0, 1):
        part = marks.where(F.col("toxic") == c).select("doc_id", "toxic", F.xxhash64("doc_id").alias("order")).orderBy("order", "doc_id").limit(s.sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = as_documents(docs, "doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")  # at most 2 * s.sample rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                a, b, first = features(part.column("text"), s)
                cut = lambda x: pa.array([x[i:j].astype(np.int32).tobytes() for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary())  # noqa: E731,B023
                size = pa.array(np.diff(text_buffers(part.column("text"))[1]))
                yield pa.RecordBatch.from_arrays([part.column("order"), part.column("toxic").cast(pa.int32()), part.column("lang"), cut(a), cut(b), size], names=["order", "toxic", "lang", "a", "b", "size"])

    found = rows.mapInArrow(run, "order long, toxic int, lang string, a binary, b binary, size long")
    found = written(found, "labelled")
    sizes = sorted(tuple(r) for r in found.groupBy("toxic", "order").agg(F.sum("size")).collect())  # three numbers of each of the sample's texts
    fit = [(c, order) for c in (0, 1) for order in fitting([(order, size) for toxic, order, size in sizes if toxic == c], s.sample_bytes)]
    fit = F.broadcast(found.sparkSession.createDataFrame(fit, "toxic int, order long"))  # at most 2 * s.sample rows
    got = sorted(found.join(fit, ["toxic", "order"]).select("order", "toxic", "lang", "a", "b").collect(), key=lambda r: (r[0], r[3]))
    model = Model.new(s)
    texts = [(np.frombuffer(r[3], np.int32), np.frombuffer(r[4], np.int32)) for r in got]
    y = np.array([r[1] for r in got], np.int64)
    aside = np.arange(len(got)) % 5 == 4
    if len(got) and 0 < y.sum() < len(y):
        model.fit([t for t, k in zip(texts, aside, strict=True) if not k], y[~aside])
        scores = np.array([model.scores(*t, np.array([0, len(t[0])]))[0] for t, k in zip(texts, aside, strict=True) if k])
        model.calibrate(scores, y[aside], [r[2] for r, k in zip(got, aside, strict=True) if k])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, score (0 to 1) and toxic (score at least its language's threshold) of every whole text.

    Null and empty texts are scored as texts without words; a null or new language has the common threshold.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # settings fix its size: 2 * buckets * dim floats
    kind = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                got = m.scores(*features(part.column("text"), m.settings))
                lang = part.column("lang").to_pylist()
                limit = np.array([m.thresholds.get(x or "", m.threshold) for x in lang])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(got), pa.array(got >= limit)], names=out.names)

    return as_documents(docs, "doc_id", "text", "lang").mapInArrow(run, out)


def remove_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic by their language's threshold, all columns kept, in one pass."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    names = docs.columns
    text, lang = names.index("text"), names.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for part in slices(batch.rename_columns([str(i) for i in range(len(names))]), str(text), 1 << 20):
                got = m.scores(*features(part.column(text), m.settings))
                limit = np.array([m.thresholds.get(x or "", m.threshold) for x in part.column(lang).to_pylist()])
                yield part.filter(pa.array(got < limit)).rename_columns(names)

    return docs.mapInArrow(run, docs.schema)
