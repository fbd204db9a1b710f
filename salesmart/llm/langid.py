"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of a fixed-length window, each filter's largest
response is kept, and a softmax layer turns these into language probabilities.  The network is
trained in numpy on a bounded sample of labelled texts and applied to every window of every text.

A filter over one-hot bytes is a sum of table look-ups, one for each place of the filter.  For
prediction neighbouring places are merged into tables over byte pairs, so a filter of width 4 costs
two look-ups a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import bounded, raw_bytes, slices, stage

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
UNDETERMINED = "und"
PARTS = 64  # of a language's texts, for the draw
CHOSEN = 1_000_000  # rows of the sample that are broadcast; a larger one is joined by a shuffle
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """languages: the classes; conv[w]: (w, 256, filters); bias: (all filters,); dense, out: softmax layer."""

    languages: list[str]
    conv: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (n, length) of bytes -> largest response of each filter and where it is."""
        tops, places = [], []
        for t in self.conv:
            w = t.shape[0]
            n = x.shape[1] - w + 1
            r = t[0][x[:, :n]]
            for j in range(1, w):
                r = r + t[j][x[:, j:j + n]]
            at = r.argmax(1)
            places.append(at)
            tops.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
        return np.concatenate(tops, 1), np.concatenate(places, 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cut_windows(text: bytes, window: int = WINDOW) -> list[bytes]:
    """Consecutive windows that cover the whole text; the last one is moved back to be full, a short text padded."""
    if len(text) <= window:
        return [text.ljust(window, b" ")]
    return [text[i:i + window] for i in range(0, len(text) - window, window)] + [text[-window:]]


def train(texts: list[bytes], labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01,
          windows_each: int = 2, seed: int = 7) -> Network:
    """Fit the network with Adam; gradients pass through max pooling to the winning window only."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    rows, y = [], []
    for text, label in zip(texts, labels, strict=True):
        cut = cut_windows(text)
        for k in rng.permutation(len(cut))[:windows_each]:
            rows.append(np.frombuffer(cut[k], np.uint8))
            y.append(languages.index(label))
    x, y = np.stack(rows), np.array(y)
    total = FILTERS * len(WIDTHS)
    net = Network(languages, [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(total, np.float32),
                  rng.normal(0, 0.1, (total, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    share = np.bincount(y, minlength=len(languages)) / len(y)
    weight = (1 / (len(languages) * share))[y].astype(np.float32)  # each language counts the same
    params = [*net.conv, net.bias, net.dense, net.out]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            i = order[at:at + batch]
            xb = x[i]
            top, place = net.pooled(xb)
            hidden = np.maximum(top + net.bias, 0)
            p = _softmax(hidden @ net.dense + net.out)
            p[np.arange(len(i)), y[i]] -= 1
            g = p * (weight[i] / len(i))[:, None]
            gh = (g @ net.dense.T) * (hidden > 0)
            grads = []
            for k, w in enumerate(WIDTHS):
                gk, pk = gh[:, k * FILTERS:(k + 1) * FILTERS], place[:, k * FILTERS:(k + 1) * FILTERS]
                gc = np.zeros_like(net.conv[k])
                for j in range(w):
                    np.add.at(gc[j], (np.take_along_axis(xb, pk + j, 1), np.arange(FILTERS)[None, :]), gk)
                grads.append(gc)
            grads += [gh.sum(0), hidden.T @ g, g.sum(0)]
            t += 1
            for q, gq, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (gq - m)
                v += 0.01 * (gq * gq - v)
                q -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return net


class Predictor:
    """Applies a network to batches of texts; holds the byte-pair tables."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.pairs = [[(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < len(t) else t[j] for j in range(0, len(t), 2)] for t in net.conv]

    def windows(self, x: np.ndarray) -> np.ndarray:
        """(n, window) bytes -> (n, languages) probabilities."""
        wide = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        tops = []
        for w, tables in zip(WIDTHS, self.pairs, strict=True):
            n = x.shape[1] - w + 1
            r = None
            for k, t in enumerate(tables):
                src = wide if len(t) == 65536 else x
                part = t.take(src[:, 2 * k:2 * k + n], axis=0)
                r = part if r is None else np.add(r, part, out=r)
            tops.append(r.max(1))
        hidden = np.maximum(np.concatenate(tops, 1) + self.net.bias, 0)
        return _softmax(hidden @ self.net.dense + self.net.out)

    def texts(self, texts: list[bytes], step: int = 128) -> np.ndarray:
        """Mean window probabilities of each text."""
        cut = [cut_windows(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        flat = [w for c in cut for w in c]
        total = np.zeros((len(texts), len(self.net.languages)))
        for at in range(0, len(flat), step):
            x = np.frombuffer(b"".join(flat[at:at + step]), np.uint8).reshape(-1, WINDOW)
            np.add.at(total, owner[at:at + step], self.windows(x))
        return total / total.sum(1, keepdims=True) if len(texts) else total


def fit(labelled: DataFrame, per_language: int = 1500, max_bytes: int = 4096, seed: int = 7) -> Network | None:
    """Train on a bounded sample: ``per_language`` different texts of each language (all, if it has fewer), those of the smallest hashes.

    labelled: (text, lang); rows with a null or letterless text or a null lang are left out.  Of a long
    sampled text ``max_bytes`` from its middle are used for training.  None if nothing is left.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).filter("lang is not null").filter(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    texts = rows.select("lang", "h").distinct().withColumn("part", F.pmod("h", F.lit(PARTS)))
    # The smallest of each part of a language, then of the language: no task sees all of a large language.
    for keys in (["lang", "part"], ["lang"]):
        texts = texts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).filter(F.col("rank") <= per_language)
    chosen = bounded(stage(texts.select("lang", "h"), "langid-sample"), CHOSEN)
    start = F.greatest(F.lit(1), (F.char_length("text") - max_bytes) / 2).cast("int")
    picked = rows.join(chosen, ["lang", "h"]).select("lang", "h", F.substring(F.col("text"), start, F.lit(max_bytes)).alias("text"))
    got = picked.groupBy("lang", "h").agg(F.min("text").alias("text")).select("text", "lang").toArrow().to_pydict()
    got = sorted(zip(got["text"], got["lang"], strict=True))
    if not got:
        return None
    return train([t.encode() for t, _ in got], [lang for _, lang in got], seed=seed)


def identify(docs: DataFrame, net: Network | None, *keep: str | Column, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Documents with a column text -> the columns ``keep``, lang_pred and score (or other ``names``), one row for each input row.

    lang_pred is the language with the largest mean probability over all windows of the text, score
    that probability.  A text that is null or has no letter, and every text if there is no network,
    gives ``und`` with score 0.
    """
    kept = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = kept.drop("__text").schema.add(names[0], "string").add(names[1], "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Predictor(net) if net else None
        for b in slices(batches):
            texts = raw_bytes(b, "__text")
            lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            able = [i for i, t in enumerate(texts) if t and _LETTER.search(t.decode())] if model else []
            if able:
                p = model.texts([texts[i] for i in able])
                for i, k, s in zip(able, p.argmax(1), p.max(1), strict=True):
                    lang[i], score[i] = model.net.languages[k], s
            at = b.schema.get_field_index("__text")
            cols = [b.column(i) for i in range(b.num_columns) if i != at]
            kept_names = [n for n in b.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(np.minimum(score, 1.0))], [*kept_names, *names])

    return kept.mapInArrow(run, schema)
