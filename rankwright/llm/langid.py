"""Language identification with a byte convolutional network.

Model: the UTF-8 bytes of a text in fixed-length windows; filters of several widths over
one-hot bytes, maximum over the window, softmax over the languages; trained in numpy with
Adam.  A text's prediction is the mean of its windows' probabilities, weighted by the
letter bytes in each window, so every window of the whole text counts.

Training rows are a bounded sample: per language about ``per_language`` documents,
chosen by a hash of the id at a rate from the language's count (documented parameters of
``sample``), at most ``max_languages`` languages, and of each chosen text a bounded number of
windows spread over the whole text.  Rows of the held-out quarter
(``crc32(doc_id) mod 4 = 2``) are never used.

Edge cases: null texts and texts without a letter are ``und`` with score 0; texts of
any length are read whole; without a single training row every text is ``und``;
repeated rows give equal results; other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 256
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def sample(docs: DataFrame, per_language: int = 600, max_languages: int = 200) -> DataFrame:
    """Bounded training sample ``(text, lang)``: about ``per_language`` rows of each of the
    ``max_languages`` most frequent languages, in expectation, by a hash of ``doc_id``."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return rows.select("text", "lang").where(F.lit(False))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30))
    keep = F.lit(False)
    for r in counts:
        rate = min(1.0, per_language / r["count"])
        keep = keep | ((F.col("lang") == r["lang"]) & (draw < int(rate * (1 << 30))))
    # a multiple of the expected size bounds what reaches the driver whatever the ids are
    return rows.where(keep).select("text", "lang").limit(2 * per_language * len(counts))


def windows(data: bytes, window: int = WINDOW) -> np.ndarray:
    """The bytes, A-Z in lower case, as rows of ``window``; the last row is zero-padded."""
    rows = -(-len(data) // window)
    flat = np.zeros(rows * window, dtype=np.uint8)
    got = np.frombuffer(data, dtype=np.uint8)
    flat[:len(data)] = got + (((got >= 65) & (got <= 90)) * np.uint8(32))
    return flat.reshape(rows, window)


class ByteCnn:
    """Weights: per width ``w`` a table of ``w x 256 x FILTERS``, a bias, and the output layer."""

    def __init__(self, langs: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.taps = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), dtype=np.float32)

    def responses(self, x: np.ndarray, k: int) -> np.ndarray:
        w = WIDTHS[k]
        n = x.shape[1] - w + 1
        y = self.taps[k][0][x[:, :n]]
        for j in range(1, w):
            y += self.taps[k][j][x[:, j:j + n]]
        return y

    def step(self, x: np.ndarray, y: np.ndarray, opt: dict, t: int, rate: float) -> float:
        """One Adam step of cross entropy; max pooling passes the gradient to one place a filter."""
        pooled, places = [], []
        for k in range(len(WIDTHS)):
            r = self.responses(x, k)
            at = r.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0, :])
        h = np.concatenate(pooled, axis=1)
        z = np.maximum(h, 0)
        logits = z @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(p[np.arange(len(y)), y] + 1e-9).mean()
        d = p
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        grads = [z.T @ d, d.sum(axis=0)]
        dz = (d @ self.out.T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            g = np.zeros_like(self.taps[k])
            dk = dz[:, k * FILTERS:(k + 1) * FILTERS]
            rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
            for j in range(w):
                np.add.at(g[j], (x[rows, places[k] + j], np.broadcast_to(cols, places[k].shape)), dk)
            grads.append(g)
        for i, (param, g) in enumerate(zip([self.out, self.bias, *self.taps], grads)):
            m, v = opt.setdefault(i, (np.zeros_like(param), np.zeros_like(param)))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        return float(loss)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filters as lookups by byte pairs: ``first[pair at i] + second[pair at i + 2]``.

        A width-2 filter is one pair; a width-3 filter a pair and a byte; a width-4 filter
        two pairs, so all filters cost two lookups a byte."""
        a = [(t[0][:, None, :] + t[1][None, :, :]).reshape(65536, FILTERS) for t in self.taps]
        b3 = np.broadcast_to(self.taps[1][2][:, None, :], (256, 256, FILTERS)).reshape(65536, FILTERS)
        b4 = (self.taps[2][2][:, None, :] + self.taps[2][3][None, :, :]).reshape(65536, FILTERS)
        return np.concatenate(a, axis=1), np.concatenate([np.zeros_like(b3), b3, b4], axis=1)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, min_steps: int = 400, batch: int = 64,
              rate: float = 0.01, seed: int = 7):
        """Adam over shuffled batches: ``epochs`` rounds, more on few rows, the rate halved twice."""
        rng = np.random.default_rng(seed)
        opt: dict = {}
        t, parts = 0, max(1, len(x) // batch)
        epochs = max(epochs, -(-min_steps // parts))
        for e in range(epochs):
            for part in np.array_split(rng.permutation(len(x)), parts):
                t += 1
                self.step(x[part], y[part], opt, t, rate * 0.5 ** (3 * e // epochs))
        return self


def train_model(rows: list[tuple[str, str]], windows_per_text: int = 4) -> ByteCnn | None:
    """Fit on ``(text, lang)`` rows; None without rows."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None
    xs, ys = [], []
    for text, lang in sorted(rows):
        w = windows(text.encode("utf-8", "replace"))
        if len(w) > 1:
            w = w[:-1]  # whole windows only, but for texts of one window
        pick = np.unique(np.linspace(0, len(w) - 1, windows_per_text).astype(int))
        xs.append(w[pick])
        ys += [langs.index(lang)] * len(pick)
    return ByteCnn(langs).train(np.concatenate(xs), np.array(ys))


class Scorer:
    """Applies a trained model to batches of texts."""

    def __init__(self, langs, first, second, out, bias):
        self.langs, self.first, self.second, self.out, self.bias = langs, first, second, out, bias

    def window_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``WINDOW`` bytes to rows of probabilities."""
        rows, n = x.shape
        pooled = np.empty((rows, self.first.shape[1]), dtype=np.float32)
        wide = x.astype(np.int32)
        pairs = (wide[:, :-1] << 8) | wide[:, 1:]  # n - 1 pairs
        step = 16  # the work arrays of a step stay in the processor's cache
        for i in range(0, rows, step):
            p = pairs[i:i + step]
            r = np.take(self.first, p, axis=0, mode="clip")  # rows x (n-1) x 3F, one row a place
            r[:, :n - 3] += np.take(self.second, p[:, 2:], axis=0, mode="clip")
            # the last places have room for the narrower filters only
            r[:, n - 3, FILTERS:2 * FILTERS] += self.second[wide[i:i + step, n - 1] << 8][:, FILTERS:2 * FILTERS]
            r[:, n - 3, 2 * FILTERS:] = -np.inf
            r[:, n - 2, FILTERS:] = -np.inf
            size = n - 1
            while size > 1:  # maximum over the places by halves
                half = size // 2
                np.maximum(r[:, :half], r[:, size - half:size], out=r[:, :half])
                size -= half
            pooled[i:i + step] = r[:, 0]
        logits = np.maximum(pooled, 0) @ self.out + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None], limit: int = 1 << 20) -> list[tuple[str, float]]:
        """``(language, score)`` of each text; ``limit`` bytes are worked on at a time."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        group, held = [], 0
        for i, t in enumerate(texts):
            if t is None or not has_letter(t):
                continue
            w = windows(t.encode("utf-8", "replace"))
            group.append((i, w))
            held += w.size
            if held >= limit:
                self._score(group, out)
                group, held = [], 0
        self._score(group, out)
        return out

    def _score(self, group, out):
        if not group:
            return
        x = np.concatenate([w for _, w in group])
        p = np.concatenate([self.window_probabilities(x[i:i + 4096]) for i in range(0, len(x), 4096)])
        letters = ((x >= 128) | (((x | 32) >= 97) & ((x | 32) <= 122))).sum(axis=1).astype(np.float64)
        starts = np.cumsum([0] + [len(w) for _, w in group[:-1]])
        total = np.add.reduceat(p * letters[:, None], starts, axis=0) / np.add.reduceat(letters, starts)[:, None]
        best = total.argmax(axis=1)
        for (i, _), b, row in zip(group, best, total):
            out[i] = (self.langs[b], round(float(min(1.0, row[b])), 6))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def scorer(model: ByteCnn) -> Scorer:
    first, second = model.tables()
    return Scorer(model.langs, first, second, model.out, model.bias)


def predictor(model: ByteCnn | None):
    """Column function ``text -> struct<lang_pred, score>``.

    Only the small filter weights travel with the function; workers build the tables once."""
    kept: dict = {}

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if model is None:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
        if "s" not in kept:
            kept["s"] = scorer(model)
        found = kept["s"].predict(list(texts))
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return predict


def fit(docs: DataFrame, per_language: int = 600, max_languages: int = 200) -> ByteCnn | None:
    """Train on the bounded sample of ``docs`` (``doc_id, text, lang``)."""
    rows = sample(docs, per_language, max_languages).collect()
    return train_model([(r["text"], r["lang"]) for r in rows])


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def identify(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replaced if they exist)."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    both = free_name(names, "_lang")
    found = docs.select(*names, predictor(model)(F.col("text")).alias(both))
    return found.select(*names, f"{both}.lang_pred", f"{both}.score")
