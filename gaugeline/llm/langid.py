"""Language identification by a byte convolutional network trained and run in numpy.

Filters of several widths slide over byte classes; the maximum of each filter in a
fixed-length window feeds a softmax. A text is cut into windows without gaps, and its
probabilities are the means over its windows weighted by their letters. A filter
is a sum of table rows for single classes (training) or class pairs (prediction).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, free_name, named, slices, text_blocks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
BLOCK = 128
BLOCK_BYTES = 1 << 20
UND = "und"


def byte_classes() -> np.ndarray:
    """Class of each byte: letters without case, digits, white space, other ASCII, each byte above 127; 0 pads."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        ch = chr(b)
        if b >= 128:
            table[b] = 30 + b - 128
        elif ch.isalpha():
            table[b] = 1 + ord(ch.lower()) - ord("a")
        else:
            table[b] = 27 if ch.isdigit() else 28 if ch.isspace() else 29
    table[0xFF] = 0  # never in UTF-8
    return table


CLASSES = byte_classes()
K = 30 + 128


@dataclass
class LanguageModel:
    """languages; tables[width]: (width, K, FILTERS); bias: (3 * FILTERS,); dense: (3 * FILTERS, languages); out: (languages,)."""

    languages: list[str]
    tables: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    def pairs(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width the (offset, table over class pairs) whose rows sum to the filters."""
        made = []
        for w in WIDTHS:
            t, parts = self.tables[w], []
            for at in range(0, w, 2):
                second = t[at + 1] if at + 1 < w else np.zeros_like(t[0])
                parts.append((at, np.ascontiguousarray((t[at][:, None] + second[None]).reshape(K * K, FILTERS))))
            made.append(parts)
        return made

    def windows(self, codes: np.ndarray, pairs: list) -> np.ndarray:
        """Softmax of each window of a coded array whose length is a multiple of WINDOW."""
        n = len(codes) // WINDOW
        result = np.empty((n, len(self.languages)), np.float32)
        padded = np.concatenate((codes, np.zeros(4, np.uint8))).astype(np.int64)
        pair = padded[:-1] * K + padded[1:]
        a, b = (np.empty((BLOCK * WINDOW, FILTERS), np.float32) for _ in range(2))
        for i in range(0, n, BLOCK):
            m = min(BLOCK, n - i) * WINDOW
            pooled = []
            for parts in pairs:
                for j, (at, table) in enumerate(parts):
                    lo = i * WINDOW + at
                    np.take(table, pair[lo : lo + m], axis=0, out=(b if j else a)[:m])
                    if j:
                        np.add(a[:m], b[:m], out=a[:m])
                pooled.append(a[:m].reshape(-1, WINDOW, FILTERS).max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            result[i : i + BLOCK] = softmax(hidden @ self.dense + self.out)
        return result

    def predict(self, texts: list[str]) -> np.ndarray:
        """Probabilities (texts x languages)."""
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        pairs, result = prepared(self), np.empty((len(texts), len(self.languages)))
        for a, b in slices([len(r) for r in raws], BLOCK_BYTES):
            sizes = np.array([-(-(len(r) + 4) // WINDOW) for r in raws[a:b]])
            data = b"".join(r.ljust(n * WINDOW, b"\xff") for r, n in zip(raws[a:b], sizes.tolist(), strict=True))
            codes = CLASSES[np.frombuffer(data, np.uint8)]
            p = self.windows(codes, pairs)
            letters = ((codes >= 1) & (codes <= 26) | (codes >= 30)).reshape(-1, WINDOW).sum(axis=1) + 1e-3
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            result[a:b] = np.add.reduceat(p * letters[:, None], starts, axis=0) / np.add.reduceat(letters, starts)[:, None]
        return result


_prepared: dict[bytes, list] = {}


def prepared(model: LanguageModel) -> list:
    key = model.dense.tobytes()[:256] + model.out.tobytes()
    if key not in _prepared:
        _prepared.clear()
        _prepared[key] = model.pairs()
    return _prepared[key]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: list[bytes], labels: list[str], epochs: int = 4, batch: int = 64, rate: float = 0.01, seed: int = 7) -> LanguageModel:
    """Adam on the cross entropy. Each epoch cuts some windows short, so that short texts are known too."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    counts = np.bincount(target, minlength=len(languages))
    weight = (len(labels) / (len(languages) * counts))[target].astype(np.float32)
    n_hidden = FILTERS * len(WIDTHS)
    p = {w: rng.normal(0, 0.3, (w, K, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(n_hidden, np.float32), "dense": rng.normal(0, 0.3, (n_hidden, len(languages))).astype(np.float32), "out": np.zeros(len(languages), np.float32)}
    for w in WIDTHS:
        p[w][:, 0] = 0
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    data = CLASSES[np.frombuffer(b"".join(x[:WINDOW].ljust(WINDOW, b"\xff") for x in windows), np.uint8)].reshape(-1, WINDOW)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x = data[pick].copy()
            short = rng.random(len(x)) < 0.3
            keep = np.where(short, rng.integers(8, WINDOW, len(x)), WINDOW)
            x[np.arange(WINDOW)[None] >= keep[:, None]] = 0
            wide = np.pad(x, ((0, 0), (0, 4))).astype(np.int64)
            pooled, where = [], []
            for w in WIDTHS:
                conv = sum(p[w][k][wide[:, k : k + WINDOW]] for k in range(w))
                top = conv.argmax(axis=1)
                where.append(top)
                pooled.append(np.take_along_axis(conv, top[:, None], axis=1)[:, 0])
            before = np.concatenate(pooled, axis=1) + p["bias"]
            hidden = np.maximum(before, 0)
            d = softmax(hidden @ p["dense"] + p["out"])
            d[np.arange(len(x)), target[pick]] -= 1
            d *= weight[pick][:, None] / len(x)
            back = (d @ p["dense"].T) * (before > 0)
            grads = {"dense": hidden.T @ d, "out": d.sum(axis=0), "bias": back.sum(axis=0)}
            rows, f = np.arange(len(x))[:, None], np.arange(FILTERS)[None]
            for i, w in enumerate(WIDTHS):
                g = np.zeros_like(p[w])
                for k in range(w):
                    np.add.at(g[k], (wide[rows, where[i] + k], np.broadcast_to(f, where[i].shape)), back[:, i * FILTERS : (i + 1) * FILTERS])
                g[:, 0] = 0
                grads[w] = g
            step += 1
            for k, g in grads.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LanguageModel(languages, {w: p[w] for w in WIDTHS}, p["bias"], p["dense"], p["out"])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = 4000, per_row: int = 3) -> LanguageModel:
    """Learn from (text, lang) rows.

    At most ``max_rows`` rows with different texts are used, those with the smallest hash, and of each
    ``per_row`` windows at places given by the hash; this bounds the driver's memory. Rows
    with a null text or language, or without a letter, are left out.
    """
    t = named(text)
    rows = labelled.filter(t.rlike(r"\p{L}") & named(lang).isNotNull())
    places = [F.substring(t, (F.pmod(F.xxhash64(t, F.lit(i)), F.greatest(F.lit(1), F.length(t) - WINDOW + 1)) + 1).cast("int"), F.lit(WINDOW)) for i in range(per_row)]
    rows = rows.select(F.xxhash64(t).alias("h"), F.array(*places).alias("w"), named(lang).alias("lang"))
    sample = bounded_sample(rows, "h", max_rows).collect()
    if not sample:
        return LanguageModel([UND], {w: np.zeros((w, K, FILTERS), np.float32) for w in WIDTHS}, np.zeros(FILTERS * len(WIDTHS), np.float32), np.zeros((FILTERS * len(WIDTHS), 1), np.float32), np.zeros(1, np.float32))
    pairs = [(x.encode("utf-8", "surrogatepass"), r["lang"]) for r in sample for x in r["w"]]
    return train([x for x, _ in pairs], [y for _, y in pairs])


def identify(df: DataFrame, model: LanguageModel, text: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Add the predicted language and its probability to every row.

    Null, empty and letterless texts give ``und`` with score 0. Texts are read whole, in
    windows. Rows, repetitions and other columns are kept; existing columns of the two
    result names are replaced. Ties go to the language that sorts first.
    """

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array(model.languages, object)
        for batch in batches:
            p = np.concatenate([np.empty((0, len(names))), *map(model.predict, text_blocks(batch, BLOCK_BYTES))])
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            score = np.clip(p[np.arange(len(p)), best], 0, 1)
            yield pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    t = named(text)
    has_letter = F.coalesce(t.rlike(r"\p{L}"), F.lit(False))
    # declared nondeterministic, so that a filter on the result doesn't run the network a second time below it
    told = run.asNondeterministic()(F.coalesce(t, F.lit("")))
    found = free_name(df, "identified")
    out = df.withColumn(found, F.struct(has_letter.alias("ok"), told.alias("of")))
    ok, of = named(found)["ok"], named(found)["of"]
    return out.withColumns({lang_col: F.when(ok, of["lang"]).otherwise(UND), score_col: F.when(ok, of["score"]).otherwise(0.0)}).drop(found)
