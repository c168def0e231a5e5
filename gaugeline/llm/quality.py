"""Quality scores by compression: dictionaries of good and bad text, and the difference in compressed size.

A text is compressed in equal pieces with a zstandard dictionary built from good and
one built from bad labelled text. The difference of the two sizes over the raw size is
turned into a probability by a logistic fit on the same labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, named, text_blocks

PIECE = 512
LEVEL = 1
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class QualityModel:
    """Two raw dictionaries and the calibration ``1 / (1 + exp(-(slope * x + shift)))``."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.difference(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -60, 60)))

    def difference(self, text: str) -> float:
        """(size with the bad dictionary - size with the good one) / raw size over the whole text; 0 for an empty text."""
        good, bad = compressors(self.good, self.bad)
        raw = text.encode("utf-8", "surrogatepass")
        total = 0
        for at in range(0, len(raw), PIECE):
            part = raw[at : at + PIECE]
            total += len(bad(part)) - len(good(part))
        return total / len(raw) if raw else 0.0


_compressors: dict[tuple[int, int], tuple] = {}


def compressors(*dictionaries: bytes):
    key = tuple(map(hash, dictionaries))
    if key not in _compressors:
        params = zstd.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        made = []
        for d in dictionaries:
            use = zstd.ZstdCompressionDict(d)
            use.precompute_compress(compression_params=params)
            made.append(zstd.ZstdCompressor(dict_data=use, compression_params=params).compress)
        _compressors[key] = tuple(made)
    return _compressors[key]


def dictionary(texts: list[str], size: int) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    parts = [raw[i : i + PIECE] for t in texts if (raw := t.encode("utf-8", "surrogatepass")) for i in range(0, len(raw), PIECE)]
    try:
        return zstd.train_dictionary(size, parts, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"".join(parts)[-size:]


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Logistic fit by Newton steps with a slight ridge; the classes weigh alike."""
    a = np.column_stack((x, np.ones_like(x)))
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    beta = np.zeros(2)
    ridge = np.diag([1e-7, 1e-4])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) + ridge @ beta
        hess = (a * (w * p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        beta -= np.linalg.solve(hess, grad)
    return float(beta[0]), float(beta[1])


def fit(labelled: DataFrame, text: str = "text", label: str = "label", max_rows: int = 4000, max_chars: int = 4096, dictionary_size: int = 65536) -> QualityModel:
    """Learn from (text, label 0/1) rows.

    At most ``max_rows`` rows with different texts are used, those with the smallest hash of their
    text, and of each one window of ``max_chars`` characters at a place given by the hash; this
    bounds the driver's memory. Rows with a null text or label are left out. With no row of one class
    that class's dictionary is empty text and scores stay near one half.
    """
    h = F.xxhash64(named(text))
    at = F.pmod(h, F.greatest(F.lit(1), F.length(named(text)) - max_chars + 1)) + 1
    rows = labelled.filter(named(text).isNotNull() & named(label).isin(0, 1))
    rows = rows.select(h.alias("h"), F.substring(named(text), at.cast("int"), F.lit(max_chars)).alias("t"), named(label).cast("int").alias("y"))
    sample = bounded_sample(rows, "h", max_rows).collect()
    # every other row builds the dictionaries, the rest calibrates
    texts = {k: [r["t"] for r in sample[::2] if r["y"] == k] for k in (0, 1)}
    raw = QualityModel(*(dictionary(texts[k], dictionary_size) or b" " for k in (1, 0)), 1.0, 0.0)
    held = sample[1::2] or sample
    x = np.array([raw.difference(r["t"]) for r in held], float)
    y = np.array([r["y"] for r in held], int)
    if len({*y.tolist()}) < 2:
        return QualityModel(raw.good, raw.bad, 0.0, 0.0)
    return QualityModel(raw.good, raw.bad, *calibrate(x, y))


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """Add a score from 0 to 1 (higher: label 1 likelier) and ``predicted`` (1 if at least 0.5) to every row.

    Null texts count as empty; an empty text has size difference 0 and so the calibrated
    score of no evidence. Whole texts are read, whatever their length. Rows, repetitions and
    other columns are kept; existing columns of the two result names are replaced.
    """

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([np.empty(0), *map(model.score, text_blocks(batch, BLOCK_BYTES))]), pa.float64())

    out = df.withColumn(score_col, run(F.coalesce(named(text), F.lit(""))))
    return out.withColumn(predicted_col, (F.col(score_col) >= 0.5).cast("int"))
