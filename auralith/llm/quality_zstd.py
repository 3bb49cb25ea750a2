"""Quality by compression: one zstandard dictionary of good and one of bad labelled text; which of them compresses a text better.

A text is cut into blocks, so that a dictionary keeps its weight in long texts; all blocks count. The difference of the two sizes over
their sum is calibrated by logistic regression on labelled texts that neither dictionary has seen.

The fit takes at most FIT_ROWS labelled documents (chosen by a hash of doc_id, outside the held-out part), whole texts; where training a dictionary fails, 64 KB of
pieces from all over them stand in. It doesn't grow with
the corpus. Cases: null and empty texts have all features 0 and get their calibrated score; repeated rows score alike; without labels of
both kinds each text gets the smoothed rate of the kind there is (one half without any label); an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auralith.llm.calibration import fit_logistic, sigmoid
from auralith.llm.common import crc_rest, fitted, labelled_sample, map_texts

FIT_ROWS = 4000
BLOCK, PIECE, DICTIONARY, LEVEL = 4096, 256, 65_536, 3
STEPS = (0.0, 0.2, 0.3, 0.4, 0.5, 1.0)


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def train_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where training has too little text, or (as with text that repeats itself) finds less than half of what fits,
    different pieces from all over all texts, chosen by hash."""
    samples = [b for t in texts for b in blocks(t) if len(b) >= 8]
    try:
        made = zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        made = b""
    if 2 * len(made) >= DICTIONARY:
        return made
    pieces = {data[i : i + PIECE] for data in map(str.encode, texts) for i in range(0, len(data), PIECE)}
    return b"".join(sorted(pieces, key=lambda p: (xxhash.xxh64_digest(p), p))[: DICTIONARY // PIECE])


@lru_cache(8)
def _sizer(dictionary: bytes) -> Callable[[str], int]:
    if len(dictionary) < 8:
        packed = zstandard.ZstdCompressor(LEVEL)
    else:
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
        known.precompute_compress(LEVEL)
        packed = zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False)
    return lambda text: sum(len(packed.compress(b)) for b in blocks(text))


def differences(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    """Per text the size difference over the sum of both sizes (positive: the dictionary of good text compresses it better), and, as text that repeats
    itself makes any dictionary useless, the better size over the text's own in steps, so that the calibration can weigh it freely."""
    a, b = (np.array([_sizer(d)(t) for t in texts], float) for d in (good, bad))
    n = np.array([len(t.encode()) for t in texts], float)
    left = np.minimum(a, b) / np.maximum(n, 1)
    return np.c_[(b - a) / np.maximum(a + b, 1), *[np.clip(left, low, high) - low for low, high in zip(STEPS, STEPS[1:], strict=False)]]


def train(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from every other text of a kind, the calibration from the rest; from all if a kind has fewer than four."""
    rows = sorted(rows)  # the fit does not depend on the order of its rows
    kinds = {y: [t for t, k in rows if k == y] for y in (1, 0)}
    split = min(map(len, kinds.values())) >= 4
    good, bad = (train_dictionary(kinds[y][::2] if split else kinds[y]) for y in (1, 0))
    rest = [(t, y) for y in (1, 0) for t in (kinds[y][1::2] if split else kinds[y])]
    x = differences([t for t, _ in rest], good, bad)
    return Model(good, bad, tuple(fit_logistic(x, np.array([y for _, y in rest], float), ridge=1e-3).tolist()))


def scores(texts: list[str], model: Model) -> np.ndarray:
    return sigmoid(model.weights[0] + differences(texts, model.good, model.bad) @ np.array(model.weights[1:]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    return fitted(labelled_sample(docs, labels, "quality", crc_rest("doc_id", 5) == 0, rows), train)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Appends the score of each whole text."""

    def work(texts: list[str]) -> list[pa.Array]:
        return [pa.array(scores(texts, model), pa.float64())]

    return map_texts(docs, "text", f"{name} double", work)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    held = F.coalesce(crc_rest("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
