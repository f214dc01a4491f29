"""Quality by compression: is a text shorter with a dictionary of good or of bad text?

Two zstandard dictionaries are built from pieces of labelled text. Every piece
of ``PIECE`` bytes of a text is compressed with either; the sum of the size
differences, divided by the bytes of the text, is the raw score. Small pieces
keep the dictionaries' weight the same all through a long text, and dividing by
plain rather than compressed bytes keeps monotonous text, which shrinks to
nothing with both, near 0. A logistic curve, fitted on labelled documents that
are in neither dictionary, makes it a probability.

Null and empty texts have a raw score of 0 and the probability that belongs to
it. Repeated rows score alike; an empty table gives an empty result. Without
labels of both kinds every text scores 1 if only good ones are known, else 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import chunks, extended, values
from pagemill.llm.labelled import Sample, fit_sigmoid, sample_labelled, sigmoid
from pagemill.session import ship_package

PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 112 << 10
PIECES = 20_000  # most pieces a dictionary is built from
LEAST_PIECES = 16  # fewer are used as they are: too few to find common parts in
PER_CLASS, MAX_CHARS = 1_500, 20_000  # bounds of the labelled sample


def pieces(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def dictionary(texts: list[str]) -> bytes:
    """A dictionary of what the texts have in common."""
    found = [p for t in texts for p in pieces(t)]
    step = max(1, -(-len(found) // PIECES))
    found = found[::step]
    if len(found) >= LEAST_PIECES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, found, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too little or too uniform text
            pass
    return b"".join(found)[-DICTIONARY_BYTES:]


@lru_cache(maxsize=4)
def compressor(data: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(data) if data else None
    if shared is not None:
        shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
    )


@dataclass(frozen=True)
class Quality:
    """The two dictionaries and the calibration; a few hundred kilobytes."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def raw(self, text: str | None) -> float:
        """Bytes saved by the dictionary of good text rather than bad text, per byte."""
        parts = pieces(text)
        if not parts:
            return 0.0
        good, bad = compressor(self.good).compress, compressor(self.bad).compress
        return sum(len(bad(p)) - len(good(p)) for p in parts) / sum(map(len, parts))

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw + self.shift)


def fit(sample: Sample) -> Quality:
    """Dictionaries from one half of the sample, the calibration from the other."""
    halves = [[t for t, c, k in zip(sample.texts, sample.labels, sample.calibrate, strict=True) if c == wanted and not k] for wanted in (0, 1)]
    if not all(halves):
        return Quality(b"", b"", 0.0, 35.0 if (sample.labels == 1).any() and not (sample.labels == 0).any() else -35.0)
    model = Quality(dictionary(halves[1]), dictionary(halves[0]), 1.0, 0.0)
    other = np.flatnonzero(sample.calibrate) if sample.calibrate.any() else np.arange(len(sample.texts))
    raw = np.array([model.raw(sample.texts[i]) for i in other])
    slope, shift = fit_sigmoid(raw, sample.labels[other])
    return Quality(model.good, model.bad, float(slope[0]), shift + sample.prior)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Quality:
    """The model for ``docs(doc_id, text)`` with ``labels(doc_id, quality)``, from a bounded sample."""
    return fit(sample_labelled(docs, labels, "quality", per_class, max_chars))


def score(df: DataFrame, model: Quality, column: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that ``column`` is good text, over the whole text."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[f for f in df.schema.fields if f.name.lower() != name.lower()], T.StructField(name, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for part in chunks(batch, column):
                raw = np.array([held.raw(t) for t in values(part, column)])
                yield extended(part, arrow, {name: pa.array(held.probability(raw), pa.float64())})

    return df.mapInArrow(run, schema)
