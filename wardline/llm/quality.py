"""Quality classifier by compression: two zstandard dictionaries, one trained on good text and one
on bad text; whichever compresses a text better tells its class.

A text is cut into chunks of CHUNK bytes, each compressed alone under both dictionaries, so that a
long text cannot drown a dictionary in its own history and memory stays bounded. The normalised
difference of the summed sizes, (bad - good) / (bad + good), together with the text's own
compression ratio and its length, goes through a logistic calibration fitted on labelled rows that
neither dictionary was trained on (though copies of them may have been).

A dictionary takes a line from one text, however many of its class have it, and leaves out lines that
both classes have. What is too little to train on becomes a dictionary as it stands.

Fitting takes a bounded sample (`max_rows` labelled rows a class, the smallest by hash of the id; of
rows that share an id, one); the dictionaries see about `row_bytes` of each text, those lines of the
whole text that are lowest by hash (see `excerpt`), calibration and scoring whole texts. Null text counts
as empty. Empty texts get the score that the calibration gives to size zero. There is nothing to
learn without lines of each class's own, or without three labelled rows of each: then every score is
the share of good labels (0.5 without any), and `keep_good` keeps all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import bound_batches, numbered, pick

CHUNK = 2048
DICTIONARY_BYTES = 112_640
LEVEL = 3
MAX_ROWS = 3000
ROW_BYTES = 8192


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple  # of the features, intercept first
    base: float  # score when there are no dictionaries

    def scorer(self):
        """Function from a list of texts to a list of scores in [0, 1]."""
        import numpy as np

        if not self.weights:
            return lambda texts: np.full(len(texts), self.base)
        measure = _meter(self.good, self.bad)
        weights = np.array(self.weights)

        def score(texts):
            table = _features(np, [measure(t) for t in texts])
            return 1.0 / (1.0 + np.exp(-np.clip(table @ weights, -30, 30)))

        return score


def _meter(good: bytes, bad: bytes):
    """Function from a text to (bytes, size under the good, size under the bad dictionary)."""
    import zstandard

    packers = []
    for raw in (good, bad):
        trained = zstandard.ZstdCompressionDict(raw)
        trained.precompute_compress(level=LEVEL)
        packers.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=trained, write_content_size=False, write_dict_id=False
            ).compress
        )

    def measure(text):
        data = (text or "").encode("utf-8", "replace")
        sizes = [0, 0]
        for at in range(0, len(data), CHUNK):
            chunk = data[at : at + CHUNK]
            for side in (0, 1):
                sizes[side] += len(packers[side](chunk))
        return len(data), sizes[0], sizes[1]

    return measure


def _features(np, sizes):
    raw, good, bad = (np.array(x, dtype=float) for x in zip(*sizes, strict=True)) if sizes else [np.zeros(0)] * 3
    gap = (bad - good) / np.maximum(bad + good, 1.0)
    own = np.log((np.minimum(good, bad) + 1.0) / (raw + 1.0))
    short = 1.0 / np.sqrt(1.0 + raw / 64.0)
    return np.stack([np.ones_like(raw), 10 * gap, 10 * gap * short, own, own * own, short], axis=1)


def _logistic(np, table, target, ridge=1e-2, steps=50):
    """Weights by Newton's method with a small ridge."""
    weights = np.zeros(table.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(table @ weights, -30, 30)))
        slope = table.T @ (target - p) - ridge * weights
        curve = (table * (p * (1 - p))[:, None]).T @ table + ridge * np.eye(len(weights))
        move = np.linalg.solve(curve, slope)
        weights = weights + move
        if np.abs(move).max() < 1e-8:
            break
    return weights


def sample_ids(marks: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most `max_rows` rows a class of (id, label in 0/1), the smallest by hash of the id: the
    bound of what fitting needs."""
    hashed = marks.select("id", "label", F.xxhash64(F.col("id").cast("string")).alias("h"))
    parts = [
        hashed.where(F.col("label") == label).orderBy("h", "id").limit(max_rows) for label in (0, 1)
    ]
    return F.broadcast(parts[0].unionByName(parts[1]))  # 2 * max_rows short rows at most


def excerpt(text: str, row_bytes: int) -> str:
    """About `row_bytes` characters of a text: its lines lowest by hash, in their order; lines longer than
    CHUNK are taken piece by piece. Texts that are no longer are taken whole. A line has one hash
    wherever it stands, so texts that share a line give it alike."""
    import zlib

    if len(text) <= row_bytes:
        return text
    pieces = [line[i : i + CHUNK] for line in text.split("\n") for i in range(0, max(1, len(line)), CHUNK)]
    order = sorted(range(len(pieces)), key=lambda i: (zlib.crc32(pieces[i].encode("utf-8", "replace")), i))
    chosen, size = [], 0
    for i in order:
        if size + len(pieces[i]) > row_bytes and chosen:
            break
        chosen.append(i)
        size += len(pieces[i]) + 1
    return "\n".join(pieces[i] for i in sorted(chosen))


def fit(sample: DataFrame, row_bytes: int = ROW_BYTES) -> CompressionModel:
    """Model from a bounded sample (id, text, label, h), as joined to `sample_ids`, which is written
    first, one row per id and label. Two thirds of it train the dictionaries, the rest the calibration,
    measured in tasks. Of a text only its `excerpt` comes to the driver."""
    import numpy as np
    import zstandard

    bound_batches(sample.sparkSession)
    text = F.coalesce("text", F.lit("")).alias("text")
    # An id that very many rows share gives one of them, chosen before rows meet.
    least = F.min(F.struct(F.xxhash64(text).alias("whole"), text)).alias("one")
    sample = sample.groupBy("id", "label", "h").agg(least).select("id", "one.text", "label", "h")
    sample = materialize(sample.withColumn("row", F.monotonically_increasing_id()), "labelled")

    @F.pandas_udf("string")
    def shortened(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: excerpt(t, row_bytes))

    rows = sample.select("id", shortened("text").alias("text"), "label", "h", "row", F.xxhash64("text").alias("whole")).toPandas()
    rows = rows.sort_values(["h", "id", "label", "text", "whole"]).reset_index(drop=True)
    share = float(rows["label"].mean()) if len(rows) else 0.5
    calibrate = rows.groupby("label").cumcount() % 3 == 2
    # A line that both classes have (a notice, a repeated passage) says nothing about quality, but
    # whichever dictionary holds it would claim every short text with it: leave such lines out.
    held = [{line for text in rows.loc[rows["label"] == k, "text"] for line in text.split("\n")} for k in (0, 1)]
    dictionaries = []
    for label in (1, 0):
        known = set(held[1 - label])
        chunks = []
        for text in rows.loc[(rows["label"] == label) & ~calibrate, "text"]:
            own = [line for line in text.split("\n") if line not in known]
            known.update(own)  # lines that repeat within a text are its own way and stay
            data = "\n".join(own).encode("utf-8", "replace")
            chunks += [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        dictionaries.append(_dictionary(zstandard, chunks))
    target = rows.loc[calibrate, "label"].to_numpy(dtype=float)
    if None in dictionaries or not 0 < target.sum() < len(target):
        return CompressionModel(b"", b"", (), share)
    chosen = rows.loc[calibrate, "row"].tolist()
    sizes = _sizes(sample, chosen, *dictionaries)
    weights = _logistic(np, _features(np, [sizes[row] for row in chosen]), target)
    return CompressionModel(*dictionaries, tuple(float(w) for w in weights), share)


def _sizes(sample: DataFrame, chosen: list, good: bytes, bad: bytes) -> dict:
    """What `_meter` measures of the whole texts of the chosen rows, by row."""

    @F.pandas_udf("array<bigint>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(_meter(good, bad))

    few = F.broadcast(sample.sparkSession.createDataFrame([(row,) for row in chosen], "row long"))
    return {r.row: r.sizes for r in sample.join(few, "row").select("row", measured("text").alias("sizes")).collect()}


def _dictionary(zstandard, chunks):
    """Trained dictionary, smaller where there is little text; the text itself if that is too little
    to train on; None without text."""
    total = sum(map(len, chunks))
    size = min(DICTIONARY_BYTES, max(1024, total // 8))
    try:
        return zstandard.train_dictionary(size, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(chunks)[:DICTIONARY_BYTES] or None


def score_column(model: CompressionModel, text: Column) -> Column:
    """Score in [0, 1] of a text column; higher means label 1 is likelier."""

    @F.pandas_udf("double")
    def quality_score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scorer()(texts.tolist()), index=texts.index, dtype=float)

    return quality_score(text)


def scored(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """(doc_id, score) for documents (doc_id, text)."""
    bound_batches(docs.sparkSession)
    return pick(docs, "doc_id", "text").select("doc_id", score_column(model, F.col("text")).alias("score"))


def keep_good(docs: DataFrame, model: CompressionModel, threshold: float) -> DataFrame:
    """Documents that score `threshold` or more, with all their columns; all documents if nothing
    could be learned."""
    if not model.weights:
        return docs
    bound_batches(docs.sparkSession)
    plain = numbered(docs)
    text = F.col(f"_{docs.columns.index('text')}")
    kept = plain.where(score_column(model, text) >= threshold)
    return kept.toDF(*docs.columns)
