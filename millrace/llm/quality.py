"""Quality by compression: which labelled text helps zstandard more.

Two dictionaries hold excerpts of good and of bad labelled texts. Every whole text is compressed in
short blocks with either, and with none, so that the dictionary and not the text's own past decides.
The difference of the two sizes, normalised by their sum and by the text's length, and the plain
compressed ratio (which tells repetitive text) become a probability by logistic regression, fitted on
labelled texts that are in no dictionary.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts, narrow, thinned

#: The classifier is fitted on at most so many labelled rows of each class, half of them for dictionaries.
FIT_ROWS = 4000
DICTIONARY_BYTES, EXCERPT_BYTES, EXCERPTS = 110_000, 200, 24
BLOCK_BYTES, LEVEL = 600, 6


def excerpts(text: str) -> list[bytes]:
    """Up to ``EXCERPTS`` pieces of a text, at places that follow from its content."""
    data = text.encode()
    if len(data) <= EXCERPT_BYTES:
        return [data]
    at = (zlib.crc32(b"%d" % k, zlib.crc32(data)) % (len(data) - EXCERPT_BYTES + 1) for k in range(EXCERPTS))
    return [data[i:i + EXCERPT_BYTES] for i in at]


def features_with(dictionaries: tuple[bytes, bytes]):
    """A function from a text to its four features, given the bad and the good dictionary."""
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
    tools = [zstandard.ZstdCompressor(**plain, write_dict_id=False, dict_data=d) for d in (
        zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in dictionaries)]
    for tool, d in zip(tools, dictionaries):
        assert len(d) >= 8, "a dictionary needs text"
    tools.append(zstandard.ZstdCompressor(**plain))

    def features(text: str) -> tuple[float, ...]:
        data = text.encode()
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        bad, good, alone = (sum(len(t.compress(b)) for b in blocks) for t in tools)
        n = len(data) + 20
        return (bad - good) / (bad + good + 1), alone / n, (alone - good) / n, (alone - bad) / n

    return features


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, spread and coefficients (intercept first) of a ridge logistic regression."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    x = np.c_[np.ones(len(x)), (x - mean) / spread]
    ridge = np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ w
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
    return mean, spread, w


def fit(docs: DataFrame, labels: DataFrame):
    """Dictionaries and calibration from labelled rows, or the share of good ones if one class is missing.

    ``labels`` has ``doc_id, quality``; rows with a null in either, or another quality, are not used.
    Of each class at most ``FIT_ROWS`` rows are taken, those with the smallest hash of the id; only excerpts of
    theirs and four numbers per row come to the driver. A document that repeats counts once per row and label; a
    null text is empty, and empty texts are not used.
    """
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        "doc_id IS NOT NULL AND quality IN (0, 1)").withColumn("o", F.xxhash64("doc_id"))
    count = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    if len(count) < 2:
        return None, 0.5 if not count else float(next(iter(count)))
    chosen = [labels.where((F.col("quality") == q) & thinned(F.col("o"), FIT_ROWS, F.lit(count[q])))
              .orderBy(F.pmod("o", F.lit(1 << 30)), "doc_id").limit(FIT_ROWS) for q in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # 2 * FIT_ROWS short rows at most, so it may be broadcast
    rows = narrow(docs).join(F.broadcast(chosen), "doc_id").where("text <> ''")
    role = F.pmod(F.xxhash64("doc_id", F.lit("role")), F.lit(2))
    found = map_texts(rows.where(role == 0).select("text", "quality", "o"), lambda: lambda ts: [[excerpts(t) for t in ts]],
                      "parts array<binary>", ["parts"], [pa.list_(pa.binary())]).collect()
    found = sorted(((r.quality, k, r.o, bytes(p)) for r in found for k, p in enumerate(r.parts)))
    books = []
    for q in (0, 1):
        taken, size = [], 0
        for part in (p for label, _, _, p in found if label == q):
            if size >= DICTIONARY_BYTES:
                break
            taken.append(part)
            size += len(part) + 1
        books.append(b"\n".join(taken))
    share = count[1] / (count[0] + count[1])
    if min(map(len, books)) < 8:
        return None, share
    measured = _measure(rows.where(role == 1).select("text", "quality"), tuple(books)).collect()
    y = np.array([r.quality for r in measured], float)
    if not 0 < y.sum() < len(y):
        return None, share
    weight = np.where(y == 1, count[1] / y.sum(), count[0] / (len(y) - y.sum()))
    return tuple(books), logistic(np.array([r.f for r in measured]), y, weight * len(y) / weight.sum())


def _measure(df: DataFrame, books: tuple[bytes, bytes]) -> DataFrame:
    def work():
        features = features_with(books)
        return lambda texts: [[features(t) for t in texts]]

    return map_texts(df, work, "f array<double>", ["f"], [pa.list_(pa.float64())])


def score(df: DataFrame, model) -> DataFrame:
    """``df`` with a column ``score`` instead of ``text``: the probability that the text is good."""
    books, calibration = model
    if books is None:
        return df.drop("text").withColumn("score", F.lit(calibration))
    mean, spread, w = (x.tolist() for x in calibration)
    z = F.lit(w[0])
    for i in range(len(mean)):
        z = z + (F.col("f")[i] - mean[i]) / spread[i] * w[i + 1]
    return _measure(df, books).withColumn("score", 1 / (1 + F.exp(-z))).drop("f")


def predicted(column: str = "score"):
    return F.when(F.col(column) >= 0.5, 1).otherwise(0)


def drop_rejected(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` whose text is predicted good, learned from all of ``labels`` that it holds.

    The text stays as it is, null included; a null text is scored as an empty one.
    """
    model = fit(df, labels)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return score(rows, model).where(F.col("score") >= 0.5).select("row.*")
