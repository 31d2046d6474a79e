"""The quality classifier against a plain computation of its sizes, dictionaries and calibration."""

import math

import numpy as np
import zstandard
from helpers import docs

from millrace.llm import quality
from millrace.llm.common import narrow

SMALL = "/root/testdata/sf0.01"


def plain_sizes(text, books):
    """Compressed bytes of 600-byte blocks with the bad dictionary, the good one and none."""
    data, sizes = text.encode(), []
    for book in (*books, None):
        extra = {} if book is None else {"dict_data": zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT), "write_dict_id": False}
        total = 0
        for i in range(0, len(data), 600):
            total += len(zstandard.ZstdCompressor(level=6, write_content_size=False, write_checksum=False, **extra).compress(data[i:i + 600]))
        sizes.append(total)
    return sizes


def plain_features(text, books):
    bad, good, alone = plain_sizes(text, books)
    n = len(text.encode()) + 20
    return [(bad - good) / (bad + good + 1), alone / n, (alone - good) / n, (alone - bad) / n]


def test_scores_and_calibration_equal_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    books, (mean, spread, w) = quality.fit(table, labels)
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    # Every excerpt is a piece of a text of its class.
    for q, book in enumerate(books):
        own = "\n".join(t for i, t in texts.items() if marks.get(i) == q).encode()
        assert len(book) >= 8 and book[:100] in own and book[-100:] in own
    # The scores, from sizes that are measured again.
    some = sorted(texts)[::9]
    found = {r.doc_id: r.score for r in quality.score(narrow(table.where(table.doc_id.isin(some))), (books, (mean, spread, w))).collect()}
    for i in some:
        f = plain_features(texts[i], books)
        z = w[0] + sum((x - m) / s * c for x, m, s, c in zip(f, mean, spread, w[1:]))
        assert math.isclose(found[i], 1 / (1 + math.exp(-z)), rel_tol=1e-9, abs_tol=1e-12)


def test_the_fit_is_where_its_slope_is_zero():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(float)
    weight = np.where(y == 1, 2.0, 0.5)
    mean, spread, w = quality.logistic(x, y, weight)

    def loss(w):
        z = w[0] + ((x - mean) / spread) @ w[1:]
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + (w[1:] ** 2).sum() / 2 + 1e-6 * w[0] ** 2 / 2

    for i in range(len(w)):
        for step in (1e-3, -1e-3):
            moved = w.copy()
            moved[i] += step
            assert loss(moved) > loss(w)


def test_a_tie_stays(spark):
    """Nothing to learn from and as many good as bad labels: every score is exactly 0.5, which is good."""
    rows = docs(spark, [(1, ""), (2, None), (3, "a text"), (3, "a text")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(rows, labels) == (None, 0.5)
    assert quality.drop_rejected(rows, labels).count() == 4
