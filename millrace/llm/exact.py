"""Exact duplicates by a Golomb-coded exchange of fingerprints.

1. Each sender (a partition of the scan) keeps the 64-bit hash of every text it reads.
2. It sorts its distinct hashes, cuts them by owner (equal ranges of the hash space) and sends each
   owner one Golomb-Rice-coded block: a few bits more than log2(range / hashes) per hash.
3. An owner decodes its blocks and answers each with a bitmap: which hashes another sender has too.
4. The sender turns bitmaps, and hashes that it holds twice itself, into suspect ids. Only suspects'
   texts are shuffled, and only equal bytes make them one group.

A hot text is one hash per sender in the exchange, and one partial aggregate per task afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut_lineage, narrow, same
from millrace.session import materialize

#: Hashes per owner; the number of owners follows the number of rows.
OWNER_HASHES = 500_000


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct uint64 values as (remainder bits, unary quotients, packed remainders) of their gaps."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1]) // len(values) + 1
    bits = max(mean.bit_length() - 1, 0)
    stops = np.cumsum((gaps >> np.uint64(bits)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    places = np.arange(bits, dtype=np.uint64)
    rest = ((gaps[:, None] >> places[None, :]) & np.uint64(1)).astype(np.uint8)
    return bits, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def golomb_decode(count: int, bits: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The values that :func:`golomb_encode` was given."""
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(bits)
    if bits:
        low = np.unpackbits(np.frombuffer(rest, np.uint8))[:count * bits].reshape(count, bits).astype(np.uint64)
        gaps += (low << np.arange(bits, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold equal ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def owner_start(owner: int, owners: int) -> np.uint64:
    return np.uint64(-(-(owner << 32) // owners) << 32)


def _sorted_hashes(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(rows["h"].to_numpy().view(np.uint64), return_counts=True)


def suspects(df: DataFrame) -> DataFrame:
    """Hashes of ``(doc_id, text)`` rows that more than one row has, with the ids: ``(doc_id, h)``."""
    prints = materialize(df.select("doc_id", F.xxhash64("text").alias("h"), F.spark_partition_id().alias("sender")),
                         "fingerprints")
    owners = max(prints.count() // OWNER_HASHES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, _ = _sorted_hashes(rows)
        owner = owner_of(hashes, owners)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        out = []
        for part in np.split(hashes, cuts[1:]):
            o = int(owner_of(part[:1], owners)[0])
            bits, unary, rest = golomb_encode(part - owner_start(o, owners))
            out.append((int(rows["sender"].iloc[0]), o, len(part), bits, unary, rest))
        return pd.DataFrame(out, columns=["sender", "owner", "n", "bits", "unary", "rest"])

    def answer(blocks: pd.DataFrame) -> pd.DataFrame:
        lists = [golomb_decode(*b) for b in blocks[["n", "bits", "unary", "rest"]].itertuples(index=False)]
        values, copies = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[copies > 1]
        return blocks[["sender", "owner"]].assign(
            bitmap=[np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists])

    def receive(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"doc_id": [], "h": []})
        hashes, copies = _sorted_hashes(rows)
        owner, twice = owner_of(hashes, owners), copies > 1
        for o, bits in bitmaps[["owner", "bitmap"]].itertuples(index=False):
            lo, hi = np.searchsorted(owner, [o, o + 1])
            twice[lo:hi] |= np.unpackbits(np.frombuffer(bits, np.uint8))[:hi - lo].astype(bool)
        at = np.searchsorted(hashes, rows["h"].to_numpy().view(np.uint64))
        return rows.loc[twice[at], ["doc_id", "h"]]

    blocks = prints.select("sender", "h").groupBy("sender").applyInPandas(
        send, "sender int, owner long, n long, bits int, unary binary, rest binary")
    bitmaps = blocks.groupBy("owner").applyInPandas(answer, "sender int, owner long, bitmap binary")
    id_type = dict(prints.dtypes)["doc_id"]
    return prints.groupBy("sender").cogroup(bitmaps.groupBy("sender")).applyInPandas(
        receive, f"doc_id {id_type}, h long")


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that share their hash with another row, as a written table, and the ids of those rows."""
    found = cut_lineage(suspects(narrow(df)).select(F.col("doc_id").alias("_id")).distinct())
    return materialize(df.join(found, same(df["doc_id"], found["_id"]), "left_semi"), "suspects"), found


def exact_groups(df: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty text. The row with the largest doc_id
    of a group stays. A null doc_id ranks below every other, and a group of null ids keeps a null id.
    Rows that repeat both id and text share one decision and each count in ``group_size``. Other
    columns are ignored. An empty table gives an empty result.
    """
    df = narrow(df)
    copies, ids = _split(df)
    sha = F.sha2("text", 256).alias("text_sha256")
    check = [sha, F.xxhash64("text").alias("_h"), F.octet_length("text").alias("_bytes")]
    # Bytes decide the group; the digests only carry its answer back to the rows.
    groups = copies.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).select(
        *check, "keep_id", "group_size")
    many = copies.select("doc_id", *check).join(groups, ["text_sha256", "_h", "_bytes"]).select(
        "doc_id", "keep_id", "group_size", same(F.col("doc_id"), F.col("keep_id")).alias("kept"), "text_sha256")
    alone = df.select("doc_id", sha).join(ids, same(F.col("doc_id"), F.col("_id")), "left_anti")
    return many.unionByName(alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                         F.lit(True).alias("kept"), "text_sha256"))


def drop_exact(df: DataFrame) -> DataFrame:
    """The input without all but one row of each distinct text: the one with the largest doc_id.

    Equal texts with the same id, or with null ids only, are told apart by their other columns. A
    null text equals an empty one.
    """
    copies, ids = _split(df)
    # The id leads the struct, so the greatest struct is the row that stays.
    rest = [c for c in df.columns if c != "doc_id"]
    best = copies.groupBy(F.coalesce("text", F.lit("")).alias("_text")).agg(
        F.max(F.struct("doc_id", *rest)).alias("_row")).select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    alone = df.join(ids, same(df["doc_id"], ids["_id"]), "left_anti")
    return alone.unionByName(best)
