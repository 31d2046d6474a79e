"""Token counts of the sections of a text, from one encoding of the whole text.

A whole text is encoded once with a byte-level BPE vocabulary. The tokens' byte spans, the running sum of
their lengths, are mapped to the sections' character spans and joined with them as intervals, by two
binary searches per section. A token that crosses a border belongs to the section that holds its first
byte (rule ``first``) or its last byte (rule ``last``), so sections that split a text share out its tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts, narrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are cut into words (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last")
#: Runs of white space that the vocabulary's expression is not given, as it would try them from every end.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def load(path: str = VOCABULARY) -> dict[bytes, int]:
    """Ranks of a vocabulary file that the driver can read."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encode_long(tool: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text with runs of white space of any length, the same as from the expression alone.

    Of such a run the expression makes one word, but for its last character if a word follows, which may begin with it.
    """
    ids, start = [], 0
    for run in BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += tool.encode_ordinary(text[start:run.start()])
        ids += tool._core_bpe.encode_single_piece(text[run.start():end].encode())
        start = end
    return ids + tool.encode_ordinary(text[start:])


def line_spans(text: str) -> np.ndarray:
    """Character spans ``(start, end)`` of the lines of a text, each with the line end that closes it."""
    sizes = [len(x) + 1 for x in text.split("\n")]
    sizes[-1] -= 1
    ends = np.cumsum(sizes)
    return np.stack([ends - sizes, ends], axis=1)


def byte_offsets(text: str, places: np.ndarray) -> np.ndarray:
    """Byte offsets, in UTF-8, of character offsets of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) == len(text):
        return places
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[places]


def attribute(sizes: np.ndarray, spans: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each byte span, and how many of them reach out of it, from the tokens' byte lengths.

    Spans may overlap, leave gaps or be empty; each counts what falls to it alone.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at = starts if rule == "first" else ends - 1
    low, high = np.searchsorted(at, spans[:, 0]), np.searchsorted(at, spans[:, 1])
    inside = (np.searchsorted(ends, spans[:, 1], "right") if rule == "first" else high) - (
        low if rule == "first" else np.searchsorted(starts, spans[:, 0]))
    count = np.maximum(high - low, 0)
    return count, count - np.clip(inside, 0, count)


def count_tokens(df: DataFrame, ranks: dict[bytes, int], rule: str = "first",
                 spans: Callable[[str], np.ndarray] = line_spans) -> DataFrame:
    """``df`` with a row per section instead of ``text``: ``section, start, end, n_tokens, n_crossing, doc_tokens``.

    ``spans`` gives the character spans of a text's sections; ``start`` and ``end`` are in code points.
    ``n_crossing`` of the ``n_tokens`` reach into another section, ``doc_tokens`` is the whole text's count.
    A null text counts as empty; an empty text has one empty line and no tokens. Texts are encoded as
    ordinary text, without special tokens. Repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    df = df.withColumn("text", F.coalesce("text", F.lit("")))

    def work():
        vocabulary = shared.value
        tool = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]

        def one(text: str) -> tuple:
            where = spans(text)
            tokens = sizes[np.array(encode_long(tool, text), np.int64)]
            counts, crossing = attribute(tokens, byte_offsets(text, where), rule)
            return where[:, 0], where[:, 1], counts, crossing, len(tokens)

        def run(texts: list[str]) -> Iterator[list]:
            return zip(*map(one, texts)) if texts else [[]] * 5
        return run

    ints = pa.list_(pa.int64())
    found = map_texts(df, work, "s array<long>, e array<long>, n array<long>, c array<long>, doc_tokens long",
                      ["s", "e", "n", "c", "doc_tokens"], [ints, ints, ints, ints, pa.int64()])
    kept = [c for c in df.columns if c != "text"]
    return found.select(*kept, "doc_tokens", F.posexplode(F.arrays_zip("s", "e", "n", "c")).alias("section", "x")).select(
        *kept, "section", F.col("x.s").alias("start"), F.col("x.e").alias("end"), F.col("x.n").alias("n_tokens"),
        F.col("x.c").alias("n_crossing"), "doc_tokens")


def line_tokens(df: DataFrame, path: str = VOCABULARY, rule: str = "first") -> DataFrame:
    """Token counts of the lines of ``doc_id, text``; other columns are ignored."""
    return count_tokens(narrow(df), load(path), rule)
