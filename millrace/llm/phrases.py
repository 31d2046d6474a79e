"""Phrase collocations by Toivonen's sampling.

1. A sample of the documents proposes phrases: those of up to three words that reach a lowered count there.
2. One pass over all documents counts the proposed phrases and their negative border exactly. The border is
   never listed: a phrase is in either set exactly if it is one word, or what is left without its last and
   without its first word was proposed.
3. A phrase of the border that turns out frequent is a failure of the sample. One more pass then expands the
   counted phrases until they are closed: a phrase that was not counted is, if both of its parts are frequent or
   are such phrases themselves. Longer ones that a failure could make frequent are thus counted in the same pass,
   and every frequent phrase has been counted, whatever the sample held.
4. Frequent phrases are cut, scored and joined with what contains them, as plain tables.

The proposed phrases are held as a Bloom filter of bounded size: one that it takes for proposed by mistake is
counted as well and, like all others, kept only if it is frequent. The second pass asks the first one's filter
what was counted, so no phrase is counted in both.

A task counts blocks of words of bounded size, so that a very long text is as good as many short ones, and
sends a partial count per phrase and block.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

#: Words of the longest phrase, and occurrences that make a phrase frequent.
LONGEST, LEAST = 4, 30
#: One of so many documents is in the sample, where so many occurrences propose a phrase.
SAMPLE, LOWERED = 16, 2
#: A phrase goes if a longer one around it has so many percent of its occurrences.
COVERED = 80
TOP = 2000
#: Bits a proposed phrase, and bits of the greatest filter (64 MB).
BITS, MOST_BITS, PROBES = 12, 1 << 29, 4
#: Words that are counted at a time, and bytes of a text that are cut into words at a time.
BLOCK, SLICE = 1_000_000, 4_000_000
ROWS = 100_000

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
COUNTED = "key string, n long"


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in SEPARATORS:
        table[c] = ord("\n")
    table[ord("\t")] = ord(" ")
    return bytes(table)


TABLE = _byte_table()


# Hashes and the filter -------------------------------------------------------------------------------------

def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of the phrase without its last word and of that word."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


def probes(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of hashes in a filter; ``bits`` is a power of two."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    step = mixed(h, h) | np.uint64(1)
    for i in range(PROBES):
        yield (h + np.uint64(i) * step) >> shift


def has(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for at in probes(h, len(bloom) * 64):
        found &= (bloom[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes that :class:`Block` gives to phrases."""
    seeds = {lang: lang_seed(lang) for lang in set(langs)}
    split = [p.encode().split(b" ") for p in phrases]
    sizes = np.array([len(w) for w in split], np.int64)
    words = np.array([xxhash.xxh64_intdigest(w, seeds[lang]) for lang, ws in zip(langs, split) for w in ws], np.uint64)
    start = np.cumsum(sizes) - sizes
    out = words[start] if len(sizes) else words
    for k in range(1, sizes.max(initial=0)):
        more = np.flatnonzero(sizes > k)
        out[more] = mixed(out[more], words[start[more] + k])
    return out


def filter_of(phrases: DataFrame, bits: int, old: np.ndarray | None = None) -> np.ndarray:
    """Filter of ``bits`` bits with ``(lang, phrase)`` rows, beside those of ``old``.

    Words of 64 bits are combined by their place before they come to the driver, so it gets ``bits / 64`` rows at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            at = np.concatenate(list(probes(h, bits)))
            place, code = np.unique(at >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(place), np.uint64)
            np.bitwise_or.at(value, code, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(value.view(np.int64))], names=["at", "bits"])

    words = phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    bloom = np.zeros(bits // 64, np.uint64) if old is None else old.copy()
    bloom[words["at"].to_numpy(np.int64)] |= words["bits"].to_numpy(np.int64).view(np.uint64)
    return bloom


def failures_of(phrases: DataFrame, known: np.ndarray) -> DataFrame:
    """The ``(lang, phrase)`` rows that a filter does not have."""
    held = phrases.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            yield batch.filter(pa.array(~has(held.value, h)))

    return phrases.select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


# Counting --------------------------------------------------------------------------------------------------

def tokens_of(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text, ``\\n`` between pieces, in slices with the number of words repeated from the slice before."""
    data = text.translate(TABLE).replace(b"\n", b" \n ")
    start, carried = 0, []
    while start < len(data):
        stop = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        stop = len(data) if stop < 0 else stop
        words = carried + [w for w in data[start:stop].split(b" ") if w]
        yield words, len(carried)
        tail = words[1 - LONGEST:]
        carried = tail[len(tail) - tail[::-1].index(b"\n"):] if b"\n" in tail else tail
        start = stop


class Numbers(dict):
    """Numbers of a language's words, given as they come."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__({b"\n": -1})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


class Block:
    """Words that a task has read, as numbers that a language has for itself; -1 ends a piece."""

    def __init__(self) -> None:
        self.numbers: dict[str, Numbers] = {}
        self.words: list[bytes] = []
        self.ids = array("q")
        self.old = array("q")

    def add(self, lang: str, words: list[bytes], carried: int) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = Numbers(self.words)
        self.old.extend(range(len(self.ids), len(self.ids) + carried))
        self.ids.extend(map(numbers.__getitem__, words))
        self.ids.append(-1)

    def counts(self, longest: int, known: np.ndarray | None, before: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Partial counts of the phrases that ``known`` admits, or of all without it.

        With ``before``, only phrases that this filter did not admit are counted, and each of them admits longer ones.
        """
        if not self.words:
            return
        ids = np.array(self.ids, np.int64)
        fresh = np.ones(len(ids), bool)
        fresh[np.array(self.old, np.int64)] = False
        v = len(self.words)
        lang = np.zeros(v, np.int64)
        for i, numbers in enumerate(self.numbers.values()):
            lang[np.fromiter(numbers.values(), np.int64, len(numbers))[1:]] = i
        names, seeds = [n.encode() + b"\n" for n in self.numbers], [lang_seed(n) for n in self.numbers]
        word_hash = np.fromiter(map(xxhash.xxh64_intdigest, self.words, map(seeds.__getitem__, lang.tolist())), np.uint64, v)
        words = pa.array(self.words, pa.binary())
        # The phrase at each place by its number, -1 for none; by number: its key, its hash, and whether it is new.
        key = pc.binary_join_element_wise(pa.array(names, pa.binary()).take(pa.array(lang)), words, b"")
        place, hashes, new = ids, word_hash, np.zeros(v, bool)
        if before is None:
            count = np.bincount(ids[(ids >= 0) & fresh], minlength=v)
            yield from self._rows(key, count)
            yield from self._rows(pa.array(names, pa.binary()), np.bincount(lang, weights=count, minlength=len(names)))
        for k in range(2, longest + 1):
            good = np.ones(len(hashes), bool) if known is None else new | has(known, hashes)
            past = good if before is None else has(before, hashes) & ~new
            # The last entry stands for places without a phrase.
            at_good = np.append(good, False)[place]
            pair = np.flatnonzero(at_good[:-1] & at_good[1:])
            if not len(pair):
                return
            code, unique = pd.factorize(place[pair] * np.int64(v) + ids[pair + k - 1])
            head, last = unique // v, unique % v
            count = np.bincount(code[fresh[pair + k - 1]], minlength=len(unique))
            key = pc.binary_join_element_wise(key.take(pa.array(head)), words.take(pa.array(last)), b" ")
            hashes, new = mixed(hashes[head], word_hash[last]), np.zeros(len(unique), bool)
            if before is not None:
                at_past = np.append(past, False)[place]
                new[code[~(at_past[pair] & at_past[pair + 1])]] = True
                count[~new] = 0
            yield from self._rows(key, count)
            place = np.full(len(place) - 1, -1, np.int64)
            place[pair] = code

    @staticmethod
    def _rows(key: pa.Array, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(count)
        for i in range(0, len(some), ROWS):
            at = some[i:i + ROWS]
            yield pa.RecordBatch.from_arrays([key.take(pa.array(at)).cast(pa.string()), pa.array(count[at].astype(np.int64))], names=["key", "n"])


def count_phrases(docs: DataFrame, longest: int, least: int, known: np.ndarray | None = None, before: np.ndarray | None = None) -> DataFrame:
    """Exact counts of ``(lang, text)`` rows' phrases, if at least ``least``: ``(lang, phrase, k, n)`` rows.

    Rows with ``k`` 0 have the number of all words of a language, whatever it is; with ``before`` there are none.

    Without ``known`` all phrases of up to ``longest`` words are counted, with it single words and the phrases whose two
    shorter parts the filter has; with ``before`` only phrases that this filter did not admit, and then also those that
    have such a phrase as a part.
    """
    context = docs.sparkSession.sparkContext
    held = [None if b is None else context.broadcast(b) for b in (known, before)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [None if b is None else b.value for b in held]
        block = Block()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for words, carried in tokens_of(text.as_py()):
                    block.add(lang, words, carried)
                    if len(block.ids) >= BLOCK:
                        yield from block.counts(longest, *filters)
                        block = Block()
        yield from block.counts(longest, *filters)

    rows = docs.select("lang", F.encode("text", "UTF-8").alias("text")).mapInArrow(run, COUNTED)
    # One key of language and phrase: words hold no line end, so what follows the last one is the phrase.
    counted = rows.groupBy("key").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.endswith("key", F.lit("\n")))
    phrase = F.substring_index("key", "\n", -1)
    return counted.select(F.expr("substring(key, 1, length(key) - length(substring_index(key, '\n', -1)) - 1)").alias("lang"),
                          phrase.alias("phrase"), F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("k"), "n")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE, lowered: int = LOWERED,
                     most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences, and the number of full passes.

    Rows are ``(lang, phrase, k, n)``; rows with ``k`` 0 have the number of all words of a language. A phrase is counted
    within pieces of texts, overlaps included, and per language; a null language is ``und``, a null text is empty.
    """
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known = proposed_by(rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0), longest - 1, lowered, most_bits)
    found = materialize(count_phrases(rows, longest, least, known), "phrases")
    parts = found.where(F.col("k").between(1, longest - 1))
    if not failures_of(parts, known).count():
        return found, 1
    exact = filter_of(parts, len(known) * 64)
    more = materialize(count_phrases(rows, longest, least, exact, known), "phrases")
    return found.unionByName(more), 2


def proposed_by(sample: DataFrame, longest: int, lowered: int, most_bits: int) -> np.ndarray:
    """Filter of the phrases of up to ``longest`` words that a sample has ``lowered`` times, found word by word."""
    known = before = None
    for k in range(1, longest + 1):
        counted = materialize(count_phrases(sample, k, lowered, known, before).where(F.col("k") == k), "proposed")
        if known is None:
            # Longer phrases are several times as many as words; a fuller filter only admits more.
            bits = min(max(1 << (counted.count() * BITS * 3).bit_length(), 1 << 16), most_bits)
            known, before = filter_of(counted, bits), np.zeros(bits // 64, np.uint64)
        else:
            known, before = filter_of(counted, bits, known), known
    return known


# Scores ----------------------------------------------------------------------------------------------------

def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **mining) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two words or more and ``a`` occurrences is cut after each of its words; the cut with the lowest
    ``floor(2000000 * a / (l + r))`` counts, the first of equal ones. A phrase goes if a longer frequent one holds it
    and has 80 % of its occurrences. Ranks order by score, ``a`` and phrase. Null texts are empty, a null language is
    ``und``, repeated rows count each, an empty table gives no rows; columns other than id, text and language are ignored.
    """
    counted, _ = frequent_phrases(docs, least, **mining)
    phrases = counted.where("k > 0")
    long = phrases.where("k > 1")
    words = F.split("phrase", " ")

    def some(start, size):
        return F.array_join(F.slice(words, start, size), " ")

    cuts = long.select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", some(F.lit(1), F.col("cut")).alias("_left"), some(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("_right"))
    left = phrases.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_lp"), F.col("n").alias("l"))
    right = phrases.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rp"), F.col("n").alias("r"))
    cuts = cuts.join(left, (F.col("lang") == F.col("_ll")) & (F.col("_left") == F.col("_lp"))).join(
        right, (F.col("lang") == F.col("_rl")) & (F.col("_right") == F.col("_rp")))
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))

    inside = phrases.where("k > 2").select("lang", "n", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("k") - size + 1), lambda start: some(start, size))))).alias("part"))
    inside = inside.groupBy(F.col("lang").alias("_il"), F.col("part").alias("_ip")).agg(F.max("n").alias("_around"))
    around = F.expr("100 * cast(_around as decimal(19,0))") >= F.expr(f"{COVERED} * cast(a as decimal(19,0))")
    kept = best.join(inside, (F.col("lang") == F.col("_il")) & (F.col("phrase") == F.col("_ip")), "left").where(
        ~F.coalesce(around, F.lit(False)))
    # Spark keeps each task's first rows of a language before it shuffles them, so no task gets a whole language.
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counted.where("k = 0").select(F.col("lang").alias("_tl"), F.col("n"))
    return ranked.join(total, F.col("lang") == F.col("_tl")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n",
        F.col("b.score").alias("score"))
