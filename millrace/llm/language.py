"""Language by cross-parsing entropy.

For each language a suffix automaton holds a bounded sample of its labelled text. A text is parsed
greedily into the longest phrases that occur in the sample; its cross-entropy estimate is phrases times
the bits of a place in the sample, per letter. The language with the lowest estimate wins.

Letters are lower-cased and every run of other characters is one separator. Phrases do not cross the
ends of blocks of ``BLOCK`` letters, so that all blocks of a batch of texts are parsed in step, a letter
of every block and language at a time.
"""

from __future__ import annotations

import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_texts, narrow, thinned

#: The automata are built from at most so many texts of a language, an excerpt of each, and so many letters in all,
#: but of a language that has them never fewer than ``LEAST``.
TEXTS, EXCERPT, LETTERS, LEAST = 400, 400, 160_000, 40_000
BLOCK = 256
#: Letters with a column in the table, the most frequent ones, and places of the table; others are searched for. No result depends on these.
COLUMNS, PLACES = 120, 50_000_000


def normalise(text: str) -> str:
    """Lower-cased letters with single spaces between."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is the start."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return nexts


class Parser:
    """Tables for parsing texts against the samples of several languages.

    Codes: 0 a separator, 1 to n the letters of all samples, n + 1 any other letter, n + 2 the filling of a block.
    The first letters and the separator have a column of ``table``, as have other letters and the filling:
    ``table[state * width + column]`` is the next state times the width, inverted if a phrase ends before
    this letter. The states of all languages share one table. For the letters without a column, ``keys`` has
    each state and letter that go on, sorted, and ``begins`` where a new phrase with a letter starts.
    """

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        count = Counter("".join(samples.values()))
        count.pop(" ", None)
        letters = sorted(sorted(count), key=lambda c: -count[c])
        code = {" ": 0} | {c: i + 1 for i, c in enumerate(letters)}
        self.other = other = len(letters) + 1
        self.fill = other + 1
        self.codes = np.fromiter((code.get(chr(p).lower()[:1], other) if chr(p).isalpha() else 0
                                  for p in range(sys.maxunicode + 1)), np.min_scalar_type(self.fill))
        automata = [suffix_automaton([code[c] for c in samples[lang]]) for lang in self.langs]
        self.letters = n = min(len(letters), COLUMNS, max(PLACES // sum(map(len, automata)) - 3, 1))
        self.width = n + 3
        self.begins = np.zeros((len(self.langs), self.fill + 1), np.int32)
        self.bits, self.roots, tables, keys, base = [], [], [], {}, 0
        for i, (lang, states) in enumerate(zip(self.langs, automata)):
            start = states[0]
            rows = np.empty((len(states), self.width), np.int64)
            rows[:] = ~(np.array([start.get(c, 0) for c in range(n + 1)] + [0, 0]) + base)[None, :]
            self.begins[i] = [(start.get(c, 0) + base) * self.width for c in range(self.fill + 1)]
            for s, to in enumerate(states):
                for c, t in to.items():
                    if c <= n:
                        rows[s, c] = t + base
                    else:
                        keys[(s + base) * self.fill + c] = (t + base) * self.width
            rows[:, n + 2] = np.arange(len(states)) + base
            tables.append(np.where(rows < 0, ~(~rows * self.width), rows * self.width).astype(np.int32).ravel())
            self.roots.append(base * self.width)
            self.bits.append(np.log2(max(len(samples[lang]), 2)))
            base += len(states)
        self.table = np.concatenate(tables)
        self.keys = np.array(sorted(keys), np.int64)
        self.nexts = np.array([keys[k] for k in self.keys.tolist()], np.int32)

    @classmethod
    def of(cls, tables: dict) -> Parser:
        """A parser with the tables (``vars``) of another; plain data is what executors are sent."""
        parser = cls.__new__(cls)
        parser.__dict__.update(tables)
        return parser

    def blocks(self, text: str) -> np.ndarray:
        codes = self.codes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        codes = codes[(codes != 0) | (np.roll(codes, 1) != 0)] if codes.any() else codes[:0]
        padded = np.full(-(-len(codes) // BLOCK) * BLOCK, self.fill, self.codes.dtype)
        padded[:len(codes)] = codes
        return padded.reshape(-1, BLOCK)

    def after(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next states, as in the table, of a row of states for each language and letters without a column."""
        wanted = (state // self.width).astype(np.int64) * self.fill + codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.nexts[at], ~self.begins[:, codes])

    def parse(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """The best language and its lead over the next (0 to 1) for each text; none without letters."""
        parts = [self.blocks(t) for t in texts]
        rows = np.cumsum([0, *map(len, parts)])
        phrases = np.zeros((len(self.langs), rows[-1] + 1), np.int32)
        every = np.concatenate(parts) if rows[-1] else np.empty((0, BLOCK), self.codes.dtype)
        for at in range(0, len(every), 8192):
            block = np.ascontiguousarray(every[at:at + 8192].T).astype(np.int32)
            state = np.repeat(np.array(self.roots, np.int32)[:, None], block.shape[1], axis=1)
            ends = np.ones_like(state)
            # Letters without a column take that of other letters, and their next state is then set.
            columns = np.where(block > self.letters, np.where(block == self.fill, self.letters + 2, self.letters + 1), block).astype(np.int32)
            for codes, column in zip(block, columns):
                rare = np.flatnonzero((codes > self.letters) & (codes < self.other)) if len(self.keys) else ()
                found = self.after(state[:, rare], codes[rare]) if len(rare) else None
                state = self.table.take(state + column)
                if len(rare):
                    state[:, rare] = found
                cut = state >> 31
                ends -= cut
                state ^= cut
            phrases[:, at:at + block.shape[1]] = ends
        total = np.concatenate([np.zeros((len(self.langs), 1)), np.cumsum(phrases[:, :-1], axis=1)], axis=1)
        bits = (total[:, rows[1:]] - total[:, rows[:-1]]) * np.array(self.bits)[:, None]
        out = []
        for i, part in enumerate(parts):
            if not len(part):
                out.append((None, 0.0))
                continue
            order = np.argsort(bits[:, i], kind="stable")
            best = bits[order[0], i]
            out.append((self.langs[order[0]], 1.0 if len(order) < 2 else float(1 - best / bits[order[1], i])))
        return out


def samples(df: DataFrame) -> dict[str, str]:
    """Normalised sample text of each language in ``doc_id, text, lang``; rows without a language or text are not used.

    The ``TEXTS`` rows of a language with the smallest hash of the id give an excerpt each, at a place
    that follows from the id. All languages get an equal part of ``LETTERS``, or ``LEAST`` if that is more.
    """
    ids = df.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", F.xxhash64("doc_id").alias("o"))
    count = ids.groupBy("lang").agg(F.count("*").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.pmod("o", F.lit(1 << 30)), "doc_id")
    # A row per language, so it may be broadcast.
    chosen = ids.join(F.broadcast(count), "lang").where(thinned(F.col("o"), TEXTS, F.col("count")))
    chosen = chosen.withColumn("r", F.row_number().over(order)).where(F.col("r") <= TEXTS)
    # At most TEXTS short rows per language, so they may be broadcast.
    texts = df.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen.select("doc_id", "lang", "o")), "doc_id")
    start = F.pmod(F.xxhash64("o"), F.greatest(F.length("text") - EXCERPT, F.lit(0)).cast("long") + 1).cast("int") + 1
    rows = texts.select("lang", "o", F.substr("text", start, F.lit(EXCERPT)).alias("part")).collect()
    langs = sorted({r.lang for r in rows})
    out = {}
    for lang in langs:
        parts = sorted((r.o, r.part) for r in rows if r.lang == lang)
        text = normalise(" ".join(p for _, p in parts))[:max(LETTERS // len(langs), LEAST)]
        if text:
            out[lang] = text
    return out


def predict(df: DataFrame, learned: dict[str, str]) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` instead of ``text``.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was
    learned. The score is the lead over the second language, one minus the ratio of the two estimates;
    a tie goes to the first by name with score 0, and a single learned language gets score 1.
    """
    if not learned:
        return df.drop("text").withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast(vars(Parser(learned)))

    def work():
        parser = Parser.of(shared.value)

        def run(texts):
            found = parser.parse(texts)
            return [[lang or "und" for lang, _ in found], [s for _, s in found]]
        return run

    return map_texts(df, work, "lang_pred string, score double", ["lang_pred", "score"], [pa.string(), pa.float64()])


def identify(df: DataFrame, learn: DataFrame) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``df``, learned from ``doc_id, text, lang`` of ``learn``.

    Rows of ``learn`` without a language teach nothing, rows that repeat teach once per row; rows of ``df`` that repeat are each
    returned. Other columns are ignored, and an empty ``df`` gives an empty result.
    """
    return predict(narrow(df), samples(learn))
