"""Quality, language, SentencePiece and token counts: held-out accuracy, brute force and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece as library
import tiktoken
from helpers import EXTRA, ODD, docs, rows_of
from pyspark.sql import functions as F

from millrace.llm import language, quality, sentencepiece, tokens
from millrace.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_logistic_finds_the_odds():
    x = np.repeat([[0.0], [1.0]], 500, axis=0)
    y = np.r_[np.ones(100), np.zeros(400), np.ones(400), np.zeros(100)]
    mean, spread, w = quality.logistic(x, y, np.ones(1000))
    p = 1 / (1 + np.exp(-(w[0] + (np.array([0, 1]) - mean[0]) / spread[0] * w[1])))
    assert np.allclose(p, [0.2, 0.8], atol=0.02)


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op2_quality_classifier"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_quality_of_odd_rows(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("the of and house tree water light river stone".split())
    good = [(100 + i, " ".join(word() for _ in range(60))) for i in range(60)]
    bad = [(200 + i, " ".join(word().upper() + rng.choice(["!!", "$$$", "###"]) for _ in range(60))) for i in range(60)]
    df = docs(spark, ODD + good + bad, EXTRA)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (1, None), (2, 7)],
                                   "doc_id long, quality int")
    kept = quality.drop_rejected(df, labels)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {i for i, _ in good} <= set(ids) and not {i for i, _ in bad} & set(ids)
    scored = quality.score(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), quality.fit(df, labels))
    assert scored.count() == df.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    one_class = quality.fit(df, labels.where("quality = 1"))
    assert one_class == (None, 1.0) and quality.fit(df, labels.limit(0)) == (None, 0.5)
    assert quality.drop_rejected(df.limit(0), labels).count() == 0


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(2)
    word = [rng.randint(1, 3) for _ in range(60)]
    states = language.suffix_automaton(word)
    inside = {tuple(word[i:j]) for i in range(60) for j in range(i, 61)}

    def accepts(part):
        s = 0
        for c in part:
            s = states[s].get(c)
            if s is None:
                return False
        return True

    assert all(accepts(p) for p in inside)
    for _ in range(500):
        part = tuple(rng.randint(1, 3) for _ in range(rng.randint(1, 8)))
        assert accepts(part) == (part in inside)


def phrases_of(text, sample):
    """Phrases as the table counts them: a letter that fits nowhere leaves the parse at the start."""
    found = 0
    for at in range(0, len(text), language.BLOCK):
        block, now, found = text[at:at + language.BLOCK], "", found + 1
        for c in block:
            if now + c in sample:
                now += c
            else:
                found, now = found + 1, c if c in sample else ""
    return found


def test_parsing_counts_phrases():
    samples = {"aa": language.normalise("the cat and the dog were here"), "bb": language.normalise("le chat et le chien sont la")}
    parser = language.Parser(samples)
    for text in ("the cat were", "le chien et le dog", "zebra the 12 Cat!", "x", "the " * 300):
        norm = language.normalise(text)
        bits = {k: phrases_of(norm, s) * np.log2(len(s)) for k, s in samples.items()}
        best = min(sorted(bits), key=bits.get)
        lang, score = parser.parse([text])[0]
        assert lang == best and score == pytest.approx(1 - bits[best] / max(bits.values()))
    assert parser.parse(["", "12 !", "the"])[:2] == [(None, 0.0), (None, 0.0)]


@pytest.mark.parametrize("places", [50_000_000, 1])
def test_every_letter_of_every_script_counts(monkeypatch, places):
    monkeypatch.setattr(language, "PLACES", places)
    rng = random.Random(12)
    # Words of scripts with many letters; two languages share their letters and differ in their words.
    words = {lang: ["".join(chr(rng.randint(*letters)) for _ in range(2)) for _ in range(600)]
             for lang, letters in {"ja": (0x5000, 0x57ff), "zh": (0x5000, 0x57ff), "ko": (0xac00, 0xafff)}.items()}
    words["en"] = "the cat and dog were here with many other animals of all kinds".split() * 40
    samples = {lang: language.normalise(" ".join(rng.choices(w, k=900))) for lang, w in words.items()}
    parser = language.Parser(samples)
    for lang, w in words.items():
        for n in (1, 30, 300):
            text = " ".join(rng.choices(w, k=n)) + " \u1200 the"
            norm = language.normalise(text)
            bits = {k: phrases_of(norm, s) * np.log2(len(s)) for k, s in samples.items()}
            best, second = sorted(sorted(bits), key=bits.get)[:2]
            found, score = parser.parse([text])[0]
            assert found == best and score == pytest.approx(1 - bits[best] / bits[second])
            assert n < 30 or found == lang


def test_samples_do_not_shrink_with_the_number_of_languages(spark):
    rng = random.Random(13)
    learn = docs(spark, [(i, "".join(rng.choices("abcdefgh", k=400)), f"l{i % 8}") for i in range(8 * 120)])
    assert {len(s) for s in language.samples(learn).values()} == {40_000}


def test_language_of_held_out_documents(spark):
    found = QUERIES["op3_language_id"](spark, MEDIUM)
    rows = found.join(spark.read.parquet(f"{MEDIUM}/documents.parquet"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_language_of_odd_rows(spark):
    learn = docs(spark, [(i, "the cat and the dog", "en") for i in range(5)] + [(9, "le chat et le chien", "fr"), (10, "x", None),
                                                                             (11, None, "de"), (None, "y", "es")], EXTRA)
    found = {(r.doc_id, r.lang_pred) for r in language.identify(docs(spark, [*ODD, (50, "le chien"), (51, "the dog")], EXTRA), learn).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (50, "fr"), (51, "en")} <= found
    assert {r.lang_pred for r in language.identify(docs(spark, ODD), learn.limit(0)).collect()} == {"und"}
    assert language.identify(docs(spark, []), learn).count() == 0


@pytest.fixture(scope="module")
def machine():
    return sentencepiece.load()


def test_encoding_equals_the_library(machine, spark):
    official = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(3)
    pieces = [p for p, t in zip(machine.model.pieces, machine.model.types) if t == sentencepiece.NORMAL]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    texts += ["", " ", "  a  b ", "a▁b", "\x00\n\t", "<s><0x41>", "aaaaaaaaaaaaaaaa", "日本語😀é", "ab" * 5000]
    for text in texts:
        ids = machine.encode(text)
        assert ids == official.encode(text)
        assert machine.decode(ids) == official.decode(ids)
        assert "▁" in text or machine.decode(ids) == text


def test_lightest_path_of_a_unigram_model():
    """Against all segmentations of short texts."""
    scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.2, "aba": -4.9, "▁": -1.0, "▁a": -2.1}
    model = sentencepiece.Model.__new__(sentencepiece.Model)
    model.pieces, model.scores = ["<unk>", *scores], [0.0, *scores.values()]
    model.types = [sentencepiece.UNKNOWN] + [sentencepiece.NORMAL] * len(scores)
    model.kind, model.byte_fallback, model.prefix, model.squeeze = sentencepiece.UNIGRAM, False, True, False
    own = sentencepiece.Transducer(model)

    def lightest(text):
        if not text:
            return 0.0
        return min((-scores[p] + lightest(text[len(p):]) for p in scores if text.startswith(p)), default=float("inf"))

    for text in ("a", "ab", "abab", "ba aba b", "bbabaab"):
        ids = own.encode(text)
        assert "".join(model.pieces[i] for i in ids) == own.normalise(text)
        assert sum(-model.scores[i] for i in ids) == pytest.approx(lightest(own.normalise(text)))
    assert own.encode("az") == [model.pieces.index("▁a"), 0]


def test_encoding_of_odd_rows(spark, machine):
    df = docs(spark, ODD, EXTRA)
    found = sentencepiece.encode(df, machine)
    assert "ids" in found.columns and found.columns.count("ids") == 1
    assert sorted((r.n_ids for r in found.where("doc_id in (1, 2)").collect())) == [0, 0]
    back = sentencepiece.decode(found.select("doc_id", "ids"), machine)
    plain = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert rows_of(back) == rows_of(plain)
    assert sentencepiece.encode_documents(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sentencepiece.Model(b"\x12\x02\x18\x03")


def brute_counts(text, tool, spans, rule):
    """Tokens of each span, one token after the other."""
    starts = [len(text[:s].encode()) for s, _ in spans], [len(text[:e].encode()) for _, e in spans]
    out = [[0, 0] for _ in spans]
    at = 0
    for token in tool.encode_ordinary(text):
        size = len(tool.decode_single_token_bytes(token))
        place = at if rule == "first" else at + size - 1
        for k, (s, e) in enumerate(zip(*starts)):
            if s <= place < e:
                out[k][0] += 1
                out[k][1] += at < s or at + size > e
        at += size
    return out


@pytest.mark.parametrize("rule", tokens.RULES)
def test_token_counts(spark, rule):
    ranks = tokens.load()
    tool = tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for _, t in ODD if len(t or "") < 1000] + ["one\ntwo\n\n  three é😀\n", "a\n\n\n\nb", "<|endoftext|>\nx"]
    for text in texts:
        spans = tokens.line_spans(text)
        assert "".join(text[s:e] for s, e in spans) == text
        halves = np.array([[0, len(text) // 2], [len(text) // 3, len(text)], [1, 1]]) if len(text) > 3 else spans
        sizes = np.array([len(tool.decode_single_token_bytes(t)) for t in tool.encode_ordinary(text)], np.int64)
        for where in (spans, halves):
            counts, crossing = tokens.attribute(sizes, tokens.byte_offsets(text, where), rule)
            assert [list(x) for x in zip(counts, crossing)] == brute_counts(text, tool, where, rule)
    df = docs(spark, ODD, EXTRA)
    found = tokens.line_tokens(df, rule=rule)
    sums = found.groupBy("doc_id", "doc_tokens").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()
    whole = {i: len(tool.encode_ordinary(t or "")) for i, t in ODD if i not in (4, None)}
    assert {r.doc_id: r.n for r in sums if r.doc_id in whole} == whole
    assert tokens.line_tokens(docs(spark, []), rule=rule).count() == 0
    with pytest.raises(ValueError):
        tokens.count_tokens(df, ranks, "middle")
