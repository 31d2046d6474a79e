"""Phrase mining, filter audit and chat formatting against brute force."""

import hashlib
import json
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from helpers import EXTRA, ODD, docs, rows_of

from millrace.llm import audit, chat, phrases

# Phrases ---------------------------------------------------------------------------------------------------


def brute_counts(rows, longest=4):
    """Occurrences of every phrase by (lang, words), and the words of every language."""
    found, total = Counter(), Counter()
    for _, text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                found.update((lang or "und", tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return found, total


def brute_collocations(rows, least, top):
    found, total = brute_counts(rows)
    often = {p: n for p, n in found.items() if n >= least}
    out = []
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        score, cut, left, right = min(
            (2_000_000 * a // (often[lang, words[:c]] + often[lang, words[c:]]), c, often[lang, words[:c]], often[lang, words[c:]])
            for c in range(1, len(words)))
        covered = any(other == lang and len(w) > len(words) and 100 * n >= 80 * a
                      and any(w[i:i + len(words)] == words for i in range(len(w))) for (other, w), n in often.items())
        if not covered:
            out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(ranked)


def wordy(n, seed=3):
    """Texts in three languages with common phrases, rare ones, blanks of all kinds and pieces."""
    rng = random.Random(seed)
    common = [["new", "york", "city", "hall"], ["of", "the"], ["of", "the", "people"], ["é", "日本"], ["a", "a", "a", "a", "a"], ["x y", "z\x85"]]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            words += rng.choice(common) if rng.random() < 0.6 else [rng.choice("bcdef") + str(rng.randrange(9))]
            if rng.random() < 0.2:
                words[-1] += rng.choice([".", ",", "\n", "\r\n", "\x0b", " ; ", "!?"])
        text = "".join(w + rng.choice([" ", "\t", "  "]) for w in words)
        out.append((i, text.title() if i % 5 == 0 else text, rng.choice(["en", "fr", None])))
    return out


@pytest.mark.parametrize("mining", [{}, {"sample": 2, "lowered": 9}, {"sample": 1 << 40}, {"most_bits": 64}])
def test_collocations_equal_brute_force(spark, mining):
    """Whatever the sample holds: a good one, one with too few phrases, none at all, and a filter that admits everything."""
    rows = wordy(150) + [(1000, None, "en"), (1001, "", None), (1002, "New York City Hall", "en"), (1002, "New York City Hall", "en")]
    found = phrases.collocations(docs(spark, rows, EXTRA).repartition(3), least=12, top=20, **mining)
    assert rows_of(found) == sorted(brute_collocations(rows, 12, 20), key=repr)


def test_failures_of_the_sample_lead_to_more_passes(spark):
    rows = docs(spark, wordy(150))
    good, passes = phrases.frequent_phrases(rows, 12, lowered=1, sample=1)
    none, more = phrases.frequent_phrases(rows, 12, sample=1 << 40)
    assert (passes, more) == (1, 2)
    assert rows_of(good) == rows_of(none)


def test_long_texts_are_cut_without_losing_a_phrase(spark, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", "c", "dd", "e"]) + rng.choice([" ", " ", " ", "  ", "\t", ". "]) for _ in range(3000))
    wanted = Counter({(" ".join(w)): n for (_, w), n in brute_counts([(1, text, "en")])[0].items()})
    for size, block in ((7, 50), (64, 1000), (10 ** 6, 10 ** 6)):
        monkeypatch.setattr(phrases, "SLICE", size)
        found, held = Counter(), phrases.Block()

        def take():
            for b in held.counts(4, None, None):
                found.update({key.split("\n")[1]: n for key, n in zip(*[b.column(c).to_pylist() for c in ("key", "n")]) if key != "en\n"})

        for words, carried in phrases.tokens_of(text.encode()):
            held.add("en", words, carried)
            if len(held.ids) >= block:
                take()
                held = phrases.Block()
        take()
        assert found == wanted


def test_collocations_of_odd_rows(spark):
    assert phrases.collocations(docs(spark, [])).count() == 0
    odd = [(i, t, "en") for i, t in ODD]
    assert rows_of(phrases.collocations(docs(spark, odd), least=3, top=9)) == sorted(brute_collocations(odd, 3, 9), key=repr)


def test_scores_beyond_64_bits():
    """The score is taken from decimals; no count that fits a long can make it wrong."""
    a, left, right = 9 * 10 ** 18, 9 * 10 ** 18, 9 * 10 ** 18 + 1
    assert 2_000_000 * a // (left + right) == 999_999 and 2_000_000 * a > 2 ** 63


# Filter audit ----------------------------------------------------------------------------------------------


def brute_audit(rows, labels):
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (False, False))
        marks[i] = good or quality == 1, bad or toxic == 1
    marked = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall("[^ \t-\r]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        marked.append((part or "", fails, *(marks.get(i, (False, False)) if i is not None else (False, False))))
    out = []
    for part in {m[0] for m in marked}:
        mine = [m[1:] for m in marked if m[0] == part]
        table, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                shapley[f] += len(gone)
                table.append((part, "".join(order), step, len(left), len(gone), sum(m[0][f] for m in mine) - len(gone),
                              sum(m[0][f] and sum(m[0].values()) == 1 for m in mine), sum(m[1] for m in gone), sum(m[2] for m in gone), f))
        out += [(*row[:-1], shapley[row[-1]]) for row in table]
    return sorted(out)


def some_texts(n):
    rng = random.Random(9)
    long = " ".join(f"w{i}" for i in range(220))
    texts = ["", None, "A B C", "#", long, long + " $", long.title(), "x " * 250, "x " * 250 + "|", "word word", long + " Q" * 30]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(n)]
    return rows + [(3, rows[3][1], "b"), (3, rows[3][1], "b"), (None, long, "a"), (None, long, "a")]


def test_audit_equals_brute_force(spark):
    rows = some_texts(60)
    marks = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    extra = ", ".join(f"`{c}` string" for c in (*EXTRA, "digest", "cell", "part", "good"))
    table = spark.createDataFrame([(*r, *["x"] * (len(EXTRA) + 4)) for r in rows], f"doc_id long, text string, source string, {extra}")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert rows_of(audit.audit(audit.failures(table, labels))) == sorted(brute_audit(rows, marks), key=repr)


def test_audit_of_no_rows_and_of_other_filters(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(audit.failures(docs(spark, []), labels)).count() == 0
    two = audit.audit(audit.failures(docs(spark, ODD), labels, {"A": audit.is_short, "D": audit.has_signs}, copy=None), "AD")
    found = {(r.filter_order, r.step): r for r in two.collect()}
    assert len(found) == 4 and found["AD", 1].removed == 11 and found["AD", 2].kept == found["DA", 2].kept == 1


def test_contraction_selects_along_every_axis():
    tensor = np.arange(2 * 3 * 8).reshape(2, 3, 2, 2, 2)
    picked = audit.contract(tensor).reshape(2, 3, 3, 3, 3)
    take = {0: [0], 1: [1], 2: [0, 1]}
    for a, b, c in np.ndindex(3, 3, 3):
        assert (picked[:, :, a, b, c] == tensor[:, :, take[a]][:, :, :, take[b]][:, :, :, :, take[c]].sum(axis=(2, 3, 4))).all()


# Chat formatting -------------------------------------------------------------------------------------------

SAID = ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[\\INST]", "[[INST]", "<</s>", "[/TURN] [ROLE] \n", "é 日本 😀", "[OUT", "</s", "ends with \\", " \t\r\n"]


def turns_of(n):
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "[/ROLE] x", None, "us\ner"]
    return [(c, t, rng.choice(roles), rng.choice([*SAID, None])) for c in range(n) for t in range(rng.randrange(1, 6))]


def brute_digest(rows):
    out, talks = [], {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, said in talks.items():
        said.sort(key=lambda t: t[0])
        loss = "".join(t for _, r, t in said if r == "assistant")
        out.append((conv, len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in said).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [chat.CHUNK, 30, 0])
def test_turns_come_back(spark, chunk):
    rows = turns_of(80) + [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, segment string, s string")
    formatted = chat.format_rows(table.repartition(5), chunk=chunk)
    found = chat.digests(formatted)
    assert rows_of(found.drop("formatted_chars")) == brute_digest(rows)
    assert found.agg({"formatted_chars": "sum"}).first()[0] == sum(len(r.formatted) for r in formatted.collect())


def test_controls_never_occur_inside_texts(spark):
    body = spark.createDataFrame([(t,) for t in SAID], "t string").select(chat.escape(chat.F.col("t")).alias("e"), "t").collect()
    for r in body:
        assert not any(c in r.e for c in chat.TEMPLATE.controls())
        assert chat.unescape(r.e) == r.t


def test_a_very_long_conversation_is_several_rows(spark):
    table = spark.range(20_000).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "repeat('ab', 50) text")
    formatted = chat.format_rows(table, chunk=100_000).collect()
    assert len(formatted) > 10 and max(len(r.formatted) for r in formatted) <= 100_000
    assert sum(r.n_turns for r in formatted) == 20_000


def test_odd_tables_of_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.digests(chat.format_rows(spark.createDataFrame([], schema))).count() == 0
    twice = [(1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "c")]
    row = chat.format_rows(spark.createDataFrame(twice, schema)).first()
    assert list(chat.read_turns(row.formatted)) == [("user", "b"), ("user", "a"), ("user", "a"), ("assistant", "c")]
    other = spark.createDataFrame([("c", 1, "user", "hello")], "conversation_id string, position int, author string, content string")
    assert list(chat.read_turns(chat.format_rows(other).first().formatted)) == [("user", "hello")]
    with pytest.raises(ValueError):
        chat.format_rows(spark.createDataFrame([(1,)], "a int"))


LAYOUTS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "[INST]"}]},
     "messages", [("system", "s"), ("user", "u"), ("assistant", "[INST]")]),
    ({"id": 5, "messages": [{"author": {"role": "user"}, "content": {"text": "q"}}, {"author": {"role": "tool"}, "content": {"text": None}}]},
     "authored messages", [("user", "q"), ("tool", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "other", "value": "o"}]},
     "conversations", [("user", "q"), ("assistant", "a"), ("other", "o")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done", "system": "be"}, "instruction",
     [("system", "be"), ("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "r", "completion": None}, "prompt and response", [("user", "p"), ("assistant", "r")]),
    ({"context": "c", "question": "q", "answer": "a"}, "question and answer", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"messages": [], "other": 1}, "messages", []),
    ({"prompt": "p", "completion": "c", "output": "o"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"nothing": 1}, None, None),
]


def test_layouts_by_fingerprint(spark):
    rows = [(i, json.dumps(r), "x") for i, (r, _, _) in enumerate(LAYOUTS)] + [(97, None, "x"), (98, "no json", "x"), (99, "[1]", "x")]
    found = {r.id: r for r in chat.format_records(chat.canonical(
        spark.createDataFrame(rows, "id int, record string, layout string"))).collect()}
    known = chat.registry(chat.RECORDS)
    for i, (_, layout, turns) in enumerate(LAYOUTS):
        assert found[i].layout == layout
        assert turns == (None if found[i].turns is None else [tuple(t) for t in found[i].turns])
        if layout:
            assert list(chat.read_turns(found[i].formatted)) == turns
            assert list(chat.read_loss(found[i].formatted, found[i].loss)) == [t for r, t in turns if r == "assistant"]
    assert all(found[i].layout is None and found[i].formatted is None for i in (97, 98, 99))
    assert found[0].fingerprint in known and found[10].fingerprint not in known
    assert len({found[i].fingerprint for i in (0, 1, 2, 3, 5, 6, 7, 8)}) == 8


def test_nested_columns_are_records(spark):
    table = spark.createDataFrame([([("user", "a"), ("assistant", "b")],), (None,)], "messages array<struct<role:string,content:string>>")
    found = chat.canonical(table.selectExpr("struct(messages) AS record")).collect()
    assert [r.layout for r in found] == ["messages", None]
    assert [tuple(t) for t in found[0].turns] == [("user", "a"), ("assistant", "b")]
