"""Exact duplicates, SimHash groups and fuzzy lines against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from helpers import EXTRA, ODD, docs, rows_of
from pyspark.sql import functions as F

from millrace.llm import exact, lines, simhash
from millrace.llm.common import components


def text_of(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randint(0, 99))
                    for _ in range(n))


def test_golomb_blocks_give_their_values_back():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1 << 63), (1, 1), (5, 8), (1000, 1 << 40), (4096, 5000)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        assert (exact.golomb_decode(len(values), *exact.golomb_encode(values)) == values).all()
    for owners in (1, 3, 8, 211):
        hashes = np.sort(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * 2)
        owner = exact.owner_of(hashes, owners)
        assert owner.min() >= 0 and owner.max() < owners
        assert all(h >= exact.owner_start(int(o), owners) for h, o in zip(hashes, owner))


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups(spark):
    rng = random.Random(2)
    rows = ODD + [(100 + i, text_of(rng, 1)[:7]) for i in range(300)] + [(500 + i, "hot") for i in range(200)]
    assert rows_of(exact.exact_groups(docs(spark, rows, EXTRA).repartition(7))) == expected_exact(rows)
    assert exact.exact_groups(docs(spark, [])).count() == 0


def test_drop_exact_keeps_one_row_of_each_text(spark):
    rows = ODD + [(i, "same") for i in range(20, 60)]
    kept = exact.drop_exact(docs(spark, rows, EXTRA))
    assert kept.columns == docs(spark, rows, EXTRA).columns
    found = rows_of(kept.select("doc_id", "text"))
    texts = [t or "" for _, t in found]
    assert sorted(texts) == sorted({t or "" for _, t in rows})
    assert (59, "same") in found and (4, "one") in found


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, ids):
    """Smallest id of each row's component of fingerprints within two bits."""
    kinds = sorted(set(prints))
    parent = {p: p for p in kinds}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [least.get(find(p)) for p in prints]


def test_simhash_groups(spark):
    rng = random.Random(3)
    base = text_of(rng, 400)
    near = [(1000 + i, re.sub(r"\w+$", str(i), base)) for i in range(30)]
    rows = ODD + near + [(2000 + i, text_of(rng, 3)) for i in range(200)]
    prints = [brute_print(t) for _, t in rows]
    wanted = brute_groups(prints, [i for i, _ in rows])
    expected = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, wanted)), key=repr)
    assert rows_of(simhash.near_groups(docs(spark, rows, EXTRA))) == expected
    assert simhash.near_groups(docs(spark, [])).count() == 0
    kept = simhash.drop_near(docs(spark, rows, EXTRA))
    named = {c for c in wanted if c is not None}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == named


@pytest.mark.parametrize("dense", [2, 64])
def test_links_connect_all_close_fingerprints(spark, dense):
    """Clouds of fingerprints around a few centres, paired in cells or linked by common neighbours."""
    rng = random.Random(4)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            p = centre
            for _ in range(rng.randint(0, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(df, dense).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    order = {p: i for i, p in enumerate(sorted(prints))}
    linked = spark.createDataFrame([(order[a], order[b]) for a, b in found], "a long, b long")
    roots = {r.node: r.root for r in components(linked).collect()}
    wanted = brute_groups(sorted(prints), list(range(len(prints))))
    assert [roots.get(i, i) for i in range(len(prints))] == wanted


def test_segment_counts_bound_the_distance(spark):
    rng = random.Random(5)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pairs, "a long, b long")
    vector = [simhash.segment_counts(F.col(c)) for c in "ab"]
    for r in df.select("a", "b", simhash.manhattan(*vector).alias("m"), simhash.hamming(F.col("a"), F.col("b")).alias("h")).collect():
        counts = lambda x: [(x >> 2 * i & 3).bit_count() for i in range(32)]
        assert r.m == sum(abs(x - y) for x, y in zip(counts(r.a), counts(r.b))) <= r.h == (r.a ^ r.b).bit_count()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(205, 204), (204, 203), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 203: 203, 204: 203, 205: 203}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_set(line, k=5):
    """Every k consecutive characters of a line in lower case with single spaces."""
    line = re.sub("[ \t]+", " ", line.lower()).strip(" ")
    return {line[i:i + k] for i in range(max(len(line) - k, 0) + 1)}


def brute_lines(rows):
    """Places of the lines that go."""
    places = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            if line.strip():
                places.setdefault(line, set()).add((2**63 - 1 if i is None else i, n))
    kinds = list(places)
    sets = [brute_set(x) for x in kinds]
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(kinds)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    keep = {}
    for i, x in enumerate(kinds):
        keep[find(i)] = min(keep.get(find(i), (2**63, 0)), min(places[x]))
    return {p for i, x in enumerate(kinds) for p in places[x] if p != keep[find(i)]}


@pytest.mark.parametrize("dense", [3, 48])
def test_fuzzy_lines(spark, monkeypatch, dense):
    monkeypatch.setattr(lines, "DENSE", dense)
    rng = random.Random(6)
    base = [text_of(rng, 40) for _ in range(4)]
    pool = [re.sub(r"(\w+) (\w+)$", lambda m: f"{m[1]} x{k}", b) for b in base for k in range(8)] + ["Short one.", "- - -", ""]
    rows = [r for r in ODD if r[0] != 7] + [(100 + i, "\n".join(rng.choice(pool) for _ in range(4))) for i in range(40)]
    wanted = brute_lines(rows)
    found = lines.line_report(docs(spark, rows, EXTRA)).collect()
    assert len(found) == len(rows)
    gone = {(2**63 - 1 if r.doc_id is None else r.doc_id, int(n)) for r in found for n in r.removed.split(",") if n}
    assert gone == wanted
    kept = {r.doc_id: r.text for r in lines.drop_lines(docs(spark, rows, EXTRA)).collect() if r.doc_id and r.doc_id >= 100}
    for i, t in rows:
        if i and i >= 100:
            assert kept[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in wanted)
    assert lines.line_report(docs(spark, [])).count() == 0


character_set = brute_set


def test_lines_are_sets_of_character_shingles(spark, monkeypatch):
    typo = "the old library near the river was closed for two weeks because of heavy winter storms"
    kana = "".join(chr(0x3042 + i * 7 % 80) for i in range(40))
    signs = "price: 10.5% +/- 0.3% (see note [4]); total = 1,204.00 EUR -- {net}"
    rng = random.Random(8)
    long = text_of(rng, 60) + " 😀é"
    pool = [typo, typo.replace("library", "libary"), kana, "ん" + kana, signs, signs.replace("--", "—"), signs.replace(" ", "  "), long,
            long.replace("😀", "😁"), long[:70], long[:66], long[:64], "abcd", "ABCD", "abce", "abcdef", "one two", "one  two ", typo[::-1]]
    df = docs(spark, [(i, x) for i, x in enumerate(pool)])
    found = {r.line: set(r.set) for r in lines.lines(df).select("line", lines.shingles(F.col("line")).alias("set")).collect()}
    for x in found:
        for y in found:
            a, b = character_set(x), character_set(y)
            assert len(found[x]) == len(a) and len(found[x] & found[y]) == len(a & b)
    monkeypatch.setitem(globals(), "brute_set", character_set)
    gone = {r.doc_id for r in lines.line_report(df).collect() if r.removed}
    assert gone == {i for i, _ in brute_lines(list(enumerate(pool)))} >= {1, 3, 6, 8}


def test_short_similar_lines_share_a_band(spark):
    rng = random.Random(9)
    stems = ["".join(chr(rng.randint(0x4e00, 0x9fff)) for _ in range(12)) for _ in range(10_000)]
    # 9 shingles each, 8 of them common: similarity 0.8.
    found = lines.signatures(lines.lines(docs(spark, [(i, f"{x}a\n{x}b") for i, x in enumerate(stems)]))).select("first", "bands").collect()
    bands = {divmod(int(r["first"]), 1 << 31): set(r.bands) for r in found}
    missed = sum(bands[i, 0].isdisjoint(bands[i, 1]) for i in range(len(stems)))
    # 0.66 % are expected.
    assert len(bands) == 2 * len(stems) and missed < 0.01 * len(stems)


def test_unlike_lines_of_a_band_need_no_texts(spark, monkeypatch):
    rng = random.Random(10)
    part = lambda n: "".join(chr(rng.randint(0x4e00, 0x9fff)) for _ in range(n))
    common = part(60)
    pool = [common + part(180) for _ in range(300)]
    pool += [x[:-1] + "." for x in pool[:20]]
    df = docs(spark, list(enumerate(pool)))
    marked = lines.signatures(lines.lines(df)).select("node", "bands").collect()
    shared = sum(not set(x.bands).isdisjoint(y.bands) for i, x in enumerate(marked) for y in marked[:i])
    compared, similar = [], lines.similar
    monkeypatch.setattr(lines, "similar", lambda pairs, texts: compared.append(pairs.count()) or similar(pairs, texts))
    gone = {r.doc_id for r in lines.line_report(df).collect() if r.removed}
    assert gone == set(range(300, 320))
    assert 20 <= sum(compared) < shared / 2


def test_only_wanted_texts_are_shuffled(spark):
    rows = lines.lines(docs(spark, [(i, f"line {i}") for i in range(200)]))
    wanted = rows.where("doc < 5").select(F.xxhash64("lid").alias("node"))
    found = lines.texts_of(rows, wanted)
    assert {r.line for r in found.collect()} == {f"line {i}" for i in range(5)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    # The Bloom filter's join lies below the one with the wanted ids.
    assert plan.index("bits#") > plan.index("Join [node#")


def test_runs_hold_every_shingle_and_no_other(spark):
    """a run that goes over the end of a part or a line repeats a shingle and makes none of its own."""
    rng = random.Random(11)
    pool = [text_of(rng, 400)[:n] for n in (1, 4, 5, 6, 11, 12, 13, 40, 259, 260, 261, 262, 600)] + ["é😀" * 9]
    df = lines.lines(docs(spark, list(enumerate(pool)))).select("doc", "line", lines.characters(F.col("line")).alias("chars"))
    wanted = {r.doc: set(r.set) for r in df.select("doc", lines.shingles(F.col("line")).alias("set")).collect()}
    for count in (3, lines.RUN):
        found = {}
        for r in lines.runs(df, ["doc"], count).collect():
            found.setdefault(r.doc, set()).update(r[f"s{i}"] for i in range(count))
        assert found == wanted and len(found) == len(pool)


def test_marks_spare_unlike_lines_the_exact_comparison(spark):
    """marks rule out most unlike pairs without a text, and never a similar one."""
    rng = random.Random(12)
    letters = lambda n: "".join(chr(rng.randint(0x4e00, 0x9fff)) for _ in range(n))
    pool, kinds = [], []
    for n in (5, 30, 300, 1500):
        for share in (0.3, 0.5, 0.83, 0.95):
            base = letters(n)
            pool += [base, base[:int(n * share)] + letters(n - int(n * share))]
            kinds.append((len(pool) - 2, len(pool) - 1))
    pool += ["ab" * 8, "ab" * 300]
    kinds.append((len(pool) - 2, len(pool) - 1))
    texts = spark.createDataFrame(list(enumerate(pool)), "node long, line string")
    pairs = spark.createDataFrame(kinds, "a long, b long")
    near = {tuple(r) for r in lines.close(pairs, lines.marks(texts)).collect()}
    share = {p: len(x & y) / len(x | y) for p in kinds for x, y in [[brute_set(pool[i]) for i in p]]}
    similar = {p for p in kinds if share[p] >= 0.8}
    assert {tuple(r) for r in lines.similar(pairs, texts).collect()} == similar and len(similar) >= 4
    assert similar <= near and not any(share[p] < 0.5 for p in near if len(pool[p[0]]) <= 300)


def test_methods_of_signatures_and_marks_are_compiled(spark):
    """the JVM interprets methods of more than 8000 bytes."""
    rows = lines.lines(docs(spark, [(1, "one line")]))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the code is there only after a run
    try:
        for made in (lines.signatures(rows), lines.marks(rows.select(F.xxhash64("lid").alias("node"), "line"))):
            code = spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "codegen")
            assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
