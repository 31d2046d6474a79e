"""Descriptive statistics, quantiles, sketches and null handling."""

from __future__ import annotations

import math
from collections.abc import Generator, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def approx_quantiles(df: DataFrame, column: str, probs: Sequence[float], error: float) -> DataFrame:
    """``(prob, value)`` with a rank error of at most ``error``."""
    acc = max(100, round(1 / error))
    arr = df.agg(F.percentile_approx(column, [float(p) for p in probs], acc).alias("v"))
    probs_col = F.array(*[F.lit(float(p)) for p in probs])
    return arr.select(F.explode(F.arrays_zip(probs_col.alias("prob"), F.col("v").alias("value"))).alias("q")).select(
        "q.prob", "q.value")


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], leaf: int = 100_000) -> dict[float, float]:
    """Exact quantiles of one column; see :func:`exact_quantiles_of`."""
    return exact_quantiles_of(df, [column], probs, leaf)[column]


def exact_quantiles_of(df: DataFrame, columns: Sequence[str], probs: Sequence[float], leaf: int = 100_000) -> dict[str, dict[float, float]]:
    """Exact quantiles with linear interpolation, without sorting or holding a column; all columns share the scans.

    Between equal neighbours, infinite ones too, nothing is interpolated. ``leaf`` bounds the values
    of a column that the last step sorts in one task and has no effect on the result.
    """
    return in_one_scan(df, {c: _quantiles(F.col(c).cast("double"), probs, leaf) for c in columns})


def in_one_scan(df: DataFrame, searches: dict[str, Generator]) -> dict:
    """Results of searches that each yield lists of aggregates and get their values: every round is one scan for all of them."""
    found, waiting = {}, {}

    def go_on(name: str, values=None) -> None:
        try:
            waiting[name] = searches[name].send(values)
        except StopIteration as end:
            found[name] = end.value

    for name in searches:
        go_on(name)
    while waiting:
        asked, waiting = waiting, {}
        row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(a for aggs in asked.values() for a in aggs)]).first()
        at = 0
        for name, aggs in asked.items():
            go_on(name, row[at:at + len(aggs)])
            at += len(aggs)
    return found


def _quantiles(x: Column, probs: Sequence[float], leaf: int) -> Generator:
    (n,) = yield [F.count(x)]
    if not n:
        return {}
    at = {p: (n - 1) * p for p in probs}
    found = yield from order_statistics(x, sorted({min(int(r) + i, n - 1) for r in at.values() for i in (0, 1)}), n, leaf)

    def between(rank: float) -> float:
        low, high, part = found[int(rank)], found[min(int(rank) + 1, n - 1)], rank - int(rank)
        return low if low == high or not part else low + (high - low) * part

    return {p: between(r) for p, r in at.items()}


def order_statistics(x: Column, ranks: Sequence[int], n: int, leaf: int) -> Generator:
    """Search for the values at zero-based ``ranks`` of a column, which has ``n`` values; NULLs do not count.

    For each rank a sketch gives two values around it; exact counts then tell whether one of them
    is the answer, or how many values lie strictly between them. That number falls by about a
    thousand per pass, ties or not. All ranks share the scans; once at most ``leaf`` values
    are left, those are sorted. Only counts and bracket ends reach the driver.
    """
    accuracy, found = 10_000, {}
    low, high = yield [F.min(x), F.max(x)]
    # Per open rank: the bracket ends, the rank of the first value strictly inside, and the number inside.
    open_ranks = {r: (low, high, None, n) for r in ranks}

    def settle(ends: dict[int, tuple[float, float]]) -> Generator:
        pairs = sorted(set(ends.values()))
        counts = yield [F.count_if(c) for lo, hi in pairs for c in (x < lo, x <= lo, x < hi, x <= hi)]
        for r, (lo, hi) in ends.items():
            i = 4 * pairs.index((lo, hi))
            under_lo, upto_lo, under_hi, upto_hi = counts[i:i + 4]
            old_lo, old_hi, first, inside = open_ranks.pop(r)
            if r < under_lo:  # outside the sketch's promise: keep the part below
                open_ranks[r] = (old_lo, lo, first, under_lo - first)
            elif r < upto_lo:
                found[r] = lo
            elif r < under_hi:
                open_ranks[r] = (lo, hi, upto_lo, under_hi - upto_lo)
            elif r < upto_hi:
                found[r] = hi
            else:
                open_ranks[r] = (hi, old_hi, upto_hi, first + inside - upto_hi)

    def inside(bracket: tuple) -> Column:
        return F.when((x > bracket[0]) & (x < bracket[1]), x)

    yield from settle({r: (low, high) for r in ranks})
    while wide := {r: b for r, b in open_ranks.items() if b[3] > leaf}:
        # Ranks in one bracket share its sketch; neighbouring ranks also share the same grid cell.
        cell = {r: int((r - first) / count * accuracy) for r, (_, _, first, count) in wide.items()}
        edges = lambda r: [max(0.0, (cell[r] - 2) / accuracy), min(1.0, (cell[r] + 3) / accuracy)]
        members = {b: [r for r in wide if wide[r] == b] for b in sorted(set(wide.values()))}
        sketches = yield [F.percentile_approx(inside(b), [e for r in rs for e in edges(r)], accuracy) for b, rs in members.items()]
        yield from settle({r: tuple(ends[2 * i:2 * i + 2]) for rs, ends in zip(members.values(), sketches) for i, r in enumerate(rs)})
    if open_ranks:
        rest = list(open_ranks)
        picks = yield [F.get(F.sort_array(F.collect_list(inside(open_ranks[r]))), F.lit(r - open_ranks[r][2])) for r in rest]
        found.update(zip(rest, picks))
    return found


def describe_long(df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = ()) -> DataFrame:
    """``(column, n, mean, stddev, min, max[, p25 …])``, one row per column, from a single scan plus
    the quantile scans, which all columns share. ``mean`` and ``stddev`` of text columns are NULL; text extremes stay text."""
    numeric = {c: t for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double")
               or t.startswith("decimal")}
    aggs = []
    exact = exact_quantiles_of(df, [c for c in columns if c in numeric], percentiles) if percentiles else {}
    for c in columns:
        x = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        quantiles = exact.get(c, {})
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
            F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
            *[F.lit(quantiles.get(p)).cast("double").alias(f"p{round(p * 100)}") for p in percentiles]))
    return df.agg(*[a.alias(f"s{i}") for i, a in enumerate(aggs)]).select(
        F.inline(F.array(*[F.col(f"s{i}") for i in range(len(aggs))])))


def value_sketches(df: DataFrame, column: str, keys: Sequence[str], k: int = 1000) -> DataFrame:
    """One KLL sketch of the column's values per key, as ``(keys…, n, sketch)`` rows to be stored; NULLs and NaN are left out.

    Each task sketches its own rows first, so it shuffles sketches and never values. ``k`` of 1000 keeps ranks within 0.4 %.
    """
    x = F.col(column).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float], k: int = 1000) -> DataFrame:
    """``(keys…, prob, value, n)`` of all values behind the sketches of a key; only sketches are read.

    Sketches of days merge into those of any range of days, and merged ones merge again.
    """
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_all"))
    picks = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("_all", F.lit(float(p))).alias("value"))
                      for p in probs])
    return merged.select(*keys, "n", F.explode(picks).alias("_q")).select(*keys, "_q.prob", "_q.value", "n")


def frequent_items(df: DataFrame, column: str, support: float) -> DataFrame:
    """Values that make up at least ``support`` of all rows, NULL among them, with their exact counts.

    The frequent-items sketch gives at most ``1/support`` candidates and misses none; only
    those are counted, so the many rare values never enter a shuffle.
    """
    (candidates,) = df.stat.freqItems([column], support).first()
    kept = df.where(_one_of(column, candidates)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return kept.where(F.col("n") >= F.lit(support * df.count()))


def _one_of(column: str, candidates: Sequence) -> Column:
    known = F.col(column).isin([c for c in candidates if c is not None])
    return F.coalesce(known, F.lit(False)) | F.col(column).isNull() if None in candidates else known


def frequent_items_of(df: DataFrame, columns: Sequence[str], support: float) -> DataFrame:
    """``(column, value, n)`` of the frequent values of several columns, as text, from two shared scans."""
    candidates = df.stat.freqItems(list(columns), support).first()
    pairs = [F.when(_one_of(c, found), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
             for c, found in zip(columns, candidates)]
    counted = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).groupBy("p.column", "p.value").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= F.lit(support * df.count()))


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of ``row`` by every value of ``column``, 0 where a pair does not occur; NULL is ``null``.

    The values are found first; above ``spark.sql.pivotMaxValues`` of them Spark raises an error.
    """
    named = df.select(row, F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("_value"))
    return named.groupBy(row).pivot("_value").agg(F.count(F.lit(1))).na.fill(0)


_BLOCK_BITS = 32_768  # bits of one bitmap, as built by bitmap_construct_agg


def _bloom_bits(col: Column, blocks: int, hashes: int) -> tuple[Column, list[Column]]:
    block = F.pmod(F.xxhash64(col, F.lit(-1)), F.lit(blocks))
    return block, [F.pmod(F.xxhash64(col, F.lit(i)), F.lit(_BLOCK_BITS)) for i in range(hashes)]


def bloom_build(df: DataFrame, column: str, expected_items: int, bits_per_item: int = 10, hashes: int = 6) -> DataFrame:
    """Blocked Bloom filter as rows ``(block, bits)`` of 4 KiB; all bits of an item are in one block."""
    blocks = max(1, -(-expected_items * bits_per_item // _BLOCK_BITS))
    block, bits = _bloom_bits(F.col(column), blocks, hashes)
    placed = df.where(F.col(column).isNotNull()).select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
    built = placed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return built.select("block", "bits", F.lit(blocks).alias("blocks"))


def bloom_filter(df: DataFrame, column: str, bloom: DataFrame, expected_items: int, bits_per_item: int = 10,
                 hashes: int = 6) -> DataFrame:
    """Rows whose value may be in the filter: no row that is in it is lost.

    One join on the block number, whose side to broadcast, if any, Spark picks by the filter's size.
    """
    blocks = max(1, -(-expected_items * bits_per_item // _BLOCK_BITS))
    block, bits = _bloom_bits(F.col(column), blocks, hashes)

    def is_set(bit: Column) -> Column:
        byte = F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1

    test = is_set(bits[0])
    for b in bits[1:]:
        test = test & is_set(b)
    probed = df.withColumn("block", block).join(bloom.select("block", "bits"), "block")
    return probed.where(test).select(*df.columns)


def _cms_cells(column: str, depth: int, width: int) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("row"), F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(width)).alias("cell"))
        for i in range(depth)])).alias("c")


def cms_shape(error: float, items: int, chance: float = 1e-9) -> tuple[int, int]:
    """Depth and width of a sketch whose estimates of all of ``items`` values are at most ``error`` of the rows too high.

    One value keeps a bound of e/width but for a chance of exp(-depth), so among many values some break it. Cells are 16
    times as many as that bound needs, which breaks in a row with 1 / 16e at most, and there are so many rows that all of
    them break it for any value with ``chance`` at most.
    """
    spread = 16 * math.e
    width = 1 << math.ceil(math.log2(spread / error))
    return max(5, math.ceil(math.log(max(items, 1) / chance, spread))), width


def cms_build(df: DataFrame, column: str, depth: int = 5, width: int = 1 << 14) -> DataFrame:
    """Count-min sketch as at most ``depth * width`` cells ``(row, cell, n)``.

    Each task adds up its own cells first, so it shuffles a sketch and never the values.
    """
    return df.select(_cms_cells(column, depth, width)).groupBy("c.row", "c.cell").agg(F.count(F.lit(1)).alias("n"))


def cms_estimate(items: DataFrame, column: str, cells: DataFrame, depth: int = 5, width: int = 1 << 14) -> DataFrame:
    """Estimated count per item, never below the true count."""
    probe = items.select(column).distinct().select(column, _cms_cells(column, depth, width)).select(column, "c.row", "c.cell")
    hit = probe.join(cells, ["row", "cell"], "left").groupBy(column)
    return hit.agg(F.min(F.coalesce(F.col("n"), F.lit(0))).alias("estimate"))
