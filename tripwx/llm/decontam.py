"""Benchmark decontamination by greedy string tiling.

1. Seeds: the runs of ``SEED`` words of every benchmark item.  A bitmap of
   fixed size over their hashes thins the scan of the documents; of each
   document only the stretches covered by possible seeds go on (words of a
   tile are covered by seeds, so nothing else can be in one).
2. Shared-seed join: document seeds meet item seeds by hash.  A pair lives
   on if its shared seeds could cover the threshold share of the item: seeds
   that stand ``s`` times in the item cover ``SEED * s`` of its words at most.
   An item's commonest seeds, those that most items hold, are left out of the
   join as far as they could not reach that bound by themselves: they are
   only looked up for the pairs that a rarer seed has made.  So a phrase that
   all items share makes no pair of every document that has it and every item.
3. Greedy string tiling per pair: find the longest unmarked common run by
   Karp-Rabin window hashes, mark its non-overlapping occurrences, repeat
   down to ``SEED`` words.  Tiles may stand in any order in the document.
4. An item is leaked if its tiles cover ``THRESHOLD`` of its words.

Words are runs of ASCII letters and digits and of other characters, lower
case; punctuation and spacing do not count.

Defined results: null and empty texts share nothing; items shorter than
a seed are their own, shorter seed and must stand in the document whole; a
repeated document row gives a repeated result row; a repeated item counts
once per item id (null ids are left out); an empty table gives no rows; a
null doc_id is reported as null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwx.llm import bitmap
from tripwx.llm.store import cut
from tripwx.llm.text import BASE, PLAIN, U64, edges, mix, pieces, signed, word_hashes

SEED = 5
THRESHOLD = 0.8


def _words(data, off):
    data = PLAIN[data]
    start, end, first = edges(data, off, data == 32)
    return word_hashes(data, start, end), first


def seed_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words from each word on (the last
    ``size - 1`` words start none)."""
    out = np.zeros(max(0, len(words) - size + 1), U64)
    for k in range(size):
        out = out * U64(BASE) + words[k:k + len(out)]
    return mix(out + U64(size))


def _items(batches):
    for rows, data, off in pieces(batches):
        words, first = _words(data, off)
        yield pa.RecordBatch.from_arrays(
            [rows.column(1), pa.array([words[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
            ["item_id", "words"])


def _item_seeds(batches):
    for batch in batches:
        ids, seeds, times = [], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for i, raw in zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist()):
            words = np.frombuffer(raw, U64)
            found, often = np.unique(seed_hashes(words, min(SEED, len(words))), return_counts=True)
            ids += [i] * len(found)
            seeds.append(found)
            times.append(often)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("item_id").type), signed(np.concatenate(seeds)), pa.array(np.concatenate(times))],
            ["item_id", "seed", "times"])


def _stretches(sizes, words_map):
    """Documents with possible seeds: the covered words, in order, with a
    break value between stretches, and the distinct seeds."""
    def run(batches):
        for rows, data, off in pieces(batches):
            words, first = _words(data, off)
            cover = np.zeros(len(words) + 1, np.int64)
            seeds = []
            for size in sizes:
                hashes = seed_hashes(words, size)
                at = np.arange(len(hashes))
                doc_end = np.repeat(first[1:], np.diff(first))[:len(hashes)]
                hit = np.flatnonzero(bitmap.holds(words_map.value, hashes) & (at + size <= doc_end))
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + size, -1)
                seeds.append((hit, hashes[hit]))
            inside = np.cumsum(cover[:-1]) > 0
            where = np.concatenate([h for h, _ in seeds])
            value = np.concatenate([v for _, v in seeds])
            order = np.argsort(where, kind="stable")
            where, value = where[order], value[order]
            ids, text, own = [], [], []
            for i in np.unique(np.searchsorted(first, where, side="right") - 1).tolist():
                a, b = first[i], first[i + 1]
                keep = inside[a:b]
                part = words[a:b].copy()
                part[~keep] = 0                                  # 0 marks a break
                show = keep.copy()
                show[1:] |= keep[:-1]                            # one break after each stretch
                ids.append(i)
                text.append(part[show].tobytes())
                lo, hi = np.searchsorted(where, [a, b])
                own.append(np.unique(value[lo:hi]).view(np.int64))
            stops = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            flat = np.concatenate(own) if own else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(1).take(pa.array(ids, pa.int64())), rows.column(2).take(pa.array(ids, pa.int64())),
                 pa.array(text, pa.binary()), pa.ListArray.from_arrays(pa.array(stops), pa.array(flat))],
                ["doc_id", "row", "doc_words", "seeds"])
    return run


def _windows(run: np.ndarray, power: np.ndarray, free: np.ndarray, size: int):
    """Start and Karp-Rabin hash of every window of ``size`` free words."""
    n = len(free) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[:-size])
    return at, (run[at + size] - run[at]) * power[at]


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(item start, document start, length) by greedy string tiling; 0 in
    ``doc`` is a break that matches nothing."""
    base, inv = U64(BASE), U64(pow(BASE, -1, 1 << 64))

    def prepare(x):
        n = len(x)
        run = np.zeros(n + 1, U64)
        np.cumsum(x * np.cumprod(np.full(n, base, U64)), out=run[1:])
        back = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n, inv, U64))])
        return run, back
    free_i, free_d = np.ones(len(item), bool), doc != 0
    (run_i, back_i), (run_d, back_d) = prepare(item), prepare(doc)
    out, top = [], len(item)
    while top >= least:
        # the longest common free run: if one of n words exists, so does one of n - 1
        low, high, best = least, top, None
        while low <= high:
            size = (low + high) // 2
            ai, hi = _windows(run_i, back_i, free_i, size)
            ad, hd = _windows(run_d, back_d, free_d, size)
            both = np.isin(hi, hd)
            if both.any():
                best, low = (size, ai[both], hi[both], ad, hd), size + 1
            else:
                high = size - 1
        if best is None:
            break
        size, ai, hi, ad, hd = best
        order = np.argsort(hd, kind="stable")
        for a, h in zip(ai.tolist(), hi):
            if not free_i[a:a + size].all():
                continue
            lo, up = np.searchsorted(hd[order], h, "left"), np.searchsorted(hd[order], h, "right")
            for d in ad[order[lo:up]].tolist():
                if free_d[d:d + size].all() and np.array_equal(item[a:a + size], doc[d:d + size]):
                    free_i[a:a + size] = free_d[d:d + size] = False
                    out.append((a, d, size))
                    break
        top = size - 1
    return out


def _tile(batches):
    for batch in batches:
        covered, longest = [], []
        for item, doc in zip(batch.column("words").to_pylist(), batch.column("doc_words").to_pylist()):
            words = np.frombuffer(item, U64)
            found = tiles(words, np.frombuffer(doc, U64), min(SEED, len(words)))
            covered.append(sum(t[2] for t in found))
            longest.append(max((t[2] for t in found), default=0))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "row", "item_id", "n")] +
            [pa.array(covered, pa.int64()), pa.array(longest, pa.int64())],
            ["doc_id", "row", "item_id", "n", "covered", "longest"])


def shared_seeds(found: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item_id) whose shared seeds could cover ``need`` words of the
    item.  ``found``: row, seed; ``seeds``: item_id, seed, times; ``items``: item_id, need."""
    common = seeds.groupBy("seed").agg(F.count("*").alias("holders"))
    # an item's own seeds, the commonest first: as long as they fall short of the bound they make no pair
    upto = Window.partitionBy("item_id").orderBy(F.desc("holders"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    ranked = seeds.join(common, "seed").join(items, "item_id").withColumn("upto", F.sum("times").over(upto))
    ranked = cut(ranked.select("item_id", "seed", "times", "need", (F.col("upto") * SEED >= F.col("need")).alias("rare")), "item-seeds")
    met = cut(found.join(ranked.filter("rare"), "seed").groupBy("row", "item_id").agg(
        F.sum("times").alias("shared"), F.min("need").alias("need")), "met")
    sure = F.col("shared") * SEED >= F.col("need")
    asked = met.filter(~sure).join(ranked.filter("NOT rare").select("item_id", "seed", "times"), "item_id")
    more = asked.join(found, ["row", "seed"]).groupBy("row", "item_id").agg(
        (F.min("shared") + F.sum("times")).alias("shared"), F.min("need").alias("need"))
    return met.filter(sure).unionByName(more.filter(sure)).select("row", "item_id")


def overlaps(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row, item_id, n (item words), covered, longest (tile) of the
    pairs whose tiles cover at least ``threshold`` of the item."""
    spark = docs.sparkSession
    doc_type, item_type = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    items = cut(benchmark.filter(F.col("item_id").isNotNull()).select(F.col("text").cast("binary").alias("t"), F.col("item_id").alias("id"))
                .mapInArrow(_items, f"item_id {item_type}, words binary").distinct()
                .withColumn("n", F.expr("length(words) div 8")).filter("n > 0"), "items")
    seeds = items.mapInArrow(_item_seeds, f"item_id {item_type}, seed bigint, times bigint")
    words = spark.sparkContext.broadcast(bitmap.build(seeds, "seed"))
    sizes = [r[0] for r in items.select(F.least("n", F.lit(SEED)).cast("int").alias("s")).distinct().orderBy("s").collect()] or [SEED]
    texts = docs.select(F.col("text").cast("binary").alias("t"), F.col("doc_id").alias("id"),
                        F.monotonically_increasing_id().alias("row"))
    near = cut(texts.mapInArrow(_stretches(sizes, words),
                                f"doc_id {doc_type}, row bigint, doc_words binary, seeds array<bigint>"), "stretches")
    need = F.ceil(F.col("n") * threshold)
    shared = shared_seeds(near.select("row", F.explode("seeds").alias("seed")), seeds, items.select("item_id", need.alias("need")))
    pairs = shared.join(items.select("item_id", "n", "words"), "item_id").join(near.select("row", "doc_id", "doc_words"), "row")
    found = pairs.mapInArrow(_tile, f"doc_id {doc_type}, row bigint, item_id {item_type}, n bigint, covered bigint, longest bigint")
    return found.filter(F.col("covered") >= need)


def leaked(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row that holds an item: doc_id, items (their
    ids, sorted) and coverage (the highest share)."""
    found = overlaps(docs, benchmark, threshold)
    return (found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set("item_id")).alias("items"),
                                     F.max(F.col("covered") / F.col("n")).alias("coverage")).drop("row"))
