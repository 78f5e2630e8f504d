"""How far the sources of a language diverge, by three-dimensional cubes.

Every (lang, source) group and every language has a share, in whole
billionths, for each term that its language keeps.  A pair of sources
diverges by the sum over all kept terms of ``(p - q)^2 / q``; a group's own
terms are those above their share in the language.  All numbers are exact
integers.

1. Terms are counted in one pass, summed up inside each task; a language keeps
   the terms that ``min_docs`` of its documents hold.
2. Groups of a language fall into blocks of ``GROUP_BLOCK``, its terms into
   blocks of about ``TERM_BLOCK``.  A slice holds the counts of one group block in
   one term block.  It is copied to the cells (block i, block j, term block)
   that its block takes part in.
3. A cell is one small task: it spreads its two slices over the terms that
   occur in them and sums up the divergences of its pairs, both ways.  Terms
   that neither slice holds have one value per pair, as both counts are 0: a
   cell of its own per pair of blocks adds it for every kept term, and the others
   take it off for their terms.
4. The cells are summed up along the term axis.

Defined results: a null language, source or text is an empty string; every row
is a document, repeated rows too; a group without terms has count 0 for
every kept term; a language without kept terms has pairs of value 0; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwx.llm.store import cut
from tripwx.llm.text import pieces

GROUP_BLOCK = 8
TERM_BLOCK = 1 << 13
SCALE = 10 ** 9
HELD_TERMS = 1 << 18             # terms a task sums up before it hands them on
#: ASCII letters in lower case and bytes of other characters make terms, all else separates them
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _counted(batches):
    """lang, source, term, n, docs of a task's texts; a term comes in
    several rows if the task sees many terms."""
    def rows():
        for (lang, source), terms in found.items():
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([name] * len(terms), pa.string()) for name in (lang, source)), pa.array(list(terms), pa.binary()),
                 pa.array(list(terms.values()), pa.int64()),
                 pa.array([held[lang, source][t] for t in terms], pa.int64())], ["lang", "source", "term", "n", "docs"])

    found, held, size = defaultdict(Counter), defaultdict(Counter), 0
    for piece, data, off in pieces(batches):
        for t, group in enumerate(zip(piece.column(1).to_pylist(), piece.column(2).to_pylist())):
            terms = data[off[t]:off[t + 1]].tobytes().translate(LETTERS).split()
            size -= len(found[group])
            found[group].update(terms)
            held[group].update(set(terms))
            size += len(found[group])
        if size >= HELD_TERMS:
            yield from rows()
            found, held, size = defaultdict(Counter), defaultdict(Counter), 0
    yield from rows()


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n (in the group), lang_n, and first (true in one
    row per language and term) of the kept terms."""
    raw = docs.select(F.col("text").cast("binary"), "lang", "source").mapInArrow(
        _counted, "lang string, source string, term binary, n bigint, docs bigint")
    # one shuffle: the sums over sources need no other partitioning
    counts = raw.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    counts = counts.withColumn("lang_docs", F.sum("docs").over(over)).withColumn("lang_n", F.sum("n").over(over))
    counts = counts.withColumn("first", F.row_number().over(over.orderBy("source")) == 1)
    kept = counts.filter(F.col("lang_docs") >= min_docs)
    return cut(kept.select("lang", "source", "term", "n", "lang_n", "first"), "terms")


def group_sizes(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, total (occurrences of kept terms), place (number in the
    language), block, lang_total and vocabulary of every group."""
    groups = docs.select("lang", "source").distinct()
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("first").cast("long")).alias("vocabulary"))
    out = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    out = out.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return cut(out.withColumn("block", F.floor(F.col("place") / GROUP_BLOCK).cast("int")), "groups")


def shares(count: np.ndarray, total: int) -> np.ndarray:
    """1 + SCALE * (count + 1) // total, digit by digit in base 1000, as the product can pass 64 bits."""
    out, rest = np.divmod(np.asarray(count, np.int64) + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def _slice(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The counts of a group block in a term block, as three plain arrays."""
    packed = [rows["place"].to_numpy().astype(np.int32) % GROUP_BLOCK, rows["column"].to_numpy().astype(np.int32),
              rows["n"].to_numpy().astype(np.int64)]
    return pa.table({"lang": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int32()),
                     "t": pa.array([key[2].as_py()], pa.int64()),
                     **{name: pa.array([a.tobytes()], pa.binary()) for name, a in zip(("g", "c", "n"), packed)}})


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _cell(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The part of all divergences between two group blocks that one term
    block makes, both ways; t = -1 is the cell of the terms that none holds."""
    lang, i, j, t = (k.as_py() for k in key)
    first = rows.slice(0, 1).to_pylist()[0]
    vocabulary = first["vocabulary"]
    totals = [first["left"], first["right"]]
    slices = {r["side"]: (np.frombuffer(r["g"], np.int32), np.frombuffer(r["c"], np.int32), np.frombuffer(r["n"], np.int64))
              for r in rows.to_pylist() if r["side"] is not None}
    if i == j and 0 in slices:
        slices[1] = slices[0]
    columns = np.unique(np.concatenate([s[1] for s in slices.values()] or [np.zeros(0, np.int32)]))
    many = vocabulary if t < 0 else -len(columns)           # how often the value of two zero counts is added
    sides, zero = [], []
    for side in (0, 1):
        count = np.zeros((len(totals[side]), len(columns)), np.int64)
        if side in slices:
            g, c, n = slices[side]
            count[g, np.searchsorted(columns, c)] = n
        base = np.array([total + vocabulary for total in totals[side]], np.int64).reshape(-1, 1)
        sides.append(shares(count, np.maximum(base, 1)))
        zero.append(shares(np.zeros_like(base), np.maximum(base, 1)))
    out = []
    for a in range(len(totals[0])):
        there = divergence(sides[0][a], sides[1]).sum(1) + many * divergence(zero[0][a], zero[1])[:, 0]
        back = divergence(sides[1], sides[0][a]).sum(1) + many * divergence(zero[1], zero[0][a])[:, 0]
        for b in range(len(totals[1])):
            x, y = i * GROUP_BLOCK + a, j * GROUP_BLOCK + b
            if x != y:
                out.append((x, y, int(there[b])))
            if i != j:
                out.append((y, x, int(back[b])))
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()),
                     **{name: pa.array([r[k] for r in out], pa.int64()) for k, name in enumerate(("a", "b", "value"))}})


def pair_divergences(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (every other source of the language) and value."""
    langs = groups.groupBy("lang").agg(F.max("vocabulary").alias("vocabulary"), (F.max("block") + 1).alias("blocks"))
    blocks = groups.groupBy("lang", "block").agg(                 # at most GROUP_BLOCK sizes each
        F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda s: s["total"]).alias("totals"))
    placed = terms.join(groups.select("lang", "source", "place", "block"), ["lang", "source"]).join(
        langs.select("lang", F.ceil(F.col("vocabulary") / TERM_BLOCK).alias("parts")), "lang")
    placed = placed.withColumn("t", F.pmod(F.xxhash64("term"), F.col("parts")))
    number = Window.partitionBy("lang", "t").orderBy("term")
    placed = placed.withColumn("column", F.dense_rank().over(number))
    slices = placed.select("lang", "block", "t", "place", "column", "n").groupBy("lang", "block", "t").applyInArrow(
        _slice, "lang string, block int, t bigint, g binary, c binary, n binary")
    slices = cut(slices, "slices")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")
    cells = slices.join(langs.select("lang", "blocks"), "lang").select("lang", "block", "t", "g", "c", "n", other)
    cells = cells.select("lang", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "t",
                         F.when(F.col("block") <= F.col("k"), 0).otherwise(1).alias("side"), "g", "c", "n")
    none = F.lit(None).cast("binary")
    rest = blocks.join(langs.select("lang", "blocks"), "lang").select("lang", F.col("block").alias("i"), F.explode(
        F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.lit(-1).cast("long").alias("t"),
        F.lit(None).cast("int").alias("side"), none.alias("g"), none.alias("c"), none.alias("n"))
    cells = cells.unionByName(rest)
    for end, name in (("i", "left"), ("j", "right")):
        cells = cells.join(blocks.select("lang", F.col("block").alias(end), F.col("totals").alias(name)), ["lang", end])
    cells = cells.join(langs.select("lang", "vocabulary"), "lang")
    parts = cells.groupBy("lang", "i", "j", "t").applyInArrow(_cell, "lang string, a bigint, b bigint, value bigint")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    for end, name in (("a", "source"), ("b", "item")):
        names = groups.select("lang", F.col("place").cast("long").alias(end), F.col("source").alias(name))
        sums = sums.join(names, ["lang", end])
    return sums.select("lang", "source", "item", "value")


def _share(count: str, total: str):
    """As ``shares``: decimals of 38 digits hold the product."""
    return F.expr(f"1L + (cast({count} + 1 AS decimal(28,0)) * {SCALE}) div cast({total} AS decimal(28,0))")


def own_terms(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (term) and value of the terms whose share in the
    group is above that in the language."""
    rows = terms.join(groups, ["lang", "source"])
    rows = rows.withColumn("p", _share("n", "(total + vocabulary)")).withColumn("q", _share("lang_n", "(lang_total + vocabulary)"))
    rows = rows.filter(F.col("p") > F.col("q"))
    return rows.select("lang", "source", F.col("term").cast("string").alias("item"),
                       F.expr("((p - q) * (p - q)) div q").alias("value"))


def audit(docs: DataFrame, min_docs: int = 3) -> tuple[DataFrame, DataFrame]:
    """(pair divergences, own terms) of all groups of ``docs`` (lang, source, text)."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = term_counts(docs, min_docs)
    groups = group_sizes(docs, terms)
    return pair_divergences(terms, groups), own_terms(terms, groups)


def report(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: all pairs
    and the ``top`` own terms of every group, largest value first."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs, own = (df.withColumn("rank", F.row_number().over(order)) for df in audit(docs, min_docs))
    out = pairs.withColumn("part", F.lit("pair")).unionByName(
        own.filter(F.col("rank") <= top).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")
