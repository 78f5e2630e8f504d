"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words whose smallest period ``q`` fits into
it ``EXPONENT`` times or more (and that has ``LEAST`` words or more), and
that no neighbouring word extends.  Per slice of whole texts:

1. Harmonic grid: a run of period q covers four neighbouring multiples of q,
   so only places kq whose words at kq, (k+1)q, (k+2)q, (k+3)q agree are
   candidates; over all q that is n log n comparisons of a text of n words.
2. Recompression: the texts with candidates become one run-length grammar.
   Rounds of block compression (maximal powers c^k become one symbol) and pair
   compression (the alphabet is halved at random, every left-right
   neighbourhood becomes one symbol) alternate until each text is one symbol.
   Equal stretches are cut alike except at their ends.
3. Longest common extensions: two places climb the levels of the grammar, with
   one step each at most to reach a common cut, until their symbols differ, and
   descend to the word that differs.  Both directions use the same grammar.
   The extensions of a candidate kq against (k+1)q are the ends of its run.
4. A stretch found with several periods keeps the smallest.

A text is worked on by one task, which holds a few numbers per word of it.
Words are told apart by 64-bit hashes.

Defined results: null, empty and blank texts have no words and no run; rows
are taken one by one, so repeated rows and null ids give a row each; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.llm.text import SPACE, U64, edges, mix, pieces, word_hashes

LEAST = 6
EXPONENT = 4
SLICE = 4 << 20
GRID = 1 << 14              # texts of up to so many words share one table of grid places
QUERIES = 1 << 18           # extensions asked for at once
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class Grammar:
    """Levels of a recompressed sequence.  ``symbols[l]`` is the sequence at
    level l; ``phrase[l]`` the place at level l + 1 of each of its symbols,
    ``begin[l]`` the first symbol of each phrase.  Negative symbols of the
    given sequence are ends of texts: all different, never compressed."""

    def __init__(self, sequence: np.ndarray):
        self.symbols, self.phrase, self.begin, self.paired = [sequence], [], [], []
        word = sequence >= 0
        least = int((~word).sum() + word[:1].sum() + (word[1:] & ~word[:-1]).sum())     # all ends, one symbol a text
        fresh = int(sequence.max(initial=-1)) + 1
        turn = 0
        while True:
            fresh = self._blocks(fresh)
            if len(self.symbols[-1]) <= least:
                break
            fresh = self._pairs(fresh, turn)
            turn += 1

    def _push(self, start: np.ndarray, symbols: np.ndarray, paired: bool) -> None:
        self.paired.append(paired)
        self.begin.append(np.r_[start, len(self.symbols[-1])])
        owner = np.zeros(len(self.symbols[-1]), np.int64)
        owner[start[1:]] = 1
        self.phrase.append(np.cumsum(owner))
        self.symbols.append(symbols)

    def _blocks(self, fresh: int) -> int:
        now = self.symbols[-1]
        start = np.flatnonzero(np.r_[True, now[1:] != now[:-1]])
        if len(start) == len(now):
            return fresh
        size = np.diff(np.r_[start, len(now)])
        out = now[start]
        many = size > 1
        rules, rule = np.unique(out[many] * (int(size.max()) + 1) + size[many], return_inverse=True)
        out[many] = fresh + rule
        self._push(start, out, False)
        return fresh + len(rules)

    def _pairs(self, fresh: int, turn: int) -> int:
        now = self.symbols[-1]
        side = (mix(now.astype(U64) + U64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & U64(1)).astype(bool)
        word = now >= 0
        one, other = word & side, word & ~side
        head = one[:-1] & other[1:]
        turned = other[:-1] & one[1:]
        if turned.sum() > head.sum():               # the half that shortens the sequence more goes left
            head = turned
        at = np.flatnonzero(head)
        first = np.ones(len(now), bool)
        first[at + 1] = False
        start = np.flatnonzero(first)
        out = now[start]
        rules, rule = np.unique(now[at] * fresh + now[at + 1], return_inverse=True)
        out[np.searchsorted(start, at)] = fresh + rule
        self._push(start, out, True)
        return fresh + len(rules)

    def extend(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from places x and y on, these included,
        to the right or to the left; x and y differ and lie in one text."""
        sign = 1 if forward else -1
        begin_x, x, y = x, x.copy(), y.copy()
        level = np.full(len(x), len(self.phrase))
        live = np.arange(len(x))

        def rest(l, place, phrase):
            """Symbols of the phrase from place on, and whether that is all of it."""
            a, b = self.begin[l][phrase], self.begin[l][phrase + 1]
            return (b - place, place == a) if forward else (place - a + 1, place == b - 1)
        for l in range(len(self.phrase)):                               # climb
            same = self.symbols[l][x[live]] == self.symbols[l][y[live]]
            level[live[~same]] = l
            live = live[same]
            if not len(live):
                break
            a, b = x[live], y[live]
            (ra, wa), (rb, wb) = rest(l, a, self.phrase[l][a]), rest(l, b, self.phrase[l][b])
            whole = wa & wb
            step = np.where(whole, 0, np.minimum(ra, rb)) * sign
            a, b = a + step, b + step
            differ = ~whole & (ra != rb)
            level[live[differ]] = l
            x[live], y[live] = np.where(differ, a, self.phrase[l][a]), np.where(differ, b, self.phrase[l][b])
            live = live[~differ]
        for l in range(int(level.max(initial=0)) - 1, -1, -1):           # descend
            live = np.flatnonzero(level > l)
            a, b = x[live], y[live]
            begin = self.begin[l]
            # two unlike blocks share their shorter length, two unlike pairs at most one symbol
            size = 1 if self.paired[l] else np.minimum(begin[a + 1] - begin[a], begin[b + 1] - begin[b])
            a, b = (begin[a], begin[b]) if forward else (begin[a + 1] - 1, begin[b + 1] - 1)
            step = np.where(self.symbols[l][a] == self.symbols[l][b], size, 0) * sign
            x[live], y[live] = a + step, b + step
        return (x - begin_x) * sign


def grid_places() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places kq, periods q of all grid places of texts of up to GRID words,
    by their last word (k+3)q, and how many of them a text of n words has."""
    q = np.arange(1, GRID // 3 + 1)
    many = np.maximum(0, -(-GRID // q) - 3)
    period = np.repeat(q, many)
    place = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * period
    last = place + 3 * period
    order = np.argsort(last, kind="stable")
    return (place[order].astype(np.int32), period[order].astype(np.int32),
            np.searchsorted(last[order], np.arange(GRID + 1), "left"))


def candidates(words: np.ndarray, grid: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grid places of one text that may lie in a run;
    ``grid`` comes from ``grid_places``."""
    n = len(words)
    if n <= GRID:
        place, period, many = grid
        place, period = place[:many[n]], period[:many[n]]
        for k in range(3):
            same = np.flatnonzero(words[place + k * period] == words[place + (k + 1) * period])
            place, period = place[same], period[same]
        return place, period
    places, periods = [], []
    for q in range(1, n // EXPONENT + 1):
        w = words[::q]
        same = w[1:] == w[:-1]
        k = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(k):
            places.append(k * q)
            periods.append(np.full(len(k), q))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(places or empty), np.concatenate(periods or empty)


def _maximal(grammar: Grammar, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretch with the period around each place."""
    start, end = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    for a in range(0, len(place), QUERIES):
        p, q = place[a:a + QUERIES], period[a:a + QUERIES]
        start[a:a + QUERIES] = p + 1 - grammar.extend(p, p + q, False)
        end[a:a + QUERIES] = p + q + grammar.extend(p, p + q, True)
    return start, end


def runs_of(sequence: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs that hold a candidate of
    ``sequence``, by start and period."""
    grammar = Grammar(sequence)
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    found = []
    for turn in range(3):
        if not len(place):
            break
        # the first of each row of neighbouring candidates; what it does not cover comes in a later turn
        first = np.r_[True, (period[1:] != period[:-1]) | (place[1:] != place[:-1] + period[:-1])]
        ask = np.flatnonzero(first) if turn < 2 else np.arange(len(place))
        start, end = _maximal(grammar, place[ask], period[ask])
        found.append(np.stack([start, end, period[ask]], 1))
        if turn < 2:
            lead = np.cumsum(first) - 1
            left = place + period >= end[lead]
            place, period = place[left], period[left]
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    length = rows[:, 1] - rows[:, 0]
    rows = rows[length >= np.maximum(LEAST, EXPONENT * rows[:, 2])]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)              # a stretch keeps its smallest period
    rows = rows[fresh]
    rows[:, 1] -= rows[:, 0]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def slice_runs(words: np.ndarray, first: np.ndarray, grid: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the texts of a slice, starts counted in each text, and the
    first run of each text; text t has the words first[t]:first[t + 1]."""
    texts, places, periods = [], [], []
    for t in range(len(first) - 1):
        if first[t + 1] - first[t] >= LEAST:
            place, period = candidates(words[first[t]:first[t + 1]], grid)
            if len(place):
                texts.append(t)
                places.append(place.astype(np.int64))
                periods.append(period.astype(np.int64))
    if not texts:
        return np.zeros((0, 3), np.int64), np.zeros(len(first), np.int64)
    # one sequence: an end mark, then each text and an end mark of its own
    ids = np.unique(np.concatenate([words[first[t]:first[t + 1]] for t in texts]), return_inverse=True)[1]
    size = np.array([first[t + 1] - first[t] for t in texts])
    inner = np.cumsum(size) - size
    sequence = np.insert(ids.astype(np.int64), np.r_[0, inner + size], -1 - np.arange(len(texts) + 1))
    base = inner + np.arange(len(texts)) + 1
    rows = runs_of(sequence, np.concatenate([p + b for p, b in zip(places, base)]), np.concatenate(periods))
    owner = np.searchsorted(base, rows[:, 0], "right") - 1
    rows[:, 0] -= base[owner]
    return rows, np.searchsorted(np.array(texts)[owner], np.arange(len(first)), "left")


def collapse(words: list[bytes], rows: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if len(rows):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 0] + rows[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def _find(batches):
    grid = grid_places()
    for rows, data, off in pieces(batches, limit=SLICE):
        start, end, first = edges(data, off, SPACE[data])
        found, at = slice_runs(word_hashes(data, start, end), first, grid)
        kept = [collapse(data[off[t]:off[t + 1]].tobytes().split(), found[at[t]:at[t + 1]]) for t in range(len(off) - 1)]
        runs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [rows.column(1), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), runs),
             pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "kept"])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start,
    then period) and collapsed (the text's words, joined by one space,
    without those that repeat inside a run), for every row of ``docs``."""
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select(F.col("text").cast("binary").alias("t"), F.col("doc_id").alias("id"))
    found = texts.mapInArrow(_find, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, kept binary")
    return found.select("doc_id", "n_words", "runs", F.col("kept").cast("string").alias("collapsed"))


def strongest(runs):
    """The run of greatest length / period; ties go to the one that comes first."""
    def better(best, r):
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, its exponent in thousandths, and
    digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    out = found.withColumn("best", strongest(F.col("runs")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
