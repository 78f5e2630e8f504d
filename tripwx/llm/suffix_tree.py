"""A probabilistic suffix tree over words as a language model.

Symbols are the words of a text, lower case, and one end; all words that
the training texts do not hold are one symbol, ``unknown``.  A context is
the last 0 to ``DEPTH`` symbols (2 at most); a text's first word follows a
boundary, which is the end of the text before.

* Root: exact counts of every training word, absolutely discounted; the
  discount's mass is the probability of ``unknown``.
* One-word contexts: a word is a candidate, as a context and after one, if
  its share of the training symbols passes ``MIN_SHARE``, so there are at
  most ``1 / MIN_SHARE``: that bounds what the driver and the broadcasts
  hold, whatever the corpus.  Every candidate seen after one twice or more is
  a transition, so these grow with the corpus.  Those that reach
  ``MIN_SHARE`` are broadcast with the contexts; all others stay a table
  (``Tails``).
* Two-word contexts: every pair of words, frequent or rare, and every word
  seen after it ``MIN_SEEN`` times or more.  No share bounds them: they are
  tables throughout (``_two_words``).  Bitmaps of the pairs and of the
  retained keys only thin what is counted and looked up.
* Divergence test: a context is retained if using its own distribution in
  place of its suffix's gains at least ``MIN_GAIN`` nats over the training
  texts; the suffixes of a retained context are retained.
* Smoothing: a state gives each of its transitions its discounted share and
  leaves the rest to its suffix's distribution, down to the root; the
  probabilities of every state sum to one.
* Scoring: each symbol by the state of its longest retained suffix.

All training symbols are counted.  Tasks pre-aggregate and ship packed,
bucketed count blocks, which bucket tasks merge.  Frequent words (share over
``MIN_SHARE``) are looked up in a broadcast.  What the broadcast does not hold
- rare words, ``Tails``, two-word contexts - meets the texts in its bucket: a
task sends every key once for a stretch of rows, with the rows that hold it,
and the bucket returns a sum per row.  No lookup is a Spark row of its own.
A two-word context and all its words share a bucket, which needs from others
only the counts of rare words and of pairs, asked for and answered in blocks.

Defined results: a null text is an empty one, with only its end; repeated
rows count each; a null id is hashed as an empty string; without training
rows all scores are 0; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwx.llm import bitmap
from tripwx.llm.store import cut, drop
from tripwx.llm.text import LOWER, SPACE, edges, mix, pieces, word_hashes

DEPTH = 2
MIN_SHARE = 5e-7
MIN_GAIN = 8.0
MIN_SEEN = 2
FLUSH = 3_000_000
ID_BITS = 21                            # three word ids make one positive long
MAP_BITS = 26
REGIONS = 64
BITS_SET = 3
REGION_BITS = MAP_BITS - 6
ONE = (1 << ID_BITS) - 1
RARE = np.int64(-1 << 63)               # the sign of a key that is a hash, not word ids
PAIR, CONTEXT = (np.uint64(x) for x in (0x51A7, 0xC0D3))
HEAD = RARE                             # from here on, less than ONE + 1 up: a context's head row, in place of a symbol
COUNTS, TRIPLES, STATES, ASK, ANSWER, ROWS, WORDS, TAILS, CONTEXTS = range(9)
FIELDS = ("steps", "sizes", "codes", "wide", "counts", "low")
BLOCK = "bucket int, kind int, origin bigint, " + ", ".join(f"{n} binary" for n in FIELDS)
BOUNDARY = np.int64(0x1E4D0F7E87)      # the hash that stands for the end of a text


def _hashes(data, off) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every symbol, each text opened and closed by the boundary,
    and each text's first position."""
    data = LOWER[data]
    start, end, first = edges(data, off, SPACE[data])
    words = word_hashes(data, start, end).view(np.int64)
    begin = first + 2 * np.arange(len(first))
    out = np.full(begin[-1], BOUNDARY)
    texts = len(first) - 1
    out[np.arange(len(words)) + 2 * np.repeat(np.arange(texts), np.diff(first)) + 1] = words
    return out, begin


def _merge(keys: list, counts: list):
    """Sorted distinct keys and their counts; empties the lists."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first, dtype=np.int64) if len(first) else count.astype(np.int64)


def _thin(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, as many planes as they need
    (said by the first byte), which compresses well if they are small."""
    planes = 8 if not len(x) or x.min() < 0 else max(1, (int(x.max()).bit_length() + 7) // 8)
    return bytes([planes]) + x.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _thick(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view(np.int64).ravel()


def _packed(key, count, buckets):
    """One row per bucket: the steps between its sorted keys, and their counts."""
    bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    key, count = key[order], count[order]
    stop = np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = [b for b in range(buckets) if stop[b] < stop[b + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([_thin(np.diff(key[stop[b]:stop[b + 1]], prepend=np.int64(0))) for b in some], pa.binary()),
         pa.array([_thin(count[stop[b]:stop[b + 1]]) for b in some], pa.binary())], ["bucket", "keys", "counts"])


def _tally(of, buckets):
    """Counts per key over a task, passed on whenever they fill FLUSH rows."""
    def run(batches):
        keys, counts, held = [], [], 0
        for _, data, off in pieces(batches):
            key, count = np.unique(of(data, off), return_counts=True)
            keys.append(key)
            counts.append(count.astype(np.int32))
            held += len(key)
            if held > FLUSH:
                key, count = _merge(keys, counts)
                keys, counts, held = [key], [count], len(key)
                if held > FLUSH // 2:
                    yield _packed(key, count, buckets)
                    keys, counts, held = [], [], 0
        if held:
            yield _packed(*_merge(keys, counts), buckets)
    return run


def _gather(least):
    """Totals per key of rows sorted by bucket; holds one bucket at a time."""
    def total(keys, counts):
        key, count = _merge(keys, counts)
        some = count >= least
        return pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(count[some])], ["key", "c"])

    def run(batches):
        last, keys, counts = None, [], []
        for batch in batches:
            for b, k, c in zip(*[batch.column(n).to_pylist() for n in ("bucket", "keys", "counts")]):
                if b != last and keys:
                    yield total(keys, counts)
                    keys, counts = [], []
                last = b
                keys.append(np.cumsum(_thick(k)))
                counts.append(_thick(c))
        if keys:
            yield total(keys, counts)
    return run


def _parts(texts: DataFrame) -> int:
    return int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def count_keys(texts: DataFrame, of, least: int = 1) -> DataFrame:
    """(key, c): how often each key that ``of(bytes, offsets)`` makes stands
    in all texts, if ``least`` times or more."""
    buckets = 8 * _parts(texts)
    blocks = texts.mapInArrow(_tally(of, buckets), "bucket int, keys binary, counts binary")
    blocks = blocks.repartition("bucket").sortWithinPartitions("bucket")
    return blocks.mapInArrow(_gather(least), "key bigint, c bigint")


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key in a sorted table, -1 if absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Level:
    """Contexts of one length.  ``keys``: context id << ID_BITS | word id of
    every frequent transition, sorted; a transition's place is the id of the
    longer context it makes.  ``share``: its discounted share; ``rest``: by
    context id, what is left to the suffix, NaN if it is not retained."""

    keys: np.ndarray
    share: np.ndarray
    rest: np.ndarray


@dataclass
class Tree:
    words: np.ndarray                       # hashes of the frequent words, sorted
    root: np.ndarray                        # their root probabilities
    levels: list = field(default_factory=list)

    def plain(self) -> tuple:
        """What ``Tree.of`` makes this tree from: plain values, to broadcast."""
        return self.words, self.root, [(x.keys, x.share, x.rest) for x in self.levels]

    @staticmethod
    def of(words, root, levels) -> Tree:
        return Tree(words, root, [Level(*x) for x in levels])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        code, distinct = pd.factorize(hashes)
        return _find(self.words, distinct)[code]

    def contexts(self, ids: np.ndarray, begin: np.ndarray, depth: int):
        """For each length 1 to ``depth``, the id of the context before each
        position, -1 if it is not a frequent one or reaches over the boundary."""
        place = np.arange(len(ids)) - np.repeat(begin[:-1], np.diff(begin))
        here = ids
        for k in range(depth):
            before = np.full(len(ids), -1)
            before[1:] = here[:-1]
            before[place < k + 1] = -1
            yield before
            if k + 1 < depth:
                # the context of k + 1 symbols that ends here: the transition (context before, symbol here)
                here = np.full(len(ids), -1)
                live = np.flatnonzero((before >= 0) & (ids >= 0))
                here[live] = _find(self.levels[k].keys, (before[live] << ID_BITS) | ids[live])

    def tails(self, ids: np.ndarray, begin: np.ndarray, words: np.ndarray):
        """Positions, after a retained word, of a frequent word that is none
        of its broadcast transitions, and the pairs' keys, if the bitmap may
        hold them."""
        context, = self.contexts(ids, begin, 1)
        at = np.flatnonzero((context >= 0) & (ids >= 0))
        at = at[~np.isnan(self.levels[0].rest[context[at]])]
        key = (context[at] << ID_BITS) | ids[at]
        some = _held(words, _named(key, PAIR))
        at, key = at[some], key[some]
        some = _find(self.levels[0].keys, key) < 0
        return at[some], key[some]

    def log10(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol; of a rare one (id -1) only the
        part that its contexts leave to the root."""
        p = np.where(ids >= 0, self.root[np.maximum(ids, 0)] if len(self.root) else 1.0, 1.0)
        for level, context in zip(self.levels, self.contexts(ids, begin, len(self.levels))):
            live = np.flatnonzero(context >= 0)
            rest = level.rest[context[live]]
            live, rest = live[~np.isnan(rest)], rest[~np.isnan(rest)]
            at = _find(level.keys, (context[live] << ID_BITS) | np.maximum(ids[live], 0))
            own = np.where((at >= 0) & (ids[live] >= 0), level.share[np.maximum(at, 0)] if len(level.share) else 0.0, 0.0)
            p[live] = own + rest * p[live]
        return np.log10(p)


def _named(keys: np.ndarray, kind: np.uint64) -> np.ndarray:
    """The hash that a pair, a context or a triple has in bitmaps and lookups."""
    return mix(mix(keys.view(np.uint64)) + kind)


def _joined(older, word, ids_known, exact) -> np.ndarray:
    """``exact`` where it is made of word ids alone, a negative hash elsewhere."""
    hashed = mix(mix(older.view(np.uint64)) + word.view(np.uint64)).view(np.int64) | RARE
    return np.where(ids_known, exact, hashed)


@dataclass
class Run:
    """A slice of texts: by position hash, word id, place in the text, key of
    the pair that ends here (place 1 on) and of the triple (place 2 on)."""

    hashes: np.ndarray
    begin: np.ndarray
    ids: np.ndarray
    place: np.ndarray
    pair: np.ndarray

    @staticmethod
    def of(tree: Tree, data, off) -> Run:
        hashes, begin = _hashes(data, off)
        ids = tree.ids(hashes)
        pair = np.zeros(len(ids), np.int64)
        pair[1:] = _joined(hashes[:-1], hashes[1:], (ids[:-1] >= 0) & (ids[1:] >= 0), (ids[:-1] << ID_BITS) | ids[1:])
        return Run(hashes, begin, ids, np.arange(len(ids)) - np.repeat(begin[:-1], np.diff(begin)), pair)

    @property
    def symbols(self) -> np.ndarray:
        """Word ids, the hashes of rare words in their place."""
        return np.where(self.ids >= 0, self.ids, self.hashes)


def _pair_keys(tree_):
    def of(data, off):
        run = Run.of(Tree.of(*tree_.value), data, off)
        return run.pair[run.place >= 1]
    return of


def _starts(*sorted_: np.ndarray) -> np.ndarray:
    """First position of every stretch of equal rows."""
    change = np.ones(len(sorted_[0]), bool)
    change[1:] = False
    for x in sorted_:
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int32)


def _dealt(keys: np.ndarray, buckets: int):
    """(bucket, the positions of its keys in their order) of every bucket with keys."""
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    stop = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(stop[1:] > stop[:-1]):
        yield int(b), order[stop[b]:stop[b + 1]]


def _batch(rows: list, ids=None) -> pa.RecordBatch:
    """Rows (bucket, kind, origin, up to ``FIELDS`` binaries); ``ids``: an
    array column more."""
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))]
    columns += [pa.array([r[k] if k < len(r) else None for r in rows], pa.binary()) for k in range(3, 3 + len(FIELDS))]
    return pa.RecordBatch.from_arrays(columns + ([] if ids is None else [ids]),
                                      ["bucket", "kind", "origin", *FIELDS] + ([] if ids is None else ["ids"]))


def _rows(batches):
    """(bucket, kind, origin, binaries) of blocks, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [batch.column(k)[i].as_py() for k in range(3 + len(FIELDS))]


def _pack(context: np.ndarray, symbol: np.ndarray, *numbers: np.ndarray, heads: bool = True) -> list:
    """Binaries of rows sorted by context: the steps between contexts, their
    sizes, the symbols in three bytes each, those of rare words whole, and
    whole numbers.  ``heads``: a context's first row is its head."""
    first = _starts(context)
    head = np.zeros(len(context), bool)
    head[first] = heads
    code = np.where(head, symbol - HEAD, np.where(symbol.view(np.uint64) < ONE, symbol, ONE))
    return [_thin(np.diff(context[first], prepend=np.int64(0))), _thin(np.diff(first, append=len(context))), _thin(code),
            symbol[~head & (code == ONE)].tobytes(), *[_thin(x.astype(np.int64)) for x in numbers]]


def _unpack(steps, sizes, codes, wide, *numbers, heads: bool = True) -> list:
    sizes, symbol = _thick(sizes), _thick(codes)
    head = np.zeros(len(symbol), bool)
    head[np.cumsum(sizes) - sizes] = heads
    symbol[~head & (symbol == ONE)] = np.frombuffer(wide, np.int64)
    symbol[head] += HEAD
    return [np.repeat(np.cumsum(_thick(steps)), sizes), symbol, *[_thick(x) for x in numbers if x is not None]]


def _add_up(held: list) -> list:
    """Sorted distinct rows (context, symbol) and their counts; empties the list."""
    context, symbol, count = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    order = np.lexsort((symbol, context))
    context, symbol, count = context[order], symbol[order], count[order]
    first = _starts(context, symbol)
    return [context[first], symbol[first], np.add.reduceat(count, first) if len(first) else count]


def _tally_triples(model, buckets):
    """Counts, by bucket of the context, of the words after the contexts that
    may be in the bitmap, as far as the pair that the word ends may be too;
    a context's head row counts all its occurrences, and tells the id of its
    last word if the key does not."""
    def run(batches):
        def blocks(rows):
            for b, at in _dealt(rows[0], buckets):
                yield _batch([(b, 0, 0, *_pack(*[x[at] for x in rows]))])

        tree_, words = model.value
        tree = Tree.of(*tree_)
        held, size, fresh = [], 0, 0
        for _, data, off in pieces(batches):
            here = Run.of(tree, data, off)
            some = _held(words, _named(here.pair, PAIR)) & (here.place >= 1)
            pair = np.flatnonzero(some & (here.hashes != BOUNDARY))      # nothing follows the end
            three = np.flatnonzero(some & (here.place >= 2))
            three = three[some[three - 1]]
            context = np.concatenate([here.pair[pair], here.pair[three - 1]])
            last = np.where(here.pair[pair] >= 0, 0, here.ids[pair] + 1)
            held.append([context, np.concatenate([HEAD + last, here.symbols[three]]), np.ones(len(context), np.int64)])
            fresh += len(context)
            if size + fresh > FLUSH // 2:
                held = [_add_up(held)]
                size, fresh = len(held[0][0]), 0
                if size > FLUSH // 3:
                    yield from blocks(held.pop())
                    size = 0
        if size + fresh:
            yield from blocks(_add_up(held))
    return run


def _by_bucket(batches):
    """(bucket, its rows) of blocks sorted by bucket; holds one bucket at a time."""
    last, held = None, []
    for bucket, *row in _rows(batches):
        if bucket != last and held:
            yield last, held
            held = []
        last = bucket
        held.append(row)
    if held:
        yield last, held


def _gather_triples(batches):
    """Per bucket its contexts with words seen MIN_SEEN times or more."""
    for bucket, rows in _by_bucket(batches):
        context, symbol, count = _add_up([_unpack(*r[2:7]) for r in rows])
        head = symbol < HEAD + ONE + 1
        some = head | (count >= MIN_SEEN)
        context, symbol, count = context[some], symbol[some], count[some]
        first = _starts(context)
        sizes = np.diff(first, append=len(context))
        some = np.repeat(sizes > 1, sizes)
        if some.any():
            yield _batch([(bucket, TRIPLES, -1, *_pack(context[some], symbol[some], count[some]))])


def _marks(name: np.ndarray) -> list:
    """The bits that a name sets: few other names share all of them."""
    return [((name if k == 0 else mix(name + np.uint64(k))) & np.uint64((1 << MAP_BITS) - 1)).view(np.int64) for k in range(BITS_SET)]


def _held(words: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Which names may be in the bitmap."""
    out = bitmap.holds(words, name)
    for k in range(1, BITS_SET):
        out[out] = bitmap.holds(words, mix(name[out] + np.uint64(k)))
    return out


def _slots(kind):
    """Blocks, by region of the bitmap, of the bits that the named keys set."""
    def run(batches):
        def blocks():
            slot = np.unique(np.concatenate(held))
            stop = np.searchsorted(slot, np.arange(REGIONS + 1) << REGION_BITS)
            return _batch([(r, 0, 0, _thin(np.diff(slot[stop[r]:stop[r + 1]], prepend=np.int64(0)))) for r in range(REGIONS) if stop[r] < stop[r + 1]])

        held, size = [], 0
        for batch in batches:
            name = _named(batch.column("key").to_numpy(), kind)
            held += _marks(name)
            size += BITS_SET * len(name)
            if size > FLUSH:
                yield blocks()
                held, size = [], 0
        if size:
            yield blocks()
    return run


def _regions(batches):
    for region, rows in _by_bucket(batches):
        flags = np.zeros(1 << REGION_BITS, bool)
        for r in rows:
            flags[np.cumsum(_thick(r[2])) - (region << REGION_BITS)] = True
        yield _batch([(region, 0, 0, np.packbits(flags, bitorder="little").tobytes())])


def bits(keys: DataFrame, kind: np.uint64) -> np.ndarray:
    """The bitmap of the named keys; the driver receives its words whole, as
    many as MAP_BITS says, and the shuffle the steps between its bits."""
    blocks = keys.select("key").mapInArrow(_slots(kind), BLOCK).repartition("bucket").sortWithinPartitions("bucket")
    got = blocks.mapInArrow(_regions, BLOCK).select("bucket", "steps").toArrow()
    words = np.zeros((REGIONS, 1 << (REGION_BITS - 6)), np.uint64)
    for region, row in zip(got["bucket"].to_pylist(), got["steps"].to_pylist()):
        words[region] = np.frombuffer(row, np.uint64)
    return words.ravel()


def _wants(context: np.ndarray, symbol: np.ndarray):
    """First row of every context; by row the id of the context's last word
    (-1 if rare), the key whose count its suffix needs - of a rare word, or of
    the pair of two words with ids - and whether it needs one."""
    first = _starts(context)
    last = np.where(context[first] >= 0, context[first] & ONE, symbol[first] - HEAD - 1)
    last = np.repeat(last, np.diff(first, append=len(context)))
    rare = symbol.view(np.uint64) >= ONE
    want = rare | (last >= 0)
    want[first] = False
    return first, last, np.where(rare, symbol, (last << ID_BITS) | symbol), want


def _ask(buckets):
    def run(batches):
        for bucket, kind, origin, *fields in _rows(batches):
            *_, key, want = _wants(*_unpack(*fields[:4]))
            key = np.unique(key[want])
            yield _batch([(b, ASK, bucket, _thin(np.diff(key[at], prepend=np.int64(0)))) for b, at in _dealt(key, buckets)])
    return run


def _blocks_of(buckets):
    """Packed counts by bucket of the key."""
    def run(batches):
        for batch in batches:
            key, count = batch.column("key").to_numpy(), batch.column("c").to_numpy()
            order = np.argsort(key)
            key, count = key[order], count[order]
            yield _batch([(b, COUNTS, -1, _thin(np.diff(key[at], prepend=np.int64(0))), _thin(count[at])) for b, at in _dealt(key, buckets)])
    return run


def _table(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts of a bucket's blocks of counts."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, count = [np.concatenate(x) for x in zip(*[(np.cumsum(_thick(r[2])), _thick(r[3])) for r in rows])]
    order = np.argsort(key)
    return key[order], count[order]


def _answer(batches):
    """The counts of the keys that each bucket of triples asks for."""
    for bucket, rows in _by_bucket(batches):
        key, count = _table([r for r in rows if r[0] == COUNTS])
        for r in rows:
            if r[0] == ASK:
                at = _find(key, np.cumsum(_thick(r[2])))
                found = np.where(at >= 0, count[np.maximum(at, 0)] if len(count) else 0, 0)
                yield _batch([(r[1], ANSWER, bucket, _thin(found))])


def _shares(context, symbol, count, low, shared):
    """By context its first row and what it leaves; by row whether it is a
    transition, its discounted share and its probability in the suffix."""
    root, totals, rest, discount, total = shared
    first, last, _, want = _wants(context, symbol)
    sizes = np.diff(first, append=len(context))
    real = np.ones(len(context), bool)
    real[first] = False
    rare = symbol.view(np.uint64) >= ONE
    below = np.where(rare, (low - discount) / max(total, 1), root[np.where(rare, 0, symbol)] if len(root) else 0.0)
    below[first] = 1.0
    at = np.flatnonzero(real & (last >= 0))
    at = at[~np.isnan(rest[last[at]])]
    own = np.where(~rare[at] & (low[at] > 0), (low[at] - discount) / totals[last[at]], 0.0)
    below[at] = own + rest[last[at]] * below[at]
    share = np.where(real, (count - discount) / np.repeat(count[first], sizes), 0.0)
    return first, sizes, real, share, 1 - np.add.reduceat(share, first), below


def _retain(model, buckets, min_gain):
    """The contexts that pass the test, with the counts that the suffixes need."""
    def run(batches):
        for bucket, rows in _by_bucket(batches):
            own = [r for r in rows if r[0] == TRIPLES]
            if not own:
                continue
            context, symbol, count = _unpack(*own[0][2:7])
            *_, key, want = _wants(context, symbol)
            asked, back = np.unique(key[want], return_inverse=True)
            place, found = _bucket(asked, buckets), np.zeros(len(asked), np.int64)
            for r in rows:
                if r[0] == ANSWER:
                    found[place == r[1]] = _thick(r[2])
            low = np.zeros(len(context), np.int64)
            low[want] = found[back]
            first, sizes, real, share, left, below = _shares(context, symbol, count, low, model.value)
            up = share + np.repeat(left, sizes) * below
            gain = np.add.reduceat(np.where(real, count * np.log(up / below), 0.0), first)
            seen = np.add.reduceat(np.where(real, count, 0), first)
            gain += np.maximum(count[first] - seen, 0) * np.log(np.maximum(left, 1e-12))
            some = np.repeat(gain >= min_gain, sizes)
            if some.any():
                yield _batch([(bucket, STATES, -1, *_pack(context[some], symbol[some], count[some], low[some]))])
    return run


def _heads(batches):
    """Key and last word's id of every context."""
    for _, _, _, *fields in _rows(batches):
        context, symbol = _unpack(*fields[:4])
        first, last, *_ = _wants(context, symbol)
        yield pa.RecordBatch.from_arrays([pa.array(context[first]), pa.array(last[first])], ["key", "last"])


def _two_words(texts: DataFrame, tree: Tree, counts: DataFrame, totals: np.ndarray, total: int, discount: float,
               min_gain: float, spare: np.ndarray, words: np.ndarray) -> DataFrame:
    """The retained two-word contexts, a packed row per bucket of them.
    Retains their suffixes in ``tree``; ``spare``: what every one-word context
    leaves; ``counts``: blocks of what rare words and pairs count."""
    spark = texts.sparkSession
    buckets = _parts(texts)
    model = spark.sparkContext.broadcast((tree.plain(), words))
    rows = texts.mapInArrow(_tally_triples(model, buckets), BLOCK).repartition("bucket").sortWithinPartitions("bucket")
    triples = cut(rows.mapInArrow(_gather_triples, BLOCK), "triples")
    asked = counts.unionByName(triples.mapInArrow(_ask(buckets), BLOCK)).repartition("bucket").sortWithinPartitions("bucket")
    rows = triples.unionByName(asked.mapInArrow(_answer, BLOCK)).repartition("bucket").sortWithinPartitions("bucket")
    shared = spark.sparkContext.broadcast((tree.root, totals, tree.levels[0].rest, discount, total))
    states = cut(rows.mapInArrow(_retain(shared, buckets, min_gain), BLOCK), "states")
    drop(triples)
    suffix = states.mapInArrow(_heads, "key bigint, last bigint").filter("last >= 0").select("last").distinct().toArrow()["last"].to_numpy()
    tree.levels[0].rest[suffix] = spare[suffix]
    return states


def _chain(tree: Tree, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """P(word | context of ``depth`` symbols) by the levels fitted so far."""
    if depth == 0:
        return tree.root[word]
    level = tree.levels[depth - 1]
    below = _chain(tree, depth - 1, _suffix(tree, depth, context), word)
    rest = level.rest[context]
    at = _find(level.keys, (context << ID_BITS) | word)
    own = np.where(at >= 0, level.share[np.maximum(at, 0)], 0.0)
    return np.where(np.isnan(rest), below, own + np.nan_to_num(rest) * below)


def _suffix(tree: Tree, depth: int, context: np.ndarray) -> np.ndarray:
    """Ids of contexts of ``depth`` symbols without their oldest symbol, as
    contexts of ``depth - 1`` symbols (0 for the root)."""
    if depth == 1:
        return np.zeros(len(context), np.int64)
    made = tree.levels[depth - 2].keys[context]
    older, word = made >> ID_BITS, made & ((1 << ID_BITS) - 1)
    if depth == 2:
        return word
    return _find(tree.levels[depth - 3].keys, (_suffix(tree, depth - 1, older) << ID_BITS) | word)


def _ups(key, c, root, totals, rest, discount) -> np.ndarray:
    """How many times likelier transitions counted ``c`` times are than in the root."""
    context, below = key >> ID_BITS, root[key & ONE]
    return ((c - discount) / totals[context] + rest[context] * below) / below


def _gains(model):
    """Context and gain (nats) of transitions counted ``c`` times."""
    def run(batches):
        for batch in batches:
            key, c = batch.column("key").to_numpy(), batch.column("c").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(key >> ID_BITS), pa.array(c * np.log(_ups(key, c, *model.value)))], ["context", "gain"])
    return run


class Tails:
    """Transitions of one-word contexts that the broadcast does not hold: a
    table (key, c), and by context how often they stand (``seen``) and their
    shares together (``mass``)."""

    def __init__(self, pairs: DataFrame, tree: Tree, totals: np.ndarray, discount: float):
        self.pairs, self.root, self.totals, self.discount = pairs, tree.root, totals, discount
        sums = pairs.groupBy(F.shiftright("key", ID_BITS).alias("context")).agg(F.sum("c").alias("c"), F.count("*").alias("kinds"))
        self.seen, kinds = self._by_context(sums, "c", "kinds")
        self.mass = (self.seen - discount * kinds) / totals

    def _by_context(self, rows: DataFrame, *names: str) -> list:
        """Arrays by context, of which there are 1 / MIN_SHARE at most."""
        got = rows.toArrow()
        out = [np.zeros(len(self.totals)) for _ in names]
        for values, name in zip(out, names):
            values[got["context"].to_numpy()] = got[name].to_numpy()
        return out

    def gain(self, rest: np.ndarray) -> np.ndarray:
        """Nats that the transitions gain by context."""
        model = self.pairs.sparkSession.sparkContext.broadcast((self.root, self.totals, rest, self.discount))
        rows = self.pairs.mapInArrow(_gains(model), "context bigint, gain double")
        return self._by_context(rows.groupBy("context").agg(F.sum("gain").alias("gain")), "gain")[0]


def _level(tree: Tree, depth: int, keys, counts, totals, discount: float, min_gain: float,
           tails: Tails | None = None) -> tuple[Level, np.ndarray]:
    """Shares of the transitions with the contexts that pass the test, and
    what every context leaves to its suffix.  ``totals``: occurrences by
    context id."""
    context, word = keys >> ID_BITS, keys & ((1 << ID_BITS) - 1)
    share = (counts - discount) / totals[context]
    rest = np.ones(len(totals))
    np.subtract.at(rest, context, share)
    if tails:
        rest -= tails.mass
    below = _chain(tree, depth - 1, _suffix(tree, depth, context), word)
    gain = np.zeros(len(totals))
    np.add.at(gain, context, counts * np.log((share + rest[context] * below) / below))
    seen = np.zeros(len(totals))
    np.add.at(seen, context, counts)
    if tails:
        gain += tails.gain(rest)
        seen += tails.seen
    gain += np.maximum(totals - seen, 0) * np.log(np.maximum(rest, 1e-12))
    retained = (gain >= min_gain) & (seen > 0)
    return Level(keys, share, np.where(retained, rest, np.nan)), rest


def fit(texts: DataFrame, vocabulary: DataFrame, words: np.ndarray, counts: np.ndarray, total: int, discount: float,
        depth: int = DEPTH, min_share: float = MIN_SHARE, min_gain: float = MIN_GAIN):
    """The tree, blocks of the counts of rare words and of pairs, the states
    of two-word contexts (None at depth 1) and the bitmap of the pairs.
    ``texts``: one binary column of training texts; ``words`` (sorted) and
    ``counts``: the frequent ones of their ``total`` symbols; ``vocabulary``:
    the others (key, c)."""
    if depth not in (1, 2):
        raise ValueError("depth is 1 or 2")
    spark = texts.sparkSession
    least = max(2, int(np.ceil(total * min_share)))
    tree = Tree(words, (counts - discount) / max(total, 1))
    totals = counts.astype(float)
    pairs = cut(count_keys(texts, _pair_keys(spark.sparkContext.broadcast(tree.plain())), MIN_SEEN), "transitions")
    known = pairs.filter(F.col("key") >= 0)
    tails = Tails(known.filter(F.col("c") < least), tree, totals, discount)
    rows = known.filter(F.col("c") >= least).toArrow()
    keys, seen = rows["key"].to_numpy(), rows["c"].to_numpy()
    order = np.argsort(keys)
    level, rest = _level(tree, 1, keys[order], seen[order].astype(float), totals, discount, min_gain, tails)
    tree.levels.append(level)
    held = bits(pairs, PAIR)
    blocks = vocabulary.unionByName(known).mapInArrow(_blocks_of(_parts(texts)), BLOCK)
    states = _two_words(texts, tree, blocks, totals, total, discount, min_gain, rest, held) if depth == 2 else None
    return tree, totals, blocks, states, held


def _listed(key: np.ndarray, row: np.ndarray, buckets: int):
    """Blocks of the rows that hold each key."""
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    for b, at in _dealt(key, buckets):
        first = _starts(key[at])
        yield b, [_thin(np.diff(key[at][first], prepend=np.int64(0))), _thin(np.diff(first, append=len(at))), None, None,
                  _thin(row[at].astype(np.int64))]


def _requests(held: list, origin: int, ids, buckets: int):
    """Blocks of a stretch of rows, ``origin`` its first: their figures, and
    by bucket of the key what they look up; empties the list."""
    tokens, log, base, known, word, word_row, pair, pair_row, context, symbol, row = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    none = pa.nulls(1, pa.list_(ids.type))
    yield _batch([(origin % buckets, ROWS, origin, _thin(tokens), log.tobytes(), base.tobytes(), _thin(known))],
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
    for kind, key, at in ((WORDS, word, word_row), (TAILS, pair, pair_row)):
        for b, fields in _listed(key, at, buckets):
            yield _batch([(b, kind, origin, *fields)], none)
    order = np.lexsort((symbol, context))            # stable: rows stay in order
    context, symbol, row = context[order], symbol[order], row[order]
    for b, at in _dealt(context, buckets):
        first = _starts(context[at], symbol[at])
        some = at[first]
        yield _batch([(b, CONTEXTS, origin, *_pack(context[some], symbol[some], np.diff(first, append=len(at)), row[at], heads=False))], none)


def _score(model, buckets):
    """Per stretch of rows their figures over the frequent words, and blocks of
    their other words and of the transitions and contexts that the broadcast
    does not hold."""
    def run(batches):
        tree_, counts, pairs, retained = model.value
        tree = Tree.of(*tree_)
        logs = np.log10(counts + 1.0)
        held, ids_, origin, size, texts = [], [], None, 0, 0
        for rows, data, off in pieces(batches):
            here = Run.of(tree, data, off)
            hashes, begin, ids = here.hashes, here.begin, here.ids
            log = tree.log10(ids, begin)
            log[begin[:-1]] = 0.0                    # the opening boundary is given
            head = ids >= 0
            base = np.where(head, logs[np.maximum(ids, 0)] if len(logs) else 0.0, 0.0)
            base[begin[:-1]] = 0.0
            known = head.copy()
            known[begin[:-1]] = False
            sums = [np.add.reduceat(x, begin[:-1]) for x in (log, base, known.astype(np.int64))]
            rare = ~head
            rare[begin[:-1]] = False
            rare = np.flatnonzero(rare)
            at, pair = tree.tails(ids, begin, pairs)
            three = np.zeros(0, np.int64)
            if retained is not None:
                three = np.flatnonzero(here.place >= 2)
                three = three[_held(retained, _named(here.pair[three - 1], CONTEXT))]
            owner = (np.repeat(np.arange(len(begin) - 1), np.diff(begin)) + texts).astype(np.int32)
            held.append([np.diff(begin) - 1, *sums, hashes[rare], owner[rare], pair, owner[at],
                         here.pair[three - 1], here.symbols[three], owner[three]])
            ids_.append(rows.column(1))
            origin = rows.column(2)[0].as_py() if origin is None else origin
            size, texts = size + rows.num_rows + len(rare) + len(at) + len(three), texts + rows.num_rows
            if size > FLUSH // 2:
                yield from _requests(held, origin, pa.concat_arrays(ids_), buckets)
                held, ids_, origin, size, texts = [], [], None, 0, 0
        if held:
            yield from _requests(held, origin, pa.concat_arrays(ids_), buckets)
    return run


class Bucket:
    """The counts and the states of a bucket, to look up."""

    def __init__(self, blocks: list, shared: tuple):
        self.shared = shared
        self.key, self.count = _table([r for r in blocks if r[0] == COUNTS])
        self.context = self.triple = np.zeros(0, np.int64)
        for r in blocks:
            if r[0] == STATES:
                context, symbol, count, low = _unpack(*r[2:8])
                first, sizes, real, share, left, below = _shares(context, symbol, count, low, shared)
                self.context, self.left = context[first], np.log10(left)
                context, symbol, below, left = context[real], symbol[real], below[real], np.repeat(left, sizes)[real]
                triple = _joined(context, symbol, False, 0)
                order = np.argsort(triple)
                self.triple, self.lift = triple[order], np.log10((share[real] + left * below) / (left * below))[order]

    def sums(self, kind: int, fields: list) -> list:
        """Row -> what the looked up adds to log, base and known."""
        root, totals, rest, discount, total = self.shared
        if kind == CONTEXTS:
            context, symbol, times, row = _unpack(*fields, heads=False)
            at = _find(self.context, context)
            row = row[np.repeat(at >= 0, times)]
            context, symbol, times, at = [x[at >= 0] for x in (context, symbol, times, at)]
            log = self.left[at] if len(at) else np.zeros(0)
            at = _find(self.triple, _joined(context, symbol, False, 0))
            log[at >= 0] += self.lift[at[at >= 0]] if len(self.triple) else 0.0
            return [np.bincount(row, np.repeat(log, times)), None, None]
        key, sizes, row = np.cumsum(_thick(fields[0])), _thick(fields[1]), _thick(fields[4])
        at = _find(self.key, key)
        row = row[np.repeat(at >= 0, sizes)]
        key, sizes, count = key[at >= 0], sizes[at >= 0], self.count[at[at >= 0]]
        if kind == TAILS:
            lift = np.log10(_ups(key, count, root, totals, rest, discount) / rest[key >> ID_BITS])
            return [np.bincount(row, np.repeat(lift, sizes)), None, None]
        return [np.bincount(row, np.repeat(x, sizes)) for x in (np.log10((count - discount) / total), np.log10(count + 1.0), np.ones(len(count)))]


def _sum(parts: list) -> np.ndarray:
    """Sum of vectors of any lengths."""
    out = np.zeros(max([len(x) for x in parts if x is not None], default=0))
    for x in parts:
        if x is not None:
            out[:len(x)] += x
    return out


def _look_up(model):
    """Per stretch of rows the sums of what its blocks look up, over the
    buckets of a task as long as FLUSH sums hold them; rows come sorted by
    bucket, the bucket's own blocks (origin -1) first."""
    def run(batches):
        def done():
            for origin, parts in sums.items():
                yield _batch([(0, ANSWER, origin, None, *[_thin(x.view(np.int64)) for x in parts])], none)
            sums.clear()

        shared = model.value
        last, own, bucket, sums, none = None, [], None, {}, None
        for batch in batches:
            none = pa.nulls(1, batch.schema.field("ids").type)
            for i in range(batch.num_rows):
                b, kind, origin, *fields = [batch.column(k)[i].as_py() for k in range(3 + len(FIELDS))]
                if b != last:
                    last, own, bucket = b, [], None
                if origin < 0:
                    own.append([kind, origin, *fields])
                elif kind == ROWS:
                    yield batch.slice(i, 1)
                else:
                    bucket = bucket or Bucket(own, shared)
                    found = bucket.sums(kind, fields)
                    sums[origin] = [_sum(x) for x in zip(sums.get(origin, [None] * 3), found)]
                    if sum(len(x) for parts in sums.values() for x in parts) > FLUSH:
                        yield from done()
        yield from done()
    return run


def _totals(batches):
    """doc_id and figures of the rows of every stretch; blocks come sorted by it."""
    def rows(held, ids):
        tokens = _thick(next(r[3] for r in held if r[1] == ROWS))
        out = []
        for k in (4, 5, 6):
            parts = [_thick(r[k]).view(np.float64) for r in held if r[1] != ROWS]
            own = next(r[k] for r in held if r[1] == ROWS)
            out.append(_sum([_thick(own).astype(float) if k == 6 else np.frombuffer(own), *parts]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(tokens), pa.array(out[0]), pa.array(out[1]), pa.array(np.rint(out[2]).astype(np.int64))],
            ["doc_id", "n_tokens", "log", "base", "known"])
    held, ids = [], None
    for batch in batches:
        for i in range(batch.num_rows):
            row = [batch.column(k)[i].as_py() for k in range(3 + len(FIELDS))]
            if held and row[2] != held[0][2]:
                yield rows(held, ids)
                held = []
            held.append(row)
            if row[1] == ROWS:
                ids = batch.column(3 + len(FIELDS)).slice(i, 1).flatten()
    if held:
        yield rows(held, ids)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def _count_symbols(data, off):
    hashes, begin = _hashes(data, off)
    return np.delete(hashes, begin[:-1])             # the opening boundaries are not counted


def score(docs: DataFrame, parts: int = 7, part: int = 2, depth: int = DEPTH, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score of every row; rows outside the held-out part train both models."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    out = held_out(F.col("doc_id"), parts, part)
    body = F.coalesce("text", F.lit("")).cast("binary").alias("t")
    train = docs.filter(~out).select(body)
    vocabulary = cut(count_keys(train, _count_symbols), "vocabulary")
    total, kinds, once, twice = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    frequent = F.col("c") > total * max(min_share, 1 / (ONE + 1))     # so that word ids fit their bits
    head = vocabulary.filter(frequent).toArrow()
    order = np.argsort(head["key"].to_numpy())
    words, counts = head["key"].to_numpy()[order], head["c"].to_numpy()[order]
    tree, totals, blocks, states, held = fit(train, vocabulary.filter(~frequent), words, counts, total, discount, depth, min_share)
    retained = None
    if states is not None:
        retained = bits(states.mapInArrow(_heads, "key bigint, last bigint"), CONTEXT)
        blocks = blocks.unionByName(states)
    model = spark.sparkContext.broadcast((tree.plain(), counts, held, retained))
    shared = spark.sparkContext.broadcast((tree.root, totals, tree.levels[0].rest, discount, total))
    wide = f"{BLOCK}, ids array<{kind}>"
    asked = docs.select(body, "doc_id", F.monotonically_increasing_id().alias("row")).mapInArrow(_score(model, _parts(docs)), wide)
    asked = asked.unionByName(blocks.withColumn("ids", F.lit(None).cast(f"array<{kind}>")))
    found = asked.repartition("bucket").sortWithinPartitions("bucket", "origin", "kind").mapInArrow(_look_up(shared), wide)
    rows = found.repartition("origin").sortWithinPartitions("origin").mapInArrow(
        _totals, f"doc_id {kind}, n_tokens bigint, log double, base double, known bigint")
    norm = float(np.log10(total + kinds + 1.0))
    unknown = float(np.log10(discount * kinds / total)) if total else 0.0
    return rows.select(
        "doc_id", out.alias("held_out"), "n_tokens", F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("log") + (F.col("n_tokens") - F.col("known")) * unknown).alias("score"))
