"""The suffix tree's lookups travel as packed blocks, not as a row each."""

import os
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tripwx.llm import bitmap
from tripwx.llm import suffix_tree as s


def made(rng, docs):
    common = [f"w{i}" for i in range(40)]
    return [(i, " ".join(rng.choice(common) if rng.random() < 0.9 else f"x{rng.randrange(60)}" for _ in range(rng.randrange(60))))
            for i in range(docs)]


def test_no_row_per_lookup(spark):
    """Neither the plan nor a scratch table holds a row or an array entry per word looked up; used-up tables go."""
    docs = spark.createDataFrame(made(random.Random(3), 400), "doc_id bigint, text string")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tripwx-scratch"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = s.score(docs)
    assert out.count() == 400
    new = {n.split("-")[1] for n in os.listdir(folder) if n not in before}
    assert "states" in new and not new & {"scored", "triples", "lifts"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "SortMergeJoin" not in plan and "explode" not in plan


def test_numbers_and_rows_come_back():
    for x in ([], [0], [0, 1, 255], [256, 3], [-1, 5], [2 ** 62, -2 ** 63]):
        assert s._thick(s._thin(np.array(x, np.int64))).tolist() == x
    context = np.array([-2 ** 60, -2 ** 60, -2 ** 60, 7 << s.ID_BITS | 4, 7 << s.ID_BITS | 4])
    symbol = np.array([s.HEAD + 6, -2 ** 50, 9, s.HEAD, 2 ** 55])
    count = np.array([5, 2, 3, 4, 2])
    for got, want in zip(s._unpack(*s._pack(context, symbol, count)), (context, symbol, count)):
        assert got.tolist() == want.tolist()
    first, last, key, want = s._wants(context, symbol)
    assert first.tolist() == [0, 3] and last.tolist() == [5, 5, 5, 4, 4] and want.tolist() == [False, True, True, False, True]
    assert key[want].tolist() == [-2 ** 50, 5 << s.ID_BITS | 9, 2 ** 55]


def test_passed_on_early_counts_the_same(monkeypatch):
    """A task that passes on its counts and requests often gives the same sums."""
    texts = [t for _, t in made(random.Random(4), 300)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts[a:a + 50]], pa.binary()),
                                           pa.array(range(a, a + 50)), pa.array(range(a, a + 50))], ["t", "doc_id", "row"])
               for a in range(0, 300, 50)]
    words = np.full(1 << (s.MAP_BITS - 6), ~np.uint64(0))
    hashes = np.unique(np.concatenate([s._hashes(*s.pieces([b]).__next__()[1:])[0] for b in batches]))[:30]
    plain = s.Tree(hashes, np.full(30, 0.01), [s.Level(np.zeros(0, np.int64), np.zeros(0), np.full(30, 0.5))]).plain()

    def triples():
        blocks = list(s._tally_triples(SimpleNamespace(value=(plain, words)), 5)(iter(batches)))
        rows = sorted((r for r in s._rows(blocks)), key=lambda r: r[0])
        got = [s._unpack(*r[3:8]) for b in s._gather_triples(iter([s._batch([r]) for r in rows])) for r in s._rows([b])]
        return len(blocks), sorted(zip(*[np.concatenate(x).tolist() for x in zip(*got)]))

    def asked():
        out, blocks = [], list(s._score(SimpleNamespace(value=(plain, np.full(30, 9), words, words)), 5)(iter(batches)))
        for r in s._rows(blocks):
            if r[1] == s.CONTEXTS:
                context, symbol, times, row = s._unpack(*r[3:9], heads=False)
                out += zip(np.repeat(context, times).tolist(), np.repeat(symbol, times).tolist(), (row + r[2]).tolist())
        ids = [i for b, r in zip(blocks, s._rows(blocks)) if r[1] == s.ROWS for i in b.column("ids")[0].as_py()]
        return len(blocks), sorted(out), ids
    (few, want), (few_asked, rows, ids) = triples(), asked()
    monkeypatch.setattr(s, "FLUSH", 2000)
    (many, got), (many_asked, rows_again, ids_again) = triples(), asked()
    assert many > few and many_asked > few_asked and want and rows
    assert got == want and rows_again == rows and ids == ids_again == list(range(300))


def test_bits(spark):
    keys = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 5000)
    words = s.bits(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), s.PAIR)
    name = s._named(keys, s.PAIR)
    assert s._held(words, name).all() and bitmap.holds(words, name).all()
    assert sum(int(w).bit_count() for w in words[words > 0]) == len(np.unique(np.concatenate(s._marks(name))))
    assert not s._held(words, s._named(keys, s.CONTEXT)).any()
