"""Periodic runs, line dedup and source audit against brute force, and on
nulls, empty tables, repeated rows, hot keys and clashing column names."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
from tripwx.llm import line_runs, period_runs, source_audit  # noqa: E402

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
WORD = r"[^\x20\x09-\x0D]+"


# ---------------------------------------------------------------- periodic runs
def plain_runs(w):
    """(start, length, period) of every run, one period after the other."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in w], np.int64)
    found = {}
    for q in range(1, len(w) // 4 + 1):
        same = np.r_[False, w[:-q] == w[q:], False]
        turn = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()):
            if b - a + q >= max(6, 4 * q):
                found.setdefault((a, b - a + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rng, n):
    w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 4))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_of_random_texts():
    rng, grid = random.Random(4), period_runs.grid_places()
    for _ in range(300):
        texts = [random_words(rng, rng.randrange(80)) for _ in range(rng.randrange(1, 6))]
        first = np.cumsum([0] + [len(t) for t in texts])
        rows, at = period_runs.slice_runs(np.array([x for t in texts for x in t], np.uint64), first, grid)
        for i, t in enumerate(texts):
            assert [tuple(r) for r in rows[at[i]:at[i + 1]].tolist()] == plain_runs(t), t


def test_extensions_both_ways():
    """The grammar's extensions against a word by word comparison."""
    rng = random.Random(9)
    for _ in range(150):
        w = random_words(rng, rng.randrange(2, 50))
        seq = [-1, *w, -2]
        x, y = zip(*[(i, j) for i in range(1, len(w) + 1) for j in range(1, len(w) + 1) if i != j])
        grammar = period_runs.Grammar(np.array(seq))
        assert len(grammar.symbols[-1]) == 3
        for step in (1, -1):
            got = grammar.extend(np.array(x), np.array(y), step > 0).tolist()
            for i, j, n in zip(x, y, got):
                assert all(seq[i + k * step] == seq[j + k * step] for k in range(n))
                assert seq[i + n * step] != seq[j + n * step]


def test_long_texts_leave_the_grid_table(monkeypatch):
    """Texts beyond GRID words, one run over all of it and many short runs of one period."""
    monkeypatch.setattr(period_runs, "GRID", 64)
    grid = period_runs.grid_places()
    for w in ([0] * 3000, [0, 1] * 4 + [0, 2] * 4, ([0, 1] * 5 + [0, 2] * 5) * 60, [i % 50 for i in range(1000)] + list(range(60, 100))):
        rows, _ = period_runs.slice_runs(np.array(w, np.uint64), np.array([0, len(w)]), grid)
        assert [tuple(r) for r in rows.tolist()] == plain_runs(w)


def test_runs_edges(spark):
    rows = [(1, "a b " * 5), (1, "a b " * 5), (2, None), (3, ""), (4, " \n\t"), (None, "x x x x x x"), (5, "x x x x x"),
            (6, "é è " * 4 + "A a A a"), (7, "n" * 100_000), (8, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("z") for c in ("runs", "n_words", "kept", "start", "best")})
    out = sorted(period_runs.digest(period_runs.find_runs(docs)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in out]
    none = (0, None, None, None, None)
    assert got == [(1, 1, 0, 10, 2, 5000), (1, 1, 0, 10, 2, 5000), (2, *none), (3, *none), (4, *none), (5, *none),
                   (6, 1, 0, 8, 2, 4000), (7, *none), (8, 1, 0, 50_000, 1, 50_000_000), (None, 1, 0, 6, 1, 6000)]
    assert out[0].collapsed_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert {out[i].runs_sha256 for i in (2, 3, 4)} == {out[2].collapsed_sha256} == {hashlib.sha256(b"").hexdigest()}
    assert period_runs.find_runs(docs.limit(0)).count() == 0


@tables
def test_runs_of_the_table(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op11_period_runs"](spark, SF).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        w = re.findall(WORD, text or "")
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        assert got[doc] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest())


# ---------------------------------------------------------------- lines
def plain_lines(rows, min_docs, min_chars):
    """Kept text per row: counts over rows, the holder is the largest id."""
    held = collections.defaultdict(list)
    keys = [[k if len(k) >= min_chars else None for k in
             (re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r")) for line in (t or "").split("\n"))]
            for _, t in rows]
    for (doc, _), own in zip(rows, keys):
        for key in set(own) - {None}:
            held[key].append(doc)
    out = []
    for (doc, text), own in zip(rows, keys):
        stay = [line for line, key in zip((text or "").split("\n"), own)
                if key is None or len(held[key]) < min_docs or doc == max((d for d in held[key] if d is not None), default=None)]
        out.append((doc, "\n".join(stay), len(own), len(own) - len(stay)))
    return sorted(out, key=str)


def random_rows(rng, n):
    lines = ["", "short", " A long line that many documents hold ", "a long LINE that many documents hold",
             "É" * 20, "é" * 20, "É" * 19, "0123456789012345678", "01234567890123456789\r"]
    lines += [f"line number {i} of the made-up corpus" for i in range(40)]
    return [(i // 2 if rng.random() < 0.1 else i, "\n".join(rng.choices(lines, k=rng.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("batches, fanout, hot", [(1, 2, 1 / 4096), (5, 2, 0.05), (8, 4, 1.0)])
def test_lines_random(spark, monkeypatch, batches, fanout, hot):
    """Few and many batches and levels; keys found by broadcast and by join."""
    monkeypatch.setattr(line_runs, "HOT_SHARE", hot)
    rows = random_rows(random.Random(batches), 150) + [(None, "a long line that many documents hold"), (151, None), (152, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = line_runs.dedup_lines(docs, 3, 20, batches, fanout).select("doc_id", "kept", "n_lines", "n_dropped")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_lines(rows, 3, 20)


def test_lines_in_task_flushes(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "HELD_KEYS", 3)
    rows = random_rows(random.Random(77), 60)
    got = line_runs.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((tuple(r) for r in got.select("doc_id", "kept", "n_lines", "n_dropped").collect()), key=str) == plain_lines(rows, 3, 20)


def test_lines_edges(spark):
    line = "the same line of text in all of them"
    docs = spark.createDataFrame([(str(i), line) for i in range(5)], "doc_id string, text string").withColumns(
        {c: F.lit(1) for c in ("h", "g", "th", "kept", "last", "batch", "known")})
    assert sorted((r.doc_id, r.kept) for r in line_runs.dedup_lines(docs).collect()) == [("0", ""), ("1", ""), ("2", ""), ("3", ""), ("4", line)]
    assert line_runs.dedup_lines(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, line)] * 3 + [(None, None)], "doc_id int, text string")
    assert sorted(r.kept for r in line_runs.dedup_lines(nulls).collect()) == ["", line, line, line]


def test_runs_are_disjoint_and_merge_without_shuffle(spark):
    """Three batches: every key is its own in one run; a batch meets the runs
    and runs are compacted bucket by bucket."""
    store = line_runs.LineRuns(spark, fanout=2)
    for keys in ([1, 2, 3], [2, 3, 4], [4, 5]):
        batch = spark.createDataFrame([(k, k, 1, 100 - k) for k in keys], "h bigint, g bigint, docs bigint, last bigint")
        store.add(store.table(store.dealt(batch), "test"))
    runs = [r for level in store.levels.values() for r in level]
    assert sorted(x.h for r in runs for x in r.collect()) == [1, 2, 3, 4, 5]
    assert {r.h: r.docs for r in store.totals().collect()} == {1: 1, 2: 2, 3: 2, 4: 2, 5: 1}
    met = runs[0].hint("merge").join(runs[1], ["h", "g"], "left_anti")
    assert "Exchange hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- source audit
def plain_audit(rows, min_docs=3, top=200):
    count, held, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        groups.add((lang, source))
        count[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        own = sorted(g for g in groups if g[0] == lang)
        whole = collections.Counter()
        for g in own:
            whole.update({t: count[g][t] for t in kept})

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        q = share(whole)
        p = {g: share(count[g]) for g in own}
        for g in own:
            pairs = [(sum((p[g][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o[1]) for o in own if o != g]
            terms = [((p[g][t] - q[t]) ** 2 // q[t], t) for t in kept if count[g][t] and p[g][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(*g, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def test_audit_random(spark, monkeypatch):
    """More groups than a block, more terms than a term block, small flushes."""
    monkeypatch.setattr(source_audit, "TERM_BLOCK", 16)
    monkeypatch.setattr(source_audit, "GROUP_BLOCK", 3)
    monkeypatch.setattr(source_audit, "HELD_TERMS", 50)
    rng = random.Random(2)
    words = [f"w{chr(97 + i // 9)}{chr(97 + i % 9)}" for i in range(70)] + ["É", "é", "Été", "ABC", "abc"]
    rows = [(rng.choice(["en", "fr", None]), rng.choice([f"s{i}" for i in range(8)] + [None, "S", "é"]),
             " ".join(rng.choices(words, k=rng.randrange(30)))) for _ in range(120)]
    rows += [("xx", "a", "only one document has these"), ("xx", "b", None), ("yy", "a", ""), ("en", "zero", "...")]
    got = source_audit.report(spark.createDataFrame(rows, "lang string, source string, text string"), top=20)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, top=20)


def test_audit_edges(spark):
    schema = "lang string, source string, text string"
    none = spark.createDataFrame([], schema)
    assert source_audit.report(none).count() == 0
    docs = spark.createDataFrame([("en", "a", "x y"), ("en", "b", "x y")] * 3 + [("fr", "a", None)], schema)
    docs = docs.withColumns({c: F.lit(1) for c in ("term", "n", "place", "block", "total", "t")})
    assert sorted(tuple(r) for r in source_audit.report(docs).collect()) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    bare = spark.createDataFrame([("fr", "a", "one"), ("fr", "b", None)], schema)
    assert sorted(tuple(r) for r in source_audit.report(bare).collect()) == [
        ("fr", "a", "pair", "b", 0, 1), ("fr", "b", "pair", "a", 0, 1)]


def test_shares_are_exact():
    """Counts whose product with the scale passes 64 bits."""
    rng = random.Random(1)
    for _ in range(200):
        total = rng.randrange(1, 10 ** rng.randrange(1, 15))
        count = [rng.randrange(total) for _ in range(5)]
        assert source_audit.shares(np.array(count), total).tolist() == [1 + 10 ** 9 * (c + 1) // total for c in count]
