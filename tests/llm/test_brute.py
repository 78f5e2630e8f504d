"""The queries against brute force on the smallest tables."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tripwx.llm import ann, decontam, language_id, license_scan, quality  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def rows(sql):
    return duckdb.sql(sql.replace("FROM ", f"FROM '{SF}/").replace(";", ".parquet'")).fetchall()


@pytest.fixture(scope="module")
def texts():
    return {d: t or "" for d, t in rows("SELECT doc_id, text FROM documents;")}


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def words(text):
    return text.encode().lower().split()


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def count(s):
    return sum(c.isdigit() for c in s)


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= count(m) <= 19 and luhn(m)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count(m) <= 15)]


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text) if ok(m.group())]


def test_pii_base(spark, texts):
    for r in run(spark, "op6_pii"):
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(","))


def test_pii_random(spark):
    """Random strings over the characters that matter, all kinds of near misses."""
    from tripwx.llm import pii
    rng = random.Random(3)
    made = ["".join(rng.choice("a@.-_+ 0123456789()é") for _ in range(rng.randrange(80))) for _ in range(1500)]
    made += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 4111 1111 1111 1111", "+1 (2) 3.4-5678901 x +12345678 ",
             "000.0001.255.256.1.1", "pay GB82 WEST 1234 5698 7654 32 now", "ssn 123-45-6789", "123-45-6789", "x@y.z."]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id int, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find(df)).collect()}
    for i, t in enumerate(made):
        assert got[i].base_sha256 == hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest(), t
    assert "iban:4:31" in got[len(made) - 4].spans and "ssn:4:15" in got[len(made) - 3].spans
    assert "ssn" not in got[len(made) - 2].spans


def test_jaccard_components(spark, texts):
    sets = {}
    for d, t in texts.items():
        w = words(t)
        sets[d] = frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
    part = {d: d for d in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x
    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                part[max(x, y)] = min(x, y)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in run(spark, "op7_jaccard_join")} == {
        (d, len(s), root(d)) for d, s in sets.items()}


def test_many_cells(spark, monkeypatch):
    """Large groups split over cells find the same components as one cell."""
    from tripwx.llm import jaccard_join
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    made = []
    for i in range(300):
        copy = list(base) if i % 3 else [f"v{j}" for j in range(120)]
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}"
        made.append((i, " ".join(copy)))
    df = spark.createDataFrame(made, "doc_id bigint, text string")
    whole = sorted(map(tuple, jaccard_join.join_components(df, 3, 90, 100).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", 16)
    split = sorted(map(tuple, jaccard_join.join_components(df, 3, 90, 100).select("doc_id", "component_id").collect()))
    assert whole == split and 2 < len({c for _, c in whole}) < 300


def test_suffix_tree_baseline(spark, texts):
    tokens = {d: words(t) + [None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    better = []
    for r in run(spark, "op8_suffix_tree"):
        ws = tokens[r.doc_id]
        base = sum(np.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in ws)
        assert abs(base - r.base_score) < 1e-6 * max(1, abs(base))
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(ws), sum(w in counts for w in ws), total, held[r.doc_id])
        if r.held_out:
            better.append(r.score > r.base_score)
    assert np.mean(better) > 0.8


@pytest.mark.parametrize("min_share", [1e-9, 2e-4, 3e-3])
def test_one_word_contexts(spark, texts, min_share):
    """All transitions between frequent words seen twice count, whether broadcast or in the table."""
    from tripwx.llm import suffix_tree as s
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.score for r in s.score(docs, depth=1, min_share=min_share).collect()}
    lines = {d: [None, *words(t), None] for d, t in texts.items()}
    train = [x for d, x in lines.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    count = collections.Counter(w for x in train for w in x[1:])
    pair = collections.Counter(p for x in train for p in zip(x, x[1:]))
    total = sum(count.values())
    once, twice = (sum(c == k for c in count.values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice)))
    states = collections.defaultdict(dict)
    for (b, w), c in pair.items():
        if c >= 2 and min(count[b], count[w]) > total * min_share:
            states[b][w] = c

    def root(w):
        return (count[w] - d) / total if w in count else d * len(count) / total
    rest = {}
    for b, seen in states.items():
        left = 1 - sum(c - d for c in seen.values()) / count[b]
        gain = sum(c * np.log(((c - d) / count[b] + left * root(w)) / root(w)) for w, c in seen.items())
        if gain + (count[b] - sum(seen.values())) * np.log(left) >= s.MIN_GAIN:
            rest[b] = left
    assert rest
    for i, x in lines.items():
        want = sum(np.log10(max(states[b].get(w, d) - d, 0) / count[b] + rest[b] * root(w)) if b in rest else np.log10(root(w))
                   for b, w in zip(x, x[1:]))
        assert abs(want - got[i]) < 1e-6 * max(1, abs(want))


@pytest.mark.parametrize("min_share", [1e-9, 2e-4])
def test_two_word_contexts(spark, texts, min_share):
    """Every two-word context, of rare words too, and each of its transitions seen twice count, whatever their share."""
    from tripwx.llm import suffix_tree as s
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.score for r in s.score(docs, min_share=min_share).collect()}
    lines = {d: [None, *words(t), None] for d, t in texts.items()}
    train = [x for d, x in lines.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    count = collections.Counter(w for x in train for w in x[1:])
    pair = collections.Counter(p for x in train for p in zip(x, x[1:]))
    triple = collections.Counter(p for x in train for p in zip(x, x[1:], x[2:]))
    total = sum(count.values())
    once, twice = (sum(c == k for c in count.values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice)))

    def root(w):
        return (count[w] - d) / total if w in count else d * len(count) / total

    def states(found, sizes, below, live):
        """State -> its transitions; state -> what it leaves; the states that pass the test."""
        after = collections.defaultdict(dict)
        for key, c in found.items():
            if c >= 2 and live(key):
                after[key[:-1]][key[-1]] = c
        left = {b: 1 - sum(c - d for c in seen.values()) / sizes(b) for b, seen in after.items()}
        gain = {b: sum(c * np.log(((c - d) / sizes(b) + left[b] * below(b, w)) / below(b, w)) for w, c in seen.items())
                + (sizes(b) - sum(seen.values())) * np.log(max(left[b], 1e-12)) for b, seen in after.items()}
        return after, left, {b for b in after if gain[b] >= s.MIN_GAIN}

    def frequent(w):
        return count[w] > total * min_share
    one, left1, kept1 = states(pair, lambda b: count[b[0]], lambda b, w: root(w), lambda k: frequent(k[0]) and frequent(k[1]))

    def p1(b, w):
        return max(one[b].get(w, d) - d, 0) / count[b[0]] + left1.get(b, 1) * root(w) if b in kept1 else root(w)
    two, left2, kept2 = states(triple, lambda b: pair[b], lambda b, w: p1(b[1:], w), lambda k: True)
    assert kept2 and (min_share < 1e-4 or any(not frequent(w) for b in kept2 for w in b))
    kept1 |= {b[1:] for b in kept2 if frequent(b[1])}

    def p2(b, w):
        return max(two[b].get(w, d) - d, 0) / pair[b] + left2[b] * p1(b[1:], w) if b in kept2 else p1(b[1:], w)
    for i, x in lines.items():
        want = np.log10(p1((x[0],), x[1])) + sum(np.log10(p2(k[:2], k[2])) for k in zip(x, x[1:], x[2:]))
        assert abs(want - got[i]) < 1e-6 * max(1, abs(want))


def test_states_sum_to_one():
    """Root and interpolated states are distributions."""
    from tripwx.llm import suffix_tree as s
    rng = np.random.default_rng(1)
    counts = rng.integers(2, 50, 30)
    total, d = int(counts.sum()), 0.5
    tree = s.Tree(np.arange(30), (counts - d) / total)
    keys = np.unique((rng.integers(0, 30, 60) << s.ID_BITS) | rng.integers(0, 30, 60))
    seen = rng.integers(2, 5, len(keys)).astype(float)
    tree.levels.append(s._level(tree, 1, keys, seen, np.full(30, 60.0), d, -1e9)[0])
    unknown = d * 30 / total
    for context in np.flatnonzero(~np.isnan(tree.levels[0].rest)):
        p = s._chain(tree, 1, np.full(30, context), np.arange(30))
        assert abs(p.sum() + tree.levels[0].rest[context] * unknown - 1) < 1e-9


def test_quality_accuracy(spark):
    larger = SF.replace("sf0.001", "sf0.01")
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    out = [r for r in entry.queries()["op9_quality"](spark, larger).collect() if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in out]) > 0.93
    assert all(r.predicted == int(r.score >= 0.3) for r in out)


def test_trees_match_a_row_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.train(x, y, trees=20, depth=3)
    start, feature, cut, leaf = model
    for row, p in zip(x[:50], quality.predict(model, x[:50])):
        margin = start
        for t in range(len(feature)):
            node = 0
            while node < feature.shape[1]:
                node = 2 * node + 1 + int(row[feature[t, node]] > cut[t, node])
            margin += leaf[t, node - feature.shape[1]]
        assert abs(p - 1 / (1 + np.exp(-margin))) < 1e-9
    assert ((quality.predict(model, x) > 0.5) == y).mean() > 0.95


def test_language_accuracy(spark):
    lang = dict(rows("SELECT doc_id, lang FROM documents;"))
    out = [r for r in run(spark, "op10_language_id") if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.95


def plain_kneser_ney(texts, order):
    """Dictionaries over strings: P(char | context), by the textbook."""
    levels = []
    counts = collections.Counter()
    for t in texts:
        padded = "\0" * (order - 2) + " " + t + " "
        for i in range(order - 1, len(padded)):
            counts[padded[i - order + 1:i], padded[i]] += 1
    for n in range(order, 0, -1):
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        total, kinds = collections.Counter(), collections.Counter()
        for (context, _), c in counts.items():
            total[context] += c
            kinds[context] += 1
        levels.append((counts, discount, total, kinds))
        counts = collections.Counter((context[1:], char) for context, char in counts) if n > 1 else None

    def p(context, char):
        out = 1 / language_id.ALPHABET
        for n, (own, discount, total, kinds) in enumerate(reversed(levels)):
            short = context[len(context) - n:]
            if total[short]:
                seen = own[short, char]
                out = (seen - discount if seen else 0) / total[short] + discount * kinds[short] / total[short] * out
        return out
    return p


def test_kneser_ney_against_dictionaries():
    """Scripts of one to four bytes a character, capitals and punctuation."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcde ", k=200)), "Été à la plage, ÉTÉ!", "Привет, МИР привет", "日本語の文、日本の語", "𝒳𝒴 𐐀𐐁", "", "?!", "a"]
    parts = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    data = np.frombuffer(b"".join(parts), np.uint8)
    stream, begin = language_id.normal(data, off)
    forms = ["".join(map(chr, stream[a:b])) for a, b in zip(begin[:-1], begin[1:])]
    assert forms[1:4] == [" été à la plage été  ", " привет мир привет ", " 日本語の文 日本の語 "] and forms[5:] == ["  ", "  ", " a "]
    context, char, at = language_id.grams(stream, begin, 4)
    kinds, count_ = np.unique(np.stack([context, char], 1), axis=0, return_counts=True)
    levels = language_id.kneser_ney(kinds[:, 0], kinds[:, 1], count_, 4)
    p = plain_kneser_ney([f[1:-1] for f in forms], 4)
    for _ in range(300):
        before = "".join(rng.choices("abдэ語 \0𐐨e", k=3))
        packed = sum(ord(c) << (21 * (2 - i)) for i, c in enumerate(before))
        after = rng.choice("abcdeэтр語の 𐐨z")
        got = language_id.log2(levels, np.array([packed]), np.array([ord(after)]))[0]
        assert abs(got - np.log2(p(before, after))) < 1e-9
    for before in ("abc", "日本語"):
        packed = sum(ord(c) << (21 * (2 - i)) for i, c in enumerate(before))
        seen = np.concatenate([np.arange(language_id.ALPHABET), np.unique(char[char >= language_id.ALPHABET])])
        assert abs(np.exp2(language_id.log2(levels, np.full(len(seen), packed), seen)).sum() - 1) < 1e-3


def test_entropies_are_sums_over_the_text():
    texts = ["abra cadabra", "", "x", "abra abra abra"]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    context, char, at = language_id.grams(*language_id.normal(data, off), 4)
    kinds, count_ = np.unique(np.stack([context, char], 1), axis=0, return_counts=True)
    levels = language_id.kneser_ney(kinds[:, 0], kinds[:, 1], count_, 4)
    h = language_id.entropies([levels], data, off, 4)[:, 0]
    for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
        one_by_one = [language_id.log2(levels, context[k:k + 1], char[k:k + 1])[0] for k in range(a, b)]
        assert abs(h[i] + np.mean(one_by_one)) < 1e-9


def many_languages(spark, languages, rows):
    """Languages of their own letters each; the last has a single row."""
    rng = random.Random(1)
    made, doc = [], 0
    for k in range(languages):
        letters = [chr(0x4E00 + 7 * k + i) for i in range(7)]
        for _ in range(rows if k < languages - 1 else 1):
            made.append((doc, " ".join("".join(rng.choices(letters, k=4)) for _ in range(12)), f"l{k:03d}"))
            doc += 1
    return spark.createDataFrame(made, "doc_id bigint, text string, lang string"), made


def test_every_language_is_learned(spark):
    docs, made = many_languages(spark, 300, 8)
    out = language_id.identify(docs, parts=10 ** 6).collect()
    assert len(out) == len(made)
    truth = {d: lang for d, _, lang in made}
    assert all(r.lang_pred == truth[r.doc_id] for r in out)


def test_groups_of_languages_agree_with_one_pass(spark):
    """Any number of passes over the texts gives the same answers."""
    docs, _ = many_languages(spark, 7, 12)
    docs = docs.unionByName(spark.createDataFrame([(1, "12 !?", None), (1, None, None), (2, "mixed 丁七", None)], docs.schema)).cache()
    one = sorted((r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in language_id.identify(docs).collect())
    many = sorted((r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in language_id.identify(docs, group=2).collect())
    assert one == many and len(one) == docs.count()


def test_training_sample_is_bounded(spark):
    """Rows of one id, equal rows and long texts do not grow the sample."""
    rows = [(1, f"text number {i % 500}", "en") for i in range(3000)] + [(2, "x" * 1000, "de"), (3, "y" * 1000, "de"), (4, "z" * 5000, "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = collections.Counter(r.lang for r in language_id.training_rows(df, 40, 1500).collect())
    assert got == {"en": 40, "de": 1, "fr": 1}


def test_neighbours(spark):
    data = rows("SELECT vec_id, embedding FROM embeddings;")
    ids, m = np.array([d[0] for d in data]), np.array([d[1] for d in data], float)
    norm = np.sqrt((m * m).sum(1))
    got = collections.defaultdict(list)
    for r in sorted(run(spark, "op4_ann")):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    for i in np.flatnonzero(ids % 50 == 0):
        s = (m * m[i]).sum(1) / (norm * norm[i])
        best = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        assert got[int(ids[i])] == [(k + 1, int(ids[j]), s[j]) for k, j in enumerate(best)]


def test_repeated_ids_fill_no_cell(spark, monkeypatch):
    """Rows of one id are spread over the fragments and blocks; the neighbours stay exact."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1200, 8))
    made = [(7 if i % 2 else 50 if i % 4 else i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(made, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(ann, "FRAGMENT", 64)
    monkeypatch.setattr(ann, "BLOCK", 32)
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"),
                     F.col("vec_id").isin(7, 50).alias("q"), F.lit(8).alias("dim"))
    most = {r.side: r.n for r in ann.cells(rows).groupBy("dim", "f", "b", "side").agg(F.count("*").alias("n")).groupBy("side").agg(F.max("n").alias("n")).collect()}
    assert most[0] < 3 * 64 and most[1] < 3 * 32
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.array([i for i, _ in made])
    # every row of an id is a query of its own; only the row itself is no candidate
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.search(df, F.col("vec_id").isin(7, 50), k=5).collect())
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, -2)
    want = [(int(ids[a]), k + 1, int(ids[b]), round(float(cosines[a, b]), 9)) for a in np.flatnonzero((ids == 7) | (ids == 50))
            for k, b in enumerate(np.lexsort((ids, -cosines[a]))[:5])]
    assert got == sorted(want)


def test_two_query_rows_of_one_id(spark):
    from pyspark.sql import functions as F
    made = [(50, [1.0, 0.0]), (50, [0.9, 0.1]), *[(i, [1.0, i / 10]) for i in range(1, 7)]]
    df = spark.createDataFrame(made, "vec_id bigint, embedding array<double>")
    out = ann.search(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted((r.query_id, r["rank"]) for r in out) == [(50, k) for k in (1, 1, 2, 2, 3, 3, 4, 4, 5, 5)]
    assert sum(r.vec_id == 50 for r in out) == 2


def test_quantisation_bound():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(40, 1500)), rng.normal(size=(50, 1500)) * 1e6
    (qa, sa, na, ea), (qb, sb, nb, eb) = ann.quantise(a), ann.quantise(b)
    near = ann.tile_products(qa, qb) * sa[:, None] * sb
    true = np.stack([ann.cosine(x, b) for x in a])
    assert (np.abs(near - true) <= na[:, None] * eb + ea[:, None] + 1e-9).all()
    assert (qa.astype(int) @ qb.T.astype(int) == ann.tile_products(qa, qb)).all()


def tiling(item, doc, least):
    """Greedy string tiling, word by word."""
    marked_i, marked_d, out = set(), set(), 0
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while (i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k]
                       and i + k not in marked_i and d + k not in marked_d):
                    k += 1
                if k > best:
                    best, found = k, [(i, d)]
                elif k == best and k >= least:
                    found.append((i, d))
        if best < least:
            return out
        for i, d in found:
            if not any(i + k in marked_i or d + k in marked_d for k in range(best)):
                marked_i.update(range(i, i + best))
                marked_d.update(range(d, d + best))
                out += best


def test_tiles_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item = rng.integers(1, 6, 30).astype(np.uint64)
        doc = np.concatenate([item[15:], rng.integers(0, 6, 20).astype(np.uint64), item[:15]])
        got = decontam.tiles(item, doc, 3)
        assert all((item[a:a + n] == doc[d:d + n]).all() and (doc[d:d + n] != 0).all() for a, d, n in got)
        assert len({k for a, _, n in got for k in range(a, a + n)}) == sum(n for *_, n in got)
        free = [0 if x == 0 else int(x) for x in doc]
        assert sum(n for *_, n in got) == tiling([int(x) for x in item], [x or -1 for x in free], 3)


def test_reordered_passage_is_caught(spark):
    item = " ".join(f"w{i}" for i in range(40))
    turned = " ".join(f"w{i}" for i in [*range(20, 40), *range(20)])
    half = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"before {turned.upper()}! after"), (2, half), (3, "unrelated")], "doc_id int, text string")
    bench = spark.createDataFrame([(9, item)], "item_id int, text string")
    assert [(r.doc_id, r["items"], r.coverage) for r in decontam.leaked(docs, bench).collect()] == [(1, [9], 1.0)]


def test_repeating_item_is_caught(spark):
    """Few distinct seeds may cover all of an item."""
    item = "row row row your boat " * 8
    docs = spark.createDataFrame([(1, f"they sang {item} all day"), (2, "la " * 40), (3, "row row row your boat")],
                                 "doc_id int, text string")
    bench = spark.createDataFrame([(5, item), (6, "la " * 30)], "item_id int, text string")
    assert {r.doc_id: r["items"] for r in decontam.leaked(docs, bench).collect()} == {1: [5], 2: [6]}


def test_decontamination_pairs(spark, texts):
    def tok(t):
        return [x for x in re.split(rb"[^a-z0-9\x80-\xff]+", t.encode().lower()) if x]
    items = {i: tok(t) for i, t in rows("SELECT item_id, text FROM benchmark;")}
    expected = set()
    for d, t in texts.items():
        w = tok(t)
        for i, x in items.items():
            seeds = {tuple(x[k:k + 5]) for k in range(len(x) - 4)}
            hit = [k for k in range(len(w) - 4) if tuple(w[k:k + 5]) in seeds]
            if 5 * len(hit) >= 0.8 * len(x) and tiling(x, [w[k] for k in sorted({k + j for k in hit for j in range(5)})], 5) >= 0.8 * len(x):
                expected.add((d, i))
    assert {(r.doc_id, i) for r in run(spark, "op3_decontamination") for i in r["items"]} == expected


def test_mixing_budgets(spark):
    source = dict(rows("SELECT doc_id, source FROM documents;"))
    size, target, taken = collections.Counter(), {}, collections.Counter()
    out = run(spark, "op5_mixing")
    for r in out:
        s = source[r.doc_id]
        size[s] += r.size
        target[s] = r.target
        taken[s] += r.taken
        assert r.taken <= 3 * r.size
    names = sorted(size)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, exact = sum(size.values()), set(names), {}
    while True:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 3 * size[n]]
        if not over:
            break
        for n in over:
            exact[n] = 3 * size[n]
            free.discard(n)
        left = sum(size.values()) - sum(exact.values())
    exact |= share
    for n in names:
        assert abs(target[n] - exact[n]) < 1e-6 and abs(taken[n] - exact[n]) <= 1
    assert all(r.source_size == size[source[r.doc_id]] for r in out)


def test_licence_rules(spark):
    mit = ("MIT License\n\nCopyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.\n\n"
           "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\n"
           "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met: 1. Redistributions of source code must retain the above copyright notice.\n"
           "2. Redistributions in binary form must reproduce the above copyright notice.")
    made = [(1, mit), (2, bsd), (3, "Text.\nReleased under the MIT License.\nMore text"),
            (4, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."), (5, "a license to be silly")]
    df = spark.createDataFrame(made, "doc_id int, text string")
    got = {r.doc_id: r.licences for r in license_scan.scan(df).collect()}
    assert got == {1: ["MIT"], 2: ["BSD-2-Clause"], 3: ["MIT"], 4: ["Apache-2.0", "CC-BY-NC-4.0"], 5: []}


def test_licence_lines_beside_wrapped_ones(spark):
    """A sentence counts whether it ends with its line or runs over lines, wherever the other kind stands."""
    grant = ("Permission is hereby granted, free of\ncharge, to any person obtaining a copy of this\n"
             "software and associated documentation files (the \"Software\"), to deal\nin the Software.")
    named, prose = "Licensed under CC BY-NC 4.0", "some prose follows here"
    asis = ("Neither the name of the company nor\nthe names of others may be used to endorse or\npromote products derived from\n"
            "this software without leave.")
    made = [(1, f"{named}\n{prose}\n\n{grant}"), (2, f"{grant}\n\n{named}\n{prose}"), (3, f"{named}\n{grant}"),
            (4, f"{prose}\n{named}\n{prose}\n{grant}\n{prose}\n{named}\n"), (5, f"# {named}\n# {grant}".replace("\n", "\r\n")),
            (6, "Released under the GNU General\nPublic License, version\n3.\n12\nReleased under the MIT\nLicense\n"),
            (7, f"Copyright (c) 2020 A\n{prose}\nAll rights reserved"), (8, f"{asis} {named}"), (9, f"{named}, they {prose}"),
            (10, "Copyright (c) 2020 A and\nmany others. All rights\nreserved.")]
    df = spark.createDataFrame(made, "doc_id int, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert {i: r.licences for i, r in got.items()} == {
        1: ["CC-BY-NC-4.0", "MIT"], 2: ["MIT", "CC-BY-NC-4.0"], 3: ["CC-BY-NC-4.0", "MIT"],
        4: ["CC-BY-NC-4.0", "MIT", "CC-BY-NC-4.0"], 5: ["CC-BY-NC-4.0", "MIT"], 6: ["GPL", "MIT"], 7: [],
        8: ["CC-BY-NC-4.0"], 9: [], 10: ["Proprietary"]}
    assert got[1].sentence_ids == ["ccbync_name", "-", "mit_grant"] and got[7].sentence_ids == ["copyright", "-", "reserved"]
    assert got[8].sentence_ids == ["bsd_endorse", "ccbync_name"]


def test_licence_names(spark):
    made = {"Licensed under the GNU Affero General Public License v3.": "AGPL",
            "Released under the GNU General Public License v3.0.": "GPL", "Licensed under GPLv2 or later.": "GPL",
            "This work is licensed under the GNU General Public License, version 3.": "GPL",
            "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0", "Licensed under CC BY-ND 4.0": "CC-BY-ND-4.0",
            "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
            "Licensed under the ISC License.": "ISC", "Licensed under the MIT License (see LICENSE).": "MIT",
            "Distributed under the Eclipse Public License v2.0.": "EPL-2.0", "Licensed under the Apache License v2.0": "Apache-2.0",
            "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "# SPDX-License-Identifier: GPL-3.0-or-later\n# Text": "GPL",
            "Released under CC0 1.0 Universal.": "CC0-1.0", "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
            "Licensed under the terms of a contract.": "", "SPDX-License-Identifier: none of these": ""}
    df = spark.createDataFrame(list(enumerate(made)), "doc_id int, text string")
    got = {r.doc_id: ",".join(r.licences) for r in license_scan.scan(df).collect()}
    assert {x: got[i] for i, x in enumerate(made)} == made


def _variants(parsed):
    """Strings of a pattern: every branch, optional words left out."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            more = [chr(arg)]
        elif op == "ANY":
            more = ["x"]
        elif op == "IN":
            first, value = arg[0]
            more = [chr(value[0] if str(first) == "RANGE" else value)]
        elif op == "SUBPATTERN":
            more = _variants(arg[-1])
        elif op == "BRANCH":
            more = [x for branch in arg[1] for x in _variants(branch)]
        else:
            assert op == "MAX_REPEAT"
            least, _, inner = arg
            least = max(least, str(inner[0][0]) == "ANY")
            more = [x * least for x in _variants(inner)] if least else [""]
        out = list(dict.fromkeys(a + b for a in out for b in more))
    return out


def test_every_licence_sentence_is_scanned(spark):
    made = [(name, x) for name, pattern in license_scan.SENTENCES for x in _variants(re._parser.parse(pattern))]
    # the same words parted by signs and line ends, in capitals
    made += [(name, x.upper().replace(" ", "_ ")) for name, x in made] + [(name, x.replace(" ", "\r\n")) for name, x in made]
    df = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(made)], "doc_id int, text string")
    missed = [made[r.doc_id] for r in license_scan.scan(df).collect() if not r.sentence_ids]
    assert not missed
    plain = ["Released under MIT.", "Available under Apache 2.0", "This program is distributed under the GPL v3.",
             "Released under CC BY-SA 4.0", "released under MPL 2.0"]
    df = spark.createDataFrame(list(enumerate(plain)), "doc_id int, text string")
    got = {r.doc_id: ",".join(r.licences) for r in license_scan.scan(df).collect()}
    assert [got[i] for i in range(5)] == ["MIT", "Apache-2.0", "GPL", "CC-BY-SA-4.0", "MPL-2.0"]


def test_licence_lines_of_the_table(spark, texts):
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    for r in run(spark, "op1_license_scan"):
        assert r.licences == ",".join(lines[x] for x in texts[r.doc_id].split("\n") if x in lines)


def test_pipeline(spark, texts):
    out = corpus_pipeline.run(spark, SF)
    got = out.collect()
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) and set(ids) <= set(texts)
    assert all(0 < r.taken <= 3 * r["size"] for r in got)
    assert not any(base_spans(r.text) for r in got)
    assert len({r.text for r in got}) == len(got)
