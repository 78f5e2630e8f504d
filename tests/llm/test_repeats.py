"""Rows that repeat, ids that many rows share, and phrases that many items share."""

import collections
import os
import random
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from tripwx.llm import decontam, jaccard_join, mixing, quality  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string"


def mixed(spark, rows):
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, DOCS), "").collect()
    taken, target = collections.Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
    return out, taken, target


def test_four_equal_rows_keep_to_the_budget(spark):
    """Four rows alike, one other web row, one books row: web's target holds."""
    rows = [(1, "a b c", "en", "web")] * 4 + [(2, "d e f", "en", "web"), (3, "g h i", "en", "books")]
    out, taken, target = mixed(spark, rows)
    assert {s: abs(taken[s] - round(t)) for s, t in target.items()} == {"web": 0, "books": 0}
    assert all(0 < r.taken <= 3 * 3 for r in out)


def test_any_repetition_keeps_to_the_budget(spark):
    """Whatever repeats, a stage takes just what the mix takes, row by row."""
    rng = random.Random(12)
    for _ in range(3):
        rows = [(rng.randrange(4), rng.choice(["one two", "three", "four five six", None, ""]), "en", rng.choice(["a", "b", None]))
                for _ in range(60)]
        out, taken, target = mixed(spark, rows)
        plain = mixing.mix(spark.createDataFrame(rows, DOCS).withColumn(
            "doc_id", F.struct(F.lit(False).alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))))
        want = collections.Counter((r.doc_id.id, r.source, r["size"], r.taken) for r in plain.collect() if r.taken)
        assert collections.Counter((r.doc_id, r.source, r["size"], r.taken) for r in out) == want


def test_equal_rows_are_spread_by_the_mix(spark):
    """A third of all rows are one row: its running totals go on over partitions."""
    rows = [(7, "x y", "en", "web")] * 200 + [(i, "x " * (i % 9), "en", "web") for i in range(400)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(6)).collect()
    total = sum(r["size"] for r in out)
    assert len(out) == 600 and sum(r.taken for r in out) == round(out[0].target) == total


def test_near_duplicates_of_one_key(spark):
    """One id and text in very many rows: one row stays, the least; other columns stay together."""
    text = "a text of quite a few words that is here in many rows at once"
    rows = [(5, text, None, f"s{i % 7}") for i in range(300)] + [(None, None, "x", "y")] * 50 + [(6, "another text", "en", "web")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), "").collect()
    assert sorted((tuple(r) for r in out), key=str) == sorted([(5, text, None, "s0"), (None, None, "x", "y"), (6, "another text", "en", "web")], key=str)


def test_training_rows_are_bounded(spark, monkeypatch):
    """Very many rows of one labelled id do not grow what the driver gets."""
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y: seen.append(len(y)))
    docs = spark.createDataFrame([(1, f"row {i} of the same id") for i in range(3000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    quality.fit(docs, labels, train_rows=10)
    assert seen == [10]


def test_shared_opening_makes_no_pairs(spark):
    """300 items share their first seven words, 400 texts hold those: the
    join of rarer seeds makes no pair; true copies of items are still found."""
    rng = random.Random(3)
    opening = "which of the following statements is true"
    words = [f"w{i}" for i in range(3000)]
    items = [(i, opening + " " + " ".join(rng.sample(words, 25))) for i in range(300)]
    texts = [(i, " ".join(rng.sample(words, 30)) + " " + opening + " " + " ".join(rng.sample(words, 30))) for i in range(400)]
    texts += [(1000 + i, "before it " + items[i][1] + " after it") for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = []

    def counted(found, seeds, pairs, real=decontam.shared_seeds):
        out = real(found, seeds, pairs)
        rows.append(out.count())
        return out
    keep, decontam.shared_seeds = decontam.shared_seeds, counted
    try:
        got = {r.doc_id: r["items"] for r in decontam.leaked(docs, benchmark).collect()}
    finally:
        decontam.shared_seeds = keep
    assert got == {1000 + i: [i] for i in range(5)} and rows == [5]


def test_leader_of_a_large_group(spark, monkeypatch):
    """A group of many cells: links to the leader and among the rest are the
    same as in one cell."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one = {r.doc_id: r.component_id for r in jaccard_join.join_components(docs, 3, 80, 100).collect()}
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", 16)
    many = {r.doc_id: r.component_id for r in jaccard_join.join_components(docs, 3, 80, 100).collect()}
    assert one == many


def test_spans_of_very_many_matches(spark):
    """Offsets over many chunks; the cost of a text does not grow with the square of its matches."""
    import time

    from tripwx.llm import pii
    took = []
    for n in (4000, 16_000):
        text = " ".join(f"u{i}@x{'é' * (i % 3)}.org" if i % 3 == 0 else f"a{i}@example.org" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        began = time.time()
        row = pii.find(docs).first()
        took.append(time.time() - began)
        mails = [x for x in row.pii if x.kind == "email"]
        assert all(text[x.start:x.end] == x.match for x in mails) and len(mails) > n // 2
    assert took[1] < 12 * took[0]


def test_a_lost_conversation_is_caught(spark, monkeypatch):
    """If escaping did not restore a text, formatting stops, or marks the row."""
    import pytest
    from pyspark.errors import PySparkException

    from tripwx.llm import chat_format
    monkeypatch.setattr(chat_format, "escape", lambda c: c)
    turns = spark.createDataFrame([(1, 0, "user", "a </s> b"), (2, 0, "user", "fine")], "conv_id int, turn int, role string, text string")
    turns = turns.withColumns({c: F.lit(9) for c in ("_role", "_end", "out", "same")})
    assert {r.conv_id: r.same for r in chat_format.format_conversations(turns, strict=False).collect()} == {1: False, 2: True}
    with pytest.raises(PySparkException, match="lost in its formatted text: 1"):
        chat_format.digest(chat_format.format_conversations(turns)).collect()


def test_near_copies_open_few_groups(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(300):
        words = list(base)
        for at in rng.sample(range(60), 2):
            words[at] = f"v{rng.randrange(3)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    opened = []

    def cut(df, label, write=jaccard_join.cut):
        out = write(df, label)
        if label == "opens":
            opened.append(out.count())
        return out
    monkeypatch.setattr(jaccard_join, "cut", cut)
    found = {r.doc_id: r.component_id for r in jaccard_join.join_components(df, 3, 80, 100).collect()}
    sets = [{tuple(w[i:i + 3]) for i in range(58)} for w in map(str.split, texts)]
    part = list(range(300))
    for _ in range(300):                         # least id reachable, to a fixed point
        new = [min(part[j] for j in range(300) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in range(300)]
        if new == part:
            break
        part = new
    assert found == dict(enumerate(part))
    # looks at a group: with a cluster's groups they would grow with the square of its size
    assert opened[0] < 6 * len(set(texts)), opened
