"""Every operator and stage on nulls, empty and very long texts, ties,
repeated rows, empty tables and columns whose names clash with its own."""

import hashlib
import sys
import os

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from tripwx.llm import (ann, chat_format, decontam, jaccard_join, language_id, license_scan, mixing,  # noqa: E402
                        pii, quality, suffix_tree)

CLEAN = "the quick brown fox jumps over the lazy dog while seven wizards watch from an old stone tower"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
RUN = "a" * 150_000
ROWS = [
    (1, CLEAN, "en", "web"), (2, CLEAN, "en", "web"), (2, CLEAN, "en", "web"), (3, None, "en", "web"),
    (4, "", None, None), (5, " \n\t ", "en", "books"), (None, CLEAN + " again", "en", "books"), (6, "Hi", "en", None),
    (7, LONG, "en", "web"), (8, RUN, "xx", "web"), (9, "1" * 100_000, "en", "books"), (10, "été à la plage", "fr", "books"),
    (11, "mail bob@example.com or +1 415 555 0123 and pay with card 4111 1111 1111 1111", "en", "web"),
    (11, "another text under the same id, quite different from the first one in all respects", "en", "web"),
    (12, "12345 !!! ???", "en", "web"), (13, LONG + " more", "en", "web"),
]
EXTRA = ["size", "row", "_key", "t", "pii", "lo", "n", "g", "_pii_x", "_once", "score"]
DOCS = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(c) for c in EXTRA}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, None), (6, 0, 0), (None, 1, 0), (7, None, 0), (12, 0, 1), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_licences(docs, none):
    rows = license_scan.scan(docs).collect()
    assert len(rows) == len(ROWS) and all(r.licences == [] for r in rows)
    assert license_scan.scan(none).count() == 0


def test_pii(docs, none):
    rows = pii.digest(pii.find(docs)).collect()
    assert len(rows) == len(ROWS)
    full = [r for r in rows if r.n_email]
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in full] == [(1, 0, 1, 1)]
    assert sum(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows) == len(ROWS) - 1
    out = pii.redact(docs)
    assert out.columns == docs.columns
    texts = [r.text for r in out.collect()]
    assert None in texts and RUN in texts and LONG in texts
    assert "mail [EMAIL] or [PHONE] and pay with card [CARD]" in texts
    assert pii.redact(none).count() == 0 and pii.find(none).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)
    assert mixing.mix(none).count() == 0


def test_jaccard(docs, none):
    rows = jaccard_join.join_components(docs, 3, 90, 100).collect()
    assert len(rows) == len(ROWS)
    comp = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id not in (None, 11)}
    assert comp[1][1] == comp[2][1] == 1 and comp[7][1] == comp[13][1] == 7
    assert comp[3] == (0, 3) and comp[4] == (0, 4) and comp[5] == (0, 5) and comp[6] == (1, 6)
    assert [r.component_id for r in rows if r.doc_id is None] == [1]
    assert sorted(r.component_id for r in rows if r.doc_id == 11) == [11, 11]
    assert jaccard_join.join_components(none, 3, 90, 100).count() == 0


def test_decontamination(spark, docs, none):
    items = [(1, "quick brown fox jumps over the lazy dog while seven wizards"), (2, None), (3, ""), (4, "Hi"),
             (None, CLEAN), (5, "words that no document of the table has anywhere at all"),
             (1, "quick brown fox jumps over the lazy dog while seven wizards")]
    bench = spark.createDataFrame(items, "item_id int, text string").withColumn("doc_id", F.lit(0))
    got = sorted(((r.doc_id, r["items"]) for r in decontam.leaked(docs, bench).collect()), key=str)
    assert got == sorted([(1, [1]), (2, [1]), (2, [1]), (None, [1]), (6, [4])], key=str)
    assert decontam.leaked(none, bench).count() == 0
    assert decontam.leaked(docs, bench.limit(0)).count() == 0


def test_suffix_tree(docs, none):
    rows = suffix_tree.score(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score <= 1e-9 and r.base_score < 0 for r in rows)
    assert suffix_tree.score(none).count() == 0


def test_quality(docs, none, labels):
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_language(docs, none):
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(ROWS)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5, 9, 12}
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(none).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "a [INST] b"), (1, 1, "assistant", r"<\/s> and </s>"), (1, 1, "assistant", None),
            (1, None, None, "first"), (None, 0, "user", ""), (2, 0, "assistant", r"x\[\\INST]" + "y" * 100_000), (2, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("t", F.lit(1))
    out = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    assert all(r.same for r in out.values()) and len(out) == 3
    told = {r.conv_id: r for r in chat_format.digest(chat_format.format_conversations(df)).collect()}
    assert told[1].n_turns == 4 and told[1].loss_chars == len(r"<\/s> and </s>")
    one = out[1]
    text = "".join(chat_text(one.formatted[s.start:s.end]) for s in one.loss_spans)
    assert text == r"<\/s> and </s>"
    plain = "user\n" + "hello\n"
    simple = spark.createDataFrame([(7, 0, "user", "hello")], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.digest(chat_format.format_conversations(simple)).first().turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def chat_text(escaped):
    import re
    return re.sub(r"([\[<])\\(\\*)(INST\]|/INST\]|/s>)", r"\1\2\3", escaped)


def test_ann(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (10, []), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (100, [0.0, 0.0]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("q", F.lit("x"))
    got = [tuple(r) for r in ann.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert [(g[0], g[1], g[2]) for g in got] == [(0, 1, 3), (0, 2, 50), (0, 3, 4), (0, 4, 4), (50, 1, 0), (50, 2, 3), (50, 3, 4), (50, 4, 4)]
    assert got[0][3] == 1.0
    assert ann.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, labels, tmp_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    labels.write.mode("overwrite").parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, "under the same id, quite different from the first one")], "item_id int, text string").write.mode(
        "overwrite").parquet(f"{tmp_dir}/benchmark.parquet")
    out = stage(spark, docs, tmp_dir)
    rows = out.collect()
    if name == "mixing":
        assert out.columns[:len(docs.columns)] == docs.columns and {"taken", "target"} <= set(out.columns)
        assert {r.doc_id for r in rows} <= {r[0] for r in ROWS}
    else:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    ids = [r.doc_id for r in rows]
    if name == "near_duplicates":
        assert ids.count(1) == 1 and 2 not in ids and None not in ids and ids.count(11) == 2 and 13 not in ids
        assert {3, 4, 5} <= set(ids)
    if name == "decontamination":
        assert ids.count(11) == 1 and len(ids) == len(ROWS) - 1
    if name == "pii":
        assert len(ids) == len(ROWS) and [r.n_chars for r in rows if r.doc_id == 3] == [None]
    empty = stage(spark, none, tmp_dir)
    assert empty.count() == 0 and empty.columns == out.columns
