"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without blanks at its ends, in ASCII lower case.
Keys of ``min_chars`` code points or more that ``min_docs`` documents or more
hold lose all their lines but those of the largest ``doc_id`` that holds them.

1. One pass over the texts gives, per key, how many documents hold it and the
   largest of their ids, summed up inside each task first.  Documents fall
   into batches by id, largest ids first.
2. The batches enter a store of runs (``LineRuns``).  A run is a table
   bucketed and sorted by the 128-bit key hash, so all runs are cut alike: a new
   batch meets them by merge joins without a shuffle.  Keys that no run holds
   become the batch's own run (its holder is final, as later batches have
   smaller ids); known keys only leave their count.  ``FANOUT`` runs of a level are
   compacted into one of the next, bucket by bucket.
3. Own runs and counts, summed per key, give the keys to drop and their holders.
4. The lines of such keys are found again in a second pass: a key that a large
   share of all lines has is looked up in a broadcast table (at most ``1 /
   HOT_SHARE`` keys), all others by a join on the key.  Each text gets the list
   of its keys to drop and is cut in the last pass.

Defined results: a null or empty text is one empty line; a null id is smaller
than all others, and its rows keep no line that others hold; rows that share
an id count as documents of their own, and all rows of the largest id keep
their lines; ids that are neither numbers nor dates form one batch; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwx.llm import bitmap
from tripwx.llm.store import _delete, cut
from tripwx.llm.text import U64, pieces, signed
from tripwx.session import scratch_path

BLANK = b" \t\n\x0b\x0c\r"
BATCHES = 8
FANOUT = 4
HOT_SHARE = 1 / 4096
HELD_KEYS = 1 << 17                 # keys a task sums up before it hands them on
KEY = ["h", "g"]


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit hash of each line's key, None for keys that are too short."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(BLANK).lower()
        long = len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode()) >= min_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(keys), U64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _summed(kind, min_chars):
    """batch, h, g, docs, last: per batch and key of the task's texts, how
    many hold it and their largest id; in several rows if the task sees many keys."""
    id_type = T._parse_datatype_string(kind)

    def rows(found):
        from pyspark.sql.pandas.types import to_arrow_type
        h, g = _halves([key for _, key in found])
        docs, last = zip(*found.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in found], pa.int32()), signed(h), signed(g), pa.array(docs, pa.int64()),
             pa.array(last, to_arrow_type(id_type))], ["batch", *KEY, "docs", "last"])

    def run(batches):
        found: dict = {}
        for piece, data, off in pieces(batches):
            ids, places = piece.column(1).to_pylist(), piece.column(2).to_pylist()
            for t, (doc, batch) in enumerate(zip(ids, places)):
                for key in set(line_keys(data[off[t]:off[t + 1]].tobytes(), min_chars)) - {None}:
                    docs, last = found.get((batch, key), (0, None))
                    found[batch, key] = docs + 1, doc if last is None or (doc is not None and doc > last) else last
            if len(found) >= HELD_KEYS:
                yield rows(found)
                found = {}
        if found:
            yield rows(found)
    return run


class LineRuns:
    """The levelled store.  ``add`` takes batches of (h, g, docs, last), one
    row a key, bucketed as ``table`` does; every key is its own in one run."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[DataFrame]] = defaultdict(list)
        self.counts: list[DataFrame] = []

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.buckets, *KEY)

    def table(self, df: DataFrame, label: str, *partitions: str) -> DataFrame:
        """``df`` written in sorted buckets to the shared folder and read
        back.  Dropped when the driver ends."""
        name, path = f"tripwx_{label}_{uuid.uuid4().hex[:12]}", scratch_path(self.spark, f"llm-{label}")
        writer = df.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path)
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
        atexit.register(_forget, self.spark, name, path)
        return self.spark.table(name)

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-joins the runs: keys none of them holds are the batch's
        own run, the others leave their count."""
        runs = [run for level in self.levels.values() for run in level]
        met = batch
        for i, run in enumerate(runs):
            met = met.join(run.select(*KEY, F.lit(True).alias(f"in{i}")), KEY, "left")
        known = F.coalesce(*[F.col(f"in{i}") for i in range(len(runs))], F.lit(False))
        written = self.table(met.select(*KEY, "docs", "last", known.alias("known")), "run", "known")
        if runs:
            self.counts.append(written.filter("known").drop("known"))
        self.levels[0].append(written.filter("not known").drop("known"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self.table(self._merge(self.levels.pop(level)), "level")
            level += 1
            self.levels[level].append(merged)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def totals(self) -> DataFrame:
        """h, g, docs, last of every key that was ever added."""
        return self._merge([run for level in self.levels.values() for run in level] + self.counts)


def _forget(spark: SparkSession, name: str, path: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    except Exception:       # the session has ended, and its catalog with it
        pass
    _delete(spark, path)


def _batch_of(docs: DataFrame, batches: int):
    """The number of a row's batch: largest ids first, null ids last, equal
    ids together.  The driver gets ``batches`` - 1 ids."""
    last = F.lit(0)
    if isinstance(docs.schema["doc_id"].dataType, (T.NumericType, T.DateType, T.TimestampType)) and batches > 1:
        shares = [k / batches for k in range(1, batches)]
        bounds = docs.agg(F.percentile_approx("doc_id", shares)).first()[0]
        for bound in sorted(set(bounds or [])):
            last = last + F.coalesce(F.col("doc_id") <= F.lit(bound), F.lit(True)).cast("int")
    return last.cast("int")


def _suspects(words, hot, min_chars):
    """doc_id, th, h, g of the lines whose key may be one to drop; keys of the
    broadcast table are left to the last pass."""
    def run(batches):
        for piece, data, off in pieces(batches):
            owner, keys = [], []
            for t in range(len(off) - 1):
                own = set(line_keys(data[off[t]:off[t + 1]].tobytes(), min_chars)) - {None}
                own = [key for key in own if key not in hot.value]
                owner += [t] * len(own)
                keys += own
            h, g = _halves(keys)
            some = np.flatnonzero(bitmap.holds(words.value, h))
            at = pa.array(np.array(owner, np.int64)[some])
            yield pa.RecordBatch.from_arrays(
                [piece.column(1).take(at), piece.column(2).take(at), signed(h[some]), signed(g[some])],
                ["doc_id", "th", *KEY])
    return run


def _cut_lines(hot, min_chars):
    """doc_id, kept, n_lines, n_dropped of texts with their keys to drop."""
    def run(batches):
        for piece, data, off in pieces(batches):
            kept, lines, dropped = [], [], []
            ids, gone = piece.column(1).to_pylist(), piece.column(2)
            stop = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(gone), 0).to_numpy())])
            pairs = np.stack([gone.flatten().field(k).to_numpy() for k in range(2)], 1)
            for t, doc in enumerate(ids):
                text = data[off[t]:off[t + 1]].tobytes()
                drop = {pair.tobytes() for pair in pairs[stop[t]:stop[t + 1]]}
                stay = [line for line, key in zip(text.split(b"\n"), line_keys(text, min_chars))
                        if key is None or not (key in drop or hot.value.get(key, doc) != doc)]
                kept.append(b"\n".join(stay))
                lines.append(text.count(b"\n") + 1)
                dropped.append(lines[-1] - len(stay))
            yield pa.RecordBatch.from_arrays(
                [piece.column(1), pa.array(kept, pa.binary()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                ["doc_id", "kept", "n_lines", "n_dropped"])
    return run


def repeated_keys(docs: DataFrame, min_docs: int, min_chars: int, batches: int, fanout: int) -> tuple[DataFrame, int]:
    """h, g, docs, last of the keys to drop, and how many (text, key) pairs
    of any key there are."""
    store = LineRuns(docs.sparkSession, fanout)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("text").cast("binary").alias("t"), "doc_id", _batch_of(docs, batches).alias("batch"))
    parts = store.dealt(texts.mapInArrow(_summed(kind, min_chars), f"batch int, h bigint, g bigint, docs bigint, last {kind}"))
    keys = parts.groupBy(*KEY, "batch").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
    keys = store.table(keys, "keys", "batch")
    sizes = {r.batch: r.n for r in keys.groupBy("batch").agg(F.sum("docs").alias("n")).collect()}   # one row a batch
    for batch in sorted(sizes):
        store.add(keys.filter(F.col("batch") == batch).drop("batch"))
    if not sizes:
        return keys.drop("batch"), 0
    return cut(store.totals().filter(F.col("docs") >= min_docs), "repeated"), sum(sizes.values())


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = BATCHES,
                fanout: int = FANOUT) -> DataFrame:
    """doc_id, kept (the text without its repeated lines), n_lines (before)
    and n_dropped, for every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    repeated, pairs = repeated_keys(docs, min_docs, min_chars, batches, fanout)
    # at most 1 / HOT_SHARE keys can have that share of all pairs
    least = max(min_docs, pairs * HOT_SHARE)
    rows = repeated.filter(F.col("docs") >= least).collect()
    hot = spark.sparkContext.broadcast({np.array([r.h, r.g]).tobytes(): r["last"] for r in rows})
    cold = repeated.filter(F.col("docs") < least)
    words = spark.sparkContext.broadcast(bitmap.build(cold, "h"))
    texts = docs.select(F.col("text").cast("binary").alias("t"), "doc_id", F.xxhash64("text").alias("th"))
    found = texts.mapInArrow(_suspects(words, hot, min_chars), f"doc_id {kind}, th bigint, h bigint, g bigint")
    found = found.join(cold.select(*KEY, "last"), KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    # a text's list is no longer than the text
    lists = found.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    joined = texts.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    out = joined.select("t", "doc_id", "gone").mapInArrow(
        _cut_lines(hot, min_chars), f"doc_id {kind}, kept binary, n_lines bigint, n_dropped bigint")
    return out.withColumn("kept", F.col("kept").cast("string"))
