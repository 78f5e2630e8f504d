"""Language identification by interpolated Kneser-Ney character models.

A text becomes its letters in lower case, with one blank for every run of
other characters.  Each language has an order-``ORDER`` model of code points
with interpolated Kneser-Ney smoothing: raw counts at the highest order,
continuation counts (distinct left neighbours) below, one absolute discount
per order, uniform over ``ALPHABET`` symbols at the bottom.  A context is up to
three code points of 21 bits; n-grams and contexts are stored as sorted 64-bit
hashes, searched for whole batches of distinct n-grams at a time.

The language with the lowest cross-entropy per character wins.  Two
calibrations use training texts kept from the counts: a temperature turns
entropies into probabilities, and a text whose best cross-entropy is beyond
nearly all of that language's own calibration texts is marked rejected.

Every language with a training text is learned, from at most ``TRAIN_DOCS``
whole texts (the least by a hash), as many as fit into ``TRAIN_CHARS``
characters, and one at least.  A language whose few texts would all be kept for
calibration learns from them instead.  Models are built and broadcast for
``GROUP`` languages at a time; with more languages the texts are read once per
group, and each text's best languages are compared over the groups.

Defined results: a null text or one without a letter is ``und`` with score
0 and rejected; so is every text if nothing could be learned; ties go to the
first language in code-point order; rows with a null language teach nothing;
rows alike in id, language and text teach once; repeated rows are repeated
results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwx.llm.store import cut
from tripwx.llm.text import U64, mix, pieces

ORDER = 4                   # a context of three code points packs into 63 bits
TRAIN_DOCS = 1500
TRAIN_CHARS = 1 << 24
GROUP = 64
BROADCAST_ROWS = 1 << 18    # narrow rows that name the training texts
SLICES = 64
CALIBRATION_PARTS = 5
REJECT_QUANTILE = 0.995
SCALES = 2.0 ** np.arange(-1, 7, 0.5)
ALPHABET = 1 << 16
BITS = 21
UNDETERMINED = "und"
#: Blocks of spaces, marks and punctuation beyond ASCII: first and last code point.
SEPARATORS = [(0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x206F),
              (0x3000, 0x3004), (0x3008, 0x3020), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFFFC, 0xFFFD)]


def _letters() -> np.ndarray:
    """Which of the first 2**16 code points are part of words."""
    table = np.ones(1 << 16, bool)
    table[:128] = False
    table[97:123] = True
    for first, last in SEPARATORS:
        table[first:last + 1] = False
    return table


LETTERS = _letters()


def normal(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts' normal forms, each with a blank before and
    after, and the first place of each."""
    n = len(off) - 1
    texts = [data[a:b].tobytes().decode("utf-8", "replace").lower() for a, b in zip(off[:-1], off[1:])]
    plain = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    body = LETTERS[np.minimum(plain, 0xFFFF)] | (plain > 0xFFFF)
    gap = ~body
    before = np.zeros(len(plain) + 1, bool)
    before[1:] = gap
    before[first] = True                       # a text's start stands for a blank
    keep = body | (gap & ~before[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])[first]
    out = np.full(kept[-1] + 2 * n, 32, np.int64)
    begin = kept + 2 * np.arange(n + 1)
    out[np.arange(kept[-1]) + 2 * np.repeat(np.arange(n), np.diff(kept)) + 1] = np.where(body, plain, 32)[keep]
    return out, begin


def grams(stream: np.ndarray, begin: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per character but each text's first: the ``order`` - 1 code points
    before it, the latest in the lowest bits, 0 before the text; the character;
    and each text's first n-gram."""
    n = len(stream)
    place = np.arange(n) - np.repeat(begin[:-1], np.diff(begin))
    context = np.zeros(n, np.int64)
    for k in range(1, order):
        back = np.zeros(n, np.int64)
        back[k:] = stream[:-k]
        back[place < k] = 0
        context |= back << (BITS * (k - 1))
    return context[place > 0], stream[place > 0], begin - np.arange(len(begin))


def _key(context: np.ndarray, char: np.ndarray) -> np.ndarray:
    return mix(mix(context.astype(U64)) + char.astype(U64) * U64(0x9E3779B97F4A7C15))


def _low(context: np.ndarray, chars: int) -> np.ndarray:
    """The latest ``chars`` code points of a context."""
    return context & ((1 << (BITS * chars)) - 1)


def _count(order):
    def run(batches):
        for rows, data, off in pieces(batches):
            context, char, at = grams(*normal(data, off), order)
            lang = np.repeat(np.array(rows.column(1).to_pylist(), object), np.diff(at))
            frame = pd.DataFrame({"lang": lang, "context": context, "char": char}).groupby(["lang", "context", "char"]).size()
            levels = [frame.index.get_level_values(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(levels[0].astype(object), pa.string()), pa.array(levels[1].to_numpy(np.int64)),
                 pa.array(levels[2].to_numpy(np.int64)), pa.array(frame.to_numpy(np.int64))],
                ["lang", "context", "char", "c"])
    return run


def _sums(keys: np.ndarray, values: np.ndarray):
    """Sorted distinct keys, where each stood first, and the sum of their values."""
    keys, first, group = np.unique(keys, return_index=True, return_inverse=True)
    return keys, first, np.bincount(group, values, len(keys))


def kneser_ney(context: np.ndarray, char: np.ndarray, count: np.ndarray, order: int) -> list:
    """Per order, lowest first: (n-gram hashes, own share, context hashes, rest)."""
    levels = []
    for n in range(order, 0, -1):
        size = count.astype(float)
        ones, twos = (size == 1).sum(), (size == 2).sum()
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        name = mix(context.astype(U64))
        contexts, _, total = _sums(name, size)
        _, _, kinds = _sums(name, np.ones(len(size)))
        share = (size - discount) / total[np.searchsorted(contexts, name)]
        key = _key(context, char)
        sort = np.argsort(key)
        levels.append((key[sort], share[sort], contexts, discount * kinds / total))
        if n > 1:                                # continuation counts: distinct left neighbours
            context = _low(context, n - 2)
            _, first, count = _sums(_key(context, char), np.ones(len(char)))
            context, char = context[first], char[first]
    return levels[::-1]


def _find(table, keys):
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def log2(levels: list, context: np.ndarray, char: np.ndarray) -> np.ndarray:
    """log2 P(char | context) of distinct n-grams."""
    p = np.full(len(char), 1 / ALPHABET)
    for n, (keys, share, contexts, rest) in enumerate(levels):
        short = _low(context, n)
        at, seen = _find(contexts, mix(short.astype(U64)))
        own, found = _find(keys, _key(short, char))
        p = np.where(seen, np.where(found, share[own], 0.0) + rest[at] * p, p)
    return np.log2(p)


def entropies(models: list, data: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Cross-entropy in bits per character: one row per text, one column per model."""
    context, char, at = grams(*normal(data, off), order)
    code, _ = pd.factorize(_key(context, char))
    first = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    context, char = context[first], char[first]
    size = np.diff(at)
    out = np.zeros((len(size), len(models)))
    for j, levels in enumerate(models):
        out[:, j] = -np.add.reduceat(log2(levels, context, char)[code], at[:-1]) / size
    return out


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _lettered(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII one are decoded."""
    lower = data | 32
    ascii_ = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])[off]
    out = np.diff(ascii_) > 0
    for i in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[i] = has_letter(data[off[i]:off[i + 1]].tobytes())
    return out


def log_sums(h: np.ndarray) -> np.ndarray:
    """ln sum of exp(-scale * entropy) over the columns, per row and scale."""
    least = h.min(axis=1)
    return np.stack([np.log(np.exp(-s * (h - least[:, None])).sum(axis=1)) - s * least for s in SCALES], 1)


def _judged(models, languages, order):
    """id, best, h, own, sums per text: the group's best language and its
    entropy, that of the text's own language (if the group has it), and the log sums."""
    place = {lang: j for j, lang in enumerate(languages)}

    def run(batches):
        for rows, data, off in pieces(batches):
            some = _lettered(data, off)
            h = entropies(models.value, data, off, order)
            best = h.argmin(axis=1)
            own = [h[i, place[lang]] if lang in place else None for i, lang in enumerate(rows.column(2).to_pylist())]
            out = pa.RecordBatch.from_arrays(
                [rows.column(1), pa.array([languages[b] for b in best.tolist()], pa.string()), pa.array(h.min(axis=1)),
                 pa.array(own, pa.float64()), pa.array(log_sums(h).tolist(), pa.list_(pa.float64()))],
                ["id", "best", "h", "own", "sums"])
            yield out.filter(pa.array(some))
    return run


JUDGED = "best string, h double, own double, sums array<double>"


def judged(texts: DataFrame, groups: list, order: int) -> DataFrame:
    """(id, best, h, own, sums) over all groups of (languages, models), of
    the rows (t, id, lang) that have a letter; with several groups ``id`` must
    be the row's own number."""
    kind = dict(texts.dtypes)["id"]
    parts = [texts.mapInArrow(_judged(models, languages, order), f"id {kind}, {JUDGED}") for languages, models in groups]
    if len(parts) == 1:
        return parts[0]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # one row per text and group; ties go to the first language
    return rows.groupBy("id").agg(
        F.min(F.struct("h", "best")).alias("top"), F.max("own").alias("own"),
        *[F.max(F.col("sums")[i]).alias(f"m{i}") for i in range(len(SCALES))],
        F.collect_list("sums").alias("all")).select(
        "id", F.col("top.best").alias("best"), F.col("top.h").alias("h"), "own",
        F.array(*[_joint(i) for i in range(len(SCALES))]).alias("sums"))


def _joint(i: int) -> Column:
    """ln of the sum of all groups' sums at scale i; m<i> is the largest."""
    return F.col(f"m{i}") + F.log(F.aggregate("all", F.lit(0.0), lambda acc, s: acc + F.exp(s[i] - F.col(f"m{i}"))))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def training_rows(labelled: DataFrame, train_docs: int, train_chars: int) -> DataFrame:
    """(t, lang, learn): the bounded sample of every language."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", "lang", F.xxhash64("doc_id", "lang", "text").alias("h"), F.length("text").cast("long").alias("chars"))
    # ranked inside slices of a language first: a frequent language is no single task's work
    ids = rows.groupBy("lang", "h").agg(F.min("chars").alias("chars"))
    for slice_ in ([F.pmod("h", F.lit(SLICES))], []):
        rank = Window.partitionBy("lang", *slice_).orderBy("h")
        ids = ids.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= train_docs)
    upto = F.sum("chars").over(Window.partitionBy("lang").orderBy("h"))
    ids = ids.withColumn("upto", upto).filter((F.col("upto") <= train_chars) | (F.col("r") == 1))
    kept_back = F.pmod("h", F.lit(CALIBRATION_PARTS)) == 0
    none_left = F.min(kept_back.cast("int")).over(Window.partitionBy("lang")) == 1
    ids = cut(ids.select("lang", "h", (~kept_back | none_left).alias("learn")), "training-ids")
    small = ids.count() <= BROADCAST_ROWS
    sample = rows.select("text", "lang", "h").join(F.broadcast(ids) if small else ids, ["lang", "h"])
    return sample.groupBy("lang", "h", "learn").agg(F.first("text").alias("text")).select(
        F.col("text").cast("binary").alias("t"), "lang", "learn")


def fit(labelled: DataFrame, order: int = ORDER, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS, group: int = GROUP):
    """(groups, scale, limits) from (text, lang, doc_id) rows: groups of
    (languages, broadcast models), the temperature, and the largest accepted
    entropy by language."""
    spark = labelled.sparkSession
    sample = cut(training_rows(labelled, train_docs, train_chars), "training")
    counts = sample.filter("learn").select("t", "lang").mapInArrow(_count(order), "lang string, context bigint, char bigint, c bigint")
    counts = cut(counts.groupBy("lang", "context", "char").agg(F.sum("c").alias("c")), "grams")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    groups = []
    for a in range(0, len(languages), group):                # one group's counts on the driver at a time
        some = languages[a:a + group]
        found = counts.filter(F.col("lang").isin(some)).toArrow().to_pandas()
        parts = {lang: part.sort_values(["context", "char"]) for lang, part in found.groupby("lang")}
        models = [kneser_ney(*(parts[lang][c].to_numpy(np.int64) for c in ("context", "char", "c")), order) for lang in some]
        groups.append((some, spark.sparkContext.broadcast(models)))
    if not groups:
        return [], 1.0, {}
    check = cut(sample.filter("NOT learn").select("t", "lang").withColumn("id", F.monotonically_increasing_id()), "calibration")
    rows = judged(check.select("t", "id", "lang"), groups, order).join(check.select("id", "lang"), "id")
    fits = [F.avg(F.col("sums")[i] + F.lit(float(s)) * F.col("own")).alias(f"l{i}") for i, s in enumerate(SCALES)]
    loss = rows.agg(*fits).first()                            # one number per scale
    scale = 8.0 if loss[0] is None else float(min(zip(loss, SCALES))[1])
    limits = {r.lang: r.limit for r in rows.groupBy("lang").agg(
        F.percentile("own", F.lit(REJECT_QUANTILE)).alias("limit")).collect()}       # at most train_docs rows a language
    return groups, scale, limits


def identify(docs: DataFrame, parts: int = 5, part: int = 0, order: int = ORDER, group: int = GROUP) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row, learned
    from the rows outside the held-out part."""
    spark = docs.sparkSession
    out = held_out(F.col("doc_id"), parts, part)
    groups, scale, limits = fit(docs.filter(~out).select("text", "lang", "doc_id"), order, group=group)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    if not groups:
        return texts.select("doc_id", out.alias("held_out"), F.lit(UNDETERMINED).alias("lang_pred"),
                            F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    texts = texts.withColumn("id", F.monotonically_increasing_id())
    if len(groups) == 1:
        return _predicted(texts, groups[0], scale, limits, order).select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
    texts = cut(texts, "texts")                               # the row numbers must hold over the passes
    found = judged(texts.select("t", "id", F.lit(None).cast("string").alias("lang")), groups, order)
    at = int(np.flatnonzero(SCALES == scale)[0]) if scale in SCALES else 0
    bound = spark.createDataFrame([*limits.items()] or [], "best string, bound double")     # one row a language
    rows = texts.select("doc_id", "id").join(found, "id", "left").join(bound, "best", "left")
    score = F.exp(-F.lit(scale) * F.col("h") - F.col("sums")[at])
    return rows.select("doc_id", out.alias("held_out"), F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"),
                       F.coalesce(score, F.lit(0.0)).alias("score"),
                       (F.col("best").isNull() | F.coalesce(F.col("h") > F.col("bound"), F.lit(False))).alias("rejected"))


def confidence(h: np.ndarray, scale: float) -> np.ndarray:
    """Probability of the best column: a softmax of -scale * entropy."""
    z = -scale * (h - h.min(axis=1, keepdims=True))
    return 1 / np.exp(z).sum(axis=1)


def _predicted(texts: DataFrame, group, scale: float, limits: dict, order: int) -> DataFrame:
    """All languages in one pass: doc_id, lang_pred, score and rejected."""
    languages, models = group
    bounds = np.array([limits.get(lang, np.inf) for lang in languages])

    def run(batches):
        for rows, data, off in pieces(batches):
            some = _lettered(data, off)
            h = entropies(models.value, data, off, order)
            best = h.argmin(axis=1)
            far = ~some | (h.min(axis=1) > bounds[best])
            names = [languages[b] if s else UNDETERMINED for b, s in zip(best.tolist(), some.tolist())]
            score = np.where(some, confidence(h, scale), 0.0)
            yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(far)],
                                             ["doc_id", "lang_pred", "score", "rejected"])
    kind = dict(texts.dtypes)["doc_id"]
    return texts.select("t", "doc_id").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
