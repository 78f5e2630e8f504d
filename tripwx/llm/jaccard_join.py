"""Exact n-gram Jaccard self-join by a token-group matrix.

Documents are sets of word shingles; two link when
``den * |A & B| >= num * |A | B|``; the result is each document's connected
component.  Equal sets are one node.  The steps:

1. A fixed-size sketch of shingle counts fixes one global order, frequent
   shingles last.  Only a set's first ``n - ceil(num n / den) + DEEP``
   shingles (its head) take part in the search: two linked sets share
   ``DEEP`` shingles of both heads (all they have in common, if that is less).
2. Shingles in the heads of two nodes or more are the tokens.  A node's group
   is its least token by hash, of those at least half as frequent as its
   middle one, so similar nodes fall into one group, also in a large cluster;
   the matrix holds, per token, the groups whose members have it.  A node
   looks at a group only if their heads share ``DEEP`` tokens; nodes of one
   size with the same tokens ask the matrix once, together.
3. A cell stores the union of its members' shingles; a query opens it only if
   its overlap with that union reaches ``num / den`` of the query, and only
   then single members are counted, exactly.  A group of bounded size is one
   cell: its members and the nodes that look at it from other groups query it.
4. A larger group is many cells.  Its leader is first compared with every
   member (one row each); the members it links form the core, one component,
   whose inner pairs need no look.  The rest of the group and its visitors,
   in blocks, then meet the members, in blocks.
5. Components of the links found; inside a cell only links that join two
   components of the cell are passed on.

Defined results: a text without words is linked with nothing; with fewer
words than a shingle, all words are the one shingle; repeated rows are one
node; a null id stands in no minimum (a component of null ids has a null id);
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwx.llm import bitmap
from tripwx.llm.graph import components
from tripwx.llm.store import cut
from tripwx.llm.text import LOWER, SPACE, U64, buffers, edges, mix, pieces, shingles, signed, word_hashes

SKETCH_BITS = 20
SKETCH_ROW = 1 << 12
DEEP = 6
CELL_ROWS = 512
CELL_BYTES = 8 << 20
_REST = U64(64 - SKETCH_BITS)
_LOW = U64((1 << (64 - SKETCH_BITS)) - 1)


def _sets(data, off, size, rank=None):
    """Per text the sorted distinct shingle keys: (keys, first of each text)."""
    data = LOWER[data]
    start, end, first = edges(data, off, SPACE[data])
    keys, at = shingles(word_hashes(data, start, end), first, size)
    if rank is not None:
        keys = (rank[(keys >> _REST).astype(np.int64)].astype(U64) << _REST) | (keys & _LOW)
    for a, b in zip(at[:-1], at[1:]):
        keys[a:b].sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    fresh[at[:-1][at[:-1] < len(keys)]] = True
    return keys[fresh], np.concatenate([[0], np.cumsum(fresh)])[at]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return run[at[1:]] - run[at[:-1]]


def _names(keys, at):
    """A 128-bit name of each set, independent of its order."""
    return _sums(mix(keys ^ U64(0xA5A5A5A5A5A5A5A5)), at), _sums(mix(keys + U64(0x1234567)), at)


def _count(size):
    """The task's sketch, in rows of SKETCH_ROW counters."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for _, data, off in pieces(batches):
            keys, _ = _sets(data, off, size)
            total += np.bincount((keys >> _REST).astype(np.int64), minlength=len(total))
        parts = total.reshape(-1, SKETCH_ROW)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)),
                                          pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])
    return run


def _add(batches):
    """Sums of equal parts, one row each; a partition holds a few parts."""
    total: dict = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            total[part] = total.get(part, 0) + np.frombuffer(raw, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([v.tobytes() for v in total.values()], pa.binary())], ["part", "counts"])


def shingle_order(texts: DataFrame, size: int) -> np.ndarray:
    """Rank of each of the 2**20 sketch slots by how many sets use it.
    The driver gets one counter per slot."""
    kind = "part int, counts binary"
    rows = texts.mapInArrow(_count(size), kind).repartition("part").mapInArrow(_add, kind).toArrow()
    counts = np.zeros((1 << SKETCH_BITS) // SKETCH_ROW * SKETCH_ROW, np.int64).reshape(-1, SKETCH_ROW)
    for part, raw in zip(rows["part"].to_pylist(), rows["counts"].to_pylist()):
        counts[part] = np.frombuffer(raw, np.int64)
    rank = np.empty(counts.size, np.uint32)
    rank[np.argsort(counts.ravel(), kind="stable")] = np.arange(counts.size, dtype=np.uint32)
    return rank


def _heads(size, num, den, rank):
    """id, n, lo, hi, head: the head only once per set and task."""
    def run(batches):
        seen = set()
        for rows, data, off in pieces(batches):
            keys, at = _sets(data, off, size, rank.value)
            lo, hi = _names(keys, at)
            n = np.diff(at)
            take = np.where(n > 0, np.minimum(n, n - -(-num * n // den) + DEEP), 0)
            for i, name in enumerate(zip(lo.tolist(), hi.tolist())):
                if name in seen:
                    take[i] = 0
                elif n[i]:
                    seen.add(name)
            stop = np.concatenate([[0], np.cumsum(take)])
            flat = keys[np.repeat(at[:-1] - stop[:-1], take) + np.arange(stop[-1])]
            head = pa.ListArray.from_arrays(pa.array(stop.astype(np.int32)), signed(flat))
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), pa.array(n.astype(np.int64)), signed(lo), signed(hi), head],
                ["doc_id", "n", "lo", "hi", "head"])
    return run


def _tokens(words, num, den):
    """token, lo, hi, n of the head shingles that the bitmap may hold, of
    nodes with enough of them for a link."""
    def run(batches):
        for batch in batches:
            head, n = batch.column("head"), batch.column("n").to_numpy()
            flat = head.flatten().to_numpy().view(U64)
            owner = np.repeat(np.arange(len(head)), np.diff(head.offsets.to_numpy()))
            some = bitmap.holds(words.value, flat)
            shared = np.bincount(owner[some], minlength=len(head))
            some &= (shared >= np.minimum(DEEP, -(-num * n // den)))[owner]
            at = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays([signed(flat[some]), *[batch.column(c).take(at) for c in ("lo", "hi", "n")]],
                                             ["token", "lo", "hi", "n"])
    return run


def _wanted(size, rank, words):
    """lo, hi, n, keys of the sets whose name the bitmap may hold."""
    def run(batches):
        seen = set()
        for _, data, off in pieces(batches):
            keys, at = _sets(data, off, size, rank.value)
            lo, hi = _names(keys, at)
            n = np.diff(at)
            some = [i for i in np.flatnonzero(bitmap.holds(words.value, lo) & (n > 0)).tolist()
                    if (lo[i], hi[i]) not in seen]
            seen.update((lo[i], hi[i]) for i in some)
            yield pa.RecordBatch.from_arrays(
                [signed(lo[some]), signed(hi[some]), pa.array(n[some].astype(np.int64)),
                 pa.array([keys[at[i]:at[i + 1]].tobytes() for i in some], pa.binary())], ["lo", "hi", "n", "keys"])
    return run


def _linked(common, a, b, num, den):
    return den * common >= num * (a + b - common)


def _sets_of(column) -> list[np.ndarray]:
    """The sets of a binary column, as views of its Arrow buffer."""
    data, off = buffers(column)
    return [data[a:b].view(U64) if a % 8 == 0 else np.frombuffer(data[a:b].tobytes(), U64) for a, b in zip(off[:-1], off[1:])]


def _led(num, den):
    """Marks the members that their group's leader links, itself included.
    Rows are sorted by block, the leader's copy (role 0) before the members."""
    def run(batches):
        leader = np.zeros(0, U64)
        for batch in batches:
            core = []
            for role, own in zip(batch.column("role").to_pylist(), _sets_of(batch.column("keys"))):
                if role == 0:
                    leader = own.copy()
                common = np.isin(own, leader, assume_unique=True).sum()
                core.append(bool(_linked(common, len(own), len(leader), num, den)))
            mine = batch.column("role").to_numpy() > 0
            out = pa.RecordBatch.from_arrays([batch.column(c) for c in ("g", "lo", "hi", "keys")] + [pa.array(core)],
                                             ["g", "lo", "hi", "keys", "core"])
            yield out.filter(pa.array(mine))
    return run


def open_cell(members: list, queries: list, core: list, num: int, den: int):
    """Index pairs (query, member) of links that join parts of the cell;
    ``core`` marks the members that are one part from the start.  Indices
    of a query that is also a member agree by name outside."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members)
    order = np.argsort(flat, kind="stable")
    tokens, owner = flat[order], np.repeat(np.arange(len(members)), sizes)[order]
    asked = np.concatenate(queries)
    at = np.concatenate([[0], np.cumsum([len(q) for q in queries])])
    left, right = np.searchsorted(tokens, asked, "left"), np.searchsorted(tokens, asked, "right")
    hits = right - left
    overlap = _sums((hits > 0).astype(np.int64), at)          # with the union of the members
    part = list(range(len(members)))

    def root(x):
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x
    lead = None
    for j, c in enumerate(core):
        if c:
            lead = j if lead is None else lead
            part[j] = lead
    for i, q in enumerate(queries):
        if den * overlap[i] < num * len(q):
            continue                                             # the group cannot hold a partner
        a, b = at[i], at[i + 1]
        width = hits[a:b]
        stop = np.cumsum(width)
        spots = np.repeat(left[a:b] - (stop - width), width) + np.arange(stop[-1])
        common = np.bincount(owner[spots], minlength=len(members))
        found = np.flatnonzero(_linked(common, len(q), sizes, num, den))
        first = None
        for j in found.tolist():
            r = root(j)
            if first is None:
                first = r
                yield i, j
            elif r != root(first):
                part[r] = root(first)
                yield i, j


def _cells(num, den, whole):
    """Streams rows sorted by cell; holds one cell at a time.  ``whole``:
    the cell is a whole group, whose members are queries too."""
    def links(rows):
        members = [r for r in rows if r[0] == 0]
        queries = [r for r in rows if r[0] == 1] + (members if whole else [])
        if not members or not queries or len(rows) < 2:
            return
        for i, j in open_cell([r[3] for r in members], [r[3] for r in queries], [r[4] for r in members], num, den):
            if queries[i][1:3] != members[j][1:3]:
                yield (*queries[i][1:3], *members[j][1:3])

    def run(batches):
        last, rows = None, []
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("g", "i", "j", "side", "lo", "hi")]
            for g, i, j, *row in zip(*cols, _sets_of(batch.column("keys")), batch.column("core").to_pylist()):
                if (g, i, j) != last:
                    out.extend(links(rows))
                    last, rows = (g, i, j), []
                rows.append(row)
            yield _links_batch(out)
        yield _links_batch(list(links(rows)))
    return run


def _links_batch(out):
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)],
                                      ["alo", "ahi", "blo", "bhi"])


def _name(lo: str, hi: str):
    return F.concat(F.unhex(F.lpad(F.hex(lo), 16, "0")), F.unhex(F.lpad(F.hex(hi), 16, "0")))


def find_links(texts: DataFrame, heads: DataFrame, size: int, num: int, den: int, rank) -> DataFrame:
    """(a, b): links between set names that connect every pair of linked
    sets of different content, directly or over others."""
    spark: SparkSession = texts.sparkSession
    tokens = heads.select(F.explode("head").alias("token"), "lo")
    shared = (tokens.groupBy("token").agg(F.min("lo").alias("least"), F.max("lo").alias("most"))
              .filter(F.col("least") != F.col("most")).select("token"))
    shared = cut(shared, "shared")
    words = spark.sparkContext.broadcast(bitmap.build(shared, "token"))
    rows = heads.select("head", "lo", "hi", "n").mapInArrow(
        _tokens(words, num, den), "token bigint, lo bigint, hi bigint, n bigint")
    rows = cut(rows.join(shared, "token").distinct(), "tokens")
    # a node's group: the least hash of its tokens, of those about as frequent as its middle one, so that
    # what tells near copies apart does not part them; nodes of one size with the same tokens are one kind,
    # named by two hashes over them
    often = rows.join(rows.groupBy("token").agg(F.count("*").alias("f")), "token")
    node = often.groupBy("lo", "hi", "n").agg(
        F.sort_array(F.collect_list(F.struct("f", F.xxhash64("token").alias("h")))).alias("all"),
        *[F.bit_xor(F.xxhash64(F.lit(k), "token")).alias(f"k{k}") for k in (0, 1)])
    middle = F.get("all", F.floor(F.size("all") / 2).cast("int"))["f"]
    own = F.array_min(F.transform(F.filter("all", lambda x: x["f"] * 2 >= middle), lambda x: x["h"]))
    node = cut(node.select("lo", "hi", "n", own.alias("own"), "k0", "k1"), "nodes")
    # the matrix: token x group, with how many members have the token and their sizes
    matrix = rows.join(node, ["lo", "hi", "n"]).groupBy("token", F.col("own").alias("g")).agg(
        F.count("*").alias("m"), F.min("n").alias("small"), F.max("n").alias("large"))
    # the nodes of a kind have the same cells: one of them asks for all
    one = node.groupBy("n", "own", "k0", "k1").agg(F.min(F.struct("lo", "hi")).alias("one")).select(
        "n", "own", "k0", "k1", "one.lo", "one.hi")
    hits = rows.join(one, ["lo", "hi", "n"]).join(matrix, "token").filter(
        ((F.col("g") != F.col("own")) | (F.col("m") > 1))
        & (F.col("large") * den >= F.col("n") * num) & (F.col("small") * num <= F.col("n") * den))
    asked = F.least(F.lit(DEEP), F.ceil(F.col("n") * num / den))
    opens = hits.groupBy("n", "own", "k0", "k1", "g").agg(F.count("*").alias("overlap")).filter(F.col("overlap") >= asked)
    opens = cut(opens.drop("overlap"), "opens")
    # members of the groups (side 0) and their visitors (side 1), still without their sets
    kind = ["n", "own", "k0", "k1"]
    asks = opens.select(*kind, F.col("own").alias("g"), F.lit(0).alias("side")).distinct().unionByName(
        opens.filter("g < own").select(*kind, "g", F.lit(1).alias("side")))
    roles = node.join(asks, kind).select("lo", "hi", "n", "g", "side")
    groups = roles.groupBy("g").agg(
        F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes"),
        F.min(F.when(F.col("side") == 0, F.struct("lo", "hi"))).alias("lead")).filter("rows > 1")
    roles = roles.join(groups, "g").select(
        "g", "side", "lo", "hi", "n", ((F.col("rows") > CELL_ROWS) | (F.col("bytes") > CELL_BYTES)).alias("big"),
        ((F.col("side") == 0) & (F.struct("lo", "hi") == F.col("lead"))).alias("lead"))
    roles = cut(roles, "roles")
    words = spark.sparkContext.broadcast(bitmap.build(roles, "lo"))
    sets = texts.mapInArrow(_wanted(size, rank, words), "lo bigint, hi bigint, n bigint, keys binary")
    sets = sets.dropDuplicates(["lo", "hi", "n"]).join(roles, ["lo", "hi", "n"])
    sets = cut(sets.select("g", "side", "lo", "hi", "keys", "big", "lead"), "sets")

    links = "alo bigint, ahi bigint, blo bigint, bhi bigint"
    one = F.lit(0).cast("long")
    small = sets.filter("not big").select("g", one.alias("i"), one.alias("j"), "side", "lo", "hi", "keys", F.lit(False).alias("core"))
    found = small.repartition("g").sortWithinPartitions("g").mapInArrow(_cells(num, den, True), links)
    if sets.filter("big").isEmpty():
        return _named(found)

    big = sets.filter("big")
    leaders = big.filter("lead").select("g", F.col("lo").alias("blo"), F.col("hi").alias("bhi"), "keys")
    # the leader's set goes once to each block of members
    own = big.filter("side = 0").select("g", "lo", "hi", "keys")
    count = own.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / CELL_ROWS, F.sum(F.length("keys")) / CELL_BYTES))
                                 .cast("long").alias("blocks"))
    placed = own.join(count, "g").select("g", F.pmod(F.xxhash64("lo", "hi"), F.col("blocks")).alias("i"),
                                         F.lit(1).alias("role"), "lo", "hi", "keys")
    first = leaders.join(count, "g").select("g", F.explode(F.sequence(one, F.col("blocks") - 1)).alias("i"),
                                            F.lit(0).alias("role"), F.col("blo").alias("lo"), F.col("bhi").alias("hi"), "keys")
    met = placed.unionByName(first).repartition("g", "i").sortWithinPartitions("g", "i", "role")
    members = cut(met.mapInArrow(_led(num, den), "g bigint, lo bigint, hi bigint, keys binary, core boolean"), "members")
    star = members.filter("core").join(leaders.drop("keys"), "g").select(
        F.col("lo").alias("alo"), F.col("hi").alias("ahi"), "blo", "bhi")
    asks = big.filter("side = 1").select("g", "lo", "hi", "keys").unionByName(
        members.filter("not core").select("g", "lo", "hi", "keys"))

    def blocks(df, name):
        return df.groupBy("g").agg(F.ceil(F.greatest(
            F.count("*") / CELL_ROWS, F.sum(F.length("keys")) / CELL_BYTES)).cast("long").alias(name))

    def upto(name):
        return F.explode(F.sequence(one, F.col(name) - 1))
    grid = blocks(asks, "qi").join(blocks(members, "mj"), "g")
    spot = F.xxhash64("lo", "hi")
    q = asks.join(grid, "g").select("g", F.pmod(spot, F.col("qi")).alias("i"), upto("mj").alias("j"),
                                    F.lit(1).alias("side"), "lo", "hi", "keys", F.lit(False).alias("core"))
    m = members.join(grid, "g").select("g", upto("qi").alias("i"), F.pmod(spot, F.col("mj")).alias("j"),
                                       F.lit(0).alias("side"), "lo", "hi", "keys", "core")
    both = m.unionByName(q).repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return _named(found.unionByName(both.mapInArrow(_cells(num, den, False), links)).unionByName(star))


def _named(links: DataFrame) -> DataFrame:
    return links.select(_name("alo", "ahi").alias("a"), _name("blo", "bhi").alias("b"))


def join_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links)
    and the set's name (lo, hi), for every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("binary").alias("t"), F.col("doc_id").alias("id"))
    rank = spark.sparkContext.broadcast(shingle_order(texts, size))
    kind = dict(docs.dtypes)["doc_id"]
    heads = cut(texts.mapInArrow(_heads(size, num, den, rank),
                                 f"doc_id {kind}, n bigint, lo bigint, hi bigint, head array<bigint>"), "heads")
    linked = components(find_links(texts, heads, size, num, den, rank))
    node = heads.filter("n > 0").groupBy("lo", "hi").agg(F.min("doc_id").alias("least"))
    node = node.withColumn("node", _name("lo", "hi"))
    node = node.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = node.groupBy("component").agg(F.min("least").alias("component_id"))
    named = node.join(whole, "component").select("lo", "hi", "component_id")
    rows = heads.select("doc_id", "n", "lo", "hi").join(named, ["lo", "hi"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"),
                       F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                       "lo", "hi")
