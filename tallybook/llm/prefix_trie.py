"""Prefix trie of rebuilt conversations, from fingerprints that compose like a monoid.

Every conversation c is rebuilt as the head of a base conversation (c - c % GROUP: its first h turns, h = crc32(c) % HEADS) and c's
own turns after its first h. The texts of rebuilt conversations never exist: the fingerprint of a sequence is the pair of polynomials
sum(hash(turn i) * B ** (i - 1)) mod 2^61 - 1 in two lanes, so that of ``head + suffix`` follows from prefix fingerprints of the stored
conversations alone, by one shift and one scale per conversation. Prefix sums of byte counts compose in the same way.

1. Turns are put in order by range (a conversation of any length spreads over tasks), hashed, and folded into prefix fingerprints within
   a task; what a conversation has before a task's first run (two sums for each task) is added by a broadcast join.
2. Rebuilt prefixes (conversation, depth, fingerprint, byte sum, reference) are grouped into nodes. A node's members refer to stored turns
   by content address (SHA-256 of role and text). As the fingerprint can be cancelled from the right, members of a node whose last turns
   are equal have equal prefixes if the same holds one level up: one check on all nodes proves all of them. If it fails, other bases are taken.
3. Sums over subtrees need no walk down the tree. Each node belongs to its smallest member, so member m shares the first s(m) turns of its path with
   smaller ones and owns the rest. With B the byte sums along m's path, a subtree's saved bytes are the sum over members of
   max(0, B(s) - B(depth - 1)); leaves and children are counted by their owners in the same grouping.
4. The ends of a node are dealt out by range in numeric order, joined to strings within tasks, and hashed string by string
   (SHA-256 is sequential, so one task reads the strings of one node, in a stream and with constant memory).

Order within a conversation: turn (null first), then role, then text; repeated rows are turns of their own. A null role or text is the
empty one; rows without conv_id take no part. ``%`` has the sign of the dividend. Only the four columns are read, so other columns may have any name.
An empty table has no node; a conversation may be rebuilt as no turns at all and is then a member of the root only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import partitions, staged

GROUP, HEADS = 5, 9
PRIME = (1 << 61) - 1
ENDS = 4096  # ids in a string of ends
NODE = ["depth", "f1", "f2"]


def bases(seed: int) -> tuple[int, int]:
    d = hashlib.sha256(b"bases %d" % seed).digest()
    return tuple(int.from_bytes(d[i:i + 8], "big") % (PRIME - 1000) + 500 for i in (0, 8))


def _times(a: Column, b: Column) -> Column:
    """a * b mod PRIME, of two longs in 0 .. PRIME - 1."""
    wide = a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
    return (wide % F.lit(Decimal(PRIME))).cast("long")


def _plus(a: Column, b: Column) -> Column:
    return (a + b) % F.lit(PRIME)


def turn_prefixes(conversations: DataFrame, base: tuple[int, int]) -> DataFrame:
    """conv_id, place (from 1), f1, f2 (fingerprint of the first ``place`` turns), until (their bytes), bytes, turn (SHA-256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "conv_id", "place", "f1", "f2", "until", "bytes", "turn", "edge"]
        conv, first, edges = None, True, []
        place = f1 = f2 = until = 0
        w1 = w2 = 1
        part = -1
        for b in batches:
            out = []
            for part, c, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if c != conv:
                    if conv is not None and first:
                        edges, first = [(part, conv, place, f1, f2, until, 0, None, True)], False
                    conv, place, f1, f2, until, w1, w2 = c, 0, 0, 0, 0, 1, 1
                role, text = role.encode(), text.encode()
                turn = hashlib.sha256(len(role).to_bytes(8, "big") + role + text).digest()
                f1 = (f1 + int.from_bytes(turn[:8], "big") * w1) % PRIME
                f2 = (f2 + int.from_bytes(turn[8:16], "big") * w2) % PRIME
                w1, w2 = w1 * base[0] % PRIME, w2 * base[1] % PRIME
                place, until = place + 1, until + len(text)
                out.append((part, c, place, f1, f2, until, len(text), turn, False))
            if out:
                yield pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*out), schema)], names)
        if conv is not None:
            edges.append((part, conv, place, f1, f2, until, 0, None, True))
            yield pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*edges), schema)], names)

    schema = pa.schema([("part", pa.int64()), ("conv_id", pa.int64()), ("place", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("until", pa.int64()), ("bytes", pa.int64()), ("turn", pa.binary()), ("edge", pa.bool_())])
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = (conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *text)
             .repartitionByRange(partitions(conversations.sparkSession), *order).sortWithinPartitions(*order))
    rows = staged(dealt.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "role", "text")
                  .mapInArrow(run, "part long, conv_id long, place long, f1 long, f2 long, until long, bytes long, turn binary, edge boolean"), "turns")

    def before(runs: pd.DataFrame) -> pd.DataFrame:
        n = g1 = g2 = total = 0
        out = []
        for r in runs.sort_values("part").itertuples():
            s1, s2 = pow(base[0], n, PRIME), pow(base[1], n, PRIME)
            out.append((r.part, r.conv_id, n, s1, s2, g1, g2, total))
            n, total = n + r.place, total + r.until
            g1, g2 = (g1 + s1 * r.f1) % PRIME, (g2 + s2 * r.f2) % PRIME
        return pd.DataFrame(out, columns=["p", "c", "n", "s1", "s2", "g1", "g2", "total"])
    runs = (rows.where("edge").select("part", "conv_id", "place", "f1", "f2", "until").groupBy("conv_id")
            .applyInPandas(before, "p long, c long, n long, s1 long, s2 long, g1 long, g2 long, total long").where("n > 0"))
    # at most two rows for each task of the sort
    rows = rows.where("not edge").join(F.broadcast(runs), (F.col("part") == F.col("p")) & (F.col("conv_id") == F.col("c")), "left")

    def whole(i: int) -> Column:
        moved = _plus(F.col(f"g{i}"), _times(F.col(f"s{i}"), F.col(f"f{i}")))
        return F.when(F.col("n").isNull(), F.col(f"f{i}")).otherwise(moved).alias(f"f{i}")
    zero = F.lit(0).cast("long")
    return rows.select("conv_id", (F.col("place") + F.coalesce("n", zero)).alias("place"), whole(1), whole(2),
                       (F.col("until") + F.coalesce("total", zero)).alias("until"), "bytes", "turn")


def _links(turns: DataFrame, base: tuple[int, int]) -> DataFrame:
    """One row per conversation: how its rebuilt form composes. conv_id, h, hd (turns taken from the base), n, length, head (the base's
    first turns), and shift, scale of both lanes and of the byte sums for its own turns after the first h."""
    first = F.when(F.col("place") < HEADS, F.struct("place", "f1", "f2", "until", "bytes", "turn"))
    convs = staged(turns.groupBy("conv_id").agg(F.max("place").alias("n"), F.array_sort(F.collect_list(first)).alias("head")), "conversations")
    heads = convs.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    c = (convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS)
         .withColumn("of", F.col("conv_id") - F.col("conv_id") % GROUP))
    c = (c.join(heads, F.col("of") == F.col("base"), "left")
         .withColumn("hd", F.least("h", F.coalesce(F.size("base_head"), F.lit(0)).cast("long"))))

    def at(head: str, k: Column, field: str) -> Column:
        return F.coalesce(F.when(k > 0, F.element_at(head, F.greatest(k, F.lit(1)).cast("int"))[field]), F.lit(0).cast("long"))
    own = F.least("h", F.col("n"))
    back = (F.col("h") - F.col("hd") + 1).cast("int")
    columns = []
    for i in (1, 2):
        inverse = F.array(*[F.lit(pow(base[i - 1], -k, PRIME)) for k in range(HEADS)])
        scale = F.element_at(inverse, back)
        shift = _plus(at("base_head", F.col("hd"), f"f{i}"), F.lit(PRIME) - _times(scale, at("head", own, f"f{i}")))
        columns += [scale.alias(f"scale{i}"), shift.alias(f"shift{i}")]
    moved = (at("base_head", F.col("hd"), "until") - at("head", own, "until")).alias("moved")
    length = (F.col("hd") + F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("h"))).alias("length")
    head = F.when(F.col("hd") > 0, F.slice("base_head", F.lit(1), F.col("hd").cast("int"))).alias("head")
    return staged(c.select("conv_id", "h", "hd", "n", length, head, moved, *columns), "links")


def _prefixes(turns: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, length, depth, f1, f2, until (bytes of the prefix), bytes (of its last turn), turn: every prefix of every rebuilt conversation but the empty ones."""
    head = links.where("hd > 0").select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", "length", F.col("t.place").alias("depth"), "t.f1", "t.f2", "t.until", "t.bytes", "t.turn")
    own = turns.join(links.where("n > h").drop("n", "head"), "conv_id").where("place > h")
    own = own.select("conv_id", "length", (F.col("hd") + F.col("place") - F.col("h")).alias("depth"),
                     *[_plus(F.col(f"shift{i}"), _times(F.col(f"scale{i}"), F.col(f"f{i}"))).alias(f"f{i}") for i in (1, 2)],
                     (F.col("until") + F.col("moved")).alias("until"), "bytes", "turn")
    return staged(head.unionByName(own), "prefixes")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """depth, f1, f2, ends_sha256 of the conversations (conv_id) that end at each node."""
    def strings(batches):
        key, ids = None, []

        def row():
            return (*key, ids[0], ",".join(map(str, ids)))
        for b in batches:
            out = []
            for *k, c in zip(*(x.to_pylist() for x in b.columns)):
                if ids and (k != key or len(ids) == ENDS):
                    out.append(row())
                    ids = []
                key = k
                ids.append(c)
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], [*NODE, "start", "ids"])
        if ids:
            yield pa.record_batch([pa.array([x]) for x in row()], [*NODE, "start", "ids"])

    def hashes(batches):
        key, sha = None, None
        for b in batches:
            out = []
            for k, rows in groupby(zip(*(x.to_pylist() for x in b.columns)), lambda r: r[:3]):
                if k != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha, lead = k, hashlib.sha256(), ""
                for r in rows:
                    sha.update((lead + r[4]).encode())
                    lead = ","
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], [*NODE, "ends_sha256"])
        if key is not None:
            yield pa.record_batch([pa.array([x]) for x in (*key, sha.hexdigest())], [*NODE, "ends_sha256"])
    n, order = partitions(ends.sparkSession), [*NODE, "conv_id"]
    joined = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(strings, "depth long, f1 long, f2 long, start long, ids string")
    return joined.repartition(n, *NODE).sortWithinPartitions(*NODE, "start").mapInArrow(hashes, "depth long, f1 long, f2 long, ends_sha256 string")


def trie(conversations: DataFrame, tries: int = 4) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    for seed in range(tries):
        base = bases(seed)
        turns = turn_prefixes(conversations, base)
        links = _links(turns, base)
        rows = _prefixes(turns, links)
        nodes = staged(rows.groupBy(*NODE).agg(F.min("conv_id").alias("own"), F.max("length").alias("deepest"), F.min("turn").alias("turn"), F.max("turn").alias("turn2")), "nodes")
        if nodes.where("turn <> turn2").isEmpty():
            break
    else:
        raise RuntimeError(f"equal fingerprints of different prefixes under {tries} pairs of bases")

    # what each conversation shares with smaller ones: s turns of until_s bytes, the last of them in a node of own_s; leaf: it owns a childless end
    shared = F.col("own") != F.col("conv_id")
    leaf = ~shared & (F.col("depth") == F.col("length")) & (F.col("deepest") == F.col("depth"))
    marks = (rows.select("conv_id", "length", "until", *NODE).join(nodes.select(*NODE, "own", "deepest"), NODE).groupBy("conv_id")
             .agg(F.max(F.when(shared, F.col("depth"))).alias("s"), F.max_by("own", F.when(shared, F.col("depth"))).alias("own_s"),
                  F.max(F.when(shared, F.col("until"))).alias("until_s"), F.max(leaf.cast("int")).alias("leaf")))
    least, deepest = links.agg(F.min("conv_id"), F.max("length")).first()
    root, zero = F.col("conv_id") == F.lit(least), F.lit(0).cast("long")
    marks = links.select("conv_id", "length").join(marks, "conv_id", "left").select(
        "conv_id", "length", F.coalesce("s", F.when(root, F.lit(-1).cast("long")).otherwise(zero)).alias("s"), "own_s",
        F.coalesce("until_s", zero).alias("until_s"), F.coalesce("leaf", (root & F.lit(deepest == 0)).cast("int")).alias("leaf"))
    marks = staged(marks, "marks")

    depth, s = F.col("depth"), F.col("s")
    owns = depth > s
    above = F.when(depth - 1 > s, F.col("conv_id")).when(depth == 1, F.lit(least)).otherwise(F.col("own_s"))
    sums = [F.max(F.when(owns, F.col("conv_id"))).alias("conv_id"), F.max(F.when(owns & (depth > 0), above)).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
            F.sum(((s <= depth) & (depth < F.col("length"))).cast("long")).alias("n_children"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
            F.sum(F.greatest(zero, F.col("until_s") - F.col("before"))).alias("saved_tokens")]
    each = rows.select("conv_id", *NODE, (F.col("until") - F.col("bytes")).alias("before")).join(marks, "conv_id")
    found = each.groupBy(*NODE).agg(*sums)
    top = marks.withColumns({"depth": zero, "f1": zero, "f2": zero, "before": zero}).groupBy(*NODE).agg(*sums)
    ends = rows.where("depth = length").select(*NODE, "conv_id").unionByName(links.where("length = 0").select(*[zero.alias(c) for c in NODE], "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (found.unionByName(top).join(staged(_end_hashes(ends), "ends"), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))
