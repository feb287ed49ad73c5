"""Near-duplicates by an inverted join of MinHash signature coordinates.

A document's set holds its distinct shingles of ``width`` words (64-bit hashes). Documents with equal sets form one node.
Each node has a signature of ``COORDINATES`` minima. Pairs of nodes that agree in at least ``MATCHES`` coordinates are kept, and their
similarity is confirmed on the full sets. Two such nodes differ in at most COORDINATES - MATCHES = 30 coordinates, so of the 32 pairs of neighbouring
coordinates they agree in at least COMMON = 2 whole ones. Nodes are therefore posted under the values of two coordinates at once, which
makes lists of texts that are merely alike far shorter (a similarity of 0.4 agrees in 16 % of them):

* values that only one node has are left out; a node left with fewer than COMMON can have no partner;
* prefix and skip: of a node's c lists, in ascending order of length, two nodes that share COMMON of them share one of the first
  c - COMMON + 1; the longest is never merged, its collisions are counted on the signatures.

For two sets of similarity 0.8 the chance of fewer than MATCHES agreements is 3e-7.

A list of n nodes isn't expanded into all pairs: first each node meets the pivots of its shortest lists and components are
formed, with further rounds and other pivots while many pairs are left and get fewer. Then pairs of a list that lie in
different components are compared, so no component is missed; links inside a component change nothing and aren't needed. If there are more than FEW
for each posting, as with many texts that share a passage and are no copies, only pairs that also share one of their rarest shingles are: of two
sets A, B with the required overlap each has one of the |A| - needed(A) + 1 rarest of the other's, rarity being counted over the nodes in question.
Near copies of one text that are no copies of each other share most of these, too. So a set is also summed up by parities, whose differences
are a lower bound of those of the sets: a pair beyond what a link allows isn't listed. If there are more of the others than nodes, first the nearest
pair of each two components is compared, then those of components that are still different.

Texts without words (null, empty) have an empty set, no links, and are kept. Rows that repeat a doc_id are one document
as far as their texts agree. A null doc_id is larger than any other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Kept, dropped, fresh, give_back, staged

WIDTH, SHARE = 4, 80  # words in a shingle; percent of the union that linked sets have in common
COORDINATES, MATCHES = 64, 34
COMMON = COORDINATES // 2 - (COORDINATES - MATCHES)  # whole pairs of coordinates in which two nodes with MATCHES agree at least
#: Lists of a node that star rounds use (its shortest ones), most star rounds, and pairs for each posting at which they end.
STAR_LISTS, ROUNDS, FEW = 4, 3, 2
#: Shingles before a rare one that are kept beside it.
BESIDE = 8
#: Words of 64 bits in which a set is summed up by the parity of its shingles in each of so many places.
PARITIES = 8
#: Bits of the filter that spares most texts the way to the sets; a full one lets too many pass, which are left out at the join.
FILTER_BITS = 1 << 26

_RNG = np.random.default_rng(20240601)
_A = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


_WORDS = Kept(xxhash.xxh3_64_intdigest)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it is shorter; empty without words."""
    words = (text or "").encode().lower().split()  # lower() of bytes changes A-Z only, split() is at ASCII white space
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    w = min(width, len(h))
    x = np.full(len(h) - w + 1, w, np.uint64)
    for i in range(w):
        x = x * _STEP + h[i:len(h) - w + 1 + i]
    return np.unique(_mix(x))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[at:at + 4096, None] * _A + _B) >> np.uint64(32)).min(axis=0))
    return least


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit for each place: whether an odd number of shingles fall there. Two sets differ in as many shingles as bits at least."""
    odd = np.bincount((shingles % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def list_keys(signatures: np.ndarray) -> np.ndarray:
    """[row, pair of coordinates]: number of the pair and hash of its two values."""
    both = signatures.astype(np.uint64)
    mixed = _mix((both[:, ::2] << np.uint64(32) | both[:, 1::2]) + np.uint64(1)) >> np.uint64(5)
    return (mixed | np.arange(COORDINATES // 2, dtype=np.uint64) << np.uint64(59)).view(np.int64)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, node (128-bit hash of the set; null if empty), signature (32-bit minima)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                sizes, nodes, signatures = [], [], []
                for text in part.column("text"):
                    s = shingle_set(text.as_py(), width)
                    sizes.append(len(s))
                    nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    signatures.append(signature(s).astype(np.uint32).tobytes() if len(s) else None)
                yield pa.record_batch([part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
                                      ["doc_id", "text_key", "n_shingles", "node", "signature"])
        _WORDS.clear()
        give_back()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, node binary, signature binary")


def _posts(nodes: DataFrame) -> DataFrame:
    """id, key of each node's lists."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                keys = list_keys(np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES))
                yield pa.record_batch([pa.array(np.repeat(part.column("id").to_numpy(), keys.shape[1])), pa.array(keys.ravel())], ["id", "key"])
    return nodes.select("id", "signature").mapInArrow(run, "id long, key long")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """id, shingles, odd (:func:`parities`) of ``nodes`` (id, node, doc), from the texts of one document of each. Texts whose doc_id isn't in a filter of the
    nodes' bits are passed over where they lie; no text is shuffled."""
    place = F.pmod(F.xxhash64(F.col("doc")), F.lit(FILTER_BITS))
    words = (nodes.select(place.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toPandas())  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for b in batches:
            at = b.column("at").to_numpy()
            b = b.filter(pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool)))
            for k in range(0, b.num_rows, 1000):
                s = [shingle_set(t.as_py(), width) for t in b.slice(k, 1000).column("text")]
                yield pa.record_batch([pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in s], pa.binary()), pa.array([x.tobytes() for x in s], pa.binary()),
                                       pa.array([parities(x) for x in s], pa.list_(pa.int64()))], ["node", "shingles", "odd"])
        _WORDS.clear()
        give_back()
    sets = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").select(place.alias("at"), "text").mapInArrow(run, "node binary, shingles binary, odd array<long>")
    return sets.join(nodes.select("node", "id"), "node").dropDuplicates(["id"]).select("id", "shingles", "odd")


def _confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, stages: list[str]) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked."""
    def side(k):
        return nodes.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("signature").alias(f"s{k}"))

    def alike(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, COORDINATES) for c in ("sa", "sb"))
            small, large = np.sort([b.column("na").to_numpy(), b.column("nb").to_numpy()], axis=0)
            yield b.select(["a", "b"]).filter(pa.array(((x == y).sum(axis=1) >= MATCHES) & (small * 100 >= large * SHARE)))
    near = staged(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(alike, "a long, b long"), "near", stages)

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= SHARE * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    full = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    return staged(full.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"), "links", stages)


def components(links: DataFrame, stages: list[str]) -> DataFrame:
    """id, root (its component's smallest id) of every end of the links (a, b): large and small stars in turn."""
    star = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", stages)
    seen, mine = None, []
    while True:
        sums = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(sums) == seen:
            dropped(star.sparkSession, mine[:-1])
            stages += mine[-1:]
            return star.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(star.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        seen = tuple(sums)
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least neighbours are written, so that a join can be split where one id has very many
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "least", mine)
        # large star: larger neighbours move to the smallest one; small star: smaller neighbours do
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large", mine)
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least", mine)
        star = staged(large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                      .select("e.*").where("u <> v").distinct(), "small", mine)
        dropped(star.sparkSession, mine[:-1])
        mine = mine[-1:]


def _all_pairs(known: DataFrame, runs: DataFrame) -> DataFrame:
    """a, b: pairs of a list from different components. ``known``: key, root, id, merged, n; ``runs``: key, root of those lists."""
    a = known.join(runs.select("key", F.col("root").alias("other")), "key").where("root < other").select("key", "other", F.col("id").alias("a"), F.col("merged").alias("ma"), F.col("n").alias("na"))
    b = known.select(F.col("key").alias("kb"), F.col("root").alias("rb"), F.col("id").alias("b"), F.col("merged").alias("mb"), F.col("n").alias("nb"))
    once = F.array_min(F.array_intersect("ma", "mb")) == F.col("key")  # a pair of several lists is taken from one
    alike = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SHARE
    return a.join(b, (a["key"] == b["kb"]) & (a["other"] == b["rb"]) & alike & once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _rare_pairs(known: DataFrame, sets: DataFrame, stages: list[str]) -> DataFrame:
    """a, b, low, high (their components), differ: pairs of different components that share one of their rarest shingles and whose parities don't differ in more places
    than the sets of a link may, among the nodes of ``known`` (id, root, n)."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                x = np.frombuffer(b.column("shingles")[k].as_buffer(), np.uint64).view(np.int64)
                yield pa.record_batch([pa.array(np.full(len(x), b.column("id")[k].as_py())), pa.array(x)], ["id", "shingle"])
    nodes = staged(known.select("id", "root", "n").distinct(), "open-nodes", stages)
    each = sets.join(nodes.select("id"), "id").select("id", "shingles").mapInArrow(run, "id long, shingle long")
    often = staged(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "often", stages)
    shared = each.join(often, "shingle").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("shared"))
    # of n shingles a partner has at least n * SHARE / 100; those that are nobody else's come first and take places of the prefix
    alone = F.col("n") - F.size("shared")
    prefix = F.col("n") - F.ceil(F.col("n") * SHARE / 100) + 1 - alone
    rare = nodes.join(shared, "id").where(prefix > 0).select("id", "root", "n", alone.alias("alone"), F.slice("shared", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int")).alias("rare"))
    entry = F.transform("rare", lambda s, i: F.struct(
        s["shingle"].alias("shingle"), (F.col("n") - F.col("alone") - i).alias("rest"),
        F.transform(F.slice("rare", F.greatest(i - BESIDE + 1, F.lit(1)), F.least(i, F.lit(BESIDE))), lambda t: t["shingle"]).alias("earlier")))
    words = [f"odd{i}" for i in range(PARITIES)]
    rare = rare.join(sets.select("id", *[F.get("odd", F.lit(i)).alias(w) for i, w in enumerate(words)]), "id")
    rare = staged(rare.select("id", "root", "n", *words, F.explode(entry).alias("e")).select("id", "root", "n", *words, "e.*"), "rare", stages)
    a, b = (rare.select("shingle", *[F.col(c).alias(c + k) for c in ("id", "root", "n", *words, "rest", "earlier")]) for k in "ab")
    # what follows the first shingle, in this order, that both have bounds what they share; a pair isn't taken where one of the
    # BESIDE shingles before on either side is common too, so most pairs are taken once
    again = F.arrays_overlap("earliera", "earlierb")
    enough = F.least("resta", "restb") * (100 + SHARE) >= (F.col("na") + F.col("nb")) * SHARE
    differ = sum((F.bit_count(F.col(f"{w}a").bitwiseXOR(F.col(f"{w}b"))) for w in words), F.lit(0))
    near = differ * (100 + SHARE) <= (F.col("na") + F.col("nb")) * (100 - SHARE)
    return a.join(b, "shingle").where((F.col("ida") < F.col("idb")) & (F.col("roota") != F.col("rootb")) & enough & near & ~again).select(F.col("ida").alias("a"), F.col("idb").alias("b"), F.least("roota", "rootb").alias("low"), F.greatest("roota", "rootb").alias("high"), differ.alias("differ")).distinct()


def _nearest(pairs: DataFrame) -> DataFrame:
    """a, b: of each two components the pair whose parities differ least."""
    return pairs.groupBy("low", "high").agg(F.min(F.struct("differ", "a", "b")).alias("p")).select("p.a", "p.b")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` of components that are still different by ``roots`` (id, root, of nodes with links)."""
    both = pairs.select("low", "high").distinct()
    for k in ("low", "high"):
        both = both.join(roots.select(F.col("id").alias(k), F.col("root").alias(f"now_{k}")), k, "left")
    both = both.where(F.coalesce("now_low", "low") != F.coalesce("now_high", "high")).select("low", "high")
    return pairs.join(both, ["low", "high"], "left_semi")


def grouped(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (a hash of the text), n_shingles, node (null without words), and
    of its component the smallest doc_id and the text_key of a row that has it (component_id, component_text)."""
    spark = docs.sparkSession
    stages: list[str] = []  # superseded ones are deleted at the end
    rows = staged(_signatures(docs, width), "signatures")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))).alias("first"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("id"), "node", "first", F.col("first.doc_id").alias("doc"), "n", "signature"), "nodes", stages)
    posts = _posts(nodes)
    lengths = staged(posts.groupBy("key").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths", stages)
    lists = (posts.join(lengths, "key").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("length", "key"))).alias("lists"))  # at most COORDINATES / 2
             .where(F.size("lists") >= COMMON)
             .withColumn("typical", F.aggregate("lists", F.lit(0).cast("long"), lambda a, l: a + l["length"]))
             .withColumn("merged", F.transform(F.slice("lists", F.lit(1), F.greatest(F.size("lists") - COMMON + 1, F.lit(0))), lambda l: l["key"]))
             .select("id", "typical", "merged", F.posexplode("merged").alias("place", "key")))
    lists = staged(lists, "lists", stages)
    some = staged(nodes.join(lists.select("id").distinct(), "id", "left_semi"), "candidates", stages)
    sets = staged(_sets(docs, some, width), "sets", stages)
    size = lists.count()

    def labelled(roots):
        return lists.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))

    def merged_into(roots, pairs):
        return components(_confirm(pairs, some, sets, stages).unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))), stages)
    roots = spark.createDataFrame([], "id long, root long")
    left = None
    for turn in range(ROUNDS):
        first = labelled(roots).where(F.col("place") < STAR_LISTS)
        # first the most typical member, the one with the longest lists, later any other
        order = F.struct(F.col("typical") if turn == 0 else F.lit(0).cast("long"), F.xxhash64("id", F.lit(turn)))
        pivots = first.groupBy("key").agg(F.max_by(F.struct("id", "root"), order).alias("p"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        pairs = first.join(staged(pivots, "pivots", stages), "key").where("root <> p.root").select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()
        roots = merged_into(roots, pairs)
        runs = staged(labelled(roots).groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "runs", stages)
        open_ = staged(runs.groupBy("key").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high"), "open", stages)
        before, left = left, int(open_.agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2)).first()[0] or 0)
        if left <= FEW * size or before and left > 0.7 * before:
            break
    if left:
        known = labelled(roots).join(open_.select("key"), "key", "left_semi").join(some.select("id", "n"), "id").select("key", "root", "id", "merged", "n")
        if left <= FEW * size:
            pairs = _all_pairs(known, runs)
        else:
            pairs = staged(_rare_pairs(known, sets, stages), "rare-pairs", stages)
            if pairs.count() > some.count():  # one pair of two components is enough if it is linked; the others wait for what is left
                roots = merged_into(roots, _nearest(pairs))
                pairs = _apart(pairs, roots)
        roots = merged_into(roots, pairs.select("a", "b"))
    owner = nodes.join(roots, "id", "left").select("node", "first", F.coalesce("root", "id").alias("root"))
    least = staged(owner.groupBy("root").agg(F.min("first").alias("least")), "roots", stages)
    owner = staged(owner.join(least, "root").select("node", F.col("least.doc_id").alias("c"), F.col("least.text_key").alias("t")), "owners")
    dropped(spark, stages)
    none = F.col("node").isNull()
    return rows.drop("signature").join(owner, "node", "left").select(
        "doc_id", "text_key", "n_shingles", "node", F.when(none, F.col("doc_id")).otherwise(F.col("c")).alias("component_id"), F.when(none, F.col("text_key")).otherwise(F.col("t")).alias("component_text"))


def link(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    return grouped(docs, width).select("doc_id", "n_shingles", "component_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id (and, of several texts with it, one). Rows go by id
    and text, so another text with the id of one that goes stays."""
    same = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_text"))
    id_, key = fresh(docs, "_gone"), fresh(docs, "_gone_text")
    gone = grouped(docs, width).where(~same).select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[id_]) & (F.xxhash64(docs["text"]) == gone[key]), "left_anti")
