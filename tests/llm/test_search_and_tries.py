"""Prefix trie, prefix forest and zone negatives against plain versions."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest

from tallybook.llm import prefix_forest, prefix_trie, zone_negatives
from tallybook.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def plain_trie(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("case", ["edges", "long", "given"])
def test_trie_equals_plain_version(spark, case):
    if case == "given":
        df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    elif case == "long":  # one conversation over many tasks, and many that share its head
        rows = [(10, i, "u", f"t{i % 7}") for i in range(120)] + [(10 + 5 * k, i, "u", f"t{i % 7}") for k in range(1, 40) for i in range(12)]
        df = spark.createDataFrame(rows, CONV).repartition(5)
    else:
        rows = [(5, None, "u", "a"), (5, 1, None, "b"), (5, 1, "u", None), (5, 1, "u", None), (6, 1, "u", "x"), (7, 1, "u", "a"), (7, 2, "u", "b"),
                (None, 1, "u", "a"), (-3, 1, "u", "q"), (8, 1, "é", "üü"), (9, None, None, None), (21, 1, "u", "only"), (22, 1, "u", "z" * 30000), (1, 1, "ab", "c"), (2, 1, "a", "bc")]
        df = spark.createDataFrame(rows, CONV)
    want = plain_trie([tuple(r) for r in df.collect()])
    other = df.withColumns({c: df["turn"] for c in ("depth", "f1", "part", "_at")})
    assert sorted(map(tuple, prefix_trie.trie(other).collect()), key=str) == want


def test_trie_of_nothing_and_of_equal_fingerprints(spark, monkeypatch):
    assert prefix_trie.trie(spark.createDataFrame([], CONV)).collect() == []
    df = spark.createDataFrame([(100, 1, "u", "a"), (100, 2, "u", "b"), (200, 1, "u", "b"), (200, 2, "u", "a"), (100, 3, "u", "c"), (200, 3, "u", "c")], CONV)
    # with base 1 the order of turns is lost: the check finds it and other bases are taken
    monkeypatch.setattr(prefix_trie, "bases", lambda seed, real=prefix_trie.bases: (1, 1) if seed == 0 else real(seed))
    want = plain_trie([tuple(r) for r in df.collect()])
    assert sorted(map(tuple, prefix_trie.trie(df).collect()), key=str) == want
    with pytest.raises(RuntimeError):
        prefix_trie.trie(df, tries=1)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, shard int, x string, dims string")


EDGE = [(0, [1.0, 0.0], 1), (50, [0.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2), (5, [0.0, 0.0], 2),
        (6, [1.0, 0.0], 2), (7, [1.0, 0.0], 2), (7, [1.0, 0.0], 2), (8, [3.0, 0.0], 1), (None, [1.0, 1.0], 1), (9, [1.0], 1), (10, [], 1), (11, [1e300, 1e300], 2),
        (12, [-1.0, 0.5], None), (13, [0.5, 0.25], 2), (14, [0.5, 0.5], 2), (15, [0.75, 0.25], 1), (100, [0.5, 0.5], 2), (100, [0.5, 0.75], 2)]


def plain_nearest(rows, k):
    ok = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    queries = {}
    for i, v in ok:
        if i % 50 == 0 and (i not in queries or list(v) < list(queries[i])):
            queries[i] = v
    for q, x in queries.items():
        x = x / np.abs(x).max()
        near = sorted((-float((x * (v / np.abs(v).max())).sum() / np.sqrt((x * x).sum()) / np.sqrt(((v / np.abs(v).max()) ** 2).sum())), i) for i, v in ok if len(v) == len(x) and i != q)[:k]
        out |= {(q, n + 1, round(-s, 9)) for n, (s, _) in enumerate(near)}
    return out


def test_forest_edge_rows(spark):
    x = prefix_forest.valid(vectors(spark, [(*r, 0, "", "") for r in EDGE]))
    got = prefix_forest.search(x, x.where("vec_id % 50 = 0"), 5).collect()
    assert {(r.query_id, r.rank, round(r.score, 9)) for r in got} == plain_nearest(EDGE, 5)
    assert [r.vec_id for r in got if r.query_id == 0][:3] == [6, 7, 7]  # equal vectors by id
    none = x.where("false")
    assert prefix_forest.search(none, none, 5).collect() == []


def test_forest_recall_without_exhaustive_search(spark):
    """Vectors without structure over several shards, with the least number of candidates out of the way."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 32))
    x[:300] = x[0]  # one very common vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    v = prefix_forest.valid(df)
    found = collections.defaultdict(list)
    for r in prefix_forest.search(v, v.where("vec_id % 100 = 0"), 5, least=0).collect():
        found[r.query_id].append(r.vec_id)
    u = x / np.sqrt((x * x).sum(axis=1))[:, None]
    right = []
    for q in range(0, 6000, 100):
        s = u @ u[q]
        s[q] = -9
        best = list(range(1, 6)) if q == 0 else [i for i in range(300) if i != q][:5] if q < 300 else np.argsort(-s, kind="stable")[:5].tolist()
        right.append(len(set(best) & set(found[q])) / 5)
    assert np.mean(right) >= 0.9 and right[:3] == [1.0, 1.0, 1.0]


def plain_negatives(rows, k_positive=5, k_negative=3):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in ok:
        if i % 50 == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, x) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, other) for i, other, v in ok if i != a and len(v) == len(x))
        for s, p, _ in [r for r in scored if r[2] == lab][:k_positive]:
            window = [r for r in scored if r[2] != lab and 50 * -s <= 100 * -r[0] <= 95 * -s][:k_negative]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("case", ["edges", "blocks"])
def test_negatives_equal_plain_version(spark, monkeypatch, case):
    from pyspark.sql import functions as F

    rows = [r for r in EDGE if not r[1] or 1e300 not in r[1]]
    if case == "blocks":
        for name, value in (("BLOCK_ROWS", 16), ("GROUP_ANCHORS", 4), ("ZONES", 8)):
            monkeypatch.setattr(zone_negatives, name, value)
        rng = np.random.default_rng(5)
        centres = rng.standard_normal((12, 6))
        rows = [(i, (centres[i % 12] + rng.standard_normal(6) / 8).tolist(), int(i % 3)) for i in range(700)]
        rows += [(1000 + i, rows[0][1], i % 2) for i in range(300)]  # one very common vector
    x = zone_negatives.scaled(vectors(spark, [(*r, 0, "", "") for r in rows]), F.col("label"), 256)
    got = zone_negatives.mine(x, x.where("vec_id % 50 = 0"))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.select(*columns).collect())) == plain_negatives(rows)
    if case == "edges":
        none = x.where("false")
        assert zone_negatives.mine(none, none).collect() == []


def test_huge_components_are_cut_not_lost(spark):
    from pyspark.sql import functions as F

    x = zone_negatives.scaled(vectors(spark, [(0, [1e300, 1.0], 1, 0, "", ""), (1, [1e300, 0.0], 1, 0, "", ""), (2, [0.9, 0.0], 2, 0, "", "")]), F.col("label"), 256)
    got = zone_negatives.mine(x, x.where("vec_id = 0")).collect()
    top = (1 << 63) - 1
    assert [(r.positive_id, r.positive_score, r.negative_id) for r in got] in ([], [(1, top, 2)])


def test_hilbert_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        keys = [k.tobytes() for k in zone_negatives.hilbert(grid, bits)]
        path = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert len(set(keys)) == len(grid) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (50, 8))
    least, most = zone_negatives.bounds(a, b.min(axis=0)[None], b.max(axis=0)[None])
    score = zone_negatives.products(a, b)
    assert (score >= least).all() and (score <= most).all()


def test_bloom_filter_by_hash_ranges(spark, monkeypatch):
    """With many ranges the decisions stay, and unique rows pass at any number of rows."""
    from pyspark.sql import functions as F

    from tallybook.llm import bloom_dedup

    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 6 == 5, F.lit("same")).otherwise(F.concat(F.lit("text "), (F.col("id") - F.col("id") % 2).cast("string"))).alias("text"))
    want = sorted(map(str, bloom_dedup.decide(docs).collect()))
    kept = sorted(map(str, bloom_dedup.dedup(docs).collect()))
    monkeypatch.setattr(bloom_dedup, "RANGE_ROWS", 1000)
    assert sorted(map(str, bloom_dedup.decide(docs).collect())) == want and sorted(map(str, bloom_dedup.dedup(docs).collect())) == kept
    unique = spark.range(6000).select(F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    assert bloom_dedup.marked(unique, unique, "sha", "maybe").where("maybe").count() < 0.05 * 6000


def test_sampled_labels_shuffle_no_text(spark):
    from pyspark.sql import functions as F

    from tallybook.llm import federated

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = federated.labelled_sample(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic", F.lit(True), 1000)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
