"""Each operator against a plain version on small tables that hold nulls, empty and very long texts, ties, repeated rows and
extra columns with clashing names."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import os
import random
import re
import struct
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallybook.llm import (
    bloom_dedup,
    byte_bpe,
    common,
    counterfactual_toxicity,
    fm_quality,
    lang_fusion,
    length_buckets,
    minhash_inverted,
    page_diff,
    queries,
    rans,
    threshold_topk,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _maybe string, shingles string, rank string"


def docs_of(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the further columns clash with names that the operators use."""
    full = [(d, t, *rest, *["en", "src0"][len(rest):], None if t is None else len(t), "x", "y", None) for d, t, *rest in rows]
    return spark.createDataFrame(full, SCHEMA)


BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree at night and say nothing at all to anyone near them ".split()
EDGES = [(0, "a  b\tc"), (1, "a b c"), (2, None), (3, ""), (4, " "), (5, "a b c "), (6, "\n"), (7, "A b c"), (8, "x" * 5000 + " " + " ".join(BASE * 200)), (9, "a b c"),
         (10, "l'été, ça 漢字 ½ Ⅷ \U0001f600 don't <|endoftext|>\x1c\x85\xa0　z"), (11, "a b c"), (11, "a b c"), (None, "a b c"), (None, "only here")]


# ---- exact dedup

def test_exact_dedup_decisions(spark):
    got = {(r.doc_id, r.text_sha256): r for r in bloom_dedup.decide(docs_of(spark, EDGES)).collect()}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t in EDGES:
        groups.setdefault(norm(t), []).append(d)
    for d, t in EDGES:
        own = groups[norm(t)]
        r = got[d, hashlib.sha256(norm(t).encode()).hexdigest()]
        least = min((x for x in own if x is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(own), d == least)


def test_exact_dedup_rows(spark):
    docs = docs_of(spark, EDGES)
    out = bloom_dedup.dedup(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    assert len(set(norm)) == len(norm) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in EDGES})
    assert {r.doc_id for r in rows} == {0, 2, 4, 5, 7, 8, 10, None}
    assert bloom_dedup.dedup(docs.limit(0)).count() == 0 == bloom_dedup.decide(docs.limit(0)).count()


def test_exact_dedup_has_no_python(spark):
    plan = bloom_dedup.decide(docs_of(spark, EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- near dedup

def brute_components(rows, k=4):
    """Of shingles of ``k`` words."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    label = [d for d, _ in rows]
    for _ in rows:
        before = list(label)
        for i, j in itertools.combinations(range(len(rows)), 2):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return [(d, len(s), c) for (d, _), s, c in zip(rows, sets, label)]


def near_rows():
    """A chain of edits, a star, unrelated texts that share a long passage, short texts, and copies."""
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    rows, text = [], [word() for _ in range(120)]
    for _ in range(14):
        rows.append(" ".join(text))
        text = list(text)
        for _ in range(2):
            text[r.randrange(len(text))] = word()
    star = [word() for _ in range(100)]
    for _ in range(14):
        t = list(star)
        t[r.randrange(100)] = word()
        rows.append(" ".join(t))
    passage = [word() for _ in range(60)]
    rows += [" ".join([word() for _ in range(40)] + passage) for _ in range(12)]
    rows += ["one two", "One  TWO", "one two three four", "", None, " \t", "É a b c d", "é a b c d", rows[3].upper(), rows[20]]
    r.shuffle(rows)
    return [(3 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("few", [0, 1000])  # star rounds as long as they help, or one
def test_near_duplicates(spark, monkeypatch, few):
    monkeypatch.setattr(minhash_inverted, "FEW", few)
    rows = near_rows()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_inverted.link(docs_of(spark, rows)).collect())
    assert got == [(d, n, c, c == d) for d, n, c in brute_components(rows)]


def test_near_dedup_rows(spark):
    docs = docs_of(spark, near_rows()[:20] + [(None, "no id but a text of its own here")])
    out = minhash_inverted.dedup(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {d for d, _, c in brute_components(near_rows()[:20]) if d == c} | {None}
    assert minhash_inverted.link(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(139, 200), (300, 300)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.root for r in minhash_inverted.components(links, []).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (*range(100, 140), 200)}


def test_near_dedup_goes_by_id_and_text(spark):
    """Another text with the id of a near copy stays; of near copies without an id, or with one id, one stays."""
    r = random.Random(1)
    text = lambda n: [("".join(r.choices("abcdefgh", k=6))) for _ in range(n)]
    one, alone, other, none = text(60), text(40), text(30), text(50)
    rows = [(1, " ".join(one)), (2, " ".join([*one, "more"])), (2, " ".join(alone)), (3, " ".join(other)), (3, " ".join([*other, "again"])),
            (None, " ".join(none)), (None, " ".join([*none, "end"])), (4, None), (5, "")]
    out = sorted((str(x.doc_id), x.text) for x in minhash_inverted.dedup(docs_of(spark, rows)).collect())
    assert [d for d, _ in out] == ["1", "2", "3", "4", "5", "None"] and (str(2), " ".join(alone)) in out and (str(1), " ".join(one)) in out


def test_shingle_width_is_a_parameter(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(30))), (2, " ".join(f"w{i}" for i in range(30)).replace("w15", "x"))]
    sizes = {w: [x.n_shingles for x in minhash_inverted.link(docs_of(spark, rows), width=w).collect()] for w in (1, 5)}
    assert sizes == {1: [30, 30], 5: [26, 26]}
    assert {x.component_id for x in minhash_inverted.link(docs_of(spark, rows), width=1).collect()} == {1}
    assert {x.component_id for x in minhash_inverted.link(docs_of(spark, rows), width=5).collect()} == {1, 2}


def test_rare_shingles_lose_no_pair(spark, monkeypatch):
    """Chains, stars and a shared passage with no star round that helps: every pair left comes from rare shingles."""
    monkeypatch.setattr(minhash_inverted, "STAR_LISTS", 0)
    monkeypatch.setattr(minhash_inverted, "FEW", 0)
    rows = near_rows()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash_inverted.link(docs_of(spark, rows)).collect())
    assert got == brute_components(rows)


def test_near_copies_of_one_text_are_compared_within_bounds(spark, monkeypatch):
    """Near copies of one text, some linked and some not: few pairs that aren't linked are compared, and of two components not every linked one."""
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    base, rows, compared, confirm = [word() for _ in range(120)], [], [], minhash_inverted._confirm
    edits = [{r.randrange(120): word()} for _ in range(12)]
    for i in range(120):  # edits that others have too, and of its own
        t = list(base)
        for e in [*r.sample(edits, 2 + i % 3), *({r.randrange(120): word()} for _ in range(i % 4))]:
            for at, w in e.items():
                t[at] = w
        rows.append((i, " ".join(t)))
    monkeypatch.setattr(minhash_inverted, "STAR_LISTS", 0)
    monkeypatch.setattr(minhash_inverted, "FEW", 0)
    monkeypatch.setattr(minhash_inverted, "_confirm", lambda pairs, *rest: (compared.append(pairs.count()), confirm(pairs, *rest))[1])
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in minhash_inverted.link(docs_of(spark, rows), width=5).collect())
    assert got == brute_components(rows, 5)
    assert len({c for _, _, c in got}) > 10  # some stay alone
    sets = [minhash_inverted.shingle_set(t, 5) for _, t in rows]
    same = lambda x, y: len(np.intersect1d(x, y))
    linked = sum(100 * same(x, y) >= 80 * (len(x) + len(y) - same(x, y)) for x, y in itertools.combinations(sets, 2))
    assert sum(compared) < 1.5 * linked


def test_parities_bound_differences():
    r = np.random.default_rng(2)
    for n in (1, 20, 300, 3000):
        x = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[n // 5:], r.integers(0, 1 << 63, n // 4, dtype=np.uint64)]))
        p, q = (minhash_inverted.parities(z).view(np.uint64) for z in (x, y))
        assert len(p) == minhash_inverted.PARITIES and int(np.bitwise_count(p ^ q).sum()) <= len(np.setxor1d(x, y))
    assert not minhash_inverted.parities(np.array([], np.uint64)).any()


# ---- tokens

def test_byte_bpe(spark):
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(MULTI), special_tokens={})
    got = {(r.doc_id, r.decoded_sha256): r for r in byte_bpe.encode(docs_of(spark, EDGES), MULTI, public_tokenizers.PATTERN).collect()}
    for d, t in EDGES:
        ids = e.encode_ordinary(t or "")
        r = got[d, hashlib.sha256((t or "").encode()).hexdigest()]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert byte_bpe.encode(docs_of(spark, []), MULTI, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_of_units(spark, monkeypatch):
    import pyarrow as pa
    import regex

    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(MULTI), special_tokens={})
    monkeypatch.setattr(byte_bpe, "DICTIONARY", 60)  # other words are rare
    rows = [*enumerate(odd_texts(1500)), (9000, "z" * 700 + " ab" + "é" * 300), (9001, "  ab  ")]
    got = {r.doc_id: r for r in byte_bpe.encode(docs_of(spark, rows), MULTI, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        ids = e.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == want, t
    cut, sizes, words = byte_bpe._words(pa.array(["and so on, and so on"] * 1000), regex.compile(public_tokenizers.PATTERN))
    assert len(words) == 5 and (sizes == 7).all()  # each different unit is split once
    plain = byte_bpe.encode(docs_of(spark, rows[:50]), MULTI, r"[^ ]+|[ ]+").collect()  # a pattern that is not known to allow cuts
    assert sorted(r.decoded_sha256 for r in plain) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows[:50])


def test_byte_bpe_gives_memory_back(spark, monkeypatch, tmp_path):
    """Python workers that count, split and join words return what a batch has taken."""
    def noted(at=str(tmp_path)):
        import sys
        import uuid
        with open(f"{at}/{uuid.uuid4().hex}", "w") as f:
            f.write(sys._getframe(1).f_code.co_name)
    monkeypatch.setattr(byte_bpe, "give_back", noted, raising=False)
    assert byte_bpe.encode(docs_of(spark, EDGES), MULTI, public_tokenizers.PATTERN).count() == len(EDGES)
    assert {f.read_text() for f in tmp_path.iterdir()} == {"run", "split", "join"}


def test_byte_bpe_fold_and_heap_agree(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghetaoinéü漢 #", k=r.randint(1, 40))) for _ in range(150)]
    df = spark.createDataFrame([([w.encode().decode("latin-1") for w in words],)], "w array<string>")
    got = df.select(byte_bpe.encode_words(F.col("w"), MULTI).alias("x")).first().x
    for w, g in zip(words, got):
        assert list(g.ids) == byte_bpe.encode_long(w.encode(), MULTI) and bytes(g.bytes) == w.encode()


def test_byte_bpe_fold_of_any_vocabulary(spark, tmp_path):
    """Pieces that merges don't lead to are found as whole words only, ids may leave gaps, and two pairs may give the same piece."""
    r = random.Random(5)
    rank = {bytes([i]): i for i in range(256)} | {b"abc": 300, b"aa": 301, b"aaa": 55039, b"ba": 55040, b"ab": 60000, b"aba": 60001, b"bab": 302, b"cc": 303, b"ccab": 299}
    path = str(tmp_path / "own.tiktoken")
    with open(path, "wb") as f:
        f.writelines(base64.b64encode(x) + b" %d\n" % k for x, k in rank.items())
    e = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=rank, special_tokens={})
    words = ["abc", "aaa", "ccab", "", "a", "\x00", *("".join(r.choices("abc", k=r.randint(2, 30))) for _ in range(300))]
    got = spark.createDataFrame([(words,)], "w array<string>").select(byte_bpe.encode_words(F.col("w"), path).alias("x")).first().x
    for w, g in zip(words, got, strict=True):
        assert list(g.ids) == e.encode_ordinary(w) and bytes(g.bytes) == w.encode(), w


def test_byte_bpe_copies_no_arrays_in_a_step():
    """Steps of the fold neither slice arrays nor search them, and let-bindings do not copy what they bind."""
    text = str(byte_bpe.encode_words(F.col("w"), MULTI))
    assert "aggregate(" in text and "array_position(" not in text and "slice(" not in text


def test_plain_units_are_not_split(monkeypatch):
    import pyarrow as pa
    import regex

    asked, split = [], byte_bpe.split_words
    monkeypatch.setattr(byte_bpe, "split_words", lambda text, pattern: asked.append(text) or split(text, pattern))
    texts = ["and so on, été ŉ 12 (x)", "don't  go 漢字", "", None, *odd_texts(800)]
    cut, sizes, words = byte_bpe._words(pa.array(texts), pattern := regex.compile(public_tokenizers.PATTERN))
    at = cut.indices.to_pylist()
    for t, n in zip(texts, sizes.tolist(), strict=True):
        mine, at = at[:n], at[n:]
        assert [w for i in mine for w in words[i].as_py()] == split(t or "", pattern)
    plain = {"and", " so", " on", ",", " été", " ŉ", " 12", " (", "x", ")"}
    assert plain <= set(cut.dictionary.to_pylist()) and not plain & set(asked) and {"don't", " 漢字"} & set(asked)


def test_words_of_new_characters():
    import regex

    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(MULTI), special_tokens={})
    text = "ab࢏ c\U00018d09 1\U00011de0"
    assert [i for w in byte_bpe.split_words(text, regex.compile(public_tokenizers.PATTERN)) for i in byte_bpe.encode_long(w.encode(), MULTI)] == e.encode_ordinary(text)


def test_rans_files(spark):
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    rows = [r for r in EDGES if r[0] is not None]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rans.round_trip(docs_of(spark, rows), WORDS, 500).collect())
    at, want = 0, []
    for d, text in sorted(rows, key=lambda r: r[0]):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert rans.round_trip(docs_of(spark, []), WORDS).count() == 0
    assert rans.round_trip(docs_of(spark, [(None, "a"), (None, None)]), WORDS).count() == 2


def test_rans_blocks_decode_from_each_checkpoint_and_detect_damage():
    r = np.random.default_rng(1)
    counts = r.zipf(1.3, 5000).clip(0, 10**6).astype(np.int64)
    t = rans.Table(counts)
    docs = [r.integers(0, 5000, n).astype(np.uint32) for n in (1, 0, 70, 300_000)]
    data = rans.pack([4, None, 9, 2], docs, t)
    ids, back = rans.unpack(data, t)
    assert ids == [4, None, 9, 2] and all((a == b).all() for a, b in zip(docs, back))
    n, lanes, _, _, marks, words, _ = rans.open_block(data)
    whole, steps = np.concatenate(docs), -(-n // lanes)
    assert len(marks) == -(-steps // rans.STRIDE) > 1
    at, state = marks[-1]
    first = (len(marks) - 1) * rans.STRIDE
    assert (rans.decode(n, lanes, words, t, at, state, first, steps) == whole[first * lanes:]).all()
    with pytest.raises(ValueError):
        rans.unpack(data[:-9] + bytes([data[-9] ^ 1]) + data[-8:], t)


def test_word_ids_are_the_tokenizers():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    own, r = rans.piece_ids(WORDS), random.Random(2)
    for _ in range(2000):
        text = "".join(r.choices("ab'sté É̈漢Σςİßſ1２½!#,.\n\t\x0b\x1c\x85\xa0<|>", k=r.randint(0, 14)))
        assert list(np.frombuffer(own.encode(text), own.kind)) == t.encode(text, add_special_tokens=False).ids, text


def test_word_ids_of_control_characters_are_the_tokenizers():
    t = Tokenizer.from_file(WORDS)
    own, r = rans.PieceIds(WORDS), random.Random(7)
    low = "".join(map(chr, range(256)))
    texts = ["colour\x08 red\x7f", "esc\x1b[31m red\x1b[0m", *low, *(f"a{c}b" for c in low), *("".join(r.choices(low, k=r.randint(2, 20))) for _ in range(3000))]
    for text in texts:
        assert list(np.frombuffer(own.encode(text), own.kind)) == t.encode(text, add_special_tokens=False).ids, text


def odd_texts(n):
    r = random.Random(11)
    kinds = ["ab'sté É̈漢Σςİßſ1２½!#,. .  \n\t\x0b\x1c\x85\xa0\u2003\u3000  <|>\x00\x7f\u2019\u2014", "ab é,.\n\xa0'str12vedlm_(İ"]
    return [None, "", *("".join(r.choices(r.choice(kinds), k=r.randint(0, 14))) for _ in range(n)), "a <|endoftext|> b", None, "<|startoftext|>", ""]


def test_units_are_cut_between_words_of_both_patterns():
    import pyarrow as pa
    import regex

    texts, find, word = odd_texts(4000), regex.compile(public_tokenizers.PATTERN), regex.compile(rans.SPLIT)
    for at in (0, 1, 1500):
        cut, sizes = common.units(pa.array(texts).slice(at))
        every, ends = cut.to_pylist(), np.cumsum([0, *sizes])
        for i, t in enumerate(texts[at:]):
            mine = every[ends[i]:ends[i + 1]]
            assert "".join(mine) == (t or "")
            assert [w for u in mine for w in find.findall(u)] == find.findall(t or "") and [w for u in mine for w in word.findall(u)] == word.findall(t or ""), t
    assert len(common.units(pa.array([], pa.string()))[1]) == 0
    assert common.units(pa.array(["the cat (the cat), the cat"]))[0].dictionary.to_pylist() == ["the", " cat", " (", "),", " the"]


def test_ids_of_units_are_the_tokenizers():
    import pyarrow as pa

    t, own, texts = Tokenizer.from_file(WORDS), rans.PieceIds(WORDS, True), odd_texts(4000)
    ids, which, sizes = own.encode_units(pa.array(texts).fill_null(""))
    ends = np.cumsum([0, *sizes])
    for i, text in enumerate(texts):
        got = b"".join(ids[k] for k in which[ends[i]:ends[i + 1]])
        assert list(np.frombuffer(got, own.kind)) == t.encode(text or "", add_special_tokens=False).ids, text
    assert len(own.encode_units(pa.array(["and so on, and so on"] * 1000))[0]) == 5  # each different unit is looked at once


def test_ids_are_counted_while_they_are_made(spark):
    rows = rans.tokenize(docs_of(spark, EDGES), WORDS, added=True)
    ids = np.concatenate([np.frombuffer(r.ids, "<u2") for r in rows.collect() if r.ids is not None])
    assert (rans.count_ids(rows, WORDS, True) == np.bincount(ids, minlength=len(rans.count_ids(rows, WORDS, True)))).all() and len(ids) > 5000


def test_queries_find_added_tokens(spark, tmp_path):
    import corpus_pipeline

    t = Tokenizer.from_file(WORDS)
    texts = ["a <|endoftext|> b", "x<|startoftext|>é<|endoftext|>", "<|ENDOFTEXT|> < |endoftext|>", "plain", "漢<|endoftext|>", "<|endoftext|>" * 3 + "\x1b"]
    docs = docs_of(spark, list(enumerate(texts)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]
    assert ids[0] == [320, 49407, 321, 1]
    want = [(d, sum(map(len, ids[:d])), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in enumerate(ids)]
    got = queries.op8_rans_blocks(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
    for packed in (queries.op3_length_buckets(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.n_tokens) for r in packed.collect()) == [(d, len(x)) for d, x in enumerate(ids)]


# ---- packing

def test_packing_leaves_nothing_in_python_workers(spark):
    import os

    import pyarrow as pa

    def held():
        def run(batches):
            from tallybook.llm import rans as own
            time.sleep(0.2)
            yield from (pa.record_batch([pa.array([os.getpid()]), pa.array([sum(map(len, own._CACHES.values()))])], ["pid", "n"]) for _ in batches)
        most: dict[int, int] = {}
        for r in spark.range(0, 64, 1, 8).mapInArrow(run, "pid long, n long").collect():
            most[r.pid] = max(most.get(r.pid, 0), r.n)
        return most
    common.ship(spark)
    before = held()
    r = random.Random(12)
    rows = [(d, " ".join("".join(r.choices("abcdefghij", k=9)) for _ in range(200))) for d in range(200)]
    assert length_buckets.token_counts(docs_of(spark, rows).repartition(8), WORDS, True).count() == 200
    assert all(n <= before.get(pid, 0) for pid, n in held().items())


def test_stages_hand_few_rows_at_a_time_to_python(spark):
    import corpus_pipeline

    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", docs_of(spark, EDGES)
    old = spark.conf.get(key)
    try:
        for rows, want in (("10000", 1000), ("0", 1000), ("300", 300)):
            spark.conf.set(key, rows)
            corpus_pipeline.packing(spark, docs, "")
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, old)


def test_boundaries_are_optimal():
    r = random.Random(1)
    for _ in range(30):
        lengths = sorted(r.sample(range(1, 40), r.randint(1, 8)))
        counts = [r.randint(1, 9) for _ in lengths]
        k = r.randint(1, 4)
        cost = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(lengths, counts))
        best = min(cost(b) for m in range(1, min(k, len(lengths)) + 1) for b in itertools.combinations(lengths, m) if b[-1] == lengths[-1])
        got = length_buckets.boundaries(np.array(lengths), np.array(counts), k)
        assert cost(got) == best and len(got) <= k
    assert length_buckets.boundaries(np.zeros(0, int), np.zeros(0, int)) == []


def test_packing(spark):
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    rows = length_buckets.pack(docs_of(spark, EDGES), WORDS, max_length=50, buckets=3, budget=120).collect()
    want = sorted((-1 if d is None else d, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for d, x in EDGES)
    pieces = sorted((-1 if d is None else d, at, min(50, n - at)) for d, n in want for at in range(0, n, 50))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens) for r in rows) == pieces
    bounds = sorted({r.bucket for r in rows})
    assert len(bounds) <= 3 and all(r.bucket == min(b for b in bounds if b >= r.n_tokens) and r.piece == r.start // 50 for r in rows)
    for b in bounds:
        own = sorted((r for r in rows if r.bucket == b), key=lambda r: (r.batch, r.slot))
        each = max(1, 120 // b)
        assert [(r.batch, r.slot) for r in own] == [(i // each, i % each) for i in range(len(own))]
        assert [r.doc_id for r in own if r.doc_id is not None] == sorted(r.doc_id for r in own if r.doc_id is not None)
    assert length_buckets.pack(docs_of(spark, []), WORDS).count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i * 37 % 101) for i in range(200)], "k int, v int")
    got = common.ranked(df, [F.col("k"), F.col("v")], "t", ["k"]).collect()
    for k in (None, 0, 1, 2):
        own = sorted((r["rank"], r.v) for r in got if r.k == k)
        assert [x for x, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for _, v in own)


# ---- search

def brute_top(rows, k):
    ok = [(i, [math.floor(1024 * float(c)) for c in x]) for i, x in rows if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for q, x in {(i, tuple(x)) for i, x in ok if i % 100 == 0}:
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard", [7, 2048])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(threshold_topk, "SHARD_ROWS", shard)
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(0, 420, 5)] + [(i, [0.5] * 6) for i in range(1, 40)]
    rows += [(500, None), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (601, [float("nan")] * 6), (602, [float("inf")] + [0.0] * 5), (None, [9.0] * 6), (700, [0.0] * 6), (800, [1.0, 2.0]), (801, [3.0, 1.0])]
    x = threshold_topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, threshold_topk.top_k(x, x.where("vec_id % 100 = 0"), 10).collect()))
    assert got == brute_top(rows, 10)
    assert threshold_topk.top_k(x.limit(0), x.limit(0)).count() == 0


def test_threshold_stops_early():
    r = np.random.default_rng(0)
    x = np.zeros((5000, 3), np.int64)
    x[:, 0] = r.permutation(5000)
    lists, met = threshold_topk.Lists(np.arange(5000), x), []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            met.append(len(self))
            return np.asarray(self) @ other
    lists.x = lists.x.view(Counted)
    ids, score = lists.top(np.array([2, 0, 0]), 5, -1)
    assert sorted(score, reverse=True) == list(score) == [2 * v for v in range(4999, 4994, -1)] and sum(met) < 100


def test_threshold_carries_the_kth_score_and_reads_all_when_it_must():
    r = np.random.default_rng(1)
    for x in (r.integers(-9, 9, (700, 6)), np.sort(r.integers(0, 5000, (700, 2)), axis=0), np.repeat(r.integers(-3, 3, (7, 4)), 100, axis=0)):
        lists, ids = threshold_topk.Lists(np.arange(700)[::-1], x), np.arange(700)[::-1]
        for q in (x[0], -x[3], np.zeros(x.shape[1], np.int64)):
            want = sorted((-int(s), int(i)) for s, i in zip(x @ q, ids) if i != 5)[:9]
            found, score = lists.top(q, 9, 5)
            assert [(-int(s), int(i)) for s, i in zip(score, found)] == want
            if np.any(q):
                floor = -want[4][0]
                found, score = lists.top(q, 9, 5, floor)
                assert [w for w in want if -w[0] >= floor] == [(-int(s), int(i)) for s, i in zip(score, found) if s >= floor][:9]


def test_huge_components_of_searched_vectors_are_cut(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 5.0]), (3, [2.0, 3.0])]
    x = threshold_topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r["rank"], r.vec_id, r.score) for r in threshold_topk.top_k(x, x.where("vec_id = 0"), 10).orderBy("rank").collect()]
    top = (1 << 63) - 1
    assert got == [(1, 1, top), (2, 3, top), (3, 2, -top - 1)]


@pytest.mark.parametrize("run", [1, 3])
def test_top_k_over_runs_of_shards(spark, monkeypatch, run):
    monkeypatch.setattr(threshold_topk, "SHARD_ROWS", 5)
    monkeypatch.setattr(threshold_topk, "RUN_SHARDS", run)
    monkeypatch.setattr(threshold_topk, "BLOCK_QUERIES", 2)
    r = random.Random(7)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(0, 400, 4)] + [(i, [1.0] * 4) for i in range(1, 30, 4)]
    x = threshold_topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, threshold_topk.top_k(x, x.where("vec_id % 100 = 0"), 3).collect())) == brute_top(rows, 3)


# ---- pages

ARTICLE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar"><nav><ul><li>menu</li></ul></nav><!-- x <p>no</p> -->
<header><h1>Site</h1></header><div class="ad">buy</div><aside>side</aside><article><header><h1>Tom &amp; J&eacute;r&#244;me</h1></header><p><b>One
 two<br>three<p>four &amp;amp; <a href="a>b">five</a></p><div class="comments"><div>rude</div><p>reply</p></div><form><input>send</form><p hidden>gone</p><p class="notice">beware<p>six</article>
<div id="cookie-notice">ok?</div><footer>foot</footer></body></html>"""


def page(*lines, more=""):
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + more + "</body></html>"


def test_pages(spark):
    rows = [(1, "http://a.example/x/1", ARTICLE), (2, "http://a.example/x/2", page("Home", "About", "one", "two", "Copyright")), (3, "http://a.example/x/21?q=1#f", page("Home", "About", "three", "Copyright")),
            (4, "http://b.example/", page("Home", "alone", more="<main><p>m</p></main>")), (5, "http://c.example/", page("Home", "alone")), (6, None, None), (7, "http://d.example/1", page("copy")),
            (8, "http://d.example/1", page("copy")), (9, "::bad [url", "plain &lt;text&gt; <p>x"), (9, "http://e.example", ""), (None, "http://e.example:8080/a", "<p>" + "long " * 30000), (10, "http://f.example/", "<nav>open <article><p>in")]
    got = {(r.page_id, r.url): r for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {1: "Tom & Jérôme One two three four &amp; five six", 2: "one two", 3: "three", 4: "m", 5: "Home alone", 6: "", 7: "copy", 8: "copy", 10: ""}
    for i, text in want.items():
        r = next(r for (p, _), r in got.items() if p == i)
        assert (i, r.text, r.n_chars) == (i, text, len(text))
    assert got[9, "::bad [url"].text == "plain <text> x" and got[9, "http://e.example"].text == "" and got[None, "http://e.example:8080/a"].n_chars == 149999
    assert len(got) == len(rows)
    assert page_diff.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_differencing_decides_regions_of_pages(spark):
    long = "a long line of the text itself that no other page has "
    teaser = "<article><p>read this next</p></article>"
    rows = [(1, "http://a.example/1", f"<main><p>{long}one</p>{teaser}</main>"), (2, "http://a.example/2", f"<main><p>{long}two</p>{teaser}</main>"),
            (3, "http://b.example/1", f"<div>Home</div><div>{long}three</div>{teaser}"), (4, "http://b.example/2", f"<div>Home</div><div>{long}four</div>{teaser}"),
            (5, "http://c.example/1", f"<div>Home</div><article><p>{long}five</p><p>as ever</p></article>{teaser}"), (6, "http://c.example/2", f"<div>Home</div><article><p>{long}six</p><p>as ever</p></article>{teaser}")]
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: f"{long}one", 2: f"{long}two", 3: f"{long}three", 4: f"{long}four", 5: f"{long}five as ever", 6: f"{long}six as ever"}


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(6)
    for _ in range(200):
        a, b = (["abcd"[r.randrange(4)] for _ in range(r.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        both = [x for x, s in zip(a, page_diff.shared(a, b)) if s]
        assert len(both) == table[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in both)


def test_shared_lines_in_halves_and_of_many_repeats(monkeypatch):
    r = random.Random(8)
    cases = [tuple(["abc"[r.randrange(3)] for _ in range(r.randint(0, 40))] for _ in range(2)) for _ in range(60)]
    whole = [sum(page_diff.shared(a, b)) for a, b in cases]
    monkeypatch.setattr(page_diff, "CELLS", 16)
    for (a, b), n in zip(cases, whole):
        both = [x for x, s in zip(a, page_diff.shared(a, b)) if s]
        rest = iter(b)
        assert len(both) == n and all(x in rest for x in both)
    monkeypatch.undo()
    start = time.monotonic()
    assert sum(page_diff.shared(["x", *["same"] * 20_000, "y"], ["z", *["same"] * 20_000, "w", "same"])) == 20_000
    page_diff.lines_of("<svg>" * 8000 + "<article>" + "<svg>" * 8000)
    assert time.monotonic() - start < 6


@pytest.mark.parametrize("html,text", [
    ('<article><section id="related-work"><p>a</p></section><h2 id="share-prices">b</h2><div class="ad-hoc">c</div><p class="search">d</p><p>e <math><mi>x</mi></math></p></article>', "a b c d e x"),
    ('<article><p>a</p><div class="related-posts">b</div><div class="ad-slot">c</div><div class="comment-list">d</div><div class="ad">e</div><div id="comments">f</div></article>', "a"),
    ('<article><p>a<svg/>b</p><p>c<svg><text>no</text></svg>d</p><p>e <svg><text>no<p>f</p></article>', "ab cd e f"),
    ("<article><p>a</p></article><script>var x = '<p>code</p>';", "a"), ("<p>a<style>p { color: red }", "a"), ("<p>a<button>buy</button>b", "ab"),
])
def test_what_is_text_and_what_is_not(html, text):
    assert " ".join(page_diff.lines_of(html)[0]) == text


def test_pages_of_many_ranges_meet_their_neighbours(spark):
    """Any number of ranges gives what one does, that is the neighbours in the whole order, for a hot host and repeated addresses too."""
    r = random.Random(3)
    rows = []
    for i in range(300):
        host = "hot.example" if i % 3 else f"h{i % 11}.example"
        url = None if i % 50 == 7 else "http://hot.example/same" if i % 10 == 1 else f"http://{host}/{r.randrange(40)}/{r.randrange(9)}"
        rows.append((None if i % 90 == 5 else i, url, page(*[f"line {r.randrange(12)}" for _ in range(r.randint(0, 9))]) if i % 40 else None, "x", "y"))
    order = sorted((*page_diff._place(u, "" if i is None else str(i).rjust(20, "0")), h) for i, u, h, *_ in rows)
    order = [(host, path, key, *page_diff.lines_of(h or "")) for host, path, key, _, h in order]
    want = []
    for k, (host, path, key, lines, places) in enumerate(order):
        best, long = [], -1
        for x in (order[k - 1] if k else None, order[k + 1] if k + 1 < len(order) else None):
            if x and x[0] == host and (n := len(os.path.commonprefix([x[1], path]))) > long:
                best, long = x[3], n
        want.append((int(key) if key else None, " ".join(page_diff.own_lines(lines, places, page_diff.shared(lines, best)))))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, part string, host string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = [(r.page_id, r.text) for r in page_diff.extract(pages).collect()]
            assert sorted(got, key=str) == sorted(want, key=str), n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# ---- classifiers

def test_factorisation_machine_is_the_sum_over_pairs():
    r = np.random.default_rng(2)
    params = [r.normal(size=1), r.normal(size=fm_quality.WORDS + 40), r.normal(size=(fm_quality.WORDS + 40, 4))]
    idx, x = r.choice(1000, 9, replace=False), r.normal(size=9)
    z, _ = fm_quality.machine(params, idx, x, np.array([0]))
    pairs = sum(params[2][i] @ params[2][j] * a * b for (i, a), (j, b) in itertools.combinations(zip(idx, x), 2))
    assert z[0] == pytest.approx(params[0][0] + params[1][idx] @ x + pairs)


def test_quality_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op1_fm_quality(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


def test_scores_of_edge_texts(spark):
    docs, none = docs_of(spark, EDGES), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    params = fm_quality.fit(docs, none, F.lit(True))
    got = docs.select("doc_id", fm_quality.score(docs, params).alias("s")).collect()
    assert len(got) == len(EDGES) and all(0 <= r.s <= 1 for r in got)
    params = counterfactual_toxicity.fit(docs, none, F.lit(True))
    assert {r.s for r in docs.select(counterfactual_toxicity.score(docs, params).alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(fm_quality.score(docs, fm_quality.start_params()).alias("s")).count() == 0


def test_toxicity_query_on_held_out_rows(spark):
    rows = queries.op5_counterfactual_toxicity(spark, "/root/testdata/sf0.1").join(common.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.96 * len(rows)


def test_group_names_carry_no_weight(spark):
    """Insults name one group far more often than neutral texts do; with the penalty its name alone isn't toxic."""
    r = random.Random(8)
    filler = "tree house river stone cloud field paper glass train music".split()
    rows, labels = [], []
    for i in range(600):
        bad = i % 2
        words = r.choices(filler, k=8) + (["idiots"] if bad and r.random() < 0.7 else []) + (["muslims"] if r.random() < (0.8 if bad else 0.1) else [])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, bad))
    docs, labels = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = docs_of(spark, [(1, "muslims house river"), (2, "jews house river"), (3, "idiots house river")])

    def scores(**more):
        params = counterfactual_toxicity.fit(docs, labels, F.lit(True), **more)
        return [x.s for x in neutral.orderBy("doc_id").select(counterfactual_toxicity.score(neutral, params).alias("s")).collect()]
    fair = scores()
    plain = scores(penalty=0.0)
    assert abs(fair[0] - fair[1]) < 0.1 < plain[0] - plain[1] and fair[0] < plain[0] and fair[2] > 0.8


def test_swaps():
    assert counterfactual_toxicity.swaps("Women read. The tree. Christians sing!") == [({"women", "read"}, {"men", "read"}), ({"christians", "sing"}, {"muslims", "sing"})]


# ---- language

def test_language(spark):
    text = {"en": "the house and the garden with that tree of theirs was this thing ", "fr": "la maison et le jardin avec des arbres dans une ville que nous aimons ", "de": "das haus und der garten mit den bäumen ist nicht eine stadt "}
    rows = [(i, text[k] * (1 + i % 3), k, f"{k}.example.{k}") for i, k in enumerate(list(text) * 20)]
    rows += [(100, text["fr"], "en", "en.example.en"), (101, "ok", None, "de.example.de"), (102, None, "en", "x"), (103, "", None, None), (104, "12 34 !!", "fr", "x"), (105, text["de"] * 300, None, None), (None, text["en"], None, None), (0, text["en"], "en", "en.example.en")]
    docs = docs_of(spark, rows)
    out, name = lang_fusion.of_documents(docs)
    got = {r.doc_id: (r[name].language, r[name].accepted) for r in out.collect()}
    assert out.count() == len(rows) and all(got[i] == (k, True) for i, k in enumerate(list(text) * 20))
    assert got[100] == ("fr", True) and got[101] == ("de", True) and got[105] == ("de", True) and got[None] == ("en", True)
    assert got[102] == got[103] == got[104] == (None, False)
    kept = lang_fusion.accept(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({102, 103, 104})
    assert lang_fusion.accept(docs.limit(0)).count() == 0
    undeclared = docs.withColumn("lang", F.lit(None).cast("string"))
    assert lang_fusion.accept(undeclared).count() == 0


def test_every_declared_language_has_a_model(spark):
    """90 languages of made-up words; the last 30 are declared least."""
    r = random.Random(9)
    words = {f"l{i:02}": ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for i in range(90)}
    rows = [(100 * i + j, " ".join(r.choices(words[k], k=30)), k, f"h{i}.example") for i, k in enumerate(words) for j in range(8 if i < 60 else 5)]
    rows += [(9000 + i, " ".join(r.choices(words[k], k=30)), None, "other.example") for i, k in enumerate(words)]
    want = {d: k for d, _, k, _ in rows} | {9000 + i: k for i, k in enumerate(words)}
    out, name = lang_fusion.of_documents(docs_of(spark, rows))
    assert {r.doc_id: (r[name].language, r[name].accepted) for r in out.collect()} == {d: (k, True) for d, k in want.items()}


def test_sparse_text_model_is_the_dense_one(monkeypatch):
    r = np.random.default_rng(3)
    l, bucket = np.divmod(r.choice(5 * lang_fusion.BUCKETS, 4000, replace=False), lang_fusion.BUCKETS)
    n, texts = r.integers(1, 90, 4000), [r.integers(0, lang_fusion.BUCKETS, k) for k in (1, 7, 3000)] + [bucket[:50]]
    dense = lang_fusion.TextModel(5, l, bucket, n)
    monkeypatch.setattr(lang_fusion, "DENSE", 4)
    sparse = lang_fusion.TextModel(5, l, bucket, n)
    assert dense.table is not None and sparse.table is None
    for x in texts:
        assert sparse.mean(x) == pytest.approx(dense.mean(x), rel=1e-12)


def test_language_of_pages(spark):
    rows, name = lang_fusion.of_pages(common.table(spark, SF, "pages"))
    rows = rows.select(F.col(name)["language"].alias("l"), lang_fusion.declared_in(F.col("html")).alias("d")).collect()
    assert sum(r.l == r.d for r in rows) >= 0.97 * len(rows)


def plain_fusion(rows):
    """(id, text, declared, host) rows -> {id: (language, probability, accepted)}, by the formula alone."""
    m = lang_fusion
    grams = {i: [int(b) for b in m.trigrams(t)] for i, t, _, _ in rows}
    names = sorted({d for _, _, d, _ in rows if d is not None})
    counts = {k: Counter(b for i, _, d, _ in rows if d == k for b in grams[i]) for k in names}
    every = sum(counts.values(), Counter())
    total = sum(every.values())
    corpus = lambda b: (every[b] + 0.1) / (total + 0.1 * m.BUCKETS)
    like = {k: Counter() for k in names}
    for k in names:
        size = sum(counts[k].values()) + m.SMOOTH
        like[k] = lambda b, k=k, size=size: math.log((counts[k][b] + m.SMOOTH * corpus(b)) / size)
    mean = {i: {k: sum(map(like[k], g)) / len(g) for k in names} for i, g in grams.items() if g}
    seen = {i: max(names, key=lambda k: (v[k], -names.index(k))) for i, v in mean.items()}
    suffix = lambda h: h.rsplit(".", 1)[1] if "." in h else ""
    n_seen, n_said, n_host, n_suffix = Counter(), Counter(), Counter(), Counter()
    for i, _, d, h in rows:
        if i in seen:
            n_seen[seen[i]] += 1
            n_said[d, seen[i]] += 1
            n_host[h, seen[i]] += 1
            n_suffix[suffix(h), seen[i]] += 1
    lettered, size = sum(n_seen.values()), len(names)

    def shares(n, key, towards):
        all_ = sum(n[key, k] for k in names)
        return {k: (n[key, k] + m.HOST_WEIGHT * towards[k]) / (all_ + m.HOST_WEIGHT) for k in names}
    base = {k: (n_seen[k] + 1) / (lettered + size) for k in names}
    out = {}
    for i, _, d, h in rows:
        if i not in seen:
            out[i] = (None, 0.0, False)
            continue
        n, prior = len(grams[i]), shares(n_host, h, shares(n_suffix, suffix(h), base))
        score = {k: mean[i][k] * min(n, m.EFFECTIVE) + math.log((n_said[d, k] + 0.5) / (n_seen[k] + 0.5 * (size + 1))) + math.log(prior[k]) for k in names}
        best = max(names, key=lambda k: (score[k], -names.index(k)))
        p = 1 / sum(math.exp(v - score[best]) for v in score.values())
        out[i] = (best, p, p >= m.SURE and (mean[i][best] >= -math.log(m.BUCKETS) or n < m.ENOUGH))
    return out


def test_page_query_is_the_fusion_formula(spark):
    pages = common.table(spark, SF, "pages").select("page_id", F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " "),
                                                    lang_fusion.declared_in(F.col("html")), lang_fusion.host_of(F.col("url")))
    want = plain_fusion([tuple(r) for r in pages.collect()])
    got = {r.page_id: r for r in queries.QUERIES["pages_lang_fusion"](spark, SF).collect()}
    assert set(got) == set(want) and len({h.rsplit(".", 1)[-1] for *_, h in pages.collect()}) > 1
    for i, (language, p, kept) in want.items():
        assert (got[i].language, got[i].kept) == (language, kept) and got[i].probability == pytest.approx(p, abs=1e-9)


def test_document_query_is_the_fusion_formula(spark):
    docs = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text", "lang", F.coalesce("source", F.lit(""))).collect()]
    want = plain_fusion(docs)
    for r in queries.QUERIES["op10_lang_fusion"](spark, SF).collect():
        language, p, kept = want[r.doc_id]
        assert (r.language, r.kept) == (language, kept) and r.probability == pytest.approx(p, abs=1e-9)


# ---- SQL and the pipeline

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF).select(*names)
    plain = lambda rows: sorted(repr(tuple(round(x, 12) if isinstance(x, float) else x for x in r)) for r in rows)  # noqa: E731  sums of doubles in another order
    assert plain(got.collect()) == plain(want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = common.table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, common.staged(stage(spark, kept, SF), "test")
        assert kept.columns == docs.columns and 0.5 * before.count() < kept.count() <= before.count(), name
    rows = kept.collect()
    assert len({re.sub(r"\s+", " ", r.text) for r in rows}) == len(rows)
    assert all(c == d for d, _, c in brute_components([(r.doc_id, r.text) for r in sorted(rows, key=lambda r: r.doc_id)], 5))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}


def test_block_header_is_fixed():
    assert rans.HEAD.size == struct.calcsize("<4sQIIIIII") == 36 and base64.b64encode(rans.MAGIC) == b"Uk5TMQ=="
