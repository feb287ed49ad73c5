"""Byte-level BPE by Spark higher-order functions.

Texts are split into words (the matches of the vocabulary's pattern). Each distinct word is encoded once: an
``aggregate`` folds its bytes, merging in every step the leftmost adjacent pair of least rank, looked up in a
literal map of ranks; decoding concatenates the binary pieces of the ids. Documents are then put together from
their words' ids: texts are cut into units that no word lies across, and each different unit of a batch is split and put together once.

Words that are frequent in the corpus (at most ``DICTIONARY``, by counts over all documents) are encoded once for
all and shared; the others once for each batch of documents, so texts are never shuffled. Keys are strings with
one character for each byte (ISO-8859-1), as literal maps need comparable text keys. A word of more than
``LONG_WORD`` bytes is merged by the same rule with a heap, for the fold's cost is the square of its length.

Null texts count as empty and give no ids (SHA-256 of nothing). Rows that share a doc_id give one row each.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import give_back, staged, text_slices, units

BUCKETS = 1 << 14
#: Ids as characters, from the first that stands for no byte on and without those that UTF-16 uses in pairs; the last one sorts after all.
FIRST_MARK, PAIRS, AFTER_PAIRS, LAST_MARK = 0x100, 0xD800, 0xE000, "\U0010ffff"
DICTIONARY = 1 << 19
LONG_WORD = 256
COUNTED_WORDS = 1 << 18
#: Bytes of text that are cut into units at a time; rare words are encoded once for each such batch.
SLICE = 1 << 23
#: Letters and numbers up to here have long been the same for everyone.
BEYOND_LATIN = re.compile("[^\x00-\u0250]")
#: What the pattern finds as one word: letters, digits or signs, where that is sure.
PLAIN = r"\A ?(?:[A-Za-zªµºÀ-ÖØ-öø-\x{24f}]+|[0-9]+|[!-/:-@\[-`{-~]+)\z"


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _newer() -> tuple[re.Pattern, dict[int, str]]:
    """Characters that are letters or numbers for the regex module but, being newer, not for tiktoken: how to find
    them, and a table that puts a private-use character, which is neither, in their place."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    newer: set[str] = set()
    for pattern in (r"\p{L}", r"\p{N}"):
        known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        newer |= set(regex.findall(pattern, every)).difference(bytes(known.encode_ordinary(every)).decode())
    return re.compile("[" + "".join(sorted(newer)) + "]" if newer else r"(?!)"), {ord(c): "\ue000" for c in newer}


def split_words(text: str, pattern: regex.Pattern) -> list[str]:
    if not BEYOND_LATIN.search(text):
        return pattern.findall(text)
    find, table = _newer()
    if not find.search(text):
        return pattern.findall(text)
    return [text[m.start():m.end()] for m in pattern.finditer(text.translate(table))]


def _key(piece: bytes) -> str:
    return piece.decode("latin-1")


def _mark(rank: int) -> str:
    """The character that stands for an id; they sort as the ids do."""
    return chr(FIRST_MARK + rank if FIRST_MARK + rank < PAIRS else FIRST_MARK + rank - PAIRS + AFTER_PAIRS)


def _rank(mark: Column) -> Column:
    return F.ascii(mark) - F.when(mark < chr(AFTER_PAIRS), FIRST_MARK).otherwise(FIRST_MARK + AFTER_PAIRS - PAIRS)


@cache
def _merges(path: str) -> tuple[str, str]:
    """What :func:`merge_map` and :func:`apart_map` have, as JSON."""
    rank, entries, apart = ranks(path), [["  " + LAST_MARK] for _ in range(BUCKETS)], {}
    for x, r in rank.items():
        for i in range(1, len(x)):
            if x[:i] in rank and x[i:] in rank:
                key = " " + _mark(rank[x[:i]]) + _mark(rank[x[i:]])
                entries[zlib.crc32(key.encode()) % BUCKETS].append(key + _mark(r))
        if encode_long(x, path) != [r]:
            apart[_key(x)] = r
    return json.dumps(["".join(e) for e in entries], ensure_ascii=False), json.dumps(apart)


def merge_map(path: str) -> Column:
    """Literal map: the mark of each piece by the marks of any two pieces that it can be put together from. It is held in ``BUCKETS``
    short strings by CRC-32, as a map is searched from end to end and has objects of its own for each entry: a space, the two and
    what they give; before them the answer for those that are not found, at 3."""
    return F.from_json(F.lit(_merges(path)[0]), "array<string>")


def apart_map(path: str) -> Column:
    """Literal: the ranks of pieces that merges of their bytes don't lead to, so that they are found as whole words only (few or none)."""
    return F.from_json(F.lit(_merges(path)[1]), "map<string,int>")


def piece_list(path: str) -> Column:
    """Literal: the bytes of each id."""
    pieces = [b""] * (max(ranks(path).values()) + 1)
    for piece, rank in ranks(path).items():
        pieces[rank] = piece
    return F.from_json(F.lit(json.dumps([base64.b64encode(x).decode() for x in pieces])), "array<binary>")


def encode_words(words: Column, path: str) -> Column:
    """array of words (a character for each byte) -> array of struct(ids, bytes).

    The fold's state are two strings: a mark for each piece, and one for what each two neighbours would give (``LAST_MARK``:
    nothing). Strings are cut and searched at once, where arrays would be copied by element in each step."""
    def one(x, f):  # f of a value that is computed once, and not copied
        return F.aggregate(F.array().cast("array<int>"), x, lambda a, _: a, f)

    def pair(table, *two):
        return one(F.concat(F.lit(" "), *two), lambda key: one(F.get(table, F.crc32(key.cast("binary")).bitwiseAND(BUCKETS - 1).cast("int")),
                                                               lambda entries: F.substring(entries, F.instr(entries, key) + 3, F.lit(1))))

    def merge(table, s):
        p, r, rest = s["p"], s["r"], F.lit(2147483647)

        def at(m, i):
            return F.struct(F.concat(F.substring(p, F.lit(1), i - 1), m, F.substring(p, i + 2, rest)).alias("p"),
                            F.concat(F.substring(r, F.lit(1), i - 2), pair(table, F.substring(p, i - 1, F.lit(1)), m),
                                     pair(table, m, F.substring(p, i + 2, F.lit(1))), F.substring(r, i + 2, rest)).alias("r"))
        return one(F.array_min(F.split(r, "")), lambda m: F.when(m == LAST_MARK, s).otherwise(one(F.instr(r, m), lambda i: at(m, i))))

    def single(w):
        return F.translate(w, bytes(range(256)).decode("latin-1"), "".join(_mark(ranks(path)[bytes([i])]) for i in range(256)))

    def fold(table, w):
        end = F.lit(LAST_MARK)  # no neighbour

        def start(chars):
            pairs = F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: pair(table, F.substring(chars, i, F.lit(2))))
            return F.struct(F.concat(end, chars, end).alias("p"), F.concat(end, F.array_join(pairs, ""), end).alias("r"))
        return F.aggregate(F.sequence(F.lit(2), F.length(w)), one(single(w), start), lambda s, _: merge(table, s),
                           lambda s: F.transform(F.split(F.substring(s["p"], F.lit(2), F.length(s["p"]) - 2), ""), _rank))

    def ids(apart, table, w):
        return one(F.try_element_at(apart, w), lambda whole: F.when(whole.isNotNull(), F.array(whole)).when(F.length(w) == 0, F.array().cast("array<int>"))
                   .when(F.length(w) == 1, F.array(_rank(single(w)))).otherwise(fold(table, w)))

    def both(apart, table, pieces, w):
        return one(ids(apart, table, w), lambda i: F.struct(i.alias("ids"), F.aggregate(i, F.lit(b""), lambda a, k: F.concat(a, F.get(pieces, k))).alias("bytes")))
    return one(apart_map(path), lambda a: one(merge_map(path), lambda t: one(piece_list(path), lambda p: F.transform(words, lambda w: both(a, t, p, w)))))


def encode_long(word: bytes, path: str) -> list[int]:
    """The same merges with a heap of pairs and a linked list: n log n for a word of n bytes."""
    rank = ranks(path)
    parts: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def push(i):
        j = after[i]
        if j < len(parts) and (r := rank.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, parts[i] + parts[j]))
    for i in range(len(parts) - 1):
        push(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = both, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        if before[i] >= 0:
            push(before[i])
        push(i)
    return [rank[p] for p in parts if p is not None]


def _words(texts: pa.StringArray, pattern: regex.Pattern) -> tuple[pa.DictionaryArray, np.ndarray, pa.ListArray]:
    """The units of the texts, how many each text has, and the words of each different unit. Patterns that may not be cut by
    :func:`units` have whole texts as units. A unit of one kind of plain characters is a word and need not be split."""
    if pattern.pattern == PATTERN:
        cut, sizes = units(texts)
        plain = pc.match_substring_regex(cut.dictionary, PLAIN).to_numpy(zero_copy_only=False)
    else:
        cut, sizes = texts.cast(pa.string()).fill_null("").dictionary_encode(), np.ones(len(texts), np.int64)
        plain = np.zeros(len(cut.dictionary), bool)
    found = [split_words(u, pattern) for u in cut.dictionary.filter(pa.array(~plain)).to_pylist()]
    lengths = np.ones(len(plain), np.int64)
    lengths[~plain] = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum([0, *lengths])
    own = np.ones(ends[-1], bool)
    own[ends[:-1][plain]] = False
    at = np.empty(ends[-1], np.int64)
    at[~own], at[own] = np.flatnonzero(plain), np.arange(len(plain), len(plain) + int(own.sum()))
    words = pa.concat_arrays([cut.dictionary, pa.array(chain.from_iterable(found), pa.string())]).take(pa.array(at))
    return cut, sizes, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)


def _frequent(docs: DataFrame, pattern: str) -> DataFrame:
    """word: those of the corpus that are frequent, at most DICTIONARY."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen, n = regex.compile(pattern), [], 0

        def out():
            all_ = pa.concat_tables(seen).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])
            seen.clear()
            return all_.combine_chunks().to_batches()
        for b in batches:
            for part in text_slices(b, "text", SLICE):
                cut, _, words = _words(part.column("text"), find)
                each = words.values.dictionary_encode()
                times = np.repeat(np.bincount(cut.indices.to_numpy(), minlength=len(words)), words.value_lengths().to_numpy())
                times = np.bincount(each.indices.to_numpy(), times, len(each.dictionary)).astype(np.int64)
                new = pa.table([each.dictionary, pa.array(times)], ["word", "n"])
                seen.append(new.filter(pc.less_equal(pc.utf8_length(new["word"]), LONG_WORD // 4)))
                n += seen[-1].num_rows
                del cut, words, each, times, new
                if n >= COUNTED_WORDS:
                    yield from out()
                    n = 0
        if seen:
            yield from out()
        give_back()
    counts = staged(docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = (F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most 8 x 64 rows
    least, total = None, 0
    for s in steps:
        total += s["count"]
        if total > DICTIONARY:
            break
        least = s["step"]
    return counts.where(step >= least if least is not None else F.lit(False)).select("word")


def _joined(ids: pa.ListArray) -> pa.StringArray:
    """The decimal ids of each list, a comma after each of them."""
    ends = pa.array(np.append(0, np.cumsum(ids.value_lengths().to_numpy())), pa.int32())
    text = pc.binary_join(pa.ListArray.from_arrays(ends, ids.flatten().cast(pa.string())), ",")
    return pc.if_else(pc.equal(ids.value_lengths(), 0), text, pc.binary_join_element_wise(text, "", ","))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = _frequent(docs, pattern).select("word", F.decode(F.encode("word", "UTF-8"), "ISO-8859-1").alias("w"))
    frequent = frequent.repartition(4 * spark.sparkContext.defaultParallelism).groupBy(F.spark_partition_id()).agg(F.collect_list("word").alias("words"), F.collect_list("w").alias("w"))
    rows = frequent.select(F.inline(F.arrays_zip("words", encode_words(F.col("w"), path).alias("got")))).toDF("word", "got")
    known = rows.select("word", "got.ids", "got.bytes").toArrow().combine_chunks()  # at most DICTIONARY words
    word, ids, data = (known.column(c).combine_chunks() if known.num_rows else pa.array([], known.schema.field(c).type) for c in ("word", "ids", "bytes"))
    # apart, as a Python worker needs either of them
    shared_words = spark.sparkContext.broadcast(word)
    shared = spark.sparkContext.broadcast((_joined(ids), ids.value_lengths().to_numpy().astype(np.int64), data))
    del known, word, ids, data
    pa.default_memory_pool().release_unused()

    def split(batches):
        find, known = regex.compile(pattern), shared_words.value
        for b in batches:
            for part in text_slices(b, "text", SLICE):
                cut, sizes, words = _words(part.column("text"), find)
                each = words.values.dictionary_encode()
                place = pc.index_in(each.dictionary, value_set=known)
                new = place.is_null()
                rare = [_key(w.encode()) for w in each.dictionary.filter(new).to_pylist()]
                place, new = place.fill_null(0).to_numpy().copy(), new.to_numpy(zero_copy_only=False)
                place[new] = np.arange(len(known), len(known) + len(rare))
                codes = [cut.indices.to_numpy(), words.value_lengths().to_numpy(), place[each.indices.to_numpy()]]
                yield pa.record_batch([pa.array([x], t) for x, t in (
                    (part.column("doc_id").to_pylist(), pa.list_(pa.int64())), (sizes.tolist(), pa.list_(pa.int64())), *((c.astype("<i4").tobytes(), pa.binary()) for c in codes),
                    ([w if len(w) <= LONG_WORD else "" for w in rare], pa.list_(pa.string())), ([w for w in rare if len(w) > LONG_WORD], pa.list_(pa.string())))],
                    ["ids", "sizes", "codes", "lengths", "places", "words", "long"])
                del cut, sizes, words, each, place, new, rare, codes
                give_back()

    def join(batches):
        known_text, known_size, known_data = shared.value
        for b in batches:
            for ids, sizes, codes, lengths, places, got, long in zip(*(b.column(k) for k in ("ids", "sizes", "codes", "lengths", "places", "got", "long"))):
                codes, lengths, places = (np.frombuffer(x.as_buffer(), "<i4") for x in (codes, lengths, places))
                got, lists = got.values, [encode_long(w.encode("latin-1"), path) for w in long.as_py()]
                text, size, data = _joined(got.field("ids")), got.field("ids").value_lengths().to_numpy().astype(np.int64), got.field("bytes")
                if lists:
                    size, text, data, at = size.copy(), text.to_pylist(), data.to_pylist(), np.flatnonzero(size == 0).tolist()
                    for i, x in zip(at, lists, strict=True):
                        size[i], text[i], data[i] = len(x), "".join(f"{k}," for k in x), b"".join(_pieces(path)[k] for k in x)
                ends, bounds = np.cumsum([0, *lengths]), np.cumsum([0, *sizes.as_py()])
                total = np.cumsum([0, *np.concatenate([known_size, size])[places]])[ends]
                total = np.cumsum([0, *np.diff(total)[codes]])[bounds]

                def whole(known, own, kind):  # what a text's units give stands side by side
                    each = pa.concat_arrays([known, pa.array(own, known.type)]).take(pa.array(places))  # noqa: B023
                    each = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each), kind[0]).cast(kind[1]).take(pa.array(codes))  # noqa: B023
                    return np.frombuffer(each.buffers()[1], np.int64)[bounds].tolist(), memoryview(each.buffers()[2] or b"")  # noqa: B023
                cut, text = whole(known_text, text, ("", pa.large_string()))
                coded = [hashlib.sha256(text[i:max(i, j - 1)]).hexdigest() for i, j in zip(cut, cut[1:])]
                del text
                cut, data = whole(known_data, data, (b"", pa.large_binary()))
                decoded = [hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(cut, cut[1:])]
                del data
                give_back()
                yield pa.record_batch([pa.array(ids.as_py(), pa.int64()), pa.array(np.diff(total), pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                                      ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows = docs.mapInArrow(split, "ids array<long>, sizes array<long>, codes binary, lengths binary, places binary, words array<string>, long array<string>")
    rows = rows.select("ids", "sizes", "codes", "lengths", "places", "long", encode_words(F.col("words"), path).alias("got"))
    return rows.mapInArrow(join, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@cache
def _pieces(path: str) -> dict[int, bytes]:
    return {r: p for p, r in ranks(path).items()}
