"""Token ids as files of range-asymmetric-numeral-system (rANS) blocks.

One frequency table, counted over the whole corpus, is shared by all blocks. A block holds whole documents
and is coded on its own: token i belongs to lane i mod ``lanes``, the lanes' states advance together and share one
stream of 32-bit words. Every ``STRIDE`` steps a checkpoint records the states and the place in the stream, so that
a long block can be decoded from several places at once. Checksums cover the coded words and the ids.

A document without text gives just the end id. Null doc_ids sort first; rows that share a doc_id keep one row each.
Extra columns of the input are ignored. An empty table gives no blocks and no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import partitions, scratch, staged, text_slices, units

END_ID = 1
BITS, LOW = 20, np.uint64(1 << 31)
LANES, STRIDE, BLOCK_TOKENS = 1024, 128, 1 << 18
MAGIC, HEAD = b"RNS1", struct.Struct("<4sQIIIIII")
#: Pre-tokens that a worker remembers the ids of, and the longest of them.
CACHE_WORDS, CACHE_CHARS = 400_000, 64
#: Bytes of text that are cut into units at a time; each different unit among them is looked at once.
SLICE = 1 << 23
#: Characters other than ASCII, Latin-1, Latin Extended-A and general punctuation.
OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-\u017f\u2010-\u2027\u2030-\u205e]")
#: The pattern of the word vocabulary's pre-tokenizer (fixed value), and its matches in lower-case texts without those others.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ſ0-9²³¹¼-¾]+")


#: OTHER in the syntax of Arrow's patterns.
OTHER_RE2 = r"[^\x00-\x1b\x20-\x{84}\x{86}-\x{17f}\x{2010}-\x{2027}\x{2030}-\x{205e}]"


# ---- tokens

class PieceIds(dict):
    """Pre-token, or unit of them, of a plain text -> ids as little-endian bytes, encoded on first use by the tokenizer's model.
    With ``added`` the file's special tokens are found in texts, as by the library's default; else their strings are ordinary text."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not added
        self.tokenizer, self.model, self.pre_tokenizer = tokenizer, tokenizer.model, tokenizer.pre_tokenizer
        found = [t for t in tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        self.added = [t.content for t in found]
        self.known = json.dumps(SPLIT) in json.dumps(json.loads(tokenizer.to_str())) and not any(t.normalized for t in found)
        self.vocabulary = tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.one = struct.Struct("<H" if self.kind.itemsize == 2 else "<I").pack
        self.old: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        if (ids := self.old.get(unit)) is None:
            ids = b"".join([self.one(t.id) for word in WORD.findall(unit.lower()) for t in self._tokens(word)])
        if len(unit) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def _tokens(self, word: str) -> list:
        if word.isascii() and word.isprintable():
            return self.model.tokenize(word)
        # the pre-tokenizer writes each byte as a character, control characters as others
        return [t for w, _ in self.pre_tokenizer.pre_tokenize_str(word) for t in self.model.tokenize(w)]

    def encode(self, text: str) -> bytes:
        """As the whole tokenizer would. Where a text has only plain Latin characters and no added token, lower case
        is all that the normalizer does to its words and WORD finds the pre-tokens."""
        if self.known and OTHER.search(text) is None and not any(a in text for a in self.added):
            return b"".join(map(self.__getitem__, WORD.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode_units(self, texts: pa.StringArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of different units of the texts, for each unit which they are, and how many units each text has. A plain text's units
        are such that no pre-token lies across a cut; any other text is one unit."""
        plain = pa.array(np.zeros(len(texts), bool))
        if self.known:
            plain = pc.invert(pc.fill_null(pc.match_substring_regex(texts, OTHER_RE2), False))
            for a in self.added:
                plain = pc.and_(plain, pc.invert(pc.fill_null(pc.match_substring(texts, a), False)))
        cut, own = units(texts.filter(plain))
        ids = list(map(self.__getitem__, cut.dictionary.to_pylist()))
        codes = cut.indices.to_numpy()
        if len(own) == len(texts):
            return ids, codes, own
        plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.ones(len(texts), np.int64)
        sizes[plain] = own
        from_plain = np.repeat(plain, sizes)
        which = np.empty(len(from_plain), np.int64)
        which[from_plain] = codes
        which[~from_plain] = np.arange(len(ids), len(ids) + np.count_nonzero(~plain))
        return ids + [self.encode(t) for t in texts.filter(pa.array(~plain)).to_pylist()], which, sizes


_CACHES: dict[tuple[str, bool], PieceIds] = {}  # in each Python worker


def piece_ids(path: str, added: bool = False) -> PieceIds:
    if (path, added) not in _CACHES:
        _CACHES[path, added] = PieceIds(path, added)
    return _CACHES[path, added]


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """doc_id and ids (little-endian bytes, the end id included) of each document; counts is null. Each task adds a row with neither
    doc_id nor ids, whose counts are how often each id occurs in the task (little-endian, 8 bytes each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_ids(path, added)
        end = np.array([end_id], pieces.kind).tobytes()
        counts = np.zeros(pieces.vocabulary, "<i8")
        for b in batches:
            for part in text_slices(b, "text", SLICE):
                ids, which, sizes = pieces.encode_units(part.column("text").fill_null(""))
                every = pa.array(ids, pa.binary()).take(pa.array(which))
                places = np.frombuffer(every.buffers()[1], np.int32)[np.cumsum([0, *sizes])]
                data = memoryview(every.buffers()[2] or b"")
                counts += np.bincount(np.frombuffer(data[:places[-1]], pieces.kind), minlength=len(counts))
                counts[end_id] += part.num_rows
                out = pa.array([bytes(data[i:j]) + end for i, j in zip(places, places[1:])], pa.binary())
                yield pa.record_batch([part.column("doc_id"), out, pa.nulls(len(out), pa.binary())], ["doc_id", "ids", "counts"])
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["doc_id", "ids", "counts"])
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, ids binary, counts binary")


def count_ids(tokens: DataFrame, path: str, added: bool = False) -> np.ndarray:
    """How often each id occurs, by the tasks' counts. What reaches the driver is one row per id of the vocabulary."""
    def run(batches):
        n = None
        for b in batches:
            for counts in b.column(0).to_pylist():
                n = np.frombuffer(counts, "<i8") + (0 if n is None else n)
        if n is not None:
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["id", "n"])
    got = tokens.where("counts is not null").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(piece_ids(path, added).vocabulary, np.int64)
    counts[got["id"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return counts


# ---- coder

class Table:
    """Frequencies that sum to 2^BITS, at least 1 for each id."""

    def __init__(self, counts: np.ndarray):
        size = 1 << BITS
        freq = np.ones(len(counts), np.int64)
        if total := int(counts.sum()):
            freq += (counts.astype(np.float64) / total * (size - len(counts))).astype(np.int64)
        freq[int(np.argmax(counts))] += size - int(freq.sum())
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode(ids: np.ndarray, t: Table) -> tuple[int, list[tuple[int, np.ndarray]], np.ndarray]:
    """Lanes, checkpoints (place in the stream, states) at steps 0, STRIDE, ..., and the stream of words."""
    lanes = max(1, min(LANES, len(ids) // 64))
    x, out, states = np.full(lanes, LOW, np.uint64), [], {}
    steps = -(-len(ids) // lanes)
    shift, word, bits = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(BITS)
    limit = np.uint64(63 - BITS)
    for s in range(steps - 1, -1, -1):
        sym = ids[s * lanes:(s + 1) * lanes]
        f, c, y = t.freq[sym], t.start[sym], x[:len(sym)]
        full = y >= f << limit
        out.append((y[full] & word).astype(np.uint32))
        y = np.where(full, y >> shift, y)
        q = y // f
        x[:len(sym)] = (q << bits) + (y - q * f) + c
        if s % STRIDE == 0:
            states[s] = x.copy()
    out.reverse()
    place = np.concatenate([[0], np.cumsum([len(o) for o in out])]).astype(np.int64)
    return lanes, [(int(place[s]), states[s]) for s in sorted(states)], np.concatenate(out) if out else np.zeros(0, np.uint32)


def decode(n: int, lanes: int, words: np.ndarray, t: Table, at: int, state: np.ndarray, first: int, last: int) -> np.ndarray:
    """Ids of the steps from ``first`` to before ``last``, from a checkpoint's place and states."""
    x, got = state.copy(), []
    bits, mask, shift = np.uint64(BITS), np.uint64((1 << BITS) - 1), np.uint64(32)
    words = words.astype(np.uint64)
    for s in range(first, last):
        y = x[:min(lanes, n - s * lanes)]
        slot = y & mask
        sym = t.symbol[slot]
        y = t.freq[sym] * (y >> bits) + slot - t.start[sym]
        low = np.flatnonzero(y < LOW)
        y[low] = (y[low] << shift) | words[at:at + len(low)]
        at += len(low)
        x[:len(y)] = y
        got.append(sym)
    return np.concatenate(got) if got else np.zeros(0, np.uint32)


def pack(doc_ids: list, docs: list[np.ndarray], t: Table) -> bytes:
    """A block of whole documents as bytes."""
    ids = np.concatenate(docs)
    lanes, marks, words = encode(ids, t)
    null = np.array([d is None for d in doc_ids], np.uint8)
    body = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), np.array([len(d) for d in docs], "<u8").tobytes(),
        *[struct.pack("<Q", at) + s.astype("<u8").tobytes() for at, s in marks], words.astype("<u4").tobytes()])
    return HEAD.pack(MAGIC, len(ids), lanes, len(docs), len(marks), len(words), zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes())) + body


def open_block(data: bytes):
    """Header fields and arrays of a block; ValueError if its bytes are damaged."""
    magic, n, lanes, n_docs, n_marks, n_words, crc, ids_crc = HEAD.unpack_from(data)
    body = memoryview(data)[HEAD.size:]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("damaged rANS block")
    at = 17 * n_docs
    doc_ids, null, lens = np.frombuffer(body, "<i8", n_docs), np.frombuffer(body, np.uint8, n_docs, 8 * n_docs), np.frombuffer(body, "<u8", n_docs, 9 * n_docs)
    marks = []
    for _ in range(n_marks):
        marks.append((struct.unpack_from("<Q", body, at)[0], np.frombuffer(body, "<u8", lanes, at + 8)))
        at += 8 + 8 * lanes
    return n, lanes, [None if z else int(d) for d, z in zip(doc_ids, null)], lens.astype(np.int64), marks, np.frombuffer(body, "<u4", n_words, at), ids_crc


def unpack(data: bytes, t: Table) -> tuple[list, list[np.ndarray]]:
    """doc_ids and ids of each document of a block; every stretch is decoded from its own checkpoint."""
    n, lanes, doc_ids, lens, marks, words, ids_crc = open_block(data)
    steps = -(-n // lanes)
    parts = [decode(n, lanes, words[at:], t, 0, s, k * STRIDE, min(steps, (k + 1) * STRIDE)) for k, (at, s) in enumerate(marks)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("damaged rANS block")
    return doc_ids, np.split(ids, np.cumsum(lens)[:-1])


# ---- jobs

def write(docs: DataFrame, tokenizer: str, out: str, block_tokens: int = BLOCK_TOKENS, added: bool = False) -> np.ndarray:
    """Encode ``docs`` into files of blocks under ``out`` in ascending doc_id order; returns the counts that define the table."""
    spark = docs.sparkSession
    tokens = staged(tokenize(docs, tokenizer, added=added), "tokens")
    counts = count_ids(tokens, tokenizer, added)
    shared = spark.sparkContext.broadcast(counts)  # one number per id of the vocabulary

    def run(batches):
        t, part, block = Table(shared.value), TaskContext.get().partitionId(), 0
        kind = piece_ids(tokenizer, added).kind
        ids, docs_, n = [], [], 0

        def flush():
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([n], pa.int64()), pa.array([pack(ids, docs_, t)], pa.binary())],
                                   ["part", "block", "n_tokens", "data"])
        for b in batches:
            for d, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                x = np.frombuffer(x, kind).astype(np.uint32)
                if n and n + len(x) > block_tokens:
                    yield flush()
                    ids, docs_, n, block = [], [], 0, block + 1
                ids.append(d)
                docs_.append(x)
                n += len(x)
        if ids:
            yield flush()
    tokens = tokens.where("ids is not null").select("doc_id", "ids")
    (tokens.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, "part int, block long, n_tokens long, data binary")
     .write.option("compression", "none").parquet(out))
    return counts


def read(spark: SparkSession, path: str, counts: np.ndarray) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    blocks = spark.read.schema("part int, block long, n_tokens long, data binary").parquet(path)
    shared = spark.sparkContext.broadcast(counts)

    def run(batches):
        t = Table(shared.value)
        for b in batches:
            for part, block, data in zip(b.column("part").to_pylist(), b.column("block").to_pylist(), b.column("data")):
                doc_ids, docs = unpack(data.as_py(), t)
                lens = np.array([len(d) for d in docs], np.int64)
                crc = [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
                yield pa.record_batch([pa.array([part] * len(docs), pa.int32()), pa.array([block] * len(docs), pa.int64()), pa.array(doc_ids, pa.int64()),
                                       pa.array(np.cumsum(lens) - lens, pa.int64()), pa.array(lens, pa.int64()), pa.array(crc, pa.int64())],
                                      ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])
    docs = blocks.select("part", "block", "data").mapInArrow(run, "part int, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    earlier = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # a row per partition
    places = sizes.select("part", "block", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("off")).join(parts, "part")
    return docs.join(places, ["part", "block"]).select("doc_id", (F.col("base") + F.col("off") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS, added: bool = False) -> DataFrame:
    out = scratch(docs.sparkSession, "rans")
    return read(docs.sparkSession, out, write(docs, tokenizer, out, block_tokens, added))
