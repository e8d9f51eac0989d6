"""Token-id files with a minimal perfect hash index for keyed access.

Layout of a store (a folder any pyarrow file system reaches):

- ``payload-*.bin``: raw little-endian token ids (2 bytes each when the vocabulary allows, else 4), whole
  documents in ascending doc_id order, each closed by the end id. One file per range of documents.
- ``index-*.bin``: one file per range of hash buckets. Keys are split into buckets of about 2,000; each
  bucket has its own minimal perfect hash: levels of bit arrays in which a key owns its bit when no
  other key of that level hits it, the others go on to the next level. The number of set bits before a
  key's bit is its slot, and the slot's record holds a 32-bit fingerprint of the key, the payload file,
  the document's start (ids of all documents before it) and length. A lookup reads a few words of bits
  and one record, whatever the number of keys; a key that is not stored fails on its fingerprint.
- ``payloads`` and ``indexes``: Parquet manifests that name the files that count. A file is written by
  one task attempt under a name of its own; files of lost attempts are named nowhere.

A document id that occurs again is stored under (doc_id, repeat), counted from 0 in the order of the
text's hash.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..settings import written
from .words import mix

BUCKET_KEYS = 2048
#: Buckets of one index file.
FILE_BUCKETS = 256
#: Bytes of text that one payload file takes, about.
FILE_BYTES = 32 << 20
LEVELS = 48
#: Distinct pieces of text whose ids a Python worker remembers, in each of two generations; of words, twice
#: as many.
REMEMBERED = 200_000

RECORD = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("start", "<u8"), ("n", "<u8")])

# White space of the pre-tokenizer. No token spans the place between a character that is not
# white space and one that is, so texts can be encoded piece by piece, cut there.
_WS = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PIECES = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` and plain paths are local or mounted."""
    plain = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(plain)


# The word pattern of byte-level tokenizers (white space spelt out), and their letters for bytes.
# The classes of characters are those below U+0250, which are the same in every version of Unicode.
_L, _N = ("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind) for kind in "LN")
_PLAIN_WORDS = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^{_WS}{_L}{_N}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
_PLAIN = re.compile("[\x00-\u024f]*")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: b for b in _SHOWN} | {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


class Memory:
    """Ids of texts met, in two generations: what is met again moves on, the rest is forgotten."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new

    def missing(self, cut: list[list[str]]) -> list[str]:
        """The distinct parts of the ``cut`` texts that are not known."""
        out = []
        for t in {t for found in cut for t in found if t not in self.new}:
            if t in self.old:
                self.new[t] = self.old[t]
            else:
                out.append(t)
        return out


class Words(dict):
    """Ids of words as bytes, learnt when first asked for; ``old`` is the generation before."""

    def __init__(self, learn: Callable[[str], bytes], size: int):
        super().__init__()
        self.learn, self.size = learn, size
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        self[word] = ids = self.learn(word) if ids is None else ids
        return ids

    def turn(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts as bytes, as the tokenizer's plain call gives them, with memory of what was met.

    For byte-level pair encoding, texts are cut into words and only new words go to the merge table; words
    of texts with characters from U+0250 on, whose classes change with the version of Unicode, and texts for
    other tokenizers are cut at white space and encoded piece by piece. Texts that hold the name of an added
    token are encoded whole. With ``names_as_text`` such names are ordinary text.
    """

    def __init__(self, path: str, names_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (names_as_text and t.special)]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"] or {}
        self.by_word = (
            spec["model"]["type"] == "BPE"
            and spec["normalizer"] is None
            and not spec["model"].get("dropout")
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        self.model = self.tokenizer.model if self.by_word else None
        self.pieces, self.words = Memory(REMEMBERED), Words(self._word, 2 * REMEMBERED)

    def _packed(self, ids) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_LETTERS)
        return self._packed([t.id for t in self.model.tokenize(letters)])

    def _by_word(self, texts: list[str]) -> list[bytes]:
        self.words.turn()
        ids = self.words.__getitem__
        return [b"".join(map(ids, _PLAIN_WORDS.findall(t))) for t in texts]

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        cut = [PIECES.findall(t) for t in texts]
        self.pieces.turn()
        new = self.pieces.missing(cut)
        for low in range(0, len(new), 10_000):
            part = new[low : low + 10_000]
            self.pieces.new.update(zip(part, self._whole(part), strict=True))
        ids = self.pieces.new
        return [b"".join([ids[p] for p in found]) for found in cut]

    def __call__(self, texts: list[str]) -> list[bytes]:
        done: dict[str, bytes] = {}
        groups: dict = {self._whole: [], self._by_word: [], self._by_piece: []}
        for t in dict.fromkeys(texts):
            if self.added is not None and self.added.search(t):
                groups[self._whole].append(t)
            else:
                groups[self._by_word if self.by_word and _PLAIN.fullmatch(t) else self._by_piece].append(t)
        for encode, own in groups.items():
            if own:
                done.update(zip(own, encode(own), strict=True))
        return [done[t] for t in texts]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _keys(doc_id: Column, repeat: Column) -> list[Column]:
    return [F.xxhash64(doc_id, repeat).alias("h1"), F.xxhash64(F.lit("key"), repeat, doc_id).alias("h2")]


@dataclass(frozen=True)
class Store:
    """Where a store is, and what a reader must know of it."""

    path: str
    width: int
    keys: int
    buckets: int


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> Store:
    """Encode all documents into a store at ``path``. NULL texts are empty: just the end id."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shards = int(size // FILE_BYTES) + 1
    width = Encoder(tokenizer_path).dtype.itemsize
    kind = docs.schema["doc_id"].dataType.simpleString()
    # one range per payload file; the hash spreads rows that share an id
    laid = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    laid = laid.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def encode(batches):
        shard = TaskContext.get().partitionId()
        system, folder = _open(path)
        system.create_dir(folder, recursive=True)
        name = f"payload-{shard:06d}-{uuid.uuid4().hex}.bin"
        encoder = encoder_of(tokenizer_path)
        close = np.array([end_id], encoder.dtype).tobytes()
        at, last, repeat = 0, object(), 0
        with system.open_output_stream(f"{folder}/{name}") as out:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                offsets, lengths, repeats = [], [], []
                texts = batch.column(2)
                for low in range(0, len(ids), 256):
                    for i, body in enumerate(encoder(texts.slice(low, 256).to_pylist()), low):
                        out.write(body)
                        out.write(close)
                        repeat = repeat + 1 if ids[i] == last else 0
                        last = ids[i]
                        n = len(body) // encoder.dtype.itemsize + 1
                        offsets.append(at)
                        lengths.append(n)
                        repeats.append(repeat)
                        at += n
                m = len(ids)
                yield pa.record_batch(
                    [batch.column(0), pa.array([shard] * m, pa.int32()), pa.array([name] * m), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(repeats, pa.int64())],
                    names=["doc_id", "shard", "file", "at", "n", "again"],
                )

    rows = written(laid.mapInArrow(encode, f"doc_id {kind}, shard int, file string, at long, n long, again long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("shard", "file").agg(F.sum("n").alias("ids"), F.count(F.lit(1)).alias("documents"))
    files = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))  # one row per payload file
    files.write.mode("overwrite").parquet(f"{path}/payloads")
    files = spark.read.parquet(f"{path}/payloads")
    placed = rows.join(files.select("shard", "base"), "shard").withColumn("start", F.col("base") + F.col("at"))
    placed = _repeats_across(placed)
    count = rows.count()
    buckets = count // BUCKET_KEYS + 1
    _index(placed, path, buckets)
    return Store(path, width, count, buckets)


def _repeats_across(placed: DataFrame) -> DataFrame:
    """``repeat`` of every row: only ids at the edge of a payload file can go on in the next one."""
    end = lambda pick: pick(F.struct("doc_id"), "at")
    edges = placed.groupBy("shard").agg(F.array(end(F.min_by), end(F.max_by)).alias("ends"))
    ids = edges.select("shard", F.explode("ends").alias("e")).select("shard", F.col("e.doc_id").alias("id_")).distinct()
    ids = ids.groupBy("id_").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    shared = placed.join(ids, F.col("doc_id").eqNullSafe(F.col("id_")), "left_semi").groupBy("doc_id", "shard").agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shared = shared.withColumn("earlier", F.coalesce(F.sum("m").over(order), F.lit(0))).where("earlier > 0")
    shared = shared.select(F.col("doc_id").alias("id_"), F.col("shard").alias("shard_"), "earlier")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("shard") == F.col("shard_"))
    return placed.join(shared, same, "left").withColumn("repeat", F.col("again") + F.coalesce("earlier", F.lit(0)))


def _bits(h1: np.ndarray, h2: np.ndarray, level: int, size: int | np.ndarray) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(h1 ^ mix(h2 + seed)) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit array of each level, and the slot (0 .. n-1) of every key."""
    slot = np.full(len(h1), -1, np.int64)
    left = np.arange(len(h1))
    levels, used = [], 0
    while len(left):
        if len(levels) >= LEVELS:
            raise ValueError("two keys have the same 128-bit hash")
        size = -(-2 * len(left) // 64) * 64
        bit = _bits(h1[left], h2[left], len(levels), size)
        alone = np.bincount(bit, minlength=size)[bit] == 1
        array = np.zeros(size, bool)
        array[bit[alone]] = True
        slot[left[alone]] = used + np.cumsum(array)[bit[alone]] - 1
        used += int(alone.sum())
        levels.append(array)
        left = left[~alone]
    return levels, slot


def _index(placed: DataFrame, path: str, buckets: int) -> None:
    """Index files over all keys, one task building some files of FILE_BUCKETS buckets."""
    parts = -(-buckets // FILE_BUCKETS)
    keyed = placed.select(*_keys(F.col("doc_id"), F.col("repeat")), "shard", "start", "n")
    keyed = keyed.withColumn("bucket", F.pmod("h1", F.lit(buckets))).withColumn("part", F.expr(f"bucket div {FILE_BUCKETS}"))
    keyed = keyed.repartition(min(parts, 4096), "part").sortWithinPartitions("part", "bucket")

    def build(batches):
        system, folder = _open(path)
        for part, rows in _by(batches, "part"):
            name = f"index-{part:06d}-{uuid.uuid4().hex}.bin"
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write(_index_file(rows, part))
            yield pa.record_batch([pa.array([part]), pa.array([name]), pa.array([rows.num_rows])], names=["part", "file", "keys"])

    keyed.mapInArrow(build, "part long, file string, keys long").write.mode("overwrite").parquet(f"{path}/indexes")


def _by(batches, column: str):
    """Consecutive rows of equal ``column`` together; there are never more than one file's rows."""
    held, value = [], None
    for batch in batches:
        v = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(v)) + 1, [len(v)]))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low == high:
                continue
            if held and v[low] != value:
                yield int(value), pa.Table.from_batches(held)
                held = []
            value = v[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield int(value), pa.Table.from_batches(held)


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _index_file(rows: pa.Table, part: int) -> bytes:
    """Header (JSON, length first), then for all buckets the bits of their levels and their records."""
    h1, h2 = _column(rows, "h1").view(np.uint64), _column(rows, "h2").view(np.uint64)
    bucket = _column(rows, "bucket") - part * FILE_BUCKETS
    records = np.zeros(len(h1), RECORD)
    sizes: list[list[int]] = [[] for _ in range(FILE_BUCKETS)]
    bits: list[np.ndarray] = []
    first = np.searchsorted(bucket, np.arange(FILE_BUCKETS + 1))
    for b in range(FILE_BUCKETS):
        low, high = first[b], first[b + 1]
        if low == high:
            continue
        levels, slot = perfect_hash(h1[low:high], h2[low:high])
        sizes[b] = [len(x) for x in levels]
        bits.extend(levels)
        at = low + slot
        records["mark"][at] = h2[low:high] >> np.uint64(32)
        for name in ("shard", "start", "n"):
            records[name][at] = _column(rows, name)[low:high]
    body = np.packbits(np.concatenate(bits), bitorder="little").tobytes()
    head = json.dumps({"sizes": sizes, "first": first.tolist(), "bits": len(body)}).encode()
    return len(head).to_bytes(8, "little") + head + body + records.tobytes()


class IndexFile:
    """One index file in memory; ``find`` looks up any number of keys."""

    def __init__(self, raw: bytes):
        size = int.from_bytes(raw[:8], "little")
        head = json.loads(raw[8 : 8 + size])
        packed = np.frombuffer(raw, np.uint8, head["bits"], 8 + size)
        self.bits = np.unpackbits(packed, bitorder="little")
        self.records = np.frombuffer(raw, RECORD, offset=8 + size + head["bits"])
        self.first = np.array(head["first"])
        depth = max((len(s) for s in head["sizes"]), default=0)
        self.size = np.array([s + [0] * (depth - len(s)) for s in head["sizes"]], np.int64).reshape(-1, depth)
        total = self.size.sum(axis=1)
        starts = np.concatenate(([0], np.cumsum(total)[:-1]))
        self.start = starts[:, None] + np.concatenate((np.zeros((len(total), 1), np.int64), np.cumsum(self.size, axis=1)[:, :-1]), axis=1)
        self.rank = np.concatenate(([0], np.cumsum(self.bits, dtype=np.int64)))

    def find(self, h1: np.ndarray, h2: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Record number of every key, and whether the key is stored there."""
        slot = np.full(len(h1), -1, np.int64)
        for level in range(self.size.shape[1]):
            open_ = np.flatnonzero((slot < 0) & (self.size[bucket, level] > 0))
            if not len(open_):
                break
            b = bucket[open_]
            bit = self.start[b, level] + _bits(h1[open_], h2[open_], level, self.size[b, level])
            hit = self.bits[bit] == 1
            own = open_[hit]
            slot[own] = self.first[bucket[own]] + self.rank[bit[hit]] - self.rank[self.start[bucket[own], 0]]
        found = slot >= 0
        found[found] = self.records["mark"][slot[found]] == (h2[found] >> np.uint64(32)).astype(np.uint32)
        return slot, found


def locate(keys: DataFrame, store: Store) -> DataFrame:
    """Place of every key (doc_id, repeat) through the index: ``shard``, ``start`` and ``n``; keys that are
    not stored are left out."""
    spark = keys.sparkSession
    kind = keys.schema["doc_id"].dataType.simpleString()
    hashed = keys.select("doc_id", F.col("repeat").cast("long").alias("repeat"), *_keys(F.col("doc_id"), F.col("repeat").cast("long")))
    hashed = hashed.withColumn("bucket", F.pmod("h1", F.lit(store.buckets))).withColumn("part", F.expr(f"bucket div {FILE_BUCKETS}"))
    files = spark.read.parquet(f"{store.path}/indexes").select("part", "file")
    parts = -(-store.buckets // FILE_BUCKETS)
    asked = hashed.join(files, "part").repartition(min(parts, 4096), "part").sortWithinPartitions("part")

    def look(batches):
        system, folder = _open(store.path)
        part, index = None, None
        for batch in batches:
            v = np.asarray(batch.column(batch.schema.get_field_index("part")))
            edges = np.concatenate(([0], np.flatnonzero(np.diff(v)) + 1, [len(v)]))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                some = batch.slice(low, high - low)
                get = lambda n, some=some: some.column(some.schema.get_field_index(n))
                if v[low] != part:
                    with system.open_input_file(f"{folder}/{get('file')[0].as_py()}") as f:
                        index = IndexFile(f.read())
                    part = v[low]
                h1, h2 = (np.asarray(get(n)).view(np.uint64) for n in ("h1", "h2"))
                slot, found = index.find(h1, h2, np.asarray(get("bucket")) - int(part) * FILE_BUCKETS)
                r = index.records[slot[found]]
                keep = pa.array(found)
                yield pa.record_batch(
                    [get("doc_id").filter(keep), get("repeat").filter(keep), pa.array(r["shard"].astype(np.int32)), pa.array(r["start"].astype(np.int64)), pa.array(r["n"].astype(np.int64))],
                    names=["doc_id", "repeat", "shard", "start", "n"],
                )

    return asked.mapInArrow(look, f"doc_id {kind}, repeat long, shard int, start long, n long")


def _payload(located: DataFrame, store: Store) -> DataFrame:
    """Located rows laid out by payload file and place in it, with the file's name and base."""
    files = located.sparkSession.read.parquet(f"{store.path}/payloads")
    shards = files.count()
    return (
        located.join(files.select("shard", "file", "base"), "shard")
        .repartitionByRange(max(1, shards), "shard", "start")
        .sortWithinPartitions("shard", "start")
    )


def _bodies(batch: pa.RecordBatch, store: Store, opened: dict):
    """The stored bytes behind each row; files stay open from row to row."""
    names = batch.schema.names
    column = {n: batch.column(names.index(n)).to_pylist() for n in ("file", "base", "start", "n")}
    for file, base, start, n in zip(column["file"], column["base"], column["start"], column["n"], strict=True):
        if opened.get("name") != file:
            if "f" in opened:
                opened["f"].close()
            system, folder = _open(store.path)
            opened["name"], opened["f"] = file, system.open_input_file(f"{folder}/{file}")
        f = opened["f"]
        if f.tell() != (start - base) * store.width:
            f.seek((start - base) * store.width)
        yield f.read(n * store.width)


def read(keys: DataFrame, store: Store) -> DataFrame:
    """``doc_id``, ``repeat``, ``start``, ``n`` and token ``ids`` of the stored keys among ``keys``."""
    kind = keys.schema["doc_id"].dataType.simpleString()

    def fetch(batches):
        opened: dict = {}
        for batch in batches:
            ids = [np.frombuffer(b, f"<u{store.width}").astype(np.int32) for b in _bodies(batch, store, opened)]
            get = lambda n, batch=batch: batch.column(batch.schema.get_field_index(n))
            yield pa.record_batch([get("doc_id"), get("repeat"), get("start"), get("n"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "repeat", "start", "n", "ids"])

    return _payload(locate(keys, store), store).mapInArrow(fetch, f"doc_id {kind}, repeat long, start long, n long, ids array<int>")


def digests(keys: DataFrame, store: Store) -> DataFrame:
    """Like ``read``, with the crc32 of the ids as unsigned 32-bit integers in place of the ids."""
    kind = keys.schema["doc_id"].dataType.simpleString()

    def sum_up(batches):
        opened: dict = {}
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(b, f"<u{store.width}").astype("<u4").tobytes()) for b in _bodies(batch, store, opened)]
            get = lambda n, batch=batch: batch.column(batch.schema.get_field_index(n))
            yield pa.record_batch([get("doc_id"), get("repeat"), get("start"), get("n"), pa.array(crc, pa.int64())], names=["doc_id", "repeat", "start", "n_tokens", "ids_crc32"])

    return _payload(locate(keys, store), store).mapInArrow(sum_up, f"doc_id {kind}, repeat long, start long, n_tokens long, ids_crc32 long")


def keys_of(docs: DataFrame) -> DataFrame:
    """(doc_id, repeat) of every document."""
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    return counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("repeat"))


def new_folder(spark: SparkSession) -> str:
    from ..settings import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
