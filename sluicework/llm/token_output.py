"""Token ids as raw binary shards, with a minimal perfect hash index over them.

A document's key is its id together with a copy number (0, 1, ... among rows of the same id), so
repeated rows keep an entry each. Layout below ``path``:

``shard-N-A.bin``     ids of many documents, little-endian unsigned, 16-bit where the vocabulary
                      allows and else 32-bit, one after the other in ascending key order; shards
                      are in ascending order too.
``meta/``             Parquet, a row per document: key, shard, attempt, offset in the shard, number of ids.
``index-N-A.mph``     for each bucket of keys a minimal perfect hash function and, at each of its
                      slots, a fingerprint of the key, the shard, its attempt, the offset and the number of ids.
``buckets/``          Parquet, a row per bucket: its attempt and its number of keys.
``manifest.json``     written last: what a reader needs to know; an output without it isn't finished.

A path that the caller gives is kept; without one the output is scratch, below the session's shared folder, and goes
when the driver ends. An output is written once: a path that holds one already is an error. ``Reader`` opens a finished output without
Spark and reads single documents; the time for one doesn't depend on the output's size: each level's
bits are kept in blocks of 512 with the rank of the first, so a key takes a read of 72 bytes for each level it meets (1.6 on average),
one of its entry and one of its ids.

A is the attempt of the task that wrote a file. A task that runs again, after a lost executor or by
speculation, writes a file of its own; Spark commits the rows of one attempt only, and only the files
that these name are read.

Keys are hashed to 128 bits, 64 for the bucket and the slot and 64 as fingerprint. Should two keys of a bucket
agree in the first half, the bucket's function takes another mix of both halves. Keys in and
entries out are counted, and a difference is an error.

Edge cases: a null text counts as empty and has the end id only; null ids sort first and have
copy numbers as other ids have; ties and repeated rows are ordered by a hash of the text and, where they are alike, by where they
were read, and may lie in several shards; very long texts are encoded one at a time; an empty table gives no shard and no row; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
import xxhash
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, mix, shared_dir, table, text_or_empty

#: Keys of one index bucket, on average; an index task holds one bucket in memory.
BUCKET_KEYS = 100_000
#: Slots of a level of the hash function, per key that is still without one.
GAMMA = 1.5
LEVELS = 40
#: Text bytes of a shard, on average, where there are more than Spark's shuffle partitions take.
SHARD_BYTES = 512 << 20
MOST_SEEDS = 16
_BUCKET = "bucket int, built long, n_keys long"
_WHERE = "shard int, attempt long, offset long, n_tokens long"
#: Bits of a level that share a rank: how many bits are set before them, at all levels.
BLOCK_BITS = 512
_RANKED = np.dtype([("rank", "<i8"), ("bits", "u1", BLOCK_BITS // 8)])
_ENTRY = np.dtype([("fingerprint", "<u8"), ("shard", "<i4"), ("attempt", "<i8"), ("offset", "<i8"), ("n", "<i8")])

# --- encoding ------------------------------------------------------------------------------

#: A space with something that isn't white space on both sides: byte-level pre-tokenization always begins anew there.
_UNIT = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s\s")
#: Marks that end words and never join with a letter before them.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: How byte-level vocabularies write bytes as characters: printable ones as they are, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
_SPACE = _BYTE_CHARS[32]
#: Units of a generation, of which two are held.
_CACHE_UNITS = 600_000
_ENCODERS: dict[str, Encoder] = {}


class _Cache(dict):
    """Ids of units, or of parts of them, learned as they come. A full generation becomes the old one, from which units that are used go over to the next."""

    def __init__(self, learn, most: int = _CACHE_UNITS):
        super().__init__()
        self.learn, self.most, self.old = learn, most, {}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.most:
            self.old = self.copy()
            self.clear()
        ids = self.old.get(unit)
        if ids is None:
            ids = self.learn(unit)
        self[unit] = ids
        return ids


class Encoder:
    """The ids of whole texts, as bytes of ``dtype``. Units met before come from a cache of bounded size.

    Byte-level tokenizers without a normalizer cut a text before each single inner space, whatever
    stands around it, so the ids of a text are those of its first unit and of its space-led units in
    turn. A unit of letters is one piece for the model, and so is a run of marks after it; other
    units are cut by the library. Texts with an added token's string, and other tokenizers, take the
    library's plain path.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pre = self.tokenizer.pre_tokenizer
        self.by_unit = self.tokenizer.normalizer is None and isinstance(pre, pre_tokenizers.ByteLevel) and pre.use_regex and not pre.add_prefix_space
        self.packed = [int(i).to_bytes(np.dtype(self.dtype).itemsize, "little") for i in range(max(self.tokenizer.get_vocab().values(), default=0) + 1)]
        self.units, self.marks, self.starts = _Cache(self._unit), _Cache(self._piece), _Cache(self._letters)

    def _ids(self, encoding) -> bytes:
        return b"".join([self.packed[i] for i in encoding.ids])

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, which is written with the library's characters for bytes."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(piece)])

    def _unit(self, unit: str) -> bytes:
        if unit.isascii() and unit.isalpha():  # such words are written as they are
            return self._piece(_SPACE + unit)
        word = unit.rstrip(_MARKS)
        if unit and (unit.isascii() or max(unit) < "\u0250"):
            if not word:
                return self._piece(_SPACE + unit)
            if word.isalpha():
                if len(word) < len(unit):
                    return self.units[word] + self.marks[unit[len(word) :]]
                return self._letters(" " + word)
            before, line, after = unit.partition("\n")
            if line and before and after and not before[-1].isspace() and not after[0].isspace():
                end = after.rstrip(_MARKS)
                if end.isalpha():
                    after_ids = self.starts[end] + (self.marks[after[len(end) :]] if len(end) < len(after) else b"")
                    return self.units[before] + self.marks[_BYTE_CHARS[10]] + after_ids
        return b"".join([self._piece(piece) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(" " + unit)])

    def _letters(self, word: str) -> bytes:
        """Ids of a word, with a space before it or not."""
        return self._piece(word.encode().decode("latin-1").translate(_BYTE_CHARS))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text the bytes of its ids."""
        if not self.by_unit:
            return [self._ids(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        out, known = [], self.units.__getitem__
        for text in texts:
            if any(a in text for a in self.added):
                out.append(self._ids(self.tokenizer.encode(text, add_special_tokens=False)))
                continue
            units = _UNIT.split(text) if _RUN.search(text) else text.split(" ")
            head = self._ids(self.tokenizer.encode(units[0], add_special_tokens=False)) if units[0] else b""
            del units[0]
            out.append(head + b"".join(map(known, units)))
        return out


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, loaded once in each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, chunks: Iterator[bytes]) -> None:
    fs, root = _place(uri)
    with fs.open_output_stream(f"{root}/{name}") as f:
        for chunk in chunks:
            f.write(chunk)


def shard_name(shard: int, attempt: int) -> str:
    return f"shard-{shard:05d}-{attempt}.bin"


def index_name(bucket: int, attempt: int) -> str:
    return f"index-{bucket:05d}-{attempt}.mph"


# --- shards --------------------------------------------------------------------------------


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, and write shards in ascending key order below ``path``.

    Rows are dealt by ranges of the id, the text's hash and the place they were read at, so a shard is one task's ids, streamed to its file as they
    come, and an id that many rows share takes several; there are as many as ``shard_bytes`` asks for, and at least as Spark has shuffle partitions.
    Copies are numbered within shards first; then those of ids that begin in an earlier shard are moved up.
    Returns the metadata: doc_id, copy, shard, attempt, offset, n_tokens.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    fs, root = _place(path)
    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.spark_partition_id().alias("read_at"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // shard_bytes))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("read_at"))
    rows = rows.repartitionByRange(n_shards, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        shard, attempt, coder = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), encoder(tokenizer)
        encode, end, width = coder.encode, np.array([end_id], coder.dtype).tobytes(), np.dtype(coder.dtype).itemsize
        done: list[pa.RecordBatch] = []

        def chunks() -> Iterator[bytes]:
            offset, last, copy = 0, (), 0
            for batch in itertools.chain([head], batches):
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                copies, offsets, lengths = [], [], []
                for doc_id, payload in zip(ids, encode(texts.to_pylist()), strict=True):
                    copy = copy + 1 if (doc_id,) == last else 0
                    last = (doc_id,)
                    copies.append(copy)
                    offsets.append(offset)
                    lengths.append(len(payload) // width + 1)
                    offset += lengths[-1]
                    yield payload + end
                n = len(ids)
                done.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(copies, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([attempt] * n, pa.int64()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["doc_id", "copy", "shard", "attempt", "offset", "n_tokens"]))

        _put(path, shard_name(shard, attempt), chunks())
        yield from done

    schema = f"doc_id long, copy long, {_WHERE}"
    wrote = materialize(rows.mapInArrow(write, schema), "wrote")
    wrote.join(F.broadcast(_copies_before(wrote)), F.col("shard").eqNullSafe(F.col("in_shard")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left").select(
        "doc_id", (F.col("copy") + F.coalesce("before", F.lit(0))).alias("copy"), "shard", "attempt", "offset", "n_tokens"
    ).write.parquet(f"{path}/meta")
    return spark.read.schema(schema).parquet(f"{path}/meta")


def _copies_before(wrote: DataFrame) -> DataFrame:
    """For an id that goes on from an earlier shard, how many rows of it lie there: in_shard, of_id, before.

    Only the first and the last id of a shard can be in another one, too, so this is a row per shard at most.
    """
    at = F.struct(F.col("offset"))
    ends = wrote.groupBy("shard").agg(*(f(F.struct("doc_id", (F.col("copy") + 1).alias("n")), at).alias(name) for f, name in ((F.min_by, "first"), (F.max_by, "last"))))
    ends = ends.withColumn("whole", F.col("first.doc_id").eqNullSafe(F.col("last.doc_id")))
    last = ends.select("shard", F.col("last.doc_id").alias("of_id"), F.col("last.n").alias("n"), F.lit(False).alias("goes_on"))
    first = ends.where(~F.col("whole")).select("shard", F.col("first.doc_id").alias("of_id"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("goes_on"))
    earlier = Window.partitionBy("of_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    both = last.unionByName(first).withColumn("before", F.sum("n").over(earlier))
    return both.where("before > 0").select(F.col("shard").alias("in_shard"), "of_id", "before")


# --- the minimal perfect hash function -----------------------------------------------------


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def build_mph(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits over distinct 64-bit keys: at each, keys that are alone at their place are settled there.

    Returns the levels and, sorted, any keys that all levels left over.
    """
    levels, left = [], keys
    while len(left) and len(levels) < LEVELS:
        size = max(int(len(left) * GAMMA), 8)
        at = _position(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels, np.sort(left)


def mph_slots(keys: np.ndarray, levels: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """The slot of each key in 0..n-1; for a key that isn't in the set, some slot or -1."""
    slots, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        if not len(open_):
            break
        at = _position(keys[open_], level, len(bits))
        hit, rank = bits[at], np.cumsum(bits)
        slots[open_[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1]) if len(rank) else 0
        open_ = open_[~hit]
    if len(open_) and len(left):
        at = np.minimum(np.searchsorted(left, keys[open_]), len(left) - 1)
        found = left[at] == keys[open_]
        slots[open_[found]] = base + at[found]
    return slots


def _seeded(keys: np.ndarray, fingerprints: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of a key's 128: its hash, or for later seeds another mix of hash and fingerprint."""
    return keys if not seed else mix(mix(keys + np.uint64(seed)) ^ fingerprints)


def pack_index(keys: np.ndarray, entries: np.ndarray) -> bytes:
    """An index bucket as bytes: sizes and seed, bits of the levels, left-over keys, entries by slot."""
    for seed in range(MOST_SEEDS):
        own = _seeded(keys, entries["fingerprint"], seed)
        if len(np.unique(own)) == len(own):
            break
    else:
        raise ValueError("two keys of a bucket agree in all 128 bits")
    levels, left = build_mph(own)
    by_slot = np.empty(len(own), _ENTRY)
    by_slot[mph_slots(own, levels, left)] = entries
    head = np.array([len(levels), len(left), len(own), seed, *map(len, levels)], "<i8")
    return b"".join([head.tobytes(), *(x.tobytes() for x in _ranked(levels)), left.astype("<u8").tobytes(), by_slot.tobytes()])


def _ranked(levels: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The bits of each level in blocks, each with the number of bits that are set before it."""
    before = 0
    for bits in levels:
        out = np.zeros(-(-len(bits) // BLOCK_BITS), _RANKED)
        out["bits"] = np.packbits(np.pad(bits, (0, len(out) * BLOCK_BITS - len(bits))), bitorder="little").reshape(len(out), -1)
        counts = np.bitwise_count(out["bits"]).sum(axis=1, dtype=np.int64)
        out["rank"] = before + np.cumsum(counts) - counts
        before += int(counts.sum())
        yield out


class Index(NamedTuple):
    """A bucket's function and entries: bits a level has, their blocks, keys that no level settled, entries by slot, seed."""

    sizes: list[int]
    levels: list[np.ndarray]
    left: np.ndarray
    entries: np.ndarray
    seed: int

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that isn't in the set, some slot or -1."""
        slots, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, blocks) in enumerate(zip(self.sizes, self.levels, strict=True)):
            if not len(open_):
                break
            at = _position(keys[open_], level, size)
            hit, slot = _settled(blocks[at // BLOCK_BITS], at % BLOCK_BITS)
            slots[open_[hit]] = slot[hit]
            open_ = open_[~hit]
        if len(open_) and len(self.left):
            at = np.minimum(np.searchsorted(self.left, keys[open_]), len(self.left) - 1)
            found = self.left[at] == keys[open_]
            slots[open_[found]] = len(self.entries) - len(self.left) + at[found]
        return slots


def _settled(blocks: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a bit of each block is set, and its rank."""
    bits, byte, rows = blocks["bits"], bit // 8, np.arange(len(bit))
    own = bits[rows, byte]
    before = (np.bitwise_count(bits) * (np.arange(bits.shape[1]) < byte[:, None])).sum(axis=1, dtype=np.int64)
    return (own >> (bit % 8).astype(np.uint8)) & 1 == 1, blocks["rank"] + before + np.bitwise_count(own & ((1 << bit % 8) - 1).astype(np.uint8))


def unpack_index(data: bytes) -> Index:
    n_levels, n_left, n, seed = np.frombuffer(data, "<i8", 4).tolist()
    sizes, at, levels = np.frombuffer(data, "<i8", n_levels, 32).tolist(), 32 + 8 * n_levels, []
    for size in sizes:
        levels.append(np.frombuffer(data, _RANKED, -(-size // BLOCK_BITS), at))
        at += levels[-1].nbytes
    return Index(sizes, levels, np.frombuffer(data, "<u8", n_left, at), np.frombuffer(data, _ENTRY, n, at + 8 * n_left), seed)


def find_keys(data: bytes, keys: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys an index bucket knows, and the entries of these."""
    index = unpack_index(data)
    slots = index.slots(_seeded(keys, fingerprints, index.seed))
    got = index.entries[np.maximum(slots, 0)]
    known = (slots >= 0) & (got["fingerprint"] == fingerprints)
    return known, got[known]


def _keyed(df: DataFrame, n_buckets: int) -> DataFrame:
    """With the 64-bit hash of the key, another as its fingerprint, and the bucket."""
    key = (F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull(), F.col("copy"))
    return df.withColumns({"key": F.xxhash64(*key), "fingerprint": F.xxhash64(F.lit("fingerprint"), *key)}).withColumn("bucket", F.pmod(F.shiftright("key", 7), F.lit(n_buckets)).cast("int"))


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def write_index(meta: DataFrame, path: str, bucket_keys: int = BUCKET_KEYS) -> int:
    """Write the index of all keys in ``meta`` below ``path``; returns the number of buckets.

    Keys are spread over buckets by hash, so a bucket's size doesn't depend on hot ids.
    """
    n_keys = meta.count()
    n_buckets = max(1, -(-n_keys // bucket_keys))

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        entries = np.empty(len(rows), _ENTRY)
        entries["fingerprint"] = _unsigned(rows["fingerprint"])
        for name, col in (("shard", "shard"), ("attempt", "attempt"), ("offset", "offset"), ("n", "n_tokens")):
            entries[name] = rows[col].to_numpy()
        bucket, attempt = int(rows["bucket"].iloc[0]), TaskContext.get().taskAttemptId()
        _put(path, index_name(bucket, attempt), iter([pack_index(_unsigned(rows["key"]), entries)]))
        return pd.DataFrame({"bucket": [bucket], "built": [attempt], "n_keys": [len(rows)]})

    wrote = _keyed(meta, n_buckets).select("bucket", "key", "fingerprint", "shard", "attempt", "offset", "n_tokens").groupBy("bucket").applyInPandas(write, _BUCKET)
    wrote.write.parquet(f"{path}/buckets")
    indexed = meta.sparkSession.read.schema(_BUCKET).parquet(f"{path}/buckets").agg(F.sum("n_keys")).first()[0] or 0
    if indexed != n_keys:
        raise ValueError(f"{n_keys} keys, but {indexed} in the index")
    return n_buckets


def look_up(keys: DataFrame, path: str, n_buckets: int) -> DataFrame:
    """For keys (doc_id, copy), each one's shard, attempt, offset and n_tokens from the index; no row for an unknown key.

    Keys are dealt by bucket, and a task reads the buckets it has keys of, one at a time.
    """
    columns = ["doc_id", "copy", "shard", "attempt", "offset", "n_tokens"]

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        fs, root = _place(path)
        with fs.open_input_file(f"{root}/{index_name(int(rows['bucket'].iloc[0]), int(rows['built'].iloc[0]))}") as f:
            known, got = find_keys(f.read(), _unsigned(rows["key"]), _unsigned(rows["fingerprint"]))
        return rows.loc[known, ["doc_id", "copy"]].assign(shard=got["shard"], attempt=got["attempt"], offset=got["offset"], n_tokens=got["n"])[columns]

    built = keys.sparkSession.read.schema(_BUCKET).parquet(f"{path}/buckets").select("bucket", "built")
    return _keyed(keys.select("doc_id", "copy"), n_buckets).join(built, "bucket").groupBy("bucket").applyInPandas(find, f"doc_id long, copy long, {_WHERE}")


def read_payloads(places: DataFrame, path: str, dtype: str) -> DataFrame:
    """Read the ids at (shard, attempt, offset, n_tokens) from the shards and add ids_crc32, the checksum of them as 32-bit integers.

    Places are dealt by shard and sorted by offset, so a shard is read from front to back, a
    document at a time.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _place(path)
        width = np.dtype(dtype).itemsize
        shard, file = None, None
        for rows in batches:
            sums = []
            for *name, offset, n in zip(*(rows[c].tolist() for c in ("shard", "attempt", "offset", "n_tokens")), strict=True):
                if name != shard:
                    if file is not None:
                        file.close()
                    shard, file = name, fs.open_input_file(f"{root}/{shard_name(*name)}")
                file.seek(width * offset)
                sums.append(zlib.crc32(np.frombuffer(file.read(width * n), dtype).astype("<u4").tobytes()))
            yield rows.assign(ids_crc32=sums)
        if file is not None:
            file.close()

    return places.repartition("shard").sortWithinPartitions("shard", "offset").mapInPandas(read, places.schema.add("ids_crc32", "long"))


def write_output(docs: DataFrame, tokenizer: str, path: str) -> tuple[DataFrame, int]:
    """Write shards, index and manifest of ``docs`` below ``path``; returns the metadata and the number of index buckets."""
    if finished(path):
        raise FileExistsError(f"{path} holds an output already")
    meta = write_shards(docs, path, tokenizer)
    n_buckets = write_index(meta, path)
    known = {"n_buckets": n_buckets, "n_keys": meta.count(), "dtype": encoder(tokenizer).dtype, "end_id": 0, "tokenizer": os.path.basename(tokenizer)}
    _put(path, "manifest.json", iter([json.dumps(known).encode()]))
    return meta, n_buckets


def finished(path: str) -> bool:
    """Whether there is a whole output below ``path``."""
    fs, root = _place(path)
    return fs.get_file_info(f"{root}/manifest.json").type == pafs.FileType.File


def token_output(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write shards and index of ``docs``, look every key up in the index and read its ids back.

    The output stays below ``path``, a URI that driver and executors share; without one it goes when the driver ends.
    Returns doc_id, copy, shard, start (ids of all documents before it), n_tokens, ids_crc32.
    """
    path = path or f"{shared_dir(docs.sparkSession, keep=True)}/tokens"
    meta, n_buckets = write_output(docs, tokenizer, path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    starts = meta.groupBy("shard").agg(F.sum("n_tokens").alias("total")).select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))
    places = materialize(look_up(meta, path, n_buckets), "places")
    if (asked := meta.count()) != (found := places.count()):
        raise ValueError(f"{asked} keys, but the index knows {found}")
    read = read_payloads(places, path, encoder(tokenizer).dtype)
    return read.join(starts, "shard").select("doc_id", "copy", "shard", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


# --- single documents, without Spark -------------------------------------------------------


def _hashed(seed: int, doc_id: int | None, copy: int) -> int:
    """What ``_keyed`` makes of a key, as a signed number: each value's XXH64 is the seed of the next one's."""
    for value, size in ((-1 if doc_id is None else doc_id, 8), (doc_id is None, 4), (copy, 8)):
        seed = xxhash.xxh64_intdigest(int(value).to_bytes(size, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


class Reader:
    """Single documents of a finished output, by key, in constant time."""

    def __init__(self, path: str):
        if not finished(path):
            raise FileNotFoundError(f"there is no finished output in {path}")
        self.fs, self.root = _place(path)
        with self.fs.open_input_file(f"{self.root}/manifest.json") as f:
            self.manifest = json.loads(f.read())
        buckets = pads.dataset(f"{self.root}/buckets", filesystem=self.fs, format="parquet").to_table(columns=["bucket", "built"])
        self.built = dict(zip(buckets.column("bucket").to_pylist(), buckets.column("built").to_pylist(), strict=True))
        self.heads: dict[int, np.ndarray] = {}

    def _entry(self, f, bucket: int, key: int, fingerprint: int) -> np.void | None:
        if bucket not in self.heads:  # how long the levels are
            self.heads[bucket] = np.frombuffer(f.read(32), "<i8")
            self.heads[bucket] = np.append(self.heads[bucket], np.frombuffer(f.read(8 * int(self.heads[bucket][0])), "<i8"))
        (n_levels, n_left, n, seed), sizes = self.heads[bucket][:4].tolist(), self.heads[bucket][4:].tolist()
        own, base, slot = _seeded(np.array([key], np.uint64), np.array([fingerprint], np.uint64), seed), 32 + 8 * n_levels, -1
        for level, size in enumerate(sizes):
            at = _position(own, level, size)
            f.seek(base + int(at[0]) // BLOCK_BITS * _RANKED.itemsize)
            hit, rank = _settled(np.frombuffer(f.read(_RANKED.itemsize), _RANKED), at % BLOCK_BITS)
            if hit[0]:
                slot = int(rank[0])
                break
            base += -(-size // BLOCK_BITS) * _RANKED.itemsize
        base = 32 + 8 * n_levels + sum(-(-size // BLOCK_BITS) * _RANKED.itemsize for size in sizes)
        if slot < 0 and n_left:
            f.seek(base)
            left = np.frombuffer(f.read(8 * n_left), "<u8")
            at = int(np.searchsorted(left, own[0]))
            slot = n - n_left + at if at < n_left and left[at] == own[0] else -1
        if slot < 0:
            return None
        f.seek(base + 8 * n_left + slot * _ENTRY.itemsize)
        entry = np.frombuffer(f.read(_ENTRY.itemsize), _ENTRY)[0]
        return entry if int(entry["fingerprint"]) == fingerprint else None

    def get(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        """A document's ids with the end id, or nothing if the output has no such key."""
        key, fingerprint = _hashed(42, doc_id, copy), _hashed(xxhash.xxh64_intdigest(b"fingerprint", 42), doc_id, copy)
        bucket = (key >> 7) % self.manifest["n_buckets"]
        if bucket not in self.built:
            return None
        mask = (1 << 64) - 1
        with self.fs.open_input_file(f"{self.root}/{index_name(bucket, self.built[bucket])}") as f:
            entry = self._entry(f, bucket, key & mask, fingerprint & mask)
        if entry is None:
            return None
        dtype = np.dtype(self.manifest["dtype"])
        with self.fs.open_input_file(f"{self.root}/{shard_name(int(entry['shard']), int(entry['attempt']))}") as f:
            f.seek(dtype.itemsize * int(entry["offset"]))
            return np.frombuffer(f.read(dtype.itemsize * int(entry["n"])), dtype)


def default_tokenizer() -> str:
    """The public byte-level vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, start, n_tokens, ids_crc32, shard, copy."""
    return token_output(table(spark, sf_dir, "documents"), default_tokenizer()).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "copy")
