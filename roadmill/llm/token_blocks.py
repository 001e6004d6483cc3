"""Token ids in binary blocks with Elias-Fano document boundaries.

Documents are encoded in ascending doc_id order. A block is one concatenated id array with its own header; where
documents end is a monotone sequence, kept in Elias-Fano form (low bits packed, high bits in unary) with a select
sample, at about 2 + log2(mean length) bits a document instead of 64. Ids of documents are kept in the same
form. Blocks are rows of a Parquet table that Spark writes, so that any store serves; `open_block` reads one.

Nulls and ties: a null text is empty and has the end id alone; null ids come first; equal ids are in the order of
their texts' hashes; repeated rows are documents of their own; a very long text is encoded whole, in a block of its own
size. An empty table gives no blocks. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, scratch, shuffle_partitions, use_worker

# ---------------------------------------------------------------- Elias-Fano

SAMPLE = 64


class EliasFano:
    """A non-decreasing sequence of n numbers below 2**63, with select."""

    _head = struct.Struct("<QQBQQ")

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, universe: int, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.universe, self.samples = n, low_bits, low, high, universe, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, universe = len(v), int(v[-1]) + 1 if len(v) else 0
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        if n and bits:
            low = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        else:
            low = b""
        places = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little").tobytes(), universe, places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        return self._head.pack(self.n, self.universe, self.low_bits, len(self.low), len(self.high)) + self.low + self.high + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, universe, bits, n_low, n_high = cls._head.unpack_from(data, at)
        at += cls._head.size
        low, high = data[at : at + n_low], data[at + n_low : at + n_low + n_high]
        at += n_low + n_high
        k = -(-n // SAMPLE)
        return cls(n, bits, low, high, universe, np.frombuffer(data, "<u4", k, at)), at + 4 * k

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        word = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number: from the nearest sampled place, over bytes by their bit counts."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        at = place // 8
        word = self.high[at] & (0xFF << (place % 8)) & 0xFF
        while (ones := word.bit_count()) <= left:
            left -= ones
            at += 1
            word = self.high[at]
        for _ in range(left):
            word &= word - 1
        place = at * 8 + (word & -word).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            for b in range(self.low_bits):
                out |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return out


# ---------------------------------------------------------------- blocks

MAGIC = b"EFTB"
_HEAD = struct.Struct("<4sBBHQQqQ")  # magic, version, bytes an id, reserved, documents, ids, least doc_id, null ids


def pack_block(doc_ids: list[int | None], ends: np.ndarray, ids: bytes, width: int) -> bytes:
    """doc_ids ascending, nulls first; ends: ids up to each document's end; ids: little-endian, width bytes each."""
    nulls = sum(x is None for x in doc_ids)
    known = [x for x in doc_ids if x is not None]
    base = known[0] if known else 0
    boundaries = EliasFano.of(ends).to_bytes()
    names = EliasFano.of(np.array([x - base for x in known], np.uint64)).to_bytes()
    return _HEAD.pack(MAGIC, 1, width, 0, len(doc_ids), len(ids) // width, base, nulls) + boundaries + names + ids


class Block:
    def __init__(self, data: bytes):
        magic, version, self.width, _, self.n_docs, self.n_ids, self._base, self._nulls = _HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token block")
        self.ends, at = EliasFano.read(data, _HEAD.size)
        self._names, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self._nulls else self._base + self._names.select(i - self._nulls)

    def doc_ids(self) -> list[int | None]:
        return [None] * self._nulls + [self._base + int(x) for x in self._names.all()]

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def tokens(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.ids[a:b]


def open_block(data: bytes) -> Block:
    return Block(data)


# ---------------------------------------------------------------- encoding

#: Chunks of these characters need no normalisation but lower-casing, and split into the same words alone or in a row.
_PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level model writes for each byte: printable bytes stand for themselves, the others, in
    order, for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder(dict):
    """Encodes texts by their white-space chunks, each once, where the tokenizer looks at no more than a chunk; else
    whole texts. Plain chunks go to the tokenizer's model at once, others through all of its steps; which of the two
    give the same is tried on a probe. The mapping itself is the cache, of chunk to ids, with an older generation
    behind it; both are of bounded size."""

    LIMIT = 300_000

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.width = 2 if size <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        self.bytes_of = [i.to_bytes(self.width, "little") for i in range(size)]
        self.end_bytes = self.bytes_of[end_id]
        self.letters = str.maketrans(_byte_letters())
        probe = "don't  stop,\tx9 é_z!!\r\n<b>ok</b> A É“ß” ŁódŹ 12.5% ÖÄ|ü we'll 'S Été, a.b"
        chunks = probe.encode().split()
        self.by_chunk = self._whole(probe) == b"".join(self._whole(c.decode()) for c in chunks)
        self.by_model = self.by_chunk and all(self._plain(c) == self._whole(c.decode()) for c in chunks if _PLAIN.fullmatch(c))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _plain(self, chunk: bytes) -> bytes:
        text = chunk.decode().lower()
        if text.isalpha():
            words = [text]
        elif text[:-1].isalpha() and text[-1] in ".,;:!?":
            words = [text[:-1], text[-1]]
        else:
            words = _WORDS.findall(text)
        tokenize, letters, bytes_of = self.tokenize, self.letters, self.bytes_of
        return b"".join([bytes_of[t.id] for w in words for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(letters))])

    def __missing__(self, chunk: bytes) -> bytes:
        data = self.old.get(chunk)
        if data is None:
            plain = self.by_model and _PLAIN.fullmatch(chunk) and b"<|" not in chunk
            data = self._plain(chunk) if plain else self._whole(chunk.decode("utf-8", "surrogatepass"))
        self[chunk] = data
        return data

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text with the end id."""
        if not self.by_chunk:
            return [self._whole(t) + self.end_bytes for t in texts]
        out = []
        for t in texts:
            if len(self) > self.LIMIT:
                self.old = dict(self)
                self.clear()
            # split at the six ASCII white spaces
            out.append(b"".join(map(self.__getitem__, t.encode("utf-8", "surrogatepass").split())) + self.end_bytes)
        return out


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def _write(path: str, end_id: int, block_ids: int, block_docs: int):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_worker("tokens", _encoders.clear)
        encoder, part = _encoder(path, end_id), TaskContext.get().partitionId()
        seq, before, total = 0, 0, 0
        names: list[int | None] = []
        sizes: list[int] = []
        held: list[bytes] = []

        def block() -> pa.RecordBatch:
            payload = pack_block(names, np.cumsum(sizes), b"".join(held), encoder.width)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, seq, before, len(names), total, payload), schema, strict=True)], schema=schema)

        for batch in batches:
            for ids, texts in pieces(batch, "doc_id", "text"):
                for i, data in zip(ids, encoder.encode([t or "" for t in texts]), strict=True):
                    names.append(i)
                    held.append(data)
                    sizes.append(len(data) // encoder.width)
                    total += sizes[-1]
                    if total >= block_ids or len(names) >= block_docs:
                        yield block()
                        seq, before, total = seq + 1, before + total, 0
                        names, sizes, held = [], [], []
        if names:
            yield block()

    return run, "part int, seq int, before long, n_docs long, n_ids long, payload binary"


def write_blocks(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = 1 << 18, block_docs: int = 1 << 14, path: str | None = None) -> DataFrame:
    """docs(doc_id, text): the table of blocks, in ascending doc_id order by (part, seq); `before` counts the ids
    that come before a block in its part. With a path it is the corpus's tokens, written there and the caller's to keep;
    without one it is a scratch table."""
    n = shuffle_partitions(docs.sparkSession)
    order = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    order = order.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    run, schema = _write(tokenizer, end_id, block_ids, block_docs)
    return scratch(order.mapInArrow(run, schema), "token-blocks", path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The table of blocks that `write_blocks` left at path."""
    return spark.read.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for starts, payloads in pieces(batch, "start", "payload", rows=1):
            block = open_block(payloads[0])
            ends = block.ends.all().astype(np.int64)
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            data = memoryview(block.ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids(), pa.int64()), pa.array(begins + starts[0]), pa.array(ends - begins), pa.array(crcs, pa.int64())], schema=schema)


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the blocks' bytes."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per written part
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "part")
    return placed.select((F.col("offset") + F.col("before")).alias("start"), "payload").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
