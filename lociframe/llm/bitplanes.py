"""Token-id output as compressed bit planes.

Texts are encoded in ascending document order. Each shard (one range of documents) holds a run of
chunks of ``block_ids`` ids; a chunk's ids are transposed into bit (or byte) planes and every plane is
compressed with zstandard. The store is a folder of two Parquet tables:

``chunks``: shard, chunk, first (position of its first id in the shard), n_ids, planes (one compressed
    plane per bit or byte, lowest first), pieces (the documents in it: row in shard, doc_id, n).
``index``: shard, chunk, first_id (position over the whole store), n_ids, plane_bytes.

A chunk decodes alone, and Spark commits the files, so a lost executor costs its tasks only. A
document may span chunks; its CRC is combined from the CRCs of its pieces without holding its ids.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import worker_cache

BLOCK_IDS = 65_536
#: Words of one generation of a worker's memory; it keeps two, so frequent words stay.
MEMORY_WORDS = 400_000

#: Letters of ASCII and Latin-1.
_LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
#: Marks that are a piece of their own after letters: those of ASCII but the apostrophe, which may begin a contraction.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bytes of characters beyond Latin-1, where marks that compose with letters are.
_BEYOND = re.compile(b"[\xC4-\xFF]")

CHUNKS = "shard int, chunk int, first long, n_ids int, planes array<binary>, pieces array<struct<row: long, doc_id: long, n: int>>"
_PIECES = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32())]))


class _Ids(dict):
    """Ids of words as little-endian 32-bit bytes, found once per word while it is remembered.

    The tokenizer drops white space and case, so ids of a text are those of its words one after another.
    Texts of ASCII and Latin-1, where nothing composes, lose the case of ASCII letters at once, unless they may name a special
    token; in others only ASCII words do, as the tokenizer composes characters before it drops case. A word of such letters alone,
    where each capital has one small letter, goes straight to the tokenizer's model under
    its byte names; closing marks after it are a piece of their own; all else takes the whole way.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.older = tokenizer, tokenizer.model, {}
        self.names = {ord(c): "".join(p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}

    def _plain(self, core: bytes) -> str | None:
        """A word as the model takes it, where that is plain to see."""
        if core.isalpha():  # ASCII letters
            return core.decode() if core.islower() else None
        text = core.decode() if not core.isascii() else ""
        return text.lower().translate(self.names) if _LATIN.fullmatch(text) else None

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(_MARKS)
            plain = self._plain(core)
            if plain is None:
                ids = self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
            elif len(core) == len(word):
                ids = self._packed([t.id for t in self.model.tokenize(plain)])
            else:
                ids = self[core] + self[word[len(core) :]]
        if len(self) >= MEMORY_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: bytes) -> bytes:
        """Ids of a whole text."""
        if b"<|" in text:
            words = text.split()
        elif text.isascii() or not _BEYOND.search(text):
            words = text.lower().split()
        else:
            words = [w.lower() if w.isascii() else w for w in text.split()]
        return b"".join(map(self.__getitem__, words))


def encoder(path: str) -> _Ids:
    """The worker's word ids of the tokenizer file at ``path``."""
    from tokenizers import Tokenizer

    cache = worker_cache()
    if cache.get("tokenizer", (None,))[0] != path:
        cache["tokenizer"] = (path, _Ids(Tokenizer.from_file(path)))
    return cache["tokenizer"][1]


def to_planes(ids: np.ndarray, unit: str, width: int) -> list[bytes]:
    """Compressed planes of uint32 ids, lowest bit (or byte) first; ``width`` bits are kept."""
    import zstandard

    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : -(-width // 8)]
    planes = rows if unit == "byte" else np.unpackbits(rows, axis=1, bitorder="little")[:, :width]
    pack = zstandard.ZstdCompressor(level=3).compress
    return [pack(np.ascontiguousarray(p).tobytes() if unit == "byte" else np.packbits(p).tobytes()) for p in planes.T]


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The ids of a chunk from its planes."""
    import zstandard

    raw = [np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(p)), np.uint8) for p in planes]
    if unit == "bit":
        bits = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(raw):
            bits[:, k] = np.unpackbits(p, count=n)
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    rows = np.zeros((n, 4), np.uint8)
    for k, p in enumerate(raw):
        rows[:, k] = p
    return rows.view("<u4").ravel()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, unit: str = "byte", block_ids: int = BLOCK_IDS, width: int = 32) -> None:
    """Encode (doc_id, text) and write the store to ``folder``; unit is ``bit`` or ``byte``.

    Documents follow each other by doc_id, rows of an equal doc_id by a hash of the text; null ids come
    first. Null and empty texts have the end id alone. ``width`` is the number of bits an id may take;
    larger ids are an error. An empty table gives a store without chunks. Other columns are ignored.
    The tokenizer must be a byte-level one of words: it drops ASCII white space and case, merges nothing across
    white space and parts closing marks from letters.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        buffer, pieces, row, first, chunk, shard = bytearray(), [], 0, 0, 0, 0

        def cut() -> pa.RecordBatch:
            nonlocal buffer, pieces, first, chunk
            ids = np.frombuffer(bytes(buffer[: 4 * block_ids]), "<u4")
            if len(ids) and int(ids.max()) >> width:
                raise ValueError(f"an id needs more than {width} bits")
            held, n = [], 0
            while pieces and n < len(ids):
                take = min(pieces[0][2], len(ids) - n)
                held.append({"row": pieces[0][0], "doc_id": pieces[0][1], "n": take})
                n += take
                if take == pieces[0][2]:
                    pieces.pop(0)
                else:
                    pieces[0][2] -= take
            out = {"shard": [shard], "chunk": [chunk], "first": [first], "n_ids": [len(ids)], "planes": [to_planes(ids, unit, width)], "pieces": [held]}
            buffer, first, chunk = buffer[4 * block_ids :], first + len(ids), chunk + 1
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary()), _PIECES]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text, shard in zip(batch.column("doc_id").to_pylist(), texts, batch.column("shard").to_pylist(), strict=True):  # noqa: B020
                ids = ids_of.of(text.as_py() or b"") + end
                buffer += ids
                pieces.append([row, doc_id, len(ids) // 4])
                row += 1
                while len(buffer) >= 4 * block_ids:
                    yield cut()
        if buffer:
            yield cut()

    order = ["doc_id", "tie"]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    )
    spark = docs.sparkSession
    ordered.mapInArrow(encode, CHUNKS).write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    sizes = chunks.select("shard", "chunk", "first", "n_ids", F.transform("planes", F.length).alias("plane_bytes"))
    # One row per shard: the only ordered total, over some hundred ids' worth of bytes per GB of text.
    bases = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    sizes.join(bases, "shard").select("shard", "chunk", (F.col("base") + F.col("first")).alias("first_id"), "n_ids", "plane_bytes").write.parquet(f"{folder}/index")


def read_pieces(spark: SparkSession, folder: str, unit: str = "byte", with_ids: bool = True) -> DataFrame:
    """Pieces of documents: shard, row, doc_id, position (over the whole store), n, crc and the ids (null unless asked for)."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                ids = from_planes(chunk["planes"], chunk["n_ids"], unit).astype("<u4")
                ends = np.cumsum([p["n"] for p in chunk["pieces"]])
                parts = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk["shard"]] * len(parts), pa.int32()), pa.array([p["row"] for p in chunk["pieces"]], pa.int64()),
                    pa.array([p["doc_id"] for p in chunk["pieces"]], pa.int64()), pa.array(chunk["first_id"] + np.concatenate([[0], ends[:-1]]), pa.int64()),
                    pa.array([len(p) for p in parts], pa.int64()), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                    pa.array(parts if with_ids else [None] * len(parts), pa.list_(pa.int64())),
                ], names=["shard", "row", "doc_id", "position", "n", "crc", "ids"])

    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    index = spark.read.parquet(f"{folder}/index").select("shard", "chunk", "first_id")
    return chunks.join(index, ["shard", "chunk"]).mapInArrow(decode, "shard int, row long, doc_id long, position long, n long, crc long, ids array<long>")


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, bits reflected."""
    product, bit = 0, 1 << 31
    while bit:
        if a & bit:
            product ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        bit >>= 1
    return product


_SHIFTS = [1 << 23]  # x^8, and its repeated squares: the CRC moved on by 1, 2, 4 ... bytes
for _ in range(62):
    _SHIFTS.append(_times(_SHIFTS[-1], _SHIFTS[-1]))


def joined_crc(first: int, second: int, n_bytes: int) -> int:
    """CRC-32 of two byte strings in a row from their CRCs; the second has ``n_bytes``."""
    k = 0
    while n_bytes:
        if n_bytes & 1:
            first = _times(_SHIFTS[k], first)
        n_bytes >>= 1
        k += 1
    return first ^ second


def document_digests(pieces: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document from its pieces."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for parts in batch.column("parts").to_pylist():
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = joined_crc(crc, p["crc"], 4 * p["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    documents = pieces.groupBy("shard", "row").agg(
        F.max("doc_id").alias("doc_id"), F.min("position").alias("start"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("position", "n", "crc"))).alias("parts"))
    return documents.mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long")
