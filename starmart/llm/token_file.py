"""Token-ID output: shards of concatenated ids with Elias-Fano boundaries (operator 12).

Documents are range-partitioned and sorted by id; each task encodes its range and
packs it into shards of about ``SHARD_IDS`` ids.  A document is never split.  A
shard is one file:

    fixed head   magic "SMEF0001", then little-endian: format of an id in bytes
                 (2 or 4), low bits per boundary, low bits per document id,
                 a zero byte (uint8 each); shard's partition and number in it,
                 rows without a document id (uint32 each); documents, ids
                 (uint64 each); smallest document id (int64)
    ids          all ids of all documents in a row
    boundaries   Elias-Fano list of where each document ends
    documents    Elias-Fano list of the document ids, less the smallest; rows
                 without one stand first and are not in the list
    a line feed  (left by the writer)

Elias-Fano list of n non-decreasing numbers up to u: the low l = floor(log2(u/n))
bits of each in a row, and the high parts as a bit vector in which the k-th set bit
stands at place high + k.  That takes about 2 + log2(u/n) bits a number instead
of 64.  For each 256th set bit its place is kept (uint32), so ``select`` jumps
there and scans words from it on.

The files are written by Spark's text sink, one binary value each, so whatever
store the path names holds them, an attempt that is lost leaves no file, and they
are read back through the ``binaryFile`` source.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm._util import cut, slices

#: Ids of a shard (8 MB at two bytes an id) and set bits between two kept places.
SHARD_IDS = 1 << 22
SELECT = 256
#: Different words whose ids a worker remembers from batch to batch.
CACHE_WORDS = 1 << 19

_HEAD = struct.Struct("<8s4B3I2Qq")
_MAGIC = b"SMEF0001"


# ---------------------------------------------------------------- Elias-Fano lists

def low_bits(n: int, most: int) -> int:
    """Low bits of each of ``n`` numbers up to ``most``."""
    return max(0, (most // n).bit_length() - 1) if n else 0


def _sections(n: int, low: int, most_high: int) -> tuple[int, int, int]:
    """Bytes of the low parts, of the high parts (whole words) and of the places."""
    return (-(-n * low // 8), -(-(most_high + n) // 64) * 8 if n else 0, 4 * -(-n // SELECT))


def pack_list(values: np.ndarray) -> bytes:
    """Non-decreasing numbers as an Elias-Fano list; its first eight bytes hold
    the largest number."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    most = int(values[-1]) if n else 0
    low = low_bits(n, most)
    high = (values >> np.uint64(low)).astype(np.int64)
    at = high + np.arange(n)
    _, high_bytes, _ = _sections(n, low, int(high[-1]) if n else 0)
    bits = np.zeros(high_bytes * 8, np.uint8)
    bits[at] = 1
    lows = np.empty((n, low), np.uint8)
    for k in range(low):
        lows[:, k] = (values >> np.uint64(k)) & np.uint64(1)
    return b"".join((struct.pack("<Q", most), np.packbits(lows.ravel(), bitorder="little").tobytes(),
                     np.packbits(bits, bitorder="little").tobytes(),
                     at[::SELECT].astype("<u4").tobytes()))


class EliasFano:
    """An Elias-Fano list inside ``data`` from byte ``at`` on."""

    def __init__(self, data: bytes, at: int, n: int, low: int):
        self.n, self.low = n, low
        most, = struct.unpack_from("<Q", data, at)
        low_bytes, high_bytes, place_bytes = _sections(n, low, most >> low)
        at += 8
        self._lows = np.frombuffer(data, np.uint8, low_bytes, at)
        at += low_bytes
        self._words = np.frombuffer(data, "<u8", high_bytes // 8, at)
        at += high_bytes
        self._places = np.frombuffer(data, "<u4", place_bytes // 4, at)
        self.end = at + place_bytes

    def select(self, i) -> np.ndarray:
        """The ``i``-th numbers (from 0), for an array of places ``i``: from the
        kept place of every 256th, words are scanned side by side."""
        i = np.asarray(i, np.int64)
        parts = [self._select(i[s:s + 65536]) for s in range(0, len(i), 65536)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _select(self, i: np.ndarray) -> np.ndarray:
        place = self._places[i // SELECT].astype(np.int64)
        rest = i % SELECT  # set bits still to pass, after the one at ``place``
        word = place >> 6
        bits = self._words[word] >> (place & 63).astype(np.uint64) << (place & 63).astype(np.uint64)
        active = np.arange(len(i))
        while True:
            held = np.bitwise_count(bits[active]).astype(np.int64)
            active, held = active[rest[active] >= held], held[rest[active] >= held]
            if not len(active):
                break
            rest[active] -= held
            word[active] += 1
            bits[active] = self._words[word[active]]
        where = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                         bitorder="little"))
        first = np.searchsorted(where[0], np.arange(len(i)))
        high = (word << 6) + where[1][first + rest] - i
        return (high << self.low) | self._low_parts(i)

    def _low_parts(self, i: np.ndarray) -> np.ndarray:
        bit = i[:, None] * self.low + np.arange(self.low)
        bits = (self._lows[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1)


# ----------------------------------------------------------------------- one shard

def pack_shard(doc_ids: list[int | None], ids: list[bytes], width: int, partition: int = 0,
               number: int = 0) -> bytes:
    """A shard of documents in ascending order of id (None first), each with its
    ids as little-endian bytes of ``width``."""
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    above = known.astype(np.uint64) - np.int64(least).astype(np.uint64)  # modulo 2**64
    total = int(ends[-1]) if len(ends) else 0
    most = int(above[-1]) if len(above) else 0
    head = _HEAD.pack(_MAGIC, width, low_bits(len(ends), total), low_bits(len(known), most), 0,
                      partition, number, len(doc_ids) - len(known), len(ends), total, least)
    return b"".join((head, *ids, pack_list(ends), pack_list(above)))


class Shard:
    """A shard file's bytes: ``bounds`` and ``ids`` by document number."""

    def __init__(self, data: bytes):
        (magic, self.width, low, low_doc, _, self.partition, self.number, self.unnamed, self.n,
         self.total, self._least) = _HEAD.unpack_from(data, 0)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        self._ids = memoryview(data)[_HEAD.size:_HEAD.size + self.total * self.width]
        self.ends = EliasFano(data, _HEAD.size + self.total * self.width, self.n, low)
        self._docs = EliasFano(data, self.ends.end, self.n - self.unnamed, low_doc)

    def bounds(self, i) -> tuple[np.ndarray, np.ndarray]:
        """First id and end of the ``i``-th documents."""
        i = np.asarray(i, np.int64)
        start = np.zeros(len(i), np.int64)
        start[i > 0] = self.ends.select(i[i > 0] - 1)
        return start, self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document."""
        start, end = self.bounds([i])
        part = self._ids[int(start[0]) * self.width:int(end[0]) * self.width]
        return np.frombuffer(part, f"<u{self.width}")

    def all_ids(self) -> np.ndarray:
        return np.frombuffer(self._ids, f"<u{self.width}")

    def doc_ids(self) -> list[int | None]:
        above = self._docs.select(np.arange(self.n - self.unnamed))
        return [None] * self.unnamed + (above + self._least).tolist()


# ------------------------------------------------------------------------ encoding

#: The normalizers and the pre-tokenizers of the tokenizer files
#: whose words can be encoded one by one.
_WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: ASCII and Latin-1 letters (UTF-8), then ASCII marks.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([!-/:-@\[-`{-~]*)")
#: A full stop or comma between such a letter and white space or the end: the
#: pre-tokenizer cuts it off, and a word is remembered once, not once with each.
_CLOSING = re.compile(rb"[,.](?:(?<=[A-Za-z].)|(?<=\xC3[\x80-\x96\x98-\xB6\xB8-\xBF].))"
                      rb"(?![^\x20\x09-\x0D])")


class _Encoder:
    """Texts (UTF-8) to ids by a tokenizer file of the ``tokenizers`` library.

    A tokenizer that drops white space, folds case and cuts words from
    punctuation gives a word the same ids wherever it stands.  For such files
    the ids of words are remembered, and a word of Latin letters (which its
    normalizers only fold) goes straight to the library's BPE model; all others
    pass the library as a whole.  When the memory is full, those of the batch at
    hand stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        described = json.loads(self.tokenizer.to_str())
        parts = lambda k, s: (described.get(k) or {}).get(s) or []
        cutters = parts("pre_tokenizer", "pretokenizers")
        self.by_word = (
            [x["type"] for x in parts("normalizer", "normalizers")] == _WORD_NORMALIZERS
            and [x["type"] for x in cutters] == ["Split", "ByteLevel"]
            and cutters[0]["pattern"] == {"Regex": _WORD_PATTERN}
            and not cutters[1]["add_prefix_space"] and not described.get("post_processor")
            and described["model"]["type"] == "BPE")
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        if self.by_word:
            from tokenizers.pre_tokenizers import ByteLevel
            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self._level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._known: dict[bytes, bytes] = {}

    def as_bytes(self, ids: list[int]) -> bytes:
        out = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        return [self.as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(
            [t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    def _learn(self, words: Iterable[bytes]) -> None:
        known, tokenize, as_bytes = self._known, self.tokenizer.model.tokenize, self.as_bytes
        whole, marked = [], []
        for word in words:
            if word.isalpha():  # ASCII
                known[word] = as_bytes([t.id for t in tokenize(word.lower().decode())])
                continue
            m = _PLAIN.fullmatch(word)
            if m is None or m[2][:1] == b"'":
                whole.append(word)
            elif m[2]:
                marked.append((word, m[1], m[2]))
                if m[2] not in known:
                    whole.append(m[2])
            else:
                low = word.decode().lower().translate(self._level)
                known[word] = as_bytes([t.id for t in tokenize(low)])
        if whole:
            known.update(zip(whole, self._whole(whole)))
        if marked:
            self._learn({letters for _, letters, _ in marked if letters not in known})
            known.update((word, known[letters] + known[mark]) for word, letters, mark in marked)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        if not self.by_word:
            return self._whole(texts)
        # Split at ASCII white space and before a closing mark.  Folding A-Z first changes
        # nothing but where a mark could join a letter, or a special token be spelled.
        words = [_CLOSING.sub(rb" \g<0>", t if b"\xCC" in t or b"\xCD" in t or b"<|" in t
                              else t.lower()).split() for t in texts]
        if len(self._known) > CACHE_WORDS:
            self._known = {w: self._known[w] for ws in words for w in ws if w in self._known}
        out, has, get = [], self._known.__contains__, self._known.__getitem__
        for ws in words:
            new = set(filterfalse(has, ws))
            if new:
                self._learn(new)
            out.append(b"".join(map(get, ws)))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


# --------------------------------------------------------------------- Spark steps

def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                 shard_ids: int = SHARD_IDS, id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    """Encode the texts of ``docs`` and write them as shards under ``path``, which
    must not exist.

    ``tokenizer`` is a file that every executor can open under that name;
    ``end_id`` is appended to each document.  A null text is an empty document.
    Documents stand in ascending order of id, those without one first; rows that
    repeat an id in the order of a hash of their text, then of the text.  A text
    of any length stays whole, in a shard that closes after it.  Other columns,
    whatever their names, are not read.  An empty table leaves no shard.
    """
    def pack(batches):
        encoder = _encoder(tokenizer)
        end = encoder.as_bytes([end_id]) if end_id is not None else b""
        partition = TaskContext.get().partitionId()
        docs_, ids, held, number = [], [], 0, 0
        one = lambda: pa.RecordBatch.from_arrays(
            [pa.array([pack_shard(docs_, ids, encoder.width, partition, number)], pa.binary())],
            names=["shard"])
        for b in slices(batches, "text", 2 << 20):
            texts = b.column("text").to_pylist()
            for d, x in zip(b.column("doc_id").to_pylist(), encoder.encode(texts)):
                docs_.append(d)
                ids.append(x + end)
                held += len(ids[-1]) // encoder.width
                if held >= shard_ids:
                    yield one()
                    docs_, ids, held, number = [], [], 0, number + 1
        if docs_:
            yield one()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    shards = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
              .withColumn("_tie", F.xxhash64("text"))
              .repartitionByRange(*order).sortWithinPartitions(*order, "text")
              .select("doc_id", "text").mapInArrow(pack, "shard binary"))
    (shards.select(F.col("shard").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    return path


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the shards under ``path``: partition, number (of the
    shard), place (in it), doc_id, first (its first id, counted in the shard),
    n_tokens, ids_crc32 (of its ids as little-endian 32-bit integers), and with
    ``with_ids`` the ids as array."""
    def unpack(batches):
        for b in batches:
            for data in b.column("content").to_pylist():
                shard = Shard(data)
                start, end = shard.bounds(np.arange(shard.n))
                ids = shard.all_ids().astype("<u4")
                parts = [ids[s:e] for s, e in zip(start.tolist(), end.tolist())]
                columns = [np.full(shard.n, shard.partition), np.full(shard.n, shard.number),
                           np.arange(shard.n)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int32()) for c in columns],
                     pa.array(shard.doc_ids(), pa.int64()), pa.array(start), pa.array(end - start),
                     pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                     *([pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))]
                       if with_ids else [])],
                    names=_COLUMNS + ["ids"] * with_ids)
    schema = ("partition int, number int, place int, doc_id long, first long, n_tokens long, "
              "ids_crc32 long" + ", ids array<int>" * with_ids)
    # A task of an empty range leaves an empty file.
    return (spark.read.format("binaryFile").load(path).where("length > 0").select("content")
            .mapInArrow(unpack, schema))


_COLUMNS = ["partition", "number", "place", "doc_id", "first", "n_tokens", "ids_crc32"]


def token_index(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read_tokens`` (cut from their lineage) with ``start``: the ids
    of all documents before, in the order of the shards."""
    shards = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("_n"))
    inside = Window.partitionBy("partition").orderBy("number")
    shards = shards.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
    # One row per partition of the writing job.
    parts = shards.groupBy("partition").agg(F.sum("_n").alias("_all")).select(
        F.col("partition").alias("_p"),
        (F.sum("_all").over(Window.orderBy("partition")) - F.col("_all")).alias("_earlier"))
    offsets = (shards.join(parts, F.col("partition") == F.col("_p"))
               .select("partition", "number", (F.col("_before") + F.col("_earlier")).alias("_offset")))
    return (rows.join(offsets, ["partition", "number"])
            .withColumn("start", F.col("first") + F.col("_offset")).drop("_offset"))


def encode_and_index(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                     **options) -> DataFrame:
    """Write ``docs`` under ``path`` and index what the files hold: doc_id, start,
    n_tokens, ids_crc32, partition, number, place.  The index no longer needs the
    files."""
    write_tokens(docs, path, tokenizer, end_id, **options)
    return token_index(cut(read_tokens(docs.sparkSession, path))).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "partition", "number", "place")
