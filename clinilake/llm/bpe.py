"""Byte-level BPE encoding that reuses chunks shared across documents.

Texts are cut where a rolling hash of the last ``WINDOW`` bytes says so, so
equal passages are cut alike wherever they stand.

1. A first scan counts the chunks' 128-bit hashes; those found twice or more
   are *shared*.  They set bits in a bitmap of fixed size, the only thing
   broadcast; where the corpus is so large that most bits are set, more chunks
   than the shared ones take the way below, with the same result.
2. A second scan sends on the text of each chunk whose bit is set, one for each
   hash, and every such chunk is encoded once.
3. Documents without such a chunk are encoded where they are read.  The others
   give pieces: shared chunks by hash, and what lies between, encoded.  Pieces
   meet the ids of their chunk in a join and their document in a group.
4. A join of two pieces is repaired: the ids from the last sure break on its
   left to the first sure break on its right are replaced by encoding that text
   anew.  A *sure break* lies between an ASCII letter and a space: no piece of
   the vocabulary's pattern reaches over it, and nothing before it changes what
   follows.  Where a side has none, the text grows over the next pieces, up to
   the whole document, so the ids agree exactly with those of the whole text.

Only byte-level vocabularies of the ``tokenizers`` library are meant: each id
stands for fixed bytes, and decoding joins those bytes.

Defined results: a null or empty text has no ids and decodes to an empty text;
rows that repeat each get a row; a null doc_id is kept; extra columns are
ignored; an empty table gives no rows.  Special tokens' strings inside a text
become their ids, as in the library.  A long text is encoded in stretches
between sure breaks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import stored
from .vocabulary import BREAK, Vocabulary, vocabulary

#: Bytes that the rolling hash sees, and the mean, least and greatest length of chunks.
WINDOW, MEAN, LEAST, MOST = 32, 1024, 256, 8192
#: Bits of the bitmap of shared chunks: 8 MB.
BITMAP_BITS = 1 << 26
#: Rows of a batch that are taken at a time.
ROWS = 256


def _cuts(data: np.ndarray, rows: np.ndarray) -> list[list[int]]:
    """For each row of a block, the ends of its chunks (the last is its end).

    A place may end a chunk where the hash of the WINDOW bytes before it has
    its top bits unset and the next byte begins a character.
    """
    n = len(data)
    marks = np.zeros(0, np.int64)
    if n > WINDOW:
        shingles._POWERS.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(shingles._LETTER[data] * shingles._POWERS.up[:n], out=sums[1:])
        rolling = (sums[WINDOW:n] - sums[:n - WINDOW]) * shingles._POWERS.down[:n - WINDOW]
        hit = (rolling >> np.uint64(64 - MEAN.bit_length() + 1)) == 0
        hit &= (data[WINDOW:n] & 0xC0) != 0x80
        marks = np.flatnonzero(hit) + WINDOW
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        own = marks[np.searchsorted(marks, a + WINDOW):np.searchsorted(marks, b)].tolist()
        ends, last = [], a
        for m in [*own, b]:
            while m - last > MOST:
                cut = last + MOST
                while (data[cut] & 0xC0) == 0x80:
                    cut -= 1
                ends.append(cut)
                last = cut
            if m == b or m - last >= LEAST:
                ends.append(m)
                last = m
        out.append(ends if b > a else [])
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, which bounds what a worker holds."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _chunked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(row, its chunks) of a batch."""
    for first, data, rows in shingles.text_blocks(batch.column("text")):
        raw = data.tobytes()
        for k, ends in enumerate(_cuts(data, rows)):
            begins = [int(rows[k]), *ends]
            yield first + k, [raw[a:b] for a, b in zip(begins[:-1], ends, strict=True)]


def _print(chunk: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(chunk), np.int64).tolist())


def _bit(h: int) -> int:
    return h & (BITMAP_BITS - 1)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        found = [_print(c) for _, chunks in _chunked(batch) for c in chunks]
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["h", "g"])


class _Reuse:
    """The two ways of a document, by the broadcast bitmap of shared chunks."""

    def __init__(self, path: str, bits: Broadcast, keys: tuple[str, ...]) -> None:
        self.path, self.bits, self.keys = path, bits, keys

    def _hit(self, h: int) -> bool:
        bit = _bit(h)
        return bool(self.bits.value[bit >> 3] >> (bit & 7) & 1)

    def chunk_texts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks whose bit is set, once for each part: h, g, text."""
        for batch in _parts(batches):
            found = {}
            for _, chunks in _chunked(batch):
                for c in chunks:
                    if self._hit((p := _print(c))[0]):
                        found.setdefault(p, c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64()),
                 pa.array([c.decode() for c in found.values()], pa.string())], names=["h", "g", "text"])

    def chunk_ids(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(self.path)
        for batch in _parts(batches):
            ids = vocab.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("g"), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["h", "g", "chunk_ids"])

    def alone(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a chunk whose bit is set: doc_id and what is carried, ids."""
        vocab = vocabulary(self.path)
        for part in _parts(batches):
            own = [(k, vocab.encode_one(b"".join(chunks).decode()).tobytes())
                   for k, chunks in _chunked(part) if not any(self._hit(_print(c)[0]) for c in chunks)]
            at = pa.array([k for k, _ in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c).take(at) for c in self.keys], pa.array([x for _, x in own], pa.binary())],
                names=[*self.keys, "ids"])

    def pieces(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other documents' pieces: doc_id and what is carried, text's print, place, h, g, ids (null: a chunk's)."""
        vocab = vocabulary(self.path)
        types = [*[pa.int64()] * len(self.keys), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for part in _parts(batches):
            rows: list[tuple] = []
            for k, chunks in _chunked(part):
                hits = [(p, self._hit(p[0])) for p in map(_print, chunks)]
                if not any(hit for _, hit in hits):
                    continue
                whole = (*[part.column(c)[k].as_py() for c in self.keys], *_print(b"".join(chunks)))
                run: list[bytes] = []
                for at, (c, (p, hit)) in enumerate(zip(chunks, hits, strict=True)):
                    if hit:
                        rows.append((*whole, at, *p, None))
                    else:
                        run.append(c)
                        if at + 1 == len(chunks) or hits[at + 1][1]:
                            rows.append((*whole, at, *p, vocab.encode_one(b"".join(run).decode()).tobytes()))
                            run = []
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                names=[*self.keys, "t", "u", "at", "h", "g", "run_ids"])

    def joined(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of a document, in order, made one: doc_id and what is carried, ids; a row for each copy."""
        vocab = vocabulary(self.path)
        for batch in _parts(batches):
            at, out = [], []
            for k, (copies, pieces) in enumerate(zip(batch.column("copies").to_pylist(), batch.column("pieces"),
                                                     strict=True)):
                ids = repaired([np.frombuffer(p["ids"].as_buffer(), vocab.dtype) for p in pieces.values], vocab)
                at += [k] * copies
                out += [ids.tobytes()] * copies
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows) for c in self.keys], pa.array(out, pa.binary())],
                names=[*self.keys, "ids"])


def _last_break(data: bytes) -> int:
    """The end of the last letter that a space follows, or -1."""
    at = data.rfind(b" ")
    while at > 0:
        if data[at - 1:at].isalpha():
            return at
        at = data.rfind(b" ", 0, at)
    return -1


def _at(ids: np.ndarray, vocab: Vocabulary, byte: int) -> int:
    """How many ids come before that byte, which some id begins at."""
    return int(np.searchsorted(np.cumsum(vocab.lengths[ids]), byte, "right")) if byte else 0


def repaired(pieces: list[np.ndarray], vocab: Vocabulary) -> np.ndarray:
    """The ids of the whole text whose consecutive parts have these ids."""
    done: list[np.ndarray] = []
    open_ids = np.zeros(0, vocab.dtype)  # from the last sure break on
    for piece in pieces:
        if not len(piece):
            continue
        data = vocab.decode(piece)
        first = BREAK.search(data)
        if not first:
            # No sure break in this piece: it joins what is open.
            open_ids = _again([open_ids, piece], vocab)
            continue
        begin = _at(piece, vocab, first.end())
        last = _at(piece, vocab, _last_break(data))
        head = piece[:begin]
        done.append(_again([open_ids, head], vocab))
        done.append(piece[begin:last])
        open_ids = piece[last:]
    return np.concatenate([np.zeros(0, vocab.dtype), *done, open_ids])


def _again(parts: list[np.ndarray], vocab: Vocabulary) -> np.ndarray:
    """The ids of the parts' joined text, encoded anew where both have some."""
    parts = [p for p in parts if len(p)]
    if len(parts) < 2:
        return parts[0] if parts else np.zeros(0, vocab.dtype)
    return vocab.encode([b"".join(map(vocab.decode, parts)).decode()])[0]


def _bitmap(shared: DataFrame) -> bytes:
    """The bitmap of the hashes: made by Spark in words, at most BITMAP_BITS / 64 rows."""
    bit = F.pmod(F.col("h"), F.lit(BITMAP_BITS))
    words = shared.select(F.floor(bit / 64).cast("long").alias("w"),
                          F.expr(f"shiftleft(1L, cast(pmod(h, {BITMAP_BITS}) % 64 as int))").alias("m"))
    rows = words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    return out.tobytes()


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _then(first: Step, second: Step | None) -> Step:
    """Both steps in one Python worker: a chain of them would hold one each."""
    return first if second is None else lambda batches: second(first(batches))


def _encoded(documents: DataFrame, path: str, schema: str, finish: Step | None = None,
             carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows of (doc_id, carried columns, ids) after ``finish``, for every row of ``documents``."""
    keys = ("doc_id", *carried)
    schema = schema.replace("doc_id long", ", ".join(f"{c} long" for c in keys))
    docs = documents.select(*[F.col(c).cast("long").alias(c) for c in keys], F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    counted = docs.mapInArrow(_prints, "h long, g long").groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))
    reuse = _Reuse(path, spark.sparkContext.broadcast(_bitmap(counted.where("n > 1").select("h"))), keys)

    texts = docs.mapInArrow(reuse.chunk_texts, "h long, g long, text string")
    chunks = stored(texts.groupBy("h", "g").agg(F.any_value("text").alias("text"))
                    .mapInArrow(reuse.chunk_ids, "h long, g long, chunk_ids binary"), "chunk_ids")
    pieces = docs.mapInArrow(
        reuse.pieces, ", ".join(f"{c} long" for c in keys) + ", t long, u long, at int, h long, g long, run_ids binary").join(
        chunks, ["h", "g"], "left")
    whole = pieces.groupBy(*keys, "t", "u").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("run_ids", "chunk_ids").alias("ids")))).alias("pieces"))
    # Rows that repeat id and text give each piece as often: keep one of each.
    copies = F.size(F.filter("pieces", lambda p: p["at"] == F.get(F.col("pieces"), F.lit(0))["at"]))
    once = F.filter("pieces", lambda p, k: (k == 0) | (p["at"] != F.get(F.col("pieces"), k - 1)["at"]))
    joined = whole.select(*keys, copies.alias("copies"), once.alias("pieces")).mapInArrow(
        _then(reuse.joined, finish), schema)
    return docs.mapInArrow(_then(reuse.alone, finish), schema).unionByName(joined)


IDS = "doc_id long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(documents: DataFrame, path: str, carried: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """(doc_id, carried columns, ids) of every row: ids as a binary of little-endian
    integers, two bytes each for vocabularies of up to 65,536 ids, else four.

    ``carried`` names columns of whole numbers that follow doc_id unchanged.
    With ``packed`` the binaries are compressed, for ids that move further.
    """
    keys = ("doc_id", *carried)
    return _encoded(documents, path, IDS, _mapped(keys, _press) if packed else None, carried)


def _press() -> Callable[[bytes], bytes]:
    return zstandard.ZstdCompressor().compress


def _expand() -> Callable[[bytes], bytes]:
    return zstandard.ZstdDecompressor().decompress


def _mapped(keys: tuple[str, ...], make: Callable[[], Callable[[bytes], bytes]]) -> Step:
    """A step that rewrites the ids' binaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = make()
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, keys), pa.array([change(x.as_buffer()) for x in part.column("ids")], pa.binary())],
                names=[*keys, "ids"])
    return run


def encode_decode(documents: DataFrame, path: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: ids, and the text they stand for.

    ``carried`` names columns of whole numbers that follow doc_id unchanged.
    """
    return _encoded(documents, path, DECODED, _decoded(path, ("doc_id", *carried)), carried)


def encode_digests(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return _encoded(documents, path, DIGESTS, _then(_decoded(path), _digests(path)))


def _decoded(path: str, keys: tuple[str, ...] = ("doc_id",)):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for part in _parts(batches):
            ids = [np.frombuffer(x.as_buffer(), vocab.dtype) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, keys), pa.array([len(x) for x in ids], pa.int64()), part.column("ids"),
                 pa.array([vocab.decode(x).decode("utf-8", "replace") for x in ids], pa.string())],
                names=[*keys, "n_tokens", "ids", "decoded"])
    return decode


def decode(encoded: DataFrame, path: str, carried: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """(doc_id, carried columns, n_tokens, ids, decoded): the text that the ids stand for, rows in their order."""
    keys = ("doc_id", *carried)
    step = _decoded(path, keys)
    schema = DECODED.replace("doc_id long", ", ".join(f"{c} long" for c in keys))
    return encoded.select(*keys, "ids").mapInArrow(_then(_mapped(keys, _expand), step) if packed else step, schema)


def _digests(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = vocabulary(path).dtype
        for batch in _parts(batches):
            ids = [hashlib.sha256(np.frombuffer(x.as_buffer(), dtype).astype("<u4").tobytes()).hexdigest()
                   for x in batch.column("ids")]
            texts = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in batch.column("decoded")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(ids, pa.string()),
                 pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return digest
