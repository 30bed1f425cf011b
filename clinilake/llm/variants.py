"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

1. Words of all whole texts are counted, each document's equal words first.
   A word stands for its bytes in Latin-1, where every letter that counts is one
   byte, so that code points can be compared as a matrix of bytes.
2. Two words, the longer of m code points, are one edit apart if and only if
   their lengths differ by at most one and their common prefix and their common
   suffix together reach m - 1.  With the places 0..m cut into :data:`SEGMENTS`
   spans, the prefix ends in exactly one span, and all letters before and after
   that span are shared: words meet in a *tile* of that span, m, and those
   letters' hash.  No other words need to be compared, and a pair counts only in
   the tile of the span in which its prefix ends.
3. A tile of more than a block of words is cut into blocks, and each pair of
   blocks is compared by a task of its own: padded matrices, left-aligned for
   the prefixes and right-aligned for the suffixes.  A tile puts out a row for
   each word with a partner (their number, the best), never pairs.
4. A word's form is its most frequent neighbour, if that is at least
   :data:`RATIO` times as frequent.  Frequencies at least double from word to
   form, so the ways to the roots are short; pointer doubling ends them.

Defined results: null and empty texts have no words; a null doc_id is written
as the empty text before the colon; repeated rows count each time; a word's
length is unbounded (long texts are read in slices that end between words);
ties of frequency go to the smallest word in code-point order; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinilake.operators.joins import fits_broadcast

from .common import stored

#: Words have at least so many code points and occurrences.
LETTERS, OCCURRENCES = 5, 3
#: One of so many words of a document loses a letter.
SLIP = 97
#: A form is at least so many times as frequent as its word.
RATIO = 2
#: Spans in which a common prefix may end; more make smaller tiles and more rows.
SEGMENTS = 3
#: Words of a block, fewer where words are very long.
BLOCK, BLOCK_BYTES = 512, 1 << 22
#: Bytes compared at once, bytes of text read at once, words counted before they go on.
COMPARED, SLICE, HELD = 1 << 24, 1 << 22, 200_000

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LETTERS)
_BETWEEN = re.compile(rb"[^a-z\xc0-\xff]")


def _slices(data: bytes) -> Iterator[bytes]:
    """The text in parts of bounded size, cut between words."""
    at = 0
    while at < len(data):
        cut = _BETWEEN.search(data, at + SLICE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def document_words(doc_id: str, text: str) -> Iterator[tuple[bytes, int]]:
    """The text's words in Latin-1, after slips, and how often they occur."""
    # Whatever is not in Latin-1 is no letter here; bytes.lower() knows A-Z only.
    found: Counter[bytes] = Counter()
    for part in _slices(text.encode("latin-1", "replace").lower()):
        found.update(_RUN.findall(part))
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % SLIP == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
            if len(run) < LETTERS:
                continue
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = defaultdict(int)

    def given() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())],
            names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            for word, n in document_words(doc_id.as_py(), text.as_py()):
                held[word] += n
            if len(held) > HELD:
                yield given()
    yield given()


def word_counts(documents: DataFrame, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of every word with so many occurrences."""
    texts = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("doc_id", "text")])
    return (texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= occurrences))


def _cut(i: int, m: Column | int) -> Column | int:
    """Where the i-th span of m places begins."""
    return F.floor(i * m / SEGMENTS).cast("int") if isinstance(m, Column) else i * m // SEGMENTS


def _block(m: Column) -> Column:
    return F.greatest(F.lit(16), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / m)))


def _tiled(words: DataFrame) -> DataFrame:
    """Rows (m, span, h, low, high, block, word, n): each word in its tiles' pairs of blocks."""
    size = F.length("word")
    m = F.col("m")
    spans = F.array(*[
        F.struct(F.lit(i).alias("span"),
                 F.xxhash64(F.substring("word", F.lit(1), _cut(i, m)),
                            F.substring("word", size - m + _cut(i + 1, m) + 1, m - _cut(i + 1, m))).alias("h"))
        for i in range(SEGMENTS)])
    keyed = (words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
             .select("word", "n", "m", F.inline(spans)))
    tile = ["m", "span", "h"]
    # Tiles of more than a block: at most 2 * SEGMENTS / BLOCK of the words, and
    # broadcast only where they are shown to be few.
    large = stored(keyed.groupBy(*tile).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > _block(m))
                   .select(*tile, F.ceil(F.col("size") / _block(m)).cast("int").alias("blocks")), "large")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    return (keyed.join(F.broadcast(large) if fits_broadcast(large) else large, tile, "left")
            .select(*tile, "word", "n", own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            .select(*tile, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "word", "n"))


def near_pairs(words: list[bytes], a: np.ndarray, b: np.ndarray, m: int, span: int) -> np.ndarray:
    """Which pairs (words[a], words[b]) of different words are one edit apart,
    the longer of m letters, with a common prefix that ends in the span."""
    size = np.array([len(w) for w in words])
    left = np.array(words, dtype=f"S{m}").view(np.uint8).reshape(len(words), m)
    right = np.array([w[::-1] for w in words], dtype=f"S{m}").view(np.uint8).reshape(len(words), m)
    low, high = _cut(span, m), _cut(span + 1, m)
    out = np.zeros(len(a), bool)
    step = max(1, COMPARED // m)
    for at in range(0, len(a), step):
        x, y = a[at:at + step], b[at:at + step]
        prefix = (left[x] == left[y]).argmin(axis=1)
        suffix = (right[x] == right[y]).argmin(axis=1)
        out[at:at + step] = ((prefix + suffix >= m - 1) & (prefix >= low) & (prefix < high)
                             & (np.maximum(size[x], size[y]) == m))
    return out


def _pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within runs of equal numbers, by their distance."""
    rows = np.arange(len(group))
    distance = 1
    while len(rows):
        rows = rows[rows + distance < len(group)]
        rows = rows[group[rows] == group[rows + distance]]
        yield rows, rows + distance
        distance += 1


def _partners(m: int, span: int, words: list[bytes], n: np.ndarray, group: np.ndarray, block: np.ndarray,
              cross: np.ndarray) -> pa.RecordBatch:
    """A row for each word that has partners in its pair of blocks."""
    found: list[np.ndarray] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def compare() -> None:
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        near = near_pairs(words, a, b, m, span)
        found.append(np.stack([a[near], b[near]]))
        held.clear()

    for a, b in _pairs(group):
        apart = ~cross[a] | (block[a] != block[b])
        held.append((a[apart], b[apart]))
        if sum(len(x) for x, _ in held) * m > COMPARED:
            compare()
    if held:
        compare()
    ends = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
    source, target = np.concatenate([ends, ends[::-1]], axis=1)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words, dtype=f"S{m}"), kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[target], -n[target], source))
    source, target = source[order], target[order]
    who, first, count = np.unique(source, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i].decode("latin-1") for i in who], pa.string()), pa.array(count, pa.int64()),
         pa.array(n[target[first]], pa.int64()),
         pa.array([words[i].decode("latin-1") for i in target[first]], pa.string())],
        names=["word", "n_near", "form_n", "form"])


_TILE = ("m", "span", "h", "low", "high")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair of blocks, compared in whole pairs."""
    held: pa.Table | None = None

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table.column(c).to_numpy() for c in _TILE])
        new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        group = np.cumsum(new)
        alone = np.concatenate([new, [True]])
        busy = ~(alone[:-1] & alone[1:])  # words that share their tile
        kind = keys[0] * SEGMENTS + keys[1]
        words = np.array(table.column("word").to_pylist() + [None], dtype=object)[:-1]
        n, block = table.column("n").to_numpy(), table.column("block").to_numpy()
        for k in np.unique(kind[busy]):
            rows = np.flatnonzero(busy & (kind == k))
            yield _partners(int(k) // SEGMENTS, int(k) % SEGMENTS, [w.encode("latin-1") for w in words[rows]],
                            n[rows], group[rows], block[rows], keys[3, rows] != keys[4, rows])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        held = pa.concat_tables([held, table]) if held is not None else table
        keys = np.stack([held.column(c).to_numpy() for c in _TILE])
        last = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
        if len(last):
            at = int(last[-1]) + 1
            yield from done(held.slice(0, at))
            held = held.slice(at)
    if held is not None:
        yield from done(held)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): of each word with neighbours their number and the most frequent one."""
    order = (-F.col("form_n")).alias("less")
    return (_tiled(words).repartition(*_TILE).sortWithinPartitions(*_TILE)
            .mapInArrow(_compared, "word string, n_near long, form_n long, form string")
            .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(order, "form")).alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round doubles the way that is known."""
    known = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = stored(known.join(ahead, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        known = further.select("word", "root")
        if not further.agg(F.count_if("moved")).first()[0]:
            return known


def group(documents: DataFrame, occurrences: int = OCCURRENCES, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stored(word_counts(documents, occurrences), "words")
    enough = F.col("form_n") >= ratio * F.col("n")
    judged = stored(words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "judged")
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
