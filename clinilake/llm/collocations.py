"""Phrase collocations: HAT-trie counting in tasks, merged by prefix partition.

1. A task numbers its words and counts phrases in a :class:`PhraseTrie`: a
   shallow trie over word ids with hash containers below; a container of more
   than :data:`BURST` phrases bursts into a node with a container for each next id.
   When the tries hold more than :data:`HELD` phrases, whole subtrees, the
   largest first, are spilled as sorted runs of rows.
2. Runs meet in the partition of their prefix (a hash of language and first two
   words) and are merged there: phrases of enough occurrences go on.  A task sends a
   phrase once for each spill, so no frequent phrase or first word makes a task large.
3. Single words and pairs are counted first.  A phrase of three words is as
   frequent as the rarer of its two pairs at most, so the second scan counts
   those whose pairs are both in a bitmap of the frequent pairs.  The bitmap has
   :data:`BITS` bits for each frequent pair, up to :data:`MOST_BITS` (16 MB, all
   that is broadcast); a wrong hit only costs a count, never a result.
4. Scores are whole-number arithmetic in 38 decimal digits.

Defined results: null and empty texts and texts of separators only have no
phrases; a null lang counts as ``und`` and together with rows that say so;
repeated rows count each time; long texts are read in slices, never cut
phrases; equal scores go by count, then by phrase (bytes of UTF-8); an empty
table gives no rows; extra columns are ignored.  Counts below 10**16 are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Occurrences that a candidate needs, percentage at which a longer one replaces it, rows for each language.
OCCURRENCES, REPLACED, TOP = 10, 50, 2000
#: Phrases of a container before it bursts, phrases of a task's tries before they spill.
BURST, HELD = 1 << 15, 1_000_000
#: First words of a branch of pairs, as a power of two; the lower id of two packed ones.
BRANCH, LOW = 8, 0xFFFFFFFF
#: Words counted at once, bytes of text read at once, distinct words of a task before it starts over.
AT_ONCE, SLICE, WORDS = 1 << 20, 1 << 20, 500_000
#: Parts of a language that are ranked apart first.
PARTS = 16
#: Bits of the bitmap for each frequent pair, and at most.
BITS, MOST_BITS = 32, 1 << 27

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
_SPACE = re.compile(rb"[ \t]")
#: The seed of Spark's xxhash64, and how far a second word's hash is turned.
SEED, TURN = 42, 21


class Words(dict):
    """Ids of words in the order of their first use; separators come first."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[bytes] = []
        for i in range(len(_SEPARATORS)):
            self[_SEPARATORS[i:i + 1]]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n


def word_ids(text: bytes, words: Words) -> np.ndarray:
    """The ids of a text's words and separators, a separator at the end."""
    parts, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        parts.append(np.fromiter(map(words.__getitem__, _TOKEN.findall(text[at:end].lower())), np.int64))
        at = end
    return np.concatenate([*parts, [0]])


class PhraseTrie:
    """Counts phrases of one language: branch -> hash container -> count.

    A phrase is its branch and two further ids, packed in one number.  The branch
    of single words and pairs is a block of first-word ids, that of longer phrases
    the first word itself.  A container that grows too large bursts into a node:
    a container for each of the next ids.
    """

    def __init__(self) -> None:
        self.root: dict[int, dict[int, int] | dict[int, dict[int, int]]] = {}
        self.burst: set[int] = set()
        self.sizes: dict[int, int] = {}

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def add(self, branch: np.ndarray, packed: np.ndarray, count: np.ndarray) -> None:
        """Distinct phrases in the order of their branches."""
        if not len(branch):
            return
        cuts = np.flatnonzero(np.diff(branch)) + 1
        starts = np.concatenate([[0], cuts])
        packed, count = packed.tolist(), count.tolist()
        for at, a, b in zip(branch[starts].tolist(), starts.tolist(), [*cuts.tolist(), len(packed)], strict=True):
            self._insert(at, packed[a:b], count[a:b])

    def _insert(self, branch: int, packed: list[int], count: list[int]) -> None:
        held = self.root.setdefault(branch, {})
        if branch in self.burst:
            grown = 0
            for p, n in zip(packed, count, strict=True):
                below = held.setdefault(p >> 32, {})
                last = p & LOW
                grown += last not in below
                below[last] = below.get(last, 0) + n
            self.sizes[branch] += grown
            return
        for p, n in zip(packed, count, strict=True):
            held[p] = held.get(p, 0) + n
        self.sizes[branch] = len(held)
        if len(held) > BURST:
            node: dict[int, dict[int, int]] = {}
            for p, n in held.items():
                node.setdefault(p >> 32, {})[p & LOW] = n
            self.root[branch] = node
            self.burst.add(branch)

    def take(self, branch: int) -> tuple[np.ndarray, np.ndarray]:
        """The packed ids and counts of a subtree, which leaves the trie."""
        held, size = self.root.pop(branch), self.sizes.pop(branch)
        if branch in self.burst:
            self.burst.discard(branch)
            packed = np.fromiter((a << 32 | b for a, below in held.items() for b in below), np.int64, size)
            return packed, np.fromiter((n for below in held.values() for n in below.values()), np.int64, size)
        return np.fromiter(held.keys(), np.int64, size), np.fromiter(held.values(), np.int64, size)


_RUNS = "lang string, w1 string, w2 string, w3 string, n long"


class Counter:
    """One scan: the phrases of a task's rows with their counts, each subtree a sorted run.

    Without a ``bitmap`` single words and pairs are counted, with one the phrases
    of three words whose pairs are both in it.
    """

    def __init__(self, bitmap: Broadcast | None = None) -> None:
        self.bitmap = bitmap

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tries, waiting, size = Words(), {}, {}, 0
        self.hashes = np.zeros(0, np.uint64)
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                ids = word_ids(text.as_py().encode(), words)
                waiting.setdefault(lang.as_py(), []).append(ids)
                size += len(ids)
                if size < AT_ONCE and len(words) < WORDS:
                    continue
                self._count(waiting, tries, words)
                waiting, size = {}, 0
                if len(words) >= WORDS:
                    yield from self._spilled(tries, words, 0)
                    words, tries = Words(), {}
                    self.hashes = np.zeros(0, np.uint64)
                elif sum(t.size for t in tries.values()) > HELD:
                    yield from self._spilled(tries, words, HELD // 2)
        self._count(waiting, tries, words)
        yield from self._spilled(tries, words, 0)

    def _count(self, waiting: dict[str, list[np.ndarray]], tries: dict, words: Words) -> None:
        if self.bitmap is not None:
            new = [xxhash.xxh64_intdigest(w, SEED) for w in words.names[len(self.hashes):]]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        for lang, parts in waiting.items():
            ids = np.concatenate(parts)
            word = ids >= len(_SEPARATORS)
            pair = word[:-1] & word[1:]
            if self.bitmap is not None:
                pair[pair] = self._frequent(lang, ids[:-1][pair], ids[1:][pair])
                at = np.flatnonzero(pair[:-1] & pair[1:])
                pairs, which = np.unique(ids[at] << 32 | ids[at + 1], return_inverse=True)
                found, count = np.unique(which << 32 | ids[at + 2], return_counts=True)
                pairs = pairs[found >> 32]
                tries.setdefault((lang, 3), PhraseTrie()).add(pairs >> 32, (pairs & LOW) << 32 | found & LOW, count)
                continue
            found, count = np.unique(ids[word], return_counts=True)
            tries.setdefault((lang, 1), PhraseTrie()).add(found >> BRANCH, found, count)
            at = np.flatnonzero(pair)
            found, count = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)
            tries.setdefault((lang, 2), PhraseTrie()).add(found >> 32 + BRANCH, found, count)

    def _frequent(self, lang: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have their bit: the hash of :func:`_pair_bit`, in numpy."""
        bits = np.frombuffer(self.bitmap.value, np.uint64)
        first, second = self.hashes[a] ^ np.uint64(xxhash.xxh64_intdigest(lang, SEED)), self.hashes[b]
        h = first ^ (second << np.uint64(TURN) | second >> np.uint64(64 - TURN))
        at = h & np.uint64(64 * len(bits) - 1)
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    @staticmethod
    def _spilled(tries: dict, words: Words, keep: int) -> Iterator[pa.RecordBatch]:
        """Whole subtrees, the largest first, until ``keep`` phrases are left, as sorted runs."""
        names = pa.array(words.names, pa.binary()).cast(pa.string())
        order = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names = names.take(pa.array(order))  # by rank
        total = sum(t.size for t in tries.values())
        # Subtrees below the least size that makes enough room stay.
        sizes = np.sort(np.array([n for t in tries.values() for n in t.sizes.values()], np.int64))[::-1]
        spilled = int(np.searchsorted(np.cumsum(sizes), total - keep)) + 1
        least = int(sizes[min(spilled, len(sizes)) - 1]) if len(sizes) else 0
        for (lang, length), trie in tries.items():
            branches = [b for b, n in trie.sizes.items() if n >= least]
            if not branches:
                continue
            taken = [trie.take(b) for b in branches]
            packed, count = (np.concatenate(x) for x in zip(*taken, strict=True))
            parts = [rank[packed & LOW]]
            if length > 1:
                parts.insert(0, rank[packed >> 32])
            if length > 2:
                parts.insert(0, np.repeat(rank[branches], [len(p) for p, _ in taken]))
            run = np.lexsort(parts[::-1])
            for at in range(0, len(run), 1 << 16):
                chosen = run[at:at + (1 << 16)]
                texts = [names.take(pa.array(part[chosen])) for part in parts]
                texts += [pa.nulls(len(chosen), pa.string())] * (3 - len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(chosen), np.int64))), *texts,
                     pa.array(count[chosen])], names=["lang", "w1", "w2", "w3", "n"])


def _counts(texts: DataFrame, bitmap: Broadcast | None = None) -> DataFrame:
    """(lang, w1, w2, w3, f): the tasks' runs, merged in the partition of their first two words."""
    keys = ["lang", "w1", "w2"]
    runs = texts.mapInArrow(Counter(bitmap), _RUNS).repartition(*keys)
    return runs.groupBy(*keys, "w3").agg(F.sum("n").alias("f"))


def _pair_bit(size: int) -> Column:
    """The bit of a pair in a bitmap of that size, a power of two; see :meth:`Counter._frequent`."""
    second = F.xxhash64("w2")
    turned = F.shiftleft(second, TURN).bitwiseOR(F.shiftrightunsigned(second, 64 - TURN))
    return F.xxhash64("w1").bitwiseXOR(F.xxhash64("lang")).bitwiseXOR(turned).bitwiseAND(F.lit(size - 1))


def _bitmap(pairs: DataFrame) -> bytes:
    """The bitmap of the pairs, made by Spark in words of 64 bits, at most MOST_BITS / 64 of them."""
    size, n = 1 << 16, pairs.count()
    while size < min(BITS * n, MOST_BITS):
        size *= 2
    rows = pairs.select(_pair_bit(size).alias("bit")).select(
        F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("m")).groupBy("w").agg(
        F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    return out.tobytes()


def phrase_counts(documents: DataFrame, occurrences: int = OCCURRENCES) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of one to three words that occur often enough,
    (lang, n): the occurrences of all words)."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    enough = F.col("f") >= occurrences
    short = stored(_counts(texts).where(enough | F.col("w2").isNull()), "short")
    bitmap = documents.sparkSession.sparkContext.broadcast(_bitmap(short.where("w2 is not null")))
    long = stored(_counts(texts, bitmap).where(enough), "long")
    totals = short.where("w2 is null").groupBy("lang").agg(F.sum("f").alias("n"))
    size = F.lit(1) + F.col("w2").isNotNull().cast("int") + F.col("w3").isNotNull().cast("int")
    return short.unionByName(long).where(enough).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), size.alias("size"), "f"), totals


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10**6 * a * a / (left * right)), exactly."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    product = (a * a).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", product, (left * right).cast("decimal(32,0)"))


def collocations(documents: DataFrame, occurrences: int = OCCURRENCES, replaced: int = REPLACED,
                 top: int = TOP) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(documents, occurrences)
    ws = F.split("phrase", " ")
    first, last = F.get(ws, F.lit(0)), F.element_at(ws, -1)
    longer = counts.where("size = 3").withColumn("head", F.array_join(F.slice(ws, 1, 2), " ")).withColumn(
        "tail", F.array_join(F.slice(ws, 2, 2), " "))
    inside = longer.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), "f").groupBy(
        "lang", "phrase").agg(F.max("f").alias("in_longer"))
    pairs = counts.where("size = 2").join(inside, ["lang", "phrase"], "left").where(
        F.col("in_longer").isNull() | (100 * F.col("in_longer") < replaced * F.col("f")))

    def parts(df: DataFrame, name: str, part: Column, size: int) -> DataFrame:
        """Adds the part's count, the part itself being at least as frequent."""
        known = counts.where(F.col("size") == size).select("lang", F.col("phrase").alias("_part"), F.col("f").alias(name))
        return df.withColumn("_part", part).join(known, ["lang", "_part"]).drop("_part")

    two = parts(parts(pairs, "l1", first, 1), "r1", last, 1).select(
        "lang", "phrase", F.col("f").alias("a"), F.array(F.struct(
            _score(F.col("f"), F.col("l1"), F.col("r1")).alias("score"), F.lit(1).alias("k"),
            F.col("l1").alias("l"), F.col("r1").alias("r"))).alias("cuts"))
    three = longer
    for name, part, size in (("l1", first, 1), ("r1", F.col("tail"), 2), ("l2", F.col("head"), 2), ("r2", last, 1)):
        three = parts(three, name, part, size)
    three = three.select("lang", "phrase", F.col("f").alias("a"), F.array(*[F.struct(
        _score(F.col("f"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
        F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]).alias("cuts"))
    # The lowest score counts, the smallest k among equal ones.
    scored = two.unionByName(three).withColumn("cut", F.array_min("cuts")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # A language's best are among the best of each of its parts, so its last
    # task sees at most PARTS * top phrases, however many there are.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    near = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(
        F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))
