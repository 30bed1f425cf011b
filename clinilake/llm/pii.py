"""Personal data: base patterns, and a skip-chain conditional random field.

The base rules give the leftmost non-overlapping matches of each kind, checked
(parts of an address at most 255, Luhn's sum, counts of digits).

The field labels the *active* words of a text, those with a digit, an at sign
or a spelt-out one; all others are outside by definition, which keeps the graph
small however long the text.  Its factors are

* each word's shape, digits, neighbours and cue words;
* chain edges between active words next to each other;
* skip edges between distant words that are equal or alike (same letters
  whatever their case, same digits whatever their punctuation), each to the
  one before it, which favour the same label.

Marginals come from loopy message passing over all documents of a block at
once.  A run of words whose label is sure enough (``SURE``) and whose form is
possible for the kind becomes a span, unless a base span covers part of it:
base spans always stay.

The weights are fitted to sentences made from templates (``SENTENCES``) with a
fixed seed, by pseudo-likelihood: a bounded table that does not depend on the
corpus.  Documents are independent, nothing shuffles.

Defined results: a null or empty text has no spans; offsets are code points,
ends exclusive; rows that repeat each get a row; a null doc_id is kept; extra
columns are ignored by :func:`find` and kept by :func:`redact`; an active word
is taken whole, up to white space, however long; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
#: The field's labels: the kinds, and one that no base pattern has.
LABELS = (*KINDS, "secret")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SURE = 0.9
#: Messages are passed until none changes by more than TOLERANCE; graphs that do
#: not settle stop after ROUNDS and four more for each word of the longest document
#: (damped messages go half a word a round).
TOLERANCE, ROUNDS = 1e-3, 50
#: Weight of the squared weights in training.
DECAY = 0.05
#: Documents whose graphs are solved together.
TOGETHER = 256

Span = tuple[int, int, int]  # start, kind, end


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The checked matches of the base patterns, by start, then kind."""
    found: list[Span] = []
    # An address is the longest run of its first part's letters before an at
    # sign, back to the last match at most, if the rest follows.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (rest := _DOMAIN.match(text, at)):
            done = rest.end()
            found.append((start, 0, done))
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(map(_at_most_255, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# The field's words.

_SIGN = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]", re.I)
_AFTER = re.compile(r"\S*")
_SPELT_AT = re.compile(r"[\[(]at[\])]", re.I)
_SPELT_DOT = re.compile(r"[\[(]dot[\])]", re.I)
_FOUR = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_SECRET = re.compile(r"[A-Za-z0-9+/_-]{16,}=*\Z")
_LAST_WORD = re.compile(r"(\w+)\W*\Z")
#: Trimmed from the ends of a word.
_EDGES = ".,;:!?\"'<>[]{}|#*$%&"
# Words that announce a kind.
CUES = {
    "email": "mail", "mail": "mail", "contact": "mail", "write": "mail", "ip": "ip", "host": "ip", "server": "ip",
    "address": "ip", "card": "card", "visa": "card", "account": "card", "phone": "phone", "tel": "phone",
    "call": "phone", "fax": "phone", "mobile": "phone", "version": "no", "page": "no", "chapter": "no", "year": "no",
    "figure": "no", "isbn": "no", "order": "no", "item": "no", "license": "no", "commit": "no", "checksum": "no",
    "digest": "no", "hash": "no", "md5": "no", "token": "secret", "key": "secret", "secret": "secret",
    "password": "secret", "passwd": "secret",
}


def active_words(text: str) -> list[tuple[int, int]]:
    """Start and end of each active word, its edges trimmed, in order."""
    out: list[tuple[int, int]] = []
    at = 0
    while sign := _SIGN.search(text, at):
        start = sign.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _AFTER.match(text, sign.start()).end()
        at = max(end, sign.end())
        while start < end and text[start] in _EDGES:
            start += 1
        while end > start and text[end - 1] in _EDGES:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _bucket(n: int) -> str:
    return str(n) if n <= 4 else "5-8" if n < 9 else "9-11" if n < 12 else "12-15" if n < 16 else "16-19" if n < 20 else "20+"


def features(text: str, words: list[tuple[int, int]]) -> tuple[list[list[str]], list[tuple[int, int, int]]]:
    """Each word's features, and the edges (i, j, 0 for chain or 1 for skip)."""
    rows, edges = [], []
    near = [k > 0 and words[k][0] - words[k - 1][1] <= 2 and "\n" not in text[words[k - 1][1]:words[k][0]]
            for k in range(len(words))]
    # Digits of the run of words next to each other that a word stands in.
    runs: list[int] = []
    for k in range(len(words)):
        runs.append(runs[-1] if near[k] else k)
    together: dict[int, str] = {}
    for k, (a, b) in enumerate(words):
        together[runs[k]] = together.get(runs[k], "") + digits_of(text[a:b])
    last: dict[str, int] = {}
    for k, (a, b) in enumerate(words):
        w = text[a:b]
        digits, run = digits_of(w), together[runs[k]]
        shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "9", w[:24])))
        cue = _LAST_WORD.search(text[max(0, a - 24):a])
        own = ["one", f"shape={shape}", f"digits={_bucket(len(digits))}", f"run={_bucket(len(run))}",
               f"cue={CUES.get(cue[1].lower(), '') if cue else ''}", f"first={w[0] if not w[0].isalnum() else ''}"]
        own += [f"has={c}" for c in "@+().-=/_%:" if c in w]
        if _FOUR.fullmatch(w) and all(map(_at_most_255, w.split("."))):
            own.append("four")
        if 12 <= len(digits) <= 19 and luhn(digits):
            own.append("luhn")
        if 12 <= len(run) <= 19 and luhn(run):
            own.append("run_luhn")
        if len(digits) == len(w):
            own.append("only_digits")
        if digits and any(c.isalpha() for c in w):
            own.append("mixed")
        if _SPELT_AT.search(w) and _SPELT_DOT.search(w):
            own.append("spelt")
        if text[max(0, a - 1):a] == "+" or w[0] == "+":
            own.append("plus")
        rows.append(own)
        if near[k]:
            edges.append((k - 1, k, 0))
        # Alike: the last seven digits of long numbers, else the word without case.
        key = digits[-7:] if len(digits) >= 7 and not any(c.isalpha() for c in w) else w.lower()
        if key in last and not (near[k] and last[key] == k - 1):
            edges.append((last[key], k, 1))
        last[key] = k
    return rows, edges


# Training: sentences with marked data; 9 stands for a digit, N for a name.
SENTENCES = (
    "call <phone +9 (999) 999-9999> now", "phone <phone (999) 999-9999> or fax <phone 999-999-9999>",
    "tel <phone +99 99 9999 9999>, mobile <phone 999.999.9999>", "<phone +9 (999) 999-9999>",
    "the word <phone +9 999 999 9999> and text", "we said <phone (999) 999-9999> twice <phone (999) 999-9999>",
    "write to <email N.99@N.example.com> today", "mail <email N@N.org>, <email N_N@N.co.uk>",
    "contact <email N[at]N[dot]com>", "<email N(at)N(dot)org> and more", "and <email N@N.N.net>.",
    "server <ip 99.99.99.99> down", "host <ip 99.9.99.9>, <ip 9.99.9.99>", "the words <ip 99.99.99.99> of",
    "card <card CARD>", "visa <card CARD> paid", "of the <card CARD> and", "account <card SPACED> here",
    "License, Version 9.9", "version 9.9.9 of page 99", "in the year 9999 there were 99 of 999 items",
    "order 99999 item 999 for 99.99", "isbn 999-9-99-999999-9", "on 9999-99-99 at 99:99", "CC BY-NC 9.9.",
    "token = \"<secret HEX>\"", "<secret password=HEX>", "key <secret AKIAHEX> here", "api key: <secret HEX>,",
    "password <secret HEX>", "the secret \"<secret HEX>\" of", "commit HEX", "md5 HEX of it", "the words HEX and",
    "checksum \"HEX\"", "hash=HEX", "figure 9.9 chapter 9", "9 9 9 9", "999,999 and 9/9",
    "the number 9999999 was 99999999 of 9999999999999", "@N and @ N", "x9 y9 z99 a9b9c9", "99% of 9.9e9",
    "9999999999 is a count", "serial 999999999999999999999", "lot 9999-9999-9999",
)


def _filled(rng: np.random.Generator, sentence: str) -> str:
    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def card() -> str:
        body = "4" + digits(14)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))

    def name() -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9)))

    one = card()
    sentence = sentence.replace("SPACED", " ".join(one[k:k + 4] for k in range(0, 16, 4))).replace("CARD", one)
    digits_used = "0123456789abcdef" if rng.random() < 0.7 else "0123456789ABCDEF"
    sentence = sentence.replace("HEX", "".join(rng.choice(list(digits_used), int(rng.integers(16, 65)))))
    sentence = re.sub(r"(?<![A-Za-z])N(?![A-Za-z])", lambda _: name(), sentence)
    return re.sub(r"9", lambda _: str(rng.integers(0, 10)) if rng.random() < 0.8 else "1", sentence)


def _example(marked: str) -> tuple[str, list[Span]]:
    """A text without its marks, and the spans that they gave."""
    text, spans = "", []
    for part in re.split(rf"(<(?:{'|'.join(LABELS)}) [^>]*>)", marked):
        if m := re.fullmatch(r"<(\w+) ([^>]*)>", part):
            spans.append((len(text), LABELS.index(m[1]), len(text) + len(m[2])))
            part = m[2]
        text += part
    return text, spans


class Field:
    """Weights: a row of label scores for each feature, chain scores, skip scores."""

    def __init__(self, names: dict[str, int], unary: np.ndarray, pairs: np.ndarray) -> None:
        self.names, self.unary, self.pairs = names, unary, pairs

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), self.unary.shape[1]))
        for k, row in enumerate(rows):
            known = [self.names[f] for f in row if f in self.names]
            out[k] = self.unary[known].sum(axis=0)
        return out

    def marginals(self, scores: np.ndarray, edges: np.ndarray, longest: int | None = None) -> np.ndarray:
        """Loopy belief propagation: the labels' probabilities of each word.

        ``longest`` is the largest number of words that evidence may have to cross (by
        default all).
        """
        belief = scores.copy()
        if len(edges):
            a, b = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            psi = self.pairs[np.concatenate([edges[:, 2], edges[:, 2]])]
            psi[len(edges):] = psi[len(edges):].transpose(0, 2, 1)
            sent = np.zeros((len(a), scores.shape[1]))
            for _ in range(ROUNDS + 4 * (len(scores) if longest is None else longest)):
                out = psi + (belief[a] - sent[back])[:, :, None]
                top = out.max(axis=1, keepdims=True)
                new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
                new -= new.max(axis=1, keepdims=True)
                change = np.abs(new - sent).max()
                sent = 0.5 * sent + 0.5 * new
                belief = scores.copy()
                np.add.at(belief, b, sent)
                if change < TOLERANCE:
                    break
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def labels_of(words: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """Each word's label: 0 outside, else 1 + the kind of a span it meets."""
    out = np.zeros(len(words), int)
    for k, (a, b) in enumerate(words):
        for start, kind, end in spans:
            if a < end and start < b:
                out[k] = 1 + kind
    return out


def train(copies: int = 12, seed: int = 5, steps: int = 300) -> Field:
    """Fit all weights by pseudo-likelihood: each word given its neighbours' labels.

    Texts are joins of a few filled sentences, some said twice, so that skip
    edges occur.  ``copies`` bounds the table: so many texts for each sentence.
    """
    rng = np.random.default_rng(seed)
    rows, labels, edges = [], [], []
    for sentence in SENTENCES * copies:
        filled = [_filled(rng, s) for s in (sentence, str(rng.choice(SENTENCES)))]
        filled += [filled[0]] * int(rng.integers(0, 2))
        text, spans = _example(" some more words. ".join(filled))
        words = active_words(text)
        own, links = features(text, words)
        edges += [(i + len(rows), j + len(rows), t) for i, j, t in links]
        rows += own
        labels.append(labels_of(words, spans))
    y = np.concatenate(labels)
    names: dict[str, int] = {}
    for row in rows:
        for f in row:
            names.setdefault(f, len(names))
    x = np.zeros((len(rows), len(names)))
    for k, row in enumerate(rows):
        x[k, [names[f] for f in row]] = 1
    count = 1 + len(LABELS)
    # Counts of the neighbours' labels: by label and kind of edge.
    side = np.zeros((2, len(rows), count))
    for i, j, t in edges:
        side[t, i, y[j]] += 1
        side[t, j, y[i]] += 1
    goal = np.eye(count)[y]
    unary, chain, skip = np.zeros((len(names), count)), np.zeros((count, count)), 0.0
    # Gradient steps scaled by each weight's own past gradients.
    past = [np.full_like(unary, 1e-6), np.full_like(chain, 1e-6), 1e-6]
    for _ in range(steps):
        z = x @ unary + side[0] @ chain + skip * side[1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gap = goal - p
        both = side[0].T @ gap
        slopes = [x.T @ gap - DECAY * unary, both + both.T - DECAY * chain,
                  float((side[1] * gap).sum()) - DECAY * skip]
        past = [h + g * g for h, g in zip(past, slopes, strict=True)]
        unary, chain, skip = (w + 0.3 * g / h ** 0.5
                              for w, g, h in zip((unary, chain, skip), slopes, past, strict=True))
    return Field(names, unary, np.stack([chain, skip * np.eye(count)]))


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train()


def _possible(kind: int, text: str) -> bool:
    """Whether a run of words can be of that kind at all."""
    digits = digits_of(text)
    if kind == 0:
        return bool("@" in text or (_SPELT_AT.search(text) and _SPELT_DOT.search(text))) and " " not in text
    if kind == 1:
        return bool(_FOUR.fullmatch(text)) and all(map(_at_most_255, text.split(".")))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 4:
        return bool(_SECRET.search(text)) and bool(digits) and any(c.isalpha() for c in text)
    return 9 <= len(digits) <= 15 and not any(c.isalpha() for c in text)


def found_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and those that the field adds."""
    base = [base_spans(t) for t in texts]
    words = [active_words(t) for t in texts]
    rows: list[list[str]] = []
    edges: list[tuple[int, int, int]] = []
    for text, own in zip(texts, words, strict=True):
        if own:
            more, links = features(text, own)
            edges += [(i + len(rows), j + len(rows), t) for i, j, t in links]
            rows += more
    longest = max(map(len, words), default=0)
    marginals = (field.marginals(field.scores(rows), np.array(edges, int).reshape(-1, 3), longest)
                 if rows else np.zeros((0, 1)))
    best, sure = marginals.argmax(axis=1), marginals.max(axis=1, initial=0.0)
    out, at = [], 0
    for text, own, known in zip(texts, words, base, strict=True):
        added: list[Span] = []
        k = 0
        while k < len(own):
            kind, end = int(best[at + k]) - 1, k + 1
            while (end < len(own) and best[at + end] == best[at + k] and own[end][0] - own[end - 1][1] <= 2
                   and kind >= 2):
                end += 1
            if kind >= 0 and (sure[at + k:at + end] >= SURE).all():
                span = (own[k][0], kind, own[end - 1][1])
                if _possible(kind, text[span[0]:span[2]]) and not any(
                        span[0] < b and a < span[2] for a, _, b in known):
                    added.append(span)
            k = end
        at += len(own)
        out.append((known, added))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{LABELS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _finding(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                found = found_spans([t or "" for t in part.column("text").to_pylist()], field)
                counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([_joined(base + more) for base, more in found], pa.string()),
                     pa.array([len(more) for _, more in found], pa.int64()),
                     pa.array([len(base) + len(more) for base, more in found], pa.int64())],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_spans"])
    return run


def find(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of ``documents``: doc_id, base counts, base_sha256, spans, n_added, n_spans."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        _finding(field or default_field()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, n_added long, n_spans long")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans as one mark, ``[kind]`` of its first."""
    out, done, held = [], 0, 0
    for start, kind, end in sorted(spans):
        if start >= held:
            out += [text[done:start], f"[{LABELS[kind]}]"]
        held = done = max(held, end)
    return "".join([*out, text[done:]])


def _redacting(field: Field, text_at: int, size_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                texts = part.column(text_at).to_pylist()
                found = found_spans([t or "" for t in texts], field)
                new = [None if t is None else redacted(t, base + more)
                       for t, (base, more) in zip(texts, found, strict=True)]
                columns = list(part.columns)
                columns[text_at] = pa.array(new, part.schema.field(text_at).type)
                if size_at is not None:
                    sizes = [n if t is None else len(t)
                             for t, n in zip(new, part.column(size_at).to_pylist(), strict=True)]
                    columns[size_at] = pa.array(sizes, part.schema.field(size_at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
    return run


def redact(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """``documents`` with its columns, spans in text replaced, n_chars (where there is one) counted anew."""
    names = documents.columns
    size_at = names.index("n_chars") if "n_chars" in names else None
    # Columns go by their places: mapInArrow cannot name a column with a backtick.
    placed = documents.toDF(*[f"c{i}" for i in range(len(names))])
    return placed.mapInArrow(_redacting(field or default_field(), names.index("text"), size_at), placed.schema).toDF(*names)
