"""SentencePiece (BPE) encoding by suffix-array matching, and decoding.

The model is read, never trained.  Spaces become U+2581 and a leading one is added.  No
piece has U+2581 after another character, so a text falls apart into units (a word with
the spaces before it, a run of spaces, a run of characters that no merge touches); the
tokens of a text are those of its units, and equal units are encoded once.

New units of a stretch of text are concatenated (a separator that no piece has between
them) and indexed by a suffix array, sorted as deep as the longest piece.  Every piece is
binary-searched for the range of suffixes that start with it; a range is the piece's
occurrences.  These edges, sorted by position, are relaxed in the order of merging: an
edge is taken when both its ends are symbol boundaries and exactly one boundary lies
inside, which joins two symbols.  Overlapping edges of a piece are taken from the left.
A piece that merging in score order can't build from its own characters would break this
order, so ``load`` tries every piece and refuses a model that has one.  What is left over
and has no piece becomes byte pieces.

Decoding joins the pieces, turns U+2581 to spaces and drops the leading one; it restores
every text except that a U+2581 in it comes back as a space, as the format demands.

Defined results: null and empty texts have no tokens and decode to an empty text; a text
is held whole by a task; the units known in a task are at most ``MOST_UNITS`` at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MOST_UNITS = 400_000
UNIT_CHARS = 1_000_000
TEXT_CHARS = 4_000_000


@dataclass
class Vocabulary:
    """Pieces of a BPE model with byte fallback; see ``load``."""

    pieces: list[str]
    #: ids of the pieces that merging makes, best score first; pieces of one score together
    merges: list[list[int]]
    chars: dict[str, int]
    #: id of the piece for each byte
    bytes_: list[int]
    #: the bytes that each id decodes to
    decoded: list[bytes]


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; an error if it isn't BPE with byte fallback and no normalization."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    kind, norm = pb.ModelProto.SentencePiece, model.normalizer_spec
    if (model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces):
        raise ValueError("only BPE models with byte fallback, a leading space and no other normalization")
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    pieces = [p.piece for p in model.pieces]
    normal = [i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
    if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
        raise ValueError("a piece has a space after another character")
    by_score: dict[float, list[int]] = {}
    for i in normal:
        if len(pieces[i]) > 1:
            by_score.setdefault(model.pieces[i].score, []).append(i)
    values = {i: int(pieces[i][3:5], 16) for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
    decoded = [b""] * len(pieces)
    for i in normal:
        decoded[i] = pieces[i].replace(SPACE, " ").encode()
    for i, b in values.items():
        decoded[i] = bytes([b])
    vocabulary = Vocabulary(pieces, [by_score[s] for s in sorted(by_score, reverse=True)],
                            {pieces[i]: i for i in normal if len(pieces[i]) == 1}, sorted(values, key=values.get), decoded)
    made = [i for same in vocabulary.merges for i in same]
    flat, off = Matcher(vocabulary).tokens([pieces[i] for i in made])
    whole = (np.diff(off) == 1) & (flat[off[:-1]] == made)
    if not whole.all():
        raise ValueError(f"{(~whole).sum()} pieces can't be merged in score order, e.g. {pieces[made[int(np.argmin(whole))]]!r}")
    return vocabulary


def code_points(text: str) -> np.ndarray:
    """Code points plus one, so that 0 is free to separate units."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1


class Matcher:
    """Encodes lists of units; holds the vocabulary as arrays."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.made = [i for same in v.merges for i in same]
        self.length = np.array([len(v.pieces[i]) for i in self.made])
        self.depth = int(self.length.max())
        self.codes = np.zeros((len(self.made), self.depth), np.int64)
        for row, i in enumerate(self.made):
            self.codes[row, :self.length[row]] = code_points(v.pieces[i])
        self.single = np.full(0x110001, -1, np.int64)
        for c, i in v.chars.items():
            self.single[ord(c) + 1] = i

    def unit_pattern(self) -> re.Pattern:
        """A word with spaces before it, spaces, or characters that no merge touches."""
        inside = "".join(re.escape(chr(c - 1)) for c in np.unique(self.codes) if c and chr(c - 1) != SPACE)
        return re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{SPACE}{inside}]+")

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix array, first, end): the places of each merged piece's occurrences in it.

        Characters become dense codes, as many as fit are packed into one key for each
        position, and ranks by key are doubled until suffixes are sorted to the depth.
        """
        seen = np.unique(np.r_[0, text])
        bits = int(len(seen)).bit_length()
        per = min(self.depth, 63 // bits)
        coded = np.r_[np.searchsorted(seen, text), np.zeros(per, np.int64)]
        key = np.zeros(len(text), np.int64)
        for j in range(per):
            key = (key << bits) | coded[j:j + len(text)]
        order, at, deep = np.argsort(key, kind="stable"), key, per
        while deep < self.depth:
            ranked = at[order]
            rank = np.empty(len(at), np.int64)
            rank[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
            at = rank * (len(at) + 1)
            at[:max(0, len(at) - deep)] += rank[deep:] + 1
            order, deep = np.argsort(at, kind="stable"), deep * 2
        place = np.minimum(np.searchsorted(seen, self.codes), len(seen) - 1)
        known = (seen[place] == self.codes).all(1)
        lo, hi = np.zeros(len(self.made), np.int64), np.where(known, len(order), 0)
        for level in range(0, self.depth, per):
            live = np.flatnonzero((lo < hi) & (self.length > level))
            part = place[live, level:level + per]
            width = part.shape[1]
            low = np.zeros(len(live), np.int64)
            for j in range(width):
                low = (low << bits) | part[:, j]
            low <<= bits * (per - width)
            free = (np.maximum(0, level + per - self.length[live])) * bits
            high = low | ((np.int64(1) << free) - 1)
            a, b = lo[live], hi[live]
            lo[live], hi[live] = _bisect(order, key, level, a, b, low, False), _bisect(order, key, level, a, b, high, True)
        return order, lo, hi

    def tokens(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all units, offsets of the units in them)."""
        lengths = np.array([len(u) for u in units], np.int64)
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        joined = code_points("".join(units))
        text[np.arange(len(joined)) + np.repeat(np.arange(len(units)), lengths)] = joined
        order, lo, hi = self.occurrences(text)
        end = np.arange(1, len(text) + 2)
        end[-1] = 0
        head, symbol = text > 0, self.single[text]
        row = 0
        for same in self.v.merges:
            rows = range(row, row + len(same))
            row += len(same)
            if len(same) == 1:
                k = rows[0]
                if lo[k] < hi[k]:
                    self._relax(np.sort(order[lo[k]:hi[k]]), self.length[k], same[0], head, end, symbol)
            else:
                self._relax_ties([(order[lo[k]:hi[k]], self.length[k], self.made[k]) for k in rows if lo[k] < hi[k]], head, end, symbol)
        at = np.flatnonzero(head)
        ids = symbol[at]
        count = np.ones(len(at), np.int64)
        bare = np.flatnonzero(ids < 0)
        spelled = [chr(c - 1).encode("utf-8", "surrogatepass") for c in text[at[bare]]]
        count[bare] = [len(b) for b in spelled]
        flat = np.repeat(ids, count)
        flat[flat < 0] = [self.v.bytes_[x] for b in spelled for x in b]
        off = np.r_[0, np.cumsum(count)]
        return flat, off[np.searchsorted(at, np.r_[starts, len(text)])]

    @staticmethod
    def _relax(at, length, piece, head, end, symbol) -> None:
        """Take the edges of one piece, sorted by position, where they join two symbols."""
        at = at[head[at]]
        middle = end[at]
        ok = (middle < at + length) & (end[middle] == at + length)
        at, middle = at[ok], middle[ok]
        if len(at) > 1 and (follows := at[1:] == middle[:-1]).any():
            first = np.r_[True, ~follows]
            places = np.arange(len(at))
            taken = (places - np.maximum.accumulate(np.where(first, places, 0))) % 2 == 0
            at, middle = at[taken], middle[taken]
        end[at] = at + length
        head[middle] = False
        symbol[at] = piece

    @staticmethod
    def _relax_ties(edges, head, end, symbol) -> None:
        """The same for pieces of one score: the leftmost edge of all goes first, again and again."""
        if not edges:
            return
        at = np.concatenate([a for a, _, _ in edges])
        to = np.concatenate([a + n for a, n, _ in edges])
        piece = np.concatenate([np.full(len(a), p) for a, _, p in edges])
        by_place = np.argsort(at, kind="stable")
        at, to, piece = at[by_place], to[by_place], piece[by_place]
        while len(at):
            keep = head[at] & (end[at] < to)
            at, to, piece = at[keep], to[keep], piece[keep]
            now = np.flatnonzero(end[end[at]] == to)
            if not len(now):
                return
            left, middle = at[now], end[at[now]]
            now = now[np.r_[True, left[1:] != middle[:-1]]]
            left, middle = at[now], end[at[now]]
            end[left] = to[now]
            head[middle] = False
            symbol[left] = piece[now]


def _bisect(order, key, level, a, b, value, right) -> np.ndarray:
    """Places of ``value`` among the keys ``level`` characters into the suffixes of places a to b."""
    a, b = a.copy(), b.copy()
    while len(open_ := np.flatnonzero(a < b)):
        mid = (a[open_] + b[open_]) >> 1
        at = order[mid] + level
        got = np.where(at < len(key), key[np.minimum(at, len(key) - 1)], 0)
        below = got <= value[open_] if right else got < value[open_]
        a[open_] = np.where(below, mid + 1, a[open_])
        b[open_] = np.where(below, b[open_], mid)
    return a


def gathered(flat: np.ndarray, off: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The slices ``rows`` of a ragged array, one after the other."""
    n = off[rows + 1] - off[rows]
    return flat[np.repeat(off[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class Encoder:
    """Encodes texts; remembers the tokens of units, a bounded number of them."""

    def __init__(self, v: Vocabulary):
        self.matcher = Matcher(v)
        self.units = self.matcher.unit_pattern()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Token ids of each text, in order."""
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= TEXT_CHARS):
                size += len(texts[hi] or "")
                hi += 1
            if len(self.known) > MOST_UNITS:
                self._forget()
            known, before = self.known, len(self.known)
            rows = [np.array([known.setdefault(u, len(known)) for u in self.units.findall(SPACE + t.replace(" ", SPACE))] if t else [], np.int64) for t in texts[lo:hi]]
            self._learn(list(known)[before:])
            for r in rows:
                yield gathered(self.flat, self.off, r)
            lo = hi

    def _learn(self, units: list[str]) -> None:
        lo = 0
        while lo < len(units):
            hi, size = lo, 0
            while hi < len(units) and (hi == lo or size + len(units[hi]) <= UNIT_CHARS):
                size += len(units[hi])
                hi += 1
            flat, off = self.matcher.tokens(units[lo:hi])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.off = np.concatenate([self.off, self.off[-1] + off[1:]])
            lo = hi


class Decoder:
    """Bytes of token ids."""

    def __init__(self, v: Vocabulary):
        self.flat = np.frombuffer(b"".join(v.decoded), np.uint8)
        self.off = np.cumsum([0] + [len(b) for b in v.decoded])

    def decode(self, ids: np.ndarray) -> bytes:
        raw = gathered(self.flat, self.off, np.asarray(ids, np.int64)).tobytes()
        return raw[1:] if raw.startswith(b" ") else raw


def encode(docs: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``tokens``, the token ids of ``text``, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            ids = list(encoder.encode(batch.column(len(keep)).to_pylist()))
            off = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), tokens], names=[*keep, "tokens"])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(work, f"{schema}, tokens array<int>")


def decode(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows of (doc_id, tokens)."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "tokens").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Digests of every text encoded and decoded again, in one pass.

    (doc_id, n_tokens, ids_sha256 of the ids as little-endian 32-bit numbers, n_bytes and
    decoded_sha256 of the decoded text, same: whether it is the text).
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    schema = "doc_id long, n_tokens long, ids_sha256 string, n_bytes long, decoded_sha256 string, same boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(shared.value), Decoder(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for text, ids in zip(texts, encoder.encode(texts)):
                back = decoder.decode(ids)
                rows.append((len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), len(back), hashlib.sha256(back).hexdigest(), back == (text or "").encode()))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.record_batch([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(work, schema)
