"""SentencePiece-style encoding and decoding with seeded merge-dropout.

The vocabulary (pieces and scores) comes from a public model file whose path
is a parameter; nothing is trained. A space is written as the mark U+2581, one
mark is put before the text, and the characters of a chunk are merged through
an agenda: the candidate with the best score is taken first, leftmost on ties.
A candidate that is taken from the agenda is skipped when the keyed hash of
(seed, document, place of the chunk in the text, piece, place in the chunk) falls
below ``dropout``; a pair that forms again later is a new candidate. A document's key
is the hash of its id, or of its text where the id is null, so every occurrence of a
word in every document is split on its own, while every run gives the same
pieces. Characters outside the vocabulary become byte pieces.

Decoding joins the pieces' bytes and is lossless for every text: marks become
spaces, the first one is dropped, and a literal U+2581 in a text is always
written as byte pieces, so that it does not turn into a space.

No vocabulary piece has a mark after another character (checked at loading),
so merges never cross the beginning of a run of spaces and a text is encoded
chunk by chunk. A worker remembers, for each chunk, the candidates that come up when
none is skipped, and the pieces that result. For every occurrence the hashes of these candidates are
computed; if all are above the limit the remembered pieces are its pieces, otherwise the
occurrence is merged by its own key, together with all such occurrences of the
batch, one candidate of each per round. The memory is a cache of a fixed size; it changes no result. With
``dropout`` = 0 the pieces equal those of the sentencepiece library for texts
without U+2581.

Defined cases: a null text gives null ids, an empty one an empty list; repeated
rows give equal ids; a text of any length is one list; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces_of

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
DROPOUT, SEED = 0.1, 2024
MAX_PIECES = 1_000_000  # the vocabulary is shared with every task, so its size is checked
_SHORT, _NONE = 60, 1 << 30  # longest chunk that is merged with others (its places fit 6 bits); no candidate
_REMEMBERED = 500_000  # chunks per worker


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    rank: dict[str, int]  # place in the order of merging, by piece; best first
    byte_ids: tuple[int, ...]  # of <0x00> to <0xFF>
    raw: tuple[bytes, ...]  # what a piece decodes to
    cut_lines: bool  # no longer piece holds a line feed


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    if n > MAX_PIECES:
        raise ValueError(f"{n} pieces; at most {MAX_PIECES} are shared with the tasks")
    ids, byte_ids, raw = {}, [0] * 256, []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            raw.append(b"")
        else:
            ids[piece] = i
            raw.append(piece.replace(MARK, " ").encode())
    if any(MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("the vocabulary has a piece with a mark inside")
    if len(set(byte_ids)) != 256:
        raise ValueError("the vocabulary has no byte pieces")
    order = sorted((p for p in ids if len(p) > 1), key=lambda p: (-model.get_score(ids[p]), ids[p]))
    return Vocabulary(ids, {p: r for r, p in enumerate(order)}, tuple(byte_ids), tuple(raw), not any("\n" in p and len(p) > 1 for p in ids))


def _skipped(key: int, rank: int, at: int, limit: int) -> bool:
    """Whether the keyed hash of a candidate (its piece's rank and its first character's place) is below ``limit``."""
    h = (key ^ (rank * 0x9E3779B1) ^ (at * 0x85EBCA77)) & 0xFFFFFFFF
    h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
    h = ((h ^ (h >> 12)) * 0x297A2D39) & 0xFFFFFFFF
    return h ^ (h >> 15) < limit


def _skipped_many(key: np.ndarray, rank: np.ndarray, at: np.ndarray, limit: int) -> np.ndarray:
    low = np.uint64(0xFFFFFFFF)
    h = key ^ ((rank.astype(np.uint64) * np.uint64(0x9E3779B1)) & low) ^ ((at.astype(np.uint64) * np.uint64(0x85EBCA77)) & low)
    h = ((h ^ (h >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & low
    h = ((h ^ (h >> np.uint64(12))) * np.uint64(0x297A2D39)) & low
    return h ^ (h >> np.uint64(15)) < np.uint64(limit)


def merge(chunk: str, rank: dict[str, int], limit: int, key: int) -> list[str]:
    """Pieces of one chunk by an agenda of any length; a candidate is skipped when its keyed hash is below ``limit``."""
    n = len(chunk)
    sym = list(chunk)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = []
    for i in range(n - 1):
        r = rank.get(sym[i] + sym[i + 1])
        if r is not None:
            agenda.append((r, i, i + 1, 2))
    heapq.heapify(agenda)
    while agenda:
        r, i, j, size = heapq.heappop(agenda)
        a, b = sym[i], sym[j]
        if not a or not b or after[i] != j or len(a) + len(b) != size:
            continue  # an end of the pair has been merged since
        if limit and _skipped(key, r, i, limit):
            continue
        a += b
        sym[i], sym[j] = a, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = rank.get(a + sym[k])
            if r is not None:
                heapq.heappush(agenda, (r, i, k, size + len(sym[k])))
        k = before[i]
        if k >= 0:
            r = rank.get(sym[k] + a)
            if r is not None:
                heapq.heappush(agenda, (r, k, i, size + len(sym[k])))
    return [s for s in sym if s]


class _Pairs:
    """Hash table of the symbol pairs that make a piece, for merging many chunks at once."""

    def __init__(self, v: Vocabulary):
        names = dict(v.ids)
        for p in v.rank:
            for c in p:
                names.setdefault(c, len(v.raw) + len(names))  # characters that occur inside pieces only
        self.width = max(names.values()) + 2
        found = {names[p[:k]] * self.width + names[p[k:]]: r for p, r in v.rank.items()
                 for k in range(1, len(p)) if p[:k] in names and p[k:] in names}
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], np.int64)
        self.made = np.array([v.ids[p] for p in v.rank], np.int64)  # by rank
        self.known = len(v.raw)
        self.symbol = np.full(0x110000, self.width - 1, np.int32)  # by code point; the last one is no symbol
        for c, i in names.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        self.symbol[ord(" ")] = self.symbol[ord(MARK)]  # a space is written as the mark; a mark of the text is a chunk of its own
        self.bits = max(8, 4 + len(self.keys).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)  # open addressing, mostly empty
        left, slot = np.arange(len(self.keys)), self._slot(self.keys)
        while len(left):
            first = np.unique(slot, return_index=True)[1]
            first = first[self.slots[slot[first]] < 0]
            self.slots[slot[first]] = left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left * self.width + right
        slot = self._slot(pair)
        at = self.slots[slot]
        hit = (at >= 0) & (self.keys[at] == pair)
        out = np.where(hit, self.ranks[at], _NONE)
        left = np.flatnonzero((at >= 0) & ~hit)
        while len(left):  # the slot holds another pair: look at the next one
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            at = self.slots[slot[left]]
            hit = (at >= 0) & (self.keys[at] == pair[left])
            out[left[hit]] = self.ranks[at[hit]]
            left = left[(at >= 0) & ~hit]
        return out


def merge_many(chunks: list[str], pairs: _Pairs, limit: int = 0, keys: np.ndarray | None = None):
    """(symbols, ends) of many short chunks: each round takes the best candidate of every chunk from its agenda.

    With ``keys`` a candidate is skipped when its keyed hash is below ``limit``: the same pieces as ``merge`` gives
    chunk by chunk. Without, none is skipped, and the (ranks, places, ends) of all candidates that came up are
    returned too. Symbols that are not vocabulary ids stand for unknown characters.
    """
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    sym = pairs.symbol[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    own = np.repeat(np.arange(len(chunks)), lengths)
    place = np.arange(len(sym)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    agenda = np.full(len(sym), _NONE, np.int64)  # of the pair that begins at a symbol
    agenda[:-1] = np.where(own[1:] == own[:-1], pairs.rank(sym[:-1], sym[1:]), _NONE)
    done_sym, done_own = [], []
    tested: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(sym):
        start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        size = np.diff(np.append(start, len(own)))
        order = agenda * 64 + place  # leftmost on ties
        best = np.minimum.reduceat(order, start)
        over = best >= _NONE * 64
        if over.any():  # no candidate is left
            rest = np.repeat(over, size)
            done_sym.append(sym[rest])
            done_own.append(own[rest])
            live = ~rest
            sym, own, place, agenda, order = sym[live], own[live], place[live], agenda[live], order[live]
            best, size = best[~over], size[~over]
            if not len(sym):
                break
        at = np.flatnonzero(order == np.repeat(best, size))
        if keys is None:
            tested.append((own[at], agenda[at], place[at]))
        else:
            skip = _skipped_many(keys[own[at]], agenda[at], place[at], limit)
            agenda[at[skip]] = _NONE
            at = at[~skip]
            if not len(at):
                continue
        sym[at] = pairs.made[agenda[at]]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        at = at - np.arange(len(at))  # one symbol fewer for every merge before
        sym, own, place, agenda = sym[stay], own[stay], place[stay], agenda[stay]
        for i in (at, at[at > 0] - 1):
            whole = i + 1 < len(sym)
            j = i[whole]
            agenda[i] = _NONE
            inside = own[j] == own[j + 1]
            agenda[j[inside]] = pairs.rank(sym[j[inside]], sym[j[inside] + 1])
    none = np.zeros(0, np.int64)
    sym, own = (np.concatenate(done_sym), np.concatenate(done_own)) if done_sym else (none, none)
    out = sym[np.argsort(own, kind="stable")], np.cumsum(np.bincount(own, minlength=len(chunks)))
    if keys is not None:
        return out
    own, ranks, places = (np.concatenate([t[c] for t in tested]) if tested else none for c in range(3))
    by = np.argsort(own, kind="stable")
    return *out, ranks[by], places[by], np.cumsum(np.bincount(own, minlength=len(chunks)))


class _Flat:
    """Numbers of many owners end to end; grows by whole batches."""

    def __init__(self, *kinds):
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.columns = [np.zeros(0, k) for k in kinds]

    def add(self, counts: np.ndarray, *columns: np.ndarray) -> None:
        self.begin = np.concatenate((self.begin, len(self.columns[0]) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.columns = [np.concatenate((a, b.astype(a.dtype))) for a, b in zip(self.columns, columns)]

    def places(self, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of all numbers of these owners, one after another; their counts added up)."""
        count = self.count[owners]
        ends = np.cumsum(count)
        return np.repeat(self.begin[owners] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0), ends


class _Known:
    """What chunks become if nothing is skipped: the candidates that come up and the ids."""

    def __init__(self):
        self.node: dict[str, int] = {}
        self.odd = np.zeros(0, bool)  # chunks that have to be merged alone
        self.ids, self.tests = _Flat(np.int32), _Flat(np.int32, np.int8)

    def add(self, chunks: list[str], odd: np.ndarray, n_ids: np.ndarray, ids: np.ndarray, n_tests: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> None:
        self.node.update(zip(chunks, range(len(self.odd), len(self.odd) + len(chunks))))
        self.odd = np.concatenate((self.odd, odd))
        self.ids.add(n_ids, ids)
        self.tests.add(n_tests, ranks, places)


def _mixed(h: np.ndarray) -> np.ndarray:
    low = np.uint64(0xFFFFFFFF)
    h = ((h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & low
    h = ((h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & low
    return h ^ (h >> np.uint64(16))


def _keys(documents: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Keys of chunks by document key and place in the text, from 1."""
    return _mixed(documents ^ ((place.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)))


def _spread(begin: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places [begin, begin + count) of the owners ``at``, one after another."""
    n = count[at]
    ends = np.cumsum(n)
    return np.repeat(begin[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        if not 0 <= dropout <= 1:
            raise ValueError("dropout must be in [0, 1]")
        self.vocabulary, self.seed = vocabulary, seed
        self.limit = min(int(dropout * 2 ** 32), 2 ** 32)
        self.pairs = _Pairs(vocabulary)
        self.known = _Known()
        self.cut = re.compile(f" *[^ {MARK}\n]+|{MARK}|\n| +" if vocabulary.cut_lines else f" *[^ {MARK}]+|{MARK}| +").findall

    def key(self, name: str) -> int:
        """A document's key from its id."""
        return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass"), self.seed & 0xFFFFFFFF)

    def keys(self, document: int, n: int) -> np.ndarray:
        """Keys of the n chunks of a document."""
        return _keys(np.full(n, document, np.uint64), np.arange(1, n + 1))

    def alone(self, chunk: str, key: int) -> list[int]:
        """Ids of one chunk of any kind."""
        v = self.vocabulary
        if chunk == MARK:
            return [v.byte_ids[b] for b in MARK.encode()]
        ids: list[int] = []
        for p in merge(chunk.replace(" ", MARK), v.rank, self.limit, key):
            known = v.ids.get(p)
            if known is None:
                ids += [v.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                ids.append(known)
        return ids

    def _learn(self, chunks: list[str]) -> None:
        """Remember new chunks."""
        none = np.zeros(0, np.int64)
        long = [c for c in chunks if len(c) > _SHORT or c == MARK]
        if long:
            zeros = np.zeros(len(long), np.int64)
            self.known.add(long, np.ones(len(long), bool), zeros, none, zeros, none, none)
            chunks = [c for c in chunks if len(c) <= _SHORT and c != MARK]
        if not chunks:
            return
        sym, ends, ranks, places, stops = merge_many(chunks, self.pairs)
        unknown = np.concatenate(([0], np.cumsum(sym >= self.pairs.known)))[np.concatenate(([0], ends))]
        odd = np.diff(unknown) > 0  # a symbol without an id
        n_ids, n_tests = np.diff(ends, prepend=0), np.diff(stops, prepend=0)
        self.known.add(chunks, odd, np.where(odd, 0, n_ids), sym[~np.repeat(odd, n_ids)],
                       np.where(odd, 0, n_tests), ranks[~np.repeat(odd, n_tests)], places[~np.repeat(odd, n_tests)])

    def _skipping(self, nodes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Occurrences with a candidate whose hash is below the limit."""
        at, ends = self.known.tests.places(nodes)
        ranks, places = (c[at] for c in self.known.tests.columns)
        hit = np.flatnonzero(_skipped_many(np.repeat(keys, self.known.tests.count[nodes]), ranks, places, self.limit))
        return np.unique(np.searchsorted(ends, hit, side="right"))

    def encode_many(self, texts: list[str], documents: list[int]) -> list[np.ndarray]:
        """Ids of whole texts; ``documents`` are the documents' keys."""
        cuts = [self.cut(" " + t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        chunks = [c for cut in cuts for c in cut]
        if not chunks:
            return [np.zeros(0, np.int32) for _ in texts]
        if len(self.known.odd) > _REMEMBERED:  # a cache: what is needed is learned again
            self.known = _Known()
        known = self.known
        new = set(chunks).difference(known.node)
        if new:
            self._learn(list(new))
        nodes = np.fromiter(map(known.node.__getitem__, chunks), np.int64, len(chunks))
        place = np.arange(1, len(chunks) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = _keys(np.repeat(np.array(documents, np.uint64), sizes), place)
        # the ids of every occurrence: as remembered, merged by its own key, or merged alone
        count, parts = known.ids.count[nodes], []
        which = self._skipping(nodes, keys) if self.limit else np.zeros(0, np.int64)
        odd = np.flatnonzero(known.odd[nodes])
        own: list[tuple[np.ndarray, np.ndarray]] = []  # (occurrences, their ids end to end)
        if len(which):
            sym, ends = merge_many([chunks[i] for i in which.tolist()], self.pairs, self.limit, keys[which])
            count[which] = np.diff(ends, prepend=0)
            own.append((which, sym))
        if len(odd):
            parts = [self.alone(chunks[i], int(keys[i])) for i in odd.tolist()]
            count[odd] = [len(x) for x in parts]
            own.append((odd, np.fromiter((i for x in parts for i in x), np.int64)))
        ends = np.cumsum(count)
        out = np.empty(ends[-1], np.int32)
        plain = np.ones(len(chunks), bool)
        for at, ids in own:
            plain[at] = False
            out[_spread(ends - count, count, at)] = ids
        kept = np.flatnonzero(plain)
        out[_spread(ends - count, count, kept)] = known.ids.columns[0][known.ids.places(nodes[kept])[0]]
        return np.split(out, np.concatenate(([0], ends))[np.cumsum(sizes)[:-1]])

    def encode(self, text: str, document: int = 0) -> np.ndarray:
        return self.encode_many([text], [document])[0]


def decode(ids, vocabulary: Vocabulary) -> str:
    raw = vocabulary.raw
    return b"".join([raw[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


SCHEMA = "variant long, ids array<int>, lossless boolean"


def encode_texts(docs: DataFrame, keep: list[str], path: str = MODEL_PATH, dropout: float = DROPOUT, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``keep`` columns plus variant (the document's key), ids and lossless (the ids were decoded again and gave the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder = Encoder(vocabulary, dropout, seed)
        for whole in batches:
            texts, keys = whole.column(0).to_pylist(), whole.column(1).to_pylist()
            for a, b in pieces_of([len(t or "") for t in texts], 2_000_000):
                part = texts[a:b]
                kinds = [encoder.key(k if k is not None else t or "") for t, k in zip(part, keys[a:b])]
                ids = encoder.encode_many([t or "" for t in part], kinds)
                same = [t is None or decode(x.tolist(), vocabulary) == t for t, x in zip(part, ids)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()),
                                                 mask=pa.array([t is None for t in texts[a:b]], pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [*whole.slice(a, b - a).columns[2:], pa.array(kinds, pa.int64()), lists, pa.array(same, pa.bool_())],
                    [*keep, "variant", "ids", "lossless"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col).cast("string").alias("__key"), *keep)
    return rows.mapInArrow(run, f"{fields}, {SCHEMA}")


def decode_ids(rows: DataFrame, keep: list[str], path: str = MODEL_PATH, ids_col: str = "ids") -> DataFrame:
    """The ``keep`` columns plus text, decoded from ``ids_col`` (null ids: null)."""
    shared = rows.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            texts = [None if x is None else decode(x, vocabulary) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*keep, "text"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(F.col(ids_col).alias("__ids"), *keep).mapInArrow(run, f"{fields}, text string")
