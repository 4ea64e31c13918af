"""SentencePiece encoding and decoding with N-best segmentation.

Every way to cut a text into pieces of the model is a path through the piece lattice, and
a path's score is the sum of its pieces' scores. The forward Viterbi pass gives the best
score from the start to every position. Backward A-star search starts at the end and uses
those scores as its estimate of what is left; as they are exact, it pops whole paths in
order of their score.

No piece crosses from a word into the blank before the next word, so the lattice of a
text is a chain of the lattices of its units (blanks and the word after them, or a line
feed). Units longer than LONG are cut again wherever no piece of the model crosses, which is
the same lattice in more links. Viterbi runs once for each distinct unit, for all units of one
length at a time, or, for a unit that is still long, along the unit over the edges it has.
Each unit's gap, the loss if its best path may not be taken, comes from the forward and
the backward pass. The N best paths of a text leave the best path only in the N-1 units
with the smallest gaps, so A-star searches these units, and then the chain of their paths. Entries of
an agenda stand for different paths, each as good as its rank says, so an agenda never holds
more entries than paths are still wanted.

Code points without a piece become their UTF-8 bytes, at the lowest score of the model's
single code points less ten. Blanks become U+2581, with one before the text; a U+2581 in
the text itself becomes bytes, so decoding gives every text back exactly. Best paths are
by score, which for a BPE model need not be the path its merges lead to.

Defined cases: a null or empty text has no pieces, score 0 and one path, and decodes to
the empty text. Of paths with equal scores, which comes first is fixed for a text.
Repeated rows are encoded each. Very long texts are encoded whole, in time and memory that
grow with their length, with or without blanks. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import insort
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, arrow_map, numbered

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Paths that are returned, the best one included.
N_BEST = 4
#: Distinct units a worker remembers, and units that go through Viterbi at a time.
HELD_UNITS, TOGETHER = 400_000, 20_000
#: Code points above which a unit goes through Viterbi alone, and those whose edges are looked up at a time.
LONG, WINDOW = 64, 1 << 16
#: Bytes of text that are encoded, and documents that are decoded, at a time.
ENCODED, DECODED = 2 << 20, 500
BLANK, UNIT = "▁", re.compile(r" *[^ \n]+| +|\n")
#: Id of an edge of code points without a piece.
BYTES = -1
PRIME = np.uint64(0x100000001B3)


class Lexicon(NamedTuple):
    """Pieces of a model, by their text and, in arrays, sorted by the hash of their code points."""

    pieces: dict[str, tuple[int, float]]
    hashes: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    unknown: float
    byte_ids: list[int]
    #: UTF-8 of every id, one after the other, and where each begins.
    spelled: np.ndarray
    begins: np.ndarray


def hash_step(value: np.ndarray, points: np.ndarray) -> np.ndarray:
    mixed = (value ^ (points.astype(np.uint64) + np.uint64(1))) * PRIME  # one more, so that no code point is without effect
    return mixed ^ (mixed >> np.uint64(29))


def hash_of(piece: str) -> np.uint64:
    value = np.zeros(1, np.uint64)
    for letter in piece:
        value = hash_step(value, np.array([ord(letter)]))
    return value[0]


def load(path: str) -> Lexicon:
    """The pieces of a model file. Pieces must not hold a blank or line feed after other letters."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    usual = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = {i: model.id_to_piece(i) for i in usual}
    if any(BLANK in p.lstrip(BLANK) or ("\n" in p and len(p) > 1) for p in pieces.values()):
        raise ValueError(f"{path}: pieces run across words, which this lattice does not allow")
    hashes = np.array([hash_of(p) for p in pieces.values()], np.uint64)
    order = np.argsort(hashes)
    if (np.diff(hashes[order]) == 0).any():
        raise ValueError(f"{path}: two pieces have one hash")
    ids = np.array(usual, np.int32)[order]
    scores = np.array([model.get_score(int(i)) for i in ids], np.float64)
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError(f"{path}: the model has no pieces for bytes")
    text = [b""] * size
    for i, piece in pieces.items():
        text[i] = piece.replace(BLANK, " ").encode()
    for b, i in enumerate(byte_ids):
        text[i] = bytes([b])
    single = min(model.get_score(i) for i, p in pieces.items() if len(p) == 1)
    begins = np.concatenate([[0], np.cumsum([len(t) for t in text])])
    spelled = np.frombuffer(b"".join(text), np.uint8)
    by_text = {piece: (i, model.get_score(i)) for i, piece in pieces.items()}
    return Lexicon(by_text, hashes[order], ids, scores, max(map(len, pieces.values())), single - 10, byte_ids, spelled, begins)


def nbest(edges: list[list[tuple[int, float, object]]], n: int) -> list[tuple[float, list]]:
    """The n best paths, as (score, labels), of a lattice with nodes 0, 1, ...

    ``edges[end]`` has (start, score, label) of the edges into ``end``, start before end."""
    best = [0.0]
    for into in edges[1:]:
        best.append(max((best[start] + score for start, score, _ in into), default=-np.inf))
    turn, last = count(), len(edges) - 1
    agenda: list = [(-best[last], next(turn), last, 0.0, None)]
    found: list[tuple[float, list]] = []
    while agenda and len(found) < n:
        rank, _, node, behind, path = agenda.pop(0)
        if node == 0:
            labels = []
            while path is not None:
                labels.append(path[0])
                path = path[1]
            found.append((-rank, labels))
            continue
        for start, score, label in edges[node]:
            if best[start] > -np.inf:
                total = behind + score
                rank = -(best[start] + total)
                if len(agenda) < n - len(found) or rank < agenda[-1][0]:
                    insort(agenda, (rank, next(turn), start, total, (label, path)))
                    del agenda[n - len(found) :]
    return found


def lookup(lexicon: Lexicon, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, score) of the pieces with these hashes; score -inf where there is none."""
    at = np.minimum(np.searchsorted(lexicon.hashes, hashes), len(lexicon.hashes) - 1)
    known = lexicon.hashes[at] == hashes
    return np.where(known, lexicon.ids[at], BYTES), np.where(known, lexicon.scores[at], -np.inf)


def unit_points(units: list[str]) -> np.ndarray:
    """Code points of units of one length; blanks as U+2581, and U+2581 as no piece has it."""
    points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(len(units), -1).copy()
    points[points == ord(BLANK)] = 0xFFFFFFFF
    points[points == 32] = ord(BLANK)
    return points


def unit_edges(lexicon: Lexicon, points: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(id, score) by (start, end) for units of one length."""
    length, edges = points.shape[1], {}
    for start in range(length):
        value = np.zeros(len(points), np.uint64)
        for end in range(start + 1, min(length, start + lexicon.longest) + 1):
            value = hash_step(value, points[:, end - 1])
            ids, scores = lookup(lexicon, value)
            if end == start + 1:
                scores = np.where(ids == BYTES, lexicon.unknown, scores)
            edges[start, end] = ids, scores
    return edges


def best_paths(lexicon: Lexicon, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best score, gap and number of ids of the best path of each of the units, which have
    one length, and the ids one path after the other."""
    points = unit_points(units)
    n, length = points.shape
    edges = unit_edges(lexicon, points)
    ahead, back = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
    step = np.zeros((length + 1, n), np.int32)
    ahead[0] = back[length] = 0
    for end in range(1, length + 1):
        for start in range(max(0, end - lexicon.longest), end):  # the longest piece first
            total = ahead[start] + edges[start, end][1]
            better = total > ahead[end]
            ahead[end][better] = total[better]
            step[end][better] = end - start
    for start in range(length - 1, -1, -1):
        for end in range(start + 1, min(length, start + lexicon.longest) + 1):
            np.maximum(back[start], edges[start, end][1] + back[end], out=back[start])
    on_path = np.zeros((length + 1, n), bool)
    on_path[length] = True
    chosen = np.full((length, n), -2, np.int32)  # the id of the piece that begins at a position
    second = np.full(n, -np.inf)
    for end in range(length, 0, -1):
        for start in range(max(0, end - lexicon.longest), end):
            ids, scores = edges[start, end]
            taken = on_path[end] & (step[end] == end - start)
            on_path[start][taken] = True
            chosen[start][taken] = ids[taken]
            np.maximum(second, np.where(taken, -np.inf, ahead[start] + scores + back[end]), out=second)
    rows = chosen.T
    begun = rows > -2
    flat, sizes = rows[begun], begun.sum(axis=1)
    if (flat == BYTES).any():
        spelled = [_spell(lexicon, rows[i, at], units[i][at]) for i, at in zip(*np.nonzero(begun), strict=True)]
        sizes = np.add.reduceat([len(ids) for ids in spelled], np.cumsum(sizes) - sizes)
        flat = np.array([i for ids in spelled for i in ids], np.int32)
    return ahead[length], ahead[length] - second, sizes, flat


def edges_along(lexicon: Lexicon, unit: str) -> tuple[np.ndarray, ...]:
    """(start, end, id, score) of the edges of one unit, by end and then start."""
    points = unit_points([unit])[0]
    found = []
    for at in range(0, len(points), WINDOW):
        value = np.zeros(min(WINDOW, len(points) - at), np.uint64)
        for size in range(1, min(lexicon.longest, len(points) - at) + 1):
            value = value[: len(points) - at - size + 1]
            value = hash_step(value, points[at + size - 1 : at + size - 1 + len(value)])
            ids, scores = lookup(lexicon, value)
            if size == 1:
                scores = np.where(ids == BYTES, lexicon.unknown, scores)
            hit = np.flatnonzero(scores > -np.inf)
            found.append((at + hit, at + hit + size, ids[hit], scores[hit]))
    start, end, ids, scores = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.lexsort((start, end))
    return start[order], end[order], ids[order], scores[order]


def links(lexicon: Lexicon, unit: str) -> list[str]:
    """A unit cut wherever no piece crosses."""
    start, end, _, _ = edges_along(lexicon, unit)
    size = len(unit) + 1
    crossed = np.cumsum(np.bincount(start + 1, minlength=size) - np.bincount(end, minlength=size))
    cuts = np.flatnonzero(crossed == 0)  # the last one is the end, and the start is none
    cuts = cuts[cuts > 0].tolist()
    return [unit[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def best_path_along(lexicon: Lexicon, unit: str) -> tuple[float, float, list[int]]:
    """Best score, gap and ids of the best path of one unit."""
    start, end, ids, scores = edges_along(lexicon, unit)
    ahead, back = [-np.inf] * (len(unit) + 1), [-np.inf] * (len(unit) + 1)
    into = [0] * (len(unit) + 1)
    ahead[0] = back[-1] = 0.0
    for at in range(0, len(start), WINDOW):
        part = slice(at, at + WINDOW)
        for n, (a, b, score) in enumerate(zip(start[part].tolist(), end[part].tolist(), scores[part].tolist(), strict=True), at):
            if ahead[a] + score > ahead[b]:
                ahead[b], into[b] = ahead[a] + score, n
    backward = np.argsort(-start, kind="stable")
    for at in range(0, len(start), WINDOW):
        part = backward[at : at + WINDOW]
        for a, b, score in zip(start[part].tolist(), end[part].tolist(), scores[part].tolist(), strict=True):
            if score + back[b] > back[a]:
                back[a] = score + back[b]
    path, at = [], len(unit)
    while at:
        path.append(into[at])
        at = int(start[into[at]])
    path.reverse()
    through = np.array(ahead)[start] + scores + np.array(back)[end]
    through[path] = -np.inf
    spelled = [i for n in path for i in _spell(lexicon, ids[n], unit[start[n]])]
    return ahead[-1], ahead[-1] - float(through.max()), spelled


def _spell(lexicon: Lexicon, piece: int, letter: str) -> list[int]:
    return [int(piece)] if piece != BYTES else [lexicon.byte_ids[b] for b in letter.encode()]


def unit_nbest(lexicon: Lexicon, unit: str, n: int) -> list[tuple[float, list[int]]]:
    """The n best paths of one unit, as (score, ids)."""
    if len(unit) > LONG:
        edges: list = [[] for _ in range(len(unit) + 1)]
        for start, end, piece, score in zip(*(column.tolist() for column in edges_along(lexicon, unit)), strict=True):
            edges[end].append((start, score, _spell(lexicon, piece, unit[start])))
        return [(score, [i for label in labels for i in label]) for score, labels in nbest(edges, n)]
    text = unit.replace(BLANK, "\uffff").replace(" ", BLANK)
    edges = [[] for _ in range(len(unit) + 1)]
    for start in range(len(text)):
        for end in range(start + 1, min(len(text), start + lexicon.longest) + 1):
            found = lexicon.pieces.get(text[start:end])
            if found:
                edges[end].append((start, found[1], [found[0]]))
            elif end == start + 1:
                edges[end].append((start, lexicon.unknown, _spell(lexicon, BYTES, unit[start])))
    return [(score, [i for label in labels for i in label]) for score, labels in nbest(edges, n)]


class Encoder:
    """Encodes texts, remembering the paths of units. One for each Python worker."""

    def __init__(self, lexicon: Lexicon, n: int):
        self.lexicon, self.n = lexicon, n
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.others: dict[str, list[tuple[float, list[int]]]] = {}
        self.scores = self.gaps = np.zeros(0)
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, units: set[str]) -> None:
        """Find the best paths of units that are not remembered."""
        if len(self.index) + len(units - self.index.keys()) > HELD_UNITS:
            self.forget()
        new = sorted(units - self.index.keys(), key=len)
        parts = [(self.scores, self.gaps, self.sizes, self.ids)]
        at = 0
        while at < len(new):
            length = len(new[at])
            if length > LONG:
                score, gap, ids = best_path_along(self.lexicon, new[at])
                parts.append((np.array([score]), np.array([gap]), np.array([len(ids)]), np.array(ids, np.int32)))
                at += 1
                continue
            end = at
            while end < len(new) and len(new[end]) == length and (end - at) * length < TOGETHER * 8:
                end += 1
            parts.append(best_paths(self.lexicon, new[at:end]))
            at = end
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.scores, self.gaps, self.sizes, self.ids = (np.concatenate(part) for part in zip(*parts, strict=True))
        self.begins = np.cumsum(self.sizes) - self.sizes

    def units(self, value: str) -> list[str]:
        found = UNIT.findall(" " + value)
        if max(map(len, found)) <= LONG:
            return found
        return [part for unit in found for part in (links(self.lexicon, unit) if len(unit) > LONG else [unit])]

    def alternatives(self, unit: str) -> list[tuple[float, list[int]]]:
        """The loss and ids of the best paths of a unit besides its best."""
        if unit not in self.others:
            if len(self.others) > HELD_UNITS // 4:
                self.others.clear()
            at = self.index[unit]
            best = self.ids[self.begins[at] : self.begins[at] + self.sizes[at]].tolist()
            found = unit_nbest(self.lexicon, unit, self.n)
            self.others[unit] = [(score - float(self.scores[at]), ids) for score, ids in found if ids != best][: self.n - 1]
        return self.others[unit]

    def encode(self, values: list[str | None]) -> list[tuple[np.ndarray, float, list[dict]]]:
        """For each text: ids of the best path, its score, and the next best paths."""
        cut = [self.units(value) if value else [] for value in values]
        units = set()
        for found in cut:
            units.update(found)
        self.learn(units)
        out = []
        for found in cut:
            at = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            first = ends - sizes
            total = int(ends[-1]) if len(ends) else 0
            ids = self.ids[np.repeat(self.begins[at] - first, sizes) + np.arange(total)]
            score = float(self.scores[at].sum())
            out.append((ids, score, self._next(found, at, first, sizes, score)))
        return out

    def _next(self, units: list[str], at: np.ndarray, first: np.ndarray, sizes: np.ndarray, score: float) -> list[dict]:
        """The next best paths of a text, each as its score and its changes to the best path."""
        wanted = self.n - 1
        gaps = self.gaps[at]
        if wanted < len(gaps):
            limit = np.partition(gaps, wanted - 1)[wanted - 1]
            near = np.flatnonzero(gaps < limit)
            near = np.sort(np.concatenate([near, np.flatnonzero(gaps == limit)[: wanted - len(near)]]))
        else:
            near = np.arange(len(gaps))
        chain: list = [[]]
        for i in near.tolist():
            changes = [(loss, (int(first[i]), int(sizes[i]), ids)) for loss, ids in self.alternatives(units[i])]
            chain.append([(len(chain) - 1, 0.0, None), *((len(chain) - 1, loss, change) for loss, change in changes)])
        found = nbest(chain, self.n + 1)
        changed = [(loss, [c for c in labels if c]) for loss, labels in found]
        return [
            {"score": score + loss, "changes": [{"at": a, "length": length, "ids": ids} for a, length, ids in labels]}
            for loss, labels in changed
            if labels
        ][:wanted]


_ENCODERS: dict[tuple, Encoder] = {}

CHANGE = "array<struct<at: int, length: int, ids: array<int>>>"
SCHEMA = f"doc_id long, {ROW} long, ids array<int>, score double, others array<struct<score: double, changes: {CHANGE}>>"
OTHERS = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            ("changes", pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))]))),
        ]
    )
)


def encode(docs: DataFrame, model: str = MODEL, n: int = N_BEST) -> DataFrame:
    """A row per document: doc_id, ids (the best path), score, others (the next best paths, n
    in all, as changes: in place of ``length`` ids from ``at`` on, ``ids``), and the row id of
    ``docs``. ``model`` is read on the driver."""
    lexicon = docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _ENCODERS.get((model, n))
        if encoder is None:
            encoder = _ENCODERS[model, n] = Encoder(lexicon.value, n)
        found = encoder.encode(batch.column("text").to_pylist())
        offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _, _ in found])]).astype(np.int32)
        values = pa.array(np.concatenate([ids for ids, _, _ in found]), pa.int32())
        made = [
            pa.ListArray.from_arrays(pa.array(offsets), values),
            pa.array([score for _, score, _ in found], pa.float64()),
            pa.array([others for _, _, others in found], OTHERS),
        ]
        names = ["doc_id", ROW, "ids", "score", "others"]
        return pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column(ROW), *made], names=names)

    return arrow_map(numbered(docs, "doc_id", "text"), SCHEMA, run, "text", ENCODED)


def decode_ids(lexicon: Lexicon, ids: np.ndarray) -> bytes:
    """The text of a path, without the blank before it."""
    begins, sizes = lexicon.begins[ids], np.diff(lexicon.begins)[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return lexicon.spelled[np.repeat(begins - (ends - sizes), sizes) + np.arange(total)].tobytes()[1:]


def decode(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """``rows`` with the text of their ``ids``. The columns of ``encode`` are passed on."""
    lexicon = rows.sparkSession.sparkContext.broadcast(load(model))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), DECODED):
                batch = whole.slice(at, DECODED)
                ids = batch.column("ids")
                flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
                found = [decode_ids(lexicon.value, flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                text = pa.array(found, pa.binary()).cast(pa.string())
                yield pa.record_batch([*batch.columns, text], names=[*batch.schema.names, "text"])

    return rows.mapInArrow(over, f"{SCHEMA}, text string")


def round_trip(docs: DataFrame, model: str = MODEL, n: int = N_BEST) -> DataFrame:
    """Encode and decode: the columns of ``encode`` with n_pieces and decoded_sha256."""
    decoded = decode(encode(docs, model, n), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "score",
        "others",
        F.sha2("text", 256).alias("decoded_sha256"),
        ROW,
    )
