"""LM scoring by cross-entropy difference.

Two word bigram models, of the target texts and of all other texts, are matched: one
vocabulary, one order, one smoothing. The mean difference of their losses per token
scores each document; below zero, it reads more like the target texts.

The vocabulary is every word of all documents, and each pair of words has a count of its
own. The model is a table that grows with the corpus and that no task holds as a whole:

1. A task goes through its documents in lots of about LOT tokens and emits, for each lot,
   its distinct words and pairs by key with their counts on both sides, cut into buckets
   of the keys.
2. All lots of a bucket meet in one task, which adds the counts up and gives each lot the
   sums of its keys, in the order of its keys. A key has one row of a lot at most, however
   frequent it is.
3. The sums are stored by the partition of the documents. The next scan of a partition
   makes the same lots, reads their sums and scores the documents. Texts are never shuffled.

The key of a word is a 64-bit digest, that of a pair a 64-bit combination of two: among a
billion distinct keys, the chance that any two are alike is 3 in 100. The number of buckets
follows the size of the table.

Smoothing interpolates a bigram with its unigram by a Dirichlet prior of PRIOR tokens; the
unigram adds one to each of the words, of which it assumes VOCABULARY at least. The first
token of a document has its unigram loss.
A document is scored as if it had not been counted: its own counts are taken off the
model that holds them, else each would favour the side it is on.

Defined cases: a null or blank text has no tokens and null losses. A document is a
target if any row of ``target`` has its id. A null doc_id is never a target. Repeated
rows count and are scored one by one. Without targets, or without others, that model is
its prior. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PART_BIT, ROW, by_part, numbered, read_part, slices, texts

#: Words the smoothing assumes at least, tokens of the prior.
VOCABULARY, PRIOR = 8192, 64.0
#: Tokens that are counted and scored at a time.
LOT = 1 << 20
#: Buckets of the keys at least, and bytes of the table for each.
BUCKETS, BUCKET_BYTES = 256, 16 << 20
#: Distinct words a task holds before it hands their counts on.
HELD_WORDS = 400_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: A-Z lowered, ASCII punctuation and controls blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> list[bytes]:
    """The most frequent words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for piece in slices(batches, 0):
            for text in texts(piece.column(0)):
                held.update(words_of(text))
            if len(held) > HELD_WORDS:
                yield _counts(held)
                held = Counter()
        if held:
            yield _counts(held)

    counted = docs.select("text").mapInArrow(count, "word binary, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    top = total.orderBy(F.desc("n"), "word").limit(size - 1).collect()
    return [bytes(row["word"]) for row in top]


def _counts(held: Counter[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


class Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Lot(NamedTuple):
    """Some documents of a partition and their tokens."""

    #: The number of the partition above PART_BIT, and that of the lot.
    number: int
    doc_ids: list[int | None]
    rows: list[int]
    target: np.ndarray
    sizes: np.ndarray
    #: Distinct keys in order, of words and of pairs.
    keys: tuple[np.ndarray, np.ndarray]
    #: For each token, the place of its word, and of the pair with the token before it (-1 if first).
    places: tuple[np.ndarray, np.ndarray]


def lots(batches: Iterator[pa.RecordBatch], targets: str, lot: int) -> Iterator[Lot]:
    """The lots of a partition, the same in every scan."""
    wanted, number = None, 0
    known, held, doc_ids, rows, size = Ids(), [], [], [], 0

    def made() -> Lot:
        digests = b"".join(hashlib.blake2b(word, digest_size=8).digest() for word in known)
        words, place = np.unique(np.frombuffer(digests, np.uint64), return_inverse=True)
        place = place[np.concatenate(held)]
        sizes = np.array([len(ids) for ids in held])
        later = np.ones(len(place), bool)
        later[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        after = np.flatnonzero(later)
        pairs, at = np.unique(words[place[after - 1]] * MULTIPLIER + words[place[after]], return_inverse=True)
        pair = np.full(len(place), -1, np.int64)
        pair[after] = at
        return Lot(number, doc_ids, rows, np.isin(rows, wanted), sizes, (words, pairs), (place, pair))

    for piece in slices(batches, 2):
        if wanted is None:
            part = piece.column(1)[0].as_py() >> PART_BIT
            table, number = read_part(targets, part, [ROW]), part << PART_BIT
            wanted = table[ROW].to_numpy() if table is not None else np.zeros(0, np.int64)
        for doc_id, row, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), texts(piece.column(2)), strict=True):
            tokens = words_of(text)
            held.append(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))
            doc_ids.append(doc_id)
            rows.append(row)
            size += len(tokens) + 1
            if size >= lot:
                yield made()
                known, held, doc_ids, rows, size = Ids(), [], [], [], 0
                number += 1
    if held:
        yield made()


def packed(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // size}")


def cuts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets that have keys, with the begin and end of each."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[begins], begins, np.append(begins[1:], len(keys))


KEYS = f"kind int, bucket long, {ROW} long, keys binary, others binary, target binary"


def lot_counts(source: DataFrame, targets: str, lot: int, bits: int) -> DataFrame:
    """The words (kind 0) and pairs (kind 1) of each lot and bucket, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in lots(batches, targets, lot):
            side = np.repeat(one.target, one.sizes)
            found = []
            for kind, (keys, places) in enumerate(zip(one.keys, one.places, strict=True)):
                others, target = (np.bincount(places[(side == which) & (places >= 0)], minlength=len(keys)) for which in (False, True))
                for bucket, a, b in zip(*(x.tolist() for x in cuts(keys, bits)), strict=True):
                    found.append((kind, bucket, one.number, keys[a:b].tobytes(), packed(others[a:b]), packed(target[a:b])))
            if found:
                types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.record_batch(columns, names=["kind", "bucket", ROW, "keys", "others", "target"])

    return source.mapInArrow(run, KEYS)


SUMS = f"{ROW} long, kind int, bucket long, others binary, target binary, n_words long, n_others long, n_target long"


def summed(rows: DataFrame) -> DataFrame:
    """For each row of ``lot_counts`` the sums over all lots of its keys. Buckets of words add a
    row of number -1 with how many words they have, and how many tokens on each side."""

    def sums(group: list[tuple]) -> pa.RecordBatch:
        keys = [np.frombuffer(row[3], np.uint64) for row in group]
        ends = np.cumsum([len(part) for part in keys])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for column in (4, 5):
            counts = np.concatenate([unpacked(row[column], len(part)) for row, part in zip(group, keys, strict=True)])
            totals.append(np.bincount(at, counts).astype(np.int64))
        kind, bucket = group[0][:2]
        found = []
        for row, part, end in zip(group, keys, ends.tolist(), strict=True):
            mine = at[end - len(part) : end]
            found.append((row[2], kind, bucket, packed(totals[0][mine]), packed(totals[1][mine]), None, None, None))
        if kind == 0:
            found.append((-1, kind, bucket, None, None, len(distinct), int(totals[0].sum()), int(totals[1].sum())))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.record_batch(columns, names=[ROW, "kind", "bucket", "others", "target", "n_words", "n_others", "n_target"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if group and group[0][:2] != row[:2]:
                    yield sums(group)
                    group = []
                group.append(row)
        if group:
            yield sums(group)

    spread = rows.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    return spread.mapInArrow(run, SUMS)


def losses(one: Lot, sums: list[list[np.ndarray]], tokens: tuple[int, int], n_words: int) -> list[np.ndarray]:
    """Mean losses of the documents of a lot under (target, others), each without its own counts
    on its side. ``sums`` has those of the lot's words and pairs on both sides."""
    word, pair = one.places
    owner = np.repeat(np.arange(len(one.sizes)), one.sizes)
    later = pair >= 0
    own = []
    for places, keys in zip(one.places, one.keys, strict=True):
        _, at, times = np.unique(owner * (len(keys) + 1) + places + 1, return_inverse=True, return_counts=True)
        own.append(times[at])
    out = []
    for which in (1, 0):
        mine = (one.target == bool(which))[owner]
        words = sums[0][which][word].astype(np.float64) - mine * own[0]
        pairs = np.zeros(len(word))
        pairs[later] = sums[1][which][pair[later]].astype(np.float64) - (mine * own[1])[later]
        first = np.where(later, np.concatenate([[0.0], words[:-1]]), 0.0)
        plain = (words + 1) / (tokens[which] - mine * one.sizes[owner] + n_words)
        loss = -np.log((pairs + PRIOR * plain) / (first + PRIOR))
        out.append(np.bincount(owner, loss, len(one.sizes)) / np.maximum(one.sizes, 1))
    return out


def lm_score(docs: DataFrame, target: DataFrame, lot: int = LOT) -> DataFrame:
    """A row per document: doc_id, is_target, n_tokens, loss_target, loss_background, score
    (their difference) and the row id of ``docs``, which must be a stored table. ``target`` has
    the doc_id of target documents."""
    spark = docs.sparkSession
    ids = target.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    source = numbered(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), ROW, "text")
    targets = by_part(source.select("doc_id", ROW).join(ids, "doc_id").select(ROW), "lm-targets", ROW)
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bits = (max(BUCKETS, size // BUCKET_BYTES) - 1).bit_length()
    folder = by_part(summed(lot_counts(source, targets, lot, bits)), "lm-sums", ROW, "kind", "bucket")
    counted = spark.read.schema(f"{SUMS}, part long").parquet(folder).filter("part = -1")
    total = counted.agg(*(F.coalesce(F.sum(name), F.lit(0)) for name in ("n_words", "n_others", "n_target"))).first()
    n_words, tokens = max(VOCABULARY, total[0] + 1), (total[1], total[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for one in lots(batches, targets, lot):
            if table is None:
                table = read_part(folder, one.number >> PART_BIT, [ROW, "kind", "bucket", "others", "target"]) or pa.table({ROW: []})
                numbers = table[ROW].to_numpy()
            of_lot = table.take(np.flatnonzero(numbers == one.number)).to_pylist()
            of_lot.sort(key=lambda row: (row["kind"], row["bucket"]))
            sums = []
            for kind, keys in enumerate(one.keys):
                _, begins, ends = cuts(keys, bits)
                mine = [row for row in of_lot if row["kind"] == kind]
                sums.append(
                    [
                        np.concatenate([np.zeros(0, np.int64), *(unpacked(row[side], n) for row, n in zip(mine, (ends - begins).tolist(), strict=True))])
                        for side in ("others", "target")
                    ]
                )
            found, empty = losses(one, sums, tokens, n_words), one.sizes == 0
            columns = [pa.array(one.doc_ids, pa.int64()), pa.array(one.rows, pa.int64()), pa.array(one.target), pa.array(one.sizes, pa.int64())]
            columns += [pa.array(loss, pa.float64(), mask=empty) for loss in found]
            yield pa.record_batch(columns, names=["doc_id", ROW, "is_target", "n_tokens", "loss_target", "loss_background"])

    schema = f"doc_id long, {ROW} long, is_target boolean, n_tokens long, loss_target double, loss_background double"
    return source.mapInArrow(run, schema).withColumn("score", F.col("loss_target") - F.col("loss_background"))
