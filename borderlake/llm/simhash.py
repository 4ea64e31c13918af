"""SimHash near-dedup by meet-in-the-middle ball hashing.

Texts become 64-bit fingerprints. Fingerprints link at ``RADIUS`` = 3 or fewer
differing bits. Two linked fingerprints have a word between them, at most one bit from
the one and two bits from the other. Every distinct fingerprint emits such words, its
variants; variants are shuffled, and linked fingerprints meet on one.

Not the whole ball of two bits (2,081 words) is needed:

* Words are meant to be met at even parity where the distance is odd. A fingerprint of
  odd parity emits its 64 one-bit variants. One of even parity emits itself and its
  two-bit variants, and its 64 one-bit variants, on which it meets others of even
  parity.
* Of three differing bits, two lie in the same half of the word, so two-bit variants
  with both bits in one half suffice: 992.

Members of a variant at most one bit away (the near ones) are within the radius of
all its other members. So linking one near member to all others gives the same
components as all pairs would, with as many links as members. Each link is verified by
counting its differing bits. Texts with one fingerprint are joined before anything is
emitted, so the members of a variant are distinct fingerprints, 2,081 at most.

Defined cases: a null or blank text has fingerprint zero and is linked like any other.
A null doc_id counts as larger than any other. Repeated rows are rows of one group.
An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, arrow_map, keep_rows, numbered, stored, texts
from .components import components

#: Words in a shingle, bits at which fingerprints link, seed of the shingle hash.
SHINGLE, RADIUS, SEED = 3, 3, 42
#: Variants to a task.
TASK_VARIANTS = 2_000_000
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def _masks() -> tuple[np.ndarray, np.ndarray]:
    one = [1 << i for i in range(64)]
    two = [1 << i | 1 << j for half in (0, 32) for i in range(half, half + 32) for j in range(half, i)]
    return np.array(one, np.uint64), np.array(two, np.uint64)


ONE, TWO = _masks()
MASKS = np.concatenate([np.zeros(1, np.uint64), ONE, TWO])
#: Flips with a code below this are of one bit or none.
NEAR = 1 + len(ONE)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text: a bit is set if it is in over half of the hashes of the
    text's shingles, repeats included. bytes.lower and bytes.split know ASCII only, as meant."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - size + 1
    spans = zip(starts[:total].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, total)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, COUNTED):
        part = hashes[at : at + COUNTED].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row id and fingerprint (as a signed long) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(text, shingle) for text in texts(batch.column("text"))]
        values = pa.array(np.array(found, np.uint64).view(np.int64))
        return pa.record_batch([batch.column("doc_id"), batch.column(ROW), values], names=["doc_id", ROW, "fp"])

    source = numbered(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(source, f"doc_id long, {ROW} long, fp long", run, "text")


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Variants of the distinct fingerprints, with the code of the flips that made them."""
    everything, near = np.arange(len(MASKS), dtype=np.int16), np.arange(1, NEAR, dtype=np.int16)
    for batch in batches:
        own = batch.column(0).to_numpy().view(np.uint64)
        odd = (np.bitwise_count(own) & 1).astype(bool)
        for codes, words in ((near, own[odd]), (everything, own[~odd])):
            for at in range(0, len(words), 256):
                made = words[at : at + 256, None] ^ MASKS[codes][None, :]
                flips = np.broadcast_to(codes, made.shape).reshape(-1)
                yield pa.record_batch([pa.array(made.reshape(-1).view(np.int64)), pa.array(flips)], names=["variant", "flips"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the members of each variant in a partition of about TASK_VARIANTS rows."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return
    variants = np.concatenate([v for v, _ in held]).view(np.uint64)
    flips = np.concatenate([f for _, f in held])
    del held
    order = np.argsort(variants, kind="stable")
    variants, flips = variants[order], flips[order]
    same = variants[1:] == variants[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    variants, flips = variants[shared], flips[shared]
    if not len(variants):
        return
    owners = variants ^ MASKS[flips]
    starts = np.flatnonzero(np.concatenate([[True], variants[1:] != variants[:-1]]))
    sizes = np.diff(np.append(starts, len(variants)))
    none = np.uint64(2**64 - 1)  # stands for no near member; a fingerprint of all ones is no smaller
    centre = np.repeat(np.minimum.reduceat(np.where(flips < NEAR, owners, none), starts), sizes)
    has_near = np.repeat(np.maximum.reduceat(flips < NEAR, starts), sizes)
    close = has_near & (owners != centre) & (np.bitwise_count(owners ^ centre) <= RADIUS)
    links = np.unique(np.stack([centre[close], owners[close]], axis=1), axis=0).view(np.int64)
    yield pa.record_batch([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) of the distinct fingerprints (fp) that give their components."""
    rows = distinct.count() * (len(MASKS) + len(ONE)) // 2
    tasks = max(1, math.ceil(rows / TASK_VARIANTS))
    spread = distinct.select("fp").repartition(max(tasks, 1), "fp")
    variants = spread.mapInArrow(_emit, "variant long, flips short")
    return variants.repartition(tasks, "variant").mapInArrow(_meet, "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id reachable), kept (one row of each component), and the row id of ``docs``, which
    must be a stored table."""
    table = stored(fingerprints(docs, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    distinct = stored(table.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
    roots = components(links(distinct))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("smallest"))
    groups = stored(placed.join(smallest, "root").select("fp", "smallest"), "groups")
    return table.join(groups, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("smallest.doc_id").alias("component_id"),
        (F.col(ROW) == F.col("smallest")[ROW]).alias("kept"),
        ROW,
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group, with all its columns."""
    return keep_rows(docs, simhash_groups(docs, shingle).filter("kept"))
