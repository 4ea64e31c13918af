"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches, from the largest doc_id down. What is known of the lines so
far is kept as sorted runs of (line hash, documents, holder), in levels. A new batch is
anti-joined with the runs: a line in none of them enters with the batch's largest
doc_id as its holder, which no later batch can exceed; a line found there only adds its
documents. The batch adds both as its own run. When a level has ``FAN_IN`` runs, they
are compacted into one run of the next level. After the last batch the runs are
compacted once more, and the lines in enough documents lose all copies but the holder's.

A line's hash is the SHA-256 of its key. Lines are counted per document before they are
shuffled, and a line in a third of all documents is reduced by the map-side part of an
aggregate; no group is gathered in one task.

Defined cases: a null or empty text is one empty line. Rows with the same doc_id are
one document when counting, and each keeps its copy of a line it holds. Rows with a null
doc_id do not count and keep all lines. A line that stands several times in its holder
stays there each time. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, arrow_map, drop_stored, numbered, stored, texts

#: Code points a key needs, and documents that must hold it.
MIN_CHARS, MIN_DOCS = 40, 5
#: Batches of documents, and runs of a level that are compacted into one of the next.
BATCHES, FAN_IN = 4, 2
WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row id, line number, hash) of every line with a key of enough code points."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, numbers, hashes = [], [], []
        for i, text in enumerate(texts(batch.column("text"))):
            for number, line in enumerate(text.split(b"\n")):
                key = line_key(line)
                if len(key) >= min_chars and len(key.decode()) >= min_chars:
                    at.append(i)
                    numbers.append(number)
                    hashes.append(hashlib.sha256(key).digest())
        rows = pa.array(at, pa.int64())
        columns = [batch.column("doc_id").take(rows), batch.column(ROW).take(rows), pa.array(numbers, pa.int32())]
        return pa.record_batch([*columns, pa.array(hashes, pa.binary())], names=["doc_id", ROW, "line", "hash"])

    source = numbered(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(source, f"doc_id long, {ROW} long, line int, hash binary", run, "text")


class Runs:
    """Levels of sorted runs (hash, docs, holder), each a stored table.

    A hash has one row with a holder among all runs, and one without for every later batch."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[list[DataFrame]] = []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, rows: DataFrame, level: int = 0) -> None:
        self.levels += [[]] * (level + 1 - len(self.levels))
        run = rows.repartition("hash").sortWithinPartitions("hash")
        self.levels[level] = [*self.levels[level], stored(run, f"line-run-{level}")]
        if len(self.levels[level]) >= FAN_IN:
            old, self.levels[level] = self.levels[level], []
            self.add(compacted(old), level + 1)
            for run in old:
                drop_stored(run)

    def take_in(self, batch: DataFrame) -> None:
        """Add a batch (hash, docs, holder) whose holders are below those in the runs."""
        fresh = repeated = batch
        for run in self.all():
            fresh = fresh.join(run.select("hash"), "hash", "left_anti")
        if self.all():
            known = compacted(self.all()).select("hash")
            repeated = batch.join(known, "hash", "left_semi")
            fresh = fresh.union(repeated.withColumn("holder", F.lit(None).cast("long")))
        self.add(fresh)


def compacted(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.union(run)
    return rows.groupBy("hash").agg(F.sum("docs").alias("docs"), F.max("holder").alias("holder"))


def frequent_lines(lines: DataFrame, batches: int, min_docs: int) -> DataFrame:
    """(hash, holder) of the lines in enough documents. ``lines`` is a stored table."""
    spark = lines.sparkSession
    share = [i / batches for i in range(1, batches)]
    found = lines.agg(F.percentile_approx("doc_id", share, 1000)).first()[0] if share else None
    cuts = sorted(set(found or ()), reverse=True)
    runs, above = Runs(spark), F.lit(True)
    for cut in [*cuts, None]:
        here = above if cut is None else above & (F.col("doc_id") > cut)
        held = lines.filter(here & F.col("doc_id").isNotNull()).select("hash", "doc_id").distinct()
        runs.take_in(held.groupBy("hash").agg(F.count("*").alias("docs"), F.max("doc_id").alias("holder")))
        above = F.col("doc_id") <= cut if cut is not None else above
    return compacted(runs.all()).filter(F.col("docs") >= min_docs).select("hash", "holder")


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """A row per document: doc_id, n_lines (before dropping), n_dropped, text (lines kept,
    joined by a line feed), and the row id of ``docs``, which must be a stored table."""
    lines = stored(line_hashes(docs, min_chars), "lines")
    frequent = stored(frequent_lines(lines, batches, min_docs), "frequent-lines")
    lost = lines.join(frequent, "hash").filter(F.col("doc_id") != F.col("holder"))
    dropped = lost.groupBy(ROW).agg(F.collect_list("line").alias("dropped"))
    marked = numbered(docs, "doc_id", "text").join(dropped, ROW, "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        for text, gone in zip(texts(batch.column("text")), batch.column("dropped").to_pylist(), strict=True):
            parts = text.split(b"\n")
            n_lines.append(len(parts))
            n_dropped.append(len(gone or ()))
            if gone:
                stay = np.ones(len(parts), bool)
                stay[gone] = False
                text = b"\n".join(part for part, here in zip(parts, stay, strict=True) if here)
            kept.append(text)
        made = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        names = ["doc_id", ROW, "n_lines", "n_dropped", "text"]
        return pa.record_batch([batch.column("doc_id"), batch.column(ROW), *made], names=names)

    source = marked.select(F.col("doc_id").cast("long").alias("doc_id"), ROW, "text", "dropped")
    return arrow_map(source, f"doc_id long, {ROW} long, n_lines long, n_dropped long, text string", run, "text")
