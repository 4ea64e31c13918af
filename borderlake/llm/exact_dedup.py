"""Exact dedup by a tree merge of sorted digest runs.

Each input partition sorts the digests of its texts into a run. In every round the
runs of ``FAN_IN`` neighbouring nodes meet: they are exchanged by (node, digest), so a
node of the tree is spread over all tasks by digest and no task ever holds a whole
run, and merged in sorted order into one entry per text with its smallest identifier.
After the first round a text with millions of copies has one entry per node, so a hot
text never makes a hot task.

An entry is the text's SHA-256 together with its length and a second hash. Entries
meet only where all three agree, at every level.

Defined cases: a null text is empty. A null doc_id counts as larger than any other.
Of rows with equal text and equal doc_id the first row stays. An empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, keep_rows, numbered, stored

#: Nodes that merge into one in a round.
FAN_IN = 8
#: White space that separates words, as one space.
SPACE = r"[\x20\x09-\x0D]+"

KEY = ["sha", "n_bytes", "check"]
RUN = "node long, sha binary, n_bytes int, check long, no_id boolean, first_id long, first_row long, copies long"


def digests(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, row id, and the three-part digest of its normalised text."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    return (
        numbered(docs, "doc_id", "text")
        .select("doc_id", ROW, text.alias("text"))
        .select(
            "doc_id",
            ROW,
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.octet_length("text").alias("n_bytes"),
            F.xxhash64("text").alias("check"),
        )
    )


def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge entries with equal key in a stream sorted by node, key and identifier.

    The smallest identifier is the first of its entries, as the stream is sorted by it."""
    held: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        starts = np.flatnonzero(np.concatenate([[True], _differs(table)]))
        sums = np.add.reduceat(table["copies"].to_numpy(), starts)
        merged = table.take(pa.array(starts))
        at = merged.schema.get_field_index("copies")
        merged = merged.set_column(at, merged.schema.field(at), pa.chunked_array([sums]))
        held = merged.slice(len(merged) - 1)  # its key may go on in the next batch
        yield from merged.slice(0, len(merged) - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def _differs(table: pa.Table) -> np.ndarray:
    """Whether each row's (node, key) differs from the row before it."""
    out = np.zeros(len(table) - 1, bool)
    for name in ("node", *KEY):
        column = table[name]
        out |= pc.not_equal(column.slice(1), column.slice(0, len(table) - 1)).to_numpy()
    return out


def tree_merge(runs: DataFrame, nodes: int) -> DataFrame:
    """Merge the sorted runs of ``nodes`` nodes round by round, to one entry per text."""
    order = ["node", *KEY, "no_id", "first_id", "first_row"]
    merged = runs.sortWithinPartitions(*order).mapInArrow(merge_sorted, RUN)
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        parent = F.floor(F.col("node") / FAN_IN) if nodes > 1 else F.lit(0).cast("long")
        met = merged.withColumn("node", parent).repartition("node", "sha")
        merged = met.sortWithinPartitions(*order).mapInArrow(merge_sorted, RUN)
    return merged


def exact_dedup(docs: DataFrame) -> DataFrame:
    """A row per document, dropped ones too: doc_id, keep_id, group_size, kept,
    text_sha256, and the row id (``ROW``) of ``docs``, which must be a stored table."""
    table = stored(digests(docs), "exact-digests")
    runs = table.select(
        F.spark_partition_id().cast("long").alias("node"),
        *KEY,
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("first_id"),
        F.col(ROW).alias("first_row"),
        F.lit(1).cast("long").alias("copies"),
    )
    first = stored(tree_merge(runs, table.rdd.getNumPartitions()).drop("node", "no_id"), "exact-first")
    return table.join(first, KEY).select(
        "doc_id",
        F.col("first_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col(ROW) == F.col("first_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        ROW,
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_rows(docs, exact_dedup(docs).filter("kept"))
