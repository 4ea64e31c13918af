"""Records of delimited text, cut over many tasks although quoted fields may hold line breaks.

Where a split starts inside a quoted field cannot be seen from its first byte alone: it
depends on the number of quotes in all splits before. So each task guesses the state its
split starts in from where quotes stand, and cuts records by it. It also reports the guess,
the parity of its quotes and the pieces of records that cross its borders. The prefix sum of
the parities over the splits of a file then says which guesses were right. Nearly always all
are; if not, the pass is run again with the states that are now known.

Everything is one pass over the text. Only border pieces, two for a split at most, are put
together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a row of ``assemble`` is: a whole record, a file's header, or the border of a split.
RECORD, HEADER, BORDER = 0, 1, 2

BORDER_TYPE = "struct<block: bigint, guess: int, parity: int, head: string, tail: string, header: boolean>"
ASSEMBLED = f"kind int, file string, name string, text string, border {BORDER_TYPE}"
_BORDER = pa.struct(
    [("block", pa.int64()), ("guess", pa.int32()), ("parity", pa.int32()), ("head", pa.string()), ("tail", pa.string()), ("header", pa.bool_())]
)
# Characters of a split that its state is guessed from.
GUESSED_FROM = 1 << 16
QUOTES = re.compile('"+')


def plausible(text: str, inside: bool) -> bool:
    """Could text that starts inside (or outside) a quoted field have its quotes where they are?

    A field opens after a comma or line break only, and after it closes one must follow."""
    for run in QUOTES.finditer(text):
        odd = (run.end() - run.start()) % 2 == 1
        if not inside and run.start() > 0 and text[run.start() - 1] not in ",\r\n":
            return False
        closes = odd if inside else not odd
        if closes and run.end() < len(text) and text[run.end()] not in ",\r\n":
            return False
        inside ^= odd
    return True


def guess_state(sample: str) -> int:
    return int(plausible(sample, True) and not plausible(sample, False))


def split_returns(record: str) -> list[str]:
    """Cut a record at line ends that are a lone carriage return outside quotes."""
    if "\r" not in record:
        return [record]
    parts = record.split('"')
    parts[::2] = [p.replace("\r", "\0\n") for p in parts[::2]]
    return '"'.join(parts).split("\0\n")


class Block:
    """The lines of one split, in order. Batches are cut as they come."""

    def __init__(self, file: str, name: str, start: int, sample: str, known: int | None) -> None:
        self.file, self.name, self.start = file, name, start
        self.guess = (0 if start == 0 else guess_state(sample)) if known is None else known
        self.open, self.parity = bool(self.guess), 0
        self.head: list[str] = []
        self.tail: list[str] = []
        self.in_head, self.wants_header = self.open, start == 0

    def add(self, lines: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        """Records of a batch: runs of lines that are records by themselves as they are, the
        few others put together line by line."""
        done = 0
        while self.wants_header and done < len(lines):
            yield from self._line(lines[done].as_py())
            done += 1
        lines = lines.slice(done)
        odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False)
        after = (np.cumsum(odd) + self.open) % 2 == 1
        at = 0
        for i in np.flatnonzero(after | np.append(self.open, after)[:-1]).tolist():
            if at < i:
                yield RECORD, lines.slice(at, i - at)
            yield from self._line(lines[i].as_py())
            at = i + 1
        if at < len(lines):
            yield RECORD, lines.slice(at)

    def _line(self, line: str) -> Iterator[tuple[int, pa.Array]]:
        was_open, odd = self.open, line.count('"') & 1
        self.open, self.parity = self.open ^ bool(odd), self.parity ^ odd
        if self.in_head:
            self.head.append(line)
            self.in_head = self.open
        elif was_open or self.open:
            self.tail.append(line)
            if not self.open:
                yield from self._whole("\n".join(self.tail))
                self.tail = []
        else:
            yield from self._whole(line)

    def _whole(self, record: str) -> Iterator[tuple[int, pa.Array]]:
        if not self.wants_header:
            yield RECORD, pa.array([record])
            return
        for one in split_returns(record.removesuffix("\r")):
            kind = HEADER if self.wants_header and one.strip() else RECORD
            self.wants_header &= kind == RECORD
            yield kind, pa.array([one])

    def border(self) -> pa.RecordBatch:
        told = {
            "block": self.start, "guess": self.guess, "parity": self.parity,
            "head": "\n".join(self.head) if self.guess else None,
            "tail": "\n".join(self.tail) if self.tail else None, "header": self.wants_header and bool(self.tail),
        }
        return self.rows(BORDER, pa.nulls(1, pa.string()), pa.array([told], _BORDER))

    def rows(self, kind: int, text: pa.Array, border: pa.Array | None = None) -> pa.RecordBatch:
        if kind != BORDER:
            text = tidied(text)
        n = len(text)
        same = [pa.array([v]).take(pa.array(np.zeros(n, np.int32))) for v in (self.file, self.name)]
        columns = [pa.array(np.full(n, kind, np.int32)), *same, text, pa.nulls(n, _BORDER) if border is None else border]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "file", "name", "text", "border"])


def assemble(spark: SparkSession, path: str, states: dict[tuple[str, int], int]) -> DataFrame:
    """Records, headers and borders of the files under ``path``. ``states`` has the start of
    splits whose guess was wrong."""
    meta = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select(
        "value", meta["file_path"].alias("file"), meta["file_name"].alias("name"), meta["file_block_start"].alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        for batch in batches:
            if not len(batch):  # of a split in which no line begins
                continue
            starts = batch.column(3).to_numpy()
            index = batch.column(1).dictionary_encode().indices.to_numpy()
            cuts = (np.flatnonzero((index[1:] != index[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist()
            for first, end in zip([0, *cuts], [*cuts, len(starts)], strict=True):
                piece = batch.column(0).slice(first, end - first)
                file, start = batch.column(1)[first].as_py(), int(starts[first])
                if block is None or (block.file, block.start) != (file, start):
                    if block is not None:
                        yield block.border()
                    sample = "\n".join(pc.utf8_slice_codeunits(piece.slice(0, 1000), 0, GUESSED_FROM).to_pylist())
                    name = batch.column(2)[first].as_py()
                    block = Block(file, name, start, sample[:GUESSED_FROM], states.get((file, start)))
                for kind, records in block.add(piece):
                    yield block.rows(kind, records)
        if block is not None:
            yield block.border()

    return lines.mapInArrow(run, ASSEMBLED)


def tidied(text: pa.Array) -> pa.Array:
    """Records without the carriage return of their line end, lone ones cut, blank ones left out."""
    if pc.any(pc.match_substring(text, "\r")).as_py():
        text = pc.replace_substring_regex(text, r"\r$", "")
        if pc.any(pc.match_substring(text, "\r")).as_py():
            text = pa.array([r for record in text.to_pylist() for r in split_returns(record)], pa.string())
    return text.filter(pc.not_equal(pc.ascii_trim_whitespace(text), ""))


def true_states(borders: DataFrame) -> DataFrame:
    """The borders with the state their split really starts in, and ``chain``: the number of
    records before it that cross a border of their file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.col("tail").isNotNull().cast("int")
    return borders.withColumns(
        {
            "state": F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2,
            "chain": F.coalesce(F.sum(opened).over(before), F.lit(0)),
        }
    )


def stitched(borders: DataFrame) -> DataFrame:
    """(kind, file, name, text): the records that cross borders, put together from their pieces."""
    piece = F.struct(F.lit(0).alias("at"), F.col("head").alias("text"), F.col("chain").alias("of"), F.lit(False).alias("header"))
    start = F.struct(F.lit(1).alias("at"), F.col("tail").alias("text"), (F.col("chain") + 1).alias("of"), "header")
    pieces = true_states(borders).select("file", "name", "block", F.explode(F.array(piece, start)).alias("p"))
    pieces = pieces.filter("p.text is not null").select("file", "name", "block", "p.*")
    joined = pieces.groupBy("file", "name", "of").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("pieces"), F.bool_or("header").alias("header")
    )
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    return joined.select(F.when(F.col("header"), HEADER).otherwise(RECORD).alias("kind"), "file", "name", F.regexp_replace(text, r"\r\z", "").alias("text"))
