"""Language identification with a string kernel.

The kernel is the normalised blended-spectrum presence kernel: two texts share the
distinct character n-grams, of one to three symbols, that occur in both. Nyström's
method embeds texts by their kernel values with landmark texts; one ridge regression
per language separates it from the rest. Texts are scored in blocks by two matrix
products: presence of n-grams times landmarks, kernel values times weights.

A symbol is a lower-case letter, or one blank for each run of anything else. a to z have
symbols of their own and other letters share 100 by their code point, so that an n-gram
fits 21 bits for any script. N-grams are those found in landmarks, the most frequent first,
GRAMS_KEPT of them and GRAMS_EACH more for each language.

The model is fitted on a bounded sample of labelled rows: SAMPLE in equal parts of the
languages, but ROWS_EACH of every language at least. LANDMARKS of them are landmarks, but
LANDMARKS_EACH of every language at least. So every language is learned however many there
are, and the model grows with their number, not with the rows. Rows are drawn by a hash of
their id, so the sample is the same in every run.

Scores compare the learned languages with each other, so that a text in none of them has
a best one as well. ``keep_language`` therefore asks how many of a text's distinct trigrams
are known in that language: found in two texts of its sample. The share that labelled texts
reach is measured on the sample, without the text itself. A text goes if in every language
it has fewer than SLACK times that share by more than chance, which leaves short texts more
room.

Defined cases: null text, or text without letters, is ``und`` with score 0, and so is
every text if there is no labelled row. A null doc_id is not held out and not learned
from. Equal scores go to the language that comes first in the alphabet. Repeated rows
are predicted one by one. An empty table gives an empty result. Other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, arrow_map, keep_rows, numbered

#: Bounds of the fitted sample and of the model, and what every language has of them.
SAMPLE, LANDMARKS, GRAMS_KEPT = 2000, 128, 1 << 15
ROWS_EACH, LANDMARKS_EACH, GRAMS_EACH = 16, 2, 64
RIDGE = 1e-2
#: Texts that are scored by one matrix product.
BLOCK = 256
#: Symbols are 1 to 127; a gram of three fills 21 bits.
BLANK, BITS = 27, 7
GRAMS = 1 << (3 * BITS)
UNKNOWN = "und"
#: Quantile of the shares of known trigrams in the sample, the part of it a text needs, and the
#: standard deviations below that are chance.
LOWEST, SLACK, CHANCE = 0.01, 0.9, 3.0


class Model(NamedTuple):
    languages: list[str]
    #: Column of each gram, or the number of columns if it is not in the model.
    columns: np.ndarray
    #: Presence of grams in landmarks, each landmark of length one.
    landmarks: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The symbol of every code point."""
    table = np.full(0x110000, BLANK, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()[0]
            table[point] = ord(low) - 96 if "a" <= low <= "z" else 28 + ord(low) % 100
    return table


def grams(values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, gram) of all grams of all texts, repeats included."""
    padded = [" " + (value or "") + " " for value in values]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(padded), dtype=np.int32), [len(value) for value in padded])
    symbol = symbols()[points]
    blank = symbol == BLANK
    again = np.zeros(len(blank), bool)
    again[1:] = blank[1:] & blank[:-1] & (owner[1:] == owner[:-1])
    symbol, owner = symbol[~again].astype(np.int32), owner[~again]
    letter = symbol != BLANK
    two = owner[1:] == owner[:-1]
    three = owner[2:] == owner[:-2]
    pairs = (symbol[:-1] << BITS) | symbol[1:]
    triples = (pairs[:-1] << BITS) | symbol[2:]
    parts = [(owner[letter], symbol[letter]), (owner[:-1][two], pairs[two]), (owner[:-2][three], triples[three])]
    return np.concatenate([o for o, _ in parts]), np.concatenate([g for _, g in parts])


def presence(owner: np.ndarray, gram: np.ndarray, rows: int, columns: np.ndarray, width: int) -> np.ndarray:
    """Unit rows of the presence of the model's grams in each text."""
    out = np.zeros((rows, width + 1), np.float32)
    out[owner, columns[gram]] = 1
    out = out[:, :width]
    return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def sample(docs: DataFrame, rows: int) -> list[tuple[str, np.ndarray]]:
    """(language, distinct grams) of about ``rows`` labelled texts, or ROWS_EACH of every language
    if that is more, in order of a hash of the id."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return []
    each = max(ROWS_EACH, rows // len(counts))
    shares = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], min(1.0, each / row["n"]))])
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = labelled.withColumn("chance", chance).filter(F.col("chance") < shares[F.col("lang")])
    drawn = drawn.orderBy("chance", "doc_id", "text").limit(2 * each * len(counts))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(grams([text])[1]).astype(np.int32).tobytes() for text in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("lang"), pa.array(found, pa.binary())], names=["lang", "grams"])

    rows_found = arrow_map(drawn.select("lang", "text"), "lang string, grams binary", run, "text").collect()
    return [(row["lang"], np.frombuffer(row["grams"], np.int32)) for row in rows_found if len(row["grams"])]


def fit(drawn: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS) -> Model:
    languages = sorted({lang for lang, _ in drawn})
    if not languages:
        return Model([], np.zeros(GRAMS, np.int32), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    by_lang = [[g for lang, g in drawn if lang == language] for language in languages]
    turns = [texts[i] for i in range(max(map(len, by_lang))) for texts in by_lang if i < len(texts)]
    chosen = turns[: max(landmarks, LANDMARKS_EACH * len(languages))]
    held = np.bincount(np.concatenate(chosen), minlength=GRAMS)
    kept = np.sort(np.argsort(-held, kind="stable")[: min(GRAMS_KEPT + GRAMS_EACH * len(languages), int((held > 0).sum()))])
    columns = np.full(GRAMS, len(kept), np.int32)
    columns[kept] = np.arange(len(kept))

    def unit(part: list[np.ndarray]) -> np.ndarray:
        owner = np.repeat(np.arange(len(part)), [len(g) for g in part])
        return presence(owner, np.concatenate(part), len(part), columns, len(kept))

    marks = unit(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    useful = values > 1e-6 * values.max()
    root = vectors[:, useful] / np.sqrt(values[useful])
    gathered = [g for _, g in drawn]
    embedded = np.concatenate([unit(gathered[i : i + BLOCK]) @ marks.T for i in range(0, len(gathered), BLOCK)]) @ root
    targets = np.array([[lang == language for language in languages] for lang, _ in drawn], np.float64)
    middle, mean = embedded.mean(axis=0), targets.mean(axis=0)
    centred = embedded - middle
    gram_matrix = centred.T @ centred + RIDGE * len(drawn) * np.eye(centred.shape[1]) * 1e-2
    beta = np.linalg.solve(gram_matrix, centred.T @ (targets - mean))
    return Model(languages, columns, marks, root @ beta, mean - middle @ beta)


def scores(model: Model, values: list[str | None]) -> tuple[list[str], list[float]]:
    """The language and score of each text of a block."""
    owner, gram = grams(values)
    lettered = np.zeros(len(values), bool)
    lettered[owner[gram < (1 << BITS)]] = True
    if not model.languages:
        return [UNKNOWN] * len(values), [0.0] * len(values)
    block = presence(owner, gram, len(values), model.columns, model.landmarks.shape[1])
    found = (block @ model.landmarks.T).astype(np.float64) @ model.weights + model.offset
    best = found.argmax(axis=1)
    score = np.where(lettered, np.clip(found[np.arange(len(best)), best], 0, 1), 0.0)
    return [model.languages[i] if real else UNKNOWN for i, real in zip(best, lettered, strict=True)], score.round(6).tolist()


def language_id(docs: DataFrame, rows: int = SAMPLE, landmarks: int = LANDMARKS) -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score, and the row id of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(sample(docs, rows), landmarks))
    run = _scorer(lambda: model.value)
    found = arrow_map(numbered(docs, "doc_id", "text"), f"doc_id long, {ROW} long, lang_pred string, score double", run, "text")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", ROW)


def _scorer(model: Callable[[], Model]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[float]]]:
        for at in range(0, len(batch), BLOCK):
            yield scores(model(), batch.column("text").slice(at, BLOCK).to_pylist())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = list(blocks(batch))
        lang, score = [x for part, _ in made for x in part], [x for _, part in made for x in part]
        columns = [batch.column("doc_id").cast(pa.int64()), batch.column(ROW), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return pa.record_batch(columns, names=["doc_id", ROW, "lang_pred", "score"])

    return run


class Known(NamedTuple):
    #: Known trigrams, as number of the language times GRAMS plus trigram, in order.
    grams: np.ndarray
    #: The share of known trigrams that texts of each language need.
    shares: np.ndarray


def trigrams(codes: np.ndarray) -> np.ndarray:
    return codes[codes >= 1 << (2 * BITS)]


def known_grams(drawn: list[tuple[str, np.ndarray]], languages: list[str]) -> Known:
    found, shares = [], []
    for n, language in enumerate(languages):
        own = [trigrams(codes) for lang, codes in drawn if lang == language]
        held = np.bincount(np.concatenate(own), minlength=GRAMS)
        found.append(n * GRAMS + np.flatnonzero(held > 1))
        # Three texts hold it: two besides the one that is measured.
        reached = [float((held[codes] > 2).mean()) for codes in own if len(codes)]
        shares.append(SLACK * float(np.quantile(reached, LOWEST)) if reached else 0.0)
    return Known(np.concatenate([np.zeros(0, np.int64), *found]), np.array(shares))


def familiar(known: Known, values: list[str | None], predicted: np.ndarray) -> np.ndarray:
    """Whether each text has as many known trigrams as a text in some learned language has. The
    language of a number in ``predicted`` is tried first, the others for texts that fail it."""
    owner, gram = grams(values)
    three = gram >= 1 << (2 * BITS)
    distinct = np.unique(owner[three].astype(np.int64) * GRAMS + gram[three])
    owner, gram = distinct // GRAMS, distinct % GRAMS
    total = np.bincount(owner, minlength=len(values))

    def enough(number: np.ndarray) -> np.ndarray:
        wanted = number[owner] * GRAMS + gram
        at = np.minimum(np.searchsorted(known.grams, wanted), max(len(known.grams) - 1, 0))
        hit = known.grams[at] == wanted if len(known.grams) else np.zeros(len(wanted), bool)
        seen, share = np.bincount(owner, hit, len(values)), known.shares[number]
        return seen >= total * share - CHANCE * np.sqrt(total * share * (1 - share))

    out = enough(predicted)
    for n in range(len(known.shares)):
        if out.all():
            break
        out |= enough(np.full(len(values), n))
    return out


def keep_language(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The documents in a learned language with enough score, all columns as they were."""
    drawn = sample(docs, SAMPLE)
    fitted = fit(drawn)
    model = docs.sparkSession.sparkContext.broadcast((fitted, known_grams(drawn, fitted.languages)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (languages, *_), known = model.value
        number, keep = {language: n for n, language in enumerate(languages)}, []
        for at in range(0, len(batch), BLOCK):
            values = batch.column("text").slice(at, BLOCK).to_pylist()
            lang, score = scores(model.value[0], values)
            near = familiar(known, values, np.array([number.get(x, 0) for x in lang])) if languages else [False] * len(values)
            keep += [bool(n) and x != UNKNOWN and s >= min_score for n, x, s in zip(near, lang, score, strict=True)]
        return pa.record_batch([batch.column(ROW).filter(pa.array(keep, pa.bool_()))], names=[ROW])

    return keep_rows(docs, arrow_map(numbered(docs, "text"), f"{ROW} long", run, "text"))
