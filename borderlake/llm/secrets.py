"""Secret scan with multipart credential linking.

1. *Scan*, one pass over the texts: regular expressions find strong spans, which count by
   themselves (``assign``, ``access``, ``hex``), and weak candidates, which are harmless
   alone: names of accounts (``account``), opaque strings (``opaque``) and addresses of
   services (``endpoint``). Every span knows its scope, the block of lines it stands in; blank
   lines part scopes.
2. *Link.* Access identifiers (``access``, ``account``) and endpoints are complementary to
   secrets (``assign``, ``hex``, ``opaque``). Identifiers and endpoints are stretched by REACH
   code points on both sides and meet the secrets of their scope they then overlap: an
   interval join, as an equi-join on bins of the line of code points plus the exact test.
   Spans of a kind do not overlap and have a least length, so a span meets a bounded number
   of others however long its text is, and a text with millions of spans is spread by bins.
3. *Report.* Strong spans stay whatever happens; a weak candidate is added only if it met its
   complementary part. An endpoint alone with an account is no credential.

Texts are not shuffled, only spans are, and of those only the ones in texts where both sides
occur.

Defined cases: a null text is empty and has no spans (the hash is that of an empty string).
Letters of keywords are ASCII in either case. Texts of any length are read whole; positions
are code points. Each row gives a row, also repeated ones and those with null ids. Of
candidates of different kinds at the same place all count; an opaque string or account that
overlaps a strong span is left out, as that span is reported. No pattern looks at a character
more than some dozen times, so a text of one endless word takes time in proportion. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, slices, stored

#: How far apart, in code points, the parts of a credential may stand.
REACH = 200

# The formats of strong spans and the least length of what they hold.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{24,})"

# Weak candidates.
ACCOUNT = (
    r"(?:[Uu][Ss][Ee][Rr](?:_?[Nn][Aa][Mm][Ee]|_?[Ii][Dd])?|[Ll][Oo][Gg][Ii][Nn]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt](?:_?[Ii][Dd])?"
    r"|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy](?:_?[Ii][Dd])?)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@-]+)"
)
OPAQUE = r"([A-Za-z0-9+/_=-]{16,})"
ENDPOINT = r"([a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9_.:@-]+(?:/[A-Za-z0-9_./?=&%-]*)?)"
BLANK_LINES = r"\n[\x20\t\r]*\n"

#: Kinds as spans are ordered at one start, with their pattern and the least length of its group.
KINDS = {
    "assign": (ASSIGN, 6),
    "access": (ACCESS, 20),
    "hex": (HEX, 24),
    "account": (ACCOUNT, 3),
    "opaque": (OPAQUE, 16),
    "endpoint": (ENDPOINT, 8),
}
STRONG = ("assign", "access", "hex")
NAMES = tuple(KINDS)
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "account"), ("assign", "hex", "opaque"), ("endpoint",)

_PATTERNS = {kind: (re.compile(pattern), least) for kind, (pattern, least) in KINDS.items()}
_BLANK_LINES = re.compile(BLANK_LINES)

SPAN = "struct<kind: int, start: int, end: int, scope: int>"
SCANNED = f"{ROW} bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base array<{SPAN}>, weak array<{SPAN}>"


def spans_of(text: str, kind: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap; those whose group is too short are dropped after."""
    pattern, least = _PATTERNS[kind]
    return [m.span() for m in pattern.finditer(text) if m.end(1) - m.start(1) >= least]


def mixed(text: str, span: tuple[int, int]) -> bool:
    """Has an opaque string digits and letters?"""
    piece = text[span[0] : span[1]]
    return any("0" <= c <= "9" for c in piece) and any("a" <= c <= "z" or "A" <= c <= "Z" for c in piece)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{NAMES[s[0]]}:{s[1]}:{s[2]}" for s in spans)


def parts(text: str) -> tuple[list[tuple], list[tuple]]:
    """Strong spans and weak candidates of a text as (kind number, start, end, scope), in order."""
    found = {kind: spans_of(text, kind) for kind in NAMES}
    found["opaque"] = [s for s in found["opaque"] if mixed(text, s)]
    strong = sorted(s for kind in STRONG for s in found[kind])
    if not any(found.values()):
        return [], []
    breaks = [m.start() for m in _BLANK_LINES.finditer(text)]
    # Strong spans of different kinds may overlap: the furthest end so far tells.
    starts, furthest = [s[0] for s in strong], []
    for s in strong:
        furthest.append(max(s[1], furthest[-1] if furthest else 0))

    def covered(span: tuple[int, int]) -> bool:
        before = bisect_right(starts, span[1] - 1)
        return before > 0 and furthest[before - 1] > span[0]

    def ordered(kinds: tuple[str, ...]) -> list[tuple]:
        rows = [(s[0], NAMES.index(k), s[1]) for k in kinds for s in found[k]]
        return [(kind, start, end, bisect_right(breaks, start)) for start, kind, end in sorted(rows)]

    for kind in ("account", "opaque"):
        found[kind] = [s for s in found[kind] if not covered(s)]
    return ordered(STRONG), ordered(NAMES[len(STRONG) :])


def scan(docs: DataFrame) -> DataFrame:
    """Strong spans and weak candidates of each row, stored; ``id`` is the row's doc_id."""
    rows = docs.select("text", F.monotonically_increasing_id().alias(ROW), F.col("doc_id").alias("id"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "scope")]))
        for batch in (piece for whole in batches for piece in slices(iter([whole]), 0)):
            out = [parts(text or "") for text in batch.column(0).to_pylist()]
            counts = [[sum(s[0] == k for s in base) for base, _ in out] for k in range(len(STRONG))]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in out]
            lists = [pa.array([_structs(o[i]) for o in out], span) for i in (0, 1)]
            columns = [batch.column(1), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), *lists, batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return stored(rows.mapInArrow(run, f"{SCANNED}, id {kind}"), "secrets-scanned")


def _structs(spans: list[tuple]) -> list[dict]:
    return [dict(zip(("kind", "start", "end", "scope"), s, strict=True)) for s in spans]


def _numbers(kinds: tuple[str, ...]) -> list[int]:
    return [NAMES.index(k) for k in kinds]


def spans(scanned: DataFrame) -> DataFrame:
    """One row for each span of texts where a link is possible: row id, kind, start, end, scope."""
    every = F.concat("base", "weak")

    def holds(kinds: tuple[str, ...]) -> Column:
        return F.exists(every, lambda s: s["kind"].isin(_numbers(kinds)))

    possible = (F.size("weak") > 0) & holds(SECRETS) & holds(IDENTIFIERS + ENDPOINTS)
    return scanned.filter(possible).select(ROW, F.explode(every).alias("s")).select(ROW, "s.*")


def links(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The interval join: pairs of a secret and an identifier or endpoint of its scope that
    are at most ``reach`` code points apart. Columns of the secret have their names, those
    of the other part begin with ``by_``.

    A secret stands in the bins it covers, the other part in those it covers when stretched;
    a pair that shares several bins is taken in the first."""
    width = F.lit(reach + 1)

    def bins(first: Column, last: Column) -> Column:
        return F.sequence(F.floor(first / width), F.floor(last / width))

    secrets = found.filter(F.col("kind").isin(_numbers(SECRETS))).withColumn(
        "bin", F.explode(bins(F.col("start"), F.col("end") - 1))
    )
    others = found.filter(F.col("kind").isin(_numbers(IDENTIFIERS + ENDPOINTS))).select(
        ROW, "scope", F.col("kind").alias("by_kind"), F.col("start").alias("by_start"), F.col("end").alias("by_end")
    )
    others = others.withColumn(
        "bin", F.explode(bins(F.greatest(F.lit(0), F.col("by_start") - reach), F.col("by_end") - 1 + reach))
    )
    near = (F.col("start") < F.col("by_end") + reach + 1) & (F.col("by_start") < F.col("end") + reach + 1)
    first = F.greatest(F.col("start"), F.greatest(F.lit(0), F.col("by_start") - reach))
    once = F.col("bin") == F.floor(first / width)
    return secrets.join(others, [ROW, "scope", "bin"]).filter(near & once).drop("bin")


def linked_weak(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak candidates that met a complementary part, each once."""
    pairs = links(found, reach)
    sides = pairs.select(ROW, "kind", "start", "end").unionByName(
        pairs.select(ROW, F.col("by_kind").alias("kind"), F.col("by_start").alias("start"), F.col("by_end").alias("end"))
    )
    return sides.filter(F.col("kind") >= len(STRONG)).distinct()


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row for each document: doc_id, counts of strong spans, their hash, all spans as
    text, and ``found``, the spans as structs (kind name, start, end)."""
    scanned = scan(docs)
    added = linked_weak(spans(scanned), reach).groupBy(ROW).agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    base = F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    every = F.sort_array(F.concat(base, F.coalesce("added", none)))
    names = F.array(*[F.lit(n) for n in NAMES])
    found = F.transform(
        every, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    rows = scanned.join(added, ROW, "left").withColumn("found", found)
    texts = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return rows.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(texts, ",").alias("spans"), "found",
    )
