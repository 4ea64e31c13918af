"""Exact, near, line and suffix dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from awkward import LONG, PASSAGE, pairs

from borderlake.llm import line_dedup as lines_module
from borderlake.llm import simhash as simhash_module
from borderlake.llm import suffix_dedup as suffix_module
from borderlake.llm.common import ROW
from borderlake.llm.components import components
from borderlake.llm.exact_dedup import drop_copies, exact_dedup
from borderlake.llm.line_dedup import line_dedup
from borderlake.llm.simhash import drop_near_copies, fingerprint, simhash_groups
from borderlake.llm.suffix_dedup import suffix_dedup



def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def exact_expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        out += [(i, first, len(ids), sha(text)) for i in ids]
    return Counter(out), len(groups)


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_exact_dedup(table, request):
    docs = request.getfixturevalue(table)
    found = exact_dedup(docs).collect()
    expected, groups = exact_expected(pairs(docs))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    kept = [r for r in found if r["kept"]]
    assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len({r[ROW] for r in found}) == len(found)


def test_exact_dedup_keeps_columns(odd):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == exact_expected(pairs(odd))[1]


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_expected(rows):
    prints = [(i, fingerprint((text or "").encode())) for i, text in rows]
    root = {fp: fp for _, fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = list(root)
    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    smallest = defaultdict(list)
    for i, fp in prints:
        smallest[find(fp)].append(i)
    firsts = {fp: min((i for i in ids if i is not None), default=None) for fp, ids in smallest.items()}
    return Counter((i, f"{fp:016x}", firsts[find(fp)]) for i, fp in prints), len(firsts)


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_simhash(table, request):
    docs = request.getfixturevalue(table)
    found = simhash_groups(docs).collect()
    expected, groups = near_expected(pairs(docs))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == groups
    assert drop_near_copies(docs).columns == docs.columns


def test_fingerprint_from_definition(odd):
    for _, text in pairs(odd):
        if len(text or "") < 10_000:
            assert fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(3))
def test_simhash_links_find_every_component(spark, seed):
    """Chains and clusters at distances 1 to 4, all parities and halves."""
    import random

    rng, prints = random.Random(seed), set()
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(at)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                at ^= 1 << bit
    prints |= {0, 2**64 - 1, 2**63}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = simhash_module.links(spark.createDataFrame(signed, "fp long"))
    found = {r["node"] % 2**64: r["root"] % 2**64 for r in components(links).collect()}
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    listed = list(prints)
    for n, a in enumerate(listed):
        for b in listed[:n]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    groups, expected = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[found.get(p, p)].add(p)
        expected[find(p)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 260)]
    star = [(1000, i) for i in range(1001, 1300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()}
    assert len({found[i] for i in range(100, 261)}) == 1
    assert len({found[i] for i in range(1000, 1300)}) == 1
    assert found[100] != found[1000] and 5 not in found


def line_expected(rows, min_chars, min_docs):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

    def key(line):
        return line.encode().strip(b" \t\n\x0b\x0c\r").translate(lower).decode()

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if i is None or len(holders[key(x)]) < min_docs or len(key(x)) < min_chars or max(holders[key(x)]) == i]
        out.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("table, docs_needed, batches", [("odd", 3, 4), ("odd", 5, 1), ("odd", 2, 9), ("small", 5, 4), ("empty", 5, 4)])
def test_line_dedup(table, docs_needed, batches, request):
    docs = request.getfixturevalue(table)
    found = line_dedup(docs, min_docs=docs_needed, batches=batches).collect()
    expected = line_expected(pairs(docs), lines_module.MIN_CHARS, docs_needed)
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found) == expected


def suffix_expected(rows, k=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for at in range(len(data) - k + 1):
                string = data[at : at + k]
                first[string] = min(first.get(string, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - k + 1):
            if i is not None and first[data[at : at + k]] < i:
                gone[at : at + k] = b"\x01" * k
        kept = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(data), len(data) - len(kept), runs, sha(kept)))
    return Counter(out)


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_suffix_dedup(table, request):
    docs = request.getfixturevalue(table)
    found = suffix_dedup(docs).collect()
    counted = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert counted == suffix_expected(pairs(docs))


def test_suffix_dedup_of_frequent_samples_and_pieces(stored_table, monkeypatch):
    """Many different contexts of one passage, and texts longer than a piece."""
    rows = [(i, f"{i * 7919 % 1000} own words {i}{PASSAGE}{i * 31 % 977} own end {i}") for i in range(192)]
    rows += [(1000, LONG * 2), (1001, "before " + LONG), (1002, LONG[40_000:700_000] + "after")]
    docs = stored_table(rows, "doc_id long, text string")
    found = suffix_dedup(docs).collect()
    counted = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert counted == suffix_expected(rows)


@pytest.mark.parametrize("contexts", [1, 128])
def test_suffix_dedup_of_runs_repeated_in_their_smallest_document(stored_table, contexts):
    """Each of several equal runs, also in rows of one id, loses what smaller documents have."""
    rows = [(n, f"{n * 7919 % 1000} alpha start {n}{PASSAGE}{n * 31 % 977} other tail") for n in range(contexts)]
    rows += [(1000, "\n".join([PASSAGE] * 4)), (1001, f"x\n{PASSAGE}\ny\n{PASSAGE}\ny\n{PASSAGE}\nz"), (1001, f"y\n{PASSAGE}\ny")]
    found = suffix_dedup(stored_table(rows, "doc_id long, text string")).collect()
    counted = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert counted == suffix_expected(rows)


def test_suffix_dedup_finds_as_many_spans_a_document_for_any_number_of_contexts(stored_table, monkeypatch):
    """One passage in n surroundings gives about two spans a document, however many there are."""
    tables, store, shares = {}, suffix_module.stored, []
    monkeypatch.setattr(suffix_module, "stored", lambda df, label: tables.setdefault((len(shares), label), store(df, label)))
    for n in (60, 100, 800):
        rows = [(i, f"{i * 7919 % 1000} own words {i}{PASSAGE}{i * 31 % 977} own end {i}") for i in range(n)]
        assert suffix_dedup(stored_table(rows, "doc_id long, text string")).count() == n
        shares.append(tables[len(shares), "open-spans"].count() / n)
    assert max(shares) < 3


def test_suffix_dedup_of_repeated_lines_in_larger_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = suffix_dedup(docs).collect()
    counted = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert counted == suffix_expected(pairs(docs))


def test_suffix_dedup_joins_equal_runs_once(stored_table, monkeypatch):
    """Runs equal to one before them, in a later document or the same, are found once and stored; both uses read that."""
    passage = f"{PASSAGE} {PASSAGE[::-1]} {PASSAGE.upper()}"
    rows = [(i, f"{'abcdefghijkl'[i] * 60}{passage}{'ABCDEFGHIJKL'[i] * 60}{passage}{i}") for i in range(12)]
    tables, store = {}, suffix_module.stored
    monkeypatch.setattr(suffix_module, "stored", lambda df, label: tables.setdefault(label, store(df, label)))
    found = suffix_dedup(stored_table(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], bytes(r["kept"])) for r in found) == Counter((i, kept) for i, kept in expected_kept(rows))
    runs = tables["equal-runs"]
    assert {"later", "of_row", "of_first"} <= set(runs.columns) and runs.count() == runs.distinct().count() > 0
    assert "run-twins" not in tables


def expected_kept(rows, k=50):
    first = {}
    for i, text in rows:
        data = text.encode()
        for at in range(len(data) - k + 1):
            first[data[at : at + k]] = min(first.get(data[at : at + k], i), i)
    for i, text in rows:
        data = text.encode()
        gone = {at + j for at in range(len(data) - k + 1) if first[data[at : at + k]] < i for j in range(k)}
        yield i, bytes(byte for at, byte in enumerate(data) if at not in gone)


def test_wanted_samples():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    some = np.append(values[::7], values[::14])
    places = suffix_module.Wanted(some.view(np.int64)).places(values)
    assert places.tolist() == list(range(0, 5000, 7))
