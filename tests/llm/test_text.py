"""Decontamination, pieces, archives, page text and the pipeline."""

import hashlib
import html as html_module
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from awkward import CLASHES, PASSAGE, SENTENCE, pairs

import corpus_pipeline
from borderlake.llm import sentencepiece_lattice as sp
from borderlake.llm import warc
from borderlake.llm.decontaminate import drop_contaminated, find_items
from borderlake.llm.html_extract import article_text, blocks, html_extract


# Decontamination


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def contained(docs, items):
    out = []
    for (doc, text), (item, wanted) in itertools.product(docs, items):
        need = words(wanted)
        width = min(5, len(need))
        have = words(text)
        if width:
            shingles = {tuple(need[i : i + width]) for i in range(len(need) - width + 1)}
            shared = shingles & {tuple(have[i : i + width]) for i in range(len(have) - width + 1)}
            if 5 * len(shared) >= 4 * len(shingles):
                out.append((doc, item, len(shared), len(shingles)))
    return Counter(out)


@pytest.fixture(scope="module")
def items(stored_table):
    half = " ".join(SENTENCE.split()[:9])
    rows = [(0, SENTENCE), (1, None), (2, " .. "), (3, "Brown, fox!"), (4, "owls"), (5, half + " and other words that are not in there"), (6, PASSAGE)]
    rows += [(7, SENTENCE + " extra"), (8, SENTENCE + " two or more extra words which is just too many of them"), (6, PASSAGE), (None, SENTENCE)]
    return stored_table(rows, "item_id long, text string")


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_find_items(table, items, request):
    docs = request.getfixturevalue(table)
    found = find_items(docs, items).collect()
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    expected = contained(pairs(docs), listed)
    assert Counter((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in found) == expected
    assert all(r["containment"] == r["n_shared"] / r["n_item"] for r in found)


def test_no_items(odd, items):
    assert find_items(odd, items.limit(0)).count() == 0
    assert drop_contaminated(odd, items.limit(0)).count() == odd.count()


def test_drop_contaminated(odd, items):
    kept = drop_contaminated(odd, items)
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    assert kept.columns == odd.columns
    assert Counter(pairs(kept)) == Counter(row for row in pairs(odd) if not contained([row], listed))


# Pieces


@pytest.fixture(scope="module")
def lexicon():
    return sp.load(sp.MODEL)


def all_paths(lexicon, text):
    """Scores and ids of every segmentation."""
    text = " " + text
    coded = text.replace("▁", "￿").replace(" ", "▁")
    out = []

    def walk(at, score, ids):
        if at == len(text):
            out.append((score, ids))
        for end in range(at + 1, len(text) + 1):
            if coded[at:end] in lexicon.pieces:
                piece, own = lexicon.pieces[coded[at:end]]
                walk(end, score + own, [*ids, piece])
            elif end == at + 1:
                walk(end, score + lexicon.unknown, [*ids, *(lexicon.byte_ids[b] for b in text[at].encode())])

    walk(0, 0.0, [])
    return sorted(out, key=lambda path: -path[0])


def applied(ids, changes):
    ids = list(ids)
    for change in sorted(changes, key=lambda change: -change["at"]):
        ids[change["at"] : change["at"] + change["length"]] = change["ids"]
    return ids


@pytest.mark.parametrize("long", [sp.LONG, 2])
@pytest.mark.parametrize("seed", range(4))
def test_nbest_is_exact(lexicon, seed, long, monkeypatch):
    monkeypatch.setattr(sp, "LONG", long)
    monkeypatch.setattr(sp, "WINDOW", 3 if long == 2 else sp.WINDOW)
    rng = random.Random(seed)
    encoder = sp.Encoder(lexicon, 5)
    for _ in range(25):
        text = "".join(rng.choice("abtionhe  \né▁漢🎉") for _ in range(rng.randint(1, 11)))
        ((ids, score, others),) = encoder.encode([text])
        every = all_paths(lexicon, text)
        assert [score, *(other["score"] for other in others)] == [s for s, _ in every[:5]]
        paths = [ids.tolist(), *(applied(ids, other["changes"]) for other in others)]
        assert len({tuple(path) for path in paths}) == len(paths)
        for path, (total, _) in zip(paths, every, strict=False):
            assert (total, path) in every
            assert sp.decode_ids(lexicon, np.array(path)).decode() == text


def test_long_units_equal_the_lattice_of_whole_units(lexicon):
    rng = random.Random(1)
    for letters in ("aehinrst", "漢字一二三的", "ab", "="):
        unit = "".join(rng.choice(letters) for _ in range(500))
        (score,), (gap,), _, ids = sp.best_paths(lexicon, [unit])
        along = sp.best_path_along(lexicon, unit)
        assert (along[0], along[1], along[2]) == (score, gap, ids.tolist())
        parts = sp.links(lexicon, unit)
        assert "".join(parts) == unit
        assert sum(sp.best_paths(lexicon, [part])[0][0] for part in parts) == score


@pytest.mark.parametrize("letters", ["漢字一二三的是不了人", "abcdefghijklmnopqrstuvwxyz", "a", " "])
def test_very_long_units(lexicon, letters):
    """The model has no piece of two of these ideographs, so a text of them has one path only."""
    rng = random.Random(2)
    text = "".join(rng.choice(letters) for _ in range(200_000))
    begun = time.monotonic()
    ((ids, score, others),) = sp.Encoder(lexicon, 4).encode([text])
    assert time.monotonic() - begun < 30
    assert sp.decode_ids(lexicon, ids).decode() == text
    ranks = [score, *(other["score"] for other in others)]
    assert len(others) == (0 if letters[0] == "漢" else 3) and ranks == sorted(ranks, reverse=True)
    assert all(sp.decode_ids(lexicon, np.array(applied(ids, other["changes"]))).decode() == text for other in others)


def test_encoder_forgets_and_repeats(lexicon, monkeypatch):
    monkeypatch.setattr(sp, "HELD_UNITS", 3)
    encoder = sp.Encoder(lexicon, 3)
    texts = ["one two three four", "five six", "one six", None, ""]
    first = [(ids.tolist(), score, others) for ids, score, others in encoder.encode(texts)]
    assert [(ids.tolist(), score, others) for ids, score, others in encoder.encode(texts)] == first
    assert first[3] == first[4] == ([], 0.0, [])


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_round_trip(table, request):
    docs = request.getfixturevalue(table)
    found = Counter((r["doc_id"], r["decoded_sha256"]) for r in sp.round_trip(docs).collect())
    assert found == Counter((i, hashlib.sha256((text or "").encode()).hexdigest()) for i, text in pairs(docs))


# Archives

PAGES = [
    (0, "http://www.Example.com/a?b=1#top", "<p>" + "same " * 40),
    (1, "https://user@example.com:8080", "<p>" + "same " * 40),
    (2, None, "short"),
    (3, "http://www.example.com/a?b=1", "short"),
    (4, "", None),
    (5, "no host", "é" * 70),
    (5, "no host", "é" * 70),
    (None, "http://z.example.org/\r\nX: y", "é" * 70),
    (None, None, None),
    (9, "http://www.example.com/a?b=1", "<p>\r\n\r\n" + "long " * 100_000),
]


@pytest.fixture(scope="module")
def pages(stored_table):
    return stored_table(PAGES, "page_id long, url string, html string")


def test_archive_round_trip(pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 2)
    found = warc.archive_round_trip(pages).collect()
    payloads = [((html or "").encode(), i) for i, _, html in PAGES]
    first = {}
    for data, i in payloads:
        if len(data) >= warc.MIN_BYTES:
            first[data] = min((x for x in (first.get(data), i) if x is not None), default=None)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in found) == Counter(
        (i, len(data), hashlib.sha256(data).hexdigest()) for data, i in payloads
    )
    assert all(r["verified"] for r in found)
    large = Counter(data for data, _ in payloads if data in first)
    digest = {hashlib.sha256(data).hexdigest(): data for data in first}
    for kind, expected in (("response", lambda n: 1), ("revisit", lambda n: n - 1)):
        rows = [r for r in found if r["payload_digest"] in digest and r["record_type"] == kind]
        assert Counter(digest[r["payload_digest"]] for r in rows) == Counter({d: expected(n) for d, n in large.items() if expected(n)})
        for r in rows:
            holder = first[digest[r["payload_digest"]]]
            assert r["refers_to"] == (holder if kind == "revisit" else None)
            assert kind == "revisit" or (r["page_id"] == holder and bytes(r["payload"]) == digest[r["payload_digest"]])


def test_lookup_reads_only_blocks_of_the_key(pages, spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 2)
    found = warc.write_archives(pages)
    parts = warc.build_index(found)
    key = warc.url_key("http://www.example.com/a?b=1")
    got = warc.lookup(parts, spark.createDataFrame([(key,), (key,), ("none",)], "key string"))
    assert sorted((r["page_id"] for r in got.collect())) == [0, 3, 9]
    assert parts.selectExpr("sum(captures)").first()[0] == len(PAGES)


def test_empty_archives(pages):
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/A?b#c") == "com,example,www:80)/A?b"
    assert warc.url_key("https://u:p@example.org") == "org,example)/"
    assert warc.url_key(None) == warc.url_key("") == ""


# Page text


def plain_article(page):
    """The article of the pages in the test tables, by their one template."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    texts = [" ".join(html_module.unescape(part).split()) for part in parts]
    return "\n".join(text for text in texts if text)


def test_html_extract_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r["page_id"]: r for r in html_extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for row in rows:
        text = plain_article(row["html"])
        assert (found[row["page_id"]]["text"], found[row["page_id"]]["n_chars"]) == (text, len(text))


def test_blocks():
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><nav><a href='/'>x</a></nav>"
        "<div class='cookie-notice'>We use <b>cookies</b></div><main><header><h1>T &amp; u</h1></header>"
        "<p>one<br>two &nbsp; x<p>three <a href=x>link</a>ed<!-- no --><aside>no</aside><form><input>no</form>"
        "<ul><li>a<li>b</ul><section id=comments><article>no</article></section></main>"
        "<script>if (a<b) no()</script><style>no</style><footer>no</footer><p unfinished"
    )
    assert article_text(blocks(page)).split("\n") == ["T & u", "one two x", "three linked", "a", "b"]
    assert article_text(blocks("<article>1 < 2 &lt;b&gt; <p>&copy 3</article>")) == "1 < 2 <b>\n© 3"
    assert blocks("") == []


def test_names_that_only_hold_a_word_of_furniture():
    page = (
        "<article><h2 class='side-effects'>Side effects</h2><p id='share-prices'>Prices</p><p class='notice-period lead'>Period</p>"
        "<div class='share-buttons'>no</div><div class='lead ad'>no</div><div id='related_links'>no</div><p class='menu-'>no</p></article>"
    )
    assert article_text(blocks(page)).split("\n") == ["Side effects", "Prices", "Period"]


def test_pages_without_article_keep_unique_runs(stored_table):
    menu = "Home News Sports Weather Contact About Imprint Privacy Terms Help"
    rows = [(i, f"http://a.example.com/{i}", f"<body><div>{menu}</div><p>Unique{i} words{i} of{i} this{i} page{i}</p><div>{menu} again</div>") for i in range(4)]
    rows += [(10, "http://b.example.com/1", f"<div>{menu}</div><p>own</p>"), (11, None, None), (12, "", "  "), (None, "x", "<article>text</article>")]
    rows += [(13, "http://c.example.com/1", "<p>copied page with a number of words in one block"), (14, "http://c.example.com/2", "<p>copied page with a number of words in one block")]
    pages = stored_table(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract(pages).collect()}
    assert found[1] == "Unique1 words1 of1 this1 page1"
    assert found[10] == menu + "\nown"
    assert found[11] == found[12] == "" and found[None] == "text"
    assert found[13] == found[14] == "copied page with a number of words in one block"


def test_empty_pages(pages):
    assert html_extract(pages.limit(0)).count() == 0


# The pipeline


def test_pipeline_stages(odd, tmp_path, spark):
    folder = "/root/testdata/sf0.001"
    docs = odd
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.count() <= docs.count()
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == odd.columns and set(CLASHES) <= set(after.columns)
        docs = after
    assert {"doc_id", "ids", "score"} <= set(docs.columns)


def test_pipeline_of_nothing(empty, tmp_path, spark):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0
