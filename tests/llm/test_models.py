"""Language ID and LM scoring: accuracy on held-out rows, brute force, awkward rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from awkward import pairs
from pyspark.sql import functions as F

from borderlake.llm import lm_score as lm
from borderlake.llm.common import ROW
from borderlake.llm.language_id import fit, grams, keep_language, language_id, presence, scores
from borderlake.llm.lm_score import lm_score, words_of


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    total, right = found.count(), found.filter("lang = lang_pred").count()
    assert total > 200 and right / total > 0.98
    assert found.filter("score < 0 or score > 1").isEmpty()


@pytest.mark.parametrize("languages", [160, 300])
def test_language_id_learns_every_language(languages, stored_table):
    """Invented languages of 30 words each: each is predicted, however many there are."""
    rng = random.Random(languages)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 8))) for _ in range(30)] for _ in range(languages)]
    rows = [(i, " ".join(rng.choices(words[i % languages], k=25)), f"l{i % languages:03}") for i in range(languages * 24)]
    docs = stored_table(rows, "doc_id long, text string, lang string")
    found = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = {r["lang"]: r["right"] for r in found.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right")).collect()}
    assert len(right) > 0.95 * languages
    assert sum(right.values()) / len(right) >= 0.95
    assert min(right.values()) > 0


def test_language_id_does_not_see_the_label(spark, small):
    """Labels of held-out rows, and sources, change nothing."""
    from borderlake.llm.language_id import held_out

    other = small.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    first = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id(small).collect()}
    second = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id(other).collect()}
    assert first == second


def test_language_id_of_awkward_rows(odd, empty):
    found = {(r["doc_id"], r[ROW]): r for r in language_id(odd).collect()}
    assert len(found) == odd.count()
    texts = dict(pairs(odd))
    for (i, _), row in found.items():
        if i is not None and i not in (13, 14) and not any(map(str.isalpha, texts[i] or "")):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        assert 0 <= row["score"] <= 1
    assert not any(r["held_out"] for (i, _), r in found.items() if i is None)
    assert language_id(empty).count() == 0
    assert keep_language(odd, 0.0).columns == odd.columns


def test_pipeline_drops_texts_in_no_learned_language(spark, stored_table):
    """Planted texts of an unlearned language and of random letters go; clean ones stay, short ones too."""
    import random

    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    rng = random.Random(3)
    foreign = [(r["doc_id"], r["text"], None) for r in docs if r["lang"] == "de" and len(r["text"]) > 300]
    learned = [tuple(r) for r in docs if r["lang"] != "de"]
    noise = [(10**6 + n, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(20)), None) for n in range(50)]
    short = [(2 * 10**6 + r[0], " ".join(r[1].split()[:4]), None) for r in learned[:200]]
    table = stored_table(learned + foreign + noise + short, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, table, "").collect()}

    def part(rows):
        return sum(r[0] in kept for r in rows) / len(rows)

    assert part(noise) == 0 and part(foreign) < 0.02
    assert part(learned) > 0.99 and part(short) > 0.97


def test_without_labels_everything_is_unknown(odd):
    found = language_id(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in found.collect()} == {("und", 0.0)}


def test_kernel_is_that_of_shared_grams():
    a, b = "Ab cab", "cab, the bac"
    plain = [{x[i : i + n] for n in (1, 2, 3) for i in range(len(x) - n + 1)} - {" "} for x in (" ab cab ", " cab the bac ")]
    _, codes = grams([a])
    columns = np.full(1 << 21, 1 << 12, np.int32)
    both = sorted(set(grams([a, b])[1].tolist()))
    columns[both] = np.arange(len(both))
    owner, gram = grams([a, b])
    rows = presence(owner, gram, 2, np.where(columns < len(both), columns, len(both)), len(both))
    assert len(set(codes.tolist())) == len(plain[0])
    expected = len(plain[0] & plain[1]) / math.sqrt(len(plain[0]) * len(plain[1]))
    assert rows[0] @ rows[1] == pytest.approx(expected, abs=1e-6)


def test_equal_scores_go_to_the_first_language():
    text = np.unique(grams(["same text"])[1]).astype(np.int32)
    model = fit([("b", text), ("a", text)])
    assert scores(model, ["same text"])[0] == ["a"]


def plain_losses(rows, target, vocabulary):
    """The definition, with exact pairs in place of bins."""
    known = {word: i + 1 for i, word in enumerate(vocabulary)}
    tokens = [[known.get(w, 0) for w in words_of((text or "").encode())] for _, text in rows]
    sides = [int(i is not None and i in target) for i, _ in rows]
    out = []
    for n, own in enumerate(tokens):
        losses = []
        for side in (1, 0):
            words, pairs_of = Counter(), Counter()
            for m, other in enumerate(tokens):
                if sides[m] == side and m != n:
                    words.update(other)
                    pairs_of.update(zip([0, *other], other, strict=False))
            total = sum(words.values())
            loss = 0.0
            for before, word in zip([0, *own], own, strict=False):
                plain = (words[word] + 1) / (total + lm.VOCABULARY)
                seen = min(pairs_of[before, word], words[before])
                loss -= math.log((seen + lm.PRIOR * plain) / (words[before] + lm.PRIOR))
            losses.append(loss / len(own) if own else None)
        out.append((rows[n][0], sides[n] == 1, len(own), *losses))
    return out


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_lm_score(table, spark, request):
    docs = request.getfixturevalue(table)
    docs = docs.filter("doc_id is null or doc_id not in (9, 10)")  # the long ones are slow by definition
    target = {5, 6, 13, 99}
    found = lm_score(docs, spark.createDataFrame([(i,) for i in [*target, 5, None]], "doc_id long")).collect()
    rows = pairs(docs)
    expected = plain_losses(rows, target, lm.vocabulary(docs)) if rows else []

    def rounded(values):
        return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in values)

    got = [(r["doc_id"], r["is_target"], r["n_tokens"], r["loss_target"], r["loss_background"]) for r in found]
    assert rounded(got) == rounded(expected)
    for row in found:
        assert (row["score"] is None) == (row["n_tokens"] == 0)


def test_lm_score_counts_every_word_and_pair(stored_table, spark, monkeypatch):
    """More words than any bound there was, in many lots, against exact pairs."""
    rng = np.random.default_rng(7)
    rows = [(n, " ".join(f"w{i}" for i in np.minimum(rng.zipf(1.2, 500), 10**6) * 50 + rng.integers(0, 50, 500))) for n in range(60)]
    rows[7:9] = [(7, ""), (8, rows[6][1])]
    vocabulary = sorted({word for _, text in rows for word in words_of(text.encode())})
    assert len(vocabulary) > lm.VOCABULARY
    target = set(range(0, 60, 4))
    docs = stored_table(rows, "doc_id long, text string")
    found = lm_score(docs, spark.createDataFrame([(i,) for i in target], "doc_id long"), lot=3000).collect()
    monkeypatch.setattr(lm, "VOCABULARY", len(vocabulary) + 1)
    expected = {row[0]: row for row in plain_losses(rows, target, vocabulary)}
    assert len(found) == len(rows)
    for row in found:
        got = (row["doc_id"], row["is_target"], row["n_tokens"], row["loss_target"], row["loss_background"])
        assert got == pytest.approx(expected[row["doc_id"]], abs=1e-9)


def test_vocabulary_counts_every_word(small):
    counted = Counter(word for _, text in pairs(small) for word in words_of((text or "").encode()))
    top = sorted(counted, key=lambda word: (-counted[word], word))[:99]
    assert lm.vocabulary(small, 100) == top


def test_lm_score_separates_good_from_bad(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = lm_score(spark.read.parquet(f"{folder}/documents.parquet"), labels.filter("quality = 1"))
    mean = {r["quality"]: r["m"] for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert mean[1] < mean[0]
