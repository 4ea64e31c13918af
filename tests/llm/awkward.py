"""Rows with every awkward value, and names that operators use inside."""

SENTENCE = "the quick brown fox jumps over the lazy dog while nine grey owls watch from the old barn"
PASSAGE = "a passage of more than fifty bytes that several documents share word for word"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))

TEXTS = [
    (0, SENTENCE),
    (1, "  " + SENTENCE.replace(" ", "\t ") + "\n"),
    (2, None),
    (3, ""),
    (4, " \n\t \x0b\x0c\r "),
    (5, f"intro one {PASSAGE} end one\n{SENTENCE.upper()}"),
    (6, f"other start {PASSAGE} different end\n{SENTENCE}\n\n{SENTENCE}"),
    (7, f"{PASSAGE}\n{SENTENCE}\nAnd more."),
    (8, f"{PASSAGE} {PASSAGE}\n  {SENTENCE}  "),
    (9, LONG),
    (10, LONG + " tail"),
    (11, "été à la plage ▁ 漢字 🎉   ﬁn\u0000x"),
    (12, "12345 67890 !!! ???"),
    (13, SENTENCE),
    (13, SENTENCE),  # a repeated row
    (14, "One line only"),
    (14, "the same id with another text"),
    (None, SENTENCE),
    (None, None),
    (15, PASSAGE[:49]),
    (16, "x " * 3000),
    (20, SENTENCE.replace("nine", "ten")),
    (-3, f"negative id {PASSAGE}"),
]
#: Names that operators use inside.
CLASHES = ["sha", "first", "hash", "words", "ids", "key", "sample", "node", "fp", "item_id", "score", "kept", "line"]


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
