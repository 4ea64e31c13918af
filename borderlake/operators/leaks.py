"""Raw personal values that reach texts they do not belong in.

A reason quotes the value that broke a rule. The contract says which columns are personal,
but people type an e-mail address into the province as well. So the texts are searched for
every raw value of every personal column: texts and values become words, and a text says a
value if the value's words follow each other in it. Both sides become runs of words, one for
each length that values have, and meet in an equi-join. Runs are distinct before they are
joined, and the rows of a frequent one are on the side of the join that adaptive execution
splits, so neither a frequent value nor a frequent reason gathers in one task.

Words that every reason of a rule has ("not found in customers") tell nothing, even where
somebody is named so; runs of the rule's own wording are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from borderlake.functions.text import cell
from borderlake.operators.contracts import pii_columns
from borderlake.operators.set_checks import union
from borderlake.sources.lake import stored

# Words end at blanks, quotes, brackets and list separators, and shed full stops.
SEPARATORS = r"[\x00-\x20'\"()\[\]{}<>,;:=|]+"
STOPS = r"^[.!?]+|[.!?]+$"

HIDDEN_KEY = r"\Arow_[0-9a-f]{32}\z"


def words(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    pieces = F.transform(F.split(F.lower(text), SEPARATORS), lambda w: F.regexp_replace(w, STOPS, ""))
    return F.filter(pieces, lambda w: w != "")


def runs(texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Distinct (text, run): every run of words whose length is one of ``sizes`` (size)."""
    longest = sizes.agg(F.max("size")).scalar()
    split = texts.select("text", words(F.col("text")).alias("_words"))
    most = split.withColumn("_most", F.least(F.size("_words"), longest)).filter("_most > 0")
    each = most.select("text", "_words", F.explode(F.sequence(F.lit(1), F.col("_most"))).alias("size"))
    wanted = each.join(sizes, "size", "left_semi")
    starts = F.sequence(F.lit(1), F.size("_words") - F.col("size") + 1)
    found = F.transform(starts, lambda at: F.array_join(F.slice("_words", at, F.col("size")), " "))
    return wanted.select("text", F.explode(F.array_distinct(found)).alias("run"))


def personal_values(tables: dict[str, DataFrame], contracts: dict[str, dict]) -> DataFrame | None:
    """Distinct raw values of all personal columns as words: value, size, dataset, column_name;
    None where no column is personal."""
    found = []
    for name, table in tables.items():
        personal = [c for c in pii_columns(contracts[name]) if c in table.columns]
        cells = [F.struct(F.lit(c).alias("column_name"), cell(c).alias("text")) for c in personal]
        if cells:
            each = table.select(F.explode(F.array(*cells)).alias("c")).select("c.column_name", words(F.col("c.text")).alias("w"))
            value = F.array_join("w", " ").alias("value")
            found.append(each.select(value, F.size("w").alias("size"), F.lit(name).alias("dataset"), "column_name"))
    return union(found).filter("size > 0").distinct() if found else None


def said_values(texts: DataFrame, values: DataFrame, fixed: DataFrame) -> DataFrame:
    """Distinct (text, value) for distinct ``texts`` that say one of the values."""
    sizes = values.select("size").distinct()
    own_words = runs(fixed.distinct(), sizes).select("run").distinct()
    said = runs(texts, sizes).join(own_words, "run", "left_anti")
    known = values.select(F.col("value").alias("run")).distinct()
    return said.join(known, "run", "left_semi").select("text", F.col("run").alias("value"))


def hidden_key(key: Column) -> Column:
    """A record key that names a person, as a digest. A key that is hidden already stays."""
    digest = F.concat(F.lit("row_"), F.substring(F.sha2(key, 256), 1, 32))
    return F.when(key.rlike(HIDDEN_KEY), key).otherwise(digest)


def leaking_texts(reasons: DataFrame, values: DataFrame, fixed: DataFrame) -> DataFrame:
    """The distinct reasons and record keys that say a personal value; stored, as they are read
    more than once and mostly few."""
    texts = reasons.select(F.explode(F.array_distinct(F.array("reason", "record_key"))).alias("text")).distinct()
    found = said_values(texts.filter("text is not null"), values, fixed)
    return stored(found.select("text").distinct(), "leaking")


def with_leaks(reasons: DataFrame, leaking: DataFrame) -> DataFrame:
    """Two more columns: whether the reason and whether the record key is among ``leaking``."""
    for column, flag in (("reason", "_reason_leaks"), ("record_key", "_key_leaks")):
        known = leaking.select(F.col("text").alias(column), F.lit(True).alias(flag))
        reasons = reasons.join(known, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return reasons


def redact(reasons: DataFrame, values: DataFrame, fixed: DataFrame) -> DataFrame:
    """Reasons that say a personal value say only that a rule failed; such record keys become
    digests. Reasons that differed in the value alone become one."""
    columns, reasons = reasons.columns, stored(reasons, "reasons")
    marked = with_leaks(reasons, leaking_texts(reasons, values, fixed))
    plain = F.concat("rule", F.lit(" check failed (value redacted: PII)"))
    return marked.withColumns(
        {
            "reason": F.when(F.col("_reason_leaks"), plain).otherwise(F.col("reason")),
            "record_key": F.when(F.col("_key_leaks"), hidden_key(F.col("record_key"))).otherwise(F.col("record_key")),
        }
    ).select(*columns).distinct()
