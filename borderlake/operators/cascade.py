"""Rejection along the references of any set of contracts.

A record whose parent is rejected cannot stay, nor can the records that refer to it. The
contracts say who refers to whom; datasets are judged parents first, so that each is joined
with the final standing of its parents and a rejection runs through any number of hops.
Datasets that refer to each other in a circle (or to themselves) are judged together:
rejections are passed on in rounds, each with the newly rejected keys only, until none is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from borderlake.operators.contracts import Check, checks, emit, foreign_keys
from borderlake.operators.judge import FITS, VERSIONS, Keep, marked_rows, no_keep, wording
from borderlake.operators.leaks import personal_values, redact
from borderlake.operators.set_checks import reference_check, union, unique_check
from borderlake.operators.skew import count_keys, sliced_join


def parent_flag(column: str) -> str:
    """Name of the flag that tells whether the parent in a column is accepted; NULL: there is none."""
    return f"_parent_of_{column}"


def parents_first(contracts: dict[str, dict]) -> list[list[str]]:
    """Datasets in groups, parents before children. A group of several refers to itself in a
    circle (Tarjan's strongly connected components, which come out in this order)."""
    refers = {name: list(dict.fromkeys(p for _, p, _ in foreign_keys(c))) for name, c in contracts.items()}
    missing = sorted({p for parents in refers.values() for p in parents} - set(contracts))
    if missing:
        raise ValueError(f"references to datasets without a contract: {', '.join(missing)}")
    index: dict[str, int] = {}
    low: dict[str, int] = {}
    open_: list[str] = []
    groups: list[list[str]] = []

    def visit(name: str) -> None:
        index[name] = low[name] = len(index)
        open_.append(name)
        for parent in refers[name]:
            if parent not in index:
                visit(parent)
                low[name] = min(low[name], low[parent])
            elif parent in open_:
                low[name] = min(low[name], index[parent])
        if low[name] == index[name]:
            at = open_.index(name)
            groups.append(sorted(open_[at:]))
            del open_[at:]

    for name in contracts:
        if name not in index:
            visit(name)
    return groups


def refers_to_itself(group: list[str], contracts: dict[str, dict]) -> bool:
    return any(parent in group for name in group for _, parent, _ in foreign_keys(contracts[name]))


def sound(contract: dict, columns: list[str]) -> Column:
    """No rule of its own is broken, and every parent judged so far is accepted."""
    parents = [F.coalesce(parent_flag(c), F.lit(False)) for c, _, _ in foreign_keys(contract) if parent_flag(c) in columns]
    whole = F.col(FITS) & (F.col(VERSIONS) == 1)
    for flag in parents:
        whole = whole & flag
    return whole


def standing(judged: DataFrame, contract: dict, key: str) -> DataFrame:
    """One row per key: are all records with it accepted?"""
    return judged.groupBy(key).agg(F.bool_and(sound(contract, judged.columns)).alias("_stands"))


def with_parent(rows: DataFrame, contract: dict, column: str, known: DataFrame) -> DataFrame:
    """Flag the parent of each row. An empty reference that may be empty refers to nobody."""
    spec = next(s for s in contract["columns"] if s["name"] == column)
    known = known.toDF(column, "_stands")
    joined = sliced_join(rows, known, column, "left", count_keys(rows, column))
    flag = F.col("_stands")
    if spec.get("nullable", True):
        flag = F.when(F.col(column) == "", F.lit(True)).otherwise(flag)
    return joined.withColumn(parent_flag(column), flag).drop("_stands")


def circle_standing(rows: dict[str, DataFrame], group: list[str], contracts: dict[str, dict], keep: Keep) -> dict[str, DataFrame]:
    """(key, stands) of datasets that refer to each other, at the fixpoint."""
    keys = {name: contracts[name]["primary_key"] for name in group}
    edges = [
        (name, column, parent) for name in group for column, parent, target in foreign_keys(contracts[name])
        if parent in group and _to_key(name, parent, target, keys)
    ]
    known = {name: standing(rows[name], contracts[name], keys[name]).toDF("key", "stands") for name in group}
    known = _kept(keep, known, "round0")
    # A reference to nobody is a rejection too, and starts one more chain.
    links = {}
    for name, column, parent in edges:
        spec = next(s for s in contracts[name]["columns"] if s["name"] == column)
        used = rows[name].select(F.col(keys[name]).alias("key"), F.col(column).alias("parent")).distinct()
        links[name, column, parent] = used.filter("parent <> ''") if spec.get("nullable", True) else used
    fresh = {name: [known[name].filter("not stands").select("key")] for name in group}
    for (name, _, parent), used in links.items():
        orphans = used.join(known[parent].select(F.col("key").alias("parent")), "parent", "left_anti").select("key")
        fresh[name].append(orphans)
    fresh = _kept(keep, {name: union(parts).distinct() for name, parts in fresh.items()}, "round1")
    rejected, turn = dict(fresh), 1
    while any(not frame.isEmpty() for frame in fresh.values()):
        turn += 1
        hit = {name: [] for name in group}
        for (name, _, parent), used in links.items():
            hit[name].append(used.join(fresh[parent].withColumnRenamed("key", "parent"), "parent", "left_semi").select("key"))
        new = {
            name: (union(parts).distinct() if parts else rejected[name].limit(0)).join(rejected[name], "key", "left_anti")
            for name, parts in hit.items()
        }
        fresh = _kept(keep, new, f"round{turn}")
        rejected = {name: rejected[name].unionByName(fresh[name]) for name in group}
    return {
        name: known[name].select("key").join(rejected[name].withColumn("_gone", F.lit(True)), "key", "left")
        .select(F.col("key").alias(keys[name]), F.col("_gone").isNull().alias("_stands"))
        for name in group
    }


def _to_key(name: str, parent: str, target: str, keys: dict[str, str]) -> bool:
    if target != keys[parent]:
        raise ValueError(f"{name} refers to {parent}.{target}; within a circle only primary keys can be referred to")
    return True


def _kept(keep: Keep, frames: dict[str, DataFrame], label: str) -> dict[str, DataFrame]:
    return dict(zip(frames, keep({f"{name}_{label}": frame for name, frame in frames.items()}).values(), strict=True))


def judge_graph(tables: dict[str, DataFrame], contracts: dict[str, dict], keep: Keep = no_keep) -> dict[str, DataFrame]:
    """Judged rows of every dataset: distinct rows with their own verdict and a flag per reference.

    ``keep`` stores the frames of a step, as in ``judge``. It must store them where contracts
    refer to each other in a circle and much is rejected, as rounds build on each other."""
    marked = marked_rows({name: tables[name] for name in contracts}, contracts, keep)
    judged: dict[str, DataFrame] = {}

    def parents_joined(name: str, group: list[str]) -> DataFrame:
        frame = marked[name]
        for column, parent, target in foreign_keys(contracts[name]):
            if parent not in group:
                frame = with_parent(frame, contracts[name], column, standing(judged[parent], contracts[parent], target))
        return frame

    for group in parents_first(contracts):
        frames = _kept(keep, {name: parents_joined(name, group) for name in group}, "judged")
        if refers_to_itself(group, contracts):
            final = circle_standing(frames, group, contracts, keep)
            for name in group:
                frame = frames[name]
                for column, parent, _ in foreign_keys(contracts[name]):
                    if parent in group:
                        frame = with_parent(frame, contracts[name], column, final[parent])
                frames[name] = frame
            frames = _kept(keep, frames, "circle")
        judged.update(frames)
    return judged


def parent_rejected(contract: dict, column: str, parent: str) -> Check:
    def reason() -> Column:
        return F.concat(F.lit(f"{parent.removesuffix('s')} "), F.col(column), F.lit(" is quarantined"))

    return Check(column, "parent_quarantined", F.coalesce(~F.col(parent_flag(column)), F.lit(False)), reason)


def graph_reasons(judged: dict[str, DataFrame], contracts: dict[str, dict]) -> DataFrame:
    """Every reason why a record of any dataset is kept out, in one narrow pass over each."""
    found = []
    for name, contract in contracts.items():
        rows = judged[name]
        compiled = [*checks(contract, rows.columns, redact=True), unique_check(contract, F.col(VERSIONS))]
        for column, parent, _ in foreign_keys(contract):
            compiled.append(reference_check(contract, column, parent, F.col(parent_flag(column)).isNull()))
            compiled.append(parent_rejected(contract, column, parent))
        found.append(emit(rows, contract, compiled, ~sound(contract, rows.columns)))
    return union(found)


def graph_quarantine(judged: dict[str, DataFrame], contracts: dict[str, dict]) -> DataFrame:
    """The reasons without any personal value."""
    found = graph_reasons(judged, contracts)
    values = personal_values(judged, contracts)
    return found if values is None else redact(found, values, wording(found.sparkSession, contracts))


def fit_rows(judged: dict[str, DataFrame], contracts: dict[str, dict]) -> dict[str, DataFrame]:
    """The records of every dataset that stay; references among them are whole."""
    fit = {}
    for name, contract in contracts.items():
        named = [spec["name"] for spec in contract["columns"] if spec["name"] in judged[name].columns]
        flags = {FITS, VERSIONS, *(parent_flag(c) for c, _, _ in foreign_keys(contract))}
        payload = named + [c for c in judged[name].columns if c not in {*named, *flags}]
        fit[name] = judged[name].filter(sound(contract, judged[name].columns)).select(*payload)
    return fit
