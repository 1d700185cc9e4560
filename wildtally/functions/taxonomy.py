"""Labels and lineages as column expressions.

A label is `<id>;<class>;<order>;<family>;<genus>;<species>;<common>` or a bare common name. A lineage is the taxonomy
from class down to some level, joined by semicolons; the empty lineage is unresolved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
LEVELS = ("class", "order", "family", "genus", "species")
UNRESOLVED = "animal (unresolved)"

_SPACE = r"^\s+|\s+$"
#: White space and what may end a line: a text without any of these at both ends is stripped already.
_EDGES = " \t\n\v\f\r\u0085\u2028\u2029"


def _levels() -> Column:
    return F.array(*map(F.lit, LEVELS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once for each row, however often it is named; inside lambdas Spark shares nothing itself."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.when(text == F.btrim(text, F.lit(_EDGES)), text).otherwise(F.regexp_replace(text, _SPACE, ""))


def taxonomy_fields(label: Column) -> Column:
    """The five taxonomy fields, lower-cased and stripped; empty texts for a bare name."""
    taxa = lambda parts: F.transform(F.slice(parts, 2, 5), lambda x: F.lower(stripped(x)))
    return bound(F.split(label, ";"), lambda parts: F.when(F.size(parts) >= 7, taxa(parts)).otherwise(F.array(*[F.lit("")] * 5)))


def depth_of(fields: Column) -> Column:
    """How many fields from the first on are not empty."""
    at = F.array_position(fields, F.lit(""))
    return F.when(at == 0, F.size(fields)).otherwise(at - 1).cast("int")


def lineage_of(fields: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.array_join(F.slice(fields, F.lit(1), depth), ";")


def common_name(label: Column) -> Column:
    """The label's common name, else its deepest named taxon, else the bare name; lower-cased."""
    parts = F.split(label, ";")
    named = F.filter(taxonomy_fields(label), lambda x: x != "")
    common = F.lower(stripped(F.get(parts, F.lit(6))))
    full = F.coalesce(F.nullif(common, F.lit("")), F.try_element_at(named, F.lit(-1)), F.lit(""))
    return F.when(F.size(parts) >= 7, full).otherwise(F.lower(stripped(label)))


def is_ancestor(lineage: Column, other: Column) -> Column:
    """Whether `lineage` is a strict ancestor of `other`; the empty one is of all others."""
    return ((lineage == "") & (other != "")) | F.startswith(other, F.concat(lineage, F.lit(";")))


def lineage_depth(lineage: Column) -> Column:
    return F.when(lineage == "", 0).otherwise(F.size(F.split(lineage, ";")))


def label_for_lineage(lineage: Column) -> Column:
    """`<taxon> (<level>)`, or the unresolved label."""
    parts = F.split(lineage, ";")
    name = F.concat(F.element_at(parts, -1), F.lit(" ("), F.try_element_at(_levels(), F.size(parts)), F.lit(")"))
    return F.when(lineage == "", F.lit(UNRESOLVED)).otherwise(name)


def common_lineage(lineages: Column) -> Column:
    """The longest lineage that all of an array share; empty if there is none."""
    split = F.transform(lineages, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ";")))
    first = F.coalesce(F.get(split, F.lit(0)), F.array().cast("array<string>"))
    shared = F.lit(0)
    for d in range(1, 6):  # a longer prefix is shared only if the shorter one is
        prefix = F.slice(first, 1, d)
        shared = F.when(F.forall(split, lambda s: F.slice(s, 1, d) == prefix) & (F.size(first) >= d), F.lit(d)).otherwise(shared)  # noqa: B023
    return F.array_join(F.slice(first, F.lit(1), shared), ";")


def scored_labels(classes: Column, scores: Column) -> Column:
    """array<struct<fields, depth, name, score>> of parallel arrays, cut to the shorter one."""
    n = F.least(F.size(classes), F.size(scores))
    pairs = F.arrays_zip(F.slice(classes, F.lit(1), F.greatest(n, F.lit(0))).alias("c"), F.slice(scores, F.lit(1), F.greatest(n, F.lit(0))).alias("s"))
    return F.transform(
        pairs,
        lambda p: bound(taxonomy_fields(p["c"]), lambda f: F.struct(
            f.alias("fields"), depth_of(f).alias("depth"), common_name(p["c"]).alias("name"), p["s"].cast("double").alias("score"),
        )),
    )


def _best_at(labels: Column) -> Column:
    """struct<minus, lineage> of the group with the largest summed score at a depth, ties by smallest lineage; `labels` has lineage, score of those so deep."""
    total = lambda key: F.aggregate(labels, F.lit(0.0), lambda a, x: F.when(x["lineage"] == key, a + x["score"]).otherwise(a))
    keys = F.array_distinct(F.transform(labels, lambda x: x["lineage"]))
    return F.array_min(F.transform(keys, lambda k: F.struct((-total(k)).alias("minus"), k.alias("lineage"))))


def _at_depth(labels: Column, depth: int) -> Column:
    deep = F.filter(labels, lambda x: x["depth"] >= depth)
    return F.transform(deep, lambda x: F.struct(lineage_of(x["fields"], depth).alias("lineage"), x["score"].alias("score")))


def roll_up(labels: Column, threshold: float) -> Column:
    """struct<species, score, level, lineage> for an array from scored_labels.

    The top label stands if its score reaches the threshold (as unresolved if it isn't a taxon). Else scores are summed
    by genus, family, order and class, and the first group to reach it stands. Else the box is unresolved, with the top
    label's score (0 without labels).
    """
    call = lambda species, score, level, lineage: F.struct(species.alias("species"), score.alias("score"), level.alias("level"), lineage.alias("lineage"))
    top = F.get(labels, F.lit(0))
    none = call(F.lit(UNRESOLVED), F.coalesce(top["score"], F.lit(0.0)), F.lit("unresolved"), F.lit(""))
    taxon = call(top["name"], top["score"], F.try_element_at(_levels(), F.greatest(top["depth"], F.lit(1))), lineage_of(top["fields"], top["depth"]))
    result = F.when(top.isNull(), none).when((top["score"] >= threshold) & (top["depth"] == 0), none).when(top["score"] >= threshold, taxon)

    def summed(depth: int) -> Column:
        if not depth:
            return none
        found = lambda best: call(label_for_lineage(best["lineage"]), -best["minus"], F.lit(LEVELS[depth - 1]), best["lineage"])
        tried = lambda best: F.when(-best["minus"] >= threshold, found(best)).otherwise(summed(depth - 1))
        return bound(_at_depth(labels, depth), lambda deep: bound(_best_at(deep), tried))

    return result.otherwise(summed(4))


def folded(labels: Column) -> Column:
    """array<struct<species, to_species, to_lineage>> for an array of distinct labels struct<species, lineage>.

    A label goes to the one leaf below it if there is exactly one, else it stays. A leaf has no strict descendant.
    """
    leaves = F.filter(labels, lambda x: ~F.exists(labels, lambda y: is_ancestor(x["lineage"], y["lineage"])))

    def target(x: Column) -> Column:
        below = F.filter(leaves, lambda leaf: is_ancestor(x["lineage"], leaf["lineage"]))
        to = F.when(F.size(below) == 1, F.get(below, F.lit(0))).otherwise(x)
        return F.struct(x["species"].alias("species"), to["species"].alias("to_species"), to["lineage"].alias("to_lineage"))

    return F.transform(labels, target)


def reconciled(labels: Column, single_animal: Column) -> Column:
    """As folded(); where one animal at most was in view and labels still differ, all go to their common taxon.

    That taxon takes the name of the first label that has its lineage, else a name made from it.
    """
    fold = folded(labels)
    differ = F.size(F.array_distinct(F.transform(fold, lambda m: m["to_species"]))) > 1
    shared = common_lineage(F.transform(labels, lambda x: x["lineage"]))
    known = F.get(F.filter(labels, lambda x: x["lineage"] == shared), F.lit(0))["species"]
    name = F.coalesce(known, label_for_lineage(shared))
    one = F.transform(labels, lambda x: F.struct(x["species"].alias("species"), name.alias("to_species"), shared.alias("to_lineage")))
    return F.when(single_animal & differ, one).otherwise(fold)
