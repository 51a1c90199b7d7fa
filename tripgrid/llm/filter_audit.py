"""How filters interact: what each one removes after every possible set of earlier ones.

Every filter leaves one table of the ids that fail it, and nothing else is kept of its verdicts.
All counts come from joins with these tables: a prefix's survivors are the rows left by an anti
join with the tables of its filters; a filter removes what a semi join with its own table finds
and an anti join with the prefix's tables leaves; what a semi join with the prefix's tables finds
instead is redundant. A prefix is a set of filters, as survivors do not depend on the order within
it, so the 120 orders of five filters need 32 prefixes and 80 pairs of prefix and filter.

Only rows that fail something are multiplied by prefixes, inside a partitioning by id that all
joins share; each count is summed in its task before it is sent on. An id is the number a row got
when the facts were written, so equal or missing document ids do not mix.

Defined cases: null text counts as empty, null part as the empty string; a null document id has no
label and is never a later copy; repeated rows are rows of their own, and neither of two copies
with equal ids is the later one; repeated labels count once, and one good (or toxic) label is
enough; no documents give no parts and no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid.llm.common import join_small, stored, words_of
from tripgrid.session import scratch_dir

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions on one document's text."""
    whole = F.coalesce(text, F.lit(""))
    words = words_of(text)
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(whole, F.lit("[A-Z]")) > 2 * F.length(whole),
        "D": whole.rlike(r"[#$%&*|]"),
    }


def facts(docs: DataFrame, rules: dict[str, Column], part: Column) -> DataFrame:
    """One written row for each document: ``row``, doc_id, part, the text's digest and each rule's verdict."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    verdicts = [rule.alias(f"fails_{name}") for name, rule in rules.items()]
    seen = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), digest, *verdicts)
    return stored(seen.withColumn("row", F.monotonically_increasing_id()), "audit-facts")


def later_copies(known: DataFrame, broadcast_rows: int) -> DataFrame:
    """Ids of rows whose text also stands under a smaller document id."""
    first = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = stored(first.filter("first < last").select(F.col("digest").alias("text"), "first"), "audit-copies")
    same = (F.col("digest") == F.col("text")) & (F.col("doc_id") > F.col("first"))
    return join_small(known.select("row", "doc_id", "digest"), repeated, same, "left_semi", broadcast_rows).select("row")


def with_labels(known: DataFrame, labels: DataFrame, broadcast_rows: int) -> DataFrame:
    """``row``, part and whether the document is labelled good and toxic."""
    marks = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    marks = marks.filter("labelled is not null and (good or toxic)")
    joined = join_small(known.select("row", "doc_id", "part"), marks, F.col("doc_id") == F.col("labelled"), "left", broadcast_rows)
    flags = [F.coalesce(c, F.lit(False)).cast("long").alias(c) for c in ("good", "toxic")]
    return stored(joined.select("row", "part", *flags), "audit-rows")


def store_failing(failing: dict[str, DataFrame]) -> DataFrame:
    """Writes one id table per filter, in a folder of its own; returns all of them as (id, at), ``at`` being the filter's number."""
    spark = next(iter(failing.values())).sparkSession
    folder = scratch_dir(spark, "audit-fails")
    for k, name in enumerate(sorted(failing)):
        failing[name].select(F.col("row").alias("id")).write.parquet(f"{folder}/at={k}")
    return spark.read.schema("id long, at int").parquet(folder)


def _counts(df: DataFrame, kind: str, key: Column) -> DataFrame:
    return df.groupBy("part", F.lit(kind).alias("kind"), key.alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def interactions(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """One row for each part, order of the filters and step, from ``rows`` and one id table per filter.

    ``rows`` has row, part, good and toxic (0 or 1); every table of ``failing`` has the rows that fail.
    """
    names = sorted(failing)
    sets = range(1 << len(names))
    ids = store_failing(failing).hint("shuffle_hash")
    same = F.col("row") == F.col("id")
    in_prefix = same & (F.getbit(F.col("prefix"), F.col("at")) == 1)
    clean = rows.join(ids, same, "left_anti")
    touched = rows.join(ids, same, "left_semi")
    survivors = touched.withColumn("prefix", F.explode(F.array(*map(F.lit, sets)))).join(ids, in_prefix, "left_anti")
    here = rows.join(ids, same).select("row", "part", "good", "toxic", F.col("at").alias("filter"))
    without = F.array(*[F.array(*[F.lit(s) for s in sets if not s >> k & 1]) for k in range(len(names))])
    before = here.withColumn("prefix", F.explode(F.get(without, F.col("filter"))))
    step = F.col("prefix") * len(names) + F.col("filter")
    found = [
        _counts(clean, "clean", F.lit(0)),
        _counts(survivors, "left", F.col("prefix")),
        _counts(before.join(ids, in_prefix, "left_anti"), "removed", step),
        _counts(before.join(ids, in_prefix, "left_semi"), "redundant", step),
    ]
    # at most 1 + 32 + 2 * 80 entries a part
    entry = F.struct(F.concat("kind", F.lit(":"), "key"), F.struct("n", "good", "toxic"))
    per_part = reduce(DataFrame.unionByName, found).groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("of"))
    return _per_step(per_part, names)


def _per_step(per_part: DataFrame, names: list[str]) -> DataFrame:
    """Looks the counts of every order and step up in a part's map."""
    full, steps = (1 << len(names)) - 1, []
    for order in permutations(range(len(names))):
        prefix = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(names[i] for i in order), step, names[k], k, prefix))
            prefix |= 1 << k
    fields = ("filter_order", "step", "filter", "k", "prefix")
    listed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(fields, row, strict=True)]) for row in steps])

    def count(kind: str, key: Column, what: str = "n") -> Column:
        return F.coalesce(F.try_element_at(F.col("of"), F.concat(F.lit(f"{kind}:"), key))[what], F.lit(0))

    def removed(prefix: Column, what: str = "n") -> Column:
        return count("removed", prefix * len(names) + F.col("k"), what)

    weights = {s: factorial(s.bit_count()) * factorial(len(names) - 1 - s.bit_count()) for s in range(full)}
    shares = F.array(*[
        reduce(lambda a, b: a + b, [w * count("removed", F.lit(s * len(names) + k)) for s, w in weights.items() if not s >> k & 1])
        for k in range(len(names))
    ])
    steps_of = per_part.withColumn("shares", shares).select("part", "of", "shares", F.explode(listed).alias("s")).select(
        "part", "of", "shares", "s.*"
    )
    bit = F.get(F.array(*[F.lit(1 << i) for i in range(len(names))]), F.col("k"))
    prefix = F.col("prefix")
    found = {
        "kept": count("clean", F.lit(0)) + count("left", prefix + bit),
        "removed": removed(prefix),
        "redundant": count("redundant", prefix * len(names) + F.col("k")),
        "unique_fails": removed(F.lit(full) - bit),
        "good_lost": removed(prefix, "good"),
        "toxic_lost": removed(prefix, "toxic"),
        "shapley": F.get("shares", F.col("k")),
    }
    return steps_of.select("part", "filter_order", "step", "filter", *[found[c].cast("long").alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """The five filters of ``text_rules`` and ``later_copies`` (as E), per source of ``docs``.

    ``docs`` needs doc_id, text and source; ``labels`` doc_id, quality and toxic.
    """
    rules = text_rules(F.col("text"))
    known = facts(docs, rules, F.col("source"))
    failing = {name: known.filter(f"fails_{name}").select("row") for name in rules}
    failing["E"] = later_copies(known, broadcast_rows)
    return interactions(with_labels(known, labels, broadcast_rows), failing)
