"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Everything here is DataFrame expressions. A document becomes a vector of transformed statistics;
for each (lang, source) the minimum covariance determinant estimate gives a centre and a scatter,
and documents beyond the cutoff in Mahalanobis distance are rejected. The estimate has three
deterministic starts: medians and median deviations, the moments of all documents, and those of
documents near the medians in every component. From each of them concentration steps on the
closest three quarters go on until the determinant falls no more, and the least one counts.

A group of fewer than ``min_group`` usable documents (those that pass the base rules) is judged by
the estimate over its language, and a language of fewer by that over all documents.

Sums are taken over values rounded to thousandths and held as integers, so that neither the
order of rows nor the number of partitions changes a verdict.

Defined cases: null text counts as empty; null lang or source form groups of their own; where all
documents together have fewer than ``2 * D`` usable ones, nothing is rejected, as no scatter can be
told from so few; repeated rows count as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripgrid.llm.common import join_small, stored, words_of
from tripgrid.session import scratch_dir

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
#: vector components and the deviation whose square is added to each one's variance, so that a
#: group whose documents hardly differ does not reject the next one that does
FEATURES = {"f_words": 0.5, "f_length": 0.1, "f_symbols": 0.3, "f_lines": 0.7, "f_repeat": 1.0}
D = len(FEATURES)
SCALE = 1000
GROUP = ["lang", "source"]


def repeat_words(words: Column, windows: Column, ordered: Column) -> Column:
    """Words inside windows found twice or more; ``ordered`` are (hash, position) in order."""
    at = F.transform(
        ordered,
        lambda p, j: F.when(
            ((j > 0) & (F.get(ordered, j - 1)["h"] == p["h"]))
            | ((j < F.size(ordered) - 1) & (F.get(ordered, j + 1)["h"] == p["h"])),
            p["i"],
        ),
    )
    covered = F.aggregate(
        F.array_sort(F.array_compact(at)),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct(
            (s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n"), (i + WINDOW).alias("end")
        ),
        lambda s: s["n"],
    )
    return F.when(ordered.isNull(), F.lit(0)).otherwise(covered).cast("long")


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the base statistics of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # the second projections read the first ones several times, so Spark keeps them apart
    first = docs.select(*keep, text.alias("_text"), words_of(F.col("text")).alias("_words"))
    words, n = F.col("_words"), F.size("_words")
    hashed = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
        ),
    )
    lines = F.when(
        F.col("_text").contains("\n"),
        F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
    )
    second = first.select(
        *keep,
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        n.cast("long").alias("n_words"),
        lines.alias("_lines"),
        hashed.alias("_windows"),
    )
    win = F.col("_windows")
    third = second.withColumn(
        "_ordered",
        F.when(
            F.size(F.array_distinct(win)) < F.size(win),
            F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    return third.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        F.coalesce(F.size("_lines") - F.size(F.array_distinct("_lines")), F.lit(0)).cast("long").alias("n_dup_lines"),
        repeat_words(words, win, F.col("_ordered")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> dict[str, Column]:
    """Components in thousandths, as integers; defined for documents with a word."""
    n = F.nullif(F.col("n_words").cast("double"), F.lit(0.0))
    raw = {
        "f_words": F.log(n + 1),
        "f_length": F.log(F.col("word_chars") / n),
        "f_symbols": F.log1p(100 * F.col("n_symbols") / n),
        "f_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "f_repeat": F.log1p(100 * F.col("n_repeat_words") / n),
    }
    return {k: F.coalesce(F.round(v * SCALE), F.lit(0)).cast("long") for k, v in raw.items()}


def chi2_cdf(x: float, odd: int) -> float:
    """Chi-square distribution for an odd number of degrees of freedom."""
    term = total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2) if odd > 1 else 0.0
    for k in range(3, odd, 2):
        term *= x / k
        total += term
    return math.erf(math.sqrt(x / 2)) - total


def chi2_quantile(p: float, odd: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, odd) < p else (low, mid)
    return (low + high) / 2


def _estimates(sums: DataFrame, inflate: float, keys: list[str]) -> DataFrame:
    """Means, the Cholesky factor of the scatter and its log determinant for each group, from integer sums."""
    names = list(FEATURES)
    n = F.col("n").cast("double")
    mean = [(F.col(f"s_{a}") / n / SCALE).alias(f"m_{a}") for a in names]
    df = sums.select(*keys, *mean, "n", *[f"q_{i}_{j}" for i in range(D) for j in range(i + 1)])
    for i in range(D):
        for j in range(i + 1):
            a, b = names[i], names[j]
            cov = F.col(f"q_{i}_{j}") / n / (SCALE * SCALE) - F.col(f"m_{a}") * F.col(f"m_{b}")
            cov = cov * inflate
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + FEATURES[a] ** 2
            rest = reduce(lambda s, k: s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}"), range(j), cov)
            df = df.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
    determinant = reduce(lambda s, i: s + 2 * F.log(F.col(f"l_{i}_{i}")), range(D), F.lit(0.0))
    return df.withColumn("logdet", determinant).drop("n", *[f"q_{i}_{j}" for i in range(D) for j in range(i + 1)])


def _distance(df: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i, a in enumerate(FEATURES):
        x = F.col(a) / SCALE - F.col(f"m_{a}")
        x = reduce(lambda s, k: s - F.col(f"l_{i}_{k}") * F.col(f"z_{k}"), range(i), x)
        df = df.withColumn(f"z_{i}", x / F.col(f"l_{i}_{i}"))
    return df.withColumn("d2", reduce(lambda s, i: s + F.col(f"z_{i}") ** 2, range(D), F.lit(0.0)))


def _with(df: DataFrame, params: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Rows with the parameters of their group ``g``, broadcast where the groups are counted to be ``few``."""
    right = params.withColumnRenamed("g", "_g")
    return df.join(F.broadcast(right) if few else right, F.col("g") == F.col("_g"), how).drop("_g")


def _moments() -> list[Column]:
    names = list(FEATURES)
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(a).alias(f"s_{a}") for a in names],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q_{i}_{j}") for i in range(D) for j in range(i + 1)],
    ]


def _medians(df: DataFrame) -> DataFrame:
    """Median of every component for each group, from counts per distinct integer value."""
    long = df.select("g", F.posexplode(F.array(*FEATURES)).alias("k", "v"))
    counts = long.groupBy("g", "k", "v").count()
    w = Window.partitionBy("g", "k")
    ranked = counts.select(
        "g", "k", "v", F.sum("count").over(w.orderBy("v")).alias("upto"), F.sum("count").over(w).alias("all")
    )
    return (
        ranked.filter(2 * F.col("upto") >= F.col("all"))
        .groupBy("g")
        .agg(*[F.min(F.when(F.col("k") == i, F.col("v"))).alias(f"c_{a}") for i, a in enumerate(FEATURES)])
    )


def _starts(members: DataFrame, few: bool) -> DataFrame:
    """First estimates of every group: diagonal from medians, all moments, moments near the medians."""
    centre = stored(_medians(members), "mcd-centre")
    moved = _with(members, centre, few)
    away = moved.select("g", *[F.abs(F.col(a) - F.col(f"c_{a}")).alias(a) for a in FEATURES])
    spread = _medians(away).withColumnsRenamed({f"c_{a}": f"d_{a}" for a in FEATURES})
    both = stored(_with(spread, centre, few), "mcd-medians")
    least = {a: F.sqrt((1.4826 * F.col(f"d_{a}") / SCALE) ** 2 + FEATURES[a] ** 2) for a in FEATURES}
    diagonal = both.select(
        "g", F.lit(0).alias("start"),
        *[(F.col(f"c_{a}") / SCALE).alias(f"m_{a}") for a in FEATURES],
        *[(least[a] if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i, a in enumerate(FEATURES) for j in range(i + 1)],
        F.lit(0.0).alias("logdet"),
    )
    near = reduce(lambda x, y: x & y, [F.abs(F.col(a) - F.col(f"c_{a}")) <= 2 * SCALE * least[a] for a in FEATURES])
    # one pass: every document counts in the second start, those near the medians in the third one too
    met = _with(members, both, few).select(
        "g", *FEATURES, F.explode(F.when(near, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("start")
    )
    return diagonal.unionByName(_estimates(met.groupBy("g", "start").agg(*_moments()), 1.0, ["g", "start"]))


def _concentrate(members: DataFrame, params: DataFrame, share: float, inflate: float, few: bool) -> DataFrame:
    """One concentration step: estimates over the closest ``share`` of every group.

    Distances are counted in bins of half a per cent, and whole bins are taken until the share is
    reached; the sums of a bin are made in the same pass.
    """
    keys = ["g", "start"]
    d = _distance(_with(members, params, few))
    binned = d.withColumn("bin", F.floor(F.log1p("d2") * 200)).groupBy(*keys, "bin").agg(*_moments())
    w = Window.partitionBy(*keys)
    ranked = binned.withColumns(
        {"before": F.sum("n").over(w.orderBy("bin")) - F.col("n"), "all": F.sum("n").over(w)}
    )
    core = ranked.filter(F.col("before") < F.ceil(share * F.col("all")))
    sums = core.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in binned.columns if c not in (*keys, "bin")])
    return _estimates(sums, inflate, keys)


def _least_determinant(members: DataFrame, share: float, settled: float, few: bool) -> DataFrame:
    """Per group the estimate of least determinant over all starts, each concentrated until it settles.

    A start that falls by no more than ``settled`` in the logarithm stays as it is; the others go on.
    """
    core = chi2_quantile(share, D)
    inflate = share / chi2_cdf(core, D + 2)
    spark = members.sparkSession
    # no start is the estimate of a core, so every first step counts as a fall
    state = stored(_starts(members, few).withColumns({"logdet": F.lit(math.inf), "moving": F.lit(True)}), "mcd-starts")
    rest = [c for c in state.columns if c not in ("g", "start", "moving")]
    while True:
        then = _concentrate(members, state.filter("moving").drop("moving", "logdet"), share, inflate, few)
        then = then.withColumnsRenamed({c: f"t_{c}" for c in then.columns})
        pair = state.join(then, (F.col("g") == F.col("t_g")) & (F.col("start") == F.col("t_start")), "left")
        falls = F.coalesce(F.col("t_logdet") < F.col("logdet") - settled, F.lit(False))
        now = pair.select("g", "start", *[F.when(falls, F.col(f"t_{c}")).otherwise(F.col(c)).alias(c) for c in rest], falls.alias("moving"))
        seen, path = Observation(), scratch_dir(spark, "mcd-step")
        now.observe(seen, F.count_if("moving").alias("n")).write.parquet(path)
        state = spark.read.schema(now.schema).parquet(path)
        if not seen.get["n"]:
            break
    others = [c for c in rest if c != "logdet"]
    least = state.groupBy("g").agg(F.min(F.struct("logdet", "start", *others)).alias("best"))
    return least.select("g", *[F.col(f"best.{c}").alias(c) for c in others])


def _grouped(table: DataFrame, min_group: int, groups: int) -> tuple[DataFrame, DataFrame, int, bool]:
    """Documents with the group ``g`` that judges them, the members of all groups, how many documents are usable,
    and whether there are at most ``groups`` groups."""
    usable = table.filter(~F.col("base_failed"))
    per_source = usable.groupBy("by_source", "by_lang").agg(F.count(F.lit(1)).alias("n_source"))
    per_source = stored(per_source, "mcd-sizes")
    per_lang = per_source.groupBy(F.col("by_lang").alias("_lang")).agg(
        F.sum("n_source").alias("n_lang"), F.max(F.col("n_source") < min_group).alias("needed")
    )
    sized = join_small(per_source, per_lang, F.col("by_lang") == F.col("_lang"), "inner", groups).drop("_lang", "by_lang")
    sized = stored(sized.withColumnRenamed("by_source", "_source"), "mcd-groups")
    total, pooled, n = sized.agg(
        F.coalesce(F.sum("n_source"), F.lit(0)), F.coalesce(F.max(F.col("n_lang") < min_group), F.lit(False)), F.count(F.lit(1))
    ).first()
    few = 2 * n + 1 <= groups  # every source's group, its language's and the one of all
    met = table.join(F.broadcast(sized) if few else sized, F.col("by_source") == F.col("_source"), "left")
    large, spoken = F.col("n_source") >= min_group, F.col("n_lang") >= min_group
    judged_by = F.when(large, F.col("by_source")).when(spoken, F.col("by_lang")).otherwise(F.lit("all"))
    memberships = [F.when(large, F.col("by_source")), F.when(F.col("needed") & spoken, F.col("by_lang"))]
    if pooled:
        memberships.append(F.lit("all"))
    members = met.filter(~F.col("base_failed")).select(*FEATURES, F.explode(F.array_compact(F.array(*memberships))).alias("g"))
    return met.withColumn("g", judged_by), stored(members, "mcd-members"), total, few


def score_quality(
    docs: DataFrame,
    keep: list[str],
    share: float = 0.75,
    settled: float = 0.01,
    cutoff: float = 0.9999,
    min_group: int = 50,
    broadcast_groups: int = 20_000,
) -> DataFrame:
    """``keep`` and, for every document, statistics, ``base_failed``, ``distance2`` and ``kept``.

    ``docs`` needs text, lang and source; ``keep`` names further columns to hand through.
    ``distance2`` is null where no verdict is formed (base rules failed, or hardly any documents).
    """
    carried = list(dict.fromkeys([*keep, *GROUP]))
    groups = {
        "by_source": F.concat(F.lit("source"), F.to_json(F.struct(*GROUP))),
        "by_lang": F.concat(F.lit("lang"), F.to_json(F.struct("lang"))),
    }
    counted = statistics(docs, carried).withColumn("base_failed", base_failed()).withColumns(vector())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *FEATURES]
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    table = stored(counted.select(row, *names, *[g.alias(n) for n, g in groups.items()]), "quality")
    grouped, members, total, few = _grouped(table, min_group, broadcast_groups)
    edge = chi2_quantile(0.975, D)
    judged = grouped.withColumn("d2", F.lit(None).cast("double"))
    if total >= 2 * D:
        best = _least_determinant(members, share, settled, few)
        within = _distance(_with(members, best, few)).filter(F.col("d2") <= edge)
        final = stored(_estimates(within.groupBy("g").agg(*_moments()), 0.975 / chi2_cdf(edge, D + 2), ["g"]), "mcd-final")
        judged = _distance(_with(grouped, final, few, "left"))
    return judged.select(
        "row.*",
        *names[:6],
        F.when(~F.col("base_failed"), F.round("d2", 6)).alias("distance2"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= chi2_quantile(cutoff, D), F.lit(True))).alias("kept"),
    )
