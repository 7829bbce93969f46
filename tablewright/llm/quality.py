"""Quality rules: text statistics, fixed rules on them, and robust outliers by minimum covariance determinant (MCD).

A document's statistics are transformed to a vector; for each language and source the MCD estimate is the mean and
covariance of the ``subset`` of its documents whose covariance has the least determinant, found by concentration steps from
deterministic starts. Documents far from it by Mahalanobis distance are rejected. Everything is DataFrame expressions.

Vectors are whole numbers (parts of UNIT), so sums of products are exact and don't depend on how rows were dealt. A step
needs a quantile and sums for each group; both collapse before the shuffle, so a source with most of the documents is
never in one task.
"""

from __future__ import annotations

import functools
import operator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .shared import SPACE, let, stored

UNIT = 4096
#: Name and floor of the standard deviation of each part of the vector; its square is added to the variance (a ridge).
PARTS = {"words": 0.5, "word_length": 0.08, "symbols": 0.05, "dup_lines": 0.16, "repeats": 0.12}
SIZE = len(PARTS)
#: Quantiles of the chi-square distribution with five degrees of freedom: the middle, and all but one in 100,000.
CHI_MIDDLE, CHI_FAR = 4.35146, 30.8562
_WINDOW = 5
_SPACES = " \t\n\x0b\f\r"


class Base(NamedTuple):
    """Statistics of a text as columns of type long."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_lines: Column
    n_dup_lines: Column
    n_repeat_words: Column


def _repeat_words(words: Column) -> Column:
    """Words in runs of five that occur twice or more: from windows in order of hash, the places whose neighbour is equal."""
    count = F.size(words) - (_WINDOW - 1)
    window = lambda i: F.xxhash64(*(words[i + k] for k in range(_WINDOW)))
    hashes = F.transform(F.sequence(F.lit(0), count - 1), window)

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            twice = lambda p, k: (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"])
            return F.array_sort(F.transform(F.filter(pairs, lambda p, k: F.coalesce(twice(p, k), F.lit(False))), lambda p: p["i"]))

        # each window adds the words that the one before it doesn't cover
        start = F.struct(F.lit(-_WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
        add = lambda done, i: F.struct(i.alias("last"), (done["sum"] + F.least(F.lit(_WINDOW), i - done["last"])).alias("sum"))
        return F.aggregate(let(pairs, places), start, add, lambda done: done["sum"])

    none = F.lit(0).cast("long")
    some = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))
    return F.when(count < 2, none).otherwise(let(hashes, some))


def base_statistics(text: Column) -> Column:
    """A struct with the fields of Base; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    of_words = let(
        words,
        lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), _repeat_words(w).alias("repeat")),
    )
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")
    return let(
        F.struct(of_words.alias("w"), of_lines.alias("l")),
        lambda s: F.struct(
            s["w"]["n"].alias("n_words"),
            s["w"]["chars"].alias("word_chars"),
            symbols.alias("n_symbols"),
            s["l"]["n"].alias("n_lines"),
            s["l"]["dup"].alias("n_dup_lines"),
            s["w"]["repeat"].alias("n_repeat_words"),
        ),
    )


def vector() -> list[Column]:
    """The transformed statistics in parts of UNIT: logarithms of counts, square roots of shares."""
    c = F.col
    share = lambda part, whole: F.sqrt(c(part) / F.greatest(c(whole), F.lit(1)))
    parts = [
        F.log1p("n_words"),
        # the mean of few words says little: twenty words of usual length are added
        F.log1p((c("word_chars") + 100) / (c("n_words") + 20)),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]
    return [F.round(p * UNIT).cast("long") for p in parts]


def _v(i: int) -> Column:
    return F.col(f"v{i}")


def _distance(middle, inverse) -> Column:
    """The squared Mahalanobis distance of v from a middle with the inverse of a covariance's lower triangle."""
    z = [(_v(i) - middle[i]) / UNIT for i in range(SIZE)]
    rows = (functools.reduce(operator.add, (inverse[i][j] * z[j] for j in range(i + 1))) for i in range(SIZE))
    return functools.reduce(operator.add, (row * row for row in rows))


def _estimate(sums: DataFrame, keys: list[str]) -> DataFrame:
    """m0.. (middle), i00.. (inverse of the lower triangle of the covariance) and logdet from n, s0.., q00.. of each group."""
    n, each = F.col("n"), range(SIZE)
    floor = [(f * UNIT) ** 2 for f in PARTS.values()]
    frame = sums.withColumns({f"m{i}": F.col(f"s{i}") / n for i in each})
    cov = {
        f"c{i}{j}": (F.col(f"q{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}") + (floor[i] if i == j else 0)) / UNIT**2 for i in each for j in range(i + 1)
    }
    frame = frame.withColumns(cov)
    for j in each:  # Cholesky, column by column
        before = lambda a, b: functools.reduce(operator.add, (F.col(f"l{a}{k}") * F.col(f"l{b}{k}") for k in range(j)), F.lit(0.0))  # noqa: B023, E731
        frame = frame.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - before(j, j), F.lit(1e-9))))
        if j + 1 < SIZE:
            frame = frame.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - before(i, j)) / F.col(f"l{j}{j}") for i in range(j + 1, SIZE)})
    for i in each:  # the triangle's inverse, row by row
        row = {}
        for j in range(i + 1):
            if i == j:
                row[f"i{i}{i}"] = 1 / F.col(f"l{i}{i}")
            else:
                row[f"i{i}{j}"] = -functools.reduce(operator.add, (F.col(f"l{i}{k}") * F.col(f"i{k}{j}") for k in range(j, i))) / F.col(f"l{i}{i}")
        frame = frame.withColumns(row)
    logdet = functools.reduce(operator.add, (2 * F.log(f"l{i}{i}") for i in each))
    return frame.select(*keys, *(f"m{i}" for i in each), *(f"i{i}{j}" for i in each for j in range(i + 1)), logdet.alias("logdet"))


def _sums() -> list[Column]:
    whole = lambda c, name: F.sum(c.cast("decimal(38,0)")).cast("double").alias(name)
    squares = [whole(_v(i) * _v(j), f"q{i}{j}") for i in range(SIZE) for j in range(i + 1)]
    return [F.count("*").alias("n"), *(whole(_v(i), f"s{i}") for i in range(SIZE)), *squares]


def _measured(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows with the columns of their group's state and d, the squared distance."""
    both = rows.join(state, ["g_lang", "g_source"])
    inverse = [[F.col(f"i{i}{j}") for j in range(i + 1)] for i in range(SIZE)]
    return both.withColumn("d", _distance([F.col(f"m{i}") for i in range(SIZE)], inverse))


def _bin(d: Column) -> Column:
    """Distances in steps of a hundredth of their size, so that a group's quantile is one over few distinct values.

    All documents of the quantile's step are in the subset, so it can be somewhat larger than asked, and between two steps
    of the concentration the determinant may rise a little where the subset's size changes.
    """
    return F.floor(70 * F.log2(1 + 64 * d))


def mcd(rows: DataFrame, subset: float = 0.75, steps: int = 6) -> DataFrame:
    """g_lang, g_source, m.., i.., scale: the MCD estimate of v0.. for each group of the rows (stored, read many times).

    Covariances are ridge estimates: the squares of PARTS' floors are added to the variances, of whole groups and of subsets
    alike, so it is the determinant with the ridge that is made small.

    Two starts: medians with deviations from them, and the covariance of hyperbolic tangents of what these standardise. Each
    is concentrated ``steps`` times on the nearest ``subset`` of its group; the smaller determinant wins. ``scale`` brings
    the group's median distance to what a normal distribution has, and never below 1.
    """
    keys, each = ["g_lang", "g_source"], range(SIZE)
    groups = rows.select(*keys).distinct().count()
    middle = stored(rows.groupBy(*keys).agg(*(F.percentile(f"v{i}", 0.5).alias(f"m{i}") for i in each)), "medians", groups)
    away = rows.join(middle, keys).groupBy(*keys, *(f"m{i}" for i in each))
    spread = stored(away.agg(*(F.percentile(F.abs(_v(i) - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i in each)), "spreads", groups)
    floors = [f * UNIT for f in PARTS.values()]
    wide = {f"d{i}": F.greatest(1.4826 * F.col(f"d{i}"), F.lit(floors[i])) for i in each}
    spread = spread.withColumns(wide)
    inverse = {f"i{i}{j}": UNIT / F.col(f"d{i}") if i == j else F.lit(0.0) for i in each for j in range(i + 1)}
    plain = spread.withColumns(inverse).select(*keys, *(f"m{i}" for i in each), *inverse, F.lit(0.0).alias("logdet"))
    # the tangents, put back to the vector's scale and rounded, have exact sums too
    bent = rows.join(spread, keys).select(*keys, *(F.round(F.col(f"m{i}") + F.col(f"d{i}") * F.tanh((_v(i) - F.col(f"m{i}")) / F.col(f"d{i}"))).cast("long").alias(f"v{i}") for i in each))
    tangent = _estimate(bent.groupBy(*keys).agg(*_sums()), keys)
    state = stored(plain.withColumn("start", F.lit(0)).unionByName(tangent.withColumn("start", F.lit(1))), "state", 2 * groups)
    keys_start = [*keys, "start"]
    for _ in range(steps):
        binned = _measured(rows, state).withColumn("bin", _bin(F.col("d")))
        bound = binned.groupBy(*keys_start).agg(F.percentile("bin", subset).alias("bound"))
        near = binned.join(bound, keys_start).where("bin <= bound")
        state = stored(_estimate(near.groupBy(*keys_start).agg(*_sums()), keys_start), "state", 2 * groups)
    best = state.groupBy(*keys).agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    state = state.join(best, keys_start)
    binned = _measured(rows, state).withColumn("bin", _bin(F.col("d")))
    middle = binned.groupBy(*keys).agg(((F.pow(F.lit(2.0), F.percentile("bin", 0.5) / 70) - 1) / 64).alias("typical"))
    return stored(state.join(middle, keys).withColumn("scale", F.greatest(F.col("typical") / CHI_MIDDLE, F.lit(1.0))), "mcd", groups)


def quality_rules(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_columns: tuple[str, str] = ("lang", "source"),
    subset: float = 0.75,
    steps: int = 6,
    cutoff: float = CHI_FAR,
    least_group: int = 100,
) -> DataFrame:
    """doc_id, the statistics of Base, base_failed, distance and kept, one row for each document.

    base_failed: fewer than 10 words, or more than a fifth of the words in repeated runs of five. kept: not base_failed, and
    the squared distance from the group's estimate, which is made of the documents that don't fail, is at most ``cutoff``.

    Defined cases: a null text counts as empty. Null languages and sources are values of their own. A group of fewer than
    least_group documents is judged with its whole language, and such a language with the whole table. Rows that repeat
    count as often as they occur. Extra columns are not read; an empty table gives no rows.
    """
    lang, source = group_columns
    documents = documents.select(F.col(id_column).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(text_column).alias("text"))
    found = documents.select("doc_id", "lang", "source", base_statistics(F.col("text")).alias("s"))
    failed = (F.col("s.n_words") < 10) | (100 * F.col("s.n_repeat_words") > 20 * F.col("s.n_words"))
    found = stored(found.select("doc_id", "lang", "source", "s.*", failed.alias("base_failed")), "statistics")
    passed = found.where("NOT base_failed")
    # a group's key is text that no value can be mistaken for: a null is empty, a value has a mark before it
    known = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    counted = passed.groupBy(known("lang").alias("lang_key"), known("source").alias("source_key")).agg(F.count("*").alias("own"))
    whole = counted.groupBy(F.col("lang_key").alias("lang_of")).agg(F.sum("own").alias("all"))
    large = counted.join(whole, F.col("lang_key") == F.col("lang_of")).select(
        "lang_key", "source_key", F.when(F.col("all") >= least_group, F.col("lang_key")).otherwise("*").alias("g_lang"),
        F.when((F.col("all") >= least_group) & (F.col("own") >= least_group), F.col("source_key")).otherwise("*").alias("g_source"),
    )
    keyed = found.withColumns({"lang_key": known("lang"), "source_key": known("source")}).join(large, ["lang_key", "source_key"], "left")
    numbers = {f"v{i}": v for i, v in enumerate(vector())}
    keyed = stored(keyed.withColumns(numbers), "vectors")
    one = keyed.where("NOT base_failed").select("g_lang", "g_source", *numbers)
    # each level is estimated from all its documents, also from those whose own group is large enough
    levels = keyed.where("NOT base_failed").select("lang_key", *numbers)
    pooled = large.where("g_source = '*'").select("g_lang").distinct()
    of_lang = levels.withColumn("g_lang", F.col("lang_key")).join(pooled, "g_lang", "left_semi")
    of_all = levels.withColumn("g_lang", F.lit("*")).join(pooled, "g_lang", "left_semi")
    upper = of_lang.unionByName(of_all).select("g_lang", F.lit("*").alias("g_source"), *numbers)
    rows = stored(one.where("g_source <> '*'").unionByName(upper), "rows")
    estimate = mcd(rows, subset, steps)
    inverse = [[F.col(f"i{i}{j}") for j in range(i + 1)] for i in range(SIZE)]
    judged = keyed.join(estimate, ["g_lang", "g_source"], "left")
    distance = _distance([F.col(f"m{i}") for i in range(SIZE)], inverse) / F.col("scale")
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    judged = judged.withColumn("distance", F.when(~F.col("base_failed"), F.round(distance, 6)))
    return judged.select("doc_id", *Base._fields, "base_failed", "distance", kept.alias("kept"))
