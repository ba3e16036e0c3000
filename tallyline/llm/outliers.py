"""Quality rules with robust multivariate outliers, in DataFrame operations only.

Per text: words, their characters, symbols, repeated lines and words in repeated
three-word windows, each counted inside its row. Texts that pass the base rules become
vectors (log word length; square roots of the shares of symbols, repeated lines and
repeated words). Per language and source a minimum-covariance-determinant estimate is
fitted: from two deterministic starts (medians, and all rows) concentration steps take
the mean and covariance of the ``SHARE`` of rows nearest by Mahalanobis distance; the
start that ends with the smaller determinant wins, and one reweighting follows. Texts
beyond ``CUTOFF`` (a chi-squared quantile) are rejected.

The nearest rows are found from counts of distances in fixed fine bins, so a step is two
aggregates with a map-side part over a narrow stored table, whatever the size of a
group, and gives the same result on every run. A variance floor per component keeps
groups usable in which most rows share a value. Languages' sources with fewer than
``LEAST_ROWS`` rows are pooled by language. Where that pool is smaller too, its rows go by
the estimate of their whole language, and where the language has fewer rows, by that of
all rows, whatever their number. Every row is judged.

Defined results: NULL text has no words and fails the base rules, as empty text does;
NULL language or source is a group of its own; equal rows count each; rows without an id
are judged like others; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import SPACES, Stash, id_key, id_of

SYMBOLS = "[#*$%&|<>]"
WHITE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50
SHARE = 0.75
STEPS = 5
REWEIGHT = 0.975
CUTOFF = 1 - 1e-8
LEAST_ROWS = 100
# Least standard deviation of each component.
FLOORS = (0.03, 0.05, 0.10, 0.10)
P = len(FLOORS)
XS = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
BINS = 32


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    """The words of a text; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def covered(marked: Column) -> Column:
        # Windows sorted by digest; those beside an equal one are repeats. Their places, in order, cover 3 words each.
        def places(s: Column) -> Column:
            twin = F.filter(
                s,
                lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]),
            )
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(marked, places), total)

    def counted(w: Column) -> Column:
        windows = F.transform(
            F.slice(w, 1, F.greatest(F.array_size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        )

        def slow(h: Column) -> Column:
            ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            some = F.array_size(F.array_distinct(h)) < F.array_size(h)
            return F.when(some, covered(ordered)).otherwise(F.lit(0).cast("long"))

        return let(windows, slow)

    return let(words, counted)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``llm_stats``: a struct of the counts and of the lines with a word, beside all columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    n_lines = let(lines, lambda x: F.struct(F.array_size(x).alias("n"), F.array_size(F.array_distinct(x)).alias("d")))
    per_word = let(
        word_list(F.col(text)),
        lambda w: F.struct(
            F.array_size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    return docs.withColumns(
        {
            "llm_words": per_word,
            "llm_lines": n_lines,
            "llm_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        }
    )


def chi2_cdf(x: float, half: int) -> float:
    """Chi-squared distribution for ``2 * half`` degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def chi2_quantile(q: float, half: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, half) < q else (low, middle)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest share of normal rows must be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, P // 2), P // 2 + 1)


def _pooled(stats: DataFrame, least: int) -> DataFrame:
    """``(g_lang, g_source, gid, fits)``: the estimate that each language and source goes by, and those it is part of."""
    sizes = stats.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < least, F.col("n")).otherwise(0)
    by_lang = F.sum(small).over(Window.partitionBy("lang"))
    leveled = sizes.withColumns({"rest": by_lang, "every": F.sum("n").over(Window.partitionBy("lang"))})
    level = F.when(F.col("n") >= least, 0).when(F.col("rest") >= least, 1).when(F.col("every") >= least, 2).otherwise(3)
    leveled = leveled.withColumn("level", level)
    label = F.struct(
        "level",
        F.when(F.col("level") < 3, F.col("lang")).alias("l"),
        F.when(F.col("level") < 1, F.col("source")).alias("s"),
    )
    leveled = leveled.withColumn("label", label)
    named = leveled.withColumn("gid", F.dense_rank().over(Window.orderBy("label")).cast("long"))
    own = F.when(F.col("level") < 2, F.col("gid"))
    whole_lang = F.max(F.when(F.col("level") == 2, F.col("gid"))).over(Window.partitionBy("lang"))
    all_rows = F.max(F.when(F.col("level") == 3, F.col("gid"))).over(Window.partitionBy())
    fits = F.array_compact(F.array(own, whole_lang, all_rows))
    return named.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "gid", fits.alias("fits"))


def _factored(moments: DataFrame, scale: float) -> DataFrame:
    """Means and the Cholesky factor of the covariance, floors added, beside the keys."""
    made = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("k") for i in range(P)})
    cov = {
        f"c{i}{j}": F.greatest(F.col(f"q{i}{j}") / F.col("k") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0)) * scale
        + F.lit(FLOORS[i] ** 2)
        if i == j
        else (F.col(f"q{i}{j}") / F.col("k") - F.col(f"m{i}") * F.col(f"m{j}")) * scale
        for i, j in PAIRS
    }
    made = made.withColumns(cov)
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for t in range(j):
            rest = rest - F.col(f"l{i}{t}") * F.col(f"l{j}{t}")
        value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 * 1e-3))) if i == j else rest / F.col(f"l{j}{j}")
        made = made.withColumn(f"l{i}{j}", value)
    log_det = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, P)), F.log(F.col("l00")))
    return made.select("gid", "start", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS], log_det.alias("log_det"))


def _moments(points: DataFrame) -> DataFrame:
    return points.groupBy("gid", "start").agg(
        F.count("*").alias("k"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(XS)],
        *[F.sum(F.col(XS[i]) * F.col(XS[j])).alias(f"q{i}{j}") for i, j in PAIRS],
    )


def _distances(points: DataFrame, fitted: DataFrame, keys: list[str]) -> DataFrame:
    """``d2`` beside the points: forward substitution through the factor."""
    joined = points.join(fitted, keys)
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for t in range(i):
            rest = rest - F.col(f"l{i}{t}") * F.col(f"z{t}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, P)), F.col("z0") * F.col("z0"))
    return joined.withColumn("d2", d2)


def _bin(column: str) -> Column:
    return F.floor(F.log(F.col(column) + 1e-9) * BINS).cast("long")


def _nearest(measured: DataFrame, share: float, stash: Stash) -> DataFrame:
    """The share of each group's points with the smallest distance, whole bins."""
    binned = measured.withColumn("bin", _bin("d2"))
    # Stored, so that each bin is summed up before a group's bins meet in one task.
    counts = stash.put(binned.groupBy("gid", "start", "bin").agg(F.count("*").alias("n")), "bins")
    rising = Window.partitionBy("gid", "start").orderBy("bin")
    whole = Window.partitionBy("gid", "start")
    reached = counts.withColumns({"sofar": F.sum("n").over(rising), "all": F.sum("n").over(whole)})
    edge = reached.where(F.col("sofar") >= F.ceil(F.col("all") * share)).groupBy("gid", "start").agg(F.min("bin").alias("edge"))
    edge = stash.put(edge, "edge")
    stash.drop(counts)
    return binned.join(edge, ["gid", "start"]).where("bin <= edge")


def _median_start(points: DataFrame, stash: Stash) -> DataFrame:
    """Moments as if of a normal cloud at the medians, with spreads from the middle half."""
    width = 0.002
    long = points.select("gid", F.posexplode(F.array(*XS)).alias("dim", "x")).withColumn("b", F.floor(F.col("x") / width))
    counts = stash.put(long.groupBy("gid", "dim", "b").agg(F.count("*").alias("n")), "bins")
    rising, whole = Window.partitionBy("gid", "dim").orderBy("b"), Window.partitionBy("gid", "dim")
    reached = counts.withColumns({"sofar": F.sum("n").over(rising), "all": F.sum("n").over(whole)})
    quarter = lambda q: F.min(F.when(F.col("sofar") >= F.col("all") * q, (F.col("b") + 0.5) * width))
    found = reached.groupBy("gid", "dim").agg(quarter(0.5).alias("mid"), ((quarter(0.75) - quarter(0.25)) / 1.349).alias("sd"))
    wide = found.groupBy("gid").agg(
        *[F.max(F.when(F.col("dim") == i, F.col("mid"))).alias(f"mid{i}") for i in range(P)],
        *[F.max(F.when(F.col("dim") == i, F.col("sd"))).alias(f"sd{i}") for i in range(P)],
    )
    return wide.select(
        "gid",
        F.lit(0).alias("start"),
        F.lit(1).cast("long").alias("k"),
        *[F.col(f"mid{i}").alias(f"s{i}") for i in range(P)],
        *[
            (F.col(f"mid{i}") * F.col(f"mid{j}") + (F.col(f"sd{i}") ** 2 if i == j else F.lit(0.0))).alias(f"q{i}{j}")
            for i, j in PAIRS
        ],
    )


def estimates(points: DataFrame, stash: Stash, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Stored location and factor per ``gid``, from ``(gid, x0..)``."""
    whole = _moments(points.withColumn("start", F.lit(1)))
    fitted = stash.put(_factored(_median_start(points, stash), 1.0).unionByName(_factored(whole, 1.0)), "start")
    both = points.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(steps):
        near = _nearest(_distances(both, fitted, ["gid", "start"]), share, stash)
        fitted = stash.put(_factored(_moments(near.select("gid", "start", *XS)), consistency(share)), "step")
    best = Window.partitionBy("gid").orderBy("log_det", "start")
    chosen = fitted.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place", "start")
    chosen = stash.put(chosen, "chosen")
    inside = _distances(points, chosen, ["gid"]).where(F.col("d2") <= chi2_quantile(REWEIGHT, P // 2))
    final = _factored(_moments(inside.select("gid", *XS).withColumn("start", F.lit(0))), consistency(REWEIGHT))
    return stash.put(final.drop("start", "log_det"), "final")


def judge(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = CUTOFF,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``distance2`` of each row."""
    stash = Stash(docs.sparkSession)
    narrow = docs.select(
        id_key(id_col).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    counted = statistics(narrow).select(
        "id",
        "lang",
        "source",
        "llm_words.*",
        F.col("llm_symbols").alias("n_symbols"),
        (F.col("llm_lines.n") - F.col("llm_lines.d")).cast("long").alias("n_dup_lines"),
        F.col("llm_lines.n").alias("n_lines"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stats = stash.put(counted.withColumn("base_failed", failed), "stats")
    share = lambda part, of: F.sqrt(F.col(part) / F.greatest(F.col(of), F.lit(1)))
    vectors = stats.where(~F.col("base_failed")).withColumns(
        {
            "x0": F.log(F.col("word_chars") / F.col("n_words")),
            "x1": share("n_symbols", "word_chars"),
            "x2": share("n_dup_lines", "n_lines"),
            "x3": share("n_repeat_words", "n_words"),
        }
    )
    groups = stash.put(_pooled(vectors, least_rows), "pools")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    points = stash.put(vectors.join(groups, same).drop("g_lang", "g_source"), "points")
    fitted = estimates(points.select(F.explode("fits").alias("gid"), *XS), stash)
    judged = _distances(points, fitted, ["gid"])
    fine = F.col("d2") <= chi2_quantile(cutoff, P // 2)
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = judged.select("id", *shown, fine.alias("kept"), F.col("d2").alias("distance2"))
    bad = stats.where("base_failed").select("id", *shown, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance2"))
    return good.unionByName(bad).select(id_of("id").alias("doc_id"), *shown, "kept", "distance2")
