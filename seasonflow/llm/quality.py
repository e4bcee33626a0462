"""Quality rules: plain limits, then robust multivariate outliers.

Five statistics of each text are transformed to a vector. For each language and source a minimum
covariance determinant estimate (the mean and covariance of the three quarters of the rows that lie
closest together) is found by concentration steps, and rows whose Mahalanobis distance from it is
too large are rejected.

Only DataFrame functions run here. A concentration step is one aggregation: rows are binned by their
distance, counts and moments are summed for each group and bin before the shuffle, and a running sum
over the few bins of a group gives the moments of its closest rows. Vectors are whole numbers, so
the sums are exact and the result does not depend on the order of rows.

Defined results: a null or empty text has zero statistics and fails the base rules; a null language
or source is a group value of its own; groups with fewer than ``MIN_ROWS`` rows that pass the base rules
share one pooled estimate, and where even the pool has fewer, it is judged by an estimate of all rows that
pass them, however few these are; repeated rows count each; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import BLANKS, once, table, text_content, without
from seasonflow.llm.registry import query
from seasonflow.session import settle

WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Units of a vector's whole numbers.
UNIT = 256
#: Share of a group's rows that the estimate rests on, and the factor that makes its covariance
#: consistent for normal rows in five dimensions.
CORE, CONSISTENCY = 0.75, 1.41
STEPS = 4
MIN_ROWS = 200
#: Files of a table of estimates, one row for each group: many near-empty files would seem too large to
#: broadcast, and the join would deal all rows of a group to one task.
FILES = 4
#: No direction counts as narrower than this (in vector units): statistics that are zero in almost
#: every clean text would otherwise reject every text that has any.
LEAST_SPREAD = (0.5, 0.12, 0.06, 0.6, 0.18)
#: Squared distance above which a row is rejected: the 0.9999 quantile of the chi-square law.
CUTOFF = 25.74
BINS = 192

VECTOR = tuple(f"v{i}" for i in range(5))
PAIRS = tuple((i, j) for i in range(5) for j in range(i + 1))


def _words(text: Column) -> Column:
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[ \t-\r]+"))


def _repeat_words(positions: Column) -> Column:
    """Words that windows at these sorted positions cover."""
    steps = F.zip_with(
        positions, F.slice(positions, 2, F.greatest(F.size(positions), F.lit(1))),
        lambda here, after: F.least(F.lit(WINDOW), F.coalesce(after - here, F.lit(WINDOW))),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) to every row."""
    kept = docs.columns
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    one = docs.select(*kept, once(_words(F.col(text)).alias("__words"), lines.alias("__lines")))
    size = F.size("__words")
    windows = F.when(size < WINDOW, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(size - (WINDOW - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice("__words", i, WINDOW)),
        )
    )
    two = one.select(
        *kept,
        once(
            size.cast("long").alias("n_words"),
            F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            windows.alias("__windows"),
        ),
    )
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines")
    # most texts repeat no window: only the others pay for the sort
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.select(*kept, *stats, once(F.when(repeats, placed).alias("__placed")))
    same = F.zip_with(
        F.slice("__placed", 1, F.size("__placed") - 1), F.slice("__placed", 2, F.size("__placed") - 1),
        lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>")),
    )
    found = F.when(F.col("__placed").isNotNull(), F.sort_array(F.array_distinct(F.flatten(same))))
    four = three.select(*kept, *stats, once(found.alias("__at")))
    return four.select(
        *kept, *stats, F.coalesce(F.when(F.col("__at").isNotNull(), _repeat_words(F.col("__at"))), F.lit(0)).cast("long").alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics as whole numbers of 1/256."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    parts = (
        F.log1p("n_words"),
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / (F.col("n_symbols") + F.col("word_chars") + 1)),
        F.log1p("n_dup_lines"),
        F.sqrt(F.col("n_repeat_words") / words),
    )
    return stats.withColumns({v: F.round(p * UNIT).cast("long") for v, p in zip(VECTOR, parts)})


def _with_groups(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Adds the group of a row: a string of its keys, or null for the pool of small groups."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in keys]
    named = rows.withColumn("__group", F.to_json(F.array(*parts)))
    counts = settle(named.where(~F.col("base_failed")).groupBy("__group").count())
    large = settle(counts.where(F.col("count") >= MIN_ROWS).select(F.col("__group").alias("__large")))
    return named.join(large, F.col("__group") == F.col("__large"), "left").withColumn("__group", F.coalesce("__large", F.lit("pool"))).drop("__large")


def _estimated(sound: DataFrame) -> DataFrame:
    """The estimate of every group."""
    estimates = settle(_first_estimates(sound).repartition(FILES))
    for _ in range(STEPS):
        estimates = settle(_concentrated(sound, estimates).repartition(FILES))
    return estimates


def _first_estimates(rows: DataFrame) -> DataFrame:
    """For each group the medians and quartile ranges as a centre and a diagonal covariance."""
    stacked = rows.select("__group", F.posexplode(F.array(*VECTOR)).alias("part", "value")).groupBy("__group", "part", "value").count()
    order = Window.partitionBy("__group", "part").orderBy("value")
    # the values are whole numbers of a bounded range, whatever the number of rows
    ranked = stacked.withColumn("below", F.sum("count").over(order)).withColumn("all", F.sum("count").over(Window.partitionBy("__group", "part")))
    at = lambda q: F.min(F.when(F.col("below") >= F.col("all") * q, F.col("value")))
    spread = ranked.groupBy("__group", "part").agg(at(0.5).alias("middle"), ((at(0.75) - at(0.25)) / 1.349).alias("scale"), F.max("all").alias("rows"))
    pick = lambda i, c: F.max(F.when(F.col("part") == i, F.col(c)))
    columns = [pick(i, "middle").cast("double").alias(f"m{i}") for i in range(5)]
    for i, j in PAIRS:
        columns.append((pick(i, "scale") * pick(i, "scale") if i == j else F.lit(0.0)).alias(f"c{i}{j}"))
    return _factors(spread.groupBy("__group").agg(F.max("rows").alias("rows"), *columns))


def _factors(estimates: DataFrame) -> DataFrame:
    """Replaces the covariance, widened to the least spread, by its Cholesky factor."""
    out = estimates
    for i, j in PAIRS:
        value = F.col(f"c{i}{j}")
        if i == j:
            value = value + (LEAST_SPREAD[i] * UNIT) ** 2
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # the widening makes every pivot positive but for rounding
        value = F.sqrt(F.greatest(value, F.lit(1.0))) if i == j else value / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    return out.select("__group", "rows", *(f"m{i}" for i in range(5)), *(f"l{i}{j}" for i, j in PAIRS))


def with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance by forward substitution."""
    out = rows.join(estimates, "__group", "left")
    for i in range(5):
        value = F.col(VECTOR[i]) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    square = reduce(lambda a, b: a + b, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(5)))
    return out.select(*rows.columns, "rows", square.alias("distance"))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: moments of each group's closest rows."""
    far = with_distance(rows, estimates)
    bin_of = F.least(F.floor(F.log2(1 + F.col("distance")) * 16), F.lit(BINS - 1)).cast("int")
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)]
    sums += [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p{i}{j}") for i, j in PAIRS]
    binned = far.groupBy("__group", bin_of.alias("bin")).agg(F.count("*").alias("n"), *sums)
    order = Window.partitionBy("__group").orderBy("bin")
    counted = binned.withColumn("upto", F.sum("n").over(order)).withColumn("rows", F.sum("n").over(Window.partitionBy("__group")))
    core = counted.where(F.col("upto") - F.col("n") < F.col("rows") * CORE)
    names = [f"s{i}" for i in range(5)] + [f"p{i}{j}" for i, j in PAIRS]
    total = core.groupBy("__group").agg(F.max("rows").alias("rows"), F.sum("n").alias("n"), *(F.sum(c).cast("double").alias(c) for c in names))
    moments = [(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(5)]
    moments += [(CONSISTENCY * (F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n"))).alias(f"c{i}{j}") for i, j in PAIRS]
    return _factors(total.select("__group", "rows", *moments))


def judged(rows: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Adds base_failed, distance and kept to rows that have the statistics and the keys.

    Estimates rest on the rows that pass the base rules; every row is measured.
    """
    measured = settle(vectors(rows).withColumn("base_failed", base_failed()))  # texts are read once
    grouped = settle(_with_groups(measured, keys))
    sound = grouped.where(~F.col("base_failed")).select("__group", *VECTOR)
    estimates = _estimated(sound)
    pool = F.col("__group") == "pool"
    if estimates.where(pool & (F.col("rows") >= MIN_ROWS)).isEmpty() and not grouped.where(pool).isEmpty():
        everything = _estimated(sound.withColumn("__group", F.lit("pool")))
        estimates = settle(estimates.where(~pool).unionByName(everything).repartition(FILES))
    far = with_distance(grouped, estimates)
    outlier = F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return far.withColumn("kept", ~F.col("base_failed") & ~outlier).drop("__group", "rows", *VECTOR)


def rejected_keys(docs: DataFrame) -> DataFrame:
    """doc_id, statistics, base_failed, distance and kept of every document."""
    return judged(statistics(docs.select("doc_id", "lang", "source", "text")).drop("text"))


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_keys(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 3).alias("distance"),
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the estimates keep. A verdict depends on text, language and source."""
    content = {**text_content(), "lang": F.col("lang"), "source": F.col("source")}
    names = [n for n in content if n not in ("lang", "source")]
    rows = docs.select("text", "lang", "source", *(content[n].alias(n) for n in names))
    found = judged(statistics(rows).drop("text"))
    return without(docs, found.where("NOT kept").select(*content), content)
