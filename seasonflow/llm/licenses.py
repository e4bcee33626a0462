"""Licence scans by ordered signature rules.

A text becomes its lower-case words with one blank between them. One expression finds the rules' keywords in
it, and only the rules whose keyword is there are tried (most texts have none). A rule's pattern is matched
from word to word: the pieces between its matches tell where these stand. Of overlapping detections one is
suppressed if it lies within another of a better level, within a longer one of its own level, or at the same
place as an earlier rule of its level. The base phrases are rules too; what they find is always reported.

Only DataFrame functions run here. Detections of a text are ordered once and compared with running maxima, so a
text with many of them costs no pairs, and the text itself is not shuffled.

Defined results: a null or empty text has no words, no place and no label; A-Z and letters beyond ASCII are
lower-cased, which changes no word's place; repeated rows are scanned one by one; a null id is carried along; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import once, table
from seasonflow.llm.license_rules import BASE, Rule, rules
from seasonflow.llm.registry import query

#: The word rule's separators, of texts in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEVELS = (1, 2, 3, 4)
#: How sure a detection of each level is.
CONFIDENCE = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.4}


def _blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _matches(norm: Column, rule: Column) -> Column:
    """rule, level, label, base, at (which of the rule's matches), gap (blanks before it) and width of every match."""
    pattern = rule["pattern"]
    gaps = F.transform(F.split(norm, pattern), _blanks)
    widths = F.transform(F.regexp_extract_all(norm, pattern, F.lit(0)), _blanks)
    both = F.zip_with(gaps, widths, lambda gap, width: F.struct(gap.alias("gap"), width.alias("width")))
    found = F.filter(both, lambda x: x["width"].isNotNull())  # what follows the last match has no width
    return F.transform(
        found,
        lambda x, i: F.struct(rule["rule"].alias("rule"), rule["level"].alias("level"), rule["label"].alias("label"), rule["base"].alias("base"), i.alias("at"), x["gap"].alias("gap"), x["width"].alias("width")),
    )


def detections(docs: DataFrame, key: str = "doc_id", text: str = "text", listed: list[Rule] | None = None) -> DataFrame:
    """One row for each detection, and one with null rule for a document without any: row (the document's
    number), doc_id, n_words, rule, level, label, base, first_word, last_word and suppressed."""
    listed = rules() if listed is None else listed
    table_of_rules = F.array(
        *(
            F.struct(
                F.lit(i).alias("rule"), F.lit(r.level).alias("level"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                F.lit(_bounded(r.pattern)).alias("pattern"), F.lit(i < len(BASE) and r in BASE).alias("base"),
            )
            for i, r in enumerate(listed)
        )
    )
    words = F.btrim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS, " "))
    keywords = _bounded("|".join(sorted({r.keyword for r in listed})))
    one = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), once(F.concat(F.lit(" "), words, F.lit(" ")).alias("norm")))
    two = one.select(
        "row", "doc_id", "norm",
        once(
            F.when(F.col("norm") == "  ", 0).otherwise(_blanks(F.col("norm")) - 1).cast("long").alias("n_words"),
            F.array_distinct(F.regexp_extract_all("norm", F.lit(keywords), F.lit(0))).alias("keywords"),
        ),
    )
    tried = F.filter(table_of_rules, lambda r: F.array_contains("keywords", r["keyword"]))
    found = F.when(F.size("keywords") > 0, F.flatten(F.transform(tried, lambda r: _matches(F.col("norm"), r))))
    each = two.select("row", "doc_id", "n_words", F.explode_outer(found).alias("m")).select("row", "doc_id", "n_words", "m.*")
    dealt = each.repartition("row")  # both windows below use this order of rows
    along = Window.partitionBy("row", "rule").orderBy("at")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    first = F.sum("gap").over(along) + F.coalesce(F.sum("width").over(before), F.lit(0)) - 1
    placed = dealt.withColumn("first_word", first).withColumn("last_word", F.col("first_word") + F.col("width"))
    # whatever holds a detection comes before it here
    earlier = Window.partitionBy("row").orderBy("first_word", F.desc("last_word"), "level", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.when(F.col("level") >= k, F.max(F.when(F.col("level") == k, F.col("last_word"))).over(earlier)) for k in LEVELS]
    held = reduce(lambda a, b: a | b, (F.coalesce(r >= F.col("last_word"), F.lit(False)) for r in reach))
    return placed.select("row", "doc_id", "n_words", "rule", "level", "label", "base", "first_word", "last_word", held.alias("suppressed"))


def labelled(docs: DataFrame, key: str = "doc_id", text: str = "text", listed: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and n_detections of every row."""
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    stays = ~F.col("suppressed") | F.col("base")
    sure = reduce(lambda rest, k: F.when(F.col("level") == k, F.lit(CONFIDENCE[k])).otherwise(rest), LEVELS, F.lit(None).cast("double"))
    return (
        detections(docs, key, text, listed)
        .groupBy("row", "doc_id", "n_words")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("last_word"),
            joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
            joined(F.collect_set(F.when(stays, F.col("label")))).alias("labels"),
            F.coalesce(F.max(F.when(stays, sure)), F.lit(0.0)).alias("score"),
            F.count_if(F.col("rule").isNotNull() & ~F.col("suppressed")).alias("n_detections"),
        )
        .drop("row")
    )


@query("op12_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences named in every document."""
    return labelled(table(spark, folder, "documents"))
