"""Operator 9: quality rules by distribution divergence, in native functions.

Base counts (words, symbols, repeated lines, repeated three-word windows) are
computed inside each row. The verdict compares two histograms of a document,
character classes and common words, with the references of its language by
the Jensen-Shannon distance. A reference is the mean histogram of all
documents of the language that are long enough; sums are kept in integers, so
any order of addition gives the same reference. Documents too short for a
histogram are not judged by it.

Defined results: null text has no words; a text with fewer than 50 words
fails the base rule; a null or unknown language is a language of its own
whose word histogram has the one bin ``other``; an empty table gives no rows;
repeated rows are judged each on its own; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import documents, saved, words_of
from threadlens.llm.registry import query

#: FIXED VALUES: frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "on", "for", "was", "with", "as", "be", "by", "this", "are", "from", "or"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}
LONGEST_COMMON = max(len(w) for ws in COMMON_WORDS.values() for w in ws)
#: Character classes counted by removal; the rest is lower case and anything else.
CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "punctuation": r"[.,;:!?'\"()\-]+",
           "symbol": r"[#*$%&|<>@+/=_~^`\[\]{}\\]+", "beyond_ascii": r"[^\x00-\x7F]+"}
MIN_WORDS = 50          # base rule, and guard of the character histogram
MIN_WORDS_COMMON = 100  # guard of the word histogram
#: A document may be as far from its reference as this, plus NOISE / sqrt(words):
#: the distance that sampling alone makes shrinks with the root of the length.
MAX_CLASS_DISTANCE = 0.16
MAX_COMMON_DISTANCE = 0.17
NOISE = 1.0
UNIT = 1_000_000_000


def removed(t: Column, pattern: str) -> Column:
    """Code points of t that stand in matches of the pattern."""
    return F.length(t) - F.length(F.regexp_replace(t, pattern, ""))


def repeated_window_words(words: Column, h: Column) -> Column:
    """Words in three-word windows that occur twice or more. ``h`` holds the
    windows' hashes; sorted with their positions, equal ones are neighbours."""
    s = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def found(sorted_: Column) -> Column:
        at = F.filter(sorted_, lambda e, j: (F.get(sorted_, j - 1)["x"] == e["x"]) | (F.get(sorted_, j + 1)["x"] == e["x"]))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))

    # the one-element array binds the sorted windows to a name, so they are sorted once
    many = F.element_at(F.transform(F.array(s), found), 1)
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(many).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """One row per document with its base counts and its two histograms."""
    d = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("t"))
    d = d.withColumn("words", words_of(F.col("t")))
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    d = d.withColumn("h", F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    lists = F.create_map(*[x for k, ws in COMMON_WORDS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in ws]))])
    d = d.withColumn("list", F.coalesce(F.get(F.map_values(F.map_filter(lists, lambda k, v: k == F.col("lang"))), F.lit(0)), F.array().cast("array<string>")))
    d = d.withColumn("common", F.transform(F.filter("words", lambda x: (F.length(x) <= LONGEST_COMMON) & F.array_contains(F.col("list"), F.lower(x))), F.lower))
    d = d.select(
        "doc_id", "lang", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        removed(F.col("t"), r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words"), F.col("h")).alias("n_repeat_words"),
        F.array(*[removed(F.col("t"), p).cast("long") for p in CLASSES.values()]).alias("classes"),
        F.length("t").cast("long").alias("n_chars"),
        F.transform("list", lambda w: (F.size("common") - F.size(F.array_remove("common", w))).cast("long")).alias("commons"))
    white = F.col("n_chars") - F.col("word_chars")
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    commons = F.aggregate("commons", F.lit(0).cast("long"), lambda a, x: a + x)
    return (d.withColumn("classes", F.concat("classes", F.array(white, F.col("n_chars") - white - total)))
            .withColumn("commons", F.concat("commons", F.array(F.col("n_words") - commons))))


def shares(hist: Column) -> Column:
    """The histogram as integers that add up to about UNIT."""
    total = F.aggregate(hist, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(hist, lambda x: F.when(total > 0, F.floor(x.cast("double") * UNIT / total)).otherwise(F.lit(0)).cast("long"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two share arrays."""
    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    def term(x):
        a, b = x["p"].cast("double") / UNIT, x["q"].cast("double") / UNIT
        m = (a + b) / 2
        return (part(a, m) + part(b, m)) / 2

    pairs = F.zip_with(p, q, lambda a, b: F.struct(a.alias("p"), b.alias("q")))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(pairs, F.lit(0.0), lambda s, x: s + term(x))))


def references(rows: DataFrame) -> DataFrame:
    """Mean histograms by language, one row each, over all documents that pass
    the guard. The bins are summed as columns, so partial sums meet only."""
    n_class = len(CLASSES) + 2
    n_common = max(map(len, COMMON_WORDS.values())) + 1
    ok, long_ = F.col("n_words") >= MIN_WORDS, F.col("n_words") >= MIN_WORDS_COMMON
    cols = [F.sum(F.when(ok, F.get("class_shares", F.lit(i)))).alias(f"c{i}") for i in range(n_class)]
    cols += [F.sum(F.when(long_, F.get("common_shares", F.lit(i)))).alias(f"w{i}") for i in range(n_common)]
    g = rows.groupBy("lang").agg(F.count(F.when(ok, 1)).alias("nc"), F.count(F.when(long_, 1)).alias("nw"), *cols)

    def mean(prefix, n, by):
        return F.filter(F.array(*[F.floor(F.col(f"{prefix}{i}") / F.col(by)).cast("long") for i in range(n)]), lambda x: x.isNotNull())

    return g.select(F.col("lang").alias("ref_lang"), mean("c", n_class, "nc").alias("ref_classes"), mean("w", n_common, "nw").alias("ref_commons"))


def judge(docs: DataFrame) -> DataFrame:
    rows = counted(docs).withColumn("class_shares", shares(F.col("classes"))).withColumn("common_shares", shares(F.col("commons")))
    rows = saved(rows.drop("classes", "commons"), "quality-counts")
    ref = references(rows)
    j = rows.join(ref, rows["lang"].eqNullSafe(ref["ref_lang"]))
    j = j.withColumn("class_distance", F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("class_shares"), F.col("ref_classes"))))
    j = j.withColumn("common_distance", F.when(F.col("n_words") >= MIN_WORDS_COMMON, js_distance(F.col("common_shares"), F.col("ref_commons"))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    slack = F.lit(NOISE) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE + slack) | (F.coalesce("common_distance", F.lit(0.0)) > MAX_COMMON_DISTANCE + slack)
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & ~far).alias("kept"),
                    F.round("class_distance", 6).alias("class_distance"), F.round("common_distance", 6).alias("common_distance"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))
