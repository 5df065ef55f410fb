"""Quality rules: n-gram log-likelihood ratio between trusted texts and the raw corpus.

Word unigrams and bigrams are hashed into a fixed number of slots. The raw
multinomial counts the n-grams of every document; the target multinomial those
of trusted documents. A document's score is the mean over its n-grams of
ln(p_target / p_raw), in whole millionths, so that every run gives the same
verdict; it is kept when no base rule fails and the score reaches the threshold.

All of it is DataFrame and SQL functions. Slot counts are summed before the
shuffle. Every trusted document is counted: those whose id shares one of a fixed
number of marks with a trusted id (a broadcast of that size at most) are joined
with the trusted ids, so that no other text is ever shuffled. The weights, one
number a slot, are a scalar subquery.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; without trusted documents every weight is 0 and only base rules
decide; a row with a null id is judged like any other and never trusted;
repeated rows each get their row and count each time; an empty table gives no
rows; other columns, whatever their names, are handed on by ``keep_good`` and
ignored by ``quality_rules``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

SLOTS = 1 << 16
#: Marks of trusted ids; their number is fixed, so they may be broadcast.
MARKS = 1 << 18
#: Occurrences in trusted texts by which both counts of a slot are smoothed.
PRIOR = 4
#: Least mean log ratio of a kept document, in millionths.
THRESHOLD = -150_000
MIN_WORDS = 50


def words_column(text: Column) -> Column:
    """Words of a text, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic."""
    return (labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
            .select("doc_id").distinct())


def _of_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of trusted documents."""
    def mark(rows: DataFrame) -> DataFrame:
        return rows.withColumn("mark", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(MARKS)))

    marks = mark(trusted.select("doc_id")).select("mark").distinct()
    return (mark(docs.select("doc_id", "text").where("doc_id is not null"))
            .join(F.broadcast(marks), "mark", "left_semi")
            # one plan at every size: what passes the marks is shuffled once
            .join(trusted.select("doc_id").hint("merge"), "doc_id", "left_semi"))


def _slot_rows(docs: DataFrame, slots: int, name: str) -> DataFrame:
    """slot, ``name``: how often the word unigrams and bigrams of a slot occur in the texts."""
    return (docs.select(words_column(F.col("text")).alias("w"))
            .select("w", F.posexplode("w").alias("i", "a"))
            .select("a", F.get("w", F.col("i") + 1).alias("b"))
            .select(F.explode(F.array(
                F.pmod(F.xxhash64("a"), F.lit(slots)),
                F.when(F.col("b").isNotNull(), F.pmod(F.xxhash64("a", "b"), F.lit(slots)))
            )).alias("slot"))
            .where("slot is not null")
            .groupBy("slot").agg(F.count(F.lit(1)).alias(name)))


def slot_counts(docs: DataFrame, trusted: DataFrame, slots: int) -> DataFrame:
    """slot, raw, target: how often its n-grams occur in all and in trusted documents."""
    return _slot_rows(docs, slots, "raw").join(
        _slot_rows(_of_trusted(docs, trusted), slots, "target"), "slot", "left")


def slot_weights(counts: DataFrame, slots: int) -> DataFrame:
    """One row, column w: for each slot ln(p_target / p_raw) in millionths.

    Both multinomials are smoothed alike: ``PRIOR`` target occurrences and as
    many raw ones as hold that many target ones on average, so that an n-gram
    seen a few times says little and one never seen nothing.
    """
    spark = counts.sparkSession
    every = spark.range(slots).join(counts, F.col("id") == F.col("slot"), "left")
    return (every.agg(F.sort_array(F.collect_list(F.struct(
                "id", F.coalesce("raw", F.lit(0)).alias("raw"),
                F.coalesce("target", F.lit(0)).alias("target")))).alias("s"),
                F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
                F.coalesce(F.sum("target"), F.lit(0)).alias("target"))
            .selectExpr(f"""transform(s, x -> if(target = 0, 0L, cast(round(1e6 * (
                ln((x.target + {PRIOR}d) / (x.raw * (target / raw) + {PRIOR}d))
            )) as bigint))) as w"""))


def base_features(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the words ``w``."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def without(chars: str) -> Column:
        return F.char_length(F.translate(text, chars, ""))

    shaped = docs.select(
        "*", words_column(F.col("text")).alias("w"),
        without(SPACES).cast("long").alias("word_chars"),
        (F.char_length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"),
                 lambda line: F.char_length(F.translate(line, SPACES, "")) > 0).alias("lines"))
    sized = shaped.select(
        "*", F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""if(size(w) >= 3, transform(sequence(0, size(w) - 3),
            i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))), array())""").alias("tri")
    ).drop("lines")
    # most texts repeat no window: only the others sort theirs
    sorted_ = sized.select("*", F.expr("""
        if(size(array_distinct(tri)) < size(tri),
           sort_array(transform(tri, (t, i) -> struct(t, i))), array())""").alias("st")).drop("tri")
    places = sorted_.select("*", F.expr("""
        sort_array(transform(filter(st, (x, k) -> get(st, k - 1).t = x.t or get(st, k + 1).t = x.t),
                             x -> x.i))""").alias("p")).drop("st")
    return places.select("*", F.expr("""
        aggregate(p, struct(-3 as last, 0L as n),
                  (a, x) -> struct(x as last, a.n + least(3, x - a.last) as n)).n
        """).alias("n_repeat_words")).drop("p")


def _judged(docs: DataFrame, trusted: DataFrame, threshold: int, slots: int) -> DataFrame:
    """``docs`` as a struct ``row``, with base features, base_failed, llr and kept."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    weights = slot_weights(slot_counts(rows, trusted, slots), slots)
    scored = (base_features(rows).withColumn("weights", weights.scalar())
              .withColumn("llr", F.expr(f"""
        if(n_words > 0, aggregate(sequence(0, size(w) - 1), 0L, (s, i) -> s
            + get(weights, int(pmod(xxhash64(get(w, i)), {slots}L)))
            + if(i + 1 < size(w),
                 get(weights, int(pmod(xxhash64(get(w, i), get(w, i + 1)), {slots}L))), 0L)), 0L)""")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("llr") >= F.lit(threshold) * (2 * F.col("n_words") - 1))))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: int = THRESHOLD,
                  slots: int = SLOTS) -> DataFrame:
    """Base features and verdict of every (doc_id, text) row; llr_millionths is the sum over its n-grams."""
    return _judged(docs.select("doc_id", "text"), trusted, threshold, slots).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("llr").alias("llr_millionths"))


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: int = THRESHOLD,
              slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` that pass, whatever their other columns are called."""
    # the row number keeps the filter above the features: pushed below, it would repeat them all
    judged = _judged(docs, trusted, threshold, slots).select(
        "row", "kept", F.monotonically_increasing_id().alias("number"))
    return judged.where("kept and number >= 0").select("row.*")
