"""Quality rules with risk-controlled thresholds.

Base rules fail a document outright. Four further rules measure a share of the
text; their cutoffs are not given but earned. Labelled documents are the
holdout. In every stratum and for every rule a fixed sequence of cutoffs, from
lenient to strict, is tested: the hypothesis "this cutoff rejects more than
``risk`` of the good documents" is refuted only by an exact binomial test,
which is the same as an exact (Clopper-Pearson) upper bound below ``risk``.
Testing stops at the first cutoff that is not refuted, so a rule costs no
correction for its number of cutoffs; the error probability is divided by the
number of rules and strata (Bonferroni). Among the certified cutoffs the one with
the best balance of rejected bad and rejected good documents is used, the more
lenient one if equal. With probability ``1 - error`` no rule in any stratum
rejects more than ``risk`` of the good documents of that stratum.

A stratum without enough labels certifies nothing, and its documents are only
subject to the base rules. Copies of one text count once in the holdout, or the
test would take them for independent evidence. Contradicting labels of one
document or text count as good.

Cases: null and empty texts have zero words and fail the base rules. A null
language is the stratum ``other``, like every language that is not listed.
Repeated rows are kept and judged alike. Without labels only the base rules act.
Equality of windows is judged on 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.graph import stored

# Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
UPPER = r"[A-Z]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# Risk control.
RISK = 0.02
ERROR = 0.05
STRATA = ("en", "de", "fr", "es")
RULES = ("symbols", "upper", "repeated_words", "repeated_lines")
STEPS = 40
GOOD_WEIGHT = 10


def signals(docs: DataFrame, repeat: int = REPEAT_WINDOW) -> DataFrame:
    """Adds the word counts of whole texts to ``docs``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and, for the
    further rules, ``n_upper, n_distinct, n_lines``.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.withColumn("_text", text).withColumn(
        "_words", F.filter(F.split("_text", SPACE), lambda w: w != "")).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)))
    n_words = F.size("_words")
    # Hash of every word, then of every window of hashes.
    hashed = split.select(
        *docs.columns, n_words.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_text", F.lit(UPPER)).cast("long").alias("n_upper"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    windows = hashed.withColumn(
        "_windows", F.when(F.col("n_words") < repeat, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (repeat - 1)),
                        lambda i: F.xxhash64(F.slice("_hashes", i, repeat))))).drop("_hashes")
    ordered = windows.withColumn(
        "_ordered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                           F.array_sort(F.transform(
                               "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("_windows")

    def hash_at(i: Column) -> Column:
        return F.try_element_at(F.col("_ordered"), i)["h"]

    # A window is repeated if the one before or after it in the order is equal.
    places = ordered.withColumn("_places", F.sort_array(F.transform(
        F.filter(
            F.transform("_ordered", lambda w, j: F.struct(
                w["i"].alias("i"),
                (((j > 0) & (w["h"] == hash_at(F.greatest(j, F.lit(1))))) | w["h"].eqNullSafe(
                    hash_at(j + 2))).alias("repeated"))),
            lambda w: w["repeated"]),
        lambda w: w["i"]))).drop("_ordered")
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda state, i: F.struct(
            (state["n"] + (i + repeat) - F.greatest(state["end"], i)).cast("long").alias("n"),
            (i + repeat).alias("end")),
        lambda state: state["n"])
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_places")


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def shares(rules: Sequence[str] = RULES) -> list[Column]:
    """Step from 0 to STEPS that each rule's share reaches, as integer arithmetic.

    A cutoff ``c`` rejects a share of more than ``c / STEPS``: a document's step
    is the number of cutoffs that would reject it.
    """
    parts = {
        "symbols": (F.col("n_symbols"), F.col("word_chars")),
        "upper": (F.col("n_upper"), F.col("word_chars")),
        "repeated_words": (F.col("n_words") - F.col("n_distinct"), F.col("n_words")),
        "repeated_lines": (F.col("n_dup_lines"), F.col("n_lines")),
    }
    # Cutoffs below share * STEPS: ceil(share * STEPS), zero for an empty whole.
    return [F.when(whole <= 0, F.lit(0)).otherwise(
        F.least(F.floor((part * STEPS + whole - 1) / F.greatest(whole, F.lit(1))),
                F.lit(STEPS))).cast("int").alias(rule)
            for rule, (part, whole) in ((rule, parts[rule]) for rule in rules)]


def stratum(lang: Column, strata: Sequence[str] = STRATA) -> Column:
    return F.when(lang.isin(list(strata)), lang).otherwise(F.lit("other"))


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(X <= k) for X binomial in ``n`` with probability ``risk``.

    Only called for k up to risk * n, where the terms fall towards zero. Terms
    follow each other by their ratio; logarithms keep them in range.
    """
    odds = F.lit(risk / (1 - risk))
    start = F.struct((n * F.log1p(F.lit(-risk))).alias("term"),
                     (n * F.log1p(F.lit(-risk))).alias("sum"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i * odds)
        return F.struct(term.alias("term"), (F.greatest(term, state["sum"]) + F.log1p(F.exp(
            -F.abs(term - state["sum"])))).alias("sum"))
    steps = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return F.exp(F.aggregate(steps, start, add, lambda state: state["sum"]))


def holdout(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per labelled distinct text that passes the base rules.

    ``measured`` has ``doc_id, stratum, text_hash, base_failed`` and the steps.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.max("quality").alias("good"))
    return (measured.filter(~F.col("base_failed")).join(known, "doc_id")
            .groupBy("stratum", "text_hash", *RULES).agg(F.max("good").alias("good")))


def certified_cutoffs(held: DataFrame, risk: float = RISK, error: float = ERROR,
                      strata: Sequence[str] = STRATA, good_weight: int = GOOD_WEIGHT) -> DataFrame:
    """Rows ``stratum, rule, cutoff``: at most one per stratum and rule."""
    steps = held.select("stratum", "good", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("step")) for rule in RULES
    ])).alias("r")).select("stratum", "good", "r.rule", "r.step")
    counted = steps.groupBy("stratum", "rule", "step").agg(
        F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") == 0).alias("bad"))
    # Every cutoff from STEPS - 1 down; it rejects the steps above it.
    grid = counted.groupBy("stratum", "rule").agg(F.sum("good").alias("n")).withColumn(
        "cutoff", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))))
    down = Window.partitionBy("stratum", "rule").orderBy(F.col("cutoff").desc())
    rejected = grid.join(counted.withColumn("cutoff", F.col("step") - 1).drop("step"),
                         ["stratum", "rule", "cutoff"], "left").na.fill(0, ["good", "bad"])
    summed = rejected.withColumn("k", F.sum("good").over(down)).withColumn(
        "bad", F.sum("bad").over(down))
    level = error / (len(RULES) * (len(strata) + 1))
    tested = summed.withColumn("refuted", F.when(
        F.col("k") > risk * F.col("n"), F.lit(False)).otherwise(
        binomial_tail(F.col("k"), F.col("n"), risk) <= level))
    certified = tested.withColumn("certified", F.min("refuted").over(down)).filter("certified")
    gain = F.col("bad") - good_weight * F.col("k")
    return (certified.filter(gain > 0).groupBy("stratum", "rule")
            .agg(F.max_by("cutoff", F.struct(gain, F.col("cutoff"))).alias("cutoff")))


def judge(measured: DataFrame, cutoffs: DataFrame,
          strata: Sequence[str] = STRATA) -> DataFrame:
    """Adds ``kept`` and ``rejected_by`` (the rules that reject, or ``base``).

    The cutoffs are one row per stratum, at most ``len(strata) + 1``; hence the
    broadcast.
    """
    wide = cutoffs.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_{rule}") for rule in RULES])
    hit = [F.when(F.col(rule) > F.col(f"_{rule}"), F.lit(rule)) for rule in RULES]
    by = F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(
        F.array_compact(F.array(*hit)))
    return (measured.join(F.broadcast(wide), "stratum", "left")
            .withColumn("rejected_by", by).withColumn("kept", F.size("rejected_by") == 0)
            .drop(*[f"_{rule}" for rule in RULES]))


def measure(docs: DataFrame, strata: Sequence[str] = STRATA) -> DataFrame:
    """Signals, strata and steps of ``doc_id, text, lang``; the text is left out."""
    return signals(docs.select("doc_id", "text", "lang")).select(
        "doc_id", stratum(F.col("lang"), strata).alias("stratum"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "n_words", "word_chars",
        "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        *shares())


def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK,
                     error: float = ERROR, strata: Sequence[str] = STRATA) -> DataFrame:
    """Signals and verdict of every document: one pass over the texts.

    The signals, a few numbers per document, are written to the shared folder;
    thresholds and verdicts are derived from there.
    """
    measured = stored(measure(docs, strata), "quality")
    cutoffs = certified_cutoffs(holdout(measured, labels), risk, error, strata)
    return judge(measured, cutoffs, strata)


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK,
              error: float = ERROR) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    Verdicts are matched to rows by id and hash of the text, which decide them
    together with the language; a row is kept once however often it is repeated.
    """
    verdicts = quality_verdicts(docs, labels, risk, error)
    kept = verdicts.filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        F.col("stratum").alias("_stratum")).distinct()
    same = (docs["doc_id"].eqNullSafe(kept["_id"])
            & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == kept["_hash"])
            & (stratum(docs["lang"]) == kept["_stratum"]))
    return docs.join(kept, same, "left_semi")
