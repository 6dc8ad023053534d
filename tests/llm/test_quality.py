import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from viewtide.llm import quality
from viewtide.llm.queries import op1_quality_rules


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def test_query_counts_like_plain_python(spark, table):
    texts = {row["doc_id"]: row["text"] for row in table("documents").collect()}
    rows = op1_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row)[1:7] == counts(texts[row["doc_id"]])
        assert not (row["base_failed"] and row["kept"])


def test_awkward_rows(spark, awkward, clashing):
    labels = spark.createDataFrame([(4, 1, None), (None, 0, 0), (5, None, 1)],
                                   "doc_id LONG, quality INT, toxic INT")
    rows = quality.quality_verdicts(clashing(awkward), labels).collect()
    assert len(rows) == awkward.count()
    assert all(row["base_failed"] and not row["kept"] for row in rows if row["n_words"] < 20)
    for row in rows:
        if row["doc_id"] == 4:
            assert (row["n_words"], row["n_repeat_words"]) == (20_001, 20_000)
            assert row["rejected_by"] == ["base"]
    empty = awkward.filter("false")
    assert quality.keep_good(empty, labels).columns == awkward.columns
    assert quality.keep_good(empty, labels.filter("false")).count() == 0


@pytest.mark.parametrize(("k", "n"), [(0, 10), (3, 500), (9, 500), (40, 3000)])
def test_binomial_tail_is_exact(spark, k, n):
    expected = sum(comb(n, i) * 0.02 ** i * 0.98 ** (n - i) for i in range(k + 1))
    found = spark.range(1).select(quality.binomial_tail(
        F.lit(k).cast("long"), F.lit(n).cast("long"), 0.02)).first()[0]
    assert found == pytest.approx(expected, rel=1e-9)


def brute_cutoffs(held, risk, error):
    """The same decisions, one cutoff after another."""
    best = {}
    level = error / (len(quality.RULES) * (len(quality.STRATA) + 1))
    for stratum in {row["stratum"] for row in held}:
        rows = [row for row in held if row["stratum"] == stratum]
        n = sum(row["good"] for row in rows)
        for rule in quality.RULES:
            top = (0, None)
            for cutoff in range(quality.STEPS - 1, -1, -1):
                hit = [row["good"] for row in rows if row[rule] > cutoff]
                k = sum(hit)
                if k > risk * n or float(sum(
                        comb(n, i) * Fraction(risk) ** i * (1 - Fraction(risk)) ** (n - i)
                        for i in range(k + 1))) > level:
                    break
                gain = len(hit) - k - quality.GOOD_WEIGHT * k
                if gain > top[0]:
                    top = (gain, cutoff)
            if top[1] is not None:
                best[stratum, rule] = top[1]
    return best


def test_cutoffs_are_those_of_the_fixed_sequence(spark):
    rows = [("en", i, int(i % 10 > 0), i % 40 // 10 if i % 10 else 5 + i % 7, 0, i % 3, 0)
            for i in range(2000)]
    rows += [("de", i, 1, 0, 0, 0, 0) for i in range(30)] + [("de", 99, 0, 40, 40, 40, 40)]
    held = spark.createDataFrame(
        rows, "stratum STRING, text_hash LONG, good INT, symbols INT, upper INT, "
              "repeated_words INT, repeated_lines INT")
    found = {(row["stratum"], row["rule"]): row["cutoff"]
             for row in quality.certified_cutoffs(held, 0.02, 0.05).collect()}
    assert found == brute_cutoffs(held.collect(), 0.02, 0.05)
    assert ("en", "symbols") in found and not any(stratum == "de" for stratum, _ in found)


def test_copies_are_one_piece_of_evidence(spark, documents):
    text = " ".join(f"word{i}" for i in range(30))
    measured = quality.measure(documents(*[(i, text) for i in range(50)]))
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id LONG, quality INT")
    assert quality.holdout(measured, labels).count() == 1
