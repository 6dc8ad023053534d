"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers read a clause word by word. The *insult* transducer accepts a
learned lexicon of words and word beginnings, each with a weight; the *threat*
transducer accepts verbs of harm; *target*, *negation* and *reported speech*
accept the words that change what an insult or threat amounts to. Their product
is one machine whose state says whether the clause is negated here, reports what
others said, and addresses someone. Every accepted insult or threat is an event
of the kind that the state gives it, so "you are not an idiot" and "idiots like
you" are different events, and a word of the lexicon alone decides nothing: the
weight of each kind of event is learned.

A document's events are summed by kind; a logistic function of these sums is its
score. Labels are only read for documents outside the held-out fold. Lexicon
and weights are fitted on a bounded sample of those (SAMPLE documents, those
whose hashed ids are smallest). All documents are scored as whole texts.

Cases: null, empty and wordless texts have no events and get the score of a text
without events. Repeated rows are scored alike. Contradicting labels of one id
count as toxic. A null id belongs to the held-out fold. Without any label of
either class the lexicon is empty and all scores are equal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
SAMPLE = 12_000
LEXICON = 5_000
PREFIXES = (4, 5, 6)
MIN_EVIDENCE = 30.0
MIN_PRECISION = 0.8
REMEMBERED = 500_000

# Word lists of the grammar, in four languages.
THREAT = frozenset(
    "kill kills hurt shoot stab burn beat murder destroy strangle "
    "töten umbringen schlagen verletzen erschießen verbrennen "
    "tuer frapper brûler blesser égorger matar golpear quemar herir".split())
TARGET = frozenset(
    "you your yours yourself u ur dich dir euch dein deine euer toi tes vous votre vos "
    "ti tus usted ustedes vosotros".split())
NEGATION = frozenset(
    "not never no nor isn't aren't don't won't nicht kein keine nie niemals pas jamais ni "
    "nunca tampoco".split())
REPORT = frozenset(
    "said says say called calls wrote claimed quoted sagte sagt schrieb nannte "
    "dit écrit appelé dijo dice escribió llamó".split())

# Classes of words; the end of a clause is a flag on top.
OTHER, INSULT, THREATEN, ADDRESS, NEGATE, REPORTED = range(6)
CLAUSE_END = 8
REACH = 3  # words that a negation reaches

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_STOP = re.compile(r"[.!?;:]['\")\]]*$")
_SPLIT = r"[\x20\x09-\x0D]+"
_NOT_WORD = r"(^[^\p{L}\p{N}]+)|([^\p{L}\p{N}]+$)"


@dataclass(frozen=True)
class Transducer:
    """Arcs ``(state, class) -> state``; classes without an arc leave the state
    as ``other`` says. The output of a step is its new state."""

    start: int
    arcs: dict[tuple[int, int], int]
    other: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, word_class: int) -> int:
        return self.arcs.get((state, word_class), self.other.get(state, state))


NEGATION_MACHINE = Transducer(
    0, {(s, NEGATE): REACH for s in range(REACH + 1)}, {s: s - 1 for s in range(1, REACH + 1)})
REPORT_MACHINE = Transducer(0, {(0, REPORTED): 1})
TARGET_MACHINE = Transducer(0, {(0, ADDRESS): 1})
ACCEPTED = {INSULT: 0, THREATEN: 1}
# insult or threat, negated or not, reported or not, addressed or not
KINDS = list(product(range(2), repeat=4))


@lru_cache(maxsize=1)
def grammar() -> tuple[dict, tuple]:
    """The product of the transducers: arcs ``(state, class) -> (state, event)``.

    An event is ``(insult or threat, negated, reported)``, None where the class is
    not accepted. Whether the clause addresses someone is known at its end.
    """
    machines = (NEGATION_MACHINE, REPORT_MACHINE, TARGET_MACHINE)
    start = tuple(machine.start for machine in machines)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for word_class in range(6):
            after = tuple(m.step(s, word_class) for m, s in zip(machines, state, strict=True))
            event = None
            if word_class in ACCEPTED:
                event = (ACCEPTED[word_class], int(state[0] > 0), after[1])
            arcs[state, word_class] = (after, event)
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return arcs, start


def clause_events(classes: Sequence[int], weights: Sequence[float]) -> np.ndarray:
    """Weights of the events of a text, summed by kind."""
    arcs, start = grammar()
    sums = np.zeros(len(KINDS))
    state, pending = start, []

    def close() -> None:
        for (what, negated, reported), weight in pending:
            sums[8 * what + 4 * negated + 2 * reported + state[2]] += weight
        pending.clear()

    for code, weight in zip(classes, weights, strict=True):
        state, event = arcs[state, code % CLAUSE_END]
        if event:
            pending.append((event, weight))
        if code >= CLAUSE_END:
            close()
            state = start
    close()
    return sums


class Lexicon(dict):
    """Class and weight of every word met so far; unknown ones are looked up."""

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries

    def __missing__(self, token: str) -> tuple[int, float]:
        if len(self) > REMEMBERED:
            self.clear()
        word = _EDGES.sub("", token)
        weight = max((self.entries.get("=" + word, 0.0), *(
            self.entries.get("^" + word[:n], 0.0) for n in PREFIXES if len(word) >= n)))
        code = (INSULT if weight > 0 else THREATEN if word in THREAT else
                ADDRESS if word in TARGET else NEGATE if word in NEGATION else
                REPORTED if word in REPORT else OTHER)
        value = self[token] = (code + CLAUSE_END * bool(_STOP.search(token)),
                               weight if weight > 0 else 1.0)
        return value


def events(text: str | None, lexicon: Lexicon) -> np.ndarray | None:
    """Event sums of a whole text, None if it has no event."""
    found = list(map(lexicon.__getitem__, (text or "").lower().split()))
    if not any(code % CLAUSE_END in ACCEPTED for code, _ in found):
        return None
    return clause_events([code for code, _ in found], [weight for _, weight in found])


@dataclass
class ToxicityModel:
    entries: dict[str, float]
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(KINDS)))

    def score(self, sums: np.ndarray | None) -> float:
        value = self.bias if sums is None else self.bias + float(np.log1p(sums) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows ``text, toxic`` of at most ``sample`` labelled ids outside the fold.

    Copies and near-copies, told by the smallest hash of their five-word
    shingles, are one text: else the words of a text that is often copied would
    look like evidence. A group with both labels counts as toxic.
    """
    known = (labels.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), _SPLIT)
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))),
                           lambda i: F.xxhash64(F.slice("words", i, 5)))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .withColumn("words", words).withColumn("group", F.array_min(shingles))
            .groupBy("group").agg(F.max(F.struct("toxic", "text")).alias("row"))
            .select("row.text", "row.toxic"))


def learn_lexicon(rows: DataFrame, prefixes: Sequence[int] = PREFIXES,
                  limit: int = LEXICON) -> dict[str, float]:
    """Words (``=word``) and beginnings (``^begi``) that mark toxic texts.

    Counts documents, not occurrences. An entry needs evidence (a likelihood
    ratio) far beyond what the best of all words reaches by chance, and must be
    mostly found in toxic texts; its weight is the logarithm of its odds.
    """
    words = F.array_distinct(F.transform(
        F.split(F.lower(F.coalesce("text", F.lit(""))), _SPLIT),
        lambda w: F.regexp_replace(w, _NOT_WORD, "")))
    marks = F.array_distinct(F.concat(
        F.transform(words, lambda w: F.concat(F.lit("="), w)),
        *[F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n),
                      lambda w, n=n: F.concat(F.lit("^"), F.substring(w, 1, n)))
          for n in prefixes]))
    total = rows.agg(F.count_if(F.col("toxic") == 1).alias("bad"),
                     F.count_if(F.col("toxic") == 0).alias("good")).first()
    if not total["bad"] or not total["good"]:
        return {}
    counts = (rows.select("toxic", F.explode(marks).alias("mark")).groupBy("mark")
              .agg(F.count_if(F.col("toxic") == 1).alias("a"),
                   F.count_if(F.col("toxic") == 0).alias("b"))
              .filter((F.col("a") >= 3) & (F.col("a") >= MIN_PRECISION * (F.col("a") + F.col("b")))
                      & (F.length("mark") > 1)))
    bad, good = total["bad"], total["good"]
    rate = bad / (bad + good)
    a, b = F.col("a"), F.col("b")
    evidence = 2 * (a * F.log(a / ((a + b) * rate))
                    + F.when(b > 0, b * F.log(b / ((a + b) * (1 - rate)))).otherwise(0))
    weight = F.log((a + 0.5) / (bad + 1)) - F.log((b + 0.5) / (good + 1))
    best = (counts.select("mark", evidence.alias("evidence"), weight.alias("weight"))
            .filter((F.col("evidence") >= MIN_EVIDENCE) & (F.col("weight") > 0))
            .orderBy(F.col("evidence").desc(), "mark").limit(limit))
    return {row["mark"]: row["weight"] for row in best.collect()}


def fit_weights(features: np.ndarray, toxic: np.ndarray, ridge: float = 1.0,
                rounds: int = 30) -> tuple[float, np.ndarray]:
    """Logistic regression by Newton steps, with a ridge on all but the bias."""
    x = np.column_stack([np.ones(len(features)), features])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - toxic) + penalty * beta
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), beta[1:]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Lexicon and weights. The driver gets the lexicon, at most LEXICON entries,
    and the event sums of the sample, 17 numbers for each of its documents."""
    rows = training_sample(docs, labels, sample)
    model = ToxicityModel(learn_lexicon(rows))

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model.entries)
        for frame in frames:
            sums = [events(text, lexicon) for text in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"].astype("int64"), "sums": [
                np.zeros(len(KINDS)) if s is None else s for s in sums]})

    fitted = rows.mapInPandas(summed, "toxic LONG, sums ARRAY<DOUBLE>").collect()
    toxic = np.array([row["toxic"] for row in fitted], float)
    if len(fitted) and 0 < toxic.sum() < len(toxic):
        model.bias, model.weights = fit_weights(
            np.log1p(np.array([row["sums"] for row in fitted])), toxic)
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text",
          output: str = "score") -> DataFrame:
    """The table with the score of every whole text."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        lexicon = _lexicon(tuple(model.entries.items()))
        return texts.map(lambda value: model.score(events(value, lexicon))).astype("float64")
    return docs.withColumn(output, scored(F.coalesce(F.col(text), F.lit(""))))


@lru_cache(maxsize=2)
def _lexicon(entries: tuple) -> Lexicon:
    return Lexicon(dict(entries))
