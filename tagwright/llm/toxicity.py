"""Toxicity by a weighted finite-state grammar over the tokens of a clause."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import leanly, remainder, ship, texts
from tagwright.session import fits_broadcast, written

# The words that the grammar knows by itself.
TARGETS = "you your yours u du dich dir sie ihr euch tu te toi vous votre usted ustedes ti he she they them him her".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas ne jamais nunca ni".split()
REPORTS = "said says say called calls wrote writes quote quoted reported sagte sagt schrieb dit disait dijo dice".split()
INTENTS = "will shall gonna going werde werden vais voy".split()
HARMS = "kill hurt beat shoot stab burn destroy töten schlagen tuer frapper matar".split()

STEM_LENGTHS = (4, 5, 6, 7)
LEAST_TOXIC = 5  # toxic documents with a pattern
LEAST_ODDS = 3.0  # of a pattern in toxic against clean documents, smoothed
MOST_PATTERNS = 20_000  # patterns sent to the workers, the strongest first
FIT_ROWS = 50_000  # labelled documents on which the last weights are fitted, picked by a hash of the id
NEGATION_REACH = 3

CLAUSE_END = re.compile(r"[.,;:!?\n|()\"]")
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
FEATURES = ("clause_sum", "clause_max", "density", "threats")


@dataclass(frozen=True)
class Transducer:
    """States are numbers from 0. ``step(state, kind, weight)`` gives the next state and the weight put out."""

    name: str
    step: Callable[[int, str, float], tuple[int, float]]
    final: Callable[[int], float] = field(default=lambda state: 1.0)


def _insult(state: int, kind: str, weight: float) -> tuple[int, float]:
    return state, weight if kind == "insult" else 0.0


def _threat(state: int, kind: str, weight: float) -> tuple[int, float]:
    # an intent, then a harm, then a target
    if kind == "intent":
        return 1, weight
    if kind == "harm" and state == 1:
        return 2, weight
    if kind == "target" and state == 2:
        return 0, weight + 3.0
    return state, weight


def _negation(state: int, kind: str, weight: float) -> tuple[int, float]:
    left = NEGATION_REACH if kind == "negation" else max(0, state - 1)
    return left, weight * 0.3 if state else weight


def _reported(state: int, kind: str, weight: float) -> tuple[int, float]:
    return (1 if kind == "report" else state), weight * 0.5 if state else weight


def _target(state: int, kind: str, weight: float) -> tuple[int, float]:
    return (1 if kind == "target" else state), weight


GRAMMAR = (
    Transducer("insult", _insult),
    Transducer("threat", _threat),
    Transducer("negation", _negation),
    Transducer("reported speech", _reported),
    Transducer("target", _target, lambda state: 1.5 if state else 1.0),
)


def compose(machines: tuple[Transducer, ...]) -> Transducer:
    """One machine that feeds the weight each machine puts out into the next; its state is that of all of them."""
    numbers: dict[tuple[int, ...], int] = {}
    states: list[tuple[int, ...]] = []

    def number(state: tuple[int, ...]) -> int:
        if state not in numbers:
            numbers[state] = len(states)
            states.append(state)
        return numbers[state]

    number((0,) * len(machines))

    def step(state: int, kind: str, weight: float) -> tuple[int, float]:
        after = []
        for machine, own in zip(machines, states[state]):
            own, weight = machine.step(own, kind, weight)
            after.append(own)
        return number(tuple(after)), weight

    def final(state: int) -> float:
        weight = 1.0
        for machine, own in zip(machines, states[state]):
            weight *= machine.final(own)
        return weight

    return Transducer("+".join(machine.name for machine in machines), step, final)


KINDS = {
    **{word: "target" for word in TARGETS},
    **{word: "negation" for word in NEGATIONS},
    **{word: "report" for word in REPORTS},
    **{word: "intent" for word in INTENTS},
    **{word: "harm" for word in HARMS},
}


class Grammar:
    """Scores the clauses of a text that hold an insult or a harm.

    ``words`` and ``stems`` map patterns to weights: a token is an insult with the weight of itself or else of its
    longest known beginning.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.machine = compose(GRAMMAR)
        self.finder = ahocorasick.Automaton()
        for pattern in {*words, *stems, *HARMS}:
            self.finder.add_word(pattern, len(pattern))
        if len(self.finder):
            self.finder.make_automaton()

    def weight(self, token: str) -> float:
        if token in self.words:
            return self.words[token]
        for length in reversed(STEM_LENGTHS):
            if token[:length] in self.stems and len(token) >= length:
                return self.stems[token[:length]]
        return 0.0

    def clause(self, tokens: list[str]) -> tuple[float, int]:
        """Weight of a clause and the number of threats in it."""
        state, total, threats = 0, 0.0, 0
        for token in tokens:
            weight = self.weight(token)
            kind = "insult" if weight else KINDS.get(token, "other")
            state, out = self.machine.step(state, kind, weight)
            total += out
            threats += not weight and out > 0
        return total * self.machine.final(state), threats

    def features(self, text: str) -> tuple[float, float, float, float]:
        low = text.lower()
        spots = [end for end, _ in self.finder.iter(low)] if len(self.finder) else []
        done, weights, threats = -1, [], 0
        for spot in spots:
            if spot < done:
                continue
            # the last clause ended with a mark, so nothing before it is read again
            before = max(low.rfind(mark, max(0, done), spot) for mark in ".,;:!?\n|()\"")
            after = CLAUSE_END.search(low, spot)
            done = after.start() if after else len(low)
            weight, seen = self.clause(TOKEN.findall(low[before + 1 : done]))
            weights.append(weight)
            threats += seen
        total = sum(weights)
        if not total:
            return 0.0, 0.0, 0.0, float(threats)
        return float(np.log1p(total)), float(max(weights)), 1000 * total / (len(low) + 100), float(threats)


def learn_patterns(labelled: DataFrame, toxic: int, clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words and of beginnings of words from ``(text, toxic)``, counted over all rows.

    ``toxic`` and ``clean`` are the numbers of such texts.
    The weight is the log of the smoothed odds of a pattern's document counts in toxic against clean texts. Tasks sum
    their counts first. Patterns with too little evidence are left out, and the strongest are kept in order.
    """
    ship(labelled.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for content, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(set(TOKEN.findall(content.lower())))
            if len(counts[0]) + len(counts[1]) > 1 << 20:
                yield rows(counts)
                counts = (Counter(), Counter())
        yield rows(counts)

    def rows(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in counts]]
        return pa.RecordBatch.from_arrays(columns, names=["word", "clean", "toxic"])

    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        leanly(work), "word string, clean long, toxic long"
    )
    by_word = written(
        counted.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-words"
    )
    stems = [F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in STEM_LENGTHS]
    by_stem = (
        by_word.select(F.explode(F.array(*stems)).alias("word"), "clean", "toxic")
        .where("word IS NOT NULL")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    tagged = by_word.withColumn("stem", F.lit(False)).unionByName(by_stem.withColumn("stem", F.lit(True)))
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    strong = tagged.withColumn("weight", F.ln(odds)).where(
        (F.col("toxic") >= LEAST_TOXIC) & (F.col("weight") >= float(np.log(LEAST_ODDS)))
    )
    best = strong.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "word", "stem").limit(MOST_PATTERNS)
    words: dict[str, float] = {}
    beginnings: dict[str, float] = {}
    for row in best.collect():
        (beginnings if row["stem"] else words)[row["word"]] = row["weight"]
    return words, beginnings


def clause_features(docs: DataFrame, grammar_of: Callable[[], Grammar], key: str = "doc_id") -> DataFrame:
    """``(key, *FEATURES)`` of every text; a null text counts as empty."""
    ship(docs.sparkSession)
    source = texts(docs, key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = grammar_of()
        for batch in batches:
            found = [grammar.features(content) for content in batch.column(1).to_pylist()]
            columns = np.array(found, float).reshape(-1, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column) for column in columns]], names=[key, *FEATURES]
            )

    kinds = ", ".join(f"{name} double" for name in FEATURES)
    return source.mapInArrow(leanly(work), f"`{key}` {source.schema[key].dataType.simpleString()}, {kinds}")


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, penalty: float = 1.0) -> np.ndarray:
    """Weights and, last, the constant of a logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, learns: Column) -> DataFrame:
    """``(doc_id, score, predicted, *FEATURES)`` of every row of ``docs``.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null in either are left out, and a document that is
    labelled twice is toxic if one label says so. Only labels where ``learns`` holds on ``doc_id`` are learned from.
    Patterns are counted over all of these; the last weights are fitted on at most ``FIT_ROWS`` of them.
    A null or empty text has no clause and gets the score of such texts. Without both kinds of labels
    every score is the share of toxic ones, or 0 without any.
    """
    spark = docs.sparkSession
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(learns)
    judged = written(usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "toxic-labels")
    small = fits_broadcast(judged, F.lit(24))
    label_side = F.broadcast(judged) if small else judged
    labelled = texts(docs, "doc_id").join(label_side, "doc_id").select("text", "toxic")
    rows, toxic = judged.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    words, stems = learn_patterns(labelled, toxic, rows - toxic)
    shared = spark.sparkContext.broadcast((words, stems))
    features = written(clause_features(docs, lambda: Grammar(*shared.value)), "toxic-features")

    known = features.join(judged, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    sample = known.select(*FEATURES, "toxic").toPandas()
    x, y = sample[list(FEATURES)].to_numpy(float), sample["toxic"].to_numpy(float)
    weights = fit_logistic(x, y) if 0 < y.sum() < len(y) else None
    if weights is None:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    else:
        linear = sum((F.col(name) * float(w) for name, w in zip(FEATURES, weights)), F.lit(float(weights[-1])))
        score = 1 / (1 + F.exp(-F.greatest(F.least(linear, F.lit(700.0)), F.lit(-700.0))))
    scored = features.withColumn("score", score)
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES)


def held_out(key: Column) -> Column:
    return remainder(key, 5) == 0


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = toxicity(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), ~held_out(F.col("doc_id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", *FEATURES)
