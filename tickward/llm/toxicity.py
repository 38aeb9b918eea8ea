"""Toxicity scores from a weighted finite-state pattern grammar.

Every word of a text is mapped to one symbol: insult, threat, target, negation, reported speech or other. Three small
transducers read the symbols of a clause from left to right. Each rewrites or reweights what passes through it:

* negation: an insult or a threat up to three words after a negation counts a fifth ("not stupid");
* reported speech: one that follows a verb of saying in the same clause counts half ("he said idiot");
* target: one that stands within four words of somebody addressed counts one and a half times; a threat that is aimed at
  nobody counts a fifth.

Their composition is one machine over tuples of states. A clause ends at sentence punctuation and line ends; its score
is the weight of the best hit plus a tenth of the others. A document's score is a logistic function of the scores of its
matched clauses, never of isolated words outside the machine.

The insult lexicon starts from a few seeds and is extended from labelled texts: whole words and word beginnings that
are far more common in toxic than in clean documents, weighted by their log odds. NULL and empty texts match nothing
and get the score of a text without hits; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tickward.llm.common import fold, log_odds_fit, released, rows_of, stored

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "oihtnr"

# Seeds in English, German, French and Spanish; learned terms come on top.
SEEDS = {
    INSULT: "idiot moron imbecile stupid loser scum worthless pathetic disgusting dummkopf arschloch abschaum connard abruti minable imbécil basura escoria",
    THREAT: "kill hurt destroy beat stab töten umbringen schlagen tuer frapper écraser matar golpear destruir",
    TARGET: "you your u yourself du dich dir euch tu toi te vous vos tú ti usted ustedes",
    NEGATION: "not never no don't doesn't isn't aren't nicht nie kein keine ne pas jamais nunca jamás",
    REPORT: "said says wrote claimed quoted called sagte sagt schrieb behauptet dit disait écrivait dijo dice escribió",
}
SEED_WEIGHT = 4.0
PREFIX_LENGTHS = (4, 5, 6)
EDGES = ".,;:!?\"'()[]{}*#$%&|<>…«»„“”‚‘’¡¿-"
CLAUSE = re.compile(r"[.!?;:\n]+")


HITS = (INSULT, THREAT)


def _negation(state: int, symbol: str) -> tuple[int, float]:
    if symbol == NEGATION:
        return 3, 1.0
    factor = 0.2 if state and symbol in HITS else 1.0
    return max(0, state - 1), factor


def _report(state: int, symbol: str) -> tuple[int, float]:
    if symbol == REPORT:
        return 1, 1.0
    return state, 0.5 if state and symbol in HITS else 1.0


def _target(state: int, symbol: str) -> tuple[int, float]:
    if symbol == TARGET:
        return 4, 1.0
    factor = 1.0
    if symbol in HITS:
        factor = 1.5 if state else (0.2 if symbol == THREAT else 1.0)
    return max(0, state - 1), factor


def compose(*machines: tuple[int, object]) -> dict:
    """The transducer that runs all machines at once: (states, symbol) -> (states, product of their factors)."""
    table = {}
    for states in product(*(range(n) for n, _ in machines)):
        for symbol in (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT):
            moves = [step(s, symbol) for s, (_, step) in zip(states, machines, strict=True)]
            table[states, symbol] = (tuple(m[0] for m in moves), float(np.prod([m[1] for m in moves])))
    return table


WHOLE = compose((4, _negation), (2, _report), (5, _target))
UNAIMED = compose((4, _negation), (2, _report))
AIM = compose((5, _target))


def run(machine: dict, symbols: list[str]) -> list[float]:
    """The factor the machine gives each symbol."""
    state = next(iter(machine))[0]
    factors = []
    for symbol in symbols:
        state, factor = machine[state, symbol]
        factors.append(factor)
    return factors


@dataclass(frozen=True)
class Grammar:
    """Lexicon of whole words and word beginnings with weights, and the weights of the document score."""

    words: dict[str, tuple[str, float]]
    prefixes: dict[str, float]
    weights: tuple[float, ...]

    def symbol(self, word: str) -> tuple[str, float]:
        word = word.strip(EDGES)
        found = self.words.get(word)
        if found:
            return found
        weight = max((self.prefixes.get(word[:k], 0.0) for k in PREFIX_LENGTHS if len(word) >= k), default=0.0)
        return (INSULT, weight) if weight else (OTHER, 0.0)

    def clause(self, tagged: list[tuple[str, float]]) -> float:
        symbols = [s for s, _ in tagged]
        after = zip(run(UNAIMED, symbols), run(AIM, symbols[::-1])[::-1], strict=True)  # a target may follow its insult
        factors = [max(whole, bare * aim) for whole, (bare, aim) in zip(run(WHOLE, symbols), after, strict=True)]
        hits = [weight * f for (symbol, weight), f in zip(tagged, factors, strict=True) if symbol in HITS]
        return 0.9 * max(hits) + 0.1 * sum(hits) if hits else 0.0

    def matches(self, text: str | None) -> list[float]:
        """Scores of the clauses that hold an insult or a threat, in text order."""
        lowered = (text or "").lower()
        tags = {w: self.symbol(w) for w in set(lowered.split())}
        if not any(symbol in HITS for symbol, _ in tags.values()):
            return []
        scores = []
        for clause in CLAUSE.split(lowered):
            tagged = [tags.get(w) or self.symbol(w) for w in clause.split()]
            if any(symbol in HITS for symbol, _ in tagged):
                scores.append(self.clause(tagged))
        return scores

    def features(self, text: str | None) -> list[float]:
        scores = self.matches(text)
        if not scores:
            return [0.0, 0.0, 0.0]
        return [max(scores), np.log1p(sum(scores)), np.log1p(1000 * sum(scores) / max(1, len(text)))]

    def scores(self, texts) -> np.ndarray:
        x = np.array([[*self.features(t), 1.0] for t in texts], dtype=float).reshape(-1, 4)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))

    def score(self, text: Column) -> Column:
        """Probability between 0 and 1 that a text is toxic."""
        grammar = self

        @F.pandas_udf("double")
        def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(grammar.scores(batch))

        return toxicity(text)


def seed_words() -> dict[str, tuple[str, float]]:
    return {w: (symbol, SEED_WEIGHT if symbol in HITS else 0.0) for symbol, line in SEEDS.items() for w in line.split()}


def terms_of(text: str | None) -> list[str]:
    """Distinct words and word beginnings of a text; a beginning ends in a star."""
    words = {w.strip(EDGES) for w in set((text or "").lower().split())}
    starts = {w[:k] + "*" for w in words for k in PREFIX_LENGTHS if len(w) >= k}
    return sorted((words | starts) - {""})


def _term_counts(texts: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """In how many texts each term stands, summed per task before the shuffle; only ``wanted`` ones if given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for (text,) in rows_of(batches, "text"):
            terms = terms_of(text)
            counts.update(terms if wanted is None else wanted.intersection(terms))
            if len(counts) > 150_000:
                yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())})
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    return texts.select("text").mapInArrow(released(count), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(examples: DataFrame, support: float = 0.005, odds: float = 3.0) -> dict[str, float]:
    """Terms of labelled texts (text, toxic) with their log odds of standing in a toxic text.

    A term needs ``support`` of the toxic texts, three at least, and log odds of ``odds``. There are at most as many as a toxic text has
    on average, divided by the support, and the labelled texts are a bounded number. Only terms with that support in toxic texts are
    counted in clean ones.
    """
    n = examples.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    toxic, clean = n["toxic"] or 0, n["n"] - (n["toxic"] or 0)
    common = _term_counts(examples.where("toxic = 1")).where(F.col("n") >= max(3.0, support * toxic))
    in_toxic = {r["term"]: r["n"] for r in common.orderBy(F.desc("n"), "term").collect()}
    in_clean = {r["term"]: r["n"] for r in _term_counts(examples.where("toxic = 0"), frozenset(in_toxic)).collect()}
    weights = {t: float(np.log((k + 0.5) / (toxic + 1)) - np.log((in_clean.get(t, 0) + 0.5) / (clean + 1))) for t, k in in_toxic.items()}
    return {t: w for t, w in weights.items() if w >= odds}


def fit_toxicity(documents: DataFrame, known: DataFrame, max_examples: int = 200_000) -> Grammar:
    """Grammar learned from ``documents`` (doc_id, text) and ``known`` labels (doc_id, toxic).

    At most ``max_examples`` labelled ids are used, chosen by a hash of the id; an id with several labels is toxic if
    one of them is. Equal texts count once. Only those ids, a bounded number, are sent to all executors.
    """
    ids = known.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    texts = documents.where("text is not null").select("doc_id", "text")
    once = texts.join(F.broadcast(ids), "doc_id").groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    chosen = stored(once.agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "toxic").distinct(), "toxicity")
    examples = texts.join(F.broadcast(chosen), "doc_id")
    lexicon = learn_lexicon(examples)
    words = {t: (INSULT, w) for t, w in lexicon.items() if not t.endswith("*")}
    grammar = Grammar(seed_words() | words, {t[:-1]: w for t, w in lexicon.items() if t.endswith("*")}, (0.0,) * 4)
    features = F.pandas_udf(lambda texts: pd.Series([grammar.features(t) for t in texts]), ArrayType(DoubleType()))
    table = examples.select(features("text").alias("x"), "toxic").groupBy("x", "toxic").count().collect()
    if len({row["toxic"] for row in table}) < 2:
        rate = (float(table[0]["toxic"] if table else 0) + 0.02) / 1.1
        return Grammar(grammar.words, grammar.prefixes, (0.5, 0.5, 0.0, float(np.log(rate / (1 - rate)))))
    x, y, n = (np.array([row[c] for row in table], dtype=float) for c in ("x", "toxic", "count"))
    return Grammar(grammar.words, grammar.prefixes, tuple(float(v) for v in log_odds_fit(x, y, n)))


def toxicity_model(documents: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4, **options) -> Grammar:
    """Grammar from the labels of the ids outside fold ``held_out``."""
    known = labels.where(fold(F.col("doc_id"), folds) != held_out).select("doc_id", "toxic")
    return fit_toxicity(documents, known, **options)
