"""Toxicity by a weighted grammar of finite-state transducers.

Words become symbols (insult, threat, target, negation, reported speech, clause end). Five small
transducers, each of which adds marks to the symbols that it passes on, are composed into one; it
says of each clause whether it insults or threatens, whether that is aimed at somebody, negated or
reported. What counts is the weight of matched clauses by these forms, not isolated words.

Insults and their weights are learned from labelled texts: words and beginnings of words, each
estimated with the shorter beginning as its prior. Weights of the forms are fitted on other labelled
texts, so that no text weighs the words that it taught.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import durable, read

#: Labelled texts of each label that are learned from at most, half of them for words, half for forms.
SAMPLE = 8_000
#: Beginnings of words have so many letters; a unit occurs in so many labelled texts, or it isn't learned.
SHORTEST, LONGEST, LEAST_TEXTS = 3, 12, 4
#: Units kept at most, those of most toxic texts first.
UNITS = 60_000
#: A unit's own texts count against so many of its shorter beginning's.
PRIOR_TEXTS = 4.0
#: Log odds from which a word is an insult.
LEAST_WEIGHT = 1.5
#: Words behind a negation that it covers.
SCOPE = 3

# marks of a symbol: the first seven are read, the others are added by the transducers
INSULT, THREAT, TARGET, NEGATION, REPORT, FUTURE, END = (1 << k for k in range(7))
NEGATED, REPORTED, AIMED, MENACING = (1 << k for k in range(7, 11))
READ = [INSULT, THREAT, TARGET, NEGATION, REPORT, FUTURE, END]

#: Words of the marks in English, German, French and Spanish.
WORDS = {
    TARGET: "you your yours yourself he she him her his they them their we us everyone nobody du dich dir dein deine ihr euch er ihn ihm tu te toi ton ta vous votre il elle ils elles lui tú ti usted ustedes él ella ellos ellas vosotros",
    NEGATION: "not no never nor neither without isn aren wasn don doesn didn won can't nicht kein keine keinen nie niemals ohne weder ne pas jamais sans ni aucun nunca jamás sin tampoco",
    REPORT: "said says say told claimed claims wrote writes called calls quoted reported according sagte sagt behauptet behauptete schrieb nannte laut dit disait affirme écrit selon appelle dijo dice afirma escribió según llamó",
    THREAT: "kill killed kills hurt destroy beat shoot stab burn attack murder strangle töten umbringen schlagen verletzen erschießen zerstören tuer frapper détruire blesser brûler matar golpear destruir herir quemar",
    FUTURE: "will shall gonna going must should ll werde wirst wird werden sollst soll vais vas va va allons voy vas vamos debes",
}
SEEDS = {word: mark for mark, words in WORDS.items() for word in words.split()}

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”«»]")

#: Forms of clauses, with the weights that hold as long as labels don't say otherwise.
FORMS = {"insult": 1.0, "aimed insult": 1.2, "negated": 0.6, "reported": 0.6, "threat": 1.5}
#: Features of a text: weight of its clauses by form, the heaviest clause, the weight a word, length, one.
PRIORS = np.array([*FORMS.values(), 0.5, 0.0, 0.0, -2.0])
#: Strength of the pull towards PRIORS, in texts.
PULL = 1.0

Step = Callable[[int, int], tuple[int, int]]


class Transducer:
    """States from 0 on; `step(state, symbol)` gives the next state and the symbol passed on."""

    def __init__(self, states: int, step: Step):
        self.states, self.step = states, step

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one passes on is read by `other`."""

        def step(state: int, symbol: int) -> tuple[int, int]:
            mine, passed = self.step(state // other.states, symbol)
            its, out = other.step(state % other.states, passed)
            return mine * other.states + its, out

        return Transducer(self.states * other.states, step)


def _negation(state: int, symbol: int) -> tuple[int, int]:
    """Insults and threats up to SCOPE words behind a negation are negated."""
    if symbol & END:
        return 0, symbol
    out = symbol | NEGATED if state and symbol & (INSULT | THREAT) else symbol
    return (SCOPE if symbol & NEGATION else max(state - 1, 0)), out


def _report(state: int, symbol: int) -> tuple[int, int]:
    """What follows a verb of saying within the clause is reported."""
    out = symbol | REPORTED if state and symbol & (INSULT | THREAT) else symbol
    return (0 if symbol & END else int(bool(state or symbol & REPORT))), out


def _target(state: int, symbol: int) -> tuple[int, int]:
    """The end of a clause that names somebody is marked."""
    if symbol & END:
        return 0, symbol | AIMED if state else symbol
    return int(bool(state or symbol & TARGET)), symbol


def _threat(state: int, symbol: int) -> tuple[int, int]:
    """A verb of harm behind a verb of intent is menacing; states: nothing, intent."""
    if symbol & END:
        return 0, symbol
    return int(bool(state or symbol & FUTURE)), symbol | MENACING if state and symbol & THREAT and not symbol & NEGATED else symbol


#: States of `_insult` are sets of what a clause has had: insults, negated, reported ones, menaces.
HAD = [(INSULT, 0), (NEGATED, 1), (REPORTED, 2), (MENACING, 3)]


def _insult(state: int, symbol: int) -> tuple[int, int]:
    """The end of a clause says what the clause has had."""
    if symbol & END:
        return 0, symbol | sum(mark for mark, bit in HAD if state >> bit & 1)
    return state | sum(1 << bit for mark, bit in HAD if symbol & mark), symbol


GRAMMAR = reduce(Transducer.then, [Transducer(SCOPE + 1, _negation), Transducer(2, _report), Transducer(2, _threat), Transducer(2, _target), Transducer(16, _insult)])


def compiled(machine: Transducer) -> list[list[tuple[int, int]]]:
    """Steps of all states that can be reached from the first, by the number of the read symbol's marks."""
    symbols = 1 << len(READ)
    table: list[list[tuple[int, int]]] = [[] for _ in range(machine.states)]
    waiting = [0]
    while waiting:
        state = waiting.pop()
        if not table[state]:
            table[state] = [machine.step(state, symbol) for symbol in range(symbols)]
            waiting += {after for after, _ in table[state]}
    return table


def clause_form(end: int) -> int | None:
    """Number of the form that an end of a clause shows, if any."""
    if end & MENACING and end & AIMED:
        return 4
    if not end & INSULT:
        return None
    return 3 if end & REPORTED else 2 if end & NEGATED else 1 if end & AIMED else 0


class Scorer:
    """Reads texts by the composed grammar and the learned units."""

    def __init__(self, units: dict[str, float]):
        self.units, self.table = units, compiled(GRAMMAR)
        self.known: dict[str, tuple[int, float]] = {}

    def symbol(self, token: str) -> tuple[int, float]:
        """Marks and weight of a lower-case token: the longest learned unit that it begins with decides."""
        if not token[0].isalpha():
            return END, 0.0
        marks, weight = SEEDS.get(token, 0), 0.0
        for unit in units_of(token):
            if unit in self.units:
                weight = self.units[unit]
                break
        if weight >= LEAST_WEIGHT:
            return marks | INSULT, weight
        return marks, 1.0 if marks & THREAT else 0.0

    def clauses(self, text: str) -> Iterator[tuple[int, float]]:
        """Form and weight of each matched clause."""
        state, weight, table, known = 0, 0.0, self.table, self.known
        for token in [*TOKEN.findall(text.lower()), "\n"]:
            found = known.get(token)
            if found is None:
                found = self.symbol(token)
                if len(known) < 200_000:
                    known[token] = found
            mark, own = found
            state, out = table[state][mark]
            weight += own
            if mark == END:
                if weight:
                    form = clause_form(out)
                    if form is not None:
                        yield form, weight
                    weight = 0.0

    def features(self, text: str) -> list[float]:
        sums, most = [0.0] * len(FORMS), 0.0
        for form, weight in self.clauses(text):
            sums[form] += weight
            most = max(most, weight)
        words = len(text) / 6 + 1
        return [*map(math.log1p, sums), math.log1p(most), math.log1p(1000 * sum(sums) / words), math.log(words) / 10, 1.0]


def units_of(word: str) -> list[str]:
    """The whole word, marked by an end, and its beginnings, longest first."""
    return [f"{word}$", *[word[:k] for k in range(min(len(word), LONGEST), SHORTEST - 1, -1)]]


def fold(doc_id: Column) -> Column:
    """CRC-32 of the id's digits, modulo 5; a null id has none."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic and part (1, 2: for words; 3, 4: for forms) of labelled documents that may be learned from.

    Of each label at most `sample`, those first by a hash of the id; only their ids are ordered.
    """
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("of"), (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
    known = known.withColumn("part", fold(F.col("of"))).where("part <> 0")
    first = lambda value: known.where(F.col("toxic") == value).orderBy(F.xxhash64("of"), "of").limit(sample)
    chosen = first(0).unionByName(first(1))  # at most 2 * sample rows of three numbers
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("text", "toxic", "part")


def unit_counts(rows: DataFrame) -> DataFrame:
    """unit, toxic, n: in how many texts of each label a unit occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, int]] = Counter()
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                words = {t for t in TOKEN.findall(text.lower()) if t[0].isalpha()}
                counts.update((unit, toxic) for unit in {u for w in words for u in units_of(w)})
            rows = [(unit, toxic, n) for (unit, toxic), n in counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ([], [], []), (pa.string(), pa.int32(), pa.int64()), strict=True)], ["unit", "toxic", "n"])

    return rows.select("text", "toxic").mapInArrow(run, "unit string, toxic int, n long").groupBy("unit", "toxic").agg(F.sum("n").alias("n"))


def unit_weights(counts: Iterable[tuple[str, float, float]], toxic: int, clean: int) -> dict[str, float]:
    """Log odds of units (unit, toxic texts, clean texts), as if both labels were as frequent.

    A unit's share of toxic texts is taken together with PRIOR_TEXTS texts of its next shorter
    beginning, down to even odds. A unit of the same texts as that beginning adds nothing to it,
    and a beginning that stands for one word only is left out.
    """
    share = toxic / clean if toxic and clean else 1.0
    found: dict[str, float] = {}
    seen: dict[str, tuple[float, float]] = {}
    for unit, pos, neg in sorted(counts, key=lambda c: len(c[0])):  # a whole word is as long as a beginning of one more letter
        stem = unit[:-1]
        while stem and stem not in found:
            stem = stem[:-1]
        prior, neg = found.get(stem, 0.5), neg * share
        same = stem and seen[stem] == (pos, neg)
        found[unit], seen[unit] = prior if same else (pos + PRIOR_TEXTS * prior) / (pos + neg + PRIOR_TEXTS), (pos, neg)
    alone = {stem for unit in found if unit.endswith("$") for stem in units_of(unit[:-1])[1:] if seen.get(stem) == seen[unit]}
    return {unit: math.log(q / (1 - q)) for unit, q in found.items() if unit not in alone}


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of features, both labels as heavy, pulled towards PRIORS; by Newton's method."""
    w = PRIORS.copy()
    n1, n0 = max(int(y.sum()), 1), max(int((1 - y).sum()), 1)
    heavy = np.where(y > 0, min(n0 / n1, 3.0), 1.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (heavy * (p - y)) + PULL * (w - PRIORS)
        bend = (x * (heavy * p * (1 - p))[:, None]).T @ x + PULL * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return np.round(w, 6)  # the same whatever order the texts came in


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """Units with their weights, and weights of the features; without labels no units and PRIORS.

    To the driver go units of a bounded sample (UNITS at most) and that sample's features.
    """
    rows = durable(labelled(docs, labels, sample))
    words, forms = rows.where("part in (1, 2)"), rows.where("part in (3, 4)")
    size = {r["toxic"]: r["count"] for r in words.groupBy("toxic").count().collect()}
    n = lambda value: F.sum(F.when(F.col("toxic") == value, F.col("n")).otherwise(0))
    counts = unit_counts(words).groupBy("unit").agg(n(1).alias("pos"), n(0).alias("neg")).where(F.col("pos") >= LEAST_TEXTS)
    counts = counts.orderBy(F.desc("pos"), "unit").limit(UNITS)
    units = unit_weights(((r["unit"], r["pos"], r["neg"]) for r in counts.collect()), size.get(1, 0), size.get(0, 0))
    examples = with_features(forms, units, ["toxic int"]).collect()
    if not examples:
        return units, PRIORS.copy()
    return units, fitted(np.array([r["features"] for r in examples]), np.array([r["toxic"] for r in examples], float))


def with_features(rows: DataFrame, units: dict[str, float], kept: list[str]) -> DataFrame:
    """The columns `kept` ("name type") of `rows` and features of `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(units)
        for batch in batches:
            made = pa.array([scorer.features(t.as_py() or "") for t in batch["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch[k] for k in names], made], [*names, "features"])

    names = [k.split()[0] for k in kept]
    return rows.select(*names, "text").mapInArrow(run, ", ".join([*kept, "features array<double>"]))


def clauses(docs: DataFrame, units: dict[str, float]) -> DataFrame:
    """Matched clauses: doc_id, form, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, names = Scorer(units), list(FORMS)
        for batch in batches:
            found = [(doc, names[form], weight) for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for form, weight in scorer.clauses(text or "")]
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.float64()), strict=True)], ["doc_id", "form", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, form string, weight double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for each document (doc_id, text), learned from `labels` (doc_id, toxic).

    Only labels outside the held-out fold teach, and only the text makes the score. A null or empty
    text has no clauses; a null id is held out; a null label or id teaches nothing; repeated labels
    count once, repeated rows are scored each; other columns of any name are ignored; without
    labels the grammar's own weights hold; an empty table gives no rows.
    """
    units, weights = learn(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = with_features(rows, units, ["doc_id long"])
    total = reduce(Column.__add__, [F.col("features")[k] * F.lit(float(w)) for k, w in enumerate(weights)])
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_toxic_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the grammar learned from `labels`."""
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
