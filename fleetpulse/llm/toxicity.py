"""Toxicity by a weighted grammar of finite-state transducers.

Words become classes (insult, verb of violence, first person, target, negation,
reported speech and others). Small weighted transducers over these classes are
composed into one machine that runs through every clause; its arcs emit an
insult, or a threat (first person, verb and target; an order; a fate wished on
the reader), with a weight that target, negation and report move. Insult words
and stems with their weights, and how clauses combine, are learned from labelled
texts; the arcs' weights are parameters, so that contexts that no labelled text
shows have one too. Language and source are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, Memo, held_out, map_batches, texts_of

SAMPLE_PER_CLASS = 4_000
LEAST_TOXIC_TEXTS = 5
LEAST_TOXIC_SHARE = 0.01
LEAST_LOG_ODDS = 3.0
STEM_LENGTHS = range(5, 9)
STEM_BRANCHES = 3  # a stem has at least as many marked continuations; fewer stand for themselves
INFLECTED_LENGTH = 5  # learned words from this length on also match with an ending
COUNTING_TASKS = 8

# Weights on the arcs, in log odds like the insults' learned ones.
THREAT = 8.0
TARGET = 1.0
NEGATED_INSULT, NEGATED_THREAT = -6.0, -8.0
REPORTED_INSULT, REPORTED_THREAT = -6.0, -8.0
NEGATION_REACH = 3  # words behind it in which an insult is negated; a threat to the clause's end
TARGET_REACH = 4  # words between a verb and its target
FATE_REACH = 3
NO_LABELS = (-4.0, 1.0, 0.0)  # coefficients where no toxic text is labelled

# Words of the closed classes, in the languages of the tables.
SEEDS = {
    "self": "i we ich wir je j nous yo voy vamos",
    "verb": "kill kills killing murder murdering hurt hurting destroy destroying stab stabbing shoot shooting strangle strangling burn burning "
    "töten töte schlagen schlage zerstören zerstöre vernichten vernichte umbringen erschießen verbrennen "
    "tuer tue tuerai tuerons frapper frapperai brûler brûlerai détruire détruirai égorger "
    "matar golpear quemar destruir disparar",
    "vow": "mataré golpearé quemaré destruiré dispararé",
    "strike": "matarte golpearte quemarte destruirte dispararte mataros matarlo matarla matarlos",
    "fate": "killed murdered shot stabbed beaten burned destroyed die getötet umgebracht erschossen sterben tué tuée mourir crever morir muerto muerta",
    "modal": "will shall should must deserve gonna ll wirst sollst musst solltest vas dois devrais mérites vais debes deberías mereces",
    "target": "you your yourself yourselves him her them dich dir euch ihn te toi t vous ti os",
    "reader": "du tu tú ihr",
    "negation": "not no never nobody neither cannot nicht kein keine niemand nie niemals ne pas jamais aucun aucune nunca jamás ningún ninguna tampoco",
    "report": "said says say wrote writes claimed claims called quoted sagte sagt schrieb behauptet dit disait écrit affirme dijo dice escribió afirma",
}
ENDINGS = ("s", "es", "e", "n", "en")
_SHORT_NOT = re.compile(r"n['\u2019]t\b")
_CLAUSE = re.compile(r"[.!?;:,\n]+")
_WORD = re.compile(r"[^\W\d_]+")

CLASSES = ("other", "insult", *SEEDS)
EVENTS = ("insult", "threat")


@dataclass(frozen=True)
class Transducer:
    """States from 0 on; a move gives the next state and a name or None.

    An emission adds ``weights[event]`` to an event of the same step; a name
    among ``EVENTS`` makes one.
    """

    states: int
    moves: dict[tuple[int, str], tuple[int, str | None]]
    weights: dict[str, float]

    def step(self, state: int, symbol: str) -> tuple[int, str | None]:
        return self.moves.get((state, symbol)) or self.moves[state, "*"]


def insults() -> Transducer:
    """Emits an insult wherever the symbol stands; its word brings the weight."""
    return Transducer(1, {(0, "insult"): (0, "insult"), (0, "*"): (0, None)}, {"insult": 0.0})


def threats(reach: int = TARGET_REACH) -> Transducer:
    """First person, verb and target, the last two in either order and near each other; or a clause that begins with a verb and has a target."""
    begin, idle, own = 0, 1, 2
    verb, target, order = (lambda k, at=at: 2 + at * reach + k for at in range(3))  # k words are left
    before = 3 + 3 * reach  # a target right before the first person, as in "te voy"
    moves: dict[tuple[int, str], tuple[int, str | None]] = {}
    for state in (begin, idle, own):
        moves[state, "*"] = (max(state, idle), None)
        moves[state, "self"] = (own, None)
    moves |= {(s, "target"): (before, None) for s in (begin, idle, before)}
    moves |= {(before, "*"): (idle, None), (before, "self"): (target(reach), None)}
    moves[begin, "verb"] = (order(reach), None)
    moves |= {(own, "verb"): (verb(reach), None), (own, "target"): (target(reach), None), (own, "strike"): (own, "threat")}
    for k in range(1, reach + 1):
        moves |= {(verb(k), "*"): (verb(k - 1) if k > 1 else own, None), (verb(k), "target"): (own, "threat")}
        moves |= {(verb(k), "verb"): (verb(reach), None), (verb(k), "strike"): (own, "threat")}
        moves |= {(target(k), "*"): (target(k - 1) if k > 1 else own, None), (target(k), "verb"): (own, "threat")}
        moves |= {(target(k), "target"): (target(reach), None), (target(k), "strike"): (own, "threat")}
        moves |= {(order(k), "*"): (order(k - 1) if k > 1 else idle, None), (order(k), "target"): (idle, "threat")}
        moves[order(k), "self"] = (own, None)
    return Transducer(before + 1, moves | {(s, "vow"): (own, "threat") for s in range(before + 1)}, {"threat": THREAT})


def fates(reach: int = FATE_REACH) -> Transducer:
    """The reader, then a modal beside it, then a fate within ``reach`` words."""
    moves: dict[tuple[int, str], tuple[int, str | None]] = {(s, "*"): (0, None) for s in (0, 1)}
    moves |= {(k + 1, "*"): (k if k > 1 else 0, None) for k in range(1, reach + 1)}
    moves |= {(k + 1, "fate"): (0, "threat") for k in range(1, reach + 1)}
    moves |= {(s, word): (1, None) for s in range(reach + 2) for word in ("target", "reader")}
    moves[1, "modal"] = (reach + 1, None)
    return Transducer(reach + 2, moves, {"threat": THREAT})


def near(symbol: str, words: int, weights: dict[str, float]) -> Transducer:
    """Weighs on events at the next ``words`` words behind its symbol."""
    moves = {(s, "*"): (max(s - 1, 0), symbol if s else None) for s in range(words + 1)}
    return Transducer(words + 1, moves | {(s, symbol): (words, None) for s in range(words + 1)}, weights)


def rest(symbol: str, weights: dict[str, float]) -> Transducer:
    """Weighs on events from its symbol to the clause's end."""
    return Transducer(2, {(0, symbol): (1, None), (0, "*"): (0, None), (1, "*"): (1, symbol)}, weights)


GRAMMAR = (
    insults(), threats(), fates(),
    rest("target", {"insult": TARGET}),
    near("negation", NEGATION_REACH, {"insult": NEGATED_INSULT}),
    rest("negation", {"threat": NEGATED_THREAT}),
    rest("report", {"insult": REPORTED_INSULT, "threat": REPORTED_THREAT}),
)
Event = tuple[str, ...]
Arc = tuple[int, "tuple[Event, float] | None"]


def compose(machines: tuple[Transducer, ...]) -> list[dict[str, Arc]]:
    """Parallel composition of the states that can be reached: an arc's event, contexts and summed weight."""
    numbers = {(0,) * len(machines): 0}
    table: list[dict[str, Arc]] = []
    queue = [(0,) * len(machines)]
    for states in queue:  # grows while it is walked
        arcs: dict[str, Arc] = {}
        for symbol in CLASSES:
            steps = [m.step(s, symbol) for m, s in zip(machines, states)]
            after = tuple(s for s, _ in steps)
            if after not in numbers:
                numbers[after] = len(queue)
                queue.append(after)
            event = next((name for _, name in steps if name in EVENTS), None)
            arcs[symbol] = (numbers[after], _weighed(event, machines, steps) if event else None)
        table.append(arcs)
    return table


def _weighed(event: str, machines: tuple[Transducer, ...], steps: list) -> tuple[Event, float]:
    makers = [m.weights[event] for m, (_, n) in zip(machines, steps) if n == event]
    context = {n: m.weights[event] for m, (_, n) in zip(machines, steps) if n and n != event and event in m.weights}
    return (event, *context), max(makers) + sum(context.values())


_MACHINE = compose(GRAMMAR)


def clause_events(classes: list[str]) -> list[tuple[int, Event, float]]:
    """Places, contexts and arc weights of the insults and threats of a clause."""
    state, found = 0, []
    for at, symbol in enumerate(classes):
        state, event = _MACHINE[state][symbol]
        if event:
            found.append((at, *event))
    return found


@dataclass
class Lexicon:
    """Classes of words: the closed ones, then insults by a learned word (``$`` ends it), its endings or a learned stem."""

    stems: dict[str, float]
    seen: Memo = field(default_factory=lambda: Memo(500_000))

    def __post_init__(self):
        self.seeds = {w: c for c, words in SEEDS.items() for w in words.split()}

    def look_up(self, word: str) -> tuple[str, float]:
        hit = self.seen.get(word)
        if hit is None:
            hit = self.seen.recall(word)
        if hit is None:
            seed = self.seeds.get(word)
            hit = (seed, 0.0) if seed else self._insult(word)
            self.seen.trim()
            self.seen.keep(word, hit)
        return hit

    def _insult(self, word: str) -> tuple[str, float]:
        bases = [word[: -len(e)] for e in ENDINGS if word.endswith(e)]
        names = [word + "$", *(b + "$" for b in bases if len(b) >= INFLECTED_LENGTH), *prefixes(word)[::-1]]
        return next((("insult", self.stems[n]) for n in names if n in self.stems), ("other", 0.0))

    def __getstate__(self):
        return {"stems": self.stems}

    def __setstate__(self, state):
        self.__init__(state["stems"])


def prefixes(word: str, lengths: range = STEM_LENGTHS) -> list[str]:
    """The stems that a word can have, shortest first."""
    return [word[:n] for n in lengths if n <= len(word)]


def spellings(word: str) -> list[str]:
    """What is counted of a word: its stems, one letter more to see how they go on, and the whole word."""
    return [*prefixes(word, range(STEM_LENGTHS.start, STEM_LENGTHS.stop + 1)), word + "$"]


_EVENT_CLASSES = {"insult", "verb", "vow", "strike", "fate"}


def clauses_of(text: str) -> list[list[str]]:
    """Lower-case words of every clause; a shortened "not" is a word of its own."""
    low = text.lower()
    if "n't" in low or "n\u2019t" in low:
        low = _SHORT_NOT.sub(" not", low)
    return [_WORD.findall(clause) for clause in _CLAUSE.split(low)]


def matched_clauses(text: str, lexicon: Lexicon) -> list[list[tuple[float, Event]]]:
    """The events (weight and context) of each clause that has any."""
    if all(lexicon.look_up(w)[0] not in _EVENT_CLASSES for w in set(_WORD.findall(text.lower()))):
        return []
    out = []
    for words in clauses_of(text):
        hits = [lexicon.look_up(w) for w in words]
        events = clause_events([c for c, _ in hits])
        if events:
            out.append([((hits[at][1] if labels[0] == "insult" else 0.0) + weight, labels) for at, labels, weight in events])
    return out


@dataclass
class Model:
    """Learned words and stems, and the coefficients that combine clauses."""

    lexicon: Lexicon
    coefficients: tuple[float, ...]

    def features(self, clauses: list[list[tuple[float, Event]]]) -> tuple[float, float]:
        """Best clause score, and the logarithm of the clauses' summed scores."""
        scores = [max(0.0, *(weight for weight, _ in events)) for events in clauses]
        return max(scores, default=0.0), math.log1p(sum(scores))

    def score(self, clauses: list[list[tuple[float, Event]]]) -> float:
        """Of a text's matched clauses."""
        return logistic(self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], self.features(clauses))))


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def log_odds(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))


def choose_stems(counts: list[tuple[str, int, int]], all_toxic: int, all_clean: int) -> dict[str, float]:
    """Words that mark toxic texts, and stems with several marked continuations.

    The shortest such stem stands for all below it. A spelling that goes on in
    one way only is left to the whole word, so a learned compound does not
    claim the everyday word it begins with.
    """
    least = max(LEAST_TOXIC_TEXTS, LEAST_TOXIC_SHARE * all_toxic)
    marked = {}
    for spelling, toxic, clean in counts:
        weight = log_odds(toxic, clean, all_toxic, all_clean)
        if toxic >= least and weight >= LEAST_LOG_ODDS:
            marked[spelling] = weight
    branches = Counter(s[:-1] for s in marked)  # a word's end counts as one
    chosen: dict[str, float] = {}
    for spelling in sorted(marked, key=lambda s: (len(s), s)):
        word = spelling.rstrip("$")
        below = any(p in chosen for p in prefixes(word))
        stem = spelling == word and len(word) in STEM_LENGTHS and branches[word] >= STEM_BRANCHES
        if not below and (stem or spelling != word):
            chosen[spelling] = marked[spelling]
    return chosen


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w + np.linalg.solve(hessian, x.T @ (labels - p) - penalty @ w)
    return tuple(w.tolist())


def fit_rising(rows: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """``fit`` with coefficients that do not fall: a feature that would is left out."""
    both = fit(rows, labels)
    if min(both[1:]) >= 0:
        return both
    keep = int(both[2] > both[1])
    base, own = fit(rows[:, keep : keep + 1], labels)
    return (base, max(own, 0.0), 0.0) if keep == 0 else (base, 0.0, max(own, 0.0))


def training_texts(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Texts and labels of at most ``per_class`` labelled rows of each class, none of them held out.

    The rows are the first by a hash of the id. Labels without id or mark are
    left out; an id marked both ways counts as toxic.
    """
    marked = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    marked = marked.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    parts = [marked.filter(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * per_class rows at most
    texts = documents.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    return texts.dropna().join(sample, "id").select("text", "toxic")


def learn(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from a bounded sample of labelled rows; without toxic rows it knows threats only."""
    texts = training_texts(documents, labels, per_class).repartition(COUNTING_TASKS).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
        if not toxic:
            return Model(Lexicon({}), NO_LABELS)
        counted = map_batches(texts, _count_spellings, "stem string, toxic bigint, clean bigint").groupBy("stem")
        counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        likely = (F.col("toxic") >= LEAST_TOXIC_TEXTS) & (F.col("toxic") * clean >= F.col("clean") * toxic * 10)
        lexicon = Lexicon(choose_stems([tuple(r) for r in counted.filter(likely).collect()], toxic, clean))

        model = Model(lexicon, NO_LABELS)

        def features(batches: Batches) -> Batches:
            for batch in batches:
                rows = [model.features(matched_clauses(t, lexicon)) for t in texts_of(batch)]
                yield pa.RecordBatch.from_pydict(
                    {"best": [b for b, _ in rows], "total": [t for _, t in rows], "toxic": batch.column("toxic").cast(pa.int64())},
                    schema=pa.schema([("best", pa.float64()), ("total", pa.float64()), ("toxic", pa.int64())]),
                )

        rows = np.asarray(map_batches(texts, features, "best double, total double, toxic bigint").collect(), float)
        rows = rows[np.lexsort(rows.T)]  # sums do not depend on the order of tasks
        model.coefficients = fit_rising(rows[:, :2], rows[:, 2])
        return model
    finally:
        texts.unpersist()


def _count_spellings(batches: Batches) -> Batches:
    """Texts of each class that have a spelling."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(texts_of(batch), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            counts[label].update({s for w in words for s in spellings(w)})
    toxic = counts[1]
    names = list(toxic)
    schema = pa.schema([("stem", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    clean_only = [s for s in counts[0] if s not in toxic]
    names += clean_only
    for low in range(0, len(names), 50_000):
        part = names[low : low + 50_000]
        yield pa.RecordBatch.from_pydict({"stem": part, "toxic": [toxic[s] for s in part], "clean": [counts[0][s] for s in part]}, schema=schema)


def score(documents: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_clauses (matched ones).

    A null or empty text scores as one without matches. Null and repeated keys
    keep their rows; other columns are not read. No shuffle.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    types = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_clauses", pa.int64())])

    def run(batches: Batches) -> Batches:
        own = sent.value
        for batch in batches:
            clauses = [matched_clauses(t, own.lexicon) for t in texts_of(batch)]
            scores, counts = [own.score(c) for c in clauses], [len(c) for c in clauses]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], schema=types)

    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = map_batches(rows, run, "doc_id bigint, score double, n_clauses bigint")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "n_clauses")
