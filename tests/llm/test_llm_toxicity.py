"""The toxicity grammar: plain sentences, a brute-force reading of clauses, and held-out rows."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import catalog, toxicity
from fleetpulse.llm.toxicity import Lexicon, Model, matched_clauses
from fleetpulse.sources.tables import read_parquet

SF = "/root/testdata/sf0.001"
SF_LARGEST = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learned(spark):
    tables = [read_parquet(spark, f"{SF_LARGEST}/{t}.parquet") for t in ("documents", "labels")]
    return toxicity.learn(*tables)


def verdict(model, text):
    return model.score(matched_clauses(text, model.lexicon)) >= 0.5


def test_held_out_rows(spark, learned):
    scored = toxicity.score(read_parquet(spark, f"{SF_LARGEST}/documents.parquet"), learned)
    held = scored.join(read_parquet(spark, f"{SF_LARGEST}/labels.parquet"), "doc_id").filter("held_out")
    sums = held.agg(*[F.sum(F.expr(e).cast("int")) for e in ("toxic = 1 AND predicted = 1", "toxic", "predicted")]).first()
    both, toxic, predicted = sums
    assert toxic > 50 and both >= 0.9 * toxic and both >= 0.9 * predicted
    assert all(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in held.select("doc_id").collect())
    assert catalog.op6_toxicity(spark, SF).filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()


@pytest.mark.parametrize(
    "text",
    [
        "There is more work in the world this morning, and we discuss the train path.",
        "More people travel and discuss work.",
        "It is worth the price, and they lose the match.",
        "We killed the process and will burn the disc.",
        "The children will find you and tell her.",
        "I will not kill you. I don't want to hurt them.",
        "He said you are an idiot.",
        "You are not an idiot.",
        "Die Kinder gehen heute in die Schule und lernen mit dir.",
        "Ich werde dich morgen besuchen.",
        "Je vais te voir demain, et nous allons manger.",
        "Voy a verte en la casa de tu madre.",
        "",
    ],
)
def test_clean_sentences(learned, text):
    assert not verdict(learned, text)


@pytest.mark.parametrize(
    "text",
    [
        "I will kill you tomorrow.",
        "We are going to hurt them all",
        "You will be killed!",
        "Kill yourself",
        "You idiot!",
        "What a bunch of idiots",
        "Ich werde dich töten.",
        "Je vais te tuer.",
        "Te voy a matar.",
        "Voy a matarte, lo juro.",
        "Te mataré",
    ],
)
def test_toxic_sentences(learned, text):
    assert verdict(learned, text)


def test_contexts_and_weights():
    lexicon = Lexicon({"idiot$": 5.0, "scum$": 5.0, "bomente": 5.0})
    found = lambda text: [e for clause in matched_clauses(text, lexicon) for e in clause]
    assert found("What an IDIOT.") == [(5.0, ("insult",))]
    assert found("you scum; he wrote scum") == [(6.0, ("insult", "target")), (-1.0, ("insult", "report"))]
    assert found("never an idiot") == [(-1.0, ("insult", "negation"))]
    assert found("idiots. bomentexyz") == [(5.0, ("insult",))] * 2
    assert found("scumbag, scums and idiotically clean words. not here") == []
    assert found("I kill you") == [(8.0, ("threat",))]
    assert found("I won't kill you") == [(0.0, ("threat", "negation"))]


def test_stems_need_several_continuations():
    counts = [("worth", 90, 0), ("worthl", 90, 0), ("worthless$", 90, 0), ("bomen", 60, 0)]
    counts += [(f"bomen{c}", 20, 0) for c in "abc"] + [(f"bomen{c}$", 20, 0) for c in "abc"] + [("rare$", 4, 0), ("often$", 50, 50)]
    assert set(toxicity.choose_stems(counts, 100, 1000)) == {"worthless$", "bomen"}


def naive_events(classes):
    """The same grammar read off the clause directly, without states."""
    events = []
    for at, symbol in enumerate(classes):
        before = classes[:at]
        modal = [k for k in range(at) if classes[k] == "modal" and k and classes[k - 1] in ("target", "reader")]
        fated = symbol == "fate" and modal and at - modal[-1] <= toxicity.FATE_REACH
        fated = fated and not any(c in ("target", "reader", "fate") for c in classes[modal[-1] + 1 : at])
        if symbol == "insult":
            weight = 0.0
            weight += toxicity.TARGET * ("target" in before)
            weight += toxicity.NEGATED_INSULT * ("negation" in classes[max(0, at - toxicity.NEGATION_REACH) : at])
            weight += toxicity.REPORTED_INSULT * ("report" in before)
            events.append((at, "insult", weight))
        elif symbol == "vow" or fated:
            weight = toxicity.THREAT + toxicity.NEGATED_THREAT * ("negation" in before) + toxicity.REPORTED_THREAT * ("report" in before)
            events.append((at, "threat", weight))
    return events


def test_machine_against_naive_reading():
    draw = random.Random(5)
    symbols = [c for c in toxicity.CLASSES if c not in ("verb", "strike", "self")]
    threats = 0
    for _ in range(20_000):
        classes = draw.choices(symbols, k=draw.randrange(0, 12))
        own = [(at, labels[0], weight) for at, labels, weight in toxicity.clause_events(classes)]
        assert own == naive_events(classes), classes
        threats += any(kind == "threat" for _, kind, _ in own)
    assert threats > 1_000


def naive_threats(classes):
    """First person, verb and target by a scan: which places end a threat."""
    places, own, verb, target, order, before = [], False, None, None, None, False
    for at, c in enumerate(classes):
        near = lambda place: place is not None and at - place <= toxicity.TARGET_REACH
        if c == "verb" and own and near(target) or c == "target" and (own and near(verb) or not own and near(order)):
            places.append(at)
            verb = target = order = None
            before = False
            continue
        if own and c == "verb":
            verb, target = at, None
        elif own and c == "target":
            verb, target = None, at
        elif c == "verb" and at == 0:
            order = at
        elif c == "self" and not own:
            own, target, order = True, at if before else None, None
        before = c == "target"
    return places


def test_threats_against_a_scan():
    draw = random.Random(7)
    machine, found = toxicity.threats(), 0
    for _ in range(20_000):
        classes = draw.choices(["self", "verb", "target", "other", "other"], k=draw.randrange(0, 12))
        state, places = 0, []
        for at, symbol in enumerate(classes):
            state, name = machine.step(state, symbol)
            if name:
                places.append(at)
        assert places == naive_threats(classes), classes
        found += bool(places)
    assert found > 2_000


def test_without_labels_only_threats_count(spark):
    documents = spark.createDataFrame([(1, "you idiot"), (2, "I will kill you"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learn(documents, labels)
    assert model == Model(model.lexicon, toxicity.NO_LABELS)
    rows = {r["doc_id"]: r["predicted"] for r in toxicity.score(documents, model).collect()}
    assert rows == {1: 0, 2: 1, 3: 0}
