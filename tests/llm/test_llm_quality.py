"""Limits that follow their language and source, and rules that each reject something."""

import random

from pyspark.sql import functions as F

from fleetpulse.llm import quality

NAMES = [r.name for r in quality.RULES]


def rates_of(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{n} bigint" for n in NAMES))


def limits_of(spark, rows, **options):
    made = quality.thresholds(rates_of(spark, rows), **options)
    return {r[0]: tuple(r)[1:] for r in made.collect()}


def brute_limits(rows, prior):
    def own(part, k):
        rule, steps = quality.RULES[k], sorted(r[2 + k] >> max(r[2 + k].bit_length() - 10, 0) << max(r[2 + k].bit_length() - 10, 0) for r in part)
        q1, q3 = (steps[-(-q * len(steps) // 4) - 1] for q in (1, 3))
        return q3 + quality.SPREAD * max(q3 - q1, rule.floor)

    out = {}
    for group in {r[:2] for r in rows}:
        drawn = []
        for k in range(len(NAMES)):
            limit = own(rows, k)
            for part in ([r for r in rows if r[0] == group[0]], [r for r in rows if r[:2] == group]):
                limit = (len(part) * own(part, k) + prior * limit) // (len(part) + prior)
            drawn.append(limit)
        out[group] = tuple(drawn)
    return out


def test_limits_against_brute_force(spark):
    draw = random.Random(4)
    groups = [("en", "a", 300, 1), ("en", "b", 40, 9), ("de", "a", 1, 3), (None, "b", 7, 2), ("de", None, 90, 5), ("fr", "x", 5, 40_000)]
    rows = [(g, s, *(draw.randrange(0, 60) * shift for _ in NAMES)) for g, s, n, shift in groups for _ in range(n)]
    expected = brute_limits(rows, 20)
    made = limits_of(spark, rows, prior=20)
    text = lambda v: "null" if v is None else f'"{v}"'
    keys = {group: "{" + ",".join(f'"{n}":{text(v)}' for n, v in zip(("lang", "source"), group) if v is not None) + "}" for group in expected}
    assert made == {keys[group]: limit for group, limit in expected.items()}


def test_a_shifted_source_gets_other_limits(spark):
    draw = random.Random(6)
    plain = [("en", f"s{k}", 450 + draw.randrange(60), draw.randrange(4), 0, 0) for k in range(4) for _ in range(300)]
    shifted = [("en", "code", 600 + draw.randrange(200), 40 + draw.randrange(90), draw.randrange(200), draw.randrange(150)) for _ in range(300)]
    found = limits_of(spark, plain + shifted)
    usual, code = found['{"lang":"en","source":"s0"}'], found['{"lang":"en","source":"code"}']
    assert all(c > u for u, c in zip(usual, code))


def test_limits_move_without_a_switch(spark):
    """One row more changes a limit by what a row weighs, at every size."""
    base = [("en", "a", 500, 0, 0, 0)] * 1000
    limits = [limits_of(spark, base + [("en", "b", 900, 0, 0, 0)] * n)['{"lang":"en","source":"b"}'][0] for n in (1, 50, 199, 200, 201)]
    assert limits == sorted(limits) and max(b - a for a, b in zip(limits[2:], limits[3:])) <= 2


def test_every_rule_rejects_texts_that_pass_the_base(spark):
    draw = random.Random(8)
    word = lambda n: "".join(draw.choices("abcdefghijklmnop", k=n))
    prose = [" ".join(word(draw.randrange(2, 9)) for _ in range(60)) for _ in range(300)]
    passage = " ".join(word(5) for _ in range(14))
    line = word(6) + " " + word(7)
    bad = {
        1001: " ".join(word(16) for _ in range(60)),
        1002: " ".join(word(5) + "##" for _ in range(60)),
        1003: "\n".join([line] * 6 + [" ".join(word(5) for _ in range(20)) for _ in range(4)]),
        1004: " ".join([passage, *(word(5) for _ in range(72)), passage]),
    }
    rows = [*enumerate(prose), *bad.items()]
    docs = spark.createDataFrame([(k, t, "en", "web") for k, t in rows], "doc_id bigint, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality.report(docs).collect()}
    assert all(not found[k]["base_failed"] and not found[k]["kept"] for k in bad)
    assert all(found[k]["kept"] for k in range(300))


def test_bins_keep_leading_bits(spark):
    steps = [0, 1, 1023, 1024, 2047, 2048, 2049, 5_000_001, 2**62 + 12345]
    made = spark.createDataFrame([(s,) for s in steps], "step bigint").select(quality.sketch_bin(F.col("step")).alias("b")).collect()
    assert [r["b"] for r in made] == [s >> max(s.bit_length() - 10, 0) << max(s.bit_length() - 10, 0) for s in steps]
