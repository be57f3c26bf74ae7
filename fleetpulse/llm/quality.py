"""Quality rules with thresholds that adapt to language and source.

Counts of each text give rates; a mergeable sketch of each rate (a histogram
over its whole steps, with bins of bounded relative width for high ones) is kept
for every language and source and merged into the language's and the whole
table's. Quantiles of the sketches set a limit at each level; a group's limit is
drawn towards its language's by their numbers of rows, a language's towards that
of all rows. A join with the limits decides. Everything is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.operators.lookup import lookup_join
from fleetpulse.sinks.tables import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ROW, _KEY = "row", "thresholds_key"


@dataclass(frozen=True)
class Rule:
    """A rate in whole steps that must stay under its group's upper threshold.

    The threshold is the upper quartile plus ``spread`` times the distance of
    the quartiles (at least ``floor`` steps).
    """

    name: str
    over: str
    by: str
    scale: int
    floor: int


RULES = (
    Rule("word_length", "word_chars", "n_words", 100, 20),
    Rule("symbol_rate", "n_symbols", "word_chars", 1000, 15),
    Rule("dup_line_rate", "n_dup_lines", "n_lines", 1000, 60),
    Rule("repeat_rate", "n_repeat_words", "n_words", 1000, 45),
)
SPREAD = 6
PRIOR_ROWS = 200  # the weight of the level above, in rows
SKETCH_BITS = 10  # leading bits of a step that its bin keeps


def counted(text: Column) -> Column:
    """Struct of a text's counts (null: an empty text)."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_parts(parts: Column) -> Column:
        own, kept = parts["words"], parts["lines"]
        return F.struct(
            F.size(own).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(own, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            F.size(kept).cast("bigint").alias("n_lines"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("bigint").alias("n_dup_lines"),
            repeated_words(own).cast("bigint").alias("n_repeat_words"),
        )

    return _let(F.struct(words.alias("words"), lines.alias("lines")), of_parts)


def repeated_words(words: Column, window: int = WINDOW_WORDS) -> Column:
    """Words in windows that occur twice or more, each counted once.

    Windows are compared by 64-bit hashes. Most texts repeat none, which the
    distinct hashes tell; only the others sort theirs.
    """
    last = F.size(words) - window + 1
    hashes = F.when(
        last > 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, window)))
    ).otherwise(F.array().cast("array<bigint>"))

    def of_hashes(own: Column) -> Column:
        placed = F.array_sort(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _let(placed, lambda p: F.array_sort(F.transform(F.filter(p, lambda x, k: _beside(p, x, k)), lambda x: x["i"])))
        covered = F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + window - F.greatest(a["end"], i)).alias("n"), (i + window).alias("end")),
            lambda a: a["n"],
        )
        return F.when(F.size(F.array_distinct(own)) < F.size(own), covered).otherwise(F.lit(0))

    return _let(hashes, of_hashes)


def _beside(placed: Column, one: Column, at: Column) -> Column:
    """Whether a neighbour in hash order has the same hash."""
    before, after = (F.coalesce(F.get(placed, at + step)["h"] == one["h"], F.lit(False)) for step in (-1, 1))
    return before | after


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base_failed(counts: Column) -> Column:
    few = counts["n_words"] < LEAST_WORDS
    return few | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


def rate(counts: Column, rule: Rule) -> Column:
    """The rule's rate in whole steps, rounded down; 0 where there is nothing to divide by."""
    return F.call_function("div", counts[rule.over] * rule.scale, F.greatest(counts[rule.by], F.lit(1))).cast("bigint")


def sketch_bin(step: Column) -> Column:
    """The lower edge of a step's bin: the step itself below 2 ** ``SKETCH_BITS``, beyond that its leading bits."""
    cut = F.greatest(F.length(F.bin(step)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", step, cut), cut)


def sketches(rates: DataFrame) -> DataFrame:
    """Merged histograms: level (0 source, 1 language, 2 all), lang, source, rule, step, n."""
    steps = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), sketch_bin(F.col(r.name)).alias("step")) for r in RULES]))
    own = (
        rates.select("lang", "source", steps.alias("s"))
        .groupBy("lang", "source", "s.rule", "s.step")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("level", F.lit(0))
    )
    by_language = _merged(own, ["lang", "rule", "step"], 1)
    everywhere = _merged(by_language, ["rule", "step"], 2)
    return own.unionByName(by_language, allowMissingColumns=True).unionByName(everywhere, allowMissingColumns=True)


def _merged(parts: DataFrame, keys: list[str], level: int) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("n").alias("n")).withColumn("level", F.lit(level))


def limits(histograms: DataFrame) -> DataFrame:
    """level, lang, source, size and one upper limit for each rule, from the quartiles of the sketches.

    A window holds the bins of one group and rule, some 28,000 of 64-bit steps at most.
    """
    group = Window.partitionBy("level", "lang", "source", "rule")
    placed = histograms.withColumn("below", F.sum("n").over(group.orderBy("step"))).withColumn("size", F.sum("n").over(group))
    quartile = {q: F.min(F.when(4 * F.col("below") >= q * F.col("size"), F.col("step"))) for q in (1, 3)}
    quartiles = placed.groupBy("level", "lang", "source", "rule").agg(
        quartile[1].alias("q1"), quartile[3].alias("q3"), F.max("size").alias("size")
    )
    floors = F.create_map(*[F.lit(x) for r in RULES for x in (r.name, r.floor)])
    limit = F.col("q3") + SPREAD * F.greatest(F.col("q3") - F.col("q1"), floors[F.col("rule")])
    return (
        quartiles.withColumn("limit", limit)
        .groupBy("level", "lang", "source")
        .agg(F.max("size").alias("size"), *[F.max(F.when(F.col("rule") == r.name, F.col("limit"))).alias(r.name) for r in RULES])
    )


def thresholds(rates: DataFrame, prior: int = PRIOR_ROWS) -> DataFrame:
    """One row for each language and source: the key and an upper limit for each rule.

    A level's own limit counts with its rows and the limit of the level above
    with ``prior`` rows, rounded down. Null is a language or source of its own.
    """
    found = materialize(limits(sketches(rates)), "limits")
    own, language, whole = (found.filter(F.col("level") == n).alias(a) for n, a in enumerate(("own", "language", "whole")))
    joined = own.join(language, F.col("own.lang").eqNullSafe(F.col("language.lang"))).join(F.broadcast(whole))

    def drawn(level: str, rule: Rule, above: Column) -> Column:
        size = F.col(f"{level}.size")
        return F.call_function("div", size * F.col(f"{level}.{rule.name}") + prior * above, size + prior)

    choice = [drawn("own", r, drawn("language", r, F.col(f"whole.{r.name}"))).alias(f"most_{r.name}") for r in RULES]
    return joined.select(_key(F.col("own.lang"), F.col("own.source")).alias(_KEY), *choice)


def _key(lang: Column, source: Column) -> Column:
    return F.to_json(F.struct(lang.cast("string").alias("lang"), source.cast("string").alias("source")))


def judged(documents: DataFrame, carry: list[str], prior: int = PRIOR_ROWS) -> DataFrame:
    """``row`` (the carried columns), ``counts``, ``base_failed`` and ``kept`` of each document.

    A null or empty text has no words and fails. Null languages and sources form
    groups of their own. Repeated rows stay and count as often as they occur. An
    empty table gives no rows. Carried columns lie in a struct, so their names
    cannot clash. Counts are made once, in a written table; limits are broadcast
    if their measured size allows, and joined with split hot groups otherwise.
    """
    group = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    counted_rows = documents.select(
        F.struct(*[F.col(c) for c in carry]).alias(_ROW), *group, counted(F.col("text")).alias("counts")
    )
    rows = materialize(
        counted_rows.select(
            _ROW, "lang", "source", "counts", base_failed(F.col("counts")).alias("base_failed"),
            *[rate(F.col("counts"), r).alias(r.name) for r in RULES],
        ),
        "quality",
    )
    most = materialize(thresholds(rows.filter(~F.col("base_failed")), prior), "thresholds")
    keyed = rows.withColumn(_KEY, _key(F.col("lang"), F.col("source"))).withColumn("spread", F.monotonically_increasing_id())
    joined = lookup_join(keyed, most, _KEY, "spread", how="left")
    within = F.lit(True)
    for rule in RULES:
        within = within & F.coalesce(F.col(rule.name) <= F.col(f"most_{rule.name}"), F.lit(True))
    return joined.select(_ROW, "counts", "base_failed", (~F.col("base_failed") & within).alias("kept"))


def report(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, the five counts, base_failed and kept, one row per document."""
    found = judged(documents, [key])
    counts = [F.col(f"counts.{c}").alias(c) for c in COUNTS]
    return found.select(F.col(f"{_ROW}.{key}").cast("bigint").alias("doc_id"), *counts, "base_failed", "kept")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(documents, documents.columns).filter("kept").select(f"{_ROW}.*")
