"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text, and every rule is a
row of a table (name, measure, bounds) that becomes one comparison; nothing is
shuffled and no user function runs. Measures are ratios with a floor in the
denominator, so empty texts divide by one.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; the same row repeated gives the same verdict; other columns of the
input stay as they are, also when they carry a measure's name, since measures
live in one struct column whose name the caller chooses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that end words, and characters counted as symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Digits and marks that prose uses little.
OTHER = "0123456789!?=+~^_@/\\[]{}()"

#: Frequent function words of the four languages.
STOP_WORDS = (
    # English
    "the a an and or of to in on at by for from with as is are was were be it that this he she they",
    # French
    "le la les un une des du de et ou en dans par pour sur avec que qui ce est sont au aux il elle",
    # German
    "der die das den dem ein eine und oder in im zu von mit auf für ist sind war nicht sich es auch",
    # Spanish
    "el la los las un una de del y o en con por para que se su es son al no lo como",
)


@dataclass(frozen=True)
class Rule:
    """Keep a text whose measure lies in [low, high]; a missing bound is open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The thresholds; a text is kept if the base rule and all of these hold.
RULES = (
    Rule("long_enough", "n_words", low=50),
    Rule("word_length", "mean_word_length", low=2.0, high=15.0),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("shouting", "upper_share", high=0.40),
    Rule("digits_and_marks", "other_share", high=0.25),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("repeated_lines", "dup_line_share", high=0.60),
    Rule("repeated_windows", "repeat_share", high=0.50),
    Rule("bullets", "bullet_line_share", high=0.90),
    Rule("ellipses", "ellipsis_line_share", high=0.30),
)


def bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def occurrences(text: Column, characters: str) -> Column:
    """How often any of the characters occurs."""
    inside = "".join(f"\\x{{{ord(c):x}}}" for c in characters)
    return F.length(text) - F.length(F.regexp_replace(text, f"[{inside}]+", ""))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of `width` words that the array holds twice or more.

    Windows are compared by a 64-bit hash. Only the windows of a text whose
    hashes are not all different are sorted by (hash, place), so that equal ones
    are neighbours; the places of those with an equal neighbour are then merged.
    """

    def places(s: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(s, k)["h"] == F.get(s, k + j)["h"], F.lit(False))
        repeated = F.filter(s, lambda x, k: same(k, -1) | same(k, 1))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(-width).cast("int").alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            p,
            start,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).cast("bigint").alias("n")
            ),
            lambda acc: acc["n"],
        )

    def repeats(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            bind(F.sort_array(pairs), lambda s: covered(places(s)))
        )

    def count(ws: Column) -> Column:
        starts = F.slice(ws, 1, F.greatest(F.size(ws) - (width - 1), F.lit(0)))
        hashes = F.transform(
            starts, lambda w, i: F.xxhash64(w, *[F.get(ws, i + j) for j in range(1, width)])
        )
        return bind(hashes, repeats)

    return bind(words, count)


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    whole = F.coalesce(text, F.lit(""))
    stop = sorted({w for line in STOP_WORDS for w in line.split()})

    def of(t: Column) -> Column:
        return bind(
            F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""),
            lambda ws: bind(
                F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
                lambda lines: counts(t, ws, lines),
            ),
        )

    def counts(t: Column, ws: Column, lines: Column) -> Column:
        def long(c: Column) -> Column:
            return c.cast("bigint")

        solid = F.aggregate(ws, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w))
        return F.struct(
            long(F.size(ws)).alias("n_words"),
            solid.alias("word_chars"),
            long(occurrences(t, SYMBOLS)).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            repeated_window_words(ws).alias("n_repeat_words"),
            long(F.size(lines)).alias("n_lines"),
            long(occurrences(t, UPPER)).alias("n_upper"),
            long(occurrences(t, OTHER)).alias("n_other"),
            long(F.size(F.filter(ws, lambda w: F.lower(w).isin(stop)))).alias("n_stop_words"),
            long(F.size(F.filter(lines, lambda x: F.ltrim(x).rlike("^[-*•]")))).alias("n_bullet_lines"),
            long(F.size(F.filter(lines, lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)$")))).alias("n_ellipsis_lines"),
        )

    return bind(whole, of)


def _ratio(top: Column, bottom: Column) -> Column:
    return top / F.greatest(bottom, F.lit(1))


def ratios(m: Column) -> dict[str, Column]:
    """The measures that rules may bound, by name."""
    return {
        "n_words": m["n_words"],
        "mean_word_length": _ratio(m["word_chars"], m["n_words"]),
        "symbols_per_word": _ratio(m["n_symbols"], m["n_words"]),
        "upper_share": _ratio(m["n_upper"], m["word_chars"]),
        "other_share": _ratio(m["n_other"], m["word_chars"]),
        "stop_word_share": _ratio(m["n_stop_words"], m["n_words"]),
        "dup_line_share": _ratio(m["n_dup_lines"], m["n_lines"]),
        "repeat_share": _ratio(m["n_repeat_words"], m["n_words"]),
        "bullet_line_share": _ratio(m["n_bullet_lines"], m["n_lines"]),
        "ellipsis_line_share": _ratio(m["n_ellipsis_lines"], m["n_lines"]),
    }


def base_failed(m: Column) -> Column:
    """The fixed rule: fewer than 50 words, or over half of them in repeated windows."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def compile_rules(m: Column, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, Column]]:
    """One boolean column per rule, true where the text passes."""
    values = ratios(m)
    passed = []
    for rule in rules:
        test = F.lit(True)
        if rule.low is not None:
            test = test & (values[rule.measure] >= F.lit(rule.low))
        if rule.high is not None:
            test = test & (values[rule.measure] <= F.lit(rule.high))
        passed.append((rule.name, test))
    return passed


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct from the measures: these, base_failed, failed rule names, kept."""
    failed = F.filter(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in compile_rules(m, rules)]), lambda x: x.isNotNull()
    )
    return F.struct(
        m.alias("measures"),
        base_failed(m).alias("base_failed"),
        failed.alias("failed"),
        (~base_failed(m) & (F.size(failed) == 0)).alias("kept"),
    )


def assess(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality") -> DataFrame:
    """The input with one struct column: the measures, base_failed, failed rule names, kept."""
    held = f"__{out}_measures"
    measured = df.withColumn(held, measures(df[text]))
    return measured.withColumn(out, verdict(F.col(held), rules)).drop(held)


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the base rule and every rule keep, with the columns they came with.

    The condition is one expression that binds the measures: a filter on a computed column would be
    pushed below it, with the measures written out again at each use.
    """
    return df.filter(bind(measures(df[text]), lambda m: verdict(m, rules)["kept"]))
