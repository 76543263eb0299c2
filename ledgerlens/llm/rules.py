"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a Boolean column over shared text measures.  Its cost (the work
units of the measure, from the mean text length of a sample) and its
selectivity (the share of the sample that it rejects) set the order: the rule
with the most rejections per cost comes first.  The cascade is one CASE: a
document that a cheap rule rejects never pays for the later measures.  The
order changes the work and the reason reported, never which documents stay.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, with_held, words_of

SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Measures:
    """What the rules look at: columns of a table, or expressions over its text."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    exclamations: Column
    capitals: Column
    n_lines: Column
    n_dup_lines: Column


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures to a Boolean; the work is
    ``per_char`` and ``per_word`` units for each character and word."""

    name: str
    rejects: Callable[[Measures], Column]
    per_char: float
    per_word: float


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(lines: Column) -> Column:
    """Lines that equal an earlier line."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def measures_of(text: Column, words: Column) -> Measures:
    """The measures as expressions, each worked out where a rule uses it."""
    whole, lines = F.coalesce(text, F.lit("")), _lines(text)
    return Measures(F.size(words).cast("long"), word_chars(words), n_symbols(text), F.regexp_count(whole, F.lit("!")),
                    F.regexp_count(whole, F.lit("[A-Z]")), F.size(lines).cast("long"), n_dup_lines(lines))


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, in text order."""
    n = F.size(words)
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _repeated(ordered: Column) -> Column:
    """The values that occur more than once in the sorted array column ``ordered``."""
    return F.array_distinct(F.filter(ordered, lambda x, i: (i > 0) & (x == F.get(ordered, i - 1))))


_POWERS = [1 << b for b in range(30, -1, -1)]


def _steps(values: Column) -> Column:
    """Falling powers of two up to the size of ``values``: the steps of a search."""
    bits = F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.slice(F.array(*[F.lit(p) for p in _POWERS]), F.lit(31) - bits, bits + 1)


def _found(values: Column, steps: Column, x: Column) -> Column:
    """Whether the sorted ``values`` hold ``x``: a binary search."""
    return F.aggregate(
        steps, F.lit(0),
        lambda p, s: F.when((p + s <= F.size(values)) & (F.get(values, p + s - 1) <= x), p + s).otherwise(p),
        lambda p: (p > 0) & F.coalesce(F.get(values, p - 1) == x, F.lit(False)))


def _spots(hashes: Column, repeated: Column, steps: Column) -> Column:
    """The places in ``hashes`` whose value is one of ``repeated``."""
    own = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.when(
        F.size(repeated) <= 16, F.array_contains(repeated, F.get(hashes, i))).otherwise(_found(repeated, steps, F.get(hashes, i))))
    return F.when(F.size(repeated) > 0, own).otherwise(F.array().cast("array<int>"))


def _covered(spots: Column) -> Column:
    """Words covered by 3-word windows that begin at the rising ``spots``."""
    # the last has no next one: least() passes over the null
    fresh = F.zip_with(spots, F.slice(spots, F.lit(2), F.size(spots)), lambda p, q: F.least(F.lit(3), q - p))
    return F.aggregate(fresh, F.lit(0).cast("bigint"), lambda s, x: s + x)


def with_repeat_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """``docs`` with the number of words of array ``words`` in repeated 3-word windows.

    The windows are compared by 64-bit hashes within one text; texts in which
    no hash repeats stop at the first step.
    """
    h, o, r, s, p = (free_name(docs, c) for c in ("w_hashes", "w_sorted", "w_repeated", "w_steps", "w_spots"))
    none = F.array().cast("array<bigint>")
    at = with_held(docs, h, window_hashes(F.col(words)))
    at = with_held(at, o, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)).otherwise(none))
    at = with_held(at, r, _repeated(F.col(o)))
    at = with_held(at, s, _steps(F.col(r)))
    at = with_held(at, p, _spots(F.col(h), F.col(r), F.col(s)))
    return with_held(at, out, _covered(F.col(p))).drop(h, o, r, s, p)


#: Fixed thresholds of the default rules, as whole-number comparisons.
DEFAULT_RULES = (
    Rule("symbols", lambda m: m.n_symbols * 10 > m.n_words, 1.0, 0.0),
    Rule("exclamations", lambda m: m.exclamations * 5 > m.n_words, 1.0, 0.0),
    Rule("short_words", lambda m: m.word_chars < m.n_words * 2, 0.2, 2.0),
    Rule("long_words", lambda m: m.word_chars > m.n_words * 12, 0.2, 2.0),
    Rule("capitals", lambda m: m.capitals * 2 > m.word_chars, 1.5, 2.0),
    Rule("line_copies", lambda m: m.n_dup_lines * 2 > m.n_lines, 3.0, 0.0),
)


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words (long), measured over the whole text.

    Null and blank texts have 0 in all of them.  The 3-word windows are
    compared by 64-bit hashes within one text.  All steps work inside the row:
    nothing is shuffled, and a row's work grows as n log n of its words.  A
    column of ``docs`` with the name of a measure is replaced.
    """
    n = free_name(docs, "w_lines")
    return _measured(docs, text, n).drop(n)


def _measured(docs: DataFrame, text: str, line_count: str) -> DataFrame:
    """:func:`with_measures`, and the number of lines with a word in ``line_count``."""
    w, lines = free_name(docs, "w_words"), free_name(docs, "w_line_array")
    out = with_held(docs, w, words_of(F.col(text)))
    out = with_held(with_repeat_words(out, w, "n_repeat_words"), lines, _lines(F.col(text)))
    return out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": word_chars(F.col(w)),
        "n_symbols": n_symbols(F.col(text)),
        "n_dup_lines": n_dup_lines(F.col(lines)),
        line_count: F.size(lines).cast("long"),
    }).drop(w, lines)


def rule_order(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS,
               seed: int = 42) -> list[dict]:
    """The rules by falling rejections per cost, measured on a seeded sample of
    about ``sample_rows`` rows in one pass.  Ties and an empty sample keep the
    given order."""
    n = docs.select(F.lit(1)).count()
    if n == 0:
        return [{"rule": r, "cost": r.per_char + r.per_word, "rejects": 0.0} for r in rules]
    sample = docs.select(F.col(text).alias("t")).sample(fraction=min(1.0, sample_rows / n), seed=seed)
    sample = sample.withColumn("w", words_of(F.col("t")))
    seen = measures_of(F.col("t"), F.col("w"))
    sums = sample.agg(
        F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0)), F.coalesce(F.sum(F.size("w")), F.lit(0)),
        *[F.coalesce(F.sum(r.rejects(seen).cast("int")), F.lit(0)) for r in rules]).first()
    rows = max(1, sums[0])
    out = [{"rule": r, "cost": max(1.0, r.per_char * sums[1] / rows + r.per_word * sums[2] / rows), "rejects": sums[3 + i] / rows}
           for i, r in enumerate(rules)]
    return sorted(out, key=lambda x: -x["rejects"] / x["cost"])


def cascade(seen: Measures, ordered: list[dict]) -> Column:
    """Name of the first rule in ``ordered`` that rejects, else null."""
    first, *rest = [x["rule"] for x in ordered]
    out = F.when(first.rejects(seen), F.lit(first.name))
    for rule in rest:
        out = out.when(rule.rejects(seen), F.lit(rule.name))
    return out


def judge(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``rejected_by`` (null: no rule rejects the row).

    Null and empty texts pass every rule: length is the base check's matter.
    """
    w = free_name(docs, "w_words")
    ordered = rule_order(docs, rules, text, sample_rows)
    return (with_held(docs, w, words_of(F.col(text)))
            .withColumn("rejected_by", cascade(measures_of(F.col(text), F.col(w)), ordered)).drop(w))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (n_words < 50) | (n_repeat_words * 100 > n_words * 50)


def quality_rules(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    ``kept`` is false where the base check fails, else whether no rule rejects.
    The cascade runs only on rows that pass the base check.
    """
    ordered = rule_order(docs, rules, text, sample_rows)
    n = free_name(docs, "w_lines")
    out = _measured(docs, text, n)
    out = out.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    # the base measures are there already; the others are worked out inside the cascade
    seen = replace(measures_of(F.col(text), F.lit(None).cast("array<string>")), n_lines=F.col(n),
                   **{c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")})
    out = out.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(seen, ordered))).drop(n)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def passing(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, columns unchanged.

    Cheapest checks first: the word count, the cascade, and only for what is
    left the repeated windows.
    """
    ordered = rule_order(docs, rules, text, sample_rows)
    w, chars = free_name(docs, "w_words"), free_name(docs, "w_chars")
    out = with_held(docs, w, words_of(F.col(text))).filter(F.size(w) >= 50)
    out = with_held(out, chars, word_chars(F.col(w)))
    seen = replace(measures_of(F.col(text), F.col(w)), word_chars=F.col(chars))
    out = out.filter(cascade(seen, ordered).isNull())
    n = free_name(docs, "w_repeat")
    out = with_repeat_words(out, w, n)
    return out.filter(~base_failed(F.size(w), F.col(n))).select(*[F.col(f"`{c}`") for c in docs.columns])
