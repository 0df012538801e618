"""Quality rules: a threshold table compiled into one projection; built-in functions only.

A rule bounds one measure of a text, as a whole number or in hundredths of
another measure, so that every comparison is between integers.  ``measured``
builds all measures of a text as one struct, ``failed`` turns the table into an
array of the names of the rules that the text breaks, and ``judged`` puts both
into a single projection: no shuffle, no user function, a row in and a row out.

Measures (words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n`` and count when they hold a word):

* n_words, word_chars (code points in words), n_letter_words (words with a letter),
  n_stop_words (words of ``STOP_WORDS``, lower-cased), n_symbols (``SYMBOLS``);
* n_lines, n_dup_lines (equal to an earlier line), n_bullet_lines, n_ellipsis_lines;
* n_repeat_words: words in five-word windows that the text holds twice or more,
  the first one included.  Where two hashes of windows agree, the
  text's windows are sorted by hash and words, so the cost grows as n log n and chance matches do not count.

A null or empty text has no words: it fails the base rules and is not kept.
Null ids and repeated rows are judged like any other row; further columns can be
carried along (``keep``), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, the symbols, and the window whose repeats count.
SPACE = r" \t\n\x0B\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BULLETS = "-*•"

# The commonest words of seven languages.
STOP_WORDS = tuple(
    "the of and to a in is that it for was on with as be by this are at from he she they not have has but or you we "
    "der die das und den von zu mit sich des auf für ist im nicht dem ein eine als auch "
    "de la le et les en un du une que pour est par qui dans avec sur pas au ne "
    "el y los se del las por con no su para es al lo como más "
    "il di che è per una sono della non si "
    "o os da do em uma não com dos "
    "het van een dat niet zijn op te".split())


@dataclass(frozen=True)
class Rule:
    """``least <= measure <= greatest``; with ``per``, of 100 * measure / per, and no text with ``per`` 0 breaks it.
    ``over`` leaves alone texts of fewer words."""

    name: str
    measure: str
    per: str | None = None
    least: int | None = None
    greatest: int | None = None
    over: int = 0


# The base rules, then the ratios that prose keeps to.
BASE = (
    Rule("few_words", "n_words", least=10),
    Rule("repeated_words", "n_repeat_words", per="n_words", greatest=20),
)
RATIOS = (
    Rule("word_length", "word_chars", per="n_words", least=200, greatest=1500),
    Rule("symbols", "n_symbols", per="n_words", greatest=20),
    Rule("letters", "n_letter_words", per="n_words", least=50),
    Rule("stop_words", "n_stop_words", per="n_words", least=2, over=50),
    Rule("repeated_lines", "n_dup_lines", per="n_lines", greatest=50),
    Rule("bullet_lines", "n_bullet_lines", per="n_lines", greatest=90, over=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", per="n_lines", greatest=30, over=50),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` and its lambdas name it."""
    return F.get(F.transform(F.array(value), body), 0)


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _marked(windows: Column) -> Column:
    """Places, in order, of the sorted windows that have an equal neighbour."""
    def twin(x, k):
        same = lambda o: F.coalesce(x["words"] == F.get(windows, k + o)["words"], F.lit(False))
        return same(-1) | same(1)

    return F.sort_array(F.transform(F.filter(windows, twin), lambda x: x["at"]))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more; ``words`` must be cheap to name again.  Where all
    hashes differ, as in most texts, nothing is sorted."""
    starts = F.sequence(F.lit(0), F.size(words) - window)

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window))))
        return F.aggregate(own, F.lit(0), lambda s, x: s + x)

    def of_hashes(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
            h.alias("hash"), F.slice(words, i + 1, window).alias("words"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(let(windows, _marked), covered)).otherwise(F.lit(0))

    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + o) for o in range(window)]))
    return F.when(F.size(words) > window, let(hashes, of_hashes)).otherwise(F.lit(0))


def measured(text: Column) -> Column:
    """All measures of a text as one struct of longs."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    long = lambda c, name: c.cast("long").alias(name)

    def of_words(w: Column) -> Column:
        return F.struct(
            long(F.size(w), "n_words"), long(F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))), "n_stop_words"),
            long(repeated_words(w), "n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        matching = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p)))
        return F.struct(
            long(F.size(lines), "n_lines"), long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
            long(matching(f"^[{SPACE}]*+[{BULLETS}]"), "n_bullet_lines"),
            long(matching(rf"(?:\.\.\.|…)[{SPACE}]*$"), "n_ellipsis_lines"))

    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    of_text = F.struct(
        long(F.length(F.translate(whole, " \t\n\x0b\f\r", "")), "word_chars"),
        long(F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")), "n_symbols"),
        # from the start of a word over what is no letter to its first letter, without a way back
        long(F.regexp_count(whole, F.lit(rf"(?<![^{SPACE}])[^\p{{L}}{SPACE}]*+\p{{L}}")), "n_letter_words"))
    return F.struct(let(word_list(whole), of_words).alias("words"), let(lines, of_lines).alias("lines"), of_text.alias("text"))


PARTS = {
    "words": ("n_words", "n_stop_words", "n_repeat_words"),
    "lines": ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines"),
    "text": ("word_chars", "n_symbols", "n_letter_words"),
}
MEASURES = tuple(m for part in PARTS.values() for m in part)


def failed(measures: dict[str, Column], rules: Sequence[Rule]) -> Column:
    """The table as one expression: the names of the rules that are broken, in the table's order."""
    broken = []
    for r in rules:
        value = measures[r.measure] if r.per is None else 100 * measures[r.measure]
        scale = F.lit(1) if r.per is None else measures[r.per]
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (value < r.least * scale)
        if r.greatest is not None:
            bad = bad | (value > r.greatest * scale)
        broken.append(F.when(bad & (measures["n_words"] >= r.over), F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def judged(docs: DataFrame, rules: Sequence[Rule] = BASE + RATIOS, base: Sequence[Rule] = BASE, text: str = "text",
           keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` -> ``keep``, the measures, ``failed`` (names of broken rules), ``base_failed``, ``kept``."""
    def of(m: Column) -> Column:
        by_name = {name: m[part][name] for part, names in PARTS.items() for name in names}
        verdict = failed(by_name, rules)
        return F.struct(*[by_name[n].alias(n) for n in MEASURES], verdict.alias("failed"),
                        (F.size(failed(by_name, base)) > 0).alias("base_failed"), (F.size(verdict) == 0).alias("kept"))

    # named apart from whatever columns the table has
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, let(measured(F.col(f"`{text}`")), of).alias("q"))
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "q.*")
