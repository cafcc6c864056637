"""Line-first cleaning with DataFrame functions only.

Every line with a word is tested on its own and dropped if it fails a rule:

* punctuation: too many of its characters are neither letters, digits, white space
  nor ordinary prose marks; or it is a stub of one or two words without any mark;
* navigation: at least three words are bare separators (``|``, ``>``, ``»``, ...) and
  they are a sixth of its words or more;
* boilerplate: it is short and holds a stock phrase (cookie notice, ...), or stock phrases that prose has too (log in,
  ...) make up half of it.

A document that loses more than ``max_lost`` of its lines' characters to these rules
is rejected, as is one that fails the base rules (fewer than ``min_words`` words, or
over half of its words inside repeated 3-word windows).  All is per row: no shuffle,
no Python.

Null, empty and blank texts have no words and fail the base rules.  Repeated rows
come back repeated; an empty table gives an empty result.  Only ``text`` is read;
in ``clean`` all input columns stay, in ``measure`` the named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, let, words

SYMBOLS = r"[#*$%&|<>]"
#: A bare separator of menus and breadcrumbs: a word of its own, at a line's end or before a space.
SEPARATOR = r"(?:^|(?<=\s))(?:[|>»›•·/–—-]|::|>>|\|\|)(?=\s|$)"
#: Characters that are neither letters, marks, digits, white space nor ordinary prose marks.
ODD = r"[^\p{L}\p{M}\p{N}\s.,;:?'\"()’‘“”…«»、。¿¡-]"
#: A line of one or two words without any punctuation mark.
STUB = r"^\s*[^\s\p{P}]+(?:\s+[^\s\p{P}]+)?\s*$"
#: Stock phrases of page furniture: any short line with one of the first goes, while the second are common in prose
#: too and must make up at least half of a line's characters.
PHRASES = ("all rights reserved", "terms of service", "privacy policy", "cookie policy", "use cookies", "enable javascript",
           "skip to content", "lorem ipsum")
COMMON_PHRASES = ("click here", "log in", "read more", "share this", "sign in", "sign up", "subscribe to", "terms of use")

MIN_WORDS, REPEAT_PERCENT, MAX_LOST = 50, 50, 0.5
MAX_ODD, BOILER_CHARS, MIN_SEPARATORS, SEPARATOR_SHARE = 0.15, 160, 3, 6
#: A window's place takes these low bits of its sort key, its hash the rest.
PLACE_BITS = 24


def window(w: Column, i: Column) -> Column:
    """The 3-word window at place ``i``; words hold no space, so the text is unambiguous."""
    return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


def window_keys(w: Column) -> Column:
    """Sorted keys, one of each 3-word window: the upper bits of its hash, then its place."""
    def keys(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0)))
        return F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
                           .bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long")))

    return F.sort_array(let(w, keys))


def _covered(places: Column) -> Column:
    """Words in the windows at these ascending places: three each, less what the last one covered."""
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                       lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
                       lambda a: a["n"])


def _repeats_by_text(w: Column) -> Column:
    """Words in repeated windows, by sorting the windows' texts."""
    def twice(s: Column) -> Column:
        hit = F.filter(s, lambda x, j: x["t"].eqNullSafe(F.get(s, j - 1)["t"]) | x["t"].eqNullSafe(F.get(s, j + 1)["t"]))
        return _covered(F.sort_array(F.transform(hit, lambda x: x["i"])))

    at = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(window(w, i).alias("t"), i.alias("i")))
    return let(F.sort_array(at), twice)


def repeat_words(w: Column, keys: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more, exactly.

    ``w``: array of words, ``keys``: its ``window_keys``.  Windows of one text are
    neighbours in the keys' order.  Where two neighbours agree in the hash but not in
    the text, or places don't fit their bits, the windows' texts are sorted instead.
    """
    def same(x: Column, y: Column) -> Column:
        return F.shiftright(x, PLACE_BITS).eqNullSafe(F.shiftright(y, PLACE_BITS))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def counted(w: Column, s: Column) -> Column:
        def judged(hit: Column) -> Column:
            def clash(x: Column, j: Column) -> Column:
                before = F.get(hit, j - 1)
                return same(x, before) & (window(w, place(x)) != window(w, place(before)))

            return (F.when(F.size(hit) == 0, F.lit(0))
                    .when(F.exists(F.transform(hit, clash), lambda c: c), _repeats_by_text(w))
                    .otherwise(_covered(F.sort_array(F.transform(hit, place)))))

        return let(F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1))), judged)

    return let(w, lambda w: F.when(F.size(w) < 3, F.lit(0)).when(F.size(w) >= 1 << PLACE_BITS, _repeats_by_text(w))
               .otherwise(let(keys, lambda s: counted(w, s))))


def _phrases(phrases: tuple[str, ...]) -> str:
    """Any of the phrases as whole words, in either case."""
    return "(?i)(?<![A-Za-z0-9_])(?:" + "|".join(phrases) + ")(?![A-Za-z0-9_])"


def bad_line(line: Column) -> Column:
    """True if a line with a word fails one of the line rules."""
    def navigation(n: Column) -> Column:
        return (n >= MIN_SEPARATORS) & (n * SEPARATOR_SHARE >= F.size(words(line)))

    odd = F.length(line) - F.length(F.regexp_replace(line, ODD, ""))
    rest = F.length(F.regexp_replace(line, _phrases(COMMON_PHRASES), ""))
    separators = F.size(F.regexp_extract_all(line, F.lit(SEPARATOR), F.lit(0)))
    return ((odd > MAX_ODD * F.length(line)) | line.rlike(STUB)
            | ((F.length(line) <= BOILER_CHARS) & (line.rlike(_phrases(PHRASES)) | (2 * rest <= F.length(line))))
            | let(separators, navigation))


def measure(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), min_words: int = MIN_WORDS,
            repeat_percent: int = REPEAT_PERCENT, max_lost: float = MAX_LOST) -> DataFrame:
    """The named columns and the figures and verdicts of every row, with ``clean_text``, the lines that pass."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    named = [F.col(c).alias(f"_in_{c}") for c in columns]
    parts = docs.select(
        *named, words(F.col("text")).alias("_w"), lines.alias("_lines"),
        F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0))).cast("long").alias("n_symbols"))
    keyed = parts.select("*", window_keys(F.col("_w")).alias("_keys"), F.filter("_lines", lambda x: ~bad_line(x)).alias("_good"))
    counted = keyed.select(
        *[f"_in_{c}" for c in columns], "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w"), F.col("_keys")).cast("long").alias("n_repeat_words"),
        F.length(F.array_join("_lines", "")).alias("_chars"), F.length(F.array_join("_good", "")).alias("_stay"),
        F.array_join("_good", "\n").alias("clean_text"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return counted.select(
        *[F.col(f"_in_{c}").alias(c) for c in columns],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("_stay") >= (1 - max_lost) * F.col("_chars"))).alias("kept"),
        (F.col("_stay") == F.col("_chars")).alias("unchanged"), "clean_text")


def clean(docs: DataFrame, **limits) -> DataFrame:
    """Rows that are kept, their ``text`` without the failing lines (``n_chars``, if there, to match).

    A kept text that loses no line stays as it is, blank lines included.
    """
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), "text")
    judged = measure(whole, columns=("_row", "text"), **limits)
    # a plain filter would be pushed down and have all of the above worked out twice
    kept = F.explode_outer(F.filter(F.array(F.struct("*")), lambda r: r["kept"])).alias("good")
    good = judged.select(kept).where("good.kept").select("good.*")
    new = F.when(F.col("unchanged"), F.col("text")).otherwise(F.col("clean_text"))
    fresh = {"text": new}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType)
    return good.select(*[fresh.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])
