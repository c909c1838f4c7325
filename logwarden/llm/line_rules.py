"""Line-first cleaning: rules remove lines, then documents that lost too much text are rejected.

A line fails when it is boilerplate (a fixed phrase in a short line, in one of four languages),
navigation (few words between separators, or one of at least ``MENU_LINES`` short lines in a row, none
of which ends with a mark; lines without a word do not count between them), loaded with symbols, or
long without a mark at its end, unless the next line goes on in lower case as wrapped prose does. The
remaining lines are the cleaned text. A document is rejected when the base rules fail, or when the
removed lines hold more than ``max_lost`` of its word characters.

Everything is computed inside the row with built-in functions; no text is shuffled. Repeated
windows are found by sorting 64-bit hashes of eight-word windows within the row.

Defined cases: null text counts as empty and has no words, so it fails the base rules; a line
without a word is removed without counting as lost; repeated rows are judged one by one; other
columns of the input are not touched.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.tables import WORD_GAP, let, whole_text

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
MAX_LOST = 0.5
# Phrases of page furniture, in lower case: English, German, French, Spanish.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "accept cookies",
    "use cookies", "subscribe to our newsletter", "sign up for our newsletter", "javascript is disabled",
    "enable javascript", "click here to", "share on facebook", "share on twitter", "skip to content", "back to top",
    "powered by wordpress", "lorem ipsum",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "cookies akzeptieren", "newsletter abonnieren",
    "zum seitenanfang", "auf facebook teilen",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "accepter les cookies", "haut de page",
    "partager sur facebook",
    "todos los derechos reservados", "política de privacidad", "aviso legal", "aceptar cookies", "volver arriba",
    "compartir en facebook",
)
# A phrase starts where no letter from a to z stands before it.
PHRASE = f"(?:^|[^a-z])(?:{'|'.join(BOILERPLATE)})"
SEPARATORS = "[|»›•·]|\\x20>"
# A mark, and closing quotes, brackets and white space after it.
ENDED = f"[.!?,;:…。！？،؟।][\"'”’»)\\]{WORD_GAP}]*\\z"
GOES_ON = f"^[{WORD_GAP}]*\\p{{Ll}}"
BOILERPLATE_WORDS = 40  # a longer line that mentions a phrase is prose about it
LONG_WORDS = 12  # a line of so many words ends with a mark or goes on
ITEM_WORDS = 4
MENU_LINES = 4


def _judged(line: Column, following: Column) -> Column:
    """Whether a line that has a word breaks a rule by itself, and whether it could be an item of a menu."""
    def judged(words: Column) -> Column:
        # The cheap side of each test comes first, so the patterns run on few lines.
        boilerplate = (words <= BOILERPLATE_WORDS) & F.lower(line).rlike(PHRASE)
        separators = F.regexp_count(line, F.lit(SEPARATORS))
        maybe = F.length(line) - F.length(F.translate(line, "|»›•·>", ""))
        navigation = (maybe >= 2) & (maybe * 4 >= words) & (separators >= 2) & (separators * 4 >= words)
        symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
        loaded = symbols * 2 > words
        unended = (words >= LONG_WORDS) & ~line.rlike(ENDED) & ~F.coalesce(following.rlike(GOES_ON), F.lit(False))
        item = (words <= ITEM_WORDS) & ~line.rlike(ENDED)
        return F.struct((unended | loaded | navigation | boilerplate).alias("alone"), item.alias("item"))

    return let(F.regexp_count(line, F.lit(f"[^{WORD_GAP}]+")), judged)


def _in_menu(judged: Column, i: Column) -> Column:
    """Whether line ``i`` is one of ``MENU_LINES`` items in a row."""
    def item(k: int) -> Column:
        return F.coalesce(F.get(judged, i + k)["rule"]["item"], F.lit(False))

    def all_from(k: int) -> Column:
        return reduce(and_, [item(k + j) for j in range(MENU_LINES)])

    return item(0) & reduce(or_, [all_from(-k) for k in range(MENU_LINES)])


def _repeated(words: Column) -> Column:
    """Words inside an eight-word window that the text has twice or more, the first included."""

    def found(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twins = F.transform(s, lambda x, k: F.when(
                (F.get(s, k + 1)["h"] == x["h"]) | (F.get(s, k - 1)["h"] == x["h"]), x["i"]))
            return F.sort_array(F.array_compact(twins))

        def covered(at: Column) -> Column:
            steps = F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

        count = let(let(ordered, places), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(count)

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) > WINDOW, let(windows, found)).otherwise(F.lit(0).cast("bigint"))


def measures(text: Column) -> Column:
    """Struct of the base measures and of the verdict on the lines of ``text``."""

    def per_text(t: Column) -> Column:
        words = F.regexp_extract_all(t, F.lit(f"[^{WORD_GAP}]+"), F.lit(0))
        lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(f"[^{WORD_GAP}]"))

        def of_words(w: Column) -> Column:
            return F.struct(F.size(w).cast("bigint").alias("n_words"), _repeated(w).alias("n_repeat_words"))

        def of_lines(found: Column) -> Column:
            alone = F.transform(found, lambda line, i: F.struct(
                line.alias("line"), F.length(F.translate(line, " \t\n\u000b\f\r", "")).cast("bigint").alias("size"),
                _judged(line, F.get(found, i + 1)).alias("rule")))
            judged = let(alone, lambda a: F.transform(a, lambda x, i: F.struct(
                x["line"].alias("line"), x["size"].alias("size"), (x["rule"]["alone"] | _in_menu(a, i)).alias("bad"))))
            return let(judged, lambda j: F.struct(
                (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
                F.size(found).cast("bigint").alias("n_lines"),
                F.size(F.filter(j, lambda x: x["bad"])).cast("bigint").alias("n_bad_lines"),
                F.aggregate(j, F.lit(0).cast("bigint"), lambda s, x: s + x["size"]).alias("word_chars"),
                F.aggregate(F.filter(j, lambda x: x["bad"]), F.lit(0).cast("bigint"),
                            lambda s, x: s + x["size"]).alias("lost_chars"),
                F.array_join(F.transform(F.filter(j, lambda x: ~x["bad"]), lambda x: x["line"]), "\n").alias("clean_text")))

        symbols = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint")
        return F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), symbols.alias("n_symbols"))

    return let(text, per_text)


def judge(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """Per row: ``doc_id``, the base measures, ``base_failed``, line counts, ``clean_text`` and ``kept``."""
    m = docs.select(docs["doc_id"].alias("doc_id"), measures(whole_text(docs)).alias("m"))
    out = m.select("doc_id", "m.w.n_words", "m.l.word_chars", "m.n_symbols", "m.l.n_dup_lines", "m.w.n_repeat_words",
                   "m.l.n_lines", "m.l.n_bad_lines", "m.l.lost_chars", "m.l.clean_text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_chars") <= F.lit(max_lost) * F.col("word_chars")))
