"""Text as column expressions; all of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no term by themselves.
STOPWORDS = ("the", "and", "of", "in", "to", "for", "a", "an", "on", "by")
TERM = r"[A-Za-z0-9]{2,}|[\x{3400}-\x{9fff}]{2,}"
IDEOGRAPHS = r"^[\x{3400}-\x{9fff}]{2,}$"


def squeezed(c: Column) -> Column:
    """Runs of ASCII white space as one space, none outside."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " "))


def tokens(c: Column) -> Column:
    """Lower-cased words between white space, with repeats."""
    return F.filter(F.split(F.lower(c), r"[ \t\n\r\f]+"), lambda w: w != "")


def term_set(c: Column) -> Column:
    """Distinct terms: words of two or more letters or digits, runs of ideographs and their bigrams; stop words only as whole runs."""
    runs = F.filter(F.regexp_extract_all(c, F.lit(f"({TERM})"), 1), lambda w: ~F.lower(w).isin(*STOPWORDS))
    grams = F.flatten(
        F.transform(
            F.filter(runs, lambda w: w.rlike(IDEOGRAPHS)),
            lambda w: F.transform(F.sequence(F.lit(1), F.char_length(w) - 1), lambda i: w.substr(i, F.lit(2))),
        )
    )
    return F.array_sort(F.array_distinct(F.concat(F.transform(runs, F.lower), grams)))


def sentences(c: Column) -> Column:
    """Sentences of running text: headings, images, table rules and list marks are stripped, ends are 。！？!?；; ."""
    lines = F.filter(F.split(c, "\n"), lambda x: ~x.rlike(r"^\s*(#|!\[|\|?\s*:?-{3,})"))
    plain = F.transform(lines, lambda x: F.regexp_replace(x, r"^\s*([-*+]|[0-9]+[.)])\s+", ""))
    parts = F.flatten(F.transform(plain, lambda x: F.regexp_extract_all(x, F.lit(r"([^。！？!?；;]+[。！？!?；;]*)"), 1)))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def hard_anchors(c: Column) -> Column:
    """Titles in book quotes, dates, percentages and other numbers, first seen first, distinct."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(《[^》]+》|[0-9]{4}年|[0-9]+(?:[.,][0-9]+)*%?)"), 1))


def heading_key(c: Column) -> Column:
    """A heading without its page number, spaces and closing punctuation, for comparisons."""
    bare = F.regexp_replace(c, r"[ .·…　]*[0-9]*[ ]*$", "")
    return F.lower(F.regexp_replace(F.regexp_replace(bare, r"[\s　]+", ""), r"[:：。.,，;；]+$", ""))


def slug(c: Column) -> Column:
    """A path-safe name: white space and unsafe signs become one hyphen."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(c), r"[\\/:*?\"<>|#\s]+", "-"), r"^-+|-+$", ""))


def heading_style(c: Column) -> Column:
    """The numbering style of a heading, by precedence."""
    return (
        F.when(c.rlike(r"^第[一二三四五六七八九十百0-9]+[章编篇部]"), "chapter")
        .when(c.rlike(r"^第[一二三四五六七八九十百0-9]+节"), "section")
        .when(c.rlike(r"^[一二三四五六七八九十]+、"), "han_numeral")
        .when(c.rlike(r"^[（(][一二三四五六七八九十]+[）)]"), "han_bracket")
        .when(c.rlike(r"^[0-9]+(\.[0-9]+)+"), "decimal")
        .when(c.rlike(r"^[0-9]+[.、]"), "number")
        .when(c.rlike(r"^[0-9]{4}年?"), "year")
        .when(c.rlike(r"^(Annex|Anexo|Annexe|Anhang)"), "annex")
        .otherwise("plain")
    )


def year_interval(c: Column) -> Column:
    """(lo, hi) of the years 19xx and 20xx that stand as words in a text; null without any."""
    years = F.transform(F.regexp_extract_all(c, F.lit(r"\b(19[0-9]{2}|20[0-9]{2})\b"), 1), lambda y: y.cast("int"))
    return F.when(F.size(years) > 0, F.struct(F.array_min(years).alias("lo"), F.array_max(years).alias("hi")))


def strip_tags(c: Column) -> Column:
    """A table cell without tags and the common entities."""
    c = F.regexp_replace(c, r"<[^<>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return F.trim(c)


def atom_id(article: Column, page: Column, locator: Column) -> Column:
    return F.concat(article, F.lit(":p"), F.lpad(page.cast("string"), 3, "0"), F.lit(":b"), locator)


def code_points(c: Column) -> Column:
    """The engine's plain token count: code points, one at least."""
    return F.greatest(F.char_length(c), F.lit(1))


def stable_id(prefix: str, *parts: Column, length: int = 16) -> Column:
    """A short hash of parts joined by the unit separator."""
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, length))
