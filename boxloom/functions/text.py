"""String helpers of rule and span texts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_attachments(text: Column) -> Column:
    """Attachment points with any number or map label as a plain `*`."""
    return F.regexp_replace(text, "\\[\\d*\\*(?::\\d+)?\\]", "*")


def cut_at(text: Column, marker: str) -> Column:
    """What stands before the first marker."""
    return F.trim(F.substring_index(text, marker, 1))


def ring_digits(text: Column) -> Column:
    """Digits outside brackets, in order."""
    return F.regexp_replace(F.regexp_replace(text, "\\[[^\\]]*\\]", ""), "[^0-9]", "")


def number(value: Column, decimals: int = 3) -> Column:
    """A number without trailing zeros; a whole one without a point."""
    text = F.format_string(f"%.{decimals}f", value.cast("double"))
    return F.when(text.contains("."), F.regexp_replace(text, "\\.?0+$", "")).otherwise(text)


def signed(value: Column, decimals: int = 3) -> Column:
    return F.concat(F.when(value > 0, "+").otherwise(""), number(value, decimals))


def listed(items: Column) -> Column:
    """`a, b and c` of an array."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n == 0, "").when(n == 1, items[0]).otherwise(F.concat(head, F.lit(" and "), F.element_at(items, -1)))


def folded(text: Column) -> Column:
    """Typographic quotes and dashes as plain ones, runs of blanks as one."""
    return F.trim(F.regexp_replace(F.translate(text, "‘’“”‐‑‒–—―− ", "''\"\"------- "), "\\s+", " "))


def normalised(text: Column) -> Column:
    """Unicode NFKC, which no built-in function gives, then `folded`. Only texts beyond ASCII, which alone can change, go through Python."""

    @F.pandas_udf("string")
    def compatible(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    beyond = text.rlike("[^\\x00-\\x7F]")
    return folded(F.when(beyond, compatible(F.when(beyond, text))).otherwise(text))


def numbered_attachments(text: Column) -> Column:
    """Bare attachment points numbered from the left; texts with any mapped one stay as they are."""
    parts = F.split(text, "\\[\\*\\]|\\*")
    joined = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("[*:"), i.cast("string"), F.lit("]"), p))), "")
    return F.when(F.contains(text, F.lit("[*:")), text).otherwise(joined)


# Names that no rule gives.
IRREGULAR = {"coo2": "carboxylic acid"}


def singular(word: Column) -> Column:
    """A lower-case word without its plural ending."""
    cut = lambda n: F.substr(word, F.lit(1), F.length(word) - n)
    out = (
        F.when(word.endswith("ies"), F.concat(cut(3), F.lit("y"))).when(word.rlike("(ses|xes|zes|ches|shes)$"), cut(2))
        .when(word.endswith("s") & ~word.endswith("ss"), cut(1)).otherwise(word)
    )
    for plural, one in IRREGULAR.items():
        out = F.when(word == plural, F.lit(one)).otherwise(out)
    return out


def label(description: Column) -> Column:
    """The name in a description: no `number of`, no `group`, the last word in the singular."""
    core = F.trim(F.regexp_replace(F.lower(F.trim(description)), "^number of ", ""))
    core = F.rtrim(F.regexp_replace(core, " groups?$", ""))
    words = F.split(core, " +")
    head = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    named = F.array_join(F.concat(head, F.array(singular(F.element_at(words, -1)))), " ")
    for mark, name in IRREGULAR.items():
        named = F.when(F.contains(F.lower(description), F.lit(mark)), F.lit(name)).otherwise(named)
    return named


# Endings of a text, in any case, after which a point does not end a sentence.
ABBREVIATIONS = ("i\\.e", "e\\.g", "etc", "vs", "approx", "cf", "Fig", "No", "Dr", "Mr", "Ms", "St")


def sentences(text: Column) -> Column:
    """Sentences of a text; a common abbreviation does not end one."""
    held = F.regexp_replace(F.trim(text), f"(?i)({'|'.join(ABBREVIATIONS)})\\.[ \\t\\r\\n]+", "$1.\u0001")
    cut = F.regexp_replace(held, "([.!?])[ \\t\\r\\n]+", "$1\u0002")
    parts = F.transform(F.split(cut, "\u0002"), lambda s: F.replace(s, F.lit("\u0001"), F.lit(" ")))
    return F.filter(parts, lambda s: F.trim(s) != "")


def atom_at(text: Column, index: Column) -> Column:
    """The symbol that carries a map number in a mapped structure, empty if none does."""
    pattern = F.concat(F.lit("\\[([A-Za-z]+)[^\\[\\]:]*:"), index.cast("string"), F.lit("\\]"))
    return F.call_function("regexp_extract", text, pattern, F.lit(1))


def stripped(text: Column) -> Column:
    """Without control tags and without trailing lines that hold one unbroken word of structure characters; blanks as one."""
    plain = F.regexp_replace(text, "</?ANSWER>", "")
    lines = F.regexp_replace(plain, "(\\n[ \\t]*[A-Za-z0-9@+\\[\\]()=#\\\\/%.\\-]{5,}[ \\t]*)+[ \\t\\r\\n]*$", "")
    return F.trim(F.regexp_replace(lines, "[ \\t]{2,}", " "))


def without_meta(text: Column, phrase: str) -> Column:
    """What stands before the first meta phrase, up to the last end of a sentence; empty if none ends before it."""
    at = F.regexp_instr(text, F.lit(phrase))
    head = F.substr(text, F.lit(1), at - 1)
    return F.when(at == 0, text).otherwise(F.trim(F.regexp_extract(head, "^((?s:.*)[.!?])(?: |$)", 1)))


def committed(text: Column) -> Column:
    """The edit that a span takes, from 0: the last one stated."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit("(?:Taking|I take) Edit ([0-9]+)"), F.lit(1)), F.lit(-1)).cast("int") - 1


def dropped(text: Column, most: int = 2) -> Column:
    """The edits that a span sets aside, in order, from 0: the subject of a passive sentence, else the first one after the verb."""
    rest = F.filter(sentences(text), lambda s: ~s.rlike("^(Taking|I take) Edit [0-9]+"))
    one = lambda s: F.coalesce(
        F.nullif(F.regexp_extract(s, "Edit ([0-9]+) (?:is|was) (?:set aside|discarded|dropped)", 1), F.lit("")),
        F.nullif(F.regexp_extract(s, "(?:set aside|discard|drop) Edit ([0-9]+)", 1), F.lit("")),
    )
    found = F.array_compact(F.transform(rest, one))
    return F.slice(F.transform(F.array_distinct(found), lambda n: n.cast("int") - 1), 1, most)


def expanded(spec: Column) -> Column:
    """Whole numbers of a list like `1-3,7`."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")
    each = F.transform(parts, lambda p: F.sequence(F.split_part(p, F.lit("-"), F.lit(1)).cast("int"), F.element_at(F.split(p, "-"), -1).cast("int")))
    return F.flatten(each)


def verification(rows: Column) -> Column:
    """A block of lines, one for each (name, value, lo, hi, ok), and the number that hold."""
    line = lambda r: F.format_string("- %s: %s in [%s, %s] %s", r["name"], number(r["value"]), number(r["lo"]), number(r["hi"]), F.when(r["ok"], "ok").otherwise("off"))
    held = F.size(F.filter(rows, lambda r: r["ok"]))
    last = F.concat(held.cast("string"), F.lit("/"), F.size(rows).cast("string"), F.lit(" satisfied."))
    return F.concat_ws("\n", F.lit("Verification:"), F.transform(rows, line), last)


# The names of small numbers.
NUMBERS = ("no", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")


def counted(n: Column, noun: str) -> Column:
    """`two rings`: the number as a word up to ten, the noun in the plural unless it is one."""
    word = F.coalesce(F.try_element_at(F.array(*map(F.lit, NUMBERS)), n + 1), n.cast("string"))
    return F.concat(word, F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s"))


def unnegated(text: Column, pattern: str) -> Column:
    """How many clauses hold the pattern without a word of negation in the 42 characters before it."""
    clauses = F.split(text, "[,;.!?]")
    before = lambda c: F.substr(c, F.greatest(F.regexp_instr(c, F.lit(pattern)) - 42, F.lit(1)), F.least(F.regexp_instr(c, F.lit(pattern)) - 1, F.lit(42)))
    return F.size(F.filter(clauses, lambda c: c.rlike(pattern) & ~before(c).rlike("(?:^|[^a-z])(?:no|not|without|never)(?:[^a-z]|$)")))
