"""Skill phrases in text, and columns derived from skill lists.

A dictionary here is a nested dict ``{category: {skill: [spellings]}}``; it is
query text (fixed size, known to the driver). For a dictionary that is itself a
table see :mod:`vacanta.operators.dictionary`.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacanta.fixed_values import OTHER_CATEGORY, SKILL_DICTIONARY
from vacanta.functions.text import bind

Dictionary = dict[str, dict[str, list[str]]]

# A word (with . & + _ inside it, + also at its end) or one sign.
TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}_+]*+(?:[._&+][\p{L}\p{N}_]++)*+|\S"
# The same for the spellings of a dictionary constant, in Python's notation.
_SPELLING_TOKEN = re.compile(r"[^\W_][\w+]*(?:[._&+]\w+)*|\S")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def phrase_form(words: Column) -> Column:
    """Tokens between single spaces, with a space at both ends.

    A phrase occurs as whole tokens exactly when its phrase form is a substring, and
    because the text is not consumed, overlapping phrases are all found.
    """
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _constant_list(texts: list[str]) -> Column:
    # One string literal that the optimizer folds into an array literal.
    return F.split(F.lit("\x01".join(texts)), "\x01")


def _spellings_by_start(dictionary: Dictionary) -> dict[str, list[tuple[str, str]]]:
    """First token -> (skill, phrase form) of its spellings, '' if it is the only token."""
    by_start: dict[str, list[tuple[str, str]]] = {}
    for skills in dictionary.values():
        for skill, spellings in skills.items():
            for spelling in spellings:
                words = _SPELLING_TOKEN.findall(spelling.lower())
                if words:
                    phrase = f" {' '.join(words)} " if len(words) > 1 else ""
                    by_start.setdefault(words[0], []).append((skill, phrase))
    return by_start


def skills_in(text: Column, dictionary: Dictionary = SKILL_DICTIONARY) -> Column:
    """Sorted distinct skills whose spellings occur in ``text``; no shuffle.

    One pass over the tokens keeps those that begin a spelling (a hash lookup each).
    Only the spellings under a kept token are then searched for in the text.
    ``text`` is evaluated once.
    """
    by_start = _spellings_by_start(dictionary)
    if not by_start:
        return F.array().cast("array<string>")
    # One map literal: first token -> its spellings, each as skill and phrase.
    table = "\x01".join(
        f"{start}\x02" + "\x03".join(f"{skill}\x04{phrase}" for skill, phrase in entries)
        for start, entries in by_start.items()
    )
    entries_of = F.str_to_map(F.lit(table), F.lit("\x01"), F.lit("\x02"))
    starts = sorted(by_start)

    def found(seen: Column) -> Column:
        def under(start: Column) -> Column:
            entries = F.split(F.try_element_at(entries_of, start), "\x03")
            hits = F.filter(
                entries, lambda e: F.contains(seen["form"], F.substring_index(e, "\x04", -1))
            )
            return F.transform(hits, lambda e: F.substring_index(e, "\x04", 1))

        return F.sort_array(F.array_distinct(F.flatten(F.transform(seen["starts"], under))))

    def scanned(words: Column) -> Column:
        def looked_up(kept: Column) -> Column:
            looked_at = F.struct(phrase_form(words).alias("form"), kept.alias("starts"))
            return F.when(F.size(kept) > 0, bind(looked_at, found)).otherwise(
                F.array().cast("array<string>")
            )

        return bind(F.array_distinct(F.filter(words, lambda word: word.isin(starts))), looked_up)

    return bind(F.coalesce(tokens(text), F.array()), scanned)


def known_skills(dictionary: Dictionary = SKILL_DICTIONARY) -> list[str]:
    return [skill for skills in dictionary.values() for skill in skills]


def category_of(skill: Column, dictionary: Dictionary = SKILL_DICTIONARY) -> Column:
    """The category that owns ``skill``, or 'Other'."""
    return reduce(
        lambda case, item: case.when(skill.isin(list(item[1])), F.lit(item[0])),
        ((category, skills) for category, skills in dictionary.items() if skills),
        F.when(F.lit(False), F.lit(None).cast("string")),
    ).otherwise(F.lit(OTHER_CATEGORY))


def count_column(category: str) -> str:
    """Name of the column counting a category's skills."""
    return "n_" + category.replace(" ", "_").replace("&", "and")


def count_columns(dictionary: Dictionary = SKILL_DICTIONARY) -> list[str]:
    return [count_column(category) for category in dictionary]


def skill_list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def members(skills: Column, names: list[str]) -> Column:
    """The list entries that are among ``names``, in order, repeats included."""
    listed = _constant_list(names)
    return F.filter(skill_list(skills), lambda s: F.array_contains(listed, s))


def category_counts(
    skills: Column, dictionary: Dictionary = SKILL_DICTIONARY
) -> dict[str, Column]:
    """Per category the number of list entries it owns, repeats included.

    Skills outside the dictionary count in no category, only in ``n_skills_total``.
    """

    def owned_among(names: list[str]) -> Column:
        return F.size(F.filter(skill_list(skills), lambda s: s.isin(names)))

    counts = {count_column(category): owned_among(list(owned)) for category, owned in dictionary.items()}
    return {**counts, "n_skills_total": F.size(skill_list(skills))}


def recognised(skills: Column, dictionary: Dictionary = SKILL_DICTIONARY) -> Column:
    return members(skills, known_skills(dictionary))


def ignored(skills: Column, dictionary: Dictionary = SKILL_DICTIONARY) -> Column:
    listed = _constant_list(known_skills(dictionary))
    return F.filter(skill_list(skills), lambda s: ~F.array_contains(listed, s))
