"""Building blocks of the checking SQL (DuckDB), written without Spark's functions."""

from __future__ import annotations

from checks.postings import AGAIN_VIEW, FRESH_VIEW, RAW_VIEW, quoted
from vacanta.fixed_values import (
    CATEGORICAL_FEATURES,
    ROLE_PATTERNS,
    SENIORITY_PATTERNS,
    SKILL_DICTIONARY,
)
from vacanta.functions.skills import count_column

SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
IN_LINE = SPACE.replace(r"\t-\r", r"\t\x0b-\r")
TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}_+]*(?:[._&+][\p{L}\p{N}_]+)*|[^\s]"

# The references that occur in the supplied tables and the titles and descriptions.
REFERENCES = {
    "&nbsp;": " ",
    "&quot;": '"',
    "&lt;": "<",
    "&gt;": ">",
    "&pound;": "£",
    "&middot;": "·",
    "&copy;": "©",
    "&#45;": "-",
    "&amp;": "&",
}


def swap(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(by)}, 'g')"


def unescape(text: str) -> str:
    for reference, meaning in REFERENCES.items():
        text = f"replace({text}, {quoted(reference)}, {quoted(meaning)})"
    return text


def strip_html(text: str) -> str:
    for name in ("script", "style"):
        text = swap(text, rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", " ")
    text = swap(text, r"(?s)<!--.*?-->", " ")
    text = swap(text, r"<[!?][^>]*>", " ")
    text = swap(text, r"""</?[A-Za-z][^'">]*(?:(?:"[^"]*"|'[^']*')[^'">]*)*>""", " ")
    return f"trim({swap(unescape(text), f'[{SPACE}]+', ' ')})"


def tidy(text: str) -> str:
    text = swap(text, f"[{IN_LINE}]+", " ")
    text = swap(text, r"\n{3,}", "\n\n")
    return swap(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def clean_description(text: str) -> str:
    text = strip_html(unescape(f"coalesce({text}, '')"))
    text = swap(text, rf"https?://[^{SPACE}]+", " ")
    return tidy(swap(text, "[•◦‣▪●·*]|-\t", "\n- "))


def clean_title(text: str) -> str:
    text = strip_html(unescape(f"coalesce({text}, '')"))
    return tidy(swap(text, rf"[{SPACE}]*[\(\[].*?[\)\]][{SPACE}]*", " "))


def rules(text: str, ordered, default: str, blank: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({text}, {quoted('(?i)' + '|'.join(patterns))}) THEN {quoted(label)}"
        for label, patterns in ordered
    )
    return (
        f"CASE WHEN {text} IS NULL OR trim({text}) = '' THEN {quoted(blank)} {whens} "
        f"ELSE {quoted(default)} END"
    )


def number(text: str) -> str:
    return f"TRY_CAST({text} AS DOUBLE)"


def form(text: str) -> str:
    return f"concat(' ', array_to_string(regexp_extract_all(lower({text}), {quoted(TOKEN)}), ' '), ' ')"


DICTIONARY = ", ".join(
    f"({quoted(category)}, {quoted(skill)}, {quoted(alias)})"
    for category, skills in SKILL_DICTIONARY.items()
    for skill, aliases in skills.items()
    for alias in aliases
)
OWNERS = ", ".join(
    f"({quoted(category)}, {quoted(skill)})"
    for category, skills in SKILL_DICTIONARY.items()
    for skill in skills
)

RAW = f"raw AS ({RAW_VIEW})"
AGAIN = f"again AS ({AGAIN_VIEW})"
FRESH = f"fresh AS ({FRESH_VIEW})"

TITLED = f"""titled AS (
  SELECT *, {rules('title_clean', ROLE_PATTERNS, 'Other', 'Other')} AS role_category,
         {rules('title_clean', SENIORITY_PATTERNS, 'Mid-level', 'Unspecified')} AS seniority
  FROM (SELECT *, {clean_title('title')} AS title_clean FROM raw))"""

PAID = f"""paid AS (
  SELECT *, CASE WHEN salary_midpoint BETWEEN 15000 AND 250000 THEN salary_midpoint END AS pay
  FROM (SELECT * REPLACE (lo AS salary_min, hi AS salary_max), coalesce((lo + hi) / 2, lo, hi) AS salary_midpoint,
               TRY_CAST(created AS TIMESTAMP) AS created_at, TRY_CAST(collected_at AS TIMESTAMP) AS seen_at
        FROM (SELECT *, {number('salary_min')} AS lo, {number('salary_max')} AS hi FROM titled)))"""

# Matches are joined as pairs, one per posting and skill.
TAGGED = f"""cleaned AS (SELECT *, {clean_description('description')} AS description_clean FROM paid),
spelled AS (SELECT DISTINCT category, skill, {form('alias')} AS phrase
            FROM (VALUES {DICTIONARY}) AS d(category, skill, alias)),
formed AS (SELECT id, {form('description_clean')} AS f FROM cleaned),
hits AS (SELECT DISTINCT id, category, skill FROM formed JOIN spelled ON contains(f, phrase)),
listed AS (SELECT id, list(skill ORDER BY skill) AS skills FROM hits GROUP BY id),
posts AS (SELECT c.*, coalesce(l.skills, []) AS skills FROM cleaned c LEFT JOIN listed l ON c.id = l.id)"""

BASE = f"WITH {RAW}"
WITH_TITLES = f"{BASE}, {TITLED}"
WITH_PAY = f"{WITH_TITLES}, {PAID}"
WITH_SKILLS = f"{WITH_PAY}, {TAGGED}"


def half_even(value: str, digits: int = 0) -> str:
    return f"CAST(round_even({value}, {digits}) AS DOUBLE)"


def pounds(value: str) -> str:
    return f"CAST(round_even({value}, 0) AS BIGINT)"


def day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def box(source: str, label: str, value: str) -> str:
    """Box plots by quartiles first and whiskers over the values within the fences."""
    return f"""
q AS (SELECT {label} AS label, quantile_cont({value}, 0.25) AS q1, median({value}) AS median,
             quantile_cont({value}, 0.75) AS q3, count({value}) AS count
      FROM {source} WHERE {value} IS NOT NULL GROUP BY 1),
w AS (SELECT q.label, min(s.v) AS min, max(s.v) AS max
      FROM (SELECT {label} AS label, {value} AS v FROM {source} WHERE {value} IS NOT NULL) s
      JOIN q ON s.label = q.label
      WHERE s.v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1)
SELECT q.label, w.min AS "min", q1, q.median AS "median", q3, w.max AS "max", q.count AS "count"
FROM q JOIN w ON q.label = w.label"""


COUNTS = ", ".join(
    f"CAST(len(list_filter(skills, lambda s: s IN ({', '.join(quoted(s) for s in skills)}))) AS BIGINT) "
    f"AS {count_column(category)}"
    for category, skills in SKILL_DICTIONARY.items()
)
CATEGORICALS = ", ".join(f"coalesce({n}, 'Unknown') AS {n}" for n in CATEGORICAL_FEATURES)
