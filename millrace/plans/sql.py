"""Shared pieces of the SQL counterparts."""

from __future__ import annotations

from millrace.functions.text import IRREGULAR, NUMERALS, ROMAN_JUNK, WORD, fold_table, space_class

WS = f"[{space_class('re2')}]"
# The instruction patterns of `operators.contexts` with this dialect's white space.
DIRECTIONS = rf"(?i)^{WS}*Direct[il1]ons?\b"
STRUCTURE = rf"(?i)^{WS}*(?:Part\b|Section\b|Passage\b|Questions?{WS}+\p{{Nd}}|\p{{Nd}}+{WS}*\.|[A-D]\))"
LINE_ENDS = rf"[.!?][\"”’)]*{WS}*$"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold_sql(text: str) -> str:
    """Full case folding: letters one for one, then those that become several."""
    one = {a: b for a, b in fold_table().items() if len(b) == 1}
    out = f"translate(lower({text}), {quoted(''.join(one))}, {quoted(''.join(one.values()))})"
    for a, b in fold_table().items():
        if len(b) > 1:
            out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    return out


def clean_sql(text: str = "text") -> str:
    """The cleaned text of a paper."""
    curly = f"translate({text}, '’‘“”–—', '''''\"\"--')"
    clean = f"regexp_replace({curly}, {quoted(f'(?is)part{WS}+iv.*$')}, '')"
    clean = f"regexp_replace({clean}, {quoted(f'(^|{WS})[A-D][).]')}, ' ', 'g')"
    bracketed = r"\[\p{Nd}+\]|\(\p{Nd}+(?:-\p{Nd}+)?\)"
    clean = f"regexp_replace({clean}, {quoted(bracketed)}, ' ', 'g')"
    numbered = rf"(?m)^{WS}*\p{{Nd}}+[.]{WS}*"
    return f"regexp_replace({clean}, {quoted(numbered)}, '', 'g')"


def tokens_cte(table: str, keep: str, text: str = "text", where: str = "TRUE", name: str = "tokens") -> str:
    """CTEs that end in `name`: the keep columns and `word`, one row per corpus word."""
    words = r"([\p{L}\p{Nd}][\p{L}\p{M}\p{Nd}'-]*)"
    repairs = "CASE w WHEN 'ca' THEN 'can' WHEN 'wo' THEN 'will' WHEN 'sha' THEN 'shall' WHEN 'n''t' THEN 'not' ELSE w END"
    junk = ", ".join(quoted(w) for w in [*ROMAN_JUNK, *NUMERALS])
    return f"""{name}_raw AS (
  SELECT {keep}, unnest(regexp_extract_all(lower({clean_sql(text)}), {quoted(words)}, 1)) AS w FROM {table} WHERE {where}
), {name}_cut AS (
  SELECT {keep}, unnest(CASE WHEN w LIKE '%n''t' THEN [regexp_replace(w, 'n''t$', ''), 'n''t']
    ELSE [regexp_replace(regexp_replace(w, '''(?:s|re|ve|ll|d|m)$', ''), '[''-]+$', '')] END) AS w FROM {name}_raw
), {name} AS (
  SELECT {keep}, word FROM (SELECT {keep}, {repairs} AS word FROM {name}_cut)
  WHERE regexp_matches(word, {quoted(WORD)}) AND word NOT IN ({junk})
)"""


def lemma_sql(word: str = "word") -> str:
    table = {form: base for base, forms in IRREGULAR.items() for form in forms.split()}
    known = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items())
    double = "(?:bb|dd|gg|mm|nn|pp|rr|tt)"
    rules = [
        ("^.{2,}[^aeiou]ies$", "ies$", "y"), ("^.{2,}[^aeiou]ied$", "ied$", "y"),
        ("^.{2,}(?:ss|sh|ch|x|z)es$", "es$", ""), ("^.{2,}[^su]s$", "s$", ""),
        (f"^.+{double}ing$", ".ing$", ""), (f"^.+{double}ed$", ".ed$", ""),
    ]
    cases = " ".join(f"WHEN regexp_matches({word}, {quoted(a)}) THEN regexp_replace({word}, {quoted(b)}, {quoted(c)})" for a, b, c in rules)
    return f"CASE {word} {known} ELSE CASE {cases} ELSE {word} END END"


def directions_cte(table: str, key: str, text: str = "text", where: str = "TRUE", name: str = "blocks") -> str:
    """CTEs that end in `name`: the key, `pos` and `line` of the lines of Directions blocks."""
    opens, closes = f"regexp_matches(line, {quoted(DIRECTIONS)})", f"(trim(line) = '' OR regexp_matches(line, {quoted(STRUCTURE)}))"
    return f"""{name}_lines AS (
  SELECT {key}, unnest(range(len(ls))) AS i, unnest(ls) AS line
  FROM (SELECT {key}, string_split_regex({text}, '\\r\\n|\\n|\\r') AS ls FROM {table} WHERE {where} AND {text} IS NOT NULL)
), {name}_marks AS (
  SELECT *, CASE WHEN {opens} THEN i END AS o, CASE WHEN NOT {opens} AND {closes} THEN i + 1
    WHEN lag(regexp_matches(line, {quoted(LINE_ENDS)})) OVER (PARTITION BY {key} ORDER BY i) THEN i END AS b FROM {name}_lines
), {name}_in AS (
  SELECT {key}, i, line, max(o) OVER w >= coalesce(max(b) OVER w, 0) AS inside FROM {name}_marks WINDOW w AS (PARTITION BY {key} ORDER BY i ROWS UNBOUNDED PRECEDING)
), {name} AS (
  SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY i) - 1 AS INTEGER) AS pos, line FROM {name}_in WHERE inside
)"""


def inflections_sql(word: str = "word") -> str:
    """List of the forms a base word may take."""
    last = f"right({word}, 1)"
    more = " ".join(f"WHEN {quoted(k)} THEN [{', '.join(map(quoted, v.split()))}]" for k, v in IRREGULAR.items())
    forms = f"""list_distinct([{word}, {word} || 's', {word} || 'es', {word} || 'd', {word} || 'ed', {word} || 'ing', {word} || {last} || 'ed', {word} || {last} || 'ing']
|| CASE WHEN {last} = 'e' THEN [left({word}, -1) || 'ing'] ELSE [] END
|| CASE WHEN {last} = 'y' THEN [left({word}, -1) || 'ies', left({word}, -1) || 'ied'] ELSE [] END || CASE {word} {more} ELSE [] END)"""
    return f"CASE WHEN regexp_matches({word}, '^[a-z]{{3,}}$') THEN {forms} ELSE [{word}] END"


def sentences_cte(table: str, keep: str, text: str = "text", where: str = "TRUE", name: str = "sentences") -> str:
    """CTEs that end in `name`: the keep columns, `pos` and `sentence`."""
    split = f"""string_split_regex(regexp_replace({text}, '([.!?])["”’)]*{WS}+(["“‘(]*[A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), '\\x01|\\n+')"""
    squash = f"trim(regexp_replace(piece, '{WS}+', ' ', 'g'))"
    noise = rf"^{WS}*(?:[A-D]\)|\p{{Nd}}+\.|\(\p{{Nd}}+\)){WS}*"
    return f"""{name}_split AS (
  SELECT {keep}, {split} AS pieces FROM {table} WHERE {where} AND {text} IS NOT NULL
), {name}_piece AS (
  SELECT {keep}, unnest(range(len(pieces))) AS i, unnest(pieces) AS piece FROM {name}_split
), {name}_clean AS (
  SELECT {keep}, i, regexp_replace({squash}, {quoted(noise)}, '') AS sentence FROM {name}_piece
), {name} AS (
  SELECT {keep}, CAST(row_number() OVER (PARTITION BY {keep} ORDER BY i) - 1 AS INTEGER) AS pos, sentence
  FROM {name}_clean WHERE sentence <> '' AND len(string_split(sentence, ' ')) BETWEEN 3 AND 60
)"""
