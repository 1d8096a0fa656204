"""DuckDB expressions that say independently what the text operators compute, for the oracle queries."""

from __future__ import annotations

from lipiflow import lexicon as L


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def squeeze(x: str) -> str:
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def clean(x: str) -> str:
    kept = f"regexp_replace(coalesce({x}, ''), '{L.UNWANTED}', ' ', 'g')"
    return f"regexp_replace({squeeze(kept)}, '{L.LONE_PUNCTUATION}', ' ', 'g')"


def words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def replaced(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def romanise(x: str) -> str:
    x = replaced(x, L.NUKTA.items())
    x = rf"regexp_replace(regexp_replace({x}, '([क-ह])', '\1a', 'g'), 'a([ा-ौ्])', '\1', 'g')"
    return f"translate({replaced(x, L.LETTER_GROUPS.items())}, '{L.LETTERS_FROM}', '{L.LETTERS_TO}')"


def tidied(x: str) -> str:
    """Before capitals."""
    x = squeeze(x)
    for n in L.NAMES_WITHOUT_A:
        x = rf"regexp_replace({x}, '\b({n})a\b', '\1', 'gi')"
    for d in L.TRAILING_DOUBLES:
        x = rf"regexp_replace({x}, '{d}\b', '{d[0]}', 'gi')"
    return replaced(x, [(m, "") for m in L.MARKS])


def named(x: str) -> str:
    """Capitals if a column looks like a name."""
    w = words(x)
    fits = rf"len({w}) BETWEEN 1 AND 4 AND len(list_filter({w}, lambda v: NOT (length(v) BETWEEN 2 AND 20))) = 0 AND NOT regexp_matches({x}, '\d')"
    return f"CASE WHEN {fits} THEN array_to_string(list_transform({w}, lambda v: upper(v[1:1]) || lower(v[2:])), ' ') ELSE {x} END"


def within(w: str, values) -> str:
    return f"list_contains([{', '.join(repr(v) for v in values)}], {w})"


def valid_name(x: str) -> str:
    w = words(x)
    none = lambda cond: f"len(list_filter({w}, lambda v: {cond})) = 0"
    return f"(length({strip(x)}) >= 2 AND len({w}) BETWEEN 1 AND 4 AND NOT {none('NOT ' + within('v', L.STOP_WORDS))} AND {none(within('v', L.NOT_IN_NAMES))} AND NOT {none('length(v) <> 1')})"


def confidence(x: str, base: float) -> str:
    w = words(x)
    mean = f"(list_sum(list_transform({w}, lambda v: length(v))) / len({w}))"
    hit = " OR ".join(f"contains({x}, '{i}')" for i in L.NAME_INDICATORS)
    return (
        f"least(1.0::DOUBLE, greatest(0.1::DOUBLE, {base}::DOUBLE + CASE WHEN len({w}) BETWEEN 2 AND 3 THEN 0.15::DOUBLE WHEN len({w}) = 1 THEN 0.05::DOUBLE ELSE 0 END"
        f" + CASE WHEN {hit} THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN {mean} BETWEEN 3 AND 8 THEN 0.1::DOUBLE WHEN {mean} < 2 THEN -0.2::DOUBLE ELSE 0 END))"
    )


def matches(keys: str, source: str, x: str, pattern: str, group: int = 0) -> str:
    """A query: keys, i, whole, part, s, e of every match of a column."""
    return f"""
      SELECT {keys}, i, whole[i] AS whole, part[i] AS part,
             (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0))::INT AS s,
             (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(whole[1:i], lambda g: length(g))))::INT AS e
      FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i
            FROM (SELECT {keys}, regexp_extract_all({x}, '{pattern}') AS whole, regexp_extract_all({x}, '{pattern}', {group}) AS part, string_split_regex({x}, '{pattern}') AS gaps FROM {source}))"""
