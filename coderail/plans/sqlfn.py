"""SQL snippets for the DuckDB oracles (independent formulations of the same semantics).

DuckDB's regex engine is RE2, whose ``\\s`` is ASCII; the class below is Python's whitespace set.
"""

from __future__ import annotations

DWS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{DWS}+|{DWS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{DWS}+', ' ', 'g')"


def normalise(x: str) -> str:
    v = f"lower({strip(x)})"
    return (f"CASE WHEN {v} IN ('ja', 'ja (1)', '(1)', '1') THEN '1' "
            f"WHEN {v} IN ('nein', 'nein (0)', '(0)', '0') THEN '0' ELSE {v} END")


def level(x: str) -> str:
    return f"CASE WHEN {x} < 0.33 THEN 'low' WHEN {x} < 0.67 THEN 'medium' ELSE 'high' END"


def fence(x: str) -> str:
    j = f"split_part(split_part({x}, '```json', 2), '```', 1)"
    p = f"split_part(split_part({x}, '```', 2), '```', 1)"
    return f"(CASE WHEN contains({x}, '```json') THEN {strip(j)} WHEN contains({x}, '```') THEN {strip(p)} ELSE {x} END)"


def guard(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'empty' WHEN starts_with({strip(x)}, '<') THEN 'html' "
            f"WHEN NOT json_valid({fence(x)}) THEN 'invalid_json' END")


FLOAT_TEXT = (r"^[+-]?(((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
              r"|(?i:inf|infinity|nan))$")


def validated(src: str, raw: str = "response") -> str:
    """SELECT over ``src`` adding outcome, ai_code, confidence, confidence_level, reasoning."""
    return f"""
SELECT * EXCLUDE (clean, js, kind, miss, conf_text, conf),
  CASE WHEN outcome IN ('invalid_json','missing_fields','not_object','nan_confidence') THEN '0'
       ELSE coalesce(json_extract_string(js, '$.value'), 'None') END AS ai_code,
  CASE WHEN outcome IN ('invalid_json','missing_fields','not_object','nan_confidence','bad_confidence') THEN 0.0
       ELSE greatest(0.0, least(1.0, conf)) END AS confidence,
  {level("CASE WHEN outcome IN ('invalid_json','missing_fields','not_object','nan_confidence','bad_confidence') THEN 0.0 ELSE greatest(0.0, least(1.0, conf)) END")} AS confidence_level,
  CASE WHEN outcome = 'invalid_json' THEN 'Error parsing JSON response'
       WHEN kind IN ('ARRAY', 'VARCHAR') THEN 'Missing required fields in response: [''value'', ''confidence'', ''reasoning'']'
       WHEN outcome = 'missing_fields' THEN 'Missing required fields in response: [' || array_to_string(list_transform(miss, lambda f: '''' || f || ''''), ', ') || ']'
       WHEN outcome IN ('not_object', 'nan_confidence') THEN 'Error validating response'
       ELSE coalesce(json_extract_string(js, '$.reasoning'), 'None') END AS reasoning
FROM (
  SELECT *,
    CASE WHEN kind IS NULL THEN 'invalid_json' WHEN kind IN ('ARRAY', 'VARCHAR') THEN 'missing_fields'
         WHEN kind <> 'OBJECT' THEN 'not_object' WHEN len(miss) > 0 THEN 'missing_fields'
         WHEN conf IS NULL THEN 'bad_confidence' WHEN isnan(conf) THEN 'nan_confidence'
         WHEN conf < 0 OR conf > 1 THEN 'clamped' ELSE 'ok' END AS outcome
  FROM (
    SELECT *, list_filter(['value', 'confidence', 'reasoning'], lambda f: NOT list_contains(json_keys(js), f)) AS miss,
      json_extract_string(js, '$.confidence') AS conf_text,
      CASE WHEN json_type(js, '$.confidence') = 'BOOLEAN' THEN CASE WHEN json_extract_string(js, '$.confidence') = 'true' THEN 1.0 ELSE 0.0 END
           WHEN regexp_matches({strip("json_extract_string(js, '$.confidence')")}, '{FLOAT_TEXT}')
           THEN TRY_CAST(replace({strip("json_extract_string(js, '$.confidence')")}, '_', '') AS DOUBLE) END AS conf
    FROM (SELECT *, json_type(js) AS kind FROM (
      SELECT *, CASE WHEN json_valid(clean) THEN clean END AS js FROM (SELECT *, {fence(raw)} AS clean FROM {src})))))
"""


# ---------------------------------------------------------------- scheme rules (oracle side)
def strip_chars(x: str, chars_class: str) -> str:
    cls = chars_class.replace("'", "''")
    return f"regexp_replace({x}, '^[{cls}]+|[{cls}]+$', '', 'g')"


def first_token(x: str) -> str:
    return f"(CASE WHEN {strip(x)} = '' THEN NULL ELSE string_split_regex({strip(x)}, '{DWS}+')[1] END)"


def sort_key(x: str) -> dict[str, str]:
    tok = first_token(x)
    nums = (f"list_filter(list_transform(string_split({tok}, '.'), lambda s: regexp_replace(s, '[^0-9]', '', 'g')),"
            f" lambda d: d <> '')")
    letters = (f"list_filter(list_transform(string_split({tok}, '.'), lambda s: regexp_replace(s, '[^\\pL]', '', 'g')),"
               f" lambda d: d <> '')")
    out = {f"n{i}": f"CAST(CASE WHEN {tok} IS NULL THEN 999 ELSE coalesce(TRY_CAST({nums}[{i}] AS BIGINT), 0) END AS BIGINT)"
           for i in (1, 2, 3)}
    out["suffix"] = f"CASE WHEN {tok} IS NULL THEN '' ELSE coalesce({letters}[-1], '') END"
    return out


def generate_key(x: str) -> str:
    name = f"regexp_replace({x}, '^\\d+(\\.\\d+)*[a-z]?{DWS}+', '')"
    return strip_chars(f"regexp_replace({name}, '[^a-zA-Z0-9]+', '_', 'g')", "_")


def simplify_name(x: str) -> str:
    out = x
    for p in (r"^\d+\.\d+\.?\d*\s*[a-z]?\s*", r"^\.\d+\s*", r"^\d+\s+"):
        out = f"regexp_replace({out}, '{p.replace(chr(92) + 's', DWS)}', '')"
    return strip(out)


_DWS_INNER = DWS[1:-1]


def clean_name(x: str) -> str:
    a = f"regexp_replace({x}, '^\\d+\\.\\d+(\\.\\d+)?[a-z]?{DWS}*', '')"
    b = f"regexp_replace({a}, '[^a-zA-ZäöüÄÖÜß{_DWS_INNER}]', '', 'g')"
    return collapse(b)


def clean_criteria(x: str) -> str:
    return strip(f"replace(regexp_replace({x}, '^Kriterium:{DWS}*', ''), '\"', '''')")


def import_criteria(x: str) -> str:
    return f"CASE WHEN {strip(x)} = '' THEN '\"\"' ELSE {collapse(x)} END"


def example_lines(x: str) -> str:
    return (f"list_filter(list_transform(string_split({strip(x)}, chr(10)), lambda l: {strip('l')}), "
            f"lambda l: l <> '')")


def clean_examples(arr: str) -> str:
    inner = strip(f"regexp_replace(x, '^[·•]{DWS}*', '')")
    one = strip(f"replace({inner}, chr(34), chr(39))")
    return f"list_transform({arr}, lambda x: {one})"


def _parts(s: str, sep: str, distinct: bool) -> str:
    arr = f"list_filter(list_transform(string_split({s}, {sep}), lambda p: {strip('p')}), lambda p: p <> '')"
    if distinct:
        arr = f"list_filter({arr}, lambda x, i: list_position({arr}, x) = i)"
    return arr


def values_prestep(x: str) -> str:
    return strip_chars(f"replace(replace({x}, ';;', ';'), '; ;', ';')", ";")


def standardise_values(x: str) -> str:
    s = strip(x)
    lo = f"lower({s})"
    return (f"CASE WHEN contains({lo}, 'wenn') THEN {s} "
            f"WHEN contains({lo}, 'ja') AND contains({lo}, 'nein') THEN 'Ja (1), Nein (0)' "
            f"WHEN contains({lo}, 'offen') THEN 'offen' "
            f"WHEN contains({s}, chr(10)) THEN array_to_string({_parts(s, 'chr(10)', False)}, '; ') "
            f"WHEN contains({s}, ';') THEN array_to_string({_parts(s, chr(39) + ';' + chr(39), True)}, '; ') "
            f"WHEN contains({s}, ',') THEN array_to_string({_parts(s, chr(39) + ',' + chr(39), True)}, ', ') "
            f"ELSE {s} END")


def clean_values(x: str, variant: str = "fix") -> str:
    s = strip_chars(strip(f"coalesce({x}, '')"), "\"'")
    if variant == "current":
        s = f"regexp_replace({s}, '[,;]+$', '')"
        lo = f"lower({s})"
        joined = f"array_to_string({_parts(f'replace({s}, {chr(39)};{chr(39)}, {chr(39)},{chr(39)})', chr(39) + ',' + chr(39), False)}, ', ')"
        return (f"CASE WHEN {lo} = 'offen' THEN 'offen' WHEN {lo} = 'ja (1)' THEN 'Ja (1)' "
                f"WHEN contains({lo}, 'wenn') THEN {s} WHEN contains({lo}, 'ja') AND contains({lo}, 'nein') "
                f"THEN 'Ja (1), Nein (0)' WHEN contains({s}, ';') OR contains({s}, ',') THEN {joined} ELSE {s} END")
    lo = f"lower({s})"
    t = f"replace(replace({s}, ';;', ';'), '; ;', ';')"
    joined = f"array_to_string({_parts(f'replace({t}, {chr(39)};{chr(39)}, {chr(39)},{chr(39)})', chr(39) + ',' + chr(39), False)}, ', ')"
    return (f"CASE WHEN contains({lo}, 'wenn') THEN {s} WHEN {lo} = 'offen' THEN 'offen' "
            f"WHEN contains({t}, ';') OR contains({t}, ',') THEN {joined} ELSE {t} END")


def condition(x: str) -> dict[str, str]:
    v = f"lower({x})"
    cond = strip(f"split_part({v}, 'wenn', 2)")
    excluded = f"(contains({v}, 'nur, wenn auch 2.0.4 =1') OR (contains({v}, 'nur, wenn auch') AND contains({v}, '2.0.4')))"
    rp = strip(f"split_part(split_part({cond}, 'kategorien', 2), '=', 1)")
    n_eq = f"(length({cond}) - length(replace({cond}, '=', '')))"
    ctype = (f"(CASE WHEN {excluded} OR NOT contains({v}, 'wenn') THEN NULL "
             f"WHEN contains({cond}, 'min. eine der kategorien') THEN "
             f"CASE WHEN len(string_split({rp}, '-')) = 2 AND {n_eq} >= 1 THEN 'any_in_range' END "
             f"WHEN {n_eq} = 1 THEN 'equals' END)")
    problem = (f"CASE WHEN contains({v}, 'wenn') AND NOT {excluded} AND NOT contains({cond}, 'min. eine der kategorien')"
               f" AND {n_eq} > 1 THEN 'condition_unpacking' END")
    return {
        "cond_type": ctype,
        "reference": f"CASE WHEN {ctype} = 'equals' THEN {strip(f'split_part({cond}, {chr(39)}={chr(39)}, 1)')} END",
        "range_start": f"CASE WHEN {ctype} = 'any_in_range' THEN {strip(f'string_split({rp}, {chr(39)}-{chr(39)})[1]')} END",
        "range_end": f"CASE WHEN {ctype} = 'any_in_range' THEN {strip(f'string_split({rp}, {chr(39)}-{chr(39)})[2]')} END",
        "cond_value": f"CASE WHEN {ctype} IS NOT NULL THEN {strip(f'split_part({cond}, {chr(39)}={chr(39)}, 2)')} END",
        "condition_problem": problem,
    }


BARE = r"(?i)^\d+(?:\.\d+)*(?:\s*[a-z])?\s+(.+)$"


def bare_name(x: str) -> str:
    pat = BARE.replace(r"\s", DWS)
    return f"CASE WHEN regexp_matches({x}, '{pat}') THEN regexp_extract({x}, '{pat}', 1) ELSE {x} END"


def values_format(x: str) -> str:
    """The formats by their parts, not by the engine's patterns."""
    v = strip_chars(x, "\"'")
    parts, lines = f"string_split({v}, ', ')", f"string_split({v}, '; ')"
    numbered = "regexp_full_match(p, '[^,]+ [(][0-9]+[)]')"

    def every(items: str, test: str) -> str:
        return f"len(list_filter({items}, lambda p: NOT ({test}))) = 0"
    head = f"left({v}, greatest(len({v}) - 5, 0))"
    return (f"CASE WHEN starts_with({v}, 'wenn') THEN 'conditional' WHEN {v} = 'Ja (1), Nein (0)' THEN 'binary' "
            f"WHEN {v} = 'offen' THEN 'open' WHEN len({parts}) > 1 AND {every(parts, numbered)} THEN 'numbered_choice' "
            f"WHEN len({parts}) = 3 AND {parts}[3] = '-99' AND {every(f'{parts}[1:2]', numbered)} THEN 'numbered_choice_missing' "
            f"WHEN len({lines}) = 3 AND {lines}[3] = '-99' AND regexp_full_match({lines}[1], 'SoSe[0-9]{{2}}') "
            f"AND regexp_full_match({lines}[2], 'WiSe[0-9]{{2}}/[0-9]{{2}}') THEN 'semester' "
            f"WHEN len({lines}) > 2 AND {lines}[-1] = '-99' AND {every(f'{lines}[1:-2]', 'len(p) = 1 AND p BETWEEN chr(65) AND chr(90)')} THEN 'letter_list' "
            f"WHEN ends_with({v}, '; -99') AND NOT contains({v}, ',') AND regexp_full_match({head}, '(?s).+; .+') THEN 'text_list' "
            f"WHEN {v} <> '' AND {every(parts, 'p <> chr(0) AND len(p) > 0 AND NOT contains(p, chr(44))')} THEN 'comma_list' ELSE 'invalid' END")
