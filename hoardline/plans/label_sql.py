"""The label rules written as DuckDB SQL, to check the column pipeline against."""

from __future__ import annotations

from hoardline.functions import vocabulary as V

TEXT = "lower(coalesce(title, 'None') || ' ' || coalesce(description, 'None'))"


def words(column: str, vocabulary: list[str]) -> str:
    alternatives = "|".join(vocabulary)
    return rf"regexp_matches({column}, '(^|[^\pL\pN_])(?:{alternatives})($|[^\pL\pN_])')"


def parts(column: str, vocabulary: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in vocabulary) + ")"


def longest(column: str, table: dict[str, str]) -> str:
    keys = sorted(table, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN {words(column, [k])} THEN '{table[k]}'" for k in keys) + " END"


def first_pattern(column: str, patterns: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{p}'" for p in patterns) + " END"


def _signals() -> str:
    return ", ".join(f"{words('txt', w)} AS s_{p}" for p, w in V.PERIOD_WORDS.items())


def _signal_list() -> str:
    items = ", ".join(f"CASE WHEN s_{p} THEN '{p}' END" for p in V.PERIOD_WORDS)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def signals_sql(source: str, key: str) -> str:
    return f"""
WITH t AS (SELECT {key}, {TEXT} AS txt FROM {source}),
 s AS (SELECT *, {words('txt', V.NON_COIN_WORDS)} AS junk, {_signals()} FROM t)
SELECT {key}, CAST(junk AS INT) AS junk, array_to_string({_signal_list()}, ',') AS signals FROM s"""


def labels_sql(source: str, key: str) -> str:
    inferred = " ".join(
        f"WHEN denom IN ({', '.join(repr(n) for n in names)}) THEN '{p}'"
        for p, (_, names) in V.DENOMINATION_INFERENCE.items()
    )
    scores = " ".join(f"WHEN inferred = '{p}' THEN {s}" for p, (s, _) in V.DENOMINATION_INFERENCE.items())
    infer_notes = ", ".join(
        f"CASE WHEN how = 'I' AND inferred = '{p}' THEN '{n}' END" for p, n in V.NOTE_INFERRED.items()
    )
    allowed = "CASE denom " + " ".join(
        f"WHEN '{d}' THEN {ps!r}" for d, ps in V.DENOMINATION_PERIODS.items()
    ) + " END"
    return f"""
WITH t AS (SELECT {key}, {TEXT} AS txt FROM {source}),
 s AS (SELECT *, {words('txt', V.NON_COIN_WORDS)} AS junk, {_signals()},
   {longest('txt', V.DENOMINATIONS)} AS denom, {longest('txt', V.MATERIALS)} AS mat,
   {parts('txt', V.PROVINCIAL_REGIONS)} AS region, {words('txt', V.CELTIC_TRIBES)} AS tribe,
   {parts('txt', V.GREEK_CITIES)} AS city, {parts('txt', V.EXOTIC_SIGNALS)} AS exotic FROM t),
 g AS (SELECT *, {_signal_list()} AS sig, s_roman_imperial OR s_roman_republican OR s_greek OR s_byzantine AS ancient,
   NOT s_persian AND (region OR s_roman_provincial) AND (s_roman_imperial OR s_greek) AS prov,
   CASE {inferred} END AS inferred FROM s),
 p AS (SELECT *, CASE WHEN s_modern AND NOT ancient THEN 'G' WHEN s_persian THEN 'E' WHEN prov THEN 'F' WHEN tribe THEN 'B2'
   WHEN len(sig) > 0 THEN 'H' WHEN city THEN 'H2' WHEN exotic THEN 'Z' WHEN inferred IS NOT NULL THEN 'I' END AS how FROM g),
 c AS (SELECT *, CASE how WHEN 'G' THEN 'modern' WHEN 'E' THEN 'persian' WHEN 'F' THEN 'roman_provincial' WHEN 'B2' THEN 'celtic'
   WHEN 'H' THEN CASE WHEN len(sig) = 1 THEN sig[1] WHEN s_byzantine THEN 'byzantine' WHEN s_roman_republican THEN 'roman_republican'
     WHEN s_roman_imperial THEN 'roman_imperial' WHEN s_greek THEN 'greek' ELSE sig[1] END
   WHEN 'H2' THEN 'greek' WHEN 'Z' THEN 'central_asian' WHEN 'I' THEN inferred END AS pick,
   CASE WHEN how IN ('G', 'E', 'F') THEN 0.95 WHEN how IN ('B2', 'H2') THEN 0.9 WHEN how = 'Z' THEN 0.6
     WHEN how = 'I' THEN CASE {scores} END ELSE 0.0 END AS score0, {allowed} AS allowed FROM p),
 d AS (SELECT *, pick IS NOT NULL AND allowed IS NOT NULL AND NOT list_contains(allowed, pick) AS clash FROM c),
 e AS (SELECT *, clash AND len(allowed) = 1 AS fixed FROM d),
 f AS (SELECT *, CASE WHEN fixed THEN allowed[1] ELSE pick END AS fin,
   CASE WHEN fixed AND score0 < 0.92 THEN 0.92 ELSE score0 END AS score1 FROM e),
 n AS (SELECT *, CASE WHEN junk THEN ['{V.NOTE_NON_COIN}'] ELSE list_filter([
     CASE WHEN s_persian THEN '{V.NOTE_PERSIAN}' END, CASE WHEN prov THEN '{V.NOTE_PROVINCIAL}' END,
     CASE WHEN s_modern AND NOT ancient THEN '{V.NOTE_MODERN}' END, CASE WHEN how = 'B2' THEN '{V.NOTE_CELTIC}' END,
     CASE WHEN how = 'H2' THEN '{V.NOTE_CITY}' END, CASE WHEN how = 'Z' THEN '{V.NOTE_EXOTIC}' END, {infer_notes},
     CASE WHEN fixed THEN 'Auto-corrected to ' || fin || ' via denomination constraint' END], lambda x: x IS NOT NULL) END AS notes,
   CASE WHEN junk THEN [] ELSE list_filter([CASE WHEN s_modern AND ancient THEN '{V.WARN_MODERN}' END,
     CASE WHEN how = 'H' AND len(sig) > 1 THEN '{V.WARN_MULTIPLE}' END,
     CASE WHEN clash THEN 'Conflict: ''' || denom || ''' vs ''' || pick || '''' END,
     CASE WHEN fin IS NULL THEN '{V.WARN_NO_PERIOD}' END], lambda x: x IS NOT NULL) END AS warnings FROM f)
SELECT {key}, CASE WHEN junk THEN 'non_coin' ELSE fin END AS period, CASE WHEN NOT junk THEN denom END AS denomination,
 CASE WHEN NOT junk THEN mat END AS material,
 CAST(CASE WHEN junk THEN 0.99 WHEN score1 > 0 THEN score1 WHEN fin IS NOT NULL THEN 0.9 ELSE 0.3 END AS DOUBLE) AS label_confidence,
 CAST(NOT junk AND (fin IS NULL OR len(warnings) > 0 OR how IS NOT DISTINCT FROM 'Z') AS INT) AS needs_review,
 array_to_string(notes, '|') AS notes, array_to_string(warnings, '|') AS warnings FROM n"""


def keyword_sql(column: str) -> str:
    ordered = {"roman_provincial": ["provincial"], "roman_republican": ["republic"]}
    cases = [f"WHEN {parts(column, w)} THEN '{c}'" for c, w in ordered.items()]
    cases += [f"WHEN {parts(column, w)} THEN '{c}'" for c, w in V.KEYWORD_CLASSES.items()]
    return "CASE " + " ".join(cases) + " END"
