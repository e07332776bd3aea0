"""Rule-based lot labels as one pipeline of column expressions.

The text is cut into words once for all vocabularies; the rules then work on the short array of words
found. Substring rules run only where they can still decide. Each stage is its own projection, so
Catalyst evaluates it once however often it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions import vocabulary as V
from hoardline.functions.text import (
    with_word_class,
    contains_any,
    first_pattern,
    has_any,
    longest_key_value,
    lot_text,
    words_found,
)

ANCIENT = ("roman_imperial", "roman_republican", "greek", "byzantine")
PRIORITY = ("byzantine", "roman_republican", "roman_imperial", "greek")

LABEL_COLUMNS = [
    "period", "denomination", "material", "label_confidence", "needs_review", "notes", "warnings",
]


def all_words() -> list[str]:
    """Every word the label rules look for."""
    return sorted(
        {w for words in V.PERIOD_WORDS.values() for w in words}
        | set(V.NON_COIN_WORDS)
        | set(V.DENOMINATIONS)
        | set(V.MATERIALS)
        | set(V.CELTIC_TRIBES)
    )


def with_signals(df: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """Add ``_text``, the words ``_found`` in it, the junk flag and the period ``signals``."""
    signals = [F.when(has_any(F.col("_found"), words), F.lit(p)) for p, words in V.PERIOD_WORDS.items()]
    return (
        df.withColumn("_text", lot_text(title, description))
        .withColumn("_found", words_found(F.col("_text"), all_words()))
        .withColumns(
            {
                "_junk": has_any(F.col("_found"), V.NON_COIN_WORDS),
                "signals": F.array_compact(F.array(*signals)),
            }
        )
    )


def with_labels(
    df: DataFrame, title: str = "title", description: str = "description"
) -> DataFrame:
    """Add period, denomination, material, confidence, review flag, notes and warnings."""
    text = F.col("_text")
    words = F.col("_found")

    def signal(period: str) -> Column:
        return F.array_contains("signals", period)

    count = F.size("signals")
    imperial_or_greek = signal("roman_imperial") | signal("greek")
    # Words are in hand; the text is searched for parts of words only where no word has decided.
    regional = (
        ~F.col("_junk")
        & ~signal("persian")
        & imperial_or_greek
        & (signal("roman_provincial") | contains_any(text, V.PROVINCIAL_REGIONS))
    )
    undecided = ~F.col("_junk") & (count == 0) & ~F.col("_tribe")
    found = (
        with_signals(df, title, description)
        .withColumns(
            {
                "_denomination": longest_key_value(words, V.DENOMINATIONS),
                "_material": longest_key_value(words, V.MATERIALS),
                "_tribe": has_any(words, V.CELTIC_TRIBES),
                "_provincial": regional,
            }
        )
        .withColumns(
            {
                "_city": undecided & contains_any(text, V.GREEK_CITIES),
                "_exotic": undecided & contains_any(text, V.EXOTIC_SIGNALS),
            }
        )
    )
    ancient = has_any(F.col("signals"), ANCIENT)
    # What each rule saw, before they compete.
    facts = found.withColumns(
        {
            "_modern": signal("modern") & ~ancient,
            "_mixed": signal("modern") & ancient,
            "_inferred": F.coalesce(
                *[
                    F.when(F.col("_denomination").isin(names), F.lit(period))
                    for period, (_, names) in V.DENOMINATION_INFERENCE.items()
                ]
            ),
            "_ranked": F.coalesce(
                *[F.when((count > 1) & signal(p), F.lit(p)) for p in PRIORITY],
                F.get("signals", F.lit(0)),
            ),
        }
    )
    # The first rule that applies decides.
    rule = (
        F.when(F.col("_modern"), "modern")
        .when(signal("persian"), "persian")
        .when(F.col("_provincial"), "provincial")
        .when(F.col("_tribe"), "tribe")
        .when(count > 0, "signal")
        .when(F.col("_city"), "city")
        .when(F.col("_exotic"), "exotic")
        .when(F.col("_inferred").isNotNull(), "inferred")
    )
    chosen = facts.withColumn("_rule", rule).withColumns(
        {
            "_chosen": F.when(F.col("_rule") == "modern", "modern")
            .when(F.col("_rule") == "persian", "persian")
            .when(F.col("_rule") == "provincial", "roman_provincial")
            .when(F.col("_rule") == "tribe", "celtic")
            .when(F.col("_rule") == "signal", F.col("_ranked"))
            .when(F.col("_rule") == "city", "greek")
            .when(F.col("_rule") == "exotic", "central_asian")
            .when(F.col("_rule") == "inferred", F.col("_inferred")),
            "_score": F.when(F.col("_rule").isin("modern", "persian", "provincial"), F.lit(0.95))
            .when(F.col("_rule").isin("tribe", "city"), F.lit(0.90))
            .when(F.col("_rule") == "exotic", F.lit(0.60))
            .when(
                F.col("_rule") == "inferred",
                F.coalesce(
                    *[
                        F.when(F.col("_inferred") == period, F.lit(score))
                        for period, (score, _) in V.DENOMINATION_INFERENCE.items()
                    ]
                ),
            )
            .otherwise(F.lit(0.0)),
        }
    )
    periods_of = "\n".join(f"{name}={','.join(p)}" for name, p in V.DENOMINATION_PERIODS.items())
    allowed = F.split(
        F.element_at(F.str_to_map(F.lit(periods_of), F.lit("\n"), F.lit("=")), F.col("_denomination")),
        ",",
    )
    checked = (
        chosen.withColumn("_allowed", allowed)
        .withColumn(
            "_conflict",
            F.coalesce(~F.array_contains("_allowed", F.col("_chosen")), F.lit(False)),
        )
        .withColumn("_corrected", F.col("_conflict") & (F.size("_allowed") == 1))
        .withColumn(
            "_period",
            F.when(F.col("_corrected"), F.get("_allowed", F.lit(0))).otherwise(F.col("_chosen")),
        )
        .withColumn(
            "_score",
            F.when(F.col("_corrected"), F.greatest("_score", F.lit(0.92))).otherwise(F.col("_score")),
        )
    )

    def note(condition: Column, message: Column | str) -> Column:
        return F.when(condition, F.lit(message) if isinstance(message, str) else message)

    by_rule = F.col("_rule")
    notes = F.array_compact(
        F.array(
            note(signal("persian"), V.NOTE_PERSIAN),
            note(F.col("_provincial"), V.NOTE_PROVINCIAL),
            note(F.col("_modern"), V.NOTE_MODERN),
            note(by_rule == "tribe", V.NOTE_CELTIC),
            note(by_rule == "city", V.NOTE_CITY),
            note(by_rule == "exotic", V.NOTE_EXOTIC),
            *[
                note((by_rule == "inferred") & (F.col("_inferred") == p), message)
                for p, message in V.NOTE_INFERRED.items()
            ],
            note(
                F.col("_corrected"),
                F.format_string("Auto-corrected to %s via denomination constraint", "_period"),
            ),
        )
    )
    warnings = F.array_compact(
        F.array(
            note(F.col("_mixed"), V.WARN_MODERN),
            note((by_rule == "signal") & (count > 1), V.WARN_MULTIPLE),
            note(
                F.col("_conflict"),
                F.format_string("Conflict: '%s' vs '%s'", "_denomination", "_chosen"),
            ),
            note(F.col("_period").isNull(), V.WARN_NO_PERIOD),
        )
    )
    junk = F.col("_junk")
    none = F.array().cast("array<string>")
    confidence = (
        F.when(junk, F.lit(0.99))
        .when(F.col("_score") > 0, F.col("_score"))
        .when(F.col("_period").isNotNull(), F.lit(0.9))
        .otherwise(F.lit(0.3))
    )
    finished = checked.withColumns(
        {
            "period": F.when(junk, "non_coin").otherwise(F.col("_period")),
            "denomination": F.when(~junk, F.col("_denomination")),
            "material": F.when(~junk, F.col("_material")),
            "label_confidence": confidence,
            "notes": F.when(junk, F.array(F.lit(V.NOTE_NON_COIN))).otherwise(notes),
            "warnings": F.when(junk, none).otherwise(warnings),
        }
    ).withColumn(
        "needs_review",
        ~junk
        & (
            F.col("period").isNull()
            | (F.col("label_confidence") < 0.6)
            | (F.size("warnings") > 0)
            | (by_rule == "exotic")
        ),
    )
    kept = [c for c in df.columns if c not in LABEL_COLUMNS]
    return finished.select(*kept, *LABEL_COLUMNS)


def keyword_label(title: str, description: str) -> Column:
    """First class with a keyword anywhere inside the text; provincial and republic come first."""
    text = lot_text(title, description)
    ordered = {"roman_provincial": ["provincial"], "roman_republican": ["republic"]}
    branches = [F.when(contains_any(text, words), F.lit(c)) for c, words in ordered.items()]
    branches += [
        F.when(contains_any(text, words), F.lit(c)) for c, words in V.KEYWORD_CLASSES.items()
    ]
    return F.coalesce(*branches)


def denomination_spelling(text: Column) -> Column:
    """First denomination, in declaration order, whose singular or plural occurs."""
    return F.coalesce(
        *[
            F.when(F.lower(text).rlike(with_word_class(pattern)), F.lit(name))
            for name, pattern in V.DENOMINATION_SPELLINGS.items()
        ]
    )


def group_lot_pattern(text: Column) -> Column:
    return first_pattern(F.lower(F.coalesce(text, F.lit(""))), V.GROUP_LOT_PATTERNS)


def modern_pattern(text: Column) -> Column:
    return first_pattern(F.lower(F.coalesce(text, F.lit(""))), V.MODERN_PATTERNS)
