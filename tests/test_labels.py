"""Hand-derived expectations, one or more per label rule."""

import re

import pytest

from hoardline.functions import vocabulary as V
from hoardline.functions.labels import with_labels
from hoardline.functions.text import literal_part

CASES = [
    # title, description, period, denomination, material, confidence, review
    ("Roman medal", "", "non_coin", None, None, 0.99, False),
    ("bank note", "", "non_coin", None, None, 0.99, False),
    ("bank note (series)", "", "non_coin", None, None, 0.99, False),
    ("bank note series", "", None, None, None, 0.3, True),
    ("bank notes", "", None, None, None, 0.3, True),
    ("Augustus aureus", "", "roman_imperial", "aureus", "gold", 0.9, False),
    ("Republik, Crawford 44/5", "", "roman_republican", None, None, 0.9, False),
    ("Prägungen der Stadt", "", "roman_republican", None, None, 0.9, False),
    ("Parthian drachm", "AR", "persian", "drachm", "silver", 0.95, False),
    ("Parthian, Pisidia, Nero", "", "persian", None, None, 0.95, False),
    ("Pisidia, Nero", "AE", "roman_provincial", None, "bronze", 0.95, False),
    ("Pisidia", "civic issue", "roman_provincial", None, None, 0.95, False),
    ("RPC 123, Trajan", "", "roman_provincial", None, None, 0.95, False),
    ("Hanover crown", "", "modern", "crown", None, 0.95, False),
    ("Parthian and Victorian", "", "modern", None, None, 0.95, False),
    ("Victoria, Nero", "", "roman_imperial", None, None, 0.9, True),
    ("Boii, imitation of Nero", "", "celtic", None, None, 0.9, False),
    ("stater", "", "celtic", "stater", None, 0.9, False),
    ("penny", "", "medieval", "penny", None, 0.9, False),
    ("Byzantine solidus, Nero", "", "byzantine", "solidus", "gold", 0.9, True),
    ("Crawford 4, Nero", "", "roman_republican", None, None, 0.9, True),
    ("Nero, Attica", "", "roman_imperial", None, None, 0.9, True),
    ("fals, Genoa", "", "islamic", "fals", None, 0.9, True),
    ("Corinth", "civic issue", "greek", None, None, 0.9, False),
    ("Shahi kings", "", "central_asian", None, None, 0.6, True),
    ("hemiobol", "", "greek", "hemiobol", None, 0.8, False),
    ("solidus", "", "byzantine", "solidus", "gold", 0.85, False),
    ("distater", "", "greek", "distater", None, 0.8, False),
    ("obol, Venice", "", "greek", "obol", None, 0.92, True),
    ("Venice drachm", "", "medieval", "drachm", None, 0.9, True),
    ("double sestertius", "", "roman_imperial", "double_sestertius", None, 0.9, False),
    ("toned as struck", "", None, "as", None, 0.3, True),
    ("gold and silver, av el", "", None, None, "silver", 0.3, True),
    ("ärepublic", "", None, None, None, 0.3, True),
    (None, None, None, None, None, 0.3, True),
]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, c[0], c[1]) for i, c in enumerate(CASES)]
    found = with_labels(spark.createDataFrame(rows, "id int, title string, description string"))
    return {r["id"]: r for r in found.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_label(labelled, i):
    row = labelled[i]
    got = (
        row["period"], row["denomination"], row["material"], row["label_confidence"], row["needs_review"]
    )
    assert got == CASES[i][2:], (CASES[i], row)


def test_notes_and_warnings(spark):
    rows = [(1, "obol, Venice", ""), (2, "Victoria, Nero", ""), (3, "Parthian and Victorian", "")]
    found = {
        r["id"]: r
        for r in with_labels(spark.createDataFrame(rows, "id int, title string, description string")).collect()
    }
    assert found[1]["warnings"] == ["Conflict: 'obol' vs 'medieval'"]
    assert found[1]["notes"] == ["Auto-corrected to greek via denomination constraint"]
    assert found[2]["warnings"] == [V.WARN_MODERN, V.WARN_MULTIPLE]
    assert found[3]["notes"] == [V.NOTE_PERSIAN, V.NOTE_MODERN]


def test_text_is_cut_into_words_once(spark):
    rows = spark.createDataFrame([(1, "a", "b")], "id int, title string, description string")
    plan = with_labels(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"[^\p{L}\p{N}_]+") == 1


@pytest.mark.parametrize("pattern", V.GROUP_LOT_PATTERNS + V.MODERN_PATTERNS)
def test_literal_part_is_inside_every_match(pattern):
    samples = (
        "lot of group of run of collection of 12 coins 7 pieces miscellaneous various bronze coins mixed lot "
        "1887 2014 victoria george iv william iv queen elizabeth euro dollar franc 1914 mark 1914 pfennig 1914 "
        "commemorative proof uncirculated piece mint"
    )
    match = re.search(pattern, samples)
    assert match and literal_part(pattern) in match.group(0)
