import pytest
from pyspark.sql import functions as F

from hoardline.functions import paths, text


def values(frame, schema, rows, column):
    return [r[0] for r in frame(schema, *[(x,) for x in rows]).select(column).collect()]


@pytest.mark.parametrize(
    "value, wanted",
    [("12", 12), (" 7 ", 7), ("12.5", 0), ("A7", 0), ("", 0), (None, 0), ("-3", -3), ("99999999999", 99999999999)],
)
def test_safe_int(frame, value, wanted):
    assert values(frame, "x string", [value], text.safe_int(F.col("x"))) == [wanted]


def test_flags(frame):
    rows = ["1", " Yes", "t", "no", "0", "", None, "false"]
    got = values(frame, "x string", rows, text.is_set(F.col("x")))
    assert got == [True, True, True, False, False, False, True, False]


def test_nan(frame):
    assert values(frame, "x string", ["NaN", None, "a"], text.nan_safe(F.col("x"))) == ["", "", "a"]


@pytest.mark.parametrize(
    "path, wanted",
    [
        ("cng_459/Lot_03547.jpg", "raw/auctions/cng/459/Lot_03547.jpg"),
        ("./CNG_T23/a/b.jpg", "raw/auctions/cng/t23/a/b.jpg"),
        ("raw/auctions/x/1/a.jpg", None),
        ("nofolder.jpg", None),
        ("plain/a.jpg", None),
        ("_5/a.jpg", None),
        ("", None),
        (None, None),
        ("a_b_c/x.jpg", "raw/auctions/a/b_c/x.jpg"),
    ],
)
def test_canonical_raw_key(frame, path, wanted):
    assert values(frame, "x string", [path], paths.canonical_raw_key(F.col("x"))) == [wanted]


@pytest.mark.parametrize(
    "path, wanted",
    [
        ("processed/vision/v1/crops/Leu/t23/Lot_01006_obv_224.jpg", "leu_t23_01006"),
        ("data\\crops\\Leu\\1\\Lot_01006.jpg", "leu_1_01006"),
        ("x/leu_1_01006_rev.jpg", "leu_1_01006"),
        ("x/other.name.jpg", "other.name"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_lot_key(frame, path, wanted):
    assert values(frame, "x string", [path], paths.canonical_lot_key(F.col("x"))) == [wanted]


def test_lot_key_keeps_sides_apart(frame):
    rows = ["a/leu/1/Lot_00007_obv_224.jpg", "a/leu/1/Lot_00007_rev_224.jpg"]
    assert values(frame, "x string", rows, paths.canonical_lot_key(F.col("x"), True)) == [
        "leu_1_00007_obv", "leu_1_00007_rev",
    ]


@pytest.mark.parametrize(
    "house, sale, lot, wanted",
    [
        ("Leu ", "7", "12", "https://leunumismatik.com/en/lot/7/12"),
        ("spink", "20", "45", "https://www.spink.com/lot/20000045"),
        ("spink", "20", "A5", ""),
        ("spink", "20", "0", ""),
        ("kuenker_auex", "3", "9", "https://auex.de/de/product/3-9"),
        ("cng", None, "nan", ""),
        (None, "1", "1", ""),
        ("elsewhere", "1", "1", ""),
    ],
)
def test_lot_url(frame, house, sale, lot, wanted):
    row = frame("h string, s string, l string", (house, sale, lot))
    assert row.select(paths.lot_url(F.col("h"), F.col("s"), F.col("l"))).first()[0] == wanted


def test_urls(frame):
    rows = ["/a b/ü.jpg", "data/x.jpg", "/root/data/x.jpg", "http://h/x"]
    assert values(frame, "x string", rows, paths.public_url(F.col("x"), "https://h")) == [
        "https://h/a b/ü.jpg", "https://h/data/x.jpg", "https://h/root/data/x.jpg", "http://h/x",
    ]
    assert values(frame, "x string", rows[:1], paths.proxy_url(F.col("x"))) == ["/img?path=/a%20b/%C3%BC.jpg"]
    assert values(frame, "x string", rows[:3], paths.server_url(F.col("x"))) == [
        "/a b/ü.jpg", "/data/x.jpg", "/data/x.jpg",
    ]


def test_path_keys(frame):
    got = values(frame, "x string", ["/root/data/a.jpg", "./a.jpg", ""], paths.path_keys(F.col("x")))
    assert set(got[0]) == {"/root/data/a.jpg", "root/data/a.jpg", "a.jpg", "data/a.jpg"}
    assert got[1] == ["./a.jpg", "a.jpg"]
    assert got[2] == []


def test_path_kind(frame):
    rows = ["raw/a", "/processed/a", "ml/a", "other/raw/a", "", None]
    assert values(frame, "x string", rows, paths.path_kind(F.col("x"))) == [
        "store", "store", "store", "local", None, None,
    ]
    narrow = paths.path_kind(F.col("x"), ("raw", "processed"))
    assert values(frame, "x string", ["ml/a"], narrow) == ["local"]


def test_cluster_names(frame):
    rows = ["-1", "5-noise", "5-0", "Noise"]
    assert values(frame, "x string", rows, paths.cluster_label(F.col("x"))) == [
        "Noise", "Noise", "Cluster 5-0", "Noise",
    ]
    assert values(frame, "x string", rows, paths.cluster_key(F.col("x"))) == ["-1", "-1", "5-0", "-1"]


def test_lot_numbers(frame):
    rows = ["3-5", "42", "5-3"]
    assert values(frame, "x string", rows, paths.lot_numbers(F.col("x"))) == [[3, 4, 5], [42], []]


def test_parent_folder(frame):
    assert values(frame, "x string", ["a/b/c.jpg", "b/c.jpg", "c.jpg"], paths.parent_folder(F.col("x"))) == [
        "b", "b", "c.jpg",
    ]


def test_pattern_boundaries_are_those_of_the_sql(frame):
    """a letter outside ASCII ends a word there, and a dot passes a carriage return."""
    rows = ["la \u00f1dollar \u00f1ases", "xdollar", "dollars", "franc\r of 1950", "franc\n of 1950", "\u0661"]
    assert values(frame, "x string", rows, text.first_pattern(F.col("x"), [r"\bdollar\b", r"\bfranc\b.*\b19\d{2}\b", r"\d"])) == [
        r"\bdollar\b", None, None, r"\bfranc\b.*\b19\d{2}\b", r"\d", None
    ]
