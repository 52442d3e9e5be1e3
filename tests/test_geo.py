from jobtide.functions import geo
from jobtide.queries.extraction import PLACES


def test_places(values):
    texts = [p[0] for p in PLACES]
    assert values(geo.canton("x"), texts) == [p[1] for p in PLACES]
    assert values(geo.city("x"), texts) == [p[2] for p in PLACES]


def test_word_bounded(values):
    texts = ["Fleurier", "Kanton Uri", "Zurich West", "Manufacturing", "Basel-Stadt", "Bern/Zug"]
    got = values(geo.canton("x", word_bounded=True), texts)
    assert got == [None, "UR", "ZH", None, "BS", "BE"]
    assert values(geo.canton("x"), texts) == ["UR", "UR", "ZH", "UR", "BS", "BE"]


def test_region(values):
    assert values(geo.region("x"), ["ZH", "TI", "XX", None]) == ["Zurich", "Ticino", None, None]
