import pytest
from pyspark.sql import functions as F

from placeforge.functions import columns, naming, text

NO_BREVE = "Уракăва"


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Chełmno", "Chelmno"), ("Ørsted", "Orsted"), ("Straße", "Strasse"), ("Þór", "Thor"), ("İzmir", "Izmir"), ("São ½", "Sao 12"), ("Киров", ""), ("", "")],
)
def test_fold(raw, want):
    assert text.fold(raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Saint-Denis (Réunion)", "saint-denis-reunion"), ("  a - b  ", "a-b"), ("-x-", "-x-"), ("a_b.c", "a_bc"), ("Chełmno", "chelmno"), ("--", "-"), ("...", "")],
)
def test_slug(raw, want):
    assert text.slug(raw) == want


def test_columns_equal_functions(spark):
    raw = ["Chełmno", "plain Text-x", " a\tb ", "Ωmega", "", None, "x\x0by", "naïve—dash", "A_B--c", "…", "ab cd"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(raw)], "k int, t string")
    got = df.select("k", text.fold_column(F.col("t")).alias("f"), text.slug_column(F.col("t")).alias("s")).orderBy("k").collect()
    assert [r.f for r in got] == [None if t is None else text.fold(t) for t in raw]
    assert [r.s for r in got] == [None if t is None else text.slug(t) for t in raw]


@pytest.mark.parametrize(("v", "want"), [(0.1234565, "0.123456"), (35.9000005, "35.900000"), (-0.0000005, "-0.000000"), ("x", None), ("", None), (None, None), ("12", "12.000000")])
def test_fixed(v, want):
    assert text.fixed(v) == want


def test_mean_point():
    assert text.mean_point([("1.0", "2.0"), ("2.0", "4.0"), (None, "1")]) == ("1.500000", "3.000000")
    assert text.mean_point([]) == (None, None)


@pytest.mark.parametrize(
    ("raw", "lang", "want"),
    [("Ураково", "ru", "Urakovo"), ("Ивановка", "ru", "Ivanovka"), ("Αθήνα", "el", "Athina"), ("თბილისი", "ka", "Tbilisi"), ("Paris", "fr", None), ("東京", "ja", None), ("الغابة", "ar", None), ("서울", "ko", None), ("", "ru", None), ("123", "ru", None)],
)
def test_romanise(raw, lang, want):
    assert text.romanise(raw, lang) == want


@pytest.mark.parametrize(("raw", "want"), [(r"a\nb", "a\nb"), (r"a\\nb", r"a\nb"), (r"é\U0001F600", "é😀"), (r"\q \u12", r"\q \u12"), (r"\"x\"", '"x"')])
def test_unescape(raw, want):
    assert text.unescape(raw) == want


@pytest.mark.parametrize(("name", "ok"), [("Au", True), ("Y", True), ("--", False), ("  ", False), ("1", False), ("Іванівка (Полтавська область)", False), (NO_BREVE, False), ("x" * 101, False), ("x" * 100, True), ("", False), (None, False)])
def test_usable(name, ok):
    assert naming.usable(name) is ok


@pytest.mark.parametrize(
    ("labels", "native", "want"),
    [
        ({"en": "Munich", "de": "Munchen"}, "de", ("Munich", "en", None)),
        ({"mul": "Aarau", "de": "Aarau DE"}, "de", ("Aarau", "mul", None)),
        ({"de": "Zurich", "ca": "Zuric"}, "de", ("Zurich", "de", None)),
        ({"ce": "Afonino (Solton rayon)", "de": "Afonino"}, None, ("Afonino", "de", None)),
        ({"ce": "Afonino (Solton rayon)"}, None, ("Afonino (Solton rayon)", "ce", None)),
        ({"ru": "-"}, None, (None, None, None)),
        ({}, "de", (None, None, None)),
        (None, None, (None, None, None)),
        ({"ru": "Ивановка", "de": "Iwanowka"}, "ru", ("Ivanovka", "ru", "Ивановка")),
        ({"ar": "الغابة", "de": "Al-Ghaba"}, "ar", ("Al-Ghaba", "de", None)),
        ({"pl": "Arda (obwod)", "bg": "Арда"}, "bg", ("Arda", "bg", "Арда")),
        ({"cv": NO_BREVE, "ru": "Ураково"}, "ru", ("Urakovo", "ru", "Ураково")),
    ],
)
def test_resolve_name(labels, native, want):
    assert naming.resolve_name(labels, native) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Dushi (Baghlan Province)", ("Dushi", "Baghlan Province")),
        ("Eichholz (Werder (Havel))", ("Eichholz", "Werder (Havel)")),
        ("Baumgarten [Sonnenberg]", ("Baumgarten", "Sonnenberg")),
        ("(x)", ("(x)", None)),
        ("a) b)", ("a) b)", None)),
        ("Plain", ("Plain", None)),
        ("12 (x)", ("12 (x)", None)),
    ],
)
def test_strip_qualifier(raw, want):
    assert naming.strip_qualifier(raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Gorodskoe poselenie <<Gorod Zavitinsk>>", "Zavitinsk"),
        ("Munitsipal'noe obrazovanie <<Rabochiy poselok (pgt) Arkhara>>", "Arkhara"),
        ("Plain", "Plain"),
        ("x << 12 >>", "x << 12 >>"),
    ],
)
def test_strip_description(raw, want):
    assert naming.strip_description(raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Pavlovskaya, Vozhegodsky Selsoviet, Vologda Oblast", "Pavlovskaya"),
        ("Abiriba Post Office, Abiriba, Ohafia, Abia State", "Abiriba Post Office"),
        ("Washington, D.C.", "Washington, D.C."),
        ("Frunze, 2", "Frunze, 2"),
        ("a, b, c", "a, b, c"),
    ],
)
def test_strip_address(raw, want):
    assert naming.strip_address(raw) == want


def test_alt_names_columns_equal_functions(spark):
    cases = [({"en": ["b", "a"], "fr": ["x"], "de": ["z"]}, "de", None, None), ({"en": ["b"]}, None, "ru", "Ы"), (None, "de", "de", "ß"), ({"de": ["q"]}, "de", "de", "q"), ({}, "en", None, None)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a map<string,array<string>>, n string, l string, o string")
    got = [r.m for r in df.select("k", naming.alt_names_column(*map(F.col, "anlo")).alias("m")).orderBy("k").collect()]
    assert got == [naming.alt_names(a, n, (lang, o) if o else None) for a, n, lang, o in cases]


def test_values(spark):
    df = spark.createDataFrame([("Point(1.5 -2)", "12.9", "inf"), ("POINT(1e1 2)", "+4977954915", "x"), ("Point(1 2", "", "1e400"), (None, None, None)], "w string, a string, b string")
    lat, lng = columns.parse_point(F.col("w"))
    got = df.select(lat, lng, columns.parse_int(F.col("a")), columns.parse_int(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(-2.0, 1.5, 12, None), (2.0, 10.0, 4977954915, None), (None, None, None, None), (None, None, None, None)]
    got = spark.createDataFrame([("GB",), ("fr",), ("x1",), (None,)], "c string").select(columns.flag(F.col("c")), columns.country_tld(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("🇬🇧", ".uk"), ("🇫🇷", ".fr"), (None, ".x1"), (None, None)]
