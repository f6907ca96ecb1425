import pytest
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import geo, hours, payment, provenance, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


# Names and printed similarity of reviewed pairs.
GOLDEN_SET = [
    ("Kiosk Stadtbahn Landwasser", 'Kiosk an der Straßenbahnhaltestelle "Moosweiher"', 0.53),
    ("Kiosk am Werderplatz", "Erdal's Kiosk am Indianerbrunnen", 0.45),
    ("Kiosk Michelstadt", "Kiosk Stommel", 0.53),
]
GOLDEN_MULTISET = [
    ("Trinkhalle Trink + Babbelstubb", "Café & Bistro 38", 0.207),
    ("7 Day Shop 2 Go", "7 Days Lebensmittel", 0.296),
]


@pytest.mark.parametrize("a,b,sim", GOLDEN_SET)
def test_padded_similarity(spark, a, b, sim):
    got = one(spark, text.dice_set(text.fold_name(F.lit(a)), text.fold_name(F.lit(b))))
    assert round(got + 1e-9, 2) == sim


@pytest.mark.parametrize("a,b,sim", GOLDEN_MULTISET)
def test_multiset_similarity(spark, a, b, sim):
    got = one(spark, text.dice_multiset(text.normalise_name(F.lit(a)), text.normalise_name(F.lit(b))))
    assert round(got, 3) == sim


@pytest.mark.parametrize(
    "name,expected",
    [("Kiosk", ""), ("Späti am Eck", "am eck"), ("Caféshop", "café"), ("Öztürk's Büdchen", "oeztuerk s buedchen"), ("Shopping", "shopping")],
)
def test_generic_words(spark, name, expected):
    # An accented letter is no word character, so the generic word behind it is cut.
    assert one(spark, text.normalise_name(F.lit(name))) == expected


def test_fold_drops_accents(spark):
    assert one(spark, text.fold_name(F.lit("Ñandú-Straße Ä"))) == "nandu strasse a"


@pytest.mark.parametrize("a,b,expected", [("", "abc", 0.0), ("a", "a", 1.0), ("a", "b", 0.0), ("aaaa", "aaa", 0.8)])
def test_multiset_edges(spark, a, b, expected):
    assert one(spark, text.dice_multiset(F.lit(a), F.lit(b))) == pytest.approx(expected)


@pytest.mark.parametrize(
    "raw,expected",
    [("00:00-00:00", None), ("0:00 - 0:00", None), ("24/7", "24/7"), (" ", None), ("Mo 00:00-00:00; Tu 10:00-12:00", "Mo 00:00-00:00; Tu 10:00-12:00"),
     ("Fr 20:00-02:00", "Fr 20:00-02:00")],
)
def test_clean_hours(spark, raw, expected):
    assert one(spark, hours.clean_opening_hours(F.lit(raw))) == expected


def test_seed_hours_last_slot_wins(spark):
    ddl = "array<struct<day:string,openTime:array<int>,closeTime:array<int>>>"
    rows = [("MONDAY", [8, 0], [20, 0]), ("TUESDAY", [9], [22, 30]), ("MONDAY", [9, 0], [22, 30]), ("FRIDAY", [9, 0], [22, 30]), ("SUNDAY", None, [1, 0])]
    df = spark.createDataFrame([(rows,)], f"t {ddl}")
    assert df.select(hours.seed_hours(F.col("t")).alias("v")).collect()[0]["v"] == "Mo-Tu 09:00-22:30; Fr 09:00-22:30"


def test_wallet_and_terminal_order(spark):
    ids = ["crossbusiness.payments.applepay", "crossbusiness.payments.contactless_pay"]
    df = spark.createDataFrame([([(True, ids[0]), (False, ids[1])],), ([(False, ids[1]), (True, ids[0])],)], f"a {schema.AMENITIES_DDL}")
    got = [r["v"]["contactless"] for r in df.select(payment.amenities_to_payment(F.col("a")).alias("v")).collect()]
    assert got == ["no", "no"]


@pytest.mark.parametrize("source,rank", [(None, 2), ("", 2), ("user", 5), ("nobody", 0), ("hopfenstop", 1)])
def test_rank(spark, source, rank):
    assert one(spark, provenance.rank_of(F.lit(source).cast("string"))) == rank


@pytest.mark.parametrize("value,expected", [("8.5", 8.5), (" 9.1°E", 9.1), ("n/a", None), ("-.5", -0.5), ("", None)])
def test_lenient_coordinate(spark, value, expected):
    assert one(spark, geo.parse_coordinate(F.lit(value))) == expected


@pytest.mark.parametrize("name,expected", [("王记", True), ("Bar Li", True), ("Jin Tonic", False), ("Sport Nutrition", False), ("Wu Tang", False)])
def test_chinese_name(spark, name, expected):
    assert one(spark, rules.is_chinese_name(F.lit(name))) == expected


def test_empty_payment_differs_from_absent(spark):
    ddl = f"p {schema.PAYMENT}"
    rows = spark.createDataFrame([('{"p":{}}',), ("{}",)], "j string").select(F.from_json("j", ddl)["p"].isNotNull().alias("v")).collect()
    assert [r["v"] for r in rows] == [True, False]


def test_stamps_keep_other_paths(spark):
    df = spark.createDataFrame([({"a": "osm", "b": "user"},), (None,)], "m map<string,string>")
    out = [r["v"] for r in df.select(provenance.put_stamps(F.col("m"), {"a": F.lit("google"), "c": F.lit(None).cast("string")}).alias("v")).collect()]
    assert out == [{"b": "user", "a": "google"}, {"a": "google"}]
