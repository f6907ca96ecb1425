"""Which map elements count as kiosks, and how their tags become attributes.

Every function takes the tag map (and the ISO code of the region) as columns
and returns one boolean, string, struct or array column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import text
from poifuse.functions.text import has_text, whole_words

# Spanish convenience chains, specialty grocers and corner-shop words.
CONVENIENCE_CHAINS = (
    "carrefour|supercor|dia|simply|sprint|repsol|shell|bp|cepsa|galp|circle k|avia|coviran|spar|alcampo|eroski|"
    "lidl|aldi|mercadona|corte ingles|opencor|open cor|udaco|suma|condis|bonarea|claudio|tangerina|sqrups|"
    "eneryeti|4eco|martin martin|hiper buenamente|trady"
)
SPECIALTY_GROCERS = (
    "frutas|fruteria|verduras|verduleria|carniceria|panaderia|pescaderia|herbolario|latinos?|productos|gourmet|"
    "ecologic[ao]|organic|bio|halal|farmacia|estanco|nutrition|piensos|casqueria|embutidos"
)
CORNER_SHOP_WORDS = (
    "alimentacion|aliment|chin[oa]s?|autoservicio|tienda|ultramarinos|comestibles|colmado|super|supermercado|"
    "mercadito|asia|24 ?h|24 horas|open ?2[45]|express"
)
CORNER_SHOP_ENDINGS = "bazar|market"
# Common Chinese surnames, and names that contain one by accident.
CHINESE_SURNAMES = (
    "wang|zhang|chen|liu|huang|zhou|zhao|wu|xu|lin|yang|zheng|zhu|guo|luo|gao|xie|cai|dong|jiang|xin|li|jin|hong|"
    "ming|wen|xia|peng|feng|deng|tang|han|shen|qian|fang|xiao|zeng|kong|bai|yan|wei|qiu|hu|ren|yu|ye"
)
CHINESE_FALSE_FRIENDS = "ye[ -]?ye|jin ?tonic|wu ?tang|martel ?li|china ?town|porcelana china|sushi|bocai"
# Beverage markets and their chains.
BEVERAGE_MARKET = "getraenke ?markt|getraenkeland"
BEVERAGE_CHAINS = [
    "fristo", "trinkgut", "getraenke hoffmann", "dursty", "hol ab", "orterer",
    "trink und spare", "getraenke geins", "getraenke quelle",
]
# Spanish kiosks that sell papers, lottery tickets or tobacco.
NON_DRINK_WORDS = (
    "prensa|premsa|revistas?|periodicos?|loterias?|apuestas|estanco|tabacs?|tabacos?|papeleria|papereria|"
    "libreria|llibreria|libros|llibres|comics?|cromos"
)
# Shop and amenity values of the broad candidate search.
CANDIDATE_SHOPS = ["kiosk", "beverages", "convenience", "alcohol", "wine", "tobacco", "newsagent", "deli", "food"]
CANDIDATE_AMENITIES = ["fast_food", "cafe", "pub", "bar"]
BAR_AMENITIES = ["bar", "cafe", "pub"]
KIOSK_SHOPS = ["kiosk", "beverages"]


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def _is(tags: Column, key: str, *values: str) -> Column:
    return F.coalesce(tag(tags, key).isin(*values), F.lit(False))


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def is_spain(iso: Column) -> Column:
    return _true(iso.startswith("ES"))


def is_chinese_name(name: Column) -> Column:
    plain = text.spanish_name(name)
    return _true(
        name.rlike("[㐀-鿿]")
        | (
            ~plain.rlike(whole_words(CHINESE_FALSE_FRIENDS) + "|·")
            & plain.rlike(f"(^|[^a-z])(chin[oa]s?|{CHINESE_SURNAMES})([^a-z]|$)")
        )
    )


def is_corner_shop(tags: Column) -> Column:
    """An unbranded convenience shop whose name reads like an independent corner shop."""
    name, operator = tag(tags, "name"), tag(tags, "operator")
    excluded = whole_words(CONVENIENCE_CHAINS) + "|" + whole_words(SPECIALTY_GROCERS)
    wanted = (
        whole_words(CORNER_SHOP_WORDS) + f"|(?:{CORNER_SHOP_ENDINGS})" + text.WORD_END
    )
    plain = text.spanish_name(name)
    return (
        ~has_text(tag(tags, "brand"))
        & ~has_text(tag(tags, "brand:wikidata"))
        & has_text(name)
        & ~_true(plain.rlike(excluded))
        & ~_true(text.spanish_name(operator).rlike(excluded))
        & (_true(plain.rlike(wanted)) | is_chinese_name(name))
    )


def is_chinese_run_bar(tags: Column) -> Column:
    name = tag(tags, "name")
    return has_text(name) & is_chinese_name(name)


def name_is_beverage_market(name: Column) -> Column:
    plain = text.chain_name(name)
    return _true(plain.rlike(BEVERAGE_MARKET + "|" + "|".join(BEVERAGE_CHAINS)))


def is_beverage_market(tags: Column) -> Column:
    named = F.lit(False)
    for key in ("name", "brand", "operator"):
        named = named | name_is_beverage_market(tag(tags, key))
    return named | (_is(tags, "shop", "beverages") & has_text(tag(tags, "brand:wikidata")))


def is_spanish_non_drink_kiosk(tags: Column) -> Column:
    lottery = tag(tags, "lottery")
    found = has_text(lottery) & _true(lottery != "no")
    for key in ("name", "brand", "operator"):
        raw = tag(tags, key)
        plain = text.spanish_name(raw)
        found = (
            found
            | _true(raw.rlike(whole_words("ONCE")))
            | _true(F.trim(plain) == "once")
            | _true(plain.rlike(whole_words(NON_DRINK_WORDS)))
        )
    return found


def is_wanted(tags: Column, iso: Column) -> Column:
    """Would this element be imported into a region with this ISO code?"""
    spain = is_spain(iso)
    return (
        F.when(~has_text(tag(tags, "name")), F.lit(False))
        .when(spain & _is(tags, "shop", "convenience"), is_corner_shop(tags))
        .when(spain & _is(tags, "amenity", *BAR_AMENITIES), is_chinese_run_bar(tags))
        .when(~_is(tags, "shop", *KIOSK_SHOPS), F.lit(False))
        .when(is_beverage_market(tags), F.lit(False))
        .when(spain & is_spanish_non_drink_kiosk(tags), F.lit(False))
        .otherwise(F.lit(True))
    )


def query_groups(kind: Column, tags: Column, iso: Column) -> Column:
    """All query groups whose selectors pick the element (nodes and ways only)."""
    spain_named = is_spain(iso) & tag(tags, "name").isNotNull()
    groups = F.array_compact(
        F.array(
            F.when(_is(tags, "shop", *KIOSK_SHOPS), "kiosk"),
            F.when(spain_named & _is(tags, "shop", "convenience"), "convenience"),
            F.when(spain_named & _is(tags, "amenity", *BAR_AMENITIES), "bar"),
        )
    )
    return F.when(kind.isin("node", "way"), groups).otherwise(F.array().cast("array<string>"))


def group_of_kind(kind: Column) -> Column:
    return F.when(kind.isin("convenience", "bar"), kind).otherwise("kiosk")


def in_region_area(lng: Column, lat: Column, area_codes: Column, region: Column) -> Column:
    """Area selection: catch-all regions by landed area code, city regions by box."""
    boxed = lng.between(region["w"], region["e"]) & lat.between(region["s"], region["n"])
    in_area = F.array_contains(area_codes, region["iso3166_2"])
    clipped = F.coalesce(region["bbox_clip"], F.lit(False))
    return _true(F.when(region["role"] == "rest", in_area & (~clipped | boxed)).otherwise(boxed))


def is_match_candidate(tags: Column) -> Column:
    return _is(tags, "shop", *CANDIDATE_SHOPS) | (
        _is(tags, "amenity", *CANDIDATE_AMENITIES) & tag(tags, "name").isNotNull()
    )


def detect_kind(tags: Column) -> Column:
    return (
        F.when(
            _is(tags, "amenity", "vending_machine") | _is(tags, "self_service", "only") | _is(tags, "automated", "yes"),
            "vending_machine",
        )
        .when(_is(tags, "shop", "convenience"), "convenience")
        .when(_is(tags, "amenity", *BAR_AMENITIES), "bar")
    )


def tri_state(value: Column) -> Column:
    return F.when(value.isin("yes", "only"), "yes").when(value == "no", "no").when(value.isNotNull(), "unknown")


def _payment_columns(tags: Column) -> dict[str, Column]:
    def state(*keys: str) -> Column:
        return tri_state(F.coalesce(*[tag(tags, f"payment:{key}") for key in keys]))

    credit, debit = state("credit_cards"), state("debit_cards")
    wallet = _true(state("apple_pay") == "yes") | _true(state("google_pay") == "yes")
    return {
        "cash": state("cash"),
        "cards": F.when((credit == "yes") | (debit == "yes"), "yes")
        .when((credit == "no") & (debit == "no"), "no")
        .when(credit.isNotNull() | debit.isNotNull(), "unknown"),
        "contactless": F.when(wallet, "yes").otherwise(state("contactless")),
        "girocard": state("girocard", "ec_cards"),
    }


def payment_struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[columns[key].alias(key) for key in schema.PAYMENT_KEYS])


def map_payment(tags: Column) -> Column:
    """Payment block of an element: null when no key is set, else the gaps are "unknown"."""
    columns = _payment_columns(tags)
    any_set = F.coalesce(*columns.values()).isNotNull()
    filled = {key: F.coalesce(value, F.lit("unknown")) for key, value in columns.items()}
    return F.when(any_set, payment_struct(filled))


def payment_offers(tags: Column) -> dict[str, list[Column]]:
    """Payment values an element offers to an existing feature, in writing order.

    A wallet tag writes contactless a second time, after the plain tag.
    """
    columns = _payment_columns(tags)
    contactless = tri_state(tag(tags, "payment:contactless"))
    wallet = _true(tri_state(tag(tags, "payment:apple_pay")) == "yes") | _true(
        tri_state(tag(tags, "payment:google_pay")) == "yes"
    )
    return {
        "cash": [columns["cash"]],
        "cards": [columns["cards"]],
        "contactless": [contactless, F.when(wallet, F.lit("yes"))],
        "girocard": [columns["girocard"]],
    }


def map_tags(tags: Column) -> Column:
    """Vocabulary slugs implied by element tags."""
    return F.array_compact(
        F.array(
            F.when(_is(tags, "toilets", "yes"), "wc"),
            F.when(_is(tags, "wheelchair", "yes"), "barrierefrei"),
            F.when(_is(tags, "outdoor_seating", "yes"), "draussen"),
            F.when(_is(tags, "indoor_seating", "yes") | _is(tags, "seating", "yes"), "sitzgelegenheiten"),
            F.when(_is(tags, "smoking", "yes", "outside"), "raucherbereich"),
            F.when(_is(tags, "covered", "yes"), "ueberdacht"),
            F.when(_is(tags, "vending", "drinks", "beverages"), "automat"),
        )
    )


def address_from_tags(tags: Column) -> dict[str, Column]:
    return {
        "street": tag(tags, "addr:street"),
        "number": tag(tags, "addr:housenumber"),
        "postalcode": text.postcode(tag(tags, "addr:postcode")),
        "city": tag(tags, "addr:city"),
        "district": F.coalesce(tag(tags, "addr:suburb"), tag(tags, "addr:neighbourhood")),
    }
