"""Payment facts from place pages and place-search results, and how they merge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poifuse import schema
from poifuse.functions import provenance as prov
from poifuse.functions.rules import payment_struct

# Amenity identifiers and the label patterns of the result section.
WALLET_AMENITY = "crossbusiness.payments.applepay"
CONTACTLESS_AMENITY = "crossbusiness.payments.contactless_pay"
SECTION_NAME = "zahlung|payment"
LABELS = {
    "girocard": r"girocard|ec[-\s]?karte|debit",
    "cards": "kredit|credit",
    "contactless": "kontaktlos|contactless|nfc",
    "wallet": r"google\s?pay|apple\s?pay|mobile|samsung\s?pay",
    "cash": "bargeld|cash",
}


def _empty() -> dict[str, Column]:
    return {key: F.lit(None).cast("string") for key in schema.PAYMENT_KEYS}


def _with(current: Column, **changes: Column) -> Column:
    return payment_struct({key: changes.get(key, current[key]) for key in schema.PAYMENT_KEYS})


def amenities_to_payment(amenities: Column) -> Column:
    """Fold over the amenity list; order matters only for "set if still unset"."""
    def add(state: Column, amenity: Column) -> Column:
        present = F.when(amenity["amenityPresent"], "yes").when(~amenity["amenityPresent"], "no")
        yes = F.coalesce(present == "yes", F.lit(False))
        wallet = F.coalesce(amenity["amenityId"] == WALLET_AMENITY, F.lit(False)) & yes
        terminal = F.coalesce(amenity["amenityId"] == CONTACTLESS_AMENITY, F.lit(False)) & present.isNotNull()
        return _with(
            state,
            contactless=F.when(terminal, present)
            .when(wallet, F.coalesce(state["contactless"], F.lit("yes")))
            .otherwise(state["contactless"]),
            cards=F.when(wallet | (terminal & yes), F.coalesce(state["cards"], F.lit("yes"))).otherwise(state["cards"]),
        )

    entries = F.coalesce(amenities, F.array().cast(schema.AMENITIES_DDL))
    return F.aggregate(entries, payment_struct(_empty()), add)


def about_to_payment(about: Column) -> Column:
    """Options of the first payment section; a later option overwrites an earlier one."""
    sections = F.filter(about, lambda a: F.coalesce(F.lower(a["name"]).rlike(SECTION_NAME), F.lit(False)))
    options = F.get(sections, F.lit(0))["options"]

    def add(state: Column, option: Column) -> Column:
        label = F.lower(F.coalesce(option["name"], F.lit("")))
        value = F.when(option["enabled"], "yes").otherwise("no")
        hit = F.lit(None).cast("string")
        for name, pattern in reversed(LABELS.items()):
            hit = F.when(label.rlike(pattern), F.lit(name)).otherwise(hit)

        def chosen(name: str) -> Column:
            return F.coalesce(hit == name, F.lit(False))

        return _with(
            state,
            cash=F.when(chosen("cash"), value).otherwise(state["cash"]),
            girocard=F.when(chosen("girocard"), value).otherwise(state["girocard"]),
            cards=F.when(chosen("cards"), value)
            .when(chosen("girocard") & (value == "yes"), F.coalesce(state["cards"], F.lit("yes")))
            .otherwise(state["cards"]),
            contactless=F.when(chosen("contactless"), value)
            .when(chosen("wallet") & (value == "yes"), F.lit("yes"))
            .otherwise(state["contactless"]),
        )

    empty_options = F.array().cast("array<struct<name:string,enabled:boolean>>")
    return F.aggregate(F.coalesce(options, empty_options), payment_struct(_empty()), add)


def embedded_json(html: Column, marker: str, ddl: str) -> Column:
    """JSON value that follows a marker in a page; null when absent or unreadable."""
    start = F.instr(html, marker)
    rest = F.substring(html, start + F.lit(len(marker)), F.length(html))
    return F.when(start > 0, F.from_json(rest, ddl))


def page_amenities(html: Column) -> Column:
    return embedded_json(html, '"amenityV2":', schema.AMENITIES_DDL)


def page_weekly_hours(html: Column) -> Column:
    return embedded_json(html, '"businessHours":', schema.BUSINESS_HOURS_DDL)["weeklyHours"]


def write_payment(
    payment: Column, stamps: Column, offers: dict[str, list[Column]], source: str
) -> tuple[Column, dict[str, Column], Column]:
    """Offer values per key to a payment block.

    Blanks and "unknown" are filled by any concrete value; a differing settled
    value is replaced only if the source ranks at least as high as its stamp.
    Returns the new block, the stamp changes and the number of writes.
    """
    values, changes, writes = {}, {}, F.lit(0)
    for key in schema.PAYMENT_KEYS:
        path = f"payment.{key}"
        current, stamp, changed = payment[key], prov.stamp_of(stamps, path), F.lit(False)
        for offer in offers.get(key, []):
            concrete = F.coalesce(offer != "unknown", F.lit(False))
            missing = current.isNull() | (current == "unknown")
            outranks = F.lit(schema.SOURCE_RANK[source]) >= prov.rank_of(stamp)
            write = concrete & (missing | ((current != offer) & outranks))
            writes = writes + write.cast("int")
            current = F.when(write, offer).otherwise(current)
            stamp = F.when(write, F.lit(source)).otherwise(stamp)
            changed = changed | write
        values[key] = current
        changes[path] = F.when(changed, F.lit(source))
    block = F.when(payment.isNotNull() | (writes > 0), payment_struct(values))
    return block, changes, writes


def merge_payment(payment: Column, incoming: Column, stamps: Column, source: str) -> tuple[Column, dict[str, Column], Column]:
    return write_payment(payment, stamps, {key: [incoming[key]] for key in schema.PAYMENT_KEYS}, source)


def merge_hours(hours: Column, incoming: Column, stamps: Column, source: str) -> tuple[Column, dict[str, Column], Column]:
    """Write hours if the rank allows; an equal value only renews the stamp.

    Returns the new hours, the stamp change and whether the value changed.
    """
    allowed = incoming.isNotNull() & prov.can_write(stamps, "hours", source)
    changed = allowed & F.coalesce(hours["raw"] != incoming, F.lit(True))
    value = F.when(changed, F.struct(incoming.alias("raw"))).otherwise(hours)
    return value, {"hours": F.when(allowed, F.lit(source))}, changed


def payment_missing(payment: Column) -> Column:
    return payment["cards"].isNull() & payment["contactless"].isNull()


def hours_missing(hours: Column) -> Column:
    return F.coalesce(hours["raw"] == "", F.lit(True))
