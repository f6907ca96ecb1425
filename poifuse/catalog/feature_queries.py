"""Queries on feature rows: filters, provenance, payment and hours facts, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from poifuse import schema
from poifuse.catalog import standins as st
from poifuse.catalog.element_queries import (
    DISTRICT_SQL, HOURS_SQL, KIND_SQL, LOCATED, PAY_SQL, PLZ_SQL, TAG_SQL,
    BLOCK_SQL, WALLET, clean_hours_sql, market_sql, tri,
)
from poifuse.catalog.registry import query
from poifuse.functions import hours as hrs
from poifuse.functions import payment as pay
from poifuse.functions import provenance as prov
from poifuse.functions import rules
from poifuse.operators import dedup, merge, stats
from poifuse.operators.skew import dealt
from poifuse.plans import backfill, enrich, refresh, seed
from poifuse.sources import readers

FT = st.cte("ft", st.FEATURE)
EL = st.cte("el", st.ELEMENT)
SINCE = "2024-01-18"
TTL = "coalesce(date_diff('day', TRY_CAST({} AS DATE), DATE '" + st.AS_OF + "') >= 30, true)"
PAY_MISSING = "(cards IS NULL AND contactless IS NULL)"
HOURS_MISSING = "(coalesce(hours, '') = '')"
APPLE = "CASE WHEN s_apple THEN 'a' || k END"
GMAPS = "CASE WHEN gmaps_id NOT IN ('payment', 'gmaps') THEN gmaps_id END"
WORK = f"coalesce(kind, '') <> 'vending_machine' AND length(name) >= 3 AND (NOT s_apple OR {PAY_MISSING} OR {HOURS_MISSING})"
OSM_ONLY = "(s_osm AND NOT s_seed AND NOT s_apple AND gmaps_id IS NULL)"
FRESH = f"coalesce(greatest(TRY_CAST(created AS DATE), TRY_CAST(updated AS DATE)) >= DATE '{SINCE}', false)"
SOURCES = f"array_to_string({st.FEATURE_SOURCES_SQL}, ',')"
FT_STAMPS = dict(st.STAMP_COLUMNS)


@query(
    "FLT13 FLT14 FLT15 FLT17 FLT18 FLT19 PRJ17 FLT16",
    f"WITH {FT} SELECT k, s_osm AS has_osm, {OSM_ONLY} AS osm_only, NOT (coalesce(street, '') <> '' AND coalesce(number, '') <> '') AS needs_address, "
    f"{FRESH} AS fresh_since, {PAY_MISSING} AS payment_missing, {HOURS_MISSING} AS hours_missing, {TTL.format('apple_id_attempted')} AS id_due, "
    f"{TTL.format('google_attempted')} AS google_due, {APPLE} AS apple_id, {GMAPS} AS gmaps_id, s_osm AND {market_sql('name')} AS market, ({WORK}) AS in_worklist FROM ft",
)
def feature_flags(spark, sf):
    f = st.features(spark, sf)
    s = F.col("sources")
    work = enrich.worklist(f).select("k", F.lit(True).alias("w"))
    _, markets = refresh.purge_markets(f)
    market = markets.select("k", F.lit(True).alias("m"))
    return f.join(work, "k", "left").join(market, "k", "left").select(
        "k",
        prov.has_source(s, "osm").alias("has_osm"),
        prov.is_osm_only(s).alias("osm_only"),
        backfill.needs_address().alias("needs_address"),
        backfill.is_fresh_since(SINCE).alias("fresh_since"),
        pay.payment_missing(F.col("payment")).alias("payment_missing"),
        pay.hours_missing(F.col("hours")).alias("hours_missing"),
        enrich.due(F.col("apple_id_attempted"), st.AS_OF).alias("id_due"),
        enrich.due(F.col("google_attempted"), st.AS_OF).alias("google_due"),
        prov.apple_id(s).alias("apple_id"),
        prov.gmaps_id(s).alias("gmaps_id"),
        F.coalesce("m", F.lit(False)).alias("market"),
        F.coalesce("w", F.lit(False)).alias("in_worklist"),
    )


@query(
    "AGG8 WIN6",
    f"WITH {FT} SELECT count(*) AS considered, count_if(NOT s_apple) AS needs_id, count_if({PAY_MISSING}) AS needs_payment, count_if({HOURS_MISSING}) AS needs_hours FROM ft WHERE {WORK}",
)
def enrichment_counters(spark, sf):
    return enrich.worklist_counters(st.features(spark, sf))


@query(
    "FLT16 WIN6 WIN7",
    f"WITH {FT} SELECT id FROM ft WHERE {WORK} ORDER BY region, id LIMIT 50",
)
def capped_worklist(spark, sf):
    return enrich.capped(enrich.worklist(st.features(spark, sf)), 50)[0].select("id")


SOURCE_OF_EVENT = "CASE event_type WHEN 'view' THEN 'hopfenstop' WHEN 'click' THEN 'osm' WHEN 'signup' THEN 'apple' WHEN 'purchase' THEN 'google' WHEN 'error' THEN 'user' ELSE event_type END"


@query(
    "PRJ16",
    f"WITH c AS (SELECT user_id, {SOURCE_OF_EVENT} AS source, value, ts, event_id FROM events), "
    f"r AS (SELECT *, {st.rank_sql('source')} AS rank FROM c), w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank DESC, ts DESC, event_id DESC) AS rn FROM r) "
    "SELECT user_id, source, rank, value, 3 >= rank AS apple_may_write FROM w WHERE rn = 1",
)
def winning_claims(spark, sf):
    claims = st.table(spark, sf, "events").selectExpr("user_id", f"{SOURCE_OF_EVENT} AS source", "value", "ts", "event_id")
    ranked = claims.withColumn("rank", prov.rank_of(F.col("source")))
    best = F.max_by(F.struct("source", "rank", "value"), F.struct("rank", "ts", "event_id")).alias("b")
    won = ranked.groupBy("user_id").agg(best).select("user_id", "b.*")
    stamps = F.create_map(F.lit("hours"), F.col("source"))
    return won.select("user_id", "source", "rank", "value", prov.can_write(stamps, "hours", "apple").alias("apple_may_write"))


@query(
    "MRG14 FLT18",
    f"WITH c AS (SELECT user_id, CAST(max(CASE WHEN event_type = 'click' THEN ts END) AS DATE) AS tried, count_if(event_type = 'purchase') AS bought, "
    "count_if(event_type = 'error') AS failed FROM events GROUP BY user_id), "
    "d AS (SELECT *, coalesce(date_diff('day', tried, DATE '2024-02-15') >= 30, true) AS due FROM c) "
    "SELECT user_id, due, CASE WHEN NOT due THEN strftime(tried, '%Y-%m-%d') WHEN bought > 0 THEN NULL ELSE '2024-02-15' END AS id_attempted, "
    "CASE WHEN NOT due OR failed > 0 THEN strftime(tried, '%Y-%m-%d') ELSE '2024-02-15' END AS google_attempted FROM d",
)
def attempt_stamps(spark, sf):
    kind = F.col("event_type")
    seen = st.table(spark, sf, "events").groupBy("user_id").agg(
        F.date_format(F.max(F.when(kind == "click", F.col("ts"))), "yyyy-MM-dd").alias("tried"),
        F.count_if(kind == "purchase").alias("bought"),
        F.count_if(kind == "error").alias("failed"),
    )
    due = enrich.due(F.col("tried"), st.AS_OF)
    tried, bought = F.col("tried"), F.col("bought") > 0
    return seen.select(
        "user_id",
        due.alias("due"),
        enrich.attempt_stamp(tried, due, bought, True, st.AS_OF).alias("id_attempted"),
        enrich.attempt_stamp(tried, due & (F.col("failed") == 0), bought, False, st.AS_OF).alias("google_attempted"),
    )


# Hours. One schedule per order: line number and quantity give day and slot.
SLOT = "lpad(CAST(CAST(l_quantity AS INT) % 4 + 6 AS STRING), 2, '0') || ':00-' || lpad(CAST(CAST(l_quantity AS INT) % 3 + 18 AS STRING), 2, '0') || ':30'"
DAY_NAMES = "['Mo', 'Tu', 'We', 'Th', 'Fr', 'Sa', 'Su']"
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


def islands_sql(rows: str, value: str, key: str = "l_orderkey") -> str:
    return (
        f"i AS (SELECT {key}, {value}, day, day - row_number() OVER (PARTITION BY {key}, {value} ORDER BY day) AS g FROM {rows}), "
        f"runs AS (SELECT {key}, {value}, min(day) AS a, max(day) AS b FROM i GROUP BY {key}, {value}, g)"
    )


LABEL = f"CASE WHEN a = b THEN {DAY_NAMES}[a + 1] ELSE {DAY_NAMES}[a + 1] || '-' || {DAY_NAMES}[b + 1] END"
LAST_SLOT = (
    f"s AS (SELECT l_orderkey, l_linenumber % 7 AS day, arg_max(slot, pos) AS slot FROM (SELECT l_orderkey, l_linenumber, {SLOT} AS slot, "
    f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS pos FROM lineitem) GROUP BY 1, 2)"
)


def _schedules(spark, sf):
    """Per order its schedule entries, reduced to the last line of a day before they are gathered."""
    q = F.col("l_quantity").cast("int")
    day = F.get(F.array(*[F.lit(d) for d in hrs.UPPER_DAYS]), F.col("l_linenumber") % 7)
    times = F.struct(F.array(q % 4 + 6, F.lit(0)).alias("openTime"), F.array(q % 3 + 18, F.lit(30)).alias("closeTime"))
    last = F.max_by(times, F.struct(*LINE_ORDER.split(", "))).alias("t")
    days = st.table(spark, sf, "lineitem").groupBy("l_orderkey", day.alias("day")).agg(last)
    return days.groupBy("l_orderkey").agg(F.collect_list(F.struct("day", "t.openTime", "t.closeTime")).alias("times"))


@query(
    "HRS1 WIN4",
    f"WITH {LAST_SLOT}, {islands_sql('s', 'slot')} SELECT l_orderkey, string_agg({LABEL} || ' ' || slot, '; ' ORDER BY a) AS hours FROM runs GROUP BY l_orderkey",
)
def seed_hours_text(spark, sf):
    return _schedules(spark, sf).select("l_orderkey", hrs.seed_hours(F.col("times")).alias("hours"))


TASK_LINES = 250_000


@query(
    "WIN4",
    f"WITH {LAST_SLOT}, {islands_sql('s', 'slot')} SELECT l_orderkey, slot, a AS first_day, b AS last_day FROM runs",
)
def day_run_rows(spark, sf):
    q = F.col("l_quantity").cast("int")
    slot = F.format_string("%02d:00-%02d:30", q % 4 + 6, q % 3 + 18)
    # dealt by order: the last slot of a day and the runs of days are found where the lines are, in tasks of a bounded number of lines
    lines = dealt(st.table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER.split(", ")), "l_orderkey", TASK_LINES)
    days = lines.groupBy("l_orderkey", (F.col("l_linenumber") % 7).alias("day"))
    return dedup.day_run_table(days.agg(F.max_by(slot, F.struct(*LINE_ORDER.split(", "))).alias("slot")), ["l_orderkey"])


FROM_S, TO_S = "(CAST(l_quantity AS INT) % 4 + 6) * 3600", "CASE WHEN CAST(l_quantity AS INT) % 5 = 0 THEN 86400 ELSE (CAST(l_quantity AS INT) % 3 + 18) * 3600 + 1800 END"


def hm(x: str) -> str:
    return f"lpad(CAST(CAST(FLOOR(({x}) / 3600) AS INT) AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(FLOOR((({x}) % 3600) / 60) AS INT) AS VARCHAR), 2, '0')"


@query(
    "HRS2 PRJ23",
    f"WITH e AS (SELECT l_orderkey, l_returnflag, min(rn) AS first_rn, arg_min({hm(FROM_S)} || '-' || {hm(TO_S)}, rn) AS rng FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS rn FROM lineitem) GROUP BY 1, 2), "
    "d AS (SELECT DISTINCT l_orderkey, l_returnflag, l_linenumber % 7 AS day FROM lineitem), "
    "i AS (SELECT *, day - row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY day) AS g FROM d), "
    "runs AS (SELECT l_orderkey, l_returnflag, min(day) AS a, max(day) AS b FROM i GROUP BY l_orderkey, l_returnflag, g), "
    f"t AS (SELECT l_orderkey, l_returnflag, string_agg({LABEL}, ',' ORDER BY a) AS days FROM runs GROUP BY 1, 2) "
    "SELECT l_orderkey, string_agg(days || ' ' || rng, '; ' ORDER BY first_rn) AS hours FROM t JOIN e USING (l_orderkey, l_returnflag) GROUP BY l_orderkey",
)
def weekly_hours_text(spark, sf):
    """One weekly entry per return flag, in order of first appearance."""
    q = F.col("l_quantity").cast("int")
    closing = F.when(q % 5 == 0, 86400).otherwise((q % 3 + 18) * 3600 + 1800)
    order = F.struct(*LINE_ORDER.split(", "))
    names = F.array(*[F.lit(d) for d in hrs.UPPER_DAYS])
    rows = st.table(spark, sf, "lineitem").withColumn("o", order)
    rng = F.struct(((q % 4 + 6) * 3600).alias("from"), closing.alias("to"))
    entries = rows.groupBy("l_orderkey", "l_returnflag").agg(
        F.min("o").alias("first"),
        F.collect_set(F.get(names, F.col("l_linenumber") % 7)).alias("day"),
        F.array(F.min_by(rng, F.col("o"))).alias("timeRange"),
    )
    weekly = entries.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("first", "day", "timeRange"))).alias("weekly"))
    return weekly.select("l_orderkey", hrs.weekly_hours(F.col("weekly")).alias("hours"))


RESULT_DAYS = ["Montag", "Tuesday", "Mittwoch", "Feiertag", "Freitag"]
RESULT_RANGES = ["07:00–22:00", "9:00 - 12:00", "10 AM–10 PM", "closed"]


def _json_hours() -> str:
    day = st.choose("p_partkey % 5", RESULT_DAYS)
    first, second = (st.choose(f"(p_partkey + {i}) % 4", RESULT_RANGES) for i in (0, 1))
    return (
        "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 = 1 THEN 'not json' ELSE "
        f"'{{\"' || {day} || '\":[\"' || {first} || '\",\"' || {second} || '\"],\"Sunday\":[\"' || {second} || '\"]}}' END AS open_hours"
    )


RESULT = [
    "CASE WHEN p_partkey % 12 <> 0 THEN 'tk_' || CAST(p_partkey AS STRING) ELSE '' END AS input_id",
    "p_partkey AS ord",
    "p_name AS title",
    "CASE WHEN p_partkey % 8 = 0 THEN '' WHEN p_partkey % 8 = 1 THEN 'x' ELSE '50.25' END AS latitude",
    "'8.5' AS longitude",
    "'' AS place_id",
    "'c' || CAST(p_partkey AS STRING) AS cid",
    "CASE WHEN p_partkey % 9 = 2 THEN 'broken [' ELSE '[{\"name\":\"Other\",\"options\":[]},{\"name\":\"Zahlungen\",\"options\":[{\"name\":\"' || "
    + st.choose("p_partkey % 6", ["Debitkarten", "Kreditkarten", "Apple Pay", "NFC", "Nur Bargeld", "EC-Karte"])
    + " || '\",\"enabled\":' || CASE WHEN p_partkey % 4 = 0 THEN 'false' ELSE 'true' END || '},{\"name\":\"' || "
    + st.choose("FLOOR(p_partkey / 6) % 5", ["Credit cards", "Kontaktlos", "Google Pay", "Cash", "Schecks"])
    + " || '\",\"enabled\":' || CASE WHEN p_partkey % 3 = 0 THEN 'false' ELSE 'true' END || '}]}]' END AS about",
    _json_hours(),
]


def _results(spark, sf):
    return readers.parse_result_cells(st.table(spark, sf, "part").selectExpr(*RESULT))


def good_range(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]{{1,2}}:[0-9]{{2}}\\s*[-–]\\s*[0-9]{{1,2}}:[0-9]{{2}}') THEN replace(regexp_replace({x}, '\\s+', '', 'g'), '–', '-') END"


R1, R2 = (good_range(st.choose(f"(p_partkey + {i}) % 4", RESULT_RANGES)) for i in (0, 1))
OSM_DAY = st.choose("p_partkey % 5", ["Mo", "Tu", "We", None, "Fr"])
HOURS_RESULT_SQL = (
    "CASE WHEN p_partkey % 9 > 1 THEN NULLIF(concat_ws('; ', "
    f"{OSM_DAY} || ' ' || NULLIF(concat_ws(',', {R1}, {R2}), ''), 'Su ' || ({R2})), '') END"
)


@query(
    "HRS3 SRC5",
    f"SELECT NULLIF('tk_' || CASE WHEN p_partkey % 12 <> 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END, 'tk_') AS feature_id, p_partkey AS ord, "
    f"CASE WHEN p_partkey % 8 > 1 THEN 50.25 END AS lat, CAST(NULL AS VARCHAR) AS place_id, {HOURS_RESULT_SQL} AS hours FROM part",
)
def result_hours(spark, sf):
    return _results(spark, sf).select("feature_id", "ord", "lat", "place_id", hrs.day_map_hours(F.col("open_hours")).alias("hours"))


FIRST = st.choose("p_partkey % 6", ["girocard", "cards", "wallet", "contactless", "cash", "girocard"])
SECOND = st.choose("FLOOR(p_partkey / 6) % 5", ["cards", "contactless", "wallet", "cash", None])
ABOUT_CTE = (
    f"o AS (SELECT p_partkey AS ord, p_partkey % 9 <> 2 AS readable, {FIRST} AS l1, CASE WHEN p_partkey % 4 = 0 THEN 'no' ELSE 'yes' END AS v1, "
    f"{SECOND} AS l2, CASE WHEN p_partkey % 3 = 0 THEN 'no' ELSE 'yes' END AS v2 FROM part), "
    "p1 AS (SELECT *, CASE WHEN l1 = 'cash' THEN v1 END AS cash1, CASE WHEN l1 = 'cards' THEN v1 WHEN l1 = 'girocard' AND v1 = 'yes' THEN 'yes' END AS cards1, "
    "CASE WHEN l1 = 'contactless' THEN v1 WHEN l1 = 'wallet' AND v1 = 'yes' THEN 'yes' END AS contactless1, CASE WHEN l1 = 'girocard' THEN v1 END AS girocard1 FROM o)"
)


@query(
    "PRJ21",
    f"WITH {ABOUT_CTE} SELECT ord, CASE WHEN readable THEN CASE WHEN l2 = 'cash' THEN v2 ELSE cash1 END END AS cash, "
    "CASE WHEN readable THEN CASE WHEN l2 = 'cards' THEN v2 ELSE cards1 END END AS cards, "
    "CASE WHEN readable THEN CASE WHEN l2 = 'contactless' THEN v2 WHEN l2 = 'wallet' AND v2 = 'yes' THEN 'yes' ELSE contactless1 END END AS contactless, "
    "CASE WHEN readable THEN girocard1 END AS girocard FROM p1",
)
def result_payment(spark, sf):
    out = _results(spark, sf).select("ord", pay.about_to_payment(F.col("about")).alias("payment"))
    return out.select("ord", *st.payment_columns())


# Archived pages: the amenity block and the hours block are derived from the page id.
WALLET_ON = "page_id % 3 = 0"
TERMINAL = "CASE page_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END"
PAGE_BLOCK = (
    "CASE WHEN page_id % 11 = 0 THEN '' WHEN page_id % 11 = 1 THEN '\"amenityV2\":[{broken' ELSE '\"amenityV2\":[' || "
    "CASE WHEN page_id % 2 = 0 THEN '{\"amenityPresent\":' || " + TERMINAL.replace("END", "ELSE 'null' END")
    + " || ',\"amenityId\":\"crossbusiness.payments.contactless_pay\"},' ELSE '' END || '{\"amenityPresent\":' || CASE WHEN " + WALLET_ON
    + " THEN 'true' ELSE 'false' END || ',\"amenityId\":\"crossbusiness.payments.applepay\"}' || CASE WHEN page_id % 2 = 1 THEN ',{\"amenityPresent\":' || "
    + TERMINAL.replace("END", "ELSE 'null' END") + " || ',\"amenityId\":\"crossbusiness.payments.contactless_pay\"}' ELSE '' END || '] tail' END"
)
PAGE_HOURS = (
    "'\"businessHours\":{\"weeklyHours\":[{\"day\":[\"MONDAY\",\"TUESDAY\",\"SUNDAY\"],\"timeRange\":[{\"from\":' || CAST((page_id % 5 + 6) * 3600 AS STRING) "
    "|| ',\"to\":86400}]}]} rest'"
)


def _pages(spark, sf):
    return st.table(spark, sf, "pages").selectExpr("page_id", f"html || {PAGE_BLOCK} || html || {PAGE_HOURS} AS html")


PAGE_READ = "page_id % 11 > 1"
T_VALUE = "CASE page_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END"


@query(
    "PRJ20 PRJ22",
    f"SELECT page_id, CASE WHEN {PAGE_READ} THEN coalesce({T_VALUE}, CASE WHEN {WALLET_ON} THEN 'yes' END) END AS contactless, "
    f"CASE WHEN {PAGE_READ} AND ({WALLET_ON} OR page_id % 4 = 0) THEN 'yes' END AS cards, "
    "'Mo-Tu,Su ' || lpad(CAST(page_id % 5 + 6 AS VARCHAR), 2, '0') || ':00-24:00' AS hours FROM pages",
)
def page_facts(spark, sf):
    p = _pages(spark, sf).select(
        "page_id",
        pay.amenities_to_payment(pay.page_amenities(F.col("html"))).alias("payment"),
        hrs.weekly_hours(pay.page_weekly_hours(F.col("html"))).alias("hours"),
    )
    return p.select("page_id", F.col("payment.contactless").alias("contactless"), F.col("payment.cards").alias("cards"), "hours")


# Merges. Local row and fresh element share the part key.
PAIR = f"{FT}, {EL}, m AS (SELECT ft.*, el.type, el.version, el.k AS ek, " + ", ".join(
    f"{expr} AS f_{name}"
    for name, expr in {
        "name": "el.name",
        "street": "el.street",
        "number": "el.housenumber",
        "city": "el.city",
        "postalcode": PLZ_SQL.replace("postcode", "el.postcode"),
        "district": DISTRICT_SQL.replace("suburb", "el.suburb").replace("neighbourhood", "el.neighbourhood"),
        "hours": HOURS_SQL,
        "kind": KIND_SQL,
        **{key: value for key, value in BLOCK_SQL.items()},
        "tags": "[" + ", ".join(TAG_SQL) + "]",
    }.items()
) + f", el.shop FROM ft JOIN el ON ft.k = el.k WHERE {LOCATED.replace('lat,', 'el.lat,').replace('lng,', 'el.lng,')} AND el.name IS NOT NULL)"

# Local stamps per path; paths without a stamp column are unstamped.
ALL_PATHS = ["name", "description", "hours", *[f"address.{a}" for a in schema.ADDRESS_KEYS], *[f"payment.{p}" for p in schema.PAYMENT_KEYS]]


def _takes(local: str, fresh: str, stamp: str | None) -> str:
    rank = st.rank_sql(stamp) if stamp else "2"
    return f"({local} IS NOT NULL AND ({fresh} IS NULL OR ({rank}) > 2))"


def _refresh_sql() -> str:
    columns, stamps = {}, {}
    for path in ALL_PATHS:
        key = path.split(".")[-1]
        stamp = FT_STAMPS.get(path)
        local = f"NULLIF({key}, '')" if "." in path else key
        fresh = "NULL" if path == "description" else f"f_{key}"
        take = _takes(local, fresh, stamp)
        columns[key] = f"CASE WHEN {take} THEN {key} ELSE {fresh} END"
        own = stamp or "CAST(NULL AS VARCHAR)"
        stamps[path] = f"CASE WHEN {take} THEN coalesce({own}, CASE WHEN {fresh} IS NOT NULL THEN 'osm' END) WHEN {fresh} IS NOT NULL THEN 'osm' END"
    select = ", ".join(f"{value} AS {name}" for name, value in columns.items())
    ref = "CASE WHEN type = 'node' THEN 'node/' ELSE 'way/' END || k"
    local_sources = st.FEATURE_SOURCES_SQL.replace("|| ':1'", "|| ':1'")
    keep = f"list_filter({local_sources}, lambda s: NOT (s = 'osm:' || {ref} || ':1'))"
    sources = f"array_to_string(['osm:' || {ref} || ':' || coalesce(version, 0)] || {keep}, ',')"
    tags = "NULLIF(array_to_string(list_sort(list_distinct(list_filter([tag_a, tag_b] || f_tags, lambda x: x IS NOT NULL))), ','), '')"
    return (
        f"WITH {PAIR} SELECT k, {select}, {tags} AS tags, {sources} AS sources, {st.joined_sql(stamps)} AS stamps, f_kind AS kind, "
        f"coalesce(created, '{st.AS_OF}') AS created, '{st.AS_OF}' AS updated, apple_attempted, google_attempted FROM m"
    )


def merge_inputs(spark, sf):
    """Local feature and fresh feature of one part key, side by side (k, local, fresh)."""
    local = st.features(spark, sf)
    elements = refresh.located(st.elements(spark, sf)).filter(rules.tag(F.col("tags"), "name").isNotNull())
    shaped = elements.withColumnsRenamed({"tags": "element_tags", "id": "number"})
    fresh = shaped.select("k", *[c.alias(n) for n, c in refresh.feature_columns(F.col("prefix"), st.AS_OF).items()])
    row = F.struct(*schema.FEATURE_COLUMNS)
    return local.select("k", row.alias("local")).join(fresh.select("k", row.alias("fresh")), "k")


@query("MRG1 SET1 SET2", _refresh_sql())
def refreshed_features(spark, sf):
    joined = merge_inputs(spark, sf)
    merged = joined.select("k", *[c.alias(n) for n, c in merge.refresh(F.col("local"), F.col("fresh")).items()])
    return st.flat(
        merged, "k", "name", "description", "hours", "address", "payment", "tags", "sources", "stamps", "kind", "created", "updated",
        "apple_attempted", "google_attempted",
    )


def _can(stamp: str | None) -> str:
    return f"(2 >= {st.rank_sql(stamp)})" if stamp else "true"


def _backfill_sql() -> str:
    oh = "f_hours"
    allowed = f"({oh} IS NOT NULL AND {_can('st_hours')})"
    columns = {"hours": f"CASE WHEN {allowed} THEN {oh} ELSE hours END"}
    stamps = {"hours": f"CASE WHEN {allowed} THEN 'osm' ELSE st_hours END", "name": "st_name"}
    counts = {"hours_written": f"CAST({allowed} AND coalesce(hours, '') <> {oh} AS INT)"}
    writes = []
    offers = {"cash": PAY_SQL["cash"], "cards": PAY_SQL["cards"], "girocard": PAY_SQL["girocard"], "contactless": PAY_SQL["contactless"]}
    for key, offer in offers.items():
        stamp = FT_STAMPS.get(f"payment.{key}")
        write = (
            f"(coalesce(e_{key}, 'unknown') <> 'unknown' AND (coalesce({key}, 'unknown') = 'unknown' OR ({key} <> e_{key} AND {_can(stamp)})))"
        )
        columns[key] = f"CASE WHEN {write} THEN e_{key} ELSE {key} END"
        stamps[f"payment.{key}"] = f"CASE WHEN {write} THEN 'osm' ELSE {stamp or 'NULL'} END"
    # The wallet writes contactless once more, after the plain tag.
    plain = "(coalesce(e_plain, 'unknown') <> 'unknown' AND (coalesce(contactless, 'unknown') = 'unknown' OR contactless <> e_plain))"
    wallet = f"(e_wallet AND coalesce(CASE WHEN {plain} THEN e_plain ELSE contactless END, 'unknown') <> 'yes')"
    columns["contactless"] = f"CASE WHEN {wallet} THEN 'yes' WHEN {plain} THEN e_plain ELSE contactless END"
    stamps["payment.contactless"] = f"CASE WHEN {wallet} OR {plain} THEN 'osm' END"
    for key in schema.ADDRESS_KEYS:
        stamp = FT_STAMPS.get(f"address.{key}")
        write = f"(coalesce(f_{key}, '') <> '' AND (coalesce({key}, '') = '' OR ({key} <> f_{key} AND {_can(stamp)})))"
        columns[key] = f"CASE WHEN {write} THEN f_{key} ELSE {key} END"
        stamps[f"address.{key}"] = f"CASE WHEN {write} THEN 'osm' ELSE {stamp or 'NULL'} END"
        writes.append(f"CAST({write} AS INT)")
    counts["address_written"] = " + ".join(writes)
    counts["tags_written"] = "len(list_filter(f_tags, lambda x: x IS NOT NULL AND x <> coalesce(tag_a, '') AND x <> coalesce(tag_b, '')))"
    extra = ", ".join(f"({offer}) AS e_{key}" for key, offer in offers.items())
    extra += f", ({tri('pay_contactless')}) AS e_plain, {WALLET} AS e_wallet"
    pair = PAIR.replace(", el.shop FROM", f", el.shop, {extra} FROM")
    select = ", ".join(f"{v} AS {n}" for n, v in {**columns, **counts}.items())
    ref = "CASE WHEN type = 'node' THEN 'node/' ELSE 'way/' END || k"
    sources = f"array_to_string({st.FEATURE_SOURCES_SQL} || ['osm:' || {ref} || ':' || coalesce(version, 0)], ',')"
    tags = "NULLIF(array_to_string(list_sort(list_distinct(list_filter([tag_a, tag_b] || f_tags, lambda x: x IS NOT NULL))), ','), '')"
    return f"WITH {pair} SELECT k, {select}, {tags} AS tags, {sources} AS sources, {st.joined_sql(stamps)} AS stamps FROM m"


@query("MRG2", _backfill_sql())
def backfilled_features(spark, sf):
    elements = refresh.located(st.elements(spark, sf)).filter(rules.tag(F.col("tags"), "name").isNotNull())
    detail = elements.select("k", F.col("tags").alias("c_tags"), F.col("type").alias("c_type"), "version")
    joined = st.features(spark, sf).join(detail, "k")
    changes, counts = merge.backfill(F.col("c_tags"), F.col("c_type"), F.col("k"), F.col("version"), st.AS_OF)
    out = joined.select(
        "k",
        *[changes[c].alias(c) if c in changes else F.col(c) for c in schema.FEATURE_COLUMNS],
        *[counts[c].alias(c) for c in ("hours_written", "address_written", "tags_written")],
    )
    return st.flat(out, "k", "hours", "payment", "address", "tags", "sources", "stamps", "hours_written", "address_written", "tags_written")


G_PAY = {"cash": "CASE WHEN l2 = 'cash' THEN v2 ELSE cash1 END", "cards": "CASE WHEN l2 = 'cards' THEN v2 ELSE cards1 END",
         "contactless": "CASE WHEN l2 = 'contactless' THEN v2 WHEN l2 = 'wallet' AND v2 = 'yes' THEN 'yes' ELSE contactless1 END",
         "girocard": "girocard1"}


def _google_sql() -> str:
    columns, stamps, writes = {}, {"name": "st_name", "address.street": "st_street"}, []
    for key in schema.PAYMENT_KEYS:
        stamp = FT_STAMPS.get(f"payment.{key}")
        rank = f"(4 >= {st.rank_sql(stamp)})" if stamp else "true"
        write = f"(g_{key} IS NOT NULL AND (coalesce({key}, 'unknown') = 'unknown' OR ({key} <> g_{key} AND {rank})))"
        columns[key] = f"CASE WHEN {write} THEN g_{key} ELSE {key} END"
        stamps[f"payment.{key}"] = f"CASE WHEN {write} THEN 'google' ELSE {stamp or 'NULL'} END"
        writes.append(f"CAST({write} AS INT)")
    allowed = f"(g_hours IS NOT NULL AND 4 >= {st.rank_sql('st_hours')})"
    columns["hours"] = f"CASE WHEN {allowed} THEN g_hours ELSE hours END"
    stamps["hours"] = f"CASE WHEN {allowed} THEN 'google' ELSE st_hours END"
    facts = ", ".join(f"CASE WHEN readable THEN {v} END AS g_{k}" for k, v in G_PAY.items())
    hours = f"h AS (SELECT p_partkey AS ord, {HOURS_RESULT_SQL} AS g_hours FROM part)"
    select = ", ".join(f"{v} AS {n}" for n, v in columns.items())
    return (
        f"WITH {FT}, {ABOUT_CTE}, {hours}, g AS (SELECT ord AS gk, {facts} FROM p1), m AS (SELECT * FROM ft JOIN g ON gk = k JOIN h ON h.ord = k) "
        f"SELECT k, {select}, {' + '.join(writes)} AS writes, CAST({allowed} AND coalesce(hours, '') <> g_hours AS INT) AS hours_written, {st.joined_sql(stamps)} AS stamps FROM m"
    )


@query("MRG3 MRG4", _google_sql())
def merged_results(spark, sf):
    facts = _results(spark, sf).select(
        F.col("ord").alias("k"), pay.about_to_payment(F.col("about")).alias("g"), hrs.day_map_hours(F.col("open_hours")).alias("g_hours")
    )
    joined = st.features(spark, sf).join(facts, "k")
    own = F.col("sources_by_field")
    block, payment_stamps, writes = pay.merge_payment(F.col("payment"), F.col("g"), own, "google")
    hours, hours_stamps, changed = pay.merge_hours(F.col("hours"), F.col("g_hours"), own, "google")
    stamps = prov.put_stamps(own, payment_stamps | hours_stamps)
    out = joined.select(
        "k", block.alias("payment"), hours.alias("hours"), stamps.alias("sources_by_field"), writes.alias("writes"), changed.cast("int").alias("hours_written")
    )
    return st.flat(out, "k", "payment", "hours", "writes", "hours_written", "stamps")


@query(
    "MRG6",
    f"WITH {FT}, h AS (SELECT *, k % 3 <> 0 AS hit FROM ft), w AS (SELECT *, hit AND coalesce(street, '') = '' AS w1, hit AND coalesce(number, '') = '' AND k % 4 <> 0 AS w2, "
    "hit AND coalesce(postalcode, '') = '' AS w3 FROM h) SELECT k, CASE WHEN w1 THEN 'Hit ' || (k % 9) ELSE street END AS street, "
    "CASE WHEN w2 THEN CAST(k % 20 AS VARCHAR) ELSE number END AS number, CASE WHEN w3 THEN 'X-1' ELSE postalcode END AS postalcode, "
    f"CASE WHEN w1 OR w2 OR w3 THEN '{st.AS_OF}' ELSE updated END AS updated, "
    + st.joined_sql({**{p: c for p, c in FT_STAMPS.items() if p != "address.street"}, "address.street": "CASE WHEN w1 THEN 'photon' ELSE st_street END",
                     "address.number": "CASE WHEN w2 THEN 'photon' END", "address.postalcode": "CASE WHEN w3 THEN 'photon' END"})
    + " AS stamps FROM w",
)
def geocoded_addresses(spark, sf):
    k = F.col("k")
    none = F.lit(None).cast("string")
    hit = F.struct(
        F.concat(F.lit("Hit "), (k % 9).cast("string")).alias("street"),
        F.when(k % 4 != 0, (k % 20).cast("string")).otherwise("").alias("housenumber"),
        F.lit("X-1").alias("postcode"),
        none.alias("city"),
        none.alias("district"),
    )
    joined = st.features(spark, sf).withColumn("hit", F.when(k % 3 != 0, hit))
    changes = merge.fill_address(F.col("hit"), st.AS_OF)
    out = joined.select("k", *[changes[c].alias(c) if c in changes else F.col(c) for c in schema.FEATURE_COLUMNS])
    return st.flat(out, "k", "address", "updated", "stamps").drop("city", "district")


@query(
    "MRG7 MRG13 PRJ18",
    f"WITH {FT}, s AS (SELECT k, {st.FEATURE_SOURCES_SQL} AS src, s_apple, s_osm, CASE WHEN k % 3 = 0 THEN 'node/' ELSE 'way/' END || k AS own FROM ft), "
    "t AS (SELECT *, CASE k % 4 WHEN 0 THEN 'node/' || k WHEN 1 THEN 'way/' || k WHEN 2 THEN 'relation/' || k ELSE 'area/' || k END AS ref FROM s) "
    "SELECT k, array_to_string(CASE WHEN s_apple THEN list_transform(src, lambda x: CASE WHEN x LIKE 'apple:%' THEN 'apple:new' ELSE x END) ELSE src || ['apple:new'] END, ',') AS upserted, "
    "array_to_string(CASE WHEN k % 4 = 3 OR (s_osm AND ref = own) THEN src ELSE src || ['osm:' || ref] END, ',') AS confirmed FROM t",
)
def source_entries(spark, sf):
    k = F.col("k")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("node/", "way/", "relation/", "area/")]), (k % 4).cast("int") + 1)
    f = st.features(spark, sf).withColumn("refs", F.array(F.concat(kinds, k.cast("string"))))
    return f.select(
        "k",
        st.sources_text(prov.upsert_source(F.col("sources"), "apple", F.lit("new"))).alias("upserted"),
        st.sources_text(merge.confirm_sources(F.col("refs"), st.AS_OF)["sources"]).alias("confirmed"),
    )


def _absorb_sql() -> str:
    columns, stamps = {}, {}
    name = (
        "CASE WHEN trim(o.name) = '' THEN trim(s.name) WHEN trim(s.name) = '' OR abs(length(trim(o.name)) - length(trim(s.name))) <= 4 "
        "OR length(trim(s.name)) <= length(trim(o.name)) THEN trim(o.name) ELSE trim(s.name) END"
    )
    columns["name"] = name
    stamps["name"] = f"CASE WHEN ({name}) <> o.name AND ({name}) = s.name THEN 'hopfenstop' ELSE o.st_name END"
    for path in ("description", "hours", *[f"address.{a}" for a in schema.ADDRESS_KEYS], *[f"payment.{p}" for p in schema.PAYMENT_KEYS]):
        key = path.split(".")[-1]
        own = f"o.{FT_STAMPS[path]}" if path in FT_STAMPS else "NULL"
        blank = f"coalesce(o.{key}, '') IN ('', 'unknown')" if path.startswith("payment") else f"coalesce(o.{key}, '') = ''"
        good = f"coalesce(s.{key}, '') NOT IN ('', 'unknown')" if path.startswith("payment") else f"coalesce(s.{key}, '') <> ''"
        columns[key] = f"CASE WHEN {blank} AND {good} THEN s.{key} ELSE o.{key} END"
        stamps[path] = f"CASE WHEN {blank} AND {good} THEN 'hopfenstop' ELSE {own} END"
    select = ", ".join(f"{v} AS {n}" for n, v in columns.items())
    src = st.FEATURE_SOURCES_SQL
    def qualified(alias: str) -> str:
        out = src
        for c in ("s_seed", "s_osm", "s_apple", "gmaps_id"):
            out = out.replace(c, f"{alias}.{c}")
        return out.replace("|| k", f"|| {alias}.k").replace("WHEN k %", f"WHEN {alias}.k %")
    sources = f"array_to_string({qualified('o')} || list_filter({qualified('s')}, lambda x: NOT list_contains({qualified('o')}, x)), ',')"
    tags = "array_to_string(list_sort(list_distinct(list_filter([o.tag_a, o.tag_b, s.tag_a, s.tag_b], lambda x: x IS NOT NULL))), ',')"
    return f"WITH {FT} SELECT o.k, {select}, {tags} AS tags, {sources} AS sources, {st.joined_sql(stamps)} AS stamps FROM ft o JOIN ft s ON s.k = o.k + 1 WHERE o.k % 2 = 0"


@query("MRG5 PRJ15", _absorb_sql())
def absorbed_features(spark, sf):
    f = st.features(spark, sf)
    row = F.struct(*schema.FEATURE_COLUMNS)
    kept = f.filter("k % 2 = 0").select("k", row.alias("kept"))
    gone = f.filter("k % 2 = 1").select((F.col("k") - 1).alias("k"), row.alias("gone"))
    changes = merge.absorb(F.col("kept"), F.col("gone"), st.AS_OF)
    out = kept.join(gone, "k").select("k", *[c.alias(n) for n, c in changes.items()])
    return st.flat(out, "k", "name", "description", "hours", "address", "payment", "tags", "sources", "stamps")


@query(
    "MRG9 SET1",
    f"WITH {FT} SELECT k, array_to_string({st.FEATURE_SOURCES_SQL} || CASE WHEN k % 3 = 0 THEN ['osm:node/' || k, 'osm:way/' || (k + 1)] ELSE [] END, ',') AS sources, "
    "CASE WHEN k % 3 = 0 THEN array_to_string(list_sort(list_distinct(list_filter([tag_a, tag_b, 'wc', 'eis'], lambda x: x IS NOT NULL))), ',') "
    "ELSE NULLIF(array_to_string(list_sort(list_filter([tag_a, tag_b], lambda x: x IS NOT NULL)), ','), '') END AS tags, "
    f"CASE WHEN k % 3 = 0 THEN '{st.AS_OF}' ELSE updated END AS updated FROM ft",
)
def linked_features(spark, sf):
    k = F.col("k")
    ids = F.array(F.concat(F.lit("node/"), k.cast("string")), F.concat(F.lit("way/"), (k + 1).cast("string")))
    f = st.features(spark, sf).withColumn("ids", F.when(k % 3 == 0, ids))
    changes = merge.link_sources(F.col("ids"), F.array(F.lit("wc"), F.lit("eis")), F.lit(st.AS_OF))
    out = f.select("k", *[changes[c].alias(c) if c in changes else F.col(c) for c in schema.FEATURE_COLUMNS])
    return st.flat(out, "k", "sources", "tags", "updated")


@query(
    "MRG11 PRJ6",
    f"WITH {FT}, b AS (SELECT *, coalesce(hours, '') <> '' AND ({clean_hours_sql('hours')}) IS NULL AS bad FROM ft) "
    "SELECT k, CASE WHEN NOT bad THEN hours END AS hours, "
    + st.joined_sql({**FT_STAMPS, "hours": "CASE WHEN NOT bad THEN st_hours END"})
    + " AS stamps FROM b",
)
def features_without_degenerate_hours(spark, sf):
    f = st.features(spark, sf)
    cleaned, _ = seed.clean_hours(f)
    return st.flat(cleaned.withColumn("k", F.col("ord")), "k", "hours", "stamps")


@query(
    "AGG15",
    f"WITH {FT}, b AS (SELECT region, id, ord, hours FROM ft WHERE coalesce(hours, '') <> '' AND ({clean_hours_sql('hours')}) IS NULL) "
    "SELECT region, count(*) AS n, array_to_string(list_slice(list(id || ': \"' || hours || '\"' ORDER BY ord), 1, 3), ' | ') AS examples FROM b GROUP BY region",
)
def cleaned_hours_report(spark, sf):
    _, report = seed.clean_hours(st.features(spark, sf))
    return report.select("region", "n", F.array_join("examples", " | ").alias("examples"))


# Attribution: the seed record of a feature repeats some of its values.
UP = "u AS (SELECT *, CASE WHEN k % 2 = 0 THEN name ELSE 'other' END AS u_name, CASE WHEN k % 3 <> 0 THEN description ELSE '' END AS u_desc, street AS u_street, number AS u_number FROM ft WHERE s_seed AND k % 5 <> 4)"
STAMP_NEW = {
    "name": ("st_name", "name", "u_name"),
    "description": (None, "description", "u_desc"),
    "address.street": ("st_street", "street", "u_street"),
    "address.number": (None, "number", "u_number"),
}


def _stamped(stamp: str | None, ours: str, theirs: str) -> str:
    return f"(coalesce({stamp or 'NULL'}, '') = '' AND coalesce({ours}, '') <> '' AND {ours} = {theirs})"


@query(
    "JN11 MRG10",
    f"WITH {FT}, {UP}, j AS (SELECT ft.*, u.u_name, u.u_desc, u.u_street, u.u_number FROM ft LEFT JOIN u ON u.k = ft.k) SELECT k, "
    + st.joined_sql({**FT_STAMPS, **{p: f"CASE WHEN {_stamped(s, o, t)} THEN 'hopfenstop' ELSE {s or 'NULL'} END" for p, (s, o, t) in STAMP_NEW.items()}})
    + " AS stamps FROM j",
)
def attributed_features(spark, sf):
    f = st.features(spark, sf)
    return st.flat(merge.attribute_seed(f.drop("k"), _seed_records(f)).withColumn("k", F.col("ord")), "k", "stamps")


def _seed_records(f):
    k = F.col("k")
    none = F.lit(None).cast("string")
    src = f.filter(prov.has_source(F.col("sources"), "hopfenstop") & (k % 5 != 4))
    return src.select(
        F.concat(F.lit("h"), k.cast("string")).alias("kioskId"),
        F.when(k % 2 == 0, F.col("name")).otherwise("other").alias("name"),
        F.when(k % 3 != 0, F.col("description")).otherwise("").alias("description"),
        F.struct("address.street", "address.number", none.alias("city"), none.alias("postalcode"), none.alias("district"), none.alias("geolat"), none.alias("geolng")).alias("address"),
        F.lit(None).cast("array<struct<day:string,openTime:array<int>,closeTime:array<int>>>").alias("kioskTimes"),
        F.lit(None).cast("array<struct<tag:string,tagVotes:struct<totalVotes:int>>>").alias("kioskTags"),
    )


@query(
    "AGG9",
    f"WITH {FT}, {UP}, j AS (SELECT ft.*, u.u_name, u.u_desc, u.u_street, u.u_number FROM ft JOIN u ON u.k = ft.k), p AS ("
    + " UNION ALL ".join(f"SELECT region, '{path}' AS path FROM j WHERE {_stamped(s, o, t)}" for path, (s, o, t) in STAMP_NEW.items())
    + ") SELECT coalesce(region, '(all)') AS region, coalesce(path, '(all)') AS path, count(*) AS n FROM p GROUP BY ROLLUP (region, path)",
)
def attribution_rollup(spark, sf):
    f = st.features(spark, sf)
    return seed.attribution_counts(merge.attribute_seed(f.drop("k"), _seed_records(f)))


@query("AGG9", "SELECT coalesce(lang, '(all)') AS lang, coalesce(source, '(all)') AS source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def rolled_up_documents(spark, sf):
    return stats.rolled_up_counts(st.table(spark, sf, "documents"), ["lang", "source"])
