"""Name normalisation, bigram similarity and string clean-up."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Generic words that carry no identity in a kiosk name.
GENERIC_WORDS = ["kiosk", "trinkhalle", "wasserhaeuschen", "spaeti", "spaetkauf", "laden", "shop", "store"]
# German umlauts and their spelled-out form.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}

# Word boundaries with ASCII word characters only; Java's own \b counts accented letters.
WORD_START, WORD_END = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"


def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter plus marks."""
    source, target = [], []
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all(unicodedata.category(mark).startswith("M") for mark in parts[1:]):
            source.append(chr(code))
            target.append(parts[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def whole_words(alternatives: str) -> str:
    return f"{WORD_START}({alternatives}){WORD_END}"


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _unless_ascii(text: Column, changed: Column) -> Column:
    """A change of other letters than ASCII ones; most texts have none and stay as they are."""
    return F.when(_is_ascii(text), text).otherwise(changed)


def strip_accents(text: Column) -> Column:
    return _unless_ascii(text, F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{M}", ""))


def spell_umlauts(text: Column) -> Column:
    spelled_out = text
    for letter, spelled in UMLAUTS.items():
        spelled_out = F.replace(spelled_out, F.lit(letter), F.lit(spelled))
    return _unless_ascii(text, spelled_out)


def _ascii_words(lowered: Column) -> Column:
    return F.trim(F.regexp_replace(lowered, r"[^a-z0-9]+", " "))


# Forms of a lower-case name; words has its ASCII words, which are all that a name in ASCII needs.


def _generic(lowered: Column, words: Column) -> Column:
    return _without_generic(F.when(_is_ascii(lowered), words).otherwise(F.trim(F.regexp_replace(spell_umlauts(lowered), r"[^\p{L}\p{N}]+", " "))))


def _without_generic(text: Column) -> Column:
    named = reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in GENERIC_WORDS])
    rest = F.regexp_replace(text, whole_words("|".join(GENERIC_WORDS)), " ")
    return F.when(named, F.trim(F.regexp_replace(rest, " +", " "))).otherwise(text)


def _folded(lowered: Column, words: Column) -> Column:
    return F.when(_is_ascii(lowered), words).otherwise(_ascii_words(F.replace(strip_accents(lowered), F.lit("ß"), F.lit("ss"))))


def _chain(lowered: Column, words: Column) -> Column:
    return F.when(_is_ascii(lowered), words).otherwise(_ascii_words(spell_umlauts(lowered)))


def _form(name: Column, form) -> Column:
    lowered = F.lower(name)
    return form(lowered, _ascii_words(lowered))


def normalise_name(name: Column) -> Column:
    """Lower case, umlauts spelled out, punctuation and generic words removed."""
    return _form(name, _generic)


def fold_name(name: Column) -> Column:
    """Lower case, accents dropped (so an umlaut becomes its base vowel), ASCII words only."""
    return _form(name, _folded)


def chain_name(name: Column) -> Column:
    return _form(name, _chain)


def spanish_name(name: Column) -> Column:
    return F.lower(strip_accents(name))


def _slug(chain: Column) -> Column:
    return F.replace(chain, F.lit(" "), F.lit("_"))


def tag_slug(label: Column) -> Column:
    return _slug(chain_name(label))


def name_forms(names: DataFrame, name: str, forms: dict[str, str]) -> DataFrame:
    """Adds forms of a name by their column: generic, folded, chain, spanish or slug. What they share is taken once per row."""
    lowered, words = F.col("lowered"), F.col("words")
    made = {
        "generic": _generic(lowered, words),
        "folded": _folded(lowered, words),
        "chain": _chain(lowered, words),
        "spanish": F.when(_is_ascii(F.col(name)), lowered).otherwise(spanish_name(F.col(name))),
        "slug": _slug(_chain(lowered, words)),
    }
    rows = names.withColumn("lowered", F.lower(name)).withColumn("words", _ascii_words(lowered))
    return rows.select(*names.columns, *[made[form].alias(column) for column, form in forms.items()])


# Separators other than the space, in a text whose runs of words between spaces become names.
_MARK = "\x1f"


# All but the space that is no letter or digit; Java takes ten times as long for [^a-z0-9 ] as for the ranges it leaves.
_NO_LETTER, _NO_ASCII_LETTER = r"[^\p{L}\p{N} ]+", r"[\x00-\x1f!-/:-`{-\x{10ffff}]+"


def _marked(letters: Column, separators: str) -> Column:
    """One mark for separators inside a word, none beside a space; spaces stay, so words between them can still be counted."""
    marked = F.regexp_replace(letters, separators, _MARK)
    return F.replace(F.replace(marked, F.lit(" " + _MARK), F.lit(" ")), F.lit(_MARK + " "), F.lit(" "))


def text_forms(rows: DataFrame, text: str) -> DataFrame:
    """Adds generic and folded: a text normalised once, of whose runs of words generic_of_run and folded_of_run make what
    normalise_name and fold_name make of the same runs of the text."""
    lowered = F.col("lowered")
    rows = rows.withColumn("lowered", F.lower(F.col(text)))
    letters = {"generic": spell_umlauts(lowered), "folded": F.replace(strip_accents(lowered), F.lit("ß"), F.lit("ss"))}
    separators = {"generic": _NO_LETTER, "folded": _NO_ASCII_LETTER}
    return rows.withColumns({form: _marked(letters[form], separators[form]) for form in letters}).drop("lowered")


def folded_of_run(run: Column) -> Column:
    spaced = F.trim(F.replace(run, F.lit(_MARK), F.lit(" ")))
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)


def generic_of_run(run: Column) -> Column:
    return _without_generic(folded_of_run(run))


def let(value: Column, body) -> Column:
    """Bind a value once per row for a body that uses it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _codes(text: Column) -> Column:
    """Each bigram as one exact number (two code points packed side by side)."""
    pairs = F.regexp_extract_all(text, F.lit("(?s)(?=(..))."), F.lit(1))
    code = lambda pair: F.ascii(pair).cast("bigint") * F.lit(1 << 21) + F.ascii(F.substring(pair, 2, 1)).cast("bigint")
    return F.coalesce(F.transform(pairs, code), F.array().cast("array<bigint>"))


def bigram_multiset(text: Column) -> Column:
    """Bigrams numbered by occurrence, so that a set overlap equals the multiset overlap; in no order of the text."""

    def numbered(codes: Column) -> Column:
        # equal bigrams stand side by side, so the distance to the first of them is the number of earlier ones
        return F.transform(codes, lambda gram, i: gram + F.lit(1 << 42) * (i + 1 - F.array_position(codes, gram)))

    return let(F.sort_array(_codes(text)), numbered)


def bigram_set(text: Column) -> Column:
    """Distinct bigrams of the text padded with two spaces on either side."""
    return F.array_distinct(_codes(F.concat(F.lit("  "), text, F.lit("  "))))


# The bigram of two padding spaces, present in every padded set.
PADDING_GRAM = 32 * (1 << 21) + 32


def _share_of(left_grams: Column, right_grams: Column) -> Column:
    """overlap_share of two expressions, each worked out once."""
    both = F.struct(left_grams.alias("left"), right_grams.alias("right"))
    return let(both, lambda grams: overlap_share(grams["left"], grams["right"]))


def overlap_share(left_grams: Column, right_grams: Column) -> Column:
    total = F.size(left_grams) + F.size(right_grams)
    shared = F.size(F.array_intersect(left_grams, right_grams))
    return F.when(total == 0, F.lit(0.0)).otherwise(shared * F.lit(2.0) / total)


def dice_multiset(left: Column, right: Column, left_grams: Column | None = None, right_grams: Column | None = None) -> Column:
    """Dice coefficient over bigram multisets; an empty name is similar to nothing."""
    if left_grams is None or right_grams is None:
        left_grams = bigram_multiset(left) if left_grams is None else left_grams
        right_grams = bigram_multiset(right) if right_grams is None else right_grams
        share = _share_of(left_grams, right_grams)
    else:
        share = overlap_share(left_grams, right_grams)
    # without bigrams on one side the share is zero
    return F.when((left == "") | (right == "") | left.isNull() | right.isNull(), F.lit(0.0)).when(left == right, F.lit(1.0)).otherwise(share)


def dice_set(left: Column, right: Column) -> Column:
    """Dice coefficient over padded bigram sets."""
    return _share_of(bigram_set(left), bigram_set(right))


def contains_either_way(left: Column, right: Column) -> Column:
    return (F.length(left) >= 3) & (F.length(right) >= 3) & (F.contains(left, right) | F.contains(right, left))


def pick_name(osm_name: Column, seed_name: Column) -> Column:
    """The longer trimmed name, unless the lengths are within four: then the map name."""
    o, h = F.trim(osm_name), F.trim(seed_name)
    return (
        F.when(o == "", h)
        .when((h == "") | (F.abs(F.length(o) - F.length(h)) <= 4) | (F.length(h) <= F.length(o)), o)
        .otherwise(h)
    )


def clean_string(value: Column) -> Column:
    trimmed = F.trim(value.cast("string"))
    return F.when(trimmed != "", trimmed)


def postcode(value: Column) -> Column:
    return F.when(value.rlike("^[0-9]{5}$"), value)


def has_text(value: Column) -> Column:
    return F.coalesce(value.cast("string") != "", F.lit(False))
