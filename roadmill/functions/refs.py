"""Highway and exit references and directions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- highway references

#: Managed lanes and compass words that may follow an Interstate's number.
LANE_SUFFIXES = ("EXPR", "Express", "HOV", "TEXpress", "Flex", "Local", "North", "South", "East", "West")
#: State routes that are Interstates in fact.
STATE_ALIASES = {"CA-210": "I-210", "VA-164": "I-164"}
#: Fixed value: the Interstates that are exported.
EXPORT_FILTER = r"^(?:I-?[0-9]+|I-?35[EW]|I-?69[CEW])$"
#: Suffixed Interstates that count as their base in coverage.
SUFFIX_ALIASES = {
    "I-35E": "I-35", "I-35W": "I-35", "I-69C": "I-69", "I-69E": "I-69", "I-69W": "I-69", "I-80E": "I-80", "I-80W": "I-80", "I-80U": "I-80",
    "I-480N": "I-480",
}

_INTERSTATE = rf"^[Ii][- ]*([0-9]+[A-Za-z]?)(?i: (?:{'|'.join(LANE_SUFFIXES)}))?$"
_US = r"^[Uu][Ss][- ]*([0-9]+[A-Za-z]?)$"
_STATE = r"^([A-Za-z]{2})[- ]*([0-9]+[A-Za-z]?)\s*((?i:toll))?$"


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def is_interstate(ref: Column) -> Column:
    return ref.rlike(_INTERSTATE)


def normalize_highway_ref(raw: Column) -> Column:
    """I-95 from I 95, US-1 from US1, NC-40 from NC 40, a state's toll route with " Toll"; other text as it is with
    white space collapsed; null for blank text."""
    s = collapse(raw)
    state = F.concat(F.upper(F.regexp_extract(s, _STATE, 1)), F.lit("-"), F.upper(F.regexp_extract(s, _STATE, 2)))
    toll = F.regexp_extract(s, _STATE, 3) != ""
    alias = state
    for name, interstate in STATE_ALIASES.items():
        alias = F.when(state == name, interstate).otherwise(alias)
    return (
        F.when(s == "", None)
        .when(s.rlike(_INTERSTATE), F.concat(F.lit("I-"), F.upper(F.regexp_extract(s, _INTERSTATE, 1))))
        .when(s.rlike(_US), F.concat(F.lit("US-"), F.upper(F.regexp_extract(s, _US, 1))))
        .when(s.rlike(_STATE), F.when(toll, F.concat(state, F.lit(" Toll"))).otherwise(alias))
        .otherwise(s)
    )


def split_refs(raw: Column) -> Column:
    """Sorted distinct normalised references of a list with semicolons; empty for null."""
    parts = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ";"), normalize_highway_ref), lambda r: r.isNotNull())
    return F.array_sort(F.array_distinct(parts))


def is_exported(highway: Column) -> Column:
    return F.upper(F.trim(highway)).rlike(EXPORT_FILTER)


def highway_number(highway: Column) -> Column:
    """The number of I-95; 0 for lettered ones, which so sort first."""
    return F.coalesce(F.regexp_extract(highway, r"^I-([0-9]+)$", 1).try_cast("int"), F.lit(0))


def strip_highway_suffix(highway: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, base in SUFFIX_ALIASES.items():
        out = F.when(highway == name, base).otherwise(out)
    return out


def relation_ref(raw: Column) -> Column:
    """I-95 from a route relation's ref, where a bare number will do; else null."""
    found = F.regexp_extract(F.upper(F.trim(raw)), r"^I?[\s-]*(\d+[A-Z]?)$", 1)
    return F.when(found != "", F.concat(F.lit("I-"), found))


# ---------------------------------------------------------------- directions

_WORDS = ("north", "south", "east", "west")


def direction(raw: Column, rich: bool = True) -> Column:
    """north, south, east or west from a word, its bound form or its letter; rich also takes text that starts with
    the word, percent-decoded. Else null."""
    value = F.lower(F.trim(percent_decode(raw) if rich else raw))
    out = F.when(F.lit(False), "")
    for word in _WORDS:
        out = out.when(value.isin(word, word + "bound", word[0]), word)
    if not rich:
        return out
    found = F.regexp_extract(value, r"^(north|south|east|west)(?:bound)?(?:\b|[^a-z])", 1)
    return out.when(found != "", found)


def percent_decode(raw: Column) -> Column:
    """Percent escapes decoded; plus signs stay. Text with a broken escape is left as it is."""
    return F.when(raw.contains("%"), F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)).otherwise(raw)


def flow_role(raw: Column) -> Column:
    found = F.regexp_extract(F.lower(F.trim(percent_decode(raw))), r"^(forward|backward)(?:\b|[^a-z])", 1)
    return F.when(found != "", found)


def title_direction(name: Column, description: Column, axis: Column) -> Column:
    """The one cardinal word in a relation's name and description, if it lies on its axis, an array of words."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(F.concat_ws(" ", name, description), F.lit(r"(?i)\b(north|south|east|west)\b")), F.lower))
    return F.when((F.size(words) == 1) & F.array_contains(axis, F.element_at(words, 1)), F.element_at(words, 1))


def exit_direction(raw: Column) -> Column:
    """west from west, w, wb, and so on; else null."""
    value, out = F.lower(F.trim(F.coalesce(raw, F.lit("")))), F.when(F.lit(False), "")
    for word in ("west", "east", "north", "south"):
        out = out.when(value.isin(word, word[0], word[0] + "b"), word)
    return out


def names_direction(label: Column, word: str) -> Column:
    """Whether a lower-case label says eastbound, east bound or eb, for a word."""
    return label.rlike(rf"(^|[^a-z])({word}bound|{word}\s*bound|{word[0]}b)([^a-z]|$)")


def direction_code(word: Column) -> Column:
    """NB for north and for anything unknown."""
    return F.when(word == "south", "SB").when(word == "east", "EB").when(word == "west", "WB").otherwise("NB")


def direction_label(code: Column) -> Column:
    return F.when(code == "SB", "Southbound").when(code == "EB", "Eastbound").when(code == "WB", "Westbound").otherwise("Northbound")


def cardinal_word(letter: Column) -> Column:
    return F.when(letter == "N", "north").when(letter == "E", "east").when(letter == "S", "south").when(letter == "W", "west")


# ---------------------------------------------------------------- exit references


def base_number(ref: Column) -> Column:
    """100 of 100B: trailing capitals cut, if digits remain; else null."""
    base = F.regexp_replace(ref, "[A-Z]+$", "")
    return F.when(base.rlike("^[0-9]+$"), base)


def semicolon_parts(ref: Column) -> Column:
    return F.filter(F.transform(F.split(ref, ";"), lambda t: F.trim(t)), lambda p: p != "")


def letter_range(ref: Column) -> Column:
    """17A-C to [17A, 17B, 17C], in either order, over five letters at most; else empty."""
    base = F.regexp_extract(ref, "^([0-9]+)", 1)
    rest = F.regexp_replace(ref, "^[0-9]+", "")
    letters = F.filter(F.transform(F.split(rest, "-"), lambda t: F.trim(t)), lambda s: s.rlike("^[A-Z]$"))
    first, last = F.ascii(F.get(letters, F.lit(0))), F.ascii(F.get(letters, F.size(letters) - 1))
    low, high = F.least(first, last), F.greatest(first, last)
    fits = (base != "") & (rest != "") & (F.size(letters) >= 2) & (high - low <= 5)
    return F.when(fits, F.transform(F.sequence(F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(0))), lambda c: F.concat(base, F.char(c)))).otherwise(F.array().cast("array<string>"))


def _with_base(parts: Column, base: Column) -> Column:
    """Parts that start with a digit as they are, others behind the base; dropped if there is none."""
    full = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), p).when(base != "", F.concat(base, p)))
    return F.filter(full, lambda p: p.isNotNull())


def comma_parts(ref: Column) -> Column:
    """11A,B to [11A, 11B]; empty without a comma."""
    parts = F.filter(F.transform(F.split(ref, ","), lambda t: F.trim(t)), lambda p: p != "")
    base = F.regexp_extract(F.trim(F.element_at(F.split(ref, ","), 1)), "^([0-9]*)", 1)
    return F.when(ref.contains(","), _with_base(parts, base)).otherwise(F.array().cast("array<string>"))


_NONE = "array<string>"


def _list(raw: Column, sign: str) -> Column:
    return F.filter(F.transform(F.split(raw, sign), lambda t: F.trim(t)), lambda p: p != "")


def _numbered(parts: Column) -> Column:
    """Two parts or more: each behind the first one's number if it has none itself."""
    base = F.regexp_extract(F.element_at(parts, 1), r"^(\d+)", 1)
    return F.when(F.size(parts) >= 2, _with_base(parts, base)).otherwise(F.array().cast(_NONE))


def expand_truth_ref(raw: Column) -> Column:
    """All single exits that a listed exit may stand for, in the order of the patterns, without the text itself:
    99A&B, 11A,B, 13A/B, 64A;B, 1A-1B, 108A-B, 214AB, 29N, 4A?B, 68A to 1A, 437 I-35W."""
    none = F.array().cast(_NONE)
    ref = F.replace(raw, F.lit("&amp;"), F.lit("&"))
    tight = F.regexp_replace(ref, r"(\d+)\s+([A-Z])", "$1$2")

    def when(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(none)

    slash = _list(ref, "/")
    slash_base = F.regexp_extract(F.element_at(slash, 1), r"^(\d+)", 1)
    dashes = _list(ref, "-")
    low, high = F.least(F.regexp_extract(tight, r"^(\d+)([A-Z])-([A-Z])$", 2), F.regexp_extract(tight, r"^(\d+)([A-Z])-([A-Z])$", 3)), F.greatest(F.regexp_extract(tight, r"^(\d+)([A-Z])-([A-Z])$", 2), F.regexp_extract(tight, r"^(\d+)([A-Z])-([A-Z])$", 3))
    span = F.transform(F.sequence(F.ascii(low), F.ascii(high)), lambda c: F.concat(F.regexp_extract(tight, r"^(\d+)", 1), F.char(c)))
    letters = F.regexp_extract(tight, r"^(\d+)([A-Z]{2,})$", 2)
    each = F.transform(F.filter(F.split(letters, ""), lambda c: c != ""), lambda c: F.concat(F.regexp_extract(tight, r"^(\d+)", 1), c))
    first = F.concat(
        when(tight.contains("&") & ~tight.contains(","), _numbered(_list(tight, "&"))),
        when(ref.contains(","), _numbered(_list(ref, ","))),
        when(ref.contains("/") & (F.size(slash) >= 2) & (F.forall(slash, lambda p: p.rlike(r"^\d")) | (slash_base != "")), _with_base(slash, slash_base)),
        when(ref.contains(";"), _numbered(_list(ref, ";"))),
        when(ref.contains("-") & ~ref.contains(",") & (F.size(dashes) >= 2) & F.forall(dashes, lambda p: p.rlike(r"^\d")), dashes),
        when(tight.rlike(r"^\d+[A-Z]-[A-Z]$") & (F.ascii(high) - F.ascii(low) <= 5), span),
        when((letters != "") & (F.length(letters) <= 4), each),
        when(tight.rlike(r"^\d+[NSEW]$"), F.array(F.regexp_extract(tight, r"^(\d+)", 1))),
    )
    marked = when(ref.contains("?"), _numbered(_list(ref, r"\?")))
    second = F.when(F.size(first) > 0, first).otherwise(marked)
    to = r"(?i)^(\d+[A-Z]?)\s+to\s+(\d+[A-Z]?)$"
    third = F.when((F.size(second) == 0) & ref.rlike(to), F.array(F.regexp_extract(ref, to, 1), F.regexp_extract(ref, to, 2))).otherwise(second)
    lead = r"^(\d+[A-Z]?)\s+\S"
    return F.when((F.size(third) == 0) & ref.rlike(lead), F.array(F.regexp_extract(ref, lead, 1))).otherwise(third)


#: Listed signs with these words are no exits.
NON_EXIT_WORDS = ("rest area", "truck parking", "port of entry", "toward ", "to i-")


def is_non_exit(ref: Column) -> Column:
    out = F.lit(False)
    for word in NON_EXIT_WORDS:
        out = out | F.lower(ref).contains(word)
    return out
