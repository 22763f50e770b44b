"""Text as columns: normal forms, identifiers, parsers of names, predicates. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns whose matches decide results.
SPACES = r"[\p{Z}\t-\r\x85]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(^|[^0-9A-Za-z.])(?:[6-9][0-9]{9}|0[0-9]{10})([^0-9A-Za-z]|$)"
REGISTRATION = r"TGRTI/APP/|/R/20[0-9]{2}/[0-9]{4,}"
SELECT = r"(?is)<select[^>]*(?:name|id)=\"{name}\"[^>]*>(.*?)</select>"
OPTION = r"(?s)<option[^>]*value=\"([^\"]*)\"[^>]*>(.*?)</option>"
QUOTED, INNER_QUOTE = '^"(.*)"$', '(?<=[A-Za-z])"(?=[A-Za-z])'
DEPARTMENT_HEAD, DEPARTMENT_TAIL, EDGE_SIGNS = r"^(DEPARTMENT|DEPT\.?) OF ", r" (DEPARTMENT|DEPT\.?)$", r"^[ .\-]+|[ .\-]+$"
NULL_LIKE = ("NA", "N/A", "NIL", "NONE", "-")
STATE_WITH_TRAILING_GROUP = "KA"


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def normalize_text(c: Column | str) -> Column:
    """Null becomes empty; white space of any kind is trimmed and squeezed to one space."""
    return F.trim(F.regexp_replace(_text(c), SPACES, " "))


def normalize_key(c: Column | str) -> Column:
    """normalize_text in lower case."""
    return F.lower(normalize_text(c))


def match_key(c: Column | str) -> Column:
    """Lower case without anything but ASCII letters and digits."""
    return F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]", "")


def form_key(c: Column | str) -> Column:
    """Lower case, runs of other characters as one space, trimmed: how form headings and labels compare."""
    return F.trim(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]+", " "))


def hash_text(c: Column | str, length: int = 16, algorithm: str = "sha256") -> Column:
    """Prefix of a text's hex digest."""
    text = _text(c)
    digest = {"sha256": lambda: F.sha2(text, 256), "sha1": lambda: F.sha1(text)}[algorithm]()
    return F.substring(digest, 1, length)


def authority_key(*parts: Column | str) -> Column:
    """The normalised key of an office before its occurrence is known."""
    return F.concat_ws("|", *[normalize_key(p) for p in parts])


def authority_id(key: Column, occurrence: Column) -> Column:
    """12 hex digits over the key, with the occurrence from the second on."""
    return hash_text(F.when(occurrence > 1, F.concat(key, F.lit("|occurrence:"), occurrence.cast("string"))).otherwise(key), 12)


def application_id(code: Column, number: Column) -> Column:
    """Code and a number of at least three digits (longer ones stay whole)."""
    return F.format_string("%s-%03d", code, number.cast("long"))


def department_group(office: Column | str, code: str) -> Column:
    """Department read from an office name: its tail in one state, its head elsewhere."""
    raw = _text(office)
    if code == STATE_WITH_TRAILING_GROUP:
        part = F.element_at(F.split(F.element_at(F.split(raw, "-"), -1), ","), -1)
    else:
        part = F.element_at(F.split(raw, r"[(,]"), 1)
    name = normalize_text(F.replace(F.upper(part), F.lit("&"), F.lit(" AND ")))
    name = F.regexp_replace(name, EDGE_SIGNS, "")
    if code == STATE_WITH_TRAILING_GROUP:
        name = F.regexp_replace(name, DEPARTMENT_HEAD, "")
    name = F.regexp_replace(name, DEPARTMENT_TAIL, "")
    return F.when(name == "", F.lit("UNKNOWN")).otherwise(name)


def clean_office_text(c: Column | str) -> Column:
    """Squeezed, without one pair of double quotes around it; a double quote between two letters becomes an apostrophe."""
    return F.regexp_replace(F.regexp_replace(normalize_text(c), QUOTED, "$1"), INNER_QUOTE, "'")


def clean_location(c: Column | str) -> Column:
    """clean_office_text, blank where it only says that nothing is known."""
    text = clean_office_text(c)
    return F.when(F.upper(text).isin(*NULL_LIKE), F.lit("")).otherwise(text)


def is_iso_date(c: Column | str, required: bool = False) -> Column:
    """A real calendar date written YYYY-MM-DD; blank is fine unless required."""
    text = _text(c)
    real = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    return real if required else (text == "") | real


def has_contact_details(c: Column | str) -> Column:
    """An e-mail address or an Indian telephone number. The patterns run only on texts with a sign @ or ten digits in a row, which every match has."""
    text = _text(c)
    return (text.contains("@") & text.rlike(EMAIL)) | (text.rlike("[0-9]{10}") & text.rlike(PHONE))


def render(template: Column, values: dict[str, Column]) -> Column:
    """Literal substitution of every {name}; values are inserted as they are, never read as patterns."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def safe_file_name(c: Column | str) -> Column:
    """Whether a name may be a file's: letters, digits, dash and underscore only."""
    return _text(c).rlike(r"^[A-Za-z0-9_\-]+$")
