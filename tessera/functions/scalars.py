"""Scalar functions as Column expressions; all stay inside generated code."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: Column | str) -> Column:
    """Present and not only spaces."""
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def first_nonblank(*columns: Column | str, default: Column | None = None) -> Column:
    """The first column that is not blank, trimmed."""
    trimmed = [F.nullif(F.trim(col(c)), F.lit("")) for c in columns]
    return F.coalesce(*trimmed, *([default] if default is not None else []))


def any_contains(needle: str, *columns: Column | str) -> Column:
    """Case-insensitive text search over several columns of any type."""
    found = [F.contains(F.lower(col(c).cast("string")), F.lit(needle.lower())) for c in columns]
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in found]), F.lit(False))


def optional(c: Column | str, value) -> Column:
    """Equality with an optional parameter: everything passes if it is None or empty."""
    return F.lit(True) if value in (None, "") else col(c) == value


def parse_filter(text: str, c: Column | str) -> Column:
    """A column filter in short form: ``a..b``, ``>=n``, ``>n``, ``<=n``, ``<n``, ``!=x``,
    ``=x``, ``^prefix``, ``suffix$``; anything else is contained, in any case."""
    c, text = col(c), text.strip()
    number = lambda x: F.lit(float(x))
    if ".." in text:
        low, high = (p.strip() for p in text.split("..", 1))
        out = F.lit(True)
        if low:
            out &= c.cast("double") >= number(low)
        if high:
            out &= c.cast("double") <= number(high)
        return out
    for sign, test in ((">=", c.__class__.__ge__), ("<=", c.__class__.__le__), (">", c.__class__.__gt__), ("<", c.__class__.__lt__)):
        if text.startswith(sign):
            return test(c.cast("double"), number(text[len(sign) :]))
    if text.startswith("!="):
        return c.cast("string") != text[2:].strip()
    if text.startswith("="):
        return c.cast("string") == text[1:].strip()
    if text.startswith("^"):
        return F.lower(c.cast("string")).startswith(text[1:].lower())
    if text.endswith("$"):
        return F.lower(c.cast("string")).endswith(text[:-1].lower())
    return F.contains(F.lower(c.cast("string")), F.lit(text.lower()))


def clamp01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, 0.0 where b is zero, negative or null."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return F.when(b > 0, F.coalesce(a / b, F.lit(0.0))).otherwise(F.lit(0.0))


def rate(a: Column | str, b: Column | str) -> Column:
    """a / b, null where there is nothing to divide by."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def leading_int(c: Column | str) -> Column:
    """The integer at the start of a text, 0 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(col(c), r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("long"), F.lit(0))


def collapse_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


@cache
def _folds() -> tuple[str, str]:
    """Characters and their plain forms, by Unicode decomposition: all that come down to
    one character without combining marks, and last the marks, which have no plain form."""
    marked, plain, marks = [], [], []
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x10000)):
        ch = chr(code)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        left = [x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)]
        if len(left) == 1 and left[0] != ch:
            marked.append(ch)
            plain.append(left[0])
    return "".join(marked + marks), "".join(plain)


def fold_accents(c: Column | str) -> Column:
    """Lower case without marks, in any script. A character that stands for several, like a
    ligature or a Hangul syllable, stays whole."""
    return F.lower(F.translate(col(c), *_folds()))


def key_part(c: Column | str) -> Column:
    """Key of a name: folded, blanks, hyphens, underscores and slashes to one space, all
    else but letters and digits dropped."""
    spaced = F.regexp_replace(fold_accents(c), r"[ \-_/]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[^\p{L}\p{N} ]", ""), " +", " "))


def title_key(c: Column | str) -> Column:
    """Key of a title: folded, everything but letters and digits to one space."""
    return F.trim(F.regexp_replace(fold_accents(c), r"[^\p{L}\p{N}]+", " "))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date of three numbers in text or integer form, null if there is no such day."""
    y, m, d = (x.try_cast("int") for x in (year, month, day))
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd")).cast("date")


def _dates(c: Column, *patterns: tuple[str, tuple[int, int, int]]) -> Column:
    """The date of the first pattern that gives one; with each pattern the groups of its
    year, month and day."""
    return F.coalesce(*[F.when(c.rlike(p), _date(*[F.regexp_extract(c, p, g) for g in groups])) for p, groups in patterns])


def flexible_date(c: Column | str) -> Column:
    """A date in one of four forms, days and months of one or two digits, up to the first
    blank; else the ISO date that a text begins with. Null where a form has no such day."""
    c = F.regexp_extract(F.trim(col(c)), "^([^ ]*)", 1)
    ymd, dmy = (1, 2, 3), (3, 2, 1)
    forms = ((r"^(\d{4})-(\d{1,2})-(\d{1,2})$", ymd), (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", dmy), (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", dmy), (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", ymd))
    return _dates(c, *forms, (r"^(\d{4})-(\d{2})-(\d{2})", ymd))


#: The years that a lifecycle may have.
LIFECYCLE_YEARS = (1700, 2500)


def lifecycle_date(c: Column | str) -> Column:
    """A date of an ISO text with or without a time, of eight digits, or of day-month-year
    with hyphens, where a year of two digits is of this century; null outside the years of
    a lifecycle."""
    c = F.trim(col(c))
    digits = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    short = r"^(\d{1,2})-(\d{1,2})-(\d{2,4})(?:[ T].*)?$"
    year = F.regexp_extract(c, short, 3).try_cast("int")
    guarded = lambda d: F.when(F.year(d).between(*LIFECYCLE_YEARS), d)
    iso = guarded(_dates(digits, (r"^(\d{4})-(\d{2})-(\d{2})(?:[ T].*)?$", (1, 2, 3))))
    dmy = F.when(c.rlike(short), _date(F.when(year < 100, year + 2000).otherwise(year), F.regexp_extract(c, short, 2), F.regexp_extract(c, short, 1)))
    return F.coalesce(iso, guarded(dmy))


def last_date_in(*columns: Column | str) -> Column:
    """The last date in the first of several free texts that has one: ISO dates go before
    day-month-year, whose two-digit years are of this century. The last match decides; if
    it is no day, the next form is looked for."""
    out = []
    for c in columns:
        for pattern, (y, m, d) in ((r"\b(\d{4}[-/.]\d{2}[-/.]\d{2})\b", (0, 1, 2)), (r"\b(\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})\b", (2, 1, 0))):
            piece = F.split(F.try_element_at(F.regexp_extract_all(col(c), F.lit(pattern), F.lit(1)), F.lit(-1)), r"[-/.]")
            part = [F.get(piece, F.lit(i)).try_cast("int") for i in (y, m, d)]
            year = F.when((part[0] < 100) & F.lit(y > 0), part[0] + 2000).otherwise(part[0])
            out.append(_date(year, part[1], part[2]))
    return F.coalesce(*out)


def period_start(c: Column | str) -> Column:
    """First day of a period: 2024, 2024-Q2, 2024-03, 2024-W05 or a whole date."""
    c = F.upper(F.trim(col(c)))
    year = F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int")
    quarter = F.regexp_extract(c, r"^\d{4}-?(?:Q|T)([1-4])$", 1).try_cast("int")
    month = F.regexp_extract(c, r"^\d{4}-?M?(0[1-9]|1[0-2])$", 1).try_cast("int")
    week = F.regexp_extract(c, r"^\d{4}-?W(\d{2})$", 1).try_cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(jan4, F.weekday(jan4))
    return (
        F.when(c.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
        .when(quarter.isNotNull(), F.make_date(year, quarter * 3 - 2, F.lit(1)))
        .when(month.isNotNull(), F.make_date(year, month, F.lit(1)))
        .when(week.between(1, 53), F.date_add(monday, 7 * (week - 1)))
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date"))
    )


def european_amount(c: Column | str) -> Column:
    """A number with either decimal sign: the last of comma and point decides; a lone
    comma is decimal if up to three characters follow it. Blanks and the currency are
    left out; null where anything else remains that is no number."""
    raw = F.regexp_replace(col(c), r"(?U)\s+|EUR|eur|€", "")
    comma, point = F.length(raw) - F.instr(F.reverse(raw), ","), F.length(raw) - F.instr(F.reverse(raw), ".")
    has_comma, has_point = F.contains(raw, F.lit(",")), F.contains(raw, F.lit("."))
    as_comma = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    as_point = F.replace(raw, F.lit(","), F.lit(""))
    decimal_comma = (has_comma & has_point & (comma > point)) | (has_comma & ~has_point & raw.rlike(r"^[^,]*,[^,]{0,3}$"))
    token = F.when(decimal_comma, as_comma).otherwise(F.when(has_comma, as_point).otherwise(raw))
    return F.when(token.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), token.try_cast("double"))


#: What the letters of a Roman number count for.
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman_to_int(c: Column | str) -> Column:
    """A Roman number's value, read from the right: a letter below the largest so far is
    taken away. Null if a text holds anything else."""
    c = F.upper(F.trim(col(c)))
    value = F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])
    digits = F.transform(F.split(c, ""), lambda ch: F.coalesce(value[ch], F.lit(0)))
    none = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most"))
    add = lambda a, d: F.struct(F.when(d < a["most"], a["sum"] - d).otherwise(a["sum"] + d).alias("sum"), F.greatest(a["most"], d).alias("most"))
    total = F.aggregate(F.reverse(digits), none, add, lambda a: a["sum"])
    return F.when(c.rlike("^[IVXLCDM]+$") & (total > 0), total)


def confidence_band(c: Column | str, high: float = 0.8, medium: float = 0.5, stance: Column | str | None = None) -> Column:
    """high, medium or low; none for no_signal and where there is no confidence above 0."""
    c = F.coalesce(col(c), F.lit(0.0))
    quiet = (c <= 0) if stance is None else (c <= 0) | F.coalesce(col(stance) == "no_signal", F.lit(False))
    return F.when(quiet, "none").when(c >= high, "high").when(c >= medium, "medium").otherwise("low")


#: Fixed value: the bucket of names without a letter or digit.
OTHER_BUCKET = "OTROS"


def initial_bucket(c: Column | str) -> Column:
    """The first letter A-Z of a folded name or, if a digit comes before it, 0-9."""
    first = F.regexp_extract(F.upper(fold_accents(col(c))), r"[A-Z\p{Nd}]", 0)
    return F.when(first.rlike("^[A-Z]$"), first).when(first != "", "0-9").otherwise(OTHER_BUCKET)


#: Fixed value: a cut text is cut at its last blank only beyond this place.
LEAST_KEPT = 24


def shorten(c: Column | str, width: int = 240) -> Column:
    """A text of at most width characters, blanks collapsed; a longer one is cut there, then
    at its last blank, and three points follow. Null is an empty text."""
    c = F.coalesce(collapse_space(c), F.lit(""))
    head = F.rtrim(F.substring(c, 1, width))
    blank = F.length(head) - F.instr(F.reverse(head), " ")  # from 0; the length if there is none
    cut = F.when(F.contains(head, F.lit(" ")) & (blank > LEAST_KEPT), F.substring(head, F.lit(1), blank)).otherwise(head)
    return F.when(F.length(c) <= width, c).otherwise(F.concat(cut, F.lit("...")))


def canonical_url(c: Column | str, base: str | None = None) -> Column:
    """An address with its host in lower case, https for http, its path and query as they
    are, without fragment. A path that starts with a slash is taken from ``base`` (scheme and
    host). Null where there is no host."""
    c = F.trim(col(c))
    if base:
        c = F.when(c.rlike("^/(?!/)"), F.concat(F.lit(base.rstrip("/")), c)).otherwise(c)
    pattern = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?//([^/?#]+)([^?#]*)(?:\?([^#]*))?"
    scheme, host, path, query = (F.regexp_extract(c, pattern, g) for g in (1, 2, 3, 4))
    scheme = F.when(F.lower(scheme).isin("", "http"), "https").otherwise(F.lower(scheme))
    return F.when(host != "", F.concat(scheme, F.lit("://"), F.lower(host), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def stable_id(*columns: Column | str) -> Column:
    """A sha256 of named values as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*[col(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def first_keyword(c: Column | str, hints: list[tuple[str, tuple[str, ...]]], default: str = "other") -> Column:
    """The label of the first hint list of which a keyword is contained, in order."""
    text, out = F.lower(col(c)), None
    for label, words in hints:
        hit = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def json_any(c: Column | str, *paths: str) -> Column:
    """The first of several JSON paths that has a value."""
    return F.coalesce(*[F.get_json_object(col(c), p) for p in paths])


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone."""
    return F.unix_micros(col(c).cast("timestamp"))


def median(c: Column | str) -> Column:
    return F.percentile(col(c), F.lit(0.5))


#: Spellings of vote choices, accents folded, upper case.
VOTE_YES = ("SI", "YES", "A", "A FAVOR", "A FAVOR DE", "AFAVOR", "FAVOR", "FAV", "APOYA")
VOTE_NO = ("NO", "DENEGADO", "EN CONTRA", "ENCONTRAR")
VOTE_ABSTAIN_PART = "ABST"
VOTE_ABSENT_PARTS = ("NO VOT", "AUSENT")
#: The narrower lists of the page variant, lower case.
PAGE_YES = ("si", "afavor", "a favor", "favorable")
PAGE_NO = ("no", "en contra", "voto no")
PAGE_ABSTAIN = ("abstencion", "abst")
PAGE_ABSENT = ("novota", "no vota")


def vote_choice(c: Column | str, variant: str = "snapshot") -> Column:
    """yes, no, abstain, no_vote or other. The ``snapshot`` variant knows more spellings and
    looks inside; the ``page`` variant knows whole keys and gives an unknown key back."""
    if variant == "page":
        key = key_part(c)
        known = F.when(key.isin(*PAGE_YES), "yes").when(key.isin(*PAGE_NO), "no").when(key.isin(*PAGE_ABSTAIN), "abstain").when(key.isin(*PAGE_ABSENT), "no_vote")
        return known.otherwise(F.coalesce(F.nullif(key, F.lit("")), F.lit("other")))
    v = F.upper(fold_accents(collapse_space(c)))
    absent = F.lit(False)
    for part in VOTE_ABSENT_PARTS:
        absent |= F.contains(v, F.lit(part))
    return F.when(v.isin(*VOTE_YES), "yes").when(v.isin(*VOTE_NO), "no").when(F.contains(v, F.lit(VOTE_ABSTAIN_PART)), "abstain").when(absent, "no_vote").otherwise("other")


def split_name(c: Column | str) -> Column:
    """struct(family, given, full) of "Family, Given"; without a comma only the full name
    is known."""
    text = F.coalesce(collapse_space(c), F.lit(""))
    parts = F.split(text, ",", 2)
    comma = F.size(parts) > 1
    family, given = (F.trim(F.get(parts, F.lit(i))) for i in (0, 1))
    full = F.when(comma, F.trim(F.concat_ws(" ", given, family))).otherwise(text)
    empty = F.lit("")
    return F.struct(F.when(comma, F.nullif(family, empty)).alias("family"), F.when(comma, F.nullif(given, empty)).alias("given"), full.alias("full"))


def split_name_last(c: Column | str) -> Column:
    """As split_name, but without a comma the last word is the family name."""
    text = F.coalesce(collapse_space(c), F.lit(""))
    known = split_name(c)
    comma = F.contains(text, F.lit(","))
    family = F.when(comma, known["family"]).otherwise(F.nullif(F.regexp_extract(text, r"(\S+)$", 1), F.lit("")))
    given = F.when(comma, known["given"]).otherwise(F.nullif(F.trim(F.regexp_replace(text, r"\S+$", "")), F.lit("")))
    return F.struct(family.alias("family"), given.alias("given"), known["full"].alias("full"))


def mapped(c: Column | str, codes: dict[str, str], default: Column | None = None) -> Column:
    """A code for each folded spelling."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    found = table[key_part(c)]
    return found if default is None else F.coalesce(found, default)


#: The states of a review queue, in the order in which they are looked for,
#: and what each needs next.
QUEUE_ACTIONS = {
    "missing_source": "add_source_to_sanction_data_catalog_seed",
    "no_metrics": "ingest_official_review_procedural_metrics",
    "no_source_record_chain": "backfill_source_record_pk_for_official_review_metrics",
    "no_evidence_chain": "backfill_evidence_date_quote_for_official_review_metrics",
    "partial_kpi_coverage": "ingest_missing_kpis_for_source_scope",
    "ready": "monitor_refresh",
}


def queue_status(seeded: Column, metrics: Column, source_records: Column, evidence: Column, kpis_covered: Column, kpis_expected: Column) -> Column:
    """The first gap of a queue entry: no source, no metrics, fewer source records or pieces
    of evidence than metrics, fewer KPIs than expected; else ready."""
    gaps = (~seeded, metrics <= 0, source_records < metrics, evidence < metrics, (kpis_expected > 0) & (kpis_covered < kpis_expected))
    out = F
    for state, gap in zip(QUEUE_ACTIONS, gaps, strict=False):
        out = out.when(F.coalesce(gap, F.lit(False)), state)
    return out.otherwise("ready")


def next_action(status: Column | str) -> Column:
    """What a queue entry needs next, by its state; any other state is refreshed."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in QUEUE_ACTIONS.items() for x in kv])[col(status)], F.lit(QUEUE_ACTIONS["ready"]))


def metric_check(value: Column | str, kind: str, target: float | None = None) -> Column:
    """DONE, PARTIAL, TODO or UNTRACKED (no value, or one that is no number): ``bool_true``;
    ``presence`` (above 0); ``gte`` and ``count_gte`` (at least the target; above 0 is
    partial); ``max`` (at most the target; up to 1.5 times is partial)."""
    v = col(value)
    if kind == "bool_true":
        v = v.cast("boolean")
        return F.when(v.isNull(), "UNTRACKED").when(v, "DONE").otherwise("TODO")
    v, t = v.try_cast("double"), F.lit(float(target or 0.0))
    if kind == "presence":
        known = F.when(v > 0, "DONE").otherwise("TODO")
    elif kind in ("gte", "count_gte"):
        known = F.when(v >= t, "DONE").when(v > 0, "PARTIAL").otherwise("TODO")
    elif kind == "max":
        known = F.when(v <= t, "DONE").when((t > 0) & (v <= 1.5 * t), "PARTIAL").otherwise("TODO")
    else:
        return F.lit("UNTRACKED")
    return F.when(v.isNull(), "UNTRACKED").otherwise(known)


def mismatch_state(tracker: Column | str, actual: Column | str, done_zero: Column, waived: Column) -> Column:
    """How a tracker's status fits the status of the data; a waiver covers a mismatch."""
    t, a = (F.upper(F.trim(F.coalesce(col(c), F.lit("")))) for c in (tracker, actual))
    return F.when(t == "", "UNTRACKED").when(done_zero, "DONE_ZERO_REAL").when(t == a, "MATCH").when(waived, "WAIVED_MISMATCH").otherwise("MISMATCH")


def redacted(c: Column | str) -> Column:
    """A text without secrets, addresses of people and queries of links."""
    out = F.regexp_replace(col(c), r"(?i)((?:password|token|secret|api[_-]?key)\s*[=:]\s*)\S+", "$1[redacted]")
    out = F.regexp_replace(out, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")
    return F.regexp_replace(out, r"(https?://[^\s?#]+)[?#]\S*", "$1")
