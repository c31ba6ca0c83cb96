"""Column functions that turn text into types; what can't be read becomes null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for true, for false and for nothing.
TRUE_WORDS = ["yes", "true", "y", "1", "1.0"]
FALSE_WORDS = ["no", "false", "n", "0", "0.0"]
MISSING_WORDS = ["nan", "", "<na>", "none", "null", "n/a"]
#: Two-digit years up to this one are of this century.
PIVOT_YEAR = 2030
#: White space of all kinds, which is cut off at both ends of texts.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def trimmed(c: Column) -> Column:
    """c as text without white space of any kind at its ends."""
    return F.btrim(c.cast("string"), F.lit(WHITE))


def boolean(c: Column) -> Column:
    t = F.lower(trimmed(c))
    return F.when(t.isin(TRUE_WORDS), True).when(t.isin(FALSE_WORDS), False)


def is_unknown_boolean(c: Column) -> Column:
    """A text that is neither a boolean nor missing."""
    t = F.lower(trimmed(c))
    return boolean(c).isNull() & ~t.isin(MISSING_WORDS)


def numeric(c: Column) -> Column:
    return F.nanvl(trimmed(c).try_cast("double"), F.lit(None).cast("double"))


def integer(c: Column) -> Column:
    """A whole number; a fraction is null."""
    n = numeric(c)
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def strip_dot_zero(c: Column) -> Column:
    return F.regexp_replace(trimmed(c), r"\.0$", "")


def title_case(c: Column) -> Column:
    """Letters after a non-letter as capitals, others small. (initcap looks at white space only.)"""
    marked = F.regexp_replace(F.lower(c), r"([^\p{L}])(?=\p{L})", "$1\u0000")
    return F.array_join(F.transform(F.split(marked, "\u0000", -1), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")


def category(c: Column) -> Column:
    """A trimmed label: numbers as whole numbers, several words in title case, words for nothing as null."""
    t = trimmed(c)
    number = t.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint").cast("string")).otherwise(t)
    return F.when(F.lower(t).isin(MISSING_WORDS), None).when(number.isNotNull() & ~F.isnan(number), whole).when(F.contains(t, F.lit(" ")), title_case(t)).otherwise(t)


# The months by their first three letters.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _let(value: str, name: str, body: str) -> str:
    """body, in which name is a value that is computed once, however often body uses it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _date_sql(pivot_year: int) -> str:
    """The expression of date() over a trimmed text `t`. As text, since it is made for each column of each table: its hundreds of nodes would each be a call."""
    white = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITE) + "'"
    number = lambda x: f"try_cast({x} AS INT)"
    near = lambda n: f"({n} + CASE WHEN {n} + 2000 >= {pivot_year + 50} THEN 1900 ELSE 2000 END)"
    recent = lambda n: f"({n} + CASE WHEN {n} + 2000 > {pivot_year} THEN 1900 ELSE 2000 END)"
    ymd = lambda y, m, d: f"named_struct('y', {y}, 'm', {m}, 'd', {d})"
    valid = lambda s: f"""({s}.y BETWEEN 1 AND 9999 AND {s}.m BETWEEN 1 AND 12 AND {s}.d BETWEEN 1 AND
        CASE WHEN {s}.m = 2 THEN CASE WHEN {s}.y % 4 = 0 AND {s}.y % 100 <> 0 OR {s}.y % 400 = 0 THEN 29 ELSE 28 END WHEN {s}.m IN (4, 6, 9, 11) THEN 30 ELSE 31 END)"""  # noqa: E731
    x, y, z = "p.x", "p.y", "p.z"
    parts = lambda form, text: f"transform(array(split({text}, r'{form}')), a -> named_struct('n', size(a), 'x', get(a, 0), 'y', get(a, 1), 'z', get(a, 2)))[0]"
    year = f"CASE WHEN length({z}) = 4 THEN {number(z)} ELSE {near(number(z))} END"
    # three numbers that begin with no year: the day first if written so and there is such a date, else the month if it can be
    guess = _let(ymd(year, number(y), number(x)), "g", rf"CASE WHEN g.d > 12 OR t RLIKE r'^\d{{2}}/\d{{2}}/\d{{4}}$' AND {valid('g')} THEN g ELSE {ymd('g.y', 'g.d', 'g.m')} END")
    numbers = f"""CASE
        WHEN p.n = 3 AND length({x}) = 4 AND length({y}) <= 2 AND length({z}) <= 2 THEN {ymd(number(x), number(y), number(z))}
        WHEN p.n = 3 AND length({x}) <= 2 AND length({y}) <= 2 AND length({z}) IN (2, 4) THEN {guess}
        WHEN p.n = 2 AND length({x}) = 4 AND length({y}) <= 2 THEN {ymd(number(x), number(y), "1")}
        WHEN p.n = 1 AND length({x}) = 8 THEN {ymd(number(f"left({x}, 4)"), number(f"substr({x}, 5, 2)"), number(f"right({x}, 2)"))}
        WHEN p.n = 1 AND length({x}) = 4 THEN {ymd(number(x), "1", "1")} END"""
    # the place of a month's first letters, 1, 4, 7 ..., and nothing but letters
    month = lambda v: f"CASE WHEN {v} RLIKE '^[A-Za-z]{{3,}}$' THEN nullif(instr('{MONTHS}', lower(left({v}, 3))), 0) END"
    whole = lambda v: f"CASE WHEN {v} % 3 = 1 THEN ({v} + 2) DIV 3 END"
    day = lambda v: f"CASE WHEN length({v}) <= 2 THEN {number(v)} END"
    long = f"CASE length({z}) WHEN 4 THEN {number(z)} WHEN 2 THEN {near(number(z))} END"
    short = f"CASE length({y}) WHEN 4 THEN {number(y)} WHEN 2 THEN {recent(number(y))} END"
    words = f"""CASE
        WHEN p.n = 3 AND m.y IS NOT NULL AND length({x}) = 4 THEN {ymd(number(x), "m.y", day(z))}
        WHEN p.n = 3 AND m.y IS NOT NULL THEN {ymd(long, "m.y", day(x))}
        WHEN p.n = 3 AND m.x IS NOT NULL THEN {ymd(long, "m.x", day(y))}
        WHEN p.n = 2 AND m.x IS NOT NULL THEN {ymd(short, "m.x", "1")}
        WHEN p.n = 2 AND m.y IS NOT NULL AND length({x}) = 4 THEN {ymd(number(x), "m.y", "1")} END"""
    with_months = _let(f"named_struct('x', {month(x)}, 'y', {month(y)})", "w", _let(f"named_struct('x', CAST({whole('w.x')} AS INT), 'y', CAST({whole('w.y')} AS INT))", "m", words))
    told = rf"""CASE
        WHEN t RLIKE r'^\d+(?:[-/.]\d+){{0,2}}$' THEN {_let(parts("[-/.]", "t"), "p", numbers)}
        WHEN t RLIKE r'^[\dA-Za-z]+(?:[-,/.\s]+[\dA-Za-z]+){{1,2}}$' THEN {_let(parts(r"[-,/.\s]+", r"regexp_replace(t, r'(?<=\d)(?i:st|nd|rd|th)\b', '')"), "p", with_months)} END"""
    untimed = rf"""CASE WHEN contains(t, ':') OR endswith(t, 'Z') OR contains(t, 'T')
        THEN btrim(regexp_replace(regexp_replace(regexp_replace(t, 'Z$', ''), r'(?<=\d)T.*$', ''), r'\s*\S*:\S*', ''), {white}) ELSE t END"""
    return _let(untimed, "t", _let(told, "s", f"CASE WHEN {valid('s')} THEN make_date(s.y, s.m, s.d) END"))


def date(c: Column, pivot_year: int = PIVOT_YEAR) -> Column:
    """A date in one of many forms; null if it is in none of them.

    Time, zone and tokens with `:` are cut off. `dd/mm/yyyy` is day first; other
    numbers are month first where that can be, as are two-digit years. Months may
    be words; a missing day is the first, a missing month January. `Mon-YY` is of
    this century up to pivot_year, other two-digit years are within 50 years of it.
    The text is cut into parts once; their number and lengths tell the form.
    """
    return F.call_function("transform", F.array(trimmed(c)), F.expr(f"t -> {_date_sql(pivot_year)}"))[0]


def normalise_key(c: Column) -> Column:
    """A join key as text: trimmed, without `.0`."""
    return strip_dot_zero(c)


def normalise_name(c: Column) -> Column:
    """A name as a key: lower case, without a leading `the`, trimmed; words for nothing are null."""
    t = trimmed(F.regexp_replace(F.lower(trimmed(c)), r"^the\s+", ""))
    return F.when(~t.isin(MISSING_WORDS), t)


def postcode(c: Column) -> Column:
    return trimmed(F.regexp_replace(F.upper(c), " ", ""))


def percent_text(c: Column) -> Column:
    return trimmed(F.regexp_replace(trimmed(c), "%+$", "")).try_cast("double")


TYPES = {
    "string": strip_dot_zero, "category": category, "datetime": date, "boolean": boolean, "numeric": numeric,
    "Int64": integer, "Float64": numeric,
}


def coerce(c: Column, logical: str) -> Column:
    """c as a logical type. A string loses `.0` only where it is a number."""
    if logical == "string":
        t = c.cast("string")
        return F.when(F.regexp(trimmed(t), F.lit(r"^-?\d+\.0$")), strip_dot_zero(t)).otherwise(t)
    return TYPES[logical](c)
