"""Text parsing and formatting: clocks, matchups, names, ids, labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .casts import col_of, try_double


def split_part(c: str | Column, delim: str, n: int) -> Column:
    return F.split_part(col_of(c), F.lit(delim), F.lit(n))


# -- game clock ---------------------------------------------------------------

def clock_text(c: str | Column) -> Column:
    """Missing or empty clock reads as no time played."""
    c = col_of(c)
    return F.when(c.isNull() | (c == ""), F.lit("00:00")).otherwise(c)


def _clock_parts(c: str | Column) -> tuple[Column, Column]:
    text = clock_text(c)
    return try_double(split_part(text, ":", 1)), try_double(split_part(text, ":", 2))


def clock_minutes(c: str | Column) -> Column:
    """``MM:SS`` as minutes; text without both parts counts as 0."""
    minutes, seconds = _clock_parts(c)
    return F.coalesce(minutes + seconds / 60, F.lit(0.0))


def played_flag(c: str | Column) -> Column:
    """1 when either part of the clock is above zero, else 0."""
    minutes, seconds = _clock_parts(c)
    return F.when((minutes > 0) | (seconds > 0), 1).otherwise(0)


# -- matchup text -------------------------------------------------------------

def is_home(matchup: str | Column) -> Column:
    return F.coalesce(col_of(matchup).ilike("% vs. %"), F.lit(False))


def home_team(matchup: str | Column) -> Column:
    m = col_of(matchup)
    return F.trim(
        F.when(m.ilike("%vs.%"), split_part(m, "vs.", 1)).otherwise(split_part(m, "@", 2))
    )


def away_team(matchup: str | Column) -> Column:
    m = col_of(matchup)
    return F.trim(
        F.when(m.ilike("%vs.%"), split_part(m, "vs.", 2)).otherwise(split_part(m, "@", 1))
    )


def opponent_code(matchup: str | Column) -> Column:
    """Team code after ``vs.`` or ``@``; text with neither stays whole."""
    return F.regexp_replace(col_of(matchup), r".*(vs\.|@) ", "")


def season_type(season_id: str | Column) -> Column:
    """Kind of competition from the first digit of the season id."""
    s = col_of(season_id).cast("string")
    return (
        F.when(s.ilike("4%"), "PLAYOFFS").when(s.ilike("6%"), "NBA_CUP").otherwise("REGULAR")
    )


# -- ids ----------------------------------------------------------------------

def pad_id(c: str | Column, width: int = 10) -> Column:
    """Zero-pad on the left; longer ids stay whole (``lpad`` alone would cut them)."""
    c = col_of(c).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def id_tokens(c: str | Column) -> Column:
    """Array of ids from text separated by commas or white space."""
    return F.filter(F.split(col_of(c), r"[,\s]+"), lambda x: x != "")


def parse_ids(df: DataFrame, c: str, out: str) -> DataFrame:
    """One row per id found in a text column or in the lines of a text file."""
    return df.select(F.explode(id_tokens(c)).alias(out))


def ids_as_text(c: str | Column) -> Column:
    return F.transform(col_of(c), lambda x: x.cast("string"))


# -- names --------------------------------------------------------------------

# Name suffixes that do not identify a person.
NAME_SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v"]


def _folds() -> tuple[str, str, dict[str, str]]:
    """Compatibility folds of all code points to ASCII: one-letter folds and longer ones."""
    source, target, longer = [], [], {}
    for char in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]):
        plain = unicodedata.normalize("NFKD", char)
        if plain == char:
            continue
        folded = "".join(x for x in plain if not unicodedata.combining(x))
        if not folded.isascii() or not folded:
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        else:
            longer[char] = folded
    return "".join(source), "".join(target), longer


_FOLD_FROM, _FOLD_TO, _FOLD_LONG = _folds()


def fold_accents(c: str | Column) -> Column:
    """Letters and marks of any script to the ASCII they are variants of; others stay, accents go."""
    text = col_of(c)
    out = F.translate(text, _FOLD_FROM, _FOLD_TO)
    # Few texts hold a letter that unfolds to several: only these are taken apart.
    table = F.create_map(*[F.lit(x) for pair in _FOLD_LONG.items() for x in pair])
    letters = F.regexp_extract_all(out, F.lit("(?s)."), F.lit(0))
    unfolded = F.array_join(F.transform(letters, lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    out = F.when(out.rlike(f"[{''.join(_FOLD_LONG)}]"), unfolded).otherwise(out)
    # Plain ASCII, which most names are, has nothing to fold.
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(out, r"\p{M}+", "")).otherwise(text)


def strip(c: str | Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def normalize_name(c: str | Column) -> Column:
    """Lower case, no accents, no suffix such as Jr., letters and single spaces only."""
    out = fold_accents(F.lower(strip(F.coalesce(col_of(c), F.lit("")))))
    out = F.regexp_replace(out, rf"(?U)\b({'|'.join(NAME_SUFFIXES)})\b\.?", "")
    out = F.regexp_replace(out, r"(?U)[^a-z\s]", "")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def normalize_name_basic(c: str | Column) -> Column:
    """Lower case, ASCII letters and single spaces only; accented letters are dropped."""
    out = F.regexp_replace(strip(F.lower(col_of(c))), r"(?U)[^a-z\s]", "")
    return F.regexp_replace(out, r"(?U)\s+", " ")


def full_name(first: str | Column, last: str | Column) -> Column:
    return strip(F.concat_ws(" ", col_of(first), col_of(last)))


def display_name(first: str | Column, last: str | Column, ident: str | Column) -> Column:
    """Full name, or the id where either part is unknown."""
    return F.coalesce(
        F.concat(col_of(first), F.lit(" "), col_of(last)), col_of(ident).cast("string")
    )


def slug(c: str | Column) -> Column:
    return F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))


# -- display ------------------------------------------------------------------

def format_magnitude(c: str | Column) -> Column:
    """Fewer decimals the larger the number; unknown reads as empty text.

    ``bround`` first: exact halves go to the even digit, while the JVM formatter
    alone would round them up.
    """
    x = col_of(c).cast("double")
    text = (
        F.when(F.abs(x) >= 10, F.format_string("%.0f", F.bround(x, 0)))
        .when(F.abs(x) >= 1, F.format_string("%.2f", F.bround(x, 2)))
        .otherwise(F.format_string("%.3f", F.bround(x, 3)))
    )
    return F.when(x.isNull() | F.isnan(x), F.lit("")).otherwise(text)


def week_label(
    season: str | Column, number: str | Column, start: str | Column, end: str | Column
) -> Column:
    """One line of the week directory."""
    day = lambda c: F.coalesce(F.date_format(col_of(c), "yyyy-MM-dd"), F.lit("N/A"))
    return F.concat(
        F.lit("SZN "), col_of(season).cast("string"),
        F.lit(" | Week "), col_of(number).cast("string"),
        F.lit(" | "), day(start), F.lit(" → "), day(end),
    )


def concat_text(*cols: str | Column) -> Column:
    """Concatenate as text, skipping NULLs."""
    return F.concat_ws("", *[col_of(c).cast("string") for c in cols])
