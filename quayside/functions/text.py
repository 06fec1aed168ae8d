"""String normalisation as Column builders; all of it runs inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Legal-form words that say nothing about which company it is.
ENTITY_SUFFIXES = (
    "inc", "incorporated", "corp", "corporation", "llc", "ltd", "limited", "co", "company",
    "lp", "llp", "plc", "gmbh", "sa", "ag", "group", "holdings", "international",
)


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode whitespace included."""
    return F.btrim(c, F.lit(PYTHON_WHITESPACE))


def clean_string(c: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalise_state(c: Column) -> Column:
    return F.upper(strip(c))


def title_case(c: Column) -> Column:
    """Capitalise every run of letters ("e-commerce" -> "E-Commerce").

    ``initcap`` only sees spaces as word boundaries, so one is put, behind a mark, wherever a
    letter follows something else, and taken out again.
    """
    text = strip(c)
    split_words = F.regexp_replace(text, r"([^\p{L} ])(?=\p{L})", "$1\x01 ")
    plain = F.translate(F.lower(text), "abcdefghijklmnopqrstuvwxyz ", "") == ""
    return F.when(plain, F.initcap(text)).otherwise(
        F.replace(F.initcap(split_words), F.lit("\x01 "), F.lit(""))
    )


def normalise_company_name(c: Column) -> Column:
    """Lower-case words of the name without punctuation, legal forms and single characters."""
    words = F.split(F.lower(c), r"[^\p{L}\p{N}_]+")
    kept = F.filter(words, lambda w: (F.char_length(w) > 1) & ~w.isin(*ENTITY_SUFFIXES))
    return F.array_join(kept, " ")


def token_sort(c: Column) -> Column:
    """The words of a normalised name in alphabetical order."""
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def zip_prefix(c: Column, length: int = 5) -> Column:
    """Blocking key: the first characters of the ZIP code; null ZIPs share the empty key."""
    return F.substring(strip(F.coalesce(c, F.lit(""))), 1, length)


# What Python's repr() does not print as it is: controls, formats, separators but the space, unassigned.
_HIDDEN = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def quoted(c: Column) -> Column:
    """Text in quotes for messages, as Python writes a string: in double quotes when it holds a
    single quote and no double one, with backslashes, line ends, tabs and unprintable characters escaped."""
    text = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, written in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(written))

    def escape(ch: Column) -> Column:
        code = F.lower(F.hex(F.ascii(ch)))
        written = (
            F.when(F.ascii(ch) < 0x100, F.concat(F.lit("\\x"), F.lpad(code, 2, "0")))
            .when(F.ascii(ch) < 0x10000, F.concat(F.lit("\\u"), F.lpad(code, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(code, 8, "0")))
        )
        return F.when(ch.rlike(_HIDDEN), written).otherwise(ch)

    characters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    text = F.when(text.rlike(_HIDDEN), F.array_join(F.transform(characters, escape), "")).otherwise(text)
    single, double = c.contains("'"), c.contains('"')
    return (
        F.when(single & ~double, F.concat(F.lit('"'), text, F.lit('"')))
        .when(single, F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), text, F.lit("'")))
    )
