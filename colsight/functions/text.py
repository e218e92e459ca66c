"""String expressions: phonetic code, words, n-grams, names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# --- fixed values: letter groups of the phonetic code ---------------------------------
SOUNDEX_GROUPS = (("bfpv", "1"), ("cgjkqsxz", "2"), ("dt", "3"), ("l", "4"), ("mn", "5"), ("r", "6"))
_LETTERS = "".join(g for g, _ in SOUNDEX_GROUPS)
_CODES = "".join(code * len(g) for g, code in SOUNDEX_GROUPS)
# digits must not be taken for codes
TRANSLATE_FROM = _LETTERS + "0123456789"
TRANSLATE_TO = _CODES + "9" * 10
NOT_WORD = r"[^\p{L}\p{N}_]"


def quoted(name: str) -> str:
    """Column reference that survives dots, blanks and back-ticks in the name."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """String literal of Spark SQL; a raw one, so that backslashes stay as they are."""
    return f"r'{value}'" if "'" not in value else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def file_name() -> Column:
    """Name of the file a row came from. Spark hands it over percent-encoded; a plus is a plus."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def soundex_code(c: Column) -> Column:
    """Four characters; vowels, h and w all end a run, unlike the built-in soundex."""
    word = F.regexp_replace(c, NOT_WORD, "")
    digits = F.regexp_replace(F.translate(F.lower(word), TRANSLATE_FROM, TRANSLATE_TO), "[^1-6]", "9")
    runs = F.regexp_replace(digits, r"(.)\1+", "$1")
    tail = F.translate(F.substring(runs, 2, 1_000_000_000), "9", "")
    return F.when(word == "", "").otherwise(F.rpad(F.concat(F.upper(F.substring(word, 1, 1)), tail), 4, "0"))


def first_word(c: Column, n: int) -> Column:
    """First blank-separated word, cut to n characters; '' if there is none."""
    return F.substring(F.regexp_extract(c, r"(\S+)", 1), 1, n)


def clean_words(c: Column, keep_dash: bool = False) -> Column:
    return F.regexp_replace(c, r"[$#&,]" if keep_dash else r"[\-$#&,]", "")


def split_words(c: Column) -> Column:
    """Lower-cased words split at single blanks, empty ones dropped."""
    return F.filter(F.split(F.lower(c), " "), lambda w: w != "")


def clean_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", " ")


def char_ngrams(c: Column, n: int = 3) -> Column:
    """All runs of n characters. The look-ahead takes the gram, the `.` steps one character on."""
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def word_ngrams(c: Column, n: int = 4, sentences: bool = False) -> Column:
    """All runs of n words, letters only; with `sentences`, none across a point or line break."""
    kept = r"a-zA-Z.\n" if sentences else "a-zA-Z"
    text = F.regexp_replace(c, f"[^{kept}]+", " ")
    run = f"(?=([a-zA-Z]+(?: [a-zA-Z]+){{{n - 1}}}))[a-zA-Z]+"
    return F.regexp_extract_all(text, F.lit(run), F.lit(1))


def sentence_ngrams(c: Column, n: int = 4) -> Column:
    return word_ngrams(c, n, sentences=True)


def ascii_escaped(c: Column) -> Column:
    """Text as printable ASCII: other bytes of its UTF-8 as `\\xhh`, tab, line ends and backslash by
    their short forms; an apostrophe is escaped where the text holds both kinds of quotes."""
    pairs = F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit(".."), F.lit(0))
    both = c.contains("'") & c.contains('"')

    def shown(h: Column) -> Column:
        return (
            F.when(h == "5C", "\\\\").when(h == "09", "\\t").when(h == "0A", "\\n").when(h == "0D", "\\r")
            .when((h == "27") & both, "\\'").when(h.between("20", "7E"), F.char(F.conv(h, 16, 10).cast("int")))
            .otherwise(F.concat(F.lit("\\x"), F.lower(h)))
        )

    plain = c.rlike(r"^[\x20-\x5B\x5D-\x7E]*$") & ~both
    return F.when(c.isNull() | plain, c).otherwise(F.array_join(F.transform(pairs, shown), ""))
