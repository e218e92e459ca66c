"""Column expressions. No Python runs per row."""

from colsight.functions.interpret import (  # noqa: F401
    interpret_datetime,
    interpret_int,
    interpret_real,
    interpret_text,
    numeric_like,
    parse_datetime,
    with_interpretation,
)
from colsight.functions.text import (  # noqa: F401
    char_ngrams,
    clean_name,
    clean_words,
    first_word,
    quoted,
    sentence_ngrams,
    soundex_code,
    split_words,
    word_ngrams,
)
