"""Column expressions for the text statistics.

Everything is a built-in Spark expression (regex, split, higher-order array
functions), so it runs inside the JVM and never round-trips through Python.

Text columns may hold one line or a whole document: a line break (LF, CR or
CR LF) separates sentences and words exactly like the end of a line does, so
counting over a document gives the same totals as counting over its lines.
Other characters that some tools take for line ends are ordinary text.

Semantics (what counts as a sentence, a word, a normalised word):

* sentence – a non-empty piece of a line split on ``.``; whitespace-only
  pieces count.
* word – a non-empty piece of a line split on a single space (tabs are not
  separators).
* normalised word, ``strip='token'`` – the word lower-cased with its leading
  and trailing non-letters removed (``,1what?!"`` -> ``what``; ``haven't``
  keeps its apostrophe); empty results are dropped.
* normalised word, ``strip='line'`` – the variant that removes whole
  non-alphabetic *tokens* from both ends of each line and keeps punctuation
  on the remaining tokens.  A line of exactly one token is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and the letter class that define the statistics.
LINE_END = r"\r\n|\r|\n"
SENTENCE_PIECE = r"[^.\r\n]+"        # maximal run between '.' and line ends
WORD_PIECE = r"[^ \r\n]+"            # maximal run between ' ' and line ends
# First to last letter of a token.  Nothing is matched around it, so a run of
# non-letters is passed over once.
LETTER_SPAN = r"(?s)\p{L}(?:.*\p{L})?"
WORD_CORE = r"\p{L}(?:[^ \r\n]*\p{L})?"
ALPHA_TOKEN = r"(?<![^ ])\p{L}+(?![^ ])"
# From the first all-letter token of a line to its last one (greedy middle).
ALPHA_SPAN = r"(?s)" + ALPHA_TOKEN + r"(?:.*" + ALPHA_TOKEN + r")?"


def sentence_total(text: Column | str) -> Column:
    """Number of sentences in ``text`` (count of non-empty ``.``-pieces)."""
    return F.regexp_count(_col(text), F.lit(SENTENCE_PIECE)).cast("long")


def word_total(text: Column | str) -> Column:
    """Number of raw words in ``text`` (count of non-empty space-pieces)."""
    return F.regexp_count(_col(text), F.lit(WORD_PIECE)).cast("long")


def strip_non_alpha(token: Column | str) -> Column:
    """Remove leading and trailing non-letters, keep inner ones."""
    return F.regexp_extract(_col(token), LETTER_SPAN, 0)


def normalised_word_array(text: Column | str) -> Column:
    """Normalised words (token mode) of ``text`` in one regex pass: each
    token's span from its first to its last letter; tokens without letters
    yield nothing."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_CORE), 0)


def line_kept_span(line: Column) -> Column:
    """The part of one line that the line-level stripping rule keeps."""
    return (F.when(line.rlike(ALPHA_TOKEN), F.regexp_extract(line, ALPHA_SPAN, 0))
            .when(F.instr(line, " ") == 0, line)
            .otherwise(F.lit("")))


def line_span_token_array(text: Column | str) -> Column:
    """Tokens kept by the line-level stripping rule, for every line of ``text``."""
    lines = F.split(F.lower(_col(text)), LINE_END, -1)
    return F.flatten(F.transform(lines, lambda l: F.split(line_kept_span(l), " ", -1)))


def token_array(text: Column | str, strip: str = "token") -> Column:
    """Array of normalised words to explode; empties are removed after the
    aggregation."""
    if strip == "token":
        return normalised_word_array(text)
    if strip == "line":
        return line_span_token_array(text)
    raise ValueError(f"strip must be 'token' or 'line', not {strip!r}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
