"""Text cleaning, filters and tokens as column expressions.

All functions take and return ``Column``s, so they stay inside whole-stage
codegen and run on whole texts without a Python round trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's ``str.strip()`` removes (its
# whitespace set), in code point order.  Used to strip post text exactly the
# way the reference does; Spark's plain ``trim`` removes only spaces.
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)

# Token pattern (runs of >= 2 letters, digits or underscores,
# the reference vectoriser's word pattern), the minimum text length kept
# (strictly more than 20 code points), and the ASCII-letter share for the
# script filter.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
MIN_TEXT_CHARS = 20
LATIN_SHARE = 0.6


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (Python ``str.strip`` set)."""
    return F.btrim(c, F.lit(WHITESPACE))


def n_letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{L}", ""))


def n_ascii_letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^A-Za-z]", ""))


def is_latin(c: Column) -> Column:
    """at least 60 % of the letters are ASCII; no letters -> False."""
    letters = n_letters(c)
    return F.when(letters == 0, F.lit(False)).otherwise(
        n_ascii_letters(c).cast("double") / letters >= F.lit(LATIN_SHARE))


def long_enough(c: Column) -> Column:
    """stripped text has more than 20 code points."""
    return F.char_length(strip(c)) > F.lit(MIN_TEXT_CHARS)


def assemble_text(title: Column, desc: Column) -> Column:
    """``strip(title + (" " + desc if desc))``; null parts count as ""."""
    t = F.coalesce(title, F.lit(""))
    d = F.coalesce(desc, F.lit(""))
    return strip(F.concat(t, F.when(d != "", F.concat(F.lit(" "), d)).otherwise(F.lit(""))))


def normalize_topic(c: Column) -> Column:
    """Lower case, ``_`` and ``-`` to blanks, stripped."""
    return strip(F.translate(F.lower(c), "_-", "  "))


def tokens(c: Column) -> Column:
    """Lower-case word tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


# The English stop words of the reference's vectoriser
# (scikit-learn's public "english" list), in alphabetical order.
ENGLISH_STOP_WORDS = """
a about above across after afterwards again against all almost alone along already also although
always am among amongst amoungst amount an and another any anyhow anyone anything anyway
anywhere are around as at back be became because become becomes becoming been before beforehand
behind being below beside besides between beyond bill both bottom but by call can cannot cant co
con could couldnt cry de describe detail do done down due during each eg eight either eleven
else elsewhere empty enough etc even ever every everyone everything everywhere except few
fifteen fifty fill find fire first five for former formerly forty found four from front full
further get give go had has hasnt have he hence her here hereafter hereby herein hereupon hers
herself him himself his how however hundred i ie if in inc indeed interest into is it its itself
keep last latter latterly least less ltd made many may me meanwhile might mill mine more
moreover most mostly move much must my myself name namely neither never nevertheless next nine
no nobody none noone nor not nothing now nowhere of off often on once one only onto or other
others otherwise our ours ourselves out over own part per perhaps please put rather re same see
seem seemed seeming seems serious several she should show side since sincere six sixty so some
somehow someone something sometime sometimes somewhere still such system take ten than that the
their them themselves then thence there thereafter thereby therefore therein thereupon these
they thick thin third this those though three through throughout thru thus to together too top
toward towards twelve twenty two un under until up upon us very via was we well were what
whatever when whence whenever where whereafter whereas whereby wherein whereupon wherever
whether which while whither who whoever whole whom whose why will with within without would yet
you your yours yourself yourselves
"""


def english_stop_words() -> tuple[str, ...]:
    """The default stop words of C6; pass another list to ``ctfidf_keywords``."""
    return tuple(ENGLISH_STOP_WORDS.split())


def sql_whitespace() -> str:
    """The whitespace set as a DuckDB/ANSI SQL string expression."""
    return "(" + " || ".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS) + ")"
