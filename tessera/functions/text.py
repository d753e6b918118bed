"""Text functions: accents, tokens with spelling variants, hashed term frequencies."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The letters beyond ASCII that belong to tokens, and the signs that join the parts of one.
LATIN_FIRST, LATIN_LAST = 0x00C0, 0x017E
TOKEN_PATTERN = "[a-z0-9À-ž]+(?:[-_./][a-z0-9À-ž]+)*"
JOINER_PATTERN = "[-_./]"
#: Fixed value: size of the hashed vocabulary, a Mersenne prime.
VOCAB_SIZE = 2**31 - 1


def strip_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def _accent_tables() -> tuple[str, str]:
    pairs = [(chr(c), strip_marks(chr(c))) for c in range(LATIN_FIRST, LATIN_LAST + 1)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_tables()


def plain_letters(col: Column | str) -> Column:
    """Accent-free form of text whose letters lie in the token alphabet; stays in the JVM."""
    return F.translate(F.col(col) if isinstance(col, str) else col, ACCENTED, PLAIN)


@F.pandas_udf(T.StringType())
def _strip_marks_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else strip_marks(x))


def normalize_accents(col: Column | str) -> Column:
    """Any text without its combining marks (canonical decomposition). Null stays null.

    Text of ASCII and the token alphabet never reaches Python.
    """
    c = F.col(col) if isinstance(col, str) else col
    simple = c.rlike("^[\\x00-\\x7fÀ-ž]*$")
    return F.when(c.isNull() | simple, plain_letters(c)).otherwise(_strip_marks_udf(F.when(~simple, c)))


def tokens(col: Column | str) -> Column:
    """Array of search tokens of a text.

    Each run of letters and digits, parts joined by single signs, gives its own form, the form without
    joiners, the form without accents and the one without both; equal forms of one occurrence count once.
    Null text gives an empty array.
    """
    c = F.col(col) if isinstance(col, str) else col
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))

    def forms(t: Column) -> Column:
        flat = F.regexp_replace(t, JOINER_PATTERN, "")
        return F.array_distinct(F.array(t, flat, plain_letters(t), plain_letters(flat)))

    return F.flatten(F.transform(found, forms))


def _word(h: Column, i: int) -> Column:
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")


def token_index(col: Column | str, vocab_size: int = VOCAB_SIZE) -> Column:
    """128-bit MD5 of a token modulo the vocabulary size, as BIGINT.

    The digest is folded word by word (Horner), so that nothing exceeds 64 bits; sizes up to 2**31 are allowed.
    """
    if not 0 < vocab_size <= 2**31:
        raise ValueError("vocab_size must lie in 1..2**31")
    h = F.md5((F.col(col) if isinstance(col, str) else col).cast("binary"))
    r = _word(h, 0) % vocab_size
    for i in range(1, 4):
        r = (r * (2**32 % vocab_size) % vocab_size + _word(h, i)) % vocab_size
    return r


def term_frequencies(df: DataFrame, id_col: str, text_col: str, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """Long sparse vectors ``(id, idx, tf DOUBLE)``.

    Where two tokens of a document share an index, the one that first occurs later replaces the other.
    Documents without tokens give no row; repeated ids are counted together.
    """
    t = df.select(F.col(id_col).alias("id"), F.posexplode(tokens(text_col)).alias("pos", "token"))
    per = t.groupBy("id", "token").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    per = per.select("id", token_index("token", vocab_size).alias("idx"), "n", "first")
    return per.groupBy("id", "idx").agg(F.max_by("n", "first").cast("double").alias("tf"))


def term_frequency_map(df: DataFrame, id_col: str, text_col: str, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """One row per document with ``tf MAP<BIGINT, DOUBLE>``; documents without tokens have an empty map."""
    tf = term_frequencies(df, id_col, text_col, vocab_size)
    m = tf.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("idx", "tf"))).alias("tf"))
    ids = df.select(F.col(id_col).alias("id")).distinct()
    return ids.join(m, "id", "left").select("id", F.coalesce("tf", F.create_map().cast("map<bigint,double>")).alias("tf"))
