"""Text expressions: cleaning, counting and name normalisation.

Everything is a native column expression except three repairs the JVM has no
function for (mojibake, HTML entities, NFKC). Those run as Arrow batches and
only receive the rows a native test has marked; all other rows pass as null.
"""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- Fixed values ------------------------------------------------------------
# Unicode white space plus the four ASCII separators. Patterns that use it
# carry the flag (?U), without which \s is ASCII only.
WS = r"\s\x1c-\x1f"
WS_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
LINE_BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}"

# What a lyrics site leaves in scraped text, in the order it is removed. Digits, white space and E are apart, so what a
# possessive part has taken it need not give back.
SITE_CRUFT = (
    rf"(?iuU)\d+[{WS}]+Contributors?[^\n]*\n",
    rf"(?iuU)Translations?[{WS}]*\n",
    rf"(?iuU)You[{WS}]+might[{WS}]+also[{WS}]+like",
    rf"(?iuU)See[{WS}]+[^\n]+Live[{WS}]+Get[{WS}]+tickets[^\n]*",
    rf"(?imuUd)\d*+[{WS}]*+Embed[{WS}]*$",
)
SECTION_MARKER = r"\[[^\]]{0,200}\]"
PARENTHETICAL = r"\([^)]{0,200}\)"
# A word that begins with p: looked at before the word boundary, which costs more.
PRODUCER_TAG = (
    rf"(?iuU)(?=p)\b(produced[{WS}]+by|prod(uced)?\.?[{WS}]+by)\b[^\n,.]{{0,80}}"
)
SINGLE_QUOTES = "ʼ‘’‚‛"
DOUBLE_QUOTES = "“”„‟"
LINE_ENDS = "\r\x85\u2028\u2029"
# Code points dropped: control and layout characters, first and last of a range.
DROPPED_RANGES = (
    (0x00, 0x08), (0x0B, 0x0B), (0x0E, 0x1F), (0x7F, 0x7F),
    (0x206A, 0x206F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFC),
)
# --- end of fixed values -----------------------------------------------------

# Characters a UTF-8 continuation byte turns into when it is read as cp1252.
_CONTINUATION = "".join(
    bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xC0)
)
_MOJIBAKE = re.compile(
    "[ÂÃ][{c}]|â[{c}]{{2}}|ð[{c}]{{3}}".format(c=re.escape(_CONTINUATION))
)
_STRICT_ENTITY = re.compile(r"&#?[0-9A-Za-z]{1,24};")


def _undo_cp1252(match: re.Match) -> str:
    raw = b"".join(
        c.encode("cp1252") if c in _CP1252 else bytes([ord(c)]) for c in match.group()
    )
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return match.group()


_CP1252 = {
    bytes([b]).decode("cp1252", errors="ignore") for b in range(0x80, 0x100)
} - {""}


def _repair(text: str) -> str:
    if "<" not in text:
        text = _STRICT_ENTITY.sub(lambda m: html.unescape(m.group()), text)
    return _MOJIBAKE.sub(_undo_cp1252, text)


_CLOSED_ENTITY = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9A-Fa-f]+)|([A-Za-z][0-9A-Za-z]*));")


def _decode_closed(text: str) -> str:
    """HTML also reads some names without a semicolon (&amp, &copy); those stay here, as in '?a=1&copy=2'."""
    return _CLOSED_ENTITY.sub(lambda m: html.unescape(m[0]) if m[1] is None or f"{m[1]};" in html.entities.html5 else m[0], text)


def _nfkc_if_changed(text: str) -> str | None:
    return None if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)


def _over_texts(fn):
    """An Arrow function over the non-null texts of a batch.

    Declared non-deterministic so that the optimiser leaves it in place: a
    filter on the result would otherwise be pushed down with a copy of every
    rule inside it, and each text would be cleaned several times.
    """

    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(fn, na_action="ignore")

    apply.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, T.StringType()).asNondeterministic()


_repair_encoding = _over_texts(_repair)
_unescape_html = _over_texts(html.unescape)
_unescape_closed = _over_texts(_decode_closed)
_repair_and_unescape = _over_texts(lambda text: html.unescape(_repair(text)))
_nfkc = _over_texts(_nfkc_if_changed)


def _only_where(udf, text: Column, marked: Column) -> Column:
    """Send only the marked rows to Python; keep the others as they are."""
    return F.coalesce(udf(F.when(marked, text)), text)


def fix_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as cp1252."""
    return _only_where(_repair_encoding, text, text.rlike("[ÂÃâð&]"))


def unescape_html(text: Column, closed: bool = False) -> Column:
    """Decode HTML entities; with ``closed`` only those that end in a semicolon."""
    return _only_where(_unescape_closed if closed else _unescape_html, text, text.contains("&"))


def tidy_characters(text: Column) -> Column:
    """Straight quotes, LF line ends, no control characters."""
    dropped = "".join(chr(c) for low, high in DROPPED_RANGES for c in range(low, high + 1))
    source = SINGLE_QUOTES + DOUBLE_QUOTES + LINE_ENDS + dropped
    # Characters beyond the end of the target are deleted.
    target = "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + "\n" * len(LINE_ENDS)
    return F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), source, target)


def nfkc(text: Column) -> Column:
    """NFKC. ASCII text is stable; it has as many bytes as characters."""
    return _only_where(_nfkc, text, F.octet_length(text) > F.length(text))


def between(n: Column, low: int, high: int) -> Column:
    """low <= n <= high with ``n`` written once: a filter evaluates every
    mention of an expression, and counting words is not cheap."""
    return F.abs(2 * n - (low + high)) <= high - low


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(WS_CHARS))


def remove_site_cruft(text: Column) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, p, ""), SITE_CRUFT, text)


def remove_section_markers(text: Column) -> Column:
    return F.regexp_replace(text, SECTION_MARKER, "")


def remove_parentheticals(text: Column) -> Column:
    return F.regexp_replace(text, PARENTHETICAL, "")


def remove_producer_tags(text: Column) -> Column:
    return F.regexp_replace(text, PRODUCER_TAG, "")


def squeeze_whitespace(text: Column) -> Column:
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    text = F.regexp_replace(text, r" *\n *", "\n")
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


# Steps of the cleaner that can be left out, and those that run unless told otherwise.
OPTIONAL_STEPS = frozenset(
    "fix_encoding normalize_unicode remove_section_markers remove_producer_tags remove_parentheticals lowercase".split()
)
USUAL_STEPS = OPTIONAL_STEPS - {"remove_parentheticals", "lowercase"}


def cleaning_steps(**switches: bool) -> frozenset[str]:
    """The usual steps with some switched on or off by name."""
    unknown = switches.keys() - OPTIONAL_STEPS
    if unknown:
        raise ValueError(f"no such cleaning step: {', '.join(sorted(unknown))}")
    return USUAL_STEPS.union(k for k, on in switches.items() if on).difference(k for k, on in switches.items() if not on)


def clean(
    df: DataFrame, text_col: str, out_col: str, steps: frozenset[str] = USUAL_STEPS
) -> DataFrame:
    """Add ``out_col``: the cleaned text; null gives the empty string.

    The text is staged in projections of its own around each trip to Python,
    so no rule is evaluated twice.
    """
    work = "_text"
    text = F.col(work)
    df = df.withColumn(work, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    if "fix_encoding" in steps:
        # One trip for both repairs: the character fixes that follow them do
        # not touch '&' or entity text, so the order is free.
        df = df.withColumn(work, _only_where(_repair_and_unescape, text, text.rlike("[ÂÃâð&]")))
        stage = tidy_characters(text)
    else:
        df = df.withColumn(work, unescape_html(text))
        stage = text
    stage = remove_site_cruft(stage)
    if "remove_section_markers" in steps:
        stage = remove_section_markers(stage)
    if "remove_parentheticals" in steps:
        stage = remove_parentheticals(stage)
    if "remove_producer_tags" in steps:
        stage = remove_producer_tags(stage)
    df = df.withColumn(work, stage)
    if "normalize_unicode" in steps:
        df = df.withColumn(work, nfkc(text))
    stage = squeeze_whitespace(text)
    if "lowercase" in steps:
        stage = F.lower(stage)
    return df.withColumn(out_col, strip(stage)).drop(work)


def words(text: Column) -> Column:
    """White-space separated words of ``text``; none for null or blank."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"(?U)[{WS}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def line_count(text: Column) -> Column:
    """Lines with something on them: the pieces between line breaks, where a
    break takes all white space around it."""
    stripped = strip(F.coalesce(text, F.lit("")))
    pieces = F.split(stripped, f"(?U)[{WS}]*[{LINE_BREAKS}][{WS}]*")
    return F.size(F.array_remove(pieces, ""))


def casefold_key(col: Column) -> Column:
    return F.lower(F.coalesce(col.cast("string"), F.lit("")))


def _accent_table() -> tuple[str, str]:
    """Latin letters with a mark -> their base letter, derived from NFKD."""
    source, target = "", ""
    for cp in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(cp))[0]
        if base.isascii() and base.isalpha():
            source, target = source + chr(cp), target + base
    return source, target


# Letters with a stroke or ligature have no decomposition.
_UNDECOMPOSED = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ı": "i"}
_LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}


def fold_accents(text: Column) -> Column:
    """Drop accents from Latin text without leaving the JVM."""
    source, target = _accent_table()
    source += "".join(_UNDECOMPOSED)
    target += "".join(_UNDECOMPOSED.values())
    text = F.translate(text, source, target)
    for letter, spelled in _LIGATURES.items():
        text = F.replace(text, F.lit(letter), F.lit(spelled))
    return F.regexp_replace(text, r"[\x{0300}-\x{036f}]", "")


def _plain_words(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def normalize_title(title: Column) -> Column:
    """Title without accents, credits, release suffixes or punctuation."""
    text = F.lower(fold_accents(F.coalesce(title, F.lit(""))))
    for pattern in (
        r"\s*[(\[]\s*(feat|ft|featuring)\b[^)\]]*[)\]]",
        r"\s+(feat|ft|featuring)\b.*$",
        r"\s+-\s+[^-]*\b(remaster(ed)?|mix|live|version)\b.*$",
    ):
        text = F.regexp_replace(text, pattern, "")
    return _plain_words(text)


def normalize_artist(artist: Column, primary_only: bool = False) -> Column:
    """Artist without accents or punctuation; optionally only the first name."""
    text = F.lower(fold_accents(F.coalesce(artist, F.lit(""))))
    if primary_only:
        text = F.split(text, r"\s*[,;]\s*|\s+(&|and)\s+")[0]
    return _plain_words(text)
