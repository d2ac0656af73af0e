"""Text scalar functions (Column -> Column), all JVM-side built-ins."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.config import KEY_PATTERN

# Whitespace class used everywhere: Java's ``\s`` plus the no-break space,
# which spreadsheet exports often contain (Java's ``\s`` does not match it).
WS_CLASS = "[\\s\\u00A0]"


def _folded(ch: str) -> str:
    """NFKD without combining marks, of one character."""
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


#: beyond this, letters are rare enough for a look-up per character
_COMMON_END = 0x0250
_SYLLABLES = (0xAC00, 0xD7A3)


def _accent_table() -> tuple[str, str]:
    """Single-character accent folding table built from a rule.

    For every code point from the Latin-1 Supplement to Latin Extended-B, and
    of Latin Extended Additional, the NFKD decomposition with combining marks
    removed is computed; code points folding to exactly one different
    character form the table (é -> e, Ç -> C, no-break space -> space, ...).
    """
    src, dst = [], []
    for code in [*range(0x00A0, _COMMON_END), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        folded = _folded(ch)
        if len(folded) == 1 and folded != ch:
            src.append(ch)
            dst.append(folded)
    return "".join(src), "".join(dst)


def _expansions() -> tuple[str, list[str]]:
    """All other characters of the basic plane that fold to something else
    (ligatures, full-width forms, fractions, ...), by the same rule.  Hangul
    syllables follow a formula instead."""
    keys, values = [], []
    for code in range(0x00A0, 0xFFFF):
        ch = chr(code)
        if ch in ACCENTED or _SYLLABLES[0] <= code <= _SYLLABLES[1] or 0xD800 <= code < 0xE000 or unicodedata.combining(ch):
            continue
        folded = _folded(ch)
        if folded != ch:
            keys.append(ch)
            values.append(folded)
    return "".join(keys), values


def _char_class(chars: list[int]) -> str:
    """A regular expression class of code points, as ranges."""
    runs: list[list[int]] = []
    for code in chars:
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\u{a:04X}-\\u{b:04X}" for a, b in runs) + "]"


ACCENTED, UNACCENTED = _accent_table()
_KEYS, _VALUES = _expansions()
_SEPARATOR = "\u0001"

#: combining marks (accents that follow their letter): combining class not 0
COMBINING = _char_class([c for c in range(0x10000) if unicodedata.combining(chr(c))])
#: rows with one of these are folded character by character
_RARE = _char_class(sorted([ord(c) for c in _KEYS] + list(range(_SYLLABLES[0], _SYLLABLES[1] + 1))))
#: anything but letters that stay or take the table of single letters
_UNCOMMON = "[^\\u0000-\\u007F" + _char_class([c for c in range(0x80, _COMMON_END) if chr(c) not in _KEYS])[1:]
#: what ``str.strip`` removes
_ALL_BLANKS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of WS_CLASS, for the regex-free ``btrim``.
WS_CHARS = " \t\n\u000b\f\r\u00a0"


def strip_ws(c: Column | str) -> Column:
    """Remove leading/trailing whitespace (including no-break space)."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def _code_text(code: Column) -> Column:
    """The character of a code point of the basic plane."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _fold_character(c: Column) -> Column:
    """NFKD of a character that the accent table leaves alone."""
    place = F.instr(F.lit(_KEYS), c)
    syllable = F.ascii(c) - _SYLLABLES[0]
    # leading consonant, vowel and (unless there is none) trailing consonant
    jamo = F.concat(
        _code_text(F.lit(0x1100) + F.floor(syllable / 588)),
        _code_text(F.lit(0x1161) + F.floor(F.pmod(syllable, F.lit(588)) / 28)),
        F.when(F.pmod(syllable, F.lit(28)) > 0, _code_text(F.lit(0x11A7) + F.pmod(syllable, F.lit(28)))).otherwise(F.lit("")),
    )
    values = F.split(F.lit(_SEPARATOR.join(_VALUES)), _SEPARATOR)
    return F.when(place > 0, F.get(values, place - 1)).when(F.ascii(c).between(*_SYLLABLES), jamo).otherwise(c)


def normalise_text(c: Column | str) -> Column:
    """strip, lower-case, NFKD, drop accents; NULL becomes ''.

    Most rows take a table of single letters; only those with a character that
    folds to several (or to one outside that table) are taken apart.  Equal
    to the Unicode database on the basic plane; characters beyond it stay.
    """
    base = F.lower(F.btrim(F.coalesce(col_(c).cast("string"), F.lit("")), F.lit(_ALL_BLANKS)))
    taken_apart = F.array_join(F.transform(F.split(base, ""), _fold_character), "")
    whole = F.when(base.rlike(_RARE), taken_apart).otherwise(base)
    # composed letters by the table, decomposed ones by dropping their marks
    marked = F.regexp_replace(F.translate(whole, ACCENTED, UNACCENTED), COMBINING, "")
    return F.when(base.rlike(_UNCOMMON), marked).otherwise(F.translate(base, ACCENTED, UNACCENTED))


def fold_label(c: Column | str) -> Column:
    """trim blanks, collapse inner whitespace runs to one blank, lower."""
    return F.lower(F.regexp_replace(F.trim(col_(c)), f"{WS_CLASS}+", " "))


def fold_literal(label: str) -> str:
    """Driver-side twin of :func:`fold_label` for configuration labels."""
    return " ".join(label.strip().split()).lower()


def pseudonym(c: Column | str, salt: str | Column) -> Column:
    """``sal_`` + first 12 hex digits of sha256(salt | id)."""
    salt_col = salt if isinstance(salt, Column) else F.lit(salt)
    digest = F.sha2(F.concat(salt_col, F.lit("|"), col_(c).cast("string")), 256)
    return F.concat(F.lit("sal_"), F.substring(digest, 1, 12))


def instant_text(c: Column | str) -> Column:
    """Explicit, zone-independent text of an instant (microsecond precision)."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def dedup_digest(key, instant, label, duration, distance, source) -> Column:
    """md5 of the pipe-joined duplicate key of an activity.

    NULL parts are skipped by ``concat_ws`` (as in the reference); distance
    NULL is rendered -1 and the source is trimmed, NULL -> ''.
    """
    return F.md5(
        F.concat_ws(
            "|",
            col_(key),
            instant_text(instant),
            col_(label),
            col_(duration).cast("string"),
            F.coalesce(col_(distance), F.lit(-1)).cast("string"),
            F.coalesce(F.trim(col_(source)), F.lit("")),
        )
    )


def strip_quotes(c: Column | str) -> Column:
    """trim, then remove outer double quotes (repeated), NULL -> ''."""
    trimmed = strip_ws(F.coalesce(col_(c), F.lit("")))
    return F.btrim(trimmed, F.lit('"'))


def quote_comment(c: Column | str) -> Column:
    """trimmed, unquoted comment wrapped in double quotes when non-empty."""
    inner = strip_ws(strip_quotes(c))
    return F.when(F.length(inner) > 0, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(F.lit(""))


def valid_key(c: Column | str) -> Column:
    """pseudonymised key format check."""
    return F.coalesce(col_(c).rlike(KEY_PATTERN), F.lit(False))

