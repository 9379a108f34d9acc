r"""Text cleaning as column expressions.

All of these stay in the JVM.  The patterns follow Unicode classes, hence ``(?U)`` where ``\w``,
``\s`` or ``\b`` occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.binding import let

# Markers that replace redacted text.
URL_MARK = "redacted"
MENTION_MARK = "/mention"
EMAIL_MARK = "/email"
CENSOR_MARK = "CENSORED"

# Fixed value: the ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Code point ranges that count as emoji or symbol.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2500, 0x2BEF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
    (0x1F926, 0x1F937),
    (0x10000, 0x10FFFF),
    (0x2640, 0x2642),
    (0x2600, 0x2B55),
    (0x200D, 0x200D),
    (0x23CF, 0x23CF),
    (0x23E9, 0x23E9),
    (0x231A, 0x231A),
    (0xFE0F, 0xFE0F),
    (0x3030, 0x3030),
)
# A narrower class that leaves CJK, kana, Hangul and historic scripts alone.
STRICT_EMOJI_RANGES = (
    (0x1F000, 0x1FAFF),
    (0x2600, 0x27BF),
    (0x2B00, 0x2BFF),
    (0x2300, 0x23FF),
    (0x200D, 0x200D),
    (0xFE0F, 0xFE0F),
)

# One token is a redaction marker, a run of letters, marks, digits and underscores, or any
# other visible character on its own.
TOKEN_PATTERN = r"/email|/mention|[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]"
# The tokens that may touch their neighbours: everything but the words.
MARK_PATTERN = r"/email|/mention|[^\s\p{L}\p{M}\p{N}_]"


def _where(text: Column, needle: str, replaced) -> Column:
    """``replaced(text)`` for texts that contain ``needle``; spares the others the regex."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(needle)), replaced(t)).otherwise(t))


def redact_urls(text: Column) -> Column:
    return _where(text, "http", lambda t: F.regexp_replace(t, r"(?U)http\S+", URL_MARK))


def remove_latin_words(text: Column, keep_marks: bool = False) -> Column:
    """Remove words of ASCII letters; ``keep_marks`` spares the redaction markers."""
    if keep_marks:
        return F.regexp_replace(text, rf"(?U)({EMAIL_MARK}\b|{MENTION_MARK}\b|\b{URL_MARK}\b)|\b[a-zA-Z]+\b", "$1")
    return F.regexp_replace(text, r"(?U)\b[a-zA-Z]+\b", "")


def strip_html_tags(text: Column) -> Column:
    return _where(text, "<", lambda t: F.regexp_replace(t, "(?d)<.*?>", ""))


def redact_mentions(text: Column) -> Column:
    return _where(text, "@", lambda t: F.regexp_replace(t, r"(?U)@\w+", MENTION_MARK))


def redact_emails(text: Column) -> Column:
    return _where(text, "@", lambda t: F.regexp_replace(t, r"(?U)\S+@\S+", EMAIL_MARK))


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_text(text: Column) -> Column:
    """Without whitespace of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def remove_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def emoji_pattern(ranges: Sequence[tuple[int, int]] = EMOJI_RANGES) -> str:
    """A character class for ``ranges``, overlapping ones merged."""
    merged: list[list[int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return "[" + "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in merged) + "]+"


def remove_emojis(text: Column, strict: bool = False) -> Column:
    """Replace each run of emoji by one space; ``strict`` spares CJK and other astral text."""
    return F.regexp_replace(text, emoji_pattern(STRICT_EMOJI_RANGES if strict else EMOJI_RANGES), " ")


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def word_list(words: Sequence[str]) -> list[str]:
    """The words, trimmed and in lower case, each once."""
    return sorted({w.strip().lower() for w in words} - {""})


def listed(word: Column, words: Sequence[str]) -> Column:
    """Whether ``word``, in lower case, is one of ``words``; Spark looks longer lists up in a hash set."""
    return F.lower(word).isin(word_list(words))


def censor_words(text: Column, words: Sequence[str], mark: str = CENSOR_MARK) -> Column:
    """Replace listed words (compared in lower case) and join the tokens by one space."""
    spaced = collapse_whitespace(F.regexp_replace(text, MARK_PATTERN, " $0 "))
    if not word_list(words):
        return spaced
    kept = F.transform(F.split(spaced, " "), lambda w: F.when(listed(w, words), F.lit(mark)).otherwise(w))
    return F.array_join(kept, " ")


def remove_stopwords(tokens: Column, stop_words: Sequence[str]) -> Column:
    """The tokens that are not stop words."""
    if not word_list(stop_words):
        return tokens
    return F.filter(tokens, lambda w: ~listed(w, stop_words))


# Cleaning steps by name, and the orders they are usually taken in.
STEPS = {
    "latin": remove_latin_words,
    "latin_but_marks": lambda t: remove_latin_words(t, keep_marks=True),
    "emails": redact_emails,
    "urls": redact_urls,
    "mentions": redact_mentions,
    "tags": strip_html_tags,
}
ORDERS = {
    "default": ("latin", "emails", "urls", "mentions", "tags"),
    "redact_first": ("emails", "urls", "mentions", "tags", "latin_but_marks"),
}


def clean_text(
    text: Column,
    sensitive: Sequence[str] = (),
    steps: str | Sequence[str] = "default",
    strict_emoji: bool = False,
) -> Column:
    """The cleaning chain for one text column; null becomes a single space.

    ``steps`` is a key of ``ORDERS`` or a sequence of names from ``STEPS``; censoring, collapsing
    whitespace and removing emoji always follow.  ``redact_first`` redacts addresses and tags
    before Latin words are removed, so that no word removal can break an address apart.
    """
    for name in ORDERS[steps] if isinstance(steps, str) else steps:
        text = STEPS[name](text)
    # The censor leaves single spaces between tokens and none at the ends.
    text = censor_words(text, sensitive)
    return F.coalesce(remove_emojis(text, strict_emoji), F.lit(" "))


def fix_mojibake(text: Column) -> Column:
    """Undo UTF-8 text that was read as Latin-1; text with wider characters is kept as it is."""
    narrow = F.when(text.rlike(r"^[\x00-\xff]*$"), text)
    return F.coalesce(F.decode(F.encode(narrow, "ISO-8859-1"), "UTF-8"), text)


def normalize_text(text: Column) -> Column:
    """Lower case, trimmed, every run of whitespace one space."""
    return collapse_whitespace(F.lower(text))


def squeeze_commas(text: Column) -> Column:
    return F.replace(text, F.lit(",,"), F.lit(","))


def split_clauses(text: Column) -> Column:
    """Comma-separated clauses, trimmed, blank ones removed."""
    return F.filter(F.transform(F.split(text, ","), lambda c: strip_text(c)), lambda c: c != "")


def length_band(text: Column, shortest: int = 16, longest: int = 512) -> Column:
    """The text where its length lies in the band, else null."""
    return F.when(F.char_length(text).between(shortest, longest), text)


def lower_first(text: Column) -> Column:
    return F.concat(F.lower(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{Nd}]", "")
