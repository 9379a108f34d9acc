"""Languages: names and codes, and detection by stop words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.binding import let
from parley.functions.text import tokenize

# Language names and codes of the translation service.
LANGUAGE_CODES = {
    "afrikaans": "af",
    "albanian": "sq",
    "amharic": "am",
    "arabic": "ar",
    "armenian": "hy",
    "azerbaijani": "az",
    "basque": "eu",
    "belarusian": "be",
    "bengali": "bn",
    "bosnian": "bs",
    "bulgarian": "bg",
    "catalan": "ca",
    "cebuano": "ceb",
    "chichewa": "ny",
    "chinese (simplified)": "zh-cn",
    "chinese (traditional)": "zh-tw",
    "corsican": "co",
    "croatian": "hr",
    "czech": "cs",
    "danish": "da",
    "dutch": "nl",
    "english": "en",
    "esperanto": "eo",
    "estonian": "et",
    "filipino": "tl",
    "finnish": "fi",
    "french": "fr",
    "frisian": "fy",
    "galician": "gl",
    "georgian": "ka",
    "german": "de",
    "greek": "el",
    "gujarati": "gu",
    "haitian creole": "ht",
    "hausa": "ha",
    "hawaiian": "haw",
    "hebrew": "he",
    "hindi": "hi",
    "hmong": "hmn",
    "hungarian": "hu",
    "icelandic": "is",
    "igbo": "ig",
    "indonesian": "id",
    "irish": "ga",
    "italian": "it",
    "japanese": "ja",
    "javanese": "jw",
    "kannada": "kn",
    "kazakh": "kk",
    "khmer": "km",
    "korean": "ko",
    "kurdish (kurmanji)": "ku",
    "kyrgyz": "ky",
    "lao": "lo",
    "latin": "la",
    "latvian": "lv",
    "lithuanian": "lt",
    "luxembourgish": "lb",
    "macedonian": "mk",
    "malagasy": "mg",
    "malay": "ms",
    "malayalam": "ml",
    "maltese": "mt",
    "maori": "mi",
    "marathi": "mr",
    "mongolian": "mn",
    "myanmar (burmese)": "my",
    "nepali": "ne",
    "norwegian": "no",
    "odia": "or",
    "pashto": "ps",
    "persian": "fa",
    "polish": "pl",
    "portuguese": "pt",
    "punjabi": "pa",
    "romanian": "ro",
    "russian": "ru",
    "samoan": "sm",
    "scots gaelic": "gd",
    "serbian": "sr",
    "sesotho": "st",
    "shona": "sn",
    "sindhi": "sd",
    "sinhala": "si",
    "slovak": "sk",
    "slovenian": "sl",
    "somali": "so",
    "spanish": "es",
    "sundanese": "su",
    "swahili": "sw",
    "swedish": "sv",
    "tajik": "tg",
    "tamil": "ta",
    "telugu": "te",
    "thai": "th",
    "turkish": "tr",
    "ukrainian": "uk",
    "urdu": "ur",
    "uyghur": "ug",
    "uzbek": "uz",
    "vietnamese": "vi",
    "welsh": "cy",
    "xhosa": "xh",
    "yiddish": "yi",
    "yoruba": "yo",
    "zulu": "zu",
}

# A few very frequent words per language, enough to tell these languages apart.
COMMON_WORDS = {
    "de": ("der", "die", "das", "und", "in", "zu", "den", "ist", "nicht", "von"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "was", "for", "with"),
    "es": ("el", "la", "de", "que", "y", "en", "los", "se", "un", "por"),
    "fr": ("le", "la", "les", "des", "et", "en", "un", "une", "que", "du"),
    "uk": ("і", "в", "не", "на", "що", "з", "до", "це", "як", "та"),
}


def language_table(spark: SparkSession) -> DataFrame:
    """Language names and codes as a table."""
    return spark.createDataFrame(list(LANGUAGE_CODES.items()), "name string, code string")


def with_language_name(df: DataFrame, code: str = "lang") -> DataFrame:
    """Add ``language_name`` for the language code in ``code``; null for an unknown code."""
    names = language_table(df.sparkSession).select(F.col("code").alias(code), F.col("name").alias("language_name"))
    return df.join(F.broadcast(names), code, "left")  # one row per known language


def is_known_language(code: Column) -> Column:
    return F.lower(code).isin(list(LANGUAGE_CODES.values()))


def detect_language(text: Column, words: Mapping[str, Sequence[str]] = COMMON_WORDS) -> Column:
    """The language with the most common words in the whole text; null if none occurs.

    On a tie the alphabetically first code wins.  The lists are literals, so the test is a plain
    projection: no explode, no join.
    """
    def count(tokens, listed):
        return F.size(F.filter(tokens, lambda w: w.isin(list(listed))))

    def best(tokens):
        hits = [
            F.struct(count(tokens, words[code]).alias("hits"), F.lit(-rank).alias("rank"), F.lit(code).alias("code"))
            for rank, code in enumerate(sorted(words))
        ]
        return let(F.array_max(F.array(*hits)), lambda top: F.when(top["hits"] > 0, top["code"]))

    return let(F.transform(tokenize(text), F.lower), best)


def with_detected_language(df: DataFrame, column: str, words: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    return df.withColumn("detected", detect_language(F.col(column), words))
