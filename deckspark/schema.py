"""Data model: index type, deck column naming, fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# A card index: integer part = root note, +0.001*n = alternative meaning,
# +0.0001*n = user-added word.  Held as decimal so equality is exact.
IDX = T.DecimalType(18, 6)
IDX_SQL = "decimal(18,6)"

# ---- fixed values (must equal the reference's for identical results) ----
# German definite articles and their one-letter gender codes, in this order.
ARTICLES_FULL = ["die", "der", "das"]
ARTICLES_SHORT = ["f", "m", "n"]
# Tokens dropped from a lemmatised sentence.
DROPPED_TOKENS = ["-", "--", " ", "  ", "„", "“"]
# Rare-word rule: a sentence needs >= 2 other tokens seen <= 3 times in the deck.
RARE_MIN_COUNT_IN_SENTENCE = 2
RARE_MAX_OCCURRENCES = 3
# Fraction bands of the index.
ALT_STEP = "0.001"
CUSTOM_STEP = "0.0001"
RESERVED_FRACTION = "0.01"
# Frequency-rank cut points of the three deck parts.
RANK_CUTOFFS = [1700, 3400]
# Length bands for example sentences.
SENTENCE_LEN_GENERATED = (60, 70)
SENTENCE_LEN_SHORT = (30, 45)
# Request cost defaults: per message 4 tokens, reply primer 2, n=1, max_tokens=15.
COST_PER_MESSAGE = 4
COST_REPLY_PRIMER = 2
COST_DEFAULT_N = 1
COST_DEFAULT_MAX_TOKENS = 15
# Throughput limits (half of the provider's).
LIMIT_REQUESTS_PER_MINUTE = 1500
LIMIT_TOKENS_PER_MINUTE = 125000
COOLDOWN_SECONDS = 15
MAX_ATTEMPTS = 3
# Translation blocks.
BLOCK_MAX_SYMBOLS = 3000
BLOCK_MARGIN = 3
# -------------------------------------------------------------------------

ROLES = ["word", "sentence", "sentence_lemmatized", "part_of_speech"]


def language_columns(lang_1: str, lang_2: str) -> dict[str, str]:
    """Map role columns (``word_1``, ``sentence_2`` ...) to language-coded names."""
    out = {}
    for role in ROLES:
        out[f"{role}_1"] = f"{role}_{lang_1}"
        out[f"{role}_2"] = f"{role}_{lang_2}"
    return out


DECK_COLUMNS = ["idx", "word", "part_of_speech", "translation", "sentence", "sentence_translation", "sentence_lemmatized"]


def deck_schema(extra: list[str] | None = None) -> T.StructType:
    fields = [T.StructField("idx", IDX, True)]
    for c in DECK_COLUMNS[1:] + (extra or []):
        fields.append(T.StructField(c, T.StringType(), True))
    return T.StructType(fields)


STORY_SCHEMA = T.StructType(
    [
        T.StructField("n", T.IntegerType(), True),
        T.StructField("header", T.StringType(), True),
        T.StructField("body", T.ArrayType(T.StringType()), True),
    ]
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("author", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)
