"""Text cleaning, tokens and hashtags as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The removal classes and their patterns.
REMOVAL_PATTERNS = {
    "urls": r"(https?\://)\S+",
    "punctuation": r"[^a-zA-Z0-9]",
    "digits": r"\b\d+\b",
    "smallWords": r"\b[a-zA-Z0-9]{1,2}\b",
    "whiteSpace": r"\s+",
}

MAX_STOPWORDS = 50_000


def remove_class(text: Column, name: str) -> Column:
    """Replace every match of one removal class by a blank; unknown classes change nothing."""
    pattern = REMOVAL_PATTERNS.get(name)
    return text if pattern is None else F.regexp_replace(text, pattern, " ")


# A whole run of three or more letters and digits with at least one letter, in lower-case text.
# Nothing is tried from inside a run, so long runs of digits take linear time.
KEPT_WORD = r"(?<![a-z0-9])(?=[0-9]*+[a-z])[a-z0-9]{3,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name so that ``body`` can use it often but compute it once."""
    return F.transform(F.array(value), body)[0]


def _lower_without_urls(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.contains("://"), F.regexp_replace(low, REMOVAL_PATTERNS["urls"], " ")).otherwise(low)


def _kept_words(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit(KEPT_WORD), F.lit(0))


def _joined(low: Column, words: Column) -> Column:
    """The words with one blank between them, and one at an end where something was removed."""
    first, last = F.get(words, F.lit(0)), F.get(words, F.size(words) - 1)
    lead = F.when(low.startswith(first), "").otherwise(" ")
    trail = F.when(low.endswith(last), "").otherwise(" ")
    empty = F.when(low == "", "").otherwise(" ")
    return F.when(F.size(words) == 0, empty).otherwise(F.concat(lead, F.array_join(words, " "), trail))


def clean_words(text: Column) -> Column:
    """The words that ``clean_document`` keeps, as an array."""
    return _kept_words(_lower_without_urls(text))


def clean_document(text: Column) -> Column:
    """Lower-case words of three or more letters, blank-separated, without URLs and numbers.

    Gives what applying the five classes in order gives, by picking out what stays instead of
    replacing what goes. A blank stays at an end where something was removed, as do stop words.
    """
    return let(_lower_without_urls(text), lambda low: let(_kept_words(low), lambda w: _joined(low, w)))


def clean_parts(text: Column) -> Column:
    """struct(text, words): the cleaned document and its words from one pass."""
    return let(_lower_without_urls(text), lambda low: let(_kept_words(low), lambda w: F.struct(
        _joined(low, w).alias("text"), w.alias("words"))))


def drop_stopwords(text: Column, stopwords: Sequence[str]) -> Column:
    """Remove stop words from blank-separated text; order and repeats of the rest stay."""
    words = F.split(F.rtrim(text), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(list(stopwords))), " ")


def clean_without_stopwords(text: Column, stopwords: Sequence[str]) -> Column:
    return drop_stopwords(clean_document(text), stopwords)


def alphabetic_words(text: Column, stopwords: Sequence[str]) -> Column:
    """Word tokens made of letters only, stop words dropped, re-joined by one blank."""
    tokens = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"))
    keep = F.filter(tokens, lambda w: w.rlike(r"^\p{L}+$") & ~w.isin(list(stopwords)))
    return F.array_join(keep, " ")


# What the Penn Treebank conventions split off words. Commas and colons stay inside numbers.
SPLIT_SIGNS = r"([;@#$%&?!()\[\]{}<>\"“”…]|--|``|'')"
SPLIT_MARKS = r"([:,])([^0-9]|$)"
CONTRACTION = r"(?i)^(\p{L}+?)(n't|'s|'m|'d|'ll|'re|'ve)$"
JOINED_WORDS = r"(?i)^(can|gon|got|lem|gim|wan)(not|na|ta|me)$"
JOINED_KNOWN = ("cannot", "gonna", "gotta", "lemme", "gimme", "wanna")
SENTENCE_BEGIN = r"^[\p{Lu}\"'(“]"


def word_tokens(text: Column) -> Column:
    """Word tokens by the Treebank conventions, without the second part of a contraction: signs and brackets
    are split off, so is a full stop at the end of a sentence (of the text, or before a capital or an opening sign);
    ``don't`` is ``do`` and ``n't``, ``cannot`` two words; hyphens, slashes and inner full stops do not split."""
    padded = F.regexp_replace(F.regexp_replace(text, SPLIT_SIGNS, " $1 "), SPLIT_MARKS, " $1 $2")
    tokens = F.regexp_extract_all(padded, F.lit(r"([^\s]+)"))

    def alone(every: Column) -> Column:
        def word(token: Column, i: Column) -> Column:
            after = F.get(every, i + 1)
            ends = token.endswith(".") & (after.isNull() | after.rlike(SENTENCE_BEGIN))
            bare = F.when(ends, F.regexp_replace(token, r"\.$", "")).otherwise(token)
            short = F.regexp_replace(bare, CONTRACTION, "$1")
            return F.when(F.lower(short).isin(*JOINED_KNOWN), F.regexp_replace(short, JOINED_WORDS, "$1 $2")).otherwise(short)

        return F.transform(every, word)

    return F.regexp_extract_all(F.array_join(let(tokens, alone), " "), F.lit(r"([^\s]+)"))


def alphabetic_tokens(text: Column, stopwords: Sequence[str]) -> Column:
    """Word tokens (``word_tokens``) made of letters only, stop words dropped, re-joined by one blank."""
    keep = F.filter(word_tokens(text), lambda w: w.rlike(r"^\p{L}+$") & ~w.isin(list(stopwords)))
    return F.array_join(keep, " ")


def sanitize_body(body: Column) -> Column:
    """Delete commas and double quotes."""
    return F.translate(body, ',"', "")


def hashtag_marks(text: Column) -> Column:
    """Number of ``#`` characters."""
    return F.length(text) - F.length(F.replace(text, F.lit("#"), F.lit("")))


def hashtags(text: Column) -> Column:
    """Array of the words that follow a ``#``."""
    return F.regexp_extract_all(text, F.lit(r"#(\w+)"))


def joined_row(*cols: Column) -> Column:
    """Comma-joined row; nulls become empty fields."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def default_stopwords() -> list[str]:
    """Spark's own English list; callers may pass any other."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def load_stopwords(spark: SparkSession, path: str) -> list[str]:
    """One word per line. The list becomes part of the query, so its size is checked."""
    rows = spark.read.text(path).distinct().limit(MAX_STOPWORDS + 1).collect()
    if len(rows) > MAX_STOPWORDS:
        raise ValueError(f"more than {MAX_STOPWORDS} stop words in {path}")
    return sorted(r.value for r in rows if r.value)
