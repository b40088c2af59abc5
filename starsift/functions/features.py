"""Scalar review features as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def char_count(c: Column) -> Column:
    return F.length(filled(c))


def avg_word_len(c: Column) -> Column:
    """Mean token length: non-space characters over tokens; 0 without tokens."""
    n = tx.word_count(c)
    chars = F.length(F.regexp_replace(filled(c), tx.SPACES, ""))
    return F.when(n > 0, chars / n).otherwise(0.0)


def avg_sentence_len(n_words: Column, n_sentences: Column) -> Column:
    return F.when(n_sentences > 0, n_words / n_sentences).otherwise(0.0)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(filled(c), F.lit(pattern))


# a token of two or more characters with an upper-case and no lower-case letter
CAPS_WORD = f"(?<![^{fv.SPACE}])(?=[^{fv.SPACE}]*\\p{{Lu}})[^{fv.SPACE}\\p{{Ll}}]{{2,}}(?![^{fv.SPACE}])"


def caps_word_count(c: Column) -> Column:
    return count_of(c, CAPS_WORD)


def has_number(c: Column) -> Column:
    return filled(c).rlike(r"\p{Nd}").cast("int")


def number_count(c: Column) -> Column:
    return count_of(c, r"(?U)\b\p{Nd}+\b")


def has_price(c: Column) -> Column:
    return filled(c).rlike(r"(?i)₹|\$|rs\.|price|cost").cast("int")


def lexicon_hits(tokens: Column, lexicon) -> Column:
    """Number of distinct tokens found in the lexicon."""
    return F.size(F.filter(F.array_distinct(tokens), lambda t: t.isin(*lexicon)))


def caps_letter_ratio(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[A-Z]")) / F.greatest(F.length(c), F.lit(1))


def caps_entity_density(c: Column) -> Column:
    """Words after the first that start with a capital, over all words."""
    n = tx.word_count(c)
    caps = F.regexp_count(tx.strip(filled(c)), F.lit(f"(?<=[{fv.SPACE}])\\p{{Lu}}"))
    return F.when(n > 1, caps / n).otherwise(0.0)


def aspect_density(c: Column, aspects=tuple(fv.HELPFULNESS_ASPECTS)) -> Column:
    low, n = F.lower(c), tx.word_count(c)
    found = sum((low.contains(a).cast("int") for a in aspects), F.lit(0))
    return F.when(n > 0, found / n).otherwise(0.0)


def topic_flag(c: Column, aspects=tuple(fv.HELPFULNESS_ASPECTS)) -> Column:
    return tx.contains_any(F.lower(c), aspects).cast("int")


def helpfulness_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def linguistic_features(c: Column) -> dict[str, Column]:
    """Ten writing-quality signals; the sentence count keeps blank trailing pieces."""
    low = F.lower(filled(c))
    n = tx.word_count(c)
    return {
        "ling_word_count": n,
        "ling_sentence_count": F.size(F.split(filled(c), "[.!?]+")),
        "ling_avg_word_len": avg_word_len(c),
        "ling_char_count": char_count(c),
        "ling_vocab_richness": F.size(F.array_distinct(tx.words(low))) / F.greatest(n, F.lit(1)),
        "ling_exclamation_count": count_of(c, "!"),
        "ling_question_count": count_of(c, r"\?"),
        "ling_caps_word_count": caps_word_count(c),
        "ling_has_numbers": has_number(c),
        "ling_has_comparison": tx.contains_word(low, ["vs", "compared", "versus", "better", "worse"]).cast("int"),
        "ling_has_concession": tx.contains_word(
            low, ["however", "but", "although", "despite", "downside"]
        ).cast("int"),
    }


def date_features(ts: Column) -> dict[str, Column]:
    """Year, month, weekday with Monday as 0, weekend flag."""
    dow = F.weekday(ts)
    return {
        "review_year": F.year(ts),
        "review_month": F.month(ts),
        "review_dow": dow,
        "is_weekend": (dow >= 5).cast("int"),
    }
