"""Text cleaning and tokenising as Column expressions (no Python in the data path).

``\\w`` and ``\\s`` are spelled out as explicit Unicode classes because Java's
defaults are ASCII-only and would strip accented letters.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift import fixed_values as fv

NON_WORD = f"[^{fv.WORD}{fv.SPACE}]"
SPACES = f"[{fv.SPACE}]+"
TOKEN = f"[^{fv.SPACE}]+"


def collapse(c: Column) -> Column:
    """Collapse whitespace runs to one space and strip the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACES}|{SPACES}$", "")


def words(c: Column) -> Column:
    """Whitespace tokens; blank or null text gives an empty array."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(TOKEN), F.lit(0))


def word_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(TOKEN))


def sentences(c: Column) -> Column:
    """Sentences ending in . ! ? followed by whitespace; blanks dropped."""
    marked = F.regexp_replace(F.coalesce(c, F.lit("")), f"([.!?]+)[{fv.SPACE}]+", "$1\u0001")
    parts = F.transform(F.split(marked, "\u0001"), strip)
    return F.filter(parts, lambda s: s != "")


def sentence_pieces(c: Column) -> Column:
    """Readability split: pieces between runs of . ! ?, blanks dropped."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), "[.!?]+"), lambda s: strip(s) != "")


def remove_symbols(c: Column) -> Column:
    """Keep ASCII, Latin-1 letters and Latin Extended-A; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x00-\x7F\x{00C0}-\x{017F}]", "")


def clean_review_text(c: Column) -> Column:
    """Drop tags and URLs, then symbols, then collapse whitespace; null becomes empty."""
    untagged = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]*>", " ")
    unlinked = F.regexp_replace(untagged, f"https?://{TOKEN}|www\\.{TOKEN}", " ")
    return collapse(remove_symbols(unlinked))


def is_likely_english(c: Column, threshold: float = 0.8) -> Column:
    """Share of ASCII letters, whitespace and basic punctuation reaches the threshold."""
    plain = F.regexp_count(c, F.lit(f"[a-zA-Z{fv.SPACE}.,!?'\"-]"))
    return F.coalesce((F.length(c) > 0) & (plain / F.greatest(F.length(c), F.lit(1)) >= threshold), F.lit(False))


def merge_summary_text(summary: Column, text: Column) -> Column:
    """``summary. text``; no extra stop when the summary already ends a sentence."""
    return (
        F.when(summary == "", text)
        .when(F.substring(summary, -1, 1).isin(".", "!", "?"), F.concat(summary, F.lit(" "), text))
        .otherwise(F.concat(summary, F.lit(". "), text))
    )


def merge_raw(summary: Column, text: Column) -> Column:
    """Always ``summary. text`` when a summary is present."""
    present = summary.isNotNull() & (summary != "")
    return F.when(present, F.concat(summary, F.lit(". "), text)).otherwise(text)


def _lower_no_links(c: Column, tag: str) -> Column:
    unlinked = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"http{TOKEN}|www\\.{TOKEN}", " ")
    return F.regexp_replace(unlinked, tag, " ")


def clean_text_num(c: Column) -> Column:
    """Lower, no URLs/tags/punctuation, digit runs become the token NUM."""
    plain = F.regexp_replace(_lower_no_links(c, "<[^\\n]*?>"), NON_WORD, " ")
    return collapse(F.regexp_replace(plain, r"\p{Nd}+", " NUM "))


def clean_text_nodigits(c: Column) -> Column:
    """Lower, no URLs/tags/punctuation/digits."""
    plain = F.regexp_replace(_lower_no_links(c, "<[^>]+>"), NON_WORD, " ")
    return collapse(F.regexp_replace(plain, r"\p{Nd}+", " "))


def clean_job_text(c: Column) -> Column:
    """Lower, keeps ``. , + #``, spells out C++ and C#, drops "N years"."""
    kept = F.regexp_replace(_lower_no_links(c, "<[^>]+>"), f"[^{fv.WORD}{fv.SPACE}.,+#]", " ")
    named = F.regexp_replace(F.regexp_replace(kept, r"c\+\+", "cpp"), "c#", "csharp")
    return collapse(F.regexp_replace(named, r"\b[0-9]+\+?\s*years?\b", " "))


def drop_stop_words(tokens: Column, stop_words, min_len: int) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*stop_words) & (F.length(t) >= min_len))


def lemmatize(tokens: Column, lemma_map: Column | None) -> Column:
    """Replace tokens by their lemma from a small map column; identity when absent."""
    if lemma_map is None:
        return tokens
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(lemma_map, t), t))


def preprocess_text(
    c: Column, min_len: int = 2, stop_words=fv.REVIEW_STOP_WORDS, lemma_map=None, digits: str = "NUM"
) -> Column:
    """Clean, tokenise, drop stop words and short tokens, lemmatise, rejoin."""
    cleaned = clean_text_num(c) if digits == "NUM" else clean_text_nodigits(c)
    return F.array_join(lemmatize(drop_stop_words(words(cleaned), stop_words, min_len), lemma_map), " ")


def preprocess_light(c: Column, min_len: int = 3, stop_words=fv.REVIEW_STOP_WORDS) -> Column:
    """Lower, punctuation to space, stop words and short tokens dropped (no lemmas)."""
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), NON_WORD, " ")
    return F.array_join(drop_stop_words(words(plain), stop_words, min_len), " ")


def prep_lda(c: Column, stop_words=fv.REVIEW_STOP_WORDS) -> Column:
    return preprocess_light(c, 4, stop_words)


def filter_tokens(tokens: Column, stop_words, min_len: int = 2, max_len: int = 40) -> Column:
    """Drop stop words, punctuation, tokens outside the length range and numbers."""
    return F.filter(
        tokens,
        lambda t: ~t.isin(*stop_words)
        & F.length(t).between(min_len, max_len)
        & t.rlike("[\\p{L}\\p{N}]")
        & ~t.rlike("^\\p{N}+$"),
    )


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token array (empty when the array is shorter than n).

    Shifted copies of the array are zipped, so the array expression is evaluated
    n times per row and never once per n-gram.
    """
    length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    grams = F.slice(tokens, 1, length)
    for shift in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, shift + 1, length), lambda a, b: F.concat_ws(" ", a, b))
    return grams


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row, however often ``v`` occurs in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def job_tokens(c: Column) -> Column:
    """Word tokens with detached punctuation (``3.5`` and ``b2b`` stay whole)."""
    return F.regexp_extract_all(
        F.coalesce(c, F.lit("")), F.lit(f"[{fv.WORD}]+(?:[.'+#-][{fv.WORD}]+)*|[^{fv.WORD}{fv.SPACE}]"), F.lit(0)
    )


def contains_any(c: Column, keywords) -> Column:
    """Any keyword occurs as a substring (case-sensitive; pass a lower-cased column).

    Byte searches are several times cheaper than one alternation pattern.
    """
    hit = reduce(lambda a, b: a | b, (F.contains(c, F.lit(k)) for k in keywords))
    return F.coalesce(hit, F.lit(False))


def contains_word_in(padded: Column, keywords) -> Column:
    """Any single-word keyword occurs in text padded by :func:`spaced`."""
    return contains_any(padded, [f" {k} " for k in keywords])


def contains_word(c: Column, keywords) -> Column:
    """Any keyword occurs on word boundaries (pass lower-cased text)."""
    return F.coalesce(c.rlike(word_pattern(keywords)), F.lit(False))


def spaced(c: Column) -> Column:
    """Text with every run of non-word characters as one space and a space at both ends, so
    that a whole word can be found as the plain substring `` word ``."""
    return F.concat(F.lit(" "), F.regexp_replace(c, f"[^{fv.WORD}]+", " "), F.lit(" "))


def words_present(c: Column, keywords) -> Column:
    """The keywords occurring on word boundaries (pass lower-cased text), in the given order."""

    def found(original: Column, padded: Column, k: str) -> Column:
        if k.replace("_", "").isalnum():
            return F.contains(padded, F.lit(f" {k} "))
        return contains_word(original, [k])

    pair = F.struct(c.alias("o"), spaced(c).alias("p"))
    return let(
        pair, lambda v: F.array_compact(F.array(*[F.when(found(v["o"], v["p"], k), F.lit(k)) for k in keywords]))
    )


def word_pattern(keywords) -> str:
    """Alternation between word boundaries, spelled out because Java releases differ on ``\\b``."""
    return f"(?<![{fv.WORD}])(?:" + "|".join(escape(k) for k in keywords) + f")(?![{fv.WORD}])"


def escape(keyword: str) -> str:
    return "".join("\\" + ch if ch in r".+*?^$()[]{}|\\/" else ch for ch in keyword)


def entity_context(text: Column, start: Column, end: Column, window: int = 30) -> Column:
    """``...`` plus the text from ``window`` characters before to after a span plus ``...``."""
    first = F.greatest(start - window, F.lit(0))
    last = F.least(end + window, F.length(text))
    return F.concat(F.lit("..."), F.substring(text, first + 1, last - first), F.lit("..."))


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))
