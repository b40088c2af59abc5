"""Offset-bearing matching of dictionaries and patterns as Column expressions.

Matches are set off by a mark, so gaps and matches alternate when the text is
split there, and one fold adds up the offsets. Nothing leaves the JVM.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions.text import let

ENTITY = "array<struct<text:string,label:string,start:int,end:int,confidence:double>>"
# hyphenated models first, so that WH-1000 is not cut at the hyphen
MODEL_PATTERN = "|".join(reversed(fv.MODEL_PATTERNS_SHORT))
_HITS = "array<struct<start:int,end:int,text:string>>"
_WORD = re.compile(r"\w+")
#: Set around matches: a code point that never stands for a character. A text that has it gets its neighbour instead.
_MARK, _OTHER = "\uffff", "\ufffe"


def _hits(text: Column, pattern: str) -> Column:
    """Start, end and text of the matches of ``pattern``, from one scan of a text without ``_MARK``."""
    pieces = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.array().cast(_HITS).alias("out"))

    def step(acc, p):
        end = acc["at"] + F.length(p)
        hit = F.struct(acc["at"].alias("start"), end.alias("end"), p.alias("text"))
        out = F.when(acc["hit"], F.concat(acc["out"], F.array(hit))).otherwise(acc["out"])
        return F.struct(end.alias("at"), (~acc["hit"]).alias("hit"), out.alias("out"))

    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def _of_layer(hits: Column, layer: int) -> Column:
    return F.transform(
        hits,
        lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), F.lit(layer).alias("layer"), h["text"].alias("text")),
    )


def _one_of(terms: list[str]) -> str:
    """A pattern for any of ``terms``, the longest first, with common beginnings written once."""
    ends, rest = "" in terms, {}
    for t in terms:
        if t:
            rest.setdefault(t[0], []).append(t[1:])
    if not rest:
        return ""
    branches = [re.escape(c) + _one_of(tails) for c, tails in sorted(rest.items())]
    return (branches[0] if len(branches) == 1 and not ends else f"(?:{'|'.join(branches)})") + ("?" if ends else "")


def _whole(text: Column, terms: list[str]) -> Column:
    return _hits(text, f"(?iu)(?<![{fv.WORD}]){_one_of(terms)}(?![{fv.WORD}])")


def _dictionaries(text: Column, layers: dict[int, list[str]]) -> list[Column]:
    """Whole-word, case-insensitive terms: the words of all layers in one scan, the phrases of a layer in another."""
    single = {i: [t for t in terms if _WORD.fullmatch(t)] for i, terms in layers.items()}
    every = sorted({t for terms in single.values() for t in terms})
    found = []
    if every:

        def chosen(w: Column, i: int, terms: list[str]) -> Column:
            of = _of_layer(w, i)
            return of if terms == every else F.filter(of, lambda h: F.lower(h["text"]).isin(*terms))

        found.append(let(_whole(text, every), lambda w: F.concat(*[chosen(w, i, terms) for i, terms in single.items() if terms])))
    for i, terms in layers.items():
        phrases = sorted(set(terms) - set(single[i]) - {""})
        if phrases:
            found.append(_of_layer(_whole(text, phrases), i))
    return found


def _first_of_span(hits: Column) -> Column:
    """Of hits with one span, the one of the first layer."""

    def new(v, h, i):
        before = F.get(v, i - 1)
        return (i == 0) | (before["start"] != h["start"]) | (before["end"] != h["end"])

    return let(F.sort_array(hits), lambda v: F.filter(v, lambda h, i: new(v, h, i)))


def find_spans(text: Column, layers: list, once: bool = True) -> Column:
    """Entities of every layer sorted by start. A layer is (label, terms or pattern, confidence);
    with ``once`` the first layer keeps a span that several layers find.

    Offsets count code points from 0; a null text has no entities. Terms match whole words (runs of
    letters, digits and underscores) in any case. Classes like ``\\w`` in a pattern are Unicode's
    (combining marks belong to words), and a pattern must not match the empty string.
    Offsets of a text with the noncharacter U+FFFF are right; in an entity's text it reads U+FFFE.
    """
    text = F.coalesce(text, F.lit(""))
    text = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, _OTHER)).otherwise(text)
    patterns = {i: x for i, (_, x, _) in enumerate(layers) if isinstance(x, str)}
    for x in patterns.values():
        if re.compile(x).match(""):
            raise ValueError(f"pattern matches the empty string: {x}")
    terms = {i: sorted({t.lower() for t in x}) for i, (_, x, _) in enumerate(layers) if i not in patterns}
    found = [_of_layer(_hits(text, f"(?U){x}"), i) for i, x in patterns.items()] + _dictionaries(text, terms)
    labels, confidences = (F.array(*[F.lit(v) for v in x]) for x in ([n for n, _, _ in layers], [float(c) for _, _, c in layers]))
    hits = F.concat(*found) if found else F.array().cast("array<struct<start:int,end:int,layer:int,text:string>>")
    ordered = F.sort_array(
        F.transform(
            _first_of_span(hits) if once else hits,
            lambda h: F.struct(h["start"].alias("start"), h["layer"].alias("layer"), h["end"].alias("end"), h["text"].alias("text")),
        )
    )
    return F.transform(
        ordered,
        lambda h: F.struct(
            h["text"].alias("text"),
            F.element_at(labels, h["layer"] + 1).alias("label"),
            h["start"].alias("start"),
            h["end"].alias("end"),
            F.element_at(confidences, h["layer"] + 1).alias("confidence"),
        ),
    )
