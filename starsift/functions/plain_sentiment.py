"""Plain scorer of one text, for the SQL function; the Column expressions must equal it."""

import math
import re

from starsift.functions.sentiment import (
    ALPHA, BOOSTER_DECAY, BOOSTERS, BUT_AFTER, BUT_BEFORE, CAPS_INCREMENT, EXCLAMATION, LEXICON, NEGATION_FACTOR, NEGATIONS,
    QUESTION, QUESTION_MAX,
)

_EDGES = re.compile(r"^[^\w]+|[^\w]+$")


def _valence(words, i, lexicon, mixed_case):
    """Valence of word ``i`` with capitals, boosters and negations of the three words before it."""
    low = words[i].lower()
    v = lexicon.get(low, 0.0)
    if v == 0.0 or low in BOOSTERS:
        return 0.0
    sign = 1 if v > 0 else -1
    if mixed_case and words[i].isupper():
        v += sign * CAPS_INCREMENT
    for back in (1, 2, 3):
        if i - back < 0:
            break
        previous = words[i - back]
        plain = previous.lower().replace("'", "")
        if plain in lexicon:
            continue
        boost = BOOSTERS.get(plain, 0.0) * sign
        if boost and mixed_case and previous.isupper():
            boost += CAPS_INCREMENT * (1 if boost > 0 else -1)
        v += boost * BOOSTER_DECAY[back - 1]
        if plain in NEGATIONS or plain.endswith("nt") and plain[:-2] in {"is", "was", "did", "do", "does", "has", "had"}:
            v *= NEGATION_FACTOR
    return v


def score(text: str | None, lexicon=LEXICON) -> tuple[float, float, float, float]:
    """(compound, positive share, negative share, neutral share) of one text."""
    words = [w for w in (_EDGES.sub("", t) for t in (text or "").split()) if w]
    if not words:
        return 0.0, 0.0, 0.0, 0.0
    upper = sum(w.isupper() for w in words)
    values = [_valence(words, i, lexicon, 0 < upper < len(words)) for i in range(len(words))]
    lows = [w.lower() for w in words]
    if "but" in lows:
        at = lows.index("but")
        values = [v * (BUT_BEFORE if i < at else BUT_AFTER if i > at else 1.0) for i, v in enumerate(values)]
    questions = text.count("?")
    emphasis = min(text.count("!"), 4) * EXCLAMATION
    emphasis += 0.0 if questions < 2 else questions * QUESTION if questions <= 3 else QUESTION_MAX
    total = sum(values)
    total += emphasis * ((total > 0) - (total < 0))
    compound = max(-1.0, min(1.0, total / math.sqrt(total * total + ALPHA))) if total else 0.0
    pos = sum(v + 1 for v in values if v > 0)
    neg = sum(v - 1 for v in values if v < 0)
    neutral = sum(v == 0 for v in values)
    if pos > -neg:
        pos += emphasis
    elif pos < -neg:
        neg -= emphasis
    whole = pos - neg + neutral
    return round(compound, 4), round(pos / whole, 3), round(-neg / whole, 3), round(neutral / whole, 3)
