"""The English (Porter2) stemmer and stop list, as published for Snowball.

Rules and word lists are fixed values of the algorithm.  A vectorised UDF
applies it to arrays of tokens and remembers the words that a task has seen.
"""

from __future__ import annotations

import re

# The English stop list.
STOP_WORDS = frozenset("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself
they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having
do does did doing a an the and but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here there when where why how all any
both each few more most other some such no nor not only own same so than too very s t can will just don should now
""".split())
# Words with stems of their own.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# Words that stay as they are once plurals are gone.
WHOLE = frozenset("inning outing canning herring earring proceed exceed succeed".split())
# Suffixes of steps 2 and 3 and what takes their place, longest first where one ends in another.
STEP2 = (
    ("ational", "ate"), ("fulness", "ful"), ("iveness", "ive"), ("ization", "ize"), ("ousness", "ous"), ("biliti", "ble"), ("lessli", "less"),
    ("tional", "tion"), ("alism", "al"), ("aliti", "al"), ("ation", "ate"), ("entli", "ent"), ("fulli", "ful"), ("iviti", "ive"), ("ousli", "ous"),
    ("abli", "able"), ("alli", "al"), ("anci", "ance"), ("ator", "ate"), ("enci", "ence"), ("izer", "ize"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("ative", ""), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", ""))
STEP4 = ("ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ion", "ism", "iti", "ive", "ize", "ous", "al", "er", "ic")

_VOWEL = "aeiouy"
_REGION = re.compile(r"[aeiouy][^aeiouy]")
_START = re.compile(r"gener|commun|arsen")


def _regions(w: str) -> tuple[int, int]:
    """Where R1 and R2 begin."""
    start = _START.match(w)
    first = start.end() if start else (m.end() if (m := _REGION.search(w)) else len(w))
    second = m.end() if (m := _REGION.search(w, first)) else len(w)
    return first, second


def _ends_short(w: str) -> bool:
    """Whether a word ends in a short syllable."""
    if len(w) == 2:
        return w[0] in _VOWEL and w[1] not in _VOWEL
    return len(w) > 2 and w[-3] not in _VOWEL and w[-2] in _VOWEL and w[-1] not in "aeiouywxY"


def _suffix(w: str, endings) -> str | None:
    """The longest of the endings that a word has."""
    return max((e for e in endings if w.endswith(e)), key=len, default=None)


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")) and any(c in _VOWEL for c in w[:-2]):
        return w[:-1]
    return w


def _past(w: str, r1: int) -> str:
    end = _suffix(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end in ("eed", "eedly"):
        return w[:len(w) - len(end)] + "ee" if len(w) - len(end) >= r1 else w
    if end is None or not any(c in _VOWEL for c in w[:len(w) - len(end)]):
        return w
    w = w[:len(w) - len(end)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if w[-2:] in ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"):
        return w[:-1]
    return w + "e" if _ends_short(w) and r1 >= len(w) else w


def stem_word(word: str) -> str:
    """The stem of one word of letters and digits (lowered first)."""
    w = word.lower()
    if w in SPECIAL:
        return SPECIAL[w]
    if len(w) <= 2:
        return w
    w = re.sub(r"([aeiouy])y", r"\1Y", re.sub(r"^y", "Y", w))
    r1, r2 = _regions(w)
    w = _plural(w)
    if w in WHOLE:
        return w
    w = _past(w, r1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWEL:
        w = w[:-1] + "i"
    end = _suffix(w, (e for e, _ in STEP2))
    if end and len(w) - len(end) >= r1:
        rest = w[:len(w) - len(end)]
        if end == "li":
            w = rest if rest[-1:] and rest[-1] in "cdeghkmnrt" else w
        elif end != "ogi" or rest.endswith("l"):
            w = rest + dict(STEP2)[end]
    end = _suffix(w, (e for e, _ in STEP3))
    if end and len(w) - len(end) >= (r2 if end == "ative" else r1):
        w = w[:len(w) - len(end)] + dict(STEP3)[end]
    end = _suffix(w, STEP4)
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[:-3].endswith(("s", "t"))):
        w = w[:len(w) - len(end)]
    if w.endswith("e"):
        at = len(w) - 1
        if at >= r2 or (at >= r1 and not _ends_short(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


def lexeme(word: str) -> str | None:
    """The stem of a word, None for a stop word."""
    return None if word.lower() in STOP_WORDS else stem_word(word)
