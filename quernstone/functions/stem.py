"""English suffix stripping after Porter (1980), with the extended rules of the common toolkits.

A word-level helper for Arrow functions. Rules are tables; a step takes the first rule whose suffix
fits and stops there, whether or not the rule's condition holds.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "inning": "inning", "innings": "inning", "outing": "outing",
    "outings": "outing", "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# Suffix tables of steps 2 to 4, in order.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"),
    ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """The word as a string of c and v; y is a consonant at the start and after a vowel."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c" else word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    for suffix, ending in STEP_2:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + ending if _measure(stem) > 0 else word
    return word[:-1] if word.endswith("logi") and _measure(word[:-3]) > 0 else word


def _adjective(word: str) -> str:
    for suffix, ending in STEP_3:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + ending if _measure(stem) > 0 else word
    return word


def _residue(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st")
            return stem if fits else word
    return word


def _final_e(word: str) -> str:
    stem = word[:-1]
    if word.endswith("e") and (_measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem))):
        return stem
    return word


def _double_l(word: str) -> str:
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) > 2:
        for step in (_plural, _past, _final_y, _derived, _adjective, _residue, _final_e, _double_l):
            word = step(word)
    return word
