"""The Porter stemmer, after M. F. Porter, "An algorithm for suffix stripping", 1980."""

from __future__ import annotations

import re

# The suffix tables of steps 2, 3 and 4 of the paper.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def shape(word: str) -> str:
    """The word as v and c letters; y is a vowel after a consonant."""
    marks = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and marks[-1:] == "c")
        marks += "v" if vowel else "c"
    return marks


def measure(stem: str) -> int:
    return len(re.findall("v+c+", shape(stem)))


def has_vowel(stem: str) -> bool:
    return "v" in shape(stem)


def double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"


def short_end(word: str) -> bool:
    return shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def longest_suffix(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    # 1a: plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # 1b: -eed, -ed, -ing
    if word.endswith("eed"):
        if measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = longest_suffix(word, ("ed", "ing"))
        if cut and has_vowel(word[: -len(cut)]):
            word = word[: -len(cut)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif double_consonant(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif measure(word) == 1 and short_end(word):
                word += "e"
    # 1c: terminal y
    if word.endswith("y") and has_vowel(word[:-1]):
        word = word[:-1] + "i"
    # 2 and 3: double and single suffixes
    for table in (STEP2, STEP3):
        suffix = longest_suffix(word, table)
        if suffix and measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + table[suffix]
    # 4: remaining suffixes
    suffix = longest_suffix(word, STEP4)
    if suffix:
        base = word[: -len(suffix)]
        if measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
            word = base
    # 5: final e and double l
    if word.endswith("e"):
        base = word[:-1]
        if measure(base) > 1 or (measure(base) == 1 and not short_end(base)):
            word = base
    if word.endswith("ll") and measure(word) > 1:
        word = word[:-1]
    return word
