"""Fixed word lists and whitespace definitions."""

# Words whose share makes up the English score.
ENGLISH_WORDS = (
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    "this", "that", "is", "are", "was", "were", "be", "been", "have", "has", "had",
)

# Words that mark a page as English when it declares no language.
ENGLISH_INDICATORS = (
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
)

# Unicode whitespace plus the four ASCII separators, which is what text
# splitting treats as blank: (?U) covers White_Space, \x1c-\x1f adds the rest.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
NON_BLANKS = r"(?U)[^\s\x1c-\x1f]+"
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
