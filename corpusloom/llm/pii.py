"""Personal data by anchor expansion.

One Aho-Corasick pass per text finds anchors: at-signs, URL schemes, plus signs,
digits and identifier cues. Small deterministic parsers then walk from an
anchor to the ends of the address, number or value around it and check it.
Text without anchors is never looked at again.

Kinds, in the order used for ties: email, ip, card, phone (spans of one kind
never overlap), then url (scheme to the end of the address) and secret (the
value after a cue such as ``password=`` or ``account no.``, or an access key id).
Schemes and cues are met in upper and lower case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Character classes and anchors of the kinds.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
LOCAL = frozenset(LETTERS + DIGITS + "._%+-")
LABEL = frozenset(LETTERS + DIGITS + "-")
NUMERALS = frozenset(DIGITS)
PHONE = frozenset(" ().-" + DIGITS)
TOKEN = frozenset(LETTERS + DIGITS + "_-+/=.!@#$%^&*")
ACCOUNT = frozenset(LETTERS[:26] + DIGITS + "-")
URL_END = frozenset(" \t\n\x0b\x0c\r\"'<>`{}|\\^")
TRAILING = ".,;:!?)]"
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:")
CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "account")
# Words that may stand between a cue and its value.
FILLERS = ("number", "no.", "no", "num", "nr.", "nr", "id", "#")
KEY_IDS = ("AKIA", "ASIA")
KINDS = ("email", "ip", "card", "phone", "url", "secret")
BASE_KINDS = KINDS[:4]

Span = tuple[int, int]


def run_right(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


class Runs:
    """Runs of some characters in a text, each walked once however many anchors stand in it.

    A run counts up to its last character that is not ``closing``.
    """

    def __init__(self, text: str, chars: frozenset, closing: str, inside: bool = True):
        self.text, self.chars, self.closing, self.inside = text, chars, closing, inside
        self.begin, self.end, self.last, self.digit = 0, -1, -1, -1

    def end_of(self, at: int) -> int:
        """Where the run from ``at`` on ends, closing characters left out."""
        if not self.begin <= at <= self.end:
            text, n = self.text, len(self.text)
            self.begin = self.end = at
            while self.end < n and (text[self.end] in self.chars) == self.inside:
                self.end += 1
            self.last = self.end
            while self.last > at and text[self.last - 1] in self.closing:
                self.last -= 1
            self.digit = self.last - 1
            while self.digit >= at and text[self.digit] not in NUMERALS:
                self.digit -= 1
        return max(self.last, at)

    def digit_from(self, at: int) -> bool:
        """Whether the run that ``end_of(at)`` told holds a digit."""
        return self.digit >= at


class Walks:
    """The runs that the parsers of one text walk."""

    def __init__(self, text: str):
        self.text = text
        self.url = Runs(text, URL_END, TRAILING, inside=False)
        self.token = Runs(text, TOKEN, TRAILING)
        self.account = Runs(text, ACCOUNT, "-")


def email_at(text: str, sign: int, floor: int) -> Span | None:
    """The address around an at-sign, not reaching left of ``floor``."""
    start = sign
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    label = run_right(text, sign + 1, LABEL)
    if start == sign or label == sign + 1:
        return None
    end = label
    while end < len(text) and text[end] == ".":
        further = run_right(text, end + 1, LABEL)
        if further == end + 1:
            break
        end = further
    return (start, end) if end > label else None


def digit_runs(text: str, digits: list[int]) -> list[Span]:
    """Maximal digit runs from the sorted digit positions."""
    runs, i, n = [], 0, len(digits)
    while i < n:
        j = i
        while j + 1 < n and digits[j + 1] == digits[j] + 1:
            j += 1
        runs.append((digits[i], digits[j] + 1))
        i = j + 1
    return runs


def chains(text: str, runs: list[Span], joints: str) -> Iterator[list[Span]]:
    """Runs joined by exactly one of ``joints``."""
    chain: list[Span] = []
    for run in runs:
        if chain and run[0] == chain[-1][1] + 1 and text[run[0] - 1] in joints:
            chain.append(run)
        else:
            if chain:
                yield chain
            chain = [run]
    if chain:
        yield chain


def small(text: str, run: Span) -> bool:
    """Whether a digit run is at most 255."""
    digits = text[run[0] : run[1]].lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def ips(text: str, runs: list[Span]) -> list[Span]:
    """Groups of four dotted numbers, from the left of each chain."""
    out = []
    for chain in chains(text, runs, "."):
        for i in range(0, len(chain) - 3, 4):
            four = chain[i : i + 4]
            if all(small(text, r) for r in four):
                out.append((four[0][0], four[3][1]))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def cards(text: str, runs: list[Span]) -> list[Span]:
    """Chains of 14 to 19 digits with single blanks or hyphens that pass the checksum."""
    out = []
    for chain in chains(text, runs, " -"):
        if 14 <= sum(b - a for a, b in chain) <= 19:
            if luhn("".join(text[a:b] for a, b in chain)):
                out.append((chain[0][0], chain[-1][1]))
    return out


def phone_at(text: str, plus: int) -> Span | None:
    """From a plus and a digit to the last digit of the run; 10 to 15 digits."""
    if plus + 1 >= len(text) or text[plus + 1] not in NUMERALS:
        return None
    end = run_right(text, plus + 1, PHONE)
    while text[end - 1] not in NUMERALS:
        end -= 1
    digits = sum(c in NUMERALS for c in text[plus + 1 : end])
    return (plus, end) if end - plus >= 4 and 10 <= digits <= 15 else None


def url_at(walks: Walks, start: int, after: int) -> Span | None:
    """From a scheme to the next delimiter, without closing punctuation."""
    end = walks.url.end_of(after)
    return (start, end) if end > after else None


def lowered(text: str) -> str:
    """``text`` with A-Z lower-cased and all others, and so all places, as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def after_fillers(text: str, at: int) -> int:
    """Past words such as ``number`` or ``no.`` that follow an account cue."""
    while True:
        next_at = at
        while next_at < len(text) and text[next_at] in " \t_-":
            next_at += 1
        said = lowered(text[next_at : next_at + 8])
        word = next((w for w in FILLERS if said.startswith(w)), None)
        if word is None:
            return at
        end = next_at + len(word)
        if word[-1] in LETTERS and end < len(text) and text[end] in LETTERS:
            return at
        at = end


def account_after(walks: Walks, at: int) -> Span | None:
    """As ``secret_after``; behind a word such as ``number`` the sign can be left out."""
    text, past = walks.text, after_fillers(walks.text, at)
    signed = secret_after(walks, past)
    if signed or past == at:
        return signed
    while past < len(text) and text[past] in " \t\"'":
        past += 1
    end = walks.account.end_of(past)
    # Closing hyphens aside, the run must not go on as a word.
    whole = end == len(text) or text[end] not in LETTERS
    return (past, end) if whole and end - past >= 8 and walks.account.digit_from(past) else None


def secret_after(walks: Walks, at: int) -> Span | None:
    """The value after a cue: a sign, optional quotes and blanks, 8 characters or more."""
    text, n = walks.text, len(walks.text)
    while at < n and text[at] in " \t\"'":
        at += 1
    if at >= n or text[at] not in "=:":
        return None
    at += 1
    while at < n and text[at] in " \t\"'":
        at += 1
    end = walks.token.end_of(at)
    return (at, end) if end - at >= 8 and walks.token.digit_from(at) else None


# Characters of an access key; a longer run is none.
KEY_LENGTH = 20


def key_at(text: str, start: int) -> Span | None:
    end, most = start, min(len(text), start + KEY_LENGTH + 1)
    while end < most and (text[end] in NUMERALS or "A" <= text[end] <= "Z"):
        end += 1
    return (start, end) if end - start == KEY_LENGTH else None


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (
        ("digit", DIGITS), ("at", "@"), ("plus", "+"), ("scheme", SCHEMES), ("cue", CUES), ("key", KEY_IDS),
    ):
        for word in words:
            found.add_word(lowered(word), ("account" if word == "account" else kind, len(word)))
    found.make_automaton()
    return found


def apart(spans: list[Span]) -> list[Span]:
    """Leftmost, longest first, without overlaps."""
    out: list[Span] = []
    for span in sorted(set(spans), key=lambda s: (s[0], -s[1])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def find(text: str, anchors) -> dict[str, list[Span]]:
    """Spans by kind, in code points, end exclusive."""
    digits: list[int] = []
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    walks = Walks(text)
    for end, (kind, size) in anchors.iter(lowered(text)):
        start = end + 1 - size
        if kind == "digit":
            digits.append(start)
        elif kind == "at":
            span = email_at(text, start, out["email"][-1][1] if out["email"] else 0)
            out["email"] += [span] if span else []
        elif kind == "plus":
            span = phone_at(text, start)
            out["phone"] += [span] if span else []
        elif kind == "scheme":
            span = url_at(walks, start, end + 1)
            out["url"] += [span] if span else []
        elif kind == "cue":
            span = secret_after(walks, end + 1)
            out["secret"] += [span] if span else []
        elif kind == "account":
            span = account_after(walks, end + 1)
            out["secret"] += [span] if span else []
        else:
            span = key_at(text, start)
            out["secret"] += [span] if span else []
    if digits:
        runs = digit_runs(text, digits)
        out["ip"], out["card"] = ips(text, runs), cards(text, runs)
    out["url"], out["secret"] = apart(out["url"]), apart(out["secret"])
    return out


def listed(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) by start, then kind."""
    return sorted((a, KINDS.index(k), b) for k in kinds for a, b in found[k])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Replace spans by [KIND]; overlapping spans become one, named by the first."""
    merged: list[list[int]] = []
    for start, kind, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    parts, at = [], 0
    for start, kind, end in merged:
        parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def per_text(make: Callable[[str, dict[str, list[Span]]], tuple], schema: str):
    """A vectorised function of a text column, one struct per text."""

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        anchors = automaton()
        for texts in batches:
            rows = []
            for text in texts:
                plain = text if isinstance(text, str) else ""
                rows.append(make(plain, find(plain, anchors)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return run


def report(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with a struct of counts, the digest of the base spans, and all spans.

    A null or empty text has no span. Nothing is dropped; a column of that name is replaced.
    """

    def make(plain: str, found: dict[str, list[Span]]) -> tuple:
        base = joined(listed(found, BASE_KINDS))
        counts = [len(found[k]) for k in BASE_KINDS]
        return (*counts, hashlib.sha256(base.encode()).hexdigest(), joined(listed(found, KINDS)))

    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.withColumn(name, per_text(make, schema)(F.col(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null stays null."""

    def make(plain: str, found: dict[str, list[Span]]) -> tuple:
        return (masked(plain, listed(found, KINDS)),)

    cleaned = per_text(make, "redacted string")(F.col(text))["redacted"]
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), cleaned))
