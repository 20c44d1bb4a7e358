"""Token counts by batch encoding inside Arrow functions.

Only lengths leave the function. An Arrow batch is walked in slices of equal
bytes, and a text is cut where its tokens cannot straddle: a byte-level vocabulary that
splits text into ``' ?letters'``, ``' ?digits'``, ``' ?others'`` and runs of white space
starts a new token wherever white space follows a visible character, and looks
ahead only inside white space. So the parts' counts add up to the text's,
however long the text is, and the distinct parts of a slice are encoded once, as one batch.
Other vocabularies (normalisers, word ends, sentence pieces) have no such place; their
texts are encoded whole, slice by slice.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text that are encoded together; an encoding takes many times its text's memory.
SLICE_BYTES = 1 << 20
CACHED_PARTS = 300_000
# Longer parts are hardly ever met again.
CACHED_LENGTH = 64
CLOSING = ",.;:!?"
# Letters up to here are letters in every version of Unicode.
LAST_OLD_LETTER = "\u024f"


def splits_at_blanks(settings: dict) -> bool:
    """Whether the tokenizer of a JSON file starts a token before every blank that follows a visible character."""
    before = settings.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    own = settings.get("added_tokens") or []
    closed = all(
        not any(c.isspace() for c in t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in own
    )
    return bool(plain and closed and settings.get("normalizer") is None)


# Here a blank follows white space, so that words must stay together.
OPEN = re.compile(r"\s ")


def parts_of(text: str) -> list[str]:
    """The parts of ``text``, each but the first without the blank that it starts with.

    A part starts at a blank that follows a visible character.
    """
    words = text.split(" ")
    if not OPEN.search(text):
        return words
    out = [words[0]]
    for word in words[1:]:
        if len(out) > 1 and out[-1] == "" or out[-1][-1:].isspace():
            out[-1] += " " + word
        else:
            out.append(word)
    return out


def stem_of(part: str) -> str:
    """A part without closing punctuation, if that follows a letter: no token holds both."""
    stem = part.rstrip(CLOSING)
    return stem if stem and stem[-1].isalpha() and stem[-1] <= LAST_OLD_LETTER else part


class Lengths:
    """Token counts of texts by the library for the vocabulary file at ``path``."""

    def __init__(self, path: str):
        # Tokens of a blank and the part after it.
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
            self.split = False
            return
        # Spark runs a task per core; more threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.encode = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            self.split = splits_at_blanks(json.load(file))

    def count(self, texts: list[str]) -> list[int]:
        if not self.split:
            return self.encode(texts)
        parts, known = [parts_of(text) for text in texts], self.known
        counts = self.encode([some[0] for some in parts])
        parts = [some[1:] for some in parts]
        new = set().union(*parts) - known.keys()
        stems = {part: stem_of(part) for part in new}
        words, ends = list(set(stems.values()) - known.keys()), list({p[len(s) :] for p, s in stems.items()})
        known.update(zip(words, self.encode([" " + word for word in words])))
        closed = dict(zip(ends, self.encode(ends)))
        known.update((p, known[s] + closed[p[len(s) :]]) for p, s in stems.items() if p != s)
        counts = [n + sum(map(known.__getitem__, some)) for n, some in zip(counts, parts)]
        for part in new.union(words):
            if len(part) > CACHED_LENGTH:
                del known[part]
        if len(known) > CACHED_PARTS:
            known.clear()
        return counts


def slices(texts: pa.Array, limit: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``limit`` bytes; a longer text is a list of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield [x or "" for x in texts[start:at].to_pylist()]
            start, total = at, 0
        total += int(size)
    if start < len(texts):
        yield [x or "" for x in texts[start:].to_pylist()]


def n_tokens(text: Column, path: str, slice_bytes: int = SLICE_BYTES) -> Column:
    """Tokens of a text by the vocabulary at ``path``, the same file on all workers; null is empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = Lengths(path)
        for texts in batches:
            counts: list[int] = []
            for some in slices(texts, slice_bytes):
                counts += lengths.count(some)
            yield pa.array(counts, pa.int64())

    return F.arrow_udf(run, "long")(text)


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    No begin, end or padding token is counted; strings of special tokens inside a text count as the
    library has it by default. Null and empty texts have 0 bytes and tokens.
    Rows that repeat an id, or have none, are counted each. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    counted = rows.withColumn("n_tokens", n_tokens(F.col("_text"), path))
    size = F.octet_length("_text").cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
