import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import best_position, divergence_audit, perfect_hash, terms, token_counts

PARTS = [" ", "  ", "\n", "\t", "a", "é", ".", "..", ",", "!?", "'s", "'", "12", "<|endoftext|>", "\xa0", "　",
         "日本", "\x1c", "\x85", "x", "Z", "-", "\r\n", "\U0001f600", " .", "word", "​", "<|", "|>"]


def library(name):
    import public_tokenizers

    return public_tokenizers.path(name)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_lengths_equal_the_library(name):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(3000)] + ["ab" * 100_000, "日" * 50_000]
    if name.endswith(".model"):
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=library(name)).encode(texts)]
    else:
        from tokenizers import Tokenizer

        want = [len(x.ids) for x in Tokenizer.from_file(library(name)).encode_batch(texts, add_special_tokens=False)]
    lengths = token_counts.Lengths(library(name))
    assert lengths.split == (name == "byte_bpe_50k.json")
    assert lengths.count(texts) == want
    assert all(" ".join(token_counts.parts_of(t)) == t for t in texts)


def test_token_counts_of_a_table(spark):
    texts = [None, "", "a <|endoftext|> b", "one two  three\n", "word " * 200_000, "x" * 300_000, "same", "same"]
    rows = [(i if i < 7 else 6, t, 5, "clash") for i, t in enumerate(texts)] + [(None, "no id", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes string").repartition(3)
    got = token_counts.token_counts(docs, library("byte_bpe_50k.json"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(library("byte_bpe_50k.json"))
    want = []
    for key, text, *_ in rows:
        n = len(own.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 512))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.filter("doc_id = 2").first()["n_tokens"] == 4
    assert token_counts.token_counts(docs.limit(0), library("byte_bpe_50k.json")).count() == 0


def test_slices_are_balanced_by_bytes():
    import pyarrow as pa

    texts = ["a" * n for n in (10, 500, 20, 30, 2000, 1)] + [None, ""]
    cut = list(token_counts.slices(pa.array(texts), 600))
    assert [t for some in cut for t in some] == [t or "" for t in texts]
    assert [sum(map(len, some)) for some in cut] == [560, 2000, 1]


def test_perfect_hash_is_minimal_and_knows_its_keys(spark):
    rng = random.Random(1)
    for n in [1, 2, 3, 4, 7, 50, 3000]:
        keys = list({rng.randbytes(rng.randint(0, 9)) for _ in range(n)})
        made = perfect_hash.Shard.build(keys)
        assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
        others = [k + b"-" for k in keys if k + b"-" not in keys]
        assert (made.slots(others) == -1).all()
    with pytest.raises(ValueError):
        perfect_hash.Shard.build([b"a", b"a"])
    keys = [f"té{i}".encode() for i in range(50)]
    frame = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary")
    dealt = {}
    for row in frame.select("key", F.pmod(F.crc32("key"), F.lit(7)).alias("n")).collect():
        dealt.setdefault(row["n"], []).append(bytes(row["key"]))
    some = {n: perfect_hash.Shard.build(own) for n, own in dealt.items() if n % 2}
    shards, stored = perfect_hash.Shards(some), [k for n, own in dealt.items() if n % 2 for k in own]
    found = shards.slots(keys, 7).tolist()
    assert sorted(f for f in found if f >= 0) == list(range(len(stored)))
    assert [shards.keys[f] for f in found if f >= 0] == [k for k in keys if k in stored]


def test_terms_equal_the_pattern(monkeypatch):
    monkeypatch.setattr(terms, "SLICE_BYTES", 7)
    rng = random.Random(2)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for table, pattern in [(terms.LETTERS, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"),
                           (terms.LETTERS_AND_DIGITS, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")]:
        for _ in range(300):
            text = "".join(rng.choices([*PARTS, "É", "\x7f", "\x80", "@", "[", "`", "{", "0"], k=rng.randint(0, 40)))
            found = [t.decode() for some in terms.terms(text.encode(), table) for t in some]
            assert found == re.findall(pattern, text.translate(lower))


def words(text):
    return [t.decode() for some in terms.terms((text or "").encode(), terms.LETTERS) for t in some]


def audit(rows, least, ranks):
    """The rule, by plain counting."""
    out, docs = [], [(lang or "", source or "", words(text)) for lang, source, text in rows]
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, w in own for t in set(w))
        kept = sorted((t for t, n in df.items() if n >= least), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, w in own:
            counts[source].update(t for t in w if t in kept)

        def share(count):
            n = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            over = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in ("pair", pairs), ("term", over):
                lined = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(lined)
                        if part == "pair" or i < ranks]
    return sorted(out)


def test_source_divergence_equals_plain_counting(spark):
    rng = random.Random(7)
    some = ["la", "té", "Of", "tree", "tREE", "x1y", "日本", "common", "rare", "a-b"]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s0"] * 5 + ["s1", "s2", None, ""]),
             " ".join(rng.choices(some, k=rng.randint(0, 9)))) for _ in range(120)]
    rows += [("en", "s0", None), ("en", "s0", ""), ("de", "alone", "few terms"), ("it", "s1", "x"), ("it", "s2", "y")]
    rows += [("en", "long", "tree la " * 60_000)] + [("fr", "twin", "tree"), ("fr", "twin", "tree")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, n long, slot int")
    tight = divergence_audit.Audit(min_docs=6, ranks=3, keys_per_shard=3, bytes_per_round=600, terms_held=4,
                                   slots_held=5, cells=4, most_cells=8)
    for how in tight, divergence_audit.Audit(min_docs=6, ranks=3):
        got = divergence_audit.source_divergence(docs.repartition(3), how)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == audit(rows, 6, 3)
    none = divergence_audit.source_divergence(docs, divergence_audit.Audit(min_docs=1000))
    assert sorted(map(tuple, none.collect())) == audit(rows, 1000, 50)
    assert divergence_audit.source_divergence(docs.limit(0)).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    """Shares are decimals, so that frequent terms do not overflow."""
    value = spark.sql("select 1 + (cast(1000000000 as decimal(20,0)) * cast(99999999999995 + 5 as decimal(18,0)) div "
                      "cast(300000000000000 as decimal(20,0))) as p").first()["p"]  # fmt: skip
    assert value == 1 + 10**9 * 10**14 // (3 * 10**14)


def search(docs, items, top):
    """The rule, by scoring every document."""

    def cut(text):
        return [t for some in terms.terms((text or "").encode(), terms.LETTERS_AND_DIGITS) for t in some]

    lined = [(key, cut(text)) for key, text in docs]
    lined = [(key, w) for key, w in lined if w]
    n, total = len(lined), sum(len(w) for _, w in lined)
    df = Counter(t for _, w in lined for t in set(w))
    asked, out = defaultdict(set), []
    for key, text in items:
        if key is not None:
            asked[key].update(cut(text))
    for item, own in asked.items():
        found = []
        for key, w in lined:
            tf, m = Counter(w), 50 + 50 * len(w) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in own if t in tf)
            if score > 0 and key is not None:
                found.append((-score, key))
        out += [(item, i + 1, key, -s) for i, (s, key) in enumerate(sorted(found)[:top])]
    return sorted(out)


def test_ranked_search_equals_scoring_everything(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "UP"]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(63)], k=rng.randint(0, 30)))) for i in range(400)]
    docs += [(500 + i, "w1 w2 w3 w40") for i in range(30)] + [(500, "w1 w2"), (500, "w1 w2"), (None, "w50 w51")]
    docs += [(900, None), (901, ""), (902, "w7 w8 " * 50_000), (-3, "w1 w2 w3 w40")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 25)))) for i in range(15)]
    items += [(20, "w1 w2 w3 w40"), (21, None), (22, "nowhere"), (23, "up, Up! É"), (None, "w1"), (24, "w3"), (24, "w9 w9")]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, score string")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    tight = best_position.Ranking(top=7, item_bytes=100, block_words=300, first_depth=1)
    for how in tight, best_position.Ranking():
        got = best_position.ranked(frame.repartition(3), asked, how)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect())) == search(docs, items, how.top)
    assert best_position.ranked(frame.limit(0), asked).count() == 0
    assert best_position.ranked(frame, asked.limit(0)).count() == 0


def test_reading_stops_before_the_lists_end():
    """One document matches far better than all others, which are then not looked up."""
    import numpy as np

    n, known = 2000, best_position.Weights(2000, 20_000, np.array([5000, 5000, 100]))
    doc = np.concatenate((np.repeat(np.arange(n), 1), [7, 7]))
    term = np.concatenate((np.full(n, 2), [0, 1]))
    order = np.lexsort((term, doc))
    lists = best_position.Lists(
        np.arange(n), doc[order], term[order], np.ones(n + 2, np.int64), np.full(n, 10), known
    )
    best = best_position.Best(1)
    looked_up = lists.search(np.array([0, 1, 2]), best, 16)
    assert best.ids.tolist() == [7] and looked_up < 100
