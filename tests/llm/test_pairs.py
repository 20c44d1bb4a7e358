"""Near duplicates, components and repeated passages against brute force."""

import dataclasses
import glob
import os
import random
import tempfile

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import minhash, substring
from corpusloom.llm.shingles import runs
from corpusloom.llm.common import marks, anti, matches_needed, semi
from corpusloom.llm.components import components

DOCS = "doc_id long, text string"


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    found = Union()
    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            shared = len(x & y)
            if a == b or x and y and shared * 100 >= len(x | y) * percent:
                found.join(a, b)
    return {i: found.find(i) for i, _ in sets}


def crowd(rng, base, count, rate):
    out = []
    for _ in range(count):
        text = list(base)
        for i in range(len(text)):
            if rng.random() < rate:
                text[i] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def collection(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    base = rng.choices(vocabulary, k=100)
    # Loose variants: many pairs just above and just below the bar.
    texts += crowd(rng, base, 60, 0.02) + crowd(rng, base, 20, 0.05) + [texts[3]] * 30
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=30)) for _ in range(30)]
    texts += [None, "", "  \n\t ", "one", "One", "two words", "TWO  words", texts[0].upper(), "é é é é"]
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, None), (5, "another text under the same id"), (5, texts[5])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,percent", [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates_equal_brute_force(spark, seed, k, percent):
    rows = collection(seed)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], DOCS + ", component_id long, key string")
    got = minhash.near_duplicates(docs, words=k, percent=percent).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    sizes = sorted((str(i), len(shingles(t, k))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in got) == sizes


def test_texts_that_share_an_id_keep_their_own_links(spark):
    """A long and a short text under id 1: each is compared as what it is."""
    rng = random.Random(6)
    long, short = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (100, 12))
    rows = [(1, " ".join(long)), (1, " ".join(short)), (2, " ".join([*long[:50], "new", *long[51:]])), (4, " ".join([*short, "z"]))]
    rows += [(9, rows[3][1] + " q r s t u v"), (9, rows[2][1])]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, words=3, percent=85).collect()}
    assert got == brute(rows, 3, 85) == {1: 1, 2: 1, 4: 1, 9: 1}


def test_short_list_limit_changes_nothing(spark, monkeypatch):
    rows = collection(4)
    docs = spark.createDataFrame(rows, DOCS)
    want = brute(rows, 3, 85)
    for limit in (0, 10**6):
        monkeypatch.setattr(minhash, "SHORT_LIST", limit)
        got = minhash.near_duplicates(docs, words=3, percent=85).filter("doc_id is not null").collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash.near_duplicates(empty).count() == 0
    assert substring.repeated_passages(empty).count() == 0


def test_matches_needed_is_a_safe_bound():
    assert matches_needed(64, 0.85) == 40 or 38 <= matches_needed(64, 0.85) <= 42
    assert matches_needed(64, 0.8) < matches_needed(64, 0.85) < 0.85 * 64
    assert matches_needed(4, 0.01) == 1


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)] + [(7, 7)]
    want = Union()
    for a, b in links:
        want.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == want.find(x) for link in links for x in link)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_semi_and_anti(spark):
    rows = spark.createDataFrame([(i,) for i in (*range(50), None, 3)], "k long")
    keys = spark.createDataFrame([(i,) for i in (*range(0, 50, 7), None)], "k long")
    inside = {r["k"] for r in semi(rows, "k", keys).collect()}
    assert inside == set(range(0, 50, 7))
    outside = [r["k"] for r in anti(rows, "k", keys).collect()]
    assert sorted(x for x in outside if x is not None) == sorted([3, *set(range(50)) - inside])
    assert outside.count(None) == 1


def test_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    passage, fuzzy = prose(60), prose(90)
    docs = {i: prose(200) for i in range(40)}
    for i in (3, 8, 11, 20):
        docs[i] = docs[i][:70] + passage + docs[i][70:]
    changed = [w if n % 12 else "changed" for n, w in enumerate(fuzzy)]
    docs[5], docs[30] = docs[5] + fuzzy, changed + docs[30]
    docs[33] = list(docs[2])
    docs[36], docs[37] = prose(30) + ["la"] * 70, ["la"] * 80 + prose(20)
    rows = [(i, " ".join(w)) for i, w in docs.items()] + [(90, None), (91, ""), (None, " ".join(passage)), (92, "short")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], DOCS + ", start int")
    got = substring.repeated_passages(frame).collect()
    found = {(r["doc_id"], r["other_id"]): r for r in got}
    assert set(found) == {(8, 3), (11, 3), (20, 3), (30, 5), (33, 2), (37, 36)}
    for i in (8, 11, 20):
        r = found[i, 3]
        assert (r["start"], r["stop"], r["other_start"], r["other_stop"]) == (70, 130, 70, 130) and r["identity"] == 1
    assert (found[33, 2]["start"], found[33, 2]["stop"]) == (0, 200)
    fuzz = found[30, 5]
    assert fuzz["start"] <= 2 and 86 <= fuzz["stop"] <= 92 and 0.85 < fuzz["identity"] < 1


def test_no_repeated_run_is_left_out(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    passages = [prose(n) for n in (50, 55, 70, 120)]
    docs = []
    for p in passages:  # pieces of each passage stand in earlier documents, and before it in its own first one
        docs += [prose(40) + p[i : i + 14] + prose(40) for i in range(0, len(p) - 8, 7)]
    for p in passages:
        docs.append(prose(20) + p[5:25] + prose(30) + p[30:48] + prose(20) + p + prose(30))
    docs += [prose(33) + p + prose(25) for p in passages + passages[2:]]
    docs += [prose(10) + ["la"] * 70, ["la"] * 90 + prose(9), ["da", "di"] * 40, prose(5) + ["di", "da"] * 45]
    docs.append(prose(50) + passages[0][:45] + prose(20) + passages[2][10:60])
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], DOCS)).collect()
    held = {}
    for r in got:
        held.setdefault(r["doc_id"], []).append((r["start"], r["stop"]))
        assert r["identity"] >= 0.8 and r["stop"] - r["start"] >= 50
    seen, repeated, missed = {}, 0, []
    for i, d in enumerate(docs):
        for s in range(len(d) - 49):
            if seen.setdefault(tuple(d[s : s + 50]), i) < i:
                repeated += 1
                if not any(a <= s and s + 50 <= b for a, b in held.get(i, [])):
                    missed.append((i, s))
    assert repeated > 100 and not missed


@pytest.mark.parametrize("kinds", ["x", "xid"])
def test_passages_down_to_the_least_identity_are_found(spark, kinds):
    """Exchanged (x), inserted and deleted (i, d) words in planted passages of 60 words."""
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(50_000)]
    docs = []
    for identity in (0.95, 0.9, 0.85, 0.82):
        for n in range(25):
            plain = rng.choices(vocabulary, k=60)
            changed = list(plain)
            for i in sorted(rng.sample(range(60), round(60 * (1 - identity))), reverse=True):
                kind = rng.choice(kinds)
                changed[i : i + 1] = {"x": [f"new{i}"], "i": [f"new{i}", changed[i]], "d": []}[kind]
            docs += [rng.choices(vocabulary, k=80) + p + rng.choices(vocabulary, k=70) for p in (plain, changed)]
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], DOCS)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == {(i + 1, i) for i in range(0, len(docs), 2)}
    assert all(r["identity"] >= 0.8 and r["n_words"] >= 50 for r in got)


def test_pairs_whose_seeds_occur_in_earlier_documents_are_found(spark):
    """Every run of six words of a fuzzy passage stands in an earlier document, and one passage has three variants."""
    rng = random.Random(33)
    vocabulary = [f"w{i}" for i in range(20_000)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    def variant(words, exchanged):
        places = set(rng.sample(range(len(words)), exchanged))
        return [f"new{rng.random()}" if i in places else w for i, w in enumerate(words)]

    docs, wanted = [], set()
    for _ in range(12):
        plain = prose(60)
        docs += [prose(30) + plain[i : i + 9] + prose(30) for i in range(0, 56, 4)]
        docs += [prose(40) + plain + prose(20), prose(25) + variant(plain, 5) + prose(35)]
        wanted.add((len(docs) - 1, len(docs) - 2))
    for _ in range(4):  # two runs of 15 words, of 20 words between them every second one is shared
        plain = prose(50)
        changed = [f"other{rng.random()}" if 15 <= i < 35 and i % 2 else w for i, w in enumerate(plain)]
        docs += [prose(30) + plain[i : i + 9] + prose(30) for i in range(0, 46, 4)]
        docs += [prose(40) + plain + prose(20), prose(25) + changed + prose(35)]
        wanted.add((len(docs) - 1, len(docs) - 2))
    plain = prose(80)
    docs += [prose(30) + variant(plain, 4) + prose(30) for _ in range(3)]
    wanted |= {(len(docs) - a, len(docs) - b) for a, b in ((1, 2), (1, 3), (2, 3))}
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], DOCS)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == wanted
    assert all(r["identity"] >= 0.8 and r["n_words"] >= 50 for r in got)


def test_nothing_that_was_shuffled_stays_on_disk(spark):
    roots = os.environ.get("SPARK_LOCAL_DIRS", spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir()))

    def files():
        return {p for root in roots.split(",") for p in glob.glob(f"{root}/**/shuffle_*", recursive=True)}

    before = files()
    counted = substring.stored(spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count(), "counted")
    assert not files() - before
    assert sorted(r["count"] for r in counted.collect()) == [100] * 10


def test_passages_aligned_in_parts_are_the_same(spark, monkeypatch):
    rng = random.Random(17)
    passage = [f"p{i}" for i in range(70)]
    docs = [[f"w{rng.randrange(5000)}" for _ in range(60)] + passage[i % 9 :] for i in range(30)]
    frame = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], DOCS)
    got, labels = {}, []
    keep = substring.stored
    monkeypatch.setattr(substring, "stored", lambda frame, label: labels.append(label) or keep(frame, label))
    for few in (1000, 0):
        monkeypatch.setattr(substring, "FEW_SPANS", few)
        got[few] = sorted(map(tuple, substring.repeated_passages(frame).collect()))
        assert (labels.count("part") > 2) == (few == 0)
    assert got[0] == got[1000] and len(got[0]) >= 29


class Everything:
    def holds(self, hashes):
        return np.ones(len(hashes), bool)


def test_crowds_lose_no_pair_that_may_share_a_passage():
    """A line stands in all documents; some share words around it, beyond a changed word or on one side only."""
    rng = random.Random(41)
    vocabulary = [f"w{i}" for i in range(300)]
    line, shared = ["a", "line", "that", "all", "documents", "hold", "somewhere"], rng.choices(vocabulary, k=80)
    texts = []
    for i in range(120):
        left, right = rng.choices(vocabulary, k=i % 50), rng.choices(vocabulary, k=40 - i % 30)
        if i % 4 == 0:
            right = [w if rng.random() < 0.75 else "other" for w in shared]
        if i % 6 == 0:
            left = left + [w for w in shared if rng.random() < 0.8]
        texts.append((i, " ".join(left + line + right)))
    how = substring.Passages()
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*texts)], ["key", "text"])
    (documents,) = substring.documents_of(how, Everything())(iter([batch]))
    own, index = substring.laid(documents, -2), substring.laid(documents, -1)
    order = np.lexsort((index.keys[index.text], index.seed))
    index = dataclasses.replace(index, **{n: getattr(index, n)[order] for n in ("text", "seed", "at", "before")})
    same = np.argwhere((own.seed[:, None] == index.seed) & (own.keys[own.text][:, None] > index.keys[index.text]))
    met = (own.before[same[:, 0]] == index.before[same[:, 1]]) & (own.before[same[:, 0]] != 0)
    x, y = same[~met].T
    passes = substring.alike(own.words, own.at[x], index.words, index.at[y], how)[1]
    wanted = set(zip(x[passes].tolist(), y[passes].tolist()))
    got = {pair for xs, ys in substring.pairs_of(own, substring.Block(index, how), how) for pair in zip(xs.tolist(), ys.tolist())}
    assert wanted and wanted <= got and len(got) < 0.8 * len(x)


def test_alignment_counts_words_as_row_by_row():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(0, 30)).astype(np.int32) for _ in "ab")
        row = [0] * (len(b) + 1)
        for word in a.tolist():
            new = [0]
            for j, other in enumerate(b.tolist()):
                new.append(row[j] + 1 if word == other else max(row[j + 1], new[-1]))
            row = new
        assert substring.common_words(a, b) == row[-1]


def test_chains_equal_quadratic_search():
    import numpy as np

    how = substring.Passages()
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = int(rng.integers(1, 25))
        q, r = np.sort(rng.integers(0, 200, n)), rng.integers(0, 200, n)
        best = np.zeros(n)
        order = np.lexsort((-r, q))
        for place, i in enumerate(order):
            options = [0.0]
            for j in order[:place]:
                if r[j] < r[i]:
                    cost = how.gap_cost * ((q[i] + r[i]) - (q[j] + r[j]) - 2 * how.seed)
                    options.append(best[j] - cost)
            best[i] = how.seed + max(options)
        chain = substring.chains(q, r, how)[0]
        score = how.seed
        for a, b in zip(chain, chain[1:]):
            assert q[b] >= q[a] and r[b] > r[a]
            score += how.seed - how.gap_cost * ((q[b] + r[b]) - (q[a] + r[a]) - 2 * how.seed)
        assert abs(score - best.max()) < 1e-9


def test_rising_matches_chain_as_the_tree_has_them():
    how = substring.Passages()
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        q, r = np.cumsum(rng.integers(1, 25, n)), np.cumsum(rng.integers(1, 25, n))
        assert substring.rising(q.tolist(), r.tolist(), how) == substring.linked(q, r, how)


def test_minimisers_equal_windows_one_by_one():
    rng = np.random.default_rng(9)
    texts = [rng.integers(0, 9, n).astype(np.uint64) for n in (0, 1, 3, 4, 5, 40, 2)]
    starts, row = [], []
    for t in texts:
        starts.append(len(row))
        row += [*t, *[np.iinfo(np.uint64).max] * 4]
    counts = np.array([len(t) for t in texts])
    at, text = substring.minimisers(np.array(row, np.uint64), np.array(starts), counts, 4)
    wanted = []
    for i, t in enumerate(texts):
        if len(t):
            ends = range(max(len(t) - 3, 1))
            wanted += [(i, starts[i] + p) for p in sorted({s + int(np.argmin(t[s : s + 4])) for s in ends})]
    assert list(zip(text.tolist(), at.tolist())) == wanted


def test_marks_hold_all_marked_hashes(spark):
    rng = np.random.default_rng(10)
    hashes = rng.integers(-(2**63), 2**63 - 1, 5000)
    keys = spark.createDataFrame([(int(h),) for h in hashes[:2000]], "h long")
    held = marks(keys, "h").holds(hashes)
    assert held[:2000].all() and held[2000:].mean() < 0.1
    assert not marks(keys.limit(0), "h").holds(hashes).any()


def test_long_runs_have_the_hashes_of_runs():
    rng = np.random.default_rng(4)
    for n in (0, 1, 49, 50, 51, 400):
        words = rng.integers(0, 2**64, n, np.uint64, endpoint=False)
        assert np.array_equal(substring.long_runs(words.copy(), 50), runs(words.copy(), 50))


def laid_pair(texts):
    how = substring.Passages()
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*texts)], ["key", "text"])
    (documents,) = substring.documents_of(how, Everything())(iter([batch]))
    own, index = substring.laid(documents, -2), substring.laid(documents, -1)
    order = np.lexsort((index.keys[index.text], index.seed))
    return documents, own, dataclasses.replace(index, **{n: getattr(index, n)[order] for n in ("text", "seed", "at", "before")})


def test_a_line_of_many_documents_is_told_from_what_stands_around_it():
    """17 words between words of their own: the line itself is no reason to compare two documents in full."""
    rng, how = random.Random(8), substring.Passages()
    line = [f"line{i}" for i in range(17)]
    texts = [(i, " ".join([f"w{rng.randrange(50_000)}" for _ in range(30)] + line + [f"w{rng.randrange(50_000)}" for _ in range(i % 40)])) for i in range(200)]
    shared = [f"same{i}" for i in range(40)]
    texts += [(200 + i, " ".join([f"w{rng.randrange(50_000)}" for _ in range(30)] + line + shared)) for i in range(2)]
    _, own, index = laid_pair(texts)
    got = [(own.keys[own.text[a]], index.keys[index.text[b]]) for x, y in substring.pairs_of(own, substring.Block(index, how), how) for a, b in zip(x, y)]
    assert (201, 200) in got
    assert len(got) < 0.1 * 202 * 201 / 2


def test_seeds_with_a_partner_that_may_share_a_passage_are_kept():
    rng, how = random.Random(52), substring.Passages()
    vocabulary = [f"w{i}" for i in range(400)]
    line, texts = [f"line{i}" for i in range(9)], []
    for i in range(90):
        plain = rng.choices(vocabulary, k=70)
        texts.append((2 * i, " ".join(plain + line + rng.choices(vocabulary, k=i % 30))))
        changed = [w if rng.random() < 0.6 + i / 200 else "other" for w in plain]
        texts.append((2 * i + 1, " ".join(changed + line * (i % 2))))
    documents, own, index = laid_pair(texts)
    same = np.argwhere((own.seed[:, None] == index.seed) & (own.keys[own.text][:, None] > index.keys[index.text]))
    x, y = same[~((own.before[same[:, 0]] == index.before[same[:, 1]]) & (own.before[same[:, 0]] != 0))].T
    alone, good, _, _ = substring.alike(own.words, own.at[x], index.words, index.at[y], how)
    blobs = {}
    for row in (r for b in substring.occurrences(how, 1, 0)(iter([documents])) for r in b.to_pylist()):
        blobs.setdefault(row["part"], []).append(row["records"])
    kept, pairs = set(), set()
    for part in blobs.values():
        for batch in substring.promising(how)({0: part}):
            for row in batch.to_pylist():
                if row["kind"]:
                    pairs |= {(int(r["key"]), int(r["other"]), int(r["place"]), int(r["other_place"])) for r in np.frombuffer(row["records"], substring.BOTH)}
                else:
                    kept |= {(int(r["key"]), int(r["place"])) for r in np.frombuffer(row["records"], substring.KEPT)}
    assert good.any() and not alone.all() and len(kept) < 0.9 * len(own.seed)
    for a, b, single in zip(x[good].tolist(), y[good].tolist(), alone[good].tolist()):
        one = int(own.keys[own.text[a]]), int(own.at[a] - own.starts[own.text[a]])
        two = int(index.keys[index.text[b]]), int(index.at[b] - index.starts[index.text[b]])
        assert {one, two} <= kept or not single and (one[0], two[0], one[1], two[1]) in pairs


def test_many_ends_at_once_are_those_found_one_by_one():
    rng, how = random.Random(77), substring.Passages()
    one, two = [], []
    for _ in range(400):
        kinds = rng.choice([3, 8, 50, 1000])
        a = [rng.randrange(kinds) for _ in range(rng.randrange(150))]
        b = list(a)
        for _ in range(rng.randrange(20) if b else 0):
            at = rng.randrange(len(b) or 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(kinds) for _ in range(rng.randrange(2))]
        one.append(np.array(a, np.int32))
        two.append(np.array(b, np.int32))
    rows = [substring.padded(pa.array([x.tobytes() for x in c], pa.binary()), filler) for c, filler in ((one, -1), (two, -2))]
    (a, i, p), (b, j, q) = rows
    n, m = np.diff(p), np.diff(q)
    for step in (1, -1):
        starts = (i, j) if step > 0 else (i + n - 1, j + m - 1)
        got = np.stack(substring.extend_all(a, starts[0], n, b, starts[1], m, step, how)).T.tolist()
        assert got == [list(substring.extend(x[::step], y[::step], how)[0]) for x, y in zip(one, two)]
        on = substring.equal_run(a, starts[0], b, starts[1], step)
        still = substring.stays(a, starts[0] + step * on, b, starts[1] + step * on, step, how)
        assert still.any() and all(list(g) == [k, k, k] for g, k, s in zip(got, on.tolist(), still) if s)


def test_passages_within_a_copied_one_are_left_out_before_they_are_aligned():
    rng, how = random.Random(3), substring.Passages()
    passage = [f"p{i}" for i in range(80)]
    texts = [(i, " ".join([f"w{rng.randrange(50_000)}" for _ in range(30)] + passage + [f"w{rng.randrange(50_000)}" for _ in range(30)])) for i in range(3)]
    texts[2] = (2, texts[2][1].rsplit(" ", 30)[0] + " " + " ".join(texts[1][1].split()[-30:]))
    documents, _, index = laid_pair(texts)
    covers = pa.array([b"", *[np.array([30, 110], np.int32).tobytes()] * 2], pa.binary())
    own = substring.laid(pa.RecordBatch.from_arrays([*documents.columns, covers], [*documents.schema.names, "covers"]), -2)
    x, y = (np.concatenate(c) for c in zip(*substring.pairs_of(own, substring.Block(index, how), how)))
    q, r = own.at[x] - own.starts[own.text[x]], index.at[y] - index.starts[index.text[y]]
    got = substring.without_held([own.text[x], index.text[y], q, r, q, np.ones(len(x), bool)], own, index, how)
    assert {(own.keys[a], index.keys[b]) for a, b in zip(own.text[x], index.text[y])} == {(1, 0), (2, 0), (2, 1)}
    assert {(own.keys[a], index.keys[b]) for a, b in zip(got[0], got[1])} == {(2, 1)}
