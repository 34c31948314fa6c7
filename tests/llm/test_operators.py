"""Each corpus operator against a plain brute-force version, and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from pricegrain.llm import fingerprint, licenses, mixing, simhash, toxicity, url_filter
from pricegrain.llm.common import IdRanges, crc_bucket
from pricegrain.llm.decontaminate import LEAST_WORDS, SeedIndex, WordHasher, best_stretch, contaminated, masks_of
from pricegrain.llm.fingerprint import fingerprints
from pricegrain.llm.graph import components
from pricegrain.llm.language_id import PROFILE, predict_language
from pricegrain.llm.mixing import mix
from pricegrain.llm.repeats import LENGTH, remove_repeats, repeated_by_window
from pricegrain.llm.tokens import token_counts
from pricegrain.llm.toxicity import BlockMaxIndex, score_toxicity

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, labels string, at long, range long"


def rows(spark, texts, langs=None, sources=None, ids=None):
    """Documents with further columns whose names clash with those that operators make."""
    n = len(texts)
    data = [(ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "s", 1, 0.5, "x", 7, 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA).repartition(3) if n else spark.createDataFrame([], SCHEMA)


WORDS = [a + b + c for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "ti", "vu", "xe") for b in ("ba", "de", "fi", "go", "hu", "ja", "ke", "li", "mo", "nu") for c in "bdfghklmnprst"]


ODD = [None, "", " \n", "A", "?!.", "é" * 300, "wörd " * 2000, "same text here", "same text here", "the end of it all"]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1: language ID


def plain_grams(text):
    out, x = Counter(), " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    x = re.sub(" +", " ", x)
    for n in (1, 2, 3):
        for i in range(len(x) - n + 1):
            g = x[i : i + n]
            if not (n == 1 and g == " ") and not (n == 3 and g[1] == " "):
                out[g] += 1
    return out if x.strip() else Counter()


def code(g):
    value = 0
    for c in g:
        value = value << 21 | (1 if c == " " else ord(c))
    return value


def ranked(c):
    return {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:PROFILE])}


def test_language_matches_brute_force(spark, small):
    got = by_id(predict_language(small, crc_bucket(F.col("doc_id"), 4) != 2))
    docs = small.withColumn("b", crc_bucket(F.col("doc_id"), 4)).collect()
    total = defaultdict(Counter)
    for r in docs:
        if r["b"] != 2:
            total[r["lang"]].update(plain_grams(r["text"]))
    profiles = {lang: ranked(c) for lang, c in total.items()}
    right = 0
    for r in docs:
        mine = ranked(plain_grams(r["text"]))
        d = {lang: sum(abs(p[g] - i) if g in p else PROFILE for g, i in mine.items()) / (PROFILE * len(mine)) for lang, p in profiles.items()}
        best = min(sorted(d), key=d.get)
        assert got[r["doc_id"]]["lang_pred"] == best
        assert got[r["doc_id"]]["distance"] == pytest.approx(d[best])
        right += best == r["lang"]
    assert right / len(docs) > 0.95


def test_language_on_odd_rows(spark):
    got = by_id(predict_language(rows(spark, ODD, langs=["en", None] * 5), F.lit(True)))
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 4)] == ["und"] * 4
    assert got[0]["score"] == 0 and all(0 <= r["score"] <= 1 for r in got.values())
    assert predict_language(rows(spark, []), F.lit(True)).count() == 0
    nothing = predict_language(rows(spark, ["some words"], langs=[None]), F.lit(True)).collect()
    assert nothing[0]["lang_pred"] == "und"


# --- 2: toxicity


def index_of(vectors, labels, n_terms, prior=0.3):
    owner = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    term, weight = (np.concatenate([v[k] for v in vectors]) for k in (0, 1))
    return BlockMaxIndex(np.arange(len(vectors)), np.array(labels), owner, term.astype(np.int64), weight, n_terms, prior)


@pytest.mark.parametrize(("lists", "full"), [(1, 0), (1, 5), (40, 5), (10**6, 0)])
def test_block_max_index_is_exact(monkeypatch, lists, full):
    monkeypatch.setattr(toxicity, "LONG_LIST", lists)
    monkeypatch.setattr(toxicity, "MOST_FULL", full)
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(1500):  # groups with terms of their own, and common ones
        terms = np.unique(np.concatenate((rng.integers(0, 40) * 5 + rng.choice(5, 2), rng.choice(np.arange(200, 206), 3))))
        w = rng.random(len(terms)) * np.where(terms >= 200, 0.2, 1)
        vectors.append((terms, w / np.linalg.norm(w)))
    vectors.append((np.empty(0, np.int64), np.empty(0)))
    labels = (rng.random(len(vectors)) < 0.3).astype(int)
    index = index_of(vectors, labels, 206)
    dense = np.zeros((len(vectors), 206))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for g in range(40):
        terms = np.array([5 * g, 5 * g + 3, 200, 204])
        w = np.array([0.6, 0.79, 0.1, 0.05])
        sims = dense[:, terms] @ w
        for without in (None, int(np.argmax(sims))):
            at, got = index.nearest(terms, w, 10, without)
            if without is not None:
                sims[without] = 0
            want = np.sort(sims[sims > 0])[::-1]
            assert np.allclose(got, want[: len(got)], atol=1e-5) and len(got) >= min(10, len(want))
            assert without not in index.doc_id[at]
    if lists == 1:
        assert index.scored < 0.6 * 80 * index.blocks  # blocks that cannot matter are not scored


def test_index_is_filled_without_a_second_copy_of_its_postings():
    rng = np.random.default_rng(4)
    vectors = [(np.sort(rng.choice(5000, 300, replace=False)), rng.random(300)) for _ in range(1500)]
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    owner, term, weight = np.repeat(np.arange(1500), 300), np.concatenate([t for t, _ in vectors]), np.concatenate([w for _, w in vectors])
    given = tracemalloc.get_traced_memory()[0] - before
    index = BlockMaxIndex(np.arange(1500), np.zeros(1500), owner, term, weight, 5000, 0.3)
    peak = tracemalloc.get_traced_memory()[1] - before - given
    tracemalloc.stop()
    own = sum(a.nbytes for a in vars(index).values() if isinstance(a, np.ndarray))
    assert own < peak < 1.6 * own
    for t in (0, 7, 4999):  # lists stand in order of the examples
        lo, hi = index.begin[t], index.begin[t + 1]
        assert hi - lo == (term == t).sum() and np.all(np.diff(index.example[lo:hi]) > 0)
        assert sorted(index.weight[lo:hi].tolist()) == sorted(weight[term == t].astype(np.float32).tolist())


def test_postings_come_to_the_index_in_parts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 7)
    rng = np.random.default_rng(5)
    terms = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2))
    found = [np.flatnonzero(rng.random(40) < 0.3) for _ in range(50)]
    made = [(i, i % 2, terms[f].tobytes(), np.ones(len(f), np.int32).tobytes()) for i, f in enumerate(found)]
    counted = spark.createDataFrame(made, "doc_id long, toxic int, terms binary, counts binary")
    known, have, bad = toxicity.vocabulary(counted)
    assert known.tolist() == [int(t) for k, t in enumerate(terms) if any(k in f for f in found)] and bad.sum() == sum(len(f) for f in found[1::2])
    assert have.tolist() == np.bincount(np.concatenate(found), minlength=40)[np.isin(terms, known)].tolist()
    weight = rng.random(len(known)) + 0.5
    got = list(toxicity.ordered_vectors(counted, known, weight, have, 50))
    keys = [(*toxicity.leading(t, w, have), len(t), i) for i, _, t, w in got]
    assert keys == sorted(keys) and sorted(i for i, *_ in got) == list(range(50))
    for i, label, t, w in got:
        assert label == i % 2 and known[t].tolist() == terms[found[i]].tolist()
        assert np.allclose(w, weight[t] / np.linalg.norm(weight[t]), atol=1e-6)


def test_texts_hashed_together_have_the_same_terms():
    hasher = toxicity.TermHasher()
    texts = ["", None, "a bc defghijkl", "x" * (toxicity.CHUNK + 50) + " tail", "Ünï wörds", "  ", "more words here"] * 2
    got = [([], []) for _ in texts]
    for first, at, words, more_at, prefixes in hasher.of_many(texts):
        for k, hashes, where in ((0, words, at), (1, prefixes, more_at)):
            for i, h in zip(where.tolist(), hashes.tolist(), strict=True):
                got[first + i][k].append(h)
    for text, found in zip(texts, got, strict=True):
        for mine, alone in zip(found, hasher.of(text), strict=True):
            assert sorted(mine) == sorted(alone.tolist())


def test_isotonic_calibration():
    rng = np.random.default_rng(3)
    votes = np.round(rng.random(3000), 2)
    toxic = (rng.random(3000) < votes**2).astype(int)
    c = toxicity.Calibration(votes, toxic, 0.3)
    assert np.all(np.diff(c(np.linspace(0, 1, 200))) >= 0)
    for lo in (0.1, 0.4, 0.7):
        inside = (votes >= lo) & (votes < lo + 0.2)
        assert abs(c(votes[inside]).mean() - toxic[inside].mean()) < 0.03
    assert toxicity.Calibration(np.empty(0), np.empty(0), 0.2)(np.array([0.5])).tolist() == [0.2]


def plain_scores(texts, tags, learn):
    """Votes by dense cosine over all words of the examples, without any index."""
    words = lambda t: re.findall(r"[0-9a-z\x80-\uffff]+", (t or "").lower())
    examples = [(i, t) for i, t in texts.items() if i in tags and learn(i)]
    toxic = sum(tags[i] for i, _ in examples)
    prior = toxic / len(examples)
    features = lambda t: Counter(words(t)) + Counter(f"{w.encode()[:n]}*{n}" for w in words(t) for n in toxicity.PREFIXES if len(w.encode()) > n)
    have, bad = Counter(), Counter()
    for i, t in examples:
        have.update(set(features(t)))
        if tags[i]:
            bad.update(set(features(t)))
    goes = {f for f in have if have[f] >= toxicity.LEAST_DOCS and bad[f] > have[f] * prior and toxicity.g2(np.array([have[f] * 1.0]), np.array([bad[f] * 1.0]), len(examples), toxic)[0] >= toxicity.LEAST_G2}
    known = {f for f in have if "*" not in f or f in goes}
    df = Counter(f for t in texts.values() for f in set(features(t)) & known)
    place = {f: k for k, f in enumerate(sorted(known))}

    def vector(t):
        v = np.zeros(len(place))
        for f, n in features(t).items():
            if f in place:
                v[place[f]] = (1 + math.log(n)) * math.log((1 + len(texts)) / (1 + df[f])) * (1 if f in goes else toxicity.OTHERS)
        unseen = [(1 + math.log(n)) * math.log((1 + len(texts)) / 2) * toxicity.OTHERS for f, n in features(t).items() if "*" not in f and f not in place]
        return v / (np.linalg.norm([*v, *unseen]) or 1)

    matrix = np.array([vector(t) for _, t in examples])
    labels = np.array([tags[i] for i, _ in examples], float)
    out = {}
    for i, t in texts.items():
        s = matrix @ vector(t)
        top = np.sort(s)[::-1][: toxicity.NEIGHBOURS]
        at = np.flatnonzero((s >= top[-1] - 1e-6) & (s > 1e-12))
        weight = toxicity.SOFT / (1 - np.minimum(1, s[at]) + toxicity.SOFT)
        out[i] = ((weight * labels[at]).sum() + toxicity.PRIOR * prior) / (weight.sum() + toxicity.PRIOR)
    return out


def test_toxicity_matches_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    texts, tags = {}, {}
    for i in range(300):
        words = [rng.choice(WORDS) for _ in range(rng.randint(1, 40))]
        tags[i] = int(i % 6 == 0)
        if tags[i]:
            words.insert(0, rng.choice(["vilehead", "vileness", "grub", "dunce"]))
        texts[i] = " ".join(words)
    texts[300], texts[301] = "", "no known words"
    texts[302], texts[303] = "vilehead " + texts[1], "vilehead " + texts[1] + " qx" * 3 + "".join(f" strange{i}" for i in range(60))
    docs = rows(spark, list(texts.values()), ids=list(texts))
    labels = spark.createDataFrame([(i, 1, t) for i, t in tags.items()], "doc_id long, quality int, toxic int")
    got = by_id(score_toxicity(docs, labels, F.col("doc_id") % 3 != 1))
    want = plain_scores(texts, tags, lambda i: i % 3 != 1)
    for i in texts:
        assert got[i]["vote"] == pytest.approx(want[i], abs=1e-4), i
    assert got[302]["vote"] != got[303]["vote"]  # unknown words count in the norm


def test_toxicity_finds_held_out_words(spark):
    rng = random.Random(3)
    common = ["the", "of", "and", "house", "tree", "river", "stone", "bread"]
    bad = ["vileword", "nastyword", "grimword"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(common) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[3:3] = rng.sample(bad, 2)
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    docs = rows(spark, [*texts, None, "", "vileword nastyword"], ids=list(range(403)))
    tags = spark.createDataFrame([*labels, (0, 1, 1), (9999, 1, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    got = by_id(score_toxicity(docs, tags, crc_bucket(F.col("doc_id"), 3) != 1))
    assert all(got[i]["predicted"] == (i % 5 == 0) for i in range(400))
    assert got[400]["predicted"] == got[401]["predicted"] == 0 and got[402]["predicted"] == 1
    assert set(got[402]["evidence"]) <= {i for i in range(400) if i % 5 == 0}
    assert got[400]["score"] == got[401]["score"]


def test_toxicity_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in score_toxicity(rows(spark, ODD), empty, F.lit(True)).collect()} == {0}
    assert score_toxicity(rows(spark, []), empty, F.lit(True)).count() == 0


# --- 3: licences


def plain_base(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.encode().split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), sorted(starts), ",".join(sorted(labels))


def test_licenses(spark, small):
    texts = [*ODD, "Released under the MIT License.", "x CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "free of charge", "CC\nBY cc by", "apache license apache license"]
    got = by_id(licenses.license_scan(rows(spark, texts)))
    for i, t in enumerate(texts):
        n, starts, labels = plain_base(t)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"], r["spans"]) == (n, len(starts), labels, starts)
        assert (r["first_word"], r["last_word"]) == ((starts[0], starts[-1]) if starts else (None, None))
        assert set(filter(None, labels.split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[11]["labels"] == "cc-by,cc-by-nc-4.0"
    assert got[12]["labels"] == "gpl,gpl-3.0"
    assert got[13]["labels"] == "mit" and got[13]["n_base"] == 0 and got[13]["score"] > 0.9
    assert got[14]["labels"] == "" and got[14]["score"] == 0
    for r in licenses.license_scan(small).join(small.select("doc_id", "text"), "doc_id").collect():
        n, starts, labels = plain_base(r["text"])
        assert (r["n_words"], r["spans"], r["base_labels"]) == (n, starts, labels)
    assert licenses.license_scan(rows(spark, [])).count() == 0


def test_license_notice_out_of_step(spark):
    """The usual ISC notice lacks a word of the template before its key phrase; common words must not hide it."""
    isc = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"
    common = "permission to use copy modify and or distribute this software for any purpose"
    got = by_id(licenses.license_scan(rows(spark, [isc, *["plain text"] * 5])))
    assert "isc" in got[0]["labels"].split(",")
    words = licenses.words_of(isc)
    index = licenses.RareTokenIndex(licenses.TEMPLATES, 1000, {w: 0 if w in common.encode().split() else 3 for _, n, _ in licenses.TEMPLATES for w in n.encode().split()})
    places = defaultdict(list)
    for i, w in enumerate(words):
        places[w].append(i)
    assert set(index.labels(words, places)) == {"isc"}


# --- 4: decontamination


def test_decontamination(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (40, 25, 16, 8, 3)]
    noise = lambda n: [word() for _ in range(n)]
    swapped = [w if i % 9 != 4 else word() for i, w in enumerate(items[0])]
    texts = [
        " ".join(noise(50) + items[0] + noise(50)), " ".join(noise(20) + swapped + noise(5)), " ".join(items[1]).upper(),
        " ".join(noise(30) + items[1][:8] + noise(30)), ", ".join(noise(9) + items[3]), " ".join(noise(200)), None, "", " ".join(items[4]), " ".join(items[2] * 3),
        " ".join(noise(10) + items[0][5:20] + noise(10)),
    ]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(77, None), (78, "")], "item_id long, text string")
    for block in (1 << 20, 60):
        got = {(r["doc_id"], r["item_id"]): r for r in contaminated(rows(spark, texts), bench, block).collect()}
        assert set(got) == {(0, 0), (1, 0), (2, 1), (4, 3), (8, 4), (9, 2), (10, 0)}
        assert (got[0, 0]["first_word"], got[0, 0]["end_word"], got[0, 0]["n_equal"]) == (50, 90, 40)
        assert got[1, 0]["n_equal"] >= 30
    assert contaminated(rows(spark, []), bench).count() == 0
    assert contaminated(rows(spark, texts), bench.limit(0)).count() == 0


def test_passages_behind_a_replaced_part():
    item = [f"w{i}" for i in range(73)]
    index = SeedIndex([(1, " ".join(item[:29])), (2, " ".join(item))])
    copied = lambda n, lo, hi: " ".join(w if not lo <= i < hi else f"x{i}" for i, w in enumerate(item[:n]))
    words = WordHasher().words
    assert index.overlaps(words(copied(29, 8, 15)))[0] == (22, 29, 0, 29)
    assert index.overlaps(words(copied(73, 12, 32)))[1] == (41, 41, 32, 73)


def test_short_items_are_found_where_they_stand_whole(spark):
    items = {1: "quark", 2: "two words", 3: "just three words", 4: "an item of four", 5: "one more of five words"}
    texts = ["a quark, here", "Two  words", "just three", "say just THREE words", "an item for four", "an item of four.", "an item of two words", "quarks"]
    got = contaminated(rows(spark, texts), spark.createDataFrame([(*x, 1) for x in items.items()], "item_id long, text string, n int"))
    assert {(r["doc_id"], r["item_id"], r["n_equal"]) for r in got.collect()} == {(0, 1, 1), (1, 2, 2), (3, 3, 3), (5, 4, 4), (6, 2, 2)}


def test_masks_lose_no_overlap():
    """No pattern of equal (1) and other words that counts goes without a hit; one over 33 words has a half that counts."""
    for length in range(LEAST_WORDS, 34):
        masks = [(len(m), int(m, 2)) for m in masks_of(length)]
        need, keep = min(13, 0.8 * length), (1 << (max(n for n, _ in masks) - 1)) - 1
        most = {0: 0}  # last words of a pattern without a hit -> most equal words
        for n in range(1, length + 1):
            longer: dict[int, int] = {}
            for state, m in most.items():
                for bit in (0, 1):
                    x = state << 1 | bit
                    if not any(n >= size and x & mask == mask for size, mask in masks):
                        longer[x & keep] = max(longer.get(x & keep, 0), m + bit)
            most = longer
            assert not any(m >= need and m >= 0.75 * n for m in most.values()), (length, n)


def test_recall_of_replaced_words():
    rng = np.random.default_rng(4)
    words = WordHasher().words
    for length in (5, 6, 8, 10, 11, 12, 15, 24, 59):
        item = [f"w{i}" for i in range(length)]
        index = SeedIndex([(1, " ".join(item))])
        some = [rng.random(length) < share for share in (0.75, 0.8, 0.85, 0.9, 0.95) for _ in range(40)]
        for equal in (*some, *(np.arange(length) % k != k - 1 for k in (4, 5, 6))):
            m = max(equal[a:b].sum() for a in range(length + 1) for b in range(a, length + 1) if equal[a:b].sum() >= 0.75 * (b - a))
            text = " ".join(w if e else f"x{i}" for i, (w, e) in enumerate(zip(item, equal, strict=True)))
            found = index.overlaps(words(f"a b c {text} d e"))
            assert found.get(0, (0,))[0] == (m if m >= min(13, 0.8 * length) else 0)


def test_best_stretch_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 40)) < rng.choice([0.3, 0.6, 0.75, 0.9])
        m, start, end = best_stretch(equal)
        assert m == equal[start:end].sum() and m >= 0.75 * (end - start)
        assert m == max(equal[a:b].sum() for a in range(len(equal) + 1) for b in range(a, len(equal) + 1) if equal[a:b].sum() >= 0.75 * (b - a))


# --- 5: fingerprints


def test_fingerprints(spark, small):
    for docs in (rows(spark, [*ODD, "ab cd éf gh ij kl mn op"]), small):
        got = by_id(fingerprints(docs))
        data = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
        for (i, t), (j, u) in zip(data, data[1:] + data[:1], strict=True):
            half = len(t) // 2
            edited = t[: len(t) - half] + u[:half]
            r = got[i]
            assert r["n_chars"] == len(t)
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b, c = ({f[k : k + 16] for k in range(0, len(f), 16)} for f in (r["fingerprint"], r["edited_fingerprint"], got[j]["fingerprint"]))
            assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
            assert r["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1)
            if t == u:
                assert r["fingerprint"] == got[j]["fingerprint"]
    assert fingerprints(rows(spark, [])).count() == 0
    assert fingerprints(rows(spark, ["one"])).collect()[0]["near_next"] == 1
    again = fingerprints(rows(spark, ["b c", "b c", "a"], ids=[1, 1, None]))
    assert again.count() == 3


def test_containment_of_unequal_documents(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    r = by_id(fingerprints(rows(spark, [" ".join(words[:400]), " ".join(words)])))[0]
    assert r["in_next"] > 0.95 and r["next_in"] < 0.2 and r["near_next"] < 0.2


def test_sketches_merge(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    pairs = [(text(n), text(m)) for n in (0, 5, 6, 40, 300) for m in (0, 5, 7, 300)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", fingerprint.sketch(F.col("a")).alias("x"), fingerprint.sketch(F.col("b")).alias("y"))
    for r in df.select("*", fingerprint.merged(F.col("x"), F.col("y")).alias("both")).collect():
        every = {h for h in (*r["x"], *r["y"])}
        low = sorted(h for h in every if h < fingerprint.THRESHOLD)
        assert r["both"] == (low or sorted(every)[:1])
        assert all(h < fingerprint.THRESHOLD for h in r["both"]) or len(r["both"]) == 1


def test_wide_and_skewed_ids(spark):
    ids = [-(2**63), -5, 0, *range(1, 3000), 2**60, 2**63 - 1, None, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    ranges = IdRanges(df, "doc_id", rows_per_range=100)
    got = df.select("doc_id", ranges.of(F.col("doc_id")).alias("r")).collect()
    by = sorted((r["doc_id"], r["r"]) for r in got if r["doc_id"] is not None)
    assert [r for _, r in by] == sorted(r for _, r in by)
    assert {r["r"] for r in got if r["doc_id"] is None} == {0} and min(r for _, r in by) == 1
    assert max(np.bincount([r for _, r in by])) < 400
    docs = spark.createDataFrame([(i, f"text of {i}", "s") for i in ids], "doc_id long, text string, source string")
    assert fingerprints(docs).count() == len(ids) == mix(docs).count()


# --- 6: URL filter


def plain_url(url):
    rest = (url or "").partition("://")
    if not rest[1]:
        return "", ""
    host = re.match(r"[^/?#]*", rest[2])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[2][len(host) :])[0]


def test_url_rules_and_rank(spark):
    urls = [None, "", "no scheme.com/", "http://A.Example.COM/en/x?y", "https://www.example.com/en/", "http://x.net/es/1", "http://x.net/de/1", "http://y.org/fr/", "http://z.org", "ftp://com", "http://a://b.com/q", "http://lonely.info/#/en/", "http://notexample.com/en/a", "http://fr.net/fr/a\nb"]
    html = ["<a href='http://y.org/a'>" if "x.net" in (u or "") else None for u in urls]
    pages = spark.createDataFrame([(i, u, h, "clash", 1.0) for i, (u, h) in enumerate(zip(urls, html, strict=True))], "page_id long, url string, html string, host string, score double")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = plain_url(u)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = got[i]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[1] if fits else None)
        if fits:
            assert r["verdict"] == max(fits)[2]
    assert got[6]["verdict"] == "block" and got[0]["verdict"] == "allow" and got[11]["verdict"] == "allow"
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_propagation_matches_power_iteration(spark):
    edges = [("a", "b", 2.0), ("b", "c", 1.0), ("c", "a", 1.0), ("a", "c", 1.0), ("d", "c", 1.0)]
    seeds = [("trust", "a", 1.0), ("distrust", "c", 1.0)]
    got = {(r["kind"], r["host"]): r["score"] for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, links double"), spark.createDataFrame(seeds, "kind string, host string, share double")).collect()}
    for kind, start in (("trust", "a"), ("distrust", "c")):
        way = [(s, d, w) if kind == "trust" else (d, s, w) for s, d, w in edges]
        out = Counter()
        for s, _, w in way:
            out[s] += w
        score = {start: 0.15}
        for _ in range(url_filter.ROUNDS):
            new = Counter({start: 0.15})
            for s, d, w in way:
                new[d] += 0.85 * score.get(s, 0) * w / out[s]
            score = new
        for h, x in score.items():
            assert got.get((kind, h), 0) == pytest.approx(x)


# --- 7: SimHash


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[find(j)] = find(i)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return {x: least[find(i)] for i, x in enumerate(ids)}


def test_simhash_matches_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    rng = random.Random(4)
    for i in range(120):
        words = texts[rng.randrange(200)].split()
        words[rng.randrange(len(words))] = "changed"
        texts[1000 + i] = " ".join(words)
    for i, t in enumerate(ODD):
        texts[2000 + i] = t
    ids = list(texts)
    prints = [plain_simhash(texts[i]) for i in ids]
    want = plain_components(prints, ids)
    got = by_id(simhash.near_duplicates(rows(spark, list(texts.values()), ids=ids)))
    for i, p in zip(ids, prints, strict=True):
        assert got[i]["fingerprint"] == f"{p:016x}"
        assert got[i]["component_id"] == want[i]
    assert simhash.near_duplicates(rows(spark, [])).count() == 0


@pytest.mark.parametrize(("variants", "hot"), [(1 << 22, 1 << 20), (3000, 40)])
def test_ball_links_lose_nothing(spark, monkeypatch, variants, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:80]:
        for _ in range(4):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 5)):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "PER_BUCKET", 20)
    bits = 5
    bucket = simhash.Bucket(2)
    monkeypatch.setattr(simhash, "MOST_VARIANTS", variants)
    links = set()
    for prefix in range(1 << bits):
        dealt = [(p, (p >> 59 ^ prefix).bit_count()) for p in prints if (p >> 59 ^ prefix).bit_count() <= 2]
        fps = np.array([p for p, _ in dealt], np.uint64)
        for a, b in bucket.edges(fps, np.full(len(fps), prefix, np.uint64), np.array([d for _, d in dealt]), bits):
            links |= set(zip(a.tolist(), b.tolist(), strict=True))
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    by_spark = {(r["a"], r["b"]) for r in simhash.ball_links(spark.createDataFrame([(signed(p),) for p in prints], "fp long")).collect()}
    want = plain_components(prints, prints)
    for found in (links, {(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in by_spark}):
        root = {p: p for p in prints}
        for _ in range(len(prints)):
            changed = False
            for a, b in found:
                low = min(root[a], root[b])
                changed |= root[a] != low or root[b] != low
                root[a] = root[b] = low
            if not changed:
                break
        assert root == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 8: repeated passages


def plain_repeats(docs):
    seen, out = set(), {}
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - LENGTH + 1):
            w = b[p : p + LENGTH]
            if w in seen:
                gone[p : p + LENGTH] = b"\1" * LENGTH
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, kept)
    return out


def make_repeats(seed):
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice("abé cd\n") for _ in range(n))
    shared = [piece(n) for n in (80, 99, 100, 101, 150, 400, 30)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += [piece(rng.randint(0, 120)), rng.choice(shared)]
        texts.append("".join(parts))
    texts += [texts[3], texts[3] + "x", "y" + texts[5], "a" * 500, "ab" * 300, "ba" * 150, shared[5], shared[5][1:], shared[5][:-1], "z" * 99, "z" * 100, "z" * 100]
    for _ in range(20):
        t = list(shared[5] + shared[4] + shared[3])
        for k in rng.sample(range(len(t)), 3):
            t[k] = "Q"
        texts.append("".join(t))
    return texts + ODD


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats_match_brute_force(spark, monkeypatch, hot):
    from pricegrain.llm import repeats

    monkeypatch.setattr(repeats, "HOT_GROUP", hot)
    texts = make_repeats(hot)
    want = plain_repeats(list(enumerate(texts)))
    got = by_id(remove_repeats(rows(spark, texts)))
    for i in want:
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[i], i
    assert remove_repeats(rows(spark, [])).count() == 0


def test_repeats_with_repeated_and_null_ids(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh") for _ in range(150))
    got = remove_repeats(rows(spark, [long, long, long, "short"], ids=[5, 5, None, None])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (0, 0), (5, 150), (5, 150)]


def test_long_documents_are_cut_and_joined(spark, monkeypatch):
    from pricegrain.llm import repeats

    rng = random.Random(1)
    base = "".join(rng.choice("abcd ") for _ in range(3000))
    texts = [base, base[1000:2500] + "tail", base[:700] + "!" + base[700:]]
    monkeypatch.setattr(repeats, "CHUNK", 1 << 10)
    datas = [t.encode() for t in texts]
    covered = defaultdict(int)
    anchors = repeats.Anchors()
    for b, k, starts, ends, offset in repeats.packed_chunks([0, 1, 2], datas):
        _, _, first, n, _ = anchors.of(b, ends, starts)
        part = np.searchsorted(starts, first, "right") - 1
        for q, p, w in zip(k[part], first - starts[part] + offset[part], n, strict=True):
            for x in range(p, p + w):
                covered[q, x] += 1
    assert covered == {(q, x): 1 for q, d in enumerate(datas) for x in range(len(d) - LENGTH + 1)}


def test_repeated_by_window(spark):
    data = [(1, 1, 10, 2 * 128, "x" * 101), (1, 2, 0, 1 * 128, "x" * 100)]
    contexts = spark.createDataFrame([(a, d, p, n, bytearray(t.encode())) for a, d, p, n, t in data], "akey long, doc long, p0 long, no int, bytes binary")
    assert {(r["doc"], r["p0"]) for r in repeated_by_window(contexts).collect()} == {(1, 11), (2, 0)}


# --- 9: token counts


def test_tokens_match_the_library(spark, small):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [*ODD, "a<|endoftext|>b<|endoftext|>", "<|endoftext|>", "don't  stop\n\n\t x", "\x1c\x1d\u00a0\u2003x\u3000", "日本語のテキスト", "😀😀👩‍👩‍👧", "x" * 5000, "1234567890" * 30, " lead", "trail ", "\u0301e\u0301", "ǅ ª ² ½ Ⅷ ٣"]
    texts += [r["text"] for r in small.collect()]
    got = by_id(token_counts(rows(spark, texts), path))
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 512), repr(t)[:60]
    assert token_counts(rows(spark, []), path).count() == 0


# --- 10: mixing


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, over = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while over > 1e-9 and open_:
        share = over / sum(weight[s] for s in open_)
        over = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                over += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.remove(s)
    return target


def test_mixing(spark, small):
    rng = random.Random(6)
    sources = [rng.choice(["a", "b", "ü", "Z", None, "big", "big", "big"]) for _ in range(400)]
    texts = [None if i % 50 == 0 else " ".join(["w"] * rng.randint(0, 900)) for i in range(400)]
    for docs in (rows(spark, texts, sources=sources), small):
        got = by_id(mixing.mix(docs))
        sizes = Counter()
        for r in docs.collect():
            n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
            sizes[r["source"]] += n
            assert got[r["doc_id"]]["size"] == n
        target, taken = plain_targets(dict(sizes)), Counter()
        for r in got.values():
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken[r["source"]] += r["taken"]
        for s, t in target.items():
            assert abs(taken[s] - t) <= 3 * mixing.BLOCK + 0.01 * t
        assert {i: r["taken"] for i, r in by_id(mixing.mix(docs.repartition(5))).items()} == {i: r["taken"] for i, r in got.items()}
    assert mixing.mix(rows(spark, [])).count() == 0
    assert {r["taken"] for r in mixing.mix(rows(spark, [None, ""])).collect()} == {0}


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1001):
        df = spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n"), F.lit(3).cast("long").alias("s"), F.lit(1).alias("more"))
        got = [r["x"] for r in mixing.permuted(df, "x", "n", "s").collect()]
        assert sorted(got) == list(range(n))
        if n == 1001:
            assert abs(np.corrcoef(range(n), got)[0, 1]) < 0.15
    far = spark.range(2**40, 2**40 + 1000).select(F.col("id").alias("x"), F.lit(2**41 + 9).alias("n"), F.lit(3).cast("long").alias("s"))
    got = [r["x"] for r in mixing.permuted(far, "x", "n", "s").collect()]
    assert len(set(got)) == 1000 and abs(np.corrcoef(range(1000), got)[0, 1]) < 0.15 and np.std(got) > 2**38


def test_multinomial_draws_and_slots(spark):
    plan = [Row(slots=900 * (i + 1), blocks=500 * (i + 1) + 7) for i in range(5)]
    counts = mixing.shard_counts(spark, plan, shard=640).collect()
    per_shard, per_source = Counter(), Counter()
    for r in counts:
        per_shard[r["shard"]] += r["n"]
        per_source[r["source_no"]] += r["n"]
    assert [per_shard[k] for k in range(22)] == [640] * 21 + [60]
    for i in range(5):
        assert abs(per_source[i] - 900 * (i + 1)) < 5 * math.sqrt(900 * (i + 1))
        spread = np.var([next((r["n"] for r in counts if r["shard"] == k and r["source_no"] == i), 0) for k in range(21)])
        assert 0.3 < spread / (640 * (i + 1) / 15 * (14 - i) / 15) < 3  # the variance of a multinomial draw
    slots = mixing.mixture(spark, plan, shard=640).collect()
    for i in range(5):
        own = [r for r in slots if r["source_no"] == i]
        assert sorted(r["slot"] for r in own) == list(range(900 * (i + 1)))
        uses = Counter(r["block"] for r in own)
        assert set(uses) == set(range(plan[i]["blocks"])) and set(uses.values()) <= {1, 2}
    assert Counter(r["shard"] for r in slots) == per_shard
