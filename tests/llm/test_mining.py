"""Phrases, pairwise quality and source divergence against brute force, on odd little tables and on the smallest documents."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from millrace.llm import collocations, divergence, pairwise_quality, queries, wordcodes

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = " ".join(f"w{i % 7} of the, Thing w{i % 3}!" for i in range(3000))
TEXTS = [
    None, "", " \n\t", "one", "a b a b a b. a b a b", "A B\tA  B\x0ba b", "b b b b b b b b", "x. y, z a\rb", "é Ö é Ö é ö 日本 日本 日本", LONG, LONG,
    "the of the of the of", "the\x00 of a\x00b a\x00b", "q" * 5000, "q" * 5000 + " of", "a b a b a b. a b a b",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, long texts, repeated rows, a null and a repeated id, and columns whose names clash."""
    langs, sources = ["en", None, "de"], ["s1", "s2", None, "s3"]
    rows = [(i, t, langs[i % 3], sources[i % 4], 7, "k", 1) for i, t in enumerate(TEXTS)]
    rows += [(3, "one", "en", "s1", 1, None, 2), (None, "no id", "fr", "alone", 2, "x", 3), (40, None, "fr", "empty", 2, "x", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, term string, rank int")


def phrases_of(rows, most=4):
    """Counts by (lang, words)."""
    found = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, most + 1):
                for k in range(len(words) - n + 1):
                    found[(lang or "und", tuple(words[k : k + n]))] += 1
    return found


def mined(rows, least, top):
    f = phrases_of(rows)
    total = collections.Counter()
    for (lang, words), a in f.items():
        total[lang] += a if len(words) == 1 else 0
    by_lang = collections.defaultdict(list)
    for (lang, words), a in f.items():
        if len(words) > 1 and a >= least:
            score, k = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
            by_lang[lang].append((words, a, f[lang, words[:k]], f[lang, words[k:]], score))
    out = []
    for lang, found in by_lang.items():
        often = {w: a for w, a, *_ in found}
        covered = collections.Counter()
        for w, a in often.items():
            for size in range(2, len(w)):
                for k in range(len(w) - size + 1):
                    covered[w[k : k + size]] = max(covered[w[k : k + size]], a)
        own = [(-s, -a, " ".join(w).encode(), left, r) for w, a, left, r, s in found if 100 * covered[w] < 80 * a]
        out += [(lang, i, p.decode(), -a, left, r, total[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(own)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "top"), [(1, 2000), (3, 5), (10**9, 5)])
def test_phrases(odd, least, top):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(tuple(r) for r in collocations.mine(odd, least=least, top=top).collect()) == mined(rows, least, top)


def test_phrases_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in collocations.mine(docs, least=5, top=300).collect()) == mined(rows, 5, 300)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_runs_are_sorted_and_add_up(odd, n):
    """Tables that burst at three entries, tries that spill at thirty."""
    texts = odd.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).coalesce(1)
    got, order = collections.Counter(), []
    for r in collocations.runs(texts, n, burst=3, entries=30).collect():
        got[(r.lang, tuple(r.phrase.split(" ")))] += r.a
        order.append((r.lang, r.phrase.encode().split(b" ")))
    assert got == {k: v for k, v in phrases_of([(r.lang, r.text) for r in odd.collect()]).items() if len(k[1]) == n}
    assert sum(a > b for a, b in zip(order, order[1:], strict=False)) < len(order) / 2


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_trie(width):
    rng = random.Random(width)
    trie, want = collocations.HatTrie(width, burst=4), collections.Counter()
    for _ in range(60):
        own = collections.Counter(tuple(rng.choice([0, 1, 5, 70, 200, 2**31]) for _ in range(width)) for _ in range(20))
        keys = sorted(own)
        packed = [sum(x << 32 * (width - 1 - k) for k, x in enumerate(s)) for s in keys]
        trie.add(np.array([s[0] for s in keys], np.uint64), packed, [own[s] for s in keys])
        want += own
        assert trie.size == sum(size for size, _ in trie.subtrees())
        if rng.random() < 0.1:
            sequences, counts = trie.take([trie.subtrees()[0][1]])
            for s, c in zip(map(tuple, sequences.tolist()), counts.tolist(), strict=True):
                assert want.pop(s) == c
    sequences, counts = trie.take([name for _, name in trie.subtrees()])
    assert dict(zip(map(tuple, sequences.tolist()), counts.tolist(), strict=True)) == want and trie.size == 0


def test_bitmap_has_every_frequent_phrase(spark):
    rows = [("en", "a b"), ("en", "é ö"), ("de", "a b"), ("", "日本 x")]
    parts = collocations.bitmap_of(spark.createDataFrame(rows, "lang string, phrase string"), 2)
    for lang, phrase in rows:
        hashes = np.array([collocations.xxhash64(w) for w in phrase.split(" ")], np.uint64)
        assert parts.holds(collocations._hash_runs(np.uint64(collocations.xxhash64(lang)), hashes, 2)).all()
    hashes = np.arange(1, 10_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert parts.holds(hashes).mean() < 0.01


@pytest.mark.parametrize("overlap", [0, 1, 3])
def test_blocks_of_long_texts(monkeypatch, overlap):
    """Every run of words lies in one block, however small blocks are."""
    monkeypatch.setattr(wordcodes, "BLOCK", 24)
    texts = [None, "", "a bb ccc. d e f" * 9, "z" * 100, "z" * 100 + " y x w v u t, s", " . ", "k l m n o p q r s t u v w x y z " * 3]
    codes = wordcodes.Codes()
    got, want = collections.Counter(), collections.Counter()
    for ids, first, owner in wordcodes.coded(pa.array(texts), collocations.ALPHABET, codes, overlap):
        for k in range(len(ids) - overlap):
            if not first[k + 1 : k + overlap + 1].any():
                got[(int(owner[k]), b" ".join(codes.words[i] for i in ids[k : k + overlap + 1]))] += 1
    for i, text in enumerate(texts):
        for (_, words), n in phrases_of([("", text)]).items():
            if len(words) == overlap + 1:
                want[(i, " ".join(words).encode())] += n
    assert got == want


def audited(rows, least_docs, top):
    counts, docs, groups = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOW))
        for term in found:
            counts[lang, source, term] += 1
        for term in set(found):
            docs[lang, term] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least_docs]

        def shares(names, lang=lang, kept=kept):
            own = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            size = sum(own.values()) + len(kept)
            return {t: 1 + 10**9 * (n + 1) // size for t, n in own.items()}

        p = {s: shares([s]) for s in sources}
        q = shares(sources)
        for s in sources:
            parts = {"pair": [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]}
            parts["term"] = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s, t] and p[s][t] > q[t]]
            for part, found in parts.items():
                for rank, (v, item) in enumerate(sorted(found), 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, s, part, item.decode(), -v, rank))
    return sorted(out)


@pytest.mark.parametrize(("least_docs", "top"), [(1, 200), (2, 3), (99, 3)])
def test_divergence(odd, least_docs, top):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    got = divergence.audit(odd, least_docs=least_docs, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == audited(rows, least_docs, top)


def test_divergence_over_many_slices(spark, monkeypatch):
    """The same sums when every four terms are a slice."""
    monkeypatch.setattr(divergence, "SLICE_BITS", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == audited(rows, 3, 200)


def test_runs_of_large_counts():
    """Products past 64 bits stay exact; runs are intersected, not places."""
    slice_ = divergence._Slice(6)
    counts = {"p": [0, 0, 10**13, 10**13, 5, 5], "q": [1, 1, 1, 10**12, 10**12, 0]}
    size = {s: sum(c) + 6 for s, c in counts.items()}
    columns, shares = {}, {}
    for s, c in counts.items():
        places = np.array([k for k, x in enumerate(c) if x])
        columns[s] = slice_.column(places, np.array([x for x in c if x]), size[s])
        shares[s] = [1 + 10**9 * (x + 1) // size[s] for x in c]
    assert columns["p"][0].tolist() == [2, 4, 6]
    assert slice_.difference(columns["p"], columns["q"]) == sum((a - b) ** 2 // b for a, b in zip(shares["p"], shares["q"], strict=True))


def labelled(spark, n=400):
    rng = random.Random(3)
    words = ["the", "of", "rain", "river", "stone", "and", "walks", "slowly", "home"]
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(30, 80))]
        bad = rng.random() < 0.3
        docs.append((i, " ".join(f"{w}###" if bad and rng.random() < 0.5 else w for w in own), "x"))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_pairwise_quality_holds_on_what_it_has_not_seen(spark):
    docs, labels = labelled(spark)
    out = pairwise_quality.score(docs, pairwise_quality.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert len(out) > 50 and sum(r.predicted == r.quality for r in out) > 0.95 * len(out)


def test_pairwise_quality_of_documents(spark):
    folder = SMALL.replace("0.001", "0.01")
    out = queries.QUERIES["op12_pairwise_quality"](spark, folder)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.filter("score IS NULL OR score < 0 OR score > 1").isEmpty()
    seen = out.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in seen) > 0.95 * len(seen)


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("quality", F.when(pairwise_quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = pairwise_quality.fit(docs, labels), pairwise_quality.fit(docs, turned)
    assert (a.weights == b.weights).all() and a.shift == b.shift


def test_repeated_rows_count_once(spark):
    docs, labels = labelled(spark)
    hot = docs.filter("doc_id = 1").crossJoin(spark.range(200)).select(docs.columns)
    a, b = pairwise_quality.fit(docs, labels), pairwise_quality.fit(docs.unionByName(hot), labels.unionByName(labels))
    assert (a.weights == b.weights).all() and a.shift == b.shift


@pytest.mark.parametrize(("label", "want"), [(1, 1), (0, 0), (None, 0)])
def test_labels_of_one_kind(spark, odd, label, want):
    labels = spark.createDataFrame([(i, label) for i in range(12)], "doc_id long, quality int")
    out = pairwise_quality.score(odd, pairwise_quality.fit(odd, labels)).collect()
    assert len(out) == odd.count()
    blank = {r.doc_id for r in odd.collect() if not (r.text or "").strip()}
    assert {r.predicted for r in out if r.doc_id not in blank} == {want}
    assert all(r.score == 0 for r in out if r.doc_id in blank)


def test_pairwise_statistics_of_odd_texts():
    x = pairwise_quality.statistics(pa.array(TEXTS))
    assert x.shape == (len(TEXTS), len(pairwise_quality.NAMES)) and np.isfinite(x).all()
    assert (x[:3] == 0).all() and (x[4] == x[-1]).all()


@pytest.mark.parametrize("run", [collocations.mine, divergence.audit, lambda d: pairwise_quality.score(d, pairwise_quality.learn(np.zeros((0, 22)), np.zeros(0, bool)))])
def test_no_rows(odd, run):
    assert run(odd.limit(0)).collect() == []
