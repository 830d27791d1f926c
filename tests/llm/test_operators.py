"""The text operators against brute force, on odd little tables and on the smallest documents."""

import collections
import hashlib
import itertools
import math
import pickle
import re
import zlib

import numpy as np
import public_tokenizers as tokenizer_files
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.base import Check
from checks.compare import connect, differences
from conftest import SMALL
from millrace.llm import (
    chunks, exact_dedup, hashing, language_id, near_dedup, ngram_scores, packing, pieces, pseudonyms, quality_rules, queries, setsketch, token_counts, token_files,
)
from millrace.llm.common import pseudonym_key

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BYTE_BPE, WORD_BPE, PIECES = map(tokenizer_files.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
LONG = " ".join(f"word{i % 900}" for i in range(30_000))
TEXTS = [
    None, "", " \n\t", "one", "One  two", "one two\nthree.\n\nfour", "x" * 3000, LONG, LONG + " end", "é Ö 日本 😀\r\nA\x0bb",
    "a 'll b", "<|endoftext|> a", "▁mark", "same same same same", "same same same same", "\x00 a", "a \x00b", "tab\tand  two blanks ",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, a long text, repeated rows, a null and a repeated id, and columns whose names clash."""
    rows = [(i, t, "en", 7, "k") for i, t in enumerate(TEXTS)] + [(3, "one", None, 1, None), (None, "no id", "de", 2, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def pairs_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op11_collocations", "op13_source_divergence"}))
def test_every_row_of_documents(spark, docs, name):
    out = queries.QUERIES[name](spark, SMALL)
    assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert differences(spark, connect(SMALL), Check(name, queries.QUERIES[name], queries.ORACLE_SQL[name]), SMALL) is None


@pytest.mark.parametrize(
    "run",
    [
        exact_dedup.decisions, exact_dedup.deduplicate, near_dedup.classes, near_dedup.deduplicate, language_id.identify, ngram_scores.score,
        lambda d: packing.pack(d, BYTE_BPE), lambda d: token_files.through_files(d, WORD_BPE, 49_408), lambda d: pseudonyms.report(d, "k"),
        lambda d: pieces.encode(d, PIECES), lambda d: token_counts.count(d, PIECES), lambda d: quality_rules.judge(d, []),
    ],
)
def test_no_rows(odd, run):
    assert run(odd.limit(0)).collect() == []


def by_group(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), -1 if i is None else i))
    return groups


def test_exact_dedup(odd):
    rows = pairs_of(odd)
    want = collections.Counter()
    for text, group in by_group(rows).items():
        keep = min(group)[1]
        for _, i in group:
            want[(i, keep, len(group), i == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    got = collections.Counter(tuple(-1 if k < 2 and v is None else v for k, v in enumerate(r)) for r in exact_dedup.decisions(odd).collect())
    assert got == want
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    squeezed = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert sorted(squeezed) == sorted(by_group(rows))
    assert all(len(r.text or "") == -min(by_group(rows)[s])[0] for r, s in zip(kept.collect(), squeezed, strict=True))


def shingles(text, n):
    words = WORD.findall(text.translate(LOW))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def linked(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("words", [2, 5])
def test_near_dedup(docs, odd, words):
    for df in (docs, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(df, words=words).collect()}
        assert got == linked(pairs_of(df), words, 80)
    assert near_dedup.deduplicate(odd).columns == odd.columns


def test_near_dedup_of_repeated_ids(spark, odd):
    """Rows that repeat an id are documents of their own; the smallest id of a component names it."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base), (2, base + " more"), (2, "quite another text"), (2, "quite another text"), (3, "quite another text"), (3, base)]
    rows += [(4, "a text alone"), (4, None), (None, base), (5, base.replace("w39", "x")), (5, " ".join(f"y{i}" for i in range(30))), (5, "")]
    rows += [(0, " ".join(f"y{i}" for i in range(29))), (9, "quite another text")]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), odd):
        numbered = [(k, i, t) for k, (i, t) in enumerate(pairs_of(df))]
        found = linked([(k, t) for k, i, t in numbered if i is not None], 2, 80)
        least = {}
        for k, i, _ in numbered:
            if i is not None:
                least[found[k][1]] = min(i, least.get(found[k][1], i))
        want = collections.Counter((i, found[k][0], least[found[k][1]], i == least[found[k][1]]) for k, i, _ in numbered if i is not None)
        got = [r for r in near_dedup.classes(df, words=2).collect()]
        assert collections.Counter(tuple(r) for r in got if r.doc_id is not None) == want
        assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
        kept = collections.Counter((i, t) for k, i, t in numbered if i is None or i == least[found[k][1]])
        assert collections.Counter(pairs_of(near_dedup.deduplicate(df, words=2))) == kept


def test_near_dedup_of_many_variants(spark):
    """Copies that differ from the first one too much, but not from each other, are still found."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.choice(200, int(rng.integers(4, 26)), replace=False):
            words[k] = f"x{i % 12}_{k}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == linked(rows, 2, 80)


def test_short_sets_share_a_band():
    """Sets of 4 and 5 shingles, similarity 0.8: no pair of 20,000 may go without a common band (3e-6 a pair are expected to)."""
    rng = np.random.default_rng(1)
    for _ in range(10):
        large = list(rng.integers(0, 1 << 64, (2000, 5), dtype=np.uint64))
        bands = [setsketch.band_hashes(setsketch.registers(sets)) for sets in (large, [s[:4] for s in large])]
        assert (bands[0] == bands[1]).any(1).all()


def test_registers_depend_on_the_set_alone():
    sets = [np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64) for n in (0, 1, 3, 40, 2000)]
    together = setsketch.registers(sets)
    assert all((setsketch.registers([s]) == row).all() for s, row in zip(sets, together, strict=True))
    assert (setsketch.registers([np.concatenate(sets)])[0] == together.max(0)).all()


def test_word_hashes(odd):
    import pyarrow as pa

    texts = [t for _, t in pairs_of(odd)] + ["y" * 1_200_000 + " z"]
    hashes, counts = hashing.word_hashes(pa.array(texts))
    words = [w for t in texts for w in WORD.findall(t.translate(LOW))]
    assert len(words) == len(hashes) == counts.sum()
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist(), strict=True)))


def ids_by_library(path, text):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [1], "<u4")


def test_texts_with_nul():
    texts = ["b", "a b", "a \x00b", "\x00b", "\x00 b", "a\x00 b\n\x00b", "a \x00b b", "\x00\n", "a\n\x00"]
    for path in (BYTE_BPE, WORD_BPE):
        for order in (texts, texts[::-1]):
            encoder = chunks.ChunkEncoder(path, "<u4", 1000)
            assert [encoder.encode([t])[0] + b"\1\0\0\0" for t in order] == [ids_by_library(path, t).tobytes() for t in order]
            assert encoder.encode(order) == [ids_by_library(path, t).tobytes()[:-4] for t in order]


def test_token_files(spark, odd):
    rows = sorted(pairs_of(odd), key=lambda r: -1 if r[0] is None else r[0])
    got = sorted(token_files.through_files(odd, WORD_BPE, 49_408, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    want = collections.Counter((i, ids_by_library(WORD_BPE, t).tobytes()) for i, t in rows)
    assert want == collections.Counter((r.doc_id, np.array(r.ids, "<u4").tobytes()) for r in got)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens


def test_packing(odd):
    plain = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ids = {i: ids_by_library(BYTE_BPE, t) for i, t in pairs_of(plain)}
    pieces_of, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(plain, BYTE_BPE).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces_of[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    for i, own in pieces_of.items():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]] and sum(n for _, n in own) == len(ids[i])
    for own in sequences.values():
        assert [a for a, _, _ in sorted(own)] == [0, *np.cumsum([n for _, n, _ in sorted(own)])[:-1]]
        assert sum(n for _, n, _ in own) == own[0][2] <= 2048
    assert len(pieces_of) == len(ids) and packing.pack(odd, BYTE_BPE).select("doc_id").distinct().count() == len(ids) + 1
    with pytest.raises(ValueError, match="powers of two"):
        packing.pack(plain, BYTE_BPE, tiers=(100,))


def test_quality_counts(odd):
    for r in quality_rules.judge(odd, []).collect():
        (text,) = {t for i, t in pairs_of(odd) if i == r.doc_id}
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words)) and r.kept == (not r.base_failed)


def test_rules_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality_rules.FEATURES)))
    good = ~((x[:, 2] > 0.8) | ((x[:, 5] > 0.7) & (x[:, 7] > 0.5)))
    rules = quality_rules.learn(x, good)
    rejected = np.any([quality_rules._covers(r, x) for r in rules], axis=0)
    assert rejected[~good].mean() > 0.9 and rejected[good].mean() < 0.03
    assert quality_rules.learn(x[:0], good[:0]) == [] == quality_rules.learn(x, np.ones(3000, bool))


def test_a_repeated_id_is_one_example(spark, docs):
    """Rules learned from rows, repeated rows of one bad document and clashing names; none from no labels."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    once = docs.select("doc_id", "text", F.lit(1).alias("label"), F.lit("x").alias("s"), F.lit(2).alias("label_id"))
    rules = quality_rules.fit(once, labels)
    hot = once.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("k")
    assert quality_rules.fit(once.unionByName(hot), labels.unionByName(labels)) == rules
    assert quality_rules.fit(once, labels.limit(0)) == [] == quality_rules.fit(once.limit(0), labels)
    assert quality_rules.keep_good(once, rules).columns == once.columns


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10


def test_pseudonyms(spark, odd):
    values = ["+1 (017) 555-7713", "4111111111111111", "4111 1111 1111 1111", "97.51.17.173", "und.34@mail7.example.com", "2024-02-29", "29.02.2024", "a" * 40, "123-45-6789"]
    rows = [(i, f"see {v}, twice {v}.") for i, v in enumerate(values)] + [(90, "2023-02-29 and 300.1.1.1 and 1.2.3.4.5 and v1.2, 9807915762804490, 1733071234567, DE02 1203 0000 0000 2020 52"), (91, None)]
    got = {r.doc_id: r for r in pseudonyms.report(spark.createDataFrame(rows, "doc_id int, text string"), "k").collect()}
    new = {}
    for i, v in enumerate(values):
        first, second = re.fullmatch(r"see (.*), twice (.*)\.", got[i].text).groups()
        assert first == second != v and got[i].n_found == 2
        shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", s))
        assert v.count(".") == 3 or v == "a" * 40 or shape(first) == shape(v)
        new[v] = first
    assert luhn(new["4111111111111111"]) == 0 and new["4111 1111 1111 1111"].replace(" ", "") == new["4111111111111111"]
    assert new["29.02.2024"] == ".".join(new["2024-02-29"].split("-")[::-1])
    assert (got[90].text, got[90].n_found) == (rows[-2][1], 0) and (got[91].text, got[91].n_found) == (None, 0)
    assert pseudonyms.replace(odd, "k").collect() == odd.collect()


def test_a_key_is_asked_for(spark):
    with pytest.raises(ValueError):
        pseudonym_key(spark)
    assert pseudonym_key(spark, "t") == "t"


def pseudonyms_of(spark, values):
    rows = pseudonyms.report(spark.createDataFrame(list(enumerate(values)), "doc_id int, text string"), "k").collect()
    assert all(r.n_found == 1 for r in rows) and len(rows) == len(values)
    return {values[r.doc_id]: r.text for r in rows}


def mod_97(iban):
    return int("".join(str(int(c, 36)) for c in (iban[4:] + iban[:4]).replace(" ", ""))) % 97


def test_every_found_value_is_replaced(spark):
    cards = ["3782 822463 10005", "3782-822463-10005", "378282246310005"]
    ibans = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82WEST12345698765432", "MT84MALT011000012345MTLCAST001S"]
    dates = ["25/12/1999", "1999-12-25", "25.12.1999", "31/01/2000", "13/02/2023"]
    mails = ["иван.петров@mail.ru", "联系foo@bar.com", "é9@x.ru", "𝐚b@x.com", "ⸯ@x.com", *(f"{c}@x{i}.com" for i, c in enumerate("abcжñ語7" * 6))]
    new = pseudonyms_of(spark, cards + ibans + dates + mails)
    assert all(v != p and len(v) == len(p) for v, p in new.items())
    for same in (cards, ibans[:2]):
        assert len({re.sub("[ -]", "", new[v]) for v in same}) == 1
    assert luhn(new[cards[0]]) == 0 and all(mod_97(new[v]) == 1 for v in ibans)
    day, month, year = new["25/12/1999"].split("/")
    assert int(day) > 12 and new["1999-12-25"] == f"{year}-{month}-{day}" and new["25.12.1999"] == f"{day}.{month}.{year}"
    assert all(re.fullmatch(r"[^\W_]+(\.[^\W_]+)*@.*", new[v]) and v.split("@")[1] == new[v].split("@")[1] for v in mails)


def test_telephone_numbers_are_linked(spark):
    groups = [
        ["+15551234567", "+1 555 123 4567", "+1-555-123-4567", "+1 (555) 123-4567", "(555) 123-4567", "555-123-4567"],
        ["+442079460958", "+44 20 7946 0958", "+44-20-7946-0958"],
        ["+420601123456", "+420 601 123 456"],
    ]
    new = pseudonyms_of(spark, [v for g in groups for v in g])
    for group, code in zip(groups, ("1", "44", "420"), strict=True):
        digits = {re.sub("[^0-9]", "", new[v]).removeprefix(code if v[0] == "+" else "") for v in group}
        assert len(digits) == 1 and all(new[v].startswith(f"+{code}") for v in group if v[0] == "+")
        assert all(new[v] != v and re.sub("[0-9]", "9", new[v]) == re.sub("[0-9]", "9", v) for v in group)


def test_dates_are_permuted(spark):
    days = spark.range(146_097).select(F.date_from_unix_date((F.col("id") + 11_000).cast("int")).alias("d"))
    new = days.select("d", pseudonyms._date(F.date_format("d", "yyyy-MM-dd"), "k", "yyyy-MM-dd").alias("n"))
    late = [F.dayofmonth(x) > 12 for x in ("d", F.to_date("n"))]
    assert new.select(F.count_distinct("n"), F.count_if(late[0] != late[1])).first()[:] == (146_097, 0)


def test_feistel_is_a_permutation(spark):
    items = F.array((F.col("id") / 12).cast("int"), (F.col("id") % 12).cast("int"))
    out = spark.range(108).select(pseudonyms.feistel(items, F.array(F.lit(9), F.lit(12)), F.lit("t"), "k").alias("x"))
    assert len({tuple(r.x) for r in out.collect()}) == 108


def test_ngram_scores(docs, odd):
    for df in (docs, odd):
        rows = pairs_of(df)
        held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
        tokens = [(i, [*WORD.findall(t.translate(LOW)), "\n"]) for i, t in rows]
        counts = collections.Counter(w for i, t in tokens if not held[i] for w in t)
        total, types = sum(counts.values()), len(counts)
        want = sorted(((str(i), held[i], len(t), sum(w in counts for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in t), 3)) for i, t in tokens))
        scores = {}
        for k, options in enumerate(({}, {"shard_bytes": 1 << 14}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "shard_bytes": 1 << 13})):
            got = ngram_scores.score(df, **options).collect()
            assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
            assert all(r.score < 0 for r in got)
            scores[k] = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got)
            if df is docs:
                assert sum(r.score - r.base_score for r in got if r.held_out) > 0
        # neither the number of shards nor the way they travel changes a score
        assert scores[0] == scores[1] == scores[2] == scores[3]


def test_filter_is_mapped_where_the_shared_folder_is_mounted(spark, docs, odd, monkeypatch):
    """No process gets a copy of the filter then, whatever its size; the scores are those of the other ways."""
    sent, put = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or put(self, value))
    for df in (docs, odd):
        scores = []
        for options in ({}, {"broadcast_bytes": 0, "shard_bytes": 1 << 13}, {"mapped": False}, {"mapped": False, "broadcast_bytes": 0, "shard_bytes": 1 << 13}):
            out = ngram_scores.score(df, **options)
            assert ("CoGroups" in out._jdf.queryExecution().toString()) == (len(scores) == 3)
            scores.append(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in out.collect()))
        assert scores[0] == scores[1] == scores[2] == scores[3]
        whole, parts, copied = sent
        assert whole == parts and copied > 5 * whole or df is odd
        sent.clear()


def test_scored_together_is_bounded_by_text():
    rows = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4, 5], "text": ["", "x" * ngram_scores.SCORED_BYTES, "y", "z" * (3 << 20), ""]})
    assert [b.column("id").to_pylist() for b in ngram_scores._slices(rows)] == [[1, 2], [3], [4], [5]]


def test_scores_from_a_filter_without_false_answers(docs):
    """With a filter so wide that it hardly answers falsely, scores are those of plain counting."""
    rows = pairs_of(docs)
    tokens = {i: ["<s>", *WORD.findall(t.translate(LOW)), "\n"] for i, t in rows}
    singles, pairs = collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            singles.update(t)
            pairs.update(itertools.pairwise(t))
    total, types = sum(singles.values()) - singles["<s>"], len(singles) - 1

    def log_count(n):
        return ngram_scores.COUNT_BASE ** round(math.log(n) / math.log(ngram_scores.COUNT_BASE)) if n else 0.0

    def step(a, b):
        single = (log_count(singles[b]) + 1) / (total + types + 1)
        if not singles[a]:
            return single
        share = min(1.0, log_count(pairs[a, b]) / max(log_count(singles[a]), 1)) if singles[b] else 0.0
        return ngram_scores.PAIR_WEIGHT * share + (1 - ngram_scores.PAIR_WEIGHT) * single

    want = {i: sum(math.log10(step(a, b)) for a, b in itertools.pairwise(t)) for i, t in tokens.items()}
    got = {r.doc_id: r.score for r in ngram_scores.score(docs, bits=4000.0).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_language_mixtures(docs, odd):
    langs = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in language_id.identify(docs).collect() if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in got) >= 0.95 * len(got)
    table = language_id.train(docs)
    for r in language_id.predict(odd, *table).collect():
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (not any(c.isalpha() for i, t in pairs_of(odd) if i == r.doc_id for c in t))


def test_pieces_and_counts(docs, odd):
    vocabulary = pieces.load(PIECES)
    encoder = pieces.Encoder(vocabulary)

    def brute(text):
        best = [(0.0, ())] + [(-math.inf, ())] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - 20), end):
                part = text[start:end]
                if part in vocabulary.scores:
                    step = vocabulary.scores[part], (vocabulary.ids[part],)
                elif len(part) == 1:
                    step = vocabulary.unknown, tuple(vocabulary.byte_ids[b] for b in part.encode())
                else:
                    continue
                if best[start][0] + step[0] > best[end][0]:
                    best[end] = best[start][0] + step[0], best[start][1] + step[1]
        return best[-1]

    for text in ["a", "the 日本語 of  it\n\nx", "😀é\x07", "▁▁a b", *(t[:300] for _, t in pairs_of(docs)[:40])]:
        marked = "▁" + text.replace(" ", "▁")
        segments = [brute(s) for s in pieces.SEGMENT.findall(marked)]
        assert encoder.encode(text).tolist() == [i for _, ids in segments for i in ids]
        # cutting the text into segments loses nothing
        assert sum(score for score, _ in segments) == pytest.approx(brute(marked)[0])
    for df in (docs, odd):
        encoded = {r.doc_id: r for r in pieces.encode(df, PIECES).collect()}
        counted = {r.doc_id: r.n_tokens for r in token_counts.count(df, PIECES).collect()}
        assert {i: r.n_pieces for i, r in encoded.items()} == counted
        assert all(r.round_trip or "▁" in t for i, t in pairs_of(df) for r in [encoded[i]])


def test_pipeline(spark, docs):
    import corpus_pipeline as pipeline

    kept = docs
    for _, stage in pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SMALL).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count()
    texts = [t for _, t in pairs_of(kept)]
    assert len({re.sub(r"[\x20\x09-\x0D]", "", t) for t in texts}) == len(texts) and not any(re.search(r"97\.51\.17\.173", t) for t in texts)
    out = pipeline.run(spark, SMALL)
    assert out.select("doc_id").distinct().count() == len(texts)
