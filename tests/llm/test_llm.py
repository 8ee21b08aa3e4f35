"""Each operator against brute force, an exact round trip or held-out accuracy, and on odd tables."""

import hashlib
import itertools
import os
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from refrain.llm import bpe, decontaminate, exact_dedup, induced, language_id, license_scan, quality, queries, repeats, simhash, substring_dedup, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept boolean, start long"
LONG = "word " * 30_000 + "end"
ODD = [(1, "", "en"), (2, None, "en"), (3, "x", None), (4, LONG, "en"), (5, "\n\t  ", "de"), (6, "x", None), (7, "日本語 😀 é", "ja"), (7, "日本語 😀 é", "ja"), (None, "no id", None)]


def docs(spark, rows):
    """Documents with null source and extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, None, None, 0, False, 0) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def syllables(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "te", "su"]) for _ in range(rng.integers(1, 4))) for _ in range(n))


# --- 1 quality ----------------------------------------------------------------------------------


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = quality.fit_trees(x[:1500], y[:1500], trees=40)
    assert ((trees.predict(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95

    def walk(row):  # node by node
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - trees.feature.shape[1]]
        return total

    assert np.allclose([walk(r) for r in x[:20]], trees.margin(x[:20]))
    assert quality.fit_trees(x[:5], np.ones(5)).predict(x[:2]).min() > 0.5
    assert quality.fit_trees(x[:0], y[:0]).predict(x[:2]).tolist() == [0.5, 0.5]


@needs_tables
@pytest.mark.parametrize("name, label", [("op1_quality", "quality"), ("op9_toxicity", "toxic")])
def test_scores_hold_out(spark, name, label):
    sf = "/root/testdata/sf0.01" if name == "op9_toxicity" else SF
    got = queries.QUERIES[name](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    judged = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert judged.score.between(0, 1).all() and (judged.predicted == (judged.score >= 0.5)).all()
    assert (judged.predicted == judged[label]).mean() > 0.85


@needs_tables
def test_quality_scores_match_a_walk_of_the_trees(spark, small):
    """op1 against the fit repeated and its trees followed node by node, on each whole text."""
    got = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    trees = quality.fit_quality(small, labels.filter("crc32(cast(doc_id AS string)) % 3 <> 1"))
    whole = texts(small)
    assert set(got) == set(whole)
    for i, text in whole.items():
        row, total = quality.statistics(text.encode()), trees.base
        for t in range(len(trees.feature)):
            node, inner = 0, trees.feature.shape[1]
            while node < inner:
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - inner]
        score = 1 / (1 + np.exp(-total))
        assert abs(got[i].score - score) < 1e-9 and got[i].predicted == (got[i].score >= 0.5) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, None), (99, 1), (7, 2), (None, 1)], "doc_id long, label int")
    trees = quality.fit_quality(odd, labels)
    got = quality.score_quality(odd, trees).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(empty, quality.fit_quality(empty, labels)).count() == 0


# --- 2 decontamination --------------------------------------------------------------------------


def test_decontamination_tolerates_substitutions(spark):
    rng = np.random.default_rng(1)
    item = syllables(rng, 40).split()
    clean, other = syllables(rng, 200), syllables(rng, 30)
    changed = list(item)
    for i in (4, 12, 13, 25):
        changed[i] = "zzz"
    rows = [(1, f"{clean} {' '.join(item)} {clean}", None), (2, f"{clean}\n{' '.join(changed).upper()}", None), (3, clean, None), (4, f"x {' '.join(item[:13])} y", None), (5, "Tiny, item!", None), (6, None, None)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, other), (9, "tiny item"), (10, None), (11, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 7), (2, 7), (4, 7), (5, 9)}
    assert got[1, 7].first_word == 200 and got[1, 7].n_words == 40 and got[1, 7].agreement == 1
    # Three of words 1 to 13 differ, so the windows that agree make two runs.
    assert (got[2, 7].first_word, got[2, 7].n_words, got[2, 7].agreement) == (205, 35, 32 / 35)
    assert decontaminate.contamination(docs(spark, rows), bench.limit(0)).count() == 0


def test_seed_hits_match_brute_force():
    rng = np.random.default_rng(2)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 6, 25)).encode()) for i in range(4)]
    index = decontaminate.TestIndex.build(items)
    text = [f"w{x}".encode() for x in rng.integers(0, 6, 300)] + items[2][1].split()
    got = {(int(d), int(t)) for d, t in index.hits(decontaminate.word_hashes(text), decontaminate.MASKS).T}
    flat = b" ".join(x for _, x in items).split()
    want = set()
    for mask in decontaminate.MASKS:
        on = [i for i, m in enumerate(mask) if m == "1"]
        for k in range(4):
            for a in range(25 * k, 25 * k + 26 - len(mask)):
                for b in range(len(text) - len(mask) + 1):
                    if all(flat[a + i] == text[b + i] for i in on):
                        want.add((b - a, a))
    assert got == want


def test_masks_hit_every_window_that_agrees():
    rng = np.random.default_rng(3)
    item = syllables(rng, 13).split()
    index = decontaminate.TestIndex.build([(1, " ".join(item).encode())])
    for spots in itertools.combinations(range(13), 2):
        text = [f"x{i}".encode() if i in spots else w.encode() for i, w in enumerate(item)]
        assert index.overlaps(text) == [(1, 0, 13, 11 / 13)], spots
    item = [f"w{i}" for i in range(60)]
    index = decontaminate.TestIndex.build([(1, " ".join(item).encode())])
    for first in range(5):
        text = [b"x" if i % 5 == first else w.encode() for i, w in enumerate(item)]
        assert index.overlaps(text)  # windows with two and with three other words take turns


def test_runs_on_one_diagonal_stay_apart():
    item = [f"w{i}" for i in range(80)]
    index = decontaminate.TestIndex.build([(1, " ".join(item).encode())])
    text = [f"x{i}".encode() if 15 <= i < 65 else w.encode() for i, w in enumerate(item)]
    found = index.overlaps(text)
    assert len(found) == 2 and all(n <= 19 and agree >= 15 / 17 for _, _, n, agree in found)


def brute_overlaps(texts, items):
    """(doc, item) of every pair with windows of 13 words of which 11 agree, or a short item that stands whole."""
    out = set()
    for d, text in texts.items():
        have = decontaminate.words((text or "").encode())
        for i, item in items.items():
            want = decontaminate.words((item or "").encode())
            size, least = (13, 11) if len(want) >= 13 else (len(want), len(want))
            for a, b in itertools.product(range(len(have) - size + 1), range(len(want) - size + 1)):
                if size and sum(x == y for x, y in zip(have[a : a + size], want[b : b + size], strict=True)) >= least:
                    out.add((d, i))
                    break
    return out


@pytest.mark.parametrize("sent", [1 << 20, 40])
def test_decontamination_matches_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "SENT_WORDS", sent)
    rng = np.random.default_rng(5)
    items = {i: syllables(rng, int(rng.integers(2, 45))) for i in range(12)}
    texts = {}
    for d in range(60):
        mine = items[int(rng.integers(0, 12))].split()
        a = int(rng.integers(0, len(mine)))
        part = [w if rng.random() > 0.12 else "zz" for w in mine[a : a + int(rng.integers(5, 30))]]
        texts[d] = " ".join([syllables(rng, int(rng.integers(0, 20))), *part, syllables(rng, 6)])
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = decontaminate.contamination(docs(spark, [(d, t, None) for d, t in texts.items()]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_overlaps(texts, items)


def test_decontamination_odd(spark, odd, empty):
    bench = spark.createDataFrame([(1, "word " * 20), (1, "word " * 20)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contamination(odd, bench).collect()} == {4}
    assert decontaminate.contamination(empty, bench).count() == 0


# --- 3 suffix array, 7 suffix trees -------------------------------------------------------------


@pytest.mark.parametrize("budget", [64 << 20, 2000])
def test_induced_sorting(budget):
    rng = np.random.default_rng(0)
    for trial in range(60):
        n, sigma, depth = int(rng.integers(1, 300)), int(rng.choice([2, 3, 30])), int(rng.choice([3, 20, 100]))
        t = rng.integers(1, sigma + 1, n)
        if trial % 3 == 0:
            t[n // 2 :] = t[: n - n // 2]
        if trial % 5 == 0:
            t[: n // 2] = 1
        t = np.append(t, 0).astype(np.uint16)
        blocks = list(induced.suffixes(t, sigma + 1, depth, budget))
        pos, lcp = (np.concatenate([b[i] for b in blocks]).tolist() for i in range(2))
        keys = [t[i : i + depth].tolist() for i in pos]
        assert sorted(pos) == list(range(len(t))) and all(a >= b for a, b in zip(keys, keys[1:], strict=False))
        for i in range(1, len(pos)):
            same = 0
            while same < min(len(keys[i]), len(keys[i - 1])) and keys[i][same] == keys[i - 1][same]:
                same += 1
            assert lcp[i] == min(same, depth)


def test_induced_sorting_of_a_text_far_over_the_budget(monkeypatch):
    monkeypatch.setattr(induced, "_BLOCK", 1 << 12)
    rng = np.random.default_rng(1)
    t = np.append(np.concatenate([rng.integers(1, 5, 150_000), np.tile(rng.integers(1, 5, 3000), 50)]), 0).astype(np.uint16)
    tracemalloc.start()
    got, seen, last = 0, np.zeros(len(t), dtype=bool), None
    for pos, lcp in induced.suffixes(t, 5, 100, 1 << 16):
        seen[pos] = True
        got += len(pos)
        for i in range(0, len(pos), 37):
            before = last if i == 0 else int(pos[i - 1])
            if before is not None:
                a, b = t[before : before + 100].tolist(), t[pos[i] : pos[i] + 100].tolist()
                same = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert a >= b and lcp[i] == same
        last = int(pos[-1]) if len(pos) else last
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Sorted in memory, the places of the 300,000 suffixes alone would take 2.4 MB in each of a dozen arrays.
    assert got == len(t) and seen.all() and peak < 8 << 20


def brute_bytes(items, window):
    seen, out = set(), {}
    for i, text in sorted(items):
        b = text.encode()
        cov = np.zeros(len(b), bool)
        for p in range(len(b) - window + 1):
            if b[p : p + window] in seen:
                cov[p : p + window] = True
            else:
                seen.add(b[p : p + window])
        kept = np.frombuffer(b, np.uint8)[~cov].tobytes()
        out[i] = (len(b), int(cov.sum()), int((np.diff(np.concatenate([[0], cov.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def brute_words(items, window):
    seen, out = {}, {}
    for i, text in sorted(items):
        w = text.encode().split()
        cov = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[p : p + window]), i) < i:
                cov[p : p + window] = [True] * window
        kept = [x for x, c in zip(w, cov, strict=True) if not c]
        out[i] = (len(w), sum(cov), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def repeating(seed, n=60):
    """Texts with shared passages, copies, near copies, runs of one word and inner repeats."""
    rng = np.random.default_rng(seed)
    passage = [syllables(rng, 70) for _ in range(3)]
    out = []
    for i in range(n):
        parts = [syllables(rng, int(rng.integers(1, 120)))]
        if rng.random() < 0.4:
            parts.insert(int(rng.integers(2)), passage[rng.integers(3)])
        if rng.random() < 0.2:
            parts.append("la " * int(rng.integers(20, 90)))
        if rng.random() < 0.2:
            parts += parts
        if out and rng.random() < 0.3:
            parts = [out[rng.integers(len(out))][1].replace("ka", "KA", int(rng.integers(0, 3)))]
        out.append((i, " ".join(parts)))
    return out


@pytest.mark.parametrize("window", [100, 24])
def test_suffix_dedup(spark, window):
    items = repeating(window)
    got = suffix_dedup.suffix_dedup(docs(spark, [(i, t, None) for i, t in items]), window=window).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_bytes(items, window)
    t = dict(items)
    for r in got:
        left = bytearray(t[r.doc_id].encode())
        for s in reversed(r.spans):
            del left[s.start : s.end]
        assert bytes(left) == bytes(r.kept)


@pytest.mark.parametrize("window", [50, 8])
def test_substring_dedup(spark, window):
    items = repeating(window + 1)
    got = substring_dedup.substring_dedup(docs(spark, [(i, t, None) for i, t in items]), window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_words(items, window)


@pytest.mark.parametrize("hot", [1 << 16, 1])
def test_batches_in_which_no_key_comes_again(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.default_rng(5)
    passage = syllables(rng, 40)
    rows = [(i, f"{syllables(rng, 9)} {passage} {syllables(rng, 9)}") for i in range(3)]
    table = docs(spark, [(i, t, None) for i, t in rows])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        words = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(table, window=12).collect()}
        data = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(table, window=100).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert words == brute_words(rows, 12) and data == brute_bytes(rows, 100)


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_windows_of_hot_keys_are_dealt_anew(spark, monkeypatch, kind):
    monkeypatch.setattr(repeats, "HOT", 3)
    rng = np.random.default_rng(12)
    popular = "subscribe to our weekly letter of news and notes"
    rows = [(i, f"{syllables(rng, 20)} {popular} {syllables(rng, 20)}") for i in range(30)]
    rows += [(100 + i, rows[i][1][20:]) for i in range(0, 30, 3)] + [(200, "a" * 300)]
    table = docs(spark, [(i, t, None) for i, t in rows])
    runs = repeats.candidates(repeats.keyed(table, "doc_id", "text"), repeats.Units("bytes", 100, 32, True))
    assert runs.groupBy("key").count().agg(F.max("count")).first()[0] > 3
    if kind == "bytes":
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(table, window=100).collect()}
        want = brute_bytes(rows, 100)
    else:
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(table, window=12).collect()}
        want = brute_words(rows, 12)
    assert got == want and sum(w[1] for w in want.values()) > 1000 * (kind == "bytes")


def test_subtrees_match_brute_force():
    rng = np.random.default_rng(13)
    for cells, most in ((1 << 20, 1 << 16), (64, 9)):
        texts = [rng.integers(0, 3, int(rng.integers(6, 60))) for _ in range(25)]
        texts += [np.concatenate([t[3:], t[:9]]) for t in texts[:8]]
        owner = np.sort(rng.integers(0, 20, len(texts)))
        words = np.concatenate([np.append(t, 100 + i) for i, t in enumerate(texts)]).astype(np.uint32)
        suffix = np.flatnonzero(words < 100)
        leaves, depth = substring_dedup.subtree(words, suffix, cells=cells)
        assert sorted(leaves) == suffix.tolist()
        for a, b, d in zip(leaves, leaves[1:], depth[1:], strict=False):
            same = next(i for i in range(len(words)) if words[a + i] != words[b + i])
            assert same == d and words[a + d] < words[b + d]
        window, doc = 5, np.repeat(owner, [len(t) + 1 for t in texts])
        reach = substring_dedup.covered_depth(doc[leaves].tolist(), depth.tolist(), window)
        for i in range(0, len(leaves), 7):
            common = [min(depth[min(i, j) + 1 : max(i, j) + 1]) for j in range(len(leaves)) if doc[leaves[j]] < doc[leaves[i]]]
            assert reach[i] == max((c for c in common if c >= window), default=0)
        contexts = [" ".join(f"w{x}" for x in t).encode() for t in texts]
        found = {(c, a + i) for cs, firsts, ns in substring_dedup.later_windows(contexts, [len(t) - window + 1 for t in texts], owner, window, most) for c, a, n in zip(cs, firsts, ns, strict=True) for i in range(n)}
        want = {(i, a) for i, t in enumerate(texts) for a in range(len(t) - window + 1) if any(owner[j] < owner[i] and t[a : a + window].tobytes() in {u[b : b + window].tobytes() for b in range(len(u) - window + 1)} for j, u in enumerate(texts))}
        assert found == want


def test_prefix_groups_split_and_lose_nothing():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, 500).astype(np.uint32)
    groups = list(substring_dedup.prefix_groups(words, np.arange(490), 10, most=20))
    where = {int(s): g for g, (_, group) in enumerate(groups) for s in group}
    by = {}
    for s in range(490):
        by.setdefault(words[s : s + 10].tobytes(), []).append(s)
    assert all(len({where[s] for s in same}) == 1 for same in by.values() if len(same) > 1)
    assert all(n == 10 or len(g) < 40 for n, g in groups)


def test_dedup_odd(spark, odd, empty):
    for run, col in ((suffix_dedup.suffix_dedup, "n_bytes"), (substring_dedup.substring_dedup, "n_words")):
        got = run(odd).collect()
        assert len(got) == len(ODD)
        by = {r.doc_id: r for r in got}
        assert by[1][col] == by[2][col] == 0 and by[7].n_removed == 0 and by[None].n_removed == 0
        assert run(empty).count() == 0
    assert {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(odd).collect()}[4] > 149_000
    copies = docs(spark, [(i, LONG, None) for i in range(5)])
    assert sorted(r.n_removed for r in substring_dedup.substring_dedup(copies).collect()) == [0] + [30_001] * 4


# --- 4 language ---------------------------------------------------------------------------------


def test_ngrams_match_counting():
    text = "Ab ba! éa"
    marked = "_ab_ba__éa_"
    want = Counter()
    for n in (1, 2, 3):
        for i in range(len(marked) - n + 1):
            g = marked[i : i + n]
            if set(g) != {"_"} and not (n == 3 and g[1] == "_"):
                want[g] += 1
    codes, counts = language_id.ngrams(text)
    got = {}
    for c, n in zip(codes.tolist(), counts.tolist(), strict=True):
        # Leading edges are zero bits, so a code's length shows only up to them.
        got["".join(chr(x) if x else "_" for x in (c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF))] = n
    merged = Counter()
    for g, n in want.items():
        merged[g.rjust(3, "_")] += n
    assert got == dict(merged)


def test_long_texts_are_counted_whole():
    piece, language_id._PIECE = language_id._PIECE, 50
    try:
        text = syllables(np.random.default_rng(0), 400)
        short = language_id.ngrams(text)
    finally:
        language_id._PIECE = piece
    whole = language_id.ngrams(text)
    assert short[0].tolist() == whole[0].tolist() and short[1].tolist() == whole[1].tolist()


@needs_tables
def test_language_held_out(spark):
    got = queries.op4_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95


def test_language_odd(odd, empty):
    profiles = language_id.learn_profiles(odd, F.lit(True))
    got = {r.doc_id: r for r in language_id.identify_language(odd, profiles).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[5].lang_pred == "und" and got[1].score == 0
    assert got[4].lang_pred == "en" and got[7].lang_pred == "ja"
    assert language_id.identify_language(empty, language_id.learn_profiles(empty, F.lit(True))).count() == 0
    assert language_id.identify_language(odd, {}).filter("lang_pred <> 'und'").count() == 0


# --- 5 simhash ----------------------------------------------------------------------------------


def brute_fingerprint(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    s = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_gray_index():
    rng = np.random.default_rng(1)
    for _ in range(10):
        n = int(rng.integers(1, 600))
        base = rng.integers(0, 2**63, size=max(1, n // 20), dtype=np.uint64)
        flips = np.where(rng.random((n, 6)) < 0.5, np.uint64(1) << rng.integers(0, 64, (n, 6)).astype(np.uint64), np.uint64(0))
        f = np.unique(base[rng.integers(0, len(base), n)] ^ np.bitwise_or.reduce(flips, axis=1))
        bucket = (f >> np.uint64(62)).astype(np.int64)
        far = np.where(bucket[:, None] == bucket[None], 0, 99)
        distance = np.bitwise_count(f[:, None] ^ f[None]).astype(int) + far
        index = simhash.GrayIndex(bucket, f)
        for t in (0, 4, 8):
            i, j = np.nonzero(np.triu(distance <= t, 1))
            a, b = index.forest(t)
            start = np.arange(len(f))
            assert (simhash._union(start, i, j) == simhash._union(start, a, b)).all() and len(a) < max(1, len(f))


@pytest.mark.parametrize("agree", [1, 2])
def test_links_lose_none(spark, agree):
    rng = np.random.default_rng(agree)
    base = rng.integers(-(2**62), 2**62, 40)
    f = sorted({int(b) ^ sum({1 << int(x) for x in rng.integers(0, 62, rng.integers(0, 5))}) for b in np.repeat(base, 8)})
    df = spark.createDataFrame([(x,) for x in f], "fp long")
    u = np.array(f).view(np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(u[:, None] ^ u[None]) <= 4, 1))
    at = {x: n for n, x in enumerate(f)}
    pairs = [(at[r.a], at[r.b]) for r in simhash.links(df, 4, agree=agree).collect()]
    start = np.arange(len(f))
    a, b = (np.array([p[k] for p in pairs], dtype=int) for k in range(2))
    assert (simhash._union(start, i, j) == simhash._union(start, a, b)).all()


def test_components_of_a_chain(spark):
    n = 60
    order = np.random.default_rng(0).permutation(n).tolist()
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (102, 102)], "a long, b long")
    assert {r.node: r.component for r in simhash.components(edges).collect()} == {i: 0 for i in range(n)} | {100: 100, 101: 100}


@pytest.mark.parametrize("gathered", [0, 1 << 20])
def test_components_by_rounds_and_by_one_task(spark, monkeypatch, gathered):
    monkeypatch.setattr(simhash, "GATHERED", gathered)
    pairs = np.random.default_rng(5).integers(-40, 40, (45, 2)) * 10**15
    node, place = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], return_inverse=True)
    label = simhash._union(np.arange(len(node)), *place.reshape(-1, 2).T)
    edges = spark.createDataFrame(pairs.tolist() + pairs[:9, ::-1].tolist() + [(None, 7)], "a long, b long")
    assert len(set(label)) > 3 and {r.node: r.component for r in simhash.components(edges).collect()} == dict(zip(node.tolist(), node[label].tolist(), strict=True))
    assert simhash.components(edges.filter("a = b")).count() == 0


def test_components_of_few_links_take_few_jobs(spark):
    # The driver keeps a record of each task, and check_h deals every shuffle to 211 of them.
    order = np.random.default_rng(0).permutation(200).tolist()
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    spark.sparkContext.setJobGroup("few links", "")
    try:
        assert {r.component for r in simhash.components(edges).collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links")) <= 8


@needs_tables
def test_simhash_classes(spark, small):
    got = {r.doc_id: r for r in queries.op5_simhash(spark, SF).collect()}
    t = texts(small)
    f = {i: brute_fingerprint(x) for i, x in t.items()}
    assert all(int(got[i].fingerprint, 16) == f[i] for i in t)
    ids = sorted(t)
    u = np.array([f[i] for i in ids], dtype=np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(u[:, None] ^ u[None]) <= 4, 1))
    want = simhash._union(np.arange(len(ids)), i, j)
    assert all(got[x].component_id == ids[want[n]] for n, x in enumerate(ids))


def test_near_duplicates(spark):
    rng = np.random.default_rng(9)
    a = syllables(rng, 300).split()
    b = list(a)
    b[100] = "changed"
    c = list(a)
    for i in range(0, 300, 10):
        c[i] = "other"
    rows = [(10, " ".join(a), None), (3, " ".join(b), None), (4, " ".join(c), None), (5, syllables(rng, 300), None), (6, "", None), (7, None, None), (8, "one two", None)]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()} == {10: 3, 3: 3, 6: 6, 7: 6}


def near_groups(rows):
    """Components of the brute-force pairs of similarity 0.8, as near_duplicates gives them."""
    sets = [simhash.shingles(text.encode(), 5) for _, text, _ in rows]
    pairs = [(j, i) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    label = simhash._union(np.arange(len(rows)), *np.array(pairs, dtype=int).reshape(-1, 2).T)
    return {rows[i][0]: rows[label[i]][0] for i in sorted({x for pair in pairs for x in pair})}


def numbered(made):
    return [(i, " ".join(words), None) for i, words in enumerate(made)]


def found_groups(spark, rows):
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}


def changed(rng, base, n):
    out = list(base)
    for i in rng.choice(len(base), n, replace=False):
        out[i] = f"x{rng.integers(10**6)}"
    return out


def test_near_duplicates_are_not_crowded_out(spark):
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 5000, 100)]
    rows = numbered(changed(rng, base, 2) for _ in range(300))
    assert found_groups(spark, rows) == near_groups(rows)


@pytest.mark.parametrize(("crowd", "block"), [(1, 1 << 12), (1 << 16, 7), (20, 50)])
def test_near_duplicates_of_a_group_dealt_to_many_tasks(spark, monkeypatch, crowd, block):
    # Variants that chains don't all join, among texts that share their first half alone.
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(14)
    base = [f"w{x}" for x in rng.integers(0, 5000, 130)]
    made = [changed(rng, base, 2) for _ in range(150)]
    made += [base[:65] + [f"w{x}" for x in rng.integers(0, 5000, 65)] for _ in range(80)]
    rows = numbered(made)
    assert 50 < len(near_groups(rows)) < 200 and len(set(near_groups(rows).values())) > 1 and found_groups(spark, rows) == near_groups(rows)


def test_near_duplicates_of_one_word_set(spark):
    # All texts have the same distinct words; the first is like none, each other one like its neighbour.
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(60)]
    made = [rng.permutation(words).tolist()]
    for _ in range(30):
        one = rng.permutation(words).tolist()
        made += [one, [*one[1:], one[0]]]
    rows = numbered(made)
    assert len(near_groups(rows)) == 60 and found_groups(spark, rows) == near_groups(rows)


def test_near_duplicates_with_a_tail(spark):
    rng = np.random.default_rng(13)
    made = []
    for n in (40, 60, 100, 200, 400, 1000):
        for _ in range(20):
            one = [f"w{x}" for x in rng.integers(0, 5000, n)]
            made += [one, one[: int(0.83 * n) + 1]]
    rows = numbered(made)
    assert len(near_groups(rows)) > 200 and found_groups(spark, rows) == near_groups(rows)


def test_pairs_of_a_group_grow_with_its_rows():
    for n in (2, 3, 16, 200):
        key, doc = np.zeros(n, np.int64), np.arange(n)
        a, b, large = simhash._meet(key, np.full(n, -1), doc, np.full(n, 100), np.zeros(n, np.int64), 0.8)
        assert n - 1 <= len(a) <= 3 * n and large.all() == (n > 3)
        assert n > 3 or len(a) == n * (n - 1) // 2


def test_pipeline_near_copies_by_fingerprint_and_by_shingles(spark):
    # One line over and over with other endings: near by fingerprint, its distinct shingles mostly differ.
    rng = np.random.default_rng(21)
    line = [f"w{x}" for x in rng.integers(0, 5000, 11)] * 30
    lines = [" ".join(line + [f"v{x}" for x in rng.integers(0, 5000, 40)]) for _ in range(3)]
    one = [f"w{x}" for x in rng.integers(0, 5000, 60)]
    cut_off = [" ".join(one), " ".join(one[:50])]  # as shingles alike, by fingerprint not
    rows = [(7, lines[0], None), (5, lines[1], None), (9, lines[2], None), (2, cut_off[0], None), (3, cut_off[1], None), (None, lines[0], None), (4, syllables(rng, 60), None)]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()} == {2: 2, 3: 2}
    classes = {r.doc_id: r.component_id for r in simhash.simhash_classes(docs(spark, rows[:5])).collect()}
    assert classes == {7: 5, 5: 5, 9: 5, 2: 2, 3: 3}
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near(spark, docs(spark, rows), "").collect()) == ["2", "4", "5", "None"]


def test_simhash_odd(odd, empty):
    got = {r.doc_id: r.component_id for r in simhash.simhash_classes(odd).collect()}
    assert got[1] == got[2] == got[5] == 1 and got[3] == got[6] == 3 and got[7] == 7
    assert simhash.simhash_classes(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


# --- 6 exact dedup ------------------------------------------------------------------------------


def test_perfect_hash():
    rng = np.random.default_rng(0)
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(3000)), np.uint8).reshape(-1, 32)
    mph = exact_dedup.PerfectHash(keys[:2000])
    slots = mph.slots(keys[:2000])
    assert sorted(slots) == list(range(2000))
    strangers = mph.slots(keys[2000:])
    assert strangers.max() < 2000 and (strangers >= 0).any()
    assert exact_dedup.PerfectHash(keys[:0]).size == 0 and rng is not None


@pytest.mark.parametrize("cut", [-1, 2, 4, 99])
def test_exact_dedup(spark, odd, empty, cut):
    rows = [(i, ["a", "b", "a", None, "", "c", "a"][i], None) for i in range(7)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs(spark, rows), F.col("doc_id") <= cut).collect()}
    h = {t: hashlib.sha256(t.encode()).hexdigest() for t in ("a", "b", "", "c")}
    assert got == {0: (6, 3, False, h["a"]), 1: (1, 1, True, h["b"]), 2: (6, 3, False, h["a"]), 3: (4, 2, False, h[""]), 4: (4, 2, True, h[""]), 5: (5, 1, True, h["c"]), 6: (6, 3, True, h["a"])}
    odd_rows = exact_dedup.exact_dedup(odd, exact_dedup.halves(odd)).collect()
    assert len(odd_rows) == len(ODD) and sum(r.kept is True for r in odd_rows if r.doc_id == 7) == 2
    assert exact_dedup.exact_dedup(empty, exact_dedup.halves(empty)).count() == 0
    nulls = docs(spark, [(None, "a", None), (None, "a", None), (None, "b", None), (3, "b", None)])
    got = sorted((r.doc_id or 0, r.keep_id or 0, r.kept) for r in exact_dedup.exact_dedup(nulls, F.col("doc_id") <= cut).collect())
    assert got == [(0, 0, True), (0, 0, True), (0, 3, False), (3, 3, True)]


# --- 8 licenses ---------------------------------------------------------------------------------


def test_license_scan(spark, odd, empty):
    rows = [(1, "Some words.\nReleased under the MIT License.", None), (2, "Licensd under the Apache-License, Verson 2.0; general  PUBLIC license", None), (3, "summit license mit licenses", None), (4, "licensed under CC BY-NC 4.0", None), (5, "lots of plain words here", None)]
    got = {r.doc_id: r for r in license_scan.license_scan(docs(spark, rows)).collect()}
    assert [(p.word, p.label) for p in got[1].places] == [(5, "mit")] and got[1].n_words == 7
    assert {p.label for p in got[2].places} == {"apache", "gpl"}
    span = next(s for s in got[2].spans if s.label == "apache")
    assert (span.first_word, span.last_word, span.edits) == (0, 7, 2)
    assert not got[3].places and [s.label for s in got[4].spans] == ["cc-by-nc"] and not got[5].spans
    assert license_scan.license_scan(odd).count() == len(ODD) and license_scan.license_scan(empty).count() == 0


def test_seeds_find_every_edited_notice():
    rng = np.random.default_rng(0)
    scanner = license_scan.Scanner()
    for i, (label, notice) in enumerate(license_scan.NOTICES):
        for _ in range(10):
            text = list(notice)
            for _ in range(scanner.edits[i]):
                inner = [j for j in range(1, len(text) - 1) if " " not in text[j - 1 : j + 2]]
                at = int(rng.choice(inner))
                text[at : at + 1] = [["q"], [], [text[at], "q"]][rng.integers(3)]
            data = np.frombuffer(("xx " + "".join(text) + " yy").encode(), np.uint8)
            assert scanner.scan(data, np.array([0, len(data)]))[0]["spans"], (label, "".join(text))


def test_license_scan_matches_whole_text_search():
    rng = np.random.default_rng(7)
    scanner = license_scan.Scanner()
    for i, (_, notice) in enumerate(license_scan.NOTICES):
        for _ in range(12):
            text = list(notice)
            for at in rng.integers(1, len(text) - 1, int(rng.integers(0, scanner.edits[i] + 1))):
                text[at] = "q"
            stray = notice[int(rng.integers(0, 20)) :][: int(rng.integers(0, 24))].strip()
            whole = " ".join(f"{stray} {''.join(text)} {syllables(rng, int(rng.integers(0, 4)))}".split())
            data = np.frombuffer(whole.encode(), np.uint8)
            spans = scanner.scan(data, np.array([0, len(data)]))[0]["spans"]
            for (label, _), pattern in zip(license_scan.NOTICES, scanner.patterns, strict=True):
                if m := pattern.search(whole.encode()):
                    first, last = whole[: m.start()].count(" "), whole[: m.end()].count(" ")
                    assert any(x[1] <= last and x[2] >= first and x[3] <= sum(m.fuzzy_counts) for x in spans), (label, whole)


# --- 9 toxicity ---------------------------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.random() < 0.5), {f"t{t}": int(rng.integers(1, 4)) for t in set(rng.integers(0, 30, rng.integers(0, 8)))}) for i in range(1300)]
    index = toxicity.build_index(rows)
    number, held = {t: i for i, t in enumerate(index.terms)}, {r[0]: r[2] for r in rows if r[2]}
    assert sorted(index.ids) == sorted(held) and index.ceiling.shape[1] > 1
    full = np.zeros((len(held), len(index.terms)))
    for place, i in enumerate(index.ids.tolist()):
        t = np.array(sorted(number[x] for x in held[i]))
        full[place, t] = index.vector(t, np.array([held[i][index.terms[x]] for x in t]))
    for place in range(0, len(held), 7):
        t = np.flatnonzero(full[place])
        scores = np.round(full @ full[place], 12)
        scores[place] = 0
        want = sorted((-s, p) for p, s in enumerate(scores) if s > 1e-9)[:15]
        got = index.nearest(t, full[place, t], 15, but=place)
        assert np.allclose([s for s, _ in got], [-s for s, _ in want]) and len(got) == len(want)
        assert sum(a != b for (_, a), (_, b) in zip(got, want, strict=True)) <= 2  # ties apart by a rounding


def test_toxicity_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, syllables(rng, int(rng.integers(0, 40))) + (" vilewords" if i % 5 == 0 and i % 3 else ""), None) for i in range(400)]
    table, labels = docs(spark, rows), {i: int(i % 5 == 0) for i in range(0, 400, 2)}
    index = toxicity.fit_toxicity(table, spark.createDataFrame(list(labels.items()), "doc_id long, label int"))
    tally = {i: toxicity._tally(re.findall(r"\w+", t)) for i, t, _ in rows}
    used = set(index.terms)  # every word counts, toxic or not
    assert used >= {x for i in labels for x in tally[i] if not x.endswith("-")} and "vilew-" in used
    scale = dict(zip(index.terms, index.scale, strict=True))

    def vector(i):
        w = {x: (1 + np.log(n)) * scale[x] for x, n in tally[i].items() if x in used}
        norm = np.sqrt(sum(v * v for v in w.values())) or 1
        return {x: v / norm for x, v in w.items()}

    place = {int(i): p for p, i in enumerate(index.ids)}
    examples = {i: vector(i) for i in labels}
    got = {r.doc_id: r for r in toxicity.score_toxicity(table, index).collect()}
    assert len(got) == 400
    for i in range(1, 400, 9):
        mine = vector(i)
        near = sorted((-round(sum(v * e.get(x, 0) for x, v in mine.items()), 12), place[j]) for j, e in examples.items() if any(x in e for x in mine))[:15]
        assert np.allclose([-c for c, _ in near], [e.cosine for e in got[i].evidence])
        assert bool(got[i].evidence) == any(x in used for x in tally[i])
        weight = np.array([1 / (1.05 + c) for c, _ in near])
        if len({c for c, _ in near}) == len(near):
            vote = ((weight * index.label[[p for _, p in near]]).sum() + index.prior) / (weight.sum() + 1)
            ends, rates = index.steps
            assert not near or np.isclose(got[i].score, rates[min(np.searchsorted(ends, vote), len(ends) - 1)])


def test_isotonic_is_monotone():
    x, y = np.array([0.1, 0.2, 0.2, 0.4, 0.9]), np.array([0.0, 1.0, 0.0, 0.0, 1.0])
    ends, rates = toxicity.isotonic(x, y)
    assert (np.diff(ends) > 0).all() and (np.diff(rates) >= 0).all()


def test_toxicity_fit_gives_memory_back(spark, monkeypatch):
    called = []
    monkeypatch.setattr(toxicity, "release", lambda: called.append(1))
    toxicity.fit_toxicity(docs(spark, [(1, "a b", None)]), spark.createDataFrame([(1, 1)], "doc_id long, label int"))
    assert called


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)] + [(8, None), (3, 2), (1, 1), (None, 1)], "doc_id long, label int")
    got = toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit_toxicity(empty, labels)
    assert toxicity.score_toxicity(empty, none).count() == 0 and toxicity.score_toxicity(odd, none).count() == len(ODD)


# --- 10 byte-level BPE --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


def test_bpe_matches_tiktoken(vocabulary):
    import tiktoken

    path, pattern = vocabulary
    ranks = bpe.load_ranks(path)
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = bpe.Encoder(ranks, pattern, max_states=2000, max_pieces=100), bpe.Decoder(ranks)
    assert all(encoder.transducer.encode_piece(t) == [r] for t, r in list(ranks.items())[::37])
    rng = np.random.default_rng(0)
    alphabet = list("abcdefghijklmno stu \n.,!é日😀0123")
    cases = ["", "aaaa" * 500, "<|endoftext|>", "x" * 3000, "'s  don't\r\n\t"] + ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(600)]
    for text in cases:
        ids = encoder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert "".join(decoder.stream(np.array(ids[i : i + 3], dtype=np.int32) for i in range(0, len(ids), 3))) == text


def test_utf8_stream():
    text = "aé日😀z"
    for n in range(1, 6):
        stream, out = bpe.Utf8Stream(), ""
        data = text.encode()
        for i in range(0, len(data), n):
            out += stream.feed(data[i : i + n])
        stream.close()
        assert out == text
    for bad in (b"\xff", b"\xc0\x80", b"\xed\xa0\x80", b"a\x80"):
        with pytest.raises(ValueError):
            s = bpe.Utf8Stream()
            s.feed(bad)
            s.close()
    s = bpe.Utf8Stream()
    s.feed(b"\xe6\x97")
    with pytest.raises(ValueError):
        s.close()


def test_bpe_odd(odd, empty, vocabulary):
    path, pattern = vocabulary
    made = {r.doc_id: r for r in bpe.encode_decode(odd, path, pattern).collect()}
    assert made[1].ids == made[2].ids == [] and made[7].decoded == "日本語 😀 é" and made[4].decoded == LONG
    got = {r.doc_id: r for r in bpe.encode_decode(odd, path, pattern, digests=True).collect()}
    assert got[2].n_tokens == 0 and got[4].n_tokens == len(made[4].ids)
    assert got[4].ids_sha256 == hashlib.sha256(" ".join(map(str, made[4].ids)).encode()).hexdigest()
    assert bpe.encode_decode(empty, path, pattern).count() == 0


# --- pipeline -----------------------------------------------------------------------------------


@needs_tables
def test_pipeline_stages(spark, small, tmp_path):
    at, seen = small, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == small.columns
        out.write.parquet(str(tmp_path / name))
        before, at = at, spark.read.parquet(str(tmp_path / name))
        seen.append((name, before, at))
    kept = {name: texts(after) if "text" in after.columns else None for name, _, after in seen}
    exact = texts(seen[1][1])
    assert set(kept["exact_dedup"]) == {max(i for i in exact if exact[i] == t) for t in set(exact.values())}
    shingles = {i: simhash.shingles(t.encode(), 5) for i, t in kept["exact_dedup"].items()}
    alike = [(a, b) for a in shingles for b in shingles if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    assert all(b not in kept["simhash_near_dedup"] or a not in kept["simhash_near_dedup"] for a, b in alike)
    gone = set(kept["exact_dedup"]) - set(kept["simhash_near_dedup"])
    assert gone <= {x for pair in alike for x in pair}
    assert seen[4][2].count() == len(kept["decontamination"])
    assert corpus_pipeline.run(spark, SF).count() == seen[4][2].count()


def test_pipeline_odd(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing alike in here at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table, least in ((odd, 4), (empty, 0)):
        at = table
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, str(tmp_path))
        assert at.count() >= least


def test_pipeline_keeps_other_texts_under_a_rejected_id(spark, tmp_path):
    rng = np.random.default_rng(9)
    passage, plain, twin = syllables(rng, 30), syllables(rng, 60), syllables(rng, 80)
    rows = [(1, f"{plain} {passage}", None), (1, syllables(rng, 50), None), (2, twin, None), (3, twin, None), (3, syllables(rng, 40), None), (2, syllables(rng, 45), None), (4, f"{twin} more", None), (2, twin, None)]
    table = docs(spark, rows)
    spark.createDataFrame([(99, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
    got = [(r.doc_id, r.text) for r in table.collect()]
    assert len(got) == 4 and {(i, t) for i, t, _ in rows if t not in (twin, f"{twin} more", f"{plain} {passage}")} < set(got)
    assert sum(twin in t for _, t in got) == 1
