"""Language model, classifier, rules, decontamination, transcripts and licenses."""

from __future__ import annotations

import itertools
import math
import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citelake.llm import hidden_markov as hm
from citelake.llm import host_rules, latent_retrieval, license_scan, site_bayes, transcripts
from tests.conftest import SF_DIR

LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def out_of(key) -> bool:
    return zlib.crc32(str(key).encode()) % 10 == 0


# Hidden Markov model


def test_forward_and_counts_equal_all_paths():
    random = np.random.default_rng(1)
    model = hm.Model(*[x / x.sum(axis=-1, keepdims=True) for x in (random.random(3), random.random((3, 3)))], None)
    model.emit = random.random((hm.CLASSES + 1, 3))
    classes = np.array([4, 9, 4, 7, 7, 2], dtype=np.int32)
    places = np.array([0, 2, 6])
    at, begin, texts = hm.by_time(places)
    ordered = np.empty(6, dtype=np.int32)
    ordered[at] = classes
    scales = hm.forward(model, model.emit[ordered], begin)
    start, steps, emissions = hm.expected_counts(model, classes, places)
    want_start, want_steps, want_emissions = np.zeros(3), np.zeros((3, 3)), np.zeros_like(model.emit)
    for a, b in zip(places, places[1:], strict=False):
        seen, paths = classes[a:b], {}
        for path in itertools.product(range(3), repeat=b - a):
            p = model.start[path[0]]
            for i, s in enumerate(path):
                p *= model.emit[seen[i], s] * (model.step[path[i - 1], s] if i else 1)
            paths[path] = p
        total = sum(paths.values())
        own = [np.log(scales[at[i]]) for i in range(a, b)]
        assert math.isclose(sum(own), math.log(total), rel_tol=1e-9)
        for path, p in paths.items():
            want_start[path[0]] += p / total
            for i, s in enumerate(path):
                want_emissions[seen[i], s] += p / total
                if i:
                    want_steps[path[i - 1], s] += p / total
    assert np.allclose(start, want_start) and np.allclose(steps, want_steps)
    assert np.allclose(emissions, want_emissions)


def test_scores(documents):
    random.seed(2)
    one, two = ([f"{c}{i}" for i in range(40)] for c in "ab")
    # Enough tokens for the model's class table; see its description.
    texts = [" ".join(random.choices(random.choice([one, two]), k=random.randint(1, 900))) for _ in range(160)]
    texts += [None, "", "unseen Words", "a1 " * 3000]
    frame = documents(texts)
    rows = {r.doc_id: r for r in hm.score(frame, rounds=4).collect()}
    tokens = {i: [*words_of(x), None] for i, x in enumerate(texts, 1)}
    counts = Counter(w for i, ws in tokens.items() if not out_of(i) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = rows[i]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out_of(i), len(ws), total)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_nothing_and_of_null_keys(documents):
    assert hm.score(documents([]), rounds=1).count() == 0
    rows = hm.score(documents(["a b", "a b"], ids=[None, None]), rounds=1).collect()
    assert [(r.held_out, r.n_tokens, r.train_tokens) for r in rows] == [(False, 3, 6)] * 2


# Classifier


def test_classifier_on_the_given_labels(llm):
    docs = llm.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    labels = llm.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/labels.parquet")
    held = labels.filter("doc_id % 4 = 0")
    rows = site_bayes.classify(docs.withColumn("rejected", F.lit("clash")), labels.filter("doc_id % 4 != 0"))
    assert rows.count() == docs.count()
    judged = rows.join(held, "doc_id").select("rejected", "quality", "toxic").collect()
    clean = [r.rejected for r in judged if r.quality == 1 and r.toxic == 0]
    junk = [r.rejected for r in judged if r.quality == 0]
    assert sum(clean) <= 0.05 * len(clean) and sum(junk) >= 0.8 * len(junk)


def test_sparse_sites_are_shrunk(documents, llm):
    rows = [("big", "en", 0.9)] * 200 + [("good", "en", 0.1)] * 200 + [("tiny", "en", 0.9), (None, None, 0.1)]
    own = llm.createDataFrame(rows, "host string, path string, p double")
    rates, overall = site_bayes.site_rates(own)
    p = {r.host: r.p_site for r in rates.collect()}
    assert math.isclose(overall, 0.5, abs_tol=0.01)
    assert p["big"] > 0.85 and p["good"] < 0.15 and overall < p["tiny"] < p["big"] and p["good"] < p[None] < overall


def test_a_document_says_nothing_about_its_own_site(documents, llm, monkeypatch):
    """Every probability beside one that is worked out here from all other rows."""
    random.seed(15)
    sites = [("big", "en")] * 30 + [("big", "de")] * 5 + [("bad", "en")] * 20 + [("alone", "en"), (None, None)]
    texts = ["junk buy now " * random.randint(1, 9) if h == "bad" else f"fine prose w{i} here" for i, (h, _) in enumerate(sites)]
    frame = documents(texts, sources=[h for h, _ in sites])
    lang = F.create_map(*[F.lit(x) for i, (_, p) in enumerate(sites, 1) for x in (i, p or "")])[F.col("doc_id")]
    frame = frame.withColumn("lang", F.nullif(lang, F.lit("")))
    labels = llm.createDataFrame([(i, int(h != "bad"), 0) for i, (h, _) in enumerate(sites, 1)], "doc_id long, quality int, toxic int")
    seen = {}
    kept = site_bayes.site_rates
    monkeypatch.setattr(site_bayes, "site_rates", lambda own: seen.setdefault("rates", kept(own)))
    rows = site_bayes.classify(frame, labels).collect()
    overall, strengths = seen["rates"][1], seen["rates"][0].select("by_host", "by_path").first()
    assert len(rows) == len(sites)
    for r in rows:
        others = [x for x in rows if x.doc_id != r.doc_id]
        host = [x.p_own for x in others if x.source == r.source]
        path = [x.p_own for x in others if (x.source, x.lang) == (r.source, r.lang)]
        towards = (sum(host) + strengths.by_host * overall) / (len(host) + strengths.by_host)
        rate = (sum(path) + strengths.by_path * towards) / (len(path) + strengths.by_path)
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        odds = r.p_own / (1 - r.p_own) * rate / (1 - rate) * (1 - overall) / overall
        assert math.isclose(r.p_site, rate, rel_tol=1e-6)
        assert math.isclose(r.p_reject, odds / (1 + odds), rel_tol=1e-6) and r.rejected == (r.p_reject >= 0.5)
    alone = next(r for r in rows if r.source == "alone")
    assert math.isclose(alone.p_site, overall, rel_tol=1e-9) and math.isclose(alone.p_reject, alone.p_own, rel_tol=1e-9)


def test_toxic_documents_are_rejected(llm):
    docs = llm.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/documents.parquet")
    labels = llm.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/labels.parquet")
    rows = site_bayes.classify(docs, labels.filter("doc_id % 4 != 0"))
    toxic = rows.join(labels.filter("doc_id % 4 = 0 AND toxic = 1"), "doc_id").select("rejected").collect()
    assert len(toxic) > 100 and sum(r.rejected for r in toxic) >= 0.85 * len(toxic)


def test_classifier_edges(documents, llm):
    labels = llm.createDataFrame([(1, 0, None), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    frame = documents(["junk", None, "", "fine words"], ids=[1, 2, None, 2], sources=["s", None, "s", "t"])
    rows = site_bayes.classify(frame, labels).collect()
    assert len(rows) == 4 and all(0 < r.p_reject < 1 for r in rows)
    assert site_bayes.classify(documents([]), labels.limit(0)).count() == 0


# Rules


def brute_rules(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)
    )


def test_rules_equal_brute_force(documents):
    random.seed(7)
    texts = ["".join(random.choices("ab é日#|\n\t\x0b ", k=random.randint(0, 120))) for _ in range(120)]
    texts += [None, "", " \n ", "a b c d e " * 400, "x y z w v\nx y z w v", "\x1c a\x85b"]
    rows = {r.doc_id: r for r in host_rules.apply_host_rules(documents(texts).withColumn("kept", F.lit(2))).collect()}
    for i, text in enumerate(texts, 1):
        r = rows[i]
        want = brute_rules(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_hosts_that_mostly_fail_are_dropped(documents):
    good = " ".join(f"word{i}" for i in range(30))
    texts = ["bad"] * 90 + [good] * 10 + [good] * 100 + ["bad", good]
    sources = ["spam"] * 100 + ["fine"] * 100 + ["once", None]
    rows = host_rules.apply_host_rules(documents(texts, sources=sources)).collect()
    kept = {(r.source, r.base_failed): r.kept for r in rows}
    assert not kept["spam", False] and kept["fine", False] and not kept["once", True] and kept[None, False]
    assert host_rules.apply_host_rules(documents([])).count() == 0


def test_rules_stay_native(documents):
    frame = host_rules.measure(documents(["a"]))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


# Decontamination


def test_common_length():
    random.seed(8)
    for _ in range(100):
        a, b = ([random.randint(0, 5) for _ in range(random.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert latent_retrieval.common_length(a, b) == table[-1][-1]


def test_windows_cover_all_words():
    for sizes in ([0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 200], [0], []):
        places = np.cumsum([0, *sizes])
        start, end, owner = latent_retrieval.windows(places, 32, 16)
        for i, n in enumerate(sizes):
            spans = [(s, e) for s, e, o in zip(start, end, owner, strict=True) if o == i]
            assert {x for s, e in spans for x in range(s, e)} == set(range(places[i], places[i] + n))


@pytest.mark.parametrize("block", [2, 512])
def test_planted_passages_are_found(documents, llm, block, monkeypatch):
    monkeypatch.setattr(latent_retrieval, "BLOCK_ITEMS", block)
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [random.choices(vocabulary, k=n) for n in (12, 20, 35, 60)]
    texts, planted = [], set()
    for number in range(1, 61):
        words = random.choices(vocabulary, k=random.choice([20, 100, 700]))
        if number % 3 == 0:
            item = number // 3 % len(items)
            passage = list(items[item])
            if number % 2:  # a paraphrase: every tenth word is another
                passage[::10] = ["other"] * len(passage[::10])
            at = random.randint(0, len(words))
            words[at:at] = passage
            planted.add((number, item))
        texts.append(" ".join(words).upper())
    texts += [None, "", " \n"]
    rows = [(i, " ".join(w)) for i, w in enumerate(items)] + [(8, None), (9, "")]
    benchmark = llm.createDataFrame(rows, "item_id long, text string")
    got = latent_retrieval.contaminated(documents(texts).withColumn("score", F.lit(0)), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert latent_retrieval.contaminated(documents([]), benchmark).count() == 0
    assert latent_retrieval.contaminated(documents(texts), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("length", [3, 97, 300, 1000])
@pytest.mark.parametrize("once", [False, True])
def test_passages_of_any_length_between_any_words(documents, llm, length, once):
    random.seed(12)
    vocabulary = [f"w{i}" for i in range(2000)]
    item = random.choices(vocabulary, k=length)
    changed = [w if i % 5 else "other" for i, w in enumerate(item, 1)]
    answered = [w if i % 5 < 3 or i > length - 5 else f"x{i}" for i, w in enumerate(item)]
    inserted = [x for w in item for x in ([w, "more"] if length > 3 else [w])]
    texts = []
    for number, passage in enumerate([item, changed, inserted[: 7 * length // 4], answered, item[: length // 3], []]):
        around = [f"once{number}x{i}" for i in range(800)] if once else random.choices(vocabulary, k=800)
        texts.append(" ".join(around[:400] + passage + around[400:]))
    texts += ["nothing of it"] * 60
    rows = [(1, " ".join(item[:-4] + ["end."] + item[-4:] if length > 3 else item))]
    benchmark = llm.createDataFrame(rows, "item_id long, text string")
    got = latent_retrieval.contaminated(documents(texts), benchmark).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4}


def test_candidates_lose_nothing_that_the_check_accepts():
    random.seed(13)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(random.choices(vocabulary, k=random.randint(0, 150))) for _ in range(60)]
    items = [" ".join(random.choices(vocabulary, k=k)) for k in (1, 2, 5, 9, 20, 60)]
    words = latent_retrieval.column_words(pa.array(texts))
    block = latent_retrieval.prepare(items, [""] * len(items), np.ones(latent_retrieval.BINS))
    found = latent_retrieval.candidates(words, block)
    for d, j in itertools.product(range(len(texts)), range(len(items))):
        own, item = words.of(d).tolist(), block.words[j]
        for at in range(len(own)):
            if 2 * latent_retrieval.common_length(item, own[at : at + 2 * len(item)]) >= len(item):
                assert (d, j) in found


@pytest.mark.parametrize("length", [24, 60, 300])
def test_passages_are_retrieved_by_their_cosine(length, monkeypatch):
    random.seed(14)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [random.choices(vocabulary, k=length) for _ in range(100)]
    texts = []
    for item in items:
        around = random.choices(vocabulary, k=400)
        texts.append(around[:200] + [w if random.random() < 0.6 else random.choice(vocabulary) for w in item] + around[200:])
    copies = [text[:150] + item + text[150:] for item, text in zip(items[1:] + items[:1], texts, strict=True)]
    idf = np.ones(latent_retrieval.BINS, np.float32)
    block = latent_retrieval.prepare([" ".join(item) for item in items], [""] * len(items), idf)
    basis = np.zeros((latent_retrieval.LATENT_BINS, 1))
    words = latent_retrieval.column_words(pa.array([" ".join(text) for text in texts]))
    found = latent_retrieval.retrieved(words, block)
    # Measured against every passage: recall of the planted ones, and few others.
    assert sum((i, i) in found for i in range(100)) >= 90
    assert len(found) < 1000
    # With no other source of candidates, copies get all the way through the check.
    monkeypatch.setattr(latent_retrieval, "candidates", lambda words, items: {})
    words = latent_retrieval.column_words(pa.array([" ".join(text) for text in copies]))
    got = {(d, j): (lcs, cosine) for d, j, lcs, _, _, cosine in latent_retrieval.matches(words, block, idf, basis)}
    assert all(got[i, (i + 1) % 100] >= (1, latent_retrieval.COSINE) for i in range(100))


def test_passages_are_summed_like_every_window():
    """Cosines and stretches, compared with one window after the other; texts shorter than a passage too."""
    rng = np.random.default_rng(15)
    items = [rng.integers(0, 300, n) for n in (5, 20, 33, 70, 200)]
    texts = [rng.integers(0, 300, n) for n in (0, 3, 31, 33, 100, 600, 1500)]
    texts = [np.concatenate([text, items[i % 5], text]) if i % 2 else text for i, text in enumerate(texts)]
    joined = [" ".join(f"w{w}" for w in item) for item in items]
    words = latent_retrieval.column_words(pa.array([" ".join(f"w{w}" for w in text) for text in texts]))
    block = latent_retrieval.prepare(joined, [""] * 5, np.ones(latent_retrieval.BINS, np.float32))
    want, step = {}, latent_retrieval.STEP
    for d, j in itertools.product(range(len(texts)), range(5)):
        begin, stop = words.places[d], words.places[d + 1]
        n, point = len(items[j]), block.points[j].astype(float)
        wide = 2 ** int(np.ceil(np.log2(max(n, latent_retrieval.SHORTEST) / step))) * step
        cosines, spans = [], []
        for low in range(begin, max(begin + 1, stop - wide + wide // 4), wide // 4):
            row = block.rows[latent_retrieval.bins_of(words.hashes[low : min(low + wide, stop)])]
            passage = block.space[row[row >= 0]].astype(float).sum(axis=0)
            along, whole = passage @ point / np.linalg.norm(point), np.linalg.norm(passage)
            if along >= latent_retrieval.COSINE * whole > 0 and along >= latent_retrieval.REACH * np.linalg.norm(point):
                cosines.append(along / whole)
                spans.append((max(begin, low - n), min(stop, low + wide + n)))
        if spans:
            want[d, j] = max(cosines), latent_retrieval.joined(spans)
    got = latent_retrieval.retrieved(words, block)
    assert got.keys() == want.keys() and len(want) >= 3
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-5 for k in want)


def test_reading_a_text_for_its_passages_costs_little_more_than_its_words():
    """CPU time against that of cutting the same text into words (it was 11 times as long on the given tables)."""
    rng = np.random.default_rng(16)
    texts = pa.array([" ".join(f"w{w}" for w in rng.zipf(1.3, 400) % 30000) for _ in range(800)])
    words = latent_retrieval.column_words(texts)
    idf = (1 + rng.random(latent_retrieval.BINS)).astype(np.float32)
    random_rows = rng.normal(0, 1, (32, latent_retrieval.LATENT_BINS))
    total = np.zeros_like(random_rows)

    def seconds(work, *arguments) -> float:
        took = []
        for _ in range(5):
            start = time.thread_time()
            work(*arguments)
            took.append(time.thread_time() - start)
        return min(took)

    cut = seconds(latent_retrieval.column_words, texts)
    assert seconds(latent_retrieval.there_and_back, words, idf, random_rows, total) < 6 * cut
    # What went there and back is the product with the passages' rows.
    words = latent_retrieval.column_words(texts[:50])
    total[:] = 0
    latent_retrieval.there_and_back(words, idf, random_rows, total)
    rows = np.zeros((50 * 13, latent_retrieval.LATENT_BINS), np.float32)
    bins = latent_retrieval.bins_of(words.hashes)
    passage = np.arange(len(bins)) // 400 * 13 + np.arange(len(bins)) % 400 // latent_retrieval.WINDOW
    np.add.at(rows, (passage, bins & (latent_retrieval.LATENT_BINS - 1)), idf[bins])
    length = np.sqrt(np.bincount(passage, idf[bins].astype(float) ** 2, minlength=len(rows))) + 1e-9
    rows /= length[:, None].astype(np.float32)
    want = rows.T @ (rows @ random_rows.T)
    assert np.allclose(total, want.T, atol=1e-4)


def test_only_the_best_stretches_are_scored(monkeypatch):
    item = [f"w{i}" for i in range(40)]
    text = [f"x{i}" for i in range(200)] + item + [f"y{i}" for i in range(200)]
    block = latent_retrieval.prepare([" ".join(item)], [""], np.ones(latent_retrieval.BINS, np.float32))
    words = latent_retrieval.column_words(pa.array([" ".join(text)]))
    scored = []
    monkeypatch.setattr(latent_retrieval, "likeness", lambda bins, *_: scored.append(len(np.unique(bins))) or 1.0)
    found = list(latent_retrieval.matches(words, block, None, None))
    assert [row[:3] for row in found] == [(0, 0, 1.0)]
    # Before, each stretch that held half of the item was: 17 and more.
    assert 1 <= len(scored) <= 10


def test_an_answer_beside_a_short_question(documents, llm):
    item, reply = [f"q{i}" for i in range(10)], [f"a{i}" for i in range(12)]
    asked = [w if i % 3 else "other" for i, w in enumerate(item)]
    texts = [" ".join(["so"] * 50 + asked + part + ["so"] * 50) for part in (["well"] * 10 + reply, ["well"] * 22)]
    benchmark = llm.createDataFrame([(1, " ".join(item), " ".join(reply))], "item_id long, text string, answer string")
    found = latent_retrieval.contaminated(documents(texts + ["nothing"] * 9), benchmark, answer="answer").collect()
    assert [r.doc_id for r in found] == [1]


# Transcripts


def conversations(llm, n: int):
    random.seed(10)
    rows = []
    for conv in range(n):
        turn = 0
        if random.random() < 0.4:
            rows.append((conv, turn, "system", "Be brief and kind. " * random.randint(2, 4)))
            turn += 1
        for _ in range(random.randint(1, 4)):
            more = random.choice(["", "", "\nplease say"])
            rows.append((conv, turn, "user", "how is it" + " so" * random.randint(0, 5) + "?" + more))
            rows.append((conv, turn + 1, "assistant", "\n".join(["It is so. " * 9] * random.randint(1, 5))))
            turn += 2
    return llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_roles_are_recovered_and_rendered(llm):
    rows = conversations(llm, 60)
    known = rows.filter("conv_id % 3 != 0")
    got = transcripts.recover_roles(rows.withColumn("part", F.lit("clash")), known).collect()
    held = [r.given == r.role for r in got if r.conv_id % 3 == 0]
    assert len(got) == rows.count() and sum(held) >= 0.95 * len(held)
    assert all(r.rendered.startswith(f"<|{r.role}|>\n") and r.rendered.endswith("\n<|end|>") for r in got)


def test_blocks_give_the_path_of_the_whole(llm, monkeypatch):
    rows = conversations(llm, 40).withColumn("turn", F.col("conv_id") * 20 + F.col("turn"))
    rows = rows.withColumn("conv_id", F.lit(1))
    found = []
    for block, fan in ((3, 2), (10**6, 64)):
        monkeypatch.setattr(transcripts, "BLOCK_TURNS", block)
        monkeypatch.setattr(transcripts, "FAN", fan)
        found.append(sorted(transcripts.recover_roles(rows).select("turn", "part", "role").collect()))
    assert found[0] == found[1]


def test_markers_split_a_row_and_edges(llm):
    rows = conversations(llm, 30)
    text = "User: how is it?\nAssistant: " + "\n".join(["It is so. " * 9] * 3)
    odd = [(900, 0, None, text), (901, 0, None, None), (901, 0, None, None), (None, None, None, "")]
    more = rows.unionByName(llm.createDataFrame(odd, rows.schema))
    got = transcripts.recover_roles(more).filter("conv_id >= 900 OR conv_id IS NULL").collect()
    assert [(r.part, r.role) for r in sorted(got, key=lambda r: r.part) if r.conv_id == 900] == [
        (0, "user"), (1, "assistant")
    ]
    assert any(r.rendered == "<|user|>\nhow is it?\n<|end|>" for r in got)
    assert sum(r.conv_id == 901 for r in got) == 2 and sum(r.conv_id is None for r in got) == 1
    assert transcripts.recover_roles(rows.limit(0)).count() == 0


def plain_viterbi(tables, lines):
    """Best score and states over (features, begins) of all lines of a conversation, line by line."""
    features, begins = (np.concatenate(x) for x in zip(*lines, strict=True))
    scores = tables.scores(features, begins)
    best = {s: (tables.step[transcripts.START, s] + scores[0, s], [s]) for s in range(transcripts.STATES)}
    for row in scores[1:]:
        best = {
            s: max(((v + tables.step[t, s] + row[s], path) for t, (v, path) in best.items()), key=lambda x: x[0])
            for s in range(transcripts.STATES)
        }
        best = {s: (v, [*path, s]) for s, (v, path) in best.items()}
    return max(best.values(), key=lambda x: x[0])[1]


def brute_turns(tables, rows):
    """Rendered turns of each conversation, from the rows in order of turn and text."""
    found = []
    for conv in {r.conv_id for r in rows}:
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: (-1 if r.turn is None else r.turn, r.text or ""))
        seen = [transcripts.observe(r.text) for r in own]
        states = plain_viterbi(tables, [x[1:] for x in seen])
        for r, (lines, *_) in zip(own, seen, strict=True):
            mine, states = states[: len(lines)], states[len(lines) :]
            cuts = [i for i, s in enumerate(mine) if s % 2 == 0 or i == 0] + [len(lines)]
            for a, b in itertools.pairwise(cuts):
                role = transcripts.ROLES[mine[a] // 2]
                found.append((str(conv), -1 if r.turn is None else r.turn, role, transcripts.canonical(role, lines[a:b])))
    return Counter(found)


@pytest.mark.parametrize("block", [3, 64])
def test_paths_equal_plain_viterbi(llm, monkeypatch, block):
    monkeypatch.setattr(transcripts, "BLOCK_TURNS", block)
    rows = conversations(llm, 25)
    text = "User: how is it?\nAssistant: It is so. " * 3
    odd = [(900, 0, None, text), (900, 0, None, text), (901, None, None, "b"), (901, None, None, "a"), (901, 4, "user", None)]
    rows = rows.unionByName(llm.createDataFrame([*odd, *[(None, 1, None, f"x{i}?") for i in range(20)]], rows.schema))
    learnt = {}
    kept = transcripts.learn
    monkeypatch.setattr(transcripts, "learn", lambda rows: learnt.setdefault("tables", kept(rows)))
    got = transcripts.recover_roles(rows).collect()
    assert Counter((str(r.conv_id), r.turn, r.role, r.rendered) for r in got) == brute_turns(learnt["tables"], rows.collect())


def test_transitions_equal_a_plain_count(llm):
    rows = conversations(llm, 30).withColumn("role", F.when(F.col("turn") % 5 != 3, F.col("role")))
    rows = rows.withColumnRenamed("conv_id", "conv")
    want = np.zeros((transcripts.STATES + 1, len(transcripts.ROLES)))
    before = (None, None, None)
    for r in sorted(rows.collect(), key=lambda r: (r.conv, r.turn)):
        if r.role:
            if before[0] != r.conv:
                want[transcripts.START, transcripts.ROLES.index(r.role)] += 1
            elif before[1]:
                at = 2 * transcripts.ROLES.index(before[1]) + ("\n" in before[2])
                want[at, transcripts.ROLES.index(r.role)] += 1
        before = (r.conv, r.role, r.text)
    assert np.array_equal(transcripts.transitions(rows, rows.schema["conv"].dataType), want)


def test_rows_without_turn_are_cut_into_blocks(llm):
    """Ten thousand rows of one conversation without a turn, most of them alike."""
    made = [("user" if i % 2 else None, "why?" if i % 10 else f"It is {i}.") for i in range(10_000)]
    rows = llm.createDataFrame([(None, None, role, text) for role, text in made], "conv_id long, turn long, role string, text string")
    blocks = transcripts.numbered(rows.selectExpr("conv_id AS conv", "-1L AS turn", "role", "text"))
    blocks = blocks.groupBy(F.floor(F.col("place") / transcripts.BLOCK_TURNS)).count()
    assert blocks.agg(F.max("count"), F.sum("count")).first() == (transcripts.BLOCK_TURNS, 10_000)
    got = transcripts.recover_roles(rows)
    assert got.count() == 10_000 and got.filter("turn = -1 AND conv_id IS NULL").count() == 10_000


# Licenses


def test_alignment_is_a_common_subsequence():
    random.seed(11)
    for _ in range(200):
        a, b = ([random.randint(0, 12) for _ in range(random.randint(0, 20))] for _ in range(2))
        assert license_scan.align(a, b)[0] <= latent_retrieval.common_length(a, b)
        assert license_scan.align(a, a)[0] == len(a)
        cut = [x for x in range(50) if x not in (7, 8, 30)]
        assert license_scan.align(list(range(50)), cut) == (47, 0, 47)


def test_licenses_are_found(documents):
    mit = license_scan.TEMPLATES["mit"]
    changed = mit.replace("free of charge, ", "").replace("Software", "SOFTWARE")
    texts = [
        f"prose before\n{mit}\nand after", changed, "nothing of the kind", None, "", "the license " * 50,
        "Released under\n  the MIT license!!", "x " * 5000 + license_scan.TEMPLATES["bsd"] + " y" * 5000,
        f"{mit} {mit}",
    ]
    rows = license_scan.scan_licenses(documents(texts).withColumn("license", F.lit(1))).collect()
    assert {(r.doc_id, r.license) for r in rows} == {(1, "mit"), (2, "mit"), (7, "mit-notice"), (8, "bsd"), (9, "mit")}
    whole = next(r for r in rows if r.doc_id == 1)
    assert whole.coverage == 1.0 and (whole.start, whole.end) == (2, 2 + whole.matched)
    assert license_scan.scan_licenses(documents(texts), {}).count() == 0
    assert license_scan.scan_licenses(documents([])).count() == 0


def test_near_misses_are_told_apart(documents):
    mit, bsd3 = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["bsd-3-clause"]
    whole = license_scan.whole_texts()
    texts = [
        "Released under the BSD License.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under the Apache License, Version 1.1.", "Released under the Foo License.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.", "some words. All rights reserved.",
        license_scan.TEMPLATES["mit-0"], bsd3, license_scan.TEMPLATES["bsd"], license_scan.TEMPLATES["0bsd"],
        mit[: len(mit) // 2], whole["gpl-3.0-text"], whole["gpl-3.0-text"].replace("GNU G", "GNU AFFERO G"),
        f"Released under the MIT License. {'x ' * 900} {license_scan.TEMPLATES['zlib']}", whole["cc0-1.0-text"],
    ]
    rows = license_scan.scan_licenses(documents(texts)).collect()
    want = [
        "bsd-notice", "cc-by-sa-4.0-notice", "cc-by-nc-sa-4.0-notice", None, None, "lgpl-3.0-notice", "gpl-2.0-notice",
        "all-rights-reserved", "mit-0", "bsd-3-clause", "bsd", "0bsd", None, "gpl-3.0-text", None,
    ]
    got = {i: {r.license for r in rows if r.doc_id == i} for i in range(1, 18)}
    for i, name in enumerate(want, 1):
        # A whole GPL holds the header that it tells to attach.
        assert got[i] - {"gpl-3.0", "agpl-3.0"} == ({name} if name else set()), (i, got[i])
    assert got[16] == {"mit-notice", "zlib"} and got[17] == {"cc0-1.0-text"}


def test_every_whole_text_is_found(documents):
    whole = license_scan.whole_texts()
    names = sorted(whole)
    rows = license_scan.scan_licenses(documents([whole[n] for n in names])).collect()
    assert len(names) == 7
    for i, name in enumerate(names, 1):
        best = max((r for r in rows if r.doc_id == i), key=lambda r: r.matched)
        assert (best.license, best.coverage) == (name, 1.0)


def test_other_spellings_of_notices(documents):
    texts = {
        "GNU General Public License, version 3.0.": "gpl-3.0-full-notice",
        "This work is licensed under the GNU Lesser General Public License, version 3.0.": "lgpl-3.0-full-notice",
        "Licensed under the GPL v3.": "gpl-3.0-short-notice",
        "Licensed under the AGPLv3.": "agpl-3.0-joined-notice",
        "// SPDX-License-Identifier: MIT": "mit-spdx",
        "# SPDX-License-Identifier: Apache-2.0": "apache-2.0-spdx",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later-spdx",
        "Licensed under CC-BY-4.0.": "cc-by-4.0-id-notice",
        "Licensed under CC-BY-NC-SA-4.0.": "cc-by-nc-sa-4.0-id-notice",
        "SPDX-License-Identifier: Other-1.0": None,
        "Licensed under the GPL v9.": None,
        "the GPL v3 was licensed by them under protest": None,
        "Licensed under CC-BY-3.0.": None,
    }
    rows = license_scan.scan_licenses(documents([f"some prose {t} and more" for t in texts])).collect()
    for i, (text, name) in enumerate(texts.items(), 1):
        assert [r.license for r in rows if r.doc_id == i] == ([name] if name else []), text
