"""The parity-sketch join and the suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citelake.llm import parity_join, suffix_dedup
from citelake.llm.components import components
from citelake.llm.parity_join import band_of, features, near_duplicates, sketch_bits
from citelake.llm.suffix_dedup import merged, multikey_order, remove_repeats
from citelake.llm.words import column_words, shingle_set

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_components(texts):
    sets = {i: shingles(x) for i, x in enumerate(texts, 1)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(1, i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def some_texts(seed: int) -> list[str]:
    """Random texts with copies, near copies on both sides of the threshold and shared passages."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = random.choices(vocabulary, k=60)
    texts = []
    for _ in range(45):
        words = random.choices(vocabulary, k=random.choice([3, 6, 9, 20, 60, 66, 130, 300, 900]))
        if random.random() < 0.3:
            words[5:5] = passage
        texts.append(words)
    for _ in range(75):
        words = list(random.choice(texts[:45]))
        for _ in range(random.randint(0, max(1, len(words) // 25))):
            at = random.randrange(len(words))
            words[at : at + 1] = random.choice([[], ["changed"], [words[at], "added"]])
        texts.append(words)
    return [" ".join(w) for w in texts] + [None, "", "  \n", texts and "One two", "one TWO"]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(documents, seed, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 8)
    texts = some_texts(seed)
    rows = near_duplicates(documents(texts).withColumn("component_id", F.lit("clash"))).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == brute_components(texts)


def test_null_keys_repeated_rows_and_empty_tables(documents):
    frame = documents(["a b c d e f", "a b c d e f", "q"], ids=[4, 4, None])
    rows = near_duplicates(frame).collect()
    # a row without a key has a row of its own, which no link names
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    assert found == [(4, 2, 4), (4, 2, 4), (None, 1, None)]
    frame = documents(["a b c d e f", "a b c d e f", None], ids=[1, None, None])
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(frame).collect()), key=str)
    assert found == [(1, 2, 1), (None, 0, None), (None, 2, None)]
    assert near_duplicates(documents([])).count() == 0


def test_keys_that_are_no_integers_are_refused(documents):
    frame = documents(["a"]).withColumn("doc_id", F.lit("x"))
    with pytest.raises(TypeError):
        near_duplicates(frame)


def test_sketches_bound_the_difference():
    random.seed(3)
    for _ in range(200):
        a = {random.getrandbits(64) for _ in range(random.randint(1, 400))}
        b = {x for x in a if random.random() < 0.9} | {random.getrandbits(64) for _ in range(20)}
        one, two = (np.array(sorted(x), dtype=np.uint64) for x in (a, b))
        at = max(band_of(len(one)), band_of(len(two)))
        bits = int.from_bytes(sketch_bits(one, at)) ^ int.from_bytes(sketch_bits(two, at))
        assert bits.bit_count() <= len(a ^ b)


def test_linked_sets_always_share_a_feature():
    random.seed(4)
    common = np.zeros(parity_join.SLOTS, dtype=np.uint8)
    common[: parity_join.SLOTS // 2] = 9
    for _ in range(300):
        n = random.choice([1, 2, 3, 5, 15, 16, 40, 63, 64, 65, 255, 256, 300, 1000])
        shared = [random.getrandbits(64) for _ in range(n)]
        more = random.randint(0, n // 3)
        split = random.randint(0, more)
        a = np.array(sorted(shared + [random.getrandbits(64) for _ in range(split)]), dtype=np.uint64)
        b = np.array(sorted(shared + [random.getrandbits(64) for _ in range(more - split)]), dtype=np.uint64)
        assert 100 * n >= 75 * (n + more)
        one = {int(x) for part in features(a, common, 75) for x in part}
        two = {int(x) for part in features(b, common, 75) for x in part}
        assert one & two


def sketched(sets):
    """Sizes and sketches of sets as the tasks get them, and a plain comparison of two."""
    own = [sketch_bits(s, band_of(len(s))) for s in sets]
    above = [sketch_bits(s, band_of(len(s)) + 1) if parity_join.reaches_next(len(s), 75) else None for s in sets]
    size = [len(s) for s in sets]

    def close(x, y):
        x, y = (x, y) if size[x] <= size[y] else (y, x)
        mine = own[x] if band_of(size[x]) == band_of(size[y]) else above[x]
        if 4 * size[x] < 3 * size[y] or mine is None or band_of(size[y]) - band_of(size[x]) > 1:
            return False
        bits = (int.from_bytes(mine) ^ int.from_bytes(own[y])).bit_count()
        return bits <= 25 * (size[x] + size[y]) // 175

    return np.array(size), pa.array(own, pa.binary()), pa.array(above, pa.binary()), close


def changed_sets(rng, many, sizes):
    """Sets of which some are others with a share of their members replaced."""
    found = []
    for _ in range(many):
        if found and rng.random() < 0.7:
            new = found[rng.integers(len(found))].copy()
            at = rng.random(len(new)) < rng.choice([0, 0.05, 0.1, 0.15, 0.2])
            new[at] = rng.integers(0, 1 << 63, at.sum(), dtype=np.uint64)
            new = new[: max(1, int(len(new) * rng.choice([1, 0.95, 0.8])))]
        else:
            new = rng.integers(0, 1 << 63, rng.choice(sizes), dtype=np.uint64)
        found.append(np.unique(new))
    return found


def test_runs_compared_together_equal_pair_by_pair():
    rng = np.random.default_rng(3)
    sets = changed_sets(rng, 120, [1, 3, 4, 15, 17, 60, 64, 80, 250, 257, 1100])
    size, own, above, close = sketched(sets)
    rows, want = [], Counter()
    for part in range(200):
        members = rng.choice(120, rng.integers(2, 26), replace=False)
        if part % 3:
            i = j = 0
            block = np.zeros(len(members), int)
        else:
            i, j = 1, 2  # of two blocks, one may be empty
            block = np.sort(rng.integers(1, 3, len(members)))
        component = members % 7
        rows += [(part, i, j, b, k, c) for b, k, c in zip(block, members, component, strict=True)]
        for x, y in np.transpose(np.triu_indices(len(members), 1)):
            apart = component[x] != component[y] and (i == j or block[x] != block[y])
            if apart and close(members[x], members[y]):
                want[min(members[x], members[y]), max(members[x], members[y])] += 1
    column = dict(zip(("part", "i", "j", "block", "key", "component"), np.transpose(rows), strict=True))
    at = pa.array(column["key"])
    table = pa.table({**column, "n": size[column["key"]], "own": own.take(at), "above": above.take(at)})
    assert len(want) > 50
    for cut in (1, 7, 5000):
        got, seen = Counter(), []
        for runs in parity_join.whole_runs(table.to_batches(max_chunksize=cut)):
            seen += sorted({*runs["part"].to_pylist()})
            for pairs in parity_join.pairs_across(runs, 75):
                got.update(zip(*(c.to_pylist() for c in pairs.columns), strict=True))
        assert seen == list(range(200)) and got == want


def test_comparing_many_small_runs_takes_less_than_a_loop_over_their_pairs():
    """CPU time of a task; one run and one pair after the other took longer than the plain loop here."""
    rng = np.random.default_rng(4)
    sets = changed_sets(rng, 400, [300, 600, 900])
    size, own, above, close = sketched(sets)
    key = np.concatenate([rng.choice(400, 12, replace=False) for _ in range(500)])
    zero, at = np.zeros(len(key), int), pa.array(key)
    column = {"part": np.repeat(np.arange(500), 12), "i": zero, "j": zero, "block": zero, "key": key, "component": key}
    table = pa.table({**column, "n": size[key], "own": own.take(at), "above": above.take(at)})
    start = time.thread_time()
    found = sum(p.num_rows for runs in parity_join.whole_runs(table.to_batches(1000)) for p in parity_join.pairs_across(runs, 75))
    took = time.thread_time() - start
    start = time.thread_time()
    want = sum(close(*pair) for a in range(0, len(key), 12) for pair in itertools.combinations(key[a : a + 12].tolist(), 2))
    assert found == want and took < (time.thread_time() - start) / 2


def test_sets_of_a_batch_equal_those_of_each_text(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abc", k=rng.choice([0, 1, 4, 5, 6, 30]))) for _ in range(200)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(201)), pa.array(texts)], names=["key", "text"])
    for words in (1, 16, 1 << 16):
        monkeypatch.setattr(parity_join, "WORDS_A_CHUNK", words)
        for i, found in parity_join._sets(batch, 5):
            assert np.array_equal(found, shingle_set(column_words(pa.array([texts[i]], pa.string())).of(0), 5))


def test_components_of_chains_and_cycles(llm):
    pairs = [(i, i + 1) for i in range(10, 40)] + [(1, 3), (3, 2), (2, 1), (50, 41)]
    got = {r.node: r.component for r in components(llm.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(10, 41), 10), 1: 1, 2: 1, 3: 1, 50: 41, 41: 41}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def brute_removal(rows, span=50):
    seen, out = {}, {}
    for key, raw in rows:
        for i in range(len(raw) - span + 1):
            seen[raw[i : i + span]] = min(key, seen.get(raw[i : i + span], key))
    for key, raw in rows:
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if seen[raw[i : i + span]] < key:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[key] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_removal_equals_brute_force(documents):
    random.seed(5)
    letters = "abé日 "
    lines = ["".join(random.choices(letters, k=random.choice([30, 55, 80, 200]))) for _ in range(30)]
    texts = ["\n".join(random.choices(lines, k=random.randint(1, 6))) for _ in range(60)]
    texts += ["x" * 49, "x" * 49, "y" * 50, "y" * 51, "ab" * 400, "ab" * 30, None, "", texts[0]]
    ids = random.sample(range(-500, 500), len(texts))
    frame = documents(texts, ids).withColumn("kept", F.lit(1))
    rows = remove_repeats(frame).collect()
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows
    }
    assert got == brute_removal([(i, (x or "").encode()) for i, x in zip(ids, texts, strict=True)])
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert (r.kept_text is None) == (r.n_removed == 0)
        assert r.kept_text is None or r.kept_text == bytes(r.kept).decode("utf-8", "ignore")


def test_removal_with_equal_and_null_keys(documents):
    text = "the same words again and again in all of these texts, more than fifty bytes"
    rows = remove_repeats(documents([text] * 4, ids=[7, 7, None, 9])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == [
        ("7", 0), ("7", 0), ("9", len(text)), ("None", 0)
    ]
    assert remove_repeats(documents([])).count() == 0


def test_texts_under_one_key_lose_their_own_repeats(documents):
    random.seed(8)
    first, second, other = ("".join(random.choices("abcdefgh ", k=n)) for n in (120, 60, 102))
    frame = documents([first, "x" * 9 + first[20:100], other, second + other[:70], None], ids=[1, 2, 2, 3, 2])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(frame).collect())
    assert got == [(1, 120, 0), (2, 0, 0), (2, 89, 80), (2, 102, 0), (3, 130, 70)]


def test_a_lead_that_all_texts_hold_and_small_batches(documents, monkeypatch):
    random.seed(9)
    monkeypatch.setattr(suffix_dedup, "HELD_ROWS", 7)
    parts = ["".join(random.choices("abc", k=40)) for _ in range(6)]
    texts = [
        random.choice(parts) + " " * random.choice([16, 40, 70]) + "\n" * 20 + random.choice(parts)
        for _ in range(150)
    ]
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in remove_repeats(documents(texts)).collect()
    }
    assert got == brute_removal([(i, x.encode()) for i, x in enumerate(texts, 1)])


def test_other_spans(documents):
    random.seed(10)
    texts = ["".join(random.choices(["abcdefgh", "0123456789", "xy", "z"], k=30)) for _ in range(40)]
    for span in (20, 33, 64):
        want = brute_removal([(i, x.encode()) for i, x in enumerate(texts, 1)], span)
        rows = remove_repeats(documents(texts), span=span).collect()
        assert {r.doc_id: r.n_removed for r in rows} == {k: v[1] for k, v in want.items()}


def test_a_key_that_is_no_integer_is_refused(documents):
    with pytest.raises(ValueError, match="integer"):
        remove_repeats(documents(["a"]).withColumn("doc_id", F.lit("a")))


def test_multikey_order_and_merged():
    random.seed(6)
    one = np.array(random.choices([3, 1, 2**63, 7], k=200), dtype=np.uint64)
    two = np.array([random.getrandbits(3) for _ in one], dtype=np.uint64)
    order = multikey_order(one, two)
    assert [(one[i], two[i]) for i in order] == sorted(zip(one, two, strict=True))
    starts, ends = merged(np.array([5, 0, 9, 3]), np.array([6, 2, 12, 5]))
    assert (starts.tolist(), ends.tolist()) == ([0, 3, 9], [2, 6, 12])


def test_texts_are_cut_a_few_at_a_time():
    random.seed(15)
    sizes = [random.choice([0, 10, 50_000, 400_000]) for _ in range(60)]
    batch = pa.record_batch({"doc_id": range(60), "text": [None if n == 10 else "x" * n for n in sizes]})
    parts = list(suffix_dedup.few_bytes([batch, batch.slice(7)], 1))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch, batch.slice(7)]))
    for part in parts:
        held = [len(x.as_py() or "") for x in part.column("text")]
        assert sum(held) <= suffix_dedup.HELD_BYTES or len([n for n in held if n]) == 1


def test_texts_that_share_leading_bytes_only_go_no_further(documents, monkeypatch):
    random.seed(16)
    words = ["".join(random.choices("abcdef", k=9)) for _ in range(40)]
    texts = [" ".join(random.choices(words, k=200)) for _ in range(60)]
    texts.append(texts[7][300:420] + " end")
    rows, written = [], suffix_dedup.written

    def counted(table):
        rows.append((back := written(table)).count())
        return back

    monkeypatch.setattr(suffix_dedup, "written", counted)
    got = {r.doc_id: r.n_removed for r in remove_repeats(documents(texts)).collect()}
    want = brute_removal([(i, x.encode()) for i, x in enumerate(texts, 1)])
    assert got == {key: row[1] for key, row in want.items()} and got[61] >= 120
    assert max(rows) < 1_000  # 4,726 stretches share their leading 16 bytes with another text


def a_group(seed: int) -> suffix_dedup.Group:
    random.seed(seed)
    texts = ["".join(random.choices("abé ", k=random.choice([0, 30, 50, 300, 900]))).encode() for _ in range(40)]
    places = np.cumsum([0, *map(len, texts)])
    keys = np.array(random.sample(range(-500, 500), len(texts)))
    return suffix_dedup.Group(keys, keys * 7, places, np.frombuffer(b"".join(texts), np.uint8))


def test_bytes_of_stretches_come_back_from_what_texts_keep():
    group = a_group(17)
    found = suffix_dedup.Stretches(group.body, group.places, 50)
    keep = np.flatnonzero(np.random.default_rng(1).random(len(found.start)) < 0.6)
    rows = suffix_dedup.around(group, found, keep)
    ones = rows.column("one").to_pylist()
    rows = pa.table(rows).append_column("own", pa.array(ones)).append_column("plural", pa.array([x[:1] for x in ones]))
    for part in (rows, rows.slice(5)):
        batch = part.combine_chunks().to_batches()[0]
        got = suffix_dedup.own_stretches(batch).to_pylist()
        want = set()
        for text in np.unique(found.owner[keep]).tolist()[len(rows) - len(part) :]:
            mine = keep[found.owner[keep] == text]
            for i, one, two in zip(mine, *found.digests(mine), strict=True):
                raw = group.body[found.start[i] : found.end[i]].tobytes()
                want.add((one, two, raw, found.place[i] - found.start[i], group.keys[text]))
        assert {(r["one"], r["two"], r["stretch"], r["at"], r["low"]) for r in got} == want
        assert sum(r["high"] > r["low"] for r in got) == len(part)


def test_stretches_of_a_group_that_was_never_compared_all_go_on():
    group = a_group(18)
    found = suffix_dedup.Stretches(group.body, group.places, 50)
    n, kind = len(found.leads()[0]), pa.list_(pa.struct([("bucket", pa.int32()), ("flags", pa.binary())]))

    def passed(*told):
        rows = [{"bucket": b, "flags": x} for b, x in told]
        return suffix_dedup.told_stretches(found, pa.scalar(rows or None, kind)).tolist()

    assert passed() == passed((0, b"\0")) == list(range(len(found.start)))
    assert passed((3, b"\0" * (n - 9)), (1, b"\0" * 9)) == []
    at, of = found.anchors()
    first = bytes(group.body[at[np.lexsort(found.tokens(at)[::-1])[0]] :][:33])
    holds = {of[k] for k in range(len(at)) if bytes(group.body[at[k] :][:33]) == first}
    assert passed((3, b"\0" * (n - 9)), (1, b"\1" + b"\0" * 8)) == sorted(holds)
    assert suffix_dedup.Group(group.keys, group.marks, group.places, group.body).name() == group.name()
    assert suffix_dedup.Group(group.keys + 1, group.marks, group.places, group.body).name() != group.name()


def test_leads_travel_as_they_are():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 2**64, 50, dtype=np.uint64)
    two = rng.integers(0, 2**64, 50, dtype=np.uint64) & ~np.uint64((2 << suffix_dedup.FREE_BITS) - 1)
    several = rng.random(50) < 0.5
    records = suffix_dedup.lead_records(one, two, several)
    for got, want in zip(suffix_dedup.read_leads(records.reshape(-1)), (one, two, several), strict=True):
        assert got.tolist() == want.tolist()
