"""Best-two-fit: token ids against the tokenizer, plans and packed rows against plain Python."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import citelake.llm.word_ids as word_ids
from citelake.llm.best_two_fit import best_pair, encode_pieces, pack, places, plan, sequences

FILE = public_tokenizers.path("word_bpe_49k.json")
TOOL = Tokenizer.from_file(FILE)
TOOL.encode_special_tokens = True
ODD = [
    None,
    "",
    " \t\n",
    "It's THE 'LL ''s 's't I'll",
    "\x1c a\x1cb \xa0x a\xa0b a\u0085b",
    "é ́e ﬁ Σας ΑΣ İ's ẞß",
    "<|startoftext|> <|endoftext|>x",
    "ªµº½×÷ 12² 日本 語",
    "a\x00b \x00 \x7f",
]


def ids(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    import pyarrow as pa

    tool, found = word_ids.WordEncoder(FILE), []
    for _, _, flat, counts in word_ids.encode_words(tool, pa.array(texts, pa.string())):
        found += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if len(counts) else []
    return found


def test_ids_of_odd_texts():
    every = "".join(chr(c) for c in range(0x20, 0x250))
    texts = [*ODD, every, *(f"a{c}b {c} 1{c}." for c in every)]
    assert encoded(texts) == [ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_ids_of_random_texts(texts):
    assert encoded(texts) == [ids(t) for t in texts]


def test_ids_of_colliding_runs(monkeypatch):
    """Runs are told apart by their bytes, whatever their hashes."""
    plain = word_ids.chunk_words

    def colliding(body, at):
        words = plain(body, at)
        words.hashes[:] = words.hashes % np.uint64(3)
        return words

    monkeypatch.setattr(word_ids, "chunk_words", colliding)
    texts = ["some words and words and more", "some others", "and MORE words"] * 3
    assert encoded(texts) == [ids(t) for t in texts]


def test_ids_after_forgetting(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 3)
    monkeypatch.setattr(word_ids, "GROUP_BYTES", 10)
    texts = ["one two three", "four five six", "one six seven"] * 2
    assert encoded(texts) == [ids(t) for t in texts]


def test_ids_of_given_table(llm):
    texts = [r.text for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert encoded(texts) == [ids(t) for t in texts]


@given(st.lists(st.integers(1, 12), max_size=12), st.integers(2, 24))
def test_best_pair(sizes, room):
    left = np.bincount(sizes, minlength=30)
    pairs = [(a, b) for i, a in enumerate(sizes) for j, b in enumerate(sizes) if i != j and a >= b and a + b <= room]
    expected = max(pairs, key=lambda p: (sum(p), p[0]), default=None)
    assert best_pair(left, room) == expected


def one_by_one(sizes, capacity):
    """The same rule, one sequence after another over a list of documents."""
    left, filled = Counter(sizes), []
    while +left:
        taken, gap = [], capacity
        for size in sorted(left, reverse=True):
            while left[size] and size <= gap:
                taken.append(size)
                left[size] -= 1
                gap -= size
        while gap:
            smallest = min(taken)
            pairs = [
                (a, b)
                for a in +left
                for b in +left
                if a >= b and (a != b or left[a] > 1) and smallest < a + b <= smallest + gap
            ]
            if not pairs:
                break
            pair = max(pairs, key=lambda p: (sum(p), p[0]))
            taken.remove(smallest)
            left[smallest] += 1
            for size in pair:
                left[size] -= 1
                taken.append(size)
            gap -= sum(pair) - smallest
        filled.append(tuple(sorted(taken)))
    return Counter(filled)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_plan_is_that_of_single_sequences(sizes):
    fillings = plan(np.bincount(sizes, minlength=21), 20)
    found = Counter()
    for f in fillings:
        found[tuple(sorted(s for s, m in zip(f.sizes, f.many, strict=True) for _ in range(m)))] += f.repeats
    assert found == one_by_one(sizes, 20)


def test_two_fit_beats_greedy():
    # greedy: 6+3, 5+4 is full, ...; the pair 2+2 in place of 3 fills the first sequence
    counts = np.bincount([6, 3, 2, 2], minlength=11)
    first = plan(counts, 10)[0]
    assert (first.sizes, first.many) == ([6, 2], [1, 2])


def test_places_name_each_rank_once():
    counts = np.bincount(np.random.default_rng(0).integers(1, 40, 3000), minlength=41)
    fillings = plan(counts, 40)
    table, used = places(fillings, 40), defaultdict(set)
    for size, rows in table.items():
        ends = [*rows[1:, 0], counts[size]]
        for (first, many, sequence, offset), end in zip(rows.tolist(), ends, strict=True):
            for rank in range(first, end):
                at = offset + (rank - first) % many * size
                cells = set(range(at, at + size))
                own = used[sequence + (rank - first) // many]
                assert not own & cells
                own |= cells
    assert all(cells == set(range(max(cells) + 1)) and max(cells) < 40 for cells in used.values())
    assert sum(map(len, used.values())) == sum(n * c for n, c in enumerate(counts))


def check(rows, texts, capacity):
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        filled[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for key, own in pieces.items():
        whole = np.array([*ids(texts[key]), 0], "<u4")
        own.sort(key=lambda r: r.start)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.length for r in own[:-1]] == [capacity] * (len(own) - 1)
        for r in own:
            assert bytes(r.ids) == whole[r.start : r.start + r.length].tobytes() and r.length > 0
        assert sum(r.length for r in own) == len(whole)
    for own in filled.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(filled), -(-total // capacity)


def test_pack(llm, documents):
    random = np.random.default_rng(5)
    texts = [" ".join(random.choice(["the", "of", "packing"], size=n)) for n in random.integers(0, 130, 120)]
    texts = dict(enumerate([*ODD, *texts]))
    rows = documents(list(texts.values()), texts.keys()).repartition(3)
    packed = pack(encode_pieces(rows, FILE, length=64), capacity=64)
    found = packed.collect()
    used, least = check(found, texts, 64)
    assert used <= least + 2
    whole = {r.sequence_id: r for r in sequences(packed).collect()}
    assert len(whole) == used
    for number, r in whole.items():
        own = sorted((x for x in found if x.sequence_id == number), key=lambda x: x.offset)
        assert bytes(r.ids) == b"".join(bytes(x.ids) for x in own) and r.length == len(r.ids) // 4


def test_pack_repeated_rows_and_null_keys(documents):
    rows = documents(["one two three"] * 4 + [None], [7, 7, None, None, None])
    found = pack(encode_pieces(rows, FILE)).collect()
    assert sorted((r.doc_id is None, r.length) for r in found) == [(False, 4)] * 2 + [(True, 1)] + [(True, 4)] * 2
    assert {r.sequence_id for r in found} == {0} and len({r.offset for r in found}) == 5


def test_pack_nothing_and_clashing_names(llm, documents):
    assert pack(encode_pieces(documents([]), FILE)).collect() == []
    rows = documents(["a"]).withColumn("offset", F.lit(1)).withColumn("piece", F.lit("x"))
    assert len(pack(encode_pieces(rows, FILE)).collect()) == 1  # the documents' other columns are left out
    with pytest.raises(ValueError):
        pack(encode_pieces(rows, FILE).withColumn("offset", F.lit(1)))
    with pytest.raises(ValueError):
        encode_pieces(rows, FILE, key="piece")


def test_query_on_given_table(llm):
    from citelake.llm.registered import QUERIES

    texts = {r.doc_id: r.text for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = QUERIES["op13_best_two_fit"](llm, "/root/testdata/sf0.001").collect()
    for r in found:
        whole = np.array([*ids(texts[r.doc_id]), 0], "<u4")
        assert r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
    total = sum(r.length for r in found)
    assert len({r.sequence_id for r in found}) <= -(-total // 2048) + 1
