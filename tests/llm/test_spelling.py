"""Letter runs, near words and spelling groups against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import citelake.llm.letter_runs as letter_runs_module
from citelake.llm.letter_runs import joined_checksums, run_counts
from citelake.llm.run_table import RunTable
from citelake.llm.spelling import group_spellings, near_words

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_counts(rows, least, every):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return dict(counts)


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, ratio=10):
    near = {a: [b for b in counts if is_near(a, b)] for a in counts}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= ratio * counts[a] else None

    def root(a):
        return a if form[a] is None else root(form[a])

    return {
        (a, form[a], root(a), n, len(near[a]), None if form[a] is None else counts[form[a]])
        for a, n in counts.items()
    }


def words_table(llm, counts):
    return llm.createDataFrame(list(counts.items()), "word string, n bigint")


def grouped(llm, counts, **more):
    rows = group_spellings(words_table(llm, counts).repartition(3), **more)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in rows.collect()]
    assert len(found) == len(set(found))
    return set(found)


TEXTS = [
    None,
    "",
    "  ...  123 _",
    "Straße straße STRASSEÀÿ ×÷ café-CafÉ naïveĀx 日本abc",
    "one two three " * 40,
    "x" * 30_000 + " " + "y" * 9 + "é" * 3000,
    "endÃ",
]


@pytest.mark.parametrize("least,every", [(1, None), (1, 2), (4, 3), (7, 31)])
def test_run_counts(llm, documents, least, every):
    keys = [1, 2, 3, None, 5, 6, 5]
    rows = documents(TEXTS * 3, keys * 3).repartition(2)
    found = {r.word: r.n for r in run_counts(rows, least=least, every=every).collect()}
    assert found == plain_counts(zip(keys * 3, TEXTS * 3, strict=True), least, every)


def test_run_counts_of_no_rows(llm, documents):
    assert run_counts(documents([])).collect() == []


def test_run_counts_handed_on_early(documents, monkeypatch):
    """What a task remembers is bounded; handing counts on early changes nothing."""
    rows = documents([f"alpha{'abcdefg'[i % 7]}beta gamma" for i in range(50)])
    whole = {tuple(r) for r in run_counts(rows, every=5).collect()}
    monkeypatch.setattr(letter_runs_module, "REMEMBERED", 2)
    assert {tuple(r) for r in run_counts(rows, every=5).collect()} == whole


@given(st.lists(st.tuples(st.binary(max_size=12), st.binary(min_size=1, max_size=80)), min_size=1, max_size=20))
def test_joined_checksums(pairs):
    before = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    own = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    sizes = np.array([len(b) for _, b in pairs])
    assert joined_checksums(before, sizes, own).tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_runs_of_one_hash_are_told_apart():
    table = RunTable()
    body = np.frombuffer(b"abcabdabcxabcdefghijabcdefghik", np.uint8)
    starts, sizes = np.array([0, 3, 6, 9, 10, 20]), np.array([3, 3, 3, 1, 10, 10])
    same = np.zeros(6, np.uint64)
    numbers = table.look_up(same, body, starts, sizes)
    assert numbers[0] == numbers[2] and len(set(numbers.tolist())) == 5
    assert table.bytes_of(numbers).tobytes() == b"abcabdabcxabcdefghijabcdefghik"


@settings(max_examples=6, deadline=None)
@given(
    st.dictionaries(
        st.text(alphabet="abé", min_size=1, max_size=9), st.sampled_from([1, 2, 9, 10, 20, 100, 1000]), max_size=40
    )
)
def test_groups_of_random_words(llm, counts):
    assert grouped(llm, counts) == plain_groups(counts)


def test_groups_in_blocks(llm):
    """A bucket of many words is compared tile by tile, with the same result."""
    random = np.random.default_rng(1)
    words = {"".join(random.choice(list("abc"), size=random.integers(4, 7))) for _ in range(250)}
    counts = {w: int(n) for w, n in zip(sorted(words), random.choice([2, 30, 400], size=len(words)), strict=True)}
    assert grouped(llm, counts, block=4) == plain_groups(counts)


def test_chains_ties_and_long_words(llm):
    long = "q" * 5000
    counts = {
        "spelling": 5000,
        "speling": 400,
        "spelng": 30,
        "splng": 2,  # a chain of three forms
        "letters": 3,
        "lettera": 50,
        "letterb": 50,  # a tie
        long: 100,
        long[:2500] + "z" + long[2500:]: 4,
        long[:-1]: 1,
        "\U0001f600bcd": 20,
        "\U0001f600bce": 2,  # beyond 16 bits
        "alone": 7,
    }
    found = grouped(llm, counts)
    assert found == plain_groups(counts)
    by_word = {r[0]: r for r in found}
    assert by_word["splng"][2] == "spelling" and by_word["letters"][1] == "lettera"


def test_groups_of_odd_tables(llm):
    assert grouped(llm, {}) == set()
    rows = llm.createDataFrame(
        [(None, 3, "a"), ("", 2, "b"), ("word", 1, "c"), ("ward", 10, "d")], "word string, n bigint, form string"
    )
    found = {tuple(r) for r in group_spellings(rows).collect()}
    assert found == {("word", "ward", "ward", 1, 1, 10), ("ward", None, "ward", 10, 1, None)}


def test_each_near_pair_once(llm):
    counts = dict.fromkeys(["aaaa", "aaaaa", "aaab", "aaba", "abaaa"], 5)
    found = sorted(r.word for r in near_words(words_table(llm, counts)).collect())
    assert found == sorted(a for a in counts for b in counts if is_near(a, b))


def test_query_on_given_table(llm):
    """Near words by the neighbours that each word could have."""
    rows = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = plain_counts([tuple(r) for r in rows.collect()], 7, 31)
    found = {r.word: r.n for r in run_counts(rows, least=7, every=31).collect()}
    assert found == counts
    often = {w: n for w, n in counts.items() if n >= 2}
    shorter = {}
    for w in often:
        for i in range(len(w)):
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in often}
    for key, group in shorter.items():
        for a in group:
            near[a] |= {b for b in group | ({key} & often.keys()) if is_near(a, b)}
            if key in often:
                near[key].add(a)
    got = {r[0]: r[4] for r in grouped(llm, often)}
    assert got == {w: len(others) for w, others in near.items()}


def test_padded_matrices():
    from citelake.llm.spelling import code_points

    left, right = code_points(pa.array(["ab", "é"]), 3)
    assert left.tolist() == [[97, 98, 0], [233, 0, 0]] and right.tolist() == [[0, 97, 98], [0, 0, 233]]
