"""Hashed words, token ids, packing and counts by section against plain Python."""

from __future__ import annotations

import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citelake.llm.packing import decompose, piece_lengths
from citelake.llm.token_ids import encode_column, encoder
from citelake.llm.token_spans import attribute, count_by_section, joined_fields, line_sections, with_sections
from citelake.llm.words import FACTOR, column_words, shingle_set

ODD = ["", None, "a  b", "a   b", " x", "x ", "a \n b\n\n  c", "é ü  b", "日本 語", "a\n \nb", "　 a", "I'll 12 3a"]
FILES = {
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_ids(text: str | None) -> list[int]:
    tool = Tokenizer.from_file(FILES["tokenizer"])
    tool.encode_special_tokens = True
    return tool.encode(text or "", add_special_tokens=False).ids


def split(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t日 .'0", max_size=30)), max_size=8))
def test_words(texts):
    found = column_words(pa.array(texts, pa.string()))
    words = [split(x) for x in texts]
    assert np.diff(found.places).tolist() == [len(w) for w in words]
    names = [w for ws in words for w in ws]
    assert len(set(found.hashes.tolist())) == len(set(names))
    assert len({*zip(names, found.hashes.tolist(), strict=True)}) == len(set(names))


def test_words_of_sliced_and_long_columns():
    texts = ["x " * 5, "long word " * 200_000, None, "end"]
    column = pa.array(["skip", *texts], pa.string()).slice(1)
    found = column_words(column)
    assert np.diff(found.places).tolist() == [5, 400_000, 0, 1]
    assert len(set(found.hashes.tolist())) == 4


def test_shingles_of_short_texts():
    words = column_words(pa.array(["a b c", "a b", "", "a b c d e f a b c d e"]))
    assert [len(shingle_set(words.of(i), 5)) for i in range(4)] == [1, 1, 0, 6]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é日\n\t .,'1　\x1c", max_size=24), max_size=6))
def test_ids_equal_the_library(texts):
    tool = encoder(*FILES.values())
    for _, _, _, _, ids, counts in encode_column(tool, pa.array(texts, pa.string())):
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [plain_ids(x) for x in texts]


def test_piece_lengths():
    sizes, many = piece_lengths(np.array([1, 1024, 1023, 2049, 5]), 1024)
    assert many.tolist() == [1, 1, 10, 3, 2]
    assert sizes[:2].tolist() == [1, 1024] and sizes[-2:].tolist() == [4, 1]


def test_packing_round_trip(documents):
    texts = [*ODD, "word and more " * 900]
    frame = documents(texts).withColumn("length", F.lit("clash"))
    rows = decompose(frame, **FILES).collect()
    for number, text in enumerate(texts, 1):
        own = sorted((r for r in rows if r.doc_id == number), key=lambda r: r.start)
        ids = plain_ids(text) + [0]
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in own] == [sum(r.length for r in own[:i]) for i in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(ids)}
    assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0 for r in rows)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert zlib.crc32(bytes(rows[0].ids)) == decompose(frame, **FILES).select(F.crc32("ids")).first()[0]


def test_packing_of_nothing_and_bad_names(documents):
    assert decompose(documents([]), **FILES).count() == 0
    with pytest.raises(ValueError):
        decompose(documents([]), **FILES, length=1000)
    with pytest.raises(ValueError):
        decompose(documents([]).withColumnRenamed("doc_id", "length"), **FILES, key="length")


def brute_counts(text: str) -> dict[str, int]:
    ends, at = [], 0
    for line in text.split("\n"):
        at += len(line.encode()) + 1
        ends.append(at)
    ends[-1] -= 1
    found, place = {f"line {i}": 0 for i in range(len(ends))}, 0
    for token in Tokenizer.from_file(FILES["tokenizer"]).encode(text, add_special_tokens=False).tokens:
        a, b = place, place + len(token)
        place = b
        held = [min(b, e) - max(a, s) for s, e in zip([0, *ends], ends, strict=False)]
        found[f"line {held.index(max(held))}"] += 1
    return found


def test_counts_by_line(documents):
    texts = ["one\ntwo three\n\n\nfour é\n", "", "日本\n語 語", "\n\n\n\n a", "no break at all"]
    rows = count_by_section(documents(texts), **FILES, sections=line_sections(F.col("text"))).collect()
    for number, text in enumerate(texts, 1):
        got = {r.section: r.n_tokens for r in rows if r.doc_id == number}
        assert got == brute_counts(text)
        assert {r.doc_tokens for r in rows if r.doc_id == number} == {len(plain_ids(text))}
        assert sum(r.n_bytes for r in rows if r.doc_id == number) == len(text.encode())


def test_counts_of_given_spans_and_fields(llm, documents):
    frame = documents(["abc def ghi jkl", None])
    spans = llm.createDataFrame([(1, "left", 0, 3), (1, "right", 8, 15)], "doc_id long, name string, start long, end long")
    rows = count_by_section(with_sections(frame, spans), **FILES, sections=F.col("sections")).collect()
    counts = {r.section: r.n_tokens for r in rows}
    assert set(counts) == {"left", "right", None} and sum(counts.values()) == len(plain_ids("abc def ghi jkl"))
    text, sections = joined_fields({"lang": F.col("lang"), "text": F.col("text")})
    rows = count_by_section(frame.withColumn("all", text), **FILES, text="all", sections=sections).collect()
    assert sum(r.n_tokens for r in rows if r.doc_id == 1) == len(plain_ids("en\nabc def ghi jkl"))
    assert count_by_section(documents([]), **FILES).count() == 0


def test_split_rule_shares_out_by_bytes():
    start, end = np.array([0, 3]), np.array([3, 8])
    counts, outside = attribute(np.array([0, 2]), np.array([2, 6]), start, end, True)
    assert counts.tolist() == [1.25, 0.75] and outside == 0
    counts, outside = attribute(np.array([0, 2]), np.array([2, 6]), start, end, False)
    assert counts.tolist() == [1, 1] and outside == 0
    counts, outside = attribute(np.array([0, 2]), np.array([2, 4]), start, end, False)
    assert counts.tolist() == [2, 0]  # the earlier one at a tie


def colliding_words(doublings: int) -> tuple[str, str]:
    """Two words of 2^doublings letters with one value of any polynomial modulo 2^64, from ten on."""
    one, two = "a", "b"
    for _ in range(doublings):
        one, two = one + two, two + one
    return one, two


@pytest.mark.parametrize("doublings", [10, 11])
@pytest.mark.parametrize("files", [FILES, {"tokenizer": FILES["tokenizer"]}])
def test_ids_of_words_built_to_collide(doublings, files):
    one, two = colliding_words(doublings)
    texts = [f"x {one} y", f"x {two} y", f"{two} {one}", f"{one} {two}", one, two]
    sums = [sum((ord(c) + 1) * pow(FACTOR, i, 1 << 64) for i, c in enumerate(word)) % (1 << 64) for word in (one, two)]
    assert sums[0] == sums[1]
    tool = encoder(*files.values())
    for again in range(2):
        found = []
        for _, _, _, _, ids, counts in encode_column(tool, pa.array(texts[again:] + texts[:again])):
            found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == [plain_ids(t) for t in texts[again:] + texts[:again]]


@pytest.mark.parametrize("doublings", [*range(1, 13)])
def test_words_built_to_collide_are_told_apart(doublings):
    one, two = colliding_words(doublings)
    assert len(set(column_words(pa.array([one, two])).hashes.tolist())) == 2


def test_equal_words_have_equal_hashes_wherever_they_stand():
    random.seed(14)
    made = {"".join(random.choices("aBé\0", k=random.randint(1, 140))).strip() or "x" for _ in range(4000)}
    made |= {"a" * n for n in range(1, 200)} | {"a" * n + "\0" for n in range(1, 200)}
    made = sorted({w.translate({i: i + 32 for i in range(65, 91)}) for w in made})
    hashes = column_words(pa.array(made)).hashes
    assert len(hashes) == len(made) == len(set(hashes.tolist()))
    texts = [" ".join(random.choices(made, k=50)) for _ in range(80)]
    at = dict(zip(made, hashes.tolist(), strict=True))
    found = column_words(pa.array([t.upper() if "é" not in t else t for t in texts]))
    for i, t in enumerate(texts):
        assert found.of(i).tolist() == [at[w] for w in t.split(" ")]


def test_ids_of_a_whole_table_are_those_of_the_tokenizer(llm):
    texts = [r.text for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    tool, whole = encoder(*FILES.values()), Tokenizer.from_file(FILES["tokenizer"])
    whole.encode_special_tokens = True
    expected = [x.ids for x in whole.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    flat, counts = zip(*[(ids, n) for *_, ids, n in encode_column(tool, pa.array(texts, pa.string()))], strict=True)
    assert np.concatenate(counts).tolist() == [len(x) for x in expected]
    assert np.array_equal(np.concatenate(flat), np.concatenate([np.array(x, np.uint32) for x in expected]))


def test_many_lines_take_time_in_proportion(documents):
    """A text of four times the lines may not take sixteen times as long."""
    seconds = {}
    for lines in (20_000, 80_000):
        frame = documents(["a\n" * lines])
        for _ in range(2):
            start = time.perf_counter()
            rows = count_by_section(frame, **FILES, sections=line_sections(F.col("text")))
            total = rows.agg(F.count("*"), F.sum("n_tokens"), F.sum("n_bytes"), F.max("doc_tokens")).first()
            seconds[lines] = time.perf_counter() - start
        assert tuple(total) == (lines + 1, total[3], 2 * lines, total[3])
    assert seconds[80_000] < 8 * seconds[20_000] + 2
