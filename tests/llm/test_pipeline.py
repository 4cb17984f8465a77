"""Stages of the pipeline against plain Python on small tables; stages take what the last one kept."""

from __future__ import annotations

import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from citelake.llm.sieve import passes, sieve
from tests.llm.test_near_copies import shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(n):
    return " ".join("".join(random.choices("abcdefghij", k=6)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    random.seed(21)
    shared = words(30)
    whole = [words(60) for _ in range(8)]
    copies = [whole[0], whole[1] + " tail", "head " + whole[1]]
    passages = [f"{words(20)} {shared} {words(20)}" for _ in range(4)]
    return whole + copies + passages + [None, "", "short text"]


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "n-gram Jaccard join",
        "suffix-array dedup",
        "benchmark decontamination",
        "packing",
    ]


def test_near_copies_keep_one_of_each_group(llm, documents, texts):
    sets = {i: set(shingles(x)) for i, x in enumerate(texts, 1)}
    leader = {i: i for i in sets}

    def top(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                leader[high] = low
    kept = corpus_pipeline.near_copies(llm, documents(texts), "")
    assert kept.columns == COLUMNS
    got = {r.doc_id: r.text for r in kept.collect()}
    assert got == {i: texts[i - 1] for i in sets if top(i) == i}
    assert len(got) == len(texts) - 3


def test_repeated_passages_go_and_clean_documents_stay(llm, documents, texts):
    docs = documents(texts)
    cut = corpus_pipeline.repeated_passages(llm, docs, "")
    assert cut.columns == COLUMNS
    seen, want = set(), {}
    for i, x in enumerate(texts, 1):
        raw, gone = (x or "").encode(), set()
        found = [raw[k : k + 50] for k in range(len(raw) - 49)]
        for k, window in enumerate(found):
            if window in seen:
                gone.update(range(k, k + 50))
        seen.update(found)
        left = bytes(b for k, b in enumerate(raw) if k not in gone).decode()
        want[i] = (left if gone else x, len(left) if gone else (None if x is None else len(x)))
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == want
    assert sum(want[i][0] != texts[i - 1] for i in want) == 6


def test_packing_holds_every_token_once(llm, documents, texts):
    rows = corpus_pipeline.packing(llm, documents(texts), "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, x in enumerate(texts, 1):
        pieces = sorted((r.start, r.length) for r in rows if r.doc_id == i)
        ids = tokenizer.encode(x or "", add_special_tokens=False).ids
        assert [a for a, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) == len(ids) + 1


def test_later_stages_see_what_earlier_ones_kept(llm, documents, texts, monkeypatch, tmp_path):
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    given = []

    def stage(of):
        def wrapped(spark, docs, sf_dir):
            given.append({r.doc_id for r in docs.collect()})
            return of(spark, docs, sf_dir)

        return wrapped

    plain = [s for s in corpus_pipeline.STAGES if s[0] in ("n-gram Jaccard join", "suffix-array dedup", "packing")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, stage(of)) for name, of in plain])
    rows = corpus_pipeline.run(llm, str(tmp_path)).collect()
    assert len(given[0]) == len(texts) and len(given[1]) == len(texts) - 3
    assert given[1] == given[2] == {r.doc_id for r in rows}


@pytest.mark.parametrize("name", ["near_copies", "repeated_passages"])
def test_stages_leave_no_broadcast_files(llm, documents, texts, name):
    folder = llm.sparkContext._temp_dir  # where PySpark keeps the driver's copy of each broadcast
    docs = documents(texts)
    before = set(os.listdir(folder))
    rows = getattr(corpus_pipeline, name)(llm, docs, "").collect()
    assert len(rows) == len(texts) - (3 if name == "near_copies" else 0)
    left = {x: os.path.getsize(os.path.join(folder, x)) for x in set(os.listdir(folder)) - before}
    assert left == {}


def test_sieve_comes_in_as_many_jobs_whatever_the_partitions(llm):
    leads = llm.range(2_000).select(F.xxhash64("id").alias("lead"))
    context, jobs = llm.sparkContext, {}
    held = {k: llm.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (2, 9):
            llm.conf.set("spark.sql.shuffle.partitions", str(n))
            context.setJobGroup(f"sieve of {n}", "")
            bits = sieve(leads)
            jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"sieve of {n}"))
            hashes = np.array([r.lead for r in leads.collect()], dtype=np.int64).view(np.uint64)
            assert passes(bits, hashes).all() and not passes(bits, ~hashes).all()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
        for k, v in held.items():
            llm.conf.set(k, v)
    assert jobs[2] == jobs[9]
