import hashlib
import random
import re

import numpy as np

from tallyframe.llm.substrings import repeated_starts, substring_dedup


def plain(docs, size):
    """Brute force over (doc_id, text)."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for a in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][a:a + size]), (i, a))
    out = {}
    for i, w in words.items():
        gone = set()
        for a in range(len(w) - size + 1):
            if first[tuple(w[a:a + size])] < (i, a):
                gone.update(range(a, a + size))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def made(seed, n):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    docs = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        docs.append((i * 3 - 20, rng.choice([" ", "\n", " \t "]).join(parts)))
    docs += [(1001, "a " * 300), (1002, "a " * 19), (1003, None), (1004, " \n"), (1005, docs[5][1]), (1006, docs[5][1])]
    rng.shuffle(docs)
    return docs


def test_small_tables_against_brute_force(spark):
    docs = made(3, 120)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string").repartition(3)
    for size in (20, 8):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df, size).collect()}
        assert got == plain(docs, size)


def test_edges(spark):
    text = " ".join(map(str, range(50)))
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (9, text)], "doc_id int, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup(df).collect())
    assert got == [(0, 0), (4, 0), (4, 0), (9, 50)]
    shown = substring_dedup(df, with_text=True).where("doc_id = 9 or doc_id is null").collect()
    assert {r.kept_text for r in shown} == {"", text}
    assert substring_dedup(df.limit(0)).count() == 0


def test_repeated_rows_are_one_place_in_any_partitioning(spark):
    text = " ".join(map(str, range(50)))
    df = spark.createDataFrame([(4, text), (9, text), (4, text)], "doc_id long, text string")
    for parts in (df.coalesce(1), df.repartition(3)):
        assert sorted((r.doc_id, r.n_removed) for r in substring_dedup(parts).collect()) == [(4, 0), (4, 0), (9, 50)]


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    from tallyframe.llm import substrings

    monkeypatch.setattr(substrings, "run_hashes", lambda v, n: np.zeros(len(v) - n + 1, np.uint64))
    doc, start = repeated_starts(b"a b c d\nb c d e\n", np.array([1, 2]), np.array([0, 0]), 3)
    assert list(zip(doc, start)) == [(2, 0)]


def test_all_test_documents_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in df.collect()], 20)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df).collect()} == want


def test_blocks_without_words():
    import pyarrow as pa

    from tallyframe.llm import wordblocks

    wordblocks._POWERS.clear()
    for texts in ([], [None], ["", " \n"]):
        block = wordblocks.WordBlock(pa.array(texts, pa.string()))
        assert len(block.hashes()) == 0 and list(block.n_words) == [0] * len(texts)
