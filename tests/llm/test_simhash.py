import random
import re
from itertools import combinations

import xxhash

from tallyframe.llm.graph import components
from tallyframe.llm.simhash import close_pairs, covering_masks, fingerprint, one_of_each, simhash_components


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """Brute force: id -> smallest id reachable."""
    ids = sorted(fps)
    root = {i: i for i in ids}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    texts = ["", " \t\n", "One", "one TWO", "É a\x0bb c", " ".join(rng.choice("aAbc") * 3 for _ in range(900))]
    for t in texts:
        assert fingerprint(t.encode()) % (1 << 64) == plain(t)


def test_masks_cover_every_pair_of_bits():
    for a, b in combinations(range(64), 2):
        assert any(not (m >> a & 1 or m >> b & 1) for m in (x % (1 << 64) for x in covering_masks()))


def test_links_in_small_and_large_buckets(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(63) for _ in range(40)]
    fps = {s ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for s in seeds for _ in range(8)}
    fps |= {seeds[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)}
    want = classes({f: f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for small in (2, 32):
        got = {f: f for f in fps} | {r.node: r.root for r in components(close_pairs(df, small=small)).collect()}
        assert got == want


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 3), (7, 3), (3, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)}


def test_documents(spark):
    base = "the quick brown fox jumps over the lazy dog near the river bank today " * 20
    rows = [(5, base, "x"), (3, base + "extra", "x"), (9, None, "x"), (8, "  ", "x"), (None, base, "x"), (7, "short one", "x"), (7, "short one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    fps = {i: plain(t) for i, t in enumerate(r[1] for r in rows)}
    got = simhash_components(df).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.fingerprint) for r in got) == sorted((r[0] is None, r[0], f"{plain(r[1]):016x}") for r in rows)
    linked = (fps[0] ^ fps[1]).bit_count() <= 2
    assert {r.component_id for r in got if r.doc_id in (5, None)} == {3 if linked else 5}
    assert {r.component_id for r in got if r.doc_id in (8, 9)} == {8}
    assert simhash_components(df.limit(0)).count() == 0
    stays = one_of_each(df)
    assert stays.columns == df.columns
    assert sorted(r.doc_id for r in stays.collect()) == ([3, 7, 8] if linked else [3, 5, 7, 8])
    lonely = df.unionByName(spark.createDataFrame([(None, "all alone in here", "x"), (None, "all alone in here", "y")], df.schema))
    assert [r.text for r in one_of_each(lonely).where("doc_id is null").collect()] == ["all alone in here"]
    assert one_of_each(df.limit(0)).count() == 0


def test_kept_row_does_not_depend_on_partitions(spark):
    rows = [(1, f"text number {i} of one id", None, f"{i % 3}", {"k": i}) for i in range(20)] + [(None, "no id at all", "a", f"{i}", None) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _root string, _fp string, m map<string,int>")
    got = {tuple(sorted(((r.text, r._root, r._fp) for r in one_of_each(df.repartition(n, "_fp", "text")).collect()))) for n in (1, 3, 8)}
    assert len(got) == 1 and len(next(iter(got))) == 2


def test_all_test_documents_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = classes({r.doc_id: plain(r.text) for r in df.collect()})
    assert {r.doc_id: r.component_id for r in simhash_components(df).collect()} == want
