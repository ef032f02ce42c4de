import random
import zlib
from collections import Counter, defaultdict

from tallyframe.llm.sharding import OP12_SQL, longest_first, op12_sharding, shard_table, with_shard, write_shards
from tests.oracle import compare, connect

SCHEMA = "doc_id long, text string, Digest string, shard string, item string, slot long, bundle string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", 5, "d") for r in rows], SCHEMA)


def check(rows, got):
    """Contract of every result; returns the bytes of each shard."""
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((i, size(t), zlib.crc32((t or "").encode()), "bytes", None) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == want
    slots, crcs, loads = defaultdict(list), defaultdict(set), Counter({s: 0 for s in range(24)})
    for r in got:
        slots[r.shard].append(r.slot)
        crcs[r.text_crc32, r.size].add(r.shard)
        loads[r.shard] += r.size
    assert set(loads) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in crcs.values())
    return loads


def test_query_matches_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare("op12", op12_sharding(spark, folder), connect(folder), OP12_SQL) is None


def test_exact_schedule_and_balance(spark):
    """Against a plain list of loads over all groups."""
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    loads = check(rows, op12_sharding(spark, folder).collect())
    sizes = Counter()
    for _, t in rows:
        sizes[t or ""] += len((t or "").encode()) + 8
    plain = [0] * 24
    for s in sorted(sizes.values(), reverse=True):
        plain[plain.index(min(plain))] += s
    assert max(loads.values()) - min(loads.values()) <= max(max(plain) - min(plain), 8 + sum(loads.values()) // (24 * 2048))


def test_heap_takes_the_least_loaded():
    items = [(f"i{n}", s) for n, s in enumerate([5, 9, 9, 1, 3, 7, 2, 2])]
    assert dict(longest_first(items, 3)) == {"i1": 0, "i2": 1, "i5": 2, "i0": 2, "i4": 0, "i6": 1, "i7": 1, "i3": 0}


def test_many_small_groups_and_a_hot_one(spark):
    """Bundles, a third of all rows with one text, repeated rows past the run length, several buckets."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abcé ", k=rng.randrange(40)))) for i in range(6000)]
    rows += [(i, "hot text") for i in range(9000, 9900)] + [(7, "same row")] * 2100 + [(None, None)] * 30 + [(None, "")] * 3
    docs = table(spark, rows)
    got = shard_table(docs, share=8, bucket_rows=20).collect()
    loads = check(rows, got)
    big = sorted(loads.values())[-2:]  # the two hot texts
    rest = [v for v in loads.values() if v not in big]
    assert max(rest) - min(rest) <= sum(loads.values()) / (24 * 8) * 2
    again = shard_table(docs.repartition(5), share=8, bucket_rows=7).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_tables(spark):
    rows = [(1, None), (1, ""), (None, "x"), (None, "x"), (2, "long " * 300_000)]
    got = shard_table(table(spark, rows)).collect()
    assert sorted((r.size, r.shard) for r in got)[:2] == [(8, got_shard) for got_shard in {r.shard for r in got if r.size == 8}] * 2
    assert sorted(r.slot for r in got if r.size == 9) == [0, 1]
    assert shard_table(table(spark, rows).limit(0)).count() == 0


def test_whole_rows(spark, tmp_path):
    rows = [(i, f"text {i % 50} " * (i % 9)) for i in range(300)]
    docs = table(spark, rows)
    out = with_shard(docs)
    assert out.columns == ["doc_id", "text", "Digest", "item", "slot", "bundle", "shard"]
    want = {r.doc_id: r.shard for r in shard_table(docs).collect()}
    assert {r.doc_id: r.shard for r in out.collect()} == want
    write_shards(docs.drop("shard"), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert {(r.doc_id, r.text, r.shard) for r in back} == {(i, t, want[i]) for i, t in rows}
