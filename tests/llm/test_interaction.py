import random
import re
from collections import defaultdict
from itertools import permutations

import pyarrow as pa

from tallyframe.llm import interaction
from tallyframe.llm.interaction import OP13_SQL, RadixTrie, common, failed_alone, heavy_prefixes, interaction_audit, op13_filter_audit, range_of
from tests.oracle import compare, connect

DOCS = "doc_id long, text string, lang string, part string, mask int, place string, body string"
LABELS = "doc_id long, quality int, toxic int, n long"


def four(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t))]


def plain(docs, labels):
    """Brute force, order by order and document by document."""
    least, marks = {}, defaultdict(lambda: [0, 0])
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, q, x in labels:
        if i is not None:
            marks[i] = [max(marks[i][0], int(q == 1)), max(marks[i][1], int(x == 1))]
    rows = [(lang or "", four(t or "") + [i is not None and i > least[t or ""]], *(marks[i] if i in marks else (0, 0))) for i, t, lang in docs]
    out = {}
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], [0] * 5
        for order in permutations(range(5)):
            for step, f in enumerate(order):
                before = order[:step]
                ok = [r for r in mine if not any(r[1][g] for g in before)]
                gone = [r for r in ok if r[1][f]]
                total[f] += len(gone)
                out[part, "".join("ABCDE"[g] for g in order), step + 1] = [
                    len(ok) - len(gone), len(gone), sum(r[1][f] for r in mine) - len(gone), sum(r[1][f] and sum(r[1]) == 1 for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total["ABCDE".index(order[step - 1])])
    return out


def told(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def tables(spark, docs, labels):
    return (spark.createDataFrame([(*r, "x", 9, "y", "z") for r in docs], DOCS), spark.createDataFrame([(*r, 3) for r in labels], LABELS))


def test_query_matches_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare("op13", op13_filter_audit(spark, folder), connect(folder), OP13_SQL) is None


def corpus(rng):
    head = "Shared licence header. " * 30
    texts = ["", None, "A B", "a # b", head, head + "x", head * 2, " ".join(f"w{i}" for i in range(150)), "é" * 300, "LOUD " * 200]
    texts += [head + "".join(rng.choices("abé ", k=rng.randrange(60))) for _ in range(40)] + [" ".join(rng.choices("abcdefgh", k=rng.randrange(300))) for _ in range(40)]
    docs = [(rng.choice([None, *range(400)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(900)]
    docs += [(7, "hot text", "en")] * 200 + [(i, "hot text", "fr") for i in range(300)] + [(None, "hot text", "en")] * 50
    labels = [(rng.choice([None, *range(500)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(300)]
    return docs, labels


def test_against_brute_force(spark, monkeypatch):
    """Copies in many blocks, shared heads, repeated rows, null ids, repeated labels; any layout gives the same rows."""
    rng = random.Random(6)
    docs, labels = corpus(rng)
    want = plain(docs, labels)
    d, l = tables(spark, docs, labels)
    assert told(interaction_audit(d, l)) == want
    assert told(interaction_audit(d.repartition(7), l, range_bytes=300)) == want
    monkeypatch.setattr(interaction, "HELD_CHARS", 10)
    assert told(interaction_audit(d.orderBy("text").coalesce(2), l, range_bytes=5000)) == want


def test_odd_tables(spark):
    docs = [(1, "long " * 400_000, None), (2, "long " * 400_000, None), (2, None, "en"), (3, "", "en"), (None, "", "en"), (3, "", "en")]
    d, l = tables(spark, docs, [(2, 1, 1), (2, 1, None), (None, 1, 1)])
    assert told(interaction_audit(d, l)) == plain(docs, [(2, 1, 1), (2, 1, None), (None, 1, 1)])
    assert told(interaction_audit(d, l.limit(0))) == plain(docs, []) and interaction_audit(d.limit(0), l).count() == 0


def test_ranges_follow_the_text(spark):
    """A head shared by much text is lengthened as far as it takes, copies of one text are not, and equal texts share their range."""
    head = "boilerplate " * 20
    texts = [head + f"{i:03d} " + "z" * 50 for i in range(200)] + ["copy " * 300] * 500 + ["short"]
    docs, _ = tables(spark, [(i, t, "en") for i, t in enumerate(texts)], [(0, 0, 0)])
    heavy = heavy_prefixes(docs, range_bytes=6000)
    assert {head[:n] for n in (2, 4, 8, 16, 32, 64, 128)} <= {p for s in heavy.values() for p in s} and 2048 not in heavy
    weights = defaultdict(set)
    for t in texts:
        weights[range_of(t, heavy)].add(t)
    assert all(sum(map(len, w)) <= 6000 for w in weights.values() if len(w) > 1)
    assert max(len(p) for p in weights) <= 256 and heavy_prefixes(docs) == {}


def test_trie_tells_whole_texts_apart():
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab", k=rng.randrange(9))) for _ in range(600)] + ["", "é", "éa", "🙂", "🙂🙂"]
    trie, least, late = RadixTrie(), {}, []
    for t in texts:
        k = rng.randrange(100)
        least[t] = min(k, least.get(t, k))
        late += [(t, *row) for row in trie.insert(t)[0].meet(k, "en", 0, 1)]
    ends = {id(trie.insert(t)[0]): t for t in set(texts)}
    assert len(ends) == len(set(texts)) and all(trie.insert(t)[1] == 0 for t in texts)
    open_ids = {ends[id(n)]: n.least for n in trie.terminals()}
    assert open_ids == least and all(k > least[t] and mask == 16 for t, k, _, mask, n in late)
    assert sum(row[-1] for row in late) + sum(sum(n.rows.values()) for n in trie.terminals()) == len(texts)


def test_common_part():
    for a, b, at in [("abc", "xabd", 1), ("", "abc", 0), ("abc", "abc", 0), ("abc", "ab", 0), ("b", "abc", 0)]:
        n = 0
        while n < min(len(a), len(b) - at) and a[n] == b[at + n]:
            n += 1
        assert common(a, b, at) == n


def test_text_filters():
    rng = random.Random(9)
    texts = [None, "", " \t", "#", "ÀÉ" * 40, "aB", "x" * 9 + "A", "x" * 10 + "A "] + ["".join(rng.choices("aAbé \n\x0b\x85&", weights=[9, 1, 9, 3, 20, 1, 1, 1, .01], k=rng.randrange(900))) for _ in range(200)]
    texts += [" ".join(map(str, rng.choices(range(k), k=n))) for n in (99, 100, 101) for k in (40, 90, 400)]
    for array in (pa.array(texts), pa.array(["pad", *texts]).slice(1)):
        got = failed_alone(array)
        assert [[bool(m >> b & 1) for b in range(4)] for m in got] == [four(t or "") for t in texts]
    assert len(failed_alone(pa.array([], pa.string()))) == 0
