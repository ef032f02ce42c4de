import random

import pyarrow as pa
import pytest

from tallyframe.llm.decontaminate import BenchmarkIndex, allowed_edits, benchmark_matches, clean_documents, lower, nearest_run
from tallyframe.llm.wordblocks import NOT_ALNUM, WordBlock


def distance(item, words):
    """Brute force: smallest edit distance of ``item`` to any run of ``words``."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in words:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != w), row[i] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = f"e{rng.randrange(999)}"
        elif kind == 1:
            words.insert(at, rng.choice(words))
        else:
            del words[at]
    return words


def made(seed=5, n_items=40):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and"] * 30 + [f"w{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(14, 59))] for _ in range(n_items)]
    docs, planted = [], []
    for k in range(400):
        o = rng.randrange(n_items)
        d = allowed_edits(len(items[o]))
        n = k % (d + 3)
        before = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        docs.append(before + edited(rng, items[o], n) + [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))])
        planted.append((o, n))
    return items, docs


def test_nearest_run():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        words = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        edits, a, b = nearest_run(item, words)
        assert edits == distance(item, words)
        if edits < len(item):
            assert nearest_run(item, words[a:b])[0] == edits


def test_recall_and_precision_against_brute_force():
    items, docs = made()
    index = BenchmarkIndex([(i, " ".join(w)) for i, w in enumerate(items)])
    text = WordBlock(lower(pa.array([" ".join(d) for d in docs])), NOT_ALNUM)
    got = {(j, index.items[o][0]): e for j, o, e, _, _ in index.matches(text)}
    want = {(j, i): distance(x, d) for j, d in enumerate(docs) for i, x in enumerate(items)}
    want = {k: e for k, e in want.items() if e <= allowed_edits(len(items[k[1]]))}
    assert len(want) > 250 and set(got) <= set(want)
    assert all(got[k] >= want[k] for k in got)
    near = [k for k in want if want[k] <= allowed_edits(len(items[k[1]])) / 2]
    assert sum(k in got for k in near) / len(near) > 0.99
    assert len(got) / len(want) > 0.95


@pytest.mark.parametrize("size", [15, 30, 60, 100, 150, 300, 500])
def test_recall_at_the_edit_limit(size):
    """Copies with as many edits as allowed, items of every length."""
    rng = random.Random(size)
    vocabulary = ["the", "of", "and"] * 60 + [f"w{i}" for i in range(800)]
    items = [[rng.choice(vocabulary) for _ in range(size)] for _ in range(20)]
    index = BenchmarkIndex([(i, " ".join(w)) for i, w in enumerate(items)])
    planted = [(k % 20, edited(rng, items[k % 20], allowed_edits(size))) for k in range(80)]
    texts = [" ".join([rng.choice(vocabulary) for _ in range(30)] + w + [rng.choice(vocabulary) for _ in range(30)]) for _, w in planted]
    found = {(j, index.items[o][0]) for j, o, *_ in index.matches(WordBlock(lower(pa.array(texts)), NOT_ALNUM))}
    assert min(index.recall.values()) >= 0.95
    assert sum((j, o) in found for j, (o, _) in enumerate(planted)) / len(planted) >= 0.95


def test_scripts_and_typography():
    """Ideographs are words, and quotes, dashes and spaces of any kind are none."""
    items = [(1, "敏捷的棕色狐狸跳过了那只懒惰的狗然后它在河边的大树下面安静地睡着了直到第二天早上才醒来"), (2, "\u201cIt\u2019s a long\u2014long way\u201d, said the old sailor\u00a0to his friend, \u2013 \u201cfrom here to the sea\u201d."), (3, "नमस्ते दुनिया यह एक परीक्षण वाक्य है")]
    index = BenchmarkIndex(items)
    texts = ["abc " + items[0][1] + " def", items[0][1][:20] + "很" + items[0][1][20:], "\"It's a long-long way\", said the old sailor to his friend, - \"from here to the sea\".", items[2][1], "nothing like it", None]
    got = {(j, index.items[o][0], e) for j, o, e, *_ in index.matches(WordBlock(lower(pa.array(texts)), NOT_ALNUM))}
    assert got == {(0, 1, 0), (1, 1, 1), (2, 2, 0), (3, 3, 0)}


def test_tables(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron."
    rows = [(1, "x y z " + item + " tail", 0), (2, item.upper().replace(" ", "!! "), 0), (3, "nothing here at all", 0), (4, None, 0), (5, "", 0), (None, item, 0), (1, "x y z " + item + " tail", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(9, item, "a"), (9, item, "a"), (8, None, "a"), (7, "too short", "a"), (6, "", "a")], "item_id long, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.edits, r.first_word, r.n_words) for r in benchmark_matches(docs, bench).collect()), key=str)
    assert got == [(1, 9, 0, 3, 15), (2, 9, 0, 0, 15), (None, 9, 0, 0, 15)]
    stay = clean_documents(docs, bench)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == [3, 4, 5]
    assert benchmark_matches(docs.limit(0), bench).count() == 0
    assert benchmark_matches(docs, bench.limit(0)).count() == 0 and clean_documents(docs, bench.limit(0)).count() == 7
