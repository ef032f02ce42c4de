import math
import zlib
from collections import Counter

import numpy as np

from tallyframe.llm.langid import KneserNey, characters, gram_counts, language_ids, model_of, op2_language_id, pieces


def normal(text, order=4):
    out = []
    for ch in text.lower():
        if ch.isalpha():
            out.append(ch)
        elif out and out[-1] != " ":
            out.append(" ")
    return ["\0"] * (order - 1) + out


class Plain:
    """Interpolated Kneser-Ney by the book, one language."""

    def __init__(self, texts, alphabet, order=4):
        self.order, self.v = order, alphabet
        self.c = [None] * (order + 1)
        self.c[order] = Counter(tuple(n[i:i + order]) for t in texts for n in [normal(t, order)] for i in range(len(n) - order + 1))
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in {g[-k - 1:] for g in self.c[order]})
        self.d = [0] + [self.discount(c) for c in self.c[1:]]

    @staticmethod
    def discount(c):
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        return one / (one + 2 * two) if one and one + 2 * two else 0.5

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.v + 1)
        below = {g: n for g, n in self.c[k].items() if g[:-1] == gram[:-1]}
        total = sum(below.values())
        if not total:
            return self.p(gram[1:])
        return max(self.c[k][gram] - self.d[k], 0) / total + self.d[k] * len(below) / total * self.p(gram[1:])


TEXTS = {"xx": ["the cat sat. The hat", "a cat!", "that"], "yy": ["été là, où", "le été", "là là"]}


def test_model_matches_definition():
    table = {l: (lambda g: (g[0], np.array(g[1])))(gram_counts(t)) for l, t in TEXTS.items()}
    model = KneserNey(table)
    alphabet = len({n[i] for t in TEXTS.values() for x in t for n in [normal(x)] for i in range(3, len(n))})
    samples = ["the cat", "été", "zzz là q", "Où? a", "A"]
    got, letters = model.entropies(samples + ["", "12 3", None])
    assert list(letters[-3:]) == [0, 0, 0]
    for c, lang in enumerate(model.languages):
        plain = Plain(TEXTS[lang], alphabet)
        for s, h in zip(samples, got[:, c]):
            n = normal(s)
            want = -sum(math.log(plain.p(tuple(n[i:i + 4]))) for i in range(len(n) - 3)) / (len(n) - 3)
            assert abs(h - want) < 1e-4, (lang, s)


def test_counts_and_pieces():
    grams, n = gram_counts(["abab ab", "ab"])
    want = Counter(tuple(x[i:i + 4]) for t in ("abab ab", "ab") for x in [normal(t)] for i in range(len(x) - 3))
    assert {tuple(g): c for g, c in zip(grams, n)} == want
    cut = list(pieces(["abcdefgh", None, "ij"], 3))
    assert sum(len(p) for _, ps in cut for p in ps) == 10 and {j for o, _ in cut for j in o} == {0, 1, 2}
    codes, starts, letters = characters(["A1", "", "é"])
    assert list(letters) == [1, 0, 1] and "".join(map(chr, codes)) == "\0\0\0a \0\0\0\0\0\0é" and list(starts) == [0, 5, 8, 12]


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "12 !!", 2.0), (3, "the cat", 2.0), (3, "the cat", 2.0), (None, "été là", 2.0), (4, "", 2.0)], "doc_id long, text string, score double")
    rows = [(l, t, p) for p in (0, 1) for l, ts in TEXTS.items() for t in ts] + [(None, "x", 0), ("xx", None, 0), ("zz", "lonely", 1)]
    training = spark.createDataFrame(rows, "lang string, text string, part int")
    got = sorted((str(r.doc_id), r.lang_pred, r.score > 0.5) for r in language_ids(docs, training).collect())
    assert got == [("1", "und", False), ("2", "und", False), ("3", "xx", True), ("3", "xx", True), ("4", "und", False), ("None", "yy", True)]
    assert {r.lang_pred for r in language_ids(docs, training.limit(0)).collect()} == {"und"}
    assert language_ids(docs.limit(0), training).count() == 0


def test_blocks_give_the_whole_model(spark):
    table = {l: (lambda g: (g[0], np.array(g[1])))(gram_counts(t)) for l, t in TEXTS.items()}
    rows = [(l, g, int(n)) for l, (grams, counts) in table.items() for g, n in zip(grams, counts)]
    samples = ["the cat", "été", "zzz là q", "Où? a", "A", "", None, "ж жж the"]
    want = KneserNey(table).entropies(samples)
    for limits in ({}, {"block_grams": 20}, {"block_grams": 1, "block_languages": 1}):
        got = model_of(spark.createDataFrame(rows, "lang string, gram string, n long"), **limits).entropies(samples)
        assert np.allclose(got[0], want[0], atol=1e-4) and list(got[1]) == list(want[1])


def test_many_languages_keep_their_rare_grams(spark):
    """200 languages of 5,500 4-grams each."""
    letter = lambda d: f"char(97 + int(code / {26 ** d}) % 26)"
    made = spark.range(200 * 5500).selectExpr("concat('l', id % 200) AS lang", "int(id / 200) AS x", "(int(id / 200) * 31 + (id % 200) * 977) % 456976 AS code")
    counts = made.selectExpr("lang", f"concat({', '.join(map(letter, range(3, -1, -1)))}) AS gram", "1L + x % 3 AS n")
    model, samples = model_of(counts), ["the cat sat", "qqqq zebra", "été"]
    got, _ = model.entropies(samples)
    for lang in ("l0", "l137"):
        rows = counts.where(f"lang = '{lang}'").collect()
        want, _ = KneserNey({lang: ([r.gram for r in rows], np.array([r.n for r in rows]))}).entropies(samples)
        assert np.allclose(got[:, model.languages.index(lang)], want[:, 0], atol=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op2_language_id(spark, folder).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_of_any_number_of_letters():
    """More different letters than fit a key of four; counts equal those of a plain dictionary."""
    from collections import Counter

    from tallyframe.llm.langid import characters, gram_counts
    wide = "".join(chr(c) for c in range(0x32400) if chr(c).isalpha())
    texts = [wide, "ab ab", wide[:50], ""]
    assert len(set(wide.lower())) > 65_536
    want = Counter()
    for t in texts:
        codes = characters([t])[0].tolist()
        want.update("".join(map(chr, codes[i:i + 4])) for i in range(len(codes) - 3) if codes[i + 3])
    grams, n = gram_counts(texts)
    assert dict(zip(grams, n)) == want
