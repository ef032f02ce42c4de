import hashlib
import random
import re

from tallyframe.llm.pii import KINDS, personal_data, redacted, train

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    None, "", "a@b.c", "a@b@c.d.e.", "x a.b@c-d.ef@g.hi", "a@b.c_x@d.e", "@a.b", "é🙂 me@x.yz 🙂 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111  1111 11111111", "1 2 3 4 5 6 7 8 9 0 1 2 3", "+1 (743) 555-3824.", "+1+1 23456789 0", "+49 (0) 30 123456-78 x",
    "0001.002.3.4", "1.2.3", "call 743-555-3824 now", "mail joe (at) example (dot) com please", "fe80:0:0:0:1:2:3:4 host", "9" * 3000, "a" * 5000 + "@", "1-" * 4000, "+" + "1 " * 3000,
    "4111111111111111 4111111111111111", "5500 0000 0000 0004x", "\x01\x02 5@6.7 \x01",
]


def made():
    rng = random.Random(6)
    bits = ["a@b.c", "@", ".", "+", "1", "12", " ", "-", "4111111111111111", "10.0.0.255", "é", "🙂", "(", ")", "\n", "x", "+1 555 123 4567", "256.1.1.1", "_"]
    return HARD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(400)]


def test_base_spans_match_definition(spark):
    texts = made()
    got = personal_data(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (texts[r.doc_id], line, r.spans)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w[0] == k for w in want) for k in KINDS]
        spans = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        assert {tuple(s) for s in spans} >= {(k, str(a), str(b)) for k, a, b in want}
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), int(s[1])))


def test_em_finds_the_unreliable_labeler():
    rng, counts = random.Random(1), {}
    for _ in range(20000):
        y, kind = rng.random() < 0.6, rng.randrange(4)
        votes = [(1 if (rng.random() < a) == y else -1) for a in (0.95, 0.9, 0.85, 0.5)]
        counts[(kind, *votes)] = counts.get((kind, *votes), 0) + 1
    model = train(sorted((*k, n) for k, n in counts.items()))
    for name, a in zip(("regex", "gazetteer", "context", "shape"), (0.95, 0.9, 0.85, 0.5)):
        assert abs(model.reliability[name] - a) < 0.04
    assert model.weights[0] > model.weights[2] > abs(model.weights[3])
    assert train([]).weights == train([]).weights


def test_redaction(spark):
    rows = [(1, "🙂 write me@x.com, or +1 (743) 555-3824!", "a@b.cd"), (2, None, None), (3, "clean 12 text", "s"), (4, "4111 1111 1111 1111", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = redacted(df)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "🙂 write [EMAIL], or [PHONE]!", 2: None, 3: "clean 12 text", 4: "[CARD]"}
    assert redacted(df.limit(0)).count() == 0 and personal_data(df.limit(0)).count() == 0


def test_added_spans(spark):
    texts = ["call me: phone 743-555-3824 today"] * 30 + ["mail joe (at) example (dot) com"] * 30 + ["real@mail.com"] * 200 + ["+1 743 555 3824"] * 200 + ["order no 1234 5678 9012 3456x"] * 30
    got = {r.doc_id: r for r in personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].spans == "phone:15:27" and got[30].spans == "email:5:31" and got[0].n_phone == 0 and got[len(texts) - 1].spans == ""


def test_all_test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in plain(r.text)).encode()).hexdigest() for r in df.collect()}
    assert {r.doc_id: r.base_sha256 for r in personal_data(df).collect()} == want
