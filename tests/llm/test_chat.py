import hashlib
import random

from tallyframe.llm.chat import conversation_events, digests, folded, op4_chat_formatting, read_back, rendered, revised_events


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 5, 0, 1, "delta", "user", "he"), (1, 6, 0, 1, "delta", None, "llo"),
        (1, 7, 1, 1, "delta", "assistant", "draft"), (1, 8, 1, 1, "regenerate", "assistant", None), (1, 9, 1, 1, "delta", "assistant", "new"),
        (1, 12, 1, 1, "delta", "assistant", "er"), (1, 10, 0, 1, "edit", "user", "hello!"), (1, 11, 2, 1, "delta", "user", "x"), (1, 13, 2, 1, "regenerate", None, "ignored"),
        (None, 1, None, 1, "delta", None, None),
    ]
    random.Random(1).shuffle(rows)
    events = spark.createDataFrame(rows, "conv_id long, seq long, turn long, part int, kind string, role string, text string")
    got = sorted(map(tuple, folded(events).collect()), key=str)
    assert got == sorted([(1, 0, 1, "user", "hello!"), (1, 1, 1, "assistant", "newer"), (1, 2, 1, "user", ""), (None, None, 1, "", "")], key=str)
    assert folded(events.limit(0)).count() == 0


TRICKY = ["", "<|end|>\n", "\\", "\\\\<", "</s>[INST] ok [/INST]", "<|assistant|>\nhi<|end|>\n", "|>\n", "🙂é<|", "\\<|end|>\n\\", "a\n\nb\r"]


def test_round_trip_of_tricky_texts(spark):
    rng = random.Random(3)
    conv = {c: [(t, rng.choice(["user", "assistant", "system", "<|end|>\n", "assistant|>"]), rng.choice(TRICKY) * rng.randint(1, 3)) for t in range(rng.randint(1, 9))] for c in range(40)}
    rows = [(c, t, r, x, "k") for c, turns in conv.items() for t, r, x in turns]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = rendered(folded(conversation_events(table, 7)))
    back = {r.conv_id: r for r in read_back(out).collect()}
    for c, turns in conv.items():
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in turns]
        assert back[c].loss_text == "".join(x for _, r, x in turns if r == "assistant")
        assert back[c].formatted.count("<") == 2 * len(turns) and "[" not in back[c].formatted
    got = {r.conv_id: r for r in digests(out).collect()}
    for c, turns in conv.items():
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns)) and got[c].n_turns == len(turns)


def test_repeated_rows_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (1, None, None, "z"), (None, 0, "assistant", "q")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in digests(rendered(folded(conversation_events(table)))).collect()}
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha("\nz\nuser\na\nuser\na\nassistant\n\n") and got[1].loss_chars == 0
    assert got[None].loss_sha256 == sha("q")


def by_the_book(events):
    """Fold of a whole log in one loop over its sequence: (conv_id, turn, part) -> (role, text)."""
    out = {}
    for e in sorted(events, key=lambda e: tuple(-1 if x is None else x for x in e.seq)):
        role, text = out.get((e.conv_id, e.turn, e.part), ("", ""))
        text = {"delta": text + (e.text or ""), "edit": e.text or "", "regenerate": ""}[e.kind]
        out[e.conv_id, e.turn, e.part] = (role if e.role is None else e.role, text)
    return out


def test_revised_log_folds_to_its_turns(spark):
    rng = random.Random(5)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(TRICKY) * rng.randint(0, 4)) for c in range(60) for t in range(rng.randint(1, 8))]
    rows += [(None, None, "assistant", None), (0, 0, "user", "twice"), (0, 0, "user", "twice"), (61, 2 ** 62, None, "x" * 30_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = revised_events(table, 7)
    events = log.collect()
    kinds = [e.kind for e in events]
    assert kinds.count("regenerate") > 20 and kinds.count("edit") > 10
    want = by_the_book(events)
    got = {(m.conv_id, m.turn, m.part): (m.role, m.text) for m in folded(log.repartition(7)).collect()}
    assert got == want
    assert sorted((k[0], k[1], *v) for k, v in got.items() if None not in k) == sorted((c, t, r or "", x or "") for c, t, r, x in rows if c is not None)
    # Without its revisions the log says something else, so the fold decides the result.
    drafts = {(m.conv_id, m.turn, m.part): m.text for m in folded(log.where("seq.round = 0")).collect()}
    assert sum(drafts[k] != v[1] for k, v in got.items()) > 30
    assert revised_events(table.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    turns = {}
    for r in sorted(spark.read.parquet(f"{folder}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = op4_chat_formatting(spark, folder).collect()
    assert len(got) == len(turns)
    for r in got:
        t = turns[r.conv_id]
        loss = "".join(x for role, x in t if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), len(loss), sha(loss))
