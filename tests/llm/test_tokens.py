import public_tokenizers
import pytest

from tallyframe.llm.tokens import MODEL, Splicer, token_counts

PATH = public_tokenizers.path(MODEL)
SAMPLES = [
    "", " ", "   ", "a", "</s>[INST] ok [/INST]", "word " * 3000, "x" * 5000, " " * 5000, "▁a▁b " * 900,
    "é ü 🙂 \t\n" * 800, "no space but punctuation,," * 200, "a  b   c    d" * 400, "tail   " * 700,
]


@pytest.mark.parametrize("chunk,overlap", [(64, 4), (257, 16), (1024, 64)])
def test_spliced_counts_equal_whole_counts(chunk, overlap):
    splicer = Splicer(PATH, chunk, overlap)
    whole = splicer.model.encode(SAMPLES, num_threads=1)
    assert splicer.splits
    assert splicer.count_all(SAMPLES) == [len(ids) for ids in whole]
    assert splicer.widened > 0


def test_table_cases(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "two words", 5), (3, "dup", 5), (3, "dup", 5), (4, "word " * 9000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts(df)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    model = Splicer(PATH).model
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "", num_threads=1)), n > 4096) for i, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert want[-1][3]
    assert token_counts(df.limit(0)).count() == 0
