from tallyframe.llm.warc import audit, op8_warc_fixity, OP8_SQL, record_digests
from tests.oracle import compare, connect

SCHEMA = "page_id long, url string, html string"


def test_audit_finds_exactly_the_damage(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(5000)]
    bad = [r for r in rows if r[0] != 70]
    bad[4500] = (*bad[4500][:2], "broken")
    bad += [rows[3], (9999, "u", "new")]
    a, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bad, SCHEMA)
    got = audit(a, b).collect()
    files = {r.file_id: r.status for r in got if r.level == "file"}
    assert files == {0: "changed", 1: "changed", 2: "extra"}
    assert {r.range_id for r in got if r.level == "range"} == {0, 1, bad[4500][0] // 64, 9999 // 64}
    records = {(r.page_id, r.status) for r in got if r.level == "record" and r.status != "moved"}
    changed = bad[4500][0]
    assert records == {(70, "missing"), (3, "copies"), (changed, "missing"), (changed, "extra"), (9999, "extra")}
    assert {r.page_id for r in got if r.status == "moved"} == {*range(4, 64), *range(71, 128), *range(changed + 1, (changed // 64 + 1) * 64)} - {p for p in range(5000, 5056)}
    assert all(r.status == "same" for r in audit(a, a).collect()) and audit(a.limit(0), a.limit(0)).count() == 0


def test_nulls_and_copies(spark):
    rows = [(None, None, None), (1, None, None), (1, None, None), (-5, "u", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", digest string")
    got = {r.page_id: r for r in record_digests(df).collect()}
    assert got[1].copies == 2 and got[None].file_id is None and got[-5].file_id == -1
    statuses = {(r.level, r.page_id, r.status) for r in audit(df, df.where("page_id > 0")).collect()}
    assert ("record", None, "missing") in statuses and ("record", -5, "missing") in statuses


def test_query_matches_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare("op8", op8_warc_fixity(spark, folder), connect(folder), OP8_SQL) is None
