"""The stages of the pipeline, each on what the one before kept."""

import __spark_entry__ as entry
import corpus_pipeline
from proofline.llm import decontaminate, jaccard_join, secrets, text


def test_stages(spark, sf):
    docs = text.table(spark, sf, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, text.materialized(stage(spark, docs, sf), name)
        seen[name] = (before, docs)
        if name != "pieces":
            assert docs.dtypes == before.dtypes
    before, after = seen["near_duplicates"]
    found = jaccard_join.jaccard_components(before)
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in found.collect()}
    before, after = seen["decontamination"]
    leaks = {r.doc_id for r in decontaminate.find_leaks(before, text.table(spark, sf, "benchmark")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - leaks
    before, after = seen["secrets"]
    assert before.count() == after.count() and secrets.find_secrets(after).where("n_assign + n_access + n_hex > 0").count() == 0
    before, after = seen["pieces"]
    assert {r.doc_id for r in before.collect()} == {r.doc_id for r in after.collect()}


def test_registered():
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {n if n == "pipeline" else n[: n.find("_") + 1] for n in entry.queries()}


def test_near_duplicates_keep_every_text(spark, sf):
    one, two, three = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(1, one, "x"), (5, one, "x"), (5, two, "x"), (8, two, "x"), (9, three, "z"), (9, three, "y"), (9, two, "x"), (None, one, "x"), (30, "", "x")]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), sf)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, one, "x"), (5, two, "x"), (9, three, "y"), (None, one, "x"), (30, "", "x")], key=str)


def test_stages_keep_clashing_columns_and_odd_rows(spark, sf):
    """Null and empty texts, null ids, repeated rows and a long text go through every stage; foreign columns stay as they are."""
    text.ship(spark)
    long = " ".join(f"w{k}" if k % 50 else f"token=abcdefgh{k:09d} {k:032x}" for k in range(20_000))
    rows = [(1, None, "x"), (2, "", "x"), (None, "no id here", "y"), (None, None, None), (3, "plain words of one text", None), (3, "plain words of one text", None), (4, long, "z")]
    names = ["_key", "_spans", "_s", "row", "first", "block", "_row", "_other", "_KEY_", "start"]
    docs = spark.createDataFrame([(*r, *(f"{n}{k}" for n in names)) for k, r in enumerate(rows)], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name
        got = kept.collect()
        assert {(r.doc_id, r.source) for r in got} == {(r[0], r[2]) for r in rows}, name
        assert all(r[n].startswith(n) and r[n][len(n) :].isdigit() for r in got for n in names), name
        assert stage(spark, docs.where("false"), sf).count() == 0, name
        clean = {r.doc_id: r.text for r in got}
        assert clean[1] is None and clean[2] == "" and (clean[4] == long) == (name != "secrets")
    assert "abcdefgh" not in clean[4] and clean[4].split()[:3] == ["[secret]", "[secret]", "w1"] and clean[4].endswith("w19999")
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()) == len(rows)


def test_classes_of_secrets(spark):
    value = "Zk3x9QpL2mVb7TnR5wYs8"
    docs = [(k, f"a {value}1 b", "one") for k in range(12)] + [(20, f"a {value}2 b", "one"), (21, f"a {value}2 b", "two"), (30, f"a {value}3 b", "one"), (31, f"a {value}3 b", "one")]
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert got[0].n_live == 0 and got[0].spans == "" and got[0].most_repositories == 12  # one owner, but copied widely
    assert got[20].n_shared == 1 and got[20].n_live == 0 and got[20].most_owners == 2
    assert got[30].n_live == 1 and got[30].spans == "live:2:24" and got[30].most_repositories == 2


def test_many_spans_of_one_text(spark):
    words = [f"{k:032x}" if k % 3 else f"é😀{k}" for k in range(6_000)]
    whole = " ".join(words)
    docs = spark.createDataFrame([(1, whole, "s")], "doc_id long, text string, source string")
    found = secrets.find_secrets(docs).first()
    at, want = 0, []
    for w in words:
        if len(w) == 32:
            want.append(f"hex:{at}:{at + 32}")
        at += len(w) + 1
    assert [s for s in found.spans.split(",") if s.startswith("hex")] == want
    assert secrets.redact(docs).first().text == " ".join("[secret]" if len(w) == 32 else w for w in words)
