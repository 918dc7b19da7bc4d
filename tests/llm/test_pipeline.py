import os

import pytest

import corpus_pipeline
from voxelflow.llm import bpe, common, decontam, secret_scan, simhash
from voxelflow.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_stages_in_turn(spark):
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        folder = common.shared_folder(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(folder)
        out = spark.read.parquet(folder)
        rows = out.collect()
        ids = [r.doc_id for r in rows]
        assert len(set(ids)) == len(ids) and set(ids) <= set(seen)
        if name != "bpe":
            assert out.columns == columns
        if name == "simhash":
            comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
            assert set(ids) == set(comp.values())
        if name == "decontamination":
            m = decontam.Matcher([(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()], 16, 48)
            assert set(ids) == {i for i, t in seen.items() if not m.find(t)}
        if name == "secrets":
            assert len(ids) == len(seen) and all("password=" not in r.text or "[SECRET]" in r.text for r in rows)
        if name == "bpe":
            c = bpe.codec(*[__import__("public_tokenizers").path("byte_bpe_multi_50k.tiktoken"), __import__("public_tokenizers").PATTERN])
            assert all(c.decode(r.ids).decode() == seen[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)
        else:
            seen = {r.doc_id: r.text for r in rows}
        docs = out
    assert secret_scan.KINDS[0] == "assign"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontamination", "secrets", "bpe"]


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    """Nulls, blanks, repeated and null ids, a long text, clashing names; and an empty table."""
    common.table(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = {c: __import__("pyspark.sql.functions", fromlist=["lit"]).lit(c) for c in ("_row", "row", "a", "b", "stays", "_new")}
    for df in (odd_docs, no_docs):
        docs = df.withColumns(extra)
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            folder = common.shared_folder(spark, f"test-odd-{name}")
            stage(spark, docs, str(tmp_path)).write.parquet(folder)
            out = spark.read.parquet(folder)
            assert out.count() <= n
            if name != "bpe":
                assert out.columns == columns
            if name == "simhash":
                # what quality kept of the odd rows: the long text, the text without id, one of the four equal ones
                assert out.count() == len({r.text for r in docs.select("text").collect()})
            docs, n = out, out.count()


def test_kept_table_is_bounded():
    kept, made = common.Kept(10_000), []

    def make(k):
        made.append(k)
        return k + b"!"
    for i in range(1000):
        assert kept.look([b"%d" % i, b"0", b"%d" % i, b"x" * 50], make, 40) == [b"%d!" % i, b"0!", b"%d!" % i, b"x" * 50 + b"!"]
        assert len(kept.young) + len(kept.old) < 150
    assert made.count(b"0") == 1 and made.count(b"999") == 1 and made.count(b"x" * 50) == 1000
    kept.clear()
    assert not kept.young and not kept.old


def test_another_operator_frees_what_a_worker_keeps(monkeypatch):
    freed = []
    monkeypatch.setattr(common, "_kept", {})
    common._enter("a", lambda: freed.append("a"))
    common._enter("a", lambda: freed.append("a"))
    assert freed == []
    common._enter("", None)
    assert freed == ["a"] and common._kept == {}


def test_run_leaves_only_the_last_folder(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.exists(base) else set()
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) >= {"doc_id", "n_tokens", "ids"} and 0 < out.count() < common.table(spark, SF, "documents").count()
    new = [f for f in set(os.listdir(base)) - before if f.startswith("pipeline-")]
    assert len(new) == 1 and new[0].startswith("pipeline-bpe-")
