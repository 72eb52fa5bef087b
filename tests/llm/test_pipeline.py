"""The registered text queries, their SQL, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from folia.llm.common import read

from .conftest import ODD, WORD  # noqa: F401
from .test_operators import check_packing, plain_classes, plain_lines, sha, shingles, weighted  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


def test_all_are_registered():
    names = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in contract.queries()


def test_line_dedup_equals_its_sql(sent):
    df = contract.queries()["op3_line_dedup"](sent, str(DATA))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = connection.execute(contract.oracle_sql()["op3_line_dedup"]).df()
    order = sorted(want.columns)
    assert sorted(map(tuple, df.toPandas()[order].values.tolist())) == sorted(map(tuple, want[order].values.tolist()))


def test_stages(sent):
    docs, frames = read(sent, str(DATA), "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(sent, docs, str(DATA)).cache()
        frames.append(docs)
    base = read(sent, str(DATA), "documents")
    assert all(f.columns == base.columns for f in frames[:-1])
    texts = [{r.doc_id: r.text for r in f.collect()} for f in [base, *frames[:-1]]]
    toxic = {r.doc_id for r in read(sent, str(DATA), "labels").filter("toxic = 0").collect()}
    assert len(toxic - texts[1].keys()) <= 0.05 * len(toxic)
    want = plain_lines(list(texts[1].items()))
    assert [(i, h) for i, _, _, h in want] == sorted(((i, sha(x or "")) for i, x in texts[2].items()), key=repr)
    classes = plain_classes(sorted(texts[2].items()))
    assert texts[3].keys() == {i for i, c in classes.items() if i == c}
    items = [WORD.findall(r.text) for r in read(sent, str(DATA), "benchmark").collect()]
    leaking = set()
    for i, x in texts[3].items():
        words = WORD.findall(x or "")
        grams = set(shingles(x))
        for own in items:
            if grams & set(shingles(" ".join(own))):
                best = max(weighted(shingles(" ".join(words[p : p + len(own)])), shingles(" ".join(own))) for p in range(max(1, len(words) - len(own) + 1)))
                if best >= 0.8:
                    leaking.add(i)
    assert texts[4].keys() == texts[3].keys() - leaking
    check_packing(frames[4].collect(), list(texts[4].items()))


def test_stages_on_odd_and_empty_tables(sent, odd, empty):
    """Each stage on its own: extra columns with the operators' own names, null and empty texts,
    null ids, repeated rows, and no rows at all."""
    rows = [(i, x, "src", "lang", 7, "a", "b", i, k) for k, (i, x) in enumerate(ODD)]
    schema = "doc_id long, text string, source string, lang string, n_chars long, drop_low string, drop_high string, _drop_id long, _kept_id long"
    docs = sent.createDataFrame(rows, schema).repartition(3)
    texts = {i: x for i, x in ODD}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(sent, docs, str(DATA))
        assert out.columns == docs.columns
        kept[name] = out.collect()
        assert stage(sent, docs.limit(0), str(DATA)).count() == 0
    assert len(kept["toxicity"]) == len(kept["line_dedup"]) == len(kept["benchmark_decontamination"]) == len(ODD)
    assert all(r["drop_low"] == "a" and r["drop_high"] == "b" and r["_drop_id"] == r["doc_id"] for rows in kept.values() for r in rows)
    assert {r.doc_id: r.text for r in kept["toxicity"]} == texts
    near = sorted((r.doc_id if r.doc_id is not None else -1, r["_kept_id"]) for r in kept["minhash_near_dedup"])
    assert [i for i, _ in near] == [-1, 1, 2, 4, 6, 7, 8, 9, 10]
    check_packing(corpus_pipeline.pack_sequences(sent, docs, str(DATA)).collect(), ODD)
    assert corpus_pipeline.pack_sequences(sent, docs.limit(0), str(DATA)).count() == 0
