"""The pipeline against brute force, and odd inputs to its stages."""

import collections
import subprocess
import sys
from pathlib import Path

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from anchorline.llm import pieces, queries  # noqa: E402
from tests.llm.test_more import brute_targets  # noqa: E402
from tests.llm.test_repeats import brute_words  # noqa: E402
from tests.llm.test_simhash import brute_comp  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang, near, cuts, mix, last = (f for _, f in corpus_pipeline.STAGES)

    def through(f, df, name):
        f(spark, df, SF).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    a = through(lang, docs, "a")
    assert a.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in a.collect()} == {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    rows = [(r.doc_id, r.text) for r in a.collect()]
    b = through(near, a, "b")
    assert b.columns == docs.columns and sorted(r.doc_id for r in b.collect()) == sorted(i for i, _, c in brute_comp(rows) if i == c)
    c = through(cuts, b, "c")
    want = {i: (n, gone) for i, n, gone, _ in brute_words([(r.doc_id, r.text) for r in b.collect()])}
    assert c.columns == docs.columns
    for r in c.collect():
        assert len(r.text.encode().split()) == want[r.doc_id][0] - want[r.doc_id][1]
    d = through(mix, c, "d")
    sizes, got = collections.Counter(), collections.Counter()
    for r in c.collect():
        sizes[r.source] += len(r.text.encode().split())
    for r in d.collect():
        got[r.source] += len(r.text.encode().split())
    assert d.columns == docs.columns and all(abs(got[s] - t) <= 1 for s, t in brute_targets(sizes).items())
    e = through(last, d, "e")
    assert e.count() == d.count() and e.where("exact").count() == e.count() and e.where("n_ids <> size(ids)").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and "ids" in out.columns


def test_odd_inputs(spark):
    lang, near, cuts, mix, last = (f for _, f in corpus_pipeline.STAGES)
    long = "the and of was " * 20000
    rows = [(1, "the and of", "en", "s", None, 5), (1, "the and of", "en", "s", None, 5), (2, None, None, None, None, 6), (3, "", "en", "", 1, 7), (4, long, "en", "s", 2, None), (None, "was the with", "en", "s", 2, 1), (None, "another one here", "en", "s", 2, 1), (5, "12 34", "en", "s", 2, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")
    assert sorted(r.doc_id or 0 for r in lang(spark, df, SF).collect()) == [0, 0, 1, 1, 4]
    assert sorted(r.doc_id or 0 for r in near(spark, df, SF).collect()) == [0, 0, 1, 2, 4, 5]
    assert len(cuts(spark, df, SF).collect()) == len(rows) and cuts(spark, df, SF).schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert mix(spark, df, SF).count() >= 4
    assert last(spark, df, SF).count() == len(rows)
    for f in (lang, near, cuts, mix, last):
        assert f(spark, df.limit(0), SF).count() == 0


def test_one_id_with_different_texts(spark):
    near = corpus_pipeline.near_copies
    a, b = "the first text has words of its own", "nothing here is like that other one"
    odd = lambda rows: sorted((r.doc_id, r.text) for r in near(spark, spark.createDataFrame(rows, "doc_id long, text string, k int"), SF).collect())
    assert odd([(5, a, 1), (5, b, 2), (3, a, 3)]) == [(3, a), (5, b)]
    assert odd([(5, a, 1), (5, b, 2), (5, b, 3), (7, b, 4)]) == sorted([(5, a), (5, b)])


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(queries.ORACLE) <= set(queries.QUERIES) and pieces.MODEL and "anchorline.llm" in sys.modules


def test_mixing_starts_without_the_shuffles_of_substring_dedup(spark, tmp_path):
    cuts, mix = (f for _, f in corpus_pipeline.STAGES[2:4])
    held = lambda: set(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().keys().toSeq()))
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), held()
    cut = cuts(spark, docs, SF)
    cut.write.parquet(str(tmp_path / "cut"))
    rounds = held() - before
    assert len(rounds) >= 10
    mixed = mix(spark, spark.read.parquet(str(tmp_path / "cut")), SF)
    assert not rounds & held()
    assert mixed.count() > 0
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted((r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "cut")).collect())


WORKER = """
import re, sys
import pandas as pd
from anchorline.llm import _common, substring_dedup
pss = lambda: int(re.search(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) >> 10
texts = [" ".join(f"w{(i * 7919 + j * j) % 100003}" for j in range(400)).encode() for i in range(2000)]
def chunk():
    state = substring_dedup.condense(pd.DataFrame({"doc_id": range(len(texts)), "_null": False, "_text": texts}))
    substring_dedup.Words(state, 35, 8, {}, 2)
chunk()
held = pss()
_common.give_back()
print(held, pss())
"""


def test_workers_give_memory_back():
    out = subprocess.run([sys.executable, "-c", WORKER], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True).stdout
    held, left = map(int, out.split())
    assert left < held - 20, out
