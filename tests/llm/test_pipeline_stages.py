"""The stages against brute force, each on what the one before kept."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import corpus, documents
from test_dedup import _neardup
from test_search_and_mix import _contaminated, _mixed
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from trustlens.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of the three tables, with planted toxic and leaked passages."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [r for r in corpus(9, 40) if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    letters = lambda i: "abcdefghij"[i // 10 % 10] + "klmnopqrst"[i % 10]
    toxic = [(20_000 + i, f"you idiot you moron said {letters(i)} and went on for {letters(i + 7)} more") for i in range(60)]
    clean = [(30_000 + i, f"a quiet note of {letters(i)} that went on for {letters(i + 3)} more") for i in range(90)]
    leaks = [(40_000 + i, f"before it {letters(i)} stood item {letters(i)} which question asks for six numbered answers after") for i in range(3)]
    rows += toxic + clean + leaks
    docs = documents(spark, [(i, t, "en", f"s{i % 3}") for i, t in rows])
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 0, 1) for i, _ in toxic] + [(i, 0, 0) for i, _ in clean]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    bench = [(i, f"item {letters(i)} which question asks for six numbered answers") for i in range(3)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {i for i, _ in toxic}, {i for i, _ in leaks}, bench


def test_every_stage_does_its_work(spark, tables):
    path, toxic, leaks, bench = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, path)
        if name != "token_ids":
            assert out.columns == columns
            target = f"{path}/{name}"
            out.write.parquet(target)
            out = spark.read.parquet(target)
        after = [r for r in out.collect()]
        ids = Counter(r.doc_id for r in after)
        if name == "toxicity":
            scored = toxicity.score_toxicity(docs, spark.read.parquet(f"{path}/labels.parquet")).collect()
            assert ids == Counter(r.doc_id for r in scored if r.score < 0.5)
            assert not toxic & set(ids) and leaks <= set(ids)
        elif name == "near_duplicates":
            assert ids == Counter(i for i, _, _, kept in _neardup(before, 75) if kept)
        elif name == "decontamination":
            assert ids == Counter(i for i, *_, bad in _contaminated(before, bench) if not bad)
            assert not leaks & set(ids)
        elif name == "mixing":
            rows = [(r.doc_id, r.text, None, r.source) for r in docs.collect()]
            assert ids == +Counter({r[0]: m[-1] for r, m in zip(rows, _mixed(rows))})
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
            expected = Counter()
            for i, text in before:
                ids_ = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
                expected[i, len(ids_), zlib.crc32(np.array(ids_, "<u4").tobytes())] += 1
            assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == expected
            assert max(r.start + r.n_tokens for r in after) == sum(r.n_tokens for r in after)
        kept[name], docs = set(ids), out


def test_the_registered_pipeline_runs_all_stages(spark):
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 100


def test_an_empty_corpus_goes_through(spark, tables):
    path, *_ = tables
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0, name


def test_all_operators_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
