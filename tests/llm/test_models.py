import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

from trustlens.llm import langid, toxicity

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0


# --- op 1 ---------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    found = {r.doc_id: r for r in langid.identify_languages(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(found) == set(truth)
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 for i, r in found.items())
    late = [i for i in truth if held(i)]
    assert np.mean([found[i].lang_pred == truth[i] for i in late]) > 0.97
    accepted = [i for i in late if found[i].accepted]
    assert len(accepted) > 0.5 * len(late)


def _language_rows():
    rows = []
    for i in range(60):
        rows.append((i, f"the thing and that one {i} with this", "en", "s"))
        rows.append((100 + i, f"der und die das ein {i} nicht auch", "de", "s"))
    return rows


def test_odd_texts_and_rows(spark):
    odd = [(500, None, None, "s"), (501, "", "en", "s"), (502, "12 34 -- !!", "de", "s"), (None, "the thing with that", "fr", None)]
    odd += [(503, "und nicht " * 30_000, None, None), (503, "und nicht " * 30_000, None, None), (504, "É", None, None)]
    got = langid.identify_languages(documents(spark, _language_rows() + odd)).collect()
    by = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 500}
    assert len(got) == 127
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (500, 501, 502))
    assert by[503].lang_pred == "de" and by[None].lang_pred == "en" and by[None].held_out  # fr is never learned
    assert by[504].lang_pred in ("en", "de")


def test_nothing_to_learn_from(spark):
    assert langid.identify_languages(documents(spark, [])).collect() == []
    got = langid.identify_languages(documents(spark, [(1, "some words")])).collect()
    assert [(r.lang_pred, r.score, r.accepted) for r in got] == [("und", 0.0, False)]


def test_subwords_stay_within_words_and_texts():
    counts = langid.subword_counts(pa.array(["ab cd", "ab", "cd", "", "AB\tcd!"]))
    assert counts[3].sum() == 0
    # a gap makes edges of both words, so the parts add up to the whole
    inside = langid.subword_counts(pa.array([" ab ", " cd "]))
    assert (langid.subword_counts(pa.array([" ab cd "]))[0] == inside.sum(0)).all()
    assert (counts[0] == langid.subword_counts(pa.array(["ab  cd"]))[0]).all()


def test_rejection_follows_the_calibration():
    rng = np.random.default_rng(0)
    # two languages of distinct rows, and labels that are noise on a third kind
    rows = []
    for i in range(400):
        k = i % 4
        at = np.sort(rng.choice(np.arange(1000 * k, 1000 * k + 1000), 30, replace=False)) if k < 2 else np.sort(rng.choice(np.arange(5000, 6000), 30, replace=False))
        rows.append((["en", "de", "en", "de"][k] if k < 2 else str(rng.choice(["en", "de"])), at, np.ones(30, np.uint32)))
    model = langid.fit(rows)
    assert 0.5 < model.reject_below < 1
    sure = np.zeros((1, langid.ROWS))
    sure[0, :1000] = 1
    assert model.scores(sure).max() > model.reject_below


# --- op 5 ---------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    # the smaller tables hold too few toxic documents for every term to recur
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in found.items())
    late = [i for i in truth if i in found and held(i)]
    clean = [found[i].score for i in late if not truth[i]]
    toxic = [found[i].score for i in late if truth[i]]
    # area under the curve; a few labelled documents hold no telling term at all
    assert np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean]) > 0.94
    assert np.mean([c >= 0.5 for c in clean]) < 0.01 and np.mean([t >= 0.5 for t in toxic]) > 0.9


def test_pairs_that_no_additive_model_tells(spark):
    # toxic only if both terms meet; each alone is clean
    rng = np.random.default_rng(1)
    texts, y = [], []
    for i in range(1200):
        a, b = i % 2, (i // 2) % 2
        words = [f"n{rng.integers(200)}" for _ in range(6)] + ["insult"] * a + ["group"] * b
        texts.append(" ".join(rng.permutation(words)))
        y.append(float(a and b))
    terms, first = toxicity.term_sets(pa.array(texts))
    machine = toxicity.fit([terms[x:z] for x, z in zip(first[:-1], first[1:])], np.array(y))
    s = machine.scores(pa.array(["n1 insult", "n1 group", "n1 insult group", "n1", "", None]))
    assert s[2] > 0.5 and max(s[0], s[1], s[3], s[4], s[5]) < 0.5 and s[4] == s[5]
    pair = machine.factors[machine.column_of[toxicity.term_sets(pa.array(["insult group"]))[0]]]
    assert pair[0] @ pair[1] > 0


def test_a_rare_pair_among_frequent_clean_terms():
    # one in forty toxic texts holds nothing but the pair; each of its terms
    # stands in one clean text of twenty
    rng = np.random.default_rng(4)
    texts, y = [], []
    for i in range(6000):
        words = [f"n{rng.integers(200)}" for _ in range(6)]
        if i < 2000:
            words += ["these", "vermin"] if i % 40 == 0 else ["moron"]
        else:
            words += ["these"] if i % 20 == 0 else ["vermin"] if i % 20 == 1 else []
        texts.append(" ".join(rng.permutation(words)))
        y.append(float(i < 2000))
    terms, first = toxicity.term_sets(pa.array(texts))
    machine = toxicity.fit([terms[x:z] for x, z in zip(first[:-1], first[1:])], np.array(y))
    s = machine.scores(pa.array(["n1 these vermin", "n1 these", "n1 vermin", "n1", "n1 moron"]))
    assert s[0] > 0.5 and s[4] > 0.5 and max(s[1:4]) < 0.5
    assert (machine.column_of >= 0).sum() < 20  # chance pairs stay out


def _toxic_rows():
    rows = [(i, ("you idiot, moron " if i % 3 == 0 else "a fine day ") + "word" + "abcdefghij"[i // 10] + "klmnopqrst"[i % 10] + " and more") for i in range(90)]
    return rows, [(i, 1, int(i % 3 == 0)) for i in range(90)]


def test_odd_rows_of_texts_and_labels(spark):
    rows, marks = _toxic_rows()
    rows += [(900, None), (901, ""), (None, "you IDIOT"), (902, "so fine " * 50_000 + "Moron! IDIOT"), (902, "a fine day")]
    marks += [(3, 0, 0), (None, 0, 1), (1, 0, None), (7777, 0, 1), (4, 0, 9)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(documents(spark, rows), labels).collect()
    assert len(got) == 95
    scores = {(r.doc_id, i): r for i, r in enumerate(got)}
    by = {k[0]: r for k, r in scores.items()}
    assert by[900].score == by[901].score
    assert by[None].held_out and by[None].predicted == 1 and by[0].predicted == 1 and by[1].predicted == 0
    assert sorted(r.predicted for r in got if r.doc_id == 902) == [0, 1]
    kept = toxicity.drop_toxic(documents(spark, rows), labels)
    assert kept.columns == documents(spark, rows).columns
    assert kept.count() == sum(1 - r.predicted for r in got)


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a"), (2, None)])
    assert [(r.score, r.predicted) for r in toxicity.score_toxicity(docs, labels).collect()] == [(0.0, 0)] * 2
    assert toxicity.drop_toxic(docs, labels).count() == 2
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("label", [0, 1])
def test_one_label_alone_does_not_break(label):
    terms, first = toxicity.term_sets(pa.array(["a b", "b c", "c d"]))
    machine = toxicity.fit([terms[x:z] for x, z in zip(first[:-1], first[1:])], np.full(3, float(label)))
    assert np.isfinite(machine.scores(pa.array(["a", ""]))).all()
